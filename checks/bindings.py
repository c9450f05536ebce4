"""Test tables in the shape the warehouse operators expect.

Renames and value maps only; every table is used whole.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as longs, for comparison across engines."""
    def cast(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return F.col(field.name).cast("long").alias(field.name)
        return F.col(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,4)")


def status(column: str, delivered: str, cancelled: str) -> Column:
    value = F.col(column)
    return (
        F.when(value == delivered, "DELIVERED").when(value == cancelled, "CANCELLED")
        .otherwise("PLACED")
    )


def orders(spark, sf_dir, amount: Column | None = None) -> DataFrame:
    """Orders; the customer stands for the user and for the restaurant."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_custkey").alias("restaurant_id"),
        status("o_orderstatus", "F", "P").alias("order_status"),
        F.date_format("o_orderdate", ISO).alias("order_timestamp"),
        (money("o_totalprice") if amount is None else amount).alias("total_amount"),
    )


def fine_orders(spark, sf_dir) -> DataFrame:
    """Orders with amounts of four decimals."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return orders(spark, sf_dir, (price / 100).cast("decimal(18,4)"))


def deliveries(spark, sf_dir) -> DataFrame:
    """Line items as orders of a restaurant that a driver delivers; both are the supplier."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("restaurant_id"),
        F.col("l_suppkey").alias("driver_id"),
        status("l_returnflag", "R", "A").alias("order_status"),
        F.date_format("l_shipdate", ISO).alias("order_timestamp"),
        money("l_extendedprice").alias("total_amount"),
    )


def event_orders(spark, sf_dir) -> DataFrame:
    """Events as orders. Only some customers have events, the others have no order."""
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("order_id"),
        "user_id",
        F.col("user_id").alias("driver_id"),
        status("event_type", "purchase", "error").alias("order_status"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("order_timestamp"),
        money("value").alias("total_amount"),
    )


def nations(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "nation")


def users(spark, sf_dir) -> DataFrame:
    """Customers with their nation as the city."""
    return (
        load(spark, sf_dir, "customer")
        .join(nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("full_name"),
            F.col("n_name").alias("city"),
        )
    )


def customers_as(kind: str, spark, sf_dir) -> DataFrame:
    """Customers as restaurants or drivers."""
    return users(spark, sf_dir).select(
        F.col("user_id").alias(f"{kind}_id"), F.col("full_name").alias(f"{kind}_name"), "city"
    )


def suppliers_as(kind: str, spark, sf_dir) -> DataFrame:
    """Suppliers with their nation as the city."""
    return (
        load(spark, sf_dir, "supplier")
        .join(nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias(f"{kind}_id"),
            F.col("s_name").alias(f"{kind}_name"),
            F.col("n_name").alias("city"),
            F.col("s_acctbal").alias("rating"),
            F.lit("Scooter").alias("vehicle_type"),
        )
    )


def regional_restaurants(spark, sf_dir) -> DataFrame:
    """Suppliers with their region as the city, so no user shares a city with them."""
    return (
        load(spark, sf_dir, "supplier")
        .join(nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("restaurant_id"), F.col("r_name").alias("city"))
    )


def branded_drivers(spark, sf_dir) -> DataFrame:
    """Parts as drivers with their brand as the city: cities that have drivers only."""
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("driver_id"), F.col("p_brand").alias("city")
    )


def as_bronze(df: DataFrame, key: str, identity: Column, json: Column, row: Column) -> DataFrame:
    """Bronze records whose id, text and arrival number are derived from table rows."""
    return df.select(
        F.struct(
            F.lit("").alias("file_order"), F.lit("records").alias("path"), F.lit(0).cast("long").alias("block"),
            row.cast("long").alias("row"),
        ).alias("record_id"),
        identity.cast("string").alias(f"raw_{key}"),
        json.alias("raw_json"),
    )


def quoted(c: Column) -> Column:
    """JSON string literal of a text without characters that need escaping."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def json_object(**members: Column | str) -> Column:
    """JSON object text; a member given as None is left out by Spark's ``concat_ws``."""
    parts = [
        F.concat(F.lit(f'"{name}":'), F.lit(value) if isinstance(value, str) else value)
        for name, value in members.items()
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
