"""Gold marts over silver tables.

Orders are aggregated before any join, so only one row per group is shuffled and
joined, however many orders one restaurant, user or driver holds. Join sides are
left to Spark: it broadcasts below its size limit and sorts and merges above it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.functions.numeric import MONEY, cents, percentage, ratio
from tierlake.functions.text import iso_day

DELIVERED = "DELIVERED"
CANCELLED = "CANCELLED"

# An order count from here on, or a spend above this, makes a user a VIP.
VIP_ORDERS = 3
VIP_SPEND = 1000


def _delivered_amount() -> Column:
    return F.sum(F.when(F.col("order_status") == DELIVERED, F.col("total_amount")).otherwise(0))


def _residual(amount: Column) -> Column:
    """What rounding to cents takes away from an amount; with it, sums of a mart are exact."""
    return (amount - cents(amount)).cast(MONEY).alias("residual")


def _with(residual: bool) -> list[str]:
    return ["residual"] if residual else []


def daily_restaurant_sales(
    orders: DataFrame, restaurants: DataFrame, residual: bool = False
) -> DataFrame:
    """Sales per day and restaurant. Orders of unknown restaurants do not count.

    ``residual`` adds a column of that name: the net revenue before rounding, less the rounded one.
    """
    per_day = orders.groupBy(
        iso_day(F.col("order_timestamp")).alias("order_date"), "restaurant_id"
    ).agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(F.col("order_status") == DELIVERED).alias("completed_orders"),
        F.count_if(F.col("order_status") == CANCELLED).alias("cancelled_orders"),
        cents(F.sum("total_amount")).alias("gross_revenue"),
        cents(_delivered_amount()).alias("net_revenue"),
        _residual(_delivered_amount()),
    )
    # The order value divides the revenue after rounding.
    rated = per_day.withColumns({
        "avg_order_value": ratio(F.col("net_revenue"), F.col("completed_orders")),
        "cancellation_rate": percentage(F.col("cancelled_orders"), F.col("total_orders")),
    })
    names = restaurants.select("restaurant_id", "restaurant_name", "city")
    return rated.join(names, "restaurant_id").select(
        "order_date",
        "restaurant_id",
        "restaurant_name",
        "city",
        "total_orders",
        "completed_orders",
        "cancelled_orders",
        "gross_revenue",
        "net_revenue",
        "avg_order_value",
        "cancellation_rate",
        *_with(residual),
    )


def user_totals(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Every user with the totals of their orders: the shared input of the user and city marts."""
    by_user = orders.groupBy("user_id").agg(
        F.count("order_id").alias("total_orders"),
        _delivered_amount().alias("delivered_amount"),
        F.min("order_timestamp").alias("first_order_date"),
        F.max("order_timestamp").alias("last_order_date"),
    )
    return users.select("user_id", "full_name", "city").join(by_user, "user_id", "left")


def user_analytics(
    totals: DataFrame,
    vip_orders: int = VIP_ORDERS,
    vip_spend: float = VIP_SPEND,
    residual: bool = False,
) -> DataFrame:
    """Lifetime value and segment of every user, with zeros for users without orders.

    All orders count, only delivered ones are spend. First and last are the least
    and greatest timestamp text. ``residual`` adds what rounding took from the spend.
    """
    orders, spend = F.col("total_orders"), F.col("total_spend")
    segment = (
        F.when((orders >= vip_orders) | (spend > vip_spend), "HIGH_VALUE_VIP")
        .when(orders >= 1, "ACTIVE_REGULAR")
        .otherwise("NEW_INACTIVE")
    )
    return (
        totals.withColumns({
            "total_orders": F.coalesce("total_orders", F.lit(0)),
            "total_spend": cents(F.coalesce("delivered_amount", F.lit(0))),
            "residual": _residual(F.coalesce("delivered_amount", F.lit(0))),
        })
        .select(
            "user_id",
            "full_name",
            "city",
            "total_orders",
            "total_spend",
            ratio(spend, orders).alias("avg_order_spend"),
            "first_order_date",
            "last_order_date",
            segment.alias("rfm_segment"),
            *_with(residual),
        )
    )


def driver_metrics(drivers: DataFrame, orders: DataFrame, residual: bool = False) -> DataFrame:
    """Delivered orders and their revenue per driver, with zeros for idle drivers.

    ``residual`` adds what rounding took from the revenue.
    """
    per_driver = (
        orders.where((F.col("order_status") == DELIVERED) & F.col("driver_id").isNotNull())
        .groupBy("driver_id")
        .agg(F.count("order_id").alias("deliveries"), F.sum("total_amount").alias("revenue"))
    )
    profile = ["driver_id", "driver_name", "vehicle_type", "city", "rating"]
    return (
        drivers.select(*profile)
        .join(per_driver, "driver_id", "left")
        .select(
            *profile,
            F.coalesce("deliveries", F.lit(0)).alias("total_deliveries"),
            cents(F.coalesce("revenue", F.lit(0))).alias("total_revenue_handled"),
            *([_residual(F.coalesce("revenue", F.lit(0)))] if residual else []),
        )
    )


def city_performance(
    totals: DataFrame, restaurants: DataFrame, drivers: DataFrame, residual: bool = False
) -> DataFrame:
    """Totals per city of users and restaurants. Orders and revenue belong to the city of the user.

    The order value spreads delivered revenue over all orders, unlike the one of
    the daily sales. The sources meet in one union and one aggregation by city. ``residual``
    adds what rounding took from the revenue.
    """
    sources = (
        totals.select(
            "city", F.lit("user").alias("source"), "total_orders", "delivered_amount"
        )
        .unionByName(
            restaurants.select("city", F.lit("restaurant").alias("source")),
            allowMissingColumns=True,
        )
        .unionByName(
            drivers.select("city", F.lit("driver").alias("source")), allowMissingColumns=True
        )
    )
    by_city = sources.groupBy("city").agg(
        F.count_if(F.col("source") == "restaurant").alias("total_restaurants"),
        F.count_if(F.col("source") == "user").alias("total_active_users"),
        F.count_if(F.col("source") == "driver").alias("total_drivers"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
        cents(F.coalesce(F.sum("delivered_amount"), F.lit(0))).alias("total_city_revenue"),
        _residual(F.coalesce(F.sum("delivered_amount"), F.lit(0))),
    )
    # A city with drivers only is no market.
    rated = by_city.where(
        F.col("total_restaurants") + F.col("total_active_users") > 0
    ).withColumn("avg_order_value", ratio(F.col("total_city_revenue"), F.col("total_orders")))
    return rated.select(*[c for c in rated.columns if c != "residual"], *_with(residual))


def top_restaurants(daily_sales: DataFrame, k: int = 5) -> DataFrame:
    """Best days by net revenue; ties go to the earlier day, then the lower id."""
    return (
        daily_sales.orderBy(F.desc("net_revenue"), "order_date", "restaurant_id")
        .limit(k)
        .select("order_date", "restaurant_id", "restaurant_name", "net_revenue", "avg_order_value")
    )


def head(table: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """First rows of a table by key, as a repeatable preview."""
    return table.orderBy(*key).limit(n)
