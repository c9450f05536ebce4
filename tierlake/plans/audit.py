"""The quality checks over the tables of a warehouse."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake import schemas
from tierlake.operators import audits, marts
from tierlake.sources.store import TableStore

AMOUNTS = (
    ("silver_menu_items", "price"), ("silver_orders", "total_amount"),
    ("silver_payments", "transaction_amount"),
)
CODES = (
    ("silver_orders", "order_status"), ("silver_payments", "payment_method"),
    ("silver_payments", "payment_status"),
)


def audit_warehouse(store: TableStore, recount: bool = False) -> DataFrame:
    """All checks on the current tables, as ``audits.report`` gives them.

    Rows and NULLs in required columns come from the store, which counted them when it wrote the
    tables, unless ``recount`` asks for the files' own. A last row per mart with revenue tells
    the cents, rounded up, by which it differs from the delivered orders it should hold. Both sums
    are exact: a mart keeps beside its rounded amounts what rounding took away.
    """
    tables = {name: store.read(name) for name in schemas.TABLES}
    known = {} if recount else {
        name: v.rows for name, v in store.versions().items() if v.rows is not None
    }
    required = {name: schemas.required(schema) for name, schema in schemas.TABLES.items()}
    found = audits.report(
        tables, required, schemas.PRIMARY_KEYS, schemas.FOREIGN_KEYS, AMOUNTS, CODES, known
    )
    delivered = tables["silver_orders"].where(F.col("order_status") == marts.DELIVERED)
    for mart, amount, parent, key in (
        ("gold_daily_restaurant_sales", "net_revenue", "silver_restaurants", "restaurant_id"),
        ("gold_user_analytics", "total_spend", "silver_users", "user_id"),
        ("gold_city_performance", "total_city_revenue", "silver_users", "user_id"),
        ("gold_driver_metrics", "total_revenue_handled", "silver_drivers", "driver_id"),
    ):
        sold = delivered.join(tables[parent].select(key), key, "left_semi")
        exact = F.col(amount) + F.coalesce("residual", F.lit(0))
        held = store.read(mart, schemas.RESIDUAL)
        both = audits.reconcile(held, exact, sold, F.col("total_amount"), places=4)
        cents = F.ceil(F.abs(F.col("left_total") - F.col("right_total")) * 100).cast("long")
        found = found.unionByName(both.select(
            F.lit("reconciliation").alias("audit"), F.lit(mart).alias("table_name"),
            F.lit(amount).alias("subject"), cents.alias("found"),
        ))
    return found
