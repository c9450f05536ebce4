"""Data-quality reports over whole test tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import bindings as B
from checks import mart_queries as M
from checks.bindings import load, plain
from checks.catalog import query
from tierlake.operators import audits, marts

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# (child table, child key, parent table, parent key)
RELATIONS = [
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "supplier", "s_suppkey"),
    ("events", "user_id", "supplier", "s_suppkey"),
    ("labels", "doc_id", "documents", "doc_id"),
]


def _relation_sql(child, child_key, parent, parent_key):
    return f"""
SELECT '{child}.{child_key}' AS relation, count(DISTINCT {child_key}) AS missing_keys,
       count({child_key}) AS orphan_rows
FROM {child} x WHERE NOT EXISTS (
  SELECT 1 FROM {parent} y WHERE y.{parent_key} = x.{child_key})"""


@query(
    "pk_audit",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def pk_audit(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    return plain(audits.duplicate_keys(lines, ["l_orderkey", "l_linenumber"]))


@query(
    "null_audit",
    """SELECT count(*) AS rows,
  count(*) - count(u.user_id) AS user_id_nulls, count(*) - count(s.order_id) AS order_id_nulls,
  count(*) - count(s.order_timestamp) AS order_timestamp_nulls
FROM (SELECT c_custkey AS user_id FROM customer) u LEFT JOIN (
  SELECT event_id AS order_id, user_id, ts AS order_timestamp FROM events
) s ON u.user_id = s.user_id""",
)
def null_audit(spark, sf_dir):
    joined = B.users(spark, sf_dir).join(B.event_orders(spark, sf_dir), "user_id", "left")
    return audits.null_counts(joined, ["user_id", "order_id", "order_timestamp"])


@query(
    "empty_key_audit",
    """SELECT CAST(sum(CASE WHEN source IS NULL OR source = '' THEN 1 ELSE 0 END) AS BIGINT)
  AS empty_keys FROM documents""",
)
def empty_key_audit(spark, sf_dir):
    return audits.empty_keys(load(spark, sf_dir, "documents"), "source")


@query("fk_audit", " UNION ALL ".join(_relation_sql(*r) for r in RELATIONS))
def fk_audit(spark, sf_dir):
    def report(child, child_key, parent, parent_key):
        missing = audits.orphans(
            load(spark, sf_dir, child), child_key, load(spark, sf_dir, parent), parent_key
        )
        return audits.orphan_summary(f"{child}.{child_key}", missing)

    return reduce(DataFrame.unionByName, [report(*r) for r in RELATIONS])


@query(
    "fk_orphans",
    """SELECT user_id AS missing_key, count(*) AS rows FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1""",
)
def fk_orphans(spark, sf_dir):
    return audits.orphans(
        load(spark, sf_dir, "events"), "user_id", load(spark, sf_dir, "supplier"), "s_suppkey"
    )


@query(
    "amount_audit",
    """SELECT CAST(sum(CASE WHEN c_acctbal <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS non_positive
FROM customer""",
)
def amount_audit(spark, sf_dir):
    return audits.non_positive(load(spark, sf_dir, "customer"), "c_acctbal")


@query(
    "domain_audit",
    """SELECT DISTINCT o_orderstatus AS value, upper(o_orderstatus) = o_orderstatus AS is_upper
FROM orders
UNION ALL
SELECT DISTINCT event_type, upper(event_type) = event_type FROM events""",
)
def domain_audit(spark, sf_dir):
    statuses = audits.domain(load(spark, sf_dir, "orders"), "o_orderstatus")
    return statuses.unionByName(audits.domain(load(spark, sf_dir, "events"), "event_type"))


def _recon_sql(shops: str, name: str) -> str:
    return f"""
SELECT '{name}' AS check_name, CAST(l AS DOUBLE) AS left_total, CAST(r AS DOUBLE) AS right_total,
       l = r AS agrees
FROM (
  SELECT (SELECT coalesce(sum(s.total_amount), 0) FROM sales s JOIN {shops} d
          ON s.restaurant_id = d.restaurant_id WHERE s.order_status = 'DELIVERED') AS l,
         (SELECT sum(total_amount) FROM sales WHERE order_status = 'DELIVERED') AS r
)"""


@query(
    "recon_audit",
    f"""WITH {M.ORDERS_SQL},
known AS (SELECT c_custkey AS restaurant_id FROM customer),
partly AS (SELECT s_suppkey AS restaurant_id FROM supplier)
{_recon_sql("known", "all restaurants known")} UNION ALL
{_recon_sql("partly", "orders of unknown restaurants")}""",
)
def recon_audit(spark, sf_dir):
    orders = B.orders(spark, sf_dir)
    delivered = orders.where(F.col("order_status") == marts.DELIVERED)

    def report(name, restaurants):
        mart = marts.daily_restaurant_sales(orders, restaurants)
        checked = audits.reconcile(mart, F.col("net_revenue"), delivered, F.col("total_amount"))
        return checked.select(F.lit(name).alias("check_name"), "*")

    both = report(
        "all restaurants known", B.customers_as("restaurant", spark, sf_dir)
    ).unionByName(
        report("orders of unknown restaurants", B.suppliers_as("restaurant", spark, sf_dir))
    )
    return plain(both)


def _fine_recon_sql(name: str, shops: str, less: str = "0") -> str:
    return f"""
SELECT '{name}' AS check_name, CAST(l AS DOUBLE) AS left_total, CAST(r AS DOUBLE) AS right_total, l = r AS agrees
FROM (
  SELECT (SELECT coalesce(sum(total_amount), 0) - {less} FROM sales WHERE order_status = 'DELIVERED'
          AND restaurant_id IN (SELECT restaurant_id FROM {shops})) AS l,
         (SELECT sum(total_amount) FROM sales WHERE order_status = 'DELIVERED') AS r
)"""


@query(
    "recon_fine",
    f"""WITH {M.FINE_ORDERS_SQL},
known AS (SELECT c_custkey AS restaurant_id FROM customer),
partly AS (SELECT s_suppkey AS restaurant_id FROM supplier)
{_fine_recon_sql("every group rounded", "known")} UNION ALL
{_fine_recon_sql("one cent lost", "known", "CAST(0.01 AS DECIMAL(18,4))")} UNION ALL
{_fine_recon_sql("orders of unknown restaurants", "partly")}""",
)
def recon_fine(spark, sf_dir):
    """A mart rounded to cents against orders of four decimals: its residuals make up for the rounding."""
    orders = B.fine_orders(spark, sf_dir)
    delivered = orders.where(F.col("order_status") == marts.DELIVERED)
    cent = F.when(F.col("order_id") == delivered.agg(F.min("order_id")).first()[0], "0.01").otherwise("0")
    short = orders.withColumn("total_amount", F.col("total_amount") - cent.cast("decimal(18,4)"))

    def report(name, sales, restaurants):
        mart = marts.daily_restaurant_sales(sales, restaurants, residual=True)
        exact = F.col("net_revenue") + F.col("residual")
        checked = audits.reconcile(mart, exact, delivered, F.col("total_amount"), places=4)
        return checked.select(F.lit(name).alias("check_name"), "*")

    known, partly = (of("restaurant", spark, sf_dir) for of in (B.customers_as, B.suppliers_as))
    return plain(
        report("every group rounded", orders, known).unionByName(report("one cent lost", short, known))
        .unionByName(report("orders of unknown restaurants", orders, partly))
    )


@query(
    "distinct_audit",
    """SELECT count(DISTINCT n_name) AS distinct_values
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def distinct_audit(spark, sf_dir):
    return audits.distinct_count(B.users(spark, sf_dir), "city")


AUDITED_KEYS = {"customer": ["c_custkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]}
AUDITED_REQUIRED = {"customer": ["c_name"], "labels": ["quality", "toxic"]}
AUDITED_AMOUNTS = (("customer", "c_acctbal"), ("lineitem", "l_discount"))
AUDITED_CODES = (("orders", "o_orderstatus"), ("events", "event_type"))


def _report_sql() -> str:
    def one(audit, table, subject, found):
        return f"SELECT '{audit}' AS audit, '{table}' AS table_name, '{subject}' AS subject, CAST({found} AS BIGINT) AS found"

    parts = []
    for t in TABLES:
        parts.append(f"{one('rows', t, '*', 'count(*)')} FROM {t}")
        parts += [f"{one('nulls', t, c, f'count(*) FILTER ({c} IS NULL)')} FROM {t}" for c in AUDITED_REQUIRED.get(t, ())]
        parts += [
            f"""{one('empty_keys', t, c, f"count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '')")} FROM {t}"""
            for c in AUDITED_KEYS.get(t, ())
        ]
    parts += [f"{one('non_positive', t, c, f'count(*) FILTER ({c} <= 0)')} FROM {t}" for t, c in AUDITED_AMOUNTS]
    parts += [f"{one('not_upper', t, c, f'count(*) FILTER (upper({c}) <> {c})')} FROM {t}" for t, c in AUDITED_CODES]
    for t, keys in AUDITED_KEYS.items():
        names = ",".join(keys)
        parts.append(f"{one('duplicate_keys', t, names, f'count(*) - count(DISTINCT ({names}))')} FROM {t}")
    for child, column, parent, key in RELATIONS:
        missing = f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"
        parts.append(f"{one('orphans', child, column, f'count(*) FILTER ({missing})')} FROM {child}")
    return " UNION ALL ".join(parts)


@query("audit_report", _report_sql())
def audit_report(spark, sf_dir):
    return audits.report(
        {t: load(spark, sf_dir, t) for t in TABLES}, AUDITED_REQUIRED, AUDITED_KEYS,
        tuple(RELATIONS), AUDITED_AMOUNTS, AUDITED_CODES,
    )


@query(
    "layer_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES),
)
def layer_row_counts(spark, sf_dir):
    return audits.row_counts({t: load(spark, sf_dir, t) for t in TABLES})
