"""JSON landing, field rules, deduplication and unnesting over whole test tables.

Raw records are derived from table rows: which case a record exercises (null,
absent, blank, quoted, ...) follows from the row's own attributes.
"""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from checks import bindings as B
from checks import mart_queries as M
from checks.bindings import json_object, load, plain, quoted
from checks.catalog import query
from tierlake.functions import json as J
from tierlake.functions import numeric as N
from tierlake.functions import text as S
from tierlake.operators import cleaning, dedup, marts
from tierlake.session import REQUIRED
from tierlake.sources import raw_json

LOADED = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _text(column):
    return F.col(column).cast("string")


def _number(column):
    """JSON number with two places."""
    return F.col(column).cast("decimal(18,2)").cast("string")


def _no_audit(df):
    return plain(df.drop("processed_at"))


# -- JSON fields and landing ---------------------------------------------------------


@query(
    "json_field_extract",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(NULL AS VARCHAR) AS absent FROM events""",
)
def json_field_extract(spark, sf_dir):
    schema = J.record_schema(["absent"], ["k"])
    parsed = load(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", schema).alias("r")
    )
    return parsed.select("event_id", J.strict_int(F.col("r.k")).alias("k"), "r.absent")


@query(
    "bronze_roundtrip",
    """SELECT l_orderkey * 10 + l_linenumber AS row, CAST(l_orderkey AS VARCHAR) AS raw_order_id,
       'lines.jsonl' AS source_file, l_partkey AS part, l_quantity AS quantity,
       l_shipdate AS shipped
FROM lineitem""",
)
def bronze_roundtrip(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    record = F.struct(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part"),
        F.col("l_quantity").alias("quantity"), F.col("l_shipdate").alias("shipped"),
    )
    records = lines.select(
        F.to_json(record).alias("value"), F.lit("lines.jsonl").alias("path"),
        F.lit(0).alias("block"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row"),
        F.lit("lines.jsonl").alias("source_file"),
    )
    bronze = raw_json.bronze_rows(records, "order_id", LOADED)
    schema = "part bigint, quantity double, shipped timestamp_ntz"
    return bronze.select(
        F.col("record_id.row").alias("row"), "raw_order_id", "source_file",
        F.from_json("raw_json", schema).alias("r"),
    ).select("row", "raw_order_id", "source_file", "r.*")


@query(
    "bronze_array_scan",
    """SELECT path, pos AS row, CAST(l_orderkey AS VARCHAR) || '/' || CAST(pos AS VARCHAR)
         AS raw_order_id, amount
FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS path, o_orderkey AS l_orderkey, o_totalprice AS amount,
         unnest(range(0, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) - 1)) AS pos
  FROM orders
)""",
)
def bronze_array_scan(spark, sf_dir):
    def element(pos):
        identity = quoted(F.concat(_text("o_orderkey"), F.lit(f"/{pos}")))
        return json_object(order_id=identity, amount=_number("o_totalprice"), extra="[1, {}]")

    texts = load(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("path"), F.lit(0).alias("block"),
        F.lit("orders.json").alias("source_file"),
        _json_array([element(pos) for pos in range(4)]).alias("value"),
    )
    elements = F.posexplode(J.array_elements(F.col("value"))).alias("row", "value")
    records = texts.select("path", "block", "source_file", elements)
    bronze = raw_json.bronze_rows(records, "order_id", LOADED)
    return bronze.select(
        F.col("record_id.path").alias("path"), F.col("record_id.row").alias("row"),
        "raw_order_id", F.from_json("raw_json", "amount double")["amount"].alias("amount"),
    )


def _json_array(elements):
    """JSON array of the first zero to four elements, by the digit of the order priority."""
    wanted = F.substring("o_orderpriority", 1, 1).cast("int") - 1
    chosen = F.slice(F.array(*elements), F.lit(1), wanted)
    return F.concat(F.lit("["), F.array_join(chosen, ", "), F.lit("]"))


# -- field rules -----------------------------------------------------------------------


@query(
    "text_normalize",
    """SELECT doc_id,
       md5(translate(trim(text, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
         AS lowered,
       md5(translate(trim(text, ' '), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'))
         AS raised,
       upper(source) AS source, CASE WHEN trim(lang, ' ') = '' OR lang IS NULL THEN 'Unknown'
         ELSE trim(lang, ' ') END AS lang
FROM documents""",
)
def text_normalize(spark, sf_dir):
    trimmed = S.trim_spaces(F.col("text"))
    return load(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(S.ascii_lower(trimmed)).alias("lowered"),
        F.md5(S.ascii_upper(trimmed)).alias("raised"),
        S.unicode_upper(F.col("source")).alias("source"),
        S.or_default(S.trim_spaces(F.col("lang")), "Unknown").alias("lang"),
    )


@query(
    "cast_real_prefix",
    """SELECT event_id, value AS suffixed, value AS padded, 0.0::DOUBLE AS word,
       0.0::DOUBLE AS nothing, CAST(json_extract(props, '$.k') AS DOUBLE) AS dotted,
       CAST('-' || CAST(value AS VARCHAR) || 'e1' AS DOUBLE) AS exponent,
       CAST(NULL AS DOUBLE) AS unknown
FROM events""",
)
def cast_real_prefix(spark, sf_dir):
    value = _text("value")
    k = F.from_json("props", "k string")["k"]
    texts = {
        "suffixed": F.concat(value, F.lit("abc")),
        "padded": F.concat(F.lit(" \t"), value, F.lit(" 7")),
        "word": F.col("event_type"),
        "nothing": F.lit(""),
        "dotted": F.concat(F.lit("+"), k, F.lit(".x")),
        "exponent": F.concat(F.lit("-"), value, F.lit("e1x")),
        "unknown": F.lit(None).cast("string"),
    }
    return load(spark, sf_dir, "events").select(
        "event_id", *[N.real_prefix(c).alias(name) for name, c in texts.items()]
    )


@query(
    "json_bool_flag",
    """SELECT event_id, CAST(value > 10 AS BIGINT) AS bare, 0::BIGINT AS quoted,
       CAST(k = 1 AS BIGINT) AS number, CAST(k = 1 AS BIGINT) AS decimal,
       0::BIGINT AS digits, 0::BIGINT AS nothing, 0::BIGINT AS absent
FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def json_bool_flag(spark, sf_dir):
    names = ["bare", "quoted", "number", "decimal", "digits", "nothing", "absent"]
    bare = F.when(F.col("value") > 10, "true").otherwise("false")
    k = F.from_json("props", "k string")["k"]
    text = json_object(
        bare=bare, quoted=quoted(bare), number=k, decimal=F.concat(k, F.lit(".0")),
        digits=quoted(k), nothing="null",
    )
    parsed = load(spark, sf_dir, "events").select(
        "event_id", F.from_json(text, J.record_schema(variant_fields=names)).alias("r")
    )
    return plain(parsed.select("event_id", *[J.flag(F.col(f"r.{n}")).alias(n) for n in names]))


@query(
    "null_defaults",
    """SELECT event_id,
       CASE event_type WHEN 'view' THEN 'N/A' WHEN 'click' THEN 'N/A' WHEN 'error' THEN 'N/A'
            WHEN 'signup' THEN '  ' ELSE CAST(k AS VARCHAR) END AS phone,
       CASE event_type WHEN 'view' THEN 'Unknown' WHEN 'click' THEN 'Unknown'
            WHEN 'error' THEN 'Unknown' WHEN 'signup' THEN 'Unknown'
            ELSE CAST(k AS VARCHAR) END AS city,
       CASE event_type WHEN 'error' THEN 'UNKNOWN' WHEN 'view' THEN NULL WHEN 'click' THEN ''
            WHEN 'signup' THEN '  ' ELSE CAST(k AS VARCHAR) END AS status
FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def null_defaults(spark, sf_dir):
    kind = F.col("event_type")
    k = F.from_json("props", "k string")["k"]
    # View: null. Click: empty. Error: the key is absent. Signup: blanks. Purchase: a text.
    given = (
        F.when(kind == "view", "null").when(kind == "click", '""').when(kind == "signup", '"  "')
        .when(kind == "purchase", quoted(k))
    )
    text = json_object(phone=given, city=given, status=given)
    schema = J.record_schema(["city"], ["phone", "status"])
    parsed = load(spark, sf_dir, "events").select("event_id", F.from_json(text, schema).alias("r"))
    phone, status = F.col("r.phone"), F.col("r.status")
    return parsed.select(
        "event_id",
        F.when(J.is_falsy(phone), "N/A").otherwise(J.text_of(phone)).alias("phone"),
        S.or_default(S.trim_spaces(F.col("r.city")), "Unknown").alias("city"),
        J.when_missing(
            status, F.lit("UNKNOWN"), S.unicode_upper(J.string_only(status))
        ).alias("status"),
    )


@query(
    "line_total",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       CAST(l_quantity AS BIGINT) AS quantity,
       CAST(round(CAST(l_quantity AS DECIMAL(18,0))
            * CAST(l_extendedprice / l_quantity AS DECIMAL(18,4)), 2) AS DOUBLE) AS total_price
FROM lineitem""",
)
def line_total(spark, sf_dir):
    quantity = F.col("l_quantity").cast("long")
    unit_price = (F.col("l_extendedprice") / F.col("l_quantity")).cast(N.MONEY)
    return plain(load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", quantity.alias("quantity"),
        N.line_total(quantity, unit_price).alias("total_price"),
    ))


# -- deduplication -----------------------------------------------------------------------


@query(
    "dedup_latest",
    """SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
)
def dedup_latest(spark, sf_dir):
    events = load(spark, sf_dir, "events").where(F.col("user_id").isNotNull()).select(
        "user_id", "event_type", "event_id", "ts", "value"
    )
    return dedup.keep_latest(events, ["user_id", "event_type"], ["event_id"])


@query(
    "dedup_first",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""",
)
def dedup_first(spark, sf_dir):
    arrival = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    keys = ["l_orderkey", "l_linenumber"]
    return dedup.keep_first(load(spark, sf_dir, "lineitem").select(*keys, *arrival), keys, arrival)


# -- silver entities -------------------------------------------------------------------------


def _table(spark, sf_dir, name, key, ranged):
    """A table, with ``ranged`` in partitions by ranges of its key: before records are made of its rows."""
    rows = load(spark, sf_dir, name)
    return rows.repartitionByRange(key) if ranged else rows


def raw_users(spark, sf_dir, ranged=False):
    """Three records per customer; the first is unusable, the second outdated."""
    segment = F.col("c_mktsegment")
    user_id = quoted(_text("c_custkey"))
    phone = (
        F.when(segment == "HOUSEHOLD", "null").when(segment == "MACHINERY", '""')
        .when(segment == "AUTOMOBILE", "0").when(segment == "FURNITURE", '"  "')
    )
    city = (
        F.when(segment == "HOUSEHOLD", '"   "').when(segment == "MACHINERY", "null")
        .otherwise(quoted(F.concat(F.lit(" City "), _text("c_nationkey"))))
    )
    latest = json_object(
        user_id=user_id,
        full_name=quoted(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))),
        email=quoted(F.concat(F.lit(" "), F.upper("c_name"), F.lit("@X.COM "))),
        phone_number=phone,
        city=city,
        registered_at=quoted(F.concat(F.lit("2024-01-15T10:30:"), _text("c_nationkey"))),
        loyalty="{}",
    )
    outdated = json_object(
        user_id=user_id, full_name='"Old"', email='"old@x.com"', registered_at='"2020"'
    )
    unusable = json_object(user_id=user_id, full_name="null")
    versions = _table(spark, sf_dir, "customer", "c_custkey", ranged).select(
        "c_custkey", F.posexplode(F.array(unusable, outdated, latest)).alias("version", "text")
    )
    arrival = F.col("c_custkey") * 3 + F.col("version")
    return B.as_bronze(versions, "user_id", F.col("c_custkey"), F.col("text"), arrival)


SILVER_USERS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS full_name,
       lower(c_name) || '@x.com' AS email,
       CASE c_mktsegment WHEN 'FURNITURE' THEN '  ' ELSE 'N/A' END AS phone_number,
       CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 'Unknown'
            ELSE 'City ' || CAST(c_nationkey AS VARCHAR) END AS city,
       '2024-01-15T10:30:' || CAST(c_nationkey AS VARCHAR) AS registered_at
FROM customer"""


@query("silver_users", SILVER_USERS_SQL)
def silver_users(spark, sf_dir):
    return _no_audit(cleaning.clean_entity(raw_users(spark, sf_dir), cleaning.USERS, LOADED))


def _raw_flagged(table, key, names, balance, identity, label):
    """Restaurant or driver records; rating and flag take a JSON kind by account balance."""
    amount = F.col(balance)
    rating = (
        F.when(amount < 0, "null").when(amount < 2000, _number(balance))
        .when(amount < 4000, quoted(F.concat(_number(balance), F.lit("abc"))))
        .when(amount < 6000, '"abc"').when(amount < 8000, quoted(_number(balance)))
    )
    active = (
        F.when(amount < 0, "null").when(amount < 2000, '"true"').when(amount < 4000, "1")
        .when(amount < 6000, "true").when(amount < 7000, "1.0").when(amount < 8000, "2")
    )
    name, category = names
    record = json_object(**{
        key: quoted(_text(identity)),
        name: quoted(F.concat(F.lit(" "), F.col(label))),
        category: '"Any "',
        "city": F.when(amount < 0, '""').otherwise('" Pune "'),
        "rating": rating,
        "is_active": active,
    })
    return B.as_bronze(table, key, F.col(identity), record, F.col(identity))


def _flagged_sql(table, key, names, balance, identity, label):
    name, category = names
    return f"""
SELECT CAST({identity} AS VARCHAR) AS {key}, {label} AS {name}, 'Any' AS {category},
       CASE WHEN {balance} < 0 THEN '' ELSE 'Pune' END AS city,
       CAST(CASE WHEN {balance} < 0 THEN 0 WHEN {balance} < 4000 THEN {balance}
            WHEN {balance} < 6000 THEN 0 WHEN {balance} < 8000 THEN {balance} ELSE 0 END AS DOUBLE)
         AS rating,
       CAST(CASE WHEN {balance} < 2000 THEN 0 WHEN {balance} < 7000 THEN 1 ELSE 0 END AS BIGINT)
         AS is_active
FROM {table}"""


RESTAURANT_CASE = (
    "restaurant_id", ("restaurant_name", "cuisine_type"), "s_acctbal", "s_suppkey", "s_name"
)
DRIVER_CASE = ("driver_id", ("driver_name", "vehicle_type"), "c_acctbal", "c_custkey", "c_name")


def raw_restaurants(spark, sf_dir, ranged=False):
    return _raw_flagged(_table(spark, sf_dir, "supplier", "s_suppkey", ranged), *RESTAURANT_CASE)


def raw_drivers(spark, sf_dir, ranged=False):
    return _raw_flagged(_table(spark, sf_dir, "customer", "c_custkey", ranged), *DRIVER_CASE)


@query("silver_restaurants", _flagged_sql("supplier", *RESTAURANT_CASE))
def silver_restaurants(spark, sf_dir):
    bronze = raw_restaurants(spark, sf_dir)
    return _no_audit(cleaning.clean_entity(bronze, cleaning.RESTAURANTS, LOADED))


@query("silver_drivers", _flagged_sql("customer", *DRIVER_CASE))
def silver_drivers(spark, sf_dir):
    bronze = raw_drivers(spark, sf_dir)
    return _no_audit(cleaning.clean_entity(bronze, cleaning.DRIVERS, LOADED))


def raw_menu_items(spark, sf_dir, ranged=False):
    number = F.col("p_partkey")
    price = (
        F.when(F.col("p_type") == "PROMO", quoted(F.concat(_number("p_retailprice"), F.lit(" EUR"))))
        .when(F.col("p_type") == "LARGE", '"free"')
        .otherwise(_number("p_retailprice"))
    )
    record = json_object(
        item_id=_text("p_partkey"),
        restaurant_id=quoted(F.col("p_brand")),
        item_name=quoted(F.concat(F.lit(" "), F.col("p_name"), F.lit("  "))),
        price=price,
        is_available=F.when(F.col("p_size") > 25, "true"),
    )
    parts = _table(spark, sf_dir, "part", "p_partkey", ranged)
    return B.as_bronze(parts, "item_id", number, record, number)


@query(
    "silver_menu",
    """SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_brand AS restaurant_id, p_name AS item_name,
       CASE WHEN p_type = 'LARGE' THEN 0.0 ELSE p_retailprice END AS price,
       CAST(p_size > 25 AS BIGINT) AS is_available
FROM part""",
)
def silver_menu(spark, sf_dir):
    bronze = raw_menu_items(spark, sf_dir)
    return _no_audit(cleaning.clean_entity(bronze, cleaning.MENU_ITEMS, LOADED))


def raw_payments(spark, sf_dir, ranged=False):
    number = F.col("o_orderkey")
    amount = _number("o_totalprice")
    record = json_object(
        payment_id=quoted(_text("o_orderkey")),
        order_id=quoted(F.concat(F.lit("O"), _text("o_orderkey"))),
        payment_method=quoted(F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" "))),
        payment_status=quoted(F.lower("o_orderstatus")),
        transaction_amount=F.when(
            F.col("o_orderstatus") == "F", quoted(F.concat(amount, F.lit("INR")))
        ).otherwise(amount),
        payment_timestamp=quoted(F.date_format("o_orderdate", B.ISO)),
    )
    orders = _table(spark, sf_dir, "orders", "o_orderkey", ranged)
    return B.as_bronze(orders, "payment_id", number, record, number)


@query(
    "silver_payments",
    """SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, 'O' || CAST(o_orderkey AS VARCHAR) AS order_id,
       upper(o_orderpriority) AS payment_method, o_orderstatus AS payment_status,
       o_totalprice AS transaction_amount,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS payment_timestamp
FROM orders""",
)
def silver_payments(spark, sf_dir):
    bronze = raw_payments(spark, sf_dir)
    return _no_audit(cleaning.clean_entity(bronze, cleaning.PAYMENTS, LOADED))


def raw_orders(spark, sf_dir, ranged=False, state_totals=True):
    """Two records per order. The second one differs and loses, unusable as it is."""
    status = F.col("o_orderstatus")
    amount = _number("o_totalprice")
    identity = quoted(_text("o_orderkey"))

    def item(pos, **members):
        return json_object(
            item_id=quoted(F.concat(_text("o_orderkey"), F.lit(f"-{pos}"))), **members
        )

    items = _json_array([
        item(0, item_name='" Tea "', quantity="2.7", unit_price=amount),
        item(1, quantity='"3"', unit_price=quoted(amount)),
        item(2, item_name='"Naan"', unit_price="12.345"),
        item(3, item_name='"Rice"', quantity="4"),
    ])
    first = json_object(
        order_id=identity,
        user_id=quoted(_text("o_custkey")),
        restaurant_id=quoted(_text("o_custkey")),
        driver_id=F.when(status == "F", quoted(_text("o_custkey"))).when(status == "P", "null"),
        order_status=F.when(status == "F", '"delivered"').when(status == "P", '" placed "'),
        order_timestamp=quoted(F.date_format("o_orderdate", B.ISO)),
        # No status: no items either.
        items=F.when(status != "O", items),
        subtotal=amount,
        tax=F.when(status == "F", "5"),
        delivery_fee=F.when(status != "O", '"40.5"'),
        discount="20",
        # A stated total is trusted even where it contradicts its parts.
        total_amount=F.when((status == "F") & F.lit(state_totals), amount),
    )
    second = json_object(order_id=identity, order_status="null", total_amount='"wrong"')
    versions = _table(spark, sf_dir, "orders", "o_orderkey", ranged).select(
        "o_orderkey", F.posexplode(F.array(first, second)).alias("version", "text")
    )
    arrival = F.col("o_orderkey") * 2 + F.col("version")
    return B.as_bronze(versions, "order_id", F.col("o_orderkey"), F.col("text"), arrival)


@query(
    "silver_orders",
    """SELECT order_id, user_id, user_id AS restaurant_id, driver_id, order_status, order_timestamp,
       subtotal, tax, delivery_fee, discount,
       CAST(CASE WHEN stated THEN subtotal ELSE CAST(subtotal AS DECIMAL(18,2))
            + CAST(tax AS DECIMAL(18,2)) + CAST(delivery_fee AS DECIMAL(18,2))
            - CAST(discount AS DECIMAL(18,2)) END AS DOUBLE) AS total_amount
FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END AS driver_id,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'P' THEN ' PLACED ' ELSE 'UNKNOWN' END
           AS order_status,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS order_timestamp,
         o_totalprice AS subtotal,
         CASE WHEN o_orderstatus = 'F' THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS tax,
         CASE WHEN o_orderstatus = 'O' THEN 0.0::DOUBLE ELSE 40.5::DOUBLE END AS delivery_fee,
         20.0::DOUBLE AS discount, o_orderstatus = 'F' AS stated
  FROM orders
)""",
)
def silver_orders(spark, sf_dir):
    orders = cleaning.clean_orders(raw_orders(spark, sf_dir), LOADED)
    return _no_audit(orders.drop("items"))


@query(
    "order_total_default",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(CAST(o_totalprice AS DECIMAL(18,2))
            + CASE o_orderstatus WHEN 'F' THEN 25.5 WHEN 'P' THEN 20.5 ELSE -20 END AS DOUBLE)
         AS total_amount
FROM orders""",
)
def order_total_default(spark, sf_dir):
    orders = cleaning.clean_orders(raw_orders(spark, sf_dir, state_totals=False), LOADED)
    return plain(orders.select("order_id", "total_amount"))


@query(
    "unnest_items",
    """SELECT order_id, pos, order_id || '-' || CAST(pos AS VARCHAR) AS item_id,
       CASE pos WHEN 0 THEN ' Tea ' WHEN 1 THEN 'Unknown Item' WHEN 2 THEN 'Naan' ELSE 'Rice' END
         AS item_name,
       CAST(CASE pos WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 4 END AS BIGINT) AS quantity,
       CAST(CASE pos WHEN 0 THEN price WHEN 1 THEN price WHEN 2 THEN 12.345 ELSE 0 END AS DOUBLE)
         AS unit_price,
       CAST(CASE pos WHEN 0 THEN 2 * price WHEN 1 THEN 3 * price WHEN 2 THEN 12.35 ELSE 0 END
         AS DOUBLE) AS total_price
FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
         unnest(range(0, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) - 1)) AS pos
  FROM orders WHERE o_orderstatus <> 'O'
)""",
)
def unnest_items(spark, sf_dir):
    orders = cleaning.clean_orders(raw_orders(spark, sf_dir), LOADED)
    return _no_audit(cleaning.unnest_items(orders))


RAW_ENTITIES = {
    "users": raw_users,
    "restaurants": raw_restaurants,
    "drivers": raw_drivers,
    "menu_items": raw_menu_items,
    "orders": raw_orders,
    "payments": raw_payments,
}


# -- raw records to marts --------------------------------------------------------------------

RAW_ORDERS_SQL = """
sales AS (
  SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(o_custkey AS VARCHAR) AS restaurant_id,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'P' THEN ' PLACED ' ELSE 'UNKNOWN' END
           AS order_status,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS order_timestamp,
         CAST(o_totalprice AS DECIMAL(18,2)) + CASE o_orderstatus WHEN 'F' THEN 0
           WHEN 'P' THEN 20.5 ELSE -20 END AS total_amount
  FROM orders
)"""


@query(
    "raw_to_user_ltv",
    f"""WITH users AS ({SILVER_USERS_SQL}), {RAW_ORDERS_SQL},
{M.LTV_SQL.format(vip_orders=15, vip_spend=2500000)}""",
)
def raw_to_user_ltv(spark, sf_dir):
    users = cleaning.clean_entity(raw_users(spark, sf_dir), cleaning.USERS, LOADED)
    orders = cleaning.clean_orders(raw_orders(spark, sf_dir), LOADED)
    totals = marts.user_totals(users, orders)
    return plain(marts.user_analytics(totals, vip_orders=15, vip_spend=2500000))


@query(
    "raw_to_daily_sales",
    f"""WITH {RAW_ORDERS_SQL}, shops AS (
  SELECT CAST(c_custkey AS VARCHAR) AS restaurant_id, c_name AS restaurant_name,
         CASE WHEN c_acctbal < 0 THEN '' ELSE 'Pune' END AS city FROM customer
), {M.DAILY_SQL} SELECT * FROM mart""",
)
def raw_to_daily_sales(spark, sf_dir):
    shop_case = ("restaurant_id", ("restaurant_name", "cuisine_type"), *DRIVER_CASE[2:])
    bronze = _raw_flagged(load(spark, sf_dir, "customer"), *shop_case)
    restaurants = cleaning.clean_entity(bronze, cleaning.RESTAURANTS, LOADED)
    orders = cleaning.clean_orders(raw_orders(spark, sf_dir), LOADED)
    return plain(marts.daily_restaurant_sales(orders, restaurants))


@query(
    "json_repeated_member",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(2 AS BIGINT) AS quantity,
       CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 2, 2) AS DOUBLE) AS total_price
FROM orders""",
)
def json_repeated_member(spark, sf_dir):
    """Line items whose quantity is written twice; the last value counts."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    rows = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.format_string(
            '{"order_id":"%s","user_id":"u","restaurant_id":"r","order_timestamp":"t","items":[{"item_id":"a",'
            '"quantity":1,"quantity":2,"unit_price":%s}]}',
            F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        ).alias("record"),
    )
    key = F.col("order_id")
    bronze = B.as_bronze(rows, "order_id", key, F.col("record"), key)
    items = cleaning.unnest_items(cleaning.clean_orders(bronze, LOADED))
    return plain(items.select("order_id", "quantity", "total_price"))
