"""Silver rows from bronze records.

Each record is parsed once. Rules never raise: a value the warehouse must refuse
becomes NULL in a column declared NOT NULL, so a bad value in a record that
deduplication discards does no harm, and the store refuses the load otherwise.
"""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.functions import json as J
from tierlake.functions import numeric as N
from tierlake.functions import text as S
from tierlake.operators.dedup import keep_first, keep_latest

Rule = Callable[[Column], Column]

# What is read of a line item; an element that is no object has none of the members.
LINE_ITEM = "struct<item_id:string,item_name:variant,quantity:variant,unit_price:variant>"
LINE_ITEMS = f"array<struct<item_id:string,item_name:string,quantity:bigint,unit_price:{N.MONEY}>>"


@dataclass(frozen=True)
class Cleaning:
    """Key and rules of an entity that keeps the latest record of each key."""

    key: str
    texts: dict[str, Rule]
    variants: dict[str, Rule]


def timestamp(moment: datetime) -> Column:
    """One moment for all rows of a load."""
    return F.lit(moment).cast("timestamp")


def _as_is(c: Column) -> Column:
    return c


def _code(c: Column) -> Column:
    return S.ascii_upper(S.trim_spaces(c))


def _email(c: Column) -> Column:
    return S.ascii_lower(S.trim_spaces(c))


def _city(c: Column) -> Column:
    return S.or_default(S.trim_spaces(c), "Unknown")


def _phone(v: Column) -> Column:
    # An empty array or object is a text of its own, unlike other empty values.
    text = F.when(J.is_container(v), F.to_json(v)).otherwise(J.text_of(v))
    return F.when(J.is_falsy(v) & ~J.is_container(v), "N/A").otherwise(text)


def _rating(v: Column) -> Column:
    return F.coalesce(N.real_prefix(J.real_text(v)), F.lit(0.0))


def _amount(v: Column) -> Column:
    return N.real_prefix(J.real_text(v), N.MONEY)


USERS = Cleaning(
    "user_id",
    {
        "full_name": S.trim_spaces,
        "email": _email,
        "city": _city,
        "registered_at": _as_is,
    },
    {"phone_number": _phone},
)

RESTAURANTS = Cleaning(
    "restaurant_id",
    {"restaurant_name": S.trim_spaces, "cuisine_type": S.trim_spaces, "city": S.trim_spaces},
    {"rating": _rating, "is_active": J.flag},
)

DRIVERS = Cleaning(
    "driver_id",
    {"driver_name": S.trim_spaces, "vehicle_type": S.trim_spaces, "city": S.trim_spaces},
    {"rating": _rating, "is_active": J.flag},
)

MENU_ITEMS = Cleaning(
    "item_id",
    {"restaurant_id": _as_is, "item_name": S.trim_spaces},
    {"price": _amount, "is_available": J.flag},
)

PAYMENTS = Cleaning(
    "payment_id",
    {
        "order_id": _as_is,
        "payment_method": _code,
        "payment_status": _code,
        "payment_timestamp": _as_is,
    },
    {"transaction_amount": _amount},
)


#: Where a silver row comes from: bronze record, and its key as written.
RECORD = ("record_id", "record_key")


def clean_entity(
    bronze: DataFrame, cleaning: Cleaning, processed_at: datetime, with_record: bool = False
) -> DataFrame:
    """Latest record of each key with its rules applied; records without a key are left out.

    The key comes from the bronze id column, so records without one are skipped in
    the scan and only the latest of a key is parsed. ``with_record`` adds the columns ``RECORD``.
    """
    written = f"raw_{cleaning.key}"
    known = bronze.where(F.col(written).isNotNull()).select("record_id", written, "raw_json")
    latest = keep_latest(known, [written], ["record_id"])
    record = J.read_record(F.col("raw_json"), cleaning.texts, cleaning.variants)
    # Expanding the parsed record keeps a filter on the result from parsing it again.
    parsed = latest.select("record_id", F.col(written).alias(cleaning.key), F.inline(F.array(record)))
    rules = {**cleaning.texts, **cleaning.variants}
    rows = parsed.select(
        "record_id",
        cleaning.key,
        F.col(J.UNREADABLE).isNotNull().alias("unreadable"),
        *[rule(F.col(name)).alias(name) for name, rule in rules.items()],
    )
    return _refuse_unreadable(rows, cleaning.key, processed_at, with_record)


def _refuse_unreadable(
    rows: DataFrame, key: str, processed_at: datetime, with_record: bool
) -> DataFrame:
    """Without the key that every table requires, the store refuses the load."""
    marked = rows.withColumns({
        "record_key": F.col(key),
        key: F.when(~F.col("unreadable"), F.col(key)),
        "processed_at": timestamp(processed_at),
    })
    rows = marked.drop("unreadable", *([] if with_record else RECORD))
    # Spark takes parsed rows for far smaller than they are. Without the hint it would broadcast them, or
    # what they are summed up to, at any size.
    return rows.hint("merge")


def clean_orders(bronze: DataFrame, processed_at: datetime, with_record: bool = False) -> DataFrame:
    """First record of each order, with its line items as a typed array.

    ``items`` is empty when the key is absent and NULL when its value is no array. ``with_record``
    adds the columns ``RECORD``.
    """
    record = J.read_record(
        F.col("raw_json"),
        ["user_id", "restaurant_id", "driver_id", "order_timestamp"],
        ["order_id", "order_status", "subtotal", "tax", "delivery_fee", "discount",
         "total_amount", "items"],
    )
    # An id of 0 or false reads like a quoted one in the bronze column, so the kind of
    # such ids is looked up too. Expanding the parsed record keeps that filter from
    # parsing it again.
    written = F.col("raw_order_id")
    suspect = F.substring(written, 1, 1).isin("0", "-", "f", "[", "{")
    known = (
        bronze.where(written.isNotNull() & (written != ""))
        .select("record_id", "raw_order_id", F.inline(F.array(record)))
        .withColumn("unreadable", F.col(J.UNREADABLE).isNotNull())
        .where(F.col("unreadable") | ~(suspect & J.is_falsy(F.col("order_id"))))
        .drop(J.UNREADABLE, "order_id")
    )
    # The rules cost more than the parsing, so they are for the records that deduplication keeps.
    first = keep_first(known, ["raw_order_id"], ["record_id"])
    zero = F.lit(0).cast(N.MONEY)
    parts = ["subtotal", "tax", "delivery_fee", "discount"]
    rows = (
        first.select(
            "record_id",
            F.col("raw_order_id").alias("order_id"),
            "unreadable",
            "user_id",
            "restaurant_id",
            "driver_id",
            J.when_missing(
                F.col("order_status"),
                F.lit("UNKNOWN"),
                S.unicode_upper(J.string_only(F.col("order_status"))),
            ).alias("order_status"),
            "order_timestamp",
            *[J.when_missing(F.col(p), zero, J.strict_money(F.col(p))).alias(p) for p in parts],
            "total_amount",
            line_items(F.col("items")).alias("items"),
        )
        .withColumn(
            "total_amount",
            J.when_missing(
                F.col("total_amount"), order_total(), J.strict_money(F.col("total_amount"))
            ),
        )
    )
    return _refuse_unreadable(rows, "order_id", processed_at, with_record)


def order_total() -> Column:
    """Total of an order that states none."""
    total = F.col("subtotal") + F.col("tax") + F.col("delivery_fee") - F.col("discount")
    return total.try_cast(N.MONEY)


def line_items(v: Column) -> Column:
    """Typed line items of an order's ``items`` value."""
    none = F.array().cast(LINE_ITEMS)
    typed = F.transform(J.elements(v, LINE_ITEM), _line_item)
    # Empty values of other kinds hold no items either.
    empty = F.when(F.to_json(v).isin('""', "{}"), none)
    return J.when_missing(v, none, F.coalesce(typed, empty))


def _line_item(item: Column) -> Column:
    name, quantity, unit_price = item["item_name"], item["quantity"], item["unit_price"]
    return F.struct(
        item["item_id"].alias("item_id"),
        J.when_missing(name, F.lit("Unknown Item"), J.text_of(name)).alias("item_name"),
        J.when_missing(quantity, F.lit(1).cast("long"), J.strict_int(quantity)).alias("quantity"),
        J.when_missing(unit_price, F.lit(0).cast(N.MONEY), J.strict_money(unit_price)).alias(
            "unit_price"
        ),
    )


def unnest_items(orders: DataFrame) -> DataFrame:
    """One row per line item of ``clean_orders``; orders without items give none."""
    exploded = orders.select("order_id", "processed_at", F.posexplode("items").alias("pos", "item"))
    return exploded.select(
        "order_id", F.col("pos").cast("long").alias("pos"), "item.*", "processed_at"
    ).withColumn("total_price", N.line_total(F.col("quantity"), F.col("unit_price")))
