import json
from decimal import Decimal as D

import pytest

from tests.conftest import NOW, dicts
from tierlake import schemas
from tierlake.operators import cleaning, marts
from tierlake.sources.store import ConstraintViolation

USER = {
    "user_id": "u1", "full_name": "Ann", "email": "a@x.com", "phone_number": "1",
    "city": "Pune", "registered_at": "2024-01-01T00:00:00Z",
}
SHOP = {
    "restaurant_id": "r1", "restaurant_name": "Wok", "cuisine_type": "Thai", "city": "Pune",
    "rating": 4.5, "is_active": True,
}
ORDER = {
    "order_id": "o1", "user_id": "u1", "restaurant_id": "r1", "driver_id": "d1",
    "order_status": "DELIVERED", "order_timestamp": "2024-02-01T12:00:00Z",
    "items": [{"item_id": "i1", "item_name": "Tea", "quantity": 2, "unit_price": 10}],
    "subtotal": 20, "tax": 1.0, "delivery_fee": 4.0, "discount": 0.0, "total_amount": 25.0,
}
PAYMENT = {
    "payment_id": "p1", "order_id": "o1", "payment_method": "UPI", "payment_status": "SUCCESS",
    "transaction_amount": 25.0, "payment_timestamp": "2024-02-01T12:02:00Z",
}


def without(record, *keys):
    return {k: v for k, v in record.items() if k not in keys}


@pytest.fixture
def users(bronze):
    return lambda *r: cleaning.clean_entity(bronze("user_id", *r), cleaning.USERS, NOW)


@pytest.fixture
def shops(bronze):
    return lambda *r: cleaning.clean_entity(bronze("restaurant_id", *r), cleaning.RESTAURANTS, NOW)


@pytest.fixture
def orders(bronze):
    return lambda *r: cleaning.clean_orders(bronze("order_id", *r), NOW)


def test_latest_user_wins(users):
    rows = dicts(users(USER, {**USER, "full_name": "Bob"}))
    assert [r["full_name"] for r in rows] == ["Bob"]


def test_first_order_wins_with_its_own_items(orders):
    later = {**ORDER, "total_amount": 99, "items": ORDER["items"] * 3}
    first = orders(ORDER, later)
    assert [r["total_amount"] for r in dicts(first, "total_amount")] == [D(25)]
    assert cleaning.unnest_items(first).count() == 1


def test_user_ids(users):
    rows = users({**USER, "user_id": ""}, without(USER, "user_id"), {**USER, "user_id": None})
    assert [r["user_id"] for r in dicts(rows)] == [""]


def test_order_ids(orders):
    ids = ["", None, 0, False, [], {}, "0", "o9", 7]
    rows = orders(without(ORDER, "order_id"), *[{**ORDER, "order_id": i} for i in ids])
    assert [r["order_id"] for r in dicts(rows, "order_id")] == ["0", "7", "o9"]


def test_falsy_order_id_does_not_shadow_a_quoted_one(orders):
    rows = orders({**ORDER, "order_id": 0, "user_id": "x"}, {**ORDER, "order_id": "0"})
    assert [r["user_id"] for r in dicts(rows, "user_id")] == ["u1"]


def test_user_texts(users):
    rows = dicts(users(
        {**USER, "user_id": "1", "email": "  A@X.COM ", "full_name": " Ann "},
        {**USER, "user_id": "2", "email": "ÉA@X.COM", "full_name": "\tAnn"},
    ))
    assert [r["email"] for r in rows] == ["a@x.com", "Éa@x.com"]
    assert [r["full_name"] for r in rows] == ["Ann", "\tAnn"]


def each(record, key, field, values):
    """The record once per value of a field, with keys a, b, c, ..."""
    return [{**record, key: chr(97 + i), field: v} for i, v in enumerate(values)]


def column(df, key, name):
    return [r[name] for r in dicts(df, key, name)]


def test_phone(users):
    df = users(*each(USER, "user_id", "phone_number", [None, "", "  ", 0, False, "0", 98]))
    assert column(df, "user_id", "phone_number") == [
        "N/A", "N/A", "  ", "N/A", "N/A", "0", "98"
    ]


def test_user_city(users):
    df = users(*each(USER, "user_id", "city", ["   ", None, " Pune "]))
    assert column(df, "user_id", "city") == ["Unknown", "Unknown", "Pune"]


def test_missing_phone_and_city(users):
    row = dicts(users(without(USER, "phone_number", "city")))[0]
    assert (row["phone_number"], row["city"]) == ("N/A", "Unknown")


def test_restaurant_city_has_no_default(shops, store):
    assert dicts(shops({**SHOP, "city": ""}))[0]["city"] == ""
    with pytest.raises(ConstraintViolation, match="city"):
        store.load("silver_restaurants", shops({**SHOP, "city": None}))


def test_rating(shops):
    df = shops(*each(SHOP, "restaurant_id", "rating", [None, "4.5abc", "abc", 3]))
    assert column(df, "restaurant_id", "rating") == [0.0, 4.5, 0.0, 3.0]


def test_flags_by_json_kind(shops):
    given = [True, 1, 1.0, 2, "true", "1", None]
    records = [{**SHOP, "restaurant_id": str(i), "is_active": v} for i, v in enumerate(given)]
    records.append({**without(SHOP, "is_active"), "restaurant_id": "7"})
    assert [r["is_active"] for r in dicts(shops(*records), "restaurant_id", "is_active")] == [
        1, 1, 1, 0, 0, 0, 0, 0
    ]


def test_order_status_is_not_trimmed(orders):
    assert dicts(orders({**ORDER, "order_status": " delivered "}), "order_status") == [
        {"order_status": " DELIVERED "}
    ]


def test_order_defaults(orders):
    row = dicts(orders(without(
        ORDER, "order_status", "tax", "delivery_fee", "discount", "driver_id"
    )), "order_status", "tax", "delivery_fee", "discount", "driver_id", "total_amount")[0]
    assert row == {
        "order_status": "UNKNOWN", "tax": D(0), "delivery_fee": D(0), "discount": D(0),
        "driver_id": None, "total_amount": D(25),
    }


def test_missing_total_is_computed_and_a_given_one_trusted(orders):
    parts = {**ORDER, "subtotal": 100, "tax": 5, "delivery_fee": 40, "discount": 20}
    rows = dicts(orders(
        {**without(parts, "total_amount"), "order_id": "a"},
        {**parts, "order_id": "b", "total_amount": 999},
    ), "order_id", "total_amount")
    assert [r["total_amount"] for r in rows] == [D(125), D(999)]


BAD_FIELDS = [
    ("order_status", None), ("order_status", 5), ("subtotal", None), ("tax", "x"),
    ("total_amount", None), ("user_id", None), ("restaurant_id", None),
    ("order_timestamp", None), ("items", None), ("items", 5), ("items", {"a": 1}),
]


def test_unusable_order_fields_are_null(orders):
    records = [{**ORDER, "order_id": chr(97 + i), f: v} for i, (f, v) in enumerate(BAD_FIELDS)]
    rows = dicts(orders(*records).drop("driver_id"), "*")
    for row, (field, _) in zip(rows, BAD_FIELDS, strict=True):
        assert [c for c, v in row.items() if v is None and c != "processed_at"] == [field]


def test_unusable_order_fields_fail_the_load(orders, store):
    records = each(ORDER, "order_id", "order_status", ["placed", None, None])
    with pytest.raises(ConstraintViolation, match="{'order_status': 2}"):
        store.stage("silver_orders", orders(*records), extra=("items",))


def test_orders_without_items_are_kept(orders):
    df = orders(without(ORDER, "items"), *each(ORDER, "order_id", "items", [[], "", {}]))
    assert df.count() == 4
    assert cleaning.unnest_items(df).count() == 0


def test_items(orders):
    items = [
        {"item_id": "i1", "item_name": " Tea ", "quantity": 2.7, "unit_price": 1.115},
        {"item_id": "i1", "quantity": "3", "unit_price": "2"},
        {"item_id": 5, "item_name": "Naan"},
    ]
    rows = dicts(cleaning.unnest_items(orders({**ORDER, "items": items})))
    names = ["pos", "item_id", "item_name", "quantity", "unit_price", "total_price"]
    assert [[r[n] for n in names] for r in rows] == [
        [0, "i1", " Tea ", 2, D("1.1150"), D("2.2300")],
        [1, "i1", "Unknown Item", 3, D(2), D(6)],
        [2, "5", "Naan", 1, D(0), D(0)],
    ]


BAD_ITEMS = [
    ("item_id", {"item_id": None}), ("item_id", {}), ("item_id", 5),
    ("item_name", {"item_id": "i", "item_name": None}),
    ("quantity", {"item_id": "i", "quantity": "2.5"}),
    ("unit_price", {"item_id": "i", "unit_price": None}),
]


def test_unusable_items_are_null(orders):
    items = [item for _, item in BAD_ITEMS]
    rows = dicts(cleaning.unnest_items(orders({**ORDER, "items": items})), "pos", "item_id",
                 "item_name", "quantity", "unit_price")
    for row, (field, _) in zip(rows, BAD_ITEMS, strict=True):
        assert [c for c, v in row.items() if v is None] == [field]


def test_payments(bronze):
    raw = bronze(
        "payment_id", {**PAYMENT, "payment_method": " upi ", "transaction_amount": "25.5 INR"}
    )
    row = dicts(cleaning.clean_entity(raw, cleaning.PAYMENTS, NOW))[0]
    assert (row["payment_method"], row["transaction_amount"]) == ("UPI", D("25.5"))


def test_menu_items(bronze):
    raw = bronze("item_id", {
        "item_id": "i1", "restaurant_id": "r1", "item_name": " Tea ", "price": 10, "x": {"y": 1},
    })
    assert dicts(cleaning.clean_entity(raw, cleaning.MENU_ITEMS, NOW)) == [{
        "item_id": "i1", "restaurant_id": "r1", "item_name": "Tea", "price": D(10),
        "is_available": 0,
    }]


def test_bad_value_in_a_discarded_duplicate_does_no_harm(users, orders, store):
    assert store.load("silver_users", users({**USER, "full_name": None}, USER)) == 1
    df = orders(ORDER, {**ORDER, "subtotal": "x", "items": None})
    assert store.stage("silver_orders", df, extra=("items",)).rows == 1


def test_declared_columns_match(users, orders):
    assert users(USER).columns != []
    for table, df in [("silver_users", users(USER)), ("silver_orders", orders(ORDER))]:
        declared = {f.name: f.dataType for f in schemas.TABLES[table].fields}
        built = {f.name: f.dataType for f in df.schema.fields if f.name in declared}
        assert built == declared


def test_empty_containers_are_phone_texts(users):
    df = users(*each(USER, "user_id", "phone_number", [[], {}, "", None]))
    assert column(df, "user_id", "phone_number") == ["[]", "{}", "N/A", "N/A"]


def test_last_of_repeated_members_counts(orders):
    text = json.dumps({**ORDER, "items": []}).replace(
        '"items": []', '"items": [{"item_id": "a", "quantity": 1, "quantity": 2, "unit_price": 3}]'
    )
    item = cleaning.unnest_items(orders(text)).first()
    assert (item["quantity"], item["total_price"]) == (2, D(6))


def test_unreadable_field_is_refused(spark, store, orders, users):
    """Without the setting the jobs require, Spark can't read a repeated member at all."""
    twice = '{"item_id": "a", "quantity": 1, "quantity": 2, "unit_price": 3}'
    order = json.dumps({**ORDER, "items": []}).replace('"items": []', f'"items": [{twice}]')
    user = json.dumps({**USER, "phone_number": {}}).replace("{}", '{"a": 1, "a": 2}')
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        for table, df in (("silver_orders", orders(order)), ("silver_users", users(user))):
            with pytest.raises(ConstraintViolation):
                store.load(table, df)
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def test_parsed_rows_are_not_broadcast(bronze):
    """Spark's estimate of their size is far too small, also for what a mart makes of them."""
    shops = cleaning.clean_entity(bronze("restaurant_id", {"restaurant_id": "r1"}), cleaning.RESTAURANTS, NOW)
    users = cleaning.clean_entity(bronze("user_id", {"user_id": "u1"}), cleaning.USERS, NOW)
    orders = cleaning.clean_orders(bronze("order_id", {"order_id": "o1"}), NOW)
    for mart in (marts.daily_restaurant_sales(orders, shops), marts.user_totals(users, orders)):
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_only_records_that_deduplication_keeps_are_cleaned(bronze):
    """The rules lie above the window in the plan, and with latest records the parsing, too."""
    orders = cleaning.clean_orders(bronze("order_id", {"order_id": "o1"}), NOW)
    users = cleaning.clean_entity(bronze("user_id", {"user_id": "u1"}), cleaning.USERS, NOW)
    for rows, costly in ((orders, "variant_get("), (users, "variant_get("), (users, "phone_number")):
        above, _, below = rows._jdf.queryExecution().executedPlan().toString().partition("Window [")
        assert costly in above and costly not in below


def test_items_that_are_no_objects_have_defaults(orders):
    items = [1, None, "x", {}, {"quantity": None}, {"item_id": 7, "unit_price": "2.5"}]
    found = orders({**ORDER, "items": items}).first()["items"]
    assert [tuple(i) for i in found] == [
        (None, "Unknown Item", 1, D(0)), (None, "Unknown Item", 1, D(0)), (None, "Unknown Item", 1, D(0)),
        (None, "Unknown Item", 1, D(0)), (None, "Unknown Item", None, D(0)), ("7", "Unknown Item", 1, D("2.5")),
    ]
