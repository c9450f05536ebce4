from decimal import Decimal as D

import pytest

from tests.conftest import dicts
from tierlake.operators import marts

ORDER = "order_id string, user_id string, restaurant_id string, driver_id string, " \
        "order_status string, order_timestamp string, total_amount decimal(18,4)"
DAY = "2024-02-01T10:00:00Z"


@pytest.fixture
def orders(spark):
    """Orders as (user, restaurant, driver, status, amount[, timestamp])."""
    def build(*rows):
        full = [
            (f"o{i}", *r[:4], (r[5] if len(r) > 5 else DAY), D(r[4])) for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(full, ORDER)

    return build


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [("u1", "Ann", "A"), ("u2", "Bob", "B"), ("u3", "Cid", "A")],
        "user_id string, full_name string, city string",
    )


@pytest.fixture
def restaurants(spark):
    return spark.createDataFrame(
        [("r1", "Wok", "A"), ("r2", "Pie", "B"), ("r3", "Bun", "C")],
        "restaurant_id string, restaurant_name string, city string",
    )


@pytest.fixture
def drivers(spark):
    return spark.createDataFrame(
        [("d1", "Dee", "Bike", "A", 4.5), ("d2", "Eli", "Car", "Z", 4.0)],
        "driver_id string, driver_name string, vehicle_type string, city string, rating double",
    )


def ltv(users, orders, **limits):
    rows = dicts(marts.user_analytics(marts.user_totals(users, orders), **limits))
    return {r["user_id"]: r for r in rows}


def test_daily_sales(orders, restaurants):
    df = orders(
        ("u1", "r1", "d1", "DELIVERED", "100.005"),
        ("u2", "r1", None, "CANCELLED", "50"),
        ("u2", "r1", None, "PLACED", "7"),
        ("u2", "r1", "d1", "DELIVERED", "20", "2024-02-02T00:00:00Z"),
    )
    day, next_day = dicts(marts.daily_restaurant_sales(df, restaurants))
    assert day == {
        "order_date": "2024-02-01", "restaurant_id": "r1", "restaurant_name": "Wok", "city": "A",
        "total_orders": 3, "completed_orders": 1, "cancelled_orders": 1,
        "gross_revenue": D("157.01"), "net_revenue": D("100.01"),
        "avg_order_value": D("100.01"), "cancellation_rate": D("33.33"),
    }
    assert (next_day["order_date"], next_day["gross_revenue"]) == ("2024-02-02", D(20))


def test_day_with_cancelled_orders_only(orders, restaurants):
    row = dicts(marts.daily_restaurant_sales(
        orders(("u1", "r1", None, "CANCELLED", "50")), restaurants
    ))[0]
    assert [row[c] for c in ("net_revenue", "avg_order_value", "cancellation_rate")] == [0, 0, 100]


def test_day_is_taken_from_the_text(orders, restaurants):
    df = orders(("u1", "r1", None, "DELIVERED", "5", "2024-02-01T23:30:00-05:00"))
    assert dicts(marts.daily_restaurant_sales(df, restaurants))[0]["order_date"] == "2024-02-01"


def test_orders_of_unknown_restaurants(orders, users, restaurants):
    df = orders(("u1", "r9", None, "DELIVERED", "5"))
    assert marts.daily_restaurant_sales(df, restaurants).count() == 0
    assert ltv(users, df)["u1"]["total_spend"] == 5


def test_status_with_blanks_is_not_delivered(orders, users, restaurants):
    df = orders(("u1", "r1", "d1", " DELIVERED ", "5"))
    assert dicts(marts.daily_restaurant_sales(df, restaurants))[0]["completed_orders"] == 0
    assert ltv(users, df)["u1"]["total_spend"] == 0


def test_user_without_orders(orders, users):
    row = ltv(users, orders(("u1", "r1", None, "DELIVERED", "5")))["u2"]
    assert row == {
        "user_id": "u2", "full_name": "Bob", "city": "B", "total_orders": 0, "total_spend": 0,
        "avg_order_spend": 0, "first_order_date": None, "last_order_date": None,
        "rfm_segment": "NEW_INACTIVE",
    }


@pytest.mark.parametrize("amount, segment", [
    ("1000.00", "ACTIVE_REGULAR"), ("1000.004", "ACTIVE_REGULAR"), ("1000.01", "HIGH_VALUE_VIP"),
])
def test_vip_by_spend(orders, users, amount, segment):
    df = orders(("u1", "r1", None, "DELIVERED", amount))
    assert ltv(users, df)["u1"]["rfm_segment"] == segment


def test_vip_by_cancelled_orders(orders, users):
    row = ltv(users, orders(*[("u1", "r1", None, "CANCELLED", "9")] * 3))["u1"]
    assert (row["rfm_segment"], row["total_spend"]) == ("HIGH_VALUE_VIP", 0)


def test_average_spend_counts_all_orders(orders, users):
    df = orders(
        ("u1", "r1", None, "DELIVERED", "10", "2024-02-03T00:00:00Z"),
        ("u1", "r1", None, "CANCELLED", "99", "2024-02-01T00:00:00Z"),
    )
    row = ltv(users, df)["u1"]
    assert (row["avg_order_spend"], row["total_orders"]) == (5, 2)
    assert row["first_order_date"] == "2024-02-01T00:00:00Z"
    assert row["last_order_date"] == "2024-02-03T00:00:00Z"


def test_drivers(orders, drivers):
    df = orders(
        ("u1", "r1", "d1", "DELIVERED", "10.005"), ("u1", "r1", "d1", "CANCELLED", "99"),
        ("u1", "r1", None, "DELIVERED", "99"), ("u1", "r1", "d9", "DELIVERED", "99"),
    )
    rows = dicts(marts.driver_metrics(drivers, df), "driver_id", "total_deliveries",
                 "total_revenue_handled")
    assert [tuple(r.values()) for r in rows] == [("d1", 1, D("10.01")), ("d2", 0, 0)]


def test_cities(orders, users, restaurants, drivers):
    df = orders(
        ("u2", "r1", None, "DELIVERED", "10"),  # user of city B, restaurant of city A
        ("u2", "r1", None, "CANCELLED", "99"),
        ("u9", "r1", None, "DELIVERED", "99"),  # unknown user
    )
    rows = dicts(marts.city_performance(marts.user_totals(users, df), restaurants, drivers))
    assert [tuple(r.values()) for r in rows] == [
        # city, restaurants, users, drivers, orders, revenue, order value over all orders
        ("A", 1, 2, 1, 0, 0, 0),
        ("B", 1, 1, 0, 2, D(10), D(5)),
        ("C", 1, 0, 0, 0, 0, 0),  # restaurants only; Z has drivers only and is absent
    ]


def test_top_and_head(orders, restaurants):
    df = orders(*[("u1", f"r{i % 3 + 1}", None, "DELIVERED", "10", f"2024-02-0{i}T") for i in range(1, 8)])
    top = marts.top_restaurants(marts.daily_restaurant_sales(df, restaurants), 3).collect()
    assert [r["order_date"] for r in top] == ["2024-02-01", "2024-02-02", "2024-02-03"]
    assert [r["order_id"] for r in marts.head(df, ["order_id"], 2).collect()] == ["o0", "o1"]
