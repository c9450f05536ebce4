"""A whole run over 84 raw records with known marts."""

import json
from decimal import Decimal as D

import pytest

from tests.conftest import dicts
from tierlake import TableStore, run_warehouse

# Cities in the order of their restaurants, drivers and first users.
CITIES = ["Bengaluru", "Delhi", "Hyderabad", "Pune", "Mumbai"]
# Day of February 2024, number of the restaurant, total; Pune cancels.
ORDERS = [
    (1, 2, "482.00"), (2, 3, "166.00"), (2, 4, "166.00"), (3, 1, "492.50"), (3, 5, "482.00"),
    (4, 2, "250.00"), (4, 3, "902.00"), (5, 4, "461.00"), (5, 5, "334.00"), (6, 1, "671.00"),
    (6, 2, "587.00"), (7, 3, "356.00"), (7, 4, "250.00"), (8, 1, "387.50"), (8, 5, "197.50"),
    (9, 2, "482.00"), (9, 3, "166.00"), (10, 4, "166.00"), (10, 5, "482.00"), (11, 1, "492.50"),
]
# First day, spend, average and segment of users 1 to 10.
USERS = [
    (6, "1163.50", "581.75", "VIP"), (1, "1069.00", "534.50", "VIP"), (2, "522.00", "261.00", ""),
    (2, "0", "0", ""), (3, "679.50", "339.75", ""), (3, "880.00", "440.00", ""),
    (4, "732.00", "366.00", ""), (4, "1068.00", "534.00", "VIP"), (5, "0", "0", ""),
    (5, "816.00", "408.00", ""),
]
# Deliveries and revenue of drivers 1 to 6.
DRIVERS = [(4, "2043.50"), (4, "1801.00"), (4, "1590.00"), (0, "0"), (4, "1495.50"), (0, "0")]
# Restaurants, users, drivers, orders, revenue, order value.
MARKETS = {
    "Bengaluru": (2, 2, 2, 4, D("2043.50"), D("510.88")), "Delhi": (2, 2, 1, 4, D("1801.00"), D("450.25")),
    "Hyderabad": (2, 2, 1, 4, D("1590.00"), D("397.50")), "Mumbai": (1, 2, 1, 4, D("1495.50"), D("373.88")),
    "Pune": (1, 2, 1, 4, D(0), D(0)),
}


def user_of(day, place):
    """The user of a restaurant's city who ordered on that day: each orders twice, five days apart."""
    return next(i for i, u in enumerate(USERS) if i % 5 == place and day in (u[0], u[0] + 5)) + 1


def raw_records():
    users = [{
        "user_id": f"USR_{i + 1:03d}", "full_name": f"User {i + 1}", "email": f"U{i}@X.COM",
        "phone_number": "1", "city": CITIES[i % 5], "registered_at": "2024-01-01",
    } for i in range(10)]
    restaurants = [{
        "restaurant_id": f"RST_{i + 1:03d}", "restaurant_name": f"Shop {i + 1}", "cuisine_type": "Any",
        "city": CITIES[i % 5], "rating": 4.0, "is_active": True,
    } for i in range(8)]
    drivers = [{
        "driver_id": f"DRV_{i + 1:03d}", "driver_name": f"Driver {i + 1}", "vehicle_type": "Bike",
        "city": CITIES[i % 5], "rating": 4.1 + i / 10, "is_active": True,
    } for i in range(6)]
    menu = [{
        "item_id": f"ITM_{i + 1:03d}", "restaurant_id": f"RST_{i % 8 + 1:03d}", "item_name": "Dish",
        "price": 100, "is_available": True,
    } for i in range(24)]
    orders, payments = [], []
    for n, (day, shop, total) in enumerate(ORDERS):
        place = shop - 1
        orders.append({
            "order_id": f"ORD_{n + 1:03d}", "user_id": f"USR_{user_of(day, place):03d}",
            "restaurant_id": f"RST_{shop:03d}", "driver_id": None if place == 3 else f"DRV_{shop:03d}",
            "order_status": "CANCELLED" if place == 3 else "DELIVERED",
            "order_timestamp": f"2024-02-{day:02d}T{12 + place}:00:00Z",
            "items": [{"item_id": f"ITM_{n + 1:03d}", "item_name": "Dish", "quantity": 1, "unit_price": float(total)}],
            "subtotal": float(total), "tax": 0.0, "delivery_fee": 0, "discount": 0, "total_amount": float(total),
        })
        if place != 3:
            payments.append({
                "payment_id": f"PAY_{n + 1:03d}", "order_id": f"ORD_{n + 1:03d}", "payment_method": "UPI",
                "payment_status": "SUCCESS", "transaction_amount": float(total),
                "payment_timestamp": f"2024-02-{day:02d}T20:00:00Z",
            })
    return {
        "users": users, "restaurants": restaurants, "drivers": drivers, "menu_items": menu,
        "orders": orders, "payments": payments,
    }


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("golden")
    for entity, records in raw_records().items():
        (folder / f"{entity}.json").write_text(json.dumps(records, indent=2))
    counts = run_warehouse(spark, str(folder), f"{folder}/warehouse")
    return counts, TableStore(spark, f"{folder}/warehouse")


def test_row_counts(run):
    counts, _ = run
    assert list(counts["bronze"].values()) == [10, 8, 6, 24, 20, 16]
    assert [sum(counts[layer].values()) for layer in ("bronze", "silver", "gold")] == [84, 104, 41]


def test_daily_sales(run):
    rows = dicts(run[1].read("gold_daily_restaurant_sales"), "order_date", "restaurant_id", "total_orders",
                 "gross_revenue", "net_revenue", "avg_order_value", "cancellation_rate")
    expected = []
    for day, shop, total in ORDERS:
        net, rate = (0, 100) if shop == 4 else (D(total), 0)
        expected.append((f"2024-02-{day:02d}", f"RST_{shop:03d}", 1, D(total), net, net, rate))
    assert sorted(tuple(r.values()) for r in rows) == sorted(expected)
    assert sum(r["net_revenue"] for r in rows) == D("6930.00")
    assert sum(r["gross_revenue"] for r in rows) == D("7973.00")


def test_users(run):
    rows = dicts(run[1].read("gold_user_analytics"), "user_id", "city", "total_orders", "total_spend",
                 "avg_order_spend", "first_order_date", "last_order_date", "rfm_segment")
    expected = [
        (f"USR_{i + 1:03d}", CITIES[i % 5], 2, D(spend), D(average), f"2024-02-{day:02d}T{12 + i % 5}:00:00Z",
         f"2024-02-{day + 5:02d}T{12 + i % 5}:00:00Z", "HIGH_VALUE_VIP" if segment else "ACTIVE_REGULAR")
        for i, (day, spend, average, segment) in enumerate(USERS)
    ]
    assert sorted(tuple(r.values()) for r in rows) == expected


def test_drivers_and_cities(run):
    rows = dicts(run[1].read("gold_driver_metrics"), "driver_id", "city", "rating", "total_deliveries",
                 "total_revenue_handled")
    assert sorted((r["driver_id"], r["city"], round(r["rating"], 1), r["total_deliveries"], r["total_revenue_handled"])
                  for r in rows) == [
        (f"DRV_{i + 1:03d}", CITIES[i % 5], round(4.1 + i / 10, 1), n, D(revenue)) for i, (n, revenue) in enumerate(DRIVERS)
    ]
    cities = dicts(run[1].read("gold_city_performance"))
    assert {r.pop("city"): tuple(r.values()) for r in cities} == MARKETS
