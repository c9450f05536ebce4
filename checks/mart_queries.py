"""Marts, city union, top-k and preview over whole test tables."""

from checks import bindings as B
from checks.bindings import plain
from checks.catalog import query
from tierlake.operators import marts

USERS_SQL = """
users AS (
  SELECT c_custkey AS user_id, c_name AS full_name, n_name AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

ORDERS_SQL = """
sales AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_custkey AS restaurant_id,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'P' THEN 'CANCELLED'
              ELSE 'PLACED' END AS order_status,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS order_timestamp,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
  FROM orders
)"""

# Amounts with four decimals, so that a mart that divides before it rounds differs.
FINE_ORDERS_SQL = ORDERS_SQL.replace(
    "CAST(o_totalprice AS DECIMAL(18,2))",
    "CAST(CAST(o_totalprice AS DECIMAL(18,2)) / 100 AS DECIMAL(18,4))",
)

EVENT_ORDERS_SQL = """
sales AS (
  SELECT event_id AS order_id, user_id, user_id AS driver_id,
         CASE event_type WHEN 'purchase' THEN 'DELIVERED' WHEN 'error' THEN 'CANCELLED'
              ELSE 'PLACED' END AS order_status,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS order_timestamp,
         CAST(value AS DECIMAL(18,2)) AS total_amount
  FROM events
)"""

DELIVERIES_SQL = """
sales AS (
  SELECT l_orderkey AS order_id, l_suppkey AS restaurant_id, l_suppkey AS driver_id,
         CASE l_returnflag WHEN 'R' THEN 'DELIVERED' WHEN 'A' THEN 'CANCELLED'
              ELSE 'PLACED' END AS order_status,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS order_timestamp,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount
  FROM lineitem
)"""

SUPPLIERS_SQL = """
shops AS (
  SELECT s_suppkey AS restaurant_id, s_suppkey AS driver_id, s_name AS restaurant_name,
         n_name AS city, s_acctbal AS rating
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

CUSTOMER_SHOPS_SQL = """
shops AS (SELECT user_id AS restaurant_id, full_name AS restaurant_name, city FROM users)"""

DAILY_SQL = """
per_day AS (
  SELECT restaurant_id, substr(order_timestamp, 1, 10) AS order_date, count(*) AS n,
         count(*) FILTER (order_status = 'DELIVERED') AS done,
         count(*) FILTER (order_status = 'CANCELLED') AS dropped,
         round(sum(total_amount), 2) AS gross,
         round(coalesce(sum(total_amount) FILTER (order_status = 'DELIVERED'), 0), 2) AS net
  FROM sales GROUP BY ALL
),
mart AS (
  SELECT order_date, restaurant_id, restaurant_name, city, n AS total_orders,
         done AS completed_orders, dropped AS cancelled_orders,
         CAST(gross AS DOUBLE) AS gross_revenue, CAST(net AS DOUBLE) AS net_revenue,
         CAST(CASE WHEN done > 0 THEN round(CAST(net / done AS DECIMAL(38,10)), 2) ELSE 0 END
              AS DOUBLE) AS avg_order_value,
         CAST(round(CAST(100.0 * dropped / n AS DECIMAL(38,10)), 2) AS DOUBLE)
           AS cancellation_rate
  FROM per_day JOIN shops USING (restaurant_id)
)"""

LTV_SQL = """
totals AS (
  SELECT u.user_id, u.full_name, u.city, CAST(count(s.order_id) AS BIGINT) AS total_orders,
         round(coalesce(sum(s.total_amount) FILTER (s.order_status = 'DELIVERED'), 0), 2) AS spend,
         min(s.order_timestamp) AS first_order_date, max(s.order_timestamp) AS last_order_date
  FROM users u LEFT JOIN sales s ON u.user_id = s.user_id
  GROUP BY 1, 2, 3
)
SELECT user_id, full_name, city, total_orders, CAST(spend AS DOUBLE) AS total_spend,
       CAST(CASE WHEN total_orders > 0
            THEN round(CAST(spend / total_orders AS DECIMAL(38,10)), 2) ELSE 0 END AS DOUBLE)
         AS avg_order_spend,
       first_order_date, last_order_date,
       CASE WHEN total_orders >= {vip_orders} OR spend > {vip_spend} THEN 'HIGH_VALUE_VIP'
            WHEN total_orders >= 1 THEN 'ACTIVE_REGULAR' ELSE 'NEW_INACTIVE' END AS rfm_segment
FROM totals"""

CITY_SQL = """,
kitchens AS (SELECT city, count(*) AS n FROM shops GROUP BY city),
crews AS (SELECT city, count(*) AS n FROM riders GROUP BY city),
people AS (SELECT city, count(*) AS n FROM users GROUP BY city),
bought AS (
  SELECT city, count(*) AS n,
         round(coalesce(sum(total_amount) FILTER (order_status = 'DELIVERED'), 0), 2) AS revenue
  FROM sales JOIN users USING (user_id) GROUP BY city
),
markets AS (SELECT city FROM kitchens UNION SELECT city FROM people)
SELECT city, coalesce(kitchens.n, 0) AS total_restaurants, coalesce(people.n, 0) AS total_active_users,
       coalesce(crews.n, 0) AS total_drivers, coalesce(bought.n, 0) AS total_orders,
       CAST(coalesce(revenue, 0) AS DOUBLE) AS total_city_revenue,
       CAST(CASE WHEN bought.n > 0 THEN round(CAST(revenue / bought.n AS DECIMAL(38,10)), 2) ELSE 0 END
            AS DOUBLE) AS avg_order_value
FROM markets LEFT JOIN kitchens USING (city) LEFT JOIN people USING (city)
LEFT JOIN crews USING (city) LEFT JOIN bought USING (city)"""

REGIONAL_SQL = """
shops AS (
  SELECT r_name AS city FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""


@query(
    "daily_sales",
    f"WITH {USERS_SQL}, {ORDERS_SQL}, {CUSTOMER_SHOPS_SQL}, {DAILY_SQL} SELECT * FROM mart",
)
def daily_sales(spark, sf_dir):
    mart = marts.daily_restaurant_sales(
        B.orders(spark, sf_dir), B.customers_as("restaurant", spark, sf_dir)
    )
    return plain(mart)


@query(
    "daily_sales_fine",
    f"WITH {USERS_SQL}, {FINE_ORDERS_SQL}, {CUSTOMER_SHOPS_SQL}, {DAILY_SQL} SELECT * FROM mart",
)
def daily_sales_fine(spark, sf_dir):
    mart = marts.daily_restaurant_sales(
        B.fine_orders(spark, sf_dir), B.customers_as("restaurant", spark, sf_dir)
    )
    return plain(mart)


@query(
    "daily_sales_deliveries",
    f"WITH {DELIVERIES_SQL}, {SUPPLIERS_SQL}, {DAILY_SQL} SELECT * FROM mart",
)
def daily_sales_deliveries(spark, sf_dir):
    mart = marts.daily_restaurant_sales(
        B.deliveries(spark, sf_dir), B.suppliers_as("restaurant", spark, sf_dir)
    )
    return plain(mart)


@query(
    "user_ltv",
    f"WITH {USERS_SQL}, {ORDERS_SQL}, {LTV_SQL.format(vip_orders=15, vip_spend=2500000)}",
)
def user_ltv(spark, sf_dir):
    totals = marts.user_totals(B.users(spark, sf_dir), B.orders(spark, sf_dir))
    return plain(marts.user_analytics(totals, vip_orders=15, vip_spend=2500000))


@query(
    "user_ltv_fine",
    f"WITH {USERS_SQL}, {FINE_ORDERS_SQL}, {LTV_SQL.format(vip_orders=15, vip_spend=25000)}",
)
def user_ltv_fine(spark, sf_dir):
    totals = marts.user_totals(B.users(spark, sf_dir), B.fine_orders(spark, sf_dir))
    return plain(marts.user_analytics(totals, vip_orders=15, vip_spend=25000))


@query(
    "user_ltv_events",
    f"WITH {USERS_SQL}, {EVENT_ORDERS_SQL}, {LTV_SQL.format(vip_orders=75, vip_spend=1000)}",
)
def user_ltv_events(spark, sf_dir):
    totals = marts.user_totals(B.users(spark, sf_dir), B.event_orders(spark, sf_dir))
    return plain(marts.user_analytics(totals, vip_orders=75, vip_spend=1000))


@query(
    "driver_metrics",
    f"""WITH {DELIVERIES_SQL}, {SUPPLIERS_SQL}
SELECT d.driver_id, d.restaurant_name AS driver_name, 'Scooter' AS vehicle_type, d.city, d.rating,
       count(s.order_id) AS total_deliveries,
       CAST(coalesce(sum(s.total_amount), 0) AS DOUBLE) AS total_revenue_handled
FROM shops d LEFT JOIN sales s ON d.driver_id = s.driver_id AND s.order_status = 'DELIVERED'
GROUP BY 1, 2, 3, 4, 5""",
)
def driver_metrics(spark, sf_dir):
    drivers = B.suppliers_as("driver", spark, sf_dir)
    return plain(marts.driver_metrics(drivers, B.deliveries(spark, sf_dir)))


@query(
    "driver_metrics_events",
    f"""WITH {USERS_SQL}, {EVENT_ORDERS_SQL}
SELECT d.user_id AS driver_id, d.full_name AS driver_name, 'Bike' AS vehicle_type, d.city,
       CAST(c.c_acctbal AS DOUBLE) AS rating, count(s.order_id) AS total_deliveries,
       CAST(coalesce(sum(s.total_amount), 0) AS DOUBLE) AS total_revenue_handled
FROM users d JOIN customer c ON c.c_custkey = d.user_id
LEFT JOIN sales s ON d.user_id = s.driver_id AND s.order_status = 'DELIVERED'
GROUP BY 1, 2, 3, 4, 5""",
)
def driver_metrics_events(spark, sf_dir):
    customers = B.load(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS driver_id", "c_acctbal AS rating", "'Bike' AS vehicle_type"
    )
    drivers = B.customers_as("driver", spark, sf_dir).join(customers, "driver_id")
    return plain(marts.driver_metrics(drivers, B.event_orders(spark, sf_dir)))


@query(
    "city_performance",
    f"""WITH {USERS_SQL}, {ORDERS_SQL}, {SUPPLIERS_SQL},
riders AS (SELECT city FROM shops) {CITY_SQL}""",
)
def city_performance(spark, sf_dir):
    return plain(_cities(spark, sf_dir, B.orders(spark, sf_dir)))


@query(
    "city_performance_fine",
    f"""WITH {USERS_SQL}, {FINE_ORDERS_SQL}, {SUPPLIERS_SQL},
riders AS (SELECT city FROM shops) {CITY_SQL}""",
)
def city_performance_fine(spark, sf_dir):
    return plain(_cities(spark, sf_dir, B.fine_orders(spark, sf_dir)))


def _cities(spark, sf_dir, orders):
    return marts.city_performance(
        marts.user_totals(B.users(spark, sf_dir), orders),
        B.suppliers_as("restaurant", spark, sf_dir),
        B.suppliers_as("driver", spark, sf_dir),
    )


@query(
    "city_performance_sparse",
    f"""WITH {USERS_SQL}, {EVENT_ORDERS_SQL}, {REGIONAL_SQL},
riders AS (SELECT p_brand AS city FROM part) {CITY_SQL}""",
)
def city_performance_sparse(spark, sf_dir):
    return plain(_sparse_cities(spark, sf_dir))


def _sparse_cities(spark, sf_dir):
    return marts.city_performance(
        marts.user_totals(B.users(spark, sf_dir), B.event_orders(spark, sf_dir)),
        B.regional_restaurants(spark, sf_dir),
        B.branded_drivers(spark, sf_dir),
    )


@query(
    "city_union",
    f"WITH {USERS_SQL}, {REGIONAL_SQL} SELECT city FROM users UNION SELECT city FROM shops",
)
def city_union(spark, sf_dir):
    return _sparse_cities(spark, sf_dir).select("city")


@query(
    "top_restaurants",
    f"""WITH {DELIVERIES_SQL}, {SUPPLIERS_SQL}, {DAILY_SQL}
SELECT order_date, restaurant_id, restaurant_name, net_revenue, avg_order_value FROM mart
ORDER BY net_revenue DESC, order_date, restaurant_id LIMIT 5""",
)
def top_restaurants(spark, sf_dir):
    mart = marts.daily_restaurant_sales(
        B.deliveries(spark, sf_dir), B.suppliers_as("restaurant", spark, sf_dir)
    )
    return plain(marts.top_restaurants(mart))


@query(
    "head_n",
    f"WITH {ORDERS_SQL} SELECT order_id, user_id, order_status, order_timestamp, "
    "CAST(total_amount AS DOUBLE) AS total_amount FROM sales ORDER BY order_id LIMIT 5",
)
def head_n(spark, sf_dir):
    orders = B.orders(spark, sf_dir).drop("restaurant_id")
    return plain(marts.head(orders, ["order_id"]))
