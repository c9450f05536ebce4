import gzip
import json
import os
import re
import time
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.conftest import dicts
from tierlake import ConstraintViolation, TableStore, run_warehouse, schemas
from tierlake.operators import audits, marts
from tierlake.plans.audit import audit_warehouse
from tierlake.plans.warehouse import shuffles_for
from tierlake.session import CLEANUP, settings, splits_of_text
from tierlake.sources import raw_json

USERS = [
    {"user_id": "u1", "full_name": "Old", "email": "O@X.COM", "city": "A", "registered_at": "2024"},
    {"user_id": "u1", "full_name": " Ann ", "email": " A@X.COM", "city": "A ", "registered_at": "2024"},
    {"user_id": "u2", "full_name": "Bob", "email": "b@x.com", "registered_at": "2024"},
]
RESTAURANTS = [{
    "restaurant_id": "r1", "restaurant_name": "Wok", "cuisine_type": "Thai", "city": "B",
    "rating": 4.5, "is_active": True,
}]
DRIVERS = [{
    "driver_id": "d1", "driver_name": "Dee", "vehicle_type": "Bike", "city": "C",
    "rating": "4.1", "is_active": 1,
}]
MENU = [{"item_id": "i1", "restaurant_id": "r1", "item_name": "Tea", "price": 5, "is_available": True}]


def order(number, user, status, total, **more):
    return {
        "order_id": f"o{number}", "user_id": user, "restaurant_id": "r1", "driver_id": "d1",
        "order_status": status, "order_timestamp": f"2024-02-0{number}T12:00:00Z",
        "items": [{"item_id": "i1", "item_name": "Tea", "quantity": 2, "unit_price": 5.5}] * number,
        "subtotal": total, "total_amount": total, **more,
    }


ORDERS = [
    order(1, "u1", "delivered", 600.5),
    order(2, "u1", "Delivered", 500),
    order(2, "u2", "CANCELLED", 1),  # comes second and loses
    order(3, "u2", "CANCELLED", 50, driver_id=None),
    {**order(4, "u2", "DELIVERED", 10), "tax": 1, "total_amount": 11, "restaurant_id": "r9"},
]
PAYMENTS = [{
    "payment_id": "p1", "order_id": "o1", "payment_method": "upi", "payment_status": "success",
    "transaction_amount": 600.5, "payment_timestamp": "2024-02-01T12:02:00Z",
}]
RAW = {
    "users": USERS, "restaurants": RESTAURANTS, "drivers": DRIVERS, "menu_items": MENU,
    "orders": ORDERS, "payments": PAYMENTS,
}


def write_raw(folder, layout):
    folder.mkdir()
    for entity, records in RAW.items():
        if layout == "array":
            (folder / f"{entity}.json").write_text(json.dumps(records, indent=2))
        else:
            lines = "\n".join(json.dumps(r) for r in records)
            (folder / f"{entity}.jsonl").write_text(lines)
    return str(folder)


@pytest.fixture(scope="module", params=["array", "lines"])
def run(request, spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp(request.param)
    raw = write_raw(folder / "raw", request.param)
    root = str(folder / "warehouse")
    return run_warehouse(spark, raw, root, request.param), TableStore(spark, root), raw, request.param


def test_row_counts(run):
    summary = run[0]
    assert summary["bronze"] == {
        "bronze_users": 3, "bronze_restaurants": 1, "bronze_drivers": 1, "bronze_menu_items": 1,
        "bronze_orders": 5, "bronze_payments": 1,
    }
    assert summary["silver"] == {
        "silver_users": 2, "silver_restaurants": 1, "silver_drivers": 1, "silver_menu_items": 1,
        "silver_orders": 4, "silver_order_items": 10, "silver_payments": 1,
    }
    assert summary["gold"] == {
        "gold_daily_restaurant_sales": 3, "gold_user_analytics": 2, "gold_driver_metrics": 1,
        "gold_city_performance": 3,
    }
    assert summary["execution_time_seconds"] > 0


def test_counts_agree_with_the_tables(run):
    summary, store, _, _ = run
    counts = summary["bronze"] | summary["silver"] | summary["gold"]
    assert {t: store.read(t).count() for t in schemas.TABLES} == counts


def test_marts(run):
    store = run[1]
    sales = dicts(store.read("gold_daily_restaurant_sales"), "order_date", "net_revenue",
                  "gross_revenue", "cancellation_rate")
    assert [tuple(r.values()) for r in sales] == [
        ("2024-02-01", D("600.50"), D("600.50"), 0), ("2024-02-02", 500, 500, 0),
        ("2024-02-03", 0, 50, 100),
    ]
    users = dicts(store.read("gold_user_analytics"), "user_id", "full_name", "city",
                  "total_orders", "total_spend", "avg_order_spend", "rfm_segment")
    assert [tuple(r.values()) for r in users] == [
        ("u1", "Ann", "A", 2, D("1100.50"), D("550.25"), "HIGH_VALUE_VIP"),
        ("u2", "Bob", "Unknown", 2, 11, D("5.50"), "ACTIVE_REGULAR"),
    ]
    drivers = dicts(store.read("gold_driver_metrics"), "total_deliveries", "total_revenue_handled")
    assert drivers == [{"total_deliveries": 3, "total_revenue_handled": D("1111.50")}]
    cities = dicts(store.read("gold_city_performance"))
    assert [tuple(r.values()) for r in cities] == [
        ("A", 0, 1, 0, 2, D("1100.50"), D("550.25")), ("B", 1, 0, 0, 0, 0, 0),
        ("Unknown", 0, 1, 0, 2, D(11), D("5.50")),
    ]


def test_rerun_gives_the_same_contents(run, spark):
    _, store, raw, layout = run
    tables = [*schemas.SILVER, *schemas.GOLD]
    before = {t: dicts(store.read(t)) for t in tables}
    run_warehouse(spark, raw, store.root, layout)
    assert {t: dicts(store.read(t)) for t in tables} == before


def test_quality_reports_on_the_tables(run):
    store = run[1]
    for table, keys in schemas.PRIMARY_KEYS.items():
        assert audits.duplicate_keys(store.read(table), keys).count() == 0, table
        schema = schemas.TABLES[table]
        row = audits.null_counts(store.read(table), schemas.required(schema)).first().asDict()
        row.pop("rows")
        assert set(row.values()) == {0}, table
    orphans = {
        (child, column): audits.orphans(store.read(child), column, store.read(parent), key).count()
        for child, column, parent, key in schemas.FOREIGN_KEYS
    }
    assert {k for k, n in orphans.items() if n} == {("silver_orders", "restaurant_id")}
    assert audits.empty_keys(store.read("silver_users"), "user_id").first()["empty_keys"] == 0
    assert audits.non_positive(store.read("silver_orders"), "total_amount").first()[0] == 0
    domain = audits.domain(store.read("silver_orders"), "order_status")
    assert all(r["is_upper"] for r in domain.collect())
    assert audits.distinct_count(store.read("gold_city_performance"), "city").first()[0] == 3


def test_reconciliation_sees_the_order_of_an_unknown_restaurant(run):
    store = run[1]
    sales = store.read("gold_daily_restaurant_sales")
    delivered = store.read("silver_orders").where("order_status = 'DELIVERED'")
    row = audits.reconcile(sales, sales.net_revenue, delivered, delivered.total_amount).first()
    assert (row["left_total"], row["right_total"], row["agrees"]) == (D("1100.50"), D("1111.50"), False)


def test_failed_layer_stops_the_run_and_keeps_later_tables(spark, tmp_path):
    raw = write_raw(tmp_path / "raw", "array")
    root = str(tmp_path / "warehouse")
    run_warehouse(spark, raw, root)
    store = TableStore(spark, root)
    before = store.current()
    broken = [{**ORDERS[0], "items": [{"item_id": None}]}]
    (tmp_path / "raw" / "orders.json").write_text(json.dumps(broken))
    with pytest.raises(ConstraintViolation, match="silver_order_items"):
        run_warehouse(spark, raw, root)
    after = store.current()
    # Orders and line items belong together: neither changed, nor did any mart.
    unchanged = {t for t in before if before[t] == after[t]}
    assert unchanged == {
        "silver_orders", "silver_order_items", "silver_payments", *schemas.GOLD
    }


def test_shuffle_partitions_follow_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with shuffles_for(spark, 10 * 1024**3):
        assert spark.conf.get(key) == "40"
    assert spark.conf.get(key, None) is None
    with shuffles_for(spark, 1024):
        assert spark.conf.get(key, None) is None
    with shuffles_for(spark, 100 * 1024**4):
        assert spark.conf.get(key) == "409600"
    with shuffles_for(spark, 100 * 1024**4, most=40_000):
        assert spark.conf.get(key) == "40000"


def test_compressed_lines_give_the_same_tables(run, spark, tmp_path):
    raw = write_raw(tmp_path / "raw", "lines")
    for entity in RAW:
        text = (tmp_path / "raw" / f"{entity}.jsonl").read_text()
        (tmp_path / "raw" / f"{entity}.jsonl").unlink()
        (tmp_path / "raw" / f"{entity}.jsonl").mkdir()
        for number, line in enumerate(text.splitlines()):
            with gzip.open(tmp_path / "raw" / f"{entity}.jsonl" / f"part-{number}.txt.gz", "wt") as file:
                file.write(line + "\n")
    store = TableStore(spark, str(tmp_path / "warehouse"))
    run_warehouse(spark, raw, store.root, "lines")
    for table in (*schemas.SILVER, *schemas.GOLD):
        assert dicts(store.read(table)) == dicts(run[1].read(table)), table


def test_text_of_compressed_files_decides_on_splits_and_shuffles(spark, tmp_path):
    assert raw_json.sizes(spark, str(tmp_path / "none")) == (0, 0)
    (tmp_path / "raw" / "a").mkdir(parents=True)
    assert raw_json.sizes(spark, str(tmp_path / "raw")) == (0, 0)
    (tmp_path / "raw" / "a" / "part-1.txt.gz").write_bytes(b"x" * 10)
    (tmp_path / "raw" / "b.jsonl").write_bytes(b"x" * 5)
    assert raw_json.sizes(spark, str(tmp_path / "raw")) == (15, 10 * raw_json.EXPANSION + 5)
    key, mb = "spark.sql.files.maxPartitionBytes", 1024**2
    before = spark.conf.get(key)
    with settings(spark, {key: "128m"}):
        assert splits_of_text(spark, 1) == splits_of_text(spark, 0) == {key: str(128 * mb)}
        assert splits_of_text(spark, 8) == {key: str(16 * mb)}
        assert splits_of_text(spark, 1000) == {key: str(4 * mb)}
    with settings(spark, {key: "1m"}):  # never above the session's own
        assert splits_of_text(spark, 8) == {key: str(mb)}
    assert spark.conf.get(key) == before


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {n for folder in folders for _, _, names in os.walk(folder) for n in names if n.startswith("shuffle_")}


@pytest.mark.parametrize("layout,bucket_bytes", [("lines", None), ("lines", 0), ("array", 0)])
def test_a_run_leaves_no_shuffle_files(spark, tmp_path, layout, bucket_bytes):
    before = shuffle_files(spark)
    raw = write_raw(tmp_path / "raw", layout)
    run_warehouse(spark, raw, str(tmp_path / "warehouse"), layout, bucket_bytes=bucket_bytes)
    until = time.monotonic() + 10
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)  # they are removed in the background
    assert not left
    assert spark.conf.get(*CLEANUP, None) is None  # callers may run a plan again


def test_audit_of_the_warehouse(run):
    rows = {(r.audit, r.table_name, r.subject): r.found for r in audit_warehouse(run[1]).collect()}
    found = {k: n for k, n in rows.items() if n and k[0] != "rows"}
    assert found == {
        ("orphans", "silver_orders", "restaurant_id"): 1,
    }
    assert rows["rows", "gold_city_performance", "*"] == 3
    assert {k[0] for k in rows} == {
        "rows", "nulls", "empty_keys", "duplicate_keys", "orphans", "non_positive", "not_upper",
        "reconciliation",
    }


def test_users_and_totals_are_joined_once(run, spark):
    """The gold job stores the joined totals; both marts start from them."""
    store = run[1]
    users, orders = store.read("silver_users"), store.read("silver_orders")
    with store.scratch(marts.user_totals(users, orders)) as totals:
        for mart in (
            marts.user_analytics(totals),
            marts.city_performance(totals, store.read("silver_restaurants"), store.read("silver_drivers")),
        ):
            assert "Join" not in mart._jdf.queryExecution().executedPlan().toString()


def test_jobs_do_not_rely_on_the_session(spark, tmp_path):
    raw = write_raw(tmp_path / "raw", "array")
    item = '{"item_id": "i1", "quantity": 1, "quantity": 2, "unit_price": 3}'
    text = json.dumps([{**ORDERS[0], "items": []}]).replace('"items": []', f'"items": [{item}]')
    (tmp_path / "raw" / "orders.json").write_text(text)
    keys = {"spark.sql.variant.allowDuplicateKeys": "false", "spark.sql.ansi.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        run_warehouse(spark, raw, str(tmp_path / "warehouse"))
        assert {k: spark.conf.get(k) for k in keys} == keys
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    items = TableStore(spark, str(tmp_path / "warehouse")).read("silver_order_items")
    assert [(r["quantity"], r["total_price"]) for r in items.collect()] == [(2, 6)]


def shuffles(df):
    """Columns by which a plan shuffles rows."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"hashpartitioning\(([^)]*)\)", plan)


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bucketed")
    root = str(folder / "warehouse")
    raw = write_raw(folder / "raw", "lines")
    summary = run_warehouse(spark, raw, root, "lines", bucket_bytes=0)
    return summary, TableStore(spark, root), raw


def test_bucketed_run_gives_the_same_tables(run, bucketed):
    assert bucketed[0]["silver"] == run[0]["silver"]
    for table in (*schemas.SILVER, *schemas.GOLD):
        assert dicts(bucketed[1].read(table)) == dicts(run[1].read(table)), table
        assert bucketed[1].versions()[table].digest == run[1].versions()[table].digest, table


def test_keys_and_references_of_buckets_need_no_shuffle(spark, bucketed):
    store = bucketed[1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for table in schemas.SILVER:
            keys = schemas.PRIMARY_KEYS[table]
            assert not shuffles(audits.duplicate_keys(store.read(table), keys)), table
        items, orders, users = (store.read(f"silver_{t}") for t in ("order_items", "orders", "users"))
        assert not shuffles(audits.orphans(items, "order_id", orders, "order_id"))
        # Only the orders' totals are shuffled, not the users they are joined to.
        assert len(shuffles(marts.user_totals(users, orders))) == 1
        assert len(shuffles(audits.orphans(orders, "user_id", users, "user_id"))) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_audit_takes_rows_from_the_manifest(bucketed):
    store = bucketed[1]
    known, counted = (
        {(r.audit, r.table_name, r.subject): r.found for r in audit_warehouse(store, recount).collect()}
        for recount in (False, True)
    )
    assert known == counted
    plan = audit_warehouse(store)._jdf.queryExecution().executedPlan().toString()
    assert "bronze_" not in re.sub(r"LocalTableScan.*", "", plan)


def orders_of(amounts):
    return [{**order(1, "u1", "delivered", a), "order_id": f"o{i}", "items": [],
             "order_timestamp": f"2024-02-{i + 1:02d}T12:00:00Z"} for i, a in enumerate(amounts)]


def test_reconciliation_of_many_rounded_days(spark, tmp_path):
    """28 days of 1.0040 are 28.00 in the mart and 28.1120 in the orders: rounding, not an error."""
    raw = write_raw(tmp_path / "raw", "lines")
    lines = "\n".join(json.dumps(o) for o in orders_of([1.0040] * 28))
    (tmp_path / "raw" / "orders.jsonl").write_text(lines)
    store = TableStore(spark, str(tmp_path / "warehouse"))
    run_warehouse(spark, raw, store.root, "lines")
    assert reconciled(store) == {
        "gold_daily_restaurant_sales": 0, "gold_user_analytics": 0, "gold_city_performance": 0, "gold_driver_metrics": 0,
    }
    sales = store.read("gold_daily_restaurant_sales", schemas.RESIDUAL)
    assert sales.agg({"net_revenue": "sum"}).first()[0] == 28 and sales.agg({"residual": "sum"}).first()[0] == D("0.1120")
    # A mart that has lost a cent, and one that has lost less.
    for lost, cents in (("0.0100", 1), ("0.0030", 1), ("0.0101", 2)):
        less = F.when(F.col("order_date") == "2024-02-03", F.lit(D(lost))).otherwise(0)
        short = sales.withColumn("residual", (F.col("residual") - less).cast("decimal(18,4)"))
        store.publish(store.stage("gold_daily_restaurant_sales", short, extra=("residual",)))
        assert reconciled(store)["gold_daily_restaurant_sales"] == cents
        store.publish(store.stage("gold_daily_restaurant_sales", sales, extra=("residual",)))


def reconciled(store):
    return {r.table_name: r.found for r in audit_warehouse(store).where("audit = 'reconciliation'").collect()}


@pytest.mark.parametrize("entity, field, column", [("orders", "total_amount", "total_amount"), ("users", "email", "email")])
def test_refused_load_names_its_records(spark, tmp_path, entity, field, column):
    raw = write_raw(tmp_path / "raw", "lines")
    records = [dict(r) for r in RAW[entity]]
    records[1][field] = None if entity == "users" else "much"
    (tmp_path / "raw" / f"{entity}.jsonl").write_text("\n".join(map(json.dumps, records)))
    store = TableStore(spark, str(tmp_path / "warehouse"))
    with pytest.raises(ConstraintViolation, match=f"{column}.*record_key") as caught:
        run_warehouse(spark, raw, store.root, "lines")
    row = store.read_refused(caught.value).first()
    assert row.reasons == [column]
    key = schemas.ENTITIES[entity]
    assert row.record_key == records[1][key] and row.record_id.path.endswith(f"/{entity}.jsonl")
    bronze = store.read(f"bronze_{entity}")
    found = bronze.where(F.col("record_id.row") == row.record_id.row).select("raw_json").first()[0]
    assert json.loads(found)[field] == records[1][field]
    assert store.read(f"silver_{entity}").count() == 0


@pytest.mark.parametrize("layout", ["array", "lines"])
@pytest.mark.parametrize("rule, name", [("number", "number 11"), ("path", "number 9"), ("time", "number 4")])
def test_files_arrive_by_a_declared_rule(spark, tmp_path, layout, rule, name):
    raw = tmp_path / "raw"
    write_raw(raw, layout)
    suffix = {"array": "json", "lines": "jsonl"}[layout]
    (raw / f"users.{suffix}").unlink()
    folder = raw / f"users.{suffix}"
    folder.mkdir()
    for n in range(1, 12):
        record = {**USERS[1], "full_name": f"number {n}"}
        text = json.dumps([record] if layout == "array" else record)
        (folder / f"part-{n}").write_text(text)
        os.utime(folder / f"part-{n}", (1_700_000_000 + (n * 3) % 13,) * 2)
    root = str(tmp_path / "warehouse")
    run_warehouse(spark, str(raw), root, layout, file_order=rule)
    assert [r.full_name for r in TableStore(spark, root).read("silver_users").collect()] == [name]


def test_numbers_in_paths_compare_as_numbers(spark):
    paths = ["a/part-9", "a/part-10", "a/part-2.json", "b1/x", "b/2", "a/part-0010", "é7", "a/part-99999999999999999999999"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    ordered = [r.path for r in df.orderBy(raw_json.by_number(F.col("path")), "path").collect()]
    assert ordered == [
        "a/part-2.json", "a/part-9", "a/part-0010", "a/part-10", "a/part-99999999999999999999999", "b/2", "b1/x", "é7",
    ]
