import random

from pyspark.sql import functions as F

from tests.conftest import dicts
from tierlake.operators.dedup import keep_first, keep_latest

ROWS = [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 5, "p"), ("", 4, "q")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, n long, v string")


def test_latest_and_first(spark):
    df = frame(spark, ROWS)
    assert {r["k"]: r["v"] for r in dicts(keep_latest(df, ["k"], ["n"]))} == {
        "a": "y", "b": "p", "": "q"
    }
    assert {r["k"]: r["v"] for r in dicts(keep_first(df, ["k"], ["n"]))}["a"] == "x"


def test_result_does_not_depend_on_the_order_of_rows(spark):
    rows = [(f"k{i % 7}", i, str(i)) for i in range(200)]
    expected = dicts(keep_latest(frame(spark, rows), ["k"], ["n"]))
    random.Random(1).shuffle(rows)
    shuffled = frame(spark, rows).repartition(5)
    assert dicts(keep_latest(shuffled, ["k"], ["n"])) == expected


def test_hot_key_is_cut_before_the_shuffle(spark):
    # A third of all rows share one key.
    n = 90_000
    key = F.when(F.col("id") < n // 3, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("n"))
    latest = keep_latest(df, ["k"], ["n"])
    assert latest.count() == n - n // 3 + 1
    assert latest.where("k = 'hot'").first()["n"] == n // 3 - 1
    plan = latest._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[shuffle:] and "WindowGroupLimit" in plan[shuffle:]
