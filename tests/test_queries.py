import gzip
import os
import re
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from checks import cleaning_queries, file_queries
from checks.catalog import ORACLES, QUERIES
from checks.compare import connect, mismatch



@pytest.fixture(scope="module")
def duckdb(sf_dir):
    return connect(sf_dir)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_an_sql_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_result_equals_the_sql_twin(spark, sf_dir, duckdb, name):
    assert mismatch(QUERIES[name](spark, sf_dir), duckdb, ORACLES[name]) is None


@pytest.mark.parametrize("name", QUERIES)
def test_plan_stays_in_the_engine(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Python|Pandas|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("name", [
    "silver_users", "silver_orders", "silver_payments", "json_repeated_member",
])
def test_records_are_parsed_once(spark, sf_dir, name):
    assert plan_of(QUERIES[name](spark, sf_dir)).count("from_json(") == 1


def test_array_texts_are_parsed_once(spark, sf_dir):
    """Once for the array, once for the records in it; the third reads the result back."""
    assert plan_of(QUERIES["bronze_array_scan"](spark, sf_dir)).count("from_json(") == 3


@pytest.mark.parametrize("name", ["raw_to_user_ltv", "raw_to_daily_sales"])
def test_raw_records_are_parsed_once_per_table(spark, sf_dir, name):
    assert plan_of(QUERIES[name](spark, sf_dir)).count("from_json(") == 2


@pytest.mark.parametrize("name", ["daily_sales", "user_ltv", "driver_metrics", "city_performance"])
def test_orders_are_reduced_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for shuffle in re.finditer(r"Exchange hashpartitioning.*\n.*\n", plan):
        assert "partial_" in shuffle.group()


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(QUERIES["driver_metrics"](spark, sf_dir))
    scan = re.search(r"ReadSchema: struct<(l_[^>]*)>", plan.replace("...", "")).group(1)
    assert {c.split(":")[0] for c in scan.split(",")} == {
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag"
    }


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "order_date"


@pytest.mark.parametrize("module", ["xxhash", "tiktoken", "public_tokenizers", "ahocorasick", "tierlake.llm", "corpus_pipeline"])
def test_other_queries_need_no_training_data_part(module):
    """Each library that only the training-data operators use, and these themselves, may be missing."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = (
        f"import sys; sys.modules[{module!r}] = None; import __spark_entry__ as e;"
        " from checks.catalog import QUERIES as q; assert set(e.queries()) == set(q) == set(e.oracle_sql())"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_rows_are_ranged_before_records_are_made(spark, sf_dir):
    for records in cleaning_queries.RAW_ENTITIES.values():
        above, _, below = plan_of(records(spark, sf_dir, ranged=True)).partition("rangepartitioning")
        assert "concat_ws(" in above and "concat_ws(" not in below


def test_raw_lines_are_in_order_of_arrival(spark, sf_dir, tmp_path):
    file_queries._raw_lines(spark, sf_dir, str(tmp_path))
    for entity, records in cleaning_queries.RAW_ENTITIES.items():
        files = sorted((tmp_path / "raw" / f"{entity}.jsonl").glob("part-*"))
        texts = [line for f in files for line in f.read_text().splitlines()]
        assert texts == [r.raw_json for r in records(spark, sf_dir).orderBy("record_id").collect()]


def test_packed_raw_lines_are_the_same_lines(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(file_queries, "FILE_RECORDS", 100)
    file_queries._raw_lines(spark, sf_dir, str(tmp_path), packed=True)
    for entity, records in cleaning_queries.RAW_ENTITIES.items():
        files = sorted((tmp_path / "raw" / f"{entity}.jsonl").glob("part-*"))
        texts = [gzip.open(f, "rt").read().splitlines() for f in files]
        assert max(map(len, texts)) <= 100
        lines = [line for text in texts for line in text]
        assert lines == [r.raw_json for r in records(spark, sf_dir).orderBy("record_id").collect()]
        if len(lines) > 500:
            assert sum(f.stat().st_size for f in files) < sum(map(len, lines)) / 3


def test_a_rerun_packs_its_raw_lines(spark, sf_dir, tmp_path, monkeypatch):
    """Beside them lie the tables of three runs."""
    monkeypatch.setattr(file_queries, "_folder", lambda spark: str(tmp_path))
    QUERIES["warehouse_rerun"](spark, sf_dir)
    for entity in cleaning_queries.RAW_ENTITIES:
        assert {f.suffix for f in (tmp_path / "raw" / f"{entity}.jsonl").glob("part-*")} == {".gz"}
