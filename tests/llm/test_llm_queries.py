"""The registered queries against SQL and plain versions on the given tables."""

import __spark_entry__ as entry
import pytest
from checks.compare import connect, mismatch
from plain import base_licences, simhash

from tierlake.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_result_equals_the_sql_twin(spark, sf_dir, name):
    assert mismatch(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and {*QUERIES, "pipeline"} <= set(entry.queries())


def test_base_licences_of_the_documents(spark, sf_dir):
    texts = dict(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    for r in QUERIES["op1_licences"](spark, sf_dir).collect():
        n, found = base_licences(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(found), ",".join(sorted({x for _, x in found})))


def test_languages_of_held_out_documents(spark, sf_dir):
    labels = dict(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()))
    rows = [r for r in QUERIES["op8_language_id"](spark, sf_dir).collect() if r.held_out]
    assert sum(r.lang_pred == labels[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_fingerprints_of_the_documents(spark, sf_dir):
    texts = dict(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    for r in QUERIES["op9_simhash"](spark, sf_dir).collect():
        assert r.fingerprint == format(simhash(texts[r.doc_id]), "016x")
