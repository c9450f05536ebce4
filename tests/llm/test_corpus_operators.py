"""Top-k, WARC, packing, near-duplicates, passages and the pipeline against plain versions."""

import gzip
import io
import math
import random
import zlib
from fractions import Fraction

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash
from plain import digest, groups, remove_repeats, sequences, simhash as plain_simhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierlake.llm import components, packing, queries, simhash, substrings, topk, warc

BPE = public_tokenizers.path("byte_bpe_50k.json")


def prose(seed, words=60, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


@pytest.fixture
def docs(spark):
    """Copies, near copies, shared passages, short, empty and null texts; extra columns."""
    base, passage = prose(1, 300), prose(2, 50)
    rows = [(i, prose(i)) for i in range(10, 40)]
    rows += [(50, base), (51, base), (52, base.replace("w1 ", "zz ", 1)), (53, base + " end")]
    rows += [(60 + i, f"{prose(100 + i, 30)} {passage} {prose(200 + i, 30)}") for i in range(8)]
    rows += [(70, "a b"), (71, ""), (72, None), (73, " \t\n"), (74, "x " * 500), (75, "a  b"), (76, "A B")]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"fp": F.lit("f"), "key": F.lit(1), "row": F.lit(2.0), "hash": F.lit(None)}).repartition(3)


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


# -- top-k -------------------------------------------------------------------------


def best(vectors, k, every):
    out = []
    for q, (key, v) in enumerate(vectors):
        if key % every:
            continue
        scores = [(-int(np.dot(v, w)), other) for i, (other, w) in enumerate(vectors) if i != q]
        out += [(key, r + 1, other, -s) for r, (s, other) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("n, block", [(300, 64), (40, 8192), (7, 64)])
def test_top_k_is_exact(spark, monkeypatch, n, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    r = np.random.default_rng(n)
    x = r.normal(size=(n, 12)).astype(np.float32)
    x[1:n // 3] = x[0]  # ties, also at the end of the list
    rows = [(i, v.tolist(), "z") for i, v in enumerate(x)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string"), k=10, every=5)
    whole = [(i, np.floor(1024 * v.astype(float)).astype(int)) for i, v in enumerate(x)]
    assert sorted(map(tuple, found.collect())) == best(whole, 10, 5)


def test_top_k_leaves_out_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, None), (4, [None, 1.0]), (5, [3.0, -1.0]), (100, [0.0, 0.0]), (100, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, k=10, every=100)
    one = 1024 * 1024
    assert sorted(map(tuple, found.collect())) == sorted([
        (0, 1, 100, 3 * one), (0, 2, 5, one), (0, 3, 100, 0),
        (100, 1, 0, 3 * one), (100, 2, 5, 2 * one), (100, 3, 100, 0),
        (100, 1, 0, 0), (100, 2, 5, 0), (100, 3, 100, 0),
    ])
    assert topk.top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("large", [20000.0, 3e7, 1e15, 1e300])
def test_top_k_of_large_components(spark, large):
    """Against exact whole numbers; a score that a long can't hold is null, its rank counts it."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 5)).round(3)
    x[::7] *= large
    x[14:30:3] = x[14]
    rows = [(i, v.tolist(), 1, "y", 2.0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, part string, score double")
    whole = [(i, [math.floor(Fraction(1024) * Fraction(c)) for c in v.tolist()]) for i, v in enumerate(x)]
    expected = []
    for i, q in whole[::10]:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in whole if j != i)
        expected += [(i, r + 1, j, -s if -(1 << 63) <= -s < 1 << 63 else None) for r, (s, j) in enumerate(scored[:10])]
    assert sorted(map(tuple, topk.top_k(df, k=10, every=10).collect())) == sorted(expected)


def test_order_of_scores_beyond_a_long():
    scores = [1 << 63, 10**20, 10**40, 3 * 10**20, -(10**20), -(10**40), -(3 * 10**20), -(1 << 70)]
    for own in ([s for s in scores if s > 0], [s for s in scores if s < 0]):
        assert sorted(own, key=topk.order_of) == sorted(own)


def test_one_result_per_query_leaves_a_group(spark, monkeypatch):
    """Small blocks: each group of blocks gives k rows per query, however many blocks it has."""
    rng = np.random.default_rng(8)
    x = rng.integers(-9, 9, (200, 3))
    found = None
    for first in range(0, 200, 20):
        block = topk._block(np.arange(first, first + 20), np.zeros(20, bool), x[first:first + 20] * 1.0, 1)
        own = np.array([q - first if first <= q < first + 20 else -1 for q in (0, 100)])
        new = topk.search_block(block, x[[0, 100]], own, 4)
        found = new if found is None else topk.best_of(found, new, 4)
    whole = [(i, v) for i, v in enumerate(x)]
    rows = [(int((0, 100)[w]), int(i), int(s)) for w, i, s in zip(found[0], found[1], found[3], strict=True)]
    assert rows == [(q, j, s) for q, _, j, s in best(whole, 4, 100)]


# -- WARC --------------------------------------------------------------------------


def test_pages_come_back_deduplicated(spark):
    html = ["<p>a</p>", None, "", "<p>a</p>", "x\r\n\r\nWARC/1.1\r\ny", "<p>a</p>", "é" * 70000, "<p>a</p>"]
    keys = [4, 9, 8, 2, 1, None, 3, 2]
    rows = [(k, None if i % 2 else f"http://u/{i}\n", h, "x") for i, (k, h) in enumerate(zip(keys, html, strict=True))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, file string")
    found = sorted(map(tuple, warc.deduplicated_pages(pages).collect()), key=str)
    raw = [(h or "").encode() for h in html]
    first = {9: 8, 4: 2, None: 2}
    expected, seen_two = [], False
    for key, payload in zip(keys, raw, strict=True):
        original = first.get(key)
        if key == 2:
            original, seen_two = (2 if seen_two else None), True
        kind = "response" if original is None else "revisit"
        expected.append((key, len(payload), digest(payload), kind, original))
    assert found == sorted(expected, key=str)
    assert warc.deduplicated_pages(pages.limit(0)).count() == 0


def test_small_payloads_are_kept(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long"), (4, "u", "long")], "page_id long, url string, html string")
    kinds = {r.page_id: r.record_type for r in warc.deduplicated_pages(pages, min_bytes=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_existing_revisits_refer_to_the_original(spark, tmp_path):
    rows = [("a", "u1", "body", 4, None), ("b", "u2", None, 4, "gone"), ("c", "u3", "body", 4, None), ("d", "u4", None, 9, "lost")]
    df = spark.createDataFrame(rows, "record_id string, target_uri string, payload string, payload_bytes int, refers_to string")
    same = F.when(F.col("record_id") != "d", warc.payload_digest(F.lit("body"))).otherwise("OTHER")
    warc.write_archive(df.withColumn("payload_digest", same).withColumn("refers_to_uri", F.lit(None).cast("string")), f"{tmp_path}/in")
    warc.resolve_revisits(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    found = {r.record_id: r for r in warc.read_archive(spark, f"{tmp_path}/out").collect()}
    assert {k: r.refers_to for k, r in found.items()} == {"a": None, "b": "a", "c": "a", "d": "lost"}
    assert bytes(found["a"].payload) == b"body" and found["c"].payload is None and found["c"].payload_bytes == 4


def record(kind, record_id, block, *lines):
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", "WARC-Date: 2019-05-04T03:02:01Z", *lines]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def test_archives_of_others_lose_nothing(spark, tmp_path):
    """Other kinds of records, HTTP heads, dates, ids, several fields of a name, blocks that are no HTTP."""
    http = "Content-Type: application/http; msgtype=response"
    image = b"HTTP/1.1 404 Not Found\r\nContent-Type: image/png\r\nX-Own: 1\r\nContent-Length: 4\r\n\r\n\x89P\xff\x00"
    get = b"GET /a HTTP/1.1\r\nHost: u\r\n\r\n"
    written = [
        record("warcinfo", "urn:uuid:0", b"software: x\r\n", "Content-Type: application/warc-fields", "WARC-Filename: f"),
        record("request", "urn:uuid:1", get, "WARC-Target-URI: http://u/a", "Content-Type: application/http; msgtype=request"),
        record("response", "urn:uuid:2", image, "WARC-Target-URI: http://u/a", http, "WARC-IP-Address: 1.2.3.4",
               "WARC-Concurrent-To: <urn:uuid:1>", "WARC-Concurrent-To: <urn:uuid:0>", "WARC-Block-Digest: sha1:X"),
        record("response", "urn:uuid:3", image, "WARC-Target-URI: http://u/b", http),
        record("response", "urn:uuid:4", b"20190504 u. IN A 1.2.3.4", "WARC-Target-URI: dns:u", "Content-Type: text/dns"),
        record("revisit", "urn:uuid:5", b"HTTP/1.1 304 Not Modified\r\nETag: e\r\n\r\n", "WARC-Target-URI: http://u/c", http,
               "WARC-Profile: http://p/server-not-modified", "WARC-Refers-To: <urn:uuid:99>", "WARC-Refers-To-Target-URI: http://old"),
        record("metadata", "urn:uuid:6", b"", "Content-Type: text/plain"),
    ]
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, written)))  # a member per record
    warc.resolve_revisits(spark, str(source), str(target))
    found = {}
    for file in target.glob("part-*"):
        with gzip.open(file) as stream:
            for fields, head, payload in warc.parse(stream):
                found[fields["warc-record-id"].strip("<>")[-1]] = (fields, head, payload)
    before = {}
    for fields, head, payload in warc.parse(io.BytesIO(b"".join(written))):
        before[fields["warc-record-id"].strip("<>")[-1]] = (fields, head, payload)
    assert found.keys() == before.keys() == set("0123456")
    for key, (fields, head, payload) in found.items():
        old = before[key]
        assert (head, payload) == (old[1], b"" if key == "3" else old[2])
        changed = {"content-length", "warc-type", "warc-payload-digest", "warc-block-digest", "warc-profile", "warc-refers-to", "warc-refers-to-target-uri"}
        assert {k: v for k, v in fields.items() if k not in changed} == {k: v for k, v in old[0].items() if k not in changed}
        if key in "0156":
            assert {k: v for k, v in fields.items() if k != "content-length"} == {k: v for k, v in old[0].items() if k != "content-length"}
    assert found["3"][0]["warc-type"] == "revisit" and found["3"][0]["warc-refers-to"] == "<urn:uuid:2>"
    assert found["3"][0]["warc-refers-to-target-uri"] == "http://u/a"
    warc.resolve_revisits(spark, str(target), f"{tmp_path}/again")
    rows = {r.record_id: r for r in warc.read_archive(spark, f"{tmp_path}/again", whole=True).collect()}
    assert len(rows) == 7 and rows["urn:uuid:3"].refers_to == "urn:uuid:2" and rows["urn:uuid:3"].payload_bytes == 4


@pytest.mark.parametrize("name", ["a.warc", "a.warc.gz"])
def test_files_are_streams(spark, tmp_path, name):
    """Blocks full of line breaks, around the ends of buffers and of splits, come back to the byte."""
    r = random.Random(7)
    blocks = [bytes(r.choices(b"\r\n\r\nab\xff", k=r.choice((0, 1, 5, 900, 65536, 131071)))) for _ in range(60)]
    blocks += [b"\r\n\r\n", b"x\r\n\r\n", b"\r\n\r", b"WARC/1.1\r\n\r\n" * 9, b"y" * 300_000 + b"\r\n\r"]
    for folder in ("1", "2"):
        written = [record("resource", f"urn:x:{folder}:{i}", x, "Content-Type: text/plain") for i, x in enumerate(blocks)]
        data = b"".join(map(gzip.compress, written) if name.endswith("gz") else written)
        (tmp_path / folder).mkdir()
        (tmp_path / folder / name).write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        found = warc.read_archive(spark, f"{tmp_path}/*", whole=True).select("file", "ordinal", "record_id", "payload").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({x.file for x in found}) == 2
    expected = [(i, f"urn:x:{folder}:{i}", x) for folder in ("1", "2") for i, x in enumerate(blocks)]
    assert sorted((x.ordinal, x.record_id, bytes(x.payload)) for x in found) == sorted(expected)
    assert warc.read_archive(spark, f"{tmp_path}/*").count() == 0


def test_a_cut_archive_is_refused(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record("response", "urn:x:1", b"z" * 99)[:-30])
    with pytest.raises(Exception, match="ends before its length"):
        warc.read_archive(spark, str(tmp_path)).collect()


# -- packing -----------------------------------------------------------------------


def test_shortest_pack_first_uses_every_length():
    r = random.Random(4)
    histogram = {length: r.randrange(1, 50) for length in r.sample(range(1, 101), 40)}
    patterns = packing.shortest_pack_first(histogram, 100)
    used = {}
    for n, lengths in patterns:
        assert sum(lengths) <= 100
        for length in lengths:
            used[length] = used.get(length, 0) + n
    assert used == histogram
    assert packing.shortest_pack_first({}, 100) == []


@pytest.mark.parametrize("size", [16, 1024])
def test_pieces_cover_every_document(spark, docs, size):
    docs = docs.unionByName(docs.limit(0)).union(docs.where("doc_id = 70").withColumn("doc_id", F.lit(None)))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    library = Tokenizer.from_file(BPE)
    ids = {k: library.encode(t, add_special_tokens=False).ids + [0] for k, t in texts.items()}
    pieces = packing.pack(docs, BPE, size=size).collect()
    for p in pieces:
        own = np.array(ids[p.doc_id][p.start:p.start + p.length], "<u4").tobytes()
        assert (p.ids_crc32, bytes(p.ids), p.doc_tokens) == (zlib.crc32(own), own, len(ids[p.doc_id]))
    total = sum(len(i) for i in ids.values())
    assert sum(p.length for p in pieces) == total
    packs = sequences([(p.sequence_id, p.offset, p.length) for p in pieces])
    for own in packs.values():
        assert [p[1] for p in own] == [sum(q[2] for q in own[:i]) for i in range(len(own))]
        assert sum(p[2] for p in own) <= size
    assert len(packs) * size < 1.3 * total + size
    assert packing.pack(docs.limit(0), BPE).count() == 0


# -- near-duplicates ---------------------------------------------------------------


def expected_components(rows):
    rows = list(rows)
    prints = [plain_simhash(r.text) for r in rows]
    group = groups(prints)
    smallest = {}
    for r, g in zip(rows, group, strict=True):
        if r.doc_id is not None:
            smallest[g] = min(smallest.get(g, r.doc_id), r.doc_id)
    return [(r.doc_id, format(p, "016x"), smallest.get(g)) for r, p, g in zip(rows, prints, group, strict=True)]


def test_simhash_components(docs):
    odd = docs.union(docs.where("doc_id in (50, 71)")).union(docs.where("doc_id = 52").withColumn("doc_id", F.lit(None)))
    found = simhash.groups(odd).select("key", simhash.fp_hex(F.col("fp")), "component_id").collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected_components(odd.collect()), key=str)
    assert simhash.groups(docs.limit(0)).count() == 0


def test_simhash_of_a_very_long_text(monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 1000)
    texts = [prose(1, 7000, 9000), None, prose(2, 3), prose(3, 1500)]
    assert simhash.fingerprint(texts).tolist() == [plain_simhash(t) for t in texts]


def test_one_document_of_each_component_stays(docs):
    odd = docs.union(docs.where("doc_id in (50, 71)")).union(docs.where("doc_id = 30").withColumn("doc_id", F.lit(None)))
    kept = simhash.one_of_each(odd)
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted({c for _, _, c in expected_components(odd.collect())})
    assert kept.columns == docs.columns


@pytest.mark.parametrize("distance, block, spread", [(4, 4096, 64), (4, 50, 10), (2, 30, 14), (0, 4096, 5)])
def test_gray_index_finds_every_link(spark, monkeypatch, distance, block, spread):
    """Dense and sparse patterns, in one block and in many."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(distance + block)
    centres = [r.getrandbits(64) for _ in range(12)]
    prints = {c ^ sum(1 << b for b in r.sample(range(spread), r.randrange(6 if spread > 5 else 1))) for c in centres for _ in range(40)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), distance)
    root = {n: t for n, t in components.components(links).collect()}
    label = [root.get(p, p) for p, in signed]
    group = groups(prints, distance)
    assert len(set(zip(label, group, strict=True))) == len(set(label)) == len(set(group))


def test_wider_masks_still_meet():
    r = random.Random(9)
    for distinct in (10, 10**7, 10**9):
        masks = simhash.segment_masks(distinct, 4)
        for _ in range(300):
            difference = sum(1 << b for b in r.sample(range(64), 4))
            assert any(not difference & m for m in masks)


def test_components_of_long_chains(spark):
    chain = list(range(0, 400, 2))
    random.Random(1).shuffle(chain)
    links = list(zip(chain, chain[1:], strict=False)) + [(1, 3), (3, 3), (1, 3), (7, 5)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(found[c] == 0 for c in chain) and (found[1], found[3], found[5], found[7]) == (1, 1, 5, 5)


# -- passages ----------------------------------------------------------------------


@pytest.mark.parametrize("width, combine, bucket", [(20, 1 << 24, 1 << 22), (5, 100, 200), (1, 1 << 24, 1 << 22)])
def test_repeated_words_go(docs, monkeypatch, width, combine, bucket):
    monkeypatch.setattr(substrings, "COMBINE", combine)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(substrings, "STRETCH", 7)
    expected = remove_repeats([(r.doc_id, r.text) for r in docs.collect()], width)
    found = substrings.remove_repeats(docs, width)
    assert found.count() == docs.count()
    for r in found.collect():
        words, kept = expected[r["row"]["doc_id"]]
        assert (r.n_words, r.n_removed, r.kept) == (len(words), len(words) - len(kept), " ".join(kept))


def test_passages_of_odd_tables(docs, spark):
    assert substrings.remove_repeats(docs.limit(0)).count() == 0
    text = prose(5, 40)
    rows = [(None, text), (3, text), (3, text), (3, "other " + text), (9, text)]
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = sorted((str(r["row"]["doc_id"]), r["row"]["text"][:5] == "other", r.n_removed) for r in found)
    # Equal rows are one document; of one key, the smaller hash of the text comes first.
    assert left[-1] == ("None", False, 40) and ("9", False, 40) in left
    assert [x[2] for x in left if x[:2] == ("3", False)] in ([0, 0], [40, 40])
    assert [x[2] for x in left if x[:2] == ("3", True)] in ([0], [40])


@pytest.mark.parametrize("combine, parts", [(1 << 24, 1), (100, 1), (100, 5)])
def test_repeated_rows_keep_their_first_passage(spark, monkeypatch, combine, parts):
    """Exactly the removals of the table without its repeated rows."""
    monkeypatch.setattr(substrings, "COMBINE", combine)
    text, passage = prose(5, 400), prose(6, 60)
    once = [(3, text), (4, f"{prose(7, 50)} {passage}"), (5, f"{passage} {prose(8, 30)}"), (6, text + " end"), (7, prose(9, 90) + " " + passage + " x " + passage)]
    last = (10, f"{prose(11, 25)} {text}")  # stands for the null key, which comes last
    expected = remove_repeats([*once, last])
    rows = [*once, (None, last[1])] * 3 + [once[0]] * 20
    random.Random(2).shuffle(rows)
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    assert len(found) == len(rows)
    for r in found:
        words, kept = expected[r["row"]["doc_id"] or 10]
        assert (r.n_words, r.kept) == (len(words), " ".join(kept))


def test_passages_of_very_long_texts(spark):
    """Texts of many batches, one of a single word, one that repeats itself."""
    once = prose(6, 40_000, 30_000)
    rows = [(1, once), (2, "a " * 100_000), (3, f"x {once[:100_000]} y"), (4, "b" * 200_000)]
    expected = remove_repeats(rows)
    for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        words, kept = expected[r["row"]["doc_id"]]
        assert (r.n_words, r.kept) == (len(words), " ".join(kept))


def test_frequent_words_change_nothing(docs, monkeypatch):
    expected = {r["row"]["doc_id"]: r.kept_sha256 for r in substrings.remove_repeats(docs).collect()}
    often = np.sort(np.array([xxhash.xxh64_intdigest(f"w{i}".encode()) for i in range(0, 400, 2)], np.uint64))
    monkeypatch.setattr(substrings, "frequent_words", lambda texts, parts: (often, 10_000))
    assert {r["row"]["doc_id"]: r.kept_sha256 for r in substrings.remove_repeats(docs).collect()} == expected


@pytest.mark.parametrize("parts", [200, 10_000, 100_000])
def test_no_bucket_gathers_windows_of_frequent_words(parts):
    """Zipf text: the windows that one pair of minimisers draws are no more than a partition's share."""
    rng = np.random.default_rng(parts)
    n, vocabulary = 1_000_000, 200_000
    share = 1 / np.arange(1, vocabulary + 1)
    words = rng.choice(vocabulary, size=n, p=share / share.sum())
    hashes = rng.integers(0, 2**64, vocabulary, dtype=np.uint64)
    counts = np.bincount(words, minlength=vocabulary)
    often = np.flatnonzero(counts >= max(2, n * substrings.FREQUENT / parts))
    frequent = hashes[often][np.lexsort((hashes[often], counts[often]))]
    keys = substrings.minimisers(substrings.ranks(hashes[words], frequent), 20)
    assert np.unique(keys, return_counts=True)[1].max() <= max(20, 2 * len(keys) / parts)


def test_equal_windows_have_equal_minimisers():
    rng = np.random.default_rng(4)
    rank = substrings.ranks(rng.choice(np.arange(9, dtype=np.uint64), 3000), np.arange(9, dtype=np.uint64))
    seen = {}
    for i, key in enumerate(substrings.minimisers(rank, 5).tolist()):
        window = rank[i:i + 5].tolist()
        least = sorted(set(window))
        assert seen.setdefault(tuple(least[:2]), key) == key
    assert len(set(seen.values())) == len(seen)


# -- pipeline ----------------------------------------------------------------------


def test_stages_follow_the_plain_versions(spark, sf_dir):
    documents = queries.table(spark, sf_dir, "documents")
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["language"](spark, documents, sf_dir)
    assert kept.count() == documents.count() and kept.schema.names == documents.columns
    alone = stage["near_duplicates"](spark, kept, sf_dir)
    assert sorted(r.doc_id for r in alone.collect()) == sorted({c for _, _, c in expected_components(kept.collect())})
    cleaned = stage["repeated_passages"](spark, alone, sf_dir)
    expected = remove_repeats([(r.doc_id, r.text) for r in alone.collect()])
    for r in cleaned.collect():
        words, left = expected[r.doc_id]
        if len(words) != len(left):
            assert (r.text, r.n_chars) == (" ".join(left), len(" ".join(left)))
    assert cleaned.columns == documents.columns and cleaned.count() == alone.count()
    packed = stage["packing"](spark, cleaned, sf_dir)
    assert packed.agg(F.count_distinct("doc_id")).first()[0] == cleaned.count()


def test_language_stage_rejects_letters_of_no_language(spark, sf_dir):
    """Random letters go; a short text, one that quotes another language and one in all four stay."""
    documents = queries.table(spark, sf_dir, "documents")
    r = random.Random(5)
    own = {}
    for d in documents.where("text is not null").orderBy("doc_id").select("lang", "text").collect():
        own.setdefault(d.lang, d.text)
    first, second = sorted(own)[:2]
    clean = {
        -1: own[first][:30], -2: own[first][:900] + own[second][:500], -3: " ".join(t[:400] for t in own.values()),
        -4: own[first] + " " + "".join(r.choices("bcdfghjklmnpqrstvwxz", k=40)),
    }
    junk = {-10 - i: " ".join("".join(r.choices("bcdfghjklmnpqrstvwxz", k=r.randrange(2, 10))) for _ in range(60)) for i in range(20)}
    more = spark.createDataFrame([*clean.items(), *junk.items(), (-50, "1 2 3")], "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["language"](spark, documents.unionByName(more, allowMissingColumns=True), sf_dir)
    ids = [x.doc_id for x in kept.collect()]
    assert len(ids) == documents.count() + len(clean) and set(clean) <= set(ids)
    assert kept.columns == documents.columns


def test_pipeline_of_odd_documents(spark, docs, tmp_path):
    odd = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r.doc_id for r in found.collect()}
    assert not ids & {51, 71, 72, 73} and {10, 50, 60, 70} <= ids
    odd.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
