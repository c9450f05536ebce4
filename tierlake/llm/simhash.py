"""SimHash near-duplicates: links by a Gray-order hierarchical index, components of linked texts."""

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.components import components
from tierlake.llm.runtime import prepare, ragged, stored

SEED = 42
#: Hashes whose bits are counted at once.
SLICE = 1 << 17
#: Fingerprints of a bucket that are searched together; larger buckets are cut into such blocks.
BLOCK = 4096
#: Fingerprints that a bucket should hold on average.
BUCKET = 256
LEAF, FANOUT = 16, 8
#: Pairs that are compared at once.
PAIRS = 1 << 20


def fingerprint(texts: list[str | None], shingle: int = 4) -> np.ndarray:
    """SimHash of each text, 64 bits: a bit is set if it is in over half of the shingles' hashes."""
    counts = np.zeros((len(texts), 64), np.int64)
    sizes = np.zeros(len(texts), np.int64)
    hash64 = xxhash.xxh64_intdigest
    held: list[np.ndarray] = []
    rows: list[int] = []

    def flush():
        if held:
            bits = np.unpackbits(np.concatenate(held).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            starts = np.concatenate(([0], np.cumsum([len(h) for h in held])))[:-1].astype(np.int64)
            np.add.at(counts, rows, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
            held.clear()
            rows.clear()

    waiting = 0
    for row, text in enumerate(texts):
        words = (text or "").encode().lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        width = min(shingle, len(words))
        first, last = starts[:len(words) - width + 1], ends[width - 1:]
        sizes[row] = len(first)
        for low in range(0, len(first), SLICE):
            pairs = zip(first[low:low + SLICE].tolist(), last[low:low + SLICE].tolist(), strict=True)
            held.append(np.array([hash64(joined[s:e], SEED) for s, e in pairs], "<u8"))
            rows.append(row)
            waiting += len(held[-1])
            if waiting >= SLICE:
                flush()
                waiting = 0
    flush()
    chosen = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(chosen, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, shingle: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp, hash`` of every row; fp is the fingerprint as a signed long, hash that of the text."""
    prepare(docs.sparkSession)
    rows = docs.select(
        docs[key].alias("key"), docs[text].alias("text"),
        F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("hash"),
    )

    def run(batches):
        for batch in batches:
            fp = fingerprint(batch["text"].to_pylist(), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(fp), batch["hash"]], ["key", "fp", "hash"])

    schema = T.StructType([
        rows.schema["key"], T.StructField("fp", T.LongType()), T.StructField("hash", T.LongType()),
    ])
    return rows.mapInArrow(run, schema)


def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in Gray order, where neighbours differ in a single bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))  # signed order of the unsigned rank


def segment_masks(distinct: int, distance: int) -> list[int]:
    """Masks such that any two patterns within the distance agree on at least one.

    The bits are cut into n segments; of these, n - distance are untouched. n is the smallest that
    leaves ``BUCKET`` of so many evenly spread patterns in a bucket.
    """
    n = distance + 1
    while n < distance + 5 and distinct / 2 ** (64 * (n - distance) / n) > BUCKET:
        n += 1
    cuts = [64 * i // n for i in range(n + 1)]
    segments = [((1 << (high - low)) - 1) << low for low, high in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(segments, n - distance)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(patterns: DataFrame, distance: int) -> DataFrame:
    """Links ``a, b`` that connect all of the distinct patterns ``fp`` within the distance.

    Two patterns within the distance agree on one of the masks, and meet in that mask's bucket.
    A bucket is searched by an index in Gray order. Of the pairs found in a bucket, a spanning set
    is returned: every pair is connected, though not by a link of its own. Buckets over ``BLOCK``
    patterns are cut into blocks by a hash, and every two blocks are searched together.
    """
    masks = segment_masks(patterns.count(), distance)
    keyed = patterns.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("mask", "part")
    )
    sizes = keyed.groupBy("mask", "part").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    placed = (
        keyed.join(sizes, ["mask", "part"]).withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("mask", "part", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"),
            "fp", gray_rank(F.col("fp")).alias("rank"),
        )
    )
    parts = int(patterns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(parts, "bucket").sortWithinPartitions("bucket", "rank")
    return dealt.select("bucket", "fp").mapInArrow(lambda it: _search(it, distance), "a long, b long")


def _search(batches, distance):
    """Search whole buckets, many small ones at once."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def found(bucket, fp):
        roots = linked(bucket, fp, distance)
        hit = np.flatnonzero(fp[roots] != fp)
        pair = [pa.array(fp[hit].view(np.int64)), pa.array(fp[roots[hit]].view(np.int64))]
        return pa.RecordBatch.from_arrays(pair, ["a", "b"])

    for batch in batches:
        held.append((
            batch["bucket"].to_numpy(zero_copy_only=False),
            batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64),
        ))
        if sum(len(h[0]) for h in held) >= 1 << 15:
            bucket, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            done = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
            held = [(bucket[done:], fp[done:])]
            if done:
                yield found(bucket[:done], fp[:done])
    if held:
        yield found(*(np.concatenate(x) for x in zip(*held, strict=True)))


def linked(bucket: np.ndarray, fp: np.ndarray, distance: int) -> np.ndarray:
    """For each pattern the first one of its bucket that it is connected with.

    ``bucket`` is sorted and ``fp`` in Gray order within it. The index has a node per 16 patterns
    in a row, then per 8 nodes, up to one per bucket. A node knows which bits all below it share;
    two nodes are searched together only if the differences on bits that both share, which
    accumulate on the way down as nodes share more bits, are within the distance.
    """
    n = len(fp)
    root = np.arange(n)
    if not n:
        return root
    levels = []  # (first child, number of children, bits shared, their values), leaves first
    owner, low, high = bucket, fp, fp
    size = LEAF
    while True:
        new = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        place = np.arange(len(owner)) - np.repeat(new, np.diff(np.append(new, len(owner))))
        starts = np.flatnonzero(place % size == 0)
        low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
        owner = owner[starts]
        levels.append((starts, np.diff(np.append(starts, len(place))), ~(low ^ high), low))
        size = FANOUT
        if len(new) == len(starts):
            break
    top = np.arange(len(owner))
    todo = [(len(levels) - 1, top, top)]
    while todo:
        level, a, b = todo.pop()
        starts, sizes, _, _ = levels[level]
        work = sizes[a] * sizes[b]
        if work.sum() > PAIRS and len(a) > 1:
            half = len(a) // 2
            todo += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        pair = np.repeat(np.arange(len(a)), work)
        k = ragged(np.zeros(len(a), np.int64), work)
        left, right = a[pair], b[pair]
        across = sizes[right]
        x, y = starts[left] + k // across, starts[right] + k % across
        if level:
            _, _, shared, value = levels[level - 1]
            near = np.bitwise_count((value[x] ^ value[y]) & shared[x] & shared[y]) <= distance
            near &= (left != right) | (x <= y)
            if near.any():
                todo.append((level - 1, x[near], y[near]))
        else:
            near = (x < y) if len(x) else np.zeros(0, bool)
            near |= left != right
            near &= np.bitwise_count(fp[x] ^ fp[y]) <= distance
            _unite(root, x[near], y[near])
    return root


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give connected places the same, smallest root."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(root, after := root[root]):
            root[:] = after


def groups(docs: DataFrame, distance: int = 4, shingle: int = 4, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``key, fp, hash, root, component_id`` of every row; the id is the smallest key links lead to.

    Rows with equal fingerprints, or ones within ``distance`` bits, are linked. Texts are
    lower-cased (A-Z), shingles are of ``shingle`` words, repeats included; shorter texts are one
    shingle, texts without words (null, empty, blank) have fingerprint zero and are linked like
    any other. Only distinct fingerprints are searched. A component's id is its smallest key that
    is not null, null if it has none; ``root`` is its smallest fingerprint. Repeated rows keep their rows. Other columns do not matter.
    """
    prepare(docs.sparkSession)
    prints = stored(fingerprints(docs, shingle, key, text), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("key").alias("first")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), distance))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = rooted.join(smallest, "root").select(
        F.col("fp").alias("its_fp"), "root", "component_id"
    )
    return prints.join(of_print, prints["fp"] == of_print["its_fp"]).select(
        "key", "fp", "hash", "root", "component_id"
    )


def fp_hex(fp: Column) -> Column:
    """16 lower-case hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, distance: int = 4, shingle: int = 4, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the smallest key stays.

    Null keys come last; of equal keys the smaller hash of the text stays, and one of equal rows.
    """
    found = groups(docs, distance, shingle, key, text)
    place = F.struct(F.col("key").isNull().alias("none"), "key", "hash")
    kept = found.groupBy("root").agg(F.min(place).alias("kept")).select("kept.key", "kept.hash")
    hash_of = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[key].alias("id"), hash_of.alias("h"))
    first = Window.partitionBy("id", "h").orderBy(F.lit(0))
    return (
        rows.join(kept, rows["id"].eqNullSafe(kept["key"]) & (rows["h"] == kept["hash"]), "left_semi")
        .withColumn("copy", F.row_number().over(first)).where("copy = 1").select("row.*")
    )
