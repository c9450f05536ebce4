"""Exact top-k search by inner product over a bit-sliced index.

Rows are indexed in blocks. Each component of a block is quantised and kept as bit slices: one
bitmap over the block's rows per bit. A query adds the slices, weighted by its own components, with
bitmap arithmetic; the sum is itself a set of slices. Rows are selected from its most significant
slice downward, together with the rows that lie within the quantisation error of the last one
selected, and only these boundary rows are scored exactly.

Blocks keep components in 32 or 64 bits, or as the doubles they came from where they are larger; scores are
then computed with whole numbers of any size.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.runtime import prepare, stored

#: Rows of an index block, bits kept of each component, bits kept of a query's weights.
BLOCK, ROW_BITS, QUERY_BITS = 8192, 6, 8
#: Queries that travel to a block together, and that are added up together.
QUERY_BLOCK, TOGETHER = 2048, 64
INDEX = "n long, width long, shift string, kind string, ids binary, none binary, slices binary, vectors binary"
#: Scores below this fit in a long.
LONG = 1 << 63
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def usable(vector: Column) -> Column:
    """Components as doubles; null unless all are finite."""
    x = lambda c: c.cast("double")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < float("inf")))
    return F.when(finite, F.transform(vector, x))


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python's where one does not fit in 60 bits."""
    if not x.size or np.abs(x).max() < 2.0**60 / scale:
        return np.floor(x * scale).astype(np.int64)
    exact = [(lambda n, d: n * scale // d)(*v.as_integer_ratio()) for v in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def build_index(rows: DataFrame, scale: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Index blocks of the rows whose vector has finite components only, written to scratch.

    Components may be of any size. Shorter vectors count as filled up with zeros.
    """
    prepare(rows.sparkSession)
    valid = rows.select(rows[key].cast("long").alias("key"), usable(rows[vector]).alias("x"))
    valid = valid.where("x is not null")
    width = valid.agg(F.max(F.size("x"))).first()[0] or 0
    blocks = max(1, -(-valid.count() // BLOCK))

    def block(batches):
        keys, none, held, number = [], [], [], 0

        def result():
            nonlocal number
            x = np.concatenate(held)
            number += 1
            own = _block(np.concatenate(keys), np.concatenate(none), x, scale)
            return pa.RecordBatch.from_pylist([own])

        for batch in batches:
            x = np.zeros((len(batch), width))
            column = batch["x"]
            sizes = np.diff(column.offsets.to_numpy())
            x[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
            keys.append(batch["key"].fill_null(0).to_numpy(zero_copy_only=False))
            none.append(batch["key"].is_null().to_numpy(zero_copy_only=False))
            held.append(x)
            while sum(map(len, held)) >= BLOCK:
                keys, none, held = ([np.concatenate(c)] for c in (keys, none, held))
                rest = [c[0][BLOCK:] for c in (keys, none, held)]
                keys, none, held = ([c[0][:BLOCK]] for c in (keys, none, held))
                yield result()
                keys, none, held = ([c] for c in rest)
        if sum(map(len, held)):
            yield result()

    packed = valid.repartition(blocks).mapInArrow(block, INDEX)
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), "bit-slices")


def _block(keys: np.ndarray, none: np.ndarray, raw: np.ndarray, scale: int) -> dict:
    """The bit slices of a block: the upper ``ROW_BITS`` bits of each component above its minimum."""
    x = scaled(raw, scale)
    n, width = x.shape
    low = x.min(axis=0)
    bits = int((x.max(axis=0) - low).max()).bit_length() if x.size else 0
    most = int(np.abs(x).max()) if x.size else 0
    kind = "i4" if most < 1 << 31 else "i8" if x.dtype != object else f"f8 {scale}"
    shift = max(0, bits - ROW_BITS)
    level = ((x - low) >> shift).astype(np.uint8)
    words = -(-n // 64)
    slices = np.zeros((width, ROW_BITS, words * 8), np.uint8)
    for bit in range(ROW_BITS):
        packed = np.packbits((level >> bit) & 1, axis=0, bitorder="little")
        slices[:, bit, :len(packed)] = packed.T
    return {
        "n": n, "width": width, "shift": str(shift), "kind": kind, "ids": keys.tobytes(),
        "none": none.tobytes(), "slices": slices.tobytes(),
        "vectors": (raw if kind[0] == "f" else x.astype(kind)).tobytes(),
    }


def components(vectors: bytes, kind: str, width: int) -> np.ndarray:
    """Vectors of a block as whole numbers."""
    if kind[0] == "f":
        return scaled(np.frombuffer(vectors, np.float64).reshape(-1, width), int(kind[3:])).astype(object)
    return np.frombuffer(vectors, kind).reshape(-1, width)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, in 64 bits where they surely fit, else as Python's integers."""
    most = [int(np.abs(x).max()) if x.size else 0 for x in (a, b)]
    if most[0] * most[1] * max(1, a.shape[1]) < LONG:
        return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
    return (a.astype(object) * b.astype(object)).sum(axis=1)


def order_of(score: int) -> str:
    """Text that sorts as scores beyond a long do: more digits first for negative ones."""
    digits = str(abs(score))
    if score >= 0:
        return f"{len(digits):06d}{digits}"
    return f"{999_999 - len(digits):06d}{''.join(chr(105 - ord(d)) for d in digits)}"


class SliceSum:
    """Bitmaps added with their weights; at most two wait at each weight."""

    def __init__(self):
        self.at: list[list[np.ndarray]] = []

    def add(self, bitmap: np.ndarray, weight: int) -> None:
        while True:
            while len(self.at) <= weight:
                self.at.append([])
            waiting = self.at[weight]
            waiting.append(bitmap)
            if len(waiting) < 3:
                return
            a, b, c = waiting
            half = a ^ b
            self.at[weight] = [half ^ c]
            bitmap, weight = (a & b) | (half & c), weight + 1

    def slices(self) -> list[np.ndarray]:
        """One bitmap per weight, least significant first."""
        weight = 0
        while weight < len(self.at):
            if len(self.at[weight]) == 2:
                a, b = self.at[weight]
                self.at[weight] = [a ^ b]
                self.add(a & b, weight + 1)
            weight += 1
        empty = np.zeros_like(next(x[0] for x in self.at if x))
        return [x[0] if x else empty for x in self.at]


def select(slices: list[np.ndarray], valid: np.ndarray, k: int, slack: np.ndarray) -> np.ndarray:
    """Rows (bitmaps, one per query) whose sum is at least the k-th largest less the slack."""
    queries = len(slack)  # whole numbers of any size
    sure = np.zeros((queries, len(valid)), np.uint64)
    tied = np.repeat(valid[None, :], queries, axis=0)
    kth = [0] * queries  # whole numbers of any size
    for weight in reversed(range(len(slices))):
        ones = tied & slices[weight]
        more = np.bitwise_count(sure | ones).sum(axis=1) >= k
        sure[~more] |= ones[~more]
        tied = np.where(more[:, None], ones, tied & ~ones)
        for i in np.flatnonzero(more):
            kth[i] |= 1 << weight
    least = [max(0, t - int(s)) for t, s in zip(kth, slack, strict=True)]
    above = np.zeros_like(sure)
    level = np.repeat(valid[None, :], queries, axis=0)
    for weight in reversed(range(len(slices))):
        bit = np.array([-(t >> weight & 1) & 0xFFFFFFFFFFFFFFFF for t in least], np.uint64)[:, None]
        above |= level & slices[weight] & ~bit
        level &= ~(slices[weight] ^ bit)
    return above | level


def search_block(block: dict, queries: np.ndarray, own: np.ndarray, k: int):
    """Query number, id, whether that is null, and score of the best rows of a block.

    ``own`` is the place of the query itself in the block, -1 if it is elsewhere. Ties at the end
    go to smaller ids.
    """
    n, width, shift = block["n"], block["width"], int(block["shift"])
    ids = np.frombuffer(block["ids"], np.int64)
    none = np.frombuffer(block["none"], bool)
    vectors = components(block["vectors"], block["kind"], width).reshape(n, width)
    slices = np.frombuffer(block["slices"], np.uint64).reshape(width, ROW_BITS, -1)
    words = slices.shape[2]
    valid = np.zeros(words * 8, np.uint8)
    valid[:(n + 7) // 8] = np.packbits(np.ones(n, np.uint8), bitorder="little")
    valid = valid.view(np.uint64)
    if queries.size and int(np.abs(queries).max()) * width >= LONG:
        queries = queries.astype(object)
    found = []
    for start in range(0, len(queries), TOGETHER):
        q = queries[start:start + TOGETHER]
        size = np.abs(q)
        bits = [max(0, int(m).bit_length() - QUERY_BITS) for m in size.max(axis=1, initial=0)]
        drop = np.array(bits, q.dtype)[:, None]
        weight = (size >> drop).astype(np.int64)
        top = (1 << ROW_BITS) - 1
        dropped = (size - (weight.astype(q.dtype) << drop)).sum(axis=1).tolist()
        error = [((1 << shift) - 1) * s + (top << shift) * d
                 for s, d in zip(size.sum(axis=1).tolist(), dropped, strict=True)]  # of any size
        slack = [-(-e >> (shift + b)) for e, b in zip(error, bits, strict=True)]
        negative = np.where(q < 0, ALL, np.uint64(0))
        total = SliceSum()
        total.add(np.zeros((len(q), words), np.uint64), 0)
        for c in range(width):
            masks = [
                (j, np.where(weight[:, c] >> j & 1, ALL, np.uint64(0))[:, None])
                for j in range(QUERY_BITS) if (weight[:, c] >> j & 1).any()
            ]
            if masks:
                for bit in range(ROW_BITS):
                    level = slices[c, bit][None, :] ^ negative[:, c][:, None]
                    for j, mask in masks:
                        total.add(level & mask, bit + j)
        near = select(total.slices(), valid, k + 1, slack)  # the query itself may be among them
        which, row = np.nonzero(np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :n])
        other = own[start + which] != row
        which, row = which[other], row[other]
        parts = [slice(low, low + (1 << 16)) for low in range(0, len(row), 1 << 16)]
        score = np.concatenate([products(vectors[row[p]], q[which[p]]) for p in parts] or [np.zeros(0, np.int64)])
        level = np.unique(score, return_inverse=True)[1] if score.dtype == object else score
        order = np.lexsort((ids[row], none[row], -level, which))
        which, row, score = which[order], row[order], score[order]
        first = np.searchsorted(which, np.arange(len(q)))
        best = np.arange(len(which)) - first[which] < k
        found.append((start + which[best], ids[row[best]], none[row[best]], score[best]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def search(index: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows for each row whose id ``every`` divides.

    The score is the integer inner product, null where it exceeds a long (the rank counts it as it
    is); ties go to smaller ids, null ids last. A query's own row is left out, other rows with its id
    are not. Query blocks and index blocks meet by an equi-join on groups of index blocks. A group's
    blocks follow each other for a query block, and only the k best rows of the group leave the task.
    """
    spark = index.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_rows = index.agg(F.sum("n")).first()[0] or 0
    query_blocks = max(1, -(-n_rows // (every * QUERY_BLOCK)))

    def pick(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, none = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["none"], bool)
                size = len(row["vectors"]) // max(1, row["n"])
                own = [row["vectors"][i * size:(i + 1) * size] for i in range(row["n"])]
                at = np.flatnonzero((ids % every == 0) & ~none)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array([row["block"]] * len(at), pa.int64()),
                     pa.array(at.astype(np.int32)), pa.array([row["kind"]] * len(at), pa.string()),
                     pa.array([own[i] for i in at], pa.binary())],
                    ["query_id", "home", "place", "kind", "x"],
                )

    def answer(batches):
        part, asked, best = None, [], None  # best: the group's rows so far, per query

        def result():
            which, ids, none, score = best
            exact = score.tolist()
            fits = [-LONG <= v < LONG for v in exact]
            return pa.RecordBatch.from_arrays(
                [pa.array([asked[w][c] for w in which], pa.int64()) for c in ("query_id", "home", "place")]
                + [
                    pa.array(ids, mask=none), pa.array([v if f else None for v, f in zip(exact, fits, strict=True)], pa.int64()),
                    pa.array([0 if f else 1 if v > 0 else -1 for v, f in zip(exact, fits, strict=True)], pa.int32()),
                    pa.array([None if f else order_of(v) for v, f in zip(exact, fits, strict=True)], pa.string()),
                ],
                ["query_id", "home", "place", "vec_id", "score", "beyond", "digits"],
            )

        for batch in batches:
            for i in range(len(batch)):
                pair = {c: batch[c][i].as_py() for c in batch.schema.names if c != "queries"}
                if pair["part"] != part:
                    if best is not None:
                        yield result()
                    part, best = pair["part"], None
                    asked = batch["queries"][i].as_py()
                    held = [components(x["x"], x["kind"], pair["width"]) for x in asked]
                    kind = object if any(h.dtype == object for h in held) else np.int64
                    q = np.concatenate([h.astype(kind) for h in held])
                own = np.array([x["place"] if x["home"] == pair["block"] else -1 for x in asked])
                found = search_block(pair, q, own, k)
                best = found if best is None else best_of(best, found, k)
        if best is not None:
            yield result()

    queries = index.mapInArrow(pick, "query_id long, home long, place int, kind string, x binary")
    blocks = (
        queries.withColumn("part", F.pmod(F.xxhash64("home", "place"), F.lit(query_blocks)))
        .groupBy("part").agg(F.collect_list(F.struct("query_id", "home", "place", "kind", "x")).alias("queries"))
        .select("part", "queries", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("group"))
    )
    grouped = index.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    # A merge join goes through the group's blocks for one query block after the other.
    answers = blocks.hint("merge").join(grouped, "group").drop("group").mapInArrow(
        answer, "query_id long, home long, place long, vec_id long, score long, beyond int, digits string"
    )
    best = Window.partitionBy("query_id", "home", "place").orderBy(
        F.desc("beyond"), F.desc("digits"), F.desc("score"), F.asc_nulls_last("vec_id")
    )
    return (
        answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def best_of(a: tuple, b: tuple, k: int) -> tuple:
    """The k best rows per query of two results of ``search_block``."""
    if object in (a[3].dtype, b[3].dtype):
        a, b = ((*x[:3], x[3].astype(object)) for x in (a, b))
    which, ids, none, score = (np.concatenate(c) for c in zip(a, b, strict=True))
    level = np.unique(score, return_inverse=True)[1] if score.dtype == object else score
    order = np.lexsort((ids, none, -level, which))
    which, ids, none, score = which[order], ids[order], none[order], score[order]
    first = np.searchsorted(which, which)
    kept = np.arange(len(which)) - first < k
    return which[kept], ids[kept], none[kept], score[kept]


def top_k(rows: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, key: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """Index the rows and search them: see ``build_index`` and ``search``.

    Vectors that are null or hold a null or a non-finite component take no part; empty vectors have
    score 0. Components of any size are ranked exactly; a score beyond a long is null. An empty table gives no rows. Other columns do not matter.
    """
    return search(build_index(rows, scale, key, vector), k, every)
