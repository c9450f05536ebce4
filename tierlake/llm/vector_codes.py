"""Vector codes: vectors cut into parts, each part coded by its nearest codebook entry.

The nearest entry is searched by slices. Per dimension the entries' coordinates are sorted, and
prefix masks tell which entries lie below each place; the slice of width 2r around a component is the
exclusive or of two of them. The slices of all dimensions are ANDed, as uint64 masks, and leave the
entries within a box. The initial radius is the distance to one good entry, so the box holds the
nearest one and every tie, and only entries in the box are measured.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.runtime import prepare, stored

#: Vectors that are coded together.
CHUNK = 4096
#: Bits of a limb: sums are added up in limbs, which no number of rows makes overflow.
LIMB = 31
#: Least and largest ``long``.
LONG = 1 << 63


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python's where one does not fit in 62 bits."""
    if not x.size or np.abs(x).max() < 2.0**60 / scale:
        return np.floor(x * scale).astype(np.int64)
    exact = [(lambda n, d: n * scale // d)(*v.as_integer_ratio()) for v in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def fitting(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers if squared distances surely fit in them, else as Python's."""
    most = max((int(np.abs(a).max()) for a in (x, books) if a.size), default=0)
    kind = np.int64 if books.shape[-1] * (2 * most) ** 2 < LONG // 2 else object
    return x.astype(kind), books.astype(kind)


def root(square: np.ndarray) -> np.ndarray:
    """A whole number of at least the square root."""
    if square.dtype == object:
        return np.array([math.isqrt(s) + 1 for s in square.tolist()], object)
    return np.sqrt(square.astype(np.float64)).astype(np.int64) + 2


class Slices:
    """Sorted coordinates and prefix masks of the entries of one codebook."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, width = entries.shape
        self.words = -(-n // 64)
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = [entries[self.order[:, d], d] for d in range(width)]
        self.below = []
        for d in range(width):
            masks = np.zeros((n + 1, self.words), np.uint64)
            for place, e in enumerate(self.order[:, d].tolist()):
                masks[place + 1] = masks[place]
                masks[place + 1, e // 64] |= np.uint64(1 << e % 64)
            self.below.append(masks)
        spread = [int(c[-1] - c[0]) for c in self.sorted]
        self.widest = spread.index(max(spread)) if spread else 0

    def distances(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        apart = x - self.entries[entry]
        return (apart * apart).sum(axis=1)

    def guess(self, x: np.ndarray) -> np.ndarray:
        """An entry whose coordinate in the widest dimension is next to the component."""
        d = self.widest
        place = np.searchsorted(self.sorted[d], x[:, d]).clip(max=len(self.entries) - 1)
        return self.order[place, d]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of least squared distance, ties to the lower index, and that distance."""
        n, width = x.shape
        if not width:
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        radius = root(self.distances(x, self.guess(x)))
        inside = np.full((n, self.words), np.uint64(0xFFFFFFFFFFFFFFFF))
        for d in range(width):
            low = np.searchsorted(self.sorted[d], x[:, d] - radius, side="left")
            high = np.searchsorted(self.sorted[d], x[:, d] + radius, side="right")
            inside &= self.below[d][high] ^ self.below[d][low]
        bits = np.unpackbits(inside.astype("<u8").view(np.uint8).reshape(n, -1), axis=1, bitorder="little")
        row, entry = np.nonzero(bits)
        distance = self.distances(x[row], entry)
        first = np.searchsorted(row, np.arange(n))
        least = np.minimum.reduceat(distance, first)
        hit = np.flatnonzero(distance == least[row])
        best = hit[np.searchsorted(row[hit], np.arange(n))]
        return entry[best], distance[best]


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part of the vectors; ``books`` is part, entry, position."""
    x, books = fitting(x, books)
    parts, _, width = books.shape
    found = [Slices(books[p]).nearest(x[:, p * width:(p + 1) * width]) for p in range(parts)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def vectors(batches, width: int, scale: int):
    """Chunks of batches with their vectors as whole numbers, shorter ones filled up with zeros."""
    held, rows = [], 0

    def chunk():
        table = pa.Table.from_batches(held).combine_chunks()
        column = table["x"].combine_chunks()
        sizes = np.diff(column.offsets.to_numpy())
        x = np.zeros((len(table), width))
        x[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
        return table, scaled(x, scale)

    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= CHUNK:
            yield chunk()
            held, rows = [], 0
    if rows:
        yield chunk()


def sums(rows: DataFrame, books: np.ndarray, scale: int, limbs: int) -> dict[tuple[int, int, int], int]:
    """Sums of the parts by (part, entry, position), and their number at position -1.

    Tasks add up what they read; the driver gets one row per number of the codebooks and limb.
    """
    parts, entries, width = books.shape

    def add(batches):
        total = np.zeros((parts, entries, width), object)
        count = np.zeros((parts, entries), np.int64)
        for _, x in vectors(batches, parts * width, scale):
            code, _ = assign(x, books)
            for p in range(parts):
                own = np.zeros((entries, width), x.dtype)
                np.add.at(own, code[:, p], x[:, p * width:(p + 1) * width])
                total[p] += own.astype(object)
                count[p] += np.bincount(code[:, p], minlength=entries)
        out = []
        for p, e in zip(*np.nonzero(count), strict=True):
            out.append((int(p), int(e), -1, 0, int(count[p, e])))
            for d, value in enumerate(total[p, e].tolist()):
                for limb in range(limbs):  # the last one keeps the sign
                    low = value >> LIMB * limb
                    out.append((int(p), int(e), d, limb, low if limb == limbs - 1 else low & (1 << LIMB) - 1))
        columns = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, [pa.int32()] * 4 + [pa.int64()], strict=True)],
            ["part", "entry", "position", "limb", "value"],
        )

    found = rows.select("x").mapInArrow(add, "part int, entry int, position int, limb int, value long")
    whole: dict[tuple[int, int, int], int] = {}
    for r in found.groupBy("part", "entry", "position", "limb").agg(F.sum("value").alias("value")).collect():
        key = (r["part"], r["entry"], r["position"])
        whole[key] = whole.get(key, 0) + (r["value"] << LIMB * r["limb"])
    return whole


def moved(books: np.ndarray, whole: dict[tuple[int, int, int], int]) -> np.ndarray:
    """Codebooks of the floors of the means; entries without parts stay."""
    out = books.astype(object)
    for (p, e, d), value in whole.items():
        if d >= 0:
            out[p, e, d] = value // whole[p, e, -1]
    return out


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal digits with commas."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel().tolist()).encode()).hexdigest()


def valid(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def train(rows: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> np.ndarray:
    """Codebooks (part, entry, position) of rows ``key, x``, started from those of smallest key.

    Rows of equal keys start in order of their components. Each round reads the rows once; the driver
    holds the codebooks and nothing that grows with the rows.
    """
    size, most, n = rows.agg(
        F.max(F.size("x")), F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))), F.count(F.lit(1))
    ).first()
    width = -(-(size or 0) // parts)
    first = rows.select("key", "x").orderBy(F.asc_nulls_last("key"), "x").limit(entries).collect()
    x = np.zeros((len(first), parts * width))
    for i, r in enumerate(first):
        x[i, :len(r["x"])] = r["x"]
    books = scaled(x, scale).reshape(len(first), parts, width).transpose(1, 0, 2)
    largest = int(abs(int(most or 0)) + 1) * scale * max(1, n)
    limbs = -(-(largest.bit_length() + 1) // LIMB)
    for _ in range(rounds if len(first) else 0):
        books = moved(books, sums(rows, books, scale, limbs))
    return books


def encode(vecs: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
           key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``key, code, error, label, label_error, codebooks_sha256`` of every row with a finite vector.

    Components become floor(scale * x). Each of ``parts`` equal parts of the vector has a codebook,
    started from the ``entries`` rows of smallest key (all, if fewer; null keys last, ties by
    components) and improved in ``rounds`` rounds: every part goes to its nearest entry (squared
    distance, ties to the lower index), every entry that got any to the floor of their mean. ``code``
    has two hex digits per part (more if ``entries`` is above 256), ``error`` is the final squared
    distance and ``label_error`` its sum over equal labels, nulls together.

    Rows whose vector is null or holds a null or non-finite component are left out. Shorter vectors,
    and widths that ``parts`` does not divide, count as filled up with zeros. Repeated rows count as
    often as they occur. Components of any size are computed exactly; an error, or sum of errors,
    beyond a ``long`` is null. An empty table gives no rows. Other columns do not matter.
    """
    prepare(vecs.sparkSession)
    x = F.transform(vecs[vector], lambda c: c.cast("double"))
    rows = stored(
        vecs.where(valid(vecs[vector])).select(vecs[key].alias("key"), vecs[label].alias("label"), x.alias("x")),
        "vectors",
    )
    books = train(rows, parts, entries, rounds, scale)
    digits = max(2, len(format(max(entries - 1, 0), "x")))
    out = T.StructType([
        rows.schema["key"], rows.schema["label"],
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
    ])

    def run(batches):
        for table, own in vectors(batches, books.shape[0] * books.shape[2], scale):
            code, distance = assign(own, books)
            error = distance.astype(object).sum(axis=1) if distance.dtype == object else distance.sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    table["key"].combine_chunks(), table["label"].combine_chunks(),
                    pa.array(["".join(format(e, f"0{digits}x") for e in c) for c in code.tolist()], pa.string()),
                    pa.array([e if e < LONG else None for e in error.tolist()], pa.int64()),
                ],
                out.names,
            )

    codes = stored(rows.mapInArrow(run, out), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    whole = F.when(F.count("error") == F.count(F.lit(1)), total).try_cast("long")
    by_label = codes.groupBy(F.col("label").alias("of")).agg(whole.alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("key").alias(key), "code", "error", F.col("label").alias(label), "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"),
    )
