"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs.

Every paragraph is hashed to a wide vector and the vectors are added modulo 2^64. The sum does not
depend on the order, and paragraphs can be added or taken away without the rest of the text. The
first lanes are uniform and tell multisets apart; the others are +1 or -1, so that the squared
length of a difference estimates by how many paragraphs two texts differ. Empty paragraphs, as blank
lines make them, count in the first lanes only.
"""

import hashlib
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.runtime import prepare

UNIFORM = 8
SIGNS = 128
LANES = UNIFORM + SIGNS
DIGEST = 8 * UNIFORM  # the most that the hash gives; the signs have one of their own

#: Paragraphs whose vectors are held at once.
HELD = 4096

#: A line break ends a paragraph; so does the end of a sentence, as many texts are a single line.
BREAK = re.compile(r"\n|(?<=[.!?]) ")


def paragraphs(text: str) -> list[str]:
    """Parts between breaks, empty ones included; an empty text is one empty part."""
    return BREAK.split(text)


def vectors(parts: Iterable[str]) -> np.ndarray:
    """One vector of lanes per paragraph."""
    raw = [p.encode() for p in parts]
    wide = b"".join([hashlib.blake2b(p, digest_size=DIGEST).digest() for p in raw])
    bits = b"".join([hashlib.blake2b(p, digest_size=SIGNS // 8, person=b"signs").digest() for p in raw])
    out = np.empty((len(raw), LANES), np.uint64)
    out[:, :UNIFORM] = np.frombuffer(wide, "<u8").reshape(-1, UNIFORM)
    signs = np.unpackbits(np.frombuffer(bits, np.uint8).reshape(-1, SIGNS // 8), axis=1).astype(np.int64) * 2 - 1
    signs[np.array([not p for p in raw], bool)] = 0
    out[:, UNIFORM:] = signs.view(np.uint64)
    return out


def fingerprint(texts: list[str]) -> np.ndarray:
    """Fingerprints of texts, a row of 64-bit lanes each; ``HELD`` paragraphs are hashed at a time."""
    out = np.zeros((len(texts), LANES), np.uint64)
    held, owner = [], []

    def add():
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        out[np.array(owner)[starts]] += np.add.reduceat(vectors(held), starts, axis=0)

    for i, text in enumerate(texts):
        parts = paragraphs(text)
        for low in range(0, len(parts), HELD):
            held += parts[low:low + HELD]
            owner += [i] * (len(held) - len(owner))
            if len(held) >= HELD:
                add()
                held, owner = [], []
    if held:
        add()
    return out


def insert(fp: np.ndarray, parts: Iterable[str]) -> np.ndarray:
    """The fingerprint after paragraphs were added."""
    return fp + vectors(parts).sum(axis=0, dtype=np.uint64)


def delete(fp: np.ndarray, parts: Iterable[str]) -> np.ndarray:
    """The fingerprint after paragraphs were taken away."""
    return fp - vectors(parts).sum(axis=0, dtype=np.uint64)


def _norm(lanes: np.ndarray) -> np.ndarray:
    signs = np.ascontiguousarray(lanes[..., UNIFORM:]).view(np.int64).astype(np.float64)
    return (signs * signs).mean(axis=-1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of common paragraphs (0 to 1), estimated from two fingerprints; 1 if they are equal.

    With multisets as vectors of counts this is 2<a,b> / (|a|^2 + |b|^2); the deviation is about
    sqrt(2 / SIGNS) of the share that differs.
    """
    whole = _norm(a) + _norm(b)
    apart = _norm(a - b)
    like = np.where(whole > 0, 1 - apart / np.where(whole > 0, whole, 1), 0.0).clip(0, 1)
    return np.where((a == b).all(axis=-1), 1.0, like)


def to_hex(lanes: np.ndarray) -> str:
    """Lanes in hex digits. Signs take 32 bits, which the paragraphs of no text can exceed."""
    return lanes[:UNIFORM].astype("<u8").tobytes().hex() + lanes[UNIFORM:].astype("<u4").tobytes().hex()


def from_hex(value: str) -> np.ndarray:
    raw = bytes.fromhex(value)
    signs = np.frombuffer(raw[8 * UNIFORM:], "<i4").astype(np.int64).view(np.uint64)
    return np.concatenate((np.frombuffer(raw[:8 * UNIFORM], "<u8"), signs))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint`` of every row; a null text is empty."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            lanes = fingerprint([t or "" for t in batch["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array([to_hex(x) for x in lanes], pa.string())], ["key", "fingerprint"]
            )

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = T.StructType([rows.schema["key"], T.StructField("fingerprint", T.StringType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def in_sequence(docs: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """Rows ``key, text, bucket, closing`` in descending order of key, dealt to ranges.

    The order is: key descending, nulls last, ties by descending hash of the text. Each bucket is
    a range of keys and hashes, in one partition, and ends with a closing row: the first row of the
    next bucket (after the last: of the first). Only keys go into the quantiles that set the
    ranges, and one row per bucket is repeated, so texts are shuffled once. A key, or null, that fills
    several ranges is cut up by hash, so its rows do not meet in one task unless their texts are equal.
    The key is an integer.
    """
    rows = docs.select(
        docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"),
        F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("hash"),
    )
    cuts = _ranges(docs, key, parts)
    bounds = F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip("khx", c, strict=True)]) for c in cuts])
    own_k, own_h = F.col("key").isNotNull().cast("long"), F.coalesce(F.col("key").cast("long"), F.lit(0))
    below = lambda b: (b["k"] < own_k) | (
        (b["k"] == own_k) & ((b["h"] < own_h) | ((b["h"] == own_h) & (b["x"] < F.col("hash")))))
    bucket = F.size(F.filter(bounds, below)) if cuts else F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    heads = sorted(
        (r["bucket"], r["head"]["key"], r["head"]["hash"])
        for r in rows.groupBy("bucket").agg(F.max(F.struct("key", "hash")).alias("head")).collect()
    )
    before = [(*heads[i][1:], heads[(i + 1) % len(heads)][0]) for i in range(len(heads))]
    kind = rows.schema["key"].dataType.simpleString()
    closing = docs.sparkSession.createDataFrame(before, f"head_key {kind}, head_hash long, closes int")
    own = F.struct("bucket", F.lit(False).alias("closing"))
    other = F.struct(F.col("closes").alias("bucket"), F.lit(True).alias("closing"))
    placed = rows.join(  # at most a row per bucket
        F.broadcast(closing),
        F.col("key").eqNullSafe(F.col("head_key")) & (F.col("hash") == F.col("head_hash")), "left",
    ).select(
        "key", "text", "hash",
        F.explode(F.when(F.col("closes").isNull(), F.array(own)).otherwise(F.array(own, other))).alias("at"),
    ).select("key", "text", "hash", "at.bucket", "at.closing")
    return (
        placed.repartitionByRange(parts, "bucket")
        .sortWithinPartitions("bucket", "closing", F.desc_nulls_last("key"), F.desc("hash"))
        .select("key", "text", "bucket", "closing")
    )


def _ranges(docs: DataFrame, key: str, parts: int) -> list[tuple[int, int, int]]:
    """Upper ends (whether there is a key, key, hash) of all ranges but the last, ascending."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = docs.agg(
        F.percentile_approx(docs[key].cast("long"), shares, F.lit(100 * parts)).alias("q"),
        F.count(docs[key]).alias("keys"), F.count(F.lit(1)).alias("rows"),
    ).first()
    if not found["rows"]:
        return []
    least, most = -(1 << 63), (1 << 63) - 1

    def cut_up(there: int, value: int, times: int) -> list[tuple[int, int, int]]:
        """Ends of a value's ranges of hashes; before them the end of what is smaller."""
        inner = [(there, value, least + (i << 64) // times) for i in range(1, times)]
        return [*([(there, value, least)] if inner and there else []), *inner, (there, value, most)]

    nulls = found["rows"] - found["keys"]
    cuts = cut_up(0, 0, max(1, round(parts * nulls / found["rows"]))) if nulls else []
    for value, times in sorted(Counter(found["q"] or []).items()):
        cuts += cut_up(1, value, times)
    return cuts


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness.

    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    The next document is the following one by descending key (nulls last, ties in a fixed order;
    after the last comes the first; a single row follows itself). Null texts are empty. Repeated
    rows keep their rows; other columns do not matter; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = in_sequence(docs, key, text, parts)
    out = T.StructType([rows.schema["key"], *T.StructType.fromDDL(
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    ).fields])

    def run(batches):
        waiting = None  # (key, text, lanes, bucket) of the row whose next is still to come
        for batch in batches:
            keys, texts = batch["key"].to_pylist(), batch["text"].to_pylist()
            buckets, closing = batch["bucket"].to_pylist(), batch["closing"].to_pylist()
            lanes = fingerprint(texts)
            pairs = []
            for i in range(len(texts)):
                if waiting is not None and waiting[3] == buckets[i]:
                    pairs.append((*waiting[:3], texts[i], lanes[i]))
                waiting = None if closing[i] else (keys[i], texts[i], lanes[i], buckets[i])
            changed = [edited(p[1], p[3]) for p in pairs]
            own = np.array([p[2] for p in pairs], np.uint64).reshape(-1, LANES)
            following = np.array([p[4] for p in pairs], np.uint64).reshape(-1, LANES)
            after = fingerprint(changed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p[0] for p in pairs], batch["key"].type),
                    pa.array([len(p[1]) for p in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    pa.array([to_hex(x) for x in own], pa.string()),
                    pa.array([to_hex(x) for x in after], pa.string()),
                    pa.array(likeness(own, after)), pa.array(likeness(own, following)),
                ],
                out.names,
            )

    return rows.mapInArrow(run, out).withColumnRenamed("key", key)
