"""Language identification by mixtures: EM over letter trigrams, languages chosen by penalised likelihood.

A mixture has one component more than there are languages: in it every trigram is as likely as any other.
It takes the letters that no learned language explains, and is kept or dropped like a language.
"""

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.runtime import prepare, ragged, stored, utf8

BUCKETS = 1 << 16
#: Cells (trigrams times languages) that are worked on at once.
CELLS = 500_000
#: Languages whose probabilities are worked on at once; the number of languages has no bound.
BLOCK = 64
#: Counts of (label, trigram) that a task of the training holds before it passes them on.
HELD = 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """Bounds and constants of training and inference."""

    #: Documents per language that training reads, about; chosen by a hash of the key.
    sample: int = 3000
    #: Added to each trigram count.
    smoothing: float = 0.05
    rounds: int = 25
    #: Log-likelihood that a further language has to gain, times the log of the letters.
    penalty: float = 3.0


@dataclass(frozen=True)
class Block:
    """Probabilities of the trigrams in up to ``BLOCK`` languages; only trigrams of the sample are held."""

    #: Where the entries of each bucket begin (and the end); an entry's language within the block.
    starts: np.ndarray
    column: np.ndarray
    probability: np.ndarray
    #: Probability in each language of a trigram its sample does not have.
    base: np.ndarray

    def likelihood(self, bucket: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Probability of each trigram (rows) in some languages of the block (columns)."""
        out = np.repeat(self.base[None, :].astype(float), len(bucket), axis=0)
        low = self.starts[bucket]
        size = self.starts[bucket + 1] - low
        at = ragged(low, size)
        out[np.repeat(np.arange(len(bucket)), size), self.column[at]] = self.probability[at]
        return out if len(columns) == out.shape[1] else out[:, columns]


@dataclass(frozen=True)
class Resting:
    """A broadcast block that is read from Spark's copy when asked, and let go of afterwards."""

    block: Broadcast

    def likelihood(self, bucket: np.ndarray, columns: np.ndarray) -> np.ndarray:
        found = self.block.value.likelihood(bucket, columns)
        self.block.__dict__.pop("_value", None)  # what a broadcast keeps of a value once read
        return found


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: ``BLOCK`` consecutive languages each, as they are or broadcast.
    blocks: list

    def opened(self) -> "Model":
        """With blocks that can be read here; several are never in memory together."""
        if len(self.blocks) == 1:
            return Model(self.languages, [b.value if isinstance(b, Broadcast) else b for b in self.blocks])
        return Model(self.languages, [Resting(b) if isinstance(b, Broadcast) else b for b in self.blocks])

    def likelihood(self, bucket: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Probability of each trigram (rows) in some languages (ascending columns; last: none of them)."""
        known = columns[columns < len(self.languages)]
        parts = [
            self.blocks[b].likelihood(bucket, known[known // BLOCK == b] - b * BLOCK)
            for b in np.unique(known // BLOCK)
        ]
        if len(known) < len(columns):
            parts.append(np.full((len(bucket), 1), 1 / BUCKETS))
        return parts[0] if len(parts) == 1 else np.concatenate(parts, axis=1)


@functools.cache
def folded() -> np.ndarray:
    """Lower-case code point of each letter, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        letter = chr(c)
        if letter.isalpha():
            lower = letter.lower()
            table[c] = ord(lower) if len(lower) == 1 else c
    return table


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around each letter, and the row it belongs to.

    Letters are lower-cased; everything else counts as a gap, so trigrams stay within words.
    """
    data, docs = utf8(texts)
    cp = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    at = np.concatenate(([0], np.cumsum(1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF))))
    starts = np.searchsorted(at, docs)
    x = folded()[cp]
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    edge = starts[(starts > 0) & (starts < len(x))]
    before[edge] = 0
    after[edge - 1] = 0
    letters = np.flatnonzero(x)
    mixed = (
        before[letters].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        + x[letters].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        + after[letters].astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    )
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    row = np.searchsorted(starts, letters, side="right") - 1
    return (mixed >> np.uint64(48)).astype(np.int64), row


def sampled(hashed: Column, size: Column, sample: int) -> Column:
    """Whether a 64-bit hash is among the share sample / size of smallest ones, for any size."""
    step = F.call_function("div", F.lit(2**63 - 1), size)
    return F.when(size <= sample, True).otherwise(F.shiftrightunsigned(hashed, 1) < step * sample)


def train(docs: DataFrame, use: Column | None = None, settings: Settings = Settings(),
          key: str = "doc_id", text: str = "text", label: str = "lang") -> Model:
    """Trigram counts per language over a sample of the labelled rows that ``use`` admits.

    Every label is learned. Rows per label are counted over the whole table first. Each language then
    gives about ``settings.sample`` whole texts, those with the smallest hashes of key and text. Rows
    without label or text teach nothing; without any the model has no language. Counts stay in the
    shared folder; the driver takes them up a block of languages at a time.
    """
    spark = docs.sparkSession
    prepare(spark)
    labelled = docs.select(
        docs[text].alias("text"), docs[label].cast("string").alias("label"),
        F.xxhash64(docs[key].cast("string"), docs[text]).alias("hash"),
        (F.lit(True) if use is None else use).alias("use"),
    ).where("use and text is not null and label is not null")
    sizes = stored(labelled.groupBy("label").agg(F.count("*").alias("size")), "labels")
    languages = sorted(r["label"] for r in sizes.select("label").collect())
    if not languages:
        return Model([], [])
    sample = labelled.join(F.broadcast(sizes), "label").where(  # a row per label
        sampled(F.col("hash"), F.col("size"), settings.sample)
    )

    def count(batches):
        numbers: dict[str, int] = {}
        held, size = [], 0

        def merged():
            cells, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            return cells, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        def rows():
            cells, n = merged()
            names = pa.array(list(numbers), pa.string()).take(pa.array(cells // BUCKETS))
            return pa.RecordBatch.from_arrays(
                [names, pa.array(cells % BUCKETS), pa.array(n)], ["label", "bucket", "n"]
            )

        for batch in batches:
            buckets, row = trigrams(batch["text"])
            own = np.array([numbers.setdefault(x, len(numbers)) for x in batch["label"].to_pylist()], np.int64)
            held.append(np.unique(own[row] * BUCKETS + buckets, return_counts=True))
            size += len(held[-1][0])
            if size >= HELD:
                held = [merged()]
                size = len(held[0][0])
                if size >= HELD // 2:
                    yield rows()
                    numbers, held, size = {}, [], 0
        if held:
            yield rows()

    counted = sample.select("text", "label").mapInArrow(count, "label string, bucket long, n long")
    total = stored(counted.groupBy("label", "bucket").agg(F.sum("n").alias("n")).sort("label"), "trigrams")
    blocks = []
    for first in range(0, len(languages), BLOCK):
        names = languages[first:first + BLOCK]
        own = total.where(F.col("label").between(names[0], names[-1])).toArrow()
        blocks.append(spark.sparkContext.broadcast(_block(
            np.searchsorted(names, own["label"].to_pylist()) if len(own) else np.zeros(0, np.int64),
            own["bucket"].to_numpy(), own["n"].to_numpy(), len(names), settings.smoothing,
        )))
    return Model(languages, blocks)


def _block(column, bucket, n, width: int, smoothing: float) -> Block:
    """Smoothed probabilities of counts."""
    order = np.lexsort((column, bucket))
    column, bucket, n = column[order], bucket[order], n[order]
    whole = np.bincount(column, weights=n, minlength=width) + smoothing * BUCKETS
    return Block(
        np.searchsorted(bucket, np.arange(BUCKETS + 1)), column.astype(np.uint16),
        ((n + smoothing) / whole[column]).astype(np.float32), (smoothing / whole).astype(np.float32),
    )


def mixtures(bucket: np.ndarray, row: np.ndarray, rows: int, model: Model,
             settings: Settings) -> np.ndarray:
    """Language proportions (rows by languages) of the letters given; zeros for rows without any.

    What a row lacks to 1 is the share of letters in no learned language.
    """
    out = np.zeros((rows, len(model.languages)))
    if not len(bucket) or not model.languages:
        return out
    model = model.opened()
    pairs, counts = np.unique(row.astype(np.int64) * BUCKETS + bucket, return_counts=True)
    row, bucket = pairs // BUCKETS, pairs % BUCKETS
    present, starts = np.unique(row, return_index=True)
    ends = np.append(starts[1:], len(row))
    step = max(1, CELLS // min(len(model.languages), BLOCK))
    texts = max(1, CELLS // len(model.languages))
    low = 0
    while low < len(present):  # whole rows, so many cells at a time
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + step, side="right")))
        high = min(high, low + texts)
        span = slice(starts[low], ends[high - 1])
        out[present[low:high]] = _estimate(
            model, bucket[span], counts[span].astype(float), starts[low:high] - starts[low], settings,
        )[:, :-1]
        low = high
    return out


def _fit(model, bucket, counts, starts, share, rounds) -> tuple[np.ndarray, np.ndarray]:
    """Shares after so many rounds of EM, and their log-likelihood.

    Each round goes through the languages a block at a time; up to ``BLOCK`` are looked up once.
    """
    columns = np.flatnonzero(share.any(axis=0))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(counts))))
    letters = np.add.reduceat(counts, starts)[:, None]
    parts = np.split(columns, range(BLOCK, len(columns), BLOCK))
    looked_up = model.likelihood(bucket, columns) if len(parts) == 1 else None
    share = share.copy()

    def swept(weight):
        fitted = np.zeros(len(counts))
        for part in parts:
            likelihood = model.likelihood(bucket, part) if looked_up is None else looked_up
            if weight is not None:
                share[:, part] *= np.add.reduceat(likelihood * weight[:, None], starts, axis=0) / letters
            fitted += np.einsum("ij,ij->i", likelihood, share[:, part][group])
        return fitted

    fitted = swept(None)
    for _ in range(rounds):
        fitted = swept(counts / fitted)
    return share, np.add.reduceat(counts * np.log(fitted), starts)


def _restrict(share, keep) -> np.ndarray:
    share = np.where(keep, share, 0)
    total = share.sum(axis=1, keepdims=True)
    return np.where(total > 0, share / np.where(total > 0, total, 1), share)


def _estimate(model, bucket, counts, starts, settings) -> np.ndarray:
    """Shares of the languages that penalised likelihood keeps and, last, of no language.

    The largest language stays, however small, so that each text has one to name. The weakest languages go together as long as the text loses less than the price of one by it, with
    the other shares merely scaled up: so what any of them can gain is below its price. All others are
    tried one by one, weakest first; without one the shares are fitted anew.
    """
    sizes = np.diff(np.append(starts, len(counts)))
    letters = np.add.reduceat(counts, starts)
    price = settings.penalty * np.log(letters + 1)
    n_parts = len(model.languages) + 1
    everything = np.full((len(starts), n_parts), 1 / n_parts)
    share, score = _fit(model, bucket, counts, starts, everything, settings.rounds)
    keep = share > 0
    needed = np.zeros_like(keep)  # tried already
    main = np.arange(len(starts)), share[:, :-1].argmax(axis=1)
    needed[main] = True
    while True:
        rows = np.flatnonzero((keep & ~needed).any(axis=1))
        if not len(rows):
            share[main] = np.maximum(share[main], np.finfo(float).tiny)
            return share
        used = np.repeat(np.isin(np.arange(len(starts)), rows), sizes)
        own = bucket[used], counts[used], np.concatenate(([0], np.cumsum(sizes[rows])[:-1]))
        order = np.argsort(np.where(keep & ~needed, share, np.inf)[rows], axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(n_parts)[None, :], axis=1)
        # The most that may go at once lies in [low, high).
        low = np.zeros(len(rows), np.int64)
        high = (keep & ~needed)[rows].sum(axis=1) + 1
        while (high - low > 1).any():
            middle = (low + high) // 2
            _, left = _fit(model, *own, _restrict(share[rows], keep[rows] & (rank >= middle[:, None])), 0)
            enough = left + price[rows] >= score[rows]
            low, high = np.where(enough, middle, low), np.where(enough, high, np.maximum(middle, low + 1))
        fewer = keep[rows] & (rank >= np.maximum(low, 1)[:, None])
        without, its_score = _fit(model, *own, _restrict(share[rows], fewer), settings.rounds // 2)
        drop = its_score + price[rows] >= score[rows]
        gone = rows[drop]
        keep[gone], share[gone], score[gone] = fewer[drop], without[drop], its_score[drop]
        needed[rows[~drop], order[~drop, 0]] = True


def identify(docs: DataFrame, model: Model, settings: Settings = Settings(),
             text: str = "text") -> DataFrame:
    """All columns as the struct ``row``, and lang_pred, score, unknown, languages, of every row.

    ``languages`` has each chosen language's proportion; lang_pred is the largest (ties: first by
    name) and score its proportion. ``unknown`` is the proportion of letters that no learned language
    explains: a text of random letters has nearly 1, and a language's name all the same. A null text, one without letter and every text under a model
    without languages is ``und`` with score and ``unknown`` 0. Only the text decides. Keys may be null or repeated,
    columns may have any names; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    names = spark.sparkContext.broadcast(model.languages)
    blocks = model.blocks

    def predict(batches):
        model = Model(names.value, blocks).opened()
        for batch in batches:
            buckets, row = trigrams(batch["text"])
            share = mixtures(buckets, row, len(batch), model, settings)
            known = share.sum(axis=1) > 0 if model.languages else np.zeros(len(batch), bool)
            best = share.argmax(axis=1) if model.languages else np.zeros(len(batch), int)
            chosen = [
                [{"lang": model.languages[j], "share": float(p[j])} for j in np.flatnonzero(p)] for p in share
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    pa.array([model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]),
                    pa.array(np.where(known, share.max(axis=1, initial=0), 0.0).clip(0, 1)),
                    pa.array(np.where(known, 1 - share.sum(axis=1), 0.0).round(12).clip(0, 1)),
                    pa.array(chosen, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
                ],
                ["row", "lang_pred", "score", "unknown", "languages"],
            )

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"))
    found = T.StructType.fromDDL(
        "lang_pred string, score double, unknown double, languages array<struct<lang:string,share:double>>"
    )
    return rows.mapInArrow(predict, T.StructType([rows.schema["row"], *found.fields]))
