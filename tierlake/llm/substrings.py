"""Removal of passages that repeat: windows of words, partitioned as super-k-mers, counted by sorting.

The minimiser of a window is its word of lowest rank: words in order of their hashes, then frequent
words by their counts, rarer ones first. A window of frequent words only has a second minimiser, the next
word in rank, so that its bucket is one of many for the same word. Consecutive windows with the same
minimisers travel to their bucket as one packed string (their words, a space between), so a word is sent
about three times and not once per window. Equal windows have equal minimisers and meet in one bucket.
A map task sends what it has for a bucket as one compressed parcel.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.runtime import prepare, slices, stored, utf8

#: Windows of a super-k-mer at most; longer stretches of one minimiser are cut.
STRETCH = 256
#: Bytes of packed strings that a bucket should hold; they are sorted together.
BUCKET_BYTES = 4 * 1024**2
#: Buckets per partition at least, so that partitions come out even.
BUCKETS = 4
#: Bytes of text from which a map task combines equal packed strings.
COMBINE = 4 * 1024**2
#: A word is frequent if it makes up this share of what one partition would hold.
FREQUENT = 1 / 20
#: Bytes that a word of a text brings about in packed strings, about.
SENT_BYTES = 20
#: Occurrences within a task from which a word is counted: less often in all tasks is not frequent.
COUNTED = 4


def words_of(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of concatenated texts.

    Their bytes end to end, their offsets there, and the first word of each text (and the end).
    """
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    solid = ~blank
    starts = solid.copy()
    starts[1:] &= blank[:-1]
    inner = docs[(docs > 0) & (docs < len(data))]
    starts[inner] = solid[inner]
    at = np.flatnonzero(starts)
    kept = np.concatenate(([0], np.cumsum(solid)))
    return data[solid], np.append(kept[at], kept[-1]), np.searchsorted(at, docs)


def spaced(compact: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words with a space after each, and where each begins (and the end)."""
    starts = offsets + np.arange(len(offsets))
    out = np.empty(len(compact) + len(offsets) - 1, np.uint8)
    gap = np.zeros(len(out), bool)
    gap[starts[1:] - 1] = True
    out[~gap] = compact
    out[gap] = 32
    return out.tobytes(), starts


def word_hashes(compact: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit hash of each word; each distinct word is hashed once."""
    coded = slices(compact, offsets).dictionary_encode()
    own = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return own[coded.indices.to_numpy()]


def frequent_words(texts: DataFrame, parts: int) -> tuple[np.ndarray, int]:
    """Hashes of words so frequent that as minimisers they would weigh on one partition, from the
    rarest to the most frequent one, and the number of all words.

    A share of ``FREQUENT`` / parts of all words makes a word frequent, so there are at most
    parts / ``FREQUENT`` of them. They only decide where windows meet, not what is found.
    """
    def count(batches):
        total, counts = 0, {}
        held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        waiting = []
        def merge():
            keys = np.concatenate([held[0], *[w[0] for w in waiting]])
            n = np.concatenate([held[1], *[w[1] for w in waiting]])
            keys, at = np.unique(keys, return_inverse=True)
            return keys, np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)
        for batch in batches:
            compact, offsets, _ = words_of(*utf8(batch["text"]))
            coded = slices(compact, offsets).dictionary_encode()
            n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            often = np.flatnonzero(n > 1)
            own = coded.dictionary.take(pa.array(often)).to_pylist()
            waiting.append((np.array([xxhash.xxh64_intdigest(w) for w in own], np.uint64), n[often]))
            total += len(offsets) - 1
            if len(waiting) >= 16:
                held, waiting = merge(), []
        keys, n = merge()
        keep = n >= COUNTED
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(keys[keep], np.uint64(0)).view(np.int64)), pa.array(np.append(n[keep], 0)),
             pa.array(np.append(np.zeros(keep.sum(), np.int64), total))],
            ["word", "n", "total"],
        )

    counted = texts.select("text").mapInArrow(count, "word long, n long, total long")
    counts = stored(counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "words")
    total = counts.agg(F.sum("total")).first()[0] or 0
    limit = max(64, int(total * FREQUENT / parts))
    often = counts.where(F.col("n") >= limit).select("word", "n").toArrow()
    word, n = often["word"].to_numpy().view(np.uint64), often["n"].to_numpy()
    return word[np.lexsort((word, n))], total


#: No word; also the first rank of frequent words.
NONE, FREQUENT_FROM = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(1 << 63)


def ranks(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Ranks of words given by hash: half the hash, but frequent words last, in their order."""
    rank = hashes >> np.uint64(1)
    if len(frequent):
        order = np.argsort(frequent)
        at = order[np.searchsorted(frequent, hashes, sorter=order).clip(max=len(frequent) - 1)]
        rank = np.where(frequent[at] == hashes, FREQUENT_FROM + at.astype(np.uint64), rank)
    return rank


def minimisers(rank: np.ndarray, width: int) -> np.ndarray:
    """What decides the bucket of each window of ``width`` words: a hash of its least rank, and of the
    next one if the least is a frequent word's."""
    def merged(a, b):
        least = np.minimum(a[0], b[0])
        second = np.minimum(np.where(a[0] == least, a[1], a[0]), np.where(b[0] == least, b[1], b[0]))
        return least, second

    def part(x, low, n):
        return x[0][low:low + n], x[1][low:low + n]

    held, span = (rank, np.full(len(rank), NONE)), 1  # of the span of words from each on
    while span * 2 <= width:
        n = len(held[0]) - span
        held, span = merged(part(held, 0, n), part(held, span, n)), span * 2
    windows = len(rank) - width + 1
    least, second = merged(part(held, 0, windows), part(held, width - span, windows))
    key = np.where(least < FREQUENT_FROM, least, least * np.uint64(0x9E3779B97F4A7C15) ^ second)
    key = (key ^ key >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return key ^ key >> np.uint64(32)


#: What a parcel holds besides the strings: their sizes, places, and lengths of known repeats.
COLUMNS = (("size", "<i4"), ("none", "?"), ("doc", "<i8"), ("hash", "<i8"), ("start", "<i4"), ("n", "<i4"))
PLACE = ("none", "doc", "hash", "start")
CODEC = pa.Codec("zstd", compression_level=5)


def parcel(columns: dict[str, np.ndarray], strings: bytes) -> bytes:
    """Rows and their strings, compressed."""
    raw = b"".join([columns[c].astype(kind).tobytes() for c, kind in COLUMNS]) + strings
    head = np.array([len(raw), len(columns["size"])], "<i8").tobytes()
    return head + CODEC.compress(raw, asbytes=True)


def unpacked(parcels: list[bytes]) -> tuple[dict[str, np.ndarray], pa.Array]:
    """Rows and strings of several parcels."""
    parts, strings = [], []
    for p in parcels:
        size, rows = (int(x) for x in np.frombuffer(p, "<i8", 2))
        raw, at, part = CODEC.decompress(p[16:], size, asbytes=True), 0, {}
        for c, kind in COLUMNS:
            part[c] = np.frombuffer(raw, kind, rows, at)
            at += part[c].nbytes
        parts.append(part)
        strings.append(raw[at:])
    columns = {c: np.concatenate([part[c] for part in parts]) for c, _ in COLUMNS}
    ends = np.concatenate(([0], np.cumsum(columns["size"], dtype=np.int64)))
    return columns, slices(np.frombuffer(b"".join(strings), np.uint8), ends)


def same_place(places) -> np.ndarray:
    """Whether a place (none, doc, hash, start) equals the one before."""
    same = np.ones(len(places[0]), bool)
    same[:1] = False
    for p in places:
        same[1:] &= p[1:] == p[:-1]
    return same


def super_kmers(none, doc, text_hash, texts: pa.Array, width: int, frequent: np.ndarray,
                buckets: int) -> pa.RecordBatch:
    """Parcels of the packed strings of all windows of some texts, one per bucket.

    Each distinct string is sent once, with its first place. Later places of an equal string repeat
    an earlier one: they travel without the string, to any bucket. A place that occurs again, as
    rows that repeat key and text bring it about, is the same place and not sent.
    """
    nothing = pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.binary())], ["bucket", "parcel"])
    data, docs = utf8(texts)
    compact, offsets, first = words_of(data, docs)
    n = len(offsets) - 1
    if n < width:
        return nothing
    least = minimisers(ranks(word_hashes(compact, offsets), frequent), width)
    windows = n - width + 1
    row = np.searchsorted(first, np.arange(windows), side="right") - 1
    valid = np.arange(windows) + width <= first[row + 1]
    at = np.flatnonzero(valid)
    if not len(at):
        return nothing
    least, row = least[at], row[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    runs = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))
    runs = np.flatnonzero(place % STRETCH == 0)
    count = np.diff(np.append(runs, len(at)))
    start, row, least = at[runs], row[runs], least[runs]
    joined, word_at = spaced(compact, offsets)
    low, high = word_at[start], word_at[start + count + width - 1] - 1
    packed = pa.array([joined[s:e] for s, e in zip(low.tolist(), high.tolist(), strict=True)], pa.binary())
    code = packed.dictionary_encode().indices.to_numpy()
    start = start - first[row]
    order = np.lexsort((start, text_hash[row], doc[row], none[row], code))
    row, start, code, low, high, count, least = (x[order] for x in (row, start, code, low, high, count, least))
    repeat = np.concatenate(([False], code[1:] == code[:-1]))
    once = ~(repeat & same_place((none[row], doc[row], text_hash[row], start)))
    row, start, low, high, count, least, repeat = (x[once] for x in (row, start, low, high, count, least, repeat))
    goes = np.where(repeat, text_hash[row].view(np.uint64), least) % np.uint64(buckets)
    order = np.argsort(goes, kind="stable")
    goes, row, repeat = goes[order], row[order], repeat[order]
    sizes = np.where(repeat, 0, (high - low)[order])
    columns = {
        "size": sizes, "none": none[row], "doc": doc[row], "hash": text_hash[row], "start": start[order],
        "n": np.where(repeat, (count + width - 1)[order], 0),
    }
    low, high = low[order], low[order] + sizes
    strings = [joined[s:e] for s, e in zip(low.tolist(), high.tolist(), strict=True)]
    edges = np.flatnonzero(np.concatenate(([True], goes[1:] != goes[:-1], [True]))).tolist()
    parcels = [
        parcel({c: v[a:b] for c, v in columns.items()}, b"".join(strings[a:b]))
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(goes[edges[:-1]].astype(np.int32)), pa.array(parcels, pa.binary())], ["bucket", "parcel"]
    )


def repeated_windows(packed: pa.Array, places: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Places (none, doc, hash, start) and lengths of windows that repeat an earlier one.

    ``packed`` are the distinct strings of a bucket with the first place of each. All windows are
    hashed over word codes; those with equal hashes are sorted by place and compared word by word.
    """
    compact, offsets, first = words_of(*utf8(packed))
    coded = slices(compact, offsets).dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    mixed = code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    windows = max(0, len(code) - width + 1)
    value = np.zeros(windows, np.uint64)
    for j in range(width):
        value *= np.uint64(0x2545F4914F6CDD1D)
        value += mixed[j:j + windows]
    row = np.searchsorted(first, np.arange(windows), side="right") - 1
    at = np.flatnonzero(np.arange(windows) + width <= first[row + 1])
    value = value[at]
    order = np.argsort(value, kind="stable")
    same = value[order[1:]] == value[order[:-1]]
    several = np.zeros(len(order), bool)
    several[1:] |= same
    several[:-1] |= same
    at = at[order[several]]
    if not len(at):
        return [p[:0] for p in places] + [np.zeros(0, np.int64)]
    value, row = value[order[several]], row[at]
    none, doc, text_hash, start = (p[row] for p in places)
    start = start + at - first[row]
    order = np.lexsort((start, text_hash, doc, none, value))
    at, value = at[order], value[order]
    head = np.maximum.accumulate(np.where(np.concatenate(([True], value[1:] != value[:-1])), np.arange(len(at)), 0))
    equal = np.ones(len(at), bool)
    for j in range(width):
        equal &= code[at + j] == code[at[head] + j]
    if not equal.all():  # two different windows with one hash: tell them apart by their words
        seen: dict[tuple, int] = {}
        for i in range(len(at)):
            head[i] = seen.setdefault(tuple(code[at[i]:at[i] + width]), i)
    later = np.zeros(len(at), bool)  # an equal place is no earlier one
    for p in (none[order], doc[order], text_hash[order], start[order]):
        later |= p != p[head]
    hit = order[later]
    none, doc, text_hash, start = none[hit], doc[hit], text_hash[hit], start[hit]
    # Neighbouring windows of a text become one stretch.
    order = np.lexsort((start, text_hash, doc, none))
    none, doc, text_hash, start = none[order], doc[order], text_hash[order], start[order]
    if not len(start):
        return [none, doc, text_hash, start, np.zeros(0, np.int64)]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] > start[:-1] + 1) | (doc[1:] != doc[:-1]) | (text_hash[1:] != text_hash[:-1]) | (none[1:] != none[:-1])
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(start)) - 1
    return [none[low], doc[low], text_hash[low], start[low], start[high] - start[low] + width]


def repeats(docs: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """``none, doc, hash, start, n``: stretches of words to remove, by key and hash of the text.

    Stretches may overlap and come several times. ``none`` marks a null key.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        docs[key].isNull().alias("none"), F.coalesce(docs[key].cast("long"), F.lit(0)).alias("doc"),
        F.xxhash64(docs[text]).alias("hash"), docs[text].alias("text"),
    ).where("text is not null")
    often, words = frequent_words(rows, parts)
    frequent = spark.sparkContext.broadcast(often)
    buckets = parts * max(BUCKETS, math.ceil(words * SENT_BYTES / parts / BUCKET_BYTES))

    def send(batches):
        held, size = [], 0

        def packed():
            rows = pa.Table.from_batches(held).combine_chunks()
            places = [rows[c].to_numpy() for c in ("none", "doc", "hash")]
            return super_kmers(*places, rows["text"], width, frequent.value, buckets)

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= COMBINE:
                yield packed()
                held, size = [], 0
        if held:
            yield packed()

    def receive(batches):
        held, bucket = [], None

        def sorted_out():
            columns, strings = unpacked(held)
            code = strings.dictionary_encode().indices.to_numpy().astype(np.int64)
            again = columns["n"] > 0
            code[again] = -1
            order = np.lexsort([columns[c] for c in reversed(PLACE)] + [code])
            equal = np.zeros(len(code), bool)
            equal[order[1:]] = code[order[1:]] == code[order[:-1]]
            same = np.zeros(len(code), bool)  # a repeated row's place, not a later one
            same[order] = same_place([columns[c][order] for c in PLACE])
            first = np.flatnonzero(~equal & ~again)
            n = columns["n"].astype(np.int64)
            later = equal & ~same & ~again
            own = strings.filter(pa.array(later))  # equal strings: the first place stays
            n[later] = np.diff(words_of(*utf8(own))[2])
            sure = [columns[c][later | again] for c in PLACE] + [n[later | again]]
            found = repeated_windows(strings.take(pa.array(first)), [columns[c][first] for c in PLACE], width)
            both = [np.concatenate(x) for x in zip(sure, found, strict=True)]
            order = np.lexsort(both[::-1])
            both = [x[order] for x in both]
            both = [x[~same_place(both)] for x in both]
            return pa.RecordBatch.from_arrays(
                [pa.array(x if c == "none" else x.astype(np.int64)) for x, c in zip(both, (*PLACE, "n"), strict=True)],
                [*PLACE, "n"],
            )

        for batch in batches:
            for number, content in zip(batch["bucket"].to_pylist(), batch["parcel"].to_pylist(), strict=True):
                if number != bucket and held:
                    yield sorted_out()
                    held = []
                bucket = number
                held.append(content)
        if held:
            yield sorted_out()

    sent = rows.mapInArrow(send, "bucket int, parcel binary")
    dealt = sent.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(receive, "none boolean, doc long, hash long, start long, n long")


def _stored_repeats(docs: DataFrame, width: int, key: str, text: str) -> DataFrame:
    found = repeats(docs, width, key, text)
    by_text = found.groupBy("none", "doc", "hash").agg(F.collect_set(F.struct("start", "n")).alias("cuts"))
    return stored(by_text, "repeats")


def cut(text: str, cuts: list[dict]) -> tuple[list[bytes], int]:
    """Words that stay, and how many go."""
    words = text.encode().split()
    edge = np.zeros(len(words) + 1, np.int64)
    for c in cuts:
        edge[c["start"]] += 1
        edge[c["start"] + c["n"]] -= 1
    keep = np.cumsum(edge)[:-1] == 0
    stay = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
    return stay, len(words) - len(stay)


def remove_repeats(docs: DataFrame, width: int = 20, key: str = "doc_id", text: str = "text",
                   carry: list[str] | None = None, with_kept: bool = True) -> DataFrame:
    """The columns ``carry`` (default all) as the struct ``row``, and n_words, n_removed, kept_sha256.

    ``with_kept`` adds ``kept``, the words that stay, joined by a space; the hash is of its UTF-8.

    A word goes if a window of ``width`` consecutive words covers it whose words also start at an
    earlier place: a smaller key (an integer; null last; of equal keys the smaller hash of the
    text), or earlier in the same text. Windows are judged on the input. Rows that repeat both key and
    text are one document and all get the result of one. A null text has no words; texts shorter than a window stay as they are.
    Other columns may have any names; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    cuts = _stored_repeats(docs, width, key, text)
    rows = docs.select(
        F.struct(*[docs[c] for c in carry or docs.columns]).alias("row"), docs[text].alias("text"),
        docs[key].isNull().alias("own_none"), F.coalesce(docs[key].cast("long"), F.lit(0)).alias("own_doc"),
        F.xxhash64(docs[text]).alias("own_hash"),
    )
    joined = rows.join(
        cuts, (rows["own_none"] == cuts["none"]) & (rows["own_doc"] == cuts["doc"])
        & (rows["own_hash"] == cuts["hash"]), "left",
    ).select("row", "text", "cuts")

    def apply(batches):
        for batch in batches:
            done = [cut(t or "", c or []) for t, c in
                    zip(batch["text"].to_pylist(), batch["cuts"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"], pa.array([len(w) + gone for w, gone in done], pa.int64()),
                    pa.array([gone for _, gone in done], pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w, _ in done], pa.string()),
                    *([pa.array([b" ".join(w).decode() for w, _ in done], pa.string())] if with_kept else []),
                ],
                ["row", *found.names],
            )

    found = T.StructType.fromDDL(
        "n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_kept
    )
    return joined.mapInArrow(apply, T.StructType([rows.schema["row"], *found.fields]))
