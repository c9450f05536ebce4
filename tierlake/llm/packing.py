"""Packing of documents into fixed-length sequences: shortest pack first over the length histogram."""

import heapq
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.pretokens import word_table
from tierlake.llm.runtime import prepare, stored, text_or_empty

#: A run is a document's full pieces together, or its last piece.
RUN = pa.struct([
    ("start", pa.int64()), ("length", pa.int64()), ("n", pa.int64()), ("seq", pa.int64()),
    ("crc32", pa.list_(pa.int64())), ("ids", pa.list_(pa.binary())),
])
RUN_DDL = (
    "array<struct<start:long,length:long,n:long,seq:long,crc32:array<long>,ids:array<binary>>>"
)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns as (how many sequences, lengths of their pieces), for counts per length.

    Lengths are placed longest first, each piece into the shortest sequence, that with most room.
    Pieces of a length are placed many at a time: one in every sequence of the pattern with most
    room, or, where no sequence has room, as many as fit into each of new ones. The work depends
    on the number of distinct lengths, not on the number of pieces.
    """
    open_packs: dict[int, list] = defaultdict(list)  # room -> [(sequences, lengths)]
    rooms: list[int] = []  # heap of negative rooms
    done = []

    def put(n, lengths, room):
        if not room:
            done.append((n, lengths))
            return
        if room not in open_packs:
            heapq.heappush(rooms, -room)
        open_packs[room].append((n, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if rooms and -rooms[0] >= length:
                room = -rooms[0]
                n, lengths = open_packs[room].pop()
                if not open_packs[room]:
                    del open_packs[room]
                    heapq.heappop(rooms)
                used = min(n, left)
                if used < n:
                    put(n - used, lengths, room)
                put(used, (*lengths, length), room - length)
                left -= used
            else:
                fit = size // length
                for n, count in ((left // fit, fit), (1, left % fit)):
                    if n and count:
                        put(n, (length,) * count, size - count * length)
                left = 0
    return done + [pack for packs in open_packs.values() for pack in packs]


def placements(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """For every length and rank within it, where it goes: ranges of ranks, sorted.

    A pattern's sequences are numbered one after the other; each of its slots takes as many ranks
    of its length as the pattern has sequences.
    """
    next_rank: dict[int, int] = defaultdict(int)
    rows, first = [], 0
    for n, lengths in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, next_rank[length], first, offset))
            next_rank[length] += n
            offset += length
        first += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T, strict=True))


#: Ranks stay below this, lengths times this below 2^63.
RANKS = 1 << 44


def token_runs(docs: DataFrame, tokenizer: str, size: int, end_id: int, key: str, text: str,
               with_ids: bool) -> DataFrame:
    """Token ids of each row, cut into full pieces and a last piece, with checksums per piece.

    ``task`` and ``seq`` number the pieces of a length within the writing task.
    """
    rows = docs.select(docs[key].alias("key"), text_or_empty(text).alias("text"))

    def cut(batches):
        table, task = word_table(tokenizer), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            ids, at = table.ids(batch["text"])
            ids = ids.astype("<u4")
            totals, runs = [], []
            for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = np.append(ids[low:high], np.uint32(end_id)).tobytes()
                n = len(own) // 4
                totals.append(n)
                runs.append([])
                for start, length, count in ((0, size, n // size), (n - n % size, n % size, 1)):
                    if not length or not count:
                        continue
                    parts = [own[4 * (start + i * length):4 * (start + (i + 1) * length)] for i in range(count)]
                    runs[-1].append({
                        "start": start, "length": length, "n": count, "seq": seen[length],
                        "crc32": [zlib.crc32(p) for p in parts], "ids": parts if with_ids else None,
                    })
                    seen[length] += count
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(totals, pa.int64()),
                 pa.array([task] * len(totals), pa.int64()), pa.array(runs, pa.list_(RUN))],
                ["key", "doc_tokens", "task", "runs"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(cut, f"key {kind}, doc_tokens long, task long, runs {RUN_DDL}")


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, key: str = "doc_id",
         text: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of all rows with their place in sequences of at most ``size`` tokens.

    Columns: key, start, length, ids_crc32, doc_tokens, sequence_id, offset and, ``with_ids``, the
    piece's token ids as little-endian 32-bit numbers. A row's ids end with ``end_id``. Full pieces
    fill a sequence each; what is left of a row is one shorter piece. The counts per length (at
    most ``size`` numbers) go to the driver, which packs them shortest pack first; each piece finds
    its slot by its rank among the pieces of its length. Ranks come from numbers given by the
    tasks that wrote the pieces, so no length is gathered in one task.

    Null and empty texts have the one piece that holds ``end_id``. Null or repeated keys keep their
    rows; equal rows take different slots. Other columns do not matter. No row, no piece.
    """
    spark = docs.sparkSession
    prepare(spark)
    runs = token_runs(docs, tokenizer, size, end_id, key, text, with_ids)
    rows = stored(runs, "packing-runs").withColumn("run", F.explode("runs"))
    counts = (
        rows.groupBy("task", F.col("run.length").alias("length")).agg(F.sum("run.n").alias("n"))
    )
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first_ranks = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    slots = placements(shortest_pack_first(histogram, size))
    slot_key = slots["length"] * RANKS + slots["rank"]
    pieces = (
        rows.join(first_ranks, (rows["task"] == first_ranks["task"])
                  & (rows["run.length"] == first_ranks["length"]))
        .select(
            "key", "doc_tokens", F.col("run.length").alias("length"), F.col("run.start").alias("start"),
            (F.col("base") + F.col("run.seq")).alias("rank"),
            F.posexplode(F.arrays_zip("run.crc32", "run.ids") if with_ids
                         else F.arrays_zip("run.crc32")).alias("i", "piece"),
        )
        .select(
            "key", (F.col("start") + F.col("i") * F.col("length")).alias("start"), "length",
            F.col("piece.crc32").alias("ids_crc32"), "doc_tokens",
            (F.col("rank") + F.col("i")).alias("rank"),
            *([F.col("piece.ids").alias("ids")] if with_ids else []),
        )
    )

    def place(batches):
        for batch in batches:
            length = batch["length"].to_numpy(zero_copy_only=False)
            rank = batch["rank"].to_numpy(zero_copy_only=False)
            slot = np.searchsorted(slot_key, length * RANKS + rank, side="right") - 1
            sequence = slots["sequence"][slot] + rank - slots["rank"][slot]
            keep = [batch[c] for c in ("key", "start", "length", "ids_crc32", "doc_tokens")]
            placed = [pa.array(sequence), pa.array(slots["offset"][slot])]
            yield pa.RecordBatch.from_arrays(
                [*keep, *placed, *([batch["ids"]] if with_ids else [])],
                ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                 *(["ids"] if with_ids else [])],
            )

    kind = rows.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
        " offset long" + (", ids binary" if with_ids else "")
    )
    return pieces.mapInArrow(place, schema).withColumnRenamed("key", key)
