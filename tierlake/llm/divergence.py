"""Source divergence audit: how the term frequencies of a language's sources differ.

A tokenizer of one translate table lowers letters and blanks separators, a split and a counter per
document give its terms, and tasks add documents up per source before anything is shuffled. All later
work is on counts above zero: a pair of sources gets its value from the terms that both hold, and
what terms of one or none of them add follows from the histogram of each source's counts.
"""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.runtime import prepare, ragged, stored

#: Terms (by source) that a task adds up before it sends them on.
HELD = 200_000
#: Pairs of sources that are worked on, or whose sums are held, at once.
PAIRS = 1_000_000
#: A frequency of one.
UNIT = 1_000_000_000

TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters, in lower case, and of all characters beyond ASCII."""
    return text.encode().translate(TABLE).split()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, docs, n``: documents that hold a term and its occurrences, task by task."""
    prepare(docs.sparkSession)

    def count(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def sums():
            keys, found, n_docs, n = [], [], [], []
            for key, (holding, more) in held.items():
                keys += [key] * len(holding)
                found += holding
                n_docs += holding.values()
                n += [d + more[t] if t in more else d for t, d in holding.items()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                    pa.array(found, pa.binary()).cast(pa.string()),
                    pa.array(n_docs, pa.int64()), pa.array(n, pa.int64()),
                ],
                ["lang", "source", "term", "docs", "n"],
            )

        for batch in batches:
            for l, s, t in zip(*(batch[c].to_pylist() for c in ("lang", "source", "text")), strict=True):
                own = Counter(terms(t))
                holding, more = held[l, s]
                holding.update(iter(own))
                for term, n in own.items():
                    if n > 1:
                        more[term] += n - 1
            if sum(len(holding) for holding, _ in held.values()) >= HELD:
                yield sums()
                held.clear()
        if held:
            yield sums()

    rows = docs.select(*[F.coalesce(docs[c], F.lit("")).alias(name) for c, name in
                         ((text, "text"), (lang, "lang"), (source, "source"))])
    return rows.mapInArrow(count, "lang string, source string, term string, docs long, n long")


def frequency(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + size)), exact for counts of any size."""
    whole = lambda c: c.cast("decimal(20,0)")
    share = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * whole(count + 1), whole(total + size))
    return share.cast("long") + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def kept_terms(docs: DataFrame, least: int, text: str, lang: str, source: str) -> DataFrame:
    """``lang, source, term, n, lang_n, sources, first`` of the terms in at least ``least`` documents.

    ``lang_n`` and ``sources`` are a term's occurrences in its language and the sources that hold it;
    one row per term and language is marked as ``first``. Counts are shuffled once, by term.
    """
    counts = (
        term_counts(docs, text, lang, source).repartition("lang", "term")
        .groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    )
    whole = Window.partitionBy("lang", "term")
    marked = counts.select(
        "lang", "source", "term", "n", F.sum("docs").over(whole).alias("lang_docs"),
        F.sum("n").over(whole).alias("lang_n"), F.count("n").over(whole).alias("sources"),
        (F.row_number().over(whole.orderBy("source")) == 1).alias("first"),
    )
    return stored(marked.where(F.col("lang_docs") >= least).drop("lang_docs"), "divergence-terms")


def pair_blocks(table: pa.Table, group: np.ndarray):
    """``key, value`` of the pairs of entries of one term, ``PAIRS`` of them or so at a time.

    The key is the first source's number times 2^32 plus the second's. Entries are sorted by term.
    """
    lang, term = (table[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "term"))
    p, none = (table[c].to_numpy() for c in ("p", "none"))
    new = np.concatenate(([True], (term[1:] != term[:-1]) | (lang[1:] != lang[:-1])))
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(term)))
    first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    ends, low = np.cumsum(size), 0

    def over(a, b):
        return (a - b) * (a - b) // b

    while low < len(term):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        i, j = np.repeat(np.arange(low, high), size[low:high]), ragged(first[low:high], size[low:high])
        i, j = i[i != j], j[i != j]
        value = over(p[i], p[j]) - over(p[i], none[j]) - over(none[i], p[j]) + over(none[i], none[j])
        key, at = np.unique(group[i] << 32 | group[j], return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, at, value)
        yield key.tolist(), total.tolist()
        low = high


def common_terms(entries: DataFrame) -> DataFrame:
    """``lang, source, item, value``: per task, what terms that both sources hold add to their pair.

    That is the gap at both counts, less what ``source_pairs`` takes for a count above zero on one
    side and none on the other. Entries (lang, source, term, p, none) come sorted by term. Pairs are
    formed in numpy and added up before they leave the task.
    """
    def run(batches):
        numbers: dict[tuple[str, str], int] = {}
        sums: dict[int, int] = {}

        def result():
            names = list(numbers)
            a, b = [names[k >> 32] for k in sums], [names[k & 0xFFFFFFFF] for k in sums]
            return pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.string()) for x in ([n[0] for n in a], [n[1] for n in a], [n[1] for n in b])),
                 pa.array(list(sums.values()), pa.int64())],
                ["lang", "source", "item", "value"],
            )

        def add(table):
            held = zip(table["lang"].to_pylist(), table["source"].to_pylist(), strict=True)
            group = np.array([numbers.setdefault(x, len(numbers)) for x in held], np.int64)
            for keys, values in pair_blocks(table, group):
                for k, v in zip(keys, values, strict=True):
                    sums[k] = sums.get(k, 0) + v
                if len(sums) >= PAIRS:
                    yield result()
                    sums.clear()

        rest = None  # the last term's entries: more of them may follow
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            last = table.slice(len(table) - 1).to_pylist()
            keys = zip(table["lang"].to_pylist(), table["term"].to_pylist(), strict=True)
            end = next((i for i, k in enumerate(keys) if k == (last[0]["lang"], last[0]["term"])), 0) if last else 0
            rest = table.slice(end)
            if end:
                yield from add(table.slice(0, end))
        if rest is not None and len(rest):
            yield from add(rest)
        if sums:
            yield result()

    return entries.mapInArrow(run, "lang string, source string, item string, value long")


def source_pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for all pairs of different sources of a language.

    With f the gap, p and q the frequencies of a term in both sources and 0 marking those of a count
    of zero: sum f(p, q) = V f(p0, q0) + sum over the first source's terms of f(p, q0) - f(p0, q0)
    + sum over the second's of f(p0, q) - f(p0, q0) + what ``common_terms`` gives. The two sums take
    one row per source and distinct count, not one per term.
    """
    other = groups.select(F.col("lang").alias("other_lang"), F.col("source").alias("other"), F.col("none").alias("q0"))
    same = F.col("lang") == F.col("other_lang")
    base = groups.join(other, same & (F.col("source") != F.col("other"))).select(
        "lang", "source", F.col("other").alias("item"), (F.col("size") * gap(F.col("none"), F.col("q0"))).alias("value")
    )
    counts = entries.groupBy("lang", "source", "p", "none").agg(F.count(F.lit(1)).alias("terms"))
    p, p0, q0 = F.col("p"), F.col("none"), F.col("q0")
    alone = counts.join(other, same & (F.col("source") != F.col("other"))).select(
        "lang",
        F.inline(F.array(
            F.struct(F.col("source").alias("source"), F.col("other").alias("item"),
                     (F.col("terms") * (gap(p, q0) - gap(p0, q0))).alias("value")),
            F.struct(F.col("other").alias("source"), F.col("source").alias("item"),
                     (F.col("terms") * (gap(q0, p) - gap(q0, p0))).alias("value")),
        )),
    )
    both = entries.where("sources > 1").select("lang", "source", "term", "p", "none")
    common = common_terms(both.repartition("lang", "term").sortWithinPartitions("lang", "term"))
    return (
        base.unionByName(alone).unionByName(common)
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    )


def audit(docs: DataFrame, least: int = 3, best: int = 200, text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: divergences between sources, and their marked terms.

    A language keeps the terms of at least ``least`` of its documents. A term's frequency in a source
    or language is 1 + floor(10^9 (count + 1) / (N + V)), N its kept terms' occurrences and V their
    number. Part ``pair`` has every other source of the language, with the sum of floor((p - q)^2 / q)
    over the kept terms; part ``term`` the ``best`` terms that a source has more often than its
    language. Ties go to the smaller item in order of UTF-8.

    Nulls in the three columns are empty strings, and empty languages and sources are groups like
    others. A source without terms has pairs but no terms; a language of one source has no pairs; an
    empty table gives no rows. Repeated rows are documents of their own. Texts of any length are
    counted whole. Other columns do not matter, whatever their names.
    """
    kept = kept_terms(docs, least, text, lang, source)
    spread = docs.select(F.coalesce(docs[lang], F.lit("")).alias("lang"), F.coalesce(docs[source], F.lit("")).alias("source"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("size"))
    found = spread.distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total", "size"])
    found = stored(found, "divergence-sources")
    langs = found.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("size").alias("size"))
    groups = found.drop("size").join(langs, "lang")
    groups = stored(groups.withColumn("none", F.when(
        F.col("size") > 0, frequency(F.lit(0), F.col("total"), F.col("size"))).otherwise(1)), "divergence-groups")
    entries = kept.join(groups, ["lang", "source"]).withColumns({
        "p": frequency(F.col("n"), F.col("total"), F.col("size")),
        "q": frequency(F.col("lang_n"), F.col("lang_total"), F.col("size")),
    })
    marked = entries.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value")
    )
    pairs = source_pairs(entries, groups).withColumn("part", F.lit("pair"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        marked.withColumn("rank", rank).where(F.col("rank") <= best).select(*columns)
        .unionByName(pairs.withColumn("rank", rank).select(*columns))
    )
