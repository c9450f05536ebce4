"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded texts.

Folding undoes disguise: compatibility forms, accents, letters of other scripts that look Latin, and
digits or signs in place of letters. The lexicon holds words and beginnings of words with the log odds
of their documents being toxic; exception phrases cancel the matches inside them. A text's weights,
also in relation to its length, give the score by a logistic curve. Lexicon, exceptions and curve are
learned from a bounded sample of labelled rows.
"""

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.runtime import prepare, stored

#: Cyrillic and Greek letters and the Latin ones they look like.
LOOKALIKES = str.maketrans(
    "авсеёһніїјкӏмоөрԛѕтуүѵхԝʏɑɡιıĸłøđαβεκνορτυχ",
    "abceehhiijklmoopqstyyvxwyagiiklodabekvoptux",
)
#: Terms that a task adds up before it sends them on.
HELD = 500_000
#: Parts of the sample; the curve is fitted on each with the lexicon of the others.
FOLDS = 4
COUNTS = [f"{kind}{fold}" for fold in range(FOLDS) for kind in ("clean", "toxic")]

#: Digits and signs that stand for letters.
SIGNS = str.maketrans("013456789@$!", "oieasgtbgasi")
MARKS = dict.fromkeys(range(0x300, 0x370))
DISGUISED = re.compile(r"(?<![0-9@$!])[0-9@$]{1,2}(?=[^\W\d_])|(?<=[^\W\d_])[0-9@$!]{1,3}(?=[^\W\d_])")
OTHER = re.compile(r"[\W\d_]+")


def fold(text: str) -> str:
    """Words in plain lower-case letters, a space before and after each."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).translate(MARKS).casefold().translate(LOOKALIKES)
    text = DISGUISED.sub(lambda m: m.group().translate(SIGNS), text.lower())
    return f" {OTHER.sub(' ', text).strip()} "


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows that are learned from, per label. ``entries``: most lexicon entries,
    those of the strongest evidence. A beginning has ``least`` to ``most`` letters; words longer than
    ``longest`` count as beginnings only. An entry needs evidence (a likelihood ratio statistic) and a
    weight (log odds); an exception at least ``clean`` documents that are not toxic."""

    sample: int = 10_000
    entries: int = 50_000
    least: int = 3
    most: int = 7
    longest: int = 24
    evidence: float = 15.0
    weight: float = 2.5
    clean: int = 3


@dataclass
class Model:
    """Entries (`` word `` or `` beginning``) with weights, exception phrases, and the curve, if any."""

    lexicon: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    curve: tuple[float, float, float] | None = None

    def automaton(self) -> ahocorasick.Automaton | None:
        """All patterns in one automaton: length and weight, no weight for exceptions."""
        if not self.lexicon:
            return None
        found = ahocorasick.Automaton()
        for term, weight in self.lexicon.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        found.make_automaton()
        return found


def matches(folded: str, automaton: ahocorasick.Automaton | None) -> list[tuple[int, str, float]]:
    """Place, entry and weight of the longest match from each place, but for those in exceptions."""
    if automaton is None:
        return []
    best: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    for last, (length, weight) in automaton.iter(folded):
        start = last - length + 1
        if weight is None:
            spared.append((start, last))
        elif length > best.get(start, (0, 0.0))[0]:
            best[start] = (length, weight)
    found, at, end = [], 0, -1
    spared.sort()
    for start in sorted(best):
        length, weight = best[start]
        while at < len(spared) and spared[at][0] <= start:
            end = max(end, spared[at][1])
            at += 1
        if start + length - 1 > end:
            found.append((start, folded[start:start + length], weight))
    return found


def features(folded: str, found: list[tuple[int, str, float]]) -> tuple[float, float]:
    """Logarithms of the weight matched, whole and per hundred words."""
    total = sum(w for _, _, w in found)
    words = folded.count(" ") - 1
    return math.log1p(total), math.log1p(100 * total / max(words, 10))


def score_of(x: tuple[float, float], curve: tuple[float, float, float] | None) -> float:
    if curve is None:
        return 0.0
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, curve[0] + curve[1] * x[0] + curve[2] * x[1]))))


def document_terms(folded: str, settings: Settings) -> set[str]:
    """Distinct words and beginnings of words."""
    out = set()
    for w in set(folded.split()):
        out.update([f" {w[:k]}" for k in range(settings.least, min(settings.most, len(w)) + 1)])
        if len(w) <= settings.longest:
            out.add(f" {w} ")
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, eligible: Column, n: int, key: str, text: str,
                    label: str) -> tuple[DataFrame, dict[int, int]]:
    """``text, toxic, fold`` of at most ``n`` rows per label, and all eligible rows by label.

    A hash of the key decides, so that the choice does not depend on the order of rows. Equal texts of
    a label count once.
    """
    usable = labels.where(eligible & labels[label].isin(0, 1) & labels[key].isNotNull())
    usable = usable.select(labels[key].alias("id"), labels[label].cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    order = F.xxhash64("id", F.lit("sample")), "id"
    picked = usable.where("toxic = 1").orderBy(*order).limit(n).unionByName(
        usable.where("toxic = 0").orderBy(*order).limit(n))
    rows = docs.select(docs[key].alias("id"), docs[text].alias("text")).where("text is not null")
    rows = rows.join(F.broadcast(picked), "id").withColumn("hash", F.xxhash64("text"))  # 2 n rows at most
    rows = rows.dropDuplicates(["hash", "toxic"])
    return stored(rows.select("text", "toxic", F.pmod("hash", F.lit(FOLDS)).cast("int").alias("fold")), "labelled"), sizes


def counted(rows: DataFrame, of, name: str) -> DataFrame:
    """``term`` and documents that hold it, by label and fold: ``of(text)`` gives a text's terms.

    Tasks add up their texts; a term is shuffled once per task.
    """
    def run(batches):
        counts = [Counter() for _ in COUNTS]

        def sums():
            terms = list(set().union(*counts))
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts)],
                ["term", *COUNTS],
            )

        for batch in batches:
            for text, toxic, part in zip(*(batch[c].to_pylist() for c in ("text", "toxic", "fold")), strict=True):
                counts[2 * part + toxic].update(of(text))
            if sum(map(len, counts)) >= HELD:
                yield sums()
                for c in counts:
                    c.clear()
        yield sums()

    found = rows.mapInArrow(run, "term string, " + ", ".join(f"{c} long" for c in COUNTS))
    return stored(found.groupBy("term").agg(*[F.sum(c).alias(c) for c in COUNTS]), name)


def total(kind: str, but: int | None = None) -> Column:
    """Documents of a label that hold a term, in all folds but one."""
    return sum((F.col(f"{kind}{i}") for i in range(FOLDS) if i != but), F.lit(0))


def _evidence(a: Column, b: Column, toxic: float, clean: float) -> Column:
    """Likelihood ratio statistic of a term in ``a`` toxic and ``b`` clean documents."""
    def part(k, n):
        return F.when(k > 0, k * F.log(k / n)).otherwise(0.0)

    both, every = a + b, toxic + clean
    apart = part(a, toxic) + part(F.lit(toxic) - a, toxic) + part(b, clean) + part(F.lit(clean) - b, clean)
    return 2 * (apart - part(both, every) - part(F.lit(every) - both, every))


def lexicon_of(terms: DataFrame, sizes: dict[tuple[int, int], int], settings: Settings,
               but: int | None = None) -> dict[str, float]:
    """Entries and weights from term counts, without those of one fold.

    ``sizes`` are the texts by fold and label. A longer entry is kept if it says more than a shorter one.
    """
    a, b = total("toxic", but), total("clean", but)
    toxic, clean = (sum(n for (part, t), n in sizes.items() if t == label and part != but) for label in (1, 0))
    if not toxic or not clean:
        return {}
    weight = F.log((a + 0.5) / (toxic + 1.0)) - F.log((b + 0.5) / (clean + 1.0))
    evidence = _evidence(a, b, float(toxic), float(clean))
    strong = terms.select("term", weight.alias("weight"), evidence.alias("evidence")).where(
        (F.col("weight") >= settings.weight) & (F.col("evidence") >= settings.evidence)
    ).orderBy(F.desc("evidence"), "term").limit(settings.entries)
    found = {r["term"]: r["weight"] for r in strong.collect()}
    out: dict[str, float] = {}
    for term in sorted(found, key=lambda t: (len(t), t)):
        shorter = [out[term[:k]] for k in range(2, len(term)) if term[:k] in out]
        if not shorter or found[term] > max(shorter) + 0.3:
            out[term] = found[term]
    return out


def phrases(folded: str, automaton) -> set[str]:
    """The words that hold matches, and each with its neighbour on either side."""
    out = set()
    for start, entry, _ in matches(folded, automaton):
        end = folded.index(" ", start + len(entry) - 1 if entry.endswith(" ") else start + len(entry))
        out.add(folded[start:end + 1])
        before = folded.rfind(" ", 0, start) if start else -1
        after = folded.find(" ", end + 1)
        if before >= 0:
            out.add(folded[before:end + 1])
        if after >= 0:
            out.add(folded[start:after + 1])
    return out


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> tuple[float, float, float]:
    """Logistic curve of weighted rows by Newton's method; slopes are not below zero."""
    use = [0, 1, 2]
    while True:
        design = np.column_stack([np.ones(len(x)), x])[:, use]
        beta = np.zeros(len(use))
        penalty = np.diag([1e-6, *[ridge] * (len(use) - 1)])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            slope = design.T @ (weight * (y - p)) - penalty @ beta
            curve = (design * (weight * p * (1 - p))[:, None]).T @ design + penalty
            step = np.linalg.solve(curve, slope)
            beta += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        below = [c for c, b in zip(use, beta, strict=True) if c and b < 0]
        if not below:
            out = [0.0, 0.0, 0.0]
            for c, b in zip(use, beta.tolist(), strict=True):
                out[c] = b
            return tuple(out)
        use.remove(min(below, key=lambda c: beta[use.index(c)]))


def train(docs: DataFrame, labels: DataFrame, eligible: Column, settings: Settings | None = None,
          key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn from the labelled rows of which ``eligible`` (on ``labels``) is true.

    The curve is fitted on texts that the lexicon was not learned from: each fold of the sample is
    matched with the lexicon of the other folds. The driver gets the lexicon and two numbers per row
    of the sample. With one label only, or none, nothing is learned and every score is 0.
    """
    settings = settings or Settings()
    prepare(docs.sparkSession)
    rows, every = labelled_sample(docs, labels, eligible, settings.sample, key, text, label)
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    toxic, clean = (sum(n for (_, t), n in sizes.items() if t == label) for label in (1, 0))
    if not toxic or not clean:
        return Model({})
    terms = counted(rows, lambda t: document_terms(fold(t), settings), "toxicity-terms")
    model = Model(lexicon_of(terms, sizes, settings))
    others = [Model(lexicon_of(terms, sizes, settings, i)) for i in range(FOLDS)]
    model.exceptions = exceptions(rows, model, toxic, clean, settings)

    def measure(batches):
        automata = [m.automaton() for m in others]
        for batch in batches:
            x = []
            for t, part in zip(batch["text"].to_pylist(), batch["fold"].to_pylist(), strict=True):
                folded = fold(t)
                x.append(features(folded, matches(folded, automata[part])))
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"], *(pa.array([v[i] for v in x], pa.float64()) for i in (0, 1))], ["toxic", "whole", "share"]
            )

    seen = rows.mapInArrow(measure, "toxic int, whole double, share double").toArrow()
    y = seen["toxic"].to_numpy().astype(float)
    x = np.column_stack([seen["whole"].to_numpy(), seen["share"].to_numpy()])
    order = np.lexsort((x[:, 1], x[:, 0], y))  # sums do not depend on the order of tasks
    weight = np.where(y == 1, every[1] / toxic, every[0] / clean)
    model.curve = fitted(x[order], y[order], (weight * len(y) / weight.sum())[order])
    return model


def exceptions(rows: DataFrame, model: Model, toxic: int, clean: int, settings: Settings) -> set[str]:
    """Phrases around matches that are no likelier in toxic documents than in others."""
    lexicon = Model(model.lexicon)

    def of():
        automaton = None

        def run(text):
            nonlocal automaton
            automaton = automaton or lexicon.automaton()
            return phrases(fold(text), automaton)

        return run

    if not model.lexicon:
        return set()
    counts = counted(rows, of(), "toxicity-phrases")
    a, b = total("toxic"), total("clean")
    spared = counts.where((b >= settings.clean) & ((a + 0.5) / (toxic + 1.0) <= (b + 0.5) / (clean + 1.0)))
    return {r["term"] for r in spared.orderBy(F.desc(b - a), "term").limit(settings.entries).collect()}


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row as the struct ``row``, with ``score`` (0 to 1) and ``matches`` (entry, weight, n).

    Null and empty texts have no match and the score of a text without any. Texts of any length are
    matched whole. Repeated rows are scored alike; other columns may have any names; an empty table
    gives an empty result.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"))
    kind = T.ArrayType(T.StructType.fromDDL("entry string, weight double, n long"))
    out = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("matches", kind)])
    entry = pa.list_(pa.struct([("entry", pa.string()), ("weight", pa.float64()), ("n", pa.int64())]))

    def run(batches):
        automaton = model.automaton()
        for batch in batches:
            scores, found = [], []
            for t in batch["text"].to_pylist():
                folded = fold(t or "")
                own = matches(folded, automaton)
                scores.append(score_of(features(folded, own), model.curve))
                times = Counter((e, w) for _, e, w in own)
                found.append([{"entry": e.strip(), "weight": w, "n": n} for (e, w), n in sorted(times.items())])
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(scores, pa.float64()), pa.array(found, entry)], out.names
            )

    return rows.mapInArrow(run, out)
