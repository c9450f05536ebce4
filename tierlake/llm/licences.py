"""Licence scans: a positional index of licence templates, looked up by their rarest words."""

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.runtime import text_or_empty

#: Upper case becomes lower case before words are taken; these characters part words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence text as words. ``mandatory`` phrases have to stand in it word by word."""

    label: str
    text: str
    mandatory: tuple[str, ...] = ()
    #: Its places are counted, and all of its words are mandatory.
    base: bool = False
    words: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "words", tuple(w for w in re.split(GAPS, self.text.lower()) if w))

    def fixed_places(self) -> list[int]:
        """Places of the words that have to be there."""
        if self.base:
            return list(range(len(self.words)))
        places: set[int] = set()
        for phrase in self.mandatory:
            words = tuple(phrase.split())
            starts = [i for i in range(len(self.words)) if self.words[i:i + len(words)] == words]
            if not starts:
                raise ValueError(f"{phrase!r} is not in the template of {self.label}")
            places.update(range(starts[0], starts[0] + len(words)))
        return sorted(places)


# The phrases that are counted, with their labels.
BASE = (
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
)

# Openings of well-known licence texts and notices, with the phrases that name them.
NOTICES = (
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3",
             ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2",
             ("gnu general public license version 2",)),
    Template("lgpl", "licensed under the GNU Lesser General Public License",
             ("gnu lesser general public license",)),
    Template("agpl", "licensed under the GNU Affero General Public License",
             ("gnu affero general public license",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0",
             ("apache license version 2 0",)),
    Template("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy"
             " of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mit-notice", "Released under the MIT License", ("mit license",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose"
             " with or without fee is hereby granted", ("with or without fee",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are"
             " permitted provided that the following conditions are met", ("source and binary forms",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license v 2 0",)),
    Template("epl", "made available under the terms of the Eclipse Public License", ("eclipse public license",)),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under CC BY-ND 4.0", ("cc by nd",)),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution 4 0",)),
    Template("cc0", "CC0 1.0 Universal Public Domain Dedication", ("cc0 1 0 universal",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
)

TEMPLATES = BASE + NOTICES


def words_of(text: Column) -> Column:
    """Words in lower case: runs of digits, letters and characters beyond ASCII."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), GAPS), "")


def inverse_frequency(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """1 + ln((N + 1) / (n + 1)) of each template word, over the documents that have it."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    rows = words.select(F.explode(F.array_append(F.array_intersect("words", known), F.lit(""))).alias("word"))
    n = {r["word"]: r["count"] for r in rows.groupBy("word").count().collect()}
    return {w: 1 + math.log((n.get("", 0) + 1) / (n.get(w, 0) + 1)) for w in vocabulary}


def posted_places(t: Template, idf: dict[str, float], rare: int, threshold: float) -> list[int]:
    """Places of the words that find a template: no text that has it goes without one of them.

    The rarest word of the mandatory phrases has to be there. Without such phrases, so many of the rarest
    words are posted that a text without any would miss more weight than the threshold leaves.
    """
    by_rarity = sorted(range(len(t.words)), key=lambda i: (-idf[t.words[i]], i))
    fixed = set(t.fixed_places())
    if t.base:
        return by_rarity[:1]
    if fixed:
        return sorted({*by_rarity[:rare], next(i for i in by_rarity if i in fixed)})
    total, missed, n = sum(idf[w] for w in t.words), 0.0, 0
    while n < len(by_rarity) and (n < rare or missed <= (1 - threshold) * total + 1e-6):
        missed, n = missed + idf[t.words[by_rarity[n]]], n + 1
    return sorted(by_rarity[:n])


def _literal_index(templates: tuple[Template, ...], idf: dict[str, float], rare: int, threshold: float):
    """Postings of the words that find each template, and the templates, as constant columns."""
    postings, table = [], []
    for number, t in enumerate(templates):
        for place in posted_places(t, idf, rare, threshold):
            postings.append((t.words[place], number, place))
        total = sum(idf[w] for w in t.words)
        fixed = set(t.fixed_places())
        table.append(F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
            F.array(*[
                F.struct(F.lit(i).alias("place"), F.lit(w).alias("word"), F.lit(idf[w] / total).alias("weight"),
                         F.lit(i in fixed).alias("fixed"))
                for i, w in enumerate(t.words)
            ]).alias("words"),
        ))
    posted = F.array(*[
        F.struct(F.lit(w).alias("word"), F.lit(n).alias("template"), F.lit(p).alias("place")) for w, n, p in postings
    ])
    return sorted({p[0] for p in postings}), posted, F.array(*table)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, threshold: float = 0.8, rare: int = 2,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """Licence labels of every row.

    The words of all templates are weighted by inverse document frequency over the whole table.
    Each file's occurrences of the templates' rarest words (one of a base phrase, ``rare`` of a
    longer template and the rarest of its mandatory phrases, see ``posted_places``) are looked up in the
    templates' postings; place in the file less place in the template gives a start. At each start the template's words are compared by relative position. A
    template is found if its mandatory phrases are there in full and the weight of the words that
    agree is at least ``threshold`` of the whole.

    Columns: key, n_words, n_base (places of base phrases), first_word, last_word (their smallest
    and largest start, else null), base_labels, labels (sorted, comma-joined, empty if none), score
    (largest weight that agreed at any start looked up, 0 without any), matches (label, start,
    score of all that was found). Null texts are empty. Work stays within each row: keys may be
    null or repeated, no row is shuffled, other columns do not matter.
    """
    rows = docs.select(docs[key].alias("key"), words_of(text_or_empty(text)).alias("words"))
    idf = inverse_frequency(rows, sorted({w for t in templates for w in t.words}))
    anchors, postings, table = _literal_index(templates, idf, rare, threshold)
    is_anchor = lambda w: w.isin(anchors)
    places = F.filter(F.transform("words", lambda w, i: F.when(is_anchor(w), i)), lambda i: i.isNotNull())
    starts = F.flatten(F.transform("anchors", lambda i: F.transform(
        F.filter(postings, lambda p: p["word"] == F.get("words", i)),
        lambda p: F.struct((i - p["place"]).alias("start"), F.get(table, p["template"]).alias("template")),
    )))
    there = lambda s, w: F.coalesce(F.get("words", s + w["place"]) == w["word"], F.lit(False))
    compared = F.transform("starts", lambda c: F.struct(
        c["template"]["label"].alias("label"), c["template"]["base"].alias("base"), c["start"].alias("start"),
        F.forall(c["template"]["words"], lambda w: ~w["fixed"] | there(c["start"], w)).alias("fixed"),
        F.aggregate(
            c["template"]["words"], F.lit(0.0),
            lambda sum_, w: sum_ + F.when(there(c["start"], w), w["weight"]).otherwise(0.0),
            lambda total: F.round(F.least(total, F.lit(1.0)), 6),
        ).alias("score"),
    ))
    found = F.filter("compared", lambda m: m["fixed"] & (m["score"] >= threshold))
    base = F.filter("found", lambda m: m["base"])
    joined = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(c, lambda m: m["label"]))))
    steps = rows.select("key", "words", places.alias("anchors"))
    steps = steps.select("key", F.size("words").cast("long").alias("n_words"), starts.alias("starts"), "words")
    steps = steps.select("key", "n_words", compared.alias("compared"))
    steps = steps.select("key", "n_words", "compared", found.alias("found"))
    steps = steps.select("key", "n_words", "compared", "found", base.alias("base"))
    start = F.transform("base", lambda m: m["start"].cast("long"))
    return steps.select(
        F.col("key").alias(key), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        joined("base").alias("base_labels"), joined("found").alias("labels"),
        F.coalesce(F.array_max(F.transform("compared", lambda m: m["score"])), F.lit(0.0)).alias("score"),
        F.transform("found", lambda m: F.struct(
            m["label"].alias("label"), m["start"].alias("start"), m["score"].alias("score")
        )).alias("matches"),
    )
