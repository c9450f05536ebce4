"""Licences, fingerprints, tokens, pieces and languages against plain versions, with odd inputs."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from plain import base_licences, fingerprint_hex, licence_labels, likeness, mixture, viterbi
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierlake.llm import fingerprints, language_id, licences, pretokens, queries, sentencepieces, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    None, "", " ", "\n", "the cat sat on the mat", "THE CAT'S hat isn't\tred  \n\n x",
    "Released under the MIT License. mit license, MIT-LICENSE", "É à ß 中文 🙂 ▁ \x00 'll 's",
    "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0 cc  by",
    "licensed under the GNU General Public License, version 3", "<|endoftext|>a<|endoftext|>",
    "license " * 3000, "a" * 5000, "the cat sat on the mat",
]


@pytest.fixture
def docs(spark):
    """Odd texts under odd keys: null and repeated ones, and columns with names used inside."""
    keys = [None, 5, 5, *range(10, 10 + len(TEXTS) - 3)]
    rows = [(k, t, "x", 1, "y") for k, t in zip(keys, TEXTS, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, words string, bucket int, key string")


def empty(docs):
    return docs.limit(0)


def by_key(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, str(r)))


def test_licences(docs):
    rows = licences.scan(docs).collect()
    assert len(rows) == len(TEXTS)
    expected = {}
    for key, text in docs.select("doc_id", "text").collect():
        n, found = base_licences(text)
        starts = [i for i, _ in found]
        expected.setdefault(key, []).append((
            n, len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in found})),
        ))
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) in expected[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    labels = {r.labels for r in rows}
    assert {"mit,mit-notice", "apache,apache-2.0,cc-by,cc-by-nc", "gpl,gpl-3.0"} <= labels
    assert licences.scan(empty(docs)).count() == 0


def test_licence_templates_need_their_mandatory_phrase(spark):
    text = "permission is hereby granted free of charge to any person obtaining a copy of this software"
    rows = [(1, text + " and associated documentation files"), (2, text.replace("charge", "cost") + " and associated documentation files")]
    found = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].labels == "mit-text" and found[1].score == 1
    assert found[2].labels == "" and 0.8 < found[2].score < 1


def altered_notices():
    """Notices and variants of each with one or two words replaced, in odd surroundings."""
    rng = random.Random(11)
    rows = []
    for t in licences.TEMPLATES:
        for gone in range(0, 3):
            for _ in range(6):
                words = list(t.words)
                for place in rng.sample(range(len(words)), min(gone, len(words))):
                    words[place] = rng.choice(["related", "acquiring", "x", "license", "public"])
                cut = rng.choice([0, 0, 1])
                rows.append(" ".join(["license"] * rng.randrange(3) + words[cut:] + ["the"] * rng.randrange(3)))
    return rows


@pytest.mark.parametrize("templates", [licences.TEMPLATES, (
    licences.Template("free", "one two three four five six seven eight nine ten eleven twelve"),
    licences.Template("pair", "alpha beta"), *licences.BASE,
)])
def test_no_licence_goes_without_a_look_up(spark, templates):
    texts = altered_notices() + ["one two three x five six seven eight nine y eleven twelve"] * 2 + [
        " ".join(w if random.Random(i).random() < 0.85 else "z" for w in templates[0].words) for i in range(60)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = df.select(licences.words_of(F.col("text")).alias("words"))
    idf = licences.inverse_frequency(words, sorted({w for t in templates for w in t.words}))
    for r in licences.scan(df, templates).collect():
        assert r.labels == licence_labels(texts[r.doc_id], templates, idf), texts[r.doc_id]


def test_the_opening_without_its_rarest_words_is_found(spark):
    """Both of the rarest words are altered; the mandatory phrase is whole."""
    t = next(t for t in licences.TEMPLATES if t.label == "mit-text")
    fixed = set(t.fixed_places())
    others = sorted(set(t.words) - {t.words[i] for i in fixed})
    texts = [" ".join("zz" if w in ("obtaining", "associated") else w for w in t.words)]
    texts += [" ".join(w for w in others if w not in ("obtaining", "associated"))] * 50 + [" ".join(t.words[i] for i in fixed)] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = df.select(licences.words_of(F.col("text")).alias("words"))
    idf = licences.inverse_frequency(words, sorted({w for t in licences.TEMPLATES for w in t.words}))
    rarest = sorted(range(len(t.words)), key=lambda i: (-idf[t.words[i]], i))[:2]
    assert {t.words[i] for i in rarest} == {"obtaining", "associated"}
    found = {r.doc_id: r for r in licences.scan(df).collect()}[0]
    assert found.score > 0 and found.labels == licence_labels(texts[0], licences.TEMPLATES, idf)


def test_licence_scan_runs_no_python_and_no_join(docs):
    plan = licences.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Join|Exchange", plan)


def test_fingerprints_of_edits(docs, spark):
    rows = [r for r in docs.select("doc_id", "text").collect() if r.doc_id not in (None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    order = sorted(((r.doc_id, r.text or "") for r in rows), reverse=True)
    found = {r.doc_id: r for r in fingerprints.fingerprint_edits(df).collect()}
    assert len(found) == len(rows)
    for i, (key, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        r = found[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint_hex(text), fingerprint_hex(changed))
        assert abs(r.near_edited - likeness(text, changed)) < 1e-9 and abs(r.near_next - likeness(text, following)) < 1e-9
    same = {found[k].fingerprint for k, t in order if t == "the cat sat on the mat"}
    assert len(same) == 1


def test_fingerprints_of_odd_tables(docs):
    assert fingerprints.fingerprint_edits(docs).count() == len(TEXTS)
    assert fingerprints.fingerprint_edits(empty(docs)).count() == 0
    one = fingerprints.fingerprint_edits(docs.where("doc_id = 11")).first()
    assert one.near_next == 1.0  # a single row follows itself
    assert fingerprints.fingerprints(docs).count() == len(TEXTS)


@pytest.mark.parametrize("hot", [7, None])
def test_fingerprints_of_a_hot_key(spark, hot):
    """A third of all rows has one key, or none: the rows follow each other as in one sorted list, in several buckets."""
    rows = [(hot if i % 3 == 0 else i, f"text {i}.\nline {i % 5}") for i in range(600)] + [(hot, "same text")] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashed = df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    order = sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h), reverse=True)
    expected = [(r.doc_id, hashlib.sha256(fingerprints.edited(r.text, n.text).encode()).hexdigest())
                for r, n in zip(order, order[1:] + order[:1], strict=True)]
    found = [(r.doc_id, r.edited_sha256) for r in fingerprints.fingerprint_edits(df).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    sizes = fingerprints.in_sequence(df, "doc_id", "text", 24).groupBy("bucket").count().collect()
    assert len(sizes) >= 20 and max(r["count"] for r in sizes) <= 3 * 600 / 24


def test_paragraphs_are_counted_without_a_modulus_in_reach():
    texts = ["a" + "\n" * n for n in (0, 1, 1 << 16, 1 << 20)] + ["b\n" * n for n in (1 << 15, 1 << 16)]
    prints = [fingerprints.to_hex(x) for x in fingerprints.fingerprint(texts)]
    assert len(set(prints)) == len(texts)
    lanes = fingerprints.fingerprint(["b\n" * 40_000, "b\n" * 20_000 + "c\n" * 20_000])
    assert abs(fingerprints.likeness(*lanes) - 2 / 3) < 0.3  # 2 <a, b> / (|a|^2 + |b|^2)


def test_blank_lines_are_nothing_in_common():
    one, other = ("\n\n".join(f"{name} {i}" for i in range(60)) for name in ("one", "other"))
    assert likeness(one, other) < 0.3
    assert fingerprints.likeness(*fingerprints.fingerprint([one, other])) == pytest.approx(likeness(one, other))
    assert fingerprints.likeness(*fingerprints.fingerprint(["\n\n", "\n"])) == 0


def test_fingerprints_add_up():
    a, b = "one.\ntwo three.\nfour", "four\none.\ntwo three."
    fa, fb = fingerprints.fingerprint([a, b])
    assert (fa == fb).all()
    grown = fingerprints.insert(fa, ["five"])
    assert (grown == fingerprints.fingerprint([a + "\nfive"])[0]).all()
    assert (fingerprints.delete(grown, ["five"]) == fa).all()
    assert (fingerprints.from_hex(fingerprints.to_hex(grown)) == grown).all()


def test_likeness_estimates_the_share_of_common_paragraphs():
    lines = [f"line {i}" for i in range(200)]
    full = fingerprints.fingerprint(["\n".join(lines)])[0]
    for kept in (0, 50, 100, 150, 200):
        other = fingerprints.fingerprint(["\n".join(lines[:kept] + [f"x {i}" for i in range(200 - kept)])])[0]
        assert abs(fingerprints.likeness(full, other) - kept / 200) < 0.3


def test_character_classes_are_those_of_the_library():
    library, table = Tokenizer.from_file(BPE).pre_tokenizer, pretokens.char_classes()
    points = [*range(0xD800), *range(0xE000, 0x3400), *range(0xA000, 0xB000), *range(0x1F000, 0x20000)]
    for kind, before in ((pretokens.LETTER, "x"), (pretokens.NUMBER, "1"), (pretokens.OTHER, "!")):
        for low in range(0, 0x3400, 512):
            own = points[low:low + 512]
            split = library.pre_tokenize_str("".join(before + chr(c) + "\n\n" for c in own))
            starts = {a for _, (a, _) in split}
            for i, c in enumerate(own):
                assert (4 * i + 1 not in starts) == (table[c] == kind), hex(c)


def test_tokens_are_those_of_the_library(docs):
    library, table = Tokenizer.from_file(BPE), pretokens.word_table(BPE)
    random.seed(5)
    letters = ["a", "s", "t", "re", "'", " ", "  ", "\n", "1", "!", "é", "中", "'s", "'ll", "\x00", "<|endoftext|>", ""]
    texts = TEXTS + ["".join(random.choices(letters, k=random.randrange(12))) for _ in range(5000)]
    ids, at = table.ids(pa.array(texts))
    counts = table.counts(pa.array(texts))
    for i, e in enumerate(library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert e.ids == ids[at[i]:at[i + 1]].tolist(), repr(texts[i])
        assert counts[i] == len(e.ids)
    rows = token_counts.count_tokens(docs, BPE, limit=4)
    assert rows.count() == len(TEXTS) and token_counts.count_tokens(empty(docs), BPE).count() == 0
    for r in rows.collect():
        assert r.over_limit == (r.n_tokens > 4)


def test_pieces_are_the_best_segmentation():
    model = sentencepieces.model(PIECES)
    random.seed(7)
    letters = [*"abcdehtrsn", " ", "  ", "é", "中", "🙂", "\n", "▁", "the ", "ing", "\x00", "ß"]
    texts = ["".join(random.choices(letters, k=random.randrange(16))) for _ in range(600)] + [None, "", "of the people"]
    ids, at, scores = model.encode(texts)
    for i, text in enumerate(texts):
        own = ids[at[i]:at[i + 1]].tolist()
        best = viterbi(model, text)
        assert own == best or abs(scores[i] - sum(model.scores[j] for j in best)) < 1e-6, repr(text)
        assert model.decode(own) == (text or "").replace("▁", " ")


def test_pieces_of_odd_tables(docs):
    rows = sentencepieces.encode(docs, PIECES)
    assert sum(not r.round_trip for r in rows.collect()) == sum("▁" in (t or "") for t in TEXTS)
    back = sentencepieces.decode(rows, PIECES)
    texts = sorted((t or "").replace("▁", " ") for t in TEXTS)
    assert sorted(r.text for r in back.collect()) == texts
    assert sentencepieces.encode(empty(docs), PIECES).count() == 0


def test_very_long_texts():
    """A word of 50,000 letters, one of 300,000 blanks, 100,000 words."""
    texts = ["ab" * 25_000, " " * 300_000 + "x", "the cat's hat " * 30_000]
    model = sentencepieces.model(PIECES)
    ids, at, _ = model.encode(texts)
    assert [model.decode(ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)] == texts
    library = Tokenizer.from_file(BPE)
    counts = pretokens.word_table(BPE).counts(pa.array(texts))
    assert counts.tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def labelled(spark):
    random.seed(11)
    words = {"aa": ["lato", "mira", "solan", "teru"], "bb": ["grick", "strow", "plent", "drusk"]}
    rows = []
    for i in range(120):
        lang = "aa" if i % 2 else "bb"
        rows.append((i, " ".join(random.choices(words[lang], k=40)), lang))
    rows += [(200, "", "aa"), (201, "123 ...", "bb"), (202, None, "aa"), (203, "solan " * 40, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_are_told_apart(spark):
    docs = labelled(spark)
    model = language_id.train(docs, F.col("doc_id") % 4 != 2)
    assert model.languages == ["aa", "bb"]
    found = {r["row"]["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert all(found[i].lang_pred == ("aa" if i % 2 else "bb") for i in range(120))
    assert all((found[i].lang_pred, found[i].score) == ("und", 0) for i in (200, 201, 202))
    assert found[203].lang_pred == "aa"


def test_mixture_of_two_languages(spark):
    docs = labelled(spark)
    model = language_id.train(docs)
    half = "lato mira solan teru lato mira " * 30 + "grick strow plent " * 20
    buckets, row = language_id.trigrams(pa.array([half, "lato mira solan " * 60]))
    share = language_id.mixtures(buckets, row, 2, model, language_id.Settings())
    assert abs(share[0].sum() - 1) < 1e-9 and abs(share[0][0] - 5 / 7) < 0.01
    assert share[1].tolist() == [1.0, 0.0]


def test_languages_of_odd_tables(docs, spark):
    model = language_id.train(labelled(spark))
    assert language_id.identify(docs, model).count() == len(TEXTS)
    assert language_id.identify(empty(docs), model).count() == 0
    nothing = language_id.train(empty(docs).withColumn("lang", F.lit("a")))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def alphabets(n):
    """A text in each of n languages, none of which shares a letter with another."""
    return {f"l{i:04}": "".join(chr(0x4E00 + 20 * i + (k * k + 3 * k) % 20) for k in range(60)) for i in range(n)}


def test_every_label_is_learned(spark):
    """More languages than a block holds, and more than a fixed number of them."""
    texts = alphabets(300)
    rows = [(i, text, lang) for i, (lang, text) in enumerate(texts.items())]
    rows += [(1000 + i, *rows[i][1:]) for i in range(280)]  # the others are the rarest
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert model.languages == sorted(texts) and len(model.blocks) == 5
    found = language_id.identify(docs, model).select("row.lang", "lang_pred", "score").collect()
    assert len(found) == 580 and all(r.lang == r.lang_pred and r.score > 0.9 for r in found)


@pytest.mark.parametrize("size", [5, 3000, 3001, 10**6, 2 * 10**9, 4 * 10**9, 10**13])
def test_sample_of_labels_of_any_size(spark, size):
    """Of so many evenly spread hashes about 3,000 are chosen; those just below and above the last."""
    share = min(1, 3000 / size)
    hashes = [(int(share * x * 2**64) - (0 if share * x < 0.5 else 2**64),) for x in (0, 0.5, 0.999)]
    hashes += [(int(share * x * 2**64) - (0 if share * x < 0.5 else 2**64),) for x in (1.001, 2) if share * x < 1]
    df = spark.createDataFrame(hashes, "hash long").withColumn("size", F.lit(size).cast("long"))
    found = df.select(language_id.sampled(F.col("hash"), F.col("size"), 3000).alias("x"))
    assert [r.x for r in found.collect()] == ([True] * 3 + [False] * 2)[:len(hashes)]


def test_small_shares_of_long_texts_stay(spark):
    """900 letters of each of two languages among 100,000; a few stray letters are not worth a language."""
    texts = [t for _, t in zip(range(6), alphabets(6).values(), strict=False)]
    rows = [(i, t * 200, f"l{i}") for i, t in enumerate(texts)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    long = texts[0] * 1637
    mixed = pa.array([f"{long} {texts[2] * 15} {texts[4] * 15}", f"{long} {texts[3][:3]}", texts[5]])
    share = language_id.mixtures(*language_id.trigrams(mixed), 3, model, language_id.Settings())
    assert [np.flatnonzero(p).tolist() for p in share] == [[0, 2, 4], [0], [5]]
    assert np.allclose(share[0], [0.982, 0, 0.009, 0, 0.009, 0], atol=0.001)


def test_mixtures_by_plain_estimation(spark, sf_dir):
    """Texts of one to four languages, some with letters of none, against EM without any short cut."""
    r = random.Random(8)
    docs = queries.table(spark, sf_dir, "documents").where("text is not null and lang is not null").orderBy("doc_id")
    samples = {}
    for d in docs.select("lang", "text").collect():
        if len(samples.setdefault(d.lang, [])) < 12:
            samples[d.lang].append(d.text[:1500])
    rows = [(i, t, lang) for lang, texts in samples.items() for i, t in enumerate(texts)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = []
    for i in range(50):
        parts = [r.choice(samples[lang]) for lang in r.sample(sorted(samples), 1 + i % len(samples))]
        parts = [p[(at := r.randrange(max(1, len(p) - 200))):at + r.randrange(40, 200)] for p in parts]
        texts.append(" ".join(parts + ["".join(r.choices("bcdfghjklmnpqrstvwxz", k=80))] * (i % 5 == 0)))
    texts += [junk(r, 60) for _ in range(4)] + ["q", "Ж" * 300]
    found = language_id.mixtures(*language_id.trigrams(pa.array(texts)), len(texts), model, language_id.Settings())
    for text, share in zip(texts, found, strict=True):
        main, expected = mixture(text, samples)
        if expected.get(None, 0) > 0.9:  # which language has the few stray letters depends on the order of trials
            assert share.sum() < 0.1
            continue
        assert model.languages[share.argmax()] == main
        assert np.allclose(share, [expected.get(lang, 0) for lang in model.languages], atol=0.02)
        assert abs(1 - share.sum() - expected.get(None, 0)) < 0.02


def junk(r, words):
    return " ".join("".join(r.choices("bcdfghjklmnpqrstvwxz", k=r.randrange(2, 10))) for _ in range(words))


def test_letters_of_no_language(spark):
    r = random.Random(9)
    clean = "lato mira solan teru " * 20
    rows = [(i, junk(r, 50)) for i in range(10)] + [(20, clean), (21, clean + junk(r, 60)), (22, "1 2"), (23, None)]
    model = language_id.train(labelled(spark))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {x["row"]["doc_id"]: x for x in language_id.identify(df, model).collect()}
    assert all(found[i].unknown > 0.9 and found[i].lang_pred in ("aa", "bb") and found[i].score < 0.1 for i in range(10))
    assert (found[20].unknown, found[20].lang_pred, found[20].score) == (0, "aa", 1)
    assert found[21].lang_pred == "aa" and 0.3 < found[21].unknown < 0.7
    assert all((found[i].unknown, found[i].lang_pred) == (0, "und") for i in (22, 23))


def test_blocks_do_not_change_mixtures(spark, monkeypatch):
    texts = list(alphabets(9).items())
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    mixed = pa.array([texts[0][1] * 4 + texts[5][1] * 2 + texts[8][1], texts[3][1], "", texts[7][1] * 30 + texts[6][1] * 3])
    shares = []
    for block in (64, 4, 1):
        monkeypatch.setattr(language_id, "BLOCK", block)
        model = language_id.train(docs)
        assert len(model.blocks) == -(-9 // block)
        shares.append(language_id.mixtures(*language_id.trigrams(mixed), 4, model, language_id.Settings()))
    assert np.allclose(shares[0], shares[1]) and np.allclose(shares[0], shares[2])
    assert [np.flatnonzero(p).tolist() for p in shares[0]] == [[0, 5, 8], [3], [], [6, 7]]


def test_trigrams_stay_within_texts():
    alone = [language_id.trigrams(pa.array([t]))[0].tolist() for t in ("ab c", "", "de")]
    buckets, row = language_id.trigrams(pa.array(["ab c", "", "de"]))
    assert buckets.tolist() == alone[0] + alone[2] and row.tolist() == [0, 0, 0, 2, 2]
    assert np.array_equal(language_id.trigrams(pa.array(["AB C"]))[0], alone[0])
