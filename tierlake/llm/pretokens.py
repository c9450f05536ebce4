"""Byte-level BPE without the tokenizer's per-word cost: split, look up, merge only what is left."""

import functools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Regex, Tokenizer, normalizers

from tierlake.llm.runtime import ragged, slices, utf8

OTHER, LETTER, NUMBER, SPACE = range(4)


@functools.cache
def char_classes() -> np.ndarray:
    """Class of every code point, asked of the library's own pattern engine."""
    table = np.zeros(0x110000, np.uint8)
    asked = [
        (kind, normalizers.Replace(Regex(pattern), "\0"))
        for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s"))
    ]
    for low in range(0, 0x110000, 0x800):
        if low == 0xD800:
            continue
        chars = "".join(map(chr, range(low, low + 0x800)))
        for kind, pattern in asked:
            marked = np.frombuffer(pattern.normalize_str(chars).encode("utf-32-le"), "<u4")
            table[low:low + 0x800][marked == 0] = kind
    table[0] = OTHER
    return table


def split(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pre-tokens of concatenated texts: their byte starts (and the end), and each text's first.

    Same cuts as the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|
    \\s+(?!\\S)|\\s+``, found for all characters at once.
    """
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(docs), np.int64)
    cp = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    at = np.concatenate(([0], np.cumsum(1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF))))
    doc_chars = np.searchsorted(at, docs)
    n = len(cp)
    cls = np.full(n + 3, 255, np.uint8)
    cls[:n] = char_classes()[cp]
    first = np.zeros(n + 3, bool)
    first[doc_chars] = True
    starts = first[:n].copy()
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = cls[1:n] != cls[:n - 1]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = cp[:-1] == 32
    space = cls[:n] == SPACE
    starts |= new & ~(after_blank & ~space)
    # Of several white-space characters before a word the last stands by itself or joins the word.
    last = space & (cls[1:n + 1] != SPACE) & ~first[1:n + 1]
    last[0] = False
    last[1:] &= (cls[:n - 1] == SPACE) & ~first[1:n]
    starts |= last
    quote = np.flatnonzero((cp == 39) & starts)
    if len(quote):
        a, b = cp.take(quote + 1, mode="clip"), cp.take(quote + 2, mode="clip")
        in_one, in_two = ~first[quote + 1], ~first[quote + 1] & ~first[quote + 2]
        one = in_one & np.isin(a, [115, 116, 109, 100])
        two = in_two & ~one & (
            ((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108))
        )
        for hit, size in ((quote[one], 2), (quote[two], 3)):
            starts[hit + 1] = False
            rest = hit[(cls[hit + size] == LETTER) & ~first[hit + size]] + size
            starts[rest] = True
    chars = np.flatnonzero(starts)
    return np.append(at[chars], at[-1]), np.searchsorted(chars, doc_chars)


class WordTable:
    """Token ids of pre-tokens: whole tokens by look-up, merges for the others.

    Which vocabulary strings are whole tokens is proved once per worker: each is encoded alone by
    the library and belongs to the set only if it comes back as one token.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        splitter, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only plain byte-level tokenizers are supported")
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        back = {c: b for b, c in byte_letters().items()}
        ranks = {
            bytes(back[c] for c in piece): rank
            for piece, rank in model["vocab"].items() if piece not in set(self.special)
        }
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [model["vocab"]["".join(pair)] for pair in pairs]
        if merged != sorted(merged) or model.get("ignore_merges"):
            raise ValueError("the ids of merged tokens have to follow the order of the merges")
        self.merges = tiktoken.Encoding(
            "words", pat_str=r"[^\x00]+|\x00", mergeable_ranks=ranks, special_tokens={}
        )
        self.gap = ranks[b"\0"]
        words = [w for w in map(_text, ranks) if w]
        alone = self.library.encode_batch_fast(words, add_special_tokens=False)
        whole = [(w.encode(), e.ids[0]) for w, e in zip(words, alone, strict=True) if len(e.ids) == 1]
        self.whole = pa.array([w for w, _ in whole], pa.large_binary())
        self.whole_ids = np.array([i for _, i in whole], np.int64)

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has; one call, a NUL between words."""
        odd = [i for i, w in enumerate(words) if b"\0" in w]
        if odd:
            parts = [self.merges.encode_ordinary(w.decode()) for w in words]
            return np.concatenate(parts).astype(np.int64), np.array([len(p) for p in parts])
        ids = self.merges.encode_to_numpy(b"\0".join(words).decode()).astype(np.int64)
        gaps = np.flatnonzero(ids == self.gap)
        return np.delete(ids, gaps), np.diff(np.concatenate(([-1], gaps, [len(ids)]))) - 1

    def _words(self, texts: pa.Array):
        """Each text's first word, per word its code, and the ids of all codes end to end."""
        data, docs = utf8(texts)
        starts, doc_words = split(data, docs)
        words = slices(data, starts)
        whole = pc.index_in(words, value_set=self.whole)
        missing = whole.is_null()
        codes = whole.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        rest = words.filter(missing).dictionary_encode()
        ids, sizes = self.whole_ids, np.ones(len(self.whole_ids), np.int64)
        if len(rest):
            codes[missing.to_numpy(zero_copy_only=False)] = rest.indices.to_numpy() + len(ids)
            merged, lengths = self._merge(rest.dictionary.to_pylist())
            ids, sizes = np.concatenate((ids, merged)), np.concatenate((sizes, lengths))
        return doc_words, codes, ids, sizes

    def _by_library(self, texts: pa.Array) -> dict[int, list[int]]:
        """Rows that hold a special string; how it is cut out is the library's own matter."""
        rows: set[int] = set()
        for special in self.special:
            hits = pc.match_substring(texts, special).fill_null(False)
            rows.update(np.flatnonzero(hits.to_numpy(zero_copy_only=False)).tolist())
        found = sorted(rows)
        encoded = self.library.encode_batch_fast([texts[i].as_py() for i in found], add_special_tokens=False)
        return {i: e.ids for i, e in zip(found, encoded, strict=True)}

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; a null has none."""
        doc_words, codes, _, sizes = self._words(texts)
        out = np.diff(np.concatenate(([0], np.cumsum(sizes[codes])))[doc_words])
        for i, ids in self._by_library(texts).items():
            out[i] = len(ids)
        return out

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts end to end, and the offsets of each text's ids."""
        doc_words, codes, ids, sizes = self._words(texts)
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        out = ids[ragged(starts[codes], sizes[codes])]
        at = np.concatenate(([0], np.cumsum(sizes[codes])))[doc_words]
        special = self._by_library(texts)
        if special:
            parts = [special.get(i, out[at[i]:at[i + 1]]) for i in range(len(texts))]
            out = np.concatenate(parts).astype(np.int64)
            at = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return out, at


def _text(word: bytes) -> str | None:
    try:
        return word.decode()
    except UnicodeDecodeError:
        return None


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte.

    Bytes that print as Latin-1 stand for themselves, the others follow from code point 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@functools.cache
def word_table(path: str) -> WordTable:
    return WordTable(path)
