"""SentencePiece encoding by Unigram Viterbi over a double-array trie, and decoding.

A model file gives the pieces with their log scores. Texts are cut where no piece can cross: before
each whitespace marker that follows another character. Each distinct part of a batch is then
segmented once; all parts are searched and scored together, one array step per byte.
"""

import functools
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.runtime import prepare, ragged, slices

MARKER = "▁"
#: Piece types of the model format, and what an unknown character costs beyond the lowest score.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
#: Bytes of distinct parts that are segmented together.
TOGETHER = 1 << 20


def _fields(data: bytes):
    """Number, wire type and value of each field of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(wire) or varint()
        yield number, data[at:at + size]
        at += size


def build_trie(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Double array of byte strings: base, check and the number of the word that ends at a node.

    The child of node s by byte b is t = base[s] + b + 1, if check[t] = s. Nodes are placed at the
    first free slots that take all of their children.
    """
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for number, word in enumerate(words):
        node = 0
        for byte in word:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][byte]
        ends[node] = number
    size = 2 * len(children) + 1024
    base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    free = np.ones(size, bool)
    free[0] = False
    slot = {0: 0}
    first_free, window = 1, 4096
    for node in range(len(children)):
        value[slot[node]] = ends[node]
        follow = sorted(children[node])
        if not follow:
            continue
        first_free += int(free[first_free:].argmax())
        offset = max(0, first_free - follow[0] - 1)
        while True:
            while offset + window + 257 > len(free):
                base, check, value = (
                    np.concatenate((x, np.full(size, fill))) for x, fill in ((base, 0), (check, -1), (value, -1))
                )
                free = np.concatenate((free, np.ones(size, bool)))
            fits = np.logical_and.reduce([free[offset + b + 1:offset + b + 1 + window] for b in follow])
            if fits.any():
                offset += int(fits.argmax())
                break
            offset += window
        base[slot[node]] = offset
        for b in follow:
            free[offset + b + 1] = False
            check[offset + b + 1] = slot[node]
            slot[children[node][b]] = offset + b + 1
    return base, check, value


@dataclass
class Model:
    """Pieces, scores and rules of a model file; only the identity normalisation is supported."""

    pieces: list[str]
    scores: np.ndarray
    types: list[int]
    dummy_prefix: bool = True
    trie: tuple = field(init=False, repr=False)

    def __post_init__(self):
        self.inner = [
            i for i, t in enumerate(self.types) if t in (NORMAL, USER_DEFINED, UNUSED) and self.pieces[i]
        ]
        self.trie = build_trie([self.pieces[i].encode() for i in self.inner])
        normal = [self.scores[i] for i, t in enumerate(self.types) if t == NORMAL]
        lowest, highest = min(normal, default=0.0), max(normal, default=0.0)
        self.unknown = self.types.index(UNKNOWN) if UNKNOWN in self.types else 0
        self.unknown_score = lowest - UNKNOWN_PENALTY
        usable = []
        for i in self.inner:
            if self.types[i] == USER_DEFINED:
                usable.append(len(self.pieces[i]) * highest - 0.1)
            else:
                usable.append(-np.inf if self.types[i] == UNUSED else float(self.scores[i]))
        self.usable = np.array(usable)
        self.inner_ids = np.array(self.inner, np.int64)
        self.byte_ids = np.full(256, -1, np.int64)
        for i, t in enumerate(self.types):
            if t == BYTE:
                self.byte_ids[int(self.pieces[i][1:-1], 16)] = i
        self.has_bytes = bool((self.byte_ids >= 0).all())
        # A marker after another character, within a piece, would let pieces cross the cuts.
        self.cuts = not any(MARKER in self.pieces[i].lstrip(MARKER) for i in self.inner)
        self.texts = [self._text(i) for i in range(len(self.pieces))]

    def _text(self, i: int) -> bytes:
        kind = self.types[i]
        if kind == BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else self.pieces[i].replace(MARKER, " ").encode()

    @classmethod
    def read(cls, path: str) -> "Model":
        with open(path, "rb") as file:
            data = file.read()
        pieces, scores, types, prefix = [], [], [], True
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                types.append(piece.get(3, NORMAL))
            elif number == 3:
                rules = dict(_fields(value))
                prefix = bool(rules.get(3, 1))
                if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("only models without normalisation are supported")
        return cls(pieces, np.array(scores, np.float64), types, prefix)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts end to end, the offsets of each text's ids, and each text's score."""
        marked = [
            ((MARKER if self.dummy_prefix else "") + t.replace(" ", MARKER)).encode() if t else b"" for t in texts
        ]
        data = np.frombuffer(b"".join(marked), np.uint8)
        docs = np.concatenate(([0], np.cumsum([len(m) for m in marked]))).astype(np.int64)
        starts = np.zeros(len(data) + 1, bool)
        starts[docs] = True
        if self.cuts and len(data) > 3:
            mark = np.zeros(len(data) + 3, bool)
            mark[:len(data) - 2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
            before = np.zeros(len(data) + 3, bool)
            before[3:] = mark[:len(data)]
            starts[:len(data)] |= (mark & ~before)[:len(data)]
        at = np.flatnonzero(starts[:len(data)])
        parts = slices(data, np.append(at, len(data))).dictionary_encode()
        ids, sizes, scores = self.segment(parts.dictionary.to_pylist())
        code = parts.indices.to_numpy()
        first = np.searchsorted(at, docs)
        begin = np.concatenate(([0], np.cumsum(sizes)))
        out = ids[ragged(begin[:-1][code], sizes[code])]
        places = np.concatenate(([0], np.cumsum(sizes[code])))[first]
        sums = np.concatenate(([0.0], np.cumsum(scores[code])))[first]
        return out, places, np.diff(sums)

    def segment(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best segmentations of distinct parts: their ids end to end, how many, and the scores."""
        found, low, size = [], 0, 0
        for high, part in enumerate(parts):
            size += len(part)
            if size >= TOGETHER:
                found.append(self._viterbi(parts[low:high + 1]))
                low, size = high + 1, 0
        if low < len(parts) or not found:
            found.append(self._viterbi(parts[low:]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _viterbi(self, parts: list[bytes]):
        data = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(p) for p in parts], np.int64)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(parts), np.int64), np.zeros(len(parts))
        part_end = np.repeat(np.cumsum(sizes), sizes)
        part_start = part_end - np.repeat(sizes, sizes)
        head = (data & 0xC0) != 0x80  # bytes that begin a character
        char = np.flatnonzero(head)
        char_end = np.append(char[1:], len(data))
        # All pieces at all characters: every walk through the trie takes a byte per step.
        base, check, value = self.trie
        begin, node, depth = char, np.zeros(len(char), np.int64), 0
        matches = []
        while len(begin):
            inside = begin + depth < part_end[begin]
            begin, node = begin[inside], node[inside]
            step = base[node] + data[begin + depth] + 1
            ok = check[step.clip(max=len(check) - 1)] == node
            ok &= step < len(check)
            begin, node = begin[ok], step[ok]
            depth += 1
            hit = value[node] >= 0
            matches.append((begin[hit], np.full(hit.sum(), depth), value[node[hit]]))
        start, length, piece = (np.concatenate(x) for x in zip(*matches, strict=True))
        usable = self.usable[piece]
        ids = self.inner_ids[piece]
        # A character that is no piece by itself may be unknown.
        single = np.zeros(len(data), bool)
        one = np.zeros(len(data), np.int64)
        one[char] = char_end - char
        single[start[(length == one[start]) & (usable > -np.inf)]] = True
        lone = char[~single[char]]
        start = np.concatenate((start, lone))
        length = np.concatenate((length, one[lone]))
        usable = np.concatenate((usable, np.full(len(lone), self.unknown_score)))
        ids = np.concatenate((ids, np.full(len(lone), self.unknown)))
        # Best score at every place, by the distance from the part's start; ties: the longer piece.
        end = start + length
        order = np.lexsort((start, end, end - part_start[start]))
        start, end, usable, ids = start[order], end[order], usable[order], ids[order]
        step_of = end - part_start[start]
        bounds = np.flatnonzero(np.concatenate(([True], step_of[1:] != step_of[:-1], [True])))
        best = np.zeros(len(data) + 1)  # of the part that ends, or begins, at a place
        chosen = np.full(len(data) + 1, -1, np.int64)
        arrived = np.zeros(len(data) + 1)
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            s, e = start[low:high], end[low:high]
            from_start = s == part_start[s]
            score = np.where(from_start, 0.0, best[s]) + usable[low:high]
            new = np.flatnonzero(np.concatenate(([True], e[1:] != e[:-1])))
            top = np.maximum.reduceat(score, new)
            is_top = np.flatnonzero(score == np.repeat(top, np.diff(np.append(new, len(e)))))
            first = is_top[np.searchsorted(is_top, new)]
            arrived[e[first]] = score[first]
            chosen[e[first]] = low + first
            inner = e[first] < part_end[s[first]]
            best[e[first][inner]] = score[first][inner]
        ends = np.cumsum(sizes)
        trail, owner = [], []
        place, part = ends.copy(), np.arange(len(parts))
        going = sizes > 0
        place, part = place[going], part[going]
        while len(place):  # all parts one piece back
            pick = chosen[place]
            trail.append(pick)
            owner.append(part)
            more = start[pick] > ends[part] - sizes[part]
            place, part = start[pick][more], part[more]
        trail, owner = np.concatenate(trail[::-1]), np.concatenate(owner[::-1])
        trail = trail[np.argsort(owner, kind="stable")]
        owner = np.sort(owner)
        got, many = ids[trail], np.ones(len(trail), np.int64)
        if self.has_bytes and (got == self.unknown).any():
            lost = got == self.unknown
            many[lost] = (end - start)[trail[lost]]
            out = np.repeat(got, many)
            out[np.repeat(lost, many)] = self.byte_ids[data[ragged(start[trail[lost]], many[lost])]]
            got = out
        total = np.bincount(owner, weights=many, minlength=len(parts)).astype(np.int64)
        return got, total, np.where(sizes > 0, arrived[ends], 0.0)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes are put together, markers become spaces, the added one goes."""
        text = b"".join([self.texts[i] for i in ids]).decode(errors="replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


@functools.cache
def model(path: str) -> Model:
    return Model.read(path)


def encode(docs: DataFrame, path: str, with_ids: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every row under the model's scores, and whether decoding gives the text back.

    Columns: key, n_pieces, n_byte_pieces, score (sum of log scores), ids_crc32 (of little-endian
    32-bit ids), round_trip and, ``with_ids``, ids. Characters without a piece become byte pieces.
    A null text is empty and has no pieces. A text that holds the whitespace marker itself, which
    decodes to a space, is the only one that does not come back. Rows are neither joined nor
    grouped: keys may be null or repeated, other columns do not matter.
    """
    prepare(docs.sparkSession)

    def run(batches):
        own = model(path)
        is_byte = np.zeros(len(own.pieces), bool)
        is_byte[own.byte_ids[own.byte_ids >= 0]] = True
        for batch in batches:
            texts = batch["text"].to_pylist()
            ids, at, score = own.encode(texts)
            flags = np.concatenate(([0], np.cumsum(is_byte[ids])))
            raw = ids.astype("<u4").tobytes()
            low, high = at[:-1].tolist(), at[1:].tolist()
            spans = list(zip(low, high, strict=True))
            flat = ids.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"], pa.array(np.diff(at)), pa.array(flags[at[1:]] - flags[at[:-1]]), pa.array(score),
                    pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in spans], pa.int64()),
                    pa.array([own.decode(flat[a:b]) == (t or "") for (a, b), t in zip(spans, texts, strict=True)]),
                    *([pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))] if with_ids else []),
                ],
                schema.names,
            )

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = T.StructType([rows.schema["key"], *T.StructType.fromDDL(
        "n_pieces long, n_byte_pieces long, score double, ids_crc32 long, round_trip boolean"
        + ", ids array<int>" * with_ids
    ).fields])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns and ``text``, the decoded ids; null ids give a null text."""
    prepare(rows.sparkSession)

    def run(batches):
        own = model(path)
        for batch in batches:
            texts = [None if x is None else own.decode(x) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(texts, pa.string())], ["row", "text"])

    packed = rows.select(F.struct(*[rows[c] for c in rows.columns]).alias("row"), rows[ids].alias("ids"))
    out = packed.mapInArrow(run, T.StructType([packed.schema["row"], T.StructField("text", T.StringType())]))
    return out.select("row.*", "text")
