"""Byte-level BPE: merges chosen by a segment tree over byte positions.

The tree's leaf at a live position holds (rank of the pair that starts there, position) as one integer, so the root is
the leftmost minimum rank. A merge removes one position and changes at most three leaves: the merged position, the
removed one and the live neighbour to the left; each is a point update of logarithmic cost. Short pieces are merged
many at a time, one tree for each row of an array; long pieces one at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronicell.llm.base import give_back_memory, small_batches, table, text_or_empty

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Python's \s counts four control characters as white space that the pattern's own dialect does not.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Widths of the trees that are merged together; longer pieces get a tree of their own.
_WIDTHS = (8, 16, 32, 64)
_NONE = np.int32(1 << 30)
#: Most pieces, and characters of pieces, whose ids a Python worker remembers, and bytes of text that it encodes at a time.
CACHE_PIECES, CACHE_CHARS, SLICE_BYTES = 400_000, 16_000_000, 1_000_000


# Ranges of letters and numbers that are younger than the Unicode version of the encoders in use, which
# take them for other characters.
_YOUNGER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2),
    (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F),
    (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED),
    (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_YOUNGER_SET = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in _YOUNGER)


def compile_pattern(pattern: str) -> Callable[[str], list[str]]:
    """A function that splits a text as the pattern's own dialect does."""
    usual = pattern.replace(r"[^\s", "[^" + _WHITE).replace(r"\S", f"[^{_WHITE}]").replace(r"\s", f"[{_WHITE}]")
    other = f"[^{_WHITE}\\p{{L}}\\p{{N}}]"
    strict = usual.replace(other, f"(?:{other}|[{_YOUNGER_SET}])")
    for kind in ("L", "N"):
        strict = strict.replace(f" ?\\p{{{kind}}}+", f" ?(?:(?![{_YOUNGER_SET}])\\p{{{kind}}})+")
    find, find_strict, younger = regex.compile(usual).findall, regex.compile(strict).findall, re.compile(f"[{_YOUNGER_SET}]").search
    return lambda text: find(text) if text.isascii() or not younger(text) else find_strict(text)


class Vocabulary:
    """Ranks of a file and, from them, the rank that each pair of tokens merges into."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        self.tokens = {r: t for t, r in self.ranks.items()}
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        self._keys = np.array(sorted(pairs), np.int64)
        self._to = np.array([pairs[k] for k in self._keys.tolist()], np.int32)
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self._keys = np.append(self._keys, np.int64(-1))  # so that a search past the end has something to miss
        self._to = np.append(self._to, _NONE)
        self._size = len(pairs)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self._keys[: self._size], key)
        return np.where(self._keys[at] == key, self._to[at], _NONE)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_one(piece: bytes, vocab: Vocabulary) -> list[int]:
    """One piece of any length: O(n log n) with a tree over all its positions."""
    n = len(piece)
    width = 1
    while width < n:
        width *= 2
    none, pairs = 1 << 62, vocab.pairs
    tok = vocab.bytes[np.frombuffer(piece, np.uint8)].tolist()
    nxt, prv, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    tree = [none] * (2 * width)

    def key(i: int) -> int:
        j = nxt[i]
        rank = pairs.get(tok[i] << 32 | tok[j]) if j < n else None
        return none if rank is None else rank * width + i

    for i in range(n):
        tree[width + i] = key(i)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: int) -> None:
        node = width + i
        tree[node] = value
        while node > 1:
            node >>= 1
            best = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best

    while tree[1] < none:
        rank, i = divmod(tree[1], width)
        j = nxt[i]
        tok[i], live[j], nxt[i] = rank, False, nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        put(j, none)
        put(i, key(i))
        if prv[i] >= 0:
            put(prv[i], key(prv[i]))
    return [t for t, alive in zip(tok, live) if alive]


def merge_many(pieces: list[bytes], vocab: Vocabulary, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of 2 to ``width`` bytes, all at once: (ids of all pieces in order, number of ids of each piece)."""
    n = len(pieces)
    size = np.array([len(p) for p in pieces])
    at = np.arange(width)
    inside = at < size[:, None]
    data = np.zeros((n, width), np.uint8)
    data[inside] = np.frombuffer(b"".join(pieces), np.uint8)
    tok = vocab.bytes[data]
    nxt = np.tile(np.arange(1, width + 1, dtype=np.int64), (n, 1))
    prv = np.tile(np.arange(-1, width - 1, dtype=np.int64), (n, 1))
    live = inside.copy()
    tree = np.full((n, 2 * width), _NONE, np.int32)

    def keys(rank: np.ndarray, pos: np.ndarray) -> np.ndarray:
        return np.where(rank == _NONE, _NONE, rank * width + pos).astype(np.int32)

    first = np.where(inside[:, 1:], vocab.pair_ranks(tok[:, :-1], tok[:, 1:]), _NONE)
    tree[:, width : 2 * width - 1] = keys(first, at[:-1])
    level = width // 2
    while level:
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        level //= 2

    rows = np.flatnonzero(tree[:, 1] < _NONE)
    while len(rows):
        rank, i = np.divmod(tree[rows, 1], width)
        i = i.astype(np.int64)
        j = nxt[rows, i]
        k, p = nxt[rows, j], prv[rows, i]
        tok[rows, i] = rank
        live[rows, j] = False
        nxt[rows, i] = k
        has_k, has_p = k < size[rows], p >= 0
        k_in, p_in = np.where(has_k, k, 0), np.where(has_p, p, 0)
        prv[rows[has_k], k[has_k]] = i[has_k]
        after = np.where(has_k, vocab.pair_ranks(rank, tok[rows, k_in]), _NONE)
        before = np.where(has_p, vocab.pair_ranks(tok[rows, p_in], rank), _NONE)
        tree[rows, width + j] = _NONE
        tree[rows, width + i] = keys(after, i)
        tree[rows[has_p], width + p[has_p]] = keys(before, p_in)[has_p]
        nodes = [width + j, width + i, np.where(has_p, width + p, width + i)]
        while nodes[0][0] > 1:
            nodes = [x >> 1 for x in nodes]
            for x in nodes:
                tree[rows, x] = np.minimum(tree[rows, 2 * x], tree[rows, 2 * x + 1])
        rows = rows[tree[rows, 1] < _NONE]
    return tok[live], live.sum(axis=1)


def merge_pieces(pieces: list[bytes], vocab: Vocabulary) -> list[np.ndarray]:
    """The ids of every piece; a piece that is itself a token is that token, as in the reference format's library."""
    out: list = [None] * len(pieces)
    by_width: dict[int, list[int]] = {w: [] for w in _WIDTHS}
    for k, piece in enumerate(pieces):
        rank = vocab.ranks.get(piece)
        if rank is not None:
            out[k] = np.array([rank], np.int32)
        elif len(piece) > _WIDTHS[-1]:
            out[k] = np.array(merge_one(piece, vocab), np.int32)
        else:
            by_width[next(w for w in _WIDTHS if len(piece) <= w)].append(k)
    for width, which in by_width.items():
        step = 1 << 17 >> width.bit_length()
        for lo in range(0, len(which), step):
            part = which[lo : lo + step]
            ids, counts = merge_many([pieces[k] for k in part], vocab, width)
            for k, own in zip(part, np.split(ids, np.cumsum(counts)[:-1])):
                out[k] = own
    return out


class Encoder:
    """Splits by the pattern and merges every different piece once while it stays in the worker's memory."""

    def __init__(self, path: str, pattern: str):
        self.vocab, self.find = vocabulary(path), compile_pattern(pattern)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.start, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = self.chars = 0

    def _learn(self, pieces: list[str]) -> None:
        found = merge_pieces([p.encode() for p in pieces], self.vocab)
        lens = np.array([len(x) for x in found])
        at, end = len(self.place), len(self.place) + len(pieces)
        ids_end = self.used + int(lens.sum())
        if end > len(self.start):
            grow = max(end, 2 * len(self.start))
            self.start, self.count = np.resize(self.start, grow), np.resize(self.count, grow)
        if ids_end > len(self.flat):
            self.flat = np.resize(self.flat, max(ids_end, 2 * len(self.flat)))
        self.flat[self.used : ids_end] = np.concatenate(found)
        self.count[at:end] = lens
        self.start[at:end] = self.used + np.cumsum(lens) - lens
        self.used = ids_end
        self.chars += sum(map(len, pieces))
        self.place.update(zip(pieces, range(at, end)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each text)."""
        split = [self.find(t) for t in texts]
        pieces = [p for s in split for p in s]
        if len(self.place) > CACHE_PIECES or self.chars > CACHE_CHARS:
            self.forget()
        if new := [p for p in dict.fromkeys(pieces) if p not in self.place]:
            self._learn(new)
        at = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        counts, ends = self.count[at], np.cumsum(self.count[at])
        take = np.repeat(self.start[at] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
        bounds = np.cumsum([len(s) for s in split])
        upto = np.concatenate([[0], ends])[bounds]
        return self.flat[take], np.diff(upto, prepend=0)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, row after the last, texts) of slices; only one slice is copied at a time, nulls as empty texts."""
    sizes = pc.binary_length(texts).fill_null(0).to_pylist()
    lo = size = 0
    for k in range(len(sizes) + 1):
        if k == len(sizes) or (size and size + sizes[k] > SLICE_BYTES):
            if k > lo:
                yield lo, k, [t or "" for t in texts.slice(lo, k - lo).to_pylist()]
            lo, size = k, 0
        if k < len(sizes):
            size += sizes[k]


def _encode(path: str, pattern: str, text_col: str, schema: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for lo, hi, texts in _slices(batch.column(text_col)):
                ids, counts = own.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, lists], names=schema)
        own.forget()  # the worker lives on, perhaps for other work
        give_back_memory()

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns of ``docs`` and ids array<int>: the whole text, split by ``pattern``, merged by the ranks in ``path``.

    No special tokens. Null and empty texts get an empty array. A column named like ``ids_col`` is replaced; all other
    columns pass through. No shuffle: rows stay where they are. ``path`` is read on every executor.
    """
    small_batches(docs.sparkSession)
    rest = docs.drop(ids_col)
    schema = T.StructType([*rest.schema, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return rest.mapInArrow(_encode(path, pattern, text_col, schema.names), schema)


def decode_ids(ids: np.ndarray, vocab: Vocabulary) -> bytes:
    return b"".join(map(vocab.tokens.__getitem__, ids.tolist()))


def _decode(path: str, ids_col: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            lists = batch.column(ids_col)
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            known = lists.is_valid().to_pylist()
            out = [decode_ids(flat[a:b], vocab) if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], known)]
            packed = [flat[a:b].astype("<u4").tobytes() if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], known)]
            sums = [None if x is None else hashlib.sha256(x).hexdigest() for x in packed]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary()), pa.array(sums, pa.string())], names=names)

    return run


def decode_documents(docs: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add decoded (binary: the bytes of the ids) and ids_sha256 (of the ids as little-endian unsigned 32-bit integers).

    Null ids give nulls; columns of these two names are replaced; an id outside the vocabulary is an error.
    """
    small_batches(docs.sparkSession)
    rest = docs.drop("decoded", "ids_sha256")
    schema = T.StructType([*rest.schema, T.StructField("decoded", T.BinaryType()), T.StructField("ids_sha256", T.StringType())])
    return rest.mapInArrow(_decode(path, ids_col, schema.names), schema)


def encode_and_decode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``decode_documents`` of ``encode_documents``, both in one Python worker instead of one after another in two."""
    small_batches(docs.sparkSession)
    rest = docs.drop(ids_col, "decoded", "ids_sha256")
    first = T.StructType([*rest.schema, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    schema = T.StructType([*first, T.StructField("decoded", T.BinaryType()), T.StructField("ids_sha256", T.StringType())])
    encode, decode = _encode(path, pattern, text_col, first.names), _decode(path, ids_col, schema.names)
    return rest.mapInArrow(lambda batches: decode(encode(batches)), schema)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    decoded = encode_and_decode(docs, path)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
