"""Byte-level BPE: encoding by a segment tree over adjacent pair ranks, and decoding.

Each pre-token owns a segment tree whose leaf i is the rank of the pair that
starts at symbol i (infinite if that pair never merges). The root is the lowest
rank, leftmost on ties; a merge updates three leaves and their paths, in
O(log n). Trees of equal size are rows of one numpy matrix, so that thousands of
pre-tokens take a step together.
"""

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from annalist.llm.common import small_batches

VOCABULARY = "byte_bpe_50k.json"
#: The published pattern of byte-level BPE with this vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens of a generation, and their bytes, about; a worker remembers two of them, and forgets the older when the younger is full, which costs time only.
REMEMBERED, REMEMBERED_BYTES = 100_000, 16 << 20
#: Pre-tokens of more bytes have a tree each.
LONG = 512
#: Cells of one matrix of trees.
CELLS = 1 << 18
_NEVER = np.int64(1) << np.int64(62)


def vocabulary_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, letters = told["model"], byte_letters()
        ids, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.bytes_of = {i: bytes(map(letters.__getitem__, s)) for s, i in ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.strings = {self.bytes_of[i]: i for i in ids.values()}
        self.first = np.array([ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        # of a pair that is listed again, the last place counts, as in a map
        ranks = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self.pair_ranks = ranks
        self.keys = np.array(sorted(ranks), np.int64)
        self.ranks = np.array([ranks[k] for k in self.keys.tolist()], np.int64)
        self.made = made
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER)

    def pieces(self, text: str) -> Iterator[tuple[int | None, list[str]]]:
        """(id of a special token, or None; pre-tokens) along the text."""
        if self.split_special is None or not any(s in text for s in self.special):
            yield None, self.pattern.findall(text)
            return
        for k, part in enumerate(self.split_special.split(text)):
            if k % 2:
                yield self.special[part], []
            elif part:
                yield None, self.pattern.findall(part)

    def merge(self, tokens: list[bytes]) -> list[np.ndarray]:
        """Ids of each byte string, merged by segment trees."""
        out: list[np.ndarray] = [None] * len(tokens)
        lens = np.array([len(t) for t in tokens], np.int64)
        sizes = np.maximum(2, 1 << np.ceil(np.log2(np.maximum(lens, 1))).astype(np.int64))
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            if size >= LONG:
                for row in rows:
                    out[row] = self._merge_long(tokens[row])
                continue
            step = max(1, CELLS // int(size))
            for k in range(0, len(rows), step):
                some = rows[k : k + step]
                for row, ids in zip(some, self._merge_rows([tokens[r] for r in some], int(size)), strict=True):
                    out[row] = ids
        return out

    def _merge_rows(self, tokens: list[bytes], size: int) -> Iterable[np.ndarray]:
        n, lens = len(tokens), np.array([len(t) for t in tokens])
        live = np.arange(size) < lens[:, None]
        symbol = np.zeros((n, size + 1), np.int64)
        symbol[:, :size][live] = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        after = np.tile(np.arange(1, size + 2), (n, 1))  # size + 1 columns; a next of at least the length is none
        before = np.tile(np.arange(-1, size), (n, 1))
        ends = lens.astype(np.int64)
        tree = np.full((n, 2 * size), _NEVER, np.int64)
        pairs = live[:, 1:]
        leaf = np.full((n, size - 1), _NEVER, np.int64)
        ranks = self.rank(symbol[:, : size - 1][pairs], symbol[:, 1:size][pairs])
        leaf[pairs] = ranks
        tree[:, size : 2 * size - 1] = np.where(leaf < _NEVER, leaf * size + np.arange(size - 1), _NEVER)
        level = size
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        rows = np.flatnonzero(tree[:, 1] < _NEVER)
        while len(rows):
            root = tree[rows, 1]
            rank, at = root // size, root % size
            right = after[rows, at]
            beyond = after[rows, right]
            symbol[rows, at] = self.made[rank]
            live[rows, right] = False
            after[rows, at] = beyond
            inner = beyond < ends[rows]
            before[rows[inner], beyond[inner]] = at[inner]
            value = np.full(len(rows), _NEVER, np.int64)
            value[inner] = self.rank(symbol[rows[inner], at[inner]], symbol[rows[inner], beyond[inner]])
            self._set(tree, size, rows, right, np.full(len(rows), _NEVER, np.int64))
            self._set(tree, size, rows, at, np.where(value < _NEVER, value * size + at, _NEVER))
            left = before[rows, at]
            inner = left >= 0
            r, a, b = rows[inner], left[inner], at[inner]
            value = self.rank(symbol[r, a], symbol[r, b])
            self._set(tree, size, r, a, np.where(value < _NEVER, value * size + a, _NEVER))
            rows = rows[tree[rows, 1] < _NEVER]
        flat = symbol[:, :size][live]
        return np.split(flat, np.cumsum(live.sum(1))[:-1])

    def _merge_long(self, token: bytes) -> np.ndarray:
        """The same for one long pre-token, without matrices."""
        n, never = len(token), int(_NEVER)
        size = 1 << (n - 1).bit_length()
        symbol, made, ranks = self.first[np.frombuffer(token, np.uint8)].tolist(), self.made, self.pair_ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [never] * (2 * size)

        def value(left: int, right: int) -> int:
            rank = ranks.get(symbol[left] << 32 | symbol[right])
            return never if rank is None else rank * size + left

        def put(leaf: int, v: int) -> None:
            at = leaf + size
            tree[at] = v
            while at > 1:
                at >>= 1
                least = min(tree[2 * at], tree[2 * at + 1])
                if tree[at] == least:
                    return
                tree[at] = least

        for i in range(n - 1):
            tree[size + i] = value(i, i + 1)
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        while tree[1] < never:
            rank, at = divmod(tree[1], size)
            right = after[at]
            symbol[at], symbol[right] = int(made[rank]), -1
            beyond = after[at] = after[right]
            put(right, never)
            if beyond < n:
                before[beyond] = at
            put(at, value(at, beyond) if beyond < n else never)
            if (left := before[at]) >= 0:
                put(left, value(left, at))
        return np.array([x for x in symbol if x >= 0], np.int64)

    @staticmethod
    def _set(tree: np.ndarray, size: int, rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        at = leaf + size
        tree[rows, at] = value
        while size > 1:
            at = at >> 1
            tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])
            size >>= 1


@lru_cache(2)
def vocabulary(path: str | None = None) -> Vocabulary:
    return Vocabulary(vocabulary_path(path))


class Memory:
    """What was computed for pre-tokens, in two generations of bounded size."""

    def __init__(self, make):
        self.make, self.known, self.old, self.size = make, {}, {}, 0

    def learn(self, pieces: Iterable[list[str]]) -> dict:
        """A dictionary with all pieces."""
        if len(self.known) > REMEMBERED or self.size > REMEMBERED_BYTES:
            self.known, self.old, self.size = {}, self.known if self.size <= 2 * REMEMBERED_BYTES else {}, 0
        new = set().union(*pieces).difference(self.known)
        # a string and what is known of it take some four times its length
        self.size += 4 * sum(map(len, new))
        found = new & self.old.keys()
        self.known.update((t, self.old[t]) for t in found)
        if new := [*(new - found)]:
            self.known.update(zip(new, self.make(new), strict=True))
        return self.known


class Encoder:
    """Ids of whole texts, with a bounded memory of pre-tokens."""

    def __init__(self, path: str | None = None):
        self.v = vocabulary(path)
        self.memory = Memory(lambda new: (ids.astype("<u4").tobytes() for ids in self.v.merge([t.encode() for t in new])))

    def encode_batch(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [[*self.v.pieces(t)] for t in texts]
        known = self.memory.learn([p for parts in split for _, p in parts])
        for parts in split:
            yield b"".join(np.uint32(i).astype("<u4").tobytes() if i is not None else b"".join(map(known.__getitem__, p)) for i, p in parts)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.v.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(2)
def encoder(path: str | None = None) -> Encoder:
    return Encoder(path)


def some_texts(batch: pa.RecordBatch, name: str = "text", most: int = 2 << 20) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts (nulls as empty) of about most bytes."""
    texts = [t or "" for t in batch.column(name).to_pylist()]
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= most or k == len(texts) - 1:
            yield at, texts[at : k + 1]
            at, size = k + 1, 0


def encode(docs: DataFrame, path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """docs with `ids` (array of ints, if keep_ids), `n_tokens`, `ids_sha256`, `decoded_sha256`.

    A null text counts as empty, an empty text has no ids and the hashes of the
    empty string. Texts are encoded whole; a special token's string in a text is
    that token. Rows stay as they are, repeated or not; other columns are kept,
    those named as the new ones are replaced.
    """
    small_batches(docs.sparkSession)
    new = {"ids": "array<int>", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    if not keep_ids:
        new.pop("ids")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"{k} {v}" for k, v in new.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for at, texts in some_texts(batch):
                coded = [*coder.encode_batch(texts)]
                part = batch.slice(at, len(texts))
                made = {
                    "ids": lambda: pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in coded], pa.list_(pa.int32())),
                    "n_tokens": lambda: pa.array([len(c) // 4 for c in coded], pa.int64()),
                    "ids_sha256": lambda: pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                    "decoded_sha256": lambda: pa.array([hashlib.sha256(coder.decode(c).encode()).hexdigest() for c in coded]),
                }
                yield pa.RecordBatch.from_arrays([*part.columns, *(made[k]() for k in new)], names=[*part.schema.names, *new])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded with `decoded`, the text of the column `ids` (null ids: null; no ids: empty)."""
    small_batches(encoded.sparkSession)
    encoded = encoded.drop("decoded")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema), "decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            texts = [None if ids is None else coder.decode(np.array(ids, "<u4").tobytes()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)
