"""Benchmark decontamination by latent semantic retrieval.

Benchmark items span a vocabulary; its document frequencies are counted over all
documents. A randomised SVD (one power step) of TF-IDF passages, those of the
items and of all documents, gives a latent space. All windows of all documents,
at lengths near those of the items, are projected into it (a window is a
difference of running sums), and windows near an item by cosine are candidates. A
candidate is a leak if the longest common subsequence of words
covers enough of the item, or, for paraphrases, less of it but its answer: the
last part of the item.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm import textnum as tn
from annalist.llm.common import small_batches

#: Dimensions of the latent space, and more of the random start.
RANK, EXTRA = 48, 8
#: Words of the SVD's passages; all documents together weigh in it as so many against the items, if they are more. Sums are in fractions of this size, so that their order doesn't matter.
PASSAGE, WEIGHT, GRAIN = 48, 2000, 1 << 20
#: Items of a block; each block is a pass over the documents.
BLOCK = 1000
#: Terms in more of the documents don't tell items apart; an item keeps at least so many terms all the same.
COMMON, FEWEST = 0.1, 4
#: The least cosine of a candidate; the share of an item that a leak has in common with it; with the answer, a lower one.
COSINE, SHARE = 0.6, 0.8
LOOSE_SHARE, ANSWER_SHARE, ANSWER_PART = 0.6, 0.9, 0.25
#: Window lengths grow by this factor; windows start every fourth of their length.
STEP = 4 / 3


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    data, bounds = tn.buffers(pa.array(texts, pa.string()), latin=True)
    starts, ends, edges = tn.words(data, bounds, tn.PUNCT)
    h = tn.hashes(data, starts, ends)
    return [h[a:z] for a, z in zip(edges[:-1], edges[1:], strict=True)]


def common_subsequence(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over the item."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for w in words.tolist():
        if m := masks.get(w):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(item) - row.bit_count()


@dataclass
class Model:
    keys: np.ndarray
    latent: np.ndarray
    bits: np.ndarray
    ids: list
    words: list[np.ndarray]
    #: (window length, items, their unit vectors, the least number of known terms in a window and its room, the room)
    scales: list[tuple[int, np.ndarray, np.ndarray, float, int]]
    #: item * len(keys) + term, rising, for the known terms of the items, and how many places of each item these fill
    pairs: np.ndarray
    known: np.ndarray

    def terms(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _find(self.keys, self.bits, h)


def _bits(keys: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 20, bool)
    bits[(keys & np.uint64(0xFFFFF)).astype(np.int64)] = True
    return bits


def _find(keys: np.ndarray, bits: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some = np.flatnonzero(bits[(h & np.uint64(0xFFFFF)).astype(np.int64)])
    at = np.minimum(np.searchsorted(keys, h[some]), len(keys) - 1)
    hit = keys[at] == h[some]
    return some[hit], at[hit]


def _hashed(batch: pa.RecordBatch):
    for at, end, data, bounds in tn.chunks(batch.column("text"), latin=True):
        starts, ends, edges = tn.words(data, bounds, tn.PUNCT)
        yield at, end, tn.hashes(data, starts, ends), edges


def _frequencies(docs: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each key is, and how many documents there are."""
    bits = _bits(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(len(keys), np.int64), 0
        for batch in batches:
            for at, end, h, edges in _hashed(batch):
                place, term = _find(keys, bits, h)
                owner = np.searchsorted(edges, place, "right") - 1
                seen = np.unique(owner * np.int64(len(keys)) + term)
                df += np.bincount(seen % len(keys), minlength=len(keys))
                rows += end - at
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *hit.tolist()], pa.int64()), pa.array([rows, *df[hit].tolist()], pa.int64())], names=["t", "df"])

    df, total = np.zeros(len(keys), np.int64), 0
    for r in docs.select("text").mapInArrow(run, "t bigint, df bigint").groupBy("t").agg(F.sum("df").alias("df")).collect():  # a row for each key at most
        if r["t"] < 0:
            total = r["df"]
        else:
            df[r["t"]] = r["df"]
    return df, total


def _start(terms: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((terms, RANK + EXTRA)).astype(np.float32)


def _power(passage: np.ndarray, term: np.ndarray, idf: np.ndarray, start: np.ndarray, out: np.ndarray) -> None:
    """Adds A'A start of the passages' TF-IDF rows to out; passage is not falling."""
    if not len(term):
        return
    first = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    w = idf[term].astype(np.float32)[:, None]
    rows = np.add.reduceat(start[term] * w, first, axis=0)
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(term))))
    by = np.argsort(term, kind="stable")
    ends = np.flatnonzero(np.concatenate([[True], term[by][1:] != term[by][:-1]]))
    out[term[by][ends]] += np.add.reduceat(rows[of[by]] * w[by], ends, axis=0)


def _product(docs: DataFrame, keys: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A'A start of the TF-IDF passages of all documents."""
    bits = _bits(keys)
    dims = [f"z{k}" for k in range(RANK + EXTRA)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = _start(len(keys))
        out = np.zeros(start.shape)
        for batch in batches:
            for _, _, h, edges in _hashed(batch):
                place, term = _find(keys, bits, h)
                owner = np.searchsorted(edges, place, "right") - 1
                passage = (place - edges[owner]) // PASSAGE
                _power(owner * np.int64(1 << 32) + passage, term, idf, start, out)
        hit = np.flatnonzero(out.any(1))
        told = np.rint(out[hit] * GRAIN).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(hit), *(pa.array(told[:, k].copy()) for k in range(len(dims)))], names=["t", *dims])

    # of each task a row for each key at most, summed by key
    summed = docs.select("text").mapInArrow(run, ", ".join(f"{c} bigint" for c in ("t", *dims))).groupBy("t").agg(*[F.sum(c).alias(c) for c in dims]).toArrow()
    z = np.zeros((len(keys), RANK + EXTRA))
    z[summed.column("t").to_numpy()] = np.column_stack([summed.column(c).to_numpy() for c in dims])
    return z / GRAIN


def _fit(docs: DataFrame, ids: list, words: list[np.ndarray]) -> Model | None:
    keys = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
    if not len(keys):
        return None
    df, total = _frequencies(docs, keys)
    rare = df <= COMMON * total
    for w in words:
        at = np.searchsorted(keys, np.unique(w))
        if rare[at].sum() < FEWEST:
            rare[at] = True
    idf = np.log((1.0 + total) / (1.0 + df[rare])) + 1e-3
    keys = keys[rare]
    bits = _bits(keys)
    z = _product(docs, keys, idf) * min(1.0, WEIGHT / max(1, total))
    own, start = np.zeros((len(keys), RANK + EXTRA)), _start(len(keys))
    found = [_find(keys, bits, w) for w in words]
    for _, term in found:
        _power(np.zeros(len(term), np.int64), term, idf, start, own)
    v = np.linalg.svd(z + own, full_matrices=False)[0][:, :RANK]
    latent = (v * idf[:, None]).astype(np.float32)
    scales, lengths = [], np.array([len(w) for w in words])
    low, high = 0, 8
    while low < max(lengths, default=0):
        some = np.flatnonzero((lengths > low) & (lengths <= high))
        some = np.array([i for i in some if len(found[i][1])], np.int64)
        if len(some):
            rows = np.array([latent[found[i][1]].sum(0) for i in some])
            rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
            window = int(np.ceil((max(low, 4) * high) ** 0.5))
            known = np.array([len(found[i][1]) for i in some])
            scales.append((window, some, rows.astype(np.float32), float(_needed(known, lengths[some]).min()), int(_room(lengths[some]).max())))
        low, high = high, int(np.ceil(high * STEP))
    pairs = np.unique(np.concatenate([i * np.int64(len(keys)) + term for i, (_, term) in enumerate(found)]))
    return Model(keys, latent, bits, ids, words, scales, pairs, np.array([len(term) for _, term in found]))


def _needed(known, length):
    """Known terms of an item that a leak has at least: it lacks (1 - LOOSE_SHARE) of the item's words at most, so it has the other known ones."""
    return known - (1 - min(LOOSE_SHARE, SHARE)) * length


def _room(length):
    """Words around a window that a common subsequence may use."""
    return np.maximum(2, length // 2)


def _may_leak(m: Model, h, place, term, edges, text, item, first, last, lengths) -> np.ndarray:
    """Which candidates have enough of the item's known terms around."""
    need = _needed(m.known[item], lengths[item])
    room = _room(lengths[item])
    a = np.searchsorted(place, np.maximum(first - room, edges[text]))
    count = np.searchsorted(place, np.minimum(last + room, edges[text + 1])) - a
    which = np.repeat(np.arange(len(item)), count)
    at = np.arange(len(which)) + np.repeat(a - (np.cumsum(count) - count), count)
    pair = item[which] * np.int64(len(m.keys)) + term[at]
    found = m.pairs[np.minimum(np.searchsorted(m.pairs, pair), len(m.pairs) - 1)] == pair
    return np.bincount(which, found, len(item)) >= need - 1e-9


def _leaks(m: Model, h: np.ndarray, edges: np.ndarray) -> dict[int, dict[int, tuple[float, float]]]:
    """Of each text: item -> (cosine, share) of its leaks."""
    place, term = m.terms(h)
    if not len(place):
        return {}
    sums = np.zeros((len(place) + 1, m.latent.shape[1]))
    np.cumsum(m.latent[term], axis=0, out=sums[1:])
    tried: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
    n, lengths = np.diff(edges), np.array([len(w) for w in m.words])
    for window, items, rows, least, room in m.scales:
        step = max(1, window // 4)
        count = np.where(n > 0, np.maximum(0, -(-(n - window) // step)) + 1, 0)
        owner = np.repeat(np.arange(len(n)), count)
        first = edges[owner] + step * (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
        last = np.minimum(first + window, edges[owner + 1])
        a, z = np.searchsorted(place, first), np.searchsorted(place, last)
        around = np.searchsorted(place, np.minimum(last + room, edges[owner + 1])) - np.searchsorted(place, np.maximum(first - room, edges[owner]))
        some = np.flatnonzero((z > a) & (around >= least - 1e-9))
        for k in range(0, len(some), 50_000):
            part = some[k : k + 50_000]
            x = (sums[z[part]] - sums[a[part]]).astype(np.float32)
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
            cos = x @ rows.T
            w, i = np.nonzero(cos >= COSINE)
            text, item, a0, z0 = owner[part[w]], items[i], first[part[w]], last[part[w]]
            ok = _may_leak(m, h, place, term, edges, text, item, a0, z0, lengths)
            for row in zip(text[ok].tolist(), item[ok].tolist(), cos[w[ok], i[ok]].tolist(), a0[ok].tolist(), z0[ok].tolist(), strict=True):
                tried.setdefault(row[:2], []).append(row[2:])
    out: dict[int, dict[int, tuple[float, float]]] = {}
    for (text, item), windows in tried.items():
        words = m.words[item]
        room = _room(len(words))
        answer = words[-max(1, round(ANSWER_PART * len(words))) :]
        done = -1
        for cos, a, z in sorted(windows, key=lambda x: x[1]):
            around = h[max(a - room, edges[text]) : min(z + room, edges[text + 1])]
            if a < done:  # the last one looked at, moved by a quarter or less
                continue
            done = a + (z - a) // 4
            share = common_subsequence(words, around) / len(words)
            if share >= SHARE or share >= LOOSE_SHARE and common_subsequence(answer, around) >= ANSWER_SHARE * len(answer):
                best = out.setdefault(text, {}).get(item, (0.0, 0.0))
                out[text][item] = max(best[0], cos), max(best[1], share)
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with `leaks`, an array of (item_id, cosine, share) by item_id: the benchmark items found in each whole text.

    Null and empty texts have none, nor do items without words leak. Repeated
    rows are searched each. Items are taken in blocks, a pass over the documents
    each. Other columns are kept; one named leaks is replaced. benchmark:
    item_id, text; rows that repeat an item_id are items of their own with one id.
    """
    small_batches(docs.sparkSession)
    kind = "array<struct<item_id:bigint,cosine:double,share:double>>"
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "leaks"])
    out = docs.withColumn("leaks", F.array().cast(kind))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"leaks {kind}"])
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64())]))

    def block_pass(frame: DataFrame, model: Model) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = sent.value
            for batch in batches:
                for at, end, h, edges in _hashed(batch):
                    part = batch.slice(at, end - at)
                    found = part.column("leaks").to_pylist()
                    for text, items in _leaks(m, h, edges).items():
                        found[text] = sorted(found[text] + [{"item_id": m.ids[i], "cosine": c, "share": s} for i, (c, s) in items.items()], key=lambda x: (x["item_id"], -x["share"]))
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, arrow)], names=part.schema.names)

        return frame.mapInArrow(run, schema)

    items: list = []
    rows = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator()
    while True:
        row = next(rows, None)
        if row is not None:
            items.append(row)
        if items and (row is None or len(items) == BLOCK):
            if model := _fit(docs, [r["item_id"] for r in items], item_words([r["text"] for r in items])):
                out = block_pass(out, model)
            items = []
        if row is None:
            return out
