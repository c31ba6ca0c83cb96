"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Every labelled document is indexed: it belongs to the cell of the example that is
nearest to it, and votes there. The examples, the cells' centres, are a bounded
number of labelled documents, so that the index travels to all tasks; while all
labelled documents are examples, each is a cell of its own. A vector has all words
of the text that any example has (others are alike to all examples). A word weighs
its TF-IDF, with document frequencies of all documents, times its relevance
frequency (Lan et al., "Supervised and Traditional Term Weighting Methods", 2009):
a smooth function of how much oftener it is in labelled documents of label 1 than
of label 0, all counted. No word is chosen or left out by it. The index keeps, for
each term and block of examples, the largest weight: blocks are taken by falling
upper bound, until no block can reach the k-th best, so the nearest cells found are
the exact ones. Their votes, weighted by similarity and members, are calibrated by
isotonic regression on leave-one-out votes of all labelled documents.
"""

import hashlib
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm import textnum as tn
from annalist.llm.common import cut, small_batches, tables

#: At most so many examples, the centres of cells, of each label; all labelled documents are their members.
POSITIVES, NEGATIVES = 2000, 4000
NEIGHBOURS = 15
#: Power of the relevance frequency in a weight.
SHARP = 2
BLOCK = 64
#: A term in more than one of so many examples is frequent.
OFTEN = 12
#: Texts whose frequent terms are multiplied at once.
PRODUCT = 128
LIMIT = 0.3
#: Calibration tells so many votes apart; more are rounded to this number.
VOTES = 1 << 16
#: Bits of the map of labelled ids at most, 4 MB.
ID_BITS = 1 << 25


class Lookup:
    """Places of hashes in a sorted array; a small table of bits turns most others away."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.keys & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of h are keys, the places of those)."""
        some = np.flatnonzero(self.bits[(h & np.uint64(0xFFFFF)).astype(np.int64)])
        if not len(self.keys):
            return some[:0], some[:0]
        at = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
        hit = self.keys[at] == h[some]
        return some[hit], at[hit]


def hashed_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the text of each."""
    starts, ends, _ = tn.words(data, bounds, tn.PUNCT)
    return tn.hashes(data, starts, ends), np.searchsorted(bounds, starts, "right") - 1


def vectors(data: np.ndarray, bounds: np.ndarray, lookup: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, times) of the known words of each text, sorted by text and term."""
    h, owner = hashed_words(data, bounds)
    which, term = lookup.find(h)
    pair, times = np.unique(owner[which] * np.int64(len(lookup.keys) + 1) + term, return_counts=True)
    return pair // (len(lookup.keys) + 1), pair % (len(lookup.keys) + 1), times


def weights(term: np.ndarray, times: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """The unit vector of a text; worth is what a term weighs besides its frequency in the text."""
    w = (1 + np.log(times)) * worth[term]
    n = np.sqrt((w * w).sum())
    return w / n if n else w


def relevance(p: np.ndarray, n: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """log2(1 + max(1, p / max(1, n))) ** SHARP of each term: p of n1 labelled documents of label 1 have it, and n of n0 of label 0, scaled as if the labels had equally many. 1 for a word that is not oftener in label 1."""
    n1, n0 = max(1, n1), max(1, n0)
    return np.log2(1 + np.maximum(1, p / np.maximum(1, n * (n1 / n0)))) ** SHARP


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range of n numbers."""
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


class BlockMaxIndex:
    """Exact k nearest examples by the dot product of unit vectors."""

    def __init__(self, edges: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int):
        """Of example i, the terms and weights from edges[i] to edges[i + 1]; each has one at least."""
        self.n = len(edges) - 1
        self.blocks = -(-self.n // BLOCK)
        # alike examples share blocks: ordered by their heaviest term
        heaviest = np.array([term[a + int(np.argmax(weight[a:z]))] for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)], np.int64)
        self.order = np.argsort(heaviest, kind="stable")
        self.at = np.argsort(self.order)
        self._arrange(np.repeat(self.at.astype(np.int32), np.diff(edges)), term.astype(np.int32), weight, terms)

    def _arrange(self, place: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int) -> None:
        # postings of frequent terms are kept as a matrix, the others as lists
        often = np.flatnonzero(np.bincount(term, minlength=terms) * OFTEN > self.n)
        self.row = np.full(terms, -1, np.int64)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.blocks * BLOCK))
        row = self.row[term]
        at = row >= 0
        self.dense[row[at], place[at]] = weight[at]
        term, place, weight = term[~at], place[~at], weight[~at]
        by = np.lexsort((place, term))
        term, self.place, self.weight = term[by], place[by], weight[by]
        # a cell is the postings of a term in a block
        cell = term * np.int64(self.blocks + 1) + self.place // BLOCK
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])[: len(cell)])
        self.cells = np.append(first, len(cell)).astype(np.int32)
        self.block = (self.place[first] // BLOCK).astype(np.uint16)
        self.best = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.edges = np.searchsorted(term[first], np.arange(terms + 1))

    def frequent(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What frequent terms add to the similarity of each text to each example."""
        x = np.zeros((len(texts), len(self.dense)))
        for i, (term, w) in enumerate(texts):
            row = self.row[term]
            x[i, row[row >= 0]] = w[row >= 0]
        return x @ self.dense

    def all_nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, apart: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """nearest() of each text; with apart the texts are the examples, and none is its own neighbour."""
        for at in range(0, len(texts), PRODUCT):
            part = texts[at : at + PRODUCT]
            for i, (text, base) in enumerate(zip(part, self.frequent(part), strict=True)):
                yield self.nearest(*text, k, at + i if apart else -1, base)

    def nearest(self, term: np.ndarray, w: np.ndarray, k: int, without: int = -1, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(examples, similarities) of the k nearest that share a term, nearest first, ties by example."""
        base = self.frequent([(term, w)])[0] if base is None else base
        rare = self.row[term] < 0
        term, w = term[rare], w[rare]
        n = self.edges[term + 1] - self.edges[term]
        cells, x = _ranges(self.edges[term], n), np.repeat(w, n)
        block = self.block[cells]
        # more than rounding can make of a similarity
        upper = (np.bincount(block, x * self.best[cells], self.blocks) + base.reshape(-1, BLOCK).max(1)) * (1 + 1e-6)
        # weights are not negative: what frequent terms give the k-th best is a floor of what all terms give it
        given = base if without < 0 else np.delete(base, self.at[without])
        floor = np.partition(given, len(given) - k)[len(given) - k] if len(given) >= k else 0.0
        taken = (upper > 0) & (upper >= floor)
        if 2 * taken.sum() < self.blocks:
            here = np.flatnonzero(taken[block])
            first, m, x = self.cells[cells[here]], self.cells[cells[here] + 1] - self.cells[cells[here]], x[here]
        else:  # so many blocks that their postings are read along
            first = self.cells[self.edges[term]]
            m, x = self.cells[self.edges[term + 1]] - first, w
        posting = _ranges(first, m)
        total = (base + np.bincount(self.place[posting], np.repeat(x, m) * self.weight[posting], len(base))).round(12)
        total[np.repeat(~taken, BLOCK)] = 0.0
        if without >= 0:
            total[self.at[without]] = 0.0
        least = np.partition(total, len(total) - k)[len(total) - k] if len(total) > k else 0.0
        hit = np.flatnonzero((total > 0) & (total >= least))
        f, s = self.order[hit], total[hit]
        best = np.lexsort((f, -s))[:k]
        return f[best], s[best]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (from, value) of the weighted isotonic regression of y on x."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), w[order].tolist(), strict=True):
        if pools and pools[-1][0] == a:
            pools[-1][1] += b * c
            pools[-1][2] += c
        else:
            pools.append([a, b * c, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, s, c2 = pools.pop()
            pools[-1][1] += s
            pools[-1][2] += c2
    return np.array([p[0] for p in pools]), np.array([(p[1] + 0.1) / (p[2] + 0.5) for p in pools])


def vote(sims: np.ndarray, share: np.ndarray, labels: np.ndarray) -> float:
    w = sims**2 * share
    return float((w * labels).sum() / w.sum()) if w.sum() else 0.0


def vote_without(found: np.ndarray, sims: np.ndarray, cell: int, label: int, share: np.ndarray, labels: np.ndarray) -> float | None:
    """The vote on a member of a cell by all others; found are one more than vote. None if no other does."""
    n, bad = share[found], share[found] * labels[found]
    own = found == cell
    n, bad = n - own, bad - own * label
    some = np.flatnonzero(n > 0.5)[:NEIGHBOURS]
    return vote(sims[some], n[some], bad[some] / n[some]) if len(some) else None


def _packed(a: np.ndarray) -> np.ndarray:
    """a in the smallest unsigned type that holds it."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


@dataclass
class Model:
    """Examples as term counts; the lookup and the index are made from them, on each worker anew."""

    keys: np.ndarray
    worth: np.ndarray
    #: The counted terms of example i are places edges[i] to edges[i + 1] of term and times.
    edges: np.ndarray
    term: np.ndarray
    times: np.ndarray
    ids: list
    #: Members of the cell of example i, and the share of them with label 1.
    labels: np.ndarray
    share: np.ndarray
    bare: float = 0.0
    steps: tuple[np.ndarray, np.ndarray] = (np.zeros(0), np.zeros(0))
    lookup: Lookup = field(init=False)
    index: BlockMaxIndex = field(init=False)

    def __post_init__(self):
        self.lookup, self.index = Lookup(self.keys), BlockMaxIndex(self.edges, self.term, self.weights(), len(self.keys))

    def dump(self) -> bytes:
        told = self.keys, self.worth, _packed(self.edges), _packed(self.term), _packed(self.times), self.ids
        return pickle.dumps((zlib.compress(pickle.dumps(told), 1), (self.labels, self.share, self.bare, self.steps)))

    @classmethod
    def load(cls, state: bytes) -> "Model":
        told, rest = pickle.loads(state)
        keys, worth, edges, term, times, ids = pickle.loads(zlib.decompress(told))
        return cls(keys, worth, edges.astype(np.int64), term, times, ids, *rest)

    @staticmethod
    def voting(state: bytes, labels: np.ndarray, share: np.ndarray, bare: float, steps: tuple[np.ndarray, np.ndarray]) -> bytes:
        """A packed model with other votes; its examples stay packed."""
        return pickle.dumps((pickle.loads(state)[0], (labels, share, bare, steps)))

    def weights(self) -> np.ndarray:
        """The unit vectors of all examples, one after the other."""
        w = (1 + np.log(self.times)) * self.worth[self.term]
        norms = np.sqrt(np.add.reduceat(w * w, self.edges[:-1])) if len(w) else np.zeros(0)
        return w / np.repeat(norms, np.diff(self.edges))

    def unit(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and weights of each example."""
        w = self.weights()
        return [(self.term[a:z].astype(np.int64), w[a:z]) for a, z in zip(self.edges[:-1].tolist(), self.edges[1:].tolist(), strict=True)]

    def vote(self, found: np.ndarray, sims: np.ndarray) -> float:
        return vote(sims, self.share[found], self.labels[found])

    def calibrated(self, vote: float) -> float:
        at = int(np.searchsorted(self.steps[0], vote, "right")) - 1
        return float(self.steps[1][max(at, 0)]) if len(self.steps[0]) else self.bare


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def _arrays(batch: pa.RecordBatch):
    for at, end, data, bounds in tn.chunks(batch.column("text"), latin=True):
        yield batch.slice(at, end - at), data, bounds


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> bytes:
    """A model, packed (`Model.load`), from labels (doc_id, label 0 or 1) of docs.

    Null labels and ids, and labels of documents that aren't here, don't count; of
    a document labelled twice the larger label does, of rows that repeat a doc_id
    the least text. All labelled documents count in weights, votes and calibration;
    the examples that they are members of are the first of each label by a hash of
    the id, `positives` and `negatives` of them at most.
    """
    small_batches(docs.sparkSession)
    with tables(docs.sparkSession):
        return _fit(docs.select("doc_id", "text"), labels, positives, negatives)


def _likely(docs: DataFrame, told: DataFrame) -> DataFrame:
    """All rows of docs whose id is one of told, which has ids of docs, and a few others.

    An id sets a bit of a map by its hash, which travels to all tasks; of other rows
    one in 16 or fewer has a bit that is set, more once told has over ID_BITS / 16
    ids. A join by id then moves the texts of these rows, not all texts.
    """
    bits = min(ID_BITS, 1 << max(6, (16 * told.count()).bit_length()))
    at = F.xxhash64("doc_id").bitwiseAND(F.lit(bits - 1))
    word, bit = F.shiftright(at, 6), at.bitwiseAND(F.lit(63)).cast("int")
    marks = told.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("marks"))
    return docs.join(F.broadcast(marks), word == marks["word"]).where(F.getbit("marks", bit) == 1).select(*docs.columns)


def _fit(docs: DataFrame, labels: DataFrame, positives: int, negatives: int) -> bytes:
    # ids as docs has them, so that they have the same hash there
    told = docs.select("doc_id").distinct().join(labels.where("label IS NOT NULL AND doc_id IS NOT NULL"), "doc_id")
    told = cut(told.groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label")), "labelled")
    # bounded, so it may be broadcast
    sample = told.where("label = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives).unionByName(told.where("label = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(negatives))
    examples = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in _arrays(batch):
                h, owner = hashed_words(data, bounds)
                key, which = np.unique(h, return_inverse=True)
                pair, times = np.unique(owner * np.int64(len(key) + 1) + which, return_counts=True)
                edges = np.searchsorted(pair // (len(key) + 1), np.arange(len(bounds)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), tn.list_array(key[pair % (len(key) + 1)].astype(np.int64), edges, pa.int64()), tn.list_array(times.astype(np.int32), edges, pa.int32())], names=["doc_id", "label", "h", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = cut(examples.select("doc_id", "label", "text").mapInArrow(represent, f"doc_id {kind}, label int, h array<bigint>, times array<int>"), "examples")
    # the words of the sample, 8 bytes each
    keys = np.sort(counted.select(F.explode("h").alias("h")).distinct().toArrow().column("h").to_numpy().astype(np.uint64))
    m = len(keys)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(keys)
        for batch in batches:
            for part, data, bounds in _arrays(batch):
                text, term, times = vectors(data, bounds, lookup)
                edges = np.searchsorted(text, np.arange(len(bounds)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), tn.list_array(term.astype(np.int32), edges, pa.int32()), tn.list_array(times.astype(np.int32), edges, pa.int32())], names=["doc_id", "label", "term", "times"])

    every = _likely(docs, told).join(told, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "label", "text")
    every = cut(every.mapInArrow(known, f"doc_id {kind}, label int, term array<int>, times array<int>"), "members")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, df, rows = Lookup(keys), np.zeros(m, np.int64), 0
        for batch in batches:
            for part, data, bounds in _arrays(batch):
                df += np.bincount(vectors(data, bounds, lookup)[1], minlength=m)
                rows += part.num_rows
        yield from _summed(df, rows)

    def by_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rows = np.zeros(m, np.int64), 0
        for batch in batches:
            n += np.bincount(batch.column("term").flatten().to_numpy(), minlength=m)
            rows += int((batch.column("term").value_lengths().to_numpy() > 0).sum())
        yield from _summed(n, rows)

    df, total = _totals(docs.select("text").mapInArrow(frequencies, "t bigint, n bigint"), m)
    p, n1 = _totals(every.where("label = 1").select("term").mapInArrow(by_label, "t bigint, n bigint"), m)
    n, n0 = _totals(every.where("label = 0").select("term").mapInArrow(by_label, "t bigint, n bigint"), m)
    worth = (np.log((1.0 + total) / (1.0 + df)) + 1.0) * relevance(p, n, n1, n0)
    del df, p, n

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _indexed([*batches], keys, worth)
        yield pa.RecordBatch.from_arrays([pa.array([model.dump()], pa.binary()), pa.array([len(model.ids)], pa.int64())], names=["model", "cells"])

    # the examples are bounded, so that one task may hold them; the driver holds the packed model only
    model, cells = counted.repartition(1).mapInArrow(build, "model binary, cells bigint").first()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.load(sent.value)
        centre = {i: k for k, i in enumerate(m.ids)}
        for batch in batches:
            term, times = (batch.column(c).flatten().to_numpy() for c in ("term", "times"))
            edges = np.concatenate([[0], np.cumsum(batch.column("term").value_lengths().to_numpy())]).astype(np.int64)
            texts = [(t := term[a:z].astype(np.int64), weights(t, times[a:z], m.worth)) for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) if z > a]
            near = [*m.index.all_nearest(texts, NEIGHBOURS + 1)]
            full = np.flatnonzero(np.diff(edges))
            ids, bad = batch.column("doc_id").to_pylist(), batch.column("label").to_numpy()[full]
            own = [centre.get(ids[i], int(found[0]) if len(found) else -1) for i, (found, _) in zip(full.tolist(), near, strict=True)]
            ends = np.concatenate([[0], np.cumsum([len(found) for found, _ in near])])
            flat = [np.concatenate([np.zeros(0), *[x[k] for x in near]]) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.int32()), pa.array(own, pa.int32()), tn.list_array(flat[0].astype(np.int32), ends, pa.int32()), tn.list_array(flat[1], ends, pa.float64())], names=["label", "cell", "found", "sims"])

    dealt = cut(every.mapInArrow(deal, "label int, cell int, found array<int>, sims array<double>"), "dealt")
    share, bad = np.zeros(cells), np.zeros(cells)
    for r in dealt.where("cell >= 0").groupBy("cell").agg(F.count("*").alias("n"), F.sum("label").alias("bad")).collect():  # a row a cell
        share[r["cell"]], bad[r["cell"]] = r["n"], r["bad"]
    marks = bad / np.maximum(1, share)
    sizes = {r["label"]: r["count"] for r in every.where(F.size("term") == 0).groupBy("label").count().collect()}
    bare = (sizes.get(1, 0) + 0.1) / (sizes.get(0, 0) + sizes.get(1, 0) + 1.0)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("label", "cell", "found", "sims")), strict=True)
            votes = [(vote_without(np.array(found, np.int64), np.array(sims), cell, label, share, marks), label) for label, cell, found, sims in rows]
            # one that no other shares a word with has a vote of 0
            yield pa.RecordBatch.from_arrays([pa.array([v or 0.0 for v, _ in votes], pa.float64()), pa.array([y for _, y in votes], pa.int32())], names=["vote", "label"])

    votes = cut(dealt.mapInArrow(left_out, "vote double, label int"), "votes")
    grouped = lambda v: votes.groupBy(v.alias("vote")).agg(F.count("*").alias("n"), F.sum("label").alias("bad"))
    found = grouped(F.col("vote"))
    if found.count() > VOTES:
        found = grouped(F.round(F.col("vote") * VOTES) / VOTES)
    found = found.toPandas()  # VOTES + 1 rows at most
    steps = isotonic(found["vote"].to_numpy(), (found["bad"] / found["n"]).to_numpy(float), found["n"].to_numpy(float)) if len(found) else (np.zeros(0), np.zeros(0))
    return Model.voting(model, marks, share, bare, steps)


def _summed(n: np.ndarray, rows: int) -> Iterator[pa.RecordBatch]:
    """Counts of terms, and of rows as those of term -1."""
    hit = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, hit)), pa.array(np.append(rows, n[hit]))], names=["t", "n"])


def _totals(counts: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """The sums of _summed over all tasks."""
    got = counts.groupBy("t").agg(F.sum("n").alias("n")).toArrow()  # terms + 1 rows at most
    t, n = got.column("t").to_numpy(), got.column("n").to_numpy()
    out = np.zeros(terms)
    out[t[t >= 0]] = n[t >= 0]
    return out, int(n[t < 0].sum())


def _indexed(batches: list[pa.RecordBatch], keys: np.ndarray, worth: np.ndarray) -> Model:
    """A model, as yet without members, of counted examples (doc_id, label, h, times), in the order of their ids."""
    batches = [b for b in batches if b.num_rows]
    joined = lambda name, values: np.concatenate([np.zeros(0, np.int64), *[values(b.column(name)) for b in batches]])
    every = [i for b in batches for i in b.column("doc_id").to_pylist()]
    lengths = joined("h", lambda c: c.value_lengths().to_numpy())
    by = np.array(sorted(range(len(every)), key=every.__getitem__), np.int64)
    first = (np.cumsum(lengths) - lengths)[by]
    lengths = lengths[by]
    flat = _ranges(first, lengths) if len(by) else np.zeros(0, np.int64)
    term = np.searchsorted(keys, joined("h", lambda c: c.flatten().to_numpy()).astype(np.uint64)).astype(np.uint32)[flat]
    times = joined("times", lambda c: c.flatten().to_numpy()).astype(np.uint32)[flat]
    some = lengths > 0
    edges = np.concatenate([[0], np.cumsum(lengths[some])]).astype(np.int64)
    ids = [every[i] for i in by[some].tolist()]
    return Model(keys, worth, edges, term, times, ids, np.zeros(len(ids)), np.zeros(len(ids)))


def score(docs: DataFrame, model: bytes, limit: float = LIMIT) -> DataFrame:
    """docs with `score` (0 to 1), `predicted` (1 from the limit on) and `neighbours`, the ids of the examples whose cells voted.

    A text without any word of the examples, as a null or empty one, gets the rate
    of examples without any word. Texts are scored whole, rows as often as they come;
    columns named as the new ones are replaced.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    new = {"score": "double", "predicted": "int", "neighbours": f"array<{kind}>"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"{k} {v}" for k, v in new.items())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.load(sent.value)
        known: dict[bytes, tuple[float, list]] = {}
        for batch in batches:
            for part, data, bounds in _arrays(batch):
                text, term, times = vectors(data, bounds, m.lookup)
                edges = np.searchsorted(text, np.arange(len(bounds)))
                scores, near = [m.bare] * part.num_rows, [[]] * part.num_rows
                keys: dict[int, bytes] = {}
                fresh: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
                if len(known) > 50_000:
                    known.clear()
                for i in np.flatnonzero(np.diff(edges)):
                    t, n = term[edges[i] : edges[i + 1]], times[edges[i] : edges[i + 1]]
                    keys[i] = hashlib.blake2b(t.tobytes() + n.tobytes(), digest_size=16).digest()
                    if keys[i] not in known:
                        fresh.setdefault(keys[i], (t, weights(t, n, m.worth)))
                for key, (found, sims) in zip(fresh, m.index.all_nearest(list(fresh.values()), NEIGHBOURS), strict=True):
                    known[key] = m.calibrated(m.vote(found, sims)) if len(found) else m.bare, [m.ids[i] for i in found.tolist()]
                for i, key in keys.items():
                    scores[i], near[i] = known[key]
                s = np.clip(np.array(scores, np.float64), 0, 1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s), pa.array((s >= limit).astype(np.int32)), pa.array(near, pa.list_(part.column("doc_id").type))], names=[*part.schema.names, *new])

    return docs.mapInArrow(run, schema)
