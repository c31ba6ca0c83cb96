"""Token counts by a whole-token shortcut.

Offline, on the driver and once for a vocabulary, every vocabulary string is merged
on its own; those that come out as one token are proved whole. The proof travels to
the tasks as a bit for each token id. A pre-token that is such a string counts 1
without any merge; only the rest is merged.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from annalist.llm.bpe import Memory, Vocabulary, some_texts, vocabulary
from annalist.llm.common import small_batches

TOKEN_LIMIT = 1024


@lru_cache(2)
def proved_whole(path: str | None = None) -> bytes:
    """A bit for each token id: whether its string encodes alone as that one token, by merging each of them."""
    v = vocabulary(path)
    strings = [*v.strings]
    bits = np.zeros(1 + max(v.strings.values(), default=0), bool)
    for s, ids in zip(strings, v.merge(strings), strict=True):
        bits[v.strings[s]] = len(ids) == 1 and ids[0] == v.strings[s]
    return np.packbits(bits).tobytes()


def whole_strings(v: Vocabulary, proof: bytes) -> frozenset[str]:
    bits = np.unpackbits(np.frombuffer(proof, np.uint8))
    out = set()
    for s, i in v.strings.items():
        if bits[i]:
            try:
                out.add(s.decode())
            except UnicodeDecodeError:  # part of a character; no pre-token is equal to it
                pass
    return frozenset(out)


class Counter:
    """Counts tokens; remembers a bounded number of pre-tokens."""

    def __init__(self, path: str | None = None, proof: bytes | None = None):
        self.v = vocabulary(path)
        self.whole = whole_strings(self.v, proof or proved_whole(path))
        self.memory = Memory(self.count)

    def count(self, tokens: list[str]) -> list[int]:
        """1 for what is proved whole; the rest is merged."""
        rest = [t for t in tokens if t not in self.whole]
        merged = dict(zip(rest, map(len, self.v.merge([t.encode() for t in rest])), strict=True))
        return [merged.get(t, 1) for t in tokens]

    def count_batch(self, texts: list[str]) -> list[int]:
        split = [[*self.v.pieces(t)] for t in texts]
        known = self.memory.learn([p for parts in split for _, p in parts])
        return [sum(1 if i is not None else sum(map(known.__getitem__, p)) for i, p in parts) for parts in split]


@lru_cache(2)
def counter(path: str | None, proof: bytes) -> Counter:
    return Counter(path, proof)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """docs with `n_bytes` (UTF-8), `n_tokens` and `over_limit` (n_tokens > limit), texts counted whole.

    A null text counts as empty: no bytes, no tokens, not over the limit. A
    special token's string in a text is that one token. Repeated rows are counted
    each; other columns are kept, those named as the new ones are replaced.
    """
    small_batches(docs.sparkSession)
    new = {"n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"{k} {v}" for k, v in new.items())])

    proof = proved_whole(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, proof)
        for batch in batches:
            for at, texts in some_texts(batch):
                part = batch.slice(at, len(texts))
                n = pa.array(count.count_batch(texts), pa.int64())
                size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, size, n, pc.greater(n, limit)], names=[*part.schema.names, *new])

    return docs.mapInArrow(run, schema)
