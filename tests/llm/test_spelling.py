"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from annalist.llm import spelling

SCHEMA = "doc_id long, text string"


def counted(rows, damage=None):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if damage and h % damage == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            found[w] += 1
    return found


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(words, ratio=2):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        top = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def some_words(seed, n=150):
    r = random.Random(seed)
    letters = "abcéÿ" if seed % 2 else "ab"
    base = ["".join(r.choices(letters, k=r.randint(1, 9))) for _ in range(n)]
    return base + [w[:k] + r.choice(["", *letters]) + w[k + r.randint(0, 1) :] for w in base for k in [r.randrange(len(w))]]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("crowd", [1, 100])
def test_all_pairs(spark, seed, crowd):
    r = random.Random(seed)
    words = {w: r.choice([1, 1, 2, 3, 3, 6, 12, 30]) for w in some_words(seed) if w}
    found = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"), crowd=crowd)
    rows = found.collect()
    assert len(rows) == len(words) and {tuple(x) for x in rows} == brute(words)


def test_texts(spark):
    r = random.Random(7)
    pool = some_words(1) + ["Straße", "STRASSE", "colour", "color", "colours", "Étude", "étude"]
    rows = [(k, " ".join(r.choices(pool, k=200)) + "_x9colour-colour") for k in range(40)] + [(None, "colour Colour COLOUR"), (1, None), (2, ""), (3, "12 34")]
    rows += rows[:3]
    docs = spark.createDataFrame([(*x, "w", 1) for x in rows], "doc_id long, text string, word string, n int")
    words = {w: n for w, n in counted(rows, 97).items() if len(w) >= 5 and n >= 3}
    assert {tuple(x) for x in spelling.spelling_variants(docs, 97).collect()} == brute(words)
    words = {w: n for w, n in counted(rows).items() if len(w) >= 6 and n >= 2}
    assert {tuple(x) for x in spelling.spelling_variants(docs, None, 6, 2).collect()} == brute(words)


def test_edges(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    long = "ab" * 30_000
    rows = [(1, f"{long} {long} {long} {long}c {long}c {long}c")]
    found = {len(x["word"]): x for x in spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[60_000]["n_near"] == found[60_001]["n_near"] == 1 and found[60_000]["form"] is None
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_long_chains_have_one_root(spark):
    words = {"a" * (5 + k): 2 ** (20 - k) for k in range(20)}
    found = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert {x["root"] for x in found} == {"aaaaa"} and {tuple(x) for x in found} == brute(words)


def test_a_crowded_segment_makes_no_pairs_of_all(spark):
    words = [(f"commonprefix{a}{b}{c}", 3) for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"]
    index, seen = spark.createDataFrame(words, "word string, n long"), []
    original = spelling.cut
    spelling.cut = lambda df, name, keep=False: seen.append(name) or original(df, name, keep)
    try:
        found = spelling.near_words(index, crowd=50).count()
    finally:
        spelling.cut = original
    assert found == 600 * (9 + 9 + 5) and seen.count("spelling-index") > 1
