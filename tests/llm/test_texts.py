"""Tokens, fingerprints, lines and toxicity on small fixtures, against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from annalist.llm import bpe, fingerprints, lines, token_counts, toxicity
from annalist.llm import textnum as tn

SPACE = " \t\n\x0b\f\r"
ODD = [None, "", " ", "\n\n", "one", "Two words", "<|endoftext|> x<|endoftext|>", "naïve ÉÀ ß", "日本語テキスト 12345", "a" * 3000, "word " * 4000, "tab\tsep\x0bv\x1cfs ls", "it's we'll  I'd   ", "é​😀"]


def docs_of(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "x") for i, t in zip(ids or range(len(texts)), texts, strict=True)], "doc_id bigint, text string, N_TOKENS string")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def fuzz(n, seed):
    rng = random.Random(seed)
    pool = [chr(c) for c in [*range(0x250), 0x2028, 0x200B, 0x3000, 0x4E2D, 0x1F600, 0x663, 0xBD, 0x301]] + ["'s", "'ll", " ", "  ", "\n", "<|endoftext|>", "a"] * 8
    return ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(n)]


def test_bpe_is_the_librarys(library):
    texts = [t or "" for t in ODD] + fuzz(3000, 1)
    coder = bpe.Encoder()
    for t, ids, want in zip(texts, coder.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, t[:50]
        assert coder.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_merges_are_leftmost_lowest_rank():
    v = bpe.vocabulary()
    rng = random.Random(3)
    words = ["".join(rng.choices("aehinrst ", k=rng.randint(1, 40))).encode() for _ in range(300)]
    ranks = dict(zip(v.keys.tolist(), v.ranks.tolist(), strict=True))
    for word, got in zip(words, v.merge(words), strict=True):
        ids = [int(v.first[b]) for b in word]
        while True:
            found = [(ranks[a << 32 | b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 32 | b in ranks]
            if not found:
                break
            rank, i = min(found)
            ids[i : i + 2] = [int(v.made[rank])]
        assert got.tolist() == ids


def test_encoding_and_counts_of_a_table(spark, library):
    docs = docs_of(spark, [*ODD, "one", "one"])
    coded = bpe.encode(docs).orderBy("doc_id").collect()
    counted = token_counts.count_tokens(docs).orderBy("doc_id").collect()
    assert bpe.encode(docs).columns == ["doc_id", "text", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r, c in zip(coded, counted, strict=True):
        text = r["text"] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == c["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert c["n_bytes"] == len(text.encode()) and c["over_limit"] == (len(ids) > 1024)
    assert [r["decoded"] for r in bpe.decode(bpe.encode(docs)).orderBy("doc_id").collect()] == [r["text"] or "" for r in coded]
    assert bpe.encode(docs.limit(0)).count() == token_counts.count_tokens(docs.limit(0)).count() == 0


def test_proof_of_whole_tokens(library):
    v = bpe.vocabulary()
    whole = token_counts.whole_strings(v, token_counts.proved_whole())
    assert len(whole) > 40_000
    for s in random.Random(5).sample(sorted(whole), 500):
        assert len(library.encode(s, add_special_tokens=False).ids) >= 1
    assert all(len(v.merge([s.encode()])[0]) == 1 for s in random.Random(6).sample(sorted(whole), 200))
    assert len(token_counts.proved_whole()) == -(-(1 + max(v.strings.values())) // 8)


def test_memory_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 1000)
    made = []
    memory = bpe.Memory(lambda new: (made.append(len(new)), [len(t) for t in new])[1])
    for k in range(50):
        pieces = [f"{k}" * 60, "again", "x" * k]
        known = memory.learn([pieces])
        assert all(known[p] == len(p) for p in pieces)
        assert sum(map(len, [*memory.known, *memory.old])) < 1500


def test_words_and_shingles():
    texts = ["A b  c\td", "", None, "É é", "x", " lead trail ", "a b c a b c"]
    data, bounds = tn.buffers(pa.array(texts))
    starts, ends, edges = tn.words(data, bounds)
    tr = {i: i + 32 for i in range(65, 91)}
    want = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(tr)) for t in texts]
    got = [[bytes(data[a:z]).decode() for a, z in zip(starts[edges[i] : edges[i + 1]], ends[edges[i] : edges[i + 1]], strict=True)] for i in range(len(texts))]
    assert got == want
    values, b = tn.distinct(*tn.shingles(tn.hashes(data, starts, ends), edges, 3))
    sets = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set() for w in want]
    assert np.diff(b).tolist() == [*map(len, sets)]


def sketch_of(text, k, spark):
    return spark.range(1).select(fingerprints.sketch(F.lit(text), k).alias("s")).first()["s"]


def test_fingerprints(spark):
    rng = random.Random(2)
    texts = [*ODD, *(" ".join(rng.choices("abcdefgh", k=rng.randint(3, 900))) for _ in range(30))]
    ids = [*range(len(texts) - 2), 7, None]
    docs = docs_of(spark, texts, ids)
    order = sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is None, -(x[0] or 0), x[1] is not None and x[1] or ""))
    for pieces in (1, 5, 40):
        got = fingerprints.fingerprint_edits(docs, pieces).collect()
        assert len(got) == len(texts)
        want = []
        for (i, t), (_, n) in zip(order, [*order[1:], order[0]], strict=True):
            t, n = t or "", n or ""
            cut = len(t) // 3
            want.append((i, len(t), hashlib.sha256((t[: len(t) - cut] + n[:cut]).encode()).hexdigest()))
        assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_chars"], r["edited_sha256"])) for r in got)
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprints.fingerprint_edits(docs.limit(0), 5).count() == 0


def plain_sketch(text, k, width):
    """The k smallest of the distinct 64-bit hashes of word runs, as Spark hashes arrays of strings."""
    words = [w for w in re.split("[ \t-\r]+", (text or "").lower()) if w]
    out = set()
    for i in range(max(1, len(words) - width + 1) if words else 0):
        h = 42
        for w in words[i : i + width]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        out.add(h - 2**64 if h >= 2**63 else h)
    return sorted(out)[:k]


def plain_likeness(a, b, k):
    if not a and not b:
        return 1.0
    union = sorted({*a, *b})[:k]
    return len({*union} & {*a} & {*b}) / len(union)


def test_fingerprints_by_brute_force(spark):
    rng = random.Random(12)
    base = rng.choices("abcdefghé", k=700)
    texts = ["", None, "  \n", "One", "one TWO", *(" ".join(base[: rng.randint(1, 700)] + rng.choices("xyz", k=rng.randint(0, 40))) for _ in range(40))]
    frame = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")
    for k in (128, 8):
        got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(frame, k=k).collect()}
        for i, t in enumerate(texts):
            following = texts[i - 1] or ""
            t = t or ""
            cut = len(t) // 3
            own, edited, after = (plain_sketch(x, k, 5) for x in (t, t[: len(t) - cut] + following[:cut], following))
            hexed = lambda hs: "".join(f"{h & (2**64 - 1):016x}" for h in hs)
            assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (hexed(own), hexed(edited))
            assert abs(got[i]["near_edited"] - plain_likeness(own, edited, k)) < 1e-12 and abs(got[i]["near_next"] - plain_likeness(own, after, k)) < 1e-12


def test_ranges_of_ids(spark):
    for cuts in ([], [5], [*range(0, 1000, 7)], [-(2**63), 3, 2**62]):
        got = spark.range(-20, 1020).select("id", fingerprints._range_of(F.col("id"), cuts).alias("r")).collect()
        assert all(r["r"] == sum(c < r["id"] for c in cuts) for r in got)


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(4)
    a, b = [[str(rng.random()) for _ in range(n)] for n in (3000, 1500)]
    x, y = " ".join(a), " ".join(a[:2000] + b)
    k = 512
    row = spark.createDataFrame([(x, y)], "x string, y string").select(fingerprints.sketch(F.col("x"), k).alias("x"), fingerprints.sketch(F.col("y"), k).alias("y"))
    row = row.select(fingerprints.resemblance(F.col("x"), F.col("y"), k).alias("j"), fingerprints.containment(F.col("x"), F.col("y"), k).alias("c"), fingerprints.distinct_count(F.col("x"), k).alias("n"), "x", "y").first()
    assert abs(row["j"] - 1996 / (2996 + 3496 - 1996)) < 0.1 and abs(row["c"] - 1996 / 2996) < 0.15 and abs(row["n"] / 2996 - 1) < 0.15
    parts = spark.createDataFrame([("g", sketch_of(x, k, spark)), ("g", sketch_of(y, k, spark)), ("h", [])], "g string, s array<bigint>")
    merged = {r["g"]: r["s"] for r in fingerprints.merge_groups(parts, ["g"], "s", k).collect()}
    assert merged["g"] == sorted({*row["x"], *row["y"]})[:k] and merged["h"] == []


def plain_dedup(rows, docs=3, chars=20):
    tr = {i: i + 32 for i in range(65, 91)}
    key = lambda x: x.strip(SPACE).translate(tr)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    held = {}
    for i, ls in split:
        for x in ls:
            if i is not None and len(key(x)) >= chars:
                held.setdefault(key(x), set()).add(i)
    gone = {k: max(v) for k, v in held.items() if len(v) >= docs}
    kept = [(i, len(ls), [x for x in ls if i is None or gone.get(key(x), i) == i]) for i, ls in split]
    return sorted(str((i, n, n - len(ls), "\n".join(ls))) for i, n, ls in kept)


LINES = ["this line is long enough to go", "  THIS line is long enough to go\t", "short", "", "another line that is found often", "é" * 20, "é" * 19, "x" * 5000]


def line_rows(n, seed, first=0):
    rng = random.Random(seed)
    return [(first + i, "\n".join(rng.choices(LINES + [f"own line number {i} of this text {k}" for k in range(5)], k=rng.randint(0, 12)))) for i in range(n)]


def line_result(df):
    return sorted(str((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"])) for r in df.collect())


def test_line_dedup(spark):
    rows = [*line_rows(60, 1), (3, LINES[0]), (3, LINES[0]), (None, "\n".join(LINES)), (99, None), (98, "")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, n_lines int")
    assert line_result(lines.dedup(docs)) == plain_dedup(rows)
    assert lines.dedup(docs.limit(0)).count() == 0


def test_line_index_is_reversible(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    a, b = line_rows(40, 2), line_rows(30, 3, first=100)
    base = lines.LineIndex.build(frame(a))
    grown = base.insert(frame(b))
    assert line_result(lines.dedup(frame(a + b), grown)) == plain_dedup(a + b)
    back = grown.delete(frame(b))
    assert line_result(lines.dedup(frame(a), back)) == plain_dedup(a)
    state = lambda x: sorted(map(tuple, x.counts.collect()))
    assert state(back) == state(base)


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    k1, k2 = rng.integers(-(2**62), 2**62, (2, 5000))
    c = lines.Cuckoo.of_size(2000)  # too small on purpose: the stash takes the rest
    c.insert(k1, k2)
    assert c.may_hold(k1, k2).all()
    c.delete(k1[:2500], k2[:2500])
    assert c.may_hold(k1[2500:], k2[2500:]).all()
    assert lines.Cuckoo.load(*c.dump()).may_hold(k1[2500:], k2[2500:]).all()
    c.delete(k1[2500:], k2[2500:])
    assert not c.table.any() and not c.stash


def test_line_index_grows(spark, monkeypatch):
    """Filters are dealt to more shards, and built anew when their stash is full; shards of many rows are probed in parts."""
    monkeypatch.setattr(lines, "SHARD_KEYS", 20)
    monkeypatch.setattr(lines, "STASHED", 0)
    monkeypatch.setattr(lines, "PROBES", 15)
    rng = random.Random(8)
    pool = [f"a line of some length {k:04d}" for k in range(200)]
    text = lambda some: "\n".join(["this line is in every document of all"] + rng.choices(some, k=rng.randint(1, 12)))
    frame = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    a, b = [(i, text(pool[:20])) for i in range(40)], [(100 + i, text(pool)) for i in range(150)]
    base = lines.LineIndex.build(frame(a))
    more = base.insert(frame(b))
    assert base.shards < more.shards and more._parts(more.refs).count() > 0
    got = sorted(str((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"])) for r in lines.dedup(frame(a + b), more).collect())
    assert got == plain_dedup(a + b)
    back = more.delete(frame(b).select("doc_id"))
    assert sorted(str((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"])) for r in lines.dedup(frame(a), back).collect()) == plain_dedup(a)


def test_line_dedup_keeps_names(spark):
    line = "the same line in three documents"
    docs = spark.createDataFrame([(i, line, 7, "d", [1]) for i in range(3)], "doc_id bigint, text string, _row int, _drops string, _LINES array<int>")
    got = sorted(lines.dedup(docs).collect(), key=lambda r: r["doc_id"])
    assert [tuple(r)[:5] for r in got] == [(0, "", 7, "d", [1]), (1, "", 7, "d", [1]), (2, line, 7, "d", [1])]


def indexed(rows, terms):
    edges = np.cumsum([0, *(len(t) for t, _ in rows)])
    return toxicity.BlockMaxIndex(edges, np.concatenate([t for t, _ in rows]), np.concatenate([w for _, w in rows]), terms)


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(3)
    terms = 60
    rows = []
    for _ in range(500):
        t = np.sort(rng.choice(terms, rng.integers(1, 9), replace=False))
        rows.append((t, toxicity.weights(t, rng.integers(1, 4, len(t)), np.linspace(1, 5, terms))))
    dense = np.zeros((500, terms))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    index = indexed(rows, terms)
    for i in range(0, 500, 7):
        found, sims = index.nearest(*rows[i], 15, without=i)
        want = dense @ dense[i]
        want[i] = 0
        best = np.sort(want[want > 0])[::-1][:15]
        assert np.allclose(sims, best) and np.allclose(want[found], sims)


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        bad = rng.random() < 0.3
        text = rng.choices(words, k=60) + (rng.choices(["vile", "nasties", "FOUL"], k=2) if bad else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (5, rows[5][1])], "doc_id bigint, text string").withColumn("score", F.lit("old"))
    marks = spark.createDataFrame([*labels, (7, None), (None, 1), (5000, 1)], "doc_id bigint, label int")
    packed = toxicity.fit(docs, marks.where(~toxicity.held_out()))
    model = toxicity.Model.load(packed)
    got = {r["doc_id"]: r for r in toxicity.score(docs, packed).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum(got[i]["predicted"] == labels[i][1] for i in held)
    assert right / len(held) > 0.95
    assert got[1000]["score"] == got[1001]["score"] == model.bare and all(0 <= r["score"] <= 1 for r in got.values())
    assert toxicity.score(docs, packed).count() == 903
    empty = toxicity.fit(docs.limit(0), marks)
    assert {r["score"] for r in toxicity.score(docs, empty).collect()} == {toxicity.Model.load(empty).bare}


def plain_toxicity(rows, labels, k=15):
    """Similarities to all examples and votes, by dictionaries over all words."""
    texts = {i: re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for i, t in rows}
    examples = [i for i in sorted(labels) if texts[i]]
    df = {}
    for w in texts.values():
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    n1 = sum(labels[i] for i in examples)
    scale = n1 / (len(examples) - n1)
    held = {x for i in examples for x in texts[i]}
    p, q = ({x: sum(x in texts[i] for i in examples if labels[i] == y) for x in held} for y in (1, 0))
    worth = {x: (np.log((1 + len(rows)) / (1 + df[x])) + 1) * np.log2(1 + max(1, p[x] / max(1, q[x] * scale))) ** 2 for x in held}

    def vector(words):
        v = {x: (1 + np.log(words.count(x))) * worth[x] for x in set(words) if x in held}
        norm = sum(a * a for a in v.values()) ** 0.5
        return {x: a / norm for x, a in v.items()}

    unit = {i: vector(w) for i, w in texts.items()}
    sims = {i: {e: sum(a * unit[e].get(x, 0.0) for x, a in v.items()) for e in examples} for i, v in unit.items()}

    def vote(i, without=None):
        near = sorted(((s, e) for e, s in sims[i].items() if s > 1e-12 and e != without), key=lambda x: (-round(x[0], 12), x[1]))[:k]
        total = sum(s * s for s, _ in near)
        return (sum(s * s * labels[e] for s, e in near) / total if total else 0.0), near

    return sims, vote, examples


def test_toxicity_by_brute_force(spark):
    """The whole query: weights over all words, exact neighbours, leave-one-out votes, their isotonic fit, scores."""
    rng = random.Random(10)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)) + ["vile", "été"] * (i % 4 == 0))) for i in range(260)] + [(300, ""), (301, None), (302, "unheard")]
    labels = {i: int(i % 4 == 0) for i in range(150)} | {300: 0}
    docs = spark.createDataFrame([(str(i), t) for i, t in rows], "doc_id string, text string")
    packed = toxicity.fit(docs, spark.createDataFrame([(str(i), y) for i, y in [*labels.items(), (9000, 1)]], "doc_id string, label int"))
    model = toxicity.Model.load(packed)
    got = {int(r["doc_id"]): r for r in toxicity.score(docs, packed).collect()}
    sims, vote, examples = plain_toxicity(rows, labels)
    assert len(model.keys) == len({w for i in examples for w in dict(rows)[i].split()})
    steps = toxicity.isotonic(np.array([vote(i, i)[0] for i in examples]), np.array([labels[i] for i in examples], float), np.ones(len(examples)))
    assert np.allclose(steps[0], model.steps[0]) and np.allclose(steps[1], model.steps[1])
    for i, t in rows:
        value, near = vote(i)
        found = [int(x) for x in got[i]["neighbours"]]
        assert np.allclose(sorted(sims[i][e] for e in found), sorted(s for s, _ in near))
        want = steps[1][max(0, int(np.searchsorted(steps[0], value + 1e-12, "right")) - 1)] if near else model.bare
        assert abs(got[i]["score"] - want) < 1e-9 and got[i]["predicted"] == (want >= toxicity.LIMIT)
    assert got[302]["neighbours"] == [] and got[301]["score"] == got[300]["score"] == model.bare


def test_leave_one_out_is_exact():
    rng = np.random.default_rng(5)
    for _ in range(60):
        rows = []
        for _ in range(150):
            t = np.sort(rng.choice(25, rng.integers(1, 6), replace=False))
            rows.append((t, toxicity.weights(t, np.ones(len(t)), np.linspace(1, 3, 25))))
        dense = np.zeros((150, 25))
        for i, (t, w) in enumerate(rows):
            dense[i, t] = w
        for i, (found, sims) in enumerate(indexed(rows, 25).all_nearest(rows, 15, apart=True)):
            want = dense @ dense[i]
            want[i] = 0
            assert i not in found and np.allclose(sims, np.sort(want[want > 1e-9])[::-1][:15])


def test_repeated_ids_and_labels_of_others(spark):
    docs = spark.createDataFrame([(1, "b vile"), (1, "a calm"), (2, "vile b"), (3, "calm a")], "doc_id bigint, text string")
    marks = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (2, 0), (8, 1), (9, 1)], "doc_id bigint, label int")
    packed = toxicity.fit(docs, marks)
    model = toxicity.Model.load(packed)
    assert model.ids == [1, 2, 3] and model.labels.tolist() == [0, 1, 0] and model.share.tolist() == [1, 1, 1]
    assert toxicity.score(docs, packed).count() == 4


def test_all_labelled_documents_count(spark):
    """More labelled documents than examples: weights, votes, bare texts and calibration are of all of them."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=30) + ["vile"] * (i % 3 == 0))) for i in range(200)] + [(900 + i, "") for i in range(7)]
    labels = {i: int(i % 3 == 0) for i in range(150)} | {900 + i: int(i < 2) for i in range(7)}
    docs, marks = (spark.createDataFrame(x, y) for x, y in ((rows, "doc_id bigint, text string"), ([*labels.items()], "doc_id bigint, label int")))
    model = toxicity.Model.load(toxicity.fit(docs, marks, 12, 18))
    assert len(model.ids) <= 30 and model.share.sum() == 150 and round((model.share * model.labels).sum()) == 50
    assert model.bare == (2 + 0.1) / (7 + 1.0)
    # by hand: each document belongs to its nearest example, and an example to itself
    plain, (lookup, at) = dict(rows), (model.lookup, {i: k for k, i in enumerate(model.ids)})
    data, bounds = toxicity.tn.buffers(pa.array([plain[i] for i in range(150)]), latin=True)
    text, term, times = toxicity.vectors(data, bounds, lookup)
    units = [(term[text == i], toxicity.weights(term[text == i], times[text == i], model.worth)) for i in range(150)]
    near = [model.index.nearest(*u, 16) for u in units]
    cells = [at.get(i, int(near[i][0][0])) for i in range(150)]
    assert np.bincount(cells, minlength=len(model.ids)).tolist() == model.share.tolist()
    df, p, n = (np.array([sum(k in set(term[text == i].tolist()) for i in range(150) if want(i)) for k in range(len(model.keys))]) for want in (lambda i: True, lambda i: labels[i], lambda i: not labels[i]))
    assert (df == p + n).all()
    over = model.worth / toxicity.relevance(p, n, 50, 100)
    everywhere = np.array([sum(w in t.split() for _, t in rows) for w in ["vile"]])[0]
    vile = lookup.find(toxicity.hashed_words(*toxicity.tn.buffers(pa.array(["vile"])))[0])[1][0]
    assert abs(over[vile] - (np.log((1 + len(rows)) / (1 + everywhere)) + 1)) < 1e-9
    votes = np.array([toxicity.vote_without(*near[i], cells[i], labels[i], model.share, model.labels) for i in range(150)])
    steps = toxicity.isotonic(votes, np.array([labels[i] for i in range(150)], float), np.ones(150))
    assert np.allclose(steps[0], model.steps[0]) and np.allclose(steps[1], model.steps[1])


def test_texts_without_labels_are_not_moved(spark):
    """The fit deals labelled texts by id, not all texts; ids of another type, repeated ones and labels of others change nothing of that."""
    rng = random.Random(13)
    text = lambda: "shared " + " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=12)) for _ in range(400))
    rows = [(str(i), text()) for i in range(600)] + [("3", text()), (None, text())]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    marks = spark.createDataFrame([*((i, int(i % 3 == 0)) for i in range(0, 30)), (3, 0), (7, None), (None, 1), (5000, 1)], "doc_id bigint, label int")

    def moved():
        gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}

    before, told = moved(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = toxicity.Model.load(toxicity.fit(docs, marks, 5, 10))
        ids = docs.select("doc_id").where("doc_id < 30").distinct()
        likely = [r["doc_id"] for r in toxicity._likely(docs, ids).collect()]
        none = toxicity._likely(docs, ids.limit(0)).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", told)
    assert model.share.sum() == 30 and round((model.share * model.labels).sum()) == 10
    assert {str(i) for i in range(30)} <= set(likely) and likely.count("3") == 2 and len(likely) < 120 and none == 0
    assert sum(n for k, n in moved().items() if k not in before) < 0.5 * sum(len(t) for _, t in rows)


def test_a_full_map_of_ids_loses_none(spark, monkeypatch):
    """With more ids than bits all rows are likely, and the fit is the same."""
    docs = spark.createDataFrame([(i, f"w{i % 7} v{i % 5}" + " vile" * (i % 4 == 0)) for i in range(-150, 150)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(-150, 150, 2)], "doc_id bigint, label int")
    assert {r["doc_id"] for r in toxicity._likely(docs, marks).collect()} >= set(range(-150, 150, 2))
    whole = toxicity.Model.load(toxicity.fit(docs, marks))
    monkeypatch.setattr(toxicity, "ID_BITS", 64)
    tight = toxicity.Model.load(toxicity.fit(docs, marks))
    assert toxicity._likely(docs, marks).count() > 250 and whole.share.sum() == tight.share.sum() == 150
    assert (whole.worth == tight.worth).all() and whole.ids == tight.ids and (whole.steps[1] == tight.steps[1]).all()


def test_a_member_does_not_vote_on_itself():
    found, sims = np.arange(3), np.array([0.9, 0.5, 0.5])
    share, labels = np.array([4.0, 1.0, 1.0]), np.array([0.5, 1.0, 0.0])
    assert toxicity.vote_without(found, sims, 0, 1, share, labels) == pytest.approx((0.81 * 1 + 0.25) / (0.81 * 3 + 0.5))
    assert toxicity.vote_without(found, sims, 1, 1, share, labels) == pytest.approx((0.81 * 2) / (0.81 * 4 + 0.25))
    assert toxicity.vote_without(found[1:2], sims[1:2], 1, 1, share, labels) is None


def test_toxicity_of_the_table(spark):
    """Held-out accuracy on the rows that the query leaves out of the fit."""
    from annalist.llm import queries
    from annalist.llm.common import read

    d = "/root/testdata/sf0.1"
    got = queries.op4_toxicity(spark, d).where("held_out").join(read(spark, d, "labels"), "doc_id").select("toxic", "predicted", "score").collect()
    bad, good = [r for r in got if r["toxic"]], [r for r in got if not r["toxic"]]
    assert sum(r["predicted"] for r in bad) >= 0.92 * len(bad) and sum(r["predicted"] for r in good) <= 0.01 * len(good)
    assert sum(g["score"] < b["score"] for g in good for b in bad) >= 0.95 * len(good) * len(bad)
