"""Grouping of spelling variants: an even-partition pigeonhole join of all words within one edit.

A word of length l is cut into two even segments, [0, l/2) and [l/2, l). One edit
leaves one segment of the shorter word (of either, if they are equally long) as it
is, so each word is indexed under its two segments, by its length, and probes the
index with four substrings: its segments, for words as long as it is, and those of
a word one shorter, the right one shifted by one place. Words that meet are
verified by their edit distance.

Many words may share a segment. What is left of words that share one differs by one
edit as well, so a key with many words is split by the segments of the rests, and
again, until few share a key. No pairs are made within a large group.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import cut, tables

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_CHARS = 5
LEAST_N = 3
#: A form has so many times the occurrences of its variant at least.
RATIO = 2
#: Indexed words that a key may have before their rests are cut further. Picks a route, not a result.
CROWD = 100
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """(word): each maximal run of letters of the whole texts, A-Z lower-cased, once per occurrence; a null text has none.

    With damage, a run loses a code point where the checksum of its document and
    itself is a multiple of that number (planted errors). A null doc_id is empty.
    """
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("_run"))
    found = found.select("_id", F.translate("_run", _UPPER, _LOWER).alias("word"))
    if damage is None:
        return found.select("word")
    found = found.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "word")))
    at = (F.col("_h") % F.char_length("word")).cast("int")
    return found.select(F.when(F.col("_h") % damage == 0, F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, least_chars: int = LEAST_CHARS, least_n: int = LEAST_N) -> DataFrame:
    """(word, n) of words long and frequent enough; counts are made before rows are dealt."""
    return words.where(F.char_length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def _key(length: Column, side: int, segment: Column) -> Column:
    """Under the key so far, which has no other letters than the segments."""
    return F.concat_ws("|", "key", length.cast("string"), F.lit(str(side)), segment)


def _parts(rows: DataFrame, parts: list[tuple[Column, Column]]) -> DataFrame:
    """word, n and, for each part, its key and what is left of the word."""
    return rows.select("word", "n", F.explode(F.array(*[F.struct(k.alias("key"), r.alias("rest")) for k, r in parts])).alias("x")).select("word", "n", "x.key", "x.rest")


def _indexed(rows: DataFrame) -> DataFrame:
    size = F.char_length("rest")
    half = (size / 2).cast("int")
    left, right = F.substr("rest", F.lit(1), half), F.substr("rest", half + 1)
    return _parts(rows, [(_key(size, 1, left), right), (_key(size, 2, right), left)])


def _probing(rows: DataFrame) -> DataFrame:
    """The keys of words as long, then of words one shorter, where the right segment starts one place later."""
    parts = []
    for less in (0, 1):
        size = F.char_length("rest") - less
        half = (size / 2).cast("int")
        parts.append((_key(size, 1, F.substr("rest", F.lit(1), half)), F.substr("rest", half + 1)))
        parts.append((_key(size, 2, F.substr("rest", half + 1 + less)), F.substr("rest", F.lit(1), half + less)))
    return _parts(rows, parts)


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, n, near, near_n), both ways: all pairs of the distinct words that one inserted, deleted or replaced code point makes equal."""
    start = words.select("word", "n", F.lit("").alias("key"), F.col("word").alias("rest"))
    index, probes, found = _indexed(start), _probing(start), None
    while True:
        index, probes = cut(index, "spelling-index"), cut(probes, "spelling-probes")
        # a rest of one letter or none leaves only words that are near
        crowded = cut(index.groupBy("key").agg(F.count("*").alias("size"), F.max(F.char_length("rest")).alias("left")).where((F.col("size") > crowd) & (F.col("left") > 1)).select("key"), "spelling-crowded")
        a, b = index.join(crowded, "key", "left_anti").alias("a"), probes.alias("b")
        longer = F.char_length("b.word") > F.char_length("a.word")
        pairs = a.join(b, F.col("a.key") == F.col("b.key")).where((longer | (F.col("a.word") < F.col("b.word"))) & (F.levenshtein("a.word", "b.word", 1) == 1))
        pairs = pairs.select(F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))
        found = pairs if found is None else found.unionByName(pairs)
        if crowded.isEmpty():
            break
        index, probes = _indexed(index.join(crowded, "key", "left_semi")), _probing(probes.join(crowded, "key", "left_semi"))
    found = found.distinct()
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) without circles: each step doubles how far a word has followed its forms."""
    at = cut(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("_over"), F.col("root").alias("_further"))
        step = cut(at.join(on, at["root"] == on["_over"], "left").select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved")), "spelling-roots")
        at = step.drop("_moved")
        if step.where("_moved").isEmpty():
            return at


def variants(words: DataFrame, ratio: int = RATIO, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct (word, n).

    A word's form is the near word of most occurrences (on ties the smallest by code
    points) if it has ratio times the word's at least; its root is the last of its
    forms, or the word. Words without near words have n_near 0 and no form. A
    ratio of 1 or less could make circles and is an error.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1")
    with tables(words.sparkSession):
        words = cut(words.select("word", "n"), "spelling-words")
        best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
        near = near_words(words, crowd).groupBy("word").agg(F.count("*").alias("n_near"), best)
        near = near.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
        told = words.join(near, "word", "left")
        fits = F.col("form_n") >= ratio * F.col("n")
        told = cut(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n")), "spelling-forms", keep=True)
        root = cut(roots(told.where("form IS NOT NULL").select("word", "form")), "spelling-root", keep=True)
    return told.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, damage: int | None = None, least_chars: int = LEAST_CHARS, least_n: int = LEAST_N, ratio: int = RATIO) -> DataFrame:
    """variants() of all words of whole texts. Null and empty texts have no words; repeated rows and ids count as often as they come; other columns play no part; without words the result is empty."""
    return variants(vocabulary(runs(docs.select("doc_id", "text"), damage), least_chars, least_n), ratio)
