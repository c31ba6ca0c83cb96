"""Document fingerprints: bottom-k sketches of word-shingle hashes, with built-in functions only.

A sketch is the sorted array of the k smallest distinct 64-bit shingle hashes. A
sketch of fewer than k hashes holds the whole set, so that estimates from it are
exact. Sketches of parts merge into the sketch of the whole.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from annalist.llm.common import partitions

K = 128
WIDTH = 5
#: Bytes of text in a range of ids, about.
RANGE_BYTES = 64 << 20
_SPACE = " \t\n\x0b\f\r"
_SPAN = 2.0**64


def let(value: Column, f) -> Column:
    """f(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _bottom(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The sketch of a text's runs of `width` words (case folded; a shorter text is one run). Null, empty and blank texts have an empty sketch."""
    trimmed = F.btrim(F.lower(text), F.lit(_SPACE))
    words = F.split(trimmed, "[ \\t-\\r]+")
    runs = let(words, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, width))))
    return F.when(F.length(trimmed) > 0, _bottom(runs, k)).otherwise(F.array().cast("array<bigint>"))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sets."""
    return _bottom(F.concat(a, b), k)


def merge_groups(df: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """One sketch for each group, the merged sketches of its parts; hashes are cut to k per group by rank, so no group is gathered whole.

    An empty sketch adds nothing; a group with no hash has an empty sketch.
    """
    empty = F.array().cast("array<bigint>")
    hashes = df.select(*keys, F.explode_outer(column).alias("h")).groupBy(*keys, "h").agg(F.lit(1).alias("one"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("h").asc_nulls_last()))
    kept = hashes.withColumn("r", rank).where(F.col("r") <= k)
    return kept.groupBy(*keys).agg(F.coalesce(F.sort_array(F.collect_list("h")), empty).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two sets, 0 to 1; 1 for two empty sets."""
    both = let(_bottom(F.concat(a, b), k), lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both.cast("double"))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact under k. The k-th smallest of n uniform hashes lies near k / n of the span."""
    share = (F.element_at(a, -1).cast("double") + F.lit(_SPAN / 2)) / F.lit(_SPAN)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of set a that is in set b, 0 to 1; 1 for an empty a."""
    union = distinct_count(merge(a, b, k), k)
    found = resemblance(a, b, k) * union / distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), found)))


def as_string(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def pieces_of(docs: DataFrame, least: int, text_col: str = "text") -> int:
    """So many ranges that each has about RANGE_BYTES of text, and `least` at least."""
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("bytes")).first()["bytes"] or 0
    return max(least, -(-size // RANGE_BYTES))


def _range_of(at: Column, cuts: list[int]) -> Column:
    """How many of the rising cuts are under at: first among every so many of them, then among those between."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    literal = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")  # noqa: E731  one constant, not one for each cut
    row = F.size(F.filter(literal(cuts[::step]), lambda b: b < at)) - 1
    return F.when(row < 0, 0).otherwise(row * step + F.size(F.filter(F.slice(literal(cuts), row * step + 1, step), lambda b: b < at)))


def with_next(docs: DataFrame, columns: list[str], pieces: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with `next_<c>` for each column: its value in the next row by descending id (after the last: in the first).

    Ids are cut into `pieces` ranges at quantiles; a range also gets the first id
    of the range after it, so each looks ahead on its own and no task sees all
    rows. Rows with one id follow each other by their text, a null id comes last.
    """
    lowest = -(2**63)
    docs = docs.withColumn("_at", F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)))
    cuts = docs.select(F.percentile_approx("_at", [(i + 1) / pieces for i in range(pieces - 1)], 100_000)).first()[0] if pieces > 1 else []
    cuts = sorted({*(cuts or [])})
    docs = docs.withColumn("_range", _range_of(F.col("_at"), cuts))
    # the first id (the largest) of each range, one row for each of at most `pieces` ranges
    firsts = {r["_range"]: r["top"] for r in docs.groupBy("_range").agg(F.max("_at").alias("top")).collect()}
    order = sorted(firsts, reverse=True)
    guests = [(firsts[later], order[k - 1]) for k, later in enumerate(order)]  # order[-1] for the first of all
    guest_of = F.create_map(*[x for top, at in guests for x in (F.lit(top).cast("long"), F.lit(at))]) if guests else F.create_map().cast(T.MapType(T.LongType(), T.IntegerType()))
    own = F.struct(F.col("_range").alias("range"), F.lit(0).alias("guest"))
    other = F.struct(guest_of[F.col("_at")].alias("range"), F.lit(1).alias("guest"))
    placed = docs.withColumn("_place", F.explode(F.when(guest_of[F.col("_at")].isNotNull(), F.array(own, other)).otherwise(F.array(own))))
    placed = placed.withColumns({"_range": F.col("_place.range"), "_guest": F.col("_place.guest")}).drop("_place")
    w = Window.partitionBy("_range").orderBy(F.col("_guest"), F.col("_at").desc(), F.col(text_col))
    return placed.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns}).where("_guest = 0").drop("_at", "_range", "_guest")


def edited(text: Column, following: Column) -> Column:
    """text with its last third (floor) replaced by as many first characters of the following text, or all of it."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(following, F.lit(1), third))


def fingerprint_edits(docs: DataFrame, pieces: int | None = None, k: int = K, width: int = WIDTH) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and the likeness of both and of the next document.

    A null text is empty. A text of fewer than `width` words is a single shingle,
    an empty or blank one has none, and two texts without any are alike (1.0).
    Rows are kept as often as they come; of the columns only doc_id and text count.
    Without `pieces`, the ranges of ids follow the bytes of the texts.
    """
    pieces = pieces or pieces_of(docs, 2 * partitions(docs.sparkSession))
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    docs = docs.withColumn("fp", sketch(F.col("text"), k, width))
    docs = with_next(docs, ["text", "fp"], pieces)
    docs = docs.withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    docs = docs.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"), "fp", "next_fp", sketch(F.col("edited_text"), k, width).alias("edited_fp"))
    return docs.select(
        "doc_id", "n_chars", "edited_sha256", as_string(F.col("fp")).alias("fingerprint"), as_string(F.col("edited_fp")).alias("edited_fingerprint"),
        resemblance(F.col("fp"), F.col("edited_fp"), k).alias("near_edited"), resemblance(F.col("fp"), F.col("next_fp"), k).alias("near_next"),
        distinct_count(F.col("fp"), k).alias("shingles"), containment(F.col("fp"), F.col("edited_fp"), k).alias("kept_share"),
    )
