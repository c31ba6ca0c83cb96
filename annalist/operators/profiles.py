"""Profiles of whole tables in one pass: moments, quantiles and histograms from sketches that merge, and correlations of values and of nulls from co-moments."""

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch; see rank_error().
SKETCH_K = 400
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
BINS = 10
#: Quantiles that a histogram is made of.
GRID = 500
#: Pairs of columns whose co-moments one aggregate takes.
PAIRS = 500


def rank_error(k: int = SKETCH_K) -> float:
    """How far a rank from a sketch may be off, as a share of all values, 99 times of 100."""
    return 2.446 / k**0.9433


def _number(c: str) -> Column:
    """The column as a double, without NaN and infinities, which have no place in moments."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def sketches(df: DataFrame, columns: list[str], by: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """(by, column_name, n_rows, n, n_zero, n_negative, total, squares, cubes, fourths, lo, hi, sketch): what a profile is made of, for each group; merged() makes one of several.

    Powers are of the values themselves, so they add up over parts; columns whose
    values lie far from 0 against their spread lose digits of their higher moments.
    """
    def parts(c: str) -> dict[str, Column]:
        x = _number(c)
        return {
            "n_rows": F.count("*"), "n": F.count(x), "n_zero": F.count_if(x == 0), "n_negative": F.count_if(x < 0),
            "total": F.sum(x), "squares": F.sum(x * x), "cubes": F.sum(x * x * x), "fourths": F.sum(x * x * x * x),
            "lo": F.min(x), "hi": F.max(x), "sketch": F.kll_sketch_agg_double(x, k),
        }

    by, names = by or [], list(parts("x"))
    wide = df.groupBy(*by).agg(*[x.alias(f"{n}_{i}") for i, c in enumerate(columns) for n, x in parts(c).items()])
    rows = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}_{i}").alias(n) for n in names]) for i, c in enumerate(columns)]
    return wide.select(*by, F.explode(F.array(*rows)).alias("x")).select(*by, "x.*")


def merged(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketches of the same columns over several parts (days, files) as those of all."""
    sums = ["n_rows", "n", "n_zero", "n_negative", "total", "squares", "cubes", "fourths"]
    return parts.groupBy(*(by or []), "column_name").agg(*[F.sum(c).alias(c) for c in sums], F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.kll_merge_agg_double("sketch").alias("sketch"))


def described(sketched: DataFrame, quantiles: tuple[float, ...] = QUANTILES, bins: int = BINS) -> DataFrame:
    """sketches() as a profile: counts, moments (of the sample for the variance, of all for skewness and excess kurtosis), quantiles `q05` and so on, and a histogram of equal widths, its counts from quantiles, off by the sketch's error and 1 / GRID of all values at each edge.

    A column without values has nulls; one with a single value a histogram of one bin.
    """
    n, mean = F.col("n"), F.try_divide("total", "n")
    m2 = F.greatest(F.col("squares") / n - mean * mean, F.lit(0.0))
    m3 = F.col("cubes") / n - 3 * mean * F.col("squares") / n + 2 * F.pow(mean, F.lit(3))
    m4 = F.col("fourths") / n - 4 * mean * F.col("cubes") / n + 6 * mean * mean * F.col("squares") / n - 3 * F.pow(mean, F.lit(4))
    some = n > 0
    when = lambda x: F.when(some, x)
    # how many of evenly spaced quantiles lie in each bin
    grid = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)]))
    place = lambda v: F.least(F.floor((v - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    counts = lambda g: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.round(F.size(F.filter(g, lambda p: p == i)) * n / GRID).cast("long"))
    histogram = F.when(some & (F.col("lo") == F.col("hi")), F.array(n)).when(some, F.transform(F.array(F.transform(grid, place)), counts)[0])
    return sketched.select(
        *[c for c in sketched.columns if c not in ("total", "squares", "cubes", "fourths", "lo", "hi", "sketch", "n_rows", "n", "n_zero", "n_negative")],
        "n", (F.col("n_rows") - n).alias("n_missing"), "n_zero", "n_negative", when(mean).alias("mean"), F.when(n > 1, F.sqrt(m2 * n / (n - 1))).alias("stddev"),
        F.when(some & (m2 > 0), m3 / F.pow(m2, F.lit(1.5))).alias("skewness"), F.when(some & (m2 > 0), m4 / (m2 * m2) - 3).alias("kurtosis"), "lo", "hi",
        *[when(F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(f"q{round(q * 100):02d}") for q in quantiles], histogram.alias("histogram"),
    )


def profile(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """described() of number columns, in one pass over df."""
    return described(sketches(df, columns, by))


def _corr(x: Column, y: Column) -> Column:
    """Pearson's correlation over rows where both are there; null where one doesn't vary."""
    varies = lambda a, b: F.min(F.when(b.isNotNull(), a)) < F.max(F.when(b.isNotNull(), a))  # noqa: E731  co-moments of equal values may not be quite 0
    return F.when(varies(x, y) & varies(y, x), F.try_divide(F.regr_sxy(x, y), F.sqrt(F.regr_sxx(x, y) * F.regr_syy(x, y))))


def correlations(df: DataFrame, columns: list[str], values: bool = True) -> DataFrame:
    """(a, b, n_both, correlation, null_correlation) of all pairs of columns: Pearson's over rows where both have a value, and of having none over all rows.

    Null where one side doesn't vary. All pairs come from one aggregate of co-moments
    (of up to PAIRS pairs; more take more passes); with values=False only of nulls.
    """
    pairs = list(combinations(columns, 2))
    out = None
    for start in range(0, len(pairs), PAIRS):
        some, aggregates = pairs[start : start + PAIRS], []
        for i, (a, b) in enumerate(some):
            x, y = (_number(a), _number(b)) if values else (F.lit(None).cast("double"), F.lit(None).cast("double"))
            none = [F.col(c).isNull().cast("double") for c in (a, b)]
            aggregates += [F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"n{i}"), _corr(x, y).alias(f"v{i}"), _corr(*none).alias(f"m{i}")]
        rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"n{i}").alias("n_both"), F.nanvl(f"v{i}", F.lit(None)).alias("correlation"), F.nanvl(f"m{i}", F.lit(None)).alias("null_correlation")) for i, (a, b) in enumerate(some)]
        part = df.agg(*aggregates).select(F.explode(F.array(*rows)).alias("x")).select("x.*")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else df.sparkSession.createDataFrame([], "a string, b string, n_both bigint, correlation double, null_correlation double")
