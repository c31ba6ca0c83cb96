"""URL filters by a path-template tree, with built-in functions only.

Paths are first reduced to shapes (digits and long hex runs become `#`). Per host
the shapes form a tree. Level by level, sibling branches that are statistically
similar are merged into the wildcard `*`: their share of bad labelled pages and
what their pages go on with (an end, digits, a name, a slash) must not differ from
their parent's as a whole by more than chance among all siblings. A branch that
differs in either keeps its name. A template is rejected if its labelled share of
bad pages, smoothed towards the share of all, reaches a limit. Explicit rules come
first.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import cut, tables

#: (host, path prefix, verdict)
Rule = tuple[str, str, str]
#: Standard errors by which a branch must differ to stay by itself, if it has no siblings.
APART = 3.0
#: Pages at the overall rate that are added to each template's labelled pages.
PRIOR = 10.0
REJECT = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a url without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule (as `host` + `path`) that fits, as a struct of rule and verdict, or null."""
    kind = "struct<rule:string,verdict:string>"
    out = F.lit(None).cast(kind)
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def shape(path: Column) -> Column:
    """The path with long hex runs and runs of digits replaced by #."""
    return F.regexp_replace(F.regexp_replace(path, "[0-9A-Fa-f]{16,}", "#"), "[0-9]+", "#")


def _divergence(counts: list[Column], shares: list[Column]) -> Column:
    """n times the Kullback-Leibler divergence of n observations from the shares; its exponent bounds the chance of as much by sampling. Where a count is not 0, its share is not either."""
    total = reduce(Column.__add__, counts)
    terms = [F.when(c > 0, c * F.log(c / (total * p))).otherwise(0.0) for c, p in zip(counts, shares, strict=True)]
    return reduce(Column.__add__, terms)


_KINDS = ("end", "digits", "slash", "name")


def templates(shapes: DataFrame, apart: float = APART) -> DataFrame:
    """shapes (host, shape, n, labelled, bad; a row for each host and shape) with `template`."""
    parts = F.split(F.regexp_replace("shape", "^/", ""), "/")
    tree = shapes.withColumn("_parts", F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(parts)).withColumn("_prefix", F.lit(""))
    depth = tree.agg(F.max(F.size("_parts"))).first()[0] or 0
    for level in range(1, depth + 1):  # until no path has more segments
        tree = cut(tree.withColumn("_seg", F.when(F.size("_parts") >= level, F.get("_parts", F.lit(level - 1)))), f"templates-{level}")
        ahead = F.get("_parts", F.lit(level))
        kind = F.when(ahead.isNull(), "end").when(ahead == "#", "digits").when(ahead == "", "slash").otherwise("name")
        sums = [F.sum(c).alias(c) for c in ("labelled", "bad")] + [F.sum(F.when(kind == k, F.col("n")).otherwise(0)).alias(k) for k in _KINDS]
        nodes = tree.where("_seg IS NOT NULL").groupBy("host", "_prefix", "_seg").agg(*sums)
        pooled = nodes.groupBy("host", "_prefix").agg(F.count("*").alias("p_children"), *[F.sum(c).alias(f"p_{c}") for c in ("labelled", "bad", *_KINDS)])
        rate = (F.col("p_bad") + 0.5) / (F.col("p_labelled") + 1.0)
        by_label = _divergence([F.col("bad"), F.col("labelled") - F.col("bad")], [rate, 1 - rate])
        pages = reduce(Column.__add__, [F.col(f"p_{k}") for k in _KINDS])
        by_kind = _divergence([F.col(k) for k in _KINDS], [F.col(f"p_{k}") / pages for k in _KINDS])
        # of many branches some differ by chance: the chance must be small for all of them
        kept = nodes.join(pooled, ["host", "_prefix"]).where(F.greatest(by_label, by_kind) >= apart**2 / 2 + F.log("p_children")).select("host", "_prefix", "_seg", F.lit(True).alias("_own"))
        kept = cut(kept, f"kept-{level}")
        # a segment of digits alone stays a class of its own
        named = F.when(F.col("_own") | (F.col("_seg") == "#") | (F.col("_seg") == ""), F.col("_seg")).otherwise("*")
        tree = tree.join(kept, ["host", "_prefix", "_seg"], "left").withColumn("_prefix", F.when(F.col("_seg").isNull(), F.col("_prefix")).otherwise(F.concat("_prefix", F.lit("/"), named))).drop("_own", "_seg")
    return tree.withColumn("template", F.col("_prefix")).drop("_parts", "_prefix")


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule], prior: float = PRIOR, reject: float = REJECT, **tree) -> DataFrame:
    """page_id, host, path, rule, verdict, template and bad_share of each page; labels: page_id, bad (0 or 1).

    Without a rule, `block` if the template's smoothed share of bad pages is at
    least `reject`, else `allow`. A null or malformed url has an empty host and
    path, and is judged by that template. Labels that are null, or of pages not
    here, don't count; of a page labelled twice the worse label does. Pages are
    judged as often as they come; columns but page_id and url don't matter. Pages
    are counted by host and shape before anything else is done with them, and the
    verdicts come back to them by a join that adaptive execution splits where one
    host and shape has very many pages.
    """
    with tables(pages.sparkSession):
        return _judged(pages, labels, rules, prior, reject, **tree)


def _judged(pages: DataFrame, labels: DataFrame, rules: list[Rule], prior: float, reject: float, **tree) -> DataFrame:
    host, path = split_url(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("shape", shape(F.col("path")))
    marks = labels.where("bad IS NOT NULL AND page_id IS NOT NULL").groupBy("page_id").agg(F.max(F.col("bad").cast("long")).alias("bad"))
    counted = pages.select("page_id", "host", "shape").join(marks, "page_id", "left").groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    tree = cut(templates(cut(counted, "shapes"), **tree), "tree")
    told = tree.agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).first()
    overall = (told["bad"] or 0) / (told["labelled"] or 1)
    purity = tree.groupBy("host", "template").agg(((F.sum("bad") + F.lit(prior * overall)) / (F.sum("labelled") + F.lit(prior))).alias("bad_share"))
    verdicts = cut(tree.select("host", "shape", "template").join(purity, ["host", "template"]), "verdicts", keep=True)
    found = pages.join(verdicts, ["host", "shape"], "left").withColumn("_m", matched(rules, F.col("host"), F.col("path")))
    own = F.when(F.col("bad_share") >= reject, "block").otherwise("allow")
    return found.select("page_id", "host", "path", F.col("_m.rule").alias("rule"), F.coalesce(F.col("_m.verdict"), own).alias("verdict"), "template", "bad_share")
