"""Queries on scans, cleaning, set operations and checks."""

from pyspark.sql import functions as F

from annalist.operators import clean, derive, merging, profile, profiles
from annalist.operators.joins import lost_rows
from annalist.plans.registry import query
from annalist.plans.tables import r4, table
from annalist.sources import manifest

_L = ["l_orderkey", "l_linenumber"]
_KEY = "o_orderkey"


@query("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_returnflag = 'R'")
def scan_parquet_project(spark, d):
    return table(spark, d, "lineitem").where((F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")) & (F.col("l_returnflag") == "R")).select("l_orderkey", "l_quantity")


@query("SELECT 'orders' AS source, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def row_count_by_source(spark, d):
    return manifest.count_rows({n: table(spark, d, n) for n in ("orders", "lineitem", "events")})


@query("""
WITH b AS (SELECT CASE WHEN o_orderkey % 50 = 7 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders), a AS (SELECT o_orderkey, o_orderstatus FROM orders)
SELECT 'removed' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'added', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
""")
def frame_diff_except_all(spark, d):
    a = table(spark, d, "orders").select(_KEY, "o_orderstatus")
    k = F.col(_KEY)
    b = a.select(F.when(k % 50 == 7, -k).otherwise(k).alias(_KEY), F.when(k % 100 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return manifest.frame_diff(a, b)


@query("""
WITH p AS (SELECT 'f' || o_orderkey AS name, o_totalprice AS mtime FROM orders), c AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'g' ELSE 'f' END || o_orderkey AS name, o_totalprice + o_orderkey % 3 AS mtime FROM orders)
SELECT coalesce(p.name, c.name) AS name, CASE WHEN p.name IS NULL THEN 'added' WHEN c.name IS NULL THEN 'removed' ELSE 'modified' END AS change FROM p FULL JOIN c ON p.name = c.name WHERE p.name IS NULL OR c.name IS NULL OR abs(p.mtime - c.mtime) > 1.5
""")
def manifest_diff(spark, d):
    o, k = table(spark, d, "orders"), F.col(_KEY)
    name = lambda first: F.concat(first, k.cast("string")).alias("name")
    return manifest.diff(o.select(name(F.lit("f")), F.col("o_totalprice").alias("mtime")), o.select(name(F.when(k % 5 == 0, "g").otherwise("f")), (F.col("o_totalprice") + k % 3).alias("mtime")), 1.5)


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS some FROM customer")
def drop_all_null_columns(spark, d):
    df = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("some"), F.lit(None).cast("string").alias("none"), F.when(F.col("c_custkey") < 0, 1).alias("never"))
    return clean.drop_all_null_columns(df)


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def distinct_rows(spark, d):
    return clean.distinct_with_rejects(table(spark, d, "lineitem").select(*_L, "l_returnflag"))[0]


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM (SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag) AS r FROM lineitem) WHERE r > 1")
def duplicate_rejects(spark, d):
    return clean.distinct_with_rejects(table(spark, d, "lineitem").select(*_L, "l_returnflag"))[1]


@query("SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS cust FROM orders WHERE o_custkey % 10 <> 0")
def filter_null_id(spark, d):
    return clean.drop_null_ids(table(spark, d, "orders").select(_KEY, F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("cust")), "cust")[0]


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def anti_blocklist(spark, d):
    blocked = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return clean.block_ids(table(spark, d, "orders").select(_KEY, "o_custkey"), "o_custkey", blocked)[0]


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_sensitive(spark, d):
    return clean.drop_sensitive(table(spark, d, "customer"), ["c_name", "c_acctbal", "c_phone"])


@query("""
SELECT column_name, count(DISTINCT coalesce(v, '?')) = 1 AS is_constant FROM (
  SELECT 'c_custkey' AS column_name, CAST(c_custkey AS VARCHAR) AS v FROM customer UNION ALL SELECT 'one', 'a' FROM customer UNION ALL SELECT 'none', NULL FROM customer UNION ALL SELECT 'mixed', CASE WHEN c_custkey % 2 = 0 THEN 'a' END FROM customer
) GROUP BY column_name
""")
def local_constant_columns(spark, d):
    return clean.constant_flags(table(spark, d, "customer").select("c_custkey", F.lit("a").alias("one"), F.lit(None).cast("string").alias("none"), F.when(F.col("c_custkey") % 2 == 0, "a").alias("mixed")))


@query("SELECT 'o_orderkey' AS column_name, 0.0 AS null_ratio UNION ALL SELECT 'status', CAST(round(avg(CASE WHEN o_orderkey % 3 = 0 THEN 1.0 ELSE 0.0 END), 4) AS DOUBLE) FROM orders")
def null_ratio_by_column(spark, d):
    df = table(spark, d, "orders").select(_KEY, F.when(F.col(_KEY) % 3 != 0, F.col("o_orderstatus")).alias("status"))
    return clean.null_ratios(df).withColumn("null_ratio", r4("null_ratio"))


@query("SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def ids_with_multiple_rows(spark, d):
    return clean.repeated_ids(table(spark, d, "lineitem"), "l_orderkey")


@query("""
WITH f AS (SELECT c_nationkey AS f, CASE WHEN min(CASE WHEN c_nationkey < 3 THEN c_mktsegment ELSE 'same' END) = max(CASE WHEN c_nationkey < 3 THEN c_mktsegment ELSE 'same' END) THEN 1 ELSE 0 END AS k FROM customer GROUP BY c_nationkey)
SELECT 'mostly' AS column_name, 'same' AS value, CAST(round(sum(k) / count(*), 4) AS DOUBLE) AS share FROM f
""")
def globally_constant_columns(spark, d):
    df = table(spark, d, "customer").select("c_nationkey", F.when(F.col("c_nationkey") < 3, F.col("c_mktsegment")).otherwise("same").alias("mostly"), F.lit(None).cast("string").alias("none"), F.col("c_name"))
    return clean.globally_constant_columns(df, "c_nationkey").withColumn("share", r4("share"))


_FILES = "(SELECT c_nationkey AS f, CASE WHEN c_nationkey % 7 = 3 THEN c_mktsegment ELSE 'most' END AS constant, CASE WHEN c_nationkey % 5 < 3 THEN 'half' ELSE c_mktsegment END AS middle, CASE WHEN c_custkey % 10 = 0 THEN c_mktsegment END AS sparse, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS none FROM customer)"


@query(f"""
WITH u AS (UNPIVOT (SELECT f, coalesce(constant, 'Missing') AS constant, coalesce(middle, 'Missing') AS middle, coalesce(sparse, 'Missing') AS sparse, coalesce(segment, 'Missing') AS segment, coalesce(none, 'Missing') AS none FROM {_FILES}) ON constant, middle, sparse, segment, none INTO NAME column_name VALUE value),
k AS (SELECT column_name, f, CASE WHEN count(DISTINCT value) = 1 THEN min(value) ELSE 'NonConstant' END AS value FROM u GROUP BY ALL),
c AS (SELECT column_name, value, count(*) AS n FROM k GROUP BY ALL), a AS (SELECT column_name, value, count(*) AS n FROM u GROUP BY ALL),
d AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS r, sum(n) OVER (PARTITION BY column_name) AS t, count(*) OVER (PARTITION BY column_name) AS m FROM a),
v AS (SELECT column_name, string_agg(value || ' (' || printf('%.2f', 100 * n / t) || '%)', ', ' ORDER BY r) FILTER (r <= 3) || CASE WHEN max(m) > 3 THEN '... (' || (max(m) - 3) || ' more not shown)' ELSE '' END AS "values", coalesce(max(CASE WHEN value = 'Missing' THEN n / t END), 0) AS missing_share, max(m) AS m FROM d GROUP BY 1),
t AS (SELECT column_name, CAST(sum(n) AS BIGINT) AS n_files, CAST(sum(CASE WHEN value <> 'NonConstant' THEN n ELSE 0 END) AS BIGINT) AS n_constant, arg_min(value, (-n, value)) FILTER (value <> 'NonConstant') AS top_value, coalesce(max(n) FILTER (value <> 'NonConstant'), 0) / sum(n) AS top_share FROM c GROUP BY 1)
SELECT t.column_name, CASE WHEN top_share >= 0.8 THEN 'constant' WHEN missing_share >= 0.8 THEN 'missing' WHEN top_share >= 0.5 THEN 'middle' END AS verdict, top_value, CAST(round(top_share, 4) AS DOUBLE) AS top_share, n_files, n_constant, CAST(round(missing_share, 4) AS DOUBLE) AS missing_share, "values"
FROM t JOIN v ON t.column_name = v.column_name WHERE NOT (v.m = 1 AND missing_share = 1)
""")
def constancy_over_files(spark, d):
    f, s = F.col("c_nationkey"), F.col("c_mktsegment")
    df = table(spark, d, "customer").select(
        f.alias("f"), F.when(f % 7 == 3, s).otherwise("most").alias("constant"), F.when(f % 5 < 3, "half").otherwise(s).alias("middle"),
        F.when(F.col("c_custkey") % 10 == 0, s).alias("sparse"), s.alias("segment"), F.lit(None).cast("string").alias("none"),
    )
    return clean.constancy(df, "f", most=3).drop("constants").withColumns({"top_share": r4("top_share"), "missing_share": r4("missing_share")})


@query("SELECT p_partkey, replace(p_name, ' ', ' and ') AS p_name FROM part")
def replace_ampersand(spark, d):
    return clean.replace_ampersand(table(spark, d, "part").select("p_partkey", F.regexp_replace("p_name", " ", " & ").alias("p_name")))


@query("SELECT r_regionkey, '2018-2019' AS _cohort, '7' AS _year_group, CAST(NULL AS VARCHAR) AS _phase FROM region")
def append_metadata(spark, d):
    return clean.append_metadata(table(spark, d, "region").select("r_regionkey"), cohort="2018-2019", year_group=7, phase=None)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders WHERE o_orderkey % 11 = 0 OR o_orderpriority <> '4-NOT SPECIFIED'")
def filter_non_substantive(spark, d):
    df = table(spark, d, "orders").select(_KEY, F.when(F.col(_KEY) % 11 != 0, F.col("o_orderpriority")).alias("p"))
    return df.where(clean.substantive(F.col("p"), ["4-not specified", "unknown"]))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN NULL ELSE o_orderstatus END AS status FROM orders")
def recode_values(spark, d):
    return table(spark, d, "orders").select(_KEY, clean.recode(F.col("o_orderstatus"), {"O": "open", "P": None}).alias("status"))


@query("""
WITH t AS (SELECT o_orderstatus AS a, o_orderpriority AS b, o_orderstatus AS c, concat(o_orderstatus, '') AS d FROM orders), v AS (SELECT * FROM (VALUES ('a', 1), ('b', 2), ('c', 3), ('d', 4)) AS v(name, place)),
s AS (SELECT x.name AS kept, y.name AS dropped, x.place FROM v x JOIN v y ON x.place < y.place WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE CASE x.name WHEN 'a' THEN a WHEN 'b' THEN b WHEN 'c' THEN c ELSE d END IS DISTINCT FROM CASE y.name WHEN 'a' THEN a WHEN 'b' THEN b WHEN 'c' THEN c ELSE d END))
SELECT kept, dropped FROM s WHERE kept NOT IN (SELECT dropped FROM s)
""")
def identical_columns(spark, d):
    s = F.col("o_orderstatus")
    return clean.identical_columns(table(spark, d, "orders").select(_KEY, s.alias("a"), F.col("o_orderpriority").alias("b"), s.alias("c"), F.concat(s, F.lit("")).alias("d")), [_KEY])


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS s FROM orders),
r AS (SELECT o_custkey, s AS fill FROM (SELECT o_custkey, s, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM o WHERE year(o_orderdate) >= 2000 AND s IS NOT NULL) WHERE r = 1)
SELECT o_orderkey, CASE WHEN s IS NULL AND year(o_orderdate) < 2000 THEN fill ELSE s END AS s FROM o LEFT JOIN r ON o.o_custkey = r.o_custkey
""")
def backfill_from_reference_row(spark, d):
    df = table(spark, d, "orders").select(_KEY, "o_custkey", "o_orderdate", F.when(F.col(_KEY) % 3 != 0, F.col("o_orderstatus")).alias("s"))
    late = F.year("o_orderdate") >= 2000
    return clean.backfill_from_reference(df, "o_custkey", "s", ~late, late, [F.desc("o_orderdate"), F.desc(_KEY)]).select(_KEY, "s")


# ---- sets, order, limit

@query("SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS c_name FROM orders UNION ALL SELECT NULL, NULL, c_name FROM customer")
def union_by_name_missing(spark, d):
    return table(spark, d, "orders").select(_KEY, "o_orderstatus").unionByName(table(spark, d, "customer").select("c_name"), allowMissingColumns=True)


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_difference_ids(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey"))


@query("SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0 INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_intersection_ids(spark, d):
    return table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")).intersect(table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey"))


@query("""
WITH t AS (SELECT DISTINCT user_id, event_type FROM events), n AS (SELECT user_id, count(*) AS n FROM t GROUP BY user_id), i AS (SELECT a.user_id, count(*) AS c FROM t a JOIN t b ON b.user_id = a.user_id + 1 AND a.event_type = b.event_type GROUP BY a.user_id)
SELECT a.user_id, CAST(round(coalesce(c, 0) / (a.n + b.n - coalesce(c, 0)), 4) AS DOUBLE) AS jaccard FROM n a JOIN n b ON b.user_id = a.user_id + 1 LEFT JOIN i ON i.user_id = a.user_id
""")
def jaccard_set_similarity(spark, d):
    s = table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("a"))
    n = s.select((F.col("user_id") - 1).alias("user_id"), F.col("a").alias("b"))
    return s.join(n, "user_id").select("user_id", r4(merging.set_similarity(F.col("a"), F.col("b"))).alias("jaccard"))


@query("""
SELECT DISTINCT o_custkey AS id, '1998' AS _cohort, '7' AS _year_group, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS priority FROM orders WHERE year(o_orderdate) = 1998
UNION SELECT DISTINCT o_custkey, '1999', '8', CAST(NULL AS VARCHAR), o_orderpriority FROM orders WHERE year(o_orderdate) = 1999
""")
def longitudinal_union(spark, d):
    from annalist.pipeline import longitudinal

    o = table(spark, d, "orders")
    a = o.where(F.year("o_orderdate") == 1998).select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status"))
    b = o.where(F.year("o_orderdate") == 1999).select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("priority"))
    return longitudinal([("1998", 7, a), ("1999", 8, b)])


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey")
def order_by_multi(spark, d):
    return table(spark, d, "orders").select(_KEY, "o_orderstatus", "o_totalprice").orderBy("o_orderstatus", F.desc("o_totalprice"), _KEY)


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25")
def topn_sample(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(25)


# ---- checks and profiles

@query("SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_duplicates FROM lineitem")
def duplicate_row_count(spark, d):
    return profile.duplicate_rows(table(spark, d, "lineitem").select(*_L))


@query("""
WITH s AS (SELECT DISTINCT o_orderstatus AS category, year(o_orderdate) AS file, CASE WHEN year(o_orderdate) % 2 = 0 AND o_orderpriority = '1-URGENT' OR year(o_orderdate) % 7 = 0 AND o_orderpriority = '5-LOW' THEN 'other' ELSE o_orderpriority END AS column_name FROM orders), n AS (SELECT category, count(DISTINCT file) AS files FROM s GROUP BY category)
SELECT s.category, column_name, count(DISTINCT file) AS files, max(n.files) - count(DISTINCT file) AS missing FROM s JOIN n ON s.category = n.category GROUP BY s.category, column_name HAVING count(DISTINCT file) >= 0.8 * max(n.files)
""")
def schema_drift_common_columns(spark, d):
    y, p = F.year("o_orderdate"), F.col("o_orderpriority")
    gap = ((y % 2 == 0) & (p == "1-URGENT")) | ((y % 7 == 0) & (p == "5-LOW"))
    s = table(spark, d, "orders").select(F.col("o_orderstatus").alias("category"), y.alias("file"), F.when(gap, "other").otherwise(p).alias("column_name"))
    return profile.common_columns(s)


_MEASURED = "strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR)".format
_MD5 = "CAST(count(*) AS VARCHAR) || ':' || CAST(sum(CAST(CAST('0x' || substring(md5({}), 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR)"


@query(f"SELECT {_MD5.format(" || ".join(map(_MEASURED, ["n_nationkey", "n_name", "n_regionkey"])))} AS fingerprint FROM nation")
def dataset_fingerprint(spark, d):
    n = table(spark, d, "nation")
    return n.agg(profile.fingerprint(n, ["n_nationkey", "n_name", "n_regionkey"]).alias("fingerprint"))


@query(f"""
WITH f AS (SELECT n_regionkey % 2 AS file, n_nationkey % 3 AS k, n_regionkey FROM nation), h AS (SELECT n_regionkey, {_MD5.format(_MEASURED("n_nationkey // 5"))} AS fp FROM nation GROUP BY n_regionkey)
SELECT fp, count(*) AS files FROM h GROUP BY fp HAVING count(*) > 1
""")
def duplicate_dataset_hash(spark, d):
    n = table(spark, d, "nation").withColumn("v", F.floor(F.col("n_nationkey") / 5))
    return n.groupBy("n_regionkey").agg(profile.fingerprint(n, ["v"]).alias("fp")).groupBy("fp").agg(F.count("*").alias("files")).where("files > 1")


@query("""
SELECT 'o_totalprice' AS column_name, count(o_totalprice) AS n, CAST(0 AS BIGINT) AS n_missing, CAST(round(avg(o_totalprice), 2) AS DOUBLE) AS mean, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders
UNION ALL SELECT 'o_custkey', count(o_custkey), CAST(0 AS BIGINT), CAST(round(avg(o_custkey), 2) AS DOUBLE), min(o_custkey), max(o_custkey) FROM orders
""")
def profile_numeric_summary(spark, d):
    return profile.numeric_summary(table(spark, d, "orders"), ["o_totalprice", "o_custkey"]).withColumn("mean", F.round("mean", 2))


_MOMENTS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(x) AS n, count(*) - count(x) AS n_missing, count(CASE WHEN x = 0 THEN 1 END) AS n_zero, CAST(round(avg(x), 4) AS DOUBLE) AS mean, CAST(round(stddev_samp(x), 4) AS DOUBLE) AS stddev,
       CAST(round((avg(x * x * x) - 3 * avg(x) * avg(x * x) + 2 * avg(x) ** 3) / (avg(x * x) - avg(x) ** 2) ** 1.5, 4) AS DOUBLE) AS skewness, min(x) AS lo, max(x) AS hi
FROM (SELECT CASE WHEN l_orderkey % 9 <> 0 THEN CAST({c} AS DOUBLE) END AS x FROM lineitem)""" for c in _MOMENTS))
def profile_full(spark, d):
    li = table(spark, d, "lineitem").select(*[F.when(F.col("l_orderkey") % 9 != 0, F.col(c)).alias(c) for c in _MOMENTS])
    return profiles.profile(li, _MOMENTS).select("column_name", "n", "n_missing", "n_zero", r4("mean").alias("mean"), r4("stddev").alias("stddev"), r4("skewness").alias("skewness"), "lo", "hi")


@query("""
WITH t AS (SELECT CASE WHEN l_orderkey % 9 <> 0 THEN CAST(l_quantity AS DOUBLE) END AS q, CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_extendedprice AS DOUBLE) END AS p, CASE WHEN l_orderkey % 45 <> 0 THEN CAST(l_discount AS DOUBLE) END AS s FROM lineitem),
f AS (SELECT *, CASE WHEN q IS NULL THEN 1.0 ELSE 0.0 END AS nq, CASE WHEN p IS NULL THEN 1.0 ELSE 0.0 END AS np, CASE WHEN s IS NULL THEN 1.0 ELSE 0.0 END AS ns FROM t)
SELECT 'q' AS a, 'p' AS b, count(CASE WHEN q IS NOT NULL AND p IS NOT NULL THEN 1 END) AS n_both, CAST(round(corr(q, p), 4) AS DOUBLE) AS correlation, CAST(round(corr(nq, np), 4) AS DOUBLE) AS null_correlation FROM f
UNION ALL SELECT 'q', 's', count(CASE WHEN q IS NOT NULL AND s IS NOT NULL THEN 1 END), CAST(round(corr(q, s), 4) AS DOUBLE), CAST(round(corr(nq, ns), 4) AS DOUBLE) FROM f
UNION ALL SELECT 'p', 's', count(CASE WHEN p IS NOT NULL AND s IS NOT NULL THEN 1 END), CAST(round(corr(p, s), 4) AS DOUBLE), CAST(round(corr(np, ns), 4) AS DOUBLE) FROM f
""")
def profile_correlations(spark, d):
    k = F.col("l_orderkey")
    li = table(spark, d, "lineitem").select(F.when(k % 9 != 0, F.col("l_quantity")).alias("q"), F.when(k % 5 != 0, F.col("l_extendedprice")).alias("p"), F.when(k % 45 != 0, F.col("l_discount")).alias("s"))
    return profiles.correlations(li, ["q", "p", "s"]).withColumns({"correlation": r4("correlation"), "null_correlation": r4("null_correlation")})


@query("""
WITH c AS (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS place FROM c) WHERE place <= 3
""")
def profile_categorical_topk(spark, d):
    return profile.top_values(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], 3)


@query("""
SELECT * FROM (SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'l_returnflag' END, CASE WHEN count(DISTINCT l_linestatus) > 1 THEN 'l_linestatus' END) AS differing FROM lineitem GROUP BY ALL) WHERE differing <> ''
""")
def differing_columns_per_group(spark, d):
    return profile.differing_columns(table(spark, d, "lineitem"), _L, ["l_returnflag", "l_linestatus"])


@query("SELECT o_orderpriority FROM orders GROUP BY o_orderpriority HAVING count(DISTINCT o_orderstatus) > 1")
def functional_dependency_violations(spark, d):
    return derive.dependency_violations(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders WHERE o_custkey % 10 = 3")
def lost_rows_anti(spark, d):
    o = table(spark, d, "orders").select(_KEY, "o_custkey")
    return lost_rows(o, o.withColumn("o_custkey", F.when(F.col("o_custkey") % 10 != 3, F.col("o_custkey"))))
