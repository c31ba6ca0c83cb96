"""Queries on merging, types, metadata and composites of features."""

from functools import reduce

from pyspark.sql import functions as F

from annalist.operators import derive, guards, joins, merging, profile, references, schemas
from annalist.plans.registry import query
from annalist.plans.tables import big, table

_KEY = "o_orderkey"

#: A record for each customer, age (by the order's year) and half of the year.
_FACTS_SQL = "(SELECT o_custkey AS id, year(o_orderdate) - 1982 AS dest_age, CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 2 END AS dest_half, max(o_orderstatus) AS dest_code, count(*) AS dest_n FROM orders GROUP BY ALL)"


def _facts(spark, d):
    o = table(spark, d, "orders")
    keys = [F.col("o_custkey").alias("id"), (F.year("o_orderdate") - 1982).alias("dest_age"), F.when(F.month("o_orderdate") < 7, 1).otherwise(2).alias("dest_half")]
    return o.groupBy(*keys).agg(F.max("o_orderstatus").alias("dest_code"), F.count("*").alias("dest_n"))


_AGES_SQL = f"(SELECT greatest(15, (SELECT min(dest_age) FROM {_FACTS_SQL} WHERE dest_half = 1)) AS first, least(24, (SELECT max(dest_age) FROM {_FACTS_SQL} WHERE dest_half = 2)) AS last)"
_LATER_SQL = f"""
WITH f AS {_FACTS_SQL}, b AS ({{base}}), a AS (SELECT unnest(range(first, greatest(first + 1, last))) AS age FROM {_AGES_SQL}),
p AS (SELECT b.*, a.age, ph.phase FROM b CROSS JOIN a CROSS JOIN (SELECT unnest(['pre', 'post']) AS phase) ph),
x AS (SELECT id, dest_age AS age, CASE dest_half WHEN 1 THEN 'pre' ELSE 'post' END AS phase, dest_code AS latest, dest_n FROM f WHERE id IN (SELECT id FROM b)),
t AS (SELECT id, CASE dest_half WHEN 2 THEN dest_age ELSE dest_age - 1 END AS age, CASE dest_half WHEN 2 THEN 'pre' ELSE 'post' END AS phase, dest_code AS code FROM f WHERE id IN (SELECT id FROM b)),
k AS (SELECT DISTINCT x.age, x.phase FROM x JOIN t ON x.age = t.age AND x.phase = t.phase)
SELECT p.*, x.latest, x.dest_n, t.code FROM p JOIN k ON p.age = k.age AND p.phase = k.phase LEFT JOIN x ON x.id = p.id AND x.age = p.age AND x.phase = p.phase LEFT JOIN t ON t.id = p.id AND t.age = p.age AND t.phase = p.phase
WHERE p.age <= 17 OR x.id IS NOT NULL
"""


@query("SELECT id, CAST(age AS BIGINT) AS age, phase, seg, latest, dest_n, code FROM (" + _LATER_SQL.format(base="SELECT c_custkey AS id, c_mktsegment AS seg FROM customer") + ")")
def train_target_many_features(spark, d):
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("seg"))
    told = _facts(spark, d).agg(F.min(F.when(F.col("dest_half") == 1, F.col("dest_age"))).alias("lo"), F.max(F.when(F.col("dest_half") == 2, F.col("dest_age"))).alias("hi")).first()
    first, last = max(15, told["lo"]), min(24, told["hi"])
    ages = base.withColumn("dest_age", F.explode(F.sequence(F.lit(first), F.lit(max(first, last - 1)))))
    out = joins.train_and_target(ages, _facts(spark, d), "id", "dest_age", "dest_half", "dest_code", 17)
    return out.select("id", big("dest_age").alias("age"), F.col("_phase").alias("phase"), "seg", F.col("dest_code_latest").alias("latest"), "dest_n", F.col("dest_code").alias("code"))


_CENSUS_SQL = "(SELECT c_custkey AS id, c_mktsegment AS census_seg, c_acctbal AS census_bal FROM customer)"
_ATT_SQL = "(SELECT CASE WHEN o_custkey % 10 = 3 THEN -o_custkey ELSE o_custkey END AS id, count(*) AS att_n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)"
_KS4_SQL = "(SELECT o_custkey AS id, max(o_totalprice) AS ks4_top FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)"
_SCHOOL_SQL = f"(SELECT coalesce(c.id, a.id) AS id, census_seg, census_bal, att_n FROM {_CENSUS_SQL} c FULL JOIN {_ATT_SQL} a ON c.id = a.id)"
_MERGE_BASE = f"SELECT coalesce(s.id, k.id) AS id, census_seg, census_bal, att_n, ks4_top FROM {_SCHOOL_SQL} s FULL JOIN {_KS4_SQL} k ON s.id = k.id"


@query(f"""
SELECT CAST(11 AS BIGINT) AS year_group, CAST(15 AS BIGINT) AS age, CAST(NULL AS VARCHAR) AS phase, s.id, census_seg, census_bal, att_n, CAST(NULL AS DOUBLE) AS ks4_top, CAST(NULL AS VARCHAR) AS latest, CAST(NULL AS BIGINT) AS dest_n, f.dest_code AS code
FROM {_SCHOOL_SQL} s LEFT JOIN {_FACTS_SQL} f ON f.id = s.id AND f.dest_age = 16 AND f.dest_half = 2
UNION ALL SELECT 11 + age - (SELECT first FROM {_AGES_SQL}), age, phase, id, census_seg, census_bal, att_n, ks4_top, latest, dest_n, code FROM ({_LATER_SQL.format(base=_MERGE_BASE)})
""")
def cohort_merge_end_to_end(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    k = F.col("o_custkey")
    sources = {
        "census": c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("census_seg"), F.col("c_acctbal").alias("census_bal")),
        "ks4": o.where("o_orderstatus = 'O'").groupBy(k.alias("id")).agg(F.max("o_totalprice").alias("ks4_top"), F.lit("F").alias("ks4_gender")),
        "att": o.where("o_orderstatus = 'F'").groupBy(F.when(k % 10 == 3, -k).otherwise(k).alias("id")).agg(F.count("*").alias("att_n")),
    }
    parts = merging.merge_cohort(11, sources, merging.Destinations(_facts(spark, d), "dest_age", "dest_half", "dest_code"), merging.MergeOptions("id"))
    names = {"_phase": "phase", "dest_code_latest": "latest", "dest_code": "code"}
    kinds = {"phase": "string", "census_seg": "string", "census_bal": "double", "att_n": "bigint", "ks4_top": "double", "latest": "string", "dest_n": "bigint", "code": "string"}

    def one(m):
        df = reduce(lambda x, kv: x.withColumnRenamed(*kv), names.items(), m.df)
        columns = [F.col(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in kinds.items()]
        return df.select(F.lit(m.year_group).cast("bigint").alias("year_group"), F.lit(m.age).cast("bigint").alias("age"), "id", *columns)

    return reduce(lambda a, b: a.unionByName(b), map(one, parts))


@query("""
SELECT 'status' AS column_name, 'category' AS logical, count(CASE WHEN o_orderkey % 7 <> 0 AND trim(' ' || o_orderstatus) IN ('', 'nan', 'none', 'null', 'n/a') THEN 1 END) AS became_null, count(CASE WHEN o_orderkey % 7 <> 0 AND o_orderstatus IS NULL THEN 1 END) AS unreadable FROM orders
UNION ALL SELECT 'price', 'numeric', count(CASE WHEN o_orderkey % 3 = 0 THEN 1 END), count(CASE WHEN o_orderkey % 3 <> 0 AND TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) IS NULL THEN 1 END) FROM orders
UNION ALL SELECT 'day', 'datetime', count(CASE WHEN o_orderkey % 5 IN (3, 4) THEN 1 END), count(CASE WHEN o_orderkey % 5 = 3 THEN 1 END) FROM orders
UNION ALL SELECT 'flag', 'boolean', count(CASE WHEN o_orderkey % 4 = 3 THEN 1 END), count(CASE WHEN o_orderkey % 4 = 3 THEN 1 END) FROM orders
UNION ALL SELECT 'half', 'Int64', count(CASE WHEN o_orderkey / 2 IS NULL THEN 1 END), count(CASE WHEN TRY_CAST(CAST(o_orderkey / 2 AS VARCHAR) AS DOUBLE) IS NULL THEN 1 END) FROM orders
""")
def guarded_types(spark, d):
    k = F.col(_KEY)
    df = table(spark, d, "orders").select(
        F.when(k % 7 != 0, F.concat(F.lit(" "), "o_orderstatus")).alias("status"), F.when(k % 3 == 0, "about 5").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(k % 5 == 3, "31/31/2018").when(k % 5 == 4, "StudID").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day"),
        F.when(k % 4 == 3, "maybe").when(k % 4 == 2, "No").otherwise("1.0").alias("flag"), (k / 2).cast("string").alias("half"),
    )
    kinds = {"status": "category", "price": "numeric", "day": "datetime", "flag": "boolean", "half": "Int64"}
    found = guards.findings(df, kinds, guards.typed_columns(df, kinds))
    return spark.createDataFrame([(f.column, f.logical, f.became_null, f.unreadable) for f in found], "column_name string, logical string, became_null bigint, unreadable bigint")


@query("""
WITH v AS (SELECT 'nationkey' AS column_name, CAST(c_nationkey AS VARCHAR) AS v, 'customer' AS f FROM customer UNION ALL SELECT 'nationkey', CAST(s_nationkey AS VARCHAR), 'supplier' FROM supplier UNION ALL SELECT 'segment', c_mktsegment, 'customer' FROM customer),
r AS (SELECT column_name, v, row_number() OVER (PARTITION BY column_name ORDER BY v) AS r FROM (SELECT DISTINCT column_name, v FROM v))
SELECT 'people' AS category, g.column_name, g.n_unique, g.files, s.samples FROM (SELECT column_name, count(DISTINCT v) AS n_unique, string_agg(DISTINCT f, ', ' ORDER BY f) AS files FROM v GROUP BY 1) g JOIN (SELECT column_name, string_agg(v, '|' ORDER BY v) AS samples FROM r WHERE r <= 10 GROUP BY 1) s ON g.column_name = s.column_name
""")
def column_metadata_by_category(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return schemas.column_metadata([("people", "customer", c), ("people", "supplier", s)]).select("category", "column_name", "n_unique", "files", "samples")


@query("""
WITH m AS (SELECT 'flag' AS column_name, 'bigint' AS dtype, count(DISTINCT c_custkey % 2) AS n FROM customer UNION ALL SELECT 'segment', 'string', count(DISTINCT c_mktsegment) FROM customer UNION ALL SELECT 'balance', 'double', count(DISTINCT c_acctbal) FROM customer)
SELECT column_name, CASE WHEN column_name = 'flag' AND n = 2 THEN 'boolean' WHEN column_name = 'segment' THEN 'category' ELSE 'Float64' END AS curated, TRUE AS changed FROM m
""")
def curated_column_types(spark, d):
    c = table(spark, d, "customer").select((F.col("c_custkey") % 2).alias("flag"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    told = schemas.require_described_once(schemas.column_metadata([("people", "customer", c)])).withColumn("values_text", F.lit(None).cast("string"))
    return schemas.curated_dtypes(told, {"category": ["segment"]}).select("column_name", "curated", "changed")


_ETHNIC = "(SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN ' Refused ' WHEN 1 THEN upper(n_name) WHEN 2 THEN 'e' || n_nationkey WHEN 3 THEN 'm' || n_regionkey ELSE NULL END AS e, n_name, r_name, c_nationkey % 3 AS person FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


@query(f"""
WITH k AS (SELECT *, CASE c_custkey % 5 WHEN 1 THEN r_name WHEN 2 THEN r_name WHEN 3 THEN r_name END AS main, CASE c_custkey % 5 WHEN 1 THEN n_name WHEN 2 THEN n_name END AS fine FROM {_ETHNIC} WHERE c_custkey % 5 <> 0),
g AS (SELECT person, count(DISTINCT main) AS n, CASE WHEN count(DISTINCT main) = 1 THEN min(main) END AS curated FROM k GROUP BY person)
SELECT k.c_custkey, k.fine AS der_ethnicity_ext_cat, k.main AS der_ethnicity_main_cat, g.n AS der_ethnicity_n_values, g.n > 1 AS der_ethnicity_has_conflict, g.curated AS der_ethnicity_curated FROM k JOIN g ON k.person = g.person
""")
def derived_features(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    codes = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    levels = codes.select(F.concat(F.lit("e"), "n_nationkey").alias("extended_code"), F.col("n_name").alias("extended_category"), F.concat(F.lit("m"), "n_regionkey").alias("main_code"), F.col("r_name").alias("main_category"))
    c, k = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")), F.col("c_custkey") % 5
    e = F.when(k == 0, " Refused ").when(k == 1, F.upper("n_name")).when(k == 2, F.concat(F.lit("e"), "n_nationkey")).when(k == 3, F.concat(F.lit("m"), "n_regionkey"))
    df = c.select("c_custkey", (F.col("c_nationkey") % 3).alias("person"), e.alias("ethnicity"))
    out, _ = derive.derive_features(df, "person", None, {"ethnicity": {"column": "ethnicity", "table": levels}})
    return out.select("c_custkey", *[f"der_ethnicity_{x}" for x in ("ext_cat", "main_cat", "n_values", "has_conflict", "curated")])


_SCHOOLS = "(SELECT CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS urn, max(o_totalprice) AS top, count(*) AS n FROM orders WHERE o_orderstatus = '{}' GROUP BY 1)"


@query(f"""
WITH f AS {_SCHOOLS.format("F")}, o AS {_SCHOOLS.format("O")}, c AS (SELECT c_custkey AS urn, c_mktsegment AS seg FROM customer)
SELECT CAST(k.urn AS DOUBLE) AS urn, coalesce(f.top, o.top) AS top, f.n AS n_f, o.n AS n_o, c.seg, '2018' AS acad_end_year FROM (SELECT urn FROM f UNION SELECT urn FROM o UNION SELECT urn FROM c) k
LEFT JOIN f ON f.urn = k.urn LEFT JOIN o ON o.urn = k.urn LEFT JOIN c ON c.urn = k.urn WHERE k.urn IS NOT NULL
""")
def school_table_of_a_year(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_custkey")
    one = lambda s, n: o.where(F.col("o_orderstatus") == s).groupBy(F.when(k % 10 != 0, k).alias("urn")).agg(F.max("o_totalprice").alias("top"), F.count("*").alias(n))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("urn"), F.col("c_mktsegment").alias("seg"))
    return references.school_table({2018: [one("F", "n_f"), one("O", "n_o"), c]})


@query("""
SELECT c_custkey, s.score AS d_crime_score, s.decile AS d_imd_decile FROM customer LEFT JOIN (SELECT n_nationkey, n_regionkey FROM nation WHERE n_nationkey % 4 <> 3) a ON c_nationkey = n_nationkey
LEFT JOIN (SELECT r_regionkey, length(r_name) AS score, r_regionkey + 1 AS decile FROM region) s ON a.n_regionkey = s.r_regionkey
""")
def deprivation_by_names(spark, d):
    code = lambda c: F.concat(F.lit("ab"), F.col(c).cast("string"), F.lit(" 1cd"))
    areas = table(spark, d, "nation").where("n_nationkey % 4 <> 3").select(F.upper(code("n_nationkey")).alias("pcds"), F.col("n_regionkey").alias("lsoa"))
    r = F.col("r_regionkey")
    scores = table(spark, d, "region").select(r.alias("code"), F.length("r_name").alias("Crime Score"), (r + 1).alias("IMD Decile"), r.alias("IDACI Score"), F.col("r_name").alias("note"))
    df = table(spark, d, "customer").select("c_custkey", code("c_nationkey").alias("postcode"))
    return references.with_deprivation(df, "postcode", areas, scores, "pcds", "lsoa", "code", "Decile", ["lsoa"], "d_").drop("postcode")


@query("""
WITH s AS (SELECT DISTINCT c_nationkey AS f, c_custkey % 9 AS x FROM customer), n AS (SELECT f, count(*) AS n FROM s GROUP BY f),
p AS (SELECT a.f AS a, b.f AS b FROM s a JOIN s b ON a.x = b.x JOIN n m ON m.f = a.f JOIN n k ON k.f = b.f GROUP BY a.f, b.f, m.n, k.n HAVING count(*) / (m.n + k.n - count(*)) >= 0.7),
r AS (WITH RECURSIVE g(a, b) AS (SELECT a, b FROM p UNION SELECT g.a, p.b FROM g JOIN p ON g.b = p.a) SELECT a, min(b) AS grp FROM g GROUP BY a)
SELECT a AS file, grp AS first_file FROM r
""")
def column_set_groups(spark, d):
    """Files (nations) by their sets of columns (customer numbers mod 9): a row a file, as schemas are."""
    sets = {r["f"]: set(r["x"]) for r in table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("f")).agg(F.collect_set(F.col("c_custkey") % 9).alias("x")).orderBy("f").collect()}
    files = list(sets)
    rows = [(files[i], files[g[0]]) for g in merging.column_groups([sets[f] for f in files]) for i in g]
    return spark.createDataFrame(rows, "file bigint, first_file bigint")


@query("""
WITH o AS (SELECT o_custkey AS id, year(o_orderdate) AS t, max(o_orderstatus) AS g, max(CASE WHEN o_orderpriority = '1-URGENT' THEN 'Refused' ELSE o_orderpriority END) AS l FROM orders GROUP BY ALL),
g AS (SELECT id, count(DISTINCT g) AS n, CASE WHEN count(DISTINCT g) = 1 THEN min(g) END AS curated FROM o GROUP BY id)
SELECT o.id, CAST(o.t AS BIGINT) AS t, g.n AS der_gender_n_values, g.n > 1 AS der_gender_has_conflict, g.curated AS der_gender_curated FROM o JOIN g ON o.id = g.id
""")
def derived_features_by_time(spark, d):
    """All steps over time: gender, language and school histories of the same call; what SQL says in one line is compared."""
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("t")).agg(F.max("o_orderstatus").alias("g"), F.max(F.when(F.col("o_orderpriority") == "1-URGENT", "Refused").otherwise(F.col("o_orderpriority"))).alias("l"))
    steps = {"gender": {"column": "g"}, "language": {"column": "l"}, "school": {"attributes": {"status": ["g"]}, "threshold": 1}}
    out, _ = derive.derive_features(o, "id", "t", steps)
    return out.select("id", big("t").alias("t"), *[f"der_gender_{x}" for x in ("n_values", "has_conflict", "curated")])


@query("""
WITH s AS (SELECT DISTINCT o_orderstatus AS category, CAST(year(o_orderdate) AS VARCHAR) AS file, CASE WHEN year(o_orderdate) = 1998 AND o_orderpriority = '1-URGENT' THEN '1-urgently' ELSE o_orderpriority END AS column_name FROM orders),
n AS (SELECT category, count(DISTINCT file) AS files FROM s GROUP BY 1), c AS (SELECT s.category, s.column_name FROM s JOIN n ON s.category = n.category GROUP BY ALL HAVING count(DISTINCT file) >= 0.8 * max(n.files)), f AS (SELECT DISTINCT category, file FROM s)
SELECT f.category, f.file, c.column_name, 'missing' AS kind FROM f JOIN c ON c.category = f.category WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.category = f.category AND s.file = f.file AND s.column_name = c.column_name)
UNION ALL SELECT s.category, s.file, s.column_name, 'extra' FROM s WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.category = s.category AND c.column_name = s.column_name)
""")
def schema_drift_per_file(spark, d):
    y, p = F.year("o_orderdate"), F.col("o_orderpriority")
    s = table(spark, d, "orders").select(F.col("o_orderstatus").alias("category"), y.cast("string").alias("file"), F.when((y == 1998) & (p == "1-URGENT"), "1-urgently").otherwise(p).alias("column_name")).distinct()
    return schemas.drift(s).select("category", "file", "column_name", "kind")


@query()
def schema_drift_best_match(spark, d):
    """Extra and missing columns with the most alike one on the other side (difflib's likeness has no SQL; tested against it)."""
    y, p = F.year("o_orderdate"), F.col("o_orderpriority")
    s = table(spark, d, "orders").select(F.col("o_orderstatus").alias("category"), y.cast("string").alias("file"), F.when((y == 1998) & (p == "1-URGENT"), "1-urgently").otherwise(p).alias("column_name")).distinct()
    return schemas.drift(s)


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderstatus END AS status, o_orderpriority AS priority FROM orders)
SELECT o_orderkey, status, priority, status IS NULL AS needs_review, o_orderkey % 4 = 0 OR o_orderkey % 6 = 1 OR (o_orderkey % 9 = 0) AS changed FROM o
""")
def review_flags(spark, d):
    k, s = F.col(_KEY), F.col("o_orderstatus")
    now = table(spark, d, "orders").select(_KEY, F.when(k % 9 != 0, s).alias("status"), F.col("o_orderpriority").alias("priority"))
    before = table(spark, d, "orders").select(F.when(k % 4 == 0, -k).otherwise(k).alias(_KEY), s.alias("status"), F.when(k % 6 == 1, "old").otherwise(F.col("o_orderpriority")).alias("priority"))
    return schemas.review_report(now, [_KEY], before, ["status"]).select(_KEY, "status", "priority", "needs_review", "changed")


@query("""
WITH s AS (SELECT DISTINCT o_orderpriority AS cohort, CASE WHEN o_orderpriority = '5-LOW' THEN 1 + o_custkey % 2 ELSE o_custkey % 4 END AS grp FROM orders)
SELECT c.cohort, g.grp FROM (SELECT DISTINCT cohort FROM s) c CROSS JOIN (SELECT DISTINCT grp FROM s) g WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.cohort = c.cohort AND s.grp = g.grp)
""")
def coverage_missing_groups(spark, d):
    low = F.col("o_orderpriority") == "5-LOW"
    s = table(spark, d, "orders").select(F.col("o_orderpriority").alias("cohort"), F.when(low, 1 + F.col("o_custkey") % 2).otherwise(F.col("o_custkey") % 4).alias("grp"))
    return profile.missing_groups(s, "cohort", "grp")
