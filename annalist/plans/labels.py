"""Queries on labels, names and types of columns."""

from pyspark.sql import functions as F

from annalist.functions import codes, coerce, labels
from annalist.functions.classify import SCHOOL_TYPES, classify
from annalist.operators import clean, frames, profile
from annalist.plans.registry import query
from annalist.plans.tables import big, r4, table

_KEY = "o_orderkey"


def _choose(column: str, options: list):
    """A literal chosen by a key: options are texts in which {a} and {b} are two-digit numbers of the key."""
    k = F.col(column)
    out = None
    for i, text in enumerate(options):
        parts = text.replace("{a}", "\u0001a\u0001").replace("{b}", "\u0001b\u0001").replace("{g}", "\u0001g\u0001").split("\u0001")
        named = {"a": F.lpad((k % 9 + 10).cast("string"), 2, "0"), "b": F.lpad((k % 9 + 11).cast("string"), 2, "0"), "g": (k % 5 + 7).cast("string")}
        value = F.concat(*[named[p] if p in named else F.lit(p) for p in parts])
        out = (F.when if out is None else out.when)(k % len(options) == i, value)
    return out


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '20' || (o_orderkey % 9 + 10) || ' - 20' || (o_orderkey % 9 + 11) WHEN 1 THEN '20' || (o_orderkey % 9 + 10) || ' - 20' || (o_orderkey % 9 + 11) ELSE NULL END AS cohort,
       CASE WHEN o_orderkey % 4 = 2 THEN '20' || (o_orderkey % 9 + 10) || ' Mar' WHEN o_orderkey % 4 = 1 THEN '20' || (o_orderkey % 9 + 10) || ' - 20' || (o_orderkey % 9 + 11) END AS by_month
FROM orders
""")
def parse_cohort_label(spark, d):
    name = _choose(_KEY, ["Census 20{a}_{b} final.xlsx", "Data (Y11 20{b})", "Extract Mar {a}.csv", "no label"])
    return table(spark, d, "orders").select(_KEY, labels.cohort_label(name, "YYYY_YY").alias("cohort"), labels.cohort_label(name, "MMM YY").alias("by_month"))


@query("""
WITH t AS (SELECT o_orderkey, o_orderkey % 12 AS i, o_orderkey % 9 + 10 AS a, o_orderkey % 9 + 11 AS b, o_orderkey % 5 + 7 AS g FROM orders)
SELECT o_orderkey, CAST(CASE WHEN i IN (0, 1, 2, 3, 4, 5, 6, 7, 9, 10) THEN g WHEN i = 8 THEN 11 END AS INTEGER) AS year_group,
       CASE WHEN i IN (0, 1, 2, 4, 5, 6, 9) THEN g || ' 20' || a || ' - 20' || b WHEN i IN (3, 7) THEN g || ' ' || (1999 + a) || ' - 20' || a WHEN i = 8 THEN '11 20' || a || ' - 20' || b WHEN i = 10 THEN g || ' 2020 - 20' || a END AS label
FROM t
""")
def parse_year_group_rules(spark, d):
    name = _choose(_KEY, ["Y{g} 20{a}{b} Census", "AS Y{g} {a}{b} at 011119", "Y{g} 202122 Attendance {a}_{b}", "Y{g} 201819 Jan {a} Census", "Y10 in Y{g} (20{a}_{b})", "Susp of Y{g} ({a}_{b})", "20{a}_{b} (Y{g})", "in Y{g} (Jan {a} Census)", "All Susp {a}-{b}", "When Y{g} in 20{a}{b}", "Y{g} 20{a} Oct 23", "Sheet1"])
    got = labels.year_group(name)
    return table(spark, d, "orders").select(_KEY, got["year_group"].alias("year_group"), got["label"].alias("label"))


@query("""
WITH t AS (SELECT o_orderkey, o_orderkey % 4 AS i, CAST(o_orderkey % 5 + 7 AS INTEGER) AS g, 2000 + o_orderkey % 20 AS y FROM orders)
SELECT o_orderkey, CAST(CASE WHEN i = 2 THEN 9 ELSE CASE WHEN i = 3 THEN NULL ELSE g END END AS INTEGER) AS year_group,
       CASE WHEN i = 0 THEN 'Y' || g || ' ' || (y + g - 11) || ' - ' || (y + 1 + g - 11)
            WHEN i = 1 THEN CASE WHEN g = 11 THEN 'Y11 ' || y || ' - ' || (y + 1) ELSE 'Y' || g || ' ' || (y + g - 11) || ' - ' || (y + 1 + g - 11) END
            WHEN i = 2 THEN 'Y9 ' || (y - 2) || ' - ' || (y - 1) END AS label
FROM t
""")
def cohort_year_shift(spark, d):
    k = F.col(_KEY)
    i, y = k % 4, k % 20 + 2000
    group = F.when(i == 3, None).when(i == 2, 11).otherwise(k % 5 + 7).cast("int")
    text = lambda a: F.concat(a.cast("string"), F.lit(" - "), (a + 1).cast("string"))
    raw = F.when(i == 1, F.concat(F.lit("Y7 "), text(y))).when(i == 2, F.concat(F.lit("11 "), text(y - 2)))
    got = labels.curated_cohort(group, raw, text(y))
    return table(spark, d, "orders").select(_KEY, got["year_group"].alias("year_group"), got["label"].alias("label"))


@query("""
SELECT p_partkey, CASE WHEN p_name LIKE '%small%' AND (lower(p_type) LIKE '%promo%' OR lower(p_type) LIKE '%economy%') THEN 'EXCLUDE' WHEN p_name LIKE '%small%' OR lower(p_type) LIKE '%small%' THEN 'size'
  WHEN (p_name LIKE '%red%' OR p_name LIKE '%blue%' OR lower(p_type) LIKE '%red%' OR lower(p_type) LIKE '%blue%') AND p_name LIKE '%e%' THEN 'colour' WHEN p_name LIKE '%ring%' OR lower(p_type) LIKE '%ring%' OR lower(p_type) LIKE '%standard%' THEN 'kind' END AS category FROM part
""")
def first_matching_rule(spark, d):
    from annalist.sources.inventory import CategoryRule, ExcludeRule, categorise

    rules = [CategoryRule("size", ["small"]), CategoryRule("colour", ["Red", "Blue"], ["e"]), CategoryRule("kind", ["ring", "standard"])]
    name = F.concat(F.lit("ANON"), F.upper("p_name"))
    return table(spark, d, "part").select("p_partkey", categorise(name, F.col("p_type"), rules, [ExcludeRule("SMALL", ["promo", "economy"])]).alias("category"))


@query("SELECT DISTINCT l_orderkey, l_linenumber, n FROM (SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1")
def flag_duplicate_keys(spark, d):
    from annalist.operators.joins import duplicate_keys

    return duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT c_custkey, split_part(c_name, '#', 1) AS kind, split_part(c_name, '#', 2) AS number FROM customer")
def split_name_positions(spark, d):
    from annalist.sources.inventory import from_names

    names = table(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(".parquet")).alias("file_name"))
    return from_names(names, ["kind", "number"], "#").drop("file_name")


#: All orders; each group leaves out categories in some cohorts, by a mark or as excluded.
_GAP = "(o_orderkey % 7 + year(o_orderdate)) % 3"
_SHEETS = f"(SELECT * FROM (SELECT o_orderkey % 7 AS grp, year(o_orderdate) AS cohort, CASE WHEN {_GAP} = 0 AND o_orderpriority = '5-LOW' THEN '~' || o_orderpriority WHEN {_GAP} = 1 AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'EXCLUDE' ELSE o_orderpriority END AS cat FROM orders) WHERE cat <> 'EXCLUDE' AND cat NOT LIKE '~%')"


def _sheets(spark, d):
    y, p = F.year("o_orderdate"), F.col("o_orderpriority")
    gap = (F.col(_KEY) % 7 + y) % 3
    cat = F.when((gap == 0) & (p == "5-LOW"), F.concat(F.lit("~"), p)).when((gap == 1) & p.isin("1-URGENT", "2-HIGH"), "EXCLUDE").otherwise(p)
    return table(spark, d, "orders").select((F.col(_KEY) % 7).alias("grp"), big(y).alias("cohort"), cat.alias("cat"))


@query(f"SELECT grp, cohort, string_agg(DISTINCT cat, ', ' ORDER BY cat) AS existing FROM {_SHEETS} GROUP BY grp, cohort")
def coverage_existing(spark, d):
    return profile.existing_categories(_sheets(spark, d), ["grp", "cohort"], "cat")


_MISSING = f"""SELECT g.grp, g.cohort, c.cat FROM (SELECT DISTINCT grp, cohort FROM {_SHEETS}) g JOIN (SELECT DISTINCT grp, cat FROM {_SHEETS}) c ON g.grp = c.grp
WHERE NOT EXISTS (SELECT 1 FROM {_SHEETS} s WHERE s.grp = g.grp AND s.cohort = g.cohort AND s.cat = c.cat)"""


@query(_MISSING)
def coverage_missing_anti(spark, d):
    return profile.missing_categories(_sheets(spark, d), ["grp"], "cohort", "cat")


@query(f"""
WITH e AS (SELECT grp, cohort, string_agg(DISTINCT cat, ', ' ORDER BY cat) AS existing, count(DISTINCT cat) AS n_existing FROM {_SHEETS} GROUP BY grp, cohort),
m AS (SELECT grp, cohort, string_agg(cat, ', ' ORDER BY cat) AS missing FROM ({_MISSING}) GROUP BY grp, cohort)
SELECT e.grp, e.cohort, existing, n_existing, missing FROM e LEFT JOIN m ON e.grp = m.grp AND e.cohort = m.cohort
""")
def coverage_full_report(spark, d):
    return profile.coverage_report(_sheets(spark, d), ["grp"], "cohort", "cat")


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN lower(p_type) || '_Name' || split_part(p_name, ' ', 1) || '_Id' WHEN 1 THEN 'already_Done' WHEN 2 THEN p_type ELSE 'X_' || split_part(p_name, ' ', 2) END AS snake,
       length(regexp_replace(n, '[^A-Z]', '', 'g')) >= 2 AND length(regexp_replace(n, '[^a-z]', '', 'g')) >= 2 AND NOT regexp_matches(n, '\\s') AS is_mixed
FROM (SELECT *, CASE p_partkey % 4 WHEN 0 THEN lower(p_type) || 'Name' || split_part(p_name, ' ', 1) || 'Id' WHEN 1 THEN 'already_Done' WHEN 2 THEN p_type ELSE 'X_' || split_part(p_name, ' ', 2) END AS n FROM part)
""")
def snake_case_regex(spark, d):
    word = lambda i: F.split("p_name", " ")[i]
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, F.concat(F.lower("p_type"), F.lit("Name"), word(0), F.lit("Id"))).when(k == 1, "already_Done").when(k == 2, F.col("p_type")).otherwise(F.concat(F.lit("X_"), word(1)))
    return table(spark, d, "part").select("p_partkey", labels.snake_case(name).alias("snake"), labels.is_mixed_case(name).alias("is_mixed"))


@query("SELECT c_custkey, length(regexp_replace(n, '[^A-Z]', '', 'g')) >= 2 AND length(regexp_replace(n, '[^a-z]', '', 'g')) >= 2 AND NOT regexp_matches(n, '\\s') AS is_mixed FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || 'XyZ' WHEN 1 THEN c_mktsegment ELSE c_name || ' AB' END AS n FROM customer)")
def mixed_case_predicate(spark, d):
    k = F.col("c_custkey") % 3
    name = F.when(k == 0, F.concat("c_name", F.lit("XyZ"))).when(k == 1, F.col("c_mktsegment")).otherwise(F.concat("c_name", F.lit(" AB")))
    return table(spark, d, "customer").select("c_custkey", labels.is_mixed_case(name).alias("is_mixed"))


@query("SELECT p_partkey, replace(p_name, ' ', '-') || '_' || p_type || '_Y' || p_size || '.parquet' AS file_name FROM part")
def build_standard_name(spark, d):
    return table(spark, d, "part").select("p_partkey", labels.standard_file_name([F.col("p_name"), F.col("p_type")], F.col("p_size")).alias("file_name"))


@query("SELECT c_custkey, c_name AS cust_c_name, c_nationkey AS cust_c_nationkey, c_acctbal AS cust_c_acctbal, c_mktsegment AS cust_c_mktsegment FROM customer")
def prefix_projection(spark, d):
    return frames.prefixed(table(spark, d, "customer"), "cust", ("c_custkey",))


@query("""
WITH v AS (SELECT 'c_mktsegment' AS column_name, c_mktsegment AS value FROM customer UNION SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY value) AS r, count(*) OVER (PARTITION BY column_name) AS n_unique FROM v)
SELECT column_name, n_unique, string_agg(value, '|' ORDER BY value) AS samples FROM r WHERE r <= 10 GROUP BY column_name, n_unique
""")
def column_profile_long(spark, d):
    return profile.column_profile(table(spark, d, "customer"), ["c_mktsegment", "c_nationkey"])


@query("""
SELECT n.n_nationkey, CASE WHEN n.n_nationkey % 2 = 0 THEN 'same' ELSE 'a' || n.n_nationkey || ' / b' || n.n_nationkey END AS description, n.n_nationkey % 2 = 0 AS collapsed FROM nation n
""")
def multi_source_lookup_collapse(spark, d):
    n = table(spark, d, "nation").select("n_nationkey")
    even = F.col("n_nationkey") % 2 == 0
    source = lambda x: n.select("n_nationkey", F.when(even, "same").otherwise(F.concat(F.lit(x), "n_nationkey")).alias("told"), F.lit(1).alias("row"))
    found = labels.lookup_texts(n, {"a": source("a"), "b": source("b")}, "n_nationkey", "told")
    return found.select("n_nationkey", F.col("text").alias("description"), F.col("agrees").alias("collapsed"))


@query("""
SELECT column_name, count(DISTINCT v) > 1 AND min(CASE WHEN lower(v) IN ('0', '1', 'true', 'false', 'yes', 'no', 'y', 'n') THEN 1 ELSE 0 END) = 1 AS is_boolean FROM (
  SELECT 'flag' AS column_name, CAST(c_custkey % 2 AS VARCHAR) AS v FROM customer UNION ALL SELECT 'name', c_name FROM customer UNION ALL SELECT 'word', CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'no' END FROM customer
) GROUP BY column_name
""")
def infer_boolean_columns(spark, d):
    df = table(spark, d, "customer").select((F.col("c_custkey") % 2).cast("string").alias("flag"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 == 0, "Yes").otherwise("no").alias("word"))
    return profile.boolean_columns(df, df.columns)


@query("""
WITH v AS (SELECT DISTINCT c_nationkey, coalesce(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END, 'Missing') AS m FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY m) AS r, count(*) OVER (PARTITION BY c_nationkey) AS n FROM v)
SELECT c_nationkey, string_agg(m, ', ' ORDER BY m) || CASE WHEN max(n) > 3 THEN ', ...' ELSE '' END AS sample FROM r WHERE r <= 3 GROUP BY c_nationkey
""")
def sample_uniques_string(spark, d):
    df = table(spark, d, "customer").withColumn("m", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")))
    return df.groupBy("c_nationkey").agg(profile.sample_text(F.collect_set(F.coalesce("m", F.lit("Missing"))), 3).alias("sample"))


@query("SELECT 'o_custkey' AS from_col, 'o_totalprice' AS to_col, count(CASE WHEN o_orderkey % 3 <> 0 THEN 1 END) AS n_from, count(CASE WHEN o_orderkey % 4 <> 0 THEN 1 END) AS n_to FROM orders")
def pair_nonnull_counts(spark, d):
    k = F.col(_KEY)
    df = table(spark, d, "orders").select(F.when(k % 3 != 0, F.col("o_custkey")).alias("o_custkey"), F.when(k % 4 != 0, F.col("o_totalprice")).alias("o_totalprice"))
    return profile.pair_counts(df, {"o_custkey": "o_totalprice"})


# ---- types

@query("""
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 11 = 5 THEN NULL WHEN o_orderkey % 11 IN (3, 8, 9) THEN date_trunc('month', o_orderdate) ELSE o_orderdate END AS DATE) AS parsed FROM orders
""")
def parse_mixed_dates(spark, d):
    o, k = F.col("o_orderdate"), F.col(_KEY) % 11
    text = F.when(k == 0, F.date_format(o, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.date_format(o, "dd/MM/yyyy")).when(k == 2, F.date_format(o, "yyyy-MM-dd HH:mm:ss")).when(k == 3, F.date_format(o, "MMM-yy")).when(k == 4, F.date_format(o, "M-d-yyyy")).when(k == 5, "not a date")
    for i, form in ((6, "yyyy/MM/dd"), (7, "dd-MMM-yyyy"), (8, "MMMM yyyy"), (9, "yyyy-MM"), (10, "MMMM d, yyyy")):
        text = text.when(k == i, F.date_format(o, form))
    return table(spark, d, "orders").select(_KEY, coerce.date(text).alias("parsed"))


@query("SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE END AS flag, o_orderkey % 6 = 5 AS is_unknown FROM orders")
def coerce_boolean(spark, d):
    k = F.col(_KEY) % 6
    text = F.when(k == 0, " Yes ").when(k == 1, "n").when(k == 2, "1.0").when(k == 3, "FALSE").when(k == 4, "N/A").otherwise("maybe")
    return table(spark, d, "orders").select(_KEY, coerce.boolean(text).alias("flag"), coerce.is_unknown_boolean(text).alias("is_unknown"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders")
def coerce_numeric(spark, d):
    text = F.when(F.col(_KEY) % 3 == 0, "n.a.").otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string")))
    return table(spark, d, "orders").select(_KEY, coerce.numeric(text).alias("price"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'White-British O''Neil' WHEN 1 THEN 'wbri' WHEN 2 THEN CAST(p_size AS VARCHAR) WHEN 3 THEN NULL ELSE p_type END AS label FROM part")
def normalise_category(spark, d):
    k = F.col("p_partkey") % 5
    text = F.when(k == 0, "white-british o'neil").when(k == 1, " wbri ").when(k == 2, F.concat(F.col("p_size").cast("string"), F.lit(".0"))).when(k == 3, " n/a ").otherwise(F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", coerce.category(text).alias("label"))


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text FROM part")
def strip_dot_zero(spark, d):
    return table(spark, d, "part").select("p_partkey", coerce.coerce(F.concat(F.col("p_size").cast("string"), F.lit(".0")), "string").alias("size_text"))


@query("""
SELECT 'price' AS column_name, count(CASE WHEN o_orderkey % 3 = 0 THEN 1 END) AS became_null, CAST(0 AS BIGINT) AS became_value FROM orders
UNION ALL SELECT 'status', CAST(0 AS BIGINT), count(CASE WHEN o_orderkey % 7 = 0 THEN 1 END) FROM orders
""")
def coercion_audit(spark, d):
    k = F.col(_KEY)
    text = F.when(k % 3 == 0, "n.a.").otherwise(F.col("o_totalprice").cast("string"))
    status = F.when(k % 7 != 0, F.col("o_orderstatus"))
    return profile.coercion_audit(table(spark, d, "orders"), {"price": (text, coerce.numeric(text)), "status": (status, F.coalesce(status, F.lit("U")))})


@query("SELECT l_orderkey, l_linenumber, round(l_discount * 100, 2) AS discount_pct, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL")
def percent_normalise(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.col("l_discount").cast("string"), F.lit("%")).alias("discount_pct"))
    return profile.scale_percents(df, ["discount_pct"]).groupBy("l_orderkey", "l_linenumber", "discount_pct").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, round(p_size / 100.0, 2) AS size_rate, p_partkey % 2 / 4.0 AS half_rate FROM part")
def rate_normalise(spark, d):
    df = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("size_rate"), ((F.col("p_partkey") % 2) / 4).alias("half_rate"))
    return profile.scale_rates(df, ["size_rate", "half_rate"])


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Final' END AS label, CASE WHEN o_orderkey % 3 = 0 THEN 'Education' WHEN o_orderkey % 3 = 1 THEN 'Employment' END AS level FROM orders")
def code_to_label(spark, d):
    k = F.col(_KEY) % 3
    code = F.when(k == 0, 260).when(k == 1, 550).otherwise(999)
    return table(spark, d, "orders").select(_KEY, codes.label(F.col("o_orderstatus"), {"O": "Open", "F": "Final"}).alias("label"), codes.activity_level(code).alias("level"))


@query("SELECT 'l_discount' AS column_name, count(CASE WHEN l_discount > 0.05 THEN 1 END) AS n_bad FROM lineitem UNION ALL SELECT 'l_quantity', count(CASE WHEN l_quantity < 5 THEN 1 END) FROM lineitem")
def range_violations(spark, d):
    return profile.out_of_range(table(spark, d, "lineitem"), {"l_discount": (0, 0.05), "l_quantity": (5, 1e9)})


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 0 END AS phase_num FROM orders")
def phase_ordinal(spark, d):
    return table(spark, d, "orders").select(_KEY, clean.recode(F.col("o_orderstatus"), {"O": "1", "P": "2", "F": "0"}).cast("int").alias("phase_num"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) + 1 AS INTEGER) AS end_year FROM orders")
def end_year_extract(spark, d):
    y = F.year("o_orderdate")
    return table(spark, d, "orders").select(_KEY, labels.end_year(F.concat(F.lit(" "), y.cast("string"), F.lit("-"), (y + 1).cast("string"), F.lit(" "))).alias("end_year"))


@query("SELECT o_orderkey, (year(o_orderdate) + o_orderkey % 5 - 4) || '-' || (year(o_orderdate) + o_orderkey % 5 - 3) AS acad_year FROM orders")
def academic_year_label(spark, d):
    return table(spark, d, "orders").select(_KEY, labels.academic_year(F.year("o_orderdate"), F.col(_KEY) % 5 + 7).alias("acad_year"))


@query("""
SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'Community School' WHEN 1 THEN 'Academy - Converter Special' WHEN 2 THEN 'Academy - Alternative Provision' WHEN 3 THEN 'Free School - 16-19'
  WHEN 4 THEN 'Voluntary Aided School' WHEN 5 THEN 'Further Education College' WHEN 6 THEN 'Non-Maintained Special School' ELSE p_type END AS school_type FROM part
""")
def ordered_keyword_classifier(spark, d):
    k = F.col("p_partkey") % 8
    texts = ["CY", "Special Academy_converter", "academy AP", "free-schools 16 to 19", "Voluntary  Aided", "General further education college", "Non-maintained special school"]
    text = None
    for i, t in enumerate(texts):
        text = (F.when if text is None else text.when)(k == i, t)
    return table(spark, d, "part").select("p_partkey", classify(text.otherwise(F.concat(F.lit(" "), "p_type")), SCHOOL_TYPES).alias("school_type"))


@query("SELECT c_custkey, substring(c_name, 1, 3) AS head, substring(c_name, 4) AS tail FROM customer")
def split_fixed_width(spark, d):
    from annalist.operators.derive import split_fixed

    head, tail = split_fixed(F.col("c_name"), 3)
    return table(spark, d, "customer").select("c_custkey", head.alias("head"), tail.alias("tail"))


# ---- functions

@query("""
SELECT p_partkey, lower(p_type) AS lo, upper(p_name) AS up, trim('  ' || p_name || ' ') AS tr, replace(p_name, ' ', '-') AS rep, contains(p_name, 'red') AS has, starts_with(p_type, 'E') AS st, ends_with(p_name, 'ring') AS en,
       split_part(p_name, ' ', 2) AS second, substring(p_brand, 7) AS num, rtrim(p_brand || '%%', '%') AS bare, p_type || '/' || p_brand AS joined FROM part
""")
def string_function_suite(spark, d):
    c = F.col
    return table(spark, d, "part").select(
        "p_partkey", F.lower("p_type").alias("lo"), F.upper("p_name").alias("up"), F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("tr"), F.regexp_replace("p_name", " ", "-").alias("rep"), c("p_name").contains("red").alias("has"), c("p_type").startswith("E").alias("st"), c("p_name").endswith("ring").alias("en"),
        F.split("p_name", " ")[1].alias("second"), F.substring("p_brand", 7, 100).alias("num"), F.rtrim(F.concat("p_brand", F.lit("%%")), F.lit("%")).alias("bare"), F.concat_ws("/", "p_type", "p_brand").alias("joined"),
    )


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) AS days, round(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') / 365.25, 4) AS age, strftime(o_orderdate, '%d/%m/%Y') AS txt FROM orders
""")
def date_function_suite(spark, d):
    o, end = F.col("o_orderdate"), F.lit("2002-01-01").cast("date")
    days = F.datediff(end, o)
    return table(spark, d, "orders").select(_KEY, F.year(o).alias("y"), F.month(o).alias("m"), days.alias("days"), r4(days / 365.25).alias("age"), F.date_format(o, "dd/MM/yyyy").alias("txt"))


@query("SELECT o_orderkey, round(abs(o_totalprice - 250000), 2) AS dist, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE round(o_totalprice / (o_orderkey % 4), 4) END AS share, CAST(o_orderkey % 7 AS BIGINT) AS m FROM orders")
def math_function_suite(spark, d):
    k = F.col(_KEY)
    return table(spark, d, "orders").select(_KEY, F.round(F.abs(F.col("o_totalprice") - 250000), 2).alias("dist"), r4(F.try_divide(F.col("o_totalprice"), (k % 4).cast("double"))).alias("share"), (k % 7).alias("m"))


@query("""
WITH t AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS a, list_sort(list_distinct(list(event_type) FILTER (event_id % 3 = 0))) AS b FROM events GROUP BY user_id)
SELECT user_id, array_to_string(a, '|') AS all_types, CAST(len(a) AS BIGINT) AS n, coalesce(array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(coalesce(b, []), x))), '|'), '') AS only_a FROM t
""")
def array_function_suite(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("a"), F.collect_set(F.when(F.col("event_id") % 3 == 0, F.col("event_type"))).alias("b"))
    return g.select("user_id", F.array_join("a", "|").alias("all_types"), big(F.size("a")).alias("n"), F.array_join(F.array_sort(F.array_except("a", "b")), "|").alias("only_a"))


@query("SELECT o_orderkey, coalesce(s, 'none') AS filled, s IS NULL AS missing, CASE WHEN s = 'F' THEN 1 ELSE 0 END AS final FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS s FROM orders)")
def null_function_suite(spark, d):
    s = F.when(F.col(_KEY) % 3 != 0, F.col("o_orderstatus"))
    return table(spark, d, "orders").select(_KEY, F.coalesce(s, F.lit("none")).alias("filled"), s.isNull().alias("missing"), F.when(s == "F", 1).otherwise(0).alias("final"))
