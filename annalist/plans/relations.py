"""Queries on joins and aggregations."""

from pyspark.sql import functions as F

from annalist.functions import coerce
from annalist.operators import aggregate, derive, joins, resolve
from annalist.operators.frames import first_per_group
from annalist.plans.registry import query
from annalist.plans.tables import LINE_ORDER, LINE_SQL, big, r4, table

_KEY = "o_orderkey"
_L = ["l_orderkey", "l_linenumber"]


def _null_every(column, n, key=_KEY):
    return F.when(F.col(key) % n != 0, F.col(column) if isinstance(column, str) else column)


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE ' ' || o_custkey || '.0' END AS k FROM orders), c AS (SELECT CASE WHEN c_custkey = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS k, c_mktsegment FROM customer)
SELECT o_orderkey, c.c_mktsegment AS seg FROM o LEFT JOIN c ON regexp_replace(trim(o.k), '\\.0$', '') IS NOT DISTINCT FROM c.k
""")
def left_join_normalised_keys(spark, d):
    o = table(spark, d, "orders").select(_KEY, F.when(F.col("o_custkey") % 9 != 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(".0"))).alias("k"))
    c = table(spark, d, "customer").select(F.when(F.col("c_custkey") != 0, F.col("c_custkey").cast("string")).alias("ck"), "c_mktsegment")
    return joins.lookup(o, c, [F.col("k")], [F.col("ck")], {"c_mktsegment": "seg"}).select(_KEY, "seg")


def _by_nation_year(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("end_year")).agg(F.count("*").alias("n_orders"))


_REF = "(SELECT c_nationkey AS nation, year(o_orderdate) AS end_year, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"
_BASE = "(SELECT o_orderkey, c_nationkey AS nation, c_nationkey % 5 AS other, year(o_orderdate) AS y FROM orders JOIN customer ON o_custkey = c_custkey)"


def _base(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.select(_KEY, F.col("c_nationkey").alias("nation"), (F.col("c_nationkey") % 5).alias("other"), F.year("o_orderdate").alias("y"))


@query(f"SELECT b.o_orderkey, b.y, r.n_orders AS att_n_orders_lag1 FROM {_BASE} b LEFT JOIN {_REF} r ON b.nation = r.nation AND b.y = r.end_year + 1")
def lagged_lookup_join(spark, d):
    return joins.lagged_lookup(_base(spark, d), _by_nation_year(spark, d), {"nation": "nation"}, "y", "end_year", 1, "att").select(_KEY, big("y").alias("y"), "att_n_orders_lag1")


@query(f"""
SELECT b.o_orderkey, r.n_orders AS att_n_orders_lag1, s.n_orders AS ks_n_orders_lag0 FROM {_BASE} b LEFT JOIN {_REF} r ON b.nation = r.nation AND b.y = r.end_year + 1 LEFT JOIN {_REF} s ON b.other = s.nation AND b.y = s.end_year
""")
def lagged_lookup_multi_ref(spark, d):
    return joins.lagged_lookups(_base(spark, d), _by_nation_year(spark, d), {"att": ({"nation": "nation"}, 1), "ks": ({"other": "nation"}, 0)}, "y", "end_year").select(_KEY, "att_n_orders_lag1", "ks_n_orders_lag0")


@query(f"SELECT CAST(1 AS BIGINT) AS lag, count(*) AS n FROM {_BASE} b JOIN {_REF} r ON b.nation = r.nation AND b.y = r.end_year + 1")
def lag_verification(spark, d):
    ref = _by_nation_year(spark, d).withColumn("from_year", F.col("end_year"))
    found = joins.lagged_lookup(_base(spark, d), ref, {"nation": "nation"}, "y", "end_year", 1, "att")
    return joins.year_differences(found, "y", "att_from_year_lag1")


@query("SELECT c_custkey, n_name AS nation, r_name AS region FROM customer LEFT JOIN (SELECT CASE WHEN n_nationkey % 6 <> 5 THEN n_nationkey END AS n_nationkey, n_name, n_regionkey FROM nation) ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def two_hop_lookup(spark, d):
    n, r = table(spark, d, "nation").withColumn("n_nationkey", F.when(F.col("n_nationkey") % 6 != 5, F.col("n_nationkey"))), table(spark, d, "region")
    c = table(spark, d, "customer")
    hop = joins.two_hop(c, n, r, F.col("c_nationkey"), "n_nationkey", "n_regionkey", "r_regionkey", {"r_name": "region"}, ["n_name"])
    return joins.lookup(hop, n.dropna(), [F.col("c_nationkey")], [F.col("n_nationkey")], {"n_name": "nation"}).select("c_custkey", "nation", "region")


@query("""
WITH l AS (SELECT s_nationkey, s_name FROM (SELECT s_nationkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) AS r FROM supplier) WHERE r = 1)
SELECT c_custkey, s_name FROM customer LEFT JOIN l ON c_nationkey = s_nationkey
""")
def lookup_last_wins(spark, d):
    last = joins.last_wins(table(spark, d, "supplier"), ["s_nationkey"], ["s_suppkey"])
    return table(spark, d, "customer").join(last, F.col("c_nationkey") == F.col("s_nationkey"), "left").select("c_custkey", "s_name")


_LEFT = "(SELECT o_custkey AS id, o_orderstatus AS a1, 'The ' || o_orderpriority AS a2 FROM orders)"
_RIGHT = "(SELECT o_custkey AS id, CASE WHEN o_orderkey % 5 = 1 THEN o_orderpriority END AS b1, CASE WHEN o_orderkey % 5 < 2 THEN o_orderstatus END AS b2 FROM orders)"


def _sides(spark, d):
    o = table(spark, d, "orders")
    left, k = o.select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("a1"), F.concat(F.lit("The "), "o_orderpriority").alias("a2")), F.col(_KEY) % 5
    return left, o.select(F.col("o_custkey").alias("id"), F.when(k == 1, F.col("o_orderpriority")).alias("b1"), F.when(k < 2, F.col("o_orderstatus")).alias("b2"))


@query(f"""
WITH l AS (SELECT id, 'a1' AS left_key, lower(a1) AS v FROM {_LEFT} UNION ALL SELECT id, 'a2', lower(substring(a2, 5)) FROM {_LEFT}), r AS (SELECT id, 'b1' AS right_key, lower(b1) AS v FROM {_RIGHT} UNION ALL SELECT id, 'b2', lower(b2) FROM {_RIGHT})
SELECT left_key, right_key, count(*) AS n FROM l JOIN r ON l.id = r.id AND l.v = r.v GROUP BY left_key, right_key
""")
def best_key_match_counts(spark, d):
    return joins.key_matches(*_sides(spark, d), "id", ["a1", "a2"], ["b1", "b2"])


@query("""
WITH a AS (SELECT o_custkey AS id, count(*) AS n_f FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS id, c_mktsegment AS seg FROM customer)
SELECT coalesce(a.id, b.id) AS id, n_f, seg FROM a FULL JOIN b ON a.id = b.id
""")
def full_outer_on_id(spark, d):
    a = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n_f"))
    k = F.col("c_custkey")
    b = table(spark, d, "customer").select(F.when(k % 3 == 0, -k).otherwise(k).alias("id"), F.col("c_mktsegment").alias("seg"))
    return joins.best_key_join(a, b, "id")


_VISITS = "(SELECT o_custkey AS id, 'The ' || o_orderpriority AS att_school, o_orderstatus AS att_school_code, count(*) AS att_n FROM orders GROUP BY ALL)"
_MARKS = "(SELECT o_custkey AS id, lower(o_orderpriority) AS ks2_estab, max(o_totalprice) AS ks2_top, 'x' AS ks2_stage FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL)"


@query(f"""
SELECT coalesce(a.id, b.id) AS id, att_school, att_school_code, att_n, ks2_estab, ks2_top, ks2_stage FROM {_VISITS} a FULL JOIN {_MARKS} b ON a.id = b.id AND lower(substring(att_school, 5)) = ks2_estab
""")
def best_key_full_join(spark, d):
    o, id_ = table(spark, d, "orders"), F.col("o_custkey").alias("id")
    a = o.groupBy(id_, F.concat(F.lit("The "), "o_orderpriority").alias("att_school"), F.col("o_orderstatus").alias("att_school_code")).agg(F.count("*").alias("att_n"))
    b = o.where("o_orderstatus <> 'P'").groupBy(id_, F.lower("o_orderpriority").alias("ks2_estab")).agg(F.max("o_totalprice").alias("ks2_top")).withColumn("ks2_stage", F.lit("x"))
    return joins.best_key_join(a, b, "id")


@query("""
WITH o AS (SELECT o_custkey AS id, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders), c AS (SELECT c_custkey AS id, c_acctbal FROM customer)
SELECT coalesce(o.id, c.id) AS id, o_orderkey, c_acctbal FROM (SELECT * FROM o WHERE r = 1) o FULL JOIN c ON o.id = c.id UNION ALL SELECT id, o_orderkey, NULL FROM o WHERE r > 1
""")
def attach_to_first_row(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), _KEY)
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    return joins.attach_to_first(o, c, ["id"], [_KEY])


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE lower(p_name) END AS name FROM part")
def normalise_name_key(spark, d):
    text = F.when(F.col("p_partkey") % 5 == 0, " N/A ").otherwise(F.concat(F.lit(" The  "), "p_name", F.lit(" ")))
    return table(spark, d, "part").select("p_partkey", coerce.normalise_name(text).alias("name"))


@query("SELECT c_custkey, t.target FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS target FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) = 2000 GROUP BY 1) t ON c_custkey = o_custkey")
def attach_target_left(spark, d):
    t = table(spark, d, "orders").where((F.col("o_orderstatus") == "F") & (F.year("o_orderdate") == 2000)).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("target"))
    return joins.null_safe_join(table(spark, d, "customer").select("c_custkey"), t, ["c_custkey"])


_FACTS = "(SELECT o_custkey AS id, year(o_orderdate) - 1980 AS age, CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 2 END AS half, max(o_totalprice) AS v FROM orders GROUP BY ALL)"


def _phases(spark, d, left_until):
    o = table(spark, d, "orders")
    facts = o.groupBy(F.col("o_custkey").alias("id"), (F.year("o_orderdate") - 1980).alias("age"), F.when(F.month("o_orderdate") < 7, 1).otherwise(2).alias("half")).agg(F.max("o_totalprice").alias("v"))
    base = joins.expand_groups(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), 10, 16, "group")
    return joins.two_phase_targets(base, facts, "id", "age", "half", "v", 5, 15, 21, left_until)


_PHASES = f"""
WITH f AS {_FACTS}, b AS (SELECT c_custkey AS id, unnest(range(10, 17)) AS "group" FROM customer), p AS (SELECT *, "group" + 5 AS age, unnest(['pre', 'post']) AS phase FROM b),
j AS (SELECT p.id, p."group", p.age, p.phase, f.v AS feature, t.v AS target FROM p LEFT JOIN f ON f.id = p.id AND f.age = p.age AND f.half = CASE p.phase WHEN 'pre' THEN 1 ELSE 2 END
      LEFT JOIN f t ON t.id = p.id AND t.half = CASE p.phase WHEN 'pre' THEN 2 ELSE 1 END AND t.age = CASE p.phase WHEN 'pre' THEN p.age ELSE p.age + 1 END),
s AS (SELECT age, phase FROM j GROUP BY age, phase HAVING count(feature) > 0 AND EXISTS (SELECT 1 FROM f WHERE f.half = CASE phase WHEN 'pre' THEN 2 ELSE 1 END AND f.age = CASE phase WHEN 'pre' THEN j.age ELSE j.age + 1 END))
SELECT j.id, CAST(j."group" AS BIGINT) AS "group", CAST(j.age AS BIGINT) AS age, j.phase, feature, target FROM j JOIN s ON j.age = s.age AND j.phase = s.phase WHERE j.age <= {{}} OR feature IS NOT NULL
"""


@query(_PHASES.format(17))
def two_phase_train_target(spark, d):
    return _phases(spark, d, 17).withColumns({"group": big("group"), "age": big("age")})


@query(_PHASES.format(0))
def conditional_left_inner(spark, d):
    return _phases(spark, d, 0).withColumns({"group": big("group"), "age": big("age")})


@query("SELECT r_regionkey, CAST(unnest(range(7, 12)) AS INTEGER) AS year_group FROM region")
def explode_year_groups(spark, d):
    return joins.expand_groups(table(spark, d, "region").select("r_regionkey"), 7, 11)


def _three(spark, d):
    o = table(spark, d, "orders")
    one = lambda status, m: o.where(F.col("o_orderstatus") == status).groupBy(F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("id")).agg(F.max("o_totalprice").alias("top"), F.count("*").alias(m))
    return [one("F", "n_f"), one("O", "n_o"), one("P", "n_p")]


def _three_sql(s):
    return f"(SELECT CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS id, max(o_totalprice) AS top, count(*) AS n FROM orders WHERE o_orderstatus = '{s}' GROUP BY 1)"


@query(f"""
SELECT k.id, coalesce(f.top, o.top, p.top) AS top, f.n AS n_f, o.n AS n_o, p.n AS n_p FROM (SELECT id FROM {_three_sql('F')} UNION SELECT id FROM {_three_sql('O')} UNION SELECT id FROM {_three_sql('P')}) k
LEFT JOIN {_three_sql('F')} f ON k.id IS NOT DISTINCT FROM f.id LEFT JOIN {_three_sql('O')} o ON k.id IS NOT DISTINCT FROM o.id LEFT JOIN {_three_sql('P')} p ON k.id IS NOT DISTINCT FROM p.id
""")
def full_outer_coalesce(spark, d):
    return joins.outer_coalesce(_three(spark, d), ["id"])


@query(f"""
SELECT k.id, f.n AS n_f, o.n AS n_o, p.n AS n_p FROM (SELECT id FROM {_three_sql('F')} UNION SELECT id FROM {_three_sql('O')} UNION SELECT id FROM {_three_sql('P')}) k
LEFT JOIN {_three_sql('F')} f ON k.id IS NOT DISTINCT FROM f.id LEFT JOIN {_three_sql('O')} o ON k.id IS NOT DISTINCT FROM o.id LEFT JOIN {_three_sql('P')} p ON k.id IS NOT DISTINCT FROM p.id
""")
def reduce_full_outer(spark, d):
    return joins.outer_coalesce([f.drop("top") for f in _three(spark, d)], ["id"])


@query(f"SELECT c.id, f.n AS n_f, o.n AS n_o, p.n AS n_p FROM (SELECT c_custkey AS id FROM customer UNION ALL SELECT NULL) c LEFT JOIN {_three_sql('F')} f ON c.id IS NOT DISTINCT FROM f.id LEFT JOIN {_three_sql('O')} o ON c.id IS NOT DISTINCT FROM o.id LEFT JOIN {_three_sql('P')} p ON c.id IS NOT DISTINCT FROM p.id")
def reduce_left_joins(spark, d):
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("id")).union(spark.range(1).select(F.lit(None).cast("bigint").alias("id")))
    return joins.left_joins(base, [f.drop("top") for f in _three(spark, d)], ["id"])


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '5-LOW' THEN 'low' END AS level FROM orders")
def map_code_labels(spark, d):
    codes = spark.createDataFrame([("1-URGENT", "high"), ("2-HIGH", "high"), ("5-LOW", "low")], "code string, level string")
    return joins.lookup(table(spark, d, "orders"), codes, [F.col("o_orderpriority")], [F.col("code")], {"level": "level"}).select(_KEY, "level")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def semi_join_members(spark, d):
    c = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.null_safe_join(table(spark, d, "orders").select(_KEY, "o_custkey"), c, ["o_custkey"], "left_semi").select(_KEY)


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def anti_join_members(spark, d):
    c = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.null_safe_join(table(spark, d, "orders").select(_KEY, "o_custkey"), c, ["o_custkey"], "left_anti").select(_KEY)


# ---- aggregations

@query("""
WITH v AS (SELECT o_custkey, o_orderstatus AS v FROM orders WHERE o_orderkey % 4 <> 0 UNION SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 3 = 0)
SELECT o_custkey, array_to_string(list_sort(list(v)), '|') AS vals FROM v GROUP BY o_custkey
""")
def collapse_to_sorted_array(spark, d):
    o = table(spark, d, "orders").select("o_custkey", _null_every("o_orderstatus", 4).alias("a"), F.when(F.col(_KEY) % 3 == 0, F.concat(F.lit(" "), "o_orderpriority")).otherwise(" ").alias("b"))
    return aggregate.collapse(o, ["o_custkey"], ["a", "b"], "vals").withColumn("vals", F.array_join("vals", "|"))


@query(f"""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_SQL}) AS r FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN count(DISTINCT l_discount) > 1 THEN round(avg(l_discount), 4) ELSE max(CASE WHEN r = 1 THEN l_discount END) END AS l_discount,
       CASE WHEN count(DISTINCT l_quantity) > 1 THEN sum(l_quantity) ELSE max(CASE WHEN r = 1 THEN l_quantity END) END AS l_quantity,
       CASE WHEN count(DISTINCT l_returnflag) > 1 THEN string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) ELSE max(CASE WHEN r = 1 THEN l_returnflag END) END AS l_returnflag
FROM l GROUP BY l_orderkey, l_linenumber
""")
def typed_duplicate_aggregation(spark, d):
    return aggregate.typed_duplicates(table(spark, d, "lineitem"), _L, ["l_discount"], ["l_quantity"], ["l_returnflag"], LINE_ORDER).withColumn("l_discount", r4("l_discount"))


@query("""
SELECT l_orderkey, CAST(round(((CASE WHEN count(DISTINCT l_returnflag) = 1 THEN 1 ELSE 0 END) + (CASE WHEN count(DISTINCT l_linestatus) = 1 THEN 1 ELSE 0 END) + (CASE WHEN count(DISTINCT l_tax) = 1 THEN 1 ELSE 0 END)) / 3.0, 4) AS DOUBLE) AS ratio FROM lineitem GROUP BY 1
""")
def similarity_ratio_report(spark, d):
    return aggregate.similarity_report(table(spark, d, "lineitem"), ["l_orderkey"], ["l_returnflag", "l_linestatus", "l_tax"]).withColumn("ratio", r4("ratio"))


@query("""
SELECT o_custkey, o_orderstatus AS a, max(CASE WHEN o_orderkey % 3 = 0 THEN 'b' END) AS b, max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END) AS c, min(o_orderkey) AS first_key FROM orders GROUP BY o_custkey, o_orderstatus
""")
def consolidate_compatible_rows(spark, d):
    k = F.col(_KEY)
    s = F.col("o_orderstatus")  # rows of different status are incompatible
    o = table(spark, d, "orders").select("o_custkey", s.alias("a"), F.when(k % 3 == 0, "b").alias("b"), F.when(k % 2 == 0, s).alias("c"), k.alias("first_key"))
    return aggregate.merge_compatible_rows(o, "o_custkey", ["first_key"])


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1")
def latest_per_key(spark, d):
    return first_per_group(table(spark, d, "events"), ["user_id", "event_type"], [F.col("ts").desc_nulls_last(), F.col("event_id")]).select("user_id", "event_type", "event_id")


_CONFLICT = "(SELECT l_orderkey, l_linenumber, count(DISTINCT CASE WHEN l_partkey % 4 <> 0 THEN l_returnflag END) > 1 AS f, count(DISTINCT l_linestatus) > 1 AS s, count(DISTINCT l_tax) > 1 AS t FROM lineitem GROUP BY ALL)"


def _conflict_input(spark, d):
    return table(spark, d, "lineitem").withColumn("l_returnflag", F.when(F.col("l_partkey") % 4 != 0, F.col("l_returnflag"))), _L, ["l_returnflag", "l_linestatus", "l_tax"]


@query(f"SELECT 'l_returnflag' AS column_name, count(CASE WHEN f THEN 1 END) AS n_conflicts FROM {_CONFLICT} UNION ALL SELECT 'l_linestatus', count(CASE WHEN s THEN 1 END) FROM {_CONFLICT} UNION ALL SELECT 'l_tax', count(CASE WHEN t THEN 1 END) FROM {_CONFLICT}")
def conflict_counts_by_column(spark, d):
    return aggregate.conflict_counts(*_conflict_input(spark, d))


@query(f"SELECT DISTINCT l_orderkey FROM {_CONFLICT} WHERE f OR s OR t")
def conflict_ids(spark, d):
    return aggregate.conflict_ids(*_conflict_input(spark, d), "l_orderkey")


@query("""
WITH l AS (SELECT l_orderkey, l_quantity AS possible, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS absence_count, CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE 1 END AS k FROM lineitem),
s AS (SELECT l_orderkey, coalesce(sum(absence_count), 0) AS absence_count, coalesce(sum(possible * k), 0) AS possible FROM l GROUP BY 1)
SELECT l_orderkey, absence_count, possible, CASE WHEN possible = 0 THEN NULL ELSE round(absence_count / possible * 100, 4) END AS absence_pct FROM s
""")
def sum_counts_recompute_pct(spark, d):
    l = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_quantity") * F.when(F.col("l_partkey") % 50 == 0, 0).otherwise(1)).alias("possible"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber").cast("double")).alias("absence_count"))  # noqa: E741
    return aggregate.sum_and_percent(l, ["l_orderkey"], ["absence_count"], "possible").withColumn("absence_pct", r4("absence_pct"))


@query("SELECT user_id, event_type, count(*) AS event_count FROM events GROUP BY ALL")
def event_count_per_group(spark, d):
    return resolve.event_counts(table(spark, d, "events"), ["user_id", "event_type"])


@query("SELECT o_custkey, count(DISTINCT s) AS n_values, count(DISTINCT s) > 1 AS has_conflict, CASE WHEN count(DISTINCT s) = 1 THEN min(s) END AS curated FROM (SELECT o_custkey, CASE WHEN o_orderkey % 12 IN (4, 8) THEN o_orderstatus END AS s FROM orders) GROUP BY 1")
def curated_value_with_conflict_flag(spark, d):
    some = (F.col(_KEY) % 12).isin(4, 8)
    return aggregate.curated_value(table(spark, d, "orders").select("o_custkey", F.when(some, F.col("o_orderstatus")).alias("s")), "o_custkey", "s")


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1")
def multi_value_ids(spark, d):
    return aggregate.conflict_ids(table(spark, d, "lineitem"), ["l_orderkey"], ["l_returnflag"], "l_orderkey")


@query("SELECT o_custkey FROM orders GROUP BY 1 HAVING count(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END) = 0")
def empty_value_ids(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.when(F.col(_KEY) % 3 == 0, F.col("o_orderstatus"))).alias("n")).where("n = 0").select("o_custkey")


@query("SELECT s AS status, o_orderpriority, count(*) AS n, CAST(round(count(*) / (SELECT count(*) FROM orders), 4) AS DOUBLE) AS share FROM (SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS s, o_orderpriority FROM orders) GROUP BY ALL")
def value_counts_normalised(spark, d):
    o = table(spark, d, "orders").select(_null_every("o_orderstatus", 3).alias("status"), "o_orderpriority")
    return aggregate.value_shares(o, ["status", "o_orderpriority"]).withColumn("share", r4("share"))


@query("""
WITH g AS (SELECT year(o_orderdate) AS y, max(CASE WHEN year(o_orderdate) <> 1998 THEN 1 ELSE 0 END) AS a, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS b FROM orders GROUP BY 1)
SELECT y, 'a' AS column_name, a AS present FROM g UNION ALL SELECT y, 'b', b FROM g
""")
def column_coverage_matrix(spark, d):
    y = F.year("o_orderdate")
    o = table(spark, d, "orders").select(big(y).alias("y"), F.when(y != 1998, F.lit(1)).alias("a"), F.when(F.col("o_orderstatus") == "F", F.lit("x")).alias("b"))
    return aggregate.coverage(o, ["y"], ["a", "b"])


def _pivot(spark, d, how, values):
    return aggregate.pivot(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", values, how, ["F", "O", "P"])


def _pivot_sql(e):
    return f"SELECT o_orderpriority, {e.format('F')} AS F, {e.format('O')} AS O, {e.format('P')} AS P FROM orders GROUP BY 1"


@query(_pivot_sql("count(DISTINCT CASE WHEN o_orderstatus = '{}' THEN o_custkey END)"))
def pivot_nunique(spark, d):
    return _pivot(spark, d, "nunique", "o_custkey")


@query(_pivot_sql("count(CASE WHEN o_orderstatus = '{}' THEN 1 END)"))
def pivot_count(spark, d):
    return _pivot(spark, d, "count", "o_custkey")


@query(_pivot_sql("CAST(sum(CASE WHEN o_orderstatus = '{}' THEN o_custkey END) AS BIGINT)"))
def pivot_sum(spark, d):
    return _pivot(spark, d, "sum", "o_custkey")


@query("SELECT o_orderkey, o_orderstatus AS status FROM orders")
def merge_equivalent_columns(spark, d):
    k, s = F.col(_KEY), F.col("o_orderstatus")
    df = table(spark, d, "orders").select(_KEY, F.when(k % 2 == 0, s).alias("a_status"), F.when(k % 3 != 0, s).alias("b_status"), F.when(k % 2 != 0, s).alias("c_status"))
    return aggregate.merge_equivalent(df, {"status": ["a_status", "b_status", "c_status"]})[0].select(_KEY, "status")


def _pair_sql(a, b):
    """The pair, from the emptier to the fuller, if no row has two values that differ."""
    fuller = f"(SELECT count({a}) <= count({b}) FROM t)"
    return f"SELECT CASE WHEN {fuller} THEN '{a}' ELSE '{b}' END AS from_col, CASE WHEN {fuller} THEN '{b}' ELSE '{a}' END AS to_col WHERE NOT EXISTS (SELECT 1 FROM t WHERE {a} <> {b})"


@query(f"""
WITH t AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS school_name_a, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS school_name_b, o_orderstatus || 'x' AS school_name_c, CASE WHEN o_orderkey % 2 = 1 THEN 'odd' END AS school_name_e FROM orders)
{" UNION ALL ".join(_pair_sql(f"school_name_{x}", f"school_name_{y}") for x, y in ("ab", "ac", "ae", "bc", "be", "ce"))}
""")
def complementary_pairs(spark, d):
    k, s = F.col(_KEY), F.col("o_orderstatus")
    df = table(spark, d, "orders").select(F.when(k % 2 == 0, s).alias("school_name_a"), F.when(k % 3 == 0, s).alias("school_name_b"), F.concat(s, F.lit("x")).alias("school_name_c"), F.col("o_custkey").alias("school_name_d"), F.when(k % 2 == 1, "odd").alias("school_name_e"))
    return aggregate.complementary_pairs(df, df.columns, 0.9)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS status FROM orders")
def coalesce_column_map(spark, d):
    df = table(spark, d, "orders").select(_KEY, _null_every("o_orderpriority", 1).alias("none"), F.when(F.col(_KEY) % 2 == 0, F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("old_status"))
    return aggregate.apply_column_map(df, {"old_status": "status"}).select(_KEY, "status")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, o_orderpriority) AS raw FROM orders")
def coalesce_sources(spark, d):
    return table(spark, d, "orders").select(_KEY, F.coalesce(F.when(F.col(_KEY) % 2 == 0, F.col("o_orderstatus")), F.col("o_orderpriority")).alias("raw"))


@query("SELECT o_orderkey, CAST((o_orderkey % 2 <> 0)::INT + (o_orderkey % 3 <> 0)::INT + 1 AS INTEGER) AS n_filled FROM orders")
def row_completeness(spark, d):
    df = table(spark, d, "orders").select(_KEY, _null_every("o_orderstatus", 2).alias("a"), _null_every("o_orderpriority", 3).alias("b"), F.col("o_custkey").alias("c"))
    return df.select(_KEY, aggregate.filled(["a", "b", "c"]).alias("n_filled"))


# ---- derivation

@query("SELECT o_custkey, CASE WHEN count(DISTINCT v) = 1 THEN min(v) END AS agreed FROM (SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus END AS v FROM orders UNION ALL SELECT o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN o_orderstatus END FROM orders) WHERE v IS NOT NULL GROUP BY 1")
def agree_or_null(spark, d):
    k = F.col(_KEY)
    o = table(spark, d, "orders").select("o_custkey", F.when(k % 5 == 0, F.col("o_orderstatus")).alias("a"), F.when(k % 7 == 0, F.col("o_orderstatus")).alias("b"))
    return aggregate.agree_or_null(o, ["o_custkey"], ["a", "b"], "agreed")


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN n.n_name WHEN 1 THEN n.n_name END AS lvl_n_name, CAST(CASE c_custkey % 4 WHEN 0 THEN n.n_regionkey WHEN 1 THEN n.n_regionkey WHEN 2 THEN c.c_nationkey % 5 END AS INTEGER) AS lvl_n_regionkey
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def hierarchical_code_mapping(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("code"), F.concat(F.lit("Nation "), "n_nationkey").alias("name"), F.concat(F.lit("r"), F.col("n_nationkey") % 5).alias("region"), "n_name", "n_regionkey")
    codes = spark.createDataFrame([(None, None, f"r{i}", None, i) for i in range(5)], "code string, name string, region string, n_name string, n_regionkey int")
    levels = n.withColumn("region", F.lit(None).cast("string")).unionByName(codes)
    k, key = F.col("c_custkey") % 4, F.col("c_nationkey")
    c = table(spark, d, "customer").select("c_custkey", F.when(k == 0, key.cast("string")).when(k == 1, F.concat(F.lit(" NATION "), key)).when(k == 2, F.concat(F.lit("R"), key % 5)).alias("c"))
    return derive.map_levels(c, "c", levels, ["code", "name", "region"], ["n_name", "n_regionkey"], "lvl_").drop("c")


@query("SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS code, CASE WHEN c_nationkey < 10 THEN 'low' WHEN c_nationkey < 20 THEN 'high' END AS source_column FROM customer")
def code_source_column(spark, d):
    k = F.col("n_nationkey")
    n = table(spark, d, "nation").select(F.when(k < 10, k.cast("string")).alias("low"), F.when(k < 20, k.cast("string")).alias("high"))
    return derive.code_sources(table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("c")), "c", n, ["low", "high"])


@query("SELECT l_orderkey, l_linenumber, l_quantity + l_tax AS total, count(*) AS n FROM lineitem GROUP BY ALL")
def guarded_fill_from_components(spark, d):
    total = F.when(F.col("l_partkey") % 2 == 0, F.col("l_quantity") + F.col("l_tax"))
    l = table(spark, d, "lineitem").select(*_L, derive.fill_total(total, [F.col("l_quantity"), F.col("l_tax")]).alias("total"))  # noqa: E741
    return l.groupBy(*_L, "total").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 > 0 THEN round(l_quantity / (l_linenumber % 4), 4) END AS share, count(*) AS n FROM lineitem GROUP BY ALL")
def ratio_where_positive(spark, d):
    l = table(spark, d, "lineitem").select(*_L, r4(derive.ratio(F.col("l_quantity"), F.col("l_linenumber") % 4)).alias("share"))  # noqa: E741
    return l.groupBy(*_L, "share").agg(F.count("*").alias("n"))
