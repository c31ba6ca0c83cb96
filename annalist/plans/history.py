"""Queries on histories, windows and conflict resolution."""

from pyspark.sql import functions as F

from annalist.operators import derive, history, resolve, scans
from annalist.operators.frames import first_per_group
from annalist.plans.registry import query
from annalist.plans.tables import r4, table

_L = ["l_orderkey", "l_linenumber"]
_DAYS = "(SELECT user_id, CAST(ts AS DATE) AS day, event_type AS v FROM events)"
#: Each row with all values of its past; a row's own set, the counts so far, and the rule for the main value.
_CUM = f"""
WITH d AS (SELECT DISTINCT user_id, day, v FROM {_DAYS}), r AS (SELECT user_id, day, count(*) AS own_n, min(v) AS own FROM d GROUP BY user_id, day),
c AS (SELECT r.user_id, r.day, p.v, count(*) AS n FROM r JOIN d p ON p.user_id = r.user_id AND p.day <= r.day GROUP BY r.user_id, r.day, p.v),
t AS (SELECT c.*, max(n) OVER (PARTITION BY user_id, day) AS top FROM c),
k AS (SELECT user_id, day, array_to_string(list_sort(list(v)), '|') AS hist, count(*) AS n_uniq, max(top) AS top, count(CASE WHEN n = top THEN 1 END) AS ties, min(CASE WHEN n = top THEN v END) AS best FROM t GROUP BY user_id, day),
f AS (SELECT k.*, r.own_n, r.own, c.n AS own_count FROM k JOIN r ON k.user_id = r.user_id AND k.day = r.day JOIN c ON c.user_id = r.user_id AND c.day = r.day AND c.v = r.own)
SELECT user_id, day, {{}} FROM f
"""


def _days(spark, d):
    return table(spark, d, "events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type")


def _sets(spark, d):
    return _days(spark, d).groupBy("user_id", "day").agg(F.array_sort(F.collect_set("event_type")).alias("vals"))


def _cum(spark, d):
    return history.cumulative(_sets(spark, d), "user_id", ["day"], "vals", "x_")


@query(_CUM.format("hist"))
def cum_hist(spark, d):
    return _cum(spark, d).select("user_id", "day", F.array_join("x_hist", "|").alias("hist"))


@query(_CUM.format("n_uniq"))
def cum_n_unique(spark, d):
    return _cum(spark, d).select("user_id", "day", F.col("x_n_uniq").alias("n_uniq"))


@query(_CUM.format("CASE WHEN ties > 1 AND own_n = 1 THEN own ELSE best END AS main"))
def cum_main_value(spark, d):
    return _cum(spark, d).select("user_id", "day", F.col("x_main").alias("main"))


@query(_CUM.format("CASE WHEN ties > 1 AND own_n = 1 THEN own_count ELSE top END AS main_n"))
def cum_main_count(spark, d):
    return _cum(spark, d).select("user_id", "day", F.col("x_main_n").alias("main_n"))


#: Events of which half belong to one entity, in their order.
_LONG = "(SELECT CASE WHEN user_id % 2 = 0 THEN -1 ELSE user_id END AS entity, event_id, event_type AS v, row_number() OVER (PARTITION BY CASE WHEN user_id % 2 = 0 THEN -1 ELSE user_id END ORDER BY event_id) AS place FROM events)"


def _long(spark, d):
    e = table(spark, d, "events").select(F.when(F.col("user_id") % 2 == 0, -1).otherwise(F.col("user_id")).alias("entity"), "event_id", F.array("event_type").alias("vals"))
    return e, max(1000, e.count() // 20)


@query(f"""
WITH e AS {_LONG}, t AS (SELECT DISTINCT v FROM e), n AS (SELECT e.entity, e.event_id, e.v AS own, t.v, sum(CASE WHEN e.v = t.v THEN 1 ELSE 0 END) OVER (PARTITION BY e.entity, t.v ORDER BY e.place) AS n FROM e CROSS JOIN t),
k AS (SELECT *, max(n) OVER (PARTITION BY event_id) AS top FROM n WHERE n > 0)
SELECT entity, event_id, string_agg(v, '|' ORDER BY v) AS hist, count(*) AS n_uniq, CASE WHEN count(CASE WHEN n = top THEN 1 END) > 1 THEN min(own) ELSE min(CASE WHEN n = top THEN v END) END AS main,
       CAST(CASE WHEN count(CASE WHEN n = top THEN 1 END) > 1 THEN max(CASE WHEN v = own THEN n END) ELSE max(top) END AS BIGINT) AS main_n FROM k GROUP BY entity, event_id
""")
def cum_of_a_long_entity(spark, d):
    e, rows = _long(spark, d)
    out = scans.cumulative(e, "entity", ["event_id"], "vals", "x_", rows)
    return out.select("entity", "event_id", F.array_join("x_hist", "|").alias("hist"), F.col("x_n_uniq").alias("n_uniq"), F.col("x_main").alias("main"), F.col("x_main_n").alias("main_n"))


@query(f"""
WITH e AS {_LONG}, c AS (SELECT entity, event_id, place, CAST(CASE WHEN v <> lag(v) OVER (PARTITION BY entity ORDER BY place) THEN 1 ELSE 0 END AS BIGINT) AS changed FROM e)
SELECT entity, event_id, changed, CAST(sum(changed) OVER (PARTITION BY entity ORDER BY place) AS BIGINT) AS n_chg FROM c
""")
def changes_of_a_long_entity(spark, d):
    e, rows = _long(spark, d)
    return scans.state_changes(e, "entity", ["event_id"], ["vals"], "s_", 1, rows).select("entity", "event_id", F.col("s_changed").alias("changed"), F.col("s_n_chg").alias("n_chg"))


@query(f"SELECT entity, event_id, arg_min(x, place) OVER (PARTITION BY entity ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN v END AS x FROM {_LONG})")
def backfill_of_a_long_entity(spark, d):
    e, rows = _long(spark, d)
    e = e.select("entity", "event_id", F.when(F.col("event_id") % 7 == 0, F.col("vals")[0]).alias("v"))
    return scans.first_known(e, "entity", ["event_id"], ["v"], rows)


#: Per user and day: whether a value is new against the day before (in rows), and how many there are, for all and for big-value events.
_STATE = f"""
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type AS v FROM events), h AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type AS v FROM events WHERE event_id % 3 = 0),
r AS (SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS before FROM (SELECT DISTINCT user_id, day FROM d)),
x AS (SELECT r.*, (SELECT count(*) FROM d WHERE d.user_id = r.user_id AND d.day = r.day) AS n1, (SELECT count(*) FROM h WHERE h.user_id = r.user_id AND h.day = r.day) AS n2, (SELECT count(*) FROM h WHERE h.user_id = r.user_id AND h.day = r.before) AS p2,
      (SELECT count(*) FROM d a WHERE a.user_id = r.user_id AND a.day = r.day AND NOT EXISTS (SELECT 1 FROM d b WHERE b.user_id = a.user_id AND b.day = r.before AND b.v = a.v)) AS new1,
      (SELECT count(*) FROM h a WHERE a.user_id = r.user_id AND a.day = r.day AND NOT EXISTS (SELECT 1 FROM h b WHERE b.user_id = a.user_id AND b.day = r.before AND b.v = a.v)) AS new2 FROM r),
f AS (SELECT *, CASE WHEN before IS NOT NULL AND new1 > 0 THEN 1 ELSE 0 END AS b1, CASE WHEN before IS NOT NULL AND p2 > 0 AND n2 > 0 AND new2 > 0 THEN 1 ELSE 0 END AS b2, CASE WHEN n1 > 1 THEN 1 ELSE 0 END AS w1, CASE WHEN n2 > 1 THEN 1 ELSE 0 END AS w2 FROM x),
g AS (SELECT *, CAST(CASE WHEN b1 + b2 >= 2 OR w1 + w2 >= 2 THEN 1 ELSE 0 END AS BIGINT) AS changed FROM f)
SELECT user_id, day, {{}} FROM g
"""


def _state_input(spark, d):
    e = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    return e.groupBy("user_id", "day").agg(F.array_sort(F.collect_set("event_type")).alias("a"), F.array_sort(F.collect_set(F.when(F.col("event_id") % 3 == 0, F.col("event_type")))).alias("_b")).select("user_id", "day", "a", F.when(F.size("_b") > 0, F.col("_b")).alias("b"))


@query(_STATE.format("b1 AS is_new"))
def lag_set_change(spark, d):
    from pyspark.sql.window import Window

    return _state_input(spark, d).select("user_id", "day", history.between_change("a", Window.partitionBy("user_id").orderBy("day")).alias("is_new"))


@query(_STATE.format("changed"))
def state_changed_threshold(spark, d):
    return history.state_changes(_state_input(spark, d), "user_id", ["day"], ["a", "b"], "s_", 2).select("user_id", "day", F.col("s_changed").alias("changed"))


@query(_STATE.format("CAST(sum(changed) OVER (PARTITION BY user_id ORDER BY day) AS BIGINT) AS n_chg, CAST(CASE WHEN sum(changed) OVER (PARTITION BY user_id ORDER BY day) > 0 THEN 1 ELSE 0 END AS BIGINT) AS ever"))
def cumulative_change_count(spark, d):
    return history.state_changes(_state_input(spark, d), "user_id", ["day"], ["a", "b"], "s_", 2).select("user_id", "day", F.col("s_n_chg").alias("n_chg"), F.col("s_ever").alias("ever"))


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS place FROM orders")
def cumcount(spark, d):
    return table(spark, d, "orders").select("o_orderkey", history.cumcount(["o_custkey"], ["o_orderdate", "o_orderkey"]).alias("place"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def top1_per_group(spark, d):
    return first_per_group(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""
SELECT o_orderkey, (SELECT n.o_orderstatus FROM orders n WHERE n.o_custkey = o.o_custkey AND (n.o_orderdate, n.o_orderkey) >= (o.o_orderdate, o.o_orderkey) AND n.o_orderkey % 3 = 0 ORDER BY n.o_orderdate, n.o_orderkey LIMIT 1) AS status FROM orders o
""")
def grouped_backfill_first(spark, d):
    o = table(spark, d, "orders").withColumn("s", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")))
    return o.select("o_orderkey", history.first_known("s", ["o_custkey"], ["o_orderdate", "o_orderkey"]).alias("status"))


# ---- resolution

@query("""
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE abs(year(o_orderdate) - 1998) END NULLS LAST, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 99 END, o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1
""")
def resolve_rank_by_error_priority_recency(spark, d):
    o = table(spark, d, "orders")
    error = F.when(F.col("o_orderkey") % 10 != 0, F.abs(F.year("o_orderdate") - 1998))
    return resolve.by_priority(o, ["o_custkey"], error, F.col("o_orderstatus"), {"O": 1, "F": 2}, F.col("o_orderdate"), [F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS a, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS b FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (a IS NOT NULL)::INT + (b IS NOT NULL)::INT DESC, o_orderkey) AS r FROM o)
SELECT o_custkey, max(CASE WHEN r = 1 THEN o_orderkey END) AS o_orderkey, arg_min(a, CASE WHEN a IS NULL THEN NULL ELSE r END) AS a, arg_min(b, CASE WHEN b IS NULL THEN NULL ELSE r END) AS b FROM r GROUP BY 1
""")
def resolve_most_complete_with_backfill(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(k % 2 == 0, F.col("o_orderstatus")).alias("a"), F.when(k % 3 == 0, F.col("o_orderpriority")).alias("b"))
    return resolve.most_complete(o, ["o_custkey"], ["a", "b"], [F.col("o_orderkey")])


@query("SELECT o_orderkey, CAST(year(o_orderdate) + 11 + CASE WHEN month(o_orderdate) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS ks2, CAST(year(o_orderdate) + 16 + CASE WHEN month(o_orderdate) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS ks4 FROM orders")
def expected_exam_year(spark, d):
    born = F.col("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", resolve.expected_exam_year(born, 11).alias("ks2"), resolve.expected_exam_year(born, 16).alias("ks4"))


@query("SELECT user_id, event_type, event_id, event_count FROM (SELECT *, count(*) OVER (PARTITION BY user_id, event_type) AS event_count, row_number() OVER (PARTITION BY user_id, event_type ORDER BY CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END DESC NULLS LAST, event_id) AS r FROM events) WHERE r = 1")
def resolve_latest_with_event_count(spark, d):
    e = table(spark, d, "events").withColumn("at", F.when(F.col("event_id") % 5 != 0, F.col("ts")))
    return resolve.latest_with_count(e, ["user_id", "event_type"], "at", [F.col("event_id")], "event_count").select("user_id", "event_type", "event_id", "event_count")


_BAD = "(SELECT DISTINCT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT l_returnflag) > 1 OR count(DISTINCT l_linestatus) > 1)"


@query(f"SELECT 'clean' AS part, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem WHERE l_orderkey NOT IN {_BAD}) UNION ALL SELECT 'conflicted', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem WHERE l_orderkey IN {_BAD})")
def split_conflicted_entities(spark, d):
    clean, bad = resolve.split_conflicted(table(spark, d, "lineitem"), _L, ["l_returnflag", "l_linestatus"], "l_orderkey")
    one = lambda df, n: df.agg(F.count("*").alias("n")).select(F.lit(n).alias("part"), "n")
    return one(clean, "clean").unionByName(one(bad, "conflicted"))


_FLAGS = f"""
WITH s AS (SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate, l_returnflag FROM lineitem),
sb AS (SELECT DISTINCT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT l_shipdate) > 1 OR count(DISTINCT l_returnflag) > 1),
sr AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_returnflag) AS r, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM s),
q AS (SELECT DISTINCT l_orderkey, l_linenumber, l_tax * 100 AS late_count, l_quantity AS possible FROM lineitem),
qb AS (SELECT DISTINCT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT l_tax) > 1 OR count(DISTINCT l_quantity) > 1),
qs AS (SELECT l_orderkey, l_linenumber, sum(late_count) AS late_count, sum(possible) AS possible FROM q GROUP BY ALL)
SELECT sr.l_orderkey, sr.l_linenumber, l_shipdate, l_returnflag, CASE WHEN sr.l_orderkey IN (SELECT l_orderkey FROM sb) THEN n END AS event_count, round(late_count, 4) AS late_count, possible,
       CASE WHEN sr.l_orderkey IN (SELECT l_orderkey FROM qb) THEN round(late_count / possible * 100, 4) END AS late_pct
FROM sr JOIN qs ON sr.l_orderkey = qs.l_orderkey AND sr.l_linenumber = qs.l_linenumber WHERE r = 1
"""


@query(_FLAGS)
def resolve_conflicts_end_to_end(spark, d):
    l = table(spark, d, "lineitem").select(*_L, "l_shipdate", "l_returnflag", (F.col("l_tax") * 100).alias("late_count"), F.col("l_quantity").alias("possible"))  # noqa: E741
    rules = [
        resolve.Rule("latest", ["l_shipdate", "l_returnflag"], [F.col("l_returnflag")], {"date": "l_shipdate", "count": "event_count"}),
        resolve.Rule("sum", ["late_count", "possible"], [], {"counts": ["late_count"], "possible": "possible"}),
    ]
    return resolve.resolve(l, "l_orderkey", _L, rules).withColumns({"late_count": r4("late_count"), "late_pct": r4("late_pct")})


_H = f"""
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type AS v FROM events), r AS (SELECT DISTINCT user_id, day FROM d)
SELECT r.user_id, r.day, (SELECT count(DISTINCT v) FROM d WHERE d.user_id = r.user_id AND d.day <= r.day) AS kind_n_uniq, (SELECT array_to_string(list_sort(list(DISTINCT v)), '|') FROM d WHERE d.user_id = r.user_id AND d.day = r.day) AS kind FROM r
"""


@query(_H)
def school_history_features(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("third"))
    out = derive.set_histories(e, "user_id", "day", {"kind": ["event_type"], "third": ["third"]}, "der_")
    return out.select("user_id", "day", F.col("der_kind_n_uniq").alias("kind_n_uniq"), F.array_join("kind", "|").alias("kind"))


@query("""
WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type AS v FROM events), s AS (SELECT DISTINCT user_id, day, v FROM e WHERE v <> 'error'), r AS (SELECT DISTINCT user_id, day FROM s)
SELECT e.event_id, n.n AS lang_n_uniq FROM e LEFT JOIN (SELECT r.user_id, r.day, (SELECT count(DISTINCT v) FROM s WHERE s.user_id = r.user_id AND s.day <= r.day) AS n FROM r) n ON e.user_id = n.user_id AND e.day = n.day
""")
def language_history_features(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"), "event_type")
    return derive.value_history(e, "user_id", "day", "event_type", "lang_", ["error"]).select("event_id", "lang_n_uniq")
