"""Joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import ranges, relational as R
from .base import cents, day, query, second


@query("join_inner_equi", "SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'")
def _(t):
    return t("lineitem").join(t("orders").where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_custkey")


@query(
    "join_star_7",
    """SELECT r_name, n_name, c_mktsegment, p_brand, s_nationkey, l_returnflag, count(*) AS n, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cents FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey WHERE l_quantity > 45 GROUP BY ALL""",
)
def _(t):
    joined = (
        t("lineitem").where("l_quantity > 45").join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("customer"), F.col("c_custkey") == F.col("o_custkey"))
        .join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .join(t("part"), F.col("p_partkey") == F.col("l_partkey")).join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    )
    return joined.groupBy("r_name", "n_name", "c_mktsegment", "p_brand", "s_nationkey", "l_returnflag").agg(F.count("*").alias("n"), F.sum(cents("l_extendedprice")).alias("cents"))


@query("join_left_outer", "SELECT c_custkey, count(o_orderkey) AS n, max(o_orderkey) AS last FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def _(t):
    return t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"), F.max("o_orderkey").alias("last"))


@query("right_outer_match_case", "SELECT l_orderkey, l_linenumber, CASE WHEN p_partkey IS NOT NULL AND p_size > 25 THEN p_partkey END AS matched FROM (SELECT * FROM part WHERE p_partkey % 2 = 0) RIGHT JOIN (SELECT * FROM lineitem WHERE l_linenumber <= 2) ON p_partkey = l_partkey")
def _(t):
    part = t("part").where("p_partkey % 2 = 0").select("p_partkey", "p_size")
    line = t("lineitem").where("l_linenumber <= 2").select("l_orderkey", "l_linenumber", "l_partkey")
    return part.join(line, F.col("p_partkey") == F.col("l_partkey"), "right").select("l_orderkey", "l_linenumber", F.when(F.col("p_size") > 25, F.col("p_partkey")).alias("matched"))


@query("join_anti_right_null", "SELECT l.c_custkey FROM (SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') o RIGHT OUTER JOIN customer l ON o.o_custkey = l.c_custkey WHERE o.o_orderkey IS NULL")
def _(t):
    return t("customer").join(t("orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("join_anti_left_null", "SELECT p_partkey FROM part LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 40) ON l_partkey = p_partkey WHERE l_orderkey IS NULL")
def _(t):
    return t("part").join(t("lineitem").where("l_quantity > 40"), F.col("l_partkey") == F.col("p_partkey"), "left_anti").select("p_partkey")


@query("anti_not_exists", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')")
def _(t):
    return t("customer").join(t("orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("semi_exists", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def _(t):
    return t("customer").join(t("orders").where("o_totalprice > 200000"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("join_semi_in", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(t):
    return t("orders").join(t("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi").select("o_orderkey")


@query("join_polars_inner", "SELECT d.doc_id, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def _(t):
    return t("documents").select("doc_id").join(t("labels"), "doc_id").select("doc_id", "quality", "toxic")


@query("join_pandas_inner_left", "SELECT DISTINCT u.user_id, u.event_type, c.c_custkey FROM (SELECT DISTINCT user_id, event_type FROM events) u LEFT JOIN customer c ON c.c_custkey = u.user_id AND c.c_acctbal > 0")
def _(t):
    return t("events").select("user_id", "event_type").distinct().join(t("customer").where("c_acctbal > 0").select("c_custkey"), F.col("user_id") == F.col("c_custkey"), "left")


@query("join_merge_sorted_inner", "SELECT d.doc_id, d.n_chars, l.quality FROM documents d JOIN labels l USING (doc_id) ORDER BY d.doc_id")
def _(t):
    return t("documents").select("doc_id", "n_chars").join(t("labels").select("doc_id", "quality").hint("merge"), "doc_id").orderBy("doc_id")


@query("join_merge_sorted_full_outer", "SELECT coalesce(c_custkey, k) AS k, CASE WHEN c_custkey IS NULL THEN 'new' WHEN k IS NULL THEN 'gone' ELSE 'both' END AS state FROM (SELECT * FROM customer WHERE c_custkey % 3 <> 0) FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders) ON c_custkey = k")
def _(t):
    old = t("customer").where("c_custkey % 3 <> 0").select("c_custkey")
    new = t("orders").select(F.col("o_custkey").alias("k")).distinct()
    return old.join(new, F.col("c_custkey") == F.col("k"), "full").select(F.coalesce("c_custkey", "k").alias("k"), F.when(F.col("c_custkey").isNull(), "new").when(F.col("k").isNull(), "gone").otherwise("both").alias("state"))


@query(
    "nway_merge",
    """SELECT p_partkey, (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R') AS returned, (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'A') AS accepted,
    (SELECT min(s_name) FROM supplier WHERE s_suppkey = p_partkey) AS supplier, (SELECT min(c_name) FROM customer WHERE c_custkey = p_partkey) AS customer FROM part""",
)
def _(t):
    line = t("lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber", "l_returnflag")
    children = {
        "r": (line.where("l_returnflag = 'R'").drop("l_returnflag"), "any"),
        "a": (line.where("l_returnflag = 'A'").drop("l_returnflag"), "any"),
        "s": (t("supplier").select(F.col("s_suppkey").alias("p_partkey"), "s_name"), "zero_or_one"),
        "c": (t("customer").select(F.col("c_custkey").alias("p_partkey"), "c_name"), "zero_or_one"),
    }
    merged = R.merge_children(t("part").select("p_partkey"), "p_partkey", children)
    return merged.select("p_partkey", F.size("r").cast("long").alias("returned"), F.size("a").cast("long").alias("accepted"), F.col("s.s_name").alias("supplier"), F.col("c.c_name").alias("customer"))


@query("join_broadcast_map", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def _(t):
    # nation and region are fixed at 25 and 5 rows
    places = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return t("customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


@query(
    "join_tpa_first_db",
    """WITH m AS (SELECT o_custkey AS k, 'a' AS db, o_orderkey AS id FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT o_custkey, 'b', o_orderkey FROM orders WHERE o_orderkey % 3 = 0)
    SELECT c_custkey, db, id FROM (SELECT c_custkey, db, id, rank() OVER (PARTITION BY c_custkey ORDER BY db) AS r FROM customer LEFT JOIN m ON k = c_custkey) WHERE r = 1""",
)
def _(t):
    o = t("orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("id"))
    found = o.where("id % 5 = 0").withColumn("db", F.lit("a")).unionByName(o.where("id % 3 = 0").withColumn("db", F.lit("b")))
    joined = t("customer").select("c_custkey").join(found, "c_custkey", "left")
    first = F.rank().over(Window.partitionBy("c_custkey").orderBy("db"))
    return joined.withColumn("r", first).where("r = 1").select("c_custkey", "db", "id")


@query("join_self_pairs", "SELECT a.l_orderkey, a.l_linenumber AS x, b.l_linenumber AS y FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber <> b.l_linenumber")
def _(t):
    a = t("lineitem").select("l_orderkey", F.col("l_linenumber").alias("x"))
    b = t("lineitem").select("l_orderkey", F.col("l_linenumber").alias("y"))
    return a.join(b, "l_orderkey").where("x <> y")


def _timed(t):
    return t("events").select("event_type", "event_id", second("ts").alias("at"))


_TIMED = "WITH e AS (SELECT event_type, event_id, floor(epoch(ts))::BIGINT AS at FROM events)"


@query("near_pairs", _TIMED + " SELECT a.event_type, a.event_id AS event_id_a, b.event_id AS event_id_b, a.at AS at_a, b.at AS at_b FROM e a JOIN e b ON a.event_type = b.event_type AND a.event_id < b.event_id AND abs(a.at - b.at) <= 600")
def _(t):
    return ranges.near_pairs(_timed(t), ["event_type"], "at", "event_id", 600)


@query("join_rejoin_payload", _TIMED + " SELECT a.event_id AS event_id_a, b.event_id AS event_id_b, round(x.value * 100)::BIGINT + round(y.value * 100)::BIGINT AS cents FROM e a JOIN e b ON a.event_type = b.event_type AND a.event_id < b.event_id AND abs(a.at - b.at) <= 120 JOIN events x ON x.event_id = a.event_id JOIN events y ON y.event_id = b.event_id")
def _(t):
    # the pairs are made from slim rows; wide columns join afterwards
    pairs = ranges.near_pairs(_timed(t), ["event_type"], "at", "event_id", 120).select("event_id_a", "event_id_b")
    wide = t("events").select("event_id", cents("value").alias("v"))
    a, b = wide.select(F.col("event_id").alias("event_id_a"), F.col("v").alias("va")), wide.select(F.col("event_id").alias("event_id_b"), F.col("v").alias("vb"))
    return pairs.join(a, "event_id_a").join(b, "event_id_b").select("event_id_a", "event_id_b", (F.col("va") + F.col("vb")).alias("cents"))


@query("join_lookup_cross", "SELECT a.r_name AS a, b.r_name AS b, CASE WHEN a.r_name = b.r_name THEN 1.0 WHEN left(a.r_name, 1) = left(b.r_name, 1) THEN 0.5 ELSE 0.0 END::DOUBLE AS sim FROM region a, region b")
def _(t):
    # a table of all pairs of a fixed, tiny set of types (5 rows)
    a, b = t("region").select(F.col("r_name").alias("a")), t("region").select(F.col("r_name").alias("b"))
    sim = F.when(F.col("a") == F.col("b"), 1.0).when(F.left("a", F.lit(1)) == F.left("b", F.lit(1)), 0.5).otherwise(0.0)
    return a.crossJoin(F.broadcast(b)).withColumn("sim", sim)


def _spans(t, lines, strand="l_returnflag", more=()):
    """Line items as intervals of days: from the ship date, as long as the quantity."""
    return t("lineitem").where(lines).select(F.concat_ws("-", "l_orderkey", "l_linenumber", *more, day("l_shipdate").cast("string"), F.col("l_quantity").cast("int").cast("string")).alias("id"), F.col(strand).alias("strand"), day("l_shipdate").alias("start"), (day("l_shipdate") + F.col("l_quantity").cast("long")).alias("stop"))


def _sides(t):
    """All returned line items of a supplier against all its accepted ones."""
    return _spans(t, "l_returnflag = 'R'", "l_suppkey", ["l_suppkey"]), _spans(t, "l_returnflag = 'A'", "l_suppkey", ["l_suppkey"])


_SPANS = """WITH s AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || date_diff('day', DATE '1970-01-01', l_shipdate::DATE) || '-' || l_quantity::INT AS id, l_suppkey AS strand, l_returnflag AS flag, date_diff('day', DATE '1970-01-01', l_shipdate::DATE)::BIGINT AS start,
date_diff('day', DATE '1970-01-01', l_shipdate::DATE)::BIGINT + l_quantity::BIGINT AS stop FROM lineitem), a AS (SELECT * FROM s WHERE flag = 'R'), b AS (SELECT * FROM s WHERE flag = 'A')"""


@query("interval_overlap", _SPANS + " SELECT a.id AS a, b.id AS b FROM a JOIN b ON a.strand = b.strand AND a.start < b.stop AND b.start < a.stop")
def _(t):
    return ranges.overlap_join(*_sides(t), ["strand"], 32).select(F.col("l_id").alias("a"), F.col("r_id").alias("b"))


@query("join_interval_report", _SPANS + " SELECT id, EXISTS (SELECT 1 FROM b WHERE a.strand = b.strand AND a.start < b.stop AND b.start < a.stop) AS hit FROM a")
def _(t):
    a, b = _sides(t)
    hit = ranges.overlap_filter(a, b, ["strand"], 32, "id").select("id", F.lit(True).alias("hit"))
    return hit.unionByName(ranges.overlap_filter(a, b, ["strand"], 32, "id", keep=False).select("id", F.lit(False).alias("hit")))


@query("join_interval_envelop", _SPANS + " SELECT id FROM a WHERE EXISTS (SELECT 1 FROM b WHERE a.strand = b.strand AND b.start <= a.start AND b.stop >= a.stop)")
def _(t):
    return ranges.overlap_filter(*_sides(t), ["strand"], 32, "id", enclosed=True).select("id")


@query("join_range_or", _SPANS + " SELECT a.id AS a, b.id AS b FROM a JOIN b ON a.strand = b.strand AND (abs(a.start - b.start) <= 5 OR abs(a.stop - b.stop) <= 5)")
def _(t):
    return ranges.within_either(*_sides(t), ["strand"], 5).select(F.col("l_id").alias("a"), F.col("r_id").alias("b"))


@query("join_window_near_iter")
def _(t):
    # all line items: what is shipped is old, what is open is new
    return ranges.greedy_matches(_spans(t, "l_linestatus = 'F'"), _spans(t, "l_linestatus = 'O'"), ["strand"], 30, 0.5)


@query("join_unix", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_tax = 0) EXCEPT SELECT l_orderkey FROM lineitem WHERE l_discount = 0")
def _(t):
    line = t("lineitem")
    some = t("orders").select("o_orderkey").join(line.where("l_tax = 0").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    return some.subtract(line.where("l_discount = 0").select("l_orderkey"))


@query("join_channel", "SELECT c_custkey, (SELECT max(o_orderkey) FROM orders) AS release FROM customer")
def _(t):
    # one row joined to all
    return t("customer").select("c_custkey").crossJoin(F.broadcast(t("orders").agg(F.max("o_orderkey").alias("release"))))
