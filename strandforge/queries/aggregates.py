"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from .base import cents, query


@query("agg_group_count", "SELECT c_nationkey, count(*) AS n, count(DISTINCT c_mktsegment) AS segments FROM customer GROUP BY c_nationkey")
def _(t):
    return t("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count_distinct("c_mktsegment").alias("segments"))


@query("agg_max_min_bool_or", "SELECT l_returnflag, max(l_quantity) AS hi, min(l_quantity) AS lo, bool_or(l_discount > 0.09) AS any_big, bool_and(l_tax < 0.09) AS all_small, sum(l_quantity::BIGINT)::BIGINT AS total, round(avg(l_quantity::BIGINT), 6) AS mean FROM lineitem GROUP BY l_returnflag")
def _(t):
    return t("lineitem").groupBy("l_returnflag").agg(
        F.max("l_quantity").alias("hi"), F.min("l_quantity").alias("lo"), F.bool_or(F.col("l_discount") > 0.09).alias("any_big"), F.bool_and(F.col("l_tax") < 0.09).alias("all_small"),
        F.sum(F.col("l_quantity").cast("long")).alias("total"), F.round(F.avg(F.col("l_quantity").cast("long")), 6).alias("mean"),
    )


@query("agg_distinct_multi", "SELECT user_id, count(DISTINCT event_type) AS types, count(DISTINCT round(value * 100)::BIGINT) AS amounts FROM events GROUP BY user_id")
def _(t):
    return t("events").groupBy("user_id").agg(F.count_distinct("event_type").alias("types"), F.count_distinct(cents("value")).alias("amounts"))


@query("count_filter_having", "SELECT c_nationkey, count(*) FILTER (WHERE c_acctbal > 0) AS rich, count(*) AS n FROM customer GROUP BY c_nationkey HAVING count(*) > 3")
def _(t):
    return t("customer").groupBy("c_nationkey").agg(F.count_if(F.col("c_acctbal") > 0).alias("rich"), F.count("*").alias("n")).where("n > 3")


@query(
    "conditional_sums_2level",
    "WITH g AS (SELECT l_linenumber, " + ", ".join(f"sum(CASE WHEN l_returnflag = '{f}' AND l_linestatus = '{s}' THEN 1 ELSE 0 END)::BIGINT AS n_{f}{s}" for f in "ANR" for s in "FO") + " FROM lineitem GROUP BY l_linenumber) SELECT " + ", ".join(f"sum(n_{f}{s})::BIGINT AS n_{f}{s}, max(n_{f}{s}) AS top_{f}{s}" for f in "ANR" for s in "FO") + " FROM g",
)
def _(t):
    kinds = [(f, s) for f in "ANR" for s in "FO"]
    by_line = t("lineitem").groupBy("l_linenumber").agg(*[F.count_if((F.col("l_returnflag") == f) & (F.col("l_linestatus") == s)).alias(f"n_{f}{s}") for f, s in kinds])
    return by_line.agg(*[x for f, s in kinds for x in (F.sum(f"n_{f}{s}").alias(f"n_{f}{s}"), F.max(f"n_{f}{s}").alias(f"top_{f}{s}"))])


@query("agg_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) = 10 OR count(*) <> count(DISTINCT o_orderpriority)")
def _(t):
    g = t("orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_distinct("o_orderpriority").alias("d"))
    return g.where("n = 10 OR n <> d").select("o_custkey", "n")


@query("agg_array", "SELECT c.c_custkey, list(o_orderkey ORDER BY o_orderkey NULLS FIRST) AS keys FROM customer c LEFT JOIN (SELECT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey FROM orders) ON o_custkey = c_custkey GROUP BY 1")
def _(t):
    some = t("orders").select("o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("k"))
    return t("customer").join(some, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(R.array_agg("k", "k").alias("keys"))


@query("agg_array_distinct_row", "SELECT user_id, list(x ORDER BY x) AS kinds FROM (SELECT DISTINCT user_id, event_type || ':' || (event_id % 3) AS x FROM events) GROUP BY user_id")
def _(t):
    e = t("events").select("user_id", F.concat_ws(":", "event_type", (F.col("event_id") % 3).cast("string")).alias("x"))
    return e.groupBy("user_id").agg(R.array_agg_distinct("x").alias("kinds"))


@query("listagg_distinct", "SELECT user_id, string_agg(DISTINCT 'E:' || event_type, '|' ORDER BY 'E:' || event_type) AS types FROM events GROUP BY user_id")
def _(t):
    return t("events").groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set(F.concat(F.lit("E:"), "event_type"))), "|").alias("types"))


@query("length_histogram_json", "SELECT lang, '[' || string_agg('{\"length\":' || b || ',\"count\":' || n || '}', ',' ORDER BY b) || ']' AS histogram FROM (SELECT lang, n_chars // 1000 AS b, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang")
def _(t):
    h = t("documents").groupBy("lang", F.floor(F.col("n_chars") / 1000).alias("b")).agg(F.count("*").alias("n"))
    return h.groupBy("lang").agg(F.to_json(F.sort_array(F.collect_list(F.struct(F.col("b").alias("length"), F.col("n").alias("count"))))).alias("histogram"))


@query("agg_db_stats", "SELECT source, count(*) AS n, min(n_chars) AS shortest, max(n_chars) AS longest, sum(n_chars)::BIGINT AS total, round(avg(n_chars), 4) AS mean, count(DISTINCT lang) AS langs FROM documents GROUP BY source")
def _(t):
    from ..plans import release

    return release.database_stats(t("documents"), "source", "n_chars", "lang")


@query("agg_lineage_tree", "WITH x AS (SELECT DISTINCT r_name AS a, n_name AS b, c_mktsegment AS c FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey) SELECT a AS path, 1 AS depth, count(*) AS size FROM x GROUP BY a UNION ALL SELECT a || '; ' || b, 2, count(*) FROM x GROUP BY a, b UNION ALL SELECT a || '; ' || b || '; ' || c, 3, count(*) FROM x GROUP BY a, b, c")
def _(t):
    from ..plans import release

    places = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return release.lineage_sizes(places.select(F.concat_ws("; ", "r_name", "n_name", "c_mktsegment").alias("lineage")))


@query("group_any", "SELECT c_custkey, coalesce(list(o_orderkey ORDER BY o_orderkey) FILTER (WHERE o_orderkey IS NOT NULL), []) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def _(t):
    rows = R.group_children(t("customer").select("c_custkey"), t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), "c_custkey", "orders")
    return rows.select("c_custkey", F.transform("orders", lambda r: r["o_orderkey"]).alias("orders"))


@query("group_zero_or_one", "SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def _(t):
    return R.group_children(t("documents").select("doc_id"), t("labels"), "doc_id", "label", "zero_or_one").select("doc_id", "label.quality", "label.toxic")


@query("group_exactly_one", "SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey")
def _(t):
    names = t("customer").select("c_custkey", "c_nationkey").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return R.group_children(t("customer").select("c_custkey"), names, "c_custkey", "nation", "exactly_one").select("c_custkey", "nation.n_name")


@query("group_atleast_one", "SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def _(t):
    base = t("lineitem").select(F.col("l_orderkey").alias("k")).distinct()
    return R.group_children(base, t("lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber"), "k", "lines", "at_least_one").select("k", F.size("lines").cast("long").alias("n"))


@query("agg_group_consecutive", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def _(t):
    return t("orders").groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("agg_max_release", "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest FROM orders GROUP BY o_custkey")
def _(t):
    return t("orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest"))


@query("agg_group_first_list", "SELECT l_orderkey, min(l_linenumber)::BIGINT AS first_line, list(l_partkey ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY l_orderkey")
def _(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.min("l_linenumber").cast("long").alias("first_line"), R.array_agg("l_partkey", "l_linenumber").alias("parts"))


@query("array_union_distinct", "SELECT user_id, list(DISTINCT tag ORDER BY tag) AS tags FROM (SELECT user_id, unnest([event_type, 'm' || (event_id % 4)]) AS tag FROM events) GROUP BY user_id")
def _(t):
    tags = F.array(F.col("event_type"), F.concat(F.lit("m"), (F.col("event_id") % 4).cast("string")))
    return t("events").select("user_id", F.explode(tags).alias("tag")).groupBy("user_id").agg(F.sort_array(F.collect_set("tag")).alias("tags"))


@query("agg_any_flag", "SELECT user_id, bool_or(event_type = 'purchase') AS bought FROM events GROUP BY user_id")
def _(t):
    return t("events").groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("bought"))


@query("agg_single_or_default", "SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN min(o_orderstatus) ELSE 'mixed' END AS status FROM orders GROUP BY o_custkey")
def _(t):
    return t("orders").groupBy("o_custkey").agg(F.when(F.min("o_orderstatus") == F.max("o_orderstatus"), F.min("o_orderstatus")).otherwise("mixed").alias("status"))


@query("agg_mode_fallback", "SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY user_id, event_type) WHERE r = 1")
def _(t):
    counted = t("events").groupBy("user_id", "event_type").agg((-F.count("*")).alias("k"))
    return R.distinct_on(counted, "user_id", "k", "event_type").select("user_id", "event_type")


@query("agg_median_list", "SELECT l_orderkey, median(l_quantity) AS mid FROM lineitem GROUP BY l_orderkey")
def _(t):
    from ..plans import sources_plans

    lists = t("lineitem").groupBy("l_orderkey").agg(F.collect_list("l_quantity").alias("q"))
    return lists.select("l_orderkey", sources_plans.median_of(F.col("q")).alias("mid"))


@query("agg_mean_stdev", "SELECT l_orderkey, round(avg(l_quantity), 6) AS mean, round(coalesce(stddev_samp(l_quantity), 0), 6) AS sd FROM lineitem GROUP BY l_orderkey")
def _(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.round(F.avg("l_quantity"), 6).alias("mean"), F.round(F.coalesce(F.stddev_samp("l_quantity"), F.lit(0.0)), 6).alias("sd"))


@query("agg_pubcounts", "SELECT upper(event_type) AS id, sum(event_id % 7)::BIGINT AS hits FROM events GROUP BY upper(event_type)")
def _(t):
    return t("events").groupBy(F.upper("event_type").alias("id")).agg(F.sum(F.col("event_id") % 7).alias("hits"))


@query("generic_rollup", "SELECT o_custkey AS upi, count(*) AS rows_in, list(DISTINCT o_orderpriority ORDER BY o_orderpriority) AS priorities, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN min(o_orderstatus) ELSE 'ncRNA' END AS rna_type, bool_or(o_orderstatus = 'O') AS is_active FROM orders GROUP BY o_custkey")
def _(t):
    g = t("orders").groupBy(F.col("o_custkey").alias("upi"))
    return g.agg(F.count("*").alias("rows_in"), R.array_agg_distinct("o_orderpriority").alias("priorities"), F.when(F.min("o_orderstatus") == F.max("o_orderstatus"), F.min("o_orderstatus")).otherwise("ncRNA").alias("rna_type"), F.bool_or(F.col("o_orderstatus") == "O").alias("is_active"))


@query("scalar_subquery_stats", "SELECT n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers, (SELECT max(c_custkey) FROM customer WHERE c_nationkey = n_nationkey) AS last FROM nation")
def _(t):
    customers = t("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"), F.max("c_custkey").alias("last"))
    suppliers = t("supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("suppliers"))
    joined = t("nation").select("n_nationkey").join(customers, "n_nationkey", "left").join(suppliers, "n_nationkey", "left")
    return joined.select("n_nationkey", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("suppliers", F.lit(0)).alias("suppliers"), "last")


@query("agg_cube_rollup_builtin", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def _(t):
    return t("lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
