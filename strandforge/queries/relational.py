"""Projections, filters, changes of tables, sorts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import relational as R
from .base import cents, day, query


@query("proj_json_object", "SELECT c_custkey, json_object('key', c_custkey, 'segment', c_mktsegment, 'none', NULL::VARCHAR)::VARCHAR AS js FROM customer")
def _(t):
    row = F.struct(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.lit(None).cast("string").alias("none"))
    return t("customer").select("c_custkey", F.to_json(row, {"ignoreNullFields": "false"}).alias("js"))


@query("filt_basic", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20 AND p_brand IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21') AND p_type <> 'X' AND p_name IS NOT NULL")
def _(t):
    return t("part").where(F.col("p_size").between(10, 20) & F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#13", "Brand#21") & (F.col("p_type") != "X") & F.col("p_name").isNotNull()).select("p_partkey", "p_size")


@query("filt_like_any", "SELECT doc_id FROM documents WHERE text LIKE '%the%' OR text LIKE '%ent%' OR text LIKE '%zzz%'")
def _(t):
    return t("documents").where(reduce(lambda a, b: a | b, [F.col("text").like(f"%{x}%") for x in ("the", "ent", "zzz")])).select("doc_id")


@query("filt_ilike_param", "SELECT doc_id FROM documents WHERE text ILIKE '%license%'")
def _(t):
    return t("documents").where(F.col("text").ilike("%license%")).select("doc_id")


@query("regex_filters", r"SELECT doc_id, regexp_matches(text, '[Nn]{2,}') AS runs, regexp_matches(text, '^[A-Za-z ,.\n]+$') AS plain, NOT regexp_matches(text, '([Ee][^Ee]*){50}') AS few FROM documents")
def _(t):
    x = F.col("text")
    return t("documents").select("doc_id", x.rlike("[Nn]{2,}").alias("runs"), x.rlike(r"^[A-Za-z ,.\n]+\z").alias("plain"), (~x.rlike("([Ee][^Ee]*){50}")).alias("few"))


@query("filt_not_exists_sub", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_custkey = c.c_custkey AND l.l_returnflag = 'R' AND l.l_quantity > 48)")
def _(t):
    done = t("orders").join(t("lineitem").where("l_returnflag = 'R' AND l_quantity > 48"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("c_custkey"))
    return t("customer").join(done, "c_custkey", "left_anti").select("c_custkey")


@query("filt_any_horizontal", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0.08 OR abs(l_tax) >= 0.08 OR l_quantity > 49")
def _(t):
    any_of = reduce(lambda a, b: a | b, [F.col("l_discount") > 0.08, F.abs("l_tax") >= 0.08, F.col("l_quantity") > 49])
    return t("lineitem").where(any_of).select("l_orderkey", "l_linenumber")


@query(
    "filt_entry_valid",
    "SELECT doc_id, CASE WHEN length(text) < 100 THEN 'too short' WHEN length(text) > 5000 THEN 'too long' WHEN (length(text) - length(translate(text, 'Nn', ''))) > 0.1 * length(text) THEN 'too many N' END AS problem FROM documents",
)
def _(t):
    from ..functions import sequences

    return t("documents").select("doc_id", sequences.entry_problem(F.col("text"), 100, 5000, 0.1).alias("problem"))


@query("filt_uncultured", "SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (1, 5, 7, 11, 13)")
def _(t):
    return t("customer").where(~F.col("c_nationkey").isin(1, 5, 7, 11, 13)).select("c_custkey")


@query("filt_overlap_class", "SELECT event_id FROM events WHERE event_type IN ('click', 'view')")
def _(t):
    return t("events").where(F.col("event_type").isin("click", "view")).select("event_id")


@query("case_when", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'other' END AS status, CASE WHEN o_totalprice > 100000 THEN 'high' WHEN o_totalprice > 1000 THEN 'mid' ELSE 'low' END AS level FROM orders")
def _(t):
    s = F.col("o_orderstatus")
    p = F.col("o_totalprice")
    return t("orders").select("o_orderkey", F.when(s == "F", "final").when(s == "O", "open").otherwise("other").alias("status"), F.when(p > 100000, "high").when(p > 1000, "mid").otherwise("low").alias("level"))


@query("coalesce_cols", "SELECT d.doc_id, coalesce(CASE WHEN l.quality = 0 THEN NULL ELSE l.quality END, l.toxic, -1) AS v FROM documents d LEFT JOIN labels l USING (doc_id)")
def _(t):
    return t("documents").join(t("labels"), "doc_id", "left").select("doc_id", F.coalesce(F.when(F.col("quality") != 0, F.col("quality")), F.col("toxic"), F.lit(-1)).alias("v"))


def _halves(t):
    """orders split in two that overlap: keys not divisible by 3 as target, even keys as source with other prices."""
    base = t("orders").select("o_orderkey", "o_custkey", cents("o_totalprice").alias("price"), "o_orderstatus")
    target = base.where("o_orderkey % 3 <> 0")
    source = base.where("o_orderkey % 2 = 0").withColumn("price", F.col("price") + F.when(F.col("o_orderkey") % 4 == 0, 100).otherwise(0))
    return target, source


_HALVES = """WITH b AS (SELECT o_orderkey, o_custkey, round(o_totalprice * 100)::BIGINT AS price, o_orderstatus FROM orders),
t AS (SELECT * FROM b WHERE o_orderkey % 3 <> 0), s AS (SELECT o_orderkey, o_custkey, price + CASE WHEN o_orderkey % 4 = 0 THEN 100 ELSE 0 END AS price, o_orderstatus FROM b WHERE o_orderkey % 2 = 0)"""


@query("dml_upsert_update", _HALVES + " SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)")
def _(t):
    target, source = _halves(t)
    return R.upsert(target, source, "o_orderkey")


@query("dml_upsert_nothing", _HALVES + " SELECT * FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)")
def _(t):
    target, source = _halves(t)
    return R.upsert(target, source, "o_orderkey", update=False)


@query("dml_upsert_guarded", _HALVES + " SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(s.price, t.price) AS price, (t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND s.price IS DISTINCT FROM t.price)) AS changed FROM t FULL JOIN s USING (o_orderkey)")
def _(t):
    target, source = _halves(t)
    target, source = target.select("o_orderkey", "price").withColumn("changed", F.lit(False)), source.select("o_orderkey", "price").withColumn("changed", F.lit(True))
    return R.upsert(target, source, "o_orderkey", changed=["price"])


@query("dml_update_from", "SELECT c_custkey, CASE WHEN n.n_nationkey IS NOT NULL THEN n.n_name ELSE c_mktsegment END AS c_mktsegment FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) n ON n_nationkey = c_nationkey")
def _(t):
    nation = t("nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return R.update_from(t("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), nation, "c_nationkey", c_mktsegment=F.col("s_n_name")).select("c_custkey", "c_mktsegment")


@query("dml_update_corr_subq", "SELECT n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS member_count FROM nation")
def _(t):
    return R.count_into(t("nation").select("n_nationkey"), t("customer").select(F.col("c_nationkey").alias("n_nationkey")), "n_nationkey", "member_count")


@query("dml_delete_using", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def _(t):
    return R.delete_using(t("orders"), t("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey").select("o_orderkey")


@query("dml_delete_not_exists", "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)")
def _(t):
    return R.keep_existing(t("supplier"), t("nation").where("n_regionkey < 2").select(F.col("n_nationkey").alias("s_nationkey")), "s_nationkey").select("s_suppkey")


@query("dml_replace_by_feature", "SELECT event_id, event_type, user_id FROM events WHERE event_type <> 'click' UNION ALL SELECT DISTINCT event_id + 1000000, 'click', user_id FROM events WHERE event_type = 'view'")
def _(t):
    e = t("events").select("event_id", "event_type", "user_id")
    new = e.where("event_type = 'view'").select((F.col("event_id") + 1000000).alias("event_id"), F.lit("click").alias("event_type"), "user_id")
    return R.replace_where(e, new, F.col("event_type") == "click")


@query("assert_zero", "SELECT count(*) AS bad FROM lineitem WHERE l_quantity < 0")
def _(t):
    bad = t("lineitem").where("l_quantity < 0")
    R.require_zero(bad.select("l_orderkey"), "negative quantities")
    return bad.agg(F.count("*").alias("bad"))


# sorts, limits, first rows


@query("sort_multi", "SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderkey DESC")
def _(t):
    return t("orders").select("o_custkey", "o_orderkey").orderBy("o_custkey", F.desc("o_orderkey"))


@query("sort_natural", r"SELECT c_name, regexp_replace(c_name, '[0-9]+$', '') AS prefix, CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT) AS number FROM customer ORDER BY 2, 3")
def _(t):
    from ..functions import text

    prefix, number = text.natural_key(F.col("c_name"))
    return t("customer").select("c_name", prefix.alias("prefix"), number.alias("number")).orderBy("prefix", "number")


@query("sort_locale", "SELECT min(upper(event_type)) AS name FROM events GROUP BY lower(event_type) ORDER BY lower(min(event_type))")
def _(t):
    e = t("events").select(F.upper("event_type").alias("name"))
    return e.withColumn("k", F.lower("name")).groupBy("k").agg(F.min("name").alias("name")).orderBy("k").select("name")


@query("limit_n", "SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def _(t):
    return t("part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(25).select("p_partkey")


@query("top1_by_score", "SELECT s_nationkey, s_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY round(s_acctbal * 100) DESC, s_suppkey) AS n FROM supplier) WHERE n = 1")
def _(t):
    s = t("supplier").select("s_nationkey", "s_suppkey", (-cents("s_acctbal")).alias("k"))
    return R.distinct_on(s, "s_nationkey", "k", "s_suppkey").select("s_nationkey", "s_suppkey")


@query("top1_latest", "SELECT o_custkey, max(date_diff('day', DATE '1970-01-01', o_orderdate::DATE)) AS latest FROM orders GROUP BY o_custkey")
def _(t):
    return t("orders").groupBy("o_custkey").agg(F.max(day("o_orderdate")).alias("latest"))


@query("argmax_ties", "SELECT l_orderkey, l_linenumber FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r = 1")
def _(t):
    return R.argmax_ties(t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_orderkey", "l_quantity").select("l_orderkey", "l_linenumber")


@query("first_by_preference", "SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY coalesce(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority), 4)) AS r FROM orders) WHERE r = 1")
def _(t):
    return R.pick_by_preference(t("orders").select("o_custkey", "o_orderkey", "o_orderpriority"), "o_custkey", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query("max_by_tuple", "SELECT c_nationkey, arg_max(c_name, (c_mktsegment, c_custkey)) AS best FROM customer GROUP BY c_nationkey")
def _(t):
    return t("customer").groupBy("c_nationkey").agg(F.max_by("c_name", F.struct("c_mktsegment", "c_custkey")).alias("best"))


@query("min_by", "SELECT c_nationkey, arg_min(c_custkey, c_name) AS lowest FROM customer GROUP BY c_nationkey")
def _(t):
    return t("customer").groupBy("c_nationkey").agg(F.min_by("c_custkey", "c_name").alias("lowest"))


@query("range_partition", "SELECT c_nationkey AS taxid, count(*) AS n FROM customer GROUP BY 1")
def _(t):
    return t("customer").repartitionByRange("c_nationkey").groupBy(F.col("c_nationkey").alias("taxid")).agg(F.count("*").alias("n"))


@query("size_chunking", "SELECT doc_id, ((sum(n_chars) OVER (ORDER BY doc_id) - n_chars) // 100000)::BIGINT AS chunk FROM documents")
def _(t):
    return R.size_chunks(t("documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 100000).select("doc_id", "chunk")


# set operations


@query("set_union_distinct", "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def _(t):
    return t("orders").select(F.col("o_custkey").alias("k")).union(t("customer").select("c_custkey")).distinct()


@query("set_union_all", "SELECT c_nationkey AS k, 'c' AS kind FROM customer UNION ALL SELECT s_nationkey, 's' FROM supplier")
def _(t):
    return t("customer").select(F.col("c_nationkey").alias("k"), F.lit("c").alias("kind")).unionByName(t("supplier").select(F.col("s_nationkey").alias("k"), F.lit("s").alias("kind")))


@query("set_difference", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def _(t):
    return t("customer").select(F.col("c_custkey").alias("k")).subtract(t("orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select("o_custkey"))


@query("set_difference_all", "SELECT c_nationkey AS k FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9900)")
def _(t):
    return t("customer").select(F.col("c_nationkey").alias("k")).join(t("supplier").where("s_acctbal > 9900").select(F.col("s_nationkey").alias("k")), "k", "left_anti")


@query("set_intersection_py", "SELECT user_id, list_has_any(list(DISTINCT event_type), ['click', 'purchase']) AS hit FROM events GROUP BY user_id")
def _(t):
    return t("events").groupBy("user_id").agg(F.arrays_overlap(F.collect_set("event_type"), F.array(F.lit("click"), F.lit("purchase"))).alias("hit"))


@query("set_intersect_except_builtin", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def _(t):
    return t("customer").select(F.col("c_nationkey").alias("k")).intersect(t("supplier").select("s_nationkey"))


# windows


@query("win_row_number_total", "SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS id FROM customer")
def _(t):
    return R.dense_ids(t("customer").select("c_custkey", "c_name"), ["c_name", "c_custkey"], "id").select("c_custkey", "id")


@query("win_row_number_empty", "SELECT count(*) AS n, count(*) AS ids FROM customer")
def _(t):
    return t("customer").withColumn("id", F.monotonically_increasing_id()).agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@query("win_min_over_partition", "SELECT o_orderkey, min(date_diff('day', DATE '1970-01-01', o_orderdate::DATE)) OVER (PARTITION BY o_custkey) < date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS has_predecessor FROM orders")
def _(t):
    return t("orders").select("o_orderkey", (F.min(day("o_orderdate")).over(Window.partitionBy("o_custkey")) < day("o_orderdate")).alias("has_predecessor"))


@query("win_dedupe_row_number", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def _(t):
    return R.distinct_on(t("events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], F.desc("event_id"))


@query("win_row_index", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS idx FROM orders")
def _(t):
    return t("orders").select("o_orderkey", (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).cast("long").alias("idx"))


@query("win_enumerate", "SELECT l_orderkey || '.' || (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1) AS region_id FROM lineitem")
def _(t):
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")) - 1
    return t("lineitem").select(F.concat_ws(".", F.col("l_orderkey").cast("string"), n.cast("string")).alias("region_id"))


@query("win_consecutive_runs", "SELECT min(k) AS run_start, max(k) AS run_end, count(*) AS run_length, f FROM (SELECT f, k, k - row_number() OVER (PARTITION BY f ORDER BY k) AS g FROM (SELECT DISTINCT l_returnflag AS f, l_orderkey AS k FROM lineitem)) GROUP BY f, g")
def _(t):
    return R.consecutive_runs(t("lineitem").select(F.col("l_returnflag").alias("f"), F.col("l_orderkey").alias("k")), "f", "k")


@query("distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _(t):
    return t("lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("distinct_on", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def _(t):
    return R.distinct_on(t("events").select("user_id", "event_id", "event_type"), "user_id", "event_id").select("user_id", "event_id")


@query("distinct_on_ordered", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, abs(round(o_totalprice * 100) - 5000000), o_orderkey) AS n FROM orders) WHERE n = 1")
def _(t):
    o = t("orders").select("o_custkey", "o_orderkey", "o_orderdate", cents("o_totalprice").alias("p"))
    return R.distinct_on(o, "o_custkey", F.desc("o_orderdate"), F.abs(F.col("p") - 5000000), "o_orderkey").select("o_custkey", "o_orderkey")
