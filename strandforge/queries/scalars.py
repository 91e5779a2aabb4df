"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coordinates, identifiers, sequences, text
from .base import cents, day, query


@query("string_sql", "SELECT c_custkey, c_name || '-' || c_mktsegment AS a, split_part(c_name, '#', 2) AS b, right(c_name, 1) AS c, upper(c_mktsegment) AS d, replace(c_name, 'Customer', 'C') AS e, substr(c_name, 2, 3) AS f, list_extract(string_split_regex(c_name, '[#]'), 1) AS g FROM customer")
def _(t):
    n = F.col("c_name")
    return t("customer").select(
        "c_custkey", F.concat(n, F.lit("-"), "c_mktsegment").alias("a"), F.split_part(n, F.lit("#"), F.lit(2)).alias("b"), F.right(n, F.lit(1)).alias("c"), F.upper("c_mktsegment").alias("d"),
        F.replace(n, F.lit("Customer"), F.lit("C")).alias("e"), F.substring(n, 2, 3).alias("f"), F.get(F.split(n, "[#]"), 0).alias("g"),
    )


@query("concat_null_rules", "SELECT doc_id, 'x' || CASE WHEN quality = 1 THEN 'q' END AS piped, concat('x', CASE WHEN quality = 1 THEN 'q' END) AS skipped FROM labels")
def _(t):
    from ..operators.relational import concat_skip

    q = F.when(F.col("quality") == 1, "q")
    return t("labels").select("doc_id", F.concat(F.lit("x"), q).alias("piped"), concat_skip(F.lit("x"), q).alias("skipped"))


@query(
    "entropy_score",
    "WITH c AS (SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS k FROM documents), u AS (SELECT doc_id, length(k) AS n, unnest(string_split(k, '')) AS ch FROM c WHERE k <> ''), g AS (SELECT doc_id, n, ch, count(*) AS f FROM u GROUP BY ALL) SELECT doc_id, round(coalesce(e, 0), 6) AS entropy FROM c LEFT JOIN (SELECT doc_id, -sum((f / n) * log2(f / n)) AS e FROM g GROUP BY doc_id) USING (doc_id)",
)
def _(t):
    return t("documents").select("doc_id", F.round(text.entropy(F.col("text")), 6).alias("entropy"))


@query("date_fns", "SELECT o_orderkey, date_diff('day', DATE '1995-01-01', o_orderdate::DATE)::BIGINT AS days, (date_diff('day', o_orderdate::DATE, DATE '1998-01-01') < 700) AS recent, date_diff('day', DATE '1970-01-01', date_trunc('month', o_orderdate)::DATE)::BIGINT AS month FROM orders")
def _(t):
    d = F.to_date("o_orderdate")
    return t("orders").select(
        "o_orderkey", F.datediff(d, F.lit("1995-01-01").cast("date")).cast("long").alias("days"), (F.datediff(F.lit("1998-01-01").cast("date"), d) < 700).alias("recent"),
        F.datediff(F.trunc(d, "month"), F.lit("1970-01-01").cast("date")).cast("long").alias("month"),
    )


@query("math_fns", "SELECT c_custkey, abs(round(c_acctbal * 100)::BIGINT) AS a, floor(round(c_acctbal * 100) / 700)::BIGINT AS fdiv, (round(c_acctbal * 100)::BIGINT) % 7 AS m, least(c_custkey, c_nationkey)::BIGINT AS lo, greatest(c_custkey, NULL, c_nationkey)::BIGINT AS hi, greatest(c_nationkey - 10, 0)::BIGINT AS clipped FROM customer")
def _(t):
    c = cents("c_acctbal")
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("long")
    return t("customer").select("c_custkey", F.abs(c).alias("a"), coordinates.floor_div(c, 700).alias("fdiv"), (c % 7).alias("m"), F.least(k, n).alias("lo"), F.greatest(k, F.lit(None).cast("long"), n).alias("hi"), F.greatest(n - 10, F.lit(0).cast("long")).alias("clipped"))


@query("bankers_round", "SELECT p_partkey, round_even(p_size / 4.0, 0)::BIGINT AS half_even, round(p_size / 4.0, 0)::BIGINT AS half_up FROM part")
def _(t):
    x = (F.col("p_size") / 4).cast("decimal(10,2)")
    return t("part").select("p_partkey", F.bround(x, 0).cast("long").alias("half_even"), F.round(x, 0).cast("long").alias("half_up"))


@query("hash_md5", "SELECT doc_id, md5(upper(text)) AS h FROM documents WHERE regexp_matches(text, '^[ -~\n]*$')")
def _(t):
    return t("documents").where(F.col("text").rlike(r"^[ -~\n]*\z")).select("doc_id", identifiers.md5(F.col("text")).alias("h"))


@query("hash_crc64")
def _(t):
    return t("customer").select("c_custkey", identifiers.crc64("c_name").alias("crc64"), identifiers.sha_number(F.col("c_name")).alias("sha_number"))


@query("urs_ids", "SELECT o_orderkey, 'URS' || upper(lpad(to_hex(o_orderkey), 10, '0')) AS urs, regexp_replace('URS' || upper(lpad(to_hex(o_orderkey), 10, '0')), '^URS0+', 'URS') AS short, o_orderkey AS back, 'URS' || upper(lpad(to_hex(o_orderkey), 10, '0')) || '_' || o_custkey AS urs_taxid FROM orders")
def _(t):
    u = identifiers.urs(F.col("o_orderkey"))
    return t("orders").select("o_orderkey", u.alias("urs"), identifiers.short_urs(u).alias("short"), identifiers.urs_number(u).alias("back"), identifiers.urs_taxid(u, F.col("o_custkey")).alias("urs_taxid"))


@query("array_fns", "SELECT l_orderkey, len(a) AS n, a[1] AS first, a[-1] AS last, list_sum(a)::BIGINT AS total, list_sort(list_distinct([x % 5 for x in a])) AS mods, a[1:2] AS two, [x for x in a if x % 2 = 0] AS evens FROM (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS a FROM lineitem GROUP BY l_orderkey)")
def _(t):
    from ..operators.relational import array_agg

    a = F.col("a")
    g = t("lineitem").groupBy("l_orderkey").agg(array_agg("l_partkey", "l_linenumber").alias("a"))
    return g.select(
        "l_orderkey", F.size(a).cast("long").alias("n"), F.element_at(a, 1).alias("first"), F.element_at(a, -1).alias("last"), F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y).alias("total"),
        F.array_sort(F.array_distinct(F.transform(a, lambda x: x % 5))).alias("mods"), F.slice(a, 1, 2).alias("two"), F.filter(a, lambda x: x % 2 == 0).alias("evens"),
    )


@query("explode_zip", "SELECT l_orderkey, unnest(a) AS part, unnest(b) AS line FROM (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS a, list(l_linenumber ORDER BY l_linenumber, l_partkey) AS b FROM lineitem GROUP BY l_orderkey)")
def _(t):
    from ..operators.relational import array_agg

    g = t("lineitem").groupBy("l_orderkey").agg(array_agg("l_partkey", "l_linenumber").alias("part"), array_agg("l_linenumber", "l_linenumber").alias("line"))
    return g.select("l_orderkey", F.inline(F.arrays_zip("part", "line")))


@query("json_extract", "SELECT event_id, json_extract_string(props, '$.k') AS k, (json_extract_string(props, '$.k'))::BIGINT + 1 AS next, json_extract_string(props, '$.none') AS missing FROM events")
def _(t):
    k = F.get_json_object("props", "$.k")
    return t("events").select("event_id", k.alias("k"), (F.try_to_number(k, F.lit("999999999")).cast("long") + 1).alias("next"), F.get_json_object("props", "$.none").alias("missing"))


@query("conditional_fns", "SELECT doc_id, quality IS DISTINCT FROM toxic AS differs, coalesce(nullif(quality, 0), 9) AS q FROM labels")
def _(t):
    return t("labels").select("doc_id", (~F.col("quality").eqNullSafe(F.col("toxic"))).alias("differs"), F.coalesce(F.nullif(F.col("quality"), F.lit(0)), F.lit(9)).alias("q"))


@query("region_names", "SELECT l_orderkey, 'U' || l_orderkey || '@' || min(l_returnflag) || '/' || string_agg(l_linenumber * 100 || '-' || (l_linenumber * 100 + l_quantity::BIGINT), ',' ORDER BY l_linenumber, l_quantity) || ':+' AS name FROM lineitem GROUP BY l_orderkey")
def _(t):
    exon = F.struct((F.col("l_linenumber") * 100).cast("long").alias("start"), (F.col("l_linenumber") * 100 + F.col("l_quantity")).cast("long").alias("stop"))
    g = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(exon).alias("exons"), F.min("l_returnflag").alias("chr"))
    return g.select("l_orderkey", coordinates.region_name(F.concat(F.lit("U"), F.col("l_orderkey").cast("string")), F.col("chr"), F.col("exons"), F.lit(1)).alias("name"))


@query("coordinate_bases", "SELECT o_orderkey, o_orderkey - 1 AS start0, o_orderkey + 10 AS stop0_open, 11 AS size FROM orders")
def _(t):
    start, stop = coordinates.rebased(F.col("o_orderkey"), F.col("o_orderkey") + 10, zero_based=False, closed=True, to_zero=True, to_closed=False)
    return t("orders").select("o_orderkey", start.alias("start0"), stop.alias("stop0_open"), coordinates.size(F.col("o_orderkey"), F.col("o_orderkey") + 10).cast("int").alias("size"))


@query("sequence_biology", "SELECT doc_id, translate(upper(text), 'U', 'T') AS dna, round((length(text) - length(translate(upper(text), 'GC', ''))) / length(text), 6) AS gc, length(text) - length(translate(text, '([{<', '')) + length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS pairs FROM documents WHERE regexp_matches(text, '^[ -~\n]+$')")
def _(t):
    x = F.col("text")
    return t("documents").where(x.rlike(r"^[ -~\n]+\z")).select("doc_id", sequences.to_dna(x).alias("dna"), F.round(sequences.gc_content(x), 6).alias("gc"), sequences.base_pairs(x).cast("long").alias("pairs"))


@query("string_py_strip", "SELECT c_custkey, CASE WHEN starts_with(lower(c_name), 'customer') THEN trim(substr(c_name, 9)) ELSE c_name END AS short FROM customer")
def _(t):
    return t("customer").select("c_custkey", text.strip_leading(F.col("c_name"), F.lit("customer")).alias("short"))


@query("split_synonyms", "SELECT p_partkey, [trim(x) for x in string_split(p_name, ' ') if trim(x) <> ''] AS names FROM part")
def _(t):
    return t("part").select("p_partkey", text.split_synonyms(F.replace("p_name", F.lit(" "), F.lit(";"))).alias("names"))


@query("day_of_order", "SELECT o_orderkey, date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::BIGINT AS d FROM orders")
def _(t):
    return t("orders").select("o_orderkey", day("o_orderdate").alias("d"))
