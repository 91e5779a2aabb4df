"""Composite operators, on a catalogue derived from the driver's tables.

Orders stand for cross-references: the customer is the sequence, the order date the
release, the clerk-like priority the database. Line items stand for regions and exons.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identifiers
from ..operators import relational as R
from ..plans import export, genes, post_release, precompute, release, sources_plans
from .base import cents, day, query


@query("select_outdated", "SELECT k AS upi, last FROM (SELECT o_custkey AS k, max(date_diff('day', DATE '1970-01-01', o_orderdate::DATE)) AS last FROM orders GROUP BY 1) LEFT JOIN (SELECT o_custkey AS c, max(date_diff('day', DATE '1970-01-01', o_orderdate::DATE)) AS known FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1) ON k = c WHERE known IS NULL OR last > known")
def select_outdated(t):
    rows = t("orders").select(F.col("o_custkey").alias("upi"), day("o_orderdate").alias("last"), "o_orderkey")
    return precompute.outdated(rows, rows.where("o_orderkey % 2 = 0").select("upi", F.col("last").alias("last_release")))


def _staged(t):
    text = F.col("text")
    return t("documents").select(F.md5(text).alias("md5"), F.length(text).cast("long").alias("len"), F.when(F.length(text) <= 4000, text).alias("seq_short"), F.when(F.length(text) > 4000, text).alias("seq_long"), "doc_id", "source")


@query(
    "op_load_rna",
    "WITH d AS (SELECT doc_id, md5(text) AS m FROM documents), k AS (SELECT m, row_number() OVER (ORDER BY m) AS id FROM (SELECT DISTINCT m FROM d WHERE doc_id % 3 = 0)), n AS (SELECT m, row_number() OVER (ORDER BY m) + (SELECT max(id) FROM k) AS id FROM (SELECT DISTINCT m FROM d EXCEPT SELECT m FROM k)) SELECT doc_id, 'URS' || upper(lpad(to_hex(id), 10, '0')) AS upi, m AS md5 FROM d JOIN (SELECT * FROM k UNION ALL SELECT * FROM n) USING (m)",
)
def _(t):
    staged = _staged(t)
    known = staged.where("doc_id % 3 = 0").groupBy("md5").agg(F.min(F.struct("len", "seq_short", "seq_long")).alias("r")).select("md5", "r.*")
    known = R.dense_ids(known, "md5", "id").withColumn("upi", identifiers.urs(F.col("id")))
    _, filled = release.load_sequences(known, staged)
    return filled.select("doc_id", "upi", "md5")


@query("md5_new_sequences", "SELECT md5(text) AS md5, count(*) AS n, count(DISTINCT text) AS kinds, min(length(text))::BIGINT AS len FROM documents GROUP BY 1")
def _(t):
    s = _staged(t)
    return s.groupBy("md5").agg(F.count("*").alias("n"), F.count_distinct(release.sequence_of()).alias("kinds"), F.min("len").alias("len"))


def _xref(t):
    """The first order of each customer and priority as the state before, those of later orders as staged."""
    o = t("orders").select((F.length("o_orderpriority") % 3).cast("int").alias("dbid"), F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("ac"), F.concat(F.lit("U"), (F.col("o_orderkey") % 7).cast("string")).alias("upi"), (F.col("o_orderkey") % 2).cast("int").alias("version"), F.col("o_custkey").alias("taxid"), "o_orderkey")
    old = R.distinct_on(o.where("o_orderkey % 5 < 3"), ["dbid", "ac"], "o_orderkey").select("dbid", "ac", "upi", "version", F.lit(1).alias("version_i"), F.lit(1).alias("created"), F.lit(1).alias("last"), F.when(F.col("o_orderkey") % 11 == 0, "Y").otherwise("N").alias("deleted"), "taxid")
    new = R.distinct_on(o.where("o_orderkey % 5 > 1"), ["dbid", "ac", "upi"], "o_orderkey").select("dbid", "ac", "upi", "version", "taxid")
    return old, new


_XREF = """WITH o AS (SELECT (length(o_orderpriority) % 3)::INT AS dbid, 'A' || o_custkey AS ac, 'U' || (o_orderkey % 7) AS upi, (o_orderkey % 2)::INT AS version, o_custkey AS taxid, o_orderkey FROM orders),
x AS (SELECT dbid, ac, upi, version, 1 AS version_i, 1 AS created, 1 AS last, CASE WHEN o_orderkey % 11 = 0 THEN 'Y' ELSE 'N' END AS deleted, taxid FROM (SELECT *, row_number() OVER (PARTITION BY dbid, ac ORDER BY o_orderkey) AS n FROM o WHERE o_orderkey % 5 < 3) WHERE n = 1),
s AS (SELECT dbid, ac, upi, version, taxid FROM (SELECT *, row_number() OVER (PARTITION BY dbid, ac, upi ORDER BY o_orderkey) AS n FROM o WHERE o_orderkey % 5 > 1) WHERE n = 1),
j AS (SELECT x.*, s.version AS sv, s.taxid AS st, s.upi IS NOT NULL AS hit FROM x LEFT JOIN s ON s.dbid = x.dbid AND s.ac = x.ac AND s.upi = x.upi WHERE x.deleted = 'N'),
h AS (SELECT dbid, ac, max(version_i) AS m, max(upi) AS u, bool_or(deleted = 'N') AS act FROM x GROUP BY dbid, ac),
r AS (SELECT dbid, ac, upi, version, version_i, created, last, deleted, taxid FROM x WHERE deleted = 'Y'
UNION ALL SELECT dbid, ac, upi, version, version_i, created, CASE WHEN hit AND version = sv THEN 2 ELSE 1 END, CASE WHEN hit AND version = sv THEN 'N' ELSE 'Y' END, taxid FROM j
UNION ALL SELECT dbid, ac, upi, sv, version_i, 2, 2, 'N', st FROM j WHERE hit AND version <> sv
UNION ALL SELECT s.dbid, s.ac, s.upi, s.version, CASE WHEN m IS NULL THEN 1 WHEN NOT act AND u = s.upi THEN m ELSE m + 1 END, 2, 2, 'N', s.taxid FROM s LEFT JOIN h ON h.dbid = s.dbid AND h.ac = s.ac WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.dbid = s.dbid AND j.ac = s.ac AND j.upi = s.upi))"""


@query("op_load_xref_full", _XREF + " SELECT * FROM r")
def _(t):
    old, new = _xref(t)
    return release.load_xref(old, new, 2, 1)


@query("op_load_xref_incremental", _XREF + " SELECT * FROM r WHERE NOT (deleted = 'Y' AND EXISTS (SELECT 1 FROM x WHERE x.deleted = 'N' AND x.dbid = r.dbid AND x.ac = r.ac AND x.upi = r.upi AND x.version_i = r.version_i AND x.created = r.created) AND NOT EXISTS (SELECT 1 FROM s WHERE s.dbid = r.dbid AND s.ac = r.ac)) UNION ALL SELECT * FROM x WHERE deleted = 'N' AND NOT EXISTS (SELECT 1 FROM s WHERE s.dbid = x.dbid AND s.ac = x.ac)")
def _(t):
    old, new = _xref(t)
    return release.load_xref_incremental(old, new, 2)


@query("op_release_stats", _XREF + ", f AS (SELECT dbid, ac, min(created) AS first, count(*) FILTER (created = 2 AND deleted = 'N') AS new, count(*) FILTER (deleted = 'Y' AND last = 1) AS gone, count(*) FILTER (deleted = 'N' AND created < 2) AS kept FROM r GROUP BY ALL) SELECT dbid, sum(new)::BIGINT AS created, sum(gone)::BIGINT AS retired, sum(kept)::BIGINT AS kept, sum(CASE WHEN first < 2 THEN new ELSE 0 END)::BIGINT AS with_predecessor FROM f GROUP BY dbid")
def _(t):
    old, new = _xref(t)
    return release.release_stats(release.load_xref(old, new, 2, 1), 2)


@query("op_release_driver", _XREF + ", d AS (SELECT dbid, row_number() OVER (ORDER BY dbid) + 1 AS id FROM (SELECT DISTINCT dbid FROM s)) SELECT r.dbid, ac, upi, version, version_i, CASE WHEN created = 2 THEN id ELSE created END::INT AS created, CASE WHEN last = 2 THEN id ELSE last END::INT AS last, deleted FROM r LEFT JOIN d ON d.dbid = r.dbid")
def _(t):
    old, new = _xref(t)
    return release.run_releases(old, new, 2)[0].drop("taxid")


@query("op_expunge", _XREF + " SELECT count(*) AS n FROM x")
def _(t):
    old, new = _xref(t)
    state = release.load_xref(old, new, 2, 1)
    for dbid in (0, 1, 2):
        state = release.expunge(state, dbid, 2, 2, 1)
    return state.agg(F.count("*").alias("n"))


@query("op_release_lookup", "SELECT n_nationkey AS id, n_regionkey AS dbid, lag(n_nationkey) OVER w AS previous, lead(n_nationkey) OVER w AS next FROM nation WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_nationkey)")
def _(t):
    r = t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("dbid"), F.lit("D").alias("status"))
    return release.release_lookup(r).select("id", "dbid", "previous", "next")


@query("op_total_active_upi", "SELECT dbid, count(DISTINCT upi) AS n FROM (SELECT (length(o_orderpriority) % 3)::INT AS dbid, o_custkey AS upi, year(o_orderdate) AS last FROM orders) o WHERE last >= (SELECT max(r) FROM (SELECT DISTINCT (length(o_orderpriority) % 3)::INT AS d, year(o_orderdate) AS r FROM orders WHERE o_orderstatus = 'F') x WHERE x.d = o.dbid) GROUP BY dbid")
def _(t):
    o = t("orders").select((F.length("o_orderpriority") % 3).cast("int").alias("dbid"), F.col("o_custkey").alias("upi"), F.year("o_orderdate").alias("last"), "o_orderstatus")
    return release.active_upi(o, o.where("o_orderstatus = 'F'").select("dbid", F.col("last").alias("id"), F.lit("F").alias("release_type")))


@query("op_healthchecks", "SELECT 'orders without lines' AS check_name, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS bad")
def _(t):
    rna = t("orders").select(F.col("o_orderkey").cast("string").alias("upi"), F.col("o_orderkey").cast("string").alias("md5"), F.col("o_orderkey").alias("id"))
    xref = t("lineitem").select(F.lit(1).alias("dbid"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ac"), F.col("l_orderkey").cast("string").alias("upi"), F.lit("N").alias("deleted"), F.lit(1).alias("taxid"))
    checks = release.healthchecks(rna, xref, xref, xref.select("ac"), xref.select("ac"))
    return checks.where("check_name = 'rna without xref'").select(F.lit("orders without lines").alias("check_name"), "bad")


@query("op_release_check", "SELECT coalesce(a.dbid, b.dbid) AS dbid, coalesce(n, 0) AS n_before, coalesce(m, 0) AS n_after, coalesce(abs(m - n) / n <= 0.3, false) AS ok FROM (SELECT o_custkey % 9 AS dbid, count(*) AS n FROM orders GROUP BY 1) a FULL JOIN (SELECT o_custkey % 9 AS dbid, count(*) AS m FROM orders WHERE o_orderkey % 3 > 0 OR o_custkey % 9 < 3 GROUP BY 1) b ON a.dbid = b.dbid")
def _(t):
    o = t("orders").select((F.col("o_custkey") % 9).alias("dbid"), "o_orderkey")
    return release.release_changes(o, o.where("o_orderkey % 3 > 0 OR dbid < 3")).drop("change")


@query("scd2_close_open", "SELECT o_custkey, count(*) AS versions, min(y) AS first, max(y) AS last, bool_or(p < y) AS has_predecessor FROM (SELECT o_custkey, year(o_orderdate) AS y, min(year(o_orderdate)) OVER (PARTITION BY o_custkey) AS p FROM orders) GROUP BY o_custkey")
def _(t):
    return t("orders").groupBy("o_custkey").agg(F.count("*").alias("versions"), F.min(F.year("o_orderdate")).cast("long").alias("first"), F.max(F.year("o_orderdate")).cast("long").alias("last"), (F.min(F.year("o_orderdate")) < F.max(F.year("o_orderdate"))).alias("has_predecessor"))


@query("op_update_accessions", "SELECT l_partkey AS accession, max(l_orderkey) AS latest FROM lineitem GROUP BY l_partkey UNION ALL SELECT p_partkey, -1 FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)")
def _(t):
    target = t("part").select(F.col("p_partkey").alias("accession"), F.lit(-1).cast("long").alias("latest"))
    staged = t("lineitem").select(F.col("l_partkey").alias("accession"), F.col("l_orderkey").alias("latest"))
    return R.upsert(target, R.distinct_on(staged, "accession", F.desc("latest")), "accession", changed=["latest"])


@query("op_update_references", "SELECT md5(event_type) AS md5, count(DISTINCT user_id) AS n FROM events WHERE event_type <> 'click' GROUP BY 1")
def _(t):
    e = t("events").select(F.md5("event_type").alias("md5"), "user_id", "event_type")
    new = e.join(e.where("event_type = 'click'").select("md5").distinct(), "md5", "left_anti")
    return new.groupBy("md5").agg(F.count_distinct("user_id").alias("n"))


@query("op_populate_precompute", "SELECT DISTINCT 'U' || o_custkey || '_' || c_nationkey AS urs_taxid FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def _(t):
    loaded = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    known = t("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    rows = t("orders").join(loaded, "o_orderkey", "left_semi").join(known, "o_custkey", "left_anti").join(t("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return rows.select(F.concat(F.lit("U"), F.col("o_custkey").cast("string"), F.lit("_"), F.col("c_nationkey").cast("string")).alias("urs_taxid")).distinct()


def _exons(t):
    start = (F.col("l_orderkey") * 10 + F.col("l_linenumber") * 1000).cast("long")
    return t("lineitem").select("l_orderkey", F.struct(start.alias("start"), (start + F.col("l_quantity")).cast("long").alias("stop")).alias("exon"), F.col("l_returnflag"), "l_linenumber")


@query(
    "op_regions",
    """WITH e AS (SELECT DISTINCT l_orderkey AS k, l_orderkey * 10 + l_linenumber * 1000 AS a, l_orderkey * 10 + l_linenumber * 1000 + l_quantity::BIGINT AS b FROM lineitem)
    SELECT 'U' || k || '@c' || (k % 5) || '/' || string_agg(a || '-' || b, ',' ORDER BY a, b) || ':+' AS region_name, min(a) AS region_start, max(b) AS region_stop, count(*) AS exon_count FROM e WHERE k % 3 <> 2 GROUP BY k""",
)
def _(t):
    k = F.col("l_orderkey").cast("string")
    staged = _exons(t).select(F.concat(F.lit("A"), k).alias("accession"), F.lit(None).cast("string").alias("urs_taxid"), F.lit("?").alias("region_name"), F.concat(F.lit("c"), (F.col("l_orderkey") % 5).cast("string")).alias("chromosome"), F.lit(1).alias("strand"), F.concat(F.lit("g"), (F.col("l_orderkey") % 3).cast("string")).alias("assembly_id"), F.col("exon.start").alias("exon_start"), F.col("exon.stop").alias("exon_stop"))
    xref = t("orders").select(F.concat(F.lit("A"), F.col("o_orderkey").cast("string")).alias("ac"), F.concat(F.lit("U"), F.col("o_orderkey").cast("string")).alias("upi"), F.lit(1).alias("taxid"), F.lit("N").alias("deleted"))
    # two assemblies; the second is staged by its other name
    assemblies = t("region").where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "g0").otherwise("h1").alias("assembly_id"), F.when(F.col("r_regionkey") == 1, "g1").alias("ucsc_id"))
    regions, _exon_rows = post_release.load_regions(staged, xref, assemblies, staged.select("region_name", "assembly_id").limit(0))
    return regions.select("region_name", "region_start", "region_stop", F.col("exon_count").cast("long").alias("exon_count"))


@query(
    "op_related_sequences",
    """SELECT source, target, CASE WHEN target IN (SELECT 'P' || p_partkey FROM part WHERE p_partkey % 2 = 0) THEN 'protein' ELSE 'other' END AS kind, list(DISTINCT m ORDER BY m) AS methods FROM (SELECT 'S' || l_suppkey AS source, 'P' || l_partkey AS target, l_returnflag AS m FROM lineitem) GROUP BY ALL""",
)
def _(t):
    staged = t("lineitem").select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("source"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("target"), F.lit("x").alias("relationship_type"), F.array("l_returnflag").alias("methods"))
    proteins = t("part").where("p_partkey % 2 = 0").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("target"))
    none = t("region").limit(0).select(F.col("r_name").alias("ac"), F.col("r_name").alias("upi"), F.lit(1).alias("taxid"), F.lit("N").alias("deleted"), F.col("r_name").alias("gene"))
    out = post_release.related_sequences(staged, proteins, none, none.select("gene", "ac"))
    return out.select("source", "target", F.col("target_kind").alias("kind"), "methods")


@query("op_compara", "SELECT dense_rank() OVER (ORDER BY c_mktsegment) AS homology_id, 'U' || c_custkey AS urs_taxid FROM customer WHERE c_custkey % 4 <> 0")
def _(t):
    staged = t("customer").select(F.col("c_mktsegment").alias("homology_group"), F.col("c_custkey").alias("ac"))
    known = t("customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("ac"), F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("urs_taxid"))
    return post_release.homology_groups(staged, known)


@query("op_simple_post_release", "SELECT c_nationkey AS k, min(c_custkey) AS v FROM customer GROUP BY 1 UNION ALL SELECT n_nationkey, -1 FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)")
def _(t):
    target = t("nation").select(F.col("n_nationkey").alias("k"), F.lit(-1).cast("long").alias("v"))
    return post_release.replace_table(target, t("customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("v")), ["k"], ["v"])


@query("op_genome_mapping_post", "SELECT n_nationkey AS assembly_id, (SELECT max(c_custkey) FROM customer WHERE c_nationkey = n_nationkey) AS region_start FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)")
def _(t):
    used = t("customer").select(F.col("c_nationkey").alias("assembly_id"))
    examples = t("customer").select(F.col("c_nationkey").alias("assembly_id"), F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("chromosome"), F.col("c_custkey").alias("region_start"), (F.col("c_custkey") + 10).alias("region_stop"))
    return post_release.clean_assemblies(t("nation").select(F.col("n_nationkey").alias("assembly_id")), used, examples).select("assembly_id", "region_start")


@query("op_unmapped", "SELECT 'D' || doc_id AS urs_taxid FROM documents WHERE n_chars BETWEEN 20 AND 5000 AND lang = 'en' AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 UNION SELECT doc_id FROM labels WHERE toxic = 1)")
def _(t):
    name = F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("urs_taxid")
    docs = t("documents").select(name, F.col("n_chars").alias("len"), (F.col("lang") == "en").alias("is_active"))
    return post_release.unmapped(docs, t("labels").where("quality = 1").select(name), t("labels").where("toxic = 1").select(name), 20, 5000)


@query("op_blat_select", "WITH h AS (SELECT l_partkey AS upi, l_orderkey, l_linenumber, (50 - l_linenumber)::DOUBLE / 50 AS f, l_quantity AS q FROM lineitem), k AS (SELECT * FROM h WHERE f > 0.95 AND q <= 25) SELECT upi, l_orderkey, l_linenumber FROM (SELECT *, rank() OVER (PARTITION BY upi ORDER BY f DESC) AS r FROM k) WHERE r = 1")
def _(t):
    hits = t("lineitem").select(F.col("l_partkey").alias("upi"), "l_orderkey", "l_linenumber", (50 - F.col("l_linenumber")).alias("matches"), F.lit(50).alias("length"), F.col("l_quantity").alias("insertions"))
    return post_release.select_alignments(hits).select("upi", "l_orderkey", "l_linenumber")


@query("op_accession_table", "SELECT 'U' || o_custkey || '_' || c_nationkey AS urs_taxid, o_orderkey AS ac, c_mktsegment AS database, o_orderstatus <> 'F' AS is_active FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0")
def _(t):
    xref = t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).select(F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("upi"), F.col("c_nationkey").alias("taxid"), F.col("o_orderkey").alias("ac"), F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("deleted"), F.lit(1).alias("last"))
    acc = t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).select(F.col("o_orderkey").alias("ac"), F.col("c_mktsegment").alias("database"), F.lit("x").alias("rna_type"), F.lit("d").alias("description"), F.lit("g").alias("gene"), F.lit("s").alias("species"))
    wanted = t("customer").where("c_acctbal > 0").select(F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("upi"))
    return precompute.accession_table(xref, acc, wanted).select("urs_taxid", "ac", "database", "is_active")


@query("op_metadata_merge", "SELECT c_custkey AS urs_taxid, max(year(o_orderdate)) AS last_release, bool_and(o_orderstatus = 'F') AS deleted, count(*) AS n_accessions, any_value(l.quality) AS quality FROM customer JOIN orders ON o_custkey = c_custkey LEFT JOIN labels l ON l.doc_id = c_custkey GROUP BY c_custkey")
def _(t):
    acc = t("orders").select(F.col("o_custkey").alias("urs_taxid"), F.year("o_orderdate").cast("long").alias("last"), (F.col("o_orderstatus") != "F").alias("is_active"), F.col("o_orderkey").alias("ac"), F.lit("d").alias("database"), F.lit("t").alias("rna_type"), F.lit("x").alias("description"))
    base = t("customer").select(F.col("c_custkey").alias("urs_taxid"))
    merged = precompute.merged_metadata(base, acc, {"qa": (t("labels").select(F.col("doc_id").alias("urs_taxid"), "quality"), "zero_or_one")})
    return merged.select("urs_taxid", "last_release", "deleted", F.size("accessions").cast("long").alias("n_accessions"), "qa.quality")


@query("op_orf_calls", "SELECT l_orderkey, l_linenumber, (l_discount >= 0.05 AND l_returnflag = 'A') AS cpat_orf, l_tax <= 0.02 AS stopfree_orf FROM lineitem")
def _(t):
    df = t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("coding_prob"), F.when(F.col("l_returnflag") == "A", "+").otherwise("-").alias("strand"), F.col("l_tax").alias("run_probability"), F.lit(1.0).alias("tcode_mean"), F.lit(None).cast("double").alias("tcode_sd"))
    return precompute.orf_calls(df, 0.05, 0.02).select("l_orderkey", "l_linenumber", "cpat_orf", "stopfree_orf")


@query("op_completeness", "SELECT l_orderkey, l_linenumber, round(abs(l_quantity - l_linenumber) / 50, 6) AS sequence_completeness, round(abs(l_linenumber - 1) / 7.0, 6) AS model_completeness FROM lineitem")
def _(t):
    df = t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_linenumber").cast("double").alias("sequence_start"), F.col("l_quantity").alias("sequence_stop"), F.lit(50.0).alias("len"), F.lit(1.0).alias("model_start"), F.col("l_linenumber").cast("double").alias("model_stop"), F.lit(7.0).alias("model_length"))
    c = precompute.completeness(df)
    return c.select("l_orderkey", "l_linenumber", F.round("sequence_completeness", 6).alias("sequence_completeness"), F.round("model_completeness", 6).alias("model_completeness"))


@query(
    "qa_flags",
    """SELECT d.doc_id, (CASE WHEN n_chars < 500 THEN NULL ELSE quality = 0 END) AS possible_orf, (lang = 'en' AND n_chars % 2 = 0) AS incomplete_sequence, (lang = 'fr' AND n_chars % 2 = 1) AS missing_rfam_match,
    (coalesce(n_chars >= 500 AND quality = 0, false) OR (lang = 'en' AND n_chars % 2 = 0) OR (lang = 'fr' AND n_chars % 2 = 1)) AS has_issue FROM documents d LEFT JOIN labels USING (doc_id)""",
)
def _(t):
    docs = t("documents").select("doc_id", "lang", "n_chars").join(t("labels"), "doc_id", "left")
    hit = F.array(F.struct(F.lit("RF00001").alias("model"), F.lit(None).cast("string").alias("domain"), F.lit(0.95).alias("sequence_completeness"), F.when((F.col("lang") == "en") & (F.col("n_chars") % 2 == 0), 0.4).otherwise(0.9).alias("model_completeness")))
    none = F.array().cast("array<struct<model:string,domain:string,sequence_completeness:double,model_completeness:double>>")
    null = F.lit(None).cast("boolean")
    df = docs.select(
        "doc_id", F.when(F.col("lang") == "fr", "rRNA").otherwise("other").alias("rna_type"), F.array().cast("array<string>").alias("domains"), F.when((F.col("lang") == "fr") & (F.col("n_chars") % 2 == 1), none).otherwise(hit).alias("hits"),
        F.lit(False).alias("is_mitochondrial"), F.lit(False).alias("is_chloroplast"), null.alias("in_repeat"), F.when(F.col("n_chars") >= 500, F.col("quality") == 0).alias("cpat_orf"), null.alias("stopfree_orf"), null.alias("tcode_orf"),
    )
    return precompute.qa_flags(df, {"rRNA": ["RF00001"]}).select("doc_id", "possible_orf", "incomplete_sequence", "missing_rfam_match", "has_issue")


@query("op_rna_type")
def _(t):
    rows = t("events").select(F.col("user_id").cast("string").alias("urs_taxid"), F.col("event_id").alias("place"), F.when(F.col("event_id") % 3 == 0, F.array(F.lit("ncRNA"), F.lit("rRNA"))).when(F.col("event_id") % 3 == 1, F.array(F.lit("ncRNA"))).otherwise(F.array(F.lit("ncRNA"), F.lit("lnc_RNA"))).alias("path"), F.when(F.col("event_type") == "click", "mod").otherwise("generic").alias("source"))
    return precompute.decide_type(precompute.merge_type_paths(rows))


@query("op_rna_type_insdc", "SELECT * FROM (SELECT user_id, list_sort([v for v in y if v <> 'misc_RNA' AND v <> 'other']) AS types FROM (SELECT user_id, list(DISTINCT CASE event_type WHEN 'click' THEN 'misc_RNA' WHEN 'view' THEN 'other' ELSE event_type END) AS y FROM events GROUP BY 1)) WHERE len(types) > 0")
def _(t):
    kind = F.when(F.col("event_type") == "click", "misc_RNA").when(F.col("event_type") == "view", "other").otherwise(F.col("event_type"))
    g = t("events").groupBy("user_id").agg(F.collect_set(kind).alias("t"))
    return g.select("user_id", F.array_sort(precompute.rewrite_types(F.col("t"))).alias("types")).where(~F.arrays_overlap("types", F.array(F.lit("misc_RNA"), F.lit("other"))))


@query("op_description")
def _(t):
    rows = t("documents").select(F.col("source").alias("urs_taxid"), F.col("lang").alias("database"), F.col("text").alias("description"))
    return precompute.best_descriptions(rows, ["de", "fr", "en"])


@query("op_short_description", "SELECT n_nationkey, CASE WHEN starts_with(lower(r_name || ' ' || n_name), lower(r_name)) THEN trim(substr(r_name || ' ' || n_name, length(r_name) + 1)) END AS short FROM nation JOIN region ON r_regionkey = n_regionkey")
def _(t):
    from ..functions import text

    rows = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("n_nationkey", text.strip_leading(F.concat_ws(" ", "r_name", "n_name"), F.col("r_name")).alias("short"))


@query(
    "op_generic_update",
    """WITH b AS (SELECT o_custkey AS upi, o_orderkey AS taxid, o_orderstatus = 'O' AS act, o_orderpriority AS p FROM orders), s AS (SELECT *, bool_or(act) OVER (PARTITION BY upi) AS any_act FROM b)
    SELECT upi, bool_or(act) AS is_active, CASE WHEN count(DISTINCT p) = 1 THEN min(p) ELSE 'ncRNA' END AS rna_type, list(DISTINCT p ORDER BY p) AS databases, count(DISTINCT taxid) AS n_species FROM s WHERE act OR NOT any_act GROUP BY upi""",
)
def _(t):
    rows = t("orders").select(F.col("o_custkey").alias("upi"), F.col("o_orderkey").alias("taxid"), (F.col("o_orderstatus") == "O").alias("is_active"), F.col("o_orderpriority").alias("rna_type"), F.lit("SO:1").alias("so_type"), F.array("o_orderpriority").alias("databases"), F.lit("d").alias("description"), F.lit(1).alias("last_release"))
    return precompute.rolled_up(rows).select("upi", "is_active", "rna_type", "databases", "n_species")


@query("op_inactive_update", "SELECT o_orderkey AS urs_taxid, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'was' END, o_orderpriority) AS rna_type FROM orders WHERE o_orderstatus <> 'O'")
def _(t):
    rows = t("orders").select(F.col("o_orderkey").alias("urs_taxid"), (F.col("o_orderstatus") == "O").alias("is_active"), F.col("o_orderpriority").alias("rna_type"), F.lit("d").alias("description"))
    previous = t("orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("urs_taxid"), F.lit("was").alias("rna_type"), F.lit("e").alias("description"))
    return precompute.inactive_rows(rows, previous).select("urs_taxid", "rna_type")


@query("op_should_show", "SELECT p_partkey, round_even(p_size / 25.0, 1) BETWEEN 0.4 AND 1.6 AS should_show FROM part")
def _(t):
    df = t("part").select("p_partkey", F.col("p_size").cast("double").alias("base_pairs"), F.lit(25.0).alias("model_base_pairs"))
    return precompute.should_show(df).select("p_partkey", "should_show")


@query("op_so_tree", "WITH RECURSIVE e AS (SELECT 'n' || n_nationkey AS term, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 'r' || r_regionkey, 'root' FROM region), p AS (SELECT 'root' AS term, ['root'] AS path UNION ALL SELECT e.term, list_append(p.path, e.term) FROM e JOIN p ON e.parent = p.term) SELECT * FROM p")
def _(t):
    edges = t("nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("term"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent"))
    edges = edges.unionByName(t("region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("term"), F.lit("root").alias("parent")))
    return precompute.ontology_paths(edges, ["root"])


def _transcripts(t):
    """Orders as transcripts: exons from their line items, near each other by order key."""
    start = (F.col("l_orderkey") * 40 + F.col("l_linenumber") * 60).cast("long")
    exon = F.struct(start.alias("start"), (start + F.col("l_quantity")).cast("long").alias("stop"))
    g = t("lineitem").groupBy(F.col("l_orderkey").alias("idx")).agg(F.sort_array(F.collect_list(exon)).alias("exons"), F.min(start).alias("region_start"), F.max((start + F.col("l_quantity")).cast("long")).alias("region_stop"))
    return g.select("idx", F.concat(F.lit("T"), F.col("idx").cast("string")).alias("region_name"), "region_start", "region_stop", F.lit("1").alias("chromosome"), F.lit("g").alias("assembly_id"), F.when(F.col("idx") % 2 == 0, 1).otherwise(-1).alias("strand"), F.concat(F.lit("t"), (F.col("idx") % 3).cast("string")).alias("so_type"), "exons")


def _features(t):
    types = t("region").where("r_regionkey < 3").select(F.concat(F.lit("t"), F.col("r_regionkey").cast("string")).alias("so_type"))
    paths = types.select(F.col("so_type").alias("term"), F.array(F.lit("root"), F.col("so_type")).alias("path"))
    return genes.pair_features(_transcripts(t), genes.type_similarity(types, paths), 200)


@query(
    "op_gene_features",
    """WITH e AS (SELECT l_orderkey AS k, l_orderkey * 40 + l_linenumber * 60 AS a, l_orderkey * 40 + l_linenumber * 60 + l_quantity::BIGINT AS b FROM lineitem),
    g AS MATERIALIZED (SELECT k, min(a) AS s, list(a ORDER BY a, b) AS aa, list(b ORDER BY a, b) AS bb, CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END AS at FROM e GROUP BY k),
    p AS MATERIALIZED (SELECT x.k AS ka, y.k AS kb, x.aa AS xa, x.bb AS xb, y.aa AS ya, y.bb AS yb, x.aa[x.at] AS x1, x.bb[x.at] AS x2, y.aa[y.at] AS y1, y.bb[y.at] AS y2 FROM g x JOIN g y ON x.k < y.k AND x.at = y.at AND abs(x.s - y.s) <= 200)
    SELECT 'T' || ka || ' vs T' || kb AS comparison,
    len([i for i in range(1, least(len(xa), len(ya)) + 1) if least(xb[i], yb[i]) > greatest(xa[i], ya[i]) AND least((least(xb[i], yb[i]) - greatest(xa[i], ya[i]))::FLOAT / (xb[i] - xa[i])::FLOAT, (least(xb[i], yb[i]) - greatest(xa[i], ya[i]))::FLOAT / (yb[i] - ya[i])::FLOAT) >= 0.9::FLOAT]) AS exons_overlapping,
    abs(x1 - y1) AS five_prime_start_gap, abs(x2 - y2) AS five_prime_stop_gap, round(least(greatest(least(x2, y2) - greatest(x1, y1), 0) / (x2 - x1), greatest(least(x2, y2) - greatest(x1, y1), 0) / (y2 - y1)), 6) AS five_prime_overlap,
    CASE WHEN ka % 3 = kb % 3 THEN 1.0 ELSE 0.5 END::FLOAT AS type_sim FROM p""",
)
def _(t):
    return _features(t).select("comparison", "exons_overlapping", "five_prime_start_gap", "five_prime_stop_gap", F.round("five_prime_overlap", 6).alias("five_prime_overlap"), "type_sim")


def _forest():
    import numpy as np

    rng = np.random.default_rng(3)
    x = np.stack([rng.random(400), rng.integers(0, 300, 400), rng.integers(0, 300, 400), rng.integers(0, 4, 400), np.ones(400), rng.choice([0.5, 1.0], 400)], 1)
    y = ((x[:, 0] > 0.3) | (x[:, 3] > 1) | (x[:, 1] < 60)).astype(float)
    return genes.Forest.fit(x, y)


@query("op_gene_classify")
def _(t):
    return genes.classify(_features(t), _forest()).select("comparison", "probability", "prediction")


@query("op_gene_communities")
def _(t):
    hits = genes.classify(_features(t), _forest()).where("prediction = 1")
    # both of a pair are on one chromosome
    places = _transcripts(t).select(F.col("idx").alias("a"), "assembly_id", "chromosome")
    edges = hits.select(F.col("idx_a").alias("a"), F.col("idx_b").alias("b"), F.col("probability").alias("weight")).join(places, "a")
    return genes.communities(edges, ["assembly_id", "chromosome"])


def _genes(t, modulus, shift):
    x = _transcripts(t).where(F.col("idx") % modulus < modulus - 1)
    return x.select(F.concat(F.lit(f"G{shift}-"), F.col("idx").cast("string")).alias("name"), F.array("region_name").alias("members"), "assembly_id", "chromosome", "strand", F.col("region_start").alias("start"), (F.col("region_stop") + F.when(F.col("idx") % 7 == 0, shift).otherwise(0)).alias("stop"))


@query("op_gene_name")
def _(t):
    x = _transcripts(t).select(F.col("idx").cast("string").alias("gene"), "region_name", "chromosome", "assembly_id", "strand", F.col("region_start").alias("start"), F.col("region_stop").alias("stop"), F.lit("HS").alias("prefix"))
    return genes.named_genes(x).select("name", "version", "start", "stop")


@query("op_gene_merge")
def _(t):
    old = _genes(t, 4, 0).withColumns({"version": F.lit(1), "first_release": F.lit(1), "last_release": F.lit(1)})
    return genes.merge_genes(old, _genes(t, 5, 1), 2, 100, 0.9).select("name", "version", "first_release", "is_active")


@query("op_gene_store", "SELECT 'T' || (l_orderkey % 50) AS gene, 'M' || l_partkey AS member FROM lineitem WHERE l_orderkey % 50 < 25 GROUP BY ALL UNION ALL SELECT DISTINCT 'T' || (l_orderkey % 50), 'old' FROM lineitem WHERE l_orderkey % 50 >= 25")
def _(t):
    line = t("lineitem").select(F.concat(F.lit("T"), (F.col("l_orderkey") % 50).cast("string")).alias("name"), F.concat(F.lit("M"), F.col("l_partkey").cast("string")).alias("m"), (F.col("l_orderkey") % 50).alias("n"))
    stored = line.select(F.col("name").alias("gene"), F.lit("old").alias("member")).distinct()
    return genes.store_members(stored, line.where("n < 25").groupBy("name").agg(F.collect_set("m").alias("members")))


@query("op_gene_metadata", "SELECT s_nationkey AS gene, arg_max(s_name, (round(s_acctbal * 100), s_name)) AS description FROM supplier GROUP BY 1")
def _(t):
    c = t("supplier").select(F.col("s_nationkey").alias("gene"), F.lit("x").alias("database"), F.col("s_name").alias("description"), F.round(F.col("s_acctbal") * 100).alias("entropy"), F.lit("SO:1").alias("so_type"), F.lit(1).alias("depth"), F.lit(0.5).alias("overlap"))
    weights = t("region").limit(1).select(F.lit("x").alias("database"), F.lit(0.0).alias("weight"))
    return genes.gene_metadata(c, weights).select("gene", "description")


@query("op_gene_train", "SELECT count(*) AS genes FROM nation WHERE n_nationkey % 2 = 0")
def _(t):
    g = t("nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("id"), F.array("n_nationkey").alias("members"), F.lit("g").alias("assembly_id"), (F.col("n_nationkey") * 100).cast("long").alias("start"), (F.col("n_nationkey") * 100 + 50).cast("long").alias("stop"))
    x = t("nation").select(F.col("n_nationkey").alias("id"), F.lit("g").alias("assembly_id"), (F.col("n_nationkey") * 100).cast("long").alias("start"), (F.col("n_nationkey") * 100 + 50).cast("long").alias("stop"))
    return genes.training_pairs(g, x, 150).where("label = 1").agg(F.count_distinct("gene").alias("genes"))


@query("op_search_merge", "SELECT c_custkey AS urs_taxid, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders, quality FROM customer LEFT JOIN labels ON doc_id = c_custkey")
def _(t):
    base = t("customer").select(F.col("c_custkey").alias("urs_taxid"))
    docs = export.search_documents(base, {"orders": (t("orders").select(F.col("o_custkey").alias("urs_taxid"), "o_orderkey"), "any"), "qa": (t("labels").select(F.col("doc_id").alias("urs_taxid"), "quality"), "zero_or_one")})
    return docs.select("urs_taxid", F.size("orders").cast("long").alias("n_orders"), "qa.quality")


@query("op_search_boost", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_custkey % 10 = 1 THEN 3 WHEN o_custkey % 10 IN (2, 3) THEN 2 ELSE 1 END - CASE WHEN o_orderpriority = '5-LOW' THEN 0.5 ELSE 0 END::DOUBLE AS boost FROM orders")
def _(t):
    b = export.boost(F.col("o_custkey") % 10, F.col("o_orderstatus") != "F", F.when(F.col("o_orderpriority") == "5-LOW", "other").otherwise("x"), F.array().cast("array<string>"), F.lit(None).cast("boolean"), 1, (2, 3))
    return t("orders").select("o_orderkey", b.alias("boost"))


@query("op_search_genes", "SELECT c_nationkey AS gene, count(DISTINCT c_custkey) AS member_count, bool_or(c_acctbal > 0) AS has_literature, list(DISTINCT c_mktsegment ORDER BY c_mktsegment) AS databases FROM customer GROUP BY 1")
def _(t):
    m = t("customer").select(F.lit("g").alias("assembly_id"), F.col("c_nationkey").alias("gene"), F.lit("r").alias("region"), F.lit(1).alias("taxid"), F.col("c_custkey").cast("string").alias("urs_taxid"), (F.col("c_acctbal") > 0).alias("has_literature"), F.array("c_mktsegment").alias("databases"))
    return export.search_genes(m).select("gene", "member_count", "has_literature", "databases")


@query("op_expression", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_tax < 0.02 OR l_discount < 0.02) AND (abs(l_quantity - 25) >= 20)")
def _(t):
    df = t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_tax").cast("string").alias("a.p-value"), F.col("l_discount").cast("string").alias("b.p-value"), (F.col("l_quantity") - 25).cast("string").alias("a.log2foldchange"))
    p = [c for c in df.columns if "p-value" in c]
    folds = [c for c in df.columns if "log2fold" in c]
    return sources_plans.differential_hits(df, p, folds, 0.02, 20).select("l_orderkey", "l_linenumber")


@query("op_expression_baseline", "SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING median(l_quantity) > 30")
def _(t):
    g = t("lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.collect_list("l_quantity"), lambda x: x.cast("decimal(10,2)").cast("string")), ",").alias("g1"))
    return sources_plans.baseline_hits(g, ["g1"], 30).select("l_orderkey")


@query("op_evlnc_match", "SELECT DISTINCT c_custkey AS id, s_suppkey AS match FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_custkey % 7 = s_suppkey % 7")
def _(t):
    name = lambda c: F.array(F.concat(F.lit("n"), (F.col(c) % 7).cast("string")), F.col(c).cast("string"))
    l = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("taxid"), F.transform(name("c_custkey"), lambda x: F.concat(x, F.when(F.length(x) > 5, "").otherwise(""))).alias("names"))
    r = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("taxid"), F.array(F.concat(F.lit("n"), (F.col("s_suppkey") % 7).cast("string"))).alias("names"))
    return sources_plans.match_by_alias(l, r, "names", "names", "taxid").select("id", "match")


@query("op_reference_lookup", "SELECT o_custkey AS ref, min(o_orderkey) AS article FROM orders GROUP BY 1")
def _(t):
    articles = t("orders").select(F.array("o_custkey", -F.col("o_custkey")).alias("ids"), F.col("o_orderkey").alias("article"))
    return sources_plans.reference_lookup(t("customer").select(F.col("c_custkey").alias("ref")), articles)[0]


@query("op_reference_missing", "SELECT c_custkey AS ref FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')")
def _(t):
    articles = t("orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select(F.array("o_custkey").alias("ids"), F.col("o_orderkey").alias("article"))
    return sources_plans.reference_lookup(t("customer").select(F.col("c_custkey").alias("ref")), articles)[1]


@query("op_taxid_fallback", "SELECT c_custkey, coalesce(a.n_nationkey, b.r_regionkey + 100, -1)::BIGINT AS taxid FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) a ON a.n_nationkey = c_nationkey LEFT JOIN (SELECT n_nationkey, r_regionkey FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_regionkey < 3) b ON b.n_nationkey = c_nationkey")
def _(t):
    places = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.concat(F.lit("s"), F.col("n_nationkey").cast("string")).alias("species"), F.concat(F.lit("g"), F.col("n_regionkey").cast("string")).alias("genus"))
    lookup = t("nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit("s"), F.col("n_nationkey").cast("string")).alias("name"), F.col("n_nationkey").cast("long").alias("taxid"))
    lookup = lookup.unionByName(t("region").where("r_regionkey < 3").select(F.concat(F.lit("g"), F.col("r_regionkey").cast("string")).alias("name"), (F.col("r_regionkey") + 100).cast("long").alias("taxid")))
    return sources_plans.taxid_with_fallback(places, lookup, ["species", "genus"], -1).select("c_custkey", F.col("taxid").cast("long").alias("taxid"))


def _regions(t):
    return _transcripts(t).select(F.col("region_name").alias("rna_id"), F.concat(F.col("region_name"), F.lit(".0")).alias("region_id"), "chromosome", "strand", "exons", F.lit("ncRNA").alias("rna_type"), F.array(F.lit("b"), F.lit("a")).alias("databases"))


_EXON = "WITH e AS (SELECT l_orderkey AS k, l_orderkey * 40 + l_linenumber * 60 AS a, l_orderkey * 40 + l_linenumber * 60 + l_quantity::BIGINT AS b FROM lineitem), s AS (SELECT *, min(a) OVER (PARTITION BY k) AS lo FROM e)"


@query("sink_bed12", _EXON + " SELECT 'T' || k AS name, 'chr1' AS chrom, min(a) - 1 AS \"chromStart\", max(b) AS \"chromEnd\", count(*) AS \"blockCount\", string_agg(b - a + 1, ',' ORDER BY a, b) AS \"blockSizes\", string_agg(a - lo, ',' ORDER BY a, b) AS \"blockStarts\", CASE WHEN k % 2 = 0 THEN '+' ELSE '-' END AS strand FROM s GROUP BY k")
def _(t):
    return export.bed12(_regions(t)).select("name", "chrom", "chromStart", "chromEnd", F.col("blockCount").cast("long").alias("blockCount"), "blockSizes", "blockStarts", "strand")


@query("bed_expand", _EXON + " SELECT 'T' || k AS name, a - 1 AS \"chromStart\", b AS \"chromEnd\" FROM e")
def _(t):
    return export.bed6(export.bed12(_regions(t))).select("name", "chromStart", "chromEnd")


@query("sink_gff3", _EXON + " SELECT 'transcript' AS type, min(a) AS start, max(b) AS \"end\" FROM e GROUP BY k UNION ALL SELECT 'noncoding_exon', a, b FROM e")
def _(t):
    return export.gff3(_regions(t)).select("type", "start", "end")


@query("sink_fasta", "SELECT '>' || doc_id || ' ' || lang || chr(10) || upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS value FROM documents WHERE regexp_matches(text, '[A-Za-z]')")
def _(t):
    return export.fasta(t("documents").select(F.col("doc_id").cast("string").alias("id"), "lang", F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("s")), "id", "lang", "s", "A-Z")


@query("sink_dfasta", "SELECT '>' || p_partkey || chr(10) || p_brand || chr(10) || p_type AS value FROM part")
def _(t):
    return export.dfasta(t("part").withColumn("id", F.col("p_partkey").cast("string")), "id", "p_brand", "p_type")


@query("sink_id_mapping", "SELECT o_orderkey AS upi, CASE WHEN db = 'PDBE' THEN 'PDB' ELSE db END AS database, CASE WHEN db = 'PDBE' THEN e || '_' || o WHEN db IN ('HGNC', 'ENA') THEN a ELSE e END AS accession, CASE WHEN db = 'ENSEMBL' THEN o ELSE 'g' END AS gene FROM (SELECT o_orderkey, ['PDBE', 'HGNC', 'ENA', 'ENSEMBL'][(o_orderkey % 4 + 1)::INT] AS db, 'e' || o_custkey AS e, 'o' || o_custkey AS o, 'a' || o_orderkey AS a FROM orders)")
def _(t):
    k = F.col("o_custkey").cast("string")
    rows = t("orders").select(F.col("o_orderkey").alias("upi"), F.get(F.array(*[F.lit(x) for x in ("PDBE", "HGNC", "ENA", "ENSEMBL")]), (F.col("o_orderkey") % 4).cast("int")).alias("database"), F.concat(F.lit("e"), k).alias("external_id"), F.concat(F.lit("o"), k).alias("optional_id"), F.concat(F.lit("a"), F.col("o_orderkey").cast("string")).alias("accession"), F.lit("g").alias("gene"), F.lit("p").alias("product"), F.lit("x").alias("rna_type"), F.lit(1).alias("taxid"))
    return export.id_mapping(rows).select("upi", "database", "accession", "gene")


@query("sink_gpi", "SELECT 'U' || c_custkey AS object_id, 'taxon:' || c_nationkey AS taxon, c_mktsegment AS synonyms FROM customer WHERE c_nationkey IN (1, 2, 3)")
def _(t):
    rows = t("customer").select(F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("urs_taxid"), F.col("c_nationkey").alias("taxid"), F.col("c_name").alias("description"), F.lit("x").alias("rna_type"), F.col("c_mktsegment").alias("alias"))
    return export.gpi(rows, rows.limit(0).select("urs_taxid", F.lit("p").alias("precursor")), [1, 2, 3]).select("object_id", "taxon", "synonyms")


@query("sink_ensembl_json", "SELECT 'R' || r_regionkey AS rna_id, '{\"rna_id\":\"R' || r_regionkey || '\",\"rna_type\":\"x\",\"sequence\":\"ACGT\",\"xrefs\":[{\"database\":\"a\",\"id\":\"1\"}]}' AS document FROM region")
def _(t):
    x = lambda d, i: F.struct(F.lit(d).alias("database"), F.lit(i).alias("id"))
    rows = t("region").select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("rna_id"), F.lit("x").alias("rna_type"), F.lit("ACGT").alias("sequence"), F.array(x("a", "1"), x("a", "1"), x("z", "2")).alias("xrefs"))
    return export.ensembl_json(rows, ["a"])


@query("sink_search_xml")
def _(t):
    rows = t("region").select(F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name"), F.lit("a < b & c").alias("description"), F.create_map(F.lit("db"), F.array("r_name", F.lit("x"))).alias("fields"), F.array(F.struct(F.lit("d").alias("db"), F.lit("1").alias("id"))).alias("references"))
    return export.search_xml(rows)


@query("sink_go_terms_tsv", "SELECT c_custkey AS rna_id, c_mktsegment AS go_term, 'Rfam:' || c_nationkey AS models FROM customer WHERE c_nationkey NOT IN (3, 4)")
def _(t):
    return t("customer").where(~F.col("c_nationkey").isin(3, 4)).select(F.col("c_custkey").alias("rna_id"), F.col("c_mktsegment").alias("go_term"), F.concat(F.lit("Rfam:"), F.col("c_nationkey").cast("string")).alias("models"))


@query("sink_release_note", "SELECT (SELECT count(*) FROM documents) AS sequences, (SELECT count(*) FROM labels) AS xrefs, (SELECT count(DISTINCT source) FROM documents) AS databases")
def _(t):
    return export.release_note(t("documents"), t("labels").withColumn("deleted", F.lit("N")), t("documents").select("source").distinct())


@query("op_crs_select", _EXON.replace("AS b FROM lineitem", "AS b, l_returnflag AS flag FROM lineitem") + ", x AS (SELECT k, a, b FROM e WHERE flag = 'A'), y AS (SELECT a, b FROM e WHERE flag = 'R') SELECT k, a, b FROM x WHERE NOT EXISTS (SELECT 1 FROM y WHERE x.a < y.b AND y.a < x.b)")
def _(t):
    from ..operators import ranges

    e = _exons_near(t)
    return ranges.overlap_filter(e.where("flag = 'A'"), e.where("flag = 'R'"), ["chromosome"], 64, "id", keep=False).select("k", F.col("start").alias("a"), F.col("stop").alias("b"))


def _exons_near(t):
    start = (F.col("l_orderkey") * 40 + F.col("l_linenumber") * 60).cast("long")
    return t("lineitem").select(F.col("l_orderkey").alias("k"), F.concat_ws("-", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").cast("string"), "l_returnflag").alias("id"), F.lit("1").alias("chromosome"), F.col("l_returnflag").alias("flag"), start.alias("start"), (start + F.col("l_quantity")).cast("long").alias("stop"))


@query("op_overlap_feedback", _EXON + ", p AS (SELECT x.k % 4 AS db, x.k AS a, y.k AS b FROM e x JOIN e y ON x.a < y.b AND y.a < x.b AND x.k <> y.k) SELECT db, count(DISTINCT a) AS overlapping, count(DISTINCT b) AS others FROM p GROUP BY db")
def _(t):
    from ..operators import ranges

    e = _exons_near(t)
    pairs = ranges.overlap_join(e, e, ["chromosome"], 64).where("l_k <> r_k")
    return pairs.groupBy((F.col("l_k") % 4).alias("db")).agg(F.count_distinct("l_k").alias("overlapping"), F.count_distinct("r_k").alias("others"))


@query("op_editing_events", _EXON.replace("FROM lineitem)", "FROM (SELECT l_orderkey, l_linenumber, min(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL))") + ", x AS (SELECT k, a + 5 AS pos FROM e), g AS (SELECT k, a, b, coalesce(sum(b - a + 1) OVER (PARTITION BY k ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e) SELECT x.k, pos, (before + pos - a + 1)::BIGINT AS place FROM x JOIN g ON g.k = x.k AND pos BETWEEN a AND b")
def _(t):
    from ..functions import coordinates

    lines = t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("l_quantity"))
    exons = _transcripts(lambda _name: lines).select(F.col("idx").alias("k"), "exons")
    events = exons.select("k", "exons", F.explode("exons").alias("e")).select("k", "exons", (F.col("e.start") + 5).alias("pos"))
    placed = events.withColumn("place", coordinates.relative_position(F.col("exons"), F.lit(1), F.col("pos")))
    return placed.where("place IS NOT NULL").select("k", "pos", "place")
