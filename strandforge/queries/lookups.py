"""Lookups of single sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import lookups
from .base import cents, query

_CLASSES = [lookups.RIBOSOMAL, *lookups.GENE_CLASSES]


@query(
    "py_hgnc_so_term",
    "WITH g AS (SELECT p_partkey, p_brand, (["
    + ", ".join(f"'{c}'" for c in _CLASSES)
    + f"])[p_partkey % {len(_CLASSES)} + 1] AS c FROM part) SELECT p_partkey, CASE "
    + " ".join(f"WHEN c = '{c}' THEN '{t}'" for c, t in lookups.GENE_CLASSES.items())
    + " WHEN p_brand = 'Brand#11' THEN 'SO:0000652' WHEN p_brand = 'Brand#12' THEN 'SO:0002344' ELSE 'SO:0000252' END AS so_term FROM g",
)
def _(t):
    rna_type = F.element_at(F.array(*[F.lit(c) for c in _CLASSES]), (F.col("p_partkey") % len(_CLASSES) + 1).cast("int"))
    groups = F.when(F.col("p_brand") == "Brand#11", F.array(F.lit("5S ribosomal RNAs"))).when(F.col("p_brand") == "Brand#12", F.array(F.lit("12S RNA")))
    return t("part").select("p_partkey", lookups.gene_class_term(rna_type, groups).alias("so_term"))


@query("json_remove_element", "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || '|last' END AS rest FROM customer")
def _(t):
    values = F.array("c_name", "c_mktsegment", F.lit("last"))
    return t("customer").select("c_custkey", F.array_join(lookups.remove_array_element(values, F.lit("BUILDING")), "|").alias("rest"))


@query(
    "py_hgnc_lookup",
    "WITH a AS (SELECT o_custkey::VARCHAR AS alias, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P') SELECT alias, o_orderkey AS upi FROM (SELECT *, row_number() OVER (PARTITION BY alias ORDER BY round(o_totalprice * 100) DESC, o_orderkey) AS n FROM a) WHERE n = 1",
)
def _(t):
    rows = t("orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("upi"), cents("o_totalprice").alias("len"), "o_custkey", "o_orderpriority", "o_orderstatus")
    return lookups.longest_by_alias(rows, ["o_custkey", "o_orderpriority", "o_orderstatus"])


@query(
    "py_mirtron_pairing",
    "WITH m AS (SELECT c_custkey AS k, c_name || '-5p' AS a, c_name AS s FROM customer UNION ALL SELECT c_custkey, c_name || '-3p', c_mktsegment FROM customer), p AS (SELECT c_custkey AS k, c_name AS a, 'pre' || c_name || 'post' AS s FROM customer WHERE c_acctbal > 0) SELECT p.a AS accession, m.a AS related, 'mature_product' AS relationship, CASE WHEN strpos(p.s, m.s) > 0 THEN strpos(p.s, m.s) - 1 END AS start, CASE WHEN strpos(p.s, m.s) > 0 THEN strpos(p.s, m.s) - 1 + length(m.s) END AS stop FROM m JOIN p USING (k) UNION ALL SELECT m.a, c_name, CASE WHEN c_acctbal > 0 THEN 'precursor' END, NULL, NULL FROM m JOIN customer ON k = c_custkey",
)
def _(t):
    c = t("customer")
    entry = lambda end, kind, sequence: F.struct(F.concat("c_name", F.lit(end)).alias("accession"), F.lit(kind).alias("kind"), sequence.alias("sequence"))
    mature = c.select(F.inline(F.array(entry("-5p", "mature", F.col("c_name")), entry("-3p", "mature", F.col("c_mktsegment")))))
    pre = c.where("c_acctbal > 0").select(entry("", "precursor", F.concat(F.lit("pre"), "c_name", F.lit("post"))).alias("r")).select("r.*")
    return lookups.mirtron_relations(mature.union(pre))


@query(
    "py_weekly_report",
    "SELECT n_name AS display_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus <> 'P' AND o_orderdate::TIMESTAMP > TIMESTAMP '1996-01-01' - INTERVAL 7 DAYS GROUP BY 1",
)
def _(t):
    xref = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("dbid"), F.when(F.col("o_orderstatus") == "P", "Y").otherwise("N").alias("deleted"), F.col("o_orderdate").cast("timestamp").alias("timestamp"), F.col("o_custkey").alias("taxid")
    )
    names = t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("display_name"))
    return lookups.weekly_report(xref, names, F.expr("TIMESTAMP '1996-01-01'"))


@query(
    "py_stored_genes",
    "SELECT s_suppkey AS id, s_name AS name, string_agg(p_name, ',' ORDER BY p_name) AS members FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey WHERE s_nationkey = 3 AND s_acctbal > 0 GROUP BY 1, 2",
)
def _(t):
    genes = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("taxid"), (F.col("s_acctbal") > 0).alias("is_active"))
    members = t("lineitem").select(F.col("l_suppkey").alias("gene_id"), F.col("l_partkey").alias("locus_id"))
    regions = t("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("region_name"))
    return lookups.stored_genes(genes, members, regions, 3).select("id", "name", F.array_join("members", ",").alias("members"))


@query("sort_merge_files", "SELECT c_nationkey AS nation, c_mktsegment AS word FROM customer UNION SELECT s_nationkey, s_name FROM supplier")
def _(t):
    return lookups.merge_sorted(t("customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("word")), t("supplier").select("s_nationkey", "s_name"))


@query("py_rfam_models", "SELECT p_name AS rfam_model_id, 'rfam' AS source, 131567 AS taxid, p_brand AS so_rna_type, p_type AS rna_type FROM part WHERE p_size > 10")
def _(t):
    models = t("part").select(F.col("p_name").alias("rfam_model_id"), F.when(F.col("p_size") > 10, F.col("p_brand")).alias("so_rna_type"), F.col("p_type").alias("rna_type"))
    return lookups.rfam_models(models)


@query(
    "py_ribovision_query",
    "SELECT o_orderpriority AS pdb_id, o_orderstatus AS chain_id, 'P' || o_orderkey AS id, c_name AS sequence, c_nationkey AS taxid, c_mktsegment AS so_rna_type FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority LIKE '1%' AND o_totalprice > 1000",
)
def _(t):
    orders, customer = t("orders"), t("customer")
    accessions = orders.select(F.col("o_orderkey").alias("accession"), F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("parent_ac"), F.col("o_orderpriority").alias("external_id"), F.col("o_orderstatus").alias("optional_id"))
    chains = orders.where("o_orderpriority LIKE '1%' AND o_orderstatus IN ('F', 'O')").select(F.col("o_orderpriority").alias("pdb_id"), F.col("o_orderstatus").alias("chain_id"))
    sequences = customer.select(F.col("c_custkey").alias("upi"), F.col("c_nationkey").alias("taxid"), F.col("c_mktsegment").alias("so_rna_type"))
    xref = orders.where("o_totalprice > 1000").select(F.col("o_orderkey").alias("ac"), F.col("o_custkey").alias("upi")).join(sequences.select("upi", "taxid"), "upi")
    rna = customer.select(F.col("c_custkey").alias("upi"), F.col("c_name").alias("seq_short"), F.lit(None).cast("string").alias("seq_long"))
    return lookups.chain_sequences(chains, xref, sequences, rna, accessions)


@query(
    "op_hgnc_fix",
    "WITH r AS (SELECT l_orderkey AS k, min(l_shipdate::DATE::VARCHAR) AS f, min(l_linestatus) AS c FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(*) = 1) SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' AND k IS NOT NULL THEN f ELSE l_shipdate::DATE::VARCHAR END AS feature_name, CASE WHEN l_returnflag = 'A' AND k IS NOT NULL THEN c ELSE l_linestatus END AS ncrna_class FROM lineitem LEFT JOIN r ON k = l_orderkey",
)
def _(t):
    database = F.when(F.col("l_returnflag") == "R", "refseq").when(F.col("l_returnflag") == "A", "hgnc").otherwise("ena")
    rows = t("lineitem").select("l_orderkey", "l_linenumber", database.alias("database"), F.to_date("l_shipdate").cast("string").alias("feature_name"), F.col("l_linestatus").alias("ncrna_class"))
    return lookups.hgnc_fix(rows, ["l_orderkey"]).drop("database")
