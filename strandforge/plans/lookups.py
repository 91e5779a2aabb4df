"""Lookups and small plans of sources: longest sequence by alias, classes of genes, mirtrons, stored genes, weekly counts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The class of a gene's RNA and its sequence ontology term.
GENE_CLASSES = {
    "RNA, long non-coding": "SO:0001877",
    "RNA, Y": "SO:0000405",
    "RNA, cluster": "SO:0000655",
    "RNA, micro": "SO:0000276",
    "RNA, misc": "SO:0000655",
    "RNA, small nuclear": "SO:0000274",
    "RNA, small nucleolar": "SO:0000275",
    "RNA, transfer": "SO:0000253",
    "RNA, vault": "SO:0000404",
}
#: Ribosomal genes by the group they are in, the first that applies; else the general term.
RIBOSOMAL_GROUPS = {"5S ribosomal RNAs": "SO:0000652", "12S RNA": "SO:0002344"}
RIBOSOMAL, RIBOSOMAL_TERM = "RNA, ribosomal", "SO:0000252"


def gene_class_term(rna_type: Column, groups: Column) -> Column:
    """The ontology term of a gene by its class and its array of groups; an unknown or null class raises."""
    groups = F.coalesce(groups, F.array().cast("array<string>"))
    ribosomal = F.coalesce(*[F.when(F.array_contains(groups, g), term) for g, term in RIBOSOMAL_GROUPS.items()], F.lit(RIBOSOMAL_TERM))
    known = reduce(lambda c, kv: c.when(rna_type == kv[0], kv[1]), GENE_CLASSES.items(), F.when(rna_type == RIBOSOMAL, ribosomal))
    return known.otherwise(F.raise_error(F.concat(F.lit("unknown class of RNA: "), F.coalesce(rna_type, F.lit("null")))))


def remove_array_element(values: Column, element: Column) -> Column:
    """The array without the one value equal to element; null if there is none, an error if there are several."""
    found = F.size(F.filter(values, lambda x: x.eqNullSafe(element)))
    return F.when(found > 1, F.raise_error(F.lit("more than one element to remove"))).when(found == 1, F.filter(values, lambda x: ~x.eqNullSafe(element)))


def longest_by_alias(df: DataFrame, aliases: list[str], key: str = "upi", length: str = "len") -> DataFrame:
    """alias, key: the longest row any of whose alias columns has the alias, ties by the smallest key.

    Each row sends its distinct aliases; the aggregate combines before the shuffle.
    """
    names = F.array_distinct(F.array(*[F.col(a).cast("string") for a in aliases]))
    rows = df.select(F.explode(F.filter(names, lambda x: x.isNotNull())).alias("alias"), F.col(length).alias("_len"), F.col(key).alias("_key"))
    return rows.groupBy("alias").agg(F.min_by("_key", F.struct(-F.col("_len"), "_key")).alias(key))


def mirtron_relations(entries: DataFrame) -> DataFrame:
    """accession, related, relationship, start, stop: mature products and precursors by names without -3p or -5p.

    entries: accession, kind (mature or precursor), sequence. Both directions are
    given; a precursor's row has where the product lies in it (0-based, end not
    included), null if it doesn't. A mature product without a precursor has one
    row with a null relationship. An accession given twice raises.
    """
    twice = F.when(F.count("*") > 1, F.raise_error(F.concat(F.lit("duplicate accession: "), F.col("accession"))))
    once = entries.groupBy("accession").agg(F.first("kind").alias("kind"), F.first("sequence").alias("sequence"), twice.alias("_twice")).where("_twice IS NULL")
    mature = once.where("kind = 'mature'").select(F.regexp_replace("accession", "-[35]p", "").alias("_pre"), F.col("accession").alias("_mature"), F.col("sequence").alias("_product"))
    pre = once.where("kind = 'precursor'").select(F.col("accession").alias("_pre"), F.col("sequence").alias("_whole"), F.lit(True).alias("_known"))
    at = F.nullif(F.instr("_whole", F.col("_product")), F.lit(0)).cast("long") - 1
    none = F.lit(None).cast("long")
    row = lambda a, b, r, start, stop: F.struct(F.col(a).alias("accession"), F.col(b).alias("related"), r.alias("relationship"), start.alias("start"), stop.alias("stop"))
    pair = F.array(row("_pre", "_mature", F.lit("mature_product"), at, at + F.length("_product")), row("_mature", "_pre", F.lit("precursor"), none, none))
    alone = F.array(row("_mature", "_pre", F.lit(None).cast("string"), none, none))
    return mature.join(pre, "_pre", "left").select(F.inline(F.when(F.col("_known"), pair).otherwise(alone)))


def weekly_report(xref: DataFrame, databases: DataFrame, now: Column | datetime, days: int = 7) -> DataFrame:
    """display_name, n: active rows of a database that are less than `days` days old at `now`, by name."""
    new = xref.where((F.col("deleted") == "N") & (F.col("timestamp") > F.lit(now) - F.expr(f"INTERVAL {int(days)} DAYS")))
    counts = new.groupBy("dbid").agg(F.count("taxid").alias("n"))
    return counts.join(databases, F.col("dbid") == F.col("id")).groupBy("display_name").agg(F.sum("n").alias("n")).orderBy("display_name")


def stored_genes(genes: DataFrame, members: DataFrame, regions: DataFrame, taxid: int) -> DataFrame:
    """The active genes of a taxid with the sorted names of their members' regions, one row a gene.

    genes: id, taxid, is_active and what describes the gene; members: gene_id, locus_id; regions: id, region_name.
    """
    wanted = genes.where((F.col("taxid") == taxid) & F.col("is_active")).drop("taxid", "is_active")
    named = wanted.select(F.col("id").alias("gene_id")).join(members, "gene_id").join(regions.select(F.col("id").alias("locus_id"), "region_name"), "locus_id")
    lists = named.groupBy(F.col("gene_id").alias("id")).agg(F.sort_array(F.collect_list("region_name")).alias("members"))
    return wanted.join(lists, "id")


def merge_sorted(*parts: DataFrame) -> DataFrame:
    """The distinct rows of all parts in the order of their columns, as merging sorted files does."""
    rows = reduce(DataFrame.union, parts).distinct()
    return rows.orderBy(*rows.columns)


def write_copy(df: DataFrame, path: str, header: bool = True, quote_all: bool = False) -> None:
    """CSV as COPY writes it: quotes doubled, nulls empty and unquoted, empty texts quoted."""
    df.write.mode("errorifexists").csv(path, header=header, quote='"', escape='"', quoteAll=quote_all, nullValue="", emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def rfam_models(models: DataFrame) -> DataFrame:
    """Models that have an ontology term, with their source and the taxid of cellular organisms (131567, a fixed value)."""
    return models.where("so_rna_type IS NOT NULL").select("rfam_model_id", F.lit("rfam").alias("source"), F.lit(131567).alias("taxid"), "so_rna_type", "rna_type")


def chain_sequences(chains: DataFrame, xref: DataFrame, precomputed: DataFrame, rna: DataFrame, accessions: DataFrame) -> DataFrame:
    """pdb_id, chain_id, id, sequence, taxid, so_rna_type for all wanted chains at once; xref: the active rows of the database.

    The chains, which are few against the tables, join the accessions first; whole sequences join last.
    """
    wanted = accessions.select(F.col("accession").alias("ac"), F.col("parent_ac").alias("id"), F.col("external_id").alias("pdb_id"), F.col("optional_id").alias("chain_id"))
    found = wanted.join(chains.select("pdb_id", "chain_id").distinct(), ["pdb_id", "chain_id"]).join(xref.select("ac", "upi", "taxid"), "ac")
    typed = found.join(precomputed.select("upi", "taxid", "so_rna_type"), ["upi", "taxid"])
    texts = rna.select("upi", F.coalesce("seq_short", "seq_long").alias("sequence"))
    return typed.join(texts, "upi").select("pdb_id", "chain_id", "id", "sequence", "taxid", "so_rna_type")


def hgnc_fix(accessions: DataFrame, keys: list[str], columns: tuple[str, ...] = ("feature_name", "ncrna_class")) -> DataFrame:
    """HGNC rows take the columns of the RefSeq row of their sequence, if it has exactly one; other rows stay. No plan here applies it by itself."""
    one = accessions.where("lower(database) = 'refseq'").groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(f"_{c}") for c in columns]).where("_n = 1")
    take = (F.lower("database") == "hgnc") & F.col("_n").isNotNull()
    rows = accessions.join(one, keys, "left")
    return rows.select(*[F.when(take, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in accessions.columns])
