"""What follows a release: regions, related sequences, homologies and the simple upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coordinates
from ..operators import relational as R


def attach_urs(df: DataFrame, xref: DataFrame) -> DataFrame:
    """df with urs_taxid filled in from the active cross-reference of its accession; the smallest where there are several."""
    active = xref.where("deleted = 'N'").groupBy(F.col("ac").alias("accession")).agg(F.min(F.concat_ws("_", "upi", F.col("taxid").cast("string"))).alias("_urs"))
    return df.join(active, "accession", "left").select(*[F.coalesce("urs_taxid", "_urs").alias(c) if c == "urs_taxid" else F.col(c) for c in df.columns])


def load_regions(staged: DataFrame, xref: DataFrame, assemblies: DataFrame, mapped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(regions, exons) of given coordinates.

    staged: accession, urs_taxid, region_name, chromosome, strand, assembly_id,
    exon_start, exon_stop. assemblies: assembly_id, ucsc_id. mapped: regions that
    come from genome mapping (region_name, assembly_id), which given ones displace.
    Regions of unknown assemblies or without a sequence go; each region must have all its exons.
    """
    rows = attach_urs(staged, xref).where("urs_taxid IS NOT NULL")
    names = assemblies.select(F.col("ucsc_id").alias("_ucsc"), F.col("assembly_id").alias("_ensembl")).where("_ucsc IS NOT NULL")
    rows = rows.join(names, F.col("assembly_id") == F.col("_ucsc"), "left").withColumn("assembly_id", F.coalesce("_ensembl", "assembly_id")).drop("_ucsc", "_ensembl")
    rows = R.keep_existing(rows, assemblies, "assembly_id")
    exon = F.struct(F.col("exon_start").alias("start"), F.col("exon_stop").alias("stop"))
    regions = rows.groupBy("urs_taxid", "chromosome", "strand", "assembly_id", "region_name").agg(F.sort_array(F.collect_set(exon)).alias("exons"), F.min("exon_start").alias("region_start"), F.max("exon_stop").alias("region_stop"), F.sort_array(F.collect_set("accession")).alias("accessions"))
    named = regions.withColumn("region_name", coordinates.region_name(F.split_part("urs_taxid", F.lit("_"), F.lit(1)), F.col("chromosome"), F.col("exons"), F.col("strand")))
    unique = named.groupBy("region_name", "assembly_id").agg(F.min_by(F.struct("urs_taxid", "chromosome", "strand", "region_start", "region_stop", "exons"), "urs_taxid").alias("_r"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("accessions")))).alias("accessions"))
    unique = unique.select("region_name", "assembly_id", "_r.*", "accessions", F.md5("region_name").alias("region_id"))
    unique = unique.withColumn("exon_count", F.size("exons")).join(mapped.select("region_name", "assembly_id", F.lit(True).alias("displaces")).distinct(), ["region_name", "assembly_id"], "left").withColumn("displaces", F.coalesce("displaces", F.lit(False)))
    return unique.drop("exons"), unique.select("region_id", "assembly_id", F.inline("exons")).withColumnsRenamed({"start": "exon_start", "stop": "exon_stop"})


def incomplete_regions(regions: DataFrame, exons: DataFrame) -> DataFrame:
    """Regions whose number of exons isn't exon_count; a release asserts that there are none."""
    counts = exons.groupBy("region_id").agg(F.count("*").alias("_n"))
    return regions.join(counts, "region_id", "left").where(F.coalesce("_n", F.lit(0)) != F.col("exon_count"))


def related_sequences(staged: DataFrame, proteins: DataFrame, xref: DataFrame, genes: DataFrame) -> DataFrame:
    """The four-step cascade: each staged relation is resolved by the first step that applies.

    staged: source, target, relationship_type, methods (array). A target is a
    protein (target_kind 'protein'), the accession of a known sequence ('rna'), a
    gene whose transcripts are known ('gene', one row each), or stays as it is
    ('other'). Rows with the same key are merged, with all their methods.
    """
    known = xref.where("deleted = 'N'").groupBy(F.col("ac").alias("target")).agg(F.min(F.concat_ws("_", "upi", F.col("taxid").cast("string"))).alias("target_urs"))
    columns = ["source", "target", "target_urs", "target_kind", "relationship_type", "methods"]
    done = []

    def step(rest: DataFrame, found: DataFrame, kind: str) -> DataFrame:
        hit = rest.join(found, "target").withColumn("target_kind", F.lit(kind))
        done.append(hit.select(*columns))
        return rest.join(found.select("target"), "target", "left_anti")

    none = F.lit(None).cast("string")
    rest = step(staged, proteins.select("target", none.alias("target_urs")).distinct(), "protein")
    rest = step(rest, known, "rna")
    members = genes.select(F.col("gene").alias("target"), F.col("ac").alias("_ac")).join(known.withColumnsRenamed({"target": "_ac"}), "_ac").select("target", "target_urs").distinct()
    rest = step(rest, members, "gene")
    done.append(rest.select("source", "target", none.alias("target_urs"), F.lit("other").alias("target_kind"), "relationship_type", "methods"))
    every = reduce(DataFrame.unionByName, done)
    return every.groupBy("source", "target", "target_urs", "target_kind", "relationship_type").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("methods")))).alias("methods"))


def homology_groups(staged: DataFrame, known: DataFrame) -> DataFrame:
    """homology_id, urs_taxid: groups of known sequences; groups are numbered in order of their name, unknown members go.

    The number comes from the distinct groups (dense_ids), not from a window over all members.
    """
    rows = staged.join(known.select("ac", "urs_taxid"), "ac").select("homology_group", "urs_taxid").distinct()
    ids = R.dense_ids(rows.select("homology_group").distinct(), "homology_group", "homology_id")
    return rows.join(ids, "homology_group").select("homology_id", "urs_taxid")


def replace_table(target: DataFrame, staged: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The simple loads: staged rows, one a key (the first in `order`), upserted into target."""
    return R.upsert(target, R.distinct_on(staged, keys, *order), keys)


def clean_assemblies(assemblies: DataFrame, used: DataFrame, examples: DataFrame, middle: int = 5000) -> DataFrame:
    """Assemblies with regions, each with an example locus: the last chromosome's region whose length is nearest to `middle`."""
    length = F.abs(F.col("region_stop") - F.col("region_start") - middle)
    picked = R.distinct_on(examples.withColumn("_off", length), "assembly_id", F.desc("chromosome"), F.col("_off"), F.col("region_start"))
    kept = R.keep_existing(assemblies, used, "assembly_id")
    return kept.join(picked.select("assembly_id", "chromosome", "region_start", "region_stop"), "assembly_id", "left")


def unmapped(possible: DataFrame, mapped: DataFrame, attempted: DataFrame, least: int = 20, most: int = 100_000) -> DataFrame:
    """urs_taxid of active sequences of a fit length that are neither mapped nor were tried."""
    fit = possible.where(F.col("is_active") & F.col("len").between(least, most))
    return fit.join(mapped.select("urs_taxid").union(attempted.select("urs_taxid")).distinct(), "urs_taxid", "left_anti").select("urs_taxid")


def select_alignments(hits: DataFrame) -> DataFrame:
    """The alignments that stand for a sequence: exact ones, or of more than 15 bases with 0.95 < matches / length < 1;
    of these, all with the best fraction for each upi. Short ones with many insertions go.

    hits: upi, matches, length, insertions and any others.
    """
    fraction: Column = F.try_divide(F.col("matches"), F.col("length"))
    bad = (F.col("matches") < 100) & (F.col("insertions") > 25)
    fine = (fraction == 1) | ((F.col("length") > 15) & (fraction > 0.95) & (fraction < 1))
    return R.argmax_ties(hits.withColumn("match_fraction", fraction).where(~bad & fine), "upi", "match_fraction")


def release_order(df: DataFrame, key: str) -> DataFrame:
    """df with the row's place among the rows of its key, by release."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy("release")))
