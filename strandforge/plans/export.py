"""Exported documents: FASTA, BED12, GFF3, GPI, id mapping, search documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coordinates
from ..operators import relational as R

#: Fixed value: the colour of BED rows.
RGB = "63,125,151"
#: Types too general to rank high.
GENERIC_TYPES = ["misc_RNA", "misc RNA", "other"]


def fasta(df: DataFrame, name: str, description: str, sequence: str, alphabet: str | None = None) -> DataFrame:
    """value: one record each; with an alphabet, only sequences of these letters."""
    rows = df if alphabet is None else df.where(F.col(sequence).rlike(f"^[{alphabet}]+$"))
    return rows.select(F.concat(F.lit(">"), F.concat_ws(" ", name, description), F.lit("\n"), F.col(sequence)).alias("value"))


def dfasta(df: DataFrame, name: str, sequence: str, structure: str) -> DataFrame:
    return df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(sequence), F.lit("\n"), F.col(structure)).alias("value"))


def bed12(df: DataFrame, extended: bool = True) -> DataFrame:
    """Columns of BED rows from (rna_id, chromosome, strand, exons 1-based closed and sorted, rna_type, databases)."""
    exons = F.sort_array("exons")
    start, stop = F.get(exons, 0)["start"] - 1, F.array_max(F.transform(exons, lambda e: e["stop"]))
    chrom = F.when(F.col("chromosome").isin("MT", "chrMT"), "chrM").otherwise(F.concat(F.lit("chr"), F.col("chromosome")))
    sizes = F.array_join(F.transform(exons, lambda e: (e["stop"] - e["start"] + 1).cast("string")), ",")
    starts = F.array_join(F.transform(exons, lambda e: (e["start"] - 1 - start).cast("string")), ",")
    columns = [
        chrom.alias("chrom"), start.alias("chromStart"), stop.alias("chromEnd"), F.col("rna_id").alias("name"), F.lit(0).alias("score"), coordinates.strand_name(F.col("strand")).alias("strand"),
        start.alias("thickStart"), stop.alias("thickEnd"), F.lit(RGB).alias("itemRgb"), F.size("exons").alias("blockCount"), sizes.alias("blockSizes"), starts.alias("blockStarts"),
    ]
    more = [F.lit(".").alias("dot"), F.col("rna_type"), F.array_join(F.sort_array("databases"), ",").alias("databases")] if extended else []
    return df.select(*columns, *more)


def bed6(df: DataFrame) -> DataFrame:
    """One row a block of BED12 rows."""
    to_longs = lambda c: F.transform(F.split(F.rtrim(F.col(c), F.lit(",")), ","), lambda x: x.cast("long"))
    blocks = F.arrays_zip(to_longs("blockSizes").alias("size"), to_longs("blockStarts").alias("offset"))
    rows = df.select("chrom", "chromStart", "name", "score", "strand", F.posexplode(blocks).alias("block", "b"))
    start = F.col("chromStart") + F.col("b")["offset"]
    return rows.select("chrom", start.alias("chromStart"), (start + F.col("b")["size"]).alias("chromEnd"), "name", "score", "strand", "block")


def gff3(df: DataFrame, source: str = "strandforge") -> DataFrame:
    """seqid, source, type, start, end, score, strand, phase, attributes: a transcript and its exons for each region."""
    exons = F.sort_array("exons")
    start, stop = F.get(exons, 0)["start"], F.array_max(F.transform(exons, lambda e: e["stop"]))
    head = F.concat(F.lit("Name="), F.col("rna_id"), F.lit(";type="), F.col("rna_type"))
    whole = F.struct(F.lit("transcript").alias("type"), start.alias("start"), stop.alias("end"), F.concat(F.lit("ID="), F.col("region_id"), F.lit(";"), head).alias("attributes"))
    parts = F.transform(exons, lambda e, k: F.struct(F.lit("noncoding_exon").alias("type"), e["start"].alias("start"), e["stop"].alias("end"), F.concat(F.lit("ID="), F.col("region_id"), F.lit(":ncRNA_exon"), (k + 1).cast("string"), F.lit(";Parent="), F.col("region_id"), F.lit(";"), head).alias("attributes")))
    rows = df.select(F.col("chromosome").alias("seqid"), coordinates.strand_name(F.col("strand")).alias("strand"), F.explode(F.concat(F.array(whole), parts)).alias("f"))
    return rows.select("seqid", F.lit(source).alias("source"), "f.type", "f.start", "f.end", F.lit(".").alias("score"), "strand", F.lit(".").alias("phase"), "f.attributes")


def id_mapping(df: DataFrame) -> DataFrame:
    """upi, database, accession, taxid, rna_type, gene with each database's own way of naming."""
    db = F.col("database")
    parts = F.split("accession", ":")
    ends = F.split(F.get(parts, 1), r"\.\.")
    rfam = F.concat(F.regexp_replace(F.get(parts, 0), r"\.\d\d+$", ""), F.lit("/"), F.get(ends, 0), F.lit("-"), F.get(ends, 1))
    accession = F.when(db == "PDBE", F.concat_ws("_", "external_id", "optional_id")).when(db.isin("HGNC", "ENA"), F.col("accession")).when(db == "TAIR", F.col("gene")).otherwise(F.col("external_id"))
    gene = F.when((db == "ENA") & (F.col("rna_type") == "piRNA"), F.col("product")).when(db.isin("MIRBASE", "ENSEMBL"), F.col("optional_id")).when((db == "RFAM") & (F.col("rna_type") == "pre_miRNA"), rfam).when(db == "TAIR", F.col("external_id")).otherwise(F.replace(F.coalesce("gene", F.lit("")), F.lit("\t"), F.lit(" ")))
    return df.select("upi", F.when(db == "PDBE", "PDB").otherwise(db).alias("database"), accession.alias("accession"), "taxid", "rna_type", gene.alias("gene"))


def gpi(rows: DataFrame, precursors: DataFrame, taxids: list[int] | None = None) -> DataFrame:
    """GPI rows of sequences: one a urs_taxid, with aliases and, for microRNAs, their precursors."""
    rows = rows if taxids is None else rows.where(F.col("taxid").isin(taxids))
    parents = precursors.groupBy("urs_taxid").agg(F.array_sort(F.collect_set("precursor")).alias("_p"))
    g = rows.groupBy("urs_taxid", "taxid").agg(F.min("description").alias("name"), F.min("rna_type").alias("object_type"), F.array_join(F.array_sort(F.collect_set("alias")), "|").alias("synonyms"))
    joined = g.join(parents, "urs_taxid", "left")
    return joined.select(F.lit("RNAcatalogue").alias("database"), F.col("urs_taxid").alias("object_id"), "name", "synonyms", "object_type", F.concat(F.lit("taxon:"), F.col("taxid").cast("string")).alias("taxon"), F.coalesce(F.array_join(F.transform("_p", lambda p: F.concat(F.lit("precursor_rna="), p)), "|"), F.lit("")).alias("properties"))


def boost(taxid: Column, active: Column, rna_type: Column, experts: Column, has_issue: Column, human: int = 9606, popular: tuple[int, ...] = (10090, 10116, 7227, 6239, 4932, 3702)) -> Column:
    """The rank of a search result: 4 for named human genes, 3 human, 2 popular species, 1 others, 0 obsolete; half a point less for a general type and for an issue."""
    base = F.when(~active, 0.0).when(F.array_contains(experts, "HGNC"), 4.0).when(taxid == human, 3.0).when(taxid.isin(*popular), 2.0).otherwise(1.0)
    return base - F.when(rna_type.isin(GENERIC_TYPES), 0.5).otherwise(0.0) - F.when(F.coalesce(has_issue, F.lit(False)), 0.5).otherwise(0.0)


def search_documents(base: DataFrame, children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """base (id, urs_taxid, ...) with all its child tables: the many-way merge, each table grouped before it joins."""
    return R.merge_children(base, "urs_taxid", children)


def search_xml(docs: DataFrame) -> DataFrame:
    """value: an <entry> each, from id, name, description, fields (map of name to array of values), references (array of structs db, id)."""
    escape = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    pairs = F.flatten(F.transform(F.map_entries("fields"), lambda e: F.transform(F.array_sort(F.array_distinct(e["value"])), lambda v: F.concat(F.lit('<field name="'), escape(e["key"]), F.lit('">'), escape(v), F.lit("</field>")))))
    refs = F.transform(F.array_sort(F.array_distinct("references")), lambda r: F.concat(F.lit('<ref dbname="'), escape(r["db"]), F.lit('" dbkey="'), escape(r["id"]), F.lit('"/>')))
    return docs.select(
        F.concat(
            F.lit('<entry id="'), escape(F.col("id")), F.lit('"><name>'), escape(F.col("name")), F.lit("</name><description>"), escape(F.col("description")), F.lit("</description><cross_references>"),
            F.array_join(refs, ""), F.lit("</cross_references><additional_fields>"), F.array_join(F.array_sort(pairs), ""), F.lit("</additional_fields></entry>"),
        ).alias("value")
    )


def search_genes(members: DataFrame) -> DataFrame:
    """One document a gene of an assembly; members of more than one taxid or region raise.

    members: assembly_id, gene, region, taxid, urs_taxid, has_literature, databases (array).
    """
    g = members.groupBy("assembly_id", "gene").agg(
        F.min("region").alias("_r0"), F.max("region").alias("_r1"), F.min("taxid").alias("_t0"), F.max("taxid").alias("_t1"), F.count_distinct("urs_taxid").alias("member_count"),
        F.bool_or("has_literature").alias("has_literature"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("databases")))).alias("databases"),
    )
    one = (F.col("_r0") == F.col("_r1")) & (F.col("_t0") == F.col("_t1"))
    gene = F.when(one, F.col("gene")).otherwise(F.raise_error(F.concat(F.lit("several regions or taxids: "), F.col("gene").cast("string"))).cast(g.schema["gene"].dataType))
    return g.select("assembly_id", gene.alias("gene"), F.col("_r0").alias("region"), F.col("_t0").alias("taxid"), "member_count", "has_literature", "databases")


def ensembl_json(df: DataFrame, trusted: list[str], alphabet: str = "ACGTN") -> DataFrame:
    """rna_id, document (JSON): valid sequences, trusted cross-references only, each once; circular and guide RNAs go."""
    rows = df.where(~F.col("rna_type").isin("circRNA", "sgRNA") & F.col("sequence").rlike(f"^[{alphabet}]+$"))
    xrefs = F.array_sort(F.array_distinct(F.filter("xrefs", lambda x: x["database"].isin(trusted))))
    kept = rows.withColumn("xrefs", xrefs).where(F.size("xrefs") > 0)
    return kept.select("rna_id", F.to_json(F.struct("rna_id", "rna_type", "sequence", "xrefs"), {"ignoreNullFields": "false"}).alias("document"))


def release_note(rna: DataFrame, xref: DataFrame, databases: DataFrame) -> DataFrame:
    """One row of counts for a release note."""
    return rna.agg(F.count("*").alias("sequences")).crossJoin(xref.where("deleted = 'N'").agg(F.count("*").alias("xrefs"))).crossJoin(databases.agg(F.count("*").alias("databases")))
