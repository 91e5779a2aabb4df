"""Entries: what every source becomes, and the sources that read it from the formats of `readers`.

A source is a function (spark, path, ...) -> DataFrame of ENTRY. Sources of one shape share a function with a
mapping of columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequences
from . import readers

EXON = "struct<start:bigint,stop:bigint>"
ENTRY = {
    "primary_id": "string", "accession": "string", "database": "string", "ncbi_tax_id": "bigint", "sequence": "string", "so_type": "string", "description": "string", "gene": "string", "locus_tag": "string",
    "species": "string", "url": "string", "seq_version": "string", "gene_synonyms": "array<string>", "references": "array<string>", "note": "map<string,string>",
    "regions": f"array<struct<chromosome:string,strand:int,assembly_id:string,exons:array<{EXON}>>>",
    "related": "array<struct<target:string,relationship:string,methods:array<string>>>",
}


def entry(df: DataFrame, database: str, **columns: Column) -> DataFrame:
    """df as entries: the columns given, null for the rest. The accession defaults to the primary id, U becomes T."""
    columns.setdefault("accession", columns["primary_id"])
    made = []
    for name, kind in ENTRY.items():
        value = F.lit(database) if name == "database" else columns.get(name, F.lit(None))
        made.append((sequences.to_dna(value) if name == "sequence" else value).cast(kind).alias(name))
    return df.select(*made)


def valid(entries: DataFrame) -> DataFrame:
    """Entries without a problem of length, N or type."""
    return entries.where(sequences.entry_problem(F.col("sequence"), so_type=F.col("so_type")).isNull())


def union(*sources: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, sources)


def from_table(df: DataFrame, database: str, names: dict[str, str], records: DataFrame | None = None, **fixed: Column) -> DataFrame:
    """Entries of a table: names maps entry columns to df's; with records (a FASTA), sequences join by primary id."""
    if records is not None:
        df = readers.fasta_lookup(df, records.select("id", F.col("sequence").alias("_sequence")), names["primary_id"])
        fixed = {"sequence": F.col("_sequence"), **fixed}
    return entry(df, database, **{k: F.col(f"`{v}`") for k, v in names.items()}, **fixed)


def from_flat(df: DataFrame, database: str, so_types: dict[str, str] | None = None) -> DataFrame:
    """Entries of EMBL or GenBank records: a record must have one RNA feature beside its source; others are skipped."""
    kinds = so_types or {"rRNA": "SO:0000252", "tRNA": "SO:0000253", "ncRNA": "SO:0000655", "misc_RNA": "SO:0000673", "precursor_RNA": "SO:0000185", "tmRNA": "SO:0000584"}
    rna = F.filter("features", lambda f: f["kind"].isin(list(kinds)))
    one = df.withColumn("_f", F.get(rna, 0)).where((F.size(rna) == 1) & ~F.exists("features", lambda f: (f["kind"] == "CDS") | F.coalesce(f["qualifiers"]["pseudo"].isNotNull(), F.lit(False))))
    lookup = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    q = F.col("_f.qualifiers")
    return entry(
        one, database, primary_id=F.col("accession"), accession=F.concat_ws(":", F.concat_ws(".", "accession", F.col("version").cast("string")), "_f.location", "_f.kind"), ncbi_tax_id=F.col("taxid"), sequence=F.col("sequence"),
        so_type=lookup[F.col("_f.kind")], description=F.coalesce(q["product"], F.col("description")), gene=q["gene"], locus_tag=q["locus_tag"], species=F.col("organism"), seq_version=F.col("version").cast("string"), references=F.col("references"),
    )


def generic_json(spark: SparkSession, path: str, database: str) -> DataFrame:
    """The JSON schema that many databases share: {data: [{primaryId, taxonId, sequence, soTermId, ...}]}."""
    df = readers.json_document(spark, path)
    for c in ("primaryId", "taxonId", "sequence", "soTermId", "name", "url", "symbolSynonyms", "publications", "genomeLocations"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None))
    has_locations = not df.schema["genomeLocations"].dataType.simpleString() == "void"
    regions = F.lit(None)
    if has_locations:
        strand = lambda s: F.when(s.isin("+", "1"), 1).when(s.isin("-", "-1"), -1).otherwise(0)
        regions = F.transform("genomeLocations", lambda g: F.struct(F.get(g["exons"], 0)["chromosome"].alias("chromosome"), strand(F.get(g["exons"], 0)["strand"]).alias("strand"), g["assembly"].alias("assembly_id"), F.transform(g["exons"], lambda e: F.struct(e["startPosition"].cast("long").alias("start"), e["endPosition"].cast("long").alias("stop"))).alias("exons")))
    taxid = F.regexp_extract(F.col("taxonId").cast("string"), r"(\d+)$", 1).try_cast("long")
    return entry(df, database, primary_id=F.col("primaryId"), ncbi_tax_id=taxid, sequence=F.col("sequence"), so_type=F.col("soTermId"), description=F.col("name"), url=F.col("url"), gene_synonyms=F.col("symbolSynonyms"), references=F.col("publications"), regions=regions)


#: Sources that are tables: what their columns become. Those with records take sequences from a FASTA file.
TABLES = {
    "silva": {"primary_id": "insdcAccession", "ncbi_tax_id": "ncbiTaxId", "sequence": "sequence", "so_type": "type", "description": "description"},
    "crw": {"primary_id": "id", "ncbi_tax_id": "taxid", "so_type": "so_term_id", "description": "description"},
    "ribovision": {"primary_id": "id", "ncbi_tax_id": "taxid", "sequence": "sequence", "so_type": "so_term_id"},
    "rgd": {"primary_id": "GENE_RGD_ID", "so_type": "so_type", "description": "NAME", "gene": "SYMBOL"},
    "mgi": {"primary_id": "MGI Marker Accession ID", "so_type": "so_type", "description": "Marker Name", "gene": "Marker Symbol"},
    "genecards": {"primary_id": "GeneCardsSymbol", "sequence": "sequence", "gene": "GeneCardsSymbol"},
    "malacards": {"primary_id": "GeneCardsSymbol", "sequence": "sequence", "gene": "GeneCardsSymbol"},
    "tarbase": {"primary_id": "mirna_id", "sequence": "sequence", "so_type": "so_type", "species": "species"},
    "mirtrondb": {"primary_id": "name", "sequence": "sequence", "so_type": "so_type", "species": "specie"},
    "evlncrnas": {"primary_id": "ID", "sequence": "sequence", "ncbi_tax_id": "taxid", "gene": "Name"},
    "circpedia": {"primary_id": "circ_id", "gene": "gene", "so_type": "so_type", "species": "species"},
    "pirbase": {"primary_id": "name", "sequence": "sequence", "so_type": "so_type"},
    "rfam": {"primary_id": "rfamseq_acc", "ncbi_tax_id": "ncbi_id", "so_type": "so_type", "description": "rfam_description"},
}
#: Sources of the shared JSON schema.
JSON = ["flybase", "lncipedia", "lncbook", "mirbase", "mirgenedb", "pombase", "sgd", "snodb", "snorna_database", "tair", "zfin", "zwd", "gtrnadb", "hgnc", "pdbe", "ribocentre", "5srrnadb", "mgnify", "plncdb"]


def mitab_related(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """source, target, relationship_type, methods of interactions in which one side is a sequence of the catalogue: its name starts with prefix."""
    rows = readers.mitab(spark, path)
    name = lambda c: F.get(F.filter(F.concat(F.coalesce(F.col(f"id_{c}"), F.array()), F.coalesce(F.col(f"alt_{c}"), F.array())), lambda x: F.startswith(x, F.lit(prefix))), 0)
    other = lambda c: F.get(F.col(f"id_{c}"), 0)
    both = rows.select(name("a").alias("source"), other("b").alias("target"), "method").unionByName(rows.select(name("b").alias("source"), other("a").alias("target"), "method"))
    kept = both.where("source IS NOT NULL AND target IS NOT NULL").withColumn("source", F.substring("source", len(prefix) + 1, 100))
    return kept.groupBy("source", "target").agg(F.lit("interacting_protein").alias("relationship_type"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("method", F.array().cast("array<string>")))))).alias("methods"))


def crs_features(spark: SparkSession, path: str, highlight: float = 10.0) -> DataFrame:
    """upi, taxid, start, stop, feature_name, metadata of conserved structures."""
    rows = readers.tsv(spark, path, "urs_taxid string, start long, stop long, chromosome string, genome_start long, genome_stop long, crs_id string, crs_fdr double")
    return rows.select(F.split_part("urs_taxid", F.lit("_"), F.lit(1)).alias("upi"), F.split_part("urs_taxid", F.lit("_"), F.lit(2)).cast("long").alias("taxid"), "start", "stop", F.lit("conserved_rna_structure").alias("feature_name"), F.to_json(F.struct("crs_id", (F.col("crs_fdr") <= highlight).alias("should_highlight"))).alias("metadata"))


def go_annotations(spark: SparkSession, path: str) -> DataFrame:
    """rna_id, qualifier, term, evidence, assigned_by of GPA rows for sequences of the catalogue, each once."""
    return readers.gpa(spark, path).select(F.col("object_id").alias("rna_id"), "qualifier", F.col("go_id").alias("term"), "evidence", "assigned_by", F.split("reference", r"\|").alias("references")).distinct()


def fan_out(entries: DataFrame) -> dict[str, DataFrame]:
    """The tables that a set of entries is written to; each a projection, so one staged table of entries serves them all."""
    key = F.col("accession")
    return {
        "accessions": entries.select(*[c for c, k in ENTRY.items() if k in ("string", "bigint") and c != "sequence"]),
        "short_sequences": entries.where(F.length("sequence") <= 4000).select(key, F.md5("sequence").alias("md5"), F.length("sequence").alias("len"), "sequence"),
        "long_sequences": entries.where(F.length("sequence") > 4000).select(key, F.md5("sequence").alias("md5"), F.length("sequence").alias("len"), "sequence"),
        "references": entries.select(key, F.explode("references").alias("reference")),
        "regions": entries.select(key, F.explode("regions").alias("r")).select("accession", "r.chromosome", "r.strand", "r.assembly_id", F.explode("r.exons").alias("e")).select("accession", "chromosome", "strand", "assembly_id", F.col("e.start").alias("exon_start"), F.col("e.stop").alias("exon_stop")),
        "related": entries.select(key.alias("source"), F.inline("related")),
        "synonyms": entries.select(key, F.explode("gene_synonyms").alias("synonym")),
    }
