"""Tables of the catalogue: their schemas, reading and writing, partition by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Columns of the core tables; partitioned ones are written partition by partition.
SCHEMAS = {
    "rna": "id long, upi string, crc64 string, len long, seq_short string, seq_long string, md5 string",
    "xref": "dbid int, ac string, upi string, version int, version_i int, created int, last int, deleted string, taxid long",
    "accessions": "accession string, database string, external_id string, optional_id string, rna_type string, gene string, description string, species string",
    "databases": "id int, descr string, display_name string, alive string, num_sequences long",
    "releases": "id int, dbid int, release_date timestamp, release_type string, status string",
    "precomputed": "id string, upi string, taxid long, is_active boolean, description string, short_description string, rna_type string, so_rna_type string, databases string, has_coordinates boolean, last_release int",
    "qa_status": "rna_id string, has_issue boolean, incomplete_sequence boolean, possible_contamination boolean, missing_rfam_match boolean, from_repetitive_region boolean, possible_orf boolean, possible_orf_stopfree boolean, possible_orf_tcode boolean, messages array<string>",
    "regions": "region_id string, region_name string, assembly_id string, urs_taxid string, chromosome string, strand int, region_start long, region_stop long, exon_count int",
    "exons": "region_id string, assembly_id string, exon_start long, exon_stop long",
    "genes": "name string, members array<string>, assembly_id string, chromosome string, strand int, start long, stop long, version int, first_release int, last_release int, is_active boolean",
}
PARTITIONS = {"xref": ["dbid", "deleted"], "regions": ["assembly_id"], "exons": ["assembly_id"]}


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")


def write(df: DataFrame, root: str, name: str, only_touched: bool = True) -> None:
    """Replaces the table or, for a partitioned one, only the partitions that df has (the partition exchange)."""
    columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
    keys = PARTITIONS.get(name)
    writer = df.select(*columns).write.mode("overwrite")
    if keys:
        writer = writer.option("partitionOverwriteMode", "dynamic" if only_touched else "static").partitionBy(*keys)
    writer.parquet(f"{root}/{name}")


def exchange(spark: SparkSession, df: DataFrame, root: str, name: str, staging: str) -> None:
    """As write, for a df that reads the same table: it is written beside it first."""
    df.write.mode("overwrite").parquet(staging)
    write(spark.read.parquet(staging), root, name)


def apply_attempts(attempted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The attempted set with new rows, each key once."""
    return attempted.unionByName(done).dropDuplicates(keys)
