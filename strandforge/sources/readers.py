"""Readers: each a function (spark, path) -> DataFrame. Files are split and read by Spark alone."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_lines(spark: SparkSession, path: str, schema: str, unescape: bool = False) -> DataFrame:
    """JSON lines; with unescape, doubled backslashes of COPY output are undone where that makes the line valid."""
    if not unescape:
        return spark.read.schema(schema).json(path)
    raw = spark.read.text(path).where("trim(value) <> ''")
    plain = F.from_json(F.replace("value", F.lit("\\\\"), F.lit("\\")), schema, {"mode": "PERMISSIVE"})
    return raw.select(F.coalesce(plain, F.from_json("value", schema)).alias("r")).select("r.*")


def json_document(spark: SparkSession, path: str, column: str = "data") -> DataFrame:
    """A whole JSON document with an array of records."""
    return spark.read.json(path, multiLine=True).select(F.explode(column).alias("r")).select("r.*")


def csv_positional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV without a header; rows that don't fit are dropped."""
    return spark.read.csv(path, schema=schema, mode="DROPMALFORMED")


def tsv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True, quoted: bool = True, null: str | None = None, comment: str | None = None) -> DataFrame:
    options = {"sep": "\t", "header": header, **({} if quoted else {"quote": "\u0000"}), **({"nullValue": null} if null is not None else {}), **({"comment": comment} if comment else {})}
    return spark.read.options(**options).csv(path, schema=schema)


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, description, sequence. Records are split at '>' by the reader; a '>' inside a header starts no record of its own."""
    raw = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", r"^>|\s+$", "").alias("v")).where("v <> ''")
    head, body = F.regexp_extract("v", r"^([^\n]*)", 1), F.regexp_replace(F.regexp_replace("v", r"^[^\n]*\n?", ""), r"\s+", "")
    return raw.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.trim(F.regexp_replace(head, r"^\S*", "")).alias("description"), body.alias("sequence"))


def fasta_lookup(keys: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Random access by id is a join."""
    return keys.join(records.withColumnRenamed("id", key), key, "left")


def _blocks(spark: SparkSession, path: str, separator: str) -> DataFrame:
    return spark.read.text(path, lineSep=separator).where("trim(value) <> ''")


FEATURE = "array<struct<kind:string,location:string,qualifiers:map<string,string>>>"
FLAT = f"accession string, version int, description string, organism string, taxid long, references array<string>, features {FEATURE}, sequence string"


def _parse_flat(text: str, embl: bool) -> dict:
    """One record of an EMBL or GenBank flat file."""
    out: dict = {"accession": None, "version": None, "description": [], "organism": None, "taxid": None, "references": [], "features": [], "sequence": []}
    section, feature, key = "", None, None
    for line in text.split("\n"):
        if not line.strip():
            continue
        code = line[:2] if embl else line[:12].strip()
        body = line[5:].rstrip() if embl else line[12:].rstrip()
        if embl:
            section = {"FT": "features", "SQ": "sequence", "  ": section}.get(code, code)
        elif code in ("FEATURES", "ORIGIN"):
            section = code.lower()
            continue
        elif code and not line.startswith(" ") and section != "origin":
            section = code
        if (embl and section == "features") or (not embl and section == "features"):
            kind, body = line[5:20].strip(), line[21:].rstrip()
            if kind:
                feature, key = {"kind": kind, "location": body.strip(), "qualifiers": {}}, None
                out["features"].append(feature)
            elif feature is not None and body.strip().startswith("/"):
                key, _, value = body.strip()[1:].partition("=")
                feature["qualifiers"][key] = value.strip('"') if value else "true"
            elif feature is not None and key:
                feature["qualifiers"][key] += " " + body.strip().strip('"')
            elif feature is not None:
                feature["location"] += body.strip()
        elif section in ("sequence", "origin"):
            if not line.startswith("SQ"):
                out["sequence"].append("".join(c for c in line if c.isalpha()))
        elif code in ("AC", "ACCESSION") and out["accession"] is None:
            out["accession"] = body.replace(";", " ").split()[0] if body.split() else None
        elif code in ("SV", "VERSION") and "." in body:
            out["version"] = int("".join(c for c in body.split()[0].rpartition(".")[2] if c.isdigit()) or 0)
        elif code in ("DE", "DEFINITION"):
            out["description"].append(body.strip())
        elif code in ("OS", "ORGANISM") and out["organism"] is None:
            out["organism"] = body.strip()
        elif code in ("RX", "PUBMED"):
            out["references"].append(body.strip().rstrip("."))
        if embl and code == "ID" and "SV" in body:
            out["accession"] = body.split(";")[0].strip() or out["accession"]
            digits = body.partition("SV")[2].split(";")[0].strip()
            out["version"] = int(digits) if digits.isdigit() else out["version"]
    for f in out["features"]:
        for ref in [f["qualifiers"].get("db_xref", "")]:
            if ref.startswith("taxon:") and ref[6:].isdigit():
                out["taxid"] = int(ref[6:])
    out["description"], out["sequence"] = " ".join(out["description"]), "".join(out["sequence"]).upper()
    return out


def _flat(spark: SparkSession, path: str, embl: bool) -> DataFrame:
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [_parse_flat(v, embl) for v in b["value"]]
            yield pd.DataFrame(rows, columns=["accession", "version", "description", "organism", "taxid", "references", "features", "sequence"]).astype({"version": "Int32", "taxid": "Int64"})

    return _blocks(spark, path, "\n//\n").where("trim(value) <> '//'").mapInPandas(parse, FLAT).where("accession IS NOT NULL")


def embl(spark: SparkSession, path: str) -> DataFrame:
    return _flat(spark, path, True)


def genbank(spark: SparkSession, path: str) -> DataFrame:
    return _flat(spark, path, False)


def gff3(spark: SparkSession, path: str) -> DataFrame:
    """seqid, source, type, start, stop, score, strand (1, -1, 0), phase, attributes (map)."""
    raw = tsv(spark, path, "seqid string, source string, type string, start long, stop long, score string, strand string, phase string, attrs string", header=False, quoted=False, comment="#")
    pairs = F.filter(F.split("attrs", ";"), lambda x: F.contains(x, F.lit("=")))
    entries = F.transform(pairs, lambda x: F.struct(F.trim(F.split_part(x, F.lit("="), F.lit(1))), F.url_decode(F.substring_index(x, "=", -1))))
    strand = F.when(F.col("strand") == "+", 1).when(F.col("strand") == "-", -1).otherwise(0)
    return raw.where("start IS NOT NULL").select("seqid", "source", "type", "start", "stop", "score", strand.alias("strand"), "phase", F.map_from_entries(entries).alias("attributes"))


def gff_transcripts(features: DataFrame, exon_type: str = "exon") -> DataFrame:
    """transcript, seqid, strand, exons (sorted) from the exons' Parent."""
    exons = features.where(F.col("type") == exon_type).select(F.col("attributes")["Parent"].alias("transcript"), "seqid", "strand", F.struct("start", "stop").alias("e"))
    return exons.groupBy("transcript", "seqid", "strand").agg(F.sort_array(F.collect_list("e")).alias("exons"))


#: The fields of PSL, in order.
PSL = "matches long, mismatches long, rep_matches long, n_count long, q_insertions long, q_base_insertions long, t_insertions long, t_base_insertions long, strand string, q_name string, q_size long, q_start long, q_end long, t_name string, t_size long, t_start long, t_end long, block_count long, block_sizes string, q_starts string, t_starts string"


def psl(spark: SparkSession, path: str) -> DataFrame:
    """Alignments, with their lists as arrays and match_fraction."""
    longs = lambda c: F.transform(F.filter(F.split(F.col(c), ","), lambda x: x != ""), lambda x: x.cast("long"))
    raw = tsv(spark, path, PSL, header=False, quoted=False).where("block_count IS NOT NULL")
    return raw.withColumns({c: longs(c) for c in ("block_sizes", "q_starts", "t_starts")}).withColumn("match_fraction", F.try_divide("matches", "q_size"))


def bed(spark: SparkSession, path: str) -> DataFrame:
    names = ["chrom", "chromStart", "chromEnd", "name", "score", "strand", "thickStart", "thickEnd", "itemRgb", "blockCount", "blockSizes", "blockStarts"]
    kinds = ["string", "long", "long", "string", "double", "string", "long", "long", "string", "int", "string", "string"]
    return tsv(spark, path, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)), header=False, quoted=False, comment="#")


def tblout(spark: SparkSession, path: str, clans: bool = True) -> DataFrame:
    """Infernal's table of hits, in the layout with clan competition (27 fields) or without (18); the last field takes the rest."""
    names = (
        ["idx", "target_name", "target_accession", "query_name", "query_accession", "clan", "mdl", "mdl_from", "mdl_to", "seq_from", "seq_to", "strand", "trunc", "pass", "gc", "bias", "score", "e_value", "inc", "overlap", "anyidx", "afrct1", "afrct2", "winidx", "wfrct1", "wfrct2", "description"]
        if clans
        else ["target_name", "target_accession", "query_name", "query_accession", "mdl", "mdl_from", "mdl_to", "seq_from", "seq_to", "strand", "trunc", "pass", "gc", "bias", "score", "e_value", "inc", "description"]
    )
    parts = F.split(F.trim("value"), r"\s+", len(names))
    number = {"mdl_from": "long", "mdl_to": "long", "seq_from": "long", "seq_to": "long", "gc": "double", "bias": "double", "score": "double", "e_value": "double"}
    rows = spark.read.text(path).where("value NOT LIKE '#%' AND trim(value) <> ''").select(parts.alias("p"))
    return rows.select(*[F.get("p", k).try_cast(number[n]).alias(n) if n in number else F.get("p", k).alias(n) for k, n in enumerate(names)])


def best_hits(hits: DataFrame) -> DataFrame:
    """Hits that clan competition keeps: unique ones (*) and the best of several (^)."""
    return hits.where(F.col("overlap").isin("*", "^"))


def cpat(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path).select(F.col("seq_ID").alias("urs"), F.col("Fickett").cast("double").alias("fickett"), F.col("Hexamer").cast("double").alias("hexamer"), F.col("Coding_prob").cast("double").alias("coding_prob"), F.col("ORF_start").cast("long").alias("start"), F.col("ORF_end").cast("long").alias("stop"), F.col("ORF_strand").alias("strand"))


def tcode(spark: SparkSession, path: str) -> DataFrame:
    """urs, mean, sd: blocks that start at '# Sequence:', with a score in the fourth column of each window."""
    blocks = spark.read.text(path, lineSep="# Sequence:").where("value LIKE '%to:%'")
    name = F.regexp_extract("value", r"^\s*(\S+)", 1)
    scores = F.transform(F.regexp_extract_all("value", F.lit(r"(?m)^\s*\d+\s+\d+\s+[+-]\s+([0-9.]+)"), F.lit(1)), lambda x: x.cast("double"))
    exploded = blocks.select(name.alias("urs"), F.explode(scores).alias("score"))
    return exploded.groupBy("urs").agg(F.avg("score").alias("mean"), F.coalesce(F.stddev_samp("score"), F.lit(0.0)).alias("sd"))


def trnascan(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select(parts.alias("p")).where(F.get("p", 1).try_cast("int").isNotNull())
    return rows.select(F.get("p", 0).alias("urs"), F.get("p", 1).cast("int").alias("hit"), F.get("p", 2).cast("long").alias("start"), F.get("p", 3).cast("long").alias("stop"), F.get("p", 4).alias("isotype"), F.get("p", 5).alias("anticodon"), F.get("p", 8).try_cast("double").alias("score"))


def ribovore(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where("value NOT LIKE '#%' AND trim(value) <> ''").select(parts.alias("p"))
    return rows.select(F.get("p", 1).alias("target"), F.get("p", 2).alias("status"), F.get("p", 3).try_cast("long").alias("length"), F.get("p", 7).alias("model"), F.get("p", 8).alias("strand"))


def dfam(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split(F.trim("value"), r"\s+", 15)
    rows = spark.read.text(path).where("value NOT LIKE '#%' AND trim(value) <> ''").select(parts.alias("p"))
    return rows.select(F.get("p", 0).alias("target"), F.get("p", 1).alias("accession"), F.get("p", 2).alias("query"), F.get("p", 3).try_cast("double").alias("bits"), F.get("p", 4).try_cast("double").alias("e_value"))


def xml(spark: SparkSession, path: str, row: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row)
    return (reader.schema(schema) if schema else reader).load(path)


def obo(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(terms: id, name; edges: term, parent) of an OBO file; obsolete terms go."""
    blocks = spark.read.text(path, lineSep="[Term]").where("value LIKE '%id:%' AND value NOT LIKE '%is_obsolete: true%'")
    one = lambda key: F.regexp_extract("value", rf"(?m)^{key}: (.*?)\s*$", 1)
    terms = blocks.select(one("id").alias("id"), one("name").alias("name"), "value").where("id <> '' AND name <> ''")
    edges = terms.select(F.col("id").alias("term"), F.explode(F.regexp_extract_all("value", F.lit(r"(?m)^is_a: (\S+)"), F.lit(1))).alias("parent"))
    return terms.select("id", "name"), edges


def taxonomy_dump(spark: SparkSession, names: str, nodes: str, merged: str) -> DataFrame:
    """taxid, name, parent, rank, replaced (old taxids) of the tab-pipe-tab dump."""
    def read(path: str, columns: list[str]) -> DataFrame:
        parts = F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t")
        return spark.read.text(path).where("value <> ''").select(*[F.get(parts, k).alias(c) for k, c in enumerate(columns)])

    name = read(names, ["taxid", "name", "unique", "kind"]).where("kind = 'scientific name'").groupBy("taxid").agg(F.min("name").alias("name"))
    node = read(nodes, ["taxid", "parent", "rank"])
    old = read(merged, ["old", "taxid"]).groupBy("taxid").agg(F.array_sort(F.collect_set(F.col("old").cast("long"))).alias("replaced"))
    return node.join(name, "taxid").join(old, "taxid", "left").select(F.col("taxid").cast("long").alias("taxid"), "name", F.col("parent").cast("long").alias("parent"), "rank", F.coalesce("replaced", F.array().cast("array<bigint>")).alias("replaced"))


#: The fields of MITAB 2.7, the first fifteen.
MITAB = ["id_a", "id_b", "alt_a", "alt_b", "alias_a", "alias_b", "method", "author", "publication", "taxid_a", "taxid_b", "type", "source", "interaction_id", "confidence"]


def mitab(spark: SparkSession, path: str) -> DataFrame:
    """Interactions: lists at | as arrays, '-' as null."""
    parts = F.split("value", "\t", -1)
    rows = spark.read.text(path).where("value NOT LIKE '#%' AND trim(value) <> ''").select(parts.alias("p"))
    field = lambda k: F.split(F.nullif(F.get("p", k), F.lit("-")), r"\|")
    taxid = lambda c: F.regexp_extract(F.get(F.col(c), 0), r"taxid:(-?\d+)", 1).try_cast("long")
    return rows.select(*[field(k).alias(c) for k, c in enumerate(MITAB)]).withColumns({c: taxid(c) for c in ("taxid_a", "taxid_b")})


#: The fields of GPA.
GPA = ["database", "object_id", "qualifier", "go_id", "reference", "evidence", "with_from", "taxon", "date", "assigned_by", "extension", "properties"]


def gpa(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path).where("value NOT LIKE '!%' AND trim(value) <> ''").select(F.split("value", "\t", -1).alias("p"))
    return rows.select(*[F.nullif(F.get("p", k), F.lit("")).alias(c) for k, c in enumerate(GPA)]).distinct()


def jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, low: int = 0, high: int = 0, parts: int = 1, **properties: str) -> DataFrame:
    """A table or query of a database; with a column, read in id ranges."""
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=column, lowerBound=low, upperBound=high, numPartitions=parts, properties=properties)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def checked_lookup(keys: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The rows of the keys; raises if a key has none."""
    joined = keys.select(key).distinct().join(table.withColumn("_found", F.lit(True)), key, "left")
    ok = F.when(F.col("_found"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("not found: "), F.col(key).cast("string"))).cast(table.schema[key].dataType))
    return joined.withColumn(key, ok).drop("_found")
