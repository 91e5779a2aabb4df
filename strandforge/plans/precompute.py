"""Per-sequence annotation: what to update, its metadata, type, description and quality flags."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import relational as R

#: Rfam families whose fragments are reported.
FRAGMENT_FAMILIES = ["RF00001", "RF00002", "RF00005", "RF00177", "RF01959", "RF01960", "RF02540", "RF02541", "RF02542", "RF02543"]
#: Domains that say nothing about the organism.
GENERIC_DOMAINS = ["unclassified sequences", "artificial sequences", "miscellaneous sequences", "other sequences"]
#: A type without more detail.
DEFAULT_TYPE, DEFAULT_SO = "ncRNA", "SO:0000655"
MITO_RRNA = "SO:0002128"


def outdated(xref: DataFrame, known: DataFrame) -> DataFrame:
    """upi, last: sequences whose latest release is newer than what was computed; a computed release that is newer raises.

    xref: upi, last. known: upi, last_release. Both are reduced to one row a upi first.
    """
    new = xref.groupBy("upi").agg(F.max("last").alias("last"))
    old = known.groupBy("upi").agg(F.max("last_release").alias("_known"))
    joined = new.join(old, "upi", "left")
    checked = F.when(F.col("_known") > F.col("last"), F.raise_error(F.lit("computed for a release that is not loaded")).cast("boolean")).otherwise(F.col("_known").isNull() | (F.col("last") > F.col("_known")))
    return joined.where(checked).select("upi", "last")


def accession_table(xref: DataFrame, accessions: DataFrame, wanted: DataFrame) -> DataFrame:
    """The accessions of the wanted upis with their cross-references, one join for all databases."""
    rows = xref.join(wanted.select("upi"), "upi", "left_semi").join(accessions, "ac")
    return rows.select("upi", "taxid", "ac", "database", "rna_type", "description", "gene", "species", (F.col("deleted") == "N").alias("is_active"), "last", F.concat_ws("_", "upi", F.col("taxid").cast("string")).alias("urs_taxid"))


def merged_metadata(base: DataFrame, accessions: DataFrame, children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """base (urs_taxid) with accessions and each child table, last_release and deleted (no accession is active).

    children: name -> (table, criterion of group_children).
    """
    own = accessions.groupBy("urs_taxid").agg(F.max("last").alias("last_release"), F.bool_and(~F.col("is_active")).alias("deleted"))
    return R.merge_children(base.join(own, "urs_taxid"), "urs_taxid", {"accessions": (accessions.select("urs_taxid", "ac", "database", "rna_type", "description", "is_active"), "at_least_one"), **children})


def first_known(*values: Column) -> Column:
    """The first value that isn't null: one ORF call out of several tools."""
    return F.coalesce(*values)


def orf_calls(df: DataFrame, cpat_cutoff: float = 0.364, stopfree_limit: float = 1e-4, tcode_limit: float = 0.95) -> DataFrame:
    """is_orf of each tool; null where a tool gave nothing. df: coding_prob, strand, run_probability, tcode_mean, tcode_sd."""
    return df.select(
        "*",
        ((F.col("coding_prob") >= cpat_cutoff) & (F.col("strand") == "+")).alias("cpat_orf"),
        (F.col("run_probability") <= stopfree_limit).alias("stopfree_orf"),
        (F.col("tcode_mean") - F.coalesce("tcode_sd", F.lit(0.0)) > tcode_limit).alias("tcode_orf"),
    )


def completeness(df: DataFrame) -> DataFrame:
    """sequence_completeness and model_completeness of hits: the share of the whole that the hit spans."""
    part = lambda a, b, n: F.try_divide(F.abs(F.col(b) - F.col(a)), F.col(n))
    return df.select("*", part("sequence_start", "sequence_stop", "len").alias("sequence_completeness"), part("model_start", "model_stop", "model_length").alias("model_completeness"))


def qa_flags(df: DataFrame, expected: dict[str, list[str]]) -> DataFrame:
    """Seven three-valued flags, has_issue and the messages of those that are true.

    df: rna_type, domains (array), hits (array of structs model, domain,
    sequence_completeness, model_completeness), is_mitochondrial, is_chloroplast, in_repeat, cpat_orf,
    stopfree_orf, tcode_orf (null: not assessed). expected: rna_type -> families.
    """
    hits, one = F.col("hits"), F.get(F.col("hits"), 0)
    single = F.size(hits) == 1
    models = F.transform(hits, lambda h: h["model"])
    generic = F.arrays_overlap(F.col("domains"), F.array(*[F.lit(d) for d in GENERIC_DOMAINS]))
    organelle = (F.col("rna_type") == "rRNA") & (F.col("is_mitochondrial") | F.col("is_chloroplast"))
    contaminated = single & one["domain"].isNotNull() & (F.size("domains") > 0) & ~generic & ~F.array_contains(F.col("domains"), one["domain"]) & ~organelle
    incomplete = single & one["model"].isin(FRAGMENT_FAMILIES) & (one["model_completeness"] <= 0.5) & (one["sequence_completeness"] >= 0.9)
    needs = F.lit(False)
    for rna_type, families in expected.items():
        lacks = (F.col("rna_type") == rna_type) & ~F.arrays_overlap(models, F.array(*[F.lit(f) for f in families]))
        needs = needs | (lacks & ~((F.lit(rna_type) == "tRNA") & F.col("is_mitochondrial") & (F.size(hits) == 0)))
    flags = {
        "incomplete_sequence": F.coalesce(incomplete, F.lit(False)),
        "possible_contamination": F.coalesce(contaminated, F.lit(False)),
        "missing_rfam_match": F.coalesce(needs, F.lit(False)),
        "from_repetitive_region": F.col("in_repeat"),
        "possible_orf": F.col("cpat_orf"),
        "possible_orf_stopfree": F.col("stopfree_orf"),
        "possible_orf_tcode": F.col("tcode_orf"),
    }
    made = df.select("*", *[c.alias(n) for n, c in flags.items()])
    any_true = reduce(lambda a, b: a | b, [F.coalesce(F.col(n), F.lit(False)) for n in flags])
    messages = F.array_compact(F.array(*[F.when(F.col(n), F.lit(n.replace("_", " "))) for n in flags]))
    return made.select("*", any_true.alias("has_issue"), messages.alias("messages"))


ANNOTATION = "urs_taxid string, path array<string>, sources array<string>"


def merge_type_paths(annotations: DataFrame) -> DataFrame:
    """Annotations of each sequence merged in order: equal paths, and a path with one that it starts, become one (the longer).

    annotations: urs_taxid, place, path (array of terms from the root), source. The order
    decides, so a group is one task's; groups are a sequence's annotations, a few rows each.
    """

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        groups: list[tuple[list[str], set[str]]] = []
        for path, source in rows.sort_values("place")[["path", "source"]].itertuples(index=False):
            path = list(path)
            for k, (have, sources) in enumerate(groups):
                short = min(len(have), len(path))
                if have[:short] == path[:short]:
                    groups[k] = (max(have, path, key=len), sources | {source})
                    break
            else:
                groups.append((path, {source}))
        return pd.DataFrame({"urs_taxid": rows["urs_taxid"].iloc[0], "path": [g[0] for g in groups], "sources": [sorted(g[1]) for g in groups]})

    return annotations.groupBy("urs_taxid").applyInPandas(merge, ANNOTATION)


def decide_type(merged: DataFrame) -> DataFrame:
    """urs_taxid, so_type: the decision ladder over merged annotations.

    One annotation decides alone; then a single specific one of a model-organism
    database; a single hit of a model; any of a model-organism database; lncRNA if all
    databases agree on it; r2dt's and Rfam's ribosomal types; Rfam's own; else ncRNA.
    """
    last = F.element_at("path", -1)
    has = lambda name: F.array_contains("sources", name)
    lnc = F.arrays_overlap("path", F.array(F.lit("lnc_RNA"), F.lit("antisense_RNA")))
    database = has("mod") | has("generic")
    g = merged.groupBy("urs_taxid").agg(
        F.count("*").alias("n"), F.min(last).alias("only"),
        F.count_if(has("mod") & (F.size("path") > 1)).alias("n_mod"), F.min(F.when(has("mod") & (F.size("path") > 1), last)).alias("mod"),
        F.count_if(has("rfam_hit") | has("r2dt")).alias("n_hit"), F.min(F.when(has("rfam_hit") | has("r2dt"), last)).alias("hit"),
        F.min(F.when(has("mod"), last)).alias("any_mod"), F.bool_and(~database | lnc).alias("all_lnc"), F.bool_or(database).alias("some_db"), F.min(F.when(database & lnc, last)).alias("lnc"),
        F.min(F.when(has("r2dt") & F.array_contains("path", "rRNA"), last)).alias("r2dt"), F.min(F.when(has("rfam_db"), last)).alias("rfam_db"),
    )
    ladder = F.when(F.col("n") == 1, F.col("only")).when(F.col("n_mod") == 1, F.col("mod")).when(F.col("n_hit") == 1, F.col("hit")).when(F.col("any_mod").isNotNull(), F.col("any_mod"))
    ladder = ladder.when(F.col("all_lnc") & F.col("some_db"), F.col("lnc")).when(F.col("r2dt").isNotNull(), F.col("r2dt")).when(F.col("rfam_db").isNotNull(), F.col("rfam_db")).otherwise(DEFAULT_TYPE)
    return g.select("urs_taxid", ladder.alias("so_type"))


#: Rewrites of sets of INSDC types, in order: if all of the first are there, the second go.
TYPE_REWRITES = [
    (["lncRNA", "antisense_RNA"], ["antisense_RNA"]),
    (["pre_miRNA", "miRNA"], ["pre_miRNA"]),
    (["snoRNA", "scaRNA"], ["snoRNA"]),
    (["misc_RNA"], ["misc_RNA"]),
    (["other"], ["other"]),
    (["ncRNA"], ["ncRNA"]),
]


def rewrite_types(types: Column) -> Column:
    """Drops less specific types from an array while something more specific remains."""
    out = F.array_distinct(types)
    for have, gone in TYPE_REWRITES:
        less = F.array_except(out, F.array(*[F.lit(x) for x in gone]))
        hit = reduce(lambda a, b: a & b, [F.array_contains(out, x) for x in have])
        out = F.when(hit & (F.size(less) > 0), less).otherwise(out)
    return out


def best_descriptions(accessions: DataFrame, preference: list[str]) -> DataFrame:
    """urs_taxid, description: of the most preferred database, the most informative text (entropy, then low character codes)."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(p) for p in preference]), F.col("database")), F.lit(0))
    rows = accessions.where("description IS NOT NULL").select("urs_taxid", "description", F.when(place == 0, len(preference) + 1).otherwise(place).alias("_rank"))
    # ranks are aggregated without the texts, which may be long
    best = rows.groupBy(F.col("urs_taxid").alias("_of")).agg(F.min("_rank").alias("_best"))
    preferred = rows.join(best, F.col("urs_taxid").eqNullSafe(F.col("_of")) & (F.col("_rank") == F.col("_best")))
    score = F.struct(-F.round(text.entropy(F.col("description")), 3), text.low_codes(F.col("description")))
    return preferred.groupBy("urs_taxid").agg(F.min_by("description", score).alias("description"))


def summarised_names(names: Column, limit: int = 3) -> Column:
    """'a, b and c', or 'a, b, c and n others'."""
    n = F.size(names)
    head = F.slice(names, 1, limit)
    return F.when(n <= 1, F.array_join(names, ", ")).when(n <= limit, F.concat(F.array_join(F.slice(names, F.lit(1), F.greatest(n - 1, F.lit(1))), ", "), F.lit(" and "), F.element_at(names, -1))).otherwise(F.concat(F.array_join(head, ", "), F.lit(" and "), (n - limit).cast("string"), F.lit(" others")))


def rolled_up(rows: DataFrame) -> DataFrame:
    """One row a upi (taxid null) from its active species rows, else from all of them.

    rows: upi, taxid, is_active, rna_type, so_type, databases (array), description, last_release.
    """
    any_active = rows.groupBy("upi").agg(F.bool_or("is_active").alias("_some"))
    used = rows.join(any_active, "upi").where(~F.col("_some") | F.col("is_active"))
    one = lambda c, default: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.lit(default))
    return used.groupBy("upi").agg(
        F.lit(None).cast("long").alias("taxid"), F.bool_or("is_active").alias("is_active"), one("rna_type", DEFAULT_TYPE).alias("rna_type"), one("so_type", DEFAULT_SO).alias("so_type"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("databases")))).alias("databases"), F.count_distinct("taxid").alias("n_species"), F.min_by("description", F.struct("taxid", "description")).alias("description"), F.max("last_release").alias("last_release"),
    )


def inactive_rows(rows: DataFrame, previous: DataFrame) -> DataFrame:
    """Inactive sequences keep the type and description that they had before, else those derived now."""
    p = previous.select("urs_taxid", F.col("rna_type").alias("_type"), F.col("description").alias("_text"))
    return rows.where("NOT is_active").join(p, "urs_taxid", "left").select("urs_taxid", F.coalesce("_type", "rna_type", F.lit(DEFAULT_TYPE)).alias("rna_type"), F.coalesce("_text", "description").alias("description"))


def should_show(df: DataFrame, least: float = 0.4, most: float = 1.6) -> DataFrame:
    """Whether a secondary structure is shown: pairs found over pairs of the model, rounded half to even to one decimal."""
    ratio = F.try_divide(F.col("base_pairs"), F.col("model_base_pairs"))
    return df.withColumn("should_show", F.bround(ratio.cast("decimal(20,6)"), 1).between(least, most))


def ontology_paths(edges: DataFrame, bases: list[str], depth: int = 20) -> DataFrame:
    """term, path: the shortest way from one of the base terms to each term, the first in order of names.

    edges: term, parent (is_a). Terms are a small dimension; each round joins one level.
    """
    spark = edges.sparkSession
    reached = spark.createDataFrame([(b, [b]) for b in bases], "term string, path array<string>")
    level = reached
    for _ in range(depth):
        step = level.withColumnRenamed("term", "parent").join(edges, "parent").select("term", F.concat("path", F.array("term")).alias("path"))
        step = step.join(reached.select("term"), "term", "left_anti").groupBy("term").agg(F.min("path").alias("path"))
        # a few thousand terms: the driver holds a level, which keeps the plan flat
        rows = [(r["term"], list(r["path"])) for r in step.collect()]
        if not rows:
            break
        level = spark.createDataFrame(rows, "term string, path array<string>")
        reached = reached.unionByName(level)
    return reached
