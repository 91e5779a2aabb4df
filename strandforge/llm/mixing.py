"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a token (word) budget. Whole epochs of a source come first;
what is left of the budget goes to its documents in the order of exponential
keys -ln(u) / weight, where weight is the document's quality, until a prefix
sum of their sizes reaches it. The last document taken gives only as many of its
first words as are left, so that every source meets its budget to the word.

Keys depend on seed, doc_id and the text's checksum alone, so reruns agree.
Prefix sums run over bins of the keys: sizes are added up by source and bin,
then only the one bin of each source in which its budget ends is sorted. The
number of bins grows with the table, so a source that holds a third of all rows
puts no more into a task than any other.

Defined results: null texts and texts without words have size 0 and are taken 0
times; null is a source of its own and comes last; repeated rows count each
time and share a key, and ties go by doc_id; an empty table gives an empty
table; columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Weights of the sources by code point of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target is at most so many times its size.
MAX_EPOCHS = 3
#: Rows that a bin of keys has on average, and the fewest bins of a source.
BIN_ROWS, MIN_BINS = 20_000, 64
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text="text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text="text"):
    """Between 0.5 and 1: less for texts with many symbols."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.coalesce(1.0 / (1.0 + F.least(F.lit(1.0), 10.0 * symbols / F.greatest(F.length(text), F.lit(1)))), F.lit(1.0))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target of a table (source, source_size), one row a source.

    The share is min(most * size, rate * weight) with one rate for all: sources
    sorted by most * size / weight are capped up to some place, found
    by running sums. The table has a row for each source, not for each document.
    """
    in_order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("_i", F.row_number().over(in_order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight).withColumn("_cap", (F.col("source_size") * most).cast("double"))
    every = Window.partitionBy()
    up = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_i")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.select(
        "*",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(up), F.lit(0.0))).alias("_left"),
        (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(up), F.lit(0.0))).alias("_open"),
    ).withColumn("_rate", F.col("_left") / F.col("_open"))
    # the first source in that order whose cap isn't passed fixes the rate; if there is none, all are capped
    rate = F.min(F.when(F.col("_cap") > F.col("_rate") * F.col("_w"), F.struct(F.col("_cap") / F.col("_w"), F.col("_i"), F.col("_rate")))).over(every)
    ranked = ranked.withColumn("_first", rate)
    return ranked.select("source", "source_size", F.least(F.col("_cap"), F.coalesce(F.col("_first._rate") * F.col("_w"), F.col("_cap"))).alias("target"))


def _key(seed: str, weight):
    """The exponential key of a document; it depends on seed, doc_id, text and weight alone."""
    return -F.log(common.unit(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("text_md5")), seed)) / weight


def _bin():
    # 1 - exp(-key) grows with the key and is spread over (0, 1)
    return F.floor((1 - F.exp(-F.col("key"))) * F.col("_bins")).cast("long")


def _plan(small: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row a source: _s, source_size, target, _epochs, _budget, _bins, _last, _before.

    The budget of words beside whole epochs ends in bin _last, before which
    _before words lie (_last is null if all documents fit, or none has words).
    """
    by_source = small.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    wanted = targets(by_source.select("source", "source_size"), weights, most)
    by_source = wanted.join(by_source.select(F.col("source").alias("_s"), "_rows"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    by_source = by_source.select(
        F.col("source").alias("_s"), "source_size", "target", epochs.alias("_epochs"),
        F.round(F.col("target") - epochs * F.col("source_size")).cast("long").alias("_budget"),
        F.greatest(F.lit(MIN_BINS), F.ceil(F.col("_rows") / BIN_ROWS)).cast("long").alias("_bins"),
    )
    by_source = common.staged(by_source, "mix-sources")
    joined = small.join(by_source, small["source"].eqNullSafe(F.col("_s")))
    bins = joined.withColumn("_bin", _bin()).groupBy("_s", "_budget", "_bin").agg(F.sum("size").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.partitionBy("_s").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = bins.withColumn("_before", before)
    last = bins.where((F.col("_before") <= F.col("_budget")) & (F.col("_before") + F.col("_size") > F.col("_budget")))
    last = last.groupBy(F.col("_s").alias("_t")).agg(F.min("_bin").alias("_last"), F.min_by("_before", "_bin").alias("_before"))
    return common.staged(by_source.join(last, F.col("_s").eqNullSafe(F.col("_t")), "left").drop("_t"), "mix-plan")


def _split(keyed: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """keyed with the plan: rows with _part, and the rows of the bins in which budgets end."""
    joined = keyed.join(plan, keyed["source"].eqNullSafe(F.col("_s"))).withColumn("_bin", _bin())
    # without a bin in which the budget ends, it takes in every document
    inside = F.col("_last").isNotNull() & (F.col("_bin") == F.col("_last"))
    whole = F.when(F.col("_last").isNull() | (F.col("_bin") < F.col("_last")), F.least(F.col("size"), F.col("_budget"))).otherwise(F.lit(0))
    return joined.where(~inside).withColumn("_part", whole), joined.where(inside)


def _edge_parts(edge: DataFrame) -> DataFrame:
    order = Window.partitionBy("source").orderBy("key", "doc_id", "text_md5", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("_upto", F.col("_before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    return edge.withColumn("_part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_budget") - F.col("_upto"))))


def _small(docs: DataFrame, seed: str, weight) -> DataFrame:
    small = docs.select("doc_id", "source", size_of().alias("size"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_md5"), weight.alias("_w"))
    return common.staged(small.select("doc_id", "text_md5", "source", "size", _key(seed, F.col("_w")).alias("key")), "mix-keys")


def shares(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS, seed: str = SEED, weight=None) -> DataFrame:
    """doc_id, text_md5, size, source, source_size, target, taken: one row for each row of docs.

    weight: a column of documents' weights above 0 (default: quality_weight()).
    """
    small = _small(docs, seed, quality_weight() if weight is None else weight)
    rest, edge = _split(small, _plan(small, weights, most))
    columns = ["doc_id", "text_md5", "size", "source", "source_size", "target", "_epochs", "_part"]
    every = rest.select(*columns).unionByName(_edge_parts(edge).select(*columns))
    return every.select("doc_id", "text_md5", "size", "source", "source_size", "target", (F.col("_epochs") * F.col("size") + F.col("_part")).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS, seed: str = SEED, weight=None) -> DataFrame:
    """The mixture: docs' columns, each document as often as it is taken.

    A last partial copy has the document's first words only, as many as the
    budget has left, joined by one space, and their length as n_chars. Documents
    without words carry nothing to mix and go. Texts stay where they are but
    for those of the few bins in which budgets end.
    """
    w = quality_weight() if weight is None else weight
    plan = _plan(_small(docs, seed, w), weights, most)
    had = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), "doc_id", "source", "text", size_of().alias("size"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_md5"), w.alias("_w"))
    rest, edge = _split(had.withColumn("key", _key(seed, F.col("_w"))), plan)
    columns = ["_row", "size", "_epochs", "_part"]
    every = rest.select(*columns).unionByName(_edge_parts(edge).select(*columns))
    # -1: a whole copy; otherwise so many words
    part = F.when(F.col("_part") >= F.col("size"), F.array(F.lit(-1).cast("long"))).when(F.col("_part") > 0, F.array(F.col("_part").cast("long"))).otherwise(F.array().cast("array<bigint>"))
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), F.col("_epochs").cast("int")), part)
    out = every.where("size > 0").select("_row", F.explode(copies).alias("_words"))
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("_row.text"), F.lit(WORD), F.lit(0)), 1, F.greatest(F.col("_words"), F.lit(1)).cast("int")), " ")
    text = F.when(F.col("_words") < 0, F.col("_row.text")).otherwise(first)
    made = {"text": text}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.col("_words") < 0, F.col("_row.n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType)
    return out.select(*[made.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.need(common.documents(spark, sf_dir), ["doc_id", "source", "text"])
    return shares(docs).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
k AS (
  SELECT doc_id, source, size, md5(text) AS h,
    -ln((('0x' || substr(md5('mix:' || doc_id || ':' || md5(text)), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
    / (1.0::DOUBLE / (1.0::DOUBLE + least(1.0::DOUBLE, 10.0::DOUBLE * (length(text) - length(translate(text, '#*$%&|<>', ''))) / greatest(length(text), 1)))) AS key
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS i FROM k GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][i % 3 + 1]::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap FROM s),
u AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS rate
  FROM w WINDOW b AS (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT rate FROM u AS v WHERE v.cap > v.rate * v.w ORDER BY v.cap / v.w, v.i LIMIT 1) * w, cap)) AS target FROM u),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
b AS (SELECT *, round(target - epochs * source_size)::BIGINT AS budget FROM e),
o AS (
  SELECT doc_id, size, source_size, target, epochs, budget,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - upto)))::BIGINT AS taken FROM o
"""
