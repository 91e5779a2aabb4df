"""The training-data pipeline: documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a table that is written
before the next one reads it. All but the last return the columns of documents.

Defined results, for every stage: an empty table gives an empty table with the stage's
columns; a null text counts as an empty one; repeated rows and rows with a null doc_id
or source are rows of their own (near copies aside, of which one stays); texts are read whole, however long;
columns that documents has besides doc_id, text, source and n_chars pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandforge.llm import common, jaccard, mixing, packing, quality, toxicity

#: A file for packing's token ids; any tokenizers file that all executors have.
VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 by a model fitted to labels; empty texts score its bias. Without labels of both classes nothing is learnt, and all have the share of toxic labels as their score."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, labels)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that quality rules keep; empty texts have too few words and go. A null source is a host."""
    return quality.drop_failing(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id; of rows alike in doc_id and text one. Texts without words are in no group and stay."""
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a document stands in it as often as it is taken, a last time in part. Texts without words aren't taken."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces without their ids: doc_id, start and length name them in the document's ids. An empty text has its closing id."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(VOCABULARY), with_ids=False).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: No SQL: the stages hash, learn and encode. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
