"""Toxicity by a linear classifier of character n-grams scaled by naive Bayes ratios.

Features are the character n-grams (lengths 4 to 6) within a text's words, in
lower case and with a mark at each end of a word, present or not. Each present
feature has the value of its log-count ratio between the classes; a logistic
regression with an L2 penalty is fitted over the FEATURES whose presence differs
most between them.

Training rows are a bounded sample of the labelled rows: at most CLASS_ROWS of
each class, chosen by a hash of doc_id. Counts of n-grams are added up by the
executors; the driver gets the chosen features and the sample's feature numbers,
and fits the model. Scoring is a projection of each whole text.

Defined results: a null or empty text has no features and scores the bias;
without rows of both classes every score is the share of toxic rows (0 without
rows); a null label is no label; several labels of a doc_id all count; repeated
rows are scored each time; columns named like a result are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Bound of the training sample in rows of each class.
CLASS_ROWS = 5_000
SIZES = (4, 5, 6)
#: Features, and training texts that must have one.
FEATURES, MIN_TEXTS = 8_000, 4
PENALTY, STEPS = 1e-3, 300
#: Words whose features a worker remembers when it scores; words and n-grams that it holds when it counts.
STORE, COUNT_WORDS, COUNT_GRAMS = 100_000, 10_000, 250_000
MARK = "\x02"


def grams(word: str, sizes: tuple[int, ...] = SIZES) -> set[str]:
    w = MARK + word + MARK
    return {w[i : i + n] for n in sizes for i in range(len(w) - n + 1)}


class Model:
    """weights: by n-gram; score() is a probability."""

    def __init__(self, weights: dict[str, float], bias: float, sizes: tuple[int, ...] = SIZES) -> None:
        self.names = list(weights)
        self.number = {g: k for k, g in enumerate(self.names)}
        self.weights = np.fromiter(weights.values(), np.float64, len(weights))
        self.bias, self.sizes = bias, sizes
        self.known: dict[str, tuple[int, ...]] = {}

    def __reduce__(self):
        return Model, (dict(zip(self.names, self.weights.tolist())), self.bias, self.sizes)

    def features(self, text: str) -> set[int]:
        found: set[int] = set()
        known, number = self.known, self.number
        for w in set(text.lower().split()):
            of = known.get(w)
            if of is None:
                if len(known) >= STORE:
                    known.clear()
                of = known[w] = tuple(number[g] for g in grams(w, self.sizes) if g in number)
            if of:
                found.update(of)
        return found

    def score(self, text: str) -> float:
        # sorted, so that the sum doesn't depend on the order of a set
        z = self.bias + float(self.weights[sorted(self.features(text))].sum())
        return 1.0 / (1.0 + np.exp(-max(-500.0, min(500.0, z))))


def training_rows(docs: DataFrame, labels: DataFrame, class_rows: int = CLASS_ROWS) -> DataFrame:
    """doc_id, text, toxic of the sample. labels: doc_id, toxic; only labelled ids (bounded) are broadcast."""
    labels = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    u = common.unit(F.col("doc_id"), "toxic-sample")
    chance = F.when(F.col("toxic") == 1, class_rows / max(1, n.get(1, 0))).otherwise(class_rows / max(1, n.get(0, 0)))
    picked = labels.withColumn("_u", u).where(F.col("_u") < chance)
    # the limit holds the bound against chance; it cuts at a hash, not at a place
    picked = picked.where("toxic = 1").orderBy("_u", "doc_id").limit(class_rows).unionByName(picked.where("toxic = 0").orderBy("_u", "doc_id").limit(class_rows))
    return docs.select("doc_id", "text").join(F.broadcast(picked.drop("_u")), "doc_id")


def fit(rows: DataFrame, sizes: tuple[int, ...] = SIZES, features: int = FEATURES, penalty: float = PENALTY) -> Model:
    """rows: text, toxic (0 or 1), a bounded sample."""
    rows = common.staged(rows.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), "toxic"), "toxic-rows")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        share = n1 / max(1, n0 + n1)
        return Model({}, float(np.log((share + 1e-9) / (1 - share + 1e-9))), sizes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        of: dict[str, set[str]] = {}

        def flush() -> pa.RecordBatch:
            names = sorted(found[0].keys() | found[1].keys())
            made = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[g] for g in names], pa.int64()) for c in found)], names=["gram", "clean", "toxic"])
            for c in found:
                c.clear()
            of.clear()
            return made

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                own: set[str] = set()
                for w in set(text.lower().split()):
                    if w not in of:
                        of[w] = grams(w, sizes)
                    own |= of[w]
                found[toxic].update(own)
                if len(found[0]) + len(found[1]) > COUNT_GRAMS:
                    yield flush()
                elif len(of) > COUNT_WORDS:
                    of.clear()
        yield flush()

    counts = common.arrow_map(rows, count, "gram string, clean long, toxic long").groupBy("gram").agg(F.sum("clean").alias("q"), F.sum("toxic").alias("p"))
    both = (F.col("p") + F.col("q")) / (n1 + n0)
    z = F.abs(F.col("p") / n1 - F.col("q") / n0) / F.sqrt(both * (1 - both) * (1 / n1 + 1 / n0) + 1e-12)
    chosen = counts.where((F.col("p") + F.col("q") >= MIN_TEXTS) & (F.col("p") + F.col("q") < n1 + n0)).orderBy(z.desc(), "gram").limit(features).collect()
    ratio = {r["gram"]: float(np.log(((r["p"] + 1) / (n1 + 2)) / ((r["q"] + 1) / (n0 + 2)))) for r in chosen}
    if not ratio:
        return Model({}, float(np.log(n1 / n0)), sizes)
    shape = Model(ratio, 0.0, sizes)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(shape.features(x)) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32())), batch.column("toxic")], names=["own", "toxic"])

    sample = common.arrow_map(rows, number, "own array<int>, toxic int").toArrow()
    own = sorted(zip(sample.column("own").to_pylist(), sample.column("toxic").to_pylist()))
    y = np.array([t for _, t in own], np.float64)
    which = np.concatenate([np.array(o, np.int64) for o, _ in own])
    row = np.repeat(np.arange(len(own)), [len(o) for o, _ in own])
    r = shape.weights
    # Nesterov's descent on the mean log loss, both classes weighing the same
    cost = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    value = r[which]
    largest = 0.25 * np.bincount(row, value**2, len(y)).max() + 0.25
    w, b, v, c, rate = np.zeros(len(r)), 0.0, np.zeros(len(r)), 0.0, 4.0 / largest
    for k in range(STEPS):
        z = np.bincount(row, value * v[which], len(y)) + c
        g = cost * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        dw = np.bincount(which, value * g[row], len(r)) + penalty * v
        nw, nb = v - rate * dw, c - rate * g.sum()
        push = k / (k + 3)
        v, c, w, b = nw + push * (nw - w), nb + push * (nb - b), nw, nb
    return Model(dict(zip(ratio, (w * r).tolist())), float(b), sizes)


SCORE = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def _scores(model: Model, batch: pa.RecordBatch) -> list[float]:
    return [model.score(x.decode("utf-8", "replace")) for x in common.text_bytes(batch)]


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """docs' columns (or `keep`), score and predicted."""

    def compute():
        def f(batch: pa.RecordBatch) -> list[pa.Array]:
            s = _scores(model, batch)
            return [pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())]

        return f

    return common.with_results(docs, SCORE, compute, keep)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with the input's columns. The model is fitted to all labels that docs have."""
    model = fit(training_rows(docs, labels))

    def compute():
        return lambda batch: [pa.array([x < threshold for x in _scores(model, batch)], pa.bool_())]

    return common.with_results(docs, T.StructType([]), compute, row_filter=True)


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.need(common.documents(spark, sf_dir), ["doc_id", "text"])
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = fit(training_rows(docs, labels.where(~held_out())))
    return score(docs, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")
