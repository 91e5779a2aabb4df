"""Quality rules with verdicts on hosts.

Document rules are counted on every whole text. A host is the web host or, for
tables of documents, their source. For each rule and host the share of documents that
fail it is shrunk towards the corpus by a beta prior whose two
parameters are fitted to all hosts (method of moments). Failures of the base
rules reject a document anywhere; a host whose shrunk rate of them reaches
HOST_LIMIT is rejected as a whole. Failures of the other rules (many symbols, many repeated
lines) are a reason only where they are usual: a host whose shrunk rate of such a rule
lies more than HOST_MARGIN standard deviations of the prior above its mean is held to it, and its
documents that fail the rule are rejected; others of that host stay.

Defined results: a null or empty text has no words and fails; a null host is a
host of its own; repeated rows count each time; an empty table gives an empty
table; input columns named like a result give way to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

MIN_WORDS = 50
#: Per cent of the words that may stand in repeated 3-word windows.
MAX_REPEAT = 50
#: A host whose shrunk failure rate is as high is rejected.
HOST_LIMIT = 0.9
#: A host is held to a rule from so many standard deviations of the prior above its mean.
HOST_MARGIN = 0.5
#: Strength of the prior where the hosts' rates do not vary more than chance.
FLAT_PRIOR = 1000.0

COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
BLANKS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"


def repeat_words(words: list[bytes], size: int = 3) -> int:
    """How many words stand in a window of `size` words that occurs twice or more."""
    n = len(words)
    if n <= size:
        return 0
    number = dict(zip(words, range(n)))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    window = ids[: n - size + 1].copy()
    for k in range(1, size):
        if k >= 2:  # keep the codes below n
            window = np.unique(window, return_inverse=True)[1].astype(np.int64)
        window = window * n + ids[k : n - size + 1 + k]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(size):
        covered[k : k + len(window)] |= twice
    return int(covered.sum())


def count_rules(raw: bytes) -> tuple[int, int, int, int, int]:
    text, words = raw.decode("utf-8", "replace"), raw.split()
    dup = 0
    if "\n" in text:
        lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
        dup = len(lines) - len(set(lines))
    return len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup, repeat_words(words)


def rule_counts(docs: DataFrame, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The input's columns (or `keep`) and COUNTS of the whole text, named with the prefix, without a shuffle."""
    schema = T.StructType([T.StructField(prefix + f.name, f.dataType) for f in COUNTS])

    def compute():
        def f(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = [count_rules(x) for x in common.text_bytes(batch)]
            return [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)]

        return f

    return common.with_results(docs, schema, compute, keep)


def base_failed(prefix: str = "") -> Column:
    n = F.col(f"{prefix}n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{prefix}n_repeat_words") > MAX_REPEAT * n)


def host_rules(prefix: str = "") -> dict[str, Column]:
    """Rules that count only for the documents of a host which is held to them: a symbol for 10 words, a repeated line for 20."""
    n = F.col(f"{prefix}n_words")
    return {"symbols": 10 * F.col(f"{prefix}n_symbols") > n, "lines": 20 * F.col(f"{prefix}n_dup_lines") > n}


def beta_prior(hosts: int, first: int | None, second: object) -> tuple[float, float]:
    """Mean and strength of the prior from the sums of the hosts' rates and of their squares (rates in 1e-9).

    Mean m and variance v give the strength m (1 - m) / v - 1 (FLAT_PRIOR where v is 0 or it is above that).
    """
    mean = (first or 0) / max(1, hosts) / 1e9
    var = float(second or 0) / max(1, hosts) / 1e18 - mean * mean
    return mean, max(0.0, min(FLAT_PRIOR, mean * (1 - mean) / var - 1)) if var > 1e-12 else FLAT_PRIOR


def host_verdicts(counted: DataFrame, host: str, limit: float = HOST_LIMIT, margin: float = HOST_MARGIN, prefix: str = "") -> DataFrame:
    """One row a host: host, n_docs, n_failed, host_rate (shrunk), host_bad, and held_<rule> for each of host_rules.

    The shrunk rate is (failed + strength * mean) / (n_docs + strength).
    """
    rules = {"base": base_failed(prefix), **host_rules(prefix)}
    failed = [F.sum(F.coalesce(rule, F.lit(False)).cast("long")).alias(f"failed_{r}") for r, rule in rules.items()]
    rates = common.staged(counted.groupBy(F.col(f"`{host}`").alias("host")).agg(F.count("*").alias("n_docs"), *failed), "host-rates")
    # sums of integers, so that any order of adding gives the same
    rate = {r: F.floor(F.col(f"failed_{r}") / F.col("n_docs") * 10**9).cast("long") for r in rules}
    sums = [x for r, e in rate.items() for x in (F.sum(e).alias(f"s1_{r}"), F.sum((e * e).cast("decimal(38,0)")).alias(f"s2_{r}"))]
    m = rates.agg(F.count("*").alias("h"), *sums).first()
    prior = {r: beta_prior(m["h"], m[f"s1_{r}"], m[f"s2_{r}"]) for r in rules}
    shrunk = {r: (F.col(f"failed_{r}") + F.lit(strength * mean)) / (F.col("n_docs") + F.lit(strength)) for r, (mean, strength) in prior.items()}
    above = {r: mean + margin * float(np.sqrt(mean * (1 - mean) / (strength + 1))) for r, (mean, strength) in prior.items()}
    held = [(shrunk[r] > above[r]).alias(f"held_{r}") for r in rules if r != "base"]
    return rates.select("host", "n_docs", F.col("failed_base").alias("n_failed"), shrunk["base"].alias("host_rate"), (shrunk["base"] >= limit).alias("host_bad"), *held)


def with_verdicts(counted: DataFrame, verdicts: DataFrame, host: str, prefix: str = "") -> DataFrame:
    """counted with _rate (its host's) and _kept. The table of hosts is joined without a hint: Spark broadcasts it
    only under its size limit and otherwise splits hot hosts."""
    mine = verdicts.select(*[F.col(c).alias(f"_v_{c}") for c in verdicts.columns])
    joined = counted.join(mine, F.col(f"`{host}`").eqNullSafe(F.col("_v_host")), "left")
    out = base_failed(prefix) | F.coalesce(F.col("_v_host_bad"), F.lit(False))
    for r, rule in host_rules(prefix).items():
        out = out | (F.coalesce(F.col(f"_v_held_{r}"), F.lit(False)) & rule)
    return joined.withColumn("_rate", F.col("_v_host_rate")).withColumn("_kept", ~out)


def quality_rules(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT, keep: list[str] | None = None) -> DataFrame:
    """keep's columns (default: all but the text), COUNTS, base_failed, host_rate and kept.

    The counts are written once to the shared folder and used both for the
    hosts' rates and for the verdicts, so each text is read once.
    """
    keep = [c for c in docs.columns if c != "text"] if keep is None else keep
    counted = common.staged(rule_counts(docs, keep), "rule-counts")
    joined = with_verdicts(counted, host_verdicts(counted, host, limit), host)
    return joined.select(
        *[F.col(f"`{c}`") for c in counted.columns if c not in ("base_failed", "host_rate", "kept")],
        base_failed().alias("base_failed"),
        F.col("_rate").alias("host_rate"),
        F.col("_kept").alias("kept"),
    )


def drop_failing(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The documents that quality_rules keeps, with the input's columns.

    The rules are counted twice (for the hosts, then for the verdicts) instead
    of writing all texts once more.
    """
    verdicts = host_verdicts(rule_counts(docs, [host], "_q_"), host, limit, prefix="_q_")
    judged = with_verdicts(rule_counts(docs, None, "_q_"), verdicts, host, "_q_")
    return judged.where("_kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.need(common.documents(spark, sf_dir), ["doc_id", "source", "text"])
    out = quality_rules(docs, "source", keep=["doc_id", "source"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
l AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
w AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (
  SELECT doc_id, i, [w, lead(w) OVER p, lead(w, 2) OVER p] AS tri, lead(w, 2) OVER p AS last
  FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
t AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS c FROM g WHERE last IS NOT NULL),
r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM t, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
f AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m),
x AS (SELECT *, 10 * n_symbols > n_words AS many_symbols, 20 * n_dup_lines > n_words AS many_lines FROM f),
h AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS bad, sum(many_symbols::INT) AS symbols, sum(many_lines::INT) AS lines
  FROM x GROUP BY source),
k AS (UNPIVOT h ON bad, symbols, lines INTO NAME rule VALUE failed),
p AS (
  SELECT rule, avg(floor(failed / n * 1e9)) / 1e9 AS mean,
         avg(floor(failed / n * 1e9) ^ 2) / 1e18 - (avg(floor(failed / n * 1e9)) / 1e9) ^ 2 AS var FROM k GROUP BY rule),
s AS (SELECT rule, mean, CASE WHEN var > 1e-12 THEN greatest(0, least(1000, mean * (1 - mean) / var - 1)) ELSE 1000 END AS strength FROM p),
v AS (
  SELECT source, coalesce(bool_or(rule = 'bad' AND (failed + strength * mean) / (n + strength) >= 0.9), false) AS host_bad,
         bool_or(rule = 'symbols' AND (failed + strength * mean) / (n + strength) > mean + 0.5 * sqrt(mean * (1 - mean) / (strength + 1))) AS held_symbols,
         bool_or(rule = 'lines' AND (failed + strength * mean) / (n + strength) > mean + 0.5 * sqrt(mean * (1 - mean) / (strength + 1))) AS held_lines
  FROM k JOIN s USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_bad AND NOT (held_symbols AND many_symbols) AND NOT (held_lines AND many_lines) AS kept
FROM x JOIN v ON x.source IS NOT DISTINCT FROM v.source
"""
