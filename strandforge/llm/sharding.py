"""Sharding by sampled splitters (law `bytes`: sizes near equal).

Rows are ordered by (hash of the text, hash of doc_id, hash of the row's place):
copies of a text stand together, and rows of one text, or alike in text and
doc_id, can still be divided. The place is written once with the keys, so every
later pass reads the same. A sample in which a row's chance grows with its size gives quantile
boundaries of that order; each row finds its range by binary search. Ranges that
turn out overfull are subdivided at boundaries from a sample of their own.
Whole ranges then go to shards, the largest first, each to the shard with the
fewest bytes. All of it is DataFrame operations.

What reaches the driver is the sample and one row a range; both are bounded by
the number of ranges, which is RANGES_PER_SHARD a shard or one for RANGE_ROWS rows.

Defined results: a null text has size 8 and the checksum of the empty text; a
null doc_id is a key like any other; repeated rows each get a slot, in any order
among themselves; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SHARDS = 24
RANGES_PER_SHARD = 64
RANGE_ROWS = 1_000_000
#: Sampled keys a range; a range is overfull above so many times the mean.
SAMPLES, OVERFULL = 16, 2.0
ROUNDS = 4
#: What orders rows.
KEY = ["h1", "h2", "h3"]
#: Bytes that a row takes besides its text.
ROW_BYTES = 8


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the three hashes that order rows; h3 depends on the row's place, so the table has to be staged."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit("row"), F.col("doc_id")).alias("h2"),
        F.xxhash64(F.lit("place"), F.monotonically_increasing_id()).alias("h3"),
    )


def _sample(rows: DataFrame, total: int, wanted: int) -> list[tuple[int, int, int, float]]:
    """(h1, h2, h3, bytes it stands for) of about `wanted` rows at most; a row's chance is in proportion to its size."""
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(wanted / total))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit("sample"), *KEY), 11).cast("double") + 0.5) / float(2**53)
    picked = rows.select(*KEY, (F.col("size") / chance).alias("w"), u.alias("u"), chance.alias("p")).where("u < p")
    return sorted((r["h1"], r["h2"], r["h3"], r["w"]) for r in picked.select(*KEY, "w").collect())


def _quantiles(sample: list[tuple[int, int, int, float]], ranges: int) -> list[tuple[int, int, int]]:
    """At most ranges - 1 keys that divide the sample's bytes evenly; a key starts a new range."""
    total, found, sofar = sum(w for *_, w in sample), [], 0.0
    for *key, w in sample:
        if sofar * ranges >= total * (len(found) + 1) and (not found or found[-1] < tuple(key)):
            found.append(tuple(key))
        sofar += w
    return found


def _literal(values: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), kind)


def range_of(splitters: list[tuple[int, ...]]) -> Column:
    """How many splitters are at or below the row's key, by binary search; splitters may be of the key's first columns."""
    if not splitters:
        return F.lit(0)
    names = KEY[: len(splitters[0])]
    keys = _literal([dict(zip(names, s)) for s in splitters], f"array<struct<{','.join(f'{c}:bigint' for c in names)}>>")
    n = len(splitters)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])

    def step(at: Column, width: Column) -> Column:
        to = at + width
        mid = F.get(keys, F.least(to, F.lit(n)) - 1)
        return F.when((to <= n) & (mid <= F.struct(*names)), to).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def shard(docs: DataFrame, shards: int = SHARDS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, range (id of the row's key range), shard, slot."""
    rows = common.staged(sized(docs), "shard-keys")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = max(shards * RANGES_PER_SHARD, -(-count // range_rows))
    splitters = _quantiles(_sample(rows, total, ranges * SAMPLES), ranges) if total else []
    for k in range(ROUNDS + 1):  # the last time, ranges stay as they are
        at = rows.withColumn("range", range_of(splitters))
        found = at.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max(F.struct(*KEY)).alias("top"), F.min(F.struct(*KEY)).alias("low")).collect()
        over = [r for r in found if r["bytes"] > OVERFULL * total / ranges and r["top"] != r["low"]]
        if not over or k == ROUNDS:
            break
        inside = at.join(F.broadcast(at.sparkSession.createDataFrame([(r["range"],) for r in over], "range int")), "range", "left_semi")
        much = sum(r["bytes"] for r in over)
        parts = -(-int(much * ranges * OVERFULL) // total) + len(over)
        more = _quantiles(_sample(inside.select(*KEY, "size"), much, parts * SAMPLES), parts)
        more = sorted({*splitters, *more})
        if len(more) == len(splitters):
            break
        splitters = more
    load = [(0, s) for s in range(shards)]
    owner, slots, first = [0] * (len(splitters) + 1), [0] * shards, [0] * (len(splitters) + 1)
    for r in sorted(found, key=lambda r: (-r["bytes"], r["range"])):
        least, s = heapq.heappop(load)
        owner[r["range"]] = s
        heapq.heappush(load, (least + r["bytes"], s))
    for r in sorted(found, key=lambda r: r["range"]):
        s = owner[r["range"]]
        first[r["range"]], slots[s] = slots[s], slots[s] + r["n"]
    inner = F.row_number().over(Window.partitionBy("range").orderBy(*KEY, "doc_id", "text_crc32", "size"))
    return at.select(
        "doc_id", "size", "text_crc32", "range",
        F.get(_literal(owner, "array<int>"), F.col("range")).alias("shard"),
        (F.get(_literal(first, "array<bigint>"), F.col("range")) + inner - 1).alias("slot"),
    )


def op2_shard_by_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(common.need(common.documents(spark, sf_dir), ["doc_id", "text"]))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
