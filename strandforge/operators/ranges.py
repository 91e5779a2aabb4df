"""Joins on nearness and on intervals, as equi-joins of bins with a residual condition.

A plain theta join has no key to shuffle by; bins give one. Every pair
is made in exactly one bin (the larger of the two lowest bins), so no duplicates need to be removed.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def near_pairs(df: DataFrame, keys: Iterable[str], position: str, index: str, distance: int) -> DataFrame:
    """Pairs (a: <index> smaller, b) with equal keys and abs(a.position - b.position) <= distance.

    Columns: keys, <index>_a, <index>_b, <position>_a, <position>_b. Each row stands
    in its bucket and, as a left side, in the next too, so that pairs of the same and
    of adjacent buckets meet in one equi-join.
    """
    keys = list(keys)
    bucket = F.floor(F.col(position) / F.lit(distance)).cast("long")
    slim = df.select(*keys, F.col(index).alias("_i"), F.col(position).alias("_p"), bucket.alias("_b"))
    left = slim.select(*keys, F.col("_i").alias("_i1"), F.col("_p").alias("_p1"), F.col("_b").alias("_b1"), F.explode(F.array(F.col("_b"), F.col("_b") + 1)).alias("_b"))
    right = slim.select(*keys, F.col("_i").alias("_i2"), F.col("_p").alias("_p2"), "_b")
    pairs = left.join(right, [*keys, "_b"]).where((F.abs(F.col("_p1") - F.col("_p2")) <= distance) & ((F.col("_b1") != F.col("_b")) | (F.col("_i1") < F.col("_i2"))))
    first = F.col("_i1") < F.col("_i2")
    return pairs.select(
        *keys,
        F.least("_i1", "_i2").alias(f"{index}_a"),
        F.greatest("_i1", "_i2").alias(f"{index}_b"),
        F.when(first, F.col("_p1")).otherwise(F.col("_p2")).alias(f"{position}_a"),
        F.when(first, F.col("_p2")).otherwise(F.col("_p1")).alias(f"{position}_b"),
    )


def _binned(df: DataFrame, start: str, stop: str, width: int, prefix: str) -> DataFrame:
    low, high = F.floor(F.col(start) / width).cast("long"), F.floor(F.col(stop) / width).cast("long")
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns], low.alias(f"_{prefix}low"), F.explode(F.sequence(low, F.greatest(low, high))).alias("_bin"))


def _matched(left: DataFrame, right: DataFrame, keys: Iterable[str], width: int, condition: Column, names: tuple[str, str]) -> DataFrame:
    l, r = _binned(left, *names, width, "l_"), _binned(right, *names, width, "r_")
    on = [F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys] + [l["_bin"] == r["_bin"]]
    joined = l.join(r.withColumnRenamed("_bin", "_rbin"), [*on[:-1], F.col("_bin") == F.col("_rbin")])
    return joined.where(condition & (F.col("_bin") == F.greatest("_l_low", "_r_low"))).drop("_bin", "_rbin", "_l_low", "_r_low")


def overlap_join(left: DataFrame, right: DataFrame, keys: Iterable[str], width: int, start: str = "start", stop: str = "stop") -> DataFrame:
    """Pairs of half-open intervals [start, stop) of the same keys that overlap; columns l_* and r_*."""
    condition = (F.col(f"l_{start}") < F.col(f"r_{stop}")) & (F.col(f"r_{start}") < F.col(f"l_{stop}"))
    return _matched(left, right, keys, width, condition, (start, stop))


def enclosed_join(left: DataFrame, right: DataFrame, keys: Iterable[str], width: int, start: str = "start", stop: str = "stop") -> DataFrame:
    """Pairs in which right's interval encloses left's."""
    condition = (F.col(f"r_{start}") <= F.col(f"l_{start}")) & (F.col(f"r_{stop}") >= F.col(f"l_{stop}"))
    return _matched(left, right, keys, width, condition, (start, stop))


def overlap_filter(left: DataFrame, right: DataFrame, keys: Iterable[str], width: int, id_column: str, keep: bool = True, enclosed: bool = False, start: str = "start", stop: str = "stop") -> DataFrame:
    """Rows of left that overlap (or, with enclosed, lie within) some interval of right; with keep=False those that don't."""
    join = enclosed_join if enclosed else overlap_join
    hits = join(left, right, keys, width, start, stop).select(F.col(f"l_{id_column}").alias(id_column)).distinct()
    return left.join(hits, id_column, "left_semi" if keep else "left_anti")


def within_either(left: DataFrame, right: DataFrame, keys: Iterable[str], distance: int, start: str = "start", stop: str = "stop") -> DataFrame:
    """Pairs of the same keys whose starts, or whose stops, are at most `distance` apart; columns l_* and r_*."""
    keys = list(keys)
    l = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns])
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])

    def by(column: str) -> DataFrame:
        mine = l.withColumn("_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col(f"l_{column}") / distance) + d)))
        theirs = r.withColumn("_b2", F.floor(F.col(f"r_{column}") / distance))
        on = [F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys]
        joined = mine.join(theirs, [*on, F.col("_b") == F.col("_b2")]).drop("_b", "_b2")
        return joined.where(F.abs(F.col(f"l_{column}") - F.col(f"r_{column}")) <= distance)

    near_start = F.abs(F.col(f"l_{start}") - F.col(f"r_{start}")) <= distance
    return by(start).unionByName(by(stop).where(~near_start))


def greedy_matches(old: DataFrame, new: DataFrame, keys: Iterable[str], distance: int = 1000, overlap: float = 0.9) -> DataFrame:
    """(new_id, old_id): each new interval, in order, takes the first old one not yet taken whose ends are nearer
    than `distance` and whose overlap exceeds `overlap` of the union.

    old, new: id, keys, start, stop. Both sides of one group of keys go through memory as slim rows, and no
    pairs are made: old intervals with equal ends wait as one, and new ones with equal ends look for theirs together.
    """
    keys = list(keys)
    ends = ["start", "stop"]
    new, old = (x.select("id", *keys, *ends).dropna(subset=[*keys, *ends]) for x in (new, old))

    def match(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        mine, theirs = (x.sort_values([*ends, "id"], ignore_index=True) for x in (mine, theirs))
        places = theirs.drop_duplicates(ends)
        starts, stops = places["start"].to_numpy(), places["stop"].to_numpy()
        at, until = places.index.to_list(), [*places.index[1:].to_list(), len(theirs)]
        waiting, ids, names = np.ones(len(places), bool), theirs["id"].to_list(), mine["id"].to_list()
        firsts = mine.drop_duplicates(ends)
        taken, out, done = set(), [], set()
        for low, high, start, stop in zip(firsts.index, [*firsts.index[1:], len(mine)], firsts["start"], firsts["stop"]):
            a, b = np.searchsorted(starts, start - distance, "right"), np.searchsorted(starts, start + distance, "left")
            inner = np.minimum(stops[a:b], stop) - np.maximum(starts[a:b], start)
            outer = np.maximum(stops[a:b], stop) - np.minimum(starts[a:b], start)
            found = iter((np.flatnonzero(waiting[a:b] & (np.abs(stops[a:b] - stop) < distance) & (inner > overlap * outer)) + a).tolist())
            place = next(found, None)
            for n in names[low:high]:
                if place is None:
                    break
                if n in done:
                    continue
                while place is not None:
                    while at[place] < until[place] and ids[at[place]] in taken:
                        at[place] += 1
                    if at[place] < until[place]:
                        o = ids[at[place]]
                        taken.add(o)
                        done.add(n)
                        out.append((n, o))
                        break
                    waiting[place] = False
                    place = next(found, None)
        return pd.DataFrame(out, columns=["new_id", "old_id"])

    kinds = dict(new.dtypes)["id"], dict(old.dtypes)["id"]
    return new.groupBy(*keys).cogroup(old.groupBy(*keys)).applyInPandas(match, f"new_id {kinds[0]}, old_id {kinds[1]}")
