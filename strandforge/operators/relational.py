"""Relational operators that Spark lacks, as compositions of DataFrame operations."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _names(keys: str | Iterable[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def distinct_on(df: DataFrame, keys: str | Iterable[str], *order: Column | str) -> DataFrame:
    """One row a key, the first in `order`; the order must be total for a repeatable result.

    The aggregate form (min_by of a struct) combines before the shuffle, so a
    key with very many rows sends one row from each task.
    """
    keys = _names(keys)
    if all(isinstance(o, str) for o in order) and order:
        rest = [c for c in df.columns if c not in keys]
        picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        return picked.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert(target: DataFrame, source: DataFrame, keys: str | Iterable[str], update: bool = True, changed: Iterable[str] | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (keys): rows of target and source, one a key; source must have each key once.

    With update, source rows replace target rows (columns that source lacks keep
    the target's values); without, target rows stay. With `changed`, a target row is
    replaced only if one of those columns differs (nulls compare as values).
    """
    keys = _names(keys)
    if not update:
        return target.unionByName(source.join(target.select(*keys), keys, "left_anti"), allowMissingColumns=True)
    flagged = source.withColumn("_hit", F.lit(True)).select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], "_hit")
    on = reduce(lambda a, b: a & b, [target[k].eqNullSafe(F.col(f"_s_{k}")) for k in keys])
    joined = target.withColumn("_have", F.lit(True)).join(flagged, on, "full")
    take = F.col("_hit").isNotNull()
    if changed is not None:
        differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in changed])
        take = take & (F.col("_have").isNull() | differs)
    return joined.select(*[F.when(take, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in source.columns else F.col(c) for c in target.columns])


def update_from(target: DataFrame, source: DataFrame, keys: str | Iterable[str], **values: Column) -> DataFrame:
    """UPDATE target SET ... FROM source: values are columns over both (source's named s_<column>). A key that source has twice raises."""
    keys = _names(keys)
    values_of = [c for c in source.columns if c not in keys]
    matched = source.groupBy(*keys).agg(F.count("*").alias("_n"), F.first(F.struct(F.lit(1).alias("_one"), *values_of)).alias("_s"))
    once = F.when(F.col("_n") == 1, F.col("_s")).otherwise(F.raise_error(F.lit("several source rows match")).cast(matched.schema["_s"].dataType))
    renamed = matched.select(*keys, once.alias("_s")).select(*keys, F.lit(True).alias("_hit"), *[F.col(f"_s.{c}").alias(f"s_{c}") for c in values_of])
    joined = target.join(renamed, keys, "left")
    return joined.select(*[F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns])


def delete_using(target: DataFrame, source: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """DELETE FROM target USING source."""
    return target.join(source.select(*_names(keys)), _names(keys), "left_anti")


def keep_existing(target: DataFrame, source: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """DELETE FROM target WHERE NOT EXISTS (... source ...)."""
    return target.join(source.select(*_names(keys)), _names(keys), "left_semi")


def replace_where(target: DataFrame, source: DataFrame, condition: Column) -> DataFrame:
    """Delete what meets the condition, then insert source's distinct rows."""
    return target.where(~F.coalesce(condition, F.lit(False))).unionByName(source.distinct())


def count_into(target: DataFrame, children: DataFrame, key: str, column: str) -> DataFrame:
    """UPDATE target SET column = (SELECT count(*) FROM children ...); 0 without children."""
    counts = children.groupBy(key).agg(F.count("*").alias("_n"))
    kept = [c for c in target.columns if c != column]
    return target.join(counts, key, "left").select(*kept, F.coalesce("_n", F.lit(0)).alias(column))


def array_agg(value: Column | str, *order: Column | str) -> Column:
    """Like array_agg: nulls stay, and the order is the given one (else the values')."""
    value = F.col(value) if isinstance(value, str) else value
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    packed = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], value.alias("x"))
    return F.transform(F.sort_array(F.collect_list(packed)), lambda s: s["x"])


def array_agg_distinct(*values: str) -> Column:
    """array_agg(DISTINCT row), sorted."""
    return F.sort_array(F.collect_set(F.struct(*values) if len(values) > 1 else F.col(values[0])))


def concat_skip(*parts: Column) -> Column:
    """concat() that skips nulls, unlike ||."""
    return F.concat_ws("", *parts)


CRITERIA = ("any", "at_least_one", "exactly_one", "zero_or_one")


def group_children(base: DataFrame, children: DataFrame, key: str, name: str, criterion: str = "any") -> DataFrame:
    """base with a column `name` of its children's rows, sorted.

    any and at_least_one give arrays; exactly_one and zero_or_one a struct
    (zero_or_one: null without a child). A base row that breaks the criterion raises.
    """
    if criterion not in CRITERIA:
        raise ValueError(criterion)
    values = [c for c in children.columns if c != key]
    grouped = children.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*values))).alias("_rows"))
    rows = F.coalesce(F.col("_rows"), F.lit(None).cast(grouped.schema["_rows"].dataType), F.array().cast(grouped.schema["_rows"].dataType))
    size = F.size(rows)
    ok = {"any": F.lit(True), "at_least_one": size >= 1, "exactly_one": size == 1, "zero_or_one": size <= 1}[criterion]
    value = rows if criterion in ("any", "at_least_one") else F.get(rows, 0)
    checked = F.when(ok, value).otherwise(F.raise_error(F.concat(F.lit(f"{name}: {criterion} broken for "), F.col(key).cast("string"))).cast(grouped.schema["_rows"].dataType if criterion in ("any", "at_least_one") else grouped.schema["_rows"].dataType.elementType))
    return base.join(grouped, key, "left").select(*base.columns, checked.alias(name))


def merge_children(base: DataFrame, key: str, children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """base with one column for each child table: name -> (table, criterion). Tables are grouped, then joined on the key."""
    for name, (table, criterion) in children.items():
        base = group_children(base, table, key, name, criterion)
    return base


def require_zero(df: DataFrame, what: str) -> None:
    """Raise if df has rows."""
    if not df.isEmpty():
        raise AssertionError(f"{what}: {df.count()} rows")


def pick_by_preference(df: DataFrame, keys: str | Iterable[str], column: str, preference: list, ties: bool = True) -> DataFrame:
    """The rows of each key whose column comes first in `preference`; values that aren't listed come last."""
    place = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col(column))
    rank = F.when(F.coalesce(place, F.lit(0)) == 0, len(preference) + 1).otherwise(place)
    w = Window.partitionBy(*_names(keys)).orderBy(rank)
    n = F.rank() if ties else F.row_number()
    return df.withColumn("_n", n.over(w)).where("_n = 1").drop("_n")


def argmax_ties(df: DataFrame, keys: str | Iterable[str], score: Column | str) -> DataFrame:
    """All rows of each key with its largest score: the maximum is aggregated, then joined back."""
    keys = _names(keys)
    score = F.col(score) if isinstance(score, str) else score
    scored = df.withColumn("_score", score)
    best = scored.groupBy(*keys).agg(F.max("_score").alias("_best"))
    return scored.join(best, keys).where(F.col("_score") == F.col("_best")).select(*df.columns)


def consecutive_runs(df: DataFrame, keys: str | Iterable[str], number: str) -> DataFrame:
    """keys, run_start, run_end, run_length of runs of consecutive distinct integers."""
    keys = _names(keys)
    w = Window.partitionBy(*keys).orderBy(number)
    islands = df.select(*keys, number).distinct().withColumn("_island", F.col(number) - F.row_number().over(w))
    return islands.groupBy(*keys, "_island").agg(F.min(number).alias("run_start"), F.max(number).alias("run_end"), F.count("*").alias("run_length")).drop("_island")


#: Sampled rows for each range of ranged().
RANGE_SAMPLE = 20


def ranged(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """df with _tie (a hash of the whole row, so that rows alike in `order` may be parted) and _range, a number that grows with (order, _tie).

    The borders are quantiles of a bounded sample and stand in the plan as literals, so
    _range depends on the row alone: unlike a partition's number it is the same in
    every branch of a plan, however exchanges are coalesced.
    """
    order = list(order)
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])
    keyed = df.withColumn("_tie", tie)
    key = F.struct(*[F.col(f"`{c}`") for c in order], "_tie")
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    picked = keyed.select(key.alias("k"), F.xxhash64(F.lit("range"), "_tie").alias("u")).orderBy("u").limit(parts * RANGE_SAMPLE)
    borders = picked.agg(F.sort_array(F.collect_set("k")).alias("k")).first()["k"]
    borders = borders[:: -(-len(borders) // parts)][1:] if borders else []
    if not borders:
        return keyed.withColumn("_range", F.lit(0))
    spark, kind = df.sparkSession, T.ArrayType(keyed.select(key.alias("k")).schema["k"].dataType)
    one = spark.createDataFrame([(borders,)], T.StructType([T.StructField("_borders", kind)]))
    number = F.size(F.filter("_borders", lambda b: b <= key))
    return keyed.crossJoin(F.broadcast(one)).withColumn("_range", number).drop("_borders")


def _running(df: DataFrame, order: Iterable[str], value: Column) -> DataFrame:
    """df with _upto, the sum of `value` over the rows before in (order, hash of the row), in two levels: no task sees all rows."""
    order = list(order)
    spread = ranged(df, order)
    sums = spread.groupBy("_range").agg(F.sum(value).alias("_sum"))  # as many rows as ranges
    before = sums.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_before"))
    inside = F.sum(value).over(Window.partitionBy("_range").orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - value
    return spread.withColumn("_inside", inside).join(F.broadcast(before), "_range").withColumn("_upto", F.col("_before") + F.col("_inside")).drop("_range", "_tie", "_inside", "_before")


def size_chunks(df: DataFrame, order: str, size: str, limit: int) -> DataFrame:
    """chunk: how often the running size (in `order`, exclusive) has passed the limit."""
    return _running(df, [order], F.col(size)).withColumn("chunk", F.floor(F.col("_upto") / limit)).drop("_upto")


def dense_ids(df: DataFrame, order: str | Iterable[str], column: str, start: int = 1) -> DataFrame:
    """Gapless ids in `order`; rows alike in it follow a hash of the whole row."""
    return _running(df, _names(order), F.lit(1).cast("long")).withColumn(column, F.col("_upto") + start).drop("_upto")
