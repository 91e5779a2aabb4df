"""Genomic coordinates: bases, names of regions, positions within a transcript."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rebased(start: Column, stop: Column, zero_based: bool, closed: bool, to_zero: bool, to_closed: bool) -> tuple[Column, Column]:
    """start and stop counted from another base, or with an open or closed end."""
    shift = int(to_zero) - int(zero_based)
    end = stop - shift if shift else stop
    start = start - shift if shift else start
    if closed and not to_closed:
        end = end + 1
    elif to_closed and not closed:
        end = end - 1
    return start, end


def size(start: Column, stop: Column, closed: bool = True) -> Column:
    return stop - start + (1 if closed else 0)


def strand_name(strand: Column) -> Column:
    return F.when(strand == 1, "+").when(strand == -1, "-").otherwise(".")


def region_name(upi: Column, chromosome: Column, exons: Column, strand: Column) -> Column:
    """upi@chromosome/start-stop,...:strand with exons (array of structs start, stop) in order."""
    spans = F.array_join(F.transform(F.sort_array(exons), lambda e: F.concat_ws("-", e["start"].cast("string"), e["stop"].cast("string"))), ",")
    return F.concat(upi, F.lit("@"), chromosome, F.lit("/"), spans, F.lit(":"), strand_name(strand))


def relative_position(exons: Column, strand: Column, position: Column) -> Column:
    """The position's place, from 1, in the transcript that the exons make; null if it lies in none."""
    hit = F.exists(exons, lambda e: (e["start"] <= position) & (position <= e["stop"]))
    before = F.aggregate(exons, F.lit(0).cast("long"), lambda a, e: a + F.when(e["stop"] < position, e["stop"] - e["start"] + 1).when(e["start"] <= position, position - e["start"]).otherwise(0))
    length = F.aggregate(exons, F.lit(0).cast("long"), lambda a, e: a + e["stop"] - e["start"] + 1)
    return F.when(hit, F.when(strand == -1, length - before).otherwise(before + 1))


def floor_div(a: Column, b) -> Column:
    """Division that rounds towards minus infinity, unlike div."""
    return F.floor(a / b).cast("long")
