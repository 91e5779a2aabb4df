"""Column functions on nucleotide sequences."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_LENGTH, MAX_LENGTH, MAX_N = 10, 1_000_000, 0.1
MESSENGER = "SO:0000234"


def to_dna(sequence: Column) -> Column:
    return F.translate(F.upper(sequence), "U", "T")


def n_fraction(sequence: Column) -> Column:
    n = F.length(sequence) - F.length(F.translate(sequence, "Nn", ""))
    return F.try_divide(n, F.length(sequence))


def entry_problem(sequence: Column, least: int = MIN_LENGTH, most: int = MAX_LENGTH, n_limit: float = MAX_N, so_type: Column | None = None) -> Column:
    """Why an entry is not taken, or null: its length, its share of N, or its type."""
    length = F.length(sequence)
    n = length - F.length(F.translate(sequence, "Nn", ""))
    out = F.when(length < least, "too short").when(length > most, "too long").when(n > n_limit * length, "too many N")
    return out if so_type is None else out.when(so_type == MESSENGER, "messenger RNA")


def require_dna(sequence: Column) -> Column:
    """The sequence; raises if it has a U."""
    return F.when(F.contains(F.upper(sequence), F.lit("U")), F.raise_error(F.lit("a sequence has U"))).otherwise(sequence)


def gc_content(sequence: Column) -> Column:
    gc = F.length(sequence) - F.length(F.translate(F.upper(sequence), "GC", ""))
    return F.try_divide(gc, F.length(sequence))


def longest_open_run(sequence: Column) -> Column:
    """The longest run of codons without a stop (TAA, TAG, TGA) in any of the three forward frames, in codons."""
    dna = to_dna(sequence)

    def frame(k: int) -> Column:
        codons = F.regexp_extract_all(F.substring(dna, F.lit(k + 1), F.length(dna)), F.lit("(...)"), F.lit(1))
        marks = F.array_join(F.transform(codons, lambda c: F.when(c.isin("TAA", "TAG", "TGA"), "*").otherwise("x")), "")
        return F.array_max(F.transform(F.split(marks, r"\*"), F.length))

    return F.greatest(*[frame(k) for k in range(3)])


def open_run_probability(sequence: Column) -> Column:
    """The chance of at least one open run as long in a random sequence of the same length and GC content.

    A stop codon's chance from the base frequencies gives the chance q that a codon is none;
    a run of r codons starts at one of n - r + 1 places of each frame.
    """
    gc = gc_content(sequence)
    at, g = (1 - gc) / 2, gc / 2
    stop = at * at * at + 2 * at * at * g
    runs = longest_open_run(sequence)
    places = F.greatest(F.lit(1), F.floor(F.length(sequence) / 3) - runs + 1) * 3
    return F.least(F.lit(1.0), 1 - F.pow(1 - F.pow(1 - stop, runs), places))


def base_pairs(dot_bracket: Column) -> Column:
    """How many pairs a dot-bracket structure has, pseudoknots included."""
    opened = F.length(dot_bracket) - F.length(F.translate(dot_bracket, "([{<", ""))
    letters = F.length(dot_bracket) - F.length(F.regexp_replace(dot_bracket, "[A-Z]", ""))
    return opened + letters


@F.pandas_udf(T.BooleanType())
def balanced(structures: pd.Series) -> pd.Series:
    """Whether each bracket of a dot-bracket structure has its partner."""
    pairs = {")": "(", "]": "[", "}": "{", ">": "<"} | {chr(97 + i): chr(65 + i) for i in range(26)}

    def one(s: str | None) -> bool | None:
        if s is None:
            return None
        depth: dict[str, int] = {}
        for c in s:
            if c in pairs:
                depth[pairs[c]] = depth.get(pairs[c], 0) - 1
                if depth[pairs[c]] < 0:
                    return False
            elif c in pairs.values():
                depth[c] = depth.get(c, 0) + 1
        return not any(depth.values())

    return structures.map(one)
