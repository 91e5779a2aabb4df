"""Column functions on strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(name: Column) -> tuple[Column, Column]:
    """(prefix, trailing number): sorts a2 before a10; without a number it is null."""
    return F.regexp_replace(name, "[0-9]+$", ""), F.try_to_number(F.nullif(F.regexp_extract(name, "([0-9]+)$", 1), F.lit("")), F.lit("999999999999999999")).cast("long")


def entropy(text: Column) -> Column:
    """Shannon entropy (bits) of the lower-case letters and digits; 0 without any."""
    alphabet = F.array(*[F.lit(c) for c in "abcdefghijklmnopqrstuvwxyz0123456789"])

    def of(kept: Column) -> Column:
        n = F.length(kept).cast("double")

        def part(c: Column) -> Column:
            k = n - F.length(F.replace(kept, c, F.lit("")))
            return F.when(k > 0, -(k / n) * F.log2(k / n)).otherwise(F.lit(0.0))

        return F.when(n > 0, F.aggregate(F.transform(alphabet, part), F.lit(0.0), lambda a, x: a + x)).otherwise(F.lit(0.0))

    # the text is cleaned once, not for each letter, as a lambda's variable is
    return F.get(F.transform(F.array(F.regexp_replace(F.lower(text), "[^a-z0-9]", "")), of), 0)


def low_codes(text: Column) -> Column:
    """A text that is smaller for one with lower character codes, the longer first if one begins the other, for ties in min_by."""
    return F.when(text == "", text).otherwise(F.concat(text, F.lit("\U0010ffff")))


def strip_leading(text: Column, *names: Column) -> Column:
    """text without a leading species name, or a common name in brackets, in the order given; case doesn't count."""
    out = text
    for n in names:
        hit = F.coalesce(F.startswith(F.lower(out), F.lower(n)) & (F.length(n) > 0), F.lit(False))
        out = F.when(hit, F.trim(F.substring(out, F.length(n) + 1, F.length(out)))).otherwise(out)
        bracketed = F.concat(F.lit("("), n, F.lit(")"))
        hit = F.coalesce(F.startswith(F.lower(out), F.lower(bracketed)), F.lit(False))
        out = F.when(hit, F.trim(F.substring(out, F.length(bracketed) + 1, F.length(out)))).otherwise(out)
    return out


def like_any(text: Column, words: list[str]) -> Column:
    hits = [F.contains(text, F.lit(w)) for w in words]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out


def json_word_or_list(text: Column) -> Column:
    """A note that is a JSON array of words, or one bare word, as an array."""
    return F.when(F.startswith(F.trim(text), F.lit("[")), F.from_json(text, "array<string>")).otherwise(F.array(text))


def split_synonyms(text: Column) -> Column:
    """Names divided by ; or, without one, by commas."""
    return F.filter(F.transform(F.when(F.contains(text, F.lit(";")), F.split(text, ";")).otherwise(F.split(text, ",")), F.trim), lambda s: s != "")
