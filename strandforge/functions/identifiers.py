"""Identifiers and checksums of sequences, regions and genes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = "URS"


def urs(number: Column) -> Column:
    """URS and ten upper-case hexadecimal digits."""
    return F.concat(F.lit(PREFIX), F.lpad(F.hex(number.cast("long")), 10, "0"))


def urs_number(name: Column) -> Column:
    """The number of a URS; null for a malformed one."""
    ok = name.rlike("^URS[0-9A-F]{10}")
    return F.when(ok, F.conv(F.substring(name, 4, 10), 16, 10).cast("long"))


def urs_taxid(name: Column, taxid: Column) -> Column:
    return F.concat_ws("_", name, taxid.cast("string"))


def split_urs_taxid(name: Column) -> tuple[Column, Column]:
    return F.split_part(name, F.lit("_"), F.lit(1)), F.nullif(F.split_part(name, F.lit("_"), F.lit(2)), F.lit("")).cast("long")


def short_urs(name: Column) -> Column:
    """URS with the leading zeros of its digits left out."""
    return F.regexp_replace(name, "^URS0+", PREFIX)


def md5(sequence: Column) -> Column:
    return F.md5(F.upper(sequence))


def sha_number(text: Column, digits: int = 11) -> Column:
    """SHA-256 modulo 10^digits, padded with zeros: sixteen hexadecimal digits at a time, in exact decimals."""
    h, modulus = F.sha2(text, 256), 10**digits
    step = F.lit(pow(16, 8, modulus)).cast("decimal(20,0)")
    out = F.lit(0).cast("decimal(20,0)")
    for at in range(0, 64, 8):
        part = F.conv(F.substring(h, at + 1, 8), 16, 10).cast("decimal(20,0)")
        out = ((out * step + part) % F.lit(modulus).cast("decimal(20,0)")).cast("decimal(20,0)")
    return F.lpad(out.cast("string"), digits, "0")


def gene_name(prefix: Column, key: Column, version: Column | None = None) -> Column:
    return F.concat(F.lit("RNAC"), prefix, F.lit("G"), sha_number(key), F.lit("."), (version if version is not None else F.lit(1)).cast("string"))


def _crc64_table() -> list[int]:
    """Table of the ISO 3309 CRC-64 that sequence databases use (polynomial x^64 + x^4 + x^3 + x + 1, reflected)."""
    table = []
    for byte in range(256):
        value = byte
        for _ in range(8):
            value = (value >> 1) ^ (0xD800000000000000 if value & 1 else 0)
        table.append(value)
    return table


@F.pandas_udf(T.StringType())
def crc64(sequences: pd.Series) -> pd.Series:
    """The CRC-64 of the text in sixteen upper-case hexadecimal digits."""
    table = _crc64_table()

    def one(s: str | None) -> str | None:
        if s is None:
            return None
        value = 0
        for b in s.encode():
            value = table[(value ^ b) & 255] ^ (value >> 8)
        return f"{value:016X}"

    return sequences.map(one)
