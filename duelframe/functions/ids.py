"""Identifiers and digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_identity_hash(*fields: Column) -> Column:
    """First 20 hexadecimal digits over the trimmed fields, one a line."""
    return F.substring(F.sha2(F.concat_ws("\n", *(F.coalesce(F.trim(f.cast("string")), F.lit("")) for f in fields)), 256), 1, 20)


def derived_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *(p.cast("string") for p in parts)), 256), 1, 24)


def row_fingerprint(df: DataFrame, exclude: tuple[str, ...] = ()) -> Column:
    """SHA-256 of the row as JSON with sorted keys; nulls are written."""
    names = sorted(c for c in df.columns if c not in exclude)
    return F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)


def table_digest(df: DataFrame, prefix: str = "rev-") -> DataFrame:
    """One row: a digest of all rows in any order, from their count and sums of parts of their hashes."""
    part = lambda h, at: F.conv(F.substring(h, at, 8), 16, 10).cast("long")
    hashed = df.select(row_fingerprint(df).alias("h"))
    sums = hashed.agg(F.count("*").alias("n"), *(F.coalesce(F.sum(part(F.col("h"), at)), F.lit(0)).alias(f"s{at}") for at in (1, 9, 17)))
    return sums.select(F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", "n", "s1", "s9", "s17"), 256), 1, 16)).alias("digest"), "n")


def hash_draw(*parts: Column) -> Column:
    """A repeatable integer from 0 to 2^32 - 1."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *(p.cast("string") for p in parts))), 1, 8), 16, 10).cast("long")
