"""Key columns: stable hashes, natural hashes, surrogate and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keys are 1 .. 2^63 - 2; 0 is the unknown member.
KEY_RANGE = 2**63 - 2
UNKNOWN_KEY = 0
#: Text of a null and separator of values in a natural hash.
NULL_TEXT = "NA"
SEPARATOR = "||"


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_key(*columns: str | Column) -> Column:
    """A positive 64-bit key from the columns' texts, the same in every run."""
    texts = [_column(c).cast("string") for c in columns]
    return (F.pmod(F.xxhash64(*texts), F.lit(KEY_RANGE)) + F.lit(1)).cast("long")


def natural_hash(*columns: str | Column) -> Column:
    """SHA-256 of the columns' texts, nulls written out."""
    return F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(_column(c).cast("string"), F.lit(NULL_TEXT)) for c in columns]), 256)


def surrogate_key(*columns: str) -> Column:
    """The column itself where it is one number, else a stable key.

    ``try_cast`` because a key column may be a text such as a hash, which a
    plain cast rejects under ANSI rules.
    """
    hashed = stable_key(*columns)
    return F.coalesce(F.col(columns[0]).try_cast("long"), hashed) if len(columns) == 1 else hashed


def date_key(ts: str | Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.date_format(_column(ts), "yyyyMMdd").cast("int")


def time_key(ts: str | Column) -> Column:
    """HHmmss as an integer."""
    return F.date_format(_column(ts), "HHmmss").cast("int")
