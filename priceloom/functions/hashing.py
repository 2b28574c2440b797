"""Row hashes that depend on values only, never on file or partition layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hex digits of the md5 that each independent draw uses, as (start, length).
SPLIT_DIGITS = (1, 8)
FOLD_DIGITS = (9, 8)


def row_key(columns: Sequence[str]) -> Column:
    """md5 of the key columns joined by ``|``. Use integers and strings: their
    text form is the same in every engine."""
    if not columns:
        raise ValueError("a row key needs at least one column")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def hash_bucket(columns: Sequence[str], buckets: int, digits: tuple[int, int] = SPLIT_DIGITS) -> Column:
    """A uniform bucket in [0, buckets) for each row key."""
    start, length = digits
    number = F.conv(F.substring(row_key(columns), start, length), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(buckets)).cast("int")
