"""Deterministic per-row randomness that two SQL engines agree on.

``md5('<seed>:<part>:<part>...')``; the integer form is the first 8 hex digits
read as an unsigned 32-bit number.  DuckDB equivalent:
``('0x' || substr(md5('<seed>:' || key), 1, 8))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key(seed: int | str, *parts) -> Column:
    pieces: list[Column] = [F.lit(f"{seed}")]
    for p in parts:
        pieces.append(F.lit(":"))
        pieces.append(p.cast("string") if isinstance(p, Column) else F.lit(str(p)))
    return F.concat(*pieces)


def hash_hex(seed: int | str, *parts) -> Column:
    """32 hex digits of md5 over ``seed:part1:part2...``."""
    return F.md5(_key(seed, *parts))


def portable_hash(seed: int | str, *parts) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits (bigint)."""
    return F.conv(F.substring(hash_hex(seed, *parts), 1, 8), 16, 10).cast("bigint")


def hash_unit(seed: int | str, *parts) -> Column:
    """Uniform number in [0, 1): ``portable_hash / 2^32``."""
    return portable_hash(seed, *parts) / F.lit(4294967296.0)
