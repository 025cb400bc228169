"""Seeded, repeatable orders and draws: an md5 of seed and key, never a generator or the row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_DIGITS = 4
DRAW_DIGITS = 15
UNIT_DIGITS = 13


def digest(seed: object, *keys: Column | str) -> Column:
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def _hex(text: Column, digits: int) -> Column:
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("bigint")


def bucket(text: Column) -> Column:
    """One of 65,536 equal, ordered parts of the digests."""
    return _hex(text, BUCKET_DIGITS).cast("int")


def draw(n: Column, seed: object, *keys: Column | str) -> Column:
    """A whole number in [0, n)."""
    return _hex(digest(seed, *keys), DRAW_DIGITS) % n


def unit(seed: object, *keys: Column | str) -> Column:
    """A number in [0, 1), exact in a double."""
    return _hex(digest(seed, *keys), UNIT_DIGITS) / F.lit(float(16**UNIT_DIGITS))
