"""Hash expressions. Everything is md5 so that other engines can reproduce the numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cells import _col


def hex_number(text, start: int, length: int) -> Column:
    """``length`` hex digits of ``text`` from ``start`` (1-based) as a bigint."""
    return F.conv(F.substring(_col(text), start, length), 16, 10).cast("bigint")


def bit_position(signature, n_bits: int, j: int = 0) -> Column:
    """The ``j``-th bit a signature sets: 8 hex digits of its md5, modulo ``n_bits``."""
    if not 0 <= j <= 3:
        raise ValueError("an md5 holds four 8-digit groups, so j is 0..3")
    digest = F.md5(_col(signature).cast("string").cast("binary"))
    return F.pmod(hex_number(digest, 1 + 8 * j, 8), F.lit(n_bits)).cast("int")
