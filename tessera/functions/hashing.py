"""Reproducible pseudo-randomness from keys.

``rand()`` changes on every run and on every task retry.  These helpers
derive a value from the row's key and a salt instead, so a recomputed
partition gives the same rows and an SQL engine can reproduce them.  The value
is the first 60 bits of the MD5 of "key:salt": it has no period in the key,
and two salts are independent.  Rows that need many values take several from
one digest (``numbers``, ``split_draw``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 15                     # hexadecimal digits of the digest that are used
HASH_RANGE = 16 ** HASH_DIGITS       # 2^60


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def draw(key, salt: int = 0) -> Column:
    """Integer in [0, 2^60) determined by a key and a salt; null for null."""
    text = F.concat(_c(key).cast("string"), F.lit(f":{salt}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def draw_below(key, salt: int, n) -> Column:
    """Integer in [0, n) (n a literal or Column)."""
    n_col = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(draw(key, salt), n_col.cast("long"))


def numbers(key, n: int, salt: int = 0) -> list[Column]:
    """``n`` independent integers in [0, 2^60) per key; two come from one
    digest (digits 1-15 and 17-31 of the MD5 of "key:salt", "key:salt+1", ...)."""
    text = _c(key).cast("string")
    digests = [F.md5(F.concat(text, F.lit(f":{salt + i}")).cast("binary")) for i in range((n + 1) // 2)]
    halves = [F.substring(d, at, HASH_DIGITS) for d in digests for at in (1, HASH_DIGITS + 2)]
    return [F.conv(h, 16, 10).cast("long") for h in halves[:n]]


def split_draw(number: Column, *sizes) -> list[Column]:
    """Integers in [0, size) for each of ``sizes`` (literals or Columns) from
    one of :func:`numbers`: its digits in the mixed radix of the sizes.  Their
    product should stay far below 2^60: the draws are even and independent up
    to a relative error of product / 2^60."""
    draws = []
    for size in sizes:
        n = (size if isinstance(size, Column) else F.lit(size)).cast("long")
        draws.append(F.pmod(number, n))
        number = F.call_function("div", number, n)
    return draws


def hash_unit(key, salt: int = 0) -> Column:
    """Uniform-looking double in [0, 1) from a key (replaces ``rand()``)."""
    return draw(key, salt) / F.lit(float(HASH_RANGE))


def threshold(fraction: float) -> int:
    """Values of :func:`draw` below this are ``fraction`` of all."""
    return int(fraction * HASH_RANGE)
