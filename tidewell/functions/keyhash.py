"""Deterministic row choice from the primary key.

A row is chosen when its draw falls under the rate. A draw is plain arithmetic
on a whole-numbered key, so it stays inside generated code and costs little
where a filter copies it; it depends on nothing but key and salt, so a
recomputed task picks the same rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.numbers import as_col

# Factors under two primes in turn: the change of modulus breaks up the even
# steps that neighbouring keys would take under one. The key is read once.
PRIME, OTHER_PRIME = 2147483647, 2147483629
FACTORS, SECOND = (48271, 1226874159, 742938285), 16807


def draw(key: Column | str, salt: str) -> Column:
    """A number from 0 to PRIME - 1; of a column's name as one text of SQL, which costs one call to build."""
    first, second, third = FACTORS
    if isinstance(key, str):
        inner = f"(cast(`{key}` as bigint) % {PRIME} * {first} + {zlib.crc32(salt.encode())}) % {PRIME}"
        return F.expr(f"{inner} * {second} % {OTHER_PRIME} * {third} % {PRIME}")
    x = (as_col(key).cast("bigint") % F.lit(PRIME) * F.lit(first) + F.lit(zlib.crc32(salt.encode()))) % F.lit(PRIME)
    return x * F.lit(second) % F.lit(OTHER_PRIME) * F.lit(third) % F.lit(PRIME)


def chosen(key: Column | str, salt: str, rate: float) -> Column:
    return draw(key, salt) < F.lit(int(rate * PRIME))


def drawn(key: Column | str, salt: str, low: float, high: float) -> Column:
    """True for keys whose draw falls in [low, high) of its range.

    Rules that share a salt take neighbouring ranges: one draw serves all, and
    no row is hit twice.
    """
    return in_span(draw(key, salt), low, high)


def in_span(drawn_number: Column, low: float, high: float) -> Column:
    """The same for a draw that a column holds."""
    return (drawn_number < F.lit(int(high * PRIME))) & (drawn_number >= F.lit(int(low * PRIME)))


def number(key: Column | str, salt: str) -> Column:
    """A number of 31 bits that does not depend on whether the row is chosen."""
    return draw(key, salt) * F.lit(SECOND) % F.lit(PRIME)


def bucket(key: Column | str, salt: str, buckets: int) -> Column:
    return number(key, salt) % F.lit(buckets)


# Two primes below 2**31 and one multiplier per column and prime: products of
# two residues stay inside a long.
_PRIMES = (2147483647, 2147483629)
_SPREAD = ((48271, 69621, 630360016, 742938285, 950706376, 1226874159), (16807, 39373, 764261123, 1078318381, 397204094, 62089911))


def number_key(*cols: Column | str) -> Column:
    """62-bit surrogate for a row that only its columns together identify.

    Takes up to six non-negative whole numbers; plain arithmetic, so it costs
    little where a table of lines has to be numbered.
    """
    halves = []
    for prime, spread in zip(_PRIMES, _SPREAD):
        terms = [as_col(c) % F.lit(prime) * F.lit(m) % F.lit(prime) for c, m in zip(cols, spread)]
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        halves.append(total % F.lit(prime))
    return halves[0] * F.lit(1 << 31) + halves[1]


def row_key(*cols: Column | str) -> Column:
    """60-bit surrogate for a short frame keyed by texts."""
    text = F.concat_ws("|", *[as_col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
