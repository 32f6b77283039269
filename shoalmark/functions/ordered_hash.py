"""A hash of rows in their order that can be worked out in parts and put together.

Row i adds its hash times the i-th power of a base, modulo a prime. A part that counts its rows from some
other place differs by one power, which is divided out when parts are joined. Two primes of 31 bits keep
all products within 64 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Primes and bases.
MODULI = ((2147483647, 48271), (2147483629, 69621))
_BITS, _DIGITS = 4, 8
#: Places that powers are known for, in digits of ``_BITS`` bits.
PLACES = 1 << (_BITS * _DIGITS)


def power(base: int, prime: int, exponent: Column) -> Column:
    """``base`` to the power of a column (0 to ``PLACES`` - 1), modulo ``prime``."""
    size, found = 1 << _BITS, None
    for digit in range(_DIGITS):
        table = ", ".join(f"{pow(base, size**digit * i, prime)}L" for i in range(size))
        at = F.shiftright(exponent, _BITS * digit).bitwiseAND(size - 1).cast("int")
        entry = F.get(F.expr(f"array({table})"), at)
        found = entry if found is None else found * entry % prime
    return found


def terms(value: Column, place: Column) -> list[Column]:
    """What a row adds to the hash, one number for each prime."""
    return [
        F.pmod(F.xxhash64(value), F.lit(p)) * power(base, p, place) % p for p, base in MODULI
    ]


def moved(sums: list[Column], start: Column, to: Column) -> list[Column]:
    """Sums of terms whose places begin at ``start``, as if they began at ``to``."""
    return [
        F.pmod(s, F.lit(p)) * power(base, p, to) % p * power(pow(base, -1, p), p, start) % p
        for s, (p, base) in zip(sums, MODULI)
    ]
