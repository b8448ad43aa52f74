"""Scalar operators of feature graphs, checked casts and stable hashes, all as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_TYPES = ("tinyint", "smallint", "int", "bigint")
FLOAT_TYPES = ("float", "double")


def number(x: Column) -> Column:
    """``x`` as double, NaN as null, so that comparisons are false on it."""
    d = x.cast("double")
    return F.when(~F.isnan(d), d)


def safe_cast(x: Column, to: str) -> Column:
    """``x`` as type ``to``; null where the value overflows or loses a fraction (``cast_failed`` tells which)."""
    if to in INT_TYPES:
        d = x.cast("double")
        return F.when(F.isnan(d) | (d != F.floor(d)), None).otherwise(x.try_cast(to))
    return x.try_cast(to)


def cast_failed(x: Column, to: str) -> Column:
    """Whether ``safe_cast`` loses a value that is not null."""
    return x.isNotNull() & safe_cast(x, to).isNull()


def presence(x: Column) -> Column:
    """1 where x > 0, 0 elsewhere, null for null; NaN is not positive."""
    return F.when(x.isNotNull(), F.coalesce(number(x) > 0, F.lit(False)).cast("int"))


def fill_null(x: Column, value: float | int) -> Column:
    """``x``, with ``value`` for null."""
    return F.coalesce(x, F.lit(value))


def clip(x: Column, low: float, high: float) -> Column:
    """``x`` inside [low, high]; null stays null, NaN stays NaN."""
    if low > high:
        raise ValueError("clip: min exceeds max")
    n = number(x)
    return F.when(n < low, F.lit(low)).when(n > high, F.lit(high)).otherwise(x)


def log1p_nonnegative(x: Column) -> Column:
    """log(1 + x), null for negative values (``log1p_failed`` tells which)."""
    return F.when(number(x) >= 0, F.log1p(x.cast("double"))).when(F.isnan(x.cast("double")), F.lit(float("nan")))


def log1p_failed(x: Column) -> Column:
    """Whether ``x`` is negative."""
    return F.coalesce(number(x) < 0, F.lit(False))


def is_binary(x: Column) -> Column:
    """Whether ``x`` is 0 or 1, false for null."""
    return F.coalesce(number(x).isin(0.0, 1.0), F.lit(False))


def hash_bucket(key: Column, seed: str, buckets: int = 10_000) -> Column:
    """First 8 bytes, big-endian, of SHA-256 of ``seed:key``, modulo ``buckets``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    return (F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)") % buckets).cast("int")


_MASK = 0xFFFFFFFF


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _mul32(a: Column, b: int) -> Column:
    """Low 32 bits of a product, in halves so that nothing overflows a long."""
    low = a.bitwiseAND(0xFFFF) * b
    high = (F.shiftright(a, 16) * b).bitwiseAND(0xFFFF)
    return (low + F.shiftleft(high, 16)).bitwiseAND(_MASK)


def _rotl32(x: Column, r: int) -> Column:
    return F.shiftleft(x, r).bitwiseAND(_MASK).bitwiseOR(F.shiftright(x, 32 - r))


def murmur3_32(text: Column, seed: int = 0) -> Column:
    """MurmurHash3 (x86, 32 bits) of the UTF-8 bytes, as an unsigned number in a long; null for null."""
    hexed = F.hex(F.encode(text, "UTF-8"))
    byte = lambda s, i: F.conv(F.substring(s, (i * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("long")

    def scramble(k: Column) -> Column:
        return _let(_mul32(k, 0xCC9E2D51), lambda a: _mul32(_rotl32(a, 15), 0x1B873593))

    def word(s: Column, at: Column) -> Column:
        return byte(s, at) + byte(s, at + 1) * 256 + byte(s, at + 2) * 65536 + byte(s, at + 3) * 16777216

    def step(s: Column):
        return lambda h, i: _let(h.bitwiseXOR(scramble(word(s, i * 4))), lambda x: (_mul32(_rotl32(x, 13), 5) + 0xE6546B64).bitwiseAND(_MASK))

    def finish(h: Column) -> Column:
        a = _let(h, lambda x: _mul32(x.bitwiseXOR(F.shiftright(x, 16)), 0x85EBCA6B))
        b = _let(a, lambda x: _mul32(x.bitwiseXOR(F.shiftright(x, 13)), 0xC2B2AE35))
        return _let(b, lambda x: x.bitwiseXOR(F.shiftright(x, 16)))

    def whole(s: Column) -> Column:
        size = (F.length(s) / 2).cast("long")
        full = (size / 4).cast("long")
        body = F.when(full > 0, F.aggregate(F.sequence(F.lit(0).cast("long"), full - 1), F.lit(seed).cast("long"), step(s))).otherwise(F.lit(seed).cast("long"))
        left, at = size % 4, full * 4
        zero = F.lit(0).cast("long")
        tail = F.when(left > 0, byte(s, at)).otherwise(zero) + F.when(left > 1, byte(s, at + 1) * 256).otherwise(zero) + F.when(left > 2, byte(s, at + 2) * 65536).otherwise(zero)
        return _let(body, lambda h: finish(h.bitwiseXOR(F.when(left > 0, scramble(tail)).otherwise(zero)).bitwiseXOR(size)))

    return F.when(text.isNotNull(), _let(hexed, whole))


def stable_hash_bucket(text: Column, seed: int = 1847, buckets: int = 65_536, null_bucket: int = 0) -> Column:
    """murmur3_32 modulo ``buckets``; null goes to ``null_bucket``."""
    return F.coalesce(murmur3_32(text, seed) % buckets, F.lit(null_bucket).cast("long"))
