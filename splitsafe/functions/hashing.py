"""Deterministic per-row randomness built from md5.

``F.rand``/``F.randn`` depend on partitioning, so a split or an injected noise
column computed with them changes when the plan changes.  Everything random in
this package is instead a pure function of ``(seed, key...)``:

    h(seed, k1, k2, ...) = int(first 8 hex digits of md5("seed:k1:k2:..."), 16)

which lies in ``[0, 2**32)``.  DuckDB computes the same integer with
``('0x' || substr(md5(concat_ws(':', seed, k1, ...)), 1, 8))::BIGINT``, so every
split and sample is checkable in SQL.  Keys must be integral or string columns
(a double's text form differs between engines).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key_text(seed, keys) -> Column:
    parts = [F.lit(str(seed))]
    for k in keys:
        c = F.col(k) if isinstance(k, str) else k
        parts.append(c.cast("string"))
    return F.concat_ws(":", *parts)


def hash_int(seed, *keys) -> Column:
    """32-bit unsigned hash of ``seed:key1:key2...`` as BIGINT."""
    digest = F.md5(_key_text(seed, keys))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_uniform(seed, *keys) -> Column:
    """Uniform in (0, 1): ``(h + 0.5) / 2**32``."""
    return (hash_int(seed, *keys) + F.lit(0.5)) / F.lit(TWO_32)


def gaussian(seed, mean: float, std: float, *keys) -> Column:
    """N(mean, std) by Box-Muller on two independent md5 uniforms."""
    u1 = hash_uniform(seed, *keys, F.lit("u1"))
    u2 = hash_uniform(seed, *keys, F.lit("u2"))
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
    return F.lit(float(mean)) + F.lit(float(std)) * z


# SQL twins (DuckDB dialect) used by the oracle queries.
def sql_hash_int(seed, *keys: str) -> str:
    inner = ", ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"('0x' || substr(md5(concat_ws(':', {inner})), 1, 8))::BIGINT"


def sql_hash_uniform(seed, *keys: str) -> str:
    return f"(({sql_hash_int(seed, *keys)}) + 0.5) / 4294967296.0"


def sql_gaussian(seed, mean: float, std: float, *keys: str) -> str:
    u1 = sql_hash_uniform(seed, *keys, "'u1'")
    u2 = sql_hash_uniform(seed, *keys, "'u2'")
    return (f"({float(mean)!r} + {float(std)!r} * sqrt(-2.0 * ln({u1})) "
            f"* cos({2.0 * math.pi!r} * {u2}))")
