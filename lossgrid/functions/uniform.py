"""Uniform draws keyed by (seed, entity, run).

``rand(seed)`` depends on how rows fall into partitions, so a lost executor or another cluster size would
change a simulation. Here each draw is a pure function of its keys: integer fifth powers modulo a Mersenne
prime, a permutation of the residues, mixed over three rounds. It stays in 64-bit integer code, needs no
string building, and any SQL engine reproduces it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIME = 2147483647
ROUND_KEYS = (1013904223, 1664525, 69069, 362437, 521288629)


def _fifth_power(df: DataFrame, name: str, x: Column) -> DataFrame:
    """Add ``name`` = x^5 mod PRIME; every product stays below 2^62."""
    base, square = F.col(f"{name}_b"), F.col(f"{name}_s")
    return (
        df.withColumn(f"{name}_b", F.pmod(x, F.lit(PRIME)))
        .withColumn(f"{name}_s", (base * base) % F.lit(PRIME))
        .withColumn(name, ((square * square) % F.lit(PRIME) * base) % F.lit(PRIME))
        .drop(f"{name}_b", f"{name}_s")
    )


def with_entity_state(df: DataFrame, out: str, entity: str, seed: int) -> DataFrame:
    """First round, once per entity: absorbs the seed and the low part of a 64-bit key."""
    low = F.pmod(F.col(entity).cast("bigint"), F.lit(PRIME))
    return _fifth_power(df, out, low + F.lit((seed * ROUND_KEYS[1] + ROUND_KEYS[0]) % PRIME))


def with_run_uniform(df: DataFrame, out: str, state: str, entity: str, run: str) -> DataFrame:
    """Rounds two and three, once per (entity, run): absorb the run, then the high part of the key.

    The high part enters after the run, so two keys with equal low parts do not move together.
    """
    high = F.expr(f"pmod(CAST(`{entity}` AS BIGINT) div {PRIME}, {PRIME})")
    df = _fifth_power(df, "_u2", F.col(state) + F.col(run).cast("bigint") * F.lit(ROUND_KEYS[2]) + F.lit(ROUND_KEYS[3]))
    df = _fifth_power(df, "_u3", F.col("_u2") + high + F.lit(ROUND_KEYS[4]))
    return df.withColumn(out, (F.col("_u3") + F.lit(0.5)) / F.lit(float(PRIME))).drop("_u2", "_u3")


def with_uniform(df: DataFrame, out: str, entity: str, run: str, seed: int) -> DataFrame:
    """Uniform on (0, 1) for (seed, entity, run)."""
    df = with_entity_state(df, "_u1", entity, seed)
    return with_run_uniform(df, out, "_u1", entity, run).drop("_u1")
