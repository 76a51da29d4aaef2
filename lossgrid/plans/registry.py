"""A registered query: how to build it, the types and rounding of its result, and its oracle.

One result specification serves both sides, so names, types and rounding cannot drift apart. It is a
string of ``name:kind`` items; kind is ``s`` text, ``i`` bigint, ``b`` boolean, ``d`` date, or a number of
digits a double is rounded to (sums of floats depend on their order). Rounding is spelled out as scaling
and half-even rounding, which both engines do alike; their own round functions treat ties differently.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK_TYPES = {"s": "string", "i": "bigint", "b": "boolean", "d": "date"}
SQL_TYPES = {"s": "VARCHAR", "i": "BIGINT", "b": "BOOLEAN", "d": "DATE"}
Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    spec: str
    sql: str | None = None

    def items(self) -> list[tuple[str, str]]:
        return [tuple(part.rsplit(":", 1)) for part in self.spec.split()]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        def typed(name: str, kind: str) -> Column:
            col = F.col(f"`{name}`")
            if kind in SPARK_TYPES:
                return col.cast(SPARK_TYPES[kind]).alias(name)
            scale = F.lit(10.0 ** int(kind))
            return (F.rint(col.cast("double") * scale) / scale + F.lit(0.0)).alias(name)

        return self.build(spark, sf_dir).select(*[typed(n, k) for n, k in self.items()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None

        def typed(name: str, kind: str) -> str:
            if kind in SQL_TYPES:
                return f'CAST("{name}" AS {SQL_TYPES[kind]}) AS "{name}"'
            scale = f"{10 ** int(kind)}e0"
            return f'round_even(CAST("{name}" AS DOUBLE) * {scale}, 0) / {scale} + 0e0 AS "{name}"'

        return f"SELECT {', '.join(typed(n, k) for n, k in self.items())} FROM ({self.sql}) AS result"
