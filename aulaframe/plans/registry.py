"""Registry of named analyses: Spark builder + SQL oracle text.

Every registered analysis is a Spark DataFrame built by the library's
operators over the given tables. Its optional oracle is an independent SQL
statement over the same tables (DuckDB dialect). Floating columns listed in
``floats`` are rounded to 8 significant digits on both sides by the same
SQL expression, so results compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from aulaframe.functions.columns import round_sig, sig_sql


@dataclass
class Analysis:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    body: str | None = None
    ctes: Sequence[str] = field(default_factory=tuple)
    floats: Sequence[str] = field(default_factory=tuple)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_sig(self.build(spark, sf_dir), list(self.floats))

    def oracle(self) -> str | None:
        if self.body is None:
            return None
        parts = [c.strip() for c in self.ctes] + [f"__q AS (\n{self.body.strip()}\n)"]
        sel = "*"
        if self.floats:
            spec = [c if isinstance(c, tuple) else (c, 8) for c in self.floats]
            rep = ", ".join(f"{sig_sql(f'\"{c}\"', d)} AS \"{c}\"" for c, d in spec)
            sel = f"* REPLACE ({rep})"
        return "WITH " + ",\n".join(parts) + f"\nSELECT {sel} FROM __q"


REGISTRY: dict[str, Analysis] = {}


def grid(*names: str) -> tuple[tuple[str, int], ...]:
    """Columns whose exact values sit on the data's decimal grid (quantiles,
    fences, extremes of 2-decimal inputs): they carry only a few ulps of
    noise, so they are rounded at 12 significant digits, well below the
    grid, where no rounding tie can occur."""
    return tuple((n, 12) for n in names)


def register(name: str, sql: str | None = None, ctes: Sequence[str] = (),
             floats: Sequence[str] = ()):
    """Decorator registering ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate analysis {name}")
        REGISTRY[name] = Analysis(name, fn, sql, tuple(ctes), tuple(floats))
        return fn

    return deco


def load_all() -> dict[str, Analysis]:
    """Import every binding module (each registers its analyses)."""
    from aulaframe.plans import (  # noqa: F401
        bind_univariate, bind_bivariate, bind_contingency, bind_star,
        bind_quality, bind_clean, bind_budget, bind_counts, bind_io, bind_factor)
    return REGISTRY
