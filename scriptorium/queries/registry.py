"""Registration of queries with the bindings they read and their SQL check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..bindings import BINDINGS, bound, with_clause


class Tables:
    """Attribute access to bindings and test tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return bound(self.spark, self.sf_dir, name)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register a query. ``sql`` may name any binding; ``extra`` adds named SELECTs."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        full = None
        if sql is not None:
            texts = [sql, *(extra or {}).values()]
            used = [b for b in BINDINGS if any(b in text for text in texts)]
            parts = [with_clause(used)] if used else []
            for cte, body in (extra or {}).items():
                parts.append(("WITH " if not parts else ", ") + f"{cte} AS ({body})")
            full = "\n".join([*parts, sql])
        REGISTRY[name] = Query(name, build, full)
        return build

    return register
