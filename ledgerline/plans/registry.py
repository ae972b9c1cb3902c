"""All registered queries and their SQL, by operator name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans.sql import PRE
from ledgerline.sources.bind import Model

_QUERIES: dict[str, Callable[[Model], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, pre: bool = True) -> Callable:
    """Registers a function of the model under a name; `sql` goes on from the common table expressions unless `pre` is false."""

    def add(f: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
        assert name not in _QUERIES, name
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = f"{PRE}{',' if sql.lstrip().startswith('+') else ''} {sql.lstrip().removeprefix('+')}" if pre else sql
        return f

    return add


def _load() -> None:
    from ledgerline.plans import archive, audits, gates, ingest, joins, merges, publishing, rebuild, reductions, scalars, scans, windows  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, sf_dir, f=f: f(Model(spark, sf_dir))) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
