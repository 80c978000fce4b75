"""Registered queries: one Spark callable and, where SQL can say it, one oracle.

Every query states its output once, as ``"name kind, name kind"``. The same list
types the Spark result and the oracle result, so both sides agree on names,
order-free values and types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import oracle
from tidemark.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, tuple[str, str]] = {}
_OUTPUTS: dict[str, str] = {}

# kind: (Spark column -> column, SQL text with {c} for the column)
_KINDS = {
    "bigint": (lambda c: c.cast("bigint"), "CAST({c} AS BIGINT)"),
    "int": (lambda c: c.cast("int"), "CAST({c} AS INTEGER)"),
    "double": (lambda c: c.cast("double"), "CAST({c} AS DOUBLE)"),
    "string": (lambda c: c.cast("string"), "CAST({c} AS VARCHAR)"),
    "date": (lambda c: c.cast("date").cast("string"), "CAST(CAST({c} AS DATE) AS VARCHAR)"),
    "ts": (lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
           "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"),
    "flag": (lambda c: c.cast("int"), "CAST({c} AS INTEGER)"),
    "r2": (lambda c: F.round(c.cast("double"), 2), "round(CAST({c} AS DOUBLE), 2)"),
    "r4": (lambda c: F.round(c.cast("double"), 4), "round(CAST({c} AS DOUBLE), 4)"),
    "r6": (lambda c: F.round(c.cast("double"), 6), "round(CAST({c} AS DOUBLE), 6)"),
    "r8": (lambda c: F.round(c.cast("double"), 8), "round(CAST({c} AS DOUBLE), 8)"),
}


def _fields(out: str) -> list[tuple[str, str]]:
    return [tuple(part.split()) for part in out.split(",")]


def shape(df: DataFrame, out: str) -> DataFrame:
    """Project df onto the declared output columns and kinds."""
    return df.select(*[_KINDS[kind][0](F.col(name)).alias(name) for name, kind in _fields(out)])


def query(name: str, out: str, sql: str | None = None):
    """Register a query; sql may use any of the oracle's named relations."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shape(build(tune(spark), sf_dir), out)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name], _OUTPUTS[name] = run, out
        if sql is not None:
            casts = ", ".join(f"{_KINDS[kind][1].format(c=col)} AS {col}" for col, kind in _fields(out))
            _ORACLES[name] = (sql, casts)
        return build
    return register


def outputs(name: str) -> str:
    """The declared output of a registered query, for another of the same shape."""
    return _OUTPUTS[name]


def oracles() -> dict[str, str]:
    """The oracle statements, each with the definitions of the relations it uses."""
    from tidemark.plans import oracle_landing, oracle_star  # noqa: F401  (define the relations)

    return {name: oracle.statement(sql, casts) for name, (sql, casts) in _ORACLES.items()}
