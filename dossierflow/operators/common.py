"""Plan helpers used by several operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUILT: dict[tuple, object] = {}


def reused(build: Callable) -> Callable:
    """Keep the columns a function builds from names and flags.

    A long expression takes seconds to assemble from Python, call by call; it
    does not change within an application, so jobs after the first reuse it.
    """

    @wraps(build)
    def get(*args):
        context = SparkContext._active_spark_context
        key = (context.applicationId if context else None, build.__module__, build.__name__, args)
        try:
            hash(key)
        except TypeError:  # e.g. a Column argument
            return build(*args)
        if any(isinstance(a, Column) for a in args):
            return build(*args)
        if key not in _BUILT:
            _BUILT[key] = build(*args)
        return _BUILT[key]

    return get


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions are costly and are read more than once.

    Catalyst would otherwise copy the expression into every filter and
    projection above it. Passing the values through a one-row generator keeps a
    single evaluation without a shuffle; the planner does not push filters on a
    generator's output below it.
    """
    kept = [c for c in df.columns if c not in columns]
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*kept, F.explode_outer(F.array(made)).alias("_made")).select(
        *kept, *[F.col("_made")[n].alias(n) for n in columns]
    )


def explode_rows(df: DataFrame, keys: list[str], items: Column, as_: str, pos: str) -> DataFrame:
    """One row per array element with its 0-based position; empty arrays give none.

    The outer form keeps the optimizer from evaluating ``items`` a second time
    in an inferred size filter.
    """
    rows = df.select(*keys, F.posexplode_outer(items).alias(pos, as_))
    return rows.filter(F.col(pos).isNotNull())
