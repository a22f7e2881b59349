"""Registered queries: name -> f(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (through the adapters in
``bazaar.sources.fixtures``) and calls library operators.  Doubles are
rounded at the edge (``finish``) so results compare across engines; the
matching DuckDB SQL lives in ``bazaar.plans.oracle``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed "as of" date of the registered mart queries (replaces current_date).
AS_OF = "2002-01-01"


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round_binary(c, digits: int):
    """Round a double at ``digits`` places as round(x * 10^d) / 10^d.

    ``F.round`` rounds the shortest decimal string of the double, so a value
    printed as ...5 goes up even when its binary value lies just below the
    half; scaling first rounds the binary product, which is what the SQL
    oracle does (identical on 200k tie-prone test values).
    """
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def finish(df: DataFrame, digits: int = 6, money: dict[str, int] | None = None,
           nullable_ints: tuple[str, ...] = ()) -> DataFrame:
    """Presentation edge of a registered query, identical in the oracle SQL.

    * doubles are rounded (6 places, or per-column ``money`` places) by ``round_binary``;
    * dates are emitted as timestamps (midnight), the one temporal type both
      engines hand over the same way;
    * integer columns that can be NULL (``nullable_ints``) are emitted as
      doubles, so a missing value is NaN on both sides.
    """
    money = money or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in nullable_ints:
            cols.append(c.cast("double").alias(f.name))
        elif isinstance(f.dataType, DoubleType):
            cols.append(round_binary(c, money.get(f.name, digits)).alias(f.name))
        elif isinstance(f.dataType, DateType):
            cols.append(c.cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def load_all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Import the query modules (their decorators fill QUERIES) and return the registry."""
    from bazaar.plans import (q_cohorts, q_customers, q_events, q_experiments, q_more,  # noqa: F401
                              q_quality, q_segments, q_sources)
    return dict(QUERIES)
