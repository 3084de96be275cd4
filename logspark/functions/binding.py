"""Name an intermediate value inside one expression.

A Column used several times is copied into the plan each time, and copies of copies grow fast.
``let`` evaluates it once, as the variable of a lambda.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_fields(df: DataFrame, fields: list[Column], keep: list[str] | None = None) -> DataFrame:
    """``df`` plus computed columns, each worked out once per row.

    Written as a one-row ``inline``: a later filter on a computed column stays above it. Through a
    plain projection the optimizer would copy the whole definition into the filter, again for each
    mention, and long parse chains would grow without end. Filters on input columns still move down.
    The values are computed by a projection, which is compiled; the ``inline`` only unpacks them.
    """
    kept = df.columns if keep is None else keep
    packed = df.select(*kept, F.struct(*fields).alias("__packed"))
    return packed.select(*kept, F.inline(F.array("__packed")))
