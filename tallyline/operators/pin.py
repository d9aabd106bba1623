"""Keep Catalyst from repeating long chains of expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Like ``withColumn``, but later steps take the value as given.

    Catalyst looks through projections: it moves a filter below them by repeating
    their expressions in it, and follows a join key down to its source in the
    same way. Over a dozen steps that each use the one before several times, the
    repeated text grows without bound, and the work is done twice. A generator of
    one row per row is where it stops looking.
    """
    others = [F.col(f"`{column}`") for column in df.columns if column != name]
    # The value is computed in a projection, which is compiled; a generator may not be.
    return df.withColumn("_given", value).select(*others, F.explode(F.array("_given")).alias(name))
