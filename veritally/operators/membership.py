"""SQL's NOT IN, without its forced broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Rows whose value is not among those of the one-column frame ``listed``.

    As in SQL nothing is left if the list holds a null, a null value is never left unless the list
    is empty, and everything is left then. Written as NOT IN, Spark would have to broadcast the
    list whatever its size; an anti join lets it choose.
    """
    name = listed.columns[0]
    counts = listed.agg(
        F.struct(
            F.count(F.lit(1)).alias("all"), F.count_if(F.col(name).isNull()).alias("nulls")
        ).alias("counts")
    )
    members = listed.select(F.col(name).alias("__member")).filter(F.col("__member").isNotNull())
    counted = df.join(members.distinct(), F.col(column) == F.col("__member"), "left_anti").withColumn(
        "__list", counts.scalar()
    )
    empty, nulls = F.col("__list.all") == 0, F.col("__list.nulls")
    return counted.filter(empty | ((nulls == 0) & F.col(column).isNotNull())).drop("__list")
