"""Column profiling: storage type suggestion (AGG-04), correlations (AGG-09).

Both are a single aggregate pass over the table (one partial aggregate per
task, one tiny exchange), then a `stack` to long form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.numeric import to_number


def suggest_types(df: DataFrame) -> DataFrame:
    """(column_name, position, suggested_type) for every column.

    Each cell is read as a number (anything else -> null). No number at all
    -> TEXT; every number whole -> INTEGER; otherwise FLOAT. The input is
    not modified.
    """
    aggs = []
    for i, c in enumerate(df.columns):
        d = to_number(F.col(f"`{c}`"))
        aggs.append(F.count(d).alias(f"n{i}"))
        whole = (d == F.floor(d)) & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))
        aggs.append(F.bool_and(F.when(d.isNotNull(), whole)).alias(f"w{i}"))
    stats = df.agg(*aggs)
    kinds = [F.when(F.col(f"n{i}") == 0, F.lit("TEXT"))
             .when(F.col(f"w{i}"), F.lit("INTEGER")).otherwise(F.lit("FLOAT"))
             for i in range(len(df.columns))]
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"),
                                 kinds[i].alias("suggested_type"))
                        for i, c in enumerate(df.columns)])
    return stats.select(F.inline(entries))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair (a < b in list order): (a, b, r)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    stats = df.agg(*[F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"p{j}")
                     for j, (a, b) in enumerate(pairs)])
    entries = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{j}").alias("r"))
                        for j, (a, b) in enumerate(pairs)])
    return stats.select(F.inline(entries))
