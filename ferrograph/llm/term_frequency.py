"""Frequency of every distinct value of a list column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of every script, and nothing else.
BLANK = r"(?U)^\s*$"


def run_heads(values: Column) -> Column:
    """The sorted values of a list, each with a flag on the first of equal ones."""
    s = F.array_sort(values)
    return F.transform(s, lambda v, i: F.struct(v.alias("term"), ((i == 0) | (F.get(s, i - 1) != v)).cast("long").alias("head")))


def term_frequency(df: DataFrame, values: str, term: str = "term") -> DataFrame:
    """(term, occurrences, records): how often each distinct value occurs and in how many rows.

    The values of a row are sorted inside the row, so that the first of equal ones can be told without a
    shuffle by row; both counts are then sums, which the hash aggregate combines in each map task before
    anything is shuffled: a value that holds a third of all rows arrives as one row a task.
    A null list has no values; null and blank (only white space) values don't count; values are
    compared as stored; equal rows count as rows. An empty table gives no rows.
    """
    kept = F.filter(F.col(f"`{values}`"), lambda v: v.isNotNull() & ~v.rlike(BLANK))
    return (
        df.select(F.inline(run_heads(kept)))
        .groupBy("term")
        .agg(F.count("*").alias("occurrences"), F.sum("head").alias("records"))
        .withColumnRenamed("term", term)
    )


def mark_extremes(freq: DataFrame, rows: DataFrame, rare_most: int = 2, common_over: float = 0.05) -> DataFrame:
    """Adds ``mark``: ``rare`` in at most ``rare_most`` records, ``common`` in more than the share ``common_over`` of all rows, else null.

    ``rows`` is the counted table; its size is one number, joined as a single row. Where a small table
    makes a value both, it is marked twice: one row for each mark.
    """
    total = rows.agg(F.count("*").alias("all_rows"))
    marks = F.filter(
        F.array(
            F.when(F.col("records") <= rare_most, F.lit("rare")),
            F.when(F.col("records") > F.col("all_rows") * F.lit(common_over), F.lit("common")),
        ),
        lambda m: m.isNotNull(),
    )
    return freq.join(F.broadcast(total)).withColumn("mark", F.explode_outer(marks)).drop("all_rows")
