"""Keyed tables: last row wins, upserts, decisions that stick, cascades, merges, text patches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The last row of each key in the given order (which should be total)."""
    w = Window.partitionBy(*keys).orderBy(*[o.desc() for o in order])
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def replace_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose key isn't in ``new``."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def sticky(old: DataFrame, new: DataFrame, key: str, column: str, undecided: str) -> DataFrame:
    """``new`` with the former value of ``column`` wherever a decision had been taken."""
    before = old.select(key, F.col(column).alias("_before"))
    kept = F.when(F.col("_before").isNotNull() & (F.col("_before") != undecided), F.col("_before")).otherwise(F.col(column))
    return new.join(before, key, "left").withColumn(column, kept).drop("_before")


def cascade(child: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent isn't removed."""
    return child.join(removed.select(key).distinct(), key, "left_anti")


def merged(base: DataFrame, piece: DataFrame, accepted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(base with the accepted rows of ``piece`` that it lacks, the rows refused because the key exists)."""
    wanted = piece.join(accepted.select(key).distinct(), key, "left_semi")
    have = base.select(key).distinct()
    return base.unionByName(wanted.join(have, key, "left_anti")), wanted.join(have, key, "left_semi")


def occurrences(text: Column, part: Column) -> Column:
    """How often ``part`` occurs without overlap; 0 for an empty part."""
    n = (F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)
    return F.when(F.length(part) > 0, n.cast("int")).otherwise(0)


def patched(df: DataFrame, text: str, before: str, after: str) -> DataFrame:
    """``text`` with ``before`` replaced by ``after`` where it occurs exactly once; ``applied`` says where."""
    once = occurrences(F.col(text), F.col(before)) == 1
    return df.withColumn("applied", F.coalesce(once, F.lit(False))).withColumn(
        text, F.when(F.col("applied"), F.replace(F.col(text), F.col(before), F.col(after))).otherwise(F.col(text))
    )


def unmatched(expected: DataFrame, received: DataFrame) -> DataFrame:
    """Rows that only one side has, with multiplicity."""
    return expected.exceptAll(received).withColumn("side", F.lit("missing")).unionByName(
        received.exceptAll(expected).withColumn("side", F.lit("unexpected"))
    )


def split_errors(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their ``error``): one bad row never stops the others."""
    marked = df.withColumn("error", error)
    return marked.filter("error is null").drop("error"), marked.filter("error is not null")
