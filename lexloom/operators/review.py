"""Checks on proposed corrections, and event logs with a transition table."""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType

GRAM, LEAST_FIDELITY = 4, 0.35


def letters(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "[^\\p{L}]", ""))


def _overlap(a: str, b: str) -> float:
    x, y = (Counter(t[i : i + GRAM] for i in range(len(t) - GRAM + 1)) for t in (a, b))
    total = sum(x.values()) + sum(y.values())
    return 2 * sum((x & y).values()) / total if total else 0.0


@F.pandas_udf(DoubleType())
def fidelity(before: pd.Series, after: pd.Series) -> pd.Series:
    """How faithful a text is to another: the better of the longest-match ratio and the overlap of letter runs."""

    def one(a: str | None, b: str | None) -> float:
        a, b = ("".join(c for c in (t or "").lower() if c.isalpha()) for t in (a, b))
        return max(SequenceMatcher(None, a, b, autojunk=False).ratio(), _overlap(a, b)) if a and b else 0.0

    return pd.Series([one(a, b) for a, b in zip(before, after)])


def neighbours(df: DataFrame, group: str, order: str, item: str) -> DataFrame:
    """With ``previous`` and ``following`` items in order."""
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("previous", F.lag(item).over(w)).withColumn("following", F.lead(item).over(w))


def verified(corrections: DataFrame, texts: DataFrame, key: str, text: str, least_confidence: float = 0.8, drift: float = 0.5) -> DataFrame:
    """corrections(key, before, after, confidence) with ``refusal``: null if accepted, else why not: confidence too
    low, passage not found exactly once, or length changed by more than ``drift``."""
    joined = corrections.join(texts.select(key, F.col(text).alias("_t")), key, "left")
    n = F.when(F.length("before") > 0, (F.length("_t") - F.length(F.replace(F.col("_t"), F.col("before"), F.lit("")))) / F.length("before")).otherwise(0)
    change = F.abs(F.length("after") - F.length("before")) / F.greatest(F.length("before"), F.lit(1))
    why = F.when(F.coalesce("confidence", F.lit(0.0)) < least_confidence, "confidence").when(F.coalesce(n, F.lit(0)) != 1, "passage").when(change > drift, "length")
    return joined.withColumn("refusal", why).drop("_t")


def current_states(events: DataFrame, key: str, order: list[str], state: str) -> DataFrame:
    """(key, state, events): the state of each key after its last event."""
    last = F.max(F.struct(*order, F.col(state).alias("_s"))).alias("m")
    return events.groupBy(key).agg(last, F.count(F.lit(1)).alias("events")).select(key, F.col("m._s").alias(state), "events")


def illegal_steps(events: DataFrame, key: str, order: list[str], state: str, allowed: DataFrame) -> DataFrame:
    """Events whose step from the key's previous state isn't in allowed(from_state, to_state)."""
    w = Window.partitionBy(key).orderBy(*order)
    steps = events.withColumn("from_state", F.lag(state).over(w)).withColumn("to_state", F.col(state)).filter("from_state is not null")
    return steps.join(allowed.select("from_state", "to_state").distinct(), ["from_state", "to_state"], "left_anti")
