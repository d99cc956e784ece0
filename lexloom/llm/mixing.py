"""Problem 7: mix sources to target shares of the total size.

Weights lie on an exponential path between the sources' own token shares q and the targets t: w is
proportional to q^(1-a) * t^a, which for equal targets is temperature mixing q^(1-a). The exponent is
bisected. Without a fixed budget it is the least one whose weights have the targets' entropy (relative
entropy to them below TOLERANCE), and the budget is the largest one that keeps every repetition limit.
With a budget it is the largest one whose weights keep the limits at that budget.

The weights are realised as whole passes over a source plus one part of a pseudo-random permutation of
its rows. The permutation is laid out in blocks; running totals are taken over block sums, and the block
in which a budget ends is parted into blocks again until what is left can be ordered row by row. The result
of this search is one row per source, the place where its budget ends; every row compares itself with it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.llm.tokenizer import BPE_50K, token_counts
from lexloom.plans.staging import Staged

#: A block is parted by so many more hexadecimal digits of the key, as long as one in which a budget ends has over LAST rows.
DIGITS, LAST = 3, 50_000
MAX_SOURCES = 100_000
TOLERANCE = 1e-12


@dataclass(frozen=True)
class Share:
    """One source of the mix: its size, its wanted share and how often a document may appear."""

    source: str
    tokens: int
    target: float
    max_repeats: int


def _normal(weights: list[float]) -> list[float]:
    total = sum(weights)
    return [w / total for w in weights] if total > 0 else [0.0 for _ in weights]


def path_weights(own: list[float], target: list[float], exponent: float) -> list[float]:
    return _normal([q ** (1 - exponent) * t**exponent if q > 0 and t > 0 else 0.0 for q, t in zip(own, target)])


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def relative_entropy(target: list[float], weights: list[float]) -> float:
    """How far the weights are from the targets: their cross entropy less the targets' own; 0 if they are equal."""
    return sum(t * math.log(t / w) + w - t for t, w in zip(target, weights) if t > 0 and w > 0)


def _bisect(holds, low: float, high: float, steps: int = 60) -> float:
    """The largest value for which ``holds`` is true, given that it is true at ``low``."""
    if holds(high):
        return high
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return low


def entropy_exponent(own: list[float], wanted: float) -> float:
    """The temperature exponent in [0, 1] at which own^exponent has the entropy ``wanted``.

    Exponent 1 keeps the shares, 0 makes them equal; entropy falls as the exponent rises."""
    return _bisect(lambda e: entropy(_normal([q**e if q > 0 else 0.0 for q in own])) >= wanted, 0.0, 1.0)


def mixing_weights(shares: list[Share], budget: float | None = None) -> tuple[list[float], float, float]:
    """(weights, budget in tokens, exponent). A source without tokens or target gets weight 0."""
    own, target = [float(s.tokens) for s in shares], [s.target for s in shares]
    usable = [s.tokens > 0 and s.target > 0 and s.max_repeats > 0 for s in shares]
    own, target = (_normal([x if u else 0.0 for x, u in zip(xs, usable)]) for xs in (own, target))
    room = [s.max_repeats * s.tokens for s in shares]
    if not any(usable):
        return [0.0] * len(shares), 0.0, 1.0
    if budget is None:
        near = lambda back: relative_entropy(target, path_weights(own, target, 1 - back)) <= TOLERANCE
        exponent = 1 - _bisect(near, 0.0, 1.0)
    else:
        fits = lambda a: all(w * budget <= r * (1 + 1e-12) for w, r in zip(path_weights(own, target, a), room))
        exponent = _bisect(fits, 0.0, 1.0)
    weights = path_weights(own, target, exponent)
    most = min(r / w for r, w in zip(room, weights) if w > 0)
    return weights, most if budget is None else min(float(budget), most), exponent


def _prefix(level: int) -> Column:
    return F.substring("key", 1, DIGITS * level)


def _ends(counts: DataFrame, rest: DataFrame) -> DataFrame:
    """(source, path, need): for rest(source, rest) the block of keys beginning with ``path`` in which the budget ends, and
    what the blocks before it leave to be drawn from it."""
    live = rest.select("source", F.lit("").alias("path"), F.col("rest").alias("need"))
    for level in range(1, 48 // DIGITS + 1):
        inside = counts.join(live, "source").filter(F.startswith("key", "path"))
        blocks = inside.groupBy("source", _prefix(level).alias("path"), "need").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("rows"))
        running = F.sum("n").over(Window.partitionBy("source").orderBy("path"))  # at most 16^DIGITS rows a source
        blocks = blocks.withColumn("upto", running).filter("upto > need and upto - n <= need")
        found = Staged(blocks.select("source", "path", (F.col("need") - F.col("upto") + F.col("n")).alias("need"), "rows"), "mix-ends").df
        live = found.select("source", "path", "need")
        if (found.agg(F.max("rows")).first()[0] or 0) <= LAST:
            break
    return live


def _part(counts: DataFrame, rest: DataFrame) -> DataFrame:
    """(source, bound, gap): the rows up to the key ``bound`` are drawn, ``gap`` is what they leave of the budget ``rest``.
    A source whose rows don't fill it has a bound above all keys."""
    ends = _ends(counts, rest)
    inside = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    last = counts.join(ends, "source").filter(F.startswith("key", "path")).withColumn("upto", F.sum("n_tokens").over(inside))
    fits = F.col("upto") <= F.col("need")
    # Where no row of the last block fits all keys below the block's own are drawn.
    ended = last.groupBy("source", "path", "need").agg(F.max(F.when(fits, F.col("key"))).alias("key"), F.max(F.when(fits, F.col("upto"))).alias("upto"))
    ended = ended.select("source", F.coalesce("key", "path").alias("bound"), (F.col("need") - F.coalesce("upto", F.lit(0))).alias("gap"))
    sums = counts.groupBy("source").agg(F.sum("n_tokens").alias("n"))
    whole = rest.join(ends, "source", "left_anti").join(sums, "source").select("source", F.lit("z").alias("bound"), (F.col("rest") - F.col("n")).alias("gap"))
    return Staged(ended.unionByName(whole), "mix-bounds").df


def mix(
    documents: DataFrame,
    targets: DataFrame,
    budget: float | None = None,
    seed: int = 17,
    vocabulary: str = BPE_50K,
    of_corpus: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(draws, shares).

    draws(doc_id, source, n_tokens, repeats): every drawn document and how often it appears.
    shares(source, target_share, max_repeats, exponent, weight, drawn_tokens, actual_share): one row per target.
    ``budget`` is in tokens, or ``of_corpus`` times the tokens of the sources that have a target.
    A source without documents has weight 0 and its target is spread over the others in proportion.
    Documents of null or untargeted sources and documents without tokens are not drawn; a target that
    is null or not above zero draws nothing. Of repeated targets of a source the largest row counts.
    Each source misses its budget by less than one document. Each row is a document of its own, also where ids
    are null or repeated. Extra columns are ignored, empty tables give empty draws.
    """
    spark = documents.sparkSession
    # The place depends on what the row says, not on where it lies; equal rows differ in nothing but their number.
    place = F.xxhash64(F.lit(seed), "doc_id", "text").alias("place")
    kept = documents.filter("source is not null").select("doc_id", "source", "text", place)
    sized = token_counts(kept, "text", ["doc_id", "source", "place"], vocabulary).filter("n_tokens > 0")
    counts = Staged(sized.withColumn("uid", F.monotonically_increasing_id()), "token-counts").df
    hexed = lambda c: F.lpad(F.hex(c), 16, "0")
    counts = counts.withColumn("key", F.concat(hexed(F.col("place")), hexed(F.xxhash64(F.lit(seed), "uid")), hexed(F.col("uid"))))
    sums = counts.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    wanted = targets.filter("source is not null").groupBy("source").agg(
        F.max(F.struct("target_share", "max_repeats")).alias("t")
    )
    # One row per row of the parameter table; a mix of more sources than MAX_SOURCES is refused.
    rows = wanted.join(sums, "source", "left").select("source", "t.*", "tokens").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"a mix has at most {MAX_SOURCES} sources")
    rows = sorted(rows, key=lambda r: r["source"])
    shares = [Share(r["source"], r["tokens"] or 0, r["target_share"] or 0.0, r["max_repeats"] or 0) for r in rows]
    if of_corpus is not None:
        budget = of_corpus * sum(s.tokens for s in shares if s.target > 0)
    weights, total, exponent = mixing_weights(shares, budget)
    plan = []
    for r, s, w in zip(rows, shares, weights):
        want = min(w * total, float(s.max_repeats * s.tokens))
        passes = min(int(want / s.tokens + 1e-9), s.max_repeats) if s.tokens and w > 0 else 0
        rest = max(0.0, want - passes * s.tokens) if passes < s.max_repeats and w > 0 else 0.0
        plan.append((s.source, r["target_share"], r["max_repeats"], exponent, w, passes, rest if rest >= 0.5 else 0.0))
    schema = "source string, target_share double, max_repeats int, exponent double, weight double, passes int, rest double"
    plan = spark.createDataFrame(plan, schema)

    first = _part(counts, plan.filter("rest > 0").select("source", "rest"))
    # A long row may stop the part far from its budget: the permutation goes on with the rows that still fit.
    later = counts.join(first, "source").filter((F.col("key") > F.col("bound")) & (F.col("n_tokens") <= F.col("gap"))).select(*counts.columns)
    second = _part(later, first.select("source", F.col("gap").alias("rest")).filter("rest > 0"))
    bound = first.join(second.select("source", F.col("bound").alias("bound2"), F.col("gap").alias("gap2")), "source", "left")
    bound = Staged(bound.select("source", "bound", "gap", "bound2", F.coalesce("gap2", "gap").alias("gap2")), "mix-bounds").df
    drawn = counts.join(plan.filter("weight > 0").select("source", "passes"), "source").join(bound, "source", "left")
    later = (F.col("n_tokens") <= F.col("gap")) & (F.col("key") <= F.col("bound2"))
    drawn = drawn.withColumn("extra", F.coalesce((F.col("key") <= F.col("bound")) | later, F.lit(False)))
    # One more row where that brings the source nearer to its budget.
    off = F.abs(F.col("n_tokens") - F.col("gap2"))
    filler = drawn.filter(~F.col("extra") & (off < F.col("gap2"))).groupBy("source").agg(F.min(F.struct(off.alias("off"), "key")).alias("m"))
    filler = Staged(filler.select("source", F.col("m.key").alias("filler")), "mix-fillers").df
    extra = F.col("extra") | F.coalesce(F.col("key") == F.col("filler"), F.lit(False))
    draws = drawn.join(filler, "source", "left").withColumn("repeats", F.col("passes") + extra.cast("int")).filter("repeats > 0")
    draws = Staged(draws.select("doc_id", "source", "n_tokens", "repeats"), "mix-draws").df
    got = draws.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("drawn_tokens"))
    report = plan.select("source", "target_share", "max_repeats", "exponent", "weight").join(got, "source", "left")
    report = report.withColumn("drawn_tokens", F.coalesce("drawn_tokens", F.lit(0)))
    size = got.agg(F.sum("drawn_tokens").alias("whole")).first()["whole"] or 0
    report = report.withColumn("actual_share", F.col("drawn_tokens") / F.lit(float(size)) if size else F.lit(0.0))
    return draws, report
