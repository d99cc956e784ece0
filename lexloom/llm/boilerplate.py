"""Problem 5: find lines repeated excessively within one source and remove them from its pages.

For every line of a source the number of its documents with the line is compared with the frequency
outside the source by the log-likelihood ratio of two binomial rates. Lines that are significantly more
frequent inside, with the false discovery rate controlled over all tested lines, are candidates; those
that also reach the stated share are excessive. Sources where the line is itself a candidate by share
don't count as its outside, else the same notice on several sites would hide itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.plans.staging import stage

MIN_CHARS, MIN_DOCS, MIN_SHARE = 20, 4, 0.1
FALSE_DISCOVERY = 0.1
#: Half a document with the line in so many is added outside: a rate of a thousandth. Any line has a rate to compare
#: with, and where few documents are outside the share decides.
BACKGROUND = 500.0
# Fixed value: white space but the line feed, as Unicode and common text tools have it.
BLANKS = "[\\t\\x0B\\f\\r\\x1C-\\x1F \\u0085\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+"
#: p-values are ranked in steps of a hundredth of a power of ten, down to the smallest double.
STEPS = 30_000
# Coefficients of the Chebyshev fit of the complementary error function (relative error below 1.2e-7).
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def canonical(text: Column) -> Column:
    """Lower case, runs of digits as one 0, runs of white space as one space, lines trimmed; by whole text."""
    lines = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]+", "0"), BLANKS, " ")
    return F.split(F.regexp_replace(lines, " ?\\n ?", "\n"), "\n")


def line_places(pages: DataFrame, documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(source, document_id, page, line_no, h1, h2): one row per line of ``min_chars`` or more; the canonical line is
    held by two independent 64-bit hashes. No row gathers others, so neither a document nor a source can be too
    large."""
    owner = documents.filter("source is not null and document_id is not null").groupBy("document_id").agg(F.min("source").alias("source"))
    texts = pages.filter("raw_text is not null and document_id is not null").select("document_id", "page", "raw_text")
    lines = texts.join(owner, "document_id").select(
        "source", "document_id", "page", F.posexplode_outer(canonical(F.col("raw_text"))).alias("line_no", "line")
    )
    line = F.trim("line")
    lines = lines.select(
        "source", "document_id", "page", (F.col("line_no") + 1).alias("line_no"),
        F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(41), F.reverse(line)).alias("h2"), F.length(line).alias("n"),
    )
    return lines.filter(F.col("n") >= min_chars).drop("n")


def _log_erfc(x: Column) -> Column:
    t = 1 / (1 + x / 2)
    poly: Column = F.lit(0.0)
    for c in reversed(ERFC):
        poly = poly * t + F.lit(c)
    return F.log(t) - x * x + poly


def _g2(k: Column, n: Column, out_k: Column, out_n: Column) -> Column:
    """Twice the log-likelihood ratio of rates k/n and out_k/out_n against one common rate."""

    def part(hits: Column, size: Column, rate: Column) -> Column:
        miss = size - hits
        return F.when(hits > 0, hits * F.log(hits / size / rate)).otherwise(0.0) + F.when(
            miss > 0, miss * F.log(miss / size / (1 - rate))
        ).otherwise(0.0)

    common = (k + out_k) / (n + out_n)
    return F.when(common >= 1, 0.0).otherwise(2 * (part(k, n, common) + part(out_k, out_n, common)))


def excess_lines(
    places: DataFrame,
    sizes: DataFrame,
    min_docs: int = MIN_DOCS,
    min_share: float = MIN_SHARE,
    false_discovery: float = FALSE_DISCOVERY,
) -> DataFrame:
    """(source, h1, h2, docs, source_docs, g2): lines significantly in excess in their source and within
    the stated share. ``places`` as of line_places, ``sizes(source, n)`` the sources' documents."""
    once = places.select("source", "h1", "h2", "document_id").distinct()
    counts = once.groupBy("source", "h1", "h2").agg(F.count(F.lit(1)).alias("k")).join(sizes, "source")
    # A quotient is exact where a share is: 70 * 0.1 is more than 7. Small sources with the line are no outside either.
    high = F.col("k") / F.col("n") >= min_share
    counts = stage(counts.withColumn("high", high), "line-counts")
    # One row per line: what it amounts to in the sources where it isn't high, and the size of the others.
    by_line = counts.groupBy("h1", "h2").agg(
        F.sum(F.when(F.col("high"), 0).otherwise(F.col("k"))).alias("low_k"),
        F.sum(F.when(F.col("high"), F.col("n")).otherwise(0)).alias("high_n"), F.max("k").alias("most"),
    )
    # A line that very many sources have is a heavy key on the left only, which adaptive execution splits.
    tested = counts.filter(F.col("k") >= min_docs).join(by_line.filter(F.col("most") >= min_docs).drop("most"), ["h1", "h2"])
    all_n = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    own_k = F.when(F.col("high"), 0).otherwise(F.col("k"))
    own_n = F.when(F.col("high"), 0).otherwise(F.col("n"))
    out_k, out_n = (F.col("low_k") - own_k).cast("double"), (F.lit(all_n) - F.col("high_n") - own_n).cast("double")
    out_k, out_n = out_k + 0.5, out_n + BACKGROUND
    k, n = F.col("k").cast("double"), F.col("n").cast("double")
    tested = tested.withColumn("g2", F.when(k / n > out_k / out_n, _g2(k, n, out_k, out_n)).otherwise(0.0))
    step = F.least(F.floor(-_log_erfc(F.sqrt(F.col("g2") / 2)) / F.log(F.lit(10.0)) * 100), F.lit(STEPS)).cast("int")
    tested = stage(tested.withColumn("step", F.greatest(step, F.lit(0))).select("source", "h1", "h2", "k", "n", "g2", "step"), "tested-lines")
    # Benjamini-Hochberg over steps: the largest p whose rank from the smallest still allows it.
    ranks = tested.groupBy("step").agg(F.count(F.lit(1)).alias("c"))  # at most STEPS + 1 rows
    down = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    ranks = ranks.withColumn("rank", F.sum("c").over(down)).withColumn("m", F.sum("c").over(Window.partitionBy()))
    passes = F.pow(F.lit(10.0), -F.col("step") / 100) <= F.lit(false_discovery) * F.col("rank") / F.col("m")
    bound = ranks.filter(passes).agg(F.min("step").alias("bound")).first()["bound"]
    found = tested.filter((F.col("step") >= F.lit(STEPS + 1 if bound is None else bound)) & (F.col("g2") > 0))
    found = found.filter((F.col("k") >= min_docs) & (F.col("k") / F.col("n") >= min_share))
    return found.select("source", "h1", "h2", F.col("k").alias("docs"), F.col("n").alias("source_docs"), "g2")


def _analysed(pages: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    places = stage(line_places(pages, documents), "line-places")
    owner = documents.filter("source is not null and document_id is not null").select("document_id", "source")
    owner = owner.groupBy("document_id").agg(F.min("source").alias("source"))
    with_text = pages.filter("raw_text is not null and document_id is not null").select("document_id")
    sizes = owner.join(with_text, "document_id", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return places, stage(excess_lines(places, stage(sizes, "source-sizes")), "excess-lines")


def excess_occurrences(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(document_id, page, line_no): each occurrence of a line in excess in its document's source.

    Lines are the pieces of raw_text between line feeds, from 1. Null raw_text, documents without source
    and pages of unknown documents have no occurrences; repeated page rows count once; empty tables
    give an empty result; extra columns are ignored.
    """
    places, excess = _analysed(pages, documents)
    hit = places.join(excess.select("source", "h1", "h2"), ["source", "h1", "h2"], "left_semi")
    return hit.select("document_id", "page", "line_no").distinct()


def _same_page(a: DataFrame, b: DataFrame) -> Column:
    """Join condition; a null page is a page like others."""
    return (a["document_id"] == b["document_id"]) & a["page"].eqNullSafe(b["page"])


def excess_report(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(source, line, docs, source_docs, g2): the excessive lines of each source in their canonical form."""
    places, excess = _analysed(pages, documents)
    hit = places.join(excess, ["source", "h1", "h2"])
    sample = F.min(F.struct("document_id", "page", "line_no"))
    hit = hit.groupBy("source", "h1", "h2", "docs", "source_docs", "g2").agg(sample.alias("s"))
    hit = hit.select("source", "h1", "h2", "docs", "source_docs", "g2", "s.document_id", "s.page", "s.line_no")
    texts = pages.select("document_id", "page", "raw_text").filter("raw_text is not null")
    joined = hit.join(texts, _same_page(hit, texts)).withColumn("line", F.trim(F.get(canonical(F.col("raw_text")), F.col("line_no") - 1)))
    # Of several rows of one page the one that has the line.
    joined = joined.filter((F.xxhash64("line") == F.col("h1")) & (F.xxhash64(F.lit(41), F.reverse("line")) == F.col("h2")))
    return joined.select("source", "line", "docs", "source_docs", "g2").distinct()


def without_excess(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(document_id, page, raw_text, removed): every page row, its excessive lines taken out and the others
    put together again in order. Rows keep their number; null raw_text stays null with removed 0."""
    gone = stage(excess_occurrences(pages, documents).groupBy("document_id", "page").agg(F.collect_set("line_no").alias("gone")), "gone-lines")
    own = pages.select("document_id", "page", "raw_text")
    joined = own.join(gone, _same_page(own, gone), "left").select(own["document_id"], own["page"], "raw_text", "gone")
    kept = F.expr("array_join(filter(split(raw_text, '\\n'), (x, i) -> not array_contains(gone, i + 1)), '\\n')")
    return joined.select(
        "document_id", "page",
        F.when(F.col("gone").isNull() | F.col("raw_text").isNull(), F.col("raw_text")).otherwise(kept).alias("raw_text"),
        F.when(F.col("raw_text").isNull(), 0).otherwise(F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))).alias("removed"),
    )
