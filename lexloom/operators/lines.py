"""Pages as lines: positions, zones, repeated heads and feet, reassembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.functions import text as T


def lines_of(pages: DataFrame, text: str) -> DataFrame:
    """(document_id, page, line_no from 0, line, lines): every line of every page with their number."""
    parts = F.split(F.col(text), "\n")
    return pages.select("document_id", "page", F.size(parts).alias("lines"), F.posexplode_outer(parts).alias("line_no", "line")).filter("line is not null")


def zone_depth(lines: Column, zone: int) -> Column:
    """Head and foot never overlap: at most half of the page's lines, at least one."""
    return F.greatest(F.lit(1), F.least(F.lit(zone), F.floor(lines / 2).cast("int")))


def repeated_zone_lines(pages: DataFrame, text: str, zone: int = 3, ratio: float = 0.55) -> DataFrame:
    """(document_id, side, canonical, pages): lines that stand at the head or foot of enough pages of a document
    of three pages or more, digits and accents aside; legally meaningful and very short lines are left alone."""
    lines = lines_of(pages, text)
    depth = zone_depth(F.col("lines"), zone)
    sides = F.filter(
        F.array(F.when(F.col("line_no") < depth, "top"), F.when(F.col("line_no") >= F.col("lines") - depth, "bottom")), lambda s: s.isNotNull()
    )
    lines = lines.withColumn("side", F.explode(sides)).withColumn("line", F.trim("line"))
    lines = lines.filter((F.length("line") >= 4) & ~T.is_protected(F.col("line"))).withColumn("canonical", T.canonical_line(F.col("line"))).filter("canonical <> ''")
    seen = lines.groupBy("document_id", "side", "canonical").agg(F.countDistinct("page").alias("pages"))
    sizes = pages.groupBy("document_id").agg(F.countDistinct("page").alias("n"))
    least = F.greatest(F.lit(3), F.floor(F.col("n") * ratio).cast("int"))
    return seen.join(sizes, "document_id").filter(F.col("n") >= 3).filter(F.col("pages") >= least).select("document_id", "side", "canonical", "pages")


def clean_pages(pages: DataFrame, text: str, zone: int = 3, ratio: float = 0.55) -> DataFrame:
    """(document_id, page, text, removed): pages without repeated heads and feet, page numbers and decoration,
    typography unified, words and wrapped lines joined, white space collapsed. Legal lines always stay."""
    base = pages.select("document_id", "page", T.join_hyphenated(T.unify_typography(T.strip_controls(F.col(text)))).alias("t"))
    repeated = repeated_zone_lines(base, "t", zone, ratio)
    per_side = repeated.groupBy("document_id").agg(
        F.collect_set(F.when(F.col("side") == "top", F.col("canonical"))).alias("top"),
        F.collect_set(F.when(F.col("side") == "bottom", F.col("canonical"))).alias("bottom"),
    )
    joined = base.join(per_side, "document_id", "left")
    none = F.array().cast("array<string>")
    top, bottom = F.coalesce("top", none), F.coalesce("bottom", none)

    def keep(line: Column, i: Column) -> Column:
        body = F.trim(line)
        depth = zone_depth(F.size("lines"), zone)
        in_top, in_bottom = i < depth, i >= F.size("lines") - depth
        form = T.canonical_line(body)
        furniture = in_top & F.array_contains(top, form) | in_bottom & F.array_contains(bottom, form)
        number = (in_top | in_bottom) & T.is_page_number(body)
        return (body == "") | T.is_protected(body) | ~(furniture | number | T.is_decoration(body))

    kept = joined.withColumn("lines", F.split("t", "\n")).withColumn("kept", F.filter("lines", keep))
    flowed = F.array_join("kept", "\n")
    return kept.select(
        "document_id", "page",
        T.collapse_whitespace(join_wrapped(flowed)).alias("text"),
        (F.size("lines") - F.size("kept")).alias("removed"),
    )


def join_wrapped(text: Column) -> Column:
    """Lines joined where the first ends in no strong punctuation and the next begins with a small letter."""
    return F.regexp_replace(text, "(?<=[^.;:!?»\"')\\]\\s])[ \\t]*\\n[ \\t]*(?=\\p{Ll})", " ")


def with_offsets(pages: DataFrame, text: str) -> DataFrame:
    """lines_of with ``begin``: each line's offset in the document's pages joined by line feeds."""
    lines = lines_of(pages, text)
    order = Window.partitionBy("document_id").orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("begin", F.coalesce(F.sum(F.length("line") + 1).over(order), F.lit(0)))


def document_text(pages: DataFrame, text: str = "text") -> DataFrame:
    """(document_id, text): the pages' texts in order, joined by line feeds; null texts count as empty."""
    parts = F.array_sort(F.collect_list(F.struct("page", F.coalesce(text, F.lit("")).alias("t"))))
    return pages.groupBy("document_id").agg(F.array_join(F.transform(parts, lambda p: p["t"]), "\n").alias("text"))


def cleaning_report(before: DataFrame, after: DataFrame, text: str) -> DataFrame:
    """(document_id, pages, chars_before, chars_after, removed_lines, ratio, emptied, warning): what cleaning took from
    each document; more than a quarter, or a page emptied, is worth a warning."""
    b = before.select("document_id", "page", F.length(F.coalesce(text, F.lit(""))).alias("b"))
    joined = b.join(after.select("document_id", "page", F.length("text").alias("a"), "removed"), ["document_id", "page"])
    per = joined.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("b").alias("chars_before"), F.sum("a").alias("chars_after"), F.sum("removed").alias("removed_lines"),
        F.sum(((F.col("b") > 0) & (F.col("a") == 0)).cast("int")).alias("emptied"),
    )
    ratio = F.when(F.col("chars_before") > 0, F.greatest(F.lit(0.0), 1 - F.col("chars_after") / F.col("chars_before"))).otherwise(0.0)
    warning = F.when(F.col("ratio") > 0.25, "much removed").when(F.col("emptied") > 0, "page emptied")
    return per.withColumn("ratio", F.round(ratio, 4)).withColumn("warning", warning)
