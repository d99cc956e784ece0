"""The pN_ queries: each operator over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexloom.llm import boilerplate, components, markup, mixing, mojibake, scans, splitting, tokenizer
from lexloom.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return components.matched_groups(table(spark, folder, "documents"), table(spark, folder, "duplicates"))


def p1_groups(spark: SparkSession, folder: str) -> DataFrame:
    return components.group_matches(table(spark, folder, "documents"), table(spark, folder, "duplicates"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    marked = markup.clean_pages(table(spark, folder, "pages")).select("document_id", "page", F.explode_outer("markup").alias("markup"))
    return marked.filter("markup is not null").distinct()


def p2_clean(spark: SparkSession, folder: str) -> DataFrame:
    return markup.clean_pages(table(spark, folder, "pages"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    pages = scans.repaired_pages(table(spark, folder, "pages"))
    return pages.select("document_id", "page", F.explode_outer("defects").alias("defect")).filter("defect is not null").distinct()


def p3_text(spark: SparkSession, folder: str) -> DataFrame:
    return scans.repaired_pages(table(spark, folder, "pages"))


def _split(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_oversized(*(table(spark, folder, t) for t in ("documents", "pages", "structure", "split_limits")))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder).select("item_kind", "item_id").distinct()


def p4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder)


def p4_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Per item its size as its pieces cover it, whether all are within the limit, and whether each begins by exactly the
    overlap before the end of the one before."""
    pieces = _split(spark, folder)
    limits = table(spark, folder, "split_limits").select("item_kind", "max_size", "overlap")
    before = F.lag("stop").over(Window.partitionBy("item_kind", "item_id").orderBy("piece_no"))
    rows = pieces.join(limits, "item_kind").withColumn("before", before)
    return rows.groupBy("item_kind", "item_id").agg(
        (F.max("stop") - F.min("begin")).alias("size"), F.min(F.col("stop") - F.col("begin") <= F.col("max_size")).alias("within"),
        F.min(F.coalesce(F.col("before") - F.col("begin") == F.col("overlap"), F.lit(True))).alias("overlapping"),
    )


def _pages_and_documents(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, folder, "pages"), table(spark, folder, "documents")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.excess_occurrences(*_pages_and_documents(spark, folder))


def p5_lines(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.excess_report(*_pages_and_documents(spark, folder)).drop("g2")


def p5_clean(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.without_excess(*_pages_and_documents(spark, folder))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenizer.token_ids(table(spark, folder, "documents"), "doc_id", "text")


def p6_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """The digest of the text that each document's ids decode to: the round trip over the whole corpus."""
    back = tokenizer.decoded(p6_ids(spark, folder), "doc_id")
    return back.select("doc_id", F.md5(F.col("text")).alias("digest"))


def p7_draws(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[0]


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[1]


def p7_tempered(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of a mix half as large as the targeted sources: repetition limits bind, so the exponent is below 1."""
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), of_corpus=0.5)[1]


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return mojibake.restored_texts(table(spark, folder, "documents")).select("doc_id")


def p8_restored(spark: SparkSession, folder: str) -> DataFrame:
    return mojibake.restored_texts(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_groups, p2_found, p2_clean, p3_found, p3_text, p4_found, p4_pieces, p4_checked, p5_found, p5_lines, p5_clean, p6_ids, p6_decoded, p7_draws, p7_shares, p7_tempered, p8_found, p8_restored)
}
