"""Exports of a corpus: nested documents, denormalised articles, categories, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

FORMATS = ("parquet", "json", "csv", "orc")


def nested(documents: DataFrame, **children: DataFrame) -> DataFrame:
    """documents with one array of structs per child table, in the order of the child's columns."""
    out = documents
    for name, child in children.items():
        columns = [c for c in child.columns if c != "document_id"]
        grouped = child.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))
        out = out.join(grouped, "document_id", "left").withColumn(name, F.coalesce(name, F.array().cast(grouped.schema[name].dataType)))
    return out


def article_records(articles: DataFrame, metadata: DataFrame, sources: DataFrame) -> DataFrame:
    """Articles with the fields of their document, so that a reader needs no join: all columns of ``articles``, the file of the
    document, and its title, type, number, date, status, jurisdiction and language (null where there is no row)."""
    said = metadata.groupBy("document_id").agg(F.max(F.struct("title", "type", "number", "date", "status", "jurisdiction", "language")).alias("m"))
    file = sources.groupBy("document_id").agg(F.min(F.struct("filename", "source_path")).alias("s"))
    joined = articles.join(said, "document_id", "left").join(file, "document_id", "left")
    names = [F.col(f"m.{c}").alias(f"document_{c}") for c in ("title", "type", "number", "date", "status")]
    return joined.select(*articles.columns, *names, "m.jurisdiction", "m.language", F.col("s.filename").alias("source_file"), "s.source_path")


def replace_in_folders(df: DataFrame, path: str, key: str, by: str, kind: str = "json") -> None:
    """Rows in one folder per value of ``by``; rows of the same key that an earlier run had put into another folder are
    removed, and everything else stays. The folders concerned are written anew beside the old ones before they replace them."""
    spark = df.sparkSession
    try:
        old = spark.read.schema(df.schema).format(kind).load(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return export(df, path, kind, by)
    from lexloom.plans.staging import stage

    own = df.select(key, F.col(by).alias("_new")).distinct()
    touched = old.join(own, key).select(by).union(df.select(by)).distinct()
    kept = old.join(touched, by, "left_semi").join(own.select(key), key, "left_anti").select(*df.columns)
    after = stage(kept.unionByName(df), "folders")
    emptied = touched.join(after.select(by), by, "left_anti").collect()  # folders that nothing is left for, no rows
    export(after, path, kind, by)
    jvm = spark.sparkContext._jvm
    for row in emptied:
        folder = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(by, row[0])
        gone = jvm.org.apache.hadoop.fs.Path(path, folder)
        gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    return None


def export(df: DataFrame, path: str, kind: str = "parquet", by: str | None = None, mode: str = "overwrite") -> None:
    """Writes ``df``; with ``by`` one folder per value, of which only those present are overwritten."""
    if kind not in FORMATS:
        raise ValueError(f"one of {FORMATS}")
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(by).option("partitionOverwriteMode", "dynamic")
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)


def quality_report(scores: DataFrame, score: str, status: str) -> DataFrame:
    """One row: number, average, least and greatest score, and a map of the numbers by status."""
    by = scores.groupBy(status).agg(F.count(F.lit(1)).alias("n"), F.sum(score).alias("s"), F.min(score).alias("lo"), F.max(score).alias("hi"))
    pairs = F.map_from_entries(F.array_sort(F.collect_list(F.struct(status, "n")))).alias("by_status")
    return by.agg(F.sum("n").alias("documents"), F.round(F.sum("s") / F.sum("n"), 4).alias("average"), F.min("lo").alias("least"), F.max("hi").alias("greatest"), pairs)
