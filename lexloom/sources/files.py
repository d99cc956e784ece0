"""File inventories, text readers and page scrapers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

IGNORED = (".gitkeep", ".DS_Store", "Thumbs.db")


def inventory(spark: SparkSession, root: str, extensions: tuple[str, ...], folders: tuple[str, ...] = (), default: str = "autres") -> DataFrame:
    """(source_path, filename, extension, size_bytes, file_hash, modified_at, category, error) of all files below
    ``root``, sorted by path. The category is the first known folder of the path, else ``default``."""
    glob = "*.{" + ",".join(e.lstrip(".") for e in extensions) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    # The scan passes over empty files; their paths are known to it, and they become rows with an error.
    same = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")
    listed = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string").select(same.alias("path"))
    listed = listed.join(files.select(same.alias("path")), "path", "left_anti")
    empty = listed.select("path", F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(0).cast("bigint").alias("length"), F.lit(b"").alias("content"))
    files = files.unionByName(empty)
    files = files.withColumn("filename", name).filter(~F.col("filename").isin(*IGNORED) & ~F.startswith("filename", F.lit("~$")))
    return files.select(
        F.col("path").alias("source_path"), "filename", F.lower(F.regexp_extract("filename", "(\\.[^.]+)$", 1)).alias("extension"),
        F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("file_hash"), F.col("modificationTime").alias("modified_at"),
        category(F.col("path"), folders, default).alias("category"),
        F.when(F.col("length") == 0, "empty file").alias("error"),
    ).orderBy("source_path")


def category(path: Column, known: tuple[str, ...], default: str = "autres") -> Column:
    parts = F.filter(F.split(path, "/"), lambda p: p.isin(*known)) if known else F.array().cast("array<string>")
    return F.coalesce(F.get(parts, 0), F.lit(default))


def usable(sources: DataFrame) -> DataFrame:
    return sources.filter("error is null or raw_path is not null")


def jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines): blank lines are skipped, lines that don't parse are kept apart."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"))
    bad = F.try_variant_get(F.try_parse_json("value"), "$", "variant").isNull()
    return parsed.filter(~bad).select("r.*"), parsed.filter(bad).select("value")


def sidecars(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """Metadata files ``NAME.meta.json`` below root as (stem, fields)."""
    files = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.meta.json").load(root)
    stem = F.regexp_extract(F.col("_metadata.file_name"), "^(.*)\\.meta\\.json$", 1)
    return files.select(stem.alias("stem"), F.from_json("value", schema).alias("fields"))


def scraped(pages: DataFrame, text: str, marker: str, fields: dict[str, str]) -> DataFrame:
    """One row per entry of an index page: the text is cut at ``marker`` (a pattern), each field is the first group
    of its pattern, with HTML entities of the basic kind resolved; entries with the same first field are kept once."""
    entries = pages.select(F.posexplode_outer(F.split(F.col(text), marker)).alias("position", "entry")).filter("position > 0")
    plain = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&"))
    rows = entries.select("position", *[F.nullif(F.trim(plain(F.regexp_extract("entry", p, 1))), F.lit("")).alias(n) for n, p in fields.items()])
    key = next(iter(fields))
    first = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("position", *[n for n in fields if n != key])).alias("f"))
    return first.select(key, *[F.col(f"f.{n}").alias(n) for n in fields if n != key])


def hybrid(native: DataFrame, other: DataFrame) -> DataFrame:
    """(document_id, page, text, method): per page the other reading where its text is longer."""
    o = other.select("document_id", "page", F.col("text").alias("_o"))
    longer = F.length(F.trim(F.coalesce("_o", F.lit("")))) > F.length(F.trim(F.coalesce("text", F.lit(""))))
    joined = native.select("document_id", "page", "text").join(o, ["document_id", "page"], "left")
    return joined.select("document_id", "page", F.when(longer, F.col("_o")).otherwise(F.col("text")).alias("text"), F.when(longer, "ocr").otherwise("native").alias("method"))
