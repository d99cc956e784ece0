"""Chunks of texts: whole if they fit, else packed sentences with an overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Where a sentence ends, and how far a whole text may exceed the limit.
SENTENCE_END = "(?<=[.;:!?])\\s+(?=[A-ZÀ-Ü0-9«\"(-])"
TOLERANCE = 1.2


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.trim(text), SENTENCE_END), lambda s: F.trim(s)), lambda s: s != "")


def packed(units: Column, most: int, overlap: int = 0) -> Column:
    """Array of blocks of units joined by blanks, of at most ``most`` characters (a longer unit stands alone); a
    block begins with the last units of the one before, up to ``overlap`` characters."""
    empty, none = F.array().cast("array<string>"), F.array().cast("array<string>")
    start = F.struct(none.alias("done"), empty.alias("now"), F.lit(0).alias("size"))

    def tail(now: Column) -> Column:
        walked = F.aggregate(
            F.reverse(now), F.struct(empty.alias("kept"), F.lit(0).alias("n"), F.lit(False).alias("over")),
            lambda a, u: F.when(a["over"] | ((a["n"] + F.length(u) > overlap) & (F.size(a["kept"]) > 0)), F.struct(a["kept"].alias("kept"), a["n"].alias("n"), F.lit(True).alias("over")))
            .otherwise(F.struct(F.concat(F.array(u), a["kept"]).alias("kept"), (a["n"] + F.length(u) + 1).alias("n"), F.lit(False).alias("over"))),
        )
        return walked["kept"]

    def step(a: Column, unit: Column) -> Column:
        full = (F.size(a["now"]) > 0) & (a["size"] + F.length(unit) + 1 > most)
        kept = tail(a["now"]) if overlap > 0 else empty
        base = F.when(full, kept).otherwise(a["now"])
        size = F.when(full, F.aggregate(kept, F.lit(0), lambda n, u: n + F.length(u) + 1)).otherwise(a["size"])
        done = F.when(full, F.concat(a["done"], F.array(F.array_join(a["now"], " ")))).otherwise(a["done"])
        return F.struct(done.alias("done"), F.concat(base, F.array(unit)).alias("now"), (size + F.length(unit) + 1).alias("size"))

    finish = lambda a: F.when(F.size(a["now"]) > 0, F.concat(a["done"], F.array(F.array_join(a["now"], " ")))).otherwise(a["done"])
    return F.aggregate(F.coalesce(units, none), start, step, finish)


def chunked(df: DataFrame, key: str, text: str, most: int, overlap: int = 0) -> DataFrame:
    """(key, position, text): whole texts within the tolerance, packed sentences of the others; blank texts give
    none. An overlap as large as the limit is cut to a tenth of it."""
    overlap = most // 10 if overlap >= most else overlap
    body = F.trim(F.col(text))
    parts = F.when(F.length(body) <= most * TOLERANCE, F.array(body)).otherwise(packed(sentences(body), most, overlap))
    rows = df.select(F.col(key), body.alias("_b"), F.posexplode_outer(parts).alias("position", "text")).filter("_b <> '' and text is not null")
    return rows.select(key, "position", "text")


def fixed(df: DataFrame, key: str, text: str, size: int, overlap: int) -> DataFrame:
    """(key, position, begin, text): windows of ``size`` characters that step by size less overlap."""
    step = size - overlap
    n = F.when(F.length(text) > 0, F.greatest(F.lit(1), F.ceil((F.length(text) - overlap) / step))).otherwise(0).cast("int")
    rows = df.filter(F.length(text) > 0).select(key, F.col(text).alias("_t"), F.explode(F.sequence(F.lit(0), n - 1)).alias("position"))
    begin = F.col("position") * step
    return rows.select(key, "position", begin.alias("begin"), F.substring(F.col("_t"), begin + 1, F.lit(size)).alias("text"))


def article_chunks(articles: DataFrame, strategy: str = "article", most: int = 1500, overlap: int = 150) -> DataFrame:
    """(chunk_id, document_id, article_id, position, text, strategy) of articles(document_id, article_id, text).

    ``article`` keeps what fits and packs the sentences of the rest, ``paragraph`` makes one chunk of each numbered or
    blank-parted block, ``fixed`` cuts windows. Positions count within the document, in the order of the ids."""
    from lexloom.operators.structure import paragraphs

    if strategy == "article":
        parts = chunked(articles, "article_id", "text", most, overlap).select("article_id", F.col("position").alias("_i"), "text")
    elif strategy == "paragraph":
        parts = paragraphs(articles, "article_id").select("article_id", F.col("idx").alias("_i"), "text")
    elif strategy == "fixed":
        parts = fixed(articles, "article_id", "text", most, overlap).select("article_id", F.col("position").alias("_i"), "text")
    else:
        raise ValueError("strategy is article, paragraph or fixed")
    rows = parts.join(articles.select("document_id", "article_id"), "article_id")
    position = F.row_number().over(Window.partitionBy("document_id").orderBy("article_id", "_i")) - 1
    rows = rows.withColumn("position", position)
    chunk_id = F.concat("article_id", F.lit("_chunk_"), F.lpad(F.col("_i").cast("string"), 3, "0"))
    return rows.select(chunk_id.alias("chunk_id"), "document_id", "article_id", "position", "text", F.lit(strategy).alias("strategy"))
