"""Problem 4: split oversized items at natural boundaries with an overlap.

An item is a string, and its pieces are the successive matches of one regular expression with bounded
quantifiers: each alternative consumes as much as the limit allows up to a boundary of one strength,
the strongest first, and the last alternative cuts anywhere. Pieces look back by the overlap, so a match
takes at most the limit less the overlap. For page limits the string has one letter per page that tells
what kind of boundary follows the page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.plans.staging import stage

UNIT_MARK = "\u001e"
HEADING = r"(?i)(?:article|art\.|artigo|titre|title|t[ií]tulo|chapitre|chapter|cap[ií]tulo|section|sec[cç][aã]o|annexe?|anexo)(?-i)\s"
TEXT_BOUNDARIES = (
    rf"(?<={UNIT_MARK})|(?<=\n)(?=\h*{HEADING})",  # a structural unit begins
    r"(?<=\n\h{0,8}\r?\n)",  # a paragraph ended
    r"(?<=[.;!?…]\h{0,3}\r?\n)",  # a line and sentence ended
    r"(?<=[.;!?…]\s)",  # a sentence ended
    r"(?<=\s)",  # a word ended
)
PAGE_BOUNDARIES = ("(?<=u)", "(?<=s)")


def piece_pattern(limit: Column, overlap: Column, boundaries: tuple[str, ...]) -> Column:
    """The expression whose matches are the pieces without their look-back.

    A piece that ends at a boundary has at least half of what fits and at least the overlap."""
    fits = F.greatest(limit - overlap, F.lit(1))
    least = F.least(fits, F.greatest(F.ceil(fits / 2), overlap, F.lit(1)))
    most = fits.cast("string")
    parts = [F.lit("(?s).{1,"), most, F.lit(r"}\z")]
    for b in boundaries:
        parts += [F.lit("|.{"), least.cast("string"), F.lit(","), most, F.lit(f"}}(?:{b})")]
    return F.concat(*parts, F.lit("|.{1,"), most, F.lit("}"))


def split_items(items: DataFrame, boundaries: tuple[str, ...]) -> DataFrame:
    """Pieces of ``items(item_kind, item_id, body, begin, size, max_size, overlap)``.

    Returns (item_kind, item_id, piece_no, begin, stop, piece): piece_no from 0, [begin, stop) counted from
    the item's own ``begin`` in characters of body, pieces overlapping by exactly ``overlap``, together covering
    the item's ``size``. Where the body is shorter than that, pieces of even length without text follow; no
    string is made for what is missing, however far a wrong offset points.
    """
    limit, overlap = F.col("max_size"), F.col("overlap")
    head = ["item_kind", "item_id", "begin", "overlap"]
    cores = F.regexp_extract_all("body", piece_pattern(limit, overlap, boundaries), F.lit(0))
    cut = items.select(*head, F.posexplode_outer(cores).alias("at", "core")).filter("at is not null")
    cut = cut.select(*head, F.col("at").cast("bigint").alias("at"), "core", F.length("core").cast("bigint").alias("n"))
    missing, fits = F.col("size") - F.length("body"), F.greatest(limit - overlap, F.lit(1))
    empty = items.withColumn("missing", missing).withColumn("fits", fits).filter("missing > 0")
    empty = empty.select(*head, "missing", "fits", F.explode(F.sequence(F.lit(0), F.ceil(F.col("missing") / F.col("fits")) - 1)).alias("i"))
    length = F.least(F.col("fits").cast("bigint"), F.col("missing") - F.col("i") * F.col("fits"))
    empty = empty.select(*head, (F.col("i") + F.lit(1 << 40)).alias("at"), F.lit(None).cast("string").alias("core"), length.alias("n"))
    item = Window.partitionBy("item_kind", "item_id").orderBy("at")
    rows = cut.unionByName(empty)
    rows = rows.withColumn("stop", F.sum("n").over(item.rowsBetween(Window.unboundedPreceding, 0))).withColumn("piece_no", F.row_number().over(item) - 1)
    rows = rows.withColumn("before", F.lag("core").over(item))
    back = F.when(F.col("piece_no") > 0, F.least(F.col("overlap").cast("bigint"), F.col("stop") - F.col("n"))).otherwise(0)
    tail = F.when(F.col("piece_no") > 0, F.expr("right(before, overlap)")).otherwise("")
    return rows.select(
        "item_kind",
        "item_id",
        "piece_no",
        (F.col("begin") + F.col("stop") - F.col("n") - back).cast("bigint").alias("begin"),
        (F.col("begin") + F.col("stop")).cast("bigint").alias("stop"),
        F.concat(F.coalesce(tail, F.lit("")), "core").alias("piece"),
    )


def _limit(limits: DataFrame, kind: str, unit: str) -> DataFrame:
    ok = f"item_kind = '{kind}' and unit = '{unit}' and max_size > 0"
    return limits.filter(ok).groupBy("item_kind").agg(
        F.min("max_size").alias("max_size"), F.min(F.coalesce("overlap", F.lit(0))).alias("overlap")
    )


def _sized(df: DataFrame, limits: DataFrame, kind: str, unit: str) -> DataFrame:
    """Rows of ``df`` whose ``size`` exceeds the limit of their kind; an overlap is cut to what fits."""
    joined = df.withColumn("item_kind", F.lit(kind)).join(_limit(limits, kind, unit), "item_kind")
    room = F.least("overlap", F.floor((F.col("max_size") - 1) / 2).cast("int"))
    return joined.filter("size > max_size").withColumn("overlap", F.greatest(room, F.lit(0)))


def oversized_documents(documents: DataFrame, pages: DataFrame, limits: DataFrame) -> DataFrame:
    """(item_kind, item_id, size, max_size, overlap): page_count, or the pages that arrived where that is
    null or zero, exceeds the limit."""
    stated = documents.filter("document_id is not null").groupBy("document_id").agg(F.max("page_count").alias("stated"))
    unknown = stated.filter("coalesce(stated, 0) = 0").select("document_id")
    arrived = (
        pages.filter("page is not null").join(unknown, "document_id", "left_semi")
        .select("document_id", "page").distinct().groupBy("document_id").agg(F.count("page").alias("arrived"))
    )
    size = F.when(F.coalesce("stated", F.lit(0)) != 0, F.col("stated")).otherwise(F.coalesce("arrived", F.lit(0)))
    sized = stated.join(arrived, "document_id", "left").select(F.col("document_id").alias("item_id"), size.cast("int").alias("size"))
    return _sized(sized, limits, "document", "page")


def document_pieces(documents: DataFrame, pages: DataFrame, structure: DataFrame, limits: DataFrame) -> DataFrame:
    """Pieces of documents with too many pages; begin and stop are page numbers from 1, stop exclusive.

    Cuts fall before a page on which a structural unit begins, else after a page whose text ends a
    sentence, else anywhere. Pages that didn't arrive count as pages without a boundary."""
    big = stage(oversized_documents(documents, pages, limits), "big-documents")
    ids = big.select(F.col("item_id").alias("document_id"))
    unit = structure.filter("page > 1").join(ids, "document_id", "left_semi").select("document_id", (F.col("page") - 1).alias("page"), F.lit("u").alias("code"))
    ended = pages.join(ids, "document_id", "left_semi").filter(F.col("text").rlike(r"[.;!?…]\s*\z"))
    ended = ended.select("document_id", "page", F.lit("s").alias("code"))
    # 's' < 'u': the strongest boundary of a page is the greatest code.
    codes = unit.union(ended).filter("page is not null").groupBy("document_id", "page").agg(F.max("code").alias("code"))
    codes = codes.groupBy(F.col("document_id").alias("item_id")).agg(F.map_from_entries(F.collect_list(F.struct("page", "code"))).alias("codes"))
    # Letters up to one limit behind the last page that something is known of; further pages have no boundaries.
    known = F.least(F.col("size"), F.coalesce(F.array_max(F.map_keys("codes")) + F.col("max_size"), F.lit(0)))
    letters = F.transform(F.sequence(F.lit(1), F.greatest(known, F.lit(1))), lambda i: F.coalesce(F.try_element_at("codes", i), F.lit("x")))
    items = big.join(codes, "item_id", "left").withColumn("body", F.when(known > 0, F.array_join(letters, "")).otherwise("")).withColumn("begin", F.lit(1))
    return split_items(items, PAGE_BOUNDARIES).withColumn("piece", F.lit(None).cast("string"))


def oversized_nodes(structure: DataFrame, limits: DataFrame) -> DataFrame:
    """(item_kind, item_id, document_id, begin, size, max_size, overlap) of nodes with both offsets and too
    long a span; swapped offsets count as their distance. Repeated rows give one; of different rows of one
    node_id the first by (offsets, document) counts."""
    spans = structure.filter("node_id is not null and char_start is not null and char_end is not null")
    spans = spans.select(
        F.col("node_id").alias("item_id"), "document_id",
        F.least("char_start", "char_end").alias("begin"), F.abs(F.col("char_end").cast("long") - F.col("char_start")).alias("size"),
    )
    spans = spans.groupBy("item_id").agg(F.max(F.struct("size", "begin", "document_id")).alias("s")).select("item_id", "s.*")
    return _sized(spans, limits, "node", "char")


def node_pieces(documents: DataFrame, structure: DataFrame, limits: DataFrame) -> DataFrame:
    """Pieces of structure nodes with too long a span; begin and stop are offsets in documents.text.

    Cuts fall where another unit of the document begins or a heading line stands, else at the end of a
    paragraph, line, sentence or word, else anywhere. Where a span reaches beyond the text (or the text is
    missing), its last pieces have no text."""
    big = oversized_nodes(structure, limits)
    starts = structure.filter("char_start > 0").groupBy("document_id").agg(F.array_sort(F.collect_set("char_start")).alias("starts"))
    big = stage(big.join(starts, "document_id", "left"), "big-nodes")
    texts = documents.select("document_id", "text").filter("document_id is not null and text is not null")
    own = F.expr("substring(text, begin + 1, int(least(size, 2147483647L)))")
    # Positions in the body of the line feeds behind which another unit begins, in order. In four bytes a character every
    # slice is found at once, so a text with many units is gone through once and not once per unit.
    inner = F.expr("transform(filter(coalesce(starts, array()), x -> x > begin and x < begin + size), x -> int(x - begin))")
    # Arrays of one element bind what is computed once to a name.
    marked = F.expr(
        "get(transform(array(named_struct('wide', encode(body, 'UTF-32'), 'at', inner, 'n', length(body))), b -> "
        "get(transform(array(concat(array(0), filter(b.at, x -> x <= b.n and decode(substring(b.wide, 4 * x - 3, 4), 'UTF-32') = '\\n'), array(b.n + 1))), c -> "
        f"array_join(transform(sequence(1, size(c) - 1), k -> decode(substring(b.wide, 4 * c[k - 1] + 1, 4 * (c[k] - 1 - c[k - 1])), 'UTF-32')), '{UNIT_MARK}')), 0)), 0)"
    )
    items = (
        big.join(texts, "document_id", "left")
        .withColumn("text", F.coalesce("text", F.lit("")))
        .withColumn("begin", F.greatest("begin", F.lit(0)))  # a negative offset is read as 0, the span keeps its length
        .withColumn("body", own)
        .withColumn("inner", inner)
        .withColumn("body", F.when((F.size("inner") > 0) & (F.instr("body", UNIT_MARK) == 0), marked).otherwise(F.col("body")))
    )
    pieces = split_items(items, TEXT_BOUNDARIES)
    return pieces.withColumn("piece", F.translate("piece", UNIT_MARK, "\n"))


def split_oversized(documents: DataFrame, pages: DataFrame, structure: DataFrame, limits: DataFrame) -> DataFrame:
    """(item_kind, item_id, piece_no, begin, stop, piece) of all items beyond split_limits.

    Null ids and offsets, repeated rows, empty tables and extra columns are allowed; ``piece`` is the text
    of a node's piece, null beyond the text and for documents. A limit that is null or not above zero splits nothing."""
    of_documents = document_pieces(documents, pages, structure, limits)
    return of_documents.unionByName(node_pieces(documents, structure, limits))
