"""Fields of acts as value, confidence and evidence; reconciliation with a catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.functions.numbers import MONTHS, lookup, same_number, written_date
from lexloom.functions.text import fold
from lexloom.operators.references import ARTICLE_LINE, without_citations

# Kinds of acts, the words that announce them, and the fields that make an act complete.
TYPE_WORDS = {
    "loi": "\\bloi\\b", "decret": "\\bdecret\\b", "arrete": "\\barrete\\b", "ordonnance": "\\bordonnance\\b", "decision": "\\bdecision\\b",
    "circulaire": "\\bcirculaire\\b", "convention": "\\b(?:convention|convencao|agreement)\\b",
}
FIELDS = ("title", "type", "number", "date", "authority", "language", "source")


def field(value: Column, confidence: float, evidence: Column) -> Column:
    shape = F.struct(value.cast("string").alias("value"), F.lit(confidence).alias("confidence"), evidence.cast("string").alias("evidence"))
    return F.when(value.isNotNull() & (value != ""), shape)


def first_field(*candidates: Column) -> Column:
    """The first candidate that has a value: candidates go from the surest to the weakest."""
    return F.coalesce(*candidates)


def head(text: Column) -> Column:
    """The text before the first article; all of it where there is none."""
    return F.get(F.split(text, f"(?m){ARTICLE_LINE}", 2), 0)


def act_type(text: Column, category: Column, name: Column) -> Column:
    """Kind whose word stands first in the head of the text or, where it has none, in the whole text, recitals aside; else the
    folder's, else the file name's, else the first in the recitals."""

    def first(part: Column) -> Column:
        plain = fold(part)
        places = [F.when(F.regexp_instr(plain, F.lit(p)) > 0, F.struct(F.regexp_instr(plain, F.lit(p)).alias("at"), F.lit(t).alias("t"))) for t, p in TYPE_WORDS.items()]
        return F.least(*places)["t"]

    own = without_citations(text)
    prefix = F.substring_index(name, "_", 1)
    return first_field(
        field(first(head(own)), 0.90, F.lit("head")),
        field(first(own), 0.60, F.lit("text")),
        field(F.when(category.isin(*TYPE_WORDS), category), 0.45, F.lit("category")),
        field(F.when(prefix.isin(*TYPE_WORDS), prefix), 0.35, F.lit("name")),
        field(first(text), 0.30, F.lit("recital")),
    )


def act_number(text: Column, name: Column | None = None) -> Column:
    """First number of the head, recitals aside (confidence 0.92), else of the text without recitals (0.75), else the one in the
    file name (0.65), else of a recital (0.40)."""
    pattern = "(?iu)\\bn[°º.o]{1,3}\\s*([0-9]{2,4}\\s*[-–]\\s*[0-9]{1,4})"
    tidy = lambda t: F.regexp_replace(F.regexp_replace(F.regexp_extract(t, pattern, 1), "\\s+", ""), "–", "-")
    own = without_citations(text)
    named = [] if name is None else [field(number_of_name(name), 0.65, F.lit("name"))]
    return first_field(field(tidy(head(own)), 0.92, F.lit("head")), field(tidy(own), 0.75, F.lit("text")), *named, field(tidy(text), 0.40, F.lit("recital")))


def number_of_name(name: Column) -> Column:
    """The number in a file name or id such as ``loi_1986_0004845`` (1986-0004845), else null."""
    pattern = "^[a-z]+[-_]([0-9]{2,4})[-_]([0-9]{1,7})(?:[-_.]|$)"
    return F.when(name.rlike(pattern), F.concat_ws("-", F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)))


def act_date(text: Column) -> Column:
    """Date of the head, recitals aside (0.95), of the last signature (0.90), any other (0.55), of a recital (0.40). Dates of
    effect (``à compter du``) are none of the act's."""
    own = F.regexp_replace(without_citations(text), "(?iu)\\b(?:à\\s+compter|à\\s+partir)\\s+du\\s+[^\\n,;.]{0,40}", " ")
    signed = F.try_element_at(F.regexp_extract_all(text, F.lit("(?iu)\\b((?:fait à|done at|feito em)\\s+[^\\n]{2,60})"), F.lit(1)), F.lit(-1))
    return first_field(
        field(written_date(head(own)), 0.95, F.lit("head")),
        field(written_date(signed), 0.90, F.lit("signature")),
        field(written_date(own), 0.55, F.lit("text")),
        field(written_date(text), 0.40, F.lit("recital")),
    )


def domain(text: Column, keywords: dict[str, list[str]]) -> Column:
    """struct(value, confidence): the domain with most keyword hits; 0.55 if it has three and twice the next's."""
    plain = fold(text)
    count = lambda words: sum(((F.length(plain) - F.length(F.replace(plain, F.lit(w), F.lit("")))) / len(w) for w in words), F.lit(0.0))
    scored = F.sort_array(F.array(*[F.struct(count(ws).alias("n"), F.lit(d).alias("d")) for d, ws in keywords.items()]), asc=False)
    best, second = F.get(scored, 0), F.get(scored, 1)
    sure = best["n"] >= F.greatest(F.lit(3.0), 2 * F.coalesce(second["n"], F.lit(0.0)))
    return F.when(best["n"] > 0, F.struct(best["d"].alias("value"), F.when(sure, 0.55).otherwise(0.30).alias("confidence")))


def completeness(df: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """With ``completeness`` (share of fields that say something) and ``missing`` (their names)."""
    said = lambda c: F.col(c).isNotNull() & ~F.trim(c).isin("", "inconnu")
    missing = F.filter(F.array(*[F.when(~said(c), F.lit(c)) for c in fields]), lambda x: x.isNotNull())
    return df.withColumn("missing", missing).withColumn("completeness", F.round((len(fields) - F.size("missing")) / len(fields), 4))


# French names under which a manual file may give a field.
ALIASES = {"title": "titre", "number": "numero", "authority": "autorite", "language": "langue", "legal_domain": "domaine", "status": "statut"}


def with_overrides(df: DataFrame, manual: DataFrame, key: str, fields: tuple[str, ...], allowed: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Manual values before extracted ones. A field may come under its alias; values that aren't ``allowed`` for their field,
    and empty ones, override nothing."""
    values = {f: F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in (f, ALIASES.get(f)) if c in manual.columns], F.lit(None).cast("string")) for f in fields}
    values |= {f: F.when(F.lower(values[f]).isin(*a), F.lower(values[f])) for f, a in (allowed or {}).items()}
    m = manual.select(key, *[values[f].alias(f"_{f}") for f in fields])
    joined = df.join(m, key, "left")
    for f in fields:
        joined = joined.withColumn(f, F.coalesce(f"_{f}", f)).drop(f"_{f}")
    return joined


def reconcile(read: DataFrame, catalogue: DataFrame, key: str, fields: tuple[str, ...], number: str | None = "number") -> DataFrame:
    """(key, field, read, listed, verdict): per field ``filled`` (only the catalogue has it), ``confirmed``,
    ``diverges`` or ``read only``; numbers are compared whatever their notation."""
    c = catalogue.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    joined = read.join(c, key)
    rows = []
    for f in fields:
        a, b = F.nullif(F.trim(F.col(f)), F.lit("")), F.nullif(F.trim(F.col(f"_{f}")), F.lit(""))
        same = same_number(a, b) if f == number else fold(a) == fold(b)
        verdict = F.when(a.isNull() & b.isNull(), F.lit(None)).when(a.isNull(), "filled").when(b.isNull(), "read only").when(same, "confirmed").otherwise("diverges")
        rows.append(F.struct(F.lit(f).alias("field"), a.alias("read"), b.alias("listed"), verdict.alias("verdict")))
    return joined.select(key, F.explode(F.array(*rows)).alias("r")).select(key, "r.*").filter("verdict is not null")


def normal_hash(value: Column) -> Column:
    """A content hash without algorithm prefix, in lower case; null if empty."""
    return F.nullif(F.lower(F.regexp_replace(F.trim(value), "^(?iu)sha256:", "")), F.lit(""))


def attach_by_hash(documents: DataFrame, own_hash: str, catalogue: DataFrame, hash_column: str, order: str, columns: list[str]) -> DataFrame:
    """Left join on the normalised content hash; of several entries with one hash the last in ``order`` holds."""
    entries = catalogue.withColumn("_h", normal_hash(F.col(hash_column))).filter("_h is not null")
    last = entries.groupBy("_h").agg(F.max(F.struct(order, *columns)).alias("_e"))
    return documents.withColumn("_h", normal_hash(F.col(own_hash))).join(last, "_h", "left").select(*documents.columns, F.col("_e").alias("entry"))


def not_yet_done(sources: DataFrame, hash_column: str, done: DataFrame, done_column: str) -> DataFrame:
    """Sources whose content wasn't processed; sources without a hash always remain."""
    finished = done.select(F.col(done_column).alias("_d")).filter("_d is not null and _d <> ''").distinct()
    return sources.join(finished, sources[hash_column] == F.col("_d"), "left_anti")


def sequential_ids(df: DataFrame, name: Column, content: Column, *order: Column) -> DataFrame:
    """``new_id``: the name, for later rows of the same name with eight digits of the hash, then a counter."""
    w = Window.partitionBy("_base").orderBy(*order)
    rows = df.withColumn("_base", name).withColumn("_i", F.row_number().over(w))
    rows = rows.withColumn("_c", F.concat_ws("_", "_base", F.substring(F.coalesce(content, F.lit("")), 1, 8)))
    rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy("_c", F.col("_i") > 1).orderBy(*order)))
    new = F.when(F.col("_i") == 1, F.col("_base")).when(F.col("_k") == 1, F.col("_c")).otherwise(F.concat_ws("_", "_c", F.col("_k").cast("string")))
    return rows.withColumn("new_id", new).drop("_base", "_i", "_c", "_k")


def authority(text: Column, kind: Column, patterns: dict[str, str], by_kind: dict[str, str]) -> Column:
    """Issuing authority read from the head (0.80), else the one that issues acts of the kind (0.75), else read from the
    rest of the text (0.30)."""
    read = lambda part, sure: [field(F.when(fold(part).rlike(p), F.lit(name)), sure, F.lit("text")) for name, p in patterns.items()]
    return first_field(*read(head(text), 0.80), field(lookup(kind, by_kind), 0.75, F.lit("kind")), *read(text, 0.30))


def date_seen(text: Column, date: Column) -> Column:
    """Whether a date stands in the head or behind the last article's beginning, where the signature is, the month read with as many wrong letters as its length
    allows (none up to 4, one up to 7, else two) provided that no other month is as close."""
    last = F.try_element_at(F.split(text, f"(?m){ARTICLE_LINE}"), F.lit(-1))
    t = fold(F.concat_ws("\n", head(text), last))
    written = F.regexp_extract_all(t, F.lit("([0-9]{1,2}(?:er)?\\s+[a-z0-9|]{3,10}\\s+[0-9]{4})"), F.lit(1))
    months = F.array(*map(F.lit, MONTHS))
    target = F.get(months, F.substring(date, 6, 2).try_cast("int") - 1)

    def same(found: Column) -> Column:
        day = F.regexp_extract(found, "^([0-9]{1,2})", 1).try_cast("int") == F.substring(date, 9, 2).try_cast("int")
        year = F.substring(found, -4, 4) == F.substring(date, 1, 4)
        month = F.regexp_extract(found, "\\s([a-z0-9|]{3,10})\\s", 1)
        away = F.levenshtein(month, target)
        others = F.array_min(F.transform(F.filter(months, lambda m: m != target), lambda m: F.levenshtein(month, m)))
        allowed = F.when(F.length(target) <= 4, 0).when(F.length(target) <= 7, 1).otherwise(2)
        return day & year & (away <= allowed) & (away < others)

    return F.coalesce(F.exists(written, same), F.lit(False))


def third_witness(read: Column, listed: Column, text: Column) -> Column:
    """Which of two dates the text supports: read, listed, both or neither."""
    a, b = date_seen(text, read), date_seen(text, listed)
    return F.when(a & b, "both").when(a, "read").when(b, "listed").otherwise("neither")
