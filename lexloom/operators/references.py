"""References of acts as witnesses: what the text says and what the address says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexloom.functions.numbers import KINDS, bound, official_key, same_number
from lexloom.functions.text import fold

# The earliest year of an act, and the words that open citations, objects and articles.
EARLIEST = 1850
_ADDRESS = "(?iu)/(?:doc/)?([a-z]+)[-_/](?:n-)?([0-9]{2,4}\\s*[-–—_]\\s*[0-9]{1,4}(?:[-_](?:bis|ter|quater)[0-9]*)?)/?$"
CITATION_LINE = "(?iu)^\\s*(?:vu\\b|consid[ée]rant\\b|sur\\s+rapport\\b|apr[èe]s\\s+avis\\b)"
OBJECT = "(?iu)\\b(?:portant|relatives?\\s+(?:aux?|[àa])|relatifs?\\s+(?:aux?|[àa])|fixant|instituant|modifiant|compl[ée]tant|abrogeant|cr[ée]ant|organisant|autorisant|approuvant|ratifiant)\\b"
ARTICLE_LINE = "(?iu)^\\s*(?:article|art\\.)\\s"


def padded(number: Column) -> Column:
    """2016-7 as 2016-007; numbers of another form stay."""
    bare = F.regexp_replace(F.regexp_replace(number, "\\s+", ""), "[–—_]", "-")
    serial = F.substring_index(bare, "-", -1)
    return F.when(bare.rlike("^[^-]+-[0-9]+$"), F.concat_ws("-", F.substring_index(bare, "-", 1), F.when(F.length(serial) < 3, F.lpad(serial, 3, "0")).otherwise(serial))).otherwise(bare)


def forms(number: Column) -> Column:
    """The notations under which a number may be cited: padded, full year, two-digit year for 1960 to 1999."""

    def every(key: Column) -> Column:
        serial = F.lpad(key["serial"].cast("string"), 3, "0")
        short = F.when(key["year"].between(1960, 1999), F.concat_ws("-", F.lpad((key["year"] % 100).cast("string"), 2, "0"), serial))
        found = F.array(padded(number), F.when(key.isNotNull(), F.concat_ws("-", key["year"].cast("string"), serial)), short)
        return F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull())))

    return bound(official_key(number), every)


def address_reference(url: Column) -> Column:
    """struct(kind, number) that a document's address states, else null."""
    plain = F.rtrim(F.url_decode(F.regexp_replace(url, "%(?![0-9A-Fa-f]{2})", "%25")))
    kind = fold(F.regexp_replace(F.regexp_extract(plain, _ADDRESS, 1), "(?iu)s$", ""))
    number = F.regexp_replace(F.regexp_replace(F.regexp_extract(plain, _ADDRESS, 2), "\\s+", ""), "[–—_]", "-")
    return F.when(number != "", F.struct(kind.alias("kind"), number.alias("number")))


def plausible(number: Column, latest: int) -> Column:
    return F.coalesce(official_key(number)["year"].between(EARLIEST, latest), F.lit(False))


def claims(meta: DataFrame, latest: int = 2100) -> DataFrame:
    """(kind, number, document_id, strength, main): every form under which a document may be cited, from its
    ``number`` and ``type`` and from its ``source_url``. Witnesses that agree make a claim stronger; if they differ the
    plausible one holds, and if both are plausible none does."""
    rows = meta.withColumn("_a", address_reference(F.col("source_url")))
    witnesses = F.struct(F.col("number").alias("read"), F.col("_a.number").alias("listed"), same_number(F.col("number"), F.col("_a.number")).alias("agree"))

    def chosen(w: Column) -> Column:
        read, listed = w["read"], w["listed"]
        one = F.when(listed.isNull(), read).when(read.isNull() | w["agree"], listed)
        one = one.when(plausible(listed, latest) & ~plausible(read, latest), listed).when(plausible(read, latest) & ~plausible(listed, latest), read)
        every = F.when(w["agree"] & read.isNotNull(), F.array_union(forms(read), forms(listed)))
        return bound(one, lambda n: F.struct(n.alias("main"), F.coalesce(every, forms(n)).alias("every"), (w["agree"] & listed.isNotNull()).alias("sure")))

    from_address = F.coalesce(F.col("_a.kind").isin(*KINDS), F.lit(False))
    kind = F.when(from_address, F.col("_a.kind")).otherwise(F.nullif(F.col("type"), F.lit("inconnu")))
    found = rows.select("document_id", kind.alias("kind"), from_address.cast("int").alias("_f"), bound(witnesses, chosen).alias("_c"))
    strength = F.col("_f") + F.coalesce(F.col("_c.sure"), F.lit(False)).cast("int")
    out = found.select("document_id", "kind", strength.alias("strength"), F.col("_c.main").alias("_m"), F.explode_outer("_c.every").alias("number"))
    return out.filter("kind is not null and number is not null").select("kind", "number", "document_id", "strength", (F.col("number") == padded(F.col("_m"))).alias("main"))


def common_root(document_id: Column) -> Column:
    """An id without bis, ter, quater and with year and serial in full, so that editions of one act agree."""
    bare = F.regexp_replace(document_id, "(?iu)_(?:bis|ter|quater)[0-9]*$", "")
    pattern = "^([a-z]+)_([0-9]{2,4})_([0-9]{1,7})$"
    year, serial = F.regexp_extract(bare, pattern, 2), F.regexp_extract(bare, pattern, 3).try_cast("int")
    full = F.when(F.length(year) == 2, F.concat(F.lit("19"), year)).otherwise(year)
    return F.when(bare.rlike(pattern), F.concat_ws("_", F.regexp_extract(bare, pattern, 1), full, serial.cast("string"))).otherwise(bare)


def preamble(text: Column, most: int = 12) -> Column:
    """The lines before the first citation, or the first ``most`` where there is none."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    flags = F.transform(lines, lambda x: x.rlike(CITATION_LINE))
    first = F.array_position(flags, True)
    return F.when(first > 0, F.slice(lines, 1, F.greatest(first - 1, F.lit(0)).cast("int"))).otherwise(F.slice(lines, 1, most))


def without_citations(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(CITATION_LINE)), "\n")


def tidy(title: Column) -> Column:
    """White space collapsed, no punctuation at the ends, sentence case if it shouts, at most 400 characters."""
    plain = F.regexp_replace(F.regexp_replace(title, "\\s+", " "), "^[ .;:—–-]+|[ .;:—–-]+$", "")
    letters = F.length(F.regexp_replace(plain, "[^\\p{L}]+", ""))
    shouted = F.length(F.regexp_replace(plain, "[^\\p{Lu}]+", "")) > 0.85 * letters
    return F.substring(F.when((letters > 0) & shouted, F.concat(F.upper(F.substring(plain, 1, 1)), F.lower(F.substring(plain, F.lit(2), F.length(plain))))).otherwise(plain), 1, 400)


def title(text: Column) -> Column:
    """struct(value, confidence): the line that says what the act is about (0.85), else the first line of
    substance (0.40); citations and everything from the first article on are passed over."""
    lines = F.slice(F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != ""), 1, 25)
    stop = F.array_position(F.transform(lines, lambda x: x.rlike(ARTICLE_LINE)), True)
    head = F.when(stop > 0, F.slice(lines, 1, F.greatest(stop - 1, F.lit(0)).cast("int"))).otherwise(lines)
    about = F.get(F.filter(head, lambda x: x.rlike(OBJECT) & ~x.rlike(CITATION_LINE)), 0)
    first = F.get(F.filter(F.slice(lines, 1, 12), lambda x: (F.length(x) >= 12) & ~x.rlike("^[0-9]+$")), 0)
    made = lambda v, c: F.when(v.isNotNull(), F.struct(tidy(v).alias("value"), F.lit(c).alias("confidence")))
    return F.coalesce(made(about, 0.85), made(first, 0.40))


def rejoined_headers(text: Column) -> Column:
    """Article headings that a scanner spread over lines, put on one line: the word, then a number, then a colon."""
    word, number = "(?im)^([ \\t]*(?:article|art\\.?))[ \\t]*\\n\\s*", "([0-9]{1,4}\\b|[IVXLC]{1,7}\\b|premier\\b|1[ \\t]*er\\b)"
    joined = F.regexp_replace(text, word + number, "$1 $2")
    return F.regexp_replace(joined, "(?im)^([ \\t]*(?:article|art\\.?)[ \\t]+" + number + ")[ \\t]*\\n\\s*:", "$1:")


def repaired_keywords(text: Column) -> Column:
    """Heading words read with confused letters (Arlicle, ArtIcIe, CHAPLTRE ...) put right before a number; digits
    between digits likewise. The patterns are built from the letters' confusions, not listed."""
    confused = {"t": "tlf1Ii", "i": "il1I|tj", "l": "l1I|t", "c": "ceo(", "e": "ec3", "r": "rnt", "a": "ao", "p": "p", "h": "hb", "s": "s5", "o": "o0c", "n": "nm", "A": "A4", "x": "x"}
    for keyword in ("Article", "Chapitre", "Section", "Titre", "Annexe"):
        for form in (keyword, keyword.upper()):
            letters = [confused.get(c, c) if c.islower() else confused.get(c.lower(), c).upper() + ("l" if c in "ILT" else "") for c in form[1:]]
            classes = form[0] + "".join(f"[{''.join(sorted(set(x) | {c}))}]".replace("|", "\\|") for x, c in zip(letters, form[1:]))
            text = F.regexp_replace(text, f"(?m)(?<![\\p{{L}}\\p{{N}}]){classes}(?=\\s*[0-9IVX]|\\s+premier)", form)
    text = F.regexp_replace(text, "(?<=[0-9])[OoQ](?=[0-9])", "0")
    return F.regexp_replace(text, "(?<=[0-9])[lI|](?=[0-9])", "1")
