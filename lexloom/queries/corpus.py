"""Text measures, cleaning, near duplicates, chunks, routes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.functions import text as T
from lexloom.operators import chunks, dedup, lines
from lexloom.queries.catalogue import query
from lexloom.queries.relational import HASH_FORM

_WORDS = " + ".join(f"(case when contains(' ' || lower(text) || ' ', ' {w} ') then 1 else 0 end)" for w in T.COMMON_WORDS)
_VISIBLE = "length(regexp_replace(text, '\\s', '', 'g'))"
_ALPHA = f"(case when {_VISIBLE} > 0 then (length(text) - length(regexp_replace(text, '\\pL', '', 'g'))) / {_VISIBLE} else 0.0 end)"
_SUSPECT = f"(case when length(text) > 0 then (length(text) - length(regexp_replace(text, '[{T.SUSPECT}]|[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x{{9f}}]', '', 'g'))) / length(text) else 0.0 end)"


@query("documents", sql=f"""
select lang, count(*) as n, round(avg({_ALPHA}), 6) as alpha, round(avg({_SUSPECT}), 6) as suspect
from documents where text is not null group by lang""")
def text_measures(documents: DataFrame) -> DataFrame:
    text = F.col("text")
    rows = documents.filter("text is not null").select("lang", T.alpha_ratio(text).alias("alpha"), T.suspect_ratio(text).alias("suspect"))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("alpha"), 6).alias("alpha"), F.round(F.avg("suspect"), 6).alias("suspect"))


_FRAGMENT = "(?:^|[^\\pL\\pN_])((?:[\\pL\\pN_] ){4,})"
def exact_round(value: str, digits: int = 4) -> str:
    """Rounding of a double by its shortest decimal form, as Spark does it; the checking engine multiplies instead."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(38, 20)), {digits}) as double)"


_READABLE = f"greatest(0.0, 0.5 * {_ALPHA} + 0.4 * least(1.0, ({_WORDS}) / 8.0) - 0.3 * least(1.0, len(regexp_extract_all(text, '{_FRAGMENT}')) * 20.0 / greatest(length(regexp_replace(text, '\\s*\\S+\\s*', 'x', 'g')), 1)) + 0.1)"
_QUALITY = "greatest(0.0, least(1.0, case when c is not null then 0.5 * (readability - least(0.4, suspect * 10)) + 0.5 * c else readability - least(0.4, suspect * 10) end))"
#: Readability and quality of the rows of quality_rows(..., text, c), c being the recogniser's confidence.
QUALITY_SQL = f"""
readable as (select *, case when length(trim(text)) > 0 then {exact_round(_READABLE)} else 0.0 end as readability, {_SUSPECT} as suspect from quality_rows),
judged_rows as (select *, case when length(trim(text)) > 0 then {exact_round(_QUALITY)} else 0.0 end as quality from readable)
"""
CONFIDENCE = "case when ocr_confidence > 1 then ocr_confidence / 100 else ocr_confidence end"


@query("pages", sql=f"with quality_rows as (select document_id, page, coalesce(text, '') as text, {CONFIDENCE} as c from pages), {QUALITY_SQL} select document_id, page, quality, readability from judged_rows")
def page_quality(pages: DataFrame) -> DataFrame:
    """Readability, suspect signs and the recogniser's confidence."""
    confidence = F.when(F.col("ocr_confidence") > 1, F.col("ocr_confidence") / 100).otherwise(F.col("ocr_confidence"))
    text = F.coalesce("text", F.lit(""))
    return pages.select("document_id", "page", T.page_quality(text, confidence).alias("quality"), T.readability(text).alias("readability"))


@query("pages", sql=f"""
with p as (select document_id, page, coalesce(text, '') as text from pages),
m as (select document_id, length(trim(text, chr(32) || chr(9) || chr(10) || chr(13))) as chars, {_ALPHA} as alpha from p),
a as (select document_id, count(*) as pages, sum(chars) as chars, avg(case when chars >= 100 then 1.0 else 0.0 end) as rich, avg(case when chars >= 20 then alpha end) as alpha from m group by document_id)
select document_id, pages, chars, round(rich, 4) as rich, round(coalesce(alpha, 0.0), 4) as alpha,
  chars = 0 or rich < 0.5 or (alpha is not null and alpha < 0.6) as ocr_required from a""")
def extraction_route(pages: DataFrame) -> DataFrame:
    """Whether a document's own text is too thin or too odd to be used."""
    text = F.coalesce("text", F.lit(""))
    chars = F.length(F.regexp_replace(text, "^[ \\t\\n\\r]+|[ \\t\\n\\r]+$", ""))
    m = pages.select("document_id", chars.alias("chars"), T.alpha_ratio(text).alias("alpha"))
    a = m.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("chars").alias("chars"),
        F.avg(F.when(F.col("chars") >= 100, 1.0).otherwise(0.0)).alias("rich"), F.avg(F.when(F.col("chars") >= 20, F.col("alpha"))).alias("alpha"),
    )
    needed = (F.col("chars") == 0) | (F.col("rich") < 0.5) | (F.col("alpha").isNotNull() & (F.col("alpha") < 0.6))
    return a.select("document_id", "pages", "chars", F.round("rich", 4).alias("rich"), F.round(F.coalesce("alpha", F.lit(0.0)), 4).alias("alpha"), needed.alias("ocr_required"))


@query("documents", sql="""
select doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), ' *\\n *', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\n+|\\n+$', '', 'g')) as text
from documents where text is not null""")
def whitespace_collapsed(documents: DataFrame) -> DataFrame:
    return documents.filter("text is not null").select("doc_id", T.collapse_whitespace(F.col("text")).alias("text"))


@query("pages", sql="""
select distinct document_id, page, length(raw_text) - length(regexp_replace(raw_text, '[\\x00-\\x08\\x0b-\\x1f\\x7f-\\x{9f}]|\\p{Cf}', '', 'g')) as removed from pages where raw_text is not null""")
def control_characters(pages: DataFrame) -> DataFrame:
    return pages.filter("raw_text is not null").select("document_id", "page", T.controls_removed(F.col("raw_text")).alias("removed")).distinct()


@query("documents", sql="select doc_id, nfc_normalize(text) as text from documents where text is not null")
def composed_text(documents: DataFrame) -> DataFrame:
    return documents.filter("text is not null").select("doc_id", T.composed(F.col("text")).alias("text"))


@query("documents")
def stated_hash_agrees(documents: DataFrame) -> DataFrame:
    """Documents whose text_hash is that of their text, in NFKC and case folded (which SQL lacks)."""
    from lexloom.operators.metadata import normal_hash

    own = F.sha2(T.exact_hash_form(F.col("text")), 256)
    rows = documents.filter("text_hash is not null").select("doc_id", (own == normal_hash(F.col("text_hash"))).alias("agrees"))
    return rows


def _plain_re(pattern: str) -> str:
    """The veto pattern for an engine without look-around: a sign on either side stands for it, as only a match matters."""
    word, digit = "[\\p{L}\\p{N}_]", "\\d"
    for c, none in ((word, "[^\\pL\\pN_]"), (digit, "[^0-9]"), ("\\p{L}", "[^\\pL]")):
        pattern = pattern.replace(f"(?<!{c})", f"(?:^|{none})").replace(f"(?!{c})", f"(?:$|{none})")
    return pattern.replace("(?iU)", "(?i)").replace("'", "''")


_PROTECTED = f"regexp_matches(line, '{_plain_re(T.protected_pattern())}')"
_CANONICAL = "trim(regexp_replace(regexp_replace(translate(regexp_replace(lower(line), '[\\x{300}-\\x{36f}]', '', 'g'), 'àâäáãçéèêëíìîïñóòôöõúùûüýÿœæ', 'aaaaaceeeeiiiinooooouuuuyyoa'), '[0-9]+', '#', 'g'), '[^a-z#]+', ' ', 'g'))"


@query("pages", sql=f"""
with t as (select distinct document_id, page, raw_text from pages where raw_text is not null),
l as (select document_id, page, len(string_split(raw_text, chr(10))) as lines, unnest(string_split(raw_text, chr(10))) as raw, generate_subscripts(string_split(raw_text, chr(10)), 1) - 1 as i from t),
z as (select *, trim(raw) as line, greatest(1, least(3, cast(floor(lines / 2) as int))) as depth from l),
s as (select document_id, page, line, unnest(list_filter([case when i < depth then 'top' end, case when i >= lines - depth then 'bottom' end], lambda x: x is not null)) as side from z),
c as (select document_id, page, side, {_CANONICAL} as canonical from s where length(line) >= 4 and not {_PROTECTED}),
n as (select document_id, count(distinct page) as n from t group by document_id),
k as (select document_id, side, canonical, count(distinct page) as pages from c where canonical <> '' group by all)
select document_id, side, canonical, pages from k join n using (document_id) where n >= 3 and pages >= greatest(3, cast(floor(n * 0.55) as int))""")
def repeated_heads_and_feet(pages: DataFrame) -> DataFrame:
    """Lines repeated at the head or foot of a document's pages."""
    return lines.repeated_zone_lines(pages.filter("raw_text is not null").select("document_id", "page", "raw_text").distinct(), "raw_text")


_FROM, _TO = T.SPACE_VARIANTS + "".join(T.QUOTES), (" " * len(T.SPACE_VARIANTS) + "".join(T.QUOTES.values())).replace("'", "''")
_JOIN = "regexp_replace({}, '([\\pL_])[-­]\\s*\\n\\s*([\\p{{Ll}}\\p{{Lt}}\\p{{Lm}}\\p{{Lo}}_])', '\\1\\2', 'g')"
_DASHED = f"regexp_replace({{}}, '([0-9])\\s*[{T.DASHES}_]\\s*([0-9])', '\\1-\\2', 'g')"
_WRAPPED = "regexp_replace({}, '([^.;:!?»\"'')\\]\\s])[ \\t]*\\n[ \\t]*(\\p{{Ll}})', '\\1 \\2', 'g')"
_COLLAPSED = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '[ \\t]+', ' ', 'g'), ' *\\n *', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\n+|\\n+$', '', 'g'))"
_BARE = "regexp_replace(lower(trim(regexp_replace(trim(line), '^(?:[-–—]|[\\[(])\\s*|\\s*(?:[-–—]|[\\])])$', '', 'g'))), '^page\\s*|\\s*(?:/|sur)\\s*[0-9]{1,4}$', '', 'g')"
#: Cleaned rows: done(document_id, page, raw_text, text, removed).
_CLEANED = f"""
with r as (select distinct document_id, page, raw_text from pages where raw_text is not null),
s as (select *, translate(regexp_replace(regexp_replace(raw_text, '\\r\\n?', chr(10), 'g'), '[\\x00-\\x08\\x0b-\\x1f\\x7f-\\x{{9f}}]|\\p{{Cf}}', '', 'g'), '{_FROM}', '{_TO}') as t0 from r),
t as (select document_id, page, raw_text, {_JOIN.format(_JOIN.format(_DASHED.format(_DASHED.format("t0"))))} as t from s),
l as (select document_id, page, raw_text, len(string_split(t, chr(10))) as lines, unnest(string_split(t, chr(10))) as raw, generate_subscripts(string_split(t, chr(10)), 1) - 1 as i from t),
z0 as (select *, trim(raw) as line, greatest(1, least(3, cast(floor(lines / 2) as int))) as depth from l),
z as (select *, {_CANONICAL} as canonical, {_PROTECTED} as protected, i < depth as head, i >= lines - depth as foot from z0),
k as (select document_id, side, canonical, count(distinct page) as n from (select document_id, page, canonical, unnest(list_filter([case when head then 'top' end, case when foot then 'bottom' end], lambda x: x is not null)) as side
  from z where length(line) >= 4 and not protected and canonical <> '') group by all),
d as (select document_id, count(distinct page) as n from t group by document_id),
again as (select document_id, side, canonical from k join d using (document_id) where d.n >= 3 and k.n >= greatest(3, cast(floor(d.n * 0.55) as int))),
m as (select z.*, z.head and exists (select 1 from again x where x.document_id = z.document_id and x.side = 'top' and x.canonical = z.canonical)
    or z.foot and exists (select 1 from again x where x.document_id = z.document_id and x.side = 'bottom' and x.canonical = z.canonical) as furniture,
  (head or foot) and length(line) <= 20 and not protected and (regexp_matches({_BARE}, '^[0-9]{{1,4}}$') or regexp_matches({_BARE}, '^[ivxlcdm]{{1,7}}$')) as number, regexp_matches(line, '{T.DECORATION}') as decoration from z),
w as (select *, line = '' or protected or not (furniture or number or decoration) as keep from m),
j as (select document_id, page, raw_text, coalesce(string_agg(case when keep then raw end, chr(10) order by i), '') as flowed, sum(case when keep then 0 else 1 end) as removed from w group by document_id, page, raw_text),
done as (select document_id, page, raw_text, {_COLLAPSED.format(_WRAPPED.format(_WRAPPED.format("flowed")))} as text, removed from j)
"""


@query("pages", sql=_CLEANED + "select document_id, page, text, removed from done")
def cleaned_pages(pages: DataFrame) -> DataFrame:
    rows = pages.filter("raw_text is not null").select("document_id", "page", "raw_text").distinct()
    return lines.clean_pages(rows, "raw_text")


@query("pages", sql="""
with p as (select distinct document_id, page, coalesce(text, '') as text from pages where page is not null)
select document_id, string_agg(text, chr(10) order by page, text) as text from p group by document_id""")
def text_of_pages(pages: DataFrame) -> DataFrame:
    return lines.document_text(pages.filter("page is not null").select("document_id", "page", F.coalesce("text", F.lit("")).alias("text")).distinct())


@query("documents", sql="""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no from documents where text is not null)
select doc_id, line_no, sum(length(line) + 1) over (partition by doc_id order by line_no) - length(line) - 1 as begin from l""")
def line_offsets(documents: DataFrame) -> DataFrame:
    rows = documents.filter("text is not null").select(F.col("doc_id").alias("document_id"), F.lit(1).alias("page"), "text")
    return lines.with_offsets(rows, "text").select(F.col("document_id").alias("doc_id"), "line_no", "begin")


_SETS = f"""
with w as (select doc_id, regexp_extract_all({HASH_FORM}, '[\\pL\\pM\\pN_\\p{{Pc}}\\x{{200c}}\\x{{200d}}]+') as w from documents where text is not null),
s as (select doc_id, list_distinct(case when len(w) >= 5 then [array_to_string(w[i:i+4], ' ') for i in range(1, len(w) - 3)] when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
k as (select doc_id, list_sort(s) as s from s where len(s) > 0),
c as (select doc_id, s, min(doc_id) over (partition by s) as class_id from k),
r as (select doc_id, len(s) as n, unnest(s) as x from c where doc_id = class_id),
p as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as common from r a join r b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2)
"""


@query("documents", sql=_SETS + """,
l as (select a, count(*) as links from p where common >= 0.8 * (na + nb - common) - 1e-9 group by a)
select c.doc_id, c.class_id, coalesce(l.links, 0) as links from c left join l on c.class_id = l.a""")
def near_duplicates(documents: DataFrame) -> DataFrame:
    return dedup.near_links(documents, "doc_id", "text")


@query("documents", sql=_SETS + "select a as doc_id, b as part_of, common / na as containment from p where na < 0.9 * nb and common >= 0.9 * na - 1e-9")
def contained_texts(documents: DataFrame) -> DataFrame:
    return dedup.containment_links(documents, "doc_id", "text")


@query("documents", sql=f"""
with base as (select doc_id, text, {HASH_FORM} as form, regexp_replace(lower(trim(text_hash)), '^sha256:', '') as fh from documents),
ff as (select fh, min(doc_id) as first from base where fh <> '' group by fh),
file_links as (select b.doc_id, f.first as duplicate_of from base b join ff f using (fh) where b.doc_id <> f.first),
left1 as (select * from base where doc_id not in (select doc_id from file_links)),
tf as (select form, min(doc_id) as first from left1 where form <> '' group by form),
text_links as (select b.doc_id, f.first as duplicate_of from left1 b join tf f using (form) where b.doc_id <> f.first),
left2 as (select * from left1 where doc_id not in (select doc_id from text_links)),
""" + _SETS.split("with ", 1)[1].replace("from documents where text is not null", "from left2 where text is not null").replace("doc_id, regexp_extract_all(" + HASH_FORM, "doc_id, regexp_extract_all(form") + """,
near as (select greatest(a, b) as doc_id, least(a, b) as duplicate_of, common / (na + nb - common) as similarity from p where a < b and common >= 0.9 * (na + nb - common) - 1e-9),
part as (select a as doc_id, b as duplicate_of, common / na as similarity from p where na < 0.9 * nb and common >= 0.9 * na - 1e-9 and a not in (select doc_id from near))
select doc_id, duplicate_of, 'file_hash' as kind, 1.0 as similarity from file_links union all select doc_id, duplicate_of, 'text_hash', 1.0 from text_links
union all select doc_id, duplicate_of, 'similarity', round(similarity, 6) from near union all select doc_id, duplicate_of, 'partial', round(similarity, 6) from part""")
def duplicate_links(documents: DataFrame) -> DataFrame:
    """All four kinds of links in one pass; the stated text_hash plays the file's hash, the text itself is compared next."""
    from lexloom.operators.metadata import normal_hash

    found = dedup.find_duplicates(documents, "doc_id", normal_hash(F.col("text_hash")), T.hash_form(F.col("text")), "text")
    return found.withColumn("similarity", F.round("similarity", 6))


@query("documents", sql="""
with d as (select doc_id, text, greatest(1, cast(ceil((length(text) - 100) / 900.0) as int)) as n from documents where length(text) > 0),
c as (select doc_id, text, unnest(range(0, n)) as position from d)
select doc_id, position, position * 900 as begin, substr(text, position * 900 + 1, 1000) as text from c""")
def fixed_chunks(documents: DataFrame) -> DataFrame:
    return chunks.fixed(documents, "doc_id", "text", 1000, 100)


@query("documents")
def sentence_chunks(documents: DataFrame) -> DataFrame:
    """Packed sentences; packing is sequential, so it is tested against a plain loop instead of SQL."""
    return chunks.chunked(documents, "doc_id", "text", 1000, 100)


@query("documents", sql="""
with d as (select doc_id, length(text) as n from documents where length(text) > 0)
select count(*) as documents, min(n) as least, max(n) as greatest, round(avg(n), 1) as average from d""")
def length_statistics(documents: DataFrame) -> DataFrame:
    rows = documents.filter(F.length("text") > 0).select(F.length("text").alias("n"))
    return rows.agg(F.count(F.lit(1)).alias("documents"), F.min("n").alias("least"), F.max("n").alias("greatest"), F.round(F.avg("n"), 1).alias("average"))


@query("pages", sql="""
select document_id, round(avg(case when ocr_confidence > 1 then ocr_confidence / 100 else ocr_confidence end), 6) as confidence, count(*) as pages, max(page) as last
from (select distinct document_id, page, ocr_confidence from pages) group by document_id""")
def mean_confidence(pages: DataFrame) -> DataFrame:
    rows = pages.select("document_id", "page", "ocr_confidence").distinct()
    c = F.when(F.col("ocr_confidence") > 1, F.col("ocr_confidence") / 100).otherwise(F.col("ocr_confidence"))
    return rows.groupBy("document_id").agg(F.round(F.avg(c), 6).alias("confidence"), F.count(F.lit(1)).alias("pages"), F.max("page").alias("last"))


@query("pages", sql="""
with n as (select distinct document_id, page, text from pages), o as (select distinct document_id, page, raw_text from pages where page is not null)
select n.document_id, n.page, case when length(trim(coalesce(o.raw_text, ''))) > length(trim(coalesce(n.text, ''))) then o.raw_text else n.text end as text,
       case when length(trim(coalesce(o.raw_text, ''))) > length(trim(coalesce(n.text, ''))) then 'ocr' else 'native' end as method
from n left join o on n.document_id = o.document_id and n.page = o.page""")
def hybrid_pages(pages: DataFrame) -> DataFrame:
    from lexloom.sources.files import hybrid

    native = pages.select("document_id", "page", "text").distinct()
    return hybrid(native, pages.filter("page is not null").select("document_id", "page", F.col("raw_text").alias("text")).distinct())


@query("pages", sql=_CLEANED + """,
per as (select document_id, count(*) as pages, sum(length(raw_text)) as chars_before, sum(length(text)) as chars_after, sum(removed) as removed_lines, sum(case when length(raw_text) > 0 and length(text) = 0 then 1 else 0 end) as emptied from done group by document_id),
x as (select *, case when chars_before > 0 then greatest(0.0, 1 - chars_after / chars_before) else 0.0 end as share from per)
select document_id, pages, chars_before, chars_after, removed_lines, emptied, """ + exact_round("share") + """ as ratio, case when share > 0.25 then 'much removed' when emptied > 0 then 'page emptied' end as warning from x""")
def cleaning_report(pages: DataFrame) -> DataFrame:
    rows = pages.filter("raw_text is not null").select("document_id", "page", "raw_text").distinct()
    return lines.cleaning_report(rows, lines.clean_pages(rows, "raw_text"), "raw_text")


@query("documents")
def repaired_typing(documents: DataFrame) -> DataFrame:
    """Reading-model marks and typed ones in dates put right; look-arounds have no counterpart in DuckDB."""
    return documents.filter("text is not null").select("doc_id", T.typewriter_ones(T.without_reader_marks(F.col("text"))).alias("text"))
