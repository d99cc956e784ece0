"""Issues, scores, references, selections, exports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window, functions as F

from lexloom.functions import text as T
from lexloom.operators import metadata as M, quality as Q, references as R, structure as S
from lexloom.queries.catalogue import SQL, query
from lexloom.queries.corpus import _ALPHA, _FRAGMENT, CONFIDENCE, QUALITY_SQL, exact_round
from lexloom.queries.relational import HASH_FORM
from lexloom.queries.structure import _ARTICLES_SQL, _WHOLE_TEXTS, CITATION, _lines_sql
from lexloom.sources import sinks


FOREIGN_RE2 = re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", Q.FOREIGN)


@query("documents", "pages", sql=f"""
with k as (select distinct document_id, page, coalesce(text, '') as text from pages),
p as (select document_id, count(*) as pages, sum(case when trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' then 1 else 0 end) as empty,
  sum(length(text) - length(regexp_replace(text, '[{T.SUSPECT}]|[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x{{9f}}]', '', 'g'))) as suspect, sum(length(text)) as chars from k group by document_id),
j as (select d.document_id, d.page_count, p.* exclude (document_id) from documents d left join p using (document_id))
select document_id, 'no_pages' as code, 'error' as severity, 1 as n from j where pages is null
union all select document_id, 'empty_pages', case when empty / pages > 0.1 then 'error' else 'warning' end, empty from j where empty > 0
union all select document_id, 'suspect_signs', 'warning', suspect from j where suspect > 0.02 * chars
union all select document_id, 'missing_pages', 'error', page_count - pages from j where page_count > pages""")
def page_issues(documents: DataFrame, pages: DataFrame) -> DataFrame:
    found = Q.page_issues(documents, pages)
    return found.filter("code in ('no_pages', 'empty_pages', 'suspect_signs', 'missing_pages')").select("document_id", "code", "severity", "n")


def _words(words: tuple[str, ...]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


_ISSUES_SQL = f"""
k as (select distinct document_id, page, coalesce(text, '') as text from pages),
again0 as (select document_id, page, {HASH_FORM} as h from k),
first as (select document_id, h, min(page) as page from again0 where length(h) >= 200 group by document_id, h),
again as (select a.document_id, count(*) as n from again0 a join first f on a.document_id = f.document_id and a.h = f.h and a.page > f.page group by a.document_id),
fragments as (select document_id, min(page) as page from k where regexp_matches(text, '{_FRAGMENT}') group by document_id),
english as (select document_id, page, text, list_transform(string_split(lower(text), chr(10)), lambda l: regexp_extract_all(l, '[a-z'']+')) as ws from k),
why as (select document_id, page from english where regexp_matches(text, '{FOREIGN_RE2}')
  or len(list_filter(ws, lambda w: len(list_filter(w, lambda x: x in {_words(Q.ENGLISH)})) >= 3 and len(list_filter(w, lambda x: x in {_words(Q.ENGLISH)})) > 2 * len(list_filter(w, lambda x: x in {_words(Q.FRENCH)})))) > 0),
text_issues as (select document_id, 'repeated_pages' as code, 'warning' as severity, cast(null as int) as page, n from again
  union all select document_id, 'fragments', 'warning', page, 1 from fragments
  union all select document_id, 'invented', 'warning', page, 1 from why)
"""


@query("documents", "pages", sql="with " + _ISSUES_SQL + "select * from text_issues where document_id in (select document_id from documents) or code in ('repeated_pages', 'invented')")
def text_issues(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Repeated pages, loose letters and invented readings; the SQL leaves out loops, which need back references and which no
    page of the test corpora has."""
    return Q.page_issues(documents, pages).filter("code in ('repeated_pages', 'fragments', 'invented')")


def _scores(documents: DataFrame, pages: DataFrame, meta: DataFrame) -> DataFrame:
    confidence = F.when(F.col("ocr_confidence") > 1, F.col("ocr_confidence") / 100).otherwise(F.col("ocr_confidence"))
    rows = pages.select("document_id", "page", F.coalesce("text", F.lit("")).alias("text"), confidence.alias("c")).distinct()
    # Added as decimals, so that the mean doesn't depend on the order of the pages.
    quality = T.page_quality(F.col("text"), F.col("c")).cast("decimal(10,4)")
    text = rows.groupBy("document_id").agg(F.round(F.sum(quality).cast("double") / F.count(F.lit(1)), 4).alias("text_quality"))
    texts = documents.filter("text is not null").select("document_id", F.lit(1).alias("page"), F.regexp_replace("text", "\\r\\n?", "\n").alias("text"))
    articles = S.articles(texts)
    gaps = S.numbering_gaps(articles, ["document_id"], "position", "value")
    fields = M.completeness(meta).select("document_id", "completeness")
    return Q.final_scores(text, Q.structure_scores(articles, gaps), fields, Q.page_issues(documents, pages))


_SCORES_SQL = (
    _lines_sql(_WHOLE_TEXTS) + _ARTICLES_SQL + f""",
y as (select document_id, value, lag(value) over (partition by document_id order by position) as before from found where value is not null),
gaps as (select document_id, count(*) as gaps from y where value - before <= 0 or (value - before > 1 and value - before = floor(value - before)) group by document_id),
per as (select document_id, avg(case when length(text) < 20 then 1.0 else 0.0 end) as short, avg(case when length(text) > 40000 then 1.0 else 0.0 end) as long, avg(case when value is null then 1.0 else 0.0 end) as unread from found group by document_id),
structure_scores as (select document_id, {exact_round("greatest(0.0, 1.0 - least(0.35, coalesce(gaps, 0) * 0.08) - least(0.2, short * 0.5) - least(0.15, long) - least(0.15, unread * 0.5))")} as structure from per left join gaps using (document_id)),
quality_rows as (select distinct document_id, page, coalesce(text, '') as text, {CONFIDENCE} as c from pages), {QUALITY_SQL},
tq as (select document_id, {exact_round('cast(sum(cast(quality as decimal(10, 4))) as double) / count(*)')} as text_quality from judged_rows group by document_id),
comp as ({SQL["completeness"]}),
{_ISSUES_SQL},
page_found as ({SQL["page_issues"]}),
issues as (select document_id, severity from text_issues union all select document_id, severity from page_found),
per_issue as (select document_id, sum(case when severity = 'error' then 1 else 0 end) as errors, sum(case when severity = 'warning' then 1 else 0 end) as warnings from issues group by document_id),
j as (select tq.document_id, 0.5 * coalesce(text_quality, 0) + 0.35 * coalesce(structure, 0) + 0.15 * coalesce(completeness, 0) as score0, coalesce(errors, 0) as errors, coalesce(warnings, 0) as warnings
  from tq left join structure_scores using (document_id) left join comp using (document_id) left join per_issue using (document_id)),
scores as (select document_id, {exact_round("greatest(0.0, least(1.0, case when errors > 0 then least(score0, 0.49) else score0 end))")} as score, errors, warnings from j),
judged as (select *, case when score < 0.5 or errors > 0 then 'failed' when score < 0.9 then 'review' else 'ok' end as status from scores)
""")


@query("documents", "pages", "metadata", sql=_SCORES_SQL + "select document_id, score, status, errors, warnings from judged")
def document_scores(documents: DataFrame, pages: DataFrame, meta: DataFrame) -> DataFrame:
    return _scores(documents, pages, meta)


@query("documents", "pages", "metadata", sql=_SCORES_SQL + "select document_id, score, status, errors, warnings from judged where status <> 'ok'")
def review_queue(documents: DataFrame, pages: DataFrame, meta: DataFrame) -> DataFrame:
    return Q.review_queue(_scores(documents, pages, meta))


@query("documents", "pages", "metadata", sql=_SCORES_SQL + """
select count(*) as documents, round(sum(score) / count(*), 4) as average, min(score) as least, max(score) as greatest, sum(case when status = 'failed' then 1 else 0 end) as failed, sum(case when status = 'ok' then 1 else 0 end) as ok,
  sum(case when status = 'review' then 1 else 0 end) as review from judged""")
def quality_report(documents: DataFrame, pages: DataFrame, meta: DataFrame) -> DataFrame:
    report = sinks.quality_report(_scores(documents, pages, meta), "score", "status")
    of = lambda status: F.coalesce(F.try_element_at("by_status", F.lit(status)), F.lit(0)).alias(status)
    return report.select("documents", "average", "least", "greatest", of("failed"), of("ok"), of("review"))


@query("pages", sql=f"""
with p as (select document_id, coalesce(text, '') as text from pages),
m as (select document_id, length(trim(text, chr(32) || chr(9) || chr(10) || chr(13))) as chars, {_ALPHA} as alpha from p),
a as (select document_id, sum(chars) as chars, avg(case when chars >= 100 then 1.0 else 0.0 end) as rich, coalesce(avg(case when chars >= 20 then alpha end), 0.0) as alpha from m group by document_id),
r as (select *, chars = 0 or rich < 0.5 or (alpha > 0 and alpha < 0.6) as needed, 0.6 + 0.38 * least(1.0, abs(rich - 0.5) / 0.5, case when alpha > 0 then abs(alpha - 0.6) / 0.6 else 1.0 end) as base from a)
select document_id, needed, case when chars = 0 then 0.98 else round(least(case when not needed and rich >= 0.95 and alpha >= 0.7 then greatest(base, 0.95) else base end, 0.99), 4) end as confidence from r""")
def route_confidence(pages: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    chars = F.length(F.regexp_replace(text, "^[ \\t\\n\\r]+|[ \\t\\n\\r]+$", ""))
    m = pages.select("document_id", chars.alias("chars"), T.alpha_ratio(text).alias("alpha"))
    a = m.groupBy("document_id").agg(
        F.sum("chars").alias("chars"), F.avg(F.when(F.col("chars") >= 100, 1.0).otherwise(0.0)).alias("rich"), F.coalesce(F.avg(F.when(F.col("chars") >= 20, F.col("alpha"))), F.lit(0.0)).alias("alpha")
    )
    a = a.withColumn("needed", (F.col("chars") == 0) | (F.col("rich") < 0.5) | ((F.col("alpha") > 0) & (F.col("alpha") < 0.6)))
    return a.select("document_id", "needed", Q.route_confidence(F.col("chars"), F.col("rich"), F.col("alpha"), F.col("needed")).alias("confidence"))


@query("pages", sql="""
with r as (select document_id, page, row_number() over (partition by document_id order by page) - 1 as i, count(*) over (partition by document_id) as n from (select distinct document_id, page from pages where page is not null)),
c as (select document_id, n, unnest(list_distinct([cast(floor(k * n / 5.0) as int) for k in range(0, 5)])) as i from (select distinct document_id, n from r) where n > 5)
select r.document_id, r.page from r left join c on r.document_id = c.document_id and r.i = c.i where r.n <= 5 or c.i is not null""")
def sampled_pages(pages: DataFrame) -> DataFrame:
    return Q.sampled_pages(pages.filter("page is not null").select("document_id", "page").distinct(), 5)


@query("pages", sql="select distinct document_id, page from pages where page in (1, 3, 5, 6, 7, 8)")
def selected_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.array_contains(Q.page_selection("1,3,5-8"), F.col("page"))).select("document_id", "page").distinct()


@query("metadata", sql="""
with m as (select document_id, type, number, regexp_extract(rtrim(coalesce(source_url, '')), '(?i)/(?:doc/)?([a-z]+)[-_/](?:n-)?([0-9]{2,4}\\s*[-–—_]\\s*[0-9]{1,4}(?:[-_](?:bis|ter|quater)[0-9]*)?)/?$', 2) as address from metadata),
b as (select document_id, type, regexp_replace(regexp_replace(number, '\\s+', '', 'g'), '[–—_]', '-', 'g') as n from m where address = '' and number is not null and type is not null and type <> 'inconnu'),
k as (select *, regexp_extract(n, '^([0-9]{2,4})[-./]([0-9]{1,4})$', 1) as y, regexp_extract(n, '^([0-9]{2,4})[-./]([0-9]{1,4})$', 2) as s from b),
p as (select *, case when regexp_matches(n, '^[^-]+-[0-9]+$') then string_split(n, '-')[1] || '-' || case when length(string_split(n, '-')[-1]) < 3 then lpad(string_split(n, '-')[-1], 3, '0') else string_split(n, '-')[-1] end else n end as main,
  case when length(y) = 4 then cast(y as int) when length(y) = 2 and y >= '60' then 1900 + cast(y as int) end as year from k),
f as (select document_id, type as kind, main, list_distinct(list_filter([main, case when year is not null then year || '-' || case when length(s) < 3 then lpad(s, 3, '0') else s end end,
  case when year between 1960 and 1999 then substr(cast(year as varchar), 3) || '-' || case when length(s) < 3 then lpad(s, 3, '0') else s end end], lambda x: x is not null)) as every from p),
u as (select document_id, kind, main, unnest(every) as number from f)
select kind, number, document_id, 0 as strength, number = main as main from u""")
def reference_claims(meta: DataFrame) -> DataFrame:
    return R.claims(meta)


@query("documents", sql="""
with b as (select document_id, regexp_replace(document_id, '(?i)_(?:bis|ter|quater)[0-9]*$', '') as bare from documents),
m as (select document_id, bare, regexp_extract(bare, '^([a-z]+)_([0-9]{2,4})_([0-9]{1,7})$', ['k', 'y', 's']) as r from b)
select document_id, case when r.k <> '' then concat_ws('_', r.k, case when length(r.y) = 2 then '19' || r.y else r.y end, cast(cast(r.s as int) as varchar)) else bare end as root from m""".replace("cast(cast(r.s as int) as varchar)", "cast(try_cast(r.s as int) as varchar)"))
def common_roots(documents: DataFrame) -> DataFrame:
    return documents.select("document_id", R.common_root(F.col("document_id")).alias("root"))


@query("documents", sql="""
with l as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') as l from documents where text is not null),
f as (select doc_id, l, list_position(list_transform(l, lambda x: regexp_matches(x, '(?i)^\\s*(?:vu\\b|consid[ée]rant\\b|sur\\s+rapport\\b|apr[èe]s\\s+avis\\b)')), true) as i from l)
select doc_id, case when i is not null and i > 0 then l[1:i - 1] else l[1:12] end as lines from f""")
def preambles(documents: DataFrame) -> DataFrame:
    return documents.filter("text is not null").select("doc_id", R.preamble(F.col("text")).alias("lines"))


@query("documents", sql="""
select doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: not regexp_matches(x, '(?i)^\\s*(?:vu\\b|consid[ée]rant\\b|sur\\s+rapport\\b|apr[èe]s\\s+avis\\b)')), chr(10)) as text
from documents where text is not null""")
def texts_without_citations(documents: DataFrame) -> DataFrame:
    return documents.filter("text is not null").select("doc_id", R.without_citations(F.col("text")).alias("text"))


_TIDY = "regexp_replace(regexp_replace({}, '\\s+', ' ', 'g'), '^[ .;:—–-]+|[ .;:—–-]+$', '', 'g')"
_ABOUT = "(?i)(?:^|[^\\pL\\pN_])(?:portant|relatives?\\s+(?:aux?|[àa])|relatifs?\\s+(?:aux?|[àa])|fixant|instituant|modifiant|compl[ée]tant|abrogeant|cr[ée]ant|organisant|autorisant|approuvant|ratifiant)(?:$|[^\\pL\\pN_])"


@query("documents", sql=f"""
with l as (select document_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1:25] as l from documents where text is not null),
s as (select *, list_position(list_transform(l, lambda x: regexp_matches(x, '(?i)^\\s*(?:article|art\\.)\\s')), true) as stop from l),
h as (select document_id, l, case when stop > 0 then l[1:stop - 1] else l end as head from s),
c as (select document_id, list_filter(head, lambda x: regexp_matches(x, '{_ABOUT}') and not regexp_matches(x, '{CITATION}'))[1] as about,
  list_filter(l[1:12], lambda x: length(x) >= 12 and not regexp_matches(x, '^[0-9]+$'))[1] as first from h),
p as (select document_id, {_TIDY.format('coalesce(about, first)')} as t, case when about is not null then 0.85 when first is not null then 0.4 end as confidence from c),
n as (select *, length(t) - length(regexp_replace(t, '\\pL', '', 'g')) as letters, length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) as upper from p)
select document_id, substr(case when letters > 0 and upper > 0.85 * letters then upper(substr(t, 1, 1)) || lower(substr(t, 2)) else t end, 1, 400) as value, confidence from n""")
def titles(documents: DataFrame) -> DataFrame:
    rows = documents.filter("text is not null").select("document_id", R.title(F.col("text")).alias("t"))
    return rows.select("document_id", "t.value", "t.confidence")


@query("documents")
def repaired_headings(documents: DataFrame) -> DataFrame:
    return documents.filter("text is not null").select("doc_id", R.repaired_keywords(R.rejoined_headers(F.col("text"))).alias("text"))


@query("sources", sql="""
select extension, category, count(*) as files, count(distinct file_hash) as contents, sum(size_bytes) as bytes, sum(case when error is not null then 1 else 0 end) as errors
from (select distinct * from sources) group by grouping sets ((extension, category), (extension), ())""")
def inventory_statistics(sources: DataFrame) -> DataFrame:
    rows = sources.distinct()
    measures = [F.count(F.lit(1)).alias("files"), F.countDistinct("file_hash").alias("contents"), F.sum("size_bytes").alias("bytes"), F.sum(F.col("error").isNotNull().cast("int")).alias("errors")]
    return rows.rollup("extension", "category").agg(*measures)


@query("sources", sql="select distinct document_id, source_path from sources where error is null or raw_path is not null")
def usable_sources(sources: DataFrame) -> DataFrame:
    from lexloom.sources.files import usable

    return usable(sources).select("document_id", "source_path").distinct()


@query("documents", "metadata", "sources", sql="""
with s as (select document_id, min(source_path) as path from sources group by document_id)
select d.document_id, m.title, m.type, s.path from documents d join metadata m using (document_id) left join s using (document_id)
where m.status is not null order by d.document_id limit 50 offset 10""")
def catalogue_page(documents: DataFrame, meta: DataFrame, sources: DataFrame) -> DataFrame:
    """A page of the catalogue: the limit is the feature."""
    paths = sources.groupBy("document_id").agg(F.min("source_path").alias("path"))
    joined = documents.select("document_id").join(meta.filter("status is not null").select("document_id", "title", "type"), "document_id").join(paths, "document_id", "left")
    return joined.orderBy("document_id").offset(10).limit(50).select("document_id", "title", "type", "path")


@query("documents", "sources", sql="""
select document_id, source from documents where document_id in (select document_id from sources where error is null and file_hash is not null and trim(file_hash) <> '')""")
def manifest(documents: DataFrame, sources: DataFrame) -> DataFrame:
    good = sources.filter("error is null").select("document_id", M.normal_hash(F.col("file_hash")).alias("h")).filter("h is not null").select("document_id")
    return documents.select("document_id", "source").join(good, "document_id", "left_semi")


@query("documents", "structure", sql="""
with s as (select document_id, list(distinct struct_pack(char_start := char_start, node_id := node_id)) as l from structure group by document_id)
select d.document_id, coalesce(len(s.l), 0) as units, list_min(list_transform(s.l, lambda x: x.node_id)) as first from documents d left join s using (document_id)""")
def nested_documents(documents: DataFrame, structure: DataFrame) -> DataFrame:
    nested = sinks.nested(documents.select("document_id"), units=structure.select("document_id", "char_start", "node_id").distinct())
    return nested.select("document_id", F.size("units").alias("units"), F.array_min(F.transform("units", lambda u: u["node_id"])).alias("first"))


@query("metadata", sql="""
with c as (select document_id, unnest(map_entries(confidence)) as e from metadata where confidence is not null)
select e.key as field, count(*) as n, round(avg(e.value), 4) as mean, round(min(e.value), 4) as least from c group by e.key""")
def field_confidence(meta: DataFrame) -> DataFrame:
    rows = meta.select(F.explode_outer("confidence").alias("field", "c")).filter("field is not null")
    return rows.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("c"), 4).alias("mean"), F.round(F.min("c"), 4).alias("least"))


@query("events", sql="""
with e as (select event_id, user_id, ts, cast(json_extract(props, '$.k') as int) as k from events)
select user_id, count(*) as n, sum(k) as k, max(ts) as last from e group by user_id""")
def event_properties(events: DataFrame) -> DataFrame:
    rows = events.withColumn("p", F.from_json("props", "k int"))
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("p.k").alias("k"), F.max("ts").alias("last"))


@query("structure", sql="""
with s as (select distinct node_id, document_id, page, char_start from structure where page is not null)
select node_id, 'DOC-' || lpad(cast(row_number() over (partition by document_id order by page, char_start nulls first, node_id) as varchar), 6, '0') as ticket from s""")
def ticket_numbers(structure: DataFrame) -> DataFrame:
    rows = structure.filter("page is not null").select("node_id", "document_id", "page", "char_start").distinct()
    n = F.row_number().over(Window.partitionBy("document_id").orderBy("page", F.col("char_start").asc_nulls_first(), "node_id"))
    return rows.select("node_id", F.concat(F.lit("DOC-"), F.lpad(n.cast("string"), 6, "0")).alias("ticket"))
