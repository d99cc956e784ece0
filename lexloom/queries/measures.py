"""Functions, readers, keyed writes and exports that no other query shows, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.functions import numbers as N, text as T
from lexloom.operators import citations as C, metadata as M, review as R, store, structure as S
from lexloom.plans.staging import new_folder
from lexloom.queries.catalogue import query
from lexloom.queries.structure import _ARTICLES_SQL, _WHOLE_TEXTS, _lines_sql
from lexloom.sources import files, readers, sinks


@query("metadata", sql="""
select document_id, coalesce(nullif(rtrim(substr(trim(regexp_replace(lower(regexp_replace(strip_accents(translate(coalesce(title, ''), 'ºª', 'oa')), '[^\\x00-\\x7f]', '', 'g')), '[^a-z0-9]+', '_', 'g'), '_'), 1, 80), '_'), ''), 'document') as slug from metadata""")
def slugs(meta: DataFrame) -> DataFrame:
    return meta.select("document_id", T.slug(F.col("title")).alias("slug"))


@query("metadata", sql="""
select document_id, translate(regexp_replace(regexp_replace(number, '\\s+', '', 'g'), '[\\-‐-―−_.]+', '-', 'g'), 'OoQlI|', '000111') as number from metadata where number is not null""")
def tidied_numbers(meta: DataFrame) -> DataFrame:
    return meta.filter("number is not null").select("document_id", N.tidy_number(F.col("number")).alias("number"))


@query("sources", sql="""
select distinct document_id, case when size_bytes < 1024 then format('{:.1f} B', size_bytes / 1.0) when size_bytes < 1048576 then format('{:,.1f} KB', size_bytes / 1024.0)
  when size_bytes < 1073741824 then format('{:,.1f} MB', size_bytes / 1048576.0) end as size from sources where size_bytes is not null""")
def human_sizes(sources: DataFrame) -> DataFrame:
    return sources.filter("size_bytes is not null").select("document_id", T.human_size(F.col("size_bytes")).alias("size")).distinct()


@query("documents", sql="""
with t as (select doc_id, regexp_replace(text, '([\\pL_])[-­]\\s*\\n\\s*([\\p{Ll}\\p{Lt}\\p{Lm}\\p{Lo}_])', '\\1\\2', 'g') as text from documents where text is not null)
select doc_id, regexp_replace(text, '([\\pL_])[-­]\\s*\\n\\s*([\\p{Ll}\\p{Lt}\\p{Lm}\\p{Lo}_])', '\\1\\2', 'g') as text from t""")
def hyphens_joined(documents: DataFrame) -> DataFrame:
    return documents.filter("text is not null").select("doc_id", T.join_hyphenated(F.col("text")).alias("text"))


@query("documents", sql="""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no from documents where text is not null),
c as (select *, length(line) - length(regexp_replace(line, '\\pL', '', 'g')) as letters, length(line) - length(regexp_replace(line, '\\p{Lu}', '', 'g')) as upper from l)
select doc_id, line_no from c where letters > 0 and upper / letters >= 0.85""")
def upper_lines(documents: DataFrame) -> DataFrame:
    lines = documents.filter("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.filter(S.upper_line(F.col("line"))).select("doc_id", "line_no")


_HEAD = "lower(strip_accents(string_split_regex(text, '(?im)^\\s*(?:article|art\\.)\\s')[1]))"
_ISSUERS = {"ministre": "\\bministre\\b", "prefet": "\\bprefet\\b", "maire": "\\bmaire\\b"}
_BY_KIND = {"loi": "assemblee", "decret": "gouvernement"}


@query("documents", sql=f"""
with t as (select document_id, category, {_HEAD} as head, lower(strip_accents(text)) as whole from documents where text is not null),
v as (select document_id, case when regexp_matches(head, '\\bministre\\b') then 'ministre' when regexp_matches(head, '\\bprefet\\b') then 'prefet' when regexp_matches(head, '\\bmaire\\b') then 'maire' end as a,
  case category when 'loi' then 'assemblee' when 'decret' then 'gouvernement' end as b,
  case when regexp_matches(whole, '\\bministre\\b') then 'ministre' when regexp_matches(whole, '\\bprefet\\b') then 'prefet' when regexp_matches(whole, '\\bmaire\\b') then 'maire' end as c from t)
select document_id, coalesce(a, b, c) as value, case when a is not null then 0.8 when b is not null then 0.75 when c is not null then 0.3 end as confidence from v""")
def authorities(documents: DataFrame) -> DataFrame:
    found = M.authority(F.col("text"), F.col("category"), _ISSUERS, _BY_KIND).alias("a")
    return documents.filter("text is not null").select("document_id", found).select("document_id", "a.value", "a.confidence")


_DOMAINS = {"foncier": ["parcelle", "bornage", "cadastre"], "fiscal": ["taxe", "tarif", "redevance"], "sante": ["sanitaire", "medecin"]}
_HITS = {d: " + ".join(f"(length(t) - length(replace(t, '{w}', ''))) / {len(w)}.0" for w in ws) for d, ws in _DOMAINS.items()}


@query("documents", sql=f"""
with x as (select document_id, lower(strip_accents(text)) as t from documents where text is not null),
n as (select document_id, unnest([{', '.join(f"{{'n': {h}, 'd': '{d}'}}" for d, h in _HITS.items())}]) as s from x),
r as (select document_id, s.n as n, s.d as d, row_number() over (partition by document_id order by s.n desc, s.d desc) as i, lead(s.n) over (partition by document_id order by s.n desc, s.d desc) as next from n)
select document_id, d as value, case when n >= greatest(3, 2 * next) then 0.55 else 0.3 end as confidence from r where i = 1 and n > 0""")
def legal_domains(documents: DataFrame) -> DataFrame:
    rows = documents.filter("text is not null").select("document_id", M.domain(F.col("text"), _DOMAINS).alias("d"))
    return rows.filter("d is not null").select("document_id", "d.value", "d.confidence")


@query("metadata", "documents", sql="""
with m as (select document_id, nullif(trim(lang), '') as langue, nullif(lower(trim(category)), '') as type from documents)
select d.document_id, coalesce(m.langue, d.language) as language, coalesce(case when m.type in ('loi', 'decret', 'arrete') then m.type end, d.type) as type from metadata d left join m using (document_id)""")
def overridden(meta: DataFrame, documents: DataFrame) -> DataFrame:
    """Manual values, one under a French name, before extracted ones; kinds that aren't allowed override nothing."""
    manual = documents.select("document_id", F.col("lang").alias("langue"), F.col("category").alias("type"))
    return M.with_overrides(meta.select("document_id", "language", "type"), manual, "document_id", ("language", "type"), {"type": ("loi", "decret", "arrete")})


@query("duplicates", "metadata", sql="""
with i as (select document_id from metadata where type = 'loi')
select distinct document_id, duplicate_of, kind from duplicates where document_id in (select * from i) or duplicate_of in (select * from i)""")
def links_touching(duplicates: DataFrame, meta: DataFrame) -> DataFrame:
    edges = duplicates.select("document_id", "duplicate_of", "kind").distinct()
    return C.touching(edges, "document_id", "duplicate_of", meta.filter("type = 'loi'"))


@query("documents", sql="""
with p as (select doc_id, text, instr(text, 'Article') as place from documents where text is not null)
select doc_id, trim(regexp_replace(substr(text, greatest(place - 1 - 120, 0) + 1, place - 1 + 7 + 120 - greatest(place - 1 - 120, 0)), '\\s+', ' ', 'g')) as excerpt from p where place > 0""")
def excerpts(documents: DataFrame) -> DataFrame:
    at = F.instr("text", "Article")
    rows = documents.filter("text is not null").withColumn("at", at).filter("at > 0")
    return rows.select("doc_id", C.excerpt(F.col("text"), F.col("at") - 1, F.col("at") + 6).alias("excerpt"))


@query("lineitem", sql="""
with w as (select distinct l_orderkey, l_linenumber, l_extendedprice, l_returnflag, l_quantity from lineitem),
b as (select l_orderkey, string_agg(l_returnflag, chr(10) order by round(l_linenumber / 10.0, 1), round(l_extendedprice, 1), l_returnflag) as text, avg(case when l_quantity >= 5 then l_quantity - 5.0 end) / 100 as confidence from w group by l_orderkey)
select l_orderkey, text, round(confidence, 6) as confidence from b""")
def blocks_and_words(lineitem: DataFrame) -> DataFrame:
    """Blocks of a page in reading order and the mean confidence of its words; negative scores mark no word."""
    rows = lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_quantity").distinct()
    block = F.struct(F.col("l_extendedprice").cast("double").alias("x"), (F.col("l_linenumber") / 10).alias("y"), F.col("l_returnflag").alias("text"))
    word = F.struct((F.col("l_quantity").cast("double") - 5).alias("conf"), F.col("l_returnflag").alias("text"))
    grouped = rows.groupBy("l_orderkey").agg(F.collect_list(block).alias("b"), F.collect_list(word).alias("w"))
    return grouped.select("l_orderkey", readers.block_text(F.col("b")).alias("text"), F.round(readers.word_confidence(F.col("w")), 6).alias("confidence"))


@query("pages", sql="""
with r as (select document_id, case max(method) when 'pymupdf' then 'native' when 'ocr' then 'ocr' else 'hybrid' end as route from pages where method is not null group by document_id),
n as (select distinct document_id, page, text, raw_text from pages)
select document_id, page, case route when 'native' then text when 'ocr' then raw_text else coalesce(raw_text, text) end as text, route as method from n join r using (document_id)""")
def pages_by_route(pages: DataFrame) -> DataFrame:
    route = F.when(F.max("method") == "pymupdf", "native").when(F.max("method") == "ocr", "ocr").otherwise("hybrid")
    routes = pages.filter("method is not null").groupBy("document_id").agg(route.alias("route"))
    rows = pages.select("document_id", "page", "text", "raw_text").distinct()
    reading = lambda text: rows.select("document_id", "page", text.alias("text"))
    return readers.by_route(routes, reading(F.col("text")), reading(F.col("raw_text")), reading(F.coalesce("raw_text", "text")))


@query("structure", "metadata", sql="""
with a as (select document_id, list_sort(list(distinct node_id)) as units from structure where level = 'titre' group by document_id),
b as (select document_id, list_sort(list(distinct node_id)) as units from structure where level = 'chapitre' group by document_id)
select a.document_id, case when coalesce(len(b.units), 0) > len(a.units) then b.units else a.units end as units from a left join b using (document_id)""")
def better_readings(structure: DataFrame, meta: DataFrame) -> DataFrame:
    """Of two readings the one with strictly more units."""
    units = lambda level: structure.filter(F.col("level") == level).groupBy("document_id").agg(F.array_sort(F.collect_set("node_id")).alias("units"))
    return readers.better_reading(units("titre"), units("chapitre"), "document_id", "units")


@query("sources", "metadata", sql="""
select distinct document_id, raw_path from sources where document_id not in (select document_id from metadata where status is not null and status <> 'ok' and document_id is not null)""")
def side_files_to_delete(sources: DataFrame, meta: DataFrame) -> DataFrame:
    return readers.kept_side_files(sources.select("document_id", "raw_path").distinct(), meta.select("document_id", "status"), "review")


@query("documents", "metadata", sql="""
with base as (select document_id from documents where lang = 'fr'), piece as (select document_id from documents where category = 'decret' or lang = 'fr'),
accepted as (select document_id from metadata where type = 'decret'), wanted as (select document_id from piece where document_id in (select * from accepted))
select document_id, 'merged' as outcome from base union all select document_id, 'merged' from wanted where document_id not in (select * from base)
union all select document_id, 'refused' from wanted where document_id in (select * from base)""")
def merged_slices(documents: DataFrame, meta: DataFrame) -> DataFrame:
    """A slice merged into a base: its accepted rows that the base lacks; those it has are refused and named."""
    base, piece = documents.filter("lang = 'fr'").select("document_id"), documents.filter("category = 'decret' or lang = 'fr'").select("document_id")
    whole, refused = store.merged(base, piece, meta.filter("type = 'decret'"), "document_id")
    return whole.withColumn("outcome", F.lit("merged")).union(refused.withColumn("outcome", F.lit("refused")))


@query("structure", sql="""
with s as (select distinct node_id, char_start, char_end from structure)
select node_id, case when char_start is null or char_end is null then 'no offsets' when char_end < char_start then 'swapped' end as error from s""")
def isolated_errors(structure: DataFrame) -> DataFrame:
    rows = structure.select("node_id", "char_start", "char_end").distinct()
    error = F.when(F.col("char_start").isNull() | F.col("char_end").isNull(), "no offsets").when(F.col("char_end") < F.col("char_start"), "swapped")
    good, bad = store.split_errors(rows, error)
    return good.select("node_id", F.lit(None).cast("string").alias("error")).union(bad.select("node_id", "error"))


_STEPS = [("view", "click"), ("click", "purchase"), ("view", "view")]


@query("events", sql="""
with s as (select event_id, user_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as before from events)
select event_id, before as from_state, event_type as to_state from s where before is not null and (before, event_type) not in (('view', 'click'), ('click', 'purchase'), ('view', 'view'))""")
def illegal_steps(events: DataFrame) -> DataFrame:
    """Events whose step from the user's former state a transition table doesn't allow."""
    allowed = events.sparkSession.createDataFrame(_STEPS, "from_state string, to_state string")
    return R.illegal_steps(events, "user_id", ["ts", "event_id"], "event_type", allowed).select("event_id", "from_state", "to_state")


@query("metadata", sql="select document_id, title, type, confidence['title'] as sure, warnings from metadata where document_id is not null")
def json_lines_round_trip(meta: DataFrame) -> DataFrame:
    """Metadata written as JSON lines and read back with a schema."""
    path = new_folder(meta.sparkSession, "json-lines")
    rows = meta.filter("document_id is not null").select("document_id", "title", "type", "confidence", "warnings")
    sinks.export(rows, path, "json")
    good, _ = files.jsonl(meta.sparkSession, path, "document_id string, title string, type string, confidence map<string,double>, warnings array<string>")
    return good.select("document_id", "title", "type", F.try_element_at("confidence", F.lit("title")).alias("sure"), "warnings")


@query("documents", "metadata", sql="""
with f as (select document_id, category, text from documents where text is not null and category is not null)
select category, count(*) as n, sum(length(text)) as chars from f group by category""")
def category_folders(documents: DataFrame, meta: DataFrame) -> DataFrame:
    """Documents exported to one folder per category, written twice (only folders present are replaced), and read back."""
    path = new_folder(documents.sparkSession, "categories")
    rows = documents.filter("text is not null and category is not null").select("document_id", "category", "text")
    for _ in range(2):
        sinks.export(rows, path, "parquet", by="category")
    back = documents.sparkSession.read.parquet(path)
    return back.groupBy(F.col("category").cast("string").alias("category")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("documents", "metadata", "sources", sql=_lines_sql(_WHOLE_TEXTS) + _ARTICLES_SQL + """,
s as (select document_id, min(filename) as filename from sources group by document_id)
select article_id, document_id, found.number as article_number, value as numeric_value, position, length(text) as chars, m.title as document_title, m.type as document_type, m.number as document_number, m.date as document_date,
  m.status as document_status, m.language, s.filename as source_file from found left join metadata m using (document_id) left join s using (document_id)""")
def article_table(documents: DataFrame, meta: DataFrame, sources: DataFrame) -> DataFrame:
    """The flat table of articles, written as CSV and read back; texts are compared by their length."""
    spark = documents.sparkSession
    texts = documents.filter("text is not null").select("document_id", F.lit(1).alias("page"), F.regexp_replace("text", "\\r\\n?", "\n").alias("text"))
    flat = sinks.article_records(S.articles(texts), meta, sources).select(
        "article_id", "document_id", F.col("number").alias("article_number"), F.col("value").alias("numeric_value"), "position", F.length("text").alias("chars"),
        "document_title", "document_type", "document_number", "document_date", "document_status", "language", "source_file",
    )
    path = new_folder(spark, "articles-csv")
    sinks.export(flat, path, "csv")
    return spark.read.schema(flat.schema).option("header", True).csv(path)


@query("documents", sql=_lines_sql(_WHOLE_TEXTS) + _ARTICLES_SQL + """,
ranked as (select document_id, line_no, level, number, list_position(['partie', 'livre', 'titre', 'sous_titre', 'chapitre', 'section', 'sous_section', 'paragraphe', 'annexe', 'article'], level) as rank, row_number() over (partition by document_id order by line_no) as n from hs),
nth as (select document_id, n, row_number() over (partition by document_id order by n) as position from ranked where level = 'article'),
up as (select x.document_id, x.position, y.level, concat_ws(' ', upper(y.level), y.number) as label, y.rank from nth x join ranked y on y.document_id = x.document_id and y.n < x.n and y.rank < 10
  where not exists (select 1 from ranked z where z.document_id = x.document_id and z.n > y.n and z.n < x.n and z.rank <= y.rank)),
agg as (select document_id, position, list(label order by rank) as hierarchy_path, max(case when level = 'titre' then label end) as titre, max(case when level = 'chapitre' then label end) as chapitre,
  max(case when level = 'section' then label end) as section, max(case when level = 'annexe' then label end) as annexe from up group by all)
select article_id, coalesce(hierarchy_path, []) as hierarchy_path, titre, chapitre, section, annexe from found left join agg using (document_id, position)""")
def article_context(documents: DataFrame) -> DataFrame:
    """Each article with the units it stands in."""
    texts = documents.filter("text is not null").select("document_id", F.lit(1).alias("page"), F.regexp_replace("text", "\\r\\n?", "\n").alias("text"))
    rows = S.with_context(S.articles(texts), S.tree(S.headings(texts)))
    return rows.select("article_id", "hierarchy_path", "titre", "chapitre", "section", "annexe")


@query("documents", sql="""
select document_id, case when lang = 'fr' then 'moved' else coalesce(category, 'none') end as category from documents""")
def replaced_in_folders(documents: DataFrame) -> DataFrame:
    """Documents in folders by category, after the French ones have moved to another folder: no stale copy stays."""
    path = new_folder(documents.sparkSession, "by-category")
    rows = documents.select("document_id", F.coalesce("category", F.lit("none")).alias("category"))
    sinks.replace_in_folders(rows, path, "document_id", "category")
    moved = documents.filter("lang = 'fr'").select("document_id", F.lit("moved").alias("category"))
    sinks.replace_in_folders(moved, path, "document_id", "category")
    return documents.sparkSession.read.schema(rows.schema).json(path)
