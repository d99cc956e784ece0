"""Filters, joins, aggregates, windows, set operations, keyed writes."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window, functions as F

from lexloom.functions.text import SPACE_VARIANTS
from lexloom.operators import citations, dedup, metadata, review, store
from lexloom.queries.catalogue import query

BLANK = "[\\s" + "".join(f"\\x{{{ord(c):x}}}" for c in SPACE_VARIANTS) + "]+"
HASH_FORM = f"trim(regexp_replace(lower(text), '{BLANK}', ' ', 'g'))"


@query("documents", sql=f"""
with h as (select document_id, sha256({HASH_FORM}) as h from documents where text is not null and {HASH_FORM} <> ''),
f as (select h, min(document_id) as duplicate_of from h group by h having count(*) > 1)
select document_id, duplicate_of, 'text_hash' as kind, cast(1.0 as double) as similarity from h join f using (h) where document_id <> duplicate_of""")
def exact_text_duplicates(documents: DataFrame) -> DataFrame:
    from lexloom.functions.text import hash_form

    content = F.nullif(F.sha2(hash_form(F.col("text")), 256), F.lit(hashlib.sha256(b"").hexdigest()))
    links = dedup.exact_links(documents, "document_id", content)
    return links.withColumn("kind", F.lit("text_hash")).withColumn("similarity", F.lit(1.0))


@query("sources", sql="""
with s as (select distinct document_id, file_hash, ingested_at from sources where file_hash is not null and file_hash <> ''),
f as (select file_hash, arg_min(document_id, (coalesce(ingested_at, ''), document_id)) as duplicate_of, count(distinct document_id) as n from s group by file_hash)
select distinct s.document_id, f.duplicate_of from s join f using (file_hash) where f.n > 1 and s.document_id <> f.duplicate_of""")
def file_hash_duplicates(sources: DataFrame) -> DataFrame:
    rows = sources.filter("file_hash <> ''").select("document_id", "file_hash", "ingested_at").distinct()
    links = dedup.exact_links(rows, "document_id", F.col("file_hash"), F.coalesce("ingested_at", F.lit("")))
    return links.filter("document_id <> duplicate_of").distinct()


@query("duplicates", sql="select duplicate_of, list_sort(list(distinct document_id)) as members, count(distinct document_id) as n from duplicates where document_id is not null and duplicate_of is not null group by duplicate_of")
def duplicate_groups(duplicates: DataFrame) -> DataFrame:
    rows = duplicates.filter("document_id is not null and duplicate_of is not null").groupBy("duplicate_of")
    return rows.agg(F.array_sort(F.collect_set("document_id")).alias("members"), F.countDistinct("document_id").alias("n"))


@query("duplicates", sql="select kind, count(*) as links, count(distinct document_id) as documents, round(avg(similarity), 4) as similarity from duplicates group by kind")
def duplicate_statistics(duplicates: DataFrame) -> DataFrame:
    return duplicates.groupBy("kind").agg(F.count(F.lit(1)).alias("links"), F.countDistinct("document_id").alias("documents"), F.round(F.avg("similarity"), 4).alias("similarity"))


@query("pages", sql=f"""
with t as (select document_id, page, trim(regexp_replace(lower(text), '{BLANK}', ' ', 'g')) as c from pages where text is not null),
f as (select document_id, c, min(page) as first from t where length(c) >= 200 group by all)
select distinct t.document_id, t.page, f.first from t join f using (document_id, c) where t.page > f.first""")
def duplicate_pages(pages: DataFrame) -> DataFrame:
    from lexloom.functions.text import hash_form

    return dedup.repeated_within(pages.select("document_id", "page", "text"), "document_id", hash_form(F.col("text")), "page", 200).select("document_id", "page", "first").distinct()


@query("documents", "pages", "metadata", "structure", sql="""
select 'documents' as part, lang as label, count(*) as n from documents group by lang
union all select 'types', type, count(*) from metadata group by type
union all select 'pages', method, count(*) from pages group by method
union all select 'levels', level, count(*) from structure group by level""")
def corpus_statistics(documents: DataFrame, pages: DataFrame, meta: DataFrame, structure: DataFrame) -> DataFrame:
    parts = [("documents", documents, "lang"), ("types", meta, "type"), ("pages", pages, "method"), ("levels", structure, "level")]
    rows = [df.groupBy(F.lit(name).alias("part"), F.col(c).alias("label")).agg(F.count(F.lit(1)).alias("n")) for name, df, c in parts]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])


@query("documents", sql="select category, count(*) as documents, coalesce(sum(page_count), 0) as pages, coalesce(sum(n_chars), 0) as chars from documents group by category")
def dashboard(documents: DataFrame) -> DataFrame:
    return documents.groupBy("category").agg(
        F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("page_count"), F.lit(0)).alias("pages"), F.coalesce(F.sum("n_chars"), F.lit(0)).alias("chars")
    )


@query("metadata", sql="select status, jurisdiction, count(*) as n, count(distinct authority) as authorities from metadata group by cube (status, jurisdiction)")
def status_cube(meta: DataFrame) -> DataFrame:
    return meta.cube("status", "jurisdiction").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("authority").alias("authorities"))


@query("documents", "metadata", sql="""
select d.document_id, d.source, m.title, m.type, coalesce(d.n_chars, 0) as n_chars from documents d left join metadata m using (document_id)
where coalesce(m.type, 'inconnu') = 'inconnu' order by coalesce(d.n_chars, 0), d.document_id""")
def documents_to_review(documents: DataFrame, meta: DataFrame) -> DataFrame:
    joined = documents.join(meta.select("document_id", "title", "type"), "document_id", "left").filter(F.coalesce("type", F.lit("inconnu")) == "inconnu")
    return joined.select("document_id", "source", "title", "type", F.coalesce("n_chars", F.lit(0)).alias("n_chars")).orderBy("n_chars", "document_id")


@query("documents", sql="select document_id, lang, substr(text, 1, 300) as excerpt from documents where contains(lower(text), 'commission') order by document_id")
def full_text_search(documents: DataFrame) -> DataFrame:
    hit = documents.filter(F.contains(F.lower("text"), F.lit("commission")))
    return hit.select("document_id", "lang", F.substring("text", 1, 300).alias("excerpt")).orderBy("document_id")


@query("metadata", sql="""
select code, count(*) as n from (select unnest(warnings) as code from metadata) where code is not null group by code order by n desc, code limit 10""")
def top_warnings(meta: DataFrame) -> DataFrame:
    codes = meta.select(F.explode_outer("warnings").alias("code")).filter("code is not null")
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "code").limit(10)


@query("documents", "duplicates", sql="select d.document_id, d.source from documents d where d.document_id not in (select document_id from duplicates where document_id is not null)")
def originals(documents: DataFrame, duplicates: DataFrame) -> DataFrame:
    return documents.select("document_id", "source").join(duplicates.select("document_id"), "document_id", "left_anti")


@query("documents", "pages", sql="select d.document_id from documents d where d.document_id in (select document_id from pages) and d.source is not null")
def documents_with_pages(documents: DataFrame, pages: DataFrame) -> DataFrame:
    return documents.filter("source is not null").select("document_id").join(pages.select("document_id"), "document_id", "left_semi")


@query("sources", "documents", sql="""
with done as (select distinct regexp_replace(lower(trim(text_hash)), '^sha256:', '') as h from documents where text_hash is not null)
select s.document_id, s.filename from sources s where s.file_hash is null or s.file_hash = '' or s.file_hash not in (select h from done)""")
def resume(sources: DataFrame, documents: DataFrame) -> DataFrame:
    done = documents.select(metadata.normal_hash(F.col("text_hash")).alias("h"))
    return metadata.not_yet_done(sources.select("document_id", "filename", "file_hash"), "file_hash", done, "h").select("document_id", "filename")


@query("documents", "sources", sql="""
with c as (select regexp_replace(lower(trim(file_hash)), '^sha256:', '') as h, arg_max(source_path, (document_id, source_path)) as path from sources where file_hash is not null and trim(file_hash) <> '' group by 1)
select d.document_id, c.path from documents d left join c on regexp_replace(lower(trim(d.text_hash)), '^sha256:', '') = c.h""")
def catalogue_by_hash(documents: DataFrame, sources: DataFrame) -> DataFrame:
    entries = sources.withColumn("k", F.struct("document_id", "source_path"))
    joined = metadata.attach_by_hash(documents.select("document_id", "text_hash"), "text_hash", entries.filter(F.trim("file_hash") != ""), "file_hash", "k", ["source_path"])
    return joined.select("document_id", F.col("entry.source_path").alias("path"))


@query("structure", "pages", sql="""
with r as (select document_id, node_id, page as first, coalesce(lead(page) over (partition by document_id order by page, node_id), page + 1) - 1 as last_page from (select distinct document_id, node_id, page from structure where page is not null)),
r2 as (select document_id, node_id, first, greatest(first, last_page) as last from r),
p as (select distinct document_id, page from pages)
select p.document_id, p.page, arg_max(r2.node_id, (r2.first, r2.node_id)) filter (where r2.node_id is not null) as node_id
from p left join r2 on p.document_id = r2.document_id and p.page between r2.first and r2.last group by p.document_id, p.page""")
def unit_of_page(structure: DataFrame, pages: DataFrame) -> DataFrame:
    nodes = structure.filter("page is not null").select("document_id", "node_id", F.col("page").alias("first")).distinct()
    w = Window.partitionBy("document_id").orderBy("first", "node_id")
    nodes = nodes.withColumn("last", F.greatest(F.col("first"), F.coalesce(F.lead("first").over(w), F.col("first") + 1) - 1)).withColumn("o", F.struct("first", "node_id"))
    return citations.covering(pages.select("document_id", "page").distinct(), nodes, "document_id", "page", "first", "last", "node_id", "o")


@query("metadata", sql="""
with g as (select *, count(*) over (partition by type, number) as n from metadata where type is not null and number is not null)
select document_id, type, number, date, row_number() over (partition by type, number order by date nulls first, document_id) as version_no from g where n > 1""")
def version_numbering(meta: DataFrame) -> DataFrame:
    return citations.versions(meta.select("document_id", "type", "number", "date"), ["type", "number"], "date", "document_id")


@query("sources", sql="""
with b as (select document_id, source_path, ingested_at, file_hash, coalesce(filename, '') as base, row_number() over (partition by coalesce(filename, '') order by document_id, source_path, ingested_at) as i
           from (select distinct document_id, source_path, ingested_at, filename, file_hash from sources)),
c as (select *, concat_ws('_', base, substr(coalesce(file_hash, ''), 1, 8)) as c from b),
k as (select *, row_number() over (partition by c, i > 1 order by document_id, source_path, ingested_at) as k from c)
select document_id, source_path, case when i = 1 then base when k = 1 then c else concat_ws('_', c, k) end as new_id from k""")
def sequential_ids(sources: DataFrame) -> DataFrame:
    rows = sources.select("document_id", "source_path", "ingested_at", "filename", "file_hash").distinct()
    out = metadata.sequential_ids(rows, F.coalesce("filename", F.lit("")), F.col("file_hash"), F.col("document_id"), F.col("source_path"), F.col("ingested_at"))
    return out.select("document_id", "source_path", "new_id")


@query("sources", sql="select * from (select document_id, filename, ingested_at, row_number() over (partition by document_id order by ingested_at desc nulls last, filename desc nulls last, source_path desc nulls last) as r from sources) where r = 1".replace("select *", "select document_id, filename, ingested_at"))
def latest_ingest(sources: DataFrame) -> DataFrame:
    return store.latest(sources, ["document_id"], F.col("ingested_at"), F.col("filename"), F.col("source_path")).select("document_id", "filename", "ingested_at")


@query("orders", sql="""
with old as (select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderdate < date '1996-01-01'),
new as (select o_orderkey, 'F' as o_orderstatus, o_totalprice * 2 as o_totalprice from orders where o_orderdate >= date '1995-06-01')
select n.o_orderkey, case when o.o_orderstatus is not null and o.o_orderstatus <> 'P' then o.o_orderstatus else n.o_orderstatus end as o_orderstatus, n.o_totalprice from new n left join old o using (o_orderkey)
union all select * from old where o_orderkey not in (select o_orderkey from new)""")
def upsert_keeping_decisions(orders: DataFrame) -> DataFrame:
    rows = orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    old = rows.filter("o_orderdate < date '1996-01-01'").drop("o_orderdate")
    new = rows.filter("o_orderdate >= date '1995-06-01'").select("o_orderkey", F.lit("F").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return store.replace_by_key(old, store.sticky(old, new, "o_orderkey", "o_orderstatus", "P"), ["o_orderkey"])


@query("orders", "lineitem", sql="select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'P')")
def cascade_delete(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    gone = orders.filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return store.cascade(lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), gone, "l_orderkey")


@query("documents", sql="""
with p as (select doc_id, text, 'Article 2' as a, 'Article deux' as b from documents where text is not null),
c as (select *, (length(text) - length(replace(text, a, ''))) / length(a) = 1 as applied from p)
select doc_id, applied, case when applied then replace(text, a, b) else text end as text from c""")
def exactly_once_patch(documents: DataFrame) -> DataFrame:
    rows = documents.filter("text is not null").select("doc_id", "text", F.lit("Article 2").alias("a"), F.lit("Article deux").alias("b"))
    return store.patched(rows, "text", "a", "b").select("doc_id", "applied", "text")


@query("metadata", "sources", sql="""
with a as (select distinct document_id, source as v from metadata), b as (select distinct document_id, category as v from sources)
select document_id, v, 'missing' as side from (select * from a except select * from b) union all select document_id, v, 'unexpected' from (select * from b except select * from a)""")
def unmatched_rows(meta: DataFrame, sources: DataFrame) -> DataFrame:
    a = meta.select("document_id", F.col("source").alias("v")).distinct()
    return store.unmatched(a, sources.select("document_id", F.col("category").alias("v")).distinct())


@query("events", sql="""
select user_id, arg_max(event_type, (ts, event_id)) as event_type, count(*) as events from events group by user_id""")
def current_states(events: DataFrame) -> DataFrame:
    return review.current_states(events, "user_id", ["ts", "event_id"], "event_type")


@query("events", sql="""
with s as (select user_id, event_id, lag(event_type) over (partition by user_id order by ts, event_id) as from_state, event_type as to_state from events)
select user_id, event_id, from_state, to_state from s where from_state = to_state""")
def repeated_states(events: DataFrame) -> DataFrame:
    kinds = events.select(F.col("event_type").alias("from_state")).distinct()
    pairs = kinds.join(kinds.select(F.col("from_state").alias("to_state")), F.col("from_state") != F.col("to_state"))
    return review.illegal_steps(events, "user_id", ["ts", "event_id"], "event_type", pairs).select("user_id", "event_id", "from_state", "to_state")


@query("events", sql="select time_bucket(interval 1 day, ts, timestamp '1970-01-01') as begin, event_type, count(*) as events, round(sum(value), 4) as value from events group by 1, 2")
def events_per_day(events: DataFrame) -> DataFrame:
    from lexloom.streaming.incremental import tumbling

    out = tumbling(events, "ts", "1 day", "event_type").withColumn("value", F.round("value", 4))
    return out.withColumn("begin", F.col("begin").cast("timestamp_ntz"))


@query("events", sql="""
with f as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 12 hour then 0 else 1 end as fresh from events),
s as (select user_id, ts, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as n from f)
select user_id, min(ts) as begin, count(*) as events from s group by user_id, n""")
def event_sessions(events: DataFrame) -> DataFrame:
    from lexloom.streaming.incremental import sessions

    return sessions(events, "ts", "12 hours", "user_id").withColumn("begin", F.col("begin").cast("timestamp_ntz"))


@query("documents", sql="""
with c as (select category, doc_id, row_number() over (partition by category order by doc_id) as r from documents)
select category, cast((r - 1) // 100 as bigint) as slice, count(*) as n, min(doc_id) as first, max(doc_id) as last from c group by 1, 2""")
def slice_plan(documents: DataFrame) -> DataFrame:
    r = F.row_number().over(Window.partitionBy("category").orderBy("doc_id"))
    rows = documents.select("category", "doc_id", F.floor((r - 1) / 100).alias("slice"))
    return rows.groupBy("category", "slice").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@query("lineitem", "orders", sql="""
with e as (select l_orderkey, case l_returnflag when 'R' then 'abroge' when 'A' then 'modifie' else 'en_vigueur' end as state, case l_returnflag when 'R' then 5 when 'A' then 2 else 1 end as severity, l_discount as sure from lineitem),
m as (select l_orderkey, max(severity) as severity from e group by l_orderkey)
select o_orderkey, any_value(state) as state, max(sure) as sure from orders join e on o_orderkey = e.l_orderkey join m on e.l_orderkey = m.l_orderkey and e.severity = m.severity group by o_orderkey""")
def status_propagation(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The strongest state that the lines of an order give it, and how sure it is."""
    state = F.when(F.col("l_returnflag") == "R", "abroge").when(F.col("l_returnflag") == "A", "modifie").otherwise("en_vigueur")
    edges = lineitem.select("l_orderkey", state.alias("state"), F.col("l_discount").alias("sure"))
    return orders.select("o_orderkey").join(citations.strongest(edges, "l_orderkey", "state", "sure"), F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")
