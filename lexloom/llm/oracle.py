"""SQL equivalents of the pN_ queries that SQL can express."""

from __future__ import annotations

_SPLIT_SIZES = """
with arrived as (select document_id, count(distinct page) as n from pages where page is not null group by document_id),
sized as (
  select 'document' as item_kind, d.document_id as item_id, 'page' as unit,
         case when coalesce(d.page_count, 0) <> 0 then d.page_count else coalesce(a.n, 0) end as size
  from documents d left join arrived a using (document_id)
  union all
  select 'node', node_id, 'char', abs(char_end - char_start) from structure
  where char_start is not null and char_end is not null)
select distinct s.item_kind, s.item_id{} from sized s
join split_limits l on l.item_kind = s.item_kind and l.unit = s.unit where s.size > l.max_size
"""

_GROUPS = """
with recursive hashed as (
  select document_id, regexp_replace(lower(trim(text_hash)), '^sha256:', '') as h from documents
  where text_hash is not null and document_id is not null),
edges as (
  select a.document_id as a, a.duplicate_of as b from duplicates a
  where a.document_id in (select document_id from documents) and a.duplicate_of in (select document_id from documents)
  union
  select x.document_id, y.m from hashed x join (select h, min(document_id) as m from hashed group by h) y using (h)
  where h <> '' and x.document_id <> y.m),
both_ways as (select a, b from edges where a <> b union select b, a from edges where a <> b),
reach(v, r) as (
  select distinct a, a from both_ways
  union
  select e.b, reach.r from reach join both_ways e on e.a = reach.v),
groups as (select v as document_id, min(r) as group_id from reach group by v)
"""

_EXCESS = """
with texts as (
  select distinct p.document_id, p.page, d.source, p.raw_text from pages p join documents d using (document_id)
  where p.raw_text is not null and d.source is not null),
pieces as (select document_id, page, source, unnest(string_split(raw_text, chr(10))) as line,
                  unnest(range(1, len(string_split(raw_text, chr(10))) + 1)) as line_no from texts),
canon as (select document_id, page, source, line_no,
  trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'),
       '[\\t\\v\\f\\r \\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')) as line
  from pieces),
long as (select * from canon where length(line) >= 20),
sizes as (select source, count(distinct document_id) as n from texts group by source),
counts as (select source, line, count(distinct document_id) as k from long group by source, line),
excess as (select c.source, c.line, c.k, s.n from counts c join sizes s using (source) where c.k >= 4 and c.k * 10 >= s.n)
"""

SQL: dict[str, str] = {
    "p1_found": _GROUPS + "select document_id, group_id from groups",
    "p1_groups": _GROUPS
    + "select d.document_id, coalesce(g.group_id, d.document_id) as group_id from documents d left join groups g using (document_id)",
    "p4_found": _SPLIT_SIZES.format(""),
    "p4_checked": _SPLIT_SIZES.format(", s.size, true as within, true as overlapping"),
    "p6_decoded": "select doc_id, md5(coalesce(text, '')) as digest from documents",
    "p5_found": _EXCESS + "select distinct document_id, page, line_no from long join excess using (source, line)",
    "p5_lines": _EXCESS + "select source, line, k as docs, n as source_docs from excess",
    "p5_clean": _EXCESS
    + """, gone as (select document_id, page, list(distinct line_no) as gone from long join excess using (source, line) group by all)
select p.document_id, p.page,
  case when g.gone is null or p.raw_text is null then p.raw_text else
    array_to_string([x for x, i in string_split(p.raw_text, chr(10)) if not list_contains(g.gone, i)], chr(10)) end as raw_text,
  case when p.raw_text is null then 0 else coalesce(len(g.gone), 0) end as removed
from pages p left join gone g on g.document_id = p.document_id and g.page = p.page""",
}
