"""Headings, articles, citations, fields of acts, numbering, review."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.functions import numbers as N
from lexloom.operators import citations as C, metadata as M, review as R, structure as S
from lexloom.plans.staging import stage
from lexloom.queries.catalogue import SQL, query


@query("structure", sql="""
with r as (select distinct node_id, upper(trim(number)) as t from structure where number is not null),
d as (select node_id, t, regexp_matches(t, '^M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$') and t <> '' as ok,
  list_transform(string_split(t, ''), lambda c: case c when 'I' then 1 when 'V' then 5 when 'X' then 10 when 'L' then 50 when 'C' then 100 when 'D' then 500 when 'M' then 1000 end) as v from r)
select node_id, case when ok then cast(list_sum(list_transform(range(1, len(v) + 1), lambda i: case when i < len(v) and v[i] < v[i + 1] then -v[i] else v[i] end)) as int) end as value from d where ok""")
def roman_numbers(structure: DataFrame) -> DataFrame:
    return structure.select("node_id", N.roman_value(F.col("number")).alias("value")).filter("value is not null").distinct()


@query("metadata", sql="""
with n as (select document_id, number, trim(regexp_replace(number, '(?i)^\\s*\\bn[°ºo]*\\s*', '')) as b from metadata where number is not null),
k as (select document_id, number, regexp_extract(b, '^([0-9]{2,4})\\s*[-–/_.]\\s*([0-9]{1,4})', 1) as y, regexp_extract(b, '^([0-9]{2,4})\\s*[-–/_.]\\s*([0-9]{1,4})', 2) as s from n)
select document_id, number, case when length(y) = 4 then cast(y as int) when length(y) = 2 and cast(y as int) >= 60 then 1900 + cast(y as int) end as year,
  case when length(y) = 4 or (length(y) = 2 and cast(y as int) >= 60) then cast(s as int) end as serial from k""")
def official_numbers(meta: DataFrame) -> DataFrame:
    rows = meta.filter("number is not null").select("document_id", "number", N.official_key(F.col("number")).alias("k"))
    return rows.select("document_id", "number", "k.year", "k.serial")


def _re2(pattern: str) -> str:
    """A Java pattern as a literal of the checking engine, whose case folding is always Unicode's."""
    return pattern.replace("'", "''").replace("(?iu)", "(?i)")


def _heading_sql() -> str:
    """A case expression that gives the heading of ``line``, built from the same rule table."""

    def one(rule: S.Rule) -> str:
        p = _re2(rule.pattern)
        size = f"length(line) - length(regexp_extract(line, '{p}', 2))" if rule.body else "length(line)"
        return f"when regexp_matches(line, '{p}') and {size} <= {rule.longest} then {{'level': '{rule.level}', 'number': nullif(trim(regexp_extract(line, '{p}', 1)), ''), 'heading': trim(regexp_extract(line, '{p}', 2))}}"

    contents = " or ".join(f"regexp_matches(line, '{_re2(p)}')" for p in S.CONTENTS)
    return f"case when {contents} then null {' '.join(one(r) for r in sorted(S.RULES, key=lambda r: r.priority))} end"


_WHOLE_TEXTS = "select document_id, 1 as page, regexp_replace(text, '\\r\\n?', chr(10), 'g') as text from documents where text is not null"
_PAGE_TEXTS = "select distinct document_id, page, regexp_replace(text, '\\r\\n?', chr(10), 'g') as text from pages where text is not null and page is not null"


def _lines_sql(texts: str) -> str:
    """Lines with the heading that counts, the first closing formula and whether one stands before."""
    any_of = lambda ps: "(" + " or ".join(f"regexp_matches(line, '{_re2(p)}')" for p in ps) + ")"
    return f"""
with texts as ({texts}),
raw as (select document_id, page, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no from texts),
l as (select document_id, page, line_no, trim(raw) as line,
  coalesce(sum(length(raw) + 1) over (partition by document_id order by page, line_no rows between unbounded preceding and 1 preceding), 0) as begin from raw),
f as (select *, {any_of(S.STOPS)} and not {any_of(S.NEVER_STOPS)} as formula, {_heading_sql()} as h0 from l),
c as (select *, coalesce(bool_or(formula) over (partition by document_id order by page, line_no rows between unbounded preceding and 1 preceding), false) as closed from f),
n as (select *, formula and not closed as stop, sum(case when closed and h0.level = 'article' then 1 else 0 end) over (partition by document_id) >= {S.LEAST_ANNEXED} as annexed from c),
m as (select * exclude (h0), case when (not closed and not stop) or (closed and annexed) then h0 when stop and annexed then {{'level': 'annexe', 'number': null, 'heading': ''}} end as h from n),
hs as (select document_id, page, line_no, begin, h.level as level, h.number as number, h.heading as heading from m where h is not null)
"""


_UNITS_SQL = """, u as (select *, sum(case when h is not null or stop then 1 else 0 end) over (partition by document_id order by page, line_no) as unit from m),
g as (select document_id, unit, any_value(h) as h, min(page) as page, bool_or(stop) as closing, bool_or(closed) as closed,
  string_agg(case when h is not null and not stop then h.heading else line end, chr(10) order by page, line_no) as t from u group by document_id, unit)
"""
_TRIM = "regexp_replace(regexp_replace({}, '^\\s+', ''), '\\s+$', '')"


def _number_sql(c: str) -> str:
    """Value of an article's number: an ordinal, digits, two parts, or Roman, and tenths for bis, ter ..."""
    suffixes = "|".join(N.SUFFIXES)
    places = ", ".join(f"'{x}'" for x in N.SUFFIXES)
    ordinals = ", ".join(f"'{k}': {v}" for k, v in N.ORDINALS.items())
    return f""", a as (select *, trim(replace(strip_accents(lower({c})), '°', '')) as t0 from a0),
b as (select *, regexp_extract(t0, '\\b({suffixes})\\b', 1) as suffix from a),
d as (select *, regexp_replace(regexp_replace(case when suffix = '' then t0 else trim(regexp_replace(t0, '\\b({suffixes})\\b.*$', '')) end, '^[ .\\-–—]+', ''), '[ .\\-–—]+$', '') as t1 from b),
e as (select *, upper(t1) as up, list_transform(string_split(upper(t1), ''), lambda x: case x when 'I' then 1 when 'V' then 5 when 'X' then 10 when 'L' then 50 when 'C' then 100 when 'D' then 500 when 'M' then 1000 end) as v from d),
w as (select *, coalesce(cast(map {{{ordinals}}}[t1] as double), try_cast(regexp_extract(t1, '^([0-9]+)\\s*(?:er|ere|e|eme)?$', 1) as double),
    case when regexp_matches(t1, '^[0-9]+[-.][0-9]+$') then cast(regexp_extract(t1, '^([0-9]+)[-.]([0-9]+)$', 1) as double) + cast(regexp_extract(t1, '^([0-9]+)[-.]([0-9]+)$', 2) as double) / 100 end,
    case when up <> '' and regexp_matches(up, '{N.ROMAN}') then list_sum(list_transform(range(1, len(v) + 1), lambda i: case when i < len(v) and v[i] < v[i + 1] then -v[i] else v[i] end)) end)
  + coalesce(list_position([{places}], nullif(suffix, '')) / 10.0, 0) as value from e)
"""


_ARTICLES_SQL = _UNITS_SQL + f""", a0 as (select document_id, unit, page, closed, h.number as number, {_TRIM.format('t')} as text, row_number() over (partition by document_id order by unit) as position,
  document_id || case when closed then '_annexe' else '' end || '_article_' || lower(regexp_replace(h.number, '[^\\pL0-9]+', '_', 'g')) as base from g where h.level = 'article')
""" + _number_sql("number") + f""", r as (select *, row_number() over (partition by document_id, base order by unit) as k from w),
found as (select document_id, case when k > 1 then concat_ws('_', base, k) else base end as article_id, position, number, value, page, closed as annexed, text,
  list_filter([case when length(text) < {S.SHORT} then 'short' end, case when length(text) > {S.LONG} then 'long' end, case when value is null then 'number_unread' end, case when k > 1 then 'number_repeated' end], lambda x: x is not null) as warnings from r)
"""


@query("documents", sql=_lines_sql(_WHOLE_TEXTS) + "select * from hs")
def heading_lines(documents: DataFrame) -> DataFrame:
    """Headings before the closing formula and of annexed texts."""
    return S.headings(_as_pages(documents), "text")


@query("documents", sql=_lines_sql(_WHOLE_TEXTS) + f""",
k as (select *, list_position([{', '.join(f"'{x}'" for x in S.LEVELS)}], level) as rank, row_number() over (partition by document_id order by begin) as n from hs),
i as (select *, document_id || '_n' || lpad(cast(n as varchar), 3, '0') as node_id from k),
p as (select x.document_id, x.n, y.node_id as up, y.rank as r, concat_ws(' ', upper(y.level), y.number) as label from i x join i y on x.document_id = y.document_id and y.n < x.n and y.rank < x.rank
  where not exists (select 1 from i z where z.document_id = x.document_id and z.n > y.n and z.n < x.n and z.rank <= y.rank)),
q as (select document_id, n, arg_max(up, r) as parent_id, count(*) as depth, list(label order by r) as path from p group by all)
select i.document_id, node_id, level, number, heading, page, begin, parent_id, coalesce(depth, 0) as depth, coalesce(path, []) as path from i left join q using (document_id, n)""")
def heading_tree(documents: DataFrame) -> DataFrame:
    return S.tree(S.headings(_as_pages(documents), "text"))


@query("documents", sql=_lines_sql(_WHOLE_TEXTS) + _ARTICLES_SQL + "select * from found")
def articles(documents: DataFrame) -> DataFrame:
    return S.articles(_as_pages(documents), "text")


@query("pages", sql=_lines_sql(_PAGE_TEXTS) + _ARTICLES_SQL + "select document_id, page, list(article_id order by position, article_id) as articles from found group by document_id, page")
def articles_by_page(pages: DataFrame) -> DataFrame:
    rows = pages.filter("text is not null and page is not null").select("document_id", "page", F.regexp_replace("text", "\\r\\n?", "\n").alias("text"))
    return S.articles_by_page(S.articles(rows.distinct(), "text"))


@query("documents", sql=_lines_sql(_WHOLE_TEXTS) + _UNITS_SQL + f"""
select document_id, max(case when unit = 0 then {_TRIM.format('t')} end) as preamble, max(case when closing then {_TRIM.format('t')} end) as epilogue,
  case when not bool_or(coalesce(h.level = 'article', false)) then 'no_articles' end as warning from g group by document_id""")
def around_articles(documents: DataFrame) -> DataFrame:
    return S.around_articles(_as_pages(documents), "text")


@query("documents", sql=_lines_sql(_WHOLE_TEXTS) + _ARTICLES_SQL + """,
y as (select document_id, position, value, lag(value) over (partition by document_id order by position) as before from found where value is not null)
select document_id, position, before, value as after, case when value - before <= 0 then 'order' else 'missing' end as problem from y
where value - before <= 0 or (value - before > 1 and value - before = floor(value - before))""")
def article_gaps(documents: DataFrame) -> DataFrame:
    return S.numbering_gaps(S.articles(_as_pages(documents), "text"), ["document_id"], "position", "value")


@query("documents", sql=f"""
with raw as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents where text is not null),
l as (select doc_id, i, trim(line) as line, coalesce(lag(trim(line) = '') over (partition by doc_id order by i), true) as blank from raw),
n as (select *, nullif(trim(regexp_extract(line, '^\\s*([0-9]{{1,3}}\\s*[°)\\-.]|[a-z]\\s*[)\\-.]|[-–—•])\\s+\\S', 1)), '') as number from l where line <> ''),
x as (select *, sum(case when number is not null or blank then 1 else 0 end) over (partition by doc_id order by i) - 1 as idx from n)
select doc_id, idx, arg_min(case when number is null then [] else [number] end, i)[1] as number, string_agg(line, ' ' order by i) as text from x group by doc_id, idx""")
def paragraphs(documents: DataFrame) -> DataFrame:
    return S.paragraphs(documents.filter("text is not null"), "doc_id", "text")


def _as_pages(documents: DataFrame) -> DataFrame:
    return documents.filter("text is not null").select("document_id", F.lit(1).alias("page"), F.regexp_replace("text", "\\r\\n?", "\n").alias("text"))


@query("lineitem", sql="""
with s as (select l_orderkey, l_partkey, l_linenumber, l_suppkey, lag(l_suppkey) over (partition by l_orderkey order by l_linenumber, l_suppkey, l_partkey) as before from lineitem)
select l_orderkey, l_linenumber, before, l_suppkey as after, case when l_suppkey - before <= 0 then 'order' else 'missing' end as problem from s
where before is not null and (l_suppkey - before <= 0 or l_suppkey - before > 1)""")
def numbering_gaps(lineitem: DataFrame) -> DataFrame:
    rows = lineitem.withColumn("at", F.struct("l_linenumber", "l_suppkey", "l_partkey"))
    return S.numbering_gaps(rows, ["l_orderkey"], "at", "l_suppkey").withColumn("l_linenumber", F.col("at.l_linenumber")).drop("at")


_CITED = f"""
with p as (select distinct document_id, page, text from pages where text is not null),
f as (select document_id, page, 'cite' as relation, unnest(regexp_extract_all(text, '{_re2(C.PATTERN_OF_RECITALS)}', 1)) as target from p),
c as (select document_id, relation, arg_min(target, (page, target)) as target_reference, min(page) as page from f group by document_id, relation, lower(target)),
k as (select *, strip_accents(lower(regexp_extract(target_reference, '^\\pL+', 0))) as kind0,
  regexp_extract(target_reference, '([0-9]{{2,4}})\\s*[-–/_]\\s*([0-9]{{1,4}})', 1) as y, regexp_extract(target_reference, '([0-9]{{2,4}})\\s*[-–/_]\\s*([0-9]{{1,4}})', 2) as s from c),
r as (select document_id, relation, target_reference, regexp_replace(kind0, 's$', '') as kind, y || '-' || case when length(s) < 3 then lpad(s, 3, '0') else s end as number, page from k)
"""


@query("pages", sql=_CITED + "select * from r")
def citations(pages: DataFrame) -> DataFrame:
    return C.citations(pages)


def _claims(meta: DataFrame) -> DataFrame:
    rows = meta.filter("number is not null and type is not null and type <> 'inconnu'")
    serial = F.substring_index("number", "-", -1)
    number = F.concat_ws("-", F.substring_index("number", "-", 1), F.when(F.length(serial) < 3, F.lpad(serial, 3, "0")).otherwise(serial))
    url = F.coalesce(F.contains("source_url", F.replace("number", F.lit(" "), F.lit(""))).cast("int"), F.lit(0))
    return rows.select(F.col("type").alias("kind"), number.alias("number"), "document_id", url.alias("strength"))


@query("pages", "metadata", sql=_CITED + """,
m as (select type as kind, string_split(number, '-')[1] || '-' || case when length(string_split(number, '-')[-1]) < 3 then lpad(string_split(number, '-')[-1], 3, '0') else string_split(number, '-')[-1] end as number,
  document_id, case when contains(coalesce(source_url, ''), replace(number, ' ', '')) then 1 else 0 end as strength from metadata where number is not null and type is not null and type <> 'inconnu'),
t as (select kind, number, max(strength) as strength from m group by all),
i as (select kind, number, min(document_id) as lo, max(document_id) as hi from m join t using (kind, number, strength) group by kind, number),
j as (select r.*, case when lo = hi then lo end as t, lo <> hi as ambiguous, case when r.kind is null then 0.35 when relation = 'cite' then 0.6 else 0.8 end as base from r left join i using (kind, number)),
o as (select *, case when t = document_id then 'self' when t is not null then 'resolved' when ambiguous then 'ambiguous' else 'unresolved' end as outcome from j)
select document_id, relation, target_reference, kind, number, page, case when outcome = 'resolved' then t end as target, outcome,
  round(case outcome when 'resolved' then least(base + 0.15, 0.99) when 'self' then 0.2 when 'ambiguous' then 0.35 else base end, 2) as confidence,
  outcome <> 'resolved' or round(least(base + 0.15, 0.99), 2) < 0.8 as needs_review from o""")
def resolved_citations(pages: DataFrame, meta: DataFrame) -> DataFrame:
    return C.resolve(C.citations(pages), C.reference_index(_claims(meta)))


@query("pages", "metadata", sql=SQL["resolved_citations"].rsplit("select document_id, relation, target_reference", 1)[0] + """, z as (
  select document_id, target_reference, round(case outcome when 'resolved' then least(base + 0.15, 0.99) when 'self' then 0.2 when 'ambiguous' then 0.35 else base end, 2) as confidence,
    outcome <> 'resolved' or round(least(base + 0.15, 0.99), 2) < 0.8 as needs from o)
select document_id, target_reference, confidence from z where needs""")
def citations_to_review(pages: DataFrame, meta: DataFrame) -> DataFrame:
    found = C.resolve(C.citations(pages), C.reference_index(_claims(meta)))
    return C.unresolved(found).select("document_id", "target_reference", "confidence")


#: Clauses about the act of a metadata row, by the length of its id; the relation each states, if any.
_CLAUSES = (
    ("Vu {}, portant organisation", "cite"), ("La présente loi modifie {} sur un point.", "modifie"), ("Est pris en application de {} :", "applique"), ("{} est abrogé.", "abroge"),
    ("{} est abrogé par la loi n° 2003-017.", None), ("abrogeant partiellement {} ;", "abroge_partiellement"), ("L'article 4 de {} est abrogé.", "abroge_partiellement"),
    ("complétant {} et d'autres", "complete"), ("{} est remplacé.", "remplace"), ("Le texte remplace {}.", "remplace"), ("modifiée par {}", None),
)
_CLAUSE_ROWS = """select document_id, type, string_split(number, '-')[1] || '-' || case when length(string_split(number, '-')[-1]) < 3 then lpad(string_split(number, '-')[-1], 3, '0') else string_split(number, '-')[-1] end as number,
  cast(substr(number, -3) as int) % 11 as k from metadata where regexp_matches(number, '^[0-9]{4}-[0-9]{1,4}$') and length(number) >= 7 and type in ('loi', 'decret', 'arrete', 'ordonnance', 'convention')"""
_STATED = "case k " + " ".join(f"when {i} then '{r}'" for i, (_, r) in enumerate(_CLAUSES) if r) + " end"


def _clauses(meta: DataFrame) -> DataFrame:
    """Pages with one clause about each act, of a made-up document for each."""
    rows = meta.filter("number rlike '^[0-9]{4}-[0-9]{1,4}$' and length(number) >= 7 and type in ('loi', 'decret', 'arrete', 'ordonnance', 'convention')")
    written = F.expr("case type when 'decret' then 'le décret' when 'arrete' then 'l’arrêté' when 'ordonnance' then 'l''ordonnance' else concat('la ', type) end")
    act = F.concat(written, F.lit(" n° "), "number")
    k = F.substring("number", -3, 3).cast("int") % len(_CLAUSES)
    rows = rows.select(F.concat(F.lit("about_"), "document_id").alias("document_id"), F.replace(F.get(F.array(*[F.lit(c) for c, _ in _CLAUSES]), k), F.lit("{}"), act).alias("text"))
    return rows.select("document_id", F.lit(1).alias("page"), F.regexp_replace("text", "\\bde le ", "du ").alias("text"))


@query("metadata", sql=f"""
with m as ({_CLAUSE_ROWS}) select 'about_' || document_id as document_id, {_STATED} as relation, type as kind, number from m where {_STATED} is not null""")
def relations_of_clauses(meta: DataFrame) -> DataFrame:
    """All seven relations, active and passive, with and without an agent; the SQL states what each clause says."""
    return C.citations(_clauses(meta)).select("document_id", "relation", "kind", "number")


@query("metadata", sql=f"""
with m as ({_CLAUSE_ROWS}), r as (select *, {_STATED} as relation from m),
claims as (select type as kind, string_split(number, '-')[1] || '-' || case when length(string_split(number, '-')[-1]) < 3 then lpad(string_split(number, '-')[-1], 3, '0') else string_split(number, '-')[-1] end as number, document_id,
  case when contains(coalesce(source_url, ''), replace(number, ' ', '')) then 1 else 0 end as strength from metadata where number is not null and type is not null and type <> 'inconnu'),
t as (select kind, number, max(strength) as strength from claims group by all),
i as (select kind, number, min(document_id) as target from claims join t using (kind, number, strength) group by kind, number having count(distinct document_id) = 1),
e as (select i.target, case relation when 'abroge' then 'abroge' when 'abroge_partiellement' then 'partiellement_abroge' when 'remplace' then 'remplace' when 'modifie' then 'modifie' end as state
  from r join i on r.type = i.kind and r.number = i.number),
s as (select *, list_position(['inconnu', 'en_vigueur', 'modifie', 'partiellement_abroge', 'remplace', 'abroge'], state) as severity from e where state is not null)
select target, arg_max(state, severity) as state, 0.95 as confidence from s group by target""")
def induced_states(meta: DataFrame) -> DataFrame:
    """State of each act from the strongest resolved relation to it."""
    return C.induced(C.resolve(C.citations(_clauses(meta)), C.reference_index(_claims(meta))))


@query("metadata", "documents", sql="""
with p as (select m.document_id, m.date, m.number, lower(strip_accents(string_split_regex(d.text, '(?im)^\\s*(?:article|art\\.)\\s')[1])) as t from metadata m join documents d using (document_id) where d.text is not null),
x as (select document_id, date, regexp_extract(t, '\\b([0-9]{1,2})(?:er)?\\s+(janvier|fevrier|mars|avril|mai|juin|juillet|aout|septembre|octobre|novembre|decembre)\\s+([0-9]{4})\\b', ['d', 'm', 'y']) as r from p)
select document_id, date, case when r.m <> '' and try_cast(r.d as int) between 1 and 31 then r.y || '-' || lpad(cast(list_position(['janvier','fevrier','mars','avril','mai','juin','juillet','aout','septembre','octobre','novembre','decembre'], r.m) as varchar), 2, '0') || '-' || lpad(r.d, 2, '0') end as read from x""")
def heading_dates(meta: DataFrame, documents: DataFrame) -> DataFrame:
    texts = documents.filter("text is not null").select("document_id", N.written_date(M.head(F.col("text"))).alias("read"))
    return meta.select("document_id", "date").join(texts, "document_id")


def _first_kind_sql(part: str) -> str:
    """The kind whose word stands first in a folded text."""
    one = lambda t, p: f"case when regexp_matches({part}, '{p}') then {{'at': length(regexp_extract({part}, '(?s)^(.*?){p}', 1)), 't': '{t}'}} end"
    return f"list_sort(list_filter([{', '.join(one(t, p) for t, p in M.TYPE_WORDS.items())}], lambda x: x is not null))[1].t"


def _first_date_sql(part: str) -> str:
    """The first date of the calendar in a folded text."""
    months = {m: i for i, m in enumerate(N.MONTHS, 1)} | N.SHORT_MONTHS
    names = "|".join([*N.MONTHS, *sorted(N.SHORT_MONTHS, key=len, reverse=True)])
    pattern = f"\\\\b[0-9]{{1,2}}(?:er)?\\\\s+(?:{names})\\\\b\\\\.?\\\\s+[0-9]{{4}}\\\\b".replace("\\\\", "\\")
    number = " ".join(f"when '{m}' then '{i:02d}'" for m, i in months.items())
    iso = f"regexp_extract(d, '([0-9]{{4}})$', 1) || '-' || case regexp_extract(d, '([a-z]+)\\.?\\s+[0-9]{{4}}$', 1) {number} end || '-' || lpad(regexp_extract(d, '^([0-9]+)', 1), 2, '0')"
    return f"list_filter(list_transform(regexp_extract_all({part}, '{pattern}'), lambda d: {iso}), lambda d: try_cast(d as date) is not null)[1]"


CITATION = "(?i)^\\s*(?:vu\\b|consid[ée]rant\\b|sur\\s+rapport\\b|apr[èe]s\\s+avis\\b)"
_NUMBER_RE = "(?i)\\bn[°º.o]{1,3}\\s*([0-9]{2,4}\\s*[-–]\\s*[0-9]{1,4})"
_number_of = lambda part: f"nullif(regexp_replace(regexp_replace(regexp_extract({part}, '{_NUMBER_RE}', 1), '\\s+', '', 'g'), '–', '-', 'g'), '')"
_ACT_SQL = f"""
with t as (select document_id, category, text, array_to_string(list_filter(string_split(text, chr(10)), lambda x: not regexp_matches(x, '{CITATION}')), chr(10)) as own from documents where text is not null),
h as (select *, string_split_regex(own, '(?im)^\\s*(?:article|art\\.)\\s')[1] as head, regexp_replace(own, '(?i)\\b(?:à\\s+compter|à\\s+partir)\\s+du\\s+[^\\n,;.]{{0,40}}', ' ', 'g') as dated,
  regexp_extract_all(text, '(?i)\\b((?:fait à|done at|feito em)\\s+[^\\n]{{2,60}})')[-1] as signed from t),
g as (select *, string_split_regex(dated, '(?im)^\\s*(?:article|art\\.)\\s')[1] as dated_head, string_split(document_id, '_')[1] as prefix, regexp_extract(document_id, '^[a-z]+[-_]([0-9]{{2,4}})[-_]([0-9]{{1,7}})(?:[-_.]|$)', 1) as ny,
  regexp_extract(document_id, '^[a-z]+[-_]([0-9]{{2,4}})[-_]([0-9]{{1,7}})(?:[-_.]|$)', 2) as ns from h),
k as (select document_id, category, prefix, head, own, text, ny, ns, lower(strip_accents(head)) as fh, lower(strip_accents(own)) as fo, lower(strip_accents(text)) as ft, lower(strip_accents(dated_head)) as dh, lower(strip_accents(signed)) as ds, lower(strip_accents(dated)) as dd from g),
v as (select document_id, 'type' as field, [{{'v': {_first_kind_sql('fh')}, 'c': 0.9, 'e': 'head'}}, {{'v': {_first_kind_sql('fo')}, 'c': 0.6, 'e': 'text'}}, {{'v': case when category in {tuple(M.TYPE_WORDS)} then category end, 'c': 0.45, 'e': 'category'}},
    {{'v': case when prefix in {tuple(M.TYPE_WORDS)} then prefix end, 'c': 0.35, 'e': 'name'}}, {{'v': {_first_kind_sql('ft')}, 'c': 0.3, 'e': 'recital'}}] as l from k
  union all select document_id, 'number', [{{'v': {_number_of('head')}, 'c': 0.92, 'e': 'head'}}, {{'v': {_number_of('own')}, 'c': 0.75, 'e': 'text'}}, {{'v': case when ny <> '' then ny || '-' || ns end, 'c': 0.65, 'e': 'name'}}, {{'v': {_number_of('text')}, 'c': 0.4, 'e': 'recital'}}] from k
  union all select document_id, 'date', [{{'v': {_first_date_sql('dh')}, 'c': 0.95, 'e': 'head'}}, {{'v': {_first_date_sql('ds')}, 'c': 0.9, 'e': 'signature'}}, {{'v': {_first_date_sql('dd')}, 'c': 0.55, 'e': 'text'}}, {{'v': {_first_date_sql('ft')}, 'c': 0.4, 'e': 'recital'}}] from k),
fields as (select document_id, field, list_filter(l, lambda x: x.v is not null)[1] as x from v)
"""


@query("documents", sql=_ACT_SQL + "select document_id, field, x.v as value, cast(x.c as double) as confidence, x.e as evidence from fields where x is not null")
def act_fields(documents: DataFrame) -> DataFrame:
    """Kind, number and date with confidence and evidence."""
    rows = documents.filter("text is not null").select(
        "document_id",
        M.act_type(F.col("text"), F.col("category"), F.col("document_id")).alias("type"),
        M.act_number(F.col("text"), F.col("document_id")).alias("number"),
        M.act_date(F.col("text")).alias("date"),
    )
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("f")) for f in ("type", "number", "date")]))
    return rows.select("document_id", fields.alias("x")).select("document_id", "x.field", "x.f.*").filter("value is not null")


@query("metadata", sql="""
with m as (select document_id, list_filter([case when title is null or trim(title) in ('', 'inconnu') then 'title' end, case when type is null or trim(type) in ('', 'inconnu') then 'type' end,
  case when number is null or trim(number) in ('', 'inconnu') then 'number' end, case when date is null or trim(date) in ('', 'inconnu') then 'date' end, case when authority is null or trim(authority) in ('', 'inconnu') then 'authority' end,
  case when language is null or trim(language) in ('', 'inconnu') then 'language' end, case when source is null or trim(source) in ('', 'inconnu') then 'source' end], lambda x: x is not null) as missing from metadata)
select document_id, missing, round((7 - len(missing)) / 7.0, 4) as completeness from m""")
def completeness(meta: DataFrame) -> DataFrame:
    return M.completeness(meta).select("document_id", "missing", "completeness")


@query("metadata", "documents", sql=_ACT_SQL + """,
w as (select document_id, max(case when field = 'type' then x.v end) as type, max(case when field = 'number' then x.v end) as number, max(case when field = 'date' then x.v end) as date from fields group by document_id),
j as (select w.document_id, unnest([{'f': 'type', 'a': nullif(trim(w.type), ''), 'b': nullif(trim(m.type), '')}, {'f': 'number', 'a': nullif(trim(w.number), ''), 'b': nullif(trim(m.number), '')}, {'f': 'date', 'a': nullif(trim(w.date), ''), 'b': nullif(trim(m.date), '')}]) as r
  from w join metadata m using (document_id)),
y as (select document_id, r.f as field, r.a as read, r.b as listed, regexp_extract(r.a, '^([0-9]{4})-([0-9]{1,4})$', ['y', 's']) as ka, regexp_extract(r.b, '^([0-9]{4})-([0-9]{1,4})$', ['y', 's']) as kb from j)
select document_id, field, read, listed, case when read is null then 'filled' when listed is null then 'read only'
  when case when field = 'number' and ka.y <> '' and kb.y <> '' then ka.y = kb.y and try_cast(ka.s as int) = try_cast(kb.s as int) else regexp_replace(lower(strip_accents(read)), '[^a-z0-9-]', '', 'g') = regexp_replace(lower(strip_accents(listed)), '[^a-z0-9-]', '', 'g') end then 'confirmed' else 'diverges' end as verdict
from y where read is not null or listed is not null""")
def reconciled_fields(meta: DataFrame, documents: DataFrame) -> DataFrame:
    """Fields read from the text against those of the metadata table."""
    read = documents.filter("text is not null").select(
        "document_id", M.act_type(F.col("text"), F.col("category"), F.col("document_id"))["value"].alias("type"),
        M.act_number(F.col("text"), F.col("document_id"))["value"].alias("number"), M.act_date(F.col("text"))["value"].alias("date"),
    )
    return M.reconcile(read, meta, "document_id", ("type", "number", "date"))


@query("metadata", sql="""
with x as (select document_id, try_cast(substr(number, 1, 4) as int) as ny, try_cast(substr(date, 1, 4) as int) as dy, try_cast(substr(date, 6, 2) as int) as dm from metadata where number is not null and date is not null)
select document_id, ny, dy from x where ny is not null and dy is not null and ny <> dy and not (abs(ny - dy) = 1 and dm in (1, 2, 11, 12))""")
def number_date_conflicts(meta: DataFrame) -> DataFrame:
    year = lambda c: F.expr(f"try_cast(substring({c}, 1, 4) as int)")
    rows = meta.filter("number is not null and date is not null").select("document_id", year("number").alias("ny"), year("date").alias("dy"), F.expr("try_cast(substring(date, 6, 2) as int)").alias("dm"))
    near = (F.abs(F.col("ny") - F.col("dy")) == 1) & F.coalesce(F.col("dm").isin(1, 2, 11, 12), F.lit(False))
    return rows.filter((F.col("ny") != F.col("dy")) & ~near).select("document_id", "ny", "dy")


@query("structure", sql="""
with s as (select distinct document_id, node_id, char_start from structure where char_start is not null)
select document_id, node_id, lag(node_id) over (partition by document_id order by char_start, node_id) as previous, lead(node_id) over (partition by document_id order by char_start, node_id) as following from s""")
def neighbouring_units(structure: DataFrame) -> DataFrame:
    rows = structure.filter("char_start is not null").select("document_id", "node_id", "char_start").distinct().withColumn("o", F.struct("char_start", "node_id"))
    return R.neighbours(rows, "document_id", "o", "node_id").select("document_id", "node_id", "previous", "following")


@query("structure", sql="""
with recursive s as (select node_id, any_value(parent_id) as parent_id, any_value(level) as level from structure group by node_id),
t as (select node_id, node_id as top, 0 as depth from s where parent_id is null or parent_id not in (select node_id from s)
      union all select s.node_id, t.top, t.depth + 1 from s join t on s.parent_id = t.node_id where t.depth < 12)
select node_id, top, depth from t""")
def tree_roots(structure: DataFrame) -> DataFrame:
    """Topmost unit and depth of each unit, by pointer doubling instead of one join per level."""
    nodes = structure.groupBy("node_id").agg(F.first("parent_id", True).alias("parent_id"))
    have = nodes.select(F.col("node_id").alias("parent_id"), F.lit(True).alias("have"))
    up = nodes.join(have, "parent_id", "left").select("node_id", F.when(F.col("have"), F.col("parent_id")).otherwise(F.col("node_id")).alias("top"))
    up = up.withColumn("depth", (F.col("top") != F.col("node_id")).cast("int"))
    up = stage(up, "tree-tops")
    for _ in range(MAX_DOUBLINGS):
        jump = up.select(F.col("node_id").alias("top"), F.col("top").alias("next"), F.col("depth").alias("more"))
        after = stage(up.join(jump, "top").select("node_id", F.col("next").alias("top"), (F.col("depth") + F.col("more")).alias("depth")), "tree-tops")
        if after.exceptAll(up).isEmpty():
            return after
        up = after
    raise ValueError("units are each other's parents")


#: So many doublings reach through 2^40 levels; only a circle is deeper.
MAX_DOUBLINGS = 40


@query("documents", sql="""
with c as (select document_id, 'Article 2' as before, 'Article 2 nouveau' as after, 0.9 as confidence from documents where text is not null),
x as (select c.*, (length(d.text) - length(replace(d.text, before, ''))) / length(before) as n from c join documents d using (document_id))
select document_id, case when n <> 1 then 'passage' when 8.0 / 9 > 0.5 then 'length' end as refusal from x""")
def checked_corrections(documents: DataFrame) -> DataFrame:
    wanted = documents.filter("text is not null").select("document_id", F.lit("Article 2").alias("before"), F.lit("Article 2 nouveau").alias("after"), F.lit(0.9).alias("confidence"))
    return R.verified(wanted, documents, "document_id", "text").select("document_id", "refusal")


@query("documents", "metadata")
def dates_witnessed(documents: DataFrame, meta: DataFrame) -> DataFrame:
    """Whether the text supports the date read from it, the listed one, both or neither (edit distances of months)."""
    texts = documents.filter("text is not null").select("document_id", "text", N.written_date(M.head(F.col("text"))).alias("read"))
    joined = texts.join(meta.select("document_id", "date"), "document_id")
    return joined.select("document_id", "read", F.col("date").alias("listed"), M.third_witness(F.col("read"), F.col("date"), F.col("text")).alias("witness"))


@query("documents")
def article_chunks(documents: DataFrame) -> DataFrame:
    from lexloom.operators.chunks import article_chunks as chunked

    return chunked(S.articles(_as_pages(documents), "text"))
