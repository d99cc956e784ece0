"""Acts as trees: headings by a rule table, articles up to the next boundary, paragraphs, numbering."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.functions.numbers import legal_number
from lexloom.functions.text import count_of
from lexloom.operators.lines import with_offsets

_NUMBER = "(premier|première|unique|[0-9]{1,4}(?:er|ère|º|°)?(?:[-.][0-9]{1,3})?(?:\\s+(?:bis|ter|quater|quinquies))?|[IVXLC]{1,7})"
_AFTER = "(?:\\s*[:.\\-–—\"'’`´,;°]+\\s*|\\s+|$)(.*)$"


@dataclass(frozen=True)
class Rule:
    """A kind of heading line: of all rules that match, the one of lowest priority holds."""

    level: str
    keyword: str
    priority: int
    longest: int = 200
    number_required: bool = True
    body: bool = False  # the rest of the line is text, so only the prefix counts for ``longest``

    @property
    def pattern(self) -> str:
        number = f"\\s*{_NUMBER}" if self.body else f"\\s+{_NUMBER}" if self.number_required else f"(?:\\s+{_NUMBER})?"
        return f"(?iu)^\\s*(?:{self.keyword}){number}{_AFTER}"


# Levels from the widest to the narrowest, and formulas that end an act or only seem to.
RULES = (
    Rule("partie", "partie", 10), Rule("livre", "livre", 20), Rule("sous_titre", "sous[-\\s]?titre", 25),
    Rule("titre", "titre|title|t[ií]tulo", 30), Rule("chapitre", "chapitre|chap\\.|chapter|cap[ií]tulo", 40),
    Rule("sous_section", "sous[-\\s]?section", 45), Rule("section", "section|sec[cç][aã]o", 50), Rule("paragraphe", "paragraphe|§", 60),
    Rule("annexe", "annexes?|annex|anexo", 70, number_required=False), Rule("article", "article|art\\.|art|artigo", 80, 400, body=True),
)
LEVELS = ("partie", "livre", "titre", "sous_titre", "chapitre", "section", "sous_section", "paragraphe", "annexe", "article")
STOPS = ("(?iu)^\\s*fait\\s+[àa]\\s+.{2,40}\\s*,?\\s*le\\s+", "(?iu)^\\s*(?:ainsi\\s+fait|par\\s+le\\s+pr[ée]sident)")
NEVER_STOPS = ("(?iu)\\bpromulgue\\b", "(?iu)\\bteneur\\s+suit\\b", "(?iu)\\ba\\s+d[ée]lib[ée]r[ée]\\s+et\\s+adopt[ée]")
CONTENTS = ("\\.{4,}\\s*[0-9]{1,4}\\s*$", "(?iu)^\\s*(?:sommaire|table\\s+des\\s+mati[èe]res)\\s*$")
PARAGRAPH = "^\\s*([0-9]{1,3}\\s*[°)\\-.]|[a-z]\\s*[)\\-.]|[-–—•])\\s+(?=\\S)"


def any_match(line: Column, patterns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [line.rlike(p) for p in patterns])


def is_stop(line: Column) -> Column:
    return any_match(line, STOPS) & ~any_match(line, NEVER_STOPS)


def upper_line(line: Column) -> Column:
    letters = count_of(line, "\\p{L}")
    return F.when(letters > 0, count_of(line, "\\p{Lu}") / letters >= 0.85).otherwise(False)


def heading(line: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct(level, number, heading) of the first rule that matches, else null."""

    def one(rule: Rule) -> Column:
        number, rest = F.regexp_extract(line, rule.pattern, 1), F.regexp_extract(line, rule.pattern, 2)
        size = F.length(line) - F.length(rest) if rule.body else F.length(line)
        found = F.struct(F.lit(rule.level).alias("level"), F.nullif(F.trim(number), F.lit("")).alias("number"), F.trim(rest).alias("heading"))
        return F.when(line.rlike(rule.pattern) & (size <= rule.longest), found)

    return F.when(~any_match(line, CONTENTS), F.coalesce(*[one(r) for r in sorted(rules, key=lambda r: r.priority)]))


#: So many articles after the closing formula are an annexed text (an agreement, a scale); fewer are stamps or notices.
LEAST_ANNEXED = 2


def _marked(pages: DataFrame, text: str, rules: tuple[Rule, ...]) -> DataFrame:
    """Lines with ``h`` (the heading that counts, else null), ``stop`` (the first closing formula) and ``closed`` (whether a
    closing formula stands before). Headings behind it count where enough articles stand there; then the closing line opens an
    implicit annex, so that the annexed numbers don't mix with those of the act."""
    lines = with_offsets(pages, text).withColumn("line", F.trim("line"))
    document = Window.partitionBy("document_id")
    before = document.orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("formula", is_stop(F.col("line"))).withColumn("h", heading(F.col("line"), rules))
    lines = lines.withColumn("closed", F.coalesce(F.max("formula").over(before), F.lit(False)))
    lines = lines.withColumn("stop", F.col("formula") & ~F.col("closed")).drop("formula")
    # A count over the lines of a document, as an aggregate: the window above already has them in one place.
    annexed = F.count(F.when(F.col("closed") & (F.col("h.level") == "article"), 1)).over(document) >= LEAST_ANNEXED
    implicit = F.struct(F.lit("annexe").alias("level"), F.lit(None).cast("string").alias("number"), F.lit("").alias("heading"))
    h = F.when(~F.col("closed") & ~F.col("stop") | F.col("closed") & F.col("annexed"), F.col("h")).when(F.col("stop") & F.col("annexed"), implicit)
    return lines.withColumn("annexed", annexed).withColumn("h", h)


def headings(pages: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(document_id, page, line_no, begin, level, number, heading): the heading lines before the closing formula, and those of
    a text annexed behind it, under an annex without number."""
    return _marked(pages, text, rules).filter("h is not null").select("document_id", "page", "line_no", "begin", "h.*")


def tree(found: DataFrame) -> DataFrame:
    """headings() with the ancestors: per level the last heading since a wider one came (``path``), ``node_id``
    by order, ``parent_id`` and ``depth``."""
    order = Window.partitionBy("document_id").orderBy("begin")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rank = F.array_position(F.array(*map(F.lit, LEVELS)), F.col("level"))
    rows = found.withColumn("rank", rank).withColumn("n", F.row_number().over(order))
    rows = rows.withColumn("node_id", F.concat("document_id", F.lit("_n"), F.lpad(F.col("n").cast("string"), 3, "0")))
    label = F.concat_ws(" ", F.upper("level"), "number")
    ancestors = []
    for i, level in enumerate(LEVELS, 1):
        here = F.last(F.when(F.col("level") == level, F.struct(F.col("n"), F.col("node_id"), label.alias("label"))), True).over(before)
        wider = F.max(F.when(F.col("rank") < i, F.col("n"))).over(before)
        valid = F.lit(i) < F.col("rank")
        ancestors.append(F.when(valid & here.isNotNull() & (F.coalesce(wider, F.lit(0)) < here["n"]), here))
    rows = rows.withColumn("up", F.filter(F.array(*ancestors), lambda a: a.isNotNull()))
    return rows.select(
        "document_id", "node_id", "level", "number", "heading", "page", "begin",
        F.try_element_at("up", F.lit(-1))["node_id"].alias("parent_id"), F.size("up").alias("depth"),
        F.transform("up", lambda a: a["label"]).alias("path"),
    )


#: An article's text with fewer characters may be incomplete, with more it may be several articles.
SHORT, LONG = 20, 40_000


def _units(pages: DataFrame, text: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(document_id, unit, h, page, closing, text): stretches of lines that a heading or the closing formula begins; unit 0
    stands before the first of them."""
    lines = _marked(pages, text, rules)
    order = Window.partitionBy("document_id").orderBy("page", "line_no")
    lines = lines.withColumn("unit", F.sum((F.col("h").isNotNull() | F.col("stop")).cast("int")).over(order))
    body = F.when(F.col("h").isNotNull() & ~F.col("stop"), F.col("h.heading")).otherwise(F.col("line"))
    return lines.groupBy("document_id", "unit").agg(
        F.max("h").alias("h"), F.min("page").alias("page"), F.max("stop").alias("closing"), F.max("closed").alias("closed"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "line_no", body.alias("t")))), lambda x: x["t"]), "\n").alias("text"),
    )


def articles(pages: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(document_id, article_id, position, number, value, page, annexed, text, warnings): each article's lines up to the next
    heading or the closing formula; a repeated number gets _2, _3 ... in its id. Articles of a text annexed behind the closing
    formula follow, their ids with the scope ``annexe``. Warnings: short, long, number_unread, number_repeated."""
    units = _units(pages, text, rules).filter("h.level = 'article'")
    numbered = units.withColumn("number", F.col("h.number")).withColumn("position", F.row_number().over(Window.partitionBy("document_id").orderBy("unit")))
    scope = F.when(F.col("closed"), "_annexe").otherwise("")
    base = F.concat("document_id", scope, F.lit("_article_"), F.lower(F.regexp_replace("number", "[^\\p{L}0-9]+", "_")))
    numbered = numbered.withColumn("base", base).withColumn("k", F.row_number().over(Window.partitionBy("document_id", "base").orderBy("unit")))
    numbered = numbered.withColumn("text", F.regexp_replace("text", "^\\s+|\\s+$", "")).withColumn("value", legal_number(F.col("number")))
    warnings = F.array(
        F.when(F.length("text") < SHORT, "short"), F.when(F.length("text") > LONG, "long"), F.when(F.col("value").isNull(), "number_unread"), F.when(F.col("k") > 1, "number_repeated")
    )
    return numbered.select(
        "document_id", F.when(F.col("k") > 1, F.concat_ws("_", "base", "k")).otherwise(F.col("base")).alias("article_id"),
        "position", "number", "value", "page", F.col("closed").alias("annexed"), "text", F.array_compact(warnings).alias("warnings"),
    )


def with_context(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """articles() with ``hierarchy_path`` and one column per level above articles: the label of the last unit of that level that
    an article stands in. ``nodes`` as of tree() over the same texts; the n-th article of both is the same."""
    n = F.row_number().over(Window.partitionBy("document_id").orderBy("begin"))
    paths = nodes.filter("level = 'article'").select("document_id", n.alias("position"), F.col("path").alias("hierarchy_path"))
    label = lambda level: F.try_element_at(F.filter("hierarchy_path", lambda x: F.substring_index(x, " ", 1) == level.upper()), F.lit(-1)).alias(level)
    return found.join(paths, ["document_id", "position"], "left").select(*found.columns, "hierarchy_path", *[label(level) for level in LEVELS[:-1]])


def around_articles(pages: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(document_id, preamble, epilogue, warning): the text before the first heading (recitals, the title), the closing formula
    with what follows up to an annexed text, and ``no_articles`` where there are none. Every document has a row."""
    units = _units(pages, text, rules)
    trimmed = lambda when: F.regexp_replace(F.max(F.when(when, F.col("text"))), "^\\s+|\\s+$", "")
    some = F.max(F.coalesce(F.col("h.level") == "article", F.lit(False)))
    rows = units.groupBy("document_id").agg(trimmed(F.col("unit") == 0).alias("preamble"), trimmed(F.col("closing")).alias("epilogue"), some.alias("_some"))
    return rows.select("document_id", "preamble", "epilogue", F.when(~F.col("_some"), "no_articles").alias("warning"))


def paragraphs(items: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, idx, number, text): blocks that a numbered line or a blank line begins."""
    lines = items.select(key, F.posexplode_outer(F.split(F.col(text), "\n")).alias("i", "line")).withColumn("line", F.trim("line"))
    order = Window.partitionBy(key).orderBy("i")
    number = F.nullif(F.trim(F.regexp_extract("line", PARAGRAPH, 1)), F.lit(""))
    lines = lines.withColumn("number", number).withColumn("blank", F.lag(F.col("line") == "", 1, True).over(order))
    lines = lines.filter("line <> ''").withColumn("fresh", (F.col("number").isNotNull() | F.col("blank")).cast("int"))
    lines = lines.withColumn("idx", F.sum("fresh").over(order) - 1)
    parts = F.array_sort(F.collect_list(F.struct("i", "line")))
    return lines.groupBy(key, "idx").agg(F.min_by("number", "i").alias("number"), F.array_join(F.transform(parts, lambda p: p["line"]), " ").alias("text"))


def numbering_gaps(items: DataFrame, scope: list[str], order: str, value: str) -> DataFrame:
    """(scope, before, after, problem): neighbours whose numbers don't rise (``order``) or leave whole numbers
    out (``missing``); rows without a number are passed over."""
    w = Window.partitionBy(*scope).orderBy(order)
    rows = items.filter(F.col(value).isNotNull()).withColumn("before", F.lag(value).over(w)).withColumn("gap", F.col(value) - F.col("before"))
    problem = F.when(F.col("gap") <= 0, "order").when((F.col("gap") > 1) & (F.col("gap") == F.floor("gap")), "missing")
    return rows.withColumn("problem", problem).filter("problem is not null").select(*scope, order, "before", F.col(value).alias("after"), "problem")


#: Rule sets by jurisdiction; a plug-in adds its own with ``register_rules``.
RULESETS: dict[str, tuple[Rule, ...]] = {"generic": RULES}


def register_rules(name: str, rules: tuple[Rule, ...], extend: str | None = "generic") -> None:
    RULESETS[name] = (*rules, *(RULESETS[extend] if extend else ()))


def rules_for(name: str) -> tuple[Rule, ...]:
    """The rules of a jurisdiction, the generic ones if it is unknown."""
    return RULESETS.get(name, RULES)


def rules_from(config: list[dict]) -> tuple[Rule, ...]:
    """Rules from configuration entries with the fields of Rule; a level that doesn't exist is an error."""
    rules = tuple(Rule(**entry) for entry in config)
    if unknown := {r.level for r in rules} - set(LEVELS):
        raise ValueError(f"unknown levels: {sorted(unknown)}")
    return rules


def articles_by_page(found: DataFrame) -> DataFrame:
    """(document_id, page, articles): the ids of the articles that begin on each page, in order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("position", "article_id"))), lambda a: a["article_id"])
    return found.groupBy("document_id", "page").agg(ordered.alias("articles"))
