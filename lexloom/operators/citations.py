"""Citations between acts: found by a small grammar, resolved through a reference index, applied to their targets.

An act is named by a kind and a number. A relation stands before it (``abroge le décret n° 71-15``) or, in the passive,
behind it (``le décret n° 71-15 est abrogé``). Where an agent follows, ``par la loi ...``, it is that agent which acts and
not the document, so nothing is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.functions.numbers import reference

# Kinds of acts, relations with the stems of their verbs, the state a relation gives its target, and the
# order of states.
CITED_KINDS = ("loi", "décret", "arrêté", "ordonnance", "code", "constitution", "décision", "convention", "accord")
VERBS = {"modifie": "modifi", "abroge": "abrog", "remplace": "remplac", "complete": "complét"}
RELATIONS = ("cite", *VERBS, "abroge_partiellement", "applique")
STATE_OF = {"abroge": "abroge", "abroge_partiellement": "partiellement_abroge", "remplace": "remplace", "modifie": "modifie"}
SEVERITY = ("inconnu", "en_vigueur", "modifie", "partiellement_abroge", "remplace", "abroge")


def _loose(word: str) -> str:
    """A pattern for ``word`` that takes its accents as optional."""
    plain = {"é": "[ée]", "ê": "[êe]", "à": "[àa]", "è": "[èe]"}
    return "".join(plain.get(c, c) for c in word)


_KIND = "(?:" + "|".join(map(_loose, CITED_KINDS)) + ")s?"
_THE = "(?:(?:la|le|les|du|de\\s+la|des)\\s+|(?:de\\s+)?l['’]\\s*)?"
_NUMBER = "[0-9]{2,4}\\s*[-–/_]\\s*[0-9]{1,4}"
ACT = f"{_KIND}(?:\\s+(?:organique|constitutionnelle))?\\s+n[°ºo\"'.]*\\s*{_NUMBER}"
_AGENT = f"(\\s+par\\s+{_THE}{_KIND})?"
_BE = "(?:est|sont|demeure|demeurent)\\s+(?:et\\s+\\p{L}+\\s+)?"
_FILLER = "(?:les\\s+dispositions\\s+|certaines\\s+dispositions\\s+|partiellement\\s+)?"


PATTERN_OF_RECITALS = f"(?iu)\\bvu\\s+{_THE}({ACT})"


def _patterns() -> list[tuple[str, str, int]]:
    """(relation, pattern, group of the target); a further group holds what forbids the match: an agent or ``partly``."""
    out = [("cite", f"(?iu)\\bvu\\s+{_THE}({ACT})()", 1)]
    out.append(("applique", f"(?iu)\\b(?:pour\\s+l['’]\\s*|en\\s+)application\\s+d[eu]s?\\s+{_THE}({ACT})()", 1))
    for relation, stem in VERBS.items():
        stem = _loose(stem)
        partly = "(partiellement\\s+)?" if relation == "abroge" else "()"
        # Active forms only: a participle with an agent has "par" behind it and so no act in this place.
        out.append((relation, f"(?iu)\\b{stem}(?:e|ent|ant|eant|ation)\\s+{partly}(?:(?:les|certaines)\\s+dispositions\\s+)?{_THE}({ACT})", 2))
        behind = f"({ACT})\\s+{_BE}{stem}[ée]e?s?{_AGENT}"
        out.append((relation, f"(?iu)(?:\\bl['’]\\s*article\\s+[0-9]+\\s+)?{behind}" if relation != "abroge" else f"(?iu)(?:^|[^\\p{{L}}])(?:article\\s+[0-9]+\\s+{_THE})?{behind}", 1))
    stem = _loose(VERBS["abroge"])
    out.append(("abroge_partiellement", f"(?iu)\\b{stem}(?:e|ent|eant)\\s+partiellement\\s+{_THE}({ACT})()", 1))
    return out


_PARTLY = f"(?iu)\\bl['’]\\s*article\\s+[0-9]+\\s+{_THE}({ACT})\\s+{_BE}{_loose(VERBS['abroge'])}[ée]e?s?{_AGENT}"


def relations_in(text: Column) -> Column:
    """Array of struct(relation, target) of a text, in one expression."""
    anything = text.rlike(f"(?iu){ACT}")

    def hits(relation: str, pattern: str, target: int) -> Column:
        names, forbidden = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (target, 3 - target))
        free = F.filter(F.arrays_zip(names.alias("t"), forbidden.alias("f")), lambda x: x["f"] == "")
        return F.transform(free, lambda x: F.struct(F.lit(relation).alias("relation"), x["t"].alias("target")))

    found = F.concat(*[hits(*p) for p in _patterns()], hits("abroge_partiellement", _PARTLY, 1))
    # An article of an act that is repealed is a partial repeal of the act.
    partly = F.transform(F.filter(found, lambda x: x["relation"] == "abroge_partiellement"), lambda x: x["target"])
    whole = F.filter(found, lambda x: ~((x["relation"] == "abroge") & F.array_contains(partly, x["target"])))
    return F.when(anything, whole)


def citations(pages: DataFrame, text: str = "text") -> DataFrame:
    """(document_id, relation, target_reference, kind, number, page): each relation and target once per document,
    where it first stands. Repeated page rows change nothing."""
    rows = pages.select("document_id", "page", F.explode(relations_in(F.col(text))).alias("x")).select("document_id", "page", "x.*")
    first = rows.groupBy("document_id", "relation", F.lower("target").alias("key")).agg(F.min(F.struct("page", "target")).alias("f"))
    first = first.select("document_id", "relation", F.col("f.target").alias("target_reference"), F.col("f.page").alias("page"))
    return first.withColumn("r", reference(F.col("target_reference"))).select("document_id", "relation", "target_reference", "r.kind", "r.number", "page")


def reference_index(claims: DataFrame) -> DataFrame:
    """(kind, number, target, ambiguous) of claims(kind, number, document_id, strength): the strongest claim
    holds; several documents of equal strength make the reference ambiguous. Independent of the claims' order."""
    best = claims.groupBy("kind", "number").agg(F.max("strength").alias("strength"))
    top = claims.join(best, ["kind", "number", "strength"])
    index = top.groupBy("kind", "number").agg(F.min("document_id").alias("target"), F.max("document_id").alias("_z"))
    return index.select("kind", "number", F.when(F.col("target") == F.col("_z"), F.col("target")).alias("target"), (F.col("target") != F.col("_z")).alias("ambiguous"))


def resolve(relations: DataFrame, index: DataFrame) -> DataFrame:
    """citations() with target, outcome (resolved, self, ambiguous, unresolved), confidence and needs_review."""
    base = F.when(F.col("kind").isNull(), 0.35).when(F.col("relation") == "cite", 0.60).otherwise(0.80)
    joined = relations.join(index, ["kind", "number"], "left")
    outcome = (
        F.when(F.col("target").isNotNull() & (F.col("target") == F.col("document_id")), "self")
        .when(F.col("target").isNotNull(), "resolved").when(F.col("ambiguous"), "ambiguous").otherwise("unresolved")
    )
    confidence = (
        F.when(F.col("outcome") == "resolved", F.least(base + 0.15, F.lit(0.99))).when(F.col("outcome") == "self", 0.20)
        .when(F.col("outcome") == "ambiguous", 0.35).otherwise(base)
    )
    out = joined.withColumn("outcome", outcome).withColumn("confidence", F.round(confidence, 2))
    needs = (F.col("outcome") != "resolved") | (F.col("confidence") < 0.80)
    return out.withColumn("needs_review", needs).select(*relations.columns, F.when(F.col("outcome") == "resolved", F.col("target")).alias("target"), "outcome", "confidence", "needs_review")


def severity(status: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SEVERITY)), status) - 1


def strongest(edges: DataFrame, target: str, status: str, confidence: str) -> DataFrame:
    """(target, status, confidence): per target the state of highest severity, then confidence."""
    ranked = edges.withColumn("_s", F.struct(severity(F.col(status)).alias("s"), F.col(confidence).alias("c"), F.col(status).alias("v")))
    return ranked.groupBy(target).agg(F.max("_s").alias("m")).select(target, F.col("m.v").alias(status), F.col("m.c").alias(confidence))


def induced(resolved: DataFrame) -> DataFrame:
    """(target, state, confidence): what the resolved relations of other acts make of an act."""
    state = F.create_map(*[F.lit(x) for pair in STATE_OF.items() for x in pair])
    edges = resolved.filter("outcome = 'resolved'").withColumn("state", F.try_element_at(state, F.col("relation"))).filter("state is not null")
    return strongest(edges.select("target", "state", "confidence"), "target", "state", "confidence")


def versions(df: DataFrame, group: list[str], *order: str) -> DataFrame:
    """Rows of groups of two or more with ``version`` from 1 in the given order (nulls first)."""
    w = Window.partitionBy(*group).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    rows = df.filter(" and ".join(f"{g} is not null" for g in group)).withColumn("version_no", F.row_number().over(w))
    return rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*group))).filter("_n > 1").drop("_n")


def covering(points: DataFrame, ranges: DataFrame, key: str, at: str, first: str, last: str, item: str, order: str) -> DataFrame:
    """Each point with the last range of the same key that covers it (null if none)."""
    r = ranges.select(key, F.col(first).alias("_f"), F.col(last).alias("_l"), F.col(item).alias("_i"), F.col(order).alias("_o"))
    hit = points.join(r, (points[key] == r[key]) & points[at].between(F.col("_f"), F.col("_l")), "left").drop(r[key])
    return hit.groupBy(*points.columns).agg(F.max(F.struct("_o", "_i")).alias("m")).select(*points.columns, F.col("m._i").alias(item))


def touching(edges: DataFrame, source: str, target: str, documents: DataFrame) -> DataFrame:
    """Edges with one of documents(document_id) at either end."""
    ids = documents.select(F.col("document_id").alias("_d")).filter("_d is not null").distinct()
    at_source = edges.join(ids, F.col(source) == F.col("_d"), "left_semi")
    at_target = edges.join(ids, F.col(target) == F.col("_d"), "left_semi")
    other = at_target.join(ids, F.col(source) == F.col("_d"), "left_anti")
    return at_source.unionByName(other)


def excerpt(text: Column, begin: Column, end: Column, window: int = 120) -> Column:
    """The passage [begin, end) with ``window`` characters on either side, white space collapsed."""
    left = F.greatest(begin - window, F.lit(0))
    return F.trim(F.regexp_replace(F.substring(text, left + 1, end + window - left), "\\s+", " "))


def unresolved(relations: DataFrame) -> DataFrame:
    return relations.filter("needs_review").orderBy("confidence", "document_id", "target_reference")
