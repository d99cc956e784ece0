import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.operators import chunks, citations, lines, metadata as M, structure as S, vectors
from lexloom.sources import readers as R


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_readers(spark):
    def broken(name, content):
        raise ValueError("unreadable")

    files = spark.createDataFrame([("a", b"un\x0cdeux"), ("b", b"\xff\xfe"), ("c", b"")], "source_path string, content binary")
    got = R.read_pages(files, [("engine", broken), ("text", R.plain_text)]).collect()
    assert {(r.source_path, r.page, r.text, r.method) for r in got} == {("a", 1, "un", "text"), ("a", 2, "deux", "text"), ("c", 1, "", "text"), ("b", None, None, None)}
    assert "engine" in next(r.error for r in got if r.source_path == "b")
    assert R.read_pages(files.limit(0), [("text", R.plain_text)]).count() == 0
    blocks = spark.createDataFrame([([(5.0, 9.01, "c"), (1.0, 2.0, "a"), (3.0, 2.0, "b")],)], "b array<struct<x:double,y:double,text:string>>")
    assert blocks.select(R.block_text(F.col("b"))).first()[0] == "a\nb\nc"
    words = spark.createDataFrame([([(90, "x"), (-1, "y"), (70, " "), (50, "z")],), ([],)], "w array<struct<conf:int,text:string>>")
    assert [r[0] for r in words.select(R.word_confidence(F.col("w"))).collect()] == [pytest.approx(0.7), None]


def test_routes_and_readings(spark):
    page = "document_id string, page int, text string"
    native, other = spark.createDataFrame([("a", 1, "n"), ("b", 1, "n")], page), spark.createDataFrame([("a", 1, "o"), ("b", 1, "o")], page)
    routes = spark.createDataFrame([("a", "native"), ("b", "ocr")], "document_id string, route string")
    assert rows(R.by_route(routes, native, other, other.limit(0))) == [("a", 1, "n", "native"), ("b", 1, "o", "ocr")]
    one, two = spark.createDataFrame([("a", ["x"]), ("b", ["x"]), ("c", [])], "k string, i array<string>"), spark.createDataFrame([("a", ["y", "z"]), ("b", ["y"])], "k string, i array<string>")
    assert rows(R.better_reading(one, two, "k", "i")) == [("a", ["y", "z"]), ("b", ["x"]), ("c", [])]
    files, scores = spark.createDataFrame([("a",), ("b",)], "document_id string"), spark.createDataFrame([("a", "ok"), ("b", "review")], "document_id string, status string")
    assert [R.kept_side_files(files, scores, p).count() for p in ("all", "review", "none")] == [0, 1, 2]


def test_more_cleaning(spark):
    df = spark.createDataFrame([("$ \\underline{\\text{Article 2}} $ **gras** <b>x</b>&nbsp;y", "le I5 mai, 2I juin et I loi", 1536)], "a string, b string, n bigint")
    a, b, n = df.select(T.without_reader_marks(F.col("a")), T.typewriter_ones(F.col("b")), T.human_size(F.col("n"))).first()
    assert "Article 2" in a and "\\" not in a and "gras x y" in a and b == "le 15 mai, 21 juin et I loi" and n == "1.5 KB"
    pages = spark.createDataFrame([("d", p, f"Journal officiel du pays\nligne {'abc'[p - 1]} du texte\nfin {'xyz'[p - 1]}\n{p}") for p in (1, 2, 3)], "document_id string, page int, t string")
    report = lines.cleaning_report(pages, lines.clean_pages(pages, "t"), "t").first()
    assert (report.pages, report.removed_lines, report.warning) == (3, 6, "much removed")


def test_rule_sets(spark):
    S.register_rules("isle", (S.Rule("article", "clause", 5, 400, body=True),))
    lines_ = spark.createDataFrame([("Clause 3 : texte",)], "line string")
    assert lines_.select(S.heading(F.col("line"), S.rules_for("isle")).alias("h")).first().h.level == "article"
    assert lines_.select(S.heading(F.col("line"), S.rules_for("nowhere")).alias("h")).first().h is None
    assert S.rules_from([{"level": "titre", "keyword": "part", "priority": 1}])[0].level == "titre"
    with pytest.raises(ValueError):
        S.rules_from([{"level": "nothing", "keyword": "x", "priority": 1}])
    found = spark.createDataFrame([("d", 1, 2, "b"), ("d", 1, 1, "a"), ("d", 2, 3, "c")], "document_id string, page int, position int, article_id string")
    assert rows(S.articles_by_page(found)) == [("d", 1, ["a", "b"]), ("d", 2, ["c"])]


def test_article_chunks(spark):
    df = spark.createDataFrame([("d", "a1", "Un.\na) deux\nb) trois"), ("d", "a2", "Une phrase ici. " * 20)], "document_id string, article_id string, text string")
    whole = chunks.article_chunks(df, "article", 100, 10).orderBy("position").collect()
    assert whole[0].chunk_id == "a1_chunk_000" and [c.position for c in whole] == list(range(len(whole))) and len(whole) > 3
    assert chunks.article_chunks(df, "paragraph").filter("article_id = 'a1'").count() == 3
    assert chunks.article_chunks(df, "fixed", 50, 5).count() > 6
    with pytest.raises(ValueError):
        chunks.article_chunks(df, "other")


def test_embedding_model(spark):
    def model():
        return lambda texts: np.array([[len(t), t.count("a")] for t in texts], np.float32)

    df = spark.createDataFrame([("c1", "d", "aa"), ("c2", "d", None), ("c3", "d", "")], "chunk_id string, document_id string, text string")
    got = {r.chunk_id: (r.vector, r.dimension) for r in vectors.embedded(df, model, "m").collect()}
    assert got == {"c1": ([2.0, 2.0], 2), "c3": ([0.0, 0.0], 2)}


def test_more_fields(spark):
    df = spark.createDataFrame([("Le ministre des mines arrête", "arrete"), ("rien", "loi"), ("rien", "autre")], "t string, k string")
    got = [r.a for r in df.select(M.authority(F.col("t"), F.col("k"), {"ministre": "ministre des mines"}, {"loi": "assemblée"}).alias("a")).collect()]
    assert [(g.value, g.confidence) if g else None for g in got] == [("ministre", 0.8), ("assemblée", 0.75), None]
    text = "Fait le 5 decernbre 1967 " + "x " * 10
    seen = spark.createDataFrame([(text, "1967-12-05", "1967-12-06"), ("le 3 juin 1999", "1999-07-03", "1999-06-03"), ("", "1999-06-03", None)], "t string, a string, b string")
    assert [r[0] for r in seen.select(M.third_witness(F.col("a"), F.col("b"), F.col("t"))).collect()] == ["read", "listed", "neither"]


def test_edges_and_excerpts(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "s string, t string")
    assert citations.touching(edges, "s", "t", spark.createDataFrame([("b",), (None,)], "document_id string")).count() == 2
    one = spark.createDataFrame([("avant  le\nmot ici après",)], "t string")
    assert one.select(citations.excerpt(F.col("t"), F.lit(10), F.lit(13), 4)).first()[0] == "le mot ici"
