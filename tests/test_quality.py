from pyspark.sql import functions as F

from lexloom.operators import quality as Q, references as R


def values(spark, f, *cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, a string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("a"))).collect()]


def test_invented_readings(spark):
    loop = " ".join(["x1=-1 y"] * 25)
    got = values(spark, Q.invented, "Le texte de la loi", "le 条文 de", "The quick brown fox jumps over the lazy dog and that is it", "mot " * 25, loop, "12 " * 40, "", None, "long " * 3 + "texte " * 19)
    assert got == [None, "foreign script", "english line", "loop", "loop", None, None, None, None]


def test_issues_and_scores(spark):
    docs = spark.createDataFrame([("a", 3), ("b", 1), ("c", None)], "document_id string, page_count int")
    pages = spark.createDataFrame([("a", 1, "Du texte lisible"), ("a", 2, "  "), ("a", 2, "  "), ("b", 1, "a b c d e ■■■"), ("b", 1, "a b c d e ■■■")], "document_id string, page int, text string")
    issues = Q.page_issues(docs, pages)
    got = {(r.document_id, r.code, r.severity) for r in issues.collect()}
    assert got == {("a", "empty_pages", "error"), ("a", "missing_pages", "error"), ("b", "suspect_signs", "warning"), ("b", "fragments", "warning"), ("c", "no_pages", "error")}
    articles = spark.createDataFrame([("b", "x" * 30, 1.0), ("b", "y", None)], "document_id string, text string, value double")
    gaps = spark.createDataFrame([("b",)], "document_id string")
    structure = Q.structure_scores(articles, gaps)
    assert structure.first().structure == round(1 - 0.08 - 0.2 - 0.15, 4)
    text = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 0.0)], "document_id string, text_quality double")
    fields = spark.createDataFrame([("b", 1.0)], "document_id string, completeness double")
    scores = {r.document_id: (r.score, r.status) for r in Q.final_scores(text, structure, fields, issues).collect()}
    assert scores == {"a": (0.49, "failed"), "b": (round(0.5 + 0.35 * 0.57 + 0.15, 4), "review"), "c": (0.0, "failed")}
    assert [r.document_id for r in Q.review_queue(Q.final_scores(text, structure, fields, issues)).collect()] == ["c", "a", "b"]


def test_samples_and_selections(spark):
    pages = spark.createDataFrame([("d", i) for i in range(1, 24)] + [("e", 1), ("e", 2)], "document_id string, page int")
    got = sorted(r.page for r in Q.sampled_pages(pages, 5).filter("document_id = 'd'").collect())
    assert got == sorted({int(i * 23 / 5) + 1 for i in range(5)}) and Q.sampled_pages(pages, 5).filter("document_id = 'e'").count() == 2
    assert spark.range(1).select(Q.page_selection("1, 3,5-8,3,x,9-7")).first()[0] == [1, 3, 5, 6, 7, 8, 9]


def test_witnesses(spark):
    got = values(spark, R.address_reference, "https://x/doc/decret-2018-002", "https://x/doc/loi-2015%20-%2018/", "https://x/actes/5", None)
    assert [tuple(g) if g else None for g in got] == [("decret", "2018-002"), ("loi", "2015-18"), None, None]
    assert values(spark, R.forms, "1996-7", "2018-002/PR", "n° 5") == [["1996-007", "96-007"], ["2018-002", "2018-002/PR"], ["n°5"]]
    meta = spark.createDataFrame(
        [("a", "decret", "96-532", "https://x/doc/decret-1996-532"), ("b", "decret", "2016-292", "https://x/doc/decret-2016-711"), ("c", "loi", "9073-62", "https://x/doc/loi-1990-62"), ("d", "loi", "2001-5", None), ("e", "inconnu", "2001-5", None)],
        "document_id string, type string, number string, source_url string",
    )
    claims = {(r.document_id, r.number, r.strength) for r in R.claims(meta, 2030).collect()}
    assert claims == {("a", "1996-532", 2), ("a", "96-532", 2), ("c", "1990-062", 1), ("c", "90-062", 1), ("d", "2001-005", 0)}
    assert values(spark, R.common_root, "decret_1965_01", "decret_65_1_bis", "autre") == ["decret_1965_1", "decret_1965_1", "autre"]


def test_headings_put_right(spark):
    assert values(spark, R.rejoined_headers, "Article\n88\n:\nTexte", "Article 5 : x", "Art.\nIV\nsuite") == ["Article 88:\nTexte", "Article 5 : x", "Art. IV\nsuite"]
    assert values(spark, R.repaired_keywords, "Arlicle 4", "ArtIcIe premier", "l'article vu", "en 2O18", "SECTlON 2") == ["Article 4", "Article premier", "l'article vu", "en 2018", "SECTION 2"]
    got = values(spark, R.title, "RÉPUBLIQUE\nVu la loi portant x\nLOI PORTANT CRÉATION D'UN FONDS.\nArticle 1", "123\nUne ligne de substance\n", "Article 1 portant", "")
    assert [(g.value, g.confidence) if g else None for g in got] == [("Loi portant création d'un fonds", 0.85), ("Une ligne de substance", 0.4), ("Article 1 portant", 0.4), None]
