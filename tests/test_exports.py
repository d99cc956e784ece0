from pyspark.sql import functions as F

from lexloom.operators import dedup, structure
from lexloom.plans.staging import new_folder
from lexloom.sources import sinks


def test_folders_without_stale_copies(spark):
    path = new_folder(spark, "folders")
    frame = lambda rows: spark.createDataFrame(rows, "id string, kind string, text string")
    sinks.replace_in_folders(frame([("a", "loi", "1"), ("b", "loi", "2"), ("c", "décret/x", "3")]), path, "id", "kind")
    sinks.replace_in_folders(frame([("a", "arrete", "4"), ("c", "arrete", "5")]), path, "id", "kind")
    got = sorted(tuple(r) for r in spark.read.schema("id string, kind string, text string").json(path).select("id", "kind", "text").collect())
    assert got == [("a", "arrete", "4"), ("b", "loi", "2"), ("c", "arrete", "5")]  # a folder that became empty is gone


def test_articles_carry_their_document(spark):
    pages = spark.createDataFrame([("d", 1, "TITRE I\nChapitre 2\nArticle 1 : Un texte.\nCHAPITRE 3\nArticle 2 : Un autre."), ("e", 1, "Article 1 : Seul.")], "document_id string, page int, text string")
    meta = spark.createDataFrame([("d", "Loi", "loi", "1-2", None, None, "x", "fr")], "document_id string, title string, type string, number string, date string, status string, jurisdiction string, language string")
    files = spark.createDataFrame([("d", "d.pdf", "/in/d.pdf"), ("d", "d2.pdf", "/in/d2.pdf")], "document_id string, filename string, source_path string")
    rows = structure.with_context(structure.articles(pages), structure.tree(structure.headings(pages)))
    got = {r.article_id: (r.titre, r.chapitre, r.hierarchy_path) for r in rows.collect()}
    assert got == {"d_article_1": ("TITRE I", "CHAPITRE 2", ["TITRE I", "CHAPITRE 2"]), "d_article_2": ("TITRE I", "CHAPITRE 3", ["TITRE I", "CHAPITRE 3"]), "e_article_1": (None, None, [])}
    records = {r.article_id: (r.document_title, r.source_file) for r in sinks.article_records(rows, meta, files).collect()}
    assert records == {"d_article_1": ("Loi", "d.pdf"), "d_article_2": ("Loi", "d.pdf"), "e_article_1": (None, None)}


def test_links_of_all_kinds(spark):
    base = " ".join(f"mot{i}" for i in range(200))
    docs = [(1, "h1", base), (2, "h1", "autre"), (3, None, base), (4, None, base + " fin"), (5, None, " ".join(f"mot{i}" for i in range(80))), (6, "", None), (7, None, "")]
    df = spark.createDataFrame(docs, "id bigint, h string, t string")
    got = {(r.id, r.duplicate_of, r.kind) for r in dedup.find_duplicates(df, "id", F.col("h"), F.col("t"), "t").collect()}
    assert got == {(2, 1, "file_hash"), (3, 1, "text_hash"), (4, 1, "similarity"), (5, 1, "partial"), (5, 4, "partial")}
    assert dedup.find_duplicates(df.limit(0), "id", F.col("h"), F.col("t"), "t").count() == 0
