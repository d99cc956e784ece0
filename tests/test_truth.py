"""Queries without SQL against plain Python over the smallest test corpus."""

import hashlib
import re
import unicodedata
from pathlib import Path

import pytest

from lexloom.functions.numbers import MONTHS
from lexloom.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test corpus")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "document_id", "text", "text_hash").collect()


def test_stated_hashes(spark, documents):
    def agrees(d):
        if d.text is None:
            return None
        form = " ".join(unicodedata.normalize("NFKC", d.text).casefold().split())
        return hashlib.sha256(form.encode()).hexdigest() == d.text_hash.strip().lower().removeprefix("sha256:")

    got = {r.doc_id: r.agrees for r in QUERIES["stated_hash_agrees"](spark, FOLDER).collect()}
    assert got == {d.doc_id: agrees(d) for d in documents if d.text_hash is not None} and any(got.values())


def chunks_of(text, most, overlap):
    text = text.strip(" ")
    if len(text) <= most * 1.2:
        return [text]
    units = [s for s in (x.strip(" ") for x in re.split(r"(?<=[.;:!?])\s+(?=[A-ZÀ-Ü0-9«\"(-])", text)) if s]
    done, now = [], []
    for unit in units:
        if now and sum(len(u) + 1 for u in now) + len(unit) + 1 > most:
            done.append(" ".join(now))
            tail, size = [], 0
            for u in reversed(now):
                if tail and size + len(u) > overlap:
                    break
                tail.insert(0, u)
                size += len(u) + 1
            now = tail
        now.append(unit)
    return done + ([" ".join(now)] if now else [])


def test_sentence_chunks(spark, documents):
    got = {}
    for r in QUERIES["sentence_chunks"](spark, FOLDER).collect():
        got.setdefault(r.doc_id, {})[r.position] = r.text
    wanted = {d.doc_id: dict(enumerate(chunks_of(d.text, 1000, 100))) for d in documents if d.text and d.text.strip(" ")}
    assert got == wanted


def test_article_chunks(spark):
    articles = {r.article_id: r.text for r in QUERIES["articles"](spark, FOLDER).collect()}
    got = {}
    for r in QUERIES["article_chunks"](spark, FOLDER).collect():
        got.setdefault(r.article_id, {})[int(r.chunk_id.rsplit("_", 1)[1])] = r.text
    assert got == {a: dict(enumerate(chunks_of(t, 1500, 150))) for a, t in articles.items() if t.strip(" ")}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def folded(text):
    plain = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))
    return plain.replace("œ", "o").replace("æ", "a")


def test_dates_witnessed(spark, documents):
    texts = {d.document_id: d.text for d in documents}
    article = re.compile(r"(?im)^\s*(?:article|art\.)\s")

    def seen(text, date):
        parts = article.split(text)
        found = re.findall(r"([0-9]{1,2}(?:er)?)\s+([a-z0-9|]{3,10})\s+([0-9]{4})", folded(parts[0] + "\n" + parts[-1]))
        if date is None:
            return False
        target = MONTHS[int(date[5:7]) - 1]
        allowed = 0 if len(target) <= 4 else 1 if len(target) <= 7 else 2
        for day, month, year in found:
            away = distance(month, target)
            if int(day.removesuffix("er")) == int(date[8:10]) and year == date[:4] and away <= allowed and away < min(distance(month, m) for m in MONTHS if m != target):
                return True
        return False

    names = {True: {True: "both", False: "read"}, False: {True: "listed", False: "neither"}}
    rows = QUERIES["dates_witnessed"](spark, FOLDER).collect()
    assert rows
    for r in rows:
        assert r.witness == names[seen(texts[r.document_id], r.read)][seen(texts[r.document_id], r.listed)], r.document_id
