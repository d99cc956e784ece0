"""Readers that turn files into pages. PDF and recognition engines are plugged in by the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: A reader gets a file's name and bytes and returns (page, text, confidence or None) for each page.
Reader = Callable[[str, bytes], list[tuple[int, str, float | None]]]

READ = "source_path string, page int, text string, method string, ocr_confidence double, error string"


def plain_text(name: str, content: bytes) -> list[tuple[int, str, float | None]]:
    """UTF-8 text, pages parted by form feeds."""
    return [(i, t, None) for i, t in enumerate(content.decode("utf-8").split("\f"), 1)]


def read_pages(files: DataFrame, readers: Sequence[tuple[str, Reader]]) -> DataFrame:
    """files(source_path, content) as pages. The readers are tried in order; the first that succeeds gives the method;
    a file that none can read becomes one row with the errors of all, so that one bad file never stops the others."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["source_path"], batch["content"]):
                errors = []
                for method, reader in readers:
                    try:
                        rows += [(path, p, t, method, c, None) for p, t, c in reader(path, bytes(content))]
                        break
                    except Exception as e:  # noqa: BLE001
                        errors.append(f"{method}: {type(e).__name__}: {e}")
                else:
                    rows.append((path, None, None, None, None, "; ".join(errors) or "no reader"))
            yield pd.DataFrame(rows, columns=["source_path", "page", "text", "method", "ocr_confidence", "error"]).astype({"page": "Int32", "ocr_confidence": "Float64"})

    return files.select("source_path", "content").mapInPandas(run, READ)


def block_text(blocks: Column) -> Column:
    """Text of a page from its blocks(x, y, text): from top to bottom, then left to right."""
    ordered = F.array_sort(F.transform(blocks, lambda b: F.struct(F.round(b["y"], 1).alias("y"), F.round(b["x"], 1).alias("x"), b["text"].alias("text"))))
    return F.array_join(F.transform(ordered, lambda b: b["text"]), "\n")


def word_confidence(words: Column) -> Column:
    """Mean confidence of a recogniser's words(conf, text) over 100; words without text or score don't count."""
    scores = F.transform(F.filter(words, lambda w: (w["conf"] >= 0) & (F.trim(w["text"]) != "")), lambda w: w["conf"].cast("double"))
    return F.when(F.size(scores) > 0, F.aggregate(scores, F.lit(0.0), lambda a, c: a + c) / F.size(scores) / 100)


def by_route(routes: DataFrame, native: DataFrame, recognised: DataFrame, hybrid: DataFrame) -> DataFrame:
    """Pages of the reading that routes(document_id, route) names: native, ocr or hybrid."""
    parts = [("native", native), ("ocr", recognised), ("hybrid", hybrid)]
    chosen = [df.select("document_id", "page", "text").join(routes.filter(F.col("route") == r).select("document_id"), "document_id", "left_semi").withColumn("method", F.lit(r)) for r, df in parts]
    return chosen[0].unionByName(chosen[1]).unionByName(chosen[2])


def better_reading(first: DataFrame, second: DataFrame, key: str, items: str) -> DataFrame:
    """Per key the second reading where it has strictly more items, else the first."""
    s = second.select(key, F.col(items).alias("_s"))
    more = F.coalesce(F.size("_s"), F.lit(0)) > F.coalesce(F.size(items), F.lit(0))
    return first.join(s, key, "left").withColumn(items, F.when(more, F.col("_s")).otherwise(F.col(items))).drop("_s")


def kept_side_files(files: DataFrame, scores: DataFrame, policy: str) -> DataFrame:
    """Side files to delete under a policy: ``all`` keeps every one, ``none`` none, ``review`` those of documents that
    aren't ok."""
    if policy not in ("all", "review", "none"):
        raise ValueError("policy is all, review or none")
    if policy == "all":
        return files.limit(0)
    return files if policy == "none" else files.join(scores.filter("status <> 'ok'").select("document_id"), "document_id", "left_anti")
