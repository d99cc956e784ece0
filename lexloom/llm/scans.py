"""Problem 3: repair text from scanned pages.

Words are counted over all pages, separately for scanned and other ones. A word's stroke key replaces
every letter by the strokes that a scanner may read differently (rn and m, cl and d, l, 1 and | are
the same), so words with one key are a few plausible glyph edits apart. Words that only scanned pages
have are linked to frequent neighbours with the same key. A skip-gram model with negative sampling is trained on the counts
of all pairs of neighbouring words of all pages; the vectors of words that share a stroke key are the sums of the learnt
context vectors around them on all pages. They decide between several neighbours and on words that are rare but real. Words
below the vocabulary have no vectors, but their counts, and those of their neighbours, are joined to each page that may need
them. Then running lines and page numbers are taken from head and foot, broken words joined and lines reflowed into
paragraphs.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexloom.llm.tokenizer import blocks
from lexloom.plans.staging import stage

SCANNED = ("ocr", "mixed")
#: A word belongs to the vocabulary with this share of all words (so it has at most 500,000) and at least MIN_COUNT.
MIN_SHARE, MIN_COUNT = 2e-6, 3
DIM, WINDOW = 32, 2
#: The skip-gram model has the most frequent words as contexts, which bounds its pairs, and is trained on all of theirs.
#: Frequent words are thinned out to this share.
CONTEXTS, SUBSAMPLE, NEGATIVES = 20_000, 1e-3, 5
#: Each side of the model is fitted so often; a vector is held back with this share of a word's mean weight.
ROUNDS, RIDGE = 3, 0.03
#: Words fitted at once, and contexts they are compared with at once; this bounds a task's memory.
ROWS, COLUMNS = 256, 4096
#: A neighbour must be so many times more frequent than the word it corrects; for real words the context must
#: also prefer it by this difference of cosines.
RATIO, REAL_RATIO, MARGIN = 8.0, 2.0, 0.2

# Signs that scanners put in place of letters, and strokes of letters and signs that get mixed up.
STROKES = {
    "i": "i", "l": "i", "1": "i", "|": "i", "!": "i", "t": "i", "†": "i", "‡": "i", "f": "i", "£": "i", "j": "i", "r": "i", "ſ": "i", "ı": "i",
    "n": "ii", "u": "ii", "h": "ii", "m": "iii", "w": "vv", "d": "ci", "c": "c", "e": "c", "(": "c", "¢": "c", "6": "c", "b": "c",
    "o": "o", "0": "o", "s": "s", "5": "s", "y": "v", "v": "v", "g": "q", "q": "q", "9": "q", "8": "a8", "2": "z", "z": "z",
}
UMLAUT = {"ü": "ii"}
SIGNS = "01569|†£("
HYPHENS = "\\-\u2010\u2011\xad\xac"  # for character classes
_WORD = re.compile(r"[^\s'’‘`´\",.;:?«»“”\[\]{}<>=/\\+*~°–—_%&#@…]+")
_EDGE = "()!-\u2010\u2011|"
_BREAK = re.compile(rf"[{HYPHENS}][ \t\xa0]*\r?\n\s*(\S+)")
_ROMAN = re.compile(r"[ivxlcdm]+")


_STROKE_TABLE = str.maketrans(STROKES | {chr(c): "" for c in range(0x300, 0x370)})


def strokes(word: str) -> str:
    """The word's stroke key; accents don't count."""
    for c, stroke in UMLAUT.items():
        word = word.replace(c, stroke)
    return unicodedata.normalize("NFD", word).translate(_STROKE_TABLE)


def words_of(text: str) -> list[str]:
    """Lower-case words without the parts of words broken at line ends; compounds keep their hyphens."""
    text = unicodedata.normalize("NFC", text).lower()
    parts, at = [], 0
    for m in _BREAK.finditer(text):
        begin = m.start()
        while begin > at and not text[begin - 1].isspace():
            begin -= 1
        parts.append(text[at:begin])
        at = m.end()
    return _WORD.findall(" ".join((*parts, text[at:])) if parts else text)


def _counted(df: DataFrame) -> DataFrame:
    """(word, native, scanned) over all pages."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for block in blocks(batch, "body"):
                for scanned in (False, True):
                    texts = [t for t, s in zip(block.column(0).to_pylist(), block.column(1).to_pylist()) if t and s == scanned]
                    counts[scanned].update(words_of("\n\n".join(texts)))
                if len(counts[0]) + len(counts[1]) > 500_000:  # hand over what has gathered
                    yield _emit(counts)
        yield _emit(counts)

    def _emit(counts) -> pa.RecordBatch:
        words = list(counts[0].keys() | counts[1].keys())
        native, scanned = ([c[w] for w in words] for c in counts)
        counts[0].clear()
        counts[1].clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(native, pa.int64()), pa.array(scanned, pa.int64())], names=["word", "native", "scanned"])

    rows = df.select("body", "scanned").mapInArrow(run, "word string, native bigint, scanned bigint")
    return rows.groupBy("word").agg(F.sum("native").alias("native"), F.sum("scanned").alias("scanned"))


@dataclass
class Lexicon:
    """The vocabulary with its counts and, once learnt, the context vectors of its frequent words and the vectors of the
    words whose context may have to decide."""

    words: list[str]
    native: np.ndarray
    scanned: np.ndarray
    least: float = MIN_COUNT
    contexts: dict[str, int] = field(default_factory=dict)
    near: np.ndarray | None = None  # one row per context word
    contested: dict[str, int] = field(default_factory=dict)
    vectors: np.ndarray | None = None  # one row per contested word


def _pair_codes(ids: np.ndarray, size: int) -> np.ndarray:
    """A number for each pair of known words within the window of which one at least is a context: smaller * size + larger for
    two contexts, word * size + context for another word; -1 is an unknown word, and contexts are below ``size``."""
    out = []
    for k in range(1, WINDOW + 1):
        low, high = np.minimum(ids[:-k], ids[k:]), np.maximum(ids[:-k], ids[k:])
        known = (low >= 0) & (low < size)
        low, high = low[known], high[known]
        out.append(np.where(high < size, low * size + high, high * size + low))
    return np.concatenate(out)


def _added_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, count = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code)
    code = code[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return code[first], np.add.reduceat(count[order], first)


def _pair_counts(pages: DataFrame, numbers: dict[str, int], size: int) -> DataFrame:
    """(id, context array, n array): how often each context stands around each numbered word on all pages; one row a word."""
    shared = pages.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, gap = shared.value.get, [-1] * WINDOW
        codes, counts, held = [], [], 0
        for batch in batches:
            for block in blocks(batch, "body", 1_000_000):
                ids: list[int] = []
                for t in block.column(0).to_pylist():
                    if t:
                        ids += [number(w, -1) for w in words_of(t)]
                        ids += gap
                code, count = np.unique(_pair_codes(np.array(ids, np.int64), size), return_counts=True)
                codes.append(code)
                counts.append(count)
                held += len(code)
                if held > 4_000_000:
                    code, count = _added_up(codes, counts)
                    codes, counts, held = [code], [count], len(code)
                    if held > 2_000_000:  # hand over what has gathered
                        yield _emit(codes, counts)
                        codes, counts, held = [], [], 0
        if held:
            yield _emit(codes, counts)

    def _emit(codes: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _added_up(codes, counts)], names=["code", "n"])

    counted = pages.select("body").mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    a, b = (F.expr(f"cast(code {op} {max(1, size)} as int)") for op in ("div", "%"))
    counted = counted.select(a.alias("a"), b.alias("b"), "n")
    # Two contexts stand around each other; a word beside itself does so twice.
    both = F.when(F.col("a") >= size, F.expr("array(struct(a as id, b as context, n))")).otherwise(F.expr("array(struct(a as id, b as context, n), struct(b as id, a as context, n))"))
    directed = counted.select(F.explode(both).alias("p")).groupBy("p.id").agg(F.collect_list(F.struct("p.context", "p.n")).alias("around"))
    rows = directed.select("id", F.col("around.context").alias("context"), F.col("around.n").alias("n"))
    return stage(rows.repartition(-(-max(1, len(numbers)) // ROWS), F.expr(f"id div {ROWS}")).sortWithinPartitions("id"), "word-pairs")


_UPPER = np.triu_indices(DIM)


def newton_step(own: np.ndarray, other: np.ndarray, seen: np.ndarray, mass: np.ndarray, share: np.ndarray) -> np.ndarray:
    """One Newton step of the vectors ``own`` towards the best ones given ``other`` in a skip-gram model with negative sampling:
    ``seen`` are the weights of the pairs, mass x share those of the negatives, of which nothing is drawn: each pair has its
    expected number of them."""
    slope, bend = -RIDGE * own, np.zeros((len(own), len(_UPPER[0])), np.float32)
    for at in range(0, len(other), COLUMNS):
        o, hit = other[at : at + COLUMNS], seen[:, at : at + COLUMNS]
        p = 1 / (1 + np.exp(-np.clip(own @ o.T, -30, 30)))
        every = hit + mass[:, None] * share[None, at : at + COLUMNS]
        slope += (hit - every * p) @ o
        bend += (every * p * (1 - p)) @ (o[:, _UPPER[0]] * o[:, _UPPER[1]])
    matrix = np.empty((len(own), DIM, DIM))
    matrix[:, _UPPER[0], _UPPER[1]] = matrix[:, _UPPER[1], _UPPER[0]] = bend
    step = np.linalg.solve(matrix + RIDGE * np.eye(DIM), slope[:, :, None].astype(np.float64))[:, :, 0]
    length = np.linalg.norm(step, axis=1, keepdims=True)
    return (own + step * np.minimum(1, 3 / np.maximum(length, 1e-9))).astype(np.float32)


def _blocks_of_rows(batches: Iterable[pa.RecordBatch], keep: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, weights) of ROWS neighbouring ids at most; the weights have a column for each context and are thinned out."""

    def dense(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((len(rows), len(keep)), np.float32)
        for line, (i, context, n) in zip(out, rows):
            np.add.at(line, context, n * keep[context] * keep[i])
        return np.array([r[0] for r in rows], np.int64), out

    rows: list[tuple[int, np.ndarray, np.ndarray]] = []
    for batch in batches:
        for i, context, n in zip(*batch.columns):
            i = i.as_py()
            if rows and (rows[-1][0] // ROWS != i // ROWS or len(rows) == ROWS):
                yield dense(rows)
                rows = []
            rows.append((i, context.values.to_numpy(), n.values.to_numpy()))
    if rows:
        yield dense(rows)


def _learnt(pairs: DataFrame, lexicon: Lexicon, frequent: np.ndarray) -> None:
    """Trains the context vectors on the counts of all pairs: words and contexts are fitted in turn, each given the other side
    only, so a step is a map over rows of words and hands over one vector for each of CONTEXTS words at most."""
    size, spark = len(frequent), pairs.sparkSession
    lexicon.near = np.zeros((size, DIM), np.float32)
    pairs = pairs.filter(F.col("id") < size)
    count = (lexicon.native + lexicon.scanned)[frequent].astype(np.float64)
    keep = np.minimum(1, np.sqrt(SUBSAMPLE * count.sum() / count)).astype(np.float32)
    # Negatives are as likely as the counts to the power of 3/4.
    chance = (count**0.75 / (count**0.75).sum()).astype(np.float32)

    def mapped(of_block, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, float rows) of of_block(ids, weights) over all blocks."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, seen in _blocks_of_rows(batches, keep):
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()]), pa.array([of_block(ids, seen).astype(np.float32).tobytes()])], names=["ids", "v"])

        rows = pairs.mapInArrow(run, "ids binary, v binary").collect()
        ids = np.concatenate([np.frombuffer(r.ids, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
        return ids, np.concatenate([np.frombuffer(r.v, np.float32) for r in rows]).reshape(-1, width) if rows else np.zeros((0, width), np.float32)

    met, sums = mapped(lambda ids, seen: seen.sum(axis=1, dtype=np.float64), 1)
    if not len(met):
        return
    mass = np.zeros(size, np.float32)
    mass[met] = sums[:, 0]
    mean = float(sums.mean(dtype=np.float64))
    mass /= mean
    rng = np.random.default_rng(11)
    words, contexts = np.zeros((size, DIM), np.float32), (rng.random((size, DIM)) - 0.5).astype(np.float32)
    contexts[mass == 0] = 0

    def fitted(own: np.ndarray, other: np.ndarray, side: np.ndarray, across: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast((own, other, side, across))

        def of_block(ids: np.ndarray, seen: np.ndarray) -> np.ndarray:
            own, other, side, across = shared.value
            return newton_step(own[ids], other, seen / np.float32(mean), side[ids], across)

        ids, rows = mapped(of_block, DIM)
        shared.unpersist()
        out = own.copy()
        out[ids] = rows
        return out

    for _ in range(ROUNDS):
        words = fitted(words, contexts, NEGATIVES * mass, chance)
        contexts = fitted(contexts, words, NEGATIVES * chance, mass)
    lexicon.near = contexts - contexts.mean(0)


def _contested(lexicon: Lexicon) -> dict[str, int]:
    """Words whose stroke key another possible correction has: only between those may the context decide."""
    by_key: dict[str, list[str]] = {}
    for w, native, scanned in zip(lexicon.words, lexicon.native, lexicon.scanned):
        if (native >= MIN_COUNT or scanned >= 50) and len(w) >= 3:
            by_key.setdefault(strokes(w), []).append(w)
    return {w: i for i, w in enumerate(sorted(w for ws in by_key.values() if len(ws) > 1 for w in ws))}


def _vectors(pairs: DataFrame, lexicon: Lexicon, numbers: dict[str, int]) -> np.ndarray:
    """Summed context vectors of every contested word over all pages. They are added as whole numbers, so that the sums don't
    depend on their order."""
    place = {numbers[w]: i for w, i in lexicon.contested.items()}
    shared = pairs.sparkSession.sparkContext.broadcast((place, np.round(lexicon.near * 1000).astype(np.int64)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, near = shared.value
        for batch in batches:
            ids, total = [], []
            for i, context, n in zip(*batch.columns):
                if (at := place.get(i.as_py())) is not None:
                    ids.append(at)
                    total.append(n.values.to_numpy() @ near[context.values.to_numpy()])
            sums = np.array(total, np.int64).reshape(-1, DIM)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(sums[:, k]) for k in range(DIM))], names=["id", *(f"v{k}" for k in range(DIM))])

    rows = pairs.mapInArrow(run, "id bigint, " + ", ".join(f"v{k} bigint" for k in range(DIM))).toPandas()  # one row per contested word of the vocabulary
    out = np.zeros((len(lexicon.contested), DIM), np.float64)
    if len(rows):
        out[rows["id"].to_numpy()] = rows.drop(columns="id").to_numpy(np.float64)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def learn(pages: DataFrame) -> tuple[Lexicon, DataFrame]:
    """The lexicon of pages(body, scanned), whose size is bounded by MIN_SHARE, whatever the corpus, and the counts of
    all rarer words."""
    counts = stage(_counted(pages), "word-counts")
    total = counts.agg(F.sum(F.col("native") + F.col("scanned")).alias("n")).first()["n"] or 0
    least = max(MIN_COUNT, MIN_SHARE * total)
    counts = counts.filter(F.col("word").rlike("\\p{L}"))
    rows = counts.filter(F.col("native") + F.col("scanned") >= least).orderBy("word").toPandas()
    lexicon = Lexicon(rows["word"].tolist(), rows["native"].to_numpy(np.int64), rows["scanned"].to_numpy(np.int64), least)
    lexicon.contested = _contested(lexicon)
    frequent = np.argsort(-(lexicon.native + lexicon.scanned), kind="stable")[:CONTEXTS]
    lexicon.contexts = {lexicon.words[i]: k for k, i in enumerate(frequent)}
    numbers = dict(lexicon.contexts)
    for w in lexicon.contested:
        numbers.setdefault(w, len(numbers))
    pairs = _pair_counts(pages, numbers, len(frequent))
    _learnt(pairs, lexicon, frequent)
    lexicon.vectors = _vectors(pairs, lexicon, numbers)
    return lexicon, counts.filter(F.col("native") + F.col("scanned") < least)


#: Before the first part of a compound, where forms are looked up; no word has it.
LEAD = "\n"


class Forms:
    """The forms of a page's words that a repair may look up and whose counts the lexicon doesn't settle."""

    def __init__(self, lexicon: Lexicon):
        # A neighbour below the vocabulary can only outweigh words that other pages have less often than that.
        self.settled = {w for w, n in zip(lexicon.words, lexicon.native) if n * REAL_RATIO >= lexicon.least}
        self.of_token: dict[str, list[str]] = {}

    def of(self, token: str) -> list[str]:
        out = self.of_token.get(token)
        if out is None:
            if len(self.of_token) > 200_000:
                self.of_token.clear()
            raw = token.lower()
            word = raw.strip(_EDGE)
            forms = {raw, word, raw.strip(")-\u2010\u2011"), *word.split("-")} - self.settled
            self.of_token[token] = out = [w for w in forms if any(map(str.isalpha, w))]
        return out

    def of_page(self, text: str, before: str, after: str) -> set[str]:
        text = unicodedata.normalize("NFC", text)
        out = {w for token in set(_WORD.findall(text)) for w in self.of(token)}
        # Parts at line ends are joined to a line below it; which one is known once the furniture is gone.
        pages = [[x for x in re.split(r"[\n\f]", t or "") if x.strip()] for t in (before, text, after)]
        lines = [*pages[0][-ZONE - 1 :], *pages[1], *pages[2][: ZONE + 1]]
        for at, line in enumerate(lines):
            if (m := _cut_word(line)) is None:
                continue
            left = m[1].lower()
            out.add(LEAD + left)
            for other in lines[at + 1 : at + 2 * ZONE + 2]:
                right = other.split(None, 1)[0].lower()
                bare = right.rstrip(".,;:!?)»")
                for whole in (left + right, left + bare, f"{left}-{bare}", f"{left}-{right}"):
                    out.update(w for w in (whole, *(w for token in _WORD.findall(whole) for w in self.of(token))) if w not in self.settled)
        return out


def _keyed_words(df: DataFrame) -> DataFrame:
    """df(word, ...) with the stroke keys of its words."""
    names = df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([strokes(w) for w in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*names, "key"])

    return df.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in df.dtypes) + ", key string")


def _rare_words(given: DataFrame, rare: DataFrame, model) -> DataFrame:
    """(row, rare): for each row of given(row, body, before, after) the words below the vocabulary that its repair may need
    as (word, native, scanned): its own and those of like stroke key. Words are joined once each, then rows to them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = Forms(model.value)
        for batch in batches:
            for block in blocks(batch, "body"):
                cols = [c.to_pylist() for c in block.columns]
                pairs = [(i, w) for i, t, a, b in zip(*cols) if t for w in sorted(forms.of_page(t, a, b))]
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.string())], names=["row", "word"])

    texts = given.select("row", "body", F.col("before.lines").alias("before"), F.col("after.lines").alias("after"))
    forms = stage(texts.mapInArrow(run, "row bigint, word string"), "page-forms")
    names = forms.select("word").distinct()
    entry = F.struct("rare", "native", "scanned").alias("entry")
    rare = rare.withColumnRenamed("word", "rare")
    own = names.join(rare.filter(f"native >= {MIN_COUNT} or scanned > 1"), F.col("word") == F.col("rare")).select("word", entry)
    strong = rare.filter(f"native >= {MIN_COUNT} or scanned >= 50").filter((F.length("rare") >= 3) & ~F.col("rare").rlike(f"[{re.escape(SIGNS)}]"))
    strong = _keyed_words(strong)
    near = _keyed_words(names.filter(~F.col("word").startswith(LEAD))).join(strong, "key").select("word", entry)
    leads = rare.filter(f"native >= {MIN_COUNT} and contains(rare, '-')").select(F.concat(F.lit(LEAD), F.substring_index("rare", "-", 1)).alias("rare")).distinct()
    leads = names.join(leads, F.col("word") == F.col("rare")).select("word", F.struct("rare", F.lit(MIN_COUNT).cast("bigint").alias("native"), F.lit(0).cast("bigint").alias("scanned")).alias("entry"))
    by_word = stage(own.union(near).union(leads).groupBy("word").agg(F.collect_set("entry").alias("entries")), "rare-words")
    return forms.join(by_word, "word").groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("entries"))).alias("rare"))


def bare(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word) if not "\u0300" <= c <= "\u036f")


def few_edits(word: str, other: str) -> bool:
    """Whether the words differ by one glyph edit (at most two letters on either side), or by two in a long word."""
    a, b = (bare(w) for w in (word, other))
    if a == b:
        return True
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    s = 0
    while s < min(len(a), len(b)) - p and a[-1 - s] == b[-1 - s]:
        s += 1
    x, y = a[p : len(a) - s], b[p : len(b) - s]
    if len(x) <= 2 and len(y) <= 2:
        return True
    # Two places: the middle begins and ends with an edit and agrees for at least two letters between them.
    return len(b) >= 7 and any(x[i : len(x) - k] == y[j : len(y) - m] and len(x) - i - k >= 2 for i in (1, 2) for j in (1, 2) for k in (1, 2) for m in (1, 2))


# The bar of a wiki link or template, with a capital behind it, is no letter.
_PIPED = re.compile(r"[^\W\d_]\|[A-ZÀ-Þ]|^\d+\|")


class Repairer:
    """Finds and repairs the defects of a page, given a lexicon."""

    #: Letters of scanned words; others come from wrong encodings, not from scanners.
    LETTERS = re.compile(r"[a-zàâäçéèêëîïôöùûüœãõáíóúñ0-9|†£()'-]+")

    def __init__(self, lexicon: Lexicon):
        self.words = lexicon.words
        self.index = {w: i for i, w in enumerate(lexicon.words)}
        self.native, self.scanned, self.vectors = lexicon.native, lexicon.scanned, lexicon.vectors
        self.contexts, self.near, self.contested = lexicon.contexts, lexicon.near, lexicon.contested
        self.real = {w: int(n) for w, n in zip(lexicon.words, lexicon.native) if n >= MIN_COUNT}
        self.by_key: dict[str, list[str]] = {}
        # Words of furniture stand on scanned pages only; they count if they are frequent there.
        self.strength = np.where(self.native >= MIN_COUNT, self.native, self.scanned / 4)
        for i in np.flatnonzero((self.native >= MIN_COUNT) | (self.scanned >= 50)):
            word = self.words[i]
            if not any(c in SIGNS for c in word) and len(word) >= 3:
                self.by_key.setdefault(strokes(word), []).append(word)
        self.leads = {w.split("-", 1)[0] for w in self.real if "-" in w}
        self.tokens: dict[str, bool] = {}
        self.fates: dict[str, tuple[list[str], bool]] = {}
        self.turn(())

    def turn(self, rare: Iterable[dict]) -> None:
        """Turns to a page, given the rare words that may matter on it."""
        self.rare = {x["rare"]: (x["native"], x["scanned"]) for x in rare}
        self.rare_by_key: dict[str, list[str]] = {}
        for w, (native, scanned) in self.rare.items():
            if (native >= MIN_COUNT or scanned >= 50) and len(w) >= 3 and w[0] != LEAD and not any(c in SIGNS for c in w):
                self.rare_by_key.setdefault(strokes(w), []).append(w)
        self.own_fates: dict[str, tuple[list[str], bool]] = {}

    def native_count(self, word: str) -> int:
        """How often other pages have a word, 0 if it isn't real."""
        n = self.real.get(word, 0) or self.rare.get(word, (0, 0))[0]
        return n if n >= MIN_COUNT else 0

    def strength_of(self, word: str) -> float:
        if (i := self.index.get(word)) is not None:
            return float(self.strength[i])
        native, scanned = self.rare[word]
        return float(native) if native >= MIN_COUNT else scanned / 4

    def alike(self, word: str) -> list[str]:
        """Frequent words of the same stroke key, in their order."""
        key = strokes(word)
        known, rare = self.by_key.get(key, []), self.rare_by_key.get(key, [])
        return sorted({*known, *rare}) if rare else known

    def likeness(self, word: str, context: np.ndarray) -> float:
        """Cosine of a word's vector with a context; words that aren't contested have no vector."""
        i = self.contested.get(word)
        return float(self.vectors[i] @ context) if i is not None else 0.0

    def strongest(self, words: list[str]) -> str:
        return max(words, key=self.strength_of)

    def neighbours(self, word: str) -> tuple[list[str], bool]:
        """(frequent words one or few glyph edits away, whether ``word`` itself may be real)."""
        # What rare words have a part in holds for the page only.
        fates = self.own_fates if self.rare and (word in self.rare or strokes(word) in self.rare_by_key) else self.fates
        if word in fates:
            return fates[word]
        if len(fates) > 200_000:
            fates.clear()
        own = self.native_count(word)
        least = own * REAL_RATIO if own else 0
        if not own:
            mine = self.index.get(word)
            seen = int(self.scanned[mine]) if mine is not None else max(1, self.rare.get(word, (0, 1))[1])
            signs = any(c in SIGNS for c in word)
            least = seen / (4 if signs else 1) * (RATIO if not signs else 1)
            if len(word) <= 3 and not signs:
                least = max(least, 50)
        near = self.alike(word) if self.LETTERS.fullmatch(word) else ()
        out = [w for w in near if w != word and self.strength_of(w) >= max(least, MIN_COUNT) and few_edits(word, w)]
        fates[word] = out, own > 0
        return fates[word]

    def plain(self, token: str) -> bool:
        """Whether a token can be passed over: a real word without a more frequent neighbour, or no word."""
        known = self.tokens.get(token)
        if known is None:
            if len(self.tokens) > 200_000:
                self.tokens.clear()
            raw = token.lower()
            word = raw.strip(_EDGE)
            if not any(c.isalpha() for c in word) or _PIPED.search(token):
                known = True
            elif self.native_count(word):
                known = len(word) < 5 or not self.neighbours(word)[0]
                if word in self.rare or strokes(word) in self.rare_by_key:
                    return known
            else:
                return False
            self.tokens[token] = known
        return known

    def context(self, words: list[str], at: int) -> np.ndarray | None:
        total = np.zeros(DIM, np.float64)
        for k in range(1, WINDOW + 1):
            for j in (at - k, at + k):
                if 0 <= j < len(words) and (i := self.contexts.get(words[j])) is not None:
                    total += self.near[i]
        norm = np.linalg.norm(total)
        return total / norm if norm else None

    def correction(self, word: str, words: list[str], at: int) -> str | None:
        """What ``word`` was misread from, the word itself where that isn't known but it is misread, or None."""
        if len(word) < 3 or _ROMAN.fullmatch(word):
            return None
        candidates, real = self.neighbours(word)
        if real:
            candidates = [w for w in candidates if abs(len(w) - len(word)) <= 1]
            if len(word) < 5 or not candidates or word not in self.contested:  # without a vector the context can't tell
                return None
            context = self.context(words, at)
            if context is None:
                return None
            best = max(candidates, key=lambda w: self.likeness(w, context))
            return best if self.likeness(best, context) > self.likeness(word, context) + MARGIN else None
        if candidates:
            if len(candidates) == 1:
                return candidates[0]
            context = self.context(words, at)
            if context is None:
                return self.strongest(candidates)
            return max(candidates, key=lambda w: self.likeness(w, context) + 0.05 * np.log(self.strength_of(w)))
        return word if _SIGN_INSIDE.search(word) and self.LETTERS.fullmatch(word) else None

    def misread(self, text: str, first_is_part: bool = False) -> Iterator[tuple[int, int, str]]:
        """(begin, end, correction) of misread words; broken words must have been joined before. The first
        word may be the end of one that a page which didn't arrive began."""
        if all(map(self.plain, set(_WORD.findall(text)))):
            return
        found = list(_WORD.finditer(text))[first_is_part:]
        lower = [m[0].lower() for m in found]
        for at, (m, raw) in enumerate(zip(found, lower)):
            if self.plain(m[0]):
                continue
            word = raw.strip(_EDGE)
            if (fixed := self._fix(raw, word, lower, at)) is not None:
                part, new = fixed
                begin = m.start() + raw.find(part)
                yield begin, begin + len(part), _like(m[0][raw.find(part) : raw.find(part) + len(part)], new)

    def _fix(self, raw: str, word: str, words: list[str], at: int) -> tuple[str, str] | None:
        if "-" in word and not self.native_count(word):
            whole = self.neighbours(word)[0]
            if whole:
                return word, self.strongest(whole)
            for part in word.split("-"):
                if part and not self.native_count(part) and (new := self.correction(part, words, at)) is not None:
                    return part, new
            return None
        if not self.native_count(word) and raw != word:  # a bracket or bar may be a letter
            bare = raw.strip(")-\u2010\u2011")
            if "(" not in bare or ")" not in raw:
                for form in (bare, raw):
                    if form != word and (near := self.neighbours(form)[0]):
                        return form, self.strongest(near)
        new = self.correction(word, words, at)
        return None if new is None else (word, new)

    def joined(self, left: str, right: str) -> str | None:
        """The whole word if ``left`` and ``right`` are its parts, None for a compound parted at its hyphen."""
        a, b = left.lower(), right.lower().rstrip(".,;:!?)»")
        whole, compound = self.native_count(a + b), self.native_count(f"{a}-{b}")
        if not whole and not compound:
            whole, compound = len(self.alike(a + b)), len(self.alike(f"{a}-{b}"))
        if compound > whole or not whole and not compound and right[:1].isupper() and not left.isupper():
            return None
        return left + right


_SIGN_INSIDE = re.compile(r"[^\W\d_][0156|†‡£¢][^\W\d_]|^[†‡£¢|][^\W\d_]{2}|[^\W\d_]{2}[†‡£¢|]$")


def _like(old: str, new: str) -> str:
    letters = [c for c in old if c.isalpha()]
    if len(letters) > 1 and sum(c.isupper() for c in letters) > len(letters) / 2:
        return new.upper()
    return new[:1].upper() + new[1:] if old[:1].isupper() and not old[1:2].isupper() and old[:1] != "I" else new


# Head and foot.

ZONE = 3
_NUMBER = r"(?:\d{1,4}|[ivxlc]{1,7}|(?=[lIoO|]{0,3}\d)[\dlIoO|]{1,4})"
_PAGE_NUMBER = re.compile(
    rf"[-–—.•|~*\[(<]*\s*{_NUMBER}\s*[-–—.•|~*\])>]*|(?:p|pp|pag|page|pagina|página|folio|fol|f°|feuillet|fo1io|foIio)\s*\.?\s*{_NUMBER}(?:\s*(?:sur|de|of|/)\s*{_NUMBER})?|\d{{1,4}}\s*/\s*\d{{1,4}}",
    re.I,
)
_BESIDE = re.compile(
    rf"^(?:[-–—.\[(]*\s*{_NUMBER}\s*[-–—.\])]*|(?:p\.|page|folio)\s*\d+(?:\s*(?:sur|/)\s*\d+)?|\d+\s*/\s*\d+)\s+(?=\S{{2}})"
    rf"|\s+(?:[-–—.\[(]+\s*{_NUMBER}\s*[-–—.\])]+|\d{{1,4}}|(?:p\.|page|folio)\s*\d+(?:\s*(?:sur|/)\s*\d+)?|\d+\s*/\s*\d+)$",
    re.I,
)


#: A page number between dashes before a running line; without it the line would look like an item of a list.
_BEFORE = re.compile(rf"^[-–—•*~.]+\s*{_NUMBER}\s*[-–—•*~.]+\s+(?=\S)", re.I)
_APART = re.compile(rf"^[ \t]*[-–—.\[(]*\s?{_NUMBER}\s?[-–—.\])]*(?:\s{{4,}}|\t)(?=\S)|\S(?:\s{{4,}}|\t)[-–—.\[(]*\s?{_NUMBER}\s?[-–—.\])]*$", re.I)


def is_page_number(line: str) -> bool:
    line = " ".join(line.split())
    if re.fullmatch(r"\d{1,4}\.", line) or re.fullmatch(r"[ivxlc]+[.)]", line, re.I):
        return False  # the end of a sentence, or an enumeration
    return bool(_PAGE_NUMBER.fullmatch(line))


@lru_cache(50_000)
def line_key(line: str) -> str:
    """A line without numbers and spaces in strokes; empty for lines that can't be running lines."""
    line = " ".join(unicodedata.normalize("NFC", line).split())
    if line[-1:] in ".;:," or is_page_number(line) or _UNIT.match(_BEFORE.sub("", line)):
        return ""
    words = [w.strip("()[]-–—.,;:|") for w in line.lower().split()]
    words = [w for w in words if w and not re.fullmatch(r"[\d/.,-]+|n[°ºo]\.?", w)]
    words = [w for i, w in enumerate(words) if not (i in (0, len(words) - 1) and _ROMAN.fullmatch(w))]
    key = strokes(re.sub(r"[^\w|†‡£(¢€]", "", "".join(words)))
    return key if len(key) >= 5 else ""


def zone_keys(text: str | None) -> list[str]:
    if not text:
        return []
    lines = [x for x in re.split(r"[\n\f]", text) if x.strip()]
    ends = [*lines[:ZONE], *lines[max(ZONE, len(lines) - ZONE) :]]
    return sorted({k for x in ends if (k := line_key(x))})


def furniture(lines: list[str], running: set[str]) -> tuple[dict[int, bool], bool, bool]:
    """(lines to take out, whether a running line is among them, whether a page number is)."""
    filled = [i for i, line in enumerate(lines) if line.strip()]
    out: dict[int, bool] = {}
    run = number = False
    for side in (filled[:ZONE], filled[::-1][:ZONE]):
        for i in side:
            if i in out:
                break
            if _APART.search(lines[i].rstrip()):  # a number set apart from whatever else the line says
                number = True
            if is_page_number(lines[i]):
                out[i] = number = True
            elif line_key(lines[i]) in running and line_key(lines[i]):
                out[i] = run = True
                number = number or bool(_BESIDE.search(" ".join(lines[i].split())))
            else:
                break
    return out, run, number


_UNIT = re.compile(
    r"\s*(?:(?:art(?:icle|igo|\.)|titre|title|t[ií]tulo|chapitre|chapter|cap[ií]tulo|section|sec[cç][aã]o|annexe?|anexo|vu\b|considerando|having regard|fait à|done at|feito em)\b|\d{1,3}\s*[°º.)]|[a-z]\)|[-–•*] )",
    re.I,
)


def reflow(lines: list[str]) -> str:
    """Continuous paragraphs from lines: a blank line, a unit or a finished sentence before a capital parts them."""
    out: list[str] = []
    last = ""
    for line in lines:
        body = " ".join(line.split())
        if not body:
            last = ""
            continue
        fresh = not out or not last or _UNIT.match(body) or last[-1] in ".;:!?" and body[:1].isupper()
        if fresh:
            out.append(body)
        else:
            out[-1] += " " + body
        last = body
    return "\n".join(out)


def _near(page: dict | None) -> tuple[str, set[str]] | None:
    return (page["lines"] or "", set(page["running"] or ())) if page else None


Near = tuple[str, set[str]] | None


def repair(r: Repairer, text: str, running: set[str], before: Near, after: Near) -> tuple[str, list[str], int]:
    """(repaired text, defects, corrected words). ``before`` and ``after`` are the ends of the neighbouring
    pages and their running lines, if they arrived; a word that goes over to the next page is completed where it begins."""
    defects: list[str] = []
    lines = re.split(r"[\n\f]", unicodedata.normalize("NFC", text))
    gone, run, number = furniture(lines, running)
    body = [line.rstrip() for i, line in enumerate(lines) if i not in gone]
    if run:
        defects.append("running_line")
    if number:
        defects.append("page_number")
    if before is not None and (head := _first_body(body)) is not None and (tail := _last_line(*before)) is not None:
        if (m := _cut_word(tail)) and r.joined(m[1], body[head].split()[0]) is not None:
            body[head] = " " + " ".join(body[head].split()[1:])
    broken = False
    for i in range(len(body)):
        m = _cut_word(body[i])
        if m is None:
            continue
        j = next((j for j in range(i + 1, len(body)) if body[j].strip()), None)
        if j is not None:
            right, rest = (body[j].split(None, 1) + [""])[:2]
        else:
            first = _first_line(*after) if after is not None else None
            right, rest = (first.split(None, 1)[0] if first else ""), None
            if not right:
                broken = broken or m[2] != "-" or not (m[1].lower() in r.leads or LEAD + m[1].lower() in r.rare)
                continue
        if not right[:1].isalpha() and right[:1] not in SIGNS:
            continue
        whole = m[1] + right if m[2] in "\xad\xac" else r.joined(m[1], right)
        if whole is None:
            whole = f"{m[1]}-{right}"
        else:
            broken = True
        body[i] = body[i][: m[0]] + whole
        if rest is not None:
            body[j] = rest
    if broken:
        defects.append("broken_word")
    flat = "\n".join(body)
    parts, at, n = [], 0, 0
    for begin, end, new in r.misread(flat, before is None and _PART.match(flat) is not None):
        parts += [flat[at:begin], new]
        at, n = end, n + 1
    if n or any(True for i in gone if not is_page_number(lines[i]) for _ in r.misread(lines[i])):
        defects.append("misread")
    return reflow(("".join(parts) + flat[at:]).split("\n")), defects, n


_PART = re.compile(r"\s*[^\W\d_A-ZÀ-Þ]")
_HYPHEN_SIGNS = "-\u2010\u2011\xad\xac"
_WORD_STOPS = frozenset("'’\"«»(")


def _cut_word(line: str) -> tuple[int, str, str] | None:
    """(position, part, hyphen) of the word part that a hyphen at the line's end cuts off."""
    line = line.rstrip(" \t\xa0\r")
    if not line or line[-1] not in _HYPHEN_SIGNS:
        return None
    begin = end = len(line) - 1
    while begin > 0 and not line[begin - 1].isspace() and line[begin - 1] not in _WORD_STOPS:
        begin -= 1
    part = line[begin:end]
    if not part or not (part[-1].isalpha() or part[-1] in "|†£") or not any(c.isalpha() for c in part):
        return None
    return begin, part, line[end]


def _first_body(lines: list[str]) -> int | None:
    return next((i for i, x in enumerate(lines) if x.strip()), None)


def _first_line(text: str, running: set[str]) -> str | None:
    lines = text.split("\n")
    gone = furniture(lines, running)[0]
    return next((x.strip() for i, x in enumerate(lines) if x.strip() and i not in gone), None)


def _last_line(text: str, running: set[str]) -> str | None:
    lines = text.split("\n")
    gone = furniture(lines, running)[0]
    return next((x for i, x in reversed(list(enumerate(lines))) if x.strip() and i not in gone), None)


def repaired_pages(pages: DataFrame) -> DataFrame:
    """(document_id, page, text, defects, corrected) of every scanned page.

    ``defects`` are those of broken_word, misread, running_line and page_number that the page shows;
    ``text`` is the page in continuous paragraphs, without furniture, words whole and corrected. Pages are
    read from raw_text, or text where that is null; where both are null, text is null without defects.
    Repeated rows count once; pages of other methods only lend their words; empty tables give no rows; extra
    columns are ignored.
    """
    spark = pages.sparkSession
    body = F.coalesce("raw_text", "text")
    scanned = F.coalesce(F.col("method").isin(*SCANNED), F.lit(False))
    every = pages.select("document_id", "page", body.alias("body"), scanned.alias("scanned"))
    lexicon, rare = learn(every.select("body", "scanned").filter("body is not null"))
    model = spark.sparkContext.broadcast(lexicon)
    scans = every.filter("scanned").select("document_id", "page", "body").distinct()

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([zone_keys(t) for t in batch.column(2).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys], names=["document_id", "page", "keys"])

    zone = every.filter("scanned and body is not null").select("document_id", "page", "body")
    zone = zone.mapInArrow(keyed, "document_id string, page int, keys array<string>")
    zone = stage(zone.select("document_id", "page", F.explode_outer("keys").alias("key")).filter("key is not null"), "zone-keys")
    often = zone.groupBy("document_id", "key").agg(F.countDistinct("page").alias("n")).filter("n > 1").select("document_id", "key")
    running = zone.join(often, ["document_id", "key"], "left_semi").groupBy("document_id", "page").agg(F.collect_set("key").alias("running"))

    lines = F.filter(F.split("body", "[\\n\\f]"), lambda x: x.rlike("\\S"))
    head, tail = F.slice(lines, 1, ZONE + 2), F.expr(f"slice(lines, greatest(1, size(lines) - {ZONE + 1}), {ZONE + 2})")
    ends = scans.filter("document_id is not null and page is not null and body is not null").withColumn("lines", lines)
    ends = ends.groupBy("document_id", "page").agg(F.min(F.struct(F.array_join(head, "\n").alias("head"), F.array_join(tail, "\n").alias("tail"))).alias("e"))
    ends = stage(ends.join(running, ["document_id", "page"], "left").select("document_id", "page", "e.*", "running"), "page-ends")
    # Neighbours by their page numbers: joins on (document, page), so no document becomes one task.
    before = ends.select("document_id", (F.col("page") + 1).alias("page"), F.struct(F.col("tail").alias("lines"), "running").alias("before"))
    after = ends.select("document_id", (F.col("page") - 1).alias("page"), F.struct(F.col("head").alias("lines"), "running").alias("after"))
    own = ends.select("document_id", "page", "running")
    key = ["document_id", "page"]
    given = scans.join(own, key, "left").join(before, key, "left").join(after, key, "left").select(*key, "body", "before", "after", "running")
    given = stage(given.withColumn("row", F.monotonically_increasing_id()), "scanned-pages")
    given = given.join(_rare_words(given, rare, model), "row", "left").select(*key, "body", "before", "after", "running", "rare")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Repairer(model.value)
        for batch in batches:
            for block in blocks(batch, "body"):
                cols = [block.column(k).to_pylist() for k in range(2, 7)]
                done = []
                for t, a, b, k, rare in zip(*cols):
                    r.turn(rare or ())
                    done.append(repair(r, t, set(k or ()), _near(a), _near(b)) if t is not None else (None, [], 0))
                out = [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.list_(pa.string())), pa.array([d[2] for d in done], pa.int32())]
                yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), *out], names=["document_id", "page", "text", "defects", "corrected"])

    return given.mapInArrow(run, "document_id string, page int, text string, defects array<string>, corrected int")
