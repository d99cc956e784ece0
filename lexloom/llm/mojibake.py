"""Problem 8: find and restore text that was decoded with the wrong character encoding.

Adjacent character pairs are counted over the whole corpus, and each pair is scored by its mutual
information weighted with its own probability, log2(p(ab)^2 / (p(a) p(b))): text that was garbled by one
wrong table is a cipher of real text, so plain mutual information hardly tells it from the original,
whereas its pairs are always rare. Runs of improbable pairs are isolated as maximum-scoring segments,
and only inside those the inverse mappings (encode with the wrong table, decode with the right one,
again for double encoding) are tried; one is accepted if the restored pairs are clearly more frequent.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexloom.llm.tokenizer import blocks

# Single-byte tables in which text is wrongly read, and those in which it may have been written.
READ_AS = ("cp1252", "latin_1", "iso8859_15", "cp437", "cp850", "mac_roman", "cp1251", "cp1250")
WRITTEN_IN = ("cp1252", "cp850", "cp437", "mac_roman", "iso8859_15")
#: Of a single-byte mix-up, one table is of this family: files move between a desktop's table and these.
COMMON = {"cp1252", "latin_1", "iso8859_15"}
#: Signs that are not garbled letters when they stand alone.
LAYOUT = re.compile("[\xa0\xad\u200b-\u200d\u2009\u202f]+")
LOST = "�"
#: Segment scores: the level under which a pair counts as improbable, and the bounds of one pair's weight.
LEVEL, BEST, WORST = -8.0, 6.0, -3.0
#: A single-byte mapping must gain so many bits of pair frequency in all and lose at no pair more than LOSS, and
#: none of its pairs may score less than PLAUSIBLE.
GAIN, LOSS, PLAUSIBLE = 6.0, 1.0, -15.0
#: A multi-byte mapping, whose bytes already had to form valid sequences, may lose at most so many bits a pair.
MULTI_LOSS = 4.0


def byte_table(codec: str) -> list[str]:
    """Character of each byte; undefined bytes stand for the control character of the same number."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@lru_cache(maxsize=None)
def alphabet() -> np.ndarray:
    """Class of each code point below 65,536: 0 for U+0000, an own class for ASCII, for what a single-byte
    table can produce, combining marks and the replacement character; one class for all others."""
    own = {chr(i) for i in range(1, 128)} | {chr(i) for i in range(0x80, 0x100)} | {chr(i) for i in range(0x300, 0x370)}
    own |= {LOST} | {c for codec in (*READ_AS, *WRITTEN_IN) for c in byte_table(codec)}
    classes = np.ones(65536, np.int64)
    classes[0] = 0
    for k, c in enumerate(sorted(own - {"\0"})):
        classes[ord(c)] = k + 2
    return classes


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return alphabet()[np.minimum(points, 65535)]


def alphabet_size() -> int:
    return int(alphabet().max()) + 1


def pair_counts(df: DataFrame, text: str) -> DataFrame:
    """(pair, n) over all texts; at most alphabet_size() squared rows, a fixed number below a million."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = alphabet_size()
        total = np.zeros(k * k, np.int64)
        for batch in batches:
            for block in blocks(batch, "t"):
                c = classes_of("\0".join(t or "" for t in block.column(0).to_pylist()))
                if len(c) > 1:
                    total += np.bincount(c[:-1] * k + c[1:], minlength=k * k)
        inner = total.reshape(k, k)
        inner[0, :] = inner[:, 0] = 0
        (pair,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], names=["pair", "n"])

    counted = df.select(F.col(text).alias("t")).mapInArrow(run, "pair bigint, n bigint")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"))


class Restorer:
    """Segments and inverse mappings for one set of corpus pair counts."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray):
        k = self.k = alphabet_size()
        table = np.zeros(k * k, np.float64)
        table[pairs] = counts
        grid = table.reshape(k, k)
        total = max(1.0, table.sum())
        left, right = grid.sum(1) + 0.5, grid.sum(0) + 0.5
        joint = grid + 0.5
        info = 2 * np.log2(joint / total) - np.log2(left / total)[:, None] - np.log2(right / total)[None, :]
        self.info = info.ravel()
        self.weight = np.clip(LEVEL - info, WORST, BEST).astype(np.float32).ravel()
        # Unseen pairs count as half a sighting.
        self.bits = np.log2(joint).ravel()
        classes = alphabet()
        special = np.zeros(k, bool)
        for codec in READ_AS:
            special[[classes[ord(c)] for c in byte_table(codec)[128:]]] = True
        special[classes[ord(LOST)]] = True
        self.special = special
        either = (special[:, None] | special[None, :]).ravel()
        self.weight[~either] = WORST
        self.start = either & (self.weight > 0)
        self.decoders = self._decoders()
        self.known: dict[tuple[str, str, str], str | None] = {}

    @staticmethod
    def _decoders() -> list[tuple[dict[str, int], list[list[str]]]]:
        """For each wrong table: the byte of each character, and the right tables."""
        out = []
        for wrong in READ_AS:
            back = {c: b for b, c in reversed(list(enumerate(byte_table(wrong))))}
            if wrong != "latin_1":  # undefined bytes may have come through as control characters
                back = {chr(b): b for b in range(0x80, 0xA0)} | back
            out.append((back, [byte_table(r) for r in WRITTEN_IN if r != wrong and {r, wrong} & COMMON]))
        return out

    def pairs_of(self, text: str) -> np.ndarray:
        c = classes_of(text)
        return c[:-1] * self.k + c[1:]

    def _decoded(self, text: str) -> Iterator[tuple[str, bool]]:
        """(text, whether multi-byte) of every inverse mapping that the text allows."""
        for back, rights in self.decoders:
            raw = [back.get(c, -1) for c in text]
            if -1 in raw:
                continue
            data = bytes(raw)
            try:
                yield data.decode("utf-8"), True
            except UnicodeDecodeError:
                pass
            for right in rights:
                other = "".join([right[b] for b in raw])
                if not any("\x80" <= c <= "\x9f" for c in other):
                    yield other, False

    def _candidates(self, segment: str) -> dict[str, bool]:
        """All texts from which the segment may stem, multi-byte mappings applied up to three times."""
        out: dict[str, bool] = {}
        level = [segment]
        for depth in range(3):
            deeper = []
            for text in level:
                for original, multi in self._decoded(text):
                    if multi and original != text and original not in out:
                        out[original] = True
                        deeper.append(original)
                    elif not multi and depth == 0:
                        out.setdefault(original, False)
            level = deeper
        out.pop(segment, None)
        return out

    def restore(self, before: str, segment: str, after: str) -> str | None:
        """The segment's original text, or None if no inverse mapping makes it more probable."""
        key = (before, segment, after)
        if key not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[key] = self._best(before, segment, after)
        return self.known[key]

    def _best(self, before: str, segment: str, after: str) -> str | None:
        old = self.bits[self.pairs_of(before + segment + after)]
        choice, most = None, 0.0
        for text, multi in self._candidates(segment).items():
            pairs = self.pairs_of(before + text + after)
            if not len(pairs):
                continue
            new = self.bits[pairs]
            if multi:
                if len(text) < 3 and self._foreign(before, text, after):
                    continue  # one or two letters of another script are no evidence
                gain = float(new.mean() - old.mean())
                if gain < -MULTI_LOSS:
                    continue
                gain = (gain + MULTI_LOSS) * len(old) + GAIN
            else:
                step = new - old
                gain = float(step.sum())
                if gain < GAIN or float(step.min()) < -LOSS or float(self.info[pairs].min()) < PLAUSIBLE:
                    continue
            if gain > most:
                choice, most = text, gain
        return choice

    def _foreign(self, before: str, text: str, after: str) -> bool:
        """Whether a short original has signs of two bytes, or letters, that no single-byte table knows. Three or four bytes
        that form one valid sign, such as a narrow space, an arrow or an emoji, hardly do so by chance."""
        unknown = [c for c in text if alphabet()[min(ord(c), 65535)] == 1 or "\u0400" <= c <= "\u04ff"]
        return any(c < "\u0800" or unicodedata.category(c)[0] in "LM" for c in unknown)

    def segments(self, classes: np.ndarray) -> list[tuple[int, int]]:
        """Maximum-scoring segments as [first, last] pair positions, after Ruzzo and Tompa, over the improbable
        pairs and the gaps between them. A segment that no earlier one can extend settles all before it."""
        pairs = classes[:-1] * self.k + classes[1:]
        (starts,) = np.nonzero(self.start[pairs])
        if not len(starts):
            return []
        upto = np.concatenate(([0.0], np.cumsum(self.weight[pairs], dtype=np.float64)))
        settled: list[tuple] = []
        stack: list[tuple] = []  # first, last, score before, score after
        for at, low, high in zip(starts.tolist(), upto[starts].tolist(), upto[starts + 1].tolist()):
            item = (at, at, low, high)
            while True:
                j = len(stack) - 1
                while j >= 0 and stack[j][2] >= item[2]:
                    j -= 1
                if j < 0:
                    settled += stack
                    stack = [item]
                    break
                if stack[j][3] >= item[3]:
                    stack.append(item)
                    break
                item = (stack[j][0], item[1], stack[j][2], item[3])
                del stack[j:]
        return [(x[0], x[1]) for x in settled + stack]

    def passages(self, text: str, classes: np.ndarray) -> Iterator[tuple[int, int, str | None]]:
        """(begin, end, original) of each garbled stretch of ``text``, original None where bytes were lost.

        ``text`` may be several texts joined by U+0000, which belongs to no pair."""
        n, reached = len(text), 0
        special = self.special[classes]
        for first, last in self.segments(classes):
            inside = np.flatnonzero(special[first : last + 2])
            if not len(inside):
                continue
            begin, end = first + int(inside[0]), first + int(inside[-1]) + 1
            while begin > reached and special[begin - 1]:
                begin -= 1
            while end < n and special[end]:
                end += 1
            if begin < reached:
                continue
            reached = end
            yield from self._resolved(text, begin, end, special)

    def _resolved(self, text: str, begin: int, end: int, special: np.ndarray) -> Iterator[tuple[int, int, str | None]]:
        segment = text[begin:end]
        if LOST not in segment:
            if (found := self._around(text, begin, end)) is not None:
                yield found
                return
            if end - begin < 2 or special[begin:end].all():
                return
        # Runs of special signs one by one.
        at = begin
        while at < end:
            if not special[at]:
                at += 1
                continue
            stop = at + 1
            while stop < end and special[stop]:
                stop += 1
            run = text[at:stop]
            if LOST in run:
                if not _alone(text, at, stop):
                    yield at, stop, None
            elif (found := self._around(text, at, stop)) is not None:
                yield found
            at = stop

    def _around(self, text: str, begin: int, end: int) -> tuple[int, int, str] | None:
        if LAYOUT.fullmatch(text[begin:end]):
            return None
        if _QUOTED.fullmatch(text[begin:end].strip()) or _alone(text, begin, end):
            return None
        before, segment = text[begin - 1 : begin] if begin else "", text[begin:end]
        after = text[end : end + 1]
        before, after = before.strip("\0"), after.strip("\0")
        if (original := self.restore(before, segment, after)) is not None:
            shouted = text[max(0, begin - 2) : begin]
            if segment.isupper() and original.islower() and len(original) == len(segment) and _CAPITALS.fullmatch(shouted):
                return None  # a capital among capitals
            return begin, end, original
        # The no-break space that ended a sequence may have become a plain space.
        if after == " " and (original := self.restore(before, segment + "\xa0", text[end + 1 : end + 2])) is not None:
            return begin, end + 1, original
        return None


_CAPITALS = re.compile(r"[^\W\d_]{2}(?<=[^a-zà-öø-ÿ]{2})")
_QUOTED = re.compile(r"""[«"'“‘(\[]\s?\S\s?[»"'”’)\]]""")
_OPEN, _CLOSE = "«\"'“‘([", "»\"'”’)]"


def _alone(text: str, begin: int, end: int) -> bool:
    """Whether the sign is quoted by itself, so spoken about rather than garbled."""
    left, right = text[max(0, begin - 4) : begin].rstrip(), text[end : end + 4].lstrip()
    return left[-1:] in _OPEN and right[:1] in _CLOSE and bool(left) and bool(right)


def restored_texts(documents: DataFrame) -> DataFrame:
    """(doc_id, text, passages, lost): every document with at least one garbled passage, its text restored
    as far as possible, the number of garbled stretches and how many of them had lost bytes.

    Null and empty texts are never garbled; lost stretches keep their replacement characters; a doc_id that
    is null or repeated is treated row by row; extra columns are ignored; an empty table gives no rows.
    """
    spark = documents.sparkSession
    # Bounded by the alphabet, not by the corpus (see pair_counts).
    rows = pair_counts(documents, "text").toPandas()
    model = spark.sparkContext.broadcast((rows["pair"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(*model.value)
        for batch in batches:
            for block in blocks(batch, "text"):
                texts = block.column(1).to_pylist()
                out = [(i, *again(restorer, *r)) for i, r in enumerate(restored_block(restorer, texts)) if r is not None]
                ids = block.column(0).take(pa.array([i for i, *_ in out], pa.int64()))
                columns = [pa.array([r[k] for r in out], t) for k, t in ((1, pa.string()), (2, pa.int32()), (3, pa.int32()))]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "text", "passages", "lost"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, passages int, lost int"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def again(restorer: Restorer, text: str, marks: int, lost: int) -> tuple[str, int, int]:
    """A garbled text restored further, where one pass left passages within others."""
    for _ in range(3):
        more = restored_block(restorer, [text])[0]
        if more is None or more[1] == more[2]:
            break
        text, marks = more[0], marks + more[1] - more[2]
    return text, marks, lost


def restored_block(restorer: Restorer, texts: list[str | None]) -> list[tuple[str, int, int] | None]:
    """(restored text, garbled stretches, lost ones) of each text, None where nothing is garbled."""
    out: list[tuple[str, int, int] | None] = [None] * len(texts)
    joined = "\0".join((t or "").replace("\0", "\x01") for t in texts)
    if len(joined) < 2:
        return out
    ends = np.cumsum([len(t or "") + 1 for t in texts])
    found: dict[int, list[tuple[int, int, str | None]]] = {}
    for begin, end, original in restorer.passages(joined, classes_of(joined)):
        found.setdefault(int(np.searchsorted(ends, begin, "right")), []).append((begin, end, original))
    for i, marks in found.items():
        text, base = texts[i], int(ends[i]) - len(texts[i]) - 1
        parts, at = [], 0
        for begin, end, original in sorted(marks):
            parts += [text[at : begin - base], text[begin - base : end - base] if original is None else original]
            at = end - base
        out[i] = ("".join(parts) + text[at:], len(marks), sum(o is None for *_, o in marks))
    return out
