"""Shingle sets of texts in numpy blocks, made anew from the texts in each pass: 64 bits a shingle are several times as much as
the text in its file, so no table of all shingles is ever written or shuffled.

What a pass knows of the whole corpus are tables of a fixed size: a count per shingle bucket, which gives the order of prefixes
(any order that all sets share is exact, a coarse one only makes more candidates), and bit fields of keys or shingles, which
let some through that aren't needed and never stop one that is.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType

WORDS = 5
#: Bits of the number of a count's bucket and of a place in a bit field; each is sent in BLOCKS packed parts.
BUCKET_BITS, FIELD_BITS, BLOCKS = 24, 27, 64
#: Words that are handled at once, and pairs in a batch.
AT_ONCE, PAIRS = 1_000_000, 200_000

Batches = Iterable[pa.RecordBatch]

_unpacked: dict[str, np.ndarray] = {}


class Shared:
    """A table of fixed size that is sent packed to the workers, each of which unpacks it once. ``drop()`` removes all copies."""

    def __init__(self, spark: SparkSession, table: np.ndarray):
        self._name = uuid.uuid4().hex
        self._sent = spark.sparkContext.broadcast(zlib.compress(table.tobytes(), 1))

    @property
    def value(self) -> np.ndarray:
        if self._name not in _unpacked:
            while len(_unpacked) > 1:
                _unpacked.pop(next(iter(_unpacked)))
            _unpacked[self._name] = np.frombuffer(zlib.decompress(self._sent.value), np.uint8)
        return _unpacked[self._name]

    def drop(self) -> None:
        self._sent.destroy()


def rows_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t) of the rows that have both."""
    return df.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))


#: A word; the signs in front are of its class anyway and are found without asking for their properties.
WORD = "(?U)[abcdefghijklmnopqrstuvwxyz0123456789éèàçùêâîôû\\w]+"


def hashed_words(rows: DataFrame) -> DataFrame:
    """(k, w): the hashes of a text's words in order. White space is in no word, so lower case is enough of the form for comparing."""
    return rows.select("k", F.transform(F.regexp_extract_all(F.lower("t"), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)).alias("w"))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(x, n): the sorted distinct hashes of the runs of WORDS words of each text, of all its words where there are fewer, one
    text after the other, and their number by text. ``ends``: 0 and where each text ends in ``words``."""
    length = np.diff(ends)
    size = np.where(length >= WORDS, length - WORDS + 1, np.minimum(length, 1))
    begin = np.concatenate(([0], np.cumsum(size)))
    x = np.empty(begin[-1], np.uint64)
    for m in range(1, WORDS + 1):
        texts = np.flatnonzero(length >= WORDS if m == WORDS else length == m)
        each = size[texts]
        into = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        first, h = np.repeat(ends[texts], each) + into, np.full(len(into), m, np.uint64)
        for j in range(m):
            h = (h ^ words[first + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        x[np.repeat(begin[texts], each) + into] = _mixed(h, 0)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        x[a:b].sort()
    text = np.repeat(np.arange(len(length)), size)
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (text[1:] != text[:-1])
    return x[new], np.bincount(text[new], minlength=len(length))


def _sets(batches: Batches) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(keys, x, n) of blocks of texts that have words."""
    for batch in batches:
        keys, lists = batch.column(0), batch.column(1)
        ends = lists.offsets.to_numpy().astype(np.int64)
        words = lists.values.to_numpy().view(np.uint64)
        at = 0
        while at < len(keys):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + AT_ONCE, "right")) - 1)
            x, n = shingles(words[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
            some = np.flatnonzero(n)
            if len(some):
                yield keys.slice(at, to - at).take(pa.array(some)), x, n[some]
            at = to


def _bounds(n: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(n)))


def _lists(x: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(_bounds(n), pa.int32()), pa.array(x))


def _parts(table: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The blocks of a table of fixed size that aren't empty."""
    for block, part in enumerate(np.split(table, BLOCKS)):
        if part.any():
            yield block, zlib.compress(part.tobytes(), 1)


def _total(parts: DataFrame, kind: type, length: int, join: Callable, last: Callable = lambda x: x) -> np.ndarray:
    """The table whose parts are joined per block, in the workers; its size is fixed, so the driver may hold it."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(part), kind)
                blocks[block] = join(blocks[block], part) if block in blocks else part
        for block, part in blocks.items():
            yield pa.record_batch({"block": pa.array([block], pa.int32()), "part": pa.array([zlib.compress(last(part).tobytes(), 1)], pa.binary())})

    kind_of = last(np.zeros(1, kind)).dtype
    table = np.zeros((BLOCKS, length // BLOCKS), kind_of)
    for row in parts.select("block", "part").repartition("block").mapInArrow(run, "block int, part binary").collect():
        table[row.block] = np.frombuffer(zlib.decompress(row.part), kind_of)
    return table.reshape(-1)


def _level(counts: np.ndarray) -> np.ndarray:
    """Counts in one byte: exact to 128, then eight steps to each power of two."""
    above = 128 + np.floor(8 * np.log2(np.maximum(counts, 128) / 128))
    return np.where(counts <= 128, counts, np.minimum(above, 255)).astype(np.uint8)


def heads(words: DataFrame) -> DataFrame:
    """(k, n, h1, h2, bits) of each text, and (block, part) of the counts of its task: size of the set, 128 bits that stand for
    it, and the parity of its shingles by place, in a power of two of places that is at least twice the size."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        for keys, x, n in _sets(batches):
            bucket, times = np.unique((x >> np.uint64(64 - BUCKET_BITS)).astype(np.uint32), return_counts=True)
            counts[bucket] += times.astype(np.uint32)
            b = _bounds(n)
            sums = [np.add.reduceat(_mixed(x, salt), b[:-1]).view(np.int64) for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)]
            bits = []
            for i, j in zip(b[:-1].tolist(), b[1:].tolist()):
                places = max(64, 1 << (2 * (j - i) - 1).bit_length())
                odd = np.bincount((x[i:j] & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).tobytes())
            none = len(n)
            yield pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int32()), *map(pa.array, sums), pa.array(bits, pa.binary()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())], names)
        for block, part in _parts(counts):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, to_arrow), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([block], pa.int32()), pa.array([part], pa.binary())], names)

    from pyspark.sql.pandas.types import to_arrow_type

    names, to_arrow = ["k", "n", "h1", "h2", "bits", "block", "part"], to_arrow_type(words.schema["k"].dataType)
    return words.mapInArrow(run, f"k {_kind(words)}, n int, h1 bigint, h2 bigint, bits binary, block int, part binary")


def _kind(df: DataFrame) -> str:
    return df.schema["k"].dataType.simpleString()


def levels(parts: DataFrame) -> Shared:
    """How many sets have a shingle of the bucket, in one byte each."""
    return Shared(parts.sparkSession, _total(parts, np.uint32, 1 << BUCKET_BITS, np.add, _level))


def _ordered(x: np.ndarray, n: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(x, place, size, shared) with the rare shingles of each set first; places count from 1. A shingle alone in its bucket is
    in no other set."""
    at = level[(x >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
    order = np.lexsort((at, np.repeat(np.arange(len(n)), n)))  # stable, so equal counts stay ordered by hash
    return x[order], np.arange(len(x)) - np.repeat(_bounds(n)[:-1], n) + 1, np.repeat(n, n), at[order] > 1


def _prefix(size: np.ndarray, share: float, least: int) -> np.ndarray:
    """Places of a prefix in which a set has ``least`` of the shingles that it has in common with another one, or all, if these
    are at least ``share`` of it."""
    common = np.ceil(size * share - 1e-9)
    return size - common + np.minimum(common, least)


def _packed(keys: pa.Array, n: np.ndarray, x: np.ndarray, mark: np.ndarray, kept: np.ndarray) -> pa.RecordBatch:
    each = np.add.reduceat(kept.astype(np.int64), _bounds(n)[:-1])
    marks, xs = _lists(mark[kept].astype(np.int32), each), _lists(x[kept].view(np.int64), each)
    some = pa.array(each > 0)
    return pa.RecordBatch.from_arrays([c.filter(some) for c in (keys, pa.array(n, pa.int32()), marks, xs)], ["k", "n", "m", "x"])


def prefixes(words: DataFrame, level: Shared, share: float, least: int) -> DataFrame:
    """(k, n, m, x): the shared shingles of each set's prefix with their places."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for keys, x, n in _sets(batches):
            x, place, size, shared = _ordered(x, n, level.value)
            yield _packed(keys, n, x, place, shared & (place <= _prefix(size, share, least)))

    return words.mapInArrow(run, f"k {_kind(words)}, n int, m array<int>, x array<bigint>")


def prefix_field(words: DataFrame, level: Shared, share: float, least: int) -> Shared:
    """The bit field of the shingles that ``prefixes`` has."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        field = np.zeros(1 << FIELD_BITS - 3, np.uint8)
        for _, x, n in _sets(batches):
            x, place, size, shared = _ordered(x, n, level.value)
            _set_bits(field, _field_place(x[shared & (place <= _prefix(size, share, least))]))
        yield from _field_parts(field)

    return Shared(words.sparkSession, _total(words.mapInArrow(run, "block int, part binary"), np.uint8, 1 << FIELD_BITS - 3, np.bitwise_or))


def _field_place(x: np.ndarray) -> np.ndarray:
    return (x & np.uint64((1 << FIELD_BITS) - 1)).astype(np.int64)


def _set_bits(field: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(field, places >> 3, (1 << (places & 7)).astype(np.uint8))


def _has_bit(field: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (field[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0


def _field_parts(field: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block, part in _parts(field):
        yield pa.record_batch({"block": pa.array([block], pa.int32()), "part": pa.array([part], pa.binary())})


def in_field(words: DataFrame, level: Shared, field: Shared, share: float, least: int) -> DataFrame:
    """(k, n, m, x): the shared shingles of each set that are in the field; m is 1 in its prefix, else 0."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for keys, x, n in _sets(batches):
            x, place, size, shared = _ordered(x, n, level.value)
            yield _packed(keys, n, x, place <= _prefix(size, share, least), shared & _has_bit(field.value, _field_place(x)))

    return words.mapInArrow(run, f"k {_kind(words)}, n int, m array<int>, x array<bigint>")


def meetings(packed: DataFrame, pair: Callable, grows: Callable) -> DataFrame:
    """(a, b, need): one row per common shingle of two sets for which ``pair(na, ma, nb, mb)`` gives a ``need`` above 0; na <= nb.
    The rows of a shingle are sorted by size, so it is left as soon as ``grows(na, nb)`` says that nb is too large."""
    rows = packed.select("k", "n", F.inline(F.arrays_zip("m", "x"))).repartition("x").sortWithinPartitions("x", "n").select("k", "n", "m", "x")

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            x = batch.column(3).to_numpy()
            if len(x) and x[0] == x[-1] and (not rest or rest[0].column(3)[0].as_py() == x[0]):
                rest.append(batch)
                continue
            cut = int(np.searchsorted(x, x[-1])) if len(x) else 0
            if len(x):
                yield from met(pa.concat_batches([*rest, batch.slice(0, cut)]))
                rest = [batch.slice(cut)]
        if rest:
            yield from met(pa.concat_batches(rest))

    def met(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, (n, m, x) = rows.column(0), (rows.column(c).to_numpy() for c in (1, 2, 3))
        left, step, found, many = np.arange(len(x)), 0, [], 0
        while len(left):
            step += 1
            left = left[left + step < len(x)]
            left = left[x[left] == x[left + step]]
            left = left[~grows(n[left], n[left + step])]
            need = pair(n[left], m[left], n[left + step], m[left + step])
            good = need > 0
            found.append((left[good], left[good] + step, need[good]))
            many += good.sum()
            if many >= PAIRS or not len(left):
                a, b, need = (np.concatenate(c) for c in zip(*found))
                found, many = [], 0
                for i in range(0, len(a), PAIRS):
                    one, other = (keys.take(pa.array(c[i : i + PAIRS])) for c in (a, b))
                    yield pa.RecordBatch.from_arrays([one, other, pa.array(need[i : i + PAIRS], pa.int32())], ["a", "b", "need"])

    return rows.mapInArrow(run, f"a {_kind(packed)}, b {_kind(packed)}, need int")


def differing(a: Column, b: Column) -> Column:
    """At least so many shingles are in one of two sets only, by their ``bits``; the longer field is folded to the shorter."""
    return _differing(a, b)


@F.pandas_udf(IntegerType())
def _differing(a, b):
    import pandas as pd

    def fold(x: np.ndarray, size: int) -> np.ndarray:
        return np.bitwise_xor.reduce(x.reshape(-1, size), axis=0)

    def count(x: bytes, y: bytes) -> int:
        x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
        size = min(len(x), len(y))
        return int(np.bitwise_count(fold(x, size) ^ fold(y, size)).sum())

    return pd.Series([count(x, y) for x, y in zip(a, b)], dtype="int32")


def common(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """``pairs`` with ``na``, ``nb`` and ``common``, counted in the whole sets. Only the sets of keys in pairs are made and sent."""
    place = F.xxhash64("k").bitwiseAND(F.lit((1 << FIELD_BITS) - 1))

    def fill(batches: Batches) -> Iterator[pa.RecordBatch]:
        field = np.zeros(1 << FIELD_BITS - 3, np.uint8)
        for batch in batches:
            _set_bits(field, batch.column(0).to_numpy())
        yield from _field_parts(field)

    ends = pairs.select(F.explode(F.array("a", "b")).alias("k")).select(place.alias("p"))
    field = Shared(pairs.sparkSession, _total(ends.mapInArrow(fill, "block int, part binary"), np.uint8, 1 << FIELD_BITS - 3, np.bitwise_or))

    def only(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_has_bit(field.value, batch.column(2).to_numpy()))).select([0, 1])

    def make(batches: Batches) -> Iterator[pa.RecordBatch]:
        for keys, x, n in _sets(batches):
            yield pa.RecordBatch.from_arrays([keys, _lists(x.view(np.int64), n)], ["k", "s"])

    kind = _kind(rows)
    sets = hashed_words(rows.select("k", "t", place.alias("p")).mapInArrow(only, f"k {kind}, t string")).mapInArrow(make, f"k {kind}, s array<bigint>")
    both = pairs.join(sets.select(F.col("k").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("k").alias("b"), F.col("s").alias("sb")), "b")
    return both.select(*pairs.columns, F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("common"))
