"""Problem 6: encode a corpus with a public byte-level BPE by replaying its merges over words.

The texts of a block are cut into pieces at single spaces, the pieces into the pattern's words, and
all words that are new to the worker are encoded together: an inverted index leads from each token
pair to the places in the words where it stands; the merges are applied in rank order, and only the
neighbours of a merged place get new index entries. Words come back to the texts by look-up, so no
row is shuffled and every text is encoded whole.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

BPE_50K = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: the pattern by which the public byte-level tokenizers cut text before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BLOCK_CHARS = 4_000_000
CACHE_PIECES = 1_000_000


def printable_bytes() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 characters
    for themselves, the other bytes in order for the code points from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """Ids of single bytes, and for a pair of ids its merge's (rank, id)."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, alphabet = model["vocab"], printable_bytes()
        self.of_byte = [0] * 256
        for char, byte in alphabet.items():
            self.of_byte[byte] = vocab[char]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        self.words = regex.compile(WORDS).findall

    def replay(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, all words at once, merges in rank order."""
        merges, of_byte = self.merges, self.of_byte
        token: list[int] = []
        starts: list[int] = []
        after: list[int] = []
        before: list[int] = []
        for word in words:
            first = len(token)
            starts.append(first)
            token += [of_byte[b] for b in word.encode("utf-8")]
            n = len(token)
            after += range(first + 1, n + 1)
            before += range(first - 1, n - 1)
            before[first] = -1
            after[n - 1] = -1
        index: dict[int, list[int]] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for at, right in enumerate(after):
            if right >= 0 and (m := merges.get((token[at], token[right]))):
                if m[0] in index:
                    index[m[0]].append(at)
                else:
                    index[m[0]] = [at]
                    made[m[0]] = (token[at], token[right], m[1])
        order = list(index)
        heapq.heapify(order)
        while order:
            rank = heapq.heappop(order)
            left_id, right_id, new = made[rank]
            # Places found late were appended late, so left-to-right order has to be restored.
            for at in sorted(index.pop(rank)):
                right = after[at]
                if token[at] != left_id or right < 0 or token[right] != right_id:
                    continue
                token[at], token[right] = new, -1
                beyond = after[at] = after[right]
                if beyond >= 0:
                    before[beyond] = at
                    if m := merges.get((new, token[beyond])):
                        self._note(index, made, order, m, at, new, token[beyond])
                back = before[at]
                if back >= 0 and (m := merges.get((token[back], new))):
                    self._note(index, made, order, m, back, token[back], new)
        out = []
        for first in starts:
            ids, at = [], first
            while at >= 0:
                ids.append(token[at])
                at = after[at]
            out.append(ids)
        return out

    @staticmethod
    def _note(index, made, order, merge, at, left, right):
        rank = merge[0]
        if rank in index:
            index[rank].append(at)
        else:
            index[rank] = [at]
            made[rank] = (left, right, merge[1])
            heapq.heappush(order, rank)


# A space next to white space on both sides belongs to a longer run, which the pattern treats whole.
_INNER_SPACE = re.compile(r"\s \s")
_CUT = re.compile(r"(?<=\S) | (?=\S)")


class Encoder:
    """Encodes texts; keeps what it learnt of pieces between blocks (emptied when it grows too large)."""

    def __init__(self, path: str = BPE_50K, cache_pieces: int = CACHE_PIECES):
        self.table = MergeTable(path)
        self.cache_pieces = cache_pieces
        self.heads: dict[str, list[int]] = {}
        self.tails: dict[str, list[int]] = {}  # without the space that precedes each
        self.sizes: dict[str, int] = {}  # of the tails

    def _learn(self, pieces: dict[str, None], known: dict[str, list[int]], lead: str) -> None:
        cut = [(p, self.table.words(lead + p)) for p in pieces]
        words = list(dict.fromkeys(w for _, ws in cut for w in ws))
        ids = dict(zip(words, self.table.replay(words)))
        for piece, ws in cut:
            known[piece] = ids[ws[0]] if len(ws) == 1 else [i for w in ws for i in ids[w]]

    def pieces(self, texts: list[str]) -> list[list[str]]:
        """Each text cut at single spaces, all pieces known afterwards."""
        if len(self.heads) + len(self.tails) > self.cache_pieces:  # words of later texts are learnt anew
            self.heads.clear()
            self.tails.clear()
            self.sizes.clear()
        cut = [_CUT.split(t) if _INNER_SPACE.search(t) else t.split(" ") for t in texts]
        heads = dict.fromkeys(p[0] for p in cut if p[0] not in self.heads)
        tails = dict.fromkeys(x for p in cut for x in p[1:] if x not in self.tails)
        if heads:
            self._learn(heads, self.heads, "")
        if tails:
            self._learn(tails, self.tails, " ")
            self.sizes.update((x, len(self.tails[x])) for x in tails)
        return cut

    def encode(self, texts: list[str | None]) -> tuple[array, list[int]]:
        """All ids in one array, and the offset at which each text's ids begin (and the last end)."""
        values, offsets = array("i"), [0]
        heads, tails, extend = self.heads, self.tails, values.extend
        for p in self.pieces([t or "" for t in texts]):
            if p[0]:
                extend(heads[p[0]])
            for x in p[1:]:
                extend(tails[x])
            offsets.append(len(values))
        return values, offsets

    def lengths(self, texts: list[str | None]) -> list[int]:
        cut = self.pieces([t or "" for t in texts])
        heads, sizes = self.heads, self.sizes
        return [len(heads[p[0]]) + sum(map(sizes.__getitem__, p[1:])) for p in cut]


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` characters, so that long texts don't pile up in memory."""
    column = batch.column(batch.schema.names.index(text))
    begin = size = 0
    for i, n in enumerate(pc.utf8_length(column).to_pylist()):
        size += n or 0
        if size >= limit:
            yield batch.slice(begin, i + 1 - begin)
            begin, size = i + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def token_ids(df: DataFrame, key: str, text: str, vocabulary: str = BPE_50K) -> DataFrame:
    """(key, ids): the ids of each row's text without special tokens.

    Null and empty texts give the empty list; strings that look like special tokens are ordinary text;
    each input row gives one row, also where keys are null or repeated; other columns are ignored.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for block in blocks(batch, "t"):
                values, offsets = encoder.encode(block.column(1).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([block.column(0), ids], names=[key, "ids"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decoded(df: DataFrame, key: str, vocabulary: str = BPE_50K) -> DataFrame:
    """(key, text) of df(key, ids): the bytes of each row's ids put together, the inverse of token_ids. Bytes that are no
    UTF-8 are an error, as the ids of a text never give them; null ids give null."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(vocabulary, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        alphabet = printable_bytes()
        parts = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items() if all(c in alphabet for c in token)}
        for batch in batches:
            texts = [None if ids is None else b"".join(map(parts.__getitem__, ids)).decode("utf-8") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return df.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, text string")


def token_counts(df: DataFrame, text: str, keep: list[str], vocabulary: str = BPE_50K) -> DataFrame:
    """The columns ``keep`` and ``n_tokens`` of each row's text (0 for null and empty texts)."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for block in blocks(batch, "_text"):
                counts = pa.array(encoder.lengths(block.column(len(keep)).to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([*block.columns[: len(keep)], counts], names=[*keep, "n_tokens"])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, f"{schema}, n_tokens bigint")
