"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are all windows of WINDOW consecutive words of the benchmark items;
a shorter item is one pattern. Patterns of one length share a table. A text is
read through a sliding frame of that length: the last BLOCK words of the frame
are looked up in the shift table, which tells how far the frame can move without
passing an occurrence; at shift 0 the block's bucket holds the patterns ending
in it, and these are compared word by word.

The benchmark is the stated set of patterns. It is cut into pieces and worked
through in blocks of about BLOCK_WORDS words, so what a task holds is bounded
however large it is; each block after the first reads the texts once more.

Defined results: A-Z are folded, everything but ASCII digits, letters and
non-ASCII characters ends a word. A null or empty text has no words and no hits;
items without words or without an id are skipped; rows with one item_id are one
item; repeated documents each get their own row; empty tables give rows without
hits or no rows. Of the documents' other columns only those asked for are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.llm.hashing import slices
from flowlake.llm.tables import stored

WINDOW = 10
BLOCK = 3
BLOCK_WORDS = 200_000
PIECE_WORDS = 2_000
TEXT = "__text"

_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _KEPT or 0x41 <= b <= 0x5A else 0x20 for b in range(256))

_RESULT = T.StructType().add("n_words", T.LongType()).add(
    "hits", T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()))
).add("items", T.ArrayType(T.LongType()))


def words_in(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class PatternTable:
    """Shift and bucket tables for patterns (tuples of word numbers) of one
    length."""

    def __init__(self, length: int, patterns: dict[tuple[int, ...], list[int]]) -> None:
        self.length, self.block = length, min(BLOCK, length)
        self.farthest = length - self.block + 1
        self.shift: dict[tuple[int, ...], int] = {}
        self.buckets: dict[tuple[int, ...], list[tuple[tuple[int, ...], list[int]]]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.farthest), length - end)
            self.buckets.setdefault(pattern[-self.block:], []).append((pattern, items))

    def search(self, words: list[int]) -> Iterator[tuple[int, list[int]]]:
        """(start, items) of every occurrence."""
        length, block, farthest, shift, at = self.length, self.block, self.farthest, self.shift, self.length
        n = len(words)
        while at <= n:
            key = tuple(words[at - block:at])
            step = shift.get(key, farthest)
            if step:
                at += step
                continue
            frame = tuple(words[at - length:at])
            for pattern, items in self.buckets.get(key, ()):
                if pattern == frame:
                    yield at - length, items
            at += 1


class Benchmark:
    """The tables of one block of item pieces."""

    def __init__(self, pieces: list[tuple[int, str]]) -> None:
        self.numbers: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for item, text in pieces:
            words = tuple(self.numbers.setdefault(w, len(self.numbers)) for w in text.encode().split())
            length = min(WINDOW, len(words))
            for at in range(len(words) - length + 1):
                items = by_length.setdefault(length, {}).setdefault(words[at:at + length], [])
                if item not in items[-1:]:
                    items.append(item)
        self.tables = [PatternTable(length, found) for length, found in sorted(by_length.items())]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[int]]:
        """Merged spans of hit words, and the sorted items found."""
        numbers = self.numbers.get
        own = [numbers(w, -1) for w in words]
        spans, items = [], set()
        for table in self.tables:
            for start, found in table.search(own):
                spans.append((start, start + table.length))
                items.update(found)
        return merged(spans), sorted(items)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


@lru_cache(maxsize=2)
def _benchmark(pieces: tuple[tuple[int, str], ...]) -> Benchmark:
    return Benchmark(list(pieces))


def item_pieces(benchmark: DataFrame) -> DataFrame:
    """item_id, piece and its words joined by spaces; neighbouring pieces share
    WINDOW - 1 words, so every window is in one piece."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_in(text)
                for at in range(0, max(1, len(words) - WINDOW + 1) if words else 0, PIECE_WORDS):
                    piece = words[at:at + PIECE_WORDS + WINDOW - 1]
                    rows.append((item, at, b" ".join(piece).decode(), len(piece)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.int64()))],
                    ["item_id", "at", "words", "n"])

    items = benchmark.filter("item_id IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    return items.mapInArrow(cut, "item_id long, at long, words string, n long")


def _scan(texts: DataFrame, pieces: tuple[tuple[int, str], ...], keep: list[str], last: bool) -> DataFrame:
    """One pass over the texts; hits and items found before are kept. The last
    pass doesn't hand the texts on."""
    n, before = len(keep), len(texts.columns) > len(keep) + 1
    carried = [*keep] if last else [*keep, TEXT]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _benchmark(pieces)
        for batch in (part for whole in batches for part in slices(whole)):
            own = []
            for i, text in enumerate(batch.column(n).to_pylist()):
                words = words_in(text)
                spans, items = tables.search(words)
                if before:
                    old = batch.column(n + 2)[i].as_py()
                    spans = merged(spans + [(s["start"], s["end"]) for s in old])
                    items = sorted({*items, *batch.column(n + 3)[i].as_py()})
                own.append((len(words), [{"start": s, "end": e} for s, e in spans], items))
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            kinds = (pa.int64(), span, pa.list_(pa.int64()))
            columns = zip(*own) if own else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(j) for j in range(len(carried))] + [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                [*carried, *_RESULT.names])

    return texts.mapInArrow(scan, T.StructType([texts.schema[c] for c in carried] + _RESULT.fields))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, n_words, hits (word spans) and items per document."""
    keep = list(keep)
    pieces = item_pieces(benchmark)
    blocks = max(1, -(-(pieces.agg(F.sum("n")).first()[0] or 0) // BLOCK_WORDS))
    found = docs.select(*keep, docs[text].alias(TEXT))
    for block in range(blocks):
        rows = pieces.filter(F.pmod(F.xxhash64("item_id", "at"), F.lit(blocks)) == block).select("item_id", "words").collect()
        last = block == blocks - 1
        found = _scan(found, tuple(sorted((r[0], r[1]) for r in rows)), keep, last)
        if not last:
            found = stored(found, "decontaminate")
    return found


def n_hit() -> Column:
    """Words covered by the spans in `hits`."""
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
