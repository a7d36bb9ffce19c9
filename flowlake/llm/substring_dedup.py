"""Removes passages that stand earlier already: exact repeats of WINDOW words.

The reference blocks are the non-overlapping blocks of BLOCK words of every text.
Since WINDOW >= 2 * BLOCK - 1, any WINDOW words hold a whole one, so of two equal
windows each holds a rolling block that is a reference block of the other. Every
rolling block probes the references; the hits are extended: the windows around
them are compared as a whole, and neighbouring repeated windows make up the
maximal repeat. A window goes if its words also start earlier: in a text with a
smaller id, or earlier in the same text. What is left is decided on the input
alone.

To probe with every word of a large corpus, blocks travel packed: a task gathers
about CHUNK_WORDS words, counts each block once, and sends each bucket of the
hash range its share as one binary value (30 hash bits, two flags and the place
as a small step, about five bytes). A bucket answers with the places hit; a
false hit costs only a comparison, as windows are compared by 128-bit hashes.
Exact copies of whole texts are set aside before the windows are compared.

The documents must come in the same order whenever they are read, as a stored
table does; otherwise the job stops with an error.

Defined results: a null or empty text has no words; a text of fewer than WINDOW
words loses none; rows that share an id are ordered by a hash of their text;
rows that repeat id and text are one place and treated alike; a null id comes
before all others; an empty table gives an empty one; other columns stay if
asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.llm.hashing import mix, runs_inside, runs_of, slices, words_of
from flowlake.llm.tables import BUILD_SIDE, stored

BLOCK, WINDOW = 10, 20
SALT = 0x2545F491
SLICE_BYTES = 3_000_000
CHUNK_WORDS = 1_000_000
# Text that gives one bucket, and the most buckets.
BUCKET_BYTES = 12_000_000
MOST_BUCKETS = 1 << 15

_HASH = np.uint64((1 << 30) - 1)
_REFERENCE, _SEVERAL = 1 << 30, 1 << 31


class Chunk:
    """The rolling blocks of neighbouring texts; places are word numbers."""

    def __init__(self) -> None:
        self.words, self.keys, self.bounds = 0, [], [0]
        self.hashes, self.places, self.reference = [], [], []

    def add(self, keys: pa.Array, texts: pa.Array) -> None:
        words = words_of(texts)
        total = len(words.hashes)
        at = np.flatnonzero(runs_inside(words.bounds, BLOCK, total))
        text = np.repeat(np.arange(len(texts)), words.counts())
        self.hashes.append(runs_of(words.hashes, BLOCK)[at])
        self.reference.append((at - words.bounds[text[at]]) % BLOCK == 0)
        self.places.append(at + self.words)
        self.keys.extend(keys.to_pylist())
        self.bounds.extend((words.bounds[1:] + self.words).tolist())
        self.words += total

    def name(self) -> int:
        """Of these texts in this order."""
        keys = np.array([(0 if k is None else k) & ((1 << 64) - 1) for k in self.keys], np.uint64)
        ends = np.array(self.bounds[1:], np.uint64)
        rolled = runs_of(mix(keys + mix(ends)), len(keys))
        return int(rolled.view(np.int64)[0])

    def distinct(self) -> tuple[np.ndarray, ...]:
        """hash, first place, whether any is a reference block, whether there
        are several; and for the others: first place, own place."""
        hashes, places = np.concatenate(self.hashes), np.concatenate(self.places)
        reference = np.concatenate(self.reference)
        if not len(hashes):
            return hashes, places, reference, reference, places, places
        order = np.argsort(hashes, kind="stable")
        hashes, places, reference = hashes[order], places[order], reference[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = hashes[1:] != hashes[:-1]
        first = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        several = np.diff(np.append(first, len(hashes))) > 1
        return (hashes[first], places[first], np.logical_or.reduceat(reference, first), several,
                places[first][group[~fresh]], places[~fresh])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    chunk = Chunk()
    for batch in batches:
        for part in slices(batch, SLICE_BYTES):
            chunk.add(part.column(0), part.column(1))
            if chunk.words >= CHUNK_WORDS:
                yield chunk
                chunk = Chunk()
    if chunk.keys:
        yield chunk


def _packed(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            hashes, places, reference, several, _, _ = chunk.distinct()
            order = np.argsort(places)
            hashes, places, reference, several = hashes[order], places[order], reference[order], several[order]
            bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            code = (hashes & _HASH).astype(np.uint32) | reference.astype(np.uint32) << np.uint32(30) | several.astype(np.uint32) << np.uint32(31)
            bucket, places, code = bucket[order], places[order], code[order]
            edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
            rows = []
            for start, end in zip(edges, [*edges[1:], len(bucket)]):
                step = np.diff(places[start:end], prepend=0)
                planes = (code[start:end], (step & 255).astype(np.uint8), (step >> 8 & 255).astype(np.uint8), (step >> 16).astype(np.uint16))
                rows.append((int(bucket[start]), b"".join(p.tobytes() for p in planes)))
            if rows:
                own = pa.array([chunk.name()] * len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), own, pa.array([r[1] for r in rows], pa.binary())], ["bucket", "chunk", "blocks"])

    return docs.mapInArrow(run, "bucket int, chunk long, blocks binary")


def _directory(docs: DataFrame) -> DataFrame:
    """Of each chunk: its texts, where they end, and blocks that occur again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            _, _, _, _, first, again = chunk.distinct()
            lists = [pa.array([v], pa.list_(t)) for v, t in (
                (chunk.keys, pa.int64()), (chunk.bounds, pa.int32()), (first, pa.int32()), (again, pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array([chunk.name()], pa.int64()), *lists], ["chunk", "keys", "bounds", "first", "again"])

    return docs.mapInArrow(run, "chunk long, keys array<long>, bounds array<int>, first array<int>, again array<int>")


def _probe(table: pa.Table) -> pa.Table:
    """One bucket: the places of each chunk whose block is a reference block of
    some text and occurs more than once."""
    codes, places, sizes = [], [], []
    for value in table.column("blocks"):
        raw = value.as_buffer()
        n = raw.size // 8
        codes.append(np.frombuffer(raw, np.uint32, n))
        low, middle = np.frombuffer(raw, np.uint8, n, 4 * n), np.frombuffer(raw, np.uint8, n, 5 * n)
        high = np.frombuffer(raw[6 * n:].to_pybytes(), np.uint16, n)
        places.append(np.cumsum(low.astype(np.int32) | middle.astype(np.int32) << 8 | high.astype(np.int32) << 16))
        sizes.append(n)
    code = np.concatenate(codes)
    plain = code & np.uint32(_REFERENCE - 1)
    order = np.argsort(plain, kind="stable")
    first = np.flatnonzero(np.append(True, plain[order][1:] != plain[order][:-1]))
    flags = np.bitwise_or.reduceat(code[order], first)
    count = np.diff(np.append(first, len(code)))
    good = (flags & np.uint32(_REFERENCE) > 0) & ((count > 1) | (flags & np.uint32(_SEVERAL) > 0))
    hit = np.zeros(len(code), bool)
    hit[order] = np.repeat(good, count)
    chunks, found = table.column("chunk").to_pylist(), []
    for chunk, own, place in zip(chunks, np.split(hit, np.cumsum(sizes)[:-1]), places):
        if own.any():
            found.append((chunk, place[own]))
    return pa.table({"chunk": pa.array([f[0] for f in found], pa.int64()), "places": pa.array([f[1] for f in found], pa.list_(pa.int32()))})


def _to_texts(hits: pa.Table, directory: pa.Table) -> pa.Table:
    """One chunk's hits, text by text."""
    keys, found = [], []
    if hits.num_rows:
        if not directory.num_rows:
            raise ValueError("the documents came in another order; store them first")
        entry = {c: directory.column(c)[0].as_py() for c in ("keys", "bounds", "first", "again")}
        places = np.unique(hits.column("places").combine_chunks().flatten().to_numpy())
        first, again = np.array(entry["first"], np.int32), np.array(entry["again"], np.int32)
        places = np.sort(np.concatenate([places, again[np.isin(first, places)]]))
        bounds = np.array(entry["bounds"])
        cuts = np.searchsorted(places, bounds)
        for i in np.flatnonzero(np.diff(cuts)):
            keys.append(entry["keys"][i])
            found.append(places[cuts[i]:cuts[i + 1]] - bounds[i])
    return pa.table({"key": pa.array(keys, pa.int64()), "hits": pa.array(found, pa.list_(pa.int32()))})


def _windows(rows: DataFrame) -> DataFrame:
    """rows: key, text, hits. For each window around a hit: a, b (its hash), at,
    and whether its words stand earlier in the same text (again)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                words = words_of(part.column(1))
                total = len(words.hashes)
                if total < WINDOW:
                    continue
                hits = part.column(2)
                text_of_hit = np.repeat(np.arange(len(hits)), hits.value_lengths().to_numpy(zero_copy_only=False))
                marks = np.zeros(total + 1, np.int64)
                marks[hits.flatten().to_numpy() + words.bounds[text_of_hit] + 1] = 1
                sums = np.cumsum(marks)
                text = np.repeat(np.arange(len(part)), words.counts())
                starts = np.flatnonzero(runs_inside(words.bounds, WINDOW, total))
                starts = starts[sums[starts + WINDOW - BLOCK + 1] > sums[starts]]
                a, b = runs_of(words.hashes, WINDOW)[starts], runs_of(words.hashes, WINDOW, SALT)[starts]
                own = text[starts]
                order = np.lexsort((starts, b, a, own))
                again = np.zeros(len(starts), bool)
                same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1]) & (own[order][1:] == own[order][:-1])
                again[order[1:]] = same
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), part.column(0).take(pa.array(own)),
                     pa.array((starts - words.bounds[own]).astype(np.int32)), pa.array(again)], ["a", "b", "key", "at", "again"])

    return rows.mapInArrow(run, "a long, b long, key long, at int, again boolean")


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """Adds __key: the id where ids are unique and not null, else a number in
    the order of id and text hash."""
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.filter("doc_id IS NULL OR n > 1").isEmpty():
        return docs.withColumn("__key", F.col("doc_id").cast("long"))
    hashed = docs.withColumn("__hash", F.xxhash64(text, F.length(text)))
    order = hashed.select(F.col("doc_id").alias("__id"), F.col("__hash").alias("__own")).distinct().orderBy("__id", "__own")
    order = stored(order.withColumn("__key", F.monotonically_increasing_id()), "places")
    both = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("__hash").eqNullSafe(F.col("__own"))
    return stored(hashed.join(order, both).drop("__hash", "__id", "__own"), "placed-documents")


def repeated_windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with __key. Returns key, starts of the windows to remove, and whole:
    whether the text copies an earlier one."""
    texts = docs.select("__key", text)
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(1, min(MOST_BUCKETS, -(-size // BUCKET_BYTES)))
    hits = _packed(texts, buckets).groupBy("bucket").applyInArrow(_probe, "chunk long, places array<int>")
    hits = stored(hits.groupBy("chunk").cogroup(_directory(texts).groupBy("chunk")).applyInArrow(_to_texts, "key long, hits array<int>"), "block-hits")
    # Exact copies: all but the first of each group.
    twins = texts.select("__key", F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"), F.octet_length(text).alias("z"))
    first = stored(twins.groupBy("x", "y", "z").agg(F.min("__key").alias("first"), F.max("__key").alias("last")).filter("first < last"), "copied-texts")
    copies = stored(twins.join(first, ["x", "y", "z"]).filter("__key > first").select(F.col("__key").alias("key")), "copies")
    rows = texts.join(hits.join(copies, "key", "left_anti").hint(BUILD_SIDE), F.col("__key") == F.col("key")).select("key", text, "hits")
    windows = stored(_windows(rows), "windows")
    single = windows.filter("NOT again").groupBy("a", "b").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    single = stored(single.filter("first < last").select("a", "b", "first"), "first-windows")
    later = windows.filter("NOT again").join(single, ["a", "b"]).filter("key > first").select("key", "at")
    later = later.unionAll(windows.filter("again").select("key", "at"))
    starts = later.groupBy("key").agg(F.collect_set("at").alias("starts"))
    nothing = F.expr("cast(array() as array<int>)")
    return starts.select("key", "starts", F.lit(False).alias("whole")).unionAll(
        copies.distinct().select("key", nothing, F.lit(True)))


def remove_repeats(docs: DataFrame, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, n_words, n_removed and kept (the other words, joined by
    one space)."""
    keep = list(keep)
    keyed = _keyed(docs.select(*dict.fromkeys(["doc_id", *keep, text])), text)
    gone = stored(repeated_windows(keyed, text), "repeats")
    rows = keyed.join(gone.hint(BUILD_SIDE), F.col("__key") == F.col("key"), "left").select(*keep, F.col(text).alias("__text"), "starts", "whole")
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            out = []
            for body, starts, whole in zip(*(batch.column(n + i).to_pylist() for i in range(3))):
                words = (body or "").encode().split()
                total = len(words)
                if whole and total >= WINDOW:
                    words = []
                elif starts:
                    covered = np.zeros(total + 1, np.int32)
                    np.add.at(covered, starts, 1)
                    np.add.at(covered, np.array(starts) + WINDOW, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(covered)[:total] == 0)]
                out.append((total, total - len(words), b" ".join(words).decode()))
            columns = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(n)), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string())))],
                [*keep, "n_words", "n_removed", "kept"])

    schema = T.StructType([docs.schema[c] for c in keep]).add("n_words", T.LongType()).add("n_removed", T.LongType()).add("kept", T.StringType())
    return rows.mapInArrow(run, schema)
