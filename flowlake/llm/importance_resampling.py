"""Importance resampling towards a target distribution, on hashed word n-grams.

A text's features are its runs of 1 to `longest` words, and a feature's bucket is the
CRC-32 of its bytes modulo `buckets`. A bucket's gain is the logarithm of its share
in the target over its share in the corpus, both with one added to every count; a
document's weight is the mean gain of its features. Adding Gumbel noise that depends
on seed and id alone and keeping the highest scores draws documents without
replacement in proportion to their exponentiated weights.

CRCs are computed by length: the distinct features of a slice of texts are grouped by
their number of bytes, every group is a two-dimensional byte array, and all CRCs of a
group are updated together, one column after the other; the buckets are then
scattered back to the features' places. A feature of more than LONGEST_COLUMNS bytes,
practically alone with its length, gets the same CRC from zlib.

Corpus and target are counted whole, by one row for each task and bucket. The driver
and the tasks hold `buckets` gains, nothing that grows with the documents. Ranks come
from range partitions (running totals), so no task sorts more than its stretch.

Defined results: A-Z are folded, everything but ASCII digits, letters and non-ASCII
characters ends a word. A null or empty text has no words, no features and weight 0.
Only documents of at least `least_words` words are drawn. Repeated rows are documents
of their own and share a score; ties go to the smaller id, a null id coming first,
then to either row. Without target texts, or without documents, all counts are 0 and
the formula holds. An empty table gives an empty one. Other columns are ignored; a
kept column with a result's name gives way to the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.llm.hashing import LOWER, slices, words_of
from flowlake.llm.tables import stored
from flowlake.operators.running import running_totals

BUCKETS = 10_000
LONGEST_COLUMNS = 4096
# Bytes of one group's matrix at a time.
MATRIX_BYTES = 1_000_000
SLICE_BYTES = 3_000_000
RESULTS = ("n_words", "n_features", "weight", "score", "rank")

_ENDS_WORD = np.ones(256, bool)
_ENDS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _crc_table() -> np.ndarray:
    """One step of the reflected CRC-32 for each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_STEP = _crc_table()


def crc_of_rows(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a byte matrix, column by column."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = _STEP[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def crc_of_values(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32 of the values data[offsets[i]:offsets[i + 1]]."""
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    crcs = np.zeros(len(lengths), np.uint32)
    for start, end in pairwise(edges):
        length = int(lengths[order[start]])
        if length > LONGEST_COLUMNS:
            for i in order[start:end]:
                crcs[i] = zlib.crc32(data[offsets[i]:offsets[i + 1]])
            continue
        most = max(1, MATRIX_BYTES // max(length, 1))
        for at in range(start, end, most):
            some = order[at:min(at + most, end)]
            crcs[some] = crc_of_rows(data[offsets[some][:, None] + np.arange(length)])
    return crcs


def _values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """data[starts[i]:ends[i]] as an Arrow array."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[places]))]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)


def features_of(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; text number and bucket of every feature."""
    words = words_of(texts, _ENDS_WORD, LOWER)
    counts = words.counts()
    number = np.repeat(np.arange(len(texts)), counts)
    data, starts, ends = words.data, words.starts, words.ends
    if longest > 1 and len(starts):
        # Joined by one space, whatever stood between two words.
        joined = np.full(int((ends - starts + 1).sum()), 0x20, np.uint8)
        new = np.cumsum(ends - starts + 1) - (ends - starts + 1)
        place = np.arange(int((ends - starts).sum()))
        before = np.cumsum(ends - starts) - (ends - starts)
        joined[place + np.repeat(new - before, ends - starts)] = data[place + np.repeat(starts - before, ends - starts)]
        data, starts, ends = joined, new, new + (ends - starts)
    text, bucket = [], []
    for k in range(1, longest + 1):
        first = np.flatnonzero(number[:len(number) - k + 1] == number[k - 1:]) if len(number) >= k else np.zeros(0, int)
        if not len(first):
            continue
        known = _values(data, starts[first], ends[first + k - 1]).dictionary_encode()
        offsets = np.frombuffer(known.dictionary.buffers()[1], np.int64)[:len(known.dictionary) + 1]
        own = np.frombuffer(known.dictionary.buffers()[2], np.uint8)
        crcs = crc_of_values(own, offsets) % np.uint32(buckets)
        text.append(number[first])
        bucket.append(crcs[known.indices.to_numpy()].astype(np.int64))
    none = np.zeros(0, np.int64)
    return counts, np.concatenate(text or [none]), np.concatenate(bucket or [none])


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """texts: one text column. bucket and n: features of all texts in it."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in (part for whole in batches for part in slices(whole, SLICE_BYTES)):
            totals += np.bincount(features_of(batch.column(0), longest, buckets)[2], minlength=buckets)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], ["bucket", "n"])

    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Gain in thousandths of every bucket, from two tables of counts."""
    total = lambda counts: F.lit(float(counts.agg(F.sum("n")).first()[0] or 0))
    size, share = total(corpus), total(target)
    every = corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in "st")
    ratio = (t + 1) * (size + float(buckets)) / ((s + 1) * (share + float(buckets)))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def weights(docs: DataFrame, gains: np.ndarray, text: str, keep: Sequence[str], longest: int) -> DataFrame:
    """The kept columns, n_words, n_features and weight: the floored mean gain."""
    keep = list(keep)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, SLICE_BYTES)):
            words, number, bucket = features_of(batch.column(len(keep)), longest, len(gains))
            n = np.bincount(number, minlength=len(words))
            # Whole numbers, so the sums of doubles are exact.
            sums = np.bincount(number, gains[bucket].astype(np.float64), minlength=len(words)).astype(np.int64)
            means = np.floor_divide(sums, np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), *(pa.array(c, pa.int64()) for c in (words, n, means))],
                [*(f"c{i}" for i in range(len(keep))), "n_words", "n_features", "weight"])

    # Kept columns travel by place, so their names can be any.
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(keep)])
    for name in RESULTS[:3]:
        schema = schema.add(name, T.LongType())
    rows = docs.select(*(docs[c].alias(f"c{i}") for i, c in enumerate(keep)), docs[text].alias("__text")).mapInArrow(weigh, schema)
    return rows.toDF(*keep, *RESULTS[:3])


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise in thousandths from seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, seed: int, percent: int, least_words: int,
    text: str = "text", keep: Sequence[str] = ("doc_id",), longest: int = 1, buckets: int = BUCKETS,
) -> DataFrame:
    """The kept columns of every document with n_words, n_features, weight, score and
    rank: 1, 2, 3... for the floor(percent / 100 * N) highest scores among the N
    documents of at least `least_words` words, null for all others. `target` has a
    text column of the same name. doc_id is always kept."""
    keep = ["doc_id", *(c for c in dict.fromkeys(keep) if c not in (*RESULTS, "doc_id", "__row"))]
    corpus = stored(bucket_counts(docs.select(text), longest, buckets), "corpus-buckets")
    aim = stored(bucket_counts(target.select(text), longest, buckets), "target-buckets")
    gains = np.zeros(buckets, np.int64)
    # One row for each bucket.
    for row in bucket_gains(corpus, aim, buckets).collect():
        gains[row["bucket"]] = row["gain"]
    scored = weights(docs, gains, text, keep, longest)
    scored = scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    # The row's number tells equal rows apart; it is fixed once it is written.
    scored = stored(scored.withColumn("__row", F.monotonically_increasing_id()), "scored-documents")
    eligible = scored.filter(F.col("n_words") >= least_words)
    drawn = percent * eligible.count() // 100
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("__row")]
    ranked = running_totals(eligible, order, {"rank": F.lit(1).cast("long")})
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).drop("__row")
