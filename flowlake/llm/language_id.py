"""Language identification by rank-order profiles.

A text's n-grams are the runs of 1 to 3 characters of its words, each word with a mark
before and after it; words are runs of letters, in lower case. The PROFILE most frequent
ones, in order, are its profile, and a language's profile is that of all texts known to
be in it. The out-of-place distance of a text to a language adds up, over the text's
profile, how many places an n-gram stands away from its place in the language's, or
PROFILE where the language's lacks it. The nearest language is predicted; the score is
one minus the distance's share of the largest possible.

Three code points of 21 bits make one number, so n-grams are exact, not hashed. All
usable labelled texts are counted, by one row for each task, language and n-gram; the
profiles (PROFILE rows for each of at most LANGUAGES languages) are what the driver and
the tasks hold. Texts are counted whole, long ones piece by piece.

Defined results: the language is `und` and the score 0 if a text is null or has no
letter, or if no language could be learnt; texts whose language is null, or whose id is
not usable, are not learnt from; equal counts are ordered by n-gram, equal distances by
the language's name; repeated rows are predicted alike; more than LANGUAGES languages
are an error; an empty table gives an empty one. Other columns are ignored; a kept
column with a result's name gives way to the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from flowlake.llm.hashing import slices

LONGEST = 3
PROFILE = 300
LANGUAGES = 2000
UNKNOWN = "und"
# Stands before and after a word; lower than any letter.
MARK = 0x20
SLICE_BYTES = 3_000_000
# Characters counted at a time, and n-grams a task keeps before it hands them on.
PIECE = 1_000_000
HELD = 1_000_000

Counts = tuple[np.ndarray, np.ndarray]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _summed(parts: Sequence[Counts]) -> Counts:
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)


def _stream(text: str | None) -> np.ndarray:
    """Code points of the words, with one mark around and between them."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    codes = np.concatenate([[MARK], np.where(_letters()[codes], codes, MARK), [MARK]])
    fresh = np.ones(len(codes), bool)
    fresh[1:] = (codes[1:] != MARK) | (codes[:-1] != MARK)
    return codes[fresh]


def grams_of(text: str | None) -> Counts:
    """The distinct n-grams of a text and how often each occurs."""
    stream, parts = _stream(text), []
    for at in range(0, len(stream), PIECE):
        found = []
        for n in range(1, LONGEST + 1):
            piece = stream[at:at + PIECE + n - 1]
            runs, inner = piece[:max(len(piece) - n + 1, 0)], np.ones(max(len(piece) - n + 1, 0), bool)
            for i in range(1, n):
                later = piece[i:i + len(runs)]
                # A mark may end a run and begin it, but not stand within.
                inner &= (later != MARK) | (i == n - 1)
                runs = runs << 21 | later
            if n == 1:
                inner = runs != MARK
            found.append(runs[inner])
        parts.append(np.unique(np.concatenate(found), return_counts=True))
    return parts[0] if len(parts) == 1 else _summed(parts)


def profile_of(counts: Counts) -> np.ndarray:
    """The most frequent n-grams, first the most frequent."""
    keys, n = counts
    if len(keys) > PROFILE:
        often = n >= np.partition(n, -PROFILE)[-PROFILE]
        keys, n = keys[often], n[often]
    return keys[np.lexsort((keys, -n))[:PROFILE]]


class Profiles:
    """The languages' profiles, sorted by n-gram."""

    def __init__(self, languages: list[str], language: np.ndarray, gram: np.ndarray, rank: np.ndarray) -> None:
        order = np.argsort(gram, kind="stable")
        self.languages, self.language, self.gram, self.rank = languages, language[order], gram[order], rank[order]

    def nearest(self, text: str | None) -> tuple[str, float]:
        own = profile_of(grams_of(text))
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        first, last = (np.searchsorted(self.gram, own, side) for side in ("left", "right"))
        uses = last - first
        entry = np.repeat(first - np.cumsum(uses) + uses, uses) + np.arange(uses.sum())
        nearer = PROFILE - np.abs(np.repeat(np.arange(len(own)), uses) - self.rank[entry])
        worst = PROFILE * len(own)
        distance = worst - np.bincount(self.language[entry], nearer, minlength=len(self.languages))
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best] / worst)


def _grams_by_language(known: DataFrame) -> DataFrame:
    """known: language, text. language, gram, n: summed within each task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[Counts]] = {}
        size = 0

        def handed() -> Iterator[pa.RecordBatch]:
            for language, parts in held.items():
                keys, n = _summed(parts)
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(keys), pa.string()), pa.array(keys), pa.array(n)], ["language", "gram", "n"])

        for batch in (part for whole in batches for part in slices(whole, SLICE_BYTES)):
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = grams_of(text)
                held.setdefault(language, []).append(own)
                size += len(own[0])
                if size > HELD:
                    held = {k: [_summed(parts)] for k, parts in held.items()}
                    size = sum(len(parts[0][0]) for parts in held.values())
                    if size > HELD // 2:
                        yield from handed()
                        held, size = {}, 0
        yield from handed()

    return known.mapInArrow(count, "language string, gram long, n long")


def fit(docs: DataFrame, usable=lambda doc_id: F.lit(True), text: str = "text", language: str = "lang") -> Profiles:
    """usable(doc_id column): which rows may be learnt from."""
    known = docs.filter(F.col(language).isNotNull() & F.col(text).isNotNull() & usable(F.col("doc_id")))
    counts = _grams_by_language(known.select(F.col(language).cast("string").alias("language"), F.col(text).alias("text")))
    totals = counts.groupBy("language", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("language").orderBy(F.desc("n"), F.asc("gram"))
    top = totals.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < PROFILE).select("language", "gram", "rank")
    # PROFILE rows for each of LANGUAGES languages at most; one row more tells that there are too many.
    found = top.limit(PROFILE * LANGUAGES + 1).toArrow()
    languages = sorted(set(found.column("language").to_pylist()))
    if len(languages) > LANGUAGES or found.num_rows > PROFILE * LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    number = {name: i for i, name in enumerate(languages)}
    own = np.array([number[name] for name in found.column("language").to_pylist()], np.int64)
    return Profiles(languages, own, found.column("gram").to_numpy(), found.column("rank").to_numpy().astype(np.int64))


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score."""
    keep = [c for c in keep if c not in ("lang_pred", "score")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, SLICE_BYTES)):
            names, scores = zip(*map(profiles.nearest, batch.column(len(keep)).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*(f"c{i}" for i in range(len(keep))), "lang_pred", "score"])

    # Kept columns travel by place, so their names can be any.
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(keep)])
    schema = schema.add("lang_pred", T.StringType()).add("score", T.DoubleType())
    rows = docs.select(*(docs[c].alias(f"c{i}") for i, c in enumerate(keep)), docs[text].alias("text"))
    return rows.mapInArrow(predict, schema).toDF(*keep, "lang_pred", "score")
