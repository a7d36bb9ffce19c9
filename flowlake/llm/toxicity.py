"""Toxicity by maximum-scoring segments.

Token weights are log-odds of toxic against clean text with a Dirichlet prior
whose mean is the token's share in all documents. A token that is clearly more
frequent in toxic texts scores its log-odds less DRIFT, any other token costs DRIFT; so clean text drifts
down and a toxic passage is a segment with a high sum. One linear scan finds all
maximal segments. Their significance follows the extreme-value law of such
sums: in n tokens of clean text a segment reaching s is expected
K * n * exp(-lambda * s) times. The best segment's expectation, turned into a
probability by a logistic curve fitted on labelled texts, is the score.

Labels are learnt from at most MAX_LABELLED rows, chosen by a hash of their id;
everything else covers all documents.

Defined results: a null or empty text has no tokens and the score of a text
without toxic tokens; labels that are null or that no document has are not used,
of several labels for one document the larger counts; without labels of both
kinds every score is the share of toxic ones, 0 if there are none; repeated
documents are scored alike; an empty table gives an empty one; other columns
stay as they are if asked for, and are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.llm.hashing import slices
from flowlake.llm.tables import stored

MAX_LABELLED = 20_000
# A token gets a weight if its share of toxic texts has at least this G-statistic
# against the share of toxic texts among all: chance alone gives that to hardly any of
# a million. Few texts can't show it, whatever they say (6 where a ninth is toxic).
MIN_G = 25.0
# ln K is the mean over the clean labelled texts and so many that say 0.
PRIOR_TEXTS = 50
PRIOR_TOKENS = 500.0
LEAST_PRIOR = 0.5
DRIFT = 0.3
# A passage is reported if clean text would show so many like it at most.
MOST_EXPECTED = 0.01

_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

Segment = tuple[int, int, float]


@dataclass(frozen=True)
class ToxicityModel:
    """weights: of tokens worth more than 0; decay and log_k: lambda and ln K;
    slope and shift: of the logistic curve."""

    weights: dict[bytes, float]
    decay: float
    log_k: float
    slope: float
    shift: float

    def surprise(self, segment_score: float, tokens: int) -> float:
        """-ln of how often clean text of that length shows such a segment."""
        return self.decay * segment_score - math.log(max(tokens, 1)) - self.log_k

    def score(self, best: float, tokens: int) -> float:
        x = self.shift + (self.slope * max(self.surprise(best, tokens), 0.0) if best > 0 else 0.0)
        return 1 / (1 + math.exp(-max(min(x, 500.0), -500.0)))


def tokens_in(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_LETTERS).split()


def segments(tokens: list[bytes], weights: dict[bytes, float]) -> list[Segment]:
    """All maximal-scoring segments (start, end, score), in one pass: each
    segment knows the nearest earlier one that starts lower."""
    get = weights.get
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum up to its end, link
    gained = 0.0
    for at, token in enumerate(tokens):
        worth = get(token)
        if worth is None:
            continue
        start, low = at, gained - DRIFT * at
        gained += worth + DRIFT
        high = gained - DRIFT * (at + 1)
        end, last = at + 1, len(found) - 1
        while True:
            while last >= 0 and found[last][2] >= low:
                last = found[last][4]
            if last < 0 or found[last][3] >= high:
                break
            start, low = found[last][0], found[last][2]
            del found[last:]
            last = len(found) - 1
        found.append((start, end, low, high, last))
    return [(s, e, high - low) for s, e, low, high, _ in found]


def _labelled(docs: DataFrame, labels: DataFrame, usable, text: str) -> DataFrame:
    """__text and toxic of the labelled sample."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = known.count()
    if rows > MAX_LABELLED:
        place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
        known = known.filter(place < MAX_LABELLED / rows)
    # Bounded by MAX_LABELLED rows of two numbers, give or take the hash's spread.
    return docs.select("doc_id", docs[text].alias("__text")).join(F.broadcast(known), "doc_id").select("doc_id", "__text", "toxic")


def _token_counts(sample: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            uses, texts = (Counter(), Counter()), (Counter(), Counter())
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = Counter(tokens_in(text))
                uses[toxic > 0].update(own)
                texts[toxic > 0].update(own.keys())
            words = list(uses[0].keys() | uses[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary())] + [pa.array([c[w] for w in words], pa.int64()) for c in (*uses, *texts)],
                ["token", "clean", "toxic", "clean_texts", "toxic_texts"])

    rows = sample.mapInArrow(count, "token binary, clean long, toxic long, clean_texts long, toxic_texts long")
    return rows.groupBy("token").agg(*(F.sum(c).alias(c) for c in ("clean", "toxic", "clean_texts", "toxic_texts")))


def _g(toxic_texts: int, clean_texts: int, share: float) -> float:
    """Twice the log-likelihood gain of the token's own share of toxic texts
    over the common one; 0 if it is no larger."""
    n = toxic_texts + clean_texts
    if toxic_texts <= n * share:
        return 0.0
    clean = clean_texts * math.log(clean_texts / (n * (1 - share))) if clean_texts else 0.0
    return 2 * (toxic_texts * math.log(toxic_texts / (n * share)) + clean)


def _background(docs: DataFrame, text: str, tokens: set[bytes]) -> tuple[dict[bytes, int], int]:
    """Uses of some tokens in all documents, and of all tokens together."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses, total = Counter(), 0
        for batch in (part for whole in batches for part in slices(whole)):
            for body in batch.column(0).to_pylist():
                own = tokens_in(body)
                total += len(own)
                uses.update(t for t in own if t in tokens)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *uses.keys()], pa.binary()), pa.array([total, *uses.values()], pa.int64())], ["token", "n"])

    rows = docs.select(docs[text]).mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    found = {None if r["token"] is None else bytes(r["token"]): r["n"] for r in rows}
    return found, found.pop(None, 0)


def _decay(clean: dict[float, float]) -> float:
    """lambda: the root above 0 of sum(p * exp(lambda * score)) = 1."""
    total = lambda x: sum(p * math.exp(min(x * s, 700.0)) for s, p in clean.items()) - 1
    high = 1.0
    while total(high) < 0 and high < 1e3:
        high *= 2
    low = 0.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 0 else (low, middle)
    return high


def _logistic(rows: list[tuple[float, int]]) -> tuple[float, float]:
    """slope, shift by Newton's method with a light ridge; rows: x, 0/1."""
    slope, shift = 0.0, 0.0
    for _ in range(60):
        g0 = g1 = 0.0
        h00 = h11 = 1e-6
        h01 = 0.0
        g1 -= 1e-3 * slope
        h11 += 1e-3
        for x, y in rows:
            p = 1 / (1 + math.exp(-max(min(shift + slope * x, 500.0), -500.0)))
            v = p * (1 - p)
            g0, g1 = g0 + y - p, g1 + (y - p) * x
            h00, h01, h11 = h00 + v, h01 + v * x, h11 + v * x * x
        det = h00 * h11 - h01 * h01
        if det <= 0:
            break
        d0, d1 = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        scale = min(1.0, 4.0 / max(abs(d0), abs(d1), 1e-12))
        shift, slope = shift + scale * d0, slope + scale * d1
        if max(abs(d0), abs(d1)) < 1e-9:
            break
    return slope, shift


def _best_segments(sample: DataFrame, weights: dict[bytes, float]) -> list[tuple[float, int, int]]:
    """Best segment score, tokens and label of each labelled text."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            found = []
            for text in batch.column(1).to_pylist():
                own = tokens_in(text)
                found.append((max((s for _, _, s in segments(own, weights)), default=0.0), len(own)))
            best, n = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.float64()), pa.array(n, pa.int64()), batch.column(2)],
                ["doc_id", "best", "n", "toxic"])

    rows = sample.mapInArrow(scan, "doc_id long, best double, n long, toxic int").collect()
    return [(r["best"], r["n"], int(r["toxic"] > 0)) for r in sorted(rows)]


def fit(docs: DataFrame, labels: DataFrame, usable=lambda doc_id: F.lit(True), text: str = "text") -> ToxicityModel:
    """usable(doc_id column): which labels may be learnt from."""
    # Read several times below; its rows get their numbers once they are written.
    sample = stored(_labelled(docs, labels, usable, text).withColumn("__row", F.monotonically_increasing_id()), "labelled-texts")
    # Copies of one text count once.
    firsts = sample.groupBy(F.xxhash64("__text").alias("hash"), "toxic").agg(F.min("__row").alias("__row")).select("__row")
    different = sample.join(firsts, "__row", "left_semi").drop("__row")
    sample = sample.drop("__row")
    counts = stored(_token_counts(different), "token-counts")
    texts = {r["toxic"]: r["n"] for r in different.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = counts.agg(F.sum("clean"), F.sum("toxic")).first()
    n_clean, n_toxic = n_clean or 0, n_toxic or 0
    if not n_clean or not n_toxic:
        share = 1.0 if n_toxic else 0.0
        return ToxicityModel({}, 1.0, 0.0, 0.0, 500.0 if share else -500.0)
    toxic_share = texts[True] / (texts[True] + texts[False])
    # Tokens in fewer toxic texts can't reach MIN_G. At most the sample's toxic tokens.
    least = MIN_G / (2 * math.log(1 / toxic_share))
    rows = counts.filter(F.col("toxic_texts") >= least).collect()
    background, total = _background(docs, text, {bytes(r["token"]) for r in rows})
    weights: dict[bytes, float] = {}
    share: dict[bytes, float] = {}
    for r in rows:
        token = bytes(r["token"])
        prior = max(PRIOR_TOKENS * background.get(token, 0) / total, LEAST_PRIOR)
        toxic, clean = r["toxic"] + prior, r["clean"] + prior
        odds = math.log(toxic / (n_toxic + PRIOR_TOKENS - toxic)) - math.log(clean / (n_clean + PRIOR_TOKENS - clean))
        if odds > DRIFT and _g(r["toxic_texts"], r["clean_texts"], toxic_share) >= MIN_G:
            weights[token] = odds - DRIFT
            share[token] = clean / (n_clean + PRIOR_TOKENS)
    scores: dict[float, float] = {-DRIFT: 1 - sum(share.values())}
    for token, p in share.items():
        scores[weights[token]] = scores.get(weights[token], 0.0) + p
    decay = _decay(scores) if weights else 1.0
    best = _best_segments(sample, weights)
    clean = [decay * s - math.log(n) for s, n, toxic in best if not toxic and s > 0 and n]
    # The mean of the law is ln K + Euler's constant; few texts leave K near 1.
    log_k = sum(x - 0.5772156649 for x in clean) / (len(clean) + PRIOR_TEXTS)
    plain = ToxicityModel(weights, decay, log_k, 1.0, 0.0)
    slope, shift = _logistic([(max(plain.surprise(s, n), 0.0) if s > 0 else 0.0, toxic) for s, n, toxic in best])
    return ToxicityModel(weights, decay, log_k, slope, shift)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, score (0 to 1) and passages: the segments that clean
    text of that length hardly shows, as token spans with their scores and how
    many of them clean text would show. A kept column with a result's name gives
    way to the result."""
    keep = [c for c in keep if c not in ("score", "passages")]
    passage = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            scores, passages = [], []
            for body in batch.column(len(keep)).to_pylist():
                own = tokens_in(body)
                found = segments(own, model.weights)
                scores.append(model.score(max((s for _, _, s in found), default=0.0), len(own)))
                rated = [(s, e, v, math.exp(-model.surprise(v, len(own)))) for s, e, v in found]
                passages.append([dict(zip(("start", "end", "score", "expected"), r)) for r in rated if r[3] <= MOST_EXPECTED])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [pa.array(scores, pa.float64()), pa.array(passages, passage)],
                [*keep, "score", "passages"])

    schema = T.StructType([docs.schema[c] for c in keep]).add("score", T.DoubleType()).add(
        "passages", T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())
                                .add("score", T.DoubleType()).add("expected", T.DoubleType())))
    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(scan, schema)
