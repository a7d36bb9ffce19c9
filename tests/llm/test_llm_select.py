"""Resampling, hard negatives and language against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from flowlake.llm import hard_negatives, language_id
from flowlake.llm import importance_resampling as resampling
from flowlake.llm.queries_select import op13_language_id

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def features(text, longest):
    words = WORDS.findall((text or "").translate(FOLD))
    runs = [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def by_hand(docs, items, longest, percent, least):
    s, t = [0] * 10_000, [0] * 10_000
    for _, text in docs:
        for b in features(text, longest)[1]:
            s[b] += 1
    for text in items:
        for b in features(text, longest)[1]:
            t[b] += 1
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000))))
    rows = []
    for doc_id, text in docs:
        n, own = features(text, longest)
        weight = sum(map(gain, own)) // len(own) if own else 0
        h = int(hashlib.sha256(f"9:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(order[:percent * len(order) // 100], 1):
        row.append(rank)
    return sorted((tuple(r) if len(r) == 6 else (*r, None) for r in rows), key=str)


def drawn(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling(spark, longest):
    rng = random.Random(4)
    vocabulary = ["Apfel", "été", "x9", "a", "the", "日本語日本語", "q" * 300, "ß" * 3000]
    text = lambda n: rng.choice([" ", "--", "\n"]).join(rng.choices(vocabulary, k=n))
    docs = [(i, text(rng.randrange(0, 12))) for i in range(60)] + [(60, None), (61, ""), (None, text(6)), (62, " ,. \n"), (63, text(3000))]
    docs += [(7, "the the a x9"), (7, "the the a x9"), (7, "the the a x9")]
    items = [text(9), "the a", None, ""]
    left = spark.createDataFrame([(i, t, 1.5, "k") for i, t in docs], "doc_id long, text string, score double, rank string").repartition(5)
    right = spark.createDataFrame([(t,) for t in items], "text string")
    got = resampling.resample(left, right, 9, 40, 4, longest=longest)
    assert drawn(got) == by_hand(docs, items, longest, 40, 4)
    assert all(type(r["rank"]) in (int, type(None)) for r in got.collect())


def test_resampling_keeps_columns_and_takes_empty_tables(spark):
    docs = spark.createDataFrame([(3, "a b", "x", 9)], "doc_id long, text string, n_lang string, weight int")
    items = spark.createDataFrame([("a",)], "text string")
    got = resampling.resample(docs, items, 9, 100, 1, keep=docs.columns).first()
    assert (got.doc_id, got.text, got.n_lang, got["rank"]) == (3, "a b", "x", 1) and got.weight != 9
    assert drawn(resampling.resample(docs, items.limit(0), 9, 100, 1)) == by_hand([(3, "a b")], [], 1, 100, 1)
    assert resampling.resample(docs.limit(0), items, 9, 10, 1).count() == 0


def test_crc_by_columns():
    rng = np.random.default_rng(1)
    values = [rng.bytes(n) for n in (*range(40), 4096, 4097, 5000) for _ in range(5)]
    rng.shuffle(values)
    offsets = np.cumsum([0, *map(len, values)])
    crcs = resampling.crc_of_values(np.frombuffer(b"".join(values), np.uint8), offsets)
    assert crcs.tolist() == [zlib.crc32(v) for v in values]
    _, number, bucket = resampling.features_of(pa.array(["Ab ab", None, "", "ab"]), 2, 10_000)
    ab, both = zlib.crc32(b"ab") % 10_000, zlib.crc32(b"ab ab") % 10_000
    assert list(zip(number, bucket)) == [(0, ab), (0, ab), (3, ab), (0, both)]


def negatives_by_hand(rows, k=5, negatives=5, percent=80):
    """rows: id, label, integer vector. The definition, one anchor at a time."""
    out = []
    for anchor, label, vector in rows:
        if anchor % 10:
            continue
        scored = sorted(((sum(a * b for a, b in zip(vector, v)), i, own) for i, own, v in rows if i != anchor), key=lambda s: (-s[0], s[1]))
        for score, positive, _ in [s for s in scored if s[2] == label][:k]:
            fitting = [s for s in scored if s[2] != label and percent * score <= 100 * s[0] <= 100 * score]
            out += [(anchor, positive, r, n, score, s) for r, (s, n, _) in enumerate(fitting[:negatives], 1)]
    return sorted(out)


NEGATIVE_COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(spark, rows, length="double", **options):
    df = spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{length}>, rank int, i string").repartition(3)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), **options)
    return sorted(tuple(r[c] for c in NEGATIVE_COLUMNS) for r in got.collect())


@pytest.mark.parametrize("length,reach", [(64, 1.0), (7, 1.0), (1, 3.0), (20, 40_000.0), (18, 2.0e5)])
def test_hard_negatives(spark, monkeypatch, length, reach):
    """Blocks and tiles so small that rows meet in many; floats wider than two bytes too."""
    for name, value in (("PACK", 16), ("ANCHOR_TILE", 4), ("ANCHOR_NUMBERS", 9 * length), ("SPREAD", 6)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(length)
    centres = rng.normal(size=(4, length))
    rows = []
    for i in range(240):
        # A third of the rows are one vector.
        v = centres[0] if i % 3 == 0 else centres[i % 4] + rng.normal(size=length) * 0.3
        rows.append((i, int(rng.integers(3)) if i != 10 else 77, [float(x) for x in v * reach], 5, "x"))
    expected = negatives_by_hand([(i, own, [math.floor(256 * x) for x in v]) for i, own, v, *_ in rows])
    assert mined(spark, rows) == expected and expected


def test_hard_negatives_with_gaps(spark):
    nan, inf = float("nan"), float("inf")
    plain = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.9, 0.1]), (3, 2, [0.9, 0.1]), (20, 3, [0.0, 0.0]), (21, 3, [0.0, 0.0]), (22, 4, [-1.0, 0.0])]
    gaps = [(4, None, [1.0, 0.0]), (5, 2, None), (6, 2, [None, 1.0]), (7, 2, [nan, 0.0]), (8, 2, [1.0, inf]), (9, 2, []), (11, 2, [1.0]), (None, 2, [0.9, 0.1])]
    twice = [(2, 9, [0.9, 0.1]), (0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0])]
    expected = negatives_by_hand([(i, own, [math.floor(256 * x) for x in v]) for i, own, v in plain])
    assert mined(spark, [(*r, 1, "i") for r in plain + gaps + twice]) == expected
    assert [e[:4] for e in expected][:2] == [(0, 1, 1, 2), (0, 1, 2, 3)]
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0], 0, "")]) == []
    assert mined(spark, [(10, None, [1.0], 0, ""), (10, 1, None, 0, "")]) == []
    with pytest.raises(ValueError, match="63 bits"):
        mined(spark, [(10, 1, [1e18], 0, "")])


def test_bounds_hold_and_rule_out(spark):
    rng = np.random.default_rng(2)
    vectors = rng.integers(-1000, 1000, (300, 50)) + np.repeat(rng.integers(-3000, 3000, (300, 5)), 10, axis=1)
    block = hard_negatives.Block.of(np.arange(300), np.zeros(300, int), vectors.astype(float), *hard_negatives.summaries(vectors))
    scores = vectors @ vectors.T
    for mean, deviation in block.levels:
        middle, spread = mean @ mean.T, deviation @ deviation.T
        assert (np.abs(scores - middle) <= spread + 1e-6).all()
    low = np.sort(scores, axis=1)[:, -5].astype(float)
    few = block.part(np.arange(2))
    columns, found, wanted = hard_negatives.left_over(few, block, low[:2], np.full(2, math.inf))
    assert len(columns) < 150 and (found == scores[:2, columns]).all() and wanted.sum(axis=1).tolist() == [5, 5]


def profile_by_hand(texts):
    uses = Counter()
    for text in texts:
        for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
            marked = f" {word} "
            uses.update(word)
            uses.update(marked[i:i + n] for n in (2, 3) for i in range(len(marked) - n + 1))
    return [g for g, _ in sorted(uses.items(), key=lambda u: (-u[1], len(u[0]), u[0]))[:300]]


def language_by_hand(text, known):
    """known: language -> profile. The nearest by out-of-place distance."""
    own = profile_by_hand([text])
    if not own or not known:
        return "und", 0.0
    away = {}
    for name, profile in known.items():
        place = {g: i for i, g in enumerate(profile)}
        away[name] = sum(abs(i - place[g]) if g in place else 300 for i, g in enumerate(own))
    best = min(sorted(away), key=away.get)
    return best, 1 - away[best] / (300 * len(own))


def usable(doc_id):
    return F.crc32(doc_id.cast("string")) % 5 != 0


def test_language_equals_the_definition(spark, sf_dir, monkeypatch):
    for name, value in (("PIECE", 700), ("HELD", 5000)):
        monkeypatch.setattr(language_id, name, value)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    by_language = {}
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 5:
            by_language.setdefault(r.lang, []).append(r.text)
    known = {name: profile_by_hand(texts) for name, texts in by_language.items()}
    got = {r.doc_id: r for r in op13_language_id(spark, sf_dir).collect()}
    assert len(got) == len(rows) and len(known) > 2
    for r in rows:
        name, score = language_by_hand(r.text, known)
        assert got[r.doc_id].lang_pred == name and got[r.doc_id].score == pytest.approx(score, abs=1e-12)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)


def test_language_of_odd_texts(spark):
    texts = ["der die und das ist", "der Mann", "the and of the", "", None, "12 -- 3!", "日本語 日本", "é" * 5000, "the " * 4000, "the and of the"]
    rows = [(i, t, "de" if i < 2 else "ja" if i == 6 else None if i == 7 else "en", 0.5) for i, t in enumerate(texts)] + [(None, "und die", "de", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double").repartition(3)
    known = {}
    for i, text, lang, _ in rows:
        if lang and text is not None and i is not None and zlib.crc32(str(i).encode()) % 5:
            known.setdefault(lang, []).append(text)
    known = {name: p for name, texts in known.items() if (p := profile_by_hand(texts))}
    named = language_id.identify(docs, language_id.fit(docs, usable), keep=docs.columns)
    assert named.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    for r in named.collect():
        name, score = language_by_hand(r.text, known)
        assert (r.lang_pred, round(r.score, 9)) == (name, round(score, 9))
    assert {r.text for r in named.filter("lang_pred = 'und'").collect()} == {"", None, "12 -- 3!"}
    nothing = language_id.fit(docs.filter("lang IS NULL"), usable)
    assert {tuple(r) for r in language_id.identify(docs, nothing, keep=[]).collect()} == {("und", 0.0)}
    assert language_id.identify(docs.limit(0), language_id.fit(docs.limit(0), usable)).count() == 0


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "abc", f"l{i}") for i in range(1, 4)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language_id.fit(docs)
