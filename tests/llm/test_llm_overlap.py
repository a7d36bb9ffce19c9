import random
import re
from collections import defaultdict

import numpy as np
import pytest

from flowlake.llm import decontaminate, jaccard_join, line_dedup, substring_dedup
from flowlake.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, items string, hits int, key long, node long, n_words int"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", 1, 2, 3, 4) for i, t in rows], DOCS).repartition(3)


def prose(rng, n, alphabet="abcdefgh", length=3):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, length + 1))) for _ in range(n))


def corpus(seed, n=60):
    """Texts with exact and near copies, shared passages, and odd rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 120)) for _ in range(n)]
    passage = prose(rng, 45)
    for i in range(0, n, 3):
        words = texts[i].split()
        at = rng.randrange(len(words) + 1)
        texts.append(" ".join(words[:at] + passage.split() + words[at:]))
    for i in range(0, n, 4):
        words = texts[i].split()
        words[rng.randrange(len(words))] = "changed"
        texts += [" ".join(words), texts[i], texts[i].upper()]
    texts += [None, "", " \n\t ", "one", "ONE", "one two three", passage * 2, prose(rng, 3000), "\n".join([passage] * 3)]
    rng.shuffle(texts)
    return list(enumerate(texts))


# --- decontamination -----------------------------------------------------------


def contamination(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    words, hit, found = split(text), set(), set()
    for item, body in items:
        own = split(body)
        k = min(10, len(own))
        for window in {tuple(own[i:i + k]) for i in range(len(own) - k + 1)} if own else ():
            for i in range(len(words) - k + 1):
                if tuple(words[i:i + k]) == window and item is not None:
                    hit.update(range(i, i + k))
                    found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [200_000, 60])
def test_decontamination_against_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    rng = random.Random(4)
    docs = corpus(4, 30)
    items = [(i, prose(rng, rng.choice([1, 2, 4, 9, 10, 11, 30]), "ab", 2)) for i in range(12)]
    items += [(100, docs[5][1]), (100, docs[7][1]), (101, None), (102, ""), (None, "changed")]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, at int")
    rows = docs + [docs[5], (None, docs[7][1])]
    got = sorted(((r.doc_id is None, r.doc_id, r.n_words, sum(h["end"] - h["start"] for h in r.hits), r["items"])
                  for r in decontaminate.find_contamination(documents(spark, rows), bench).collect()), key=str)
    want = sorted(((i is None, i, *contamination(t, items)) for i, t in rows), key=str)
    assert got == want


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(documents(spark, [(1, "a b")]), none).first()["hits"] == []
    assert decontaminate.find_contamination(documents(spark, []), none).count() == 0


# --- Jaccard join ---------------------------------------------------------------


def similar_components(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    label = list(range(len(rows)))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    lowest = defaultdict(lambda: None)
    for (i, _), own in zip(rows, label):
        if i is not None:
            lowest[own] = i if lowest[own] is None else min(lowest[own], i)
    return sorted(((i, len(s), lowest[own]) for (i, _), s, own in zip(rows, sets, label)), key=str)


@pytest.mark.parametrize("pivots", [64, 1])
def test_components_against_brute_force(spark, monkeypatch, pivots):
    """Also with blocks so small that regions and clusters are cut into many."""
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    if pivots == 1:
        for name, value in (("REGION_BLOCK", 4), ("REGION_ROWS", 30), ("CLUSTER_SHINGLES", 400), ("LEAF", 3), ("TASK_EDGES", 5)):
            monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(pivots)
    base = prose(rng, 60).split()
    family = []
    for i in range(25):  # a chain: each differs a little from the one before
        base = base[:]
        base[rng.randrange(len(base))] = f"new{i}"
        family.append(" ".join(base))
    rows = [(i, t) for i, t in corpus(pivots, 25)] + [(1000 + i, t) for i, t in enumerate(family)]
    rows += [rows[3], (None, family[4])]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.find_components(documents(spark, rows)).collect()), key=str)
    assert got == similar_components(rows)


def test_a_large_group_of_near_copies(spark):
    """2,000 different texts made from one, at similarities around the threshold: some
    are linked with many, some with none, and chains lead from one to the other."""
    rng = random.Random(12)
    base = prose(rng, 120).split()
    rows = []
    for i in range(2000):
        words = base[:]
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            words[rng.randrange(120)] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.find_components(documents(spark, rows)).collect()), key=str)
    expected = similar_components(rows)
    assert got == expected and 1 < len({c for *_, c in expected}) < 1000


def test_cells_keep_every_link():
    """Division into cells against all pairs, on sets with clusters within clusters."""
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(6):
        centre = rng.integers(0, 1 << 60, 90)
        for _ in range(8):
            own = np.where(rng.random(90) < 0.25, rng.integers(0, 1 << 60, 90), centre)
            sets += [np.unique(np.where(rng.random(90) < rng.choice([0.02, 0.06, 0.12]), rng.integers(0, 1 << 60, 90), own)) for _ in range(12)]
    cells = jaccard_join.Cells([s.astype(np.uint64) for s in sets], np.arange(len(sets)))
    cells.join(np.arange(len(sets)))
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    pairs = lambda labels: {(i, labels.index(x)) for i, x in enumerate(labels)}
    assert pairs(cells.forest.label.tolist()) == pairs(label) and 6 < len(set(label)) < len(sets)
    assert len(cells.forest.edges) == len(sets) - len(set(label))


def test_folds_never_exceed_the_distance():
    rng = np.random.default_rng(4)
    for size in (5, 300, 1100, 2047, 2048, 5000):
        a = rng.integers(0, 1 << 63, size).astype(np.uint64)
        b = np.concatenate([a[: int(size * 0.9)], rng.integers(0, 1 << 63, size // 8).astype(np.uint64)])
        texts = [np.unique(a), np.unique(b)]
        text = np.repeat([0, 1], [len(t) for t in texts])
        n = np.array([len(t) for t in texts])
        folds = [np.frombuffer(v.as_buffer(), np.uint8) for v in jaccard_join._folded(text, np.concatenate(texts), n)]
        assert [int(f.sum()) for f in folds] == n.tolist()
        common = len(np.intersect1d(*texts))
        forest = jaccard_join.Forest(np.arange(2))
        jaccard_join.connect_near(n, folds, forest, np.arange(2))
        if 100 * common >= 80 * (n.sum() - common):
            assert forest.edges


def test_full_buckets_bring_sets_closer_only():
    """A set whose shingles crowd a few buckets, against one folded half as fine."""
    a = np.arange(1, 2048, dtype=np.uint64) << np.uint64(40)
    b = np.arange(1, 2149, dtype=np.uint64) << np.uint64(40)
    n = np.array([len(a), len(b)])
    text = np.repeat([0, 1], n)
    folds = [np.frombuffer(v.as_buffer(), np.uint8) for v in jaccard_join._folded(text, np.concatenate([a, b]), n)]
    assert len(folds[1]) == 2 * len(folds[0]) and folds[0].max() == 255
    forest = jaccard_join.Forest(np.arange(2))
    jaccard_join.connect_near(n, folds, forest, np.arange(2))
    assert forest.edges


def test_jaccard_of_nothing(spark):
    assert jaccard_join.find_components(documents(spark, [])).count() == 0
    got = jaccard_join.find_components(documents(spark, [(1, None), (2, ""), (3, " ")])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(1, 0, 1), (2, 0, 2), (3, 0, 3)}


def test_connected_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(30)] + [(500, i) for i in range(400, 440)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    edges += [(7, 7), (None, 3), (5, None)]
    label = {x: x for e in edges for x in e if x is not None}
    for _ in range(200):
        for a, b in edges:
            if a is not None and b is not None:
                label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    assert got == {x: label[x] for x in linked}


# --- lines and passages -----------------------------------------------------------


def kept_lines(rows, run=line_dedup.RUN):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    seen, out = {}, {}
    for k in order:
        lines = (rows[k][1] or "").split("\n")
        full = [i for i, line in enumerate(lines) if line.strip()]
        gone = set()
        for s in range(len(full) - run + 1):
            window = tuple(lines[i] for i in full[s:s + run])
            if seen.setdefault(window, (rows[k], s)) != (rows[k], s):
                gone.update(full[s:s + run])
        out[k] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return sorted(((rows[k][0], None if rows[k][1] is None else out[k]) for k in out), key=str)


def test_lines_against_brute_force(spark):
    rng = random.Random(9)
    pool = ["alpha", "beta", "", "gamma", "  ", "delta"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14)))) for i in range(40)]
    rows += [(100, None), (101, ""), (None, "alpha\nbeta\ngamma"), (102, "\n".join(f"line {i}" for i in range(3000))), (103, "only\ntwo")]
    rows += [rows[5]]
    df = documents(spark, rows)
    out = line_dedup.delete_repeated_lines(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == kept_lines(rows)
    assert line_dedup.delete_repeated_lines(documents(spark, [])).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def kept_lines_of_any_length(rows, long=line_dedup.LONG):
    """As kept_lines, but runs of one or two lines count if they have more than `long` words."""
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    seen, out = {}, {}
    for k in order:
        lines = rows[k][1].split("\n")
        full, gone = [i for i, line in enumerate(lines) if line.strip()], set()
        for run in range(1, line_dedup.RUN + 1):
            for s in range(len(full) - run + 1):
                window = tuple(lines[i] for i in full[s:s + run])
                if run == line_dedup.RUN or sum(len(line.split()) for line in window) > long:
                    if seen.setdefault(window, (rows[k], s)) != (rows[k], s):
                        gone.update(full[s:s + run])
        out[k] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return sorted((rows[k][0], out[k]) for k in out)


def test_long_passages_of_one_or_two_lines(spark):
    rng = random.Random(10)
    line = lambda n: " ".join(rng.choice("abcdefgh") * 3 for _ in range(n))
    pool = [line(n) for n in (51, 50, 60, 30, 25, 26, 21, 3, 2, 1)] + ["", " \t ", line(40) + "\t\t x  y " + line(8), line(41) + " \t x  y " + line(8)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 10)))) for i in range(60)]
    rows += [(100, f"{pool[0]}\nnew"), (101, f"other\n{pool[1]}\nmore"), (102, f"start\n{pool[4]}\n{pool[5]}\nend"), (103, pool[0])]
    want = kept_lines_of_any_length(rows)
    assert want != sorted(kept_lines(rows)) and dict(want)[100] == "new" and dict(want)[103] == "" and dict(want)[101] == rows[-3][1]
    df = documents(spark, rows)
    got = lambda **more: sorted((r.doc_id, r.text) for r in line_dedup.delete_repeated_lines(df, **more).collect())
    assert got() == want
    assert got(long=None) == sorted(kept_lines(rows))


def kept_words(rows, window=substring_dedup.WINDOW):
    distinct = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = {}, {}
    for row in distinct:
        words = re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")
        gone = set()
        for s in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[s:s + window]), (row, s)) != (row, s):
                gone.update(range(s, s + window))
        out[row] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return sorted(((r[0], *out[r]) for r in rows), key=str)


@pytest.mark.parametrize("odd", [False, True])
def test_passages_against_brute_force(spark, monkeypatch, odd):
    monkeypatch.setattr(substring_dedup, "CHUNK_WORDS", 400)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 2_000)
    rows = corpus(13, 40)
    if odd:  # repeated rows and a row without an id
        rows += [rows[2], rows[9], (None, rows[4][1])]
    df = documents(spark, rows).cache()
    got = substring_dedup.remove_repeats(df).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == kept_words(rows)
    assert any(r.n_removed for r in got)


def test_passages_of_nothing(spark):
    assert substring_dedup.remove_repeats(documents(spark, [])).count() == 0
    got = substring_dedup.remove_repeats(documents(spark, [(1, None), (2, "")])).collect()
    assert {(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got} == {(1, 0, 0, ""), (2, 0, 0, "")}
