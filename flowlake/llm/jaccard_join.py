"""Exact Jaccard join of word shingles in its metric space, for components.

1 - J is a metric. Over whole texts alone pivots divide nothing: nearly all documents
have no shingle in common, are equally far (1) from nearly every pivot, and no window
of the triangle inequality rules anyone out. So the join first finds where distances
differ, and divides there:

1. Regions. Two linked documents always share a shingle among the first
   n - ceil(0.8 n) + 1 of any common order, so all documents with such a shingle make
   one region. Regions with the same members are one.
2. Clusters. Counts of shingles by hash bucket bring sets only closer: half the sum of
   their differences is a distance that never exceeds the true one. Members of a region
   that are too far apart even so aren't linked; the others are connected, over all
   regions, to clusters. Links never leave a cluster, and every document is in one.
3. Cells. Within a cluster pivots are chosen, every member goes to the cell of the nearest
   one, and boundary members are replicated to each cell whose pivot is at most twice
   the radius farther away: of two linked documents both are then in the cell of either.
   A cell is divided again until it is small or divides no more, and then compared.
   Whoever is linked with a pivot, or has become part of one component, isn't compared.

Shingle sets are sent once, to the task of their cluster, and only the edges of a
spanning forest come back; no pair is ever a row. A region or a cluster too large for a
task is cut into blocks, see `_forest`. Documents with one shingle set are one class from
the start. Any order of the shingles is right; those that are frequent in a bounded
sample of documents come last, which keeps regions small where many share a passage.

Defined results: A-Z are folded; a null text or one without words has no shingles
and stands alone; with fewer than five words the whole sequence is the only
shingle; a null id is smaller than none, so a component takes the smallest id
that is not null; repeated rows are linked; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlake.llm.components import connected_components
from flowlake.llm.hashing import LOWER, WHITE_SPACE, mix, runs_inside, runs_of, slices, words_of
from flowlake.llm.tables import BUILD_SIDE, stored

WORDS = 5
# J >= 80 %, distance <= 20 %.
PERCENT = 80
RADIUS = 1 - PERCENT / 100
# The order of shingles looks at so many documents, and keeps so many shingles.
ORDER_DOCUMENTS = 5_000
ORDER_SHINGLES = 100_000
SLICE_BYTES = 3_000_000
# Hash buckets of a set, at least; they double with its size, from 8 shingles each on.
FOLDS = 16
FULL = 255
# Members of a block of a region, and of the regions that share a task, about.
REGION_BLOCK = 4096
REGION_ROWS = 20_000
# Shingles of a block of a cluster, and of the clusters that share a task, about.
CLUSTER_SHINGLES = 1_000_000
# So many edges are one task's work; more are joined step by step.
TASK_EDGES = 1_000_000
# Pivots of a division, and members that are compared without one.
PIVOTS, LEAF = 8, 32

_EDGES = "a long, b long"


def shingles_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and hash of every distinct shingle, sorted by both, and the
    number of shingles of each text."""
    words = words_of(texts, WHITE_SPACE, LOWER)
    counts, total = words.counts(), len(words.hashes)
    number = np.repeat(np.arange(len(texts)), counts)
    inside = runs_inside(words.bounds, WORDS, total)
    text, hashes = [number[:len(inside)][inside]], [runs_of(words.hashes, WORDS)[inside]]
    for k in range(1, WORDS):
        short = np.flatnonzero(counts == k)
        if len(short):
            text.append(short)
            hashes.append(runs_of(words.hashes, k)[words.bounds[short]])
    text, hashes = np.concatenate(text), np.concatenate(hashes)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    text, hashes = text[fresh], hashes[fresh]
    return text, hashes, np.bincount(text, minlength=len(texts))


def _set_hashes(text: np.ndarray, hashes: np.ndarray, texts: int, salt: int) -> np.ndarray:
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes + np.uint64(salt)), out=sums[1:])
    bounds = np.searchsorted(text, np.arange(texts + 1))
    return mix(sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for part in slices(batch, SLICE_BYTES):
        yield part, part.column(column)


def _folded(text: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> pa.Array:
    """How many shingles of each text fall into each of its hash buckets, in a byte; more
    than FULL count as FULL, which brings sets closer still. Buckets go by leading bits,
    so two neighbours are one of half as many."""
    bits = np.maximum(np.frexp(n / 4)[1] - 1, FOLDS.bit_length() - 1).astype(np.uint64)
    sizes = np.int64(1) << bits.astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    bucket = (hashes >> (np.uint64(64) - bits[text])).astype(np.int64)
    counts = np.minimum(np.bincount(bucket + starts[text], minlength=int(sizes.sum())), FULL).astype(np.uint8)
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(counts)])


def _members(docs: DataFrame, salt: int) -> DataFrame:
    """doc_id, n, node and check (two hashes of the shingle set) and folds."""
    def run(batches):
        for batch in batches:
            for part, texts in _texts(batch, 1):
                text, hashes, n = shingles_of(texts)
                node, check = (_set_hashes(text, hashes, len(texts), s) for s in (salt, salt + 0x5DEECE66D))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(node), pa.array(check), _folded(text, hashes, n)],
                    ["doc_id", "n", "node", "check", "folds"])

    return docs.mapInArrow(run, "doc_id long, n long, node long, check long, folds binary")


def _frequent(docs: DataFrame) -> np.ndarray:
    """Sorted shingles that stand in three of the sampled documents or more."""
    rows = docs.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = docs if rows <= ORDER_DOCUMENTS else docs.filter(place < ORDER_DOCUMENTS / rows)

    def run(batches):
        for batch in batches:
            for _, texts in _texts(batch, 1):
                yield pa.RecordBatch.from_arrays([pa.array(shingles_of(texts)[1].view(np.int64))], ["shingle"])

    counts = sample.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 2")
    found = counts.orderBy(F.desc("n"), "shingle").limit(ORDER_SHINGLES).toArrow()
    return np.sort(found.column("shingle").to_numpy().view(np.uint64))


def _prefixes(docs: DataFrame, frequent: np.ndarray, salt: int) -> DataFrame:
    """shingle, node: the first n - ceil(0.8 n) + 1 shingles of every text."""
    def run(batches):
        for batch in batches:
            for _, texts in _texts(batch, 1):
                text, hashes, n = shingles_of(texts)
                node = _set_hashes(text, hashes, len(texts), salt)
                # Copies within a slice count once.
                once = np.zeros(len(texts), bool)
                once[np.unique(node, return_index=True)[1]] = True
                use = once[text]
                text, hashes = text[use], hashes[use]
                if len(frequent) and len(hashes):
                    at = np.searchsorted(frequent, hashes)
                    late = frequent[np.minimum(at, len(frequent) - 1)] == hashes
                    order = np.lexsort((hashes, late, text))
                    text, hashes = text[order], hashes[order]
                rank = np.arange(len(text)) - np.searchsorted(text, text)
                first = rank < (n - (n * PERCENT + 99) // 100 + 1)[text]
                text, hashes = text[first], hashes[first]
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(node[text])], ["shingle", "node"])

    return docs.mapInArrow(run, "shingle long, node long")


def _regions(prefixes: DataFrame) -> DataFrame:
    """region, members (how many) and node, for every set of classes that share a
    shingle. A region is named by a hash of its members; should two sets have one name
    they are compared as one. Rows are sorted within a shingle, and spilled, not held."""
    own = Window.partitionBy("shingle")
    again = F.lag("node").over(own.orderBy("node")).eqNullSafe(F.col("node"))
    once = prefixes.withColumn("again", again).withColumn("one", F.when(F.col("again"), 0).otherwise(1))
    named = once.withColumns({
        "members": F.sum("one").over(own),
        # Sums of 32 bits each don't overflow.
        "region": F.sum(F.when(~F.col("again"), F.shiftright(F.xxhash64("node"), 32))).over(own),
    })
    shared = named.filter("NOT again AND members > 1")
    return shared.select(F.xxhash64("region", "members").alias("region"), "members", "node").distinct()


def _sets(docs: DataFrame, wanted: DataFrame, salt: int) -> DataFrame:
    """wanted (doc_id, node, whole, size) with the shingles of its classes, eight
    bytes each, in place of the id."""
    def run(batches):
        for batch in batches:
            for part, texts in _texts(batch, 1):
                text, hashes, _ = shingles_of(texts)
                node = _set_hashes(text, hashes, len(texts), salt)
                offsets = (np.searchsorted(text, np.arange(len(texts) + 1)) * 8).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(hashes)])
                found = pa.RecordBatch.from_arrays([*part.columns[2:], packed], ["node", "whole", "size", "shingles"])
                # Another row with the id may have another set.
                yield found.filter(pa.array(node == part.column(2).to_numpy()))

    rows = docs.join(wanted.withColumnRenamed("doc_id", "__id").hint(BUILD_SIDE), F.col("doc_id").eqNullSafe(F.col("__id")))
    found = rows.select("doc_id", "text", "node", "whole", "size").mapInArrow(run, "node long, whole long, size long, shingles binary")
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    return found if ids.isEmpty() else found.dropDuplicates(["node"])


class Forest:
    """Components of places, and the edges that made them. `known`: the component each
    place is in already."""

    def __init__(self, known: np.ndarray) -> None:
        _, first, place = np.unique(known, return_index=True, return_inverse=True)
        self.label = first[place]
        self.edges: list[tuple[int, int]] = []

    def link(self, one: int, others: np.ndarray) -> None:
        """Of each other component one edge is enough."""
        labels, first = np.unique(self.label[others], return_index=True)
        strange = labels != self.label[one]
        self.edges.extend((one, int(o)) for o in others[first[strange]])
        self.label[np.isin(self.label, labels)] = self.label[one]

    def split(self, places: np.ndarray) -> bool:
        return len(places) > 1 and bool((self.label[places] != self.label[places[0]]).any())


def connect_near(n: np.ndarray, folds: list[np.ndarray], forest: Forest, places: np.ndarray) -> None:
    """Connects the places whose folds are near enough to be linked: sets of a and b
    shingles with a difference of at most (a + b) / 9."""
    by_size: dict[int, list[int]] = {}
    for place in places.tolist():
        by_size.setdefault(len(folds[place]), []).append(place)
    for size, own in by_size.items():
        # Sets of linked sizes have as many buckets, or twice as many.
        rows = [folds[p] for p in own]
        rows += [np.minimum(folds[p].reshape(-1, 2).sum(axis=1, dtype=np.int16), FULL) for p in by_size.get(2 * size, [])]
        both = np.array([*own, *by_size.get(2 * size, [])])
        table = np.stack(rows).astype(np.int16)
        for i in range(len(own)):
            others = i + 1 + np.flatnonzero(forest.label[both[i + 1:]] != forest.label[both[i]])
            a, b = n[both[others]], n[both[i]]
            others = others[np.minimum(a, b) * 100 >= np.maximum(a, b) * PERCENT]
            if len(others):
                apart = np.abs(table[others] - table[i]).sum(axis=1, dtype=np.int64)
                near = apart * (100 + PERCENT) <= (n[both[others]] + n[both[i]]) * (100 - PERCENT)
                if near.any():
                    forest.link(both[i], both[others[near]])


def _near_in_regions(table: pa.Table) -> pa.Table:
    """One task's regions, or a block of a large one: a forest of near members."""
    region, node, n = (table.column(c).to_numpy() for c in ("whole", "node", "n"))
    raw = table.column("folds").combine_chunks()
    folds = [np.frombuffer(v.as_buffer(), np.uint8) for v in raw]
    order = np.argsort(region, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(region[order], prepend=region[order[0]] - 1)), len(order))
    forest = Forest(table.column("known").to_numpy())
    for start, end in zip(edges, edges[1:]):
        connect_near(n, folds, forest, order[start:end])
    return _edges(forest, node)


def _edges(forest: Forest, node: np.ndarray) -> pa.Table:
    found = np.array(forest.edges, np.int64).reshape(-1, 2)
    return pa.table({"a": node[found[:, 0]], "b": node[found[:, 1]]})


class Cells:
    """The sets of one group of clusters; places are row numbers."""

    def __init__(self, sets: list[np.ndarray], known: np.ndarray) -> None:
        self.n = np.array([len(s) for s in sets])
        self.bounds = np.append(0, np.cumsum(self.n))
        # Shingles numbered from 0.
        different, self.shingle = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(different), bool)
        self.forest = Forest(known)

    def common(self, one: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections."""
        own = self.shingle[self.bounds[one]:self.bounds[one + 1]]
        self.mark[own] = True
        sizes = self.n[others]
        starts = np.cumsum(sizes) - sizes
        places = np.arange(int(sizes.sum())) + np.repeat(self.bounds[others] - starts, sizes)
        found = np.add.reduceat(self.mark[self.shingle[places]], starts, dtype=np.int64)
        self.mark[own] = False
        return found

    def compare(self, one: int, others: np.ndarray) -> np.ndarray:
        """Links one place with the others it is linked to; the distances."""
        common = self.common(one, others)
        either = self.n[others] + self.n[one] - common
        linked = common * 100 >= either * PERCENT
        if linked.any():
            self.forest.link(one, others[linked])
        return 1 - common / either

    def join(self, places: np.ndarray) -> None:
        """All links among the places, but for those within one component."""
        if not self.forest.split(places):
            return
        if len(places) > LEAF:
            pivots = places[np.linspace(0, len(places) - 1, PIVOTS).astype(int)]
            away = np.stack([self.compare(p, places) for p in pivots], axis=1)
            least = away.min(axis=1, keepdims=True)
            # The nearest pivot's cell, and boundary members of the others.
            inside = away <= least + 2 * RADIUS + 1e-9
            cells = [places[inside[:, c]] for c in range(PIVOTS) if (away[:, c] == least[:, 0]).any()]
            # Worth it if the pairs within the cells are fewer than those among all.
            if sum(len(cell) ** 2 for cell in cells) <= 0.8 * len(places) ** 2:
                for cell in cells:
                    self.join(cell)
                return
        for i in range(len(places) - 1):
            others = places[i + 1:]
            others = others[self.forest.label[others] != self.forest.label[places[i]]]
            a, b = self.n[others], self.n[places[i]]
            others = others[np.minimum(a, b) * 100 >= np.maximum(a, b) * PERCENT]
            if len(others):
                self.compare(places[i], others)


def _links_in_clusters(table: pa.Table) -> pa.Table:
    """One task's clusters, or a block of a large one: a forest of links."""
    cluster, node = table.column("whole").to_numpy(), table.column("node").to_numpy()
    sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("shingles").combine_chunks()]
    order = np.lexsort((node, cluster))
    cells = Cells(sets, table.column("known").to_numpy())
    edges = np.append(np.flatnonzero(np.diff(cluster[order], prepend=cluster[order[0]] - 1)), len(order))
    for start, end in zip(edges, edges[1:]):
        cells.join(order[start:end])
    return _edges(cells.forest, node)


def _components_at_once(table: pa.Table) -> pa.Table:
    """node and component (the smallest node) of a bounded number of edges."""
    a, b = table.column("a").to_numpy(), table.column("b").to_numpy()
    node, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[:len(a)], place[len(a):]
    label = np.arange(len(node))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return pa.table({"node": node, "component": node[label]})
        label = new


def _components(edges: DataFrame) -> DataFrame:
    """node and component of all nodes with an edge; edges: stored."""
    if edges.count() > TASK_EDGES:
        return connected_components(edges)
    found = edges.groupBy(F.lit(0).alias("all")).applyInArrow(_components_at_once, "node long, component long")
    return stored(found, "components")


def _forest(rows: DataFrame, room: int, tasks: int, connect: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """a, b: a forest of the links that `connect` finds within each whole (a region or a
    cluster). rows (stored): whole, size (of the whole), node and what `connect` reads.

    Wholes up to `room` share so many tasks, so each row is sent once. A larger one is cut into
    blocks. First every block is joined by itself, with some members of the whole as
    pivots in all of them, which leaves most of a group of near copies in one component.
    Then all but the largest component's members are sent to every block: of two members
    of different components one is such a stray, and meets the other in its block. So
    what is sent grows with the strays, not with the square of the whole."""
    key = lambda seed: F.xxhash64("node", F.lit(seed))
    blocks = F.ceil(F.col("size") / room)

    def joined(placed: DataFrame) -> DataFrame:
        return stored(placed.groupBy("task", "block").applyInArrow(connect, _EDGES), "forest")

    small = rows.filter(F.col("size") <= room).withColumn("known", F.col("node"))
    shared = F.pmod(F.xxhash64("whole", F.lit(5)), F.lit(max(1, tasks)))
    found = joined(small.withColumns({"task": shared, "block": F.lit(-1).cast("long")}))
    large = rows.filter(F.col("size") > room).withColumns({"task": F.col("whole"), "block": F.pmod(key(3), blocks)})
    if large.isEmpty():
        return found
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    by_hash = Window.partitionBy("whole").orderBy(key(7), "node")
    pivots = large.withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= PIVOTS).drop("rank")
    pivots = pivots.withColumn("own", F.col("block")).withColumn("block", everywhere).filter("block <> own").drop("own")
    first = joined(large.unionByName(pivots).withColumn("known", F.col("node")))
    components = _components(first).withColumnRenamed("component", "known")
    known = stored(large.join(components, "node", "left").select("whole", "node", F.coalesce("known", "node").alias("known")), "known-components")
    counts = known.groupBy("whole", "known").agg(F.count("*").alias("n"))
    largest = counts.groupBy("whole").agg(F.max_by("known", F.struct("n", "known")).alias("largest"))
    labelled = large.join(known.join(largest, "whole").hint(BUILD_SIDE), ["whole", "node"])
    strays = labelled.filter("known <> largest").withColumn("own", F.col("block")).withColumn("block", everywhere).filter("block <> own")
    second = joined(labelled.unionByName(strays.drop("own")))
    return found.unionAll(first).unionAll(second)


def _join_regions(docs: DataFrame, members: DataFrame, salt: int) -> DataFrame:
    """node, component: over all regions; classes in no region are left out."""
    regions = stored(_regions(_prefixes(docs, _frequent(docs), salt)), "regions")
    rows = regions.count()
    classes = members.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("folds").alias("folds"))
    classes = stored(classes.join(regions.select("node").distinct(), "node"), "region-classes")
    known = regions.join(classes.select("node", "n", "folds"), "node").withColumnsRenamed({"region": "whole", "members": "size"})
    near = _forest(stored(known, "region-members"), REGION_BLOCK, rows // REGION_ROWS, _near_in_regions)
    clusters = _components(near).withColumnRenamed("component", "whole")
    wanted = stored(clusters.join(classes.select("node", "doc_id", "n"), "node"), "wanted-classes")
    sizes = wanted.groupBy("whole").agg(F.sum("n").alias("size"))
    total = wanted.agg(F.sum("n")).first()[0] or 0
    placed = stored(wanted.join(sizes, "whole").select("doc_id", "node", "whole", "size"), "cluster-sizes")
    sets = stored(_sets(docs, placed, salt), "shingle-sets")
    return _components(_forest(sets, CLUSTER_SHINGLES, total // CLUSTER_SHINGLES, _links_in_clusters))


def find_components(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    salt = 1
    while True:
        members = stored(_members(docs, salt), "shingle-classes")
        twice = members.groupBy("node").agg(F.min("check").alias("x"), F.max("check").alias("y")).filter("x < y")
        if twice.isEmpty():
            break
        salt += 1  # two sets with one hash: hash anew
    real = members.filter("n > 0")
    groups = _join_regions(docs, real, salt).withColumnRenamed("node", "own")
    classes = real.groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("size"))
    classes = classes.join(groups, F.col("node") == F.col("own"), "left")
    classes = stored(classes.filter("size > 1 OR component IS NOT NULL").select("node", "low", F.coalesce("component", "node").alias("component")), "linked-classes")
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    known = stored(classes.join(lowest, "component").select("node", "component_id"), "class-components")
    shown = members.withColumn("own", F.when(F.col("n") > 0, F.col("node"))).join(
        known.withColumnRenamed("node", "own"), "own", "left")
    return shown.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
