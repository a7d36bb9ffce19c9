"""Hard negatives by segment summaries.

A vector is cut into segments; of each, the mean and the deviation (the norm of what
is left without the mean) are stored. Over one segment of length L the inner product
of two vectors is L * mean * mean give or take deviation * deviation, so the sums over
the segments bound the score from both sides. A block of anchors meets a block of rows
level by level: with few long segments, with more and shorter ones for the rows that
are left, and exactly for those that no bound has ruled out. Bounds are compared with
what an anchor has found so far (its k-th best score) and with its window of scores.

The stated queries (anchors) meet all rows, in blocks of bounded size: rows travel
packed, GROUP_BYTES of them in a group, once for each block of ANCHOR_NUMBERS numbers
of anchors. A group returns at most k rows for an anchor, and the k best of those are
found by a window with a limit, so nothing is as large as the product of the two.
That every anchor has to be held against every row by its summary makes the work grow
with the square of the table: a hundredth of it meets all of it.

Scores are integers: a component x counts as floor(scale * x). They are exact; vectors
whose scores could leave 63 bits stop the job with an error.

Defined results: rows with a null id, a null label, a null or empty vector, a null or
non-finite component, or another length than most take no part; of rows that share an
id only the one with the smallest label, then vector, takes part; ties go to the
smaller id; an anchor whose label no other row has gives no rows, nor does a positive
with a negative score, whose window is empty; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlake.llm.tables import stored

# Segments of a vector at each level, coarse to fine; stored at the finest.
LEVELS = (4, 16)
SCALE = 256.0
# Rows packed into one binary value, and rows multiplied at a time.
PACK = 4096
ANCHOR_TILE = 512
# Two-byte components in one group, and numbers of one block of anchors.
GROUP_BYTES = 32_000_000
ANCHOR_NUMBERS = 1_000_000
# Groups wanted for a block, where the table is large enough for them.
SPREAD = 64

_PACKED = "n int, width int, ids binary, labels binary, vectors binary, means binary, deviations binary"
_POSITIVES = "anchor_id long, positive_id long, positive_score long"
_FOUND = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _edges(length: int) -> np.ndarray:
    return np.arange(LEVELS[-1] + 1) * length // LEVELS[-1]


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean times the root of the length, and deviation, of every finest segment."""
    edges = _edges(vectors.shape[1])
    lengths = np.maximum(np.diff(edges), 1)
    sums = np.zeros((2, len(vectors), vectors.shape[1] + 1))
    np.cumsum(vectors, axis=1, out=sums[0, :, 1:])
    np.cumsum(np.square(vectors, dtype=np.float64), axis=1, out=sums[1, :, 1:])
    first, second = sums[:, :, edges[1:]] - sums[:, :, edges[:-1]]
    means = first / np.sqrt(lengths)
    return means, np.sqrt(np.maximum(second - means * means, 0))


@dataclass
class Block:
    """Vectors with their summaries at every level."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    norms: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, means: np.ndarray, deviations: np.ndarray) -> Block:
        edges = _edges(vectors.shape[1])
        roots = np.sqrt(np.diff(edges))
        energy = means * means + deviations * deviations
        levels = []
        for segments in LEVELS[:-1]:
            starts = np.arange(segments) * (LEVELS[-1] // segments)
            whole = np.add.reduceat(means * roots, starts, axis=1) / np.sqrt(np.maximum(np.add.reduceat(np.diff(edges), starts), 1))
            levels.append((whole, np.sqrt(np.maximum(np.add.reduceat(energy, starts, axis=1) - whole * whole, 0))))
        return cls(ids, labels, vectors, [*levels, (means, deviations)], np.sqrt(energy.sum(axis=1)))

    def part(self, rows: np.ndarray) -> Block:
        levels = [(m[rows], d[rows]) for m, d in self.levels]
        return Block(self.ids[rows], self.labels[rows], self.vectors[rows], levels, self.norms[rows])

    def tiles(self, size: int) -> list[Block]:
        return [self.part(np.arange(at, min(at + size, len(self.ids)))) for at in range(0, len(self.ids), size)]


def left_over(anchors: Block, rows: Block, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that some anchor may score within its low and high, their exact scores,
    and which of these lie within."""
    columns, alive = np.arange(len(rows.ids)), None
    for (mean, deviation), (other_mean, other_deviation) in zip(anchors.levels, rows.levels):
        middle = mean @ other_mean[columns].T
        # Summaries are stored in single precision.
        spread = deviation @ other_deviation[columns].T + 1e-5 * np.outer(anchors.norms, rows.norms[columns]) + 1e-3
        within = (middle + spread >= low[:, None]) & (middle - spread <= high[:, None])
        if alive is not None:
            within &= alive
        keep = within.any(axis=0)
        columns, alive = columns[keep], within[:, keep]
    scores = anchors.vectors @ rows.vectors[columns].T
    return columns, scores, alive & (scores >= low[:, None]) & (scores <= high[:, None])


class Best:
    """The k best (score, then smaller id) under each key so far."""

    def __init__(self, keys: int, k: int, kind: np.dtype) -> None:
        self.k, self.keys = k, keys
        self.key, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, kind), np.zeros(0, np.int64)
        # The k-th best, which a newcomer has to reach.
        self.least = np.full(keys, -math.inf)

    def offer(self, keys: np.ndarray, scores: np.ndarray, wanted: np.ndarray, ids: np.ndarray) -> None:
        """scores and wanted: one row for each of keys, one column for each id."""
        if wanted.shape[1] > 4 * self.k:
            # All that reach the k-th best of this tile, ties included.
            some = np.where(wanted, scores.astype(np.float64), -math.inf)
            wanted = wanted & (some >= np.partition(some, -self.k, axis=1)[:, -self.k, None])
        row, column = np.nonzero(wanted)
        if not len(row):
            return
        key = np.concatenate([self.key, keys[row]])
        score, ident = np.concatenate([self.score, scores[row, column]]), np.concatenate([self.id, ids[column]])
        order = np.lexsort((ident, -score, key))
        key = key[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        order, key, rank = order[rank < self.k], key[rank < self.k], rank[rank < self.k]
        self.key, self.score, self.id = key, score[order], ident[order]
        last = rank == self.k - 1
        self.least[key[last]] = self.score[last]


def _unpacked(table: pa.Table) -> list[Block]:
    blocks = []
    for row in table.select(["n", "width", "ids", "labels", "vectors", "means", "deviations"]).to_pylist():
        read = lambda name, kind: np.frombuffer(row[name], kind).reshape(row["n"], -1)  # noqa: E731, B023
        means, deviations = (read(name, np.float32).astype(np.float64) for name in ("means", "deviations"))
        vectors = read("vectors", np.int16 if row["width"] == 2 else np.int64)
        blocks.append(Block.of(read("ids", np.int64)[:, 0], read("labels", np.int64)[:, 0], vectors, means, deviations))
    return blocks


def _anchor_block(table: pa.Table) -> Block:
    rows = len(table)
    vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(rows, -1)
    return Block.of(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), vectors, *summaries(vectors))


def _exact(block: Block, kind: type) -> Block:
    block.vectors = block.vectors.astype(kind)
    return block


def _prepared(rows: DataFrame, vector: str) -> DataFrame:
    """vec_id, label and vector (whole numbers as longs) of the rows that take part."""
    numbers = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col(vector).cast("array<double>").alias("vector"))
    whole = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))))
    usable = numbers.filter(F.coalesce(whole, F.lit(False)))
    length = usable.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    usable = usable.filter(F.size("vector") == (length["n"] if length else 0))
    usable = usable.withColumn("vector", F.transform("vector", lambda x: F.floor(F.lit(SCALE) * x)))
    twice = usable.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1")
    if twice.isEmpty():
        return usable
    least = F.min(F.struct("label", "vector")).alias("r")
    return stored(usable.groupBy("vec_id").agg(least).select("vec_id", "r.label", "r.vector"), "different-ids")


def _packs(rows: DataFrame) -> DataFrame:
    def pack(batches):
        for whole in batches:
            for batch in (whole.slice(at, PACK) for at in range(0, whole.num_rows, PACK)):
                vectors = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
                means, deviations = summaries(vectors)
                # Two bytes to a component where all fit, eight elsewhere.
                small = vectors.astype(np.int16)
                packed = small if (small == vectors).all() else vectors
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.num_rows], pa.int32()), pa.array([packed.itemsize], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in (
                        batch.column(0).to_numpy(), batch.column(1).to_numpy(), packed, means.astype(np.float32), deviations.astype(np.float32)))],
                    ["n", "width", "ids", "labels", "vectors", "means", "deviations"])

    return rows.mapInArrow(pack, _PACKED)


def _meetings(anchors: DataFrame, packs: DataFrame, blocks: int, groups: int):
    """Every block of anchors with every group of packs."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("i", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("j", every(groups))
    right = packs.withColumn("i", every(blocks)).withColumn("j", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j"))


def _top(found: DataFrame, keys: list[str], score: str, ident: str, k: int, rank: str = "rank") -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(ident))
    return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def mine(
    embeddings: DataFrame, is_anchor: Column, label: Column, k: int = 5, negatives: int = 5, percent: int = 80, vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    An anchor's positives are its k best other rows of one label; a positive's
    negatives the best rows of other labels that score at least `percent` per cent of
    what it scores, and no more than it. `is_anchor` looks at vec_id; `label` is taken
    in place of the column label.
    """
    spark = embeddings.sparkSession
    rows = _prepared(embeddings.withColumn("label", label), vector)
    facts = rows.agg(
        F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("vector")).alias("length"),
        F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))).alias("largest")).first()
    if not facts["n"] or not facts["anchors"]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    largest = facts["length"] * facts["largest"] ** 2
    if largest >= 2.0**63:
        raise ValueError("scores of these vectors do not fit 63 bits")
    # Whole numbers below 2**53 are exact in doubles, whose products are faster.
    kind = np.float64 if largest < 2.0**53 else np.int64
    blocks = -(-facts["anchors"] * facts["length"] // ANCHOR_NUMBERS)
    groups = max(-(-facts["n"] * facts["length"] * 2 // GROUP_BYTES), min(-(-facts["n"] // PACK), SPREAD))
    packs = stored(_packs(rows), "packed-vectors")
    anchors = stored(rows.filter(is_anchor), "anchors")

    def positives_of(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 3]
        if len(left) and len(right):
            own = _exact(_anchor_block(left), kind)
            for tile in own.tiles(ANCHOR_TILE):
                best = Best(len(tile.ids), k, kind)
                for other in _unpacked(right):
                    for one in np.intersect1d(tile.labels, other.labels):
                        here = np.flatnonzero(tile.labels == one)
                        some, rest = tile.part(here), _exact(other.part(np.flatnonzero(other.labels == one)), kind)
                        columns, scores, wanted = left_over(some, rest, best.least[here], np.full(len(here), math.inf))
                        ids = rest.ids[columns]
                        best.offer(here, scores, wanted & (some.ids[:, None] != ids[None, :]), ids)
                found.append((tile.ids[best.key], best.id, best.score.astype(np.int64)))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score"), columns)))

    positives = _meetings(anchors, packs, blocks, groups).applyInArrow(positives_of, _POSITIVES)
    positives = stored(_top(positives, ["anchor_id"], "positive_score", "positive_id", k), "positives")
    # At most k entries for an anchor.
    lists = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives"))
    asking = anchors.join(lists.withColumnRenamed("anchor_id", "vec_id"), "vec_id")

    def negatives_of(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 5]
        if len(left) and len(right):
            own = _exact(_anchor_block(left), kind)
            # Windows of scores; one that is not there is empty.
            high, ident = np.full((len(left), k), -1, np.int64), np.zeros((len(left), k), np.int64)
            for row, entries in enumerate(left.column("positives").to_pylist()):
                for at, entry in enumerate(entries):
                    high[row, at], ident[row, at] = entry["positive_score"], entry["positive_id"]
            # The smallest whole number not below percent / 100 of it, without a product.
            low = high // 100 * percent + -(-(high % 100 * percent) // 100)
            own_rows = np.arange(len(left))
            for at in range(0, len(left), ANCHOR_TILE):
                here = own_rows[at:at + ANCHOR_TILE]
                tile, best = own.part(here), Best(len(here) * k, negatives, kind)
                floor, roof = low[here], high[here]
                for packed in _unpacked(right):
                    other = _exact(packed, kind)
                    least = np.maximum(floor, best.least.reshape(-1, k))
                    least = np.where(floor <= roof, least, math.inf)
                    columns, scores, wanted = left_over(tile, other, least.min(axis=1), roof.max(axis=1).astype(np.float64))
                    ids = other.ids[columns]
                    wanted &= other.labels[columns][None, :] != tile.labels[:, None]
                    for p in range(k):
                        inside = wanted & (scores <= roof[:, p, None]) & (scores >= least[:, p, None])
                        best.offer(np.arange(len(here)) * k + p, scores, inside, ids)
                row, p = here[best.key // k], best.key % k
                found.append((own.ids[row], ident[row, p], high[row, p], best.id, best.score.astype(np.int64)))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"), columns)))

    mined = _meetings(asking, packs, blocks, groups).applyInArrow(negatives_of, _FOUND)
    top = _top(mined, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return top.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
