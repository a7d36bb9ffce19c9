"""Near-duplicates among embeddings: spherical k-means cells, blocked cosine
products inside them, one representative for each group.

Identical vectors are folded into one class with a size first. The cells' centres
are fitted on a sample of at most FIT_FLOATS numbers; every class has its home
in the cell of its nearest centre, and visits as a guest each other cell that
may hold a vector it links with: those whose border is not too far, and whose
members' angles to their centre allow it by the triangle inequality. Of two
cells only one sends guests to the other, so every pair is compared once. Members
and guests of a cell are compared in blocks of BLOCK, each pair of blocks a group
of its own, so no task holds more than two blocks.
A group returns, for each member, how many vectors it links with and the
smallest member of its part of the group; pairs themselves are never written.

Two vectors are linked if their cosine in double precision is at least
THRESHOLD. All links are found. What that costs depends on the data: where
vectors lie in tight groups they visit few cells, where they are spread evenly
over many dimensions they visit nearly all, and the work grows with the square of
the table. The number of cells is the one that needs the fewest visits.

Defined results: a vector that is null, empty, zero, has a null or non-finite
component, or another length than most vectors links with nothing and stands for
itself; a null id likewise; repeated rows are vectors of their own; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.components import connected_components
from flowlake.llm.tables import stored

THRESHOLD = 0.9
REACH = math.acos(THRESHOLD)
# Far more than the rounding of a cosine, or of an angle near 0.
SLACK = 1e-6
# Classes to a cell on average, at the least; cells are fewer where that saves visits.
CELL_CLASSES = 400
MOST_CELLS = 4096
FIT_FLOATS = 2_000_000
FIT_ROUNDS = 8
# Visits are counted on so many vectors of the sample.
TRIED = 1000
BLOCK = 4096
# Rows of a block that are multiplied at a time.
TILE = 1024


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return _unit(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1))


def fit_cells(sample: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means; the first centres are spread over the sample's order,
    empty cells keep theirs."""
    centres = sample[np.linspace(0, len(sample) - 1, cells).astype(int)]
    for _ in range(FIT_ROUNDS):
        own = np.concatenate([np.argmax(part @ centres.T, axis=1) for part in np.array_split(sample, -(-len(sample) // 4096))])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-300)[:, None], centres)
    return centres


def _usable(vectors: DataFrame) -> DataFrame:
    """Adds usable: whether a row can be compared at all."""
    whole = (
        F.col("vec_id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
        & F.exists("vector", lambda x: x != 0))
    rated = vectors.withColumn("usable", F.coalesce(whole, F.lit(False)))
    length = rated.filter("usable").groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    return rated.withColumn("usable", F.col("usable") & (F.size("vector") == (length["n"] if length else 0)))


def _homes(unit: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and the angle to it."""
    parts = [part @ centres.T for part in np.array_split(unit, -(-len(unit) // TILE))]
    home = np.concatenate([np.argmax(part, axis=1) for part in parts])
    return home, np.arccos(np.clip(np.concatenate([part.max(axis=1) for part in parts]), -1, 1))


def _visits(unit: np.ndarray, home: np.ndarray, centres: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Which cells each row visits. near and far: the angles between a cell's
    centre and its members; NaN where it has none."""
    own, other = home[:, None], np.arange(len(centres))[None, :]
    cosines = unit @ centres.T
    # The sine of the angle between the row and the border of the two cells.
    apart = np.sqrt(np.maximum(2 - 2 * (centres[home] @ centres.T), 0))
    border = np.take_along_axis(cosines, own, axis=1) - cosines <= (math.sin(REACH) + SLACK) * apart + SLACK
    angle = np.arccos(np.clip(cosines, -1, 1))
    reached = (angle >= near - REACH - SLACK) & (angle <= far + REACH + SLACK)
    return border & reached & (own != other) & (((own + other) % 2 == 1) == (own < other))


def choose_cells(sample: np.ndarray, n: int) -> np.ndarray:
    """The centres with the fewest rows to compare for n vectors like these."""
    best, least, cells = None, math.inf, min(len(sample), MOST_CELLS, -(-n // CELL_CLASSES))
    while cells:
        centres = fit_cells(sample, cells)
        home, angle = _homes(sample, centres)
        near, far = np.full(cells, np.nan), np.full(cells, np.nan)
        np.fmin.at(near, home, angle)
        np.fmax.at(far, home, angle)
        some = np.linspace(0, len(sample) - 1, min(len(sample), TRIED)).astype(int)
        parts = np.array_split(some, -(-len(some) // 256))
        visits = sum(_visits(sample[p], home[p], centres, near, far).sum() for p in parts) / len(some)
        # A vector's copies: as a guest for each block of members, as a member for each block of guests.
        rows = visits * -(-n // (cells * BLOCK)) + visits * n / (cells * BLOCK) + 1 + n / (cells * BLOCK)
        if rows < least:
            best, least = centres, rows
        cells //= 2
    return best


def _links(classes: DataFrame, centres: np.ndarray) -> DataFrame:
    """rep, links (vectors of other classes) and least (a smaller or equal rep
    of the same component), in parts to be summed."""
    def settle(batches):
        for batch in batches:
            if batch.num_rows:
                home, angle = _homes(_matrix(batch.column(2)), centres)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int64)), pa.array(angle)], ["rep", "size", "vector", "home", "angle"])

    placed = classes.select("rep", "size", "vector").mapInArrow(settle, "rep long, size long, vector array<double>, home long, angle double")
    placed = stored(placed, "vector-cells")
    near, far = np.full(len(centres), np.nan), np.full(len(centres), np.nan)
    # One row for each cell, MOST_CELLS at most.
    for r in placed.groupBy("home").agg(F.min("angle").alias("near"), F.max("angle").alias("far")).collect():
        near[r["home"]], far[r["home"]] = r["near"], r["far"]

    def visit(batches):
        for whole in batches:
            for batch in (whole.slice(at, 256) for at in range(0, whole.num_rows, 256)):
                home = batch.column(3).to_numpy()
                row, cell = np.nonzero(_visits(_matrix(batch.column(2)), home, centres, near, far))
                starts = np.searchsorted(row, np.arange(len(home) + 1)).astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(starts), pa.array(cell.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], cells], ["rep", "size", "vector", "home", "cells"])

    visits = stored(placed.mapInArrow(visit, "rep long, size long, vector array<double>, home long, cells array<long>"), "vector-visits")
    members = visits.withColumn("cell", F.explode(F.concat(F.array("home"), "cells"))).withColumn("guest", F.col("cell") != F.col("home"))
    # One row for each cell.
    blocks = lambda guest: F.ceil(F.count_if(F.col("guest") == guest) / BLOCK)
    counts = members.groupBy("cell").agg(blocks(False).alias("own"), blocks(True).alias("guests"))
    split = members.join(F.broadcast(counts), "cell")
    part = lambda n: F.pmod(F.xxhash64("rep"), n)
    split = split.withColumn("block", F.when(F.col("guest"), F.col("own") + part(F.col("guests"))).otherwise(part(F.col("own"))))
    last = F.col("own") - 1 + F.when(F.col("guest"), F.lit(0).cast("long")).otherwise(F.col("guests"))
    pairs = split.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pairs = pairs.select("cell", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
                         "rep", "size", "vector", "block")
    found = pairs.groupBy("cell", "first", "second").applyInArrow(_compare, "rep long, links long, least long")
    return stored(found, "vector-links")


def _compare(table: pa.Table) -> pa.Table:
    """One group: all members of one block, or two blocks against each other."""
    rep = table.column("rep").to_numpy()
    size, block = table.column("size").to_numpy(), table.column("block").to_numpy()
    order = np.lexsort((rep, block))
    rep, size, block = rep[order], size[order], block[order]
    unit = _matrix(table.column("vector").combine_chunks())[order]
    first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
    here, there = np.flatnonzero(block == first), np.flatnonzero(block == second)
    links, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
    for tile in (here[at:at + TILE] for at in range(0, len(here) if len(there) else 0, TILE)):
        a, b = np.nonzero(unit[tile] @ unit[there].T >= THRESHOLD)
        a, b = tile[a], there[b]
        if first == second:
            a, b = a[a < b], b[a < b]
        np.add.at(links, a, size[b])
        np.add.at(links, b, size[a])
        while len(a):
            low = np.minimum(label[a], label[b])
            new = label.copy()
            # What earlier tiles put under one label moves with it.
            np.minimum.at(new, label[a], low)
            np.minimum.at(new, label[b], low)
            new = new[new]
            if (new == label).all():
                break
            label = new
    linked = links > 0
    # Members are in the order of block, then rep: the label's smallest rep.
    least = np.full(len(rep), np.iinfo(np.int64).max)
    np.minimum.at(least, label, rep)
    return pa.table({"rep": rep[linked], "links": links[linked], "least": least[label][linked]})


def find_near_duplicates(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = _usable(embeddings.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias("vector")))
    # Adding 0 makes one zero of two.
    fine = rows.filter("usable").select("vec_id", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector"))
    fine = fine.withColumn("key", F.xxhash64("vector"))
    classes = stored(fine.groupBy("key", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")), "vector-classes")
    n = classes.count()
    alone = rows if not n else rows.filter("NOT usable")
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if n:
        most = max(1, FIT_FLOATS // classes.select(F.size("vector")).first()[0])
        place = F.pmod(F.xxhash64("rep"), F.lit(1 << 40)) / F.lit(float(1 << 40))
        sample = classes.filter(place < most / n).select("rep", "vector").toArrow().sort_by("rep")
        points = _matrix(sample.column("vector").combine_chunks())
        links = _links(classes, choose_cells(points, n))
        groups = connected_components(links.select(F.col("rep").alias("a"), F.col("least").alias("b")))
        known = classes.select("rep", "size").join(links.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
        known = known.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
            "rep", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
        known = stored(known.filter("n_links > 0"), "linked-vectors")
        copied = stored(classes.filter("size > 1").select("key", "vector", F.col("rep").alias("other")), "copied-vectors")
        members = fine.join(copied, ["key", "vector"], "left").select("vec_id", F.coalesce("other", "vec_id").alias("rep"))
        alone = alone.unionAll(members.join(known, "rep", "left").select(
            "vec_id", F.coalesce("n_links", F.lit(0).cast("long")), F.coalesce("component", "vec_id")))
    return alone.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
