"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells.

Equal vectors are folded into one first. Cells come from spherical k-means in two levels: coarse centres from a bounded
sample on the driver, then the centres within each coarse cell, fitted side by side on the executors from a bounded
sample of the cell. The number of cells grows with the root of the number of vectors. Every vector belongs to its
nearest cell and also visits the cells whose centre is nearly as near, so that links across a border are found. Within a cell the members meet the cell's own vectors in blocks of bounded size; a crowded cell is only more
blocks. A block gives out, for each vector, the number of its links and one neighbour to be connected to, never all
pairs. A link that two cells can see counts in the one of lower number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuloom.llm.shared import attach_by_group, components, stored


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.95
    margin: float = 0.1  # a vector visits the cells whose cosine is at most this below its best
    coarse_margin: float = 0.3  # only cells within the coarse cells that are at most this below its best are looked at
    most_centre_bytes: int = 256 << 20  # bounds the broadcast of the centres, and with it their number
    coarse_sample: int = 64  # vectors of the sample a coarse cell
    sample_per_cell: int = 16
    most_sampled: int = 16_384  # of one coarse cell
    most_within: int = 1024  # cells of one coarse cell
    rare: int = 4096  # vectors of a dimension with at most so many vectors are one cell
    rounds: int = 8
    block_values: int = 1 << 22  # numbers in one block of a cell's own vectors; four times as many in one of its members
    block: int | None = None  # rows of a block, for tests
    seed: int = 3


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_kmeans(sample: np.ndarray, k: int, s: Settings) -> np.ndarray:
    """k unit centres of unit vectors, by Lloyd's rounds from a drawn start; empty cells keep their centre."""
    rng = np.random.default_rng(s.seed)
    centres = sample[np.sort(rng.choice(len(sample), k, replace=False))].copy()
    for _ in range(s.rounds):
        cell = np.concatenate([(part @ centres.T).argmax(axis=1) for part in np.array_split(sample, max(1, len(sample) * k // 4_000_000))])
        order = np.argsort(cell, kind="stable")
        starts = np.flatnonzero(np.r_[True, cell[order][1:] != cell[order][:-1]])
        sums = np.add.reduceat(sample[order], starts, axis=0)
        norms = np.linalg.norm(sums, axis=1)
        ok = norms > 0
        centres[cell[order][starts][ok]] = sums[ok] / norms[ok, None]
    return centres


def usable(vector: str) -> object:
    """Not null, not empty, not zero, all components there and finite."""
    c = F.col(vector)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return c.isNotNull() & (F.size(c) > 0) & F.coalesce(~bad, F.lit(False)) & F.exists(c, lambda x: x != 0)


def sampled(vectors: DataFrame, n: int, wanted: int) -> DataFrame:
    """About `wanted` of n vectors, the same whenever the vectors are: those whose hash is in a part of its range."""
    return vectors.where(F.pmod(F.xxhash64("rep", F.lit(5)), F.lit(1 << 30)) < int(min(1.0, wanted / max(n, 1)) * (1 << 30)))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


@dataclass
class Cells:
    """The centres of one dimension: `within` holds those of the coarse cell k at first[k] up to first[k + 1]."""

    d: int
    coarse: np.ndarray
    within: np.ndarray
    first: np.ndarray
    offset: int = 0

    def near(self, v: np.ndarray, s: Settings) -> np.ndarray:
        """Cosines of unit vectors with all centres; -2 where the coarse cell is too far to be looked into."""
        rough = v @ self.coarse.T
        open_ = rough >= rough.max(axis=1, keepdims=True) - s.coarse_margin
        out = np.full((len(v), len(self.within)), -2, np.float32)
        for k in np.flatnonzero(open_.any(axis=0)):
            rows = np.flatnonzero(open_[:, k])
            low, high = self.first[k], self.first[k + 1]
            out[rows, low:high] = v[rows] @ self.within[low:high].T
        return out


def fit(vectors: DataFrame, n: int, d: int, s: Settings) -> Cells:
    """Cells of n vectors of dimension d: about twice the root of n, as far as their centres fit most_centre_bytes."""
    k = int(max(1, min(round(2 * n**0.5), s.most_centre_bytes // (4 * max(d, 64)))))
    k1 = max(1, round(k**0.5))
    rows = sampled(vectors, n, s.coarse_sample * k1).select("v").toArrow().column(0).combine_chunks()
    if not len(rows):
        rows = vectors.limit(1).select("v").toArrow().column(0).combine_chunks()
    sample = unit(matrix(rows, d)).astype(np.float32)
    coarse = spherical_kmeans(sample, min(k1, len(sample)), s)
    if k <= len(coarse):
        return Cells(d, coarse, coarse, np.arange(len(coarse) + 1))
    shared = vectors.sparkSession.sparkContext.broadcast(coarse)

    def cells_of(batches):
        for batch in batches:
            if batch.num_rows:
                at = (unit(matrix(batch.column(1), d)).astype(np.float32) @ shared.value.T).argmax(axis=1)
                yield pa.record_batch([pa.array(at.astype(np.int64)), *batch.columns], ["cell", "rep", "v"])

    wanted = s.sample_per_cell * k
    kind = vectors.schema["v"].dataType.simpleString()
    rough = stored(sampled(vectors, n, wanted).select("rep", "v").mapInArrow(cells_of, f"cell long, rep long, v {kind}"))
    sizes = {r["cell"]: r["count"] for r in rough.groupBy("cell").count().collect()}  # a row a coarse cell
    total = max(1, sum(sizes.values()))
    share = {c: min(s.most_within, max(1, round(k * m / total))) for c, m in sizes.items()}
    kept = F.lit(1.0)
    crowded = {c: s.most_sampled / m for c, m in sizes.items() if m > s.most_sampled}  # fewer than wanted / most_sampled
    for c, part in crowded.items():
        kept = F.when(F.col("cell") == c, F.lit(part)).otherwise(kept)
    rough = rough.where(F.pmod(F.xxhash64("rep", F.lit(6)), F.lit(1 << 30)) < kept * (1 << 30))

    def centres_of(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        found = spherical_kmeans((own := unit(matrix(table.column("v").combine_chunks(), d)).astype(np.float32)), min(share[cell], len(own)), s)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, d, dtype=np.int32)), pa.array(found.ravel()))
        return pa.table({"cell": pa.array([cell] * len(found), pa.int64()), "centre": lists})

    # The centres alone come to the driver, at most most_centre_bytes of them.
    found = rough.groupBy("cell").applyInArrow(centres_of, "cell long, centre array<float>").toArrow().sort_by("cell")
    cell = found.column("cell").to_numpy()
    within = found.column("centre").combine_chunks().flatten().to_numpy().reshape(-1, d)
    missing = np.setdiff1d(np.arange(len(coarse)), cell)  # a coarse cell without any sampled vector is one cell
    cell, within = np.concatenate([cell, missing]), np.concatenate([within, coarse[missing]])
    order = np.argsort(cell, kind="stable")
    return Cells(d, coarse, np.ascontiguousarray(within[order]), np.searchsorted(cell[order], np.arange(len(coarse) + 1)))


def assigned(vectors: DataFrame, cells: Cells, s: Settings) -> DataFrame:
    """(cell, home, rep, n, v, cells): a row for every cell that a vector belongs to or visits; home is the one it belongs to."""
    shared = vectors.sparkSession.sparkContext.broadcast(cells)
    step = max(1, 8_000_000 // max(1, len(cells.within)))

    def placed(batches):
        own = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                near = own.near(unit(matrix(part.column(2), own.d)).astype(np.float32), s)
                home = near.argmax(axis=1) + own.offset
                row, cell = np.nonzero(near >= near.max(axis=1, keepdims=True) - s.margin)
                cell = cell + own.offset
                visited = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)), pa.array(cell.astype(np.int64)))
                out = part.append_column("cells", visited).take(pa.array(row))
                yield pa.record_batch([pa.array(cell.astype(np.int64)), pa.array(home[row].astype(np.int64)), *out.columns], ["cell", "home", "rep", "n", "v", "cells"])

    return vectors.select("rep", "n", "v").mapInArrow(placed, f"cell long, home long, rep long, n long, v {vectors.schema['v'].dataType.simpleString()}, cells array<long>")


def all_assigned(vectors: DataFrame, s: Settings) -> DataFrame:
    """The same for vectors of every dimension. Those of a rare dimension are one cell; every other has cells of its own."""
    sizes = vectors.groupBy(F.size("v").alias("d")).count().collect()  # a row a dimension
    often = sorted(((r["d"], r["count"]) for r in sizes if r["count"] > s.rare))
    other = (-F.size("v")).cast("long")
    rest = vectors.where(~F.size("v").isin([d for d, _ in often])) if often else vectors
    out = rest.select(other.alias("cell"), other.alias("home"), "rep", "n", "v", F.array(other).alias("cells"))
    offset = 0
    for d, n in often:
        own = vectors.where(F.size("v") == d)
        cells = fit(own, n, d, s)
        cells.offset = offset
        offset += len(cells.within)
        out = out.unionByName(assigned(own, cells, s))
    return out


def compared(table: pa.Table, s: Settings) -> pa.Table:
    """What one block tells of the vectors with a link in it: (rep, links, neighbour)."""
    table = table.combine_chunks()
    own = table.column("own").to_numpy()
    cell, home, rep, n = (table.column(c).to_numpy() for c in ("cell", "home", "rep", "n"))
    lists = table.column("v").chunk(0)
    v = unit(matrix(lists, len(lists[0])))
    left, right = np.flatnonzero(~own), np.flatnonzero(own)
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for part in (left[k : k + 1024] for k in range(0, len(left), 1024)):
        i, j = np.nonzero(v[part] @ v[right].T >= s.threshold)
        ok = rep[part[i]] != rep[right[j]]
        a.append(part[i[ok]])
        b.append(right[j[ok]])
    a, b = np.concatenate(a), np.concatenate(b)
    # A visitor's link is seen in its home too if the other one visits that; then the cell of lower number counts it.
    visits = table.column("cells").chunk(0)
    width = np.int64(1) << 32
    keys = np.repeat(np.arange(len(rep)), visits.value_lengths().to_numpy()) * width + visits.flatten().to_numpy() % width
    away = home[a] != cell[a]
    twice = away & (home[a] < cell[a]) & np.isin(b * width + home[a] % width, keys)
    a, b, away = a[~twice], b[~twice], away[~twice]
    # Two vectors at home here meet once each way; a visitor and a vector of the cell meet once, for both.
    reps = np.unique(np.concatenate([rep[a], rep[b]]))
    i, j = np.searchsorted(reps, rep[a]), np.searchsorted(reps, rep[b])
    links = np.bincount(i, n[b], len(reps)) + np.bincount(j[away], n[a[away]], len(reps))
    return pa.table({"rep": reps, "links": links.astype(np.int64), "neighbour": smallest_reached(reps, i, j)})


def smallest_reached(reps: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of reps (sorted) the smallest that the links between places i and j reach."""
    label = np.arange(len(reps))
    while True:
        before = label.copy()
        np.minimum.at(label, i, before[j])
        np.minimum.at(label, j, before[i])
        label = label[label]
        if (label == before).all():
            return reps[label]


def near_dedup(rows: DataFrame, vector: str = "embedding", id: str = "vec_id", settings: Settings = Settings()) -> DataFrame:
    """One row a row of rows: id, n_links, component_id, kept (the id is its component's smallest).

    Cosines are taken in double precision. Null, empty and zero vectors, and those with null or non-finite components,
    link with nothing, nor do rows without an id; vectors of different dimension don't link. Equal vectors always
    link. Rows that share an id are one node of the components. An empty table gives an empty table; other columns
    aren't read. Links are found within cells: recall is measured, not certain (see README).
    """
    s = settings
    all_rows = rows.select(F.col(id).cast("long").alias("id"), F.when(usable(vector) & F.col(id).isNotNull(), F.col(vector)).alias("v"))
    all_rows = stored(all_rows)
    vectors = stored(all_rows.where("v is not null").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    if vectors.limit(1).count():
        links = linked(vectors, s)
        degree = links.groupBy("rep").agg(F.sum("links").alias("others"))
        member = components(links.select("rep", "neighbour").where("rep <> neighbour"))
        groups = vectors.join(degree, "rep", "left").join(member.withColumnRenamed("node", "rep"), "rep", "left")
    else:
        groups = vectors.withColumn("others", F.lit(0).cast("long")).withColumn("component", F.col("rep"))
    groups = stored(groups.select("v", "n", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = attach_by_group(all_rows, groups, "v", "n", all_rows.count())
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def linked(vectors: DataFrame, s: Settings) -> DataFrame:
    """(rep, links, neighbour): links add up over the rows of a rep; the neighbours connect what is linked."""
    placed = stored(all_assigned(vectors, s))
    rows = F.least(F.lit(16_384), F.greatest(F.lit(256), F.floor(F.lit(s.block_values) / F.size("v")))) if s.block is None else F.lit(s.block)
    # A row a cell: about twice the root of the number of vectors, so small enough to broadcast whatever the corpus.
    sizes = F.broadcast(placed.groupBy("cell").agg(F.ceil(F.sum((F.col("cell") == F.col("home")).cast("long")) / F.first(rows)).cast("int").alias("own_blocks"), F.ceil(F.count("*") / (4 * F.first(rows))).cast("int").alias("blocks")))
    sized = placed.join(sizes, "cell").where("own_blocks > 0")
    columns = ["cell", "home", "rep", "n", "v", "cells"]
    own = sized.where("cell = home").select(F.lit(True).alias("own"), *columns, F.pmod(F.xxhash64("rep", F.lit(1)), F.col("own_blocks")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    members = sized.select(F.lit(False).alias("own"), *columns, F.explode(F.sequence(F.lit(0), F.col("own_blocks") - 1)).alias("i"), F.pmod(F.xxhash64("rep", F.lit(2)), F.col("blocks")).cast("int").alias("j"))

    def block(table: pa.Table) -> pa.Table:
        return compared(table, s)

    return stored(own.unionByName(members).groupBy("cell", "i", "j").applyInArrow(block, "rep long, links long, neighbour long"))
