"""Embedding near-duplicates by cover trees and dual traversal, exact.

On unit vectors, cosine >= c is distance <= sqrt(2 - 2c). Equal vectors are one. A few centres, the top of the tree, are taken
from a bounded sample and part all vectors into cells; every cell has its true covering radius, so the sample decides speed and
never results. A cell is cut into chunks of bounded size, and each chunk gets a tree of nested levels with halving radii, which is written once to the shared folder as a file
of its own. Groups of chunks meet in pairs: a task reads the chunks of two groups and lets those meet whose cells are in reach. Of
two chunks only the vectors count that their distance to the other cell's centre less its radius leaves in reach; there, pairs of tree
nodes are dropped if their centres are further apart than both covering radii and the threshold, taken whole if they are so close
that all their pairs must link, and opened otherwise. No vector is sent to a pair of chunks, so that shuffles and disk grow with the
vectors, and a task holds two groups of chunks and node pairs of bounded number, whatever the number of vectors.

A pair of groups gives link counts and, for the components, a spanning set of links, so that a cloud of near copies costs as many rows
as it has vectors. Where distances say nothing (unrelated vectors in many dimensions are all equally far apart) no exact method on
distances can prune, and arithmetic grows with the square of the cells that stay in reach, in blocks of bounded memory.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.llm.common import new_path, stored
from supportlens.llm.links import components

COSINE = 0.9
#: Vectors on which the top of the tree is fitted, at most, and centres taken from them.
SAMPLE, CENTRES = 4096, 1024
#: Vectors of a chunk, about, and chunks of a group, at most.
CHUNK, GROUP = 4096, 8
#: Tasks over the pairs of groups, at most.
TASKS = 20_000
#: Of the nested levels. Unrelated vectors are about 1.4 apart, so that nodes of radius 1 and more would never be dropped.
RADII = (0.5, 0.25, 0.125, 0.0625)
#: Room for rounding: nothing is dropped or taken whole on a difference so small.
ROOM = 1e-5
BLOCK = 1024
MOST_PAIRS = 1 << 20


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _reach(r: float | np.ndarray) -> float | np.ndarray:
    """The cosine at a distance."""
    return 1 - np.minimum(r, 2.0) ** 2 / 2


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def net(x: np.ndarray, r: float, rows: int = 256) -> np.ndarray:
    """The centre of each row: rows are centres unless a centre before them is within r."""
    near, centre = _reach(r), np.full(len(x), -1)
    centres = np.zeros(0, np.int64)
    for low in range(0, len(x), rows):
        block = np.arange(low, min(low + rows, len(x)))
        if len(centres):
            cosine = x[block] @ x[centres].T
            best = cosine.argmax(axis=1)
            held = cosine[np.arange(len(block)), best] >= near
            centre[block[held]] = centres[best[held]]
            block = block[~held]
        among, new = x[block] @ x[block].T >= near, []
        for i in range(len(block)):
            if centre[block[i]] < 0:
                new.append(block[i])
                centre[block[i]] = block[i]
                later = np.flatnonzero(among[i] & (centre[block] < 0))
                centre[block[later]] = block[i]
        centres = np.concatenate([centres, np.array(new, np.int64)])
    return centre


class Tree:
    """Nested levels over rows of unit vectors. paths: for each level, the row that is the centre of each row's node; the last level
    is the rows themselves."""

    def __init__(self, x: np.ndarray, weight: np.ndarray, paths: np.ndarray | None = None):
        self.x, self.x32, self.weight = x, x.astype(np.float32), weight
        self.paths = self.built() if paths is None else paths
        self.radius, self.sums, self.nodes, self.children = [], [], [], []
        rows = np.arange(len(x))
        for level, path in enumerate([*self.paths, rows]):
            r = np.zeros(len(x))
            far = _distance((x * x[path]).sum(axis=1))
            far[path == rows] = 0
            np.maximum.at(r, path, far)
            self.radius.append(r)
            self.sums.append(np.bincount(path, weight, len(x)))
            nodes = np.unique(path)
            self.nodes.append(nodes)
            if level:
                above = self.paths[level - 1][nodes]
                order = np.argsort(above, kind="stable")
                starts = np.searchsorted(above[order], np.arange(len(x) + 1))
                self.children.append((nodes[order], starts))

    def built(self) -> np.ndarray:
        path, paths = np.zeros(len(self.x), np.int64), []
        for r in RADII:
            finer = np.arange(len(self.x))
            order = np.lexsort((np.arange(len(path)) != path, path))  # each node's centre first
            ends = np.flatnonzero(np.diff(path[order], append=-1)) + 1
            for low, high in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True):
                if high - low > 1:
                    rows = order[low:high]
                    finer[rows] = rows[net(self.x[rows], r)]
            path = finer
            paths.append(path)
        return np.array(paths)


def _labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest row of each row's component."""
    label = np.arange(n)
    while len(left):
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


class Links:
    """Link counts and components of the rows of two trees, from node pairs taken whole."""

    def __init__(self, a: Tree, b: Tree, same: bool):
        self.a, self.b, self.same = a, b, same
        self.more = [[np.zeros(len(t.x)) for _ in t.radius] for t in (a, b)]
        self.inner = np.zeros(len(a.x))
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.whole: list[list[np.ndarray]] = [[], []]
        self.held, self.joined = 0, (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def take(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        """All pairs of the nodes' rows link. On one tree, i = j is a node with itself."""
        own = i == j if self.same else np.zeros(len(i), bool)
        np.add.at(self.more[0][level], i, self.b.sums[level][j])
        np.add.at(self.more[1][level], j[~own], self.a.sums[level][i[~own]])
        if own.any():
            paths = self.a.paths[level] if level < len(self.a.paths) else np.arange(len(self.a.x))
            self.inner += np.isin(paths, i[own]) * self.a.weight  # a row's own weight is no link
        self.pairs.append((i, j))
        if level < len(self.a.paths):
            for side, tree, nodes in ((0, self.a, i), (1, self.b, j)):
                rows = np.flatnonzero(np.isin(tree.paths[level], nodes))
                self.whole[side].append(np.stack([rows, tree.paths[level][rows]]))
                self.held += len(rows)
        self.held += len(i)
        if self.held > MOST_PAIRS:  # a spanning set joins as much
            self.joined = self.edges()
            self.pairs, self.whole, self.held = [], [[], []], 0

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for tree, more in ((self.a, self.more[0]), (self.b, self.more[1])):
            total = more[-1].copy()
            for path, extra in zip(tree.paths, more[:-1], strict=True):
                total += extra[path]
            out.append(total)
        if self.same:
            return out[0] + out[1] - self.inner, out[1]
        return out[0], out[1]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Links (by row, those of b behind those of a) that join the same rows as all links do: fewer than rows."""
        shift = 0 if self.same else len(self.a.x)
        n = len(self.a.x) + (0 if self.same else len(self.b.x))
        left = [self.joined[0]] + [i for i, _ in self.pairs] + [w[0] for w in self.whole[0]] + [w[0] + shift for w in self.whole[1]]
        right = [self.joined[1]] + [j + shift for _, j in self.pairs] + [w[1] for w in self.whole[0]] + [w[1] + shift for w in self.whole[1]]
        label = _labels(n, np.concatenate(left), np.concatenate(right))
        rows = np.flatnonzero(label != np.arange(n))
        return rows, label[rows]


def _start(a: Tree, b: Tree, t: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of top nodes in reach, by blocks. For nodes without extent one threshold serves a whole block."""
    (la, wa), (lb, wb) = ((n[tree.radius[0][n] == 0], n[tree.radius[0][n] > 0]) for tree in (a, b) for n in (tree.nodes[0],))
    for left, right in ((la, lb), (la, wb), (wa, lb), (wa, wb)):
        for low in range(0, len(left), BLOCK):
            i = left[low : low + BLOCK]
            for start in range(0, len(right), BLOCK * 4):
                j = right[start : start + BLOCK * 4]
                if same and i[0] > j[-1] and left is la and right is lb:
                    continue  # met from the other side
                reach = _reach(t)
                if right is wb or left is wa:
                    reach = _reach(a.radius[0][i][:, None] + b.radius[0][j][None, :] + t).astype(np.float32)
                at = np.flatnonzero(a.x32[i] @ b.x32[j].T >= reach - np.float32(ROOM))
                x, y = i[at // len(j)], j[at % len(j)]
                yield (x[x <= y], y[x <= y]) if same else (x, y)


def traverse(a: Tree, b: Tree, cosine: float, same: bool) -> Links:
    """All links between the rows of a and b (of one tree if `same`)."""
    t, found = float(np.sqrt(2 - 2 * cosine)), Links(a, b, same)
    last = len(a.paths)
    # Of each level one part at a time: node pairs are opened as they are met.
    stack = [((0, i[k : k + MOST_PAIRS], j[k : k + MOST_PAIRS]) for i, j in _start(a, b, t, same) for k in range(0, len(i), MOST_PAIRS))]
    while stack:
        level, i, j = next(stack[-1], (None, None, None))
        if i is None:
            stack.pop()
            continue
        if not len(i):
            continue
        dots = np.concatenate([np.einsum("ij,ij->i", a.x[i[k : k + 65_536]], b.x[j[k : k + 65_536]]) for k in range(0, len(i), 65_536)])
        d, r = _distance(dots), a.radius[level][i] + b.radius[level][j]
        if same:
            d[i == j] = 0
        single = r == 0
        if same:
            single &= i != j
        whole = (d + r <= t - ROOM) & ~single
        if level == last:
            whole[:] = False
        hits = single & (dots >= cosine)
        if same and level == last:
            hits &= i != j
        if hits.any():
            found.take(level, i[hits], j[hits])  # nodes without extent: one place, however many rows
        if whole.any():
            found.take(level, i[whole], j[whole])
        rest = ~single & ~whole & (d - r <= t + ROOM)
        if level < last and rest.any():
            stack.append(_opened(a, b, level, i[rest], j[rest], same))
    return found


def _opened(a: Tree, b: Tree, level: int, i: np.ndarray, j: np.ndarray, same: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The pairs of the nodes' children, at most MOST_PAIRS at a time; those of one pair of nodes may come in several parts."""
    (ca, sa), (cb, sb) = a.children[level], b.children[level]
    nj = sb[j + 1] - sb[j]
    n = (sa[i + 1] - sa[i]) * nj
    ends = np.cumsum(n)
    for low in range(0, int(ends[-1]), MOST_PAIRS):
        high = min(low + MOST_PAIRS, int(ends[-1]))
        some = np.arange(np.searchsorted(ends, low, "right"), np.searchsorted(ends, high - 1, "right") + 1)
        pair = np.repeat(some, np.diff(np.minimum(ends[some], high), prepend=low))
        at = np.arange(low, high) - (ends - n)[pair]
        x, y = ca[sa[i[pair]] + at // nj[pair]], cb[sb[j[pair]] + at % nj[pair]]
        if same:  # a node with itself: each pair of children once
            once = (i[pair] != j[pair]) | (x <= y)
            x, y = x[once], y[once]
        yield level + 1, x, y


def vector_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, dim, digest and vec (numbers of 32 bits where they hold it exactly, else doubles) of every row; the last three null where
    the vector can't link."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    kind = rows.schema["vec_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, digests, data = [], [], []
            for value in batch.column(1):
                x = np.array(value.values.to_numpy(zero_copy_only=False) if value.is_valid else [], np.float64)
                good = len(x) > 0 and np.isfinite(x).all() and x.any()
                raw = (x + 0.0).tobytes() if good else None
                dims.append(len(x) if good else None)
                digests.append(hashlib.sha256(raw).digest() if good else None)
                data.append(_packed(x) if good else None)
            columns = [pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["vec_id", "dim", "digest", "vec"])

    return rows.mapInArrow(read, f"vec_id {kind}, dim int, digest binary, vec binary")


def _packed(x: np.ndarray) -> bytes:
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return ((short if (short == x).all() else x) + 0.0).tobytes()


def _unit_rows(column: pa.Array | pa.ChunkedArray | pd.Series, dim: int) -> np.ndarray:
    data = list(column) if isinstance(column, pd.Series) else column.to_pylist()
    x = np.zeros((len(data), dim))
    long = np.fromiter((len(v) == 8 * dim for v in data), bool, len(data))
    for rows, kind in ((np.flatnonzero(~long), np.float32), (np.flatnonzero(long), np.float64)):
        if len(rows):
            x[rows] = np.frombuffer(b"".join(data[k] for k in rows.tolist()), kind).reshape(-1, dim)
    return unit(x) if len(x) else x


def _top(classes: DataFrame, dim: int, n: int) -> np.ndarray:
    """Centres: the first of the nested net over a bounded sample, coarse radii first."""
    some = classes.orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE).select("vec").collect()
    x = _unit_rows(pd.Series([r["vec"] for r in some]), dim)
    chosen: list[int] = []
    for r in (2.0, *RADII):
        for c in np.unique(net(x, r)).tolist():
            if c not in chosen:
                chosen.append(c)
    return x[chosen[: min(CENTRES, max(1, -(-n // CHUNK)))]]


class _Chunks:
    """The chunks of `folder` as their files hold them. Those of the two groups at work are kept."""

    def __init__(self, folder: str, dim: int, most: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.dim, self.most, self.kept = dim, most, {}

    def get(self, chunk: int) -> tuple[Tree, np.ndarray] | None:
        """Tree and classes of a chunk; None if no vector fell to it."""
        if chunk not in self.kept:
            if len(self.kept) >= self.most:
                self.kept.pop(next(iter(self.kept)))
            files = self.fs.get_file_info(pafs.FileSelector(f"{self.folder}/chunk={chunk}", allow_not_found=True))
            parts = [pq.ParquetFile(self.fs.open_input_file(f.path)).read() for f in files if f.path.endswith(".parquet")]
            self.kept[chunk] = self._grown(pa.concat_tables(parts).sort_by("place")) if parts else None
        self.kept[chunk] = self.kept.pop(chunk)  # last to go
        return self.kept[chunk]

    def _grown(self, rows: pa.Table) -> tuple[Tree, np.ndarray]:
        x = _unit_rows(rows["vec"], self.dim)
        paths = np.frombuffer(b"".join(rows["path"].to_pylist()), np.int32).reshape(len(x), -1).T.astype(np.int64)
        return Tree(x, rows["weight"].to_numpy().astype(float), paths), rows["cls"].to_numpy()


def _part(tree: Tree, rows: np.ndarray) -> Tree:
    """The tree over some of its rows. A node whose centre stays away is centred on its first row at hand; nodes stay nested and
    radii are measured anew."""
    return Tree(tree.x[rows], tree.weight[rows], _kept_paths(tree.paths[:, rows], rows))


def _class_links(classes: DataFrame, dim: int, n: int, cosine: float) -> DataFrame:
    """For classes (cls, vec, weight) of one dimension: rows (a, -1, links of one of its vectors to other classes) and (a, b, 0) for
    the components."""
    spark, t = classes.sparkSession, float(np.sqrt(2 - 2 * cosine))
    centres = _top(classes, dim, n)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(low, BLOCK)
                dots = _unit_rows(batch.column(1), dim) @ centres.T
                cell = dots.argmax(axis=1)
                far = _distance(dots[np.arange(len(cell)), cell])
                columns = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)]
                yield pa.RecordBatch.from_arrays(columns, ["cls", "vec", "weight", "cell", "far"])

    celled = stored(classes.select("cls", "vec", "weight").mapInArrow(assign, "cls bigint, vec binary, weight bigint, cell int, far double"), "cells")
    radius, chunks = np.full(len(centres), -9.0), np.zeros(len(centres), np.int64)
    for r in celled.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect():  # one row a centre
        radius[r["cell"]], chunks[r["cell"]] = r["far"], -(-r["n"] // CHUNK)
    first = np.concatenate([[0], np.cumsum(chunks)])
    parts = F.element_at(F.array(*map(F.lit, chunks.tolist())), F.col("cell") + 1)
    base = F.element_at(F.array(*map(F.lit, first[:-1].tolist())), F.col("cell") + 1)
    chunked = celled.withColumn("chunk", base + F.pmod(F.xxhash64("cls"), parts)).select("cls", "vec", "weight", "chunk")

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(_unit_rows(frame["vec"], dim), frame["weight"].to_numpy(float))
        out = frame[["cls", "vec", "weight", "chunk"]].copy()
        out["path"] = [row.tobytes() for row in np.ascontiguousarray(tree.paths.T.astype(np.int32))]
        out["place"] = np.arange(len(out), dtype=np.int32)
        return out

    folder = new_path(spark, "trees")
    grown = chunked.groupBy("chunk").applyInPandas(grow, "cls bigint, vec binary, weight bigint, chunk bigint, path binary, place int")
    grown.write.partitionBy("chunk").parquet(folder)

    total = int(first[-1])
    each = min(GROUP, max(1, total // 8))
    groups = -(-total // each)
    apart = _distance(centres @ centres.T)

    def link(left: tuple, right: tuple, cells: tuple[int, int], same: bool) -> tuple[Links, np.ndarray, np.ndarray] | None:
        """Links of two chunks, and the rows of each that they are over."""
        (a, b), whole = (left[0], right[0]), [np.arange(len(x[1])) for x in (left, right)]
        if cells[0] == cells[1]:
            return traverse(a, b, cosine, same), *whole
        rows = [np.flatnonzero(_distance(x.x @ centres[c]) - radius[c] <= t + ROOM) for x, c in ((a, cells[1]), (b, cells[0]))]
        if not len(rows[0]) or not len(rows[1]):
            return None
        if 2 * len(rows[0]) * len(rows[1]) >= len(a.x) * len(b.x):  # the others link with none either way
            return traverse(a, b, cosine, False), *whole
        return traverse(_part(a, rows[0]), _part(b, rows[1]), cosine, False), *rows

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _Chunks(folder, dim, 2 * each)
        for batch in batches:
            for unit_ in batch.column(0).to_pylist():
                high = (math.isqrt(8 * unit_ + 1) - 1) // 2
                low = unit_ - high * (high + 1) // 2
                of = [np.arange(g * each, min((g + 1) * each, total)) for g in (low, high)]
                cell = [np.searchsorted(first, x, "right") - 1 for x in of]
                near = apart[np.ix_(*cell)] - radius[cell[0]][:, None] - radius[cell[1]][None, :] <= t + 2 * ROOM
                near &= of[0][:, None] <= of[1][None, :]
                counts: dict[int, np.ndarray] = {}
                start: dict[int, int] = {}
                names: list[np.ndarray] = []
                edges: list[tuple[np.ndarray, np.ndarray]] = []

                def known(chunk: int, entry: tuple) -> int:
                    """Where the chunk's rows begin among those of the groups."""
                    if chunk not in start:
                        start[chunk] = sum(map(len, names))
                        names.append(entry[1])
                        counts[chunk] = np.zeros(len(entry[1]))
                    return start[chunk]

                for i, j in np.argwhere(near).tolist():
                    x, y = int(of[0][i]), int(of[1][j])
                    left, right = store.get(x), store.get(y)
                    found = link(left, right, (int(cell[0][i]), int(cell[1][j])), x == y) if left and right else None
                    if found is None:
                        continue
                    links, rows, others = found
                    at = [known(x, left) + rows, known(y, right) + others]
                    n, m = links.counts()
                    counts[x][rows] += n
                    if x != y:
                        counts[y][others] += m
                    place = at[0] if x == y else np.concatenate(at)
                    p, q = links.edges()
                    edges.append((place[p], place[q]))
                if not names:
                    continue
                cls, total_links = np.concatenate(names), np.concatenate([counts[c] for c in start])
                label = _labels(len(cls), *(np.concatenate([e[k] for e in edges]) for k in (0, 1)))
                at, joined = np.flatnonzero(total_links > 0), np.flatnonzero(label != np.arange(len(cls)))
                columns = [
                    np.concatenate([cls[at], cls[joined]]), np.concatenate([np.full(len(at), -1), cls[label[joined]]]),
                    np.concatenate([np.rint(total_links[at]).astype(np.int64), np.zeros(len(joined), np.int64)]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "n"])

    units = groups * (groups + 1) // 2
    return spark.range(0, units, 1, max(1, min(units, TASKS))).mapInArrow(meet, "a bigint, b bigint, n bigint")


def _kept_paths(paths: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A tree's paths (those of the rows at `place`, in order) over these rows."""
    out, rows = [], np.arange(len(place))
    for path in paths:
        nodes, group = np.unique(path, return_inverse=True)
        first = np.full(len(nodes), len(place))
        np.minimum.at(first, group, rows)
        at = np.searchsorted(place, nodes)
        there = (at < len(place)) & (place[np.minimum(at, len(place) - 1)] == nodes)
        out.append(np.where(there, at, first)[group])
    return np.array(out)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing and stand for themselves; vectors link only
    with those of as many numbers. Repeated vectors and repeated rows link with each other. Null ids never name a component: it is
    null if all its ids are, and such rows are not kept. An empty table gives no rows; other columns are ignored.
    """
    # The vectors are read twice: that is less than to write them once more.
    rows = vector_rows(vectors, id_col, vector_col)
    grouped = rows.filter("digest IS NOT NULL").groupBy("digest", "dim").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("vec").alias("vec")
    )
    classes = stored(grouped.withColumn("cls", F.monotonically_increasing_id()), "classes")
    rows = rows.select("vec_id", "digest")
    spark, out = vectors.sparkSession, None
    for r in classes.groupBy("dim").count().collect():  # the different lengths of vectors
        part = _class_links(classes.filter(F.col("dim") == r["dim"]), r["dim"], r["count"], cosine)
        out = part if out is None else out.unionAll(part)
    links = stored(out if out is not None else spark.createDataFrame([], "a bigint, b bigint, n bigint"), "links")
    counts = links.filter("b < 0").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    roots = components(links.filter("b >= 0").select("a", "b")).withColumnRenamed("node", "cls")
    told = classes.select("cls", "digest", "least", "weight").join(counts, "cls", "left").join(roots, "cls", "left")
    told = told.withColumn("root", F.coalesce("root", "cls"))
    least = told.groupBy("root").agg(F.min("least").alias("component"))
    told = told.join(least, "root").select("digest", "component", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"))
    held, alone = rows.filter("digest IS NOT NULL"), rows.filter("digest IS NULL")
    joined = held.select("vec_id", "digest").join(told, "digest").select("vec_id", "links", "component")
    every = joined.unionAll(alone.select("vec_id", F.lit(0).cast("bigint"), F.col("vec_id").cast("bigint")))
    return every.select(
        "vec_id", F.col("links").alias("n_links"), F.col("component").cast("bigint").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"),
    )
