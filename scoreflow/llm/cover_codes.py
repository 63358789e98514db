"""Vector code compression: product codes by Lloyd rounds over cover trees.

Vectors are cut into parts, each part is coded by the nearest entry of its
codebook, and the codebooks are improved by Lloyd rounds in exact integers.

A partition's vectors are cut into chunks; each chunk has one cover tree per
part over its distinct parts, built once and written. A node covers the points
within its radius of its centre, and its children cover them within half of
that, the centre being the centre of one child again. Points are stored in the
order of the leaves, so every subtree is a stretch of them and its sums are a
difference of two cumulative sums.

A round reads the trees. With a the nearest entry to a node's centre p and r
its radius, the triangle inequality gives the whole subtree to a if every
other entry b has d(p, b) > d(p, a) + 2 r. Other nodes are ambiguous and
descend; leaves compare their points one by one, ties to the lower index. What
a task sends is one sum per codebook entry, so copies of a vector cost nothing
beyond their own task, and only the codebooks reach the driver.

Defined results: rows whose vector is null, empty or holds null or non-finite
components go, and so do vectors of another length than most; a null id is
carried, and such rows start a codebook only if there are not enough others;
repeated ids start it in the order of their vectors; with fewer rows than
entries the codebooks are as short; repeated rows each get their code; null
labels are one label; extra columns are ignored; an empty table gives no rows.
A length that the parts do not divide, or components so large that a squared
distance is no long, raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.llm.common import written
from scoreflow.llm.vectors import integer_vectors
from scoreflow.operators.joins import join_hot_split

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
# Vectors of a chunk (one tree per part), and points of a leaf.
CHUNK_ROWS, LEAF_POINTS = 2048, 8
# Nodes or points compared with a codebook at once.
STEP = 4096


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows; as doubles while those are exact."""
    most = 4 * a.shape[1] * max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0))) ** 2
    if most >= 1 << 63:
        raise ValueError("components too large: their squared distances are no longs")
    if most < 1 << 53:
        a, b = a.astype(float), b.astype(float)
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]


@dataclass
class CoverTree:
    """Distinct points in leaf order, how many rows hold each, each row's
    point, and the nodes: centre, squared radius, stretch of points, children."""

    points: np.ndarray
    counts: np.ndarray
    point_of: np.ndarray
    centre: np.ndarray
    radius2: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    child: np.ndarray
    children: np.ndarray


def build_tree(rows: np.ndarray) -> CoverTree:
    distinct, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    inverse = inverse.reshape(-1)
    order = np.arange(len(distinct))
    nodes = [[0, 0, 0, len(distinct), 0, 0]]  # centre, radius2, begin, end, first child, children
    at = 0
    while at < len(nodes):
        begin, end = nodes[at][2:4]
        own = order[begin:end]
        # The centre stands first in its stretch.
        to_centre = squared_distances(distinct[own[:1]], distinct[own])[0]
        nodes[at][0], nodes[at][1] = begin, int(to_centre.max())
        if end - begin > LEAF_POINTS:
            groups, left, near = [], own, to_centre
            within = nodes[at][1] / 4
            while len(left):
                inside = near <= within
                inside[0] = True
                groups.append(left[inside])
                left = left[~inside]
                if len(left):
                    near = squared_distances(distinct[left[:1]], distinct[left])[0]
            nodes[at][4:6] = len(nodes), len(groups)
            for group in groups:
                order[begin : begin + len(group)] = group
                nodes.append([0, 0, begin, begin + len(group), 0, 0])
                begin += len(group)
        at += 1
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    table = np.array(nodes, dtype=np.int64).reshape(-1, 6)
    return CoverTree(distinct[order], counts[order], place[inverse], *table.T)


def assign_points(tree: CoverTree, codebook: np.ndarray) -> np.ndarray:
    """The nearest entry (ties: lowest) of every point of the tree."""
    out = np.empty(len(tree.points), dtype=np.int64)
    exact = []
    front = np.zeros(1, dtype=np.int64)
    while len(front):
        below = []
        for at in range(0, len(front), STEP):
            nodes = front[at : at + STEP]
            d2 = squared_distances(tree.points[tree.centre[nodes]], codebook)
            nearest = d2.argmin(1)
            # A margin for the rounding of the roots: in doubt a node descends.
            reach = (np.sqrt(d2[np.arange(len(nodes)), nearest].astype(float)) + 2 * np.sqrt(tree.radius2[nodes])) * (1 + 1e-9)
            rivals = (np.sqrt(d2.astype(float)) <= reach[:, None]).sum(1)
            settled = (rivals == 1) | (tree.radius2[nodes] == 0)
            whole = nodes[settled]
            held = tree.end[whole] - tree.begin[whole]
            out[_stretches(tree.begin[whole], held)] = np.repeat(nearest[settled], held)
            open_nodes = nodes[~settled]
            leaves = tree.children[open_nodes] == 0
            exact.append(open_nodes[leaves])
            below.append(open_nodes[~leaves])
        inner = np.concatenate(below)
        front = _stretches(tree.child[inner], tree.children[inner])
    leaves = np.concatenate(exact)
    points = _stretches(tree.begin[leaves], tree.end[leaves] - tree.begin[leaves])
    for at in range(0, len(points), STEP):
        some = points[at : at + STEP]
        out[some] = squared_distances(tree.points[some], codebook).argmin(1)
    return out


def _stretches(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All numbers of the stretches [begin, begin + length)."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - length), length)


def subtree_sums(tree: CoverTree, entry: np.ndarray, entries: int) -> np.ndarray:
    """Per codebook entry the number of its rows and their sums: stretches of
    points with one entry are differences of the cumulative sums."""
    weighted = np.column_stack([tree.counts, tree.points * tree.counts[:, None]])
    cumulative = np.zeros((len(weighted) + 1, weighted.shape[1]), dtype=np.int64)
    np.cumsum(weighted, axis=0, out=cumulative[1:])
    cut = np.flatnonzero(np.diff(entry, prepend=-1, append=-1))
    out = np.zeros((entries, weighted.shape[1]), dtype=np.int64)
    np.add.at(out, entry[cut[:-1]], cumulative[cut[1:]] - cumulative[cut[:-1]])
    return out


_TREE_FIELDS = ("points", "counts", "point_of", "centre", "radius2", "begin", "end", "child", "children")
_TREE = "struct<" + ",".join(f"{f}:array<bigint>" for f in _TREE_FIELDS) + ">"
CHUNKS = f"ids array<bigint>, labels array<string>, trees array<{_TREE}>"
_TREE_TYPE = pa.struct([(f, pa.list_(pa.int64())) for f in _TREE_FIELDS])


def _chunk_rows(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            chunk = batch.slice(at, CHUNK_ROWS)
            x = chunk.column("x").flatten().to_numpy(zero_copy_only=False).reshape(chunk.num_rows, -1)
            trees = []
            for part in np.split(x, parts, axis=1):
                tree = build_tree(part)
                trees.append({f: getattr(tree, f).reshape(-1) for f in _TREE_FIELDS})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk.column("id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([chunk.column("label").to_pylist()], pa.list_(pa.string())),
                    pa.array([trees], pa.list_(_TREE_TYPE)),
                ],
                names=["ids", "labels", "trees"],
            )


def _trees(batch: pa.RecordBatch) -> Iterator[tuple[int, list[CoverTree]]]:
    """(row of the batch, its trees), one chunk at a time."""
    for i in range(batch.num_rows):
        trees = batch.column("trees")[i].values
        found = []
        for k in range(len(trees)):
            fields = {f: trees.field(f)[k].values.to_numpy(zero_copy_only=False) for f in _TREE_FIELDS}
            fields["points"] = fields["points"].reshape(len(fields["counts"]), -1)
            found.append(CoverTree(**fields))
        yield i, found


SUMS = "part int, entry int, pos int, total bigint"


def _round_sums(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per part, entry in use and position (0: the count) of all
    chunks of the task."""
    parts, entries, width = codebooks.shape
    sums = np.zeros((parts, entries, width + 1), dtype=np.int64)
    for batch in batches:
        for _, trees in _trees(batch):
            for k, tree in enumerate(trees):
                sums[k] += subtree_sums(tree, assign_points(tree, codebooks[k]), entries)
    part, entry = np.nonzero(sums[:, :, 0])
    columns = [np.repeat(part, width + 1), np.repeat(entry, width + 1), np.tile(np.arange(width + 1), len(part))]
    arrays = [pa.array(c.astype(np.int32)) for c in columns] + [pa.array(sums[part, entry].reshape(-1))]
    yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "pos", "total"])


CODES = "id bigint, label string, code string, error bigint"


def _coded(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[pa.RecordBatch]:
    digits = max(2, len(f"{codebooks.shape[1] - 1:x}"))
    for batch in batches:
        for i, trees in _trees(batch):
            codes, error = [], 0
            for k, tree in enumerate(trees):
                entry = assign_points(tree, codebooks[k])
                apart = tree.points - codebooks[k][entry]
                codes.append(entry[tree.point_of])
                error = error + (apart * apart).sum(1)[tree.point_of]
            code = ["".join(f"{e:0{digits}x}" for e in row) for row in np.column_stack(codes).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(code), pa.array(error)],
                names=["id", "label", "code", "error"],
            )


@dataclass(frozen=True)
class Codebooks:
    """Parts x entries x components, in integers."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def cover_trees(rows: DataFrame, parts: int) -> DataFrame:
    """The written chunks of (id, label, x)."""
    return written(rows.mapInArrow(lambda batches: _chunk_rows(batches, parts), CHUNKS), "cover_trees")


def learn_codebooks(first: np.ndarray, chunks: DataFrame, parts: int, rounds: int) -> Codebooks:
    """`rounds` Lloyd rounds from the vectors `first`."""
    codebooks = np.stack(np.split(first, parts, axis=1)).astype(np.int64)
    for _ in range(rounds):
        known = codebooks
        partial = chunks.select("trees").mapInArrow(lambda batches, c=known: _round_sums(batches, c), SUMS)
        found = partial.groupBy("part", "entry", "pos").agg(F.sum("total").alias("total")).collect()
        sums = np.zeros((*known.shape[:2], known.shape[2] + 1), dtype=np.int64)
        for r in found:
            sums[r.part, r.entry, r.pos] = r.total
        counts = sums[:, :, :1]
        # numpy's floor division rounds down, as the rule asks.
        codebooks = np.where(counts > 0, sums[:, :, 1:] // np.maximum(counts, 1), known)
    return Codebooks(codebooks)


def compress(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """(id, label as string, code, error) of every kept row, and the codebooks."""
    spark = rows.sparkSession
    named = rows.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{vector}`").alias("v")
    )
    kept = integer_vectors(named, "v", scale).select("id", "label", "x")
    # A codebook starts from a bounded number of rows.
    first = kept.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    if not first:
        return spark.createDataFrame([], CODES), None
    if len(first[0].x) % parts:
        raise ValueError(f"{len(first[0].x)} components are not {parts} equal parts")
    chunks = cover_trees(kept, parts)
    model = learn_codebooks(np.array([r.x for r in first], dtype=np.int64), chunks, parts, rounds)
    return chunks.mapInArrow(lambda batches: _coded(batches, model.entries), CODES), model


def compression_digest(rows: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept row."""
    found, model = compress(rows)
    found = written(found, "codes")
    totals = found.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("copies"))
    joined = join_hot_split(found, written(totals, "label_errors"), ["label"], "copies", found.count())
    return joined.select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(model.sha256() if model else None).cast("string").alias("codebooks_sha256")
    )
