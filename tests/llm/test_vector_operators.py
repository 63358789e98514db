"""Whitening, product codes and source mixing against plain versions."""

import hashlib
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest

from scoreflow.llm import cover_codes, mixing, whitening
from scoreflow.llm.common import read_table

VECTORS = "vec_id bigint, embedding array<float>, label int, x int, k1 bigint, copies bigint, y string"


def _vectors(n=300, dim=8, seed=3):
    """Clustered vectors, copies of one that are a third of all rows, ties,
    null and repeated ids, and rows that go."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [(i, (centres[i % 6] + 0.2 * rng.normal(size=dim)).astype(np.float32).tolist(), i % 4) for i in range(n)]
    rows += [(10_000 + i, rows[5][1], 1) for i in range(n // 2)]
    rows += [(7, rows[8][1], None), (7, rows[7][1], None), (None, rows[9][1], None), (None, rows[10][1], 3)]
    bad = [None, [], [1.0] * (dim - 1), [1.0] * (dim - 1) + [None], [1.0] * (dim - 1) + [math.nan], [math.inf] + [0.0] * (dim - 1)]
    kept = list(rows)
    rows += [(20_000 + i, v, 0) for i, v in enumerate(bad)]
    random.Random(1).shuffle(rows)
    return rows, kept


def _table(spark, rows):
    return spark.createDataFrame([(i, v, c, 1, 2, 3, "y") for i, v, c in rows], VECTORS).repartition(5)


def _check_whitening(found, kept):
    x = {}
    for i, v, _ in kept:
        x.setdefault(i, []).append(tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v))
    points = sorted({p for ps in x.values() for p in ps})
    n, sums = len(points), [sum(c) for c in zip(*points, strict=True)]
    centred = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(p, sums, strict=True)] for p in points])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    rows = {}
    for r in found:
        rows.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    assert {r.n for r in found} == {n}
    (error,) = {r.identity_error for r in found}
    assert error <= 1e-9
    parts = min(16, int((values > 1e-9 * values[0]).sum()))
    assert len(found) == parts * len(kept)
    white = centred @ (vectors[:, :parts] / np.sqrt(values[:parts]))
    where = {p: i for i, p in enumerate(points)}
    signs = {}
    for i, ps in x.items():
        for p in ps:
            deviation = sum((n * c - s) ** 2 for c, s in zip(p, sums, strict=True))
            for k in range(parts):
                hits = rows[i, deviation][k + 1]
                want = white[where[p], k]
                for r in hits:
                    assert abs(abs(r.whitened) - abs(want)) < 1e-7 * max(1, abs(want))
                    if abs(want) > 1e-6:
                        signs.setdefault(k, set()).add(np.sign(r.whitened) * np.sign(want))
                    assert abs(r.explained - values[k] / values.sum()) < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 5 * 16)  # several blocks of rows and columns
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 5)
    rows, kept = _vectors()
    _check_whitening(whitening.whitening_digest(_table(spark, rows)).collect(), kept)


def test_whitening_of_more_dimensions_than_components(spark):
    rows, kept = _vectors(n=60, dim=24, seed=4)
    _check_whitening(whitening.whitening_digest(_table(spark, rows)).collect(), kept)


def test_whitening_without_variance(spark):
    """A constant and a repeated dimension have no component; equal vectors
    and an empty table give no rows."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(a), float(b), float(a), 0.5], 0) for i, (a, b) in enumerate(rng.normal(size=(40, 2)))]
    found = whitening.whitening_digest(_table(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2} and len(found) == 80
    for rows in ([(i, [1.0, 2.0], 0) for i in range(5)], []):
        out = whitening.whitening_digest(_table(spark, rows))
        assert out.collect() == []
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def _plain_codes(kept, parts=4, entries=256, rounds=4):
    vectors = [(i, [math.floor(1024 * float(np.float32(c))) for c in v], c) for i, v, c in kept]
    first = sorted(vectors, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    width = len(vectors[0][1]) // parts
    cut = lambda v, k: v[k * width : (k + 1) * width]
    books = [[cut(v, k) for _, v, _ in first] for k in range(parts)]

    def nearest(part, book):
        d = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for k in range(parts):
            held = {}
            for _, v, _ in vectors:
                held.setdefault(nearest(cut(v, k), books[k])[0], []).append(cut(v, k))
            books[k] = [[sum(c) // len(held[e]) for c in zip(*held[e], strict=True)] if e in held else b for e, b in enumerate(books[k])]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, by_label = [], {}
    for i, v, label in vectors:
        at = [nearest(cut(v, k), books[k]) for k in range(parts)]
        error = sum(d for _, d in at)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for e, _ in at), error, label))
    return sorted(((i, c, e, by_label[label], digest) for i, c, e, label in out), key=repr)


def test_codes_against_plain_lloyd(spark, monkeypatch):
    monkeypatch.setattr(cover_codes, "CHUNK_ROWS", 64)
    rows, kept = _vectors()
    found = cover_codes.compression_digest(_table(spark, rows))
    assert sorted(map(tuple, found.collect()), key=repr) == _plain_codes(kept)


def test_codes_of_few_rows(spark):
    rows, kept = _vectors(n=12, dim=4, seed=9)
    found = cover_codes.compression_digest(_table(spark, rows))
    assert sorted(map(tuple, found.collect()), key=repr) == _plain_codes(kept)
    empty = cover_codes.compression_digest(_table(spark, []))
    assert empty.collect() == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError, match="equal parts"):
        cover_codes.compression_digest(_table(spark, [(1, [1.0, 2.0, 3.0], 0)])).collect()


@pytest.mark.parametrize("dim", [1, 2, 8])
def test_cover_tree(dim):
    rng = np.random.default_rng(dim)
    rows = np.concatenate([rng.integers(-900, 900, size=(400, dim)), np.zeros((50, dim), dtype=int), rng.integers(0, 5, size=(200, dim))])
    tree = cover_codes.build_tree(rows)
    assert (tree.points[tree.point_of] == rows).all() and tree.counts.sum() == len(rows)
    for c, r2, b, e, child, n in zip(tree.centre, tree.radius2, tree.begin, tree.end, tree.child, tree.children, strict=True):
        assert c == b
        assert ((tree.points[b:e] - tree.points[c]) ** 2).sum(1).max() == r2
        if n:  # children partition the node, and the first keeps its centre
            kids = range(child, child + n)
            assert tree.begin[child] == b and tree.end[child + n - 1] == e
            assert all(tree.end[k] == tree.begin[k + 1] for k in kids[:-1])
            assert all(4 * tree.radius2[k] <= r2 for k in kids)
    book = rng.integers(-900, 900, size=(20, dim))
    book[7] = book[3]  # a tie goes to the lower index
    d = ((tree.points[:, None, :] - book[None]) ** 2).sum(2)
    entry = cover_codes.assign_points(tree, book)
    assert (entry == d.argmin(1)).all() and 7 not in entry
    sums = cover_codes.subtree_sums(tree, entry, 20)
    near = ((rows[:, None, :] - book[None]) ** 2).sum(2).argmin(1)
    for k in range(20):
        assert sums[k, 0] == (near == k).sum() and (sums[k, 1:] == rows[near == k].sum(0)).all()


def test_whole_subtrees_are_assigned_without_their_points(monkeypatch):
    """Tight clusters far apart: no distance beyond the upper nodes is taken."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-100_000, 100_000, size=(8, 4))
    rows = np.concatenate([c + rng.integers(-3, 4, size=(200, 4)) for c in centres])
    tree = cover_codes.build_tree(rows)
    taken = []
    real = cover_codes.squared_distances
    monkeypatch.setattr(cover_codes, "squared_distances", lambda a, b: taken.append(len(a)) or real(a, b))
    entry = cover_codes.assign_points(tree, centres)
    assert sum(taken) < len(tree.points) / 10
    assert (entry == ((tree.points[:, None] - centres[None]) ** 2).sum(2).argmin(1)).all()


def test_far_components(spark):
    """Beyond exact doubles the distances are longs; beyond those an error."""
    a = np.array([[1 << 29, 3], [-(1 << 29), 5]])
    assert cover_codes.squared_distances(a, a).tolist() == [[0, (1 << 60) + 4], [(1 << 60) + 4, 0]]
    with pytest.raises(ValueError, match="too large"):
        cover_codes.squared_distances(a << 4, a)


def _targets(sizes, weights, epochs):
    """The excess reshared round by round, in fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped, words = {}, set(), Fraction(sum(sizes.values()))
    while True:
        left = words - sum(epochs * sizes[s] for s in capped)
        total = sum(weight[s] for s in order if s not in capped)
        target = {s: Fraction(epochs * sizes[s]) if s in capped else left * weight[s] / total for s in order}
        over = {s for s in order if target[s] > epochs * sizes[s]}
        if not over:
            return target
        capped |= over


DOCS = "doc_id bigint, text string, source string, size bigint, key string, taken string, s int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, s, -1, "k", "t", 0) for i, t, s in rows], DOCS).repartition(4)


def _sources(rng):
    words = lambda n: " ".join(rng.choice(["a", "bb", "é", "日本"]) for _ in range(n))
    rows = [(i, words(rng.randrange(1, 30)), rng.choice("zab")) for i in range(120)]
    rows += [(200 + i, words(3), "tiny") for i in range(2)] + [(300 + i, words(5), None) for i in range(9)]
    rows += [(400, "the same text twice over", "a")] * 150 + [(None, "no id at all", "b")] * 20
    rows += [(500, None, "a"), (501, "", "b"), (502, " \t\r\x0b\x0c\n ", "b"), (503, " x y z", "z"), (504, "", "void")]
    rows += [(505, words(9000), "z")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("weights", [(5, 2, 1), (1, 9), (1000, 1, 1, 1)])
def test_mix(spark, monkeypatch, weights):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 10)
    rows = _sources(random.Random(len(weights)))
    found = mixing.mix_digest(_docs(spark, rows), weights).collect()
    assert len(found) == len(rows)
    sizes = {}
    for i, t, s in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] = sizes.get(s, 0) + n
    target = _targets(sizes, weights, 3)
    taken = {}
    for r in found:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - float(target[r.source])) <= 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        e = int(r.target // r.source_size) if r.source_size else 0
        assert e * r.size <= r.taken <= (e + 1) * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - float(target[s])) <= 0.5
    # At most one document (or copy) of a source is cut; the others are taken whole times.
    for s in taken:
        assert sum(bool(r.size and r.taken % r.size) for r in found if r.source == s) <= 1
    again = mixing.mix_digest(_docs(spark, rows[::-1]).repartition(7), weights).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, found))


def test_mixed_documents(spark):
    rows = _sources(random.Random(8))
    digest = mixing.mix_digest(_docs(spark, rows)).collect()
    out = mixing.mix_documents(_docs(spark, rows)).collect()
    assert out[0].asDict().keys() == {*DOCS.replace(",", "").split()[::2], "mix_epoch", "mix_words"}
    assert sum(r.mix_words for r in out) == sum(r.taken for r in digest)
    assert {(r.text, r.source) for r in out} <= {(t, s) for _, t, s in rows} and {r.size for r in out} == {-1}


def test_mix_of_nothing(spark):
    for rows in ([], [(1, None, None), (2, "", "a")]):
        found = mixing.mix_digest(_docs(spark, rows)).collect()
        assert [(r.size, r.target, r.taken) for r in found] == [(0, 0.0, 0)] * len(rows)
    with pytest.raises(ValueError):
        mixing.mix_digest(_docs(spark, []), weights=())


def test_registered_vector_queries(spark, sf_small):
    """The other two have DuckDB SQL."""
    from scoreflow.llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding, r.label) for r in read_table(spark, sf_small, "embeddings").collect()]
    _check_whitening(QUERIES["op11_whitening"](spark, sf_small).collect(), rows)
