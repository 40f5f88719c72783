"""Embeddings: whitening against a direct eigensolver, codes against all distances."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_frames import FOLDER
from tidemark.llm import anchor_trees, part_codes, queries, singular, sql, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, whitened string, code string, tm_id string"
NAN, INF = float("nan"), float("inf")


def table(ready, rows):
    named = [(i, v, label, "w", "c", "t") for i, v, label in rows]
    return ready.createDataFrame(named, SCHEMA)


@pytest.fixture(scope="module")
def odd(ready):
    """Vectors of 16 numbers: repeated, null, with gaps, of other lengths, without id or label."""
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(0, 1, 16).tolist(), i % 3) for i in range(60)]
    rows += [(7, rows[7][1], 1), (7, rows[7][1], 1), (None, rows[9][1], None), (61, rows[3][1], None)]
    bad = [None, [], [None] * 16, [NAN] * 16, [INF] + [0.0] * 15, [1.0] * 15, [-INF] * 16, [1.0] * 32]
    return rows, table(ready, rows + [(100 + i, v, 2) for i, v in enumerate(bad)])


def matrices():
    draw = np.random.default_rng(1)
    return {
        "any": draw.standard_normal((300, 40)),
        "graded": draw.standard_normal((300, 20)) * np.logspace(0, -6, 20),
        "of low rank": draw.standard_normal((300, 5)) @ draw.standard_normal((5, 20)),
        "few rows": draw.standard_normal((3, 16)),
        "zero columns": np.hstack([draw.standard_normal((50, 5)), np.zeros((50, 3))]),
        "equal blocks": np.kron(np.eye(4), draw.standard_normal((6, 5))),
        "equal columns": np.repeat(draw.standard_normal((30, 8)), 2, axis=1),
        "identity": np.eye(16),
        "one column": np.array([[3.0], [4.0]]),
        "nothing": np.zeros((5, 4)),
    }


@pytest.mark.parametrize("name", matrices())
def test_singular_values_and_vectors(name):
    factor = np.linalg.qr(matrices()[name], mode="r")
    factor = np.concatenate([factor, np.zeros((factor.shape[1] - len(factor), factor.shape[1]))])
    squares, turn = singular.right_singular(factor)
    wanted = np.linalg.svd(factor, compute_uv=False) ** 2
    size = max(wanted[0], 1e-300)
    real = wanted > 1e-12 * size
    assert np.allclose(squares[real], wanted[real], rtol=1e-11, atol=0)
    assert abs(squares - wanted).max() <= 1e-13 * size
    assert abs(turn.T @ turn - np.eye(len(wanted))).max() < 1e-11
    assert abs(factor.T @ factor @ turn - turn * squares).max() <= 1e-13 * size


def direct_whitening(rows):
    x = np.floor(np.array(rows, np.float64) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    variances, turn = np.linalg.eigh(centred.T @ centred / n)
    variances, turn = variances[::-1], turn[:, ::-1][:, :8]
    return ((n * x - sums) ** 2).sum(axis=1), variances, centred @ turn / np.sqrt(variances[:8])


def same_whitening(found, ids, rows):
    deviation, variances, wanted = direct_whitening(rows)
    by = {}
    for r in found:
        by.setdefault((r["vec_id"], r["component"]), set()).add(r["whitened"])
        assert r["n"] == len(rows) and r["identity_error"] < 1e-10
        assert abs(r["explained"] / (variances[r["component"] - 1] / variances.sum()) - 1) < 1e-10
    assert {r["deviation"] for r in found} == set(deviation.tolist())
    for c in range(8):
        own = np.array([next(iter(by[i, c + 1])) for i in ids])
        assert min(abs(own - wanted[:, c]).max(), abs(own + wanted[:, c]).max()) < 1e-8


def test_whitening_equals_eigensolver(ready):
    given = vectors.embeddings(ready, FOLDER).collect()
    found = queries.op11_whitening(ready, FOLDER).collect()
    assert len(found) == 8 * len(given)
    same_whitening(found, [r["vec_id"] for r in given], [r["embedding"] for r in given])


def test_whitening_of_odd_rows(odd):
    rows, df = odd
    found = whitening.whitened_components(df.repartition(5)).collect()
    assert len(found) == 8 * len(rows)
    same_whitening(found, [r[0] for r in rows], np.array([r[1] for r in rows], np.float32))


def test_factors_are_folded_in_rounds(odd, monkeypatch):
    rows, df = odd
    monkeypatch.setattr(whitening, "FOLD", 3)
    found = whitening.whitened_components(df.repartition(20)).collect()
    same_whitening(found, [r[0] for r in rows], np.array([r[1] for r in rows], np.float32))


def test_whitening_without_variance(ready, odd):
    df = odd[1]
    for some in (df.filter("false"), df.filter("vec_id in (7, 100, 101, 102)"), df.filter("vec_id = 9")):
        empty = whitening.whitened_components(some)
        assert empty.count() == 0 and "identity_error" in empty.columns
    line = table(ready, [(i, [float(i)] * 16, 0) for i in range(20)])
    found = whitening.whitened_components(line).collect()
    assert len(found) == 20 and {r["component"] for r in found} == {1}
    assert abs(found[0]["explained"] - 1) < 1e-12


def test_deviation_beyond_a_long_is_null(ready):
    rows = [(i, [float((-1) ** i) * 1e30] * 16, 0) for i in range(8)]
    assert {r["deviation"] for r in whitening.whitened_components(table(ready, rows)).collect()} == {None}


def direct_codes(rows, parts=16, entries=64, rounds=2):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    x = np.floor(np.array([r[1] for r in rows], np.float64) * 256).astype(np.int64)
    books = [p[order[:entries]] for p in np.split(x, parts, axis=1)]

    def assigned():
        away = [((p[:, None] - b[None]) ** 2).sum(axis=2) for p, b in zip(np.split(x, parts, axis=1), books)]
        return np.array([a.argmin(axis=1) for a in away]), sum(a.min(axis=1) for a in away)

    for _ in range(rounds):
        own, _ = assigned()
        for p, values in enumerate(np.split(x, parts, axis=1)):
            for k in set(own[p].tolist()):
                books[p][k] = values[own[p] == k].sum(axis=0) // (own[p] == k).sum()
    own, error = assigned()
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()
    by_label = {}
    for r, e in zip(rows, error):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    return sorted(
        repr((r[0], "".join(f"{k:02x}" for k in own[:, i]), int(error[i]), by_label[r[2]], digest))
        for i, r in enumerate(rows)
    )


def as_rows(df):
    columns = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


def test_codes_equal_all_distances(ready):
    given = vectors.embeddings(ready, FOLDER).collect()
    wanted = direct_codes([(r["vec_id"], r["embedding"], r["label"]) for r in given])
    assert as_rows(queries.op13_part_codes(ready, FOLDER)) == wanted


def test_codes_equal_sql(ready, duck):
    duck.execute(f"create or replace view embeddings as from '{FOLDER}/embeddings.parquet'")
    found = duck.sql(sql.PART_CODES)
    columns = ", ".join(("vec_id", "code", "error", "label_error", "codebooks_sha256"))
    wanted = sorted(repr(r) for r in found.project(columns).fetchall())
    assert as_rows(queries.op13_part_codes(ready, FOLDER)) == wanted


def test_codes_of_odd_rows(odd, monkeypatch):
    rows, df = odd
    rows = [(i, np.array(v, np.float32).tolist(), label) for i, v, label in rows]
    assert as_rows(part_codes.part_codes(df)) == direct_codes(rows)
    monkeypatch.setattr(part_codes, "BLOCK_ROWS", 7)  # trees over a few rows each
    assert as_rows(part_codes.part_codes(df.repartition(3), entries=5)) == direct_codes(rows, entries=5)
    assert part_codes.part_codes(df.filter("false")).count() == 0
    with pytest.raises(ValueError):
        part_codes.part_codes(df, parts=5)


@pytest.mark.parametrize("spread", (1, 3, 200, 1 << 27))
def test_trees_find_the_nearest_entry(spread):
    draw = np.random.default_rng(spread)
    for points in (
        draw.integers(-spread, spread + 1, (700, 4)),
        np.repeat(draw.integers(-spread, spread + 1, (9, 4)), 80, axis=0),
        draw.integers(-spread, spread + 1, (1, 4)),
    ):
        entries = np.concatenate([points[:20], points[:3], draw.integers(-spread, spread + 1, (10, 4))])
        wanted = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
        tree = anchor_trees.Tree.loads(anchor_trees.build(points).dumps())
        assert (anchor_trees.nearest(tree, points, entries) == wanted).all()
        totals = anchor_trees.totals(tree, points, entries)
        for k in range(len(entries)):
            own = points[wanted == k]
            assert totals[k].tolist() == [len(own), *own.sum(axis=0)]


def test_separate_clusters_are_owned_whole():
    draw = np.random.default_rng(0)
    centres = np.array([[0, 0], [1000, 0], [0, 1000]])
    points = np.concatenate([c + draw.integers(-20, 20, (500, 2)) for c in centres])
    tree = anchor_trees.build(points)
    (balls, _), (single, _) = anchor_trees.owners(tree, points, centres)
    assert len(single) == 0 and (tree.end - tree.start)[balls].sum() == len(points)


def test_scaling_is_floor(ready):
    rows = table(ready, [(0, [-0.001] * 16, 0), (1, [0.0] * 16, 0)])
    found = rows.filter(F.col("vec_id") == 0).select("embedding").toArrow().column(0).combine_chunks()
    assert set(vectors.scaled(found, 16, 256, 1 << 28).ravel().tolist()) == {-1}
