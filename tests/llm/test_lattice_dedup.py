"""Embedding groups against all pairs, the lattice, odd vectors."""

import itertools

import numpy as np
import pytest

from innledger.llm import lattice_dedup
from innledger.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, row string, id int, h long"


def brute(rows, least=0.98):
    """vec_id: (links, smallest id reachable) from all pairs."""
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    close = (x @ x.T >= least) & (label[:, None] == label[None])
    np.fill_diagonal(close, False)
    ids = np.array([r[0] for r in rows])
    name = ids.copy()
    while True:
        new = np.minimum(name, np.where(close, name[None], ids.max() + 1).min(1))
        if (new == name).all():
            return dict(zip(ids.tolist(), zip(close.sum(1).tolist(), name.tolist(), strict=True), strict=True))
        name = new


def test_recall_beside_all_pairs(spark):
    """The vectors of a test table and turned copies of them, around the least cosine."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    rng = np.random.default_rng(7)
    rows = [(r.vec_id, list(r.embedding), r.label) for r in table if r.embedding and r.label is not None]
    for k in range(1500):
        _, vector, label = rows[rng.integers(len(table) // 2)]
        turn = rng.normal(size=len(vector)) * np.linalg.norm(vector) / np.sqrt(len(vector))
        near = (np.array(vector) + turn * rng.uniform(0.02, 0.2)).astype(np.float32)
        rows.append((10_000 + k, near.tolist(), label))
    want = brute(rows)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = {r.vec_id: r for r in lattice_dedup.near_duplicates(df).collect()}
    assert set(got) == set(want)
    links = sum(n for n, _ in want.values())
    assert links > 2000 and 0.99 * links <= sum(r.n_links for r in got.values()) <= links
    assert all(r.n_links <= want[i][0] for i, r in got.items())
    assert np.mean([r.component_id == want[i][1] for i, r in got.items()]) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_embedding_near_dedup"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert dict(got.dtypes) == {
        "vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean",
    }


def test_nearest_points():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 2
    points = lattice_dedup.nearest_points(x)
    sums = points.sum(1)
    assert np.allclose(sums % 2, 0) and (np.isclose(points % 1, 0).all(1) | np.isclose(points % 1, 0.5).all(1)).all()
    away = ((x - points) ** 2).sum(1)
    for root in lattice_dedup._roots():
        assert (((x - points - root) ** 2).sum(1) >= away - 1e-9).all()
    assert away.max() <= 1 + 1e-9 and len(lattice_dedup._roots()) == 240


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=16).tolist()
    near = (np.array(a) + rng.normal(size=16) * 0.02).tolist()
    half = [x / 2 for x in a]
    nan, inf = float("nan"), float("inf")
    rows = [
        (10, a, 1), (3, near, 1), (4, a, 1), (4, a, 1), (5, half, 1), (6, a, 2), (7, a, None),
        (8, None, 1), (9, [0.0] * 16, 1), (11, [nan, *a[1:]], 1), (12, [inf, *a[1:]], 1),
        (13, [None, *a[1:]], 1), (14, [], 1), (15, a[:8], 1), (None, a, 1), (None, a[::-1], 1),
    ]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = lattice_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    group = [r for r in got if r.component_id == 3]
    assert sorted((r.vec_id or 0, r.n_links) for r in group) == [(0, 5), (3, 5), (4, 5), (4, 5), (5, 5), (10, 5)]
    assert [r.vec_id for r in group if r.kept] == [3]
    rest = [r for r in got if r.component_id != 3]
    assert all(r.n_links == 0 and r.vec_id == r.component_id and r.kept for r in rest)


@pytest.mark.parametrize("size", [32, 64, 128])
def test_recall_at_the_threshold(spark, size):
    """Pairs of one cosine each; they are found more often the closer they are."""
    rng = np.random.default_rng(size)
    for cosine, least in ((0.9801, 0.95), (0.985, 0.98), (0.99, 0.995)):
        x = rng.normal(size=(800, size))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        away = rng.normal(size=x.shape)
        away -= (away * x).sum(1, keepdims=True) * x
        away /= np.linalg.norm(away, axis=1, keepdims=True)
        y = cosine * x + np.sqrt(1 - cosine**2) * away
        rows = [(2 * k + i, v.tolist(), k) for k in range(800) for i, v in ((0, x[k]), (1, y[k]))]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        got = lattice_dedup.near_duplicates(df).filter("n_links = 1").count() / 2
        assert got >= least * 800


@pytest.mark.parametrize("kind", ["string", "double", "date", "struct<a: int, b: string>"])
def test_labels_of_any_type(spark, kind):
    rng = np.random.default_rng(3)
    a = rng.normal(size=16).tolist()
    near = (np.array(a) + rng.normal(size=16) * 0.01).tolist()
    one, other = {
        "string": ("'x'", "'y'"), "double": ("1.5D", "1.25D"), "date": ("DATE '2020-01-01'", "DATE '2020-01-02'"),
    }.get(kind, ("named_struct('a', 1, 'b', 'x')", "named_struct('a', 1, 'b', 'y')"))
    rows = [(1, a, 0), (2, near, 0), (3, a, 1), (4, near, 1), (5, a, None), (6, a, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int").selectExpr(
        "vec_id", "embedding", f"CAST(CASE n WHEN 0 THEN {one} WHEN 1 THEN {other} END AS {kind}) AS label"
    )
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice_dedup.near_duplicates(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (2, 3), 4: (2, 3), 6: (2, 3), 5: (0, 5)}


def test_empty_table(spark):
    assert lattice_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("cosine", [0.98, 0.985, 0.995])
def test_pairs_of_a_chain(spark, cosine):
    """Vectors turned step by step: neighbours are linked, ends are not, all reach the first."""
    step = np.arccos(cosine) * 0.97
    rows = [(i, [float(np.cos(i * step)), float(np.sin(i * step))] + [0.0] * 30, 0) for i in range(12)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = {r.vec_id: r for r in lattice_dedup.near_duplicates(df, cosine).collect()}
    want = brute(rows, cosine)
    found = sum(r.n_links for r in got.values())
    assert found >= 0.9 * sum(n for n, _ in want.values())
    for i, j in itertools.combinations(range(12), 2):
        assert want[i][1] == want[j][1] == 0
