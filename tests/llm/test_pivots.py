import math
import random

import numpy as np
import pytest

from logvigil.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, label int, node string, n string, links string"


def brute(rows, least):
    good = {}
    for i, (_, v, label) in enumerate(rows):
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = np.array(v, np.float32).astype(np.float64)
    links = {i: set() for i in range(len(rows))}
    for i in good:
        for j in good:
            a, b = good[i], good[j]
            if i != j and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                    links[i].add(j)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[rows[i][0]] = (len(links[i]), min(rows[j][0] for j in seen))
    return out


def vectors(seed, groups=12, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=size)
        for _ in range(int(rng.integers(1, 25))):
            rows.append((centre + rng.normal(size=size) * 0.25, g % 3))
    rows += [(rng.normal(size=size), 0) for _ in range(60)] + [(rows[0][0], rows[0][1])] * 4
    return [(i, [float(x) for x in v], int(label)) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("block", [1024, 7])
def test_links_and_components_of_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    rows = vectors(3)
    rng = random.Random(0)
    rng.shuffle(rows)
    got = pivots.classed(spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)).collect()
    want = brute(rows, 0.93)
    found, all_links = sum(r.n_links for r in got), sum(n for n, _ in want.values())
    assert all(r.n_links <= want[r.vec_id][0] for r in got)
    assert found >= 0.99 * all_links and all_links > 300
    assert sum(r.component_id != want[r.vec_id][1] for r in got) <= 0.01 * len(rows)


def test_components_out_of_the_range_of_squares(spark):
    """Squares that are too large or too small for a double are no reason to lose links."""
    rows = [(0, [1e200, 1e200], "a"), (1, [2e-200, 2.1e-200], "a"), (2, [1.0, 1.0], "a"), (3, [1e200, -1e200], "a"), (4, [5e-324, 0.0], "a"), (5, [3.0, 0.0], "a")]
    got = {r.vec_id: (r.n_links, r.component_id) for r in pivots.classed(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (0, 3), 4: (1, 4), 5: (1, 4)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (7, [1.0, 1.0], None),
            (8, [1.0, 1.0], 0), (9, [2.0, 2.0], 0), (10, [1.0, 1.0, 0.0], 0), (11, [1.0, 1.0], 1), (12, [1e38, 1e38], 0), (8, [1.0, 1.0], 0)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in pivots.classed(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)).collect())
    assert got == sorted([(i, 0, i) for i in (1, 2, 3, 4, 5, 6, 7, 10, 11)] + [(8, 3, 8)] * 2 + [(9, 3, 8), (12, 3, 8)])
    null_id = spark.createDataFrame([(None, [1.0], 0, "", "", "")], SCHEMA)
    assert [(r.vec_id, r.n_links, r.component_id) for r in pivots.classed(null_id).collect()] == [(None, 0, None)]
    assert pivots.classed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pivots_grow_with_the_root():
    index = pivots.Index()
    assert index.pivots(100) == 64 and index.pivots(10**4) == 400 and index.pivots(10**12) == index.most_pivots


def dense_group(rows, size=64, seed=8):
    """Unit vectors, a third of them in one group of distinct near copies with cosines of 0.94 to 0.98."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    centre, off = unit(rng.normal(size=size)), rng.normal(size=(rows // 3, size))
    off = unit(off - (off @ centre)[:, None] * centre)
    share = rng.uniform(0.94, 0.98, rows // 3)[:, None]
    return np.concatenate([np.sqrt(share) * centre + np.sqrt(1 - share) * off, unit(rng.normal(size=(rows - rows // 3, size)))])


@pytest.mark.parametrize("rows", [10_000, 40_000, 100_000])
def test_members_of_a_dense_group_share_pivots(rows):
    index, x = pivots.Index(), dense_group(rows)
    pool = x[np.random.default_rng(0).permutation(rows)[: index.pool * index.pivots(rows)]]
    points = pivots.spread(pool, index.pivots(rows), 0.93)
    assert len(points) == index.pivots(rows)
    group = x[:: max(1, rows // 4000)][: 4000 // 3]
    named = np.zeros((len(group), len(points)), np.float32)
    np.put_along_axis(named, np.argpartition(-(group @ points.T), index.prefix - 1, axis=1)[:, : index.prefix], 1, 1)
    links = group @ group.T >= 0.93
    np.fill_diagonal(links, False)
    assert ((named @ named.T >= index.shared) & links).sum() >= 0.999 * links.sum() > 0


def test_links_of_a_dense_group(spark):
    x = dense_group(9000).astype(np.float32)
    rows = [(i, v.tolist(), 0, "", "", "") for i, v in enumerate(x)]
    got = pivots.classed(spark.createDataFrame(rows, SCHEMA)).agg({"n_links": "sum"}).head()[0]
    exact = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    links = int((exact @ exact.T >= 0.93).sum()) - len(x)
    assert 0.999 * links <= got <= links
