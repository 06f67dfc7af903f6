"""Iterative / numerical operators against brute force on small fixtures."""

import math
import os
import struct

import numpy as np
import pyarrow as pa
import pytest

from tadkit.operators import segment as sg
from tadkit.operators import stats as st
from tadkit.operators import textmining as tm

RNG = np.random.default_rng(7)


@pytest.fixture(scope="module")
def blobs(spark):
    pts = np.vstack([RNG.normal(c, 0.3, size=(40, 2)) for c in ([0, 0], [5, 5], [0, 6])] + [np.array([[20, 20], [-15, 9]])])
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)]
    return spark.createDataFrame(rows, "id long, x array<double>"), pts


def test_knn_exact_vs_brute_force(spark, blobs):
    df, pts = blobs
    k = 4
    nb = sg.knn(df, df, "id", "x", k, exclude_self=True).collect()
    got = {}
    for r in nb:
        got.setdefault(r["query_id"], []).append((r["rank"], r["ref_id"]))
    D = np.linalg.norm(pts[:, None, :] - pts[None, :, :], axis=2)
    np.fill_diagonal(D, np.inf)
    for q in range(len(pts)):
        want = list(np.lexsort((np.arange(len(pts)), D[q]))[:k])
        assert [i for _, i in sorted(got[q])] == want


@pytest.fixture
def small_groups(monkeypatch):
    """Cells, groups and blocks of queries of a few rows."""
    from tadkit.operators import metric
    for name, n in (("CELL_ROWS", 5), ("GROUP_ROWS", 16), ("QUERY_ROWS", 25)):
        monkeypatch.setattr(metric, name, n)


def _dbscan_brute(pts, eps, min_samples, D=None):
    n = len(pts)
    D = np.linalg.norm(pts[:, None, :] - pts[None, :, :], axis=2) if D is None else D
    nbrs = [np.where(D[i] <= eps)[0] for i in range(n)]
    core = np.array([len(nb) >= min_samples for nb in nbrs])
    label = -np.ones(n, dtype=int)
    comp = {}
    for i in range(n):                       # components of core points, named by smallest member
        if core[i] and i not in comp:
            stack, members = [i], []
            comp[i] = i
            while stack:
                j = stack.pop()
                members.append(j)
                for m in nbrs[j]:
                    if core[m] and m not in comp:
                        comp[m] = i
                        stack.append(m)
            for j in members:
                comp[j] = min(members)
    for i in range(n):
        if core[i]:
            label[i] = comp[i]
        else:
            cs = [comp[m] for m in nbrs[i] if core[m]]
            label[i] = min(cs) if cs else -1
    ids = sorted(set(label[label >= 0]))
    remap = {v: r for r, v in enumerate(ids)}
    return [remap.get(v, -1) for v in label]


def test_dbscan_vs_brute_force(spark, blobs):
    df, pts = blobs
    got = {r["id"]: r["cluster"] for r in sg.dbscan(df, "id", "x", eps=0.5, min_samples=4).collect()}
    want = _dbscan_brute(pts, 0.5, 4)
    assert [got[i] for i in range(len(pts))] == want
    assert got[120] == -1 and got[121] == -1


def test_isolation_forest_flags_far_points(spark, blobs):
    df, pts = blobs
    out = {r["id"]: r for r in sg.isolation_forest(df, "id", "x", n_trees=60, sample_size=64, contamination=0.02).collect()}
    top2 = sorted(out.values(), key=lambda r: -r["score"])[:2]
    assert {r["id"] for r in top2} == {120, 121}


def test_special_functions_textbook():
    assert st.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-6)
    assert st.chi2_sf(9.487729036781154, 4) == pytest.approx(0.05, abs=1e-6)
    assert st.kolmogorov_sf(1.3580986393225505) == pytest.approx(0.05, abs=1e-4)
    assert st._f_sf(4.102821015130399, 2, 10) == pytest.approx(0.05, abs=1e-6)
    assert st.studentized_range_sf(3.877, 3, 10) == pytest.approx(0.05, abs=2e-3)


def test_lag_forecast_line(spark):
    rows = [("s", i, 2.0 * i + 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "s string, t int, y double")
    f = tm.lag_regression_forecast(df, "s", "t", "y", lags=1, horizon=3).first()["forecast"]
    assert f == pytest.approx([41.0, 43.0, 45.0], rel=1e-9)


def test_tfidf_matches_textbook(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"])], "d int, tokens array<string>")
    w = {(r["d"], r["term"]): r["weight"] for r in tm.tfidf(docs, "d", "tokens").collect()}
    idf = {t: math.log(3 / (1 + df)) + 1 for t, df in {"a": 1, "b": 2, "c": 1}.items()}
    v1 = np.array([2 * idf["a"], idf["b"]])
    assert w[(1, "a")] == pytest.approx(v1[0] / np.linalg.norm(v1))


def test_kruskal_wallis_known(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 5.0), ("b", 6.0)]
    r = st.kruskal_wallis(spark.createDataFrame(rows, "g string, x double"), "g", "x").first()
    assert r["h"] == pytest.approx(3.857142857, rel=1e-6)


def _write_bmp(path, w, h, rgb):
    row_pad = (4 - (w * 3) % 4) % 4
    data = b""
    for y in range(h - 1, -1, -1):
        for x in range(w):
            r, g, b = rgb[y][x]
            data += bytes([b, g, r])
        data += b"\x00" * row_pad
    header = b"BM" + struct.pack("<IHHI", 54 + len(data), 0, 0, 54)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(data), 2835, 2835, 0, 0)
    with open(path, "wb") as f:
        f.write(header + info + data)


def test_image_folder_scan(spark, tmp_path):
    from tadkit.sources.files import pixels, read_labelled_images
    for cls in ("cat", "dog"):
        os.makedirs(tmp_path / cls)
        _write_bmp(str(tmp_path / cls / "a.bmp"), 2, 2, [[(255, 0, 0), (0, 255, 0)], [(0, 0, 255), (9, 9, 9)]])
    df = pixels(read_labelled_images(spark, str(tmp_path)), scale=255.0)
    rows = df.collect()
    assert sorted(r["label"] for r in rows) == ["cat", "dog"]
    assert len(rows[0]["pixels"]) == 12


def test_small_results_and_models_roundtrip(spark, tmp_path):
    import pandas as pd
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from tadkit.sources import tables as tb
    pdf = pd.DataFrame({"x": [0.0, 1.0, 2.0, 3.0], "label": [0.0, 0.0, 1.0, 1.0]})
    df = tb.from_pandas(spark, pdf)
    assert len(tb.to_pandas_capped(df, 10)) == 4
    with pytest.raises(ValueError):
        tb.to_pandas_capped(df, 2)
    m = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression()]).fit(df)
    tb.save_fitted(m, str(tmp_path / "m"))
    back = tb.load_fitted(str(tmp_path / "m"))
    assert back.transform(df).count() == 4


def test_knn_high_dim_exact(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 10, (4, 16))
    pts = np.vstack([c + rng.normal(0, 0.5, (40, 16)) for c in centres])
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(pts)], "id long, x array<double>")
    k = 5
    got = {}
    for r in sg.knn(df, df, "id", "x", k, exclude_self=True).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["ref_id"]))
    D = np.linalg.norm(pts[:, None, :] - pts[None, :, :], axis=2)
    np.fill_diagonal(D, np.inf)
    for q in range(len(pts)):
        assert [i for _, i in sorted(got[q])] == list(np.lexsort((np.arange(len(pts)), D[q]))[:k])


@pytest.mark.parametrize("p", [1.0, 3.0, float("inf")])
def test_knn_minkowski_with_ties(spark, p):
    pts = np.array([[i % 7, i % 5] for i in range(60)], float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pts)], "id long, x array<double>")
    got = {}
    for r in sg.knn(df, df, "id", "x", 6, p=p, exclude_self=True).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["ref_id"]))
    gap = np.abs(pts[:, None] - pts[None])
    D = gap.max(axis=2) if np.isinf(p) else (gap ** p).sum(axis=2) ** (1 / p)
    np.fill_diagonal(D, np.inf)
    for q in range(60):
        assert [i for _, i in sorted(got[q])] == list(np.lexsort((np.arange(60), D[q]))[:6])


def test_smote_balances_between_true_neighbours(spark, small_groups, monkeypatch):
    """Over several groups, and without the training bound of the classifier, each neighbour is one of the true k nearest."""
    from tadkit.operators import features as fe
    monkeypatch.setattr(sg.knn, "__defaults__", (2.0, False, 10, 42))
    pts = RNG.normal(size=(90, 3))
    rows = [(i, v.tolist(), 1.0) for i, v in enumerate(pts)] + [(i, [0.0] * 3, 0.0) for i in range(100, 350)]
    df = spark.createDataFrame(rows, "id long, x array<double>, label double")
    D = np.linalg.norm(pts[:, None] - pts[None], axis=2)
    np.fill_diagonal(D, np.inf)
    made = fe.smote(df, "id", "label", 1.0, "x", k=3).collect()
    assert len(made) == 160 and len({r.id for r in made}) == 160
    times = np.bincount([int(r.id.split("_")[1]) for r in made], minlength=90)
    assert set(times) == {1, 2}
    for r in made:
        q, new = int(r.id.split("_")[1]), np.array(r.x)
        near = np.argsort(D[q])[:3]
        off = [np.linalg.norm(np.cross(new - pts[q], pts[i] - pts[q])) for i in near]
        assert min(off) < 1e-9
    assert sorted(r.id for r in fe.smote(df, "id", "label", 1.0, "x", k=3).collect()) == sorted(r.id for r in made)
    assert fe.smote(df, "id", "label", 0.0, "x", k=3).count() == 0
    assert fe.smote(df.where("id = 1 or id >= 100"), "id", "label", 1.0, "x").count() == 0


@pytest.mark.parametrize("p", [2.0, float("inf")])
def test_exact_neighbours_across_groups(spark, small_groups, p):
    pts = np.array([[i % 7, i % 5] for i in range(60)], float)
    df = spark.createDataFrame([(f"k{i:02d}", v.tolist()) for i, v in enumerate(pts)] + [("none", None)], "id string, x array<double>")
    got = {}
    for r in sg.knn_exact(df, df, "id", "x", 6, p=p, exclude_self=True).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["ref_id"]))
    gap = np.abs(pts[:, None] - pts[None])
    D = gap.max(axis=2) if np.isinf(p) else np.sqrt((gap ** 2).sum(axis=2))
    np.fill_diagonal(D, np.inf)
    for q in range(60):
        assert sorted(got[f"k{q:02d}"]) == [(n, f"k{i:02d}") for n, i in enumerate(np.lexsort((np.arange(60), D[q]))[:6], 1)]
    assert sg.knn_exact(df.limit(0), df, "id", "x", 6).collect() == sg.knn_exact(df, df.limit(0), "id", "x", 6).collect() == []


def test_dbscan_chain_is_one_cluster(spark):
    """A chain longer than any number of rounds, and a dense cell beside it."""
    pts = [(float(i), 0.0) for i in range(150)] + [(400 + 0.001 * i, 0.0) for i in range(60)]
    df = spark.createDataFrame([(i, list(v)) for i, v in enumerate(pts)], "id long, x array<double>")
    for eps in (1.0, 1.5):
        got = {r["id"]: r["cluster"] for r in sg.dbscan(df, "id", "x", eps=eps, min_samples=2).collect()}
        assert {got[i] for i in range(150)} == {0} and {got[i] for i in range(150, 210)} == {1}


def test_dbscan_higher_dimension_and_p(spark):
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(c, 0.4, (30, 4)) for c in (0, 3, 6)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pts)], "id long, x array<double>")
    got = {r["id"]: r["cluster"] for r in sg.dbscan(df, "id", "x", eps=0.9, min_samples=4).collect()}
    assert [got[i] for i in range(90)] == _dbscan_brute(pts, 0.9, 4)


@pytest.mark.parametrize(("eps", "p"), [(0.9, 2.0), (2.5, 1.0), (0.6, float("inf"))])
def test_dbscan_over_many_cells(spark, small_groups, eps, p):
    """Cells cut by hash, groups of cells and copies of one point; all coordinates count."""
    rng = np.random.default_rng(6)
    pts = np.vstack([rng.normal(c, 0.4, (40, 6)) for c in (0, 2, 6)] + [np.full((60, 6), 3.0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pts)], "id long, x array<double>")
    gap = np.abs(pts[:, None] - pts[None])
    D = gap.max(axis=2) if np.isinf(p) else np.sqrt((gap ** 2).sum(axis=2)) if p == 2 else gap.sum(axis=2)
    got = {r["id"]: r["cluster"] for r in sg.dbscan(df, "id", "x", eps=eps, min_samples=4, p=p).collect()}
    assert [got[i] for i in range(len(pts))] == _dbscan_brute(pts, eps, 4, D)


def test_the_index_skips_cells_out_of_reach(spark, monkeypatch):
    """On clustered points few pairs are compared and the rows shipped grow with the points; a search within reach misses none."""
    from pyspark.sql import functions as F
    from tadkit.operators import metric
    from tadkit.operators.metric import build_index, effort, in_radius, meet
    monkeypatch.setattr(metric, "GROUP_ROWS", 200)
    rng = np.random.default_rng(8)
    centres, sent = rng.normal(0, 20, (40, 8)), {}
    for n in (1500, 3000):
        pts = centres[rng.integers(0, 40, n)] + rng.normal(0, 0.5, (n, 8))
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pts)], "tag long, x array<double>")
        index, homes = build_index(df, "x", cells=40)
        left = homes.withColumn("bound", F.lit(1.5))
        sent[n], pairs = effort(index, left)
        assert pairs < 0.1 * n ** 2
    assert sent[3000] <= 2.2 * sent[1500] <= 2.2 * 2 * 1500

    def visit(tags):
        found = []

        def feed(own, x, bound, columns, y, allowed):
            found.append((own, (np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2)) <= bound[:, None]).sum(axis=1)))
        return feed, lambda: [np.concatenate([f[i] for f in found]) if found else np.array([]) for i in (0, 1)]
    got = dict(tuple(r) for r in meet(index, left, homes, in_radius, visit, "a long, n long").groupBy("a").agg(F.sum("n")).collect())
    D = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(axis=2))
    assert [got[i] for i in range(3000)] == (D <= 1.5).sum(axis=1).tolist()


def test_cosine_of_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(tm.cosine("a", "b")).collect()] == [None, 1.0]


def test_varclus_finds_blocks_that_unrotated_components_mix():
    """Correlated blocks: the first component runs through both, so loads on it say nothing of the blocks."""
    sizes, within, between = (4, 3), 0.7, 0.35
    p = sum(sizes)
    block = np.repeat([0, 1], sizes)
    R = np.where(block[:, None] == block[None], within, between)
    np.fill_diagonal(R, 1.0)
    order = np.random.default_rng(1).permutation(p)
    R, block = R[np.ix_(order, order)], block[order]
    halves = st.split_variables(R, list(range(p)))
    assert sorted(map(sorted, halves)) == sorted([np.flatnonzero(block == b).tolist() for b in (0, 1)])
    w, v = np.linalg.eigh(R)
    plain = np.abs(v[:, -2:] * np.sqrt(w[-2:]))
    assert len(set(plain[:, 1] >= plain[:, 0])) == 1             # without rotation all would go to the first
    rotated = st.quartimax(v[:, [-1, -2]] * np.sqrt(w[[-1, -2]]))
    assert (rotated ** 4).sum() >= (plain ** 4).sum() and np.allclose((rotated ** 2).sum(), (plain ** 2).sum())


def test_varclus_of_three_known_groups(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(800, 3)) + 0.5 * rng.normal(size=(800, 1))
    cols = [f"x{i}" for i in range(8)]
    group = [0, 0, 0, 1, 1, 2, 2, 2]
    x = base[:, group] + 0.3 * rng.normal(size=(800, 8))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols))
    got = {r.variable: r for r in st.varclus(df, cols, max_eigen=0.7).collect()}
    found = [got[c].cluster for c in cols]
    assert len(set(found)) == 3 and all((found[i] == found[j]) == (group[i] == group[j]) for i in range(8) for j in range(8))
    assert sum(r.representative for r in got.values()) == 3 and all(r.r2_own > r.r2_next for r in got.values())


def test_discriminant_of_two_classes_in_closed_form(spark):
    from tadkit.operators import models as md
    rng = np.random.default_rng(9)
    a, b = rng.normal(0, 1, (120, 3)) @ np.diag([1, 2, 3]), rng.normal(1, 1, (80, 3)) @ np.diag([1, 2, 3])
    rows = [(0, *map(float, r)) for r in a] + [(1, *map(float, r)) for r in b] + [(1, None, 1.0, 1.0), (None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k int, x0 double, x1 double, x2 double").repartition(5)
    m = md.lda_fit(df, "k", ["x0", "x1", "x2"])
    pooled = ((a - a.mean(0)).T @ (a - a.mean(0)) + (b - b.mean(0)).T @ (b - b.mean(0))) / (len(a) + len(b) - 2)
    way = np.linalg.solve(pooled, b.mean(0) - a.mean(0))
    assert np.allclose(m["coef"][1] - m["coef"][0], way)
    cut = way @ (a.mean(0) + b.mean(0)) / 2 - np.log(len(b) / len(a))
    assert np.isclose(m["intercept"][0] - m["intercept"][1], cut)
    side = m["scalings"][:, 0]
    assert np.isclose(abs(side @ way) / np.linalg.norm(side) / np.linalg.norm(way), 1)


def test_silhouettes_against_all_pairs(spark):
    rng = np.random.default_rng(12)
    pts = np.vstack([rng.normal(c, 1.0, (20, 3)) for c in (0, 2)] + [np.full((1, 3), 9.0)])
    lab = np.repeat([0, 1, 7], [20, 20, 1])
    rows = [(i, int(k), v.tolist()) for i, (k, v) in enumerate(zip(lab, pts))] + [(99, None, [0.0] * 3), (98, 1, None)]
    df = spark.createDataFrame(rows, "id long, c int, x array<double>")
    D = ((pts[:, None] - pts[None]) ** 2).sum(axis=2)
    got = {r.id: r.silhouette for r in sg.silhouettes(df, "id", "x", "c").collect()}
    assert set(got) == set(range(41))
    for i in range(41):
        own = (lab == lab[i]) & (np.arange(41) != i)
        if not own.any():
            assert got[i] == 0
            continue
        a, b = D[i][own].mean(), min(D[i][lab == k].mean() for k in (0, 1, 7) if k != lab[i])
        assert got[i] == pytest.approx((b - a) / max(a, b))
    one = sg.silhouettes(df.where("c = 0"), "id", "x", "c")
    assert {r.silhouette for r in one.collect()} == {0.0}
    s = {r.c: r for r in sg.silhouette_spread(sg.silhouettes(df, "id", "x", "c"), "c").collect()}
    assert s[0].n == 20 and s[0].least == pytest.approx(min(got[i] for i in range(20))) and s[7].median == 0


def test_agreement_of_labellings(spark):
    from math import comb
    rng = np.random.default_rng(13)
    a, b = rng.integers(0, 3, 200), rng.integers(0, 4, 200)
    b = np.where(rng.random(200) < 0.6, a, b)
    df = spark.createDataFrame([(int(x), int(y), 1) for x, y in zip(a, b)] + [(None, 1, 1), (5, 5, 2), (5, 5, 2)], "a int, b int, t int")
    got = {r.t: r for r in sg.label_agreement(df, "a", "b", ["t"]).collect()}
    table = np.array([[((a == i) & (b == j)).sum() for j in range(4)] for i in range(3)])
    pairs = sum(comb(int(n), 2) for n in table.ravel())
    pa, pb = (sum(comb(int(n), 2) for n in table.sum(axis=k)) for k in (1, 0))
    want = (pairs - pa * pb / comb(200, 2)) / ((pa + pb) / 2 - pa * pb / comb(200, 2))
    assert got[1].adjusted_rand == pytest.approx(want) and got[1].n == 200 and got[1].matched_share == pytest.approx(table.max(axis=1).sum() / 200)
    assert got[2].adjusted_rand == 1 and got[2].matched_share == 1
    assert sg.label_agreement(df.where("t = 1"), "a", "b").first().adjusted_rand == pytest.approx(want)
    drift = {(r.t, r.b): (r.n, r.drift) for r in sg.share_drift(df, "b", "t").collect()}
    assert drift[2, 5] == (2, 1.0) and drift[1, 5] == (0, None) and drift[2, 0][0] == 0


def test_rolling_origin_against_refits(spark):
    """Every origin refitted by itself, over all rows behind it and over a window of them."""
    rng = np.random.default_rng(14)
    y = np.cumsum(rng.normal(0, 1, 40)) + 5
    rows = [("a", i, float(v)) for i, v in enumerate(y)] + [("b", i, None if i == 9 else float(i % 5)) for i in range(20)] + [(None, 1, 1.0)]
    df = spark.createDataFrame(rows, "k string, t int, y double")
    for window in (None, 12):
        got = {(r.origin, r.step): r for r in tm.rolling_origin(df, "k", "t", "y", lags=2, horizon=3, min_train=8, window=window).where("k = 'a'").collect()}
        want = {}
        for t in range(40):
            at = [i for i in range(2, t + 1) if window is None or i > t - window]
            if len(at) >= 8:
                beta = np.linalg.lstsq(np.array([[1, y[i - 1], y[i - 2]] for i in at]), y[at], rcond=None)[0]
                h = [y[t], y[t - 1]]
                for step in (1, 2, 3):
                    h.insert(0, beta @ [1, h[0], h[1]])
                    if t + step < 40:
                        want[t, step] = (y[t + step], h[0])
        assert set(got) == set(want)
        assert all(got[k].actual == v[0] and got[k].forecast == pytest.approx(v[1], abs=1e-6) for k, v in want.items())
    b = tm.rolling_origin(df, "k", "t", "y", lags=2, horizon=1, min_train=3).where("k = 'b'").collect()
    assert b and all(r.origin not in (9, 10) and r.target != 9 for r in b)


def test_spaces_survive_a_reload_and_meet_new_categories(spark, tmp_path):
    from tadkit.operators import spaces as sp
    rows = [(i, float(i), float(i % 7), ["x", "y", None][i % 3], int(i % 3 == 0 or i % 5 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c string, y int")
    fitted = sp.fit_spaces(df, ["a", "b"], ["c"], "y", variance=0.99)
    sp.save_spaces(fitted, str(tmp_path / "spaces"))
    back = sp.load_spaces(str(tmp_path / "spaces"))
    new = spark.createDataFrame([(1, 3.0, 1.0, "never seen", 0), (2, 4.0, 2.0, "y", 0), (3, 5.0, 3.0, None, 0)], "id int, a double, b double, c string, y int")
    one, two = ({(r.id, r.space): list(r["values"]) for r in sp.in_spaces(s, new, "id").collect()} for s in (fitted, back))
    assert one == two and {s for _, s in two} == {"raw", "minmax", "standard", "pca", "woe"} and len(two) == 15
    assert two[1, "woe"] == [0.0] and two[1, "raw"] == [3.0, 1.0]
    for at, c in ((2, "y"), (3, None)):
        n, e = sum(r[3] == c for r in rows), sum(r[4] for r in rows if r[3] == c)
        every = sum(r[4] for r in rows)
        assert two[at, "woe"][0] == pytest.approx(math.log((max(n - e, 0.5) / (60 - every)) / (max(e, 0.5) / every)))


def test_model_based_imputation_predicts_the_category(spark):
    from tadkit.operators import quality as qu
    rng = np.random.default_rng(15)
    x = rng.normal(0, 1, 400)
    truth = np.where(x > 0.8, "high", np.where(x < -0.8, "low", "mid"))
    df = spark.createDataFrame([(i, float(v), None if i % 4 == 0 else str(t)) for i, (v, t) in enumerate(zip(x, truth))], "id int, x double, c string")
    got = {r.id: r.c for r in qu.model_impute(df, "c", ["x"], max_iter=100).collect()}
    assert all(got[i] == truth[i] for i in range(400) if i % 4)
    assert np.mean([got[i] == truth[i] for i in range(0, 400, 4)]) > 0.9


@pytest.mark.parametrize("ratio", [0.0, 0.5, 1.0])
def test_hinge_with_elastic_net_against_a_slow_solver(spark, ratio):
    """Objective within 1e-4 of many accelerated steps on a hardly smoothed hinge; noise columns get exact zeros under l1."""
    from tadkit.operators import models as md
    rng = np.random.default_rng(16)
    X = rng.normal(size=(300, 5))
    y = (X[:, 0] - 0.7 * X[:, 1] + 0.3 + 0.5 * rng.normal(size=300) > 0).astype(int)
    cols = [f"x{i}" for i in range(5)]
    df = spark.createDataFrame([(*map(float, r), int(k)) for r, k in zip(X, y)] + [(None, 0.0, 0.0, 0.0, 0.0, 1)], ", ".join(f"{c} double" for c in cols) + ", y int")
    alpha = 0.05
    m = md.hinge_fit(df.repartition(3), "y", cols, alpha, ratio)
    A, s = np.c_[X, np.ones(300)], 2 * y - 1

    def objective(w):
        return np.maximum(1 - s * (A @ w), 0).mean() + alpha * (ratio * np.abs(w[:5]).sum() + (1 - ratio) / 2 * (w[:5] ** 2).sum())
    w = v = np.zeros(6)
    width, t, best = 1e-4, 1.0, np.inf
    rate = 1 / (np.linalg.eigvalsh(A.T @ A / 300)[-1] / width + alpha)
    for _ in range(40000):
        g = A.T @ (-s * np.clip((1 - s * (A @ v)) / width, 0, 1)) / 300
        g[:5] += alpha * (1 - ratio) * v[:5]
        new = v - rate * g
        new[:5] = np.sign(new[:5]) * np.maximum(np.abs(new[:5]) - rate * alpha * ratio, 0)
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        v = new + (old - 1) / t * (new - w)
        w = new
        best = min(best, objective(w))
    assert objective(np.append(m["coef"], m["intercept"])) == pytest.approx(m["objective"])
    assert abs(m["objective"] - best) < 1e-4 and m["passes"] <= 200
    if ratio == 1.0:
        assert (m["coef"] == 0).sum() >= 2 and m["coef"][0] > 0 > m["coef"][1]
    hits = md.hinge_predict(df.dropna(), m).selectExpr("avg(double(prediction = y))").first()[0]
    assert hits > 0.8


def test_kmeans_rows_go_to_the_nearest_centre(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F
    rng = np.random.default_rng(17)
    pts = rng.normal(size=(200, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pts)], "id int, x array<double>").withColumn("features", array_to_vector(F.col("x")))
    m = sg.kmeans(df, "features", 5)
    centres = np.array(m.clusterCenters())
    want = ((pts[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    got = {r.id: r.cluster for r in m.transform(df).collect()}
    assert [got[i] for i in range(200)] == want.tolist()
    for k in range(5):                                   # centres are the means of their rows
        assert np.allclose(centres[k], pts[want == k].mean(axis=0), atol=0.05)
    again = sg.recluster_largest(m.transform(df), "features", "cluster", 2).collect()
    largest = str(np.bincount(want).argmax())
    assert {r.label for r in again if r.cluster == int(largest)} == {f"{largest}.0", f"{largest}.1"}
    assert all(r.label == str(r.cluster) for r in again if r.cluster != int(largest))


def test_components_reach_the_wanted_variance(spark):
    from tadkit.operators import features as fe
    rng = np.random.default_rng(18)
    x = rng.normal(size=(150, 5)) @ rng.normal(size=(5, 5))
    cols = [f"x{i}" for i in range(5)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, " + ", ".join(f"{c} double" for c in cols))
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    share = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    share /= share.sum()
    m = fe.pca_fit(df, cols, variance=0.8)
    k = int(np.searchsorted(np.cumsum(share), 0.8) + 1)
    assert np.allclose(fe.pca_explained(m), share[:k])
    got = np.array([[r[f"cp_{j + 1}"] for j in range(k)] for r in fe.pca_transform(m, df, keep=["id"]).orderBy("id").collect()])
    assert got.shape == (150, k) and np.allclose(np.var(got, axis=0, ddof=1), share[:k] * 5)


def test_baskets_are_offered_the_items_nearest_to_their_mean(spark):
    rng = np.random.default_rng(19)
    items = {f"i{k:02d}": rng.normal(size=6) for k in range(40)}
    baskets = {b: [f"i{k:02d}" for k in rng.integers(0, 45, 5)] for b in range(25)}          # items from 40 on are unknown
    vec = spark.createDataFrame([(k, v.tolist()) for k, v in items.items()], "item string, vec array<double>")
    df = spark.createDataFrame([(b, k) for b, k in baskets.items()], "b int, items array<string>")
    means = {r.b: np.array(r.mean_vec) for r in tm.basket_mean_vector(df, "b", "items", vec).collect()}
    for b, names in baskets.items():
        known = [items[n] for n in names if n in items]
        assert (b in means) == bool(known) and (not known or np.allclose(means[b], np.mean(known, axis=0)))
    q = spark.createDataFrame([(str(b), v.tolist()) for b, v in means.items()], "id string, v array<double>")
    got = {}
    for r in sg.knn_exact(q, vec.toDF("id", "v"), "id", "v", 4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.ref_id))
    names, m = sorted(items), np.array([items[n] for n in sorted(items)])
    for b, v in means.items():
        order = np.argsort(np.linalg.norm(m - v, axis=1))[:4]
        assert [n for _, n in sorted(got[str(b)])] == [names[i] for i in order]


def test_best_terms_against_a_dense_table(spark):
    rng = np.random.default_rng(20)
    words = [f"w{i}" for i in range(12)]
    docs = [[words[k] for k in rng.integers(0, 12 if y else 9, 15)] for y in (rng.random(60) < 0.4)]
    label = rng.integers(0, 3, 60)
    df = spark.createDataFrame([(d, int(y)) for d, y in zip(docs, label)] + [(["w0"], None), (None, 1), ([], 2)], "t array<string>, y int")
    counts = np.array([[d.count(w) for w in words] for d in docs] + [[0] * 12] * 2, float)
    y = np.append(label, [1, 2])
    f = []
    for j in range(12):
        groups = [counts[y == k, j] for k in range(3)]
        between = sum(len(g) * (g.mean() - counts[:, j].mean()) ** 2 for g in groups) / 2
        f.append(between / (sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(y) - 3)))
    got = [(r.term, r.f) for r in tm.k_best_terms(df, "t", "y", 5).collect()]
    want = sorted(zip(words, f), key=lambda t: (-t[1], t[0]))[:5]
    assert [t for t, _ in got] == [t for t, _ in want] and np.allclose([v for _, v in got], [v for _, v in want])


@pytest.mark.parametrize("p", [1.0, 2.0, 3.0, np.inf])
def test_knn_of_tied_and_odd_references(p):
    """The rough product changes nothing: ties, own rows, k beyond the references, values that are no numbers."""
    rng = np.random.default_rng(3)
    ref = np.concatenate([rng.normal(size=(200, 6)).round(1)] * 3)
    for odd in (False, True):
        ref[7, 2] = np.nan if odd else 0.0
        for k in (1, 5, 700):
            got = sg._k_nearest(range(60), ref[:60], list(range(600)), ref, k, p, True)
            for own in (0, 7, 59):
                gap = np.abs(ref - ref[own])
                d = np.sqrt((gap * gap).sum(axis=1)) if p == 2 else gap.max(axis=1) if np.isinf(p) else (gap ** p).sum(axis=1) ** (1 / p)
                want = [i for i in np.lexsort((np.arange(600), d)) if i != own and not np.isnan(d[i])][:k]
                rows = got[got["query_id"] == own]
                assert rows["ref_id"].tolist() == want or np.isnan(d).any() and k == 700
                assert rows["dist"].tolist() == list(d[rows["ref_id"]])


def test_knn_measures_few_references_exactly():
    """No query makes its differences to all references: a product of matrices ranks them."""
    import tracemalloc
    rng = np.random.default_rng(4)
    ref, q = rng.normal(size=(20_000, 64)), rng.normal(size=(8, 64))
    tracemalloc.start()
    sg._k_nearest(range(8), q, list(range(20_000)), ref, 39, 2.0, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * ref.nbytes                  # 3.1 times before, 1.1 now


@pytest.mark.parametrize("p", [1.0, 2.0, np.inf])
def test_distances_hold_one_matrix(p):
    import tracemalloc
    from tadkit.operators.metric import distances
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(1500, 8)), rng.normal(size=(1100, 8))
    tracemalloc.start()
    d = distances(a, b, p)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * d.nbytes                  # three times that before
    gap = np.abs(a[1400] - b[1090])
    assert d[1400, 1090] == pytest.approx(gap.sum() if p == 1 else gap.max() if np.isinf(p) else np.sqrt((gap * gap).sum()))


def test_dbscan_of_copies(spark):
    """Copies of one vector are one node of the links, however many there are."""
    pts = [[0.0, 0.0]] * 400 + [[0.1, 0.0]] * 3 + [[5.0, 5.0]] * 2 + [[0.0, 0.6]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(pts)], "id long, x array<double>")
    got = {r["id"]: r["cluster"] for r in sg.dbscan(df, "id", "x", eps=0.6, min_samples=4).collect()}
    assert [got[i] for i in range(len(pts))] == [0] * 403 + [-1] * 2 + [0]


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_group_frames_share_batches(spark):
    """Every group is seen whole and as ``applyInPandas`` shows it, also a null key, a group longer than a batch
    and groups beside one with nulls; groups have no batch of their own."""
    import pandas as pd
    from tadkit.functions import udf as ud
    rows = [(i % 300, 2**60 + i, float(i)) for i in range(900)] + [(None, 5, None), (None, None, 1.0), (7, None, 2.0)] + [(1000, i, 0.0) for i in range(700)]
    df = spark.createDataFrame(rows, "k long, v long, x double").repartition(3)

    def seen(g):
        return pd.DataFrame({"k": g["k"][:1], "n": [len(g)], "top": g["v"].max(), "kinds": ["".join(sorted(str(t) for t in g.dtypes))], "at": [int(g.index[-1])]})
    schema = "k long, n long, top long, kinds string, at long"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "128")
    try:
        got, want = ud.per_group_frame(df, ["k"], seen, schema), df.groupBy("k").applyInPandas(seen, schema)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "FlatMapGroupsInPandas" not in _plan(got)


def test_listed_words_are_looked_up_once_a_row(spark):
    from tadkit.functions import text as tx
    rows = [(1, ["a", "b", "a", "c"]), (2, []), (3, None), (None, ["a", "d"]), (4, ["b"]), (5, ["x", "b", "y"]), (5, ["z", "x"])]
    df = spark.createDataFrame(rows, "id long, t array<string>")
    words = spark.createDataFrame([("b",), ("b",), ("d",), (None,)], "word string")
    out = tx.drop_listed_words(df, "id", "t", words)
    got = sorted((r["id"] or 0, r["tokens_kept"]) for r in out.collect())
    assert got == [(0, []), (1, ["a", "a", "c"]), (2, []), (3, []), (4, []), (5, ["x", "z", "x", "y"]), (5, ["x", "z", "x", "y"])]
    assert "posexplode" not in _plan(out)


def test_coherence_reads_documents_once(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a", "c"]), (3, ["b", "a"]), (3, ["q"]), (4, None)], "id long, t array<string>")
    topics = spark.createDataFrame([(0, 0, "a"), (0, 1, "b"), (1, 0, "c"), (1, 1, "b")], "topic int, rank int, term string")
    out = tm.topic_coherence(df, "id", "t", topics)
    got = {r["topic"]: r["umass"] for r in out.collect()}
    assert got[0] == pytest.approx(math.log(3 / 3)) and got[1] == pytest.approx(math.log(1 / 1))
    assert any("presence-" in f for f in out.inputFiles())


def test_best_terms_shuffle_sums_alone(spark):
    rows = [("x", ["a", "a", "b"]), ("x", ["a", None]), ("y", ["b"]), ("y", None), ("y", []), (None, ["a"]), ("x", ["c"] * 5)] * 300
    out = tm.k_best_terms(spark.createDataFrame(rows, "y string, t array<string>").repartition(3), "t", "y", 9)
    got = {r["term"]: r["df"] for r in out.collect()}
    assert got == {"a": 600, "b": 600, "c": 300}
    assert "_d#" not in _plan(out)


def test_item_vectors_are_trained_block_by_block(spark, monkeypatch):
    """Items that share baskets come to lie near each other, in blocks of few baskets whose vectors are averaged; no item is lost."""
    monkeypatch.setattr(tm, "_BLOCK", 2000)
    rng = np.random.default_rng(3)
    rows = [([f"{g}{k}" for k in rng.integers(0, 8, 6)],) for g in "ab" for _ in range(600)] + [(["a0"],), ([],), (["once"],), ([None, "b1"],)]
    df = spark.createDataFrame(rows, "items array<string>").repartition(3)
    got = {r["item"]: np.array(r.vec) for r in tm.item_vectors(df, size=8, max_iter=30, partitions=2).collect()}
    assert set(got) == {None, "once"} | {f"{g}{k}" for g in "ab" for k in range(8)} and all(len(v) == 8 for v in got.values())
    unit = {k: v / np.linalg.norm(v) for k, v in got.items()}
    near = lambda g, h: np.mean([unit[f"{g}{i}"] @ unit[f"{h}{j}"] for i in range(8) for j in range(8) if (g, i) != (h, j)])
    assert min(near("a", "a"), near("b", "b")) > near("a", "b") + 0.3
    few = {r["item"] for r in tm.item_vectors(df, size=8, min_count=3, partitions=2).collect()}
    assert few == {f"{g}{k}" for g in "ab" for k in range(8)}


def test_basket_means_of_vectors_of_unlike_length(spark):
    vec = spark.createDataFrame([("x", [1.0, 2.0]), ("y", [3.0])], "item string, vec array<double>")
    df = spark.createDataFrame([(1, ["x", "y"]), (2, ["y", "z"]), (3, ["z"])], "b int, items array<string>")
    assert {r.b: r.mean_vec for r in tm.basket_mean_vector(df, "b", "items", vec).collect()} == {1: [2.0, 2.0], 2: [3.0]}


def test_tfidf_of_a_vocabulary_equals_counting(spark):
    """Words and word pairs of rows with repeats, nulls, tokens that hold spaces, and empty ones; counted batch by batch."""
    import collections
    rows = [(1, ["a", "b", "a", "b"]), (2, ["a b", "c", None, "c"]), (3, []), (4, None), (5, ["c"]), (6, [None]), (7, ["b", "a"]), (8, ["a", "b", "d", "d"])]
    grams = {i: [w for w in t or [] if w is not None] + [" ".join(w for w in p if w is not None) for p in zip(t or [], (t or [])[1:])] for i, t in rows}
    cf = collections.Counter(g for v in grams.values() for g in v)
    df = collections.Counter(g for v in grams.values() for g in set(v))
    words = sorted((w for w in df if df[w] >= 2), key=lambda w: (-cf[w], w))[:4]
    want = {}
    for i, v in grams.items():
        w = {g: v.count(g) * (np.log((1 + len(rows)) / (1 + df[g])) + 1) for g in set(v) & set(words)}
        want |= {(i, g): x / np.sqrt(sum(y * y for y in w.values())) for g, x in w.items()}
    docs = spark.createDataFrame(rows, "d int, tokens array<string>").repartition(3)
    got = {(r.d, r.term): r.weight for r in tm.tfidf(docs, "d", "tokens", 1, 2, min_df=2, max_features=4).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    t = pa.array([["a", "b", "c"], ["c", "a", "b", "c"]])
    terms, row, term, tf = tm._gram_counts(t, 3, 3)
    assert sorted(zip(row.tolist(), terms.take(pa.array(term)).to_pylist(), tf.tolist())) == [(0, "a b c", 1), (1, "a b c", 1), (1, "c a b", 1)]


def test_knn_searches_all_references(spark, small_groups, monkeypatch):
    """More references than a task holds: none is left out; rows of one key are queries of their own, also without a key."""
    from tadkit.operators import metric
    monkeypatch.setattr(metric, "NEAR_ROWS", 3)
    rng = np.random.default_rng(21)
    pts = np.concatenate([rng.normal(size=(70, 3)).round(1)] * 2)
    refs = spark.createDataFrame([(f"k{i % 130:03d}", v.tolist()) for i, v in enumerate(pts)] + [(None, [0.0] * 3), ("none", None)], "id string, x array<double>")
    rows = [("k003", pts[3]), ("k003", pts[50]), ("k003", pts[50]), (None, pts[9])]
    q = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "id string, x array<double>")
    for own in (False, True):
        got = sg.knn(q, refs, "id", "x", 12, exclude_self=own, held_rows=20).collect()
        want = []
        for key, v in rows:
            d = [(np.sqrt(((v - w) ** 2).sum()), f"k{i % 130:03d}") for i, w in enumerate(pts)]
            want += [(key or "", i, r, round(float(s), 9)) for i, (s, r) in enumerate(sorted(t for t in d if not (own and t[1] == key))[:12], 1)]
        assert sorted((r.query_id or "", r["rank"], r.ref_id, round(r.dist, 9)) for r in got) == sorted(want)
    held = sg.knn(q, refs, "id", "x", 12, held_rows=1000).collect()
    assert sorted((r.query_id or "", r["rank"], r.ref_id) for r in held) == sorted((r.query_id or "", r["rank"], r.ref_id) for r in sg.knn(q, refs, "id", "x", 12, held_rows=20).collect())


def test_knn_queries_leave_no_reference_out(spark, monkeypatch):
    """The nearest of every reference, also beyond what a task holds."""
    import inspect
    from tadkit.plans import q_models
    assert "limit(" not in inspect.getsource(sg.knn) and "max_train_rows" not in inspect.signature(sg.knn).parameters
    small, seen = "/root/testdata/sf0.001", {}
    full = sg.knn
    for name, held in (("held", 10_000), ("searched", 50)):
        monkeypatch.setattr(q_models, "knn", lambda *a, held=held: full(*a, held_rows=held))
        seen[name] = [sorted(map(tuple, f(spark, small).collect())) for f in (q_models.m12_knn, q_models.m12_knn_reg)]
    assert seen["held"] == seen["searched"]


@pytest.mark.parametrize("p", [1.0, 2.0, 3.0, np.inf])
@pytest.mark.parametrize("shift", [0.0, 1e4])
def test_pairs_within_are_those_of_the_distances(p, shift):
    """The product in single precision leaves none out and adds none, also on ties and far from the origin."""
    from tadkit.operators.metric import _pairs, distances, within
    rng = np.random.default_rng(22)
    a, b = rng.normal(size=(60, 8)).round(1) + shift, rng.normal(size=(90, 8)).round(1) + shift
    b[:20] = a[:20]
    i, j = (v.ravel() for v in np.indices((60, 90)))
    d = _pairs(a, b, i, j, p).reshape(60, 90) if p == 2 else distances(a, b, p)
    for eps in (0.0, *np.quantile(d, [0.01, 0.1, 0.5, 1.0])):
        near = np.zeros(d.shape, bool)
        near[within(a, b, np.full(60, eps), p)] = True
        assert (near == (d <= eps)).all()
        quick = within(a, b, np.full(60, eps), p, quick=True)
        assert near[quick].all()
    b[3, 2] = np.nan
    near = np.zeros(d.shape, bool)
    near[within(a, b, np.full(60, 2.0), p)] = True
    assert not near[:, 3].any() and (near[:, 4:] == (d[:, 4:] <= 2.0)).all()


def test_few_pairs_are_compared_in_dense_points(monkeypatch):
    """Who has enough neighbours looks for no more, and points known to be connected are not compared."""
    from tadkit.operators import metric
    seen, within = [], metric.within

    def counted(a, b, *rest):
        seen.append(len(a) * len(b))
        return within(a, b, *rest)
    monkeypatch.setattr(sg, "within", counted)
    monkeypatch.setattr(metric, "TILE_ROWS", 50)
    y = np.random.default_rng(23).random((1000, 3))
    for visit in (sg._count_to(4, 2.0), sg._linked(2.0)):
        seen.clear()
        feed, close = visit(np.arange(1000))
        for at in range(0, 1000, 100):
            feed(np.arange(at, at + 100), y[at:at + 100], np.full(100, 0.5), np.arange(1000), y, None)
        got = close()
        assert sum(seen) < 0.2 * 1000 ** 2                  # all of them before
    assert set(got[1].tolist()) == {0} and len(got[0]) == 999


@pytest.mark.parametrize(("eps", "p"), [(0.9, 2.0), (2.5, 1.0), (0.6, float("inf"))])
def test_dbscan_in_stages(spark, small_groups, monkeypatch, eps, p):
    """Nearest cells first, then the rest: the same clusters as by all pairs."""
    from tadkit.operators import metric
    for name, n in (("NEAR_ROWS", 4), ("LEAST_QUERIES", 20), ("TILE_ROWS", 7)):
        monkeypatch.setattr(metric, name, n)
    rng = np.random.default_rng(24)
    pts = np.vstack([rng.normal(c, 0.5, (50, 6)) for c in (0, 1.2, 6)] + [np.full((20, 6), 3.0), rng.normal(0, 5, (20, 6))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pts)], "id long, x array<double>")
    gap = np.abs(pts[:, None] - pts[None])
    D = gap.max(axis=2) if np.isinf(p) else np.sqrt((gap ** 2).sum(axis=2)) if p == 2 else gap.sum(axis=2)
    got = {r["id"]: r["cluster"] for r in sg.dbscan(df, "id", "x", eps=eps, min_samples=4, p=p).collect()}
    assert [got[i] for i in range(len(pts))] == _dbscan_brute(pts, eps, 4, D)


@pytest.mark.parametrize("p", [1.0, 2.0])
def test_nearest_in_stages(spark, small_groups, monkeypatch, p):
    """The bound of the first stage and the bound that falls leave none of the nearest out."""
    from tadkit.operators import metric
    for name, n in (("NEAR_ROWS", 3), ("LEAST_QUERIES", 20), ("TILE_ROWS", 7)):
        monkeypatch.setattr(metric, name, n)
    pts = np.random.default_rng(25).normal(size=(120, 5)).round(1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pts)], "id long, x array<double>")
    gap = np.abs(pts[:, None] - pts[None])
    D = np.sqrt((gap ** 2).sum(axis=2)) if p == 2 else gap.sum(axis=2)
    np.fill_diagonal(D, np.inf)
    got = {}
    for r in sg.knn_exact(df, df, "id", "x", 5, p=p, exclude_self=True).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["ref_id"], r["dist"]))
    for q in range(120):
        assert np.allclose([d for _, _, d in sorted(got[q])], np.sort(D[q])[:5])
        assert len({i for _, i, _ in got[q]}) == 5 and q not in {i for _, i, _ in got[q]}


def test_groups_are_dealt_to_all_partitions(spark):
    from pyspark.sql import functions as F
    from tadkit.operators.metric import _slots
    rows = spark.createDataFrame([(v,) for v in _slots(24, 12)], "s int").select(F.pmod(F.hash("s"), F.lit(12)).alias("p")).groupBy("p").count().collect()
    assert [r["count"] for r in rows] == [2] * 12
