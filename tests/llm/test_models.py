"""Quality, toxicity and vector search: held-out accuracy, recall, edge cases."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tadkit.llm.ann import balanced_parts, best_of_block, nearest, neighbour_graph
from tadkit.llm.quality import AttentionModel, FEATURES, drop_low_quality, passages, quality_scores, score_quality
from tadkit.llm.toxicity import fit_ordinal, toxicity

MID = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, score string"
EDGE = [(1, None, "k"), (2, "", None), (3, " \n ", "x"), (4, "word " * 50_000, "y"), (None, "plain text here", "z"), (5, "same words", "a"), (5, "same words", "a")]


def labelled(spark, path, n):
    d = spark.read.parquet(f"{path}/documents.parquet")
    return d, spark.read.parquet(f"{path}/labels.parquet"), n


def test_quality_on_held_out_rows(spark):
    d, labels, _ = labelled(spark, MID, 0)
    got = {r.doc_id: r for r in quality_scores(d, labels).collect()}
    assert len(got) == d.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())
    test = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([g.predicted == q for g, q in test]) > 0.97
    assert all(g.predicted == (g.score >= 0.5) and 0 <= g.score <= 1 for g, _ in test)


def test_quality_ignores_held_out_labels_and_other_columns(spark):
    d, labels, _ = labelled(spark, SMALL, 0)
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality", "toxic")
    other = d.selectExpr("doc_id", "text", "'q' as lang", "'s' as source", "1 as label")
    a = sorted((r.doc_id, r.score) for r in quality_scores(d, labels).collect())
    b = sorted((r.doc_id, r.score) for r in quality_scores(other, turned).collect())
    assert [x[1] for x in a] == pytest.approx([x[1] for x in b])


def test_quality_edge_cases(spark):
    d, labels, _ = labelled(spark, SMALL, 0)
    e = spark.createDataFrame(EDGE, DOC)
    every = d.select("doc_id", "text").where("doc_id > 10").unionByName(e.select("doc_id", "text"))
    got = quality_scores(every, labels).collect()
    assert len(got) == every.count() and all(0 <= r.score <= 1 for r in got)
    empty = [r.score for r in got if r.doc_id in (1, 2, 3)]
    assert len(empty) == 3 and len(set(empty)) == 1
    assert quality_scores(d.limit(0), labels).collect() == []
    assert {r.score for r in quality_scores(d, labels.limit(0)).collect()} == {0.5}
    assert drop_low_quality(e, labels.limit(0)).columns == e.columns
    assert [r.score for r in score_quality(e, 0.25).select("score").distinct().collect()] == [0.25]


def test_a_column_named_score_is_left_alone(spark):
    d = spark.createDataFrame([(1, "some text", 42.0, 0.1), (2, None, 7.0, 0.2)], "doc_id long, text string, score double, _quality_score double")
    got = drop_low_quality(d, spark.createDataFrame([], "doc_id long, quality int"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "some text", 42.0, 0.1), (2, None, 7.0, 0.2)]


def test_attention_forward_in_plain_python():
    """The score of a bag, passage by passage, without the implementation's arrays."""
    rng = np.random.default_rng(2)
    m = AttentionModel(rng.normal(size=FEATURES), rng.uniform(0.5, 2, FEATURES), 5, 3, 1)
    w, b, v, u, g, c, d = m.p
    bags = [rng.normal(size=(n, FEATURES)) * 3 for n in (1, 4, 2)]
    got = m.scores(np.concatenate(bags), np.array([1, 4, 2]))
    for bag, score in zip(bags, got):
        code, pull = [], []
        for x in bag:
            h = [math.tanh(sum(max(-8, min(8, (x[i] - m.mean[i]) / m.scale[i])) * w[i][j] for i in range(FEATURES)) + b[j]) for j in range(5)]
            t = [math.tanh(sum(h[j] * v[j][k] for j in range(5))) for k in range(3)]
            s = [1 / (1 + math.exp(-sum(h[j] * u[j][k] for j in range(5)))) for k in range(3)]
            code.append(h)
            pull.append(math.exp(sum(t[k] * s[k] * g[k] for k in range(3))))
        z = [sum(p * h[j] for p, h in zip(pull, code)) / sum(pull) for j in range(5)]
        assert score == pytest.approx(1 / (1 + math.exp(-sum(z[j] * c[j] for j in range(5)) - d[0])))


def test_rare_toxic_rows_are_found(spark):
    """Twenty toxic rows among thousands: below the share of words that the plain penalty would let live."""
    rng = np.random.default_rng(4)
    words = [f"{a}{b}an" for a in "bdfgklmnprst" for b in ("ol", "im", "ur", "eb")]
    rows = [(i, " ".join(rng.choice(words, 12)) + (" vilword nastyterm" if i % 450 == 3 else "")) for i in range(9000)]
    labels = spark.createDataFrame([(i, 0, int(i % 450 == 3)) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.toxic for r in toxicity(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}
    assert {i for i, t in got.items() if t} == {i for i, _ in rows if i % 450 == 3}


def test_attention_gradient():
    """The gradient agrees with differences of the loss."""
    rng = np.random.default_rng(0)
    m = AttentionModel(np.zeros(FEATURES), np.ones(FEATURES), 5, 4, 1)
    n, y, w = np.array([3, 1, 4]), np.array([1.0, 0.0, 1.0]), np.ones(3)
    x = rng.standard_normal((8, FEATURES))

    def loss():
        s = m.scores(x, n)
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).sum()
    for p, g in zip(m.p, m.gradient(x, n, y, w)):
        at = tuple(rng.integers(0, k) for k in p.shape)
        p[at] += 1e-5
        up = loss()
        p[at] -= 2e-5
        down = loss()
        p[at] += 1e-5
        assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_passages_do_not_depend_on_neighbours():
    texts = ["One two. THREE!! four | five", "", "x " * 300, None, "é è 12 12 12"]
    together = np.concatenate([rows for _, rows, _ in passages(pa.array(texts, pa.string()))])
    alone = np.concatenate([rows for t in texts for _, rows, _ in passages(pa.array([t], pa.string()))])
    assert np.allclose(together, alone)


def test_toxicity(spark):
    d, labels, _ = labelled(spark, "/root/testdata/sf0.1", 0)
    # Half of the labels train, the other half test.
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1 and toxic is not null")
    got = {r.doc_id: r for r in toxicity(d, train).collect()}
    assert len(got) == d.count()
    y = np.array([r.toxic for r in test.collect()])
    p = np.array([got[r.doc_id].toxic for r in test.collect()])
    assert (p & (y == 0)).sum() <= 0.01 * (y == 0).sum() and (p & (y == 1)).sum() >= 0.75 * (y == 1).sum()
    toxic = [r for r in got.values() if r.toxic]
    assert {r.grade for r in toxic} >= {1, 2} and all(0 <= r.severity <= 2 for r in got.values())


def test_toxicity_edge_cases(spark):
    d, labels, _ = labelled(spark, SMALL, 0)
    e = spark.createDataFrame([(a, b, c) for a, b, c in EDGE], "doc_id long, text string, severity string")
    every = d.select("doc_id", "text").where("doc_id > 10").unionByName(e.select("doc_id", "text"))
    got = toxicity(every, labels).collect()
    assert len(got) == every.count()
    assert len({r.severity for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity(d.limit(0), labels).collect() == []
    assert not any(r.toxic or r.severity > 1e-6 for r in toxicity(d, labels.limit(0)).collect())


def test_ordinal_model_shares_weights_over_thresholds():
    rng = np.random.default_rng(2)
    n = 3000
    x = rng.random((n, 6)) < 0.3
    margin = x @ np.array([3.0, 2.0, 0, 0, 0, 0]) - 1.5 + rng.logistic(size=n)
    grade = (margin > 0).astype(int) + (margin > 2)
    row, feature = np.nonzero(x)
    m = fit_ordinal(row, feature, grade)
    w = dict(zip(m.words.tolist(), m.weights.tolist()))
    assert m.thresholds[1] > m.thresholds[0] and w[0] == pytest.approx(3, abs=0.6) and w[1] == pytest.approx(2, abs=0.6)
    assert all(abs(w.get(k, 0)) < 0.4 for k in range(2, 6))


def brute(rows, k):
    ok = {}
    for i, v in sorted(((i, v) for i, v in rows if i is not None and v is not None), key=lambda r: (r[0], r[1]) if None not in r[1] else (r[0], [])):
        if None not in v and np.isfinite(v).all() and any(v):
            ok.setdefault(i, np.array(v, np.float64))
    out = set()
    for i, q in ok.items():
        if i % 20 == 0:
            near = sorted(((-(q * c).sum(), j) for j, c in ok.items() if j != i))[:k]
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(near, 1)}
    return out


def test_nearest_recall(spark):
    d = spark.read.parquet(f"{MID}/embeddings.parquet")
    got = nearest(d).collect()
    want = {(q, v) for q, _, v, _ in brute([(r.vec_id, r.embedding) for r in d.collect()], 20)}
    found = {(r.query_id, r.vec_id) for r in got}
    assert len(found & want) >= 0.9 * len(want) and len(found) == len(want)


def test_nearest_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, [1.0, None]), (6, [1.0, 0.0]), (7, [1.0, 0.0]),
            (20, [1.0, 0.0]), (9, [-1.0, 2.0]), (9, [-1.0, 2.0]), (None, [1.0, 1.0]), (40, [0.5, 0.25])]
    d = spark.createDataFrame([(*r, "a") for r in rows], "vec_id long, embedding array<double>, part string")
    assert {tuple(r) for r in nearest(d).collect()} == brute(rows, 20)
    assert {tuple(r) for r in nearest(d, k=2).collect()} == brute(rows, 2)
    assert nearest(d.limit(0)).collect() == []


def test_block_search_with_thousands_of_ties():
    rng = np.random.default_rng(0)
    c = np.repeat(rng.integers(-2, 3, (40, 4)).astype(float), 50, axis=0)
    ids = rng.permutation(2000)
    q_ids, q = ids[:30], c[:30]
    a, b, s = best_of_block(q_ids, q, ids, c, 20)
    for i, own in enumerate(q_ids):
        want = sorted((-(q[i] * v).sum(), j) for v, j in zip(c, ids) if j != own)[:20]
        assert [(-x, j) for x, j in want] == [(x, j) for o, j, x in zip(a, b, s) if o == own]


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((8, 16)) * 3
    x = centres[np.arange(800) % 8] + rng.standard_normal((800, 16)) * 0.3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = neighbour_graph(x, 10)
    part = balanced_parts(graph, 3, rng)
    sizes = np.bincount(part)
    assert sizes.max() - sizes.min() <= 1 and (part[graph] == part[:, None]).mean() > 0.8
