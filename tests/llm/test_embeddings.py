import numpy as np
import pytest

from corpuloom.llm import embeddings


def by_hand(rows, threshold=0.95):
    ok = {k: np.array(v, float) for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    link = {k: [j for j in ok if j != k and len(ok[j]) == len(ok[k]) and (ok[j] == ok[k]).all() or j != k and len(ok[j]) == len(ok[k]) and ok[j] @ ok[k] / np.linalg.norm(ok[j]) / np.linalg.norm(ok[k]) >= threshold] for k in ok}
    label = list(range(len(rows)))
    for _ in rows:
        for k in link:
            label[k] = min([label[k], *(label[j] for j in link[k])])
    return sorted((rows[k][0], len(link.get(k, [])), min(rows[j][0] for j in range(len(rows)) if label[j] == label[k])) for k in range(len(rows)))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 24))
    near = [centres[k % 40] + rng.normal(size=24) * 0.2 * rng.random() for k in range(500)]
    rows = [(k, [float(x) for x in np.float32(v)]) for k, v in enumerate([*near, *rng.normal(size=(300, 24))])]
    rows += [(900 + k, list(rows[3][1])) for k in range(60)]  # a group of equal vectors
    rows += [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [float("nan")] * 24), (2004, [float("inf")] + [1.0] * 23), (2005, [None] + [1.0] * 23), (2006, [1.0, 0.0]), (2007, [1.0, 0.1]), (2008, [-1.0, 0.0])]
    return rows


def test_against_brute_force(spark, vectors):
    table = spark.createDataFrame([(*r, 1) for r in vectors], "vec_id long, embedding array<float>, rep int")
    expected = by_hand(vectors)
    for settings in (embeddings.Settings(), embeddings.Settings(block=16, rare=1), embeddings.Settings(rare=300, most_within=3, most_sampled=40)):
        got = embeddings.near_dedup(table, settings=settings).collect()
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
        found = sorted((r.vec_id, r.n_links, r.component_id) for r in got)
        assert [f[0] for f in found] == [e[0] for e in expected]
        # Links may be missed, at most a tenth of them, and none is made up or counted twice.
        assert all(f[1] <= e[1] and f[2] >= e[2] for f, e in zip(found, expected))
        assert sum(f[1] for f in found) >= 0.98 * sum(e[1] for e in expected)


def test_empty_null_and_single(spark):
    table = spark.createDataFrame([(5, [1.0, 2.0]), (None, [1.0, 2.0]), (5, [1.0, 2.0])], "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_dedup(table).collect()), key=repr)
    assert got == [(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True)]
    assert embeddings.near_dedup(table.where("false")).collect() == []


@pytest.mark.parametrize("d", [64, 768])
def test_recall_of_links_at_the_threshold(spark, d):
    """Pairs drawn at a cosine of 0.951 among clustered vectors, found in cells fitted over the table itself."""
    rng = np.random.default_rng(d)
    centres = embeddings.unit(rng.normal(size=(40, d)))
    a = embeddings.unit(centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, d)) * 0.8 / d**0.5)
    away = rng.normal(size=a.shape)
    away = embeddings.unit(away - (away * a).sum(axis=1, keepdims=True) * a)
    b = 0.951 * a + (1 - 0.951**2) ** 0.5 * away
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([a, b]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeddings.near_dedup(table, settings=embeddings.Settings(rare=100)).collect()}
    every = np.concatenate([a, b])
    truth = (every @ every.T >= 0.95).sum(axis=1) - 1
    recall = sum(got.values()) / truth.sum()
    print(f"d {d}: {truth.sum()} links, recall {recall:.4f}")
    assert all(got[k] <= t for k, t in enumerate(truth)) and recall >= 0.98
