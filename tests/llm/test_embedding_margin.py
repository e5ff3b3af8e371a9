import numpy as np

from corpuloom.llm import embeddings


def test_pairs_right_at_the_threshold_share_a_cell():
    s = embeddings.Settings()
    rng = np.random.default_rng(5)
    a = embeddings.unit(rng.normal(size=(10_000, 64)))
    away = rng.normal(size=a.shape)
    away = embeddings.unit(away - (away * a).sum(axis=1, keepdims=True) * a)
    b = 0.951 * a + (1 - 0.951**2) ** 0.5 * away
    centres = embeddings.spherical_kmeans(a.astype(np.float32), 126, s)
    near = [x @ centres.T for x in (a, b)]
    home = [x.argmax(axis=1) for x in near]
    rows = np.arange(len(a))
    visits = [near[k][rows, home[1 - k]] >= near[k].max(axis=1) - s.margin for k in (0, 1)]
    assert (visits[0] | visits[1]).mean() >= 0.9995
