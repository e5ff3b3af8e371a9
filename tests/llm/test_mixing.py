from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corpuloom.llm import mixing


def targets(sizes: dict, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= most * sizes[s]}
        if not over:
            return out | {s: float(level * weight[s]) for s in free}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= most * sizes[s]
        free -= over
    return out


@pytest.fixture()
def corpus(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 5 == 0, None).otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"),
        F.repeat(F.lit("w "), (F.pmod(F.xxhash64("id"), F.lit(90)) * F.when(F.col("id") % 50 == 0, 20).otherwise(1)).cast("int")).alias("text"),
    )
    return rows


def test_the_mix_meets_its_targets(corpus):
    rows = mixing.mix(corpus).collect()
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r.size
    expected = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source], rel=1e-12)
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= max(0.02 * expected[s], 200), s
    assert len(rows) == 4000


def test_reruns_and_other_partitions_agree(corpus):
    one = sorted(mixing.mix(corpus).collect())
    key = lambda r: (r.doc_id, r.copies)
    assert sorted(map(key, one)) == sorted(map(key, mixing.mix(corpus.repartition(7)).collect()))


def test_sizes_of_awkward_texts(spark):
    texts = [None, "", " \t\n", "a", " a  b\n", "a b", "a\x1cb c"]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(mixing.words(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [0, 0, 0, 1, 2, 1, 2]


def test_awkward_tables(documents, no_documents):
    rows = mixing.mix(documents).collect()
    assert len(rows) == documents.count() and all(r.copies in (0, 1, 2) for r in rows)
    assert mixing.mix(no_documents).collect() == [] and mixing.mixed_documents(no_documents).collect() == []
    only_empty = documents.where("text is null or text = ''")
    assert all(r.taken == 0 and r.target == 0 for r in mixing.mix(only_empty).collect())


def test_mixed_documents_are_the_copies(documents):
    want = {}
    for r in mixing.mix(documents).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    out = mixing.mixed_documents(documents)
    assert out.columns == documents.columns
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == {k: n for k, n in want.items() if n}
