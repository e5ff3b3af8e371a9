import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpuloom.llm import exact_dedup, shared, simhash
from corpuloom.llm.shared import components


def union(pairs, nodes):
    label = {n: n for n in nodes}
    while True:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
        if not changed:
            return label


@pytest.mark.parametrize("seed", range(3))
def test_components_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(30)] + [(200, 201 + k) for k in range(40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long").repartition(5)).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    expected = union(edges, {n for e in edges for n in e})
    assert got == {n: expected[n] for n in linked}


def test_components_of_nothing_and_of_strings(spark):
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []
    got = components(spark.createDataFrame([("b", "c"), ("c", "a"), ("z", "z")], "a string, b string")).collect()
    assert {(r.node, r.component) for r in got} == {("a", "a"), ("b", "a"), ("c", "a")}


def exact_by_hand(rows):
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    out = []
    for id, text in rows:
        group = [(-len(t or ""), i is None, i or 0, i) for i, t in rows if strip(t) == strip(text)]
        out.append((id, min(group, key=lambda g: g[:3])[3], len(group)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1)), lambda t: F.unhex(F.lit("00"))])
def test_exact_dedup_also_with_digests_that_collide(documents, digest):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = exact_dedup.exact_dedup(documents, digest=digest).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=repr) == exact_by_hand(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_exact_dedup_keeps_one_of_each(documents, no_documents):
    kept = exact_dedup.kept_rows(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 6, 7, 8, 10, 11]
    assert exact_dedup.kept_rows(no_documents).collect() == []
    assert exact_dedup.exact_dedup(no_documents).collect() == []


def entry_rows(rows):
    return sorted(((r.digest, r.keep.id, r.group_size) for r in rows.collect()), key=repr)


def test_batch_by_batch_equals_one_go(spark, documents):
    entries = exact_dedup.stored(exact_dedup.entries_of(documents, "text", "doc_id"))
    expected = entry_rows(entries.groupBy("digest").agg(exact_dedup.best().alias("keep"), F.count("*").alias("group_size")))
    for memtables, fan_out in ((1, 4), (2, 2), (3, 2), (5, 2)):
        index = exact_dedup.Index(spark, buckets=3, fan_out=fan_out)
        for k in range(memtables):
            index.flush(entries.where(F.pmod("row", F.lit(memtables)) == k))
            assert all(len(level) < fan_out for level in index.levels)
        assert entry_rows(index.lookup()) == expected
    second = exact_dedup.indexed(entries, index=exact_dedup.indexed(entries))
    assert [r[2] for r in entry_rows(second.lookup())] == [2 * r[2] for r in expected]


def test_runs_are_merged_without_an_exchange_or_a_sort_of_one_of_them(spark, documents, capsys):
    entries = exact_dedup.stored(exact_dedup.entries_of(documents, "text", "doc_id"))
    index = exact_dedup.Index(spark, buckets=3, fan_out=9)
    for k in range(2):
        index.flush(entries.where(F.pmod("row", F.lit(2)) == k))
    index.lookup().explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_probe_reads_only_runs_whose_filter_lets_something_through(spark, documents):
    entries = exact_dedup.stored(exact_dedup.entries_of(documents, "text", "doc_id"))
    index = exact_dedup.Index(spark, buckets=3, fan_out=9)
    digests = [r.digest for r in entries.select("digest").distinct().orderBy("digest").collect()]
    for k in range(4):
        index.flush(entries.where(F.col("digest").isin(digests[2 * k : 2 * k + 2])))
    index.runs_read = 0
    asked = entries.where(F.col("digest") == digests[2]).select("digest").distinct()
    assert [r.digest for r in index.probe(asked).collect()] == [digests[2]] and index.runs_read == 1
    index.runs_read = 0
    assert index.probe(asked.select(F.unhex(F.lit("ff")).alias("digest"))).count() == 0 and index.runs_read == 0
    everything = entries.select("digest").distinct()
    assert index.probe(everything).count() == min(8, len(digests))


@pytest.mark.parametrize("filter_rows", [1, 1 << 18])
def test_filters_lose_nothing(spark, filter_rows):
    rows = spark.range(2000).select(F.xxhash64("id").alias("k"), "id")
    bloom = shared.filter_of(F.col("k"), rows.where("id < 900"), filter_rows)
    assert bloom.count() <= filter_rows
    got = shared.may_hold(rows, F.col("k"), bloom, filter_rows)
    assert got.where("id < 900 and may_hold").count() == 900 and got.count() == 2000
    if filter_rows > 1:
        assert got.where("may_hold").count() < 910


def fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in simhash.near_dedup(documents).collect():
        assert r.fingerprint == f"{fingerprint(texts[r.doc_id]):016x}"


@pytest.mark.parametrize("seed", range(2))
def test_all_pairs_within_three_bits(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    fps = set(centres)
    for c in centres:
        for _ in range(120):
            x = c
            for _ in range(rnd.randrange(1, 5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    expected = {tuple(sorted((a, b))) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 3}
    table = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")
    for run in (2048, 8):  # with a small bound, most keys count as crowded
        monkeypatch.setattr(simhash, "RUN", run)
        full = (1 << 64) - 1
        got = [tuple(sorted((r.a & full, r.b & full))) for r in near(table, run).collect()]
        assert len(got) == len(set(got)) and set(got) == expected


def near(table, run):
    """near_pairs with the bound in the workers as well."""
    spread = simhash.variants(table).repartition("block", "key").sortWithinPartitions("block", "key")

    def met(batches):
        simhash.RUN = run
        yield from simhash.met(batches)

    found = simhash.stored(spread.mapInArrow(met, "a long, b long, block byte, hot boolean"))
    hot = found.where("hot").select("block", F.col("b").alias("key"), F.col("a").alias("fp"))
    return found.where("not hot").select("a", "b").unionByName(simhash.crowded_pairs(hot))


def test_a_crowded_key_over_many_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "RUN", 4)
    rows = [(0, 1, k) for k in range(11)] + [(0, 2, k) for k in range(3)] + [(1, 2, k) for k in range(6)]
    batches = [pa.record_batch([pa.array([r[0] for r in p], pa.int8()), pa.array([r[1] for r in p]), pa.array([r[2] for r in p])], ["block", "key", "fp"]) for p in (rows[k : k + 3] for k in range(0, len(rows), 3))]
    hot = [(b, key, fp) for out in simhash.met(batches) for fp, key, b, h in zip(*(out.column(k).to_pylist() for k in range(4))) if h]
    assert sorted(hot) == sorted([r for r in rows if (r[0], r[1]) != (0, 2)])


def test_near_dedup_by_hand(spark, no_documents):
    base = [f"w{k}" for k in range(300)]
    texts = [" ".join(base)] * 3 + [" ".join(base[:-1] + ["other"]), " ".join(base[1:]), "quite another text of some words", None, "", " "]
    docs = spark.createDataFrame([(10 + k, t) for k, t in enumerate(texts)] + [(12, texts[2])], "doc_id long, text string")
    ids = [r.doc_id for r in docs.collect()]
    fps = [fingerprint(r.text) for r in docs.collect()]
    pairs = [(a, b) for a, b in itertools.combinations(range(len(fps)), 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    label = union(pairs, range(len(fps)))
    expected = sorted((ids[k], sum(k in p for p in pairs), min(ids[j] for j in range(len(fps)) if label[j] == label[k])) for k in range(len(fps)))
    assert sorted((r.doc_id, r.n_near, r.component_id) for r in simhash.near_dedup(docs).collect()) == expected
    kept = simhash.representatives(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({e[2] for e in expected})
    assert simhash.near_dedup(no_documents).collect() == [] and simhash.representatives(no_documents).collect() == []


def test_majority():
    assert simhash.bit_majority(np.array([], dtype=np.uint64)) == 0
    assert simhash.bit_majority(np.array([3, 1], dtype=np.uint64)) == 1


def test_tables_go_when_told(spark):
    table = shared.stored(spark.range(3).toDF("x"))
    assert table.count() == 3
    path = shared._TABLES[-1][1]
    shared.drop_tables(spark)
    assert not shared._TABLES
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()
