import hashlib
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    good = [f"Sentence number {k} speaks of things such as {k * 7} and {k * k}, in plain words. It goes on a little." for k in range(60)]
    bad = [" ".join(f"{w.upper()}!!" for w in g.split()) for g in good[:30]]
    rows = [(k, t, "en", "abc"[k % 3], len(t)) for k, t in enumerate(good + bad)]
    rows += [(500, good[0].replace(" ", "  "), "en", "a", 0), (501, good[1], None, None, None), (501, good[1], None, None, None), (None, good[2], "en", None, 1), (502, None, None, None, None), (503, "", "en", "c", 0), (504, "long words " * 20_000, "en", "b", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(k, int(k < 60), 0) for k in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages_in_turn(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        assert docs.columns == columns, name
        seen.append(docs.collect())
    start, scored, exact, near, mixed = ([r.doc_id for r in s] for s in seen)
    assert set(range(60)) <= set(scored) and not set(range(60, 90)) & set(scored)
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert len({strip(r.text) for r in seen[2]}) == len(seen[2]) == len({strip(r.text) for r in seen[1]})
    assert 500 in exact and 0 not in exact  # the longer of two texts equal but for white space
    assert set(near) <= set(exact) and len(near) > 0.8 * len(exact)
    assert set(mixed) <= set(near) and all(mixed.count(d) <= 2 for d in mixed)


def test_run_gives_the_digests_of_the_mix(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []
