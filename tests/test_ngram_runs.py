import random
from collections import Counter

import pyarrow as pa
import pytest

from corpuloom.operators import ngram_runs
from corpuloom.plans import catalogue

TEXTS = ["red cat\tsat\n\n red  cat\r\n \t \n", "<s> red </s>\nred cat sat", None, "", "\n", "a\xa0b c d\x0be\x0cf \x85 \x1c", "é 漢字 \U0001f600 red cat"]


def by_hand(texts, n):
    out = Counter()
    for text in texts:
        for line in (text or "").split("\n"):
            for c in "\t\x0b\f\r":
                line = line.replace(c, " ")
            if words := [w for w in line.split(" ") if w]:
                words = ["<s>"] * (n - 1) + words + ["</s>"]
                out.update(" ".join(words[k : k + n]) for k in range(len(words) - n + 1))
    return out


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_counts(spark, n):
    assert Counter({r.ngram: r.cnt for r in ngram_runs.counts(table(spark, TEXTS), n).collect()}) == by_hand(TEXTS, n)


def test_frequent_ones_of_many_groups(spark):
    draw = random.Random(3)
    texts = ["\n".join(" ".join(f"w{int(draw.paretovariate(0.5)) % 500}" for _ in range(draw.choice([0, 1, 20]))) for _ in range(30)) for _ in range(40)]
    every = by_hand(texts, 3)
    rows = ngram_runs.counts(table(spark, texts), 3, letters=ngram_runs.GROUP_BYTES * 150, least=2).collect()
    assert len(rows) == len({r.ngram for r in rows}) and {r.ngram: r.cnt for r in rows} == {k: c for k, c in every.items() if c >= 2}


def test_more_words_than_a_key_holds():
    texts = [" ".join(f"w{k * j % 997}" for j in range(700)) + "\nlast one" for k in (1, 2)]
    words, line = ngram_runs.words_of_lines(pa.array(texts))
    assert len(set(words.to_pylist())) ** 8 > 1 << 63
    got = Counter()
    for batch in ngram_runs.runs_of(pa.array(texts), 8, 5):
        for run in batch.column(1).to_pylist():
            cnt, lengths, text = ngram_runs.unpacked(run)
            at = 0
            for c, m in zip(cnt.tolist(), lengths.tolist()):
                got[bytes(text[at : at + m]).decode()] += c
                at += m
    assert got == by_hand(texts, 8)


def test_pieces_are_all_of_it():
    texts = pa.array(["a" * 10, None, "b" * 100, "", "c" * 5, "d" * 5])
    some = list(ngram_runs.pieces(texts, 12))
    assert [x for piece, _ in some for x in piece.to_pylist()] == texts.to_pylist()
    assert sum(size for _, size in some) == 120 and max(size for _, size in some) == 100 and len(some) > 2


def test_nothing(spark):
    assert ngram_runs.counts(table(spark, [None, " \n"]).where("doc_id >= 0"), 2).collect() == []
    with pytest.raises(ValueError):
        ngram_runs.counts(table(spark, TEXTS), 0)


@pytest.mark.parametrize("name", ["ngram_trigram", "ngram_freq_filter"])
def test_packed_runs_are_shuffled(spark, tmp_path, name):
    table(spark, TEXTS * 5).write.parquet(f"{tmp_path}/documents.parquet")
    rows = catalogue.QUERIES[name](spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and not any(x in plan for x in ("Generate", "HashAggregate")) and not rows.isEmpty()


def test_steps_of_the_tokenizer_are_run_once(spark, tmp_path):
    spark.createDataFrame([(1, "Dr. No (not here) said: 1,000 a.m. Yes! 'tis it.\n\nNo; no.")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = catalogue.token_bigrams(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    marks = [line.count("[A-Z][a-z]") for line in plan.splitlines() if "[A-Z][a-z]" in line]
    assert marks == [1, 1]  # one pass for sentences and one for tokens, in a column of its own
    assert "FlatMapGroupsInArrow" in plan and "Aggregate" not in plan
    assert {r.ngram for r in rows.collect()} >= {"1,000 a.m.", "<s> tis", "no </s>"}
