import random
import zlib

import numpy as np
import pytest

from corpuloom.llm import quality, toxicity
from corpuloom.llm.labelled import training_sample

BAD = ["idiot", "moron", "trash", "stupid"]


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice("ba ke lo mi tu ra so ne".split()) for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    docs, labels = [], []
    for k in range(600):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, 200))]
        toxic, good = int(k % 4 == 0), int(k % 3 != 0)
        if toxic:
            for _ in range(max(1, len(words) // 25)):
                words[rnd.randrange(len(words))] = rnd.choice(BAD)
        text = " ".join(words).capitalize() + "."
        if not good:
            text = rnd.choice([" ".join(w.upper() + "!!" for w in words), " ".join(w for w in words[:5] for _ in range(30)), " ".join(w + "$%&" for w in words)])
        docs.append((k, text, "en", "a", len(text), 1))
        labels.append((k, good, toxic))
    docs += [(9000, None, None, None, None, 1), (9001, "", None, None, 0, 1), (9002, " \n", None, None, 2, 1), (9003, "word " * 60_000, None, None, 0, 1), (None, "Kelo mi.", None, None, 0, 1)]
    labels += [(9000, None, None), (None, 1, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, label int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("what, column, folds, held", [(toxicity.toxicity, "toxic", 3, 1), (quality.quality, "quality", 5, 0)])
def test_held_out_accuracy_and_awkward_rows(labelled, what, column, folds, held):
    docs, labels = labelled
    rows = what(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r[column] for r in labels.collect() if r[column] is not None}
    out = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in out]) > 0.93 and len(out) > 60
    for r in rows:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == held or r.doc_id is None and held == 0)
    empty = {r.score for r in rows if r.doc_id in (9000, 9001, 9002)}
    assert len(empty) == 1


@pytest.mark.parametrize("what", [toxicity.toxicity, quality.quality])
def test_without_labels_or_documents(labelled, what):
    docs, labels = labelled
    assert len({r.score for r in what(docs, labels.where("false")).collect()}) == 1
    assert len({r.score for r in what(docs, labels.where("toxic = 0 and quality = 1")).collect()}) == 1
    assert what(docs.where("false"), labels).collect() == []


def test_misspellings_share_ngrams():
    rnd = random.Random(1)
    plain = [" ".join(rnd.choice(["river", "stone", "cloud", "green", "table"]) for _ in range(30)) for _ in range(120)]
    texts = [t + (" " + rnd.choice(BAD)) * 3 if k % 2 else t for k, t in enumerate(plain)]
    model = toxicity.Logits(toxicity.train(texts, [k % 2 for k in range(120)]), 10, 8)
    assert model.score(plain[0] + " moronn idiiot morron") > model.score(plain[0] + " garden mountain window")


def test_samples_leave_the_held_out_fold_out(labelled):
    docs, labels = labelled
    texts, ys = training_sample(docs, labels, "toxic", 3, 1, (40, 40), 10_000)
    assert len(texts) == 80 and sum(ys) == 40
    held = {r.text for r in docs.collect() if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert not held & set(texts)
    again = training_sample(docs.unionByName(docs), labels, "toxic", 3, 1, (40, 40), 10_000)
    assert again == (texts, ys)
    short = training_sample(docs, labels, "toxic", 3, 1, (40, 40), 50)[0]
    assert len(short) == 80 and all(len(a) <= 50 and a in b for a, b in zip(short, texts))


def test_accepted_keeps_columns(labelled):
    docs, labels = labelled
    out = quality.accepted(docs.withColumnRenamed("label", "score"), labels)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    scored = {r.doc_id: r.predicted for r in quality.quality(docs, labels).collect()}
    assert {r.doc_id for r in out.collect()} == {k for k, p in scored.items() if p}
    assert quality.accepted(docs.where("false"), labels).collect() == []


def test_passages_by_hand():
    found = quality.passages([b"AB cd", b"", b" ", b"a a a b!"], 2)
    assert found.piece.tolist() == [0, 3, 3] and found.first.tolist() == [0, 2, 4] and len(found.word_bucket) == 6
    assert found.word_bucket[2] == found.word_bucket[3] == found.word_bucket[4] != found.word_bucket[5]
    assert found.x[0][0] == pytest.approx(0.5) and found.x[1][7] == pytest.approx(0.5) and found.x[1][8] == pytest.approx(0.5)
    pieces, rows = quality.segments([b"word " * 100, b"", b"x" * 95], 30)
    assert b"".join(p for p, r in zip(pieces, rows) if r == 0) == b"word " * 100 and b"".join(p for p, r in zip(pieces, rows) if r == 2) == b"x" * 95
    assert max(map(len, pieces)) <= 30 and rows.tolist().count(1) == 1


def bags(n, rnd):
    """Documents of 1 to 60 passages of chance words; those of label 1 hold one passage with telling words, of label 0 none."""
    word = lambda: "".join(rnd.choice("ba ke lo mi tu ra so ne".split()) for _ in range(rnd.randint(1, 3)))
    texts, labels = [], []
    for k in range(n):
        parts = [[word() for _ in range(50)] for _ in range(rnd.randint(1, 60))]
        if k % 2:
            part = rnd.choice(parts)
            for at in rnd.sample(range(50), 8):
                part[at] = rnd.choice(["zulu", "xray", "quux"])
        texts.append(" ".join(" ".join(p) for p in parts))
        labels.append(k % 2)
    return texts, labels


def test_attention_gradients():
    """Each parameter's gradient against differences of the loss, in double precision."""
    texts, labels = bags(12, random.Random(3))
    s = quality.Settings(hidden=5, attention=3)
    model = quality.train(texts, labels, quality.Settings(hidden=5, attention=3, epochs=3))
    rng = np.random.default_rng(1)
    model.params = {k: np.array(v + rng.normal(0, 0.3, v.shape), np.float64) for k, v in model.params.items()}
    found = quality.passages([t.encode() for t in texts], s.passage_words)
    starts = np.flatnonzero(np.r_[True, found.piece[1:] != found.piece[:-1]])
    sizes = np.diff(np.r_[starts, len(found.piece)])
    y, weight = np.array(labels, float), np.full(len(labels), 1 / len(labels))
    _, grads = quality.gradients(model, found, starts, sizes, y, weight)
    for name, value in model.params.items():
        places = [()] if value.ndim == 0 else [tuple(rng.integers(0, d) for d in value.shape) for _ in range(6)]
        if name == "E":
            places = [(int(b), 2) for b in found.word_bucket[:4]]
        for at in places:
            loss = []
            for step in (1e-5, -1e-5):
                model.params[name] = value.copy()
                model.params[name][at] += step
                loss.append(quality.gradients(model, found, starts, sizes, y, weight)[0])
            model.params[name] = value
            assert (loss[0] - loss[1]) / 2e-5 == pytest.approx(float(grads[name][at]), rel=1e-4, abs=1e-8), name


def test_attention_finds_the_one_passage_that_tells():
    rnd = random.Random(5)
    texts, labels = bags(500, rnd)
    more, truth = bags(300, rnd)
    right = {}
    for attend in (True, False):
        model = quality.train(texts, labels, quality.Settings(attend=attend, share=0.5))
        right[attend] = np.mean((model.scores([t.encode() for t in more]) >= 0.5) == np.array(truth))
    print(f"accuracy with attention {right[True]:.3f}, with equal weights {right[False]:.3f}")
    assert right[True] > 0.93 and right[False] < right[True] - 0.1


def test_long_texts_score_the_same_in_pieces_and_within_little_memory():
    import tracemalloc

    texts, labels = bags(60, random.Random(6))
    model = quality.train(texts, labels, quality.Settings(epochs=20))
    whole = model.scores([t.encode() for t in texts], 1 << 30)
    words = " ".join(texts).encode()
    assert model.scores([t.encode() for t in texts], 1 << 19) == pytest.approx(whole, abs=1e-6)
    assert model.scores([words * 3], 1 << 16) == pytest.approx(model.scores([words * 3], 1 << 30), abs=0.02)  # passages begin anew in a piece
    long = b"some words here " * 2_000_000
    tracemalloc.start()
    model.scores([long])
    assert tracemalloc.get_traced_memory()[1] < len(long) + 150_000_000
    tracemalloc.stop()


def test_repeated_rows_score_the_same(labelled):
    docs, labels = labelled
    for what in (toxicity.toxicity, quality.quality):
        once = {r.doc_id: r.score for r in what(docs, labels).collect()}
        twice = what(docs.unionByName(docs), labels).collect()
        assert len(twice) == 2 * len(once) and all(r.score == once[r.doc_id] for r in twice)


def test_the_cut_follows_the_set_aside_texts():
    rnd = random.Random(2)
    plain = [" ".join(rnd.choice(["river", "stone", "cloud", "green", "table", "house"]) for _ in range(30)) for _ in range(400)]
    texts = [t + " " + rnd.choice(BAD) if k % 4 == 0 else t for k, t in enumerate(plain)]
    model = toxicity.Logits(toxicity.fitted(texts, [int(k % 4 == 0) for k in range(400)], 0.7), 1000, 64)
    found = [model.score(t) >= 0.7 for t in texts]
    assert np.mean([a == (k % 4 == 0) for k, a in enumerate(found)]) > 0.97
