import glob

import pytest

from corpuloom import __main__ as cli
from corpuloom.plans import corpus

PAGES = "".join(f"<page><title>{t}</title>{r}<revision><text>{x}</text></revision></page>" for t, r, x in [("Cats", "", "== Cats ==\n'''Cats''' sit. [[Dog|Dogs]] run (fast).\n\nCats and dogs sleep."), ("Category:X", "", "no"), ("R", "<redirect/>", "no"), ("Bad", "", "a &lt;!-- b"), ("Dogs", "", "Dogs run. Dogs sleep.")])


def read(folder):
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{folder}/part-*")))


def test_tools_in_turn(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(f"<mediawiki>{PAGES}</mediawiki>")
    at = lambda name: str(tmp_path / name)
    for line in [
        f"articles {at('dump.xml')} {at('a')}",
        f"articles {at('dump.xml')} {at('files')} --files",
        f"textify {at('a')} {at('t')}",
        f"sentences {at('t')} {at('s')}",
        f"tokenize {at('s')} {at('k')}",
        f"ngrams {at('k')} {at('n1')} -n 1",
        f"ngrams {at('k')} {at('n2')}",
        f"filter {at('n2')} {at('f')} -t 2",
        f"sort {at('n1')} {at('o')}",
        f"merge {at('n1')} {at('n1')} {at('m')}",
        f"collocations {at('s')} {at('c')}",
        f"association {at('c')} {at('x')} --unigrams {at('n1')}",
        f"truncate {at('dump.xml')} 0 11 {at('cut')}",
    ]:
        cli.run(spark, cli.parser().parse_args(line.split()))
    assert "Dogs run" in read(at("t")) and "no" not in read(at("t")).split() and "<!--" not in read(at("t"))
    assert "cats sit\n" in read(at("k")) and "dogs run\n" in read(at("k"))
    ones = dict(reversed(x.split("\t")) for x in read(at("n1")).splitlines()[1:])
    assert ones["dogs"] == "4" and int(read(at("n1")).splitlines()[0]) == sum(map(int, ones.values()))
    assert read(at("o")).splitlines()[1].endswith("</s>")
    assert {x.split("\t")[1]: int(x.split("\t")[0]) for x in read(at("m")).splitlines()[1:]}["dogs"] == 8
    assert all(int(x.split("\t")[0]) >= 2 for x in read(at("f")).splitlines())
    assert open(at("cut/dump.xml")).read() == "<mediawiki>" and len(glob.glob(at("files/*.txt"))) == 3
    assert read(at("x"))


def test_whole_corpus(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(f"<mediawiki>{PAGES}</mediawiki>")
    out = corpus.build(spark, str(tmp_path / "dump.xml"), str(tmp_path / "out"))
    assert {r.title for r in out.plaintext.collect()} == {"Cats", "Dogs"} and [r.title for r in out.rejects.collect()] == ["Bad"]
    n_words = sum(len(r.words) for r in out.tokens.collect())
    n_lines = sum(1 for r in out.tokens.collect() if r.words)
    for n in (1, 2, 3):
        assert sum(r.cnt for r in out.counts[n].collect()) == n_words + n_lines
    own = {r.w: r.cnt for r in out.collocations.where("w = v").collect()}
    ones = {r.ngram: r.cnt for r in out.counts[1].collect()}
    assert own == {w: c for w, c in ones.items() if w != "</s>"}
    assert all(r.norm_mi == pytest.approx(1) for r in out.association.where("w = v").collect())
    assert corpus.frequent(out, 1, corpus.Settings(threshold=4)).first().cnt >= 4
    pruned = corpus.build(spark, str(tmp_path / "dump.xml"), str(tmp_path / "out2"), corpus.Settings(cutoff=2))
    wide = {(r.w, r.v): r.cnt for r in out.collocations.collect()}
    assert all(wide[r.w, r.v] == r.cnt for r in pruned.collocations.collect())


def test_settings():
    with pytest.raises(ValueError):
        corpus.Settings(orders=(0,))
