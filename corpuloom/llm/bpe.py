"""BPE encoding and decoding by forced boundaries.

A byte pair that occurs inside no token of the vocabulary can never be merged across, so every place where it stands
is a certain cut. White space is one such place (the vocabulary has none inside a token and the pre-tokenizer drops
it), and inside a word the pairs of the vocabulary give more. The fragments between the cuts are encoded on their
own and the results joined; a fragment met before is looked up.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuloom.llm.shared import Recent, slices
from corpuloom.llm.token_counts import WHITE

SPLIT = re.compile(r"[^\t-\r ]+")


def byte_letters() -> list[str]:
    """The visible letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class ForcedBoundaryBpe:
    """Encoder and decoder of a lower-casing word-end BPE vocabulary (a tokenizers .json file without a decoder)."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, models

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec.get("decoder") is not None or not model["end_of_word_suffix"]:
            raise ValueError("not a lower-casing word-end BPE vocabulary without a decoder")
        self.library = Tokenizer.from_file(path)
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.special_rx = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace("\\s", WHITE)
        self.words = regex.compile(pattern)
        self.letters = byte_letters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.last = models.BPE(vocab=self.vocab, merges=merges, end_of_word_suffix=self.end)
        self.inner = models.BPE(vocab=self.vocab, merges=merges)  # for fragments that don't end their word
        inside = set()
        for token in self.vocab:
            body = token[: -len(self.end)] if token.endswith(self.end) else token
            inside.update(zip(body, body[1:]))
        self.inside = inside  # pairs of byte letters that some token has inside; any other pair is a certain cut

    def cut(self, word: str) -> list[str]:
        """A word in byte letters, cut at every pair that no token has inside."""
        at = [k for k in range(1, len(word)) if (word[k - 1], word[k]) not in self.inside]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)])] if at else [word]

    def words_of(self, text: str) -> list[str]:
        """The pre-tokenizer's words in byte letters.

        Below U+0250 every version of Unicode agrees on letters, digits and cases; other texts are normalised and
        parted by the library, whose version of Unicode may not be Python's.
        """
        if text.isascii():
            text = text.lower()
        elif max(text) < "\u0250":
            text = unicodedata.normalize("NFC", text).lower()
        else:
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]
        letters = self.letters
        return ["".join([letters[b] for b in word.encode()]) for word in self.words.findall(text)]

    def word_ids(self, word: str) -> list[int]:
        """The ids of one word of the pre-tokenizer, in byte letters."""
        if self.inside.issuperset(zip(word, word[1:])):
            return [t.id for t in self.last.tokenize(word)]
        *heads, tail = self.cut(word)
        return [t.id for fragment in heads for t in self.inner.tokenize(fragment)] + [t.id for t in self.last.tokenize(tail)]

    def plain(self, text: str) -> list[int]:
        return [i for word in self.words_of(text) for i in self.word_ids(word)]

    def encode(self, text: str | None) -> list[int]:
        """The ids of a whole text; special strings in it are their tokens. Null counts as empty."""
        if not text:
            return []
        if self.special_rx is None or "<|" not in text:
            return self.plain(text)
        return [i for part in self.special_rx.split(text) if part for i in ([self.special[part]] if part in self.special else self.plain(part))]

    def decode(self, ids: list[int]) -> str:
        """What a vocabulary without a decoder gives: the tokens joined by one space; unknown ids have none."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


PUNCTUATION = ".,;:!?"


class Units(Recent):
    """A white-space-free unit of text -> (number of tokens, ids as text, tokens as text).

    Most units are a word of letters with or without punctuation behind it: two words to the pre-tokenizer, looked up
    one by one in `words`, where capitals and neighbours don't matter.
    """

    def __init__(self, bpe: ForcedBoundaryBpe, most_units: int, longest_kept: int):
        super().__init__(most_units)
        self.bpe, self.longest_kept = bpe, longest_kept
        self.words = Words(bpe, most_units)

    def __missing__(self, unit: str) -> tuple[int, str, str]:
        if len(unit) > self.longest_kept:
            return self.words.coded(unit)
        if (known := self.older.get(unit)) is not None:
            return self.keep(unit, known)
        core = unit.rstrip(PUNCTUATION)
        word = core.lower() if core.isascii() else unicodedata.normalize("NFC", core).lower()
        if word.isalpha() and max(word) < "\u0250":
            out = self.words[word]
            if len(core) < len(unit):
                tail = self.words[unit[len(core) :]]
                out = (out[0] + tail[0], f"{out[1]} {tail[1]}", f"{out[2]} {tail[2]}")
        else:
            out = self.words.coded(unit)
        return self.keep(unit, out)


class Words(Recent):
    """A single word of the pre-tokenizer, normalised, -> the same three."""

    def __init__(self, bpe: ForcedBoundaryBpe, most: int):
        super().__init__(most)
        self.bpe = bpe

    def described(self, ids: list[int]) -> tuple[int, str, str]:
        tokens = self.bpe.tokens
        return len(ids), " ".join([str(i) for i in ids]), " ".join([tokens[i] for i in ids])

    def coded(self, text: str) -> tuple[int, str, str]:
        """Of any text, not looked up."""
        return self.described(self.bpe.encode(text))

    def __missing__(self, word: str) -> tuple[int, str, str]:
        if (known := self.older.get(word)) is None:
            letters = self.bpe.letters
            known = self.described(self.bpe.word_ids(word if word.isascii() else "".join([letters[b] for b in word.encode()])))
        return self.keep(word, known)


_KNOWN: dict[tuple, Units] = {}


def known_units(tokenizer: str, most_units: int, longest_kept: int) -> Units:
    key = (tokenizer, most_units, longest_kept)
    if key not in _KNOWN:
        _KNOWN[key] = Units(ForcedBoundaryBpe(tokenizer), most_units, longest_kept)
    return _KNOWN[key]


def digests(known: Units, text: str | None) -> tuple[int, str, str]:
    found = [e for e in map(known.__getitem__, SPLIT.findall(text)) if e[0]] if text else []
    if not found:
        empty = hashlib.sha256(b"").hexdigest()
        return 0, empty, empty
    counts, ids, decoded = zip(*found)
    return sum(counts), hashlib.sha256(" ".join(ids).encode()).hexdigest(), hashlib.sha256(" ".join(decoded).encode()).hexdigest()


def encode_digests(docs: DataFrame, tokenizer: str, text: str = "text", id: str = "doc_id", most_units: int = 200_000, longest_kept: int = 64) -> DataFrame:
    """One row a row of docs: id, n_tokens, ids_sha256 (of the decimal ids joined by one space), decoded_sha256.

    A null text counts as empty: no tokens, and both digests are those of the empty string. Repeated rows give
    repeated rows, a null id stays null, an empty table gives an empty table; other columns of docs aren't read.
    most_units and longest_kept bound the memory of units looked up and never change a result. No shuffle.
    """

    def coded(batches):
        known = known_units(tokenizer, most_units, longest_kept)
        for batch in slices(batches):
            n, ids, decoded = zip(*[digests(known, x) for x in batch.column(1).to_pylist()])
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id].dataType.simpleString()
    out = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(coded, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id)


def encode_texts(docs: DataFrame, tokenizer: str, text: str = "text", id: str = "doc_id", most_units: int = 200_000, longest_kept: int = 64) -> DataFrame:
    """The token ids themselves: id, ids (array<int>). A null text gives an empty array."""

    def coded(batches):
        known = known_units(tokenizer, most_units, longest_kept)
        for batch in slices(batches):
            ids = [[int(i) for u in SPLIT.findall(x or "") for i in known[u][1].split()] for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(coded, f"id {kind}, ids array<int>").withColumnRenamed("id", id)


def decode_ids(rows: DataFrame, tokenizer: str, ids: str = "ids", id: str = "doc_id") -> DataFrame:
    """The texts of token ids as the library decodes them: id, text. Null ids give an empty text."""

    def decoded(batches):
        bpe = known_units(tokenizer, 200_000, 64).bpe
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([bpe.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], ["id", "text"])

    kind = rows.schema[id].dataType.simpleString()
    return rows.select(F.col(id).alias("id"), F.col(ids).alias("ids")).mapInArrow(decoded, f"id {kind}, text string").withColumnRenamed("id", id)
