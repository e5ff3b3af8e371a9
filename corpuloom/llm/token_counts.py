"""Token counts: whole texts in, only lengths out.

A text is cut where the pre-tokenizer of a byte-level vocabulary always cuts: between a character that isn't white
space and white space that follows it. The units between the cuts encode independently, so the length of a text is
the sum of its units' lengths. Units met before are looked up; new ones go through the library in batches of equal
bytes. Only the lengths leave the Python worker.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Unicode's White_Space, spelled out: Python's \s also has U+001C to U+001F, which the library's doesn't.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNITS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
CUT = re.compile(f"(?<=[^{WHITE}])[{WHITE}]")


def n_bytes(text: str) -> int:
    """Bytes of UTF-8, without encoding what is plain ASCII."""
    return len(text) if text.isascii() else len(text.encode("utf-8", "replace"))


class UnitLengths(dict):
    """unit -> number of tokens. An unknown unit counts 0 at first and is noted in `pending`."""

    def __init__(self, path: str, batch_bytes: int, most_units: int, longest_kept: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.batch_bytes, self.most_units, self.longest_kept = batch_bytes, most_units, longest_kept
        self.pending: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.pending.append(unit)
        return 0

    def encoded(self, units: list[str]) -> dict[str, int]:
        """Lengths of the units from the library, in batches of about batch_bytes bytes, whatever their number."""
        out: dict[str, int] = {}
        batch, size = [], 0
        for k, unit in enumerate(units):
            batch.append(unit)
            size += n_bytes(unit)
            if size >= self.batch_bytes or k == len(units) - 1:
                out.update(zip(batch, (len(e) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False))))
                batch, size = [], 0
        return out

    def lengths(self, texts: list[str | None]) -> list[int]:
        """The number of tokens of each text; null counts as empty."""
        out, owed, look = [], [], self.__getitem__
        self.pending = pending = []
        for text in texts:
            before = len(pending)
            pieces = pieces_of(text, self.batch_bytes) if text and len(text) > self.batch_bytes else (text,)
            out.append(sum(sum(map(look, UNITS.findall(piece))) for piece in pieces) if text else 0)
            if len(pending) > before:
                owed.append((len(out) - 1, before, len(pending)))
        if owed:
            new = self.encoded(list(set(pending)))
            for k, a, b in owed:
                out[k] += sum(new[u] for u in pending[a:b])
            if len(self) + len(new) > self.most_units:
                self.clear()
            self.update((u, n) for u, n in new.items() if len(u) <= self.longest_kept)
            self.pending = []
        return out


_KNOWN: dict[tuple, UnitLengths] = {}


def by_bytes(texts: list[str | None], most: int) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about `most` bytes; a longer text is a list of its own."""
    part, size = [], 0
    for text in texts:
        n = n_bytes(text or "")
        if part and size + n > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += n
    if part:
        yield part


def pieces_of(text: str, most: int) -> Iterator[str]:
    """A long text in pieces of about `most` characters, cut only where the pre-tokenizer always cuts: before white space
    that stands behind another character. A stretch without such a place stays whole."""
    low = 0
    while len(text) - low > most:
        m = CUT.search(text, low + most)
        if not m:
            break
        yield text[low : m.start()]
        low = m.start()
    yield text[low:]


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", id: str = "doc_id", limit: int = 1024, batch_bytes: int = 1 << 20, most_units: int = 1_000_000, longest_kept: int = 64) -> DataFrame:
    """One row a row of docs: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    tokenizer: path of a byte-level tokenizers .json file. Special strings inside a text count as the library's
    default has them. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated rows, a null id
    stays null, an empty table gives an empty table, and other columns of docs are neither read nor returned.
    most_units and longest_kept bound the memory of units looked up; they never change a count. No shuffle.
    """

    def counted(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = (tokenizer, batch_bytes, most_units, longest_kept)
        if key not in _KNOWN:
            _KNOWN[key] = UnitLengths(*key)
        known = _KNOWN[key]
        for batch in batches:
            n = [x for part in by_bytes(batch.column(2).to_pylist(), batch_bytes) for x in known.lengths(part)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    return rows.mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long").select(F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
