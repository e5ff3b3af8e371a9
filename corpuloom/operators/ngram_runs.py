"""N-gram counts of large tables: each task counts pieces of its texts in numpy, and packed runs are shuffled, not rows.

An n-gram goes to the group that its words' hash names; a group's runs are merged on their own. Memory is bounded by the
size of a piece and of a group, whatever the corpus; nothing is cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuloom.operators.ngrams import BEGIN, END

#: Bytes of texts that are counted at a time, and that a group's n-grams come from, about; rows of a batch handed on.
PIECE_BYTES, GROUP_BYTES, BATCH = 6 << 20, 8 << 20, 1 << 15

RUN = "g int, run binary"


def packed(cnt, lengths, text: bytes) -> bytes:
    """A run: n-grams one behind the other, their lengths and counts byte by byte of the number, so that zeros go."""
    import numpy as np
    import pyarrow as pa

    planes = [a.view(np.uint8).reshape(len(a), -1).T.tobytes() for a in (cnt.astype("<i8"), lengths.astype("<u4"))]
    raw = b"".join([*planes, text])
    return len(cnt).to_bytes(8, "little") + len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpacked(run: bytes):
    """(cnt, lengths, text) of a run."""
    import numpy as np
    import pyarrow as pa

    n, size = int.from_bytes(run[:8], "little"), int.from_bytes(run[8:16], "little")
    raw = pa.Codec("zstd").decompress(run[16:], size)
    plane = lambda at, k: np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * k, at).reshape(k, n).T)
    return plane(0, 8).view("<i8").ravel(), plane(8 * n, 4).view("<u4").ravel(), memoryview(raw)[12 * n :]


def words_of_lines(texts):
    """(words, line of each): the words of all lines of a string array, parted at white space as text.words_of() does."""
    import pyarrow.compute as pc

    parts = pc.ascii_split_whitespace(pc.split_pattern(texts.drop_null(), "\n").flatten())
    words, line = parts.flatten(), pc.list_parent_indices(parts)
    some = pc.greater(pc.binary_length(words), 0)
    return words.filter(some), line.filter(some).to_numpy()


def places(words, line, n: int):
    """(dictionary, ids, starts): words by number with the marks of each line around them, and where the n-grams start."""
    import numpy as np
    import pyarrow as pa

    coded = pa.concat_arrays([words, pa.array([BEGIN, END], words.type)]).dictionary_encode()
    ids = coded.indices.to_numpy()
    first = np.r_[True, line[1:] != line[:-1]]
    k = np.cumsum(first) - 1
    at = np.arange(len(words)) + k * n + n - 1
    last = at[np.r_[np.flatnonzero(first)[1:] - 1, len(words) - 1]] + 1
    out = np.full(len(words) + (k[-1] + 1) * n, ids[-2], np.int64)
    out[at], out[last] = ids[:-2], ids[-1]
    starts = np.ones(len(out), bool)
    for j in range(n - 1):
        starts[last - j] = False
    return coded.dictionary, out, np.flatnonzero(starts)


def pieces(texts, most: int):
    """A string array in slices of about most bytes."""
    import numpy as np
    import pyarrow.compute as pc

    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + most, "right")))
        yield texts.slice(low, high - low), int(upto[high - 1] - (upto[low - 1] if low else 0))
        low = high


def runs_of(texts, n: int, groups: int):
    """Record batches of RUN: the counts within a string array, by group."""
    import zlib

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    words, line = words_of_lines(texts)
    if not len(words):
        return
    every, padded, starts = places(words, line, n)
    del words, line
    step = len(starts) if len(every) ** n < 1 << 63 else max(1, int(2 ** (62 / n)) - n)
    for low in range(0, len(starts), step):
        start, dictionary, ids, base = starts[low : low + step], every, padded, 0
        if step < len(starts):  # too many words for a key of 63 bits: those of a stretch are numbered anew
            base = start[0]
            used, ids = np.unique(padded[base : start[-1] + n], return_inverse=True)
            dictionary = every.take(pa.array(used))
        width, keys = len(dictionary), ids[start - base]
        for j in range(1, n):
            keys = keys * width + ids[start - base + j]
        keys.sort()
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        cnt, keys = np.diff(np.r_[new, len(keys)]), keys[new]
        of = [keys]
        for _ in range(1, n):
            rest, digit = np.divmod(of[0], width)
            of[:1] = rest, digit
        del keys, new
        hashes = np.fromiter((zlib.crc32(w.encode()) for w in dictionary.to_pylist()), np.uint64, width)
        mixed = np.zeros(len(cnt), np.uint64)
        for x in of:
            mixed = (mixed ^ hashes[x]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        home = ((mixed >> np.uint64(16)) % np.uint64(groups)).astype(np.uint16 if groups < 1 << 16 else np.int64)
        order = np.argsort(home, kind="stable")
        del mixed
        grams = [dictionary.take(pa.array(x[order])) for x in of]
        grams = (pc.binary_join_element_wise(*grams, " ") if n > 1 else grams[0]).cast(pa.large_string())
        cnt, cuts = cnt[order], np.r_[0, np.cumsum(np.bincount(home, minlength=groups))]
        ends = np.frombuffer(grams.buffers()[1], np.int64, len(grams) + 1, 8 * grams.offset)
        text, lengths = memoryview(grams.buffers()[2]), np.diff(ends)
        some = np.flatnonzero(np.diff(cuts))
        out = [packed(cnt[a:b], lengths[a:b], text[ends[a] : ends[b]]) for a, b in zip(cuts[some], cuts[some + 1])]
        del grams, text, ends, of
        pa.default_memory_pool().release_unused()
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(out, pa.binary())], ["g", "run"])


def bytes_of(texts: DataFrame, column: str = "text") -> int:
    return texts.agg(F.sum(F.octet_length(column)).cast("long")).first()[0] or 0


def counts(texts: DataFrame, n: int = 2, column: str = "text", letters: int | None = None, least: int = 1) -> DataFrame:
    """(ngram, cnt) of at least `least` occurrences, as ngrams.ngram_counts() gives them of the words of each line of the texts.

    letters: about how many bytes all texts have; else they are read once more to tell.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if letters is None:
        letters = bytes_of(texts, column)
    groups = max(texts.sparkSession.sparkContext.defaultParallelism, -(-letters // GROUP_BYTES))

    def run(batches):
        import pyarrow as pa

        held, size = [], 0
        for batch in batches:
            for piece, bytes_ in pieces(batch.column(0), PIECE_BYTES):
                if held and size + bytes_ > PIECE_BYTES:
                    yield from runs_of(pa.concat_arrays(held), n, groups)
                    held, size = [], 0
                held.append(piece)
                size += bytes_
        if held:
            yield from runs_of(pa.concat_arrays(held), n, groups)

    def merged(table):
        import numpy as np
        import pyarrow as pa

        some = [unpacked(x.as_py()) for x in table.column("run")]
        cnt, lengths = (np.concatenate([x[k] for x in some]) for k in (0, 1))
        ends = np.r_[0, np.cumsum(lengths, dtype=np.int64)]
        text = pa.py_buffer(b"".join(x[2] for x in some))
        del some, lengths
        coded = pa.LargeStringArray.from_buffers(len(cnt), pa.py_buffer(ends), text).dictionary_encode()
        del text, ends
        grams, sums = coded.dictionary, np.zeros(len(coded.dictionary), np.int64)
        np.add.at(sums, coded.indices.to_numpy(), cnt)
        del coded, cnt
        pa.default_memory_pool().release_unused()
        if least > 1:
            kept = np.flatnonzero(sums >= least)
            grams, sums = grams.take(pa.array(kept)), sums[kept]
        rows = pa.record_batch([grams.cast(pa.string()), pa.array(sums)], ["ngram", "cnt"])
        return pa.Table.from_batches([rows.slice(k, BATCH) for k in range(0, len(rows), BATCH)], rows.schema)

    return texts.select(column).mapInArrow(run, RUN).groupBy("g").applyInArrow(merged, "ngram string, cnt long")
