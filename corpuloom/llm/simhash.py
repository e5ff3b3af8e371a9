"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at most 3 bits apart have at most 2 differing bits left once a block that holds one of them is blanked
out, and then some value lies within one bit (half that radius) of both. So each distinct fingerprint emits, for each
of three blocks blanked out, the rest of its bits and all variants one bit away: 3 * (1 + 64) - 64 = 131 keys. Rows
that meet at a key are verified by their real distance. A pair meets at several keys; one of them, that any task can
tell from the two fingerprints, reports it, so collisions are deduplicated without a further shuffle.

Equal fingerprints are folded into one before anything is emitted, with their number of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuloom.llm.shared import attach_by_group, components, row_key, slices, stored, without_rows

RADIUS = 3
#: (lowest bit, number of bits) of the blocks that are blanked out in turn.
BLOCKS = ((0, 21), (21, 21), (42, 22))
#: A key with more fingerprints than this is joined in slices over many tasks instead of within its own.
RUN = 2048


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


MASKS = [signed(((1 << 64) - 1) ^ (((1 << n) - 1) << low)) for low, n in BLOCKS]


def bit_majority(hashes: np.ndarray) -> int:
    """The fingerprint of unsigned 64-bit hashes: the bits set in over half of them; none: zero."""
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """Words of the text (A-Z lower-cased) between `[\\x20\\x09-\\x0D]`, shingles of `width` words, XXH64, bit majority."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        return digest(b" ".join(words), seed)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
    return bit_majority(np.array([digest(s, seed) for s in shingles], dtype=np.uint64))


def fingerprints(docs: DataFrame, text: str = "text", id: str = "doc_id", width: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp, row): fp as a signed long, row as in shared.row_key(). Null and empty texts have fingerprint zero."""

    def hashed(batches):
        for batch in slices(batches):
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(x, width, seed) for x in texts], dtype=np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(fps), batch.column(1)], ["id", "fp", "row"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), row_key(text).alias("row"), F.col(text).alias("text")).mapInArrow(hashed, f"id {kind}, fp long, row long")


def key_of(j: int):
    base = F.col("fp").bitwiseAND(F.lit(MASKS[j]))
    return lambda flip: F.struct(F.lit(j).cast("byte").alias("block"), flip.bitwiseXOR(base).alias("key"))


def variants(fps: DataFrame) -> DataFrame:
    """(block, key, fp): every key within one bit of the fingerprint, for each block blanked out."""
    keys = []
    for j, (low, n) in enumerate(BLOCKS):
        flips = [0] + [signed(1 << k) for k in range(64) if not low <= k < low + n]
        keys.append(F.transform(F.array(*[F.lit(x) for x in flips]), key_of(j)))
    return fps.select("fp", F.explode(F.concat(*keys)).alias("v")).select("v.block", "v.key", "fp")


def meeting_key(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The one (block, key) that reports the pair: the first block with a difference; there, the lesser middle."""
    x = a ^ b
    block = np.full(len(x), len(BLOCKS) - 1, dtype=np.int8)
    for j in reversed(range(len(BLOCKS))):
        block[(x & np.uint64(~MASKS[j] & (2**64 - 1))) != 0] = j
    mask = np.array([m & (2**64 - 1) for m in MASKS], dtype=np.uint64)[block]
    rest = x & mask
    low = rest & (~rest + np.uint64(1))  # lowest differing bit
    one, two = (a & mask) ^ low, (b & mask) ^ low
    # One bit left: the middles are the two ends themselves. Two left: each end with the lowest differing bit flipped.
    single = rest == low
    one, two = np.where(single, a & mask, one), np.where(single, b & mask, two)
    return block, np.minimum(one, two)


def linked(a: np.ndarray, b: np.ndarray, block: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which of the pairs are within the radius and reported at this key."""
    near = np.bitwise_count(a ^ b) <= RADIUS
    out = np.zeros(len(a), dtype=bool)
    if near.any():
        at, k = meeting_key(a[near], b[near])
        out[near] = (at == block[near]) & (k == key[near])
    return out


def met(batches):
    """Rows in order of (block, key): verified pairs (a, b, hot=false); members of crowded keys as (fp, key, block, hot=true)."""
    block, key, fp = np.empty(0, np.int8), np.empty(0, np.uint64), np.empty(0, np.uint64)
    crowded = None
    kinds = ["a", "b", "block", "hot"]

    def given(a, b, blocks, hot):
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(blocks, pa.int8()), pa.array(np.full(len(a), hot))], kinds)

    def runs_of(block, key):
        new = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
        return np.concatenate([[0], new]), np.concatenate([new, [len(key)]])

    def within(block, key, fp):
        starts, ends = runs_of(block, key)
        size = ends - starts
        for s in np.unique(size[size > 1]):
            at = starts[size == s]
            if s > RUN:
                for k in at:
                    yield given(fp[k : k + s], key[k : k + s], block[k : k + s], True)
                continue
            i, j = np.triu_indices(s, 1)
            step = max(1, 2_000_000 // len(i))
            for part in (at[k : k + step] for k in range(0, len(at), step)):
                left, right = (part[:, None] + i).ravel(), (part[:, None] + j).ravel()
                ok = linked(fp[left], fp[right], block[left], key[left])
                a, b = fp[left[ok]], fp[right[ok]]
                if len(a):
                    yield given(a, b, block[left[ok]], False)

    for batch in batches:
        new = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy().view(np.uint64)]
        block, key, fp = (np.concatenate(p) for p in zip((block, key, fp), new))
        last = (block[-1], key[-1])
        cut = len(key) - np.argmax(((key != last[1]) | (block != last[0]))[::-1]) if (key[0], block[0]) != (last[1], last[0]) else 0
        if cut:  # whole runs
            if crowded is not None and crowded == (block[0], key[0]):
                n = int(np.argmax((key != key[0]) | (block != block[0])))
                yield given(fp[:n], key[:n], block[:n], True)
                yield from within(block[n:cut], key[n:cut], fp[n:cut]) if cut > n else ()
            else:
                yield from within(block[:cut], key[:cut], fp[:cut])
            crowded = None
            block, key, fp = block[cut:], key[cut:], fp[cut:]
        if len(key) > RUN:  # a crowded key that isn't over: pass its members on, so that memory stays bounded
            yield given(fp, key, block, True)
            crowded = last
            block, key, fp = block[:0], key[:0], fp[:0]
    if len(key):
        if crowded is not None and crowded == (block[0], key[0]):
            yield given(fp, key, block, True)
        else:
            yield from within(block, key, fp)


def crowded_pairs(hot: DataFrame) -> DataFrame:
    """Pairs of the crowded keys: one side sliced, the other sent to every slice, so no task has a whole key's pairs.

    A key of n members has about the root of n slices: a task meets n members with n / slices, and no more than
    n * slices rows are moved.
    """
    hot = hot.withColumn("at", F.struct("block", "key"))
    sizes = hot.groupBy("at").agg(F.count("*").alias("n"), F.ceil(F.sqrt(F.count("*"))).cast("int").alias("slices"))
    sized = stored(attach_by_group(hot, stored(sizes), "at", "n", hot.count()).select("block", "key", "fp", "slices"))
    left = sized.select("block", "key", F.col("fp").alias("a"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    right = sized.select("block", "key", F.col("fp").alias("b"), F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int").alias("slice"))
    near = left.join(right, ["block", "key", "slice"]).where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS))

    def reported(batches):
        for batch in batches:
            block, key, a, b = (batch.column(k).to_numpy() for k in range(4))
            a, b, key = a.view(np.uint64), b.view(np.uint64), key.view(np.uint64)
            yield batch.filter(pa.array(linked(a, b, block, key))).select(["a", "b"])

    return near.select("block", "key", "a", "b").mapInArrow(reported, "a long, b long")


def near_pairs(fps: DataFrame) -> DataFrame:
    """All pairs (a, b) of the distinct fingerprints in column fp that differ in 1 to 3 bits, each once."""
    # A fingerprint becomes 131 rows, so the few bytes of them are dealt out first.
    dealt = fps.repartition(max(fps.sparkSession.sparkContext.defaultParallelism, fps.count() // 250_000))
    spread = variants(dealt).repartition("block", "key").sortWithinPartitions("block", "key")
    found = stored(spread.mapInArrow(met, "a long, b long, block byte, hot boolean"))
    hot = found.where("hot").select("block", F.col("b").alias("key"), F.col("a").alias("fp"))
    return found.where("not hot").select("a", "b").unionByName(crowded_pairs(hot))


def near_dedup(docs: DataFrame, text: str = "text", id: str = "doc_id", width: int = 3, seed: int = 42) -> DataFrame:
    """One row a row of docs: id, fingerprint (16 hex digits), n_near, component_id.

    n_near: other rows whose fingerprint differs in at most 3 bits. component_id: the smallest id reachable over such
    links, the row's own included. Null and empty texts have fingerprint zero and link like any other. Repeated rows
    are rows of their own. A null id is smaller than none: it is never a component_id unless all ids of the component
    are null. An empty table gives an empty table; other columns of docs aren't read.
    """
    out = with_components(docs, text, id, width, seed)
    return out.select(F.col("id").alias(id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "n_near", "component_id")


def with_components(docs: DataFrame, text: str, id: str, width: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp, row, n_near, component_id)."""
    fps = stored(fingerprints(docs, text, id, width, seed))
    classes = stored(fps.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("least")))
    links = stored(near_pairs(classes.select("fp")))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(classes.select(F.col("fp").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("others"))
    member = components(links)  # by fingerprint; the smallest id of each component follows
    placed = classes.join(member.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    placed = stored(placed)
    least = stored(placed.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("fps")))
    groups = attach_by_group(placed, least, "component", "fps", placed.count()).join(degree.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "n", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_near"), "component_id")
    out = attach_by_group(fps, stored(groups), "fp", "n", fps.count())
    return out.select("id", "fp", "row", "n_near", "component_id")


def representatives(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """docs with one document of each component, the one with the smallest id; all columns of docs.

    Of rows equal in id and text one stays. Components without any id keep their rows.
    """
    found = stored(with_components(docs, text, id))
    stays = F.col("id").eqNullSafe(F.col("component_id"))
    repeated = found.where(stays & (F.col("n_near") > 0)).groupBy("id", "row").agg(F.count("*").alias("n")).where("n > 1")
    return without_rows(docs, found.where(~stays), repeated, text, id)
