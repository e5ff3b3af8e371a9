"""What the operators share: the cluster's shared folder, joins that a hot key can't stall, components."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuloom.sources.workspace import delete, new_path, shared_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: lineage ends in the shared folder, so a lost executor costs only its tasks."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


_TABLES: list[tuple[str, str]] = []


def drop_tables(spark: SparkSession, since: int = 0) -> None:
    """Deletes the tables that stored() wrote for this application: to be called once all results are written.

    since: the number of tables there were before, to delete only those written after that.
    """
    app = spark.sparkContext.applicationId
    for found in [x for x in _TABLES[since:] if x[0] == app]:
        delete(spark, found[1])
        _TABLES.remove(found)


def tables_written() -> int:
    return len(_TABLES)


def table_path(spark: SparkSession, name: str = "table") -> str:
    """A new path in the shared folder that drop_tables() deletes."""
    path = new_path(spark, name)
    _TABLES.append((spark.sparkContext.applicationId, path))
    return path


def stored(df: DataFrame) -> DataFrame:
    """df written once as Parquet in the shared folder and read back: compressed, columnar and safe against lost executors."""
    spark = df.sparkSession
    path = table_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A filter has at most this many rows of 64 bits, so it may be broadcast whatever the corpus: 262,144 rows, some 10 MB.
FILTER_ROWS = 1 << 18


def filter_of(keys: Column, rows: DataFrame, filter_rows: int = FILTER_ROWS) -> DataFrame:
    """A Bloom filter of the keys (longs) as a stored table (place, bits) of at most filter_rows rows.

    Past some ten keys a row it lets most others through as well: what it is used for takes more time then and stays right.
    """
    slot = F.pmod(keys, F.lit(64 * filter_rows))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))
    return stored(rows.select(F.shiftright(slot, 6).alias("place"), bit.alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits")))


def may_hold(rows: DataFrame, keys: Column, bloom: DataFrame, filter_rows: int = FILTER_ROWS) -> DataFrame:
    """rows with the column may_hold: false where the filter is sure that the key isn't among those it was made of."""
    slot = F.pmod(keys, F.lit(64 * filter_rows))
    bits = bloom.withColumnsRenamed({"place": "__place", "bits": "__bits"})
    joined = rows.withColumn("__slot", slot).join(F.broadcast(bits), F.shiftright("__slot", 6) == F.col("__place"), "left")
    hit = F.getbit(F.coalesce("__bits", F.lit(0).cast("long")), F.pmod("__slot", F.lit(64)).cast("int")) == 1
    return joined.withColumn("may_hold", hit).drop("__slot", "__place", "__bits")


def inner_names(docs: DataFrame) -> DataFrame:
    """docs with the columns c0, c1, ...: whatever docs calls its own, nothing here clashes with it."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])


def row_key(text: str) -> Column:
    """With the id, what rows are told apart by where texts shouldn't travel."""
    return F.xxhash64(F.col(text))


def without_rows(docs: DataFrame, gone: DataFrame, repeated: DataFrame, text: str, id: str) -> DataFrame:
    """docs without the rows in gone, and with one each of those in repeated; both are (id, row) with row_key().

    A filter of bounded size tells which rows can't be in either: they stay where they are. The others are shuffled
    and joined, at every size in the same way.
    """
    rows = inner_names(docs)
    c_id, c_text = (f"c{docs.columns.index(c)}" for c in (id, text))
    keys = gone.select("id", "row", F.lit(1).alias("drop")).unionByName(repeated.select("id", "row", F.lit(0).alias("drop")))
    keys = stored(keys.groupBy(F.col("id").alias("k_id"), F.col("row").alias("k_row")).agg(F.max("drop").alias("drop")))
    rows = may_hold(rows.withColumn("k", row_key(c_text)), F.col("k"), filter_of(F.col("k_row"), keys))
    some = rows.where("may_hold").join(keys.hint("merge"), F.col(c_id).eqNullSafe(F.col("k_id")) & (F.col("k") == F.col("k_row")), "left").where("drop is null or drop = 0")
    names = [f"c{k}" for k in range(len(docs.columns))]
    once = some.where("drop = 0").select(*names).dropDuplicates([c_id, c_text])
    return rows.where("not may_hold").select(*names).unionByName(some.where("drop is null").select(*names)).unionByName(once).toDF(*docs.columns)


def slices(batches, rows: int = 256):
    """Arrow batches in slices of few rows, so that a worker holds few texts as Python objects at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
    pa.default_memory_pool().release_unused()


class Recent(dict):
    """A dict of bounded size for __missing__ to fill: when it is full its entries become the older half, and those
    asked for again move up; so what is frequent stays."""

    def __init__(self, most: int):
        super().__init__()
        self.half, self.older = max(1, most // 2), {}

    def keep(self, key, value):
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def attach_by_group(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int, most_hot: int = 1024) -> DataFrame:
    """rows left join groups on key, where groups has one row a key and its number of rows in `size`.

    A key that holds more than n_rows / most_hot rows goes through a broadcast join: there are fewer than
    most_hot such keys whatever the input, so the broadcast has a proven bound. All other keys are shuffled.
    """
    hot_at = n_rows // most_hot
    hot = groups.where(F.col(size) > hot_at)
    rest = groups.where(F.col(size) <= hot_at)
    hot_keys = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(hot_keys, key, "left_anti").join(rest, key, "left"))


def local_forest(batches, most_nodes: int = 1_000_000):
    """Union-find over the edges (u, v) of one partition; gives (node, smallest node reached) without loops.

    Memory is bounded: after most_nodes nodes the forest so far is given out and a new one begun.
    """
    parent: dict = {}

    def find(x):
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root and x != root:
            parent[x], x = root, up
        return root

    def given(kind):
        nodes = list(parent)
        roots = [find(x) for x in nodes]
        return pa.record_batch([pa.array(nodes, kind), pa.array(roots, kind)], ["u", "v"])

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                low, high = (a, b) if a < b else (b, a)
                parent[high] = low
        if len(parent) > most_nodes:
            yield given(kind)
            parent.clear()
    if parent:
        yield given(kind)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges in the first two columns (no nulls): (node, component).

    component is the smallest node reachable; nodes without an edge to another node aren't in the result.
    Each partition first contracts its own edges to a forest, then large-star and small-star rounds run
    until nothing changes; each round ends in a reliable checkpoint. Strings compare by code point.
    """
    a, b = edges.columns[:2]
    kind = edges.schema[a].dataType.simpleString()
    least, most = F.least("u", "v"), F.greatest("u", "v")
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").mapInArrow(local_forest, f"u {kind}, v {kind}")
    pairs = checkpointed(pairs.select(most.alias("u"), least.alias("v")).distinct())

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(pairs)
    for _ in range(most_rounds):
        # Neighbours' minima are folded map-side. A node that stands behind many edges (the root of a giant component)
        # gets its minimum by broadcast: fewer than 1,024 nodes hold over 1/1,024 of the edges.
        up = pairs.groupBy("u").agg(F.min("v").alias("m"))
        behind = pairs.groupBy("v").agg(F.count("*").alias("n"))
        above = behind.join(up.withColumnRenamed("u", "v"), "v", "left")
        large = attach_by_group(pairs, above, "v", "n", before[0]).select("u", F.coalesce("m", "v").alias("v")).distinct()
        up = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(up, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        pairs = checkpointed(small)
        after = state(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

