"""Shared helpers: stored intermediates, Arrow text buffers, word hashing, grouped Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from coursematch.config import checkpoint_dir
from coursematch.operators.ranges import running_sum

CHUNK_BYTES = 1 << 20


class Store:
    """Intermediate tables of one run, under the folder that spark.checkpoint.dir names.

    A written table cuts the lineage, and it survives the loss of an executor. Tables that only an
    earlier step needs are removed with ``drop``; those that the lazily returned result still reads
    stay, as a checkpoint would, for the owner of the folder to clear.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
        self.n = 0

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back."""
        self.n += 1
        path = f"{self.root}/{self.n:02d}-{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._llm_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that ``put`` has written."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._llm_path)
            path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(documents: DataFrame, store: Store, text: str = "text", key: str = "_row_key") -> tuple[DataFrame, DataFrame | None]:
    """``documents`` with a long that tells its texts apart and sorts like doc_id: doc_id itself where no doc_id has two
    texts (repeated rows have one), else the place of (doc_id, text digest) in their order, with the table (key, doc_id) behind
    it. NULL doc_ids have a NULL key."""
    id_ = F.col("doc_id").cast("long")
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))
    ids = documents.where("doc_id is not null").select(id_.alias("doc_id"), digest.alias("md"))
    if ids.groupBy("doc_id").agg(F.min("md").alias("a"), F.max("md").alias("b")).where("a != b").isEmpty():
        return documents.withColumn(key, id_), None
    table = store.put(ids.distinct().withColumn("all", F.lit(0)), "ids")
    names = store.put(running_sum(table, ["all"], ["doc_id", "md"], F.lit(1).cast("long"), "_k").drop("all"), "keys")
    names_of = names.select(F.col("doc_id").alias("_d"), F.col("md").alias("_m"), F.col("_k").alias(key))
    rows = documents.join(names_of, (id_ == F.col("_d")) & (digest == F.col("_m")), "left").drop("_d", "_m")
    return rows, names.select(F.col("_k").alias("key"), "doc_id")


# ---------------------------------------------------------------- text buffers

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


#: A value for each byte and a power for each place in a word.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
POWER = np.cumprod(np.full(1 << 16, 0xD1342543DE82EF95, dtype=np.uint64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``size`` text bytes (a longer text makes a run of its own):
    the rows, their bytes, and the rows' offsets in them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offs = buffers(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
            yield batch.slice(at, to - at), data[offs[at]: offs[to]], offs[at: to + 1] - offs[at]
            at = to


def words(data: np.ndarray, offs: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word spans that never cross rows: starts, 64-bit hashes, and for each row its first word's number."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    sep = separators[data]
    start = ~sep
    start[1:] &= sep[:-1]
    heads = offs[:-1][offs[:-1] < offs[1:]]
    start[heads] = ~sep[heads]
    starts = np.flatnonzero(start)
    if not len(starts):
        return starts, np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    place = np.arange(n, dtype=np.int64)
    place -= np.maximum.accumulate(np.where(start, place, 0))
    value = BYTE[data]
    value *= POWER[place & 0xFFFF]
    value[sep] = 0
    return starts, mix(np.add.reduceat(value, starts)), np.searchsorted(starts, offs)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words of each row; a row of fewer words has them all as one run.
    Returns the hashes and, for each row, the number of its first one."""
    n_words = np.diff(first)
    n = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(bounds[-1], np.uint64)
    if not len(hashes):
        return out, bounds
    row = np.repeat(np.arange(len(n)), n)
    at = first[:-1][row] + (np.arange(bounds[-1]) - bounds[:-1][row])
    length = np.minimum(n_words, k)[row]
    for j in range(k):
        have = j < length
        out += np.where(have, hashes[np.minimum(at + j, len(hashes) - 1)], np.uint64(0)) * POWER[j + 7]
    return mix(out + length.astype(np.uint64)), bounds


# ---------------------------------------------------------------- groups

def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys, in batches sorted by them. Holds one batch and one run."""
    held: list[pa.Table] = []

    def same(a: pa.Table, b: pa.Table) -> bool:
        return all(a[k][a.num_rows - 1].as_py() == b[k][0].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        cut = np.zeros(t.num_rows, bool)
        for k in keys:
            v = t[k].to_numpy()
            cut[1:] |= v[1:] != v[:-1]
        cut[0] = bool(held) and not same(held[-1], t)
        edges = [*np.flatnonzero(cut), t.num_rows]
        if edges[0] > 0:
            held.append(t.slice(0, edges[0]))
        for a, b in zip(edges, edges[1:]):
            if held:
                yield pa.concat_tables(held)
            held = [t.slice(a, b - a)]
    if held:
        yield pa.concat_tables(held)


class Forest:
    """Union-find over small integers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        """Whether a and b were apart."""
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that hold whole runs of equal keys, from batches sorted by the key."""
    held: list[pa.Table] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        held.append(t)
        n += t.num_rows
        if n < rows:
            continue
        t = pa.concat_tables(held)
        v = t[key].to_numpy()
        edges = np.flatnonzero(v[1:] != v[:-1]) + 1
        cut = int(edges[-1]) if len(edges) else 0
        if cut:
            yield t.slice(0, cut)
        held, n = [t.slice(cut)], t.num_rows - cut
    if n:
        yield pa.concat_tables(held)
