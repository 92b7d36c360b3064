"""Embedding near-duplicates: random-hyperplane sign hashing in several tables, exact cosines, components.

Equal vectors are one class. Each table cuts the space by its own hyperplanes; classes with the same
signs share a bucket. A bucket's classes are compared in blocks of bounded size inside tasks, in double
precision, and a pair counts only in the first table that brings it together. A block gives each class's
number of linked vectors and only as many links as connect it, never its list of pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import Forest, Store, grouped, partitions
from coursematch.llm.components import components

MISS = 1e-5      # chance that a pair just at the threshold meets in no table
BUCKET = 256     # vectors wanted in a bucket
MIN_BITS = 8
BLOCK = 512      # classes in a block


def tables(n: int, cosine: float) -> tuple[int, int]:
    """Hyperplanes in a table and tables for n vectors: buckets keep their size as n grows."""
    bits = min(62, max(MIN_BITS, math.ceil(math.log2(max(n, 1) / BUCKET))))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-same))


def planes(dim: int, bits: int, n_tables: int, seed: int = 11) -> np.ndarray:
    """The normals, (dim, n_tables * bits): the same in every task."""
    return np.random.default_rng([seed, dim]).standard_normal((n_tables * bits, dim)).T


def codes(x: np.ndarray, bits: int, n_tables: int) -> np.ndarray:
    """The bucket of each vector in each table."""
    sign = (x @ planes(x.shape[1], bits, n_tables) > 0).reshape(len(x), n_tables, bits)
    return sign @ (1 << np.arange(bits, dtype=np.int64))


def matrix(column) -> np.ndarray:
    """Rows of a list column of one length, in double precision, each scaled by the power of two of its largest entry (which
    changes no cosine, and keeps norms and projections of very large and very small vectors finite)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    power = np.frexp(np.abs(x).max(axis=1, initial=0))[1]
    return np.ldexp(x, -power[:, None])


def _dealt(bits: int, n_tables: int):
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims):
                rows = batch.filter(pa.array(dims == d))
                c = codes(matrix(rows.column("embedding")), bits, n_tables)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(rows.column("rep").to_numpy(), n_tables)), pa.array(np.repeat(rows.column("dim").to_numpy(), n_tables)),
                    pa.array(np.tile(np.arange(n_tables, dtype=np.int32), len(rows))), pa.array(c.reshape(-1))], ["rep", "dim", "tab", "code"])
    return run


def _links(bits: int, n_tables: int, cosine: float):
    def run(batches):
        for t in grouped(batches, ["dim", "tab", "code", "i", "j"]):
            if t.num_rows < 2:
                continue
            rep, copies, part = t["rep"].to_numpy(), t["copies"].to_numpy(), t["part"].to_numpy()
            x = matrix(t["embedding"])
            c = codes(x, bits, n_tables)
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            tab, i, j = (t[k][0].as_py() for k in ("tab", "i", "j"))
            left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
            found = unit[left] @ unit[right].T >= cosine
            if i == j:
                found = np.triu(found, 1)
            a, b = np.nonzero(found)
            a, b = left[a], right[b]
            new = ~(c[a, :tab] == c[b, :tab]).any(axis=1)
            a, b = a[new], b[new]
            if not len(a):
                continue
            n = np.zeros(len(rep), np.int64)
            np.add.at(n, a, copies[b])
            np.add.at(n, b, copies[a])
            forest, to = Forest(len(rep)), np.full(len(rep), -1, np.int64)
            extra: list[tuple[int, int]] = []
            for p, q in zip(a.tolist(), b.tolist()):
                if forest.join(p, q):
                    extra.append((p, q))
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([*rep[hit], *(rep[p] for p, _ in extra)], pa.int64()), pa.array([*([None] * len(hit)), *(int(rep[q]) for _, q in extra)], pa.int64()),
                pa.array([*n[hit], *([0] * len(extra))], pa.int64())], ["a", "b", "n"])
    return run


def near_vectors(embeddings: DataFrame, cosine: float = 0.9, vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    n_links counts the other vectors with a cosine of at least ``cosine``; component_id is the smallest
    vec_id reachable. Vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing, and so do vectors of different lengths with each other. A row without a vec_id links
    with nothing and is kept; repeated rows of a vec_id count as vectors of their own. Other columns are
    not read. Pairs are found with a chance of at least 1 - MISS at the threshold, more above it.
    """
    spark = embeddings.sparkSession
    store = Store(spark, "hyperplane")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    sound = (F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
             & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
             & F.exists("embedding", lambda v: v != 0))
    # -0.0 and 0.0 are the same component; classes are keyed by the vector itself
    good = rows.where(F.coalesce(sound, F.lit(False))).withColumn("embedding", F.transform("embedding", lambda v: v + F.lit(0.0)))
    classes = store.put(good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                        .select("rep", "copies", F.size("embedding").alias("dim"), "embedding"), "classes")
    bits, n_tables = tables(classes.count(), cosine)

    dealt = classes.select("rep", "dim", "embedding").mapInArrow(_dealt(bits, n_tables), "rep long, dim int, tab int, code long")
    dealt = store.put(dealt, "dealt")
    size = (dealt.groupBy("dim", "tab", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int")))
    placed = (dealt.join(size, ["dim", "tab", "code"]).withColumn("part", F.pmod(F.xxhash64("rep", "tab"), "parts").cast("int"))
              .select("rep", "dim", "tab", "code", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
              .select("rep", "dim", "tab", "code", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")))
    keys = ["dim", "tab", "code", "i", "j"]
    found = (placed.join(classes.select("rep", "copies", "embedding"), "rep").repartition(partitions(spark), *keys).sortWithinPartitions(*keys)
             .select(*keys, "rep", "copies", "part", "embedding").mapInArrow(_links(bits, n_tables, cosine), "a long, b long, n long"))
    found = store.put(found, "found")
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    comp = components(found.where("b is not null").select("a", "b"), store)
    result = (classes.select("rep", "copies", "embedding").join(counts, "rep", "left").join(comp, F.col("rep") == comp.node, "left")
              .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    keyed = rows.withColumn("key", F.when(F.coalesce(sound, F.lit(False)), F.transform("embedding", lambda v: v + F.lit(0.0))))
    return (keyed.select("vec_id", "key").join(result.withColumnRenamed("embedding", "key"), "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
