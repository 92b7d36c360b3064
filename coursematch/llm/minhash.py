"""MinHash near-duplicates: circulant signatures, banding, exact Jaccard, components.

Two permutations make the whole signature. The first scatters the shingles over a circle of 2^32
places; the second ranks the places, and coordinate k is the lowest rank after all places have moved
on by k. Documents whose rows of a band agree share a bucket; all links are confirmed on full sets.

A group of near copies may hold a third of the rows, so its pairs are never listed. Equal sets are one
class with one representative. Within a bucket every representative is held against the bucket's leader
(the set with most copies), which joins most of a group. Only buckets whose members still belong to
different components go on: their members outside the bucket's largest component are held against all
members, in blocks of bounded size inside tasks, and each block gives only links that connect it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import LOWER, Forest, Store, grouped, keyed, mix, partitions, shingles, slices, words
from coursematch.llm.components import components

ROWS = 4            # signature coordinates in a band
MISS = 1e-5         # chance that a pair just at the threshold shares no band
BLOCK = 128         # representatives in a block


def bands(similarity: float) -> int:
    """Bands so that a pair at the threshold is missed with a chance of at most MISS."""
    return math.ceil(math.log(MISS) / math.log1p(-similarity ** ROWS))


def scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation's place on the circle of a 64-bit shingle."""
    return (mix(x ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def rank(x: np.ndarray) -> np.ndarray:
    """The second permutation: a bijection of the 2^32 places."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], size: int, chunk: int = 1 << 15) -> np.ndarray:
    """Circulant signatures of non-empty sets, one row each. Works through runs of sets that fit the cache."""
    out = np.empty((len(sets), size), np.uint32)
    at = 0
    while at < len(sets):
        to, n = at, 0
        while to < len(sets) and (to == at or n + len(sets[to]) <= chunk):
            n += len(sets[to])
            to += 1
        places = scatter(np.concatenate(sets[at:to]))
        heads = np.cumsum([0, *(len(s) for s in sets[at: to - 1])])
        for k in range(size):
            out[at:to, k] = np.minimum.reduceat(rank(places + np.uint32(k)), heads)
        at = to
    return out


def band_keys(sig: np.ndarray, n_bands: int) -> np.ndarray:
    """A 64-bit bucket key for each row of sig and band; the band's number is part of it."""
    key = np.zeros((len(sig), n_bands), np.uint64) + np.arange(1, n_bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        key = mix(key + sig[:, r::ROWS][:, :n_bands])
    return key.view(np.int64)


def shingle_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows and their sorted sets of shingle hashes (64-bit)."""
    for rows, data, offs in slices(batches):
        _, h, first = words(LOWER[data], offs)
        s, bounds = shingles(h, first, k)
        yield rows, [np.unique(s[a:b]) for a, b in zip(bounds, bounds[1:])]


def _describe(k: int, n_bands: int):
    def run(batches):
        for rows, sets in shingle_sets(batches, k):
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(signatures([sets[i] for i in full], n_bands * ROWS), n_bands) if full else np.zeros((0, n_bands))
            at, bands_of = 0, [None] * len(sets)
            for j, i in enumerate(full):
                bands_of[i] = keys[j].tolist()
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
                pa.array(bands_of, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "bands"])
    return run


def _sets(k: int):
    def run(batches):
        for rows, sets in shingle_sets(batches, k):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "shingles"])
    return run


def overlaps(queries: list[np.ndarray], members: list[np.ndarray], cells: int = 1 << 22) -> np.ndarray:
    """Intersection sizes of all queries with all members (sorted sets)."""
    if len(queries) * len(members) <= 16:
        return np.array([[len(np.intersect1d(q, m, assume_unique=True)) for m in members] for q in queries])
    vocab, code = np.unique(np.concatenate(queries), return_inverse=True)
    out = np.zeros((len(queries), len(members)), np.int64)
    q_row = np.repeat(np.arange(len(queries)), [len(q) for q in queries])
    flat = np.concatenate(members)
    m_row = np.repeat(np.arange(len(members)), [len(m) for m in members])
    m_code = np.minimum(np.searchsorted(vocab, flat), len(vocab) - 1)
    hit = vocab[m_code] == flat
    m_row, m_code = m_row[hit], m_code[hit]
    width = max(1, cells // (len(queries) + len(members)))
    for a in range(0, len(vocab), width):
        q = np.zeros((len(queries), width), np.float32)
        m = np.zeros((len(members), width), np.float32)
        x = (code >= a) & (code < a + width)
        q[q_row[x], code[x] - a] = 1
        x = (m_code >= a) & (m_code < a + width)
        m[m_row[x], m_code[x] - a] = 1
        out += (q @ m.T).astype(np.int64)
    return out


def _links(num: int, den: int):
    """Confirmed links of each group (g, i, j): those that connect its queries to its members."""
    def run(batches):
        for t in grouped(batches, ["g", "i", "j"]):
            rep, comp = t["rep"].to_numpy(), t["comp"].to_numpy()
            query = t["query"].to_numpy()
            member = t["member"].to_numpy()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["shingles"]]
            qs, ms = np.flatnonzero(query), np.flatnonzero(member)
            if not len(qs) or not len(ms):
                continue
            size = np.array([len(s) for s in sets])
            common = overlaps([sets[x] for x in qs], [sets[x] for x in ms])
            union = size[qs][:, None] + size[ms] - common
            found = (common * den >= num * union) & (comp[qs][:, None] != comp[ms])
            forest, a, b = Forest(len(rep)), [], []
            for x, y in zip(*np.nonzero(found)):
                if forest.join(int(qs[x]), int(ms[y])):
                    a.append(rep[qs[x]])
                    b.append(rep[ms[y]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _compare(rows: DataFrame, num: int, den: int) -> DataFrame:
    spark = rows.sparkSession
    cols = rows.select("g", "i", "j", "rep", "comp", "query", "member", "shingles")
    return (cols.repartition(partitions(spark), "g", "i", "j").sortWithinPartitions("g", "i", "j")
            .mapInArrow(_links(num, den), "a long, b long"))


def near_duplicates(documents: DataFrame, words_per_shingle: int = 5, similarity: str = "0.8", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document.

    Words are runs of other bytes than ASCII white space, after lower-casing A-Z. A document of fewer
    words than a shingle has its whole sequence as one shingle; one without words (or with a null text)
    links with nothing. ``similarity`` is a decimal string, compared exactly. component_id is the
    smallest doc_id reachable by links; kept marks it. A document without a doc_id belongs to no
    component and is kept. Repeated rows of one doc_id each come back; different texts of one doc_id are
    documents of their own, each with its own links. Extra columns are not read.
    Whole texts are read; no bucket is cut short.
    """
    store = Store(documents.sparkSession, "minhash")
    rows, names = keyed(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")), store)
    found = _classified(rows.select("_row_key", "text"), words_per_shingle, similarity, store)
    if names is None:
        found = found.withColumnRenamed("key", "doc_id")
    else:
        least = names.select(F.col("key").alias("component_id"), F.col("doc_id").alias("_c"))
        found = (found.join(names, "key", "left").join(least, "component_id", "left")
                 .select("doc_id", "n_shingles", F.col("_c").alias("component_id")))
    return (found.select("doc_id", "n_shingles", "component_id")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def without_near_duplicates(documents: DataFrame, words_per_shingle: int = 5, similarity: str = "0.8", text: str = "text") -> DataFrame:
    """The rows of ``documents`` of which no near-duplicate comes earlier: one text of each component, that of the smallest
    doc_id (of several texts of that doc_id, the one of the smallest digest). Its repeated rows, and rows without a doc_id, stay."""
    store = Store(documents.sparkSession, "minhash")
    rows, _ = keyed(documents, store, text)
    found = _classified(rows.select("_row_key", F.col(text).alias("text")), words_per_shingle, similarity, store)
    gone = found.where("key != component_id").select(F.col("key").alias("_row_key")).distinct()
    return rows.join(gone, "_row_key", "left_anti").select(documents.columns)


def _classified(rows: DataFrame, words_per_shingle: int, similarity: str, store: Store) -> DataFrame:
    """(key, n_shingles, component_id) for rows (key, text): the component is its smallest key."""
    spark = rows.sparkSession
    limit = Fraction(similarity)
    num, den = limit.numerator, limit.denominator
    n_bands = bands(float(limit))
    docs = rows.toDF("doc_id", "text")

    described = store.put(docs.mapInArrow(_describe(words_per_shingle, n_bands), "doc_id long, n_shingles long, digest binary, bands array<long>"), "described")
    known = described.where("doc_id is not null and n_shingles > 0")
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    classes = store.put(classes, "classes")

    places = classes.select("rep", "copies", F.posexplode("bands").alias("band", "key"))
    stats = (places.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(-F.col("copies"), "rep")).alias("top"))
             .where("n > 1").select("key", F.col("top.rep").alias("leader")))
    buckets = store.put(places.join(stats, "key").select("key", "band", "rep", "leader"), "buckets")
    wanted = buckets.select("rep").distinct()
    sets = store.put(docs.join(wanted, docs.doc_id == wanted.rep, "left_semi").dropDuplicates(["doc_id"])
                     .mapInArrow(_sets(words_per_shingle), "rep long, shingles binary"), "sets")

    # leaders: one group for each leader and block of members
    pairs = buckets.where("rep != leader").select("rep", "leader").distinct()
    sized = pairs.join(pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("n")), "leader")
    dealt = sized.select(F.col("leader").alias("g"), "rep", F.lit(0).alias("i"),
                         F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / BLOCK)).cast("int").alias("j"))
    members = dealt.select("g", "i", "j", "rep", F.col("rep").alias("comp"), F.lit(False).alias("query"), F.lit(True).alias("member"))
    heads = dealt.select("g", "i", "j").distinct().select("g", "i", "j", F.col("g").alias("rep"), F.col("g").alias("comp"), F.lit(True).alias("query"), F.lit(False).alias("member"))
    first = store.put(_compare(members.unionAll(heads).join(sets, "rep"), num, den), "first")
    comp = store.put(components(first, store), "comp")

    # buckets that still hold several components: the rest against all, in blocks
    rows = store.put(buckets.join(comp, buckets.rep == comp.node, "left")
                     .select("key", "band", "rep", F.coalesce("component", "rep").alias("comp")), "rows")
    per = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = (per.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("big"))
             .where("parts > 1").select("key", F.col("big.comp").alias("big"),
                                        F.ceil((F.col("n") - F.col("big.n")) / BLOCK).cast("int").alias("nq"), F.ceil(F.col("n") / BLOCK).cast("int").alias("nm")))
    held = rows.join(mixed, "key").withColumn("h", F.xxhash64("rep")).withColumn("query", F.col("comp") != F.col("big"))
    as_member = held.select("key", "rep", "comp", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("i"), F.pmod("h", "nm").cast("int").alias("j"), F.lit(False).alias("query"), F.lit(True).alias("member"))
    as_query = held.where("query").select("key", "rep", "comp", F.pmod("h", "nq").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nm") - 1)).alias("j"), F.lit(True).alias("query"), F.lit(False).alias("member"))
    both = (as_member.unionAll(as_query).groupBy(F.col("key").alias("g"), "i", "j", "rep", "comp")
            .agg(F.max("query").alias("query"), F.max("member").alias("member")))
    second = store.put(_compare(both.join(sets, "rep"), num, den), "second")
    component = components(first.unionAll(second), store)

    of_class = (classes.join(component, classes.rep == component.node, "left")
                .select("digest", F.coalesce("component", "rep").alias("component_id")))
    return (described.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
            .join(of_class, "digest", "left")
            .select(F.col("doc_id").alias("key"), "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
