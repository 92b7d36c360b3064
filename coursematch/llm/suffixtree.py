"""Language-model scores from a probabilistic suffix tree over words.

States are contexts, runs of up to DEPTH words (the bound L that such a tree has by definition). Every context that stands
LEAST_CONTEXT times in the training texts is a candidate, whether or not its suffixes are states. It is kept if its next-word distribution
diverges enough from that of its longest proper suffix. A kept state holds the next words that stand LEAST times after it,
discounted; the mass it takes off goes to the suffix's distribution, down to the smoothed word counts at the root.
So the corpus is read once for each length and once to score, whatever is in it.

The tree grows with the corpus, so counts, states and probabilities are Spark tables. A run's value is its log10
probability less that of its suffix and its context's weight, and, if it is a state itself, its own weight: the
values of all runs that end at a token sum up to the token's log10 probability. So the texts' runs are looked
up in one table and summed by document. Runs travel as packed numbers, a row for each task and bucket of keys, and meet
in grouped (counts) or cogrouped (scores) tasks. The most frequent runs (HEAD, a bounded number) go to every executor, and
bitmaps of bounded size tell most runs that are not in the table; both only save shuffling.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import LOWER, POWER, Store, mix, partitions, slices, words

DEPTH = 3                   # words of a context, at most
LEAST = 2                   # times of a context with its next word
LEAST_CONTEXT = 4           # times of a context
HEAD = 1e-6                 # share of the training tokens of a run whose value goes to every executor
SIEVE = 27                  # log2 of a bitmap's bits
DISCOUNT = 0.75
DIVERGENCE = 0.01           # nats of a kept context against its suffix
FLUSH = 1 << 21             # tokens counted or scored together in a task
SLICE = 1 << 18             # bytes of text looked at together, that fit a cache
DOCS = 1 << 14              # documents scored together, so that a short tells their places
BUCKET = 1 << 22            # training tokens for each bucket of keys
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
END = mix(np.array([0x454E44], np.uint64)).view(np.int64)[0]


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end, and each text's first token."""
    _, h, first = words(LOWER[data], offs)
    return np.insert(h.view(np.int64), first[1:], END), first + np.arange(len(first))


def find(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The place of each x among the keys, or -1."""
    if not len(sorted_keys):
        return np.full(len(x), -1)
    i = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return np.where(sorted_keys[i] == x, i, -1)


class Index:
    """Sorted keys by their upper bits, to look many up: hashes, so that few share a cell."""

    def __init__(self, keys: np.ndarray):
        keys = keys.view(np.uint64)
        self.shift = np.uint64(64 - max(1, int(4 * len(keys)).bit_length()))
        self.order = np.argsort(keys)
        self.keys = np.append(keys[self.order], np.uint64(0))
        cells = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64)
        self.start = np.append(np.searchsorted(self.keys[:-1] >> self.shift, cells), len(keys)).astype(np.int32)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each x among the keys as given, or -1."""
        x = x.view(np.uint64)
        cell = (x >> self.shift).view(np.int64)
        at, end = self.start[cell], self.start[cell + 1]
        out = np.full(len(x), -1)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            same = self.keys[here] == x[left]
            out[left[same]] = self.order[here[same]]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


def grams(t: np.ndarray, first: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the runs of m words that end at each token, of their contexts and of their suffixes, and whether
    the run lies in its text. A key is made of the keys of context and suffix; that of one word is its hash."""
    k, ctx, suf = t, t, t
    left = np.arange(len(t)) - np.repeat(first[:-1], np.diff(first))
    for j in range(2, m + 1):
        ctx, suf = np.roll(k, 1), k
        k = key(ctx, suf)
    return k, ctx, suf, left >= m - 1


def key(ctx: np.ndarray, suf: np.ndarray) -> np.ndarray:
    return mix(ctx.view(np.uint64) * POWER[3] + suf.view(np.uint64) * POWER[5]).view(np.int64)


def bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap of 2^SIEVE bits with two of each ``k``, from its low bits and those above: what is not in it needs no shuffle."""
    x = F.explode(F.array(*(F.shiftrightunsigned("k", by).bitwiseAND(F.lit((1 << SIEVE) - 1)) + 1 for by in (0, SIEVE)))).alias("x")
    rows = keys.select(x).groupBy(F.bitmap_bucket_number("x").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits")).collect()
    out = np.zeros(1 << (SIEVE - 3), np.uint8)
    for r in rows:
        at = (r.b - 1) * 4096
        out[at: at + 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def sieved(bits: np.ndarray, k: np.ndarray) -> np.ndarray:
    has = lambda x: (bits[x >> 3] >> (x & 7).astype(np.uint8)) & 1 > 0
    out = has(k & ((1 << SIEVE) - 1))
    first = np.flatnonzero(out)
    out[first] = has(k[first] >> SIEVE & ((1 << SIEVE) - 1))
    return out


def buckets_of(k: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key, a range of keys; ``_bucket`` is the same of a column."""
    return ((k.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _bucket(k, buckets: int):
    return F.shiftright(F.shiftrightunsigned(k, 32) * F.lit(buckets), 32).cast("int")


def _packed(x: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of x between the ends, each as the bytes of its numbers."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])


def _flat(t: pa.Table, column: str, kind) -> np.ndarray:
    """The numbers of all rows of a packed column; null has none."""
    return np.frombuffer(b"".join(x for x in t[column].to_pylist() if x), kind)


def _lists(order: np.ndarray, of: np.ndarray, buckets: int, **columns: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket that has something, with its part of every column. order: sorts ``of``, the buckets."""
    ends = np.searchsorted(of[order], np.arange(buckets + 1))
    have = np.flatnonzero(np.diff(ends))
    ends = np.append(ends[have], ends[-1])
    return pa.RecordBatch.from_arrays([pa.array(have, pa.int32()), *(_packed(c[order], ends) for c in columns.values())], ["bucket", *columns])


def _firsts(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts the keys, and where in it each distinct one begins."""
    order = np.argsort(k)
    s = k[order]
    return order, np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)


LISTS = "bucket int, ctx binary, suf binary, n binary"


def _counted(m: int, buckets: int, shared=None):
    """Counts of the runs of m words whose context may be in the bitmap, summed within a task as far as they come
    together, as lists a bucket. Words have no context."""
    def run(batches):
        held, n = [], 0

        def flush():
            k, ctx, suf = (np.concatenate(x) for x in zip(*held))
            order, at = _firsts(k.view(np.uint64))
            c = np.diff(np.append(at, len(k))).astype(np.int32)
            one = order[at]
            return _lists(np.arange(len(at)), buckets_of(k[one], buckets), buckets, ctx=ctx[one], suf=suf[one], n=c)

        for _, data, offs in slices(batches, size=SLICE):
            t, first = tokens(data, offs)
            k, ctx, suf, ok = grams(t, first, m)
            if m > 1:
                ok &= sieved(shared.value, ctx)
            held.append((k[ok], ctx[ok], suf[ok]))
            n += len(held[-1][0])
            if n >= FLUSH:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()
    return run


def _summed(m: int, least: int):
    """The runs of a bucket that stand ``least`` times, with their keys."""
    def run(t: pa.Table) -> pa.Table:
        ctx, suf, n = _flat(t, "ctx", np.int64), _flat(t, "suf", np.int64), _flat(t, "n", np.int32)
        k = key(ctx, suf) if m > 1 else suf
        order, at = _firsts(k)
        n = np.add.reduceat(n[order], at, dtype=np.int64)
        one = order[at[n >= least]]
        return pa.table({"k": k[one], "ctx": ctx[one], "suf": suf[one], "n": n[n >= least]})
    return run


def _valued(buckets: int):
    """Values as lists a bucket."""
    def run(batches):
        held, n = [], 0

        def flush():
            k, v, known = (np.concatenate(x) for x in zip(*held))
            of = buckets_of(k, buckets)
            return _lists(np.lexsort((v, of)), of, buckets, k=k, v=v, known=known)       # equal values side by side take less room

        for b in batches:
            held.append([b[c].to_numpy(zero_copy_only=False) for c in ("k", "v", "known")])
            n += b.num_rows
            if n >= FLUSH:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()
    return run


#: A block of documents has one row with their ids and sums, and one for each bucket with the keys to look up, the documents' places and their numbers of keys.
PARTS = "bucket int, block long, key binary, at binary, times binary, doc_id array<long>, n_tokens binary, known binary, base binary, v binary"
SUMS = PARTS.replace("bucket int, ", "").replace("key binary, ", "").replace("times binary, ", "")


def _scores(shared, depth: int, buckets: int):
    """What the most frequent runs give each document, and the other runs that may be in the tables."""
    def run(batches):
        (head, base, v, known), of_states, of_runs = shared.value
        head = Index(head)
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("key", pa.binary()), ("at", pa.binary()), ("times", pa.binary()), ("doc_id", pa.list_(pa.int64())),
                            *((c, pa.binary()) for c in ("n_tokens", "known", "base", "v"))])
        block = TaskContext.get().partitionId() << 32
        held, n, docs = [], 0, 0

        def flush():
            ids, n_tokens, row, k, known_, base, v_ = (np.concatenate(x) if not isinstance(x[0], pa.Array) else pa.concat_arrays(x) for x in zip(*held))
            of = buckets_of(k, buckets)
            order = np.argsort(of, kind="stable")
            found, of, row = _lists(order, of, buckets, key=k), of[order], row[order]
            one = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (of[1:] != of[:-1])])) if len(row) else np.zeros(0, np.int64)
            places = _lists(np.arange(len(one)), of[one], buckets, at=row[one], times=np.diff(np.append(one, len(row))).astype(np.int32))
            filled = [found["bucket"], pa.array(np.full(found.num_rows, block)), found["key"], places["at"], places["times"]]
            yield pa.RecordBatch.from_arrays(filled + [pa.nulls(found.num_rows, f.type) for f in list(schema)[5:]], schema=schema)
            whole = np.array([0, len(n_tokens)])
            own = [pa.ListArray.from_arrays(pa.array(whole, pa.int32()), ids), *(_packed(x, whole) for x in (n_tokens, known_, base, v_))]
            yield pa.RecordBatch.from_arrays([pa.array([block % buckets], pa.int32()), pa.array([block]), *[pa.nulls(1, pa.binary())] * 3, *own], schema=schema)

        for rows, data, offs in slices((b.slice(i, DOCS) for b in batches for i in range(0, b.num_rows, DOCS)), size=SLICE):
            t, first = tokens(data, offs)
            of = np.repeat(np.arange(len(rows)), np.diff(first))
            left = np.arange(len(t)) - np.repeat(first[:-1], np.diff(first))
            sums, more = np.zeros((3, len(rows))), []
            k, state = t, None
            for m in range(1, depth + 1):
                may = left >= m - 1
                if m > 1:
                    # a run of more words has a value behind a kept context only
                    run = np.flatnonzero(np.roll(state, 1) & may)
                    k = key(np.roll(k, 1), k)
                    run = run[sieved(of_runs, k[run])]
                    state = sieved(of_states, k) & may if m < depth else np.zeros(len(k), bool)
                    may = state.copy()
                    may[run] = True
                else:
                    state = sieved(of_states, k)
                may = np.flatnonzero(may)
                i = head.find(k[may])
                got = i >= 0
                at, i = of[may[got]], i[got]
                sums += [np.bincount(at, x[i], minlength=len(rows)) for x in (known, base, v)]
                may = may[~got]
                if m == 1:
                    may = may[state[may] | sieved(of_runs, k[may])]
                more.append((of[may], k[may]))
            row, k = (np.concatenate(x) for x in zip(*more))
            order = np.argsort(row, kind="stable")
            held.append((rows.column(rows.schema.get_field_index("doc_id")), np.diff(first), (row[order] + docs).astype(np.int16), k[order], sums[0].astype(np.int32), sums[1], sums[2]))
            n, docs = n + len(t), docs + len(rows)
            if n >= FLUSH or docs >= DOCS:
                yield from flush()
                held, n, docs = [], 0, 0
                block += 1
        if held:
            yield from flush()
    return run


def _looked_up(parts: pa.Table, values: pa.Table) -> pa.Table:
    """The documents' sums over a bucket's values; rows of documents pass."""
    own = parts.filter(pa.compute.is_valid(parts["doc_id"]))
    asked = parts.filter(pa.compute.is_valid(parts["key"]))
    out = [own.drop_columns(["bucket", "key", "times"])]
    k, v, known = (_flat(values, c, kind) for c, kind in (("k", np.int64), ("v", float), ("known", bool)))
    if asked.num_rows and len(k):
        order, at = _firsts(k)
        names = Index(k[order[at]])
        base, v, known = (np.add.reduceat(x[order], at) for x in (v * known, v, known.astype(np.int32)))
        known = known.astype(np.int32)
        for block, asks, rows, times in zip(asked["block"].to_pylist(), asked["key"], asked["at"], asked["times"]):
            i = names.find(np.frombuffer(asks.as_buffer(), np.int64))
            got = i >= 0
            row, i = np.repeat(np.frombuffer(rows.as_buffer(), np.int16), np.frombuffer(times.as_buffer(), np.int32))[got], i[got]        # in the documents' order
            if not len(row):
                continue
            at = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            whole = np.array([0, len(at)])
            out.append(pa.Table.from_arrays([
                pa.array([block]), _packed(row[at], whole), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.binary()),
                *(_packed(np.add.reduceat(y[i], at, dtype=y.dtype), whole) for y in (known, base, v))], schema=out[0].schema))
    return pa.concat_tables(out)


def _documents(t: pa.Table) -> pa.Table:
    """A block's documents with their whole sums."""
    own, more = t.filter(pa.compute.is_valid(t["doc_id"])), t.filter(pa.compute.is_valid(t["at"]))
    out = {"doc_id": own["doc_id"].combine_chunks().flatten(), "n_tokens": _flat(own, "n_tokens", np.int64)}
    at = _flat(more, "at", np.int16)
    for c, kind in (("known", np.int32), ("base", float), ("v", float)):
        x = _flat(own, c, kind)
        out[c] = x + np.bincount(at, _flat(more, c, kind), minlength=len(x))
    return pa.table(out | {"known": out["known"].astype(np.int64)})


def contexts(grams_of: DataFrame, candidates: DataFrame) -> DataFrame:
    """(ctx, size, back) of the candidates with a next word; back is the log10 weight of those whose next words diverge from
    those of their suffix, else null.

    grams_of: (ctx, n, lower) of each context with a next word; lower is the word's log10 probability under the suffix."""
    n, below = F.col("n"), F.pow(F.lit(10.0), F.col("lower"))
    per = grams_of.groupBy("ctx").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("p"), F.sum(below).alias("b"), F.sum(n * F.log(n / below)).alias("kl"))
    size = F.col("size")
    per = per.join(candidates, "ctx").withColumn("held", (F.col("p") - DISCOUNT * F.col("kinds")) / size).withColumn("p", F.col("p") / size)
    rest, rest_below = F.greatest(1 - F.col("p"), F.lit(1e-12)), F.greatest(1 - F.col("b"), F.lit(1e-12))
    per = per.withColumn("kl", F.col("kl") / size - F.col("p") * F.log(size) + rest * F.log(rest / rest_below))
    kept = (F.col("kl") >= DIVERGENCE) & (2 * size * F.col("kl") >= F.col("kinds") + 3 * F.sqrt(2 * F.col("kinds")))
    return per.select("ctx", "size", F.when(kept, F.log10(1 - F.col("held"))).alias("back"))


def score(documents: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``documents``.

    Learns from the rows whose crc32(doc_id) mod 7 is not 2. Tokens are the words (runs of other bytes than
    ASCII white space, A-Z in lower case) and an end. base_score has the smoothed word counts alone, score the
    tree; both are log10. A null or empty text is an end alone. Rows without a doc_id are scored, not learned
    from, and not held out; repeated rows are learned from as often as they stand. Other columns are not read.
    """
    spark = documents.sparkSession
    sc = spark.sparkContext
    store = Store(spark, "suffixtree")
    part = F.crc32(F.col("doc_id").cast("string")) % 7
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    train = docs.where(part != 2).select("doc_id", "text")

    def put(df: DataFrame, name: str) -> DataFrame:
        """Store a table, and then drop what was shuffled for it."""
        before = spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
        try:
            return store.put(df, name)
        finally:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)

    def counted(m: int, buckets: int, shared=None) -> DataFrame:
        sums = train.mapInArrow(_counted(m, buckets, shared), LISTS).groupBy("bucket").applyInArrow(_summed(m, LEAST if m > 1 else 1), "k long, ctx long, suf long, n long")
        return put(sums if m > 1 else sums.select("k", "n"), f"counts{m}")

    buckets = partitions(spark)
    table = counted(1, buckets)
    whole = table.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, kinds = int(whole[0] or 0), int(whole[1])
    buckets = max(buckets, -(-total // BUCKET))
    root = lambda n: F.log10((n + F.lit(1.0)) / F.lit(float(total + kinds + 1)))
    lower = table.select("k", "n", (F.col("k") == F.lit(int(END))).alias("end"), root(F.col("n")).alias("log"))
    head, lists, of_runs, of_states = [], [], 0, 0

    def keep(values: DataFrame, known: bool) -> np.ndarray:
        """Set the values of a table apart: the most frequent ones' rows, the others as lists; and the bitmap of their keys."""
        often = F.col("n") >= max(1, int(np.ceil(HEAD * total)))
        values = values.withColumn("known", F.lit(known))
        head.append(values.where(often).select("k", "v", "known").toPandas())     # at most 1 / HEAD rows
        rest = values.where(~often).select("k", "v", "known").mapInArrow(_valued(buckets), "bucket int, k binary, v binary, known binary")
        lists.append(put(rest, "values"))
        return bitmap(values.select("k"))

    length = 1
    while length <= DEPTH:
        # a context is a run of the length before, and was counted then
        candidates = lower.where((F.col("n") >= LEAST_CONTEXT) & ~F.col("end")).select(F.col("k").alias("ctx"), F.col("n").alias("size"))
        shared = sc.broadcast(bitmap(candidates.select(F.col("ctx").alias("k"))))
        runs = counted(length + 1, buckets, shared)
        found = put(runs.join(lower.select(F.col("k").alias("suf"), "end", F.col("log").alias("lower")), "suf")
                    .select("k", "ctx", "n", "end", "lower").repartition("ctx"), f"runs{length + 1}")       # so a context's sums are small
        shared.destroy()
        store.drop(runs)
        tried = put(contexts(found, candidates), f"contexts{length}")
        of_states |= keep(tried.where("back is not null").select(F.col("ctx").alias("k"), F.col("size").alias("n"), F.col("back").alias("v")), False)
        of_runs |= keep(lower.select("k", "n", root(F.col("n")).alias("v")) if length == 1 else lower.where("v is not null"), length == 1)
        done = table if length == 1 else lower
        log = F.log10((F.col("n") - DISCOUNT) / F.col("size") + F.pow(F.lit(10.0), F.col("back") + F.col("lower")))
        lower = put(found.join(tried, "ctx")
                    .select("k", "n", "end", F.coalesce(log, "lower").alias("log"), (log - F.col("lower") - F.col("back")).alias("v")), f"logs{length + 1}")
        store.drop(found, tried, done)
        length += 1

    of_runs |= keep(lower.where("v is not null"), False)
    store.drop(lower)
    head = pd.concat(head)
    order, at = _firsts(head["k"].to_numpy(np.int64))
    v, known = head["v"].to_numpy(float), head["known"].to_numpy(float)
    head = [head["k"].to_numpy(np.int64)[order[at]], *(np.add.reduceat(x[order], at) if len(at) else x for x in (v * known, v, known))]
    shared = sc.broadcast((head, of_states, of_runs))
    parts = docs.mapInArrow(_scores(shared, length, buckets), PARTS)
    scored = (parts.groupBy("bucket").cogroup(reduce(DataFrame.unionAll, lists).groupBy("bucket")).applyInArrow(_looked_up, SUMS)
              .groupBy("block").applyInArrow(_documents, "doc_id long, n_tokens long, known long, base double, v double"))
    unseen = (F.col("n_tokens") - F.col("known")) * root(F.lit(0.0))
    return scored.select(
        "doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "n_tokens", F.col("known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + unseen).alias("base_score"), (F.col("v") + unseen).alias("score"))
