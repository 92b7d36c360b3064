"""Phrase collocations by vertical partitioning of the word suffixes.

1. Words are counted; only a word that stands often enough can be part of a frequent phrase, so each
   place's suffix is cut at the first rare word, and between two words whose pair is rare. Bitmaps of fixed size say which,
   that of the pairs from counts by hash; a false yes only costs bytes.
2. Prefixes are grouped by a memory budget: a prefix (of one word, at first) that stands more often than the budget is
   extended by a word, each extension counted by a pass over the texts; the others are packed into groups that
   stay within the budget.
3. Every task sorts the suffixes of one group at a time, depth-truncated, into a subtree on its own; its leaves
   are the different suffixes with their counts, and the count of an inner node is the total of its leaves.
   Nodes above an extended prefix come out in parts, one a group, and are added.

The frequent phrases are then scored by plain joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursematch.llm.common import LOWER, Store, grouped, mix, partitions, slices, words

DEPTH = 5
#: Suffixes of one group (12 to 48 bytes each in a task), if the corpus isn't so large that groups, and with them
#: the lists that go to the tasks, would pass 2^20.
BUDGET = 1 << 19
MOST_GROUPS = 1 << 20
#: Hash slots a group: the prefixes of a slot stay together.
SLOTS = 16
#: Bits of the bitmap of frequent words.
BITS = 26
#: log2 of the counters of word pairs, and of those in one row of a shuffle.
PAIR_BITS, PAIR_BLOCK = 24, 16
#: Different words, and suffixes, that a task counts together before it passes them on.
FLUSH_WORDS = 1 << 18
FLUSH = 1 << 20

PIECE = np.zeros(256, dtype=bool)
PIECE[list(b".,;:!?") + [0x0A, 0x0B, 0x0C, 0x0D]] = True
GAP = PIECE.copy()
GAP[[0x20, 0x09]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Suffixes:
    """The words of a run of texts: hash (with the language), and how many words follow in the piece."""

    def __init__(self, batch: pa.RecordBatch, data: np.ndarray, offs: np.ndarray):
        self.data = LOWER[data]
        self.starts, h, self.first = words(self.data, offs, GAP)
        last = ~GAP[self.data]
        last[:-1] &= GAP[self.data[1:]]
        tails = offs[1:][offs[1:] > offs[:-1]] - 1
        last[tails] = ~GAP[self.data[tails]]
        self.ends = np.flatnonzero(last) + 1
        lang = batch.column(batch.schema.get_field_index("lang")).dictionary_encode()
        self.langs = [str(v) for v in lang.dictionary.to_pylist()]
        codes = np.array([int.from_bytes(hashlib.blake2b(v.encode(), digest_size=8).digest(), "little") for v in self.langs], np.uint64)
        self.lang = np.repeat(np.asarray(lang.indices), np.diff(self.first))
        self.hashes = mix(h ^ codes[self.lang]) if len(h) else h
        after = np.cumsum(PIECE[self.data], dtype=np.int64)[self.starts] if len(h) else np.zeros(0, np.int64)
        new = np.ones(len(h) + 1, bool)
        new[1:-1] = after[1:] != after[:-1]
        new[self.first] = True
        self.new = new  # a word that begins a piece, and one place past the end

    def word(self, i: int) -> str:
        return self.data[self.starts[i]: self.ends[i]].tobytes().decode("utf-8", "replace")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Suffixes]:
    for batch, data, offs in slices(batches):
        yield Suffixes(batch, data, offs)


def _count_words(batches):
    """The different words of many texts with their counts; a row without a word has the language's total."""
    schema = pa.schema([("h", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    counts: dict[int, int] = {}
    spelt: dict[int, tuple[str, str]] = {}
    totals: dict[str, int] = {}

    def flush():
        out = {"h": [*counts, *[0] * len(totals)], "lang": [*(x for x, _ in spelt.values()), *totals], "word": [*(w for _, w in spelt.values()), *[None] * len(totals)],
               "n": [*counts.values(), *totals.values()]}
        counts.clear(), spelt.clear(), totals.clear()
        return pa.RecordBatch.from_pydict(out, schema)

    for s in _runs(batches):
        keys, at, n = np.unique(s.hashes.view(np.int64), return_index=True, return_counts=True)
        for h, i, c in zip(keys.tolist(), at.tolist(), n.tolist()):
            if h in counts:
                counts[h] += c
            else:
                counts[h] = c
                spelt[h] = s.langs[s.lang[i]], s.word(i)
        for lang, c in zip(s.langs, np.bincount(s.lang, minlength=len(s.langs)).tolist()):
            totals[lang] = totals.get(lang, 0) + c
        if len(counts) >= FLUSH_WORDS:
            yield flush()
    if totals:
        yield flush()


def _bit(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = (h >> np.uint64(64 - BITS)).astype(np.int64)
    return at >> 3, (1 << (at & 7)).astype(np.uint8)


class Sieve(NamedTuple):
    """Bitmaps of the words, and the pairs of words, that may be frequent."""

    words: np.ndarray
    pairs: np.ndarray | None = None

    def word(self, h: np.ndarray) -> np.ndarray:
        byte, bit = _bit(h)
        return (self.words[byte] & bit) != 0

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.pairs is None:
            return np.ones(len(a), bool)
        at = _pair(a, b)
        return (self.pairs[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (_extend(a, b) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _windows(s: Suffixes, sieve: Sieve, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Places whose word may be frequent, and the length of each one's suffix: up to the depth, the piece's end, a rare word or a rare pair."""
    n = len(s.hashes)
    good = sieve.word(s.hashes)
    to_next = np.zeros(n + 1, bool)     # the next word goes on with a suffix
    if n > 1:
        to_next[:n - 1] = good[:-1] & good[1:] & ~s.new[1:n]
        at = np.flatnonzero(to_next)
        to_next[at] = sieve.pair(s.hashes[at], s.hashes[at + 1])
    length, on = good.astype(np.int8), good.copy()
    for j in range(1, depth):
        on &= to_next[np.minimum(np.arange(n) + j - 1, n)]
        length += on
    at = np.flatnonzero(good)
    return at, length[at]


def _sketch_pairs(sieve: Sieve) -> Callable:
    """Counts of the pairs of frequent words by hash, up to 65,535, as rows of counters."""
    schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])

    def task(batches):
        counts = np.zeros(1 << PAIR_BITS, np.uint16)
        any_ = False
        for s in _runs(batches):
            at, length = _windows(s, sieve, 2)
            at = at[length > 1]
            if len(at):
                slot, n = np.unique(_pair(s.hashes[at], s.hashes[at + 1]), return_counts=True)
                counts[slot] = np.minimum(counts[slot] + n, 65535)
                any_ = True
        if any_:
            blocks = counts.reshape(-1, 1 << PAIR_BLOCK)
            for i in range(0, len(blocks), 32):
                yield pa.RecordBatch.from_pydict({"block": list(range(i, i + 32)), "counts": [b.tobytes() for b in blocks[i: i + 32]]}, schema)
    return task


def _frequent_pairs(least: int) -> Callable:
    """Added counters of each block (``block``, ``counts``, sorted by block) as bits: ``least`` or more."""
    schema = pa.schema([("block", pa.int32()), ("bits", pa.binary())])

    def bits(block, total):
        return pa.RecordBatch.from_pydict({"block": [block], "bits": [np.packbits(total >= min(least, 65535), bitorder="little").tobytes()]}, schema)

    def task(batches):
        block, total = None, None
        for batch in batches:
            for b, c in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(c.as_buffer(), np.uint16)
                if b != block:
                    if block is not None:
                        yield bits(block, total)
                    block, total = b, np.zeros(len(part), np.int64)
                total += part
        if block is not None:
            yield bits(block, total)
    return task


def _extend(key: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The key of a prefix with one more word; that of a single word is its hash."""
    return mix(key * _STEP + h)


def _member(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(keys), bool)
    return of[np.minimum(np.searchsorted(of, keys), len(of) - 1)] == keys


def _prefixes(h: Callable[[int], np.ndarray], length: np.ndarray, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The key of each suffix's shortest prefix that isn't extended, and its number of words."""
    key = h(0).copy()
    depth = np.ones(len(key), np.int8)
    todo = np.arange(len(key))
    for level, keys in enumerate(hot, 1):
        todo = todo[_member(key[todo], keys) & (length[todo] > level) & (depth[todo] == level)]
        key[todo] = _extend(key[todo], h(level)[todo])
        depth[todo] += 1
    return key, depth


def _count_prefixes(sieve: Sieve, hot: list[np.ndarray]) -> Callable:
    """Counts of the prefixes that the last list of ``hot`` has extended."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])
    level = len(hot) + 1

    def counted(held):
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], schema=schema)

    def task(batches):
        held, size = [], 0
        for s in _runs(batches):
            at, length = _windows(s, sieve)
            key, depth = _prefixes(lambda j: s.hashes[np.minimum(at + j, len(s.hashes) - 1)], length, hot)
            held.append(key[depth == level])
            size += len(held[-1])
            if size >= FLUSH:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)
    return task


# ---------------------------------------------------------------- packed suffixes

def _width(n: int) -> str:
    return "u1" if n <= 1 << 8 else "u2" if n <= 1 << 16 else "u4" if n <= 1 << 32 else "u8"


def _pack(lanes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted suffixes (one row a word place, 0 past the end) by numbers into their own words."""
    vocab, codes = np.unique(lanes, return_inverse=True)
    width, size = _width(len(vocab)), _width(int(counts.max()) + 1)
    head = np.array([lanes.shape[1], len(vocab), int(size[1])], np.int64)
    return head.tobytes() + vocab.tobytes() + codes.astype(width).tobytes() + counts.astype(size).tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, v, size = np.frombuffer(data, np.int64, 3)
    at = 24 + 8 * v
    vocab = np.frombuffer(data, np.uint64, v, 24)
    width = np.dtype(_width(int(v)))
    lanes = vocab[np.frombuffer(data, width, DEPTH * n, at)].reshape(DEPTH, n)
    return lanes, np.frombuffer(data, f"u{size}", n, at + DEPTH * n * width.itemsize).astype(np.int64)


def _leaves(lanes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different suffixes in order, with their total counts."""
    order = np.lexsort(lanes[::-1])
    lanes = lanes[:, order]
    head = np.ones(lanes.shape[1], bool)
    head[1:] = (lanes[:, 1:] != lanes[:, :-1]).any(0)
    at = np.flatnonzero(head)
    return lanes[:, at], np.add.reduceat(counts[order], at)


def _deal(sieve: Sieve, hot: list[np.ndarray], group: np.ndarray) -> Callable:
    """The suffixes of many texts by group, equal ones as one with a count."""
    schema = pa.schema([("g", pa.int32()), ("lang", pa.string()), ("leaves", pa.binary())])
    shift = np.uint64(64 - (len(group).bit_length() - 1))

    langs: dict[str, int] = {}

    def packed(held):
        names = list(langs)
        lanes, g, lang = (np.concatenate(x, -1) for x in zip(*held))
        order = np.lexsort((lang, g))
        cut = np.flatnonzero(np.append(True, (np.diff(g[order]) != 0) | (np.diff(lang[order]) != 0)))
        out = {"g": [], "lang": [], "leaves": []}
        for a, b in zip(cut, np.append(cut[1:], len(order))):
            rows = order[a:b]
            out["g"].append(g[rows[0]])
            out["lang"].append(names[lang[rows[0]]])
            out["leaves"].append(_pack(*_leaves(lanes[:, rows], np.ones(b - a, np.int64))))
        return pa.RecordBatch.from_pydict(out, schema)

    def task(batches):
        held, size = [], 0
        for s in _runs(batches):
            at, length = _windows(s, sieve)
            if not len(at):
                continue
            n = len(s.hashes)
            key, _ = _prefixes(lambda j: s.hashes[np.minimum(at + j, n - 1)], length, hot)
            lanes = np.zeros((DEPTH, len(at)), np.uint64)
            for j in range(DEPTH):
                on = length > j
                lanes[j, on] = s.hashes[at[on] + j]
            code = np.array([langs.setdefault(v, len(langs)) for v in s.langs], np.int32)
            held.append((lanes, group[(mix(key) >> shift).astype(np.int64)], code[s.lang[at]]))
            size += len(at)
            if size >= FLUSH:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)
    return task


def _subtrees(hot: list[np.ndarray], least: int, depth: int) -> Callable:
    """The nodes of each group's subtree: path (8 bytes a word), count. Nodes above an extended prefix are parts."""
    schema = pa.schema([("lang", pa.string()), ("path", pa.binary()), ("f", pa.int64())])

    def task(batches):
        for t in grouped(batches, ["g", "lang"]):
            packs = [_unpack(p) for p in t["leaves"].to_pylist()]
            lanes, counts = _leaves(np.concatenate([p[0] for p in packs], 1), np.concatenate([p[1] for p in packs]))
            del packs
            key = None
            for d in range(1, depth + 1):
                new = np.ones(lanes.shape[1], bool)
                new[1:] = (lanes[:d, 1:] != lanes[:d, :-1]).any(0)
                at = np.flatnonzero(new)
                total = np.add.reduceat(counts, at)
                key = lanes[0].copy() if d == 1 else _extend(key, lanes[d - 1])
                part = _member(key[at], hot[d - 1]) if d <= len(hot) else np.zeros(len(at), bool)
                keep = (lanes[d - 1, at] != 0) & (part | (total >= least))
                if keep.any():
                    paths = np.ascontiguousarray(lanes[:d, at[keep]].T).astype(">u8").tobytes()
                    k = int(keep.sum())
                    paths = pa.BinaryArray.from_buffers(pa.binary(), k, [None, pa.py_buffer((np.arange(k + 1, dtype=np.int32) * (8 * d)).tobytes()), pa.py_buffer(paths)])
                    yield pa.RecordBatch.from_arrays([pa.array([t["lang"][0].as_py()] * k, pa.string()), paths, pa.array(total[keep])], schema=schema)
    return task


# ---------------------------------------------------------------- operator

def frequent_phrases(docs: DataFrame, least: int = 100, depth: int = DEPTH, budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of 1 to ``depth`` words that stand ``least`` times or more in a language: (lang, path, f), where a path
    is 8 bytes a word; the words (h, lang, word, n) behind those bytes; and the languages' totals (lang, n). All are stored tables.

    Words are told apart by 64-bit hashes; two words of one hash raise an error, they are never mixed up.
    """
    if not 1 <= depth <= DEPTH:
        raise ValueError(f"depth is 1 to {DEPTH}")
    spark = docs.sparkSession
    store = Store(spark, "collocations")
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    counted = texts.mapInArrow(_count_words, "h long, lang string, word string, n long")
    total = F.col("word").isNull()
    seen = store.put(counted.groupBy("h", F.when(total, F.col("lang")).alias("of")).agg(
        F.min("lang").alias("lang"), F.min("word").alias("word"), F.sum("n").alias("n"),
        ((F.min("lang") != F.max("lang")) | (F.min("word") != F.max("word"))).alias("mixed")), "words")
    if not seen.where("word is not null and mixed").isEmpty():
        raise ValueError("two words have one 64-bit hash")
    totals = store.put(seen.where("word is null").select("lang", "n"), "totals")
    vocab = store.put(seen.where((F.col("word").isNotNull()) & (F.col("n") >= least)).select("h", "lang", "word", "n"), "vocab")
    store.drop(seen)

    frequent = np.zeros(1 << (BITS - 3), np.uint8)
    at = F.shiftrightunsigned("h", 64 - BITS)
    # at most 2^20 rows come to the driver, whatever the vocabulary
    for r in vocab.select(F.shiftright(at, 6).alias("w"), (at % 64).cast("int").alias("b")).groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toLocalIterator():
        frequent[r.w * 8: r.w * 8 + 8] |= np.frombuffer(np.int64(r.bits).tobytes(), np.uint8)
    sieve = Sieve(frequent)
    sketched = texts.mapInArrow(_sketch_pairs(sieve), "block int, counts binary").repartition(partitions(spark), "block").sortWithinPartitions("block")
    pairs = np.zeros((1 << (PAIR_BITS - PAIR_BLOCK), 1 << (PAIR_BLOCK - 3)), np.uint8)
    for r in sketched.mapInArrow(_frequent_pairs(least), "block int, bits binary").toLocalIterator():    # 2 MB in all
        pairs[r.block] = np.frombuffer(bytes(r.bits), np.uint8)
    sieve = Sieve(frequent, pairs.ravel())
    standing = int(vocab.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    budget = max(budget, standing // MOST_GROUPS)
    n_groups = max(1, -(-2 * standing // budget))
    slots = 1 << max(1, (SLOTS * n_groups - 1).bit_length())

    # vertical partitioning: extend what is over the budget, pack the rest by hash slots
    hot: list[np.ndarray] = []
    level = vocab.select(F.col("h").alias("key"), "n")
    load = np.zeros(slots, np.int64)
    shift = np.uint64(64 - (slots.bit_length() - 1))
    settled = store.put(level, "prefixes")
    prefix_tables = [settled]
    for d in range(1, depth + 1):
        over = [] if d == depth else [r.key for r in prefix_tables[-1].where(F.col("n") > budget).select("key").collect()]  # at most standing / budget
        hot_now = np.sort(np.array(over, np.int64).view(np.uint64))
        if not len(hot_now):
            break
        hot.append(hot_now)
        nxt = texts.mapInArrow(_count_prefixes(sieve, hot), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        prefix_tables.append(store.put(nxt, "prefixes"))

    def slot_loads(batches):
        for batch in batches:
            key = np.asarray(batch.column(0)).view(np.uint64)
            n = np.asarray(batch.column(1))
            cold = ~np.logical_or.reduce([_member(key, h) for h in hot]) if hot else np.ones(len(key), bool)
            slot = (mix(key[cold]) >> shift).astype(np.int64)
            keys, where = np.unique(slot, return_inverse=True)
            yield pa.RecordBatch.from_pydict({"slot": keys, "n": np.bincount(where, n[cold], len(keys)).astype(np.int64)})

    for t in prefix_tables:
        for r in t.mapInArrow(slot_loads, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toLocalIterator():
            load[r.slot] += r.n
        store.drop(t)
    group = np.zeros(slots, np.int32)
    g = held = 0
    for i, n in enumerate(load):
        if held and held + n > budget:
            g, held = g + 1, 0
        group[i] = g
        held += int(n)
    dealt = texts.mapInArrow(_deal(sieve, hot, group), "g int, lang string, leaves binary")
    dealt = dealt.repartition(max(partitions(spark), min(g + 1, 8 * partitions(spark))), "g").sortWithinPartitions("g", "lang")
    nodes = dealt.mapInArrow(_subtrees(hot, least, depth), "lang string, path binary, f long")
    return store.put(nodes.groupBy("lang", "path").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "nodes"), vocab, totals


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, depth: int = DEPTH, absorbed_percent: int = 100, budget: int = BUDGET) -> DataFrame:
    """The best ``top`` phrases of 2 to ``depth`` words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are put in lower case (A-Z), split at ``.,;:!?`` and line ends into pieces, and these at blanks and tabs into words.
    a counts the phrase's places within pieces; cut after its first k words, l and r count the parts, and
    the score is floor(1000 a n / (l r)) for the language's number of words n, the lowest over the cuts (the smallest k of equal ones). A phrase inside a
    longer one that stands at least ``absorbed_percent`` in a hundred times as often is left out. Ranked by score and a descending, then by the
    phrase's bytes. Products are exact decimals.

    A null text is empty, a null language is ``und``, an empty text has no words; every row counts, repeated ones
    repeatedly, whatever its doc_id; other columns are not read. An empty table, or one without frequent phrases,
    gives no rows.
    """
    store = Store(docs.sparkSession, "collocations-scores")
    nodes, vocab, totals = frequent_phrases(docs, least, depth, budget)
    size = F.octet_length("path")
    longer = nodes.where(size > 16)
    inner = longer.select("f", F.explode(F.array(F.expr("substring(path, 1, octet_length(path) - 8)"), F.expr("substring(path, 9)"))).alias("path"))
    inner = inner.groupBy("path").agg(F.max("f").alias("outer_f"))
    cands = nodes.where(size > 8).join(inner, "path", "left").where(F.coalesce(100 * F.col("outer_f") < absorbed_percent * F.col("f"), F.lit(True)))
    cuts = cands.select("lang", "path", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), (size / 8 - 1).cast("int"))).alias("k"))
    cuts = cuts.select("*", F.expr("substring(path, 1, 8 * k)").alias("left"), F.expr("substring(path, 8 * k + 1)").alias("right"))
    parts = nodes.select(F.col("path").alias("part"), F.col("f"))
    cuts = (cuts.join(parts.withColumnsRenamed({"part": "left", "f": "l"}), "left").join(parts.withColumnsRenamed({"part": "right", "f": "r"}), "right")
            .join(totals, "lang"))
    scored = cuts.withColumn("score", F.expr("(1000 * cast(a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    best = store.put(scored.groupBy("lang", "path", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
                     .select("lang", "path", "a", "n", "b.score", "b.l", "b.r"), "scored")

    # each language's best: first within salted parts of it, so that no task sees a whole language
    salt = F.pmod(F.xxhash64("path"), F.lit(4 * partitions(docs.sparkSession)))
    w = Window.partitionBy("lang", "salt").orderBy(F.desc("score"), F.desc("a"))
    short = store.put(best.withColumn("salt", salt).withColumn("place", F.rank().over(w)).where(F.col("place") <= top).drop("place"), "short")
    store.drop(best)
    spelt = (short.select("path", F.posexplode(F.expr("transform(sequence(1, octet_length(path), 8), i -> substring(path, i, 8))")).alias("at", "word_path"))
             .select("path", "at", F.conv(F.hex("word_path"), 16, -10).cast("long").alias("h")).join(vocab.select("h", "word"), "h")
             .groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda e: e.word), " ").alias("phrase")))
    named = short.join(spelt, "path")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    named = named.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
