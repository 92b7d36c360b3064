"""Benchmark decontamination by the q-gram lemma.

A passage of m characters that stands in a text with at most e edits shares at least m - q + 1 - q * e
q-grams with it, all on diagonals at most e apart. Shared q-grams are counted in diagonal bands of width
2 * (e + 1) that overlap by half, so some band holds them all; bands that reach the bound are verified by
a banded alignment of the passage against the region. Items go out in blocks of bounded bytes, each held
against all texts; texts are read whole and never shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import BYTE, LOWER, POWER, SPACE, mix, slices

Q = 12
RATE = 0.05                 # edits per character of a passage
BLOCK_BYTES = 4 << 20       # bytes of items that go to the executors at once
HITS_AT_ONCE = 1 << 20      # shared grams that a task lists at once


def normal(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A-Z in lower case and every run of white space as one blank, row by row."""
    space = SPACE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[offs[:-1][offs[:-1] < len(data)]] = True
    run = np.concatenate([[0], np.cumsum(keep)])
    return np.where(space, 32, LOWER[data]).astype(np.uint8)[keep], run[offs]


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of the q bytes that start at each place but the last q - 1 (rows are not told apart)."""
    if len(data) < q:
        return np.zeros(0, np.uint64)
    if q != Q:
        h, n = BYTE[data], len(data) - q + 1
        out = np.zeros(n, np.uint64)
        for j in range(q):
            out += h[j: j + n] * POWER[j]
        return mix(out)
    h = BYTE[data]
    two = h[:-1] * POWER[1] + h[1:]
    four = two[:-2] * POWER[2] + two[2:]
    eight = four[:-4] * POWER[4] + four[4:]
    return mix(eight[:-4] * POWER[8] + four[8:])


def _counted(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of ``keys`` with the sums of n."""
    order = np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return keys[at], np.add.reduceat(n[order], at)


class Grams:
    """The places of the q-grams of some items (numbers), and which items hold a gram how often."""

    def __init__(self, q: int, items: list[int], text: list[np.ndarray]):
        self.q = q
        hs = [grams(text[i], q) for i in items]
        h = np.concatenate(hs)
        order = np.argsort(h, kind="stable")
        self.place = np.concatenate([np.arange(len(g)) for g in hs])[order]
        self.of = np.repeat(items, [len(g) for g in hs])[order]
        h = h[order]
        self.keys, self.begin = np.unique(h, return_index=True)
        self.end = np.append(self.begin[1:], len(h))
        # (gram, item) once each, with the number of its places
        key = np.repeat(np.arange(len(self.keys)), self.end - self.begin)
        new = np.ones(len(h), bool)
        new[1:] = (key[1:] != key[:-1]) | (self.of[1:] != self.of[:-1])
        self.pair = np.flatnonzero(new)
        self.times = np.diff(np.append(self.pair, len(h)))
        self.pair_begin = np.searchsorted(self.pair, self.begin)
        self.pair_end = np.append(self.pair_begin[1:], len(self.pair))
        bits = max(16, math.ceil(math.log2(len(h) + 1)) + 6)
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[h >> self.shift] = True

    def shared(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the texts whose gram some item has: place, row, number of the gram."""
        g = grams(data, self.q)
        at = np.flatnonzero(self.seen[g >> self.shift])
        if len(at):
            i = np.minimum(np.searchsorted(self.keys, g[at]), len(self.keys) - 1)
            real = self.keys[i] == g[at]
            at, i = at[real], i[real]
            row = np.searchsorted(offs, at, "right") - 1
            inside = at + self.q <= offs[row + 1]
            return at[inside], row[inside], i[inside]
        return at, at, at


def _spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and of which range each is."""
    n = end - begin
    of = np.repeat(np.arange(len(n)), n)
    return begin[of] + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)), of


class Items:
    """Normalised passages and the places of their q-grams.

    q is 12, or less where a passage's bound on shared 12-grams would be 0 or less: floor(m / (e + 1)) makes it 1 at least.
    """

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.text = [], []
        for item, text in items:
            raw = np.frombuffer(text.strip().encode(), np.uint8)
            t, _ = normal(raw, np.array([0, len(raw)]))
            if len(t) >= Q:
                self.ids.append(item)
                self.text.append(t)
        self.m = np.array([len(t) for t in self.text], np.int64)
        self.e = (self.m * RATE).astype(np.int64)
        q = np.where(self.m - Q + 1 - Q * self.e >= 1, Q, self.m // (self.e + 1))
        self.need = self.m - q + 1 - q * self.e
        self.grams = [Grams(int(k), np.flatnonzero(q == k).tolist(), self.text) for k in np.unique(q)]

    def candidates(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """(row, item, lowest diagonal, width) of bands that reach the bound; diagonals count from the row's start.

        Where a text and an item share so many grams (repeated ones, as in runs of one character) that listing them costs more
        than aligning the item with the whole text, all diagonals are one band. Other shared grams are listed HITS_AT_ONCE at a time.
        """
        out = [np.zeros((0, 4), np.int64)]
        size = np.diff(offs)
        for grams_ in self.grams:
            at, row, i = grams_.shared(data, offs)
            if not len(at):
                continue
            # shared grams of each (row, item), without listing them
            totals: dict[int, int] = {}
            step = max(1, HITS_AT_ONCE // max(1, int((grams_.pair_end - grams_.pair_begin).max())))
            for a in range(0, len(at), step):
                p, of = _spread(grams_.pair_begin[i[a: a + step]], grams_.pair_end[i[a: a + step]])
                keys, where = np.unique(row[a: a + step][of] * len(self.ids) + grams_.of[grams_.pair[p]], return_inverse=True)
                for k, n in zip(keys.tolist(), np.bincount(where, grams_.times[p]).astype(np.int64).tolist()):
                    totals[k] = totals.get(k, 0) + n
            keys = np.array(sorted(totals), np.int64)
            n = np.array([totals[k] for k in keys.tolist()], np.int64)
            r, item = keys // len(self.ids), keys % len(self.ids)
            keep = n >= self.need[item]
            dense = keep & (n > self.m[item] * size[r] // 20 + 100 * self.m[item])
            out.append(np.column_stack([r, item, -self.m[item], self.m[item] + size[r]])[dense])
            sparse = keys[keep & ~dense]
            found: list[np.ndarray] = []
            counts: list[np.ndarray] = []
            ends = np.cumsum(grams_.end[i] - grams_.begin[i])
            a = 0
            while a < len(at) and len(sparse):
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + HITS_AT_ONCE, "right")))
                o, of = _spread(grams_.begin[i[a:b]], grams_.end[i[a:b]])
                it, rw = grams_.of[o], row[a:b][of]
                on = np.isin(rw * len(self.ids) + it, sparse)
                o, of, it, rw = o[on], of[on], it[on], rw[on]
                half = np.floor_divide((at[a:b] - offs[row[a:b]])[of] - grams_.place[o], self.e[it] + 1)
                # the band that begins at this half, and the one that begins at the half before
                bands = np.concatenate([np.stack([rw, it, half - shift], axis=1) for shift in (0, 1)])
                if len(bands):
                    k, c = _counted(bands, np.ones(len(bands), np.int64))
                    found.append(k)
                    counts.append(c)
                if len(found) > 16:
                    k, c = _counted(np.concatenate(found), np.concatenate(counts))
                    found, counts = [k], [c]
                a = b
            if found:
                k, c = _counted(np.concatenate(found), np.concatenate(counts))
                k = k[c >= self.need[k[:, 1]]]
                step = self.e[k[:, 1]] + 1
                out.append(np.column_stack([k[:, 0], k[:, 1], k[:, 2] * step, 2 * step]))
        return np.concatenate(out)

    def edits(self, item: int, text: np.ndarray, low: int, width: int) -> tuple[int, int] | None:
        """The least edits, and the end in ``text``, of the passage on diagonals low - e to low + width + e; None over the budget."""
        t, e = self.text[item], int(self.e[item])
        a, b = max(0, low - e), min(len(text), low + width + e + len(t))
        exact = text[a:b].tobytes().find(t.tobytes())
        if exact >= 0:
            return 0, a + exact + len(t)
        # cell k of row i: i characters of the passage against text up to i + k + low - e
        k = np.arange(width + 2 * e + 1)
        big = len(t) + len(text) + 1
        d = np.where((k + low - e >= 0) & (k + low - e <= len(text)), 0, big)
        for i, c in enumerate(t):
            j = i + k + low - e                 # the text's character that the diagonal step takes
            on = (j >= 0) & (j < len(text))
            cost = np.where(on, text[np.clip(j, 0, max(len(text) - 1, 0))] != c, True)
            step = np.where(on, d + cost, big)
            up = np.append(d[1:], big) + 1      # the passage's character has no partner
            x = np.minimum(step, up)
            x[(j + 1 < 0) | (j + 1 > len(text))] = big
            d = np.minimum.accumulate(x - k) + k    # characters of the text without a partner
        best = int(d.argmin())
        return (int(d[best]), int(best + low - e + len(t))) if d[best] <= e else None

    def hits(self, data: np.ndarray, offs: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each row the (item_id, least edits) that it holds, by item_id."""
        data, offs = normal(data, offs)
        best: list[dict[int, int]] = [{} for _ in range(len(offs) - 1)]
        if self.ids:
            for row, item, low, width in self.candidates(data, offs).tolist():
                if best[row].get(item, 1) == 0:
                    continue
                got = self.edits(item, data[offs[row]: offs[row + 1]], low, width)
                if got and got[0] < best[row].get(item, self.m[item]):
                    best[row][item] = got[0]
        return [sorted((self.ids[i], e) for i, e in b.items()) for b in best]


HITS = "array<struct<item_id:bigint,edits:bigint>>"


def _search(items: list[tuple[int, str]]):
    made: list[Items] = []

    def run(batches):
        if not made:
            made.append(Items(items))
        for rows, data, offs in slices(batches):
            before = rows.column(2).to_pylist()
            hits = [[*(old or []), *({"item_id": i, "edits": e} for i, e in new)] for old, new in zip(before, made[0].hits(data, offs))]
            hits = pa.array(hits, pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int64())])))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), hits], ["row", "text", "hits"])
    return run


def contamination(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(row, hits): every row of ``documents`` as a struct, and the benchmark items that stand in its text.

    hits has item_id and the edits of its best place, at most RATE of the item's characters. Texts and items
    are compared in lower case (A-Z) with runs of white space as one blank, by UTF-8 byte. Items without an
    id or text, or of fewer than Q characters, are not looked for; a null or empty text holds none. Repeated
    rows are judged alike; an item_id that stands twice in the benchmark is one hit for each text of it.
    The items pass through the driver in blocks of BLOCK_BYTES and are part of the plan: this is made for benchmarks of up
    to some hundreds of MB, against any number of texts.
    """
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    schema = f"row {documents.schema.simpleString()}, text string, hits {HITS}"
    out = documents.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.lit(None).cast(HITS).alias("hits"))
    for b in range(blocks):
        block = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]
        out = out.mapInArrow(_search(block), schema)
    return out.select("row", "hits")
