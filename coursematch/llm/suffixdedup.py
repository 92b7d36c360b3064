"""Repeated byte strings across documents, by a sparse suffix array in buckets, deep-shallow sorted.

A string of LENGTH bytes occurs again if equal strings stand earlier. Every window of LENGTH bytes has an
anchor: the leftmost smallest hash of its K-byte grams. Equal windows have their anchors at the same place
with the same gram, so suffixes need to be compared only within the bucket of a gram that occurs twice.

A bucket holds, for each distinct piece of text around the gram (the windows that share the anchor), the
first place where it stands. Later equal pieces go as they are. The pieces' suffixes from the gram on, and
their reversed prefixes up to it, are each sorted deep-shallow: multikey quicksort on eight bytes at a time
down to SHALLOW words of eight, then a blind trie for each group that is still tied. The common prefixes of
neighbours in both orders tell which windows of which pieces are equal.

Copies of a whole text are found by its hash first. Pieces are pre-aggregated before the shuffle, and a
bucket with very many different pieces is settled window by window instead, so that no task holds it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import BYTE, POWER, Store, keyed, mix, partitions, slices, whole_groups

LENGTH = 100
K = 24
SHALLOW = 4             # words of eight bytes that multikey quicksort looks at
WIDTH = 104             # bytes that a padded string takes, a multiple of eight of at least LENGTH
MOST = 20_000           # different pieces that a bucket may hold


def grams(data: np.ndarray) -> np.ndarray:
    """Hashes of the K = 24 bytes that start at each place but the last 23."""
    h = BYTE[data]
    two = h[:-1] * POWER[1] + h[1:]
    four = two[:-2] * POWER[2] + two[2:]
    eight = four[:-4] * POWER[4] + four[4:]
    sixteen = eight[:-8] * POWER[8] + eight[8:]
    return mix(sixteen[:-8] * POWER[16] + eight[16:])


def anchors(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows of one row that share an anchor: row, anchor, first window, last window, gram hash."""
    none = np.zeros(0, np.int64)
    n = np.maximum(np.diff(offs) - LENGTH + 1, 0)
    if not n.sum():
        return none, none, none, none, none
    g = grams(data)
    place = np.arange(len(g), dtype=np.uint64)
    low = np.uint64((1 << 28) - 1)
    least = (g & ~low) | (place & low)          # ties of the upper bits go to the leftmost
    span = LENGTH - K + 1
    step = 1
    while step * 2 <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < span:
        least = np.minimum(least[: len(least) - (span - step)], least[span - step:])
    row = np.repeat(np.arange(len(n)), n)
    p = offs[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
    a = (least[p] & low).astype(np.int64)
    a += (p - a + (1 << 27)) >> 28 << 28        # buffers beyond 2^28 bytes
    new = np.ones(len(p), bool)
    new[1:] = (a[1:] != a[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(p)) - 1
    return row[head], a[head], p[head], p[tail], g[a[head]].view(np.int64)


def _grams_of(batches):
    for rows, data, offs in slices(batches):
        row, _, _, _, h = anchors(data, offs)
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(h)))
        yield pa.RecordBatch.from_arrays([pa.array(h[at]), rows.column(0).take(pa.array(row[at])), pa.array(np.minimum(n, 2).astype(np.int32))], ["h", "doc_id", "n"])


def _pieces(batches):
    """Rows of pieces in wanted buckets: the first of each kind in its text, later ones as spans to remove (h null)."""
    for rows, data, offs in slices(batches):
        row, a, p0, p1, h = anchors(data, offs)
        wanted = rows.column(2)
        flat = wanted.flatten().to_numpy()
        of = np.repeat(np.arange(len(rows)), wanted.value_lengths().to_numpy())
        keep = np.zeros(len(h), bool)
        if len(h) and len(flat):
            # both sides in one order: a bucket is wanted for its own row only
            pair = np.stack([np.concatenate([of, row]), np.concatenate([flat, h])], axis=1)
            order = np.lexsort((np.arange(len(pair)) >= len(flat), pair[:, 1], pair[:, 0]))
            s = pair[order]
            mark = (order < len(flat)).astype(np.int64)
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]).any(axis=1)
            group = np.cumsum(new) - 1
            hit = np.add.reduceat(mark, np.flatnonzero(new))[group] > 0
            back = np.empty(len(s), bool)
            back[order] = hit
            keep = back[len(flat):]
        row, a, p0, p1, h = row[keep], a[keep], p0[keep], p1[keep], h[keep]
        raw = data.tobytes()
        ids, out = rows.column(0).to_pylist(), []
        seen: set = set()
        last = -1
        for r, x, b, e, k in zip(row.tolist(), a.tolist(), p0.tolist(), p1.tolist(), h.tolist()):
            if r != last:
                seen, last = set(), r
            seg, o = raw[b: e + LENGTH], int(offs[r])
            kind = (k, x - b, seg)
            if kind in seen:
                out.append((None, None, ids[r], x - o, b - o, e - o, None))
            else:
                seen.add(kind)
                fp = int.from_bytes(hashlib.blake2b(seg, digest_size=8, salt=(x - b).to_bytes(2, "big")).digest(), "big", signed=True)
                out.append((k, fp, ids[r], x - o, b - o, e - o, seg))
        if out:
            c = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(c, kinds)], ["h", "fp", "doc_id", "a", "p0", "p1", "seg"])


PIECE = "h long, fp long, doc_id long, a long, p0 long, p1 long, seg binary"


# ---------------------------------------------------------------- deep-shallow sorting

def blind_trie(strings: list[bytes], skip: int) -> tuple[list[int], list[int]]:
    """The order of strings that agree on ``skip`` bytes, and each one's common prefix with the one before.

    Inner nodes hold the depth where strings part and a child for each byte there (-1: the string ends);
    a string goes down blindly, is compared once with the leaf it meets, and parts from its path there."""
    root: list | None = None

    def byte(s: bytes, d: int) -> int:
        return s[d] if d < len(s) else -1

    for i, s in enumerate(strings):
        if root is None:
            root = [None, [i]]
            continue
        node = root
        while node[0] is not None:
            kids = node[1]
            b = byte(s, node[0])
            node = kids[b] if b in kids else next(iter(kids.values()))
        other = strings[node[1][0]]
        if s == other:
            node[1].append(i)
            continue
        lo, hi = skip, min(len(s), len(other))
        while lo < hi:              # the first byte where they differ
            mid = (lo + hi + 1) // 2
            if s[lo:mid] == other[lo:mid]:
                lo = mid
            else:
                hi = mid - 1
        at = root
        while at[0] is not None and at[0] < lo:
            at = at[1][byte(s, at[0])]
        if at[0] == lo:
            at[1][byte(s, lo)] = [None, [i]]
        else:
            at[0], at[1] = lo, {byte(other, lo): [at[0], at[1]], byte(s, lo): [None, [i]]}
    order: list[int] = []
    lcp: list[int] = []
    stack = [(root, 0)]
    while stack:
        node, before = stack.pop()
        if node[0] is None:
            same = len(strings[node[1][0]])
            order += node[1]
            lcp += [before, *[same] * (len(node[1]) - 1)]
        else:
            keys = sorted(node[1], reverse=True)
            stack += [(node[1][b], before if b == keys[-1] else node[0]) for b in keys]
    return order, lcp


def deep_shallow(group: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings by group and bytes, and each one's common prefix with the one before (-1: other group).
    A string's end comes before its longer continuations. Strings have at most WIDTH bytes."""
    n = len(strings)
    size = np.array([len(s) for s in strings], np.int64)
    padded = np.frombuffer(b"".join(s.ljust(WIDTH, b"\0") for s in strings), ">u8").reshape(n, -1).astype(np.uint64)
    order = np.argsort(group, kind="stable")
    new = np.ones(n, bool)
    new[1:] = group[order][1:] != group[order][:-1]
    lcp = np.where(new, -1, -2)                 # -2: not known yet
    for w in range(SHALLOW):
        bucket = np.cumsum(lcp != -2)
        alone = np.bincount(bucket)[bucket] == 1
        live = np.flatnonzero(~alone)
        if not len(live):
            break
        # three-way partition of all live buckets at once: by the next eight bytes, then by length where both end
        rank = np.lexsort((np.minimum(size[order[live]], 8 * w + 8), padded[order[live], w], bucket[live]))
        order[live] = order[live][rank]
        x, y = order[live][1:], order[live][:-1]
        inner = (bucket[live][1:] == bucket[live][:-1]) & (lcp[live][1:] == -2)
        differ = padded[x, w] ^ padded[y, w]
        end = np.minimum(size[x], size[y])
        apart = inner & ((differ != 0) | ((end < 8 * w + 8) & (size[x] != size[y])))
        equal = 8 * w + _equal_bytes(differ)
        at = live[1:][apart]
        lcp[at] = np.minimum(equal, end)[apart]
    bucket = np.cumsum(lcp != -2)
    heads = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(heads, np.append(heads[1:], n)):
        if b - a > 1:
            members = order[a:b]
            sub, common = blind_trie([strings[i] for i in members], min(8 * SHALLOW, int(size[members].min())))
            order[a:b] = members[sub]
            lcp[a + 1: b] = common[1:]
    return order, lcp


def _equal_bytes(differ: np.ndarray) -> np.ndarray:
    """Leading zero bytes of 64-bit words."""
    out = np.full(len(differ), 8)
    for i in range(8):
        out = np.where((out == 8) & ((differ >> np.uint64(56 - 8 * i)) & np.uint64(0xFF) != 0), i, out)
    return out


def repeated_windows(group: np.ndarray, doc: np.ndarray, a: np.ndarray, p0: np.ndarray, p1: np.ndarray, segs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, from, to) of runs of bytes under windows that another piece of the group has at an earlier place."""
    first = np.lexsort((a, doc, group))
    group, doc, a, p0, p1 = group[first], doc[first], a[first], p0[first], p1[first]
    segs = [segs[i] for i in first]
    before = a - p0
    right, right_lcp = deep_shallow(group, [s[o:o + WIDTH] for s, o in zip(segs, before.tolist())])
    left, left_lcp = deep_shallow(group, [s[:o][::-1] for s, o in zip(segs, before.tolist())])
    n, span = len(segs), LENGTH - K + 1
    again = np.zeros((n, span + 2), bool)
    rc, lc = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(span):                       # the window that begins d bytes before the anchor
        live = np.flatnonzero((before >= d) & (a - p1 <= d))
        if len(live) < 2:
            continue
        rc[right] = np.cumsum(right_lcp < LENGTH - d)
        lc[left] = np.cumsum(left_lcp < d)
        _, lead, kind = np.unique(rc[live] * (n + 1) + lc[live], return_index=True, return_inverse=True)
        earlier = lead[kind]                    # pieces are in order of their places
        again[live, d + 1] = (earlier != np.arange(len(live))) & ((doc[live[earlier]] != doc[live]) | (a[live[earlier]] != a[live]))
    edge = np.diff(again.astype(np.int8), axis=1)
    i, start = np.nonzero(edge == 1)
    j, stop = np.nonzero(edge == -1)
    return doc[i], a[i] - (stop - 1), a[i] - start + LENGTH


def _sorted(batches):
    for t in whole_groups(batches, "h"):
        doc, lo, hi = repeated_windows(t["h"].to_numpy(), t["doc_id"].to_numpy(), t["a"].to_numpy(), t["p0"].to_numpy(), t["p1"].to_numpy(), t["seg"].to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo), pa.array(hi)], ["doc_id", "lo", "hi"])


def _each_window(batches):
    """The windows of pieces of very large buckets."""
    for batch in batches:
        out = []
        for doc, a, p0, p1, seg in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "a", "p0", "p1", "seg"))):
            out += [(hashlib.blake2b(seg[i: i + LENGTH], digest_size=16, salt=(a - p0 - i).to_bytes(2, "big")).digest(), doc, p0 + i) for i in range(p1 - p0 + 1)]
        if out:
            k, d, p = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), pa.array(d, pa.int64()), pa.array(p, pa.int64())], ["key", "doc_id", "p"])


def _cut(batches):
    for batch in batches:
        n_removed, n_spans, kept, sha = [], [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
            raw = (text.as_py() or "").encode()
            parts, end, gone, runs = [], 0, 0, 0
            last = -1
            for s in sorted(spans or (), key=lambda s: (s["lo"], s["hi"])):
                lo, hi = max(s["lo"], 0), min(s["hi"], len(raw))
                if lo >= hi:
                    continue
                if lo > last:
                    parts.append(raw[end:lo])
                    runs += 1
                gone += max(0, hi - max(lo, last))
                last = end = max(last, hi)
            parts.append(raw[end:])
            rest = b"".join(parts)
            n_removed.append(gone)
            n_spans.append(runs)
            kept.append(rest)
            sha.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([len((t.as_py() or "").encode()) for t in batch.column("text")], pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
            pa.array(kept, pa.binary()), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def drop_repeats(documents: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) for every row of ``documents``.

    Each byte under a string of LENGTH bytes that also starts earlier (in a document of a smaller doc_id, or
    earlier in the same one) is removed; strings may overlap, do not cross documents and are judged on the
    input. kept has the remaining bytes. A null text is empty. Repeated rows (one doc_id, one text) are one document:
    they remove nothing from each other, and each comes back. Different texts of one doc_id are documents of
    their own, in the order of their digests. Rows without a doc_id are left as they are and
    not compared. Other columns are not read. Texts are read whole; no group is cut short.
    """
    spark = documents.sparkSession
    store = Store(spark, "suffix")
    rows, _ = keyed(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), store)
    docs = rows.select(F.col("_row_key").alias("doc_id"), "text")     # from here on, doc_id is the text's own key

    described = docs.where("doc_id is not null").select("doc_id", F.octet_length("text").alias("n"), F.sha2("text", 256).alias("sha")).where(F.col("n") >= LENGTH)
    copied = described.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first != last")
    copies = store.put(described.join(copied, "sha").where("doc_id != first").select("doc_id", "n").distinct(), "copies")

    seen = docs.where("doc_id is not null").mapInArrow(_grams_of, "h long, doc_id long, n int")
    twice = seen.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    wanted = store.put(seen.select("h", "doc_id").join(twice, "h").groupBy("doc_id").agg(F.collect_set("h").alias("hs")).join(copies, "doc_id", "left_anti"), "wanted")

    by_doc = docs.where("doc_id is not null").join(wanted, "doc_id").select("doc_id", "text", "hs")
    pieces = store.put(by_doc.mapInArrow(_pieces, PIECE), "pieces")
    kinds = (pieces.where("h is not null").groupBy("h", "fp")
             .agg(F.min(F.struct("doc_id", "a", "p0", "p1")).alias("first"), F.count(F.lit(1)).alias("n"), F.first("seg").alias("seg")))
    kinds = store.put(kinds.select("h", "fp", "first.*", "n", "seg"), "kinds")
    width = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    mixed = kinds.join(width, "h").select("h", "doc_id", "a", "p0", "p1", "seg", "kinds")
    sorted_ = (mixed.where(F.col("kinds") <= MOST).repartition(partitions(spark), "h").sortWithinPartitions("h")
               .mapInArrow(_sorted, "doc_id long, lo long, hi long"))
    each = mixed.where(F.col("kinds") > MOST).mapInArrow(_each_window, "key binary, doc_id long, p long")
    lead = each.groupBy("key").agg(F.min(F.struct("doc_id", "p")).alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    single = each.join(lead, "key").where(F.struct("doc_id", "p") != F.col("lead")).select("doc_id", F.col("p").alias("lo"), (F.col("p") + LENGTH).alias("hi"))

    span = [F.col("p0").alias("lo"), (F.col("p1") + LENGTH).alias("hi")]
    own = pieces.where("h is null").select("doc_id", *span)
    repeated = kinds.where("n > 1").select("h", "fp", F.struct("doc_id", "a").alias("first"))
    later = pieces.where("h is not null").select("h", "fp", "doc_id", "a", "p0", "p1").join(repeated, ["h", "fp"]).where(F.struct("doc_id", "a") != F.col("first")).select("doc_id", *span)
    whole = copies.select("doc_id", F.lit(0).cast("long").alias("lo"), F.col("n").cast("long").alias("hi"))
    spans = (sorted_.unionAll(single).unionAll(own).unionAll(later).unionAll(whole)
             .groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))
    spans = spans.withColumnRenamed("doc_id", "_row_key")
    return rows.join(spans, "_row_key", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
