"""K-d tree sharding: nodes split at weighted medians along their widest metadata dimension.

The points of the tree are the distinct texts (weight: the bytes of all copies), so copies stay together;
the copies of a text that has more than half a shard's bytes are points of their own. A node for k shards
is split at the quantile floor(k/2)/k of its bytes along the dimension that is widest in it (sizes,
languages and sources of the points), until each leaf is one shard's bytes. The quantile is found by
grouped sums over the bits of an order key, a few per level for all nodes at once, so no node is ever
sorted or gathered. Texts with more than 2% of a shard's bytes are at most n_shards / 0.02; they are dealt
to the two sides by hand, heaviest first, and the rest fills the sides up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursematch.llm.common import Store
from coursematch.operators.ranges import running_sum

HEAVY = 0.02        # share of a shard from which a text is dealt by hand
WHOLE = 0.5         # share of a shard beyond which copies of a text are points of their own
NEAR = 0.002        # share of a shard to which a split is exact
SHIFTS = (51, 38, 25, 12, 0)
DIMS = 3


def _values(spark, rows: list[tuple], columns: str) -> DataFrame:
    """A few control rows as a SQL table of literals."""
    names = [c.split() for c in columns.split(", ")]
    literal = lambda v: str(v).lower() if isinstance(v, bool) else f"{v!r}D" if isinstance(v, float) else f"{v}L"
    body = ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in rows) or "(" + ", ".join("NULL" for _ in names) + ")"
    table = spark.sql(f"SELECT {', '.join(f'CAST({n} AS {t}) AS {n}' for n, t in names)} FROM VALUES {body} AS v({', '.join(n for n, _ in names)})")
    return table if rows else table.where("false")


def _dim(i) -> F.col:
    return F.col(f"d{i}")


def _order(dim) -> F.col:
    """A point's place along a dimension; equal values are ordered by the point's hash."""
    d = F.when(dim == 0, _dim(0)).when(dim == 1, _dim(1)).otherwise(_dim(2))
    return F.shiftleft(d, 51).bitwiseOR(F.col("tie").bitwiseAND(F.lit((1 << 51) - 1)))


def _split_keys(spark, points: DataFrame, todo: dict[int, tuple[int, float]], near: float) -> dict[int, int]:
    """For each node (dimension, bytes wanted on the left) the order key below which points go left."""
    found: dict[int, int] = {}
    state = {n: (dim, 0, want) for n, (dim, want) in todo.items()}
    above = 63
    for shift in SHIFTS:
        if not state:
            break
        small = _values(spark, [(n, d, p, float(r)) for n, (d, p, r) in state.items()], "node int, dim int, prefix long, want double")
        keyed = points.join(F.broadcast(small), "node").withColumn("key", _order(F.col("dim")))
        if above < 63:
            keyed = keyed.where(F.shiftright("key", above) == F.col("prefix"))
        sums = keyed.groupBy("node", "want", F.shiftright("key", shift).alias("b")).agg(F.sum("bytes").alias("w"), F.count(F.lit(1)).alias("n"))
        # at most 2^13 buckets for each of at most n_shards nodes
        run = sums.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("b")))
        pick = run.where(F.col("upto") >= F.col("want")).groupBy("node").agg(F.min(F.struct("b", "w", "n", "upto")).alias("x"))
        got = {r.node: r.x for r in pick.collect()}
        after = {}
        for n, (dim, prefix, want) in state.items():
            x = got.get(n)
            if x is None:                       # nothing left to divide: all goes left
                found[n] = (prefix + 1) << above if above < 63 else (1 << 63) - 1
                continue
            rest = want - (x.upto - x.w)
            if x.w <= near or x.n == 1 or shift == 0:
                found[n] = min((x.b + (1 if rest * 2 > x.w else 0)) << shift, (1 << 63) - 1)
            else:
                after[n] = (dim, x.b, rest)
        state, above = after, shift
    return found


def shard(documents: DataFrame, n_shards: int | None = 40, target_bytes: int | None = None, text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``documents``.

    Size is the text's UTF-8 bytes plus 16 (a null text has none). Shards are 0 to n_shards - 1, or as
    many as target_bytes asks for. Law ``bytes``: their sizes are near equal. slot numbers a shard's rows
    from 0 by doc_id (rows without a doc_id last; equal rows in any order); grown_shard belongs to another law
    and is null. Null metadata is a value of its own. Repeated rows are rows like others: they are told apart by a stored number,
    so copies of one text, also those of one doc_id or of none, can be dealt over shards. No rows, no shards.
    The tree's nodes are control state of the driver, some thousands at 40 shards and 200,000 at 200,000 shards.
    Columns lang and source are used where they exist; other columns are not read.
    """
    spark = documents.sparkSession
    store = Store(spark, "kdtree")
    body = F.coalesce(F.col(text), F.lit(""))
    meta = [F.col(c).cast("string").alias(c) if c in documents.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    base = store.put(documents.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
                                      F.xxhash64(body).alias("h"), F.monotonically_increasing_id().alias("row"), *meta), "base")
    total = base.agg(F.sum("size")).first()[0] or 0
    if n_shards is None:
        n_shards = max(1, -(-total // int(target_bytes)))
    target = total / n_shards

    groups = base.groupBy("h").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.min("lang").alias("lang"), F.min("source").alias("source"))
    groups = store.put(groups, "groups")
    is_large, is_heavy = (F.col("bytes") > WHOLE * target) & (F.col("n") > 1), F.col("bytes") > HEAVY * target
    large = groups.where(is_large).select("h")                    # fewer than n_shards / WHOLE rows
    dims = [F.least(F.lit(4095), (F.log2(F.col("size").cast("double")) * 100).cast("long")).alias("d0"),
            *(F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(c), F.lit(4095)) + 1).cast("long").alias(f"d{i}") for i, c in ((1, "lang"), (2, "source")))]
    blank = F.lit(None).cast("long")
    copies = base.join(F.broadcast(large), "h").select("h", F.xxhash64("row", "h").alias("tie"), "row", F.col("size").alias("bytes"), *dims, "doc_id", "size", "text_crc32", F.lit(True).alias("single"))
    single = copies.where(~is_heavy)
    whole = (groups.where(~is_large & ~is_heavy)
             .select("h", F.col("h").alias("tie"), blank.alias("row"), "bytes", *dims, blank.alias("doc_id"), blank.alias("size"), blank.alias("text_crc32"), F.lit(False).alias("single")))
    points = store.put(single.unionAll(whole).withColumn("node", F.lit(0)), "points")
    # fewer than n_shards / HEAVY rows
    atoms = [((False, r.h), r.bytes) for r in groups.where(~is_large & is_heavy).select("h", "bytes").collect()]
    atoms += [((True, r.tie), r.bytes) for r in copies.where(is_heavy).groupBy("tie").agg(F.sum("bytes").alias("bytes")).collect()]
    atoms.sort(key=lambda a: (-a[1], a[0]))
    spans = points.agg(*(F.max(f"d{i}") - F.min(f"d{i}") for i in range(DIMS))).first()

    nodes = {0: (0, n_shards)}                   # node: first shard, number of shards
    held = {0: atoms}
    fresh = 1
    while any(k > 1 for _, k in nodes.values()):
        stats = {r.node: r for r in points.groupBy("node").agg(F.sum("bytes").alias("bytes"), *(F.min(f"d{i}").alias(f"a{i}") for i in range(DIMS)), *(F.max(f"d{i}").alias(f"b{i}") for i in range(DIMS))).collect()}
        todo, children, leaves = {}, {}, {}
        for n, (first, k) in nodes.items():
            if k == 1:
                leaves[n] = (first, 1)
                continue
            s = stats.get(n)
            light = s.bytes if s else 0
            left_k = k // 2
            left = (light + sum(w for _, w in held[n])) * left_k / k
            room = [left, light + sum(w for _, w in held[n]) - left]
            sides: tuple[list, list] = ([], [])
            for a in held[n]:
                side = 0 if room[0] >= room[1] else 1
                sides[side].append(a)
                room[side] -= a[1]
            width = [(s[f"b{i}"] - s[f"a{i}"]) / max(1, spans[i] or 1) if s else 0 for i in range(DIMS)]
            todo[n] = (max(range(DIMS), key=lambda i: width[i]), min(max(room[0], 0), light))
            children[n] = (fresh, fresh + 1)
            leaves[fresh], leaves[fresh + 1] = (first, left_k), (first + left_k, k - left_k)
            held[fresh], held[fresh + 1] = sides
            fresh += 2
        cut = _split_keys(spark, points, todo, NEAR * target)
        splits = _values(spark, [(n, todo[n][0], cut[n], *children[n]) for n in todo], "node int, dim int, cut long, low int, high int")
        moved = (points.join(F.broadcast(splits), "node", "left")
                 .withColumn("node", F.when(F.col("dim").isNull(), F.col("node")).when(_order(F.col("dim")) < F.col("cut"), F.col("low")).otherwise(F.col("high")))
                 .drop("dim", "cut", "low", "high"))
        nxt = store.put(moved, "points")
        store.drop(points)
        points, nodes = nxt, leaves

    place = _values(spark, [(n, f) for n, (f, _) in nodes.items()], "node int, shard int")
    by_hand = _values(spark, [(*key, nodes[n][0]) for n in nodes for key, _ in held[n]], "copy boolean, h long, shard int")
    points = points.join(F.broadcast(place), "node")
    of_text = points.where("not single").select("h", "shard").unionAll(by_hand.where("not copy").select("h", "shard"))
    out = ["doc_id", "size", "text_crc32", "row", "shard"]
    rows = (base.join(of_text, "h").select(*out).unionAll(points.where("single").select(*out))
            .unionAll(copies.join(F.broadcast(by_hand.where("copy").select(F.col("h").alias("tie"), "shard")), "tie").select(*out)))
    # numbered by ranges of (shard, doc_id), so that no task numbers a whole shard of a large table
    rows = store.put(rows.withColumn("one", F.lit(1).cast("long")), "placed")
    numbered = running_sum(rows, ["shard"], ["doc_id", "text_crc32", "row"], "one", "at")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("at") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
