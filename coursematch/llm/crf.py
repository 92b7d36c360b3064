"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are rates of its bytes and words and those of the lines beside it;
a transition score ties neighbouring labels. Forward-backward gives each line's chance of being good, and
their mean, weighted by line length, is the document's score. The field is fitted on a bounded sample of
labelled documents (all their lines carry the document's label); scoring reads every whole text once,
without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import LOWER, SPACE, Store, slices, words

SAMPLE = 8000           # labelled documents that the field is fitted on, at most
SAMPLE_LINES = 5000     # longer labelled documents are left out of the fit
FIT_LINES = 500_000     # lines that the field is fitted on, at most
_B = np.arange(256)
_UP, _LOW, _DIGIT = (_B >= 65) & (_B <= 90), (_B >= 97) & (_B <= 122), (_B >= 48) & (_B <= 57)
_END = np.isin(_B, [ord(c) for c in ".!?"])
_MARK = (_B > 32) & (_B < 127) & ~_UP & ~_LOW & ~_DIGIT & ~np.isin(_B, [ord(c) for c in ".,;:'\"-()?"])
OWN, NEAR = 13, 7       # features of the line itself; how many of them its neighbours add


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the texts in a buffer: a row of features for each line, line lengths, and each text's first line.
    Every text has at least one line; line feeds end lines."""
    feeds = np.flatnonzero(data == 10)
    # an empty mark at each text's end makes its last line
    ends = np.sort(np.concatenate([feeds, offs[1:]]), kind="stable")
    doc_end = np.searchsorted(ends, offs[1:], "right")
    # texts that end where the next one's first line feed stands share a place: count lines per text instead
    per = 1 + np.searchsorted(feeds, offs[1:]) - np.searchsorted(feeds, offs[:-1])
    first = np.concatenate([[0], np.cumsum(per)])
    del doc_end
    starts = np.empty(first[-1], np.int64)
    stops = np.empty(first[-1], np.int64)
    head = np.zeros(first[-1], bool)
    head[first[:-1]] = True
    starts[head] = offs[:-1]
    starts[~head] = feeds + 1
    tail = np.zeros(first[-1], bool)
    tail[first[1:] - 1] = True
    stops[tail] = offs[1:]
    stops[~tail] = feeds
    size = stops - starts
    n = np.maximum(size, 1)

    def rate(mask: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(mask)])
        return (run[stops] - run[starts]) / n

    mark = _MARK[data]
    twice = np.zeros(len(data), bool)
    twice[1:] = mark[1:] & (data[1:] == data[:-1])
    edge = np.unique(np.concatenate([offs, feeds, feeds + 1]))
    at, h, bound = words(LOWER[data], edge[edge <= len(data)])
    line = np.searchsorted(starts, at, "right") - 1 if len(at) else np.zeros(0, np.int64)
    n_words = np.bincount(line, minlength=len(size))
    again = np.zeros(len(at), bool)
    again[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((h, line))
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = (h[order][1:] != h[order][:-1]) | (line[order][1:] != line[order][:-1])
    kinds = np.bincount(line[order][new], minlength=len(size)) if len(at) else np.zeros(len(size))
    w = np.maximum(n_words, 1)
    last = np.where(size > 0, data[np.maximum(stops - 1, 0)] if len(data) else 0, 0)
    solid = rate(~SPACE[data]) * n
    own = np.stack([
        rate(mark), rate(twice), rate(_UP[data]), rate(_DIGIT[data]), rate(data == ord("|")), rate(_END[data]),
        np.bincount(line, again, minlength=len(size)) / w if len(at) else np.zeros(len(size)),
        1 - kinds / w, np.log1p(size) / 5, np.log1p(n_words) / 4, solid / w / 10, _END[last].astype(float), (n_words == 0).astype(float)], axis=1)
    before, after = np.zeros((len(size), NEAR)), np.zeros((len(size), NEAR))
    before[1:] = own[:-1, :NEAR]
    after[:-1] = own[1:, :NEAR]
    before[head] = 0
    after[tail] = 0
    return np.hstack([own, before, after, head[:, None], tail[:, None]]), size, first


def chances(odds: np.ndarray, first: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains: each line's chance of being good, and the expected transitions.
    odds: log-odds of good for each line; step[a, b]: score of label b after a (0 bad, 1 good)."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    heads, n = first[:-1][order], n[order]
    live = [int(np.searchsorted(-n, -t, "left")) for t in range(n[0] if len(n) else 0)]   # chains longer than t
    emit = np.stack([np.zeros_like(odds), odds], axis=1)
    fore, back = np.empty_like(emit), np.zeros_like(emit)
    for t, k in enumerate(live):
        at = heads[:k] + t
        if t:
            fore[at] = emit[at] + np.logaddexp(fore[at - 1, :1] + step[0], fore[at - 1, 1:] + step[1])
        else:
            fore[at] = emit[at]
        fore[at] -= fore[at].max(axis=1, keepdims=True)
    pairs = np.zeros((2, 2))
    for t in range(len(live) - 1, 0, -1):
        at = heads[: live[t]] + t
        ahead = emit[at] + back[at]
        back[at - 1] = np.logaddexp(step[:, 0] + ahead[:, :1], step[:, 1] + ahead[:, 1:])
        back[at - 1] -= back[at - 1].max(axis=1, keepdims=True)
        joint = fore[at - 1][:, :, None] + step + ahead[:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    total = fore + back
    return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500))), pairs


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, rounds: int = 300, rate: float = 0.1, ridge: float = 1e-3) -> dict:
    """Weights that make the labels likely (gradient steps with running scales). label: one for each chain."""
    mean, sd = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / sd, -8, 8)
    y = np.repeat(label, np.diff(first)).astype(float)
    inside = np.ones(len(y), bool)
    inside[first[:-1]] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (np.flatnonzero(inside) * 0 + y[np.flatnonzero(inside) - 1].astype(int), y[inside].astype(int)), 1)
    theta = np.zeros(z.shape[1] + 5)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        p, pairs = chances(z @ theta[:-5] + theta[-5], first, theta[-4:].reshape(2, 2))
        g = np.concatenate([(y - p) @ z, [(y - p).sum()], (seen - pairs).ravel()]) / len(y) - ridge * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return {"mean": mean, "sd": sd, "w": theta[:-5], "b": theta[-5], "step": theta[-4:].reshape(2, 2)}


def document_scores(data: np.ndarray, offs: np.ndarray, model: dict) -> np.ndarray:
    """The mean chance of each text's lines, weighted by their lengths (and one for the line itself)."""
    if "prior" in model:
        return np.full(len(offs) - 1, model["prior"])
    x, size, first = features(data, offs)
    p, _ = chances(np.clip((x - model["mean"]) / model["sd"], -8, 8) @ model["w"] + model["b"], first, model["step"])
    return np.add.reduceat(p * (size + 1.0), first[:-1]) / np.add.reduceat(size + 1.0, first[:-1])


def _sampled(batches):
    for rows, data, offs in slices(batches):
        x, _, first = features(data, offs)
        keep = [i for i in range(len(rows)) if first[i + 1] - first[i] <= SAMPLE_LINES]
        yield pa.RecordBatch.from_arrays([
            rows.column(0).take(pa.array(keep, pa.int64())), rows.column(2).take(pa.array(keep, pa.int64())), pa.array(np.diff(first)[keep]),
            pa.array([x[first[i]: first[i + 1]].astype(np.float32).tobytes() for i in keep], pa.binary())], ["doc_id", "quality", "lines", "x"])


def train(documents: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE, fit_lines: int = FIT_LINES) -> dict:
    """The field, from at most ``sample`` labelled documents whose crc32(doc_id) mod 3 is not 1 (those with the
    smallest hashes of their doc_id), and of these the first that have at most ``fit_lines`` lines together.
    Labels other than 0 and 1 are left out; a doc_id with two labels has the smaller one, and of several rows of a
    doc_id one counts. Without both labels the model is their share, or 0.5."""
    store = Store(documents.sparkSession, "crf")
    known = (labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1).groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    found = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id")
             .select("doc_id", "text", "quality").mapInArrow(_sampled, "doc_id long, quality int, lines long, x binary"))
    found = store.put(found.groupBy("doc_id").agg(F.min(F.struct("quality", "lines", "x")).alias("r")).select("doc_id", "r.*"), "lines")
    sizes = found.select(F.xxhash64("doc_id").alias("h"), "lines").toPandas().sort_values("h")      # at most ``sample`` rows
    within = sizes.h[sizes.lines.cumsum() <= fit_lines]
    rows = found.where(F.xxhash64("doc_id") <= (int(within.max()) if len(within) else -(1 << 63))).select("doc_id", "quality", "x").toPandas()
    store.drop(found)
    if rows.quality.nunique() < 2:
        return {"prior": float(rows.quality.mean()) if len(rows) else 0.5}
    rows = rows.sort_values("doc_id", kind="stable")
    width = OWN + 2 * NEAR + 2
    x = [np.frombuffer(b, np.float32).reshape(-1, width) for b in rows.x]
    return fit(np.vstack(x).astype(float), np.concatenate([[0], np.cumsum([len(a) for a in x])]), rows.quality.to_numpy())


def _scored(model: dict):
    def run(batches):
        for rows, data, offs in slices(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(document_scores(data, offs, model))], ["row", "score"])
    return run


def quality(documents: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """(row, score): every row of ``documents`` as a struct, and its quality from 0 to 1.

    Null and empty texts have one empty line. Repeated rows score alike. Other columns are carried, not read."""
    model = train(documents, labels, text)
    schema = f"row {documents.schema.simpleString()}, score double"
    return documents.select(F.struct("*").alias("row"), F.col(text).alias("text")).mapInArrow(_scored(model), schema)
