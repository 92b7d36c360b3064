"""Mixing to target weights with soft domain memberships, in DataFrame operations.

A naive Bayes classifier over the words of labelled documents that tell a domain from the others gives every
document its posteriors over the domains. Each document gets a nonnegative rate so that the expected tokens of each
domain, sum of rate * tokens * posterior, come as close to their targets as they can: least squares by projected gradient,
where one step needs only sums with a row for the whole table, and the rates stay with the rows.
"""

from __future__ import annotations

import warnings
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import Store

DOMAINS = ("clean", "low", "toxic")
SAMPLE = 8000       # labelled documents that the classifier is fitted on, at most
RATIO = 6           # a word is used only if it is so many times as common in some domain as in another
# to be chosen from on held-out labels:
ERROR = (1e-3, 1e-4, 1e-5, 1e-6)                    # chance that a word is taken for a domain that it does not tell from the others
SMOOTH = (0.5, 0.1)                                 # counts added to a word's
SHRINK = (1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1)     # factors of its evidence
TOKEN = r"[0-9a-z\x{80}-\x{10FFFF}]+|[^0-9a-z\x{80}-\x{10FFFF}\s]+"
STEPS = 100         # gradient steps at most; a warning tells if they don't do
CLOSE = 1e-6        # share of all tokens: a projected gradient under it ends the fit
LENGTHS = (4.0, 2.0, 1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 1e-3)  # of a step, tried at once
MOST_WORDS = 4096   # of the classifier, those of the best test values; part of the plan, so their number is fixed


def _tokens(text: str):
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKEN), F.lit(0))


def classifier(documents: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE, store: Store | None = None) -> dict:
    """Domain priors and, for each chosen word, the log-odds shifts of its presence.

    Domains: toxic (toxic is 1), else low (quality is 0), else clean; rows with other labels are left out, and
    of several rows of a doc_id the worst counts. The sample is that of the smallest hashes of doc_id."""
    d = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    known = (labels.where("doc_id is not null and quality in (0, 1) and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(d).alias("d"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # stored before they are tokenised: otherwise each count below would read, and tokenise, all documents
    store = store or Store(documents.sparkSession, "mixing-classifier")
    rows = store.put(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id"), "labelled")
    rows = store.put(rows.select("doc_id", "d", F.array_distinct(_tokens("text")).alias("w")), "words")
    rows = rows.withColumn("out", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0)
    live = range(len(DOMAINS))
    size = {(r.d, r.out): r.n for r in rows.groupBy("d", "out").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_fit = np.array([size.get((i, False), 0) for i in live], float)
    n = n_fit + np.array([size.get((i, True), 0) for i in live], float)
    if not n.sum():
        return {"n": n, "base": np.zeros(len(DOMAINS)), "words": {}, "chosen": None}
    counts = rows.select("d", "out", F.explode("w").alias("w")).groupBy("w").agg(
        *(F.sum((F.col("d") == i).cast("double")).alias(f"k{i}") for i in live), *(F.sum(((F.col("d") == i) & ~F.col("out")).cast("double")).alias(f"f{i}") for i in live))
    # choice on the held-out third, from words of the others; then words and counts of all
    p, words, odds = _telling(counts, "f", n_fit, max(ERROR))
    level, smooth, shrink = min(ERROR), SMOOTH[0], 1.0
    if words and (n > n_fit).any():
        held = rows.where("out").select("d", F.array_intersect("w", F.array(*(F.lit(w) for w in words))).alias("w")).collect()
        held = [r for r in held if n_fit[r.d]]
        at, d, loss = {w: j for j, w in enumerate(words)}, np.array([r.d for r in held], int), {}
        has = np.zeros((len(held), len(words)), np.float32)
        for i, r in enumerate(held):
            has[i, [at[w] for w in r.w]] = 1
        for e in ERROR:
            on = odds <= e
            for a in SMOOTH:
                prior, absent, shift = _evidence(p[on], n_fit, a)
                hits = has[:, on] @ shift
                for s in SHRINK:
                    x = np.where(n_fit > 0, prior + s * (absent + hits), -np.inf)
                    x = x - x.max(axis=1, keepdims=True)
                    loss[e, a, s] = float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(d)), d]).sum())
        level, smooth, shrink = min(loss, key=loss.get)
    p, words, _ = _telling(counts, "k", n, level)
    prior, absent, shift = _evidence(p, n, smooth)
    return {"n": n, "base": prior + shrink * absent, "words": {w: (shrink * x).tolist() for w, x in zip(words, shift)}, "chosen": (level, smooth, shrink)}


def _telling(counts: DataFrame, name: str, n: np.ndarray, level: float):
    """The words that some domain has more often than the others by a likelihood-ratio test: their counts (one row a
    word) by domain, the words, and the test's chances."""
    live, all_n = np.flatnonzero(n), float(n.sum())
    if len(live) < 2:
        return np.zeros((0, len(DOMAINS))), [], np.zeros(0)
    k = [F.col(f"{name}{i}") for i in range(len(DOMAINS))]
    total = sum(k[1:], k[0])
    part = lambda x, e: F.when((x > 0) & (e > 0), x * F.log(x / e)).otherwise(0.0)

    def test(i):
        share = float(n[i] / all_n)
        absent, rest = F.lit(float(n[i])) - k[i], total - k[i]
        out = part(k[i], total * share) + part(rest, total * (1 - share)) + part(absent, (all_n - total) * share) + part(all_n - total - absent, (all_n - total) * (1 - share))
        return F.when(k[i] > total * share, 2 * out).otherwise(0.0)

    shares = [(k[i] + 0.5) / float(n[i] + 1) for i in live]
    best = F.greatest(*(test(int(i)) for i in live))
    top = (counts.withColumn("best", best).where((F.col("best") >= NormalDist().inv_cdf(level) ** 2) & (F.greatest(*shares) >= RATIO * F.least(*shares)))
           .select("w", "best", *k).orderBy(F.desc("best"), "w").limit(MOST_WORDS).orderBy("w").collect())
    odds = np.array([NormalDist().cdf(-r.best ** 0.5) for r in top])
    return np.array([[r[f"{name}{i}"] for i in range(len(DOMAINS))] for r in top]).reshape(-1, len(DOMAINS)), [r.w for r in top], odds


def _evidence(k: np.ndarray, n: np.ndarray, smooth: float):
    """Log priors, the log-odds of no word at all, and each word's log-odds shifts by its presence."""
    p = (k + smooth) / (n + 2 * smooth)
    return np.log((n + 1e-3) / (n.sum() + 1e-3 * len(n))), np.log1p(-p).sum(axis=0), np.log(p) - np.log1p(-p)


def _sum_of(column: str, i: int, start: float):
    return F.aggregate(column, F.lit(start), lambda s, v: s + v[i])


def posteriors(documents: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """documents (as struct ``row``) with n_tokens and the posteriors p0, p1, ...; domains without labelled rows have 0."""
    live = [i for i in range(len(DOMAINS)) if model["n"][i] > 0] or [0]
    out = documents.select(F.struct("*").alias("row"), _tokens(text).alias("w"))
    if model["words"]:
        shifts = F.create_map(*(x for w, v in sorted(model["words"].items()) for x in (F.lit(w), F.array(*(F.lit(float(y)) for y in v)))))
        hits = F.transform(F.array_intersect("w", F.array(*(F.lit(w) for w in sorted(model["words"])))), lambda w: F.element_at(shifts, w))
    else:
        hits = F.array().cast("array<array<double>>")
    out = out.select("row", F.size("w").cast("long").alias("n_tokens"), hits.alias("hits"))
    logs = {i: _sum_of("hits", i, float(model["base"][i])) for i in live}
    out = out.select("row", "n_tokens", *(logs[i].alias(f"l{i}") for i in live))
    most = F.greatest(*(F.col(f"l{i}") for i in live)) if len(live) > 1 else F.col(f"l{live[0]}")
    raw = {i: F.exp(F.col(f"l{i}") - most) for i in live}
    return out.select("row", "n_tokens", *((raw[i] / sum((raw[j] for j in live), F.lit(0.0)) if i in live else F.lit(0.0)).alias(f"p{i}") for i in range(len(DOMAINS))))


class Step(NamedTuple):
    """One move of the rates: rows that are free under the miss ``off`` go down by their posteriors' product with ``move``."""

    off: tuple[float, ...]
    move: tuple[float, ...]


class Mixture(NamedTuple):
    """Rated rows, the targets, what the rates come to, and whether the projected gradient fell under ``CLOSE``."""

    rows: DataFrame
    targets: tuple[float, ...]
    got: tuple[float, ...]
    settled: bool


def _dot(p: list[Column], v) -> Column:
    return sum((p[i] * v[i] for i in range(len(p))), F.lit(0.0))


def _free(x: Column, slope: Column, most: float | None) -> Column:
    """Rates that may follow their gradient: not at a bound that it points out of."""
    inside = (x > 0) | (slope < 0)
    return inside if most is None else inside & ((x < most) | (slope > 0))


def _bounded(x: Column, most: float | None) -> Column:
    return F.greatest(F.lit(0.0), x) if most is None else F.least(F.lit(float(most)), F.greatest(F.lit(0.0), x))


def rate_column(steps: list[Step], weight: Column, p: list[Column], most: float | None) -> Column:
    """A row's rate after ``steps``, from 1: a fold over the steps, so rows need no key to get their rates."""
    k = len(p)
    start = F.lit(1.0 if most is None else min(1.0, float(most)))
    if not steps:
        return start
    moves = F.array(*[F.array(*[F.lit(float(v)) for v in (*s.off, *s.move)]) for s in steps])
    return F.aggregate(moves, start, lambda x, s: F.when(
        _free(x, _dot(p, [s[i] for i in range(k)]), most), _bounded(x - weight * _dot(p, [s[k + i] for i in range(k)]), most)).otherwise(x))


def fit_rates(numbers: DataFrame, targets: np.ndarray, store: Store, most: float | None = None, limit: int = STEPS) -> tuple[list[Step], np.ndarray, np.ndarray, bool]:
    """Steps of projected gradient descent on the squared miss of ``targets``, for rates from 0 to ``most`` (no bound if None).

    The gradient of a row is its tokens times posteriors times the miss. Rows are scaled by their tokens and by the
    tokens of the domains that they belong to, and the rates off their bounds also by the domains' second
    moments (two-metric projection), which leaves a step down hill. Each step takes one pass over the stored numbers for
    the moments and one that tries all step lengths, of the plain and the scaled direction, at once. It ends when
    the projected gradient is under ``CLOSE`` of all tokens: then no rates meet the targets more closely. Returns the
    steps, the domains' tokens, what the rates come to, and whether it ended so.
    """
    k = len(targets)
    p = [F.col(f"p{i}") for i in range(k)]
    t, x = F.col("n_tokens"), F.col("x")
    first = numbers.agg(*(F.sum(t * p[i]).alias(f"s{i}") for i in range(k))).first()
    mass = np.array([first[i] or 0.0 for i in range(k)])
    total = float(mass.sum())
    if not total:
        return [], mass, mass, True
    weight = _weight(p, mass)
    state = store.put(numbers.select("n_tokens", *p, F.lit(1.0 if most is None else min(1.0, float(most))).alias("x")), "rates")
    got = mass * (1.0 if most is None else min(1.0, float(most)))
    steps, settled, bound = [], False, None
    for _ in range(limit):
        off = got - targets
        slope = _dot(p, [float(v) for v in off])
        free = _free(x, slope, most)
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        part = lambda cond, name: [F.sum(F.when(cond, t * weight * p[i] * p[j])).alias(f"{name}{i}_{j}") for i, j in pairs]
        seen = state.agg(*part(free, "f"), *part(F.lit(True), "a"), F.sum(F.when(free, t * weight * slope * slope)).alias("g")).first()
        square = lambda name: np.array([[seen[f"{name}{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
        bound = float(np.linalg.eigvalsh(square("a"))[-1])
        if (seen["g"] or 0.0) ** 0.5 <= CLOSE * total:
            settled = True
            break
        values, axes = np.linalg.eigh(square("f"))
        scaled = axes @ (np.where(values > 1e-9 * bound, 1 / np.maximum(values, 1e-300), 0) * (axes.T @ off))
        tries = [Step(tuple(map(float, off)), tuple(map(float, a * m))) for m in (scaled, off / bound) for a in LENGTHS]
        moved = [F.when(free, _bounded(x - weight * _dot(p, s.move), most)).otherwise(x) for s in tries]
        sums = state.agg(*(F.sum(t * m * p[i]).alias(f"t{n}_{i}") for n, m in enumerate(moved) for i in range(k))).first()
        ends = np.array([[sums[f"t{n}_{i}"] or 0.0 for i in range(k)] for n in range(len(tries))])
        loss = ((ends - targets) ** 2).sum(axis=1)
        best = int(loss.argmin())
        if loss[best] >= (off @ off) * (1 - 1e-9):
            break
        steps.append(tries[best])
        got = ends[best]
        nxt = store.put(state.select("n_tokens", *p, moved[best].alias("x")), "rates")
        store.drop(state)
        state = nxt
    store.drop(state)
    return steps, mass, got, settled


def _weight(p: list[Column], mass: np.ndarray) -> Column:
    of = _dot(p, [float(v) for v in mass])
    return F.when(of > 0, 1 / of).otherwise(F.lit(0.0))


def fit(documents: DataFrame, labels: DataFrame, shares: dict[str, float] | None = None, factors: dict[str, float] | None = None, text: str = "text",
        keep: list[str] | None = None, most: float | None = None) -> Mixture:
    """Classify, then fit the rates; see ``mix``."""
    store = Store(documents.sparkSession, "mixing")
    whole = posteriors(documents, classifier(documents, labels, text, store=store), text)
    p = [F.col(f"p{i}") for i in range(len(DOMAINS))]
    carried = F.struct(*(F.col(f"row.{c}") for c in keep)).alias("row") if keep else F.col("row")
    soft = store.put(whole.select(carried, "n_tokens", *p), "posteriors")
    numbers = soft.select("n_tokens", *p)
    now = numbers.agg(*(F.sum(F.col("n_tokens") * p[i]).alias(f"s{i}") for i in range(len(DOMAINS)))).first()
    now = np.array([x or 0.0 for x in now])
    if shares is not None:
        want = np.array([shares.get(d, 0.0) for d in DOMAINS]) * (now > 0)
        want = want / max(want.sum(), 1e-12) * now.sum()
    else:
        want = now * np.array([(factors or {}).get(d, 1.0) for d in DOMAINS])
    steps, mass, got, settled = fit_rates(numbers, want, store, most)
    if not settled:
        warnings.warn(f"rates come to {got.round().tolist()} tokens for targets of {want.round().tolist()}; the least miss may be smaller still")
    return Mixture(soft.withColumn("rate", rate_column(steps, _weight(p, mass), p, most)), tuple(want), tuple(got), settled)


def mix(documents: DataFrame, labels: DataFrame, shares: dict[str, float] | None = None, factors: dict[str, float] | None = None, text: str = "text",
        keep: list[str] | None = None, most: float | None = None) -> DataFrame:
    """(row, n_tokens, p0, p1, p2, rate): every row of ``documents`` as a struct (with only the columns ``keep`` if given), with its posteriors and rate.

    Texts are read and tokenised once: the rows are stored with their posteriors, and the rates are found on these numbers.

    Targets are ``shares`` of all tokens, or each domain's expected tokens times ``factors``; the rates, from 0 to ``most``, are those whose
    expected tokens come closest to them in squares (``fit`` also gives the targets and what they come to). Where targets are out of
    reach the closest point is taken, and if it isn't found in ``STEPS`` steps a warning tells what is missed. A null or empty
    text has no tokens and keeps rate by its posteriors. Repeated rows have the same rate. Domains without a
    labelled document have posterior 0 and their target is left out; without labels every document is clean.
    No rows give no rows. Other columns are carried, not read.
    """
    return fit(documents, labels, shares, factors, text, keep, most).rows
