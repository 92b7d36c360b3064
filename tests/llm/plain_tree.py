"""A suffix tree in memory, to hold the stored tables of the suffix tree against."""

import numpy as np

from coursematch.llm.suffixtree import DISCOUNT, DIVERGENCE, END, LEAST_CONTEXT, find

BITS = 24                   # places for a word's number in a pair


class Tree:
    """The same in memory for contexts of up to two words, to hold the tables against: words (hash, count), pairs
    and triples with their log10 probabilities, and the states' back-off weights."""

    def __init__(self, total: int, kinds: int):
        self.total, self.kinds = total, kinds
        self.words = self.n = np.zeros(0, np.int64)
        self.contexts = [np.zeros(0, bool), np.zeros(0, bool)]      # by word number, by pair number: candidates
        self.keys: list[np.ndarray] = [np.zeros(0, np.int64)] * 2   # sorted (context number, word number)
        self.log: list[np.ndarray] = [np.zeros(0)] * 2
        self.back: list[np.ndarray] = [np.zeros(0), np.zeros(0)]    # log10 back-off weight of a state; nan: no state

    def root(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 1.0) / (self.total + self.kinds + 1))

    def numbers(self, t: np.ndarray, first: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The word numbers of tokens (-1: not in the tree), and the candidate context numbers of each length."""
        w = find(self.words, t)
        one = np.full(len(t), -1)
        one[1:] = w[:-1]
        one[first[:-1]] = -1
        out = [np.where((one >= 0) & self.contexts[0][one], one, -1) if len(self.words) else one]
        if depth > 1:
            before = np.full(len(t), -1)
            before[1:] = out[0][:-1]
            before[first[:-1]] = -1
            pair = find(self.keys[0], np.where((before >= 0) & (one >= 0), (before << BITS) | one, -1))
            out.append(np.where((pair >= 0) & self.contexts[1][pair], pair, -1) if len(self.keys[0]) else np.full(len(t), -1))
        return w, out

    def lower(self, keys: np.ndarray, level: int) -> np.ndarray:
        """log10 probability of each (context, word) of a level under the context's suffix."""
        ctx, w = keys >> BITS, keys & ((1 << BITS) - 1)
        base = self.root(self.n[w])
        if level == 0:
            return base
        suffix = self.keys[0][ctx] & ((1 << BITS) - 1)
        i = find(self.keys[0], (suffix << BITS) | w)
        weight = self.back[0][suffix]
        return np.where(np.isnan(weight), base, np.where(i >= 0, self.log[0][np.maximum(i, 0)], weight + base))

    def learn(self, level: int, keys: np.ndarray, n: np.ndarray) -> None:
        """Keep the contexts of a level whose next words diverge, and their probabilities."""
        order = np.argsort(keys)
        keys, n = keys[order], n[order].astype(float)
        ctx = keys >> BITS
        size = (self.n if level == 0 else self._pairs)[ctx].astype(float)
        width = len(self.contexts[level])
        below = 10 ** self.lower(keys, level)
        p = n / size
        gather = lambda x: np.bincount(ctx, x, minlength=width)
        rest, rest_below = np.maximum(1 - gather(p), 1e-12), np.maximum(1 - gather(below), 1e-12)
        kl = gather(p * np.log(p / below)) + rest * np.log(rest / rest_below)
        kinds = gather(np.ones(len(n)))
        whole = np.zeros(width)
        whole[ctx] = size
        kept = (kinds > 0) & (kl >= DIVERGENCE) & (2 * whole * kl >= kinds + 3 * np.sqrt(2 * kinds))
        held = (n - DISCOUNT) / size
        back = np.where(kept, 1 - gather(held), np.nan)
        self.keys[level] = keys
        self.log[level] = np.where(kept[ctx], np.log10(held + np.nan_to_num(back)[ctx] * below), np.log10(below))
        self.back[level] = np.log10(back)
        if level == 0:
            self._pairs = n.astype(np.int64)
            self.contexts[1] = (n >= LEAST_CONTEXT) & (self.words[keys & ((1 << BITS) - 1)] != END)

    def score(self, t: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token its word number, its log10 root probability and its log10 probability; for a word
        that is not in the tree, 0 and what its root probability is weighted with."""
        w, (one, two) = self.numbers(t, first, 2)
        base = np.where(w >= 0, self.root(self.n[w]) if len(self.n) else 0.0, 0.0)
        out = base
        for level, ctx in ((0, one), (1, two)):
            if not len(self.back[level]):
                continue
            weight = np.where(ctx >= 0, self.back[level][ctx], np.nan)
            i = find(self.keys[level], np.where((ctx >= 0) & (w >= 0), (ctx << BITS) | w, -1))
            out = np.where(np.isnan(weight), out, np.where(i >= 0, self.log[level][np.maximum(i, 0)], weight + out))
        return w, base, out
