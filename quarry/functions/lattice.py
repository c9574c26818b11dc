"""All segmentations of many words into pieces of a vocabulary, in numpy.

The pieces are a flat trie walked from every position of every word at once; the
edges found are grouped by the position in their word, so one numpy step settles
that position in all words. Sums and best ways are kept as logarithms, so a word
may be of any length. Piece number 0 is the unknown one: any single character
that is no piece itself. Time is linear in the characters times the longest piece.
"""

from __future__ import annotations

import copy

import numpy as np


class Trie:
    """Sorted (node, character) keys of all prefixes; ``pieces[0]`` is not used."""

    def __init__(self, pieces: list[str]):
        nodes = {"": 0}
        for p in pieces:
            for k in range(1, len(p) + 1):
                nodes.setdefault(p[:k], len(nodes))
        self.longest = max(map(len, pieces), default=1)
        self.letters = np.array(sorted({ord(c) for p in pieces for c in p} or {0}), np.uint32)
        place = {int(c): i for i, c in enumerate(self.letters)}
        keys = np.array([nodes[p[:-1]] * len(place) + place[ord(p[-1])] for p in nodes if p], np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], np.array([n for p, n in nodes.items() if p], np.int32)[order]
        self.piece = np.full(len(nodes), -1, np.int32)
        for i, p in enumerate(pieces):
            if p:
                self.piece[nodes[p]] = i

    def only(self, at: np.ndarray) -> Trie:
        """The trie of the pieces ``at``, numbered anew in that order; its nodes are shared."""
        new = np.full(int(max(self.piece.max(initial=0), at.max(initial=0))) + 1, -1, np.int32)
        new[at] = np.arange(len(at))
        out = copy.copy(self)
        out.piece = np.where(self.piece >= 0, new[self.piece], -1).astype(np.int32)
        return out

    def coded(self, chars: np.ndarray) -> np.ndarray:
        """Places of characters among the pieces' own, -1 for others."""
        at = np.minimum(np.searchsorted(self.letters, chars), len(self.letters) - 1)
        return np.where(self.letters[at] == chars, at, -1).astype(np.int64)

    def edges(self, codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece) of every piece in the characters; ``left``: those up to the word's end."""
        at, node = np.arange(len(codes), dtype=np.int64), np.zeros(len(codes), np.int64)
        out = []
        for k in range(self.longest):
            more = left[at] > k
            at, node = at[more], node[more]
            c = codes[at + k]
            key = node * len(self.letters) + c
            slot = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            found = (self.keys[slot] == key) & (c >= 0) if len(self.keys) else np.zeros(len(at), bool)
            if not k:
                alone = found.copy()
                alone[found] = self.piece[self.child[slot[found]]] >= 0
                unknown = at[~alone]
                out.append((unknown, np.ones(len(unknown), np.int64), np.zeros(len(unknown), np.int32)))
            at, node = at[found], self.child[slot[found]].astype(np.int64)
            p = self.piece[node]
            whole = p >= 0
            out.append((at[whole], np.full(int(whole.sum()), k + 1, np.int64), p[whole]))
            if not len(at):
                break
        return tuple(np.concatenate(x) for x in zip(*out))


def log_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log of the sum of exponentials of each run of rows that begins at ``first``."""
    top = np.maximum.reduceat(values, first, axis=0)
    runs = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(values))))
    return top + np.log(np.add.reduceat(np.exp(values - top[runs]), first, axis=0))


class Lattice:
    """Positions of all words lie in one line; a word has a position more than letters."""

    def __init__(self, words: list[str], trie: Trie, whole: bool = True):
        """``whole``: a piece that is all of a word counts as an edge (not where a piece is to be replaced)."""
        length = np.array([len(w) for w in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.base = np.concatenate(([0], np.cumsum(length + 1)))[:-1]
        self.end = self.base + length
        self.size = int(length.sum() + len(words))
        word = np.repeat(np.arange(len(words)), length)
        place = np.arange(len(chars)) - np.repeat(np.cumsum(length) - length, length)
        start, size, self.p = trie.edges(trie.coded(chars), length[word] - place)
        if not whole:
            part = (size < length[word[start]]) | (size == 1)
            start, size, self.p = start[part], size[part], self.p[part]
        self.start = self.base[word[start]] + place[start]
        self.stop, self.into, self.out = self.start + size, place[start] + size, place[start]

    def _runs(self, by: np.ndarray, node: np.ndarray):
        """(edges, first of each node's run, nodes) for each value of ``by``, ascending."""
        order = np.lexsort((node, by))
        steps = np.flatnonzero(np.diff(by[order], prepend=-1))
        for a, b in zip(steps, np.append(steps[1:], len(order))):
            rows = order[a:b]
            first = np.flatnonzero(np.diff(node[rows], prepend=-1))
            yield rows, first, node[rows[first]]

    def forward(self, logp: np.ndarray, seeds: np.ndarray | None = None) -> np.ndarray:
        """Log of the sum over all ways to each position, a column per model. ``seeds`` are
        the sums at the first positions of a single word that goes on from an earlier block."""
        alpha = np.full((self.size, logp.shape[1]), -np.inf)
        alpha[self.base] = 0.0
        known = 0
        if seeds is not None:
            known = len(seeds) - 1
            alpha[: len(seeds)] = seeds
        for rows, first, nodes in self._runs(self.into, self.stop):
            if self.into[rows[0]] > known:
                alpha[nodes] = log_sums(alpha[self.start[rows]] + logp[self.p[rows]], first)
        return alpha

    def log_likelihood(self, logp: np.ndarray) -> np.ndarray:
        """One row per word, one column per model."""
        return self.forward(logp)[self.end]

    def expected(self, logp: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in ``count`` copies of the words, for one model."""
        alpha = self.forward(logp[:, None])[:, 0]
        beta = np.full(self.size, -np.inf)
        beta[self.end] = 0.0
        for rows, first, nodes in reversed(list(self._runs(self.out, self.start))):
            beta[nodes] = log_sums((logp[self.p[rows]] + beta[self.stop[rows]])[:, None], first)[:, 0]
        word = np.searchsorted(self.base, self.start, side="right") - 1
        share = np.exp(alpha[self.start] + logp[self.p] + beta[self.stop] - alpha[self.end][word])
        return np.bincount(self.p, share * count[word], len(logp))

    def best(self, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, pieces, last edge) of the best way to each position; of equal ones the one whose last piece is the longest."""
        score = np.full(self.size, -np.inf)
        score[self.base] = 0.0
        count, edge = np.zeros(self.size, np.int64), np.full(self.size, -1, np.int64)
        for rows, first, nodes in self._runs(self.into, self.stop):
            value = score[self.start[rows]] + logp[self.p[rows]]
            top = np.maximum.reduceat(value, first)
            runs = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(rows))))
            start = np.where(value == top[runs], self.start[rows], np.iinfo(np.int64).max)
            least = np.minimum.reduceat(start, first)
            chosen = np.flatnonzero(start == least[runs])
            score[nodes], count[nodes], edge[nodes] = top, count[least] + 1, rows[chosen]
        return score, count, edge

    def ends(self, edge: np.ndarray) -> list[list[int]]:
        """For each word the ends of its best pieces, as places in the word."""
        out = []
        for a, b in zip(self.base.tolist(), self.end.tolist()):
            own = []
            while b > a:
                own.append(b - a)
                b = int(self.start[edge[b]])
            out.append(own[::-1])
        return out
