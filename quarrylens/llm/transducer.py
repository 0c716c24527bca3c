"""Weighted acyclic automata over words: each accepted n-gram carries the sum of weights on its path.

States are built from sorted n-grams, deepest first: a state is complete when the n-grams leave its
prefix, its least weight moves to the arc into it, and a state equal to a registered one is
replaced by that.  Arcs of a state are sorted by label, so two automata are intersected by search.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

# Weight of "does not end here".
OPEN = -1


class Transducer:
    """``labels`` (sorted words), states with a final weight or OPEN, and their arcs."""

    def __init__(self, labels: list[bytes], first: np.ndarray, final: np.ndarray, label: np.ndarray, target: np.ndarray, weight: np.ndarray):
        self.labels, self.first, self.final = labels, first, final
        self.label, self.target, self.weight = label, target, weight

    @property
    def root(self) -> int:
        return len(self.final) - 1

    @classmethod
    def build(cls, labels: list[bytes], grams: np.ndarray, weights: np.ndarray) -> Transducer:
        """From distinct n-grams in sorted order (rows of label numbers, -1 behind the last word)."""
        rows, depth = grams.shape
        size = (grams >= 0).sum(1)
        differs = np.ones((rows, depth), bool)
        if rows:
            differs[1:] = np.logical_or.accumulate(grams[1:] != grams[:-1], axis=1)
        register: dict[bytes, int] = {struct.pack("<q", 0): 0}
        final, arcs = [0], [np.zeros((0, 3), np.int64)]
        # Of the nodes one level deeper: their rows, states and the weight their arc must carry.
        below = np.zeros(0, np.int64)
        states = pushed = below
        for d in range(depth, -1, -1):
            if d:
                here = np.flatnonzero(differs[:, d - 1] & (size >= d))
            else:
                here = np.zeros(1, np.int64)
            ends = np.where(size[here] == d, weights[here], OPEN) if d and rows else np.full(len(here), OPEN)
            begin, end = np.searchsorted(below, here), np.searchsorted(below, np.r_[here[1:], rows])
            own = np.zeros((len(below), 3), np.int64)
            if len(below):
                own[:, 0], own[:, 1], own[:, 2] = grams[below, d], states, pushed
            least = np.where(ends >= 0, ends, np.iinfo(np.int64).max)
            full = end > begin
            if full.any():
                inner = np.minimum.reduceat(own[:, 2], begin[full])
                least[full] = np.minimum(least[full], inner)
            if not d:
                # Nothing leads into the first state; its arcs keep their weights.
                least[:] = 0
            own[:, 2] -= np.repeat(least, end - begin)
            rest = np.where(ends >= 0, ends - least, OPEN)
            numbers = np.zeros(len(here), np.int64)
            for i in np.flatnonzero(full | (rest != 0)).tolist():
                mine = own[begin[i] : end[i]]
                key = struct.pack("<q", rest[i]) + mine.tobytes()
                at = register.get(key)
                if at is None or not d:
                    at = register[key] = len(final)
                    final.append(int(rest[i]))
                    arcs.append(mine)
                numbers[i] = at
            below, states, pushed = here, numbers, least
        every = np.concatenate(arcs)
        first = np.r_[0, np.cumsum([len(a) for a in arcs])].astype(np.int64)
        return cls(labels, first, np.array(final, np.int64), every[:, 0], every[:, 1], every[:, 2])

    def grams(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """All n-grams and their weights, in no fixed order."""
        state, total = np.array([self.root]), np.zeros(1, np.int64)
        path = np.full((1, depth), -1, np.int32)
        found, weights = [], []
        for d in range(depth + 1):
            ends = self.final[state] >= 0
            if d:
                found.append(path[ends])
                weights.append(total[ends] + self.final[state[ends]])
            if d == depth:
                break
            arc, source = self._fan(state)
            path, total, state = path[source], total[source] + self.weight[arc], self.target[arc]
            path[:, d] = self.label[arc]
        return np.concatenate(found), np.concatenate(weights)

    def _fan(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All arcs of the given states, and which of the states each leaves."""
        fan = self.first[state + 1] - self.first[state]
        source = np.repeat(np.arange(len(state)), fan)
        return np.arange(len(source)) + np.repeat(self.first[state] - np.cumsum(fan) + fan, fan), source

    def compose(self, counts: Transducer, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(own weight, weight in ``counts``) of every n-gram that both accept: pairs of states, level by level."""
        place = {w: i for i, w in enumerate(counts.labels)}
        names = np.array([place.get(w, -1) for w in self.labels] or [-1], np.int64)
        width = max(1, len(counts.labels))
        arcs = np.repeat(np.arange(len(counts.final)), np.diff(counts.first)) * width + counts.label
        mine, theirs = np.array([self.root]), np.array([counts.root])
        own, other = np.zeros(1, np.int64), np.zeros(1, np.int64)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for d in range(depth + 1):
            ends = (self.final[mine] >= 0) & (counts.final[theirs] >= 0)
            out.append((own[ends] + self.final[mine[ends]], other[ends] + counts.final[theirs[ends]]))
            arc, source = self._fan(mine)
            key = theirs[source] * width + names[self.label[arc]]
            at = np.minimum(np.searchsorted(arcs, key), max(0, len(arcs) - 1))
            both = (arcs[at] == key) & (names[self.label[arc]] >= 0) if len(arcs) else np.zeros(len(key), bool)
            arc, source, at = arc[both], source[both], at[both]
            own, other = own[source] + self.weight[arc], other[source] + counts.weight[at]
            mine, theirs = self.target[arc], counts.target[at]
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def to_bytes(self) -> bytes:
        names = b"\n".join(self.labels)
        wide = "<u4" if not len(self.weight) or self.weight.max() < 1 << 32 else "<i8"
        head = struct.pack("<5q", len(self.labels), len(names), len(self.final), len(self.label), int(wide == "<i8"))
        parts = [np.diff(self.first).astype("<u4"), self.final.astype("<i8"), self.label.astype("<u4"), self.target.astype("<u4"), self.weight.astype(wide)]
        return head + names + b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        n_labels, n_names, n_states, n_arcs, wide = struct.unpack_from("<5q", data)
        at = 40 + n_names
        labels = data[40:at].split(b"\n") if n_labels else []
        parts = []
        kinds = [("<u4", n_states), ("<i8", n_states), ("<u4", n_arcs), ("<u4", n_arcs), ("<i8" if wide else "<u4", n_arcs)]
        for kind, n in kinds:
            part = np.frombuffer(data, kind, n, at)
            at += part.nbytes
            parts.append(part.astype(np.int64))
        fan, final, label, target, weight = parts
        return cls(labels, np.r_[0, np.cumsum(fan)], final, label, target, weight)


def order_of(grams: np.ndarray, labels: int) -> np.ndarray:
    """Sorting order of the rows; one packed number each where that fits into 63 bits."""
    depth = grams.shape[1]
    if (labels + 1) ** depth < 1 << 63:
        key = np.zeros(len(grams), np.int64)
        for d in range(depth):
            key = key * (labels + 1) + grams[:, d] + 1
        return np.argsort(key, kind="stable")
    return np.lexsort(grams.T[::-1])


def union(parts: Sequence[Transducer], depth: int, at_least: int = 0) -> Transducer:
    """One automaton of all n-grams with their summed weights; sums below ``at_least`` are left out."""
    labels = sorted(set().union(*[p.labels for p in parts]))
    place = {w: i for i, w in enumerate(labels)}
    grams, weights = [np.zeros((0, depth), np.int32)], [np.zeros(0, np.int64)]
    for part in parts:
        found, weight = part.grams(depth)
        names = np.array([place[w] for w in part.labels] + [-1], np.int32)
        grams.append(names[found])
        weights.append(weight)
    every, weight = np.concatenate(grams), np.concatenate(weights)
    if len(every):
        order = order_of(every, len(labels))
        every, weight = every[order], weight[order]
        heads = np.flatnonzero(np.r_[True, (every[1:] != every[:-1]).any(1)])
        every, weight = every[heads], np.add.reduceat(weight, heads)
        keep = weight >= at_least
        every, weight = every[keep], weight[keep]
    return from_grams(labels, every, weight)


def from_grams(labels: list[bytes], grams: np.ndarray, weights: np.ndarray) -> Transducer:
    """Build from sorted n-grams with only the labels that occur in them."""
    used = np.unique(grams)
    used = used[used >= 0]
    names = np.full(len(labels) + 1, -1, np.int32)
    names[used] = np.arange(len(used))
    return Transducer.build([labels[i] for i in used.tolist()], names[grams], weights)
