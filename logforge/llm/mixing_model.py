"""A bit-level context-mixing model of texts: hashed contexts, gated weights, adaptive refinement.

A text is its words, lower-cased, then one end.  A frequent word, the end, and
the escape to a rare word are leaves of a code tree; the bytes of a rare word are
leaves of another.  Each step down a tree is a bit.  Three predictors estimate it
from counts: for words the step itself, the step after the last very frequent
word, and after the last two of these; for bytes the step after the last two and four
bytes of the word and after all of them.  Their log odds are added with weights
that a gate chooses by how often the contexts were seen, and a map from estimated
to observed chances refines the sum.  The words' weights and map go on learning
through each text; how a rare word spells depends on no text, so its do not.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np

from .words import Words, mix, prefix_hash, starts

INPUTS = 3
LEVELS = 4
GATES = LEVELS * LEVELS
# Words of a text that are coded with the same weights and map before these learn; the first time is cut here too, so that short texts learn.
TURN = 128
EARLY = (16, 32, 64)
# Bits that the fitted chance of a map's entry weighs as much as.
HOLD = 64
# Leaves that are coded at once; a text's turn is never parted, so no text's score depends on others.
AT_ONCE = 1 << 11
# Ids below this are very frequent words; a place's state is the last of them before it, or none, and the last but one.
FREQUENT = 64
STATES = (FREQUENT + 1) ** 2
SCALE = 1 / 1024
BINS = 24
# Log odds from -8 to 8, rounded to halves, of which the fit counts combinations.
ODDS_BINS = 33
CELLS = GATES * ODDS_BINS**INPUTS
END_HASH = 0x0123456789ABCDEF

_U = np.uint64


class Code:
    """A prefix code, short for frequent leaves; each path is a run of (node, bit)."""

    def __init__(self, counts: np.ndarray):
        n = leaves = len(counts)
        heap = [(int(c) + 1, s) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        left, right = [], []
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            left.append(x)
            right.append(y)
            heapq.heappush(heap, (a + b, n))
            n += 1
        parent, side = np.full(n, -1), np.zeros(n, np.uint8)
        inner = np.arange(leaves, n)
        parent[left], parent[right], side[right] = inner, inner, 1
        node, at = [], np.arange(leaves)
        bits = []
        while (parent[at] >= 0).any():
            node.append(parent[at] - leaves)
            bits.append(side[at])
            at = np.where(parent[at] >= 0, parent[at], at)
        # Walked from the leaves up; paths run from the root down.
        node, bits = (np.array(x).T.reshape(leaves, -1) for x in (node, bits))
        depth = (node >= 0).sum(1)
        self.length = depth.astype(np.int32)
        self.first = np.concatenate([[0], np.cumsum(depth)[:-1]]).astype(np.int32)
        columns = np.arange(node.shape[1])
        pick = np.repeat(depth, depth) - 1 - (np.arange(depth.sum()) - np.repeat(self.first, depth))
        leaf = np.repeat(np.arange(leaves), depth)
        self.node = node[leaf, columns[pick]].astype(np.uint32) if depth.sum() else np.zeros(0, np.uint32)
        self.bit = bits[leaf, columns[pick]] if depth.sum() else np.zeros(0, np.uint8)
        self.nodes = n - leaves

    def paths(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each step on the paths to some leaves: which leaf, and where its node and bit stand."""
        n = self.length.take(leaf)
        cut = np.cumsum(n)
        which = np.repeat(np.arange(len(leaf)), n)
        return which, np.arange(cut[-1] if len(cut) else 0) + (self.first.take(leaf) - (cut - n)).take(which)

    def node_counts(self, counts: np.ndarray) -> np.ndarray:
        """How often each node's steps were 0 and 1, if leaves came up ``counts`` times."""
        weight = np.repeat(np.asarray(counts, np.float64), self.length)
        return np.bincount(self.node.astype(np.int64) * 2 + self.bit, weights=weight, minlength=2 * self.nodes)


@dataclass
class Stream:
    """Leaves in order, with the row of each, its turn in the row and its contexts; a context of None is none."""

    leaf: np.ndarray
    row: np.ndarray
    turn: np.ndarray
    contexts: list[np.ndarray | None]


class Vocabulary:
    """Frequent words' hashes and ids, by descending count; found by two probes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, others: int):
        bits = max(10, int(4 * len(hashes)).bit_length())
        self.mask = _U((1 << bits) - 1)
        self.slots = np.full(1 << bits, -1, np.int32)
        ids = np.arange(len(hashes), dtype=np.int32)
        left = ids
        for shift in (0, 30):
            slot = ((hashes[left] >> _U(shift)) & self.mask).astype(np.int64)
            free = self.slots[slot] < 0
            self.slots[slot[free][::-1]] = left[free][::-1]
            left = left[self.slots[slot] != left]
        self.hashes = hashes
        dropped = np.zeros(len(hashes), bool)
        dropped[left] = True
        # The few words that find no slot are rare ones.
        self.counts = np.append(np.where(dropped, 0, counts), others + counts[dropped].sum())
        self.escape = len(hashes)

    def ids(self, h: np.ndarray) -> np.ndarray:
        if not self.escape:
            return np.zeros(len(h), np.int32)
        one = self.slots[(h & self.mask).astype(np.int64)]
        two = self.slots[((h >> _U(30)) & self.mask).astype(np.int64)]
        return np.where((one >= 0) & (self.hashes[one] == h), one, np.where((two >= 0) & (self.hashes[two] == h), two, self.escape)).astype(np.int32)


def with_ends(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and word number (-1 for the end) of every token, ends included."""
    rows = len(words.first) - 1
    per = np.diff(words.first) + 1
    row = np.repeat(np.arange(rows), per)
    last = np.cumsum(per) - 1
    number = np.arange(len(row)) - row
    number[last] = -1
    h = np.full(len(row), END_HASH, _U)
    h[number >= 0] = words.hash
    return h, row, number


def places(vocabulary: Vocabulary, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaf, state and number in its row of every token."""
    ids = vocabulary.ids(h)
    n = len(ids)
    begin = np.searchsorted(row, row, "left") if n else np.zeros(0, np.int64)
    often = np.flatnonzero(ids < FREQUENT)
    # Of each place the last and the last but one very frequent word before it in its row.
    rank = np.searchsorted(often, np.arange(n), "left")
    state = np.zeros(n, np.int32)
    for back in (1, 2):
        state *= FREQUENT + 1
        if len(often):
            at = rank - back
            source = often[np.maximum(at, 0)]
            state += np.where((at >= 0) & (source >= begin), ids[source] + 1, 0).astype(np.int32)
    return ids, state, np.arange(n) - begin


def _state_contexts() -> list[np.ndarray]:
    last, before = (x.astype(_U) for x in divmod(np.arange(STATES), FREQUENT + 1))
    one = last * _U(0x9E3779B97F4A7C15)
    return [(mix(x) & _U(0xFFFFFFFF)).astype(np.uint32) for x in (one, one + before * _U(0xC2B2AE3D27D4EB4F))]


# Of each state: the contexts of one word and of two.
STATE_CONTEXTS = _state_contexts()


def word_stream(vocabulary: Vocabulary, h: np.ndarray, row: np.ndarray) -> Stream:
    ids, state, place = places(vocabulary, h, row)
    turn = place // TURN + sum((place >= k).astype(np.int32) for k in EARLY)
    return Stream(ids, row, turn.astype(np.int32), [None, *(c.take(state) for c in STATE_CONTEXTS)])


def byte_stream(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> Stream:
    """Bytes of some words of lower-case ``data``, each word closed by a blank."""
    n = end - start + 1
    cut = np.cumsum(n)
    begin = np.repeat(cut - n, n)
    place = np.arange(cut[-1] if len(cut) else 0) - begin
    value = data[np.minimum(np.repeat(start, n) + place, len(data) - 1)] if len(data) else np.zeros(len(place), np.uint8)
    value[cut - 1] = 0x20
    past = np.zeros(len(value), np.uint32)
    short = past
    for k in range(1, 5):
        back = np.zeros(len(value), np.uint32)
        back[k:] = value[:-k]
        back[place < k] = 0
        past = past | back << np.uint32(8 * (k - 1))
        if k == 2:
            short = past
    prefix = prefix_hash(value)
    from . import words

    whole = (prefix[:-1] - prefix[begin]) * words._inverses[begin] + place.astype(_U)
    low = lambda x, k: (mix(x.astype(_U) + _U(k << 40)) & _U(0xFFFFFFFF)).astype(np.uint32)
    return Stream(value.astype(np.int32), np.repeat(row, n), np.zeros(len(value), np.int32), [low(short, 1), low(past, 2), low(whole, 3)])


def hashed_slot(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    slot = (context + node * np.uint32(0x9E3779B1)) * np.uint32(0x85EBCA6B)
    slot ^= slot >> np.uint32(15)
    slot *= np.uint32(0xC2B2AE35)
    return slot >> np.uint32(32 - bits)


def steps(code: Code, bits: int, s: Stream, some: slice | np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of each bit of some leaves: which leaf, the bit, and the slot in each predictor's table."""
    leaf = s.leaf[some]
    which, flat = code.paths(leaf)
    node = code.node.take(flat)
    slots = [node if c is None else hashed_slot(c[some].take(which), node, bits) for c in s.contexts]
    return which, code.bit.take(flat), slots


class Counts:
    """Sums of what falls into the entries of a table."""

    def __init__(self, size: int):
        self.table = np.zeros(size)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, entry: np.ndarray, n: np.ndarray) -> None:
        self.held.append((entry, n))
        self.size += len(entry)
        if self.size > 1 << 20:
            self.settle()

    def settle(self) -> None:
        if self.held:
            entry, n = (np.concatenate(x) for x in zip(*self.held, strict=True))
            self.table += np.bincount(entry, weights=n, minlength=len(self.table))
            self.held.clear()
        self.size = 0


def as_inputs(pairs: np.ndarray) -> np.ndarray:
    """Log odds of counts, with how well they are known in the two lowest bits."""
    n = pairs.reshape(-1, 2).astype(np.float64)
    total = n.sum(1)
    odds = np.log((n[:, 1] + 0.3) / (n[:, 0] + 0.3))
    level = (total > 0).astype(np.uint16) + (total > 3) + (total > 30)
    return (np.clip(np.round(odds / SCALE), -8191, 8191).astype(np.int32) + 8192).astype(np.uint16) << np.uint16(2) | level.astype(np.uint16)


def cells(tables: list[np.ndarray], slots: list[np.ndarray], bit: np.ndarray, less: np.ndarray) -> np.ndarray:
    """The cell of each bit: its gate and the log odds that its predictors give it without ``less`` of the bits counted; twice that and the bit."""
    gate, cell = np.zeros(len(bit), np.int32), np.zeros(len(bit), np.int32)
    toward = bit.astype(np.int8) * np.int8(2) - np.int8(1)
    for k, (table, slot) in enumerate(zip(tables, slots, strict=True)):
        own = (slot.astype(np.int64) << 1) + bit
        same, other = np.maximum(table.take(own) - less, 0), table.take(own ^ 1)
        odds, total = np.log((same + np.float32(0.3)) / (other + np.float32(0.3))) * toward, same + other
        if k:
            gate = gate * LEVELS + (total > 0) + (total > 3) + (total > 30)
        cell = cell * ODDS_BINS + np.clip(np.rint(odds * np.float32(2)), -(ODDS_BINS // 2), ODDS_BINS // 2).astype(np.int32) + ODDS_BINS // 2
    return (gate * np.int32(ODDS_BINS**INPUTS) + cell) << 1 | bit


@dataclass
class Layer:
    """One tree with its predictors and their mixer."""

    code: Code
    bits: int
    inputs: list[np.ndarray]
    rate: float = 0.0  # of learning within a text
    weights: np.ndarray = field(default_factory=lambda: np.tile(np.array([0.4] * INPUTS + [0.0]), (GATES, 1)))
    refine: np.ndarray | None = None  # gate x bin: chance of a 1, from which each text's own map begins

    def read(self, slots: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """Log odds of each predictor for each bit, and the gate."""
        odds, gate = [], None
        for k, slot in enumerate(slots):
            raw = self.inputs[k].take(slot)
            odds.append((raw >> np.uint16(2)).astype(np.float32) * np.float32(SCALE) - np.float32(8192 * SCALE))
            if k:
                gate = (raw & np.uint16(3)) if gate is None else gate * np.uint16(LEVELS) + (raw & np.uint16(3))
        return odds, gate.astype(np.int64)

    def log10(self, s: Stream, rows: int) -> np.ndarray:
        """log10 probability of each row's leaves; rows ascend.  Rows do not depend on each other."""
        total = np.zeros(rows)
        several = bool(s.turn.any()) and self.rate > 0
        copies = rows if several else 1
        weights = np.repeat(self.weights.T.astype(np.float32)[:, None], copies, 1)
        maps = None if self.refine is None else np.repeat(self.refine.reshape(1, -1), copies, 0)
        order = np.argsort(s.turn, kind="stable") if several else None
        row = s.row[order] if several else s.row
        turns = int(s.turn.max(initial=0)) + 1 if several else 1
        bounds = np.searchsorted(s.turn[order], np.arange(turns + 1)) if several else [0, len(s.leaf)]
        last = np.zeros(rows, np.int32)
        last[s.row] = s.turn
        for t in range(turns):
            a, end = int(bounds[t]), int(bounds[t + 1])
            while a < end:
                b = min(a + AT_ONCE, end)
                if b < end:
                    b = a + (int(np.searchsorted(row[a:b], row[b])) or b - a)
                some = order[a:b] if several else slice(a, b)
                which, bit, slots = steps(self.code, self.bits, s, some)
                odds, gate = self.read(slots)
                lead = starts(row[a:b]) if several else np.zeros(1, np.int64)
                own = row[a:b][lead] if several else lead
                key = (np.repeat(np.arange(len(own)) * GATES, np.diff(np.append(lead, b - a))).take(which) + gate) if several else gate
                columns = weights[:, own].reshape(INPUTS + 1, -1)
                z = columns[INPUTS].take(key)
                for k in range(INPUTS):
                    z += columns[k].take(key) * odds[k]
                np.clip(z, -11, 11, out=z)
                p = np.float32(1) / (np.float32(1) + np.exp(-z))
                if maps is not None:
                    chance = maps[own].ravel()
                    at = key * BINS + np.clip((z + np.float32(8)) * np.float32(BINS / 16), 0, BINS - 1).astype(np.int64)
                    q = (p + chance.take(at)) * np.float32(0.5)
                else:
                    q = p
                cost = np.log(np.abs(q - (np.float32(1) - bit)))
                if len(cost):  # every leaf has a bit, or none has
                    n = self.code.length.take(s.leaf[some])
                    total += np.bincount(row[a:b], weights=np.add.reduceat(cost, np.cumsum(n) - n), minlength=rows)
                if several and (last[own] > t).any():
                    self._learn(columns, key, odds, bit - p)
                    weights[:, own] = columns.reshape(INPUTS + 1, -1, GATES)
                    if maps is not None:
                        self._observe(chance, at, bit)
                        maps[own] = chance.reshape(-1, GATES * BINS)
                a = b
        return total / np.log(10)

    @staticmethod
    def _observe(chance: np.ndarray, at: np.ndarray, bit: np.ndarray) -> None:
        """Move each row's chances toward the bits it has just had under them."""
        seen = np.bincount(at, minlength=len(chance))
        ones = np.bincount(at, weights=bit, minlength=len(chance))
        chance += ((ones - seen * chance) / (seen + HOLD)).astype(np.float32)

    def _learn(self, columns: np.ndarray, key: np.ndarray, odds: list[np.ndarray], error: np.ndarray) -> None:
        """A step of each row's weights in each gate against the mean error of the bits it has just had there."""
        size = columns.shape[1]
        step = self.rate / (np.bincount(key, minlength=size) + 64)
        for k in range(INPUTS + 1):
            moved = np.bincount(key, weights=error * odds[k] if k < INPUTS else error, minlength=size)
            columns[k] += (step * moved).astype(np.float32)

    def fit(self, counts: np.ndarray, rounds: int = 12, hold: float = 20.0) -> None:
        """Gate weights by Newton steps over how often each cell held a 0 and a 1, then the refinement."""
        n = counts.reshape(GATES, ODDS_BINS**INPUTS, 2)
        ones, seen = np.zeros(GATES * BINS), np.zeros(GATES * BINS)
        middle = 1 / (1 + np.exp(-((np.arange(BINS) + 0.5) * 16 / BINS - 8)))
        for gate in range(GATES):
            some = np.flatnonzero(n[gate].any(1))
            if not len(some):
                continue
            x = np.stack([*(k / 2 - 8 for k in np.unravel_index(some, (ODDS_BINS,) * INPUTS)), np.ones(len(some))], 1)
            one, all_ = n[gate, some, 1], n[gate, some].sum(1)
            start = self.weights[gate].copy()

            def loss(w: np.ndarray, x=x, one=one, all_=all_, start=start) -> float:
                z = x @ w
                return float(all_ @ np.logaddexp(0, z) - one @ z + hold / 2 * np.sum((w - start) ** 2))

            w, now = start, loss(start)
            for _ in range(rounds):
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                slope = x.T @ (all_ * p - one) + hold * (w - start)
                step = np.linalg.solve((x * (all_ * p * (1 - p))[:, None]).T @ x + hold * np.eye(INPUTS + 1), slope)
                # Half the step until it does not climb.
                while (then := loss(w - step)) > now and np.abs(step).max() > 1e-9:
                    step /= 2
                w, now = (w - step, then) if then <= now else (w, now)
                if np.abs(step).max() < 1e-6:
                    break
            self.weights[gate] = w
            bin_ = np.clip((np.clip(x @ w, -11, 11) + 8) * (BINS / 16), 0, BINS - 1).astype(np.int64)
            ones[gate * BINS : (gate + 1) * BINS] = np.bincount(bin_, weights=one, minlength=BINS)
            seen[gate * BINS : (gate + 1) * BINS] = np.bincount(bin_, weights=all_, minlength=BINS)
        refine = (ones.reshape(GATES, BINS) + 20 * middle) / (seen.reshape(GATES, BINS) + 20)
        self.refine = np.clip(refine, 1e-4, 1 - 1e-4).astype(np.float32)
