"""LM scoring: context mixing over words and bytes, learned from the training part of a corpus.

Word counts, counts under contexts, scores: three passes over the texts.
What is kept for a word travels packed, once a block of documents, so a word that
all documents hold costs no task more than another.  Tables that every task gets
have a fixed size; rare words, which no table holds, meet their counts by hash.
The mixers' weights and refinement are fitted on every training text: what the second
pass counted is read again, each step predicted from the counts without itself.
Every rare word is spelled, once where a training text holds it and once a chunk
elsewhere; its chance is its count and its spelling's share, together one distribution.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.scale import work_dir

from .common import block_id, land, tidy
from .mixing_model import CELLS, STATE_CONTEXTS, Code, Counts, Layer, Stream, Vocabulary, as_inputs, byte_stream, cells, hashed_slot, places, steps, with_ends, word_stream
from .words import LOWER, Words, chunks, mix, starts, tokenize

# Words with a leaf of their own; the rest is escaped.
LEAVES = 65_536
WORD_BITS, BYTE_BITS = 20, 18
BLOCK_ROWS, BLOCK_BYTES = 20_000, 8 << 20
PART = 1 << 14
# What a row of counts is about.
PLACES, RARE, LETTERS = 0, 1, 2
# Steps or bytes in a row of counts, and entries that are added up at once.
ROW, HELD = 1 << 16, 1 << 22
MOST = (1 << 32) - 1

_U = np.uint64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(7)) == 2, F.lit(False))


def teaches(doc_id: Column) -> Column:
    """Not held out; a row without an id teaches nothing."""
    return doc_id.isNotNull() & ~held_out(doc_id)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(h ^ _U(0x6A09E667F3BCC909)) % _U(buckets)).astype(np.int64)


def _split(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _count_words(buckets: int):
    """Distinct tokens of a block with their counts, one row for each bucket."""

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h = np.sort(np.concatenate(held))
        lead = starts(h)
        n = np.diff(np.append(lead, len(h))).astype(np.uint32)
        h = h[lead]
        order, cut = _split(_bucket(h, buckets), buckets)
        h, n = h[order], n[order]
        some = [k for k in range(buckets) if cut[k] < cut[k + 1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), *[pa.array([x[cut[k] : cut[k + 1]].tobytes() for k in some], pa.binary()) for x in (h, n)]], names=["bucket", "h", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                held.append(with_ends(tokenize(data, offsets))[0])
                size += 8 * len(held[-1])
                if size > BLOCK_BYTES:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return count


def _add_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    h, n = [], []
    for batch in batches:
        h += [np.frombuffer(x.as_buffer(), _U) for x in batch.column("h")]
        n += [np.frombuffer(x.as_buffer(), np.uint32) for x in batch.column("n")]
    if not h:
        return
    h, n = np.concatenate(h), np.concatenate(n).astype(np.int64)
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    lead = starts(h)
    n = np.add.reduceat(n, lead)
    h = h[lead].view(np.int64)
    for a in range(0, len(h), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(h[a : a + 100_000]), pa.array(n[a : a + 100_000])], names=["h", "c"])


def _streams(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, Stream]:
    words = tokenize(data, offsets)
    h, row, number = with_ends(words)
    return words, h, row, number, word_stream(vocabulary, h, row)


def _spell(data: np.ndarray, words: Words, number: np.ndarray, row: np.ndarray) -> Stream:
    """Of tokens by number; an end is an empty word."""
    if not len(words.start):
        return byte_stream(data, np.zeros(len(number), np.int64), np.zeros(len(number), np.int64), row)
    start, end = words.start[number], words.end[number]
    return byte_stream(LOWER[data], start, np.where(number < 0, start, end), row)


COUNTED = "kind int, a binary, n binary"


def _counted(rows: list[tuple], names: tuple[str, ...] = ("kind", "a", "n")) -> pa.RecordBatch:
    kinds = [pa.int32()] * (len(names) - 2) + [pa.binary()] * 2
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=list(names))


def _summed(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, ascending, the sum of each and the place of one of it."""
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every = every[order]
    lead = starts(every)
    return every[lead], np.add.reduceat(np.concatenate(n)[order], lead) if len(lead) else np.zeros(0, np.int64), order[lead]


def _cut_out(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of some spans, one after the other."""
    cut = np.cumsum(size)
    return data[np.repeat(start - (cut - size), size) + np.arange(cut[-1] if len(cut) else 0)]


def _count_places(shared, buckets: int):
    """Of a block: how often each leaf follows each state, and its rare words with their counts; packed by bucket."""

    def flush(held: list[np.ndarray], rare: list[tuple]) -> Iterator[pa.RecordBatch]:
        leaves = np.uint32(shared.value[0].escape + 1)
        key = np.sort(np.concatenate(held))
        lead = starts(key)
        n = np.diff(np.append(lead, len(key))).astype(np.uint32)
        key = key[lead]
        # All leaves of a state meet, in one bucket.
        order, cut = _split(_bucket((key // leaves).astype(_U), buckets), buckets)
        key, n = key[order], n[order]
        rows = [(k, PLACES, key[a:b].tobytes(), n[a:b].tobytes()) for k, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]
        h, n, one = _summed([r[0] for r in rare], [r[1] for r in rare])
        data, size = np.concatenate([r[2] for r in rare]), np.concatenate([r[3] for r in rare])
        start = (np.cumsum(size) - size)[one]
        size = size[one]
        order, cut = _split(_bucket(h, buckets), buckets)
        n = n.astype(np.uint32)
        for k, (a, b) in enumerate(zip(cut, cut[1:])):
            if a < b:
                mine = order[a:b]
                rows.append((k, RARE, _cut_out(data, start[mine], size[mine]).tobytes(), n[mine].tobytes()))
        yield _counted(rows, ("bucket", "kind", "a", "n"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value[0]
        held: list[np.ndarray] = []
        rare: list[tuple] = []
        size = 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                words = tokenize(data, offsets)
                h, row, number = with_ends(words)
                leaf, state, _ = places(vocabulary, h, row)
                held.append(state.astype(np.uint32) * np.uint32(vocabulary.escape + 1) + leaf.astype(np.uint32))
                out = np.flatnonzero((leaf == vocabulary.escape) & (number >= 0))
                different, first, n = np.unique(h[out], return_index=True, return_counts=True)
                start, end = (x[number[out][first]] for x in (words.start, words.end))
                # Each word with the blank that closes it.
                spelled = _cut_out(np.append(LOWER[data], np.uint8(0x20)), start, end - start + 1)
                spelled[np.cumsum(end - start + 1) - 1] = 0x20
                rare.append((different, n, spelled, end - start + 1))
                size += 4 * len(leaf) + len(spelled) + 24 * len(n)
                if size > 2 * BLOCK_BYTES:
                    yield from flush(held, rare)
                    held, rare, size = [], [], 0
        if held:
            yield from flush(held, rare)

    return count


def _add_places(shared):
    """Counts of a bucket: of the steps down the tree after each state, of rare words, and of these words' bytes."""

    def down(key: np.ndarray, n: np.ndarray, code: Code, leaves: int) -> Iterator[tuple]:
        state, leaf = np.divmod(key, np.uint32(leaves))
        lead = starts(state)
        for a, b in zip(lead, np.append(lead[1:], len(state))):
            which, flat = code.paths(leaf[a:b])
            at = node = code.node.take(flat)
            some = np.arange(code.nodes, dtype=np.uint32)
            if 4 * len(node) < code.nodes:
                some, at = np.unique(node, return_inverse=True)
            both = np.bincount(at.astype(np.int64) << 1 | code.bit.take(flat), weights=n[a:b].take(which), minlength=2 * len(some))
            both = both.reshape(-1, 2).astype(np.int64)
            met = np.flatnonzero(both[:, 0] + both[:, 1])
            yield (np.uint32(state[a]) << np.uint32(16) | some[met]), both[met]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, code = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rare: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        pending = {PLACES: 0, RARE: 0}

        def settle(kind: int) -> None:
            pending[kind] = 0
            if kind == PLACES and held:
                held[:] = [_summed([k for k, _ in held], [n for _, n in held])[:2]]
            if kind == RARE and rare:
                h, n, one = _summed([r[0] for r in rare], [r[1] for r in rare])
                data, size = np.concatenate([r[2] for r in rare]), np.concatenate([r[3] for r in rare])
                start = np.cumsum(size) - size
                rare[:] = [(h, n, _cut_out(data, start[one], size[one]), size[one])]

        for batch in batches:
            for kind, packed, n in zip(batch.column("kind").to_pylist(), batch.column("a"), batch.column("n"), strict=True):
                n = np.frombuffer(n.as_buffer(), np.uint32).astype(np.int64)
                if kind == PLACES:
                    held.append((np.frombuffer(packed.as_buffer(), np.uint32), n))
                else:
                    data = np.frombuffer(packed.as_buffer(), np.uint8)
                    w = tokenize(data, np.array([0, len(data)]))
                    rare.append((w.hash, n, data, w.end - w.start + 1))
                pending[kind] += len(n)
                if pending[kind] > HELD:
                    settle(kind)
        settle(PLACES)
        settle(RARE)
        nodes: list[np.ndarray] = []
        pairs: list[np.ndarray] = []
        size = 0
        for key, n in held:
            for node, both in down(key, n, code, vocabulary.escape + 1):
                while len(node):
                    # Counts beyond 32 bits take another row.
                    nodes.append(node)
                    pairs.append(np.minimum(both, MOST).astype(np.uint32))
                    size += len(node)
                    if size >= ROW:
                        yield _counted([(PLACES, np.concatenate(nodes).tobytes(), np.concatenate(pairs).tobytes())])
                        nodes, pairs, size = [], [], 0
                    left = (both > MOST).any(1)
                    node, both = node[left], np.maximum(both[left] - MOST, 0)
        if nodes:
            yield _counted([(PLACES, np.concatenate(nodes).tobytes(), np.concatenate(pairs).tobytes())])
        for _, n, data, size in rare:
            cut = np.cumsum(size)
            yield _counted([(LETTERS, b"", np.bincount(data, weights=np.repeat(n, size), minlength=256).astype(np.int64).tobytes())])
            a = 0
            while a < len(n):
                begin = cut[a] - size[a]
                b = max(a + 1, int(np.searchsorted(cut, begin + ROW, "right")))
                yield _counted([(RARE, data[begin : cut[b - 1]].tobytes(), n[a:b].tobytes())])
                a = b

    return add


def _steps_after(packed: pa.Scalar, n: pa.Scalar) -> tuple[list[np.ndarray], np.ndarray]:
    """Slots of some steps in the tables of the step itself and of both contexts, and how often each was 0 and 1."""
    key = np.frombuffer(packed.as_buffer(), np.uint32)
    state, node = key >> np.uint32(16), key & np.uint32(0xFFFF)
    return [node, *(hashed_slot(c.take(state), node, WORD_BITS) for c in STATE_CONTEXTS)], np.frombuffer(n.as_buffer(), np.uint32).reshape(-1, 2)


def _steps_within(packed: pa.Scalar, n: pa.Scalar, code: Code) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Slots and bits of the steps that spell some words, and how often the word stands in the texts."""
    data = np.frombuffer(packed.as_buffer(), np.uint8)
    end = np.flatnonzero(data == 0x20)
    start = np.append(0, end[:-1] + 1)
    b = byte_stream(data, start, end, np.arange(len(end)))
    n = np.frombuffer(n.as_buffer(), np.int64).take(b.row)
    for a in range(0, len(b.leaf), 1 << 14):
        which, bit, slots = steps(code, BYTE_BITS, b, slice(a, a + (1 << 14)))
        yield slots, bit, n[a : a + (1 << 14)].take(which)


def _parts(counts: list[Counts]) -> Iterator[pa.RecordBatch]:
    """What is not 0 of a task's sums; as floats, which hold up to 2^24 exactly."""
    k = 0
    for c in counts:
        c.settle()
        for a in range(0, len(c.table), PART):
            t = c.table[a : a + PART]
            if t.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([t.astype(np.float32).tobytes()], pa.binary())], names=["part", "t"])
            k += 1
        c.table = c.table[:0]


def _tables(shared):
    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value
        counts = [Counts(2 << WORD_BITS) for _ in range(2)] + [Counts(2 << BYTE_BITS) for _ in range(3)]
        for batch in batches:
            for kind, packed, n in zip(batch.column("kind").to_pylist(), batch.column("a"), batch.column("n"), strict=True):
                if kind == PLACES:
                    slots, n = _steps_after(packed, n)
                    for c, slot in zip(counts[:2], slots[1:], strict=True):
                        for b in (0, 1):
                            c.add(slot << np.uint32(1) | np.uint32(b), n[:, b])
                else:
                    for slots, bit, times in _steps_within(packed, n, code):
                        for c, slot in zip(counts[2:], slots, strict=True):
                            c.add(slot << np.uint32(1) | bit, times)
        yield from _parts(counts)

    return tables


def _fall(shared):
    """How many steps of the training texts fall into each cell of the words' layer, and of rare words into each of the bytes'."""

    def fall(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, tables = shared.value
        counts = [Counts(2 * CELLS), Counts(2 * CELLS)]
        for batch in batches:
            for kind, packed, n in zip(batch.column("kind").to_pylist(), batch.column("a"), batch.column("n"), strict=True):
                if kind == PLACES:
                    slots, n = _steps_after(packed, n)
                    for b in (0, 1):
                        some = np.flatnonzero(n[:, b])
                        # A step is predicted from all others.
                        counts[0].add(cells(tables[:3], [s[some] for s in slots], np.full(len(some), b, np.uint8), np.float32(1)), n[some, b])
                else:
                    # Spelling is for words as they are new: each word once, from all other words.
                    for slots, bit, times in _steps_within(packed, n, code):
                        counts[1].add(cells(tables[3:], slots, bit, times.astype(np.float32)), np.ones(len(bit)))
        yield from _parts(counts)

    return fall


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of whole parts."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, t in zip(batch.column("part").to_pylist(), batch.column("t"), strict=True):
            add = np.frombuffer(t.as_buffer(), np.float32).astype(np.float64)
            total[k] = total[k] + add if k in total else add
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.astype(np.float32).tobytes() for t in total.values()], pa.binary())], names=["part", "t"])


def _sums(parts: DataFrame, sizes: list[int]) -> list[np.ndarray]:
    """The tables that the tasks' parts add up to; of fixed size."""
    tables = [np.zeros(size, np.float32) for size in sizes]
    place = [(table, a) for table in tables for a in range(0, len(table), PART)]
    for k, t in parts.repartition("part").mapInArrow(tidy(_add_parts), "part int, t binary").collect():
        table, a = place[k]
        table[a : a + PART] = np.frombuffer(t, np.float32)
    return tables


PACKED = "bucket int, block long, kind int, a binary, b binary, c binary, d binary, e binary"
# A packed row's kind, beside 0 for rare words of a block, 1 for its documents and 2 for what words add to these.
KNOWN = 3
_NAMES = ["bucket", "block", "kind", "a", "b", "c", "d", "e"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 5
    columns = zip(*rows, strict=True) if rows else [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_NAMES)


def _score(shared, buckets: int, total: float):
    """Per block: scores as far as known words go, and for each bucket its rare words, how they spell and who holds them."""

    def flush(heads: list[tuple], rare: list[tuple], before: int) -> Iterator[pa.RecordBatch]:
        ids, null, n, base, score = (np.concatenate([x[k] for x in heads]) for k in range(5))
        teach = np.concatenate([x[5] for x in heads])
        h, row, spelled = (np.concatenate([x[k] for x in rare]) for k in range(3))
        block = block_id(before)
        out = [(block % buckets, block, 1, ids.tobytes(), null.tobytes(), n.astype(np.uint32).tobytes(), base.tobytes(), score.tobytes())]
        order = np.lexsort((row, h))
        h, row, spelled = h[order], row[order], spelled[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        lead = np.flatnonzero(new)
        times = np.diff(np.append(lead, len(h))).astype(np.uint32)
        h, row, spelled = h[lead], row[lead], spelled[lead]
        who = (row << 1 | teach[row]).astype(np.uint16)
        word = starts(h)
        bucket = _bucket(h[word], buckets)
        held = np.diff(np.append(word, len(h)))
        pointer = np.argsort(np.repeat(bucket, held), kind="stable")
        order, cut = _split(bucket, buckets)
        before = np.concatenate([[0], np.cumsum(held[order])])
        who, times = who[pointer], times[pointer]
        for k in range(buckets):
            if cut[k] < cut[k + 1]:
                mine = order[cut[k] : cut[k + 1]]
                p = slice(before[cut[k]], before[cut[k + 1]])
                out.append((k, block, 0, h[word[mine]].tobytes(), spelled[word[mine]].astype(np.float32).tobytes(), held[mine].astype(np.uint32).tobytes(), who[p].tobytes(), times[p].tobytes()))
        yield _batch(out)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, layer, byte_layer = shared.value
        known = np.append(np.log10((vocabulary.counts[:-1] + 1) / total), 0.0)
        heads: list[tuple] = []
        rare: list[tuple] = []
        held = size = blocks = 0
        for batch in batches:
            ids = batch.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            own = ids.fill_null(0).to_numpy().astype(np.int64)
            teach = batch.column("teach").to_numpy(zero_copy_only=False)
            for at, end, data, offsets in chunks(batch.column("text")):
                rows = end - at
                words, h, row, number, s = _streams(vocabulary, data, offsets)
                own_leaf = s.leaf != vocabulary.escape
                n = np.stack([np.bincount(row, minlength=rows), np.bincount(row[own_leaf], minlength=rows), np.diff(offsets)], 1)
                base = np.bincount(row, weights=known[s.leaf], minlength=rows)
                value = layer.log10(s, rows)
                out = np.flatnonzero(~own_leaf)
                # Each rare word of the chunk is spelled once; one that a training row of it has is spelled by ``_spell_known``.
                different, first, which = np.unique(h[out], return_index=True, return_inverse=True)
                new = np.ones(len(different), bool)
                new[which[teach[at:end][row[out]]]] = False
                b = _spell(data, words, number[out][first[new]], np.arange(new.sum()))
                spelled = np.zeros(len(different))
                spelled[new] = byte_layer.log10(b, int(new.sum()))
                heads.append((own[at:end], null[at:end], n, base, value, teach[at:end].astype(np.int64)))
                rare.append((h[out], row[out] + held, spelled[which]))
                held += rows
                size += len(data)
                if held >= BLOCK_ROWS or size >= BLOCK_BYTES:
                    yield from flush(heads, rare, blocks)
                    heads, rare, held, size, blocks = [], [], 0, 0, blocks + 1
        if heads:
            yield from flush(heads, rare, blocks)

    return score


def _spell_known(shared, buckets: int):
    """How each rare word of the training texts spells; packed by bucket."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte_layer = shared.value[2]
        for batch in batches:
            for packed in batch.column("a"):
                data = np.frombuffer(packed.as_buffer(), np.uint8)
                w = tokenize(data, np.array([0, len(data)]))
                number = np.arange(len(w.hash))
                spelled = byte_layer.log10(_spell(data, w, number, number), len(number)).astype(np.float32)
                order, cut = _split(_bucket(w.hash, buckets), buckets)
                h, spelled = w.hash[order], spelled[order]
                yield _batch([(k, 0, KNOWN, h[a:b].tobytes(), spelled[a:b].tobytes(), b"", b"", b"") for k, (a, b) in enumerate(zip(cut, cut[1:])) if a < b])

    return spell


def _meet(total: float, seen: float, kinds: float):
    """Counts of rare words from all blocks, and what they add to each document."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        through: list[tuple] = []
        known: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if r[2] == KNOWN:
                    known.append((np.frombuffer(r[3], _U), np.frombuffer(r[4], np.float32)))
                else:
                    (through if r[2] else rows).append(r)
        yield _batch(through)
        del through
        if not rows:
            return
        h = [np.frombuffer(r[3], _U) for r in rows]
        own = [np.frombuffer(r[5], np.uint32) for r in rows]
        taught = []
        for r, held in zip(rows, own, strict=True):
            who, times = np.frombuffer(r[6], np.uint16), np.frombuffer(r[7], np.uint32)
            taught.append(np.add.reduceat(times.astype(np.int64) * (who & 1), np.cumsum(held, dtype=np.int64) - held))
        size = [len(x) for x in h]
        every = np.concatenate(h)
        order = np.argsort(every, kind="stable")
        lead = starts(every[order])
        count = np.empty(len(every), np.int64)
        kept = np.diff(np.append(lead, len(every)))
        count[order] = np.repeat(np.add.reduceat(np.concatenate(taught)[order], lead), kept)
        # Of words that have a count, how they spell: a row of each.
        spelled_by = np.full(len(every), -np.inf, np.float32)
        if known:
            one, spell = (np.concatenate(x) for x in zip(*known, strict=True))
            by = np.argsort(one)
            one, spell = one[by], spell[by]
            word = every[order[lead]]
            at = np.minimum(np.searchsorted(one, word), len(one) - 1)
            spelled_by[order] = np.repeat(np.where(one[at] == word, spell[at], np.float32(-np.inf)), kept)
        sums: dict[int, list[np.ndarray]] = {}
        at = 0
        for r, held, n in zip(rows, own, size, strict=True):
            c, spell = count[at : at + n], spelled_by[at : at + n].astype(np.float64)
            at += n
            spelled = np.frombuffer(r[4], np.float32).astype(np.float64)
            base = np.log10((c + 1) / total)
            value = np.where(c > 0, np.log10(np.maximum(c, 1) + (kinds + 1) * 10**spell), np.log10(kinds + 1) + spelled) - np.log10(seen + kinds + 1)
            who = (np.frombuffer(r[6], np.uint16) >> 1).astype(np.int64)
            times = np.frombuffer(r[7], np.uint32)
            top = int(who.max()) + 1
            add = [np.bincount(who, weights=times * np.repeat(x, held), minlength=top) for x in (base, value, (c > 0).astype(float))]
            old = sums.setdefault(r[1], [np.zeros(0)] * 3)
            for k in range(3):
                long, short = (old[k], add[k]) if len(old[k]) > top else (add[k], old[k])
                long[: len(short)] += short
                old[k] = long
        for block, (base, value, known) in sums.items():
            yield _batch([(0, block, 2, base.tobytes(), value.tobytes(), known.astype(np.uint32).tobytes(), b"", b"")])

    return meet


SCORED = "doc_id long, n_tokens long, n_known long, n_bytes long, base_score double, score double"


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    heads: dict[int, tuple] = {}
    parts: dict[int, list[tuple]] = defaultdict(list)
    for batch in batches:
        for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if r[2] == 1:
                heads[r[1]] = r[3:]
            else:
                parts[r[1]].append(r[3:6])
    for block, (ids, null, n, base, score) in heads.items():
        n, known, size = (x.copy() for x in np.frombuffer(n, np.uint32).astype(np.int64).reshape(-1, 3).T)
        base, score = np.frombuffer(base).copy(), np.frombuffer(score).copy()
        # In a fixed order, so that sums of a rerun are the same to the last bit.
        for b, s, k in sorted(parts.pop(block, ())):
            b, s, k = np.frombuffer(b), np.frombuffer(s), np.frombuffer(k, np.uint32)
            base[: len(b)] += b
            score[: len(s)] += s
            known[: len(k)] += k
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(null, bool)), *(pa.array(x) for x in (n, known, size, base, score))],
            names=["doc_id", "n_tokens", "n_known", "n_bytes", "base_score", "score"],
        )


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes and bits_per_byte of every row.

    Tokens are words, A-Z lower-cased, and an end.  ``base_score`` is the log10
    probability under add-one word counts of the training rows (ids that are not
    held out), ``score`` that of the mixed model; a null or empty text is an end.
    ``bits_per_byte`` is the whole text's, its end included, over its UTF-8 bytes;
    null where there are none.
    Rows without an id teach nothing and are scored; repeated rows teach as often
    as they stand there.  With nothing to learn from, all words are spelled.
    ``docs`` is read several times and should be a table.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "lm")
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", teaches(F.col("doc_id")).alias("teach"))
    training = texts.where("teach")
    counted = training.select("text").mapInArrow(tidy(_count_words(buckets)), "bucket int, h binary, n binary")
    words = land(counted.repartition("bucket").mapInArrow(_add_words, "h long, c long"), f"{base}/words")
    size = words.agg(F.sum("c"), F.count("*")).first()
    n_train, n_kinds = size[0] or 0, size[1]
    # A count from which at most LEAVES words are left: bins of counts, a few hundred rows.
    level = F.floor(8 * F.log2("c")).cast("int")
    bins = sorted(words.groupBy(level.alias("level")).count().collect(), reverse=True)
    above, least = 0, None
    for row in bins:
        above += row["count"]
        if above > LEAVES:
            break
        least = row["level"]
    top = words.where(level >= least).orderBy(F.col("c").desc(), "h").collect() if least is not None else []
    hashes = np.array([r["h"] for r in top], np.int64).view(_U)
    counts = np.array([r["c"] for r in top], np.int64)
    vocabulary = Vocabulary(hashes, counts, n_train - int(counts.sum()))
    seen, kinds = float(vocabulary.counts[-1]), float(n_kinds - (vocabulary.counts[:-1] > 0).sum())

    code = Code(vocabulary.counts)
    tables = spark.sparkContext.broadcast((vocabulary, code))
    found = training.select("text").mapInArrow(tidy(_count_places(tables, buckets)), "bucket int, kind int, a binary, n binary")
    found = land(found.repartition("bucket").mapInArrow(tidy(_add_places(tables)), COUNTED), f"{base}/counts")
    # A row of 256 numbers for each partition at most.
    letters = [np.frombuffer(r[0], np.int64) for r in found.where(F.col("kind") == LETTERS).select("n").collect()]
    byte_code = Code(sum(letters, np.zeros(256, np.int64)))
    found = found.where(F.col("kind") != LETTERS)
    spell = spark.sparkContext.broadcast(byte_code)
    learned = _sums(found.mapInArrow(tidy(_tables(spell)), "part int, t binary"), [2 << WORD_BITS] * 2 + [2 << BYTE_BITS] * 3)
    learned = [code.node_counts(vocabulary.counts).astype(np.float32), *learned]
    layer = Layer(code, WORD_BITS, [as_inputs(t) for t in learned[:3]], rate=0.4)
    byte_layer = Layer(byte_code, BYTE_BITS, [as_inputs(t) for t in learned[3:]])
    seen_by = spark.sparkContext.broadcast((byte_code, learned))
    for one, fallen in zip((layer, byte_layer), _sums(found.mapInArrow(tidy(_fall(seen_by)), "part int, t binary"), [2 * CELLS] * 2), strict=True):
        if fallen.any():
            one.fit(fallen.astype(np.float64))

    model = spark.sparkContext.broadcast((vocabulary, layer, byte_layer))
    total = float(n_train + n_kinds + 1)
    packed = texts.mapInArrow(tidy(_score(model, buckets, total)), PACKED)
    spelled = found.where(F.col("kind") == RARE).select("a").mapInArrow(tidy(_spell_known(model, buckets)), PACKED)
    met = packed.union(spelled).repartition("bucket").mapInArrow(_meet(total, seen, kinds), PACKED)
    scored = met.repartition("block").mapInArrow(_total, SCORED)
    bits = F.col("score") / -math.log10(2)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score",
        "n_bytes", F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"),
    )
