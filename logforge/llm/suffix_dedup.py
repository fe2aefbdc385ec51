"""Suffix-array dedup: bytes covered by long strings that start anywhere else too.

Only a string's neighbours in suffix order can share its first ``LENGTH`` bytes,
so a position is a repeat if its suffix has that much in common with another.
Sorting every suffix of a corpus would move each byte hundreds of times; here:

- Anchors are positions whose 16 bytes hash lowest in some window, so equal
  strings of ``LENGTH`` bytes have equal anchors.  Only anchors whose following
  bytes occur twice in the corpus go on; nothing else can be a repeat.
- A shard, a block of texts, sorts the suffixes at its anchors by doubling:
  ranks of 8 bytes make ranks of 16, 32 and so on.
- Shards meet by what follows the anchor, and their sorted suffixes are merged
  by binary search.  Neighbours' common prefixes follow.
- A suffix a byte further left shares a byte more if that byte is equal.  So the
  suffixes before an anchor are settled with those at it, through the common
  prefixes of the anchors' suffixes and of what stands before them, reversed.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.scale import work_dir

from .common import checked, land, tidy
from .words import chunks, mix, prefix_hash, span_hash

LENGTH = 400
GRAM = 16
SPAN = 192
# Bytes from an anchor on that every repeat round it holds.
SURE = LENGTH - SPAN
BEFORE = SPAN - 1
PAD = 0xFF  # no byte of UTF-8
BLOCK_BYTES = 8 << 20

_U = np.uint64


def anchor_of(data: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """For each position the anchor of the string that starts there, where one fits; ties go to the right."""
    n = len(data) - GRAM + 1
    if n < SPAN:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    h = span_hash(prefix, at, at + GRAM)
    low = (h & ~_U(0xFFFFFFFF)) | (_U(0xFFFFFFFF) - at.astype(_U))
    step = 1
    while 2 * step <= SPAN:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < SPAN:
        rest = SPAN - step
        low = np.minimum(low[:-rest], low[rest:])
    return 0xFFFFFFFF - (low & _U(0xFFFFFFFF)).astype(np.int64)


def text_anchors(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, and its anchors: place, what follows it as a hash, least and largest distance of the strings it settles."""
    prefix = prefix_hash(data)
    anchor = anchor_of(data, prefix)
    for r in range(len(offsets) - 1):
        begin, stop = int(offsets[r]), int(offsets[r + 1]) - LENGTH + 1
        if stop <= begin:
            continue
        own = anchor[begin:stop]
        lead = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        place = own[lead]
        last = np.append(lead[1:], len(own)) - 1
        yield r, place - begin, span_hash(prefix, place, place + SURE), place - begin - last, place - begin - lead


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id")
        for at, _, data, offsets in chunks(batch.column("text")):
            rows, places, follows = [], [], []
            for r, place, follow, _, _ in text_anchors(data, offsets):
                rows.append(at + r)
                places.append(place)
                follows.append(follow)
            cut = np.concatenate([[0], np.cumsum([len(x) for x in places])]).astype(np.int32)
            one = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(rows, pa.int64())),
                    pa.ListArray.from_arrays(cut, pa.array(one(places, np.int32))),
                    pa.ListArray.from_arrays(cut, pa.array(one(follows, _U).view(np.int64))),
                ],
                names=["id", "places", "follows"],
            )


def ranks(strings: np.ndarray) -> np.ndarray:
    """Rank of each row of bytes, equal for equal rows, by doubling of the bytes compared."""
    width = 8
    while width < strings.shape[1]:
        width *= 2
    padded = np.full((len(strings), width), PAD, np.uint8)
    padded[:, : strings.shape[1]] = strings
    now = padded.view(">u8").astype(_U)
    while True:
        flat = now[:, 0::2].ravel() if now.shape[1] > 1 else now.ravel()
        next_ = now[:, 1::2].ravel() if now.shape[1] > 1 else np.zeros_like(flat)
        order = np.lexsort((next_, flat))
        a, b = flat[order], next_[order]
        new = np.ones(len(a), _U)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        out = np.empty(len(a), _U)
        out[order] = np.cumsum(new, dtype=_U)
        now = out.reshape(len(strings), -1)
        if now.shape[1] == 1:
            return now[:, 0].astype(np.int64)


def common_prefix(strings: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common with the row before; 0 for the first."""
    out = np.zeros(len(strings), np.int64)
    for a in range(1, len(strings), 4096):
        b = min(a + 4096, len(strings))
        differ = strings[a:b] != strings[a - 1 : b - 1]
        out[a:b] = np.where(differ.any(1), differ.argmax(1), strings.shape[1])
    return out


def merge(words: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Two sorted runs of rows as one: each row of the second finds its place in the first by binary search."""
    low, high = np.zeros(len(two), np.int64), np.full(len(two), len(one))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        a, b = words[one[middle]], words[two[open_]]
        differ = a != b
        at = differ.argmax(1)
        rows = np.arange(len(open_))
        less = a[rows, at] < b[rows, at]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
    return np.insert(one, low, two)


PACKED = "bucket int, follows binary, near binary, far binary, before binary, after binary, several binary, member binary, ids binary, places binary"
_NAMES = [x.split()[0] for x in PACKED.split(", ")]
_KINDS = [pa.int32()] + [pa.binary()] * 9


def _shards(buckets: int):
    """Sorted suffixes of a block's repeated anchors; equal surroundings are sent once, with all their places."""

    def flush(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not found:
            return
        follow, near, far, place = (np.concatenate([f[k] for f in found]) for k in (0, 1, 2, 3))
        sides = np.concatenate([f[4] for f in found])
        ids = np.concatenate([np.repeat(np.frombuffer(f[5], np.uint8)[None], len(f[0]), 0) for f in found])
        copies = np.concatenate([np.full(len(f[0]), f[6]) for f in found])
        order = np.lexsort((far, near, ranks(sides[:, BEFORE:]), ranks(sides[:, :BEFORE])))
        s = sides[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]).any(1) | (near[order][1:] != near[order][:-1]) | (far[order][1:] != far[order][:-1])
        kind = np.empty(len(s), np.int64)
        kind[order] = np.cumsum(new) - 1
        lead = order[new]
        several = np.zeros(len(lead), bool)
        np.logical_or.at(several, kind, copies)
        several |= np.bincount(kind) > 1
        bucket = (mix(follow[lead]) % _U(buckets)).astype(np.int64)
        for k in np.unique(bucket):
            mine = np.flatnonzero(bucket == k)
            mine = mine[np.argsort(ranks(sides[lead[mine], BEFORE:]), kind="stable")]
            own = lead[mine]
            number = np.full(len(lead), -1)
            number[mine] = np.arange(len(mine))
            member = np.flatnonzero(number[kind] >= 0)
            columns = (
                follow[own], near[own].astype(np.uint16), far[own].astype(np.uint16), sides[own, :BEFORE], sides[own, BEFORE:],
                several[mine].astype(np.uint8), number[kind[member]].astype(np.int32), ids[member], place[member].astype(np.int32),
            )
            yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int32()), *[pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns]], names=_NAMES)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        held = 0
        for batch in batches:
            ids, marks, copies = batch.column("id"), batch.column("places"), batch.column("several")
            for at, _, data, offsets in chunks(batch.column("text")):
                wide = np.concatenate([np.full(BEFORE, PAD, np.uint8), data, np.full(LENGTH, PAD, np.uint8)])
                for r, place, follow, near, far in text_anchors(data, offsets):
                    chosen = np.isin(place, marks[at + r].values.to_numpy())
                    if not chosen.any():
                        continue
                    place, follow, near, far = place[chosen], follow[chosen], near[chosen], far[chosen]
                    step = np.arange(BEFORE + LENGTH)
                    grid = place[:, None] + step[None]  # from BEFORE bytes left of the anchor, shifted by the padding
                    sides = wide[grid + int(offsets[r])]
                    size = int(offsets[r + 1] - offsets[r])
                    sides[(grid < BEFORE) | (grid >= BEFORE + size)] = PAD
                    found.append((follow, near, far, place, sides, ids[at + r].as_py(), copies[at + r].as_py()))
                    held += sides.size
                    if held > BLOCK_BYTES:
                        yield from flush(found)
                        found, held = [], 0
        yield from flush(found)

    return shards


def repeated_distances(before: np.ndarray, after: np.ndarray, order: np.ndarray, near: np.ndarray, far: np.ndarray, several: np.ndarray) -> np.ndarray:
    """For each anchor and distance, whether the string that far left of the anchor occurs again.

    Strings at a distance are equal if what stands before the anchors agrees
    that far and what follows agrees for the rest; both are runs of neighbours in
    their sorted order whose common prefixes are long enough.
    """
    n = len(order)
    after_prefix = common_prefix(after[order])
    back = before[:, ::-1]
    left = np.argsort(ranks(back), kind="stable")
    before_prefix = common_prefix(back[left])
    reach, room = (after != PAD).sum(1), (before != PAD).sum(1)
    weight = 1 + several.astype(np.int64)
    out = np.zeros((n, SPAN), bool)
    group_left, group_after = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(SPAN):
        some = np.flatnonzero((near <= d) & (far >= d) & (room >= d) & (reach >= LENGTH - d))
        if not len(some):
            continue
        group_left[left] = np.cumsum(before_prefix < d)
        group_after[order] = np.cumsum(after_prefix < LENGTH - d)
        _, kind = np.unique(group_left[some] * (n + 1) + group_after[some], return_inverse=True)
        out[some, d] = np.bincount(kind, weights=weight[some])[kind] > 1
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    by: dict[int, list[tuple]] = defaultdict(list)
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for bucket, *rest in zip(*columns, strict=True):
            by[bucket].append(rest)
    while by:
        _, rows = by.popitem()
        read = lambda k, kind: [np.frombuffer(r[k], kind) for r in rows]
        near, far, several = (np.concatenate(read(k, t)) for k, t in ((1, np.uint16), (2, np.uint16), (5, np.uint8)))
        before = np.concatenate(read(3, np.uint8)).reshape(-1, BEFORE)
        after = np.concatenate(read(4, np.uint8)).reshape(-1, LENGTH)
        words = np.ascontiguousarray(after).view(">u8").reshape(-1, LENGTH // 8).astype(_U)
        sizes = [len(r[5]) for r in rows]
        starts = np.cumsum([0, *sizes[:-1]])
        runs = [np.arange(a, a + n) for a, n in zip(starts, sizes, strict=True)]
        while len(runs) > 1:
            runs.sort(key=len)
            runs = [merge(words, b, a) for a, b in zip(runs[0::2], runs[1::2], strict=False)] + ([runs[-1]] if len(runs) % 2 else [])
        del words
        found = repeated_distances(before, after, runs[0], near.astype(np.int64), far.astype(np.int64), several)
        member = np.concatenate([m + a for m, a in zip(read(6, np.int32), starts, strict=True)])
        ids = np.concatenate(read(7, np.uint8)).reshape(-1, 16)
        place = np.concatenate(read(8, np.int32)).astype(np.int64)
        hit = found[member].any(1)
        member, ids, place = member[hit], ids[hit], place[hit]
        # Runs of distances are runs of starting positions.
        bits = np.zeros((len(member), SPAN + 2), np.int8)
        bits[:, 1:-1] = found[member]
        turn = np.diff(bits, axis=1)
        row, first = np.nonzero(turn == 1)
        _, last = np.nonzero(turn == -1)
        for a in range(0, len(row), 50_000):
            s = slice(a, a + 50_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x.tobytes() for x in ids[row[s]]], pa.binary()),
                    pa.array((place[row[s]] - last[s] + 1).astype(np.int32)),
                    pa.array((place[row[s]] - first[s] + LENGTH).astype(np.int32)),
                ],
                names=["id", "start", "end"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the spans that cover repeats."""
    for whole in batches:
        for at in range(0, max(1, whole.num_rows), 256):
            batch = whole.slice(at, 256)
            removed, spans, digest, edges = [], [], [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges"), strict=True):
                data = text.as_py().encode()
                joined: list[list[int]] = []
                for r in sorted((x["start"], x["end"]) for x in ranges.as_py()):
                    if joined and r[0] <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], r[1])
                    else:
                        joined.append(list(r))
                kept, end = [], 0
                for a, b in joined:
                    kept.append(data[end:a])
                    end = b
                kept.append(data[end:])
                rest = b"".join(kept)
                removed.append(len(data) - len(rest))
                spans.append(len(joined))
                digest.append(hashlib.sha256(rest).hexdigest())
                edges.append([{"start": a, "end": b} for a, b in joined])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()), pa.array(edges, kind)],
                names=["id", "n_removed", "n_spans", "kept_sha256", "spans"],
            )


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start, end) of every row.

    A byte goes if a string of ``LENGTH`` bytes covers it that also starts
    elsewhere, in the same text or another; spans are the maximal runs of such
    bytes.  Null texts count as empty.  Repeated rows repeat each other.  Texts
    are told apart by half of their SHA-256.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "suffixes")
    text = F.coalesce("text", F.lit(""))
    full = docs.select("doc_id", text.alias("text"), F.sha2(text.cast("binary"), 256).alias("sha"))
    full = full.withColumn("id", F.unhex(F.substring("sha", 1, 32)))
    rows = land(full.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "sha", "id"), f"{base}/rows")
    copies = rows.groupBy("id").agg((F.count("*") > 1).alias("several"))

    long = full.where(F.octet_length("text") >= LENGTH).select("id", "text")
    anchors = land(long.mapInArrow(tidy(_anchors), "id binary, places array<int>, follows array<long>"), f"{base}/anchors")
    twice = anchors.select(F.explode("follows").alias("follow")).groupBy("follow").agg(F.count("*").alias("n")).where("n > 1").select("follow")
    twice = land(twice, f"{base}/twice")
    each = anchors.select("id", F.explode(F.arrays_zip("places", "follows")).alias("_")).select("id", F.col("_.places").alias("place"), F.col("_.follows").alias("follow"))
    # Bounded by the anchors of one text.
    marked = each.join(checked(twice), "follow", "left_semi").groupBy("id").agg(F.collect_set("place").alias("places"))
    marked = land(marked.join(copies, "id"), f"{base}/marked")
    texts = long.join(checked(marked.select("id")), "id", "left_semi").dropDuplicates(["id"])
    texts = land(texts.join(marked, "id"), f"{base}/texts")

    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = texts.mapInArrow(tidy(_shards(buckets)), PACKED).repartition("bucket")
    spans = land(packed.mapInArrow(tidy(_merge), "id binary, start int, end int"), f"{base}/spans")
    spans = spans.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    cut = texts.select("id", "text").join(spans, "id")
    cut = land(cut.mapInArrow(tidy(_cut), "id binary, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>"), f"{base}/cut")
    out = rows.join(cut, "id", "left")
    return out.select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )
