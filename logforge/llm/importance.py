"""Target-distribution importance resampling over hashed word n-grams.

A document weighs as much as its n-grams are likelier in the target texts than
in the corpus; adding noise of the Gumbel distribution to the weights and taking
the highest sums draws documents without replacement in proportion to them.

Each chunk of texts interns its n-grams in an open-addressed numpy table: XXH64
of the bytes is the key, slots are probed one after the other, and an n-gram
shares a slot only if its bytes are equal too.  A slot stores the n-gram's bucket
and count, so an n-gram is hashed to its bucket once a chunk however often it
occurs; for weights, the occurrences' slots gather the gains.

The draw needs no task that sees all rows: scores are sorted by range, and a
row's rank is its place in its range plus the sizes of the ranges before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.scale import work_dir

from .common import land, tidy
from .words import LOWER, chunks, tokenize

BUCKETS = 10_000
LONGEST = 2  # words of an n-gram
SMOOTH = 1
SCALE = 1000
MIN_WORDS = 20
PERCENT = 25
SEED = "7"
CHUNK_BYTES = 1 << 19

# All but digits, letters and what is not ASCII; after lower-casing no capitals are left.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[:0x30] = SEPARATOR[0x3A:0x61] = SEPARATOR[0x7B:0x80] = True
_SEPARATES = SEPARATOR.copy()
_SEPARATES[65:91] = False

_U = np.uint64
# The primes of XXH64, fixed values.
_P1, _P2, _P3, _P4, _P5 = (_U(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_SHORT = 32  # bytes from which XXH64 works in stripes


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << _U(bits)) | (x >> _U(64 - bits))


def lanes(data: np.ndarray, kind: str) -> np.ndarray:
    """The little-endian number that begins at each byte; ``data`` must end in as many spare bytes."""
    width = np.dtype(kind).itemsize
    return np.ndarray((len(data) - width + 1,), kind, data, strides=(1,))


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of spans of ``data``, which ends in eight spare bytes."""
    eight, four = lanes(data, "<u8"), lanes(data, "<u4")
    h = length.astype(_U) + _P5
    at = start.copy()
    for k in range(_SHORT // 8 - 1):
        on = np.flatnonzero((length >= 8 * (k + 1)) & (length < _SHORT))
        if not len(on):
            break
        h[on] = _turn(h[on] ^ (_turn(eight[at[on]] * _P2, 31) * _P1), 27) * _P1 + _P4
        at[on] += 8
    on = np.flatnonzero((length & 4 > 0) & (length < _SHORT))
    h[on] = _turn(h[on] ^ (four[at[on]].astype(_U) * _P1), 23) * _P2 + _P3
    at[on] += 4
    for k in range(3):
        on = np.flatnonzero(((length & 3) > k) & (length < _SHORT))
        h[on] = _turn(h[on] ^ (data[at[on]].astype(_U) * _P5), 11) * _P1
        at[on] += 1
    h ^= h >> _U(33)
    h *= _P2
    h ^= h >> _U(29)
    h *= _P3
    h ^= h >> _U(32)
    view = memoryview(data)
    for i in np.flatnonzero(length >= _SHORT).tolist():
        h[i] = xxhash.xxh64_intdigest(view[start[i] : start[i] + length[i]])
    return h


def same_bytes(data: np.ndarray, one: np.ndarray, two: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether spans of equal length hold equal bytes."""
    eight = lanes(data, "<u8")
    out = np.ones(len(one), bool)
    for k in range(_SHORT // 8):
        on = np.flatnonzero((length > 8 * k) & (length < _SHORT) & (one != two))
        if not len(on):
            break
        spare = (8 * (8 - np.minimum(length[on] - 8 * k, 8))).astype(_U)
        out[on] &= ((eight[one[on] + 8 * k] ^ eight[two[on] + 8 * k]) << spare) == 0
    view = memoryview(data)
    for i in np.flatnonzero((length >= _SHORT) & (one != two)).tolist():
        out[i] = view[one[i] : one[i] + length[i]] == view[two[i] : two[i] + length[i]]
    return out


class Grams:
    """Open-addressed table of the n-grams of one chunk: ``slot`` of each occurrence, ``bucket`` and ``count`` of each slot."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, hashed=xxh64):
        size = 16
        while size < 2 * len(start):
            size *= 2
        key = hashed(data, start, length)
        mask = size - 1
        slot = (key & _U(mask)).astype(np.int64)
        held = np.full(size, -1, np.int64)  # the occurrence whose n-gram a slot holds
        open_ = np.arange(len(start))
        while len(open_):
            claim = open_[held[slot[open_]] < 0]
            held[slot[claim]] = claim  # of several, one is left; all look at it below
            other = held[slot[open_]]
            same = (key[other] == key[open_]) & (length[other] == length[open_])
            maybe = np.flatnonzero(same)
            same[maybe] = same_bytes(data, start[open_[maybe]], start[other[maybe]], length[open_[maybe]])
            open_ = open_[~same]
            slot[open_] = (slot[open_] + 1) & mask
        self.slot = slot
        self.count = np.bincount(slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        self.used = np.flatnonzero(held >= 0)
        view = memoryview(data)
        first = held[self.used]
        begin, stop = start[first].tolist(), (start[first] + length[first]).tolist()
        self.bucket[self.used] = [crc32(view[a:b]) % BUCKETS for a, b in zip(begin, stop, strict=True)]


def grams(data: np.ndarray, offsets: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words joined by single spaces, row, start and length of each n-gram there, and each row's words."""
    words = tokenize(data, offsets, _SEPARATES)
    size = words.end - words.start
    to = np.cumsum(size + 1) - (size + 1)
    total = int(size.sum() + len(size))
    joined = np.full(total + 8, 32, np.uint8)
    source = np.repeat(words.start - to, size + 1) + np.arange(total)
    joined[:total] = LOWER[data[np.minimum(source, max(0, len(data) - 1))]] if total else 0
    joined[to + size] = 32
    row, start, length = [], [], []
    for n in range(1, longest + 1):
        m = max(0, len(size) - n + 1)
        whole = np.flatnonzero(words.row[:m] == words.row[n - 1 : n - 1 + m])
        last = whole + n - 1
        row.append(words.row[whole])
        start.append(to[whole])
        length.append(to[last] + size[last] - to[whole])
    return joined, np.concatenate(row), np.concatenate(start), np.concatenate(length), np.diff(words.first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, data, offsets in chunks(batch.column("text"), CHUNK_BYTES):
            joined, _, start, length, _ = grams(data, offsets)
            table = Grams(joined, start, length)
            total += np.bincount(table.bucket[table.used], weights=table.count[table.used], minlength=BUCKETS).astype(np.int64)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many n-grams of ``texts`` fall in each bucket; ``BUCKETS`` sums come to the driver, whatever the input."""
    rows = texts.select("text").mapInArrow(tidy(_count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much likelier a bucket is in the target, add-one smoothed, floored."""
    s, t = int(corpus.sum()), int(target.sum())
    return np.array([math.floor(SCALE * math.log(float((b + SMOOTH) * (s + SMOOTH * BUCKETS)) / float((a + SMOOTH) * (t + SMOOTH * BUCKETS)))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _weigh(gains: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in chunks(batch.column("text"), CHUNK_BYTES):
                joined, row, start, length, words = grams(data, offsets)
                table = Grams(joined, start, length)
                gain = gains[table.bucket]
                n = np.bincount(row, minlength=end - at)
                total = np.bincount(row, weights=gain[table.slot], minlength=end - at).astype(np.int64)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, end - at), pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return weigh


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs``.

    ``rank`` counts the drawn rows from 1 in their order: ``percent`` of the rows
    with ``min_words`` words, the highest scores, ties to the smaller id; it is
    null for the others.  A null text has no words, a row without features
    weight 0.  A row without an id draws noise for an empty id and comes after
    equal scores; rows that share an id share their noise, and equal rows take
    successive ranks.  Without target texts, or without words in them, all
    buckets are as likely there.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "importance")
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    kind = dict(docs.dtypes)["doc_id"]
    weighed = docs.select("doc_id", "text").mapInArrow(tidy(_weigh(gains)), f"doc_id {kind}, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    weighed = land(weighed.withColumn("score", F.col("weight") + noise), f"{base}/weighed")

    able = weighed.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("_tie")]
    # Rows that are equal in all else are told apart by where they stand, so no range has to hold them all.
    ranged = able.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = land(ranged.withColumn("_at", F.monotonically_increasing_id()).drop("_tie"), f"{base}/ranged")
    part, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before, offsets = 0, []
    for r in sorted(ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):  # one row for a range
        offsets.append((r.part, before))
        before += r.n
    offsets = F.broadcast(spark.createDataFrame(offsets, "_part long, _before long"))
    ranked = ranged.withColumn("_part", part).join(offsets, "_part").withColumn("rank", F.col("_before") + place + 1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    rest = weighed.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns).union(rest.select(*columns))
