"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Benchmark items give their word n-grams, and a document that holds one is
compared with its item round that place.  A common n-gram costs little: a window
is aligned only if it holds as many of the item's words as the score asks for,
which no alignment can do without.  Words are compared by 64-bit hashes; windows
of one batch are aligned together, row by row of the item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.scale import work_dir

from .common import tidy
from .words import buffers, chunks, shingles, starts, tokenize

GRAM = 3
# Score of an equal word, a different word, a skipped word.
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
# Seeds handled at once: what a task holds of the benchmark.  A larger benchmark goes over the corpus in blocks.
BLOCK_WORDS = 1_000_000
# Seeds found in whole rows that are handled at once.
HITS = 1 << 19


class Items:
    """One block of benchmark items, as word hashes with their n-grams."""

    def __init__(self, ids: list[int], texts: list[str], gram: int):
        self.ids = ids
        data, offsets = buffers(pa.array([t or "" for t in texts], pa.string()))
        words = tokenize(data, offsets)
        self.words = [words.hash[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        row, at, h = shingles(words, gram)
        order = np.lexsort((at, row, h))
        self.gram_hash, self.gram_item = h[order], row[order]
        self.gram_at = at[order] - words.first[self.gram_item]
        self.vocabulary = np.unique(words.hash)
        self.numbered = [self.numbers(w) for w in self.words]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Places of words in the benchmark's vocabulary; others have the number after the last."""
        place = np.searchsorted(self.vocabulary, h)
        place[place == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[place] == h, place, len(self.vocabulary)) if len(self.vocabulary) else place


def smith_waterman(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of ``item`` in each row of word hashes, and the column after its end.

    A gap along a row is a running maximum of the row's own scores, so a row of
    the item takes a few array operations for all windows.
    """
    n, width = windows.shape
    above = np.zeros((n, width + 1), np.float32)
    best, stop = np.zeros(n, np.float32), np.zeros(n, np.int64)
    ramp = (GAP * np.arange(width + 1)).astype(np.float32)
    for word in item:
        now = np.maximum(above + np.float32(GAP), 0)
        diagonal = above[:, :-1] + np.where(windows == word, np.float32(MATCH), np.float32(MISMATCH))
        np.maximum(now[:, 1:], diagonal, out=now[:, 1:])
        now = np.maximum.accumulate(now - ramp, axis=1) + ramp
        top = now.argmax(1)
        value = now[np.arange(n), top]
        better = value > best
        best[better], stop[better] = value[better], top[better]
        above = now
    return best, stop


def _grams(batch: pa.RecordBatch, gram: int) -> Iterator[tuple]:
    for at, end, data, offsets in chunks(batch.column("text")):
        words = tokenize(data, offsets)
        yield at, end, words, *shingles(words, gram)


def _candidates(items: Items, row: np.ndarray, at: np.ndarray, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows (item, row, first word, word after the last) round the seeds, one for each cluster of them; whole rows at once."""
    low, high = np.searchsorted(items.gram_hash, h, "left"), np.searchsorted(items.gram_hash, h, "right")
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return
    n = (high - low)[hit]
    lead = starts(row[hit])
    before = (np.cumsum(n) - n)[lead]
    cuts = np.append(lead[starts(before // HITS)], len(hit))
    size = np.array([len(w) for w in items.words], np.int64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        some, times = hit[a:b], n[a:b]
        entry = np.repeat(low[some], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        r, item = np.repeat(row[some], times), items.gram_item[entry]
        begin = np.repeat(at[some], times) - items.gram_at[entry]  # where the item would begin
        order = np.lexsort((begin, r, item))
        r, item, begin = r[order], item[order], begin[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > size[item[1:]] // 2)
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(r)) - 1
        r, item = r[head], item[head]
        slack = size[item] // 4 + 4
        yield item, r, np.maximum(first[r], begin[head] - slack), np.minimum(first[r + 1], begin[last] + size[item] + slack)


def _align(items: Items, gram: int, least: float, schema: T.StructType):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(len(items.vocabulary) + 1, bool)
        for batch in batches:
            ids = batch.column("doc_id")
            found: list[tuple] = []
            for at, _, words, row, place, h in _grams(batch, gram):
                known = items.numbers(words.hash)
                for item, r, a, b in _candidates(items, row, place, h, words.first):
                    order = np.lexsort((b - a, item))
                    item, r, a, b = item[order], r[order], a[order], b[order]
                    lead = starts(item)
                    for low, high in zip(lead, np.append(lead[1:], len(item)), strict=True):
                        k = int(item[low])
                        text = items.numbered[k]
                        own[text] = True
                        for part in range(low, high, 256):
                            s = slice(part, min(part + 256, high))
                            which = a[s, None] + np.arange(int((b[s] - a[s]).max()))
                            inside = which < b[s, None]
                            grid = np.where(inside, known[np.where(inside, which, 0)], len(items.vocabulary))
                            # A point of the score is an equal word: with fewer words of the item than that, no alignment is enough.
                            able = np.flatnonzero(own[grid].sum(1) >= least * len(text))
                            if not len(able):
                                continue
                            score, stop = smith_waterman(text, grid[able])
                            for i in np.flatnonzero(score >= least * len(text)):
                                w = part + int(able[i])
                                end = int(a[w]) + int(stop[i]) - int(words.first[r[w]])
                                found.append((ids[at + int(r[w])].as_py(), items.ids[k], float(score[i]) / len(text), end))
                        own[text] = False
            columns = list(zip(*found, strict=True)) if found else [()] * 4
            kinds = (ids.type, pa.int64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.name for f in schema])

    return align


def find_leaks(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM, least: float = 0.5) -> DataFrame:
    """(doc_id, item_id, score, end_word): documents that hold an item or an edited copy of it.

    The score is the local alignment's, per word of the item: 1 for a whole
    copy; pairs from ``least`` up are returned, each once, with its best place.
    Items of fewer than ``gram`` words and null or empty ones have no seed and
    are found nowhere, nor are documents without words.  Equal items are both
    reported.  Every n-gram of an item is a seed, however often the corpus has it.

    A block of ``BLOCK_WORDS`` benchmark words goes to every task; more blocks
    go over the documents one after another.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "leaks")
    texts = docs.select("doc_id", "text")
    sized = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    blocks = max(1, _blocks(sized))
    sized = sized.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    schema = T.StructType(
        [texts.schema["doc_id"], T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("end_word", T.LongType())]
    )
    parts = []
    for n in range(blocks):
        rows = sized.where(F.col("_block") == n).orderBy("item_id", "text").collect()  # at most a block
        items = Items([r["item_id"] for r in rows], [r["text"] for r in rows], gram)
        if not len(items.gram_hash):
            continue
        pairs = texts.mapInArrow(tidy(_align(items, gram, least, schema)), schema)
        # Written: a later block, or another use, does not align again.
        pairs.write.parquet(f"{base}/{n}")
        parts.append(spark.read.schema(schema).parquet(f"{base}/{n}"))
    out = spark.createDataFrame([], schema)
    for p in parts:
        out = out.union(p)
    best = F.max(F.struct("score", "end_word")).alias("_")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "_.score", "_.end_word")


def _blocks(benchmark: DataFrame) -> int:
    words = benchmark.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    return -(-words // BLOCK_WORDS)
