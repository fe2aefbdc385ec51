"""Toxicity: misspelled lexicon terms by Levenshtein automata on a trie, weighed by context.

The lexicon is learned: words that labelled toxic texts hold and labelled clean
ones do not.  Its trie and the Levenshtein automaton of each allowed distance
are walked together, and the product is made deterministic as it is needed, so a
word costs one look-up a character and most words die after a few.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.scale import work_dir

from .common import tidy

WORD = re.compile(r"\w+")
QUOTES = "\"'`“”„«»‘’"
# Words that report what somebody else says, or speak about a word.
REPORTING = frozenset(
    "said says say wrote writes called calls quote quoted quotes word words term phrase slur insult insults meaning dit sagte dijo".split()
)
# Words at each side that make a term's context.
CONTEXT = 4
# Labelled rows that the lexicon and the weights are fitted on, at most; the text of no other row is read for it.
FIT_ROWS = 20_000
LEXICON = 400
N_FEATURES = 4
# What a match counts with: by distance, and again if quoted.
DISTANCE, QUOTED = (1.0, 0.7, 0.5), 0.5


class Lexicon:
    """Terms with the edits each allows, as a lazily determinised product automaton."""

    def __init__(self, terms: list[str], allowed: list[int] | None = None):
        self.terms = terms
        nodes: list[dict[str, int]] = [{}]
        final: dict[int, int] = {}
        for k, term in enumerate(terms):
            at = 0
            for c in term:
                if c not in nodes[at]:
                    nodes[at][c] = len(nodes)
                    nodes.append({})
                at = nodes[at][c]
            final[at] = k
        self.nodes, self.final = nodes, final
        self.allowed = [edits(t) for t in terms] if allowed is None else allowed
        self.most = max(self.allowed, default=0)
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.results: list[tuple[int, int] | None] = []
        self.begin = self._intern({0: 0})

    def _close(self, state: dict[int, int]) -> dict[int, int]:
        """Skipping trie characters costs an edit each."""
        work = list(state)
        while work:
            at = work.pop()
            cost = state[at] + 1
            if cost <= self.most:
                for child in self.nodes[at].values():
                    if cost < state.get(child, self.most + 1):
                        state[child] = cost
                        work.append(child)
        return state

    def _intern(self, state: dict[int, int]) -> int:
        key = frozenset(self._close(state).items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            ends = [(cost, self.final[at]) for at, cost in key if at in self.final and cost <= self.allowed[self.final[at]]]
            best = min(ends, default=None)
            self.results.append((best[1], best[0]) if best else None)
        return self.ids[key]

    def _move(self, at: int, c: str) -> int:
        """-1 is the dead state."""
        out: dict[int, int] = {}

        def reach(node: int, cost: int) -> None:
            if cost <= self.most and cost < out.get(node, self.most + 1):
                out[node] = cost

        for node, cost in self.states[at]:
            reach(node, cost + 1)  # an extra character
            for label, child in self.nodes[node].items():
                reach(child, cost + (label != c))
        to = self._intern(out) if out else -1
        if len(self.steps[at]) < 4096:
            self.steps[at][c] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, distance) of the nearest term within its allowed distance."""
        at = self.begin
        for c in word:
            to = self.steps[at].get(c)
            at = self._move(at, c) if to is None else to
            if at < 0:
                return None
        return self.results[at]


def edits(term: str) -> int:
    """Misspellings a term may have: none in short words, where another word is near."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Finder:
    """Lexicon matches of a text, each as (term, distance, quoted)."""

    def __init__(self, terms: list[str], allowed: list[int] | None = None):
        self.lexicon = Lexicon(terms, allowed)
        self.memo: dict[str, tuple[int, int] | None] = {}

    def hits(self, text: str) -> tuple[list[tuple[int, int, bool]], int]:
        words = WORD.findall(text.lower())
        memo, out = self.memo, []
        if len(memo) > 300_000:
            memo.clear()
        places = []
        for i, w in enumerate(words):
            if w in memo:
                m = memo[w]
            else:
                m = memo[w] = self.lexicon.match(w)
            if m is not None:
                places.append((i, m))
        if places:
            spans = [x.span() for x in WORD.finditer(text.lower())]
            low = text.lower()
            out = [(m[0], m[1], quoted(low, words, spans, i)) for i, m in places]
        return out, len(words)


def quoted(text: str, words: list[str], spans: list[tuple[int, int]], i: int) -> bool:
    """Whether quotation marks stand round word ``i`` within its window, or a reporting word just before."""
    first, last = max(0, i - CONTEXT), min(len(words) - 1, i + CONTEXT)
    before = text[spans[first][0] : spans[i][0]]
    after = text[spans[i][1] : spans[last][1] + 1]
    if any(q in before for q in QUOTES) and any(q in after for q in QUOTES):
        return True
    return any(w in REPORTING for w in words[max(0, i - 2) : i])


def features(hits: list[tuple[int, int, bool]], weight: np.ndarray) -> list[float]:
    """Strength of the strongest match, how many there are, and the strength again where all are misspelled or all quoted.

    Matches count less if misspelled or quoted.  The last two let the weights
    say how much less, if the labelled texts show it.
    """
    if not hits:
        return [0.0] * N_FEATURES
    worth = [DISTANCE[d] * (QUOTED if q else 1.0) for _, d, q in hits]
    top = max(float(weight[t]) * w for (t, _, _), w in zip(hits, worth, strict=True))
    return [top, math.log1p(sum(worth)), top * all(d for _, d, _ in hits), top * all(q for _, _, q in hits)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights with the constant last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = np.full(len(w), ridge)
        penalty[-1] = 1e-6
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """Texts and ``toxic`` of at most ``rows`` labelled documents, none of them held out.

    Which ones is decided by a hash of the id.  An id labelled twice counts as
    toxic if any label says so.  The bound makes the broadcast safe.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("_toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "_toxic")


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[list[str], list[int], np.ndarray, np.ndarray]:
    """Terms, the edits each allows, their weights and the logistic weights; no labels: no terms and a score of 0.

    A term is a word of three letters or more that four, and one in a hundred, toxic texts
    hold and that is at least twenty times likelier in toxic texts than in clean
    ones; the ``LEXICON`` strongest stay.  A term whose misspellings turn up in
    clean texts about as often as in toxic ones allows none.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "toxicity")
    labelled_texts(docs, labels, rows).write.parquet(f"{base}/labelled")
    texts = spark.read.parquet(f"{base}/labelled")
    sizes = {r[0]: r[1] for r in texts.groupBy("_toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return [], [], np.zeros(0), np.array([0.0] * N_FEATURES + [-30.0])
    word = F.explode(F.array_distinct(F.split(F.lower("text"), r"(?U)\W+"))).alias("word")
    counts = texts.select(word, "_toxic").groupBy("word").agg(F.sum("_toxic").alias("t"), F.sum(1 - F.col("_toxic")).alias("c"))
    odds = F.log((F.col("t") + 0.05) / toxic / ((F.col("c") + 0.05) / max(clean, 1)))
    strong = counts.where((F.length("word") >= 3) & (F.col("t") >= F.greatest(F.lit(4), F.lit(0.01 * toxic)))).withColumn("odds", odds)
    top = strong.where(F.col("odds") >= math.log(20)).orderBy(F.col("odds").desc(), "word").limit(LEXICON).collect()
    terms, weight = [r["word"] for r in top], np.array([min(r["odds"], 6.0) for r in top])

    def misspelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(terms)
        for batch in batches:
            found = [(t, y) for text, y in zip(batch.column("text"), batch.column("_toxic").to_pylist(), strict=True) for t in {t for t, d, _ in finder.hits(text.as_py())[0] if d}]
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.int32()), pa.array([y for _, y in found], pa.int32())], names=["term", "y"])

    seen = texts.mapInArrow(tidy(misspelled), "term int, y int").groupBy("term").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).collect()
    mixed = {r["term"] for r in seen if (r["t"] + 0.5) / toxic < 3 * (r["c"] + 0.5) / max(clean, 1) and r["c"] >= 2}
    allowed = [0 if k in mixed else edits(t) for k, t in enumerate(terms)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(terms, allowed)
        for batch in batches:
            x = [features(finder.hits(t.as_py())[0], weight) for t in batch.column("text")]
            y = batch.column("_toxic").cast(pa.float64())
            yield pa.RecordBatch.from_arrays([y, pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    # At most ``rows`` short rows of numbers.
    found = texts.mapInArrow(tidy(measure), "y double, x array<double>").collect()
    found.sort()
    return terms, allowed, weight, fit_logistic(np.array([r["x"] for r in found]).reshape(-1, N_FEATURES), np.array([r["y"] for r in found]))


def score_texts(
    docs: DataFrame, terms: list[str], allowed: list[int], weight: np.ndarray, logistic: np.ndarray,
    keep: tuple[str, ...] = ("doc_id",), least: float = 0.3, carry_text: bool = False,
) -> DataFrame:
    """``keep`` columns, score, predicted, and the matches as (term, distance, quoted) texts.

    ``text`` stays only with ``carry_text``.  Null and empty texts have no matches and get the score of a text without any.
    """
    picked = docs.select(*dict.fromkeys((*keep, "text")))
    schema = T.StructType(
        [f for f in picked.schema.fields if carry_text or f.name != "text"]
        + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("matches", T.ArrayType(T.StringType()))]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(terms, allowed)
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 1024):
                batch = whole.slice(at, 1024)
                x, matches = [], []
                for value in batch.column("text"):
                    hits, _ = finder.hits(value.as_py() or "")
                    x.append(features(hits, weight))
                    matches.append(sorted({f"{terms[t]}~{d}{' quoted' * q}" for t, d, q in hits}))
                z = np.array(x).reshape(-1, N_FEATURES) @ logistic[:-1] + logistic[-1]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                columns = [batch.column(c) for c in batch.schema.names if carry_text or c != "text"]
                columns += [pa.array(p), pa.array((p >= least).astype(np.int32)), pa.array(matches, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return picked.mapInArrow(tidy(score), schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), least: float = 0.3, rows: int = FIT_ROWS, carry_text: bool = False) -> DataFrame:
    """Learn from ``labels`` and score all of ``docs``, one row for each row."""
    return score_texts(docs, *learn(docs, labels, rows), keep=keep, least=least, carry_text=carry_text)
