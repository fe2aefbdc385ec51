"""Quality rules: decision lists learned by sequential covering.

Only DataFrame operations touch rows.  The learner sees a count table over a
grid of binned statistics, whose size the grid bounds whatever the input; the
rules come back as one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.scale import work_dir

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
# Statistics the rules may test.
FEATURES = ("word_length", "symbol_share", "duplicate_share", "repeat_share", "line_words", "short_share")
BINS = 8


def once(df: DataFrame, *columns: Column) -> DataFrame:
    """Select computed columns behind a one-element explode, so no later step computes them again."""
    return df.select(F.explode(F.array(F.struct(*columns))).alias("_")).select("_.*")


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each whole text; a null text has none of anything.

    ``n_repeat_words`` counts words that lie in a window of five words found
    twice or more in the same text.  Windows are compared by 64-bit hashes, and
    only texts with an equal pair are looked at more closely.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = once(docs, F.col("doc_id"), words.alias("w"), lines.alias("lines"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    df = once(
        df, F.col("doc_id"), F.col("n_symbols"),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size(F.filter("w", lambda x: F.octet_length(x) <= 2)).cast("long").alias("n_short"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    windows = F.when(
        F.size("h") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("h") - WINDOW), lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    df = once(df, *[F.col(c) for c in df.columns if c != "h"], windows.alias("win"))
    pairs = F.when(
        F.size("win") > F.size(F.array_distinct("win")), F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    )
    df = once(df, *[F.col(c) for c in df.columns if c != "win"], pairs.alias("pairs"))
    equal = lambda x, j: F.coalesce(F.get("pairs", j)["x"] == x["x"], F.lit(False))
    twice = F.sort_array(F.transform(F.filter("pairs", lambda x, j: equal(x, j - 1) | equal(x, j + 1)), lambda x: x["i"]))
    df = once(df, *[F.col(c) for c in df.columns if c != "pairs"], twice.alias("at"))
    covered = F.aggregate(
        F.transform("at", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get("at", j + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x,
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("at")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return df.select(
        "*", share("word_chars", "n_words").alias("word_length"), share("n_symbols", "n_words").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("duplicate_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_words", "n_lines").alias("line_words"), share("n_short", "n_words").alias("short_share"),
    )


def base_failed() -> Column:
    """Too short, or too much of it said more than once."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    """``feature`` at most ``bound``, or above it."""

    feature: int
    bin: int
    above: bool

    def holds(self, bins: tuple[int, ...]) -> bool:
        return (bins[self.feature] > self.bin) == self.above


Cell = tuple[tuple[int, ...], int, int, int, int]  # bins; bad and good to grow on, bad and good to prune on


def _totals(cells: list[Cell]) -> tuple[int, int, int, int]:
    return tuple(sum(c[k] for c in cells) for k in (1, 2, 3, 4))


def _grow(cells: list[Cell], bins: list[int], most: int) -> list[Test]:
    rule: list[Test] = []
    while len(rule) < most:
        bad, good, _, _ = _totals(cells)
        if not bad or not good:
            break
        here, best, found = math.log2(bad / (bad + good)), 0.0, None
        for f, n in enumerate(bins):
            table = [[0, 0] for _ in range(n)]
            for c in cells:
                table[c[0][f]][0] += c[1]
                table[c[0][f]][1] += c[2]
            low = [0, 0]
            for b in range(n - 1):
                low = [low[0] + table[b][0], low[1] + table[b][1]]
                for above, (p, q) in ((False, low), (True, (bad - low[0], good - low[1]))):
                    if p and (gain := p * (math.log2(p / (p + q)) - here)) > best + 1e-9:
                        best, found = gain, Test(f, b, above)
        if found is None:
            break
        rule.append(found)
        cells = [c for c in cells if found.holds(c[0])]
    return rule


def _prune(rule: list[Test], cells: list[Cell]) -> list[Test]:
    def value(tests: list[Test]) -> float:
        _, _, bad, good = _totals([c for c in cells if all(t.holds(c[0]) for t in tests)])
        return (bad - good) / (bad + good) if bad + good else -1.0

    options = [rule[: k + 1] for k in range(len(rule))]
    return max(options, key=lambda r: (value(r), -len(r)), default=[])


def cover(cells: list[Cell], bins: list[int], max_rules: int = 12, max_tests: int = 4, least: float = 0.9, support: int = 3) -> list[list[Test]]:
    """Sequential covering: grow a rule by information gain, prune it on rows it did not see, remove what it covers.

    A rule stands if at least ``least`` of all rows it covers, and of those to
    prune on, are bad, and it covers ``support`` bad ones.
    """
    rules: list[list[Test]] = []
    while len(rules) < max_rules:
        rule = _prune(_grow(cells, bins, max_tests), cells)
        hit = [c for c in cells if all(t.holds(c[0]) for t in rule)]
        a, b, c, d = _totals(hit)
        if not rule or a + c < support or a + c < least * (a + b + c + d) or c < least * (c + d):
            break
        rules.append(rule)
        cells = [x for x in cells if x not in hit]
    return rules


def learn_rules(stats: DataFrame, labels: DataFrame, **options: float) -> list[list[tuple[str, float, bool]]]:
    """Rules (statistic, bound, above) for bad texts from rows labelled ``quality`` 0 or 1.

    All labelled rows count.  Labels of an id given twice are taken together:
    bad if any says so; null labels and ids do not count.  No labels: no rules.
    """
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_q"))
    rows = stats.join(marked, "doc_id").where(~base_failed())
    steps = [i / BINS for i in range(1, BINS)] + [0.98]
    found = rows.agg(*[F.percentile_approx(f, steps, 10_000).alias(f) for f in FEATURES]).first()
    edges = [sorted(set(found[f] or [])) for f in FEATURES]
    binned = [sum((F.when(F.col(f) > F.lit(e), 1).otherwise(0) for e in es), F.lit(0)).alias(f"_{f}") for f, es in zip(FEATURES, edges, strict=True)]
    prune = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    count = lambda bad, part: F.count(F.when((F.col("_q") == bad) & part, 1))
    grid = rows.select(*binned, "_q", "doc_id").groupBy(*[f"_{f}" for f in FEATURES])
    cells = [
        (tuple(r[: len(FEATURES)]), *r[len(FEATURES) :])
        for r in grid.agg(count(0, ~prune), count(1, ~prune), count(0, prune), count(1, prune)).collect()
    ]
    rules = cover(sorted(cells), [len(e) + 1 for e in edges], **options)
    return [[(FEATURES[t.feature], float(edges[t.feature][t.bin]), t.above) for t in rule] for rule in rules]


def verdict(rules: list[list[tuple[str, float, bool]]]) -> Column:
    """The decision list: number of the first rule that holds, null if none does."""
    out = None
    for n, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for feature, bound, above in rule:
            holds = holds & (F.col(feature) > bound if above else F.col(feature) <= bound)
        out = F.when(holds, n) if out is None else out.when(holds, n)
    return F.lit(None).cast("int") if out is None else out.cast("int")


def apply_rules(docs: DataFrame, labels: DataFrame, **options: float) -> DataFrame:
    """Statistics, base_failed, ``rule`` (the first that rejects, or null) and kept of every document.

    Null and empty texts fail the base.  Repeated rows are judged one by one.
    Empty tables give no rows, and no labels give no rules.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "quality")
    text_stats(docs).write.parquet(f"{base}/stats")
    stats = spark.read.parquet(f"{base}/stats")
    rules = learn_rules(stats, labels, **options)
    judged = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
