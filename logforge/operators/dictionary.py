"""Technique dictionaries of any size: substring tests as an equi-join of pieces cut around rare grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.scale import fits, work_dir

GRAM = 4
# Grams of the dictionary that may go to every executor.
BROADCAST_GRAMS = 500_000


def text_grams(text: Column | str, size: int) -> Column:
    """ARRAY of the distinct pieces of ``size`` characters."""
    text = F.col(text) if isinstance(text, str) else text
    last = F.length(text) - size + 1
    pieces = F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(size)))
    return F.when(last >= 1, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits(df, BROADCAST_GRAMS) else df


def match_dictionary(
    texts: DataFrame, dictionary: DataFrame, ids: list[str], text: str = "cmd", size: int = GRAM
) -> DataFrame:
    """Rows (ids, technique), each once: the text holds a pattern of the technique as a substring.

    ``dictionary`` has ``pattern`` and ``technique``; ``ids`` name a text.  Each
    pattern is anchored at the gram of it that fewest texts hold.  Where a text
    holds an anchor, it is cut as the patterns of that anchor lie around it (by
    offset and length, each combination once), and the pieces meet the patterns
    in an equi join: what is joined grows with the texts, not with texts times
    patterns.  Patterns shorter than a gram are their own gram; an empty
    pattern is in every text.  NULL texts and patterns match nothing.
    """
    spark = texts.sparkSession
    base = work_dir(spark, "dictionary")
    # Texts are often built by costly patterns, and are read three times.
    texts.filter(F.col(text).isNotNull()).select(*ids, text).write.parquet(f"{base}/texts")
    known = spark.read.parquet(f"{base}/texts")
    patterns = dictionary.filter(F.col("pattern").isNotNull()).select("pattern", "technique").distinct()
    # The techniques of the empty pattern: one array, as large as the dictionary has such techniques.
    every = [r.technique for r in patterns.filter("pattern = ''").select("technique").distinct().collect()]
    named = known.dropna(subset=ids)

    own = patterns.filter("pattern != ''").select("pattern").distinct()
    short = own.filter(F.length("pattern") < size).select("pattern", F.col("pattern").alias("gram"))
    grams = own.filter(F.length("pattern") >= size).select("pattern", F.explode(text_grams("pattern", size)).alias("gram"))
    held = named.select(F.explode(text_grams(text, size)).alias("gram"))
    counts = held.join(_small(grams.select("gram").distinct()), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # A gram that no text holds rules its pattern out.
    rare = grams.join(_small(counts), "gram", "left").groupBy("pattern").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("_g"))
    anchored = short.unionByName(rare.filter(F.col("_g.n") > 0).select("pattern", F.col("_g.gram").alias("gram")))
    shape = F.struct((F.instr(F.col("pattern"), F.col("gram")) - 1).alias("before"), F.length("pattern").alias("length"))
    shapes = anchored.select("gram", shape.alias("shape")).distinct().groupBy("gram").agg(F.collect_list("shape").alias("shapes"))
    shapes.write.parquet(f"{base}/shapes")
    shapes = spark.read.parquet(f"{base}/shapes")

    last = F.length(text)
    widths = sorted(r[0] for r in shapes.select(F.length("gram")).distinct().collect())  # at most ``size`` numbers
    starts = lambda w: F.transform(F.sequence(F.lit(1), last - w + 1), lambda i: F.struct(i.alias("at"), F.substring(text, i, F.lit(w)).alias("gram")))
    none = F.array().cast("array<struct<at: int, gram: string>>")
    places = F.flatten(F.array(*[F.when(last >= w, starts(w)).otherwise(none) for w in widths])) if widths else none
    met = named.select(*ids, text, F.explode(places).alias("_p")).join(_small(shapes), F.col("_p.gram") == F.col("gram"))
    cuts = met.select(*ids, text, F.explode("shapes").alias("_s"), (F.col("_p.at") - F.col("_s.before")).alias("_from"))
    cuts = cuts.filter((F.col("_from") >= 1) & (F.col("_from") + F.col("_s.length") - 1 <= last))
    pieces = cuts.select(*ids, F.substring(F.col(text), F.col("_from"), F.col("_s.length")).alias("pattern"))
    hits = pieces.join(patterns, "pattern").select(*ids, "technique")
    if every:
        always = known.select(*ids, F.explode(F.array(*map(F.lit, every))).alias("technique"))
        hits = hits.unionByName(always)
    return hits.distinct()
