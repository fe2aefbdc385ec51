"""Line dedup: near-equal lines by a deletion-neighbourhood join; the earliest stays.

Two lines are near if one edit of a word (change, insertion, deletion) makes one
of them the other.  Each line emits a hashed key for every variant, lines with
an equal key are near, and the earliest line of each key is kept.  A variant is
known by its parts before and after the edit, whose running hashes make all
variants of a line in one pass over its words.

Most lines have no near line.  One edit leaves one half of a line untouched, so
only lines that share a half with another line emit variants; none is lost.
Only DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logforge.scale import work_dir

from .common import checked, land

# Shorter lines are never dropped; lines below NEAR_WORDS only if equal, for one word of few is no small edit.
MIN_WORDS = 3
NEAR_WORDS = 8


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, r"[\x20\x09-\x0D]+"), "")


def _doc_key() -> list[Column]:
    return [F.col("doc_id"), F.xxhash64("text").alias("text_hash")]


def _line(w: Column, i: Column, min_words: int, near_words: int) -> Column:
    """Number, word count, two hashes and the halves' keys of a line."""
    m = F.size(w)
    low, high = F.floor(m / 2).cast("int"), F.floor((m + 1) / 2).cast("int")
    half = lambda k: (F.xxhash64(F.lit(1), F.slice(w, 1, k)), F.xxhash64(F.lit(2), F.slice(w, m - k + 1, k)))
    halves = F.when(m >= near_words, F.array_distinct(F.array(*half(low), *half(high)))).otherwise(F.array().cast("array<bigint>"))
    return F.struct(
        i.cast("int").alias("line_no"), m.alias("m"), F.xxhash64(w).alias("h1"), F.xxhash64(F.lit(7), w).alias("h2"), halves.alias("halves")
    )


def _order() -> Column:
    """When a line occurs first: by document id, rows without one last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "line_no")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """doc_id, text_hash, n_lines and ``removed``: (line_no, doc_id, line, near) of each line to drop.

    A line goes if an equal line, or one within one word edit, occurs earlier;
    (doc_id, line) is the earliest such place.  Lines are compared as word
    sequences, so white space does not count.  Documents are ordered by id, null
    ids last, and lines by number; that an earlier line goes itself changes
    nothing.  Rows equal in id and text count as one document and give one row;
    null texts have no lines.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "lines")
    lines = F.transform(F.split("text", "\n"), _words)
    words = docs.select(F.explode(F.array(F.struct(*_doc_key(), lines.alias("lines")))).alias("_")).select("_.*")
    near = F.transform("lines", lambda w, i: _line(w, i, min_words, near_words))
    scanned = land(
        words.select("doc_id", "text_hash", F.greatest(F.size("lines"), F.lit(0)).alias("n_lines"), F.filter(near, lambda x: x["m"] >= min_words).alias("lines")),
        f"{base}/scanned",
    )
    each = scanned.select("doc_id", "text_hash", F.explode("lines").alias("_")).select("doc_id", "text_hash", "_.*")

    # Exact repetitions: the first place of each line that occurs more than once.
    first = each.groupBy("h1", "h2").agg(F.min(_order()).alias("first"), F.max(_order()).alias("last"))

    # Lines that share a half with a different line.
    halves = each.select(F.explode("halves").alias("half"), "h1").groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
    shared = land(halves.where("a <> b").select("half"), f"{base}/halves")
    some = each.select("h1", F.explode("halves").alias("half")).join(checked(shared), "half", "left_semi")
    candidates = land(some.select("h1").distinct(), f"{base}/candidates")

    # Their words again, once per line, with running hashes from both ends.
    again = words.select("doc_id", "text_hash", F.posexplode_outer("lines").alias("line_no", "w")).where(F.size("w") >= near_words)
    again = again.withColumn("h1", F.xxhash64("w")).withColumn("h2", F.xxhash64(F.lit(7), F.col("w")))
    again = again.join(checked(candidates), "h1", "left_semi")
    again = again.groupBy("h1", "h2").agg(F.min(_order()).alias("first"), F.first("w").alias("w"))
    again = again.select("h1", "h2", "first", F.size("w").alias("m"), F.posexplode("w").alias("j", "word"))
    line = Window.partitionBy("h1", "h2").orderBy("j")
    front, back = F.xxhash64("word", "j"), F.xxhash64("word", F.col("m") - F.col("j"))
    again = again.withColumn("front", front).withColumn("back", back)
    again = again.select(
        "h1", "h2", "first", "m", "j",
        F.bit_xor("front").over(line).alias("through"), F.col("front").alias("own"),
        F.bit_xor("back").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("whole"),
        F.bit_xor("back").over(line).alias("back_through"), F.col("back").alias("back_own"),
    )
    before, after = F.col("through").bitwiseXOR(F.col("own")), F.col("whole").bitwiseXOR(F.col("back_through"))
    from_here = after.bitwiseXOR(F.col("back_own"))
    # Word j deleted; the whole line, cut at j; the whole line, cut behind its last word.
    deleted = F.struct(F.xxhash64(before, F.col("j"), after, F.col("m") - 1), F.xxhash64(after, F.col("j"), before))
    cut = F.struct(F.xxhash64(before, F.col("j"), from_here, F.col("m")), F.xxhash64(from_here, F.col("j"), before))
    end = F.struct(F.xxhash64(F.col("through"), F.col("m"), F.lit(0).cast("bigint"), F.col("m")), F.xxhash64(F.lit(0).cast("bigint"), F.col("m"), F.col("through")))
    named = lambda s: F.struct(s.getField("col1").alias("a"), s.getField("col2").alias("b"))
    keys = F.explode(F.when(F.col("j") + 1 == F.col("m"), F.array(named(deleted), named(cut), named(end))).otherwise(F.array(named(deleted), named(cut))))
    keyed = again.select(keys.alias("k"), "h1", "h2", "first").select("k.a", "k.b", "h1", "h2", "first")
    keyed = land(keyed, f"{base}/keyed")
    best = keyed.groupBy("a", "b").agg(F.min("first").alias("partner"), F.max("first").alias("latest")).where("partner <> latest").select("a", "b", "partner")
    best = land(best, f"{base}/best")
    # A key may be common to very many lines; the adaptive join splits such a partition.
    near_first = keyed.join(checked(best), ["a", "b"]).where("partner < first").groupBy("h1", "h2").agg(F.min("partner").alias("partner"))

    known = first.join(land(near_first, f"{base}/near"), ["h1", "h2"], "left").where("first <> last or partner is not null")
    known = land(known.select("h1", "h2", "first", F.least("first", "partner").alias("earliest")), f"{base}/known")
    marked = each.select("doc_id", "text_hash", "line_no", "h1", "h2", _order().alias("here")).join(checked(known), ["h1", "h2"])
    marked = marked.where("earliest < here").select(
        "doc_id", "text_hash",
        F.struct("line_no", F.col("earliest.doc_id").alias("doc_id"), F.col("earliest.line_no").alias("line"), (F.col("earliest") < F.col("first")).alias("near")).alias("r"),
    )
    # Bounded by the lines of one document.
    removed = marked.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("r")).alias("removed"))
    every = scanned.groupBy("doc_id", "text_hash").agg(F.max("n_lines").alias("n_lines"))
    removed = removed.withColumnsRenamed({"doc_id": "_d", "text_hash": "_t"})
    out = every.join(removed, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t")), "left").drop("_d", "_t")
    none = F.array().cast(removed.schema["removed"].dataType)
    return out.withColumn("removed", F.coalesce("removed", none))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; all rows and columns stay."""
    base = work_dir(docs.sparkSession, "line-texts")
    removed = repeated_lines(docs, min_words, near_words).where(F.size("removed") > 0)
    # Names that no column of the input has.
    key, of, gone = (next(f"{n}{k}" for k in range(len(docs.columns) + 1) if f"{n}{k}" not in docs.columns) for n in ("_doc", "_hash", "_gone"))
    removed = land(removed.select(F.col("doc_id").alias(key), F.col("text_hash").alias(of), F.col("removed.line_no").alias(gone)), f"{base}/removed")
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(of))
    joined = docs.join(removed, same, "left")
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(gone, i))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)
