"""Near duplicates by circulant MinHash, banded, with links confirmed on the full sets.

Two permutations of 64-bit numbers make a whole signature: the first scatters a
set's shingles, the second is turned by one place for each coordinate, and a
coordinate is the least value of the set under it.  Three coordinates make a
band; sets that agree in a band are compared.  At a similarity of 0.8 a pair
agrees in none of the 28 bands with a chance of 2e-9.

No bucket is expanded into its pairs.  Its members are compared with one of them
first.  A pair that could still link two groups lies in a bucket of both, and its
common shingles occur in several groups: members with too few such shingles are
put aside, again and again.  What is left is compared with a few others of other
groups, then paired where sizes and such shingles let two sets be similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.scale import work_dir

from .common import BROADCAST_ROWS, checked, components, land, tidy
from .jaccard_join import sets
from .words import mix

SIZE = 4
PERCENT = 80
BANDS, WIDTH = 28, 3
# Times that members without enough shingles of several groups are put aside.
PEELS = 2
# Parts of a set by a hash, for bounds of what two sets have in common.
SEGMENTS = 16

_U = np.uint64
_SCATTER = _U(0x8F1BBCDCBFA53E0B)
_FIRST, _SECOND = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
# Members of a bucket that those of other groups are compared with before pairs are: the least number after flipping these bits.
FLIPS = (-1, 0x2AAAAAAAAAAAAAAA, 0x1249249249249249, 0x0F0F0F0F0F0F0F0F)


def signature(row: np.ndarray, h: np.ndarray, count: int) -> np.ndarray:
    """Coordinates (count, sets) of the sets that rows of hashes ``h``, in order of ``row``, make up."""
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    out = np.empty((count, len(first)), _U)
    if not len(first):
        return out
    place = mix(h ^ _SCATTER)
    value, spare = np.empty_like(place), np.empty_like(place)
    for k in range(count):
        # The second permutation, of places turned by k: multiplications by odd numbers and shifted copies can be undone.
        np.add(place, _U(k), out=value)
        np.multiply(value, _FIRST, out=value)
        np.right_shift(value, _U(29), out=spare)
        np.bitwise_xor(value, spare, out=value)
        np.multiply(value, _SECOND, out=value)
        np.right_shift(value, _U(32), out=spare)
        np.bitwise_xor(value, spare, out=value)
        out[k] = np.minimum.reduceat(value, first)
    return out


def band_keys(coordinates: np.ndarray, bands: int, width: int) -> np.ndarray:
    """One key (sets, bands) for the coordinates of each band."""
    keys = np.empty((coordinates.shape[1], bands), _U)
    for b in range(bands):
        key = np.full(coordinates.shape[1], mix(np.array([b + 1], _U))[0])
        for w in range(width):
            key = mix(key ^ coordinates[b * width + w]) * _FIRST
        keys[:, b] = key
    return keys


SKETCH = "doc_id long, n long, a long, b long"


def _sketch(size: int, bands: int, width: int, whole: bool):
    """Size of each set, two sums of hashes by which equal sets are known, and band keys; with ``whole`` the set instead of the keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, row, h in sets(batch.column("text"), size):
                n = np.bincount(row, minlength=end - at)
                cut = np.concatenate([[0], np.cumsum(n)])
                sums = []
                for x in (h, mix(h ^ _U(0x5851F42D4C957F2D))):
                    running = np.concatenate([np.zeros(1, _U), np.cumsum(x, dtype=_U)])
                    sums.append(pa.array((running[cut[1:]] - running[cut[:-1]]).view(np.int64)))
                if whole:
                    last = pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(h.view(np.int64)))
                else:
                    keys = band_keys(signature(row, h, bands * width), bands, width)
                    each = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))])
                    last = pa.ListArray.from_arrays(each.astype(np.int32), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, end - at), pa.array(n.astype(np.int64)), *sums, last], names=["doc_id", "n", "a", "b", "hashes" if whole else "keys"])

    return sketch


def _nodes(rows: DataFrame, several: DataFrame, again: DataFrame) -> DataFrame:
    """Add ``first``, the smallest id with that set, and ``node``, the set's number.

    The number is the id, or for ids of several sets one number for each set, above all ids.
    """
    rows = rows.join(checked(several), ["n", "a", "b"], "left").join(checked(again), "doc_id", "left")
    rows = rows.withColumn("first", F.coalesce("first", "doc_id"))
    own = F.xxhash64("doc_id", "n", "a", "b").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return rows.withColumn("node", F.when(F.col("many"), own).otherwise(F.col("doc_id"))).drop("many")


def _similar(common: Column, n: str, m: str, percent: int) -> Column:
    return 100 * common >= percent * (F.col(n) + F.col(m) - common)


def _confirmed(pairs: DataFrame, held: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b) those whose full sets are similar."""
    for end, size in (("a", "_n"), ("b", "_m")):
        pairs = pairs.join(checked(sizes), F.col(end) == F.col("node")).drop("node").withColumnRenamed("n", size)
    pairs = pairs.where(_similar(F.least("_n", "_m"), "_n", "_m", percent))
    left = held.select(F.col("node").alias("a"), F.col("hashes").alias("_h"))
    right = held.select(F.col("node").alias("b"), F.col("hashes").alias("_g"))
    common = F.size(F.array_intersect("_h", "_g")).cast("long")
    return pairs.join(left, "a").join(right, "b").where(_similar(common, "_n", "_m", percent)).select("a", "b")


def _open(placed: DataFrame, links: DataFrame, base: str) -> DataFrame:
    """Bucket rows with their group, of the buckets that hold several groups."""
    groups = land(components(links, base), f"{base}/groups").withColumnsRenamed({"id": "node", "component_id": "group"})
    placed = placed.drop("group").join(checked(groups), "node", "left").withColumn("group", F.coalesce("group", "node"))
    placed = land(placed, f"{base}/placed")
    mixed = placed.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("key")
    mixed = land(mixed, f"{base}/mixed")
    return land(placed.join(checked(mixed), "key", "left_semi"), f"{base}/open")


_PARTS = [f"p{s}" for s in range(SEGMENTS)]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles, in all and by a hash in each of ``SEGMENTS`` segments."""
    for batch in batches:
        column = batch.column("h")
        n = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.repeat(np.arange(len(n)), n) * SEGMENTS + (mix(column.flatten().to_numpy().view(_U)) % _U(SEGMENTS)).astype(np.int64)
        parts = np.bincount(at, minlength=len(n) * SEGMENTS).reshape(-1, SEGMENTS)
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(n), *(pa.array(x) for x in parts.T)], names=["node", "c", *_PARTS])


def _peeled(open_: DataFrame, held: DataFrame, percent: int, base: str) -> DataFrame:
    """The rows of ``open_`` whose document may still link two groups, with ``c`` and its parts, how much it can share with other groups.

    What a set shares with a similar one of another group are shingles that occur
    in several groups; without enough of them a document is put aside, and so may
    others be whose shingles it had.
    """
    for k in range(PEELS):
        nodes = land(open_.select("node", "group").distinct(), f"{base}/nodes-{k}")
        each = held.join(checked(nodes), "node").select("node", "group", "n", F.explode("hashes").alias("h"))
        across = each.groupBy("h").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("h")
        across = land(across, f"{base}/across-{k}")
        able = each.join(checked(across), "h", "left_semi").groupBy("node", "n").agg(F.collect_list("h").alias("h"))  # of one document
        able = able.where(100 * F.size("h") >= percent * F.col("n")).select("node", "h").mapInArrow(tidy(_segments), "node long, c long, " + ", ".join(f"{p} long" for p in _PARTS))
        able = land(able, f"{base}/able-{k}")
        left = open_.drop("c", *_PARTS).join(checked(able, BROADCAST_ROWS // 8), "node")
        mixed = left.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("key")
        open_ = land(left.join(mixed, "key", "left_semi"), f"{base}/left-{k}")
    return open_


def _may_link(percent: int) -> Column:
    """Whether a document (n, group, c and its parts) and one of another group (m, others and its parts) can be similar.

    In no segment have they more in common than either shares with other groups there.
    """
    common = sum((F.least(p, f"other_{p}") for p in _PARTS), F.lit(0).cast("long"))
    return (F.col("group") != F.col("others")) & _similar(F.least("c", "other_c"), "n", "m", percent) & _similar(common, "n", "m", percent)


def _others(open_: DataFrame) -> DataFrame:
    """The rows of ``open_`` as the other end of a pair."""
    return open_.select("key", F.col("node").alias("other"), F.col("n").alias("m"), F.col("group").alias("others"), *[F.col(p).alias(f"other_{p}") for p in ("c", *_PARTS)])


def near_copies(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, bands: int = BANDS, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    A document's set is its distinct shingles of ``size`` words, or its whole
    text if it has fewer; null texts and texts without words have none and link
    with nothing.  Documents link at a similarity of ``percent``, equal sets
    always; ``component_id`` is the smallest id that links reach, the own one
    included, and the document of that id is ``kept``.

    Rows that share an id are one document with all their sets.  A row without an
    id links with nothing, has no component and is kept.  ``docs`` is read
    twice and should be a table.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "circulant")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = land(texts.mapInArrow(tidy(_sketch(size, bands, width, False)), SKETCH + ", keys array<long>"), f"{base}/rows")
    named = rows.where(F.col("doc_id").isNotNull())
    full = named.where(F.col("n") > 0)

    several = full.groupBy("n", "a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    several = land(several.where("first < last").drop("last"), f"{base}/several")
    mark = F.xxhash64("n", "a", "b")
    again = named.select("doc_id", mark.alias("mark")).groupBy("doc_id").agg(F.count("*").alias("rows"), F.min("mark").alias("low"), F.max("mark").alias("high"))
    again = land(again.where("rows > 1").select("doc_id", (F.col("low") < F.col("high")).alias("many")), f"{base}/again")
    nodes = land(_nodes(full, several, again), f"{base}/nodes")
    edges = nodes.where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    edges = edges.union(nodes.where("node <> doc_id").select(F.col("node").alias("a"), F.col("doc_id").alias("b")))
    edges = land(edges.distinct(), f"{base}/equal")

    # One document stands for each set; with a band key of its own, it has no near copy there.
    banded = nodes.where("doc_id = first").select("node", "doc_id", "n", F.explode("keys").alias("key"))
    heads = banded.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last").drop("last")
    heads = land(heads, f"{base}/heads")
    placed = land(banded.join(checked(heads), "key").distinct(), f"{base}/buckets")
    sizes = land(placed.select("node", "n").distinct(), f"{base}/sizes")
    wanted = land(placed.select("doc_id").distinct(), f"{base}/wanted")
    held = texts.join(checked(wanted), "doc_id", "left_semi").mapInArrow(tidy(_sketch(size, bands, width, True)), SKETCH + ", hashes array<long>")
    held = _nodes(held, several, again).where("doc_id = first").select("doc_id", "node", "n", "hashes")
    # Repeated rows of one id hold one set several times.
    held = held.join(checked(again), "doc_id", "left_anti").union(held.join(checked(again), "doc_id", "left_semi").dropDuplicates(["node"]))
    held = land(held.drop("doc_id"), f"{base}/sets")

    tried = land(placed.where("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), f"{base}/star")
    links = land(_confirmed(tried, held, sizes, percent), f"{base}/links-0")
    open_ = _peeled(_open(placed.select("key", "node", "n"), links, f"{base}/first"), held, percent, f"{base}/peel")
    chosen = open_.groupBy("key").agg(*[F.min(F.col("node").bitwiseXOR(F.lit(f))).alias(f"f{i}") for i, f in enumerate(FLIPS)])
    chosen = chosen.select("key", F.explode(F.array_distinct(F.array(*[F.col(f"f{i}").bitwiseXOR(F.lit(f)) for i, f in enumerate(FLIPS)]))).alias("other"))
    ordered = [F.least("other", "node").alias("a"), F.greatest("other", "node").alias("b")]
    pairs = open_.join(_others(open_).join(chosen, ["key", "other"]), "key").where(_may_link(percent)).select(*ordered).distinct()
    pairs = land(pairs.join(tried, ["a", "b"], "left_anti"), f"{base}/tries")
    tried = tried.union(pairs)
    links = land(links.union(_confirmed(pairs, held, sizes, percent)), f"{base}/links-1")

    open_ = _open(open_, links, f"{base}/last")
    mine = land(open_.groupBy("node").agg(F.collect_list("key").alias("keys")), f"{base}/keys")  # one a band
    open_ = land(open_.join(checked(mine, BROADCAST_ROWS // 8), "node"), f"{base}/keyed")
    # A pair comes once, in the first bucket of both.
    once = F.col("key") == F.array_min(F.array_intersect("keys", "other_keys"))
    both = open_.join(_others(open_).join(mine.select(F.col("node").alias("other"), F.col("keys").alias("other_keys")), "other"), "key")
    pairs = both.where((F.col("node") < F.col("other")) & _may_link(percent) & once).select(*ordered).distinct()
    pairs = land(pairs.join(tried, ["a", "b"], "left_anti"), f"{base}/pairs")
    edges = land(edges.union(links).union(_confirmed(pairs, held, sizes, percent)).distinct(), f"{base}/edges")

    found = land(components(edges, f"{base}/all"), f"{base}/found")
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(checked(found), F.col("doc_id") == F.col("id"), "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
