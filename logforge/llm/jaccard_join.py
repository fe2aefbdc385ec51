"""N-gram Jaccard join with adaptive multi-match prefixes.

Texts are sets of hashed word shingles.  Two sets of similarity t share, in any
common order of shingles, at least k shingles among the first
n - ceil(t n) + k of each; so a document may lengthen its prefix by some
shingles if as many more must be shared.

First, all documents: prefixes in hash order, k about an eighth of the set.  A
document is dropped unless k shingles of its prefix occur in other prefixes.
Shingles travel packed, once a block of documents, so one that all documents
hold is no larger than any other.  Then, for what is left, rarest shingles
first: each document takes the k for which its candidates are estimated to cost
least.  Candidates are linked through the most typical document of each shingle
first; only documents that this leaves in different groups are paired.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.scale import work_dir

from .common import block_id, checked, components, land, tidy
from .words import chunks, mix, shingles, starts, tokenize

SIZE = 5
PERCENT = 75
# Documents and text bytes that are packed together.
BLOCK_ROWS, BLOCK_BYTES = 50_000, 8 << 20
# Similarities are kept in parts of this.
WHOLE = 100_000_000
# Documents of a shingle's largest group that a document outside it is compared with before groups are.
TRIES = 6
# What a candidate costs to verify, in rows of the join of prefixes.
VERIFY = 4
# Slots of the table of shingle counts that every task gets: 16 MB whatever the input.
SLOTS = 1 << 22

_U = np.uint64


def overlap(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Least overlap of a set of ``n`` with any similar one."""
    return -(-percent * n // 100)


def sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, row and hash of all distinct shingles, by row and hash."""
    for at, end, data, offsets in chunks(column):
        row, _, h = shingles(tokenize(data, offsets), size, short=True)
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
        yield at, end, row[new], h[new]


def _landed(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The same of sets that were written."""
    for at in range(0, batch.num_rows, 500):
        some = batch.slice(at, 500)
        n = some.column("n").to_numpy()
        yield at, at + len(n), np.repeat(np.arange(len(n)), n), some.column("hashes").flatten().to_numpy().view(_U)


def _ranks(row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of each row's set and place of each entry in its row."""
    n = np.bincount(row, minlength=rows)
    return n, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


PACKED = "bucket int, block long, kind int, a binary, b binary, c binary"


def _pack(buckets: int, size: int, percent: int, whole: bool):
    """Blocks of documents as one row of ids, sizes and counts, and one row of shingles for each bucket."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        count: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        hashes: list[np.ndarray] = []
        held = [0, 0, 0]  # rows, shingles, blocks before

        def flush() -> Iterator[pa.RecordBatch]:
            if not held[0]:
                return
            own, n = np.concatenate(ids), np.concatenate(count)
            h, r = np.concatenate(hashes), np.concatenate(rows)
            order = np.argsort(h, kind="stable")
            h, r = h[order], r[order]
            lead = starts(h)
            length = np.diff(np.append(lead, len(h)))
            several = np.repeat(length > 1, length)
            shared = np.bincount(r[several], minlength=len(own)).astype(np.uint32)
            # Of a shingle several documents here hold, the others need to know no more than that.
            key = h[lead]
            owner = np.where(length > 1, 0xFFFF, r[lead]).astype(np.uint16)
            bucket = (mix(key) >> _U(32)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            key, owner, bucket = key[order], owner[order], bucket[order]
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            block = block_id(held[2])
            out = [(block % buckets, block, 1, own.tobytes(), n.astype(np.uint32).tobytes(), shared.tobytes())]
            for k in range(buckets):
                s = slice(cut[k], cut[k + 1])
                if cut[k] < cut[k + 1]:
                    out.append((k, block, 0, key[s].astype(np.uint32).tobytes(), (key[s] >> _U(32)).astype(np.uint16).tobytes(), owner[s].tobytes()))
            for x in (ids, count, rows, hashes):
                x.clear()
            held[:] = 0, 0, held[2] + 1
            yield _batch(out)

        for batch in batches:
            own = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for at, end, row, h in _landed(batch) if whole else sets(batch.column("text"), size):
                n, place = _ranks(row, end - at)
                chosen = place < (n if whole else n - overlap(n, percent) + n // 8 + 1)[row]
                ids.append(own[at:end])
                count.append(n)
                rows.append(row[chosen] + held[0])
                hashes.append(h[chosen])
                held[0] += end - at
                held[1] += len(h)
                if held[0] >= BLOCK_ROWS or 6 * held[1] >= BLOCK_BYTES:
                    yield from flush()
        yield from flush()

    return pack


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "block", "kind", "a", "b", "c"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        yield from zip(*columns, strict=True)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of whole buckets: how many of each document's are in another block too."""
    keys, owners, sources, blocks, through = [], [], [], [], []
    for bucket, block, kind, a, b, c in _rows(batches):
        if kind == 1:
            through.append((bucket, block, kind, a, b, c))
            continue
        keys.append(np.frombuffer(a, np.uint32).astype(_U) | np.frombuffer(b, np.uint16).astype(_U) << _U(32))
        owners.append(np.frombuffer(c, np.uint16))
        sources.append(np.full(len(owners[-1]), len(blocks), np.int32))
        blocks.append(block)
    yield _batch(through)
    if not blocks:
        return
    key, owner, source = np.concatenate(keys), np.concatenate(owners), np.concatenate(sources)
    del keys, owners, sources
    order = np.argsort(key, kind="stable")
    key, owner, source = key[order], owner[order], source[order]
    lead = starts(key)
    length = np.diff(np.append(lead, len(key)))
    counted = np.repeat(length > 1, length) & (owner != 0xFFFF)
    pair, n = np.unique(source[counted].astype(np.int64) << 16 | owner[counted], return_counts=True)
    by = pair >> 16
    for k in np.unique(by):
        s = by == k
        yield _batch([(0, blocks[k], 2, (pair[s] & 0xFFFF).astype(np.uint32).tobytes(), n[s].astype(np.uint32).tobytes(), b"")])


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of whole blocks added up."""
    heads: dict[int, tuple] = {}
    parts: dict[int, list] = defaultdict(list)
    for _, block, kind, a, b, c in _rows(batches):
        if kind == 1:
            heads[block] = (a, b, c)
        else:
            parts[block].append((a, b))
    for block, (a, b, c) in heads.items():
        shared = np.frombuffer(c, np.uint32).astype(np.int64)
        for who, n in parts.pop(block, ()):
            shared[np.frombuffer(who, np.uint32)] += np.frombuffer(n, np.uint32)
        columns = [np.frombuffer(a, np.int64), np.frombuffer(b, np.uint32).astype(np.int64), shared]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["doc_id", "n", "shared"])


def shared_counts(docs: DataFrame, size: int, percent: int, whole: bool = False) -> DataFrame:
    """doc_id, n and, of the hash-order prefix, how many shingles other documents' prefixes hold.

    With ``whole``, of all shingles of sets that were written.
    """
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.mapInArrow(tidy(_pack(buckets, size, percent, whole)), PACKED)
    met = packed.repartition("bucket").mapInArrow(tidy(_meet), PACKED)
    return met.repartition("block").mapInArrow(tidy(_total), "doc_id long, n long, shared long")


def _sketch(size: int, whole: bool):
    """Size and two sums of hashes of each set, by which equal sets are known; with ``whole`` the set itself."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, row, h in sets(batch.column("text"), size):
                n = np.bincount(row, minlength=end - at)
                cut = np.concatenate([[0], np.cumsum(n)])
                sums = []
                for x in (h, mix(h ^ _U(0x5851F42D4C957F2D))):
                    running = np.concatenate([np.zeros(1, _U), np.cumsum(x, dtype=_U)])
                    sums.append(pa.array((running[cut[1:]] - running[cut[:-1]]).view(np.int64)))
                columns = [batch.column("doc_id").slice(at, end - at), pa.array(n), *sums]
                names = ["doc_id", "n", "a", "b"]
                if whole:
                    columns.append(pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(h.view(np.int64))))
                    names.append("hashes")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return sketch


SKETCH = "doc_id long, n long, a long, b long"


def _nodes(rows: DataFrame, many: DataFrame) -> DataFrame:
    """Add ``node``: the id, or for ids of several sets one number for each set, above all ids."""
    own = F.xxhash64("doc_id", "n", "a", "b").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return rows.join(checked(many), "doc_id", "left").withColumn("node", F.when(F.col("many"), own).otherwise(F.col("doc_id"))).drop("many")


def _slot(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ _U(0x2545F4914F6CDD1D)) & _U(SLOTS - 1)).astype(np.int64)


PART = SLOTS // 64


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(SLOTS, np.uint32)
    for batch in batches:
        h = batch.column("hashes").flatten().to_numpy().view(_U)
        table += np.bincount(_slot(h), minlength=SLOTS).astype(np.uint32)
    parts = [(k, table[k * PART : (k + 1) * PART]) for k in range(SLOTS // PART)]
    parts = [(k, t.tobytes()) for k, t in parts if t.any()]
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([t for _, t in parts], pa.binary())], names=["part", "t"])


def _add_slots(key: tuple, table: pa.Table) -> pa.Table:
    total = np.zeros(PART, np.uint64)
    for t in table.column("t"):
        total += np.frombuffer(t.as_buffer(), np.uint32)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "t": pa.array([np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()], pa.binary())})


def count_table(packed: DataFrame) -> np.ndarray:
    """How many documents hold shingles of each slot: over the real count of each of its shingles, by chance."""
    counted = packed.select("hashes").mapInArrow(tidy(_count_slots), "part int, t binary").groupBy("part").applyInArrow(_add_slots, "part int, t binary")
    table = np.zeros(SLOTS, np.uint32)
    for part, t in counted.collect():
        table[part * PART : (part + 1) * PART] = np.frombuffer(t, np.uint32)
    return table


def _choose(n: int, cost: np.ndarray, percent: int) -> int:
    """The number of shared shingles to ask for: least prefix cost plus estimated candidates to verify."""
    free = n - int(overlap(np.array(n), percent))
    running = np.cumsum(cost)
    options = [k for k in (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64) if free + k <= n and k <= max(1, n // 4)]
    value = [running[free + k - 1] * (1 + VERIFY / k) for k in options]
    return options[int(np.argmin(value))]


def _prefixes(table, percent: int):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = table.value
        for batch in batches:
            flat = batch.column("hashes").flatten().to_numpy().view(_U)
            n = batch.column("n").to_numpy()
            cut = np.concatenate([[0], np.cumsum(n)])
            count = slots[_slot(flat)].astype(np.int64)
            keep, ells, typical = [], [], []
            for i in range(len(n)):
                c, h = count[cut[i] : cut[i + 1]], flat[cut[i] : cut[i + 1]]
                order = np.lexsort((h, c))
                # One document's own entry costs nothing.
                k = _choose(int(n[i]), np.maximum(c[order] - 1, 0), percent)
                keep.append(h[order[: int(n[i]) - int(overlap(n[i], percent)) + k]])
                ells.append(k)
                typical.append(float(np.minimum(c, 1000).mean()))
            sizes = np.array([len(x) for x in keep], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keep).view(np.int64) if keep else np.zeros(0, np.int64)),
                    batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(n)), sizes))),
                    pa.array(np.repeat(n, sizes)),
                    pa.array(np.repeat(batch.column("most").to_numpy(), sizes)),
                    pa.array(np.repeat(ells, sizes).astype(np.int64)),
                    pa.array(np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)),
                    pa.array(np.repeat(typical, sizes).astype(np.float64)),
                ],
                names=["h", "doc_id", "n", "most", "ell", "place", "typical"],
            )

    return prefixes


def _comparable(n: str, most: str, m: str, most_of_m: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar, with no more in common than either shares with anything."""
    common = F.least(n, m, most, most_of_m)
    return 100 * common >= percent * (F.col(n) + F.col(m) - common)


def _common(pairs: DataFrame, packed: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b and more) with ``common``, ``near`` (the similarity in parts of WHOLE) and ``similar`` of the whole sets."""
    left = packed.select(F.col("doc_id").alias("a"), F.col("n").alias("_n"), F.col("hashes").alias("_h"))
    right = packed.select(F.col("doc_id").alias("b"), F.col("n").alias("_m"), F.col("hashes").alias("_g"))
    common = F.size(F.array_intersect("_h", "_g")).cast("long")
    both = pairs.join(left, "a").join(right, "b").select(*pairs.columns, (F.col("_n") + F.col("_m")).alias("_both"), common.alias("common"))
    union = F.col("_both") - F.col("common")
    near = F.floor(F.lit(WHOLE).cast("long") * F.col("common") / union).cast("long")
    return both.withColumn("near", near).withColumn("similar", 100 * F.col("common") >= percent * union).drop("_both")


def _verify(pairs: DataFrame, packed: DataFrame, percent: int) -> DataFrame:
    """(a, b, near, common) of the pairs whose whole sets are similar."""
    return _common(pairs.select("a", "b"), packed, percent).where("similar").select("a", "b", "near", "common").distinct()


def _grouped(links: DataFrame, base: str) -> DataFrame:
    return land(components(links.select("a", "b"), base), f"{base}/all").withColumnsRenamed({"id": "doc_id", "component_id": "group"})


def _open(prefix: DataFrame, groups: DataFrame, base: str) -> DataFrame:
    """Rows of the shingles that several groups hold, with the row's group and the shingle's largest one."""
    placed = land(prefix.join(checked(groups), "doc_id", "left").withColumn("group", F.coalesce("group", "doc_id")), f"{base}-placed")
    sizes = placed.groupBy("h", "group").agg(F.count("*").alias("k"))
    mixed = sizes.groupBy("h").agg(F.max(F.struct("k", "group")).alias("big"), F.count("*").alias("groups")).where("groups > 1")
    mixed = land(mixed.select("h", F.col("big.group").alias("big")), f"{base}-mixed")
    return land(placed.join(checked(mixed), "h"), f"{base}-open")


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, n_links and component_id of every row of ``docs``.

    A document's set is its distinct shingles of ``size`` words, or its whole
    text if it has fewer; null texts and texts without words have none and link
    with nothing.  Documents link at a similarity of ``percent``;
    ``component_id`` is the smallest id that links reach, the own one included.
    Links are between different sets; equal sets always link.  ``n_links``
    counts the verified ones that the groups were found by, not all.

    Rows that share an id are one node.  A row without an id links with nothing
    and has no component.  ``docs`` is read more than once and should be a table.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "jaccard")
    texts = docs.select("doc_id", "text")
    named = texts.where(F.col("doc_id").isNotNull())
    rows = land(shared_counts(named, size, percent), f"{base}/rows")
    left = land(rows.where((F.col("n") > 0) & (F.col("shared") >= F.floor(F.col("n") / 8) + 1)).select("doc_id").distinct(), f"{base}/left")
    some = land(named.join(checked(left), "doc_id", "left_semi"), f"{base}/texts")

    # Equal sets: the smallest id stands for all.
    marks = land(some.mapInArrow(tidy(_sketch(size, False)), SKETCH), f"{base}/marks")
    many = marks.distinct().groupBy("doc_id").agg((F.count("*") > 1).alias("many")).where("many")
    many = land(many, f"{base}/many")
    marks = _nodes(marks, many)
    first = marks.groupBy("n", "a", "b").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    first = land(first, f"{base}/first")
    several = first.where("first <> last").select("n", "a", "b", "first")
    equal = marks.join(checked(several), ["n", "a", "b"]).where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    equal = equal.union(marks.where("node <> doc_id").select(F.col("node").alias("a"), F.col("doc_id").alias("b")))
    stand = land(first.select(F.col("first").alias("node")).distinct(), f"{base}/stand")
    packed = _nodes(some.mapInArrow(tidy(_sketch(size, True)), SKETCH + ", hashes array<long>").where("n > 0"), many)
    packed = land(packed.join(checked(stand), "node", "left_semi").select(F.col("node").alias("doc_id"), "n", "hashes"), f"{base}/sets")

    # No two sets have more in common than what is not the own of either.
    most = shared_counts(packed, size, percent, whole=True).groupBy("doc_id").agg(F.max("shared").alias("most"), F.max((100 * F.col("shared") >= percent * F.col("n"))).alias("_can"))
    most = land(most.where("_can").select("doc_id", "most"), f"{base}/most")
    packed = packed.join(checked(most), "doc_id")

    table = spark.sparkContext.broadcast(count_table(packed))
    prefix = packed.select("doc_id", "n", "hashes", "most").mapInArrow(tidy(_prefixes(table, percent)), "h long, doc_id long, n long, most long, ell long, place long, typical double")
    prefix = land(prefix, f"{base}/prefix")
    table.destroy()
    heads = prefix.groupBy("h").agg(F.max(F.struct("typical", -F.col("doc_id"), "n", "most")).alias("head"), F.count("*").alias("docs")).where("docs > 1")
    heads = land(heads.select("h", (-F.col("head.col2")).alias("a"), F.col("head.n").alias("m"), F.col("head.most").alias("most_of_m")), f"{base}/heads")
    prefix = land(prefix.drop("typical").join(heads, "h"), f"{base}/common")
    star = prefix.where(F.col("a") != F.col("doc_id")).where(_comparable("n", "most", "m", "most_of_m", percent))
    star = land(star.select("a", F.col("doc_id").alias("b")).distinct(), f"{base}/star")
    links = land(_verify(star, packed, percent), f"{base}/links-0")

    # Documents that the most typical one did not reach try some others of the largest group.
    open_ = _open(prefix, _grouped(links, f"{base}/groups-0"), f"{base}/0")
    tries = [F.max(F.when(F.col("group") == F.col("big"), F.struct(F.xxhash64(F.lit(s), "doc_id").alias("k"), F.col("doc_id").alias("a"), F.col("n").alias("m"), F.col("most").alias("most_of_m")))).alias(f"t{s}") for s in range(TRIES)]
    others = open_.groupBy("h").agg(*tries).select("h", F.explode(F.array_distinct(F.array(*[f"t{s}" for s in range(TRIES)]))).alias("t")).select("h", "t.a", "t.m", "t.most_of_m")
    again = open_.where(F.col("group") != F.col("big")).drop("a", "m", "most_of_m").join(others, "h").where(_comparable("n", "most", "m", "most_of_m", percent))
    again = land(again.select("a", F.col("doc_id").alias("b")).distinct().join(star, ["a", "b"], "left_anti"), f"{base}/again")
    links = land(links.union(_verify(again, packed, percent)), f"{base}/links")

    # What groups are left may still be linked by a pair.  A document's cell is the nearest one it is known to link
    # with, else itself.  Differences of sets, 1 less the similarity, obey the triangle inequality: two cells whose
    # middles differ by more than a link and both radii have no link.
    groups = land(_grouped(links, f"{base}/groups-1"), f"{base}/groups")
    cells = links.groupBy(F.col("b").alias("doc_id")).agg(F.max(F.struct("near", "a", "common")).alias("_"))
    cells = cells.select("doc_id", F.col("_.a").alias("cell"), (WHOLE - F.col("_.near")).alias("off"), F.col("_.common").alias("inside"))
    cells = land(cells, f"{base}/cells")
    open_ = _open(prefix, groups, f"{base}/1").join(checked(cells), "doc_id", "left")
    open_ = open_.withColumn("cell", F.coalesce("cell", "doc_id")).withColumn("off", F.coalesce("off", F.lit(0).cast("long"))).withColumn("inside", F.coalesce("inside", "n"))
    open_ = land(open_.select("h", "doc_id", "n", "most", "ell", "place", "group", "big", "cell", "off", "inside"), f"{base}/open")
    sizes = open_.groupBy("cell").agg(F.max("off").alias("radius"), ((F.min("doc_id") == F.max("doc_id")) & (F.max("off") == 0)).alias("single"))
    per = open_.groupBy("h", "cell", "group", "big").agg(F.min("ell").alias("ell"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("most").alias("most"), F.max("ell").alias("top"), F.max(F.col("n") - F.col("place")).alias("left"))
    per = land(per.join(checked(land(sizes, f"{base}/sizes")), "cell"), f"{base}/per")
    one = per.where(F.col("group") != F.col("big"))
    other = per.select("h", *[F.col(c).alias(f"{c}2") for c in ("cell", "group", "ell", "low", "high", "most", "top", "left", "radius", "single")])
    met = one.join(other, "h").where(F.col("group") != F.col("group2")).where((F.col("group2") == F.col("big")) | (F.col("cell") < F.col("cell2")))
    able = F.least("most", "most2", "high", "high2")
    met = met.where(100 * able >= percent * (F.greatest("low", able) + F.greatest("low2", able) - able))
    # Of two sets that share at least so many, the first n - least + k of each share k: only these places count.
    least = F.ceil(percent * (F.col("low") + F.col("low2")) / (100 + percent))
    met = met.where(F.least("left", "left2") + F.least("top", "top2") > least)
    swap = F.col("cell") > F.col("cell2")
    pick = lambda x, y, name: F.when(swap, F.col(y)).otherwise(F.col(x)).alias(name)
    met = met.select(
        pick("cell", "cell2", "a"), pick("cell2", "cell", "b"), pick("radius", "radius2", "r"), pick("radius2", "radius", "q"), pick("single", "single2", "one"), pick("single2", "single", "other"),
        (F.col("single") & F.col("single2")).alias("single"), F.least("ell", "ell2").alias("ell"),
    )
    # Two cells of one document each: their shared prefix shingles are counted whole.
    met = met.groupBy("a", "b").agg(F.count("*").alias("k"), F.min("ell").alias("ell"), F.max("single").alias("single"), F.max("r").alias("r"), F.max("q").alias("q"), F.max("one").alias("one"), F.max("other").alias("other"))
    met = land(met.where(~F.col("single") | (F.col("k") >= F.col("ell"))).select("a", "b", "r", "q", "one", "other"), f"{base}/cell-pairs")
    link = WHOLE - WHOLE * percent // 100 + 4  # and what rounding can add
    apart = WHOLE - F.col("near")
    close = land(_common(met, packed, percent).withColumn("apart", apart).where(F.col("apart") <= link + F.col("r") + F.col("q")).distinct(), f"{base}/close")
    # A document alone in its cell stands first, so that the larger cell is opened under all bounds at once.
    turn = F.col("other") & ~F.col("one")
    first_of = lambda x, y: [F.when(turn, F.col(y)).otherwise(F.col(x)).alias(x), F.when(turn, F.col(x)).otherwise(F.col(y)).alias(y)]
    close = close.select(*first_of("a", "b"), *first_of("r", "q"), *first_of("one", "other"), "apart", "common")
    members = land(open_.select("cell", "doc_id", "off", "inside", "n", "most").distinct(), f"{base}/members")
    left_ = members.select(F.col("cell").alias("a"), F.col("doc_id").alias("x"), F.col("off").alias("xo"), F.col("inside").alias("xi"), F.col("n").alias("xn"), F.col("most").alias("xm"))
    right_ = members.select(F.col("cell").alias("b"), F.col("doc_id").alias("y"), F.col("off").alias("yo"), F.col("inside").alias("yi"), F.col("n").alias("yn"), F.col("most").alias("ym"))
    pairs = close.join(left_, "a").where(F.col("apart") <= link + F.col("xo") + F.col("q")).join(right_, "b")
    pairs = pairs.where((F.col("apart") <= link + F.col("xo") + F.col("yo")) & _comparable("xn", "xm", "yn", "ym", percent))
    # A document alone in its cell is compared with the other cell's middle: what it can have in common with a member
    # lies within the middle, at most as much as either has there, or outside, at most what either shares with anything.
    # A middle has all its shingles inside, also those that it shares with nothing, and none outside.
    bound = lambda alone, mine, theirs, inside: F.when(
        F.col(alone), F.least("common", inside) + F.least(*(F.greatest(x, F.lit(0).cast("long")) for x in (F.col(mine) - F.col("common"), F.col(theirs) - F.col(inside))))
    ).otherwise(F.lit(1 << 60))
    able = F.least(bound("one", "xm", "ym", "yi"), bound("other", "ym", "xm", "xi"), F.least("xn", "yn"))
    pairs = pairs.where(100 * able >= percent * (F.col("xn") + F.col("yn") - able))
    pairs = land(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), f"{base}/pairs")
    crossed = land(_verify(pairs, packed, percent).select("a", "b"), f"{base}/cross-links")
    links = links.select("a", "b")

    edges = land(equal.union(links).union(crossed).distinct(), f"{base}/all-links")
    found = components(edges, f"{base}/all-groups")
    ends = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).groupBy("id").agg(F.count("*").alias("n_links"))
    found = land(found.join(ends, "id"), f"{base}/found")
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(checked(found), F.col("doc_id") == F.col("id"), "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "doc_id").alias("component_id"))
    nameless = texts.where(F.col("doc_id").isNull()).mapInArrow(tidy(_sketch(size, False)), SKETCH)
    return out.union(nameless.select("doc_id", "n", F.lit(0).cast("long"), F.col("doc_id").alias("component_id")))
