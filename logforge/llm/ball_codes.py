"""Vector code compression: product codes whose codebooks are refined by ball k-means.

Vectors are cut into four parts, each with a codebook of at most 256 entries.
A round gives every part its nearest entry and moves each entry to the floored
mean of its parts.  All arithmetic is on integers, so codes do not depend on how
rows are spread over tasks.

Ball k-means leaves out work that cannot change a code.  Members of an entry lie
in a ball.  Only entries nearer than the ball's diameter are neighbours.  A part
nearer to its entry than half the way to the nearest neighbour is in the stable
core and keeps its code; any other lies in a ring, between the half ways to two
successive neighbours, and is compared with the neighbours up to there.  The
comparisons are of exact squares, ties included, so nothing is approximated.

Vectors are packed once into blocks, in a table bucketed by block.  A round reads
it with the codes of the round before, bucketed alike: the join has no shuffle,
and a round writes four bytes for a vector and sums of fixed size for a task.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.scale import left_lookup, work_dir

from .common import block_id, land

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Vectors of a block.
BLOCK = 1024
# Bytes of packed vectors that one task reads.
TASK_BYTES = 64 << 20
# Ring members with at most so many candidates are compared pair by pair; with more, a product with the codebook is less work.
FEW = 24
LIMB = 32
LARGEST = (1 << 63) - 1


def exact(flat: np.ndarray) -> np.ndarray:
    """floor(1024 x) of finite values: 64-bit, or Python's integers if one is too large."""
    flat = flat.astype(np.float64)
    if not len(flat) or np.abs(flat).max() < 2.0**40:
        return np.floor(flat * SCALE).astype(np.int64)
    return np.array([int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in flat.tolist()], object)


def kind_for(dim: int, *arrays: np.ndarray) -> type:
    """A type in which all squared distances between rows of these arrays are exact."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    bound = max(dim, 1) * (2 * most) ** 2
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 61 else object


@dataclass
class Balls:
    """A part's entries, and of each the neighbours by growing distance, with the squares (beyond all comparison outside the ball's reach)."""

    entries: np.ndarray
    squares: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray, radius: np.ndarray, kind: type) -> Balls:
        own = entries.astype(kind)
        between = np.empty((len(own), len(own)), kind)
        for i in range(len(own)):
            between[i] = ((own - own[i]) ** 2).sum(1)
            between[i, i] = -1  # first in its own order
        order = np.argsort(between, axis=1, kind="stable")[:, 1:]
        squares = np.take_along_axis(between, order, 1)
        # A radius is an upper bound; the small factor covers its rounding.
        reach = (2 * radius) ** 2 * (1 + 1e-9)
        near = squares.astype(np.float64) <= reach[:, None]
        width = int(near.sum(1).max(initial=0))
        squares = np.where(near, squares, LARGEST if kind is np.int64 else np.inf)[:, :width]
        return cls(own, squares, order[:, :width])


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row, the lower index at ties, and the squared distance."""
    squares = (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None]
    code = squares.argmin(1)
    return code, squares[np.arange(len(x)), code]


def refine(x: np.ndarray, old: np.ndarray, balls: Balls) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entries given those of the round before; also how many parts lay in a stable core."""
    entries = balls.entries
    best = ((x - entries[old]) ** 2).sum(1)
    code = old.copy()
    if not balls.order.shape[1]:
        return code, best, len(x)
    reach = 4 * best
    ring = np.flatnonzero(balls.squares[old, 0] <= reach)
    count = (balls.squares[old[ring]] <= reach[ring, None]).sum(1)
    wide = ring[count > FEW]
    if len(wide):
        code[wide], best[wide] = nearest(x[wide], entries)
    few, count = ring[count <= FEW], count[count <= FEW]
    if len(few):
        row = np.repeat(few, count)
        first = np.cumsum(count) - count
        candidate = balls.order[old[row], np.arange(len(row)) - np.repeat(first, count)]
        square = ((x[row] - entries[candidate]) ** 2).sum(1)
        least = np.minimum.reduceat(square, first)
        lowest = np.minimum.reduceat(np.where(square == np.repeat(least, count), candidate, len(entries)), first)
        better = (least < best[few]) | ((least == best[few]) & (lowest < old[few]))
        code[few[better]], best[few[better]] = lowest[better], least[better]
    return code, best, len(x) - len(ring)


def _kept(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
    """Components and lengths of the vectors without null or non-finite components, and their rows."""
    column = batch.column("embedding")
    flat, lengths = column.flatten(), pc.list_value_length(pc.fill_null(column, pa.scalar([], column.type))).to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, math.nan).to_numpy(zero_copy_only=False)
    cut = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    keep = (wrong[cut[1:]] == wrong[cut[:-1]]) & ~column.is_null().to_numpy(zero_copy_only=False)
    if not keep.all():
        values = values[np.repeat(keep, lengths)]
        batch, lengths = batch.filter(pa.array(keep)), lengths[keep]
    return values, lengths, batch


def _smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task: how many vectors are kept, the longest, and the first ``ENTRIES`` by id, with the ties at the end left out by value."""
    rows, longest, first = 0, 0, {}
    for batch in batches:
        values, lengths, batch = _kept(batch)
        rows, longest = rows + len(lengths), max(longest, int(lengths.max(initial=0)))
        cut = np.cumsum(lengths) - lengths
        ids = batch.column("vec_id")
        known = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
        order = known[np.argsort(ids.take(pa.array(known)).to_numpy(), kind="stable")] if len(known) else known
        limit = max(first) if len(first) >= ENTRIES else None
        for i in order.tolist():
            key = ids[i].as_py()
            if limit is not None and key > limit or len(first) >= ENTRIES and key > max(first):
                break
            vector = values[cut[i] : cut[i] + lengths[i]].tolist()
            first[key] = min(first.get(key, vector), vector)
            if len(first) > ENTRIES:
                del first[max(first)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([None, *first], pa.int64()), pa.array([None, *first.values()], pa.list_(pa.float64())), pa.array([rows] + [0] * len(first), pa.int64()), pa.array([longest] + [0] * len(first), pa.int64())],
        names=["vec_id", "vector", "rows", "longest"],
    )


def _blocks(dim: int):
    """Kept vectors, packed; each component in as few bytes as the block allows."""

    def pack(held: list[tuple[np.ndarray, pa.RecordBatch]], before: int) -> pa.RecordBatch:
        grid = np.concatenate([g for g, _ in held])
        whole = exact(grid.ravel())
        if whole.dtype == object:
            kind, data = "raw", grid.tobytes()
        else:
            most = int(np.abs(whole).max(initial=0))
            kind = next(k for k, top in (("int16", 1 << 15), ("int32", 1 << 31), ("int64", 1 << 63)) if most < top)
            data = whole.astype(kind).tobytes()
        ids, labels = (pa.concat_arrays([b.column(c) for _, b in held]) for c in ("vec_id", "label"))
        one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        return pa.RecordBatch.from_arrays([pa.array([block_id(before)]), one(ids), one(labels), pa.array([kind]), pa.array([data], pa.binary())], names=["block", "ids", "labels", "kind", "data"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, before = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                values, lengths, some = _kept(batch.slice(at, BLOCK))
                grid = np.zeros((len(lengths), dim))
                grid[np.arange(dim)[None] < lengths[:, None]] = values
                if rows + len(grid) > BLOCK:
                    yield pack(held, before)
                    held, rows, before = [], 0, before + 1
                held.append((grid, some))
                rows += len(grid)
        if rows:
            yield pack(held, before)

    return blocks


def _parts(kind: str, data: bytes, n: int, dim: int) -> np.ndarray:
    """A block's components as (part, vector, place)."""
    grid = exact(np.frombuffer(data, np.float64)) if kind == "raw" else np.frombuffer(data, kind)
    return grid.reshape(n, PARTS, dim // PARTS).transpose(1, 0, 2)


def _limbs(total: np.ndarray) -> list[np.ndarray]:
    """Integers as 32-bit digits, the last one signed: sums of digits cannot overflow."""
    out = []
    while True:
        if total.dtype != object or not total.size or max(abs(int(total.max())), abs(int(total.min()))) < 1 << 62:
            total = total.astype(np.int64)
            return [*out, total & 0xFFFFFFFF, total >> LIMB]
        out.append((total & 0xFFFFFFFF).astype(np.int64))
        total = total >> LIMB


ROUND = "block long, codes binary, part int, entry int, limb int, n long, far double, sums array<long>"
FINAL = "code string, error long"


def _assigner(books: list[np.ndarray], radius: np.ndarray | None, dim: int):
    """Codes and squared distances of a block's parts."""
    cache: dict[tuple[int, type], Balls] = {}

    def assign(parts: np.ndarray, codes: np.ndarray | None) -> tuple[list[np.ndarray], list[np.ndarray]]:
        found, squares = [], []
        for p in range(PARTS):
            kind = kind_for(dim // PARTS, parts[p], books[p])
            x = parts[p].astype(kind)
            if codes is None:
                code, square = nearest(x, books[p].astype(kind))
            else:
                if (p, kind) not in cache:
                    cache[p, kind] = Balls.of(books[p], radius[p], kind)
                code, square, _ = refine(x, codes[p].astype(np.int64), cache[p, kind])
            found.append(code)
            squares.append(square)
        return found, squares

    return assign


def _round(books: list[np.ndarray], radius: np.ndarray | None, dim: int):
    """New codes of each block, and for the task each entry's members: number, farthest and sums."""
    size = len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigner(books, radius, dim)
        total: list[np.ndarray] = [np.zeros((size, dim // PARTS), np.int64) for _ in range(PARTS)]
        number, far = np.zeros((PARTS, size), np.int64), np.zeros((PARTS, size))
        block = None
        for batch in batches:
            for i in range(batch.num_rows):
                block, kind, data = (batch.column(c)[i].as_py() for c in ("block", "kind", "data"))
                n = len(batch.column("ids")[i])
                old = None if radius is None else np.frombuffer(batch.column("codes")[i].as_py(), np.uint8).reshape(PARTS, n)
                parts = _parts(kind, data, n, dim)
                found, squares = assign(parts, old)
                for p in range(PARTS):
                    if parts[p].dtype == object and total[p].dtype != object:
                        total[p] = total[p].astype(object)
                    np.add.at(total[p], found[p], parts[p])
                    number[p] += np.bincount(found[p], minlength=size)
                    np.maximum.at(far[p], found[p], np.sqrt(squares[p].astype(np.float64)))
                codes = np.stack(found).astype(np.uint8).tobytes()
                yield _rows([(block, codes, None, None, None, None, None, None)])
        if block is None:
            return
        out = []
        for p in range(PARTS):
            used = np.flatnonzero(number[p])
            for k, digits in enumerate(_limbs(total[p][used])):
                out += [(block, None, p, int(e), k, int(number[p, e]) * (k == 0), float(far[p, e]), digits[j].tolist()) for j, e in enumerate(used)]
        yield _rows(out)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.int64()))
    names = [x.split()[0] for x in ROUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _final(books: list[np.ndarray], radius: np.ndarray, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigner(books, radius, dim)
        for batch in batches:
            for i in range(batch.num_rows):
                kind, data = (batch.column(c)[i].as_py() for c in ("kind", "data"))
                ids, labels = (batch.column(c)[i].values for c in ("ids", "labels"))
                old = np.frombuffer(batch.column("codes")[i].as_py(), np.uint8).reshape(PARTS, len(ids))
                found, squares = assign(_parts(kind, data, len(ids), dim), old)
                error = np.zeros(len(ids), object)
                for s in squares:
                    error += [int(x) for x in s]
                code = [row.tobytes().hex() for row in np.stack(found, 1).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code, pa.string()), pa.array([min(x, LARGEST) for x in error], pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


def compress(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[list[list[int]]]]:
    """vec_id, label, code and error of every kept row of ``vectors`` (vec_id, embedding, label), and the four codebooks.

    Rows whose vector is null or holds a null or non-finite component are left
    out.  Codebooks start from the smallest ids: rows of one id give the least of
    their vectors, rows without an id none (they are coded like all others; if
    no row has an id, the only entry is zero).  With fewer ids there are fewer
    entries.  Vectors shorter than the longest, or than the next multiple of four,
    are read as if zeros followed.  An error above 2**63 - 1 is given as that.
    An empty table gives no rows and empty codebooks.
    """
    if not 1 <= entries <= ENTRIES:
        raise ValueError(f"from 1 to {ENTRIES} entries")
    spark = vectors.sparkSession
    base = work_dir(spark, "codes")
    kinds = dict(vectors.dtypes)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    found = vectors.select("vec_id", "embedding").mapInArrow(_smallest, "vec_id long, vector array<double>, rows long, longest long")
    found = land(found, f"{base}/first")
    rows, longest = found.agg(F.sum("rows"), F.max("longest")).first()
    schema = f"vec_id long, label {kinds['label']}, {FINAL}"
    if not rows:
        return spark.createDataFrame([], schema), [[] for _ in range(PARTS)]
    dim = -(-longest // PARTS) * PARTS
    first = found.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy("vec_id").limit(entries).collect()
    start = np.zeros((max(1, len(first)), dim))
    for i, r in enumerate(first):
        start[i, : len(r.vector)] = r.vector
    books = [b.copy() for b in exact(start.ravel()).reshape(len(start), PARTS, dim // PARTS).transpose(1, 0, 2)]

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows * dim * 2 // TASK_BYTES))
    token = uuid.uuid4().hex
    made: list[str] = []

    def bucketed(df: DataFrame, name: str) -> DataFrame:
        made.append(f"codes_{token}_{name}")
        df.write.bucketBy(tasks, "block").option("path", f"{base}/{name}").saveAsTable(made[-1])
        return spark.table(made[-1])

    try:
        packed = vectors.mapInArrow(_blocks(dim), f"block long, ids array<long>, labels array<{kinds['label']}>, kind string, data binary")
        packed = bucketed(packed.repartition(tasks, "block"), "blocks")
        radius, codes = None, None
        for n in range(rounds):
            given = packed if codes is None else packed.join(codes.hint("shuffle_hash"), "block")
            done = bucketed(given.mapInArrow(_round(books, radius, dim), ROUND), f"round_{n}")
            books, radius = _moved(done, books, dim)
            codes = done.where(F.col("part").isNull()).select("block", "codes")
        given = packed.join(codes.hint("shuffle_hash"), "block")
        return land(given.mapInArrow(_final(books, radius, dim), schema), f"{base}/coded"), [b.tolist() for b in books]
    finally:
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _moved(done: DataFrame, books: list[np.ndarray], dim: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries at their members' floored mean, and how far members of the round's assignment can be from them.

    What comes to the driver is four codebooks of sums, whatever the input.
    """
    width = dim // PARTS
    sums = F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]) if width else F.array().cast("array<long>")
    rows = done.where(F.col("part").isNotNull()).groupBy("part", "entry", "limb").agg(F.sum("n").alias("n"), F.max("far").alias("far"), sums.alias("sums")).collect()
    books, radius = [b.astype(object) for b in books], np.zeros((PARTS, len(books[0])))
    number: dict[tuple[int, int], int] = {}
    total: dict[tuple[int, int], list[int]] = {}
    for r in rows:
        key = (r.part, r.entry)
        number[key] = number.get(key, 0) + r.n
        total[key] = [t + (s << (LIMB * r.limb)) for t, s in zip(total.get(key, [0] * width), r.sums, strict=True)]
        radius[key] = max(radius[key], r.far)
    for (p, e), n in number.items():
        new = np.array([t // n for t in total[p, e]], object)
        shift = float(((new - books[p][e]) ** 2).sum()) ** 0.5 if width else 0.0
        books[p][e] = new
        radius[p, e] = (radius[p, e] + shift) * (1 + 1e-9)
    small = all(abs(int(v)) < 1 << 40 for b in books for v in b.ravel())
    return [b.astype(np.int64) if small else b for b in books], radius


def codebooks_sha256(books: list[list[list[int]]]) -> str:
    """Of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for part in books for entry in part for v in entry).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error of all rows of the same label (nulls are one label), at most 2**63 - 1."""
    key = F.coalesce(F.col("label").cast("string"), F.lit("")).alias("_label"), F.col("label").isNull().alias("_none")
    coded = coded.select("*", *key)
    total = coded.groupBy("_label", "_none").agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("label_error"))
    total = total.withColumn("label_error", F.least("label_error", F.lit(LARGEST).cast("decimal(38,0)")).cast("long"))
    return left_lookup(coded, total, ["_label", "_none"]).drop("_label", "_none")
