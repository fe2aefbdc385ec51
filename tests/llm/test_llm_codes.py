"""Ball k-means codes, importance resampling and circulant MinHash against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_cases import LOWER, awkward, frame, prose, table, words

from logforge.llm.ball_codes import Balls, codebooks_sha256, compress, exact, kind_for, label_errors, nearest, refine
from logforge.llm.circulant import BANDS, WIDTH, band_keys, near_copies, signature
from logforge.llm.importance import BUCKETS, Grams, grams, resample, xxh64
from logforge.llm.oracle import ORACLE
from logforge.llm.words import buffers, mix

VECTORS = "vec_id long, embedding array<double>, label int, block long, codes string, n int, first string"


def codes_by_hand(rows, size=256, rounds=4):
    kept = [(i, [int(x) * 1024 if abs(x) >= 2**53 else math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4)
    kept = [(i, v + [0] * (4 * width - len(v)), label) for i, v, label in kept]
    first = {}
    for i, v, _ in kept:
        if i is not None:
            first[i] = min(first.get(i, v), v)
    start = [first[i] for i in sorted(first)][:size] or [[0] * 4 * width]
    books = [[v[p * width : (p + 1) * width] for v in start] for p in range(4)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[p * width : (p + 1) * width], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(4)] for _, v, _ in kept]

    for _ in range(rounds):
        found = assign()
        for p in range(4):
            for k in range(len(books[p])):
                own = [v[p * width : (p + 1) * width] for (_, v, _), f in zip(kept, found, strict=True) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    top = (1 << 63) - 1
    rows = [(i, "".join(f"{k:02x}" for _, k in f), min(top, sum(d for d, _ in f)), label) for (i, _, label), f in zip(kept, assign(), strict=True)]
    total = defaultdict(int)
    for _, _, error, label in rows:
        total[label] += error
    return sorted((repr(i), c, e, min(top, total[label])) for i, c, e, label in rows), books


def vectors(spark, rows, tmp_path):
    path = str(tmp_path / "vectors")
    spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], VECTORS).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def cloud(seed, n, dim=8):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(12)]
    return [(i, [m + rng.gauss(0, 0.05) for m in rng.choice(middles)], rng.choice((1, 2, 2, None))) for i in range(n)]


ODD = [
    (900, None, 1), (901, [1.0, None, 2.0, 3.0], 1), (902, [math.nan] * 8, 1), (903, [math.inf] * 8, 2), (None, [0.1] * 8, None), (None, None, None),
    (5, [0.5] * 8, 1), (5, [-0.5] * 8, 1), (5, [0.5] * 8, 1), (904, [], 3), (905, [0.25], None), (906, [0.25] * 10, 2),
]


@pytest.mark.parametrize("rows", [cloud(1, 500), cloud(2, 120) + ODD, cloud(3, 40) + [(950, [1e30, -1e30] * 4, 7), (951, [3e38] * 8, 7), (952, [2e10] * 8, 7)], [(i, [0.5] * 8, 1) for i in range(300)], ODD[:6]])
def test_codes(spark, tmp_path, rows):
    coded, books = compress(vectors(spark, rows, tmp_path))
    want, by_hand = codes_by_hand(rows)
    assert sorted((repr(r.vec_id), r.code, r.error, r.label_error) for r in label_errors(coded).collect()) == want
    assert books == by_hand and codebooks_sha256(books) == hashlib.sha256(",".join(str(v) for b in by_hand for e in b for v in e).encode()).hexdigest()


def test_codes_without_rows(spark, tmp_path):
    coded, books = compress(vectors(spark, [(1, None, 1)], tmp_path))
    assert label_errors(coded).collect() == [] and books == [[], [], [], []]
    assert compress(spark.createDataFrame([], VECTORS))[0].collect() == []


@pytest.mark.parametrize("most", [3, 900, 1 << 28, 1 << 40])
def test_rings_lose_nothing(most):
    """With a code from any earlier round, the neighbours compared hold the nearest entry; cores skip work."""
    rng = np.random.default_rng(most)
    middles = rng.integers(-most, most + 1, (30, 4))
    entries = np.concatenate([middles, middles[:5]])
    x = middles[rng.integers(0, 30, 400)] + rng.integers(-1 - most // 50, 2 + most // 50, (400, 4))
    kind = kind_for(4, x, entries)
    old = nearest(x.astype(kind), (entries + rng.integers(-2, 3, entries.shape)).astype(kind))[0]
    far = np.zeros(len(entries))
    np.maximum.at(far, old, np.sqrt(((x - entries[old]).astype(object) ** 2).sum(1).astype(float)))
    code, square, core = refine(x.astype(kind), old, Balls.of(entries, far * (1 + 1e-9), kind))
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(entries)) for v in x]
    assert [(int(s), int(c)) for s, c in zip(square, code, strict=True)] == want
    assert core > 100 or most == 3


def test_exact():
    x = np.array([0.1, -0.1, 1e15, -1e300, 2.0**52 + 0.5])
    assert exact(x).tolist() == [102, -103, 10**15 * 1024, int(-1e300) * 1024, (2**52) * 1024 + (512 if x[4] != 2.0**52 else 0)]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, w + [f"{a} {b}" for a, b in itertools.pairwise(w)]


def drawn_by_hand(docs, target):
    bucket = lambda x: zlib.crc32(x.encode()) % BUCKETS
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    size, wanted = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (size + BUCKETS) / ((s[b] + 1) * (wanted + BUCKETS)))) for b in range(BUCKETS)]
    rows = []
    for i, text in docs:
        w, f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    n = 25 * len(able) // 100
    return sorted(map(repr, [(*r, k + 1 if k < n else None) for k, r in enumerate(able)] + [(*r, None) for r in rows if r[1] < 20]))


@pytest.mark.parametrize("seed", [1, 2])
def test_resample(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = awkward(seed) + [(500 + i, f"É{i}-x_{'y' * i} " + prose(rng, 30), "s") for i in range(60)] + [(700, prose(rng, 25), "s")] * 9
    target = [None, "", prose(rng, 40), prose(rng, 10).upper()]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = resample(table(spark, rows, tmp_path), bench)
    assert sorted(repr(tuple(r)) for r in got.collect()) == drawn_by_hand([(i, t) for i, t, _ in rows], target)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t, _ in rows])
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", list(enumerate(target)))
    assert sorted(map(repr, con.execute(ORACLE["op12_importance"]).fetchall())) == sorted(repr(tuple(r)) for r in got.drop("n_words").collect())


def test_resample_without_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resample(frame(spark, []), none).collect() == []
    got = resample(frame(spark, [(1, "a b", "s"), (2, None, "s")]), none).collect()
    assert sorted((r.doc_id, r.n_features, r.rank) for r in got) == [(1, 3, None), (2, 0, None)]


def test_grams():
    rng = random.Random(3)
    texts = [None, "", "A b-C", "x" * 200 + " y " + "x" * 200, "é ß 你好", *(prose(rng, rng.randrange(1, 90)) for _ in range(40))]
    data, row, start, length, n = grams(*buffers(pa.array(texts)))
    found = defaultdict(list)
    for r, a, size in zip(row, start, length, strict=True):
        found[int(r)].append(bytes(data[a : a + size]).decode())
    assert all(sorted(found[k]) == sorted(features(t)[1]) and n[k] == len(features(t)[0]) for k, t in enumerate(texts))
    assert [int(h) for h in xxh64(data, start, length)] == [xxhash.xxh64_intdigest(bytes(data[a : a + size])) for a, size in zip(start, length, strict=True)]
    count = Counter(x for v in found.values() for x in v)
    # Also with keys that collide: bytes decide.
    for hashed in (xxh64, lambda data, start, length: np.zeros(len(start), np.uint64), lambda data, start, length: (length % 3).astype(np.uint64)):
        t = Grams(data, start, length, hashed)
        for k, (a, size) in enumerate(zip(start, length, strict=True)):
            g = bytes(data[a : a + size])
            assert t.count[t.slot[k]] == count[g.decode()] and t.bucket[t.slot[k]] == zlib.crc32(g) % BUCKETS
        assert len(t.used) == len(count)


def four_word_set(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def copies_by_hand(rows):
    held = defaultdict(set)
    for i, t, _ in rows:
        if i is not None:
            held[i].add(four_word_set(t))
    root = {i: i for i in held}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(held, 2):
        if any(s and t and 100 * len(s & t) >= 80 * len(s | t) for s, t in itertools.product(held[a], held[b])):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in held}


def checked_copies(spark, rows, tmp_path):
    got = near_copies(table(spark, rows, tmp_path)).collect()
    want = copies_by_hand(rows)
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.kept) for r in got) == sorted(
        (repr(i), len(four_word_set(t)), repr(None if i is None else want[i]), i is None or want[i] == i) for i, t, _ in rows
    )
    return want


@pytest.mark.parametrize("seed", [1, 2])
def test_copies(spark, tmp_path, seed):
    checked_copies(spark, awkward(seed), tmp_path)
    assert near_copies(frame(spark, [])).collect() == []


def test_copies_in_hot_buckets(spark, tmp_path):
    """Many near copies on either side of the bound, a passage in many texts, and a chain in which only neighbours are similar."""
    rng = random.Random(4)
    base = prose(rng, 150).split(" ")
    rows = []
    for i in range(120):
        w = list(base)
        for k in rng.sample(range(150), rng.randrange(1, 9)):
            w[k] = f"own{i}x{k}"
        rows.append((1000 - i, " ".join(w), "s"))
    passage = prose(rng, 60)
    rows += [(2000 + k, f"{prose(rng, rng.randrange(1, 14))} {passage}", "s") for k in range(60)]
    chain = prose(rng, 260).split(" ")
    rows += [(3100 - k, " ".join(chain[6 * k : 6 * k + 100]), "s") for k in range(20)]
    want = checked_copies(spark, rows, tmp_path)
    assert want[3100] == 3081 and len({want[i] for i in range(881, 1001)}) > 2


def test_signature():
    """Coordinates agree as often as sets do, and each is the least under the second permutation turned by its number."""
    rng = np.random.default_rng(5)
    pool = mix(rng.integers(0, 1 << 62, 1000).astype(np.uint64))
    one, two = np.sort(pool[:900]), np.sort(pool[100:])
    s = signature(np.repeat([0, 1], [900, 900]), np.concatenate([one, two]), 400)
    assert abs((s[:, 0] == s[:, 1]).mean() - 0.8) < 0.06
    assert (signature(np.zeros(900, int), one[::-1].copy(), 400)[:, 0] == s[:, 0]).all()
    keys = band_keys(s[: BANDS * WIDTH], BANDS, WIDTH)
    same = (s[: BANDS * WIDTH, 0] == s[: BANDS * WIDTH, 1]).reshape(BANDS, WIDTH).all(1)
    assert ((keys[0] == keys[1]) == same).all() and len(set(keys[0].tolist())) == BANDS
