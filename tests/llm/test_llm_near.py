"""Line dedup, n-gram Jaccard join, decontamination and suffix-array dedup against brute force."""

import hashlib
import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import awkward, frame, prose, shingle_set, table, words

from logforge.llm.common import components
from logforge.llm.decontam import find_leaks, smith_waterman
from logforge.llm.jaccard_join import PERCENT, SIZE, near_duplicates, shared_counts
from logforge.llm.line_dedup import drop_repeated_lines, repeated_lines
from logforge.llm.suffix_dedup import common_prefix, merge, ranks, repeated_bytes


def within_one(a, b):
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def lines_by_hand(rows):
    docs = sorted({(i is None, i or 0, t) for i, t, _ in rows if t is not None}, key=lambda r: r[:2])
    seen, out = [], defaultdict(set)
    for none, i, text in docs:
        for n, line in enumerate(text.split("\n")):
            w = words(line)
            if len(w) < 3:
                continue
            earlier = [p for p, v in seen if v == w or (min(len(v), len(w)) >= 8 and within_one(v, w))]
            if earlier:
                out[None if none else i, text].add((n, *min(earlier)[1:]))
            seen.append(((none, None if none else i, n), w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_lines(spark, tmp_path, seed):
    # Rows of one id with different texts are ordered by a hash; the rule for them is tested elsewhere.
    rows = [r for r in awkward(seed) if r[0] != 91]
    docs = table(spark, rows, tmp_path)
    got = repeated_lines(docs).collect()
    want = lines_by_hand(rows)
    texts = defaultdict(set)
    for i, t, _ in rows:
        texts[i].add(t)
    found = {}
    for r in got:
        text = next(iter(texts[r.doc_id] - {None})) if r.n_lines else None
        found[r.doc_id, text] = {(x.line_no, x.doc_id, x.line) for x in r.removed}
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in want.items() if v}
    assert len(got) == len({(i, t) for i, t, _ in rows})
    after = drop_repeated_lines(docs)
    assert after.columns == docs.columns and after.count() == len(rows)
    for r in after.select("doc_id", "text", "_gone").collect():
        before = [t for t in texts[r.doc_id] if (t is None) == (r.text is None)]
        assert r._gone == 8 and len(before) == 1
        if r.text is not None:
            gone = {n for n, *_ in want.get((r.doc_id, before[0]), ())}
            assert r.text == "\n".join(x for n, x in enumerate(before[0].split("\n")) if n not in gone)


def test_lines_of_one_id_and_empty_table(spark, tmp_path):
    rows = [(1, "a b c\nx y z", "s"), (1, "x y z\nq", "s"), (1, "x y z\nq", "s")]
    got = repeated_lines(table(spark, rows, tmp_path)).collect()
    assert len(got) == 2 and sum(len(r.removed) for r in got) == 1
    assert repeated_lines(frame(spark, [])).collect() == [] and drop_repeated_lines(frame(spark, [])).count() == 0


def groups_by_hand(rows):
    sets = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            sets[i].append(shingle_set(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        for s, t in itertools.product(sets[a], sets[b]):
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard(spark, tmp_path, seed):
    rows = awkward(seed)
    got = near_duplicates(table(spark, rows, tmp_path)).collect()
    want = groups_by_hand(rows)
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == sorted(
        (repr(i), len(shingle_set(t)), repr(None if i is None else want[i])) for i, t, _ in rows
    )
    assert all((r.n_links > 0) == (len([x for x in want.values() if x == want[r.doc_id]]) > 1) for r in got if r.doc_id is not None)


def test_jaccard_chain_and_hot_passage(spark, tmp_path):
    """A chain of texts of which only neighbours are similar, beside many texts that share a passage."""
    rng = random.Random(5)
    chain = prose(rng, 260).split(" ")
    rows = [(100 - k, " ".join(chain[8 * k : 8 * k + 100]), "s") for k in range(20)]
    passage = prose(rng, 60)
    rows += [(200 + k, f"{prose(rng, 60)} {passage} {prose(rng, 60)}", "s") for k in range(60)]
    rows += [(300 + k, passage + f" {k} end", "s") for k in range(30)]
    got = {r.doc_id: r.component_id for r in near_duplicates(table(spark, rows, tmp_path)).collect()}
    assert got == groups_by_hand(rows) and got[100] == 81


def test_jaccard_links_headed_by_others(spark, tmp_path):
    """All that two similar texts share is headed by long texts that are similar to neither."""
    rng = random.Random(1)
    own = lambda k: " ".join(f"own{rng.randrange(10**9)}" for _ in range(k))
    rows = []
    for g, size in enumerate((44, 54, 64)):
        x, y = own(size), own(size)
        rows += [(10 * g + k, f"{x} {own(1)} {y} {own(7)}", "s") for k in (1, 2)]
        for k, piece in enumerate((x, y)):
            long = own(300)
            rows.append((500 + 10 * g + k, f"{piece} {long}", "s"))
            rows += [(600 + 100 * g + 10 * k + j, f"{long} {own(60)}", "s") for j in range(6)]
    got = {r.doc_id: r.component_id for r in near_duplicates(table(spark, rows, tmp_path)).collect()}
    assert got == groups_by_hand(rows) and [got[k] for k in (2, 12, 22)] == [1, 11, 21]


def test_jaccard_equal_blocks(spark, tmp_path):
    """Two partitions of the same rows lose none, and share all their shingles."""
    frame(spark, [r for r in awkward(2) if r[0] is not None]).coalesce(1).write.parquet(str(tmp_path / "one"))
    docs = spark.read.parquet(str(tmp_path / "one"))
    got = [tuple(r) for r in shared_counts(docs.union(docs), SIZE, PERCENT).collect()]
    sizes = [(r.doc_id, len(shingle_set(r.text))) for r in docs.collect()]
    assert sorted(got) == sorted(2 * [(i, n, min(n, n - -(-PERCENT * n // 100) + n // 8 + 1)) for i, n in sizes])


def test_jaccard_empty(spark, tmp_path):
    assert near_duplicates(table(spark, [], tmp_path)).collect() == []
    assert [tuple(r) for r in near_duplicates(table(spark, [(None, "a b", "s"), (3, None, "s")], tmp_path, "two")).orderBy("doc_id").collect()] == [
        (None, 1, 0, None), (3, 0, 0, 3)
    ]


def test_components(spark, tmp_path):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(30)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "c")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {k: v for k, v in root.items() if any(k in e and e[0] != e[1] for e in edges)}


def align_by_hand(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -0.5), h[i - 1, j] - 0.5, h[i, j - 1] - 0.5)
    return h.max()


def test_alignment():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = (rng.integers(1, 5, n).astype(np.uint64) for n in (12, 30))
        assert smith_waterman(a, b[None])[0][0] == pytest.approx(align_by_hand(a, b))


def test_leaks(spark, tmp_path):
    rng = random.Random(40)
    items = [(k, prose(rng, 30)) for k in range(12)]
    rows = list(awkward(4))
    edited = items[1][1].split(" ")
    for k in range(0, 30, 5):
        edited[k] = "swapped"
    part = " ".join(items[2][1].split(" ")[:8])
    rows += [(500, f"{prose(rng, 50)} {items[0][1]} {prose(rng, 40)}", "s"), (501, f"{prose(rng, 9)}\n{' '.join(edited)}", "s")]
    rows += [(502, f"{prose(rng, 40)} {part} {prose(rng, 40)}", "s"), (503, " ".join(w for _, w in items), "s"), (503, items[0][1], "s"), (None, items[3][1].upper(), "s")]
    bench = [*items, (90, None), (91, ""), (92, "too short"), (93, items[4][1]), (None, items[0][1])]
    got = find_leaks(table(spark, rows, tmp_path), spark.createDataFrame(bench, "item_id long, text string")).collect()
    want = {(500, 0), (501, 1), (None, 3), *((503, k) for k in range(12)), (503, 93)}
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    scores = {(r.doc_id, r.item_id): r.score for r in got}
    assert scores[500, 0] == 1.0 and 0.5 < scores[501, 1] < 1
    assert next(r.end_word for r in got if r.doc_id == 500) == 80
    assert find_leaks(frame(spark, []), spark.createDataFrame(bench, "item_id long, text string")).collect() == []
    assert find_leaks(frame(spark, rows), spark.createDataFrame([], "item_id long, text string")).collect() == []


def test_leaks_of_common_grams(spark, tmp_path):
    """An edited copy is found however often the corpus has the words that it kept."""
    rng = random.Random(41)
    item = prose(rng, 15).split(" ")
    edited = " ".join([*item[:10], *("swapped" for _ in item[10:])])
    # What the copy kept is common, what it changed is rare.
    rows = [(k, f"{' '.join(item[:4])} {k} {' '.join(item[3:7])} {k} {' '.join(item[6:10])}", "s") for k in range(1100)]
    piece = [(2000 + k, f"{k} {' '.join(item[k : k + 3])} {prose(rng, 30)}", "s") for k in range(8) for _ in range(1100)]
    rows += [*piece, (5000, f"{prose(rng, 20)} {edited} {prose(rng, 20)}", "s"), (5001, f"{prose(rng, 20)} {' '.join(item)}", "s")]
    bench = [(7, " ".join(item))]
    got = {(r.doc_id, r.item_id): r.score for r in find_leaks(table(spark, rows, tmp_path), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    want = {(i, 7): align_by_hand(item, words(t)) / 15 for i, t in {i: t for i, t, _ in rows if i >= 5000}.items()}
    assert {k: v for k, v in got.items() if k[0] >= 5000} == pytest.approx(want)
    found = {i for i, t in {i: t for i, t, _ in rows}.items() if align_by_hand(item, words(t)) >= 7.5}
    assert {i for i, _ in got} == found


def bytes_by_hand(rows):
    seen = defaultdict(int)
    data = [(t or "").encode() for _, t, _ in rows]
    for d in data:
        for p in range(len(d) - 399):
            seen[d[p : p + 400]] += 1
    out = []
    for (i, _, _), d in zip(rows, data):
        hit = [False] * len(d)
        for p in range(len(d) - 399):
            if seen[d[p : p + 400]] > 1:
                hit[p : p + 400] = [True] * 400
        spans = sum(h and not (k and hit[k - 1]) for k, h in enumerate(hit))
        rest = bytes(x for x, h in zip(d, hit) if not h)
        out.append((repr(i), len(d), len(d) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_bytes(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [r for r in awkward(seed) if r[0] != 93]
    piece = prose(rng, 70)
    rows += [(600 + k, prose(rng, 30) + piece[k : 399 + 2 * k] + prose(rng, 30), "s") for k in range(6)]
    rows += [(700, "z" * 1000, "s"), (701, piece + piece, "s"), (702, "\0" * 450, "s"), (703, "\0" * 399 + "a", "s"), (704, "ü" * 250 + piece[:300], "s")]
    got = repeated_bytes(table(spark, rows, tmp_path)).drop("spans").collect()
    assert sorted((repr(r[0]), *r[1:]) for r in got) == bytes_by_hand(rows)


def test_repeated_bytes_empty(spark, tmp_path):
    assert repeated_bytes(table(spark, [], tmp_path)).collect() == []


def test_suffix_order():
    rng = np.random.default_rng(1)
    strings = rng.integers(97, 100, (300, 40)).astype(np.uint8)
    strings[50:80] = strings[20:50]
    strings[60:80, 30:] = 97
    rows = [s.tobytes() for s in strings]
    rank = ranks(strings)
    assert all((rank[a] < rank[b]) == (rows[a] < rows[b]) and (rank[a] == rank[b]) == (rows[a] == rows[b]) for a in range(300) for b in range(0, 300, 7))
    order = np.argsort(rank, kind="stable")
    prefix = common_prefix(strings[order])
    for k in range(1, 300):
        a, b = rows[order[k - 1]], rows[order[k]]
        assert prefix[k] == next((i for i in range(40) if a[i] != b[i]), 40)
    words_ = strings.view(">u8").astype(np.uint64)
    one, two = (np.array(sorted(range(a, b), key=rows.__getitem__)) for a, b in ((0, 200), (200, 300)))
    assert [rows[k] for k in merge(words_, one, two)] == sorted(rows)
