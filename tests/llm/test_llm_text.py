"""Toxicity, quality rules, licence scan, URL filter and LM scoring."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_cases import LOWER, awkward, frame, prose, table, words

from logforge.llm.license_scan import PHRASES, Scanner, SuffixAutomaton, scan_licenses, tokens
from logforge.llm import lm_score
from logforge.llm.lm_score import score_texts
from logforge.llm.mixing_model import (
    AT_ONCE, BINS, CELLS, EARLY, FREQUENT, GATES, HOLD, STATE_CONTEXTS, TURN, Code, Layer, Vocabulary, as_inputs, cells, hashed_slot, with_ends, word_stream,
)
from logforge.llm.oracle import ORACLE
from logforge.llm.quality_rules import apply_rules, cover, text_stats
from logforge.llm.toxicity import Finder, Lexicon, edits, score_toxicity
from logforge.llm.url_filter import GlobSet, filter_urls
from logforge.llm.words import buffers, chunks, shingles, tokenize


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lexicon_against_distances():
    rng = random.Random(3)
    terms = ["stupid", "idiot", "disgusting", "scum", "abab", "ababab"]
    automaton = Lexicon(terms)
    for _ in range(3000):
        word = rng.choice(terms)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            word = rng.choice((word[:at] + rng.choice("abist") + word[at:], word[:at] + word[at + 1 :], word[:at] + rng.choice("abist") + word[at + 1 :]))
        near = [(d, k) for k, t in enumerate(terms) if (d := edit_distance(word, t)) <= edits(t)]
        assert automaton.match(word) == (min(near)[::-1] if near else None), word


def test_quotation():
    finder = Finder(["idiot"])
    find = lambda text: [(d, q) for _, d, q in finder.hits(text)[0]]
    assert find("you idiot go away") == [(0, False)]
    assert find("you idiott go away") == [(1, False)]
    assert find('they shouted "you idiot" at the crowd') == [(0, True)]
    assert find("she called idiot a bad term") == [(0, True)]
    assert find("") == [] and finder.hits("")[1] == 0


def toxic_rows(rng, n=400):
    rows, labels = [], []
    for i in range(n):
        text = prose(rng, rng.randrange(5, 80)).split(" ")
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(("grumbleface", "nastykins", "vilething")))
        rows.append((i, " ".join(text), "s"))
        labels.append((i, 1, int(toxic), "x"))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int, text string"


def test_toxicity(spark, tmp_path):
    rng = random.Random(8)
    rows, labels = toxic_rows(rng)
    extra = [(1000, "what a nastykin you are, vilethings", "s"), (1001, None, "s"), (1002, "", "s"), (None, "grumbleface", "s"), (1000, "calm words", "s")]
    docs = table(spark, rows + extra, tmp_path)
    marks = spark.createDataFrame([*labels, (5, None, 1, None), (None, 1, 1, None), (7, 1, None, None), (9999, 0, 1, None)], LABELS)
    got = score_toxicity(docs, marks).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    known = {i: t for i, _, t, _ in labels}
    wrong = [r.doc_id for r in got if r.doc_id in known and known[r.doc_id] != r.predicted and r.doc_id != 5]
    assert len(wrong) <= 4
    assert sorted(r.predicted for r in got if r.doc_id == 1000) == [0, 1]
    assert all(r.predicted == 0 for r in got if r.doc_id in (1001, 1002)) and [r.predicted for r in got if r.doc_id is None] == [1]
    again = score_toxicity(docs, marks, keep=("doc_id", "word"), carry_text=True)
    assert again.columns == ["doc_id", "word", "text", "score", "predicted", "matches"]
    # Labels of held-out rows teach nothing.
    flipped = marks.selectExpr("doc_id", "quality", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 1 - toxic, toxic) AS toxic", "text")
    assert sorted(map(repr, score_toxicity(docs, flipped).collect())) == sorted(map(repr, got))
    none = score_toxicity(docs, marks.limit(0)).collect()
    assert len(none) == len(got) and not any(r.predicted for r in none)
    assert score_toxicity(frame(spark, []), marks).collect() == []


def stats_by_hand(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    hit = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_text_stats(spark, tmp_path):
    rows = [*awkward(3), (800, "a b c d e a b c d e f", "s"), (801, "x | # <p>\n\nx | # <p>\n  \n  ", "s"), (802, "q " * 9 + "q", "s")]
    got = text_stats(table(spark, rows, tmp_path)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(repr((r.doc_id, *(r[n] for n in names))) for r in got) == sorted(repr((i, *stats_by_hand(t))) for i, t, _ in rows)


def test_cover():
    cells = [((b, c), bad, 30 - bad, bad // 2, (30 - bad) // 2) for b, c in itertools.product(range(4), range(4)) for bad in ((28 if b >= 2 and c < 1 else 1),)]
    rules = cover(cells, [4, 4])
    assert len(rules) == 1 and all(all(t.holds((b, 0)) for t in rules[0]) == (b >= 2) for b in range(4)) and not any(t.holds((3, 3)) for t in rules[0][-1:] if t.feature)
    assert cover([], [4, 4]) == []


def test_quality_rules(spark, tmp_path):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        w = prose(rng, rng.randrange(20, 90)).split(" ")
        bad = i % 6 == 0
        if bad:
            w = [x + "%%%" for x in w]
        rows.append((i, " ".join(w), "s"))
        labels.append((i, int(not bad), 0, "x"))
    rows += [(900, None, "s"), (901, "", "s"), (902, "a b c d e " * 10, "s"), (None, rows[1][1], "s"), (1, rows[1][1], "s")]
    marks = spark.createDataFrame([*labels, (None, 0, 0, ""), (3, None, 0, "")], LABELS)
    docs = table(spark, rows, tmp_path)
    got = apply_rules(docs, marks)
    names = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert all(names[i].kept == bool(q) for i, q, _, _ in labels) and not any(names[i].kept for i in (900, 901, 902)) and names[None].kept
    assert all((r.rule is None) == (r.kept or r.base_failed) or r.rule is not None for r in names.values())
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    without = apply_rules(docs, marks.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in without)
    assert apply_rules(frame(spark, []), marks).collect() == []


def test_suffix_automaton():
    rng = random.Random(2)
    texts = [[rng.choice("abc") for _ in range(rng.randrange(1, 15))] for _ in range(6)]
    automaton = SuffixAutomaton(texts)
    joined = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for _ in range(100):
        text = [rng.choice("abcd") for _ in range(25)]
        longest = [max((n for n in range(e + 1) if tuple(text[e - n : e]) in joined), default=0) for e in range(1, 26)]
        want = [(e, n) for e, n in enumerate(longest, 1) if n >= 2 and (e == 25 or longest[e] <= n)]
        runs = automaton.runs(text, 2)
        assert [(e, n) for e, n, _ in runs] == want
        for e, n, state in runs:
            ends = {(k, i + n) for k, t in enumerate(texts) for i in range(len(t) - n + 1) if t[i : i + n] == text[e - n : e]}
            assert set(automaton.ends[state]) == ends


def test_licenses(spark, tmp_path):
    rows = [
        *awkward(7), (800, "Text here. Licensed under the Apache License, Version 2.0. More", "s"), (801, "CC BY 4.0 and ALL rights\nreserved. all rights reserved", "s"),
        (802, "the GNU General Public License", "s"), (803, "permission is hereby granted free of charge to any person or two obtaining a copy of this software and associated documentation files", "s"),
        (804, "the license under the version", "s"),
    ]
    docs = table(spark, rows, tmp_path)
    got = {(r.doc_id, r.n_words): r for r in scan_licenses(docs).collect()}
    for i, t, _ in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        places = [(k, label) for phrase, label in PHRASES for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        r = got[i, len(w)]
        assert r.n_base == len(places) and (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) <= {*r.labels.split(","), ""}
        assert 0 <= r.score <= 1
    by = {i: r for (i, _), r in got.items()}
    assert by[800].labels == "apache-2.0" and by[801].labels == "cc-by,reserved" and by[802].base_labels == "gpl"
    assert by[803].labels == "mit" and by[803].spans[0].end - by[803].spans[0].start == 22 and by[804].labels == "" and by[1].score == 0
    assert scan_licenses(frame(spark, [])).collect() == [] and scan_licenses(docs, keep=("doc_id", "word")).columns[:2] == ["doc_id", "word"]
    assert Scanner((), 3, 0.8, 8).spans(tokens("a b c")) == []


def test_globs():
    rng = random.Random(1)
    globs = ["".join(rng.choice(("a", "b", "/", "*", "**", "?")) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    texts = ["".join(rng.choice("ab/") for _ in range(rng.randrange(0, 30))) for _ in range(200)]
    hit = GlobSet(globs).match(*buffers(pa.array(texts)))
    for k, glob in enumerate(globs):
        pattern = "".join({"**": ".*", "*": "[^/]*", "?": "."}.get(x, re.escape(x)) for x in re.findall(r"\*\*|.", glob))
        assert [bool(re.fullmatch(pattern, t)) for t in texts] == list(hit[:, k]), glob


def test_urls_against_sql(spark, tmp_path):
    urls = [
        None, "", "x", "://", "http://", "http://NET/a", "http://a.net", "http://a.net/", "https://Example.net/en/x?q=a.net/", "http://notexample.net/en/1", "ftp://a.example.com/de/#t",
        "http://example.com/den", "http://www.org/fr/1", "http://www.org/fr", "http://h.org?x/fr/", "a://b://c.net/d", "http://x.casino-win.org/en/1", "http://best-bets.info/a", "http://a.info/login",
        "http://a.info/b/setup.exe", "http://Ünicode.net/\n", "http://a.net/" + "y" * 3000, "http://a.net/", "http://sub.net.evil.com/x",
    ]
    pages = spark.createDataFrame([(i, u, "t") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = filter_urls(pages).drop("globs")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(urls)))
    want = con.execute(ORACLE["op7_url_filter"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert filter_urls(pages.limit(0)).collect() == []


def test_words():
    texts = [None, "", "A bc\td", " x ", "É y", "", "one two three four five six seven"]
    column = pa.array(texts)
    for most in (1, 7, 100):
        out = []
        for at, end, data, offsets in chunks(column, most):
            w = tokenize(data, offsets)
            out += [[bytes(data[a:b]).lower() for a, b in zip(w.start[w.first[r] : w.first[r + 1]], w.end[w.first[r] : w.first[r + 1]])] for r in range(end - at)]
        assert out == [[x.encode() for x in words((t or "").translate(LOWER))] for t in texts]
    w = tokenize(*buffers(pa.array(["a b c d e f", "b c d e f", "A B C D", "a b c d e f"])))
    row, _, h = shingles(w, 5, short=True)
    by = [sorted(h[row == k]) for k in range(4)]
    assert by[0] == by[3] and len(by[0]) == 2 and by[1][0] in by[0] and len(by[2]) == 1 and by[2][0] not in by[0]


def test_code_is_a_probability():
    """Chances of all leaves sum to 1 whatever the mixer's weights are."""
    counts = np.array([50, 20, 9, 9, 3, 1, 1, 0])
    code = Code(counts)
    assert np.sum(0.5**code.length) == 1 and code.length[0] == code.length.min()
    rng = np.random.default_rng(1)
    vocabulary = Vocabulary(np.arange(1, 8, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), counts[:-1], 0)
    layer = Layer(code, 6, [as_inputs(code.node_counts(counts)), *(as_inputs(rng.integers(0, 9, 128)) for _ in range(2))])
    layer.weights = rng.normal(0.4, 0.3, layer.weights.shape)
    one = word_stream(vocabulary, np.array([vocabulary.hashes[0]] * 8), np.arange(8))
    one.leaf = np.arange(8, dtype=np.int32)
    assert np.sum(10 ** layer.log10(one, 8)) == pytest.approx(1, abs=1e-4)


def test_lm_score(spark, tmp_path):
    rows = awkward(9)
    docs = table(spark, rows, tmp_path)
    got = score_texts(docs).collect()
    part = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _, _ in rows}
    count = Counter()
    for i, t, _ in rows:
        if i is not None and not part[i]:
            count.update([*words((t or "").translate(LOWER)), None])
    total, kinds = sum(count.values()), len(count)
    want = []
    for i, t, _ in rows:
        w = [*words((t or "").translate(LOWER)), None]
        want.append((repr(i), part[i], len(w), sum(count[x] > 0 for x in w), total, round(sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w), 6)))
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score < 0 for r in got)
    again = {(r.doc_id, r.n_tokens, r.base_score): r.score for r in score_texts(docs).collect()}
    assert all(again[r.doc_id, r.n_tokens, r.base_score] == r.score for r in got)


def test_lm_equal_blocks(spark, tmp_path):
    """Two partitions of the same rows are scored as one partition that holds them twice."""
    one = frame(spark, awkward(9)).coalesce(1)
    one.write.parquet(str(tmp_path / "one"))
    docs = spark.read.parquet(str(tmp_path / "one"))
    docs.union(docs).coalesce(1).write.parquet(str(tmp_path / "both"))
    found = lambda rows: sorted((repr(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows)
    got = score_texts(docs.union(docs)).collect()
    assert found(got) == found(score_texts(spark.read.parquet(str(tmp_path / "both"))).collect())
    times = Counter((r.doc_id, r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)
    assert all(n % 2 == 0 for n in times.values())


def test_lm_learns(spark, tmp_path):
    """On held-out texts of a source with order in it, the model beats word counts."""
    rng = random.Random(2)
    kinds = [[prose(rng, 1) for _ in range(60)] for _ in range(3)]
    rows = [(i, " ".join(rng.choice(kinds[i % 3]) for _ in range(300)), "s") for i in range(300)]
    held = [r for r in score_texts(table(spark, rows, tmp_path)).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.97


@pytest.mark.parametrize("leaves", [30, 1 << 16])
def test_lm_fits_on_every_training_text(spark, tmp_path, monkeypatch, leaves):
    """Weights and refinement see each step of each training text, long and repeated ones too, predicted from all other steps."""
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(1, 30)), "s") for i in range(700)]
    rows += [(1000, prose(rng, 4000), "s"), (1001, prose(rng, 4000), "s"), (3, rows[3][1], "s"), (1003, None, "s"), (1004, "É x É", "s"), (None, "no id", "s")]
    assert len(rows[700][1]) > 20_000
    fits, kept = [], []
    monkeypatch.setattr(lm_score, "LEAVES", leaves)
    monkeypatch.setattr(lm_score, "Vocabulary", lambda *a: kept.append(Vocabulary(*a)) or kept[-1])
    monkeypatch.setattr(Layer, "fit", lambda layer, counts: fits.append((layer, counts)))
    score_texts(table(spark, rows, tmp_path)).collect()
    (vocabulary,), (layer, counts) = kept, fits[0]
    code, size = layer.code, 1 << lm_score.WORD_BITS
    steps, rare = [], Counter()
    for i, t, _ in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 == 2:
            continue
        w = [x.encode() for x in words((t or "").translate(LOWER))]
        h, row, number = with_ends(tokenize(*buffers(pa.array([t], pa.string()))))
        before = [0, 0]
        for k, leaf in enumerate(vocabulary.ids(h).tolist()):
            if leaf == vocabulary.escape and k < len(w):
                rare[w[k] + b" "] += 1
            for at in range(code.first[leaf], code.first[leaf] + code.length[leaf]):
                steps.append((code.node[at], before[0] * (FREQUENT + 1) + before[1], code.bit[at]))
            if leaf < FREQUENT:
                before = [leaf + 1, before[0]]
    node, state, bit = (np.array(x) for x in zip(*steps, strict=True))
    node = node.astype(np.uint32)
    slots = [node, *(hashed_slot(c[state], node, lm_score.WORD_BITS) for c in STATE_CONTEXTS)]
    tables = [np.bincount(s.astype(np.int64) * 2 + bit, minlength=2 * size).astype(np.float32) for s in slots]
    for k in (1, 2):
        assert np.array_equal(as_inputs(tables[k]), layer.inputs[k])
    want = np.bincount(cells(tables, slots, bit, np.ones(len(bit), np.float32)), minlength=2 * CELLS)
    assert counts.sum() == len(steps) and np.array_equal(want, counts)
    assert len(fits) == 1 + bool(rare) and (rare or leaves > 30)  # a few words find no slot and are rare ones
    if rare:
        spelling, counts = fits[1]
        letters = np.zeros(256, np.int64)
        for word, n in rare.items():
            np.add.at(letters, list(word), n)
        assert np.array_equal(spelling.code.length, Code(letters).length)
        assert counts.sum() == sum(int(spelling.code.length[list(word)].sum()) for word in rare)


def test_lm_texts_learn_on_their_own():
    """Weights and map go on learning through each text, as in a bit-by-bit statement, and no text's score depends on others."""
    rng = np.random.default_rng(6)
    counts = np.array([90, 60, 40, 20, 9, 9, 3, 1, 1, 1])
    code, bits = Code(counts), 6
    vocabulary = Vocabulary(np.arange(1, 10, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), counts[:-1], 1)
    layer = Layer(code, bits, [as_inputs(code.node_counts(counts)), *(as_inputs(rng.integers(0, 60, 128)) for _ in range(2))], rate=0.4)
    layer.weights = rng.normal(0.4, 0.2, layer.weights.shape)
    layer.refine = rng.uniform(0.05, 0.95, (GATES, BINS)).astype(np.float32)
    texts = [rng.integers(0, 2 if k % 3 else 9, n) for k, n in enumerate([1, EARLY[0], EARLY[0] + 1, TURN, TURN + 1, 3 * TURN, 0, *rng.integers(1, 9 * TURN, 60), 2 * AT_ONCE])]
    stream = lambda some: word_stream(vocabulary, np.concatenate([vocabulary.hashes[t] for t in some]), np.repeat(np.arange(len(some)), [len(t) for t in some]))
    got = layer.log10(stream(texts), len(texts))
    assert np.array_equal(got, [layer.log10(stream([t]), 1)[0] for t in texts])
    for text, score in list(zip(texts, got, strict=True))[:20]:
        one = stream([text])
        weights, chances, cost = layer.weights.copy(), layer.refine.astype(float).ravel(), 0.0
        ends = sorted({*EARLY, *range(TURN, len(text) + TURN, TURN)})
        for begin, end in zip([0, *ends], ends):
            had = []
            for k in range(begin, min(end, len(text))):
                leaf = one.leaf[k]
                for at in range(code.first[leaf], code.first[leaf] + code.length[leaf]):
                    node, bit = code.node[at : at + 1], int(code.bit[at])
                    raw = [int(t[node[0] if c is None else hashed_slot(c[k : k + 1], node, bits)[0]]) for t, c in zip(layer.inputs, one.contexts, strict=True)]
                    odds = np.array([*((r >> 2) / 1024 - 8 for r in raw), 1.0])
                    gate = (raw[1] & 3) * 4 + (raw[2] & 3)
                    z = min(max(weights[gate] @ odds, -11), 11)
                    p = 1 / (1 + math.exp(-z))
                    cell = gate * BINS + int(min(max((z + 8) * BINS / 16, 0), BINS - 1))
                    q = (p + chances[cell]) / 2
                    cost += math.log10(q if bit else 1 - q)
                    had.append((gate, cell, odds, bit, bit - p))
            for gate in {h[0] for h in had}:
                some = [h for h in had if h[0] == gate]
                weights[gate] += layer.rate / (len(some) + 64) * sum(h[4] * h[2] for h in some)
            for cell in {h[1] for h in had}:
                some = [h[3] for h in had if h[1] == cell]
                chances[cell] += (sum(some) - len(some) * chances[cell]) / (len(some) + HOLD)
        assert score == pytest.approx(cost, rel=1e-4, abs=1e-6)


def test_lm_spells_every_rare_word(spark, tmp_path, monkeypatch):
    """A rare word's chance is its count and its spelling's share, whether a training text holds it or not."""
    rows = awkward(9) + [(i, f"own{i * i}é Own{i * i}é the{i}", "s") for i in range(200, 240)]
    kept, layers = [], []
    fit = Layer.fit
    monkeypatch.setattr(lm_score, "LEAVES", 30)
    monkeypatch.setattr(lm_score, "Vocabulary", lambda *a: kept.append(Vocabulary(*a)) or kept[-1])
    monkeypatch.setattr(Layer, "fit", lambda layer, counts: layers.append(layer) or fit(layer, counts))
    got = score_texts(table(spark, rows, tmp_path)).collect()
    (vocabulary,), (layer, byte_layer) = kept, layers
    found, count, spelled = [], Counter(), {}
    for i, t, _ in rows:
        data, offsets = buffers(pa.array([t], pa.string()))
        w = tokenize(data, offsets)
        h, row, number = with_ends(w)
        s = word_stream(vocabulary, h, row)
        out = np.flatnonzero(s.leaf == vocabulary.escape)
        spelled |= dict(zip(h[out].tolist(), byte_layer.log10(lm_score._spell(data, w, number[out], np.arange(len(out))), len(out)), strict=True))
        found.append((i, t, layer.log10(s, 1)[0], h[out].tolist()))
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(h[out].tolist())
    seen, kinds = sum(count.values()), len(count)
    assert kinds > 50 and any(x not in count for x in spelled)
    want = []
    for i, t, score, rare in found:
        score += sum(math.log10(count[x] + (kinds + 1) * 10 ** spelled[x]) - math.log10(seen + kinds + 1) for x in rare)
        size = len((t or "").encode())
        want.append((repr(i), size, pytest.approx(score, rel=1e-5), pytest.approx(-score * math.log2(10) / size, rel=1e-5) if size else None))
    by = lambda r: (r[0], r[1])
    assert sorted(((repr(r.doc_id), r.n_bytes, r.score, r.bits_per_byte) for r in got), key=by) == sorted(want, key=by)


def test_lm_cells():
    """A step's cell is that of the counts without it; odds are rounded to halves."""
    tables = [np.array(x, np.float32) for x in ([5, 3], [0, 1, 40, 2], [1, 0, 0, 9])]
    for slots, bit, less in itertools.product(itertools.product((0,), (0, 1), (0, 1)), (0, 1), (0, 1, 3)):
        gate = cell = 0
        for k, slot in enumerate(slots):
            n = tables[k][2 * slot : 2 * slot + 2].tolist()
            n[bit] = max(n[bit] - less, 0)
            if k:
                gate = gate * 4 + sum(sum(n) > x for x in (0, 3, 30))
            cell = cell * 33 + round(2 * math.log((n[1] + 0.3) / (n[0] + 0.3))) + 16
        got = cells(tables, [np.array([s], np.uint32) for s in slots], np.array([bit], np.uint8), np.array([less], np.float32))
        assert got.tolist() == [(gate * 33**3 + cell) * 2 + bit]


def test_lm_fit_finds_weights():
    """From counts of cells the fit finds the weights that made them; a gate without counts keeps its own."""
    code = Code(np.array([3, 2, 1]))
    layer = Layer(code, 4, [])
    at = np.stack(np.unravel_index(np.arange(33**3), (33,) * 3), 1) / 2 - 8
    want = np.array([0.7, -0.2, 0.5, 0.3])
    p = 1 / (1 + np.exp(-(at @ want[:3] + want[3])))
    counts = np.zeros((16, 33**3, 2))
    counts[5] = np.stack([1000 * (1 - p), 1000 * p], 1)
    layer.fit(counts.ravel())
    assert layer.weights[5] == pytest.approx(want, abs=1e-3)
    assert layer.weights[4].tolist() == [0.4, 0.4, 0.4, 0.0]
    assert np.all(np.diff(layer.refine[5]) > 0)


def test_lm_without_training(spark, tmp_path):
    rows = [(None, "a b", "s"), (None, None, "s")]
    got = score_texts(table(spark, rows, tmp_path)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert all(r.score < 0 for r in got)
    assert score_texts(table(spark, [], tmp_path, "none")).collect() == []
