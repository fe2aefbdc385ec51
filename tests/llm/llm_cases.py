"""Rows that trouble operators, and brute-force helpers."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Extra columns have names that the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, h1 long, size int, n long, shared string, "
    "id string, sha int, first string, _gone int, _d int, _t int, bucket int, score string, word string"
)
EXTRA = (7, 3, 1, "x", "y", 5, "z", 8, 9, 10, 11, "s", "w")


def prose(rng, n):
    return " ".join(rng.choice(("ti", "er", "on", "sh", "ou")) + rng.choice(("the", "nd", "ha", "re", "wh")) + str(rng.randrange(40)) for _ in range(n))


def awkward(seed=1):
    """(doc_id, text, source): copies, near copies, shared passages, nulls, empty, blank, long and periodic texts, repeated rows."""
    rng = random.Random(seed)
    passage = prose(rng, 90)
    line = prose(rng, 12)
    rows = []
    for i in range(40):
        text = prose(rng, rng.randrange(1, 160))
        if i % 5 == 0:
            text = f"{text}\n{passage}\n{prose(rng, 20)}"
        if i % 3 == 0:
            text += f"\n{line}"
        rows.append((i, text, f"s{i % 4}"))
    base = rows[7][1] + " " + prose(rng, 150)
    rows.append((50, base, "hot"))
    for i in range(51, 66):
        words = base.split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "hot"))
    edited = line.split(" ")
    for i in range(70, 76):
        words = list(edited)
        words[i - 70] = "other"
        rows.append((i, " ".join(words), "hot"))
    rows.append((76, " ".join(edited[1:]), None))
    rows.append((77, "new " + line, None))
    rows += [(80, None, "s1"), (81, "", "s1"), (82, " \n\t\n ", None), (83, "one", "\U0001f600"), (84, "One", ""), (85, "a b c d", "s0")]
    rows += [(None, passage, "s2"), (None, None, None), (90, rows[3][1], "s3"), (90, rows[3][1], "s3"), (91, rows[4][1], "s3"), (91, "another text of that id", "s3")]
    rows.append((92, "ab " * 900, "s2"))
    rows.append((93, prose(rng, 6000), "s2"))
    rows.append((94, "é ß 你好 " * 120 + " nbsp x", "s2"))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *EXTRA) for i, t, s in rows], SCHEMA)


def table(spark, rows, tmp_path, name="documents"):
    path = str(tmp_path / f"{name}.parquet")
    frame(spark, rows).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def words(text):
    return WORD.findall(text or "")


def shingle_set(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
