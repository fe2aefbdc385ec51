"""URL filters: all glob rules at once in a multiword Shift-And automaton.

A rule is a glob over the canonical url, host then path.  ``*`` stands for any
run of bytes but ``/``, ``**`` for any run, ``?`` for one byte.  Rules are packed
one after another into 64-bit words; a step shifts all of them by one byte.  The
urls of a batch move through the automaton together, one byte of each at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import buffers

_U = np.uint64


class GlobSet:
    """Globs compiled to masks; ``match`` gives a row of booleans for each text."""

    def __init__(self, globs: list[str]):
        self.last: list[int] = []
        chars: list[tuple[int, int]] = []
        self.begin: list[int] = []
        loops: list[tuple[int, bool]] = []
        at = 0
        for glob in globs:
            self.begin.append(at)  # the state before the first byte
            text, i = glob.encode(), 0
            while i < len(text):
                if text[i : i + 1] == b"*":
                    wide = text[i + 1 : i + 2] == b"*"
                    loops.append((at, wide))
                    i += 1 + wide
                    continue
                at += 1
                chars.append((at, -1 if text[i : i + 1] == b"?" else text[i]))
                i += 1
            self.last.append(at)
            at += 1
        self.words = at // 64 + 1
        self.step = np.zeros((256, self.words), _U)
        self.stay = np.zeros((256, self.words), _U)
        self.start = np.zeros(self.words, _U)
        bit = lambda p: (p // 64, _U(1) << _U(p % 64))
        for p, c in chars:
            w, b = bit(p)
            if c < 0:
                self.step[:, w] |= b
            else:
                self.step[c, w] |= b
        for p, wide in loops:
            w, b = bit(p)
            keep = self.stay[ord("/"), w]
            self.stay[:, w] |= b
            if not wide:
                self.stay[ord("/"), w] = keep
        for p in self.begin:
            w, b = bit(p)
            self.start[w] |= b

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        state = np.tile(self.start, (rows, 1))
        left, base = -length[order], offsets[:-1][order]
        for j in range(int(length.max(initial=0))):
            live = int(np.searchsorted(left, -j, "left"))  # rows longer than j stand first
            c = data[base[:live] + j]
            d = state[:live]
            moved = d << _U(1)
            moved[:, 1:] |= d[:, :-1] >> _U(63)
            state[:live] = (moved & self.step[c]) | (d & self.stay[c])
        out = np.zeros((rows, len(self.last)), bool)
        for k, p in enumerate(self.last):
            out[order, k] = (state[:, p // 64] >> _U(p % 64)) & _U(1)
        return out


def rule_globs(rule: str) -> list[str]:
    """The globs of a host/path rule: its host and all subdomains, any path with its start."""
    return [f"{rule}**", f"*.{rule}**"]


# What the contract fixes: verdict and rule.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Where no rule speaks: hosts that sell, and paths that hold no page of text.
BLOCK_GLOBS = (
    "*casino*/**", "*-win.*/**", "*bets.*/**", "*-bets*/**", "*pills*/**", "*poker*/**", "*payday*/**", "*replica*/**",
    "**/login**", "**/wp-admin/**", "**/cgi-bin/**", "**.exe", "**.zip",
)


def host(url: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, upper.lower()), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(
    pages: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    block_globs: tuple[str, ...] = BLOCK_GLOBS,
    url: str = "url",
    keep: tuple[str, ...] = ("page_id",),
) -> DataFrame:
    """``keep`` columns, host, path, rule, verdict and the globs that matched.

    The longest fitting rule decides; without one, a url that any of
    ``block_globs`` fits is blocked and others are allowed.  A null url and one
    without ``://`` have empty host and path, fit no rule and are allowed.  One
    row out for each row in, in a single pass without shuffle.
    """
    globs = [g for _, r in rules for g in rule_globs(r)] + list(block_globs)
    weight = [len(r) for _, r in rules]
    names = pa.array([r for _, r in rules], pa.string())
    verdicts = np.array([v == "block" for v, _ in rules] + [False])
    chosen = pages.select(*keep, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    schema = T.StructType([*chosen.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType()), T.StructField("globs", T.ArrayType(T.StringType()))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = GlobSet(globs)
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 2048):
                batch = whole.slice(at, 2048)
                h, p = batch.column("host"), batch.column("path")
                data, offsets = buffers(pa.compute.binary_join_element_wise(h, p, ""))
                hit = automaton.match(data, offsets)
                n = len(rules)
                fits = hit[:, 0 : 2 * n : 2] | hit[:, 1 : 2 * n : 2]
                best = np.where(fits, weight, -1).argmax(1) if n else np.zeros(len(hit), int)
                ruled = fits.any(1)
                best = np.where(ruled, best, n)
                extra = hit[:, 2 * n :]
                blocked = np.where(ruled, verdicts[best], extra.any(1))
                rule = names.take(pa.array(best, mask=~ruled))
                verdict = pa.array(np.where(blocked, "block", "allow"), pa.string())
                matched = pa.array([[block_globs[k] for k in np.flatnonzero(r)] for r in extra], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict, matched], names=[f.name for f in schema])

    return chosen.mapInArrow(judge, schema)
