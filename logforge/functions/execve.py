"""Command lines rebuilt from EXECVE argument fields, as built-in expressions.

``compat`` reproduces the unanchored search of the deployed parser, traps
included (an ``a2=41`` inside another value counts as an argument).  ``strict``
reads whole ``name=value`` tokens and joins arguments the kernel split into
chunks (``a1[0]=`` ``a1[1]=``).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from logforge.facts import TECHNIQUES
from logforge.functions.audit import is_execve, kv_tokens
from logforge.functions.text import SPACE, col, let, strip

# Argument field patterns.
QUOTED_ARG = r'a(\d+)="([^"]*)"'
HEX_ARG = r"a\d+=([0-9A-Fa-f]+)"
ARG_COUNT = r"argc=\d+"


def decode_hex(digits: Column) -> Column:
    """Hex digits to text; bad UTF-8 becomes U+FFFD.  Odd lengths give NULL."""
    text = F.make_valid_utf8(F.unhex(digits).cast("string"))
    return F.when(F.length(digits) % 2 == 0, text)


def _index(name: Column) -> list[Column]:
    # Numbers of any length compare like integers by (digit count, digits).
    digits = F.ltrim(name, F.lit("a0"))
    return [F.length(digits).alias("width"), digits.alias("digits")]


def _one_per_index(entries: Column) -> Column:
    """Sort by index and keep the first entry of each, comparing neighbours."""
    return let(
        F.sort_array(entries),
        lambda s: F.filter(
            s,
            lambda e, i: ~e["digits"].eqNullSafe(F.get(s, i - 1)["digits"]),
        ),
    )


def _compat_entries(line: Column, quoted_only: bool) -> Column:
    # The last quoted value of an index wins, hence the falling rank.
    quoted = F.transform(
        F.regexp_extract_all(line, F.lit(QUOTED_ARG), F.lit(0)),
        lambda t, i: F.struct(
            *_index(F.substring_index(t, "=", 1)),
            F.lit(0).alias("source"),
            (-i).alias("rank"),
            F.substring(
                t, F.instr(t, '"') + 1, F.length(t) - F.instr(t, '"') - 1
            ).alias("val"),
        ),
    )
    if quoted_only:
        return quoted
    # Hex values only fill indexes without a quoted one; the first wins.
    tokens = F.filter(
        F.regexp_extract_all(line, F.lit(HEX_ARG), F.lit(0)),
        lambda t: F.length(F.substring_index(t, "=", -1)) % 2 == 0,
    )
    hexed = F.transform(
        tokens,
        lambda t, i: F.struct(
            *_index(F.substring_index(t, "=", 1)),
            F.lit(1).alias("source"),
            i.alias("rank"),
            decode_hex(F.substring_index(t, "=", -1)).alias("val"),
        ),
    )
    return F.concat(quoted, hexed)


_STRICT_ARG = r"""(?:^|\s)(a\d+(?:\[\d+\])?=(?:"[^"]*"|\S*)|[\w-]+=(?:"[^"]*"|'[^']*'|\S*))"""


def _part(token: Column, rank: Column) -> Column:
    """Index, chunk and value of one argument token."""
    name = F.substring_index(token, "=", 1)
    raw = F.substring(token, F.instr(token, "=") + 1, F.length(token))
    chunk = F.coalesce(F.regexp_extract(name, r"\[(\d+)\]", 1).try_cast("int"), F.lit(0))
    value = (
        F.when(raw.startswith('"'), F.btrim(raw, F.lit('"')))
        .when(raw.rlike("^[0-9A-Fa-f]+$") & (F.length(raw) % 2 == 0), F.unhex(raw).cast("string"))
        .otherwise(raw)
    )
    return F.struct(
        *_index(F.substring_index(name, "[", 1)),
        chunk.alias("chunk"),
        rank.alias("rank"),
        value.alias("val"),
    )


def _strict_parts(line: Column) -> Column:
    """One entry per argument index and chunk, in their order, of whole tokens only."""
    tokens = F.filter(
        F.regexp_extract_all(line, F.lit(_STRICT_ARG), F.lit(1)),
        lambda t: t.rlike(r"^a\d+(\[\d+\])?="),
    )
    # Drop repeats of the same chunk.
    return let(
        F.sort_array(F.transform(tokens, _part)),
        lambda s: F.filter(
            s,
            lambda e, i: (i == 0)
            | ~e["digits"].eqNullSafe(F.get(s, i - 1)["digits"])
            | (e["chunk"] != F.get(s, i - 1)["chunk"]),
        ),
    )


def _strict_entries(line: Column) -> Column:
    """One entry per argument index, chunks joined."""
    # The parts are sorted, so the chunks of one index are one slice.
    return let(
        _strict_parts(line),
        lambda s: let(
            _starts(s), lambda at: F.transform(at, lambda b, j: _joined(s, at, b, j))
        ),
    )


_CHUNK_ARG = r"""(?:^|\s)(a\d+\[\d+\]=(?:"[^"]*"|\S*))"""


def argument_parts(line: Column | str, mode: str = "compat") -> Column:
    """ARRAY of (width, digits, chunk, val): the argument pieces that one record holds.

    A long argument comes in chunks, and a long command in several records;
    ``join_parts`` puts the pieces of an event together.  Values may end within
    a character.  NULL for lines that are no EXECVE.
    """
    line = col(line)
    if mode == "strict":
        parts = _strict_parts(line)
    elif mode == "compat":
        whole = F.transform(
            _one_per_index(_compat_entries(line, False)),
            lambda e: F.struct(e["width"].alias("width"), e["digits"].alias("digits"), F.lit(0).alias("chunk"), F.lit(0).alias("rank"), e["val"].alias("val")),
        )
        parts = F.concat(whole, F.transform(F.regexp_extract_all(line, F.lit(_CHUNK_ARG), F.lit(1)), _part))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    pieces = F.transform(parts, lambda e: F.struct(*[e[n].alias(n) for n in ("width", "digits", "chunk", "val")]))
    return F.when(is_execve(line), pieces)


def join_parts(parts: Column) -> Column:
    """Command of pieces that are unique by index and chunk: arguments in order, blanks between, none between chunks."""
    text = lambda s: F.transform(
        s,
        lambda e, i: F.concat(
            F.when((i == 0) | e["digits"].eqNullSafe(F.get(s, i - 1)["digits"]), F.lit("")).otherwise(F.lit(" ")), e["val"]
        ),
    )
    return let(F.sort_array(parts), lambda s: F.make_valid_utf8(F.array_join(text(s), "")))


def _starts(parts: Column) -> Column:
    """Positions where the argument index changes."""
    return F.array_compact(
        F.transform(
            parts,
            lambda e, i: F.when(~e["digits"].eqNullSafe(F.get(parts, i - 1)["digits"]), i),
        )
    )


def _joined(parts: Column, starts: Column, begin: Column, j: Column) -> Column:
    end = F.coalesce(F.get(starts, j + 1), F.size(parts))
    chunks = F.slice(parts, begin + 1, end - begin)
    return F.struct(
        F.make_valid_utf8(F.array_join(F.transform(chunks, lambda e: e["val"]), "")).alias("val")
    )


def args(line: Column | str, mode: str = "compat", quoted_only: bool = False) -> Column:
    """Argument values in numeric index order, gaps closed: ARRAY<STRING>."""
    line = col(line)
    if mode == "strict":
        entries = _strict_entries(line)
    elif mode == "compat":
        entries = _one_per_index(_compat_entries(line, quoted_only))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.transform(entries, lambda e: e["val"])


def command(line: Column | str, mode: str = "compat") -> Column:
    """Rebuilt command of an EXECVE line; NULL for other lines or without args."""
    line = col(line)
    rebuilt = let(
        args(line, mode), lambda a: F.when(F.size(a) > 0, F.array_join(a, " "))
    )
    return F.when(is_execve(line), rebuilt)


def clean_line(line: Column | str, mode: str = "compat") -> Column:
    """Line without argument fields and argument count."""
    line = col(line)
    if mode == "strict":
        fields = r"(?:^|(?<=\s))(?:a\d+(?:\[\d+\]|_len)?|argc)=(?:\"[^\"]*\"|\S*)\s*"
        return strip(F.regexp_replace(line, fields, ""))
    line = F.regexp_replace(line, QUOTED_ARG, "")
    line = F.regexp_replace(line, HEX_ARG, "")
    return strip(F.regexp_replace(line, ARG_COUNT + SPACE + "*", ""))


def clean_line_manual(line: Column | str) -> Column:
    """Manual variant: quoted arguments go together with the blanks after them."""
    line = F.regexp_replace(col(line), r'a\d+="[^"]*"' + SPACE + "*", "")
    return strip(F.regexp_replace(strip(line), ARG_COUNT + SPACE + "*", ""))


def historic_line(line: Column | str) -> Column:
    """Oldest output form: prefix, argument count kept, command at the end."""
    line = col(line)
    rest = strip(F.regexp_replace(line, r'a\d+="[^"]*"' + SPACE + "*", ""))
    out = F.concat(F.lit("PROCESSED: "), rest, F.lit(' cmd="'), command(line), F.lit('"'))
    return F.coalesce(out, line)


def fallback_command(line: Column | str) -> Column:
    """Command from quoted a0..a9 only; ``N/A`` for lines that are no EXECVE.

    The first value of each index counts and empty ones are skipped; without
    an ``a0`` the command starts with a blank.
    """
    line = col(line)
    # The look-ahead finds every start, also one inside another value, just as
    # ten separate searches would.
    tokens = F.regexp_extract_all(line, F.lit(r'(?=(a[0-9]="[^"]+"))'), F.lit(1))

    def joined(found: Column) -> Column:
        first = lambda name: F.get(F.filter(found, lambda t: F.startswith(t, name)), F.lit(0))
        value = lambda t: F.substring(t, 5, F.length(t) - 5)
        rest = F.filter(
            F.transform(F.array(*[F.lit(f"a{i}=") for i in range(1, 10)]), first),
            lambda t: t.isNotNull(),
        )
        head = F.coalesce(value(first(F.lit("a0="))), F.lit(""))
        return F.array_join(F.concat(F.array(head), F.transform(rest, value)), " ")

    return F.when(is_execve(line), let(tokens, joined)).otherwise(F.lit("N/A"))


def technique_text(
    cmd: Column | str,
    dictionary: Mapping[str, Sequence[str]] = TECHNIQUES,
    mode: str = "compat",
) -> Column:
    """Technique ids a command hints at, sorted and comma-joined; '' for none.

    ``compat`` tests plain substrings; ``strict`` asks for whole words (a
    version number after the word is allowed: ``python3.11``).
    """
    # The dictionary is one literal walked per row.  Spelled out as dozens of
    # tests it would make a generated method too large to be compiled.
    cmd = col(cmd)
    if mode == "strict":
        pattern = lambda ps: rf"(?:^|[^\w.-])(?:{'|'.join(map(re.escape, ps))})[0-9.]*(?:$|[^\w-])"
        hits = [F.when(cmd.rlike(pattern(dictionary[t])), F.lit(t)) for t in sorted(dictionary)]
        return F.concat_ws(",", *hits)
    entries = F.array(
        *[
            F.struct(F.lit(t).alias("id"), F.array(*map(F.lit, dictionary[t])).alias("patterns"))
            for t in sorted(dictionary)
        ]
    )

    def tags(text: Column) -> Column:
        hit = lambda e: F.exists(e["patterns"], lambda p: F.contains(text, p))
        return F.concat_ws(",", F.transform(F.filter(entries, hit), lambda e: e["id"]))

    # Bound first: a command given as an expression would be rebuilt for every pattern.
    return let(cmd, tags)


def split_techniques(text: Column | str) -> Column:
    """The comma-joined ids as an array (empty for '')."""
    return F.when(col(text) == "", F.array().cast("array<string>")).otherwise(F.split(col(text), ","))


def techniques(
    cmd: Column | str,
    dictionary: Mapping[str, Sequence[str]] = TECHNIQUES,
    mode: str = "compat",
) -> Column:
    """The same as an array, each id at most once."""
    return let(technique_text(cmd, dictionary, mode), split_techniques)


def technique_list(
    cmd: Column | str,
    dictionary: Mapping[str, Sequence[str]] = TECHNIQUES,
    mode: str = "compat",
) -> Column:
    """The same as one text, NULL when nothing matches."""
    return let(technique_text(cmd, dictionary, mode), lambda t: F.when(t != "", t))
