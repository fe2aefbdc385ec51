"""EXECVE enrichment, id resolution and rendering of whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.facts import TECHNIQUES
from logforge.functions import execve as X
from logforge.functions import render as R
from logforge.functions.audit import field_columns, id_value, is_execve, shape_struct
from logforge.operators.events import assemble_events
from logforge.operators.routing import drop_proctitle
from logforge.scale import fits, left_lookup

IDS = ("auid", "uid", "gid")


def rebuild_commands(
    df: DataFrame,
    line: str = "msg",
    mode: str = "compat",
    profile: str = "debian",
    dictionary=TECHNIQUES,
) -> DataFrame:
    """Add cmd, line_clean, the techniques and the three ids of EXECVE lines.

    Lines that are no EXECVE, or have no argument, keep NULL in ``cmd`` and
    their own text in ``line_clean``.  Profile ``manual`` reads quoted
    arguments only, drops lines with a process title and enriches nothing.
    """
    manual = profile == "manual"
    if manual:
        df = drop_proctitle(df, line)
    guarded = lambda c, test: F.when(test, c)
    # Arguments are extracted once, and only where the substring test holds.
    df = df.withColumn(
        "_args", guarded(X.args(line, mode, quoted_only=manual), is_execve(line))
    )
    has_args = F.coalesce(F.size("_args") > 0, F.lit(False))
    clean = X.clean_line_manual(line) if manual else X.clean_line(line, mode)
    built = F.struct(
        guarded(F.array_join("_args", " "), has_args).alias("cmd"),
        guarded(clean, has_args).alias("line_clean"),
    )
    # The one-element explode keeps later filters (on techniques, say) from
    # being pushed below the rebuild and running it again.
    kept = [c for c in df.columns if c not in ("_args", "cmd", "line_clean")]
    df = df.select(*kept, F.explode(F.array(built)).alias("_built")).select(
        *kept,
        F.col("_built.cmd").alias("cmd"),
        F.coalesce("_built.line_clean", line).alias("line_clean"),
    )
    rebuilt = F.col("cmd").isNotNull() if not manual else F.lit(False)
    # Texts first, typed columns after: a pattern used twice would run twice.
    df = df.withColumns(
        {
            "_tags": guarded(X.technique_text("cmd", dictionary, mode), rebuilt),
            **{
                f"{name}_id": guarded(
                    F.regexp_extract("line_clean", rf"\b{name}=(\d+)", 1),
                    rebuilt & F.contains("line_clean", F.lit(f"{name}=")),
                )
                for name in IDS
            },
        }
    )
    return df.withColumns(
        {
            "techniques": X.split_techniques("_tags"),
            "mitre_techniques": F.when(F.col("_tags") != "", F.col("_tags")),
            **{f"{name}_id": id_value(F.col(f"{name}_id")) for name in IDS},
        }
    ).drop("_tags")


def resolve_ids(
    df: DataFrame, passwd: DataFrame | None, groups: DataFrame | None
) -> DataFrame:
    """Add auid_name, uid_name and gid_name by host-scoped lookup.

    ``passwd`` and ``groups`` have host, id, name, unique on (host, id).
    Unknown and unset ids keep NULL.
    """
    small = {id(dim): fits(dim) for dim in (passwd, groups) if dim is not None}
    for name, dim in (("auid", passwd), ("uid", passwd), ("gid", groups)):
        if dim is None:
            df = df.withColumn(f"{name}_name", F.lit(None).cast("string"))
            continue
        side = dim.select(
            "host", F.col("id").alias(f"{name}_id"), F.col("name").alias(f"{name}_name")
        )
        df = left_lookup(df, side, ["host", f"{name}_id"], broadcast=small[id(dim)])
    return df


def add_line_out(df: DataFrame, prefix: str = "") -> DataFrame:
    """Add ``line_out``: the cleaned line with its key=value tail."""
    pairs = {
        "cmd": F.col("cmd"),
        **{f"{n}_name": F.col(f"{n}_name") for n in IDS if f"{n}_name" in df.columns},
        "mitre_techniques": F.col("mitre_techniques"),
    }
    return df.withColumn(
        "line_out",
        F.when(F.col("cmd").isNotNull(), R.kv(F.col("line_clean"), pairs, prefix)).otherwise(
            F.col("line_clean")
        ),
    )


def enrich_execve(
    df: DataFrame,
    line: str = "msg",
    mode: str = "compat",
    profile: str = "debian",
    passwd: DataFrame | None = None,
    groups: DataFrame | None = None,
    dictionary=TECHNIQUES,
) -> DataFrame:
    """Full enrichment: cmd, techniques, names and ``line_out``."""
    df = rebuild_commands(df, line, mode, profile, dictionary)
    return add_line_out(resolve_ids(df, passwd, groups))


def enrich_events(
    records: DataFrame,
    passwd: DataFrame | None = None,
    groups: DataFrame | None = None,
    line: str = "msg",
    mode: str = "compat",
    dictionary=TECHNIQUES,
) -> DataFrame:
    """Whole events enriched: ids and names from SYSCALL, command and techniques from EXECVE.

    EXECVE records carry no ids of their own on most systems, so names can
    only be added once the records of an event are together.
    """
    events = assemble_events(records, line, mode)
    tagged = events.withColumn("_tags", X.technique_text("cmd", dictionary, mode))
    tagged = tagged.withColumns(
        {
            "techniques": F.when(F.col("cmd").isNotNull(), X.split_techniques("_tags")),
            "mitre_techniques": F.when(F.col("cmd").isNotNull() & (F.col("_tags") != ""), F.col("_tags")),
        }
    ).drop("_tags")
    return resolve_ids(tagged, passwd, groups)


def extract_fields(df: DataFrame, mode: str = "compat", line: str = "msg") -> DataFrame:
    """Add the eight forwarded fields with their defaults."""
    return df.withColumns(field_columns(line, mode))


def parse_shape(df: DataFrame, shape: str, line: str = "msg") -> DataFrame:
    """Add the typed fields of a record shape as struct column ``shape``."""
    return df.withColumn("shape", shape_struct(line, shape))


def forwarded_fields(df: DataFrame, mode: str = "compat", line: str = "msg") -> DataFrame:
    """Direct-tail path: eight fields plus the fallback command ``cmd``."""
    return extract_fields(df, mode, line).withColumn("cmd", X.fallback_command(line))


def render_rfc3339(df: DataFrame) -> DataFrame:
    return df.withColumn("line_out", R.rfc3339())


def render_received(df: DataFrame) -> DataFrame:
    return df.withColumn("line_out", R.received())


def render_traditional(df: DataFrame) -> DataFrame:
    return df.withColumn("line_out", R.traditional())


def _leef_column(df: DataFrame):
    present = {c: F.col(c) for c in df.columns}
    fields = {n: present[n] for n in ("auid", "uid", "euid", "pid", "exe", "success", "key", "cmd")}
    fields["devTime"] = R.rfc3339_time("ts")
    return R.leef(F.col("audit_type"), fields)


def render_leef(df: DataFrame) -> DataFrame:
    """LEEF 2.0 of a frame made by ``forwarded_fields`` (with ``ts``)."""
    return df.withColumn("line_out", _leef_column(df))


def render_json(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumn("line_out", F.to_json(F.struct(*columns)))


def frame_octets(df: DataFrame, line: str = "line_out") -> DataFrame:
    return df.withColumn(line, R.octet_frame(line))


def dual_format(df: DataFrame, formats: tuple[str, ...] = ("leef", "traditional")) -> DataFrame:
    """Every message once per format, without reading the input twice."""
    made = {
        "leef": lambda: _leef_column(df),
        "traditional": R.traditional,
        "rfc3339": R.rfc3339,
        "received": R.received,
    }
    rows = F.array(
        *[F.struct(F.lit(f).alias("format"), made[f]().alias("line_out")) for f in formats]
    )
    return df.withColumn("_out", F.explode(rows)).select(*df.columns, "_out.*")


