"""Size-checked broadcasts, salted joins and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A dimension is broadcast only if a count proves it has at most this many rows.
BROADCAST_ROWS = 500_000
# Copies of the small side in a salted join; a hot key is spread over this many tasks.
SALTS = 32


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``max_rows`` rows (counted, never collected)."""
    return df.count() <= max_rows


def left_lookup(
    df: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "left",
    broadcast: bool | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join a large ``df`` with a dimension that is unique on ``keys``.

    A dimension proven small is broadcast, so ``df`` is not shuffled.  Any
    other one is joined on ``keys`` plus a salt taken from the whole row, with
    the dimension repeated once per salt: one hot key (or NULL) is spread over
    ``salts`` tasks.  The salt is a hash and not a random number, so a task
    that runs again sends every row to the same place; exact copies of one row
    stay together and are left to the adaptive skew split.
    """
    if broadcast is None:
        broadcast = fits(dim)
    if broadcast:
        return df.join(F.broadcast(dim), keys, how)
    salted = df.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts)).cast("int")
    )
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, keys + ["_salt"], how).drop("_salt")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then uses a
    temporary folder.  On a cluster a machine-local folder would be lost with
    its executor, so the setting is required there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="logforge-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
