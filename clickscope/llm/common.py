"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import clickscope
from clickscope.session import checkpoint_dir

ASCII_SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Runs of characters other than 0x20 and 0x09-0x0D, in order.

    A null or blank text has an empty array.
    """
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(ASCII_SPACE))
    empty = F.array().cast("array<string>")
    return F.when(F.length(bare) == 0, empty).otherwise(F.split(bare, r"[\x09-\x0D\x20]+"))


def pick(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns of the caller, whatever
    their names, never meet an operator's own."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores in front until it clashes with no column."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and cut its lineage.

    Runs one job. The rows survive the loss of any executor.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again.

    Like ``durable``, but compressed; for larger intermediate tables.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def importable_by_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For drivers that only put the package on their own ``sys.path``; where it
    is installed or shipped with the job this changes nothing.
    """
    root = str(Path(clickscope.__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])
