"""What the operators share: tables by name, columns by fixed names, written tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **types: str) -> DataFrame:
    """The named columns with the given types, and no other: further columns cannot clash with added ones."""
    return df.select(*[df[name].cast(kind).alias(name) for name, kind in types.items()])


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage: a lost executor costs the running stage, not the work before it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoints(spark: SparkSession) -> None:
    """``checkpoint()`` writes to ``spark.checkpoint.dir``; a local session without it gets a scratch folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoints"))


def hex64(name: str) -> F.Column:
    """A 64-bit integer column as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(name)), 16, "0"))
