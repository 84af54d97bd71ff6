"""Helpers shared by the operators of this package."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.session import scratch_path, ship_package


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back: lineage ends here,
    and a lost executor costs only the tasks that follow."""
    ship_package(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, name: str) -> Column:
    """The text column, null read as the empty text."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def quoted(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket_of(column: str, modulus: int) -> Column:
    """crc32 of a value's decimal text, modulo ``modulus``: fixes folds by id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus
