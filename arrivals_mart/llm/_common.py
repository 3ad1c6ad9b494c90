"""What the operators of this subpackage share: table reading and scratch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.session import scratch_path

#: ``[\x20\x09-\x0D]``: what separates words. ``bytes.split()`` splits at the same six characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: A-Z to a-z for ``bytes.translate``; UTF-8 keeps those bytes to ASCII.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared scratch folder and read it back: the lineage
    is cut, and a lost executor costs no recomputation of what stands before."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def struct_of(df: DataFrame, *without: str):
    """All columns but ``without`` in one struct, so that no name of theirs clashes with an operator's."""
    names = [c for c in df.columns if c not in without]
    return F.struct(*[F.col(f"`{c}`") for c in names]), T.StructType([df.schema[c] for c in names])


def held_out(id_col: str):
    """True where crc32(id as text) mod 3 is 1: rows that no model learns from."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 3 == 1
