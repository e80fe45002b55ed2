"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formmart.session import deleted, scratch_path, shuffles_deleted

#: A word: a run of characters other than blank and the ASCII controls 9 to 13.
WORD_CLASS = r"\x20\x09-\x0D"
WORD = re.compile(f"[^{WORD_CLASS}]+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def low_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased, in UTF-8; null has none.

    ``bytes.lower`` knows ASCII letters alone, ``bytes.split`` cuts at blanks
    and the controls 9 to 13.
    """
    return text.encode().lower().split() if text else []


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def crc_fold(c: Column, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; null stays null."""
    return F.crc32(c.cast("string").cast("binary")) % F.lit(folds)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dropped(df: DataFrame) -> None:
    """Delete the folder of a frame that ``written`` returned and that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        deleted(spark, folder)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once below the shared folder and read back; the job's shuffle files are deleted at its end.

    This cuts the lineage, fixes the rows for every later reader, and a lost
    executor costs only the files it was reading.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    with shuffles_deleted(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """As ``written``, in a folder for each value of ``by`` (the last columns)."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    with shuffles_deleted(spark):
        df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
