"""What the corpus operators share: word patterns, ASCII folding, and tables written to the shared folder."""

from __future__ import annotations

import ctypes
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calipers.sources.shared import shared_folder

#: Characters that separate words where a contract takes words as runs of other characters.
BLANKS = " \t\n\v\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
#: Words of digits, a-z and everything beyond ASCII, after A-Z were lower-cased.
FOLDED_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of rows that a Python worker takes at a time, where the session names no number: texts of one batch are held several times over.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder. Python workers look for this package where the driver has it, beside their own path, and take BATCH_BYTES at a time."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(text: Column) -> Column:
    """A-Z to a-z and nothing else; null reads as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def blank_words(text: Column) -> Column:
    """Words between blanks, as an array without empty strings."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def folded_words(text: Column) -> Column:
    return F.regexp_extract_all(fold(text), F.lit(FOLDED_WORD), F.lit(0))


def give_back() -> None:
    """Returns freed memory to the system at the end of a task: a Python worker that waits would hold it beside the next stage's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def settle(df: DataFrame, files: int | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    (df.coalesce(files) if files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
