"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.session import checkpoint_root

#: Word separators: ASCII blank and 0x09-0x0D (a word is ``[^\x20\x09-\x0D]+``).
SPACES = r"[ \t-\r]+"


def session(df: DataFrame) -> SparkSession:
    return df.sparkSession


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    The lineage ends at replicated files, so a lost executor costs only its
    running tasks; the files go with the folder's retention.
    """
    spark = session(df)
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def others(columns: list[str], reserved: str) -> list[str]:
    """The columns without one that has the name of an operator's result, which replaces it (names meet whatever their case)."""
    return [c for c in columns if c.lower() != reserved]


def text_of(col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text, in order (array of strings, none for an empty text)."""
    return F.array_remove(F.split(text, SPACES), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda variable holds the value; an ordinary alias could be inlined into
    a lambda body and be computed again for each array element.
    """
    return F.transform(F.array(value), body)[0]
