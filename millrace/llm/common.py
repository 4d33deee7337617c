"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_folder

#: ASCII white space, as a class for Java's and Python's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lowered, cut at ASCII white space, as UTF-8.

    ``bytes.lower`` and ``bytes.split`` touch ASCII only, which is the rule.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a costly pass feeds several later ones.  The folder is under
    ``spark.checkpoint.dir``, so a lost executor takes nothing with it.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_crc(id_column: str) -> Column:
    """crc32 of an id written as text (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))
