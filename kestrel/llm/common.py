"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files of the shared folder that
    ``spark.checkpoint.dir`` names instead of recomputing the plan, and every
    branch that uses the frame sees one materialisation.
    """
    path = staging_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staging_path(spark, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until it clashes with no column of ``df`` (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(name: str) -> Column:
    """The text column with null as the empty string."""
    return F.coalesce(F.col(name), F.lit(""))


def row_key(id_col: str, text_col: str) -> Column:
    """64-bit key of a document row by its id and text; rows equal in both share it."""
    return F.xxhash64(F.col(id_col), text_of(text_col))
