"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="feedsieve-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    A lost executor costs a re-read only. The tables stay in the folder, like
    checkpoint files, until the cluster clears it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/feedsieve-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by as many underscores as no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_text(column: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes, for choosing numbers of partitions."""
    row = docs.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text_col))).alias("b")
    ).first()
    return row["n"], row["b"] or 0


def slices(batch: pa.RecordBatch, text_col: int, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice hold about ``most`` bytes.

    No text is cut: a longer one is a slice of its own.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += int(size)
    if first < batch.num_rows:
        yield batch.slice(first)
