"""Helpers the text operators share: words, row keys, Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

# A word is a run of anything but space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: str | None) -> list[str]:
    return WORDS.findall(text) if text else []


def row_key() -> Column:
    """A key of (doc_id, text), NULLs included: equal rows share it, others do not."""
    none = F.lit("-")
    return F.md5(
        F.concat(
            F.coalesce(F.col("doc_id").cast("string"), none),
            F.lit(":"),
            F.coalesce(F.md5(F.col("text")), none),
        )
    )


def with_columns(batch: pa.RecordBatch, keep: Iterable[str], made: dict) -> pa.RecordBatch:
    """Some columns of a batch, unchanged, and new ones after them."""
    columns = {name: batch.column(name) for name in keep} | made
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def per_document(
    docs: DataFrame, keep: list[str], work: Callable[[str], tuple], made: str
) -> DataFrame:
    """Run ``work`` on every whole text (NULL: empty); its values become the columns ``made``.

    ``made`` is a DDL list of columns. ``keep`` names the columns passed through.
    """
    names = [part.split()[0] for part in made.split(", ")]
    schema = docs.select(*keep).schema
    for field in StructType.fromDDL(made):
        schema = schema.add(field)
    types = {f.name: to_arrow_type(f.dataType) for f in schema if f.name in names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [work(text or "") for text in batch.column("text").to_pylist()]
            values = zip(*rows) if rows else ([] for _ in names)
            yield with_columns(
                batch, keep, {n: pa.array(list(v), types[n]) for n, v in zip(names, values)}
            )

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)

