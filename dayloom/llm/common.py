"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keep(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows written once to the shared folder and read back: later passes neither repeat the work
    nor depend on an executor that may be lost. ``by`` names columns whose values get folders of their own."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(kept: DataFrame) -> None:
    """Remove the files of a kept table that nothing reads any more."""
    files = kept.inputFiles()
    if files:
        session = kept.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key as one table, from batches sorted by the keys."""
    import numpy as np
    import pyarrow.compute as pc

    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if rest is not None:
            now = pa.concat_tables([rest, now]).combine_chunks()
        if now.num_rows == 0:
            continue
        changed = np.zeros(now.num_rows - 1, dtype=bool)
        for key in keys:
            column = now.column(key)
            changed |= pc.not_equal(column.slice(1), column.slice(0, now.num_rows - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist()]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield now.slice(start, end - start)
        rest = now.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest
