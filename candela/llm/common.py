"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.plans.materialize import materialize
from candela.session import scratch_path

__all__ = ["Scratch", "WORD", "materialize", "map_rows", "slices", "spare_name", "tokenizer_path"]

#: Words of the mixing, quality and join operators: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: UTF-8 bytes of text that a Python task holds at once (one longer text still passes whole).
SLICE_BYTES = 1 << 20


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the files stay where they are installed."""
    import public_tokenizers
    return public_tokenizers.path(name)


class Scratch:
    """Tables in the shared folder that one operator needs until its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Writes the table and reads it back."""
        self.paths.append(scratch_path(self.spark, name))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def drop(self) -> None:
        """Deletes all tables put here; nothing may read them any more."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        self.paths = []


def spare_name(taken, wanted: str) -> str:
    """``wanted``, lengthened by underscores until no column in ``taken`` clashes (case ignored)."""
    have = {c.lower() for c in taken}
    while wanted.lower() in have:
        wanted += "_"
    return wanted


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that the texts of ``column`` in each piece stay near ``limit`` bytes."""
    import numpy as np
    import pyarrow.compute as pc
    if pa.default_memory_pool().backend_name != "system":
        # Arrow's own allocators keep what a task has freed; a worker that waits would hold it.
        pa.set_memory_pool(pa.system_memory_pool())
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(lengths, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def map_rows(df: DataFrame, text: str, make: Callable[[], Callable], fields: list[tuple[str, T.DataType]],
             piece_bytes: int = SLICE_BYTES) -> DataFrame:
    """Adds ``fields`` to every row of ``df`` with a Python function of the text column.

    ``make()`` runs once in each task and returns a function from a list of texts (``None`` for
    null) to one list per field.  Every other column passes through as it is, so nothing is
    joined back and no row can be lost.  Fields whose name is taken get an underscore appended.
    """
    names, taken = [], list(df.columns)
    for name, _ in fields:
        names.append(spare_name(taken, name))
        taken.append(names[-1])
    out = T.StructType(list(df.schema.fields) + [T.StructField(n, kind) for n, (_, kind) in zip(names, fields)])
    at = df.columns.index(text)

    def run(batches):
        work = make()
        for batch in batches:
            for piece in slices(batch, at, piece_bytes):
                made = work(piece.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, *(pa.array(v, type=arrow) for v, arrow in zip(made, kinds))],
                    names=[*piece.schema.names, *names])

    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(kind) for _, kind in fields]
    return df.mapInArrow(run, out)


def rows_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in columns))
