"""Intermediate tables in the shared folder, row keys, and Arrow batches of documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from storelens.session import stored

__all__ = ["each_slice", "held", "packed", "slices", "stored", "task_keys", "unpacked"]

#: Bytes of text that a Python task works on at a time; one longer text is a slice of its own. Batches that Spark sends
#: are bounded by spark.sql.execution.arrow.maxBytesPerBatch.
SLICE_BYTES = 1 << 20


def packed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_text`` (null stays null) and ``_row`` with all other columns, so that no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    row = F.struct(*rest) if rest else F.struct(F.lit(True).alias("_"))
    return docs.select(F.col(text).cast("string").alias("_text"), row.alias("_row"))


def unpacked(df: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The columns that ``packed`` took in, in their old order."""
    return df.select(*[F.col("_text").alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in columns])


def slices(batch: pa.RecordBatch, column: str = "_text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about ``limit`` bytes of ``column``."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)).astype(np.int64)
    block = (np.cumsum(sizes) - sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


_held: dict[str, object] = {}


def held(key: str, make: Callable[[], object]) -> object:
    """One large object that a Python worker keeps over its tasks; asking for another one lets it go."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def let_go(but: str = "") -> None:
    """Forget what ``held`` keeps in this worker, unless it is ``but``."""
    if but not in _held:
        _held.clear()


def each_slice(df: DataFrame, compute: Callable[[pa.RecordBatch], list], fields: list[T.StructField], keep: list[str], holds: str = "") -> DataFrame:
    """Columns ``keep`` of ``df`` and, beside them, the arrays that ``compute`` returns for each slice of rows. ``holds``: key of what
    ``compute`` asks ``held`` for; workers let go of anything else first."""
    schema = T.StructType([*(df.schema[c] for c in keep), *fields])
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(holds)  # by name, as this function travels without its module's state
        for batch in batches:
            pa.default_memory_pool().release_unused()  # a worker lives on after its task
            for part in slices(batch):
                new = [a if isinstance(a, pa.Array) else pa.array(a, kind) for a, kind in zip(compute(part), kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *new], names=schema.names)

    return df.mapInArrow(run, schema)


def task_keys(state: dict, count: int) -> np.ndarray:
    """Row keys of this task: partition in the high bits, running number in the low ones. ``state`` lives as long as the task."""
    context = TaskContext.get()
    first = ((context.partitionId() if context else 0) << 40) + state.get("next", 0)
    state["next"] = state.get("next", 0) + count
    return np.arange(first, first + count, dtype=np.int64)
