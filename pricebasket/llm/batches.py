"""Python in tasks: columns added to rows that keep all their own, and memory handed back."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Characters of text handled at once.
BLOCK = 1 << 20


def released(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` over a task's batches, handing freed memory back to the machine when it ends.

    Workers live on between tasks; what the allocator keeps for them would otherwise add up.
    """

    @wraps(function)
    def run(parts: Iterator) -> Iterator:
        try:
            yield from function(parts)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def with_columns(rows: DataFrame, reads: list[str], compute: Callable[..., dict], schema: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Each row without ``drop``, with what ``compute`` makes of the lists of its columns ``reads``.

    New columns must not have names that the rows have. ``compute`` gets some rows at a time, up to
    about ``BLOCK`` characters, and gives a list or array for each column of ``schema``.
    """
    added = T._parse_datatype_string(schema)
    kept = [name for name in rows.columns if name not in drop]
    whole = T.StructType([*(rows.schema[name] for name in kept), *added])
    arrow = to_arrow_schema(added)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, reads):
                made = compute(*(part.column(name).to_pylist() for name in reads))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in kept), *(pa.array(made[f.name], f.type, from_pandas=True) for f in arrow)],
                    names=[*kept, *arrow.names])

    return rows.mapInArrow(released(extend), whole)


def blocks(batch: pa.RecordBatch, reads: list[str]) -> Iterator[pa.RecordBatch]:
    """Slices of the batch whose read strings hold about ``BLOCK`` characters, a row at least."""
    import pyarrow.compute as pc

    size = [0] * batch.num_rows
    for name in reads:
        if pa.types.is_string(batch.column(name).type) or pa.types.is_large_string(batch.column(name).type):
            size = [a + (b or 0) for a, b in zip(size, pc.binary_length(batch.column(name)).to_pylist())]
    start, held = 0, 0
    for row, n in enumerate(size):
        held += n
        if held >= BLOCK:
            yield batch.slice(start, row + 1 - start)
            start, held = row + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)
