"""Python functions of single rows over Arrow batches.

A batch is read and answered in pieces of a few rows, so a task holds the batch and its answer once, as Arrow buffers, and the
Python strings of one piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

#: Rows of a piece.
PIECE = 256


def in_pieces(function: Callable, columns: tuple[pa.Array, ...], kind: pa.DataType) -> pa.Array:
    """``function`` of each row; structs are returned as dictionaries."""
    done = []
    for start in range(0, len(columns[0]), PIECE):
        rows = zip(*(column.slice(start, PIECE).to_pylist() for column in columns))
        done.append(pa.array([function(*row) for row in rows], kind))
    return pa.concat_arrays(done) if done else pa.array([], kind)


def by_row(function: Callable, kind: DataType):
    """Column function that applies ``function`` to the values of each row."""
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:  # one column comes without its tuple
            yield in_pieces(function, (batch,) if isinstance(batch, pa.Array) else batch, arrow)

    return run


def by_rows(function: Callable, kind: DataType, rows: int = PIECE):
    """Column function that applies ``function`` to lists of the values of a few rows; it returns a list of their answers, structs as tuples."""
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = (batch,) if isinstance(batch, pa.Array) else batch
            starts = range(0, len(columns[0]), rows)
            done = [pa.array(function(*(c.slice(start, rows).to_pylist() for c in columns)), arrow) for start in starts]
            yield pa.concat_arrays(done) if done else pa.array([], arrow)

    return run
