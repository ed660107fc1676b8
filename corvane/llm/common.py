"""Column rules and batch helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType


class Memo(dict):
    """A bounded memo of a function of one key: it starts anew once it is full."""

    def __init__(self, function: Callable, entries: int = 500_000):
        super().__init__()
        self.function, self.entries = function, entries

    def __missing__(self, key):
        if len(self) >= self.entries:
            self.clear()
        value = self[key] = self.function(key)
        return value


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text is 2 modulo 4; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnt(doc_id: str = "doc_id") -> Column:
    """Rows a model may learn from: a known id that is not held out."""
    return F.col(doc_id).isNotNull() & ~held_out(doc_id)


def map_rows(df: DataFrame, schema: StructType | str,
             rows: Callable[[dict[str, list]], Iterator[tuple]], slice_rows: int = 256) -> DataFrame:
    """``mapInArrow`` over slices of at most ``slice_rows`` rows, so that Python objects
    of a few texts at a time are alive. ``rows`` takes lists by column name and yields
    one tuple for each output row."""
    out = df.limit(0).select().sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, slice_rows):
                part = batch.slice(start, slice_rows)
                found = list(rows({n: part.column(i).to_pylist()
                                   for i, n in enumerate(part.schema.names)}))
                columns = zip(*found) if found else [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, out)
