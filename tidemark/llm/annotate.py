"""Add one column, computed over Arrow slices of a text column, to any table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.batches import bound_batches, tidy
from tidemark.llm.words import SLICE_BYTES, slices


def annotate(
    df: DataFrame,
    compute: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    fields: str,
    name: str,
    text: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``df`` with a struct column ``name`` of ``fields`` (DDL) behind its own.

    ``compute`` gets rows whose texts have about ``slice_bytes`` together and
    returns one array per field. All columns of ``df`` pass through unchanged,
    but one called ``name``, whose place the new one takes.
    """
    bound_batches(df.sparkSession)
    columns = df.columns
    kept = [c for c in columns if c != name]
    struct = T._parse_datatype_string(fields)
    fields_kept = [f for f in df.schema.fields if f.name != name]
    # Spark takes dots in names for parts of a struct here; plain ones go in.
    plain = df.toDF(*[f"_{k}" for k in range(len(columns))])
    schema = T.StructType(
        [
            *[T.StructField(f"_{k}", f.dataType) for k, f in enumerate(fields_kept)],
            T.StructField("_new", struct),
        ]
    )
    names = struct.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = pa.RecordBatch.from_arrays(batch.columns, names=columns)
            for part in slices(named, text, slice_bytes):
                found = compute(part)
                column = pa.StructArray.from_arrays([found[n] for n in names], names)
                yield pa.RecordBatch.from_arrays(
                    [*[part[c] for c in kept], column], names=schema.names
                )

    return plain.mapInArrow(tidy(run), schema).toDF(*kept, name)
