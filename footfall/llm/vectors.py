"""Rows of a vector table as packed doubles."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(rows: DataFrame, scale: float | None = None) -> DataFrame:
    """id, dim and v (doubles as bytes) of each vector without null or non-finite components, ids not null.

    With ``scale``, components are floor(scale * x); without, vectors are brought to length one and zero vectors left out.
    Vectors whose length is beyond doubles are scaled by their largest component first.
    """
    schema = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("v", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            ids, dims, data = [], [], []
            lists = batch.column(1)
            values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            lengths = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy()), 0)
            stops = np.cumsum(lengths)
            for i, n, stop in zip(batch.column(0).to_pylist(), lengths.tolist(), stops.tolist()):
                x = values[stop - n : stop]
                if i is None or not n or not np.isfinite(x).all():
                    continue  # a null component is NaN here
                if scale is None:
                    most = np.abs(x).max()
                    if most == 0:
                        continue
                    x = x / most
                    x = x / np.sqrt((x * x).sum())
                else:
                    x = np.floor(scale * x)
                    if not np.isfinite(x).all():
                        continue
                ids.append(i)
                dims.append(n)
                data.append(np.ascontiguousarray(x, np.float64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, dims, data), schema)], schema=schema)

    vectors = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return vectors.mapInArrow(run, "id long, dim int, v binary")


def matrix(column) -> np.ndarray:
    """Packed vectors of one dimension as rows."""
    data = column.to_pylist() if hasattr(column, "to_pylist") else list(column)
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)
