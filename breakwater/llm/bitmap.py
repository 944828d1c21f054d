"""A bitmap of fixed size that spares rows which are surely not asked for; it never drops one that is."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of the bitmap, whatever the corpus: 8 MB. Filled up it spares nothing and changes nothing.
BITS = 1 << 26


def mark(number: Column) -> Column:
    """The bit of a 64-bit number."""
    return F.shiftrightunsigned(number, 64 - 26)


def _bytes(batches: Iterable) -> Iterator:
    """Rising marks to bytes of the bitmap and their places."""
    import pyarrow as pa

    at, value = None, 0
    for batch in batches:
        places, values = [], []
        for bit in batch.column(0).to_pylist():
            if at != bit >> 3:
                if at is not None:
                    places.append(at)
                    values.append(value)
                at, value = bit >> 3, 0
            value |= 1 << (bit & 7)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(values, pa.int32())], ["place", "value"])
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([value], pa.int32())], ["place", "value"])


def bitmap_of(marks: DataFrame, width: int) -> np.ndarray:
    """The bitmap of a column ``mark``; what reaches the driver is at most its own size."""
    dealt = marks.distinct().withColumn("part", F.pmod(F.shiftright("mark", 3), F.lit(width)).cast("int"))
    ordered = dealt.repartitionById(width, F.col("part")).select("mark").sortWithinPartitions("mark")
    rows = ordered.mapInArrow(_bytes, "place int, value int").toArrow()
    bitmap = np.zeros(BITS // 8, np.uint8)
    bitmap[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return bitmap


def might_hold(bitmap: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether each 64-bit number may be among those the bitmap was made of."""
    at = (numbers.view(np.uint64) >> np.uint64(64 - 26)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
