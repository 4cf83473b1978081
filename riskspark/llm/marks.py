"""Marks (row, place) found in buckets, on their way back to the rows.

A bucket sends one cell for each slot of rows, so the number of shuffled rows does not
grow with the number of documents in a bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARKS = "slot int, rows binary, places binary"


def cells(column, kind: str) -> np.ndarray:
    """The values in the binary cells of a column, one cell after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def slotted(rows: np.ndarray, place: np.ndarray, slots: int) -> list[pa.Array]:
    """Marks as one cell for each slot of rows: the slot, its rows, their places."""
    slot = (rows % slots).astype(np.int32)
    order = np.argsort(slot, kind="stable")
    have, cut = np.unique(slot[order], return_index=True)
    cut = np.append(cut, len(order))
    parts = ([x[cut[i]:cut[i + 1]].tobytes() for i in range(len(have))] for x in (rows[order].astype("<i8"), place[order].astype("<i4")))
    return [pa.array(have, pa.int32()), *(pa.array(c, pa.binary()) for c in parts)]


def _lists(table: pa.Table) -> pa.Table:
    rows, place = cells(table.column("rows"), "<i8"), cells(table.column("places"), "<i4")
    order = np.argsort(rows, kind="stable")
    rows, place = rows[order], place[order]
    have, cut = np.unique(rows, return_index=True)
    ends = pa.array(np.append(cut, len(rows)).astype(np.int32))
    return pa.table({"row": pa.array(have, pa.int64()), "marks": pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32)))})


def by_row(marks: DataFrame) -> DataFrame:
    """``row`` and its ``marks`` from a table of MARKS."""
    return marks.groupBy("slot").applyInArrow(_lists, "row long, marks array<int>")
