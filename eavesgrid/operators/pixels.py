"""Pixels of any sample type: Arrow kernels that put crops together and sum them up, on the flat buffers of a whole batch.

A raster's catalog row may name a sample type (``dtype``) and a value that stands for no data (``nodata``); without these columns samples are
bytes and every value counts.  Samples are little-endian, pixels stand row by row with their bands interleaved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from ..session import ship_package

#: Sample types and how numpy reads them
SAMPLE_TYPES = {"u8": "u1", "u16": "<u2", "i16": "<i2", "u32": "<u4", "i32": "<i4", "f32": "<f4", "f64": "<f8"}
STEP_BYTES = 8 << 20
BATCH_BYTES = 256 << 20


def sample_bytes(dtype: Column) -> Column:
    """Bytes of one sample; a type that isn't known fails the job."""
    found = F.lit(None).cast("int")
    for name, code in SAMPLE_TYPES.items():
        found = F.when(dtype == name, F.lit(np.dtype(code).itemsize)).otherwise(found)
    return F.coalesce(found, F.raise_error(F.concat(F.lit("unknown sample type "), F.coalesce(dtype, F.lit("NULL")))).cast("int"))


def with_sample_type(catalog: DataFrame) -> DataFrame:
    """The catalog with ``dtype`` and ``nodata``, bytes and none where it does not say."""
    dtype = F.coalesce("dtype", F.lit("u8")) if "dtype" in catalog.columns else F.lit("u8")
    nodata = F.col("nodata").cast("double") if "nodata" in catalog.columns else F.lit(None).cast("double")
    return catalog.withColumns({"dtype": dtype, "nodata": nodata})


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and where each row starts; nulls are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[starts[0] : starts[-1]]
    return flat, starts - starts[0]


def _fill_value(dtype: str, nodata: float | None) -> bytes:
    """The bytes of one sample without data; empty where these are zeros."""
    if nodata is None:
        return b""
    value = np.array([nodata]).astype(SAMPLE_TYPES[dtype]).tobytes()
    return value if any(value) else b""


def assemble(frags: pa.ListArray, totals: np.ndarray, dtypes: list[str], nodata: list[float | None]) -> pa.Array:
    """Each row's fragments (``off``, ``data``) at their places in a buffer of ``totals`` bytes, the rest without data."""
    bases = np.concatenate([[0], np.cumsum(totals)])
    out = np.zeros(int(bases[-1]), np.uint8)
    for i, (kind, value) in enumerate(zip(dtypes, nodata)):
        pattern = _fill_value(kind, value)
        if pattern and totals[i]:
            out[bases[i] : bases[i + 1]].reshape(-1, len(pattern))[:] = np.frombuffer(pattern, np.uint8)
    pieces = frags.flatten()
    if len(pieces):
        data, starts = _buffer(pieces.field("data"))
        owner = np.repeat(np.arange(len(frags)), frags.value_lengths().fill_null(0).to_numpy())
        target = bases[owner] + pieces.field("off").to_numpy()
        first = 0
        while first < len(target):  # copied in steps, since the places take eight times the bytes
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + STEP_BYTES, "right")) - 1)
            n = np.diff(starts[first : last + 1])
            at = np.repeat(target[first:last] - (starts[first:last] - starts[first]), n) + np.arange(starts[last] - starts[first])
            out[at] = data[starts[first] : starts[last]]
            first = last
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(totals), [None, pa.py_buffer(bases.astype(np.int64)), pa.py_buffer(out)])


def assembled_crops(whole: DataFrame, kept: list[str]) -> DataFrame:
    """``kept`` columns and ``data``, from rows with ``height, width, n_channels, dtype, nodata, frags``."""
    ship_package(whole.sparkSession)
    needed = list(dict.fromkeys([*kept, "height", "width", "n_channels", "dtype", "nodata", "frags"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("dtype").to_pylist()
            size = np.array([np.dtype(SAMPLE_TYPES[k]).itemsize for k in kinds], np.int64)
            for c in ("height", "width", "n_channels"):
                size = size * batch.column(c).to_numpy()
            ends, first = np.cumsum(size), 0
            while first < len(size):
                last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BATCH_BYTES, "right"))
                last = min(max(last, first + 1), len(size))
                part = batch.slice(first, last - first)
                data = assemble(part.column("frags"), size[first:last], kinds[first:last], part.column("nodata").to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), data.cast(pa.binary())], [*kept, "data"])
                first = last

    schema = StructType([*(whole.schema[c] for c in kept), StructField("data", BinaryType())])
    return whole.select(*needed).mapInArrow(run, schema)


def _reduced(flat: np.ndarray, starts: np.ndarray, kind: str, nodata: np.ndarray):
    """Per row of samples: how many count, how many stand for no data, sum, least and greatest of those that count."""
    dtype = np.dtype(SAMPLE_TYPES[kind])
    values, at = np.frombuffer(flat.tobytes(), dtype), starts // dtype.itemsize
    n = np.diff(at)
    row_value = np.repeat(nodata, n)
    absent = (values == row_value) | (np.isnan(row_value) & np.isnan(values)) if len(values) else np.zeros(0, bool)
    if dtype.kind == "f":
        absent |= np.isnan(values)
    before = np.concatenate([[0], np.cumsum(absent)])
    gone = before[at[1:]] - before[at[:-1]]
    total, least, most = np.zeros(len(n)), np.full(len(n), np.nan), np.full(len(n), np.nan)
    full = np.flatnonzero(n > 0)
    if len(full):
        wide = values.astype(np.float64)
        total[full] = np.add.reduceat(np.where(absent, 0.0, wide), at[:-1][full])
        least[full] = np.minimum.reduceat(np.where(absent, np.inf, wide), at[:-1][full])
        most[full] = np.maximum.reduceat(np.where(absent, -np.inf, wide), at[:-1][full])
    return n - gone, gone, total, least, most


def fragment_sums(frags: DataFrame, kept: list[str]) -> DataFrame:
    """``kept`` columns and ``n, n_nodata, total, least, most`` over the samples of each row's ``frags``; the last two are NULL without samples.

    Sums of whole numbers are exact below 2**53.
    """
    ship_package(frags.sparkSession)
    needed = list(dict.fromkeys([*kept, "dtype", "nodata", "frags"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, kinds = batch.column("frags"), np.array(batch.column("dtype").to_pylist(), object)
            if not len(lists):
                continue
            flat, starts = _buffer(lists.flatten().field("data"))
            pieces = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            ends = starts[pieces]
            nodata = np.array([np.inf if x is None else x for x in batch.column("nodata").to_pylist()])
            cols = [np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64), *(np.zeros(len(lists)) for _ in range(3))]
            first = 0
            for last in [*(np.flatnonzero(kinds[1:] != kinds[:-1]) + 1), len(kinds)]:  # runs of one sample type
                found = _reduced(flat[ends[first] : ends[last]], ends[first : last + 1] - ends[first], kinds[first], nodata[first:last])
                for col, got in zip(cols, found):
                    col[first:last] = got
                first = last
            none = cols[0] == 0
            arrays = [pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3], mask=none), pa.array(cols[4], mask=none)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *arrays], [*kept, "n", "n_nodata", "total", "least", "most"])

    schema = StructType([
        *(frags.schema[c] for c in kept), StructField("n", LongType()), StructField("n_nodata", LongType()),
        *(StructField(c, DoubleType()) for c in ("total", "least", "most")),
    ])
    return frags.select(*needed).mapInArrow(run, schema)


def stretched(crops: DataFrame, low: float, high: float, nodata: float | None = None) -> DataFrame:
    """Crops with 8-bit samples: ``low`` becomes 0 and ``high`` 255, what lies outside is cut off, no data becomes 0.

    Images are prepared and scored from bytes; this brings other sample types there.  Halves are rounded to the even neighbour.
    """
    if not high > low:
        raise ValueError(f"high must be above low, got {low} and {high}")
    ship_package(crops.sparkSession)
    kept = [c for c in crops.columns if c not in ("data", "dtype")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for kind, data in zip(batch.column("dtype").to_pylist(), batch.column("data")):
                raw = data.as_py()
                if raw is None:
                    out.append(None)
                    continue
                values = np.frombuffer(raw, SAMPLE_TYPES[kind]).astype(np.float64)
                absent = np.isnan(values) if nodata is None else np.isnan(values) | (values == nodata)
                scaled = np.rint(np.clip((np.where(absent, low, values) - low) / (high - low), 0, 1) * 255)
                out.append(scaled.astype(np.uint8).tobytes())
            arrays = [*(batch.column(c) for c in kept), pa.array(["u8"] * len(out)), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "dtype", "data"])

    schema = StructType([*(crops.schema[c] for c in kept), StructField("dtype", StringType()), StructField("data", BinaryType())])
    return crops.select(*kept, "dtype", "data").mapInArrow(run, schema)
