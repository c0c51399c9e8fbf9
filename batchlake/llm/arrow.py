"""Helpers for Arrow batches inside Spark tasks."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step handles at once; a single longer text is a step of its own.
STEP_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package also if it is not installed where they run.

    The folder goes on their module path; a cluster without that folder needs ``--py-files``.
    """
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in parts:
        env["PYTHONPATH"] = os.pathsep.join([here, *parts])


def steps(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds at most ``limit`` bytes of ``text``, or a single row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = batch.column(text)
        if batch.get_total_buffer_size() <= limit:
            yield batch
            continue
        sizes = np.asarray(
            pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64
        )
        ends = np.cumsum(sizes)
        begin = 0
        while begin < n:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def filled(batch: pa.RecordBatch, text: str) -> pa.Array:
    """The text column of a batch; null counts as empty."""
    return pa.compute.fill_null(batch.column(text).cast(pa.string()), "")


def texts(batch: pa.RecordBatch, text: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(text).to_pylist()]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All text bytes of a column without nulls, and each text's length in bytes."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column), dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], np.diff(ends).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each run of ``lengths[i]`` values, 0 for an empty run."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def with_columns(frame: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; whatever else a table holds stays out of the tasks."""
    return frame.select(*[frame[n] for n in names])


def span_text(spans: Column, *kinds: str) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined, of the given kinds or of all."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    parts = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def span_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


#: Spans in code points, end exclusive, as operators return them.
SPANS = "spans array<struct<kind: string, start: bigint, end: bigint>>"
SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)
