"""Heat of a grid of counts as a convolution, by fast Fourier transforms of rows, then columns.

The heat of a pixel is the sum of all counts over the squared distance (1 for the pixel's
own), so it is the grid of counts convolved with one kernel. Every row of the grid is
transformed by itself; its spectrum travels in blocks of columns, so that a block meets with
those of all rows; there the columns are transformed, multiplied by the kernel's spectrum and
transformed back; and rows gather their blocks again. The kernel is even along both axes, so half
its rows and a real spectrum do. Rows and columns are padded with zeros, as what leaves the
image on one side must not come in on the other.

Work is pixels times the logarithm of the image's sides, whatever the number of points and
the kernel's reach. A task holds some rows, or one block of columns. Results carry the
rounding error of a transform: about 1e-15 of the largest heat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Columns of a spectrum that travel together, and rows that a task transforms at a time.
BLOCK, ROWS = 64, 32


def fast_length(n: int) -> int:
    """The smallest length of at least n with no prime factor above 5."""
    best = 1 << max(n - 1, 0).bit_length()
    five = 1
    while five < best:
        three = five
        while three < best:
            rest = -(-n // three)
            best = min(best, three << max(rest - 1, 0).bit_length())
            three *= 3
        five *= 5
    return best


def _slices(kind: int, at: list[int], spectra: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks of columns of the spectra of some rows."""
    for block in range(-(-spectra.shape[1] // BLOCK)):
        part = spectra[:, block * BLOCK : (block + 1) * BLOCK]
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(at), pa.int32()), pa.array([block] * len(at), pa.int32()), pa.array(at, pa.int32()), _lists(part.real), _lists(part.imag)],
            ["kind", "block", "y", "re", "im"],
        )


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(np.ascontiguousarray(rows).ravel()))


def _matrix(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    n = len(lists)
    flat = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def inverse_square(counted: DataFrame, width: int, height: int, reach: int | None = None) -> DataFrame:
    """x, y, heat of every pixel of the image. counted: x, y, points, one row per pixel.

    ``reach`` cuts the kernel: only counts nearer than that on both axes give heat. Counts
    one pixel beyond the image, where its border falls, take part as sources.
    """
    rx, ry = (width, height) if reach is None else (min(reach - 1, width), min(reach - 1, height))
    if rx < 0 or ry < 0:
        rx = ry = -1
    wide, high = fast_length(width + 1 + max(rx, 0)), fast_length(height + 1 + max(ry, 0))
    least = 0.25 / max(rx * rx + ry * ry, 1)  # no count gives less than four times this; below it, all is rounding

    def transform_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                dense = np.zeros((part.num_rows, wide))
                lists = part.column(1)
                owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                cells = lists.flatten()
                np.add.at(dense, (owner, cells.field("x").to_numpy()), cells.field("points").to_numpy())
                yield from _slices(0, part.column(0).to_pylist(), np.fft.rfft(dense))

    def kernel_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dx = np.minimum(np.arange(wide), wide - np.arange(wide))
        for b in batches:
            ids = b.column(0).to_numpy()
            for i in range(0, len(ids), ROWS):
                square = dx[None, :].astype(float) ** 2 + ids[i : i + ROWS, None].astype(float) ** 2
                weights = np.where(dx[None, :] <= rx, 1 / np.where(square == 0, 1.0, square), 0.0)
                yield from _slices(1, ids[i : i + ROWS].tolist(), np.fft.rfft(weights))

    def columns(t: pa.Table) -> pa.Table:
        kind, y = t.column("kind").to_numpy(), t.column("y").to_numpy()
        re, im = _matrix(t.column("re")), _matrix(t.column("im"))
        data, kernel = np.zeros((high, re.shape[1]), complex), np.zeros((high, re.shape[1]))
        mine = kind == 0
        data[y[mine]] = re[mine] + 1j * im[mine]
        kernel[y[~mine]] = kernel[-y[~mine]] = re[~mine]
        out = np.fft.ifft(np.fft.fft(data, axis=0) * np.fft.fft(kernel, axis=0).real, axis=0)[:height]
        block = np.full(height, t.column("block")[0].as_py(), np.int32)
        return pa.table([pa.array(np.arange(height, dtype=np.int32)), pa.array(block), _lists(out.real), _lists(out.imag)], ["y", "block", "re", "im"])

    def gather_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, parts in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                cells = parts.values.take(pa.array(np.argsort(parts.values.field("block").to_numpy())))
                spectrum = cells.field("re").flatten().to_numpy() + 1j * cells.field("im").flatten().to_numpy()
                heat = np.fft.irfft(spectrum, wide)[:width]
                yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), _lists(np.where(heat < least, 0.0, heat)[None, :])], ["y", "row"])

    sliced = "kind int, block int, y int, re array<double>, im array<double>"
    rows = counted.groupBy("y").agg(F.collect_list(F.struct("x", F.col("points").cast("double").alias("points"))).alias("cells"))
    kernel = counted.sparkSession.range(max(ry + 1, 1)).mapInArrow(kernel_rows, sliced)
    both = rows.mapInArrow(transform_rows, sliced).unionByName(kernel)
    blocks = both.groupBy("block").applyInArrow(columns, "y int, block int, re array<double>, im array<double>")
    gathered = blocks.groupBy("y").agg(F.collect_list(F.struct("block", "re", "im")).alias("parts")).mapInArrow(gather_rows, "y int, row array<double>")
    return gathered.select("y", F.posexplode("row").alias("x", "heat")).select("x", "y", "heat")
