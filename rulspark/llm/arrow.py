"""Arrow batches of texts as flat byte arrays, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that a vectorised step handles at once. Steps hold some eight bytes per
# byte of text, so this bounds a worker's memory whatever the size of an Arrow batch.
SLICE_BYTES = 1_000_000


_MODEL: dict = {}


def held(key: tuple, make):
    """The model this worker uses now. Workers outlive a stage, so one model is kept at a
    time and the next one takes its place."""
    if _MODEL.get("key") != key:
        _MODEL.clear()
        _MODEL.update(key=key, value=make())
    return _MODEL["value"]


def release() -> None:
    """Free the model of an earlier stage in a worker that needs none now."""
    _MODEL.clear()


def filled(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The texts with null as the empty text, with 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def strings(column: pa.Array) -> list[str]:
    return filled(column).to_pylist()


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and where each text begins (one more at the end)."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer text is a range of its own."""
    if len(texts) == 0:
        return
    _, bounds = flat(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(bounds, bounds[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` inside each range; 0 for an empty one."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
