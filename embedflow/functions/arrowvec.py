"""Arrow helpers for Python stages: vector columns as numpy matrices without per-row objects.

``numbers``, ``column``, ``binary`` and ``built`` go by buffers: ``to_numpy`` and ``pa.array`` import pandas, which takes some 40 MB
in every Python worker.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def numbers(arr: pa.Array) -> np.ndarray:
    """A numeric array as numpy; with nulls, as ``to_numpy`` gives it."""
    return arr.to_numpy(zero_copy_only=False) if arr.null_count else np.from_dlpack(arr)


def column(values: np.ndarray) -> pa.Array:
    """Numbers as an Arrow array."""
    return pa.Array.from_buffers(pa.from_numpy_dtype(values.dtype), len(values), [None, pa.py_buffer(np.ascontiguousarray(values))])


def binary(values: list[bytes], kind: pa.DataType | None = None) -> pa.Array:
    """Bytes as a binary array, or as a string array."""
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.Array.from_buffers(kind or pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(values))])


def built(values: list, kind: pa.DataType) -> pa.Array:
    """Python values (None: null) as ``pa.array`` makes them, for texts, bytes, numbers, booleans, lists and structs of these."""
    n, there = len(values), [v is not None for v in values]
    valid = None if all(there) else pa.py_buffer(np.packbits(np.array(there, bool), bitorder="little"))
    if pa.types.is_struct(kind):
        children = [built([None if v is None else v[f.name] for v in values], f.type) for f in kind]
        return pa.Array.from_buffers(kind, n, [valid], children=children)
    if pa.types.is_boolean(kind):
        return pa.Array.from_buffers(kind, n, [valid, pa.py_buffer(np.packbits(np.array(values, bool), bitorder="little"))])
    if pa.types.is_integer(kind) or pa.types.is_float32(kind) or pa.types.is_float64(kind):
        dtype = np.dtype({"float": "f4"}.get(str(kind), str(kind)))
        return pa.Array.from_buffers(kind, n, [valid, pa.py_buffer(np.array([0 if v is None else v for v in values], dtype))])
    if not (pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_list(kind)):
        return pa.array(values, type=kind)
    rows = [() if v is None else v for v in values] if pa.types.is_list(kind) else [v.encode() if isinstance(v, str) else v or b"" for v in values]
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int64)
    if ends[-1] > np.iinfo(np.int32).max:
        raise ValueError(f"{ends[-1]} bytes or items don't fit one array")
    offsets = pa.py_buffer(ends.astype(np.int32))
    if pa.types.is_list(kind):
        return pa.Array.from_buffers(kind, n, [valid, offsets], children=[built([x for r in rows for x in r], kind.value_type)])
    return pa.Array.from_buffers(kind, n, [valid, offsets, pa.py_buffer(b"".join(rows))])


def list_lengths(arr: pa.Array) -> np.ndarray:
    """Lengths of a list<...> array (-1 for NULL rows)."""
    lens = numbers(pc.list_value_length(arr))
    return np.where(np.isnan(lens.astype(float)), -1, lens).astype(np.int64) if arr.null_count else lens.astype(np.int64)


def as_matrix(arr: pa.Array, rows: np.ndarray, dim: int, dtype=np.float64) -> np.ndarray:
    """Rows ``rows`` (all of length ``dim``) of a list<float> array as a (len(rows), dim) matrix."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    offsets = arr.offsets.to_numpy()
    flat = arr.values.to_numpy(zero_copy_only=False)
    if len(rows) == len(arr) and np.all(np.diff(offsets) == dim):
        return flat[offsets[0] : offsets[0] + len(arr) * dim].reshape(len(arr), dim).astype(dtype, copy=False)
    idx = offsets[rows][:, None] + np.arange(dim)[None, :]
    return flat[idx].astype(dtype, copy=False)
