"""Compare a Spark frame with a DuckDB relation: names, types, row counts, values."""

from __future__ import annotations

import math

import pyarrow as pa


def _type(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, list):
        return tuple(_cell(x) for x in v)
    return repr(v)


def _rows(table: pa.Table, names: list[str]) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_cell(v) for v in row) for row in zip(*columns, strict=True))


def differences(got: pa.Table, want: pa.Table) -> list[str]:
    names = sorted(want.column_names)
    if sorted(got.column_names) != names:
        return [f"columns {sorted(got.column_names)} != {names}"]
    out = []
    for n in names:
        a, b = _type(got.schema.field(n).type), _type(want.schema.field(n).type)
        if a != b:
            out.append(f"type of {n}: {a} != {b}")
    if got.num_rows != want.num_rows:
        return [*out, f"rows {got.num_rows} != {want.num_rows}"]
    a, b = _rows(got, names), _rows(want, names)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if bad:
        shown = [(n, p, q) for n, p, q in zip(names, *bad[0], strict=True) if p != q]
        out.append(f"{len(bad)} rows differ, first: {shown}")
    return out
