"""Binary Avro records in message payloads, decoded a batch at a time.

A payload begins with a zero byte and the four bytes of its writer's schema
number; the record follows.  All payloads of one schema in a batch are decoded
together, field by field: every row has a place in the batch's bytes, and a
field moves all places on at once.  What the writer wrote is then fitted to the
reader's columns by name: columns that the writer does not know are null, and
numbers widen.

Known kinds: null, boolean, int, long, float, double, bytes, string, enum,
fixed, records in records, and unions of these.  Arrays and maps are refused
when the schema is read, not when data are.  Defined results: a null payload, a
wrong first byte, an unknown schema number, bytes that end early or go on
after the record, and numbers, branches or symbols out of range give null.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

HEAD = 5  # bytes before the record
# The bytes that a varying-length number of 32 and of 64 bits has at most.
VARINT = {"int": 5, "long": 10}
FIXED_SIZE = {"float": (4, "<f4"), "double": (8, "<f8")}
ARROW = {"null": pa.null(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "float": pa.float32(),
         "double": pa.float64(), "bytes": pa.binary(), "string": pa.string(), "enum": pa.string(), "fixed": pa.binary()}


class _Rows:
    """Payloads of one schema: their bytes, and where each has come to."""

    def __init__(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> None:
        # bytes after the last one, so that a look beyond an end finds something
        self.data = np.concatenate([data, np.zeros(16, np.uint8)])
        self.at, self.end = at.copy(), end
        self.good = at <= end

    def __len__(self) -> int:
        return len(self.at)

    def _check(self, fine: np.ndarray) -> None:
        self.good &= fine
        self.at = np.where(self.good, self.at, self.end)

    def number(self, kind: str, rows: np.ndarray | None = None) -> np.ndarray:
        """Zig-zag numbers of varying length, for ``rows`` or all."""
        value, going = np.zeros(len(self), np.uint64), self.good.copy() if rows is None else self.good & rows
        for i in range(VARINT[kind]):
            self._check(~going | (self.at < self.end))
            going &= self.good
            part = self.data[self.at]
            value |= np.where(going, (part & 127).astype(np.uint64) << np.uint64(7 * i), np.uint64(0))
            self.at = self.at + going
            going &= part > 127
        self._check(~going)
        found = (value >> np.uint64(1)).astype(np.int64) ^ -(value & np.uint64(1)).astype(np.int64)
        if kind == "int":
            self._check((found >= -(1 << 31)) & (found < 1 << 31))
        return np.where(self.good, found, 0)

    def span(self, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and sizes of the next bytes of ``rows``; others get none."""
        self._check(~rows | ((sizes >= 0) & (sizes <= self.end - self.at)))
        sizes = np.where(self.good & rows, sizes, 0)
        start, self.at = self.at, self.at + sizes
        return start, sizes

    def slices(self, start: np.ndarray, sizes: np.ndarray) -> tuple[pa.Buffer, pa.Buffer]:
        ends = np.concatenate([[0], np.cumsum(sizes)])
        place = np.repeat(start - ends[:-1], sizes) + np.arange(ends[-1])
        return pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(self.data[place].tobytes())


def _text(rows: _Rows, start: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets, body = rows.slices(start, sizes)
    found = pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, body])
    try:
        return found.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no text make their row null
        texts = []
        for i, raw in enumerate(found.to_pylist()):
            try:
                texts.append(raw.decode())
            except UnicodeDecodeError:
                texts.append("")
                rows.good[i] = False
        return pa.array(texts, pa.string())


def _plain(schema: Any) -> Any:
    """A schema without wrappers such as {"type": {"type": ...}}; unknown kinds are refused."""
    if isinstance(schema, list):
        return [_plain(s) for s in schema]
    if isinstance(schema, str):
        schema = {"type": schema}
    if not isinstance(schema["type"], str):
        return _plain(schema["type"])
    if schema["type"] == "record":
        return {"type": "record", "fields": [{"name": f["name"], "type": _plain(f["type"])} for f in schema["fields"]]}
    if schema["type"] not in ARROW:
        raise ValueError(f"Avro type {schema['type']} is not supported")
    return schema


def _arrow(schema: Any) -> pa.DataType:
    if isinstance(schema, list):
        kinds = {_arrow(s) for s in schema} - {pa.null()}
        if len(kinds) > 1:
            raise ValueError("a union of several kinds has no column type")
        return kinds.pop() if kinds else pa.null()
    if schema["type"] == "record":
        return pa.struct([(f["name"], _arrow(f["type"])) for f in schema["fields"]])
    return ARROW[schema["type"]]


def _decode(rows: _Rows, schema: Any, present: np.ndarray) -> pa.Array:
    """Values of the rows that are ``present``; null for the others."""
    if isinstance(schema, list):
        branch = rows.number("long", present)
        rows._check(~present | ((branch >= 0) & (branch < len(schema))))
        found: pa.Array = pa.nulls(len(rows), _arrow(schema))
        for i, option in enumerate(schema):
            mine = present & rows.good & (branch == i)
            value = _decode(rows, option, mine)
            if option["type"] != "null":
                found = pa.compute.if_else(pa.array(mine), value, found)
        return found
    kind = schema["type"]
    gone = pa.array(~present)
    if kind == "record":
        parts = [_decode(rows, f["type"], present) for f in schema["fields"]]
        return pa.StructArray.from_arrays(parts, fields=list(_arrow(schema)), mask=gone)
    if kind == "null":
        return pa.nulls(len(rows))
    if kind in VARINT:
        return pa.array(rows.number(kind, present).astype(np.int32 if kind == "int" else np.int64), mask=~present)
    if kind == "boolean":
        start, _ = rows.span(np.ones(len(rows), np.int64), present)
        value = rows.data[start]
        rows._check(~present | (value < 2))
        return pa.array(value == 1, mask=~present)
    if kind in FIXED_SIZE:
        size, code = FIXED_SIZE[kind]
        start, _ = rows.span(np.full(len(rows), size), present)
        value = rows.data[np.where(rows.good & present, start, 0)[:, None] + np.arange(size)].copy().view(code)[:, 0]
        return pa.array(value.astype(code[1:]), mask=~present)
    if kind == "enum":
        place = rows.number("int", present)
        symbols = schema["symbols"]
        rows._check(~present | ((place >= 0) & (place < len(symbols))))
        return pa.array(symbols, pa.string()).take(pa.array(np.where(rows.good & present, place, 0), mask=~present))
    sizes = np.full(len(rows), schema["size"]) if kind == "fixed" else rows.number("long", present)
    start, sizes = rows.span(sizes, present)
    if kind == "string":
        value = _text(rows, start, sizes)
    else:
        offsets, body = rows.slices(start, sizes)
        value = pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, body])
    return pa.compute.if_else(pa.array(present), value, pa.scalar(None, value.type))


def _decoder(payload: str, into: str, writers: dict[int, Any], target: pa.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(payload).cast(pa.binary())
            known = column.is_valid().to_numpy(zero_copy_only=False)
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
            body = column.buffers()[2]
            data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
            start, end = offsets[:-1], offsets[1:]
            headed = known & (end - start >= HEAD)
            head = np.concatenate([data, np.zeros(HEAD, np.uint8)])[np.where(headed, start, 0)[:, None] + np.arange(HEAD)].astype(np.int64)
            number = (head[:, 1:] << np.array([24, 16, 8, 0])).sum(1)
            headed &= head[:, 0] == 0
            parts, order = [], []
            for writer, schema in writers.items():
                mine = np.flatnonzero(headed & (number == writer))
                if not len(mine):
                    continue
                rows = _Rows(data, start[mine] + HEAD, end[mine])
                found = _decode(rows, schema, np.ones(len(mine), bool))
                good = rows.good & (rows.at == rows.end)
                values = [found.field(f.name).cast(f.type) if found.type.get_field_index(f.name) >= 0 else pa.nulls(len(mine), f.type)
                          for f in target]
                parts.append(pa.StructArray.from_arrays(values, fields=list(target), mask=pa.array(~good)))
                order.append(mine)
            rest = np.setdiff1d(np.arange(len(column)), np.concatenate(order) if order else [])
            parts.append(pa.nulls(len(rest), target))
            order.append(rest)
            places = np.empty(len(column), np.int64)
            places[np.concatenate(order).astype(np.int64)] = np.arange(len(column))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.concat_arrays(parts).take(pa.array(places))],
                                             [*batch.schema.names, into])
    return run


def decode_avro_payloads(df: DataFrame, payload: str, writers: Mapping[int, str], reader: T.StructType, into: str = "record") -> DataFrame:
    """Adds ``into``: the record of ``payload`` in the columns of ``reader``, null where it cannot be read.

    ``writers`` has the schema, as JSON, of each number that payloads may carry.
    """
    schemas = {n: _plain(json.loads(s)) for n, s in writers.items()}
    for schema in schemas.values():
        if isinstance(schema, list) or schema["type"] != "record":
            raise ValueError("a payload holds a record")
        _arrow(schema)
    kept = df.drop(into)
    out = T.StructType([*kept.schema.fields, T.StructField(into, reader)])
    return kept.mapInArrow(_decoder(payload, into, schemas, to_arrow_type(reader)), out)


def _bytes_of(number: Column, size: int) -> Column:
    return F.unhex(F.lpad(F.hex(number), 2 * size, "0"))


def avro_number(value: Column) -> Column:
    """A whole number as Avro writes it; for making payloads from columns."""
    value = value.cast("long")
    zigzag = F.shiftleft(value, 1).bitwiseXOR(F.shiftright(value, 63))
    parts = []
    for i in range(VARINT["long"]):
        left = F.shiftrightunsigned(zigzag, 7 * i)
        more = F.shiftrightunsigned(zigzag, 7 * i + 7) != 0 if i < 9 else F.lit(False)
        one = _bytes_of(left.bitwiseAND(F.lit(127)) + F.when(more, 128).otherwise(0), 1)
        parts.append(one if i == 0 else F.when(left != 0, one).otherwise(F.lit(b"")))
    return F.concat(*parts)


def avro_text(value: Column) -> Column:
    return F.concat(avro_number(F.octet_length(value)), value.cast("binary"))


def avro_payload(schema_number: int, *fields: Column) -> Column:
    """A payload of encoded fields under a schema's number."""
    return F.concat(F.lit(b"\0" + schema_number.to_bytes(4, "big")), *fields)
