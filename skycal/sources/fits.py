"""Object catalogues in binary tables of FITS files, one file per image.

Spark lists and distributes the files; the helper below only gives the bytes of one table a numpy
type. A file is one chip's catalogue, some tens of megabytes, so it fits in a task."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skycal.functions.names import base_name
from skycal.schemas import OBJECT_CATALOG

_BLOCK, _CARD = 2880, 80
# The format's column codes and their big-endian types.
_TYPES = {"L": "S1", "B": "u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8", "A": "S"}


def _header(data: bytes, at: int) -> tuple[dict[str, str], int]:
    """Keyword values of the header at an offset, and the offset of the data behind it."""
    cards: dict[str, str] = {}
    for i in range(at, len(data), _CARD):
        card = data[i:i + _CARD].decode("ascii", "replace")
        if card[:8].strip() == "END":
            return cards, -(-(i + _CARD - at) // _BLOCK) * _BLOCK + at
        if card[8:10] == "= ":
            text = re.match(r"\s*'((?:[^']|'')*)'", card[10:])
            cards[card[:8].strip()] = text.group(1).rstrip() if text else card[10:].split("/")[0].strip()
    raise ValueError("header without END")


def _size(cards: dict[str, str]) -> int:
    axes = [int(cards[f"NAXIS{i + 1}"]) for i in range(int(cards.get("NAXIS", 0)))]
    cells = int(np.prod(axes)) if axes else 0
    total = abs(int(cards["BITPIX"])) // 8 * int(cards.get("GCOUNT", 1)) * (int(cards.get("PCOUNT", 0)) + cells)
    return -(-total // _BLOCK) * _BLOCK


def table_of(data: bytes, ext: int) -> np.ndarray:
    """The binary table in extension ext (0 is the primary unit) as a structured array."""
    cards, start = _header(data, 0)
    for _ in range(ext):
        cards, start = _header(data, start + _size(cards))
    fields = []
    for i in range(1, int(cards["TFIELDS"]) + 1):
        count, code = re.match(r"(\d*)([A-Z])", cards[f"TFORM{i}"]).groups()
        if code not in _TYPES or f"TSCAL{i}" in cards or f"TZERO{i}" in cards:
            fields.append((f"_skip{i}", "V", _width(count, code)))
        elif code == "A":
            fields.append((cards[f"TTYPE{i}"], f"S{count or 1}"))
        else:
            fields.append((cards[f"TTYPE{i}"], _TYPES[code], *([(int(count),)] if count not in ("", "1") else [])))
    dtype = np.dtype([(n, f"V{w[0]}") if t == "V" else (n, t, *w) for n, t, *w in fields])
    if dtype.itemsize != int(cards["NAXIS1"]):
        raise ValueError("column formats do not add up to the row length")
    return np.frombuffer(data, dtype, int(cards["NAXIS2"]), start)


def _width(count: str, code: str) -> int:
    unit = {"X": 1 / 8, "C": 8, "M": 16, "P": 8, "Q": 16}.get(code) or np.dtype(_TYPES[code]).itemsize or 1
    return int(-(-(int(count or 1) * unit) // 1))


def read_fits_catalogs(spark: SparkSession, path: str | list[str], ext: int = 2,
                       schema: T.StructType = OBJECT_CATALOG) -> DataFrame:
    """The schema's columns of the table in extension ext of every file under the path, FILENAME taken from the file.
    A file that cannot be read as such a table, a compressed one too, raises; none is passed over."""
    names = [f.name for f in schema.fields if f.name != "FILENAME"]
    wanted = T.StructType([f for f in schema.fields if f.name != "FILENAME"] + [T.StructField("_path", T.StringType())])
    arrow = {f.name: _arrow_type(f.dataType) for f in wanted.fields}

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                table = table_of(content.as_py(), ext)
                columns = [_column(table[n], arrow[n]) for n in names]
                columns.append(pa.array([path.as_py()] * len(table), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "_path"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(decode, wanted).withColumn("FILENAME", base_name(F.col("_path"))).drop("_path")


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    return {T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.DoubleType: pa.float64(),
            T.StringType: pa.string()}[type(t)]


def _column(values: np.ndarray, to: pa.DataType) -> pa.Array:
    if pa.types.is_string(to):
        return pa.array([v.decode("ascii", "replace").rstrip() for v in values], to)
    if pa.types.is_list(to):
        flat = pa.array(np.ascontiguousarray(values, dtype=to.value_type.to_pandas_dtype()).reshape(-1))
        width = values.shape[1] if values.ndim == 2 else 1
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width), pa.int32()), flat)
    return pa.array(np.ascontiguousarray(values, dtype=to.to_pandas_dtype()))
