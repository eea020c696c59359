"""CSV files of one kind whose columns stand in different orders, or are missing in some, as one table by column name."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skycal.operators.catalog import stack_catalogs

MAX_HEADERS = 1000      # different headers under one path; more of them are files that do not belong together
_WHOLE = str(1 << 50)   # bytes: no file is split or packed together with others while headers are read


def _first_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that is not blank, of the one file that a task has. The rest of the file is not asked for."""
    for batch in batches:
        for line, path in zip(batch.column("value").to_pylist(), batch.column("path").to_pylist()):
            if line.strip():
                yield pa.RecordBatch.from_arrays([pa.array([line]), pa.array([path])], names=["header", "path"])
                return


def read_headers(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(header, path): the first line of every file under a path. Each file is one task, which ends after its first
    lines: bodies are not read. Files without a line are not among them."""
    session = spark.newSession()      # the same context; its own settings
    for key in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"):
        session.conf.set(key, _WHOLE)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    reader = session.read.option("recursiveFileLookup", True)
    lines = (reader.option("pathGlobFilter", glob) if glob else reader).text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("path")).mapInArrow(_first_records, "header string, path string")


def header_groups(spark: SparkSession, path: str | list[str], sep: str = ",", glob: str | None = None) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of every different header. Like Spark's own file index, the driver holds the paths, and
    nothing of what is in the files but their different first lines."""
    found = read_headers(spark, path, glob).groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    rows = found.orderBy("header").limit(MAX_HEADERS + 1).collect()
    if len(rows) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers under {path}")
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in rows:
        # A byte-order mark and spaces around names don't make another column.
        names = tuple(n.strip() for n in next(csv.reader([r.header.removeprefix("﻿")], delimiter=sep)))
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"column {twice[0]!r} stands twice in the header of {r.paths[0]}")
        groups.setdefault(names, []).extend(unquote(p) for p in r.paths)
    return [(list(names), paths) for names, paths in groups.items()]


def _same_type(kinds: list[T.DataType]) -> T.DataType:
    """What holds the values of all inferred types: whole numbers, else doubles, else text."""
    kinds = [k for k in kinds if not isinstance(k, T.NullType)] or [T.StringType()]
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return T.LongType()
    return T.DoubleType() if all(isinstance(k, T.NumericType) for k in kinds) else T.StringType()


def read_csv_by_header(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, sep: str = ",",
                       glob: str | None = None, multiline: bool = False) -> DataFrame:
    """All header CSV files under a path as one table, columns by name: one scan for each different header, whatever
    the number of files, and a union of them. A column that a file lacks is NULL in its rows.

    With a schema, the result has its columns in its order, and the scans read no others; a column that no file has is
    NULL throughout. Without one, types are inferred for each header and widened to what holds them all, and columns come in the order of first
    appearance. Quoted fields may hold separators and quotes, and with multiline line ends too; empty fields and NaN are
    NULL as they are parsed, so filters reach the files. No files, or empty ones only: an empty table of the schema,
    and without one an error."""
    frames, inferred = [], []
    for names, files in header_groups(spark, path, sep, glob):
        reader = spark.read.option("header", True).option("sep", sep).option("nullValue", "NaN").option("quote", '"').option("escape", '"').option(
            "multiLine", multiline).option("ignoreLeadingWhiteSpace", False)
        if schema is None:
            frame = reader.option("inferSchema", True).csv(files)
        else:
            known = {f.name: f.dataType for f in schema.fields}
            types = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])
            frame = reader.schema(types).csv(files)
        frame = frame.toDF(*names)
        text = schema is None and all(isinstance(f.dataType, T.StringType) for f in frame.schema.fields)
        nothing = text and frame.isEmpty()      # a header alone tells no types
        inferred.append({f.name: T.NullType() if nothing else f.dataType for f in frame.schema.fields})
        frames.append(frame if schema is None else frame.select(*[F.col(f"`{n}`") for n in names if n in known]))
    if not frames and schema is None:
        raise ValueError(f"no file with a header under {path}")
    if schema is None:
        every = {n: _same_type([k[n] for k in inferred if n in k]) for kinds in inferred for n in kinds}
        frames = [f.select(*[F.col(f"`{n}`").cast(every[n]).alias(n) for n in f.columns]) for f in frames]
        return stack_catalogs(frames)
    if not frames:
        return spark.createDataFrame([], schema)
    table = stack_catalogs(frames)
    return table.select(*[F.col(f"`{f.name}`") if f.name in table.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
