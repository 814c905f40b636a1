"""What Parquet files say of themselves, read by tasks from their footers alone."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "array<struct<name: string, type: string>>"
FOOTER = (
    "path string, row_count bigint, group_count int, largest_group_rows bigint,"
    f" largest_group_bytes bigint, codecs string, writer string, in_order boolean, columns {COLUMNS}"
)
#: Where Spark keeps the schema it wrote, with the metadata of its columns.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
#: How each side names a type.
_TYPE_NAMES = {
    "int64": "bigint", "int32": "int", "int16": "smallint", "int8": "tinyint", "bool": "boolean",
    "date32[day]": "date", "large_string": "string",
}
#: Stores that have another name there.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def stamped(rows: DataFrame, options: dict[str, str]) -> DataFrame:
    """Rows whose footers will name the options of their writer.

    A footer names the codec of each column, but not its level; metadata of the columns is kept
    in the schema that Spark stores with each file.
    """
    note = {"writer": writer_note(options)}
    return rows.select(*[F.col(f"`{name}`").alias(name, metadata=note) for name in rows.columns])


def writer_note(options: dict[str, str]) -> str:
    return json.dumps(options, sort_keys=True)


def footers(spark: SparkSession, folders: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per Parquet file below some folders, from its footer; no column is read.

    Bytes of a row group are those stored. `writer` is what `stamped` left, the same in all
    columns, else NULL. `in_order` says whether the row groups of a file follow each other by the
    first column of `order` that it holds; it is NULL where statistics are missing. Executors open
    the files with the file systems that Arrow knows.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(list(folders))
        .select("path")
    )
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_footer(path, list(order)) for path in batch.column(0).to_pylist()]
            rows = [dict(zip(_ARROW_FOOTER.names, row, strict=True)) for row in found]
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_FOOTER)

    return listed.mapInArrow(read, FOOTER)


_ARROW_FOOTER = pa.schema(
    [
        ("path", pa.string()),
        ("row_count", pa.int64()),
        ("group_count", pa.int32()),
        ("largest_group_rows", pa.int64()),
        ("largest_group_bytes", pa.int64()),
        ("codecs", pa.string()),
        ("writer", pa.string()),
        ("in_order", pa.bool_()),
        ("columns", pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))),
    ]
)


def _opened(path: str):
    scheme, _, rest = path.partition(":")
    uri = f"{_SCHEMES.get(scheme, scheme)}://{rest.removeprefix('//')}"
    files, name = pafs.FileSystem.from_uri(uri)
    return files.open_input_file(name)


def _footer(path: str, order: list[str]) -> tuple:
    with _opened(path) as opened:
        file = pq.ParquetFile(opened)
        footer, schema = file.metadata, file.schema_arrow
    groups = [footer.row_group(i) for i in range(footer.num_row_groups)]
    chunks = [[group.column(i) for i in range(group.num_columns)] for group in groups]
    place = {chunk.path_in_schema: i for i, chunk in enumerate(chunks[0])} if chunks else {}
    leading = next((place[name] for name in order if name in place), None)
    columns = [{"name": field.name, "type": _type_name(field.type)} for field in schema]
    return (
        path,
        footer.num_rows,
        len(groups),
        max((group.num_rows for group in groups), default=0),
        max((sum(chunk.total_compressed_size for chunk in row) for row in chunks), default=0),
        ",".join(sorted({chunk.compression.lower() for row in chunks for chunk in row})),
        _writer(footer.metadata or {}),
        _ascending([row[leading].statistics for row in chunks]) if leading is not None else None,
        columns,
    )


def _type_name(arrow: pa.DataType) -> str:
    if pa.types.is_timestamp(arrow):
        return "timestamp"
    if pa.types.is_decimal(arrow):
        return f"decimal({arrow.precision},{arrow.scale})"
    return _TYPE_NAMES.get(str(arrow), str(arrow))


def _writer(metadata: dict[bytes, bytes]) -> str | None:
    fields = json.loads(metadata.get(_SPARK_SCHEMA, b"{}")).get("fields", [])
    notes = {field["metadata"].get("writer") for field in fields}
    return notes.pop() if len(notes) == 1 else None


def _ascending(statistics: list) -> bool | None:
    if not all(one is not None and one.has_min_max for one in statistics):
        return None
    return all(a.max <= b.min for a, b in zip(statistics, statistics[1:]))
