"""STRM1: a streaming source that reads a growing table by the largest value of a column.

``spark.readStream.format("max_value").schema(...).option("path", ...).option("column", ...)``
reads a folder of Parquet files that only gets rows with larger values: the offset is the
largest value read, and a batch holds the rows above it.  The driver reads footers only
(a file's footer once); a batch's partitions are the row groups whose statistics reach
into its range, so what was read before is not read again.  As with any max-value source,
a row that arrives with a value at or below the offset is not seen.

Files are reached through Arrow's file systems.  The column is an integer, a date or a
timestamp without NULLs in the row groups to read; rows with a NULL there are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def as_number(value) -> int:
    """A value of the column as a whole number that orders like it."""
    scalar = value if isinstance(value, pa.Scalar) else pa.scalar(value)
    if pa.types.is_date(scalar.type) or pa.types.is_timestamp(scalar.type):
        scalar = scalar.cast(pa.timestamp("us")).cast(pa.int64())
    return scalar.as_py()


class RowGroup(InputPartition):
    def __init__(self, path: str, number: int, above: int | None, upto: int):
        self.path, self.number, self.above, self.upto = path, number, above, upto


class MaxValueReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.column, self.uri = schema, options["column"], options["path"]
        self.footers: dict[tuple, list[tuple[int, int, int]]] = {}

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.uri if "://" in self.uri else f"file://{self.uri}")

    def _row_groups(self) -> Iterator[tuple[str, int, int, int]]:
        """(file, row group, least, largest) of the folder as it is now."""
        store, folder = self._store()
        for info in store.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True)):
            if info.type != fs.FileType.File or info.base_name.startswith(("_", ".")) or not info.base_name.endswith(".parquet"):
                continue
            key = (info.path, info.size, info.mtime_ns)
            if key not in self.footers:
                with store.open_input_file(info.path) as f:
                    self.footers[key] = list(self._ranges(pq.ParquetFile(f).metadata))
            for number, least, largest in self.footers[key]:
                yield info.path, number, least, largest

    def _ranges(self, footer: pq.FileMetaData) -> Iterator[tuple[int, int, int]]:
        at = footer.schema.to_arrow_schema().get_field_index(self.column)
        for number in range(footer.num_row_groups):
            chunk = footer.row_group(number).column(at)
            if not chunk.is_stats_set or not chunk.statistics.has_min_max:
                if footer.row_group(number).num_rows:
                    raise ValueError(f"row group without statistics of {self.column}")
                continue
            yield number, as_number(chunk.statistics.min), as_number(chunk.statistics.max)

    def initialOffset(self) -> dict:
        return {"value": None}

    def latestOffset(self) -> dict:
        return {"value": max((largest for *_, largest in self._row_groups()), default=None)}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        above, upto = start["value"], end["value"]
        if upto is None or above is not None and upto <= above:
            return []
        return [RowGroup(path, n, above, upto) for path, n, least, largest in self._row_groups() if least <= upto and (above is None or largest > above)]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        store, _ = self._store()
        wanted = to_arrow_schema(self.schema)
        with store.open_input_file(partition.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(row_groups=[partition.number], columns=list({*wanted.names, self.column})):
                values = batch.column(batch.schema.get_field_index(self.column))
                if not pa.types.is_integer(values.type):
                    values = values.cast(pa.timestamp("us")).cast(pa.int64())
                keep = pc.less_equal(values, partition.upto)
                if partition.above is not None:
                    keep = pc.and_(keep, pc.greater(values, partition.above))
                kept = batch.filter(keep, null_selection_behavior="drop").select(wanted.names)
                yield from pa.Table.from_batches([kept]).cast(wanted).to_batches()


class MaxValueSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "max_value"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return MaxValueReader(schema, self.options)


def max_value_stream(spark: SparkSession, path: str, schema: StructType | str, column: str):
    """STRM1: the rows of a growing table, by the largest value of ``column`` read so far."""
    spark.dataSource.register(MaxValueSource)
    return spark.readStream.format("max_value").schema(schema).option("column", column).load(path)
