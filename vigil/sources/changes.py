"""Changed rows of a master table as a streaming source.

``ChangeTableSource`` is a Python data source: the table (a folder of Parquet
files that its owner appends changed rows to) has an update time and a key. The
offset is the high-water mark (update time, key) together with the number of
rows in the overlap below it. A micro-batch reads the rows from the previous mark
less ``overlap_seconds`` up to the new mark, so that a row committed late, with
an update time below the mark, is still read: it changes the number of rows in
the overlap, hence the offset. Rows read before come again inside the overlap;
``read_changes`` removes them with ``dropDuplicatesWithinWatermark``, whose
state holds the overlap only. A row committed later than the overlap is not
seen (as with any high-water mark).

The mark is found from the files' row-group statistics and the rows of the
overlap; a batch is split by row groups, and only row groups that can hold
wanted rows are read, by the executors.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

MICROS = 1_000_000


def _dataset(path: str) -> pads.Dataset:
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        store, inner = fs.FileSystem.from_uri(path.replace("file:/", "file:///") if path.startswith("file:/") and not path.startswith("file://") else path)
        return pads.dataset(inner, format="parquet", filesystem=store)
    return pads.dataset(path, format="parquet")


def _time(micros: int, kind: pa.DataType) -> pa.Scalar:
    return pa.scalar(micros, pa.timestamp("us")).cast(pa.timestamp("us", kind.tz)).cast(kind)


def _micros(value: pa.Scalar) -> int:
    return value.cast(pa.timestamp("us", value.type.tz)).cast(pa.int64()).as_py()


def _as(column: pa.Array, kind: pa.DataType) -> pa.Array:
    """The column in the type that Spark expects; times without a zone (as in old Parquet files) are in UTC."""
    if pa.types.is_timestamp(kind) and column.type != kind:
        column = column.cast(pa.timestamp("us", column.type.tz), safe=False)
    return column if column.type == kind else column.cast(kind)


class Slice(InputPartition):
    """Row groups of one file, and the update times wanted from them."""

    def __init__(self, path: str, group: int, above: int | None, upto: int) -> None:
        super().__init__(f"{path}#{group}")
        self.path, self.groups, self.above, self.upto = path, [group], above, upto


class ChangeReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options) -> None:
        self.names, self.arrow = schema.names, to_arrow_schema(schema)
        self.path, self.time, self.key = options["path"], options["timecolumn"], options["keycolumn"]
        self.overlap = int(float(options.get("overlapseconds", "3600")) * MICROS)
        self.parts = int(options.get("partitions", "8"))

    def initialOffset(self) -> dict:
        return {"time": "", "key": "", "recent": 0}

    def _newest(self, data: pads.Dataset) -> int | None:
        """Greatest update time, from the statistics of the row groups where they have it."""
        kind, best = data.schema.field(self.time).type, None
        for fragment in data.get_fragments():
            footer = fragment.metadata
            at = [i for i in range(footer.num_columns) if footer.schema.column(i).path == self.time]
            for group in fragment.row_groups:
                column = footer.row_group(group.id).column(at[0])
                if column.physical_type == "INT64" and column.is_stats_set and column.statistics.has_min_max:
                    top = pa.scalar(column.statistics.max, kind)
                else:
                    top = pc.max(fragment.subset(row_group_ids=[group.id]).to_table(columns=[self.time]).column(0))
                if top.is_valid and (best is None or _micros(top) > best):
                    best = _micros(top)
        return best

    def latestOffset(self) -> dict:
        try:
            data = _dataset(self.path)
        except FileNotFoundError:
            return self.initialOffset()
        newest = self._newest(data) if data.schema.names else None
        if newest is None:
            return self.initialOffset()
        kind = data.schema.field(self.time).type
        recent, key = 0, ""
        for batch in data.to_batches(columns=[self.time, self.key], filter=pc.field(self.time) > _time(newest - self.overlap, kind)):
            recent += batch.num_rows
            last = batch.filter(pc.equal(batch.column(0), _time(newest, kind))).column(1)
            top = pc.max(last.cast(pa.string()))
            key = max(key, top.as_py() or "")
        return {"time": str(newest), "key": key, "recent": recent}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if start == end or not end["time"]:
            return []
        data = _dataset(self.path)
        kind = data.schema.field(self.time).type
        above = int(start["time"]) - self.overlap if start["time"] else None
        upto = int(end["time"])
        wanted = pc.field(self.time) <= _time(upto, kind)
        if above is not None:
            wanted = wanted & (pc.field(self.time) > _time(above, kind))
        found = [(f.path, g.id) for f in data.get_fragments(filter=wanted) for g in f.subset(filter=wanted).row_groups]
        most, out = -(-len(found) // self.parts), []
        for path, group in found:
            if out and out[-1].path == path and len(out[-1].groups) < most:
                out[-1].groups.append(group)
            else:
                out.append(Slice(path, group, above, upto))
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        data = _dataset(self.path)
        kind = data.schema.field(self.time).type
        wanted = pc.field(self.time) <= _time(partition.upto, kind)
        if partition.above is not None:
            wanted = wanted & (pc.field(self.time) > _time(partition.above, kind))
        part = data.format.make_fragment(partition.path, filesystem=data.filesystem, row_groups=partition.groups)
        for batch in part.to_batches(schema=data.schema, columns=self.names, filter=wanted):
            yield pa.RecordBatch.from_arrays([_as(c, f.type) for c, f in zip(batch.columns, self.arrow, strict=True)], schema=self.arrow)


class ChangeTableSource(DataSource):
    """Options: path, timeColumn, keyColumn, overlapSeconds (3600), partitions (8)."""

    @classmethod
    def name(cls) -> str:
        return "change_table"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ChangeReader(schema, {k.lower(): v for k, v in self.options.items()})


def read_changes(spark: SparkSession, path: str, schema: StructType, *, time_column: str = "update_timestamp", key_column: str = "customer_id",
                 overlap_seconds: int = 3600, partitions: int = 8) -> DataFrame:
    """The stream of changed rows of the table at ``path``, each (key, update time) once.

    Rows without an update time can't be ordered and aren't read. The watermark keeps the state of
    two overlaps: a late row stands at most one overlap below the mark of the batch before.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ChangeTableSource)
    rows = (spark.readStream.format("change_table").schema(schema).option("path", path).option("timeColumn", time_column)
            .option("keyColumn", key_column).option("overlapSeconds", str(overlap_seconds)).option("partitions", str(partitions)).load())
    kind = dict(rows.dtypes)[time_column]
    timed = rows if kind == "timestamp" else rows.withColumn("_update_time", rows[time_column].cast("timestamp"))
    watermark = time_column if kind == "timestamp" else "_update_time"
    once = timed.withWatermark(watermark, f"{2 * overlap_seconds + 1} seconds").dropDuplicatesWithinWatermark([key_column, time_column])
    return once.drop("_update_time")
