"""A streaming source for a growing table, read in order of an offset column: ``readStream.format("offset_table")``.

Spark keeps the offsets and commits in the checkpoint; the source only says which range comes next and how it is
split. The table is a folder of Parquet files, opened with Arrow's file systems, so a path can be local, ``hdfs://`` or
``s3://``. Options:

- ``path``: the folder;
- ``offsetcolumn``: a stored column that new rows have greater values of;
- ``startingoffset``: ``earliest`` (default), ``latest`` or a value; the first range includes its start;
- ``maxrows``: rows per trigger, about: whole row groups are admitted, at least one.

Ranges and row counts come from the files' footers, so nothing but footers is read on the driver. Each row group
that can hold rows of the range is a partition of its own. Rows whose offset is NULL are never read, and rows
that arrive late with an offset below the last end stay unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

EARLIEST, LATEST = "earliest", "latest"


@dataclass
class RowGroup(InputPartition):
    """One row group and the range of offsets to take from it."""

    path: str
    group: int
    start: str
    end: str
    inclusive: bool


@dataclass
class Span:
    path: str
    group: int
    rows: int
    low: object
    high: object


class OffsetTableReader(DataSourceStreamReader):
    """Offsets are ``{"offset": text or null, "inclusive": bool}``; a range goes from a start, with it if it is inclusive."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.column = options["path"], options["offsetcolumn"]
        self.starting = options.get("startingoffset", EARLIEST)
        self.most = int(options["maxrows"]) if options.get("maxrows") else None
        self.names = schema.names
        self.at: dict | None = None

    def _table(self) -> pads.FileSystemDataset:
        return pads.dataset(self.path, format="parquet")

    def _spans(self, table: pads.FileSystemDataset) -> list[Span]:
        """Row groups with the smallest and largest offset that their footers state."""
        found, place = [], None
        for fragment in table.get_fragments():
            meta = fragment.metadata
            place = meta.schema.to_arrow_schema().get_field_index(self.column) if place is None else place
            for i in range(meta.num_row_groups):
                stats = meta.row_group(i).column(place).statistics
                if stats is None or not stats.has_min_max:
                    if meta.row_group(i).num_rows and (stats is None or stats.num_values):
                        raise ValueError(f"{fragment.path} has no statistics of {self.column}")
                    continue
                found.append(Span(fragment.path, i, meta.row_group(i).num_rows, stats.min, stats.max))
        return found

    def _value(self, text: str, kind: pa.DataType):
        return pa.scalar(text).cast(kind).as_py()

    def _text(self, value) -> str:
        return value.isoformat() if hasattr(value, "isoformat") else str(value)

    def _kind(self, table: pads.FileSystemDataset) -> pa.DataType:
        return table.schema.field(self.column).type

    def initialOffset(self) -> dict:
        if self.starting not in (EARLIEST, LATEST):
            return {"offset": self.starting, "inclusive": True}
        spans = self._spans(self._table())
        if not spans:
            return {"offset": None, "inclusive": True}
        first = min(s.low for s in spans) if self.starting == EARLIEST else max(s.high for s in spans)
        return {"offset": self._text(first), "inclusive": True}

    def latestOffset(self) -> dict:
        """The end of the next range: of all that is new, or of the first row groups that hold ``maxrows`` rows."""
        self.at = self.at or self.initialOffset()
        table = self._table()
        spans = self._spans(table)
        if self.at["offset"] is not None and spans:
            start = self._value(self.at["offset"], self._kind(table))
            spans = [s for s in spans if s.high > start or (self.at["inclusive"] and s.high == start)]
        if not spans:
            return self.at
        spans.sort(key=lambda s: s.high)
        end, rows = spans[-1].high, 0
        for i, s in enumerate(spans):
            rows += s.rows
            if self.most and rows > self.most and i:
                end = spans[i - 1].high
                break
        self.at = {"offset": self._text(end), "inclusive": False}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        # After a restart Spark tells the position by an empty range.
        self.at = end
        if start == end or end["offset"] is None:
            return []
        table = self._table()
        kind, spans = self._kind(table), self._spans(table)
        low = self._value(start["offset"], kind) if start["offset"] is not None else min((s.low for s in spans), default=None)
        high = self._value(end["offset"], kind)
        inclusive = start["inclusive"]
        return [RowGroup(s.path, s.group, self._text(low), end["offset"], inclusive) for s in spans
                if s.low <= high and (s.high > low or (inclusive and s.high == low))]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        table = self._table()
        fragment = table.format.make_fragment(partition.path, filesystem=table.filesystem, row_groups=[partition.group])
        kind = self._kind(table)
        offset = pads.field(self.column)
        low, high = (pa.scalar(v).cast(kind) for v in (partition.start, partition.end))
        within = ((offset >= low) if partition.inclusive else (offset > low)) & (offset <= high)
        for batch in fragment.to_batches(schema=table.schema, columns=self.names, filter=within):
            if batch.num_rows:
                # Spark's timestamps without a zone are in microseconds.
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(c, pa.timestamp("us", c.type.tz)) if pa.types.is_timestamp(c.type) else c for c in batch.columns], names=self.names)

    def commit(self, end: dict) -> None:
        """Nothing is held for a range, so there is nothing to let go."""


class OffsetTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "offset_table"

    def schema(self) -> StructType:
        return from_arrow_schema(pads.dataset(self.options["path"], format="parquet").schema)

    def streamReader(self, schema: StructType) -> OffsetTableReader:
        return OffsetTableReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Make ``offset_table`` known to the session."""
    spark.dataSource.register(OffsetTable)
