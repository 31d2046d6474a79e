"""A streaming sink whose batches become visible as a whole: ``writeStream.format("committed_files")``.

A task writes its rows to a file of its own below ``data`` and returns the file's name as its commit message.
When all tasks of a batch are through, the driver lists their files in ``commits/batch-n.json``, which appears under
that name in one step. Readers take the files of such lists only, so rows of failed or repeated tasks and of batches
that were cut short are never seen. A batch that comes again after its list was written changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Written(WriterCommitMessage):
    """The file that a task wrote, and its rows; no name if there were none."""

    name: str | None
    rows: int


class CommittedFilesWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _open(self) -> tuple[pafs.FileSystem, str]:
        files, root = pafs.FileSystem.from_uri(self.path)
        for folder in ("data", "commits"):
            files.create_dir(f"{root}/{folder}", recursive=True)
        return files, root

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = self._open()
        name, rows, writer = f"part-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                writer = writer or pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=files)
                writer.write_batch(batch)
                rows += batch.num_rows
            if writer:
                writer.close()
        except BaseException:
            if writer:
                writer.close()
                files.delete_file(f"{root}/data/{name}")
            raise
        return Written(name if writer else None, rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        files, root = self._open()
        final = f"{root}/commits/batch-{batchId}.json"
        if files.get_file_info(final).type != pafs.FileType.NotFound:
            self.abort(messages, batchId)
            return
        lines = [json.dumps({"batch_id": batchId, "name": m.name, "rows": m.rows}) for m in messages if m and m.name]
        # A name that begins with a dot is not read as data.
        draft = f"{root}/commits/.batch-{batchId}-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write("\n".join(lines).encode())
        files.move(draft, final)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        """Take back the files of the tasks that did finish."""
        files, root = self._open()
        for m in messages:
            if m and m.name and files.get_file_info(f"{root}/data/{m.name}").type != pafs.FileType.NotFound:
                files.delete_file(f"{root}/data/{m.name}")


class CommittedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_files"

    def streamWriter(self, schema: StructType, overwrite: bool) -> CommittedFilesWriter:
        return CommittedFilesWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make ``committed_files`` known to the session."""
    spark.dataSource.register(CommittedFiles)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """``(batch_id, name, rows)`` of every file that counts."""
    schema = "batch_id BIGINT, name STRING, rows BIGINT"
    try:
        return spark.read.schema(schema).json(f"{path}/commits")
    except AnalysisException as error:  # no batch yet
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all batches that were committed. The names of the files come to the driver, as for any table."""
    names = [r["name"] for r in commits(spark, path).select("name").collect()]
    reader = spark.read.schema(schema)
    return reader.parquet(*[f"{path}/data/{n}" for n in names]) if names else spark.createDataFrame([], schema)
