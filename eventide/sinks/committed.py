"""A file sink whose rows become visible by commit only.

Every task attempt writes files under names of its own and reports them in its commit
message. When all tasks of a micro-batch are done, the driver writes one small list of the reported
files, named after the batch, and readers take the files that such lists name. So

* an attempt that is killed, fails, or runs twice leaves files that no list names: no reader sees them;
* a batch that fails as a whole is aborted, and what its finished tasks wrote is deleted;
* a batch replayed after a failure finds its list and commits nothing again (its files are deleted).

A list is written under a hidden name and renamed, so that it is there whole or not at all.
One query writes to a table. Batch ids are those of that query's checkpoint, which must not be
changed for another while the table stays. Files of attempts that were never reported are removed by
:func:`remove_orphans`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as pafs
from pyarrow import parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from ..session import register_source
from ..sources.lines import file_system
from .writers import _trigger

FORMAT = "committed_files"
FILES, COMMITS = "files", "commits"


@dataclass
class Written(WriterCommitMessage):
    """The files of one task attempt and the rows in them."""
    files: list[str] = field(default_factory=list)
    rows: int = 0


def _commit_path(path: str, batch_id: int) -> str:
    return f"{path}/{COMMITS}/{batch_id}.json"


class CommittedWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, file_rows: int):
        self.path, self.file_rows = path, file_rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One attempt: a file per ``file_rows`` rows or so, none without rows."""
        fs, root = file_system(self.path)
        fs.create_dir(f"{root}/{FILES}", recursive=True)
        done, out, held = Written(), None, 0
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    name, held = f"{uuid.uuid4().hex}.parquet", 0
                    out = pq.ParquetWriter(f"{root}/{FILES}/{name}", batch.schema, filesystem=fs)
                    done.files.append(name)
                out.write_batch(batch)
                held += batch.num_rows
                done.rows += batch.num_rows
                if held >= self.file_rows:
                    out.close()
                    out = None
        finally:
            if out is not None:
                out.close()
        return done

    def _delete(self, messages) -> None:
        fs, root = file_system(self.path)
        for m in messages:
            for name in m.files if m else ():
                if fs.get_file_info(f"{root}/{FILES}/{name}").type == pafs.FileType.File:
                    fs.delete_file(f"{root}/{FILES}/{name}")

    def commit(self, messages, batchId: int) -> None:
        fs, root = file_system(self.path)
        target = _commit_path(root, batchId)
        if fs.get_file_info(target).type == pafs.FileType.File:  # replayed
            self._delete(messages)
            return
        fs.create_dir(f"{root}/{COMMITS}", recursive=True)
        temp = f"{root}/{COMMITS}/.{batchId}-{uuid.uuid4().hex}"
        what = {"batch": batchId, "files": sorted(n for m in messages if m for n in m.files),
                "rows": sum(m.rows for m in messages if m)}
        with fs.open_output_stream(temp) as f:
            f.write(json.dumps(what).encode())
        fs.move(temp, target)

    def abort(self, messages, batchId: int) -> None:
        self._delete(messages)


class CommittedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> CommittedWriter:
        return CommittedWriter(self.options["path"].rstrip("/"), int(self.options.get("fileRows", 1_000_000)))


def write_committed(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = "1 minute",
                    file_rows: int = 1_000_000, query_name: str | None = None) -> StreamingQuery:
    """Append a stream to the table at ``path``, each micro-batch once."""
    spark = stream.sparkSession
    register_source(spark, CommittedFiles)
    w = (stream.writeStream.format(FORMAT).outputMode("append").option("checkpointLocation", checkpoint)
         .option("fileRows", str(file_rows)))
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start(path)


def commits(path: str) -> list[dict]:
    """What each committed batch says: batch, files, rows; in batch order."""
    fs, root = file_system(path)
    out = []
    for info in fs.get_file_info(pafs.FileSelector(f"{root}/{COMMITS}", allow_not_found=True)):
        if not info.base_name.startswith("."):
            with fs.open_input_file(info.path) as f:
                out.append(json.loads(f.read()))
    return sorted(out, key=lambda c: c["batch"])


def read_committed(spark: SparkSession, path: str, schema, up_to_batch: int | None = None) -> DataFrame:
    """The rows of all committed batches, or of those up to one. File names come to the
    driver, as those of any folder that Spark lists; the frame stays on the files named now."""
    names = [f"{path}/{FILES}/{n}" for c in commits(path) if up_to_batch is None or c["batch"] <= up_to_batch for n in c["files"]]
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def remove_orphans(path: str) -> int:
    """Delete the files that no commit names; only while no query writes. Returns how many."""
    fs, root = file_system(path)
    named = {n for c in commits(path) for n in c["files"]}
    found = fs.get_file_info(pafs.FileSelector(f"{root}/{FILES}", allow_not_found=True))
    orphans = [f.path for f in found if f.base_name not in named]
    for p in orphans:
        fs.delete_file(p)
    return len(orphans)
