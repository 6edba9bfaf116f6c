"""FASTQ files by name: one ordered file for each sample, replicate and mate."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from readloom.sources import bgzf
from readloom.sources.storage import clear_folder, join_parts, located


@dataclass
class Parts(WriterCommitMessage):
    """What a task wrote: its number, and (file's name, part) in order."""

    number: int
    parts: list[tuple[str, str]] = field(default_factory=list)


class FastqWriter(DataSourceArrowWriter):
    """Takes rows of file_name and value, a file's rows together; the commit joins the tasks' parts of each file in the tasks' order."""

    def __init__(self, options: dict[str, str]):
        self.path, self.gzip = options["path"].rstrip("/"), options.get("gzip") == "true"
        self.folder = f"{self.path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        task = TaskContext.get()
        done, name, out, writer = Parts(task.partitionId()), None, None, None
        system, _ = located(self.folder)
        system.create_dir(located(self.folder)[1], recursive=True)

        def close() -> None:
            if out is not None:
                if self.gzip:
                    writer.flush()
                out.close()

        for batch in iterator:
            for file_name, value in zip(batch["file_name"].to_pylist(), batch["value"].to_pylist(), strict=True):
                if file_name != name:
                    close()
                    part = f"{self.folder}/{task.partitionId()}-{task.taskAttemptId()}-{len(done.parts)}"
                    name, out = file_name, system.open_output_stream(located(part)[1], compression=None)
                    writer = bgzf.Writer(out)
                    done.parts.append((name, part))
                raw = value.encode() + b"\n"
                writer.put(raw) if self.gzip else out.write(raw)
        close()
        return done

    def commit(self, messages: list[Parts | None]) -> None:
        files = defaultdict(list)
        for message in sorted((m for m in messages if m), key=lambda m: m.number):
            for name, part in message.parts:
                files[name].append(part)
        for name, parts in files.items():
            join_parts(f"{self.path}/{name}", b"", parts, bgzf.END if self.gzip else b"")
        clear_folder(self.folder)

    def abort(self, messages: list[Parts | None]) -> None:
        clear_folder(self.folder)


class FastqFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "readloom_fastq_files"

    def schema(self) -> str:
        return "file_name string, value string"

    def writer(self, schema, overwrite: bool) -> FastqWriter:
        return FastqWriter(dict(self.options))
