"""Files that are read and written by byte ranges: local ones and what pyarrow has a file system for."""

from __future__ import annotations

import re
import tempfile
import uuid
from fnmatch import fnmatch

from pyarrow import fs
from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors share; a local session without that setting gets a temporary one."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="spark-readloom-")
        spark.conf.set("spark.checkpoint.dir", top)
    path = f"{top.rstrip('/')}/readloom-{uuid.uuid4().hex}"
    system, own = located(path)
    system.create_dir(own, recursive=True)
    return path


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path; a path without a scheme is local."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)


def can_open(path: str) -> bool:
    """Whether pyarrow knows the path's scheme; others are left to Spark's own readers."""
    try:
        located(path)
    except (ValueError, OSError):
        return False
    return True


def files_of(paths: str | list[str], hidden: tuple[str, ...] = ("_", ".")) -> list[tuple[str, int]]:
    """(path, bytes) of every file in order of names: of files, of folders' files and of patterns in the last part of a path."""
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        system, own = located(path)
        prefix = path[: len(path) - len(own)] if path.endswith(own) and "://" in path else ""
        folder, _, name = own.rpartition("/")
        if set(name) & set("*?["):
            there = [i for i in system.get_file_info(fs.FileSelector(folder or "/", allow_not_found=True)) if fnmatch(i.base_name, name)]
        else:
            there = system.get_file_info([own])
            if there[0].type == fs.FileType.Directory:
                there = system.get_file_info(fs.FileSelector(own))
                there = [i for i in there if not i.base_name.startswith(hidden)]
        there = [i for i in there if i.type == fs.FileType.File]
        if not there:
            raise FileNotFoundError(path)
        found += [(prefix + i.path, i.size) for i in there]
    return sorted(set(found))


def join_parts(path: str, first: bytes, parts: list[str], last: bytes, piece: int = 8 << 20) -> None:
    """Writes ``first``, the parts and ``last`` as one file, a piece at a time."""
    system, own = located(path)
    system.create_dir(own.rpartition("/")[0], recursive=True)
    with system.open_output_stream(own, compression=None) as out:
        out.write(first)
        for part in parts:
            with system.open_input_stream(located(part)[1], compression=None) as source:
                while block := source.read(piece):
                    out.write(block)
        out.write(last)


def clear_folder(path: str) -> None:
    """Removes a folder that this library wrote its parts to."""
    system, own = located(path)
    if system.get_file_info([own])[0].type == fs.FileType.Directory:
        system.delete_dir(own)
