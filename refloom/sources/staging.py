"""Files that tasks write into the shared folder for later stages to read."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

from refloom.session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, tag: str) -> str:
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = os.path.join(base, f"{tag}-{uuid.uuid4().hex[:12]}")
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


class WholeFile:
    """A file that appears under its name only when it is complete: a task that is retried
    or run twice writes its own copy, and the last one to finish replaces the others."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        folder, _, name = inner.rpartition("/")
        self.path, self.part = inner, f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.part)
        self.write, self.flush, self.tell = self.out.write, self.out.flush, self.out.tell

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)

    def __enter__(self):
        return self

    def __exit__(self, kind, *_):
        if kind is None:
            self.close()
        else:
            self.out.close()
