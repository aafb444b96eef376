"""Binary files in the shared folder, written and read inside tasks.

Names are new for every attempt and only a finished attempt's name reaches the
manifest, so a lost or doubled task leaves nothing that a reader would see."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]  # as Spark writes it
    return fs.FileSystem.from_uri(uri)


def create(folder: str, suffix: str):
    """(uri, output stream) of a new file in ``folder``."""
    part = TaskContext.get().partitionId()
    uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}{suffix}"
    where, path = _place(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, where.open_output_stream(path, compression=None)


def open_random(uri: str):
    where, path = _place(uri)
    return where.open_input_file(path)


def open_stream(uri: str):
    where, path = _place(uri)
    return where.open_input_stream(path, compression=None)
