"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; a bare path is local."""
    return fs.FileSystem.from_uri(uri if ":" in uri else f"file://{os.path.abspath(uri)}")


def write_once(uri: str, write) -> None:
    """Calls ``write(stream)`` and moves the finished file into place, so a repeated or lost attempt leaves no half file."""
    store, path = place(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as stream:
        write(stream)
    store.move(part, path)


def write_array(uri: str, values: np.ndarray) -> None:
    write_once(uri, lambda stream: stream.write(np.ascontiguousarray(values).data.cast("B")) if len(values) else None)


def mapped(uri: str, dtype) -> np.ndarray:
    """A stored array, memory-mapped. From a remote store it is fetched into an unlinked temporary file."""
    store, path = place(uri)
    size = store.get_file_info(path).size
    if not size:
        return np.zeros(0, dtype=dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with tempfile.TemporaryFile() as own, store.open_input_stream(path) as stream:
        while block := stream.read(1 << 22):
            own.write(block)
        own.flush()
        return np.memmap(own, dtype=dtype, mode="r")
