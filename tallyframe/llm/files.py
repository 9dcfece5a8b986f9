"""Flat files in the shared folder, written whole and read by memory map where the file system allows."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow.fs as pafs


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:"):
            return pafs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


class FlatWriter:
    """Writes under a name of its own and moves the file into place when closed: a task that is run
    again, or twice at once, leaves one whole file."""

    def __init__(self, uri: str):
        self.fs, self.path = resolve(uri)
        folder, name = self.path.rsplit("/", 1)
        self.fs.create_dir(folder, recursive=True)
        self.temp = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temp)

    def write(self, values: np.ndarray) -> None:
        self.out.write(np.ascontiguousarray(values).tobytes())

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.temp, self.path)


def write_flat(uri: str, values: np.ndarray) -> None:
    out = FlatWriter(uri)
    out.write(values)
    out.close()


def read_flat(uri: str, dtype: str, start: int = 0, count: int | None = None) -> np.ndarray:
    """``count`` values from ``start``: a memory map on a mounted file system, else one ranged read."""
    fs, path = resolve(uri)
    width = np.dtype(dtype).itemsize
    if isinstance(fs, pafs.LocalFileSystem):
        size = os.path.getsize(path) // width
        n = size - start if count is None else min(count, size - start)
        if n <= 0:
            return np.zeros(0, dtype=dtype)
        return np.memmap(path, dtype=dtype, mode="r", offset=start * width, shape=(n,))
    with fs.open_input_file(path) as f:
        f.seek(start * width)
        raw = f.read(None if count is None else count * width)
    return np.frombuffer(raw, dtype=dtype)


def flat_size(uri: str, dtype: str) -> int:
    fs, path = resolve(uri)
    return fs.get_file_info(path).size // np.dtype(dtype).itemsize


def remove_folder(uri: str) -> None:
    """Delete a folder of intermediate files that nothing reads any more; one that was never written is no error."""
    fs, path = resolve(uri)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)
