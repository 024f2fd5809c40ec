"""Binary files in the folder that driver and executors share.

Paths are what Spark uses (``file:/…``, ``hdfs://…``, a plain path). Local paths are opened and
memory-mapped in place; other stores go through pyarrow's file systems.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import numpy as np
from pyarrow import fs


def local_path(uri: str) -> str | None:
    """The path of a file in a mounted folder, or None for a remote store."""
    parts = urlparse(uri)
    if parts.scheme == "":
        return uri
    return unquote(parts.path) if parts.scheme == "file" else None


@contextmanager
def writer(uri: str):
    """A binary file that appears whole or not at all, so that repeated task attempts are harmless."""
    path = local_path(uri)
    if path is None:
        system, place = fs.FileSystem.from_uri(uri)
        system.create_dir(os.path.dirname(place), recursive=True)
        with system.open_output_stream(place) as out:
            yield out
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with open(part, "wb") as out:
            yield out
        os.replace(part, path)
    finally:
        if os.path.exists(part):
            os.unlink(part)


def mapped(uri: str) -> np.ndarray:
    """The file's bytes: memory-mapped when it lies in a mounted folder, read otherwise."""
    path = local_path(uri)
    if path is not None:
        return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    system, place = fs.FileSystem.from_uri(uri)
    with system.open_input_stream(place) as source:
        return np.frombuffer(source.read(), np.uint8)


def write_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Named arrays behind one another: a header line, then each array's bytes at a multiple of 8."""
    spans, at = [], 0
    for name, array in arrays.items():
        spans.append(f"{name}:{array.dtype.str}:{at}:{array.size}")
        at += -(-array.nbytes // 8) * 8
    header = (" ".join(spans) + "\n").encode()
    header = header[:-1] + b" " * (-len(header) % 8) + b"\n"
    with writer(uri) as out:
        out.write(len(header).to_bytes(8, "little") + header)
        for array in arrays.values():
            out.write(np.ascontiguousarray(array).tobytes())
            out.write(b"\0" * (-array.nbytes % 8))


def map_arrays(uri: str) -> dict[str, np.ndarray]:
    raw = mapped(uri)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    found = {}
    for span in raw[8 : 8 + size].tobytes().decode().split():
        name, kind, at, count = span.rsplit(":", 3)
        dtype = np.dtype(kind)
        first = 8 + size + int(at)
        found[name] = raw[first : first + int(count) * dtype.itemsize].view(dtype)
    return found
