"""Binary files in the shared folder, written and read by tasks.

A task writes under a name of its own and returns that name, so a repeated attempt leaves the first
attempt's file unused and never half overwritten. Files are opened through the file system that
the folder's URI names; local ones are memory-mapped where they lie, others through a copy that has
no name and ends with the process.
"""

from __future__ import annotations

import mmap
import struct
import tempfile
import uuid

import numpy as np
from pyarrow import fs
from pyspark.sql import SparkSession

from cohortline.session import shared_folder

_MAGIC = b"COHORT01"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/cohortline/{name}-{uuid.uuid4().hex}"


def located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def create(folder: str, name: str) -> tuple[str, object]:
    """A new file's URI and an output stream."""
    uri = f"{folder}/{name}-{uuid.uuid4().hex}"
    system, path = located(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, system.open_output_stream(path)


def opened(uri: str):
    """A seekable input file."""
    system, path = located(uri)
    return system.open_input_file(path)


def mapped(uri: str) -> memoryview:
    """The file's bytes, memory-mapped."""
    system, path = located(uri)
    if isinstance(system, fs.LocalFileSystem):
        with open(path, "rb") as f:
            return memoryview(mmap.mmap(f.fileno(), 0, prot=mmap.PROT_READ))
    with tempfile.TemporaryFile() as copy, system.open_input_stream(path) as source:
        while piece := source.read(8 << 20):
            copy.write(piece)
        copy.flush()
        return memoryview(mmap.mmap(copy.fileno(), 0, prot=mmap.PROT_READ))


def dump(*arrays: np.ndarray) -> bytes:
    """Arrays behind a header; each begins at a multiple of eight bytes."""
    head = [_MAGIC, struct.pack("<q", len(arrays))]
    body = []
    for a in arrays:
        raw = a.tobytes()
        head.append(struct.pack("<8sq", a.dtype.str.encode(), len(a)))
        body.append(raw + b"\0" * (-len(raw) % 8))
    return b"".join(head + body)


def load(raw: bytes | memoryview) -> list[np.ndarray]:
    """Views of the arrays of ``dump``."""
    if bytes(raw[:8]) != _MAGIC:
        raise ValueError("not a file of arrays")
    n = struct.unpack_from("<q", raw, 8)[0]
    at, out = 16 + 16 * n, []
    for k in range(n):
        kind, length = struct.unpack_from("<8sq", raw, 16 + 16 * k)
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        out.append(np.frombuffer(raw, dtype, length, at))
        at += -(-length * dtype.itemsize // 8) * 8
    return out


def narrow(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))
