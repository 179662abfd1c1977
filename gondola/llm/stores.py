"""Files of named numpy arrays in the shared folder, for tables that are too large to broadcast."""

from __future__ import annotations

import json
import uuid
from collections import OrderedDict

import numpy as np
from pyarrow import fs

#: Bytes of fetched files that a worker keeps where the shared folder is no mounted one.
FETCHED = 1 << 28

_open: OrderedDict[str, tuple[dict[str, np.ndarray], int]] = OrderedDict()


def place(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Writes a file; it appears when it is complete. A task that runs again leaves the same file."""
    system, path = place(folder)
    system.create_dir(path, recursive=True)
    head = json.dumps([[k, v.dtype.str, len(v)] for k, v in arrays.items()]).encode()
    head += b" " * (-(len(head) + 8) % 8)
    half = f"{path}/_{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(half) as out:
        out.write(np.array([len(head)], dtype="<i8").tobytes() + head)
        for values in arrays.values():
            out.write(np.ascontiguousarray(values).tobytes() + b"\0" * (-values.nbytes % 8))
    try:
        system.move(half, f"{path}/{name}")
    except OSError:
        if system.get_file_info(f"{path}/{name}").type != fs.FileType.File:
            raise
        system.delete_file(half)  # another attempt was first


def read(folder: str, name: str) -> dict[str, np.ndarray]:
    """A file's arrays: mapped into memory from a mounted folder, else fetched, `FETCHED` bytes of files at a time."""
    key = f"{folder}/{name}"
    if key in _open:
        _open.move_to_end(key)
        return _open[key][0]
    system, path = place(folder)
    if isinstance(system, fs.LocalFileSystem):
        data, held = np.memmap(f"{path}/{name}", dtype=np.uint8, mode="r"), 0
    else:
        with system.open_input_stream(f"{path}/{name}") as stream:
            data = np.frombuffer(stream.read(), dtype=np.uint8)
        held = len(data)
    at = 8 + int(data[:8].view("<i8")[0])
    found = {}
    for column, kind, count in json.loads(data[8:at].tobytes()):
        size = count * np.dtype(kind).itemsize
        found[column] = data[at : at + size].view(kind)
        at += size + -size % 8
    _open[key] = found, held
    while len(_open) > 20_000 or len(_open) > 1 and sum(h for _, h in _open.values()) > FETCHED:
        _open.popitem(last=False)
    return found
