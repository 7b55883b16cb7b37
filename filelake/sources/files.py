"""Single files in the task that needs them, in any file system that pyarrow knows."""

from __future__ import annotations

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("/"):
        uri = f"file://{uri}"
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def open_file(uri: str):
    filesystem, path = locate(uri)
    return filesystem.open_input_file(path)


def read_bytes(uri: str) -> bytes:
    """A whole object, for encoders that take one; callers bound its size."""
    with open_file(uri) as stream:
        return stream.read()
