"""Files in the shared folder, by any file system that Arrow knows (file, hdfs, s3, gs ...)."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    """Where a qualified path lies. One without a scheme is refused: each machine would take it for its own disk."""
    scheme, mark, path = uri.partition(":/")
    if not mark:
        raise ValueError(f"{uri} names no file system")
    return fs.FileSystem.from_uri(f"file:///{path.lstrip('/')}" if scheme == "file" else uri)


def put(uri: str, data_parts) -> int:
    """Writes the parts under another name and then renames: a task that is lost leaves no half file. Gives the bytes written."""
    system, path = _at(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft, size = f"{path}.{uuid.uuid4().hex[:8]}.tmp", 0
    with system.open_output_stream(draft) as out:
        for part in data_parts:
            out.write(part)
            size += len(part)
    if system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_file(path)
    system.move(draft, path)
    return size


def opened(uri: str):
    """A file to read from any place."""
    system, path = _at(uri)
    return system.open_input_file(path)
