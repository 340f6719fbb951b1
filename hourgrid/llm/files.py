"""Reading and writing of files in the shared folder from Python workers."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq

from hourgrid.files import filesystem


def read_rows(uri: str) -> pa.Table:
    """One Parquet file."""
    fs, path = filesystem(uri)
    return pq.read_table(path, filesystem=fs)


def write_bytes(uri: str, data: bytes) -> None:
    """Write a file whole; a task that is run again writes the same bytes again."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(data)


def read_bytes(uri: str, at: int = 0, size: int | None = None) -> bytes:
    """A file, or ``size`` bytes of it from ``at`` on."""
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        f.seek(at)
        return f.read(size) if size is not None else f.read()
