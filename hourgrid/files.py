"""File systems of Spark paths, for Python workers that read the shared folder."""

from __future__ import annotations

import pyarrow.fs as pafs


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The filesystem and path of a Spark URI (``file``, ``hdfs``, ``s3a``, ``gs`` and the like)."""
    scheme, sep, rest = uri.partition("://")
    if not sep:
        if uri.startswith("file:"):
            return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
        return pafs.LocalFileSystem(), uri
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")
