"""File systems for Python tasks on executors: paths as Spark writes them."""

from __future__ import annotations

import pyarrow.fs as pafs

# names under which Spark knows stores that the library knows by another
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "abfss": "abfs", "wasbs": "abfs", "wasb": "abfs"}


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it, for ``/a``, ``file:/a``, ``file:///a`` and ``scheme://...``."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
