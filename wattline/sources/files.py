"""Paths as Hadoop lists them -> an Arrow file system for use inside tasks."""

from __future__ import annotations

import re
from urllib.parse import quote


def arrow_fs(path: str):
    """(file system, path) for a Hadoop-style path string (file:, s3a:, hdfs:, ...)."""
    from pyarrow import fs as pafs
    if path.startswith("file:") or path.startswith("/"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    uri = re.sub(r"^s3[an]://", "s3://", path)
    return pafs.FileSystem.from_uri(quote(uri, safe=":/@=&?"))
