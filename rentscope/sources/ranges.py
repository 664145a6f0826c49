"""Ranges of bytes of files, read inside tasks.

Spark's readers give rows or whole files.  Where a task needs a few bytes of a
large file it opens the file itself, through Arrow's file systems; for a store
that only Spark opens (``Ranges.can`` is false) callers take another way."""

from __future__ import annotations

import re
from urllib.parse import unquote


class Ranges:
    """``read(at, length)`` on one file; a context manager."""

    SCHEMES = {"": "", "file": "", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}

    @classmethod
    def can(cls, path: str) -> bool:
        return cls._scheme(path) in cls.SCHEMES

    @staticmethod
    def _scheme(path: str) -> str:
        return (re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path) or ["", ""])[1].lower()

    def __init__(self, path: str, encoded: bool = False):
        """``encoded``: the path is a URI with %-escapes, as in ``_metadata.file_path``."""
        from pyarrow import fs
        path = unquote(path) if encoded else path
        scheme = self.SCHEMES[self._scheme(path)]
        if scheme:
            store, place = fs.FileSystem.from_uri(re.sub("^[^:]*", scheme, path))
        else:
            store, place = fs.LocalFileSystem(), re.sub("^[Ff][Ii][Ll][Ee]:/*", "/", path)
        self.file = store.open_input_file(place)
        self.size = self.file.size()

    def __call__(self, at: int, length: int) -> bytes:
        return self.file.read_at(length, at)

    def __enter__(self) -> "Ranges":
        return self

    def __exit__(self, *_) -> None:
        self.file.close()
