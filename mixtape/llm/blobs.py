"""Binary files in shared storage, from inside tasks.

A task writes under a name of its own (a fresh suffix each attempt) and returns
that name as a row; the rows are stored through Spark's committer. So a retried
or doubled task leaves a file that no row names, and readers follow the rows.
Paths are URIs that pyarrow's file systems know (file, hdfs, s3, gs, ...).
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def create(folder: str, name: str):
    """(uri, open output stream) of a new file ``name`` with a suffix of this attempt."""
    system, path = resolve(folder)
    system.create_dir(path, recursive=True)
    stem, dot, ending = name.partition(".")
    file = f"{stem}-{uuid.uuid4().hex[:12]}{dot}{ending}"
    return f"{folder}/{file}", system.open_output_stream(f"{path}/{file}", compression=None)


def open_file(uri: str):
    """A seekable input file."""
    system, path = resolve(uri)
    return system.open_input_file(path)
