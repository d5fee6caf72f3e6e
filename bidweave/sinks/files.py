"""Listing, copying and deleting files, run inside tasks.

Functions of this module travel to the executors by value, so that they need no
copy of the package.
"""

from __future__ import annotations

import posixpath
import re
import shutil
import sys
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 8 << 20


#: Stores in which a written object appears at once and whole, and that copy within themselves.
STORES = ("s3", "gs", "gcs", "abfs", "abfss")
#: Larger objects need several requests, so they are copied as a stream.
ONE_REQUEST = 5 << 30


def _place(uri: str) -> tuple[str, str, str]:
    """Scheme, host or bucket, and path."""
    scheme, host, path = re.fullmatch(r"(?:([A-Za-z][\w+.-]*):(?://([^/]*))?)?(/.*)?", uri).groups()
    scheme = {"s3a": "s3", "s3n": "s3", None: "file"}.get(scheme, scheme)
    return scheme, host or "", path or ""


def _open(uri: str):
    """File system of a URI and the path in it."""
    from pyarrow import fs

    scheme, host, path = _place(uri)
    if scheme == "file":
        return fs.LocalFileSystem(), path
    system, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system, base.rstrip("/") + path


def _size(system, path: str) -> int | None:
    info = system.get_file_info(path)
    return info.size if info.is_file else None


def _entries(folder: str, deep: bool) -> Iterator[tuple[str, object]]:
    """URI and information of what a folder holds, hidden names left out."""
    from pyarrow import fs

    system, path = _open(folder)
    path = path.rstrip("/")
    for info in system.get_file_info(fs.FileSelector(path, recursive=deep)):
        below = info.path[len(path) :].lstrip("/")
        if not any(name[:1] in "._" for name in below.split("/")):
            yield f"{folder.rstrip('/')}/{below}", info


def subfolders(root: str) -> list[str]:
    """Folders directly below ``root``: one for each day of a log."""
    from pyarrow import fs

    return sorted(uri for uri, info in _entries(root, False) if info.type == fs.FileType.Directory)


def list_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Files of each (folder, deep), with modification time and length."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            found = [
                (uri, None if info.mtime_ns is None else info.mtime_ns // 1000, info.size)
                for uri, info in _entries(row.folder, row.deep)
                if info.is_file
            ]
            yield pd.DataFrame(found, columns=["path", "micros", "length"]).astype({"micros": "Int64"})


def copy_file(source: str, target: str, length: int) -> None:
    """Copies one file; the target appears only once it is complete.

    Within one store the store copies. A store shows a new object when it is
    whole, so it is written in place; elsewhere a hidden file is renamed.
    """
    source_fs, source_path = _open(source)
    target_fs, target_path = _open(target)
    if _size(target_fs, target_path) == length and _size(source_fs, source_path) is None:
        return
    (kind, host, _), (own_kind, own_host, _) = _place(target), _place(source)
    folder, name = posixpath.split(target_path)
    written = target_path
    if kind not in STORES:
        target_fs.create_dir(folder, recursive=True)
        written = f"{folder}/.{name}.{uuid.uuid4().hex}"
    same = (kind, host) == (own_kind, own_host)
    try:
        if same and kind in (*STORES, "file") and length <= ONE_REQUEST:
            target_fs.copy_file(source_path, written)
        else:
            with (
                source_fs.open_input_stream(source_path) as read,
                target_fs.open_output_stream(written) as write,
            ):
                shutil.copyfileobj(read, write, CHUNK)
        if _size(target_fs, written) != length:
            raise OSError(f"copy of {source} is incomplete")
        if written != target_path:
            target_fs.move(written, target_path)
    except Exception:
        if _size(target_fs, written) is not None:
            target_fs.delete_file(written)
        raise


def delete_copied(source: str, target: str, length: int) -> None:
    """Deletes a source file whose copy is complete."""
    source_fs, source_path = _open(source)
    target_fs, target_path = _open(target)
    if _size(target_fs, target_path) != length:
        raise OSError(f"no complete copy of {source}")
    if _size(source_fs, source_path) is not None:
        source_fs.delete_file(source_path)


def _each(action, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs ``action`` on every file; a failure is noted and the rest go on."""
    for batch in batches:
        errors = []
        for row in batch.itertuples(index=False):
            try:
                if row.error is None:
                    action(row.path, row.target, row.length)
                errors.append(row.error)
            except Exception as problem:
                errors.append(f"{type(problem).__name__}: {problem}")
        yield batch.assign(error=errors)


def copy_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _each(copy_file, batches)


def delete_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _each(delete_copied, batches)
