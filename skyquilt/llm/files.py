"""File access from tasks, for file systems that Arrow knows: written under a temporary name, then renamed."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow.fs as fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextmanager
def whole_file(uri: str):
    """A binary file that appears under its name only when it is complete; another attempt replaces it with the same bytes."""
    store, path = locate(uri)
    folder, _, name = path.rpartition("/")
    store.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    try:
        with store.open_output_stream(temporary, compression=None) as out:
            yield out
        store.move(temporary, path)
    except BaseException:
        if store.get_file_info(temporary).type != fs.FileType.NotFound:
            store.delete_file(temporary)
        raise


def read_stream(uri: str):
    store, path = locate(uri)
    return store.open_input_stream(path, compression=None)


def read_random(uri: str):
    store, path = locate(uri)
    return store.open_input_file(path)
