"""Whole files in the shared folder, written and read in ranges by the tasks themselves.

Paths are URIs or absolute paths. pyarrow opens file:, hdfs:, s3: and gs: URIs, so nothing here
relies on a folder of one machine. A file is written under a name of its own attempt and then
moved, so a task that runs twice leaves one whole file with the same content."""

import uuid
from contextlib import contextmanager

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@contextmanager
def new_file(path: str):
    """An output stream; the file appears under `path` when the block ends well."""
    system, name = opened(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    aside = f"{name}.{uuid.uuid4().hex}"
    try:
        with system.open_output_stream(aside, compression=None) as out:
            yield out
        system.move(aside, name)
    except BaseException:
        if system.get_file_info(aside).type != fs.FileType.NotFound:
            system.delete_file(aside)
        raise


@contextmanager
def open_file(path: str):
    """A random-access input file."""
    system, name = opened(path)
    with system.open_input_file(name) as file:
        yield file
