"""Files that tasks write into the shared work folder, through the file system that its address names.

A file gets a name of its own for every attempt of a task. Only names that come back in a task's rows count, so the
files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from backsight.storage import new_path


def new_folder(spark: SparkSession, label: str) -> str:
    return new_path(spark, label)


def opened(address: str) -> tuple[fs.FileSystem, str]:
    if address.startswith("file:"):
        return fs.LocalFileSystem(), "/" + address[5:].lstrip("/")
    if address.startswith("/"):
        return fs.LocalFileSystem(), address
    return fs.FileSystem.from_uri(address)


def new_file(folder: str, ending: str) -> str:
    """The address of a new file in ``folder``; the folder is made if it is missing."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    return f"{folder}/{uuid.uuid4().hex}{ending}"


def writer(address: str):
    system, path = opened(address)
    return system.open_output_stream(path, compression=None)


def reader(address: str):
    """A random-access file."""
    system, path = opened(address)
    return system.open_input_file(path)
