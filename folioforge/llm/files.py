"""Files that executors write in the shared folder, by any file system that pyarrow opens."""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_fs(url: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(url) if "://" in url or url.startswith("file:") else (fs.LocalFileSystem(), url)


class Commit:
    """A file that appears under its name only when it is whole.

    Every attempt of a task writes under its own name, and what names the file is the row the task
    returns; an attempt that dies or runs twice leaves a file that no row names.
    """

    def __init__(self, folder: str, stem: str, suffix: str):
        self.name = f"{stem}-{uuid.uuid4().hex}{suffix}"
        self.fs, path = open_fs(folder)
        self.fs.create_dir(path, recursive=True)
        self.path = f"{path}/{self.name}"
        self.out = self.fs.open_output_stream(self.path + ".part")

    def write(self, data: bytes) -> int:
        self.out.write(data)
        return len(data)

    def close(self) -> str:
        self.out.close()
        self.fs.move(self.path + ".part", self.path)
        return self.name


def open_input(folder: str, name: str):
    system, path = open_fs(folder)
    return system.open_input_file(f"{path}/{name}")
