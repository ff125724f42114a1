"""Files on shared storage that tasks write once and read by ranges."""

from __future__ import annotations

import uuid

from pyarrow import fs


# Names that Spark's file systems have for storage, and what the same is called here. Access
# comes from the executors' environment, not from Spark's settings.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def known_uri(path: str) -> str:
    scheme, colon, rest = path.partition(":")
    return f"{SCHEMES.get(scheme, scheme)}{colon}{rest}"


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(known_uri(path))
    return fs.LocalFileSystem(), path


class Output:
    """A file that appears under its name when it is complete.

    A task that is lost leaves a hidden part. Where a repeated task's bytes may differ, its
    file needs a name of its own, and readers a list of the files that count.
    """

    def __init__(self, folder: str, name: str):
        self.system, self.folder = locate(folder)
        self.system.create_dir(self.folder, recursive=True)
        self.name = name
        self.hidden = f"{self.folder}/.{name}.{uuid.uuid4().hex}"
        self.stream = self.system.open_output_stream(self.hidden, compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; gives the offset of ``data``."""
        at = self.size
        self.stream.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self.stream.close()
        self.system.move(self.hidden, f"{self.folder}/{self.name}")


class Ranges:
    """Range reads from the files of a folder; keeps the last file open."""

    def __init__(self, folder: str):
        self.system, self.folder = locate(folder)
        self.name, self.file = None, None

    def open(self, name: str):
        if name != self.name:
            if self.file is not None:
                self.file.close()
            self.name, self.file = name, self.system.open_input_file(f"{self.folder}/{name}")
        return self.file

    def read(self, name: str, offset: int, length: int) -> bytes:
        return self.open(name).read_at(length, offset)

    def size(self, name: str) -> int:
        return self.open(name).size()
