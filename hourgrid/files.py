"""Files that tasks read and write as streams, by their addresses."""

from __future__ import annotations

import re

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and place of an address as Spark writes it; without a scheme it is a local one."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    if scheme is None or scheme[1].lower() == "file":
        plain = path if scheme is None else path[len("file:") :]
        return fs.LocalFileSystem(), re.sub(r"^/+", "/", plain)
    return fs.FileSystem.from_uri(path)


def open_input(path: str):
    """The bytes of a file as they are, read on demand."""
    system, place = located(path)
    return system.open_input_stream(place, compression=None, buffer_size=1 << 16)


def open_at(path: str, place: int):
    """The bytes of a file from a place on, read on demand."""
    system, name = located(path)
    source = system.open_input_file(name)
    source.seek(place)
    return source


def open_output(path: str):
    """A new file; its folder is made."""
    system, place = located(path)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(place, compression=None)
