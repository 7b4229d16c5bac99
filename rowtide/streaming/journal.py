"""What tasks write down while they send, so that another attempt knows.

Spark keeps nothing of a task that ends before its commit, but messages it sent are out. A journal
is a folder of small files on shared storage, one folder per micro-batch: *claims*, created by
exactly one attempt, and *outcomes*, one line per message, written out at once.
"""

from __future__ import annotations

import json
import mmap
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from json.encoder import encode_basestring_ascii

from pyarrow import fs


def _storage(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder as Spark names it (``/a``, ``file:/a``, ``hdfs://host/a``)."""
    if folder.startswith("file:"):
        folder = "/" + folder[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(folder)


class _Mapped:
    """A new local file written through memory: a line costs no system call, and stays when its writer is killed.

    Room is taken before it is written to, so a full disk is an ``OSError``. Zeros follow the text until the file is closed.
    """

    ROOM = 1 << 18

    def __init__(self, path: str) -> None:
        self._file, self._begin, self._map = open(path, "xb+"), 0, None
        try:
            self._make_room(0)
        except BaseException:
            self._file.close()
            raise

    def _length(self) -> int:
        return self._begin + (self._map.tell() if self._map else 0)

    def _make_room(self, size: int) -> None:
        length = self._length()
        begin = length - length % mmap.ALLOCATIONGRANULARITY
        room = max(self.ROOM, length - begin + size)
        os.posix_fallocate(self._file.fileno(), begin, room)
        fresh = mmap.mmap(self._file.fileno(), room, offset=begin)
        fresh.seek(length - begin)
        if self._map:
            self._map.close()
        self._begin, self._map = begin, fresh

    def write(self, data: bytes) -> None:
        try:
            self._map.write(data)
        except ValueError:  # no room: nothing is written
            self._make_room(len(data))
            self._map.write(data)

    def flush(self) -> None:
        pass

    def close(self) -> None:
        self._file.truncate(self._length())
        self._map.close()
        self._file.close()


class Outcomes:
    """Outcomes of one attempt, a line each."""

    def __init__(self, stream) -> None:
        self._stream = stream
        self._kind, self._before, self._behind = None, b"", b""  # the line around a number, the same for most

    def add(self, session: str | None, number: int, sink: str | None, ok: bool, error: str | None) -> None:
        kind = session, sink, ok, error
        if kind != self._kind:
            texts = ("null" if text is None else encode_basestring_ascii(text) for text in (session, sink, error))
            session, sink, error = texts
            self._before = f"[{session}, ".encode()
            self._behind = f", {sink}, {'true' if ok else 'false'}, {error}]\n".encode()
            self._kind = kind
        self._stream.write(b"%b%d%b" % (self._before, number, self._behind))
        self._stream.flush()

    def close(self) -> None:
        self._stream.close()


@dataclass(frozen=True)
class Journal:
    """The notes of one micro-batch; goes to the tasks as its folder's name.

    On local, mounted and HDFS folders a claim has one winner. Object stores cannot create a file
    exclusively and show it when it is closed: there a claim tells attempts that follow one
    another, so speculative execution must be off, and outcomes of a cut attempt are lost.
    """

    folder: str

    def claim(self, name: str) -> bool:
        """Whether the caller is the first to claim ``name``."""
        storage, folder = _storage(self.folder)
        storage.create_dir(folder, recursive=True)
        path = f"{folder}/{name}.claim"
        if isinstance(storage, fs.LocalFileSystem):
            try:
                os.close(os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            except FileExistsError:
                return False
            return True
        if storage.get_file_info(path).type != fs.FileType.NotFound:
            return False
        own = f"{folder}/{uuid.uuid4().hex}.new"
        storage.open_output_stream(own).close()
        try:
            storage.move(own, path)  # HDFS moves onto no existing file
        except OSError:
            return False
        return True

    def write(self, name: str) -> Outcomes:
        """A new file of outcomes under ``name``; every attempt has its own."""
        storage, folder = _storage(self.folder)
        storage.create_dir(folder, recursive=True)
        path = f"{folder}/{name}.{uuid.uuid4().hex}.outcomes"
        if isinstance(storage, fs.LocalFileSystem):
            try:
                return Outcomes(_Mapped(path))
            except (OSError, AttributeError):  # a mounted folder or a system that maps no files
                pass
        return Outcomes(storage.open_output_stream(path))

    def read(self, name: str) -> Iterator[tuple]:
        """Whole lines of all attempts under ``name``; lines cut short by a lost task, zeros among them, are left out."""
        storage, folder = _storage(self.folder)
        listed = storage.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        for entry in listed:
            if not (entry.base_name.startswith(f"{name}.") and entry.base_name.endswith(".outcomes")):
                continue
            with storage.open_input_stream(entry.path) as stream:
                *lines, _cut = stream.read().split(b"\n")
            yield from (tuple(json.loads(line)) for line in lines if b"\0" not in line)
