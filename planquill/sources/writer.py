"""A writer of log files with buffering, rotation and retention: the sink of a capture.

Files are named ``prefix[-time][-pid]-index.plog``. A file is only ever added to by the writer that
made it; each flush is a frame of its own, so what is on disk can be read at any time. Templates are
defined anew in every file: a reference whose definition is in an earlier file is written as a definition.
"""

from __future__ import annotations

import os
import threading
import time
from dataclasses import dataclass
from datetime import datetime, timezone

from . import codec
from .logfile import SUFFIX


@dataclass
class WriterSettings:
    path: str
    prefix: str = "planlog"
    pattern: str = ""  # strftime, put between prefix and index
    codec: str = "lz4"
    zstd_level: int = 1
    flush_bytes: int = 1 << 20  # 0: every record at once
    rotate_seconds: float = 24 * 3600  # 0: never
    rotate_bytes: int = 1 << 30  # 0: never
    rotate_after: bool = False  # the record that brings a file to rotate_bytes is its last, as where no other writes to it
    truncate: bool = False  # begin an existing file of the same name anew, when time rotates
    keep_files: int = 0  # 0: all
    keep_bytes: int = 0
    cleanup_seconds: float = 60.0
    pid_in_name: bool = False


class LogWriter:
    """Call it with lists of records; ``rotate`` begins a new file, ``close`` writes what is held."""

    def __init__(self, settings: WriterSettings, clock=time.time):
        self.settings, self.clock = settings, clock
        self.lock = threading.RLock()
        self.index, self.file, self.opened, self.size = 0, None, 0.0, 0
        self.pending, self.pending_records = bytearray(), 0
        self.defined: set[int] = set()
        self.plans: dict[int, tuple] = {}
        self.server_us, self.cleaned = 0, None

    def name(self) -> str:
        s = self.settings
        parts = [s.prefix]
        if s.pattern:
            parts.append(datetime.fromtimestamp(self.clock(), timezone.utc).strftime(s.pattern))
        if s.pid_in_name:
            parts.append(str(os.getpid()))
        return os.path.join(s.path, "-".join([*parts, f"{self.index:06d}"]) + SUFFIX)

    def __call__(self, records: list[dict]) -> None:
        with self.lock:
            for record in records:
                self._add(record)

    def _add(self, record: dict) -> None:
        s = self.settings
        if self.file is None:
            self._open(record, by_time=False)
        elif s.rotate_seconds and self.clock() - self.opened > s.rotate_seconds:
            self._next(record, by_time=True)
        data = self._bytes(record)
        held = self.size + len(self.pending)
        if s.rotate_bytes and held > 0 and (held >= s.rotate_bytes if s.rotate_after else held + len(data) > s.rotate_bytes):
            self._next(record, by_time=False)
            data = self._bytes(record)
        self.pending += data
        if len(self.pending) >= s.flush_bytes:
            self.flush()

    def _bytes(self, record: dict) -> bytes:
        """With the first use of a template in this file as its definition."""
        template = record["template"]
        if template["mode"] == "ref" and template["id"] not in self.defined:
            record = record | {"template": template | {"mode": "define", "metrics": None}}
        if record["template"]["mode"] == "define":
            self.defined.add(template["id"])
        return codec.record_bytes(record, self.server_us)

    def _next(self, record: dict, by_time: bool) -> None:
        self.flush()
        self.file.close()
        self.index += 0 if by_time and self.settings.pattern else 1
        self._open(record, by_time)

    def _open(self, record: dict, by_time: bool) -> None:
        s, header = self.settings, codec.write_log([], self.settings.codec, record.get("file"))
        os.makedirs(s.path, exist_ok=True)
        while True:
            try:
                self.file = open(self.name(), "wb" if s.truncate and by_time else "xb")
                break
            except FileExistsError:
                self.index += 1
        self.server_us = codec._server_us((record.get("file") or {}).get("server_start"))
        self.file.write(header)
        self.file.flush()
        self.opened, self.size, self.defined = self.clock(), 0, set()
        self._clean()

    def flush(self) -> None:
        with self.lock:
            if self.pending:
                frame = codec.compressed(self.settings.codec, bytes(self.pending), self.settings.zstd_level)
                self.file.write(frame)
                self.file.flush()
                self.size += len(frame)
                self.pending.clear()

    def rotate(self) -> bool:
        """The next record begins a new file."""
        with self.lock:
            if self.file is None:
                return False
            self.flush()
            self.file.close()
            self.file, self.index = None, self.index + 1
            return True

    def _clean(self) -> None:
        """Delete oldest files of this prefix while either limit is passed; never the current one."""
        s = self.settings
        if not (s.keep_files or s.keep_bytes) or (self.cleaned is not None and s.cleanup_seconds and self.clock() - self.cleaned < s.cleanup_seconds):
            return
        self.cleaned = self.clock()
        current, found = os.path.abspath(self.file.name), []
        for f in os.listdir(s.path):
            if f.startswith(s.prefix + "-") and f.endswith(SUFFIX):
                p = os.path.join(s.path, f)
                found.append((os.stat(p).st_mtime_ns, p, os.stat(p).st_size))
        found.sort()
        files, held = len(found), sum(x[2] for x in found)
        for _, p, n in found:
            if not ((s.keep_files and files > s.keep_files) or (s.keep_bytes and held > s.keep_bytes)):
                break
            if os.path.abspath(p) != current:
                os.remove(p)
                files, held = files - 1, held - n

    def close(self) -> None:
        with self.lock:
            if self.file is not None:
                self.flush()
                self.file.close()
                self.file = None
