"""File access for the Python data sources: listing, splitting, members.

Paths go through Arrow's file systems, so a folder may be local, on HDFS or in an
object store. Archives made of many small compressed members are read in byte
ranges: a task starts at the first member that begins in its range, so one huge
archive is read by many tasks.
"""

from __future__ import annotations

import contextlib
import fnmatch
import io
import lzma
import os
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow.fs as pafs
from pyspark.sql.datasource import InputPartition, WriterCommitMessage

SPLIT_BYTES = 256 << 20
READ_BYTES = 1 << 20
# Ordinals leave room for this many records per compressed byte. Deflate shrinks
# data about a thousandfold at most, so ordinals of two members never meet.
ORDINAL_ROOM = 1 << 20

# Files written as xz: of base64 lines a tenth of the time of the usual 6, for a quarter more bytes.
XZ_PRESET = 1

MAGIC = {"gz": b"\x1f\x8b\x08", "xz": b"\xfd7zXZ\x00"}


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int

    def __post_init__(self):
        InputPartition.__init__(self, (self.path, self.start))


# Bytes of a file that a task reads at least, however small the ranges are.
PACK_BYTES = 4 << 20


@dataclass
class Ranges(InputPartition):
    """Byte ranges of a file that follow each other, read one by one by one task."""

    ranges: list[Split]

    def __post_init__(self):
        InputPartition.__init__(self, (self.ranges[0].path, self.ranges[0].start))


def packed(splits: Sequence[Split]) -> list[Ranges]:
    """Small ranges of one file put together, so that tasks do not cost more than their reading."""
    out: list[Ranges] = []
    for s in splits:
        held = out[-1].ranges if out else []
        if held and held[-1].path == s.path and s.end - held[0].start <= PACK_BYTES:
            held.append(s)
        else:
            out.append(Ranges([s]))
    return out


def codec_of(path: str) -> str | None:
    return {".gz": "gz", ".xz": "xz"}.get(os.path.splitext(path)[1])


def _data_files(fs: pafs.FileSystem, root: str, path: str) -> list[pafs.FileInfo]:
    """A file, or all files under a folder but hidden and uncommitted ones, by path."""
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type != pafs.FileType.Directory:
        return [info]
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    seen = [
        f for f in found
        if f.type == pafs.FileType.File and not any(p[:1] in "_." for p in f.path[len(root) :].split("/") if p)
    ]
    return committed(fs, root, sorted(seen, key=lambda f: f.path))


def plan_splits(path: str | Sequence[str], split_bytes: int = SPLIT_BYTES, divisible: bool = True) -> list[Split]:
    """Byte ranges of a file, or of all files under a folder; of several, one after the other.

    Several paths are given one a line; ``*`` and ``?`` stand for names in the last part of a path.
    """
    splits = []
    for fs, f in (x for p in paths_of(path) for x in _matching(p)):
        step = split_bytes if divisible and codec_of(f.path) else max(f.size, 1)
        splits += [Split(f.path, at, min(at + step, f.size)) for at in range(0, f.size, step)]
    return splits


def paths_of(path: str | Sequence[str]) -> list[str]:
    return [p for p in (path.split("\n") if isinstance(path, str) else path) if p]


def _matching(path: str) -> Iterator[tuple[pafs.FileSystem, pafs.FileInfo]]:
    """The data files of a path, or of every path its last part stands for."""
    fs, root = file_system(path)
    folder, name = os.path.split(root.rstrip("/"))
    if not any(c in name for c in "*?"):
        yield from ((fs, f) for f in _data_files(fs, root, path))
        return
    inside = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if fnmatch.fnmatchcase(os.path.basename(f.path), name))
    if not inside:
        raise FileNotFoundError(path)
    for one in inside:
        yield from ((fs, f) for f in _data_files(fs, one, path))


def open_split(source: str | Sequence[str], split: Split):
    """The file of a split; all paths of a source lie in one file system."""
    return file_system(paths_of(source)[0])[0].open_input_file(split.path)


class _Input:
    """The bytes of a file from an offset on, read forward once; what is left over can be given back."""

    def __init__(self, file, start: int):
        self.file = file
        self.seek(start)

    def seek(self, offset: int) -> None:
        self.file.seek(offset)
        self.pos, self.back = offset, b""

    def read(self) -> bytes:
        out, self.back = self.back or self.file.read(READ_BYTES), b""
        self.pos += len(out)
        return out

    def unread(self, data: bytes) -> None:
        self.back = data + self.back
        self.pos -= len(data)

    def skip(self, n: int) -> None:
        """Pass over ``n`` bytes that have been peeked at."""
        self.back = self.back[n:]
        self.pos += n

    def peek(self, n: int) -> bytes:
        while len(self.back) < n:
            raw = self.file.read(READ_BYTES)
            if not raw:
                break
            self.back += raw
        return self.back[:n]


DAMAGE = (zlib.error, lzma.LZMAError, EOFError)


class _Member(io.RawIOBase):
    """Decompressed bytes of the member that starts where ``source`` is.

    Output is taken in pieces, so a member that unpacks to very much more than it
    takes up does not fill the memory. At its end ``source`` stands behind it.
    """

    def __init__(self, source: _Input, codec: str):
        self.source, self.gz = source, codec == "gz"
        self.codec = zlib.decompressobj(31) if self.gz else lzma.LZMADecompressor(lzma.FORMAT_XZ)
        self.pending, self.over, self.damage = b"", False, None

    def readable(self):
        return True

    def _next(self) -> bytes:
        if self.gz:
            return self.codec.decompress(self.codec.unconsumed_tail or self._more(), READ_BYTES)
        return self.codec.decompress(self._more() if self.codec.needs_input else b"", READ_BYTES)

    def _more(self) -> bytes:
        raw = self.source.read()
        if not raw:
            raise EOFError("the member is cut off")
        return raw

    def readinto(self, buffer) -> int:
        if self.damage:
            raise self.damage
        try:
            while not self.pending and not self.over:
                if self.codec.eof:
                    self.source.unread(self.codec.unused_data)
                    self.over = True
                else:
                    self.pending = self._next()
        except DAMAGE as e:
            self.damage = e
            raise
        n = min(len(buffer), len(self.pending))
        buffer[:n] = self.pending[:n]
        self.pending = self.pending[n:]
        return n

    def finish(self) -> None:
        """Read what is left, so that ``source`` stands at what follows."""
        waste = bytearray(READ_BYTES)
        while self.readinto(waste):
            pass


def member_at(file, offset: int, codec: str):
    """``read(n)`` over the decompressed bytes of the member that starts at ``offset``."""
    return io.BufferedReader(_Member(_Input(file, offset), codec), READ_BYTES).read1


# What the text of a member begins with: a record, or its first header line.
_START = re.compile(rb"(?:\r?\n)*(?:WARC/\d|[!-9;-~]+:)")
_PROBE_BYTES = 1 << 16


def _begins_record(head: bytes, codec: str) -> bool:
    try:
        probe = zlib.decompressobj(31) if codec == "gz" else lzma.LZMADecompressor(lzma.FORMAT_XZ)
        return bool(_START.match(probe.decompress(head, 4096)))
    except DAMAGE:
        return False


def _find_member(source: _Input, end: int, codec: str) -> int | None:
    """Move ``source`` to the next member before ``end`` that begins like a record.

    Needed where a split starts and after damage only: three bytes that look like a
    member turn up by chance in compressed data.
    """
    magic = MAGIC[codec]
    while source.pos < end:
        window = source.peek(READ_BYTES + _PROBE_BYTES)
        if not window:
            return None
        whole = len(window) < READ_BYTES + _PROBE_BYTES
        hit = window.find(magic)
        while 0 <= hit and (whole or hit < READ_BYTES):
            if source.pos + hit >= end:
                return None
            if _begins_record(window[hit : hit + _PROBE_BYTES], codec):
                source.skip(hit)
                return source.pos
            hit = window.find(magic, hit + 1)
        if whole:
            return None
        source.skip(READ_BYTES)
    return None


def members(file, split: Split, codec: str) -> Iterator[tuple[int, io.BufferedReader]]:
    """(offset, stream) of the members that start within the split, in one pass over its bytes.

    Whatever follows a member directly is the next one, whatever its text begins
    with. A damaged member ends early with an exception from its stream; reading goes
    on at the next one that can be recognised.
    """
    source = _Input(file, split.start)
    at = 0 if split.start == 0 else _find_member(source, split.end, codec)
    while at is not None and at < split.end:
        if source.peek(len(MAGIC[codec])) != MAGIC[codec]:
            at = _find_member(source, split.end, codec)
            continue
        member = _Member(source, codec)
        yield at, io.BufferedReader(member, READ_BYTES)
        try:
            member.finish()
            at = source.pos
        except DAMAGE:
            source.seek(at + 1)
            at = _find_member(source, split.end, codec)


def read_headers(stream, skip_blank: bool = False) -> list[tuple[str, str]] | None:
    """Header lines up to a blank line; None when they are malformed.

    ``skip_blank`` passes over blank lines before the first header.
    """
    headers: list[tuple[str, str]] = []
    while True:
        line = stream.readline()
        if not line:
            return None
        line = line.rstrip(b"\r\n")
        if not line:
            if skip_blank and not headers:
                continue
            return headers
        if line[:1] in b" \t" and headers:
            name, value = headers[-1]
            headers[-1] = (name, f"{value} {line.strip().decode('utf-8', 'replace')}")
            continue
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            return None
        headers.append((name.decode("utf-8", "replace"), value.strip().decode("utf-8", "replace")))


@dataclass
class Written(WriterCommitMessage):
    """Files one task has written, by their paths below the output folder."""

    files: list[str] = field(default_factory=list)


#: Folder of the manifests of an output, one for each committed job.
MANIFESTS = "_manifests"
# part-<task>-<job>-<attempt>.<codec>
_PART = re.compile(r"part-\d{5,}-[0-9a-f]{8}-\d+\.\w+\Z")


class ManifestCommitter:
    """Output by manifest: what a job has written counts from the moment its list of files is there.

    Tasks write under final names that no other attempt has. The driver writes one list and
    renames it, whatever the number of files. Files of killed, repeated or failed attempts are
    in no list, and readers that follow the lists pass over them.
    """

    def __init__(self, path: str):
        self.path = path
        self.job = uuid.uuid4().hex

    def name(self, task: int, attempt: int, codec: str) -> str:
        return f"part-{task:05d}-{self.job[:8]}-{attempt}.{codec}"

    def start(self, relative: str, written: Written):
        fs, root = file_system(self.path)
        fs.create_dir(os.path.dirname(f"{root}/{relative}"), recursive=True)
        written.files.append(relative)
        return fs.open_output_stream(f"{root}/{relative}", compression=None)

    def commit(self, messages) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(f"{root}/{MANIFESTS}", recursive=True)
        new = f"{root}/{MANIFESTS}/_new-{self.job}"
        with fs.open_output_stream(new, compression=None) as out:
            for message in messages:
                for relative in message.files if message else []:
                    out.write(f"{relative}\n".encode())
        fs.move(new, f"{root}/{MANIFESTS}/{self.job}.txt")

    @contextlib.contextmanager
    def or_nothing(self, written: Written) -> Iterator[None]:
        """A task that fails removes its files; one that is killed leaves them unlisted."""
        try:
            yield
        except BaseException:
            self.abort([written])
            raise

    def abort(self, messages) -> None:
        """Remove what is known of a failed job."""
        fs, root = file_system(self.path)
        for message in messages:
            for relative in message.files if message else []:
                with contextlib.suppress(OSError):
                    fs.delete_file(f"{root}/{relative}")


def _listed(fs: pafs.FileSystem, folder: str) -> set[str] | None:
    """Paths in the manifests of the nearest folder above that has some."""
    while folder.strip("/"):
        found = fs.get_file_info(pafs.FileSelector(f"{folder}/{MANIFESTS}", allow_not_found=True))
        if found:
            lists = [f.path for f in found if f.path.endswith(".txt")]
            return {f"{folder}/{line}" for p in lists for line in fs.open_input_stream(p).read().decode().splitlines()}
        folder = os.path.dirname(folder)
    return None


def committed(fs: pafs.FileSystem, root: str, files: list[pafs.FileInfo]) -> list[pafs.FileInfo]:
    """The files without those that a sink of this library has written and not committed."""
    parts = {f.path for f in files if _PART.match(os.path.basename(f.path))}
    if not parts:
        return files
    listed = _listed(fs, root.rstrip("/")) or set()
    return [f for f in files if f.path not in parts or f.path in listed]


def committed_files(path: str) -> list[str]:
    """Full paths of the committed files below ``path``, for readers that know nothing of manifests."""
    fs, root = file_system(path)
    return [f.path for f in _data_files(fs, root, path)]
