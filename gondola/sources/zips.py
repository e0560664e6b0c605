"""Packed files of nested ZIP archives as a Spark data source.

The reader plans one partition per packed file from the central directories of the archives. A
task reads its member's byte range only and inflates it piece by piece; a member that is itself
an archive is followed by its local headers, in the order in which they come, so that neither
its end nor the whole of it is needed. No member is held, whatever its size. Checksums are
known at a member's end, when its text has gone out: a last row then gives the reason.
"""

from __future__ import annotations

import struct
import sys
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gondola.sources.shared import materialize

READ_BYTES = 1 << 18
PACK_BYTES = 1 << 12
SCHEMA = "archivo string, paquete string, nombre string, parte long, texto string, motivo string"

# What reading a member can raise: structure, checksum, stream, encryption, unknown method.
UNREADABLE = (
    zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, NotImplementedError, struct.error, ValueError,
)

_LOCAL, _DIRECTORY, _END, _DESCRIPTOR = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\7\x08"
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


class Damaged(Exception):
    """The archive around a packed file cannot be read."""


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI as Hadoop writes it, and the path in it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


@dataclass
class Member(InputPartition):
    """A packed file of an archive, or the reason why the archive has none."""

    archive: str
    name: str = ""
    offset: int = 0
    packed: int = 0
    method: int = 0
    crc: int = 0
    encrypted: bool = False
    reason: str | None = None

    def __post_init__(self):
        self.value = 0


def _inflated(pieces: Iterator[bytes], method: int, encrypted: bool) -> Iterator[bytes]:
    if encrypted:
        raise RuntimeError("an encrypted member")
    if method == zipfile.ZIP_STORED:
        yield from pieces
        return
    if method != zipfile.ZIP_DEFLATED:
        raise NotImplementedError(f"compression method {method}")
    state = zlib.decompressobj(-15)
    for piece in pieces:
        while piece and not state.eof:
            yield state.decompress(piece, READ_BYTES)
            piece = state.unconsumed_tail
    while not state.eof:
        more = state.decompress(state.unconsumed_tail, READ_BYTES)
        if not more:
            raise EOFError("a member ends early")
        yield more


def outer_bytes(member: Member) -> Iterator[bytes]:
    """The bytes of an archive's member, from its range of the file."""
    try:
        system, path = filesystem(member.archive)
        with system.open_input_file(path) as file:
            file.seek(member.offset)
            header = file.read(30)
            if header[:4] != _LOCAL:
                raise zipfile.BadZipFile("no member where the directory has one")
            file.seek(member.offset + 30 + sum(struct.unpack("<2H", header[26:30])))

            def range_():
                left = member.packed
                while left:
                    piece = file.read(min(READ_BYTES, left))
                    if not piece:
                        raise EOFError("the archive ends early")
                    left -= len(piece)
                    yield piece

            crc = 0
            for piece in _inflated(range_(), member.method, member.encrypted):
                crc = zlib.crc32(piece, crc)
                yield piece
            if crc != member.crc:
                raise zipfile.BadZipFile(f"bad checksum of {member.name}")
    except UNREADABLE as error:
        raise Damaged(str(error)) from None


class _Bytes:
    """A stream of pieces, read by number of bytes; what was read too far is given back."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.rest = pieces, b""

    def piece(self, most: int = READ_BYTES) -> bytes:
        while not self.rest:
            found = next(self.pieces, None)
            if found is None:
                return b""
            self.rest = found
        out, self.rest = self.rest[:most], self.rest[most:]
        return out

    def exactly(self, n: int) -> bytes:
        parts = []
        while n:
            part = self.piece(n)
            if not part:
                raise EOFError("the archive ends early")
            parts.append(part)
            n -= len(part)
        return b"".join(parts)

    def back(self, data: bytes) -> None:
        self.rest = data + self.rest


def _sizes(packed: int, size: int, extra: bytes) -> tuple[int, bool]:
    """Bytes of a packed member, and whether an extra field has its sizes in 64 bits."""
    long = False
    while len(extra) >= 4:
        kind, n = struct.unpack("<2H", extra[:4])
        if kind == 1:
            long = True
            wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
            size = next(wide, size) if size == 0xFFFFFFFF else size
            packed = next(wide, packed) if packed == 0xFFFFFFFF else packed
        extra = extra[4 + n :]
    return packed, long


def inner_members(stream: _Bytes) -> Iterator[tuple[str, Iterator[bytes]]]:
    """Name and bytes of every file of a streamed archive. The bytes must be read to their end
    before the next file; their checksum is compared there."""
    found = 0
    while True:
        mark = stream.exactly(4)
        if mark != _LOCAL:
            if mark not in (_DIRECTORY, _END) or not found and mark == _DIRECTORY:
                raise zipfile.BadZipFile("not a ZIP archive")
            return
        found += 1
        _, flags, method, _, _, crc, packed, size, name, extra = struct.unpack("<5H3I2H", stream.exactly(26))
        name = stream.exactly(name).decode("utf-8" if flags & 0x800 else "cp437", "replace")
        packed, long = _sizes(packed, size, stream.exactly(extra))
        yield name, _inner_bytes(stream, name, flags, method, crc, packed, long)


def _inner_bytes(stream: _Bytes, name: str, flags: int, method: int, crc: int, packed: int, long: bool) -> Iterator[bytes]:
    later = bool(flags & 8)  # checksum and sizes follow the bytes
    if flags & 1:
        raise RuntimeError("an encrypted member")
    if later and method != zipfile.ZIP_DEFLATED:
        raise NotImplementedError("a stored member of unknown size")
    found = size = 0
    if later:
        state, read = zlib.decompressobj(-15), 0
        while not state.eof:
            piece = state.unconsumed_tail or stream.piece()
            if not piece:
                raise EOFError("the archive ends early")
            read += 0 if state.unconsumed_tail else len(piece)
            out = state.decompress(piece, READ_BYTES)
            found, size = zlib.crc32(out, found), size + len(out)
            yield out
        stream.back(state.unused_data)
        read -= len(state.unused_data)
        mark = stream.exactly(4)
        crc = struct.unpack("<I", stream.exactly(4) if mark == _DESCRIPTOR else mark)[0]
        if struct.unpack("<2Q" if long else "<2I", stream.exactly(16 if long else 8)) != (read, size):
            raise zipfile.BadZipFile(f"bad sizes of {name}")
    else:

        def range_():
            left = packed
            while left:
                piece = stream.piece(min(left, READ_BYTES))
                if not piece:
                    raise EOFError("the archive ends early")
                left -= len(piece)
                yield piece

        pieces = range_()
        for out in _inflated(pieces, method, False):
            found = zlib.crc32(out, found)
            yield out
        for _ in pieces:  # a member's bytes behind the end of its deflate stream
            pass
    if found != crc:
        raise zipfile.BadZipFile(f"bad checksum of {name}")


def text_chunks(pieces: Iterator[bytes], chunk: int) -> Iterator[str]:
    """Text in parts of about `chunk` bytes that end at a line end."""
    held, size = [], 0
    for piece in (p[k : k + chunk] for p in pieces for k in range(0, len(p), chunk)):
        held.append(piece)
        size += len(piece)
        if size >= chunk and (cut := piece.rfind(b"\n") + 1):
            held[-1] = piece[:cut]
            yield b"".join(held).decode("utf-8", errors="replace").rstrip("\r\n")
            held = [piece[cut:]]
            size = len(held[0])
    if rest := b"".join(held):
        yield rest.decode("utf-8", errors="replace").rstrip("\r\n")


class ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.chunk, self.piece = int(options.get("chunkbytes", 1 << 20)), int(options.get("piecechunks", 64))

    def partitions(self) -> list[Member]:
        """One per packed CSV or inner archive; one with a reason per archive that cannot be
        read. Only the directories at the archives' ends are read here."""
        system, base = filesystem(self.root)
        start = system.get_file_info(base)
        files = [start] if start.is_file else system.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        prefix = self.root[: len(self.root) - len(base)] if self.root.endswith(base) else ""
        found = []
        for info in sorted(files, key=lambda f: f.path):
            if not (info.is_file and info.path.lower().endswith(".zip")):
                continue
            archive = prefix + info.path
            try:
                with system.open_input_file(info.path) as file, zipfile.ZipFile(file) as packed:
                    for m in packed.infolist():
                        if m.filename.lower().endswith((".zip", ".csv")):
                            found.append(Member(
                                archive, m.filename, m.header_offset, m.compress_size, m.compress_type, m.CRC,
                                bool(m.flag_bits & 1),
                            ))
            except UNREADABLE as error:
                found.append(Member(archive, reason=str(error)))
        return found or [Member("")]

    def read(self, member: Member):
        if not member.archive:
            return
        if member.reason is not None:
            yield (member.archive, None, None, None, None, f"corrupt archive: {member.reason}")
            return
        pieces = outer_bytes(member)
        try:
            if member.name.lower().endswith(".csv"):
                yield from self._rows(member.archive, "", member.name, pieces)
                return
            try:
                for name, inner in inner_members(_Bytes(pieces)):
                    if name.lower().endswith(".csv"):
                        yield from self._rows(member.archive, member.name, name, inner)
                    else:
                        for _ in inner:
                            pass
            except UNREADABLE as error:
                for _ in pieces:  # is the archive around it whole?
                    pass
                yield (member.archive, member.name, None, None, None, f"corrupt inner archive: {error}")
            for _ in pieces:
                pass
        except Damaged as error:
            yield (member.archive, None, None, None, None, f"corrupt archive: {error}")

    def _rows(self, archive: str, package: str, name: str, pieces: Iterator[bytes]):
        """The chunks of one file. Every `piece` of them are written as a file of their own, so
        each such part starts with the header line."""
        header = ""
        for part, text in enumerate(text_chunks(pieces, self.chunk)):
            if part == 0:
                header = text.split("\n", 1)[0]
            elif part % self.piece == 0:
                text = header + "\n" + text
            yield (archive, package, name, part, text, None)


class ZipSource(DataSource):
    """`spark.read.format("packed_csv").load(root)`: archivo, paquete, nombre, parte, texto of
    all CSV files in the archives below `root`, or in that archive, and rows with a `motivo`."""

    @classmethod
    def name(cls) -> str:
        return "packed_csv"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZipReader:
        return ZipReader(self.options)


def joined_lines(files: DataFrame) -> DataFrame:
    """`files` with neighbouring rows as one, their lines joined, where all but `linea` and `orden` is
    alike. For rows that come in their order, with no line elsewhere that belongs between two
    such neighbours: a file of several blocks needs a column that tells them apart."""
    alike = [n for n in files.columns if n not in ("linea", "orden")]

    def run(batches):
        for batch in batches:
            lines, at, first, texts = batch.column("linea").to_pylist(), 0, [], []
            for _, of in groupby(zip(*(batch.column(n).to_pylist() for n in alike))):
                to = at + sum(1 for _ in of)
                first.append(at)
                texts.append("\n".join(lines[at:to]))
                at = to
            column = batch.schema.get_field_index("linea")
            yield batch.take(pa.array(first, pa.int64())).set_column(column, batch.schema.field(column), pa.array(texts, pa.string()))

    return files.mapInArrow(run, files.schema)


def _packed(batches):
    """Texts of more than a few lines as deflated bytes, marked by their first one."""
    for batch in batches:
        texts = (t.encode() for t in batch.column("linea").to_pylist())
        data = [b"z" + zlib.compress(t) if len(t) > PACK_BYTES else b"t" + t for t in texts]
        at = batch.schema.get_field_index("linea")
        yield batch.set_column(at, pa.field("linea", pa.binary()), pa.array(data, pa.binary()))


def write_days(files: DataFrame, root: str) -> DataFrame:
    """Archives from text: one per `dia`, with one inner archive per `paquete`, which holds the
    files `nombre` made of the lines `linea`, or several joined, in `orden` (an action). Returns
    dia and archivo.

    A day is written by one task, text by text, to a name of its own that is changed at the
    end, so a repeated task leaves whole archives only. Longer texts travel to it deflated."""
    kinds = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == "linea" else f.dataType) for f in files.schema])
    texts = files.mapInArrow(_packed, kinds)
    ordered = texts.repartition("dia").sortWithinPartitions("dia", "paquete", "nombre", "orden")

    def run(batches):
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in range(4))))
        for day, of_day in groupby(rows, lambda r: r[0]):
            archive = f"{root.rstrip('/')}/dia_{day}.zip"
            system, path = filesystem(archive)
            system.create_dir(path.rsplit("/", 1)[0], recursive=True)
            staged = f"{path}.{uuid.uuid4().hex}"
            with system.open_output_stream(staged) as out, zipfile.ZipFile(_Writer(out), "w") as outer:
                for package, of_package in groupby(of_day, lambda r: r[1]):
                    with outer.open(f"{day}/comercio_{package}_{day}.zip", "w", force_zip64=True) as stream:
                        with zipfile.ZipFile(_Writer(stream), "w", zipfile.ZIP_DEFLATED) as inner:
                            for name, lines in groupby(of_package, lambda r: r[2]):
                                with inner.open(name, "w", force_zip64=True) as file:
                                    for line in lines:
                                        text = line[3][1:]
                                        file.write((zlib.decompress(text) if line[3][:1] == b"z" else text) + b"\n")
            system.move(staged, path)
            yield pa.RecordBatch.from_pylist([{"dia": str(day), "archivo": archive}])

    chosen = ordered.select(*(F.col(c).cast("string") for c in ("dia", "paquete", "nombre")), "linea")
    return materialize(chosen.mapInArrow(run, "dia string, archivo string"), "packed-days")


class _Writer:
    """A stream that can be written on only, which ZIP files follow by descriptors."""

    def __init__(self, out):
        self.write, self.flush = out.write, lambda: None


# What runs in tasks travels with the plan; workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
