"""Files seen from tasks: folders listed and packed files read where Spark put the work.

Tasks reach a store through ``pyarrow.fs``, by the scheme of the path (local files, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs

#: Bytes read at a time, and bytes unpacked at a time.
PIECE, UNPACKED = 1 << 20, 1 << 23


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path inside it. ``file:/x`` and ``file:///x`` are the same file."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", uri):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri)


def listed(uri: str) -> list[tuple[str, bool, int, int]]:
    """(path, is a folder, bytes, change in microseconds) of what a folder holds; hidden names are left out."""
    store, inner = located(uri)
    prefix = uri[: len(uri) - len(inner)] if uri.endswith(inner) else "file:"
    found = []
    for info in store.get_file_info(fs.FileSelector(inner)):
        if info.base_name[:1] in "._" and "=" not in info.base_name:
            continue
        changed = (info.mtime_ns or 0) // 1000
        found.append((f"{prefix}{info.path}", info.type == fs.FileType.Directory, info.size or 0, changed))
    return found


def unpacked(uri: str) -> Iterator[bytes]:
    """The content of a gzip file piece by piece, all members. Raises ``ValueError`` where it cannot be unpacked."""
    store, inner = located(uri)
    unpacker, rest = zlib.decompressobj(31), b""
    try:
        with store.open_input_stream(inner, compression=None) as stream:
            while True:
                rest = rest or stream.read(PIECE)
                if not rest:
                    break
                if unpacker.eof:  # a further member
                    unpacker = zlib.decompressobj(31)
                piece = unpacker.decompress(rest, UNPACKED)
                rest = unpacker.unconsumed_tail or unpacker.unused_data
                if piece:
                    yield piece
            if piece := unpacker.flush():
                yield piece
    except (zlib.error, OSError) as error:
        raise ValueError(str(error)) from error
    if not unpacker.eof:
        raise ValueError("the file ends early")


def plain(uri: str) -> Iterator[bytes]:
    store, inner = located(uri)
    try:
        with store.open_input_stream(inner, compression=None) as stream:
            while piece := stream.read(PIECE):
                yield piece
    except OSError as error:
        raise ValueError(str(error)) from error


def lines(pieces: Iterator[bytes]) -> Iterator[pa.Array]:
    """Lines as binary arrays, without their ends; what is cut by a piece's end goes on in the next."""
    kept: list[bytes] = []
    for piece in pieces:
        last = piece.rfind(b"\n")
        if last < 0:
            kept.append(piece)
            continue
        yield _array(b"".join([*kept, piece[: last + 1]]))
        kept = [piece[last + 1 :]] if last + 1 < len(piece) else []
    if kept:
        yield _array(b"".join(kept) + b"\n")


def _array(block: bytes) -> pa.Array:
    ends = np.flatnonzero(np.frombuffer(block, np.uint8) == 10)
    # Each line with its line feed is a slice of the block: no line becomes a Python object.
    offsets = np.concatenate([[0], ends + 1]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(block)])


def glob_pattern(glob: str) -> str:
    """A regular expression for a file name pattern with ``*``, ``?``, ``[…]`` and ``{…,…}``."""
    out, depth, at = [], 0, 0
    while at < len(glob):
        sign = glob[at]
        if sign == "[" and (close := glob.find("]", at + 2)) > 0:
            out.append("[" + glob[at + 1 : close].replace("\\", "\\\\").replace("!", "^", 1 if glob[at + 1] == "!" else 0) + "]")
            at = close
        elif sign == "{":
            out.append("(?:")
            depth += 1
        elif sign == "}" and depth:
            out.append(")")
            depth -= 1
        else:
            out.append({"*": "[^/]*", "?": "[^/]", ",": "|" if depth else ","}.get(sign, re.escape(sign)))
        at += 1
    return "^" + "".join(out) + "$"
