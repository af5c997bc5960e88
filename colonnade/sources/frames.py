"""Checksummed, compressed frames.

A frame is a 16-byte CityHash128 of all that follows, the method, the size of method, sizes and payload together, the size of the
content, and the payload.
"""

from __future__ import annotations

import pyarrow as pa

from ..errors import ChecksumError, CodecError
from ..functions.cityhash import digest
from .wire import Reader, Writer

# Fixed values of the format.
LZ4, NONE, ZSTD = 0x82, 0x02, 0x90
HEADER = 9
LIMIT = 128 * 1024 * 1024
_CODECS = {LZ4: "lz4_raw", ZSTD: "zstd"}
METHODS = {"none": NONE, "lz4": LZ4, "zstd": ZSTD}


def encode_frame(content: bytes, method: str = "lz4") -> bytes:
    """One frame. Content that does not get smaller is stored as it is."""
    if len(content) > LIMIT:
        raise CodecError(f"a frame holds {LIMIT} bytes at most")
    if method not in METHODS:
        raise CodecError(f"unknown method {method!r}")
    code, payload = METHODS[method], content
    if code != NONE:
        payload = pa.compress(content, codec=_CODECS[code], asbytes=True) if content else content
        if len(payload) >= len(content):
            code, payload = NONE, content
    out = Writer()
    out.pack("B", code)
    out.pack("I", len(payload) + HEADER)
    out.pack("I", len(content))
    out.raw(payload)
    body = out.take()
    return digest(body) + body


def decode_frame(reader: Reader) -> bytes:
    """The content of the frame at the reader's place."""
    checksum = bytes(reader.raw(16))
    start = reader.at
    code, size, content_size = reader.byte(), reader.unpack("I"), reader.unpack("I")
    if size < HEADER or size > LIMIT or content_size > LIMIT:
        raise CodecError(f"impossible frame sizes: {size}, {content_size}")
    payload = bytes(reader.raw(size - HEADER))
    if digest(bytes(reader.data[start : reader.at])) != checksum:
        raise ChecksumError("the frame's checksum does not agree with its content")
    if code == NONE:
        if len(payload) != content_size:
            raise CodecError("the size of stored content differs from what the frame says")
        return payload
    if code not in _CODECS:
        raise CodecError(f"unknown compression method {code:#04x}")
    try:
        return pa.decompress(payload, decompressed_size=content_size, codec=_CODECS[code], asbytes=True)
    except (pa.ArrowInvalid, OSError) as wrong:
        raise CodecError(f"the payload cannot be decompressed: {wrong}") from wrong


def decode_frames(data: bytes) -> bytes:
    """The content of all frames in a byte string."""
    reader, parts = Reader(data), []
    while reader.left:
        parts.append(decode_frame(reader))
    return b"".join(parts)
