"""Blocks of documents and packed numbers, for look-ups that move one request per block and shard.

A block is a few megabytes of documents that one task read together. It keeps its documents as packed numbers
and asks for each distinct word once: one request for each shard of the 64-bit word numbers, in sorted
order, so that an answer is a plain list in the same order. A shard sees the requests of
all blocks, and a block its own answers; neither grows with the number of documents in other blocks.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text of a block; a longer document is a block of its own.
BLOCK_BYTES = 10 << 20
ROWS = "kind int, key bigint, block bigint, part bigint, data binary"
_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("key", pa.int64()), ("block", pa.int64()), ("part", pa.int64()), ("data", pa.binary())]
)


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as planes of their used bytes, compressed."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + squeeze(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    width, raw = data[0], np.frombuffer(unsqueeze(data[1:]), np.uint8)
    n = len(raw) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = raw.reshape(width, n).T
    return out.view(np.uint64).ravel()


def joined(parts: Iterable[bytes]) -> bytes:
    """Several byte strings as one."""
    parts = list(parts)
    return b"".join([len(parts).to_bytes(4, "little"), *(len(x).to_bytes(8, "little") for x in parts), *parts])


def parted(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:4], "little")
    sizes = [int.from_bytes(data[4 + 8 * i : 12 + 8 * i], "little") for i in range(n)]
    out, at = [], 4 + 8 * n
    for size in sizes:
        out.append(data[at : at + size])
        at += size
    return out


def framed(columns: pa.RecordBatch | pa.Table) -> bytes:
    """Columns of any type as bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, columns.schema) as writer:
        writer.write(columns)
    return squeeze(sink.getvalue().to_pybytes())


def unframed(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(unsqueeze(data)).read_all()


def shard_edges(numbers: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's numbers begin among sorted numbers; one more entry closes the last."""
    limits = np.array([(s << 64) // shards for s in range(shards)], np.uint64)
    return np.append(np.searchsorted(numbers, limits), len(numbers))


def row_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA
    )


def each_block(make: Callable[[int, pa.Table], list[tuple]], text: str = "text") -> Callable:
    """For ``mapInArrow``: ``make`` gets a block's number and documents and gives rows."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(batch.schema.get_field_index(text)).nbytes
            if held and size + own > BLOCK_BYTES:
                yield row_batch(make(secrets.randbits(62), pa.Table.from_batches(held)))
                held, size = [], 0
            held.append(batch)
            size += own
        if held:
            yield row_batch(make(secrets.randbits(62), pa.Table.from_batches(held)))

    return blocks
