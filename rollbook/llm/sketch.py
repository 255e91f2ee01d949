"""Which hashed items occur in two or more rows: a bit table of bounded size.

Tasks give sorted positions per chunk of the table; chunks are merged one stream at a time. The table has
one bit per position, set if two rows hit it: a set bit may be chance, an unset bit is proof that at most
one row has the item. Its size is a power of two chosen from the number of bytes, up to a fixed bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import give_back_memory, written

LEAST_BITS, MOST_BITS = 20, 29
CHUNK_BITS = 22
#: Positions gathered by a task before they are given out.
FLUSH = 1 << 21
_SCHEMA = "chunk int, once binary, more binary, counts binary"
#: Counts end here.
MOST_COUNT = 255


def text_bytes(docs: DataFrame, text_column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text_column)).alias("n")).first()["n"] or 0


def table_bits(n_bytes: int, per_byte: float = 0.5, most: int = MOST_BITS) -> int:
    """log2 of the table size for so many bytes of text."""
    return int(min(most, max(LEAST_BITS, np.ceil(np.log2(max(1, n_bytes * per_byte))))))


def _pack(places: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.diff(places, prepend=np.uint32(0)).astype("<u4").tobytes()) if len(places) else b""


def _unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<u4"), dtype=np.uint32) if blob else np.zeros(0, np.uint32)


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.uint32)


def shared_bits(
    docs: DataFrame, rows_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, levels: tuple[int, ...] = (2,)
) -> list[bytearray]:
    """For each level the packed bit table of positions that so many rows of ``docs`` hit (255 at most);
    ``rows_of`` gives the item hashes of each row of a batch. Levels after the first are few positions: their
    tables have a bit for eight of them, so three bits less."""

    def gather(batches):
        held: list[np.ndarray] = []
        n = 0

        def given():
            every = np.concatenate(held) if held else np.zeros(0, np.uint32)
            held.clear()
            every.sort()
            new = np.concatenate([every[:1] == every[:1], every[1:] != every[:-1]])
            values, counts = every[new], np.diff(np.flatnonzero(new).astype(np.int32), append=np.int32(len(every)))
            cuts = np.searchsorted(values, np.arange(0, (1 << bits) + 1, 1 << min(CHUNK_BITS, bits), dtype=np.uint64))
            rows = []
            for c, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if hi > lo:
                    v, n_rows = values[lo:hi] & np.uint32((1 << CHUNK_BITS) - 1), counts[lo:hi]
                    more = n_rows > 1
                    rows.append((c, _pack(v[~more]), _pack(v[more]), np.minimum(n_rows[more], MOST_COUNT).astype(np.uint8).tobytes()))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3)]],
                ["chunk", "once", "more", "counts"],
            )

        for batch in batches:
            for hashes in rows_of(batch):
                held.append(np.unique(positions(hashes, bits)))
                n += len(held[-1])
                if n >= FLUSH:
                    yield given()
                    n = 0
        if held:
            yield given()
        give_back_memory()

    def merge(batches):
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, once, more, counts in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                table = seen.setdefault(c, np.zeros(1 << min(CHUNK_BITS, bits), np.uint8))
                places = _unpack(once)
                table[places] = np.minimum(table[places], MOST_COUNT - 1) + 1
                places = _unpack(more)
                table[places] = np.minimum(table[places].astype(np.int64) + np.frombuffer(counts, np.uint8), MOST_COUNT)
        for c, table in seen.items():
            packed = [np.packbits(table >= n) for n in levels]
            packed = b"".join((np.packbits(p > 0) if k else p).tobytes() for k, p in enumerate(packed))
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([packed], pa.binary())], ["chunk", "bits"])
        seen.clear()
        give_back_memory()

    parts = docs.mapInArrow(gather, _SCHEMA)
    n_parts = max(1, 1 << max(0, bits - CHUNK_BITS))
    merged = written(parts.repartition(min(n_parts, 128), "chunk").mapInArrow(merge, "chunk int, bits binary"), "bits", "uncompressed")
    width = (1 << min(CHUNK_BITS, bits)) // 8
    widths = [width // 8 if k else width for k in range(len(levels))]
    out = [bytearray((1 << bits) // 8 * w // width) for w in widths]
    # At most 2 ** MOST_BITS bits a level in all; a few chunks at a time pass through the driver's JVM.
    for row in merged.coalesce(16).toLocalIterator():
        at = 0
        for table, w in zip(out, widths, strict=True):
            table[row["chunk"] * w : (row["chunk"] + 1) * w] = row["bits"][at : at + w]
            at += w
    return out


def is_shared(table: bytearray, hashes: np.ndarray, bits: int) -> np.ndarray:
    table = np.frombuffer(table, np.uint8)
    place = positions(hashes, bits)
    return (table[place >> np.uint32(3)] >> (np.uint8(7) - (place & np.uint32(7)).astype(np.uint8))) & np.uint8(1) == 1
