"""Vectorised word handling for Arrow batches: splitting, hashing and n-grams of whole texts.

Every operator here reads a text column as the byte buffer Arrow already holds and works on all
documents of a slice at once. A word is a run of bytes for which a 256-entry table says so; the
separators are ASCII, so UTF-8 sequences are never cut. Word hashes are polynomial hashes modulo
2**64 over a byte table, followed by a finalising mix; n-gram hashes are polynomials in word
hashes. Slices hold about ``SLICE_BYTES`` of text (one document, if that is longer), so memory
does not depend on the batch or table size.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

SLICE_BYTES = 2 << 20


def mix(x):
    """Finalising permutation of uint64 values (splitmix constants)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spaced_words() -> np.ndarray:
    """Byte table: everything but ASCII white space (0x20, 0x09-0x0D) is part of a word."""
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def alnum_words() -> np.ndarray:
    """Byte table: ASCII letters and digits and all non-ASCII bytes are part of a word."""
    table = np.zeros(256, bool)
    table[128:] = True
    for lo, hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
        table[lo:hi] = True
    return table


def lowered() -> np.ndarray:
    """Byte table that maps A-Z to a-z and every other byte to itself."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type)
                              or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of at most ``limit`` bytes (or a single longer row)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


class Words:
    """Words of a slice of documents: byte starts and ends, and word offsets per document."""

    def __init__(self, data: np.ndarray, off: np.ndarray, table: np.ndarray,
                 fold: np.ndarray | None = None):
        self.data = data if fold is None else fold[data]
        inside = table[data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        firsts = off[:-1][off[:-1] < len(data)]
        begin[firsts] |= inside[firsts]
        self.start = np.flatnonzero(begin)
        stop = inside
        stop[:-1] &= ~inside[1:] | begin[1:]
        self.end = np.flatnonzero(stop) + 1
        self.off = np.searchsorted(self.start, off)
        self.counts = np.diff(self.off)

    def __len__(self):
        return len(self.start)

    def doc_of(self) -> np.ndarray:
        """Row number of each word's document."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def doc_end(self) -> np.ndarray:
        """For each word the word index at which its document ends."""
        return np.repeat(self.off[1:], self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        out = np.empty(len(self.start), np.uint64)
        byte = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                   + np.uint64(seed))
        factor = 0xD6E8FEB86659FD93
        inverse = pow(factor, -1, 1 << 64)
        up = down = np.ones(0, np.uint64)
        i, n = 0, len(out)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + SLICE_BYTES, "right")))
            lo, hi = self.start[i], self.end[j - 1]
            if len(up) < hi - lo + 1:
                up = np.full(hi - lo + 1, factor, np.uint64)
                down = np.full(hi - lo + 1, inverse, np.uint64)
                up[0] = down[0] = 1
                np.cumprod(up, out=up)
                np.cumprod(down, out=down)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(byte[self.data[lo:hi]] * up[:hi - lo], out=total[1:])
            s, e = self.start[i:j] - lo, self.end[i:j] - lo
            out[i:j] = mix((total[e] - total[s]) * down[s])
            i = j
        return out

    def text(self, k: int) -> bytes:
        return self.data[self.start[k]:self.end[k]].tobytes()


def ngrams(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``n`` words from each position on (the last n - 1 positions are left out)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    acc = hashes[:size] + np.uint64(n * 0x632BE59BD9B4E019 + seed & 0xFFFFFFFFFFFFFFFF)
    for j in range(1, n):
        acc = acc * np.uint64(0x2545F4914F6CDD1D) + hashes[j:size + j]
    return mix(acc)


def give_back() -> None:
    """Hand memory that is free but kept by the allocators back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # GNU C library only
    if trim is not None:
        trim(0)


def frugal(run):
    """An Arrow function that gives memory back at its end: Python workers outlive their tasks,
    and what one operator's arrays took would else be held beside the next one's."""
    def each(batches):
        yield from run(batches)
        give_back()
    return each


def column(batch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def doc_texts(docs):
    """``doc_id`` as long and ``text`` as string, whatever other columns there are; rows with a
    null id take no part in any operator."""
    from pyspark.sql import functions as F

    from tripdeck.llm.stages import small_batches
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).where("doc_id is not null")


def compact(docs, keys=("doc_id",)):
    """(doc_id, z): each whole text zstd-compressed, the form in which texts are shuffled.
    With other ``keys``, long columns of ``docs``, these instead of doc_id."""
    keys = list(keys)

    def pack(batches):
        codec = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data, off = buffers(column(batch, "text"))
            z = [codec.compress(data[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c) for c in keys), pa.array(z, pa.binary())], [*keys, "z"])
    docs = doc_texts(docs) if keys == ["doc_id"] else docs.select(*keys, "text")
    return docs.mapInArrow(frugal(pack), ", ".join(f"{c} long" for c in [*keys]) + ", z binary")


def unpack(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a ``z`` column; null counts as empty."""
    codec = zstandard.ZstdDecompressor()
    parts = [codec.decompress(v) if v else b"" for v in column.to_pylist()]
    off = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=off[1:])
    return np.frombuffer(b"".join(parts), np.uint8), off
