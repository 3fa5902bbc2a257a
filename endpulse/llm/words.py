"""Words and their hashes for a whole Arrow batch at once, inside tasks.

A word is a run of digits, letters a-z (A-Z are lower-cased) and bytes from 0x80,
which on UTF-8 is the class [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ on characters.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib

import numpy as np
import pyarrow as pa

LONG = 64  # bytes; longer words have a digest for a hash, as products of powers collide for some of them
BLOCK = 1 << 20  # bytes hashed at once; only a single longer word needs more
MULT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of MULT and of its inverse, at least n of them; kept for the next call."""
    if len(_powers.get("up", ())) < n:
        n = max(n, BLOCK + 1)
        for name, base in (("up", MULT), ("down", pow(MULT, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offsets[0]:offsets[-1]]
    return offsets - offsets[0], raw


def word_hashes(offsets: np.ndarray, raw: np.ndarray):
    """Per word: hash, text number, first byte, end byte (in raw)."""
    n = len(raw)
    hashes, begins, ends = [], [], []
    edges = np.zeros(n + 1, dtype=bool)
    edges[offsets] = True
    at = 0
    while at < n:
        to = min(n, at + BLOCK)
        while to < n and not edges[to] and IS_WORD[LOWER[raw[to - 1]]] and IS_WORD[LOWER[raw[to]]]:
            to += 1
        low = LOWER[raw[at:to]]
        word = IS_WORD[low]
        gap = edges[at:to + 1]
        starts = word.copy()
        starts[1:] &= ~word[:-1] | gap[1:-1]
        stops = word.copy()
        stops[:-1] &= ~word[1:] | gap[1:-1]
        b, e = np.flatnonzero(starts), np.flatnonzero(stops) + 1
        up, down = powers(to - at)
        total = np.zeros(to - at + 1, dtype=np.uint64)
        np.cumsum(low * up[:to - at], dtype=np.uint64, out=total[1:])
        found = mix((total[e] - total[b]) * down[b])
        for i in np.flatnonzero(e - b > LONG).tolist():
            found[i] = int.from_bytes(hashlib.blake2b(low[b[i]:e[i]].tobytes(), digest_size=8).digest(), "little")
        hashes.append(found)
        begins.append(b + at)
        ends.append(e + at)
        at = to
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    begins, ends = join(begins, np.int64), join(ends, np.int64)
    texts = np.searchsorted(offsets, begins, side="right") - 1
    return join(hashes, np.uint64), texts, begins, ends


def hash_word(text: str) -> int:
    """The hash that word_hashes gives this one word."""
    offsets, raw = text_bytes(pa.array([text]))
    found = word_hashes(offsets, raw)[0]
    if len(found) != 1:
        raise ValueError(f"not one word: {text!r}")
    return int(found[0])


def gram_hashes(hashes: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
    """Hash of the words at each of the given distances; one entry per possible first word."""
    n = max(0, len(hashes) - steps[-1])
    out = np.full(n, len(steps), dtype=np.uint64)
    for s in steps:
        out *= np.uint64(MULT)
        out += hashes[s:s + n]
        out += np.uint64(s)
    return mix(out)


def slices(batch: pa.RecordBatch, column: str, most: int = BLOCK):
    """Parts of a batch of about `most` bytes of text, at least one row each."""
    if not batch.num_rows:
        return
    offsets, _ = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(batch.num_rows, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to


def freeing(task):
    """A task that gives its memory back to the system when it ends; the worker lives on, perhaps idle."""
    def run(batches):
        yield from task(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass
    return run
