"""Vectorised word hashing over batches of texts (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are hashed together up to so many bytes; a longer text forms a chunk of its own.
CHUNK_BYTES = 1 << 18

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8).tobytes()
_R = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one-to-one)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts as UTF-8; null as empty), about CHUNK_BYTES each."""
    first, size, out = 0, 0, []
    for i, value in enumerate(texts):
        text = value.as_py()
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        if out and size + len(raw) > CHUNK_BYTES:
            yield first, out
            first, size, out = i, 0, []
        out.append(raw)
        size += len(raw) + 1
    if out:
        yield first, out


def blank(data: np.ndarray) -> np.ndarray:
    """Whether each byte is ASCII white space."""
    return (data == 32) | (data - np.uint8(9) <= 4)


def word_spans(raws: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start and end of each word, row of each word); words are runs without ASCII white space."""
    whole = b"\n".join(raws) + b"\n"
    data = np.frombuffer(whole.translate(_LOWER) if lower else whole, np.uint8)
    space = blank(data)
    edge = np.flatnonzero(np.concatenate((~space[:1], space[1:] != space[:-1])))
    starts, ends = edge[0::2], edge[1::2]
    bounds = np.cumsum([len(r) + 1 for r in raws])
    return data, starts, ends, np.repeat(np.arange(len(raws)), np.diff(np.searchsorted(starts, bounds), prepend=0))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _R, np.uint64))
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    values = (data[np.repeat(starts, lengths) + place].astype(np.uint64) + np.uint64(1)) * powers[place]
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))


def gram_hashes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of so many words inside one row."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = (total + words[k:k + n]) * _R
    inside = rows[:n] == rows[size - 1:]
    return mix(total[inside]), rows[:n][inside]


def shingles(raws: list[bytes], size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its lower-cased word shingles; a shorter text is one shingle."""
    data, starts, ends, rows = word_spans(raws, lower=True)
    words = word_hashes(data, starts, ends)
    hashes, owners = gram_hashes(words, rows, size)
    cuts = np.searchsorted(owners, np.arange(len(raws) + 1))
    firsts = np.searchsorted(rows, np.arange(len(raws) + 1))
    out = []
    for i in range(len(raws)):
        own = hashes[cuts[i]:cuts[i + 1]]
        count = firsts[i + 1] - firsts[i]
        if not len(own) and count:
            total = np.uint64(count)
            for w in words[firsts[i]:firsts[i + 1]]:
                total = mix(np.array([total * _R + w], np.uint64))[0]
            own = np.array([total], np.uint64)
        own = np.sort(own)
        out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return out


def bucket_grams(raws: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of all hashed n-grams of the texts, in three tables of 2**bits buckets each.

    The tables hold lower-cased words, pairs of neighbouring words (by the difference of their hashes, so that
    an immediate repetition is one bucket whatever the word) and runs of three bytes inside a text.
    """
    shift, size = np.uint64(64 - bits), 1 << bits
    low, starts, ends, rows = word_spans(raws, lower=True)
    words = word_hashes(low, starts, ends)
    pairs = mix((words[1:] - words[:-1]))[rows[1:] == rows[:-1]] if len(words) else words
    data = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8).astype(np.uint32)
    triples = ((data[:-2] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA77)) ^ (data[2:] * np.uint32(0xC2B2AE3D)))
    owners = np.repeat(np.arange(len(raws)), [len(r) + 1 for r in raws])[:len(triples)]
    same = rows[1:] == rows[:-1]
    return (
        np.concatenate([
            (words >> shift).astype(np.int64), (pairs >> shift).astype(np.int64) + size,
            (triples >> np.uint32(32 - bits)).astype(np.int64) + 2 * size,
        ]),
        np.concatenate([rows, rows[1:][same], owners]),
    )
