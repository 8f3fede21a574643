"""Word shingles of many texts at once: A-Z lower-cased, words between ASCII white space."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Byte table: A-Z to a-z, tab to carriage return to a space.
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[65:91] += 32
_TABLE[9:14] = 32
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_NEXT = np.uint64(0x9E3779B97F4A7C15)
_HASHES: dict[str, int] = {}
_KEEP = 250_000


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words one after another, and where each text's words end. Null: none."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, offsets, data = texts.buffers()
    if data is None:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    plain = pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(_TABLE[np.frombuffer(data, np.uint8)]),
                                        None, 0, texts.offset)
    lists = pc.split_pattern(plain, " ")
    chunks = lists.flatten()
    coded = chunks.dictionary_encode()
    words = coded.dictionary.to_pylist()
    if len(_HASHES) + len(words) > _KEEP:
        _HASHES.clear()
    own = np.empty(len(words) + 1, np.uint64)
    blank = -1
    for k, word in enumerate(words):
        h = _HASHES.get(word)
        if h is None:
            h = _HASHES[word] = xxhash.xxh3_64_intdigest(word)
        own[k] = h
        if not word:
            blank = k
    codes = coded.indices.to_numpy()
    real = codes != blank
    ends = np.concatenate([[0], np.cumsum(real)])[np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()]
    return own[codes[real]], ends


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Each text's set of distinct shingles of ``width`` words as ascending 64-bit fingerprints. A text with fewer
    words has its whole sequence as one shingle; one without words has none."""
    words, ends = _word_hashes(texts)
    begins = np.concatenate([[0], ends[:-1]])
    rolled = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            part = words[k:]
            rolled[:len(part)] = mix64(rolled[:len(part)] * _NEXT + part + np.uint64(k + 1))
        out = []
        for begin, end in zip(begins.tolist(), ends.tolist()):
            if end - begin >= width:
                out.append(np.unique(rolled[begin:end - width + 1]))
            elif end == begin:
                out.append(np.zeros(0, np.uint64))
            else:
                h = np.zeros(1, np.uint64)
                for k in range(end - begin):
                    h = mix64(h * _NEXT + words[begin + k] + np.uint64(k + 1))
                out.append(mix64(h + np.uint64(width - (end - begin))))
    return out
