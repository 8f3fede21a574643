"""Token ids of many texts with the ``tokenizers`` library, each distinct chunk encoded once.

A text is cut before single spaces and line breaks, and between a letter and sentence marks, where both vocabularies
start a new word in any case, so the ids of a text are the ids of its chunks in order. Arrow finds the distinct chunks of
a slice of rows; the library encodes those the worker has not met yet; numpy lays the ids out. A chunk that is one run of
Latin letters is one word for both vocabularies (with sentence marks after it, two), and the library's model encodes
those directly. Texts where white space touches white space (one word may then reach over the cut) go to the library
whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A run of letters that no normaliser changes but for A-Z, and the marks that may follow it.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_WORD = f"^(?P<lead>[ \n]?)(?P<core>[{_LETTERS}]+)(?P<marks>[.,!?;:]*)$"
_LOWER = "^(?P<lead>)(?P<core>[a-z\u00df-\u00f6\u00f8-\u00ff]+)(?P<marks>[.,!?;:]*)$"

# Byte tables: A-Z to a-z and line breaks to spaces; ASCII letters; sentence marks.
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_LOWERED[10] = 32
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b".,!?;:")] = True

SLICE_BYTES = 6 << 20  # text bytes laid out at a time
KEEP_CHUNKS = 600_000  # chunks a worker remembers before it drops the rarer half
KEEP_WORDS = 150_000  # and words
KEEP_CHARS = 64  # longer chunks are not remembered

_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary file; ``spaced``: the space before a word belongs to the word's ids; ``plain``: the strings of its
    special tokens in a text are ordinary text (else the library finds the tokens themselves)."""
    file: str
    spaced: bool
    folder: str | None = None
    plain: bool = False

    def path(self) -> str:
        if self.folder:
            return f"{self.folder}/{self.file}"
        import public_tokenizers
        return public_tokenizers.path(self.file)


BYTE_BPE = Vocabulary("byte_bpe_50k.json", True)
WORD_BPE = Vocabulary("word_bpe_49k.json", False)
PLAIN_WORD_BPE = Vocabulary("word_bpe_49k.json", False, plain=True)

_ENCODERS: dict = {}


def encoder(vocabulary: Vocabulary) -> Encoder:
    """The worker's encoder for a vocabulary (the file is read once per worker)."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


class Remembered:
    """The ids of many strings one after another, and how often each was met."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.starts, self.lengths, self.hits = (np.zeros(1024, np.int64) for _ in range(3))
        self.flat, self.used, self.n = np.zeros(4096, np.uint32), 0, 0

    def places(self, strings: list[str]) -> np.ndarray:
        return np.fromiter(map(self.place.get, strings, repeat(-1)), np.int64, len(strings))

    def ids(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these entries one after another, and where each one's end."""
        lengths = self.lengths[entry]
        ends = np.cumsum(lengths)
        source = np.repeat(self.starts[entry] - (ends - lengths), lengths)
        source += np.arange(len(source))
        return self.flat[source], ends

    def add(self, strings: list[str], ids: np.ndarray, lengths: np.ndarray, hits: np.ndarray | int = 0) -> np.ndarray:
        """Appends strings that are not there yet; returns their places."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(strings) > len(self.starts):
            self.starts, self.lengths, self.hits = (
                np.concatenate([a, np.zeros_like(a)]) for a in (self.starts, self.lengths, self.hits))
        self.flat[self.used:self.used + len(ids)] = ids
        at = slice(self.n, self.n + len(strings))
        self.starts[at] = self.used + np.cumsum(lengths) - lengths
        self.lengths[at], self.hits[at] = lengths, hits
        self.place.update(zip(strings, range(self.n, self.n + len(strings))))
        self.used, self.n = self.used + len(ids), self.n + len(strings)
        return np.arange(at.start, at.stop)

    def frequent(self) -> Remembered:
        """The half of the strings that was met more often, with halved counts."""
        hits = self.hits[:self.n]
        keep = np.flatnonzero(hits > np.median(hits))
        strings = list(self.place)  # in the order of their places
        out = Remembered()
        out.add([strings[k] for k in keep.tolist()], self.ids(keep)[0], self.lengths[keep], hits[keep] // 2)
        return out


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary.path())
        if vocabulary.plain:
            self.library.encode_special_tokens = True
        # Texts with such a string, in any case, are encoded whole.
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = "(?i)" + "|".join(map(re.escape, special)) if special and not vocabulary.plain else None
        self.model = self.library.model
        self.spaced = vocabulary.spaced
        # A chunk that is always one id of its own marks the cuts when many chunks are encoded in one call.
        self.mark = " |" if self.spaced else " | "
        self.mark_id = self.whole(self.mark)[0]
        # Bytes of each id: its characters stand for one byte each, but for the mark of a word's end.
        words = self.library.get_vocab(with_added_tokens=True)
        self.widths = np.zeros(max(words.values()) + 1, np.int64)
        for word, k in words.items():
            self.widths[k] = len(word.removesuffix("</w>"))
        self.pattern = _WORD if self.spaced else _LOWER
        # The vocabulary writes each byte as one character: printable ones as themselves, the rest from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(256 + k) for k, b in enumerate(rest)}
        self.chunks, self.words = Remembered(), Remembered()

    def whole(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _word(self, word: str) -> list[int]:
        """Ids of one word (as the library cuts texts) from the library's model."""
        if not word:
            return []
        if word.isascii():  # only the space or line break before it has another character
            spelt = self.letters[ord(word[0])] + word[1:] if word[0] in " \n" else word
        else:
            spelt = word.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(spelt)]

    def _plain(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(which, ids, lengths)``: the chunks of letters and sentence marks, and their ids. Each is a line break or
        nothing, a word with the space before it, and the marks; distinct words are encoded once."""
        parts = pc.extract_regex(chunks, self.pattern)
        fits = pc.and_(parts.is_valid(), pc.less_equal(pc.utf8_length(chunks), KEEP_CHARS))
        which = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
        lead, core, marks = parts.take(pa.array(which)).flatten()
        new_line = pc.equal(lead, "\n")
        first = pc.binary_join_element_wise(pc.if_else(new_line, "", lead), core, "")
        words = pa.concat_arrays([pc.if_else(new_line, "\n", ""), first, marks]).dictionary_encode()
        known = words.dictionary.to_pylist()
        if self.words.n + len(known) > KEEP_WORDS:
            self.words = Remembered()
        at = self.words.places(known)
        missing = np.flatnonzero(at < 0)
        new = [known[k] for k in missing.tolist()]
        rows = [self._word(w) for w in new]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        at[missing] = self.words.add(new, np.fromiter(chain.from_iterable(rows), np.uint32, int(lengths.sum())), lengths)
        entry = at[words.indices.to_numpy()].reshape(3, len(which)).T.ravel()
        ids, _ = self.words.ids(entry)
        return which, ids, self.words.lengths[entry].reshape(-1, 3).sum(axis=1)

    def _cut(self, chunks: list[str], ids: np.ndarray) -> np.ndarray | None:
        """Where the ids of each chunk end when all were encoded as one text: by the bytes the ids stand for.
        None where an id reaches over a cut or the normaliser changed lengths."""
        reach = np.cumsum(self.widths[ids])
        want = np.cumsum(np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks)))
        ends = np.searchsorted(reach, want) + 1
        return ends if len(reach) and ends[-1] == len(ids) and (reach[ends - 1] == want).all() else None

    def _together(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of many chunks from one call of the library."""
        ids = np.asarray(self.whole(("" if self.spaced else " ").join(chunks)), np.uint32)
        ends = self._cut(chunks, ids)
        if ends is None:  # then with a mark after each
            ids = np.asarray(self.whole(self.mark.join(chunks) + self.mark), np.uint32)
            marks = np.flatnonzero(ids == self.mark_id)
            assert len(marks) == len(chunks), "a mark was not encoded on its own"
            return [ids[m + 1:n] for m, n in zip([-1, *marks[:-1].tolist()], marks.tolist())]
        ends = ends.tolist()
        return [ids[m:n] for m, n in zip([0, *ends[:-1]], ends)]

    def _add(self, chunks: list[str]) -> np.ndarray:
        """Encodes chunks that are not remembered; returns their places."""
        at = np.empty(len(chunks), np.int64)
        which, ids, lengths = self._plain(pa.array(chunks, pa.string()))
        at[which] = self.chunks.add([chunks[k] for k in which.tolist()], ids, lengths)
        rest = np.setdiff1d(np.arange(len(chunks)), which)
        other = [chunks[k] for k in rest.tolist()]
        found = {}
        short = [c for c in other if "|" not in c and 0 < len(c) <= KEEP_CHARS]
        ready = [c for c in short if (c[0] == " ") == self.spaced and (self.spaced or c.isascii())]
        for group in (ready, sorted(set(short).difference(ready))):
            for begin in range(0, len(group), 20_000):
                part = group[begin:begin + 20_000]
                found.update(zip(part, self._together(part)))
        rows = [found[c] if c in found else self.whole(c) for c in other]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        at[rest] = self.chunks.add(other, np.fromiter(chain.from_iterable(rows), np.uint32, int(lengths.sum())), lengths)
        return at

    def _chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The chunks of all texts, and how many there are up to each text's end. A cut stands before a space, a line
        break, and sentence marks that follow a letter; a vocabulary that drops white space gets chunks without."""
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(data if data is not None else b"", np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        if not self.spaced:
            raw = _LOWERED[raw]
        blank = (raw == 32) | (raw == 10)
        start = blank.copy()
        if len(raw):
            letter = _IS_LETTER[raw]
            letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)  # the accented letters of Latin 1
            start[1:] |= _IS_MARK[raw[1:]] & letter[:-1]
            start[at[:-1][np.diff(at) > 0]] = True
        ends = np.append(np.flatnonzero(start), len(raw))
        last = np.searchsorted(ends[:-1], at[1:])
        if not self.spaced:
            ends = ends - np.searchsorted(np.flatnonzero(blank), ends)
            raw = raw[~blank]
        return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)), last

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: the ids of all texts one after another, and where each text's ids end. Null: none."""
        if pa.types.is_large_string(texts.type):
            texts = texts.cast(pa.string())
        texts = pc.fill_null(texts, "")
        odd: dict[int, np.ndarray] = {}
        strange = pc.match_substring_regex(texts, self.special) if self.special else pa.array([False] * len(texts), pa.bool_())
        if self.spaced:
            strange = pc.or_(strange, pc.match_substring_regex(texts, rf"{_SPACES}{_SPACES}|\x00"))
        if pc.any(strange).as_py():
            for k in np.flatnonzero(strange.to_numpy(zero_copy_only=False)):
                odd[int(k)] = np.asarray(self.whole(texts[int(k)].as_py()), np.uint32)
            texts = pc.if_else(strange, "", texts)
        chunks, last = self._chunks(texts)
        coded = chunks.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if self.chunks.n + len(words) > KEEP_CHUNKS:
            self.chunks = self.chunks.frequent()
        at = self.chunks.places(words)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            at[missing] = self._add([words[k] for k in missing.tolist()])
        entry = at[coded.indices.to_numpy()] if len(chunks) else np.zeros(0, np.int64)
        self.chunks.hits[:self.chunks.n] += np.bincount(entry, minlength=self.chunks.n)
        ids, ends = self.chunks.ids(entry)
        bounds = np.concatenate([[0], ends])[last]
        if odd:
            parts = np.split(ids, bounds[:-1]) if len(bounds) else []
            parts = [odd.get(k, p) for k, p in enumerate(parts)]
            ids = np.concatenate(parts)
            bounds = np.cumsum([len(p) for p in parts])
        return ids, bounds


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of rows with about ``size`` text bytes (a longer text is a run of its own)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    at = np.cumsum(lengths)
    begin = 0
    while begin < len(lengths):
        base = at[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(at, base + size, "right")))
        yield batch.slice(begin, end - begin)
        pa.default_memory_pool().release_unused()  # else Arrow keeps as much again as a worker uses
        begin = end


def encoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, text: str = "text"
            ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Per run of rows: the rows, all their ids, and where each row's ids end."""
    own = encoder(vocabulary)
    for batch in batches:
        for part in slices(batch, text):
            yield part, *own.texts(part.column(text))
