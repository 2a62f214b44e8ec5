"""Cuts whole texts into pieces that a byte-level BPE tokenizer encodes alone, many texts at a time, and keeps the ids of pieces in a memo bounded by bytes.

The tokenizers' pattern never matches across the places cut here: before white space that follows another character; before the last space of a run of white space if a word follows; after white space that is no space; between a letter and an ASCII mark other than the apostrophe. Where a neighbour may be white space beyond ASCII nothing is cut, so a piece may hold several matches; the tokenizer takes them apart itself. Cutting, counting out repeats and gathering ids work on whole Arrow buffers; Python sees distinct new pieces only.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are cut and encoded at once, unless one text alone has more.
SLICE_BYTES = 6 << 20
#: Bytes of pieces and ids that a memo holds, about, before it starts afresh with the pieces at hand.
MEMO_BYTES = 64 << 20
#: What a piece costs in a memo besides its bytes.
ENTRY_BYTES = 160
#: Stretches that are gathered at once.
GATHERED = 1 << 17
#: Longer pieces are not kept.
LONGEST = 64

OTHER, SPACE, BREAK, LETTER, MARK, DIGIT, UNSURE = range(7)


def _kinds() -> np.ndarray:
    kind = np.full(256, OTHER, np.uint8)
    kind[[9, 10, 11, 12, 13]] = BREAK
    kind[32] = SPACE
    kind[28:32] = UNSURE  # white space to some pattern libraries
    kind[[0xC2, 0xE1, 0xE2, 0xE3]] = UNSURE  # first bytes of all white space beyond ASCII
    kind[48:58] = DIGIT
    kind[65:91] = kind[97:123] = LETTER
    for c in b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~":
        kind[c] = MARK
    return kind


KIND = _kinds()


def cuts(raw: np.ndarray) -> np.ndarray:
    """Where pieces begin in bytes of UTF-8, besides at 0; ascending."""
    if len(raw) < 2:
        return np.empty(0, np.int64)
    kind = KIND[raw]
    white = (kind == SPACE) | (kind == BREAK)
    # a byte whose character may be white space beyond ASCII, first byte or later one
    unsure = kind == UNSURE
    late = raw >= 0x80
    spread = unsure.copy()
    spread[1:] |= unsure[:-1] & late[1:]
    spread[2:] |= unsure[:-2] & late[1:-1] & late[2:]
    solid = ~white & ~spread
    before, here = slice(None, -1), slice(1, None)
    cut = white[here] & solid[before]
    cut |= solid[here] & (kind[before] == BREAK)
    last = np.zeros(len(raw) - 1, bool)
    last[:-1] = (kind[1:-1] == SPACE) & white[:-2] & solid[2:]
    cut |= last
    letter, mark = kind == LETTER, kind == MARK
    cut |= letter[before] & mark[here]
    cut |= mark[before] & letter[here]
    return np.flatnonzero(cut) + 1


#: White space in UTF-8, by first byte and whole.
WHITE = frozenset(c.encode() for c in map(chr, range(0x3001)) if c.isspace())


def begins_white(piece: bytes) -> bool:
    """Whether a piece's first character is white space."""
    return piece[:1] in WHITE if piece[0] < 0x80 else piece[:2] in WHITE or piece[:3] in WHITE


def ends_white(piece: bytes) -> bool:
    return piece[-1:] in WHITE if piece[-1] < 0x80 else piece[-2:] in WHITE or piece[-3:] in WHITE


def gather(store: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of store that begin at starts and have the given sizes, one after the other."""
    if len(sizes) > GATHERED:  # places take far more than what they find, so they are made for some stretches at a time
        return np.concatenate([gather(store, starts[k : k + GATHERED], sizes[k : k + GATHERED]) for k in range(0, len(sizes), GATHERED)])
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64)
    at += np.repeat(starts - (ends - sizes), sizes)
    return store[at]


def slices(sizes: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first, end) of rows that together have at most so many bytes, or of one larger row."""
    first, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and held + n > most:
            yield first, i
            first, held = i, 0
        held += n
    if len(sizes) > first:
        yield first, len(sizes)


def grouped(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have so many bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if held and size + b.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(b)
        size += b.nbytes
    if held:
        yield pa.concat_batches(held)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a column of strings; null: empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, 8 * column.offset) if offsets is not None and n else np.zeros(n + 1, np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


class PieceMemo:
    """encode gets a list of distinct pieces as bytes and returns (ids of all of them, how many each has)."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = MEMO_BYTES):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.store, self.held = np.empty(0, np.uint32), 0

    def _known(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(store, starts, sizes) that hold the ids of the given distinct pieces."""
        at = np.fromiter(map(self.place.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(at < 0)
        if not len(new):
            return self.store, self.starts[at], self.sizes[at]
        fresh = [pieces[i] for i in new.tolist()]
        ids, sizes = self.encode(fresh)
        starts = np.cumsum(sizes) - sizes
        store = np.concatenate([self.store, ids])
        out_starts, out_sizes = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        old = at >= 0
        out_starts[old], out_sizes[old] = self.starts[at[old]], self.sizes[at[old]]
        out_starts[new], out_sizes[new] = starts + len(self.store), sizes
        if self.held > self.most:  # starts afresh: what the texts at hand use stays
            kept = pieces
            keep_starts, keep_sizes = out_starts, out_sizes
            body = gather(store, keep_starts, keep_sizes)
            self.clear()
        else:
            kept, keep_sizes, body = fresh, sizes, ids
        short = np.fromiter(map(len, kept), np.int64, len(kept)) <= LONGEST
        begin, base = np.cumsum(keep_sizes) - keep_sizes, len(self.place)
        some = kept if short.all() else [p for p, ok in zip(kept, short.tolist(), strict=True) if ok]
        self.place.update(zip(some, range(base, base + len(some)), strict=True))
        self.starts = np.concatenate([self.starts, begin[short] + len(self.store)])
        self.sizes = np.concatenate([self.sizes, keep_sizes[short]])
        self.store = np.concatenate([self.store, body])
        self.held += sum(map(len, some)) + ENTRY_BYTES * len(some) + 4 * len(body)
        return store, out_starts, out_sizes

    def encode_column(self, column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end, ids, ends) for slices, of at most so many bytes or one row, of a column of texts: the ids of the rows in a row, and where each row's end."""
        offsets, data = buffers(column)
        for first, end in slices(np.diff(offsets), most):
            low, high = int(offsets[first]), int(offsets[end])
            raw = data[low:high]
            edges = offsets[first : end + 1] - low
            if len(raw) == 0:
                yield first, end, np.empty(0, np.uint32), np.zeros(end - first, np.int64)
                continue
            begin = np.zeros(len(raw) + 1, bool)
            begin[edges] = begin[cuts(raw)] = True
            begins = np.flatnonzero(begin)
            pieces = pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(raw)])
            coded = pieces.dictionary_encode()
            code = coded.indices.to_numpy()
            store, starts, sizes = self._known(coded.dictionary.to_pylist())
            ids = gather(store, starts[code], sizes[code])
            through = np.concatenate([[0], np.cumsum(sizes[code])])
            yield first, end, ids, through[np.searchsorted(begins, edges[1:])]
