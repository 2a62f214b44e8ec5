"""Byte-level BPE by rank files, with numpy: matches of the pattern are laid out by length in padded matrices, and in each round every row merges its leftmost pair of lowest rank; pairs are looked up in an open hash table, merged rows are compacted, and finished rows leave.

A round copies whole rows, so a match of n bytes would cost n * n: matches of more than LONG bytes (runs of one character, texts without spaces) take the same merges in the same order from a heap of pairs over linked places, in n log n.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from textmill.llm.common import prepare, resting
from textmill.llm.pieces import MEMO_BYTES, PieceMemo, buffers, gather, grouped

NONE = np.int32(2**31 - 1)
#: Cells of a matrix: bounds its memory.
CELLS = 1_000_000
#: Bytes of text that are encoded and decoded at once, unless one text alone has more: arrays over them take some thirty times as much.
SLICE_BYTES = 2 << 20
#: Bytes of a match from which a heap takes the place of a row.
LONG = 512


class Bpe:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pairs: dict[tuple[int, int], int] = {}
        self.pattern = regex.compile(pattern)
        self._table()
        self.memo = PieceMemo(self.encode_pieces, most=MEMO_BYTES // 2)

    def _table(self) -> None:
        """The hash table of pairs: every way to cut a token in two that are tokens themselves. A power of two of slots, under a quarter full; linear probing."""
        keys, values = [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    values.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        key, value = np.array(keys, np.int64), np.array(values, np.int32)
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = key[free]  # of several keys for a slot the last one stays
            won = self.keys[slot] == key
            self.values[slot[won]] = value[won]
            key, value, slot = key[~won], value[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or NONE; a negative id has no pair."""
        key = left << 20 | right
        out = np.full(key.shape, NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        flat, wanted = out.reshape(-1), key.reshape(-1)
        slot = self._slot(wanted[todo])
        while len(todo):
            found = self.keys[slot]
            hit = found == wanted[todo]
            flat[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (found >= 0)
            todo, slot = todo[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def merge(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids: one row a match, padded with -1 on the right. (ids that remain, row after row; how many each row has)."""
        done = np.full(ids.shape, -1, np.int64)
        where = np.arange(len(ids))
        rank = self.lookup(ids[:, :-1], ids[:, 1:])
        while len(ids):
            at = rank.argmin(1) if rank.shape[1] else np.zeros(len(ids), np.int64)
            best = rank[np.arange(len(ids)), at] if rank.shape[1] else np.full(len(ids), NONE)
            over = best == NONE
            if over.any():
                done[where[over], : ids.shape[1]] = ids[over]
                ids, rank, where, at, best = (x[~over] for x in (ids, rank, where, at, best))
                if not len(ids):
                    break
            n, r = ids.shape[1], np.arange(len(ids))
            # compaction: what stands right of the merged pair moves one place left
            ids[r, at] = best
            column = np.arange(n - 1)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), 1)
            if n > 2:
                rank = np.take_along_axis(rank, (c := column[:-1]) + (c >= at[:, None]), 1)
                # new pairs left and right of the merged token
                left = np.flatnonzero(at > 0)
                rank[left, at[left] - 1] = self.lookup(ids[left, at[left] - 1], ids[left, at[left]])
                right = np.flatnonzero(at < n - 2)
                rank[right, at[right]] = self.lookup(ids[right, at[right]], ids[right, at[right] + 1])
            else:
                rank = rank[:, :0]
            # columns that no row needs any longer
            if n > 3 and (ids[:, -1] < 0).all():
                ids, rank = ids[:, :-1], rank[:, :-1]
        return done[done >= 0], (done >= 0).sum(1)

    def merge_long(self, match: bytes) -> np.ndarray:
        """The ids of one long match: the pair of lowest rank, the leftmost of equals, is merged as long as there is one."""
        start = self.byte[np.frombuffer(match, np.uint8)]
        ids, n = start.tolist(), len(match)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        rank = self.lookup(start[:-1], start[1:])
        some = np.flatnonzero(rank != NONE)
        heap = list(zip(rank[some].tolist(), some.tolist(), start[some].tolist(), start[some + 1].tolist(), strict=True))
        heapq.heapify(heap)
        pairs, alive = self.pairs, bytearray(b"\1" * n)

        def push(i: int, j: int) -> None:
            r = pairs.get((ids[i], ids[j]))
            if r is None:
                r = pairs[ids[i], ids[j]] = int(self.lookup(np.array([ids[i]]), np.array([ids[j]]))[0])
                if len(pairs) > 100_000:
                    pairs.clear()
            if r != NONE:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], alive[j] = r, 0
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                push(i, k)
            if before[i] >= 0:
                push(before[i], i)
        return np.array(ids, np.int64)[np.frombuffer(alive, np.uint8) > 0]

    def encode_matches(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all matches in a row, how many each has)."""
        sizes = np.zeros(len(matches), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # matches, and their ids in a row
        whole = list(map(self.ranks.get, matches))
        found = np.array([i for i, r in enumerate(whole) if r is not None], np.int64)
        sizes[found] = 1
        parts.append((found, np.array([r for r in whole if r is not None], np.int64)))
        by_width: dict[int, list[int]] = {}
        for i, m in enumerate(matches):
            if whole[i] is not None or not m:
                continue
            if len(m) > LONG:
                ids = self.merge_long(m)
                sizes[i] = len(ids)
                parts.append((np.array([i]), ids))
            else:
                by_width.setdefault((len(m) + 3) // 4 * 4 if len(m) <= 64 else 1 << (len(m) - 1).bit_length(), []).append(i)
        for width, rows in sorted(by_width.items()):
            step = max(1, CELLS // width)
            for k in range(0, len(rows), step):
                some = rows[k : k + step]
                joined = np.frombuffer(b"".join([matches[i].ljust(width, b"\0") for i in some]), np.uint8).reshape(len(some), width)
                filled = np.fromiter((len(matches[i]) for i in some), np.int64, len(some))
                ids, n = self.merge(np.where(np.arange(width) < filled[:, None], self.byte[joined], -1))
                sizes[some] = n
                parts.append((np.array(some), ids))
        store = np.concatenate([ids for _, ids in parts])
        starts = np.zeros(len(matches), np.int64)
        base = 0
        for rows, ids in parts:
            starts[rows] = base + np.cumsum(sizes[rows]) - sizes[rows]
            base += len(ids)
        return gather(store, starts, sizes).astype(np.uint32), sizes

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, how many each has). A word, alone or behind a space, is one match; the pattern takes the others apart."""
        once: dict[bytes, int] = {}
        of, number = [], []
        for p in pieces:
            t = p.decode("utf-8", "replace")
            if t.isalpha() or t[0] == " " and t[1:].isalpha():
                of.append(once.setdefault(p, len(once)))
                number.append(1)
            else:
                found = [once.setdefault(m.encode(), len(once)) for m in self.pattern.findall(t)]
                of.extend(found)
                number.append(len(found))
        ids, sizes = self.encode_matches(list(once))
        of = np.array(of, np.int64)
        through = np.concatenate([[0], np.cumsum(sizes[of])])
        ends = through[np.cumsum(number)]
        return gather(ids, (np.cumsum(sizes) - sizes)[of], sizes[of]), np.diff(ends, prepend=0)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids in a row, where those of each id end)."""
        sizes = self.sizes[ids]
        return gather(self.blob, self.starts[ids], sizes), np.cumsum(sizes)


@functools.cache
def bpe(path: str, pattern: str) -> Bpe:
    return Bpe(path, pattern)


def encode_decode(docs: DataFrame, *, ranks: str, pattern: str, text: str = "text", doc_id: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """One row a document: doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes, exact (the decoded bytes are the text's); with keep_ids also ids (array of int).

    Null texts count as empty: no ids, and the digests of nothing. Texts go through whole, however long: a batch is cut into slices of a bounded number of bytes, of which one very long text is one. Rows are encoded alone, so repeated rows and ids give repeated results, a null doc_id stays null and an empty table gives none; other columns of docs, whatever their names, are not read. ranks: path of a rank file that every executor can open.
    """
    prepare(docs.sparkSession)
    fields = ["doc_id long", "n_tokens long", "ids_sha256 string", "decoded_sha256 string", "n_bytes long", "exact boolean", "ids array<int>"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int32())]
    wide = len(fields) if keep_ids else len(fields) - 1
    names = [f.split()[0] for f in fields[:wide]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(ranks, pattern)
        for batch in grouped(batches, SLICE_BYTES):
            keys = batch.column(0).to_pylist()
            offsets, data = buffers(batch.column(1))
            for first, stop, ids, ends in model.memo.encode_column(batch.column(1), SLICE_BYTES):
                back, byte_ends = model.decode(ids)
                byte_ends = np.concatenate([[0], byte_ends])
                rows, begin, low = [], 0, 0
                for i, end in zip(range(first, stop), ends.tolist(), strict=True):
                    high = int(byte_ends[end])
                    own, body = ids[begin:end].astype("<u4", copy=False), back[low:high]
                    exact = np.array_equal(body, data[offsets[i] : offsets[i + 1]])
                    row = [keys[i], end - begin, hashlib.sha256(own.tobytes()).hexdigest(), hashlib.sha256(body).hexdigest(), high - low, exact]
                    rows.append([*row, own.astype(np.int32)] if keep_ids else row)
                    begin, low = end, high
                columns = list(zip(*rows, strict=True)) or [()] * wide
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds[:wide], strict=True)], names)

    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"cast(`{text}` as string) as text")
    return rows.mapInArrow(resting(run), ", ".join(fields[:wide]))
