"""Token ids as binary files: independent zstandard frames, a table of documents, and a seek table with a checksum of every frame, so that a reader decompresses only the frames that its documents touch.

A file holds the ids of consecutive documents as little-endian uint32, cut into frames of FRAME ids each (the last is shorter); frame i has the ids from i * FRAME on. Then come two skippable frames: the documents (ids, starts and lengths, compressed), and the seek table of the zstandard seekable format: compressed size, size and the low half of XXH64 for each frame, then the number of frames, a descriptor byte and the magic number. Plain zstandard tools decompress the file to the bare ids.
"""

from __future__ import annotations

import functools
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import fresh, prepare
from textmill.llm.pieces import PieceMemo, begins_white, ends_white, grouped

#: Ids in a frame.
FRAME = 65_536
#: Fixed values of the seekable format.
SEEK_MAGIC, SKIP_SEEK, SKIP_DOCS, CHECKSUMS = 0x8F92EAB1, 0x184D2A5E, 0x184D2A50, 0x80
#: Text that is encoded in one call.
CHUNK = 32_768


class FileTokenizer:
    """A tokenizer of the tokenizers library with a byte-level vocabulary, behind a memo of pieces.

    Strings of special tokens in a text are ordinary text, as the vocabulary files' own description has it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.sizes[i] = len(token)  # the byte-level alphabet has one character a byte
        self.memo = PieceMemo(self.encode_pieces)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces go through the library many at a time: where a piece begins with one space, or a line feed is put before it, it is a match of the pattern apart from what stands before, and the tokens' sizes show where it ends."""
        out: list = [None] * len(pieces)
        chunks: list[tuple[list[int], list[bytes]]] = []
        alone: list[int] = []
        room = 0
        for i, p in enumerate(pieces):
            if ends_white(p) or (begins_white(p[1:]) if p[0] == 32 else begins_white(p)):
                alone.append(i)
                continue
            if room <= 0:
                chunks.append(([], []))
                room = CHUNK
            p = p if p[0] == 32 else b"\n" + p
            chunks[-1][0].append(i)
            chunks[-1][1].append(p)
            room -= len(p)
        for k in range(0, len(chunks), 64):
            some = chunks[k : k + 64]
            joined = [b"".join(parts).decode("utf-8", "replace") for _, parts in some]
            for (at, parts), e in zip(some, self.tok.encode_batch_fast(joined, add_special_tokens=False), strict=True):
                ids = np.array(e.ids, np.uint32)
                ends, wanted = np.cumsum(self.sizes[ids]), np.cumsum([len(p) for p in parts])
                cut = np.searchsorted(ends, wanted)
                if len(ids) == 0 or cut[-1] >= len(ids) or (ends[cut] != wanted).any():
                    alone.extend(at)
                    continue
                begin = 0
                for i, p, stop in zip(at, parts, (cut + 1).tolist(), strict=True):
                    out[i] = ids[begin + (p[0] == 10) : stop]
                    begin = stop
        whole = self.tok.encode_batch_fast([pieces[i].decode("utf-8", "replace") for i in alone], add_special_tokens=False)
        for i, e in zip(alone, whole, strict=True):
            out[i] = np.array(e.ids, np.uint32)
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))


@functools.cache
def tokenizer(path: str) -> FileTokenizer:
    return FileTokenizer(path)


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path[5:])


class FrameWriter:
    """Writes one file; ids may come in parts of any size."""

    def __init__(self, stream, level: int = 3):
        self.stream, self.codec = stream, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.buffer, self.table, self.docs, self.n = bytearray(), [], [], 0

    def add(self, keys: list[int | None], ids: np.ndarray, ends: np.ndarray) -> None:
        """The ids of some documents in a row; ends: where each document's end."""
        sizes = np.diff(ends, prepend=0)
        self.docs.extend(zip(keys, (ends - sizes + self.n).tolist(), sizes.tolist(), strict=True))
        self.n += len(ids)
        self.buffer += memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
        at, size = 0, 4 * FRAME
        while len(self.buffer) - at >= size:
            self._frame(bytes(memoryview(self.buffer)[at : at + size]))
            at += size
        if at:
            del self.buffer[:at]

    def _frame(self, raw: bytes) -> None:
        packed = self.codec.compress(raw)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.stream.write(packed)

    def close(self) -> None:
        if self.buffer:
            self._frame(bytes(self.buffer))
        null = np.array([d is None for d, _, _ in self.docs], np.uint8)
        keys = np.array([d or 0 for d, _, _ in self.docs], "<i8")
        sizes = np.array([n for _, _, n in self.docs], "<u8")
        body = self.codec.compress(struct.pack("<Q", len(self.docs)) + null.tobytes() + keys.tobytes() + sizes.tobytes())
        self.stream.write(struct.pack("<II", SKIP_DOCS, len(body)) + body)
        seek = b"".join(struct.pack("<III", *x) for x in self.table) + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEK_MAGIC)
        self.stream.write(struct.pack("<II", SKIP_SEEK, len(seek)) + seek)


class FrameReader:
    """Reads one file by its tables; only frames that are asked for are read and decompressed."""

    def __init__(self, path: str):
        system, place = open_fs(path)
        self.file, self.codec = system.open_input_file(place), zstandard.ZstdDecompressor()
        size = self.file.size()
        n, kind, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not kind & CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.packed, self.sums = table[:, 0].astype(np.int64), table[:, 2]
        self.starts = np.concatenate([[0], np.cumsum(self.packed)])
        at = int(self.starts[-1])
        magic, length = struct.unpack("<II", self._at(at, 8))
        if magic != SKIP_DOCS:
            raise ValueError(f"{path} has no table of documents")
        body = self.codec.decompress(self._at(at + 8, length))
        (count,) = struct.unpack_from("<Q", body)
        null = np.frombuffer(body, np.uint8, count, 8)
        self.keys, self.null = np.frombuffer(body, "<i8", count, 8 + count), null.astype(bool)
        self.sizes = np.frombuffer(body, "<u8", count, 8 + 9 * count).astype(np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self._last: tuple[int, bytes] = (-1, b"")

    def _at(self, place: int, n: int) -> bytes:
        self.file.seek(place)
        return self.file.read(n)

    def frame(self, i: int) -> bytes:
        if self._last[0] != i:
            raw = self.codec.decompress(self._at(int(self.starts[i]), int(self.packed[i])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i} does not match its checksum")
            self._last = (i, raw)
        return self._last[1]

    def parts(self, row: int) -> Iterator[memoryview]:
        """The ids of the document in the given row, frame by frame."""
        at, end = 4 * int(self.begins[row]), 4 * int(self.begins[row] + self.sizes[row])
        while at < end:
            raw, begin = self.frame(at // (4 * FRAME)), at // (4 * FRAME) * 4 * FRAME
            stop = min(end, begin + len(raw))
            yield memoryview(raw)[at - begin : stop - begin]
            at = stop

    def documents(self, wanted: Iterable[int]) -> dict[int, np.ndarray]:
        """ids of the wanted documents that the file holds (of rows with one id, the first)."""
        out: dict[int, np.ndarray] = {}
        for d in wanted:
            if len(rows := np.flatnonzero((self.keys == d) & ~self.null)):
                out[d] = np.frombuffer(b"".join(self.parts(int(rows[0]))), "<u4")
        return out

    def close(self) -> None:
        self.file.close()


def write_token_files(docs: DataFrame, folder: str, *, tokenizer_file: str, end_id: int = 0, text: str = "text", doc_id: str = "doc_id") -> list[tuple[str, int, int, int]]:
    """Encodes every text, with end_id after each, and writes files in ascending order of doc_id (null first, ties by a hash of the text). Returns (path, first id, ids, documents) of each file in order.

    Documents are dealt out by ranges of doc_id, so each task writes one file on its own; the file names are unique to the attempt, and only those of attempts that succeeded are returned. Null texts count as empty. What the driver gets is a row a file.
    """
    prepare(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"coalesce(cast(`{text}` as string), '') as text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(tokenizer_file)
        writer = stream = None
        for b in grouped(batches):
            if not b.num_rows:
                continue
            if writer is None:
                system, top = open_fs(folder)
                system.create_dir(top, recursive=True)
                place = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids.zst"
                stream = system.open_output_stream(f"{top}/{place}", compression=None)
                writer = FrameWriter(stream)
            keys = b.column(0).to_pylist()
            for first, stop, ids, ends in model.memo.encode_column(b.column(1)):
                writer.add(keys[first:stop], np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1))
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([f"{folder}/{place}"]), pa.array([writer.n], pa.int64()), pa.array([len(writer.docs)], pa.int64())], ["part", "path", "n", "docs"])

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    files = sorted(map(tuple, dealt.mapInArrow(run, "part long, path string, n long, docs long").collect()))
    out, start = [], 0
    for _, path, n, count in files:
        out.append((path, start, n, count))
        start += n
    return out


def read_token_files(spark, files: list[tuple[str, int, int, int]]) -> DataFrame:
    """One row a document of the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32; every frame is checked against its checksum."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                r = FrameReader(path)
                for k in range(0, len(r.keys), 10_000):
                    rows = range(k, min(k + 10_000, len(r.keys)))
                    sums = [functools.reduce(lambda c, part: zlib.crc32(part, c), r.parts(i), 0) for i in rows]
                    part = slice(k, k + 10_000)
                    yield pa.RecordBatch.from_arrays([pa.array(r.keys[part], mask=r.null[part]), pa.array(r.begins[part] + base), pa.array(r.sizes[part]), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                r.close()

    table = spark.createDataFrame([f[:2] for f in files], "path string, base long")
    return table.repartition(max(1, len(files))).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, *, tokenizer_file: str, end_id: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Writes the files to a new folder of spark.checkpoint.dir and reads them back: doc_id, start, n_tokens, ids_crc32 for every document. An empty table gives no file and no rows; repeated rows each have their place."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, fresh(spark, "token-ids"), tokenizer_file=tokenizer_file, end_id=end_id, text=text, doc_id=doc_id))
