"""Token-id files: one zstandard frame per document, seek table at the end.

A file is a sequence of independent zstandard frames in the public seekable
format: document frames in ascending doc_id order, one index frame, and a
skippable frame with the seek table (compressed size, plain size and the
low 32 bits of XXH64 for every frame). A reader fetches the table, finds a
document's frame and decompresses nothing else; a damaged frame fails its
checksum. Ids are little-endian, 2 bytes wide where the vocabulary allows
it and 4 bytes otherwise.

Writing sorts the documents by range over the cluster, so a hot source or a
long text loads no single task; each task streams its documents to one file
of its own name, and only files reported by finished tasks are listed.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagframe.llm.common import RangeReader, make_folder, map_columns, open_output, pick, spread
from lagframe.llm.tokens import encoder

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80
TABLE_ENTRY = struct.Struct("<III")
TABLE_FOOTER = struct.Struct("<IBI")
SKIPPABLE_HEADER = struct.Struct("<II")

END_ID = 2
FILE_SCHEMA = "partition long, path string, n_docs long, n_tokens long"
DOCUMENT_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
# Compressed bytes fetched at once when a whole file is read.
READ_BYTES = 8 << 20


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class TokenFileWriter:
    """Appends documents to one file; ``close`` adds index and seek table."""

    def __init__(self, path: str, width: int, level: int = 3):
        self.out, self.width = open_output(path), width
        self.codec = zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.n_tokens = 0

    def _frame(self, data: bytes) -> None:
        packed = self.codec.compress(data)
        self.out.write(packed)
        self.entries.append((len(packed), len(data), checksum(data)))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._frame(ids.astype(f"<u{self.width}").tobytes())
        self.doc_ids.append(doc_id)
        self.n_tokens += len(ids)

    def close(self) -> None:
        known = np.array([x is not None for x in self.doc_ids], dtype="u1")
        ids = np.array([x or 0 for x in self.doc_ids], dtype="<i8")
        head = json.dumps({"width": self.width, "docs": len(ids)}).encode()
        self._frame(struct.pack("<I", len(head)) + head + ids.tobytes() + known.tobytes())
        table = b"".join(TABLE_ENTRY.pack(*x) for x in self.entries)
        table += TABLE_FOOTER.pack(len(self.entries), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(SKIPPABLE_HEADER.pack(SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class TokenFile:
    """Reader of one file: the seek table and index first, then single frames."""

    def __init__(self, path: str):
        self.source = RangeReader(path)
        size = self.source.size
        n, flags, magic = TABLE_FOOTER.unpack(self.source.read(size - TABLE_FOOTER.size, TABLE_FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError(f"{path}: no seek table with checksums")
        table = self.source.read(size - TABLE_FOOTER.size - n * TABLE_ENTRY.size, n * TABLE_ENTRY.size)
        self.entries = list(TABLE_ENTRY.iter_unpack(table))
        self.offsets = [0, *accumulate(e[0] for e in self.entries)]
        self.codec = zstandard.ZstdDecompressor()
        index = self._plain(n - 1, self.source.read(self.offsets[n - 1], self.entries[n - 1][0]))
        length = struct.unpack_from("<I", index)[0]
        head = json.loads(index[4:4 + length])
        self.width, self.n_docs = head["width"], head["docs"]
        at = 4 + length
        ids = np.frombuffer(index, "<i8", self.n_docs, at).tolist()
        known = np.frombuffer(index, "u1", self.n_docs, at + 8 * self.n_docs).tolist()
        self.doc_ids = [i if k else None for i, k in zip(ids, known, strict=True)]

    def _plain(self, k: int, packed: bytes) -> bytes:
        data = self.codec.decompress(packed, max_output_size=self.entries[k][1]) if self.entries[k][1] else b""
        if len(data) != self.entries[k][1] or checksum(data) != self.entries[k][2]:
            raise ValueError(f"frame {k} fails its checksum")
        return data

    def _ids(self, k: int, packed: bytes) -> np.ndarray:
        return np.frombuffer(self._plain(k, packed), f"<u{self.width}").astype("<u4")

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document; reads its frame only."""
        return self._ids(k, self.source.read(self.offsets[k], self.entries[k][0]))

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order, read a few megabytes at a time."""
        k = 0
        while k < self.n_docs:
            last = k + 1
            while last < self.n_docs and self.offsets[last + 1] - self.offsets[k] <= READ_BYTES:
                last += 1
            block = self.source.read(self.offsets[k], self.offsets[last] - self.offsets[k])
            for i in range(k, last):
                at = self.offsets[i] - self.offsets[k]
                yield self.doc_ids[i], self._ids(i, block[at:at + self.entries[i][0]])
            k = last


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> list[tuple]:
    """Encode whole texts, append ``end_id``, write files in ascending doc_id order.

    Null doc_ids come first and repeated ones keep their input order; null
    and empty texts hold ``end_id`` alone; other columns are ignored. An
    empty table writes no file. Returns (partition, path, n_docs, n_tokens)
    of each file in order, a few bytes per file.
    """
    make_folder(path)

    def write(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        part, writer = TaskContext.get().partitionId(), None
        # the name is new for every attempt: a task that is run again never meets its first file
        to = f"{path}/part-{part:06d}-{uuid.uuid4().hex}.tok.zst"
        with encoder(tokenizer) as code:
            width = 2 if max(code.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
            for batch in batches:
                writer = writer or TokenFileWriter(to, width)
                for doc_id, ids in zip(batch["doc_id"], code.encode(batch["text"], end_id), strict=True):
                    writer.add(doc_id, ids)
        if writer:
            writer.close()
            yield {"partition": [part], "path": [to], "n_docs": [len(writer.doc_ids)], "n_tokens": [writer.n_tokens]}

    ordered = (pick(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
               .repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").drop("row"))
    return sorted(tuple(r) for r in map_columns(ordered, write, FILE_SCHEMA).collect())


def read_token_files(spark: SparkSession, files: list[tuple]) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over all files.
    Each file is one task; every frame's checksum is verified.
    """
    starts = [0, *accumulate(f[3] for f in files)]
    work = spread(spark, [(f[1], starts[i]) for i, f in enumerate(files)], "path string, base long")

    def read(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["base"], strict=True):
                rows = []
                for doc_id, ids in TokenFile(path).documents():
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                yield {n: [r[i] for r in rows] for i, n in enumerate(("doc_id", "start", "n_tokens", "ids_crc32"))}

    return map_columns(work, read, DOCUMENT_SCHEMA)


def read_documents(files: Iterable[tuple], doc_ids: Iterable[int]) -> dict[int, np.ndarray]:
    """The ids of a few documents, decompressing their frames only."""
    wanted, out = set(doc_ids), {}
    for f in files:
        file = TokenFile(f[1])
        for k, doc_id in enumerate(file.doc_ids):
            if doc_id in wanted:
                out[doc_id] = file.document(k)
    return out
