"""Token ids as binary files of patched frame-of-reference blocks.

A block holds 128 ids: the block minimum is subtracted, the rest is packed at
the width that a chosen percentile of the block needs, and the few ids that do
not fit keep their high bits in an exception list. A file ends with an index of
block starts and the documents' ids and lengths, so any document can be read
without decoding what lies before it.

File: ``PFOR`` | version u32 | blocks | block starts u64[] | doc ids i64[] |
doc id is null u8[] | doc lengths i64[] | footer start, blocks, docs, ids (u64
each) | ``PFOR``. Block: minimum u32, width u8, zero u8, exceptions u16; packed
words u64[2 * width]; exceptions (position u16, high bits u32)[].

Documents are range-partitioned by id, so file k holds the k-th run of ids and
every task writes one file to the shared folder (temporary name, then rename:
a repeated or speculative task leaves the same bytes).

Defined results: null and empty texts hold the end id alone; null ids sort
first; rows that repeat an id are stored in the order of their texts; an empty
table gives no file and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import prepare_python, publish_file, shared_path, table
from larder.llm.tokens import encoder, tokenizer_path

BLOCK = 128
MAGIC = b"PFOR"
HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("zero", "u1"), ("n", "<u2")])
PATCH = np.dtype([("at", "<u2"), ("high", "<u4")])
TRAILER = struct.Struct("<QQQQ4s")

#: Production parameters.
PERCENTILE = 90
END_ID = 2
#: Texts encoded at a time, and words kept by an encoder.
ROWS = 1000
WORDS = 700_000
#: Blocks decoded at a time.
CHUNK = 4096


def pack_lanes(v: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK) values below 2**width as (blocks, 2 * width) words."""
    out = np.zeros((len(v), BLOCK * width // 64), np.uint64)
    v = v.astype(np.uint64)
    for j in range(BLOCK):
        word, shift = divmod(j * width, 64)
        out[:, word] |= v[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= v[:, j] >> np.uint64(64 - shift)
    return out


def unpack_lanes(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), BLOCK), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(BLOCK):
        word, shift = divmod(j * width, 64)
        x = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = x & mask
    return out


def _spans(start: np.ndarray, size: int) -> np.ndarray:
    return start[:, None] + np.arange(size)


def encode_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Blocks of (n, BLOCK) ids (uint32) and the byte size of each."""
    low = ids.min(axis=1)
    rest = ids - low[:, None]
    rank = max(0, -(-BLOCK * percentile // 100) - 1)
    need = np.partition(rest, rank, axis=1)[:, rank]
    width = np.ceil(np.log2(need.astype(np.float64) + 1)).astype(np.int64)
    high = rest >> np.minimum(width, 31).astype(np.uint32)[:, None]
    high[width >= 32] = 0
    row, col = np.nonzero(high)
    n = np.bincount(row, minlength=len(ids))
    packed = BLOCK // 8 * width
    size = HEAD.itemsize + packed + PATCH.itemsize * n
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    head = np.zeros(len(ids), HEAD)
    head["low"], head["width"], head["n"] = low, width, n
    out[_spans(start, HEAD.itemsize)] = head.view(np.uint8).reshape(len(ids), -1)
    for w in np.unique(width):
        if w:
            of = np.flatnonzero(width == w)
            words = pack_lanes(rest[of].astype(np.uint64) & np.uint64((1 << int(w)) - 1), int(w))
            out[_spans(start[of] + HEAD.itemsize, BLOCK // 8 * int(w))] = words.view(np.uint8).reshape(len(of), -1)
    if len(row):
        patch = np.zeros(len(row), PATCH)
        patch["at"], patch["high"] = col, high[row, col]
        nth = np.arange(len(row)) - (np.cumsum(n) - n)[row]
        at = start[row] + HEAD.itemsize + packed[row] + PATCH.itemsize * nth
        out[_spans(at, PATCH.itemsize)] = patch.view(np.uint8).reshape(len(row), -1)
    return out.tobytes(), size


def decode_blocks(raw: bytes, start: np.ndarray) -> np.ndarray:
    """(n, BLOCK) ids of the blocks that begin at ``start`` within ``raw``."""
    data = np.frombuffer(raw, np.uint8)
    head = data[_spans(start, HEAD.itemsize)].reshape(-1).view(HEAD)
    width, n = head["width"].astype(np.int64), head["n"].astype(np.int64)
    rest = np.zeros((len(start), BLOCK), np.uint64)
    for w in np.unique(width):
        if w:
            of = np.flatnonzero(width == w)
            words = data[_spans(start[of] + HEAD.itemsize, BLOCK // 8 * int(w))]
            rest[of] = unpack_lanes(np.ascontiguousarray(words).view(np.uint64), int(w))
    row = np.repeat(np.arange(len(start)), n)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = start[row] + HEAD.itemsize + BLOCK // 8 * width[row] + PATCH.itemsize * nth
        patch = np.ascontiguousarray(data[_spans(at, PATCH.itemsize)]).reshape(-1).view(PATCH)
        rest[row, patch["at"]] |= patch["high"].astype(np.uint64) << width[row].astype(np.uint64)
    return (rest + head["low"].astype(np.uint64)[:, None]).astype(np.uint32)


class FileWriter:
    """Streams documents into one file; holds less than a batch of ids."""

    def __init__(self, sink, percentile: int = PERCENTILE):
        self.sink, self.percentile = sink, percentile
        self.sink.write(MAGIC + struct.pack("<I", 1))
        self.at, self.ids = 8, 0
        self.open = np.zeros(0, np.uint32)
        self.sizes, self.docs, self.nulls, self.lengths = [], [], [], []

    def add(self, doc_ids: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.docs += [0 if x is None else x for x in doc_ids]
        self.nulls += [x is None for x in doc_ids]
        self.lengths.append(lengths)
        self.ids += len(ids)
        ids = np.concatenate([self.open, ids])
        whole = len(ids) // BLOCK * BLOCK
        self.open = ids[whole:]
        self._blocks(ids[:whole])

    def _blocks(self, ids: np.ndarray) -> None:
        for first in range(0, len(ids), CHUNK * BLOCK):
            raw, size = encode_blocks(ids[first:first + CHUNK * BLOCK].reshape(-1, BLOCK), self.percentile)
            self.sink.write(raw)
            self.sizes.append(size)

    def close(self) -> None:
        if len(self.open):
            pad = np.full(BLOCK - len(self.open), self.open.min(), np.uint32)
            self._blocks(np.concatenate([self.open, pad]))
        size = np.concatenate([*self.sizes, np.zeros(0, np.int64)]).astype(np.int64)
        start = 8 + np.cumsum(size) - size
        lengths = np.concatenate([*self.lengths, np.zeros(0, np.int64)])
        self.sink.write(start.astype("<u8").tobytes())
        self.sink.write(np.array(self.docs, "<i8").tobytes())
        self.sink.write(np.array(self.nulls, "u1").tobytes())
        self.sink.write(lengths.astype("<i8").tobytes())
        self.sink.write(TRAILER.pack(8 + int(size.sum()), len(size), len(self.docs), self.ids, MAGIC))


class FileReader:
    """Documents of one file, a chunk of blocks at a time."""

    def __init__(self, source):
        """``source``: a seekable binary file."""
        self.source = source
        source.seek(0, 2)
        end = source.tell()
        foot, blocks, docs, self.ids, magic = TRAILER.unpack(self._at(end - TRAILER.size, TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a file of token blocks")
        self.start = np.append(np.frombuffer(self._at(foot, 8 * blocks), "<u8"), foot).astype(np.int64)
        at = foot + 8 * blocks
        self.docs = np.frombuffer(self._at(at, 8 * docs), "<i8")
        self.nulls = np.frombuffer(self._at(at + 8 * docs, docs), "u1").astype(bool)
        self.lengths = np.frombuffer(self._at(at + 9 * docs, 8 * docs), "<i8")
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])

    def _at(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def block_ids(self, a: int, b: int) -> np.ndarray:
        start = self.start[a:b]
        raw = self._at(int(start[0]), int(self.start[b] - start[0]))
        return decode_blocks(raw, start - start[0]).reshape(-1)

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, by the index alone."""
        lo, hi = int(self.first[k]), int(self.first[k + 1])
        a = lo // BLOCK
        return self.block_ids(a, -(-hi // BLOCK))[lo - a * BLOCK:hi - a * BLOCK]

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        held, base, k = np.zeros(0, np.uint32), 0, 0
        for a in range(0, len(self.start) - 1, CHUNK):
            held = np.concatenate([held, self.block_ids(a, min(a + CHUNK, len(self.start) - 1))])
            while k < len(self.docs) and self.first[k + 1] - base <= len(held):
                yield k, held[self.first[k] - base:self.first[k + 1] - base]
                k += 1
            keep = int(self.first[min(k, len(self.docs))]) - base
            held, base = held[keep:], base + keep


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID,
                percentile: int = PERCENTILE, id_col: str = "doc_id", text: str = "text") -> list[dict]:
    """Encode ``docs`` into files of ``folder``; the files in id order with
    their numbers of documents and ids (one small row per file)."""
    spark = docs.sparkSession
    prepare_python(spark, ROWS)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        batches = (b for b in batches if len(b))
        batch = next(batches, None)
        if batch is None:
            return
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        part = TaskContext.get().partitionId()
        own = f"{path}/_part-{part:06d}-{TaskContext.get().taskAttemptId()}"
        enc = encoder(tokenizer, WORDS)
        with store.open_output_stream(own) as sink:
            out = FileWriter(sink, percentile)
            while batch is not None:
                ids, lengths = enc.encode(batch["text"].tolist(), end_id)
                out.add([None if x is None else int(x) for x in batch["id"].tolist()], ids, lengths)
                batch = next(batches, None)
            out.close()
        publish_file(store, own, f"{path}/part-{part:06d}.pfor")
        yield pd.DataFrame({"part": [part], "file": [f"{folder}/part-{part:06d}.pfor"],
                            "n_docs": [len(out.docs)], "n_ids": [out.ids]})

    # Rows that repeat an id (or have none) are spread over files by the start of
    # their text, equal ones by their place in the input; no text is cut.
    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"),
                           F.substring(F.col(text), 1, 32).alias("head"), F.monotonically_increasing_id().alias("place"))
               .repartitionByRange(parts, "id", "head", "place").sortWithinPartitions("id", "text")
               .select(F.col("id").cast("string"), "text"))  # pandas makes doubles of longs beside a null
    files = ordered.mapInPandas(write, "part long, file string, n_docs long, n_ids long")
    return sorted((r.asDict() for r in files.collect()), key=lambda r: r["part"])


def read_files(spark: SparkSession, files: list[dict], with_ids: bool = False) -> DataFrame:
    """Documents of the files in id order: doc_id, start, n_tokens, ids_crc32
    (and the ids), ``start`` counting all ids before the document."""
    prepare_python(spark)
    base = np.cumsum([0] + [f["n_ids"] for f in files]).tolist()
    names = [f["file"] for f in files]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        for batch in batches:
            for k in batch["id"]:
                store, path = fs.FileSystem.from_uri(names[k])
                with store.open_input_file(path) as source:
                    f = FileReader(source)
                    rows = []
                    for i, ids in f.documents():
                        rows.append((None if f.nulls[i] else str(f.docs[i]), base[k] + int(f.first[i]), len(ids),
                                     zlib.crc32(ids.astype("<u4").tobytes())) + ((ids,) if with_ids else ()))
                        if len(rows) == 1000:
                            yield pd.DataFrame(rows, columns=cols)
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=cols)

    cols = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id string, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    found = spark.range(0, len(files), 1, max(1, len(files))).mapInPandas(read, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every document's place, length and checksum, read back from the files."""
    folder = shared_path(spark, "token-files")
    files = write_files(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return read_files(spark, files)
