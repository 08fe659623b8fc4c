"""Token-id output as fixed-width bit-packed binary files.

Each id takes ``bits = ceil(log2(vocabulary))`` bits.  Documents are written
in ascending doc_id order, one run of files per range of ids.  A file is

    magic ``TIDS`` | u16 version | u16 bits | u32 block_ids | u64 n_docs | u64 n_ids | u64 n_blocks
    n_docs  x i64   doc_id
    n_docs  x u64   end of the document (in ids from the start of the file)
    n_blocks x u64  byte offset of the block behind the head
    payload         blocks of ``block_ids`` ids, each packed from a byte boundary, high bit first

all little-endian.  Any id is found from its number alone (block =
number // block_ids), and a block unpacks with numpy in one call.

Files go to ``out_dir``, any folder that Spark's executors share (a URI that
pyarrow's file systems know: file, hdfs, s3, gs).  A task writes a file
under a name of its attempt and then renames it, so a retried or speculative
task leaves one whole copy.

Defined results: a null text is the empty text; every document ends with
``end_id``, so an empty one has one id; a null doc_id sorts first and reads
back as null (a flag value marks it); rows that repeat a doc_id follow one another,
ordered by text hash; an empty table gives no files and an empty result;
other columns are ignored, whatever their names."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.bpe import codec
from strata.llm.ship import ship_package
from strata.llm.words import bounded, texts_of

MAGIC, VERSION = b"TIDS", 1
HEAD = struct.Struct("<4sHHIQQQ")
BLOCK_IDS = 4096
FILE_IDS = 8 << 20
NULL_ID = -(1 << 63)

FILE_SCHEMA = "file string, first_doc long, n_docs long, n_ids long"


def bits_for(vocab_size: int) -> int:
    """The fewest bits that hold every id below ``vocab_size``."""
    return max(1, (vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """The ids as consecutive ``bits``-bit numbers, high bit first, filled up to a byte."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits == 16:
        return ids.astype(">u2").tobytes()
    raw = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - bits:]
    return np.packbits(raw.reshape(-1)).tobytes()


def unpack_bits(raw: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` numbers of ``pack_bits``."""
    if bits == 16:
        return np.frombuffer(raw, ">u2", n).astype(np.uint32)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits:] = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits).reshape(n, bits)
    return np.packbits(wide, axis=1).view(">u4").reshape(-1).astype(np.uint32)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there."""
    if not urlsplit(uri).scheme:
        uri = f"file://{uri}"
    return pafs.FileSystem.from_uri(uri)


def write_file(fs: pafs.FileSystem, path: str, doc_ids: np.ndarray, ends: np.ndarray, ids: np.ndarray, bits: int,
               block_ids: int, attempt: str) -> None:
    blocks = [pack_bits(ids[i:i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])[:-1].astype("<u8")
    temporary = f"{path}.{attempt}"
    with fs.open_output_stream(temporary) as out:
        out.write(HEAD.pack(MAGIC, VERSION, bits, block_ids, len(doc_ids), len(ids), len(blocks)))
        out.write(doc_ids.astype("<i8").tobytes())
        out.write(ends.astype("<u8").tobytes())
        out.write(offsets.tobytes())
        for b in blocks:
            out.write(b)
    fs.move(temporary, path)


class TokenFile:
    """Random access to one file."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.source = fs.open_input_file(path)
        magic, version, self.bits, self.block_ids, n_docs, self.n_ids, n_blocks = HEAD.unpack(self.source.read(HEAD.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{path} is no token-id file")
        self.doc_ids = np.frombuffer(self.source.read(8 * n_docs), "<i8")
        self.ends = np.frombuffer(self.source.read(8 * n_docs), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(self.source.read(8 * n_blocks), "<u8").astype(np.int64)
        self.payload = HEAD.size + 16 * n_docs + 8 * n_blocks

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` (exclusive), reading only the blocks that hold them."""
        if last <= first:
            return np.empty(0, np.uint32)
        b0, b1 = first // self.block_ids, (last - 1) // self.block_ids
        out, whole = [], -(-self.block_ids * self.bits // 8)
        self.source.seek(self.payload + int(self.offsets[b0]))
        raw = self.source.read(int(self.offsets[b1] - self.offsets[b0]) + whole)
        if self.block_ids * self.bits % 8 == 0:  # full blocks then follow one another without a gap
            out.append(unpack_bits(raw, self.bits, min(self.n_ids - b0 * self.block_ids, (b1 - b0 + 1) * self.block_ids)))
        else:
            for b in range(b0, b1 + 1):
                at = int(self.offsets[b] - self.offsets[b0])
                out.append(unpack_bits(raw[at:at + whole], self.bits, min(self.block_ids, self.n_ids - b * self.block_ids)))
        return np.concatenate(out)[first - b0 * self.block_ids:last - b0 * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        """All ids of the file's ``k``-th document."""
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))

    def runs(self, most: int) -> Iterator[tuple[int, int]]:
        """Consecutive documents of at most ``most`` ids together (or one document)."""
        k = 0
        while k < len(self.ends):
            begin = int(self.ends[k - 1]) if k else 0
            last = max(k + 1, int(np.searchsorted(self.ends, begin + most, "right")))
            yield k, last
            k = last


def _write(tokenizer: str, out_dir: str, end_id: int, block_ids: int, file_ids: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        bits = bits_for(max(c.vocab_size, end_id + 1))
        fs, folder = open_folder(out_dir)
        task = TaskContext.get()
        docs, ends, ids, held, number = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, ends, ids, held, number
            d = np.concatenate(docs)
            name = f"{folder}/part-{task.partitionId():06d}-{number:05d}.tids"
            write_file(fs, name, d, np.concatenate(ends), np.concatenate(ids), bits, block_ids, f"attempt-{task.taskAttemptId()}")
            out = pa.RecordBatch.from_pydict({"file": [name], "first_doc": pa.array([int(d[0])], pa.int64()),
                                              "n_docs": pa.array([len(d)], pa.int64()), "n_ids": pa.array([held], pa.int64())})
            docs, ends, ids, held, number = [], [], [], 0, number + 1
            return out

        for b in bounded(batches):
            offsets, own = c.encode(texts_of(b.column("text")))
            last = offsets[1:]
            out = np.insert(own.astype(np.uint16 if bits <= 16 else np.uint32), last, end_id)
            docs.append(b.column("doc_id").fill_null(NULL_ID).to_numpy())
            ends.append(last + np.arange(1, len(last) + 1) + held)
            ids.append(out)
            held += len(out)
            if held >= file_ids:
                yield flush()
        if held:
            yield flush()
    return run


def write_token_files(docs: DataFrame, tokenizer: str, out_dir: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                      block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the files below ``out_dir`` (which must exist) and return their
    list with ``base``, the number of ids in all files before each.  The
    list is written as a table beside them, so reading it encodes nothing."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    fs, folder = open_folder(out_dir)
    fs.create_dir(f"{folder}/ids", recursive=True)
    listing = f"{out_dir}/files"
    ranged.mapInArrow(_write(tokenizer, f"{out_dir}/ids", end_id, block_ids, file_ids), FILE_SCHEMA).write.parquet(listing)
    files = spark.read.schema(FILE_SCHEMA).parquet(listing)
    # one row per file, not per document: a small window however large the corpus
    before = Window.orderBy("first_doc", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(out_dir: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(out_dir)
        for b in batches:
            for name, base in zip(b.column("file").to_pylist(), b.column("base").to_pylist()):
                f = TokenFile(fs, name)
                for k, last in f.runs(1 << 20):
                    begin = np.concatenate([[f.ends[k - 1] if k else 0], f.ends[k:last]])
                    ids = f.ids(int(begin[0]), int(begin[-1])).astype("<u4")
                    at = (begin - begin[0]).tolist()
                    raw = memoryview(ids).cast("B")
                    crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(at, at[1:])]
                    doc = f.doc_ids[k:last]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc, pa.int64(), mask=doc == NULL_ID), pa.array(begin[:-1] + base, pa.int64()),
                         pa.array(np.diff(begin), pa.int64()), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_token_files(files: DataFrame, out_dir: str) -> DataFrame:
    """One row per document of the listed files: doc_id, start (ids before
    it in all files), n_tokens and the crc32 of its ids (as little-endian
    unsigned 32-bit integers).  Files are dealt over the tasks one by one."""
    return files.select("file", "base").repartition("file").mapInArrow(
        _read(out_dir), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(spark: SparkSession, docs: DataFrame, tokenizer: str, out_dir: str, end_id: int) -> DataFrame:
    """Write the documents' token files, then read them back."""
    return read_token_files(write_token_files(docs, tokenizer, out_dir, end_id), out_dir)
