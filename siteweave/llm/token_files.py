"""Token ids in files of length-delimited binary records, with a separate offset index for shuffled reads.

A shard `shard-NNNNN.bin` is a run of records:

    uint64 length | uint32 masked CRC-32 of those 8 bytes | payload | uint32 masked CRC-32 of the payload

All numbers are little-endian; a CRC is masked by a rotation of 15 bits and an addition, so that a checksum of data that
holds checksums stays sound. A payload is one byte of flags (1: the id is not null), an int64 id, one byte with the width of
a token id (2 or 4) and the ids. `shard-NNNNN.idx` holds four int64 numbers for each record: id, byte offset, number of
ids, ids before it in the shard. `manifest.parquet` has a row for each shard.

Null and empty texts become a record that holds the end id alone. Rows with equal or null ids are all kept (null first,
then by id; among equal ids by text). Columns besides id and text are ignored. An empty table gives no shard.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm.common import Recent, fresh, kept, pieces, table

_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")
_META = struct.Struct("<BqB")
_MASK = 0xA282EAD8
#: Words kept by a worker, twice over at most.
CACHED_WORDS = 1_000_000
#: A space next to other white space: there the words can't be taken one by one.
_LOOSE = r" [\s\x0B\x1C-\x1F\x{85}\p{Z}]|[\s\x0B\x1C-\x1F\x{85}\p{Z}] "


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + _TAIL.pack(masked(size)) + payload + _TAIL.pack(masked(payload))


def records(stream, where: str) -> Iterator[bytes]:
    """The payloads of a shard in order; a damaged or short record raises."""
    while head := stream.read(_HEAD.size):
        if len(head) < _HEAD.size or masked(head[:8]) != _HEAD.unpack(head)[1]:
            raise ValueError(f"{where}: damaged length")
        size = _HEAD.unpack(head)[0]
        body = stream.read(size + _TAIL.size)
        if len(body) < size + _TAIL.size or masked(body[:size]) != _TAIL.unpack(body[size:])[0]:
            raise ValueError(f"{where}: damaged record")
        yield body[:size]


def pack(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return _META.pack(doc_id is not None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    known, doc_id, width = _META.unpack_from(payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", offset=_META.size).astype("<u4")


def read_at(stream, offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its offset in the index."""
    stream.seek(offset)
    return unpack(next(records(stream, f"offset {offset}")))


class WordEncoder:
    """Texts to ids, word by word, each distinct word encoded once by the tokenizers library.

    A byte-level BPE of this family never merges across a space that stands between two other characters, so the text
    may be cut there; texts with a space beside other white space go to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.first = Recent(CACHED_WORDS // 10, self._ids)
        self.later = Recent(CACHED_WORDS, lambda word: self._ids(" " + word))

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, store: Recent, words: set[str], lead: str) -> None:
        new = store.missing(words)
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            found = self.tokenizer.encode_batch_fast([lead + w for w in part], add_special_tokens=False)
            store.update((w, array("I", e.ids).tobytes()) for w, e in zip(part, found, strict=True))

    def encode(self, column: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """The ids of each text and the end id. Each distinct word of the column is looked up once."""
        column = pc.fill_null(column, "")
        loose = pc.match_substring_regex(column, _LOOSE).to_numpy(zero_copy_only=False)
        words = pc.split_pattern(column.filter(pa.array(~loose)), " ")
        offsets = words.offsets.to_numpy()
        coded = words.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn(self.later, set(distinct), " ")
        # The first word of a text has no space before it; it and the end id get entries of their own behind the others.
        heads = words.values.take(pa.array(offsets[:-1])).to_pylist()
        self._learn(self.first, set(heads), "")
        known = [*map(self.later.__getitem__, distinct), *map(self.first.__getitem__, heads), struct.pack("<I", end_id)]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids, starts = np.frombuffer(b"".join(known), dtype="<u4"), np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        codes[offsets[:-1]] = len(distinct) + np.arange(len(heads))
        codes = np.insert(codes, offsets[1:], len(known) - 1)
        each = sizes[codes]
        upto = np.cumsum(each)
        flat = ids[np.repeat(starts[codes] - upto + each, each) + np.arange(upto[-1] if len(upto) else 0)]
        ends = upto[offsets[1:] + np.arange(len(heads))] if len(heads) else upto
        cut = iter(np.split(flat, ends[:-1]))
        for text, whole in zip(column, loose, strict=True):
            yield np.frombuffer(self._ids(text.as_py()) + struct.pack("<I", end_id), dtype="<u4") if whole else next(cut)


def encoder(path: str) -> WordEncoder:
    """This worker's encoder; workers live on from task to task, and so do the words they know."""
    encoders = kept("token_files")
    if path not in encoders:
        encoders[path] = WordEncoder(path)
    return encoders[path]


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write(df: DataFrame, folder: str, tokenizer: str, end_id: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write df in ascending order of id; the manifest of the shards.

    The table is dealt out by ranges of the id before it is encoded, so that finding the ranges reads only the ids. A
    shard is written under a name of the attempt and then renamed: a task that is run again replaces it with the same
    bytes.
    """
    schema = "shard int, records long, tokens long, bytes long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        enc = encoder(tokenizer)
        width = 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        name, trial = f"{base}/shard-{shard:05d}", uuid.uuid4().hex
        index, offset, tokens, out = [], 0, 0, None
        for batch in pieces(batches, text, 8 << 20):
            if out is None:
                out = store.open_output_stream(f"{name}.bin.{trial}")
            for doc_id, seq in zip(batch.column(id_column).to_pylist(), enc.encode(batch.column(text), end_id), strict=True):
                record = frame(pack(doc_id, seq, width))
                out.write(record)
                index.append((doc_id or 0, offset, len(seq), tokens))
                offset += len(record)
                tokens += len(seq)
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{name}.idx.{trial}") as idx:
            idx.write(np.array(index, dtype="<i8").tobytes())
        for kind in ("bin", "idx"):
            store.move(f"{name}.{kind}.{trial}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "records": [len(index)], "tokens": [tokens], "bytes": [offset]})

    # Rows that share an id, or have none, are told apart by a hash of the text: many of them don't end up in one shard.
    rows = df.select(F.col(id_column).cast("long").alias(id_column), F.col(text).alias(text), F.xxhash64(text).alias("tie"))
    dealt = rows.repartitionByRange(F.col(id_column), F.col("tie")).sortWithinPartitions(id_column, "tie", text).select(id_column, text)
    path = f"{folder}/manifest.parquet"
    dealt.mapInArrow(run, schema).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def read(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """The records of all shards: doc_id, start (ids of all records before it), n_tokens and the ids, or their CRC-32.

    The manifest has one row for each shard, so the driver gets a number of rows bounded by the number of write tasks.
    """
    shards = spark.read.parquet(f"{folder}/manifest.parquet").orderBy("shard").collect()
    plan, before = [], 0
    for s in shards:
        plan.append((s["shard"], before))
        before += s["tokens"]
    value = "ids_crc32 long" if digest else "ids array<int>"
    schema = f"doc_id long, start long, n_tokens long, {value}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                where = f"{base}/shard-{row['shard']:05d}.bin"
                start, got, held = row["start"], [], 0
                with store.open_input_stream(where) as stream:
                    for payload in records(stream, where):
                        doc_id, ids = unpack(payload)
                        got.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()) if digest else ids))
                        start += len(ids)
                        held += 1 if digest else len(ids)
                        if held >= 1 << (12 if digest else 20):
                            yield _rows(got, digest)
                            got, held = [], 0
                if got:
                    yield _rows(got, digest)

    files = spark.createDataFrame(plan, "shard int, start long").repartition(max(1, len(plan)))
    return files.mapInArrow(run, schema)


def _rows(got: list[tuple], digest: bool) -> pa.RecordBatch:
    a, b, c, d = zip(*got, strict=True)
    last = pa.array(d, pa.int64() if digest else pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), last], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])


def op7_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    folder = fresh(spark, "tokens")
    write(table(spark, sf_dir, "documents"), folder, tokenizer or public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read(spark, folder, digest=True)
