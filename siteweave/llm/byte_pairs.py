"""Byte-level BPE by ranks: each distinct pre-token of the corpus is encoded once, wherever it occurs.

Encoding takes three steps, of which only the middle one sees words of the whole corpus:

1. Texts are cut into pre-tokens and dealt to blocks of about 16 MB. A block keeps its pre-tokens by position, as numbers in
   its own dictionary (most frequent first), and gives each distinct one to the bucket of its hash, once.
2. In a bucket, each distinct word is encoded once; the ids go back to every block that asked. However frequent a word is, a
   block asks for it once, so no bucket is hot.
3. A block puts the ids of its words in the order of their positions and cuts them into documents. Blocks lie in a bucketed
   table in the shared folder, so they are not shuffled for it; only the ids are.

Decoding joins ids with the token-byte table, whose size the vocabulary fixes, so it is broadcast.

Which characters are letters, numbers or white space is asked of the tiktoken library itself, as expression libraries follow
different editions of Unicode. Null and empty texts have no ids (0, hashes of the empty string). Null or repeated doc_ids are
kept as they are, row by row. Columns besides id and text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm.common import fresh, kept, pieces, table, utf8

#: Bytes of text in a block, and the least number of buckets of words.
BLOCK, BUCKETS = 16 << 20, 1_024
#: Pre-tokens of a block whose ids are put in order at once; each takes about 60 bytes meanwhile.
CHUNK = 1 << 18
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _encoding(ranks: dict[bytes, int], pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Splitter:
    """Pre-tokens of the pattern  's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+  for many texts at once.

    The pattern takes every character, so it is enough to say where pre-tokens begin, and that depends on neighbours only:
    at a change of class (letter, number, space, other), but a single U+0020 stays with the run behind it; of more white
    space, the last character is cut off unless the text ends there. An apostrophe that follows a letter, a number or white
    space other than U+0020, or begins the text, may begin a contraction, behind which a new pre-token begins.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        self.kind = np.full(0x110000, _OTHER, np.uint8)
        for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
            one = _encoding(ranks, pattern)
            self.kind[[*map(ord, one.decode(one.encode_ordinary(every)))]] = kind

    def starts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions at which pre-tokens begin, in texts that lie one behind the other in raw; offsets: len(texts) + 1."""
        if not len(raw):
            return np.empty(0, np.int64)
        begins = np.flatnonzero((raw & 0xC0) != 0x80)  # bytes that begin a character
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(points)
        kind = self.kind[points]
        first = np.zeros(n + 1, bool)  # first characters of texts, and the end
        first[np.searchsorted(begins, offsets)] = True
        first[n] = True
        blank = points == 0x20
        cut = first.copy()
        cut[1:n] |= kind[1:] != kind[:-1]
        # White space before other text: its last character begins anew; if that is U+0020, the run behind goes on from it.
        space = kind == _SPACE
        last = np.flatnonzero(space & cut[1:] & ~first[1:])
        cut[last] = True
        cut[last[blank[last]] + 1] = False
        marks = np.flatnonzero(points == 0x27)
        before = np.where(first[marks], _SPACE, kind[marks - 1])
        marks = marks[(before != _OTHER) & (first[marks] | ~blank[marks - 1])]
        if len(marks):
            at = lambda k: np.where(inside(k), points[np.minimum(marks + k, n - 1)], 0)
            inside = lambda k: (marks + k < n) & ~np.logical_or.reduce([first[np.minimum(marks + j, n)] for j in range(1, k + 1)])
            one, two = at(1), at(2)
            size = np.where(np.isin(one, [*map(ord, "stmd")]), 2, 0)
            for pair in ("re", "ve", "ll"):
                size = np.where((one == ord(pair[0])) & (two == ord(pair[1])), 3, size)
            marks, size = marks[size > 0], size[size > 0]
            cut[marks] = True
            cut[marks + 1] = False
            cut[marks[size == 3] + 2] = False
            cut[marks + size] = True
        return begins[np.flatnonzero(cut[:n])]


def _tools(path: str) -> dict:
    """What this worker needs of a vocabulary; workers live on from task to task."""
    store = kept("byte_pairs")
    if path not in store:
        import public_tokenizers

        ranks = read_ranks(path)
        store[path] = {"splitter": Splitter(ranks), "encoding": _encoding(ranks, public_tokenizers.PATTERN), "width": 2 if max(ranks.values()) < 1 << 16 else 4}
    return store[path]


def _planes(codes: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes."""
    return pa.compress(np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True) if len(codes) else b""


def _numbers(packed: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.uint32)
    raw = pa.decompress(packed, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel()


def _packed(raw: np.ndarray, offsets: np.ndarray) -> bytes:
    """Strings that lie one behind the other, compressed: the size of all, their sizes, their bytes."""
    sizes = np.diff(offsets)
    body = (np.minimum(sizes, 255).astype(np.uint8).tobytes(), sizes[sizes >= 255].astype("<u4").tobytes(), raw[offsets[0] : offsets[-1]].tobytes())
    whole = b"".join(body)
    return len(whole).to_bytes(4, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> list[str]:
    whole = pa.decompress(data[4:], decompressed_size=int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True)
    sizes = np.frombuffer(whole, np.uint8, n).astype(np.int64)
    long = np.flatnonzero(sizes == 255)
    sizes[long] = np.frombuffer(whole, "<u4", len(long), n)
    at = np.append(0, np.cumsum(sizes))
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(at), pa.py_buffer(whole).slice(n + 4 * len(long))).to_pylist()


def _hash(words: pa.Array) -> np.ndarray:
    """A bucket for each word, alike in every block: its bytes' sum of odd powers, mixed."""
    raw, offsets = utf8(words)
    weights = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(raw)) - np.repeat(offsets[:-1], np.diff(offsets))
    sums = np.add.reduceat(np.append((raw.astype(np.uint64) + np.uint64(1)) * weights[place & 63], np.uint64(0)), offsets[:-1])
    return ((sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64)


_BLOCKS = "block long, ids array<long>, sizes array<int>, n int, codes binary, places binary, buckets array<struct<bucket:int,n:int,words:binary>>"


def blocks(df: DataFrame, ranks: str, id_column: str = "doc_id", text: str = "text", block: int = BLOCK, buckets: int = BUCKETS) -> DataFrame:
    """Step 1. A row for each block: its documents and their numbers of pre-tokens, the pre-tokens by position, as ranks
    by frequency, which compress well, and the place of each rank in the words of all buckets, one behind the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _tools(ranks)["splitter"]
        part, made = TaskContext.get().partitionId(), 0
        ids, sizes, words, held = [], [], [], 0

        def row() -> pa.RecordBatch:
            nonlocal made
            tokens = pa.chunked_array(words, pa.large_string()).combine_chunks()
            words.clear()  # a block's pre-tokens are several times its text
            tokens = tokens.dictionary_encode()
            codes, distinct = tokens.indices.to_numpy(zero_copy_only=False), tokens.dictionary
            often = np.argsort(-np.bincount(codes, minlength=len(distinct)), kind="stable")
            bucket = _hash(distinct)[often] % buckets if len(distinct) else np.empty(0, np.int64)
            rank = np.empty(len(often), np.uint32)
            rank[often] = np.arange(len(often))
            words_of = distinct.take(pa.array(often))
            order = pc.sort_indices(pa.table({"bucket": bucket, "word": words_of}), sort_keys=[("bucket", "ascending"), ("word", "ascending")]).to_numpy()
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order))
            filled, upto = np.unique(bucket[order], return_index=True)
            raw, offsets = utf8(words_of.take(pa.array(order)))
            bounds = [*upto.tolist(), len(order)]
            lists = [_packed(raw, offsets[lo : hi + 1]) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
            shared = pa.StructArray.from_arrays([pa.array(filled, pa.int32()), pa.array(np.diff(bounds), pa.int32()), pa.array(lists, pa.binary())], ["bucket", "n", "words"])
            out = [pa.array([(part << 33) + made]), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())), pa.array([len(codes)], pa.int32()), pa.array([_planes(rank[codes])], pa.binary()), pa.array([_planes(place)], pa.binary())]
            made += 1
            return pa.RecordBatch.from_arrays([*out, pa.ListArray.from_arrays(pa.array([0, len(shared)], pa.int32()), shared)], names=["block", "ids", "sizes", "n", "codes", "places", "buckets"])

        for batch in pieces(batches, text, 1 << 20):
            raw, offsets = utf8(batch.column(text))
            starts = split.starts(raw, offsets)
            if len(starts):
                words.append(pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw)))
            ids += batch.column(id_column).to_pylist()
            sizes += np.diff(np.searchsorted(starts, offsets)).tolist()
            held += len(raw)
            if held >= block:
                yield row()
                ids, sizes, words, held = [], [], [], 0
                pa.default_memory_pool().release_unused()
        if ids:
            yield row()
            pa.default_memory_pool().release_unused()

    return df.select(F.col(id_column).cast("long").alias(id_column), F.col(text).cast("string").alias(text)).mapInArrow(run, _BLOCKS)


def answers(asked: DataFrame, ranks: str) -> DataFrame:
    """Step 2. (block, bucket, sizes, n, ids) for the rows (block, bucket, n, words): each distinct word of a bucket is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _tools(ranks)
        encode, width = tools["encoding"].encode_ordinary, tools["width"]
        known, at = {}, None
        for batch in batches:
            out = []
            for block, bucket, n, words in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "n", "words")), strict=True):
                if bucket != at:
                    known, at = {}, bucket
                found = []
                for word in _unpacked(words, n):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = encode(word)
                    found.append(ids)
                flat = np.fromiter((i for ids in found for i in ids), f"<u{width}")
                out.append((block, bucket, _planes(np.fromiter(map(len, found), np.uint32, len(found))), len(found), flat.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary()), strict=True)], names=["block", "bucket", "sizes", "n", "ids"])

    # Sorted, so that a task has the words of one bucket at a time.
    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "block long, bucket int, sizes binary, n int, ids binary")


def reassembled(cut: DataFrame, answered: DataFrame, ranks: str, id_column: str = "doc_id") -> DataFrame:
    """Step 3. (id, ids) of each document from blocks and the answers to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _tools(ranks)["width"]
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                got = sorted(row["got"] or [], key=lambda g: g["bucket"])
                sizes = np.concatenate([np.empty(0, np.int64), *(_numbers(g["sizes"], g["n"]) for g in got)]).astype(np.int64)
                flat = np.frombuffer(b"".join(g["ids"] for g in got), f"<u{width}")
                place, rank = _numbers(row["places"], len(sizes)), _numbers(row["codes"], row["n"])
                starts = np.cumsum(sizes) - sizes
                words = np.array([0, *np.cumsum(row["sizes"])])
                lo = 0
                while lo < len(row["ids"]):  # documents of about CHUNK pre-tokens at a time
                    hi = max(lo + 1, int(np.searchsorted(words, words[lo] + CHUNK, side="right")) - 1)
                    own = place[rank[words[lo] : words[hi]]]
                    each = sizes[own]
                    upto = np.append(0, np.cumsum(each))
                    ids = flat[np.repeat(starts[own] - upto[:-1], each) + np.arange(upto[-1])].astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(upto[words[lo : hi + 1] - words[lo]], pa.int32()), pa.array(ids))
                    yield pa.RecordBatch.from_arrays([pa.array(row["ids"][lo:hi], pa.int64()), lists], names=[id_column, "ids"])
                    lo = hi

    got = answered.groupBy("block").agg(F.collect_list(F.struct("bucket", "sizes", "n", "ids")).alias("got"))  # as many rows as buckets, at most
    return cut.hint("merge").join(got, "block", "left").mapInArrow(run, f"`{id_column}` long, ids array<int>")


def decode(df: DataFrame, ranks: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """df with the bytes of its ids (null: null). An id that the vocabulary lacks raises."""
    table = sorted((rank, token) for token, rank in read_ranks(ranks).items())
    if [rank for rank, _ in table] != [*range(len(table))]:
        raise ValueError("ranks must be numbered from 0 without gaps")
    shared = df.sparkSession.sparkContext.broadcast([token for _, token in table])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(shared.value, pa.large_binary())
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                lists = batch.column(ids)
                lists = lists.cast(pa.large_list(lists.type.value_type))
                flat = tokens.take(pc.list_flatten(lists))
                ends = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)))
                bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset :][ends] if len(flat) else np.zeros(len(ends), np.int64)
                data = flat.buffers()[2] or pa.py_buffer(b"")
                out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(bounds.astype(np.int64)), data])
                if lists.null_count:
                    out = pc.if_else(lists.is_valid(), out, None)
                yield pa.RecordBatch.from_arrays([*batch.columns, out.cast(pa.binary())], names=[*batch.schema.names, into])

    return df.mapInArrow(run, f"{fields}, `{into}` binary")


def _by_block(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, bucketed by block as joins will want it. The catalog keeps its name until it is dropped."""
    spark = df.sparkSession
    name = f"siteweave_blocks_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(parts, "block").option("compression", "zstd").option("path", fresh(spark, "blocks")).saveAsTable(name)
    return spark.table(name)


def encode(df: DataFrame, ranks: str, id_column: str = "doc_id", text: str = "text", block: int = BLOCK, buckets: int | None = None) -> DataFrame:
    """(id, ids) of each row. buckets: eight for each shuffle partition, if not given, so that their words stay few."""
    buckets = buckets or max(BUCKETS, 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = _by_block(blocks(df, ranks, id_column, text, block, buckets))
    asked = cut.select("block", F.explode("buckets").alias("b")).select("block", "b.bucket", "b.n", "b.words")
    return reassembled(cut.select("block", "ids", "sizes", "n", "codes", "places"), answers(asked, ranks), ranks, id_column)


def digest(df: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Numbers and hashes of ids and decoded bytes."""
    return df.select(id_column, F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_byte_pairs(spark: SparkSession, sf_dir: str, ranks: str | None = None) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of each document."""
    import public_tokenizers

    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digest(decode(encode(table(spark, sf_dir, "documents"), path), path))
