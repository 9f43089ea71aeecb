"""SentencePiece encoding and decoding with N-best segmentations.

A text is cut into segments before which every segmentation must have a boundary (no piece holds a space after another
character). On a segment's lattice of pieces, a forward Viterbi pass gives the score of the best way to each position;
these scores are exact heuristics for a backward A-star search that yields segmentations from the best on. A text's
segmentations differ in few segments: the n best need only the n - 1 segments that lose least by their second-best way,
and the same search runs over this chain.

Scores are the model's own. Characters that no piece covers become byte pieces, and so does a literal U+2581, which the
model writes for a space; so decode(encode(text)) is the text, whatever it holds. Null and empty texts have no ids and
one segmentation, of score 0. Among equal scores the one found first counts; the order is the same in every run. Texts
are taken whole. Repeated rows give repeated results; other columns are kept, except one named like the result.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siteweave.llm.common import Recent, kept, pieces, schema_with, table

SPACE = "▁"
#: Stands for a literal U+2581 while a text is encoded; a lone surrogate, so no text from a file holds it.
_LITERAL = "\udcff"
_SEGMENT = re.compile(r" +[^ ]*")
NEVER = float("-inf")
#: Segments that a worker remembers, twice over at most; each takes about 300 bytes. ALONE: in workers that serve no other operator.
CACHED, ALONE = 150_000, 450_000
SEGMENTATIONS = 4


class Model:
    """The pieces of a model file, and what this worker has encoded with them."""

    def __init__(self, path: str, cached: int = CACHED) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(size)]
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = {i: b for b, i in enumerate(self.byte_ids)}
        self.auto = ahocorasick.Automaton()
        self.single, self.pairs = set(), set()
        lowest = 0.0
        for i, piece in enumerate(self.text):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or i in self.bytes:
                self.text[i] = ""
                continue
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {i} holds a space inside; texts can't be cut at spaces")
            score = sp.get_score(i)
            lowest = min(lowest, score) if score > -1e8 else lowest
            self.auto.add_word(piece, (i, len(piece), score))
            self.pairs.update(map("".join, zip(piece, piece[1:])))
            if len(piece) == 1:
                self.single.add(piece)
        self.auto.make_automaton()
        self.written = [bytes([self.bytes[i]]) if i in self.bytes else piece.replace(SPACE, " ").encode() for i, piece in enumerate(self.text)]
        self.unknown = lowest - 10
        # A segment is looked up without its leading space, which all have.
        self.known = Recent(cached, lambda rest: self.best(SPACE + rest))
        self.parts, self.ways = Recent(cached, self.viterbi), Recent(cached // 8)

    def edges(self, segment: str) -> list[tuple[int, int, float, object]]:
        """(start, end, score, id or character) of the lattice, by end."""
        out = [(at + 1 - size, at + 1, score, i) for at, (i, size, score) in self.auto.iter(segment)]
        if not self.single.issuperset(segment):
            out += [(k, k + 1, self.unknown, c) for k, c in enumerate(segment) if c not in self.single]
            out.sort(key=lambda e: e[1])
        return out

    def as_ids(self, path: list[object]) -> bytes:
        try:
            return array("I", path).tobytes()
        except TypeError:  # characters that no piece covers
            out: list[int] = []
        for p in path:
            if isinstance(p, str):
                out += [self.byte_ids[b] for b in (SPACE if p == _LITERAL else p).encode("utf-8", "surrogatepass")]
            else:
                out.append(p)
        return np.array(out, dtype="<u4").tobytes()

    def best(self, segment: str) -> tuple[bytes, float, float]:
        """The ids of the best way through a segment, its score, and what the second best loses."""
        # No piece holds two characters that are side by side in none; every way has a boundary between them.
        if segment[1:].isalpha():
            return self.parts[segment]
        pairs = self.pairs
        cuts = [k for k in range(1, len(segment)) if segment[k - 1 : k + 1] not in pairs]
        found = [self.parts[segment[a:b]] for a, b in zip([0, *cuts], [*cuts, len(segment)], strict=True)]
        if len(found) == 1:
            return found[0]
        ids, scores, losses = zip(*found)
        return b"".join(ids), sum(scores), min(losses)

    def viterbi(self, segment: str) -> tuple[bytes, float, float]:
        n, edges = len(segment), self.edges(segment)
        forward, back = [NEVER] * (n + 1), [None] * (n + 1)
        forward[0] = 0.0
        for e in edges:
            start, end, score, _ = e
            v = forward[start] + score
            if v > forward[end]:
                forward[end], back[end] = v, e
        path, at, on_path = [], n, [None] * (n + 1)
        while at:
            e = on_path[at] = back[at]
            path.append(e[3])
            at = e[0]
        path.reverse()
        second = NEVER
        if len(edges) > len(path):
            # Another way holds an edge that the best lacks; the best way over an edge is forward + edge + backward.
            backward = [NEVER] * (n + 1)
            backward[n] = 0.0
            edges.reverse()
            for e in edges:
                start, end, score, _ = e
                v = backward[end] + score
                if v > backward[start]:
                    backward[start] = v
                v = forward[start] + score + backward[end]
                if v > second and on_path[end] is not e:
                    second = v
        return self.as_ids(path), forward[n], forward[n] - second

    def segment_ways(self, segment: str, n: int) -> list[tuple[float, bytes]]:
        """The n best ways through a segment, by A-star from its end."""
        new = self.ways.missing({segment})
        known = self.ways.get(segment)
        if new or len(known) < n:
            by_end: list[list] = [[] for _ in range(len(segment) + 1)]
            forward = [NEVER] * (len(segment) + 1)
            forward[0] = 0.0
            for e in self.edges(segment):
                forward[e[1]] = max(forward[e[1]], forward[e[0]] + e[2])
                by_end[e[1]].append(e)
            known, serial = [], itertools.count()
            # Among equal totals the way nearest to the start goes on, so ties don't spread the search.
            heap = [(-forward[-1], len(segment), next(serial), 0.0, None)]
            while heap and len(known) < n:
                total, at, _, gone, path = heapq.heappop(heap)
                if not at:
                    ids = []
                    while path:
                        ids.append(path[0])
                        path = path[1]
                    known.append((-total, self.as_ids(ids)))
                    continue
                for s, _, score, value in by_end[at]:
                    heapq.heappush(heap, (-(forward[s] + gone + score), s, next(serial), gone + score, (value, path)))
            self.ways[segment] = known
        return known[:n]

    def segments(self, text: str) -> list[str]:
        """Segments as stored: with the first space left off, and later ones written as the model does."""
        if SPACE in text:
            text = text.replace(SPACE, _LITERAL)
        if "  " not in text and text[0] != " ":
            return text.split(" ")
        return [s[1:].replace(" ", SPACE) for s in _SEGMENT.findall(" " + text)]

    def nbest(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The n best segmentations of a text as (score, ids as little-endian unsigned 32-bit numbers)."""
        if not text:
            return [(0.0, b"")]
        parts = self.segments(text)
        ids, scores, losses = zip(*map(self.known.__getitem__, parts), strict=True)
        best = float(sum(scores))
        out = [(best, b"".join(ids))]
        if n < 2:
            return out
        loss = np.array(losses)
        least = np.sort(loss.argpartition(n - 2)[: n - 1]) if len(loss) >= n else np.arange(len(loss))
        open_at = [(int(k), self.segment_ways(SPACE + parts[k], n)) for k in least if np.isfinite(loss[k])]
        # Where the ids of the open segments lie.
        whole, spans, at, done = out[0][1], [], 0, 0
        for k, _ in open_at:
            at += sum(map(len, ids[done:k]))
            spans.append((at, at + len(ids[k])))
            done = k
        # A-star over the chain: a state says which way each open segment goes; the next states lose no less.
        heap, seen = [(-best, (0,) * len(open_at))], {(0,) * len(open_at)}
        while heap:
            total, ways = heapq.heappop(heap)
            if any(ways):
                changed, at = [], 0
                for (_, options), w, (lo, hi) in zip(open_at, ways, spans, strict=True):
                    if w:
                        changed += [whole[at:lo], options[w][1]]
                        at = hi
                out.append((-total, b"".join([*changed, whole[at:]])))
                if len(out) == n:
                    break
            for j, (_, options) in enumerate(open_at):
                if ways[j] + 1 < len(options):
                    after = (*ways[:j], ways[j] + 1, *ways[j + 1 :])
                    if after not in seen:
                        seen.add(after)
                        heapq.heappush(heap, (total + options[ways[j]][0] - options[ways[j] + 1][0], after))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; their bytes, those of byte pieces among them, are read as UTF-8."""
        return b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


def model(path: str, cached: int = CACHED) -> Model:
    """This worker's model; it lives on from task to task."""
    models = kept("sentence_pieces")
    if (path, cached) not in models:
        for other in [k for k in models if k[0] == path]:  # one size of a model at a time, so that they don't add up
            del models[other]
        models[path, cached] = Model(path, cached)
    return models[path, cached]


def encode(df: DataFrame, path: str, n: int = SEGMENTATIONS, text: str = "text", into: str = "segmentations") -> DataFrame:
    """df with the n best segmentations of its text, best first, as structs of score and ids."""
    keep = [c for c in df.columns if c != into]
    kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = model(path)
        for batch in pieces(batches, text, 1 << 20):
            found = [[{"score": s, "ids": np.frombuffer(i, "<i4")} for s, i in sp.nbest(t or "", n)] for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*keep, into])

    return df.select(*keep).mapInArrow(run, schema_with(df.select(*keep), **{into: "array<struct<score:double,ids:array<int>>>"}))


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """df with the text of a column of ids; null for null."""
    keep = [c for c in df.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = model(path)
        for batch in batches:
            texts = [None if i is None else sp.decode(i) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, into])

    return df.select(*keep).mapInArrow(run, schema_with(df.select(*keep), **{into: "string"}))


def digest(df: DataFrame, path: str, n: int = SEGMENTATIONS, text: str = "text", cached: int = CACHED) -> DataFrame:
    """df without its text, with what sums its segmentations up: number of ids of the best, CRC-32 and score of each, and
    whether the ids of the best decode to the text. cached: segments that a worker remembers."""
    more = {"n_tokens": "long", "ids_crc32": "long", "scores": "array<double>", "crc32s": "array<long>", "round_trip": "boolean"}
    keep = [c for c in df.columns if c != text and c not in more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = model(path, cached)
        for batch in pieces(batches, text, 4 << 20):
            rows = []
            for t in batch.column(text).to_pylist():
                ways = sp.nbest(t or "", n)
                crcs = [zlib.crc32(i) for _, i in ways]
                back = sp.decode(np.frombuffer(ways[0][1], "<u4").tolist())
                rows.append((len(ways[0][1]) // 4, crcs[0], [s for s, _ in ways], crcs, back == (t or "")))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.bool_())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=[*keep, *more])

    return df.select(*keep, text).mapInArrow(run, schema_with(df.select(*keep), **more))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents").select("doc_id", "text"), model_path(), cached=ALONE)
