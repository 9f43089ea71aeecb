"""Toxicity by compression distance: how much shorter a window gets with a dictionary of toxic text than with one of
ordinary text.

A window is a word with a space on either side (long words are cut into windows of 32 bytes). Its bytes are written as
four-byte symbols before they are compressed, so that zstandard's length counts the dictionary phrases that the window is
made of: a word that the dictionary holds is one phrase, another one several. Both dictionaries are trained by zstandard:
the toxic one on windows that stand out in toxic text, the other on windows of ordinary text. The pair of lengths gives
each window a log-likelihood ratio, read from a table that was counted on labelled texts not used for the dictionaries;
a logistic model over a document's windows is the calibrated threshold.

The fit sees a bounded sample of labelled rows (FIT_TOXIC and FIT_CLEAN documents, whole, in the order of a hash of the
id); executors count their windows, and the driver gets each document's distinct windows with counts. Scoring covers all windows of every text. Null and empty texts have no windows and get the
score of that; texts without a label in the sample change nothing. If the sample lacks one of the classes, every score is
the share of toxic labels. Repeated rows get equal scores; columns besides id and text are kept by score().
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm.common import Recent, kept, pieces, schema_with, table, utf8

FIT_TOXIC, FIT_CLEAN = 3_000, 4_000
LONGEST = 32
#: Bytes of a symbol, and of the dictionaries in windows' bytes.
SYMBOL, TOXIC_DICT, PLAIN_DICT = 4, 4_096, 32_768
#: How many standard deviations a window is more common in toxic text, to be trained on as toxic.
STAND_OUT = 2.5
#: Windows that a worker remembers, twice over at most.
CACHED = 200_000
#: Letters and digits in lower case, everything else in ASCII a space; other bytes as they are.
_FOLD = np.array([b if b >= 128 or chr(b).isalnum() else 0x20 for b in range(256)], dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_SYMBOLS = np.random.default_rng(7).integers(0, 256, (256, SYMBOL)).astype(np.uint8)
_GAP, _LEN = 36, 16
_LEVELS = (1.0, 2.0, 3.0, 4.0, 5.0)


def folded(text: str | None) -> bytes:
    return _FOLD[np.frombuffer((text or "").encode(), np.uint8)].tobytes()


def windows(text: bytes) -> list[bytes]:
    """The windows of a folded text."""
    words = text.split()
    return words if len(text) <= LONGEST or max(map(len, words), default=0) <= LONGEST else [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


def _wide(window: bytes) -> bytes:
    return _SYMBOLS[np.frombuffer(b" " + window + b" ", np.uint8)].tobytes()


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """zstandard's choice of content; its raw samples where there are too few to choose from."""
    wide = [_wide(s) for s in samples]
    try:
        return zstandard.train_dictionary(size * SYMBOL, wide, k=128, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(wide))[-size * SYMBOL :] or bytes(16)


class Lengths:
    """Compressed lengths of windows under one dictionary."""

    def __init__(self, dictionary: bytes) -> None:
        how = zstandard.ZstdCompressionParameters(window_log=19, hash_log=18, chain_log=18, search_log=5, min_match=4, target_length=32, strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.compressor = zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    def of(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0, dtype=np.int32)
        sizes = (np.fromiter(map(len, words), np.uint64, len(words)) + np.uint64(2)) * np.uint64(SYMBOL)
        starts = np.concatenate([np.zeros(1, np.uint64), np.cumsum(sizes)[:-1]]).astype(np.uint64)
        data = _SYMBOLS[np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8)].tobytes()
        out = self.compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(data, np.stack([starts, sizes], 1).tobytes()), threads=1)
        return np.fromiter((len(out[i]) for i in range(len(out))), np.int32, len(words))


@dataclass(frozen=True)
class Model:
    toxic: bytes
    plain: bytes
    ratio: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float


class Scorer:
    """A model at work; it remembers the ratios of the windows it has met."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, Recent(CACHED)
        self.toxic, self.plain = Lengths(model.toxic), Lengths(model.plain)

    def learn(self, words: set[bytes]) -> None:
        new = self.known.missing(words)
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            self.known.update(zip(part, self.model.ratio[_cells(self.toxic.of(part), self.plain.of(part))].tolist(), strict=True))

    def features(self, texts: list[bytes]) -> np.ndarray:
        cut = [windows(t) for t in texts]
        self.learn(set().union(*cut))
        get = self.known.__getitem__
        return np.array([_features(np.fromiter(map(get, c), np.float64, len(c))) for c in cut]).reshape(len(cut), -1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.model.weights):
            return np.full(len(texts), self.model.base)
        x = (self.features(texts) - self.model.mean) / self.model.scale
        return 1 / (1 + np.exp(-np.clip(np.c_[np.ones(len(x)), x] @ self.model.weights, -30, 30)))


def _cells(toxic: np.ndarray, plain: np.ndarray) -> np.ndarray:
    gap = np.clip(plain - toxic + 8, 0, _GAP - 1)
    return gap * _LEN + np.clip((toxic - 10) // 2, 0, _LEN - 1)


def _features(x: np.ndarray) -> np.ndarray:
    n = len(x)
    out = [np.log1p(n), np.log1p(np.maximum(x, 0).sum()), np.maximum(x, 0).sum() / (n + 3)]
    for level in _LEVELS:
        hits = (x >= level).sum()
        out += [np.log1p(hits), hits / np.sqrt(n + 1), min(1.0, 10 * hits / (n + 3))]
    top = np.sort(x)[::-1][:8]
    out += [*(top[k] if n > k else 0.0 for k in range(3)), top.sum() / 8]
    return np.array(out)


def _doc_counts(docs: list[np.ndarray], size: int) -> np.ndarray:
    """The number of documents that each window is in."""
    return np.bincount(np.concatenate([*docs, np.empty(0, np.int64)]).astype(np.int64), minlength=size).astype(float)


def bag(text: str | None) -> tuple[bytes, bytes]:
    """The distinct windows of a text, joined by spaces, and how often each is in it, as 32-bit numbers."""
    found = Counter(windows(folded(text)))
    return b" ".join(found), np.fromiter(found.values(), "<i4", len(found)).tobytes()


def fit(texts: list[str], toxic: list[int], share: float, seed: int = 0) -> Model:
    """share: of toxic labels among all, to which the scores are calibrated."""
    return fit_bags(map(bag, texts), toxic, share, seed)


def fit_bags(bags: Iterable[tuple[bytes, bytes]], toxic: list[int], share: float, seed: int = 0) -> Model:
    """fit() on the bags of the texts."""
    y = np.array(toxic, dtype=bool)
    none = np.empty(0)
    if y.all() or not y.any() or min(y.sum(), (~y).sum()) < 4:
        return Model(b"", b"", none, none, none, none, float(share))
    half = np.arange(len(y)) % 2 == 0
    code: dict[bytes, int] = {}
    words, often = [], []
    for names, counts in bags:
        words.append(np.array([code.setdefault(w, len(code)) for w in names.split()], dtype=np.int32))
        often.append(np.frombuffer(counts, "<i4"))
    names = list(code)
    del code
    count = lambda want: _doc_counts([words[i] for i in np.flatnonzero(want)], len(names))
    in_toxic, in_plain = count(half & y), count(half & ~y)
    usual = in_plain * (half & y).sum() / max(1, (half & ~y).sum())
    stand_out = ((in_toxic - usual) / np.sqrt(usual + 1) > STAND_OUT) & (in_toxic >= 6 * (usual + 0.5))
    rng = np.random.default_rng(seed)

    def draw(weights: np.ndarray, n: int) -> list[bytes]:
        total = weights.sum()
        return [names[i] for i in rng.choice(len(names), n, p=weights / total)] if total else []

    dicts = train_dictionary(draw(np.where(stand_out, in_toxic, 0), 30_000), TOXIC_DICT), train_dictionary(draw(np.where(stand_out, 0, in_plain), 80_000), PLAIN_DICT)
    lengths = [Lengths(d) for d in dicts]
    cells = np.concatenate([_cells(*(n.of(names[at : at + 50_000]) for n in lengths)) for at in range(0, len(names), 50_000)])
    # The ratios are counted and the document model is fitted on the half that the dictionaries have not seen.
    held = [np.bincount(cells, count(~half & c), _GAP * _LEN) for c in (y, ~y)]
    rare = 5 / max(5.0, held[0].sum())
    p, q = (h / max(1.0, h.sum()) + rare for h in held)
    ratio = np.log(p / q)
    value = ratio[cells]
    del names
    fitted = np.flatnonzero(~half)
    x, t = np.array([_features(np.repeat(value[words[i]], often[i])) for i in fitted]), y[fitted]
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    prior = min(max(share, 0.01), 0.5)
    sw = np.where(t, prior / max(1, t.sum()), (1 - prior) / max(1, (~t).sum())) * len(t)
    w, ridge = np.zeros(z.shape[1]), np.r_[1e-6, np.full(z.shape[1] - 1, 2.0)]
    for _ in range(40):
        pr = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve((z * (sw * pr * (1 - pr))[:, None]).T @ z + np.diag(ridge), z.T @ (sw * (t - pr)) - ridge * w)
    return Model(*dicts, ratio, mean, scale, w, share)


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[bytes, bytes]], list[int], float]:
    """The bounded sample for fit_bags() and the share of toxic labels, from rows whose crc32(doc_id) mod 5 is not 0."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    counts = dict(known.groupBy("toxic").count().collect())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = known.where("toxic = 1").orderBy(*order).limit(FIT_TOXIC).unionByName(known.where("toxic = 0").orderBy(*order).limit(FIT_CLEAN))
    # At most FIT_TOXIC + FIT_CLEAN ids, so the broadcast is bounded; repeated ids add their texts, at most one each.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("toxicity")
        for batch in pieces(batches, "text", 4 << 20):
            bags = [bag(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array([w for w, _ in bags], pa.binary()), pa.array([n for _, n in bags], pa.binary())], names=["doc_id", "toxic", "names", "counts"])

    kinds = dict(rows.dtypes)
    got = rows.mapInArrow(run, f"doc_id {kinds['doc_id']}, toxic {kinds['toxic']}, names binary, counts binary").collect()
    got.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    return [(bytes(r["names"]), bytes(r["counts"])) for r in got], [r["toxic"] for r in got], counts.get(1, 0) / max(1, sum(counts.values()))


def score(df: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """df with the score of its text column."""
    keep = [c for c in df.columns if c != into]
    shared = df.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size and a small table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        key = zlib.crc32(model.toxic + model.plain + model.weights.tobytes())
        scorers = kept("toxicity")
        if key not in scorers:
            scorers.clear()
            scorers[key] = Scorer(model)
        for batch in pieces(batches, text, 4 << 20):
            raw, offsets = utf8(batch.column(text))
            all_bytes = _FOLD[raw].tobytes()
            texts = [all_bytes[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scorers[key].score(texts), pa.float64())], names=[*keep, into])

    return df.select(*keep).mapInArrow(run, schema_with(df.select(*keep), **{into: "double"}))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_bags(*labelled(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    scored = score(docs, model, into="score").drop("text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
