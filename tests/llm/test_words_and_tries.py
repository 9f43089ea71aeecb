"""Prefix tries, byte-level BPE and spelling variants against brute force."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siteweave.llm import byte_pairs, prefix_trie, spelling
from siteweave.llm.common import utf8

ODD = ["", None, " ", "  x", "x  ", "\n\n x", "don't 'tis we'll I'd they've'S ''s 's's", "日本語　テスト", "a" * 5000, "é" * 300 + " x" * 3000, "1234 ٣٤ ½x", "\x1c\x85  ", "tab\tand\r\nnewline ", "x́y", "🙂👍🏽 <|endoftext|>"]


def of_ids(path):
    import public_tokenizers

    return byte_pairs._encoding(byte_pairs.read_ranks(path), public_tokenizers.PATTERN)


def ranks():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_pre_tokens_are_those_of_the_pattern():
    import public_tokenizers
    import regex

    rng, letters = random.Random(1), " \n\t　\x1c'sStrveldmax19é.,١!"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    raw, offsets = utf8(pa.array(texts))
    starts = byte_pairs.Splitter(byte_pairs.read_ranks(ranks())).starts(raw, offsets)
    found = [(got - at).tolist() for got, at in zip(np.split(starts, np.searchsorted(starts, offsets[1:-1])), offsets, strict=False)]
    expression = regex.compile(public_tokenizers.PATTERN)
    for text, got in zip(texts, found, strict=True):
        sizes = [len(m.encode()) for m in expression.findall(text)]
        assert got == [sum(sizes[:k]) for k in range(len(sizes))], repr(text)


def test_every_character_as_the_library_takes_it():
    """All code points, also those that editions of Unicode disagree on, between letters, digits, signs and spaces."""
    split, enc = byte_pairs.Splitter(byte_pairs.read_ranks(ranks())), of_ids(ranks())
    rng = random.Random(2)
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    rng.shuffle(points)
    texts = ["".join(chr(p) + rng.choice(["a", "7", "!", " ", "", "\n", "'s"]) for p in points[k : k + 50]) for k in range(0, 200_000, 50)]
    raw, offsets = utf8(pa.array(texts))
    starts = split.starts(raw, offsets)
    data = raw.tobytes()
    for text, own, lo, hi in zip(texts, np.split(starts, np.searchsorted(starts, offsets[1:-1])), offsets, offsets[1:], strict=False):
        cuts = [*own.tolist(), int(hi)]
        assert cuts[0] == lo
        assert [i for a, b in itertools.pairwise(cuts) for i in enc.encode_ordinary(data[a:b].decode())] == enc.encode_ordinary(text)


@pytest.mark.parametrize(("block", "buckets"), [(byte_pairs.BLOCK, None), (40, 3)])
def test_byte_pairs_encode_and_decode_as_the_library(spark, block, buckets):
    rows = [*enumerate(ODD), (None, "no id"), (3, "an id twice"), (3, "an id twice")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, decoded int").repartition(3)
    found = byte_pairs.decode(byte_pairs.encode(df, ranks(), block=block, buckets=buckets), ranks())
    enc = of_ids(ranks())
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in found.collect()), key=key) == sorted(((i, enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=key)
    sums = {r.doc_id: r for r in byte_pairs.digest(found).collect()}
    ids = enc.encode_ordinary(ODD[6])
    assert (sums[6].n_tokens, sums[6].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert sums[0].ids_sha256 == sums[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_byte_pairs_are_put_in_order_a_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(byte_pairs, "CHUNK", 5)
    texts = ["one two three four five six seven", "", "eight", "nine ten eleven it's", None, "twelve " * 9]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    enc = of_ids(ranks())
    got = {r["doc_id"]: r["ids"] for r in byte_pairs.encode(df, ranks()).collect()}
    assert got == {k: enc.encode_ordinary(t or "") for k, t in enumerate(texts)}


def test_byte_pairs_of_nothing(spark):
    assert byte_pairs.encode(spark.createDataFrame([], "doc_id long, text string"), ranks()).count() == 0
    assert [r.decoded for r in byte_pairs.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), ranks()).collect()] == [None]


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("most", [spelling.MOST, 4])
def test_variants_are_all_pairs_at_one_edit(spark, most):
    rng = random.Random(4)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(400)} | {"", "a", "b", "ab", "aa", "aab", "x" * 3000, "x" * 2999 + "y", "x" * 3001}
    df = spark.createDataFrame([(w, len(w) + 1) for w in words], "word string, n long")
    found = sorted((r.word, r.other, r.n_other) for r in spelling.variants(df.where("word <> ''"), most).collect())
    assert found == sorted((a, b, len(b) + 1) for a in words for b in words if a and b and a != b and one_edit(a, b))


def test_word_counts_with_deleted_letters(spark):
    rng = random.Random(5)
    docs = [(rng.choice([None, *range(50)]), " ".join(rng.choice(["Straßen", "ÀÉÎabcd", "Wörterbuch", "plainword", "x-ray", "日本語abcdefgh"]) for _ in range(40))) for _ in range(60)] + [(1, None), (2, ""), (3, "éé" * 4000)]
    want = {}
    import re

    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                want[run] = want.get(run, 0) + 1
    df = spark.createDataFrame([(i, t, "w", 5) for i, t in docs], "doc_id long, text string, word string, n int")
    assert {r.word: r.n for r in spelling.word_counts(df).collect()} == want
    assert spelling.word_counts(df.limit(0)).count() == 0
    assert spelling.grouped(spelling.word_counts(df.limit(0))).count() == 0


def test_forms_and_roots(spark):
    counts = {"correctly": 5000, "corectly": 90, "corectlyy": 3, "correctlx": 500, "unrelated": 10, "unrelatet": 10, "unrelatee": 1}
    found = {r.word: r for r in spelling.grouped(spark.createDataFrame([*counts.items()], "word string, n long")).collect()}
    assert {w: (r.form, r.root, r.n_near, r.form_n) for w, r in found.items()} == {
        "correctly": (None, "correctly", 2, None), "corectly": ("correctly", "correctly", 2, 5000), "corectlyy": ("corectly", "correctly", 1, 90), "correctlx": ("correctly", "correctly", 1, 5000),
        "unrelated": (None, "unrelated", 2, None), "unrelatet": (None, "unrelatet", 2, None), "unrelatee": ("unrelated", "unrelated", 2, 10),
    }


def tried(rows):
    """The trie by brute force: (depth, path) to its columns."""
    own = {}
    for c, *turn in rows:
        if c is not None:
            own.setdefault(c, []).append(turn)
    own = {c: [(r or "", t or "") for _, r, t in sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))] for c, turns in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    path = {c: (*own.get(c - c % 20, [])[: h[c]], *own[c][h[c] :]) for c in own}
    nodes = {p[:d] for p in path.values() for d in range(len(p) + 1)}
    below = {n: [c for c in sorted(path) if path[c][: len(n)] == n] for n in nodes}
    children = {n: [m for m in nodes if len(m) == len(n) + 1 and m[: len(n)] == n] for n in nodes}
    words = lambda n: len([w for w in __import__("re").split("[\x20\x09-\x0d]+", n[-1][1]) if w]) if n else 0
    out = []
    for n in nodes:
        sub = [m for m in nodes if m[: len(n)] == n]
        ends = ",".join(str(c) for c in below[n] if path[c] == n)
        out.append((below[n][0], len(n), below[n[:-1]][0] if n else None, len(below[n]), len(children[n]), sum(not children[m] for m in sub), sum((len(below[m]) - 1) * words(m) for m in sub), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("members", [1, 3, prefix_trie.MEMBERS])
def test_tries_against_brute_force(spark, members):
    rng = random.Random(6)
    rows = []
    for c in rng.sample(range(200), 90):
        for turn in range(rng.randint(1, 6)):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["u", "a", None]), rng.choice(["a b", "a  b c ", "", None])))
    rows += [(400, k, "u", "a b") for k in range(60)] + [(407, k, "u", "a b") for k in range(60)] + rows[:5] + [(None, 1, "u", "lost")]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, d int, label string").repartition(5)
    got = prefix_trie.conversation_trie(df, members).select("conv_id", "d", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == tried(rows)


def test_tries_of_nothing_and_of_no_turns(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert prefix_trie.conversation_trie(spark.createDataFrame([], kind)).count() == 0
    short = [(c, 0, "u", "x") for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    got = prefix_trie.conversation_trie(spark.createDataFrame(short, kind)).collect()
    assert [(r.d, r.n_convs, r.n_children, r.n_leaves) for r in got] == [(0, len(short), 0, 1)]
    assert got[0].ends_sha256 == hashlib.sha256(",".join(str(c) for c, *_ in short).encode()).hexdigest()


def test_level_order_bits():
    parent = np.array([-1, -1, 0, 0, 1, 3])
    bits = prefix_trie.louds(parent)
    assert "".join(map(str, bits)) == "110" "110" "10" "0" "10" "0" "0"
    assert prefix_trie.parents(bits).tolist() == parent.tolist()
