import base64
import hashlib
import random
from pathlib import Path

import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from lectern.llm import automaton, budget, tokens, words

DIRECTORY = automaton.DEFAULT_DIR
ODD = [
    "", " ", "   ", "\n", "a  b", " a", "a ", "a \n b", "don't DON'T we'll", "<|endoftext|> is text", "é é ́x", "½ ² Ⅷ", "\x1c\x1d a\x85b\xa0 c",
    "😀 👩‍👩‍👧", "a" * 5000, "=" * 3000, " " * 400 + "x", "naïve　x y", "tab\tand\r\nline", "数学講義 1", "x" * 200_000,
]


@pytest.fixture(scope="module")
def model():
    return automaton.load(DIRECTORY, "byte_bpe_50k")


@pytest.fixture(scope="module")
def reference():
    lines = (Path(DIRECTORY) / "byte_bpe_50k.tiktoken").read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=automaton.SPLIT, mergeable_ranks=ranks, special_tokens={})


def garbled(seed, n=300):
    draw = random.Random(seed)
    ranges = [(32, 127), (128, 0x300), (0x400, 0x500), (0x4E00, 0x4F00), (0x1F600, 0x1F640)]
    return ["".join(chr(draw.randrange(*draw.choice(ranges))) if draw.random() < 0.8 else draw.choice(" \n\t\xa0 ") for _ in range(draw.randrange(120))) for _ in range(n)]


def test_automaton_is_the_merges(model, reference):
    for text in ODD + garbled(1):
        ids = model.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert model.decode(ids) == text
    assert model.encode(None) == []
    assert model.clones == len(model.tokens) - 256 + 1  # one state a merge, and the first


def test_small_automaton_by_brute_force():
    merges = [b"aa", b"ab", b"aab", b"ba", b"aaaa"]
    model = automaton.Automaton([bytes([i]) for i in range(256)] + merges)
    ranks = {t: i for i, t in enumerate(model.tokens)}
    draw = random.Random(3)
    for _ in range(500):
        word = bytes(draw.choice(b"ab") for _ in range(draw.randrange(1, 14)))
        parts = [bytes([b]) for b in word]
        while True:
            best = min((ranks.get(parts[i] + parts[i + 1], 999), i) for i in range(len(parts) - 1)) if len(parts) > 1 else (999, 0)
            if best[0] == 999:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        assert model.encode_word(word) == [ranks[p] for p in parts]


def test_batches_give_the_same(model):
    encoder = tokens.Encoder(model, cached=50)  # the table begins anew again and again
    texts = [None, *ODD, *garbled(2), "the same text", "the same text"]
    for start in range(0, len(texts), 40):
        part = texts[start : start + 40]
        offsets, flat = encoder.ids(part)
        for k, text in enumerate(part):
            assert flat[offsets[k] : offsets[k + 1]].tolist() == model.encode(text)
        assert encoder.counts(part).tolist() == [len(model.encode(t)) for t in part]


def test_columns(spark, model):
    rows = [(1, None, "x"), (2, "", "y"), (3, "hello world", None), (3, "hello world", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("__text", F.lit("clash"))
    got = sorted((r["doc_id"], r["ids"]) for r in tokens.with_ids(df, "text", ["doc_id"]).collect())
    hello = model.encode("hello world")
    assert got == [(1, []), (2, []), (3, hello), (3, hello)]
    assert sorted(r["n_tokens"] for r in tokens.with_counts(df, "text", ["doc_id"]).collect()) == [0, 0, len(hello), len(hello)]
    assert tokens.with_ids(df.limit(0), "text", ["doc_id"]).collect() == []
    back = tokens.with_ids(df, "text", ["doc_id"]).select(tokens.decode_udf(spark)("ids").alias("t"))
    assert sorted(r["t"] for r in back.collect()) == ["", "", "hello world", "hello world"]


def test_budget(spark, model):
    rows = [("a", "u", "en", "one two"), ("a", "u", "en", "one two"), ("b", "u", "en", "one two"), ("c", None, "en", None), ("d", None, "en", ""), ("e", "", None, "x"), ("a", "w", "en", "one two"), (None, "w", "en", None)]
    df = spark.createDataFrame(rows, "id string, u string, lang string, t string").withColumn("n_tokens", F.lit("clash"))
    got = {(r["u"], r["lang"]): (r["n_videos"], r["n_tokens"]) for r in budget.token_budget(df, "id", "t", ["u", "lang"]).collect()}
    n = len(model.encode("one two"))
    assert got == {("u", "en"): (2, 2 * n), (None, "en"): (2, 0), ("", None): (1, 1), ("w", "en"): (2, n)}
    assert budget.token_budget(df.limit(0), "id", "t", ["u", "lang"]).collect() == []


def test_slices_are_bounded_in_rows_and_bytes():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * 100] * 50 + ["y" * 10_000] + ["z"] * 9})
    got = list(words.slices(iter([batch]), rows=20, size=2000))
    assert pa.Table.from_batches(got).to_pydict() == batch.to_pydict()
    assert all(b.num_rows <= 20 and (b.nbytes <= 2000 or b.num_rows == 1) for b in got)
    assert list(words.slices(iter([batch.slice(0, 0)]))) == []


def test_budget_of_a_text_that_looks_like_a_hash(spark):
    rows = [("a", "u", None), ("b", "u", hashlib.md5(b"u").hexdigest()), ("c", "v", None)]
    df = spark.createDataFrame(rows, "video_id string, university string, transcript string")
    got = {r["university"]: (r["n_videos"], r["n_tokens"]) for r in budget.token_budget(df, "video_id", "transcript", ["university"]).collect()}
    assert got["v"] == (1, 0) and got["u"][0] == 2 and got["u"][1] > 0
