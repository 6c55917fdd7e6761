import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from flowtally.llm import packing
from flowtally.llm.encoder import WordEncoder
from flowtally.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, length long, ids string"
ODD = [
    "it's 3 O'CLOCK, don't 'Ll 're", "<|endoftext|>a <|startoftext|>", "x<|endoftext|>y", "İstanbul ŉ Σίσυφος ΣΑΣ",
    "é ño ́x", "a b c\u0085d\x1ce\x0bf\x0cg", "日本語 テスト 12３", "​zero‍", "", "   ", "\r\n\t",
    "ſharp ß ẞ ﬁ", "🙂 a🙂b", "éÉèÈ çÇ ñÑ öÖßẞ", "0" * 50, "x" * 3000, "a  b", "²³ ½ ª º × ÷",
]


@pytest.fixture(scope="module")
def full():
    return Tokenizer.from_file(tokenizer_path())


def test_words_give_the_ids_of_the_tokenizer(full, spark):
    encode = WordEncoder(tokenizer_path(), words=50, pieces=20)
    texts = ODD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()[:60]]
    for text in texts:
        ids = np.frombuffer(encode(text), dtype="<i4").tolist()
        assert ids == full.encode(text, add_special_tokens=False).ids, text[:60]


def test_pieces_hold_every_id_once(spark, full):
    rows = [(i, t, 0, "x") for i, t in enumerate(ODD)] + [
        (100, None, 0, None), (101, "word " * 7000, 0, None), (None, "same", 0, None), (102, "same", 0, None),
        (102, "same", 0, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    pieces = packing.pack(docs, tokenizer_path(), size=64).collect()
    wanted = defaultdict(list)
    for doc_id, text, _, _ in rows:
        wanted[doc_id].append(full.encode(text or "", add_special_tokens=False).ids + [1])
    got = defaultdict(list)
    sequences = defaultdict(list)
    for p in pieces:
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], dtype="<u4").tobytes())
        assert p["length"] == len(p["ids"]) > 0
        got[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for doc_id, texts in wanted.items():
        ids = [i for p in sorted(got[doc_id], key=lambda p: p["start"]) for i in p["ids"]]
        assert sorted(ids) == sorted(i for t in texts for i in t)
        if len(texts) == 1:
            assert ids == texts[0]
            assert {p["doc_tokens"] for p in got[doc_id]} == {len(ids)}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        # A full sequence or a power of two: nothing is padded.
        assert at <= 64 and at & (at - 1) == 0


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1500, 4000).tolist()
    places, sequences = packing.assign(lengths, 2048, 1.0, 1 / 2048)
    cost, used = np.zeros(sequences), np.zeros(sequences)
    for _, _, n, s, _ in places:
        cost[s] += n + n * n / 2048
        used[s] += n
    full = used == 2048
    assert used.sum() == sum(lengths) and full.sum() >= sequences - 11
    assert cost[full].max() < 1.6 * cost[full].mean()


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0
