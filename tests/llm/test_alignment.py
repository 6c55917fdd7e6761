import hashlib
from bisect import bisect
from collections import Counter
from itertools import takewhile

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from flowtally.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "a", " lead", "trail ", "two  spaces", "three   spaces and\n new\n\nlines ", "tab\t x\t\ty",
    "the the the quick brown fox", "Größe élan naïve café", "日本語のテキスト と 中文", "emoji 🙂🙂 x", "<|endoftext|> </s> <s> <unk>",
    "bad ▁ piece", "nbsp  x 　 y", "it's we'll 1234567 3.14159 !!! ??? (a+b)*c", "aa aaa aaaa aaaaa", "x" * 3000,
    "nul\x00byte", "\x1c \x85 odd", "é combining", "the the the quick brown fox", "\r\n \r\n  end", "\nfirst", "\n", "one\ntwo\nthree four\n", "\n\nx \n y", "end \n", "a\u3000b \u3000c\u3000 d", "ﬁ ligature ½ Ⅷ",
]
SCHEMA = "doc_id long, text string, a string, row string"


@pytest.fixture(scope="module")
def tables():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b, alignment.token_bytes_a(a), alignment.token_bytes_b(b)


def brute(texts, tables):
    """Whole texts, all pairs of tokens."""
    a, b, bytes_a, bytes_b = tables
    docs = []
    for text in texts:
        ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        spans = []
        for side, table in zip(ids, (bytes_a, bytes_b)):
            at, found = 0, []
            for i in side:
                found.append((i, at, at + len(table[i])))
                at += len(table[i])
            spans.append(found)
        whole = (" " + (text or "")).encode()
        fit = text and all(b"".join(t[i] for i in side) == whole for side, t in zip(ids, (bytes_a, bytes_b)))
        docs.append(spans if fit else [[], []])
    links = []
    for sa, sb in docs:
        ends = [y[2] for y in sb]
        links.append([(x[0], y[0]) for x in sa for y in takewhile(lambda y: y[1] < x[2], sb[bisect(ends, x[1]):])])
    counts = Counter(pair for doc in links for pair in doc)
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    out = []
    for i, ((sa, sb), doc) in enumerate(zip(docs, links)):
        ends = sorted({x[2] for x in sa} & {y[2] for y in sb})
        groups, left = [], [list(sa), list(sb)]
        for end in ends:
            cut = [[x for x in takewhile(lambda x: x[2] <= end, side)] for side in left]
            left = [side[len(part):] for side, part in zip(left, cut)]
            groups.append("|".join(",".join(str(x[0]) for x in part) for part in cut))
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if sa else ""
        out.append((i, len(sa), len(sb), len(groups), len(doc), sum(counts[p] == most[p[1]] for p in doc),
                    sum(counts[p] for p in doc), sha))
    return out


@pytest.mark.parametrize("block, cache", [(alignment.BLOCK, alignment.CACHE), (40, 10)])
def test_equals_whole_texts(spark, tables, block, cache):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(TEXTS)], SCHEMA).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2 if cache == 10 else 10_000)
    try:
        assert sorted(map(tuple, alignment.align(docs, A, B, block, cache).collect())) == brute(TEXTS, tables)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_real_documents(spark, tables):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [row["text"] for row in docs.orderBy("doc_id").select("text").collect()]
    got = sorted(map(tuple, alignment.align(docs, A, B).collect()))
    assert [row[1:] for row in got] == [row[1:] for row in brute(texts, tables)]
    assert sum(row[1] for row in got) > 10_000


def test_segments_join_to_the_text():
    for text in filter(None, TEXTS):
        assert "".join(map(alignment.whole, alignment.segments(text))) == " " + text


def test_repeated_rows_and_empty_table(spark, tables):
    rows = [(1, "one two"), (1, "one two"), (None, "one two"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, alignment.align(docs, A, B).collect()), key=repr)
    want = [(doc_id, *row[1:]) for (doc_id, _), row in zip(rows, brute([t for _, t in rows], tables))]
    assert got == sorted(want, key=repr)
    assert alignment.align(docs.where("false"), A, B).count() == 0
