import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql.types import LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from siltworks.llm import alignment as al
from siltworks.llm.tokens import _BYTE_CHARS, vocabulary

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("pairs", StringType()), StructField("block", StringType())])
A = Tokenizer.from_file(vocabulary(al.A_FILE))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=vocabulary(al.B_FILE))
VALUE = {c: b for b, c in enumerate(_BYTE_CHARS)}


def sides(text):
    """Tokens of both sides as (id, bytes), or nothing where they don't spell the text."""
    if not text:
        return [], []
    a = A.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(VALUE[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(rows):
    docs, times = [], Counter()
    for doc_id, text, *_ in rows:
        a, b = map(spans, sides(text))
        links = [(x, y) for x, s, e in a for y, t, f in b if max(s, t) < min(e, f)]
        times.update(links)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, _, e in side if low < e <= cut) for side in (a, b)))
            low = cut
        docs.append((doc_id, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = Counter()
    for (x, y), n in times.items():
        most[y] = max(most[y], n)
    out = Counter()
    for doc_id, n_a, n_b, n_groups, links, digest in docs:
        out[doc_id, n_a, n_b, n_groups, len(links), sum(times[p] == most[p[1]] for p in links), sum(times[p] for p in links), digest] += 1
    return out, times


def odd_texts():
    rng = random.Random(11)
    words = ["the", "Quick", "Straße", "日本語テキスト", "naïve", "é", "ﬁ", "x" * 70, "123456", "--", "...", "it's", "🙂🙃", " ", " ", "\x00", "\r\n", "　", "don’t", "ABCdef", "</s>", "<|endoftext|>"]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", "\t", "   ", " \n ", "\n  ", "\r\n"]
    out = [None, "", " ", "\n", "  ", "\n\n", " a", "a ", "\na\n", "a\nb", "a  b", "<|endoftext|>", "</s> <s>", "▁", "a ▁b", "\ta", "é" * 300, "a" * 3000, " " * 100, "\n" * 50]
    for _ in range(80):
        out.append("".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(60))))
    return out


def frame(spark, texts):
    rows = [(i if i % 9 else None, t, "clash", "x") for i, t in enumerate(texts)]
    rows += [rows[-1], rows[30]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


def numbers(df):
    return Counter(tuple(r) for r in df.collect())


def test_equals_the_definition(spark):
    docs, rows = frame(spark, odd_texts())
    want, times = brute(rows)
    assert numbers(al.aligned_documents(docs)) == want
    got = {(r["a"], r["b"]): r["n"] for r in al.id_pairs(docs).collect()}
    assert got == times


def test_many_small_blocks(spark, monkeypatch):
    texts = odd_texts()
    side = al.encoders(vocabulary(al.A_FILE), vocabulary(al.B_FILE))
    for encoder in side:
        whole = encoder.encode(pa.array([" " + t if t else "" for t in texts]))
        each = [encoder.encode(pa.array([" " + t if t else ""])) for t in texts]
        assert whole[0].tolist() == np.concatenate([e[0] for e in each]).tolist() and whole[1].tolist() == [int(e[1][0]) for e in each]


@pytest.mark.parametrize("number", [0, 1])
def test_ids_are_the_libraries(number):
    side = al.encoders(vocabulary(al.A_FILE), vocabulary(al.B_FILE))[number]
    for text in odd_texts():
        if text:
            want = A.encode(" " + text, add_special_tokens=False).ids if number == 0 else B.encode(text)
            assert side.encode(pa.array([" " + text]))[0].tolist() == want, repr(text)


def test_a_text_larger_than_a_block(spark):
    rng = random.Random(2)
    text = " ".join(rng.choice(["lorem", "ipsum", "dolor", "Sit", "amet\n", "x1y2"]) for _ in range(250_000))
    docs = spark.createDataFrame([(1, text), (2, "lorem ipsum"), (3, None)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r for r in al.aligned_documents(docs).collect()}
    a, b = sides(text)
    ends = lambda tokens: set(np.cumsum([len(x) for _, x in tokens]).tolist())
    common = ends(a) & ends(b)
    assert len(text) > 1 << 20
    assert (got[1]["n_a"], got[1]["n_b"], got[1]["n_groups"], got[1]["n_links"]) == (len(a), len(b), len(common), len(a) + len(b) - len(common))
    assert got[3]["n_links"] == 0 and got[3]["groups_sha256"] == ""


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want, _ = brute([tuple(r) for r in docs.where("length(text) < 4000").select("doc_id", "text").collect()])
    assert numbers(al.aligned_documents(docs.where("length(text) < 4000"))) == want


def test_empty_table(spark):
    docs, _ = frame(spark, odd_texts())
    assert al.aligned_documents(docs.where("false")).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert numbers(al.aligned_documents(nothing)) == Counter({(1, 0, 0, 0, 0, 0, 0, ""): 1, (2, 0, 0, 0, 0, 0, 0, ""): 1})
