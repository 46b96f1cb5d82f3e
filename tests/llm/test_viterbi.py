import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siltworks.llm import viterbi as vt
from siltworks.llm.tokens import vocabulary

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("ids", StringType())])
ODD = [None, "", " ", "   ", "a  b", "  lead", "tail ", "a\n\nb\t", "日本 語 é ß \U0001f600", "<s> hi </s> <0x41>", "x" * 400, "Ⅷ ﬁ", "\0", "a    b     c"]


@pytest.fixture(scope="module")
def model():
    return vt.pieces(vocabulary(vt.MODEL))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(vt.MODEL))


def texts(n=300):
    rng = random.Random(3)
    alphabet = ["the", "ing", "a", "e", "Th", "ß", "日", " ", " ", "  ", ".", "\n", "0", "tion", "\U0001f600", "qu"]
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_merges_equal_the_library(model, library):
    for text, raw in zip(texts(), model.encode(texts(), "merged"), strict=True):
        assert np.frombuffer(raw, np.int32).tolist() == library.encode(text or ""), repr(text)


def best_sum(word, score, unknown):
    """Dynamic programme over one word: best sum, and of equals the longest last piece."""
    best = [(0.0, [])]
    for j in range(1, len(word) + 1):
        found = None
        for size in range(1, min(16, j) + 1):
            s = score.get(word[j - size : j], unknown if size == 1 else None)
            if s is not None and (found is None or best[j - size][0] + s >= found[0]):
                found = (best[j - size][0] + s, [*best[j - size][1], word[j - size : j]])
        best.append(found)
    return best[-1]


def test_viterbi_finds_the_best_sum(model, library):
    plain = [i for i in range(3, library.get_piece_size()) if not library.is_byte(i)]
    score = {library.id_to_piece(i): library.get_score(i) for i in plain}
    words = sorted({w for t in texts() if t for w in vt._WORD.findall(vt.MARK + t.replace(" ", vt.MARK))})[:400]
    for word, raw in zip(words, model.segment(words, "viterbi"), strict=True):
        total, parts = best_sum(word, score, model.unknown)
        want = [i for p in parts for i in ([library.piece_to_id(p)] if p in score else [library.piece_to_id(f"<0x{b:02X}>") for b in p.encode()])]
        got = np.frombuffer(raw, np.int32).tolist()
        assert got == want, word


@pytest.mark.parametrize("way", ["viterbi", "merged"])
def test_texts_read_back(spark, way):
    rows = [(i if i % 5 else None, t, "clash") for i, t in enumerate(texts(60))] + [(3, "again", ""), (3, "again", "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    back = vt.decode_texts(vt.encode_texts(docs, way=way)).collect()
    key = lambda r: (r[0] is not None, r[0], r[1])
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=key) == sorted(((i, t or "") for i, t, _ in rows), key=key)
    assert vt.encode_texts(docs.where("false")).count() == 0


def test_query_counts_and_checks_ids(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r["doc_id"]: library.encode(r["text"]) for r in docs.collect()}
    got = vt.op8_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(want) and all(r["reads_back"] for r in got)
    for r in got:
        ids = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids, np.int32).tobytes())


def test_words_forgotten_and_split_matrices(model, library, monkeypatch):
    monkeypatch.setattr(vt, "REMEMBERED", 2)
    monkeypatch.setattr(vt, "CELLS", 16)
    some = [t for t in texts(40) if t]
    assert [np.frombuffer(x, np.int32).tolist() for x in model.encode(some * 2, "merged")] == library.encode(some * 2)
