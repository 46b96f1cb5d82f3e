"""SentencePiece encoding and decoding in numpy, a batch of words at a time.

A text's spaces become the model's space mark, and it falls into words before each run of marks, since
no piece goes on past one. Each distinct word is segmented once. Words of the same length form a
matrix and advance together: prefix hashes give the hash of any substring of all of them,
a search in the sorted hashes of the pieces gives score and id, and a vectorised maximum over the
last piece's length fills the next column of best scores and of backpointers. Characters without
a piece cost ten below the worst score and become byte pieces.

The largest sum of scores is what unigram models mean by an encoding. Models of merges
(the public one here is such) put pieces together pair by pair instead, best pair first, which no sum of scores
reproduces; ``merged`` does that on the same matrices, with the maximum taken over neighbouring
pairs, and gives the ids of the ``sentencepiece`` library. Both decode to the same text.

Defined cases: a null or empty text has no ids; rows are encoded by themselves, whatever their doc_id; the
space mark itself in a text reads back as a space, as in the library; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.shared import documents
from siltworks.llm.tokens import powers, vocabulary

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Words remembered by one Python worker for each way of segmenting.
REMEMBERED = 400_000
#: Texts whose words are segmented together, and cells of a matrix of words.
TEXTS, CELLS = 512, 1 << 18

_WORD = re.compile(f"{MARK}+[^{MARK}]*")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_NEVER = -1e18


class Pieces:
    """A model's pieces: sorted hashes of their text, with score and id, and how to read ids back."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        names = [model.id_to_piece(i) for i in plain]
        if any(re.search(f"[^{MARK}]{MARK}", x) for x in names):
            raise ValueError("a piece goes on past a space")
        self.longest = max(map(len, names))
        self.powers = powers(_BASE, 1 << 16)
        hashes = np.array([self._hash(x) for x in names], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(plain, np.int32)[order]
        self.scores = np.array([model.get_score(i) for i in plain], np.float64)[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << 20, bool)  # by the first bits of the hash: spares most searches
        self.maybe[self.hashes >> np.uint64(44)] = True
        self.unknown = self.scores[self.scores > -1e8].min() - 10
        self.byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.bytes_of = [b""] * n
        for i in range(n):
            if model.is_byte(i):
                self.bytes_of[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.bytes_of[i] = model.id_to_piece(i).replace(MARK, " ").encode()
        self.seen: dict[str, dict[str, bytes]] = {"viterbi": {}, "merged": {}}

    def _hash(self, text: str) -> np.uint64:
        codes = np.array([*map(ord, text)], np.uint64) + np.uint64(1)
        return np.multiply(np.sum(codes * self.powers[: len(codes)][::-1], keepdims=True, dtype=np.uint64), _MIX)[0]

    def prefixes(self, codes: np.ndarray) -> np.ndarray:
        """Hash of each word's first characters: a column more than there are characters."""
        out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
        for j in range(codes.shape[1]):
            out[:, j + 1] = out[:, j] * _BASE + codes[:, j] + np.uint64(1)
        return out

    def probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of substrings by their (unmixed) hashes; _NEVER where there is no such piece."""
        mixed = hashes * _MIX
        scores, ids = np.full(len(mixed), _NEVER), np.full(len(mixed), -1, np.int32)
        at = np.flatnonzero(self.maybe[mixed >> np.uint64(44)])
        found = np.minimum(np.searchsorted(self.hashes, mixed[at]), len(self.hashes) - 1)
        there = self.hashes[found] == mixed[at]
        at, found = at[there], found[there]
        scores[at], ids[at] = self.scores[found], self.ids[found]
        return scores, ids

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words as rows: whether a piece begins at each character, and its id (-1: to be spelled in bytes)."""
        n, width = codes.shape
        prefix = self.prefixes(codes)
        best = np.full((n, width + 1), _NEVER)
        best[:, 0] = 0
        back, ids = np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)
        for j in range(1, width + 1):
            for size in range(1, min(self.longest, j) + 1):  # of equal sums, the longest last piece stays
                score, piece = self.probe(prefix[:, j] - prefix[:, j - size] * self.powers[size])
                if size == 1:
                    score = np.where(piece < 0, self.unknown, score)
                total = best[:, j - size] + score
                better = (total >= best[:, j]) & (score > _NEVER)
                best[better, j], back[better, j], ids[better, j] = total[better], size, piece[better]
        begins, found = np.zeros((n, width), bool), np.full((n, width), -1, np.int32)
        at, row = np.full(n, width), np.arange(n)
        while len(row):
            start = at - back[row, at]
            begins[row, start], found[row, start] = True, ids[row, at]
            row, at = row[start > 0], start[start > 0]
        return begins, found

    def merged(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same by merging neighbours, the pair with the best score first and the leftmost of equals."""
        n, width = codes.shape
        prefix = self.prefixes(codes)
        place = np.arange(width)
        end = np.tile(place + 1, (n, 1))  # of the symbol that begins at a place; 0 where none does
        pair = np.full((n, width), _NEVER)  # score of merging the symbol with the next one

        def weigh(row: np.ndarray, at: np.ndarray) -> None:
            middle = end[row, at]
            inside = middle < width
            pair[row[~inside], at[~inside]] = _NEVER
            row, at, middle = row[inside], at[inside], middle[inside]
            stop = end[row, middle]
            pair[row, at] = self.probe(prefix[row, stop] - prefix[row, at] * self.powers[stop - at])[0]

        weigh(np.repeat(np.arange(n), width), np.tile(place, n))
        row = np.arange(n)
        while len(row):
            at = pair[row].argmax(axis=1)
            going = pair[row, at] > _NEVER
            row, at = row[going], at[going]
            gone = end[row, at]
            end[row, at] = end[row, gone]
            end[row, gone], pair[row, gone] = 0, _NEVER
            weigh(row, at)
            before = np.where((end[row] == at[:, None]) & (end[row] > 0), place, -1).max(axis=1)
            has = before >= 0
            weigh(row[has], before[has])
        begins, found = end > 0, np.full((n, width), -1, np.int32)
        row, at = np.nonzero(begins)
        found[row, at] = self.probe(prefix[row, end[row, at]] - prefix[row, at] * self.powers[end[row, at] - at])[1]
        return begins, found

    def segment(self, words: list[str], way: str) -> list[bytes]:
        """Ids of words, as bytes of 32-bit numbers; words of the same length advance together."""
        run: Callable = getattr(self, way)
        out = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, members in by_length.items():
            share = max(1, CELLS // length)
            for low in range(0, len(members), share):
                part = members[low : low + share]
                raw = "".join([words[i] for i in part]).encode("utf-32-le", "surrogatepass")
                codes = np.frombuffer(raw, "<u4").reshape(len(part), length).astype(np.uint64)
                begins, found = run(codes)
                row, at = np.nonzero(begins)
                ids = found[row, at]
                bounds = (np.concatenate([[0], np.cumsum(begins.sum(axis=1))]) * 4).tolist()
                raw = ids.tobytes()
                for k, i in enumerate(part):
                    out[i] = raw[bounds[k] : bounds[k + 1]]
                for k in np.unique(row[ids < 0]).tolist():
                    out[part[k]] = self._spelled(words[part[k]], at[row == k], ids[row == k])
        return out

    def _spelled(self, word: str, at: np.ndarray, ids: np.ndarray) -> bytes:
        """Ids of a word with the bytes of its characters that have no piece."""
        parts = [[x] if x >= 0 else self.byte[list(word[a].encode())] for a, x in zip(at.tolist(), ids.tolist(), strict=True)]
        return np.concatenate(parts).astype(np.int32).tobytes()

    def encode(self, texts: list[str | None], way: str) -> list[bytes]:
        """Ids of whole texts."""
        out = []
        for low in range(0, len(texts), TEXTS):
            seen = self.seen[way]
            if len(seen) > REMEMBERED:
                seen.clear()
            cut = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts[low : low + TEXTS]]
            missing = list({w for words in cut for w in words if w not in seen})
            found = dict(zip(missing, self.segment(missing, way), strict=True))
            seen.update((w, ids) for w, ids in found.items() if len(w) <= 64)
            out += [b"".join([seen[w] if w in seen else found[w] for w in words]) for words in cut]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; the first space, which stands for none, goes."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The worker's model: the file is read once per Python process."""
    return Pieces(path)


def encode_texts(docs: DataFrame, path: str | None = None, way: str = "merged") -> DataFrame:
    """doc_id, ids of every document."""
    path = path or vocabulary(MODEL)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pieces(path).encode(batch.column(1).to_pylist(), way)
            bounds = np.concatenate([[0], np.cumsum([len(x) >> 2 for x in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join(found), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, ids array<int>")


def decode_texts(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of rows of ids."""
    path = path or vocabulary(MODEL)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [pieces(path).decode(x.values.to_numpy()) if x.is_valid else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(work, "doc_id long, text string")


def encoding_digest(docs: DataFrame, path: str | None = None, way: str = "merged") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of 32-bit ids), reads_back (the ids decode to the text) of every document."""
    path = path or vocabulary(MODEL)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = model.encode(texts, way)
            same = [model.decode(np.frombuffer(x, np.int32)) == (t or "").replace(MARK, " ") for x, t in zip(found, texts, strict=True)]
            columns = [batch.column(0), pa.array([len(x) >> 2 for x in found], pa.int64()), pa.array([zlib.crc32(x) for x in found], pa.int64()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_crc32", "reads_back"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_tokens long, ids_crc32 long, reads_back boolean")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The model here is one of merges.
    return encoding_digest(documents(spark, sf_dir))


QUERIES = {"op8_sentencepiece": (op8_sentencepiece, None)}
