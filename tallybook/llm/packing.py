"""Lexical retrieval packing.

1. Texts become token ids, once, and are written with a similarity key (smallest hash of id trigrams, then a hash of doc_id).
2. Rows move once, range-partitioned by that key, so that texts with common passages come near each other while a large group
   of copies still spreads over tasks. Each task streams its sorted rows in blocks of about ``BLOCK_TOKENS`` ids; a block is
   one shard of the index, so memory does not depend on the input.
3. A shard has a BM25 inverted index over ids. The document that a window starts with is the seed: its strongest terms query the
   index, and the unused neighbours fill the window in order of score. A document that does not fit is cut; its rest starts the
   next window and becomes its seed. Without neighbours the next unused document follows. Only the last sequence of a task can
   be short, and is padded up to the window.

Defined results: a null or empty text has the end id alone; null doc_ids are carried along; repeated rows are packed each;
further columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, map_stream, table
from .registry import query

WINDOW, END_ID = 2048, 1
BLOCK_TOKENS = 2_000_000
#: Terms of a seed that query the index, and neighbours taken from one query.
QUERY_TERMS, NEIGHBOURS = 16, 16
K1, B = 1.2, 0.75

# the split of byte-level BPE, for texts of the characters in _PLAIN; any other text goes to the tokenizer whole
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r"\t\n\r "
_SPLIT = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_OTHER = re.compile(r"[^\t\n\r -~¡-ɏ‐-‧]|<\|")


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


def _word_encoder(path: str):
    """A quick encoder of single words over the same vocabulary, or None if its merges are not in the order of ids."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    if model.get("type") != "BPE":
        return None
    vocab, byte = model["vocab"], _byte_of()
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if any(c not in vocab for c in byte) or merged != sorted(x for x in merged if x is not None):
        return None
    known = set(merged) | {vocab[c] for c in byte}
    ranks = {bytes(byte[c] for c in w): i for w, i in vocab.items() if i in known}
    return tiktoken.Encoding("words", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder(dict):
    """Ids of split words as packed bytes, remembered up to a bound."""

    def __init__(self, path: str, code: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer, self.code = Tokenizer.from_file(path), code
        self.word = _word_encoder(path) or (lambda w: self.tokenizer.encode(w, add_special_tokens=False).ids)

    def __missing__(self, word: str) -> bytes:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = got = np.array(self.word(word), self.code).tobytes()
        return got

    def ids(self, text: str | None, end: bytes) -> bytes:
        if not text:
            return end
        if _OTHER.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.code).tobytes() + end
        return b"".join(map(self.__getitem__, _SPLIT.findall(text))) + end


def similarity_key(ids: np.ndarray, doc_id: int | None) -> int:
    """Smallest 32-bit hash of id trigrams in the high bits, a hash of the id in the low ones."""
    x = ids.astype(np.uint64)
    n = max(1, len(x) - 2)
    h = x[:n] * np.uint64(0x9E3779B97F4A7C15)
    for k, c in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        if len(x) > k:
            h = h[: len(x) - k] + x[k : k + len(h)] * np.uint64(c)
    h ^= h >> np.uint64(29)
    low = int((h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).min())
    return low << 31 | xxhash.xxh32_intdigest(str(doc_id)) >> 1


def tokenized(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """(doc_id, key, n, ids): ids packed as little-endian unsigned integers of ``width(path)`` bytes."""
    code = _code(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path, code)
        end = np.array([end_id], code).tobytes()
        for b in batches:
            ids = [enc.ids(t, end) for t in b.column(1).to_pylist()]
            keys = [similarity_key(np.frombuffer(x, code), d) for d, x in zip(b.column(0).to_pylist(), ids, strict=True)]
            n = [len(x) // int(code[-1]) for x in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "key", "n", "ids"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_stream(rows, encode, "doc_id bigint, key bigint, n bigint, ids binary")


def _code(path: str) -> str:
    """Two bytes an id if the vocabulary allows it."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


class Shard:
    """BM25 index of one block of documents."""

    def __init__(self, docs: list[np.ndarray]):
        terms, tfs, owners = [], [], []
        for k, ids in enumerate(docs):
            s = np.sort(ids, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
            terms.append(s[first])
            tfs.append(np.diff(np.append(first, len(s))))
            owners.append(np.full(len(first), k, np.int32))
        term, tf, owner = np.concatenate(terms), np.concatenate(tfs).astype(np.float32), np.concatenate(owners)
        size = np.array([len(d) for d in docs], np.float32)
        df = np.bincount(term)
        self.idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5)).astype(np.float32)
        self.weight = self.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * (size / size.mean())[owner]))
        self.query_weight = self.idf[term] * tf
        self.own = np.concatenate(([0], np.cumsum([len(t) for t in terms])))
        self.term = term
        order = np.argsort(term, kind="stable")
        self.posting, self.posting_weight = owner[order], self.weight[order]
        self.start = np.concatenate(([0], np.cumsum(df)))
        self.used = np.zeros(len(docs), bool)

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused documents by descending score for the strongest terms of ``seed``."""
        a, b = self.own[seed], self.own[seed + 1]
        q = self.query_weight[a:b]
        top = np.argpartition(q, -QUERY_TERMS)[-QUERY_TERMS:] if len(q) > QUERY_TERMS else np.arange(len(q))
        score = np.zeros(len(self.used), np.float32)
        for t in self.term[a:b][top].tolist():
            x, y = self.start[t], self.start[t + 1]
            score[self.posting[x:y]] += self.posting_weight[x:y]  # a document stands once in a posting list
        score[self.used] = 0
        k = min(NEIGHBOURS, len(score))
        best = np.argpartition(score, -k)[-k:]
        best = best[score[best] > 0]
        return best[np.lexsort((best, -score[best]))]


class Packer:
    """Fills windows of one task; ``pieces`` are (doc, start, length, sequence, offset, ids)."""

    def __init__(self, window: int, first: int):
        self.window, self.sequence, self.filled, self.pieces = window, first, 0, []

    def add(self, doc: int, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.window - self.filled)
            self.pieces.append((doc, at, n, self.sequence, self.filled, ids[at : at + n]))
            at += n
            self.filled += n
            if self.filled == self.window:
                self.sequence, self.filled = self.sequence + 1, 0

    def pack(self, docs: list[np.ndarray]) -> None:
        shard = Shard(docs)
        nearby: list[int] = []
        free = 0
        for _ in docs:
            while nearby and shard.used[nearby[-1]]:
                nearby.pop()
            if nearby:
                k = nearby.pop()
            else:
                while shard.used[free]:
                    free += 1
                k = free
            shard.used[k] = True
            sequence, fresh = self.sequence, self.filled == 0
            self.add(k, docs[k])
            if self.filled and (fresh or self.sequence != sequence or not nearby):
                # this document starts the open window (whole or with its rest), or the last seed has no neighbours left
                nearby = shard.neighbours(k).tolist()[::-1]
            elif not self.filled:
                nearby = []


def pack(
    docs: DataFrame, path: str, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID,
) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids): ids as little-endian unsigned 32-bit integers."""
    code = _code(path)
    rows = cut(tokenized(docs, path, doc_id, text, end_id))
    total = rows.agg(F.sum("n")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (2 * BLOCK_TOKENS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << 36)
        names, ids, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            packer.pack(ids)
            pieces, packer.pieces = packer.pieces, []
            for i in range(0, len(pieces), 1000):
                doc, start, n, seq, off, body = zip(*pieces[i : i + 1000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[d] for d in doc], pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                     pa.array([len(ids[d]) for d in doc], pa.int64()), pa.array(seq, pa.int64()), pa.array(off, pa.int64()),
                     pa.array([x.astype("<u4").tobytes() for x in body], pa.binary())],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for b in batches:
            for name, body in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist(), strict=True):
                names.append(name)
                ids.append(np.frombuffer(body, code))
                size += len(ids[-1])
                if size >= BLOCK_TOKENS:
                    yield from flush()
                    names, ids, size = [], [], 0
        if ids:
            yield from flush()

    placed = rows.repartitionByRange(parts, "key").sortWithinPartitions("key", "doc_id", "n").select("doc_id", "ids")
    return map_stream(placed, run, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op5_pack")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), default_tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
