"""Operator 10: token-id output with Elias-Fano document boundaries.

Documents are range-partitioned and sorted by ``doc_id``; each task encodes its
run of texts and cuts it into blocks of whole documents. A block is one record
of the store: the concatenated ids (2 bytes each when the vocabulary allows,
else 4), the Elias-Fano coded document ends within the block, and the
Elias-Fano coded document ids. The store is a folder of Parquet files written
by Spark, so it works in any file system Spark can write, commits whole tasks
only, and survives lost executors. The place of a block in the whole
concatenation is its place in its task's run plus the sizes of earlier runs
(one number per task).

Cases: a text that spells an added token, such as ``<|endoftext|>``, gets its id, as
the library does by default; a null or empty text is a document with the end id alone; a null
``doc_id`` sorts first and is kept; repeated ids or rows each keep a place,
ordered by a hash of their text; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import string
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.llm import chunks
from feedrank.llm.common import arrow_schema, documents, narrow
from feedrank.llm.elias_fano import EliasFano
from feedrank.session import scratch_dir

BLOCK_IDS = 1 << 18             # a block is closed at so many ids ...
BLOCK_DOCS = 1 << 13            # ... or documents
MEMO_LIMIT = 700_000            # chunks remembered a worker, in each generation
SEQUENCE = "struct<n:int,width:int,low:binary,high:binary,samples:binary>"
BLOCK = (f"run int, before long, n_ids long, id_bytes int, ids binary, ends {SEQUENCE}, "
         f"n_null int, first_id long, doc_ids {SEQUENCE}")
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"

_encoders: dict[str, Callable[[list[str]], Iterator[bytes]]] = {}


def _splits_at_spaces(spec: dict) -> bool:
    """True for tokenizers whose pieces never depend on text beyond a chunk."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or not t["content"]
           or any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", [])):
        return False            # such a token reads or takes signs beyond its own
    return (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and not spec.get("normalizer")
            and model["type"] == "BPE" and not model.get("dropout"))


def encoder_of(raw: bytes) -> Callable[[list[str]], Iterator[bytes]]:
    """texts -> ids of each as little-endian bytes, by the tokenizers library."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # one core a task
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(raw.decode("utf-8"))
        kind = id_type(tok.get_vocab_size())

        def encode(texts: list[str]) -> list[bytes]:
            return [np.array(e.ids, kind).tobytes()
                    for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

        if _splits_at_spaces(json.loads(raw)):
            joined = _JoinedEncoder(tok, kind, encode)
            memo = chunks.Memo(joined, kind, MEMO_LIMIT, lines=True)
            joined.known = memo.known
            _encoders[key] = lambda texts: map(np.ndarray.tobytes, memo.encoded(texts))
        else:
            _encoders[key] = encode
    return _encoders[key]


class _JoinedEncoder:
    """Encodes many chunks in few calls of the library.

    An ASCII word after one space, with or without punctuation after it, is one
    or two pre-tokens: the library's model takes them as they are, each word once,
    and none that ``known`` has without its punctuation (nor such a word of other
    Latin letters). Other chunks that start with one space and end in another sign
    may stand side by side without changing each other's ids. Byte-level tokens
    spell out their bytes, so the ids of the joined text are dealt back by byte length.
    """

    JOIN = 512
    MARKS = string.punctuation

    def __init__(self, tok, kind: str, alone: Callable[[list[str]], list[bytes]]):
        self.tok, self.kind, self.alone = tok, kind, alone
        self.model = tok.model
        self.known: Callable[[str], bytes | None] = lambda chunk: None
        vocab = tok.get_vocab(with_added_tokens=False)
        added = tok.get_added_tokens_decoder()
        top = max([*vocab.values(), *added]) + 1
        self.bytes_of = np.zeros(top, dtype=np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)                  # one sign a byte
        for i, token in added.items():
            self.bytes_of[i] = len(token.content.encode("utf-8"))
        self.id_bytes = [i.tobytes() for i in np.arange(top, dtype=kind)]
        self.space = tok.pre_tokenizer.pre_tokenize_str(" a")[0][0][:-1]
        inside = re.compile(f"[A-Za-z\xaa-\u024f]*[{re.escape(self.MARKS)}]*")
        self.words = not any(inside.fullmatch(t.content) for t in added.values())

    def _piece(self, piece: str) -> bytes:
        return b"".join([self.id_bytes[t.id] for t in self.model.tokenize(piece)])

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        free, other, marks, plain = [], [], {"": b""}, {}
        for i, c in enumerate(texts):
            if len(c) < 2 or c[0] != " " or c[1].isspace() or c[-1].isspace():
                other.append(i)
            elif not self.words or not (word := c.rstrip(self.MARKS)[1:]).isalpha():
                free.append(i)
            elif not c.isascii() and (len(word) == len(c) - 1 or max(word) > "\u024f"
                                      or not (ids := self.known(" " + word))):
                free.append(i)
            else:
                mark = c[len(word) + 1:]
                if not c.isascii():
                    plain[word] = ids
                if mark not in marks:
                    marks[mark] = self._piece(mark)
                ids = plain.get(word)
                if ids is None:
                    ids = self.known(" " + word) if mark else None
                    plain[word] = ids = ids or self._piece(self.space + word)
                out[i] = ids + marks[mark]
        width = np.dtype(self.kind).itemsize
        for k in range(0, len(free), self.JOIN):
            places = free[k:k + self.JOIN]
            part = [texts[i] for i in places]
            ids = np.array(self.tok.encode_batch_fast(
                ["".join(part)], add_special_tokens=False)[0].ids, dtype=self.kind)
            sizes = np.fromiter(map(len, map(str.encode, part)), np.int64, len(part))
            ends = (np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(sizes)) + 1) * width
            raw, at = ids.tobytes(), 0
            for i, end in zip(places, ends.tolist()):
                out[i] = raw[at:end]
                at = end
        for i, ids in zip(other, self.alone([texts[i] for i in other])):
            out[i] = ids
        return out


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class _Block:
    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.ends: list[int] = []
        self.doc_ids: list[int] = []
        self.n_null = 0
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes, width: int) -> None:
        self.parts.append(ids)
        self.size += len(ids) // width
        self.ends.append(self.size)
        if doc_id is None:
            self.n_null += 1
        else:
            self.doc_ids.append(doc_id)

    def row(self, run: int, before: int, width: int) -> dict:
        first = self.doc_ids[0] if self.doc_ids else 0
        ids = np.array([d - first for d in self.doc_ids], dtype=np.uint64)
        return {"run": run, "before": before, "n_ids": self.size, "id_bytes": width,
                "ids": b"".join(self.parts), "ends": vars(EliasFano.encode(self.ends)),
                "n_null": self.n_null, "first_id": first,
                "doc_ids": vars(EliasFano.encode(ids))}


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def write_store(docs: DataFrame, path: str, tokenizer: bytes, end_id: int = 2) -> str:
    """Encode every text, append ``end_id``, write the store to ``path``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer)
    target = arrow_schema(spark, BLOCK)
    from tokenizers import Tokenizer
    kind = id_type(Tokenizer.from_str(tokenizer.decode("utf-8")).get_vocab_size())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, me = encoder_of(shared.value), TaskContext.get().partitionId()
        end, width = np.array([end_id], kind).tobytes(), np.dtype(kind).itemsize
        block, before = _Block(), 0
        for group in chunks.groups(_pairs(batches)):
            for (doc_id, _), ids in zip(group, encode([t for _, t in group])):
                block.add(doc_id, ids + end, width)
                if block.size >= BLOCK_IDS or len(block.ends) >= BLOCK_DOCS:
                    yield pa.RecordBatch.from_pylist([block.row(me, before, width)], target)
                    before += block.size
                    block = _Block()
        if block.ends:
            yield pa.RecordBatch.from_pylist([block.row(me, before, width)], target)

    spread = F.xxhash64("text")
    (narrow(docs).repartitionByRange(F.col("doc_id").asc_nulls_first(), spread)
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), spread)
     .mapInArrow(run, BLOCK)
     .write.option("compression", "zstd").parquet(path))
    return path


def _sequence(x: dict) -> EliasFano:
    return EliasFano(x["n"], x["width"], x["low"], x["high"], x["samples"])


def read_store(spark: SparkSession, path: str,
               per_doc: Callable[[np.ndarray], object], schema: str) -> DataFrame:
    """One row per stored document: doc_id, start, n_tokens and ``per_doc(ids)``.

    ``schema`` names these four columns. Offsets come from the Elias-Fano
    select of each block.
    """
    blocks = spark.read.schema(BLOCK).parquet(path)
    sizes = (blocks.groupBy("run").agg(F.sum("n_ids").alias("n")).orderBy("run")
             .collect())                                # one row per writing task
    base, total = {}, 0
    for r in sizes:
        base[r["run"]] = total
        total += r["n"]
    target = arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield decode(batch.slice(i, 1).to_pylist()[0])

    def decode(b: dict) -> pa.RecordBatch:
        ends = _sequence(b["ends"]).all().astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        ids = np.frombuffer(b["ids"], dtype="<u2" if b["id_bytes"] == 2 else "<u4")
        doc_ids = [None] * b["n_null"] + [
            int(d) + b["first_id"] for d in _sequence(b["doc_ids"]).all()]
        values = [per_doc(ids[s:e]) for s, e in zip(starts, ends)]
        offset = base[b["run"]] + b["before"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in
             zip((doc_ids, starts + offset, ends - starts, values), target)], schema=target)

    return blocks.mapInArrow(run, schema)


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def public_tokenizer(name: str = "byte_bpe_50k.json") -> bytes:
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_store(documents(spark, sf_dir, "doc_id", "text"),
                       scratch_dir(spark, "token-store"), public_tokenizer())
    return read_store(spark, path, crc32_of, RESULT)
