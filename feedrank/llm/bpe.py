"""Operator 7: byte-level BPE encoding and decoding with a rank queue.

Merges of one pre-token are driven by a priority queue over merge ranks: each
rank has a bucket of positions in a doubly linked list of symbols, and a
hierarchical bitmap marks the non-empty buckets. Find-first-set on the top word
and then on one leaf word gives the next rank in constant time. Entries whose
symbols have changed since they were queued are stale and are skipped when they
come up. A pre-token of n bytes costs O(n) queue steps, so pre-tokens of
hundreds of kilobytes are no special case. All new pre-tokens of a group of
texts share one queue, and a bucket is merged at once with array operations.

Cases: a null or empty text has no ids and decodes to no bytes; repeated rows
each give their row; an empty table gives an empty table; special-token strings
are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from feedrank.llm import chunks
from feedrank.llm.common import documents, per_document

LEAF_BITS = 8                   # one leaf word covers 256 ranks
NONE = 1 << 40                  # rank of a pair that never merges
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class RankQueue:
    """Entries by merge rank; ``pop`` returns the lowest rank and its bucket."""

    __slots__ = ("buckets", "leaves", "top")

    def __init__(self) -> None:
        self.buckets: dict[int, list] = {}
        self.leaves: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, entry) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(entry)
            return
        self.buckets[rank] = [entry]
        block = rank >> LEAF_BITS
        self.leaves[block] = self.leaves.get(block, 0) | 1 << (rank & 255)
        self.top |= 1 << block

    def pop(self) -> tuple[int, list]:
        block = (self.top & -self.top).bit_length() - 1
        word = self.leaves[block]
        lowest = word & -word
        self.leaves[block] = word = word ^ lowest
        if not word:
            self.top ^= 1 << block
        rank = block << LEAF_BITS | lowest.bit_length() - 1
        return rank, self.buckets.pop(rank)


class BytePairCodec:
    """Encoder and decoder over ``ranks`` (token bytes -> id = merge rank)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.names = [str(i) for i in range(self.size)]
        # remembered ids are kept as bytes: a quarter of what a tuple of integers takes
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        self.packed = [i.tobytes() for i in np.arange(self.size, dtype=self.kind)]
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.split = regex.compile(pattern).findall
        # ``size`` stands for "no symbol": it is no part of any pair
        pairs = {ranks[a] * (self.size + 1) + ranks[b]: rank for token, rank in ranks.items()
                 for k in range(1, len(token))
                 if (a := token[:k]) in ranks and (b := token[k:]) in ranks}
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs) or [-1], dtype=np.int64)
        self.pair_ranks = np.array([pairs.get(k, NONE) for k in self.pair_keys.tolist()],
                                   dtype=np.int64)
        self.memo = chunks.Memo(self._encode_chunks, self.kind)

    # ------------------------------------------------------------ whole texts

    def encode(self, text: str) -> list[int]:
        return next(self.encoded([text]))

    def encoded(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text; the chunks not met before are merged together."""
        return map(np.ndarray.tolist, self.memo.encoded(texts))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _encode_chunks(self, fresh: list[str]) -> list[bytes]:
        ranks, packed = self.ranks, self.packed
        split = [[p.encode("utf-8") for p in self.split(c)] for c in fresh]
        pieces = sorted({p for row in split for p in row if p not in ranks})
        merged = {p: b"".join(map(packed.__getitem__, ids))
                  for p, ids in zip(pieces, self.merge_all(pieces))}
        return [b"".join([packed[ranks[p]] if p in ranks else merged[p] for p in row])
                for row in split]

    # ----------------------------------------------------------------- merging

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """Merges of many pre-tokens through one queue, a bucket at a time.

        Pre-tokens lie side by side in one array; the lowest rank is the same
        merge wherever it stands, so its whole bucket is applied at once. Only
        when a merge brings up a lower rank beside it does order within a
        pre-token matter beyond that: such pre-tokens are redone by ``merge``.
        """
        if not pieces:
            return []
        size = self.size
        lengths = np.array([len(p) for p in pieces])
        ends = np.cumsum(lengths)
        n = int(ends[-1])
        ids = np.append(self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)], size)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n
        before[ends - lengths] = n
        alive = np.ones(n + 1, dtype=bool)
        alive[n] = False
        current = self._rank(ids[:n], ids[after[:n]])        # of the pair that starts here
        current = np.append(current, NONE)
        queue = RankQueue()
        self._push(queue, np.flatnonzero(current < NONE), current)
        odd: list[np.ndarray] = []
        while queue.top:
            rank, bucket = queue.pop()
            at = bucket[0] if len(bucket) == 1 else np.sort(np.concatenate(bucket))
            at = at[current[at] == rank]                     # others are stale
            if not len(at):
                continue
            if len(at) > 1:
                touching = np.append(False, after[at[:-1]] == at[1:])
                if touching.any():                           # leftmost first: every other one
                    place = np.arange(len(at))
                    run = place - np.maximum.accumulate(np.where(touching, 0, place))
                    at = at[run % 2 == 0]
            j = after[at]
            right = after[j]
            passing = self._rank(np.full(len(at), rank), ids[right])
            ids[at], after[at], before[right] = rank, right, at
            left = before[at]            # itself merged just now where two merges touch
            alive[j], current[j] = False, NONE
            new_right = self._rank(ids[at], ids[right])
            new_left = self._rank(ids[left], ids[at])
            lower = np.minimum(np.minimum(passing, new_right), new_left) < rank
            if lower.any():
                odd.append(at[lower])
            current[left], current[n] = new_left, NONE
            current[at] = new_right
            own = new_left < NONE
            own[1:] &= left[1:] != at[:-1]                   # that pair is counted as a right one
            self._push(queue, np.concatenate([at[new_right < NONE], left[own]]), current)
        live = np.flatnonzero(alive)
        cuts = np.searchsorted(live, ends)
        flat, out, start = ids[live].tolist(), [], 0
        for end in cuts.tolist():
            out.append(flat[start:end])
            start = end
        if odd:
            for k in np.unique(np.searchsorted(ends, np.concatenate(odd), side="right")).tolist():
                out[k] = self.merge(pieces[k])
        return out

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * (self.size + 1) + b
        k = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[k] == key, self.pair_ranks[k], NONE)

    @staticmethod
    def _push(queue: RankQueue, at: np.ndarray, current: np.ndarray) -> None:
        if not len(at):
            return
        ranks = current[at]
        order = np.lexsort((at, ranks))
        at, ranks = at[order], ranks[order]
        first = np.append(0, np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()
        for s, e, rank in zip(first, [*first[1:], len(at)], ranks[first].tolist()):
            queue.push(rank, at[s:e])

    def merge(self, raw: bytes) -> list[int]:
        """Merges of one pre-token in rank order, leftmost first among equal ranks."""
        rank_of, stride, n = self.pairs.get, self.size + 1, len(raw)
        ids = self.byte_ids[np.frombuffer(raw, dtype=np.uint8)].tolist()
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue = RankQueue()
        push = queue.push
        for i in range(n - 1):
            rank = rank_of(ids[i] * stride + ids[i + 1])
            if rank is not None:
                push(rank, i)
        while queue.top:
            rank, bucket = queue.pop()
            bucket.sort()
            for k, i in enumerate(bucket):
                left = ids[i]
                j = after[i]
                if left < 0 or j >= n or rank_of(left * stride + ids[j]) != rank:
                    continue                                   # stale entry
                ids[i], ids[j] = rank, -1
                after[i] = j = after[j]
                lower = False
                if j < n:
                    before[j] = i
                    new = rank_of(rank * stride + ids[j])
                    if new is not None:
                        push(new, i)
                        lower = new < rank
                h = before[i]
                if h >= 0:
                    new = rank_of(ids[h] * stride + rank)
                    if new is not None:
                        push(new, h)
                        lower = lower or new < rank
                if lower:        # a lower rank has come up: it goes first
                    for later in bucket[k + 1:]:
                        push(rank, later)
                    break
        return [x for x in ids if x >= 0]


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    return {base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in raw.splitlines() if line)}


_codecs: dict[tuple[str, str], BytePairCodec] = {}


def codec_of(raw: bytes, pattern: str) -> BytePairCodec:
    """One codec (and its memo) per Python worker and vocabulary."""
    key = (hashlib.sha256(raw).hexdigest(), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = BytePairCodec(read_ranks(raw), pattern)
    return _codecs[key]


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[bytes, str]:
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int), ``decoded`` (binary) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)   # size of the vocabulary

    def rows(pairs: Iterator[tuple]) -> Iterator[tuple]:
        codec = codec_of(shared.value, pattern)
        for group in chunks.groups(pairs):
            for (doc_id, _), ids in zip(group, codec.encoded([t for _, t in group])):
                yield doc_id, ids, codec.decode(ids)

    return per_document(docs, "doc_id long, ids array<int>, decoded binary", rows)


def digest_documents(docs: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """Count, id digest and round-trip digest per text, without shipping the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def rows(pairs: Iterator[tuple]) -> Iterator[tuple]:
        codec = codec_of(shared.value, pattern)
        for group in chunks.groups(pairs):
            for (doc_id, _), ids in zip(group, codec.encoded([t for _, t in group])):
                listed = ",".join([codec.names[i] for i in ids])
                yield (doc_id, len(ids), hashlib.sha256(listed.encode()).hexdigest(),
                       hashlib.sha256(codec.decode(ids)).hexdigest())

    return per_document(docs, RESULT, rows)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(documents(spark, sf_dir, "doc_id", "text"), *public_vocabulary())
