"""Operator 9: greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie over bytes. Each node has a failure link and the number
of pieces that following it gives off: when no child fits the next byte, the
automaton adds that number and continues at the link, so every byte is read
once and no piece is ever built. Entries with an end-of-word mark fit only at
the end of a word, the others only before it: at the end of a word the state
reached tells the number of pieces of what is left (worked out once a state).
The result equals taking the longest fitting entry at each place, left to right.

Words are runs without ASCII white space, lower-cased. A word with a place where
no entry fits counts as one piece, as an unknown word.

Cases: null and empty texts have no words and no pieces; very long words are
read byte by byte and not remembered; where an entry is there with and without
mark, each counts at its place; repeated rows each get their row; an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

from feedrank.llm.common import documents, per_document

RESULT = "doc_id long, n_words long, n_tokens long"
MEMO_LIMIT = 500_000
LONGEST_MEMO_WORD = 64
STUCK = -1


class LongestMatch:
    """Failure automaton over non-empty byte strings: ``vocabulary`` for places
    before the end of a word, ``endings`` for its end (by default the same)."""

    def __init__(self, vocabulary: Iterable[bytes], endings: Iterable[bytes] | None = None):
        self.child: list[dict[int, int]] = [{}]
        self.above: list[tuple[int, int]] = [(0, 0)]        # parent, byte
        final = [False]

        def node_of(entry: bytes) -> int:
            node = 0
            for b in entry:
                nxt = self.child[node].get(b)
                if nxt is None:
                    nxt = self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.above.append((node, b))
                    final.append(False)
                node = nxt
            return node

        inner = [node_of(entry) for entry in vocabulary if entry]
        last = inner if endings is None else [node_of(entry) for entry in endings if entry]
        for node in inner:
            final[node] = True
        self.final = final
        self.left = {node: 1 for node in last}      # state at the end -> pieces left
        self.fail = [STUCK] * len(self.child)
        self.popped = [0] * len(self.child)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for b, v in self.child[u].items():
                queue.append(v)
                if final[v]:
                    self.fail[v], self.popped[v] = 0, 1
                    continue
                z, count = self.fail[u], self.popped[u]
                while z != STUCK and b not in self.child[z]:
                    count += self.popped[z]
                    z = self.fail[z]
                if z != STUCK:
                    self.fail[v], self.popped[v] = self.child[z][b], count
        self.memo: dict[bytes, int] = {}

    def length(self, word: bytes) -> int:
        """Number of pieces of a word; 1 for an unknown one, 0 for an empty one."""
        n = self._ended(word) if word else 0
        return 1 if n == STUCK else n

    def _pieces_left(self, node: int) -> int:
        """Pieces of a state's bytes at the end of a word, where they are no ending:
        the longest shorter entry, then the rest. As long as an entry at most."""
        rest = bytearray()
        while node:
            node, b = self.above[node]
            rest.append(b)
            if self.final[node]:
                n = self._ended(bytes(reversed(rest)))
                return STUCK if n == STUCK else n + 1
        return STUCK

    def _ended(self, word: bytes) -> int:
        """Number of pieces of a non-empty word, STUCK for an unknown one."""
        child, fail, popped = self.child, self.fail, self.popped
        node = count = 0
        for b in word:
            nxt = child[node].get(b)
            while nxt is None:
                count += popped[node]
                node = fail[node]
                if node == STUCK:
                    return STUCK
                nxt = child[node].get(b)
            node = nxt
        left = self.left.get(node)
        if left is None:
            left = self.left[node] = self._pieces_left(node)
        return STUCK if left == STUCK else count + left

    def lengths(self, words: list[bytes]) -> int:
        """Sum over words, repeated ones looked up in a bounded memo."""
        memo, total = self.memo, 0
        for w in words:
            n = memo.get(w)
            if n is None:
                n = self.length(w)
                if len(w) <= LONGEST_MEMO_WORD:
                    if len(memo) >= MEMO_LIMIT:
                        memo.clear()
                    memo[w] = n
            total += n
        return total


def byte_alphabet() -> dict[str, int]:
    """Characters by which byte-level vocabulary files write bytes (public rule:
    printable Latin-1 signs stand for themselves, the others from U+0100 on)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def word_pieces(tokenizer: bytes) -> tuple[list[bytes], list[bytes]]:
    """Byte strings of a tokenizer file's entries without and with end-of-word mark.

    A file that knows no such mark has entries for any place: both lists hold all.
    """
    spec = json.loads(tokenizer)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    alphabet, mark = byte_alphabet(), spec["model"].get("end_of_word_suffix") or ""
    entries = [e for e in spec["model"]["vocab"] if e not in special and e != mark]

    def raw(texts: Iterable[str]) -> list[bytes]:
        return sorted(bytes(alphabet[c] for c in e) for e in texts)

    if not mark:
        return raw(entries), raw(entries)
    return (raw(e for e in entries if not e.endswith(mark)),
            raw(e.removesuffix(mark) for e in entries if e.endswith(mark)))


_automata: dict[str, LongestMatch] = {}


def automaton_of(tokenizer: bytes) -> LongestMatch:
    key = hashlib.sha256(tokenizer).hexdigest()
    if key not in _automata:
        _automata.clear()
        _automata[key] = LongestMatch(*word_pieces(tokenizer))
    return _automata[key]


def count_tokens(docs: DataFrame, tokenizer: bytes) -> DataFrame:
    """Words and greedy word pieces of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def rows(pairs: Iterator[tuple]) -> Iterator[tuple]:
        automaton = automaton_of(shared.value)
        for doc_id, text in pairs:
            words = (text or "").lower().encode("utf-8").split()
            yield doc_id, len(words), automaton.lengths(words)

    return per_document(docs, RESULT, rows)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        return count_tokens(documents(spark, sf_dir, "doc_id", "text"), f.read())
