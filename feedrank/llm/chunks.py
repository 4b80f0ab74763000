"""Splitting text for byte-level BPE, with a bounded per-worker memo.

The pre-token pattern never joins a non-space with a following space, and a
single space always goes with the word after it. A text may therefore be cut
before a space unless white space stands on both sides of it. The pieces
between two cuts ("chunks") encode independently of each other, so their ids
are remembered: running text repeats most of its words. The memo is bounded and
never changes a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Signs with the Unicode White_Space property (and the few more that Python counts).
WHITE_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace()]
SPACE_PAIRS = [c + " " for c in WHITE_SPACE]
LINE_PAIRS = [c + "\n" for c in WHITE_SPACE]
MEMO_LIMIT = 250_000
GROUP_CHARS = 1 << 22           # texts encoded together hold about so many characters
LONGEST_MEMO_CHUNK = 64


def _has(pairs: list[str], text: str) -> bool:
    return any(pair[0] in text and pair in text for pair in pairs)


def _plain(text: str) -> bool:
    """True if there is no white space before a space (nor the mark of a cut)."""
    return "\0" not in text and not _has(SPACE_PAIRS, text)


def chunks(text: str) -> list[str]:
    """Cut ``text`` at spaces where that is safe; the chunks join to ``text``.

    >>> chunks("a b  c")
    ['a', ' b  c']
    """
    if _plain(text):
        parts = text.replace(" ", "\0 ").split("\0")
        return parts if parts[0] else parts[1:]
    parts = text.split(" ")
    out, held = [], parts[0]
    for part in parts[1:]:
        before_space = not held or held[-1].isspace()
        after_space = not part or part[0].isspace()
        if before_space or after_space:      # leave white space runs in one chunk
            held += " " + part
        else:
            out.append(held)
            held = " " + part
    if held:
        out.append(held)
    return out


def _cut(texts: list[str], lines: bool) -> tuple[list[int], pa.Array, np.ndarray]:
    """Order in which texts were cut, all their chunks, how many each has; "" may be one.

    ``lines``: also before a line feed, where no white space stands before any.
    """
    spaces, both, other = [], [], []
    for i, text in enumerate(texts):
        if not _plain(text):
            other.append(i)
        elif lines and "\n" in text and not _has(LINE_PAIRS, text):
            both.append(i)
        else:
            spaces.append(i)
    marked = pc.replace_substring(pa.array([texts[i] for i in both + spaces], pa.large_string()),
                                  " ", "\0 ")
    marked = pa.concat_arrays([pc.replace_substring(marked[:len(both)], "\n", "\0\n"),
                               marked[len(both):]])
    parts = pc.split_pattern(marked, "\0")
    rest = [chunks(texts[i]) for i in other]
    flat = pa.concat_arrays([parts.flatten(),
                             pa.array([c for row in rest for c in row], pa.large_string())])
    sizes = np.concatenate([pc.list_value_length(parts).to_numpy(zero_copy_only=False),
                            np.array([len(row) for row in rest], dtype=np.int64)])
    return both + spaces + other, flat, sizes.astype(np.int64)


class Memo:
    """chunk -> its ids as bytes of type ``kind``, in two generations of about ``limit`` chunks.

    ``encoded`` handles a group of texts: each distinct chunk is looked up once,
    those not met before are encoded together, and the ids are put together with
    array operations. When the younger generation is full it becomes the older one,
    which is dropped; a chunk met in the older one moves to the younger. Chunks
    of unusual length are forgotten after their group. ``lines``: no pre-token
    that begins before a line feed holds it, so texts may be cut there, too.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], kind: str,
                 limit: int = MEMO_LIMIT, lines: bool = False):
        self.encode, self.kind, self.limit, self.lines = encode, kind, limit, lines
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.unusual: list[str] = []

    def _trim(self) -> None:
        for c in self.unusual:
            del self.young[c]
        self.unusual = []
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}

    def known(self, chunk: str) -> bytes | None:
        """The remembered ids of a chunk."""
        found = self.young.get(chunk)
        return self.old.get(chunk) if found is None else found

    def _values(self, distinct: list[str]) -> list[bytes]:
        self._trim()
        young, old = self.young, self.old
        values = list(map(young.get, distinct))
        places = [i for i, value in enumerate(values) if value is None]
        missing = []
        for i in places:
            c = distinct[i]
            if c in old:
                young[c] = old[c]
            else:
                missing.append(c)
        young.update(zip(missing, self.encode(missing)))
        self.unusual = [c for c in missing if len(c) > LONGEST_MEMO_CHUNK]
        for i in places:
            values[i] = young[distinct[i]]
        return values

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        order, flat, sizes = _cut(texts, self.lines)
        coded = flat.dictionary_encode()
        values = self._values(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(values), dtype=self.kind)
        length = np.fromiter(map(len, values), np.int64, len(values)) // ids.itemsize
        first = np.cumsum(length) - length
        at = coded.indices.to_numpy(zero_copy_only=False)
        n = length[at]
        ends = np.append(0, np.cumsum(n))               # where chunks end among all ids
        ids = ids[np.repeat(first[at] - ends[:-1], n) + np.arange(ends[-1])]
        out: list[np.ndarray] = [ids] * len(texts)
        cuts = ends[np.append(0, np.cumsum(sizes))].tolist()
        for i, start, end in zip(order, cuts, cuts[1:]):
            out[i] = ids[start:end]
        return out


def groups(pairs: Iterator[tuple], size: int = GROUP_CHARS) -> Iterator[list[tuple]]:
    """(key, text) pairs in runs of about ``size`` characters; a null text is empty."""
    held, chars = [], 0
    for key, text in pairs:
        held.append((key, text or ""))
        chars += len(text or "") + 64
        if chars >= size:
            yield held
            held, chars = [], 0
    if held:
        yield held
