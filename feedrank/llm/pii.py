"""Operator 1: personal data by patterns and a skip-chain random field.

Base spans come from four patterns (email, ip, card, phone) with their checks.
The field then looks at every token that could be personal data (it holds a
digit or an at sign): label O or one of the four kinds. Adjacent number tokens
are one token of the field where together they are a base span, have the digits
of a base card or phone elsewhere in the text, or repeat another whole run. Node potentials are a
softmax over shape and context features; a chain factor joins tokens that are
neighbours in the text; a skip factor joins all tokens of a document with the
same key (letters and digits only, lower case; for emails also the part before
the at sign; for phones also the digits after the country code), so spaced,
hyphenated and plain forms of a number are linked. Distant repeats so share their potentials: a number that is a card
in one place is one in the others, also where a pattern missed it. The factors
of one key form a star around a hidden label, so n repeats cost n messages. Loopy
message passing runs over all documents of a batch at once; tokens inside base
spans are clamped to their kind. A token whose marginal for a kind reaches
``CONFIDENCE`` adds a span; base spans always stay.

Potentials are learned from the base spans themselves (tokens inside a span have
its kind, others O) on at most ``TRAIN_DOCS`` distinct texts in hash order. A token
that passes a pattern's checks alone, but lies in a longer match that failed
them, is left out of training: it is neither. Each training text also counts a
second time with its cards and addresses spoilt (wrong check digit, a part above
255), so that look-alikes are seen as O.

Cases: null and empty texts have no spans; repeated rows each get their row; a
corpus without base spans trains a field that adds nothing; offsets are code
points, the end exclusive; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.llm.common import arrow_schema, documents, narrow, per_batch, per_document

TRAIN_DOCS = 4_000
TRAIN_TOKENS = 200              # candidate tokens taken from a training text
CONFIDENCE = 0.9
ROUNDS = 8                      # of message passing
SKIP_STRENGTH = 4.0             # log-potential of two equal labels on a skip edge
KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)         # label 0 is O

# The patterns of the base spans.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

HAS_CANDIDATE = re.compile(r"[0-9@]")
NUMBER = re.compile(r"\+?[0-9]+([().-]+[0-9]+)*")
BETWEEN = re.compile(r"[\x20\x09-\x0D()]+")     # between the tokens of one number
LEAST_DIGITS, MOST_DIGITS = 9, 19               # of a number over several tokens
LEAST_SUFFIX = 7                                # digits of a phone without its country code
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = ".,;:!?\"'()[]{}<>#*$%&|="
Span = tuple[int, int, int]     # kind, start, end


# ---------------------------------------------------------------- base spans

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, found from each at sign in linear time."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
            at = text.find("@", free)
        else:
            # a failed run cannot serve a later at sign: it holds none
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """All checked pattern matches, by kind as listed and then by start."""
    if not HAS_CANDIDATE.search(text):
        return []
    found: list[Span] = [(0, s, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(int(p) <= 255 if len(p) < 9 else not p.lstrip("0") or int(p[-9:]) <= 255
               and not p[:-9].strip("0") for p in m.group().split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((3, *m.span()))
    return found


# -------------------------------------------------------------------- tokens

@dataclass
class Tokens:
    """Candidate tokens of one document in text order."""

    spans: list[tuple[int, int]]
    features: list[list[int]]       # indices of active features
    keys: list[list[str]]
    fixed: list[int]                # label of the base span around a token, else -1
    linked: list[bool]              # next candidate is the next token of the text
    alone: list[int]                # label that the patterns give the token alone, else 0


FEATURE_SPACE = 1 << 12


def _feature(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=4).digest(),
                          "little") % FEATURE_SPACE


_memo: dict[tuple, int] = {}


def feature(*parts: object) -> int:
    if parts not in _memo:
        if len(_memo) > 100_000:
            _memo.clear()
        _memo[parts] = _feature(*parts)
    return _memo[parts]


def shape(token: str) -> str:
    """Letters to a, digits to 9, runs shortened to one sign."""
    coarse = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", token))
    return coarse[:24]


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def known_numbers(text: str, base: list[Span]) -> dict[str, tuple[str, ...]]:
    """Digits -> keys of each base card and phone.

    Phones are known also without their country code, plain and after a trunk
    zero; their last nine and seven digits are keys too.
    """
    known: dict[str, tuple[str, ...]] = {}
    for kind, start, end in base:
        digits = digits_of(text[start:end])
        if kind == 2:
            known.setdefault(digits, (digits,))
        elif kind == 3:
            keys = (digits, "~" + digits[-9:], "~" + digits[-LEAST_SUFFIX:])
            known[digits] = keys
            for k in range(1, 4):
                if len(digits) - k >= LEAST_SUFFIX:
                    known.setdefault(digits[k:], keys)
                    known.setdefault("0" + digits[k:], keys)
    return known


@dataclass
class Piece:
    """A candidate: one token, or adjacent number tokens that are one number."""

    first: int                      # token numbers
    last: int
    start: int
    end: int
    word: str
    previous: str
    kind: int                       # label of the base span around it, else -1
    key: str                        # digits of that span if it is a card or phone


def pieces(text: str, base: list[Span], known: dict[str, tuple[str, ...]]) -> list[Piece]:
    by_start = sorted((s, e, kind) for kind, s, e in base)
    at, previous = 0, ""
    tokens: list[Piece] = []
    for number, m in enumerate(TOKEN.finditer(text)):
        word = m.group()
        if HAS_CANDIDATE.search(word):
            core = word.strip(EDGE)
            start = m.start() + word.find(core) if core else m.start()
            end = start + len(core)
            while at < len(by_start) and by_start[at][1] <= start:
                at += 1
            kind, key = -1, ""
            if at < len(by_start) and by_start[at][0] < end:
                s, e, kind = by_start[at]
                key = digits_of(text[s:e]) if kind in (2, 3) else ""
                kind += 1
            tokens.append(Piece(number, number, start, end, word, previous, kind, key))
        previous = word
    runs: list[list[Piece]] = []
    for t in tokens:
        numeric = NUMBER.fullmatch(text, t.start, t.end) is not None
        if (numeric and runs and runs[-1][-1].last == t.first - 1
                and NUMBER.fullmatch(text, runs[-1][-1].start, runs[-1][-1].end)
                and BETWEEN.fullmatch(text, runs[-1][-1].end, t.start)):
            runs[-1].append(t)
        else:
            runs.append([t])
    spans = {(s, e) for kind, s, e in base if kind in (2, 3)}
    whole = Counter(d for run in runs
                    if LEAST_DIGITS <= len(d := digits_of(text[run[0].start:run[-1].end])) <= MOST_DIGITS)
    out: list[Piece] = []
    for run in runs:
        digits = [digits_of(text[t.start:t.end]) for t in run] if len(run) > 1 else [""]
        i = 0
        while i < len(run):
            joined, stop = digits[i], i
            for j in range(i + 1, len(run)):
                joined += digits[j]
                if len(joined) > MOST_DIGITS:
                    break
                free = all(t.kind < 0 for t in run[i:j + 1])
                if (run[i].start, run[j].end) in spans or free and (
                        joined in known or j - i + 1 == len(run) and whole[joined] > 1):
                    stop = j
            a, z = run[i], run[stop]
            out.append(a if stop == i else Piece(
                a.first, z.last, a.start, z.end, a.word, a.previous, a.kind, a.key))
            i = stop + 1
    return out


def candidates(text: str, base: list[Span]) -> Tokens:
    out = Tokens([], [], [], [], [], [])
    known = known_numbers(text, base)
    before = -2
    for piece in pieces(text, base, known):
        core, word = " ".join(text[piece.start:piece.end].split()), piece.word
        bare = re.sub(r"[\W_]+", "", core).lower()
        digits = digits_of(core)
        checked = base_spans(core)
        alone = checked[0][0] + 1 if checked and checked[0][1:] == (0, len(core)) else 0
        out.alone.append(alone)
        out.spans.append((piece.start, piece.end))
        out.fixed.append(piece.kind)
        out.linked.append(False)
        if out.spans[1:] and before == piece.first - 1:
            out.linked[-2] = True
        before = piece.last
        keys = {bare} if len(bare) >= 6 else set()
        if piece.key:
            keys.update(known[piece.key])
        elif digits in known and not re.search(r"[^\W\d_]", core):
            keys.update(known[digits])
        if "@" in core:
            keys.add("@" + core.split("@")[0].lower())
        out.keys.append(sorted(keys))
        out.features.append([
            feature("one"), feature("alone", alone), feature("shape", shape(core)), feature("digits", min(20, len(digits))),
            feature("luhn", 13 <= len(digits) <= 19 and luhn(digits)),
            feature("at", "@" in core), feature("plus", core[:1] == "+" or word[:1] == "+"),
            feature("all digits", core == digits, min(20, len(digits))),
            feature("before", piece.previous.lower()[-12:]),
            feature("dots", core.count(".") if core.replace(".", "") == digits else -1)])
    return out


# --------------------------------------------------------------------- field

@dataclass
class Field:
    """Node weights (features x labels) and chain log-potentials."""

    node: np.ndarray
    chain: np.ndarray


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(docs: list[Tokens], steps: int = 150, rate: float = 0.5) -> Field:
    """Softmax node weights by AdaGrad; chain potentials from label pairs."""
    rows = [f for d in docs for f in d.features]
    width = len(rows[0]) if rows else 1
    x = np.array(rows, dtype=np.int64).reshape(-1, width)
    y = np.array([max(0, k) for d in docs for k in d.fixed], dtype=np.int64)
    known = np.array([k > 0 or not a for d in docs for k, a in zip(d.fixed, d.alone)], dtype=bool)
    node = np.zeros((FEATURE_SPACE, LABELS))
    total = np.full_like(node, 1e-8)
    x_known, target = x[known], np.eye(LABELS)[y[known]]
    for _ in range(steps if len(target) else 0):
        error = (_softmax(node[x_known].sum(axis=1)) - target) / len(target)
        grad = np.zeros_like(node)
        for j in range(width):
            np.add.at(grad, x_known[:, j], error)
        grad += 1e-5 * node
        total += grad ** 2
        node -= rate * grad / np.sqrt(total)
    counts = np.ones((LABELS, LABELS))
    at = 0
    for d in docs:
        for i, linked in enumerate(d.linked):
            if linked and i + 1 < len(d.linked) and known[at + i] and known[at + i + 1]:
                counts[y[at + i], y[at + i + 1]] += 1
        at += len(d.linked)
    joint = counts / counts.sum()
    chain = np.log(joint / (joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)))
    return Field(node, np.clip(chain, -3, 3))


def spoilt(text: str, base: list[Span]) -> str:
    """The text with each base card and ip changed so that its check fails."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in base):
        if start < at or kind not in (1, 2):
            continue
        out.append(text[at:start])
        span = text[start:end]
        out.append(span.rsplit(".", 1)[0] + ".999" if kind == 1
                   else span[:-1] + str((int(span[-1]) + 1) % 10))
        at = end
    return "".join(out) + text[at:]


def marginals(docs: list[Tokens], field: Field) -> list[np.ndarray]:
    """Label marginals of each document's tokens after loopy message passing."""
    n = sum(len(d.spans) for d in docs)
    if n == 0:
        return [np.zeros((0, LABELS)) for _ in docs]
    x = np.array([f for d in docs for f in d.features], dtype=np.int64)
    unary = field.node[x].sum(axis=1)
    fixed = np.array([k for d in docs for k in d.fixed])
    on = np.flatnonzero(fixed > 0)
    unary[on] = -30.0
    unary[on, fixed[on]] = 30.0
    left, star, member = [], [], []
    stars, at = 0, 0
    for d in docs:
        left += [at + i for i, linked in enumerate(d.linked) if linked]
        places = defaultdict(list)
        for i, keys in enumerate(d.keys):
            for key in keys:
                places[key].append(at + i)
        for where in places.values():
            if len(where) > 1:
                star += [stars] * len(where)
                member += where
                stars += 1
        at += len(d.spans)
    left = np.array(left, dtype=np.int64)
    star, member = np.array(star, dtype=np.int64), np.array(member, dtype=np.int64)
    skip = SKIP_STRENGTH * np.eye(LABELS)
    zeros = np.zeros
    right_msg, left_msg = zeros((len(left), LABELS)), zeros((len(left), LABELS))
    up, down = zeros((len(star), LABELS)), zeros((len(star), LABELS))

    def send(belief: np.ndarray, potential: np.ndarray) -> np.ndarray:
        total = belief[:, :, None] + potential[None]
        top = total.max(axis=1)
        out = top + np.log(np.exp(total - top[:, None, :]).sum(axis=1))
        return out - out.max(axis=1, keepdims=True)

    def beliefs() -> np.ndarray:
        b = unary.copy()
        np.add.at(b, left + 1, right_msg)
        np.add.at(b, left, left_msg)
        np.add.at(b, member, down)
        return b

    for _ in range(ROUNDS):
        b = beliefs()
        new_right = send(b[left] - left_msg, field.chain)
        new_left = send(b[left + 1] - right_msg, field.chain.T)
        up = send(b[member] - down, skip)
        centre = zeros((stars, LABELS))
        np.add.at(centre, star, up)
        new_down = send(centre[star] - up, skip)
        right_msg = (right_msg + new_right) / 2           # damping
        left_msg = (left_msg + new_left) / 2
        down = (down + new_down) / 2
    p = _softmax(beliefs())
    return np.split(p, np.cumsum([len(d.spans) for d in docs])[:-1])


def added_spans(tokens: Tokens, p: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans for confident tokens outside base spans; phone parts are merged."""
    out: list[Span] = []
    last = -2
    for i in np.flatnonzero(p[:, 1:].max(axis=1) >= CONFIDENCE) if len(p) else ():
        start, end = tokens.spans[i]
        kind = int(p[i, 1:].argmax())
        if tokens.fixed[i] > 0 or end <= start or any(
                s < end and start < e for _, s, e in base):
            continue
        if kind == 3 and out and out[-1][0] == 3 and last == i - 1 and tokens.linked[last]:
            out[-1] = (3, out[-1][1], end)
        else:
            out.append((kind, start, end))
        last = i
    return out


# --------------------------------------------------------------------- Spark

def train(docs: DataFrame, limit: int = TRAIN_DOCS) -> Field:
    """Fit the field on candidate tokens of at most ``limit`` documents."""
    hinted = (narrow(docs).filter(F.col("text").rlike("[0-9@]"))
              .withColumn("h", F.xxhash64("text")))
    # the hashes are chosen first, so that no task gathers more texts than the sample
    chosen = hinted.select("h").distinct().orderBy("h").limit(limit)
    sample = (hinted.join(F.broadcast(chosen), "h").groupBy("h").agg(F.min("text").alias("text"))
              .select(F.col("h").alias("doc_id"), "text"))
    schema = ("doc_id long, features array<array<int>>, fixed array<int>, "
              "linked array<boolean>, alone array<int>")

    def compute(pairs: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in pairs:
            for seen in (text, spoilt(text, base_spans(text))):
                t = candidates(seen, base_spans(seen))
                n = TRAIN_TOKENS
                yield doc_id, t.features[:n], t.fixed[:n], t.linked[:n], t.alone[:n]

    rows = sorted(per_batch(sample, schema, compute).collect())      # at most 2 * ``limit`` rows
    return fit([Tokens([(0, 0)] * len(r["fixed"]), r["features"], [[]] * len(r["fixed"]),
                       r["fixed"], r["linked"], r["alone"]) for r in rows])


def label_texts(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text."""
    bases = [base_spans(t) for t in texts]
    tokens = [candidates(t, b) if b or HAS_CANDIDATE.search(t) else Tokens([], [], [], [], [], [])
              for t, b in zip(texts, bases)]
    return [(b, added_spans(t, p, b))
            for b, t, p in zip(bases, tokens, marginals(tokens, field))]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def detect(docs: DataFrame, field: Field) -> DataFrame:
    """Counts and spans of personal data in every document."""
    shared = docs.sparkSession.sparkContext.broadcast((field.node, field.chain))

    def rows(pairs: Iterator[tuple]) -> Iterator[tuple]:
        model = Field(*shared.value)
        for group in _groups(pairs, 64):
            found = label_texts([t or "" for _, t in group], model)
            for (doc_id, _), (base, added) in zip(group, found):
                n = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
                yield (doc_id, *n, hashlib.sha256(listed(base).encode()).hexdigest(),
                       listed(base + added), len(added))

    return per_document(docs, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                        "base_sha256 string, spans string, n_added long", rows)


def _groups(pairs: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    for pair in pairs:
        held.append(pair)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if end <= at:
            continue                                   # inside an earlier span
        out.append(text[at:max(at, start)])
        if start >= at:
            out.append(f"[{KINDS[kind].upper()}]")
        at = end
    return "".join(out) + text[at:]


def mask_documents(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with personal data masked in ``text`` (and ``n_chars`` recounted)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((field.node, field.chain))
    arrow_schema(spark, "doc_id long")                          # ships the package
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field(*shared.value)
        for batch in batches:
            new: list[str | None] = []
            for start in range(0, batch.num_rows, 64):
                texts = batch.column(at).slice(start, 64).to_pylist()
                found = label_texts([t or "" for t in texts], model)
                new += [t and masked(t, b + a) for t, (b, a) in zip(texts, found)]
            columns = list(batch.columns)
            columns[at] = pa.array(new, type=batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return detect(docs, train(docs))
