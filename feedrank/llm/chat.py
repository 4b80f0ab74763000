"""Operator 3: transcript parsing by a hidden Markov model, canonical rendering.

A transcript is an ordered run of lines. Each line gives an observation: the
word of a speaker marker at its start (if any), its length class and how it ends.
A marker is told by its form: one or two words, framed or followed by a colon.
Hidden states are (role, first line of a turn or a later one); Viterbi recovers
them, then every line is rendered in canonical form: a ``<|role|>`` line opens a
turn and loses its marker; other lines stay whole.

What a word means is learned from the conversations whose roles are known: each
word is a class (a few common ones by number, all others by hash). A word that
training didn't meet falls back on how markers in general fall on the states, so
it opens a turn, and its role comes from the turns around it. A first line that
opens with ordinary words in a marker's form loses them too.

Scale. Lines are range-partitioned by (conversation, turn, line, text), so a
conversation of any length is cut into runs of even size. Viterbi over a run is
a max-plus matrix from the state before it to its last state; only the first and
last conversation of a run can go on elsewhere, so two small matrices a run go to
the driver, which finds the best states at the cuts. Every run is then decoded on
its own, with its cut states given. The result is that of one Viterbi pass over
each whole conversation.

Cases: a null or empty text is one empty line; a very long line is one observation;
a role beyond the three has no state and teaches nothing, its lines get one of them; a null conversation id is one
conversation, null turns come first; repeated rows are further lines in place;
an empty table gives no rows; without known roles every state is equally likely
and the first role wins ties.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.llm.common import arrow_schema, per_batch, stored, table

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)         # role * 2 + (1 on a turn's later lines)
# Words with a class of their own; all others share HASHED classes.
MARKER_WORDS = ("system", "note", "user", "human", "customer", "question", "q", "assistant",
                "ai", "bot", "agent", "answer", "a")
HASHED = 499
FRAME_OPEN, FRAME_CLOSE = r"\s*(?:[#*]{1,4}\s*|<\|?|\[)?", r"(?:\s*(?:\|?>|\]|\*+|:))+"
MARKER = re.compile(FRAME_OPEN + "(" + "|".join(MARKER_WORDS) + ")" + FRAME_CLOSE + r"\s*", re.IGNORECASE)
FORM = re.compile(FRAME_OPEN + r"([^\W\d_][\w.'-]{0,31}(?: [\w.'-]{1,31})?)" + FRAME_CLOSE + r"(?:\s+|$)")
LENGTHS = (0, 20, 60, 120, 240, 480)
OBSERVED = (1 + len(MARKER_WORDS) + HASHED, len(LENGTHS) + 1, 4)      # sizes of the parts
UNSEEN = 0.1                    # share of the markers' weight that is spread over all words
TRAIN_FOLDS, FOLDS = 4, 5       # conversations of this share teach the model
NULL_KEY = -(1 << 63)           # stands for a null conversation id or turn in keys
LINE = ("part int, conv_id long, turn long, line_no int, tie long, line string, marker int, "
        "length int, ending int, body int, state int")
RESULT = "conv_id long, turn long, line_no int, role string, rendered string"


def observe(line: str) -> tuple[int, int, int, int]:
    """marker class (0: none), length class, ending class, and where the body starts."""
    m = MARKER.match(line) or FORM.match(line)
    word = m.group(1).lower() if m else ""
    if word in MARKER_WORDS:
        marker = MARKER_WORDS.index(word) + 1
    else:
        marker = 1 + len(MARKER_WORDS) + zlib.crc32(word.encode()) % HASHED if m else 0
    body = line[m.end():].rstrip() if m else line.rstrip()
    length = sum(len(body) > k for k in LENGTHS)
    ending = {"?": 1, ":": 2, ".": 3}.get(body[-1:], 0)
    return marker, length, ending, m.end() if m else 0


# --------------------------------------------------------------------- model

@dataclass
class Model:
    """Log-probabilities: start and transition of states, parts of observations."""

    start: np.ndarray
    step: np.ndarray
    parts: list[np.ndarray]

    @classmethod
    def of(cls, counts: dict[tuple[str, int, int], int]) -> "Model":
        """From counts by (kind, row, column); kinds: start, step, part 0..2."""
        def matrix(kind: str, rows: int, columns: int, least: float = 0.1) -> np.ndarray:
            m = np.full((rows, columns), least)
            for (k, i, j), n in counts.items():
                if k == kind:
                    m[i, j] += n
            return m

        start = matrix("start", 1, STATES)[0]
        start[1::2] = 1e-9                          # a conversation opens with a first line
        step = matrix("step", STATES, STATES)
        for s in range(STATES):
            for t in range(1, STATES, 2):
                if t // 2 != s // 2:
                    step[s, t] = 1e-9               # a later line keeps its role
        words = matrix("part0", STATES, OBSERVED[0], 1e-5)
        words[:, 0] += 0.1
        words[:, 1:] += UNSEEN * words[:, 1:].mean(axis=1, keepdims=True)
        parts = [words, *(matrix(f"part{i}", STATES, n) for i, n in enumerate(OBSERVED) if i)]
        return cls(np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True)),
                   [np.log(p / p.sum(1, keepdims=True)) for p in parts])

    def emission(self, seen: np.ndarray) -> np.ndarray:
        """Log-likelihood (lines x states) of observation parts (lines x 3)."""
        return sum(p[:, seen[:, i]].T for i, p in enumerate(self.parts))


def through(emission: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best scores from each row of ``first`` (scores of line 0) to the last state."""
    score = first
    for e in emission[1:]:
        score = (score[:, :, None] + step[None]).max(axis=1) + e
    return score


def viterbi(emission: np.ndarray, step: np.ndarray, first: np.ndarray,
            last: int | None = None) -> np.ndarray:
    """Best state path; ``first`` are scores of line 0, ``last`` a given end."""
    back = np.zeros((len(emission), STATES), dtype=np.int64)
    score = first
    for i in range(1, len(emission)):
        total = score[:, None] + step
        back[i] = total.argmax(axis=0)
        score = total.max(axis=0) + emission[i]
    path = np.empty(len(emission), dtype=np.int64)
    path[-1] = score.argmax() if last is None else last
    for i in range(len(emission) - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


# --------------------------------------------------------------------- Spark

def sequence(lines: DataFrame) -> DataFrame:
    """Lines cut into even, ordered runs (``part``) and stored with observations.

    ``lines`` has conv_id, turn, line_no, line and role (null where unknown).
    """
    keyed = lines.select(F.coalesce("conv_id", F.lit(NULL_KEY)).alias("conv_id"),
                         F.coalesce("turn", F.lit(NULL_KEY)).alias("turn"), "line_no",
                         F.xxhash64("line").alias("tie"), "line", "role")
    ranged = (keyed.repartitionByRange("conv_id", "turn", "line_no", "tie")
              .select(F.spark_partition_id().alias("part"), "*"))

    def rows(batch: Iterator[tuple]) -> Iterator[tuple]:
        for part, conv_id, turn, line_no, tie, line, role in batch:
            marker, length, ending, body = observe(line or "")
            state = 2 * ROLES.index(role) + int(line_no > 0) if role in ROLES else None
            yield (part, conv_id, turn, line_no, tie, line or "", marker, length, ending,
                   body, state)

    return stored(per_batch(ranged, LINE, rows), "chat-lines")


def _runs(frame: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """A part in order, and the bounds of its conversations."""
    frame = frame.sort_values(["conv_id", "turn", "line_no", "tie"], kind="stable")
    conv = frame["conv_id"].to_numpy()
    return frame, np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1, [len(frame)]])


def _seen(frame: pd.DataFrame) -> np.ndarray:
    return frame[["marker", "length", "ending"]].to_numpy(dtype=np.int64)


def train(lines: DataFrame) -> Model:
    """Count states and observations of conversations whose roles are known.

    A start is counted where a conversation begins, not where a part goes on with
    one; a step where two lines that follow each other both have a state.
    """
    schema = "kind string, i int, j int, n long"
    arrow_schema(lines.sparkSession, schema)
    # one row a part: the conversation it ends with, which the next may go on with
    ends = lines.groupBy("part").agg(F.max("conv_id").alias("last")).orderBy("part").collect()
    goes_on = {after["part"]: row["last"] for row, after in zip(ends, ends[1:])}
    known = lines.filter(F.pmod(F.xxhash64("conv_id"), F.lit(FOLDS)) < TRAIN_FOLDS).drop("line")

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        frame, bounds = _runs(frame)
        labelled = frame["state"].notna().to_numpy()
        state, seen = frame["state"].fillna(0).to_numpy(dtype=np.int64), _seen(frame)
        found: dict[tuple[str, int, int], int] = {}
        opens = np.zeros(len(frame), dtype=bool)
        opens[bounds[:-1]] = True
        inner = np.flatnonzero(~opens)
        inner = inner[labelled[inner] & labelled[inner - 1]]
        opens[0] = goes_on.get(int(frame["part"].iloc[0])) != int(frame["conv_id"].iloc[0])
        first = opens & labelled
        state_, seen_ = state[labelled], seen[labelled]
        for kind, i, j in (("start", np.zeros(int(first.sum()), int), state[first]),
                           ("step", state[inner - 1], state[inner]),
                           *((f"part{k}", state_, seen_[:, k]) for k in range(len(OBSERVED)))):
            for pair, n in zip(*np.unique(np.stack([i, j], 1), axis=0, return_counts=True)):
                found[kind, int(pair[0]), int(pair[1])] = int(n)
        return pd.DataFrame([(*k, n) for k, n in found.items()], columns=["kind", "i", "j", "n"])

    sums = (known.groupBy("part").applyInPandas(count, schema)
            .groupBy("kind", "i", "j").agg(F.sum("n").alias("n")).collect())   # model size
    return Model.of({(r["kind"], r["i"], r["j"]): r["n"] for r in sums})


def cut_states(lines: DataFrame, model: Model) -> dict[int, tuple[int | None, int | None]]:
    """part -> (state before its first line, state of its last line), where a
    conversation goes on across the cut; two small rows a part reach the driver."""
    schema = "part int, conv_id long, at_start boolean, at_end boolean, scores array<double>"
    arrow_schema(lines.sparkSession, schema)

    def ends(frame: pd.DataFrame) -> pd.DataFrame:
        frame, bounds = _runs(frame)
        out = []
        for k in sorted({0, len(bounds) - 2}):
            run = frame.iloc[bounds[k]:bounds[k + 1]]
            e = model.emission(_seen(run))
            # row 0: the conversation starts here; rows 1..: by the state before
            first = np.vstack([model.start, model.step]) + e[0]
            out.append((int(run["part"].iloc[0]), int(run["conv_id"].iloc[0]), k == 0,
                        k == len(bounds) - 2, through(e, model.step, first).ravel().tolist()))
        return pd.DataFrame(out, columns=["part", "conv_id", "at_start", "at_end", "scores"])

    found = (lines.drop("line").groupBy("part").applyInPandas(ends, schema)
             .orderBy("part", F.col("at_start").desc()).collect())
    given: dict[int, list] = {}
    chain: list = []
    for k, row in enumerate(found):
        table_ = np.array(row["scores"]).reshape(STATES + 1, STATES)
        goes_on = (k + 1 < len(found) and row["at_end"] and found[k + 1]["at_start"]
                   and found[k + 1]["part"] != row["part"]
                   and found[k + 1]["conv_id"] == row["conv_id"])
        if chain:
            total = chain[-1][1][:, None] + table_[1:]
            chain.append((row["part"], total.max(axis=0), total.argmax(axis=0)))
        elif goes_on:
            chain.append((row["part"], table_[0], None))
        if chain and not goes_on:
            state = int(chain[-1][1].argmax())
            for i in range(len(chain) - 1, -1, -1):
                part, _, back = chain[i]
                entry = given.setdefault(part, [None, None])
                if i < len(chain) - 1:              # goes on in the next part
                    entry[1] = state
                if back is not None:
                    entry[0] = state = int(back[state])
            chain = []
    return {part: tuple(entry) for part, entry in given.items()}


def decode(lines: DataFrame, model: Model) -> DataFrame:
    """Role and canonical rendering of every line."""
    given = cut_states(lines, model)
    arrow_schema(lines.sparkSession, RESULT)

    def parse(frame: pd.DataFrame) -> pd.DataFrame:
        frame, bounds = _runs(frame)
        before, last = given.get(int(frame["part"].iloc[0]), (None, None))
        e_all = model.emission(_seen(frame))
        path = np.empty(len(frame), dtype=np.int64)
        for k, (s, t) in enumerate(zip(bounds[:-1], bounds[1:])):
            first = (model.step[before] if k == 0 and before is not None else model.start) + e_all[s]
            goes_on = k == len(bounds) - 2 and last is not None
            path[s:t] = viterbi(e_all[s:t], model.step, first, last if goes_on else None)
        texts = []
        for line, body, state in zip(frame["line"], frame["body"], path):
            text = (line[body:] if state % 2 == 0 else line).strip()
            texts.append(f"<|{ROLES[state // 2]}|>\n{text}" if state % 2 == 0 else text)
        frame = frame.assign(role=[ROLES[s // 2] for s in path], rendered=texts)
        return frame[["conv_id", "turn", "line_no", "role", "rendered"]]

    def real(column: str) -> Column:
        return F.when(F.col(column) != NULL_KEY, F.col(column)).alias(column)

    return (lines.groupBy("part").applyInPandas(parse, RESULT)
            .select(real("conv_id"), real("turn"), "line_no", "role", "rendered"))


def transcripts(turns: DataFrame) -> DataFrame:
    """Raw transcript lines of stored conversations, markers in mixed styles.

    The style depends on the conversation, and a tenth of the turns carry no
    marker. ``role`` stays beside each line to teach and to test the model.
    """
    h = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    names = [{"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
             {"system": "### System:\n", "user": "### Human:\n", "assistant": "### Assistant:\n"},
             {"system": "[system] ", "user": "[customer] ", "assistant": "[agent] "},
             {"system": "Note: ", "user": "Q: ", "assistant": "A: "}]
    marker = F.lit("")
    for style, by_role in enumerate(names):
        for role, word in by_role.items():
            marker = F.when((h == style) & (F.col("role") == role), word).otherwise(marker)
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10)) == 0
    raw = F.concat(F.when(bare, "").otherwise(marker), F.coalesce("text", F.lit("")))
    return (turns.select(F.col("conv_id").cast("long").alias("conv_id"),
                         F.col("turn").cast("long").alias("turn"),
                         F.col("role").cast("string").alias("role"),
                         F.col("text").cast("string").alias("text"))
            .select("conv_id", "turn", F.posexplode(F.split(raw, "\n")).alias("line_no", "line"),
                    "role"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sequence(transcripts(table(spark, sf_dir, "conversations")))
    return decode(lines, train(lines))
