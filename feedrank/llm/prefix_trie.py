"""Operator 11: prefix trie of conversations from sorted turn-id matrices.

A conversation is the sequence of its turns; every prefix shared by one or more
conversations is a node. A turn's id is the first 16 bytes of the SHA-256 of its
role and text, so texts are read once and never shuffled.

1. Rows (conversation, turn ids, text lengths) are range-partitioned by their id
   sequences, then by conversation id, so a node is a run of neighbouring rows,
   and a very common sequence is split over as many shards as it needs.
2. A shard numbers its ids in byte order and sorts its rows with ``lexsort`` over
   padded matrices, ``WIDTH`` columns at a time; only rows that tie go on to the
   next columns. It writes blocks of at most ``BLOCK_TURNS`` turns (or one row).
3. The rows at block boundaries are compared across blocks; two numbers a block
   (turns shared with the row before and the row after) are all it has to know
   about the others.
4. A block compares neighbouring rows column by column; change masks, OR-ed from
   the left, mark where a row starts a node. Counts, minima and sums of a depth
   are ``reduceat`` over the rows that reach it. All of them add up over rows:
   leaves are counted at the last row of a childless node, and a turn's text is
   saved once for each row that doesn't start its node.
5. Nodes that reach over a block boundary come out as partial rows under a
   digest of their prefix and are added up by it.

Cases: rows without a conversation id belong to no conversation; a null role or
text is an empty one; turns with one number follow each other in the order of
their ids (null numbers first); repeated rows are repeated turns; a conversation
of any length is one row of 16 + 8 bytes a turn; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedrank.llm.common import arrow_schema, stored, table

MAX_HEAD = 6            # heads have 0 to 5 turns
FAMILY = 100            # conversations that share a head
ID_BYTES = 16
WIDTH = 32              # columns of a padded matrix
SHARD_TURNS = 1 << 20
BLOCK_TURNS = 1 << 17

BLOCKS = ("shard int, block int, n long, ids binary, sizes binary, turns binary, lengths binary, "
          "first array<binary>, last array<binary>")
NODES = ("node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends string, "
         "first_end long")
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
          "saved_tokens", "ends_sha256")
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------- conversations

def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that name a turn; the role's length keeps (role, text) apart."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, ID_BYTES)


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` (structs of id and length, in order)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    one = F.struct(F.col("turn").isNotNull().alias("numbered"),
                   F.col("turn").cast("long").alias("turn"),
                   turn_id(role, text).alias("id"), F.length(text).cast("long").alias("length"))
    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("one"))
            .filter(F.col("conv_id").isNotNull())
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns")))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``ids`` and ``lengths`` after the family's head replaced the first turns."""
    own = stored(sequences(conversations), "trie-sequences")
    heads = (own.filter(F.col("conv_id") % FAMILY == 0)
             .select(F.col("conv_id").alias("family"),
                     F.slice("turns", 1, MAX_HEAD - 1).alias("head")))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MAX_HEAD
    none = F.slice("turns", 1, 0)
    whole = F.concat(F.coalesce(F.slice("head", F.lit(1), h.cast("int")), none),
                     F.slice("turns", h.cast("int") + 1, F.size("turns") + 1))
    return (own.join(heads, own["conv_id"] - own["conv_id"] % FAMILY == heads["family"], "left")
            .select("conv_id", whole.alias("turns"))
            .select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.length").alias("lengths")))


# -------------------------------------------------------------------- shards

def lex_order(ranks: np.ndarray, start: np.ndarray, size: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Rows in the order of their rank sequences (shorter first), then of ``ids``.

    ``ranks`` holds all sequences one after another; row i is
    ``ranks[start[i]:start[i] + size[i]]``.
    """
    out: list[np.ndarray] = []
    todo: list[tuple[np.ndarray, int | None]] = [(np.arange(len(start)), 0)]
    while todo:
        rows, at = todo.pop()
        if at is None or not len(rows):
            out.append(rows)
            continue
        matrix = padded(ranks, start[rows], size[rows], at)
        order = np.lexsort((ids[rows], *matrix.T[::-1]))
        rows, matrix = rows[order], matrix[order]
        new = np.concatenate([[False], (matrix[1:] != matrix[:-1]).any(axis=1)])
        run = np.cumsum(new)
        tied = (np.bincount(run) > 1) & (np.bincount(run, size[rows] > at + WIDTH) > 0)
        open_row = tied[run]
        cut = np.flatnonzero(new & (open_row | np.roll(open_row, 1)))
        parts = np.split(rows, cut)
        first = np.concatenate([[0], cut])
        todo.extend(reversed([(part, at + WIDTH if more else None)
                              for part, more in zip(parts, open_row[first].tolist())]))
    return np.concatenate([*out, np.zeros(0, dtype=np.int64)]).astype(np.int64)


def padded(ranks: np.ndarray, start: np.ndarray, size: np.ndarray, at: int) -> np.ndarray:
    """Columns ``at`` to ``at + WIDTH`` of the rank sequences, from 1 on; 0 is padding."""
    column = at + np.arange(min(WIDTH, max(1, int(size.max(initial=0)) - at)))
    there = column < size[:, None]
    matrix = np.zeros(there.shape, dtype=np.int64)
    matrix[there] = ranks[(start[:, None] + column)[there]] + 1
    return matrix


def shared_turns(ranks: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For every row but the first: how many leading turns it shares with the row before."""
    shared = np.zeros(max(0, len(start) - 1), dtype=np.int64)
    live = np.arange(len(shared))
    at = 0
    while len(live):
        both = padded(ranks, np.concatenate([start[live], start[live + 1]]),
                      np.concatenate([size[live], size[live + 1]]), at)
        above, below = both[:len(live)], both[len(live):]
        changed = np.logical_or.accumulate((above != below) | (below == 0), axis=1)
        shared[live] += (~changed).sum(axis=1)
        live = live[~changed[:, -1]]
        at += both.shape[1]
    return shared


def _starts(size: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(size) else size


def _ranks(turns: bytes | pa.Buffer) -> np.ndarray:
    """Turn ids numbered in byte order."""
    halves = np.frombuffer(turns, dtype=">u8").reshape(-1, 2).astype(np.uint64)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    ordered = halves[order]
    new = np.concatenate([[False], (ordered[1:] != ordered[:-1]).any(axis=1)])[:len(order)]
    ranks = np.empty(len(order), dtype=np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def sorted_blocks(rows: DataFrame, shard_turns: int = SHARD_TURNS,
                  block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Blocks (``BLOCKS``) of the rows in the order of sequences and conversation ids."""
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(total // shard_turns + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    target = arrow_schema(spark, BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        whole = pa.Table.from_batches(got).combine_chunks()
        conv = whole.column(0).to_numpy()
        listed = [whole.column(k).combine_chunks() for k in (1, 2)]
        size = np.diff(listed[0].offsets.to_numpy()).astype(np.int64)
        turns = b"".join(listed[0].flatten().to_pylist())
        length = listed[1].flatten().to_numpy(zero_copy_only=False)
        start = _starts(size)
        order = lex_order(_ranks(turns), start, size, conv)
        turn = np.frombuffer(turns, dtype=f"V{ID_BYTES}")
        bound = (np.cumsum(size[order] + 1) - 1) // block_turns
        for number, part in enumerate(np.split(order, np.flatnonzero(np.diff(bound)) + 1)):
            flat = np.repeat(start[part] - _starts(size[part]), size[part]) + np.arange(size[part].sum())
            ends = [[turn[j].tobytes() for j in range(start[r], start[r] + size[r])]
                    for r in (part[0], part[-1])]
            yield pa.RecordBatch.from_pylist([{
                "shard": TaskContext.get().partitionId(), "block": number, "n": len(part),
                "ids": conv[part].tobytes(), "sizes": size[part].tobytes(),
                "turns": turn[flat].tobytes(), "lengths": length[flat].astype(np.int64).tobytes(),
                "first": ends[0], "last": ends[1]}], schema=target)

    return (rows.select("conv_id", "ids", "lengths").repartitionByRange(shards, "ids", "conv_id")
            .mapInArrow(run, BLOCKS))


def with_edges(blocks: DataFrame) -> DataFrame:
    """Adds ``before`` and ``after``: turns shared with the neighbour row, -1 where there is none."""
    order = Window.orderBy("of_shard", "of_block")

    def common(a: Column, b: Column) -> Column:
        same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
        stop = F.array_position(same, F.lit(False))
        return F.when(stop == 0, F.size(same)).otherwise(stop - 1).cast("long")

    ends = blocks.select(F.col("shard").alias("of_shard"), F.col("block").alias("of_block"),
                         "first", "last")                   # two rows of a block, one task
    edges = ends.select(
        "of_shard", "of_block",
        F.coalesce(common(F.lag("last").over(order), F.col("first")), F.lit(-1)).alias("before"),
        F.coalesce(common(F.col("last"), F.lead("first").over(order)), F.lit(-1)).alias("after"))
    return (blocks.join(edges, (blocks["shard"] == edges["of_shard"])
                        & (blocks["block"] == edges["of_block"]))
            .select("n", "ids", "sizes", "turns", "lengths", "before", "after"))


# --------------------------------------------------------------------- nodes

def prefix_keys(turns: np.ndarray, depth: int) -> list[bytes]:
    """Digests of the first 0, 1, .. ``depth`` turns of a row."""
    state = hashlib.sha256()
    keys = [state.digest()]
    for k in range(depth):
        state.update(turns[k].tobytes())
        keys.append(state.digest())
    return keys


def block_nodes(conv: np.ndarray, size: np.ndarray, turns: np.ndarray, length: np.ndarray,
                before: int, after: int) -> Iterator[dict[str, list]]:
    """Nodes of a block, a depth at a time, as columns of ``NODES``.

    Nodes that are shared with the row before or after the block have their
    digest in ``node``; those whose parent is shared have its digest in
    ``parent``.
    """
    start = _starts(size)
    ranks = _ranks(turns.tobytes())
    shared = np.concatenate([[before], shared_turns(ranks, start, size)])   # with the row above
    below = np.concatenate([shared[1:], [after]])                   # with the row below
    leaf = (below < size).astype(np.int64)      # the last row of a node without children
    summed = np.concatenate([[0], np.cumsum(length)])
    reach = np.minimum(np.maximum(shared, 0), size)
    top, end = (prefix_keys(turns[start[r]:start[r] + size[r]], n)
                for r, n in ((0, before), (len(size) - 1, after)))
    rows = np.arange(len(size))
    node_of = np.zeros(len(size), dtype=np.int64)                   # at the depth above
    above: tuple[np.ndarray, list[bytes | None]] | None = None      # its minima and open digests
    depth = 0
    while True:
        rows = rows[size[rows] >= depth]
        if not len(rows):
            return
        begins = shared[rows] < depth
        begins[0] = True
        at = np.flatnonzero(begins)

        def total(x: np.ndarray, at=at) -> np.ndarray:
            return np.add.reduceat(x.astype(np.int64), at)

        least = np.minimum.reduceat(conv[rows], at)
        first = max(depth, 1)
        saved = np.where(reach[rows] >= first, summed[start[rows] + reach[rows]]
                         - summed[start[rows] + np.minimum(first - 1, reach[rows])], 0)
        ended = size[rows] == depth
        n_ended = total(ended)
        keys: list[bytes | None] = [None] * len(at)
        if depth <= before:
            keys[0] = top[depth]
        if depth <= after:
            keys[-1] = end[depth]
        parents: list[bytes | None] = [None] * len(at)
        parent_least: list[int | None] = [None] * len(at)
        if above is not None:
            up = node_of[rows[at]]
            parents = [above[1][u] for u in up.tolist()]
            parent_least = above[0][up].tolist()
        digests, texts, first_end = [], [], []
        for k, (a, n) in enumerate(zip(at.tolist(), n_ended.tolist())):
            joined = ",".join(map(str, conv[rows[a:a + n]].tolist())) if n else ""
            shut = keys[k] is None
            digests.append((hashlib.sha256(joined.encode()).hexdigest() if n else NO_ENDS)
                           if shut else None)
            texts.append(joined if n and not shut else None)
            first_end.append(int(conv[rows[a]]) if n and not shut else None)
        yield {"node": keys, "parent": parents, "conv_id": least.tolist(), "depth": [depth] * len(at),
               "parent_conv_id": [m if p is None else None for m, p in zip(parent_least, parents)],
               "n_convs": total(np.ones(len(rows))).tolist(),
               "n_children": total((size[rows] > depth) & (shared[rows] < depth + 1)).tolist(),
               "n_leaves": total(leaf[rows]).tolist(), "saved_tokens": total(saved).tolist(),
               "ends_sha256": digests, "ends": texts, "first_end": first_end}
        node_of[rows] = np.cumsum(begins) - 1
        above = (least, keys)
        depth += 1


def nodes_of(blocks: DataFrame) -> DataFrame:
    """Nodes and partial nodes (``NODES``) of blocks with edges."""
    target = arrow_schema(blocks.sparkSession, NODES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                arrays = [np.frombuffer(row[name].as_buffer(), dtype=kind) for name, kind in (
                    ("ids", np.int64), ("sizes", np.int64), ("turns", f"V{ID_BYTES}"),
                    ("lengths", np.int64))]
                for level in block_nodes(*arrays, row["before"].as_py(), row["after"].as_py()):
                    yield pa.RecordBatch.from_pydict(level, schema=target)

    return blocks.mapInArrow(run, NODES)


def digests_of(parts: DataFrame) -> DataFrame:
    """``hashed`` (node) and ``digest`` of its ends, joined in order part by part."""
    schema = "hashed binary, digest string"
    target = arrow_schema(parts.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_pydict(
                {"hashed": [d[0] for d in done], "digest": [d[1] for d in done]}, schema=target)
        if state is not None:
            yield pa.RecordBatch.from_pydict({"hashed": [node], "digest": [state.hexdigest()]},
                                             schema=target)

    return (parts.repartition("node").sortWithinPartitions("node", "first_end")
            .select("node", "ends").mapInArrow(run, schema))


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS,
         block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row a node of the trie of the rebuilt conversations."""
    rows = stored(rebuilt(conversations), "trie-rows")
    blocks = stored(sorted_blocks(rows, shard_turns, block_turns), "trie-blocks")
    found = stored(nodes_of(with_edges(blocks)), "trie-nodes")
    shared = found.filter("node is not null")
    merged = (shared.groupBy("node")
              .agg(F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
                   F.first("depth").alias("depth"),
                   *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]))
    ends = digests_of(shared.filter("ends is not null"))
    merged = stored(merged.join(ends, merged["node"] == ends["hashed"], "left")
                    .withColumn("ends_sha256", F.coalesce("digest", F.lit(NO_ENDS)))
                    .drop("hashed", "digest"), "trie-shared")
    up = merged.select(F.col("node").alias("up"), F.col("conv_id").alias("up_conv_id"))
    below = (found.filter("node is null and parent is not null")
             .select("parent", *RESULT).drop("parent_conv_id")
             .unionByName(merged.drop("node")))
    joined = below.join(up, below["parent"] == up["up"], "left").withColumn(
        "parent_conv_id", F.col("up_conv_id"))
    alone = found.filter("node is null and parent is null")
    return alone.select(*RESULT).unionByName(joined.select(*RESULT))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


# ------------------------------------------------------------------- SQL form

# Python's crc32 has no DuckDB name; the table of its 256 steps is built from the rule.
SQL = f"""WITH RECURSIVE
steps(i, c, k) AS (
  SELECT i, CAST(i AS UBIGINT), 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1
  FROM steps WHERE k < 8),
lut AS MATERIALIZED (SELECT list(c ORDER BY i) AS l FROM steps WHERE k = 8),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc AS MATERIALIZED (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS UBIGINT))),
      lambda c, b: xor(l[CAST(xor(c, b) & 255 AS BIGINT) + 1], c >> 8)),
      4294967295::UBIGINT) % {MAX_HEAD} AS h FROM ids CROSS JOIN lut),
own AS MATERIALIZED (
  SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
built AS MATERIALIZED (
  SELECT o.conv_id, list_concat(coalesce(p.t[1:h::BIGINT], []), o.t[h::BIGINT + 1:]) AS t
  FROM own o JOIN crc USING (conv_id)
  LEFT JOIN own p ON p.conv_id = o.conv_id - o.conv_id % {FAMILY}),
prefixes AS (SELECT conv_id, len(t) AS n, d, t[1:d] AS p
  FROM built, LATERAL (SELECT unnest(range(0, len(t) + 1)) AS d)),
nodes AS MATERIALIZED (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * coalesce(length(any_value(p[d][2])), 0) END AS saved,
    sha256(coalesce(string_agg(CASE WHEN n = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id),
      '')) AS ends_sha256
  FROM prefixes GROUP BY p, d),
kids AS MATERIALIZED (SELECT p[1:d - 1] AS up, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
told AS MATERIALIZED (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.up = n.p),
sums AS (
  SELECT up, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT p[1:unnest(range(0, d + 1))] AS up, saved, n_children FROM told) GROUP BY up)
SELECT t.conv_id, CAST(t.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, t.n_convs, t.n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, t.ends_sha256
FROM told t JOIN sums s ON s.up = t.p
LEFT JOIN nodes u ON t.d > 0 AND u.p = t.p[1:t.d - 1]"""
