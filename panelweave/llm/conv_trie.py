"""The prefix trie of conversations, from sorted sequences and range minima.

A conversation is the row of its turns; each turn is written as a symbol, 16 bytes of the SHA-256 of
its role and text. Sorted by symbols, the conversations that share their first d turns stand side by
side. With the lengths of the common prefixes of neighbours (LCP), a prefix of d turns of row i has as
members all rows out to which no LCP falls below d. A sparse table of range minima answers this for any
stretch at once, so every candidate prefix (row, depth) finds the left and the right end of its members
by a binary search of its own: no stack, no order among candidates. A node is a candidate that begins
its own interval.

Steps:

1. ``turn_sequences``: one row per conversation (symbols, bytes of each text), from one shuffle.
2. ``prefix_trie`` sorts the rows by range partitioning on (symbols, key), so that equal conversations,
   however many, spread over tasks. Each task goes through its rows in blocks of ``UNITS`` candidates.
   Nodes whose members lie inside a block are done. All others hold the first or the last row of a block,
   so a block hands on these two rows, with what it counted for each of their prefixes.
3. These rows are sequences too; the same step runs on them, level by level, until one block is left.
   A level has a sixteenth of the rows of the one before at most.
4. Conversations that end at a node over several blocks come as sorted stretches of their keys, and are
   hashed as a stream in order. Parents outside a block are looked up by the hash of their prefix.

Turns are ordered by turn, null first; turns of one number by their symbols. Null role and text are
empty. Rows without a conversation key belong to none and are left out. A conversation is one row, so
its symbols have to fit one (16 bytes a turn). Repeated rows are turns of their own. Equal
conversations share all nodes. An empty table has no nodes, not even a root. Extra columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.registry import query, table
from panelweave.operators.timeline import checked_broadcast
from panelweave.session import pin, scratch_path

SYMBOL = 16
UNITS = 1 << 18  # candidates, one per row and depth, that a block holds
LEAST_ROWS = 32  # rows of a block, however long they are
PIECE = 1 << 16  # keys in a stretch of ends
NODE, EDGE, ENDS = 0, 1, 2
COUNTS = ("n", "least", "kids", "leaves", "saved")  # per depth of a row, what lower levels found
NOTHING = hashlib.sha256(b"").hexdigest()
OUT = (
    "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "key binary, parent_key binary, path binary, sizes array<int>, n array<long>, least array<long>, kids array<long>, leaves array<long>, saved array<long>, ends binary"
)
COLUMNS = [c.split()[0] for c in OUT.split(", ")]
NODES = COLUMNS[1:9]


def turn_sequences(turns: DataFrame, near: str = "conv_id") -> DataFrame:
    """(conv_id, path: the symbols in a row, sizes: UTF-8 bytes of each text), partitioned by the expression ``near``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    symbol = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * SYMBOL)
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.expr(near).alias("near"), "conv_id", F.struct("turn", symbol.alias("symbol"), F.octet_length(text).alias("size")).alias("t"))
    grouped = rows.repartition("near").groupBy("near", "conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return grouped.select("near", "conv_id", F.unhex(F.array_join(F.col("t.symbol"), "")).alias("path"), F.col("t.size").alias("sizes"))


def graft_heads(sequences: DataFrame, head: str) -> DataFrame:
    """Every sequence with its first ``head`` turns taken from the one whose key is its ``near``, none if that is absent.

    Expects the sequences of one ``near`` to be few; they are partitioned by it already.
    """
    groups = sequences.groupBy("near").agg(F.collect_list(F.struct("conv_id", "path", "sizes")).alias("all"))
    first = F.get(F.filter("all", lambda x: x["conv_id"] == F.col("near")), F.lit(0))
    one = groups.select(first.alias("first"), F.explode("all").alias("own")).select(
        F.col("own.conv_id").alias("conv_id"), F.coalesce("first.path", F.lit(b"")).alias("_path"), F.coalesce("first.sizes", F.array().cast("array<int>")).alias("_sizes"),
        F.col("own.path").alias("path"), F.col("own.sizes").alias("sizes"))
    h = F.expr(head).cast("int")
    return one.select(
        "conv_id", F.concat(F.substring("_path", F.lit(1), SYMBOL * h), F.substring("path", SYMBOL * h + 1, F.octet_length("path"))).alias("path"),
        F.concat(F.slice("_sizes", F.lit(1), h), F.slice("sizes", h + 1, F.size("sizes") + 1)).alias("sizes"))


def _sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Row j has the minimum of each stretch of 2**j values."""
    rows = [values]
    while 2 << len(rows) - 1 <= len(values):
        half, last = 1 << len(rows) - 1, rows[-1]
        rows.append(np.minimum(last[:-half], last[half:]))
    return rows


def _extents(lcp: np.ndarray, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row whose common prefix with ``row`` has ``depth`` turns; lcp[i] is that of rows i - 1 and i."""
    minima, count = _sparse_table(lcp), len(lcp)
    left, right = row.copy(), row.copy()
    for j in range(len(minima) - 1, -1, -1):
        step, least = 1 << j, minima[j]
        to = left - step
        left = np.where((to >= 0) & (least[np.clip(to + 1, 0, len(least) - 1)] >= depth), to, left)
        to = right + step
        right = np.where((to < count) & (least[np.clip(right + 1, 0, len(least) - 1)] >= depth), to, right)
    return left, right


def _neighbours(paths: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before, in turns; -1 for the first."""
    symbols = np.frombuffer(b"".join(paths), dtype=np.uint64).reshape(-1, 2)
    start = np.cumsum(lengths) - lengths
    lcp = np.full(len(paths), -1, dtype=np.int64)
    alive, depth = np.arange(1, len(paths)), 0
    while len(alive):
        longer = np.minimum(lengths[alive - 1], lengths[alive]) > depth
        lcp[alive[~longer]] = depth
        alive = alive[longer]
        same = (symbols[start[alive - 1] + depth] == symbols[start[alive] + depth]).all(axis=1)
        lcp[alive[~same]] = depth
        alive, depth = alive[same], depth + 1
    return lcp


def _prefix_keys(path: bytes) -> list[bytes]:
    """A hash of each prefix, the empty one first."""
    digest, keys = hashlib.sha256(), []
    for at in range(0, len(path) + 1, SYMBOL):
        keys.append(digest.copy().digest()[:SYMBOL])
        digest.update(path[at:at + SYMBOL])
    return keys


def fold(block: pd.DataFrame, whole: bool) -> pd.DataFrame:
    """Nodes of a sorted block, and unless it is ``whole`` its first and last row and their ends, as rows of OUT.

    Without the columns of COUNTS the rows are conversations, else rows that a lower level handed on.
    """
    paths, convs, raw = list(block["path"]), block["conv_id"].to_numpy(dtype=np.int64), "n" not in block.columns
    rows = len(paths)
    lengths = np.array([len(p) // SYMBOL for p in paths], dtype=np.int64)
    lcp = _neighbours(paths, lengths)
    row = np.repeat(np.arange(rows), lengths + 1)
    start = np.cumsum(lengths + 1) - lengths - 1
    depth = np.arange(len(row)) - start[row]
    left, right = _extents(lcp, row, depth)

    begins = left == row  # these candidates are the nodes, in preorder
    node = (np.cumsum(begins) - 1)[start[left] + depth]
    row_of, depth_of, right_of = row[begins], depth[begins], right[begins]
    count = len(row_of)
    if raw:
        n, least = right_of - row_of + 1, np.full(count, np.iinfo(np.int64).max)
        np.minimum.at(least, node, convs[row])
        kids, leaves, saved = (np.zeros(count, dtype=np.int64) for _ in range(3))
    else:
        given = {c: np.concatenate(list(block[c])).astype(np.int64) for c in COUNTS}
        n, kids, leaves, saved = (np.zeros(count, dtype=np.int64) for _ in range(4))
        for out, c in ((n, "n"), (kids, "kids"), (leaves, "leaves"), (saved, "saved")):
            np.add.at(out, node, given[c])
        least = np.full(count, np.iinfo(np.int64).max)
        np.minimum.at(least, node, given["least"])

    parent = np.where(depth_of > 0, node[np.maximum(start[row_of] + depth_of - 1, 0)], -1)
    sizes = np.concatenate([np.append(0, s) for s in block["sizes"]]).astype(np.int64)[begins]  # bytes of each node's last text
    inner = np.flatnonzero(parent >= 0)
    opened = np.zeros(count, dtype=bool) if whole else (row_of == 0) | (right_of == rows - 1)
    closed = ~opened
    children = kids.copy()
    np.add.at(children, parent[inner], 1)
    last = np.searchsorted(row_of, right_of, side="right")  # behind the last node of each subtree
    total = lambda own: np.append(0, np.cumsum(own))[last] - np.append(0, np.cumsum(own))[:-1]
    all_leaves, all_saved = total(leaves + (children == 0)), total(saved + (n - 1) * sizes)

    ends = np.zeros(count, dtype=np.int64)
    if raw:
        np.add.at(ends, node[start + lengths], 1)
    chains = {} if whole and raw else {i: _prefix_keys(paths[i]) for i in ({0, rows - 1} if raw else range(rows))}
    on_chain = lambda v: 0 if row_of[v] == 0 else rows - 1  # noqa: E731  the row whose prefixes an open node is one of
    out: list[dict] = []
    for v in np.flatnonzero(closed).tolist():
        up, made = int(parent[v]), {}
        if raw:
            at = row_of[v]
            made["ends_sha256"] = hashlib.sha256(",".join(map(str, convs[at:at + ends[v]].tolist())).encode()).hexdigest() if ends[v] else NOTHING
        else:
            made["key"] = chains[row_of[v]][depth_of[v]]
        if up >= 0:
            made |= {"parent_key": chains[on_chain(up)][depth_of[up]]} if opened[up] else {"parent_conv_id": int(least[up])}
        out.append(made | {"kind": NODE, "conv_id": int(least[v]), "depth": int(depth_of[v]), "n_convs": int(n[v]), "n_children": int(children[v]),
                           "n_leaves": int(all_leaves[v]), "saved_tokens": int(all_saved[v])})
    if not whole:
        for v in np.flatnonzero(opened & (ends > 0)).tolist():
            for at in range(row_of[v], row_of[v] + ends[v], PIECE):
                piece = convs[at:min(at + PIECE, row_of[v] + ends[v])].tolist()
                out.append({"kind": ENDS, "key": chains[on_chain(v)][depth_of[v]], "conv_id": piece[0], "ends": ",".join(map(str, piece)).encode()})
        within = inner[closed[inner] & opened[parent[inner]]]  # subtrees that hang on an open node
        for mine, theirs in ((kids, 1), (leaves, all_leaves[within]), (saved, all_saved[within])):
            np.add.at(mine, parent[within], theirs)
        for i in dict.fromkeys((0, rows - 1)):
            nodes = node[start[i]:start[i] + lengths[i] + 1]
            mine = (row_of[nodes] == 0) == (i == 0)  # what both rows share goes with the first
            counts = {c: np.where(mine, x[nodes], np.iinfo(np.int64).max if c == "least" else 0) for c, x in zip(COUNTS, (n, least, kids, leaves, saved))}
            out.append({"kind": EDGE, "conv_id": int(convs[i]), "path": paths[i], "sizes": block["sizes"].iloc[i]} | counts)
    return pd.DataFrame({c: pd.Series([r.get(c) for r in out], dtype="Int64" if c in NODES[:-1] else object) for c in COLUMNS})


def _blocks(frames: Iterator[pd.DataFrame], units: int) -> Iterator[pd.DataFrame]:
    held, cost = [], 0
    for frame in frames:
        costs, at = frame["sizes"].map(len).to_numpy() + 1, 0
        while at < len(frame):
            upto = at + int(np.searchsorted(np.cumsum(costs[at:]), units - cost)) + 1
            held.append(frame.iloc[at:upto])
            cost += int(costs[at:upto].sum())
            at = upto
            if cost >= units and sum(map(len, held)) >= LEAST_ROWS:
                yield pd.concat(held, ignore_index=True)
                held, cost = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _level(rows: DataFrame, parts: int, units: int) -> DataFrame:
    """One level: rows dealt by range, folded block by block, stored."""
    whole = parts == 1
    limit = 1 << 62 if whole else units

    def folded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(frames, limit):
            yield fold(block, whole)

    spark = rows.sparkSession
    path = scratch_path(spark, "trie-level")
    rows.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id").mapInPandas(folded, OUT).write.parquet(path)
    return spark.read.schema(OUT).parquet(path)


def prefix_trie(sequences: DataFrame, units: int = UNITS) -> DataFrame:
    """All nodes of the trie of ``turn_sequences``: the columns of NODES."""
    spark = sequences.sparkSession
    rows = pin(sequences.select("conv_id", "path", "sizes"))
    levels: list[DataFrame] = []
    while True:
        size = rows.agg(F.count("*").alias("rows"), F.sum(F.size("sizes") + 1).alias("units")).first()
        if not size["rows"] and not levels:
            return spark.createDataFrame([], OUT).select(*NODES)
        parts = -(-size["units"] // units)
        if not levels:
            parts = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
        parts = max(1, min(parts, size["rows"] // LEAST_ROWS))
        levels.append(_level(rows, parts, units))
        if parts == 1:
            break
        rows = levels[-1].filter(F.col("kind") == EDGE).select("conv_id", "path", "sizes", *COUNTS)
    first = levels[0].filter(F.col("kind") == NODE)
    if len(levels) == 1:
        return first.select(*NODES)

    over = levels[1].filter(F.col("kind") == NODE)
    for level in levels[2:]:
        over = over.unionAll(level.filter(F.col("kind") == NODE))
    over = over.drop("ends_sha256").join(_end_digests(levels[0].filter(F.col("kind") == ENDS)), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    over = pin(over.select(*NODES, "key", "parent_key"))  # nodes over several blocks: a few for each block
    names = checked_broadcast(over.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent")))
    nodes = first.select(*NODES, "parent_key").unionAll(over.select(*NODES, "parent_key"))
    here = nodes.filter("parent_key IS NULL").select(*NODES)
    there = nodes.filter("parent_key IS NOT NULL").join(names, "parent_key").drop("parent_conv_id").withColumnRenamed("_parent", "parent_conv_id")
    return here.unionAll(there.select(*NODES))


def _end_digests(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256) from sorted stretches of keys: one running hash per node, nothing is gathered."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for frame in frames:
            done = []
            for mine, ends in zip(frame["key"], frame["ends"]):
                if mine == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = mine, hashlib.sha256()
                digest.update(ends)
            yield pd.DataFrame(done, columns=["key", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "ends_sha256"])

    return pieces.select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends").mapInPandas(hashed, "key binary, ends_sha256 string")


OP11_SQL = r"""
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT c, list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda a, b:
               list_reduce(range(8), lambda r, i: xor(r >> 1, (r & 1) * 3988292384), xor(a, b)), 4294967295::BIGINT) AS crc FROM ids),
h AS (SELECT c, (xor(crc, 4294967295) % 9)::BIGINT AS h FROM crc),
t AS (SELECT conv_id, strlen(coalesce(text, ''))::BIGINT AS bytes, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS symbol,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT c, 0 AS part, pos, symbol, bytes FROM h JOIN t ON conv_id = c - c % 5 WHERE pos < h
      UNION ALL SELECT c, 1, pos, symbol, bytes FROM h JOIN t ON conv_id = c WHERE pos >= h),
p AS (SELECT c, 0::BIGINT AS d, '' AS path, 0::BIGINT AS bytes FROM ids
      UNION ALL SELECT c, row_number() OVER w, string_agg(symbol, '') OVER w, bytes FROM r WINDOW w AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
l AS (SELECT c, max(d) AS len FROM p GROUP BY c),
n AS (SELECT p.path, p.d, min(p.c) AS conv, count(*) AS n, any_value(p.bytes) AS bytes,
             sha256(coalesce(string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (l.len = p.d), '')) AS ends
      FROM p JOIN l USING (c) GROUP BY p.path, p.d),
k AS (SELECT left(path, length(path) - 64) AS path, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
s AS (SELECT a.path, sum(CASE WHEN k.kids IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.n - 1) * n.bytes) AS saved
      FROM n LEFT JOIN k ON k.path = n.path JOIN p AS a ON a.c = n.conv AND a.d <= n.d GROUP BY a.path)
SELECT n.conv::BIGINT AS conv_id, n.d::BIGINT AS depth, up.conv::BIGINT AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(k.kids, 0)::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN k USING (path) LEFT JOIN n AS up ON n.d > 0 AND up.path = left(n.path, length(n.path) - 64)
"""


@query("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, rebuilt to share their first turns in fives."""
    sequences = turn_sequences(table(spark, sf_dir, "conversations"), "conv_id - conv_id % 5")
    return prefix_trie(graft_heads(sequences, "crc32(cast(cast(conv_id AS string) AS binary)) % 9"))
