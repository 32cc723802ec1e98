"""The prefix trie of conversations by a van Emde Boas recursion.

A sequence of turns is cut at half of its depth, and again at half of each half, down to single
turns. A cut prefix is named by the tree that the piece hangs in and the block of turns in front of
the cut; equal prefixes get equal names wherever they stand. The name of the cut is the tree of the
lower piece, so upper tries and lower forests go on side by side, and a piece of one turn is an
edge of the trie: from its tree to the cut behind it.

``WIDTH`` turns are one row, whose pieces are named in one vectorised step for each halving. Longer
sequences are rows of rows: the names of ``WIDTH`` blocks form a row of the next level, trees come
down level by level. No task needs more than one row at a time, however long a sequence is, and
the number of Spark rounds is the logarithm of the greatest length to the base ``WIDTH``.

Totals are grafted upwards along the same cuts: the bytes of the blocks in front of a piece are
handed down to it, and every node adds up what its sequences share below it. A sequence owns a node
if it is the smallest through it; on its way down it owns all nodes from the first one on, and
shares the bytes above that one. So sums of a node over its whole subtree come from one grouping of
the turns and need no pass for each depth. Nodes are reduced within tasks before they are shuffled:
a turn that a third of all conversations begin with is one row a task.

Rows without a conversation id are left out. Missing roles and texts are empty, missing turns come
first; equal turns are ordered by the hash of role and text, and equal rows all count. Other columns
do not matter. Names have 128 bits. No conversation, no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared
from .ordering import numbered

#: Turns, or blocks, of one row; a power of two.
WIDTH = 64
#: Ids that are joined to one text before they are digested.
PACK = 1 << 14

ROOT = np.array([1, 2], np.uint64)
#: Rebuilding: conversations of so many ids share a base, of which they take up to 8 turns.
BASES, HEADS = 5, 9

_FACTORS = shared.MULTIPLIERS[:6]
_GIVEN = {"tree": "binary", "cut": "binary", "before": "bigint", "more": "boolean", "total": "bigint"}
_OWNED = {"own_depth": "bigint", "own_before": "bigint", "own_leaf": "boolean"}


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of pairs of names, in the last axis of two words."""
    f = _FACTORS
    out = np.empty(np.broadcast_shapes(left.shape, right.shape), np.uint64)
    la, lb, ra, rb = left[..., 0], left[..., 1], right[..., 0], right[..., 1]
    out[..., 0] = shared.mix(shared.mix(la ^ f[0]) + ra * f[1] + rb * f[2] + lb)
    out[..., 1] = shared.mix(shared.mix(lb ^ f[3]) + rb * f[4] + ra * f[5] + la)
    return out


def _blocks(names: np.ndarray) -> list[np.ndarray]:
    """Names of the aligned blocks of 1, 2, 4, ... places of each row."""
    levels = [names]
    while levels[-1].shape[1] > 1:
        levels.append(_joined(levels[-1][:, 0::2], levels[-1][:, 1::2]))
    return levels


def _names(values: pa.Array) -> np.ndarray:
    fixed = values.cast(pa.binary(16))
    data = np.frombuffer(fixed.buffers()[1] or b"", np.uint64)
    return data[2 * fixed.offset : 2 * (fixed.offset + len(fixed))].reshape(-1, 2)


def _binary(names: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(names).tobytes()
    return pa.Array.from_buffers(pa.binary(16), len(names), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _numbers(batch: pa.RecordBatch, name: str, missing) -> np.ndarray:
    return _column(batch, name).fill_null(missing).to_numpy(zero_copy_only=False)


class _Rows:
    """The blocks of a batch of rows, in a grid that is as wide as its longest row."""

    def __init__(self, batch: pa.RecordBatch):
        items = _column(batch, "items")
        _, names, sizes = items.flatten().flatten()
        self.counts = items.value_lengths().fill_null(0).to_numpy()
        self.n = len(self.counts)
        width = 1 << int(max(self.counts.max(initial=1), 1) - 1).bit_length()
        self.row = np.repeat(np.arange(self.n), self.counts)
        self.at = np.arange(len(self.row)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        grid = np.zeros((self.n, width, 2), np.uint64)
        grid[self.row, self.at] = _names(names)
        self.levels, self.width = _blocks(grid), width
        self.sizes = sizes.to_numpy()
        self.sums = np.bincount(self.row, self.sizes, self.n).astype(np.int64) if self.n else np.zeros(0, np.int64)

    def whole(self) -> np.ndarray:
        """Names of blocks of full width; those of shorter rows are never part of a cut."""
        return self.levels[-1][:, 0]

    def cuts(self, trees: np.ndarray, ends: np.ndarray, given: np.ndarray) -> np.ndarray:
        """For each row the name of the prefix in front of its block 0, 1, ... and behind the last.
        The recursion goes breadth first: all pieces of one size are cut in one step."""
        out = np.empty((self.n, self.width + 1, 2), np.uint64)
        out[:, 0] = trees
        # The end of a row is a cut of the row above; the first row's is its own.
        out[:, self.width] = _joined(trees, self.whole())
        if self.width == WIDTH:
            out[given, self.width] = ends[given]
        for level in range(len(self.levels) - 2, -1, -1):
            half = 1 << level
            out[:, half : self.width : 2 * half] = _joined(
                out[:, 0 : self.width : 2 * half], self.levels[level][:, 0::2]
            )
        return out


def _upwards(rows: DataFrame) -> DataFrame:
    """The rows of the next level: ``WIDTH`` neighbouring rows' blocks each. Sequences of one
    row that is not full have no next level."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _Rows(batch)
            yield pa.RecordBatch.from_arrays(
                [_column(batch, "conv_id"), _column(batch, "place"), _binary(found.whole()), pa.array(found.sums)],
                ["conv_id", "place", "name", "size"],
            )

    wide = rows.filter((F.col("place") > 0) | (F.size("items") == WIDTH))
    return _rows(shared.arrow_map(wide, work, "conv_id long, place long, name binary, size long"))


def _rows(blocks: DataFrame) -> DataFrame:
    """(conv_id, place, items): ``WIDTH`` places of a sequence of (conv_id, place, name, size)."""
    item = F.struct((F.col("place") % WIDTH).alias("at"), "name", "size")
    row = F.floor(F.col("place") / WIDTH).alias("place")
    return blocks.groupBy("conv_id", row).agg(F.sort_array(F.collect_list(item)).alias("items"))


def _with(rows: DataFrame, columns: dict[str, str], source: DataFrame | None, on: list[str]) -> DataFrame:
    if source is None:
        return rows.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind in columns.items()))
    return rows.join(source, on, "left")


def _downwards(rows: DataFrame, leaves: bool) -> DataFrame:
    """What each block of the rows is given: its tree, the cut behind it, the bytes in front of it,
    whether its sequence goes on, and that one's bytes. Of ``leaves``, which are turns, the
    edges of the trie with what the node takes from the sequence."""
    plain = "conv_id long, place long, tree binary, cut binary, before long, more boolean, total long"
    edges = (
        "conv_id long, depth long, up_a long, up_b long, a long, b long, size long, before long, last boolean, "
        "branch boolean, child int, leaf int, shared long"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _Rows(batch)
            row, at = found.row, found.at
            given = _column(batch, "tree").is_valid().to_numpy(zero_copy_only=False)
            trees, ends = (_names(_column(batch, c).fill_null(ROOT.tobytes())) for c in ("tree", "cut"))
            cuts = found.cuts(trees, ends, given)
            tree, cut = cuts[row, at], cuts[row, at + 1]
            sums = np.cumsum(found.sizes) - found.sizes
            before = sums - (np.cumsum(found.sums) - found.sums)[row] + _numbers(batch, "before", 0)[row]
            more = (at < found.counts[row] - 1) | _numbers(batch, "more", False)[row]
            total = np.where(given, _numbers(batch, "total", 0), found.sums)[row]
            ids, place = _numbers(batch, "conv_id", 0)[row], _numbers(batch, "place", 0)[row] * WIDTH + at
            if not leaves:
                columns = [pa.array(ids), pa.array(place), _binary(tree), _binary(cut)]
                columns += [pa.array(before), pa.array(more), pa.array(total)]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "place", *_GIVEN])
                continue
            depth = place + 1
            # A sequence that owns no node shares all its turns.
            owned = _numbers(batch, "own_depth", np.iinfo(np.int64).max)[row]
            start = np.where(_column(batch, "own_before").is_valid().to_numpy(zero_copy_only=False)[row],
                             _numbers(batch, "own_before", 0)[row], total)
            columns = [ids, depth, *tree.view(np.int64).T, *cut.view(np.int64).T, found.sizes, before, ~more]
            columns += [owned == depth, (more & (owned <= depth + 1)).astype(np.int32)]
            columns += [_numbers(batch, "own_leaf", False)[row].astype(np.int32), np.where(owned > depth, start - before, 0)]
            names = [part.split()[0] for part in edges.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)

    return shared.arrow_map(rows, work, edges if leaves else plain)


def _digests(ends: DataFrame) -> DataFrame:
    """(a, b, digest): SHA-256 of the ids that end in a node, in order and comma-joined. Ids are
    joined where a range of them lies; a node's texts then run through its digest in order, so that
    no task holds more than one text of a node."""
    sort = ["a", "b", "conv_id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def packed() -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_pylist([{"a": node[0], "b": node[1], "first": ids[0], "ids": text}])

        for batch in batches:
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (node != (a, b) or len(ids) == PACK):
                    yield packed()
                    ids = []
                node = (a, b)
                ids.append(conv)
        if ids:
            yield packed()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"a": node[0], "b": node[1], "digest": sha.hexdigest()}])

        for batch in batches:
            for a, b, text in zip(*(_column(batch, c).to_pylist() for c in ("a", "b", "ids"))):
                if node == (a, b):
                    sha.update(b",")
                else:
                    if node:
                        yield done()
                    node, sha = (a, b), hashlib.sha256()
                sha.update(text.encode())
        if node:
            yield done()

    ranged = ends.select(*sort).repartitionByRange(*sort).sortWithinPartitions(*sort)
    packs = shared.arrow_map(ranged, pack, "a long, b long, first long, ids string")
    dealt = packs.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return shared.arrow_map(dealt, digest, "a long, b long, digest string")


def _listed(ids: Column) -> Column:
    return F.sha2(F.coalesce(ids.cast("string"), F.lit("")), 256)


def trie(sequences: DataFrame, members: DataFrame) -> DataFrame:
    """Every node of the trie of ``sequences`` (conv_id, place from 0 on without gaps, name of 16
    bytes, size); ``members`` has each conv_id once with its number of places, 0 too."""
    levels = [shared.stored(_rows(sequences), "rows")]
    top = levels[0].agg(F.max("place")).first()[0] or 0
    while top > 0:
        levels.append(shared.stored(_upwards(levels[-1]), "rows"))
        top //= WIDTH
    given = None
    for rows in levels[:0:-1]:
        given = shared.stored(_downwards(_with(rows, _GIVEN, given, ["conv_id", "place"]), False), "trees")
    rows = _with(levels[0], _GIVEN, given, ["conv_id", "place"])

    edges = _downwards(_with(rows, _OWNED, None, []), True)
    first = edges.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("before").alias("before"),
        F.bool_and("last").alias("leaf"),
    )
    owners = first.groupBy("conv_id").agg(
        F.min("depth").alias("own_depth"), F.min("before").alias("own_before"), F.bool_or("leaf").alias("own_leaf")
    )
    edges = _downwards(_with(rows, _OWNED, shared.stored(owners, "owners"), ["conv_id"]), True)
    nodes = shared.stored(
        edges.groupBy("a", "b").agg(
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            F.min("up_a").alias("up_a"),
            F.min("up_b").alias("up_b"),
            F.count("*").alias("n_convs"),
            F.sum("child").alias("n_children"),
            F.sum("leaf").alias("n_leaves"),
            F.sum("shared").alias("saved_tokens"),
            F.bool_or("branch").alias("branch"),
            F.count_if("last").alias("n_ends"),
            F.min(F.when(F.col("last"), F.col("conv_id"))).alias("end"),
        ),
        "nodes",
    )
    numbers = ["n_convs", "n_children", "n_leaves", "saved_tokens"]

    # The root, one row, from one row of each side.
    empty = members.filter("n_places = 0")
    least, n_convs = members.agg(F.min("conv_id"), F.count("*")).first()
    n_ends, end = empty.agg(F.count("*"), F.min("conv_id")).first()
    below = nodes.filter("depth = 1").agg(F.count("*"), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    a, b = ROOT.view(np.int64).tolist()
    root = [(a, b, least, 0, n_convs, below[0], max(below[1] or 0, 1), below[2] or 0, n_ends, end, None)]
    kinds = ["a", "b", "conv_id", "depth", *numbers, "n_ends", "end", "parent_conv_id"]
    root = members.sparkSession.createDataFrame(root if n_convs else [], ", ".join(f"{k} long" for k in kinds))

    # The top of a branch hangs in another sequence's node; below it, parents have the same owner.
    deep = F.col("branch") & (F.col("depth") > 1)
    parent = F.when(F.col("depth") == 1, F.lit(least).cast("long")).otherwise(F.col("conv_id"))
    hung = nodes.filter(~deep).withColumn("parent_conv_id", parent)
    above = nodes.filter("n_convs > 1").select(
        F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id")
    )
    hung = hung.unionByName(nodes.filter(deep).join(above, ["up_a", "up_b"]))
    everything = hung.select(*root.columns).unionByName(root)

    ends = shared.stored(
        _downwards(_with(rows, _OWNED, None, []), True).filter("last").select("conv_id", "a", "b")
        .unionByName(empty.select("conv_id", F.lit(a).alias("a"), F.lit(b).alias("b"))),
        "ends",
    )
    crowded = ends.groupBy("a", "b").count().filter("count > 1").drop("count")
    digests = _digests(ends.join(crowded, ["a", "b"], "left_semi"))
    return everything.join(digests, ["a", "b"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        *(F.col(c).cast("long").alias(c) for c in numbers),
        F.when(F.col("n_ends") > 1, F.col("digest")).otherwise(_listed(F.col("end"))).alias("ends_sha256"),
    )


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, name, size) of the turns in their order; the name is a hash of role and
    text, the size that of the text in bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("name"),
        F.octet_length(text).cast("long").alias("size"),
    )
    return numbered(rows, [F.asc_nulls_first("turn"), F.asc("name")], "place", "conv_id").drop("turn")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with the beginning of each conversation taken from its base, and the length of each."""
    head = shared.fold("conv_id", HEADS)
    lent = (
        rows.filter((F.col("place") < HEADS - 1) & (F.col("conv_id") % BASES == 0))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "name", "size"))).alias("lent"))
    )
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("own")).withColumn("head", head.cast("int"))
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % BASES).join(lent, "base", "left")
    taken = F.when(F.col("lent").isNotNull(), F.slice("lent", 1, F.col("head")))
    convs = shared.stored(convs.select("conv_id", "own", "head", taken.alias("lent")), "bases")
    n_lent = F.coalesce(F.when(F.col("lent").isNotNull(), F.size("lent")), F.lit(0))
    # Where the base is shorter than what is taken from it, the own turns move up.
    short = convs.filter((n_lent < F.col("head")) & (F.col("own") > F.col("head"))).select(
        "conv_id", (F.col("head") - n_lent).alias("short")
    )
    own = rows.filter(F.col("place") >= head).join(short, "conv_id", "left")
    own = own.select("conv_id", (F.col("place") - F.coalesce("short", F.lit(0))).alias("place"), "name", "size")
    taken = convs.select("conv_id", F.explode("lent").alias("x")).select("conv_id", "x.place", "x.name", "x.size")
    places = n_lent + F.greatest(F.col("own") - F.col("head"), F.lit(0))
    return own.unionByName(taken), convs.select("conv_id", places.alias("n_places"))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Contract query: the trie of the rebuilt conversations."""
    return trie(*rebuilt(turns(shared.read(spark, sf_dir, "conversations"))))


#: CRC-32 of an id's decimal digits, bit by bit (the polynomial is a fixed value).
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT,
  list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda k: 0::UBIGINT)),
    lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)))))"""

ORACLE = f"""
WITH src AS (
  SELECT conv_id, key, strlen(text) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS place
  FROM (
    SELECT conv_id, turn, coalesce(text, '') AS text,
      sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key
    FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT conv_id, conv_id - conv_id % {BASES} AS base, {_CRC} % {HEADS} AS head
  FROM (SELECT DISTINCT conv_id FROM src)
), paths AS (
  SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(key, '') OVER w) AS node, size
  FROM (
    SELECT c.conv_id, 0 AS part, place, key, size FROM convs c JOIN src s ON s.conv_id = base AND place < head
    UNION ALL
    SELECT c.conv_id, 1, place, key, size FROM convs c JOIN src s ON s.conv_id = c.conv_id AND place >= head)
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM convs
), steps AS (
  SELECT *, lag(node) OVER w AS up, depth = max(depth) OVER (PARTITION BY conv_id) AS last
  FROM paths WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
  SELECT node, min(conv_id) AS conv_id, min(depth) AS depth, min(up) AS up, count(*) AS n_convs, min(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM steps GROUP BY node
), children AS (
  SELECT up AS node, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up
), totals AS (
  SELECT upper AS node, CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens,
    count(*) FILTER (children.node IS NULL) AS n_leaves
  FROM (SELECT DISTINCT u.node AS upper, v.node AS lower FROM steps u JOIN steps v ON u.conv_id = v.conv_id AND v.depth >= u.depth)
  JOIN nodes ON nodes.node = lower LEFT JOIN children ON children.node = lower GROUP BY upper
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.up LEFT JOIN children c ON c.node = n.node JOIN totals t ON t.node = n.node
"""
