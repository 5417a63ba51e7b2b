"""Conversation prefix trie by whole-sequence collapse.

Turns are numbered, and every prefix of a conversation is named by 128 bits
that are added up over its (position, role, text) hashes, so the names of a
long conversation's prefixes are a running sum that can be taken in blocks.
Identical conversations are grouped into weighted sequences with the list of
their ids; a sequence that is a proper prefix of another is dropped by an
anti join, which leaves the trie's leaves; the prefixes of one representative
per sequence are aggregated with its weight to the nodes.

What a node adds to its ancestors is charged to the smallest leaf below it: the
nodes of one leaf are an end of its path, so sums over subtrees are running
sums along the leaves' paths, added up by node.  No step holds a whole
conversation, a whole group of copies or all children of a node in one task,
but for the hash of a list of ids, which is streamed.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import ROW_KEY, store, with_row_key

#: Turns of a conversation that one window group holds.
BLOCK = 4_096
#: Groups that the children of one node are dealt out to.
SALTS = 64
#: A rebuilt conversation begins with turns of the one whose id is the next smaller multiple of this,
FAMILY = 100
#: fewer than this many.
MOST_SHARED = 6
LANES = ("l1", "l2", "l3", "l4")
NODE = "STRUCT<depth: LONG, l1: LONG, l2: LONG, l3: LONG, l4: LONG>"


@dataclass(frozen=True)
class Trie:
    """``nodes`` (``node`` names one), and ``ends``: the conversations (``conv_id``) that end at a ``node``."""

    nodes: DataFrame
    ends: DataFrame


def _root() -> Column:
    return F.struct(F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(x) for x in LANES))


def _blocks_of(n: Column) -> Column:
    """The blocks that positions 0 to n - 1 fall in; none for n = 0."""
    return F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / BLOCK))))


def _block(pos: Column | str) -> Column:
    return F.floor((F.col(pos) if isinstance(pos, str) else pos) / BLOCK)


def number_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, pos`` (from 0), two 64-bit hashes of role and text, the text's code points, and the row's key.

    Turns are ordered by ``turn``, null first; turns of one number by role,
    then by the hashes.  Null roles and texts are empty; rows without conv_id
    are left out.  Turns are sorted by ranges, so a conversation of any length
    is numbered by as many tasks as its rows ask for.
    """
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    turns = store(
        with_row_key(conversations, conv_col, turn_col, role_col, text_col)
        .where(F.col(conv_col).isNotNull())
        .select(
            F.col(conv_col).cast("long").alias("conv_id"),
            F.col(turn_col).alias("turn"),
            role.alias("role"),
            F.xxhash64(F.lit(1), role, text).alias("c1"),
            F.xxhash64(F.lit(2), role, text).alias("c2"),
            F.length(text).cast("long").alias("n_chars"),
            ROW_KEY,
        ),
        "trie-turns",
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("c1"), F.col("c2"), F.col(ROW_KEY)]
    dealt = store(turns.repartitionByRange("conv_id", *order).withColumn("slice", F.spark_partition_id()), "trie-slices")
    here = Window.partitionBy("conv_id", "slice").orderBy(*order)
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("conv_id", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = dealt.withColumn("rank", F.row_number().over(here)).join(offsets, ["conv_id", "slice"])
    return store(
        ranked.select("conv_id", (F.col("rank") - 1 + F.col("offset")).alias("pos"), "c1", "c2", "n_chars", ROW_KEY), "trie-numbered"
    )


def rebuild(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(every conversation's id and rebuilt length, the rebuilt turns as :func:`number_turns` gives them).

    Conversation c takes the first h turns of conversation c - c % FAMILY (all
    if fewer, none if absent), then its own turns after its first h, where h is
    crc32 of its decimal id modulo MOST_SHARED.  A conversation left without
    turns keeps its id, with length 0.
    """
    lengths = numbered.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"))
    c = F.col("conv_id")
    convs = lengths.select(
        c, "n", (F.crc32(c.cast("string").cast("binary")) % MOST_SHARED).alias("h"), (c - c % FAMILY).alias("base")
    )
    bases = lengths.where(c % FAMILY == 0).select(c.alias("base"), F.col("n").alias("n_base"))
    convs = store(
        convs.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0)))), "trie-conversations"
    )
    own = (
        numbered.withColumn("block", _block("pos"))
        .join(convs.select("conv_id", "h", "shared", _blocks_of(F.col("n")).alias("block")), ["conv_id", "block"])
        .where("pos >= h")
        .withColumn("pos", F.col("pos") - F.col("h") + F.col("shared"))
    )
    heads = numbered.where((c % FAMILY == 0) & (F.col("pos") < MOST_SHARED)).withColumnRenamed("conv_id", "base")
    taken = heads.join(convs.select("conv_id", "base", "h"), "base").where("pos < h")
    columns = ["conv_id", "pos", "c1", "c2", "n_chars", ROW_KEY]
    left = convs.select("conv_id", (F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return left, store(own.select(*columns).unionAll(taken.select(*columns)), "trie-rebuilt")


def _running(df: DataFrame, pos: str, sums: list[str], backwards: bool = False) -> DataFrame:
    """``df`` with ``run_<x>``: the sum of each x along a conversation up to this ``pos`` (from it on, if ``backwards``).

    Sums within blocks, and the sums of whole blocks before, which are few.
    """
    rows = df.withColumn("block", _block(pos))
    order = F.col(pos).desc() if backwards else F.col(pos)
    block = F.col("block").desc() if backwards else F.col("block")
    within = Window.partitionBy("conv_id", "block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "block").agg(*(F.sum(x).alias(x) for x in sums))
    carried = totals.select("conv_id", "block", *(F.sum(x).over(before).alias(f"carry_{x}") for x in sums))
    carried = carried.where(F.col(f"carry_{sums[0]}").isNotNull())  # conversations of one block carry nothing
    ran = rows.withColumns({f"run_{x}": F.sum(x).over(within) for x in sums}).join(carried, ["conv_id", "block"], "left")
    full = {f"run_{x}": F.col(f"run_{x}") + F.coalesce(f"carry_{x}", F.lit(0)) for x in sums}
    return ran.withColumns(full).drop("block", *(f"carry_{x}" for x in sums))


def name_prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, n_chars``: every prefix of every conversation, with the name of the one before.

    A name is the depth and four sums of 32-bit halves of two 64-bit hashes of
    (position, role and text): 128 bits, independent of the order of adding.
    """
    a, b = F.xxhash64("pos", "c1"), F.xxhash64("c2", F.lit(3), "pos")
    half = F.lit(0xFFFFFFFF).cast("long")
    lanes = dict(zip(LANES, (F.shiftrightunsigned(a, 32), a.bitwiseAND(half), F.shiftrightunsigned(b, 32), b.bitwiseAND(half))))
    ran = _running(turns.select("conv_id", "pos", "n_chars", *(v.alias(k) for k, v in lanes.items())), "pos", list(LANES))
    depth = F.col("pos") + 1
    return ran.select(
        "conv_id",
        depth.alias("depth"),
        F.struct(depth.alias("depth"), *(F.col(f"run_{x}").alias(x) for x in LANES)).alias("node"),
        F.struct(F.col("pos").alias("depth"), *((F.col(f"run_{x}") - F.col(x)).alias(x) for x in LANES)).alias("parent"),
        "n_chars",
    )


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``parent_conv_id`` and ``n_children``; a node's children are dealt out to SALTS groups."""
    salted = nodes.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    families = store(salted.where("parent IS NOT NULL").groupBy("parent", "salt").agg(F.count(F.lit(1)).alias("n")), "trie-families")
    named = families.join(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    children = families.groupBy(F.col("parent").alias("node")).agg(F.sum("n").alias("n_children"))
    return (
        salted.join(named.drop("n"), ["parent", "salt"], "left")
        .drop("salt")
        .join(children, "node", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    )


def build(convs: DataFrame, turns: DataFrame) -> Trie:
    """The trie over ``turns`` (as of :func:`rebuild` or :func:`number_turns`) of ``convs`` (``conv_id``).

    Nodes: ``node``, ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over the subtree, (members - 1) times the
    code points of the last text).  Conversations without turns end at the
    root.  Without conversations there is no node.
    """
    prefixes = store(name_prefixes(turns), "trie-prefixes")
    deepest = prefixes.groupBy("conv_id").agg(F.max("node").alias("node"))  # depth comes first in a name
    ends = store(
        convs.select("conv_id").join(deepest, "conv_id", "left").select("conv_id", F.coalesce("node", _root()).alias("node")),
        "trie-ends",
    )
    # Identical conversations collapse to one weighted sequence, told by its smallest id.
    sequences = store(
        ends.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight")), "trie-sequences"
    )
    length = F.col("node.depth")
    told = sequences.select("conv_id", "weight", length.alias("length"), _blocks_of(length).alias("block"))
    paths = store(
        prefixes.withColumn("block", _block(F.col("depth") - 1)).join(told, ["conv_id", "block"]).drop("block"), "trie-paths"
    )
    inner = paths.where("depth < length").select("node").unionAll(paths.where("depth = 1").select(_root().alias("node")))
    leaves = store(sequences.join(inner.distinct(), "node", "left_anti").select("conv_id", "node"), "trie-leaves")
    at_root = sequences.select(
        "conv_id", "weight", F.lit(0).cast("long").alias("depth"), _root().alias("node"),
        F.lit(None).cast(NODE).alias("parent"), F.lit(0).cast("long").alias("n_chars"),
    )
    steps = paths.drop("length").unionByName(at_root)
    # A leaf's path has depths 0 to its length.
    in_leaf = leaves.select("conv_id", _blocks_of(F.col("node.depth") + 1).alias("block"), F.lit(True).alias("leaf"))
    steps = store(
        steps.withColumn("block", _block("depth")).join(in_leaf, ["conv_id", "block"], "left").drop("block"), "trie-steps"
    )
    nodes = store(
        steps.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"),
            F.max("parent").alias("parent"),
            F.sum("weight").alias("n_convs"),
            F.count("leaf").alias("n_leaves"),
            F.min(F.when(F.col("leaf"), F.col("conv_id"))).alias("charged"),
            F.max("n_chars").alias("n_chars"),
        ),
        "trie-nodes",
    )
    saved = (F.col("n_convs") - 1) * F.col("n_chars")
    charges = nodes.select(F.col("charged").alias("conv_id"), F.col("node.depth").alias("depth"), saved.alias("saved")).where("saved > 0")
    along = steps.where("leaf").select("conv_id", "depth", "node").join(charges, ["conv_id", "depth"], "left").na.fill(0, ["saved"])
    below = _running(along, "depth", ["saved"], backwards=True).groupBy("node").agg(F.sum("run_saved").alias("saved_tokens"))
    full = _with_parents(nodes).join(below, "node")
    return Trie(
        full.select(
            "node", "conv_id", F.col("node.depth").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"
        ),
        ends,
    )


def prefix_trie(conversations: DataFrame) -> Trie:
    """The trie of the rebuilt ``conversations``; see :func:`number_turns`, :func:`rebuild` and :func:`build`.

    Repeated rows are turns of their own.  Texts count whole.  An empty table
    gives no nodes; columns beyond conv_id, turn, role and text are not used.
    """
    return build(*rebuild(number_turns(conversations)))


def with_last_turn(nodes: DataFrame, turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` but for the root with ``role`` and ``text`` of their last turn, read from ``conversations``."""
    texts = with_row_key(conversations, "role", "text")
    last = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), ROW_KEY)
    return nodes.join(last, ["conv_id", "depth"]).join(texts, ROW_KEY).drop(ROW_KEY)


def _list_digests(batches):
    """SHA-256 of each node's ids, as they come: (node's columns, digest)."""
    names = ["depth", *LANES]
    held, state, any_id = None, None, False

    def batch(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1])], [*names, "digest"]
        )

    for b in batches:
        if not b.num_rows:
            continue
        keys = np.column_stack([b.column(c).to_numpy() for c in names])
        ids = b.column("conv_id").to_pylist()
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(ids)]
        out = []
        for x, y in zip(edges, edges[1:]):
            key = tuple(keys[x].tolist())
            if key != held:
                if held is not None:
                    out.append((*held, state.hexdigest()))
                held, state, any_id = key, hashlib.sha256(), False
            state.update(("," if any_id else "").encode() + ",".join(map(str, ids[x:y])).encode())
            any_id = True
        if out:
            yield batch(out)
    if held is not None:
        yield batch([(*held, state.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256``: SHA-256 of the comma-joined ascending ids that end at a node.

    The hash of a list needs it in order, so a node's ids are sorted (on disk if
    need be) and streamed by one task, eight bytes each; none holds them all.
    """
    flat = ends.select(*(F.col(f"node.{x}").alias(x) for x in ("depth", *LANES)), "conv_id")
    names = ["depth", *LANES]
    sorted_ids = flat.repartition(*names).sortWithinPartitions(*names, "conv_id")
    schema = ", ".join(f"{x} LONG" for x in names) + ", digest STRING"
    return sorted_ids.mapInArrow(_list_digests, schema).select(F.struct(*names).alias("node"), F.col("digest").alias("ends_sha256"))
