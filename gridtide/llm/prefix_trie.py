"""Trie of shared conversation openings, without collecting a conversation or the members of a node.

A conversation is a run of narrow rows (number of the turn, digest, bytes); a prefix is known by its length and a
running sum of digests.  Identical conversations collapse into one weighted sequence with a list of those
that end there; sequences that are proper prefixes of others are no leaves; nodes are weighted prefixes, added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import share_code, stored
from gridtide.operators.ordered import BLOCK, COPIES, OrderedBlocks, collapse_copies

# Turns that one window task holds together: a longer conversation is summed up chunk by chunk.
CHUNK = 4096
_ENDS = 1 << 16
_SUMS = ("s0", "s1", "s2", "s3")
NODE = ["depth", *_SUMS]


def numbered_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, rows_per_block: int) -> DataFrame:
    """``conv_id``, ``digest``, ``bytes``, ``number`` (from 1) of every turn.

    Turns are ordered by turn (null first) and then by digest.  One order over all conversations is cut into blocks,
    so that a conversation with most of the rows is numbered by many tasks.
    """
    role_text, whole = (F.coalesce(F.col(name), F.lit("")) for name in (role, text))
    # The length of the role keeps (role, text) apart from other splits of the same letters.
    content = F.concat_ws(":", F.length(role_text), F.concat(role_text, whole))
    read = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.octet_length(whole).cast("long").alias("bytes"),
    )
    turns = stored(collapse_copies(read.where("conv_id IS NOT NULL")), "turns")
    order = ["conv_id", "turn", "digest"]
    blocked = OrderedBlocks.fit(turns, order, rows_per_block).attach(turns)
    upto = Window.partitionBy(BLOCK, "conv_id").orderBy("turn", "digest").rowsBetween(Window.unboundedPreceding, 0)
    placed = blocked.withColumn("upto", F.sum(COPIES).over(upto))
    sizes = blocked.groupBy("conv_id", BLOCK).agg(F.sum(COPIES).alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    # Only the conversation that runs into a block from the one before has turns before it.
    before = sizes.withColumn("before", F.sum("size").over(earlier)).where("before > 0").select("conv_id", BLOCK, "before")
    last = F.col("upto") + F.coalesce("before", F.lit(0))
    numbers = F.sequence(last - F.col(COPIES) + 1, last)
    joined = placed.join(before, ["conv_id", BLOCK], "left")
    return stored(joined.select("conv_id", "digest", "bytes", F.explode(numbers).alias("number")), "numbered")


def rebuilt_turns(turns: DataFrame, opening: int, families: int) -> DataFrame:
    """``conv_id``, ``number``, ``length``, ``digest``, ``bytes`` of the rebuilt conversations; a turnless one has number 0 alone.

    Conversation c takes the first h turns of c - c % ``families``, with h = crc32(c) % ``opening``, and its own
    after its first h.  At most ``opening`` - 1 turns of a conversation are copied, to at most 2 * ``families`` others.
    """
    convs = turns.groupBy("conv_id").agg(F.max("number").alias("own"))
    base = F.col("conv_id") - F.col("conv_id") % families
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % opening
    convs = convs.withColumns({"base": base, "h": shared})
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("of_base"))
    # ``taken`` turns come from the base, own ones follow.
    taken = F.least(F.col("h"), F.coalesce("of_base", F.lit(0)))
    length = taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = convs.join(lengths, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), length.alias("length"))
    convs = stored(convs, "convs")
    columns = ["conv_id", "number", "length", "digest", "bytes"]
    heads = turns.where(F.col("number") < opening).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.where("taken > 0"), "base").where("number <= taken").select(*columns)
    own = turns.join(convs, "conv_id").where("number > h")
    own = own.withColumn("number", F.col("number") - F.col("h") + F.col("taken")).select(*columns)
    nothing = {"number": F.lit(0).cast("long"), "digest": F.unhex(F.lit("")), "bytes": F.lit(0).cast("long")}
    empty = convs.where("length = 0").withColumns(nothing).select(*columns)
    return heads.unionByName(own).unionByName(empty)


def _own_sums() -> dict[str, Column]:
    """Four numbers of 32 bits for a turn at its place; nothing for the turnless row."""
    halves = [F.xxhash64(F.lit(salt), "number", "digest") for salt in (1, 2)]
    parts = [part for half in halves for part in (half.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(half, 32))]
    return {name: F.when(F.col("number") > 0, part).otherwise(F.lit(0).cast("long")) for name, part in zip(_SUMS, parts)}


def _running(df: DataFrame, key: str, number: str, names: list[str], chunk: int, backwards: bool = False) -> DataFrame:
    """``names`` replaced by their running sums in the order of ``number``, from its end if ``backwards``.

    A chunk of numbers is one window partition; the sums of whole chunks, few, are added to those that follow.
    """
    part = F.floor(F.col(number) / chunk).cast("long")
    df = df.withColumn("_part", -part if backwards else part)
    way = F.col(number).desc() if backwards else F.col(number)
    inside = Window.partitionBy(key, "_part").orderBy(way).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(key, "_part").agg(*[F.sum(name).alias(f"_{name}") for name in names])
    carried = sums.withColumns({f"_{name}": F.sum(f"_{name}").over(across) for name in names}).where(f"_{names[0]} IS NOT NULL")
    placed = df.withColumns({name: F.sum(name).over(inside) for name in names})
    added = {name: F.col(name) + F.coalesce(f"_{name}", F.lit(0)) for name in names}
    return placed.join(carried, [key, "_part"], "left").withColumns(added).drop("_part", *[f"_{name}" for name in names])


def _end_digests(ends: DataFrame) -> DataFrame:
    """``first``, ``ends_sha256``: for each group, the digest of its ``conv_id`` values in ascending order, comma-joined.

    Ids come together in groups of neighbouring ones, at most ``_ENDS`` each; a worker then reads these in
    order and holds no more than one, however many conversations are alike.
    """
    bucket = F.floor(F.col("conv_id") / _ENDS)
    texts = ends.groupBy("first", bucket.alias("bucket")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    texts = texts.select("first", "bucket", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    schema = pa.schema([("first", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, hashlib.sha256()
        for batch in batches:
            done: list[dict] = []
            for first, ids in zip(batch.column("first").to_pylist(), batch.column("ids").to_pylist()):
                if first != last:
                    if last is not None:
                        done.append({"first": last, "ends_sha256": digest.hexdigest()})
                    last, digest = first, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield pa.RecordBatch.from_pylist(done, schema)
        if last is not None:
            yield pa.RecordBatch.from_pylist([{"first": last, "ends_sha256": digest.hexdigest()}], schema)

    share_code(ends.sparkSession)
    return texts.repartition("first").sortWithinPartitions("first", "bucket").mapInArrow(run, "first long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    opening: int = 9,
    families: int = 5,
    rows_per_block: int = 1_000_000,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, see ``rebuilt_turns``.

    ``conv_id`` is the smallest member, ``depth`` the number of turns, ``parent_conv_id`` the parent's smallest member
    (null for the root), ``n_convs`` the members, ``n_children`` the children, ``n_leaves`` the childless nodes of the
    subtree, ``saved_tokens`` the sum over the subtree of (``n_convs`` - 1) times the bytes of the last text, and
    ``ends_sha256`` digests the ids of members that end here.

    Null roles and texts are empty.  Turns of one number are ordered by their content's digest, repeated rows are
    turns like others, rows without a conversation id take no part.  An empty table gives no rows; other columns are not read.

    Prefixes meet by a running sum of 128 bits of digests.  Each node is verified: its members' last turns
    must have one digest, which by induction over the depth makes them equal from the first turn on.
    """
    turns = numbered_turns(conversations, conv_id, turn, role, text, rows_per_block)
    own = {f"own_{name}": F.col(name) for name in _SUMS}
    rebuilt = rebuilt_turns(turns, opening, families).withColumns(_own_sums()).withColumns(own)
    # One row per conversation and depth, less the root.
    paths = stored(_running(rebuilt, "conv_id", "number", list(_SUMS), chunk).withColumnRenamed("number", "depth"), "paths")

    # Whole sequences: identical conversations are one, known by its smallest member.
    deepest = paths.where("depth = length").select(*NODE, "conv_id")
    sequences = stored(deepest.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight")), "sequences")
    ends = deepest.join(sequences.select(*NODE, F.col("conv_id").alias("first")), NODE).select("first", "conv_id")
    ends = _end_digests(ends)

    # Prefixes of distinct sequences; every sequence starts at the root.
    root = [F.lit(0).cast("long").alias(name) for name in NODE]
    weighted = stored(paths.where("depth > 0").join(sequences.select("conv_id", "weight"), "conv_id"), "prefixes")
    parts = [F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("bytes").alias("bytes")]
    alike = [F.min("digest").alias("least"), F.max("digest").alias("most"), *[F.max(f"own_{name}").alias(f"own_{name}") for name in _SUMS]]
    deeper = weighted.groupBy(*NODE).agg(*parts, *alike)
    collided = F.when(F.col("least") != F.col("most"), F.raise_error(F.lit("Different turns meet in one node.")).cast("long"))
    deeper = deeper.withColumn("bytes", F.coalesce(collided, "bytes"))
    parent = [(F.col("depth") - 1).alias("parent_depth"), *[(F.col(name) - F.col(f"own_{name}")).alias(f"parent_{name}") for name in _SUMS]]
    deeper = deeper.select(*NODE, "conv_id", "n_convs", "bytes", *parent)
    top = sequences.agg(F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs")).where("conv_id IS NOT NULL")
    nothing = [F.lit(None).cast("long").alias(name) for name in ("parent_depth", *[f"parent_{name}" for name in _SUMS])]
    top = top.select(*root, "conv_id", "n_convs", F.lit(0).cast("long").alias("bytes"), *nothing)
    nodes = stored(deeper.unionByName(top), "nodes")

    # A sequence whose end is a proper prefix of another is no leaf.
    parent_key = [F.col(f"parent_{name}").alias(name) for name in NODE]
    children = stored(nodes.where("depth > 0").groupBy(*parent_key).agg(F.count(F.lit(1)).alias("n_children")), "children")
    leaves = sequences.join(children, NODE, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))

    # The nodes of which a sequence is the smallest member are the last ones of its path: their savings are summed
    # from the end of the path, and all of them count at every earlier place of it.
    saved = nodes.select(*NODE, "conv_id", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    summed = _running(saved, "conv_id", "depth", ["saved"], chunk, backwards=True)
    totals = saved.groupBy("conv_id").agg(F.sum("saved").alias("all_saved"), F.min("depth").alias("from_depth"))
    through = stored(totals.join(leaves, "conv_id", "left").fillna(0, ["leaf"]), "totals")
    zero = F.lit(0).cast("long")
    passing = weighted.select(*NODE, "conv_id").join(through, "conv_id")
    passing = passing.select(*NODE, "leaf", F.when(F.col("depth") < F.col("from_depth"), F.col("all_saved")).otherwise(zero).alias("all_saved"))
    at_root = through.select(*root, "leaf", F.when(F.col("from_depth") > 0, F.col("all_saved")).otherwise(zero).alias("all_saved"))
    below = passing.groupBy(*NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum("all_saved").alias("below"))
    below = below.unionByName(at_root.groupBy(*NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum("all_saved").alias("below")))

    # Parents: inside a path they belong to the same sequence; only the first node of a path has to look its parent up.
    starts = through.select("conv_id", F.col("from_depth").alias("depth"))
    parents = nodes.select(*[F.col(name).alias(f"parent_{name}") for name in NODE], F.col("conv_id").alias("parent"))
    firsts = nodes.where("depth > 0").join(starts, ["conv_id", "depth"], "left_semi")
    firsts = firsts.join(parents, [f"parent_{name}" for name in NODE]).select("conv_id", "depth", "parent")
    listed = sequences.select(*NODE, F.col("conv_id").alias("first")).join(ends, "first").select(*NODE, "ends_sha256")
    found = (
        nodes.join(summed.select(*NODE, "saved"), NODE)
        .join(below, NODE)
        .join(children, NODE, "left")
        .join(listed, NODE, "left")
        .join(firsts, ["conv_id", "depth"], "left")
    )
    return found.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("saved") + F.col("below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
