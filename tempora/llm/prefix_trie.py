"""Conversation prefix trie by whole-sequence collapse.

Conversations are put in order, rebuilt from another one's opening, collapsed
into distinct sequences with a weight and the list of conversations that end
there; sequences that are proper prefixes of others go by an anti join, which
leaves the leaves; what remains is aggregates over the prefixes of distinct
sequences, so copies cost nothing. Texts leave in the first step: a turn is its
SHA-256 and its length.

Names of prefixes. A turn at depth d counts with two 64-bit hashes of (d, turn);
a prefix is its depth and the two sums, so that a whole sequence is one
aggregate of its turns, and running sums give all its prefixes.

Long conversations. Running sums go per block of 1,024 depths, plus what the
blocks before add up to, so a conversation with a third of all turns is many
tasks' work. Common prefixes are partial aggregates before their shuffle; joins
have one side unique by key, and adaptive execution splits the other. End lists
are put together from pieces of at most 256 ids, which one task streams through
the hash in order.

Saved tokens of a subtree. Each node's own saving is booked on one sequence, that
of its smallest member; a sequence's bookings from depth d on are a running sum,
and a node's subtree is the sum of those of all distinct sequences through it.

Defined results. Null role and text are empty; null turns come first, and turns
of one number follow by role (code points), then by their SHA-256 (a defined
order that moves no texts); repeated turns stay.
Rows without conv_id are in no conversation. Other columns are ignored. An empty
table has no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import map_arrow, store

BLOCK = 1024  # depths summed in one go; turn numbers placed in one go (2**10)
SUM = "decimal(38,0)"
KEY = ["depth", "a", "b"]


def _position(turns: DataFrame) -> DataFrame:
    """Add ``pos``, the place of a turn in its conversation from 0: its place in a run of 1,024 turn numbers plus the runs before."""
    t = turns.withColumn("run", F.coalesce(F.shiftright("turn", 10), F.lit(-(1 << 62))))
    inside = Window.partitionBy("conv_id", "run").orderBy(F.col("turn").asc_nulls_first(), "role", "token")
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = t.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0))).where("start > 0").drop("size")
    placed = t.withColumn("pos", F.row_number().over(inside).cast("long") - 1).drop("turn", "role")
    return placed.join(starts, ["conv_id", "run"], "left").withColumn("pos", F.col("pos") + F.coalesce("start", F.lit(0))).drop("run", "start")


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, token, chars) of every turn."""
    role, body = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    token = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, body), 256))
    return _position(conversations.where("conv_id IS NOT NULL").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), token.alias("token"), F.char_length(body).cast("long").alias("chars")))


def rebuild(turns: DataFrame, modulus: int = 100, openings: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conversations, their rebuilt turns): the first h turns of the conversation ``modulus`` divides, then the own ones after the first h.

    h is crc32 of the decimal id modulo ``openings``, so less than ``openings``
    turns of one conversation in ``modulus`` are handed out.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % openings).alias("h")
    base = (F.col("conv_id") - F.col("conv_id") % modulus).alias("base")
    convs = turns.select("conv_id").distinct().select("conv_id", h, base)
    first = turns.where((F.col("conv_id") % modulus == 0) & (F.col("pos") < openings - 1)).withColumnRenamed("conv_id", "base")
    heads = convs.join(first, "base").where("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "token", "chars")
    length = first.groupBy("base").agg(F.count(F.lit(1)).alias("length"))
    own = turns.select("*", h, base).where("pos >= h").join(length, "base", "left")
    kept = F.least(F.col("h"), F.coalesce("length", F.lit(0)))
    tails = own.select("conv_id", (F.col("pos") - F.col("h") + kept + 1).alias("depth"), "token", "chars")
    return convs.select("conv_id"), heads.unionByName(tails)


def _hashes() -> dict[str, Column]:
    return {c: F.xxhash64(F.lit(c), "depth", "token").cast("decimal(20,0)") for c in ("a", "b")}


def running(rows: DataFrame, key: str, columns: Sequence[str], falling: bool = False) -> DataFrame:
    """Replace ``columns`` by their running sums along ``depth`` (from the end if ``falling``), per ``key``."""
    t = rows.withColumn("block", F.floor(F.col("depth") / BLOCK))
    order = (lambda c: F.col(c).desc()) if falling else (lambda c: F.col(c).asc())
    inside = Window.partitionBy(key, "block").orderBy(order("depth")).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy(order("block")).rowsBetween(Window.unboundedPreceding, -1)
    sums = t.groupBy(key, "block").agg(*[F.sum(c).cast(SUM).alias(f"_{c}") for c in columns], F.count(F.lit(1)).alias("_n"))
    starts = sums.select(key, "block", F.sum("_n").over(before).alias("_n"), *[F.sum(f"_{c}").over(before).cast(SUM).alias(f"_{c}") for c in columns])
    starts = starts.where("_n > 0").drop("_n")
    t = t.withColumns({c: F.sum(c).over(inside).cast(SUM) for c in columns}).join(starts, [key, "block"], "left")
    return t.withColumns({c: (F.col(c) + F.coalesce(f"_{c}", F.lit(0))).cast(SUM) for c in columns}).drop("block", *[f"_{c}" for c in columns])


def _sequences(convs: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b): every conversation's whole sequence; one without turns is the empty one."""
    zero = F.lit(0).cast(SUM)
    whole = rebuilt.withColumns(_hashes()).groupBy("conv_id").agg(F.max("depth").alias("depth"), F.sum("a").cast(SUM).alias("a"), F.sum("b").cast(SUM).alias("b"))
    return convs.join(whole, "conv_id", "left").select("conv_id", F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
                                                       F.coalesce("a", zero).alias("a"), F.coalesce("b", zero).alias("b"))


def _end_lists(sequences: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): the hash of the ascending, comma-joined ids of the conversations that end at a node."""
    piece = F.shiftright("conv_id", 8)  # ids are distinct, so a piece holds 256 of them at most
    pieces = sequences.groupBy(*KEY, piece.alias("piece")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    dealt = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece")

    def digest(batches):
        key, sha = None, None
        for batch in batches:
            done: list[tuple] = []
            for row in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if row[:3] != key:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = row[:3], hashlib.sha256(row[3].encode())
                else:
                    sha.update(b"," + row[3].encode())
            yield _ends(done)
        if key is not None:
            yield _ends([(*key, sha.hexdigest())])

    return map_arrow(dealt, digest, f"depth long, a {SUM}, b {SUM}, ends_sha256 string")


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    types = [pa.int64(), pa.decimal128(38, 0), pa.decimal128(38, 0), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=[*KEY, "ends_sha256"])


def prefix_trie(conversations: DataFrame, modulus: int = 100, openings: int = 6) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see the module)."""
    turns = store(_turns(conversations), "trie-turns")
    convs, rebuilt = rebuild(turns, modulus, openings)
    rebuilt = store(rebuilt, "trie-rebuilt")
    sequences = store(_sequences(convs, rebuilt), "trie-sequences")
    # the collapse: one row per distinct sequence, its weight and its smallest conversation
    distinct = sequences.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("rep"))
    distinct = store(distinct, "trie-distinct")
    steps = rebuilt.withColumnRenamed("conv_id", "rep").join(distinct.select("rep"), "rep", "left_semi").withColumns(_hashes())
    steps = steps.withColumns({"step_a": F.col("a"), "step_b": F.col("b")}).drop("token")
    zero = F.lit(0).cast(SUM)
    root = distinct.select("rep", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"),
                           *[zero.alias(c) for c in ("a", "b", "step_a", "step_b")])
    prefixes = store(running(steps, "rep", ["a", "b"]).unionByName(root), "trie-prefixes")
    # leaves: sequences that are no proper prefix of another
    proper = prefixes.join(distinct.select("rep", F.col("depth").alias("last")), "rep").where("depth < last").select(*KEY).distinct()
    leaves = distinct.join(proper, KEY, "left_anti").select("rep", F.lit(1).alias("leaf"))
    weighed = prefixes.join(distinct.select("rep", "weight"), "rep").join(leaves, "rep", "left")
    nodes = weighed.groupBy(*KEY).agg(
        F.min("rep").alias("conv_id"), F.sum("weight").alias("n_convs"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"),
        F.max("chars").alias("chars"), (F.col("a") - F.max("step_a")).cast(SUM).alias("up_a"), (F.col("b") - F.max("step_b")).cast(SUM).alias("up_b"))
    nodes = store(nodes, "trie-nodes")
    # bookings: each node's own saving on the sequence of its smallest member, summed from the end
    saving = nodes.select(F.col("conv_id").alias("rep"), "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    booked = prefixes.join(saving, ["rep", "depth"], "left").select("rep", *KEY, F.coalesce("saved", F.lit(0)).cast(SUM).alias("saved"))
    through = running(booked, "rep", ["saved"], falling=True)
    # one aggregate per node of what comes from sequences, from children and from end lists
    none = {"saved": F.lit(None).cast(SUM), "child": F.lit(None).cast("long"), "ends_sha256": F.lit(None).cast("string")}
    order = [*KEY, "saved", "child", "ends_sha256"]
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    facts = through.withColumns({k: none[k] for k in ("child", "ends_sha256")}).select(*order)
    facts = facts.unionByName(nodes.where("depth > 0").select(*up).withColumns(none | {"child": F.lit(1).cast("long")}).select(*order))
    facts = facts.unionByName(_end_lists(sequences).withColumns({k: none[k] for k in ("saved", "child")}).select(*order))
    found = facts.groupBy(*KEY).agg(F.sum("saved").cast("long").alias("saved_tokens"), F.count("child").alias("n_children"),
                                    F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(found, KEY).join(parents, ["depth", "up_a", "up_b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("n_leaves").cast("long").alias("n_leaves"), "saved_tokens", "ends_sha256")
