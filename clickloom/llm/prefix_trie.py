"""Prefix trie of conversations: time-forward processing of subtree totals over sorted nodes.

A node is a distinct sequence of first turns, known by its depth and a 128-bit hash. Nodes that
share a member lie on that conversation's path, so the trie comes from counting rows, and no text
travels beyond the first step.

Totals flow upwards. Nodes are cut into shards: a node's weight is the number of rows at or below it, its
level the number of times ``shard_rows`` goes into the weight (as a power), and connected nodes of one level
are a shard. Within a shard, nodes are sorted by reverse level order (deepest first, by Spark's external
sort); each node takes from a priority queue what its children have sent, and sends its totals to its
parent's place in the order. What a shard's root sends crosses to the parent's shard, summed by receiver,
and the next level's shards are processed the same way, until the root of the trie is done.
"""

from __future__ import annotations

import heapq
import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.storage import small, stored
from clickloom.operators.running import totals_before, with_chunks
from clickloom.session import ship_package

PREFIX, FAMILY = 6, 100
# Rows of a shard on the lowest level; a shard of level n has fewer than the (n+1)-th power.
SHARD_ROWS = 1000
LEVELS = 4
# Messages that a queue holds before it writes a sorted run, and ids in one piece of a node's list.
QUEUE_HELD, IDS_PER_PIECE = 200_000, 4096
# Positions of one conversation that one task hashes at a time.
_STRETCH = 1 << 16

NODE = ["depth", "k1", "k2"]


class MessageQueue:
    """A priority queue of (place, numbers) that sums messages to one place and spills sorted runs.

    Places have to be taken in rising order, and only messages to places not yet passed may be sent.
    A run goes to an unnamed file of the task itself, as Spark's own sorts do: it is gone with the task,
    and another attempt makes it anew.
    """

    def __init__(self, held: int = QUEUE_HELD):
        self.limit, self.heap, self.sums, self.runs = held, [], {}, []

    def send(self, place: tuple, numbers: tuple) -> None:
        before = self.sums.get(place)
        if before is None:
            if len(self.heap) >= self.limit:
                self._spill()
            heapq.heappush(self.heap, place)
            self.sums[place] = numbers
        else:
            self.sums[place] = tuple(a + b for a, b in zip(before, numbers))

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        for place in sorted(self.heap):
            pickle.dump((place, self.sums[place]), file)
        file.seek(0)
        run = self._read(file)
        self.heap, self.sums = [], {}
        # Runs are merged as one stream, each with its next message in hand.
        first = next(run, None)
        if first is not None:
            self.runs.append([first, run])

    @staticmethod
    def _read(file) -> Iterator[tuple[tuple, tuple]]:
        with file:
            while True:
                try:
                    yield pickle.load(file)
                except EOFError:
                    return

    def take(self, place: tuple) -> tuple | None:
        """The sum of all messages to a place, or None; none to an earlier place may be left."""
        found = []
        if self.heap and self.heap[0] == place:
            heapq.heappop(self.heap)
            found.append(self.sums.pop(place))
        for run in self.runs:
            if run[0][0] == place:
                found.append(run[0][1])
                run[0] = next(run[1], None)
        if self.runs:
            self.runs = [run for run in self.runs if run[0] is not None]
        least = min([self.heap[0]] if self.heap else [], default=None)
        if (least is not None and least < place) or any(run[0][0] < place for run in self.runs):
            raise ValueError("a message's receiver is not among the nodes of its shard")
        return tuple(map(sum, zip(*found))) if found else None


def time_forward(nodes: Iterator[dict], held: int = QUEUE_HELD) -> Iterator[tuple[int, int, int]]:
    """``n_children``, ``n_leaves``, ``saved`` of each node, in the order of ``nodes``: by falling depth, then key.

    A node has ``depth``, ``k1``, ``k2``, the parent's ``p1``, ``p2``, its ``own`` saved amount, ``children``, ``leaves`` and
    ``saved`` that were sent from other shards, and ``top``: whether it is its shard's root.
    """
    queue = MessageQueue(held)
    for node in nodes:
        sent = queue.take((-node["depth"], node["k1"], node["k2"])) or (0, 0, 0)
        children = node["children"] + sent[0]
        leaves = (node["leaves"] + sent[1]) if children else 1
        saved = node["own"] + node["saved"] + sent[2]
        if not node["top"]:
            queue.send((1 - node["depth"], node["p1"], node["p2"]), (1, leaves, saved))
        yield children, leaves, saved


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), two hashes of role and text, ``chars``; no texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    # A conversation of very many turns is split along its turns, any other stays whole.
    ranked = totals_before(with_chunks(own, ["turn"]), ["turn", "role", "text"], [(("conv_id",), {"before": F.lit(1)})])
    return ranked.select(
        "conv_id", (F.col("before") + 1).cast("long").alias("pos"), F.xxhash64(F.lit(11), "role", "text").alias("t1"),
        F.xxhash64(F.lit(12), "role", "text").alias("t2"), F.length("text").cast("long").alias("chars"),
    )


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``conv_id``, ``depth``, ``t1``, ``t2``, ``chars``, ``n`` of the rebuilt conversations; and ``conv_id``, ``n`` of all."""
    turns = stored(_turns(conversations), "turns")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % PREFIX).cast("long")
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    heads = turns.filter(F.col("pos") < PREFIX).select(F.col("conv_id").alias("base"), "pos", "t1", "t2", "chars")
    reach = heads.groupBy("base").agg(F.count("*").alias("there"))
    convs = lengths.withColumns({"base": base, "head": head}).join(reach, "base", "left")
    shift = F.least("head", F.coalesce("there", F.lit(0)))
    convs = stored(convs.select("conv_id", "base", "head", shift.alias("shift"), (shift + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("n")), "rebuilt")
    # At most five turns of a base, for each of the fewer than 200 conversations that begin with it.
    begun = convs.join(heads, "base").filter("pos <= head").select("conv_id", F.col("pos").alias("depth"), "t1", "t2", "chars", "n")
    kept = turns.join(convs, "conv_id").filter("pos > head").select("conv_id", (F.col("pos") - F.col("head") + F.col("shift")).alias("depth"), "t1", "t2", "chars", "n")
    return begun.unionByName(kept), convs.select("conv_id", "n")


def path_rows(conversations: DataFrame) -> DataFrame:
    """A row for each conversation and each node on its path, the root included.

    Keys are exclusive ors of the hashes of turn and position: any prefix's key comes from running totals,
    and those of a very long conversation from totals of its stretches.
    """
    rebuilt, convs = rebuilt_turns(conversations)
    placed = rebuilt.select(
        "conv_id", "depth", F.xxhash64(F.lit(1), "t1", "t2", "depth").alias("h1"), F.xxhash64(F.lit(2), "t1", "t2", "depth").alias("h2"), "chars", "n",
        F.expr(f"cast((depth - 1) div {_STRETCH} as int)").alias("stretch"),
    )
    both = lambda over, of="h": [F.expr(f"bit_xor({of}{i})").over(over).alias(f"x{i}") for i in (1, 2)]
    along = W.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    within = placed.select("*", *both(along))
    stretches = placed.filter(F.col("n") > _STRETCH).groupBy("conv_id", "stretch").agg(*[F.expr(f"bit_xor(h{i})").alias(f"s{i}") for i in (1, 2)])
    earlier = W.partitionBy("conv_id").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = stretches.select("conv_id", "stretch", *[F.expr(f"bit_xor(s{i})").over(earlier).alias(f"c{i}") for i in (1, 2)])
    whole = within.join(carried, ["conv_id", "stretch"], "left")
    key = {i: F.col(f"x{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))) for i in (1, 2)}
    rows = whole.select(
        "conv_id", "depth", *[key[i].alias(f"k{i}") for i in (1, 2)], *[key[i].bitwiseXOR(F.col(f"h{i}")).alias(f"p{i}") for i in (1, 2)], "chars", "n",
    )
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), *[zero.alias(c) for c in ("k1", "k2", "p1", "p2", "chars")], "n")
    return rows.unionByName(roots)


def _same(names: list[str], left: str, right: str) -> list[Column]:
    return [F.col(f"{left}{n}") == F.col(f"{right}{n}") for n in names]


def _levels(nodes: DataFrame, shard_rows: int) -> Column:
    level = F.lit(0)
    for n in range(1, LEVELS + 1):
        level = F.when(F.col("weight") >= shard_rows**n, n).otherwise(level)
    return level


def _ends(rows: DataFrame) -> DataFrame:
    """For each node where conversations end: the hash of their sorted ids. Ids go in pieces, so that
    a node in which very many end is one stream of pieces and never a list."""
    ends = rows.filter("depth = n").select(*NODE, "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def made():
            return pa.RecordBatch.from_pylist([dict(zip(NODE, node), first=ids[0], ids=",".join(map(str, ids)))], schema=piece_schema)

        for batch in batches:
            for *own, conv in zip(*[c.to_pylist() for c in batch.columns]):
                if own != node or len(ids) >= IDS_PER_PIECE:
                    if ids:
                        yield made()
                    node, ids = own, []
                ids.append(conv)
        if ids:
            yield made()

    piece_schema = pa.schema([*[(c, pa.int64()) for c in NODE], ("first", pa.int64()), ("ids", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for *own, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if own == node:
                    digest.update(b"," + ids.encode())
                else:
                    if node is not None:
                        done.append(dict(zip(NODE, node), ends_sha256=digest.hexdigest()))
                    node, digest = own, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist(done, schema=hash_schema)
        if node is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(NODE, node), ends_sha256=digest.hexdigest())], schema=hash_schema)

    hash_schema = pa.schema([*[(c, pa.int64()) for c in NODE], ("ends_sha256", pa.string())])
    in_order = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    cut = stored(in_order.mapInArrow(pieces, "depth long, k1 long, k2 long, first long, ids string"), "end-pieces")
    streams = cut.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return streams.mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS, queue_held: int = QUEUE_HELD) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations.

    Columns, all long but the last: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. A conversation c is rebuilt from the first h
    turns of conversation c - c % 100 (remainder towards zero), h the CRC-32 of c's decimal digits modulo 6,
    and its own turns after its first h. Turns go by ``turn`` (null first), equal ones by role and text; a
    repeated row is a turn of its own; a null role or text is empty. Rows without ``conv_id`` take no part. An
    empty table has no nodes. Texts of any length are whole; other columns are not read.

    Two different prefixes are taken for one with probability of about 2**-128 for each pair. A single
    path of more than ``shard_rows`` turns is walked by one task, as a sorted stream.
    """
    spark = conversations.sparkSession
    ship_package(spark)
    rows = stored(path_rows(conversations), "paths")
    below = F.col("n") - F.col("depth") + 1
    nodes = stored(
        rows.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("chars").alias("chars"),
            F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.sum(below).alias("weight"),
        ),
        "nodes",
    )
    heavy = nodes.filter(F.col("weight") >= shard_rows).select(*NODE, F.col("conv_id").alias("heavy_conv"), _levels(nodes, shard_rows).alias("level"))
    heavy = stored(heavy, "heavy-nodes")
    known = small(heavy)
    # The topmost node of each level on a conversation's path is the root of its shard there.
    level = F.coalesce("level", F.lit(0)).alias("level")
    tops = rows.join(known, NODE, "left").groupBy("conv_id", level).agg(F.min(F.struct(*NODE)).alias("top"))
    placed = nodes.join(known.drop("heavy_conv"), NODE, "left").withColumn("level", level)
    placed = stored(placed.join(tops, ["conv_id", "level"]), "sharded-nodes")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def each():
            for batch in batches:
                kept.append(batch)
                yield from batch.to_pylist()

        # Results come in the order of the rows, so each batch leaves as soon as its last row is done.
        out: list[tuple[int, int, int]] = []
        for totals in time_forward(each(), queue_held):
            out.append(totals)
            if len(out) == len(kept[0]):
                yield finished(kept.pop(0), out)
                out = []

    def finished(batch: pa.RecordBatch, totals: list[tuple[int, int, int]]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*totals)]
        same = [batch.column(c) for c in carried]
        return pa.RecordBatch.from_arrays([*same, *columns], [*carried, "n_children", "n_leaves", "saved_tokens"])

    carried = ["depth", "k1", "k2", "p1", "p2", "conv_id", "n_convs", "top"]
    schema = "depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, top boolean, n_children long, n_leaves long, saved_tokens long"
    highest = heavy.agg(F.max("level")).first()[0] or 0
    done = None
    for number in range(highest + 1):
        own = placed.filter(F.col("level") == number)
        if done is None:
            sent = own.withColumns({c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")})
        else:
            crossing = done.filter("top and depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
            totals = crossing.agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
            sent = own.join(totals, NODE, "left").fillna(0, ["children", "leaves", "saved"])
        ready = sent.select(
            *NODE, "p1", "p2", "conv_id", "n_convs", (F.col("top") == F.struct(*NODE)).alias("is_top"), F.col("top").alias("shard"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("own"), "children", "leaves", "saved",
        ).withColumnRenamed("is_top", "top")
        dealt = ready.repartition("shard").sortWithinPartitions(F.desc("depth"), "k1", "k2").drop("shard")
        part = stored(dealt.mapInArrow(walk, schema), "totals")
        done = part if done is None else done.unionByName(part)

    # A parent with more than shard_rows children is heavy, so that no other parent's key is hot.
    parent = [F.col("depth") - 1 == F.col("h_depth"), F.col("p1") == F.col("h_k1"), F.col("p2") == F.col("h_k2")]
    by_heavy = done.join(small(heavy.select(*[F.col(c).alias(f"h_{c}") for c in NODE], "heavy_conv")), parent, "left").drop("h_depth", "h_k1", "h_k2")
    light = nodes.filter(F.col("weight") < shard_rows).select(*[F.col(c).alias(f"h_{c}") for c in NODE], F.col("conv_id").alias("light_conv"))
    unplaced = by_heavy.filter("heavy_conv is null and depth > 0").join(light, parent, "left").select(*by_heavy.columns, "light_conv")
    others = by_heavy.filter("heavy_conv is not null or depth = 0").withColumn("light_conv", F.lit(None).cast("long"))
    named = unplaced.unionByName(others).join(_ends(rows), NODE, "left")
    return named.select(
        "conv_id", "depth", F.coalesce("heavy_conv", "light_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
