"""The prefix trie of conversations: ternary search trees over dictionary-encoded turns, one for each range of sequences.

Turns get numbers in the order of (role, text), so a conversation is a list of numbers, and equal conversations are one
list with its members counted before anything is built. The lists are sorted by range into shards of bounded size. Each
shard inserts its lists into a ternary search tree, always the middle one of what is left first, which keeps the trees
of siblings balanced; one traversal from the last node to the first then adds members, leaves and words up to the root.

A node that lies inside one shard is done. A prefix that goes on from the last list of one shard to the first of the
next is in both: such nodes, two paths for each shard, are put together by the length of the prefix that the
neighbouring lists share, which also says what both shards have counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laddermill.llm.common import materialize, ship, small, table, words

#: Turns of different sequences in a shard.
SHARD_TURNS = 1 << 16
_INNER, _FIRST, _LAST = 0, 1, 2
_NODES = [("shard", pa.int32()), ("depth", pa.int32()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("member_words", pa.int64()), ("own_words", pa.int64()), ("ends", pa.string()), ("edge", pa.int32()), ("up_edge", pa.int32()), ("on_last", pa.bool_()), ("first", pa.list_(pa.int64())), ("first_words", pa.list_(pa.int64())), ("final", pa.list_(pa.int64()))]
_SCHEMA = "shard int, depth int, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, member_words bigint, own_words bigint, ends string, edge int, up_edge int, on_last boolean, first array<bigint>, first_words array<bigint>, final array<bigint>"


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id, turns: the numbers (id) and words (n) of each conversation's turns in order.

    turns: conv_id, turn, role, text. Turns are ordered by turn, null first, and equal ones by role and text; null roles
    and texts are empty; rows that repeat are turns of their own; rows with a null conv_id belong to no conversation.
    """
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    numbered = rows.select("role", "text").distinct().sort("role", "text").select(F.monotonically_increasing_id().alias("id"), "role", "text", F.size(words(F.col("text"))).cast("long").alias("n"))
    dictionary = materialize(numbered, "turn-ids")  # written, so that numbers stay and a frequent turn's rows can be split among tasks
    encoded = rows.join(dictionary, ["role", "text"])
    order = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"), "id", "n")))
    return encoded.groupBy("conv_id").agg(F.transform(order, lambda x: F.struct(x["id"].alias("id"), x["n"].alias("n"))).alias("turns"))


def with_shared_openings(conversations: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """conversations with the first h turns of each replaced by those of the one whose conv_id is the multiple of `every` before it.

    h is crc32(conv_id) % most. A conversation that is absent gives no turns; shorter ones give and lose all they have.
    """
    conversations = materialize(conversations, "conversations")
    heads = conversations.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("of"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    joined = conversations.join(heads, F.col("of") == F.col("conv_id") - F.col("conv_id") % every, "left")
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return joined.select("conv_id", F.when(F.col("head").isNull(), rest).otherwise(F.concat(F.slice(F.col("head"), F.lit(1), h), rest)).alias("turns"))


def sequences(conversations: DataFrame) -> DataFrame:
    """Each different sequence of turns once: ids, words, n and least of its conversations, ends (a hash of their sorted conv_ids).

    The hash of a list can only be computed along it. The members of one sequence therefore pass through one task, sorted
    by Spark, which can spill; the task itself holds one sequence and one state of the hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def packed() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["ids", "words", "n", "least", "ends"])

        for b in batches:
            for ids, spoken, conv in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or ids != now[0]:
                    if now is not None:
                        done.append((*now[:4], now[4].hexdigest()))
                    now = [ids, spoken, 0, conv, hashlib.sha256()]
                now[4].update(b",%d" % conv if now[2] else b"%d" % conv)
                now[2] += 1
            if done:
                yield packed()
                done = []
        if now is not None:
            done.append((*now[:4], now[4].hexdigest()))
            yield packed()

    rows = conversations.select(F.transform("turns", lambda x: x["id"]).alias("ids"), F.transform("turns", lambda x: x["n"]).alias("words"), "conv_id")
    return rows.repartition("ids").sortWithinPartitions("ids", "conv_id").mapInArrow(run, "ids array<bigint>, words array<bigint>, n bigint, least bigint, ends string")


class Tree:
    """A ternary search tree over numbers. Node 0 is the empty prefix; the children of a node are a search tree below eq."""

    def __init__(self) -> None:
        self.key, self.lo, self.eq, self.hi, self.up, self.depth, self.words = [-1], [-1], [-1], [-1], [-1], [0], [0]

    def _new(self, key: int, up: int, words: int) -> int:
        for column, value in ((self.key, key), (self.lo, -1), (self.eq, -1), (self.hi, -1), (self.up, up), (self.depth, self.depth[up] + 1), (self.words, words)):
            column.append(value)
        return len(self.key) - 1

    def insert(self, ids: list[int], words: list[int]) -> list[int]:
        """The nodes of all prefixes, from the empty one on."""
        path = [0]
        for key, n in zip(ids, words, strict=True):
            up = path[-1]
            side, at = self.eq, up
            while (child := side[at]) >= 0 and self.key[child] != key:
                side, at = (self.lo if key < self.key[child] else self.hi), child
            if child < 0:
                child = side[at] = self._new(key, up, n)
            path.append(child)
        return path


def middles(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of each range before its halves."""
    ranges = [(0, n)]
    while ranges:
        i, j = ranges.pop()
        if i < j:
            yield (middle := (i + j) // 2)
            ranges += [(middle + 1, j), (i, middle)]


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard; the rows are `sequences`, ascending by ids."""
    ids, spoken, n, least, ends = columns = [[] for _ in range(5)]
    for b in batches:
        for column, values in zip(columns, b.columns, strict=True):
            column += values.to_pylist()
    if not ids:
        return
    tree, stops, paths = Tree(), {}, {}
    for i in middles(len(ids)):
        path = tree.insert(ids[i], spoken[i])
        stops[path[-1]] = i
        if i in (0, len(ids) - 1):
            paths[i] = path
    size = len(tree.key)
    members, first, kids, leaves, member_words, own_words = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size, [0] * size
    for node in range(size - 1, -1, -1):  # every node stands behind its parent
        if node in stops:
            i = stops[node]
            members[node] += n[i]
            first[node] = least[i] if first[node] is None else min(first[node], least[i])
        leaves[node] = leaves[node] or 1
        member_words[node] += members[node] * tree.words[node]
        own_words[node] += tree.words[node]
        if (up := tree.up[node]) >= 0:
            members[up] += members[node]
            first[up] = first[node] if first[up] is None else min(first[up], first[node])
            kids[up] += 1
            leaves[up] += leaves[node]
            member_words[up] += member_words[node]
            own_words[up] += own_words[node]
    edge = [_INNER] * size
    for i, mark in ((len(ids) - 1, _LAST), (0, _FIRST)):
        for node in paths[i]:
            edge[node] = mark
    on_last = set(paths[len(ids) - 1])
    none = [None] * (size - 1)
    columns = [[TaskContext.get().partitionId()] * size, tree.depth, first, [first[u] if u >= 0 else None for u in tree.up], members, kids, leaves, member_words, own_words]
    columns += [[ends[stops[x]] if x in stops else None for x in range(size)], edge, [edge[u] if u >= 0 else _INNER for u in tree.up], [x in on_last for x in range(size)], [ids[0], *none], [spoken[0], *none], [ids[-1], *none]]
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, _NODES, strict=True)], [name for name, _ in _NODES])
    for at in range(0, size, 10_000):
        yield whole.slice(at, 10_000)


def merged(nodes: DataFrame) -> DataFrame:
    """The nodes of all shards (shard_nodes) as the nodes of one trie."""
    # A row for each shard: how many turns its first sequence shares with the last one of the shard before.
    bounds = nodes.filter("depth = 0").select("shard", "first", "first_words", "final", F.lag("final").over(W.orderBy("shard")).alias("before"))
    m = F.least(F.size("first"), F.size("before"))
    differs = F.array_position(F.zip_with(F.slice(F.col("first"), F.lit(1), m), F.slice(F.col("before"), F.lit(1), m), lambda a, b: a != b), True)
    bounds = bounds.withColumn("shared", F.when(F.col("before").isNull(), -1).when(differs == 0, m).otherwise(differs - 1).cast("int"))
    goes_on = F.lead(F.col("shared") == F.size("before")).over(W.orderBy("shard"))  # the last sequence is a prefix of the next shard's first: no leaf
    bounds = bounds.select("shard", "first_words", "shared", F.coalesce(goes_on, F.lit(False)).alias("goes_on"))

    edges = nodes.filter(F.col("edge") > _INNER).drop("first", "first_words", "final").join(small(bounds), "shard")
    again = (F.col("edge") == _FIRST) & (F.col("depth") <= F.col("shared"))
    low = F.greatest("depth", F.lit(1))
    twice = F.when(again, F.aggregate(F.slice(F.col("first_words"), low, F.greatest(F.col("shared") - low + 1, F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(0)
    island = F.sum(F.when(again, 0).otherwise(1)).over(W.partitionBy("depth").orderBy("shard", "edge"))
    edges = materialize(edges.withColumns({"again": again, "twice": twice, "island": island}).drop("first_words"), "edges")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    whole = edges.groupBy("depth", "island").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), (F.sum("n_children") - count(F.col("again") & (F.col("depth") < F.col("shared")))).alias("n_children"),
        (F.sum("n_leaves") - count(F.col("on_last") & F.col("goes_on"))).alias("n_leaves"), (F.sum("member_words") - F.sum("own_words") + F.sum("twice")).alias("saved_tokens"), F.max("ends").alias("ends"), F.min(F.struct("shard", "up_edge")).alias("some"),
    )
    whole = materialize(whole, "boundary-nodes")
    names = edges.join(whole.select("depth", "island", F.col("conv_id").alias("parent")), ["depth", "island"]).select("shard", (F.col("depth") + 1).alias("depth"), F.col("edge").alias("up_edge"), "parent")

    kept = ["depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "up_edge", "shard"]
    inner = nodes.filter(F.col("edge") == _INNER).withColumn("saved_tokens", F.col("member_words") - F.col("own_words")).select(*kept, "parent_conv_id")
    every = inner.union(whole.select(*kept[:-2], "some.up_edge", "some.shard", F.lit(None).cast("long")))
    joined = every.join(small(names), ["shard", "depth", "up_edge"], "left")
    return joined.select("conv_id", F.col("depth").cast("long").alias("depth"), F.coalesce("parent", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of conversations (conv_id, turns; see conversations_of).

    conv_id: its smallest member; depth; parent_conv_id (root: null); n_convs: its members; n_children; n_leaves: childless
    nodes in its subtree, itself included; saved_tokens: summed over its subtree, (n_convs - 1) times the words of each
    node's last turn; ends_sha256: of the conv_ids of its members that end there, ascending, comma-joined. Conversations
    without turns are members of the root. No conversations: no rows. One conversation's numbers are held by one row.
    """
    ship(conversations.sparkSession)
    every = materialize(sequences(conversations), "sequences")
    turns = every.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = every.repartitionByRange(max(1, -(-turns // shard_turns)), "ids").sortWithinPartitions("ids")
    return merged(materialize(shards.mapInArrow(shard_nodes, _SCHEMA), "trie-nodes"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_openings(conversations_of(table(spark, sf_dir, "conversations"))))


QUERIES = {"op13_prefix_trie": op13_prefix_trie}

_CRC = "xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(cast(conv_id as varchar), ''), lambda c: [cast(ascii(c) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, v: case when v >= 0 then xor(a, v) else xor(a >> 1, (a & 1) * 3988292384) end), 4294967295)"
ORACLE = {
    "op13_prefix_trie": rf"""
with t as materialized (select conv_id, coalesce(role, '') r, coalesce(text, '') x, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) pos from conversations where conv_id is not null),
     ids as materialized (select conv_id, {_CRC} % 4 h from (select distinct conv_id from t)),
     rebuilt as (select ids.conv_id, pos, r, x from ids join t on t.conv_id = ids.conv_id - ids.conv_id % 20 and pos <= h union all select conv_id, pos, r, x from ids join t using (conv_id) where pos > h),
     prefixes as (select conv_id, row_number() over w d, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) n, list({{'r': r, 'x': x}}) over (partition by conv_id order by pos rows between unbounded preceding and current row) k from rebuilt window w as (partition by conv_id order by pos)),
     held as materialized (select conv_id, d, n, min(conv_id) over (partition by d, k) rep from prefixes union all select conv_id, 0, 0, min(conv_id) over () from ids),
     nodes as materialized (select rep, d, count(*) n_convs, any_value(n) n from held group by rep, d),
     linked as materialized (select nodes.*, up.rep parent from nodes left join held up on up.conv_id = nodes.rep and up.d = nodes.d - 1),
     kids as (select parent rep, d - 1 d, count(*) n_children from linked where parent is not null group by all),
     below as (select a.rep, a.d, count(*) filter (n_children is null) n_leaves, cast(sum((l.n_convs - 1) * l.n) as bigint) saved from linked l left join kids on kids.rep = l.rep and kids.d = l.d join held a on a.conv_id = l.rep and a.d <= l.d group by a.rep, a.d),
     ends as (select rep, d, string_agg(cast(conv_id as varchar), ',' order by conv_id) e from held join (select conv_id, max(d) d from held group by conv_id) using (conv_id, d) group by rep, d)
select rep conv_id, d depth, parent parent_conv_id, n_convs, coalesce(n_children, 0) n_children, n_leaves, saved saved_tokens, sha256(coalesce(e, '')) ends_sha256
from linked left join kids using (rep, d) join below using (rep, d) left join ends using (rep, d)
"""
}
