"""Prefix trie of conversations, by union-find over sorted neighbours.

A turn becomes the SHA-256 of role and text, a conversation the string of its turns'
digests. Equal strings are folded, the distinct ones are sorted by range, and every
sorted chunk builds its own trie: the edges between neighbours, weighted by the number
of turns they share, are united in descending order, and each union of two components
creates the branching node at that depth (or widens the one that is there). Nodes off the
paths to a chunk's first and last string are complete. What hangs off those two paths is
summed onto them, and the chunk shrinks to its two outer strings. The outer strings of
all chunks are merged across the boundaries by the same step, until one chunk is left.

A row never holds more than ``BLOCK`` turns: longer conversations continue in further
bands, whose strings start from the digest of all turns before. Bands are worked from the
deepest up; each hands the sums of its roots to the strings above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table, tidy

#: Turns of a row, and turns (with one more for each row) that a chunk holds in memory.
BLOCK = 1_024
CHUNK = 65_536
#: Ids that are written into one piece of text before a node's digest is taken.
IDS = 10_000
DIGEST = 32
LEAD = 8
NO_ID = 2**63 - 1

_SUMS = ("firsts", "ns", "children", "leaves", "saved", "ends")
_BELOW = ("children", "leaves", "saved")
_SEQUENCE = "root binary, string binary, sizes array<long>, depths array<long>, " + ", ".join(
    f"{name} array<long>" for name in _SUMS)
_NODE = ("conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long,"
         " ends_key binary, own_key binary, parent_conv_id long, parent_key binary")
_ROW = f"kind string, {_SEQUENCE}, {_NODE}"


def key_of(root: bytes, prefix: bytes) -> bytes:
    """The name of a node: its band's root and its turns since then."""
    return hashlib.sha256(root + hashlib.sha256(prefix).digest()).digest() if prefix else root


def _keys(root: bytes, string: bytes) -> list[bytes]:
    """The names of all nodes along ``string``, root first."""
    out, running = [root], hashlib.sha256()
    for at in range(0, len(string), DIGEST):
        running.update(string[at:at + DIGEST])
        out.append(hashlib.sha256(root + running.digest()).digest())
    return out


def shared(a: bytes, b: bytes) -> int:
    """Turns that two strings have in common at their start."""
    most, at = min(len(a), len(b)), 0
    while at < most and a[at:at + DIGEST] == b[at:at + DIGEST]:
        at += DIGEST
    return at // DIGEST


class Chunk:
    """The trie of some sorted, distinct (root, string) rows.

    ``rows``: (root, string, sizes, sums), where sums maps a depth to [first, n, children,
    leaves, saved, ends] of what hangs there. ``whole``: no neighbours lie outside.
    """

    def __init__(self, rows: list[tuple], whole: bool, start: int, named: bool, block: int):
        self.rows, self.whole, self.start, self.named, self.block = rows, whole, start, named, block
        self.nodes: list[tuple] = []
        self.totals: list[tuple] = []
        self.left: dict[int, dict[int, list[int]]] = {0: {}, len(rows) - 1: {}}
        self._names: dict[int, list[bytes]] = {}
        self._unite()
        self._sum()

    def _unite(self) -> None:
        rows, m = self.rows, len(self.rows)
        common = [-1] + [
            shared(rows[i - 1][1], rows[i][1]) if rows[i - 1][0] == rows[i][0] else -1 for i in range(1, m)]
        self.depth = [len(r[1]) // DIGEST for r in rows]
        self.low, self.high, self.up = list(range(m)), list(range(m)), [-1] * m
        chief, top = list(range(m)), list(range(m))

        def find(i: int) -> int:
            while chief[i] != i:
                chief[i] = chief[chief[i]]
                i = chief[i]
            return i

        def node(depth: int, below: int) -> int:
            self.depth.append(depth)
            self.low.append(self.low[below])
            self.high.append(self.high[below])
            self.up.append(-1)
            self.up[below] = len(self.depth) - 1
            return len(self.depth) - 1

        for i in sorted((i for i in range(1, m) if common[i] >= 0), key=lambda i: -common[i]):
            a, b = find(i - 1), find(i)
            left, right = top[a], top[b]
            joint = left if self.depth[left] == common[i] else node(common[i], left)
            self.up[right], self.high[joint] = joint, self.high[right]
            chief[b], top[a] = a, joint
        for i in range(m):
            if chief[i] == i and self.depth[top[i]] > 0:
                node(0, top[i])

    def _names_of(self, row: int) -> list[bytes]:
        if row not in self._names:
            self._names[row] = _keys(self.rows[row][0], self.rows[row][1])
        return self._names[row]

    def _sum(self) -> None:
        rows, last = self.rows, len(self.rows) - 1
        count = len(self.depth)
        given: list[dict[int, list[int]]] = [{} for _ in range(count)]
        for i, (_, _, _, sums) in enumerate(rows):
            at = i
            for depth in sorted(sums, reverse=True):
                while self.up[at] >= 0 and depth <= self.depth[self.up[at]]:
                    at = self.up[at]
                self._add(given[at].setdefault(depth, [NO_ID, 0, 0, 0, 0, 0]), sums[depth])
        waiting: list[list[list]] = [[] for _ in range(count)]
        for at in sorted(range(count), key=lambda x: -self.depth[x]):  # those below come first
            root, _, sizes, _ = rows[self.low[at]]
            above = self.depth[self.up[at]] if self.up[at] >= 0 else -1
            outer = 0 if self.low[at] == 0 else last if self.high[at] == last else None
            open_ = outer is not None and not self.whole
            total = given[at].pop(self.depth[at], [NO_ID, 0, 0, 0, 0, 0])
            pending = waiting[at]
            for depth in range(self.depth[at], above, -1):
                if depth < self.depth[at] and depth in given[at]:
                    self._add(total, given[at][depth])
                if open_:
                    if any(total[1:]):
                        self.left[outer][depth] = total
                    self._close(pending, None, self._names_of(self.low[at])[depth])
                    total, pending = [NO_ID, 0, 0, 0, 0, 0], []
                    continue
                first, n, children, leaves, saved, ends = total
                if depth == 0 and self.start:  # the band above has this node
                    self.totals.append((root, children, leaves, saved))
                    self._close(pending, None, root)
                    total, pending = [NO_ID, 0, 0, 0, 0, 0], []
                    continue
                leaves = leaves or 1
                saved += (n - 1) * (sizes[depth - 1] if depth else 0)
                own = self._names_of(self.low[at])[depth] if self.named or ends or depth == self.block else None
                row = [first, self.start + depth, n, children, leaves, saved, own if ends else None, own, None, None]
                self.nodes.append(row)
                self._close(pending, first, None)
                total, pending = [first, n, 1, leaves, saved, 0], [row]
            if self.up[at] >= 0:
                waiting[self.up[at]] += pending
                if total[1]:
                    self._add(given[self.up[at]].setdefault(above, [NO_ID, 0, 0, 0, 0, 0]), total)

    @staticmethod
    def _add(to: list[int], more: list[int]) -> None:
        to[0] = min(to[0], more[0])
        for k in range(1, 6):
            to[k] += more[k]

    @staticmethod
    def _close(rows: list[list], conv: int | None, key: bytes | None) -> None:
        for row in rows:
            row[8], row[9] = conv, key

    def contracted(self) -> list[tuple]:
        """The first and the last row with all that hangs off them; none if whole."""
        return [] if self.whole else [(*self.rows[i][:3], sums) for i, sums in self.left.items()]


def _table(kind: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [f.name for f in _ARROW]
    if kind == "node":
        at, columns = names.index("conv_id"), list(zip(*rows))
    elif kind == "total":
        at = 1
        columns = [[r[0] for r in rows], [None] * len(rows), [None] * len(rows), [None] * len(rows),
                   [None] * len(rows), [None] * len(rows), *[[[r[k]] for r in rows] for k in (1, 2, 3)]]
    else:
        at, columns = 1, [[r[k] for r in rows] for k in range(3)]
        columns.append([list(r[3]) for r in rows])
        columns += [[[s[k] for s in r[3].values()] for r in rows] for k in range(6)]
    arrays = [pa.array([kind] * len(rows), pa.string())]
    for k, field in enumerate(_ARROW):
        if k:
            inside = 0 <= k - at < len(columns)
            arrays.append(pa.array(columns[k - at], field.type) if inside else pa.nulls(len(rows), field.type))
    return pa.RecordBatch.from_arrays(arrays, names)


_KINDS = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
_ARROW = [pa.field(name, _KINDS[kind]) for name, kind in (part.split() for part in _ROW.split(", "))]


def _tries(whole: bool, start: int, named: bool, block: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def done() -> Iterator[pa.RecordBatch]:
            trie = Chunk(rows, whole, start, named, block)
            for kind, found in (("node", trie.nodes), ("total", trie.totals), ("row", trie.contracted())):
                for at in range(0, len(found), 10_000):
                    yield _table(kind, found[at:at + 10_000])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for root, string, sizes, depths, *sums in zip(*columns):
                rows.append((root, string, sizes, {d: list(s) for d, *s in zip(depths, *sums)}))
                size += len(string) // DIGEST + 1
                if size >= chunk and not whole:
                    yield from done()
                    rows, size = [], 0
        if rows:
            yield from done()
    return run


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and the position within the conversation in this task."""
    task, before, behind = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy()
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        lengths = np.diff(np.append(first, len(ids)))
        at = np.arange(len(ids)) - np.repeat(first, lengths)
        if before == ids[0]:
            at[:lengths[0]] += behind
        before, behind = ids[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.array(np.full(len(ids), task)), pa.array(at)],
            ["conv_id", "turn_key", "size", "task", "at"])


def _numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn_key, size, at): positions from 0 by turn, without one task for a conversation.

    Rows are sorted by range, numbered in each range, and moved up where a conversation
    began in an earlier range: at most one such conversation for each range.
    """
    order = ["conv_id", "turn", "turn_key"]
    ranged = materialise(
        turns.select(*order, "size").repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_positions, "conv_id long, turn_key string, size long, task long, at long"), "turns")
    parts = ranged.groupBy("conv_id", "task").count()
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    moved = parts.withColumn("before", F.sum("count").over(before)).where("before > 0")
    return ranged.join(moved.select("conv_id", "task", "before"), ["conv_id", "task"], "left").select(
        "conv_id", "turn_key", "size", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"))


def _lead() -> Column:
    """How many turns of the family's first conversation open conversation ``conv_id``."""
    return F.expr("crc32(cast(conv_id as string)) % 9")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, turn_key, size, at) of the rebuilt conversations, and (conv_id, total).

    ``numbered`` has the original ones. Each opens with turns of conversation
    ``conv_id - conv_id % 5`` and goes on with its own behind as many.
    """
    own = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    own = materialise(own.withColumn("lead", _lead()).withColumn("family", F.expr("conv_id - conv_id % 5")), "ids")
    heads = own.where("conv_id = family").select("family", F.least("n", F.lit(LEAD)).alias("there"))
    lengths = own.join(heads, "family", "left").withColumn(
        "opened", F.least("lead", F.coalesce("there", F.lit(0)))).select(
        "conv_id", "lead", "opened", (F.col("opened") + F.greatest(F.col("n") - F.col("lead"), F.lit(0))).alias("total"))
    lengths = materialise(lengths, "lengths")
    tails = numbered.join(lengths, "conv_id").where("at >= lead").select(
        "conv_id", "turn_key", "size", (F.col("opened") + F.col("at") - F.col("lead")).alias("at"), "total")
    opening = numbered.where(f"conv_id % 5 = 0 and at < {LEAD}").withColumnRenamed("conv_id", "family")
    members = lengths.withColumn("family", F.expr("conv_id - conv_id % 5"))
    openings = members.join(opening, "family").where("at < opened").select(
        "conv_id", "turn_key", "size", "at", "total")
    return tails.unionByName(openings), lengths.select("conv_id", "total")


def _key(root: str, string: str) -> Column:
    return F.expr(
        f"if(length({string}) = 0, {root}, unhex(sha2(concat({root}, unhex(sha2({string}, 256))), 256)))")


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the bands' roots: (conv_id, band, digest of the block) in, root out."""
    before, root = None, b""
    for batch in batches:
        out = []
        for conv, digest in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            root = root if conv == before else b""
            out.append(root)
            before, root = conv, hashlib.sha256(root + digest).digest()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["conv_id", "band", "root"])


def _blocks(turns: DataFrame, lengths: DataFrame, block: int) -> tuple[DataFrame, int]:
    """(conv_id, band, root, string, sizes, ends) and the deepest band."""
    gathered = turns.groupBy("conv_id", F.expr(f"at div {block}").alias("band")).agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("at", "turn_key", "size"))).alias("t"))
    blocks = gathered.select(
        "conv_id", "band", F.expr("unhex(array_join(t.turn_key, ''))").alias("string"),
        F.col("t.size").alias("sizes"), (F.col("band") == F.expr(f"(total - 1) div {block}")).alias("ends"))
    silent = lengths.where("total = 0").select(
        "conv_id", F.lit(0).cast("long").alias("band"), F.lit(b"").alias("string"),
        F.expr("cast(array() as array<bigint>)").alias("sizes"), F.lit(True).alias("ends"))
    blocks = materialise(blocks.unionByName(silent), "blocks")
    deepest = blocks.agg(F.max("band")).collect()[0][0]
    if not deepest:
        return blocks.withColumn("root", F.lit(b"")), 0
    chain = blocks.select("conv_id", "band", F.expr("unhex(sha2(string, 256))").alias("digest"))
    roots = chain.repartition("conv_id").sortWithinPartitions("conv_id", "band").mapInArrow(
        _roots, "conv_id long, band long, root binary")
    return materialise(blocks.join(roots, ["conv_id", "band"]), "rooted"), deepest


def _text_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, ids = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([held], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
            ["ends_key", "first", "ids"])

    for batch in batches:
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (key != held or len(ids) == IDS):
                yield piece()
                ids = []
            held = key
            ids.append(conv)
    if ids:
        yield piece()


def _text_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, running = None, None
    for batch in batches:
        keys, texts = [], []
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if key != held:
                if running is not None:
                    keys.append(held)
                    texts.append(running.hexdigest())
                held, running = key, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.string())],
                                         ["ends_key", "ends_sha256"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary()), pa.array([running.hexdigest()])],
                                         ["ends_key", "ends_sha256"])


def _ends(blocks: DataFrame) -> DataFrame:
    """(ends_key, ends_sha256): the digest of the ids that end at a node, in their order.

    The ids are put into text by range, ``IDS`` to a piece; a node's digest then takes its
    pieces one after the other, in a stream.
    """
    ids = blocks.where("ends").select(_key("root", "string").alias("ends_key"), "conv_id")
    order = ["ends_key", "conv_id"]
    pieces = ids.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _text_pieces, "ends_key binary, first long, ids string")
    return pieces.repartition("ends_key").sortWithinPartitions("ends_key", "first").mapInArrow(
        _text_digests, "ends_key binary, ends_sha256 string")


def _band(rows: DataFrame, band: int, block: int, chunk: int) -> tuple[list[DataFrame], DataFrame | None]:
    """The nodes of a band by level, and the sums of its roots."""
    nodes, totals, level = [], None, 0
    while True:
        size = rows.agg(F.sum(F.expr(f"length(string) div {DIGEST} + 1"))).collect()[0][0] or 0
        whole = size <= chunk
        order = ["root", "string"]
        dealt = rows.repartition(1) if whole else rows.repartitionByRange(-(-size // chunk), *order)
        made = materialise(
            dealt.select(*[f.name for f in _ARROW[1:11]]).sortWithinPartitions(*order).mapInArrow(
                _tries(whole, band * block, level > 0, block, chunk), _ROW), f"trie-{band}-{level}")
        nodes.append(made.where("kind = 'node'").select(*[f.name for f in _ARROW[11:]]))
        if band:
            found = made.where("kind = 'total'").select(
                "root", *[F.col(c)[0].alias(f"{c}_below") for c in _BELOW])
            totals = found if totals is None else totals.unionByName(found)
        if whole:
            return nodes, totals
        rows, level = made.where("kind = 'row'"), level + 1


def prefix_trie(conversations: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """A row for every node of the trie of the rebuilt ``conversations`` (conv_id, turn, role, text).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256). Turns are in the order of ``turn``, null first; equal ones, and repeated
    rows, follow each other by their digest of role and text. Null role and text count as
    empty. Rows without conv_id belong to no conversation and are left out. Long texts
    leave the rows at once, as digests. Further columns are ignored; an empty table gives
    an empty result. Turns count as equal when their SHA-256 is.
    """
    spark = conversations.sparkSession
    turns = tidy(conversations, conv_id="long", turn="long", role="string", text="string").where("conv_id is not null")
    turns = turns.na.fill("", ["role", "text"]).select(
        "conv_id", "turn", F.expr("sha2(concat(octet_length(role), ':', role, text), 256)").alias("turn_key"),
        F.expr("cast(octet_length(text) as bigint)").alias("size"))
    blocks, deepest = _blocks(*rebuilt(_numbered(turns)), block)
    if deepest is None:
        return spark.createDataFrame(
            [], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
            " saved_tokens long, ends_sha256 string")
    folded = materialise(blocks.groupBy("band", "root", "string").agg(
        F.first("sizes").alias("sizes"), F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n"),
        F.max(F.col("ends").cast("long")).alias("end")), "strings")
    nodes, totals = [], None
    for band in range(deepest, -1, -1):
        rows = folded.where(F.col("band") == band)
        if totals is None:
            below = rows.select("*", *[F.lit(0).cast("long").alias(f"{c}_below") for c in _BELOW])
        else:
            below = rows.withColumn("below", _key("root", "string")).join(
                totals.withColumnRenamed("root", "below"), "below", "left").na.fill(
                0, [f"{c}_below" for c in _BELOW])
        once = {"depths": F.expr(f"length(string) div {DIGEST}"), "firsts": F.col("first"), "ns": F.col("n"),
                **{c: F.col(f"{c}_below") for c in _BELOW}, "ends": F.col("end")}
        rows = below.select("root", "string", "sizes", *[F.array(c.cast("long")).alias(n) for n, c in once.items()])
        found, totals = _band(rows, band, block, chunk)
        nodes += found
    every = nodes[0]
    for more in nodes[1:]:
        every = every.unionByName(more)
    named = every.where("own_key is not null").select(
        F.col("own_key").alias("parent_key"), F.col("conv_id").alias("named_parent"))
    return every.join(named, "parent_key", "left").join(_ends(blocks), "ends_key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "named_parent").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


#: CRC-32 of a decimal number, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(range(length({text})), lambda i: ascii(substr({text}, i + 1, 1))::bigint)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))),
  4294967295)"""

OP11_SQL = f"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce("text", '') as "text",
    row_number() over (partition by conv_id order by turn nulls first) - 1 as pos
  from conversations where conv_id is not null),
ids as (
  select conv_id, conv_id - conv_id % 5 as family, count(*) as n,
    {_CRC.format(text="conv_id::varchar")} % 9 as lead
  from turns group by conv_id),
opened as (
  select i.*, least(i.lead, coalesce(f.n, 0)) as opened from ids i left join ids f on f.conv_id = i.family),
rebuilt as (
  select o.conv_id, o.opened + t.pos - o.lead as pos, t.role, t."text"
  from opened o join turns t using (conv_id) where t.pos >= o.lead
  union all
  select o.conv_id, t.pos, t.role, t."text"
  from opened o join turns t on t.conv_id = o.family where t.pos < o.opened),
strings as (
  select o.conv_id, coalesce(list(sha256(length(role) || ':' || role || "text") order by pos)
    filter (where pos is not null), []) as s,
    coalesce(list(strlen("text") order by pos) filter (where pos is not null), []) as sizes
  from opened o left join rebuilt r using (conv_id) group by o.conv_id),
members as (
  select conv_id, d as depth, array_to_string(s[1:d], '') as k, array_to_string(s[1:d - 1], '') as above,
    case when d = 0 then 0 else sizes[d] end as size, d = len(s) as ends
  from (select *, unnest(range(len(s) + 1)) as d from strings)),
nodes as (
  select k, depth, any_value(above) as above, min(conv_id) as conv_id, count(*) as n, any_value(size) as size,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from members group by k, depth),
children as (select above as k, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by all),
known as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join children c using (k, depth)),
sums as (
  select m.k, m.depth, sum((b.n_children = 0)::bigint) as n_leaves, sum((b.n - 1) * b.size) as saved
  from known b join members m on m.conv_id = b.conv_id and m.depth <= b.depth group by all)
select x.conv_id, x.depth::bigint as depth, p.conv_id as parent_conv_id, x.n as n_convs,
  x.n_children::bigint as n_children, s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, x.ends_sha256
from known x join sums s using (k, depth)
left join nodes p on x.depth > 0 and p.depth = x.depth - 1 and p.k = x.above
"""
