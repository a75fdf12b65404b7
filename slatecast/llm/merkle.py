"""Merkle manifest of a dataset by time-forward processing.

Leaves are numbered within their source; a node's label is the last leaf it
covers, then its height, so children always come before their parents. A sweep
takes nodes in the order of their labels: a node reads the digests its children
sent to it, hashes them and sends the result on to its parent. What is on its
way is kept in a priority queue ordered by label. The near part of that queue is
a heap in a task, which only ever holds the open runs of one path (arity x
height messages); the far part is a written table: a task owns ``arity**height``
consecutive nodes of a source, and messages that leave its subtree are sorted
out to their receivers by the next shuffle. A tree of n leaves thus takes
log(n) / ``height`` rounds, whatever share of the leaves one source has.

The reversed sweep runs through the same nodes from the largest label down: a
node gets the proof suffix that leads from it to the root and sends each child
that suffix with the child's siblings before it, down to the leaves.

Defined cases: nulls are written as ``-``; a null source is the first of all; a
null doc_id sorts first in its source; rows of one doc_id sort by their digest,
so equal rows are told apart by position only; empty and very long texts are
hashed whole by Spark, and only digests are shuffled; an empty table gives an
empty result. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecast.llm.common import in_order, positions, store

ARITY, HEIGHT = 3, 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
EMPTY = sha256(b"").hexdigest()

#: Messages between tasks: node ``pos`` of ``n`` in a group has a digest.
NODE = "grp string, pos long, n long, digest string"


def digest(*values: Column) -> Column:
    """SHA-256 of fields written one after another with their byte lengths."""
    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(written, values)).cast("binary"), 256)


def _hash(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Subtree:
    """The nodes above ``arity**height`` consecutive nodes, or above all of a group that has no more.

    Nodes are addressed by (height, position) as counted in this round.
    """

    def __init__(self, first: int, digests: list[str], n: int, arity: int, height: int):
        self.first, self.arity, self.leaves = first, arity, len(digests)
        self.top = 0
        while (arity ** self.top < n) and self.top < height:
            self.top += 1
        self.digests: dict[tuple[int, int], str] = {}
        self.sizes = [n]
        for _ in range(self.top):
            self.sizes.append(-(-self.sizes[-1] // arity))
        self._forward(digests)

    def _label(self, level: int, pos: int) -> tuple[int, int]:
        last = min((pos + 1) * self.arity ** level, self.sizes[0]) - 1
        return last, level

    def _forward(self, digests: list[str]) -> None:
        queue: list[tuple[tuple[int, int], int, int, str]] = []   # label, level, position, digest from a child

        def send(level: int, pos: int, value: str) -> None:
            self.digests[level, pos] = value
            if level < self.top:
                up = pos // self.arity
                heapq.heappush(queue, (self._label(level + 1, up), level + 1, pos, value))

        def deliver(before: int) -> None:
            """Visit all nodes whose last leaf lies before ``before``."""
            while queue and queue[0][0][0] < before:
                label, level = queue[0][0], queue[0][1]
                received = []
                while queue and queue[0][0] == label:
                    received.append(heapq.heappop(queue)[2:])
                send(level, received[0][0] // self.arity, _hash([value for _, value in sorted(received)]))

        for pos, value in enumerate(digests, self.first):
            deliver(pos)
            send(0, pos, value)
        deliver(self.first + len(digests))

    @property
    def root(self) -> tuple[int, str]:
        pos = self.first // self.arity ** self.top
        return pos, self.digests[self.top, pos]

    def backward(self, suffix: list[list[str]]) -> Iterator[tuple[int, list[list[str]]]]:
        """(leaf, proof): a proof lists, from the leaf upwards, what stands left and right of the node."""
        pos, _ = self.root
        queue = [(tuple(-x for x in self._label(self.top, pos)), self.top, pos, suffix)]
        while queue:
            _, level, pos, proof = heapq.heappop(queue)
            if level == 0:
                yield pos, proof
                continue
            first = pos * self.arity
            children = range(first, min(first + self.arity, self.sizes[level - 1]))
            values = [self.digests[level - 1, child] for child in children]
            for k, child in enumerate(children):
                own = ["".join(values[:k]), "".join(values[k + 1:])]
                heapq.heappush(queue, (tuple(-x for x in self._label(level - 1, child)), level - 1, child,
                                       [own, *proof]))


def fold(value: str, proof: list[list[str]]) -> str:
    """The root that a leaf leads to by its proof."""
    for left, right in proof:
        value = _hash([left, value, right])
    return value


def _groups(parts: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows by their first ``keys`` values, of batches sorted by them; groups are of bounded size."""
    key, held = None, []
    for part in parts:
        for row in zip(*(column.to_pylist() for column in part.columns)):
            if row[:keys] != key:
                if held:
                    yield key, held
                key, held = row[:keys], []
            held.append(row)
    if held:
        yield key, held


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


def _by_block(nodes: DataFrame, width: int, *columns: str) -> DataFrame:
    block = F.floor(F.col("pos") / width).cast("long")
    placed = nodes.select("grp", block.alias("block"), "pos", *columns)
    return placed.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")


def sweep(nodes: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> tuple[DataFrame, list[DataFrame]]:
    """Subroots (grp, digest) of groups of numbered nodes, and the nodes that entered each round."""
    width = arity ** height
    schema = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])

    def forward(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (grp, _), held in _groups(parts, 2):
                n = held[0][3]
                tree = Subtree(held[0][2], [row[4] for row in held], n, arity, height)
                yield grp, tree.root[0], tree.sizes[-1], tree.root[1]
        yield from _batches(rows(), schema)

    rounds, ended, at = [], [], nodes
    while True:
        most = at.agg(F.max("n")).first()[0]
        if most is None or most <= 1:
            break
        ended.append(at.filter("n = 1").select("grp", "digest"))
        rounds.append(at.filter("n > 1"))
        at = store(_by_block(rounds[-1], width, "n", "digest").mapInArrow(forward, NODE), "nodes")
    roots = at.select("grp", "digest")
    for done in ended:
        roots = roots.unionByName(done)
    return roots, rounds


PROOF = "array<array<string>>"
PROOF_TYPE = pa.list_(pa.list_(pa.string()))


def _delivered(nodes: DataFrame, tops: DataFrame, arity: int, height: int, emit: Callable, schema: pa.Schema,
               ddl: str) -> DataFrame:
    """One reversed round: ``tops`` (grp, block, proof) of the subtrees down to ``nodes`` (with a payload)."""
    width = arity ** height
    nodes = nodes.select("grp", F.floor(F.col("pos") / width).cast("long").alias("block"), "pos", "n", "digest",
                         "payload", F.lit(None).cast(PROOF).alias("proof"))
    tops = tops.select("grp", "block", F.lit(-1).cast("long").alias("pos"), F.lit(0).cast("long").alias("n"),
                       F.lit(None).cast("string").alias("digest"), F.lit(None).cast("string").alias("payload"), "proof")
    mixed = nodes.unionByName(tops).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")

    def backward(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (grp, _), held in _groups(parts, 2):
                suffix, held = held[0][6], held[1:]
                if not held:      # an empty table has a suffix for its root only
                    continue
                tree = Subtree(held[0][2], [row[4] for row in held], held[0][3], arity, height)
                payloads = {row[2]: row[5] for row in held}
                for pos, proof in tree.backward(suffix):
                    yield emit(grp, pos, tree.digests[0, pos], payloads[pos], proof)
        yield from _batches(rows(), schema)

    return mixed.mapInArrow(backward, ddl)


def reversed_sweep(rounds: list[DataFrame], leaves: DataFrame, suffixes: DataFrame, emit: Callable, schema: pa.Schema,
                   ddl: str, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """``emit(grp, pos, digest, payload, proof)`` of every leaf, given each group's suffix (grp, proof).

    ``rounds`` are those of :func:`sweep`; ``leaves`` are its nodes with a ``payload`` column.
    """
    width = arity ** height
    nothing = F.lit(None).cast("string").alias("payload")
    tops = suffixes.select("grp", F.lit(0).cast("long").alias("block"), "proof")
    entering = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("proof", PROOF_TYPE)])
    for depth in range(len(rounds) - 1, 0, -1):
        nodes = rounds[depth].select("grp", "pos", "n", "digest", nothing)
        # groups that ended before this round enter further down
        there = nodes.groupBy("grp").agg(F.lit(True).alias("there"))
        known = tops.join(there, "grp", "left")
        down = _delivered(nodes, known.filter("there").drop("there"), arity, height,
                          lambda grp, pos, value, payload, proof: (grp, pos, proof), entering,
                          f"grp string, pos long, proof {PROOF}")
        tops = store(known.filter("there is null").drop("there").unionByName(
            down.select("grp", F.col("pos").alias("block"), "proof")), "suffixes")
    return _delivered(leaves, tops, arity, height, emit, schema, ddl)


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    return positions(in_order(rows, ["grp", *order], name), ["grp"])


def manifest(docs: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether a tampered copy still folds to the root.

    A document whose doc_id has an even CRC-32 is tampered with: its text loses the line feeds.
    """
    fields = [F.col(c) for c in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = digest(*fields[:-1], F.translate(F.col("text"), "\n", ""))
    rows = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("grp"),
        digest(*fields).alias("digest"), F.when(tampered, changed).alias("changed"))
    leaves = store(_numbered(store(rows, "digests"), ["doc_id", "digest"], "leaves"), "leaf-nodes")

    subroots, rounds = sweep(leaves.select("grp", "pos", "n", "digest"), arity, height)
    subroots = store(subroots, "subroots")
    sources = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("payload"), "digest")
    sources = store(_numbered(sources, ["payload"], "sources"), "source-nodes")
    top, top_rounds = sweep(sources.select("grp", "pos", "n", "digest"), arity, height)

    root = top.first()
    schema = pa.schema([("grp", pa.string()), ("proof", PROOF_TYPE), ("subroot", pa.string())])
    none = docs.sparkSession.createDataFrame([("", [])], f"grp string, proof {PROOF}")
    suffixes = store(reversed_sweep(
        top_rounds, sources, none, lambda grp, pos, value, payload, proof: (payload, proof, value),
        schema, f"grp string, proof {PROOF}, subroot string", arity, height), "source-proofs")

    def checked(grp, pos, value, payload, proof):
        siblings = _hash([side for level in proof for side in level])
        return grp, pos, siblings, fold(payload or value, proof)

    schema = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("proof_sha256", pa.string()),
                        ("folded_root", pa.string())])
    proofs = reversed_sweep(rounds, leaves.select("grp", "pos", "n", "digest", F.col("changed").alias("payload")),
                            suffixes.select("grp", "proof"), checked, schema,
                            "grp string, pos long, proof_sha256 string, folded_root string", arity, height)
    out = leaves.join(proofs, ["grp", "pos"]).join(suffixes.select("grp", "subroot"), "grp")
    out = out.withColumn("root", F.lit(root["digest"] if root else None).cast("string"))
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
