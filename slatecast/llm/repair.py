"""Repair of conversation structure at least cost, with an audit of the edits.

A repaired conversation has roles ``(s?(ua)+)?``. Edits of a row: Keep (0),
Rerole to user or assistant (1), Delete (2); an empty user or assistant row may
be Inserted anywhere (5). Blank and duplicate rows must go; a truncated row that
stays adds 5. Of the cheapest repairs the one whose edit initials are least in
ASCII order is taken.

The dynamic programme keeps one audit for each of four states (nothing yet,
after system, after user, after assistant). Audits share their prefixes: an
audit is a node of a persistent tree with a link to its prefix, ancestors at
powers of two and the rolling hash of everything up to it. Audits of equal cost
are compared at the end of their longest common prefix, which is searched over
the ancestors' hashes; equal hashes are verified by letters once and then
remembered as equal, and a collision falls back to comparing letters.

No conversation has to fit a task: rows are numbered by a range sort, and
conversations are cut into segments of ``SEGMENT`` rows. For every state that a
segment may begin in and end in there is one best audit; audits of a segment are
ranked among each other, and a second programme of the same kind runs over the
segments with those ranks for letters. That is exact, because audits that end
with the same row never are prefixes of each other (insertions stand before the
row they lead to). Chosen segments are then spelled out row by row, and the
texts stream through in order, one at a time. What has to be whole is what the
result asks for: an audit of one letter per edit and one hash per conversation.

Defined cases: nulls of any column are read as one space, but a null turn still
sorts first and a null conv_id is a conversation of its own; rows of one turn
are ordered by role, then text; repeated rows are duplicates of the first;
empty texts are blank; texts of any length are streamed; an empty table gives
an empty result; a conversation without rows after damage has zeros, an empty
audit and the hash of the empty string; gaps beyond a long are its maximum.
Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecast.llm.common import in_order, positions, store

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SEGMENT = 4096
#: What counts as blank.
BLANKS = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
SOUND, BLANK, DUPLICATE, CUT = range(4)

# states: nothing yet, after system, after user, after assistant
FIRST, SYSTEM, USER, ASSISTANT = range(4)
#: The role that state takes next, by initial, and the state after it.
NEXT = {FIRST: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: What an inserted or reroled row is in each state.
TURN = {FIRST: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
#: Insertions that end a conversation well after the last row.
CLOSING = {FIRST: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}


class Trail:
    """Sequences of small numbers as nodes of a persistent tree; node 0 is the empty one."""

    def __init__(self, modulus: int = (1 << 61) - 1, base: int = 911_382_323):
        self.modulus, self.base = modulus, base
        self.letter, self.depth, self.mark, self.same = [0], [0], [0], [0]
        self.up: list[list[int]] = [[]]    # ancestors 1, 2, 4, ... steps above

    def add(self, node: int, letter: int) -> int:
        new = len(self.letter)
        up, k = [node], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.mark.append((self.mark[node] * self.base + letter + 1) % self.modulus)
        self.same.append(new)
        self.up.append(up)
        return new

    def above(self, node: int, depth: int) -> int:
        """The prefix of length ``depth``."""
        steps, k = self.depth[node] - depth, 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def _known(self, node: int) -> int:
        while self.same[node] != node:
            self.same[node] = self.same[self.same[node]]
            node = self.same[node]
        return node

    def _equal(self, a: int, b: int) -> bool:
        """Whether two sequences of one length are equal, letter by letter where that isn't known yet."""
        walked = []
        while (a := self._known(a)) != (b := self._known(b)):
            if self.letter[a] != self.letter[b]:
                return False
            walked.append((a, b))
            a, b = self.up[a][0], self.up[b][0]
        for a, b in walked:
            self.same[max(a, b)] = min(a, b)
        return True

    def _letters_less(self, a: int, b: int) -> bool:
        """The same without hashes: the topmost difference of two unequal sequences of one length."""
        less = False
        while a != b:
            if self.letter[a] != self.letter[b]:
                less = self.letter[a] < self.letter[b]
            a, b = self.up[a][0], self.up[b][0]
        return less

    def less(self, a: int, b: int) -> bool:
        shorter = self.depth[a] < self.depth[b]
        depth = min(self.depth[a], self.depth[b])
        a, b = self.above(a, depth), self.above(b, depth)
        if a == b:
            return shorter
        if self.mark[a] == self.mark[b]:
            return shorter if self._equal(a, b) else self._letters_less(a, b)
        x, y = a, b
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and self.mark[self.up[x][k]] != self.mark[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if self._equal(self.up[x][0], self.up[y][0]):
            return self.letter[x] < self.letter[y]
        return self._letters_less(a, b)

    def letters(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return out[::-1]


class Best:
    """The best (cost, audit) of each state; an audit is added only where it may be the best."""

    def __init__(self, trail: Trail):
        self.trail, self.at = trail, {}

    def offer(self, state: int, cost: int, node: int, letter: int | None = None) -> bool:
        known = self.at.get(state)
        if known and known[0] < cost:
            return False
        if letter is not None:
            node = self.trail.add(node, letter)
        if known and known[0] == cost and not self.trail.less(node, known[1]):
            return False
        self.at[state] = (cost, node)
        return True


D, I, K, R = map(ord, "DIKR")


def repair_rows(trail: Trail, start: int, rows: list[tuple[str, int]]) -> dict[int, tuple[int, int]]:
    """Best (cost, audit) by final state for rows (role initial, fault), from one state on."""
    best = Best(trail)
    best.at[start] = (0, 0)
    for initial, fault in rows:
        reached = list(best.at)
        for _ in range(2):      # more than two insertions in a row never pay
            more = []
            for state in reached:
                cost, node = best.at[state]
                if best.offer(NEXT[state][TURN[state]], cost + INSERT, node, I):
                    more.append(NEXT[state][TURN[state]])
            reached = more
        after = Best(trail)
        stay = TRUNCATED if fault == CUT else 0
        for state, (cost, node) in best.at.items():
            after.offer(state, cost + DELETE, node, D)
            if fault in (SOUND, CUT):
                if initial in NEXT[state]:
                    after.offer(NEXT[state][initial], cost + KEEP + stay, node, K)
                if initial != TURN[state]:
                    after.offer(NEXT[state][TURN[state]], cost + REROLE + stay, node, R)
        best = after
    return best.at


def chain(trail: Trail, segments: Iterator[dict[int, list[tuple[int, int, int]]]]) -> tuple[int, list[int]]:
    """The final state and the list of states between segments, given {start: [(end, cost, rank)]} of each."""
    best, links = Best(trail), []
    best.at[FIRST] = (0, 0)
    came: dict[int, tuple[int, int]] = {}      # node -> (node before, state after)
    for segment in segments:
        after = Best(trail)
        for state, (cost, node) in best.at.items():
            for end, more, rank in segment.get(state, ()):
                if after.offer(end, cost + more, node, rank):
                    came[after.at[end][1]] = (node, end)
        best = after
    least = Best(trail)
    for state, (cost, node) in best.at.items():
        if state in CLOSING and least.offer(0, cost + INSERT * CLOSING[state], node):
            final = state
    node = least.at[0][1]
    while node:
        node, state = came[node]
        links.append(state)
    return final, links[::-1]


def spelled(start: int, audit: list[int], rows: list[tuple[str, int]]) -> list[tuple[str, str, str]]:
    """(initials inserted before, edit, initial after the edit) of each row."""
    out, state, before, at = [], start, "", 0
    for letter in audit:
        edit = chr(letter)
        if edit == "I":
            before += TURN[state]
            state = NEXT[state][TURN[state]]
            continue
        initial = rows[at][0] if edit == "K" else TURN[state] if edit == "R" else ""
        out.append((before, edit, initial))
        if initial:
            state = NEXT[state][initial]
        before, at = "", at + 1
    return out


def _closing(state: int) -> str:
    out = ""
    for _ in range(CLOSING[state]):
        out += TURN[state]
        state = NEXT[state][TURN[state]]
    return out


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (nameless, conv, turn, role, text) after the damage that a checksum of conversation and turn deals."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    dealt = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.translate("text", ".!?", "")).otherwise(
        F.col("text"))
    rows = rows.select(F.col("conv_id").isNull().alias("nameless"), F.coalesce("conv_id", F.lit(0)).alias("conv"),
                       F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"),
                       spaced("text").alias("text"), dealt.alias("dealt")).filter("dealt <> 0")
    copies = F.when(F.col("dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("nameless", "conv", "turn", F.when(F.col("dealt") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


KEY = ["nameless", "conv"]


def faults(placed: DataFrame) -> DataFrame:
    """(nameless, conv, _at, pos, initial, fault) of rows in order; the texts stay where they are."""
    kept = F.rtrim(F.col("text"), F.lit(BLANKS))
    slim = placed.select(
        *KEY, "_at", F.substring("role", 1, 1).alias("initial"), (kept == "").alias("blank"),
        (~F.substring(kept, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256).alias("digest"))
    slim = store(slim, "turns")
    seen = slim.groupBy(*KEY, "digest").agg(F.min("_at").alias("first"), F.count("*").alias("times")).filter("times > 1")
    rows = positions(slim, KEY).join(seen.drop("times"), [*KEY, "digest"], "left")
    fault = (F.when(F.col("blank"), BLANK).when(F.col("first") < F.col("_at"), DUPLICATE)
             .when(F.col("cut"), CUT).otherwise(SOUND))
    return rows.select(*KEY, "_at", "pos", "initial", fault.alias("fault"))


def _by_group(parts: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows grouped by their first ``keys`` columns, of batches sorted by them; nothing is held but a batch."""
    def rows():
        for part in parts:
            yield from zip(*(column.to_pylist() for column in part.columns))

    yield from itertools.groupby(rows(), key=lambda row: row[:keys])


def _written(rows: Iterator[tuple], schema: pa.Schema, size: int = 4000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


def _arrow(fields: list[tuple[str, T.DataType]]) -> tuple[pa.Schema, T.StructType]:
    kinds = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.BooleanType: pa.bool_()}
    return (pa.schema([(n, kinds[type(t)]) for n, t in fields]),
            T.StructType([T.StructField(n, t) for n, t in fields]))


_KEYS = [("nameless", T.BooleanType()), ("conv", T.LongType())]


def segment_audits(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(key, seg, start, end, cost, rank): the best way through every segment from each state to each state."""
    schema, kind = _arrow([*_KEYS, ("seg", T.LongType()), ("start", T.IntegerType()), ("end", T.IntegerType()),
                           ("cost", T.LongType()), ("rank", T.IntegerType())])

    def run(parts):
        def out():
            for key, group in _by_group(parts, 3):
                turns = [row[4:6] for row in group]
                trail = Trail()
                ways = [(start, end, cost, bytes(trail.letters(node)))
                        for start in ((FIRST,) if key[2] == 0 else range(4))
                        for end, (cost, node) in repair_rows(trail, start, turns).items()]
                rank = {audit: k for k, audit in enumerate(sorted({way[3] for way in ways}))}
                for start, end, cost, audit in ways:
                    yield *key, start, end, cost, rank[audit]
        yield from _written(out(), schema)

    return _segmented(rows, segment).mapInArrow(run, kind)


def _segmented(rows: DataFrame, segment: int) -> DataFrame:
    seg = F.floor(F.col("pos") / segment).cast("long")
    cut = rows.select(*KEY, seg.alias("seg"), "pos", "initial", F.col("fault").cast("int").alias("fault"), "_at")
    return cut.repartition(*KEY, "seg").sortWithinPartitions(*KEY, "seg", "pos")


def chosen_ways(ways: DataFrame) -> DataFrame:
    """(key, seg, start, end, last) along the cheapest repair of every conversation."""
    schema, kind = _arrow([*_KEYS, ("seg", T.LongType()), ("start", T.IntegerType()), ("end", T.IntegerType()),
                           ("last", T.BooleanType())])

    def run(parts):
        def segments(group):
            for _, rows in itertools.groupby(group, key=lambda row: row[2]):
                ways: dict[int, list] = {}
                for row in rows:
                    ways.setdefault(row[3], []).append(row[4:7])
                yield ways

        def out():
            for key, group in _by_group(parts, 2):
                _, ends = chain(Trail(), segments(group))
                for seg, (start, end) in enumerate(zip([FIRST, *ends], ends)):
                    yield *key, seg, start, end, seg == len(ends) - 1
        yield from _written(out(), schema)

    placed = ways.select(*KEY, "seg", "start", "end", "cost", "rank").repartition(*KEY)
    return placed.sortWithinPartitions(*KEY, "seg", "start", "end").mapInArrow(run, kind)


def row_edits(rows: DataFrame, ways: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(key, _at, before, edit, after, fault) of every row; insertions at the end come as a row without an edit."""
    schema, kind = _arrow([*_KEYS, ("_at", T.LongType()), ("before", T.StringType()), ("edit", T.StringType()),
                           ("after", T.StringType()), ("fault", T.IntegerType())])
    end = (1 << 63) - 1

    def run(parts):
        def out():
            for key, group in _by_group(parts, 3):
                way, *turns = group
                start, final, last = way[4], way[5], way[6]
                facts = [row[7:9] for row in turns]
                trail = Trail()
                node = repair_rows(trail, start, facts)[final][1]
                for row, (before, edit, after) in zip(turns, spelled(start, trail.letters(node), facts)):
                    yield *key[:2], row[9], before, edit, after, row[8]
                if last and CLOSING[final]:
                    yield *key[:2], end, _closing(final), "", "", SOUND
        yield from _written(out(), schema)

    none = F.lit(None)
    seg = F.floor(F.col("pos") / segment).cast("long").alias("seg")
    ways = ways.select(*KEY, "seg", F.lit(-1).cast("long").alias("pos"), "start", "end", "last",
                       none.cast("string").alias("initial"), none.cast("int").alias("fault"), none.cast("long").alias("_at"))
    turns = rows.select(*KEY, seg, "pos", none.cast("int").alias("start"), none.cast("int").alias("end"),
                        none.cast("boolean").alias("last"), "initial", F.col("fault").cast("int").alias("fault"), "_at")
    both = ways.unionByName(turns).repartition(*KEY, "seg").sortWithinPartitions(*KEY, "seg", "pos")
    return both.mapInArrow(run, kind)


def repaired(placed: DataFrame, edits: DataFrame) -> DataFrame:
    """One row per conversation with rows: its faults, audit, cost and the hash of what it is after repair.

    Texts pass one by one in the order of their conversation.
    """
    schema, kind = _arrow([*_KEYS, *((c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
                           ("audit", T.StringType()), ("repaired_sha256", T.StringType())])

    def run(parts):
        def out():
            for key, group in _by_group(parts, 2):
                count, illegal, cost, audit, lines, last = [0] * 4, 0, 0, [], 0, None
                sha = hashlib.sha256()

                def line(role: str, text: str) -> None:
                    nonlocal lines
                    sha.update(("\n" * bool(lines) + f"{role}:{text}").encode())
                    lines += 1

                for *_, edit, before, after, fault, role, text in _paired(group):
                    for initial in before:
                        audit.append("I")
                        cost += INSERT
                        line(ROLES[initial], "")
                    if not edit:
                        continue
                    audit.append(edit)
                    count[fault] += 1
                    illegal += last is not None and last + role[:1] not in ("su", "ua", "au")
                    last = role[:1]
                    cost += {"K": KEEP, "R": REROLE, "D": DELETE}[edit] + TRUNCATED * (fault == CUT and edit != "D")
                    if edit != "D":
                        line(ROLES[after] if edit == "R" else role, text)
                yield *key, count[BLANK], count[DUPLICATE], count[CUT], illegal, cost, "".join(audit), sha.hexdigest()

        # audits may be long, so few conversations are written at a time
        yield from _written(out(), schema, 200)

    none = F.lit(None).cast("string")
    texts = placed.select(*KEY, "_at", none.alias("edit"), none.alias("before"), none.alias("after"),
                          F.lit(None).cast("int").alias("fault"), "role", "text")
    edits = edits.select(*KEY, "_at", "edit", "before", "after", "fault", none.alias("role"), none.alias("text"))
    both = texts.unionByName(edits).repartition(*KEY)
    return both.sortWithinPartitions(*KEY, "_at", F.col("edit").asc_nulls_last()).mapInArrow(run, kind)


def _paired(group: Iterator[tuple]) -> Iterator[tuple]:
    """A row's edit (first) and its text (second) as one; the closing insertions have no text."""
    edit = None
    for row in group:
        if row[3] is None:
            yield *edit[:7], *row[7:]
            edit = None
        else:
            edit = row
            if row[3] == "":
                yield *row[:7], "", ""


def gaps(rows: DataFrame) -> DataFrame:
    """Missing turns of every conversation."""
    wide = "decimal(38,0)"
    span = F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count_distinct("turn")
    return rows.groupBy(*KEY).agg(F.least(F.coalesce(span, F.lit(0)), F.lit((1 << 63) - 1)).cast("long").alias("gaps"))


def audit_conversations(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Faults, cheapest repair and audit of every conversation, after the damage of :func:`damaged`."""
    damage = damaged(conversations.select("conv_id", "turn", "role", "text"))
    placed = in_order(damage, [*KEY, "turn", "role", "text"], "conversation-rows")
    rows = store(faults(placed), "faults")
    ways = chosen_ways(store(segment_audits(rows, segment), "segment-audits"))
    found = repaired(placed, row_edits(rows, ways, segment))
    ids = conversations.select(F.col("conv_id").isNull().alias("nameless"),
                               F.coalesce("conv_id", F.lit(0)).alias("conv")).distinct()
    out = ids.join(gaps(placed), KEY, "left").join(found, KEY, "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.when(~F.col("nameless"), F.col("conv")).alias("conv_id"), *zero,
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
