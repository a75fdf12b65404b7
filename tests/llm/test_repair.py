"""Conversation repair against plain strings and against every sequence of edits."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import pytest

from slatecast.llm import repair

COLUMNS = "text string, role string, turn long, conv_id long, pos int, seg string, `a.b` int, edit string"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        dealt = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if dealt == 0:
            continue
        text = "" if dealt == 1 else re.sub("[.!?]", "", text) if dealt == 2 else text
        out += [(conv, turn, "user" if dealt == 4 else role, text)] * (2 if dealt == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def fault_of(row, seen):
    if not re.search("[^\x20\x09-\x0d]", row[3]):
        return 1
    if (row[2], row[3]) in seen:
        return 2
    return 0 if re.search("[.!?][\x20\x09-\x0d]*\\Z", row[3]) else 3


def cheapest(turns):
    """(cost, audit, lines) with whole strings instead of trees."""
    best = {0: (0, "", [])}

    def put(at, state, value):
        if state not in at or value[:2] < at[state][:2]:
            at[state] = value

    def opened(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                role = "assistant" if state == 2 else "user"
                put(best, NEXT[state][role[0]], (cost + 5, audit + "I", lines + [role + ":"]))
        return best

    for (_, _, role, text), fault in turns:
        now = {}
        for state, (cost, audit, lines) in opened(best).items():
            put(now, state, (cost + 2, audit + "D", lines))
            if fault in (0, 3):
                extra = 5 if fault == 3 else 0
                if role[:1] in NEXT[state]:
                    put(now, NEXT[state][role[:1]], (cost + extra, audit + "K", lines + [f"{role}:{text}"]))
                for new in ("user", "assistant"):
                    if new[0] in NEXT[state] and new[0] != role[:1]:
                        put(now, NEXT[state][new[0]], (cost + 1 + extra, audit + "R", lines + [f"{new}:{text}"]))
        best = now
    return min(v for k, v in opened(best).items() if k in (0, 3))


def expected(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = after_damage([r for r in rows if r[0] == conv])
        seen, turns = set(), []
        for row in mine:
            turns.append((row, fault_of(row, seen)))
            seen.add((row[2], row[3]))
        known = [r[1] for r in mine if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        count = [sum(f == k for _, f in turns) for k in range(4)]
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(mine)]
        cost, audit, lines = cheapest(turns) if mine else (0, "", [])
        out.append((conv, gaps, count[1], count[2], count[3], sum(p not in ("su", "ua", "au") for p in pairs), cost,
                    audit, sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **options):
    frame = spark.createDataFrame([(t, r, n, c, 1, "s", 2, "K") for c, n, r, t in rows], COLUMNS)
    got = repair.audit_conversations(frame, **options)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_repair_against_strings(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(120):
        role = rng.choice(("user", "assistant", "system"))
        for turn in range(rng.randint(1, 9)):
            role = {"user": "assistant"}.get(role, "user") if rng.random() < 0.75 else rng.choice(
                ("user", "assistant", "system", "tool", "", None))
            text = rng.choice(("a.", "b!", "c?", "d", "e. ", "", " \n", None, "f.\x0b", "ü."))
            if text and rng.random() < 0.6:
                text = f"{turn}{text}"
            rows.append((conv or None, None if rng.random() < 0.05 else turn, role, text))
    rows += [(900, 5, "user", "same.")] * 6 + [(901, -(1 << 62), "user", "x."), (901, 1 << 62, "assistant", "y.")]
    rows += [(902, 1, "user", "long text. " * 100_000), (902, 2, "assistant", "." + " " * 300_000)]
    rows += [(1000 + t, None, "user", "z.") for t in range(30)]      # some lose their only row
    check(spark, rows)


@pytest.mark.parametrize("segment", [1, 3, 16])
def test_long_conversations_in_segments(spark, segment):
    rng = random.Random(segment)
    rows = [(7, t, rng.choice(("user", "assistant", "assistant", "system", "tool")), rng.choice(("a", "b.", f"{t}.", f"{t}")))
            for t in range(300)]
    rows += [(8, t, "assistant" if t % 2 else "user", f"{t}" if t % 3 else f"{t}.") for t in range(100)]
    check(spark, rows, segment=segment)


def test_empty_table(spark):
    check(spark, [])


def accepted(roles):
    return re.fullmatch("(s?(ua)+)?", roles) is not None


def test_programme_against_every_sequence_of_edits():
    rng = random.Random(3)
    for _ in range(150):
        rows = [(rng.choice("suax"), rng.randrange(4)) for _ in range(rng.randint(0, 3))]
        best = None
        for edits in itertools.product([("", "D"), *((ins, e) for ins in ("", "I", "II") for e in ("K", "Ru", "Ra"))],
                                       repeat=len(rows)):
            for closing in ("", "I", "II"):
                audit, cost, shape, ok = "", 0, "", True
                for (ins, edit), (initial, fault) in zip(edits, rows):
                    audit += ins + edit[0]
                    cost += 5 * len(ins) + {"D": 2, "K": 0, "R": 1}[edit[0]]
                    if edit != "D":
                        ok &= fault in (0, 3)
                        cost += 5 * (fault == 3)
                        shape += "." * len(ins) + (initial if edit == "K" else edit[1])
                audit, cost, shape = audit + closing, cost + 5 * len(closing), shape + "." * len(closing)
                if not ok:
                    continue
                if any(accepted("".join(fill)) for fill in itertools.product(*("ua" if c == "." else c for c in shape))):
                    best = min(best or (cost, audit), (cost, audit))
        trail = repair.Trail()
        found = repair.repair_rows(trail, 0, rows)
        mine = min((cost + 5 * repair.CLOSING[state], "".join(map(chr, trail.letters(node))) + "I" * repair.CLOSING[state])
                   for state, (cost, node) in found.items())
        assert mine == best, rows


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 7, 2])
def test_comparison_survives_collisions(modulus):
    """With a modulus of 2 nearly all hashes collide; the order stays that of the strings."""
    rng = random.Random(modulus)
    trail, text = repair.Trail(modulus), {0: ()}
    for _ in range(400):
        parent = rng.choice([*list(text)[-12:], 0])
        letter = rng.randrange(2)
        text[trail.add(parent, letter)] = text[parent] + (letter,)
    for _ in range(4000):
        a, b = rng.choice(list(text)), rng.choice(list(text))
        assert trail.less(a, b) == (text[a] < text[b])
        assert tuple(trail.letters(a)) == text[a]
