"""Conversation repair next to an exhaustive search over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from tabml.llm import repair

FAR = (10**9, "~")


def brute(letters: str, faults: str) -> tuple[int, str]:
    """Least (cost, audit) over every series of edits with at most ``n + 3`` insertions."""
    n = len(letters)
    follows = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def best(i, state, left):
        found = [(0, "")] if i == n and state in ("", "a") else [FAR]

        def take(cost, letter, rest):
            if rest is not FAR:
                found.append((cost + rest[0], letter + rest[1]))

        if i < n:
            take(3, "D", best(i + 1, state, left))
            if faults[i] not in "bd":
                more = faults[i] == "t"
                if letters[i] in follows[state]:
                    take(more, "K", best(i + 1, letters[i], left))
                for role in "ua":
                    if role in follows[state]:
                        take(2 + more, "R", best(i + 1, role, left))
        if left:
            for role in "ua":
                if role in follows[state]:
                    take(2, "I", best(i, role, left - 1))
        return min(found) if min(found)[0] < 10**9 else FAR

    return best(0, "", n + 3)


def test_align_like_all_edits():
    draw = random.Random(1)
    for _ in range(3000):
        n = draw.randint(0, 9)
        letters = "".join(draw.choice("suauax") for _ in range(n))
        faults = "".join(draw.choice("----tbd") for _ in range(n))
        assert repair.align(letters, faults) == brute(letters, faults), (letters, faults)


def expected(rows):
    """Per conversation what the damage and the counts ought to be, turn by turn."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        place = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(place.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        one = (turn, "user" if fate == 4 else role, text)
        kept += [] if fate == 0 else [one, one] if fate == 3 else [one]
    result = {}
    for conv, kept in out.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), ""
        for _, role, text in kept:
            end = text.strip(" \t\n\v\f\r")
            faults += "b" if not end else "d" if (role, text) in seen else "-" if end[-1] in ".!?" else "t"
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in kept]
        letters = "".join(x if x and x in "sua" else "x" for x in initials)
        cost, audit = brute(letters, faults)
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        # Roles that remain: s only as a kept first one, then user and assistant by turns.
        lines, at, alternate = [], 0, 0
        for edit in audit:
            if edit == "D":
                at += 1
                continue
            due = ("user", "assistant")[alternate % 2]
            role, text = (due, "") if edit == "I" else (kept[at][1] if edit == "K" else due, kept[at][2])
            at += edit != "I"
            alternate += role[:1] in "ua"
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(f) for f in "bdt"]
        result[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_like_turn_by_turn(spark, seed):
    draw = random.Random(seed)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(draw.randint(1, 7)):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = draw.choice(["Hello.", "Why? ", "no end", "", "\t\n", None, "äö!", f"t{turn}."])
            rows.append((conv, draw.choice([turn, turn, turn + 1, None]), role, text))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r[0]: tuple(r)[1:] for r in repair.repair_damaged(frame).collect()}
    assert got == expected(rows)


def test_dropped_empty_and_extra(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame(
        [(gone, 0, "user", "x.", 1, "y")], "conv_id long, turn long, role string, text string, there int, fate string"
    )
    row = repair.repair_damaged(frame).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.repair_damaged(frame.limit(0)).count() == 0


def test_long_conversation_and_text(spark):
    rows = [(1, k, "ua"[k % 2].replace("u", "user").replace("a", "assistant"), f"{k}.") for k in range(300)]
    rows.append((1, 300, "user", "word " * 100_000))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = repair.repair_damaged(frame).first()
    kept = [r for r in row["audit"] if r != "D"]
    assert row["cost"] > 0 and len(kept) % 2 == 0 and len(row["audit"]) >= 270
