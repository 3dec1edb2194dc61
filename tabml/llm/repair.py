"""Repair of conversations by aligning their turns with an alternating target (Wagner-Fischer).

Damage, ordering and counting of turns are Spark's; a conversation's alignment depends on one
letter per turn and runs over numpy rows inside a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map, col

#: Cost of changing a role, of deleting a turn, of inserting one, and of keeping
#: one whose text breaks off.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Turns of a conversation up to which a worker remembers its answer, and answers it remembers.
REMEMBERED_TURNS, REMEMBERED = 32, 50_000

_FAR = 1 << 40
_BLANKS = " \t\n\v\f\r"


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, there``: turns damaged by a hash of their place.

    The remainder of crc32(``conv_id:turn``) by 20 decides: 0 drops the turn, 1 empties its
    text, 2 takes out its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it the user's. Nulls are
    one space, in the hash as well; ``conv_id`` and ``turn`` themselves stay null. A dropped
    turn stays as a row that is not ``there``, so that its conversation does.
    """

    def said(name: str) -> Column:
        return F.coalesce(col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", ""))
    rows = turns.select(
        col("conv_id").cast("long").alias("conv_id"), col("turn").cast("long").alias("turn"),
        said("role").alias("role"), said("text").alias("text"), fate.alias("fate"),
    )
    changed = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        (F.col("fate") != 0).alias("there"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return changed.drop("_copy")


# --- alignment ---------------------------------------------------------------------------


def _least(must: np.ndarray, cut: np.ndarray) -> tuple[int, int]:
    """What any repair costs, and what it costs at least to delete one more turn.

    Turns that must go cost a deletion, truncated ones cost 1 whether they stay or not, which a
    deletion of such a turn then has paid already.
    """
    open_cuts = int((cut & ~must).sum())
    return DELETE * int(must.sum()) + TRUNCATED * open_cuts, DELETE - TRUNCATED * (open_cuts > 0)


def _offset(ahead: np.ndarray | int, deletion: int) -> np.ndarray:
    """The least cost of being so many target places ahead of the turns (behind: negative)."""
    return np.where(ahead > 0, INSERT * ahead, -deletion * ahead)


def _costs(letters: str, must: np.ndarray, cut: np.ndarray, target: str, most: int) -> np.ndarray | None:
    """Least cost of the rest of the way from every (turn, target place), if any way costs ``most`` at most.

    Row i, column j: turns from i on against places from j on, filled from the end. Only the
    Ukkonen band is computed: places from which the offset that is still to be made up, before
    and after, leaves the whole below ``most``.
    """
    n, m = len(letters), len(target)
    system = target[:1] == "s"
    base, deletion = _least(must, cut)
    kept_before = np.concatenate([[0], np.cumsum(~must)])
    kept = int(kept_before[-1])
    if base + int(_offset(m - kept, deletion)) > most:
        return None
    table = np.full((n + 1, m + 1), _FAR, np.int64)
    places = np.arange(m + 1)
    codes = np.frombuffer(target.encode("ascii"), np.uint8)
    # An inserted turn is the user's or the assistant's, never the system's.
    insertable = codes != ord("s")

    def band(i: int) -> tuple[int, int]:
        ahead = places - kept_before[i]
        open_ = base + _offset(ahead, deletion) + _offset((m - kept) - ahead, deletion) <= most
        found = np.flatnonzero(open_)
        return (int(found[0]), int(found[-1]) + 1) if len(found) else (0, 0)

    for i in range(n, -1, -1):
        low, high = band(i)
        if low == high:
            return None
        row = np.full(high - low, _FAR, np.int64)
        if i == n:
            row = np.minimum(row, INSERT * (m - places[low:high]))
            if system and low == 0:
                row[0] = 0 if m == 0 else _FAR
        else:
            row = np.minimum(row, table[i + 1, low:high] + DELETE)
            if not must[i]:
                top = min(high, m)
                if top > low:
                    wanted = codes[low:top]
                    step = np.where(wanted == ord(letters[i]), 0, np.where(insertable[low:top], REROLE, _FAR))
                    row[: top - low] = np.minimum(row[: top - low], table[i + 1, low + 1 : top + 1] + step + TRUNCATED * int(cut[i]))
            # Insertions run on along the row: a running minimum from its end.
            start = 1 if system and low == 0 else 0
            part = row[start:] + INSERT * places[low + start : high]
            part = np.minimum.accumulate(part[::-1])[::-1]
            row[start:] = part - INSERT * places[low + start : high]
        table[i, low:high] = np.minimum(row, _FAR)
    return table if table[0, 0] <= most else None


def _audit(letters: str, must: np.ndarray, cut: np.ndarray, target: str, table: np.ndarray) -> str:
    """The ASCII-least edits of a cheapest way: at every step the least letter that stays on one."""
    i = j = 0
    n, m, out = len(letters), len(target), []
    while i < n or j < m:
        now = table[i, j]
        if i < n and table[i + 1, j] + DELETE == now:
            out.append("D")
            i += 1
        elif j < m and target[j] != "s" and table[i, j + 1] + INSERT == now:
            out.append("I")
            j += 1
        else:
            out.append("K" if letters[i] == target[j] else "R")
            i, j = i + 1, j + 1
    return "".join(out)


def align(letters: str, faults: str) -> tuple[int, str]:
    """Cheapest cost and its ASCII-least audit for a conversation's role initials and faults.

    A turn's fault is ``b`` or ``d`` (has to go), ``t`` (costs 1 if it stays) or ``-``. Targets
    are ``(ua)^k`` and ``s(ua)^k`` of every length that the best cost so far allows, nearest
    ones first; equal costs compare their audits.
    """
    n = len(letters)
    must = np.array([f in "bd" for f in faults], bool)
    cut = np.array([f == "t" for f in faults], bool)
    best, audit = DELETE * n, "D" * n
    (base, deletion), kept = _least(must, cut), n - int(must.sum())
    # A first turn of the system's can only be kept, so without one there is no such target.
    starts = ["", "s"] if any(x == "s" and not m for x, m in zip(letters, must, strict=True)) else [""]
    pairs = sorted(range(1, (kept + best // INSERT) // 2 + 2), key=lambda k: (abs(2 * k - kept), k))
    for k in pairs:
        for start in starts:
            if base + int(_offset(len(start) + 2 * k - kept, deletion)) > best:
                continue
            target = start + "ua" * k
            table = _costs(letters, must, cut, target, best)
            if table is None:
                continue
            cost = int(table[0, 0])
            own = _audit(letters, must, cut, target, table)
            if cost < best or own < audit:
                best, audit = cost, own
    return best, audit


_remembered = lru_cache(maxsize=REMEMBERED)(align)


def repaired(audit: str, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """The turns that an audit leaves: kept, with another role, or inserted without text."""
    at, spoken = 0, 0
    for edit in audit:
        expected = "user" if spoken % 2 == 0 else "assistant"
        if edit == "D":
            at += 1
            continue
        if edit == "I":
            yield expected, ""
        else:
            yield (roles[at] if edit == "K" else expected), texts[at]
            # The one turn that may come before the alternation is the system's.
            system = edit == "K" and spoken == 0 and roles[at][:1] == "s"
            at += 1
            if system:
                continue
        spoken += 1


# --- conversations -----------------------------------------------------------------------

_NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Conversation:
    """The turns of one conversation as they come."""

    def __init__(self, key: int | None):
        self.key = key
        self.turns: set[int] = set()
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.faults: list[str] = []
        self.seen: set[bytes] = set()

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.turns.add(turn)
        whole = f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")
        said = hashlib.blake2b(whole, digest_size=16).digest()
        ending = text.rstrip(_BLANKS)
        if not ending:
            fault = "b"
        elif said in self.seen:
            fault = "d"
        else:
            fault = "-" if ending[-1] in ".!?" else "t"
        self.seen.add(said)
        self.faults.append(fault)
        self.roles.append(role)
        self.texts.append(text)

    def result(self) -> tuple:
        # Initials that no target has, none included, are alike; a letter keeps places equal.
        letters = "".join(r[:1] if r[:1] in ("s", "u", "a") else "x" for r in self.roles)
        faults = "".join(self.faults)
        cost, audit = (_remembered if len(letters) <= REMEMBERED_TURNS else align)(letters, faults)
        digest = hashlib.sha256()
        for number, (role, text) in enumerate(repaired(audit, self.roles, self.texts)):
            digest.update((("\n" if number else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        illegal = sum(pair not in ("su", "ua", "au") for pair in (a + b for a, b in zip(letters, letters[1:], strict=False)))
        counts = [faults.count(f) for f in "bdt"]
        return (self.key, gaps, *counts, illegal, cost, audit, digest.hexdigest())


def _batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    columns = list(zip(*found, strict=True)) if found else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(_NAMES))


def repair(turns: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``turns`` (``conv_id, turn, role, text, there``).

    Turns go by number (null first), equal numbers by role and text. A turn's first fault
    counts: blank, duplicate (role and text came before), truncated (its last character that is
    not white space is none of ``.!?``). ``illegal`` counts neighbours whose role initials are
    not su, ua or au; ``gaps`` the numbers that are missing between first and last turn. The
    repair is the cheapest series of edits after which the initials are ``s?(ua)+`` or nothing
    is left: keep (0), change the role to user or assistant (2), delete (3; blank and duplicate
    turns must go), insert a turn without text (2); a truncated turn that stays adds 1.
    ``audit`` has the initials of the edits, of equally cheap ones the ASCII-least, and
    ``repaired_sha256`` is the digest of the remaining ``role:text`` lines.

    Conversations of which no row is ``there`` have zeros, no edits and the digest of nothing; a
    null ``conv_id`` is a conversation as well. Roles and texts must not be null. Extra columns
    are ignored, an empty table has no rows. A conversation's turns pass through one task, which
    holds its texts, as its alignment is one sequence; conversations are spread by key.
    """
    spread = turns.select("conv_id", "turn", "role", "text", "there").repartition("conv_id")
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        found: list[tuple] = []
        for rows in batches:
            columns = (rows[name].to_pylist() for name in ("conv_id", "turn", "role", "text", "there"))
            for key, turn, role, text, there in zip(*columns, strict=True):
                if now is None or key != now.key:
                    if now is not None:
                        found.append(now.result())
                    now = Conversation(key)
                if there:
                    now.add(turn, role, text)
            if len(found) >= 2000:
                yield _batch(found)
                found = []
        if now is not None:
            found.append(now.result())
        yield _batch(found)

    return arrow_map(spread.sortWithinPartitions(*order), run, _DDL)


def repair_damaged(turns: DataFrame) -> DataFrame:
    """:func:`repair` of what :func:`damaged` makes of ``turns``."""
    return repair(damaged(turns))
