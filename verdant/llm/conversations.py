"""Repair of conversation structure by lightest derivations.

A conversation is well formed if its roles' first letters read ``(s?(ua)+)?``.
Repairing is deduction: item ``(i, q)`` says that the rows from the i-th on can
be edited into something that the pattern accepts from its state q. Axioms are
the ends ``(n, q)`` of accepting q and the edits of each row with their costs;
a deduction puts one edit before an item:

* ``(i + 1, q)`` and Delete of row i give ``(i, q)``;
* ``(i + 1, q')`` and Keep or Rerole of row i give ``(i, q)`` if its role leads from q to q';
* ``(i, q')`` and Insert of a role that leads from q to q' give ``(i, q)``.

The weight of an item is (cost, audit), the audit being the edits' letters in
order. Items leave an agenda lightest first and are final then; it ends when the
goal ``(0, 0)`` is final. Costs add up, and one letter put before two audits keeps
their order, so deductions are monotone. They are superior in the agenda's order
(cost, rows covered, audit): all raise the cost but Keep, which covers one more row.
From one state only one role can be rerolled to or inserted, so two deductions of
the same item never begin with the same letter: audits of equal cost differ in
their first letter, and an item needs no more than that and its cost.

Long conversations are repaired window by window from the end; all four items at
a window's border are final before the next window starts, as its axioms.

Jobs: rows without their texts are dealt out by conversation and sorted (Spark
spills); a task streams through them and keeps some bytes a row of one
conversation at a time. A second stream takes each conversation's audit and its
texts in order and feeds the hash row by row. One conversation's rows go through one task,
since audit and hash of the whole are one value each; texts are never gathered.

Defined results: a null role, text, id or turn reads as one blank (in the
damage key and the texts; a null turn sorts first); rows of the same turn are
in order of role and text hash; a role with another first letter, or none,
can't be kept; repeated rows are duplicates; a conversation without rows is well
formed; other columns, whatever their names, are left out; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_ROWS = 4096
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
ROLES = {ord("u"): "user", ord("a"): "assistant"}
# Costs of the edits, and what a truncated row adds unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATION = 3, 4, 3, 3
# The pattern (s?(ua)+)? as states: 0 start, 1 after s, 2 after u, 3 after a; 0 and 3 accept.
_NEXT = {(0, ord("s")): 1, (0, ord("u")): 2, (1, ord("u")): 2, (3, ord("u")): 2, (2, ord("a")): 3}
_INTO: dict[int, list[list[int]]] = {r: [[q for q in range(4) if _NEXT.get((q, r)) == t] for t in range(4)] for r in b"sua"}
_CHOSEN = [ord("u"), ord("u"), ord("a"), ord("u")]        # the role that an edit gives in a state
_D, _I, _K, _R, _END = b"DIKRE"


def _window(roles: bytes, faults: bytes, lo: int, hi: int, ends: list[int] | None, letters: bytearray) -> list[int]:
    """Costs of the items ``(lo, q)`` (only of the goal if ``lo`` is 0) from the costs ``ends`` of ``(hi, q)`` (None: the
    axioms behind the last row); the first letters go to ``letters``."""
    costs = [-1] * (4 * (hi - lo + 1))
    agenda = [(0, 0, _END, q) for q in (0, 3)] if ends is None else [(c, 0, _END, q) for q, c in enumerate(ends)]
    heapq.heapify(agenda)
    open_ = 1 if lo == 0 else 4
    push = heapq.heappush
    while open_:
        cost, covered, letter, q = heapq.heappop(agenda)
        at = 4 * covered + q
        if costs[at] >= 0:
            continue
        costs[at] = cost
        i = hi - covered
        if covered or ends is None:
            letters[4 * i + q] = letter
            for r in ROLES:
                for p in _INTO[r][q]:
                    push(agenda, (cost + INSERT, covered, _I, p))
        if i == lo:
            open_ -= lo > 0 or q == 0
            continue
        push(agenda, (cost + DELETE, covered + 1, _D, q))
        fault, role = faults[i - 1], roles[i - 1]
        if fault != BLANK and fault != DUPLICATE:
            more = cost + (TRUNCATION if fault == TRUNCATED else 0)
            if role in _INTO:
                for p in _INTO[role][q]:
                    push(agenda, (more, covered + 1, _K, p))
            for r in ROLES:
                for p in _INTO[r][q]:
                    push(agenda, (more + REROLE, covered + 1, _R, p))
    return costs[-4:]


def repair(roles: bytes, faults: bytes, window: int = WINDOW_ROWS) -> tuple[int, str]:
    """``(cost, audit)`` of the lightest repair of rows with these first letters of roles and faults (0: none)."""
    letters = bytearray(4 * (len(roles) + 1))
    hi, ends = len(roles), None
    while True:
        lo = max(hi - window, 0)
        ends = _window(roles, faults, lo, hi, ends, letters)
        if lo == 0:
            break
        hi = lo
    audit, i, q = bytearray(), 0, 0
    while (letter := letters[4 * i + q]) != _END:
        audit.append(letter)
        if letter != _D:
            q = _NEXT[q, roles[i] if letter == _K else _CHOSEN[q]]
        i += letter != _I
    return ends[0], audit.decode()


def damaged(rows: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)`` with the damage that a hash of id and turn picks; rows that it drops stay,
    marked ``gone``, so that their conversation is known."""
    blank = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("gone"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")


def _sha(text: str):
    return F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col(text)), 256)


class _Conversation:
    """What is kept of one conversation while its rows stream by."""

    def __init__(self, conv_id):
        self.conv_id, self.roles, self.faults, self.digests, self.rows = conv_id, bytearray(), bytearray(), bytearray(), 0
        self.turns, self.lowest, self.highest, self.last = 0, None, None, None

    def add(self, turn, initial: str, fault: int, digest: bytes):
        self.rows += 1
        self.roles += initial.encode() if initial in ("s", "u", "a") else b"-"
        self.faults.append(fault)
        self.digests += digest
        if turn is not None and turn != self.last:            # turns come in order
            self.turns += 1
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = self.last = turn

    def result(self):
        if self.rows:
            digests = np.frombuffer(bytes(self.digests), dtype="V16")
            order = np.argsort(digests.view("<u8").reshape(-1, 2)[:, 0], kind="stable")
            firsts = _first_of_equals(digests, order)
            faults = np.frombuffer(bytes(self.faults), dtype=np.uint8).copy()
            faults[~firsts & (faults != BLANK)] = DUPLICATE
        else:
            faults = np.empty(0, dtype=np.uint8)
        roles = bytes(self.roles)
        pairs = sum(roles.count(x) for x in (b"su", b"ua", b"au"))      # none overlaps itself
        cost, audit = repair(roles, faults.tobytes())
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.turns
        counts = [int((faults == k).sum()) for k in (BLANK, DUPLICATE, TRUNCATED)]
        return [self.conv_id, gaps, *counts, max(len(roles) - 1, 0) - pairs, cost, audit]


def _first_of_equals(digests: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which digests are the first of their kind; ``order`` sorts by the first eight bytes, stably."""
    head, tail = (digests.view("<u8").reshape(-1, 2)[order, k] for k in (0, 1))
    order = order[np.lexsort((order, tail, head))]
    head, tail = (digests.view("<u8").reshape(-1, 2)[order, k] for k in (0, 1))
    first = np.ones(len(order), dtype=bool)
    first[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
    out = np.empty(len(order), dtype=bool)
    out[order] = first
    return out


_AUDIT_FIELDS = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")
_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _audit_batches(batches):
    """Sorted rows -> one row a conversation."""
    now = None
    for batch in batches:
        arrow = batch.column("conv_id").type
        done = []
        for conv_id, turn, gone, initial, fault, digest in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "turn", "gone", "initial", "fault", "digest")), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(conv_id)
            if not gone:
                now.add(turn, initial, fault, digest)
        if done:
            yield _audit_batch(done, arrow)
    if now is not None:
        yield _audit_batch([now.result()], arrow)


def _audit_batch(rows: list, arrow) -> pa.RecordBatch:
    types = [arrow, *[pa.int64()] * 6, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=_NAMES)


class _Repaired:
    """Hash of a conversation's repaired rows, fed in order."""

    def __init__(self, row: dict):
        self.row, self.audit, self.at, self.state, self.sha = row, row["audit"], 0, 0, hashlib.sha256()
        self.empty = True
        self.inserts()

    def write(self, role: str, text: str):
        self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def given(self) -> str:
        role = _CHOSEN[self.state]
        self.state = _NEXT[self.state, role]
        return ROLES[role]

    def inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.write(self.given(), "")
            self.at += 1

    def add(self, role: str, text: str):
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = _NEXT[self.state, ord(role[0])]
            self.write(role, text)
        elif letter == "R":
            self.write(self.given(), text)
        self.inserts()


def _hash_batches(batches):
    """Sorted audits, each followed by its rows -> audits with the hash of the repaired rows."""
    now, arrow = None, None

    def out(done):
        types = [arrow, *[pa.int64()] * 6, pa.string(), pa.string()]
        columns = [[*(x.row[c] for c in _NAMES), x.sha.hexdigest()] for x in done]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*columns, strict=True), types, strict=True)],
                                          names=[*_NAMES, "repaired_sha256"])

    for batch in batches:
        arrow = batch.column("conv_id").type
        done = []
        columns = {c: batch.column(c) for c in (*_NAMES, "role", "text")}
        for k, role in enumerate(columns["role"].to_pylist()):
            if role is None:
                if now is not None:
                    done.append(now)
                now = _Repaired({c: columns[c][k].as_py() for c in _NAMES})
            else:
                now.add(role, columns["text"][k].as_py())
        if done:
            yield out(done)
    if now is not None:
        yield out([now])


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Repairs rows ``(conv_id, turn, role, text)`` without nulls in role and text and a boolean ``gone`` (the row only
    tells that there is such a conversation). Returns one row per conv_id: ``(conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256)``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.select("conv_id", "turn", "role", "text", "gone", F.unhex(F.substring(_sha("text"), 1, 32)).alias("digest"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(0))
    plain = rows.select("conv_id", "turn", "gone", "role", F.substring("role", 1, 1).alias("initial"), fault.cast("tinyint").alias("fault"), "digest")
    audits = (plain.repartition("conv_id").sortWithinPartitions(*order).drop("role")
              .mapInArrow(_audit_batches, f"conv_id {kind}, {_AUDIT_FIELDS}"))
    texts = rows.where(~F.col("gone")).select("conv_id", "turn", "role", "text", "digest")
    both = audits.unionByName(texts, allowMissingColumns=True)
    streamed = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("cost").isNull(), *order[1:])
    return streamed.select(*_NAMES, "role", "text").mapInArrow(_hash_batches, f"conv_id {kind}, {_AUDIT_FIELDS}, repaired_sha256 string")
