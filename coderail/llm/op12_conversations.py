"""Repair of conversation structure: the cheapest edits that make roles read (system) user assistant user assistant ...

Scalar big-integer weights: every edit path is one integer, its cost in the high digits, its audit letters below.  Each
row of a conversation owns one slot of two base-8 digits, at a place fixed by the row's number: an optional ``I`` for an
empty row put in before it, then ``D``, ``K`` or ``R`` for the row itself, and zero at the end of a slot of one letter.  A last slot
holds an ``I`` behind the last row.  No slot is the beginning of another, so comparing the low digits compares the
audits in ASCII order, weights simply add up, and an ordinary minimum over the nodes (row, what the roles so far are)
decides cost and audit at once.  More than one row put in at a place is never cheapest: two rows put in side by side can
both be left out again, and behind a lone system row deleting that row (4) is cheaper than putting in two (6).

A conversation passes through two sorted streams.  The first sees no texts: it numbers the kinds of rows (one byte
each) and solves runs of ``SEGMENT`` rows, each a small matrix of integers, which join by minimum and addition, so that no
step handles integers longer than a segment but the one that appends to the path so far.  The second stream puts the audit
in front of the conversation's rows and hashes the repaired rows as they come by, one at a time.

Null role or text: one blank.  An empty role has no initial, so its row is deleted or given a role.  Null turn: a blank in the damage key, sorted first.  Null ``conv_id``: a conversation of its own.
Equal turns: ordered by role and text.  Repeated rows: as any others (they make duplicates).  A conversation without rows after damage:
zeros, empty audit, hash of nothing.  Empty table: no rows.  Other columns are ignored.
Memory: one byte a row, one audit and 32 bytes a distinct row of one conversation, and one Arrow batch of texts.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coderail.llm.common import materialise, table

# The costs and letters of the edits, the characters that end a sentence, the blanks.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
STOPS = "[.!?]"
NOT_BLANK = r"[^\x20\x09-\x0D]"
LEGAL = {"su", "ua", "au"}

#: Roles so far: none, a system row, up to a user row, up to an assistant row; and the state behind a role.
STATES = START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The one role that may be put in, or given to a row, in each state.
FITS = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
DONE = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
SLOT_BITS = 6
SEGMENT = 256
INITIALS = "?sua"


def slot(letters: str) -> int:
    """One or two audit letters as two digits, zero at the end."""
    return sum(LETTERS[x] << (3 - 3 * i) for i, x in enumerate(letters))


def kind(initial: str, must_go: bool, truncated: bool) -> int:
    """What decides a row's edits, as one byte."""
    return max(INITIALS.find(initial), 0) * 4 + 2 * must_go + truncated


@functools.cache
def edges(row: int, state: int) -> tuple[tuple[int, int, int], ...]:
    """(next state, cost, slot) of everything that can be done at a row of this kind in this state."""
    initial, must_go, more = INITIALS[row >> 2], row >> 1 & 1, TRUNCATED * (row & 1)
    out = []
    for put_in, at, paid in (("", state, 0), ("I", NEXT[state, FITS[state]], INSERT)):
        out.append((at, paid + DELETE, slot(put_in + "D")))
        if not must_go:
            if (at, initial) in NEXT:
                out.append((NEXT[at, initial], paid + more, slot(put_in + "K")))
            out.append((NEXT[at, FITS[at]], paid + REROLE + more, slot(put_in + "R")))
    return tuple(out)


def solved(rows: bytes) -> dict[tuple[int, int], int]:
    """Least weight from each state before the rows to each state behind them."""
    width = SLOT_BITS * len(rows)
    out = {}
    for start in STATES:
        best = {start: 0}
        for i, row in enumerate(rows):
            place, to = width - SLOT_BITS * (i + 1), {}
            for state, weight in best.items():
                for after, cost, letters in edges(row, state):
                    total = weight + (cost << width) + (letters << place)
                    if after not in to or total < to[after]:
                        to[after] = total
            best = to
        out.update({(start, state): weight for state, weight in best.items()})
    return out


def cheapest(rows: bytes, segment: int = SEGMENT) -> tuple[int, str]:
    """Cost and audit of a conversation whose rows are of these kinds."""
    best, done = {START: 0}, 0  # weights over the ``done`` slots so far
    known: dict[bytes, dict] = {}
    for at in range(0, len(rows), segment):
        part = rows[at : at + segment]
        matrix = known.get(part) or known.setdefault(part, solved(part))
        width, to = SLOT_BITS * len(part), {}
        for (state, after), weight in matrix.items():
            if state in best:
                cost, low = weight >> width, weight & ((1 << width) - 1)
                total = (best[state] << width) + (cost << (SLOT_BITS * done + width)) + low
                if after not in to or total < to[after]:
                    to[after] = total
        best, done = to, done + len(part)
    ends = [(w << SLOT_BITS) for s, w in best.items() if s in DONE]
    ends += [(w << SLOT_BITS) + (INSERT << SLOT_BITS * (done + 1)) + slot("I") for s, w in best.items() if s == USER]
    least = min(ends)
    low = least & ((1 << SLOT_BITS * (done + 1)) - 1)
    names = {v: k for k, v in LETTERS.items()}
    # two base-8 digits a slot, so the octal digits are the letters
    return least >> SLOT_BITS * (done + 1), "".join(names[int(d)] for d in f"{low:o}" if d != "0")


class Repaired:
    """The repaired rows of one conversation, hashed while its rows come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.lines = audit, 0, START, hashlib.sha256(), 0

    def _emit(self, role: str, text: str, initial: str) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines, self.state = self.lines + 1, NEXT[self.state, initial]

    def _put_in(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._emit(NAMES[FITS[self.state]], "", FITS[self.state])
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._put_in()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self._emit(role, text, role[:1])
        elif letter == "R":
            self._emit(NAMES[FITS[self.state]], text, FITS[self.state])

    def digest(self) -> str:
        self._put_in()
        return self.sha.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after damage, and whether a row is left: each conversation keeps at least one
    row, so that none is lost."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    what = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", blank)
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace(text, STOPS, "")).otherwise(text)
    left = what != 0
    rows = conversations.select(
        "conv_id", "turn", F.when(what == 4, "user").when(left, F.coalesce("role", blank)).alias("role"), F.when(left, text).alias("text"),
        left.alias("left"), F.when(what == 3, 2).otherwise(1).alias("_times"))
    return rows.select("conv_id", "turn", "role", "text", "left", F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_")).drop("_")


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("left"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation (see ``SUMMARY``), from rows sorted within hash partitions of ``conv_id``."""
    text = F.col("text")
    slim = rows.select(
        "conv_id", "turn", "left", F.substring("role", 1, 1).alias("initial"), (~text.rlike(NOT_BLANK)).alias("blank"),
        (~text.rlike(rf"(?s){STOPS}[\x20\x09-\x0D]*\z")).alias("cut"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("same"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SUMMARY.split(", ")]
        now, out, any_yet = None, [], False
        for batch in batches:
            for conv, turn, left, initial, blank, cut, same in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not any_yet or conv != now:
                    if any_yet:
                        out.append(finish())
                    any_yet, now = True, conv
                    seen, kinds, last = set(), bytearray(), None
                    turns, low, high, latest = 0, None, None, None
                    counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

                    def finish(c=now):  # the variables of the conversation that is being read
                        cost, audit = cheapest(bytes(kinds))
                        gaps = 0 if high is None else high - low + 1 - turns
                        return (c, gaps, *counts.values(), cost, audit)
                if not left:
                    continue
                fault = "blank" if blank else "duplicate" if same in seen else "truncated" if cut else None
                seen.add(same)
                if fault:
                    counts[fault] += 1
                if kinds and last + initial not in LEGAL:
                    counts["illegal"] += 1
                last = initial
                if turn is not None and turn != latest:  # sorted, so equal turns are neighbours
                    turns, low, high, latest = turns + 1, turn if low is None else low, turn, turn
                kinds.append(kind(initial, fault in ("blank", "duplicate"), fault == "truncated"))
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=summary_schema())
                out = []
        if any_yet:
            out.append(finish())
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=summary_schema())

    return slim.mapInArrow(solve, SUMMARY)


def summary_schema() -> pa.Schema:
    return pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in SUMMARY.split(", ")])


def repaired_hashes(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """``summary`` with ``repaired_sha256``: each conversation's audit is sorted in front of its rows, which are hashed as they come."""
    fields = [c.split()[0] for c in SUMMARY.split(", ")]
    nothing = F.lit(None)
    heads = summary.select(F.lit(0).alias("part"), "conv_id", nothing.cast("long").alias("turn"), nothing.cast("string").alias("role"),
                           nothing.cast("string").alias("text"), F.struct(*fields[1:]).alias("head"))
    body = rows.where("left").select(F.lit(1).alias("part"), "conv_id", "turn", "role", "text", F.lit(None).cast(heads.schema["head"].dataType).alias("head"))
    both = heads.unionByName(body).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "part", F.col("turn").asc_nulls_first(), "role", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = summary_schema().append(pa.field("repaired_sha256", pa.string()))
        head, repaired, out = None, None, []
        for batch in batches:
            for part, conv, role, text, new in zip(*(batch.column(c).to_pylist() for c in ("part", "conv_id", "role", "text", "head")), strict=True):
                if part == 0:
                    if head:
                        out.append({**head, "repaired_sha256": repaired.digest()})
                    head, repaired = {"conv_id": conv, **new}, Repaired(new["audit"])
                else:
                    repaired.row(role, text)
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if head:
            out.append({**head, "repaired_sha256": repaired.digest()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return both.mapInArrow(hashed, SUMMARY + ", repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, text, left); rows not ``left`` only name a conversation."""
    dealt = rows.repartition("conv_id").sortWithinPartitions(*_order())
    return repaired_hashes(rows, materialise(audits(dealt), "audits"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


OP12_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS key
  FROM conversations
), drawn AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(key, lambda x: CAST(ascii(x) AS BIGINT))), lambda crc, b:
    list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS what
  FROM keyed
), damaged AS (
  SELECT c, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
    CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, LATERAL (SELECT unnest(range(CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy) t
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged
), judged AS (
  SELECT *, substr(role, 1, 1) AS initial,
    lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY pos) || substr(role, 1, 1) AS pair,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault
  FROM numbered
), edits AS (
  SELECT * FROM (VALUES (false), (true)) AS i(put_in), (VALUES ('D'), ('K'), ('R')) AS l(letter)
), paths AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT) AS pos, 0 AS state, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''} AS best FROM keyed
  UNION ALL
  SELECT c, pos, state, min(best) AS best FROM (
    SELECT c, pos, CASE letter WHEN 'D' THEN here
        WHEN 'K' THEN CASE WHEN initial = 's' AND here = 0 THEN 1 WHEN initial = 'u' AND here <> 2 THEN 2 WHEN initial = 'a' AND here = 2 THEN 3 END
        ELSE CASE WHEN here = 2 THEN 3 ELSE 2 END END AS state,
      {'cost': best.cost + CASE WHEN put_in THEN 3 ELSE 0 END + CASE letter WHEN 'D' THEN 4 WHEN 'K' THEN 0 ELSE 3 END
          + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END,
        'audit': best.audit || CASE WHEN put_in THEN 'I' ELSE '' END || letter,
        'lines': best.lines || CASE WHEN put_in THEN chr(10) || CASE WHEN state = 2 THEN 'assistant' ELSE 'user' END || ':' ELSE '' END
          || CASE letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text
            ELSE chr(10) || CASE WHEN here = 2 THEN 'assistant' ELSE 'user' END || ':' || text END} AS best
    FROM (SELECT p.c, r.pos, p.state, p.best, put_in, letter, r.initial, r.fault, r.role, r.text,
        CASE WHEN NOT put_in THEN p.state WHEN p.state = 2 THEN 3 ELSE 2 END AS here
      FROM paths p JOIN judged r ON r.c = p.c AND r.pos = p.pos + 1, edits)
    WHERE letter = 'D' OR fault NOT IN ('blank', 'duplicate'))
  WHERE state IS NOT NULL GROUP BY c, pos, state
), counted AS (
  SELECT k.c, any_value(k.conv_id) AS conv_id, max(j.n) AS n, max(j.gaps) AS gaps, max(j.blank) AS blank, max(j.duplicate) AS duplicate,
    max(j.truncated) AS truncated, max(j.illegal) AS illegal
  FROM keyed k LEFT JOIN (
    SELECT c, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
      count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
      count(*) FILTER (pos > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY c) j ON j.c = k.c
  GROUP BY k.c
), ended AS (
  SELECT p.c, min({'cost': p.best.cost + CASE p.state WHEN 2 THEN 3 ELSE 0 END, 'audit': p.best.audit || CASE p.state WHEN 2 THEN 'I' ELSE '' END,
    'lines': p.best.lines || CASE p.state WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END}) AS best
  FROM paths p JOIN counted n ON n.c = p.c AND p.pos = coalesce(n.n, 0) WHERE p.state IN (0, 2, 3) GROUP BY p.c
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost,
  best.audit AS audit, sha256(substr(best.lines, 2)) AS repaired_sha256
FROM counted JOIN ended USING (c)
"""
