"""Conversation structure repair by iterative-deepening A*.

A conversation's rows (in order) become the roles ``s? (u a)*`` by edits:
Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty turn 5; a
truncated row that stays adds 5, blank and repeated rows must go.  The search
is depth first in ASCII order of the edits (D, I, K, R) under a cost bound
that rises to the least estimate beyond it, with a table of states (row,
expected role) and the budget with which they failed; the first path that
accepts is the cheapest, and of the cheapest the ASCII-least.

The estimate is the cost of the relaxed problem in which a conversation may
end after a user turn, computed backwards over the rows.  One inserted
assistant turn mends that, so the estimate is at most 5 too low, the bound
rises at most five times, and the search is linear in the rows.

Spark does the rest: faults and order come from windows, one task reads the
one-byte codes of a conversation (never its texts) and writes an edit per
row, the edits are joined to the rows by conversation and place, and the
repaired text is hashed as a stream, a row at a time.  A conversation's
memory is a few dozen bytes per row.

Defined cases: NULL roles and texts, and NULLs in the damage key, read as one
space.  Rows of one turn are ordered by role, then text (a repeated row follows its
original).  A role's initial is its first character; an empty role has none and
cannot be kept.  Rows of NULL conv_id form one conversation.  Extra columns
are ignored; an empty table gives no rows; a conversation without rows left
gives zeros, an empty audit and the digest of the empty string.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlens.llm.common import table

# --- fixed values: the contract's costs, fault names and edits ---
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FINE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)  # roles so far; the first and the last may end
FAR = 1 << 30
GONE = -1
SUMMARY_PLACE = 1 << 62


def damage(turns: DataFrame) -> DataFrame:
    """The contract's damaged rows; a dropped row stays as a marker (``gone``)."""
    def spaced(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    key = F.pmod(F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))), F.lit(20))
    out = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), key.alias("hit"))
    text = F.when(F.col("hit").isin(0, 1), F.lit("")) \
        .when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.select("conv_id", "turn", (F.col("hit") == 0).alias("gone"),
                      F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                      text.alias("text"), F.explode(copies).alias("copy"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) with place in the conversation and first fault."""
    order = [F.col("gone"), F.col("turn").asc_nulls_first(), "role", "text"]
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("gone", "place"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(F.col("gone"), GONE).when(last == "", BLANK).when(F.col("seen") > 1, DUPLICATE) \
        .when(~last.isin(".", "!", "?"), CUT).otherwise(FINE)
    return rows.withColumn("place", place.cast("long")).withColumn("seen", seen) \
        .select("conv_id", "place", "turn", "role", "text", fault.alias("fault"))


def estimates(roles: str, faults: Sequence[int]) -> list[array]:
    """Least cost from (state, row) if a conversation may end in any state."""
    n = len(roles)
    user = array("i", bytes(4 * (n + 1)))  # a user turn is next
    reply = array("i", user)               # an assistant turn is next
    start = array("i", user)
    for i in range(n - 1, -1, -1):
        u, a, s = user[i + 1] + DELETE, reply[i + 1] + DELETE, start[i + 1] + DELETE
        if faults[i] not in (BLANK, DUPLICATE):
            more = TRUNCATED if faults[i] == CUT else 0
            to_user = more + (0 if roles[i] == "u" else REROLE) + reply[i + 1]
            u, s = min(u, to_user), min(s, to_user)
            a = min(a, more + (0 if roles[i] == "a" else REROLE) + user[i + 1])
            if roles[i] == "s":
                s = min(s, more + user[i + 1])
        u, a = min(u, INSERT + a), min(a, INSERT + u)
        user[i], reply[i], start[i] = u, a, min(s, INSERT + a)
    return [start, user, reply, user]


def _moves(role: str | None, fault: int, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows taken, next state) in ASCII order of the edits; no role: no row is left."""
    then = AFTER_A if state == AFTER_U else AFTER_U
    insert = ("I", INSERT, 0, then)
    if role is None:
        return [insert]
    out = [("D", DELETE, 1, state), insert]
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED if fault == CUT else 0
        if role == "s" and state == START:
            out.append(("K", more, 1, AFTER_S))
        elif role == ("a" if state == AFTER_U else "u"):
            out.append(("K", more, 1, then))
        out.append(("R", more + REROLE, 1, then))
    return out


def cheapest_edits(roles: str, faults: Sequence[int]) -> tuple[int, str]:
    """(cost, audit): the ASCII-least of the cheapest edit strings.

    ``roles`` holds one initial per row (a space or any other letter cannot be kept).
    """
    n = len(roles)
    least = estimates(roles, faults)
    options = {(r, f, s): _moves(r, f, s) for r in {*roles, None} for f in {*faults, FINE} for s in range(4)}
    bound = least[START][0]
    while True:
        failed = [array("i", [-1]) * (n + 1) for _ in range(4)]  # budget of the failed states
        beyond = FAR
        path = bytearray()
        # the branch: state, cost so far and next edit to try at every node; its row follows from the path
        state, spent, tried, row = bytearray([START]), array("q", [0]), bytearray([0]), 0
        while state:
            here, cost = state[-1], spent[-1]
            if row == n and here in (START, AFTER_A):
                return cost, path.decode()
            moves = options[(roles[row], faults[row], here) if row < n else (None, FINE, here)]
            pick = tried[-1]
            while pick < len(moves):
                edit, price, taken, then = moves[pick]
                pick += 1
                total = cost + price
                goal = total + least[then][row + taken]
                if goal > bound:
                    beyond = min(beyond, goal)
                elif bound - total > failed[then][row + taken]:
                    tried[-1] = pick
                    path += edit.encode()
                    row += taken
                    state.append(then)
                    spent.append(total)
                    tried.append(0)
                    break
            else:
                failed[here][row] = max(failed[here][row], bound - cost)
                state.pop(), spent.pop(), tried.pop()
                if path:
                    row -= path.pop() != ord("I")
        bound = beyond


def replay(audit: str, roles: str) -> tuple[list[tuple[str, str, str]], str]:
    """Per row (initials inserted before it, its edit, the role it gets if rerolled), and the initials inserted last."""
    rows, lead, state = [], "", START
    for edit in audit:
        then = AFTER_A if state == AFTER_U else AFTER_U
        role = "a" if then == AFTER_A else "u"
        if edit == "I":
            lead, state = lead + role, then
            continue
        if edit == "K" and state == START and roles[len(rows)] == "s":
            then = AFTER_S
        rows.append((lead, edit, role))
        lead = ""
        if edit != "D":
            state = then
    return rows, lead


PLAN = ("key string, place long, lead string, edit string, new_role string, gaps long, blank long, duplicate long, "
        "truncated long, illegal long, cost long, audit string")
FULL = {"u": "user", "a": "assistant"}  # fixed values: roles that an edit writes
LEGAL = ("su", "ua", "au")
PART = 100_000  # rows of a yielded frame


def _plan(key: str | None, roles: str, faults: bytearray, turns: array) -> Iterator[tuple]:
    cost, audit = cheapest_edits(roles, faults)
    edits, tail = replay(audit, roles)
    for i, (lead, edit, role) in enumerate(edits):
        yield (key, i + 1, lead, edit, FULL[role], 0, 0, 0, 0, 0, 0, "")
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(1 for x, y in zip(roles, roles[1:]) if x + y not in LEGAL)
    yield (key, SUMMARY_PLACE, tail, "", "", gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT),
           illegal, cost, audit)


def _plans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of each conversation from its sorted (key, initial, fault, turn) rows, then one summary row."""
    def conversations():
        held = None
        for b in batches:
            for key, role, fault, turn in zip(b["key"], b["initial"], b["fault"].tolist(), b["turn"]):
                if held is None or held[0] != key:
                    if held is not None:
                        yield held
                    held = (key, [], bytearray(), array("q"))
                if fault != GONE:
                    held[1].append(role)
                    held[2].append(fault)
                    if turn is not None:
                        held[3].append(int(turn))
        if held is not None:
            yield held

    out = []
    columns = [c.split(" ")[0] for c in PLAN.split(", ")]
    for key, roles, faults, turns in conversations():
        for line in _plan(key, "".join(roles), faults, turns):
            out.append(line)
            if len(out) >= PART:
                yield pd.DataFrame(out, columns=columns)
                out = []
    if out:
        yield pd.DataFrame(out, columns=columns)


RESULT = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from its sorted edits and rows (an edit comes right before its row)."""
    digest, first, edit = hashlib.sha256(), True, None

    def line(text: str) -> None:
        nonlocal first
        digest.update((text if first else "\n" + text).encode("utf-8", "surrogatepass"))
        first = False

    for b in batches:
        out = []
        for r in b.itertuples(index=False):
            if r.kind:  # a row; rows that are gone have no edit before them
                if edit is not None and edit.edit != "D":
                    line((edit.new_role if edit.edit == "R" else r.role) + ":" + r.text)
                edit = None
                continue
            for c in r.lead:
                line(FULL[c] + ":")
            edit = r
            if r.place == SUMMARY_PLACE:
                out.append((r.key, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                            digest.hexdigest()))
                digest, first, edit = hashlib.sha256(), True, None
        if out:
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in RESULT.split(", ")])


def plans(rows: DataFrame) -> DataFrame:
    """Edits per row and a summary per conversation of ``with_faults`` rows."""
    codes = rows.select(F.col("conv_id").cast("string").alias("key"), "place",
                        F.rpad(F.substring("role", 1, 1), 1, " ").alias("initial"), "fault",
                        F.col("turn").cast("string").alias("turn"))
    return codes.repartition("key").sortWithinPartitions("key", "place").mapInPandas(_plans, PLAN)


def repair(turns: DataFrame) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired text per conversation of (conv_id, turn, role, text, gone)."""
    kind = turns.schema["conv_id"].dataType
    rows = table(with_faults(turns), "repair-rows")
    edits = plans(rows).withColumns({"kind": F.lit(0), "role": F.lit(""), "text": F.lit("")})
    texts = rows.select(F.col("conv_id").cast("string").alias("key"), "place", "role", "text", F.lit(1).alias("kind"))
    both = edits.unionByName(texts, allowMissingColumns=True) \
        .fillna("", ["lead", "edit", "new_role", "audit"]) \
        .fillna(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"])
    out = both.repartition("key").sortWithinPartitions("key", "place", "kind").mapInPandas(_hashes, RESULT)
    return out.select(F.col("key").cast(kind).alias("conv_id"), *[c.split(" ")[0] for c in RESULT.split(", ")[1:]])


def _oracle() -> str:
    from creditlens.llm.periodic import CRC32_SQL

    space = r"[\x20\x09-\x0D]"
    return f"""
WITH RECURSIVE spaced AS (SELECT conv_id, turn, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k,
  coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
hit AS (SELECT *, {CRC32_SQL.format(s="k")} % 20 AS hit FROM spaced),
damaged AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN hit = 1 THEN '' WHEN hit = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hit WHERE hit <> 0),
conv AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i
  FROM damaged d JOIN conv v ON d.conv_id IS NOT DISTINCT FROM v.conv_id),
faulty AS (SELECT *, substr(role, 1, 1) AS r, CASE WHEN regexp_matches(text, '^{space}*$') THEN 1
  WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 2
  WHEN regexp_matches(text, '[.!?]{space}*$') THEN 0 ELSE 3 END AS f,
  lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY i) AS before FROM placed),
-- forward search: cheapest, then least, audit per (conversation, rows taken, state, insertions in a row)
path AS (
  SELECT c, 0::BIGINT AS i, 0 AS s, 0 AS ins, 0::BIGINT AS cost, '' AS audit, '' AS body FROM conv
  UNION ALL
  SELECT c, i, s, ins, cost, audit, body FROM (
    SELECT *, row_number() OVER (PARTITION BY c, i, s, ins ORDER BY cost, audit) AS rank FROM (
      SELECT p.c, p.i + 1 AS i, e.s, 0 AS ins, p.cost + e.cost AS cost, p.audit || e.edit AS audit,
        p.body || e.line AS body
      FROM (SELECT * FROM path UNION ALL
            SELECT c, i, CASE WHEN s = 2 THEN 3 ELSE 2 END, 1, cost + 5, audit || 'I',
              body || CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END || chr(10) FROM path
            UNION ALL
            SELECT c, i, CASE WHEN s = 2 THEN 2 ELSE 3 END, 2, cost + 10, audit || 'II',
              body || CASE WHEN s = 2 THEN 'assistant:' || chr(10) || 'user:' ELSE 'user:' || chr(10) || 'assistant:' END
              || chr(10) FROM path) p
      JOIN faulty x ON x.c = p.c AND x.i = p.i + 1,
      LATERAL (SELECT unnest([
        {{'edit': 'D', 'cost': 2, 's': p.s, 'line': '', 'ok': true}},
        {{'edit': 'K', 'cost': CASE WHEN x.f = 3 THEN 5 ELSE 0 END, 's': 1, 'line': x.role || ':' || x.text || chr(10),
          'ok': x.f NOT IN (1, 2) AND p.s = 0 AND x.r = 's'}},
        {{'edit': 'K', 'cost': CASE WHEN x.f = 3 THEN 5 ELSE 0 END, 's': CASE WHEN p.s = 2 THEN 3 ELSE 2 END,
          'line': x.role || ':' || x.text || chr(10),
          'ok': x.f NOT IN (1, 2) AND x.r = CASE WHEN p.s = 2 THEN 'a' ELSE 'u' END}},
        {{'edit': 'R', 'cost': CASE WHEN x.f = 3 THEN 6 ELSE 1 END, 's': CASE WHEN p.s = 2 THEN 3 ELSE 2 END,
          'line': CASE WHEN p.s = 2 THEN 'assistant:' ELSE 'user:' END || x.text || chr(10),
          'ok': x.f NOT IN (1, 2)}}], recursive := true)) e WHERE e.ok)) WHERE rank = 1),
ended AS (SELECT p.* FROM (SELECT c, i, s, cost, audit, body FROM path UNION ALL
  SELECT c, i, 3, cost + 5, audit || 'I', body || 'assistant:' || chr(10) FROM path WHERE s = 2 UNION ALL
  SELECT c, i, 3, cost + 10, audit || 'II', body || 'user:' || chr(10) || 'assistant:' || chr(10) FROM path WHERE s = 1) p
  JOIN (SELECT v.c, count(f.i) AS n FROM conv v LEFT JOIN faulty f ON f.c = v.c GROUP BY v.c) z ON z.c = p.c AND z.n = p.i
  WHERE s IN (0, 3)),
best AS (SELECT c, arg_min({{'cost': cost, 'audit': audit, 'body': body}}, {{'a': cost, 'b': audit}}) AS b FROM ended GROUP BY c),
summed AS (SELECT c, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (f = 1) AS blank,
  count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated,
  count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY c)
SELECT v.conv_id, coalesce(m.gaps, 0)::BIGINT AS gaps, coalesce(m.blank, 0)::BIGINT AS blank,
  coalesce(m.duplicate, 0)::BIGINT AS duplicate, coalesce(m.truncated, 0)::BIGINT AS truncated,
  coalesce(m.illegal, 0)::BIGINT AS illegal, b.b.cost::BIGINT AS cost, b.b.audit AS audit,
  sha256(CASE WHEN b.b.body = '' THEN '' ELSE substr(b.b.body, 1, length(b.b.body) - 1) END) AS repaired_sha256
FROM conv v JOIN best b ON b.c = v.c LEFT JOIN summed m ON m.c = v.c"""


ORACLE_SQL = _oracle()
