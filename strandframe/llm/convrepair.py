"""Conversation structure repair by iterative-deepening A*: the cheapest edits that turn a conversation's roles into
``(s?(ua)+)?``.

Edits, by their initials: Keep a turn (0), Rerole it to user or assistant (2), Delete it (3; blank and repeated turns must
go), Insert an empty turn of a user or assistant (2, anywhere); a truncated turn that stays costs 1. The search goes
depth first over the edits in ASCII order (D, I, K, R) under a bound on cost so far plus a lower bound of the rest; the
bound rises to the least value that was cut off. What failed is remembered by (turn, state) with the cost that was left.
So the first path that is accepted is the cheapest and, of equals, the least string.

A state is what the roles so far allow next: 0 nothing yet, 1 behind system, 2 behind user, 3 behind assistant. It decides
the role of Insert and Rerole, so a string of edits stands for one result.

Conversations of up to ``LONG`` turns are searched whole. Longer ones, which may hold any share of all rows, are sorted by
ranges and cut into pieces of ``PIECE`` turns. Each piece is searched from each state to each state, always to the end of
its last turn (insertions belong to the turn behind them), so no path of a piece is the beginning of another and the order
of whole strings is decided within one piece. Then the cheapest chain of pieces is found from a few numbers for each.

Defined results: a null role or text is one space; conversations of null id are one; turns that share a number stand in
the order of role, then md5 of the text, then place; a role that begins with neither s, u nor a can't be kept; a
conversation without turns (all rows marked as not present) needs no edit; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strandframe.llm.common import PLACE, attach, placed, stage

#: Turns of a conversation that is searched whole, at most; turns of a piece of a longer one.
LONG, PIECE = 128, 64
#: The states' next role, the state behind it, and what it costs to end there.
ROLE, NEXT, END = ("user", "user", "assistant", "user"), (2, 2, 3, 2), (0, 4, 2, 0)
COST = {"D": 3, "I": 2, "K": 0, "R": 2}
NEVER = 1 << 40


def kept_state(state: int, initial: str) -> int | None:
    """The state behind a turn that is kept."""
    if initial == "s":
        return 1 if state == 0 else None
    return NEXT[state] if initial == ROLE[state][0] else None


def lower_bounds(turns: list[tuple[str, bool, bool]], goal: int | None) -> list[tuple[int, int, int, int]]:
    """For each place among the turns (initial, must go, truncated), and each state there, a lower bound of the cost of the
    rest.

    A turn that must go costs 3; one that stays costs 1 if it is truncated, and 2 more if its role has to change. Two turns
    that could stay, one behind the other, with roles that may not follow each other cost 2 more: one is deleted or
    changed, or something is inserted between them. So does the first with what its state allows, and the last with the
    goal. Pairs that share no turn add up; the best choice of pairs counts.
    """
    if goal in (0, 1):  # nothing, or one system turn, is left: all others go
        out, most, s_turn = [tuple(0 if s == goal else NEVER for s in range(4))], 0, NEVER
        for initial, must_go, truncated in reversed(turns):
            most, s_turn = most + 3, min(s_turn, int(truncated) - 3 if initial == "s" and not must_go else NEVER)
            out.append((most if goal == 0 else min(NEVER, most + s_turn), most if goal == 1 else NEVER, NEVER, NEVER))
        return out[::-1]
    ends = ("a",) if goal is None else ("", "s", "u", "a")[goal]
    nothing = END if goal is None else tuple(0 if s == goal else NEVER for s in range(4))
    out = [nothing]
    system = False  # whether one of them is system's: one at most stays what it is, and only from state 0
    gone = 0  # of the turns from here on that must go
    alone, follow, ahead = 0, None, 0  # best from the next turn that could stay; that turn; best from the one behind it
    for initial, must_go, truncated in reversed(turns):
        if must_go:
            gone += 3
        else:
            odd, system = initial not in ("u", "a"), system or initial == "s"
            own = min(3, 2 + truncated) if odd else int(truncated)
            if follow is None:
                clash = 0 if odd or initial in ends else 2
                best = own + clash
            else:
                before, odd_before, own_before = follow
                clash = 0 if odd or odd_before or initial + before in ("su", "ua", "au") else 2
                best = max(own + alone, own + own_before + clash + ahead)
            alone, ahead, follow = best, (alone if follow is not None else 0), (initial, odd, own)
        if follow is None:
            out.append(tuple(min(NEVER, gone + x) for x in nothing) if goal is None else tuple(gone for _ in range(4)))
        else:
            initial_, odd_, own_ = follow
            out.append(tuple(gone + max(alone, own_ + ahead + (0 if odd_ or kept_state(state, initial_) is not None else 2)) - 2 * (system and state == 0) for state in range(4)))
    return out[::-1]


def search(turns: list[tuple[str, bool, bool]], start: int = 0, goal: int | None = None) -> tuple[int, str] | None:
    """(cost, edits): the cheapest from state ``start``, of equals the least string; None if there are none.

    goal: the state to end in, with the last turn's edit as the last one; if it is None, any end that is accepted.
    """
    n = len(turns)
    if goal is not None:
        if not n:
            return (0, "") if goal == start else None
    rest = lower_bounds(turns, goal)
    bound = rest[0][start]
    while bound < NEVER:
        failed: dict[tuple[int, int], int] = {}
        beyond = NEVER
        path: list[str] = []
        frames = [[0, start, 0, 0]]  # turn, state, cost so far, next edit
        while frames:
            frame = frames[-1]
            i, state, cost, edit = frame
            if not edit:
                least = cost + rest[i][state]
                if least > bound or failed.get((i, state), -1) >= bound - cost:
                    beyond = min(beyond, least) if least > bound else beyond
                    frames.pop()
                    del path[-1:]
                    continue
                if i == n and (state == goal if goal is not None else END[state] == 0):
                    return cost, "".join(path)
            new = None
            while edit < 4 and new is None:
                kind = "DIKR"[edit]
                edit += 1
                if kind == "I":
                    if goal is None or i < n:
                        new = (i, NEXT[state], cost + 2)
                elif i < n:
                    initial, must_go, truncated = turns[i]
                    if kind == "D":
                        new = (i + 1, state, cost + 3)
                    elif not must_go:
                        after = kept_state(state, initial) if kind == "K" else NEXT[state]
                        new = None if after is None else (i + 1, after, cost + COST[kind] + truncated)
            frame[3] = edit
            if new is None:
                failed[i, state] = max(failed.get((i, state), -1), bound - cost)
                frames.pop()
                del path[-1:]
            else:
                path.append(kind)
                frames.append([*new, 0])
        bound = beyond
    return None


def apply(turns: list[tuple[str, str]], edits: str, state: int = 0) -> tuple[list[dict], int]:
    """The turns (role, text) after the edits, and the state behind them."""
    out, at = [], iter(turns)
    for kind in edits:
        if kind == "I":
            out.append({"role": ROLE[state], "text": ""})
        else:
            role, text = next(at)
            if kind == "D":
                continue
            if kind == "K":
                out.append({"role": role, "text": text})
                if role[:1] == "s":
                    state = 1
                    continue
            else:
                out.append({"role": ROLE[state], "text": text})
        state = NEXT[state]
    return out, state


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def is_truncated(text: Column) -> Column:
    """Whether the last character that is no white space ends no sentence."""
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present, copy, the columns PLACE): rows damaged by crc32(``conv_id:turn``) % 20: 0 drops
    one (present is false), 1 empties its text, 2 takes [.!?] out of it, 3 repeats it, 4 makes it a user's."""
    rows = placed(conversations.select("conv_id", "turn", "role", "text"), "conversations")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("kind", F.crc32(name.cast("binary")) % 20)
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"), text.alias("text"), (F.col("kind") != 0).alias("present"), copies.alias("copy"), *PLACE)


_PIECES = "conv_id long, part int, piece long, whole boolean, first_turn long, last_turn long, first_role string, last_role string, turns long, different long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>"
_SEARCHED = _PIECES.replace("cost long, audit string, repaired", "costs array<long>, audits array<string>, rows")


def _described(rows: list[dict]) -> tuple[dict, list[tuple[str, bool, bool]]]:
    """The faults of turns in order, and the turns as the search takes them."""
    kinds, turns = [], []
    for r in rows:
        must_go = r["blank"] or r["repeated"]
        kinds.append("blank" if r["blank"] else "duplicate" if r["repeated"] else "truncated" if r["cut"] else "")
        turns.append((r["role"][:1], must_go, kinds[-1] == "truncated"))
    numbers = [r["turn"] for r in rows if r["turn"] is not None]
    legal = {"su", "ua", "au"}
    about = {
        "first_turn": numbers[0] if numbers else None, "last_turn": numbers[-1] if numbers else None, "first_role": turns[0][0] if turns else None, "last_role": turns[-1][0] if turns else None, "turns": len(rows),
        "different": len(set(numbers)), **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")}, "illegal": sum(a[0] + b[0] not in legal for a, b in zip(turns, turns[1:], strict=False)),
    }
    return about, turns


def _runs(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[list[dict]]:
    """Rows of one conversation that follow each other, up to ``most`` at a time."""
    run: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if run and (row["conv_id"] != run[0]["conv_id"] or len(run) == most):
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def _whole(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out = []
    for run in _runs(batches, None):
        rows, seen = [r for r in run if r["present"]], set()
        for r in rows:
            r["repeated"] = (r["role"], r["text"]) in seen
            seen.add((r["role"], r["text"]))
        about, turns = _described(rows)
        cost, audit = search(turns)
        out.append({"conv_id": run[0]["conv_id"], "part": 0, "piece": 0, "whole": True, **about, "cost": cost, "audit": audit, "repaired": apply([(r["role"], r["text"]) for r in rows], audit)[0]})
        if len(out) >= 500:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for number, run in enumerate(_runs(batches, PIECE)):
        rows = [r for r in run if r["present"]]
        about, turns = _described(rows)
        found = [search(turns, s, t) for s in range(4) for t in range(4)]
        row = {"conv_id": run[0]["conv_id"], "part": run[0]["part"], "piece": number, "whole": False, **about, "costs": [NEVER if f is None else f[0] for f in found], "audits": ["" if f is None else f[1] for f in found], "rows": [{"role": r["role"], "text": r["text"]} for r in rows]}
        yield pa.RecordBatch.from_pylist([row], schema)


_CHAIN = "c_part int, c_piece long, start int, goal int, tail int, again long, clash long"


def _chained(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """For each piece the states it goes from and to on the conversation's cheapest path, the insertions behind the last
    one, and what lies across its border with the piece before: a turn number again, roles that don't follow each other.

    Kept of a conversation: for each piece, which state each state was best reached from.
    """

    def ended(pieces: list[tuple[int, int, int, int]], back: bytearray, cost: list[int], rank: list[int]) -> Iterator[dict]:
        t = min(range(4), key=lambda s: (cost[s] + END[s], rank[s]))
        rows = []
        for k in range(len(pieces) - 1, -1, -1):
            s = back[4 * k + t]
            part, piece, again, clash = pieces[k]
            rows.append({"c_part": part, "c_piece": piece, "start": s, "goal": t, "tail": 0, "again": again, "clash": clash})
            t = s
        rows[0]["tail"] = END[rows[0]["goal"]] // 2
        for at in range(0, len(rows), 500):
            yield rows[at : at + 500]

    conv, pieces = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if not pieces or r["conv_id"] != conv:
                if pieces:
                    for rows in ended(pieces, back, cost, rank):
                        yield pa.RecordBatch.from_pylist(rows, schema)
                conv, pieces, back, cost, rank, turn, role = r["conv_id"], [], bytearray(), [0, NEVER, NEVER, NEVER], [0, 1, 2, 3], None, None
            again = int(turn is not None and r["first_turn"] == turn)
            clash = int(role is not None and r["first_role"] is not None and role + r["first_role"] not in ("su", "ua", "au"))
            turn, role = (turn if r["last_turn"] is None else r["last_turn"]), (role if r["last_role"] is None else r["last_role"])
            pieces.append((r["part"], r["piece"], again, clash))
            best = [min(range(4), key=lambda s, t=t: (cost[s] + r["costs"][4 * s + t], rank[s])) for t in range(4)]
            # Of two strings the one that leaves an earlier one of the states before is less; from the same state, by the piece.
            order = sorted(range(4), key=lambda t: (rank[best[t]], r["ranks"][4 * best[t] + t]))
            cost = [min(NEVER, cost[best[t]] + r["costs"][4 * best[t] + t]) for t in range(4)]
            rank = [order.index(t) for t in range(4)]
            back += bytes(best)
    if pieces:
        for rows in ended(pieces, back, cost, rank):
            yield pa.RecordBatch.from_pylist(rows, schema)


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def repair(rows: DataFrame) -> DataFrame:
    """Pieces of conversations, of up to LONG turns each: conv_id, part, piece (their order), whole, first_turn, last_turn,
    turns, different (turn numbers), blank, duplicate, truncated, illegal, cost, audit, repaired (role, text).

    rows: conv_id, turn, role and text without null, present (rows that aren't only vouch for their conversation), copy
    and the columns PLACE, which tell rows apart.
    """
    rows = rows.withColumn("blank", is_blank(F.col("text"))).withColumn("cut", is_truncated(F.col("text")))
    counts = rows.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > LONG)
    long_ = stage(counts, "conversations-long")
    any_long = bool(long_.limit(1).count())
    marked = attach(rows, long_, ["conv_id"], "n") if any_long else rows.withColumn("n", F.lit(None).cast("long"))
    order = ["turn", "role", "digest", *PLACE, "copy"]
    marked = marked.withColumn("digest", F.md5(F.col("text").cast("binary")))
    short = marked.filter("n is null").select("conv_id", *order, "text", "present", "blank", "cut").repartition("conv_id").sortWithinPartitions("conv_id", *order)
    done = short.select("conv_id", "turn", "role", "text", "present", "blank", "cut").mapInArrow(functools.partial(_whole, schema=_arrow(_PIECES)), _PIECES)
    if not any_long:
        return done
    own = stage(marked.filter("n is not null").select("conv_id", *order, "text", "present", "blank", "cut"), "conversations-turns")
    keyed = own.withColumn("k1", F.xxhash64("role", "text")).withColumn("k2", F.xxhash64(F.lit(7), "role", "text"))  # 128 bits
    place = F.struct("turn", *PLACE, "copy")
    firsts = keyed.filter("present").groupBy("conv_id", "k1", "k2").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    firsts = stage(firsts.select("conv_id", "k1", "k2", "n", *[F.col(f"first.{c}").alias(f"f_{c}") for c in ("turn", *PLACE, "copy")]), "conversations-firsts")
    same = F.lit(True)
    for c in ("turn", *PLACE, "copy"):
        same = same & F.col(c).eqNullSafe(F.col(f"f_{c}"))
    flagged = attach(keyed, firsts, ["conv_id", "k1", "k2"], "n").withColumn("repeated", F.col("n").isNotNull() & ~same)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = flagged.repartitionByRange(parts, "conv_id", *order).sortWithinPartitions("conv_id", *order).select("conv_id", "turn", "role", "text", "present", "blank", "cut", "repeated", F.spark_partition_id().alias("part"))
    pieces = stage(ranged.mapInArrow(functools.partial(_pieces, schema=_arrow(_SEARCHED)), _SEARCHED), "conversations-pieces")
    # The place of each of a start's four strings among them.
    ranks = F.transform("audits", lambda a, i: F.size(F.filter(F.slice("audits", (F.floor(i / 4) * 4 + 1).cast("int"), 4), lambda b: b < a)))
    light = pieces.select("conv_id", "part", "piece", "first_turn", "last_turn", "first_role", "last_role", "costs", ranks.alias("ranks")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    chain = stage(light.mapInArrow(functools.partial(_chained, schema=_arrow(_CHAIN)), _CHAIN), "conversations-chain")
    chosen = pieces.join(chain, (F.col("part") == F.col("c_part")) & (F.col("piece") == F.col("c_piece")))

    @F.arrow_udf("array<struct<role:string,text:string>>")
    def repaired(turns: pa.Array, audit: pa.Array, start: pa.Array, tail: pa.Array) -> pa.Array:
        out = []
        for t, a, s, k in zip(turns.to_pylist(), audit.to_pylist(), start.to_pylist(), tail.to_pylist(), strict=True):
            out.append(apply([(x["role"], x["text"]) for x in t], a + "I" * k, s)[0])
        return pa.array(out, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))

    at = F.col("start") * 4 + F.col("goal")
    audit = F.get("audits", at)
    out = chosen.withColumn("cost", F.get("costs", at) + 2 * F.col("tail")).withColumn("repaired", repaired("rows", audit, "start", "tail")).withColumn("audit", F.concat(audit, F.repeat(F.lit("I"), F.col("tail"))))
    out = out.withColumn("different", F.col("different") - F.col("again")).withColumn("illegal", F.col("illegal") + F.col("clash"))
    return done.unionByName(out.select(*done.columns))


_SUMS = ("different", "blank", "duplicate", "truncated", "illegal", "cost")
_DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _joined(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row for each conversation from its pieces in order; texts pass by, and only sums, the audit and the state of the
    hash are kept."""

    def row() -> pa.RecordBatch:
        gaps = 0 if low is None else high - low + 1 - sums["different"]
        out = {"conv_id": conv, "gaps": gaps, **{k: sums[k] for k in _SUMS[1:]}, "audit": "".join(audit), "repaired_sha256": hash_.hexdigest()}
        return pa.RecordBatch.from_pylist([out], schema)

    conv, sums = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            if sums is None or r["conv_id"] != conv:
                if sums is not None:
                    yield row()
                conv, sums, audit, hash_, begun, low, high = r["conv_id"], dict.fromkeys(_SUMS, 0), [], hashlib.sha256(), False, None, None
            for k in _SUMS:
                sums[k] += r[k]
            low, high = (r["first_turn"] if low is None else low), (high if r["last_turn"] is None else r["last_turn"])
            audit.append(r["audit"])
            if r["lines"] is not None:
                hash_.update(("\n" * begun + r["lines"]).encode())
                begun = True
    if sums is not None:
        yield row()


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation; the hash
    is of the repaired turns, ``role:text``, joined by newlines.

    Only long conversations' pieces are shuffled once more; a hash can't be split, so one task sees such a conversation's
    pieces pass by.
    """
    pieces = repair(rows)
    lines = F.array_join(F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("different"), F.lit(0).cast("long"))
    pieces = stage(pieces.withColumn("lines", F.when(F.size("repaired") > 0, lines)).drop("repaired"), "conversations-repaired")
    one = pieces.filter("whole").select("conv_id", gaps.alias("gaps"), *_SUMS[1:], "audit", F.sha2(F.coalesce("lines", F.lit("")), 256).alias("repaired_sha256"))
    more = pieces.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").select("conv_id", "first_turn", "last_turn", *_SUMS, "audit", "lines")
    return one.unionByName(more.mapInArrow(functools.partial(_joined, schema=_arrow(_DIGEST)), _DIGEST))


def oracle_sql() -> str:
    """DuckDB SQL for the digests of damaged conversations: turn by turn, the cheapest and least edits to each state."""
    blank = "[^\\x20\\x09-\\x0D]"
    return f"""
WITH RECURSIVE source AS (
  SELECT row_number() OVER () AS row, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS name FROM conversations
), bytes AS (
  SELECT row, name, range(0, len(name)) AS places FROM source
), table_ AS (
  SELECT n, list_reduce([n::BIGINT] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(0, 256) t(n)
), crc AS (
  SELECT row, xor(list_reduce([4294967295::BIGINT] || list_transform(places, lambda i: ascii(name[i + 1])::BIGINT), lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1])), 4294967295) % 20 AS kind FROM bytes, (SELECT list(v ORDER BY n) AS tab FROM table_)
), damaged AS (
  SELECT row, conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM source JOIN crc USING (row) WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), row, copy) AS i FROM damaged
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{blank}') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
    substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed
), about AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM judged GROUP BY conv_id
), steps AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM about
  UNION ALL
  SELECT conv_id, i, state, cost, audit, lines FROM (
    WITH inserted AS (
      SELECT conv_id, i, state, cost, audit, lines FROM steps
      UNION ALL SELECT conv_id, i, CASE state WHEN 2 THEN 3 ELSE 2 END, cost + 2, audit || 'I', lines || [CASE state WHEN 2 THEN 'assistant:' ELSE 'user:' END] FROM steps
      UNION ALL SELECT conv_id, i, CASE state WHEN 2 THEN 2 ELSE 3 END, cost + 4, audit || 'II', lines || CASE state WHEN 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END FROM steps
    ), next AS (SELECT s.*, j.role, j.text, j.initial, j.fault FROM inserted s JOIN judged j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = s.i + 1
    ), moved AS (
      SELECT conv_id, i + 1 AS i, state, cost + 3 AS cost, audit || 'D' AS audit, lines FROM next
      UNION ALL SELECT conv_id, i + 1, CASE WHEN initial = 's' THEN 1 WHEN initial = 'u' THEN 2 ELSE 3 END, cost + (fault = 'truncated')::INT, audit || 'K', lines || [role || ':' || text] FROM next
        WHERE fault NOT IN ('blank', 'duplicate') AND (initial = 's' AND state = 0 OR initial = 'u' AND state <> 2 OR initial = 'a' AND state = 2)
      UNION ALL SELECT conv_id, i + 1, CASE state WHEN 2 THEN 3 ELSE 2 END, cost + 2 + (fault = 'truncated')::INT, audit || 'R', lines || [CASE state WHEN 2 THEN 'assistant:' ELSE 'user:' END || text] FROM next WHERE fault NOT IN ('blank', 'duplicate')
    )
    SELECT *, row_number() OVER (PARTITION BY conv_id, i, state ORDER BY cost, audit) AS r FROM moved
  ) WHERE r = 1
), ended AS (
  SELECT s.conv_id, s.cost + [0, 4, 2, 0][state + 1] AS cost, s.audit || repeat('I', [0, 2, 1, 0][state + 1]) AS audit, s.lines || [[], ['user:', 'assistant:'], ['assistant:'], []][state + 1] AS lines FROM steps s JOIN about a ON s.conv_id IS NOT DISTINCT FROM a.conv_id AND s.i = a.n
), best AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS r FROM ended
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN about a ON o.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id AND b.r = 1
"""
