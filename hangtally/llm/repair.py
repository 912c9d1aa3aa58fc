"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is in order when its role initials read ``(s?(ua)+)?``. Rows are kept, given another role, deleted, or
empty rows are put in. The least costly edits are a lightest derivation in a weighted deduction system:

* an item ``(i, state)`` says that the first i rows have become an output which ends in ``state``: nothing yet, ``s``, a
  whole pair, or a pair still waiting for its ``a``. The axiom is ``(0, nothing)``, the goals are ``nothing`` and ``pair`` at the end;
* a hyperedge joins an item with an edit that the next row allows (``edits``), or with an insertion, to a new item;
* the weight is (cost, audit), the audit holding the edits' initials. Joining adds costs and appends initials. That is
  superior (never lighter than the item it extends) and monotone: two audits of the same item and cost are never
  prefixes of each other, since a longer one would hold insertions more, which cost. So items leave the agenda
  (``lightest``) with their final weight, and ties of cost end in the ASCII-least audit.

A long conversation is solved in blocks of ``BLOCK`` rows. A block gives the lightest weight from each state it may be entered in
to each state it may be left in; blocks are joined by the same agenda, an item being a state at a block's end, a hyperedge
joining it with a block's weight. The rows are dealt by range of (conversation, turn), so one
conversation may spread over many tasks; only its blocks' weights meet in one task, read in order and never held together.

Costs: keep 0, new role user or assistant 2, delete 3, insert an empty user or assistant row 2, and 1 for each row not
deleted that is truncated. Blank and duplicate rows must be deleted. The first fault that holds counts: *blank* (nothing
but white space, U+0020 and U+0009 to U+000D), *duplicate* (same role and text earlier), *truncated* (the last character that is not
white space is none of ``.!?``).

Cases: null role or text is one space. Rows stand in the order of turn, nulls first, then role, then text. Equal rows are
rows of their own, all but the first duplicates. A null conv_id is a conversation of its own. A role that does not begin with
s, u or a, or is empty, cannot be kept. A conversation without rows has cost 0 and an empty audit; an empty table gives an empty
result. Very long texts stay in the JVM until the digest, which reads a conversation's repaired rows in order, one at
a time. A conversation's audit is one value and as long as the conversation. Further columns of any name are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import os.path
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from hangtally.llm.common import batch, prepare, rows_of, stored

BLOCK = 256
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SOUND, BLANK, DUPLICATE, CUT = range(4)
NOTHING, SYSTEM, PAIR, OPEN = range(4)
#: State and initial put out -> next state.
STEPS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): OPEN, (SYSTEM, "u"): OPEN, (PAIR, "u"): OPEN, (OPEN, "a"): PAIR}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
WHITE = " \t\n\x0b\f\r"

Weight = tuple   # (cost, audit, ...)
CONV = ["anon", "conv"]
BLOCKS = ("anon boolean, conv bigint, part int, block bigint, timed array<boolean>, turns array<bigint>, marks array<binary>, initials array<string>, "
          "illegal bigint, items array<struct<enter: int, leave: int, cost: bigint, audit: string>>")
PATHS = "anon boolean, conv bigint, part int, block bigint, enter int, leave int, cost bigint, illegal bigint"
EDITED = "anon boolean, conv bigint, part int, block bigint, place int, timed boolean, turn bigint, mark binary, new_role string"


def lightest(axioms: dict, deduce: Callable[[object, Weight], Iterable[tuple[object, Weight]]], goals: Iterable = ()) -> dict:
    """Items with their lightest weights, finalised lightest first, until all goals are final or nothing is left to deduce."""
    final, missing = {}, set(goals)
    agenda = [(w, item) for item, w in axioms.items()]
    heapq.heapify(agenda)
    while agenda:
        w, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = w
        missing.discard(item)
        if goals and not missing:
            break
        for new, weight in deduce(item, w):
            if new not in final:
                heapq.heappush(agenda, (weight, new))
    return final


def edits(initial: str, fault: int) -> list[tuple[str, int, str]]:
    """What a row may become: (initial put out, cost, edit)."""
    out = [("", DELETE, "D")]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT else 0
        if initial in ("s", "u", "a"):
            out.append((initial, KEEP + extra, "K"))
        out += [(r, REROLE + extra, "R") for r in ROLES if r != initial]
    return out


_EDITS = {(i, f): edits(i, f) for i in ("s", "u", "a", "") for f in range(4)}
_INSERTS = {q: [(STEPS[q, r], INSERT, "I") for r in ROLES if (q, r) in STEPS] for q in range(4)}


def crossings(rows: list[tuple[str, int]], enter: int) -> dict[int, Weight]:
    """Lightest weight of leaving the rows (initial, fault) in each state, entered in one state."""
    allowed = [_EDITS[i if i in ("s", "u", "a") else "", f] for i, f in rows]

    def deduce(item: tuple[int, int], w: Weight) -> Iterator[tuple[tuple[int, int], Weight]]:
        i, q = item
        for to, cost, letter in _INSERTS[q]:
            yield (i, to), (w[0] + cost, w[1] + letter)
        if i < len(allowed):
            for out, cost, letter in allowed[i]:
                to = STEPS.get((q, out)) if out else q
                if to is not None:
                    yield (i + 1, to), (w[0] + cost, w[1] + letter)

    ends = [(len(rows), q) for q in range(4)]
    final = lightest({(0, enter): (0, "")}, deduce, ends if enter == NOTHING else ends[1:])
    return {q: final[len(rows), q] for q in range(4) if (len(rows), q) in final}


def solved(rows: list[tuple[str, int]]) -> Weight:
    """(cost, audit) of a whole short conversation."""
    ends = crossings(rows, NOTHING)
    return min(ends[q] for q in (NOTHING, PAIR) if q in ends)


# ---- rows and their faults -------------------------------------------------------

def damaged(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with planted faults, told from crc32 of ``conv_id:turn`` modulo 20; null is one space."""
    kind = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return (turns.select("conv_id", "turn", "role", "text", kind.alias("kind")).where("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
            .drop("_copy"))


def _conversation() -> list[Column]:
    return [F.col("conv_id").isNull().alias("anon"), F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv")]


def judged(turns: DataFrame) -> DataFrame:
    """One row per set of equal rows: conversation, turn, role, text, mark (digest of role and text), copies, and the first copy's fault.

    Equal rows are counted first and faults come from aggregates, so no conversation and no repeated text meets in one task.
    """
    rows = turns.select(*_conversation(), F.col("turn").isNotNull().alias("timed"), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
                        *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    rows = rows.withColumn("mark", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    first = rows.groupBy(*CONV, "mark").agg(F.min(F.struct("timed", "turn")).alias("first"))
    ended = F.rtrim("text", F.lit(WHITE))
    fault = (F.when(ended == "", BLANK).when(F.struct("timed", "turn") != F.col("first"), DUPLICATE)
             .when(~F.right(ended, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(SOUND))
    return rows.join(first, [*CONV, "mark"]).withColumn("fault", fault).drop("first")


def measures(rows: DataFrame) -> DataFrame:
    """Per conversation of judged rows: gaps, blank, duplicate, truncated."""
    turn = F.when(F.col("timed"), F.col("turn"))
    by_turn = rows.groupBy(*CONV, turn.alias("turn")).agg(
        F.sum(F.when(F.col("fault") == BLANK, F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == DUPLICATE, F.col("copies")).when(F.col("fault") == BLANK, 0).otherwise(F.col("copies") - 1)).alias("duplicate"),
        F.count_if(F.col("fault") == CUT).alias("truncated"))
    return by_turn.groupBy(*CONV).agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
                                      *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


# ---- blocks, their chain, the edits ------------------------------------------------

def blocks_of(rows: DataFrame) -> DataFrame:
    """Blocks of judged rows with their weights: rows of ``BLOCKS``."""
    prepare(rows.sparkSession)
    schema = to_arrow_schema(_parse_datatype_string(BLOCKS))
    order = [*CONV, "timed", "turn", "role", "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, block, now, begun = TaskContext.get().partitionId(), [], [], 0, None, False

        def close() -> None:
            timed, turns, marks, initials, faults = map(list, zip(*held))
            told = list(zip(initials, faults))
            # only a block known to begin its conversation is entered with nothing put out
            items = [(q, to, *w) for q in ([NOTHING] if begun and not block else range(4)) for to, w in crossings(told, q).items()]
            wrong = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            made.append((*now, part, block, timed, turns, marks, initials, wrong,
                         [dict(zip(("enter", "leave", "cost", "audit"), x)) for x in items]))
            held.clear()

        for anon, conv, timed, turn, mark, initial, fault, copies in rows_of(batches):
            if (anon, conv) != now:
                if held:
                    close()
                begun, now, block = now is not None, (anon, conv), 0
            for k in range(copies):
                if len(held) == BLOCK:
                    close()
                    block += 1
                held.append((timed, turn, mark if k == 0 else None, initial, fault if k == 0 or fault == BLANK else DUPLICATE))
                if len(made) >= 500:
                    yield batch(schema, *zip(*made))
                    made.clear()
        if held:
            close()
        if made:
            yield batch(schema, *zip(*made))

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select(*CONV, "timed", "turn", "mark", F.left("role", F.lit(1)).alias("initial"), "fault", "copies").mapInArrow(work, BLOCKS)


def chained(blocks: DataFrame) -> DataFrame:
    """The lightest way through each conversation's blocks: rows of ``PATHS``; cost and illegal stand in the last block's row."""
    schema = to_arrow_schema(_parse_datatype_string(PATHS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, made, keys, backs, final, illegal, last = None, [], [], [], {}, 0, ""

        def close() -> None:
            state = min((w[:2], q) for q, w in final.items() if q in (NOTHING, PAIR))[1]
            cost, way = final[state][0], []
            for key, back in zip(reversed(keys), reversed(backs)):
                way.append((*now, *key, back[state], state))
                state = back[state]
            made.extend((*row, cost if k == 0 else 0, illegal if k == 0 else 0) for k, row in enumerate(way))

        for anon, conv, part, block, first, end, wrong, items in rows_of(batches):
            if (anon, conv) != now:
                if keys:
                    close()
                now, keys, backs, final, illegal, last = (anon, conv), [], [], {NOTHING: (0, "")}, 0, None
            if len(made) >= 5000:
                yield batch(schema, *zip(*made))
                made.clear()

            def deduce(item: tuple[int, int], w: Weight) -> Iterator[tuple[tuple[int, int], Weight]]:
                for x in items if item[0] == 0 else ():
                    if x["enter"] == item[1]:
                        yield (1, x["leave"]), (w[0] + x["cost"], w[1] + x["audit"], item[1])

            chart = lightest({(0, q): w for q, w in final.items()}, deduce)
            keys.append((part, block))
            backs.append({q: w[2] for (k, q), w in chart.items() if k})
            # a common beginning decides no tie to come
            same = len(os.path.commonprefix([w[1] for (k, _), w in chart.items() if k]))
            final = {q: (w[0], w[1][same:]) for (k, q), w in chart.items() if k}
            illegal += wrong + (last is not None and last + first not in LEGAL)
            last = end
        if keys:
            close()
        for at in range(0, len(made), 5000):
            yield batch(schema, *zip(*made[at:at + 5000]))

    ordered = blocks.select(*CONV, "part", "block", F.col("initials")[0].alias("first"), F.element_at("initials", -1).alias("end"), "illegal", "items")
    return ordered.repartition(*CONV).sortWithinPartitions(*CONV, "part", "block").mapInArrow(work, PATHS)


def chosen(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the audit of the way taken and the state it enters in."""
    taken = F.filter("items", lambda x: (x["enter"] == F.col("enter")) & (x["leave"] == F.col("leave")))[0]["audit"]
    return blocks.drop("illegal").join(paths, [*CONV, "part", "block"]).withColumn("audit", taken).drop("items")


def repaired(rows: DataFrame, ways: DataFrame) -> DataFrame:
    """The repaired conversations: anon, conv, part, block, place (their order), role, text."""
    schema = to_arrow_schema(_parse_datatype_string(EDITED))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for anon, conv, part, block, timed, turns, marks, initials, enter, audit in rows_of([b]):
                at, state = 0, enter
                for place, edit in enumerate(audit):
                    if edit != "D":
                        out = initials[at] if edit == "K" else "a" if state == OPEN else "u"
                        state = STEPS[state, out]
                        own = (None, None, None) if edit == "I" else (timed[at], turns[at], marks[at])
                        made.append((anon, conv, part, block, place, *own, None if edit == "K" else ROLES[out]))
                    at += edit != "I"
            if made:
                yield batch(schema, *zip(*made))

    edited = ways.select(*CONV, "part", "block", "timed", "turns", "marks", "initials", "enter", "audit").mapInArrow(work, EDITED)
    inserted = edited.where("mark is null").select(*CONV, "part", "block", "place", F.col("new_role").alias("role"), F.lit("").alias("text"))
    kept = edited.where("mark is not null").join(rows.select(*CONV, "timed", "turn", "mark", "role", "text"), [*CONV, "timed", "turn", "mark"])
    return kept.select(*CONV, "part", "block", "place", F.coalesce("new_role", "role").alias("role"), "text").union(inserted)


def digested(output: DataFrame) -> DataFrame:
    """Per repaired conversation: anon, conv, repaired_sha256 of its ``role:text`` rows joined by newlines."""
    out = "anon boolean, conv bigint, repaired_sha256 string"
    schema = to_arrow_schema(_parse_datatype_string(out))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, whole = None, None
        for b in batches:
            made = []
            for anon, conv, role, text in rows_of([b]):
                if (anon, conv) != now:
                    if whole is not None:
                        made.append((*now, whole.hexdigest()))
                    now, whole = (anon, conv), hashlib.sha256()
                else:
                    whole.update(b"\n")
                whole.update(f"{role}:{text}".encode())
            if made:
                yield batch(schema, *zip(*made))
        if whole is not None:
            yield batch(schema, *zip((*now, whole.hexdigest())))

    ordered = output.repartition(*CONV).sortWithinPartitions(*CONV, "part", "block", "place").select(*CONV, "role", "text")
    return ordered.mapInArrow(work, out)


def report(original: DataFrame, turns: DataFrame) -> DataFrame:
    """Per conversation of ``original``: faults of its rows in ``turns``, cost and audit of the repair, digest of the repaired rows."""
    rows = stored(judged(turns), "judged-turns")
    blocks = stored(blocks_of(rows), "repair-blocks")
    ways = stored(chosen(blocks, chained(blocks)), "repair-ways")
    plan = ways.groupBy(*CONV).agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
                                   F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    every = original.select("conv_id", *_conversation()).distinct()
    found = every.join(measures(rows), CONV, "left").join(plan, CONV, "left").join(digested(repaired(rows, ways)), CONV, "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return found.select("conv_id", *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
