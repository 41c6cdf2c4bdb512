"""Operator 11: cheapest repair of conversations, by a dynamic program over a trie of their signatures.

A conversation's rows stand in the order of turn (nulls first), role and text. A row's fault is the first that holds:
blank (no word), duplicate (role and text seen earlier in the conversation) or truncated (its last character that is no
white space isn't one of . ! ?). Edits: Keep (0), Rerole to user or assistant (2), Delete (3, and needed for blank and
duplicate rows), Insert an empty user or assistant turn (2); a truncated row that stays adds 1. The cheapest edits whose
roles read (s?(ua)+)? are taken, of several the one whose initials come first in ASCII.

A row counts only by its initial and fault, so a conversation is a word over nine symbols, its signature. Distinct
signatures are sorted and dealt by ranges; a task walks them as a trie, depth first: a layer of the program holds, for
each of four states, the cost, the rank of its edits among the states and a step back, and layers are computed once for
each prefix that neighbours share. A layer's size doesn't depend on its depth. Answers go out at terminal nodes. Edits of
equal cost are compared by ranks: each layer's edit strings have one letter for each row so far and end in it, so none
is a prefix of another and the earlier difference decides.

A signature that many conversations share is joined through SALTS parts, so no task gets all of them. Faults are found
in groups of equal (conversation, role, text). SHA-256 and the order of turns are sequential, so the rows of one
conversation pass through one task, as a sorted stream that spills; it holds one symbol and one edit for each row, never
the texts.

Null conv_id is a conversation; null roles and texts are one space; rows equal in turn, role and text are separate rows
(the later ones duplicates); texts may be of any length; a conversation without rows has the empty answer; an empty table
gives no rows; further columns are ignored.
"""

import functools
import hashlib
import os
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, partitions, saved

SPACE = " \t\n\x0b\x0c\r"
SALTS = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
#: Where a role's initial leads from a state: 0 nothing yet, s after a system turn, u and a after those. 0 and a may end.
STATES = "0sua"
LEADS = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
#: Inserts that lead from a state to an end.
CLOSING = {"0": "", "a": "", "u": "I", "s": "II"}
#: A symbol is - for rows that must go, else the initial (x: any other one), a capital if the row is truncated.
REPORT = "conv_id long, signature string, gaps long, blank long, duplicate long, truncated long, illegal long"
ANSWER = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, place long, edit string, role string, text string"


def next_role(state: str) -> str:
    """The only role that may be inserted, or given to a row, in this state."""
    return "a" if state == "u" else "u"


@functools.cache
def moves(state: str, symbol: str) -> list[tuple]:
    """(state after, cost, edits) of all ways to take one row, with up to two inserts before it; three never pay."""
    found, edits, cost = [], "", 0
    for _ in range(3):
        found.append((state, cost + DELETE, edits + "D"))
        if symbol != "-":
            role, extra = symbol.lower(), TRUNCATED * symbol.isupper()
            if (state, role) in LEADS:
                found.append((LEADS[state, role], cost + extra + KEEP, edits + "K"))
            found.append((next_role(state), cost + extra + REROLE, edits + "R"))
        state, edits, cost = next_role(state), edits + "I", cost + INSERT
    return found


@functools.lru_cache(100_000)
def step(layer: tuple, symbol: str) -> tuple[tuple, int, dict]:
    """The next layer, how much dearer it is, and for each of its states (state before, edits).

    A layer is ((state, cost above the layer's least, rank), ...), so layers far apart in the trie are often equal.
    """
    best: dict = {}
    for state, cost, rank in layer:
        for after, more, edits in moves(state, symbol):
            way = (cost + more, rank, edits, state)
            if after not in best or way < best[after]:
                best[after] = way
    least = min(way[0] for way in best.values())
    order = sorted(best, key=lambda s: best[s][1:3])
    return tuple((s, best[s][0] - least, k) for k, s in enumerate(order)), least, {s: (best[s][3], best[s][2]) for s in order}


def solve(signatures: Iterable[str]) -> Iterator[tuple[str, int, str]]:
    """signature, cost, edits of sorted signatures; the layers of what one shares with the one before are kept."""
    path: list = [((("0", 0, 0),), 0, {})]  # of each prefix: the layer, its least cost, the steps back
    last = ""
    for signature in signatures:
        shared = len(os.path.commonprefix([last, signature]))
        del path[shared + 1 :]
        for symbol in signature[shared:]:
            layer, least, back = step(path[-1][0], symbol)
            path.append((layer, path[-1][1] + least, back))
        last = signature
        layer, least, _ = path[-1]
        cost, _, state = min((cost + INSERT * len(CLOSING[s]), rank, s) for s, cost, rank in layer)
        edits = [CLOSING[state]]
        for _, _, back in path[:0:-1]:
            state, taken = back[state]
            edits.append(taken)
        yield signature, least + cost, "".join(reversed(edits))


def _told(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def undamaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, live of turns as they are; nulls are one space."""
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _told("role").alias("role"), _told("text").alias("text"), F.lit(True).alias("live"))


def damaged(turns: DataFrame) -> DataFrame:
    """The same after a damage that each row's own key decides: see the contract. Of a dropped row one stays that isn't live, so no conversation is lost."""
    rows = undamaged(turns).withColumn("kind", F.crc32(F.concat(_told("conv_id"), F.lit(":"), _told("turn")).cast("binary")) % 20)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    yes, no = F.lit(True), F.lit(False)
    live = F.explode(F.when(F.col("kind") == 0, F.array(no)).when(F.col("kind") == 3, F.array(yes, yes)).otherwise(F.array(yes)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), live.alias("live"))


def with_faults(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, live) with initial, fault, symbol, and late: of equal rows the first isn't."""
    body = F.rtrim("text", F.lit(SPACE))
    again = F.row_number().over(Window.partitionBy("live", "conv_id", "role", "text").orderBy("turn")) > 1
    fault = F.when(body == "", "blank").when(again, "duplicate").when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated")
    initial = F.left("role", F.lit(1))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    rows = rows.withColumn("fault", fault).withColumn("initial", initial).withColumn("symbol", symbol)
    return rows.withColumn("late", F.coalesce(F.col("fault") == "duplicate", F.lit(False)))


def _in_order(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition(partitions(rows), "conv_id").sortWithinPartitions("conv_id", *order)


def signatures(rows: DataFrame) -> DataFrame:
    """REPORT of each conversation of rows with faults."""

    schema = arrow_schema(REPORT)

    def read(batches):
        import pyarrow as pa

        names = ["blank", "duplicate", "truncated"]

        def done(c):
            gaps = c["last"] - c["first"] + 1 - c["turns"] if c["turns"] else 0
            return (c["conv_id"], c["symbols"].decode(), gaps, *[c[n] for n in names], c["illegal"])

        c = None
        for batch in batches:
            out = []
            for conv_id, live, turn, initial, fault, symbol in zip(*(x.to_pylist() for x in batch.columns)):
                if c is None or c["conv_id"] != conv_id:
                    out += [] if c is None else [done(c)]
                    c = {"conv_id": conv_id, "symbols": bytearray(), "first": None, "last": None, "turns": 0, "initial": None, "illegal": 0} | dict.fromkeys(names, 0)
                if not live:
                    continue
                if turn is not None and turn != c["last"]:
                    c["turns"] += 1
                    c["first"], c["last"] = turn if c["first"] is None else c["first"], turn
                if fault is not None:
                    c[fault] += 1
                c["illegal"] += c["initial"] is not None and c["initial"] + initial not in ("su", "ua", "au")
                c["initial"] = initial
                c["symbols"] += symbol.encode()
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
        if c is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, done(c)))], schema)

    ordered = _in_order(rows, "live", "turn", "role", "text", "late")
    return ordered.select("conv_id", "live", "turn", "initial", "fault", "symbol").mapInArrow(read, REPORT)


def answers(report: DataFrame) -> DataFrame:
    """report with the cost and the edits (audit) of each conversation's signature."""

    solution = "signature string, cost long, audit string, salts array<int>"
    schema = arrow_schema(solution)

    def walk(batches):
        salts: list = []

        def rows():
            for batch in batches:
                for signature, parts in zip(*(x.to_pylist() for x in batch.columns)):
                    salts.append(parts)
                    yield signature

        columns = []
        for row in solve(rows()):
            columns.append((*row, salts.pop(0)))
            if len(columns) == 1000:
                yield batch_of(columns)
                columns = []
        if columns:
            yield batch_of(columns)

    def batch_of(rows):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    salted = report.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    words = salted.groupBy("signature", "salt").count().groupBy("signature").agg(F.collect_list("salt").alias("salts"))
    words = words.repartitionByRange(partitions(report), "signature").sortWithinPartitions("signature")
    solved = words.mapInArrow(walk, solution).select("signature", "cost", "audit", F.explode("salts").alias("salt"))
    return salted.join(solved, ["signature", "salt"]).drop("salt")


def edited(audit: str) -> Iterator[tuple[str, int]]:
    """Of each row its edit, after the number of turns inserted before it; the turns inserted at the end come with an empty edit."""
    inserts = 0
    for edit in audit:
        if edit == "I":
            inserts += 1
        else:
            yield edit, inserts
            inserts = 0
    yield "", inserts


def _conversations(batches) -> Iterator[tuple]:
    """("head", report row) and ("turn", edit, role, text) of each conversation in turn, from rows behind their heads."""

    def inserted(state, n):
        for _ in range(n):
            state = next_role(state)
            yield state

    state, plan = "0", None

    def tail():
        for role in inserted(state, next(plan)[1]):
            yield "turn", "I", ROLES[role], ""

    for batch in batches:
        for row in zip(*(x.to_pylist() for x in batch.columns)):
            conv_id, report, role, text = row
            if report is not None:
                if plan is not None:
                    yield from tail()
                state, plan = "0", edited(report["audit"])
                yield "head", conv_id, report
                continue
            edit, n = next(plan)
            for state in inserted(state, n):  # noqa: B020
                yield "turn", "I", ROLES[state], ""
            if edit == "K":
                state = LEADS[state, role[:1]]
                yield "turn", edit, role, text
            elif edit == "R":
                state = next_role(state)
                yield "turn", edit, ROLES[state], text
    if plan is not None:
        yield from tail()


def _behind_heads(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The rows of each conversation, in order, behind one row with its report."""
    head = F.struct(*[c for c in report.columns if c not in ("conv_id", "signature")])
    heads = report.select("conv_id", head.alias("report"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(False).alias("late"))
    live = rows.where("live").select("conv_id", F.lit(None).cast(heads.schema["report"].dataType).alias("report"), "turn", "role", "text", "late")
    both = heads.unionByName(live).withColumn("_body", F.col("report").isNull())
    return _in_order(both, "_body", "turn", "role", "text", "late").select("conv_id", "report", "role", "text")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, turn, role, text, live) with their faults, stored, and the report with cost and audit of each conversation."""
    rows = saved(with_faults(rows), "conversation-rows")
    return rows, answers(saved(signatures(rows), "conversation-signatures"))


def repaired_turns(rows: DataFrame, report: DataFrame) -> DataFrame:
    """TURNS: the turns of the repaired conversations, numbered from 0, with the edit that each comes from."""

    schema = arrow_schema(TURNS)

    def write(batches):
        import pyarrow as pa

        out, place, conv = [], 0, None
        for kind, *what in _conversations(batches):
            if kind == "head":
                conv, place = what[0], 0
                continue
            out.append((conv, place, *what))
            place += 1
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return _behind_heads(rows, report).mapInArrow(write, TURNS)


def digests(rows: DataFrame, report: DataFrame) -> DataFrame:
    """ANSWER: the report with the hash of each repaired conversation, role:text, joined by newlines."""

    schema = arrow_schema(ANSWER)

    def write(batches):
        import pyarrow as pa

        out, said = [], None
        for kind, *what in _conversations(batches):
            if kind == "head":
                if said is not None:
                    out[-1]["repaired_sha256"] = said.hexdigest()
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
                said, start = hashlib.sha256(), ""
                out.append({"conv_id": what[0], **what[1]})
            else:
                said.update(f"{start}{what[1]}:{what[2]}".encode())
                start = "\n"
        if out:
            out[-1]["repaired_sha256"] = said.hexdigest()
            yield pa.RecordBatch.from_pylist(out, schema)

    return _behind_heads(rows, report).mapInArrow(write, ANSWER)
