"""Conversation structure repair: the cheapest edits that give a conversation its form.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Every
row becomes a symbol of its role and fault; equal consecutive symbols are one run. What
a symbol may cost between two places of the form is a 4 x 4 matrix over (min, +); a run
of n rows is its n-th power, put together from powers of two that are kept. From the
end of the conversation to its beginning they give the least cost from each place on;
then the runs are unrolled in halves, and every row takes the ASCII-least edit that
keeps the cost.

The rows of a conversation meet in one task without their texts: a symbol and a digest
each, and the audit, a character per edit, is a value of the result anyway. The texts
follow in a second pass behind their audit and are hashed as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerometry.llm.documents import BATCH_BYTES, kept

#: What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"

NEVER = 1 << 60
#: Places in the form: nothing yet, behind s, behind u, behind a; the first and last may end.
PLACES = range(4)
ENDS = (0, NEVER, NEVER, 0)
#: Where the role at hand leads from each place, if anywhere.
LEADS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: Role that the form asks for in each place, which a rerole or an insertion gives.
ASKED = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}

LEGAL = ("su", "ua", "au")
MOST_LONG = (1 << 63) - 1

Matrix = tuple[tuple[int, ...], ...]
Costs = tuple[int, ...]


# Damage and faults


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in, by ``crc32("conv_id:turn") % 20``; nulls read as a space.

    0 drops a row, 1 empties its text, 2 takes the sentence ends out of it, 3 repeats it,
    4 makes it the user's. A dropped row stays as one of ``copy`` -1 without role and
    text, so that no conversation disappears.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    fault = F.crc32(key) % 20
    text = F.coalesce("text", space)
    text = (
        F.when(fault == 1, F.lit(""))
        .when(fault == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
    )
    role = F.when(fault == 4, F.lit("user")).otherwise(F.coalesce("role", space))
    copies = (
        F.when(fault == 0, F.array(F.lit(-1)))
        .when(fault == 3, F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))
    )
    there = fault != 0
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(there, role).alias("role"),
        F.when(there, text).alias("text"),
        F.explode(copies).alias("copy"),
    )


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


#: Rows of a conversation in order; rows alike in all of these are copies.
ORDER = ("turn", "role", "digest")


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows as (conv_id, turn, role, digest, times, seen, blank, truncated), copies counted.

    ``seen``: an earlier row of the conversation has this role and text. Copies are
    added up before they are shuffled; of the rest, rows of one role and text are put in
    order to find the first.
    """
    ended = F.rtrim("text", F.lit(BLANK_CHARACTERS))
    told = rows.select(
        "conv_id",
        "turn",
        "role",
        digest(F.col("text")).alias("digest"),
        (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    group = ["conv_id", "turn", "role", "digest", "blank", "truncated"]
    counted = told.groupBy(*group).agg(F.count("digest").alias("times"))
    along = Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    return counted.withColumn("seen", F.row_number().over(along) > 1)


# Costs


def symbol_costs(symbol: str) -> tuple[int | None, int]:
    """What keeping a row costs (None: it must go) and the role's initial it has."""
    return (None if symbol == "x" else TRUNCATED if symbol.isupper() else 0), symbol.lower()


def _product(left: Matrix, right: Matrix) -> Matrix:
    return tuple(
        tuple(min(left[p][k] + right[k][q] for k in PLACES) for q in PLACES) for p in PLACES
    )


def _ahead(matrix: Matrix, costs: Costs) -> Costs:
    return tuple(min(NEVER, *(matrix[p][q] + costs[q] for q in PLACES)) for p in PLACES)


@lru_cache(maxsize=None)
def insertions() -> Matrix:
    """Least cost of getting from place to place by insertions alone."""
    steps = [[0 if p == q else NEVER for q in PLACES] for p in PLACES]
    for p in PLACES:
        place, cost = p, 0
        while steps[p][LEADS[ASKED[place]][place]] > cost + INSERT:
            place, cost = LEADS[ASKED[place]][place], cost + INSERT
            steps[p][place] = cost
    return tuple(map(tuple, steps))


@lru_cache(maxsize=None)
def power(symbol: str, twos: int) -> Matrix:
    """Costs of ``2 ** twos`` rows of a symbol, with insertions before each."""
    if twos:
        half = power(symbol, twos - 1)
        return _product(half, half)
    keep, role = symbol_costs(symbol)
    own = [[NEVER] * 4 for _ in PLACES]
    for p in PLACES:
        own[p][p] = DELETE
        if keep is not None:
            asked = ASKED[p]
            if asked != role:
                own[p][LEADS[asked][p]] = keep + REROLE
            kept_at = LEADS.get(role, (None,) * 4)[p]
            if kept_at is not None:
                own[p][kept_at] = keep
    return _product(insertions(), tuple(map(tuple, own)))


def before_run(symbol: str, times: int, costs: Costs) -> Costs:
    """Least costs from each place on ahead of a run, from those behind it."""
    twos = 0
    while times:
        if times & 1:
            costs = _ahead(power(symbol, twos), costs)
        times, twos = times >> 1, twos + 1
    return costs


# Choices


def _unrolled(symbol: str, times: int, place: int, costs: Costs) -> tuple[str, int]:
    """The ASCII-least cheapest edits of a run and the place they end in; costs from behind it."""
    if times == 1:
        return _row_edits(symbol, place, costs)
    half = 1 << (times - 1).bit_length() - 1
    rest = times - half
    first, place = _unrolled(symbol, half, place, _level(before_run(symbol, rest, costs)))
    second, place = _unrolled(symbol, rest, place, costs)
    return first + second, place


@lru_cache(maxsize=1 << 14)
def _row_edits(symbol: str, place: int, costs: Costs) -> tuple[str, int]:
    """Insertions and the edit of one row."""
    ahead = _ahead(power(symbol, 0), costs)
    keep, role = symbol_costs(symbol)
    edits = ""
    while DELETE + costs[place] != ahead[place]:
        asked = LEADS[ASKED[place]][place]
        kept_at = LEADS.get(role, (None,) * 4)[place]
        if INSERT + ahead[asked] == ahead[place]:
            edits, place = edits + "I", asked
        elif kept_at is not None and keep + costs[kept_at] == ahead[place]:
            return edits + "K", kept_at
        else:
            return edits + "R", asked
    return edits + "D", place


def _level(costs: Costs) -> Costs:
    """Costs above the least of them: choices depend on these only, which are few."""
    least = min(costs)
    return tuple(min(NEVER, c - least) for c in costs)


def cheapest_edits(runs: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and audit of a conversation given as runs of symbols.

    A symbol is a role's initial, ``o`` for any other, in capitals if the row is
    truncated, or ``x`` if it must go.
    """
    costs = _ahead(insertions(), ENDS)
    behind = []
    for symbol, times in reversed(runs):
        behind.append(_level(costs))
        least = min(costs)
        costs = tuple(c + least for c in before_run(symbol, times, _level(costs)))
    place, audit = 0, []
    for (symbol, times), after in zip(runs, reversed(behind), strict=True):
        edits, place = _unrolled(symbol, times, place, after)
        audit.append(edits)
    while ENDS[place]:
        audit.append("I")
        place = LEADS[ASKED[place]][place]
    return costs[0], "".join(audit)


# Passes over the rows of each conversation

AUDITED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string"
)


def audits(faults: DataFrame) -> DataFrame:
    """Counts, cost and audit per conversation."""
    known = F.col("digest").isNotNull()
    initial = F.substring("role", 1, 1)
    symbol = F.when(F.col("blank"), F.lit("b")).when(F.col("seen"), F.lit("d"))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    symbol = symbol.when(F.col("truncated"), F.upper(letter)).otherwise(letter)
    rows = faults.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        F.when(known, letter).alias("letter"),
        F.when(known, symbol).alias("symbol"),
        F.col("times"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    return ordered.select("conv_id", "turn", "letter", "symbol", "times").mapInArrow(_audit, AUDITED)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = []
    for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
        found.append((conv_id, *_conversation(rows)))
        if len(found) >= 1000 or len(found[-1][-1]) > 1 << 20:
            yield _batch(found, AUDITED)
            found = []
    yield _batch(found, AUDITED)


def _batch(found: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    columns = zip(*found, strict=True) if found else [()] * len(fields)
    return pa.record_batch(
        [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _conversation(rows: Iterator[tuple]) -> tuple:
    runs: list[list] = []
    counts = dict.fromkeys("bdt", 0)
    first = last = before = None
    turns = illegal = 0
    for _, turn, letter, symbol, times in rows:
        if symbol is None:
            continue
        if turn is not None and turn != last:
            first = turn if first is None else first
            last, turns = turn, turns + 1
        if before is not None:
            illegal += before + letter not in LEGAL
        illegal += (times - 1) * (letter + letter not in LEGAL)
        before = letter
        # Further copies of a row are duplicates, unless blank.
        if symbol == "b":
            counts["b"] += times
            parts = [("x", times)]
        elif symbol == "d":
            counts["d"] += times
            parts = [("x", times)]
        else:
            counts["t"] += symbol.isupper()
            counts["d"] += times - 1
            parts = [(symbol, 1), ("x", times - 1)]
        for name, n in parts:
            if not n:
                continue
            if runs and runs[-1][0] == name:
                runs[-1][1] += n
            else:
                runs.append([name, n])
    gaps = 0 if first is None else min(MOST_LONG, last - first + 1 - turns)
    cost, audit = cheapest_edits([tuple(run) for run in runs])
    return gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit


TURNS = "conv_id long, position long, turn long, role string, text string, edit string"
HASHED = "conv_id long, repaired_sha256 string"


def repaired_turns(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """What is left of the conversations: rows in ``position`` from 0, each with its edit.

    The rows of a conversation follow its audit in one sorted stream, so neither is
    repeated for the other and no text waits in memory. They stay together in order.
    """
    texts = rows.where(F.col("copy") >= 0).select(
        "conv_id", "turn", "role", digest(F.col("text")).alias("digest"), "text", F.lit(1).alias("kind")
    )
    ahead = audited.select("conv_id", F.col("audit").alias("text"), F.lit(0).alias("kind"))
    together = texts.unionByName(ahead, allowMissingColumns=True)
    ordered = together.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)
    return ordered.select("conv_id", "turn", "role", "text").mapInArrow(_repair, TURNS)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, size = [], 0
    for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
        audit = next(rows)[3]
        for position, line in enumerate(_repaired(audit, rows)):
            found.append((conv_id, position, *line))
            size += 50 + len(line[2])
            if size > BATCH_BYTES:
                yield _batch(found, TURNS)
                found, size = [], 0
    yield _batch(found, TURNS)


def _repaired(audit: str, rows: Iterator[tuple]) -> Iterator[tuple]:
    """The lines (turn, role, text, edit) that an audit leaves of a conversation's rows."""
    place = 0
    for edit in audit:
        turn, role, text = None, ROLES[ASKED[place]], ""
        if edit != "I":
            _, turn, own, text = next(rows)
            if edit == "D":
                continue
            role = own if edit == "K" else role
        yield turn, role, text, edit
        place = LEADS[role[0]][place]


def turn_digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of every conversation's ``role:text`` by line, of turns as :func:`repaired_turns` gives them."""
    return turns.select("conv_id", "role", "text").mapInArrow(_hash, HASHED)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = []
    for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
        hashed, separator = hashlib.sha256(), ""
        for _, role, text in rows:
            hashed.update(f"{separator}{role}:{text}".encode())
            separator = "\n"
        found.append((conv_id, hashed.hexdigest()))
    yield _batch(found, HASHED)


def audited_conversations(rows: DataFrame) -> DataFrame:
    """Counts, cost and audit of every conversation, as a table."""
    return kept(audits(with_faults(rows)), "conversation-audits")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Per original conv_id: faults after the damage, cost, audit and digest of the repair.

    Rows of one turn are in the order of role, then the SHA-256 of their text. A null
    conv_id is a conversation of its own; null roles and texts are one space, so such
    a row is blank or has a role that no form holds. A conversation without rows has
    zeros, an empty audit and the digest of nothing. Gaps beyond a long are its
    largest value. An empty table gives no rows.
    """
    rows = damaged(conversations)
    audited = audited_conversations(rows)
    hashed = turn_digests(repaired_turns(rows, audited)).withColumnRenamed("conv_id", "_conv")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return audited.join(hashed, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        *audited.columns, F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )
