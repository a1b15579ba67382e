"""Conversation repair against edits tried one by one."""

import random
from itertools import groupby

import plain
import pytest
from given import documents  # noqa: F401

from aerometry.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost int, copy int, digest string"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, "d") for row in rows], SCHEMA)


def found(spark, rows):
    result = repair.repair_conversations(table(spark, rows)).collect()
    assert len({row.conv_id for row in result}) == len(result)
    return {row.conv_id: tuple(row[c] for c in COLUMNS) for row in result}


def expected(rows):
    ordered = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0))
    return {conv_id: plain.repaired(list(own)) for conv_id, own in groupby(ordered, key=lambda row: row[0])}


def drawn(n, seed=1):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "Assistant", "sys"]
    texts = ["Yes.", "No!", "so on", "", " \t\n\x0b", None, "why? ", "é", ".\x1c", "\r. \n"]
    rows = []
    for conv_id in range(n):
        for _ in range(rng.randint(0, 9)):
            turn = rng.choice([None, *range(-1, 6)])
            rows.append((conv_id, turn, rng.choice(roles), rng.choice(texts)))
    return [*rows, *rows[:40], (None, 1, "user", "a."), (None, None, "assistant", "b."), (-5, 2, "user", "x?")]


def test_repairs_equal_edits_tried_in_order(spark, documents):
    rows = drawn(300)
    got, wanted = found(spark, rows), expected(rows)
    assert got == wanted
    assert set("".join(row[6] for row in wanted.values())) == set("DIKR")


@pytest.mark.parametrize("seed", range(3))
def test_runs_equal_rows_taken_one_by_one(seed):
    """Long runs of one symbol, put together from powers, against the plain search."""
    rng = random.Random(seed)
    for _ in range(60):
        runs = [(rng.choice("suaoSUAOx"), rng.randint(1, 9)) for _ in range(rng.randint(0, 6))]
        merged = [(s, sum(n for _, n in own)) for s, own in groupby(runs, key=lambda r: r[0])]
        single = [(s, 1) for s, n in merged for _ in range(n)]
        cost, audit = repair.cheapest_edits(merged)
        assert (cost, audit) == repair.cheapest_edits(single)
        assert sum(edit != "I" for edit in audit) == len(single)


def test_a_very_long_run():
    cost, audit = repair.cheapest_edits([("u", 200_000), ("x", 100_000), ("a", 1)])
    assert len(audit) >= 300_001 and audit.count("D") >= 100_000
    assert cost == 4 * audit.count("D") + 3 * audit.count("R") + 3 * audit.count("I")


def test_hot_conversation_and_copies(spark, documents):
    """One conversation with a third of all rows, a row repeated a thousand times."""
    hot = [(1, t, "user" if t % 2 else "assistant", f"turn {t // 2}.") for t in range(400)]
    rows = [*hot, *[(2, 3, "user", "again")] * 1000, *drawn(40, 5)[20:]]
    got = found(spark, rows)
    wanted = expected([row for row in rows if row[0] != 2])
    assert {k: v for k, v in got.items() if k != 2} == {k: v for k, v in wanted.items() if k != 2}
    assert got[2][2] in (999, 1999) and got[2][6].count("D") >= 999


def test_repaired_turns_are_the_conversations(spark, documents):
    rows = repair.damaged(table(spark, drawn(50)))
    audited = repair.audited_conversations(rows)
    turns = repair.repaired_turns(rows, audited).collect()
    audits = {row.conv_id: row.audit for row in audited.collect()}
    assert turns
    for conv_id, own in groupby(turns, key=lambda row: row.conv_id):
        own = list(own)
        assert [row.position for row in own] == list(range(len(own)))
        assert "".join(row.edit for row in own) == audits[conv_id].replace("D", "")
        initials = "".join(row.role[0] for row in own)
        assert plain.re.fullmatch("(s?(ua)+)?", initials)


def test_empty_and_dropped(spark, documents):
    assert found(spark, []) == {}
    dropped = [(c, t, "user", "x.") for c in range(40) for t in range(9)
               if plain.zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert dropped
    for row in found(spark, dropped).values():
        assert row == (0, 0, 0, 0, 0, 0, "", plain.sha(""))


def test_gaps_beyond_a_long(spark, documents):
    least = -(1 << 63)
    rows = [(c, t, "user", "x.") for c in range(3) for t in (least, (1 << 63) - 1)]
    assert max(row[0] for row in found(spark, rows).values()) == (1 << 63) - 1
