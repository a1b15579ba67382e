"""Spelling variants against the comparison of all pairs of words."""

import random

import plain
import pyarrow as pa
from given import documents, edges, empty, stays  # noqa: F401
from pyspark.sql import functions as F

from aerometry.llm import spelling

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def found(docs, **parameters):
    return {
        row.word: (row.form, row.root, row.n, row.n_near, row.form_n)
        for row in spelling.group_variants(docs, **parameters).select(*COLUMNS).collect()
    }


def drawn(seed=3, n=400):
    """Words over few letters, many of them one edit apart, some of them frequent."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abÉ") for _ in range(rng.randint(5, 7))) for _ in range(90)]
    weights = [7 ** rng.randint(0, 4) for _ in words]
    separators = [" ", "×", "-", "\n", "7", "÷ "]
    return [
        (i, "".join(w + rng.choice(separators) for w in rng.choices(words, weights, k=60)))
        for i in range(n)
    ]


def test_variants_equal_all_pairs(documents):
    rows = [*drawn(), *drawn()[:5], (None, "Aababa " * 9), (7, "ABABAB" * 3)]
    expected = plain.variants(rows)
    assert found(documents(rows)) == expected
    assert sum(form is not None for form, *_ in expected.values()) > 5
    assert max(n_near for _, _, _, n_near, _ in expected.values()) > 3


def test_every_occurrence_may_be_damaged(documents):
    rows = [(i, "banana bandana bananas cabana") for i in range(60)]
    expected = plain.variants(rows, damaged=3)
    assert found(documents(rows), damaged=3) == expected and len(expected) > 4


def test_scan_joins_groups_cut_by_batches():
    """The same neighbours, however the sorted rotations are cut into batches."""
    rows = [("p$", f"w{i}", 100 - i, i % 3 > 0, i % 2 > 0) for i in range(5)]
    rows = [("a$", "solo", 9, True, True), *rows, ("q$", "x", 7, True, True), ("q$", "y", 7, False, False)]
    names = ["prefix", "word", "n", "skips", "first"]
    rows = [(p, w, n, s, s and f) for p, w, n, s, f in rows]
    whole = pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=names)
    expected = pa.Table.from_batches(list(spelling._scan(iter([whole]))))
    for size in (1, 2, 3):
        parts = [whole.slice(i, size) for i in range(0, len(whole), size)]
        again = pa.Table.from_batches(list(spelling._scan(iter(parts))))
        assert again.to_pylist() == expected.to_pylist()
    assert expected.num_rows


def test_a_group_of_the_whole_alphabet(documents):
    """Sixty words that differ in one letter only: sixty neighbours each, no pair is made."""
    letters = [chr(c) for c in range(0xE0, 0x100)] + [chr(c) for c in range(ord("a"), ord("z") + 1)]
    rows = [(i, " ".join(f"mirr{c}r" for c in letters)) for i in range(20)]
    expected = plain.variants(rows)
    assert found(documents(rows)) == expected
    assert expected["mirror"][3] >= len(letters) - 1


def test_long_chain_of_forms(documents):
    words = ["rotati" + "o" * k for k in range(6)]
    rows = [(k, f"{word} " * 5 ** (k + 1)) for k, word in enumerate(words)]
    got = found(documents(rows))
    assert got == plain.variants(rows)
    assert got["rotati"][:2] == (words[1], words[-1])


def test_rounds_leave_one_table(documents, stays):
    _, left = stays(lambda: spelling.group_variants(documents(drawn())))
    assert left == {"spelling-forms": 1, "spelling-roots": 1}


def test_edges(edges, empty):
    rows = [(row.doc_id, row.text) for row in edges.collect()]
    assert found(edges, least_count=1) == plain.variants(rows, least_count=1)
    assert found(empty) == {}


def test_rotations_are_as_many_as_places(spark):
    words = spark.createDataFrame([("abcabc", 5)], "word string, n long")
    made = spelling.rotations(words)
    assert made.count() == 13 and made.where(F.col("skips")).count() == 6
    assert {r.prefix for r in made.where(~F.col("skips")).collect()} >= {"abcabc$", "$abcabc", "c$abcab"}
