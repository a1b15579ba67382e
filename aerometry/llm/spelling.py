"""Spelling variants: words one edit apart, found among sorted rotations (permuterm).

A word marked with a terminator, ``word$``, has a rotation for every place to cut it.
The rotation that begins behind a character ends with that character; without it, what
is left names the word but for one skipped character. So two words of equal length that
differ in one character share such a prefix, and a word with one character fewer has
the whole prefix as a rotation of its own. Sorted by prefix, all near words of a word
lie in its groups. A group holds at most one word per letter of the alphabet and one
shorter word, whatever the corpus, and is scanned once: every member learns the number
of its neighbours there and the most frequent one; no pairs are made.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometry.llm.documents import Passing, kept

#: Letters of a word, its least length and count, how much more frequent
#: the form must be, and which occurrences lose a character.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5
DAMAGED = 199

TERMINATOR = "$"
#: Distinct words that a task counts before it hands them on.
COUNTED = 300_000


def occurring_words(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    damaged: int = DAMAGED,
) -> DataFrame:
    """``word`` and ``n`` of the words of all texts, after the damage.

    A run of letters, A-Z in lower case, loses its code point ``h % length`` where
    ``damaged`` divides h, the crc32 of ``<doc_id>:<run>``. A null text has no runs; a
    null doc_id reads as an empty one. Each task adds up its own words first.
    """
    # Maximal runs: a shorter run has no part that is long enough.
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for at in range(batch.num_rows):
                key = zlib.crc32(f"{batch[0][at].as_py() or ''}:".encode())
                # Of bytes, lower() changes A-Z only.
                text = batch[1][at].as_buffer().to_pybytes().lower().decode(errors="replace")
                for word, n in Counter(runs.findall(text)).items():
                    h = zlib.crc32(word.encode(), key)
                    if h % damaged == 0:
                        skipped = h % len(word)
                        word = word[:skipped] + word[skipped + 1 :]
                        if len(word) < least_length:
                            continue
                    total[word] += n
                if len(total) > COUNTED:
                    yield _counts(total)
                    total.clear()
        yield _counts(total)

    texts = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("string"), F.col("text").cast("string")
    )
    parts = texts.mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _counts(total: Counter[str]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
        names=["word", "n"],
    )


def rotations(words: DataFrame) -> DataFrame:
    """A row per word and place: the prefix it can be found by.

    ``skips`` rows leave out the character before the cut; the others are whole
    rotations. In a run of equal characters leaving out any gives the same word, so
    only its ``first`` one counts where a character is added or removed.
    """
    place, length = F.col("_place"), F.length("word")
    head = F.col("word").substr(F.lit(1), place)
    tail = F.col("word").substr(place + 1, length)
    tail_after = F.col("word").substr(place + 2, length)
    own, before = (F.col("word").substr(at, F.lit(1)) for at in (place + 1, place))
    mark = F.lit(TERMINATOR)
    whole = F.struct(
        F.concat(tail, mark, head).alias("prefix"),
        F.lit(False).alias("skips"),
        F.lit(False).alias("first"),
    )
    skipping = F.struct(
        F.concat(tail_after, mark, head).alias("prefix"),
        F.lit(True).alias("skips"),
        ((place == 0) | (own != before)).alias("first"),
    )
    places = words.withColumn("_place", F.explode(F.sequence(F.lit(0), length)))
    both = F.when(place < length, F.array(whole, skipping)).otherwise(F.array(whole))
    return places.select("word", "n", F.inline(both))


SCANNED = "word string, n_near long, form string, form_n long"


def neighbours(words: DataFrame) -> DataFrame:
    """Per word with neighbours: how many, and the most frequent, ties to the smallest.

    Rotations are dealt by prefix and sorted, so that groups follow one another; a
    group cut by the end of a batch is put together.
    """
    rows = rotations(words)
    ordered = rows.repartition("prefix").sortWithinPartitions("prefix", F.desc("n"), "word")
    found = ordered.select("prefix", "word", "n", "skips", "first").mapInArrow(_scan, SCANNED)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
        .select("word", "n_near", F.col("_best.form").alias("form"), (-F.col("_best.less")).alias("form_n"))
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        if not len(table):
            continue
        # The last group may go on in the next batch.
        end = int(_group_starts(table.column("prefix"))[-1])
        if end:
            yield from _scanned(table.slice(0, end))
        rest = table.slice(end)
    if rest is not None:
        yield from _scanned(rest)


def _group_starts(prefix: pa.ChunkedArray) -> np.ndarray:
    prefix = prefix.combine_chunks()
    changed = pc.not_equal(prefix[1:], prefix[:-1])
    return np.concatenate([[0], np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1])


def _scanned(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The neighbours of every member of whole groups, which are in order of -n, word."""
    starts = _group_starts(table.column("prefix"))
    sizes = np.diff(np.append(starts, len(table)))
    alone = np.repeat(sizes == 1, sizes)
    if alone.all():
        return
    table = table.filter(pa.array(~alone))
    sizes = sizes[sizes > 1]
    starts = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(table))
    skips = table.column("skips").to_numpy()
    first = table.column("first").to_numpy()
    none = len(table)
    # The best and second best skipping member, the best that counts for a shorter word.
    top = np.minimum.reduceat(np.where(skips, at, none), starts)
    second = np.minimum.reduceat(np.where(skips & (at != top[group]), at, none), starts)
    top_first = np.minimum.reduceat(np.where(first, at, none), starts)
    shorter = np.minimum.reduceat(np.where(skips, none, at), starts)
    n_skips = np.add.reduceat(skips.astype(np.int64), starts)
    n_first = np.add.reduceat(first.astype(np.int64), starts)
    other = np.where(at == top[group], second[group], top[group])
    with_shorter = first & (shorter[group] < none)
    number = np.where(skips, n_skips[group] - 1 + with_shorter, n_first[group])
    best = np.where(skips, np.where(with_shorter, np.minimum(other, shorter[group]), other), top_first[group])
    near = np.flatnonzero(number > 0)
    best = pa.array(best[near])
    yield pa.record_batch(
        [
            table.column("word").take(pa.array(near)).combine_chunks(),
            pa.array(number[near]),
            table.column("word").take(best).combine_chunks(),
            table.column("n").take(best).combine_chunks(),
        ],
        names=["word", "n_near", "form", "form_n"],
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and the last of its forms, from (word, form) rows without circles.

    Every round doubles the steps taken; a form has ``TIMES`` the word's count at
    least, so there are few steps. A round's table goes when the next one's is written.
    """
    before = Passing(forms.sparkSession)
    reached = before.kept(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = reached.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        joined = reached.join(ahead, F.col("root") == F.col("_at"), "left")
        further = F.col("_next").isNotNull().alias("_moved")
        now = Passing(forms.sparkSession)
        reached = now.kept(
            joined.select("word", F.coalesce("_next", "root").alias("root"), further), "spelling-roots"
        )
        before.drop()
        before = now
        if reached.where("_moved").isEmpty():
            return reached.select("word", "root")
        reached = reached.select("word", "root")


def group_variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    damaged: int = DAMAGED,
) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    The form is the near word of largest n, ties to the smallest in code-point order,
    if it has ``times`` the word's n at least, else null; the root is the last form
    that forms lead to. Null, empty and letterless texts have no words, an empty table
    gives no rows, and of a repeated document every row counts.
    """
    passing = Passing(docs.sparkSession)
    words = passing.kept(occurring_words(docs, least_length, least_count, damaged), "spelling-words")
    near = neighbours(words)
    known = words.join(near, "word", "left")
    is_form = F.col("form_n") >= times * F.col("n")
    known = kept(
        known.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("form")).alias("form"),
            F.when(is_form, F.col("form_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    passing.drop()
    last = roots(known.where(F.col("form").isNotNull()))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
