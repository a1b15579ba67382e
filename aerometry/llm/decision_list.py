"""Quality rules as a decision list learned from labelled statistics.

Statistics of a text are column expressions. Sequential covering grows one rule
at a time: a conjunction of thresholds on statistics that singles out documents
of label 0. A rule grows on two thirds of the labelled rows by information gain,
loses its last conditions while that helps on the other third, and is kept if it
is precise there; the rows it covers leave the search. The rules become one
ordered conditional expression. Each step is one aggregation over the labelled
rows, whatever their number; only counts per statistic and bin reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerometry.session import scratch_path

SPACE = "[ \\t-\\r]+"
SYMBOLS = "[^#*$%&|<>]+"

#: Up to so many repeated windows they are looked up one by one, beyond they are sorted.
FEW = 64

#: Cuts per statistic, rules, conditions per rule.
BINS = 24
MOST_RULES = 12
MOST_CONDITIONS = 3

#: A rule is kept if it covers so many rows of the pruning third, so precisely.
LEAST_COVER = 3
LEAST_PRECISION = 0.7

Condition = tuple[str, str, float]
Rule = tuple[Condition, ...]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` loops over it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _rest(array: Column, start: int) -> Column:
    return F.slice(array, start, F.size(array))


def _windows(words: Column) -> Column:
    """Hashes of all windows of three words."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def build(h: Column) -> Column:
        pairs = F.zip_with(h, _rest(h, 2), lambda a, b: F.xxhash64(a, b))
        triples = F.zip_with(pairs, _rest(h, 3), lambda a, b: F.xxhash64(a, b))
        return F.slice(triples, 1, F.greatest(F.size(h) - 2, F.lit(0)))

    return _let(hashed, build)


def _repeated(windows: Column) -> Column:
    """Hashes that occur twice or more."""

    def build(s: Column) -> Column:
        same = F.zip_with(s, _rest(s, 2), lambda a, b: F.when(a == b, a))
        return F.array_distinct(F.filter(same, lambda x: x.isNotNull()))

    return F.when(
        F.size(F.array_distinct(windows)) == F.size(windows), F.array().cast("array<long>")
    ).otherwise(_let(F.sort_array(windows), build))


def _starts(windows: Column, repeated: Column) -> Column:
    """Positions of repeated windows, ascending."""

    def looked_up(d: Column) -> Column:
        at = F.transform(windows, lambda h, i: F.when(F.array_contains(d, h), i))
        return F.filter(at, lambda i: i.isNotNull())

    def neighbours(s: Column) -> Column:
        both = F.zip_with(
            s,
            _rest(s, 2),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
        )
        return F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return (
        F.when(F.size(repeated) == 0, F.array().cast("array<int>"))
        .when(F.size(repeated) <= FEW, _let(repeated, looked_up))
        .otherwise(_let(ordered, neighbours))
    )


def _covered(starts: Column) -> Column:
    """Words covered by windows of three words at ascending positions."""

    def build(p: Column) -> Column:
        new = F.zip_with(p, _rest(p, 2), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(new, F.lit(0).cast("long"), lambda total, n: total + n)

    return _let(starts, build)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_counts(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts and what further statistics need; null texts are empty.

    Windows are compared by 64-bit hashes of their words.
    """
    text = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    words = text.select(
        "doc_id",
        "text",
        F.filter(F.split("text", SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike("[^ \\t-\\r]")).alias("lines"),
    )
    windows = words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("text", "[^.,;:!?]+", "")).cast("long").alias("n_marks"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        _windows(F.col("words")).alias("windows"),
    )
    repeated = windows.withColumn("repeated", _repeated(F.col("windows")))
    starts = repeated.withColumn("starts", _starts(F.col("windows"), F.col("repeated")))
    return starts.withColumn("n_repeat_words", _covered(F.col("starts"))).drop(
        "windows", "repeated", "starts"
    )


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0)).cast("double")


def statistics() -> dict[str, Column]:
    """The statistics rules are made of, by name."""
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": _share("word_chars", "n_words"),
        "symbol_share": _share("n_symbols", "n_words"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "upper_share": _share("n_upper", "word_chars"),
        "mark_share": _share("n_marks", "n_words"),
        "distinct_share": _share("n_distinct", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; a document that one of them covers is rejected."""

    rules: tuple[Rule, ...]

    def kept(self) -> Column:
        """The list as a conditional over statistics."""
        verdict = None
        for rule in self.rules:
            verdict = (verdict if verdict is not None else F).when(_holds(rule), F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))

    def __str__(self) -> str:
        lines = [" and ".join(f"{n} {op} {t:g}" for n, op, t in rule) for rule in self.rules]
        return "\n".join([f"reject if {line}" for line in lines] + ["keep otherwise"])


def _holds(rule: Rule) -> Column:
    found = F.lit(True)
    for name, op, threshold in rule:
        value = F.col(name)
        found = found & (value <= threshold if op == "<=" else value > threshold)
    return found


def _cuts(rows: DataFrame, names: list[str]) -> dict[str, list[float]]:
    """Distinct quantiles of each statistic over the labelled rows."""
    shares = [i / BINS for i in range(1, BINS)] + [0.01, 0.99]
    found = rows.agg(
        *[F.percentile_approx(n, sorted(shares), 10_000).alias(n) for n in names]
    ).first()
    return {n: sorted(set(found[n] or [])) for n in names}


def _bins(cuts: dict[str, list[float]]) -> Column:
    """Per statistic, in how many cuts the value lies above."""
    entries = [
        F.struct(
            F.lit(i).alias("s"),
            sum((F.when(F.col(n) > t, 1).otherwise(0) for t in cuts[n]), F.lit(0)).alias("b"),
        )
        for i, n in enumerate(cuts)
    ]
    return F.explode(F.array(*entries))


def _best(rows: DataFrame, cuts: dict[str, list[float]], rule: Rule) -> tuple[float, Condition] | None:
    """The condition that gains most for the rule, from counts per statistic and bin."""
    covered = rows.where(_holds(rule))
    counts = (
        covered.select("bad", _bins(cuts).alias("x"))
        .groupBy(F.col("x.s").alias("s"), F.col("x.b").alias("b"))
        .agg(F.sum("bad").alias("bad"), F.count("*").alias("n"))
        .collect()
    )
    by: dict[int, dict[int, tuple[int, int]]] = {}
    for row in counts:
        by.setdefault(row["s"], {})[row["b"]] = (row["bad"], row["n"])
    best = None
    for s, name in enumerate(cuts):
        bins = by.get(s, {})
        bad, n = (sum(v[i] for v in bins.values()) for i in (0, 1))
        low_bad = low_n = 0
        for b, cut in enumerate(cuts[name]):
            low_bad += bins.get(b, (0, 0))[0]
            low_n += bins.get(b, (0, 0))[1]
            for op, p, m in (("<=", low_bad, low_n), (">", bad - low_bad, n - low_n)):
                if 0 < p and m < n:
                    gain = p * (math.log2(p / m) - math.log2(bad / n))
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, (name, op, cut))
    return best if best is not None and best[0] > 1e-9 else None


def _worth(rows: DataFrame, rule: Rule) -> list[tuple[int, int]]:
    """(bad, covered) of every nonempty beginning of the rule."""
    aggregates = []
    for k in range(1, len(rule) + 1):
        holds = _holds(rule[:k])
        aggregates += [F.sum(F.when(holds, F.col("bad"))), F.count(F.when(holds, 1))]
    found = rows.agg(*aggregates).first()
    return [(found[2 * k] or 0, found[2 * k + 1]) for k in range(len(rule))]


def learn(labelled: DataFrame, names: list[str]) -> DecisionList:
    """Rules for label 0 from rows with ``quality``, ``doc_id`` and the statistics.

    Rows with another label than 0 or 1 take no part. Without rows of label 0 the
    list is empty and keeps everything.
    """
    rows = labelled.where(F.col("quality").isin(0, 1)).withColumn(
        "bad", (1 - F.col("quality")).cast("long")
    )
    part = F.pmod(F.xxhash64("doc_id", *names), F.lit(3))
    cuts = _cuts(rows, names)
    growing, pruning = rows.where(part > 0), rows.where(part == 0)
    rules: list[Rule] = []
    for _ in range(MOST_RULES):
        rule: Rule = ()
        while len(rule) < MOST_CONDITIONS:
            found = _best(growing, cuts, rule)
            if found is None or found[1] in rule:
                break
            rule = (*rule, found[1])
        if not rule:
            break
        worth = _worth(pruning, rule)
        values = [(2 * bad - n) / n if n else -1.0 for bad, n in worth]
        length = max(range(len(rule)), key=lambda k: (round(values[k], 6), -k)) + 1
        bad, n = worth[length - 1]
        if n < LEAST_COVER or bad < LEAST_PRECISION * n:
            break
        rule = rule[:length]
        rules.append(rule)
        growing, pruning = growing.where(~_holds(rule)), pruning.where(~_holds(rule))
    return DecisionList(tuple(rules))


def held_out() -> Column:
    """Every fifth document by checksum is never learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def apply_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, base verdict and the learned verdict for every document.

    One row per input row. Null and empty texts have no words and fail; repeated
    rows are judged alike; a label counts once per document and value, null labels
    not at all; other columns are not read. The counts are kept as a table in the
    shared folder, from which the rules are learned and the result is read.
    """
    spark = docs.sparkSession
    kept = scratch_path(spark, "counts")
    with_counts(docs).write.parquet(kept)
    made = statistics()
    counted = spark.read.parquet(kept).withColumns(made)
    marks = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).distinct()
    labelled = counted.where(~held_out()).join(marks, "doc_id").select("doc_id", "quality", *made)
    learned = scratch_path(spark, "labelled")
    labelled.write.parquet(learned)
    rules = learn(spark.read.parquet(learned), list(made))
    failed = F.coalesce(base_failed(), F.lit(True))
    return counted.select(
        "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & rules.kept()).alias("kept")
    )
