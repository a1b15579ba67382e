"""Remove passages that another document has too, found by recompression.

A window is ``WINDOW`` consecutive words of one document. Recompression gives every
window an anchor that equal windows share. Anchors that occur in one
document only rule out most windows at once. Successive windows with one anchor
make a bundle, which is named by 128 bits of its words: a bundle that a smaller
document has too goes as a whole. Where an anchor has several different bundles,
which overlap in part, the windows of each bundle's smallest document are named
and compared one by one; bundles of larger documents have no other windows.

Exact copies of a whole document are settled by the digests of their texts, so
large groups of copies meet neither as anchors nor as windows. Anchors and windows
are counted with partial aggregation before the shuffle, and joined back by a
join whose skewed partitions adaptive execution can split; nothing is collected
but what belongs to one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometry.llm.documents import (
    kept,
    slices,
    text_bytes,
    texts_of,
    unused,
    without_repeats,
    word_bounds,
)
from aerometry.llm.recompression import Windows, anchors, word_names
from aerometry.llm.secret_scan import with_char_counts
from aerometry.session import scratch_path

WINDOW = 50
BATCH_BYTES = 4 << 20

EMPTY = hashlib.sha256(b"").hexdigest()

PARSED = "doc_id long, digest binary, n_words long, words_sha256 string, anchors array<long>"
FOUND = (
    "doc_id long, digest binary, packed binary, anchors array<long>, starts array<int>, "
    "counts array<int>, high array<long>, low array<long>"
)
NAMED = "doc_id long, digest binary, starts array<array<int>>, high array<long>, low array<long>"
KEY = ["doc_id", "digest"]
KEPT = "doc_id long, digest binary, n_removed long, kept_sha256 string, text string"


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words of a batch, and the words before each text."""
    data, offsets = text_bytes(texts)
    starts, ends, before = word_bounds(data, offsets)
    return word_names(data, starts, ends), before


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = batch.column(1).cast(pa.large_string())
        for first, end in slices(whole, BATCH_BYTES):
            texts = whole[first:end]
            names, before = _words(texts)
            starts, found = anchors(names, before, WINDOW)
            bounds = np.searchsorted(starts, before)
            own = [np.unique(found[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in own])])
            values = np.concatenate([*own, np.zeros(0, np.uint64)]).view(np.int64)
            raw = [text.as_py().encode() for text in texts]
            digests = [hashlib.sha256(b" ".join(text.split())).hexdigest() for text in raw]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[first:end],
                    batch.column(2)[first:end],
                    pa.array(np.diff(before), pa.int64()),
                    pa.array(digests, pa.string()),
                    _lists(values, ends, pa.int64()),
                ],
                ["doc_id", "digest", "n_words", "words_sha256", "anchors"],
            )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in without_repeats(batches, 0, 2):
        texts = batch.column(1)
        packed = [squeeze.compress(text.as_py().encode()) for text in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(packed, pa.binary())],
            ["doc_id", "digest", "packed"],
        )


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Successive windows that share an anchor other documents have, with their names."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for doc_id, digest, packed, shared in zip(*batch.columns, strict=True):
            names, before = _words(_unpacked(unpack, packed))
            starts, found = anchors(names, before, WINDOW)
            wanted = np.isin(found, np.asarray(shared.values).view(np.uint64))
            starts, found = starts[wanted], found[wanted]
            if not len(starts):
                continue
            new = (np.diff(starts) != 1) | (found[1:] != found[:-1])
            first = np.flatnonzero(np.concatenate([[True], new]))
            counts = np.diff(np.append(first, len(starts)))
            starts, windows = starts[first], Windows(names)
            one = np.array([0, len(starts)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_id.as_py()], pa.int64()),
                    pa.array([digest.as_py()], pa.binary()),
                    pa.array([packed.as_py()], pa.binary()),
                    _lists(found[first].view(np.int64), one, pa.int64()),
                    _lists(starts, one, pa.int32()),
                    _lists(counts, one, pa.int32()),
                    *[
                        _lists(windows.named(starts, counts + WINDOW - 1, k).view(np.int64), one, pa.int64())
                        for k in (0, 1)
                    ],
                ],
                ["doc_id", "digest", "packed", "anchors", "starts", "counts", "high", "low"],
            )


def _unpacked(unpack: zstandard.ZstdDecompressor, packed: pa.Scalar) -> pa.Array:
    return pa.array([unpack.decompress(packed.as_py()).decode()], pa.large_string())


def _ranges(column: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Starts and counts from a list of pairs."""
    pairs = column.values
    return np.asarray(pairs.field("start")), np.asarray(pairs.field("count"))


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of some bundles, named one by one, with all starts of each name."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for doc_id, digest, packed, ranges in zip(*batch.columns, strict=True):
            names, _ = _words(_unpacked(unpack, packed))
            first, counts = _ranges(ranges)
            starts = np.unique(
                np.concatenate([np.arange(a, a + n) for a, n in zip(first, counts, strict=True)])
            )
            windows = Windows(names)
            high, low = (windows.named(starts, WINDOW, k) for k in (0, 1))
            order = np.lexsort((starts, low, high))
            starts, high, low = starts[order], high[order], low[order]
            new = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            first = np.flatnonzero(np.concatenate([[True], new]))
            each, one = np.append(first, len(starts)), np.array([0, len(first)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_id.as_py()], pa.int64()),
                    pa.array([digest.as_py()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(one, pa.int32()), _lists(starts, each, pa.int32())),
                    *[_lists(x[first].view(np.int64), one, pa.int64()) for x in (high, low)],
                ],
                ["doc_id", "digest", "starts", "high", "low"],
            )


def _without(text: bytes, starts: np.ndarray, counts: np.ndarray) -> tuple[int, bytes, bytes]:
    """Removed words, the words that stay, and the text that stays.

    ``counts`` are the successive windows that go from each of ``starts`` on. Of the white space around removed words, what stands before them stays.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    first, end, _ = word_bounds(data, np.array([0, len(data)]))
    marks = np.zeros(len(first) + 1, dtype=np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + counts + WINDOW - 1, -1)
    gone = np.cumsum(marks)[:-1] > 0
    stays = [text[a:b] for a, b in zip(first[~gone].tolist(), end[~gone].tolist(), strict=True)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    parts, last = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        parts.append(text[last : first[a]])
        last = first[b] if b < len(first) else end[b - 1]
    parts.append(text[last:])
    return int(gone.sum()), b" ".join(stays), b"".join(parts)


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for packed, ranges in zip(batch.column(2), batch.column(3), strict=True):
                text = unpack.decompress(packed.as_py())
                removed, words, left = _without(text, *_ranges(ranges))
                digest = hashlib.sha256(words).hexdigest()
                rows.append((removed, digest, left.decode() if with_text else None))
            removed, digests, left = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(left, pa.string()),
                ],
                ["doc_id", "digest", "n_removed", "kept_sha256", "text"],
            )

    return run


def with_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the digest of the text."""
    return texts_of(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))


def _repeats(docs: DataFrame, with_text: bool) -> tuple[DataFrame, DataFrame]:
    """Every row's counts and copies, and what is left of documents with repeats."""
    spark = docs.sparkSession
    texts = with_digest(docs)
    parsed_path = scratch_path(spark, "parsed")
    texts.mapInArrow(_parse, PARSED).write.option("compression", "zstd").parquet(parsed_path)
    parsed = spark.read.schema(PARSED).parquet(parsed_path)

    texts_seen = spark.read.schema(PARSED).parquet(parsed_path)
    smallest = kept(
        texts_seen.groupBy("digest").agg(F.min("doc_id").alias("smallest")), "smallest"
    )
    rows = parsed.drop("anchors").join(smallest, "digest", "left")
    rows = rows.withColumn(
        "copy", F.coalesce((F.col("doc_id") > F.col("smallest")) & (F.col("n_words") >= WINDOW), F.lit(False))
    ).drop("smallest")

    def exploded() -> DataFrame:
        source = spark.read.schema(PARSED).parquet(parsed_path).where(F.col("doc_id").isNotNull())
        return source.select("doc_id", F.explode("anchors").alias("anchor"))

    shared = kept(
        exploded()
        .groupBy("anchor")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where(F.col("least") < F.col("most"))
        .select("anchor"),
        "shared",
    )
    hits = exploded().join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("shared"))
    originals = rows.where(~F.col("copy")).select("doc_id").distinct()
    hits = hits.join(originals, "doc_id", "left_semi")
    packed = texts.mapInArrow(_pack, "doc_id long, digest binary, packed binary")
    found = scratch_path(spark, "found")
    # Both sides lie by document, so this drops what still repeats without a shuffle; behind
    # it every text of a document is one row.
    (
        packed.join(hits, "doc_id")
        .dropDuplicates(KEY)
        .select("doc_id", "digest", "packed", "shared")
        .mapInArrow(_bundles, FOUND)
        .write.option("compression", "zstd")
        .parquet(found)
    )
    covered = _covered(spark, found)
    sources = spark.read.schema(FOUND).parquet(found).select("doc_id", "digest", "packed")
    left = (
        sources.join(covered, KEY)
        .select("doc_id", "digest", "packed", "ranges")
        .mapInArrow(_cut(with_text), KEPT)
    )
    return rows, left


def _covered(spark: SparkSession, found: str) -> DataFrame:
    """Per text the ranges of windows that a smaller document has too."""

    def occurrences() -> DataFrame:
        lists = ("anchors", "starts", "counts", "high", "low")
        rows = spark.read.schema(FOUND).parquet(found)
        rows = rows.select(*KEY, F.explode(F.arrays_zip(*lists)).alias("b"))
        return rows.select(
            *KEY,
            F.col("b.anchors").alias("anchor"),
            F.col("b.starts").alias("start"),
            F.col("b.counts").alias("count"),
            "b.high",
            "b.low",
        )

    name = ["anchor", "high", "low"]
    least = kept(occurrences().groupBy(name).agg(F.min("doc_id").alias("least")), "least")
    placed = scratch_path(spark, "bundles")
    occurrences().join(least, name).write.option("compression", "zstd").parquet(placed)

    def bundles() -> DataFrame:
        return spark.read.parquet(placed)

    ranges = F.collect_set(F.struct("start", "count")).alias("ranges")
    mixed = kept(
        bundles()
        .groupBy("anchor")
        .agg(*[f(c).alias(f"{c}_{f.__name__}") for c in ("high", "low") for f in (F.min, F.max)])
        .where((F.col("high_min") < F.col("high_max")) | (F.col("low_min") < F.col("low_max")))
        .select("anchor"),
        "mixed",
    )
    firsts = bundles().where(F.col("doc_id") == F.col("least")).join(mixed, "anchor")
    named = scratch_path(spark, "named")
    (
        spark.read.schema(FOUND)
        .parquet(found)
        .select(*KEY, "packed")
        .join(firsts.groupBy(KEY).agg(ranges), KEY)
        .select(*KEY, "packed", "ranges")
        .mapInArrow(_single_windows, NAMED)
        .write.option("compression", "zstd")
        .parquet(named)
    )

    def windows() -> DataFrame:
        rows = spark.read.schema(NAMED).parquet(named)
        rows = rows.select(*KEY, F.explode(F.arrays_zip("starts", "high", "low")).alias("w"))
        return rows.select(*KEY, "w.starts", "w.high", "w.low")

    earliest = kept(
        windows()
        .groupBy("high", "low")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where(F.col("least") < F.col("most"))
        .drop("most"),
        "earliest",
    )
    gone = F.col("doc_id") > F.col("least")
    whole = bundles().where(gone).select(*KEY, F.array(F.struct("start", "count")).alias("ranges"))
    one = F.lit(1).alias("count")
    single = (
        windows()
        .join(earliest, ["high", "low"])
        .where(gone)
        .select(
            *KEY, F.transform("starts", lambda at: F.struct(at.alias("start"), one)).alias("ranges")
        )
    )
    together = F.flatten(F.collect_list("ranges")).alias("ranges")
    return whole.unionByName(single).groupBy(KEY).agg(together)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of every document.

    A word goes if a window that covers it also starts in a document with a smaller
    ``doc_id``; windows are judged on the input. One row per input row. Null texts
    count as empty; documents shorter than a window stay whole; rows that repeat a
    ``doc_id`` are no repeats of each other; rows without ``doc_id`` stay whole and
    are no one's source. Other columns are not read.
    """
    rows, left = _repeats(docs, with_text=False)
    return (
        rows.join(left.drop("text"), KEY, "left")
        .select(
            "doc_id",
            "n_words",
            F.when(F.col("copy"), F.col("n_words"))
            .otherwise(F.coalesce("n_removed", F.lit(0)))
            .cast("long")
            .alias("n_removed"),
            F.when(F.col("copy"), F.lit(EMPTY))
            .otherwise(F.coalesce("kept_sha256", "words_sha256"))
            .alias("kept_sha256"),
        )
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; ``n_chars`` follows.

    Rows, order of columns and other columns stay; a null text stays null, and a
    text that repeats as a whole becomes empty.
    """
    rows, left = _repeats(docs, with_text=True)
    copies = rows.where("copy").select("doc_id", "digest", F.lit("").alias("text"))
    changed = left.select("doc_id", "digest", "text").unionByName(copies).dropDuplicates(KEY)
    changed = kept(changed, "changed")  # so that a row repeated without end can be split
    own_id, own_digest, left_text = (unused(docs, n) for n in ("left_id", "left_digest", "left_text"))
    changed = changed.toDF(own_id, own_digest, left_text)
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    joined = docs.join(
        changed, (F.col("doc_id").cast("long") == F.col(own_id)) & (digest == F.col(own_digest)), "left"
    )
    text = F.coalesce(left_text, "text")
    return with_char_counts(joined.withColumn("text", text).select(*docs.columns))
