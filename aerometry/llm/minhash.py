"""Near-duplicate documents by ProbMinHash, banding and verification.

A text is its set of shingles of five words, weighted by one plus the logarithm of
how often each occurs. Every shingle draws the arrivals of a Poisson process whose
rate is its weight, each arrival falling into a register by chance; a register
keeps the shingle that arrives first. A shingle stops when its next arrival is
later than all registers' first ones. Registers of two texts agree with the
probability Jaccard similarity of their weights, which equals the Jaccard
similarity of the sets where weights are alike. A text with repeated shingles also
has registers in which every shingle weighs 1, as in texts without repeats, so that
its sets meet whatever the counts.

Texts that agree in all registers of some band are candidates. Within a band's
bucket the smallest document is the leader; two candidates always share a leader,
so a leader and its followers make a cell, and every pair of a cell is verified by
the exact Jaccard similarity of the shingle sets. A cell is cut into chunks of
bounded size, each verified in one task with the leader added. Where that leaves
followers unconnected, members of different components exchange sketches, a byte
for each of some more registers; texts that their sketches and sizes do not rule
out are verified, chunk by chunk. A task emits no pairs but a spanning forest of
the links it found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometry.llm.documents import (
    Passing,
    kept,
    slices,
    text_bytes,
    texts_of,
    unused,
    without_repeats,
    word_bounds,
)
from aerometry.llm.recompression import Windows, mix, word_names
from aerometry.session import scratch_path

SHINGLE = 5
SIMILARITY = 0.8

#: A pair of similarity 0.8 is missed by all bands with a chance of 5 in 100,000 at most.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS

#: Documents and shingles of a chunk, at most about, and bytes of one batch.
CHUNK = 400
CHUNK_SHINGLES = 1_000_000
BATCH_BYTES = 4 << 20
#: Registers of a sketch, and how many must agree. They are independent, so of a pair of
#: similarity 0.8 fewer do with a chance of 2 in 10,000,000.
SKETCH, LEAST_AGREEING = 512, 362
#: Sketches of a block, at most about; blocks meet in pairs.
SKETCH_BLOCK = 2_000
#: Shingles compared at a time.
COLUMNS = 4096

_DRAW = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(0xC2B2AE3D27D4EB4F)

SIGNED = "doc_id long, digest binary, bands array<long>, n_shingles long"
CELL = "leader long, part long, other int, doc_id long, component long, packed binary"
MEMBERS = "leader long, doc_id long, digest binary, n_shingles long"
LINKS = "doc_id long, other long, similarity double"
PACKED = "doc_id long, digest binary, packed binary"


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text numbers (ascending), names, counts.

    A text of fewer words than a shingle has one shingle of all its words, a text
    without words none.
    """
    data, offsets = text_bytes(texts)
    first, end, before = word_bounds(data, offsets)
    sizes = np.diff(before)
    lengths = np.minimum(sizes, SHINGLE)
    room = np.where(sizes > 0, sizes - lengths + 1, 0)
    if not room.sum():
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none
    text = np.repeat(np.arange(len(sizes)), room)
    starts = np.arange(len(text)) - np.repeat(np.cumsum(room) - room, room) + before[text]
    names = Windows(word_names(data, first, end)).named(starts, lengths[text])
    order = np.lexsort((names, text))
    text, names = text[order], names[order]
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (names[1:] != names[:-1])])
    at = np.flatnonzero(new)
    return text[at], names[at], np.diff(np.append(at, len(names)))


def signatures(
    text: np.ndarray, names: np.ndarray, counts: np.ndarray, n: int, registers: int = REGISTERS
) -> np.ndarray:
    """The first shingle in every register of ``n`` texts; texts without shingles keep 0."""
    times = np.full(n * registers, np.inf)
    winners = np.zeros(n * registers, dtype=np.uint64)
    weights = 1 + np.log(counts)
    arrival = np.zeros(len(names))
    draw = 0
    while len(names):
        draw += 1
        key = mix(names + mix(np.array([draw], dtype=np.uint64)) * _DRAW)
        chance = ((key >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
        arrival = arrival - np.log(chance) / weights
        place = text * registers + (mix(key ^ _PLACE) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(times, place, arrival)
        won = times[place] == arrival
        winners[place[won]] = names[won]
        last = times.reshape(n, registers).max(axis=1)
        going = arrival < last[text]
        text, names, weights, arrival = text[going], names[going], weights[going], arrival[going]
    return winners.reshape(n, registers)


def band_keys(winners: np.ndarray) -> np.ndarray:
    """One number per text and band."""
    bands = winners.reshape(len(winners), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), bands.shape[:2])
    for row in range(ROWS):
        key = mix(key * _DRAW + bands[:, :, row])
    return key


def text_bands(
    text: np.ndarray, names: np.ndarray, counts: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of ``n`` texts one after the other, and where each text's begin, with the end last.

    Counts of 1 weigh 1, so a text without repeats has the same registers either way.
    Of a text with repeats the bands that differ without its counts are added.
    """
    weighted = band_keys(signatures(text, names, counts, n))
    owners = np.unique(text)
    again = np.unique(text[counts > 1])
    repeats = np.isin(text, again)
    number = np.searchsorted(again, text[repeats])
    plain = band_keys(signatures(number, names[repeats], np.ones(len(number)), len(again)))
    differs = plain != weighted[again]
    owner = np.concatenate([np.repeat(owners, BANDS), np.repeat(again, differs.sum(axis=1))])
    keys = np.concatenate([weighted[owners].ravel(), plain[differs]])
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return keys[np.argsort(owner, kind="stable")], bounds


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = batch.column(1).cast(pa.large_string())
        for first, end in slices(whole, BATCH_BYTES):
            texts = whole[first:end]
            text, names, counts = shingles(texts)
            keys, bounds = text_bands(text, names, counts, len(texts))
            bands = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array(keys.view(np.int64))
            )
            sizes = np.bincount(text, minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[first:end],
                    pa.array(list(map(_digest, texts)), pa.binary()),
                    bands,
                    pa.array(sizes, pa.int64()),
                ],
                ["doc_id", "digest", "bands", "n_shingles"],
            )


def _digest(text: pa.Scalar) -> bytes:
    """Of a text's words; texts with equal words are one."""
    return hashlib.sha256(b" ".join(text.as_py().encode().split())).digest()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)

    def named() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = pa.array(list(map(_digest, batch.column(1))), pa.binary())
            columns = [batch.column(0), digests, batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "text"])

    for batch in without_repeats(named(), 0, 1):
        packed = [squeeze.compress(text.as_py().encode()) for text in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
            ["doc_id", "digest", "packed"],
        )


def _common(sets: list[np.ndarray], first: int) -> np.ndarray:
    """How many shingles each of the ``first`` sets shares with each of the others.

    If the first are all, they are compared with themselves.
    """
    names = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    order = np.argsort(names, kind="stable")
    names, rows = names[order], rows[order]
    new = np.concatenate([[True], names[1:] != names[:-1]])
    times = np.diff(np.append(np.flatnonzero(new), len(names)))
    keep = np.repeat(times > 1, times)
    column = (np.cumsum(times > 1) - 1)[np.cumsum(new) - 1][keep]
    rows = rows[keep]
    right = slice(0, None) if first == len(sets) else slice(first, None)
    found = np.zeros((first, len(sets) - (right.start or 0)), dtype=np.float32)
    for start in range(0, int((times > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        held[rows[a:b], column[a:b] - start] = 1
        found += held[:first] @ held[right].T
    return found


def _similar(
    left: list[np.ndarray], right: list[np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of pairs whose Jaccard similarity reaches the threshold, and the similarity.

    Without ``right`` the sets are compared with each other, each pair once.
    """
    common = _common([*left, *(right or [])], len(left))
    ours = np.array([len(s) for s in left])
    theirs = ours if right is None else np.array([len(s) for s in right])
    union = ours[:, None] + theirs[None, :] - common
    # Counts are whole numbers, so that the threshold itself is met exactly.
    linked = (common > 0) & (common * 10 >= 8 * union)
    rows, columns = np.nonzero(np.triu(linked, 1) if right is None else linked)
    return rows, columns, common[rows, columns] / union[rows, columns]


class _Forest:
    """Smallest member of each group of linked documents."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def root(self, doc: int) -> int:
        above = self.above
        while above.setdefault(doc, doc) != doc:
            above[doc] = above[above[doc]]
            doc = above[doc]
        return doc

    def link(self, one: int, two: int) -> bool:
        """Whether they were not yet linked."""
        one, two = self.root(one), self.root(two)
        if one != two:
            self.above[max(one, two)] = min(one, two)
        return one != two


def _verify(cell: list[tuple]) -> list[tuple[int, int, float]]:
    """Links within a chunk, or between two: rows of (other, doc, component, shingles).

    Links of documents that an earlier pass connected are not looked for again, and
    of the others only as many as connect what is linked.
    """
    forest = _Forest()
    known = {doc: component for _, doc, component, _ in cell}
    first = [(doc, s) for other, doc, _, s in cell if other == 0]
    second = [(doc, s) for other, doc, _, s in cell if other == 1]
    left, right = (first, second) if first and second else (first or second, None)
    rows, columns, similarity = _similar(
        [s for _, s in left], None if right is None else [s for _, s in right]
    )
    found = []
    for a, b, how in zip(rows.tolist(), columns.tolist(), similarity.tolist(), strict=True):
        one, two = left[a][0], (right or left)[b][0]
        if one != two and known[one] != known[two] and forest.link(one, two):
            found.append((max(one, two), min(one, two), how))
    return found


def _verify_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cells come one after the other; one may go on in the next batch."""
    unpack = zstandard.ZstdDecompressor()
    name, cell = None, []
    for batch in batches:
        found: list[tuple[int, int, float]] = []
        keys = list(zip(batch["leader"], batch["part"], strict=True))
        for start, end in _parts([len(p) for p in batch["packed"]]):
            packed = batch["packed"].iloc[start:end]
            texts = pa.array([unpack.decompress(p).decode() for p in packed], pa.large_string())
            text, names, _ = shingles(texts)
            bounds = np.searchsorted(text, np.arange(len(texts) + 1))
            for i, (a, b) in enumerate(pairwise(bounds.tolist())):
                at = start + i
                if keys[at] != name:
                    found += _verify(cell) if cell else []
                    name, cell = keys[at], []
                cell.append(
                    (
                        int(batch["other"].iat[at]),
                        int(batch["doc_id"].iat[at]),
                        int(batch["component"].iat[at]),
                        names[a:b],
                    )
                )
        yield pd.DataFrame(found, columns=["doc_id", "other", "similarity"]).astype(_LINK_TYPES)
    if cell:
        found = _verify(cell)
        yield pd.DataFrame(found, columns=["doc_id", "other", "similarity"]).astype(_LINK_TYPES)


_LINK_TYPES = {"doc_id": "int64", "other": "int64", "similarity": "float64"}


def _parts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose packed texts stay below a batch's bytes."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total + 4 * size > BATCH_BYTES and i > start:
            yield start, i
            start, total = i, 0
        total += 4 * size
    if start < len(sizes):
        yield start, len(sizes)


def _linked(cells: DataFrame, packed: DataFrame) -> DataFrame:
    """Verify all cells; one task handles many, in order."""
    rows = packed.select("digest", "packed").hint("merge").join(cells, "digest")
    return (
        rows.select(*[c.split()[0] for c in CELL.split(", ")])
        .repartition("leader", "part")
        .sortWithinPartitions("leader", "part", "other", "doc_id")
        .mapInPandas(_verify_cells, LINKS)
    )


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for start, end in _parts([len(p.as_py()) for p in batch.column(1)]):
            packed = batch.column(1)[start:end]
            texts = pa.array([unpack.decompress(p.as_py()).decode() for p in packed], pa.large_string())
            text, names, _ = shingles(texts)
            winners = signatures(text, names, np.ones(len(names)), len(texts), SKETCH)
            sketches = [row.tobytes() for row in (winners >> np.uint64(17)).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[start:end], pa.array(sketches, pa.binary())], ["digest", "sketch"]
            )


SKETCHED = (
    "leader long, pair long, block long, part long, parts long, doc_id long, digest binary, "
    "component long, n_shingles long, sketch binary"
)
NEEDED = "leader long, part long, other int, doc_id long, digest binary, component long"


def _not_ruled_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members with a partner that sketch and size allow, per pair of chunks.

    Pairs of blocks come one after the other; one may go on in the next batch.
    """
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        key = batch[["leader", "pair"]].to_numpy()
        starts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
        for start, end in pairwise(starts[:-1]):
            yield _needed(batch.iloc[start:end])
        rest = batch.iloc[starts[-2] :].reset_index(drop=True)
    if rest is not None:
        yield _needed(rest)


def _needed(rows: pd.DataFrame) -> pd.DataFrame:
    block = rows["block"].to_numpy()
    left = np.flatnonzero(block == block.min())
    right = np.flatnonzero(block == block.max())
    sketches = np.frombuffer(b"".join(rows["sketch"]), dtype=np.uint8).reshape(len(rows), SKETCH)
    component, part = rows["component"].to_numpy(), rows["part"].to_numpy()
    size = rows["n_shingles"].to_numpy()
    found: set[tuple[int, int]] = set()
    parts = int(rows["parts"].iat[0])
    for a in left:
        # Members of a chunk were compared before, those of a component need not be.
        # Of a block with itself each pair is looked at once.
        others = right if block.min() != block.max() else right[right > a]
        others = others[(component[others] != component[a]) & (part[others] != part[a])]
        fits = 10 * np.minimum(size[others], size[a]) >= 8 * np.maximum(size[others], size[a])
        others = others[fits]
        agree = (sketches[others] == sketches[a]).sum(axis=1)
        for b in others[agree >= LEAST_AGREEING].tolist():
            low, high = sorted((int(part[a]), int(part[b])))
            found |= {(low * parts + high, int(a)), (low * parts + high, b)}
    chunks, members = (np.array(x, dtype=np.int64) for x in zip(*sorted(found), strict=True)) if found else ([], [])
    needed = rows.iloc[members][["leader", "doc_id", "digest", "component"]].assign(part=chunks)
    needed["other"] = (part[members] != needed["part"].to_numpy() // parts).astype("int32") if found else 0
    return needed[["leader", "part", "other", "doc_id", "digest", "component"]]


def _still_to_compare(
    large: DataFrame, packed: DataFrame, links: DataFrame, passing: Passing
) -> DataFrame:
    """Cells of texts from different chunks that may be similar and that no link connects yet.

    Of each cell the members outside its largest component meet each other and it; the
    largest component's own members do not meet. What meets are sketches, in blocks.
    """
    component = connected(links, passing)
    labelled = large.join(component, "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    counts = passing.kept(
        labelled.groupBy("leader", "component").agg(F.count("*").alias("n")), "components"
    )
    blocks = lambda n: F.ceil(n / SKETCH_BLOCK).cast("long")
    largest = F.max(F.struct("n", "component"))
    cells = (
        counts.groupBy("leader")
        .agg(largest.alias("largest"), F.sum("n").alias("all"), F.count("*").alias("components"))
        .where(F.col("components") > 1)
        .select(
            "leader",
            F.col("largest.component").alias("largest"),
            blocks(F.col("all") - F.col("largest.n")).alias("small_blocks"),
            blocks(F.col("largest.n")).alias("large_blocks"),
        )
    )
    mixed = passing.kept(labelled.join(cells, "leader"), "mixed")
    sketches = passing.kept(
        packed.join(mixed.select("digest").distinct(), "digest", "left_semi")
        .select("digest", "packed")
        .mapInArrow(_sketch, "digest binary, sketch binary"),
        "sketches",
    )
    in_largest = F.col("component") == F.col("largest")
    deal = F.xxhash64("digest")
    block = F.when(
        in_largest, F.col("small_blocks") + F.pmod(deal, F.col("large_blocks"))
    ).otherwise(F.pmod(deal, F.col("small_blocks")))
    all_blocks = F.col("small_blocks") + F.col("large_blocks")
    partners = F.when(in_largest, F.col("small_blocks")).otherwise(all_blocks)
    met = (
        mixed.withColumn("block", block)
        .withColumn("partner", F.explode(F.sequence(F.lit(0).cast("long"), partners - 1)))
        .withColumn("pair", F.least("block", "partner") * all_blocks + F.greatest("block", "partner"))
    )
    return (
        met.join(sketches, "digest")
        .select(*[c.split()[0] for c in SKETCHED.split(", ")])
        .repartition("leader", "pair")
        .sortWithinPartitions("leader", "pair", "block", "doc_id")
        .mapInPandas(_not_ruled_out, NEEDED)
        .distinct()
    )


def connected(links: DataFrame, result: Passing | None = None) -> DataFrame:
    """``doc_id`` and ``component`` (its smallest document) of all linked documents.

    Alternates two steps until nothing changes: every document's larger neighbours
    are linked to its smallest one, then its smaller neighbours. Each step keeps
    the links as a table in the shared folder; a round's tables go when the next one's
    links are written. The last stay, in ``result`` if given.
    """
    spark = links.sparkSession

    def written(rows: DataFrame, tables: Passing) -> tuple[DataFrame, tuple]:
        found = tables.kept(rows, "edges")
        mark = F.xxhash64("high", "low").cast("decimal(38,0)")
        return found, tuple(found.agg(F.count("*"), F.sum(mark)).first())

    before = Passing(spark)
    edges, state = written(
        links.select(
            F.greatest("doc_id", "other").alias("high"), F.least("doc_id", "other").alias("low")
        )
        .where(F.col("high") > F.col("low"))
        .distinct(),
        before,
    )
    while True:
        both = edges.select(F.col("high").alias("node"), F.col("low").alias("near")).unionAll(
            edges.select(F.col("low").alias("node"), F.col("high").alias("near"))
        )
        least = before.kept(
            both.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("least")), "least"
        )
        large = (
            both.where(F.col("near") > F.col("node"))
            .join(least, "node")
            .select(F.col("near").alias("high"), F.col("least").alias("low"))
            .distinct()
        )
        middle = before.kept(large, "edges")
        smallest = before.kept(middle.groupBy("high").agg(F.min("low").alias("least")), "least")
        small = (
            middle.join(smallest, "high")
            .select(F.col("low").alias("high"), F.col("least").alias("low"))
            .where(F.col("high") > F.col("low"))
            .unionAll(smallest.select("high", F.col("least").alias("low")))
            .distinct()
        )
        now = Passing(spark)
        edges, changed = written(small, now)
        before.drop()
        if changed == state:
            break
        before, state = now, changed
    if result is not None:
        result.paths += now.paths
    stars = edges.select(F.col("high").alias("doc_id"), F.col("low").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("doc_id"), "component").distinct())


def near_duplicates(docs: DataFrame, with_links: bool = False) -> DataFrame:
    """``doc_id`` and ``class_id`` of every document.

    ``class_id`` is the smallest ``doc_id`` that a chain of links leads to. Texts
    are linked if their words are equal, or if their shingle sets have a Jaccard
    similarity of ``SIMILARITY`` or more. One row per input row. Null and empty
    texts, and rows without ``doc_id``, are in no one else's class; rows that share
    a ``doc_id`` are one document. Other columns are not read.

    ``with_links`` adds a link that puts the document into its class: ``linked_to``,
    another document that it is linked to directly, and their ``similarity``; both
    null in a class of one.
    """
    spark = docs.sparkSession
    texts = texts_of(docs)
    signed_path = scratch_path(spark, "signed")
    texts.mapInArrow(_sign, SIGNED).write.option("compression", "zstd").parquet(signed_path)

    def signed() -> DataFrame:
        return spark.read.schema(SIGNED).parquet(signed_path)

    # Equal texts: only their smallest document goes on.
    usable = signed().where(F.col("doc_id").isNotNull() & (F.size("bands") > 0))
    ends_of = [F.min("doc_id").alias("original"), F.max("doc_id").alias("last_copy")]
    firsts = kept(usable.groupBy("digest").agg(*ends_of), "firsts")
    originals = usable.join(firsts.drop("last_copy"), "digest").where(F.col("doc_id") == F.col("original"))

    # What is needed for links only goes with them found.
    passing = Passing(spark)
    members = passing.path("members")
    exploded = originals.select("doc_id", "digest", "n_shingles", F.explode("bands").alias("band"))
    leaders = passing.kept(
        exploded.groupBy("band")
        .agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last"))
        .where(F.col("leader") < F.col("last"))
        .drop("last"),
        "leaders",
    )
    own_columns = [c.split()[0] for c in MEMBERS.split(", ")]
    exploded.join(leaders, "band").select(*own_columns).distinct().write.parquet(members)

    def followers() -> DataFrame:
        return spark.read.schema(MEMBERS).parquet(members)

    sizes = followers().groupBy("leader").agg(
        F.greatest(
            F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES)
        ).cast("long").alias("parts")
    )
    # A chunk holds texts, so one document with many of them is dealt too.
    dealt = (
        followers()
        .join(passing.kept(sizes, "sizes"), "leader")
        .withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")))
    )
    is_leader = F.col("doc_id") == F.col("leader")
    everywhere = dealt.where(is_leader).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    )
    chunks = dealt.where(~is_leader).unionByName(everywhere)
    own = chunks.select(
        "leader", "part", F.lit(0).alias("other"), "doc_id", "digest", F.col("doc_id").alias("component")
    )
    # Whole texts are shuffled once, then only those of cells. Both sides lie by document and
    # digest, so copies of a row go without another shuffle.
    members_only = passing.path("packed")
    (
        texts.mapInArrow(_pack, PACKED)
        .hint("merge")
        .join(followers().select("doc_id", "digest").distinct(), ["doc_id", "digest"], "left_semi")
        .dropDuplicates(["doc_id", "digest"])
        .write.parquet(members_only)
    )
    packed = spark.read.schema(PACKED).parquet(members_only)
    first_links = scratch_path(spark, "links")
    _linked(own, packed).write.parquet(first_links)
    links = spark.read.schema(LINKS).parquet(first_links)

    # Cells of several chunks whose members are not yet one component.
    large = dealt.where(F.col("parts") > 1)
    if not large.isEmpty():
        across = _still_to_compare(large, packed, links, passing)
        second_links = scratch_path(spark, "links")
        _linked(passing.kept(across, "across"), packed).write.parquet(second_links)
        links = links.unionByName(spark.read.schema(LINKS).parquet(second_links))

    component = connected(links)
    passing.drop()
    classes = firsts.join(
        component.withColumnRenamed("doc_id", "original"), "original", "left"
    ).select("digest", "original", "last_copy", F.coalesce("component", "original").alias("class_id"))
    rows = signed().select("doc_id", "digest")
    single = F.coalesce("class_id", "doc_id")
    found = rows.join(classes, "digest", "left").select(
        "doc_id", "original", "last_copy", F.when(F.col("doc_id").isNotNull(), single).alias("class_id")
    )
    if not with_links:
        return found.select("doc_id", "class_id")
    # Copies and their original are linked, other documents by the best link that was kept.
    ends = links.select("doc_id", "other", "similarity").unionByName(
        links.select(F.col("other").alias("doc_id"), F.col("doc_id").alias("other"), "similarity")
    )
    best = F.min(F.struct((-F.col("similarity")).alias("less"), "other"))
    best = ends.groupBy("doc_id").agg(best.alias("best")).withColumnRenamed("doc_id", "_doc")
    copy = F.when(F.col("doc_id") != F.col("original"), F.col("original")).when(
        F.col("last_copy") != F.col("doc_id"), F.col("last_copy")
    )
    return found.join(best, F.col("doc_id") == F.col("_doc"), "left").select(
        "doc_id",
        "class_id",
        F.coalesce(copy, "best.other").alias("linked_to"),
        F.when(copy.isNotNull(), F.lit(1.0)).otherwise(-F.col("best.less")).alias("similarity"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its class.

    Rows without ``doc_id`` stay; all columns stay as they are.
    """
    dropped = near_duplicates(docs).where(F.col("doc_id") != F.col("class_id"))
    name = unused(docs, "dropped_id")
    dropped = dropped.select(F.col("doc_id").alias(name)).distinct()
    same = F.col("doc_id").cast("long") == F.col(name)
    return docs.hint("merge").join(dropped, same, "left_anti")
