"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Codes are signs of a learned rotation (iterative quantization) of the vectors'
directions. A code is split into substrings, and each substring has its own index
of all codes. Two codes within Hamming radius r agree in at least one of the s
substrings up to about r / s bits, so probing every index for the values within
that distance retrieves every code within the radius. What is retrieved is reranked by
the inner product of the original vectors in double precision.

The rotation and the radius are fitted on a bounded sample. Queries that find too few
vectors within the radius search again with wider ones, up to all bits. Equal vectors share
one index entry that keeps their smallest identifiers, so that a group of copies,
however large, is searched and found once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerometry.llm.documents import kept, sampled

#: Vectors the rotation and the radius are fitted on, at most.
SAMPLE = 8_000
#: Of the sample's true neighbours, the share whose codes the radius must reach.
REACH = 0.97
ROUNDS = 30

SUBSTRING_BITS = 16
#: Index entries of one block, and queries of one block.
BLOCK = 20_000
QUERY_BLOCK = 2_000
RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Codes:
    """The learned rotation; ``bits`` is a multiple of the substring width."""

    rotation: np.ndarray
    radius: int

    @property
    def substrings(self) -> int:
        return self.rotation.shape[1] // SUBSTRING_BITS

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Substrings of every vector's code."""
        signs = directions(vectors) @ self.rotation > 0
        weights = 1 << np.arange(SUBSTRING_BITS)
        shaped = signs.reshape(len(vectors), -1, SUBSTRING_BITS)
        return (shaped @ weights).astype(np.uint16)


def directions(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled by their largest component first, so that no square is lost."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def learn_rotation(sample: np.ndarray, bits: int, seed: int = 7) -> np.ndarray:
    """Rotations that bring directions close to corners of the cube, side by side.

    One rotation gives a bit per dimension; more bits take further rotations,
    learned from other starting points.
    """
    unit = directions(sample)
    size = unit.shape[1]
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(-(-bits // size)):
        turn, _ = np.linalg.qr(rng.standard_normal((size, size)))
        for _ in range(ROUNDS):
            corners = np.where(unit @ turn > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(unit.T @ corners)
            turn = left @ right
        found.append(turn)
    return np.concatenate(found, axis=1)[:, :bits]


def fit(sample: np.ndarray, neighbours: int, bits: int = 128) -> Codes:
    """Codes and the radius that reaches ``REACH`` of the sample's true neighbours.

    A sample's neighbours are farther away than those in a larger table, so the
    radius errs on the safe side there, on the average: a query in a sparse place
    may need a wider one.
    """
    rotation = learn_rotation(sample, bits)
    codes = Codes(rotation, bits)
    packed = codes.encode(sample)
    queries = np.arange(0, len(sample), max(1, len(sample) // 400))
    scores = sample[queries] @ sample.T
    scores[np.arange(len(queries)), queries] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : min(neighbours, len(sample) - 1)]
    distances = distance(packed[queries][:, None, :], packed[near]).ravel()
    radius = int(np.quantile(distances, REACH, method="higher")) if distances.size else bits
    return Codes(rotation, radius)


def distance(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hamming distance over all substrings."""
    return np.bitwise_count(left ^ right).sum(axis=-1, dtype=np.int32)


def allowances(radius: int, substrings: int) -> list[int]:
    """How many bits each substring may differ; -1 leaves it out.

    If every substring differed by more than its allowance, all together would
    differ by more than the radius.
    """
    spare = radius - substrings + 1
    return [spare // substrings + (s < spare % substrings) for s in range(substrings)]


def probe(index: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per query the entries whose codes lie within the radius.

    ``index`` and ``queries`` hold substrings. Each substring's index lists the
    entries by value; the values within its allowance of the query's are probed.
    """
    tables = []
    for s, near in enumerate(allowances(radius, index.shape[1])):
        order = np.argsort(index[:, s], kind="stable")
        values, starts = np.unique(index[order, s], return_index=True)
        tables.append((s, near, order, values, np.diff(np.append(starts, len(order)))))
    whole, asked = _wide(index), _wide(queries)
    for i, query in enumerate(queries):
        seen = np.zeros(len(index), dtype=bool)
        for s, near, order, values, sizes in tables:
            probed = np.bitwise_count(values ^ query[s]) <= near
            seen[order[np.repeat(probed, sizes)]] = True
        found = np.flatnonzero(seen)
        yield i, found[distance(whole[found], asked[i]) <= radius]


def _wide(codes: np.ndarray) -> np.ndarray:
    """Codes in words of 64 bits where their length allows it."""
    codes = np.ascontiguousarray(codes)
    return codes.view(np.uint64) if codes.shape[1] % 4 == 0 else codes


def taking_part(vectors: DataFrame) -> DataFrame:
    """Distinct ``vec_id`` and ``vector`` (double) of rows that can be searched, with ``entry``.

    Vectors must be finite, not zero, and as long as most are. ``entry`` names equal
    vectors alike, by 128 bits.
    """
    vector = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .where(F.forall("vector", fine) & F.exists("vector", lambda x: x != 0))
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    usual = sizes.orderBy(F.desc("count"), "size").first()
    size = usual["size"] if usual else 0
    return (
        rows.where(F.size("vector") == size)
        .withColumn("entry", F.concat(F.hex(F.xxhash64("vector")), F.hex(F.xxhash64(F.lit("again"), "vector"))))
        .dropDuplicates(["vec_id", "entry"])
    )


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), dtype=np.float64).reshape(len(rows), -1)


def encoded(rows: DataFrame, codes: Codes) -> DataFrame:
    """Rows with the ``code`` of their ``vector``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = codes.encode(_matrix(batch["vector"])) if len(batch) else ()
            yield batch.assign(code=[code.tobytes() for code in found])

    fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInPandas(run, f"{fields}, code binary")


FOUND = "entry string, own string, near string, vec_id long, score double"


def search(
    index: pd.DataFrame, queries: pd.DataFrame, codes: Codes, neighbours: int
) -> pd.DataFrame:
    """The best identifiers of one block of the index for each query entry, never its ``own``."""
    rows: list[tuple] = []
    if len(index) and len(queries):
        shape = (-1, codes.substrings)
        entry_codes = np.frombuffer(b"".join(index["code"]), dtype=np.uint16).reshape(shape)
        query_codes = np.frombuffer(b"".join(queries["code"]), dtype=np.uint16).reshape(shape)
        vectors, asked = _matrix(index["vector"]), _matrix(queries["vector"])
        ids, entries, names = index["ids"].tolist(), index["entry"].tolist(), queries["entry"].tolist()
        owns = [None if own is None else int(own) for own in queries["own"].tolist()]
        # Identifiers that repeat are few; of them an entry may hold nothing but its query's own.
        alone = {own: [len(i) == 1 and i[0] == own for i in ids] for own in set(owns) - {None}}
        for q, found in probe(entry_codes, query_codes, codes.radius):
            if owns[q] is not None:
                found = found[~np.array(alone[owns[q]], dtype=bool)[found]]
            scores = np.einsum("ij,j->i", vectors[found], asked[q])
            if len(found) > neighbours:
                least = np.partition(scores, -neighbours)[-neighbours]
                found, scores = found[scores >= least], scores[scores >= least]
            merged = sorted(
                (-score, vec_id, entry)
                for entry, score in zip(found.tolist(), scores.tolist(), strict=True)
                for vec_id in ids[entry]
                if vec_id != owns[q]
            )
            rows += [
                (names[q], queries["own"].iat[q], entries[entry], vec_id, -score)
                for score, vec_id, entry in merged[:neighbours]
            ]
    made = pd.DataFrame(rows, columns=["entry", "own", "near", "vec_id", "score"])
    return made.astype({"vec_id": "int64", "score": "float64"})


def _dealt(rows: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
    """Rows with their own block, once for every block of the other side."""
    return rows.withColumns(
        {
            own: F.pmod(F.xxhash64("entry"), F.lit(blocks)).cast("int"),
            other: F.explode(F.sequence(F.lit(0), F.lit(others - 1))),
        }
    )


#: What is asked for: a vector, and the identifier that may not be found, if it stands at others too.
ASKED = ("entry", "own")


def _best(index: DataFrame, asked: DataFrame, codes: Codes, most: int) -> DataFrame:
    """For each query entry the ``most`` best of those within the radius, over all blocks."""
    blocks = -(-index.count() // BLOCK)
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    left = _dealt(index, "block", blocks, "query_block", query_blocks)
    right = _dealt(asked, "query_block", query_blocks, "block", blocks)
    found = (
        left.groupBy("block", "query_block")
        .cogroup(right.groupBy("block", "query_block"))
        .applyInPandas(lambda i, q: search(i, q, codes, most), FOUND)
    )
    best = Window.partitionBy(*ASKED).orderBy(F.desc("score"), "vec_id", "near")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)
    return kept(found.drop("place"), "found")


def _found(index: DataFrame, asked: DataFrame, codes: Codes, most: int) -> DataFrame:
    """``_best``, with wider radii for the entries that find fewer than ``most``."""
    bits = codes.rotation.shape[1]
    found = _best(index, asked, codes, most)
    while codes.radius < bits:
        enough = found.groupBy(*ASKED).count().where(F.col("count") >= most)
        enough = kept(enough.select(*[F.col(c).alias(f"_{c}") for c in ASKED]), "enough")
        same = F.col("entry").eqNullSafe(F.col("_entry")) & F.col("own").eqNullSafe(F.col("_own"))
        asked = kept(asked.join(enough, same, "left_anti"), "asked")
        if asked.isEmpty():
            break
        radius = min(bits, max(2 * codes.radius, codes.radius + SUBSTRING_BITS))
        codes = replace(codes, radius=radius)
        # What they found before is found again.
        wider = _best(index, asked, codes, most)
        found = kept(found.join(enough, same, "left_semi").unionByName(wider), "found")
    return found


def nearest(
    vectors: DataFrame, neighbours: int = 20, every: int = 20, bits: int = 128
) -> DataFrame:
    """The nearest found of each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Queries are the rows whose ``vec_id`` is divisible by ``every``, candidates all
    rows but the query's own; nearest first, ties to the smaller ``vec_id``. Null
    vectors, zero vectors, vectors with null or non-finite components, vectors of
    another length than most and rows without ``vec_id`` take no part; a row that
    repeats another's identifier and vector counts once. Other columns are not
    read. Without rows to search the result is empty.

    Every query has ``neighbours`` rows, or as many as there are candidates. An identifier
    at several different vectors is one query, of which the nearest to any count; a row
    found through several of them counts once. A product too large for a double is
    infinite; one that is thereby no number is not found.

    Both sides are cut into blocks of bounded size and every pair of blocks is one
    task, as a radius wide enough for this recall leaves values to probe everywhere.
    Queries with too few candidates within the radius, and only they, are searched
    again with about twice the radius, and so on; all bits reach every candidate.
    """
    spark = vectors.sparkSession
    rows = kept(taking_part(vectors), "vectors")
    most = neighbours + 1  # a query's own identifier may be among them

    # Of equal vectors only the smallest identifiers can be found.
    by_id = Window.partitionBy("entry").orderBy("vec_id")
    entries = kept(
        rows.withColumn("place", F.row_number().over(by_id))
        .where(F.col("place") <= most)
        .groupBy("entry")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector")),
        "entries",
    )
    sample = np.array([row["vector"] for row in sampled(entries, SAMPLE, "entry")], dtype=np.float64)
    if len(sample) == 0:
        return spark.createDataFrame([], RESULT)
    sample = sample[np.lexsort(sample.T)]
    codes = fit(sample, neighbours, bits)

    index = kept(encoded(entries, codes), "index")
    queries = rows.where(F.col("vec_id") % every == 0).select("entry", F.col("vec_id").alias("query_id"))
    # Equal vectors ask once, unless their identifier stands at other vectors too: those are
    # then no candidates, and might fill a result that must hold others.
    spread = queries.groupBy("query_id").count().where(F.col("count") > 1)
    # As text, since whole numbers beside nulls lose digits in pandas.
    spread = spread.select("query_id", F.col("query_id").cast("string").alias("own"))
    queries = kept(queries.join(spread, "query_id", "left"), "queries")
    asked = index.drop("ids").join(queries.select(*ASKED).distinct(), "entry")
    asked = kept(asked, "asked")
    found = _found(index, asked, codes, most).select(
        *[F.col(c).alias(f"_{c}") for c in ASKED], "near", "vec_id", "score"
    )
    same = (F.col("entry") == F.col("_entry")) & F.col("own").eqNullSafe(F.col("_own"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "near")
    return (
        queries.join(found, same)
        .where(F.col("vec_id") != F.col("query_id"))
        .groupBy("query_id", "vec_id", "near")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(ranked).cast("int"))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
