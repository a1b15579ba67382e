"""Pack tokenized documents into windows of equal capacity by differencing.

A document is cut into full windows, the largest multiple of ``UNIT`` that is
left, and a rest below ``UNIT``. The pieces below a window are dealt to cells of
bounded size, and each cell is partitioned by Karmarkar and Karp's multiway
differencing: a partial partition is a vector of window loads; the two partials
with the largest imbalances are merged again and again, heavy windows of one onto
light windows of the other, until one partition is left. Large pieces meet early
and rests even out what they leave, so loads end a few tokens apart. A cell takes
as many windows as its tokens need and one more while a window exceeds capacity.
Pieces are dealt by their place in the table, so that equal ones spread too.
"""

from __future__ import annotations

import heapq
import os
import re
import sys
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometry.llm.bpe_automaton import byte_characters
from aerometry.llm.documents import map_texts
from aerometry.session import scratch_path

CAPACITY = 4096
UNIT = 512
END_TOKEN = 2

#: A cell holds about so many tokens, and so many pieces, at most.
CELL_TOKENS = 256 * CAPACITY
CELL_PIECES = 20_000

#: Distinct words of a generation of a worker's memory; it holds two.
MEMO_LIMIT = 345_000

WORD = re.compile(r"[^ \t-\r]+")
#: White space to some and not to others, of a vocabulary and the ways to split texts.
CONTROL = re.compile("[\x1c-\x1f\x85\xa0]")

#: Characters whose words are looked up together.
BATCH_BYTES = 8 << 20


if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("checksums are over little-endian numbers of four bytes")


class Memo(dict):
    """Words and their tokens; a missing one is made.

    When a generation is full, the one before it goes. Words that are asked for again
    move over, so that common ones stay.
    """

    def __init__(self, make: Callable[[str], bytes], before: Memo | None = None) -> None:
        self.make, self.before = make, {} if before is None else before

    def __missing__(self, word: str) -> bytes:
        known = self.before.get(word)
        if known is None:
            known = self.make(word)
        self[word] = known
        return known

    def following(self) -> Memo:
        """This generation, or a new one if it is full."""
        if len(self) <= MEMO_LIMIT:
            return self
        self.before = {}
        return Memo(self.make, self)


class WordTokens:
    """Token numbers of words, as little-endian bytes, by a vocabulary that drops white space.

    Such a vocabulary splits at every white space, and between letters and a mark
    behind them, before it merges; so a text's tokens are those of its words in
    order. It also lower-cases letter by letter, which texts of Latin letters
    undergo here as a whole, so that fewer words differ. A word of such letters is one
    piece to it, whose bytes go to the merges as characters.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = self.tokenizer.model
        shown = {byte: character for character, byte in byte_characters().items()}
        self.shown = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(128, 256)}
        self.memo = Memo(self._tokens)

    def encode(self, text: str) -> bytes:
        """The tokens of a text, four bytes each."""
        return bytes(self.encode_all(pa.array([text], pa.large_string()))[0])

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The tokens of each text. Words that repeat in plain texts are looked up once."""
        written = texts.to_pylist()
        plain = np.fromiter(map(_plain, written), dtype=bool, count=len(written))
        found = [b""] * len(written)
        for at in np.flatnonzero(~plain):
            self.memo.make = self._tokens
            found[at] = b"".join(map(self.memo.__getitem__, WORD.findall(written[at])))
            self.memo = self.memo.following()
        if plain.any():
            tokens, bounds = self._plain_tokens(texts.filter(pa.array(plain)))
            for at, first, end in zip(np.flatnonzero(plain), bounds, bounds[1:], strict=False):
                found[at] = tokens[first:end].tobytes()
        return found

    def _plain_tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of plain texts one after the other, and where each text's begin."""
        lists = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        words = lists.flatten().dictionary_encode()
        self.memo.make = self._letters
        # Next to white space at either end of a text lies an empty word, without tokens.
        known = [self.memo[word] if word else b"" for word in words.dictionary.to_pylist()]
        self.memo = self.memo.following()
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        tokens = np.frombuffer(b"".join(known), dtype="<u4")
        word = words.indices.to_numpy()
        ends = np.cumsum(sizes[word])
        ahead = np.concatenate([[0], ends])
        starts = (np.cumsum(sizes) - sizes)[word]
        place = np.repeat(starts - ahead[:-1], sizes[word]) + np.arange(ahead[-1])
        offsets = lists.offsets.to_numpy()
        return tokens[place], ahead[offsets - offsets[0]]

    def _letters(self, word: str) -> bytes:
        """Tokens of a word of a plain text: in lower case, of Latin-1 characters."""
        if not word.isalpha():
            return self._tokens(word)
        shown = word if word.isascii() else word.translate(self.shown)
        return array("I", [token.id for token in self.merges.tokenize(shown)]).tobytes()

    def _tokens(self, word: str) -> bytes:
        """Letters and one mark behind them are encoded apart, as the vocabulary splits them.

        Some letters beyond Latin-1 end with a mark of their own in lower case.
        """
        if word[-1] in ".," and word[:-1].isalpha() and word[-2] < "\u0100":
            return self.memo[word[:-1]] + self.memo[word[-1]]
        found = self.tokenizer.encode(word, add_special_tokens=False).ids
        return array("I", found).tobytes()


def _plain(text: str) -> bool:
    """Whether the text can be lower-cased and split as a whole, with the same tokens."""
    if "<|" in text or CONTROL.search(text):
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One encoder per worker process and file."""
    return WordTokens(path)


def cuts(tokens: int) -> list[tuple[int, int]]:
    """Start and length of each piece of a document."""
    found = [(start, CAPACITY) for start in range(0, tokens - CAPACITY + 1, CAPACITY)]
    start = len(found) * CAPACITY
    body = (tokens - start) // UNIT * UNIT
    if body:
        found.append((start, body))
        start += body
    if start < tokens:
        found.append((start, tokens - start))
    return found


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def document_pieces(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of every document, with the checksum of their tokens."""
    end = np.array([END_TOKEN], dtype="<u4").tobytes()

    def batch(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        rows = []
        words = word_tokens(path)
        for doc_id, found in zip(ids.to_pylist(), words.encode_all(texts), strict=True):
            tokens = memoryview(found + end)
            total = len(tokens) // 4
            for start, length in cuts(total):
                crc = zlib.crc32(tokens[4 * start : 4 * (start + length)])
                rows.append((doc_id, start, length, crc, total))
        columns = zip(*rows, strict=True) if rows else [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
        )

    return map_texts(docs, batch, PIECES, BATCH_BYTES)


def difference(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each size's window, and the loads, by multiway differencing."""
    loads: list[np.ndarray | None] = []
    merges: list[tuple[int, int, np.ndarray] | None] = [None] * len(sizes)
    heap = []
    for i, size in enumerate(sizes.tolist()):
        load = np.zeros(windows, dtype=np.int64)
        load[0] = size
        loads.append(load)
        heap.append((-size if windows > 1 else 0, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        merged = loads[a] + loads[b][::-1]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        loads[a] = loads[b] = None
        heapq.heappush(heap, (int(merged[-1] - merged[0]), len(loads)))
        loads.append(merged)
        merges.append((a, b, order))
    last = heap[0][1]
    names = {last: np.arange(windows)}
    window = np.empty(len(sizes), dtype=np.int64)
    for node in range(last, -1, -1):
        own = names.pop(node)
        if merges[node] is None:
            window[node] = own[0]
            continue
        a, b, order = merges[node]
        pairs = np.empty(windows, dtype=np.int64)
        pairs[order] = own
        names[a], names[b] = pairs, pairs[::-1]
    return window, loads[last]


def partition(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """A window for each size such that no window exceeds capacity."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window, loads = difference(sizes, windows)
        if loads.max() <= capacity:
            return window
        windows += 1


PLACED = PIECES + ", place long"
PACKED = PIECES + ", sequence_id long, offset long"


def _pack_cell(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
    pieces = pieces.drop(columns=["cell", "place"]).sort_values(
        ["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True]
    )
    lengths = pieces["length"].to_numpy()
    full = int((lengths >= CAPACITY).sum())
    window = np.arange(len(pieces))
    if full < len(pieces):
        window[full:] = full + partition(lengths[full:])
    pieces["sequence_id"] = (int(key[0]) << 32) + window
    pieces = pieces.sort_values("sequence_id", kind="stable")
    lengths = pieces["length"]
    pieces["offset"] = lengths.groupby(pieces["sequence_id"]).cumsum() - lengths
    return pieces


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    """Every token of every document in one window of at most ``CAPACITY`` tokens.

    One row per piece, with its document, place and window. Null and empty texts
    consist of the end token; repeated rows are packed as documents of their own;
    a null ``doc_id`` stays null; no rows give no rows. Other columns of ``docs``
    are not read. The vocabulary file at ``path`` must exist on every executor.

    Texts are tokenized once; the pieces are kept as a table in the shared folder,
    and only these few numbers per piece are shuffled.
    """
    spark = docs.sparkSession
    kept = scratch_path(spark, "pieces")
    placed = document_pieces(docs, path).withColumn("place", F.monotonically_increasing_id())
    placed.write.parquet(kept)
    pieces = spark.read.schema(PLACED).parquet(kept)
    small = F.col("length") < CAPACITY
    tokens, count = pieces.agg(
        F.sum(F.when(small, F.col("length"))), F.count("*")
    ).first()
    cells = max(1, -(-(tokens or 0) // CELL_TOKENS), -(-count // CELL_PIECES))
    cell = F.pmod(F.xxhash64("place"), F.lit(cells))
    return pieces.withColumn("cell", cell).groupBy("cell").applyInPandas(_pack_cell, PACKED)
