"""Byte-pair encoding and decoding by a tokenization automaton.

The merges are compiled one after the other into a deterministic automaton whose
arcs carry tokens and which accepts exactly the correct tokenizations. It begins
as one state with a loop for each byte. The gadget for a merge ``u v -> w``
redirects every ``u`` arc to a copy of its target that lacks the ``v`` arc, and
adds a ``w`` arc wherever a ``u`` arc leaves. As all arcs of a token share their
target, a state is kept as its parent and the one arc it lost.

Reading that automaton byte by byte is made deterministic on demand: a byte state
holds, for every place where a token may still go on, the automaton state there
and the part of the token already read. For every prefix of a word exactly one
token ends it, so the tokens are read off backwards along the visited states.
Visited transitions are kept in a table, words in a memo; both are emptied when
they reach their limit, which changes nothing but time.

Decoding emits the byte labels of the arcs.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from aerometry.llm.documents import map_texts

#: Distinct words and byte transitions a worker remembers.
MEMO_LIMIT = 500_000
TABLE_LIMIT = 1_000_000

#: White space as Unicode defines it; the control characters 28 to 31 are not in it.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACES}\p{{L}}\p{{N}}]+"
    rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)


def byte_characters() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write bytes as."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeAutomaton:
    """Automaton over tokens. State 0 is the start and has every arc."""

    def __init__(self, labels: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        self.labels = labels
        size = max(labels.values()) + 1
        self.parent, self.lost, self.time = [-1], [-1], [0]
        self.target = [0] * size
        self.left = [-1] * size  # the token a token begins with, -1 for single bytes
        self.birth = [0] * size
        self._removed: dict[int, dict[int, int]] = {0: {}}
        self.alive = [len(label) == 1 for label in self._by_id(size)]
        for time, (u, v) in enumerate(merges, start=1):
            self._merge(labels[u], labels[v], labels[u + v], time)

    def _by_id(self, size: int) -> list[bytes]:
        found = [b""] * size
        for label, token in self.labels.items():
            found[token] = label
        return found

    def _merge(self, u: int, v: int, w: int, time: int) -> None:
        if not (self.alive[u] and self.alive[v] and self.allows(self.target[u], v)):
            return  # no correct tokenization so far has u before v
        if self.alive[w]:
            raise ValueError("two merges make the same token")
        after = self.target[v]
        self.parent.append(self.target[u])
        self.lost.append(v)
        self.time.append(time)
        self.target[u] = len(self.parent) - 1
        self.target[w], self.left[w], self.birth[w], self.alive[w] = after, u, time, True

    def removed(self, state: int) -> dict[int, int]:
        """Arcs that the state lost, by the time of the merge."""
        found = self._removed.get(state)
        if found is None:
            chain_, at = [], state
            while at > 0:
                chain_.append(at)
                at = self.parent[at]
            found = {self.lost[s]: self.time[s] for s in chain_}
            if len(self._removed) > 20_000:
                self._removed.clear()
                self._removed[0] = {}
            self._removed[state] = found
        return found

    def allows(self, state: int, token: int) -> bool:
        """Whether the state has an arc for the token.

        A token got its arc where the token it begins with had one when it was
        made; losing that one later does not matter.
        """
        removed = self.removed(state)
        if not removed:
            return True
        until = self.time[-1] + 1
        while token >= 0:
            when = removed.get(token)
            if when is not None and when <= until:
                return False
            until, token = self.birth[token], self.left[token]
        return True


class WordEncoder:
    """The token automaton read byte by byte, made deterministic as words need it."""

    def __init__(self, automaton: MergeAutomaton) -> None:
        self.automaton = automaton
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for label, token in automaton.labels.items():
            if automaton.alive[token]:
                self._spell(label, token)
        self.length = {t: len(label) for label, t in automaton.labels.items()}
        self._reset()

    def _spell(self, label: bytes, token: int) -> None:
        node = 0
        for byte in label:
            nxt = self.children[node].get(byte)
            if nxt is None:
                nxt = len(self.children)
                self.children[node][byte] = nxt
                self.children.append({})
                self.token_at.append(-1)
            node = nxt
        self.token_at[node] = token

    def _reset(self) -> None:
        start = ((0, 0),)
        self.numbers = {(start, -1): 0}
        self.configs = [start]
        self.last = [-1]
        self.table: dict[int, int] = {}

    def encode(self, word: bytes) -> tuple[int, ...]:
        """Token numbers of one pre-split word."""
        if len(self.table) > TABLE_LIMIT:
            self._reset()
        table, state, path = self.table, 0, []
        for byte in word:
            key = state << 8 | byte
            nxt = table.get(key)
            if nxt is None:
                nxt = self._step(state, byte)
                table[key] = nxt
            path.append(nxt)
            state = nxt
        found, at = [], len(path)
        while at:
            token = self.last[path[at - 1]]
            found.append(token)
            at -= self.length[token]
        found.reverse()
        return tuple(found)

    def _step(self, state: int, byte: int) -> int:
        going, ended = [], -1
        for before, node in self.configs[state]:
            node = self.children[node].get(byte)
            if node is None:
                continue
            token = self.token_at[node]
            if token >= 0 and self.automaton.allows(before, token):
                ended = token
            if self.children[node]:
                going.append((before, node))
        going.append((self.automaton.target[ended], 0))
        key = (tuple(going), ended)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.configs)
            self.configs.append(key[0])
            self.last.append(ended)
        return number


class Memo(dict):
    """Token numbers by pre-split word."""

    def __init__(self, words: WordEncoder) -> None:
        super().__init__()
        self.words = words

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = self.words.encode(piece.encode())
        if len(piece) <= 64:
            if len(self) >= MEMO_LIMIT:
                self.clear()
            self[piece] = found
        return found


class ByteLevelCodec:
    """Encodes and decodes with a byte-level vocabulary file of ``tokenizers``."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = byte_characters()
        as_bytes = lambda text: bytes(to_byte[c] for c in text)
        model = spec["model"]
        labels = {as_bytes(text): token for text, token in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        merges = [(as_bytes(u), as_bytes(v)) for u, v in pairs]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.memo = Memo(WordEncoder(MergeAutomaton(labels, merges)))
        size = max([*labels.values(), *self.specials.values()]) + 1
        self.arcs = [b""] * size
        for label, token in labels.items():
            self.arcs[token] = label
        for content, token in self.specials.items():
            self.arcs[token] = content.encode()
        names = sorted(self.specials, key=len, reverse=True)
        self._split = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None

    def encode(self, text: str) -> list[int]:
        if self._split is None or not any(name in text for name in self.specials):
            return self._ordinary(text)
        found: list[int] = []
        for part in self._split.split(text):
            found += [self.specials[part]] if part in self.specials else self._ordinary(part)
        return found

    def _ordinary(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, PIECE.findall(text))))

    def decode(self, tokens: list[int]) -> str:
        return b"".join(map(self.arcs.__getitem__, tokens)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> ByteLevelCodec:
    """One codec per worker process and file.

    Its tables hold millions of small objects without cycles; freezing them and
    collecting less often keeps the garbage collector from visiting them again.
    """
    found = ByteLevelCodec(path)
    gc.freeze()
    gc.set_threshold(200_000, 50, 1000)
    return found


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every document with the vocabulary file at ``path``.

    The file must exist on every executor. One row per input row: the number of
    tokens, the digest of their decimal numbers joined by commas, and the digest
    of the decoded text. Null and empty texts have no tokens; repeated rows are
    encoded alike; other columns of ``docs`` are not read.
    """

    def batch(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        own = codec(path)
        decimal = list(map(str, range(len(own.arcs))))
        counts, encoded, decoded = [], [], []
        for text in texts.to_pylist():
            tokens = own.encode(text)
            counts.append(len(tokens))
            joined = ",".join(map(decimal.__getitem__, tokens)).encode()
            encoded.append(hashlib.sha256(joined).hexdigest())
            decoded.append(hashlib.sha256(own.decode(tokens).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_texts(docs, batch, SCHEMA)
