"""Find secrets in texts with one deterministic automaton over their bytes.

All rules are compiled together: the scan reads every byte once, whatever the
number of rules, and says where the head of some rule ends. The rare hits are
then resolved into spans: an automaton of the reversed head gives the leftmost
start, and the rule's tail class the end. Spans of one rule do not overlap; a
match that fails the rule's least length still uses up its characters, as a
regular expression would. A private key goes on over the lines of its body, which
are read only where its first line was found.

Texts of a batch are cut at line ends, which lead every state back to the start,
and the pieces advance together, a byte each per step.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometry.llm.automata import Automaton
from aerometry.llm.documents import map_texts, text_bytes

#: Pieces longer than this are cut at every byte that leads back to the start.
LONG_PIECE = 1 << 14
#: So few pieces, still to be read, are read one by one; more are read a byte of each at a time.
FEW_LANES = 24


@dataclass(frozen=True)
class Rule:
    """A match is ``head`` followed by all characters of ``tail`` that come next.

    ``value`` is the class that counts towards ``least``, from the match's end
    backwards; None counts the whole match. ``armored`` goes on over the lines of a
    key, up to the line that ends it.
    """

    kind: str
    head: str
    tail: str | None
    least: int = 0
    value: str | None = None
    armored: bool = False


VALUE = r"[A-Za-z0-9+/_.=-]"

BASE = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""" + VALUE,
        VALUE,
        8,
        "value",
    ),
    Rule("access", r"AKIA[A-Z0-9]", r"[A-Z0-9]", 16),
    Rule("hex", r"[0-9a-f]{32}", r"[0-9a-f]", 32),
)

#: Further shapes that no ordinary prose has.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", None, armored=True),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]", r"[A-Za-z0-9]", 40),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]", r"[A-Za-z0-9_-]", 40),
)

RULES = BASE + MORE

#: Ends of lines, also as quoted strings write them.
BREAK = re.compile(rb"\r?\n|\r|(?:\\+r)?\\+n|\\+r")
#: What may stand between the digits of a body: white space and marks of quoted lines.
MARKS = rb"\s\"'`,;<>&#%*|"
#: Lines such as ``DEK-Info: AES-128-CBC,00`` ahead of a body.
NAMED = re.compile(
    rb"(?:(?:[%b+]|\\+[nrt]?)*[A-Za-z][A-Za-z0-9-]*:(?:(?!-----)[^\r\n\\])*)*+" % MARKS
)
BODY = re.compile(rb"(?:[A-Za-z0-9+/=%b]|\\+)*+" % MARKS)
END = re.compile(rb"-----END [A-Z ]*PRIVATE KEY-----")
GROUP = re.compile(rb"[+/=]*[A-Za-z0-9][A-Za-z0-9+/=]*")
#: So many digits of a body are no word.
LONG_GROUP = 24


def armor_end(data: np.ndarray, position: int, end: int) -> int:
    """Where the key ends whose first line ends at ``position``.

    Without the line that ends it, a key goes to the last line that is one group of
    digits, a shorter one included; a blank line ends it. Several groups in one line,
    as where line ends were lost, count while they are long, and one more.
    """
    view = memoryview(data)
    first = NAMED.match(view, position, end).end()
    last = BODY.match(view, first, end).end()
    closed = END.match(view, last, end)
    if closed:
        return closed.end()
    body, stop, start = bytes(view[first:last]), None, 0
    breaks = [m.span() for m in BREAK.finditer(body)]
    for line_end, following in [*breaks, (len(body), None)]:
        groups = list(GROUP.finditer(body, start, line_end))
        long = 0
        while long < len(groups) and len(groups[long][0]) >= LONG_GROUP:
            long += 1
        whole = following is not None or last == end
        if len(groups) == 1 and whole:
            stop = groups[0].end()
        elif groups:
            if long:
                stop = groups[min(long, len(groups) - 1)].end()
            if long < len(groups):
                break
        elif stop is not None and not body[start:line_end].strip():
            break
        start = following
    return position if stop is None else first + stop


class Scanner:
    """The compiled rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.all = Automaton([rule.head for rule in rules])
        self.back = [Automaton([r.head], search=False, reverse=True) for r in rules]
        self.tails = [_members(rule.tail) for rule in rules]
        self.rows, self.ends = self.all.table.tolist(), self.all.mask.tolist()
        step = self.all.table
        self.resets = (step == self.all.start).all(axis=0)[self.all.byte_class]

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of bytes at which heads end, and which heads newly do (as bits)."""
        starts, ends = self._pieces(data, offsets)
        order = np.argsort(starts - ends, kind="stable")
        at, ends = starts[order], ends[order]
        lengths = ends - at
        classes = self.all.byte_class.astype(np.uint8)[data]
        flat, mask, width = self.all.flat, self.all.mask, self.all.classes
        accepting = mask > 0
        state = np.zeros(len(at), dtype=np.int32)
        before = np.zeros(len(at), dtype=bool)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        live = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")
        for t, n in enumerate(live):
            if n <= FEW_LANES:
                for lane in range(n):
                    rest = slice(int(at[lane]) + t, int(ends[lane]))
                    found.append(self._rest(classes[rest], rest.start, int(state[lane]), bool(before[lane])))
                break
            old = state[:n]
            new = flat[old * width + classes[at[:n] + t]]
            now = accepting[new]
            if now.any() or before[:n].any():
                lanes = np.flatnonzero(now)
                fresh = mask[new[lanes]] & ~np.where(before[lanes], mask[old[lanes]], 0)
                keep = fresh > 0
                found.append((at[lanes[keep]] + t, fresh[keep]))
            state, before = new, now
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        positions = np.concatenate([p for p, _ in found])
        bits = np.concatenate([b for _, b in found])
        order = np.argsort(positions, kind="stable")
        return positions[order], bits[order]

    def _rest(
        self, classes: np.ndarray, first: int, state: int, before: bool
    ) -> tuple[np.ndarray, np.ndarray]:
        """As ``hits`` for the rest of one lane, byte by byte."""
        rows, mask = self.rows, self.ends
        last = mask[state] if before else 0
        positions, bits = [], []
        for position, byte in enumerate(classes.tobytes(), first):
            state = rows[state][byte]
            now = mask[state]
            if now:
                if now & ~last:
                    positions.append(position)
                    bits.append(now & ~last)
                last = now
            elif last:
                last = 0
        return np.array(positions, dtype=np.int64), np.array(bits, dtype=np.int64)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.resets[10]:
            raise ValueError("a rule reads across line ends")
        cuts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
        if len(cuts) > 1 and np.diff(cuts).max() > LONG_PIECE:
            cuts = np.unique(np.concatenate([offsets, np.flatnonzero(self.resets[data]) + 1]))
        return cuts[:-1], cuts[1:]

    def spans(self, data: np.ndarray, first: int, end: int, hits) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes of one text, which lies at ``first:end``."""
        used = [first] * len(self.rules)
        found = []
        for position, bits in hits:
            for k, rule in enumerate(self.rules):
                if not bits >> k & 1 or position < used[k]:
                    continue
                start = self._start(k, data, used[k], position)
                if start is None:
                    continue
                stop = self._stop(k, data, position + 1, end)
                used[k] = stop
                if self._long_enough(rule, k, data, start, position, stop):
                    found.append((k, start - first, stop - first))
        return found

    def _start(self, k: int, data, least: int, position: int) -> int | None:
        back, state, start = self.back[k], 0, None
        while position >= least:
            state = back.table[state, back.byte_class[data[position]]]
            if back.mask[state]:
                start = position
            elif state == self._dead(k):
                break
            position -= 1
        return start

    @cache
    def _dead(self, k: int) -> int:
        back = self.back[k]
        stuck = (back.table == np.arange(len(back.table))[:, None]).all(axis=1) & (back.mask == 0)
        return int(np.flatnonzero(stuck)[0]) if stuck.any() else -1

    def _stop(self, k: int, data, position: int, end: int) -> int:
        tail = self.tails[k]
        if self.rules[k].armored:
            return armor_end(data, position, end)
        if tail is None:
            return position
        step = 64
        while position < end:
            outside = np.flatnonzero(~tail[data[position : min(end, position + step)]])
            if len(outside):
                return position + int(outside[0])
            position, step = min(end, position + step), step * 4
        return position

    def _long_enough(self, rule: Rule, k: int, data, start: int, position: int, stop: int) -> bool:
        # The head ends with the value's first character, so the value goes from there.
        return stop - (position if rule.value else start) >= rule.least


def _members(pattern: str | None) -> np.ndarray | None:
    if pattern is None:
        return None
    automaton = Automaton([pattern], search=False)
    return automaton.mask[automaton.table[0]][automaton.byte_class] > 0


@cache
def scanner() -> Scanner:
    return Scanner()


def _joined(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    ordered = sorted(spans, key=lambda span: (span[1], span[0]))
    return ",".join(f"{rules[k].kind}:{start}:{end}" for k, start, end in ordered)


def find_spans(texts: pa.Array) -> list[list[tuple[int, int, int]]]:
    """Per text its spans (rule number, start, end) in code points."""
    scan = scanner()
    data, offsets = text_bytes(texts)
    positions, bits = scan.hits(data, offsets)
    bounds = np.searchsorted(positions, offsets)
    result: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    for i in np.flatnonzero(np.diff(bounds)):
        first, end = int(offsets[i]), int(offsets[i + 1])
        hits = zip(positions[bounds[i] : bounds[i + 1]].tolist(), bits[bounds[i] : bounds[i + 1]].tolist())
        found = scan.spans(data, first, end, hits)
        if found:
            points = np.concatenate([[0], np.cumsum(data[first:end] & 0xC0 != 0x80)])
            result[i] = [(k, int(points[a]), int(points[b])) for k, a, b in found]
    return result


SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every document: counts per base rule and all spans.

    One row per input row. Null and empty texts have no spans; repeated rows are
    scanned alike; other columns of ``docs`` are not read. Spans are written
    ``kind:start:end`` in code points by start, then kind. Letters in either case are
    those of ASCII; no other letter stands for one. Memory follows ``BATCH_BYTES``, or
    the longest text where that is larger.
    """

    def batch(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        rules, rows = RULES, find_spans(texts)
        base = [[s for s in row if s[0] < len(BASE)] for row in rows]
        counts = [
            pa.array([sum(s[0] == k for s in row) for row in base], pa.int64())
            for k in range(len(BASE))
        ]
        digests = [hashlib.sha256(_joined(row, rules).encode()).hexdigest() for row in base]
        spans = [_joined(row, rules) for row in rows]
        return pa.RecordBatch.from_arrays(
            [ids, *counts, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )

    return map_texts(docs, batch, SCHEMA)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, overlapping ones merged, replaced by ``[SECRET]``."""
    parts, last = [], 0
    for _, start, end in sorted(spans, key=lambda span: span[1:]):
        if start >= last:
            parts += [text[last:start], "[SECRET]"]
        last = max(last, end)
    return "".join([*parts, text[last:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with all secrets replaced; ``n_chars`` follows where it exists.

    Null texts stay null; rows, order of columns and other columns stay as they are.
    """

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at)
            filled = texts.fill_null("").cast(pa.large_string())
            found = find_spans(filled)
            cleaned = [
                redact(text, spans) if spans else text
                for text, spans in zip(texts.to_pylist(), found, strict=True)
            ]
            yield batch.set_column(at, "text", pa.array(cleaned, texts.type))

    return with_char_counts(docs.mapInArrow(run, docs.schema))


def with_char_counts(docs: DataFrame) -> DataFrame:
    """``n_chars`` set to the text's length, where the column exists."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
