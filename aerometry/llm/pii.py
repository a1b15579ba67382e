"""Find personal data by anchors and local parsers.

One Aho-Corasick automaton finds the anchors: at-signs, plus signs, digits,
address schemes and identifier cues. From each anchor a small deterministic
parser expands to the boundaries of an email address, a network address, a card,
phone or account number, and validates it. Texts without anchors cost one pass.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from aerometry.llm.documents import map_texts

DIGITS = frozenset("0123456789")
LABEL = frozenset(string.ascii_letters + string.digits + "-")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
PHONE = DIGITS | frozenset(" ().-")
USER = LOCAL | frozenset(":~!$&'*,;=")
UPPER_DIGITS = frozenset(string.ascii_uppercase + string.digits)

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "ssn", "login")
KINDS = BASE_KINDS + MORE_KINDS

SCHEMES = ("http://", "https://", "ftp://", "ssh://")
IBAN_CUES = ("IBAN", "iban")
SSN_CUES = ("SSN", "ssn")

#: Characters of an account number by country; others have any number from 15 to 34.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}

Span = tuple[str, int, int]


@cache
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for cue in [*DIGITS, "@", "+", *SCHEMES, *IBAN_CUES, *SSN_CUES]:
        kind = "digit" if cue in DIGITS else "scheme" if cue in SCHEMES else cue.lower()
        found.add_word(cue, kind)
    found.make_automaton()
    return found


def _run(text: str, at: int, members: frozenset[str]) -> int:
    """First position from ``at`` on that holds no member."""
    end = len(text)
    while at < end and text[at] in members:
        at += 1
    return at


def _emails(text: str, signs: list[int]) -> Iterator[Span]:
    used = 0
    for sign in signs:
        start = sign
        while start > used and text[start - 1] in LOCAL:
            start -= 1
        end = _run(text, sign + 1, LABEL)
        if start == sign or end == sign + 1:
            continue
        dots = 0
        while end < len(text) and text[end] == ".":
            label = _run(text, end + 1, LABEL)
            if label == end + 1:
                break
            end, dots = label, dots + 1
        if dots:
            used = end
            yield "email", start, end


def _digit_runs(digits: list[int]) -> list[tuple[int, int]]:
    runs: list[tuple[int, int]] = []
    start = last = None
    for at in digits:
        if start is None:
            start = at
        elif at != last + 1:
            runs.append((start, last + 1))
            start = at
        last = at
    if start is not None:
        runs.append((start, last + 1))
    return runs


def _chains(text: str, runs: list[tuple[int, int]], separators: str) -> Iterator[list]:
    """Runs of digits that follow each other with one separator between."""
    chain: list[tuple[int, int]] = []
    for run in runs:
        if chain and not (run[0] == chain[-1][1] + 1 and text[run[0] - 1] in separators):
            yield chain
            chain = []
        chain.append(run)
    if chain:
        yield chain


def _addresses(text: str, runs: list[tuple[int, int]]) -> Iterator[Span]:
    for chain in _chains(text, runs, "."):
        for i in range(0, len(chain) - 3, 4):
            parts = [text[a:b].lstrip("0") for a, b in chain[i : i + 4]]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                yield "ip", chain[i][0], chain[i + 3][1]


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of those before it."""
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = int(digit) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _cards(text: str, runs: list[tuple[int, int]]) -> Iterator[Span]:
    for chain in _chains(text, runs, " -"):
        if 13 <= sum(b - a for a, b in chain) <= 19:
            if luhn("".join(text[a:b] for a, b in chain)):
                yield "card", chain[0][0], chain[-1][1]


def _phones(text: str, signs: list[int]) -> Iterator[Span]:
    for sign in signs:
        if sign + 1 >= len(text) or text[sign + 1] not in DIGITS:
            continue
        end = _run(text, sign + 2, PHONE)
        while end > sign + 2 and text[end - 1] not in DIGITS:
            end -= 1
        if end >= sign + 4 and 9 <= sum(c in DIGITS for c in text[sign:end]) <= 15:
            yield "phone", sign, end


def iban_valid(account: str) -> bool:
    """Whether the check digits of an international account number fit."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _after_cue(text: str, end: int) -> int:
    """Start of what a cue announces: behind a colon, number sign or spaces."""
    return _run(text, end, frozenset(" :#"))


def _accounts(text: str, cue_ends: list[int]) -> Iterator[Span]:
    """Words behind an account number look like more of its groups.

    So the number ends with any group that makes it valid: with the one that gives
    its country's length, or else with the last one.
    """
    for end in cue_ends:
        start = at = _after_cue(text, end)
        found, ends = [], {}
        while at < len(text) and len(found) < 34:
            if text[at] in UPPER_DIGITS:
                found.append(text[at])
                at += 1
                ends[len(found)] = at
            elif text[at] == " " and at + 1 < len(text) and text[at + 1] in UPPER_DIGITS:
                at += 1
            else:
                break
        account = "".join(found)
        if not (account[:2].isalpha() and account[2:4].isdigit()):
            continue
        usual = IBAN_LENGTHS.get(account[:2])
        for length in sorted(ends, key=lambda n: (n == usual, n), reverse=True):
            last = length == len(account)
            grouped = last or text[ends[length]] not in UPPER_DIGITS
            if length >= 15 and grouped and iban_valid(account[:length]):
                yield "iban", start, ends[length]
                break


def _security_numbers(text: str, cue_ends: list[int]) -> Iterator[Span]:
    for end in cue_ends:
        start = at = _after_cue(text, end)
        parts = []
        for length in (3, 2, 4):
            stop = _run(text, at, DIGITS)
            if stop - at != length:
                break
            parts.append(text[at:stop])
            at = stop + 1 if length != 4 and text[stop : stop + 1] == "-" else stop
        if len(parts) == 3 and at - start == 11 and parts[0] not in ("000", "666") and parts[0] < "900":
            yield "ssn", start, at


def _logins(text: str, scheme_ends: list[int]) -> Iterator[Span]:
    """Names and passwords ahead of the host of an address."""
    for start in scheme_ends:
        end = _run(text, start, USER)
        if end > start and text[end : end + 1] == "@" and ":" in text[start:end]:
            yield "login", start, end


def personal_spans(text: str) -> list[Span]:
    """All spans (kind, start, end) of one text, by kind as listed, then start."""
    at: dict[str, list[int]] = {}
    for last, kind in _anchors().iter(text):
        at.setdefault(kind, []).append(last)
    if not at:
        return []
    after = {kind: [last + 1 for last in ends] for kind, ends in at.items()}
    runs = _digit_runs(at.get("digit", []))
    return [
        *_emails(text, at.get("@", [])),
        *_addresses(text, runs),
        *_cards(text, runs),
        *_phones(text, at.get("+", [])),
        *_accounts(text, after.get("iban", [])),
        *_security_numbers(text, after.get("ssn", [])),
        *_logins(text, after.get("scheme", [])),
    ]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string"
)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Personal data of every document: counts per base kind and all spans.

    One row per input row. Null and empty texts have no spans; repeated rows are
    treated alike; other columns of ``docs`` are not read. Spans are written
    ``kind:start:end`` in code points, by kind as listed, then start.
    """

    def batch(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        found = [personal_spans(text) for text in texts.to_pylist()]
        base = [[s for s in spans if s[0] in BASE_KINDS] for spans in found]
        counts = [
            pa.array([sum(s[0] == kind for s in spans) for spans in base], pa.int64())
            for kind in BASE_KINDS
        ]
        digests = [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base]
        return pa.RecordBatch.from_arrays(
            [ids, *counts, pa.array(digests, pa.string()), pa.array(map(joined, found), pa.string())],
            ["doc_id", *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans"],
        )

    return map_texts(docs, batch, SCHEMA)
