"""Secrets and personal data against regular expressions."""

import random
import time

import plain
import pyarrow as pa
import pytest
from given import documents, edges, empty  # noqa: F401
from plain import TEXTS

from aerometry.llm import pii, secret_scan
from aerometry.llm.automata import Automaton

SECRET_PARTS = [
    "token", "secret", "password", "Api_key", "apikey", "passwd", "=", ":", " ", '"', "'", "a",
    "0123456789abcdef" * 2, "AKIA", "ABCDEFGHIJKLMN", "deadbeef", "é", "\n", ".", "==",
]
PRIVATE_PARTS = [
    *"0123456789@.+- ()%_aZé\n", "12", "255", "256", "1.2.3.4", "4465758382889437",
    "+1 (663) 555-6869", "a.b@c.d", "0000255", "9" * 30,
]


def drawn(parts, n, longest=40, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_secrets_equal_regular_expressions():
    texts = [*drawn(SECRET_PARTS, 4000), "x" * 70_000 + " token=abcdefghij", "\n" * 3]
    found = secret_scan.find_spans(pa.array(texts, pa.large_string()))
    kinds = [rule.kind for rule in secret_scan.RULES]
    for text, spans in zip(texts, found, strict=True):
        base = sorted((start, k, end) for k, start, end in spans if k < len(secret_scan.BASE))
        assert [(kinds[k], a, b) for a, k, b in base] == plain.secrets(text), text


@pytest.mark.parametrize("few", [0, 3, 10**6])
def test_lanes_read_alone_or_together(monkeypatch, few):
    monkeypatch.setattr(secret_scan, "FEW_LANES", few)
    monkeypatch.setattr(secret_scan, "LONG_PIECE", 50)
    texts = drawn(SECRET_PARTS, 300, longest=60, seed=11)
    found = secret_scan.find_spans(pa.array(texts, pa.large_string()))
    kinds = [rule.kind for rule in secret_scan.RULES]
    for text, spans in zip(texts, found, strict=True):
        base = sorted((start, k, end) for k, start, end in spans if k < len(secret_scan.BASE))
        assert [(kinds[k], a, b) for a, k, b in base] == plain.secrets(text), text


def test_ten_megabytes_in_one_line():
    """Without a byte that leads back to the start, it is read as fast as a loop goes."""
    line = "Zm9vYmFy+/8=ab12" * 640_000
    text = f"{line} token = abcdefgh12 {'0123456789abcdef' * 4} {line}"
    began = time.process_time()
    (spans,) = secret_scan.find_spans(pa.array([text], pa.large_string()))
    assert time.process_time() - began < 20
    kinds = [rule.kind for rule in secret_scan.RULES]
    assert [(kinds[k], a, b) for k, a, b in sorted(spans, key=lambda s: (s[1], s[0]))] == plain.secrets(text)


def test_more_secret_shapes():
    text = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "Z" * 36 + " eyJhbGciOi.eyJzdWIiOiIx." + "s" * 30
    found = secret_scan.find_spans(pa.array([text, "ghp_short eyJ a.b"], pa.large_string()))
    kinds = [secret_scan.RULES[k].kind for k, _, _ in found[0]]
    assert sorted(kinds) == ["code_host", "private_key", "web_token"] and not found[1]


KEY_BODY = ["MIIEpAIBAAKCAQEA" + c * 48 for c in "bcdefg"] + ["Zm9vYmFy+/8="]
KEY_BEGIN, KEY_END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
KEY_NAMED = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,00FF", ""]


@pytest.mark.parametrize("end", [[KEY_END], []])
@pytest.mark.parametrize("named", [KEY_NAMED, []])
@pytest.mark.parametrize("line_end", ["\n", "\r\n", "\\n", "\\r\\n", "\\\\n", "\n    ", "\n> ", '\\n" +\n  "'])
def test_no_key_body_survives(line_end, named, end):
    key = line_end.join([KEY_BEGIN, *named, *KEY_BODY, *end])
    text = f"é before {key}\n\nAfter it, prose: a-b.\n{key}"
    spans = secret_scan.find_spans(pa.array([text, "x", text], pa.large_string()))
    for found in (spans[0], spans[2]):
        assert secret_scan.redact(text, found) == "é before [SECRET]\n\nAfter it, prose: a-b.\n[SECRET]"


def test_keys_in_one_line_or_without_a_body():
    one_line = " ".join([KEY_BEGIN, *KEY_BODY])
    texts = {
        f"{one_line} {KEY_END} prose": "[SECRET] prose",
        one_line: "[SECRET]",
        f"{KEY_BEGIN} starts a key, as is known.": "[SECRET] starts a key, as is known.",
        f"{KEY_BEGIN}\nNote: prose here.": "[SECRET]\nNote: prose here.",
        f"{KEY_BEGIN}\n{KEY_BODY[0]}\nThe key was cut.": "[SECRET]\nThe key was cut.",
        f"{KEY_BEGIN}\n{KEY_BODY[0]}\n{KEY_BEGIN}\n{KEY_BODY[1]}": "[SECRET]\n[SECRET]",
        KEY_BEGIN * 3: "[SECRET]" * 3,
    }
    found = secret_scan.find_spans(pa.array(list(texts), pa.large_string()))
    for (text, cleaned), spans in zip(texts.items(), found, strict=True):
        assert secret_scan.redact(text, spans) == cleaned


def test_redact_secrets_leaves_no_key_body(documents):
    key = "\n".join([KEY_BEGIN, *KEY_BODY, KEY_END])
    rows = secret_scan.redact_secrets(documents([(1, f"a\n{key}\nb"), (2, key)])).collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in rows} == {1: ("a\n[SECRET]\nb", 12), 2: ("[SECRET]", 8)}


def test_redaction_keeps_the_rest():
    text = "é password = abcdefgh12, fine"
    spans = secret_scan.find_spans(pa.array([text], pa.large_string()))[0]
    assert secret_scan.redact(text, spans) == "é [SECRET], fine"


def test_automaton_is_minimal_and_right():
    one = Automaton(["ab|cb|ab"], search=False)
    state = 0
    for byte in b"cb":
        state = one.table[state, one.byte_class[byte]]
    assert one.mask[state] == 1
    assert len(one.table) == 4  # start, one letter read, done, stuck
    with pytest.raises(ValueError):
        Automaton(["é"])


def test_private_spans_equal_regular_expressions():
    for text in drawn(PRIVATE_PARTS, 8000, seed=2):
        base = [s for s in pii.personal_spans(text) if s[0] in pii.BASE_KINDS]
        assert base == plain.private(text), text


def test_accounts_numbers_and_logins():
    text = "IBAN: DE89 3704 0044 0532 0130 00, SSN 123-45-6789, https://u:pw@host.example/x"
    assert [s[0] for s in pii.personal_spans(text)] == ["email", "iban", "ssn", "login"]
    assert not pii.personal_spans("IBAN DE88 3704 0044 0532 0130 00 ssn 000-45-6789")


@pytest.mark.parametrize(
    ("account", "behind"),
    [
        ("DE89 3704 0044 0532 0130 00", " BIC COBADEFF"),
        ("GB82 WEST 1234 5698 7654 32", " Please"),
        ("GB82WEST12345698765432", " 7 days, A"),
        ("NO93 8601 1117 947", " X"),
        ("MT84 MALT 0110 0001 2345 MTLC AST0 01S", " AND MORE CAPITALS"),
        ("ZZ65 1234 5678 9012", " END"),
        ("DE89 3704 0044 0532 0130 00", ""),
        ("DE89 3704 0044 0532 0130 00", "x"),
    ],
)
def test_accounts_with_words_behind(account, behind):
    expected = [("iban", 5, 5 + len(account))]
    assert [s for s in pii.personal_spans(f"IBAN {account}{behind}") if s[0] == "iban"] == expected


def test_accounts_end_with_a_group():
    assert not pii.personal_spans("IBAN DE88 3704 0044 0532 0130 00 BIC COBADEFF")
    assert not pii.personal_spans("IBAN GB82WEST12345698765432A B")
    # By chance a further group may be valid too; the country's length decides.
    further = next(f"{n:02}" for n in range(100) if pii.iban_valid(f"DE89370400440532013000{n:02}"))
    spans = pii.personal_spans(f"IBAN DE89 3704 0044 0532 0130 00 {further}")
    assert [s for s in spans if s[0] == "iban"] == [("iban", 5, 32)]


@pytest.mark.parametrize(
    ("operator", "brute", "kinds"),
    [
        (secret_scan.scan_secrets, plain.secrets, ("assign", "access", "hex")),
        (pii.find_personal_data, plain.private, ("email", "ip", "card", "phone")),
    ],
)
def test_tables(edges, empty, operator, brute, kinds):
    found = operator(edges)
    assert operator(empty).count() == 0
    expected = []
    for doc_id, text in TEXTS:
        spans = brute(text)
        per_kind = [sum(s[0] == kind for s in spans) for kind in kinds]
        expected.append((doc_id, *per_kind, plain.sha(plain.joined(spans)), plain.joined(spans)))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_redact_secrets_keeps_columns(edges, empty):
    cleaned = secret_scan.redact_secrets(edges)
    assert cleaned.columns == edges.columns and secret_scan.redact_secrets(empty).count() == 0
    texts = {row.doc_id: (row.text, row.n_chars) for row in cleaned.collect()}
    assert texts[7][0].endswith("and\n[SECRET]") and texts[7][1] == len(texts[7][0])
    assert texts[1] == (None, None) and texts[None][0] == "no identifier, [SECRET]"
