"""Plain versions of the operators, one document or pair at a time."""

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

PROSE = "the cat sat on the mat and looked at the moon while rain fell on old roofs"

#: Null, empty, blank, unusual white space, repeated rows, a missing identifier.
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, PROSE),
    (4, PROSE),
    (5, "one word \x1cand  another"),
    (6, "É" * 3000 + " " + "x" * 5000),
    (None, "no identifier, password = hunter2hunter2"),
    (7, "mail me@here.org or +1 (555) 010-9999 and\npassword: abcdefgh12"),
    (8, " ".join(f"w{i % 97}" for i in range(3000))),
]

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def without_repeats(rows, window=50):
    """Per row (doc_id, n_words, n_removed, kept words' digest)."""
    first = {}
    for doc_id, text in rows:
        own = words(text)
        for k in range(len(own) - window + 1):
            if doc_id is not None:
                name = tuple(own[k : k + window])
                first[name] = min(first.get(name, doc_id), doc_id)
    result = []
    for doc_id, text in rows:
        own = words(text)
        gone = set()
        for k in range(len(own) - window + 1):
            if doc_id is not None and first[tuple(own[k : k + window])] < doc_id:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        result.append((doc_id, len(own), len(gone), sha(kept)))
    return result


SECRETS = [
    (
        "assign",
        re.compile(
            r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        ),
        lambda m: len(m[1]) >= 8,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def secrets(text):
    """Base spans (kind, start, end) by start, then kind."""
    found = []
    for k, (kind, pattern, fits) in enumerate(SECRETS):
        found += [(m.start(), k, kind, m.end()) for m in pattern.finditer(text or "") if fits(m)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text):
    return re.sub("[^0-9]", "", text)


PRIVATE = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda s: True),
    (
        "ip",
        re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        lambda s: all(int(p) <= 255 for p in s.split(".")),
    ),
    (
        "card",
        re.compile(r"[0-9]([\x20-]?[0-9])+"),
        lambda s: 13 <= len(_digits(s)) <= 19 and _luhn(_digits(s)),
    ),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s: 9 <= len(_digits(s)) <= 15),
]


def private(text):
    """Base spans (kind, start, end) by kind, then start."""
    return [
        (kind, m.start(), m.end())
        for kind, pattern, fits in PRIVATE
        for m in pattern.finditer(text or "")
        if fits(m[0])
    ]


def joined(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def classes(rows, size=5):
    """Smallest linked document per document, all pairs compared."""
    above = {}

    def root(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    sets = []
    for doc_id, text in rows:
        own = tuple(words(text))
        if doc_id is None:
            continue
        root(doc_id)
        if own:
            grams = {own[k : k + size] for k in range(max(1, len(own) - size + 1))}
            sets.append((doc_id, own, grams))
    holders = defaultdict(list)
    for at, (doc_id, own, grams) in enumerate(sets):
        shared = Counter(other for gram in grams for other in holders[gram])
        for other, common in shared.items():
            partner, partner_words, partner_grams = sets[other]
            union = len(grams) + len(partner_grams) - common
            if own == partner_words or 10 * common >= 8 * union:
                a, b = root(doc_id), root(partner)
                above[max(a, b)] = min(a, b)
        for gram in grams:
            holders[gram].append(at)
    return {doc_id: root(doc_id) for doc_id, _ in rows if doc_id is not None}


def counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    own = words(text)
    grams = Counter(zip(own, own[1:], own[2:], strict=False))
    covered = set()
    for k in range(len(own) - 2):
        if grams[tuple(own[k : k + 3])] > 1:
            covered.update(range(k, k + 3))
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(own),
        sum(map(len, own)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def variants(rows, least_length=6, least_count=5, times=5, damaged=199):
    """Per word (form, root, n, n_near, form_n), all pairs of words compared."""
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damaged == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                count[run] += 1
    count = {word: n for word, n in count.items() if n >= least_count}
    near = {word: [w for w in count if one_edit(word, w)] for word in count}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda w: (-count[w], w), default=None)
        form[word] = best if best is not None and count[best] >= times * count[word] else None
    result = {}
    for word, n in count.items():
        root = word
        while form[root] is not None:
            root = form[root]
        result[word] = (form[word], root, n, len(near[word]), count.get(form[word]))
    return result


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def damaged_turns(rows):
    """The rows (turn, role, text) of one conversation after the damage, in order."""
    found = []
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        found += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    digest = lambda text: hashlib.sha256(text.encode()).digest()
    return sorted(found, key=lambda r: (r[0] is not None, r[0], r[1].encode(), digest(r[2])))


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation.

    Edits are tried in order of cost, then of the audit, until one gives the form.
    """
    rows = damaged_turns(rows)
    faults, seen = [], set()
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        if not last:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append(None if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            break
        place = (at, "s" in roles and len(roles) == 1, roles[-1:])
        if place in done:
            continue
        done.add(place)
        options = [("I", INSERTED, 0, role, "") for role in ("user", "assistant")]
        if at < len(rows):
            _, role, text = rows[at]
            if faults[at] in ("blank", "duplicate"):
                options.append(("D", 4, 1, "", ""))
            else:
                extra = 3 * (faults[at] == "truncated")
                options += [("D", 4, 1, "", ""), ("K", extra, 1, role, text)]
                options += [("R", 3 + extra, 1, to, text) for to in ("user", "assistant")]
        for edit, price, step, role, text in options:
            longer = roles if edit == "D" else roles + (role[:1] or "-")
            if re.fullmatch("s?(ua)*u?", longer):
                line = () if edit == "D" else (f"{role}:{text}",)
                heapq.heappush(heap, (cost + price, audit + edit, at + step, longer, lines + line))
    count = Counter(faults)
    numbers = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal)
    return (*numbers, cost, audit, sha("\n".join(lines)))


INSERTED = 3


def quality_features(text):
    """The ranking's features of one text, in its order."""
    own = text.split()
    if not own:
        return [0.0] * 13
    n = len(own)
    chars = sum(c not in " \t\n\x0b\x0c\r" for c in text)
    count = lambda letters: sum(c in letters for c in text)
    lines = [line for line in text.split("\n") if line.strip()]
    raw = text.encode()
    return [
        math.log(1 + n),
        chars / n,
        count("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / max(chars, 1),
        count("0123456789") / max(chars, 1),
        count("#*$%&<>~^=+\\@_{}[]") / n,
        count("|") / n,
        count(",;:\"'()-") / n,
        count(".!?") / n,
        len(lines) / n,
        len(set(own)) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        len(zlib.compress(raw, 1)) / len(raw),
        math.log(1 + max(len(w) for w in own)),
    ]


def pairwise_weights(differences, penalty, steps=20_000):
    """Weights of least logistic loss on feature differences, by plain gradient steps."""
    differences = np.asarray(differences, dtype=float)
    weights = np.zeros(differences.shape[1])
    rate = 1 / (penalty + np.linalg.norm(differences, 2) ** 2 / 4)
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-(differences @ weights)))
        weights += rate * (differences.T @ (1 - chance) - penalty * weights)
    return weights


def covering(rows, cuts, most_rules, most_conditions, least_cover, least_precision):
    """Rules by sequential covering; rows are (statistics, bad, whether to prune by it)."""

    def holds(rule, row):
        return all(row[0][n] <= t if op == "<=" else row[0][n] > t for n, op, t in rule)

    rules = []
    while len(rules) < most_rules:
        rows = [row for row in rows if not (rules and holds(rules[-1], row))]
        growing = [row for row in rows if not row[2]]
        pruning = [row for row in rows if row[2]]
        rule = ()
        while len(rule) < most_conditions:
            inside = [row for row in growing if holds(rule, row)]
            bad, n, best = sum(row[1] for row in inside), len(inside), None
            for name in cuts:
                for cut in cuts[name]:
                    for op in ("<=", ">"):
                        left = [row[1] for row in inside if holds(((name, op, cut),), row)]
                        p, m = sum(left), len(left)
                        if 0 < p and m < n:
                            gain = p * (math.log2(p / m) - math.log2(bad / n))
                            if best is None or gain > best[0] + 1e-9:
                                best = (gain, (name, op, cut))
            if best is None or best[0] <= 1e-9 or best[1] in rule:
                break
            rule = (*rule, best[1])
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            own = [row[1] for row in pruning if holds(rule[:k], row)]
            worth.append((round((2 * sum(own) - len(own)) / len(own), 6) if own else -1.0, sum(own), len(own)))
        length = max(range(len(rule)), key=lambda k: (worth[k][0], -k)) + 1
        _, bad, n = worth[length - 1]
        if n < least_cover or bad < least_precision * n:
            break
        rules.append(rule[:length])
    return rules
