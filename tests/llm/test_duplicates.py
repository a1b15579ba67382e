"""Substring removal and near-duplicate classes against brute force."""

import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from given import documents, edges, empty, stays  # noqa: F401
from plain import TEXTS

from aerometry.llm import documents as document_helpers
from aerometry.llm import minhash, substring_dedup
from aerometry.llm.recompression import Windows, anchors

WINDOW = substring_dedup.WINDOW


def prose(rng, n, letters=400):
    return [f"w{rng.randrange(letters)}" for _ in range(n)]


def planted(rng):
    """Copies, near copies, shared passages, runs and periodic passages."""
    texts = []
    passage, periodic = prose(rng, 70), prose(rng, 3) * 40
    for i in range(60):
        own = prose(rng, rng.randint(5, 200))
        kind = i % 6
        if kind == 0 and texts:
            own = list(rng.choice(texts))
        elif kind == 1:
            at = rng.randint(0, len(own))
            own = own[:at] + passage[rng.randint(0, 5) :] + own[at:]
        elif kind == 2:
            own = own + periodic[rng.randint(0, 4) : rng.randint(60, 110)] + prose(rng, 5)
        elif kind == 3 and texts:
            own = list(rng.choice(texts))
            own[rng.randrange(len(own))] = "edited"
        elif kind == 4:
            own = ["the"] * rng.randint(45, 90) + own
        texts.append(own)
    spaces = [" ", "\n", "\t ", "  "]
    return [(i, rng.choice(spaces).join(t)) for i, t in enumerate(texts)]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(5)
    for _ in range(400):
        letters = rng.choice([1, 2, 3, 5, 50])
        if rng.random() < 0.3:
            shared = (prose(rng, rng.randint(1, 6), letters) * 60)[: rng.randint(50, 70)]
        else:
            shared = prose(rng, rng.randint(50, 70), letters)
        texts = [
            prose(rng, rng.randint(0, 60), letters) + shared + prose(rng, rng.randint(0, 60), letters)
            for _ in range(2)
        ]
        batch = pa.array([" ".join(t) for t in texts], pa.large_string())
        names, before = substring_dedup._words(batch)
        starts, found = anchors(names, before, WINDOW)
        assert len(starts) == sum(len(t) - WINDOW + 1 for t in texts)
        assert (found != np.iinfo(np.uint64).max).all()
        by_window = {}
        for window, anchor in zip(Windows(names).named(starts, WINDOW), found, strict=True):
            by_window.setdefault(int(window), set()).add(int(anchor))
        assert all(len(own) == 1 for own in by_window.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(documents, seed):
    texts = [*planted(random.Random(seed)), (3, "short row of a repeated identifier"), *TEXTS[-1:]]
    texts += [(i, t) for i, t in TEXTS if i is None or i < 4]
    found = substring_dedup.substring_dedup(documents(texts)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain.without_repeats(texts), key=repr)


def test_substring_dedup_edges(edges, empty):
    assert substring_dedup.substring_dedup(empty).count() == 0
    found = substring_dedup.substring_dedup(edges).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain.without_repeats(TEXTS), key=repr)


def test_remove_repeats_keeps_rows_and_columns(documents, edges, empty):
    assert substring_dedup.remove_repeats(empty).columns == empty.columns
    same = substring_dedup.remove_repeats(edges)
    assert same.columns == edges.columns
    assert sorted(map(repr, same.collect())) == sorted(map(repr, edges.collect()))
    texts = planted(random.Random(3))
    left = {r.doc_id: r for r in substring_dedup.remove_repeats(documents(texts)).collect()}
    for doc_id, n, removed, digest in plain.without_repeats(texts):
        own = plain.words(left[doc_id].text)
        assert (n - removed, plain.sha(" ".join(own))) == (len(own), digest)
        assert left[doc_id].n_chars == len(left[doc_id].text)


def test_rows_that_repeat_thousands_of_times(documents, base):
    """One row, two thousand times, and a smaller document that shares a passage with it."""
    rng = random.Random(12)
    shared, own, other = prose(rng, 80), prose(rng, 120), prose(rng, 60)
    row = (9, " ".join([*own, *shared]))
    texts = [(2, " ".join([*shared, *other])), *[row] * 2000, (9, " ".join([*shared, *own]))]
    docs = documents(texts)
    substring_dedup.substring_dedup(docs).write.parquet(f"{base}/counts")
    found = docs.sparkSession.read.parquet(f"{base}/counts")
    expected = plain.without_repeats(texts)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    substring_dedup.remove_repeats(docs).write.parquet(f"{base}/left")
    left = docs.sparkSession.read.parquet(f"{base}/left").collect()
    digests = sorted((r.doc_id, plain.sha(" ".join(plain.words(r.text)))) for r in left)
    assert digests == sorted((i, digest) for i, _, _, digest in expected)


def test_repeats_leave_a_task_once(monkeypatch):
    monkeypatch.setattr(document_helpers, "RECENT_KEYS", 3)
    rows = [1, 1, 2, 1, 3, 3, 4, 1, 1, None, None]
    batches = [pa.record_batch([pa.array(rows[a : a + 3], pa.int64())], names=["k"]) for a in range(0, 11, 3)]
    left = [k for b in document_helpers.without_repeats(iter(batches), 0) for k in b.column(0).to_pylist()]
    assert set(left) == set(rows) and len(left) <= 8


def test_what_stands_before_a_removed_passage_stays():
    text = b"a\n" + b" ".join(b"x%d" % i for i in range(50)) + b" \n b"
    removed, words, left = substring_dedup._without(text, np.array([1]), np.array([1]))
    assert (removed, words, left) == (50, b"a b", b"a\nb")


def families(rng, chunk):
    """Families of near copies, one larger than a chunk, with chains of links."""
    texts, doc_id = [], 0
    for size in (2, 3, 5, 3 * chunk):
        base = prose(rng, 120)
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(30)}"
            texts.append((doc_id, " ".join(own)))
            doc_id += 1
        chain = list(base)
        for step in range(6):
            chain[step * 17 % len(chain)] = f"c{step}"
            texts.append((doc_id, "\n".join(chain)))
            doc_id += 1
    texts += [(doc_id + i, " ".join(prose(rng, n))) for i, n in enumerate((1, 3, 4, 5, 6, 900))]
    texts += [(5000 + i, t) for i, t in enumerate(("three little words", "three  little words"))]
    return texts


@pytest.mark.parametrize(("chunk", "block"), [(400, 2000), (12, 2000), (12, 7)])
def test_classes(documents, monkeypatch, chunk, block):
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    monkeypatch.setattr(minhash, "SKETCH_BLOCK", block)
    texts = families(random.Random(8), 12)
    random.Random(1).shuffle(texts)
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(documents(texts)).collect()}
    assert found == plain.classes(texts)


def repeating(rng, pairs, times):
    """Pairs of texts that share all but 8 of 98 shingles; one of each repeats a line."""
    texts = []
    for i in range(pairs):
        shared = [f"p{i}w{rng.randrange(10**9)}" for _ in range(64)]
        line = [f"p{i}l{k}" for k in range(30)]
        texts.append((2 * i, " ".join(shared) + "\n" + " ".join(line * times + line[:4])))
        texts.append((2 * i + 1, " ".join(shared) + "\n" + " ".join(line + line[:4] + ["x", "y"])))
    return texts


def test_counts_that_differ_fifty_fold(documents):
    """By the weighted bands alone, some 12 of 100 such pairs are never compared."""
    texts = repeating(random.Random(4), 100, 50)
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(documents(texts)).collect()}
    expected = plain.classes(texts)
    assert found == expected and all(i - c == i % 2 for i, c in expected.items())


def test_links_lead_through_each_class(documents, monkeypatch):
    """A link named is one: its similarity is that of the two texts, and 0.8 or more."""
    monkeypatch.setattr(minhash, "CHUNK", 12)
    texts = [*families(random.Random(3), 12), (7000, "a b"), (7001, "a  b"), (7001, "a  b"), (7002, None)]
    rows = minhash.near_duplicates(documents(texts), with_links=True).collect()
    sets = {}
    for doc_id, text in texts:
        own = plain.words(text)
        sets[doc_id] = {tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))} if own else set()
    expected = plain.classes(texts)
    size = plain.Counter(expected.values())
    for r in rows:
        assert r.class_id == expected[r.doc_id]
        assert (r.linked_to is None) == (size[r.class_id] == 1) == (r.similarity is None)
        if r.linked_to is not None:
            one, two = sets[r.doc_id], sets[r.linked_to]
            assert r.linked_to != r.doc_id and expected[r.linked_to] == r.class_id
            assert r.similarity == pytest.approx(len(one & two) / len(one | two), abs=1e-6) and r.similarity >= 0.8


def test_repeated_rows_stay_within_chunks(documents, monkeypatch):
    """Copies of a row, and one document of many texts, fill no chunk beyond its bounds."""
    monkeypatch.setattr(minhash, "CHUNK", 10)
    base = prose(random.Random(6), 60)
    variants = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]) for k in range(60)]
    texts = [(1, " ".join(base)), *[(2, variants[0])] * 3000, *[(3, v) for v in variants]]
    found = minhash.near_duplicates(documents(texts)).collect()
    assert len(found) == len(texts) and {r.class_id for r in found} == {1}

    docs = minhash.texts_of(documents([*texts[:1], *texts[3000:]]))
    packed = [b for b in minhash._pack(iter(docs.toArrow().to_batches()))]
    assert sum(b.num_rows for b in packed) == 62


def test_a_template_without_links_moves_no_texts(documents, spark, monkeypatch):
    """Texts of similarity 0.6 are candidates and meet as sketches; hardly any meets again as text."""
    monkeypatch.setattr(minhash, "CHUNK", 40)
    rng = random.Random(21)
    body = prose(rng, 80)
    texts = [(i, " ".join([*body, *[f"own{i}w{k}" for k in range(24)]])) for i in range(400)]
    moved = []
    linked = minhash._linked

    def counted(cells, packed):
        moved.append(cells.count())
        return linked(cells, packed)

    monkeypatch.setattr(minhash, "_linked", counted)
    found = minhash.near_duplicates(documents(texts)).collect()
    assert all(r.class_id == r.doc_id for r in found)
    assert len(moved) == 2 and moved[0] >= 400 and moved[1] <= 20


def test_tables_go_when_links_are_found(documents, stays, monkeypatch):
    """The result is read from four tables, however many passes and rounds there were."""
    monkeypatch.setattr(minhash, "CHUNK", 12)
    texts = families(random.Random(3), 12)
    found, left = stays(lambda: minhash.near_duplicates(documents(texts), with_links=True))
    assert left == {"signed": 1, "firsts": 1, "links": 2, "edges": 1}
    assert {r.doc_id: r.class_id for r in found.collect()} == plain.classes(texts)


def test_sets_are_compared_with_themselves_once():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, 50)).astype(np.uint64) for _ in range(12)]
    for left, right in ((sets, None), (sets[:5], sets[5:])):
        rows, columns, how = minhash._similar(left, right)
        expected = {}
        for a, one in enumerate(left):
            for b, two in enumerate(left if right is None else right):
                if right is not None or a < b:
                    similarity = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
                    if similarity >= 0.8 - 1e-12:
                        expected[a, b] = pytest.approx(similarity)
        assert dict(zip(zip(rows.tolist(), columns.tolist()), how.tolist(), strict=True)) == expected


def test_texts_without_repeats_have_no_further_bands():
    names = np.arange(1, 41, dtype=np.uint64)
    text, counts = np.repeat([0, 2, 3], 40), np.repeat([1, 1, 50], 40)
    counts[-20:] = 1
    keys, bounds = minhash.text_bands(text, np.tile(names, 3), counts, 5)
    first, none, same, further, last = (set(keys[a:b].tolist()) for a, b in zip(bounds, bounds[1:]))
    assert len(first) == minhash.BANDS and first == same and not none and not last
    assert first < further and minhash.BANDS < len(further) <= 2 * minhash.BANDS


def test_class_edges(edges, empty):
    assert minhash.near_duplicates(empty).count() == 0
    found = sorted((repr(tuple(r)) for r in minhash.near_duplicates(edges).collect()))
    assert found == sorted(repr((i, i)) for i, _ in TEXTS)


def test_one_of_each_keeps_rows_and_columns(documents, edges):
    kept = minhash.one_of_each(edges)
    assert kept.columns == edges.columns and kept.count() == len(TEXTS)
    texts = families(random.Random(8), 4)
    expected = {i for i, c in plain.classes(texts).items() if i == c}
    assert {r.doc_id for r in minhash.one_of_each(documents(texts)).collect()} == expected


def test_registers_agree_with_probability_jaccard():
    """Over many registers, agreement is near the similarity of the weights."""
    rng = np.random.default_rng(2)
    agreed = []
    for _ in range(40):
        names = rng.integers(1, 1 << 62, 60, dtype=np.uint64)
        counts = rng.integers(1, 5, 60)
        left, right = np.arange(0, 48), np.arange(12, 60)
        text = np.repeat([0, 1], 48)
        both = np.concatenate([left, right])
        signed = minhash.signatures(text, names[both], counts[both], 2)
        assert (signed != 0).all()
        weights = 1 + np.log(counts)
        x, y = np.zeros(60), np.zeros(60)
        x[left], y[right] = weights[left], weights[right]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratios = np.fmax(x[None, :] / x[:, None], y[None, :] / y[:, None]).sum(axis=1)
        similarity = (1 / ratios[(x > 0) & (y > 0)]).sum()
        agreed.append((signed[0] == signed[1]).mean() - similarity)
    assert abs(np.mean(agreed)) < 0.02
