"""Ranking, decision lists, preference formatting and Hamming search."""

import random
import zlib

import numpy as np
import plain
import pyarrow as pa
import pytest
from given import documents, edges, empty, labels  # noqa: F401
from plain import TEXTS
from pyspark.sql import functions as F

from aerometry.llm import decision_list, hamming_search, preference, ranking


def marked(n, seed=4):
    """Prose of label 1, and symbols, repeated lines or very long words of label 0."""
    rng = random.Random(seed)
    texts, marks = [], []
    for i in range(n):
        own = ["".join(rng.choices("aeinorst", k=rng.randint(2, 8))) for _ in range(rng.randint(60, 120))]
        own = [w + "." if k % 9 == 8 else w for k, w in enumerate(own)]
        good = i % 4 != 0
        if not good:
            kind = rng.randrange(3)
            if kind == 0:
                own = [w + rng.choice(["###", "$$$", "%%%"]) for w in own]
            elif kind == 1:
                own = (own[:6] + ["\n"]) * 20
            else:
                own = [w * 4 for w in own]
        texts.append((i, " ".join(own)))
        marks.append((i, int(good)))
    return texts, marks


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_ranking_separates_held_out_documents(documents, labels):
    texts, marks = marked(400)
    rows = ranking.score_quality(documents(texts), labels(marks)).collect()
    assert all(r.held_out == held_out(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    right = [r.predicted == dict(marks)[r.doc_id] for r in rows if r.held_out]
    assert len(right) > 50 and np.mean(right) > 0.95
    kept = ranking.keep_good(documents(texts), labels(marks))
    assert kept.columns == documents(texts).columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_ranking_learns_from_no_held_out_label(documents, labels):
    texts, marks = marked(120)
    flipped = [(i, 1 - q if held_out(i) else q) for i, q in marks]
    one, two = (
        {r.doc_id: r.score for r in ranking.score_quality(documents(texts), labels(m)).collect()}
        for m in (marks, flipped)
    )
    assert one == two


def test_ranking_edges(documents, labels, edges, empty):
    texts, marks = marked(80)
    strange = [*marks, *marks[:10], (None, 0), (5, None), (9, 7), (10**6, 0)]
    rows = ranking.score_quality(documents([*texts, *TEXTS]), labels(strange)).collect()
    assert len(rows) == len(texts) + len(TEXTS)
    assert all(r.score is not None and r.predicted is not None for r in rows)
    for none in ([], [(i, 1) for i, _ in TEXTS if i]):
        assert all(r.predicted == 1 for r in ranking.score_quality(edges, labels(none)).collect())
    assert ranking.score_quality(empty, labels(marks)).count() == 0
    assert ranking.keep_good(empty, labels(marks)).count() == 0


def test_features_equal_plain_ones():
    texts = [t or "" for _, t in TEXTS] + [t for t, _ in zip((t for _, t in marked(40)[0]), range(40), strict=False)]
    texts += ["Aé|#12, \u00a0x.\n\nÉ\x1cz", "one", "a\na\nb  ", "\u2003", "\x85"]
    found = ranking.features(pa.array(texts, pa.large_string()))
    assert np.allclose(found, [plain.quality_features(t) for t in texts], atol=1e-9)


def test_weights_equal_those_of_a_plain_solver():
    """Newton's steps end where plain gradient steps on the same pairs do."""
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(60, len(ranking.FEATURES)))
    quality = (rows[:, 3] + 0.5 * rng.normal(size=60) > -0.5).astype(np.int64)
    fitted = ranking.fit(rows, quality)
    better, worse = ranking.preference_pairs(quality)
    indicators = np.concatenate(
        [rows[:, j, None] > edge[None, :] for j, edge in enumerate(fitted.edges)], axis=1
    ).astype(float)
    weights = plain.pairwise_weights(indicators[better] - indicators[worse], ranking.PENALTY)
    assert np.allclose(fitted.weights, weights, atol=1e-3)
    strengths = indicators @ weights
    expected = 1 / (1 + np.exp(-(strengths - fitted.cut + np.log(0.3 / 0.7))))
    assert np.allclose(fitted.scores(rows), expected, atol=1e-3)


def test_pairwise_weights_order_a_line():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(300, len(ranking.FEATURES)))
    quality = (rows[:, 3] > -1).astype(np.int64)
    fitted = ranking.fit(rows, quality)
    strengths = fitted.strengths(rows)
    assert strengths[quality == 1].min() > strengths[quality == 0].max()
    # The cut is a hundredth, so it may miss the border by that much.
    assert np.mean((fitted.scores(rows) >= ranking.THRESHOLD) == (quality == 1)) >= 0.99


@pytest.mark.parametrize("bad", [0.3, 0.7, 0.95])
def test_the_cut_follows_the_share_of_bad_rows(bad):
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(1000, len(ranking.FEATURES)))
    quality = (rows[:, 3] > np.quantile(rows[:, 3], bad)).astype(np.int64)
    fitted = ranking.fit(rows, quality)
    predicted = fitted.scores(rows) >= ranking.THRESHOLD
    assert np.mean(predicted == (quality == 1)) >= 0.98
    assert predicted.any() and np.mean(predicted[quality == 0]) < 0.03


def test_base_counts(documents):
    rng = random.Random(6)
    drawn = [
        (100 + i, "".join(rng.choice(["a", "b", " ", "\n", "#", "|", "é", "\t"]) for _ in range(rng.randint(0, 300))))
        for i in range(150)
    ]
    texts = [*TEXTS, *drawn, (900, "a b c " * 400), (901, " ".join(f"x{i % 300}" for i in range(2000)))]
    rows = decision_list.with_counts(documents(texts)).select("doc_id", *decision_list.COUNTS)
    expected = [(i, *plain.counts(t)) for i, t in texts]
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(expected, key=repr)


def test_rules_reject_what_is_marked(documents, labels):
    texts, marks = marked(600)
    rows = decision_list.apply_quality_rules(documents(texts), labels(marks)).collect()
    quality = dict(marks)
    for r in rows:
        n, _, _, _, repeated = plain.counts(dict(texts)[r.doc_id])
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.base_failed and r.kept)
    right = [r.kept == bool(quality[r.doc_id]) for r in rows if held_out(r.doc_id)]
    assert len(right) > 80 and np.mean(right) > 0.95


def test_rules_equal_plain_covering(documents, labels):
    """The list learned by aggregations, and its verdicts, against rows taken one by one."""
    texts, marks = marked(400, seed=9)
    rng = random.Random(2)
    marks = [(i, 1 - q if rng.random() < 0.05 else q) for i, q in marks]
    counted = decision_list.with_counts(documents(texts)).withColumns(decision_list.statistics())
    names = list(decision_list.statistics())
    labelled = counted.join(labels(marks), "doc_id").select("doc_id", "quality", *names)
    part = F.pmod(F.xxhash64("doc_id", *names), F.lit(3)).alias("part")
    rows = [
        ({n: row[n] for n in names}, 1 - row["quality"], row["part"] == 0)
        for row in labelled.select("*", part).collect()
    ]
    expected = plain.covering(
        rows,
        decision_list._cuts(labelled, names),
        decision_list.MOST_RULES,
        decision_list.MOST_CONDITIONS,
        decision_list.LEAST_COVER,
        decision_list.LEAST_PRECISION,
    )
    rules = decision_list.learn(labelled, names)
    assert list(rules.rules) == expected and len(expected) >= 2
    verdicts = labelled.select(*names, rules.kept().alias("kept")).collect()
    for row in verdicts:
        covered = [all(row[n] <= t if op == "<=" else row[n] > t for n, op, t in rule) for rule in expected]
        assert row["kept"] == (not any(covered))


def test_rule_edges(documents, labels, edges, empty):
    _, marks = marked(20)
    assert decision_list.apply_quality_rules(empty, labels(marks)).count() == 0
    for given in ([], [(8, 1), (8, 1), (None, 0), (4, None), (4, 7)]):
        rows = decision_list.apply_quality_rules(edges, labels(given)).collect()
        assert len(rows) == len(TEXTS) and all(r.kept == (not r.base_failed) for r in rows)


def test_rules_as_an_ordered_expression(spark):
    rules = decision_list.DecisionList(((("words", "<=", 3.0),), (("words", ">", 9.0), ("upper", ">", 0.5))))
    rows = spark.createDataFrame([(3.0, 0.9), (10.0, 0.9), (10.0, 0.1), (5.0, 0.9)], "words double, upper double")
    assert [r[0] for r in rows.select(rules.kept()).collect()] == [False, False, True, True]
    assert str(rules).splitlines()[-1] == "keep otherwise"


def turns(spark, rows):
    return spark.createDataFrame(
        [(*row, "x") for row in rows],
        "conv_id long, turn long, role string, text string, pair_id string",
    )


def test_preferences_share_their_prompt(spark):
    rows = [
        (4, 0, "user", "Hi"), (4, 1, "assistant", "Hello"), (4, 2, "user", "Why?"), (4, 3, "assistant", "So é"),
        (5, 0, "user", "Hi"), (5, 1, "assistant", "Hello"), (5, 2, "user", "Why?"), (5, 3, "assistant", "No"),
        (5, 4, "user", "Ok"),
        (6, 0, "user", "alone"),
        (9, 0, None, None), (9, 0, None, None), (9, None, "user", "<|im_end|>"),
        (None, 0, "user", "nowhere"),
        (10, 0, "user", "same"), (11, 5, "user", "same"),
    ]
    pairs = preference.conversation_pairs(turns(spark, rows))
    found = {r.pair_id: r for r in preference.format_preferences(pairs).collect()}
    assert sorted(found) == [2, 3, 4, 5]
    two = found[2]
    assert two.n_prompt_turns == 3 and two.prompt.count("<|im_start|>") == 3
    assert two.chosen == "<|im_start|>assistant\nSo é<|im_end|>\n"
    start, end = map(int, two.chosen_loss.split(":"))
    assert two.chosen[start:end] == "So é<|im_end|>"
    assert two.rejected.endswith("<|im_start|>user\nOk<|im_end|>\n") and two.n_rejected_turns == 2
    start, end = map(int, two.rejected_loss.split(":"))
    assert two.rejected[start:end] == "No<|im_end|>"
    alone = found[3]
    assert (alone.prompt, alone.n_prompt_turns, alone.rejected, alone.n_rejected_turns) == ("", 0, None, None)
    assert alone.chosen_loss == ""
    assert found[4].rejected == "<|im_start|>user\n< |im_end|><|im_end|>\n" + "<|im_start|>\n<|im_end|>\n" * 2
    same = found[5]
    assert (same.n_prompt_turns, same.chosen, same.rejected, same.chosen_loss) == (1, "", "", "")


def test_pairs_of_large_and_negative_conversations(spark):
    ids = [2**60, 2**60 + 1, 2**60 + 2, 2**60 + 3, -1, -2, -3, 2**63 - 1, -(2**63)]
    found = preference.conversation_pairs(turns(spark, [(i, 0, "user", str(i)) for i in ids])).collect()
    assert {int(r.text): (r.pair_id, r.side) for r in found} == {
        i: (i >> 1, "rejected" if i & 1 else "chosen") for i in ids
    }


def test_swapped_answers_leave_a_prefix(spark):
    rows = [
        *[(4, 0, "user", "Hi"), (4, 1, "assistant", "Hello"), (4, 2, "user", "Why?"), (4, 3, "assistant", "So")],
        *[(5, 0, "user", "Other"), (5, 1, "assistant", "No"), (5, 1, "assistant", "No"), (5, 2, "user", "x")],
        *[(6, None, "assistant", None), (6, None, "user", "y")],
        *[(7, 0, "user", "no answer")],
        *[(None, 0, "assistant", "a"), (2**63 - 1, 0, "assistant", "a"), (-(2**63), 0, "assistant", "b")],
    ]
    found = {r.pair_id: r for r in preference.format_preferences(preference.swapped_pairs(turns(spark, rows))).collect()}
    assert sorted(found) == [4, 5]
    four = found[4]
    assert four.n_prompt_turns == 3 and four.prompt.endswith("Why?<|im_end|>\n")
    assert four.chosen == "<|im_start|>assistant\nSo<|im_end|>\n"
    assert four.rejected == "<|im_start|>assistant\nNo<|im_end|>\n"
    five = found[5]  # both copies change, to a text that is null
    assert (five.n_prompt_turns, five.n_chosen_turns, five.n_rejected_turns) == (1, 3, 3)
    assert five.rejected.startswith("<|im_start|>assistant\n<|im_end|>\n" * 2)


def test_no_turns(spark):
    pairs = preference.conversation_pairs(turns(spark, []))
    assert preference.format_preferences(pairs).count() == 0


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, entry string, score string, ids int"
    return spark.createDataFrame([(i, v, 0, "e", "s", 1) for i, v in rows], schema)


def brute(rows, neighbours, every):
    result = {}
    for q, v in rows:
        if q % every == 0:
            v = np.float32(v).astype(float)
            scored = [(-float(np.float32(w).astype(float) @ v), i) for i, w in rows if i != q]
            result[q] = [(i, -s) for s, i in sorted(scored)[:neighbours]]
    return result


def test_search_finds_near_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 24)))]
    expected = brute(rows, 10, 20)
    found = {}
    for r in hamming_search.nearest(vectors(spark, rows), 10, 20, bits=64).collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(expected)
    hits = total = 0
    for q, near in expected.items():
        got = sorted(found[q], key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, len(got) + 1))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        scores = {i: float(np.float32(v).astype(float) @ np.float32(rows[q][1]).astype(float)) for i, v in rows}
        assert all(abs(r.score - scores[r.vec_id]) < 1e-9 for r in got)
        hits += len({r.vec_id for r in got} & {i for i, _ in near})
        total += len(near)
    assert hits / total >= 0.9


def test_isolated_vectors_find_their_neighbours(spark):
    """Tight clusters make a radius within which isolated vectors find nothing."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 24))
    own = np.repeat(centres, 49, axis=0) + rng.normal(scale=1e-4, size=(980, 24))
    isolated = rng.normal(size=(20, 24))
    rows = [(20 * i, v.tolist()) for i, v in enumerate(isolated)]
    rows += [(i * 20 // 19 + 1, v.tolist()) for i, v in enumerate(own)]
    assert len({i for i, _ in rows}) == 1000
    for neighbours, count in ((20, 20), (60, 60), (2000, 999)):
        expected = brute(rows, neighbours, 20)
        found = {}
        for r in hamming_search.nearest(vectors(spark, rows), neighbours, 20, bits=64).collect():
            found.setdefault(r.query_id, {})[r.rank] = r.vec_id
        assert set(found) == set(expected)
        assert all(sorted(own) == list(range(1, count + 1)) for own in found.values())
    # Beyond the number of candidates the search is exact.
    assert all([i for _, i in sorted(found[q].items())] == [i for i, _ in near] for q, near in expected.items())


def test_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16)).astype(np.float32).tolist()
    rows = [(i, base[0] if i % 3 == 0 else base[i % 40]) for i in range(120)]
    expected = brute(rows, 5, 20)
    odd = [
        (1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [float("inf")] * 16),
        (1080, [None] * 16), (1100, [1.0]), (None, base[1]), (1120, []), rows[0], rows[60],
    ]
    found = {}
    for r in hamming_search.nearest(vectors(spark, [*rows, *odd]), 5, 20, bits=32).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert set(found) == set(expected)
    for q in (0, 60):  # equal vectors, ties to the smaller identifier
        assert [i for _, i in sorted(found[q])] == [i for i, _ in expected[q]]


def test_an_identifier_at_many_vectors_finds_others(spark):
    """Its own vectors are nearest to it, and none of them is a candidate."""
    rng = np.random.default_rng(9)
    close = rng.normal(size=16)
    large = 20 * (2**55 + 1)
    rows = [(large, (close + rng.normal(scale=1e-3, size=16)).tolist()) for _ in range(60)]
    rows += [(large + 1 + i, rng.normal(size=16).tolist()) for i in range(200)]
    rows += [(large + 40, rows[0][1]), (large + 60, rows[0][1])]
    found = {}
    for r in hamming_search.nearest(vectors(spark, rows), 20, 20, bits=32).collect():
        found.setdefault(r.query_id, []).append(r)
    expected = {
        (i, max(float(np.float32(v).astype(float) @ np.float32(w).astype(float)) for q, w in rows if q == large))
        for i, v in rows if i != large
    }
    best = {}
    for i, score in expected:
        best[i] = max(score, best.get(i, score))
    got = sorted(found[large], key=lambda r: r.rank)
    assert [r.rank for r in got] == list(range(1, 21))
    assert {large + 40, large + 60} <= {r.vec_id for r in got}
    for r in got:
        assert r.vec_id != large and abs(r.score - best[r.vec_id]) < 1e-9
    assert all(len(own) == 20 for own in found.values())


def test_tiny_and_huge_components(spark):
    """Squares that vanish in doubles hide no direction."""
    schema = "vec_id long, embedding array<double>"
    rng = np.random.default_rng(10)
    rows = [(i, (rng.normal(size=8) * 10.0 ** rng.choice([-200.0, 0.0, 100.0])).tolist()) for i in range(200)]
    found = hamming_search.nearest(spark.createDataFrame(rows, schema), 5, 20, bits=16).collect()
    assert len(found) == 50 and all(r.score is not None for r in found)
    assert np.allclose(np.linalg.norm(hamming_search.directions(np.array([v for _, v in rows])), axis=1), 1)


def test_nothing_to_search(spark):
    assert hamming_search.nearest(vectors(spark, [])).columns == ["query_id", "rank", "vec_id", "score"]
    assert hamming_search.nearest(vectors(spark, [(1, None)])).count() == 0
    assert hamming_search.nearest(vectors(spark, [(20, [1.0, 2.0])])).count() == 0
    few = [(i, [1.0, float(i)]) for i in (20, 21, 22)]
    rows = hamming_search.nearest(vectors(spark, few), bits=16).collect()
    assert [(r.rank, r.vec_id) for r in sorted(rows, key=lambda r: r.rank)] == [(1, 22), (2, 21)]


@pytest.mark.parametrize(("radius", "parts"), [(0, 4), (3, 4), (17, 8), (56, 8)])
def test_probing_retrieves_every_code_within_the_radius(radius, parts):
    rng = np.random.default_rng(radius)
    index = rng.integers(0, 1 << 16, (500, parts), dtype=np.uint16)
    queries = index[:20] ^ (rng.random((20, parts)) < 0.5).astype(np.uint16) * np.uint16(9)
    for q, found in hamming_search.probe(index, queries, radius):
        near = hamming_search.distance(index, queries[q]) <= radius
        assert found.tolist() == np.flatnonzero(near).tolist()


