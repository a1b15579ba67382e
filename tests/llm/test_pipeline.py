"""The pipeline stage by stage against brute force, and the registered queries."""

import random
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import plain
import public_tokenizers
import pytest
from given import documents, labels  # noqa: F401
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from aerometry.llm import packing
from aerometry.llm.oracles import ORACLES
from aerometry.llm.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")


def corpus():
    """Prose and junk with copies, near copies, shared passages and secrets."""
    rng = random.Random(12)

    def prose(n):
        return ["".join(rng.choices("aeinorst", k=rng.randint(2, 8))) for _ in range(n)]

    passage = prose(60)
    texts, marks, best = [], [], []
    for i in range(160):
        own = prose(rng.randint(60, 160))
        good = i % 5 != 0
        if not good:
            own = [w + rng.choice(["###", "$$$"]) for w in own]
        elif i % 7 == 1:
            own = own[:40] + passage + own[40:]
        elif i % 7 == 2 and best:
            own = rng.choice(best).split()
            own[rng.randrange(len(own))] = "edited"
        elif i % 7 == 3:
            own[10:10] = ["password:", "hunter2" * 3, "AKIA" + "A1B2" * 5]
        elif i % 7 == 4 and best:
            own = rng.choice(best).split()
        texts.append((i, " ".join(own)))
        if good:
            best.append(texts[-1][1])
        marks.append((i, int(good)))
    return [*texts, (900, None), (901, ""), (902, texts[1][1])], marks


@pytest.fixture(scope="module")
def base(spark, documents, labels, tmp_path_factory):  # noqa: F811
    texts, marks = corpus()
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents(texts).write.parquet(f"{folder}/documents.parquet")
    labels(marks).write.parquet(f"{folder}/labels.parquet")
    return folder


def redacted(text):
    spans = plain.secrets(text)
    parts, last = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= last:
            parts += [text[last:start], "[SECRET]"]
        last = max(last, end)
    return "".join([*parts, text[last:]])


def test_every_stage_equals_brute_force(spark, base, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "repeats", "secrets", "packing"]
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns = docs.columns

    def step(name, docs):
        stages[name](spark, docs, base).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    def texts_of(df):
        assert df.columns == columns
        return {r.doc_id: r.text for r in df.collect()}

    texts, marks = corpus()
    good = step("quality", docs)
    kept = texts_of(good)
    wrong = [i for i, q in marks if (i in kept) != bool(q)]
    assert len(wrong) <= 4 and all(kept[i] == t for i, t in texts if i in kept)

    single = step("near_duplicates", good)
    classes = plain.classes(sorted(kept.items()))
    assert texts_of(single) == {i: t for i, t in kept.items() if classes[i] == i}

    left = step("repeats", single)
    before, after = texts_of(single), texts_of(left)
    expected = plain.without_repeats(sorted(before.items()))
    assert {i: (len(plain.words(t)), plain.sha(" ".join(plain.words(t)))) for i, t in after.items()} == {
        i: (n - gone, digest) for i, n, gone, digest in expected
    }
    assert sum(gone for _, _, gone, _ in expected) > 0

    clean = step("secrets", left)
    safe = texts_of(clean)
    assert safe == {i: None if t is None else redacted(t) for i, t in after.items()}
    assert any("[SECRET]" in (t or "") for t in safe.values())

    rows = step("packing", clean).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc_id, text in safe.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, packing.END_TOKEN]
        data, at = np.array(ids, dtype="<u4").tobytes(), 0
        for r in sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(data[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(ids)
    found = corpus_pipeline.run(spark, base).drop("sequence_id", "offset").collect()
    kept_columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(map(tuple, found)) == sorted(tuple(r[c] for c in kept_columns) for r in rows)


def test_registered_queries():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(contract.oracle_sql())
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")
@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")

    def shown(frame):
        frame = frame[sorted(frame.columns)].astype(object)
        frame = frame.where(frame.notna(), None)
        return sorted(map(repr, frame.itertuples(index=False, name=None)))

    found = contract.queries()[name](spark, str(SF_DIR)).toPandas()
    assert len(found) and shown(found) == shown(connection.execute(ORACLES[name]).df())
