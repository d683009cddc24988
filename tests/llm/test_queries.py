"""Registered queries against their SQL, and the pipeline and BPE against plain Python."""

import hashlib
import importlib.util
import os
import re

import duckdb
import public_tokenizers
import pytest

from touchline.llm import bpe
from touchline.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "labels", "benchmark")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(dict(zip(names, row))[c] for c in df.columns) for row in found.fetchall()]
    got = [tuple(row) for row in df.collect()]
    assert got and sorted(map(repr, got)) == sorted(map(repr, want))


def test_names():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
def test_pipeline(spark, duck):
    import corpus_pipeline

    from touchline.llm import mixing

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    good = stages["quality rules"](spark, docs, SF_DIR)
    failed = duck.execute(f"SELECT doc_id FROM ({ORACLES['op6_quality_rules']}) WHERE NOT kept")
    assert good.columns == columns
    assert {r["doc_id"] for r in good.collect()} == set(texts) - {r[0] for r in failed.fetchall()}

    equal = stages["exact dedup"](spark, good, SF_DIR)
    bare = {}
    for r in good.collect():
        key = re.sub(r"[\x20\x09-\x0d]", "", r["text"] or "")
        bare.setdefault(key, []).append((-len(r["text"] or ""), r["doc_id"]))
    assert equal.columns == columns
    assert sorted(r["doc_id"] for r in equal.collect()) == sorted(min(v)[1] for v in bare.values())

    near = stages["near dedup"](spark, equal, SF_DIR)
    left = {r["doc_id"]: r["text"] for r in equal.collect()}
    assert near.columns == columns
    assert {r["doc_id"] for r in near.collect()} == smallest_of_groups(left)

    mix = stages["mix"](spark, near, SF_DIR)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed(near).collect()}
    assert mix.columns == columns
    got = sorted(r["doc_id"] for r in mix.collect())
    assert got == sorted(i for i, n in copies.items() for _ in range(n))

    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    codec = bpe.encoding(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    assert sorted(r["doc_id"] for r in rows) == got
    for r in rows:
        ids = codec.encode_ordinary(texts[r["doc_id"]])
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", lowered)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def smallest_of_groups(texts):
    found, _ = components(texts)
    return {i for i, c in found.items() if i == c}
