"""Joins, searches, models and the pipeline against brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
from boletim.llm import jaccard, topk, toxicity
from boletim.llm.common import table
from boletim.llm.shingles import shingle_sets
from tests.conftest import SF_DIR


def _components(sets):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def _shingles(text):
    words = text.translate({i: i + 32 for i in range(65, 91)}).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_jaccard_join(spark, tmp_path):
    rng = random.Random(4)
    texts = [None, "", " \t", "a b", "A  B", "a b c d e"]
    for _ in range(6):
        base = rng.choices([f"w{i}" for i in range(300)], k=rng.choice([20, 60, 150]))
        for _ in range(12):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
            texts.append(" ".join(words))
    ids = [100 + i for i in range(len(texts))]
    rows = [(d, t, 1) for d, t in zip(ids, texts)]
    rows += [rows[8], (None, texts[9], 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, size int")
    got = jaccard.join(df, folder=str(tmp_path / "join")).collect()
    sets = [_shingles(t or "") for t in texts]
    want = {d: (len(s), ids[c]) for d, s, c in zip(ids, sets, _components(sets))}
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
        else:
            assert r.component_id == want[ids[9]][1]


def test_jaccard_join_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard.join(empty, folder=str(tmp_path / "a")).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, None)], "doc_id bigint, text string")
    got = jaccard.join(blank, folder=str(tmp_path / "b")).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(1, 0, 1), (2, 0, 2)}


def test_jaccard_join_hands_python_small_batches(spark, tmp_path, monkeypatch):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(setting), []
    put = jaccard._Store.put

    def spied(self, name, table):
        seen.append(int(spark.conf.get(setting)))
        return put(self, name, table)

    monkeypatch.setattr(jaccard._Store, "put", spied)
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (3, "x y z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = jaccard.join(df, folder=str(tmp_path / "join")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 3)}
    assert seen and max(seen) <= jaccard.ROWS
    assert spark.conf.get(setting) == before


def test_components_of_long_chains(spark, tmp_path):
    rng = random.Random(11)
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(4000)]
    chain, star, pair = ids[:3000], ids[3000:3900], ids[3900:3902]
    edges = list(zip(chain, chain[1:])) + [(star[0], x) for x in star[1:]] + [tuple(pair)]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, *edges[:9]], "a bigint, b bigint")
    store = jaccard._Store(spark, str(tmp_path / "chain"))
    got = jaccard.components(df, store, "c").collect()
    want = {node: min(part) for part in (chain, star, pair) for node in part}
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    assert len(list((tmp_path / "chain").glob("c-moves-*"))) <= 15


def test_prefixes_of_links_meet():
    rng = np.random.default_rng(0)
    frequent = rng.integers(0, 2**63, 50).astype("uint64")
    import pandas as pd

    order = jaccard.Order(pd.DataFrame({"token": frequent.view("int64"), "n": range(50)}))
    for _ in range(300):
        size = int(rng.integers(4, 80))
        pool = np.concatenate([frequent[:25], rng.integers(0, 2**63, size).astype("uint64")])
        a = np.unique(rng.choice(pool, size, replace=False))
        drop = rng.integers(0, len(a) // 5 + 1)
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, drop).astype("uint64")]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            assert len(np.intersect1d(order.prefix(a), order.prefix(b)))


def test_shingle_hashes_tell_texts_apart():
    texts = ["a b c d e f", "A b  c\td e f", "a b c d", "a b c d e", "x" * 300, "x" * 301, "é " * 9]
    sets = list(shingle_sets(texts))
    assert [len(s) for s in sets] == [2, 2, 1, 1, 1, 1, 1]
    assert (sets[0] == sets[1]).all() and len({int(s[0]) for s in sets[2:]}) == 5
    assert [s.tolist() for s in shingle_sets(texts[::-1])] == [s.tolist() for s in sets[::-1]]


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [list(map(float, v)) for v in rng.normal(0, 0.2, (300, 8))]
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[7]) for i in range(8)] + [rows[3]]
    rows += [(50, vectors[9]), rows[100], rows[100], (100, vectors[0])]
    bad = [(2000, None), (2050, [None] * 8), (2100, [float("nan")] * 8), (None, vectors[0])]
    df = spark.createDataFrame(
        [(*r, 1) for r in rows + bad], "vec_id bigint, embedding array<float>, score int"
    )
    got = topk.search(df, "vec_id % 50 = 0").collect()
    ids = np.array([r[0] for r in rows])
    whole = np.floor(256 * np.array([r[1] for r in rows], "float32").astype("float64")).astype(int)
    want = []
    for q in range(len(rows)):
        if ids[q] % 50 == 0:
            scores, others = whole @ whole[q], np.arange(len(rows)) != q
            best = np.lexsort((ids[others], -scores[others]))[:5]
            want += [
                (int(ids[q]), n + 1, int(ids[others][i]), int(scores[others][i]))
                for n, i in enumerate(best)
            ]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.search(df.limit(0), "vec_id % 50 = 0").count() == 0


def _toxic_docs(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdeo", k=4)) for _ in range(150)]
    rows, labels = [], []
    for i in range(600):
        text = rng.choices(words, k=rng.randint(20, 80))
        bad = i % 4 == 0
        for _ in range(4 if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["grobian", "lump", "schuft"]))
        rows.append((i, " ".join(text), 0.5))
        labels.append((i, int(bad)))
    rows += [(9001, None, 0.5), (9002, "", 0.5), (None, "lump lump schuft", 0.5)]
    labels += [(3, None), (None, 1), labels[0]]
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string, score double"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int"),
    )


def test_toxicity_on_held_out_documents(spark):
    docs, labels = _toxic_docs(spark)
    got = toxicity.judge(docs, labels).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in got if r.held_out} == {r.doc_id for r in held}
    right = [(r.predicted == 1) == (r.doc_id % 4 == 0) for r in held if r.doc_id < 600]
    assert sum(right) >= 0.95 * len(right)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    kept = toxicity.ordinary(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_toxicity_without_labels(spark):
    docs, labels = _toxic_docs(spark)
    got = toxicity.judge(docs.limit(3), labels.limit(0)).collect()
    assert [r.score for r in got] == [0.5] * 3
    assert toxicity.judge(docs.limit(0), labels).count() == 0


def test_every_operator_is_registered_once():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(contract.LLM_SQL) <= set(names)


@pytest.mark.parametrize("name", sorted(contract.LLM_SQL))
def test_matches_duckdb(spark, name):
    import duckdb

    with duckdb.connect() as con:
        for t in ("documents", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
        found = con.execute(contract.LLM_SQL[name])
        want = [d[0] for d in found.description], sorted(found.fetchall())
    df = contract.queries()[name](spark, SF_DIR)
    assert (df.columns, sorted(map(tuple, df.collect()))) == want


def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, SF_DIR, "documents")
    columns, seen = docs.columns, docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        seen = stage(spark, seen, SF_DIR)
        assert seen.columns == columns
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.count() >= docs.count() and "sequence_id" in out.columns


def test_near_copies_keep_one(spark):
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(60))
    far = " ".join(f"v{i}" for i in range(60))
    rows = [(1, text, 5), (1, text, 5), (2, text + " x", 5), (3, "other", 5), (None, None, 5)]
    rows += [(None, text, 5), (None, far, 5), (None, far + " x", 5), (3, "another one", 5), (4, "", 5)]
    rows += [(5, "lone words here", 5), (5, text + " x", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, size int")
    kept = corpus_pipeline.without_near_copies(spark, df, SF_DIR)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert [t for d, t in got if d is None and t and t.startswith("v")] in ([far], [far + " x"])
    rest = [x for x in got if not (x[0] is None and x[1])]
    assert sorted(rest, key=str) == sorted([
        (1, text), (3, "other"), (3, "another one"), (4, ""), (5, "lone words here"), (None, None),
    ], key=str)
