"""The registered queries on the smallest tables: against their SQL, or against brute force."""

import collections
import math
import re
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from conftest import SF

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
from compare import rows_of  # noqa: E402
from ruleframe.llm import mixing, pii, queries  # noqa: E402
from test_documents import brute_components, brute_contamination, brute_fingerprint, brute_targets  # noqa: E402


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def result(spark, number):
    name = next(n for n in queries.QUERIES if n.startswith(f"op{number}_"))
    return queries.QUERIES[name](spark, SF)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_its_sql(spark, con, name):
    found = queries.QUERIES[name](spark, SF)
    expected = con.execute(queries.SQL[name])
    columns = [d[0] for d in expected.description]
    assert rows_of(found.columns, [tuple(r) for r in found.collect()]) == rows_of(columns, expected.fetchall())


def test_pseudonyms(spark, con):
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    feistel = pii.Feistel(queries.pii_key(spark))
    found = {r.doc_id: r for r in result(spark, 1).collect()}
    assert {i: (r.text, r.n_private) for i, r in found.items()} == {i: pii.pseudonymise(t, feistel) for i, t in texts.items()}
    assert sum(r.n_private for r in found.values()) > 0


def test_groups(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    prints = [brute_fingerprint(t) for _, t in rows]
    expected = {i: (f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, brute_components([i for i, _ in rows], prints))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in result(spark, 4).collect()} == expected


def test_held_out_toxicity(spark, con):
    """On the larger table, since the smallest has six toxic training rows."""
    folder = "/root/testdata/sf0.1"
    found = queries.QUERIES["op7_toxicity_lexicon"](spark, folder).collect()
    labels = dict(con.execute(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) >= 0.93 * len(held)
    assert sum(p and not y for p, y in held) <= 0.002 * len(held)


def test_base_scores(spark, con):
    import zlib

    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    tokens = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in rows}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    count = collections.Counter(w for i in train for w in tokens[i])
    total, distinct = sum(count.values()), len(count)
    better = collections.Counter()
    for r in result(spark, 8).collect():
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (r.doc_id not in train, len(own), total)
        assert r.n_known == sum(count[w] > 0 for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in own))
        for fold in (r.held_out, None):
            better[fold] += r.score - r.base_score
    assert better[True] > 0 and better[None] > 0  # as a whole the model is the better one


def test_recall(spark, con):
    rows = con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    hits, found = 0, result(spark, 9).collect()
    for q in ids[ids % 100 == 0]:
        distances = np.sqrt(((vectors - vectors[ids == q]) ** 2).sum(axis=1))
        distances[ids == q] = np.inf
        near = set(ids[np.lexsort((ids, distances))[:10]].tolist())
        own = [r for r in found if r.query_id == q]
        assert [r["rank"] for r in own] and len(own) == 10
        assert all(r.score == pytest.approx(distances[ids == r.vec_id][0], rel=1e-14) for r in own)
        hits += len(near & {r.vec_id for r in own})
    assert hits >= 0.9 * len(found)


def test_exact_repeats_are_covered(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    words = {i: re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower()) for i, t in rows}
    holders = collections.defaultdict(set)
    for i, w in words.items():
        for a in range(len(w) - 49):
            holders[tuple(w[a : a + 50])].add(i)
    covered = collections.defaultdict(set)
    for r in result(spark, 10).collect():
        covered[r.doc_id] |= set(range(r.start_word, r.end_word))
        assert r.n_documents > 1
    for i, w in words.items():
        for a in range(len(w) - 49):
            if len(holders[tuple(w[a : a + 50])]) > 1:
                assert set(range(a, a + 50)) <= covered[i]


def test_pipeline_stage_by_stage(spark, con):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    model = queries.toxicity_model(spark, docs, SF)
    feistel = pii.Feistel(queries.pii_key(spark))

    def groups(rows):
        ids, prints = [r.doc_id for r in rows], [brute_fingerprint(r.text) for r in rows]
        return [r for r, c in zip(rows, brute_components(ids, prints)) if c == r.doc_id]

    def clean(row):
        n, hit, _ = brute_contamination(row.text, items)
        return not hit or 20 * hit < n

    brute = {
        "toxicity": lambda rows: [r for r in rows if model.score(r.text) < queries.TOXIC],
        "near_duplicates": groups,
        "decontamination": lambda rows: [r for r in rows if clean(r)],
        "pseudonyms": lambda rows: [r.__class__(**{**r.asDict(), "text": pii.pseudonymise(r.text, feistel)[0]}) for r in rows],
    }
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = spark.createDataFrame(step(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, brute[name](before))), name
    kept = docs.collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in kept}
    sizes = collections.Counter()
    for r in kept:
        sizes[r.source] += size[r.doc_id]
    targets = brute_targets(sizes, {s: 1 + i % 3 for i, s in enumerate(sorted(sizes))})
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    times = collections.Counter(r.doc_id for r in mixed)
    for r in kept:
        rate = targets[r.source] / sizes[r.source]
        assert math.floor(rate) <= times[r.doc_id] <= math.floor(rate) + 1
    assert sum(times.values()) == mixing.mix_sources(docs).count()


def test_pipeline_as_a_whole(spark):
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(map(tuple, whole.select("doc_id", "text", "copy").collect())) == sorted(
        map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "text", "copy").collect())
    )
