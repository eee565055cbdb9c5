"""Archives, nearest neighbours, language-model scores and repeated passages on small tables."""

import base64
import gzip
import hashlib
import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ruleframe.llm import ann, automaton, passages, warc
from ruleframe.session import run_folder

DOCS = "doc_id long, text string, source string"


# --- WARC -----------------------------------------------------------------------------------------

PAGES = [
    (3, "http://a/3", "<p>one</p>"), (1, "http://a b\r\nX: y", "<p>one</p>"), (2, None, None), (5, "http://a/5", ""),
    (None, "http://a/n", "<p>one</p>"), (None, "http://a/m", "only null"), (4, "http://é/4", "漢字\r\n\r\nWARC/1.1\r\n\r\n"),
    (9, "http://a/9", "long " * 400_000), (1, "http://a/again", "<p>one</p>"),
]


def archive(spark, tmp_path, rows, **options):
    path = f"file://{tmp_path}/warc"
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path, **options)
    return path


def test_round_trip_of_pages(spark, tmp_path):
    records = warc.read_warc(spark, archive(spark, tmp_path, PAGES))
    found = warc.page_records(records).collect()
    digest = lambda html: base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    first = {}
    for page, _, html in PAGES:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    expected = []
    for page, _, html in PAGES:
        least = first.get(html or "")
        again = least is not None and (page is None or page > least)
        expected.append((page, len((html or "").encode()), digest(html), "revisit" if again else "response", least if again else None))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    payloads = records.where("warc_type = 'response'").select("record_id", "payload").collect()
    assert {bytes(r.payload).decode() for r in payloads} == {html or "" for _, _, html in PAGES}


def test_small_payloads_are_no_revisits(spark, tmp_path):
    records = warc.read_warc(spark, archive(spark, tmp_path, PAGES, least=11))
    assert records.where("warc_type = 'revisit'").count() == 0


def test_no_pages(spark, tmp_path):
    assert warc.read_warc(spark, archive(spark, tmp_path, [])).count() == 0


def test_filters_are_decided_from_headers(spark, tmp_path):
    path = archive(spark, tmp_path, PAGES)
    reader = warc.WarcReader({"path": path})
    wanted = [warc.EqualTo(("warc_type",), "revisit"), warc.StringStartsWith(("target_uri",), "http://a/")]
    rest = list(reader.pushFilters([*wanted, warc.EqualTo(("content_length",), 3)]))
    assert reader.filters == wanted and len(rest) == 1
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert rows and all(r["warc_type"] == "revisit" and r["target_uri"].startswith("http://a/") for r in rows)
    reader = warc.WarcReader({"path": path, "payload": "false"})
    assert all(r["payload"] is None for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist())
    records = warc.read_warc(spark, path)
    assert records.where("warc_type IN ('revisit', 'x') AND record_id IS NOT NULL").count() == 3


def test_gzip_members_and_broken_archives(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: %s\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    folder = tmp_path / "gz"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(gzip.compress(record % b"resource") + gzip.compress(record % b"metadata"))
    records = warc.read_warc(spark, f"file://{folder}").collect()
    assert [(r.warc_type, bytes(r.payload)) for r in records] == [("resource", b"abc"), ("metadata", b"abc")]
    (folder / "a.warc.gz").write_bytes(gzip.compress(b"nothing\r\n"))
    with pytest.raises(Exception, match="no WARC record"):
        warc.read_warc(spark, f"file://{folder}").collect()


def test_files_are_grouped_into_partitions(tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * 100)
    (tmp_path / "_SUCCESS").write_bytes(b"")
    planned = warc.WarcReader({"path": f"file://{tmp_path}", "partitionbytes": "250"}).partitions()
    assert [len(p.files) for p in planned] == [2, 2, 1]


# --- nearest neighbours ---------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>")


def brute_nearest(rows, queries, k=10):
    out = {}
    for q in queries:
        own = np.array(dict(rows)[q], np.float64)
        near = sorted((math.sqrt(((np.array(v, np.float64) - own) ** 2).sum()), i) for i, v in rows if i != q)
        out[q] = [(i, d) for d, i in near[:k]]
    return out


def test_recall_against_brute_force(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.4 * random.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    table = ann.usable_vectors(vectors(spark, rows))
    found = ann.nearest(table, table.where("id % 100 = 0"), tile=64, leaf_size=32).collect()
    expected = brute_nearest(rows, range(0, 3000, 100))
    hits = sum((r.id, pytest.approx(r.distance)) in [(i, d) for i, d in expected[r["query"]]] for r in found)
    assert len(found) == 300 and hits >= 270


def test_ties_repeats_and_unusable_vectors(spark):
    same = [(i, [1.0, 2.0]) for i in range(50)]
    odd = [(60, None), (61, [0.0, 0.0]), (62, [1.0, None]), (63, [float("nan"), 1.0]), (64, [float("inf"), 1.0]), (None, [1.0, 2.0]), (65, [1.0])]
    rows = [*same, *odd, (7, [1.0, 2.0]), (70, [4.0, 6.0])]
    table = ann.usable_vectors(vectors(spark, rows).withColumn("v", F.lit(1)).withColumn("size", F.lit(2)))
    assert table.count() == 51
    found = ann.nearest(table, table.where("id IN (0, 7, 70)")).orderBy("query", "rank").collect()
    assert [r.id for r in found if r["query"] == 0] == list(range(1, 11))
    assert [r.id for r in found if r["query"] == 7] == [0, 1, 2, 3, 4, 5, 6, 8, 9, 10]
    assert [(r.id, r.distance) for r in found if r["query"] == 70] == [(i, 5.0) for i in range(10)]


def test_few_or_no_vectors(spark):
    three = ann.usable_vectors(vectors(spark, [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [4.0, 0.0])]))
    found = ann.nearest(three, three).orderBy("query", "rank").collect()
    assert [(r["query"], r["rank"], r.id, r.distance) for r in found][:2] == [(0, 1, 1, 1.0), (0, 2, 2, 3.0)] and len(found) == 6
    none = ann.usable_vectors(vectors(spark, []))
    assert ann.nearest(none, none).count() == 0
    assert ann.nearest(three, three.limit(0)).count() == 0


def test_queries_of_small_leaves_get_k(spark):
    random = np.random.default_rng(6)
    rows = [(i, random.normal(size=4).astype(np.float32).tolist()) for i in range(200)]
    table = ann.usable_vectors(vectors(spark, rows))
    found = ann.nearest(table, table.where("id < 20"), recall=0.1, leaf_size=4, branch=4).groupBy("query").count().collect()
    assert len(found) == 20 and {r["count"] for r in found} == {10}


def test_best_bins_reach_every_leaf():
    random = np.random.default_rng(1)
    tree = ann.fit_tree(random.normal(size=(500, 4)), branch=4, leaf_size=20)
    assert sorted(tree.best_bins(random.normal(size=4), tree.leaves)) == list(range(tree.leaves))
    assert tree.best_bins(np.zeros(4), 3) == tree.best_bins(np.zeros(4), 10)[:3]
    sizes = np.arange(tree.leaves) % 3
    found = tree.best_bins(np.zeros(4), 1, sizes, 12)
    assert sizes[found].sum() >= 12 > sizes[found[:-1]].sum() and found == tree.best_bins(np.zeros(4), len(found))


# --- language model -------------------------------------------------------------------------------


def brute_model(rows, order, share, discount):
    """Probabilities by definition, with plain dictionaries."""
    tokens = {i: [*(t or "").lower().encode().split(), b"\n"] for i, t, _ in rows}
    train = [tokens[i] for i, _, y in rows if y]
    count = Counter(w for t in train for w in t)
    total, distinct = sum(count.values()), len(count)
    least = max(2, math.ceil(share * total))
    once, twice = (sum(c == n for c in count.values()) for n in (1, 2))
    first = once / (once + 2 * twice) if once and twice else 0.5
    kept = [{(w,): c for w, c in count.items() if c >= least}]
    for n in range(2, order + 1):
        grams = Counter()
        for t in train:
            t = [b"\n", *t]
            for i in range(len(t) - n + 1):
                grams[tuple(t[i : i + n])] += 1
        kept.append({g: c for g, c in grams.items() if c >= least})

    def unigram(w):
        if not total:
            return 1.0
        return (count[w] - first) / total if count[w] else first * distinct / total

    def chance(history, w):
        if not history:
            return unigram(w)
        after = {g: c for g, c in kept[len(history)].items() if g[:-1] == history} if len(history) < len(kept) else {}
        if not after:
            return chance(history[1:], w)
        base = kept[len(history) - 1][history]
        weight = max(1 - sum(c - discount for c in after.values()) / base, 1e-12)
        own = max(after.get((*history, w), 0) - discount, 0) / base
        return own + weight * chance(history[1:], w)

    out = {}
    for i, t in tokens.items():
        score, history = 0.0, (b"\n",)
        for w in t:
            history = history[-(order - 1) :] if order > 1 else ()
            score += math.log10(chance(history, w))
            history = (*history, w)
        base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in t)
        out[i] = (len(t), sum(count[w] > 0 for w in t), total, base, score)
    return out


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("chunk", [40, 1 << 20])
def test_scores_against_brute_force(spark, order, chunk):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.8)) % 60}" for _ in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40))), i % 7 != 2) for i in range(80)]
    rows += [(80, None, True), (81, "", False), (82, "unseen words only", False), (83, rows[0][1], True)]
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], DOCS).withColumn("chunk", F.lit(1))
    train = {i: y for i, _, y in rows}
    found = automaton.score_texts(docs, F.col("doc_id").isin([i for i in train if train[i]]), order=order, share=0.002, chunk=chunk)
    expected = brute_model(rows, order, 0.002, 0.75)
    got = {r.id: r for r in found.collect()}
    assert set(got) == set(expected)
    for i, (n, known, total, base, score) in expected.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.train) == (n, known, total, train[i])
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


@pytest.mark.parametrize("hot", [0.05, 1.0])
def test_scores_whatever_histories_are_hot(spark, monkeypatch, hot):
    monkeypatch.setattr(automaton, "HOT", hot)
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.8)) % 50}" for _ in range(30)), i % 7 != 2) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], DOCS)
    got = {r.id: r.score for r in automaton.score_texts(docs, F.col("doc_id") % 7 != 2, chunk=300).collect()}
    assert got == {i: pytest.approx(x[-1]) for i, x in brute_model(rows, 3, 0, 0.75).items()}


@pytest.mark.parametrize("order", [2, 3, 4])
def test_long_texts_go_through_in_lanes(spark, order):
    """Lanes after the first begin some words early; their scores are those of one pass."""
    rng = random.Random(7)
    sizes = [1, automaton.LANE - 1, automaton.LANE, automaton.LANE + 1, 3 * automaton.LANE, 1_000, 2_000]
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 30}" for _ in range(n)), i != 2) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], DOCS)
    got = {r.id: r.score for r in automaton.score_texts(docs, F.col("doc_id") != 2, order=order, chunk=2_500).collect()}
    assert got == {i: pytest.approx(x[-1]) for i, x in brute_model(rows, order, 0, 0.75).items()}


def test_pairs_that_occur_twice_count_in_a_large_corpus(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(4_000)) for _ in range(60)]  # of 240,000, 2 are less than 1e-5
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate([*texts, *["rare pair"] * 2, "w1 rare pair", "w1 pair rare"])], DOCS)
    got = {r.id: r.score for r in automaton.score_texts(docs, F.col("doc_id") < 62).collect()}
    assert got[62] > got[63] + 1


def test_scores_without_training_or_texts(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (None, None, None)], DOCS)
    found = automaton.score_texts(docs, F.lit(False)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found) == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert automaton.score_texts(docs.limit(0), F.lit(True)).count() == 0


# --- passages -------------------------------------------------------------------------------------


def test_compact_windows_cover_each_run_once():
    rng = np.random.default_rng(3)
    for size, values in ((40, 1000), (60, 3), (30, 1)):
        row = rng.integers(0, values, size).astype(np.uint64)
        left, c, right = passages.compact_windows(row, np.array([0]), np.array([size]), 5)
        for a in range(size):
            for b in range(a + 4, size):
                place = a + int(row[a : b + 1].argmin())
                assert [x for x in zip(left, c, right) if x[0] <= a <= x[1] <= b <= x[2]] == [
                    x for x in zip(left, c, right) if x[1] == place and x[0] <= a and b <= x[2]
                ]
                assert sum(l <= a <= m <= b <= r for l, m, r in zip(left, c, right)) == 1


def texts_with_passages():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    filler = lambda n: " ".join(word() for _ in range(n))
    shared, edited = filler(60), filler(120).split()
    variant = list(edited)
    variant[40] = variant[80] = "changed"
    texts = [f"{filler(70)} {shared} {filler(30)}" for _ in range(6)]
    texts += [f"{filler(30)} {' '.join(edited)} {filler(40)}", f"{filler(90)} {' '.join(variant)}"]
    texts += [filler(200), filler(49), "same " * 300, None, ""]
    texts += [texts[8], texts[9], f"{filler(60)} {' '.join(shared.split()[:40])} {filler(60)}"]
    return texts


def test_passages_are_found_and_nothing_else(spark):
    texts = texts_with_passages()
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], DOCS).withColumn("key", F.lit(1))
    found = passages.repeated_passages(docs).orderBy("id", "start").collect()
    assert [(r.id, r.start, r.end, r.passage, r.documents) for r in found if r.id < 6] == [(i, 70, 130, 0, 6) for i in range(6)]
    assert [(r.start, r.end, r.passage, r.documents) for r in found if r.id in (6, 7)] == [(30, 150, 6, 2), (90, 210, 6, 2)]
    assert [(r.id, r.start, r.end, r.passage) for r in found if r.id > 7] == [(8, 0, 200, 8), (13, 0, 200, 8)]


def test_parts_of_a_passage_that_stand_elsewhere_too():
    rng = np.random.default_rng(4)
    draw = lambda n: rng.integers(0, 1 << 16, n).astype(np.uint16)
    x, y, z = draw(30), draw(30), draw(30)
    for lead in ([draw(20), x, draw(40), x, y, draw(9)], [draw(20), x, y[:12], draw(40), y, z, draw(9)]):
        text = np.concatenate([draw(15), x, y, z, draw(9)])
        lead = np.concatenate(lead)
        c, d = (15, 75) if len(lead) == 159 else (45, 105)
        for one, two, side in ((text, lead, 0), (lead, text, 2)):
            found = {p[side : side + 2] for p in passages.shared_passages(one, two, 50, 0.8)}
            assert any(a <= c and d <= b for a, b in found)


def test_passages_of_no_documents(spark):
    assert passages.repeated_passages(spark.createDataFrame([], DOCS)).count() == 0
    two = spark.createDataFrame([(None, "w%d " * 60 % tuple(range(60)), "s")] * 2, DOCS)
    assert [(r.id, r.start, r.end, r.passage, r.documents) for r in passages.repeated_passages(two).collect()] == [(None, 0, 60, None, 2)] * 2


# --- archives, read as the registered query does ----------------------------------------------------


def test_lengths_and_digests_are_those_of_the_payloads(spark, tmp_path):
    path = archive(spark, tmp_path, PAGES)
    whole = sorted(map(tuple, warc.page_records(warc.read_warc(spark, path)).collect()), key=repr)
    assert sorted(map(tuple, warc.read_pages(spark, path).collect()), key=repr) == whole
    for file in (tmp_path / "warc").glob("*.txt"):
        body = file.read_bytes()
        if b"only null" in body:
            file.with_suffix(".other").write_bytes(body.replace(b"only null", b"0nly null"))
    for file in (tmp_path / "warc").glob("*.other"):
        (tmp_path / "wrong").mkdir(exist_ok=True)
        (tmp_path / "wrong" / "part.txt").write_bytes(file.read_bytes())
    with pytest.raises(Exception, match="does not have the digest"):
        warc.read_pages(spark, f"file://{tmp_path}/wrong").collect()


def test_a_record_without_a_length_is_refused(spark, tmp_path):
    (tmp_path / "odd.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\n\r\n")
    with pytest.raises(Exception, match="without a content length"):
        warc.read_warc(spark, f"file://{tmp_path}/odd.warc").collect()


# --- passages that only some texts of a list share --------------------------------------------------


def linked(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], DOCS)
    return {(r.id, r.passage) for r in passages.repeated_passages(docs, **options).collect()}


@pytest.mark.parametrize("crowd", [4, 1000])
@pytest.mark.parametrize("common", [20, 40])
def test_no_link_is_lost_to_a_first_text_that_shares_less(spark, crowd, common):
    """Pairs share 52 words around words that many other texts have as well."""
    rng = random.Random(common)
    filler = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    line = filler(common)
    texts = [f"{filler(20)} {line} {filler(20)}" for _ in range(40)]
    for _ in range(15):
        before, after = filler((52 - common) // 2), filler((53 - common) // 2)
        texts += [f"{filler(20)} {before} {line} {after} {filler(20)}" for _ in range(2)]
    assert linked(spark, texts, crowd=crowd) == {(i, i - i % 2) for i in range(40, 70)}


@pytest.mark.parametrize("others", [0, 30])
def test_all_texts_of_a_crowded_list_meet(spark, others):
    """Two lines that many texts have make a passage only where few words stand between them."""
    rng = random.Random(others)
    filler = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    one, two = filler(45), filler(12)
    texts = [f"{filler(20)} {one} {filler(20)}" for _ in range(others)]
    texts += [f"{filler(20)} {one} {filler(7)} {two} {filler(20)}" for _ in range(40)]
    near = range(len(texts), len(texts) + 6)
    texts += [f"{filler(20)} {one} {filler(2)} {two} {filler(20)}" for _ in near]
    assert linked(spark, texts) == {(i, near[0]) for i in near}


def test_passages_with_one_changed_word_are_found(spark):
    rng = random.Random(5)
    draw = lambda n: ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]
    texts = []
    for i in range(60):
        shared = draw(50 + i % 6)
        changed = list(shared)
        changed[25] = "changed"
        texts += [" ".join([*draw(15), *x, *draw(15)]) for x in (shared, changed)]
    assert linked(spark, texts) == {(i, i - i % 2) for i in range(120)}


def test_what_is_staged_for_passages_is_little(spark):
    """Signatures are gone when they are read, and of the words only those of texts that are compared are kept."""
    rng = random.Random(6)
    draw = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    shared = draw(60)
    texts = [draw(80) for _ in range(20)] + [f"{draw(20)} {shared} {draw(20)}" for _ in range(2)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], DOCS)
    with run_folder(spark) as folder:
        found = passages.repeated_passages(docs)
        assert {(r.id, r.start, r.end) for r in found.collect()} == {(20, 20, 80), (21, 20, 80)}
        staged = {p.name.split("-")[0]: str(p) for p in Path(folder.removeprefix("file:")).iterdir()}
        assert "signatures" not in staged and "nearby" not in staged
        assert spark.read.parquet(staged["arrays"]).count() == 2
