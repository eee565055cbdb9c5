"""Quality rules, importance resampling and whitening on small tables, against plain Python and numpy."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ruleframe.llm import importance, quality, queries, whitening

from conftest import SF  # noqa: I001

DOCS = "doc_id long, text string, lang string"
ODD = [None, "", " \n\t", "one", "a b c a b c", "x\nx\n\nx \n", "#*$ é漢 字\r\n#*$ é漢 字\r\nq", "one\n", "\n\none", "word " * 5_000]


# --- quality rules --------------------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated)


def brute_model(texts, order=3):
    """Interpolated modified Kneser-Ney over letters, written plainly; returns the mean surprise of a text."""
    letters = [[quality.LINE] * (order - 1) + [int(quality.LETTER[b]) for b in (t or "").encode()] for t in texts]
    grams = [collections.Counter() for _ in range(order + 1)]
    for row in letters:
        for i in range(order - 1, len(row)):
            grams[order][tuple(row[i - order + 1 : i + 1])] += 1
    for size in range(order - 1, 0, -1):
        grams[size] = collections.Counter(g[1:] for g in grams[size + 1])

    def discount(size, c):
        n = [sum(v == k for v in grams[size].values()) for k in (1, 2, 3, 4)]
        if not n[0] or not n[1]:
            return 0.5
        y, k = n[0] / (n[0] + 2 * n[1]), min(c, 3)
        return min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) if n[k - 1] else k / 2

    discounts = [[None] + [discount(size, c) for c in (1, 2, 3)] if size else None for size in range(order + 1)]
    after = [collections.defaultdict(list) for _ in range(order + 1)]
    for size in range(1, order + 1):
        for g, c in grams[size].items():
            after[size][g[:-1]].append((c, discounts[size][min(c, 3)]))

    def chance(g):
        if not g:
            return 1 / quality.LETTERS
        follow = after[len(g)].get(g[:-1])
        if follow is None:
            return chance(g[1:])
        total = sum(c for c, _ in follow)
        c = grams[len(g)][g]
        own = (c - discounts[len(g)][min(c, 3)]) / total if c else 0
        return own + sum(d for _, d in follow) / total * chance(g[1:])

    return [
        -sum(math.log(chance(tuple(r[i - order + 1 : i + 1]))) for i in range(order - 1, len(r))) / (len(r) - order + 1)
        if len(r) >= order else None
        for r in letters
    ]


def test_counts_and_perplexity_of_odd_texts(spark):
    texts = [*ODD[:-1], "The cat sat.", "The rat, the hat: 3 cats", "été déjà vu"]
    rows = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS)
    model = quality.fit_quality(rows, order=3)
    found = {r.doc_id: r.quality for r in quality.with_quality(rows, model).collect()}
    for i, (text, expected) in enumerate(zip(texts, brute_model(texts))):
        assert tuple(found[i][c] for c in quality.COUNTS) == brute_counts(text)
        assert found[i].log_perplexity == (None if expected is None else pytest.approx(expected))


def test_chances_of_each_history_add_up(spark):
    model = quality.fit_quality(spark.read.parquet(f"{SF}/documents.parquet").limit(50))
    histories = np.append(np.unique(np.random.default_rng(0).integers(0, quality.LETTERS**3, 40)), 0)
    for history in histories:
        assert np.exp(model.chances(history * quality.LETTERS + np.arange(quality.LETTERS))).sum() == pytest.approx(1)


def test_base_columns_of_the_registered_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.QUERIES["op11_quality_rules"](spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        n, chars, symbols, lines, repeated = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.base_failed and r.kept)


def brute_word_surprise(texts):
    """Modified Kneser-Ney over word pairs, written plainly; own occurrences taken off, spelling by the letter model."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})
    rows = [[None, *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)), None] for t in texts]
    pairs = collections.Counter(p for r in rows for p in zip(r, r[1:]))
    before = collections.Counter(w for _, w in pairs)
    letters = [[quality.LINE] * 3 + [int(quality.LETTER[b]) for b in (t or "").encode()] for t in texts]
    grams = collections.Counter(tuple(r[i - 3 : i + 1]) for r in letters for i in range(3, len(r)))
    numbers = np.array([sum(x * quality.LETTERS**k for k, x in enumerate(reversed(g))) for g in sorted(grams)])
    model = quality.KneserNey.of(numbers, np.array([grams[g] for g in sorted(grams)]), 4)
    bytes_of = collections.Counter(int(quality.LETTER[b]) for b in range(256) if not 0x41 <= b <= 0x5A)

    def spelled(word):
        row = [27] * 3 + [int(quality.LETTER[b]) for b in ((word or "") + " ").encode()]
        steps = [sum(x * quality.LETTERS**k for k, x in enumerate(reversed(row[i - 3 : i + 1]))) for i in range(3, len(row))]
        return math.exp(sum(model.chances(np.array(steps)))) / math.prod(bytes_of[x] for x in row[3:])

    def kneser_ney(counts, key, discounts, shorter):
        counts = {k: c for k, c in counts.items() if c}
        total = sum(counts.values())
        if not total:
            return shorter
        less = {k: discounts[min(c, 3)] for k, c in counts.items()}
        return (counts.get(key, 0) - less.get(key, 0)) / total + sum(less.values()) / total * shorter

    def discounts(counts):
        return quality.discounts([sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)])

    of_pairs, of_words = discounts(pairs), discounts(before)

    def surprise(h, w):
        others = before - collections.Counter([w]) if pairs[h, w] == 1 else before
        word = kneser_ney(others, w, of_words, spelled(w))
        behind = collections.Counter({y: c for (x, y), c in pairs.items() if x == h}) - collections.Counter([w])
        return -math.log(kneser_ney(behind, w, of_pairs, word))

    return [sum(surprise(h, w) for h, w in zip(r, r[1:])) / (len(r) - 1) for r in rows]


def test_word_perplexity_against_plain_python(spark):
    """Its pairs are counted over all texts: the same letters in other words, or the words in another order, surprise more."""
    rng = np.random.default_rng(3)
    words = ["The", "cat", "sat", "mat.", "été", "x9#", "漢字", "rat"]
    texts = [*ODD[:-1], *(" ".join(rng.choice(words, n)) for n in (1, 9, 30, 80)), "cat The mat. sat", "zqx " + " the cat" * 7]
    rows = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS).repartition(3)
    found = {r.id: r.log_perplexity for r in quality.quality_report(rows).collect()}
    for i, (text, expected) in enumerate(zip(texts, brute_word_surprise(texts))):
        assert found[i] == (pytest.approx(expected, rel=1e-5) if text else None)
    model = quality.fit_quality(rows)
    shared = spark.sparkContext.broadcast(model)
    scored = quality.with_word_surprise(rows, lambda: quality._speller(shared), chunk=20)  # many chunks
    assert {r.doc_id: r.surprise for r in scored.collect() if texts[r.doc_id]} == pytest.approx({i: x for i, x in found.items() if texts[i]}, rel=1e-5)


def test_words_in_an_order_of_their_own_are_rejected(spark):
    """Letters as in the other texts, but words that follow one another nowhere else: a model of letters keeps it."""
    rng = np.random.default_rng(8)
    words = ["tan" + "".join(rng.choice(list("aeioulnrst"), 4)) + "ten" for _ in range(400)]
    step = [[words[(7 * i + k) % 400] for k in range(2)] for i in range(400)]
    texts = []
    for _ in range(200):
        at, row = int(rng.integers(400)), []
        for _ in range(120):
            row.append(words[at])
            at = words.index(step[at][int(rng.integers(2))])
        texts.append(" ".join(row))
    salad = " ".join(" ".join(texts).split()[i] for i in rng.integers(0, 24_000, 120))
    rows = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*texts, salad])], DOCS)
    found = {r.id: r for r in quality.quality_report(rows).collect()}
    assert sum(found[i].kept or found[i].base_failed for i in range(200)) >= 198
    assert not found[200].base_failed and not found[200].kept and found[200].log_perplexity > found[200].high
    assert found[200].letter_low <= found[200].letter_perplexity <= found[200].letter_high


def test_bands_reject_noise_and_patter_but_no_prose(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("aeioulnrst"), size)) for size in rng.integers(2, 9, 400)]
    prose = [" ".join(rng.choice(words, 120)) for _ in range(300)]
    noise = ["".join(rng.choice(list("qzxjk#9(] \n"), 700)) for _ in range(3)]
    patter = [" ".join(["tata" + "ta" * (i % 7) for i in rng.permutation(60)]) for _ in range(3)]
    rows = [(i, t, ["en", None][i % 2]) for i, t in enumerate(prose + noise + patter)]
    found = {r.id: r for r in quality.quality_report(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(found[i].kept for i in range(300))
    assert not any(found[i].kept for i in range(300, 306))
    assert all(found[i].log_perplexity > found[i].high for i in range(300, 303))
    assert all(found[i].log_perplexity < found[i].low for i in range(303, 306) if not found[i].base_failed)


def test_labelled_documents(spark):
    """Documents labelled good are kept, most of the others are not."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = queries.QUERIES["op11_quality_rules"](spark, folder).join(labels, "doc_id").where("NOT base_failed")
    kept = {r.quality: r.share for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.4


def test_quality_of_odd_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert quality.quality_report(empty).collect() == []
    same = spark.createDataFrame([(1, "a b " * 40, None), (1, "a b " * 40, None), (None, None, "en")], DOCS).withColumn("low", F.lit(3)).withColumn("of", F.lit(1))
    found = quality.quality_report(same).collect()
    assert sorted((r.id is None, r.n_words, r.kept) for r in found) == [(False, 80, False), (False, 80, False), (True, 0, False)]


# --- importance resampling ------------------------------------------------------------------------


def brute_resample(rows, target, percent=5, least=20):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    def buckets(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    s, t = (collections.Counter(b for text in texts for b in buckets(text)) for texts in ([r[1] for r in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    out = []
    for i, text in rows:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, buckets(text)))
        out.append([i, len(buckets(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_resampling_of_odd_texts(spark):
    texts = [*ODD, "It IS the Éa—x_y 3.5\x00z " * 9, "w" * 300 + " " + "v" * 65, *[f"alpha beta gamma{i} delta " * 8 for i in range(60)]]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(7, texts[20]), (7, texts[20])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("score", F.lit(0))
    target = ["alpha beta", None, "delta alpha", "gamma1 delta"]
    items = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 50):
        found = importance.importance_resample(docs, items, percent=percent).collect()
        expected = brute_resample(rows, target, percent)
        # rows of one id and text are alike, so either may be the one that is drawn
        assert sorted(map(tuple, found), key=repr) == expected


def test_ranks_follow_the_scores_over_many_tasks(spark):
    """The sort is left in many tasks of uneven size, whose files Spark reads in another order."""
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.expr("repeat(concat('w', id % 40, ' v '), CAST(10 + pow(id % 7, 3) AS INT))").alias("text"))
    items = spark.createDataFrame([("w1 v w3 v",)], "text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = importance.importance_resample(docs, items, percent=60).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    best = sorted(found, key=lambda r: (-r.score, r.id))
    assert [r["rank"] for r in best] == [*range(1, 1_801), *[None] * 1_200]


def test_resampling_of_no_documents_and_no_target(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(i, f"a b c{i} " * 10) for i in range(40)], "doc_id long, text string")
    assert importance.importance_resample(none, some).collect() == []
    assert sum(r["rank"] is not None for r in importance.importance_resample(some, none).collect()) == 2


def test_pretokenisation_returns_words_with_offsets():
    found = importance.splitter().pre_tokenize_str("héllo  wörld, 3.5\n")
    assert found == [("héllo", (0, 5)), ("wörld", (7, 12)), ("3", (14, 15)), ("5", (16, 17))]


# --- whitening ------------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["any", "equal", "clusters", "rank"])
def test_components_equal_those_of_numpy(size, kind):
    rng = np.random.default_rng(size)
    a = rng.standard_normal((size, 2 * size + 2))
    q, _ = np.linalg.qr(a)
    values = {
        "any": None, "equal": np.full(size, 3.0), "rank": np.where(np.arange(size) < size // 2 + 1, 2.0 + np.arange(size), 0),
        "clusters": np.resize([4, 4 - 1e-9, 2, 2, 1], size),
    }[kind]
    matrix = a @ a.T if values is None else (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    e, v = whitening.principal_components(matrix, 32)
    expected = np.linalg.eigvalsh(matrix)[::-1][: len(e)]
    scale = abs(expected).max()
    assert len(e) == min(32, size if kind != "rank" else size // 2 + 1)
    assert np.allclose(e, expected, rtol=0, atol=1e-13 * scale)
    assert np.allclose(v @ v.T, np.eye(len(e)), atol=1e-13)
    assert np.allclose(matrix @ v.T, v.T * e, rtol=0, atol=1e-12 * scale)


def brute_whitened(rows):
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in usable], object)
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    centred = centred.astype(np.float64)
    covariance = centred.T @ centred / n
    e, u = np.linalg.eigh(covariance)
    e, u = e[::-1], u[:, ::-1]
    deviation = [sum(int(d) ** 2 for d in n * row - sums) for row in x]
    return [i for i, _ in usable], n, deviation, e, centred @ u / np.sqrt(np.maximum(e, 1e-300)), np.trace(covariance)


def check_whitened(found, rows, components):
    ids, n, deviation, e, z, trace = brute_whitened(rows)
    by = collections.defaultdict(dict)
    for r in found:
        by[r.component][r.id] = r
    assert sorted(by) == list(range(1, components + 1))
    for k in range(1, components + 1):
        own = [by[k][i] for i in ids]
        assert all((r.n, r.deviation) == (n, d) for r, d in zip(own, deviation))
        assert own[0].explained == pytest.approx(e[k - 1] / trace, rel=1e-9)
        w = np.array([r.whitened for r in own])
        assert min(np.abs(w - z[:, k - 1]).max(), np.abs(w + z[:, k - 1]).max()) < 1e-8
        assert len({r.identity_error for r in own}) == 1 and own[0].identity_error < 1e-9


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(5) * [9, 5, 3, 2, 1]).tolist()) for i in range(300)]
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0, 0.0, 0.0]), (903, [math.nan] * 5), (904, [math.inf, 0.0, 0.0, 0.0, 0.0]), (905, [1.0, 2.0])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("deviation", F.lit("clash")).repartition(7)
    found = whitening.whiten_embeddings(table).collect()
    check_whitened(found, rows, 5)
    assert len(found) == 5 * 300


def test_whitening_of_equal_few_and_huge_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten_embeddings(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten_embeddings(spark.createDataFrame([(1, [0.5, 2.0])], schema)).collect() == []
    assert whitening.whiten_embeddings(spark.createDataFrame([(i, [0.5, 2.0]) for i in range(9)], schema)).collect() == []
    two = whitening.whiten_embeddings(spark.createDataFrame([(1, [0.0, 0.0]), (None, [1.0, 1.0]), (1, [0.0, 0.0])], schema)).collect()
    assert sorted((r.id is None, r.component, r.n) for r in two) == [(False, 1, 3), (False, 1, 3), (True, 1, 3)]
    huge = whitening.whiten_embeddings(spark.createDataFrame([(i, [1e30 * (i % 2), 1.0]) for i in range(4)], schema)).collect()
    assert len(huge) == 4 and all(r.deviation is None or r.deviation >= 0 for r in huge)


def test_the_registered_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = queries.QUERIES["op13_embedding_whitening"](spark, SF).withColumnRenamed("vec_id", "id").collect()
    check_whitened(found, rows, 32)
