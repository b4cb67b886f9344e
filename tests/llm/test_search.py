"""Spelling variants, top-k and ranked search against plain versions, on the test tables and on awkward rows."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.llm import bitsliced, lexical, variants


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(params=["documents", "edges", "nothing"])
def docs(request):
    return request.getfixturevalue(request.param)


def same_rows(df, want, *columns):
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == Counter(want)


# op11


def plain_variants(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 5}
    at = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            at[k, w[:k] + w[k + 1 :]].add(w)
    near = {w: set() for w in words}
    for some in at.values():
        for w in some:
            near[w] |= some - {w}
    for w in words:
        for k in range(len(w)):
            shorter = w[:k] + w[k + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants(docs):
    same_rows(variants.grouped(docs), plain_variants([(r.doc_id, r.text) for r in docs.collect()]), *COLUMNS)


def test_variants_of_runs_of_letters(spark):
    """Runs of one letter, edits in the middle, at both ends and in letters of one symbol; a chain of forms."""
    times = {"aaaaaa": 700, "aaaaaaa": 130, "aaaaaaaa": 26, "aaaaaaaaa": 5, "aaabaa": 9, "àaaaaa": 7, "unsaid": 6, "unsaic": 40, "nsaidx": 5, "×÷×÷×÷": 6, "×÷×÷×": 90}
    rows = [(k, f"{word.upper() if k % 2 and word.isascii() else word}’s 1") for word, n in times.items() for k in range(n)] + [(None, None), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r for r in variants.grouped(docs).collect()}
    same_rows(variants.grouped(docs), plain_variants(rows), *COLUMNS)
    assert got["aaaaaaaaa"].root == "aaaaaa" and got["unsaid"].form == "unsaic"


def test_every_edit_is_found(spark, docs):
    """Pairs over a small alphabet, where many words share reduced words and halves."""
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abé"), rng.integers(6, 9))) for _ in range(400)})
    got = variants.near_pairs(spark.createDataFrame([(w, 5) for w in words], "word string, n long")).collect()

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    assert Counter((r.word, r.near) for r in got) == Counter((a, b) for a in words for b in words if one_edit(a, b))


# op12


def plain_top(rows, k=5, one_in=50):
    able = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in able:
        if q % one_in == 0:
            scores = [(sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in able if i != q]
            out += [(q, rank, i, s) for rank, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:k], 1)]
    return out


RANKED = ("query_id", "rank", "vec_id", "score")
VECTORS = "vec_id long, embedding array<float>, label int, query int, score long, q string, ids binary"


def test_top_k(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    same_rows(bitsliced.searched(rows), plain_top([(r.vec_id, r.embedding) for r in rows.collect()]), *RANKED)


def test_top_k_of_awkward_rows(spark, monkeypatch):
    rng = np.random.default_rng(1)
    fine = [(k, [float(x) for x in rng.normal(0, 0.4, 7).astype(np.float32)]) for k in range(130)]
    copies = [(200 + k, fine[50][1]) for k in range(9)]
    odd = [
        (300, None), (350, [0.1, None, 0.2]), (400, [float("nan")] * 7), (450, [float("inf")] + [0.0] * 6), (None, [1.0] * 7), (500, []), (550, [0.5, -0.25]),
        (600, [0.0] * 7), (-50, [-0.5] * 7), (700, [0.5] * 9), (750, [1000.5, -3.25, 1e-8, 0.0, 5.0, -77.0, 0.001]), (0, fine[3][1]), (50, fine[50][1]), (50, fine[50][1]),
    ]
    rows = [(i, v, 1, 2, 3, "q", b"x") for i, v in fine + copies + odd]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    want = plain_top([(i, v) for i, v, *_ in rows])
    got = bitsliced.searched(df)
    assert {tuple(r) for r in got.collect()} >= set(want) - {w for w in want if w[0] in (0, 50)}
    same_rows(got.select(*RANKED), want, *RANKED)
    monkeypatch.setattr(bitsliced, "ASKED", 20)  # several passes over the queries give the same
    same_rows(bitsliced.searched(df), want, *RANKED)
    same_rows(bitsliced.searched(df, k=1000, one_in=100), plain_top([(i, v) for i, v, *_ in rows], 1000, 100), *RANKED)


def test_top_k_of_nothing(spark):
    assert bitsliced.searched(spark.createDataFrame([], VECTORS)).count() == 0
    one = spark.createDataFrame([(50, [1.0], 1, 1, 1, "", b"")], VECTORS)
    assert bitsliced.searched(one).count() == 0


def test_adders():
    rng = np.random.default_rng(4)
    ids, q = np.arange(150), rng.integers(-300, 90, (150, 6))
    block = bitsliced.Block(*bitsliced.sliced(ids, q))
    for asked in (rng.integers(-200, 200, 6), np.zeros(6, np.int64), np.array([0, -1, 0, 0, 0, 0])):
        total, shift = block.summed(asked)
        got = [shift + sum(int(s[r // 64] >> np.uint64(r % 64) & np.uint64(1)) << t for t, s in enumerate(total)) for r in range(150)]
        assert got == (q @ asked).tolist()


# op13


def plain_ranking(docs, items, k=10):
    term = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
    counts = [(i, Counter(term.findall(lower(t)))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, total = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in counts:
            m = 10 + 90 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(term.findall(lower(text))) if t in c)
            if s > 0:
                scores.append((-s, i is not None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return out


ASKED = "item_id long, text string, item int, terms string, score int"


@pytest.fixture(scope="module")
def items(spark, sf_dir):
    rows = [(r.item_id, r.text, 1, "t", 2) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    odd = [(None, "the of w3x W4X", 1, "t", 2), (900, None, 1, "t", 2), (901, "", 1, "t", 2), (902, "!?", 1, "t", 2), (903, "nowhere-to-be-found", 1, "t", 2)]
    same = [(904, "same line x one", 1, "t", 2)] * 2 + [(905, " ".join(f"w{k}x" for k in range(400)) + " the of and", 1, "t", 2)]
    return spark.createDataFrame(rows + odd + same, ASKED)


def test_ranking(docs, items, monkeypatch):
    want = plain_ranking([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    columns = ("item_id", "rank", "doc_id", "score")
    same_rows(lexical.ranked(docs, items), want, *columns)
    monkeypatch.setattr(lexical, "BLOCK", 3)
    monkeypatch.setattr(lexical, "ASKED", 300)
    same_rows(lexical.ranked(docs.repartition(2), items), want, *columns)


def test_no_items(spark, docs):
    assert lexical.ranked(docs, spark.createDataFrame([], ASKED)).count() == 0


def test_accumulators_stop(spark):
    """Frequent terms alone make no accumulator once rarer ones have filled the ranking."""
    docs = [(k, f"rare{k % 2} " * 9 + "the") for k in range(12)] + [(k, "the and of") for k in range(12, 60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(1, "the rare0 rare1 of")]
    got = lexical.ranked(df.withColumn("k", F.lit(1)), spark.createDataFrame(items, "item_id long, text string"))
    same_rows(got, plain_ranking(docs, items), "item_id", "rank", "doc_id", "score")
    assert max(r.doc_id for r in got.collect()) < 12
