"""The operators against plain versions of their contracts, on the test tables and on awkward rows."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ratelens.llm import decontaminate, html, jaccard, language, lines, mixing, quality, scoring, secrets, shard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(params=["documents", "edges", "nothing"])
def docs(request):
    return request.getfixturevalue(request.param)


@pytest.fixture
def plain(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "source", "lang").collect()]


# op1


def test_shards(docs, plain):
    got = [r.asDict() for r in shard.shard_documents(docs).collect()]
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in plain)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) and 0 <= k < 24 for k, s in slots.items())
    assert all(len(s) == 1 for s in by_key((r["doc_id"], r["shard"]) for r in got).values())


def by_key(pairs):
    out = defaultdict(set)
    for k, v in pairs:
        out[k].add(v)
    return out


def test_tree_shares_and_moves(spark):
    ids = spark.range(20_000).selectExpr("cast(id as string) as k")
    leaves = shard.layout(24)
    heavy = [shard.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in leaves]
    both = ids.select(shard.descend(ids.k, leaves).alias("a"), shard.descend(ids.k, heavy).alias("b"), shard.descend(ids.k, shard.layout(25)).alias("c")).collect()
    n = Counter(r.a for r in both)
    assert len(n) == 24 and max(n.values()) < 1.25 * 20_000 / 24 and min(n.values()) > 0.75 * 20_000 / 24
    assert abs(Counter(r.b for r in both)[5] / 20_000 - 3 / 26) < 0.02
    # Only into the region (and there the rack) whose weight grew.
    region, rack = (lambda s: s // 12), (lambda s: s // 4)
    for r in both:
        if r.a != r.b:
            assert region(r.b) == 0
            if region(r.a) == 0:
                assert rack(r.b) == 1 and (rack(r.a) != 1 or r.b == 5)
        assert r.c in (r.a, 24)
    assert 0.02 < sum(r.c == 24 for r in both) / 20_000 < 0.06


# op4


def plain_targets(sizes):
    total = sum(sizes.values()) * 1.5
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    capped, target = set(), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        target = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in order}
        above = {s for s in free if target[s] > 2 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_mix(docs, plain):
    got = [r.asDict() for r in mixing.mix(docs).collect()]
    sizes = Counter()
    for _, t, s, _ in plain:
        sizes[s] += len(WORD.findall(t or ""))
    target = plain_targets(sizes) if sizes else {}
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(WORD.findall(t or ""))) for d, t, *_ in plain)
    assert sorted({(r["source_size"], round(r["target"], 3)) for r in got}) == sorted({(sizes[s], round(target[s], 3)) for s in sizes})
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    biggest = max((r["size"] for r in got), default=0)
    assert abs(sum(r["taken"] for r in got) - 1.5 * sum(sizes.values())) <= 2 * biggest
    assert rows(mixing.mix(docs), "doc_id", "taken") == rows(mixing.mix(docs.repartition(5)), "doc_id", "taken")
    assert sum(r["taken"] for r in got) == sum(len(WORD.findall(r.text or "")) for r in mixing.mixed_documents(docs).collect())
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_mix_meets_targets(documents):
    taken, target, most = Counter(), {}, Counter()
    source = {r.doc_id: r.source for r in documents.collect()}
    for r in mixing.mix(documents).collect():
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        most[s] = max(most[s], r.size)
    assert all(abs(taken[s] - target[s]) <= most[s] + 1 for s in target)


# op6


def plain_groups(plain):
    sets = []
    for _, t, *_ in plain:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, *_) in enumerate(plain):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, *_) in enumerate(plain)), key=repr)


def test_jaccard(docs, plain):
    assert rows(jaccard.components_of(docs), "doc_id", "n_shingles", "component_id") == plain_groups(plain)


def test_chains_of_near_copies(spark):
    """Each text is linked with its neighbours only; a group of many near copies stays one group."""
    words = [f"u{i}" for i in range(200)]
    texts = []
    for k in range(12):
        words[k * 16 : k * 16 + 3] = [f"v{k}a", f"v{k}b", f"v{k}c"]
        texts.append(" ".join(words))
    texts += [" ".join([f"q{i}" if i != k else f"z{k}" for i in range(150)]) for k in range(60)]
    plain = [(k, t, None, None) for k, t in enumerate(texts)]
    df = spark.createDataFrame(plain, "doc_id long, text string, source string, lang string")
    assert rows(jaccard.components_of(df), "doc_id", "n_shingles", "component_id") == plain_groups(plain)


def test_linked_sets_meet_where_they_may():
    """The first common shingle stands in both prefixes, in a shared block, and passes all bounds."""
    rng = np.random.default_rng(1)
    linked = 0
    levels = rng.integers(0, 3, jaccard.CELLS).astype(np.uint8)
    for n in (1, 2, 6, 7, 8, 10, 14, 20, 33, 50, 100, 333):
        for _ in range(150):
            base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            drop, more = rng.integers(0, int(n * 0.16) + 1, 2)
            other = np.unique(np.concatenate([rng.permutation(base)[drop:], rng.integers(0, 2**64, more, dtype=np.uint64)]))
            both, union = len(np.intersect1d(base, other)), len(np.union1d(base, other))
            if 100 * both >= 85 * union and both != union:
                linked += 1
                x, y = jaccard.ordered(base, levels), jaccard.ordered(other, levels)
                i = next(k for k, h in enumerate(x) if h in other)
                j = int(np.flatnonzero(y == x[i])[0])
                assert i < jaccard.prefix(len(x)) and j < jaccard.prefix(len(y))
                assert 185 * min(len(x) - i, len(y) - j) >= 85 * (len(x) + len(y))
                assert set(jaccard.classes(len(x))) & set(jaccard.classes(len(y)))
                bits = sum(int(a ^ b).bit_count() for a, b in zip(jaccard.sketch(x).view(np.uint64), jaccard.sketch(y).view(np.uint64), strict=True))
                assert 185 * bits <= 15 * (len(x) + len(y))
    assert linked > 500


def test_shingles_of_bytes():
    """Words of a batch, whatever stands at the bounds of texts and pieces."""
    import pyarrow as pa

    from ratelens.llm import hashing

    texts = ["a b c d e", "A  B\tc\nd e", None, "", " ", "a b c", "d", "e", "x" * 300 + " y", "é è\x0bê ë ì", "a b c d a b c d"] * 3
    for piece in (7, 1 << 20):
        old, hashing.PIECE = hashing.PIECE, piece
        try:
            got = []
            for _, offsets, data in hashing.grouped_texts(pa.array(["skipped", *texts]).slice(1), 100):
                bounds, h = hashing.shingles_of(offsets, data, 4)
                got += [set(h[a:b].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)]
        finally:
            hashing.PIECE = old
        want = []
        for t in texts:
            w = lower(t).split()
            want.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
        assert len(got) == len(want)
        name: dict = {}
        for g, w in zip(got, want, strict=True):
            assert len(g) == len(w)
            if len(w) == 1:
                assert name.setdefault(next(iter(w)), next(iter(g))) == next(iter(g))
        assert len(set(name.values())) == len(name)


def test_survivors(docs, plain):
    kept = jaccard.survivors(docs)
    groups = plain_groups(plain)
    want = len({g for _, n, g in groups if n}) + sum(n == 0 for _, n, _ in groups)
    assert kept.columns == docs.columns
    assert abs(kept.count() - want) <= (1 if any(d is None for d, *_ in plain) else 0)


# op8


def plain_hits(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    at, hit, found = defaultdict(list), set(), set()
    for i, w in enumerate(words):
        at[w].append(i)
    for item, passage in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(passage))
        for s in range(max(1, len(own) - 12) if own else 0):
            window = own[s : s + 13]
            for i in at[window[0]]:
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item)
    listed = sorted(str(i) for i in found if i is not None)
    return len(words), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("tests", ["given", "own", "none"])
def test_decontamination(spark, docs, plain, sf_dir, tests):
    if tests == "given":
        items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    else:
        long = [t for _, t, *_ in plain if t and len(t.split()) > 30]
        items = [(k, " ".join(t.split()[k : k + 20])) for k, t in enumerate(long[:9])] + [(None, "the of and"), (77, "w1x"), (78, None), (79, ""), (80, "one, TWO!")]
        items = items + items[:2] if tests == "own" else []
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontaminate.scanned(docs, benchmark), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == sorted(((d, *plain_hits(t, items)) for d, t, *_ in plain), key=repr)


def test_proximity(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    broken = passage.replace("p6", "p6 extra")
    df = spark.createDataFrame([(1, passage), (2, broken)], "doc_id long, text string")
    got = decontaminate.scanned(df, spark.createDataFrame([(5, passage)], "item_id long, text string"), terms=13)
    assert rows(got, "doc_id", "n_hit", "n_near") == [(1, 13, 0), (2, 0, 1)]


# op9


def plain_shape(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(repeated), failed


def test_quality(docs, plain, labels):
    got = quality.judged(docs, labels)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(got, *columns) == sorted(((d, *plain_shape(t)) for d, t, *_ in plain), key=repr)
    assert not got.where("base_failed and kept").count()
    assert got.where("kept is null").count() == 0


def test_ratio_is_that_of_the_multinomials(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "c d"), (3, None)], "doc_id long, text string")
    sample = spark.createDataFrame([(1, True)], "doc_id long, good boolean")
    found = quality.weights(docs, sample, buckets=64)
    grams = {1: [], 2: []}
    for r in quality.grams(docs.where("text is not null").selectExpr("doc_id", "split(text, ' ') words"), 64).collect():
        grams[r.doc_id] += [r.one] + ([] if r.two is None else [r.two])
    assert len(grams[1]) == 5 and len(grams[2]) == 3
    raw, good = Counter(grams[1] + grams[2]), Counter(grams[1])
    for b in range(64):
        want = np.log((good[b] + 1) / (len(grams[1]) + 64)) - np.log((raw[b] + 1) / (len(grams[1]) + len(grams[2]) + 64))
        assert abs(found[b] - want) < 1e-12


def test_limit_is_of_trusted_documents_kept_back_that_pass_the_base_rules(spark, monkeypatch):
    long = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    docs = [(k, long(k)) for k in range(100)] + [(k, f"short {k}") for k in range(100, 160)] + [(k, long(k % 100)) for k in range(160, 190)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    sample = docs.selectExpr("doc_id", "true good")
    back = {r.doc_id for r in docs.where(quality.kept_back()).collect()}
    fold = [r for r in docs.collect() if r.doc_id in back]
    assert 20 < len(fold) < 60 and any(r.doc_id >= 100 for r in fold)
    counted = {r.text for r in docs.collect() if r.doc_id not in back}
    # Short ones, counted ones and copies of counted ones are all lower than the others.
    value = {r.text: 0.5 for r in fold if r.text not in counted and r.doc_id < 100}
    assert value and len(value) < sum(r.doc_id < 100 or r.doc_id >= 160 for r in fold)
    scores = spark.createDataFrame([(r.text, value.get(r.text, -1.0)) for r in docs.dropDuplicates(["text"]).collect()], "text string, ratio double")
    scored = scores.select(*quality.key_of(scores.text), "ratio")
    assert quality.threshold(docs, sample, scored) == 0.5
    seen, weigh = [], quality.weights
    monkeypatch.setattr(quality, "weights", lambda d, s: seen.append({r.doc_id for r in s.where("good").collect()}) or weigh(d, s))
    quality.judged(docs, docs.selectExpr("doc_id", "1 quality"))
    assert seen == [{r.doc_id for r in docs.collect()} - back]


# op2


def test_main_text():
    page = (
        "<html><head><title>T</title><style>p{}</style><script>x='</p>'</script></head><body><header><a href=/>Home</a> Site</header>"
        "<nav><ul><li><a href=/a>One two</a></li><li><a href=/b>Two</a></li></ul></nav><div class='side-bar sidebar'><p>"
        + "aside words " * 20 + "</p></div><div class=\"ad\">Buy this now</div><main><h2>Head</h2><p>Fish &amp; chips,&nbsp; w<i>or</i>ld<br>end &lt;b&gt;"
        "<p>Second.</p><div class='comments'><p>" + "I like it " * 20 + "</p></div><form><p>subscribe</p></form><!-- <p>no</p> --></main><footer>&copy; me</footer>"
    )
    node = html.tree()
    assert html.main_text(page, node) == "Head\nFish & chips, world end <b>\nSecond."
    assert html.main_text(None, node) == html.main_text("", node) == ""
    assert all(html.decide(node, r[:-1]) == r[-1] for r in html.LABELLED)


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in html.extracted(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        want = "".join(re.sub("<[^>]*>", " ", article).split())
        import html as plain

        assert "".join(got[page.page_id].text.split()) == "".join(plain.unescape(want).split())
        assert got[page.page_id].n_chars == len(got[page.page_id].text)
    odd = spark.createDataFrame([(None, None, None), (1, "u", ""), (2, None, "<p>a <b"), (2, None, "x < y & z")], "page_id long, url string, html string")
    assert rows(html.extracted(odd), "page_id", "n_chars")[-1] == (None, 0)


def test_articles_of_loose_pages_are_found():
    node, words = html.tree(), " ".join(["Long plain words of the article."] * 8)
    said = lambda page: html.main_text(page, node)
    article = f"<article><p>{words}</p></article>"
    for page in (
        f"<head><title>t</title><body>{article}",
        f"<html><head><meta charset=utf-8><title>t<body>{article}<svg><title>x</title></svg>",
        f"<body><button>Menu {article}<button>x</button>",
        f"<body><select><option>One {article}",
        f"<body><iframe src=x>{article}",
        f"<body><!-- never closed {article}",
        f"<body><svg><p></p><svg><text>no</text></svg>{article}<svg/>",
        f"<body><!-->{article}<!-- closed -->",
        f"<body><div class='layout with-sidebar'><p>{words}</p></div>",
        f"<body><div class='page has-comments no-share'><p>{words}</p></div>",
        f"<body><div class='sidebar-layout'>{article}</div>",
        f"<body><form action=/ id=aspnet><main><p>{words}</p></main></form>",
    ):
        assert said(page) == words, page
    assert said(f"<body>{article}<p class='advert'>{words} Buy.</p><p>{words}</p>") == f"{words}\n{words}"
    assert said(f"<body>{article}<ul><li class=sponsor><p>{words}</p><li>{words}</ul>") == f"{words}\n{words}"
    assert said(f"<body>{article}<div class=comments><article><p>{words} Me too.</p></article></div>") == words
    assert said(f"<body><svg><svg><text>no</text></svg><text>{words}</text></svg><script>'<script>{words}'</script>{article}") == words


# op3


def test_scores(docs, plain):
    got = [r.asDict() for r in scoring.scores(docs).collect()]
    assert len(got) == len(plain)
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    words = [[*WORD.findall(lower(t)), None] for _, t, *_ in plain]
    n = Counter(w for (d, *_), own in zip(plain, words, strict=True) if not out(d) for w in own)
    total, kinds = sum(n.values()), len(n)
    base = lambda own: sum(np.log10((n[w] + 1) / (total + kinds + 1)) for w in own)
    want = sorted(((d, out(d), len(own), sum(n[w] > 0 for w in own), total, round(base(own), 3)) for (d, *_), own in zip(plain, words, strict=True)), key=repr)
    key = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    assert sorted(((*(r[k] for k in key), round(r["base_score"], 3)) for r in got), key=repr) == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_model_beats_its_base(documents):
    held = scoring.scores(documents).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert held.s > held.b


def plain_ratios(counts, upto=5):
    """Katz's discounts: Good-Turing's expected count over the count, scaled so that counts past ``upto`` keep theirs."""
    times, out = Counter(counts), [1.0] * (upto + 1)
    past = (upto + 1) * times[upto + 1] / times[1] if times[1] else 1.0
    for r in range(1, upto + 1):
        if times[r] and past < 1:
            ratio = ((r + 1) * times[r + 1] / (r * times[r]) - past) / (1 - past)
            out[r] = ratio if 0 < ratio <= 1 else 1 - 0.5 / r
    return out


def plain_katz(texts):
    """P(w | u, v) by the counts of ``texts`` (lists of words), as a function; None is the end."""
    three = Counter(g for own in texts for g in zip([None, None, *own], [None, *own], [*own, None], strict=False))
    two, one = Counter(), Counter()
    for (_, v, w), n in three.items():
        two[v, w] += n
        one[w] += n
    all_ = sum(one.values()) + len(one) + 1
    r3, r2 = (plain_ratios(x.values()) for x in (three, two))
    cut = lambda n, r: n * (r[n] if n < len(r) else 1.0)

    def level(grams, ratio, history, w, lower):
        follow = {g[-1]: n for g, n in grams.items() if g[:-1] == history}
        total = sum(follow.values())
        if not total:
            return lower(w)
        left = 1 - sum(cut(n, ratio) for n in follow.values()) / total
        scale, left = (1 - 1e-6, 1e-6) if left < 1e-9 else (1, left)
        return cut(follow[w], ratio) / total * scale if w in follow else left / (1 - sum(map(lower, follow))) * lower(w)

    p1 = lambda w: (one[w] + 1) / all_
    p2 = lambda v, w: level(two, r2, (v,), w, p1)
    return (lambda u, v, w: level(three, r3, (u, v), w, lambda x: p2(v, x))), one


def test_words_not_their_classes_are_scored(spark):
    """Words that share ending, length and count differ by what stood before them, one word or two words back."""
    rng = np.random.default_rng(8)
    name = lambda k: f"{'abcdefghij'[k // 10]}{'klmnopqrst'[k % 10]}ing"
    texts = [" ".join(name(int(k)) for k in (np.cumsum(rng.integers(1, 3, 14)) * 7 + i) % 40) for i in range(80)] + ["new words aking", "", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts * 2)], "doc_id long, text string").repartition(5)
    out = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    p, one = plain_katz([(t or "").split() for k, t in enumerate(texts * 2) if not out(k)])
    for u, v in ((None, None), ("akoing", None), (name(7), name(14)), (name(3), name(30))):
        assert abs(sum(p(u, v, w) for w in [*one, "unknown"]) - 1) < 1e-9
    got = scoring.scores(docs).collect()
    assert {r.held_out for r in got} == {True, False}
    for r in got:
        own = ((texts * 2)[r.doc_id] or "").split()
        want = sum(np.log10(p(*g)) for g in zip([None, None, *own], [None, *own], [*own, None], strict=False))
        assert abs(r.score - want) < 1e-6 * max(1, abs(want))


# op5


def plain_secrets(text):
    out = []
    text = text or ""
    for k, (kind, pattern) in enumerate((("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+"))):
        for m in re.finditer(pattern, text, re.A | (re.I if kind == "assign" else 0)):
            if len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24):
                out.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_secrets(spark, docs, plain):
    network = secrets.trained(n=300)
    more = [(900 + k, t) for k, t in enumerate(["TOKEN: abcdef", "é api_key='x1y2z3' AKIA" + "A1" * 9, "api_key = short", "paſſword=abcdefgh", "f" * 23, "f" * 30 + "g" + "0" * 24])]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = rows(secrets.scanned(every, network), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    want = []
    for d, t in [(d, t) for d, t, *_ in plain] + more:
        s = plain_secrets(t)
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        want.append((d, *(sum(k == kind for k, *_ in s) for kind in ("assign", "access", "hex")), hashlib.sha256(told.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_every_token_is_a_candidate():
    """Short, letter-only and sign-bearing tokens and what patterns leave of a token; scores by batch as one by one."""
    network = secrets.trained(n=900)
    texts = ["", "a b", "the pwd: Xk9mQ2vT is set", "bob:s3cr3tPw@host", "AbCdEfGhIjKlMnOpQrStUvWx", "x9$Kq!2mZ&7pLw#4 no", "token=abc123~restofsecretABC99",
             "é" * 7 + "\n" + "abcdefg " * 5000, "x" * 70_000 + " \U0001f600" * 9, "abcdef" + "a0" * 12 + " 123456token=abcdef"]
    for text in texts:
        base = secrets.base_spans(text)
        spans = secrets.candidates(text, base)
        free = [not any(a <= i < b for a, _, b in base) and c not in " \t\n\r\x0b\x0c" for i, c in enumerate(text)]
        expected, start = [], None
        for i, ok in enumerate([*free, False]):
            if ok and start is None:
                start = i
            elif not ok and start is not None:
                expected += [(start, i)] if i - start >= 6 else []
                start = None
        assert spans == expected, text[:40]
        some = spans[:: max(1, len(spans) // 40)]
        one = [network.probability(secrets.window(text, a, b)) for a, b in some]
        batch = dict(zip(spans, network.probabilities(text, spans), strict=True))
        assert all(abs(batch[s] - p) < 1e-3 for s, p in zip(some, one, strict=True))


def test_network_finds_held_out_secrets():
    network = secrets.trained()
    fresh = [(network.probability(secrets.window(t, a, b)) >= network.threshold, y) for t, a, b, y in secrets.labelled_findings(600, seed=99)]
    assert sum(f for f, y in fresh if y) / sum(y for _, y in fresh) >= 0.9
    assert sum(f for f, y in fresh if not y) / sum(not y for _, y in fresh) <= 0.05


# op7


def test_language(docs, plain):
    got = [r.asDict() for r in language.identified(docs).collect()]
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, *_ in plain)
    learned = {x for d, t, _, x in plain if x and t is not None}
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in learned | {"und"} for r in got)
    blank = {d for d, t, *_ in plain if not any(c.isalpha() for c in t or "")} - {d for d, t, *_ in plain if any(c.isalpha() for c in t or "")}
    assert all(r["lang_pred"] == "und" for r in got if r["doc_id"] in blank)


def test_language_of_held_out_documents(documents):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in language.identified(documents).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_unseen_words_fall_back_to_shorter_pieces():
    vector = lambda *x: np.array(x, np.float32)
    model = language.Model(["a", "b"], {0: {"known": vector(-1, -9)}, 2: {"<k": vector(-3, -2)}, 3: {"ing": vector(-5, -1)}})
    assert list(model.vector("known")) == [-1, -9]
    assert list(model.vector("king")) == [-5, -1]
    assert list(model.vector("kk")) == [-3, -2]
    assert list(model.vector("zz")) == [0, 0]


# op10


def test_line_dedup(docs, plain):
    got = [r.asDict() for r in lines.deduplicated(docs).collect()]
    want = Counter(d for d, *_ in plain)
    assert Counter(r["doc_id"] for r in got) == want
    left = Counter()
    for r in got:
        for line in r["text"].split("\n"):
            left[line] += 1
    norm = lambda s: re.sub(r"[\W_]+", " ", re.sub("[1-9]", "0", s.lower())).strip()
    seen = Counter(norm(k) for k, v in left.items() for _ in range(v))
    assert all(v == 1 for k, v in seen.items() if k and k.isascii())
    assert sum(r["n_lines"] for r in got) == sum((t or "").count("\n") + 1 for _, t, *_ in plain)


def test_fuzzy_lines(spark):
    line = "the quick brown fox jumps over the lazy dog and runs on through fields of corn until evening comes"
    texts = [line + "\nother words entirely here", line.replace("quick", "quickk") + "\nx9", line.upper() + "\nx1\n***\n***", "all new"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.dropped for r in lines.deduplicated(df).collect()}
    assert got == {0: [], 1: [0], 2: [0, 1], 3: []}


def test_main_text_of_deep_pages_takes_linear_time():
    """Closing tags of elements that are not open, under 50,000 open ones."""
    for page in ("<div>" * 50_000 + "text </section>" * 50_000, "<ul><li>" + "<div>" * 50_000 + "text </li><dd>" * 50_000):
        start = time.monotonic()
        found = html.blocks(page)
        assert time.monotonic() - start < 20  # a second or so; minutes where each tag looks through all
        assert len(found) == 50_000


def plain_vector(tables, langs, word):
    for length in (0, *range(language.LONGEST, 0, -1)):
        parts = [word] if length == 0 else language.pieces(word, length)
        known = [tables[length][p] for p in parts if p in tables.get(length, {})]
        if known:
            return np.mean(known, axis=0)
    return np.zeros(langs, np.float32)


def test_words_of_a_batch_get_the_frequencies_of_each_alone():
    random = np.random.default_rng(3)
    texts = ["".join(random.choice(list("abcdeé"), size=n)) for n in random.integers(1, 9, 400)]
    tables = {}
    for word in texts[:60]:
        for length in range(language.LONGEST + 1):
            for p in [word] if length == 0 else language.pieces(word, length):
                tables.setdefault(length, {})[p] = random.random(3).astype(np.float32)
    rows_ = language.Model(["x", "y", "z"], tables).rows()
    words = [*texts, "Ω", "ΩΩΩΩΩΩΩ"]
    np.testing.assert_allclose(
        language.vectors(rows_, words, 3), [plain_vector(tables, 3, w) for w in words], rtol=1e-5)
    assert language.vectors({}, ["a"], 2).tolist() == [[0, 0]] and language.vectors(rows_, [], 3).shape == (0, 3)


def test_quality_takes_every_label(spark):
    labels = spark.range(41_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    got = {r.good: r["count"] for r in quality.labelled(labels).groupBy("good").count().collect()}
    assert got == {True: 20_500, False: 20_500}


def test_quality_limit_is_the_percentile(spark):
    from pyspark.sql import functions as F

    docs = spark.range(900).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 60), i -> concat('w', id, 'x', i))) as text")
    sample = docs.selectExpr("doc_id", "true as good")
    scored = docs.select(*quality.key_of(F.col("text")), (F.col("doc_id") / 7).alias("ratio"))
    back = scored.join(docs.where(quality.kept_back()).select(*quality.key_of(F.col("text"))), ["k1", "k2"])
    want = back.agg(F.percentile("ratio", F.lit(0.013))).first()[0]
    assert quality.threshold(docs, sample, scored, 0.013) == pytest.approx(want, rel=1e-12)
