"""The operators against brute force on small fixtures: nulls, empty and long texts, ties, repeated rows, clashing names."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import compare, oracle_connection
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, extraction, importance, mixing, pii_anchors, queries, secret_scan, suffix_dedup, tensored_minhash, url_filter, vector_graph
from corpusloom.llm import common

ROOT = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans(common.UPPER, common.LOWER)


def words_of(n, seed, vocabulary=5000):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with nulls, an empty text, a long one, repeats, and columns named like those that operators add."""
    rows = [(1, "Some plain words here.", "a"), (1, "Some plain words here.", "a"), (2, None, "b"), (3, "", None), (None, "no id here", "a"), (4, "word " * 60_000, "b"), (5, "é" * 3, "c")]
    frame = documents(spark, rows)
    return frame.select("*", *[F.lit(7).alias(c) for c in ("size", "taken", "key", "id", "hits", "items", "pii", "secrets", "levels", "rank", "n_words", "kept")])


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, name):
    state, text, _ = compare(spark, oracle_connection(ROOT), ROOT, name, queries.QUERIES[name], queries.ORACLES[name])
    assert state == "ok" and "TYPES" not in text, text


def test_odd_rows(spark, odd):
    benchmark = spark.createDataFrame([(1, "no id here"), (None, None), (2, "")], "item_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id bigint, quality int, toxic int")
    for frame in (odd, odd.limit(0)):
        n = frame.count()
        assert mixing.mix_sources(frame).count() == n
        assert secret_scan.secret_digest(frame).count() == secret_scan.redact_secrets(frame).count() == n
        assert pii_anchors.pii_digest(frame).count() == n
        assert decontamination.leak_digest(frame, benchmark).count() == decontamination.leak_digest(frame, benchmark.limit(0)).count() == n
        assert decontamination.leak_digest(frame, benchmark).where("contaminated").count() == (1 if n else 0)
        assert suffix_dedup.remove_repeats(frame).count() == n
        assert tensored_minhash.near_duplicates(frame).count() == n
        scores, kept = importance.resample(frame, labels)
        assert scores.count() == kept.count() == n and kept.columns == frame.columns


def test_kth_largest(spark):
    values = [random.Random(3).gauss(0, 1) for _ in range(3000)] + [0.25] * 50
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 40, 1500, 3050):
        assert importance.kth_largest(frame, "x", k, bins=16) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(frame, "x", 3051) is None


def test_importance_features_hold_bigrams():
    got = {}
    for numbers, buckets, _ in importance.feature_pairs([t.encode() for t in ("alpha beta gamma", "gamma beta alpha", "", "x")]):
        for n, b in zip(numbers, buckets):
            got.setdefault(int(n), set()).add(int(b))
    # the same words in another order are other features; three words hold two bigrams besides the three words
    assert got[0] != got[1] and len(got[0] - got[1]) == 2 and len(got[0]) == 6 and 2 not in got and len(got[3]) == 2


def test_importance_task_holds_a_bounded_count(monkeypatch):
    import pyarrow as pa

    read = []

    def batches():
        for b in range(40):
            read.append(b)
            texts = [words_of(60, 100 * b + i, 50_000) for i in range(20)] + [None, ""]
            yield pa.RecordBatch.from_arrays([pa.array(range(100 * b, 100 * b + 22), pa.int64()), pa.array(texts)], names=["doc_id", "text"])

    def summed(out):
        got = {}
        for batch in out:
            for b, r, t, c in zip(*(batch.column(k).to_pylist() for k in range(4))):
                old = got.get(b, (0, 0, 0))
                got[b] = (old[0] + r, old[1] + t, old[2] | c)
        return got

    chosen = np.arange(0, 4000, 3, dtype=np.int64)
    whole = summed(importance.task_counts(batches(), chosen))
    monkeypatch.setattr(importance, "MERGE_AT", 2000)
    read.clear()
    stream = importance.task_counts(batches(), chosen)
    first = next(stream)
    # rows leave the task long before its input ends, and Spark's sum of them is the same count
    assert first.num_rows and len(read) < 40
    assert summed([first, *stream]) == whole and whole[-1] == (880, 294, 0)


def test_importance_rejects_what_the_target_lacks(spark):
    rows, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        rows.append((i, words_of(40, i, 300) + (f" clown {words_of(3, 10_000 + i, 300)} clown" if bad else ""), "s"))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    scores, kept = importance.resample(documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert {r[0] for r in kept.select("doc_id").collect()} == {i for i in range(1500) if i % 5}
    assert scores.count() == 1500


def test_extraction(spark):
    tree = extraction.train_tree(spark)
    page = """<html><head><title>T</title><style>p{}</style></head><body><div id="cookie-banner"><p>We use cookies on this site to make it better for all.</p></div>
    <nav><a href=x>Home</a></nav><article><header><h1>Big &amp; small</h1></header><p>One <b>bold</b>
    word.<p>Two &lt;three&gt;<br>four.<div class="ad-slot">Buy now and save a lot of money on this offer.</div><!-- no --><script>x("</p>")</script></article>
    <section class="comments"><p>I like this article very much and want to say so here.</p></section><aside><p>Other things to read on this site.</p></aside></body>"""
    assert extraction.main_text(page, tree) == "Big & small\nOne bold word.\nTwo <three> four."
    assert extraction.main_text(None, tree) == extraction.main_text("", tree) == ""
    plain = f"<ul><li><a href=1>a</a></li></ul><div><p>{words_of(40, 1)}.</p><p>{words_of(30, 2)}.</p></div><p><a href=2>{words_of(30, 3)}</a></p>"
    assert extraction.main_text(plain, tree) == f"{words_of(40, 1)}.\n{words_of(30, 2)}."


def test_extraction_of_frames_with_furniture_words(spark):
    tree = extraction.train_tree(spark)
    text = [f"{words_of(n, n)}." for n in (40, 30)]
    inner = "".join(f"<p>{t}</p>" for t in text) + f"<div class='Sidebar'><p>{words_of(12, 1)}.</p></div>"
    for page in (
        f"<html class='no-ads'><body class='has-sidebar'><article>{inner}</article></body></html>",
        f"<body id=page><main role='main' class='share'><article class='post comments-open tags'>{inner}</article></main></body>",
        f"<div data-id='sidebar' data-role=form title='a class=ad id=menu'><article>{inner}</article></div>",
    ):
        assert extraction.main_text(page, tree) == "\n".join(text), page


@pytest.mark.parametrize("seed", range(3))
def test_fm_index(seed):
    text = np.random.RandomState(seed).randint(1, 5, 400)
    index = decontamination.FMIndex(text)
    for n in (1, 2, 5):
        phrases = np.unique(np.lib.stride_tricks.sliding_window_view(text, n), axis=0)
        phrases = np.concatenate((phrases, np.full((1, n), 9)))
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high):
            want = [k for k in range(len(text) - n + 1) if (text[k : k + n] == p).all()]
            assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_remove_leaks(spark):
    leak = words_of(14, 99)
    benchmark = spark.createDataFrame([(1, leak), (2, "short item")], "item_id bigint, text string")
    rows = [(1, f"Start of it, {leak.upper()}! The end."), (2, words_of(50, 5)), (3, leak), (4, "a short   ITEM, here")]
    out = {r.doc_id: r for r in decontamination.remove_leaks(documents(spark, [(i, t, "s") for i, t in rows]), benchmark).collect()}
    assert {i: r.text for i, r in out.items()} == {1: "Start of it, ! The end.", 2: rows[1][1], 4: "a , here"}
    assert all(r.n_chars == len(r.text) for r in out.values())
    blocks = decontamination.find_leaks(documents(spark, [(i, t, "s") for i, t in rows]), benchmark, block_bytes=1)
    assert {r.doc_id: r["items"] for r in blocks.collect()} == {1: ["1"], 2: [], 3: ["1"], 4: ["2"]}


def test_suffix_dedup(spark):
    shared, pick = words_of(150, 1), random.Random(4)
    rows = [(i, f"{words_of(60, 100 + i)} {shared[i * 3 : 500 + 40 * i]} {words_of(60, 200 + i)}") for i in range(8)]
    rows += [(20, "ab" * 700), (21, "x" * 399), (22, "x" * 399), (23, None), (24, "é" * 300), (None, words_of(300, 7)), (25, words_of(300, 7)), (25, words_of(300, 7))]
    rows += [(30 + k, "".join(pick.choice("ab") for _ in range(900)) + shared[:401]) for k in range(3)]
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[k : k + 400] for t in texts for k in range(len(t) - 399))
    want = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 399):
            if count[t[k : k + 400]] > 1:
                gone[k : k + 400] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        want.append((i, len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.remove_repeats(documents(spark, [(i, t, "s") for i, t in rows])).collect()
    assert Counter(map(tuple, got)) == Counter(want)


def test_suffix_dedup_of_repeated_rows_in_other_batches(spark):
    texts = {1: words_of(100, 30)[:400], 2: words_of(300, 31), 3: words_of(300, 32)}
    rows = [(i, texts[i], "s") for i in (1, 1, 2, 2, 3)]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 1)  # every interval is a batch
    try:
        got = suffix_dedup.remove_repeats(documents(spark, rows)).collect()
    finally:
        spark.conf.set(name, before)
    assert all(r.n_removed == (0 if r.doc_id == 3 else r.n_bytes) for r in got) and len(got) == 5, got


def test_mixing_targets(spark):
    sizes = {"a": 1000, "b": 10, "c": 200, None: 50, "d": 0}
    rows = [(k, " ".join(["w"] * (n // 10)), s) for s, n in sizes.items() for k in range(hash(str(s)) % 1000, hash(str(s)) % 1000 + 10)]
    out = mixing.mix_sources(documents(spark, rows)).collect()
    weight = dict(zip(["a", "b", "c", "d", None], (1, 2, 3, 1, 2)))
    total, fixed = sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        open_ = {s: w for s, w in weight.items() if s not in fixed}
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = {s: 3 * sizes[s] for s, x in share.items() if x > 3 * sizes[s]}
        if not over:
            break
        fixed |= over
    for s, want in (fixed | share).items():
        mine = [r for r in out if r.source == s]
        assert all(math.isclose(r.target, want, rel_tol=1e-12) and r.taken <= 3 * r["size"] for r in mine)
        assert abs(sum(r.taken for r in mine) - want) <= 1


def test_vector_graph(spark):
    r = np.random.RandomState(1)
    base = r.normal(size=(300, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(base)] + [(1000 + k, (base[0] + 0.03 * r.normal(size=16)).tolist()) for k in range(80)]
    rows += [(2000 + k, base[5].tolist()) for k in range(5)] + [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] * 16), (3003, [1.0]), (3004, [2.0]), (None, base[5].tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    out = vector_graph.near_vectors(frame, shard=60)
    got = {x.vec_id: x for x in out.collect()}
    ids = [i for i, _ in rows if i is not None and i < 3000]
    x = vector_graph.unit_rows(np.array([v for i, v in rows if i is not None and i < 3000]))
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    found = sum(got[i].n_links for i in ids)
    assert 0.95 * near.sum() <= found <= near.sum() and all(got[i].n_links <= n for i, n in zip(ids, near.sum(1)))
    assert all(got[1000 + k].component_id == 0 for k in range(80)) and all(got[2000 + k].component_id == 5 for k in range(5))
    assert got[3003].n_links == 1 and got[3004].component_id == 3003 and not got[3004].kept
    assert all(got[i].n_links == 0 and got[i].kept for i in (3000, 3001, 3002)) and got[None].n_links == 0
    assert vector_graph.audit_recall(frame, out) >= 0.95
    assert vector_graph.near_vectors(frame.limit(0)).count() == 0


def test_vector_pairs_meet_with_many_centres():
    r = np.random.RandomState(3)

    def rows(n):
        return vector_graph.unit_rows(groups[r.randint(0, 10, n)] + r.normal(size=(n, 64)))

    groups = 0.3 * r.normal(size=(10, 64))
    a, w = rows(1500), r.normal(size=(1500, 64))
    w = vector_graph.unit_rows(w - (w * a).sum(1, keepdims=True) * a)
    b = 0.9 * a + np.sqrt(1 - 0.9**2) * w
    share = {}
    for k in (5, 50, 1000):
        centre = rows(k)
        margin = vector_graph.probe_margin(centre, rows(1500))
        sides = [[vector_graph.places(u, centre, m) for u in x] for x, m in ((a, margin), (b, margin), (a, 0.0))]
        share[k] = [np.mean([bool(set(near[1]) & set(v[0])) for near, v in zip(x, sides[1])]) for x in (sides[0], sides[2])]
    assert all(x[0] >= 0.98 for x in share.values()), share
    assert share[1000][1] < 0.9  # what the fixed number of probes reaches


def test_url_filter(spark):
    urls = ["http://A.Example.com/en/x?q#f", "https://www.example.com/en/1", "http://x.net/es/", "ftp://y.org", None, "no scheme", "http://com?x", "http://example.com#/en/", "http://xcom/", "http://spam-farm.example.org/a"]
    pages = spark.createDataFrame([(k, u, 0) for k, u in enumerate(urls)], "page_id bigint, url string, rule int")
    named = [(*r, True) for r in url_filter.RULES] + [(*s, "block", False) for s in url_filter.BAD_SITES]
    entries = spark.createDataFrame(named, "host string, path string, verdict string, named boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, entries, blocks=2).collect()}
    assert got == {
        0: ("a.example.com", "/en/x", "example.com/en/", "block"), 1: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 2: ("x.net", "/es/", "net/es/", "block"),
        3: ("y.org", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("com", "", None, "allow"), 7: ("example.com", "", None, "allow"),
        8: ("xcom", "/", None, "allow"), 9: ("spam-farm.example.org", "/a", None, "block"),
    }


# The base patterns of the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def test_pii():
    anchors, pick = pii_anchors.automaton(), random.Random(1)
    for _ in range(20_000):
        t = "".join(pick.choice("0123a@.+-( )5x %_4é") for _ in range(pick.randint(0, 40)))
        want = [("email", m.start(), m.end()) for m in EMAIL.finditer(t)]
        want += [("ip", m.start(), m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
        want += [("card", m.start(), m.end()) for m in CARD.finditer(t) if 13 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and pii_anchors.luhn(d)]
        want += [("phone", m.start(), m.end()) for m in PHONE.finditer(t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
        assert [s for s in pii_anchors.find_spans(t, anchors) if s[0] in pii_anchors.BASE_KINDS] == want
    t = "see ftp://bob:pw1@host/x, IBAN: GB82 WEST 1234 5698 7654 32. SSN 123-45-6789"
    assert [(k, t[a:b]) for k, a, b in pii_anchors.find_spans(t, anchors)] == [("login", "bob:pw1"), ("account", "GB82 WEST 1234 5698 7654 32"), ("ssn", "123-45-6789")]


def entropy(s, width=20):
    best = 0.0
    for k in range(len(s) - width + 1):
        best = max(best, -sum(v / width * math.log2(v / width) for v in Counter(s[k : k + width]).values()))
    return best


def test_secrets(spark):
    pick = random.Random(2)
    parts = ["password", "Token", "api_key", "=", ": ", '"', "abc", "AKIA", "ABCDEFGH12345678", "0123abcdef", "deadbeef99", " ", "é", "key"]
    rows = [(k, "".join(pick.choice(parts) for _ in range(pick.randint(1, 25)))) for k in range(400)]
    got = {r.doc_id: r for r in secret_scan.secret_digest(documents(spark, [(k, t, "s") for k, t in rows])).collect()}
    for k, t in rows:
        spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[1]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
        assert got[k].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (t, text, got[k].spans)
        assert Counter(s[3] for s in spans) == Counter({"assign": got[k].n_assign, "access": got[k].n_access, "hex": got[k].n_hex})
    letters = "0123456789abcdef"
    strings = ["".join(pick.choice(letters) for _ in range(pick.randint(20, 60))) for _ in range(20)] + ["a" * 30]
    frame = spark.createDataFrame([(s,) for s in strings], "s string").select("s", secret_scan.highest_entropy(F.col("s"), letters).alias("h"))
    assert all(math.isclose(r.h, entropy(r.s), abs_tol=1e-8) for r in frame.collect())
    red = secret_scan.redact_secrets(documents(spark, [(1, "a password=abcdef99 b token: zzzzzzz", "s"), (2, "clean", "s")])).orderBy("doc_id").collect()
    assert [r.text for r in red] == ["a [SECRET] b [SECRET]", "clean"] and all(r.n_chars == len(r.text) for r in red)


def test_secrets_of_every_class(spark):
    pick, lower, digits = random.Random(5), "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = ["0123456789abcdef", lower.upper() + digits, lower + lower.upper() + digits, lower + digits, lower + "234567", lower + digits + "_-", lower.upper() + digits + "-/+"]
    strings = ["".join(pick.choice(a) for _ in range(23)) + "k7"[a[0] == "0" :] for a in alphabets] + ["k3j9x7q2m5w8z1r4t6y0", "7KQ2-M9XD-4TLB-W8Z3-HN5C"]
    plain = ["/2020/05/some-article-title", "blog-post-about-our-trip-2024", "MAX_RETRY_COUNT_2_DEFAULT"]
    rows = [(k, f"see {s} there", "s") for k, s in enumerate(strings + plain)]
    got = {r.doc_id: r.text for r in secret_scan.redact_secrets(documents(spark, rows)).collect()}
    assert [got[k] for k in range(len(rows))] == ["see [SECRET] there"] * len(strings) + [f"see {s} there" for s in plain]


@pytest.mark.parametrize("size", [2, 5])
def test_minhash(spark, size):
    rows, pick = [], random.Random(size)
    for k in range(60):
        w = words_of(pick.randint(5, 120), k).split()
        for c in range(pick.randint(1, 6)):
            v = list(w)
            for _ in range(pick.randint(0, 4)):
                v[pick.randrange(len(v))] = f"x{pick.randrange(99)}"
            rows.append((k * 10 + c, " ".join(v)))
    rows += [(5000, None), (5001, ""), (5002, "One"), (5003, "oNE"), (None, rows[0][1])]
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    up = {i: i for i in sets if i is not None}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in up:
        for b in up:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    got = {r.doc_id: r for r in tensored_minhash.near_duplicates(documents(spark, [(i, t, "s") for i, t in rows]), size).collect()}
    assert {i: got[i].component_id for i in up} == {i: top(i) for i in up}
    assert all(got[i].n_shingles == len(s) and got[i].kept == (i is None or top(i) == i) for i, s in sets.items())


def test_prefix_pairs(spark):
    pick = random.Random(11)
    base = [pick.getrandbits(64) for _ in range(120)]
    sets = []
    for k in range(150):  # a crowd of variants of one set, most of them under the threshold to each other, and a few small sets
        kept = pick.sample(base, 120 - pick.choice((2, 5, 10, 14, 30)))
        sets.append(set(kept) | {pick.getrandbits(64) for _ in range(pick.choice((0, 3, 12, 25)))})
    sets += [set(base[:k]) for k in range(1, 12)]
    likeness = {(x, y): (len(sets[x] & sets[y]), len(sets[x] | sets[y])) for x in range(len(sets)) for y in range(x + 1, len(sets))}
    close = {p for p, (both, either) in likeness.items() if 100 * both >= 80 * either}
    rows = [(k, np.sort(np.array(list(s), np.uint64)).tobytes()) for k, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "id bigint, members binary")
    pairs = tensored_minhash.prefix_pairs(frame, frame.select("id", F.col("id").alias("component")), 80)
    got = {(r.a, r.b) for r in pairs.collect()}
    assert close and close <= got and len(got) < len(likeness) // 2
    assert {(r.a, r.b) for r in tensored_minhash.confirm(pairs, frame, 80).collect()} == close
    one = tensored_minhash.prefix_pairs(frame, frame.select("id", F.lit(0).cast("bigint").alias("component")), 80)
    assert one.isEmpty() and tensored_minhash.prefix_pairs(frame.limit(0), frame.select("id", F.col("id").alias("component")), 80).isEmpty()


def test_components(spark):
    pick = random.Random(5)
    edges = [(pick.randrange(200), pick.randrange(200)) for _ in range(110)] + [(500 + k, 501 + k) for k in range(40)] + [(900, 900 + k) for k in range(60)]
    up = {v: v for e in edges for v in e}

    def top(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: top(v) for v in linked}


def test_importance_counts_only_buckets_that_can_be_listed(spark):
    rows, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        rows.append((i, words_of(40, i, 300) + (f" clown {words_of(3, 10_000 + i, 300)} clown" if bad else ""), "s"))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    docs, labels = documents(spark, rows).repartition(4), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    ids = importance.target_ids(labels, importance.MOST_LABELS)
    whole = importance.feature_counts(docs, ids).collect()
    # the model of all counts, as before the heavy buckets were found first
    total = next(r for r in whole if r["bucket"] == -1)
    share = total["target"] / total["raw"]
    listed = sorted(
        (r["bucket"], np.log((r["target"] + 1) / (r["raw"] * share + 1)))
        for r in whole
        if r["bucket"] >= 0 and bin(r["contexts"] & (2**64 - 1)).count("1") >= importance.CONTEXTS and r["raw"] * share - r["target"] > importance.Z * np.sqrt(r["raw"] * share + 1) and np.log((r["target"] + 1) / (r["raw"] * share + 1)) <= importance.CUT
    )
    buckets, ratios = importance.ratio_model(docs, labels)
    assert listed and list(buckets) == [b for b, _ in listed] and np.allclose(ratios, [r for _, r in listed])
    heavy = importance.heavy_buckets(docs, 16.9 * total["raw"] / total["target"])
    assert set(buckets) <= set(heavy) and 0 < len(heavy) < len(whole) / 10
