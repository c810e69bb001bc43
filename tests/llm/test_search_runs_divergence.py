"""Top-k search, periodic runs and source divergence: brute force on small tables and odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import divergence, runs, topk
from hearth.llm.queries import ORACLES, QUERIES

CLASH = "c g dim norm block bucket term n docs p q chunk rank start period words".split()


def clashing(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


# ------------------------------------------------------------------ top-k

VEC = "vec_id long, embedding array<double>"


def brute_top_k(rows, k=5, every=50):
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(good):
        if i is None or i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), j is None, j or 0, j) for b, (j, p) in enumerate(good) if a != b and len(p) == len(q))
        out += [(i, r, j, -s) for r, (s, _, _, j) in enumerate(scored[:k], 1)]
    return Counter(out)


def vectors(seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) * 4 ** rng.uniform(-2, 2) for _ in range(6)]) for i in range(700)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)] + [rows[100]] * 3 + [(None, rows[150][1]), (None, rows[3][1])]
    rows += [(2000, None), (2050, [1.0, None]), (2100, [1.0, float("nan")]), (2150, [float("inf")] * 6), (2200, [0.0] * 6), (2250, []), (2251, []),
             (2300, [1.0, 2.0]), (2301, [0.5, -0.5]), (2350, [7.0, 7.0, 7.0]), (-50, [0.25] * 6)]
    return rows


@pytest.mark.parametrize("sizes", [(16384, 4096, 1024), (64, 4, 16)])
def test_top_k_equals_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("BUCKET", "BLOCK", "PART"), sizes):
        monkeypatch.setattr(topk, name, value)
    rows = vectors(5)
    found = topk.top_k(clashing(spark.createDataFrame(rows, VEC)))
    assert Counter(map(tuple, found.select("query_id", "rank", "id", "score").collect())) == brute_top_k(rows)


def test_top_k_prunes_by_coordinates_without_a_miss():
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(20, 8))
    codes = np.rint(np.repeat(centre, 50, axis=0) * 1000 + rng.normal(size=(1000, 8)) * 30).astype(np.int32)
    norm = np.sqrt((codes.astype(float) ** 2).sum(axis=1))
    unit = codes / norm[:, None]
    exact = codes.astype(np.int64) @ codes[:40].astype(np.int64).T
    threshold = np.sort(exact, axis=0)[-6]
    mask = topk.candidates(unit[:40], unit, norm[:40], norm, threshold)
    assert mask.T[exact >= threshold].all() and mask.mean() < 0.3


def test_top_k_of_an_empty_table_and_of_big_codes(spark):
    assert topk.top_k(spark.createDataFrame([], VEC)).count() == 0
    big = [(0, [60000.0, 60000.0]), (1, [60000.0, 59999.996]), (2, [60000.0, 59999.99]), (50, [70000.0, 0.0])]
    found = [tuple(r) for r in topk.top_k(spark.createDataFrame(big, VEC)).orderBy("rank").collect()]
    code = [[int(np.floor(256 * x)) for x in v] for _, v in big]
    assert found == [(0, 1, 1, sum(x * y for x, y in zip(code[0], code[1]))), (0, 2, 2, sum(x * y for x, y in zip(code[0], code[2])))]


# ------------------------------------------------------------------- runs

def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        k = 0
        while k + q < len(w):
            if w[k] == w[k + q]:
                s = k
                while k + q < len(w) and w[k] == w[k + q]:
                    k += 1
                if k + q - s >= max(6, 4 * q):
                    found.setdefault((s, k + q), q)
            k += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_row(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        a = h // 10 % len(w)
        p = 1 + (len(w) - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    longest = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *longest, sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_grammar_extensions_and_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        texts = []
        for _ in range(rng.randrange(1, 6)):
            k, n = rng.choice([1, 2, 3, 30]), rng.choice([0, 1, 5, 6, 7, 20, 80, 200])
            w = [rng.randrange(k) for _ in range(n)]
            if n > 20 and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randrange(1, 9)
                w = w[:a] + [w[min(n - 1, a + (i - a) % p)] for i in range(a, n)]
            texts.append(w)
        bounds = np.concatenate(([0], np.cumsum([len(w) for w in texts]))).astype(np.int64)
        s, e, q = runs.find_runs(np.array([x for w in texts for x in w], dtype=np.int64), bounds)
        want = sorted((int(b) + s_, n, q_) for b, w in zip(bounds, texts) for s_, n, q_ in brute_runs(w))
        assert list(zip(s.tolist(), (e - s).tolist(), q.tolist())) == want


def test_long_texts_of_one_word_and_of_a_long_period():
    n = 60_000
    s, e, q = runs.find_runs(np.zeros(n, dtype=np.int64), np.array([0, n]))
    assert list(zip(s, e, q)) == [(0, n, 1)]
    cycle = np.random.default_rng(1).permutation(7001)
    words = np.concatenate((np.arange(8000, 9000), np.tile(cycle, 5), np.arange(9000, 9005)))
    s, e, q = runs.find_runs(words, np.array([0, len(words)]))
    assert list(zip(s, e, q)) == [(1000, 1000 + 5 * 7001, 7001)]


ODD = [(1, None), (2, ""), (3, " \n\t\x0b"), (4, "a a a a a a"), (4, "a a a a a a"), (5, "é é é é é é x " * 20), (6, "x y " * 8), (None, "b " * 30),
       (None, None), (7, "go " * 1500 + "end"), *[(i, " ".join(f"w{j * 7 % (i + 3)}" for j in range(i * 3))) for i in range(10, 80)]]


def test_runs_of_odd_rows_equal_brute_force(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    found = runs.periodic_runs(clashing(df), rewrite=runs.repeat_tail).drop("n_words", "runs", "collapsed")
    assert Counter(map(tuple, found.collect())) == Counter(brute_row(i, t) for i, t in ODD)
    assert runs.periodic_runs(df.limit(0)).count() == 0
    plain = {r["id"]: r for r in runs.periodic_runs(df).where("id = 4").collect()}
    assert (plain[4]["runs"], plain[4]["collapsed"], plain[4]["n_words"]) == ("0,6,1\n", "a", 6)


def test_op12_equals_brute_force_on_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(map(tuple, QUERIES["op12_runs"](spark, sf).collect())) == Counter(brute_row(*r) for r in docs)


# ------------------------------------------------------------- divergence

def brute_divergence(rows, least=10, top=10):
    import re

    told = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {x[0] for x in told}:
        mine = [(s, w) for la, s, w in told if la == lang]
        docs = Counter(t for _, w in mine for t in set(w))
        kept = {t for t, n in docs.items() if n >= least}
        count = defaultdict(Counter)
        for s, w in mine:
            count[s].update(t for t in w if t in kept)
        whole = Counter(t for _, w in mine for t in w if t in kept)
        p = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            pairs = sorted((-sum(f(p(count[s], t), p(count[o], t)) for t in kept), o.encode()) for o in count if o != s)
            terms = sorted((-f(p(c, t), p(whole, t)), t.encode()) for c in [count[s]] for t in c if p(c, t) > p(whole, t))[:top]
            out += [(lang, s, part, i.decode(), -v, r) for part, x in (("pair", pairs), ("term", terms)) for r, (v, i) in enumerate(x, 1)]
    return Counter(out)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["É", "été", "日本", "😀x", "Straße"]
    rows = []
    for i in range(240):
        source = rng.choice(["web", "web", "web", "news", "code", None, ""])
        lang = rng.choice(["en", "en", "de", None])
        cut = 300 if source == "web" else rng.choice([40, 200])
        rows.append((" ".join(rng.choice(words[:cut] + words[-5:]).upper() if rng.random() < 0.2 else rng.choice(words[:cut]) for _ in range(rng.randrange(0, 90))), lang, source))
    return rows + [(None, "en", "empty"), ("", "xx", "a"), ("rare words", "xx", "b"), (None, None, None), ("12 34", "en", "digits"), ("flood " * 40_000, "en", "web")] + rows[:3] * 2


@pytest.mark.parametrize("sizes", [(1 << 15, 512, 1 << 20), (50, 7, 4)])
def test_divergence_equals_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("CHUNK_COUNTS", "CHUNK_TERMS", "BLOCK_WORDS"), sizes):
        monkeypatch.setattr(divergence, name, value)
    rows = corpus(4)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    found = divergence.audit(clashing(df))
    assert Counter(map(tuple, found.collect())) == brute_divergence(rows)


def test_divergence_of_an_empty_table_and_of_one_group(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    one = [("same words here", "en", "web")] * 12
    found = divergence.audit(spark.createDataFrame(one, schema))
    assert Counter(map(tuple, found.collect())) == brute_divergence(one) == Counter()


@pytest.mark.parametrize("name,tables", [("op11_topk", ["embeddings"]), ("op13_divergence", ["documents"])])
def test_oracles(spark, name, tables):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    found = QUERIES[name](spark, sf)
    want = con.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(want.columns)
    assert Counter(map(tuple, found.select(*want.columns).collect())) == Counter(want.fetchall())
