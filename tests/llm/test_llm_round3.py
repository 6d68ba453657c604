import re
from collections import Counter, defaultdict
from decimal import Decimal
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from conftest import SF
from messy import documents, empty

from tabforge.llm import divergence, minhash, whitening
from tabforge.llm.queries import ORACLE, QUERIES

# ---------------------------------------------------------------------------- whitening


def _triangle(x):
    r = np.linalg.qr(x - x.mean(axis=0), mode="r")
    out = np.zeros((x.shape[1], x.shape[1]))
    out[:len(r)] = r
    return out


RNG = np.random.default_rng(5)
_Q = np.linalg.qr(np.vstack([(h := RNG.normal(size=(300, 12))), -h]))[0]
CASES = {
    "even": RNG.normal(size=(900, 40)), "graded": RNG.normal(size=(900, 30)) * np.logspace(0, -6, 30),
    "rank 3": RNG.normal(size=(900, 3)) @ RNG.normal(size=(3, 20)), "few rows": RNG.normal(size=(5, 30)),
    "all equal": _Q, "nearly equal": np.vstack([_Q, _Q * (1 + 1e-9 * np.arange(12))]),
    "twice": np.hstack([(h := RNG.normal(size=(200, 7))), h]), "one": RNG.normal(size=(50, 1)),
    "two": RNG.normal(size=(50, 2)), "blocks": np.vstack([np.eye(9), -np.eye(9)]),
}


@pytest.mark.parametrize("name", CASES)
def test_directions(name):
    r = _triangle(CASES[name])
    lams, v = whitening.principal_directions(r, 8)
    true = np.linalg.svd(r, compute_uv=False) ** 2
    rank = int((true > true[0] * 1e-20).sum())
    assert len(lams) == min(8, rank)
    assert np.allclose(lams, true[:len(lams)], rtol=1e-12, atol=0)
    assert np.abs(v.T @ v - np.eye(len(lams))).max() < 1e-12
    assert np.abs(r.T @ (r @ v) - v * lams).max() < 1e-12 * lams[0]


def test_singular_values_of_a_graded_bidiagonal_are_relatively_accurate():
    a, b = np.logspace(0, -12, 13), np.logspace(0, -12, 13)[:-1] * .1
    found = np.sqrt(whitening.squared_singular_values(a, b))
    # the inverse's largest singular values are the reciprocals of the least ones
    least = 1 / np.linalg.svd(np.linalg.inv(np.diag(a) + np.diag(b, 1)), compute_uv=False)[0]
    assert abs(found[-1] / least - 1) < 1e-13


def _by_row(df):
    out = defaultdict(dict)
    for r in df.collect():
        out[r.vec_id][r.component] = r
    return out


def test_whitening_query_against_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = np.floor(1024 * np.stack(rows.embedding).astype(float)) + 100000
    n, s = len(x), x.sum(axis=0).astype(int)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    y = (x - x.mean(axis=0)) @ vectors[:, :8] / np.sqrt(values[:8])
    got = _by_row(QUERIES["op11_whitening"](spark, SF))
    assert len(got) == n
    flip = np.ones(8)
    for k, i in enumerate(rows.vec_id):
        for c in range(1, 9):
            r = got[i][c]
            if k == 0:
                flip[c - 1] = np.sign(r.whitened * y[0, c - 1])
            assert abs(r.whitened - flip[c - 1] * y[k, c - 1]) < 1e-8
            assert r.n == n and r.identity_error < 1e-10
            assert abs(r.explained / (values[c - 1] / values.sum()) - 1) < 1e-10
            assert r.deviation == sum((n * int(v) - int(t)) ** 2 for v, t in zip(x[k], s, strict=True))


def test_whitening_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 0.0]),
            (6, [None, 1.0]), (7, [1.0]), (8, [1e300, 0.0]), (None, [-3.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, whitened string")
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == sorted(
        (i is None, i or 0, c) for i in (0, 1, 1, None) for c in (1, 2))
    assert whitening.whiten(df.limit(0)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0
    # beyond 64 bits: exact all the same
    far = spark.createDataFrame([(i, [float(i) * 1e10, 1.0]) for i in (0, 1, 3)], "vec_id long, embedding array<double>")
    x = [int(i * 1e10 * 1024) + 100000 for i in (0, 1, 3)]
    want = {i: Decimal((3 * v - sum(x)) ** 2) for i, v in zip((0, 1, 3), x, strict=True)}
    assert {r.vec_id: r.deviation for r in whitening.whiten(far).collect()} == want


def test_whitening_over_many_partitions(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    one = whitening.fit(rows.coalesce(1))
    many = whitening.fit(rows.repartition(40))
    assert one.sums == many.sums and np.allclose(one.values, many.values, rtol=1e-12)
    assert np.allclose(np.abs((one.directions * many.directions).sum(axis=0)), 1, atol=1e-10)


# --------------------------------------------------------------------------- divergence

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _brute_divergence(rows, least, top):
    groups, in_docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = [w.translate(LOWER) for w in TERM.findall(text or "")]
        groups[lang or "", source or ""].update(words)
        in_docs[lang or ""].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        mine = {s: c for (x, s), c in groups.items() if x == lang}

        def share(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        shares = {s: share(c) for s, c in mine.items()}
        whole = share(sum(mine.values(), Counter()))
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        for s in mine:
            pairs = [(-sum(gap(shares[s][t], shares[o][t]) for t in kept), o.encode()) for o in mine if o != s]
            terms = [(-gap(shares[s][t], whole[t]), t.encode()) for t in kept
                     if mine[s][t] and shares[s][t] > whole[t]]
            for part, found, upto in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(sorted(found)[:upto])]
    return sorted(out)


@pytest.mark.parametrize("least", [1, 2, 3, 100])
def test_divergence_against_brute_force(spark, least):
    docs = documents(spark).unionByName(spark.createDataFrame(
        [(i, f"the {w} cat-sat Überall the naïve_{w}", g, s, 0, 0, "", "", "", 0, "")
         for i, (w, g, s) in enumerate([("a", "en", "x"), ("b", "en", "y"), ("a", None, "x"), ("c", "de", None),
                                        ("a", "en", "x"), ("B", "en", "z"), ("", "", "x"), ("été", "fr", "q")])],
        documents(spark).schema))
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    got = divergence.divergence(docs, min_docs=least, top=3)
    assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank"))
                  for r in got.collect()) == _brute_divergence(rows, least, 3)
    assert divergence.divergence(empty(spark)).count() == 0


def test_divergence_in_small_steps(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [("en" if i % 3 else "de", f"s{i % 17}", " ".join(f"{chr(97 + a)}{chr(97 + b)}" for a, b in
             rng.integers(0, 6, (rng.integers(0, 60), 2)))) for i in range(200)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    for name in ("HELD", "CHUNK"):
        monkeypatch.setattr(divergence, name, 7)
    # blocks and accumulators of the same functions that the tasks run, a few entries at a time
    size = np.array([3, 1, 2])
    gid, p = np.array([0, 1, 2, 1, 0, 2]), np.array([50, 60, 9, 70, 20, 31])
    p0 = np.array([5, 6, 7])[gid]
    acc = dict(divergence.scatter_block(size, gid, p, p0))
    gap = lambda x, y: (x - y) ** 2 // (x + y)
    fix = lambda a, b, a0, b0: gap(a, b) - gap(a, b0) - gap(a0, b) + gap(a0, b0)
    assert acc[0].tolist() == [0, fix(50, 60, 5, 6), fix(50, 9, 5, 7) + fix(20, 31, 5, 7)]
    got = divergence.divergence(docs, min_docs=10, top=4)
    assert sorted(map(tuple, got.collect())) == _brute_divergence(rows, 10, 4)


def test_divergence_long_texts(spark):
    rows = [("en", "a", "x" * 2_000_000), ("en", "b", " " * 2_000_000), ("en", "c", "ab." * 600_000)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    got = divergence.divergence(docs, min_docs=1, top=10)
    assert sorted(map(tuple, got.collect())) == _brute_divergence(rows, 1, 10)


# ------------------------------------------------------------------------------ minhash

def _sets(rows, k):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        out.append({b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def _brute_groups(rows, k, part):
    sets, up = _sets(rows, k), list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= part * len(a | sets[j]):
                up[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (name, _) in enumerate(rows):
        ids[find(i)].append(name)
    out = []
    for i, (name, _) in enumerate(rows):
        first = min((x for x in ids[find(i)] if x is not None), default=None) if sets[i] else name
        out.append((name, len(sets[i]), first, name == first))
    return sorted(out, key=repr)


def _found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_minhash_awkward(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for k, part in ((3, Fraction(85, 100)), (5, Fraction(4, 5))):
        got = minhash.minhash_groups(docs, part, k)
        assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
        assert _found(got) == _brute_groups(rows, k, part)
    assert minhash.minhash_groups(empty(spark)).count() == 0


def _variants(seed, groups=6, copies=40, words=120):
    """Groups of copies of a text with few to many words exchanged, so that similarities lie on both
    sides of the threshold and many links run through others."""
    rng, rows = np.random.default_rng(seed), []
    for g in range(groups):
        base = [f"w{v}" for v in rng.integers(0, 3000, words)]
        for _ in range(copies):
            text = list(base)
            for at in rng.integers(0, words, rng.integers(0, 9)):
                text[at] = f"x{rng.integers(0, 10 ** 6)}"
            rows.append((len(rows), " ".join(text)))
    order = rng.permutation(len(rows))
    return [(int(i), rows[i][1]) for i in order]


@pytest.mark.parametrize("settings", [{}, {"group_rows": 7}, {"group_bytes": 9000}])
def test_minhash_against_brute_force(spark, settings):
    rows = _variants(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _found(minhash.minhash_groups(docs, Fraction(85, 100), 3, **settings)) == _brute_groups(
        rows, 3, Fraction(85, 100))


def test_minhash_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert _found(QUERIES["op13_bbit_minhash"](spark, SF)) == _brute_groups(rows, 3, Fraction(85, 100))


def test_packed_signatures_count_equal_low_bits():
    signer, rng = minhash.Signer(128, 4), np.random.default_rng(3)
    a, b = (rng.integers(0, 2 ** 32, 128).astype("<u4") for _ in range(2))
    b[:50] = a[:50]
    want = int(((a & 15) == (b & 15)).sum())
    assert minhash.matches(signer.packed(a), signer.packed(b), 128) == want


def test_estimates_are_corrected_for_collisions():
    signer, rng = minhash.Signer(128, 4), np.random.default_rng(4)
    for s in (0.0, 0.3, 0.6, 0.9):
        errors = []
        for _ in range(60):
            both, own = int(1000 * s), 1000 - int(1000 * s)
            h = rng.integers(0, 2 ** 64, both + 2 * own, dtype=np.uint64)
            x, y = (signer.packed(signer.least(np.concatenate([h[:both], part])))
                    for part in (h[both:both + own], h[both + own:]))
            errors.append(minhash.estimate(minhash.matches(x, y, 128), 128) - both / (both + 2 * own))
        assert abs(np.mean(errors)) < 0.02


def test_minhash_long_texts(spark):
    rows = [(1, " " * 2_000_000), (2, "x" * 2_000_000), (3, "x" * 2_000_000), (4, "a b c " * 300_000),
            (5, "a b c " * 200_000 + "a b"), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _found(minhash.minhash_groups(docs, Fraction(85, 100), 3)) == _brute_groups(rows, 3, Fraction(85, 100))


# ------------------------------------------------------------------------------- oracle

def test_divergence_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    res = con.execute(ORACLE["op12_source_divergence"])
    cols = [c[0] for c in res.description]
    got = QUERIES["op12_source_divergence"](spark, SF)
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(res.fetchall())
