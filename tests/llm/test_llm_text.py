import hashlib
import random

import numpy as np
import xxhash
from messy import LONG, documents, empty
from pyspark.sql import functions as F

from tabforge.llm import gsaca, line_dedup, mixing, quality_rules, simhash, suffix_dedup
from tabforge.llm.common import SPACE


# ------------------------------------------------------------------------------- lines

def _brute_lines(rows, least):
    key = lambda line: line.strip(SPACE).translate({c: c + 32 for c in range(65, 91)})
    seen = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if key(line):
                seen.setdefault(key(line), set()).add(i)
    hot = {k for k, ids in seen.items() if len(ids) >= least}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if key(x) not in hot]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def test_lines_against_brute_force(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for least in (1, 2, 3, 50):
        got = line_dedup.dedup_lines(docs, min_docs=least)
        assert set(got.columns) == set(docs.columns) | {"n_dropped"}
        found = sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()], key=repr)
        assert found == _brute_lines(rows, least)
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


# ------------------------------------------------------------------------------- mixing

def _brute_mix(rows):
    """Sorted water filling and sorted hashes in plain Python."""
    h = lambda i: int(hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:15], 16)
    n = lambda t: len((t or "").encode().split())
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + n(t)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    open_, left, target = set(names), sum(sizes.values()), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
            open_.remove(s)
    return sizes, target, h, n


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "a", "a", "b", "é", None, "z"]))
            for i in range(800)] + [(7, "x y", "a"), (None, None, "only")]
    rows.append((801, "tiny", "tiny"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes, target, h, n = _brute_mix(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken, biggest = {}, {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r["size"] == n(r.text) and 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        biggest[r.source] = max(biggest.get(r.source, 0), r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= biggest[s] + 2
    # one threshold a source: whoever is taken more often has the smaller hash
    for s in sizes:
        times = sorted((h(r.doc_id), r.taken // r["size"]) for r in got if r.source == s and r["size"])
        assert [t for _, t in times] == sorted((t for _, t in times), reverse=True)
    again = {(r.doc_id, r.text): r.taken for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.text): r.taken for r in got}
    made = mixing.apply_mix(docs)
    assert made.columns == docs.columns
    assert made.count() == sum(r.taken // r["size"] for r in got if r["size"])


def test_mix_awkward(spark):
    docs = documents(spark)
    assert mixing.mix(docs).count() == docs.count()
    assert mixing.apply_mix(docs).columns == docs.columns
    assert mixing.mix(empty(spark)).count() == 0 and mixing.apply_mix(empty(spark)).count() == 0


# ------------------------------------------------------------------------------- substrings

def _brute_substrings(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        covered = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if w in seen:
                covered[k:k + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        spans = sum(1 for k in range(len(b)) if covered[k] and (not k or not covered[k - 1]))
        out[i] = (len(b), sum(covered), spans, kept)
    return out


def test_suffix_order():
    rng = random.Random(5)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 5)):
            top, x = rng.choice([1, 2, 3, 30]), []
            for _ in range(rng.randint(1, 4)):
                x += [rng.randint(1, top) for _ in range(rng.randint(0, 25))] + [0]
            texts.append(x)
        sizes = np.array([len(x) for x in texts])
        want, base = [], 0
        for x in texts:
            key = [(c, 0) if c else (0, -k) for k, c in enumerate(x)]
            want += [base + k for k in sorted(range(len(x)), key=lambda k: key[k:])]
            base += len(x)
        got = gsaca.suffix_order(np.array([c for x in texts for c in x]), sizes)
        assert got.tolist() == want


def test_substrings_against_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    base, other = [[word() for _ in range(90)] for _ in range(2)]
    rows = []
    for i in range(260):
        x = list(base if i % 3 else other)
        for _ in range(rng.randint(0, 4)):
            x[rng.randrange(len(x))] = word() + str(i)
        rows.append((i, " ".join(x)))
    rows += [(300, None), (301, ""), (302, "a" * 3000), (303, "ab" * 700), (304, "short"),
             (305, "\u0000" * 400), (306, LONG[:3000]), (-4, LONG[:3000])]
    want = _brute_substrings(rows, 100)
    for parts in (1, 6):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
               for r in suffix_dedup.dedup_substrings(docs).collect()}
        assert got == want


def test_substrings_awkward(spark):
    docs = documents(spark)
    got = suffix_dedup.dedup_substrings(docs, length=64)
    assert set(got.columns) == set(docs.columns) | {"n_removed", "n_spans"}
    rows = got.collect()
    assert len(rows) == docs.count()
    assert next(r for r in rows if r.doc_id == 5).n_removed > len(LONG) - 200
    assert suffix_dedup.dedup_substrings(empty(spark)).count() == 0
    # copies under one id: the second is removed, rows without an id come last
    text = " ".join(map(str, range(200)))
    twice = spark.createDataFrame([(1, text), (1, text + " tail"), (None, text)],
                                  "doc_id long, text string")
    rows = suffix_dedup.dedup_substrings(twice).collect()
    assert sorted(r.n_removed for r in rows) == [0, len(text), len(text)]
    assert next(r.n_removed for r in rows if r.doc_id is None) == len(text)


# ------------------------------------------------------------------------------- SimHash

def _brute_print(text, k):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_groups(spark):
    rng = random.Random(2)
    base = [f"Word{rng.randint(0, 500)}" for _ in range(300)]
    rows = []
    for i in range(300):
        x = list(base) if i % 2 else [f"w{rng.randint(0, 999)}" for _ in range(rng.randint(0, 30))]
        if i % 4 == 1:
            x[rng.randrange(len(x))] = "changed" + str(i)
        rows.append((i, " ".join(x)))
    rows += [(400, None), (401, ""), (402, " \t"), (7, "repeated id"), (None, "no id at all here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [_brute_print(t, 3) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    want = sorted(((i, f"{prints[a]:016x}", least.get(find(a))) for a, (i, _) in enumerate(rows)), key=repr)
    for most in (2048, 64):  # small buckets only by dividing them
        got = simhash.simhash_groups(docs, max_bucket=most)
        assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got.collect()], key=repr) == want
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == len({find(a) for a in range(len(rows))})
    assert simhash.keep_one(documents(spark)).columns == documents(spark).columns
    assert simhash.keep_one(empty(spark)).count() == 0


def test_links_join_buckets_dealt_from_several_partitions(spark):
    rng = random.Random(4)
    pairs = [(x, x ^ 0b111 << rng.randrange(60)) for x in (rng.getrandbits(63) for _ in range(300))]
    # the halves of a pair in partitions of their own
    prints = spark.sparkContext.parallelize([(x,) for half in zip(*pairs, strict=True) for x in half], 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # as larger tables
    try:
        links = simhash.fingerprint_links(spark.createDataFrame(prints, "fp long"), 3).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(sorted((r.a, r.b)) for r in links) == sorted(sorted(p) for p in pairs)


def test_groups_that_share_an_id_or_have_none_stay_apart(spark):
    rng = random.Random(3)
    a, b, c = (" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=400)) for _ in range(3))
    own = simhash.simhash(c.encode(), 3)
    near = next(t for i in range(999) if 1 <= (simhash.simhash((t := f"{c} z{i}").encode(), 3) ^ own).bit_count() <= 3)
    rows = [(5, a), (5, b), (9, b), (None, c), (None, near)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in kept if r.doc_id == 5) == sorted([a, b])
    assert len(kept) == 3 and [r.text in (c, near) for r in kept if r.doc_id is None] == [True]


def test_masks_cover_every_pair():
    masks, rng = simhash.covering_masks(3), random.Random(1)
    for _ in range(3000):
        differ = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(m & differ == 0 for m in masks)
    assert len(masks) == 15 and all(30 <= m.bit_count() <= 36 for m in masks)


# ------------------------------------------------------------------------------- rules

def _brute_rules(text):
    t = text or ""
    words = [w for w in "".join(" " if c in SPACE else c for c in t).split(" ") if w]
    lines = [x for x in t.split("\n") if any(c not in SPACE for c in x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = {w: windows.count(w) for w in set(windows)} if len(windows) < 500 else None
    if counts is None:
        counts = {}
        for w in windows:
            counts[w] = counts.get(w, 0) + 1
    inside = {k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t),
            len(lines) - len(set(lines)), len(inside),
            len(words) < 20 or 100 * len(inside) > 30 * len(words))


def test_rules_against_brute_force(spark):
    rng = random.Random(9)
    texts = [r.text for r in documents(spark).collect()]
    for _ in range(60):
        w = [rng.choice(["a", "b.", "c|", "#d", "é", "\n", "\x0b", "  "]) for _ in range(rng.randint(0, 60))]
        texts.append(" ".join(w))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = {r.doc_id: tuple(r[n] for n in names) for r in quality_rules.apply_rules(docs).collect()}
    assert got == {i: _brute_rules(t) for i, t in enumerate(texts)}


def test_rules_by_line(spark):
    clean = "\n".join(f"Sentence {i} has {i * 7} plain words{i}." for i in range(8))
    menu = "\n".join(["Home | About | News | Contact | More."] * 9)
    furniture = "\n".join(f"All rights reserved, page {i}." for i in range(30))
    docs = spark.createDataFrame(
        [(1, clean), (2, clean + "\n" + "no stop here"), (3, menu), (4, furniture),
         (5, "no sentence end " * 10)], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.apply_rules(docs).collect()}
    assert got[1].kept and got[1].cleaned == clean and got[1].n_lines_removed == 0
    assert got[2].kept and got[2].cleaned == clean and got[2].lost_chars == 10
    assert not any(got[i].kept for i in (3, 4, 5))
    assert got[4].n_lines_removed == 30
    docs = documents(spark)
    assert quality_rules.apply_rules(docs).count() == docs.count()
    assert quality_rules.apply_rules(empty(spark)).count() == 0
    assert "Python" not in quality_rules.apply_rules(docs.select("doc_id", F.lower("text").alias("text"))
                                                     )._jdf.queryExecution().toString()
