import gzip
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF
from messy import documents, empty
from pyspark.sql import functions as F

from tabforge.llm import ann, licenses, packing, quality_cnn, warc
from tabforge.llm.queries import ORACLE, QUERIES, tokenizer_path
from tabforge.sources.tables import TABLES, read_table


# ------------------------------------------------------------------------------- search

def test_search_recall_and_order(spark):
    vectors = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = vectors.select("vec_id", "embedding").toPandas().sort_values("vec_id")
    x, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    got: dict = {}
    for r in ann.search(vectors).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    place = {i: k for k, i in enumerate(ids)}
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        mine = sorted(got[q])
        assert [k for k, _, _ in mine] == list(range(1, 21)) and q not in [v for _, v, _ in mine]
        assert mine == sorted(mine, key=lambda t: (-t[2], t[1]))
        s = (x * x[place[q]]).sum(axis=1)
        assert all(abs(score - s[place[v]]) < 1e-12 for _, v, score in mine)
        s[place[q]] = -np.inf
        hits += len({v for _, v, _ in mine} & set(ids[np.lexsort((ids, -s))[:20]]))
        total += 20
    assert hits / total >= 0.9


def test_search_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]),
            (6, [inf, 0.0]), (7, [None, 1.0]), (8, [0.0, 0.0]), (9, [1.0]), (20, [0.5, 0.5]),
            (20, [0.5, 0.5]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(df).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.5),
                   (20, 1, 0, 0.5), (20, 2, 1, 0.5), (20, 3, 2, 0.5)]
    assert ann.search(df.limit(0)).count() == 0


def test_balanced_partition():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1200, 16)) + 4 * rng.normal(size=(8, 16))[rng.integers(0, 8, 1200)]
    graph = ann.neighbour_graph(x, 10)
    label = ann.balanced_partition(x, graph, 8)
    assert np.bincount(label, minlength=8).max() <= np.ceil(1.1 * 1200 / 8)
    shuffled = rng.permutation(label)
    cut = lambda part: (part[graph] != part[:, None]).mean()
    assert cut(label) < 0.6 * cut(shuffled)


# ------------------------------------------------------------------------------- classifier

def test_classifier_on_held_out_rows(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    net = quality_cnn.fit(docs, labels)
    rows = quality_cnn.score(docs, net).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 300
    good, bad = ([r.predicted for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.1
    for r in rows[:50]:
        assert zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.predicted == (r.score >= 0.3)


def test_classifier_awkward(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (4, None), (5, 7), (9, 1), (8, 1)],
                                   "doc_id long, quality int")
    net = quality_cnn.fit(docs, labels, steps=5)
    got = quality_cnn.score(docs, net)
    assert set(got.columns) == set(docs.columns) | {"held_out", "predicted"}
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    blank = {r.score for r in rows if not r.text}
    assert len(blank) == 1 and all(r.held_out for r in rows if r.doc_id is None)
    assert quality_cnn.keep_good(docs, net).columns == docs.columns
    none = quality_cnn.fit(empty(spark), labels.limit(0))
    assert quality_cnn.score(empty(spark), none).count() == 0
    assert {r.score for r in quality_cnn.score(docs, none).collect()} == {0.5}


def test_every_byte_is_in_a_chunk():
    net = quality_cnn.new_net()
    raw = bytes(random.Random(1).randrange(97, 99) for _ in range(5000))
    before = quality_cnn.pooled(net, raw)
    net.embed[ord("!")] = 40.0
    for at in (0, 7, 8, 2500, 4999):
        assert (quality_cnn.pooled(net, raw[:at] + b"!" + raw[at + 1:]) != before).any()


# ------------------------------------------------------------------------------- licences

def test_licences(spark):
    mit = "Released under the MIT License."
    files = [(1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."), (2, "a/b/c/x.txt", "code\nmore"),
             (3, "a/b/LICENSE.txt", mit), (4, "a/y.txt", "intro\n" + mit + "\n" + "text. " * 50), (5, "z.txt", "none"),
             (6, None, None), (7, "a/b/c/x.txt", ""), (8, "a/q.txt", "the version of the work is under review"),
             (2, "a/b/c/x.txt", "code\nmore"), (9, "a/bb/w.txt", "MIT license")]
    df = spark.createDataFrame(files, "doc_id long, path string, text string").withColumn("license", F.lit("?"))
    got = Counter((r.doc_id, r.own_license, r.license, r.inherited_from)
                  for r in licenses.scan_licenses(df).collect())
    assert got == Counter({
        (1, "Apache-2.0", "Apache-2.0", None): 1, (2, None, "MIT", "a/b"): 2, (3, "MIT", "MIT", None): 1,
        (4, "MIT", "MIT", None): 1, (5, None, None, None): 1, (6, None, None, None): 1,
        (7, None, "MIT", "a/b"): 1, (8, None, "Apache-2.0", "a"): 1, (9, None, "Apache-2.0", "a"): 1})
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_every_licence_line_is_found(spark):
    docs = read_table(spark, SF, "documents")
    files = docs.withColumn("path", F.concat(F.lit("d/"), F.col("doc_id").cast("string")))
    own = {r.doc_id: r.own_license for r in licenses.scan_licenses(files).collect()}
    notices = {t: lic for lic, t in licenses.TEMPLATES}
    for r in docs.collect():
        stated = [notices[x] for x in r.text.split("\n") if x in notices]
        assert own[r.doc_id] == (stated[0] if stated else None)


WRAPPED = {
    "GPL-3.0": """/*
 * Copyright (C) 2011 Someone
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main() { return 0; }
""",
    "MIT": """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a
copy of this software and associated documentation files, to deal in the
Software without restriction.
""",
    "MPL-2.0": """# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0.
import os
"""}


def test_wrapped_notices(spark):
    prose = read_table(spark, SF, "documents").select("doc_id", F.lit("p/x").alias("path"), "text")
    files = [(-1, "a/main.c", WRAPPED["GPL-3.0"]), (-2, "b/LICENSE", WRAPPED["MIT"]), (-3, "b/c/x", "code"),
             (-4, "c/x.py", "x = 1\n" * 30 + WRAPPED["MPL-2.0"]), (-5, None, WRAPPED["MIT"]), (None, "d/x", WRAPPED["GPL-3.0"])]
    df = prose.union(spark.createDataFrame(files, "doc_id long, path string, text string"))
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert {k: got[k].own_license for k in (-1, -2, -3, -4, -5, None)} == {
        -1: "GPL-3.0", -2: "MIT", -3: None, -4: "MPL-2.0", -5: "MIT", None: "GPL-3.0"}
    assert (got[-3].license, got[-3].inherited_from) == ("MIT", "b") and got[-4].own_line == 30


def test_rare_words_are_no_notice(spark):
    prose = read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", F.lit("p/x").alias("path"), "text")
    words = " ".join(f"qx{chr(97 + i)}zw" for i in range(20))
    files = [(-1, "a/x.txt", f"{words} released yesterday under the MIT license {words[::-1]}"),
             (-2, "b/x.txt", "It is released under the MIT License.")]
    df = prose.union(spark.createDataFrame(files, "doc_id long, path string, text string"))
    got = {r.doc_id: r.own_license for r in licenses.scan_licenses(df).where("doc_id < 0").collect()}
    assert got == {-1: None, -2: "MIT"}


# ------------------------------------------------------------------------------- archives

def _pages(spark):
    big = "<p>" + "é" * 900
    return spark.createDataFrame(
        [(1, "http://a/", big), (2, "http://a/b c\r\nX: y", big), (9, None, big), (3, "u", None), (4, "u", ""),
         (5, "u", "small"), (6, "u", "small"), (9, "again", big), (None, "n", big), (None, "n", "x"),
         (7, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 3),
         (8, "u", "z" * 300000)], "page_id long, url string, html string").withColumn("status", F.lit("?"))


@pytest.mark.parametrize("compress", [True, False])
def test_archive_round_trip(spark, tmp_path, compress):
    path = str(tmp_path / "w")
    warc.write_warc(_pages(spark), path, compress=compress, file_bytes=4000)
    rows = warc.read_warc(spark, path).collect()
    assert {r.status for r in rows} == {"record"}
    html = {r.page_id: (r.html or "").encode() for r in _pages(spark).collect() if r.page_id}
    for r in rows:
        page = r.record_id[len("<urn:page:"):-1]
        if r.record_type == "response" and page:
            assert bytes(r.payload) == html[int(page)] and r.payload_bytes == len(html[int(page)])
    kinds = Counter((r.record_id[10:-1], r.record_type, r.refers_to) for r in rows)
    assert kinds == Counter({
        ("1", "revisit", "<urn:page:9>"): 1, ("2", "revisit", "<urn:page:9>"): 1, ("", "revisit", "<urn:page:9>"): 1,
        ("9", "response", None): 2, ("", "response", None): 1, **{(str(i), "response", None): 1 for i in range(3, 9)}})
    assert {r.payload_bytes for r in rows if r.record_type == "revisit"} == {1803}
    warc.write_warc(_pages(spark).limit(0), path + "0", compress=compress)
    assert warc.read_warc(spark, path + "0").count() == 0


def test_files_are_bounded_by_bytes_and_members_by_what_they_state(spark, tmp_path):
    pages = spark.range(40, numPartitions=1).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.concat(F.lit("x"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 30)).alias("html"))
    path = str(tmp_path / "w")
    warc.write_warc(pages, path, compress=False, file_bytes=10000)
    sizes = [f.stat().st_size for f in (tmp_path / "w").glob("part-*")]
    assert len(sizes) > 7 and max(sizes) < 10000 + 4000 and warc.read_warc(spark, path).count() == 40
    body = b"y" * (1 << 29)      # a valid record of any size is read
    head = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n"
    found = list(warc.salvage(gzip.compress(head % len(body) + body + warc.END, 1)))
    assert [f[0] for f in found] == ["record"] and len(found[0][4]) == len(body)
    # what goes on beyond its stated end, or holds no record, is a gap
    for bad in (head % 5 + body[:100000] + warc.END, body[:100000], b"WARC/1.1\r\nA: b\r\n\r\n"):
        assert [f[0] for f in warc.salvage(gzip.compress(bad))] == ["gap"]


@pytest.mark.parametrize("compress", [True, False])
def test_salvage(spark, compress):
    records = [bytes(r.record) + warc.END for r in
               warc.warc_records(read_table(spark, SF, "pages")).orderBy("_id").limit(12).collect()]
    parts = [gzip.compress(r) if compress else r for r in records]
    rng = random.Random(4)
    for case in range(40):
        data, hurt = list(parts), set()
        for k in rng.sample(range(12), rng.randint(0, 4)):
            hurt.add(k)
            p = bytearray(data[k])
            if case % 3 == 0:
                p[rng.randrange(len(p) // 3, len(p) - 12)] ^= 0x55
            elif case % 3 == 1:
                p = p[:rng.randrange(3, len(p) - 9)]
            else:
                p = bytearray(b"junk WARC/1.1\r\n \x1f\x8b\x08 junk") + p[5:]
            data[k] = bytes(p)
        whole = b"".join(data)
        found = list(warc.salvage(whole))
        assert sum(f[2] for f in found) == len(whole)
        assert [f[1] for f in found] == list(np.cumsum([0] + [f[2] for f in found[:-1]]))
        urns = [f[3][b"warc-record-id"] for f in found if f[0] == "record"]
        kept = [warc._parse(r, 0)[1][b"warc-record-id"] for k, r in enumerate(records) if k not in hurt]
        assert set(kept) <= set(urns)
        assert bool(hurt) <= any(f[0] == "gap" for f in found)
    assert list(warc.salvage(b"")) == []


# ------------------------------------------------------------------------------- packing

def _check_packing(rows, texts, window):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    ids = {d: tok.encode(t or "", add_special_tokens=False).ids + [0] for d, t in texts.items()}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            part = np.array(ids[d][at:at + r.length], "<u4")
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[d])
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids[d])
    padded = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded


def test_packing_round_trip(spark):
    docs = read_table(spark, SF, "documents").repartition(3)
    extra = spark.createDataFrame(
        [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "<|endoftext|> \u0000 \U0001f9ea ñ́ 　 x  '  'S 's 12\n\n ")],
        "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(extra)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert _check_packing(packing.pack(docs, tokenizer_path()).collect(), texts, 1024) == 0
    # a bound on open windows of two: completed early, still whole
    assert _check_packing(packing.pack(docs, tokenizer_path(), max_open=2).collect(), texts, 1024) == 0


def test_packing_awkward(spark):
    docs = documents(spark)
    rows = packing.pack(docs, tokenizer_path()).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r.doc_id for r in docs.collect())
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0


def test_sum_of_squares_rule():
    packer = packing.Packer(10)
    piece = lambda n: ("d", 0, np.zeros(n, "<u4"), n)
    assert packer.add(piece(6)) == [] and packer.add(piece(6)) == []
    assert packer.level[6] == 2
    assert [len(h) for h in packer.add(piece(4))] == [2] and packer.level[6] == 1
    packer.add(piece(3))   # to 9 (1 window of fill 9) beats a second fill
    assert packer.level[9] == 1 and packer.level[6] == 0
    assert sum(len(p[2]) for h in packer.finish() for p in h) == 9


# ------------------------------------------------------------------------------- queries

@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*cols).collect()), key=repr) == sorted(want.fetchall(), key=repr)
