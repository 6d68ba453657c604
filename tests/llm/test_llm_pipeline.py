import zlib
from collections import Counter

import corpus_pipeline
from conftest import SF
from messy import documents, empty
from test_llm_models import _check_packing
from test_llm_text import _brute_lines, _brute_print

from tabforge.llm import quality_cnn
from tabforge.sources.tables import read_table


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    known = docs
    good = corpus_pipeline.quality(spark, docs, SF)
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in good.collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert len(kept & set(clean)) >= 0.99 * len(clean)
    rows = [(r.doc_id, r.text) for r in good.collect()]

    cut = corpus_pipeline.lines(spark, good, SF)
    assert cut.columns == known.columns
    want = {i: t for i, _, _, t in _brute_lines(rows, 10)}
    assert {r.doc_id: r.text for r in cut.collect()} == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    few = corpus_pipeline.near_duplicates(spark, cut, SF)
    assert few.columns == known.columns
    prints = {i: _brute_print(t, 3) for i, t in want.items()}
    group = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if group[j] < group[i] and (prints[i] ^ prints[j]).bit_count() <= 3:
                    group[i], changed = group[j], True
    assert {r.doc_id for r in few.collect()} == set(group.values())

    mixed = corpus_pipeline.mix(spark, few, SF)
    assert mixed.columns == known.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert max(times.values()) <= 3 and set(times) <= set(group.values())
    n = {i: len(t.encode().split()) for i, t in want.items()}
    left = sum(n[i] for i in set(group.values()))
    assert abs(sum(n[i] * k for i, k in times.items()) - left) < 0.1 * left + 20 * max(n.values())

    packed = corpus_pipeline.pack(spark, mixed.dropDuplicates(["doc_id"]), SF).collect()
    assert _check_packing(packed, {i: want[i] for i in times}, 1024) == 0


def test_run_and_awkward_rows(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert name == "pack" or out.columns == docs.columns
        out.count()
        assert stage(spark, empty(spark), SF).count() == 0


def test_training_never_sees_held_out_rows(spark):
    docs, labels = (read_table(spark, SF, t) for t in ("documents", "labels"))
    seen = {t for t, _ in quality_cnn.training_rows(docs, labels, 10**6, 10**9, "doc_id", "text", "quality")}
    texts = Counter(r.text.encode() for r in docs.collect())
    known = {r.doc_id for r in labels.collect()}
    for r in docs.collect():
        out = zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        if texts[r.text.encode()] == 1 and r.doc_id in known:
            assert (r.text.encode() in seen) != out
