"""Very long and clashing inputs, and groups of any size."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import licenses, mixing, packing, quality_rules, suffix_dedup
from tabforge.llm.queries import tokenizer_path


def _brute_substrings(rows, length):
    """Removed bytes of each text, by definition."""
    seen, out = set(), []
    for _, text in sorted(rows):
        raw, gone = text.encode(), np.zeros(len(text.encode()), bool)
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            if w in seen:
                gone[i:i + length] = True
            seen.add(w)
        out.append(bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("group_runs", [5, 1 << 14])
def test_hot_anchors_are_divided(spark, group_runs):
    """One passage in many documents, each with other words near it: far more than SORT_RUNS unequal
    runs share an anchor."""
    rng = random.Random(3)
    passage = "the quick brown fox jumps over the lazy dog and then it sleeps all day long. "
    rows = []
    for i in range(250):
        word = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 40)))
        rows.append((i, (word + passage + word[::-1]) * rng.randint(1, 3)))
    want = _brute_substrings(rows, 64)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.dedup_substrings(docs, length=64, group_runs=group_runs).orderBy("doc_id").collect()
    assert [bytes(r.kept) for r in got] == want


def test_unequal_runs_are_decided_by_the_suffix_order(spark, capsys):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    numbered = suffix_dedup._numbered(docs, "doc_id", "text").withColumn("__text", F.coalesce("text", F.lit("")))
    asked = numbered.select("_doc", "_seq", "__text").mapInArrow(suffix_dedup._cut_task(100, 32), suffix_dedup.DEALT).repartition(8, "bucket")
    settled = asked.mapInArrow(suffix_dedup._settle_task(), suffix_dedup.FLAT)
    whole = settled.where(F.col("kind") == suffix_dedup.SPAN).agg(F.sum("n")).first()[0]
    every = suffix_dedup.repeated_spans(numbered, 100).agg(F.sum(F.pmod("span", F.lit(suffix_dedup.PLACE)))).first()[0]
    with capsys.disabled():
        print(f"\nrepeated windows: {every}, of which equal as whole runs {whole}")
    assert every >= whole > 0


def test_licence_terms_of_any_length(spark):
    chain = "a." * 100_000 + "a"
    files = spark.createDataFrame(
        [("r/LICENSE", "Released under the MIT License."), ("r/long.txt", chain), ("r/spaces.txt", " " * 2_000_000),
         ("r/letters.txt", "x" * 2_000_000)], "path string, text string")
    assert licenses.scan_licenses(files).count() == 4


def test_packing_of_long_white_space(spark):
    from tokenizers import Tokenizer

    texts = [" " * 2_000_000, "x y" + "\n" * 1_200_000 + "z", "a." * 100_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = packing.pack(docs, tokenizer_path()).groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("of")).orderBy("doc_id").collect()
    tok = Tokenizer.from_file(tokenizer_path())
    want = [len(tok.encode(t, add_special_tokens=False).ids) + 1 for t in texts]
    assert [(r.n, r.of) for r in got] == [(n, n) for n in want]


def test_columns_named_like_working_ones_stay(spark):
    docs = spark.createDataFrame([(1, "One line. " * 30, "a", 7, "b", "t"), (2, "Other words.", "b", 8, "p", "u")],
                                 "doc_id long, text string, source string, passes int, below string, _text string")
    for out in (mixing.mix(docs), quality_rules.apply_rules(docs), suffix_dedup.dedup_substrings(docs)):
        rows = out.orderBy("doc_id").collect()
        assert [(r.passes, r.below, r._text) for r in rows] == [(7, "b", "t"), (8, "p", "u")]


def test_line_rules_count_words_and_look_at_long_lines(spark):
    lines = ["Home  |  News  |  Sport.", "A menu\t|\tnews.", "word " * 80 + "click here to read it.",
             "word " * 80 + "and an end."]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, line string")
    got = [r.ok for r in df.select("k", quality_rules.line_passes(F.col("line")).alias("ok")).orderBy("k").collect()]
    assert got == [False, False, False, True]
