"""Source divergence audit: how far the term shares of a source lie from every other source's.

Terms with no occurrence in a group still have a share, its *zero baseline*, so a distance of two
groups is a sum over all kept terms.  It is split into

* a baseline part, from each group's distinct shares against its peers' zero baselines, and
* a correction for the terms that both groups hold, by Gustavson's row accumulation: a task holds a
  block of the term-major index (term -> groups); each group of the block scatters its terms through
  the index rows into a dense accumulator with an entry per peer, and only the accumulators leave
  the task, never a row per pair of postings.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import text_bytes
from tabforge.operators.joins import attach_counted
from tabforge.session import checkpoint

ONE = 1_000_000_000
#: Entries that a task's counters or accumulators may hold before they are handed on.
HELD = 1 << 18
#: Values of a baseline part computed at once.
CHUNK = 1 << 20
#: ASCII letters lower-cased, other ASCII turned to spaces, bytes of other characters kept.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and non-ASCII characters, only A-Z lower-cased."""
    return raw.translate(_FOLD).split()


def _count_task():
    """``(lang, source, term, n, docs)`` combined over the texts of the task, and an empty term per
    group seen, so that groups without terms are known."""

    def run(batches):
        n, docs = Counter(), Counter()

        def flush():
            keys = list(n)
            out = [pa.array([k[i] for k in keys], pa.binary()).cast(pa.string()) for i in range(3)]
            batch = pa.RecordBatch.from_arrays(
                [*out, pa.array([n[k] for k in keys], pa.int64()),
                 pa.array([docs[k] for k in keys], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
            n.clear()
            docs.clear()
            return batch

        for batch in batches:
            columns = [text_bytes(batch.column(i)) for i in range(3)]
            for lang, source, text in zip(*columns, strict=True):
                n[(lang, source, b"")] += 0
                for term, k in Counter(terms_of(text)).items():
                    n[(lang, source, term)] += k
                    docs[(lang, source, term)] += 1
                if len(n) >= HELD:
                    yield flush()
        if n:
            yield flush()

    return run


def term_index(docs: DataFrame, min_docs: int, lang_col: str, source_col: str,
               text_col: str) -> DataFrame:
    """Term-major index ``(lang, term, n, groups array<(source, n)>)`` of the kept terms; a row with
    an empty term lists all groups of the language.  One shuffle, on language and term."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]
    counted = (docs.select(*[c.alias(f"c{i}") for i, c in enumerate(text)])
               .mapInArrow(_count_task(), "lang string, source string, term string, n long, docs long"))
    by_group = (counted.repartition("lang", "term").groupBy("lang", "term", "source")
                .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (by_group.groupBy("lang", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"),
                 F.collect_list(F.struct("source", "n")).alias("groups"))
            .where((F.col("docs") >= min_docs) | (F.col("term") == "")).drop("docs"))


def _share(count, total, vocabulary):
    """1 + floor(ONE (count + 2) / (total + 2 V)), exactly, for counts of any size."""
    top = F.lit(ONE).cast("decimal(20,0)") * (count + F.lit(2)).cast("decimal(18,0)")
    return F.lit(1) + _div(top, (F.col(total) + 2 * F.col(vocabulary)).cast("decimal(20,0)"))


def _div(a, b):
    return F.call_function("div", a, b)


def squared_gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of shares up to ONE + 1, in 64 bits."""
    gap = p - q
    return gap * gap // (p + q)


# ------------------------------------------------------------------------- row accumulation

def _accumulators(rows: dict) -> pa.RecordBatch:
    keys = list(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
         pa.array([np.flatnonzero(rows[k]) for k in keys], pa.list_(pa.int32())),
         pa.array([rows[k][rows[k] != 0] for k in keys], pa.list_(pa.int64()))],
        names=["lang", "gid", "peers", "value"])


ACCUMULATED = "lang string, gid int, peers array<int>, value array<long>"


def scatter_block(size: np.ndarray, gid: np.ndarray, p: np.ndarray, p0: np.ndarray):
    """``(group, accumulator)`` of a block of the index, one language: row t holds ``size[t]`` postings
    of ``gid``, ``p`` and ``p0``.  A group's accumulator has, per peer, the sum over their common
    terms of what the two baseline parts miss."""
    width = int(gid.max(initial=-1)) + 1
    start = np.cumsum(size) - size
    row = np.repeat(np.arange(len(size)), size)
    order = np.argsort(gid, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(gid[order]) != 0])) if len(gid) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(gid)], strict=True):
        acc = np.zeros(width, np.int64)
        mine = order[lo:hi]                              # the group's postings in the block
        reach = np.cumsum(size[row[mine]])
        first = 0
        while first < len(mine):                         # so many index rows at a time
            last = max(first + 1, int(np.searchsorted(reach, (reach[first - 1] if first else 0) + CHUNK)))
            own = mine[first:last]
            n = size[row[own]]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[row[own]], n)
            pa_, pa0, pb, pb0 = np.repeat(p[own], n), np.repeat(p0[own], n), p[at], p0[at]
            gain = (squared_gap(pa_, pb) - squared_gap(pa_, pb0)
                    - squared_gap(pa0, pb) + squared_gap(pa0, pb0))
            np.add.at(acc, gid[at], gain)
            first = last
        acc[gid[mine[0]]] = 0
        yield int(gid[mine[0]]), acc


def _scatter_task():
    def run(batches):
        held, size_held = {}, 0
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lang in dict.fromkeys(langs):
                part = batch.filter(pa.array(langs == lang))
                size = pa.compute.list_value_length(part.column(1)).to_numpy().astype(np.int64)
                post = part.column(1).flatten()
                gid, p, p0 = (post.field(i).to_numpy().astype(np.int64) for i in range(3))
                for group, acc in scatter_block(size, gid, p, p0):
                    before = held.get((lang, group), acc[:0])
                    short, long_ = sorted((before, acc), key=len)
                    long_[:len(short)] += short
                    held[(lang, group)] = long_
                    size_held += len(long_) - len(before)
                    if size_held > HELD:
                        yield _accumulators(held)
                        held, size_held = {}, 0
        if held:
            yield _accumulators(held)

    return run


def _baseline_task():
    """Per group the sum of its shares' gaps to each peer's zero baseline: the terms it holds, as if
    no peer held them, and its share of the terms that neither holds."""

    def run(batches):
        for batch in batches:
            out = {}
            for lang, gid, vocabulary, p0, mine, peers in zip(
                    *[batch.column(i) for i in range(6)], strict=True):
                peer0 = peers.values.to_numpy().astype(np.int64)
                p, n = ((mine.values.field(i).to_numpy().astype(np.int64) if len(mine.values) else
                         np.zeros(0, np.int64)) for i in range(2))
                zero = squared_gap(np.int64(p0.as_py()), peer0)
                # V - n(A) - n(B) terms are in neither: half of V and own n(A) here, the rest there
                acc = -zero * n.sum()
                step = max(1, CHUNK // max(1, len(peer0)))
                for lo in range(0, len(p), step):
                    gap = squared_gap(p[lo:lo + step, None], peer0[None, :])
                    acc += (gap * n[lo:lo + step, None]).sum(axis=0)
                own = gid.as_py()
                later = np.arange(len(peer0)) > own
                acc += np.where(later, zero * vocabulary.as_py(), 0)
                acc[own] = 0
                out[(lang.as_py(), own)] = acc
            if out:
                yield _accumulators(out)

    return run


# --------------------------------------------------------------------------------- operator

def divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, lang_col: str = "lang",
               source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased; a language keeps the V
    terms found in at least ``min_docs`` of its rows.  A group (language and source), and the
    language itself, gives a term p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N its occurrences of
    kept terms.  The gap of two shares is floor((p - q)^2 / (p + q)).

    Part ``pair``: for every other source of the language the gaps summed over all kept terms (0 if
    there are none), all ranks.  Part ``term``: kept terms that the group holds and gives more than
    the language does, by their gap, ranks up to ``top``.  Values fall with the rank; ties go by the
    item's UTF-8 bytes.

    Null language, source and text count as empty strings, which are a language and a source of their
    own.  Every row is a document, whatever its id, also a repeated one.  Groups without terms take
    part.  Other columns are not read; an empty table gives an empty result.

    The output has a row per ordered pair of a language's sources; no step makes more rows than that
    or than there are (term, source) postings.  A task holds a batch of index rows and accumulators
    of bounded total size; a language's list of zero baselines travels with each of its groups.
    """
    index = checkpoint(term_index(docs, min_docs, lang_col, source_col, text_col))
    kept = index.where(F.col("term") != "")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_total"))
    totals = (kept.select("lang", F.explode("groups").alias("g")).groupBy("lang", F.col("g.source").alias("source"))
              .agg(F.sum("g.n").alias("total")))
    named = index.where(F.col("term") == "").select(
        "lang", F.posexplode(F.array_sort(F.col("groups.source"))).alias("gid", "source"))
    groups = (named.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", "gid", F.coalesce("total", F.lit(0)).alias("total"),
                      F.coalesce("v", F.lit(0)).alias("v"), "lang_total"))
    # without kept terms nothing is ever divided by N + 2 V = 0
    groups = checkpoint(groups.withColumn(
        "p0", F.when(F.col("v") > 0, _share(F.lit(0), "total", "v")).otherwise(F.lit(1)).cast("long")))

    posts = kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("groups").alias("g"))
    posts = attach_counted(posts.select("lang", "term", "lang_n", F.col("g.source").alias("source"),
                                        F.col("g.n").alias("n")).where(F.col("n") > 0),
                           groups, ["lang", "source"], "inner")
    posts = checkpoint(posts.select(
        "lang", "source", "term", "gid", "p0", _share(F.col("n"), "total", "v").cast("long").alias("p"),
        _share(F.col("lang_n"), "lang_total", "v").cast("long").alias("q")))

    return _pairs(posts, groups).unionByName(_terms(posts, top))


def _terms(posts: DataFrame, top: int) -> DataFrame:
    gap = F.col("p") - F.col("q")
    rank = F.row_number().over(Window.partitionBy("lang", "source")
                               .orderBy(F.desc("value"), F.asc("term")))
    return (posts.where(F.col("p") > F.col("q"))
            .select("lang", "source", "term", _div(gap * gap, F.col("p") + F.col("q")).alias("value"))
            .withColumn("rank", rank).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def _pairs(posts: DataFrame, groups: DataFrame) -> DataFrame:
    rows = (posts.repartition("lang", "term").groupBy("lang", "term")
            .agg(F.collect_list(F.struct("gid", "p", "p0")).alias("row")))
    common = rows.select("lang", "row").mapInArrow(_scatter_task(), ACCUMULATED)

    shares = (posts.groupBy("lang", "gid", "p").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("lang", "gid").agg(F.collect_list(F.struct("p", "n")).alias("shares")))
    peers = (groups.groupBy("lang")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("gid", "p0"))), lambda x: x["p0"]).alias("peers")))
    base = (groups.join(shares, ["lang", "gid"], "left").join(peers, "lang")
            .select("lang", "gid", "v", "p0",
                    F.coalesce("shares", F.array().cast("array<struct<p:bigint,n:bigint>>")).alias("shares"), "peers")
            .mapInArrow(_baseline_task(), ACCUMULATED))
    # a group's baseline part counts for it and, turned round, for its peer
    flat = lambda df: df.select("lang", "gid", F.explode(F.arrays_zip("peers", "value")).alias("z")).select(
        "lang", "gid", F.col("z.peers").alias("peer"), F.col("z.value").alias("value"))
    base = flat(base)
    turned = base.select("lang", F.col("peer").alias("gid"), F.col("gid").alias("peer"), "value")
    sums = (flat(common).union(base).union(turned).groupBy("lang", "gid", "peer")
            .agg(F.sum("value").alias("value")))
    mine = groups.select("lang", "gid", "source")
    other = groups.select("lang", F.col("gid").alias("peer"), F.col("source").alias("item"))
    pairs = (mine.join(other, "lang").where(F.col("gid") != F.col("peer"))
             .join(sums, ["lang", "gid", "peer"], "left"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return (pairs.select("lang", "source", F.lit("pair").alias("part"), "item",
                         F.coalesce("value", F.lit(0)).alias("value"))
            .withColumn("rank", rank))
