"""Suffix-array dedup: bytes covered by a long string that starts earlier are removed.

A *window* is a string of ``length`` bytes.  Equal windows must meet without shipping every
suffix, so windows are dealt by an anchor that depends on nothing but their bytes: the smallest
hash of the ANCHOR-byte strings inside.  Neighbouring windows mostly share their anchor and travel
as one *run*, a stretch of text at most twice as long as a window; equal windows are always in
runs of the same anchor.

1. Every text is cut into runs.  Per run only hashes of the anchor and of the bytes, and the place,
   are shuffled (about 20 bytes for 36 bytes of text).  Runs with the same bytes are settled there:
   all but the earliest are repeats.  Runs alone with their anchor are settled too.
2. Of the others, one run per distinct content is fetched from its text, and the runs of an anchor
   become one text whose suffixes are sorted (:mod:`tabforge.llm.gsaca`).  Equal windows are
   neighbours in that order, and all but the earliest of them are repeats.
3. Anchors with more than GROUP_RUNS distinct runs (a line that a third of all documents hold) are
   divided before that: their runs are cut where the two smallest hashes of a window change, and
   each pair of hashes is a group of its own.  Pieces with the same bytes are settled as runs are.
   Groups that still hold more than GATHER_RUNS pieces are cut by one more hash, and so on.  Inside
   its task a group is cut the same way down to SORT_RUNS, since many short texts sort side by side.
4. Repeats go back to the documents and their bytes are cut out.

So content hashes settle only what is equal as a whole; among unequal runs and pieces the suffix
order decides every window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tabforge.llm.common import text_bytes
from tabforge.llm.gsaca import suffix_order
from tabforge.session import scratch_path

ANCHOR = 32
GROUP_RUNS, SORT_RUNS = 4096, 64
#: Pieces of a divided anchor that one task may gather (about 130 bytes each).
GATHER_RUNS = 1 << 16
SLICE = 1 << 20
#: Symbols that are sorted side by side.
SORT_AT_ONCE = 1 << 20
RUN, SPAN, PIECE, HOT, FETCH, DIVIDE = range(6)
#: A place and a number of windows travel as one long, place * PLACE + number.
PLACE = 1 << 16
#: Windows whose hashes are sorted at once.
CUT_AT_ONCE = 1 << 14
_NULL_ID, _NULL_SEQ = (1 << 63) - 1, 1 << 30

DEALT = ("bucket int, kind int, h array<int>, a array<long>, b array<long>, doc array<long>, "
         "seq array<int>, start array<int>, n array<int>")
FLAT = "kind int, doc long, seq int, start int, n int, a long, b long"
_COLUMNS = (("h", np.int32), ("a", np.int64), ("b", np.int64), ("doc", np.int64), ("seq", np.int32),
            ("start", np.int32), ("n", np.int32))


# ------------------------------------------------------------------------------------- runs

def runs_of(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor hash, first window, windows)`` of the runs of a text, in order."""
    found = []
    for lo in range(0, len(raw) - length + 1, SLICE - length):
        found.append(_runs_of_slice(raw[lo:lo + SLICE - 1], length, lo))
        if lo + SLICE - 1 >= len(raw):
            break
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _anchor_hashes(raw: bytes) -> np.ndarray:
    """Hashes of all strings of ANCHOR bytes."""
    x = np.frombuffer(raw, np.uint8).astype(np.uint64)
    h, width = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
    while width < ANCHOR:  # from hashes of width bytes to those of twice as many
        left, right = h[:-width], h[width:]
        h = (left * np.uint64(0xD6E8FEB86659FD93) ^ (right >> np.uint64(29))) + right * np.uint64(0xA0761D6478BD642F)
        h ^= h >> np.uint64(32)
        width *= 2
    return h


def pieces_of(strings: list[bytes], length: int, level: int):
    """``(string, first window, windows, key)`` of the pieces of strings: stretches of windows with
    the same ``level`` smallest hashes, which make the key.  Equal windows have equal keys."""
    sizes = np.array([len(s) for s in strings], np.int64)
    hashes = _anchor_hashes(b"".join(strings)) >> np.uint64(20)
    count = sizes - length + 1
    of = np.repeat(np.arange(len(sizes)), count)
    at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    place = np.repeat(np.cumsum(sizes) - sizes, count) + at
    view = np.lib.stride_tricks.sliding_window_view(hashes, length - ANCHOR + 1)
    key = np.empty(len(of), np.uint64)
    for lo in range(0, len(of), CUT_AT_ONCE):
        least = np.partition(view[place[lo:lo + CUT_AT_ONCE]], level - 1, axis=1)[:, :level]
        least.sort(axis=1)
        mixed = np.zeros(len(least), np.uint64)
        for column in least.T:
            mixed = (mixed ^ column) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        key[lo:lo + CUT_AT_ONCE] = mixed
    fresh = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])])) \
        if len(of) else np.zeros(0, np.int64)
    return of[fresh], at[fresh], np.diff(np.append(fresh, len(of))), key[fresh].view(np.int64)


def _pieces(strings, doc, seq, start, length, level):
    """Pieces of runs at ``(doc, seq, start)``: sorted columns ``key, content, doc, seq, start, n``,
    the pieces' bytes, and which of equal bytes come first."""
    of, at, n, key = pieces_of(strings, length, level)
    found = [strings[r][a:a + m + length - 1] for r, a, m in zip(of.tolist(), at.tolist(), n.tolist(), strict=True)]
    content = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)
    doc, seq, start = doc[of], seq[of], start[of] + at
    order = np.lexsort((start, seq, doc, content, key))
    key, content, doc, seq, start, n = (x[order] for x in (key, content, doc, seq, start, n))
    return (key, content, doc, seq, start, n), [found[i] for i in order.tolist()], _fresh(key, content)


def _fresh(key, content) -> np.ndarray:
    out = np.ones(len(key), bool)
    out[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
    return out


def _runs_of_slice(raw: bytes, length: int, lo: int):
    h = _anchor_hashes(raw)
    # 44 bits of hash over 20 bits of place: the least one is the first of equal hashes
    least = (h & ~np.uint64(SLICE - 1)) | np.arange(len(h), dtype=np.uint64)
    reach, wide = length - ANCHOR + 1, 1
    while wide * 2 <= reach:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if reach > wide:
        least = np.minimum(least[:wide - reach], least[reach - wide:])
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return ((least[first] >> np.uint64(20)).astype(np.int64), first + lo,
            np.diff(np.append(first, len(least))))


def _table(kind: int, bucket: np.ndarray, columns: dict) -> list[pa.RecordBatch]:
    """One row per bucket with the columns' values as arrays (absent ones empty)."""
    if not len(bucket):
        return []
    order = np.argsort(bucket, kind="stable")
    sorted_ = bucket[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    cuts = pa.array(np.append(starts, len(order)), pa.int32())
    none = pa.array(np.zeros(len(starts) + 1, np.int32), pa.int32())
    arrays = [pa.array(sorted_[starts], pa.int32()), pa.array(np.full(len(starts), kind), pa.int32())]
    for name, dtype in _COLUMNS:
        here = name in columns
        values = np.asarray(columns[name])[order].astype(dtype) if here else np.zeros(0, dtype)
        arrays.append(pa.ListArray.from_arrays(cuts if here else none, pa.array(values)))
    return [pa.RecordBatch.from_arrays(arrays, names=["bucket", "kind", *[n for n, _ in _COLUMNS]])]


def _cut_task(length: int, buckets: int):
    def run(batches):
        for batch in batches:
            ids, seqs = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            texts = list(text_bytes(batch.column(2)))
            found = [runs_of(t, length) for t in texts]
            count = np.array([len(f[0]) for f in found])
            if not count.sum():
                continue
            h, start, n = (np.concatenate(x) for x in zip(*found, strict=True))
            doc = np.repeat(np.arange(len(texts)), count)
            content = np.fromiter(
                (xxhash.xxh3_64_intdigest(texts[d][s:s + k + length - 1])
                 for d, s, k in zip(doc.tolist(), start.tolist(), n.tolist(), strict=True)),
                np.uint64, len(doc)).view(np.int64)
            rank = np.empty(len(texts), np.int64)
            rank[np.lexsort((seqs, ids))] = np.arange(len(texts))
            order = np.lexsort((start, rank[doc], content, h))
            h, start, n, doc, content = (x[order] for x in (h, start, n, doc, content))
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (content[1:] != content[:-1])
            yield from _table(SPAN, ids[doc[~fresh]] % buckets, {
                "doc": ids[doc[~fresh]], "seq": seqs[doc[~fresh]], "start": start[~fresh], "n": n[~fresh]})
            h, start, n, doc, content = (x[fresh] for x in (h, start, n, doc, content))
            edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            many = np.diff(np.append(edge, len(h)))
            hot = np.repeat(many > GROUP_RUNS, many)
            yield from _table(HOT, h[edge][many > GROUP_RUNS] % buckets,
                              {"h": _short(h[edge][many > GROUP_RUNS], buckets)})
            if hot.any():
                strings = [texts[d][x:x + k + length - 1] for d, x, k in
                           zip(doc[hot].tolist(), start[hot].tolist(), n[hot].tolist(), strict=True)]
                found, _, first = _pieces(strings, ids[doc[hot]], seqs[doc[hot]], start[hot], length, 2)
                key, same, d, q, x, k = (c[~first] for c in found)
                yield from _table(SPAN, d % buckets, {"doc": d, "seq": q, "start": x, "n": k})
                key, same, d, q, x, k = (c[first] for c in found)
                yield from _table(PIECE, (key & 0xFFFFFFFF) % buckets, {
                    "a": key, "b": same, "doc": d, "seq": q, "start": x, "n": k})
            cool = ~hot
            yield from _table(RUN, h[cool] % buckets, {
                "h": _short(h[cool], buckets), "a": content[cool], "doc": ids[doc[cool]],
                "seq": seqs[doc[cool]], "start": start[cool], "n": n[cool]})

    return run


def _short(h: np.ndarray, buckets: int) -> np.ndarray:
    """32 bits that, with the bucket, name an anchor.  Anchors that share a name cost a comparison
    of their runs and nothing else."""
    return ((h // buckets) & 0xFFFFFFFF).astype(np.uint32).view(np.int32)


# --------------------------------------------------------------------------------- settling

def _flat(kind, doc, seq, start, n=None, a=None, b=None) -> pa.RecordBatch:
    size = len(doc)
    fill = lambda v: np.zeros(size, np.int64) if v is None else v
    kinds = np.full(size, kind) if np.isscalar(kind) else kind
    types = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(fill(v)), t, safe=False) for v, t in
         zip((kinds, doc, seq, start, n, a, b), types, strict=True)],
        names=["kind", "doc", "seq", "start", "n", "a", "b"])


def _settle_task():
    """Compare the runs of each anchor, and the pieces of each group, by their hashes."""

    def settled(key, a, doc, seq, start, n):
        order = np.lexsort((start, seq, doc, a, key))
        key, a, doc, seq, start, n = (x[order] for x in (key, a, doc, seq, start, n))
        fresh = _fresh(key, a)
        return (_flat(SPAN, doc[~fresh], seq[~fresh], start[~fresh], n[~fresh]),
                tuple(x[fresh] for x in (key, doc, seq, start, n)))

    def run(batches):
        held, pieces, marks = [], [], []
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            for kind in np.unique(kinds):
                part = batch.filter(pa.array(kinds == kind))
                cols = {n: part.column(i + 2).flatten().to_numpy() for i, (n, _) in enumerate(_COLUMNS)}
                if kind == SPAN:
                    yield _flat(SPAN, cols["doc"], cols["seq"], cols["start"], cols["n"])
                    continue
                if kind == PIECE:
                    pieces.append([cols[c] for c in ("a", "b", "doc", "seq", "start", "n")])
                    continue
                counts = pa.compute.list_value_length(part.column(2)).to_numpy()
                key = np.repeat(part.column(0).to_numpy().astype(np.int64) << 32, counts)
                key = key | cols["h"].astype(np.int64) & 0xFFFFFFFF
                if kind == RUN:
                    held.append((key, *[cols[c] for c in ("a", "doc", "seq", "start", "n")]))
                else:
                    marks.append(key)
        if pieces:
            spans, (key, doc, seq, start, n) = settled(*(np.concatenate(x) for x in zip(*pieces, strict=True)))
            yield spans
            yield _flat(DIVIDE, doc, seq, start, n, key)
        if not held:
            return
        pieces.clear()
        spans, (key, doc, seq, start, n) = settled(*(np.concatenate(x) for x in zip(*held, strict=True)))
        held.clear()
        yield spans
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        many = np.diff(np.append(edge, len(key)))
        hot = np.isin(key[edge], np.concatenate(marks)) if marks else np.zeros(len(edge), bool)
        ask = np.where(hot | (many > GROUP_RUNS), DIVIDE, np.where(many > 1, FETCH, -1))
        ask = np.repeat(ask, many)
        go = ask >= 0
        yield _flat(ask[go], doc[go], seq[go], start[go], n[go], key[go])

    return run


def _fetched(kind, doc, seq, start, a, n, s) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in
         zip((np.full(len(doc), kind), doc, seq, start, a, n, s), types, strict=True)],
        names=["kind", "doc", "seq", "start", "a", "n", "s"])


def _divided(strings, doc, seq, start, length, level):
    """Pieces of runs: those that come first with their bytes, the others as spans."""
    (key, _, doc, seq, start, n), found, first = _pieces(strings, doc, seq, start, length, level)
    yield _fetched(RUN, doc[first], seq[first], start[first], key[first], n[first],
                   [x for x, f in zip(found, first.tolist(), strict=True) if f])
    if not first.all():
        rest = ~first
        yield _fetched(SPAN, doc[rest], seq[rest], start[rest], key[rest], n[rest],
                       pa.nulls(int(rest.sum()), pa.binary()))


def _fetch_task(length: int):
    """Bytes of the runs that are asked for, or of their pieces."""

    def run(batches):
        for batch in batches:
            ids, seqs = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            texts = list(text_bytes(batch.column(2)))
            asked = batch.column(3)
            doc = np.repeat(np.arange(len(texts)), pa.compute.list_value_length(asked).to_numpy())
            place, key = (asked.flatten().field(i).to_numpy() for i in range(2))
            divide, (start, n) = place < 0, np.divmod(np.abs(place), PLACE)
            for lo in range(0, len(doc), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                d, cut, s, m, name = doc[part], divide[part], start[part], n[part], key[part]
                strings = [texts[i][x:x + y + length - 1] for i, x, y in
                           zip(d.tolist(), s.tolist(), m.tolist(), strict=True)]
                whole = np.flatnonzero(~cut)
                yield _fetched(RUN, ids[d[whole]], seqs[d[whole]], s[whole], name[whole], m[whole],
                               [strings[i] for i in whole.tolist()])
                if len(whole) < len(d):
                    yield from _divided([x for x, c in zip(strings, cut.tolist(), strict=True) if c],
                                        ids[d[cut]], seqs[d[cut]], s[cut], length, 2)

    return run


def _divide_task(length: int, level: int):
    def run(batches):
        for batch in batches:
            doc, seq, start = (batch.column(i).to_numpy() for i in range(1, 4))
            yield from _divided(batch.column(6).to_pylist(), doc, seq, start, length, level)

    return run


FETCHED = "kind int, doc long, seq int, start int, a long, n int, s binary"


def repeated_windows(groups: list[list[tuple]], length: int):
    """Repeats among the runs of each group: ``(doc, seq, start, n)`` arrays of windows that
    another run of the group holds earlier.  A group is a list of ``(doc, seq, start, bytes)``."""
    out = []
    groups = sorted(groups, key=lambda g: sum(len(r[3]) for r in g))
    lo = 0
    while lo < len(groups):
        hi, total = lo, 0
        while hi < len(groups) and (hi == lo or total < SORT_AT_ONCE):
            total += sum(len(r[3]) + 1 for r in groups[hi])
            hi += 1
        out.append(_repeated_in(groups[lo:hi], length))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _repeated_in(groups, length):
    runs = [r for g in groups for r in g]
    sizes = np.array([len(r[3]) + 1 for r in runs])
    ends = np.cumsum(sizes)
    symbols = np.ones(ends[-1], np.int64)
    raw = np.frombuffer(b"\0".join(r[3] for r in runs) + b"\0", np.uint8)
    symbols += raw
    symbols[ends - 1] = 0
    in_group = np.cumsum([len(g) for g in groups])
    text_ends = ends[in_group - 1]
    order = suffix_order(symbols, np.diff(np.append(0, text_ends)))

    owner = np.repeat(np.arange(len(runs)), sizes)
    left = ends[owner] - 1 - np.arange(len(symbols))
    order = order[left[order] >= length]                # suffixes that begin with a whole window
    windows = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.uint16), length)
    same = np.zeros(len(order), bool)
    for lo in range(1, len(order), 1 << 15):
        hi = min(len(order), lo + (1 << 15))
        same[lo:hi] = (windows[order[lo:hi]] == windows[order[lo - 1:hi - 1]]).all(axis=1)
    group_of = np.repeat(np.arange(len(groups)), [len(g) for g in groups])[owner]
    same[1:] &= group_of[order[1:]] == group_of[order[:-1]]
    first = np.flatnonzero(~same)
    doc, seq, start = (np.array([r[i] for r in runs], np.int64) for i in range(3))
    rank = np.empty(len(runs), np.int64)
    rank[np.lexsort((start, seq, doc))] = np.arange(len(runs))
    rank = rank[owner[order]]
    repeat = np.zeros(0, np.int64)
    if len(order):
        least = np.minimum.reduceat(rank, first)
        repeat = np.sort(order[rank > np.repeat(least, np.diff(np.append(first, len(order))))])
    # neighbouring windows of a run become one span
    cut = np.ones(len(repeat), bool)
    cut[1:] = (repeat[1:] != repeat[:-1] + 1) | (owner[repeat[1:]] != owner[repeat[:-1]])
    at = np.flatnonzero(cut)
    of = owner[repeat[at]]
    where = start[of] + repeat[at] - (ends[of] - sizes[of])
    return doc[of], seq[of], where, np.diff(np.append(at, len(repeat)))


def small_groups(group: list[tuple], length: int):
    """``(spans, groups)``: a group cut to groups of at most SORT_RUNS unequal pieces, by ever more
    hashes, and the spans that repeat a whole piece."""
    first, spans = {}, []
    for doc, seq, start, raw in sorted(group, key=lambda r: r[:3]):
        if raw in first:
            spans.append((doc, seq, start, len(raw) - length + 1))
        else:
            first[raw] = (doc, seq, start, raw)
    todo, done = [(list(first.values()), 2)], []
    while todo:
        rows, level = todo.pop()
        if len(rows) <= SORT_RUNS or level > length - ANCHOR + 1:
            if len(rows) > 1:
                done.append(rows)
            continue
        doc, seq, start = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        (key, _, doc, seq, start, n), found, fresh = _pieces([r[3] for r in rows], doc, seq, start, length, level)
        spans += zip(*(x[~fresh].tolist() for x in (doc, seq, start, n)), strict=True)
        at = np.flatnonzero(fresh)
        cuts = np.flatnonzero(key[at][1:] != key[at][:-1]) + 1
        for part in np.split(at, cuts):
            todo.append(([(int(doc[i]), int(seq[i]), int(start[i]), found[i]) for i in part], level + 1))
    return spans, done


def _sort_task(length: int):
    def run(batches):
        groups: dict[int, list] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            other = table.filter(pa.compute.equal(table["kind"], SPAN))
            if other.num_rows:
                yield _flat(SPAN, *(other[c].to_numpy() for c in ("doc", "seq", "start", "n")))
            own = table.filter(pa.compute.equal(table["kind"], RUN))
            for row in zip(*[own[c].to_pylist() for c in ("a", "doc", "seq", "start", "s")], strict=True):
                groups.setdefault(row[0], []).append(row[1:])
        small = []
        for key in list(groups):
            spans, parts = small_groups(groups.pop(key), length)
            small += parts
            if spans:
                yield _flat(SPAN, *(np.array(x, np.int64) for x in zip(*spans, strict=True)))
        if small:
            yield _flat(SPAN, *repeated_windows(small, length))

    return run


# ---------------------------------------------------------------------------------- operator

def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``_doc`` and ``_seq``, which order and tell apart all rows: rows that repeat an
    id are numbered by their text's hash, rows without one come after all others."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID))
    again = docs.groupBy(F.col(id_col)).count().where((F.col("count") > 1) | F.col(id_col).isNull())
    if again.isEmpty():
        return docs.withColumns({"_doc": key, "_seq": F.lit(0)})
    order = Window.partitionBy("_doc", F.col(id_col).isNull()).orderBy(F.xxhash64(text_col))
    seq = F.row_number().over(order) - 1 + F.when(F.col(id_col).isNull(), _NULL_SEQ).otherwise(0)
    return docs.withColumn("_doc", key).withColumn("_seq", seq.cast("int"))


def _packed(sign, start, n):
    """Place and number as one long; ``sign`` is kept as the sign (n is never 0)."""
    value = F.col(start).cast("long") * PLACE + n.cast("long")
    return F.when(sign, -value).otherwise(value)


def _written(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _grouped(fetched: DataFrame, length: int, group_runs: int) -> DataFrame:
    """``fetched`` with no group of more than ``group_runs`` pieces: larger ones are cut by one more
    hash, until the windows of a group are equal but for what hashes have not seen."""
    done = None
    for level in range(3, length - ANCHOR + 2):
        large = (fetched.where(F.col("kind") == RUN).groupBy("a").agg(F.count(F.lit(1)).alias("many"))
                 .where(F.col("many") > group_runs).select("a"))
        if large.isEmpty():
            break
        deeper = (fetched.where(F.col("kind") == RUN).join(large, "a", "left_semi").select(*fetched.columns)
                  .mapInArrow(_divide_task(length, level), FETCHED))
        # only the large groups are written again
        small = (fetched.where(F.col("kind") == RUN).join(large, "a", "left_anti").select(*fetched.columns)
                 .union(fetched.where(F.col("kind") == SPAN)))
        done = small if done is None else done.union(small)
        fetched = _written(deeper, fetched.sparkSession, "pieces")
    return fetched if done is None else done.union(fetched)


def repeated_spans(docs: DataFrame, length: int, group_runs: int = GATHER_RUNS) -> DataFrame:
    """``(doc, seq, span)``: windows, packed, that also start earlier."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("_doc", "_seq", "__text")
    buckets = 4 * parts
    settled = _written(
        keyed.mapInArrow(_cut_task(length, buckets), DEALT).repartition(parts, "bucket")
        .mapInArrow(_settle_task(), FLAT), spark, "runs")
    asked = (settled.where(F.col("kind") >= FETCH)
             .groupBy("doc", "seq")
             .agg(F.collect_list(F.struct(_packed(F.col("kind") == DIVIDE, "start", F.col("n")), "a")).alias("asked")))
    found = (keyed.join(asked, (F.col("_doc") == F.col("doc")) & (F.col("_seq") == F.col("seq")))
             .select("_doc", "_seq", "__text", "asked"))
    fetched = _grouped(_written(found.mapInArrow(_fetch_task(length), FETCHED), spark, "pieces"),
                       length, group_runs)
    sorted_ = _written(fetched.repartition(parts, "a").mapInArrow(_sort_task(length), FLAT), spark, "repeats")
    return (settled.where(F.col("kind") == SPAN).union(sorted_)
            .select("doc", "seq", _packed(F.lit(False), "start", F.col("n")).alias("span")))


def _remove_udf(length: int):
    @arrow_udf("struct<kept:binary,n_bytes:long,n_removed:long,n_spans:long>")
    def remove(text: pa.Array, spans: pa.Array) -> pa.Array:
        kept, sizes, gone, count = [], [], [], []
        for raw, here in zip(text_bytes(text), spans, strict=True):
            pieces, upto, runs, lost = [], 0, 0, 0
            if here.is_valid:
                start, n = np.divmod(here.values.to_numpy(), PLACE)
                order = np.argsort(start)
                end = np.maximum.accumulate((start + n)[order] + length - 1)
                start = start[order]
                opens = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]])[:len(start)])
                closes = end[np.append(opens[1:] - 1, len(end) - 1)[:len(opens)]]
                for a, b in zip(start[opens].tolist(), closes.tolist(), strict=True):
                    pieces.append(raw[upto:a])
                    upto, runs, lost = b, runs + 1, lost + b - a
            pieces.append(raw[upto:])
            kept.append(b"".join(pieces))
            sizes.append(len(raw))
            gone.append(lost)
            count.append(runs)
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in (sizes, gone, count)]],
            names=["kept", "n_bytes", "n_removed", "n_spans"])

    return remove


def dedup_substrings(docs: DataFrame, length: int = 100, id_col: str = "doc_id",
                     text_col: str = "text", group_runs: int = GATHER_RUNS) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts earlier: in a smaller
    id, or in the same document before.  Strings overlap, don't cross documents, and are judged on
    the input.

    Returns ``docs`` with ``kept`` (the bytes left, as binary), ``n_bytes``, ``n_removed`` and
    ``n_spans`` (maximal removed runs); columns of these names are replaced.

    Null and empty texts, and those shorter than ``length``, lose nothing.  Rows that repeat an id
    are documents of their own, ordered by their text's hash; rows without an id come last.  An
    empty table gives an empty result; long texts are cut into runs by slices.  Tables of places, and
    one of the stretches of text that the sorting compares, are written to the shared checkpoint
    folder.  ``spark.sql.shuffle.partitions`` sets the share of the runs a task holds.
    """
    if not 2 * ANCHOR <= length < PLACE:
        raise ValueError(f"length must be from {2 * ANCHOR} to {PLACE - 1}")
    numbered = (_numbered(docs, id_col, text_col)
                .withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    spans = (repeated_spans(numbered, length, group_runs).groupBy("doc", "seq")
             .agg(F.collect_list("span").alias("_spans"))
             .withColumnsRenamed({"doc": "_sdoc", "seq": "_sseq"}))
    joined = numbered.join(spans, (F.col("_doc") == F.col("_sdoc")) & (F.col("_seq") == F.col("_sseq")),
                           "left")
    out = joined.withColumn("_out", _remove_udf(length)(F.col("__text"), F.col("_spans")))
    return out.withColumns({c: F.col(f"_out.{c}") for c in ("kept", "n_bytes", "n_removed", "n_spans")}
                           ).drop("_out", "_spans", "_sdoc", "_sseq", "_doc", "_seq", "__text")
