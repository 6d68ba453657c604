"""MinHash near-duplicates with b-bit signatures.

1. Every text gets MINIMA minima of its shingles' hashes.  A band key hashes ROWS minima whole; of
   each minimum only BITS low bits are retained, packed side by side.
2. Texts with equal words are one class from here on, so a group of copies costs one row.
3. Classes that share a band key are a bucket.  Within it packed signatures are compared by bit
   counts: m matches of k minima estimate the similarity (m / k - c) / (1 - c), with c = 2^-BITS
   for the collisions of unequal minima.  Pairs far enough below the wanted similarity go.
   Of the others a spanning forest leaves the bucket, so n near copies cost n rows, not n^2.
4. The forests' components are the groups within which links are confirmed on the full shingle
   sets, read from one text of each class.  Again only a spanning forest of the links comes out;
   its components are the result.  Groups too large for a task are cut into blocks that meet in
   pairs.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import text_bytes
from tabforge.llm.components import connected_components
from tabforge.session import checkpoint, scratch_path

BITS = 4
SEED = 42
#: Shingles whose minima are taken at once; signatures compared at once.
CHUNK, BLOCK = 4096, 1 << 20
#: Classes and bytes of shingle sets up to which a group is gathered in one task.
GROUP_ROWS, GROUP_BYTES = 8192, 1 << 26
_LOW = np.uint64(0x1111111111111111)


# ------------------------------------------------------------------------------ signatures

def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted; fewer words are one shingle, none are none."""
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh3_64_intdigest(line, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)),
                                 np.uint64, len(starts)))


class Signer:
    """Minima, band keys and packed low bits of a shingle set."""

    def __init__(self, minima: int, rows: int):
        if minima % rows or minima * BITS % 64:
            raise ValueError("minima must be a multiple of the band rows and fill whole 64-bit words")
        rng = np.random.default_rng(SEED)
        self.minima, self.rows = minima, rows
        self.times = rng.integers(0, 1 << 64, minima, dtype=np.uint64) | np.uint64(1)
        self.plus = rng.integers(0, 1 << 64, minima, dtype=np.uint64)

    def least(self, hashes: np.ndarray) -> np.ndarray:
        """32-bit minima of the multiply-shift hashes."""
        out = np.full(self.minima, np.uint64(2 ** 64 - 1))
        for lo in range(0, len(hashes), CHUNK):
            mixed = hashes[lo:lo + CHUNK] * self.times[:, None]
            mixed += self.plus[:, None]
            np.minimum(out, mixed.min(axis=1), out=out)
        return (out >> np.uint64(32)).astype("<u4")

    def band_keys(self, least: np.ndarray) -> list[int]:
        bands = least.reshape(-1, self.rows)
        return [xxhash.xxh3_64_intdigest(band.tobytes(), i) for i, band in enumerate(bands)]

    def packed(self, least: np.ndarray) -> np.ndarray:
        low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, 64 // BITS)
        shifts = (np.arange(64 // BITS) * BITS).astype(np.uint64)
        return np.bitwise_or.reduce(low << shifts, axis=1)


def matches(a: np.ndarray, b: np.ndarray, minima: int) -> np.ndarray:
    """Equal b-bit minima of packed signatures (last axis: words), by bit counts."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    x &= _LOW
    return minima - np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def estimate(equal: np.ndarray, minima: int) -> np.ndarray:
    """Similarity from the number of equal b-bit minima, corrected for collisions."""
    c = 2.0 ** -BITS
    return (equal / minima - c) / (1 - c)


def least_matches(similarity: float, minima: int, deviations: float) -> int:
    """Equal minima below which a pair is refused: ``deviations`` standard deviations under what
    ``similarity`` leads one to expect."""
    p = 2.0 ** -BITS + (1 - 2.0 ** -BITS) * similarity
    return max(0, int(np.floor(minima * p - deviations * np.sqrt(minima * p * (1 - p)))))


SIGNED = "hi long, lo long, n_shingles long, sig binary, keys array<long>"


def _sign_task(shingle: int, minima: int, rows: int):
    signer = Signer(minima, rows)

    def run(batches):
        for batch in batches:
            out = []
            for raw in text_bytes(batch.column(1)):
                words = words_of(raw)
                name = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words), SEED), np.int64)
                hashes = shingle_hashes(words, shingle)
                if len(hashes):
                    least = signer.least(hashes)
                    keys = np.array(signer.band_keys(least), np.uint64).view(np.int64)
                    out.append((name[0], name[1], len(hashes), signer.packed(least).tobytes(), keys))
                else:
                    out.append((name[0], name[1], 0, b"", None))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
                names=["id", "hi", "lo", "n_shingles", "sig", "keys"])

    return run


# ------------------------------------------------------------------------------- candidates

def _alike(own, other, least: int, minima: int, part: Fraction) -> np.ndarray:
    """Which pairs of ``own`` and ``other`` (sizes, signatures) pass: enough equal minima, and sizes
    that allow the similarity at all."""
    equal = matches(own[1][:, None, :], other[1][None, :, :], minima)
    small, large = np.minimum(own[0][:, None], other[0][None, :]), np.maximum(own[0][:, None], other[0][None, :])
    return (equal >= least) & (small * part.denominator >= large * part.numerator)


def spanning_candidates(node, size, sig, alike) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that pass ``alike``, found breadth first."""
    links, rest = [], np.arange(len(node))
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            found = np.full(len(rest), -1)
            step = max(1, BLOCK // len(rest))
            for lo in range(0, len(front), step):
                own = front[lo:lo + step]
                open_ = np.flatnonzero(found < 0)
                near = alike((size[own], sig[own]), (size[rest[open_]], sig[rest[open_]]))
                hit = near.any(axis=0)
                found[open_[hit]] = own[near[:, hit].argmax(axis=0)]
            hit = found >= 0
            links += zip(node[found[hit]].tolist(), node[rest[hit]].tolist(), strict=True)
            front, rest = rest[hit], rest[~hit]
    return links


def _grouped(batches, keys: int):
    """Rows of each run of equal leading columns, as lists of column slices."""
    last, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(i).to_numpy() for i in range(keys)]
        edge = np.flatnonzero(np.any([n[1:] != n[:-1] for n in names], axis=0)) + 1
        for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows], strict=True):
            here = tuple(n[lo] for n in names)
            if here != last:
                if held:
                    yield held
                last, held = here, []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield held


def _signatures(parts, at: int) -> np.ndarray:
    raw = b"".join(v.as_buffer() for p in parts for v in p.column(at))
    return np.frombuffer(raw, np.uint64).reshape(sum(p.num_rows for p in parts), -1)


def _column(parts, at: int) -> np.ndarray:
    return np.concatenate([p.column(at).to_numpy(zero_copy_only=False) for p in parts])


def _link_batch(links) -> pa.RecordBatch:
    a = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])


def _bucket_task(least: int, minima: int, part: Fraction):
    def alike(own, other):
        return _alike(own, other, least, minima, part)

    def run(batches):
        for held in _grouped(batches, 2):
            links = spanning_candidates(_column(held, 2), _column(held, 3), _signatures(held, 4), alike)
            if links:
                yield _link_batch(links)

    return run


def candidate_links(members: DataFrame, signs: DataFrame, task, group_rows: int) -> DataFrame:
    """Links that join at least the classes that chains of passing pairs join: a spanning forest per
    bucket.  A bucket of more than ``group_rows`` classes is not gathered but joined whole; what that
    joins too much is parted again when links are confirmed."""
    sizes = members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least"))
    shared = checkpoint(members.join(sizes.where(F.col("n") > 1), ["band", "key"]))
    stars = shared.where((F.col("n") > group_rows) & (F.col("node") != F.col("least"))).select(
        F.col("least").alias("a"), F.col("node").alias("b"))
    small = (shared.where(F.col("n") <= group_rows).join(signs, "node")
             .select("band", "key", "node", "n_shingles", "sig")
             .repartition("band", "key").sortWithinPartitions("band", "key")
             .mapInArrow(task, "a long, b long"))
    return small.union(stars).distinct()


# ------------------------------------------------------------------------------- confirming

def _set_task(shingle: int):
    """``(hi, lo, set)``: the class of a text and its full shingle set."""

    def run(batches):
        for batch in batches:
            out = []
            for raw in text_bytes(batch.column(1)):
                words = words_of(raw)
                hi, lo = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words), SEED), np.int64)
                out.append((hi, lo, shingle_hashes(words, shingle).tobytes()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in
                                    zip(cols, (pa.int64(), pa.int64(), pa.binary()), strict=True)]],
                names=["id", "hi", "lo", "set"])

    return run


def confirmed_links(node, size, sig, sets, first: np.ndarray, least: int, minima: int,
                    part: Fraction) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of a group whose full sets have the similarity.  ``first``
    marks the rows to compare with all others.  Pairs that links join already are left out."""
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum([len(x) for x in sets])
    starts = ends - [len(x) for x in sets]
    label, links = np.arange(len(node)), []
    flag = np.zeros(int(ids.max(initial=-1)) + 1, bool)
    for i in np.flatnonzero(first).tolist():
        other = np.flatnonzero(label != label[i])
        if not len(other):
            break
        other = other[_alike((size[[i]], sig[[i]]), (size[other], sig[other]), least, minima, part)[0]]
        own = ids[starts[i]:ends[i]]
        flag[own] = True
        for lo in range(0, len(other), CHUNK):
            of = other[lo:lo + CHUNK]
            n = ends[of] - starts[of]
            cut = np.cumsum(n) - n
            both = np.add.reduceat(flag[ids[np.arange(n.sum()) + np.repeat(starts[of] - cut, n)]], cut,
                                   dtype=np.int64)
            true = of[both * part.denominator >= (n + len(own) - both) * part.numerator]
            for j in true.tolist():
                if label[j] != label[i]:
                    links.append((int(node[i]), int(node[j])))
                    label[label == label[j]] = label[i]
        flag[own] = False
    return links


def _confirm_task(least: int, minima: int, part: Fraction):
    def run(batches):
        for held in _grouped(batches, 3):
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for p in held for v in p.column(7)]
            links = confirmed_links(_column(held, 4), _column(held, 5), _signatures(held, 6), sets,
                                    _column(held, 3), least, minima, part)
            if links:
                yield _link_batch(links)

    return run


def _confirmed(groups: DataFrame, task, group_rows: int, group_bytes: int) -> DataFrame:
    """Confirmed links of ``groups (comp, node, n_shingles, sig, set)``.  A group beyond the limits is
    dealt to blocks, each pair of which is a group of its own; the first block's rows are compared
    with all rows."""
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / group_rows), F.ceil(F.sum("n_shingles") * 8 / group_bytes))
    sizes = groups.groupBy("comp").agg(blocks.cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (groups.join(sizes, "comp").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     (F.col("own") <= F.col("other")).alias("first"), "node", "n_shingles", "sig", "set"))
    return (dealt.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
            .mapInArrow(task, "a long, b long").distinct())


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """``(node, set)`` for ``nodes``: one text of each of their classes is read again."""
    wanted = classes.join(nodes, "node", "left_semi").select("node", "first", "hi", "lo")
    own = (docs.join(wanted.select("first").distinct(), docs["_id"].eqNullSafe(F.col("first")), "left_semi")
           .select("_id", "_text").mapInArrow(
               _set_task(shingle), f"id {docs.schema['_id'].dataType.simpleString()}, hi long, lo long, set binary"))
    found = own.join(wanted, own["id"].eqNullSafe(wanted["first"]) & (own["hi"] == wanted["hi"])
                     & (own["lo"] == wanted["lo"])).select("node", "set")
    return _written(found.dropDuplicates(["node"]), "sets")


# --------------------------------------------------------------------------------- operator

def minhash_groups(docs: DataFrame, similarity: Fraction | float | str = Fraction(4, 5), shingle: int = 5,
                   minima: int = 128, rows: int = 4, deviations: float = 5.0, id_col: str = "doc_id",
                   text_col: str = "text", group_rows: int = GROUP_ROWS,
                   group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` per row of ``docs``.

    A row's set are its distinct ``shingle``-word shingles (A-Z lower-cased; fewer words are one
    shingle).  Rows link when intersection over union of the full sets, as 64-bit hashes, is at least
    ``similarity`` (a fraction keeps it exact); ``component_id`` is the smallest id reachable, the
    row's own included, and ``kept`` marks the rows that have it.

    ``minima`` / ``rows`` bands miss a pair of similarity s with probability
    (1 - s^rows)^(minima / rows), 5e-11 at s = 0.85 and 4e-8 at 0.8; a pair is refused unconfirmed
    ``deviations`` standard deviations below what its estimate should be (3e-7).  No bucket, partner
    or candidate is capped.  Groups of more than ``group_rows`` classes or ``group_bytes`` bytes of
    shingle sets are split; a task holds at most two blocks of that size, or one class's set.

    Null and empty texts and those without words have an empty set and link with nothing, not even
    each other: their component is their own id.  Rows with equal words are always linked.  Rows that
    repeat an id are judged by their own texts.  Null ids never name a component that has another id;
    a component of null ids alone has none, and its rows are kept.  Long texts are read whole, in
    blocks of shingles.  Other columns are not read; an empty table gives an empty result.
    """
    part = Fraction(similarity).limit_denominator(10 ** 6)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    signed = checkpoint(texts.mapInArrow(_sign_task(shingle, minima, rows), f"id {id_type}, {SIGNED}"))
    classes = checkpoint(
        signed.where(F.col("n_shingles") > 0).groupBy("hi", "lo")
        .agg(F.min("id").alias("first"), F.any_value("n_shingles").alias("n_shingles"),
             F.any_value("sig").alias("sig"), F.any_value("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()))
    roots = _components(texts, classes, part, shingle, minima, deviations, group_rows, group_bytes)
    named = classes.select("hi", "lo", "node", "first").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = named.join(least, "root").select("hi", "lo", "component_id", F.lit(True).alias("linked"))
    out = signed.select("id", "hi", "lo", "n_shingles").join(of_class, ["hi", "lo"], "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def _components(texts: DataFrame, classes: DataFrame, part: Fraction, shingle: int, minima: int,
                deviations: float, group_rows: int, group_bytes: int) -> DataFrame:
    """``(node, root)`` of the classes with a confirmed link."""
    members = classes.select("node", "n_shingles", F.posexplode("keys").alias("band", "key"))
    signs = classes.select("node", "sig")
    least = least_matches(float(part), minima, deviations)
    loose = candidate_links(members, signs, _bucket_task(least, minima, part), group_rows)
    comps = checkpoint(connected_components(loose).withColumnRenamed("root", "comp"))
    groups = (_sets(texts, classes, comps.select("node"), shingle).join(comps, "node")
              .join(classes.select("node", "n_shingles", "sig"), "node"))
    links = _confirmed(groups, _confirm_task(least, minima, part), group_rows, group_bytes)
    return checkpoint(connected_components(links))
