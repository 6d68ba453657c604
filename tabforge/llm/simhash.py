"""SimHash near-duplicates with covering locality-sensitive hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tabforge.llm.common import text_bytes
from tabforge.llm.components import connected_components
from tabforge.session import checkpoint

BITS = 64
SEED = 42
#: Bucket size up to which all members are compared; larger buckets are divided by more bits.
MAX_BUCKET = 8192


def simhash(raw: bytes, shingle: int) -> int:
    """Unsigned fingerprint: a bit is 1 if it is set in over half of the shingles' XXH64."""
    words = raw.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for lo in range(0, len(starts), 65536):
        h = np.array([digest(line[a:b], SEED) for a, b in
                      zip(starts[lo:lo + 65536], ends[lo:lo + 65536], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def _fingerprint_udf(shingle: int):
    @arrow_udf("long")
    def fingerprint(text: pa.Array) -> pa.Array:
        values = np.fromiter((simhash(t, shingle) for t in text_bytes(text)), np.uint64, len(text))
        return pa.array(values.view(np.int64), pa.int64())

    return fingerprint


def covering_masks(radius: int) -> list[int]:
    """Bit masks of the covering family: bit i gets a vector m(i) of radius + 1 bits, and the
    mask of v keeps the bits with <m(i), v> = 1.  At most ``radius`` differing bits leave a
    vector v orthogonal to all of theirs, so the two fingerprints agree on all of v's mask."""
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
            for v in range(1, 2 ** (radius + 1))]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _divide_udf(radius: int):
    """Finer masks for a bucket: the bits in which its members vary are dealt to radius + 1 parts,
    and a pair within the radius agrees on all of at least one part."""

    @arrow_udf("array<long>")
    def finer_masks(mask: pa.Array, vary: pa.Array) -> pa.Array:
        out, known = [], {}
        for pair in zip(mask.to_pylist(), vary.to_pylist(), strict=True):
            if pair not in known:
                free = [i for i in range(BITS) if pair[1] >> i & 1]
                parts = [sum(1 << i for i in free[k::radius + 1]) for k in range(radius + 1)]
                known[pair] = [_signed(pair[0] & (2 ** BITS - 1) | p) for p in parts]
            out.append(known[pair])
        return pa.array(out, pa.list_(pa.int64()))

    return finer_masks


def spanning_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints: every value is linked to the
    one from which a breadth-first search reached it, so at most n - 1 links come out."""
    rest, links = values, []
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            found = np.full(len(rest), -1)
            for lo in range(0, len(front), 256):
                near = np.bitwise_count(front[lo:lo + 256, None] ^ rest[None, :]) <= radius
                hit = near.any(axis=0) & (found < 0)
                found[hit] = lo + near[:, hit].argmax(axis=0)
            hit = found >= 0
            links += zip(front[found[hit]].tolist(), rest[hit].tolist(), strict=True)
            front, rest = rest[hit], rest[~hit]
    return links


def _bucket_links(radius: int):
    def run(batches):
        last, kept = None, np.zeros(0, np.uint64)

        def out(pairs):
            a = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])],
                                              names=["a", "b"])

        for batch in batches:
            mask, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(fp):
                continue
            fp = fp.view(np.uint64)
            edge = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            cuts = [0, *edge.tolist(), len(fp)]
            links = []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                here = (mask[lo], key[lo])
                if here != last:
                    links += spanning_links(kept, radius)
                    last, kept = here, fp[lo:hi]
                else:
                    kept = np.concatenate([kept, fp[lo:hi]])
            if links:
                yield out(links)
        if links := spanning_links(kept, radius):
            yield out(links)

    return run


def fingerprint_links(prints: DataFrame, radius: int, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links ``(a, b)`` that join exactly the fingerprints (column ``fp``, distinct) which chains
    of pairs within ``radius`` bits join.

    Each fingerprint goes to one bucket per mask.  Buckets of up to ``max_bucket`` members are
    compared in one streamed pass that emits a spanning forest; the members of larger ones move
    on to finer masks over the bits in which they vary, where each pair within the radius still
    meets.  Those bits get fewer each time, and v of them leave at most 2^v members.
    """
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in covering_masks(radius)])
    level = prints.select("fp", F.explode(masks).alias("mask"))
    links = []
    while True:
        level = checkpoint(level.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))
        sizes = checkpoint(level.groupBy("mask", "key").agg(
            F.count(F.lit(1)).alias("n"), F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("vary"))
                           .where(F.col("n") > 1))
        small = level.join(sizes.where(F.col("n") <= max_bucket), ["mask", "key"], "left_semi")
        # dealt by a hash of their own: a deal by the join's keys would be left out as the join's
        # own, whose buckets AQE may read in parts (as a broadcast join, or to split skew)
        links.append(small.select("mask", "key", "fp").repartition(F.xxhash64("mask", "key"))
                     .sortWithinPartitions("mask", "key")
                     .mapInArrow(_bucket_links(radius), "a long, b long"))
        large = sizes.where(F.col("n") > max_bucket)
        if large.isEmpty():
            break
        finer = large.select("mask", "key", F.explode(
            _divide_udf(radius)(F.col("mask"), F.col("vary"))).alias("finer"))
        level = level.join(finer, ["mask", "key"]).select("fp", F.col("finer").alias("mask")).distinct()
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out.distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                   text_col: str = "text", max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``(id_col, fingerprint, component_id, text_hash, root)`` per row of ``docs``.

    ``fingerprint``: 16 lower-case hex digits of the 64-bit SimHash over ``shingle``-word
    shingles.  Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the
    smallest id reachable over links, the row's own included.

    Equal fingerprints are one node, so a group of copies costs one row after a partial
    aggregation.  Candidates come from the covering masks, each compared in full, so no pair
    within the radius is missed.  ``text_hash`` tells rows with a repeated id apart, and
    ``root``, a fingerprint of the component, components that share their smallest id.

    Texts without words (null included) have fingerprint zero and link like any other.  Null ids
    never become a component's id unless it holds nothing else (then it is null).  An empty table
    gives an empty result.
    """
    fp = _fingerprint_udf(shingle)(F.col(text_col))
    rows = checkpoint(docs.select(F.col(id_col).alias("_id"), fp.alias("fp"),
                                  F.xxhash64(F.col(text_col)).alias("text_hash")))
    nodes = rows.groupBy("fp").agg(F.min("_id").alias("first"))
    stars = connected_components(fingerprint_links(nodes.select("fp"), radius, max_bucket))
    rooted = (nodes.join(stars.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    rooted = checkpoint(rooted)
    first = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(first, "root").select("fp", "component_id", "root")
    return (rows.join(named, "fp")
            .select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0"))
                    .alias("fingerprint"), "component_id", "text_hash", "root"))


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one with the smallest id
    (null ids last, then the smallest text hash); rows equal in id and text count as one."""
    groups = simhash_groups(docs, shingle, radius, id_col, text_col)
    best = (groups.groupBy("root")
            .agg(F.min(F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"),
                                F.col("text_hash").alias("th"))).alias("_best"))
            .select(F.col("_best.id").alias("_id"), F.col("_best.th").alias("_th")))
    tagged = docs.withColumn("_hash", F.xxhash64(F.col(text_col)))
    return (tagged.join(best, tagged[id_col].eqNullSafe(best["_id"])
                        & (tagged["_hash"] == best["_th"]), "left_semi")
            .dropDuplicates([id_col, "_hash"]).drop("_hash"))
