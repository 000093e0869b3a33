"""SimHash near-duplicates by an embedding of fingerprints in per-segment bit counts.

A fingerprint's 64 bits are read as 32 segments of two bits, and each segment as its number of set
bits. Manhattan distance between two such vectors of counts is at most the number of differing bits,
so fingerprints within `max_bits` are within `max_bits` of each other in this space, too. The 32
axes lie in eight groups. A pair within range differs in at most four groups, so it agrees on all
axes of at least four: for each choice of four groups there is a grid whose cells are the counts on
those axes, and every pair within range shares a cell of at least one grid. Pairs of a cell beyond
`max_bits` of Manhattan distance on all axes are ruled out by that; the rest is verified on the bits themselves.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .components import connected_components
from .shared import shuffle_partitions

SEED = 42
GROUPS = 8
# Fingerprints of a cell that one task compares. Beyond that the cell's fingerprints are linked
# through midpoints, which is exact, too.
CELL = 4096
# Shingle hashes whose bits are counted at once.
BLOCK = 1 << 16


def simhash(words: list[bytes], shingle: int) -> int:
    """The fingerprint as a signed number: a bit is 1 if set in over half the shingle hashes."""
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        spans = [(0, len(line))]
    else:
        starts = np.concatenate(([0], ends[: -shingle] + 1))
        spans = list(zip(starts.tolist(), ends[shingle - 1 :].tolist()))
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(spans), BLOCK):
        block = spans[at : at + BLOCK]
        hashes = np.fromiter((hashed(line[a:b], SEED) for a, b in block), np.uint64, len(block))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(spans), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """64-bit SimHash of a text's word shingles, as a long; null and texts without a word give 0.

    A-Z are lower-cased; words are runs of anything but ASCII white space; a text of fewer than
    `shingle` words is one shingle. Whole texts count, repeated shingles as often as they come.
    """

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.binary())
        return pa.array([simhash((x.as_py() or b"").lower().split(), shingle) for x in raw], pa.int64())

    return of(text)


def fingerprint_hex(value: str) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _masks(groups: int, kept: int) -> list[int]:
    """For each grid, the bits of the axes it keeps; segments go to groups in turn."""
    group_bits = [sum(3 << (2 * s) for s in range(32) if s % groups == g) for g in range(groups)]
    masks = [sum(group_bits[g] for g in choice) for choice in combinations(range(groups), kept)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


# The low bit of each segment.
LOW = 0x5555555555555555


def _counts_code() -> Column:
    """The vector of counts, packed: each two-bit field holds as many set bits, from its low one on, as the segment."""
    x, shifted = F.col("fp"), F.shiftrightunsigned("fp", 1)
    two = F.shiftleft(x.bitwiseAND(shifted).bitwiseAND(LOW), 1)
    return x.bitwiseOR(shifted).bitwiseAND(LOW).bitwiseOR(two)


def counts_codes(fps: np.ndarray) -> np.ndarray:
    """The same for unsigned fingerprints. Counts in this form differ in as many bits as their Manhattan distance."""
    one, low = np.uint64(1), np.uint64(LOW)
    shifted = fps >> one
    return (fps | shifted) & low | ((fps & shifted & low) << one)


def _spanning_links(max_bits: int):
    """For cells of several fingerprints: enough verified links to connect what is linked in them."""

    def links(batches):
        for batch in batches:
            a, b = [], []
            for cell in batch.column("members"):
                fps = np.unique(np.array(cell.values, dtype=np.int64)).view(np.uint64)
                codes = counts_codes(fps)
                # Grow one tree at a time: every fingerprint is compared once with those not yet reached.
                free = np.ones(len(fps), bool)
                for root in range(len(fps)):
                    if not free[root]:
                        continue
                    free[root] = False
                    reached = [root]
                    while reached:
                        node = reached.pop()
                        rest = np.flatnonzero(free)
                        near = rest[np.bitwise_count(codes[rest] ^ codes[node]) <= max_bits]
                        near = near[np.bitwise_count(fps[near] ^ fps[node]) <= max_bits]
                        free[near] = False
                        reached.extend(near.tolist())
                        a.extend([int(fps[node].view(np.int64))] * len(near))
                        b.extend(fps[near].view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return links


def _midpoint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints of overfull cells without comparing them in pairs.

    Two fingerprints within `max_bits` have a point within half of that, rounded up, of both, so
    each sends itself to all points that near, and those that meet hang below the least of them. Only
    links within `max_bits` are kept; for odd limits two that meet may be one bit too far, so then
    the longer half is taken on one side only.
    """
    far, near = (max_bits + 1) // 2, max_bits // 2

    def ball(radius: int) -> list[int]:
        points = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(64), r)]
        return [p - (1 << 64) if p >> 63 else p for p in points]

    def sent(radius: int) -> DataFrame:
        masks = F.array(*[F.lit(m) for m in ball(radius)])
        return fps.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))

    least = sent(near).groupBy("at").agg(F.min("fp").alias("least"))
    met = sent(far).join(least, "at").filter("fp <> least")
    return met.select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct()


def links(fps: DataFrame, max_bits: int = 4, groups: int = GROUPS, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within `max_bits` bits of each other.

    Every link given is within `max_bits`, and two fingerprints within that are connected by links;
    not every pair within range is listed. `fps` holds distinct values in a column `fp`.
    """
    if not max_bits < groups:
        raise ValueError("there must be more groups than bits that may differ")
    masks = _masks(groups, groups - max_bits)
    # A row becomes one for each grid: dealt out first, so that many tasks share that.
    coded = fps.repartition(shuffle_partitions(fps.sparkSession), "fp").withColumn("code", _counts_code())
    grid = coded.select("fp", F.posexplode(F.array(*[F.col("code").bitwiseAND(m) for m in masks])).alias("grid", "cell"))
    sizes = grid.groupBy("grid", "cell").agg(F.count("*").alias("n"))
    crowded = materialise(sizes.filter(F.col("n") > cell).select("grid", "cell"), "crowded-cells")
    members = grid.join(crowded, ["grid", "cell"], "left_anti").groupBy("grid", "cell").agg(F.collect_list("fp").alias("members"))
    trees = members.filter("size(members) > 1").select("members").mapInArrow(_spanning_links(max_bits), "a long, b long")
    far = _midpoint_links(grid.join(crowded, ["grid", "cell"]).select("fp").distinct(), max_bits)
    return trees.union(far).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """One row per document: doc_id, fp (long), component_id (least doc_id it is linked to).

    Documents are linked if their fingerprints differ in at most `max_bits` bits. Copies of one
    fingerprint are one node, so a group of copies costs as much as a single document. A document
    without an id takes part, but cannot name its component; repeated rows give repeated rows. An
    empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("fp"))
    rows = materialise(rows, "fingerprints")
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = connected_components(links(classes.select("fp"), max_bits))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialise(rooted.join(least, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
