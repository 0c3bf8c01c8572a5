"""Connected components of a distributed list of links: a distributed union-find.

Every partition first runs union-find on its own links, which leaves at most one link per node. Rounds
of star contraction then join the parts: each node's neighbours move to its smallest neighbour, first
the larger ones, then the smaller ones, until nothing changes. A node with very many links is never
gathered: its minimum is pre-aggregated, and the join that hands it out can be split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.llm.tables import written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != x:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["u", "v"])


def _larger_to_smallest(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _smaller_to_smallest(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node with a link to another; the component is its smallest node.

    Links may be repeated, in either direction, or lead from a node to itself; nulls link nothing. No
    links give no rows.
    """
    pairs = links.select(F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v"))
    pairs = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
    now = written(pairs.mapInArrow(_forest, "u bigint, v bigint"), "links")
    mark = _mark(now)
    while mark[0]:
        now = written(_smaller_to_smallest(_larger_to_smallest(now)), "links")
        mark, before = _mark(now), mark
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )


def merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component`` of ``parts`` after further ``links`` a, b: only the components these touch are worked on."""
    ends = links
    for c in ("a", "b"):
        of = parts.select(F.col("node").alias(c), F.col("component").alias(f"{c}_component"))
        ends = ends.join(of, c, "left").withColumn(f"{c}_component", F.coalesce(f"{c}_component", c))
    moved = written(components(ends.select(F.col("a_component").alias("a"), F.col("b_component").alias("b"))), "moved")
    if moved.isEmpty():
        return parts
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = parts.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return written(old.unionAll(moved.join(parts.select("node"), "node", "left_anti").select("node", "component")), "parts")


def group_members(stars: DataFrame) -> DataFrame:
    """``sig, doc`` of the members of groups with two links or more.

    ``stars`` has links ``sig, a, b`` from one member of a group to each other. A group with a single link has
    one pair only, the link itself: where all links are compared, nothing of that group is left.
    """
    several = stars.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1").select("sig")
    held = stars.join(several, "sig", "left_semi")
    return held.select("sig", F.explode(F.array("a", "b")).alias("doc")).distinct()


def mixed_groups(members: DataFrame, parts: DataFrame) -> DataFrame:
    """``sig, doc, component, top`` of the members ``sig, doc`` of groups that are not within one component.

    ``top`` is the group's largest component. Comparing each member outside it with the members of other
    components leaves no pair of the group open: all other pairs are within one component already. Groups
    only close, so the members found here are all that a later round needs.
    """
    named = members.join(parts.withColumnRenamed("node", "doc"), "doc", "left").select(
        "sig", "doc", F.coalesce("component", "doc").alias("component")
    )
    sizes = named.groupBy("sig", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("sig").agg(
        F.max(F.struct("n", "component")).getField("component").alias("top"), F.count("*").alias("components")
    )
    return named.join(largest.where("components > 1").drop("components"), "sig")


SKETCH_WORDS = 32  # 64-bit words of a parity sketch


def parity_sketch(hashes: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Bit i is the parity of the hashes that fall on i: bits that differ bound differing hashes from below."""
    bits = 64 * words
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def wide_sketch(hashes: np.ndarray) -> np.ndarray | None:
    """A parity sketch with a bit or two for each hash, of sets for which the fixed size is too small to tell."""
    words = SKETCH_WORDS
    while 64 * words < len(hashes):
        words *= 2
    return parity_sketch(hashes, words) if words > SKETCH_WORDS else None


def sketch_array(sketches: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(sketches) + 1, dtype=np.int32) * SKETCH_WORDS, sketches.ravel())


def folded(sketch: str) -> Column:
    """A parity sketch of a quarter of the size: bits that differ still bound differing hashes from below."""
    n = SKETCH_WORDS // 4
    parts = [[F.col(sketch)[i + j * n] for j in range(4)] for i in range(n)]
    return F.array(*[a.bitwiseXOR(b).bitwiseXOR(c).bitwiseXOR(d) for a, b, c, d in parts])


def may_link(n: str, sketch: str, other_n: str, other_sketch: str, threshold: tuple[int, int], words: int = SKETCH_WORDS) -> Column:
    """False only if so many bits of the sketches differ that the sets can't be similar enough."""
    up, down = threshold
    apart = sum((F.bit_count(F.col(sketch)[i].bitwiseXOR(F.col(other_sketch)[i])) for i in range(words)), F.lit(0))
    sizes = F.least(n, other_n) * down >= F.greatest(n, other_n) * up
    return sizes & (apart * (up + down) <= (F.col(n) + F.col(other_n)) * (down - up))


def _wide_apart(a: str, b: str) -> Column:
    """Bits that differ of two wide sketches; null if one is missing or their sizes are too far apart."""

    def halved(sketch: str) -> Column:
        half = (F.size(sketch) / 2).cast("int")
        return F.zip_with(F.slice(sketch, 1, half), F.slice(sketch, half + 1, half), lambda x, y: x.bitwiseXOR(y))

    x = F.when(F.size(a) > F.size(b), halved(a)).otherwise(F.col(a))
    y = F.when(F.size(b) > F.size(a), halved(b)).otherwise(F.col(b))
    counts = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def plausible(pairs: DataFrame, sketches: DataFrame, threshold: tuple[int, int], wide: DataFrame | None = None) -> DataFrame:
    """Those pairs ``a, b`` that may link by their sketches ``doc, n, sketch``, and by the wide ones ``doc, n, wide`` of large sets."""
    up, down = threshold
    of_a = sketches.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    of_b = sketches.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(of_a, "a").join(of_b, "b").where(may_link("n_a", "sketch_a", "n_b", "sketch_b", threshold))
    if wide is not None:
        both = both.select("a", "b", "n_a", "n_b")
        for c in ("a", "b"):
            of = wide.select(F.col("doc").alias(c), F.col("n").alias(f"n_{c}"), F.col("wide").alias(f"wide_{c}"))
            both = both.join(of, [c, f"n_{c}"], "left")
        close = _wide_apart("wide_a", "wide_b") * (up + down) <= (F.col("n_a") + F.col("n_b")) * (down - up)
        both = both.where(F.coalesce(close, F.lit(True)))
    return both.select("a", "b").distinct()


def open_pairs(
    mixed: DataFrame, sketches: DataFrame, tested: DataFrame, probes: int, threshold: tuple[int, int], wide: DataFrame | None = None
) -> DataFrame:
    """Pairs ``a, b`` of ``mixed_groups`` that lie in different components and were not compared yet.

    ``sketches`` has ``doc, n, sketch`` of every member. With ``probes``, only pairs with so many members
    of the largest component, drawn by a hash that differs from group to group: enough to join most sets
    that belong to it, at a cost that follows the members. Without, all of them.
    """
    slim = sketches.select("doc", "n", folded("sketch").alias("sketch"))
    sketched = written(mixed.join(slim, "doc"), "mixed")
    one = sketched.where("component <> top").select("sig", *[F.col(c).alias(f"x_{c}") for c in ("doc", "component", "n", "sketch")])
    other = sketched
    if probes:
        drawn = [F.min_by("doc", F.xxhash64("sig", "doc", F.lit(i))) for i in range(probes)]
        chosen = sketched.where("component = top").groupBy("sig").agg(F.array_distinct(F.array(*drawn)).alias("docs"))
        other = sketched.join(chosen.select("sig", F.explode("docs").alias("doc")), ["sig", "doc"])
    pairs = (
        one.join(other, "sig")
        .where("component <> x_component and (component = top or doc > x_doc)")
        .where(may_link("n", "sketch", "x_n", "x_sketch", threshold, SKETCH_WORDS // 4))
        .select(F.least("doc", "x_doc").alias("a"), F.greatest("doc", "x_doc").alias("b"))
        .distinct()
    )
    return plausible(pairs.join(tested, ["a", "b"], "left_anti"), sketches, threshold, wide)
