"""From band keys to verified links and components, without ever holding one
bucket in one task.

``link`` takes nodes with band keys and returns the exactly verified links
that connect them.  Round one compares every member of a bucket with the
bucket's smallest node only, so its work is linear in the number of keys.
Buckets whose members then still lie in different components go to round
two: their members are dealt into blocks, every pair of blocks is a work unit
of bounded size, and a unit compares its members of different components by
their full sets.  It gives only links that join components, at most one for
each member.  Nothing is capped: links known before only save comparisons
inside a component.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import discard, stage

#: Shingles of a block of a bucket's members.
BLOCK = 200_000


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the
    smallest node reachable.  Alternating large-star and small-star steps;
    every step is written to the shared folder."""
    e = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
              "edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = (both.join(low, both["u"] == low["x"]).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        small = large.join(low2, large["u"] == low2["x"])
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        before, e = e, stage(small, "edges")
        discard(before)
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == state:
            break
        state = now
    root = e.groupBy("u").agg(F.min("v").alias("root"))
    roots = stage(root.select(F.col("u").alias("node"), "root")
                  .unionByName(root.select(F.col("root").alias("node"), "root").distinct()), "roots")
    discard(e)
    return roots


def verified(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets, in ``sets(node, items)``, have
    ``share[1] * intersection >= share[0] * union``."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("xa"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("xb"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    common = F.size(F.array_intersect("xa", "xb"))
    both = both.select("a", "b", common.alias("i"), (F.size("xa") + F.size("xb")).alias("s"))
    return both.where(F.lit(share[1]) * F.col("i") >= F.lit(share[0]) * (F.col("s") - F.col("i"))).select("a", "b")


def _unit(share: tuple[int, int]):
    """Links of one work unit, the members of two blocks of a bucket: every
    pair of different components is compared by its full sets; a link is given
    only if it joins components that no earlier link of the unit has joined."""

    def links(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node").combine_chunks()
        one, two = key[1].as_py(), key[2].as_py()
        node, root, block = (rows.column(c).to_numpy() for c in ("node", "root", "block"))
        lists = rows.column("items").chunk(0) if rows.num_rows else pa.array([], pa.list_(pa.int64()))
        at = lists.offsets.to_numpy().astype(np.int64)
        items = lists.values.to_numpy()[at[0]:at[-1]]
        at = at - at[0]
        distinct, items = np.unique(items, return_inverse=True)
        size = np.diff(at)
        mark = np.zeros(len(distinct), np.int64)
        root = root.copy()
        out = []
        for i in np.flatnonzero(block == one):
            other = (block == two) & (root != root[i])
            if not other.any():
                continue
            own = items[at[i]:at[i + 1]]
            mark[own] = 1
            common = np.add.reduceat(mark[items], at[:-1])
            mark[own] = 0
            near = other & (share[1] * common >= share[0] * (size + size[i] - common))
            for j in np.flatnonzero(near):
                if root[j] != root[i]:
                    out.append((node[i], node[j]))
                    root[root == root[j]] = root[i]
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return links


def link(nodes: DataFrame, keys: Callable[[DataFrame], DataFrame], sets_of: Callable[[DataFrame], DataFrame],
         share: tuple[int, int]) -> DataFrame:
    """Verified links ``(a, b)`` that connect all ``nodes(node, n, ...)`` of a
    component of similar nodes which meet in some bucket.

    ``keys(nodes)`` gives ``(node, key)``, one row for each table;
    ``sets_of(nodes)`` gives ``(node, items array<long>)``.  Large inputs are
    joined by sorting at every size, so that the plan does not change with it.
    """
    k = keys(nodes)
    hubs = (k.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
            .select(F.col("key").alias("k2"), "hub"))
    shared = stage(k.join(hubs.hint("merge"), k["key"] == hubs["k2"]).select("key", "node", "hub"), "buckets")
    star = stage(shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(),
                 "pairs")
    some = star.select(F.col("a").alias("node")).unionByName(star.select(F.col("b").alias("node"))).distinct()
    sets = stage(sets_of(some), "sets")
    links = stage(verified(star, sets, share), "links")
    roots = components(links)
    own = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    own = stage(own.join(nodes.groupBy("node").agg(F.max("n").alias("n")), "node")
                .select("key", "node", "root", "n").distinct(), "members")
    left = own.groupBy("key").agg(
        F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("members"),
        F.sum("n").alias("weight"), F.sum(F.xxhash64("node") % (1 << 40)).alias("who"),
        F.sum(F.xxhash64(F.lit(1), "node") % (1 << 40)).alias("whom"))
    left = left.where("r1 < r2 and members > 2")
    # buckets of the same members need one look only
    left = left.groupBy("members", "weight", "who", "whom").agg(F.min("key").alias("key"))
    left = left.select(F.col("key").alias("k2"), F.ceil(F.col("weight") / BLOCK).cast("int").alias("parts"))
    rest = own.join(left, own["key"] == left["k2"]).select("key", "node", "root", "parts")
    rest = rest.join(sets.hint("merge"), "node")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("node", "key"), "parts").cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rest = rest.select("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
                       "node", "root", "items", "block")
    more = rest.groupBy("key", "one", "two").applyInArrow(_unit(share), "a long, b long")
    more = stage(more.distinct(), "more")
    discard(shared, star, sets, roots, own)
    return links.unionByName(more)
