"""Operator 13: a Merkle manifest of a dataset, with a proof for every row.

Every row is a leaf (the digest of its fields).  The leaves of a language, in
order of doc_id, are the bottom of a tree of fan-out 8; the languages' roots
are the leaves of one more such tree.

*Rollup.*  A node's place in its tree is written in digits of base 8.  Nodes
are shuffled once by (tree, place / 512); inside such a block the three lowest
digits are grouped away one after the other, each group becoming a struct that
holds its children's structs.  The 512 leaves of a block end up in one nested
row, and the block's root is a leaf of the next pass, over 512 times fewer
rows.  *Proofs.*  From the top down, the path to the root of every block meets
the block's nested row in one grouping; a transform puts every child's
siblings beside it, an explode per digit hands the path on, and no join is
needed.  No task ever holds more than one block of 512 nodes at a time, also
if one language holds all rows.

Digests are lowercase hexadecimal SHA-256; a parent hashes its children's
digests as text.  The last group of a level may have fewer than 8 nodes, even
one, and is hashed all the same; a tree of one leaf is that leaf.

Results for odd input: null fields count as ``-``; rows without a doc_id come
first, rows of equal doc_id are ordered by their digests, equal rows are
leaves of their own; a null language is a language of its own, the first;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import stage
from lapse.operators.ranking import running_totals

FAN_BITS = 3
DIGITS = 3  # digits grouped away in one block
_MASK = (1 << FAN_BITS) - 1
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def _leaf(text: Column) -> Column:
    return F.sha2(F.concat(*[_field(F.col(f)) for f in FIELDS[:-1]], _field(text)), 256)


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """``doc_id, lang, digest`` of every row, and as ``changed`` the digest of
    the row with its text's A-Z lower-cased where ``tampered`` holds."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        _leaf(text).alias("digest"),
        F.when(tampered, _leaf(F.translate(text, _UPPER, _UPPER.lower()))).alias("changed"))


def _placed(nodes: DataFrame, tree: list[str], order: list[str]) -> DataFrame:
    """Add ``place``, the node's number in its tree, and ``levels``, how many
    levels lie above the nodes of the tree."""
    ranked = running_totals(nodes.withColumn("one", F.lit(1).cast("long")), tree, [F.col(c) for c in order],
                            ["one"], totals="all_")
    levels = sum(((F.col("all_one") > F.lit(1 << (FAN_BITS * k))).cast("int") for k in range(1, 20)),
                 (F.col("all_one") > 1).cast("int"))
    return ranked.withColumns({"place": F.col("cum_one") - 1, "levels": levels}).drop("one", "cum_one", "all_one")


def _parent(kids: Column, hashed: Column) -> Column:
    """Digest of the parent of ``kids``; above the root nothing is hashed."""
    joined = F.array_join(F.transform(kids, lambda k: k["digest"]), "")
    return F.when(hashed, F.sha2(joined, 256)).otherwise(kids[0]["digest"])


def _roll(nodes: DataFrame, tree: list[str], payload: list[str], name: str) -> DataFrame:
    """One pass: nested block rows ``tree..., place, levels, digest, kids``.
    ``levels`` counts the levels above the block's children."""
    block = nodes.withColumn("block", F.shiftright("place", FAN_BITS * DIGITS))
    block = block.withColumns({f"d{i}": F.shiftright("place", FAN_BITS * i).bitwiseAND(F.lit(_MASK)).cast("int")
                               for i in range(DIGITS)}).repartition(*tree, "block")
    fields = ["digest", *payload]
    for i in range(DIGITS):
        by = [*tree, "block", "levels", *[f"d{j}" for j in range(DIGITS - 1, i, -1)]]
        block = block.groupBy(*by).agg(F.sort_array(F.collect_list(
            F.struct(F.col(f"d{i}").alias("digit"), *fields))).alias("kids"))
        block = block.withColumn("digest", _parent(F.col("kids"), F.col("levels") > i))
        fields = ["digest", "kids"]
    return stage(block.withColumnRenamed("block", "place"), name)


def _tree(nodes: DataFrame, tree: list[str], payload: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """All passes over placed nodes, lowest first, and the trees' roots."""
    top = nodes.agg(F.max("levels")).first()[0] or 0
    passes = [_roll(nodes, tree, payload, f"{name}0")]
    while top > DIGITS * len(passes):
        up = passes[-1].select(*tree, "place", F.greatest(F.col("levels") - DIGITS, F.lit(0)).alias("levels"), "digest")
        passes.append(_roll(up, tree, [], f"{name}{len(passes)}"))
    return passes, passes[-1].select(*tree, "digest")


def _siblings(kids: Column) -> Column:
    """Every kid with the digests left and right of it, concatenated."""
    def beside(k: Column, keep: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(F.filter(kids, keep), lambda x: x["digest"]), "")

    return F.transform(kids, lambda k: F.struct(
        k.alias("node"), beside(k, lambda x: x["digit"] < k["digit"]).alias("left"),
        beside(k, lambda x: x["digit"] > k["digit"]).alias("right")))


def _unroll(blocks: DataFrame, tree: list[str], known: list[str]) -> DataFrame:
    """The nodes of nested block rows that carry their own ``path``: each node
    with its place and its path, nearest siblings first."""
    at = F.col("place")
    out = blocks
    for i in reversed(range(DIGITS)):
        out = out.select(*tree, "levels", *known, at.alias("place"), "path", F.explode(_siblings(F.col("kids"))).alias("kid"))
        step = F.array(F.struct(F.col("kid.left").alias("left"), F.col("kid.right").alias("right")))
        path = F.when(F.col("levels") > i, F.concat(step, F.col("path"))).otherwise(F.col("path"))
        at = F.col("place") * (1 << FAN_BITS) + F.col("kid.node.digit")
        out = out.select(*tree, "levels", *known, "kid.node", at.alias("place"), path.alias("path"))
        if i:
            out = out.select(*tree, "levels", *known, "place", "path", "node.kids")
            at = F.col("place")
    return out.select(*tree, "place", *known, "path", "node.*").drop("digit")


def _paths(passes: list[DataFrame], tree: list[str], tops: DataFrame, known: list[str]) -> DataFrame:
    """Bottom nodes of the trees whose tops (``tree..., path, known...``) are
    given, each with its path and what is known of its tree."""
    above = tops.withColumn("place", F.lit(0).cast("long"))
    for blocks in reversed(passes):
        # a block's path and its nested row meet by grouping: one of each a group
        wide = blocks.select(*tree, "place", "levels", "kids").unionByName(
            above.select(*tree, "place", "path", *known), allowMissingColumns=True)
        met = wide.groupBy(*tree, "place").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("levels", "kids", "path", *known)])
        above = _unroll(met, tree, known)
    return above


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``
    for every row, and ``path``, its proof: the siblings' digests (left and
    right of the node) of every level up to the root.

    The root is folded again from the path and the leaf as ``tampered`` rows
    would have it (text lower-cased; nobody tampers by default)."""
    rows = stage(leaves(docs, tampered if tampered is not None else F.lit(False)), "leaves")
    low, subroots = _tree(_placed(rows, ["lang"], ["doc_id", "digest", "changed"]), ["lang"],
                          ["doc_id", "changed"], "blocks")
    high, roots = _tree(_placed(subroots, [], ["lang"]), [], ["lang"], "languages")
    empty = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    tops = roots.select(F.col("digest").alias("root"), empty.alias("path"))
    subs = _paths(high, [], tops, ["root"]).select("lang", "path", "root", F.col("digest").alias("subroot"))
    found = _paths(low, ["lang"], subs, ["root", "subroot"])
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    folded = F.aggregate("path", F.coalesce("changed", "digest"),
                         lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"),
                        folded.alias("folded_root"), "path").withColumn("verified", F.col("folded_root") == F.col("root"))


def every_third() -> Column:
    """Rows whose decimal doc_id has an unsigned CRC-32 that 3 divides."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
