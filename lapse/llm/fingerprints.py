"""Operator 5: document fingerprints by Order MinHash, in column expressions.

A text's symbols are its words (runs of characters other than white space).
Its k-mers (k = ``K`` words) are numbered by occurrence, so that a repeated
k-mer counts as often as it stands there.  For each of ``FUNCTIONS`` random
orders two numbered k-mers are selected, kept in the order they have in the
text, and hashed as a pair; the fingerprint is the list of those hashes.  Two
texts agree in an entry only if they share both k-mers and their order, which
makes the share of equal entries sensitive to edit distance.

An order ranks k-mers by a hash of its own (xxhash64 of the k-mer and the
order's number).  The two selected k-mers are minimal in it read from its one
and from its other end.  The first and the last place of a random order are
distributed exactly like its first two, and as plain minimum and maximum they
are fixed-size aggregates: the k-mers of a text stream through them without
ever being sorted by an order or gathered.  The low ``POSITION_BITS`` bits of
a packed value carry the position.

The "next document" of the contract needs a global order.  Boundaries of
doc_id ranges are fixed once as quantiles; ``lead`` runs inside a range, and
the last row of a range takes the first row of the next one.

Results for odd input: a null text counts as empty; an empty or blank text
has the fingerprint of no k-mers (zeros); a text of fewer than k words has
its whole sequence as its one k-mer; rows without a doc_id come last in the
order; repeated rows stand next to each other and each gets a result row; a
table of one row is its own next document; an empty table gives an empty
result; positions beyond 2^27 words count as 2^27 - 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import stage, texts
from lapse.llm.native import before, let

K = 3
FUNCTIONS = 32
POSITION_BITS = 27
#: doc_id ranges: at least, at most, and the bytes of text of one in between.
RANGES = 512
MOST_RANGES = 8192
RANGE_BYTES = 1 << 29


def _kmers(text: Column, k: int, which: int) -> Column:
    """Occurrence-numbered k-mers of a text as packed longs: hash bits, a bit
    that tells the edited text (``which``) from its document, position."""
    mask = (1 << POSITION_BITS) - 1
    space = r"[\x09-\x0D\x20]+"

    def hashes(words: Column) -> Column:
        last = F.greatest(F.size(words) - k, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.shiftleft(
            F.xxhash64(*[F.get(words, i + j) for j in range(k)]), POSITION_BITS).bitwiseOR(
            F.least(i, F.lit(mask)).cast("long")))

    def numbered(s: Column) -> Column:
        # s is sorted by (hash, position): equal k-mers stand together
        kmer = F.transform(s, lambda x: F.shiftright(x, POSITION_BITS))
        fresh = let(kmer, lambda h: F.transform(h, lambda x, i: F.when(
            (i > 0) & (x == F.get(h, i - 1)), F.lit(-1)).otherwise(i)))
        first = let(fresh, lambda f: F.zip_with(f, before(f, lambda x, y: F.greatest(x, y), F.lit(-1)),
                                                lambda x, y: F.greatest(x, y)))
        return let(first, lambda f: F.transform(s, lambda x, i: F.shiftleft(
            F.xxhash64(F.shiftright(x, POSITION_BITS), i - F.get(f, i)), POSITION_BITS + 1).bitwiseOR(
            F.lit(which << POSITION_BITS).cast("long")).bitwiseOR(x.bitwiseAND(F.lit(mask).cast("long")))))

    def of(words: Column) -> Column:
        return let(F.sort_array(hashes(words)), lambda s: F.when(
            F.size(F.array_distinct(F.transform(s, lambda x: F.shiftright(x, POSITION_BITS)))) == F.size(s),
            F.transform(s, lambda x: F.shiftleft(
                F.xxhash64(F.shiftright(x, POSITION_BITS), F.lit(0)), POSITION_BITS + 1).bitwiseOR(
                F.lit(which << POSITION_BITS).cast("long")).bitwiseOR(x.bitwiseAND(F.lit(mask).cast("long")))))
            .otherwise(numbered(s)))

    trimmed = F.btrim(text, F.lit("\t\n\x0b\x0c\r "))
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(let(F.split(trimmed, space), of))


def _order(docs: DataFrame, ranges: int | None) -> DataFrame:
    """The rows with ``part``: numbers of doc_id ranges, ascending."""
    d = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if ranges is None:
        size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = min(max(RANGES, size // RANGE_BYTES), MOST_RANGES)
    cuts = d.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 40_000)).first()[0] or []
    cuts = sorted(set(cuts))
    part = F.lit(0)
    if cuts:
        array = F.array(*[F.lit(c).cast("long") for c in cuts])
        # the number of cuts that are not above the doc_id, by halving
        steps = F.array(*[F.lit(1 << j) for j in reversed(range(len(cuts).bit_length()))])
        part = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
            F.get(array, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at))
    return d.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(part))


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``part, doc_id, text, next_id, next_text``: the next row by descending
    doc_id (equal ids by text digest); after the last row the first.  The rows
    lie hash-partitioned by ``part``; texts are shuffled once."""
    d = _order(docs, ranges)
    heads = d.groupBy("part").agg(F.max("doc_id").alias("head_id"))
    parts = sorted(r["part"] for r in heads.collect())  # at most ranges + 1
    # the first row of every range: at most ranges + 1 ids are sent around
    first = d.join(F.broadcast(heads.select(F.col("part").alias("p"), "head_id")),
                   (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("head_id")), "left_semi")
    first = first.groupBy("part").agg(F.min_by(F.struct("doc_id", "text"), F.md5("text")).alias("head"))
    ahead = {parts[i - 1]: p for i, p in enumerate(parts)}  # whose last row a range's first row follows
    target = F.create_map(*[F.lit(x) for q_p in ahead.items() for x in q_p]) if parts else F.lit(None).cast("map<int,int>")
    first = first.select(F.element_at(target, F.col("part")).alias("p"), "head")
    w = Window.partitionBy("part").orderBy(F.col("doc_id").desc_nulls_last(), F.md5("text"))
    d = d.withColumn("own", F.lead(F.struct("doc_id", "text")).over(w))
    d = d.join(first.hint("merge"), F.col("part") == F.col("p"), "left")
    follower = F.coalesce("own", "head")
    return d.select("part", "doc_id", "text", follower["doc_id"].alias("next_id"), follower["text"].alias("next_text"))


def fingerprints(docs: DataFrame, k: int = K, functions: int = FUNCTIONS, ranges: int | None = None) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` for every row of ``docs``; the number of doc_id
    ``ranges`` follows the size of the table."""
    rows = with_next(docs, ranges)
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    cut = F.expr("cast(n_chars div 3 as int)")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut),
                                              F.substring("next_text", F.lit(1), cut)))
    rows = rows.select("part", "doc_id", "next_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       F.sha2("text", 256).alias("own_sha"), F.sha2("next_text", 256).alias("next_sha"),
                       F.concat(_kmers(F.col("text"), k, 0), _kmers(F.col("edited"), k, 1)).alias("kmers"))
    # with "part" among the keys the aggregations keep the rows where they are
    base = ["part", "doc_id", "next_id", "n_chars", "edited_sha256", "own_sha", "next_sha"]
    each = rows.select(*base, F.explode_outer("kmers").alias("x"))
    side = F.shiftright(F.col("x"), POSITION_BITS).bitwiseAND(F.lit(1).cast("long"))
    each = each.withColumn("side", F.coalesce(side, F.lit(-1).cast("long")))
    low = F.lit((1 << POSITION_BITS) - 1).cast("long")
    mask = F.lit(-1 << (POSITION_BITS + 1)).cast("long")
    each = each.select(*base, "side", F.shiftright("x", POSITION_BITS + 1).alias("kmer"), F.col("x").bitwiseAND(low).alias("at"))
    each = each.select(*base, "side", *[F.when(F.col("side") >= 0, F.xxhash64("kmer", F.lit(j)).bitwiseAND(mask).bitwiseOR(
        F.col("at"))).alias(f"v{j}") for j in range(functions)])
    ends = each.groupBy(*base, "side").agg(*[f(f"v{j}").alias(f"{name}{j}") for j in range(functions)
                                             for name, f in (("a", F.min), ("z", F.max))])
    entries = []
    for j in range(functions):
        a, z = F.col(f"a{j}"), F.col(f"z{j}")
        one, two = F.shiftright(a, POSITION_BITS + 1), F.shiftright(z, POSITION_BITS + 1)
        early = a.bitwiseAND(low) <= z.bitwiseAND(low)
        entries.append(F.substring(F.hex(F.when(early, F.xxhash64(one, two)).otherwise(F.xxhash64(two, one))), -8, 8))
    sign = ends.select(*base, "side", F.lpad(F.concat(*entries), 8 * functions, "0").alias("print"))
    none = F.lit("0" * 8 * functions)
    both = sign.groupBy(*base).agg(
        F.coalesce(F.max(F.when(F.col("side") == 0, F.unhex("print"))), F.unhex(none)).alias("own"),
        F.coalesce(F.max(F.when(F.col("side") == 1, F.unhex("print"))), F.unhex(none)).alias("edited"))
    return _compare(stage(both.drop("part", "next_id"), "prints"), functions)


def _compare(both: DataFrame, functions: int) -> DataFrame:
    """The result rows: each row's fingerprints beside the next document's,
    which has the fingerprint of its text."""
    by_text = both.groupBy("own_sha").agg(F.max("own").alias("next_print")).withColumnRenamed("own_sha", "sha")
    # read from its files this side gets an exchange of its own, so that the followers of a common text can be split
    by_text = stage(by_text, "by_text")
    both = both.join(by_text, F.col("next_sha") == F.col("sha"), "left")

    def near(x: Column, y: Column) -> Column:
        same = [F.when(F.substring(x, 4 * j + 1, 4) == F.substring(y, 4 * j + 1, 4), 1).otherwise(0)
                for j in range(functions)]
        return sum(same[1:], same[0]) / F.lit(float(functions))

    return both.select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("own")).alias("fingerprint"),
                       F.lower(F.hex("edited")).alias("edited_fingerprint"), near(F.col("own"), F.col("edited")).alias("near_edited"),
                       near(F.col("own"), F.col("next_print")).alias("near_next"))
