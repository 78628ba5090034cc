"""Operator 8: license scan by ordered signature rules, in column expressions.

A text is normalised to lower-case words parted by single spaces.  Base
phrases are counted where their words stand consecutively.  The rules of
``license_rules`` (hundreds of expressions) are gated twice: a text without
any gate word is done at once, and a rule's expression is tried only where
the rule's keyword occurs.  Detections are intervals of the normalised text;
one that lies inside another of the same or a higher priority is dropped.

Every text is scanned in its own row: no shuffle, no Python.

Results for odd input: a null or wordless text has no words, no labels and
score 0; null doc_ids and repeated rows are scanned like any other; an empty
table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import texts
from lapse.llm.license_rules import GATE, rules
from lapse.llm.native import before, let

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
WEIGHTS = {1: 0.5, 2: 0.8, 3: 0.95}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _spaces(c: Column) -> Column:
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))


def _intervals(norm: Column, rule: Column) -> Column:
    """All matches of one rule as (first, last, priority, label) structs."""
    pattern = rule["pattern"]
    none = F.lit(None).cast("array<struct<first:int,last:int,priority:int,label:string>>")

    def found(parts: Column) -> Column:
        hits = F.regexp_extract_all(norm, pattern, F.lit(0))
        both = F.zip_with(F.slice(parts, F.lit(1), F.size(parts) - 1), hits,
                          lambda p, h: F.struct(F.length(p).alias("gap"), F.length(h).alias("own")))
        return let(both, lambda b: F.zip_with(
            b, before(F.transform(b, lambda x: x["gap"] + x["own"]), lambda x, y: x + y, F.lit(0)),
            lambda x, at: F.struct((at + x["gap"]).alias("first"), (at + x["gap"] + x["own"]).alias("last"),
                                   rule["priority"].alias("priority"), rule["label"].alias("label"))))

    return let(F.split(norm, pattern), lambda parts: F.when(F.size(parts) > 1, found(parts)).otherwise(none))


def _unsuppressed(detections: Column) -> Column:
    """Detections that lie inside no other of the same or a higher priority.

    In the order (first, longest, highest priority) a detection lies inside an
    earlier one exactly if the farthest end so far, over the earlier ones of at
    least its priority, reaches its end.
    """
    order = F.array_sort(F.transform(detections, lambda d: F.struct(
        d["first"].alias("first"), (-d["last"]).alias("back"), (-d["priority"]).alias("low"), d["label"].alias("label"))))

    def far(ds: Column, priority: int) -> Column:
        ends = F.transform(ds, lambda d: F.when(d["low"] <= -priority, -d["back"]).otherwise(F.lit(-1)))
        return before(ends, lambda x, y: F.greatest(x, y), F.lit(-1))

    return let(order, lambda ds: let(
        F.struct(*[far(ds, p).alias(f"p{p}") for p in WEIGHTS]),
        lambda m: F.filter(ds, lambda d, i: F.coalesce(
            F.when(d["low"] == -3, F.get(m["p3"], i)).when(d["low"] == -2, F.get(m["p2"], i))
            .otherwise(F.get(m["p1"], i)), F.lit(-1)) < -d["back"])))


def scan(docs: DataFrame, base: dict[str, str] = BASE) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, detections``; detections are spans of the normalised text (character
    offsets) that suppression left."""
    own = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.select("doc_id", F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate("text", _UPPER, _UPPER.lower()), SEPARATORS, " ")),
                                        F.lit(" ")).alias("norm"))
    norm = F.col("norm")
    own = own.withColumn("n_words", F.when(norm == "  ", 0).otherwise(_spaces(norm) - 1).cast("long"))
    marks = {}
    for i, phrase in enumerate(base):
        size = len(phrase.split(" "))
        own = own.withColumn(f"parts{i}", F.when(norm.contains(f" {phrase} "), F.split(norm, f" {phrase}(?= )")))
        parts = F.col(f"parts{i}")
        marks[phrase] = (F.size(parts) - 1, _spaces(F.get(parts, F.lit(0))),
                         F.col("n_words") - _spaces(F.element_at(parts, -1)) + 1 - size)
    places = [F.when(F.col(f"parts{i}").isNotNull(), m[0]).otherwise(0) for i, m in enumerate(marks.values())]
    own = own.withColumns({
        "n_base": sum(places[1:], places[0]).cast("long"),
        "first_word": F.least(*[m[1] for m in marks.values()]).cast("long"),
        "last_word": F.greatest(*[m[2] for m in marks.values()]).cast("long"),
        "base": F.array_compact(F.array(*[F.when(F.col(f"parts{i}").isNotNull(), F.lit(label))
                                          for i, label in enumerate(base.values())]))})
    table = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(priority).alias("priority"),
                               F.lit(keyword).alias("keyword"), F.lit(pattern).alias("pattern"))
                      for label, priority, keyword, pattern in rules()])
    gate = norm.contains(GATE[0])
    for word in GATE[1:]:
        gate = gate | norm.contains(word)
    tried = F.filter(table, lambda r: norm.contains(r["keyword"]))
    found = F.flatten(F.array_compact(F.transform(tried, lambda r: _intervals(norm, r))))
    own = own.withColumn("detections", F.when(gate, F.transform(_unsuppressed(found), lambda d: F.struct(
        d["first"].alias("start"), (-d["back"]).alias("end"), (-d["low"]).alias("priority"), d["label"].alias("label")))))
    named = F.coalesce(F.transform("detections", lambda d: d["label"]), F.array().cast("array<string>"))
    weight = F.aggregate(F.coalesce("detections", F.array().cast("array<struct<start:int,end:int,priority:int,label:string>>")),
                         F.lit(1.0), lambda acc, d: acc * (F.lit(1.0) - sum(
                             [F.when(d["priority"] == p, w).otherwise(0.0) for p, w in WEIGHTS.items()], F.lit(0.0))))
    return own.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", named))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(1.0 - weight).alias("score"), "detections")
