"""Licence scan with ordered signature rules (built-in functions only).

Each text becomes lower-case words between single spaces. One pass looks up
which rule keywords occur; only the rules whose keyword is there are matched.
Every match is an interval of words with the tier of its rule. A match that
lies inside another of the same or a higher tier is suppressed (of equal
intervals the earlier rule stays); what survives gives the labels and, by the
weight of its tier, the score. The rules are in ``license_rules``.

The work is one projection: no shuffle, each document by itself.
"""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martstar.llm.common import ascii_lower, let, text_of
from martstar.llm.license_rules import BASE, WEIGHTS, gate_words, rules

FIRST, LAST = "\x01", "\x02"  # marks; no word holds them
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# the two characters whose Unicode lower case brings in an ASCII letter
ODD_LOWER = ("K", "İ")


def words_line(text: str) -> Column:
    """The words of a text, one space between them and none at the ends."""
    t = text_of(text)
    odd = reduce(lambda a, b: a | b, [F.contains(t, F.lit(c)) for c in ODD_LOWER])
    low = F.when(odd, ascii_lower(t)).otherwise(F.lower(t))
    return F.trim(F.regexp_replace(low, NOT_WORD, " "))


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _gate() -> str:
    """One pattern for all keywords, alternatives grouped by first letter."""
    parts = [f"{k}(?:{'|'.join(w[1:] for w in ws)})" for k, ws in groupby(gate_words(), key=lambda w: w[0])]
    return f" ({'|'.join(parts)})(?= )"


def _rule_table() -> Column:
    """The rules as one constant array."""
    return F.expr("array(" + ", ".join(
        f"named_struct('i', {i}, 'tier', {tier}, 'label', '{label}', 'kw', '{kw}', 'rx', r'(?<= ){rx}(?= )')"
        for i, tier, label, kw, rx in rules()) + ")")


def _intervals(line: str) -> Column:
    """Array of (start, minus_end, tier, i, label) of all matches, sorted.

    A match begins and ends with whole words, so marks on its first and last word tell
    its places once the line is cut into words: no sum runs along the matches.
    """
    hits = F.filter(_rule_table(), lambda r: F.array_contains(F.col("_kw"), r["kw"]) & F.regexp_like(F.col(line), r["rx"]))

    def spans(r: Column) -> Column:
        marked = F.regexp_replace(F.col(line), r["rx"], F.lit(f"{FIRST}$0{LAST}"))

        def places(ws: Column) -> Column:
            def of(found) -> Column:
                return F.filter(F.transform(ws, lambda w, i: F.when(found(w), i)), lambda i: i.isNotNull())
            ends = F.arrays_zip(of(lambda w: F.startswith(w, F.lit(FIRST))).alias("a"), of(lambda w: F.endswith(w, F.lit(LAST))).alias("z"))
            return F.transform(ends, lambda x: F.struct(
                x["a"].alias("start"), (-(x["z"] + 1)).alias("minus_end"), r["tier"].alias("tier"), r["i"].alias("i"), r["label"].alias("label")))

        return let(F.split(F.trim(marked), " "), places)

    return F.array_sort(F.flatten(F.transform(hits, spans)))


def _surviving(intervals: Column) -> Column:
    """Drop intervals inside others of the same or a higher tier; one sweep."""
    tiers = range(len(WEIGHTS))
    start = F.struct(*[F.lit(-1).alias(f"c{t}") for t in tiers],
                     F.expr("cast(array() as array<string>)").alias("labels"),
                     F.lit(len(WEIGHTS)).alias("best"), F.lit(0).alias("n"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["minus_end"]
        cover = F.greatest(*[F.when(d["tier"] >= t, acc[f"c{t}"]).otherwise(F.lit(-1)) for t in tiers], F.lit(-1))
        stays = cover < end
        return F.struct(
            *[F.when(d["tier"] == t, F.greatest(acc[f"c{t}"], end)).otherwise(acc[f"c{t}"]).alias(f"c{t}")
              for t in tiers],
            F.when(stays, F.array_union(acc["labels"], F.array(d["label"]))).otherwise(acc["labels"]).alias("labels"),
            F.when(stays, F.least(acc["best"], d["tier"])).otherwise(acc["best"]).alias("best"),
            (acc["n"] + stays.cast("int")).alias("n"))

    return F.aggregate(intervals, start, step)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_found.

    One row per input row. Empty or null text: no words, empty labels, null
    places, score 0. ``n_found`` is the number of surviving rule matches.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), words_line(text_col).alias("_words"))
    d = d.select("doc_id", F.when(F.col("_words") == "", 0).otherwise(_spaces(F.col("_words")) + 1).alias("_n"),
                 F.concat(F.lit(" "), "_words", F.lit(" ")).alias("_line"))
    line, n = F.col("_line"), F.col("_n")
    count, first, last, names = [], [], [], []
    for phrase, label in BASE:
        there = F.contains(line, F.lit(f" {phrase} "))
        size = phrase.count(" ") + 1
        count.append(F.when(there, F.regexp_count(line, F.lit(f"(?<= ){phrase}(?= )"))).otherwise(0))
        first.append(F.when(there, _spaces(F.substring_index(line, f" {phrase} ", 1))))
        last.append(F.when(there, n - _spaces(F.substring_index(line, f" {phrase} ", -1)) - size))
        names.append(F.when(there, F.lit(label)))
    d = d.select(
        "doc_id", "_line", n.cast("long").alias("n_words"),
        sum(count[1:], count[0]).cast("long").alias("n_base"),
        F.least(*first).cast("long").alias("first_word"),
        F.greatest(*last).cast("long").alias("last_word"),
        F.array_compact(F.array(*names)).alias("_base"),
        F.array_distinct(F.regexp_extract_all(line, F.lit(_gate()), F.lit(1))).alias("_kw"))
    d = d.withColumn("_found", F.when(F.size("_kw") > 0, _surviving(_intervals("_line"))))
    best = F.coalesce(F.col("_found.best"), F.lit(len(WEIGHTS)))
    score = reduce(lambda e, t: e.when(best == t, WEIGHTS[t]), range(1, len(WEIGHTS)), F.when(best == 0, WEIGHTS[0]))
    labels = F.array_union("_base", F.coalesce("_found.labels", F.expr("cast(array() as array<string>)")))
    return d.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("_base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        score.otherwise(F.when(F.size("_base") > 0, WEIGHTS[-1]).otherwise(0.0)).cast("double").alias("score"),
        F.coalesce(F.col("_found.n"), F.lit(0)).cast("long").alias("n_found"))
