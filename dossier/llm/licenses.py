"""License scans: ordered signature rules gated by keywords; DataFrame functions only.

Words are longest runs of ASCII letters and digits and of all that is not ASCII,
with A-Z lower-cased. Documents without any keyword of a rule are done. In the
others, each place of a keyword is looked at with the words around it, and the
rules of that keyword are tried there; a rule's matches all hold its keyword, so
none can lie elsewhere. A match is a detection: a run of words with the rule's
label.

Overlapping detections are resolved in two steps:

1. a detection within another goes, unless its own rule has the better priority;
   of two over the same words and of one priority the earlier rule's stays;
2. of those left, a detection goes that shares words with one of better priority.

Detections can only meet within some words, and so are compared with their
neighbours in order of place alone: the work grows with the text. All is done
within the row, without a shuffle.

Defined results: a null or empty text has no words and no detection; repeated
rows are scanned each by itself; an empty table gives no rows. Only the key and
the results are returned, so that no other column can clash with them.
"""

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.llm.license_rules import BASE, SPAN, Rule, license_rules

# How sure a detection is, by its rule's priority.
CERTAINTY = [1.0, 0.9, 0.7, 0.3]

_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DETECTION = "struct<start:int,stop:int,priority:int,rule:int,label:string,base:boolean>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _lower(text: Column) -> Column:
    """A-Z lower-cased. Of all other letters only two have ASCII in their lower case, so lower() serves without them."""
    return F.when(text.rlike("[Kİ]"), F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))


def license_words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    spaced = F.trim(F.regexp_replace(_lower(F.coalesce(text, F.lit(""))), _BREAKS, " "))
    return _let(spaced, lambda s: F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " ", -1)))


class _Table:
    """The rules by keyword, as constants of a plan."""

    def __init__(self, rules: list[Rule]):
        by_word: dict[str, list[dict]] = {}
        for order, rule in enumerate(rules):
            for word in rule.keywords:
                entry = {"rule": order, "priority": rule.priority, "label": rule.label, "base": rule.base}
                by_word.setdefault(word, []).append(entry | {"pattern": rule.regex(word)})
        kind = "map<string,array<struct<rule:int,priority:int,label:string,base:boolean,pattern:string>>>"
        self.by_word = F.from_json(F.lit(json.dumps(by_word)), kind)
        self.words = F.array(*map(F.lit, sorted(by_word)))
        # Detections that share words have their keywords at most so many words apart, each with so many rules.
        self.reach = (4 * SPAN + 2) * max(map(len, by_word.values()))

    def detections(self, words: Column) -> Column:
        """All matches of all rules, in order of place, each once."""
        numbered = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
        marks = F.filter(numbered, lambda m: F.array_contains(self.words, m["word"]))

        def around(mark):
            at = mark["at"]
            first = F.greatest(at - SPAN, F.lit(0))
            before = F.slice(words, first + 1, at - first)
            after = F.slice(words, at + 2, F.lit(SPAN))
            marked = F.array(F.concat(F.lit("\x01"), mark["word"]))
            return F.concat_ws(" ", F.array(F.lit("")), before, marked, after)

        def size(text):
            return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))

        def of(mark, seen):
            tried = F.transform(
                F.element_at(self.by_word, mark["word"]),
                lambda r: F.struct(r.alias("r"), F.call_function("regexp_extract", seen, r["pattern"], F.lit(0)).alias("run")),
            )

            def placed(hit):
                start = mark["at"] - size(F.substring_index(hit["run"], "\x01", 1)) + 1
                rule = hit["r"]
                return F.struct(
                    start.alias("start"), (start + size(hit["run"])).alias("stop"), rule["priority"].alias("priority"),
                    rule["rule"].alias("rule"), rule["label"].alias("label"), rule["base"].alias("base"),
                )

            return F.transform(F.filter(tried, lambda hit: hit["run"] != ""), placed)

        found = F.transform(marks, lambda m: _let(around(m), lambda seen: of(m, seen)))
        found = F.array_distinct(F.flatten(found)).cast(f"array<{_DETECTION}>")
        return F.when(F.arrays_overlap(words, self.words), F.array_sort(found)).otherwise(
            F.array().cast(f"array<{_DETECTION}>")
        )

    def _left(self, detections: Column, beats) -> Column:
        """The detections that no neighbour ``beats``."""

        def stays(d, i):
            first = F.greatest(i - self.reach, F.lit(0))
            near = F.slice(detections, first + 1, F.lit(2 * self.reach + 1))
            return ~F.exists(near, lambda e: beats(e, d))

        return F.filter(detections, stays)

    def resolved(self, detections: Column) -> Column:
        def holds(e, d):
            longer = (e["stop"] - e["start"]) > (d["stop"] - d["start"])
            sooner = (e["priority"] < d["priority"]) | (e["rule"] < d["rule"])
            within = (e["start"] <= d["start"]) & (e["stop"] >= d["stop"]) & (e["priority"] <= d["priority"])
            return within & (longer | sooner)

        def meets(e, d):
            return (e["start"] < d["stop"]) & (e["stop"] > d["start"]) & (e["priority"] < d["priority"])

        return _let(self._left(detections, holds), lambda kept: self._left(kept, meets))


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: list[Rule] | None = None
) -> DataFrame:
    """``key``, ``n_words``, ``base`` (all places of the base rules) and ``detections`` (what is left of all).

    A detection is the run of words from ``start`` (from 0) up to ``stop``, with its rule's label, priority and number.
    """
    table = _Table(license_rules() if rules is None else rules)

    def scanned(words):
        return _let(
            table.detections(words),
            lambda found: F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                F.filter(found, lambda d: d["base"]).alias("base"),
                table.resolved(found).alias("detections"),
            ),
        )

    scan = docs.select(F.col(key).alias("key"), _let(license_words(F.col(text)), scanned).alias("scan"))
    return scan.select(F.col("key").alias(key), "scan.n_words", "scan.base", "scan.detections")


def license_labels(scan: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row for each document of ``scan_licenses``: labels, places of the base phrases, and how sure the best one is."""

    def named(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    def labels(detections):
        return F.transform(detections, lambda d: d["label"])

    starts = F.transform("base", lambda d: d["start"].cast("bigint"))
    certain = F.transform("detections", lambda d: F.get(F.array(*map(F.lit, CERTAINTY)), d["priority"]))
    return scan.select(
        key,
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        named(labels("base")).alias("base_labels"),
        named(F.concat(labels("base"), labels("detections"))).alias("labels"),
        F.coalesce(F.array_max(certain), F.lit(0.0)).alias("score"),
    )


__all__ = ["BASE", "license_labels", "license_words", "scan_licenses"]
