"""Quality rules as a short-circuit cascade; DataFrame functions only."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import hash_sample, unused, without
from tagwright.session import spread, written

WINDOW = 3
SYMBOLS = r"[#*$%&|<>]"
BLANK = r"[\x20\x09-\x0D]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_marks", "n_lines", "n_dup_lines", "n_repeat_words")
SAMPLE_ROWS = 2000  # documents on which cost and selectivity are estimated
TIMES = 3
LEAST_SECONDS = 0.01

Measured = dict[str, Column]


@dataclass(frozen=True)
class Rule:
    """A document fails if ``fails`` holds for the measures that the rule reads."""

    name: str
    reads: tuple[str, ...]
    fails: Callable[[Measured], Column]


# The order here has no effect: the cascade finds its own.
FEW_WORDS = Rule("few words", ("n_words",), lambda m: m["n_words"] < 50)
REPEATED = Rule(
    "repeated phrases",
    ("n_words", "n_repeat_words"),
    lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
)
RULES = (
    FEW_WORDS,
    REPEATED,
    Rule("symbols", ("n_words", "n_symbols"), lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("exclamation marks", ("n_words", "n_marks"), lambda m: 10 * m["n_marks"] > 3 * m["n_words"]),
    Rule(
        "word length",
        ("n_words", "word_chars"),
        lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 20 * m["n_words"]),
    ),
    Rule("repeated lines", ("n_lines", "n_dup_lines"), lambda m: 100 * m["n_dup_lines"] > 35 * m["n_lines"]),
)


def words_of(text: Column) -> Column:
    """The words of a text, one after the other; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), "")


def windows(words: Column, width: int = WINDOW) -> Column:
    """The hash of each run of ``width`` words, in order."""

    def hashes(own: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(own) - width)
        runs = F.transform(starts, lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(width)]))
        return F.when(F.size(own) >= width, runs).otherwise(F.array().cast("array<bigint>"))

    return _bound(words, hashes)


def covered_words(hashes: Column, width: int = WINDOW) -> Column:
    """How many words lie in a window that is found twice or more.

    Most texts repeat no window, which one pass over the hashes tells. In the others the windows are
    sorted by hash; those equal to a neighbour are put back in the order of the text, and each covers
    ``width`` words or as many as lie before the next one.
    """
    last = F.size(hashes) - 1
    zipped = F.arrays_zip(hashes.alias("hash"), F.sequence(F.lit(0), last).alias("at"))
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)

    def covered(places: Column) -> Column:
        none = F.array(F.lit(None).cast("struct<hash:bigint,at:int>"))
        beside = F.arrays_zip(
            places.alias("own"),
            F.concat(none, F.slice(places, F.lit(1), last)).alias("before"),
            F.concat(F.slice(places, F.lit(2), last), none).alias("after"),
        )
        same = lambda one, other: one["hash"].eqNullSafe(other["hash"])
        twice = F.filter(beside, lambda x: same(x["own"], x["before"]) | same(x["own"], x["after"]))
        return _bound(F.sort_array(F.transform(twice, lambda x: x["own"]["at"])), spanned)

    def spanned(starts: Column) -> Column:
        following = F.slice(starts, F.lit(2), F.size(starts))
        spans = F.zip_with(starts, following, lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
        return F.aggregate(spans, F.lit(0).cast("bigint"), lambda so_far, span: so_far + span)

    return F.when(repeats, _bound(F.sort_array(zipped), covered)).otherwise(F.lit(0).cast("bigint"))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it.

    Without it a filter on the result, pushed below the projection, would repeat the value in the body, even
    for each element of an array.
    """
    return F.transform(F.array(value), lambda own: body(own)).getItem(0)


def measures(text: Column, words: Column, hashes: Column) -> Measured:
    """What the rules read, each as an expression on the text, its words and its windows."""
    given = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(given, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda pattern: F.regexp_count(given, F.lit(pattern)).cast("bigint")
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.char_length(given).cast("bigint") - count(BLANK),
        "n_symbols": count(SYMBOLS),
        "n_marks": count("!"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_dup_lines": _bound(lines, lambda own: (F.size(own) - F.size(F.array_distinct(own))).cast("bigint")),
        "n_repeat_words": _bound(hashes, covered_words),
    }


def measured(docs: DataFrame, names: Iterable[str] = MEASURES, text: str = "text") -> DataFrame:
    """``docs`` with the named measures; words and windows are made once per text.

    A null text counts as an empty one: all measures are zero. Nothing is shuffled, whatever the length of
    a text. Columns of the input named like an added one are replaced.
    """
    chosen = list(names)
    given = without(docs, *chosen, "rule_words", "rule_windows")
    split = given.withColumn("rule_words", words_of(F.col(text)))
    if "n_repeat_words" in chosen:
        split = split.withColumn("rule_windows", windows(F.col("rule_words")))
    found = measures(F.col(text), F.col("rule_words"), F.col("rule_windows"))
    return split.select(*[F.col(f"`{name}`") for name in given.columns], *[found[name].alias(name) for name in chosen])


def rule_order(
    docs: DataFrame, rules: Iterable[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules by rejected share per second, the best first, as found on a sample.

    The sample are ``rows`` documents at most, picked by a hash of their text and written once. A rule's cost is the
    time its measures take over the sample beyond a bare scan, the median of ``TIMES``; its selectivity is the share it
    rejects. Both decide the order of evaluation only, never whether a document is kept. Null and empty texts, and an empty table, are
    samples like others.
    """
    sample = written(hash_sample(docs, text, rows), "rule-sample")

    def seconds(df: DataFrame) -> float:
        taken = []
        for _ in range(TIMES):
            begun = time.monotonic()
            df.write.format("noop").mode("overwrite").save()
            taken.append(time.monotonic() - begun)
        return median(taken)

    bare = seconds(sample)
    ranked = []
    for rule in rules:
        fails = rule.fails({name: F.col(name) for name in rule.reads})
        tested = measured(sample, rule.reads, text).select(fails.cast("double").alias("fails"))
        cost = max(LEAST_SECONDS, seconds(tested) - bare)
        rejected = tested.agg(F.avg("fails")).first()[0] or 0.0
        ranked.append((-rejected / cost, cost, rule.name, rule))
    return [entry[-1] for entry in sorted(ranked, key=lambda entry: entry[:3])]


def cascade(
    docs: DataFrame,
    rules: Iterable[Rule],
    text: str = "text",
    failed: str = "failed_rule",
    known: Iterable[str] = (),
) -> DataFrame:
    """``docs`` with the name of the first rule, in the given order, that a document fails; null if none.

    Each measure is worked out within the branch of the rule that reads it, so a document that one rule
    rejects does not pay for the next. Measures that ``docs`` has already are named in ``known``. A null text is an
    empty one; an empty table gives no rows. Which of several failed rules is named follows from the given order, whether one is
    does not.
    """
    given = without(docs, failed)
    rules = list(rules)
    read = {name for rule in rules for name in rule.reads} - set(known)
    ready = not read & {"n_words", "n_repeat_words"}  # the other measures need no words

    def verdict(words: Column) -> Column:
        found = measures(F.col(text), words, windows(words)) | {name: F.col(name) for name in known}
        branches = F
        for rule in rules:
            branches = branches.when(rule.fails({name: found[name] for name in rule.reads}), rule.name)
        return branches

    none = F.array().cast("array<string>")
    return given.withColumn(failed, verdict(none) if ready else _bound(words_of(F.col(text)), verdict))


# What a report shows of every document; what only the other rules read is worked out as far as the cascade gets.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def document_quality(docs: DataFrame) -> DataFrame:
    """The reported measures of every document, whether it fails a base rule, and whether it passes all rules.

    A null or empty text has zeros and fails. Rows that repeat an id stay; an empty table gives no rows. Nothing depends on the
    order that the cascade finds.
    """
    source = spread(docs.select("doc_id", "text"))
    judged = cascade(measured(source, REPORTED), rule_order(source), known=REPORTED)
    base = [rule.fails({name: F.col(name) for name in rule.reads}) for rule in (FEW_WORDS, REPEATED)]
    return judged.select(
        "doc_id", *REPORTED, (base[0] | base[1]).alias("base_failed"), F.col("failed_rule").isNull().alias("kept")
    )


def passing(docs: DataFrame) -> DataFrame:
    """The documents that fail no rule; all columns stay as they are, whatever their names.

    Null and empty texts fail. Whole texts are judged, of any length. An empty table gives no rows.
    """
    source = spread(docs)
    failed = unused(docs, "failed_rule")
    judged = cascade(source, rule_order(source), failed=failed)
    return judged.where(F.col(failed).isNull()).drop(failed)
