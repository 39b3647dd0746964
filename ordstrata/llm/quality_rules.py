"""Quality rules that vote or abstain, weighed by expectation-maximisation."""

from __future__ import annotations

from functools import reduce
from math import log
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordstrata.llm.common import stored

BLANKS = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
WINDOW = 8
# Frequent function words of the languages whose prose the rules know.
FUNCTION_WORDS = (
    "the of and to in a is that it for on was as with be by are this from or have an"
    " der die das und zu den von mit sich des auf für ist im dem nicht ein eine als auch"
    " de la le et les des en un du une que est pour qui dans par sur au pas plus"
    " el los se del las por con para lo su al como más o no si y"
).split()


def measure(docs: DataFrame) -> DataFrame:
    """Counts of every whole text of ``docs`` (doc_id, text); a null text counts as empty.

    Everything of one text is computed inside its row, so nothing is shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    none = F.array().cast("array<string>")
    kept = [c for c in ("row", "doc_id") if c in docs.columns]
    split = docs.select(
        *kept,
        text.alias("text"),
        F.when(trimmed == "", none).otherwise(F.split(trimmed, GAP)).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"),
    )
    def less(pattern: str) -> Column:
        return F.length("text") - F.length(F.regexp_replace("text", pattern, ""))

    counted = split.select(
        *kept,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        less(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        less(r"\p{Lu}+").cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit(r"\p{Punct}{2,}")).cast("long").alias("n_runs"),
        F.regexp_count("text", F.lit(r"(?<!\S)\p{Punct}+(?!\S)")).cast("long").alias("n_bare"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size(F.array_intersect("words", F.array(*map(F.lit, FUNCTION_WORDS))))
        .cast("long")
        .alias("n_function"),
        F.when(F.size("words") >= WINDOW, F.transform("words", lambda w: F.xxhash64(w))).alias("windows"),
    )
    # Hashes of 1, 2, 4 and then 8 words from each position; those past the end go.
    for reach in (1, 2, 4):
        counted = counted.withColumn("windows", _joined(reach))
    n_windows = F.greatest(F.size("windows") - (WINDOW - 1), F.lit(0))
    counted = counted.withColumn("windows", F.slice("windows", F.lit(1), n_windows))
    # Hashes of windows in order, only where one occurs twice.
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered = counted.withColumn("ordered", F.when(repeated, F.sort_array(pairs))).drop("windows")
    twice = F.filter(
        "ordered",
        lambda x, i: F.coalesce(
            (F.get("ordered", i - 1)["h"] == x["h"]) | (F.get("ordered", i + 1)["h"] == x["h"]),
            F.get("ordered", i - 1)["h"] == x["h"],
            F.get("ordered", i + 1)["h"] == x["h"],
        ),
    )
    starts = ordered.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # Each window adds the words that the window before it did not reach.
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda done, at: F.struct(
            at.alias("last"),
            (done["n"] + F.least(F.lit(WINDOW), at - done["last"])).alias("n"),
        ),
        lambda done: done["n"],
    )
    n_repeat = F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")
    return starts.select(*(c for c in counted.columns if c != "windows"), n_repeat)


def _joined(reach: int) -> Column:
    return F.transform("windows", lambda h, i: F.xxhash64(h, F.get("windows", i + reach)))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules() -> dict[str, tuple[Column, Column]]:
    """Name: (votes good, votes bad); where neither holds the rule abstains."""
    c = F.col
    many = c("n_words") >= 50
    return {
        "length": (many, c("n_words") < 20),
        "symbols": (100 * c("n_symbols") <= c("n_words"), 10 * c("n_symbols") > c("n_words")),
        "marks": (50 * c("n_runs") <= c("n_words"), 10 * c("n_runs") > c("n_words")),
        "bare_marks": (50 * c("n_bare") <= c("n_words"), 10 * c("n_bare") > c("n_words")),
        "repeats": (
            20 * c("n_repeat_words") <= c("n_words"),
            100 * c("n_repeat_words") > 30 * c("n_words"),
        ),
        "lines": (
            (c("n_dup_lines") == 0) & (c("n_lines") >= 2),
            100 * c("n_dup_lines") > 30 * c("n_lines"),
        ),
        "capitals": (10 * c("n_upper") <= c("word_chars"), 10 * c("n_upper") > 4 * c("word_chars")),
        "variety": (
            many & (100 * c("n_distinct") >= 35 * c("n_words")),
            many & (100 * c("n_distinct") < 15 * c("n_words")),
        ),
        "word_length": (
            c("word_chars").between(3 * c("n_words"), 12 * c("n_words")),
            (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 20 * c("n_words")),
        ),
        "function_words": (c("n_function") >= 3, many & (c("n_function") == 0)),
    }


def votes() -> list[Column]:
    return [
        F.when(good, 1).when(bad, -1).otherwise(0).alias(f"vote_{name}")
        for name, (good, bad) in rules().items()
    ]


def posterior(names: list[str], prior: float, accuracy: dict[str, tuple[float, float]]) -> Column:
    """Probability that a text is good, from its votes and the rules' accuracies."""
    prior_odds = log(prior / (1 - prior))
    evidence = []
    for name in names:
        on_good, on_bad = accuracy[name]
        # By vote -1, 0 and 1. An array is an object of the generated code, where numbers would be
        # its text and each round of the estimate compile and keep code of its own.
        weights = [log((1 - on_good) / on_bad), 0.0, log(on_good / (1 - on_bad))]
        if not evidence:
            weights = [prior_odds + w for w in weights]
        evidence.append(F.get(F.array(*map(F.lit, weights)), F.col(name) + 1))
    return 1 / (1 + F.exp(-reduce(add, evidence)))


def estimate(patterns: DataFrame, names: list[str], rounds: int = 20) -> tuple[float, dict]:
    """Share of good texts, and each rule's accuracy on good and on bad texts.

    ``patterns`` has one row per combination of votes with its count ``n``, at most three to the
    number of rules. Each round is one aggregate over it; only the estimates reach the driver.
    The start takes the majority of the votes. Where a rule never votes, its accuracy is even.
    """

    def held(x: float) -> float:
        return min(max(x, 0.02), 0.98)

    majority = reduce(add, [F.col(n) for n in names])
    good = F.when(majority > 2, 0.9).otherwise(0.1)
    prior, accuracy = 0.5, {}
    for _ in range(rounds):
        on = {}
        for n in names:
            on[f"{n}_g"] = F.sum(F.when(F.col(n) == 1, F.col("as_good")).otherwise(0.0))
            on[f"{n}_gv"] = F.sum(F.when(F.col(n) != 0, F.col("as_good")).otherwise(0.0))
            on[f"{n}_b"] = F.sum(F.when(F.col(n) == -1, F.col("as_bad")).otherwise(0.0))
            on[f"{n}_bv"] = F.sum(F.when(F.col(n) != 0, F.col("as_bad")).otherwise(0.0))
        weighed = patterns.withColumn("good", good).withColumns(
            {"as_good": F.col("n") * F.col("good"), "as_bad": F.col("n") * (1 - F.col("good"))}
        )
        sums = weighed.agg(
            F.sum("as_good").alias("good"),
            F.sum("n").alias("all"),
            *(v.alias(k) for k, v in on.items()),
        ).first()
        if not sums["all"]:
            return 0.5, {n: (0.5, 0.5) for n in names}
        before = (prior, accuracy)
        prior = held((sums["good"] + 1) / (sums["all"] + 2))
        accuracy = {
            n: tuple(held((sums[f"{n}_{k}"] + 1) / (sums[f"{n}_{k}v"] + 2)) for k in "gb")
            for n in names
        }
        good = posterior(names, prior, accuracy)
        if before[1] and all(
            abs(x - y) < 1e-3 for n in names for x, y in zip(accuracy[n], before[1][n])
        ):
            break
    return prior, accuracy


def judged(docs: DataFrame, least_probability: float, carried: bool) -> DataFrame:
    """Counts and verdicts; with ``carried`` also the row itself, as a struct ``row``."""
    names = [f"vote_{name}" for name in rules()]
    if carried:
        docs = docs.select(F.struct("*").alias("row"), F.col("doc_id"), F.col("text"))
    measured = stored(measure(docs).select("*", *votes()))
    patterns = stored(measured.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1))
    probability = posterior(names, *estimate(patterns, names))
    return measured.withColumns(
        {
            "base_failed": base_failed(),
            "quality_probability": probability,
            "kept": ~base_failed() & (probability >= least_probability),
        }
    )


def judge(docs: DataFrame, least_probability: float = 0.5) -> DataFrame:
    """Counts, ``base_failed``, ``quality_probability`` and ``kept`` of every row of ``docs``.

    Rules vote good or bad or abstain on each text. Expectation-maximisation over the counts of
    vote combinations estimates how often each rule is right on good and on bad texts; the
    posterior probability that a text is good decides, and a failed base rule rejects at once.

    A null or empty text has zero counts and fails. Repeated rows each get their own verdict, the
    same for the same text. Rows without doc_id are judged like others. An empty table gives no
    rows. Further columns are not read.
    """
    return judged(docs, least_probability, False).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality_probability",
    )


def without_rejected(docs: DataFrame, least_probability: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all columns."""
    return judged(docs, least_probability, True).filter("kept").select("row.*")
