"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Each rule is a boolean expression over the text and the base measures, and
costs the characters it reads.  On a sample of all files the cost and the
rejections of every rule are taken among the texts that the rules before it
leave; the cascade is one CASE over the rules, each the one with the most
rejections per cost where it stands, so a text that a cheap rule rejects never
reaches the costly ones.  The order changes the time taken and the name of the
reported rule, never the verdict.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipledger.llm.common import words
from clipledger.session import stored

WINDOW = 5            # words in a repeated window
SAMPLE_ROWS = 2_000   # rows on which cost and selectivity are estimated, about

# The symbols of the contract.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """`rejects` is true for a text to reject; null counts as not rejecting.  `reads`: characters it looks at."""

    name: str
    rejects: Column
    reads: Column = field(default_factory=lambda: F.lit(0))


def _hits(pattern: str) -> Column:
    """Code points of `text` that match."""
    return F.char_length(F.regexp_replace("text", f"[^{pattern}]+", F.lit("")))


def default_rules() -> list[Rule]:
    """Thresholds as ratios of whole numbers, so that no rounding decides."""
    n, chars, whole = F.col("n_words"), F.col("word_chars"), F.char_length("text")
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("repeated_lines", 10 * F.col("n_dup_lines") > 3 * F.greatest("n_lines", F.lit(4))),
        Rule("word_length", (chars < 2 * n) | (chars > 20 * n)),
        Rule("capitals", 10 * _hits(r"\p{Lu}") > 3 * chars, whole),
        Rule("exclamation", 10 * _hits("!?") > chars, whole),
        Rule("no_letters", 2 * _hits(r"\p{L}") < chars, whole),
    ]


def _window(ws: Column, i: Column) -> list[Column]:
    return [F.get(ws, i + k) for k in range(WINDOW)]


def measures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text and the base measures as long.

    Null and blank texts have no words, and zero in every measure but n_lines.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), words(F.col("text")).alias("ws"))
    at = F.when(F.size("ws") >= WINDOW, F.sequence(F.lit(0), F.size("ws") - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    lines = F.split("text", "\n")
    base = base.select(
        "*", F.filter(lines, lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]"))).alias("full"),
        F.size(lines).cast("long").alias("n_lines"), at.alias("at"),
        F.transform(at, lambda i: F.xxhash64(*_window(F.col("ws"), i))).alias("hashes"))
    # Equal windows have equal hashes: as many hashes as windows means that no window is repeated.
    # Only the other texts sort their windows; words hold no space, so a joined window stands for its words.
    base = base.select(
        "*", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(F.transform("at", lambda i: F.struct(
            F.concat_ws(" ", *_window(F.col("ws"), i)).alias("w"), i.alias("i"))))).alias("sorted"))
    same = lambda j, k: F.get(F.col("sorted"), j)["w"].eqNullSafe(F.get(F.col("sorted"), k)["w"])
    base = base.withColumn("starts", F.when(F.col("sorted").isNotNull(), F.sort_array(F.transform(
        F.filter("at", lambda j: same(j, j - 1) | same(j, j + 1)), lambda j: F.get(F.col("sorted"), j)["i"]))))
    # A repeated window adds the words up to the next repeated window, at most its own.
    gaps = F.zip_with(
        F.slice("starts", F.lit(2), F.greatest(F.size("starts") - 1, F.lit(0))),
        F.slice("starts", F.lit(1), F.greatest(F.size("starts") - 1, F.lit(0))),
        lambda after, here: F.least(after - here, F.lit(WINDOW)))
    covered = F.when(F.size("starts") > 0, F.aggregate(gaps, F.lit(WINDOW), lambda a, x: a + x)).otherwise(0)
    joined = F.array_join("ws", "")
    measured = F.struct(
        "n_lines", F.size("ws").cast("long").alias("n_words"), F.char_length(joined).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(joined, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"))
    # A generator of one row: a filter on a measure is not pushed through it, where it would repeat the work
    # of every measure for each word.
    return base.select("doc_id", "text", F.explode(F.array(measured)).alias("m")).select("doc_id", "text", "m.*")


def _base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def cascade_order(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules in turn, each with the most rejections per cost among the texts left by those before it; ties by name.

    About `sample_rows` rows of all files are chosen by their hash; texts that
    fail the base never reach a rule and do not count.  The driver gets one row
    for each set of rules that reject the same text.
    """
    share = max(docs.count() // sample_rows, 1)
    sample = docs.select("doc_id", "text").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0)
    flags = [F.coalesce(r.rejects, F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]
    costs = [(1 + r.reads).cast("double").alias(f"c{i}") for i, r in enumerate(rules)]
    # Stored, so that the measures are taken once for all rules.
    measured = stored(measures(sample), "rule-sample").where(~_base_failed())
    left = [(tuple(row[f"r{i}"] for i in range(len(rules))), row["n"], [row[f"c{i}"] for i in range(len(rules))])
            for row in measured.select(*flags, *costs).groupBy(*[f"r{i}" for i in range(len(rules))])
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(rules))]).collect()]
    ordered, waiting = [], list(range(len(rules)))
    while waiting:
        def worth(i: int) -> float:
            return sum(n for r, n, _ in left if r[i]) / max(sum(c[i] for _, _, c in left), 1.0)

        best = min(waiting, key=lambda i: (-worth(i), rules[i].name))
        waiting.remove(best)
        ordered.append(rules[best])
        left = [x for x in left if not x[0][best]]
    return ordered


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: doc_id, the base measures, base_failed, kept and rejected_by (null if kept).

    A text fails the base with under 10 words, or with over 20 % of its words
    in repeated windows; the cascade sees only the others.  Null and empty
    texts fail it.  Repeated rows get equal verdicts; other columns are not
    read; an empty table gives an empty result.
    """
    measured = measures(docs)
    ordered = cascade_order(docs, rules or default_rules(), sample_rows)
    failed = _base_failed()
    verdict = F.when(failed, F.lit("base"))
    for rule in ordered:
        verdict = verdict.when(rule.rejects, F.lit(rule.name))
    return measured.withColumn("rejected_by", verdict).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"), "rejected_by")
