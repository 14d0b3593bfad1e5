"""Quality rules under weak supervision.

Rules look at a document's counts and vote for or against it, or abstain. Documents with the same votes are counted
together, so whatever the corpus's size there are at most 3 ** len(RULES) rows, on which expectation-maximisation
estimates how often each rule votes against, abstains and votes for, among good and among bad documents. A document is
kept if the posterior probability that it is good, given all votes and abstentions, is one half or more.

The share of good documents is given (GOOD), as bad ones of several kinds, each of which one rule sees, would otherwise be
taken for good ones with a slip. Bad documents may be far fewer: what is left of their share then takes documents that
look like all others, which stay. For the same reason no rule may be wrong about more than MOST_FALSE of the good ones:
what it votes against beyond that must be bad. How often a rule abstains says little about quality; it is drawn to the rate of all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laddermill.llm.common import let, materialize, table, words

WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
ITERATIONS = 20
RULES = ("length", "word_size", "symbols", "line_size", "repeated_lines", "repeated_words")
#: The share of good documents.
GOOD = 0.8
#: How often a rule votes against, abstains and votes for before any vote is seen, and the weight of that: a share of all documents.
PRIOR_GOOD, PRIOR_BAD, PRIOR_WEIGHT = (0.02, 0.08, 0.9), (0.35, 0.15, 0.5), 0.02
#: Weight of the abstentions of all documents in the estimate of either class, in documents of the class.
POOLED = 4.0
#: The most of the good documents that a rule may vote against.
MOST_FALSE = 0.01
VOTES = (-1, 0, 1)


def repeated_words(w: Column) -> Column:
    """Words of the array w inside a run of WINDOW words that occurs at least twice in it, the first occurrence too."""
    windows = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    def count(h: Column) -> Column:
        def of_sorted(z: Column) -> Column:
            same = lambda x, k: ((k > 0) & (F.get(z, k - 1)["h"] == x["h"])) | F.coalesce(F.get(z, k + 1)["h"] == x["h"], F.lit(False))
            places = F.array_sort(F.transform(F.filter(z, same), lambda x: x["i"]))
            fresh = lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b)
            return let(places, fresh)

        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(ordered, of_sorted))

    return F.when(F.size(w) > WINDOW, let(windows, count)).otherwise(0)


def counts(docs: DataFrame, text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """docs' doc_id (and the columns `more`) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Words are runs of other than ASCII white space; a null text has none, and 0 everywhere, and fails the base.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    row = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).cast("long").alias("n_repeat_words")))
    found = docs.select(
        "doc_id", *more,
        row.alias("w"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(F.split(text, "\n"), lambda x: x != "")).cast("long").alias("n_lines"),
    )
    failed = (F.col("w.n_words") < LEAST_WORDS) | (F.col("w.n_repeat_words") * 100 > F.col("w.n_words") * MOST_REPEATED)
    return found.select("doc_id", *more, "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words", "n_lines", failed.alias("base_failed"))


def vote(against: Column, for_: Column) -> Column:
    """-1, 1, or 0 to abstain."""
    return F.when(against, -1).when(for_, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules, over the columns of counts(). Each looks at something of its own, and votes both ways."""
    n, c = F.greatest(F.col("n_words"), F.lit(1)), F.col
    mean, lines = c("word_chars") / n, F.greatest(c("n_lines"), F.lit(1))
    return {
        "length": vote(c("n_words") < LEAST_WORDS, c("n_words") >= 2 * LEAST_WORDS),
        "word_size": vote((mean < 2.5) | (mean > 12), (mean >= 3) & (mean <= 10)),
        "symbols": vote((c("n_symbols") * 10 > n) | (c("n_symbols") * 25 > F.greatest(c("word_chars"), F.lit(1))), c("n_symbols") * 50 <= n),
        "line_size": vote((c("n_lines") >= 8) & (n < 2 * lines), (c("n_lines") < 4) | (n >= 3 * lines)),
        "repeated_lines": vote(c("n_dup_lines") * 10 > lines * 3, c("n_dup_lines") * 10 <= lines),
        "repeated_words": vote(c("n_repeat_words") * 10 > n * 2, c("n_repeat_words") * 10 <= n),
    }


def votes(counted: DataFrame) -> DataFrame:
    return counted.withColumns({f"v_{name}": rule.cast("int") for name, rule in rules().items()})


def fit(voted: DataFrame, iterations: int = ITERATIONS, good: float = GOOD) -> dict:
    """For each class and rule how often it votes -1, 0 and 1, and the share of good documents, as given.

    Each iteration is one aggregate over the table of vote patterns; only its sums come to the driver.
    """
    columns = [f"v_{name}" for name in RULES]
    patterns = materialize(voted.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), "votes")
    priors = {"good": PRIOR_GOOD, "bad": PRIOR_BAD}
    model = {"share": good, **{c: dict.fromkeys(RULES, prior) for c, prior in priors.items()}}
    cells = [(c, name, v) for c in priors for name in RULES for v in VOTES]
    first = patterns.agg(F.sum("n").alias("n"), *(F.sum(F.when(F.col(f"v_{name}") == 0, F.col("n")).otherwise(0)).alias(name) for name in RULES)).first()
    total = first["n"] or 0
    for _ in range(iterations if total else 0):
        p = posterior(model)
        weight = {"good": p * F.col("n"), "bad": (1 - p) * F.col("n")}
        s = patterns.agg(*(F.sum(F.when(F.col(f"v_{name}") == v, weight[c]).otherwise(0.0)).alias(f"{c}_{name}_{v}") for c, name, v in cells)).first()
        model = {"share": good, "good": {}, "bad": {}}
        for c in priors:
            for name in RULES:
                seen = [s[f"{c}_{name}_{v}"] for v in VOTES]
                silent = (seen[1] + POOLED * sum(seen) * first[name] / total) / ((1 + POOLED) * sum(seen))
                extra = PRIOR_WEIGHT * total
                voiced = [seen[i] + extra * priors[c][i] for i in (0, 2)]
                against = voiced[0] / sum(voiced) * (1 - silent)
                against = min(against, MOST_FALSE) if c == "good" else against
                model[c][name] = (against, silent, 1 - silent - against)
    return model


def posterior(model: dict) -> Column:
    """The probability that a document is good, given its votes and abstentions."""
    odds = F.lit(math.log(model["share"] / (1 - model["share"])))
    least = 1e-12  # a rule that never abstains, or always does
    for name in RULES:
        ratio = [math.log(max(g, least) / max(b, least)) for g, b in zip(model["good"][name], model["bad"][name], strict=True)]
        odds = odds + F.when(F.col(f"v_{name}") == -1, ratio[0]).when(F.col(f"v_{name}") == 1, ratio[2]).otherwise(ratio[1])
    return 1 / (1 + F.exp(-odds))


def judged(docs: DataFrame, iterations: int = ITERATIONS, more: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs (doc_id, text): the counts, base_failed, p_good and kept, and the columns `more`.

    kept is false if the base fails, else whether p_good is one half or more. A null or empty text fails the base. Rows
    that repeat, and rows with a null doc_id, are judged each for itself; other columns are ignored. An empty table
    gives no rows.
    """
    voted = materialize(votes(counts(docs, more=more)), "quality")
    p = posterior(fit(voted, iterations))
    return voted.withColumn("p_good", p).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def keep_good(docs: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """docs without the rejected rows, each judged by its own text, whatever other rows have its doc_id."""
    named = docs.withColumn("_row", F.xxhash64(*docs.columns))
    good = judged(named, iterations, more=("_row",)).filter("kept").select(F.col("doc_id").alias("_good"), "_row").distinct()
    joined = named.join(good.withColumnRenamed("_row", "_good_row"), F.col("_row").eqNullSafe(F.col("_good_row")) & named["doc_id"].eqNullSafe(F.col("_good")), "left_semi")
    return joined.drop("_row")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


QUERIES = {"op3_quality_rules": op3_quality_rules}
ORACLE: dict[str, str] = {}
