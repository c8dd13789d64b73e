"""Quality rules: simple counts per document, and a log-likelihood ratio of hashed n-grams."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ROW_HASH, SPACE, row_hash, stored, whole_text

# Characters counted as symbols, and the rule limits.
SYMBOLS = r"[#*$%&|<>]"
FEWEST_WORDS = 50
MOST_REPEATED_PERCENT = 50
# A token is a run of letters or a run of other visible characters.
TOKEN = r"\p{L}+|[^\s\p{L}]+"

BUCKETS = 1 << 14


def with_base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``.

    All per row, in arrays.  Windows are compared by a 64-bit hash within one text; only a text that
    has a window twice sorts its windows to find where.
    """
    words = F.array_remove(F.split(F.col(text), f"[{SPACE}]+"), "")
    lines = F.filter(F.split(F.col(text), "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    hashed = F.transform(
        "_words", lambda word, i: F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2))
    )
    placed = F.sort_array(F.transform("_windows", lambda window, i: F.struct(window.alias("window"), i.alias("start"))))
    has_repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")

    def repeated(item: Column, place: Column) -> Column:
        beside = [F.get("_placed", place + step)["window"] == item["window"] for step in (-1, 1)]
        return F.coalesce(beside[0], F.lit(False)) | F.coalesce(beside[1], F.lit(False))

    def reach(start: Column, place: Column) -> Column:
        """Words that this window covers before the next repeated one starts."""
        return F.least(F.lit(3), F.coalesce(F.get("_starts", place + 1) - start, F.lit(3)))

    return (
        docs.withColumns({"_words": words, "_lines": lines})
        .withColumn("_windows", F.slice(hashed, 1, F.greatest(F.size("_words") - 2, F.lit(0))))
        .withColumn("_placed", F.when(has_repeats, placed))
        .withColumn("_starts", F.sort_array(F.transform(F.filter("_placed", repeated), lambda item: item["start"])))
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.array_join("_words", "")).cast("long"),
                "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": F.coalesce(
                    F.aggregate(F.transform("_starts", reach), F.lit(0).cast("long"), lambda total, n: total + n),
                    F.lit(0).cast("long"),
                ),
            }
        )
        .drop("_words", "_lines", "_windows", "_placed", "_starts")
    )


def base_failed() -> Column:
    too_few = F.col("n_words") < FEWEST_WORDS
    return too_few | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def with_grams(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """Add ``_grams``: the bucket of every token and of every pair of neighbouring tokens."""

    def bucket(*tokens: Column) -> Column:
        return F.pmod(F.xxhash64(*tokens), F.lit(buckets)).cast("int")

    after = F.slice("_tokens", 2, F.greatest(F.size("_tokens") - 1, F.lit(0)))
    return (
        docs.withColumn("_tokens", F.regexp_extract_all(F.col(text), F.lit(f"({TOKEN})"), F.lit(1)))
        .withColumn("_ones", F.transform("_tokens", lambda token: bucket(token)))
        .withColumn("_twos", F.slice(F.zip_with("_tokens", after, lambda a, b: bucket(a, b)), 1, F.size(after)))
        .withColumn("_grams", F.concat("_ones", "_twos"))
        .drop("_tokens", "_ones", "_twos")
    )


def fit_ratio(
    grams: DataFrame,
    trusted_ids: DataFrame,
    buckets: int = BUCKETS,
    mixed: float = 0.05,
    least_count: float = 0.5,
) -> list[float]:
    """Log ratio of the trusted to the raw multinomial for every bucket; ``grams`` has ``doc_id``, ``_grams``.

    The raw counts are over all n-grams of all rows, merged in each task, so that a task ships at
    most ``buckets`` rows.  The trusted target is every row with a trusted id; the ids are stored first, so
    that Spark knows their size and broadcasts them only below its own threshold.  The target is mixed with the
    raw distribution at ``mixed`` of its size, and at least ``least_count`` counts per bucket, so a
    ratio cannot fall below ``log(mixed / (1 + mixed))`` however large the corpus.
    """
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("_trusted_id")).where("_trusted_id IS NOT NULL")
    chosen = stored(ids.distinct(), "trusted")
    marked = grams.join(chosen, F.col("doc_id") == F.col("_trusted_id"), "left")
    counted = (
        marked.select(F.col("_trusted_id").isNotNull().cast("long").alias("trusted"), F.explode("_grams").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("trusted"))
    )
    counts = {row["bucket"]: (row["raw"], row["trusted"]) for row in counted.collect()}  # at most `buckets` rows
    all_raw = sum(raw for raw, _ in counts.values())
    all_trusted = sum(trusted for _, trusted in counts.values())
    prior = max(mixed * all_trusted, least_count * buckets)
    ratios = [0.0] * buckets
    for bucket, (raw, trusted) in counts.items():
        share = raw / all_raw
        ratios[bucket] = round(math.log((trusted + prior * share) / ((all_trusted + prior) * share)), 4)
    return ratios


def log_ratio(ratios: list[float]) -> Column:
    """Mean log ratio over the n-grams of a text; 0 for a text without any."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    total = F.aggregate("_grams", F.lit(0.0), lambda sofar, bucket: sofar + F.get(table, bucket))
    return total / F.greatest(F.size("_grams"), F.lit(1))


def quality_rules(
    docs: DataFrame,
    trusted_ids: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = -0.25,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Base counts, rule verdict and method verdict of every document.

    ``kept`` is false for a document that fails the base rules, else true when its length-normalised
    log-likelihood ratio reaches ``threshold``.  The texts are read once: counts and bucket numbers
    are stored, and both multinomials and scores come from the stored buckets.  Texts never move.

    A null or empty text has no words and fails.  Without trusted rows every ratio is 0.  Repeated rows
    get equal verdicts; a null id is never trusted.  Other columns are not read.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    counted = with_base_counts(source.withColumn(ROW_HASH, row_hash()))
    rows = stored(with_grams(counted, "text", buckets).drop("text"), "grams")
    ratios = fit_ratio(rows.select("doc_id", "_grams"), trusted_ids, buckets)
    failed = base_failed()
    return rows.withColumn("log_ratio", log_ratio(ratios)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("log_ratio") >= threshold)).alias("kept"),
        "log_ratio",
        ROW_HASH,
    )
