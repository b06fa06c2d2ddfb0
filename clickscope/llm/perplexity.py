"""Quality classifier: perplexity under a Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney trigram model over code
points, one for each language and one of all, trained on the whole text of
every trusted document and kept as tables (see ``symbolmodel``).

A document's perplexity per symbol is held against two quantiles of its
language's trusted perplexities, above and below which it is rejected (text of
one repeated word is too easy to foretell). They are taken from held-out text:
trusted documents are dealt to ``FOLDS``, and each is scored, here and in the
result, by the models that did not count its fold. Which quantiles is chosen
with the labels (``cuts``). A short text's perplexity is an average of few
symbols, so it is first shrunk towards the median as if ``PRIOR_SYMBOLS`` more
had that one, in the quantiles and in the result alike.
Languages without trusted text use the model and the threshold of all.

Defined results: a null or empty text, or one of white space only, has no
perplexity and is kept; a null language uses the pooled model; without trusted
text nothing is rejected; labels that repeat for a document make it trusted if
any says so; rows repeat as they are; an empty table gives no rows; further
columns are not read (the filtering form returns them as they are).
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import materialized_broadcast
from . import symbolmodel
from .shared import landed, read_table, under_other_names

LEVELS = (0.99, 0.995, 0.998, 0.999)  # shares of trusted text to keep, of which the labels choose
FOLDS = 3
PRIOR_SYMBOLS = 300.0


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``_quality`` (1 if any label of the document says so,
    null: no label) and ``_fold`` (of trusted text, equal texts in the same
    one; else ``ALL``). The labels are broadcast after a check of their size,
    else joined by a shuffle."""
    of = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
          .agg(F.max((F.col("quality") == 1).cast("int")).alias("_quality")))
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")
    return docs.join(materialized_broadcast(of), "doc_id", "left").select(*docs.columns, "_quality").withColumn(
        "_fold", F.when(F.col("_quality") == 1, fold).otherwise(symbolmodel.ALL))


def shrunk(prior: float) -> Column:
    n = F.col("_n")
    return F.exp((n * F.col("_logs") + prior * F.log("_middle")) / (n + prior))


def cuts(scored: DataFrame, prior: float = PRIOR_SYMBOLS) -> DataFrame:
    """(lang, _middle, _low, _high) from held-out rows (lang, _quality, _n,
    _logs): the median, and the quantiles between which the chosen share of a
    language's trusted texts lies; a null language for those of all texts.

    Of ``LEVELS`` the share with which the most labelled texts are judged
    right (mean of both labels; ties: the largest) is taken. Where a language
    has too few texts for a quantile beyond its extremes, the wider of its
    own and the bound of all texts holds."""
    scored = landed(scored.where("_logs is not null"), "quality-held-out")
    good = scored.where("_quality = 1")

    def by_language(rows: DataFrame, *values: Column) -> DataFrame:
        every = rows.agg(*values).select(F.lit(None).cast("string").alias("lang"), "*")
        return rows.where("lang is not null").groupBy("lang").agg(*values).union(every)

    middle = materialized_broadcast(by_language(good, F.percentile_approx(F.exp("_logs"), 0.5, 10_000).alias("_middle")))
    rows = landed(with_bounds(scored, middle, ["_middle"]).withColumn("_x", shrunk(prior)), "quality-shrunk")
    low, high = ([(1 - x) / 2 for x in LEVELS], [(1 + x) / 2 for x in LEVELS])
    found = by_language(rows.where("_quality = 1"), F.count("*").alias("m"),
                        F.percentile_approx("_x", low, 10_000).alias("low"),
                        F.percentile_approx("_x", high, 10_000).alias("high"))
    every = found.where("lang is null").select(F.col("low").alias("all_low"), F.col("high").alias("all_high"))
    found = found.crossJoin(F.broadcast(every)).join(
        middle.withColumnRenamed("lang", "_of"), F.col("lang").eqNullSafe(F.col("_of")))
    few = [F.col("m") * x < 1 for x in low]
    bounds = [(F.when(f, F.least(F.col("low")[i], F.col("all_low")[i])).otherwise(F.col("low")[i]),
               F.when(f, F.greatest(F.col("high")[i], F.col("all_high")[i])).otherwise(F.col("high")[i]))
              for i, f in enumerate(few)]
    found = materialized_broadcast(found.select("lang", "_middle", *(
        c.alias(f"{side}{i}") for i, pair in enumerate(bounds) for side, c in zip(("low", "high"), pair))))
    names = [f"{side}{i}" for i in range(len(LEVELS)) for side in ("low", "high")]
    judge = with_bounds(rows.drop("_middle"), found, names)
    kept = [F.col("_x").between(F.col(f"low{i}"), F.col(f"high{i}")) for i in range(len(LEVELS))]
    right = judge.groupBy("_quality").agg(*(F.avg(k.cast("double")).alias(f"k{i}") for i, k in enumerate(kept))).collect()
    share = {r._quality: r for r in right}
    value = [share[1][f"k{i}"] - (share[0][f"k{i}"] if 0 in share else 0.0) if 1 in share else 0.0
             for i in range(len(LEVELS))]
    best = max(range(len(LEVELS)), key=lambda i: (value[i] if 0 in share else 0.0, LEVELS[i]))
    return found.select("lang", "_middle", F.col(f"low{best}").alias("_low"), F.col(f"high{best}").alias("_high"))


def with_bounds(rows: DataFrame, bounds: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with their language's ``names`` of ``bounds``; those of all
    texts where the language has none."""
    every = bounds.where("lang is null").first()
    joined = rows.join(bounds.where("lang is not null").select("lang", *names), "lang", "left")
    return joined.select(*rows.columns, *(
        F.coalesce(F.col(n), F.lit(every[n] if every else None).cast("double")).alias(n) for n in names))


def judged(docs: DataFrame, labels: DataFrame, prior: float = PRIOR_SYMBOLS) -> DataFrame:
    """``docs`` with ``_perplexity``, ``_shrunk``, ``_threshold``, ``_least``
    and ``_kept``. A trusted text is scored by the models that did not count
    its fold."""
    every = with_labels(docs, labels)
    trusted = every.where("_quality = 1").select("lang", "text", F.col("_fold").alias("fold"))
    model = symbolmodel.Model(trusted, FOLDS)
    labelled = every.where("_quality is not null").select("doc_id", "lang", "text", "_quality", "_fold")
    bounds = cuts(symbolmodel.with_perplexity(labelled, model, F.col("_fold"))
                  .select("lang", "_quality", "_n", "_logs"), prior)
    scored = symbolmodel.with_perplexity(every, model, F.col("_fold"))
    scored = with_bounds(scored, bounds, ["_middle", "_low", "_high"]).withColumn("_shrunk", shrunk(prior))
    kept = F.coalesce(F.col("_shrunk").between(F.col("_low"), F.col("_high")), F.lit(True))
    return scored.select(*docs.columns, F.exp("_logs").alias("_perplexity"), "_shrunk",
                         F.col("_high").alias("_threshold"), F.col("_low").alias("_least"), kept.alias("_kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, as they are."""
    return under_other_names(docs, lambda rows: judged(rows, labels).where("_kept"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    docs = judged(texts, read_table(spark, sf_dir, "labels"))
    return docs.select("doc_id", "lang", F.col("_perplexity").alias("perplexity"), F.col("_shrunk").alias("shrunk"),
                       F.col("_threshold").alias("threshold"), F.col("_kept").alias("kept"))
