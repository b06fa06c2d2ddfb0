"""Kneser-Ney symbol trigrams of trusted text, counted and joined on Spark.

A symbol is a code point; digits count as one symbol and white space as
another (runs once). No symbol, language or count is cut: every language with
trusted text has its own interpolated modified Kneser-Ney model, whose lowest
order backs off to the model of all trusted text, and that one to an equal
share for each symbol. A language with little trusted text so leans on all of
it by what its own counts leave, and one with none equals it.

A trigram is one 63-bit number. Tasks count the distinct ones of their text;
counts, discounts, contexts and totals stay tables, spread by the hash of
(model, context). To score, documents are dealt to hash buckets; a bucket asks
once for each distinct trigram of a model, the distinct questions of all
buckets are joined to the orders of the model, and the answers meet the
bucket's documents again. Nothing of the model passes through the driver but
its number of symbols, and no task holds more of it than its bucket asked for.

Models are named by ``fold``: -1 counts all trusted text, f all but fold f.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.joins import materialized_broadcast
from .shared import buckets, landed

BITS = 21
MASK = (1 << BITS) - 1
UNICODE = 0x110000
ALL = -1  # the fold of the models that count all trusted text
PENDING = 2_000_000  # trigrams a task holds before it makes them distinct

_FOLDED = np.arange(UNICODE, dtype=np.int64)
_FOLDED[[c for c in range(UNICODE) if chr(c).isspace()]] = ord(" ")
_FOLDED[[c for c in range(UNICODE) if chr(c).isdigit()]] = ord("0")


def symbols(text: str) -> np.ndarray:
    """The symbols of a text after two leading spaces, runs of space once."""
    s = _FOLDED[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    space = s == ord(" ")
    run = ~space
    run[1:] |= ~space[:-1]
    return np.concatenate([np.full(2, ord(" ")), s[run]])


def trigrams(text: str | None) -> np.ndarray:
    s = symbols(text or "")
    return (s[:-2] << 2 * BITS) | (s[1:-1] << BITS) | s[2:]


def pool_name(fold: Column) -> Column:
    return fold.cast("string")


def model_name(fold: Column, lang: Column) -> Column:
    """The language's model, or the pooled one for a null language."""
    return F.when(lang.isNull(), pool_name(fold)).otherwise(F.concat(fold.cast("string"), F.lit(":"), lang))


def pool_of(model: Column) -> Column:
    """The name of the pooled model behind a model."""
    return F.substring_index(model, ":", 1)


def distinct_trigrams(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, code, n): the trigrams of ``rows``'s texts, added up by task."""
    kinds = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([T.StructField(k, kinds[k]) for k in keys]
                          + [T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, held = defaultdict(list), 0

        def drain() -> Iterator[pa.RecordBatch]:
            for key, parts in pending.items():
                code, n = np.unique(np.concatenate(parts), return_counts=True)
                same = [pa.array([k] * len(code), at.type) for k, at in zip(key, types)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(code), pa.array(n.astype(np.int64))],
                                                 [*keys, "code", "n"])
            pending.clear()

        for batch in batches:
            types = [batch.schema.field(k) for k in keys]
            for *key, text in zip(*(batch.column(k).to_pylist() for k in [*keys, "text"])):
                found = trigrams(text)
                if len(found):
                    pending[tuple(key)].append(found)
                    held += len(found)
            if held > PENDING:
                yield from drain()
                held = 0
        yield from drain()

    return rows.select(*keys, "text").mapInArrow(count, schema)


def trigram_counts(trusted: DataFrame, folds: int = 0) -> DataFrame:
    """(model, ab, b, c, n) of every model from ``trusted`` (lang, text, fold)."""
    rows = (distinct_trigrams(trusted, ["lang", "fold"]).groupBy("lang", "fold", "code")
            .agg(F.sum("n").alias("n")))
    of = F.filter(F.array(*(F.lit(f) for f in (ALL, *range(folds)))), lambda f: ~f.eqNullSafe(F.col("fold")))
    rows = rows.select("lang", "code", "n", F.explode(of).alias("fold"))
    names = F.array_distinct(F.array(pool_name(F.col("fold")), model_name(F.col("fold"), F.col("lang"))))
    rows = rows.select(F.explode(names).alias("model"), "code", "n").groupBy("model", "code").agg(F.sum("n").alias("n"))
    ab = F.shiftright("code", BITS)
    return rows.select("model", ab.alias("ab"), ab.bitwiseAND(F.lit(MASK)).alias("b"),
                       F.col("code").bitwiseAND(F.lit(MASK)).alias("c"), "n")


def level(counts: DataFrame, context: list[str]) -> tuple[DataFrame, DataFrame]:
    """One order of the model from its (continuation) counts ``n``.

    (model, context, c, p): the discounted share of each seen symbol, and
    (model, context, g): the mass each context leaves to the lower order."""
    of = [F.count(F.when(F.col("n") == k, 1)).alias(f"t{k}") for k in (1, 2, 3, 4)]
    types = counts.groupBy("model").agg(*of)
    y = F.when(F.col("t1") > 0, F.col("t1") / (F.col("t1") + 2 * F.col("t2"))).otherwise(0.5)

    def discount(k: int):
        d = k - (k + 1) * y * F.col(f"t{k + 1}") / F.col(f"t{k}")
        safe = F.when(F.col(f"t{k}") > 0, d).otherwise(F.lit(0.5 * k))
        return F.greatest(F.lit(0.05), F.least(safe, F.lit(k - 0.05)))

    types = materialized_broadcast(types.select("model", *(discount(k).alias(f"d{k}") for k in (1, 2, 3))))
    totals = counts.groupBy("model", *context).agg(
        F.sum("n").alias("total"), F.count(F.when(F.col("n") == 1, 1)).alias("s1"),
        F.count(F.when(F.col("n") == 2, 1)).alias("s2"), F.count(F.when(F.col("n") > 2, 1)).alias("s3"))
    totals = totals.join(types, "model")
    if not context:
        totals = materialized_broadcast(totals)
    left = F.col("d1") * F.col("s1") + F.col("d2") * F.col("s2") + F.col("d3") * F.col("s3")
    gaps = totals.select("model", *context, (left / F.col("total")).alias("g"))
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    shares = counts.join(totals, ["model", *context]).select(
        "model", *context, "c", ((F.col("n") - d) / F.col("total")).alias("p"))
    return shares, materialized_broadcast(gaps) if not context else gaps


class Model:
    """The orders of the models as tables, and their number of symbols."""

    def __init__(self, trusted: DataFrame, folds: int = 0):
        counts = landed(trigram_counts(trusted, folds), "quality-trigrams", "zstd")
        c2 = landed(counts.groupBy("model", "b", "c").agg(F.count("*").alias("n")), "quality-bigrams", "zstd")
        c1 = landed(c2.groupBy("model", "c").agg(F.count("*").alias("n")), "quality-symbols", "zstd")
        self.size = c1.where(F.col("model") == pool_name(F.lit(ALL))).count()
        self.orders = [([], *level(c1, [])), (["b"], *level(c2, ["b"])), (["ab"], *level(counts, ["ab"]))]

    def log_probabilities(self, asked: DataFrame) -> DataFrame:
        """``asked`` (model, code) with ``logp`` = log p(c | a b).

        Interpolation is linear in the share ``low`` that the lowest order
        backs off to, so a (model, trigram) has p = own + left * low."""
        ab = F.shiftright("code", BITS)
        q = (asked.select("model", "code").union(asked.select(pool_of(F.col("model")).alias("model"), "code")).distinct()
             .select("model", "code", ab.alias("ab"), ab.bitwiseAND(F.lit(MASK)).alias("b"),
                     F.col("code").bitwiseAND(F.lit(MASK)).alias("c"),
                     F.lit(0.0).alias("own"), F.lit(1.0).alias("left")))
        for context, shares, gaps in self.orders:
            q = q.join(gaps, ["model", *context], "left").join(shares, ["model", *context, "c"], "left")
            # a context never seen leaves all its mass to the lower order
            g = F.coalesce("g", F.lit(1.0))
            q = q.select("model", "code", "ab", "b", "c", (F.coalesce("p", F.lit(0.0)) + g * F.col("own")).alias("own"),
                         (g * F.col("left")).alias("left"))
        q = landed(q.select("model", "code", "own", "left"), "quality-orders", "zstd")
        low = q.where(F.col("model") == pool_of(F.col("model"))).select(
            F.col("model").alias("pool"), "code", (F.col("own") + F.col("left") / (self.size + 1)).alias("low"))
        p = F.when(F.col("model") == F.col("pool"), F.col("low")).otherwise(
            F.col("own") + F.col("left") * F.col("low"))
        return (asked.join(q, ["model", "code"]).withColumn("pool", pool_of(F.col("model"))).join(low, ["pool", "code"])
                .select("model", "code", F.log(p).cast("float").alias("logp")))


def with_perplexity(docs: DataFrame, model: Model, fold: Column | None = None) -> DataFrame:
    """``docs`` with ``_n`` and ``_logs``: the number of symbols of each text
    and their mean negative log-probability (null: none), under the models of
    ``fold`` (all trusted text if not given)."""
    fold = F.lit(ALL) if fold is None else fold
    if not model.size:
        return docs.withColumns({"_n": F.lit(0).cast("long"), "_logs": F.lit(None).cast("double")})
    n = buckets(docs.sparkSession)
    keyed = docs.withColumns({
        "_model": model_name(fold, F.col("lang")),
        "_bucket": F.pmod(F.xxhash64("doc_id", "lang", "text"), F.lit(n)).cast("int")})
    # a question names its model alone; the pool behind it is in the name
    asked = distinct_trigrams(keyed.select(F.col("_bucket").alias("bucket"), F.col("_model").alias("model"), "text"),
                              ["bucket", "model"])
    asked = landed(asked.select("bucket", "model", "code").distinct(), "quality-asked", "zstd")
    answers = asked.join(model.log_probabilities(asked.select("model", "code").distinct()),
                         ["model", "code"]).select(F.col("bucket").alias("_bucket"), "model", "code", "logp")
    schema = T.StructType([*docs.schema.fields, T.StructField("_n", T.LongType()), T.StructField("_logs", T.DoubleType())])
    columns = docs.columns

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {name: (part["code"].to_numpy(), part["logp"].to_numpy().astype(np.float64)) for name, part in
                 pd.DataFrame({k: right[k].to_pandas() for k in ("model", "code", "logp")})
                 .sort_values("code").groupby("model")}
        sizes, logs = [], []
        for name, text in zip(left["_model"].to_pylist(), left["text"].to_pylist()):
            at = trigrams(text)
            sizes.append(len(at))
            if len(at):
                code, logp = found[name]
                logs.append(-float(logp[np.searchsorted(code, at)].mean()))
            else:
                logs.append(None)
        return (left.select(columns).append_column("_n", pa.array(sizes, pa.int64()))
                .append_column("_logs", pa.array(logs, pa.float64())))

    return keyed.groupBy("_bucket").cogroup(answers.groupBy("_bucket")).applyInArrow(score, schema)
