"""Mixing sources to target weights by hash order, prefix sums and exact budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import numbered, running_total, unused, word_count

#: Weights of the sources in code-point order, repeating; and how often a source may be read at most.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Hex digits of the random key that name a range of a source: 3 give 4,096 ranges to sort on their own.
RANGE_DIGITS = 3


def _weight(index: Column, weights: Sequence[int]) -> Column:
    listed = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    return F.get(listed, (index % len(weights)).cast("int"))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source key: ``source_size``, ``target`` and the whole-word ``budget``.

    Takes rows of (source_key, size). All sizes together are shared out by
    weight. A source stops at ``max_epochs`` times its size and the rest is
    shared again among the others; in order of cap over weight, the stopped
    sources are the first ones whose cap lies within their share of what is
    left. The windows run over one row per source.
    """
    totals = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy("source_key")
    everything = Window.partitionBy()
    weighed = totals.select(
        "source_key",
        "source_size",
        _weight(F.row_number().over(by_name) - 1, weights).alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"),
        F.sum("source_size").over(everything).alias("all"),
    )
    tightest = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    after = tightest.rowsBetween(0, Window.unboundedFollowing)
    capped = weighed.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("caps_before"),
        F.sum("weight").over(after).alias("weights_left"),
    ).withColumn(
        "full", F.col("cap") * F.col("weights_left") <= F.col("weight") * (F.col("all") - F.col("caps_before"))
    )
    shared = capped.select(
        "*",
        F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything).alias("caps"),
        F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(everything).alias("weights"),
    )
    share = (F.col("weight") * (F.col("all") - F.col("caps"))).cast("double") / F.col("weights").cast("double")
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share)
    return shared.select("source_key", "source_size", target.alias("target"), F.floor(target).alias("budget"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = "mix-",
    range_digits: int = RANGE_DIGITS,
) -> DataFrame:
    """Decide how many words of each document the mix takes.

    Adds ``size`` (words, null text: 0), ``source_size``, ``target``, ``budget``
    and ``taken`` to all rows of ``docs`` (columns doc_id, text, source; further
    ones stay, but the five names are overwritten). Each source is read in
    the order of a hash of doc_id, whole as often as its budget allows; of the
    last round it gives the documents before the cut, and of the document at the
    cut the words that fit, so that ``taken`` adds up to the budget exactly.

    Null source: a source of its own, last. Null doc_id: hashed as a text of its
    own. Repeated rows count each; equal rows may swap places, which changes no
    row's values as a set. Empty texts take nothing. Empty table: no rows.
    """
    docs = docs.drop("size", "source_size", "target", "budget", "taken")
    inside, own_columns = numbered(docs)
    doc_id, text, source = (F.col(inside.columns[docs.columns.index(c)]) for c in ("doc_id", "text", "source"))
    key = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    sized = inside.select(
        "*",
        word_count(text).alias("size"),
        F.coalesce(F.concat(F.lit("a"), source), F.lit("b")).alias("source_key"),
        key.alias("_key"),
        F.substring(key, 1, range_digits).alias("_range"),
    )
    targets = source_targets(sized.select("source_key", "size"), weights, max_epochs)
    order = [F.col("_key"), doc_id, F.col("size")]
    placed = running_total(sized, ["source_key"], "_range", order, F.col("size"), "_before").join(targets, "source_key")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - epochs * F.col("source_size") - F.col("_before")))
    taken = (epochs * F.col("size") + rest).cast("long").alias("taken")
    return placed.select(*own_columns, "size", "source_size", "target", "budget", taken)


def repeat_taken(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mixed rows themselves: one row per time that a document is read.

    Whole readings carry the whole text. Only the one document at a source's cut
    has a reading that stops early, after the words that the budget still holds.
    """
    number = unused("_round", mixed.columns)
    rounds = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    left = F.col("taken") - (F.col(number) - 1) * F.col("size")
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    part = F.array_join(F.slice(words, 1, F.greatest(left, F.lit(0)).cast("int")), "")
    text = F.when(left < F.col("size"), part).otherwise(F.col("text"))
    read = mixed.where((F.col("taken") > 0) & (F.col("size") > 0)).withColumn(number, F.explode(rounds))
    return read.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in columns])


#: The same rows in DuckDB's SQL.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, coalesce('a' || source, 'b') AS source_key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents
), totals AS (
  SELECT source_key, sum(size)::BIGINT AS source_size FROM sized GROUP BY source_key
), weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source_key) - 1) % 3 + 1)::INT] AS weight,
         source_size * 3 AS cap, sum(source_size) OVER () AS everything
  FROM totals
), capped AS (
  SELECT *, cap * sum(weight) OVER (ORDER BY cap / weight, source_key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
       <= weight * (everything - coalesce(sum(cap) OVER (ORDER BY cap / weight, source_key
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
  FROM weighed
), shared AS (
  SELECT *, coalesce(sum(cap) FILTER (WHERE is_full) OVER (), 0) AS caps,
         coalesce(sum(weight) FILTER (WHERE NOT is_full) OVER (), 0) AS weights
  FROM capped
), targets AS (
  SELECT source_key, source_size,
         CASE WHEN is_full THEN cap::DOUBLE
              ELSE (weight * (everything - caps))::DOUBLE / weights::DOUBLE END AS target
  FROM shared
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source_key ORDER BY s.key, s.doc_id NULLS FIRST, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier
  FROM sized s JOIN targets t USING (source_key)
), epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - earlier)))::BIGINT AS taken
FROM epochs
"""
