"""Document fingerprints from closed syncmers over words.

Of all runs of ``k`` words those are chosen whose smallest inner run of ``s``
words, by hash, is the first or the last one. The choice depends on nothing
outside the run, so equal passages get the same anchors wherever they stand, and
two documents are compared by matching anchors at the places that one common
shift maps to each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import WORD

#: Words of a run and of its inner runs: closed syncmers are about 2 of (k - s + 1) runs, here half.
K, S = 5, 2
#: How far a matched anchor may lie from the common shift: so many anchors, and this share of the mean number of both.
DRIFT, DRIFT_SHARE = 4, 0.05
#: Ranges of doc_ids per shuffle partition, for the sort by doc_id.
RANGES_PER_PARTITION = 4
#: Bounds of ranges that one group of the two-step search holds.
STEP = 32


def with_anchors(df: DataFrame, text: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """Add ``name``: the 32-bit hashes of the text's closed syncmers, in the order of the text.

    A text whose words hold no closed syncmer, as of fewer than ``k`` words, has one
    anchor, the hash of all of them; one without words, or null, has none.
    """
    words, inner, found = f"_{name}_words", f"_{name}_inner", f"_{name}_found"
    count, runs = F.size(words), k - s + 1
    # named columns that are used several times are computed once and not folded into what uses them
    hashed = df.withColumn(
        words,
        F.transform(
            F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)
        ),
    )
    usable = F.greatest(count - s + 1, F.lit(0))
    steps = F.arrays_zip(*[F.slice(words, i + 1, usable).alias(f"w{i}") for i in range(s)])
    hashes = F.transform(steps, lambda w: F.xxhash64(*[w[f"w{i}"] for i in range(s)])) if s > 1 else F.col(words)
    summed = hashed.withColumn(inner, F.when(count >= k, hashes))
    whole_runs = F.greatest(count - k + 1, F.lit(0))
    shifted = F.arrays_zip(*[F.slice(inner, i + 1, whole_runs).alias(f"r{i}") for i in range(runs)])

    def closed(run: Column) -> Column:
        smallest = F.least(*[run[f"r{i}"] for i in range(runs)])
        return (run["r0"] == smallest) | (run[f"r{runs - 1}"] == smallest)

    def anchor(run: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*[run[f"r{i}"] for i in range(runs)]), 32)

    chosen = summed.withColumn(found, F.when(count >= k, F.transform(F.filter(shifted, closed), anchor)))
    whole = F.array(F.shiftrightunsigned(F.xxhash64(F.col(words)), 32))
    few = F.when(count > 0, whole).otherwise(F.array().cast("array<long>"))
    return chosen.withColumn(name, F.when(F.size(found) > 0, F.col(found)).otherwise(few)).drop(words, inner, found)


def as_text(anchors: str) -> Column:
    """The fingerprint: eight hex digits for each anchor, joined."""
    return F.array_join(F.transform(anchors, lambda a: F.lower(F.lpad(F.hex(a), 8, "0"))), "")


def _sorted_places(a: str, b: str) -> Column:
    """All anchors of both, each as one number: anchor, place among its document's anchors, and document (0 or 1), sorted."""

    def places(anchors: str, side: int) -> Column:
        return F.transform(anchors, lambda x, i: F.shiftleft(x, 31) + F.shiftleft(i.cast("long"), 1) + F.lit(side))

    return F.sort_array(F.concat(places(a, 0), places(b, 1)))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Add ``name``: twice the anchors of ``a`` and ``b`` that match by position over all anchors of both, 0 to 1.

    Occurrences of an anchor in both documents that follow each other by place are
    paired, each at most once. The middle one of all pairs' shifts (place in ``b`` less place in
    ``a``) is the common shift, and the pairs that lie within the drift of it
    match. So a passage put in front, or a few words more or less, cost little, while
    moved or further repeated passages do not count. Equal lists of anchors give 1, also two without any.
    """
    sorted_, pairs, shifts = f"_{name}_sorted", f"_{name}_pairs", f"_{name}_shifts"
    last = F.lit((1 << 30) - 1)

    def place(x: Column) -> Column:
        return F.shiftright(x, 1).bitwiseAND(last)

    placed = df.withColumn(sorted_, _sorted_places(a, b))
    rest = F.greatest(F.size(sorted_) - 1, F.lit(0))
    neighbours = F.arrays_zip(F.slice(sorted_, F.lit(1), rest).alias("x"), F.slice(sorted_, F.lit(2), rest).alias("y"))
    # the same anchor, in two documents
    met = placed.withColumn(
        pairs,
        F.filter(neighbours, lambda n: (F.shiftright(n["x"], 31) == F.shiftright(n["y"], 31)) & (n["x"].bitwiseXOR(n["y"]).bitwiseAND(F.lit(1)) == 1)),
    )

    def from_side(side: int) -> Column:
        forward = F.filter(pairs, lambda n: n["x"].bitwiseAND(F.lit(1)) == side)
        sign = F.lit(1 - 2 * side)
        return F.sort_array(F.transform(forward, lambda n: sign * (place(n["y"]) - place(n["x"]))))

    # pairs that begin in the same document hold no occurrence twice
    both = met.withColumn(shifts + "0", from_side(0)).withColumn(shifts + "1", from_side(1))
    chosen = both.withColumn(
        shifts, F.when(F.size(shifts + "0") >= F.size(shifts + "1"), F.col(shifts + "0")).otherwise(F.col(shifts + "1"))
    )
    total = F.size(a) + F.size(b)
    middle = F.get(shifts, F.floor(F.size(shifts) / 2).cast("int"))
    drift = DRIFT + F.lit(DRIFT_SHARE / 2) * total
    matched = F.size(F.filter(shifts, lambda d: F.abs(d - middle) <= drift))
    value = F.when(total > 0, F.lit(2.0) * matched / total).otherwise(F.lit(1.0))
    return chosen.withColumn(name, value).drop(sorted_, pairs, shifts, shifts + "0", shifts + "1")


def anchor_positions(docs: DataFrame) -> DataFrame:
    """(doc_id, position, anchor): one row per anchor, to match passages of documents by position."""
    found = with_anchors(docs.select("doc_id", "text"), "text", "anchors")
    return found.select("doc_id", F.posexplode("anchors").alias("position", "anchor"))


def _range_of(value: str, bounds: list[int]) -> Column:
    """How many bounds lie below the value, found in two steps."""
    if not bounds:
        return F.lit(0)
    coarse, listed = F.lit(bounds[::STEP]), F.lit(bounds)
    step = F.size(F.filter(coarse, lambda b: b < F.col(value)))
    first = F.greatest(step - 1, F.lit(0)) * STEP
    inside = F.slice(listed, first + 1, F.lit(STEP))
    return F.coalesce(first + F.size(F.filter(inside, lambda b: b < F.col(value))), F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text, ...) with the text that follows by doc_id; the first one follows the last.

    Documents are dealt to ranges of doc_id, and a window looks ahead inside each
    range. A copy of the first document of every range is put at the end of the
    range before it, so no document needs to see two ranges. The table's windows
    over all ranges have one row per range.
    """
    spark = docs.sparkSession
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / ranges for i in range(1, ranges)]
    found = docs.select(F.percentile_approx("doc_id", cuts, 10 * ranges)).first()[0]
    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "_range", _range_of("doc_id", sorted(set(found or [])))
    )
    by_range = Window.partitionBy().orderBy("_range")
    smallest = dealt.groupBy("_range").agg(F.min("doc_id").alias("_first"), F.max(F.col("doc_id").isNull()).alias("_null"))
    before = F.coalesce(F.lag("_range").over(by_range), F.max("_range").over(Window.partitionBy()))
    smallest = smallest.select(
        "_range", F.when(~F.col("_null"), F.col("_first")).alias("_first"), before.alias("_before")
    )
    # one row per range: its number is bounded by the setting above
    firsts = dealt.join(
        F.broadcast(smallest), (dealt["_range"] == smallest["_range"]) & dealt["doc_id"].eqNullSafe(smallest["_first"])
    ).groupBy("_before").agg(F.min(F.struct(dealt["doc_id"], dealt["text"])).alias("d"))
    copies = firsts.select("d.doc_id", "d.text", F.col("_before").alias("_range"), F.lit(1).alias("_copy"))
    both = dealt.withColumn("_copy", F.lit(0)).unionByName(copies)
    return both.withColumn("next_text", F.lead("text").over(_in_range()))


def _in_range():
    return Window.partitionBy("_range").orderBy("_copy", "doc_id", "text")


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next). The edited text has its last half replaced by as much of the
    beginning of the next document. A null text counts as empty. Null doc_ids come
    first; rows with equal doc_ids follow each other by text. A single document is
    its own next one. Empty table: no rows. doc_id has to be a whole number and,
    for even tasks, mostly distinct: equal doc_ids are sorted in one task.
    """
    marked = with_anchors(with_next(docs), "text", "anchors")
    marked = marked.withColumn("next_anchors", F.lead("anchors").over(_in_range())).where("_copy = 0")
    half = F.floor(F.length("text") / 2).cast("int")
    kept = F.col("text").substr(F.lit(1), F.length("text") - half)
    edited = marked.withColumn("edited", F.concat(kept, F.col("next_text").substr(F.lit(1), half)))
    edited = with_anchors(edited, "edited", "edited_anchors")
    edited = with_likeness(edited, "anchors", "edited_anchors", "near_edited")
    edited = with_likeness(edited, "anchors", "next_anchors", "near_next")
    return edited.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("anchors").alias("fingerprint"),
        as_text("edited_anchors").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
