"""Mixing sources to target weights.

Sources share the words of the whole corpus by weight. A source's target stops
at a number of epochs of its own words, and what is over is shared anew by
weight among the others: the fixed point min(cap, level * weight), found from
prefix sums over the sources sorted by cap / weight.

Within a source every document gets a hash-random key. Ranges of the key are
sorted and summed each for itself, prefix sums over the ranges place them, and
the budget is cut where the running sum reaches it: whole epochs first, then
the documents before the cut, and of the document on the cut the words that
are left, so a source's words are its target rounded to a whole number.

Rows of one key are summed before anything is sorted, so repeated rows meet in
no task. Those on a cut are told apart by their place in the written table.

Defined results: a null or empty text has size 0 and takes nothing; null
sources are one source, the last; a null doc_id is carried; repeated rows are
documents of their own; extra columns are carried by `mix_documents`, also
under names used here; an empty table gives no rows, and sources without a
word have target 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreflow.llm.common import broadcast_checked, written
from scoreflow.operators.prefix import prefix_sums

# Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = "mix"
# Documents of a source that one range of keys holds on average.
RANGE_ROWS = 1 << 12
# Sources are broadcast up to this many; more of them shuffle.
BROADCAST_SOURCES = 100_000
_GAPS = r"[\x20\x09-\x0D]++[^\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text, null as 0: a word starts the
    text or follows a gap."""
    first = F.when(F.substring(text, 1, 1).rlike(r"^[^\x20\x09-\x0D]"), 1).otherwise(0)
    return F.coalesce(F.regexp_count(text, F.lit(_GAPS)) + first, F.lit(0)).cast("bigint")


def mixing_key(doc_id: Column, source: Column, text: Column, seed: str = SEED) -> Column:
    """The random place of a row in its source: 128 bits as hex digits, a
    function of the row alone."""
    parts = [F.coalesce(c.cast("string"), F.lit("null")) for c in (doc_id, source, text)]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts).cast("binary"))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, share: float = 1.0
) -> DataFrame:
    """(source, n_docs, source_size, weight, target) from (source, size): one
    row per source. The targets share `share` of all words."""
    if not weights or min(weights) <= 0 or epochs < 1 or not 0 < share <= epochs:
        raise ValueError(f"no weights above 0, no epoch or more words than {epochs} epochs hold")
    found = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    found = written(found.withColumn("one", F.lit(1)), "sources")
    ranked = prefix_sums(found, [F.col("source").asc_nulls_last()], ["one"])
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("before_one") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "n_docs", "source_size", weight.alias("weight"), (epochs * F.col("source_size")).alias("cap"))
    ranked = written(ranked, "weights")
    filled = written(prefix_sums(ranked, [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()], ["cap", "weight"]), "levels")
    words, total = filled.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    # The level if all sources before this one are at their cap.
    level = (F.lit(words * share) - F.col("before_cap")) / (F.lit(total) - F.col("before_weight"))
    levels = filled.withColumn("level", level)
    # The first source that stays below its cap sets the level of all after it.
    under = levels.where(F.col("level") * F.col("weight") < F.col("cap"))
    low = under.agg(F.min(F.struct("before_weight", "level")).alias("m")).select("m.level").first()[0]
    fair = F.col("weight") * F.lit(float(low)) if low is not None else F.col("cap").cast("double")
    return levels.select("source", "n_docs", "source_size", "weight", F.least(F.col("cap").cast("double"), fair).alias("target"))


def _cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, epochs, cut_key, cut_left) of each source: whole epochs it
    takes, the key that its budget ends in and the words left for that key."""
    budget = F.round("target").cast("bigint")
    per = targets.withColumn("budget", budget).withColumn("epochs", F.expr("CASE WHEN source_size > 0 THEN budget div source_size ELSE 0L END"))
    per = per.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    # Ranges of the key's first 32 bits, as many as hold RANGE_ROWS each.
    per = written(per.withColumn("ranges", F.ceil(F.col("n_docs") / F.lit(RANGE_ROWS))), "budgets")
    ranges = per.select(F.col("source").alias("s"), "ranges")
    slot = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint") * F.col("ranges") / F.lit(1 << 32))
    dealt = sizes.join(broadcast_checked(ranges, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("s")))
    keys = dealt.select("source", slot.alias("slot"), "key", "size").groupBy("source", "slot", "key").agg(F.sum("size").alias("words"))
    keys = written(keys, "mix_keys")
    until = (Window.unboundedPreceding, -1)
    within = Window.partitionBy("source", "slot").orderBy("key").rowsBetween(*until)
    placed = keys.withColumn("before", F.coalesce(F.sum("words").over(within), F.lit(0)))
    # One row per range: their prefix sums move the ranges to their places.
    totals = keys.groupBy("source", "slot").agg(F.sum("words").alias("words"))
    earlier = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("slot").rowsBetween(*until)), F.lit(0))
    moves = totals.select(F.col("source").alias("s"), F.col("slot").alias("r"), earlier.alias("move"), F.col("words").alias("held"))
    rests = per.select(F.col("source").alias("t"), "rest")
    moves = moves.join(broadcast_checked(rests, BROADCAST_SOURCES), F.col("s").eqNullSafe(F.col("t")))
    # The budget ends in one range of a source, and there in one key.
    ending = moves.where("move < rest AND rest <= move + held")
    ends = placed.join(broadcast_checked(written(ending, "endings"), BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("s")) & (F.col("slot") == F.col("r")))
    left = F.col("rest") - F.col("move") - F.col("before")
    ends = ends.where((left > 0) & (left <= F.col("words"))).select(F.col("source").alias("s"), F.col("key").alias("cut_key"), left.alias("cut_left"))
    out = per.join(ends, F.col("source").eqNullSafe(F.col("s")), "left")
    return written(out.select("source", "epochs", "cut_key", "cut_left"), "cuts")


def mix_sizes(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, share: float = 1.0) -> DataFrame:
    """`sizes` (a written table with source, size, key and place) with
    source_size, target, epochs and taken: the words that the mix takes of each row."""
    targets = written(source_targets(sizes, weights, epochs, share), "targets")
    cuts = _cuts(sizes, targets)
    of = targets.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("of_source"), "source_size", "target", "epochs", "cut_key", "cut_left"
    )
    of = broadcast_checked(written(of, "mix"), BROADCAST_SOURCES)
    rows = sizes.join(of, F.col("source").eqNullSafe(F.col("of_source")), "left")
    whole = F.col("epochs") * F.col("size") + F.when(F.col("key") < F.col("cut_key"), F.col("size")).otherwise(0)
    on_cut = F.coalesce(F.col("key") == F.col("cut_key"), F.lit(False))
    # Copies on a cut: those of a partition are numbered there, and the
    # partitions' sums place them.
    edge = written(rows.where(on_cut).select("source", "place", "size", "cut_left"), "on_cut").withColumn("part", F.shiftright("place", 33))
    until = (Window.unboundedPreceding, -1)
    mine = F.coalesce(F.sum("size").over(Window.partitionBy("source", "part").orderBy("place").rowsBetween(*until)), F.lit(0))
    sums = edge.groupBy("source", "part").agg(F.sum("size").alias("held"))
    ahead = F.coalesce(F.sum("held").over(Window.partitionBy("source").orderBy("part").rowsBetween(*until)), F.lit(0))
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), ahead.alias("ahead"))
    edge = edge.withColumn("mine", mine).join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    some = F.greatest(F.lit(0), F.least(F.col("size"), F.col("cut_left") - F.col("mine") - F.col("ahead")))
    edge = edge.select(F.col("place").alias("edge_place"), some.alias("some"))
    edge = broadcast_checked(written(edge, "edges"), BROADCAST_SOURCES)
    out = rows.join(edge, F.col("place") == F.col("edge_place"), "left")
    taken = whole + F.coalesce("some", F.lit(0))
    return out.select(*sizes.columns, "source_size", "target", "epochs", taken.cast("bigint").alias("taken"))


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, key) of every row, written."""
    text = F.col("text")
    source = F.col("source").cast("string")
    key = mixing_key(F.col("doc_id"), source, text, seed)
    columns = [F.col("doc_id"), source.alias("source"), word_count(text).alias("size"), key.alias("key")]
    return written(docs.select(*columns, F.monotonically_increasing_id().alias("place")), "mix_sizes")


def mix_digest(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, share: float = 1.0) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row."""
    found = mix_sizes(sized(docs), weights, epochs, share)
    return found.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken", "source")


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, share: float = 1.0) -> DataFrame:
    """The mixed corpus: the rows of `docs`, each as often as the mix takes it,
    with `mix_epoch` (from 0) and `mix_words`, the leading words it takes of
    this repeat (all but for the row on the cut). Rows that take nothing go;
    columns of these two names are replaced."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("mix_epoch", "mix_words")])
    key = mixing_key(F.col("doc_id"), F.col("source").cast("string"), F.col("text"))
    sizes = docs.select(
        row.alias("row"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        key.alias("key"),
        F.monotonically_increasing_id().alias("place"),
    )
    found = mix_sizes(written(sizes, "mix_rows"), weights, epochs, share).where("taken > 0")
    repeats = F.sequence(F.lit(0), F.ceil(F.try_divide("taken", "size")).cast("int") - 1)
    found = found.select("row", "size", "taken", F.explode(repeats).alias("mix_epoch"))
    words = F.least(F.col("size"), F.col("taken") - F.col("mix_epoch") * F.col("size"))
    return found.select("row.*", "mix_epoch", words.alias("mix_words"))
