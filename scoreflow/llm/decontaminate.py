"""Benchmark decontamination: a prefix-filtered set join.

Native. A window is `window` consecutive words of an item (a shorter item is
one window). Its set is its word shingles. Pass one finds the documents'
occurrences of any benchmark shingle and counts them over all documents. In
containment every shingle of a window must occur, so the prefix a window needs
is one shingle: its rarest in the corpus. Only occurrences of prefix shingles
become candidates; the shingle's place in the window gives the start, and the
positional and length bounds drop starts outside the text. What is left is
verified word for word against the document's own words.

The shingle test is a hash join on 64-bit hashes; equality is decided by the
final word comparison, so a hash collision costs time, never a wrong hit.

Defined results: a null text or item text has no words; a benchmark row with a
null item_id is ignored; several rows with one item_id count as one item;
repeated document rows each get their row; an empty benchmark leaves every
document clean; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreflow.llm.common import (
    NON_WORDS,
    ascii_lower,
    broadcast_checked,
    broadcast_weighed,
    row_key,
    split_words,
    text_or_empty,
    written,
)

WINDOW = 10
SHINGLE = 5
# A benchmark side of at most so many rows is broadcast; beyond it the same joins shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def _words(text: Column) -> Column:
    return split_words(ascii_lower(text), NON_WORDS)


def _shingle_hashes(words: Column, n: Column, size: int) -> Column:
    """Hash of the shingle that starts at each place of `words` (n >= size)."""
    return F.transform(
        F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)])
    )


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """Distinct windows: `win` (its words), `n`, `item_ids`, `wid`."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), _words(text_or_empty()).alias("words")
    )
    items = items.where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    each = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("words", s + 1, window))).alias("win"))
    grouped = each.groupBy("win").agg(F.collect_set("item_id").alias("item_ids"))
    return grouped.select("win", F.size("win").alias("n"), "item_ids", F.xxhash64("win").alias("wid"))


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(win, wid, n, size, offset, h) for every shingle of every window."""
    size = F.least(F.lit(shingle), F.col("n"))
    out = None
    for k in range(1, shingle + 1):
        own = windows.where(size == k).select(
            "win", "wid", "n", F.lit(k).alias("size"),
            F.posexplode(_shingle_hashes(F.col("win"), F.col("n"), k)).alias("offset", "h"),
        )
        out = own if out is None else out.unionByName(own)
    return out


def _occurrences(docs: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """(k1, k2, n_words, size, at, h) of every benchmark shingle in a document."""
    rows = docs.select(*row_key(), _words(F.col("text")).alias("words"))
    known = broadcast_checked(shingles.select("size", "h").distinct(), BROADCAST_ROWS)
    out = None
    for k in sizes:
        hashes = F.when(F.size("words") >= k, _shingle_hashes(F.col("words"), F.size("words"), k))
        own = rows.select("k1", "k2", F.size("words").alias("n_words"), F.lit(k).alias("size"), hashes.alias("hashes"))
        # Outer: a plain explode would have its emptiness test pushed below the
        # projections, where it splits the text again for every word. The join drops the nulls.
        own = own.select("k1", "k2", "n_words", "size", F.posexplode_outer("hashes").alias("at", "h"))
        own = own.join(known.where(F.col("size") == k), ["size", "h"], "left_semi")
        out = own if out is None else out.unionByName(own)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside occurrences
    of windows) and item_ids (of the windows that occur, sorted as strings)."""
    return _contamination(docs, benchmark, window, shingle).drop("k1", "k2")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The documents, all columns, without those that hold a benchmark window."""
    hit = _contamination(docs, benchmark, window, shingle).where("n_hit > 0").select("k1", "k2").distinct()
    hit = written(hit, "contaminated")
    row = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), *row_key(text=text_or_empty()))
    return row.join(broadcast_checked(hit, BROADCAST_ROWS), ["k1", "k2"], "left_anti").select("row.*")


def _contamination(docs: DataFrame, benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    windows = written(benchmark_windows(benchmark, window), "benchmark_windows")
    shingles = written(_window_shingles(windows, shingle), "benchmark_shingles")
    sizes = sorted(r[0] for r in shingles.select("size").distinct().collect())  # at most `shingle` numbers
    if not sizes:
        return rows.select(
            "doc_id",
            *row_key(),
            F.size(_words(F.col("text"))).cast("long").alias("n_words"),
            F.lit(0).cast("long").alias("n_hit"),
            F.array().cast("array<string>").alias("item_ids"),
        )
    seen = written(_occurrences(rows, shingles, sizes), "benchmark_shingle_hits")
    counts = seen.groupBy("size", "h").agg(F.count(F.lit(1)).alias("rarity"))
    prefix = (
        shingles.join(counts, ["size", "h"], "left")
        .groupBy("win", "wid", "n", "size")
        .agg(F.min(F.struct(F.coalesce("rarity", F.lit(0)).alias("rarity"), "offset", "h")).alias("p"))
        .where(F.col("p.rarity") > 0)  # a shingle that occurs nowhere: neither does the window
        .select("win", "n", "size", F.col("p.offset").alias("offset"), F.col("p.h").alias("h"))
        .join(windows.select("win", "item_ids"), "win")
    )
    prefix = written(prefix, "benchmark_prefixes")
    bytes_of = 40 + F.length(F.array_join("win", " ")) + F.aggregate("item_ids", F.lit(0), lambda n, i: n + 8 + F.length(i))
    start = F.col("at") - F.col("offset")
    candidates = (
        seen.join(broadcast_weighed(prefix, bytes_of, BROADCAST_BYTES), ["size", "h"])
        .where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
        .groupBy("k1", "k2")
        .agg(F.array_sort(F.collect_set(F.struct(start.alias("start"), "n", "win", "item_ids"))).alias("candidates"))
    )
    none = F.array().cast(candidates.schema["candidates"].dataType)
    # The text crosses the join, not its words: it is smaller and split only once after it.
    keyed = rows.select("doc_id", *row_key(), "text").join(candidates, ["k1", "k2"], "left")
    out = keyed.select("doc_id", "k1", "k2", "candidates", _words(F.col("text")).alias("words")).select(
        "doc_id",
        "k1",
        "k2",
        F.size("words").cast("long").alias("n_words"),
        F.filter(
            F.coalesce("candidates", none), lambda c: F.slice("words", c["start"] + 1, c["n"]) == c["win"]
        ).alias("hits"),
    )
    hit = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")),
        lambda acc, c: F.struct(
            F.greatest(acc["to"], c["start"] + c["n"]).alias("to"),
            (acc["n"] + F.greatest(F.lit(0), c["start"] + c["n"] - F.greatest(acc["to"], c["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda c: c["item_ids"]))))
    return out.select("doc_id", "k1", "k2", "n_words", hit.cast("long").alias("n_hit"), ids.alias("item_ids"))


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    c = contamination(docs, benchmark)
    return c.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
