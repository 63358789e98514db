"""Substring dedup by repeated-phrase automata.

A word is removed if a window of `window` words around it starts earlier too
(in a smaller document, or further up in the same one). Five steps:

1. Whole copies. Rows whose text stands in a smaller document need no search:
   all their windows start earlier.
2. Anchors. In every window the shingle with the smallest hash is its anchor,
   so equal windows have equal anchors and about one word in eight starts one.
   Anchors are counted over all documents with partial sums.
3. Recurring passages. Windows around recurring anchors are hashed and grouped;
   those found twice or more keep their first place. Runs of such places are
   the passages, every recurring window standing in exactly one of them.
4. Automata. Passages are dealt to shards of bounded size. A passage is entered
   into its shard's Aho-Corasick automaton by the aligned blocks of half a
   window, one of which lies in every window. A document streams through the
   automata of those shards that hold a passage of its windows; the documents
   of a shard are dealt to as many tasks as their number asks for, so a passage
   that a third of all documents share costs many small tasks. Each block found
   is extended word by word, which both verifies and delimits the occurrence.
5. Removal. Occurrences other than first places become spans per document.

Hashes only choose what to compare: words are compared in step 4. (A window is
grouped under 96 bits.)

Defined results: a null text has no words; a null doc_id orders after all
others; rows that share a doc_id count as one document, whose places compare by
their start in each row's own text (such rows are told apart by `sub`, a hash
of their text, so that no group is more than one text); texts of fewer than `window` words lose
nothing; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.llm.common import broadcast_checked, broadcast_weighed, text_or_empty, written
from scoreflow.llm.hashing import U, batch_words, inside, mix, slices, window_hashes
from scoreflow.operators.joins import join_hot_split

WINDOW = 20
ANCHOR = 6
# Words of passages in one shard, and documents of one task of a shard.
SHARD_WORDS = 200_000
TASK_DOCUMENTS = 1_000
# Sides of at most so many rows, or about so many bytes where rows vary in size,
# are broadcast to the texts; larger ones shuffle with them.
BROADCAST_ROWS = 300_000
BROADCAST_BYTES = 16 << 20
NO_ID = (1 << 63) - 1


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best(x[i : i + width]) for each i, in log2(width) passes."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = best(x[: len(x) - step], x[step:])
        have += step
    return x


def anchor_places(hashes: np.ndarray, whole: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the smallest hash of a window: `whole[i]` tells whether
    the window whose anchors start at i..i+width-1 lies in one text."""
    if len(hashes) < width or not whole.any():
        return np.zeros(0, dtype=np.int64)
    least = _sliding(hashes, width, np.minimum)
    least = np.where(whole[: len(least)], least, U(0))
    padded = np.concatenate([np.zeros(width - 1, dtype=U), least, np.zeros(width - 1, dtype=U)])
    reach = _sliding(padded, width, np.maximum)
    return np.flatnonzero((reach == hashes) & (hashes > 0))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, ord, sub, at) of every anchor."""
    width = WINDOW - ANCHOR + 1
    for batch in batches:
        for part in slices(batch):
            w = batch_words(part.column("text"))
            h = window_hashes(w.hashes, ANCHOR)
            whole = inside(w.first, WINDOW, max(0, len(w.hashes) - WINDOW + 1))
            at = anchor_places(h, whole, width)
            document = w.document[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h[at].view(np.int64)),
                    *[pa.array(np.asarray(part.column(c))[document]) for c in ("ord", "sub")],
                    pa.array((at - w.first[document]).astype(np.int32)),
                ],
                names=["h", "ord", "sub", "at"],
            )


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ord, sub, stretches): first and last start of the windows around the
    anchors at `places`, touching ones joined."""
    width = WINDOW - ANCHOR + 1
    for batch in batches:
        out = []
        for places in batch.column("places"):
            p = np.unique(np.asarray(places.values))
            cut = np.flatnonzero(np.diff(p) > width) + 1
            low = np.maximum(p[np.append(0, cut)] - width + 1, 0)
            out.append(np.stack([low, p[np.append(cut, len(p)) - 1]], axis=1).ravel())
        yield pa.RecordBatch.from_arrays(
            [batch.column("ord"), batch.column("sub"), pa.array(out, pa.list_(pa.int32()))], names=["ord", "sub", "stretches"]
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w1, w2, ord, sub, start) of every window that starts in `stretches`."""
    for batch in batches:
        for part in slices(batch):
            w = batch_words(part.column("text"))
            n = len(w.hashes) - WINDOW + 1
            if n <= 0:
                continue
            stretches = part.column("stretches")
            counts = np.diff(np.asarray(stretches.offsets)) // 2
            values = np.asarray(stretches.flatten()).astype(np.int64).reshape(-1, 2)
            owner = np.repeat(np.arange(part.num_rows), counts)
            last = np.minimum(values[:, 1], np.diff(w.first)[owner] - WINDOW)
            keep = values[:, 0] <= last
            owner, begin, last = owner[keep], values[keep, 0], last[keep]
            begin, end = w.first[owner] + begin, w.first[owner] + last + 1
            marks = np.zeros(len(w.hashes) + 1, dtype=np.int64)
            np.add.at(marks, begin, 1)
            np.add.at(marks, end, -1)
            start = np.flatnonzero(np.cumsum(marks)[:n] > 0)
            h1 = window_hashes(w.hashes, WINDOW)[start]
            h2 = window_hashes(mix(w.hashes + U(0x5A)), WINDOW)[start]
            document = w.document[start]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h1.view(np.int64)),
                    pa.array((h2 & U(0xFFFFFFFF)).astype(np.uint32).view(np.int32)),
                    *[pa.array(np.asarray(part.column(c))[document]) for c in ("ord", "sub")],
                    pa.array((start - w.first[document]).astype(np.int32)),
                ],
                names=["w1", "w2", "ord", "sub", "start"],
            )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ord, sub, runs): start and number of windows of each run of places in
    `starts`."""
    for batch in batches:
        runs = []
        for starts in batch.column("starts"):
            s = np.sort(np.asarray(starts.values).astype(np.int64))
            cut = np.flatnonzero(np.diff(s) != 1) + 1
            begin, end = np.append(0, cut), np.append(cut, len(s))
            runs.append(np.stack([s[begin], end - begin], axis=1).ravel().astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("ord"), batch.column("sub"), pa.array(runs, pa.list_(pa.int32()))], names=["ord", "sub", "runs"]
        )


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ord, start, n, words) of each run."""
    for batch in batches:
        out = ([], [], [], [])
        for order, text, runs in zip(*(batch.column(c).to_pylist() for c in ("ord", "text", "runs"))):
            words = text.encode().split()
            for start, n in zip(runs[::2], runs[1::2]):
                passage = words[start : start + n + WINDOW - 1]
                out[0].append(order)
                out[1].append(start)
                out[2].append(len(passage))
                out[3].append(b" ".join(passage).decode())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.string())],
            names=["ord", "start", "n", "words"],
        )


class PhraseAutomaton:
    """Finds every stretch of at least a window that a text shares with a passage."""

    def __init__(self, passages: list[tuple[int, int, list[str]]], window: int = WINDOW):
        self.passages, self.window, self.block = passages, window, window // 2
        blocks: dict[str, list[tuple[int, int]]] = {}
        for p, (_, _, words) in enumerate(passages):
            for at in range(0, len(words) - self.block + 1, self.block):
                blocks.setdefault(f" {' '.join(words[at : at + self.block])} ", []).append((p, at))
        self.automaton = ahocorasick.Automaton()
        for key, places in blocks.items():
            self.automaton.add_word(key, places)
        if blocks:
            self.automaton.make_automaton()
        self.empty = not blocks

    def occurrences(self, words: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(passage, its word, text's word, length) of each maximal shared stretch."""
        if self.empty or len(words) < self.window:
            return
        text = f" {' '.join(words)} "
        # Offset after the space that ends each word.
        ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words)))
        done: dict[tuple[int, int], int] = {}
        n = len(words)
        for end, places in self.automaton.iter(text):
            i = int(np.searchsorted(ends, end)) + 1 - self.block
            for p, at in places:
                if done.get((p, i - at), -1) > i:
                    continue
                theirs = self.passages[p][2]
                low = 0
                while low < at and low < i and words[i - low - 1] == theirs[at - low - 1]:
                    low += 1
                high, most = self.block, min(n - i, len(theirs) - at)
                while high < most and words[i + high] == theirs[at + high]:
                    high += 1
                done[(p, i - at)] = i + high
                if low + high >= self.window:
                    yield p, at - low, i - low, low + high


def _locate(key, documents: pa.Table, passages: pa.Table) -> pa.Table:
    """(ord, tk, spans): what one task's documents share with a shard's passages
    beyond the passages' own first places."""
    entries = [
        (o, s, text.split(" "))
        for o, s, text in zip(*(passages.column(c).to_pylist() for c in ("ord", "start", "words")))
    ]
    out = ([], [], [])
    automaton = PhraseAutomaton(entries)
    for row in range(documents.num_rows):
        order, tk = documents.column("ord")[row].as_py(), documents.column("tk")[row].as_py()
        words = [w.decode() for w in documents.column("text")[row].as_py().encode().split()]
        spans = [
            (start, start + n)
            for p, at, start, n in automaton.occurrences(words)
            if not (entries[p][0] == order and entries[p][1] + at == start)
        ]
        if spans:
            out[0].append(order)
            out[1].append(tk)
            out[2].append([x for span in _merged(spans) for x in span])
    return pa.table(
        {"ord": pa.array(out[0], pa.int64()), "tk": pa.array(out[1], pa.int64()), "spans": pa.array(out[2], pa.list_(pa.int32()))}
    )


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [tuple(x) for x in out]


REMOVED = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


def _remove(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                totals, removed, digests, texts = [], [], [], []
                for text, whole, spans in zip(*(part.column(c).to_pylist() for c in ("text", "whole", "spans"))):
                    words = text.encode().split()
                    if whole and len(words) >= WINDOW:
                        kept = []
                    elif spans:
                        kept, at = [], 0
                        flat = [x for s in spans for x in s]
                        for begin, end in _merged(list(zip(flat[::2], flat[1::2]))):
                            kept += words[at:begin]
                            at = end
                        kept += words[at:]
                    else:
                        kept = words
                    joined = b" ".join(kept)
                    totals.append(len(words))
                    removed.append(len(words) - len(kept))
                    digests.append(hashlib.sha256(joined).hexdigest())
                    texts.append(joined.decode() if keep_text else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(totals, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.array(texts, pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
                )

    return run


def _copies(rows: DataFrame) -> DataFrame:
    """(ord, tk) of rows whose whole text stands in a smaller document."""
    prints = rows.select("ord", "tk", F.hash("text").alias("t2"), F.length("text").alias("t3"))
    first = prints.groupBy("tk", "t2", "t3").agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
    first = first.where("first < last").select("tk", "t2", "t3", "first")
    found = prints.join(first, ["tk", "t2", "t3"]).where("ord > first")
    return written(found.select("ord", "tk").distinct(), "phrase_copies")


def _told_apart(rows: DataFrame) -> DataFrame:
    """`rows` with `sub`: 0 for an ord of one row, else a hash of the text; of
    equal rows one stays."""
    shared = written(rows.groupBy("ord").count().where("count > 1").select("ord"), "phrase_shared")
    if shared.isEmpty():
        return rows.withColumn("sub", F.lit(0).cast("bigint"))
    beside = broadcast_checked(shared.withColumn("shared", F.lit(True)), BROADCAST_ROWS)
    marked = rows.join(beside, "ord", "left")
    alone = marked.where("shared IS NULL").select("ord", "tk", "text", F.lit(0).cast("bigint").alias("sub"))
    told = marked.where("shared").select("ord", "tk", "text", F.col("tk").alias("sub"))
    return alone.unionByName(told.dropDuplicates(["ord", "tk", "text"]))


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, if
    asked for, the kept words joined by one space."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("ord"),
        text_or_empty().alias("text"),
    ).withColumn("tk", F.xxhash64("text"))
    copies = _copies(rows)
    beside = broadcast_checked(copies, BROADCAST_ROWS)
    single = _told_apart(rows.join(beside, ["ord", "tk"], "left_anti").select("ord", "tk", "text"))

    anchors = written(single.select("ord", "sub", "text").mapInArrow(_anchors, "h bigint, ord bigint, sub bigint, at int"), "phrase_anchors")
    recurring = written(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "phrase_recurring")
    # Rows of the commonest anchors stay where they are.
    held = join_hot_split(anchors, recurring, ["h"], "k", anchors.count())
    places = held.groupBy("ord", "sub").agg(F.collect_list("at").alias("places"))
    stretches = written(places.mapInArrow(_stretches, "ord bigint, sub bigint, stretches array<int>"), "phrase_stretches")

    text = ["ord", "sub"]
    near = broadcast_weighed(stretches, 20 + 4 * F.size("stretches"), BROADCAST_BYTES)
    near = single.select(*text, "text").join(near, text).select(*text, "text", "stretches")
    windows = near.mapInArrow(_windows, "w1 bigint, w2 int, ord bigint, sub bigint, start int")
    first = windows.groupBy("w1", "w2").agg(F.min(F.struct("ord", "start", "sub")).alias("first"), F.count(F.lit(1)).alias("k"))
    first = written(first.where("k > 1").select("w1", "w2", "first.ord", "first.sub", "first.start"), "phrase_first")

    starts = first.groupBy(*text).agg(F.collect_list("start").alias("starts"))
    runs = written(starts.mapInArrow(_runs, "ord bigint, sub bigint, runs array<int>"), "phrase_runs")
    sources = broadcast_weighed(runs, 20 + 4 * F.size("runs"), BROADCAST_BYTES)
    sources = single.select(*text, "text").join(sources, text).select("ord", "text", "runs")
    passages = written(sources.mapInArrow(_passages, "ord bigint, start int, n int, words string"), "phrase_passages")
    n_words = passages.agg(F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0))).first()[0]
    shards = max(1, -(-n_words // SHARD_WORDS))
    shard = F.pmod(F.xxhash64(F.lit("shard"), "ord"), F.lit(shards))
    passages = passages.withColumn("shard", shard)

    # A document goes to the shards of its windows' first places.
    owners = first.select("w1", "w2", shard.alias("shard"), F.col("ord").alias("ord0"), F.col("start").alias("start0"))
    routes = windows.join(owners, ["w1", "w2"]).where("ord <> ord0 or start <> start0")
    routes = written(routes.select("ord", "sub", "shard").distinct(), "phrase_routes")
    tasks = routes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / TASK_DOCUMENTS).cast("long").alias("tasks"))
    dealt = routes.join(tasks, "shard").select(
        "ord", "sub", "shard", F.pmod(F.xxhash64(F.lit("task"), "ord", "sub"), F.col("tasks")).alias("task")
    )
    streamed = single.join(broadcast_checked(dealt, BROADCAST_ROWS), text).select("shard", "task", "ord", "tk", "text")
    copied = passages.join(tasks, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), "ord", "start", "words"
    )
    found = (
        streamed.groupBy("shard", "task")
        .cogroup(copied.groupBy("shard", "task"))
        .applyInArrow(_locate, "ord bigint, tk bigint, spans array<int>")
    )
    spans = written(found.groupBy("ord", "tk").agg(F.collect_list("spans").alias("spans")), "phrase_spans")

    whole = copies.select("ord", "tk", F.lit(True).alias("whole"))
    out = rows.join(broadcast_checked(whole, BROADCAST_ROWS), ["ord", "tk"], "left")
    bytes_of_spans = 24 + F.aggregate("spans", F.lit(0), lambda n, s: n + 4 * F.size(s))
    out = out.join(broadcast_weighed(spans, bytes_of_spans, BROADCAST_BYTES), ["ord", "tk"], "left")
    out = out.select("doc_id", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "spans")
    result = out.mapInArrow(_remove(keep_text), REMOVED)
    return result if keep_text else result.drop("kept")
