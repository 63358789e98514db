"""N-gram Jaccard join by universe partition and pigeonhole.

A document's set is its distinct word shingles. Equal sets are one class, kept
once. The universe of shingles is hashed into segments, their number m chosen
by size band; H bounds the symmetric difference of two linked sets of a band.
Two schemes find linked sets, and a band takes the one whose counted cost is
lower:

* Segment subsets. Each segment that holds something is a token (segment,
  content). Linked sets differ in at most H segments, so each has at most H
  tokens that the other lacks. Order all tokens by (count, token), counts as
  below: the first token that two sets share stands among the first H + 1 of
  either, as every token before it is one that the other lacks. So each set
  indexes the H(own size) + 1 tokens of least count and leaves out the others,
  the common ones. If two sets share no token at all, both have at most H.
* One-deletion neighbourhoods. With floor(H / 2) + 1 segments some segment
  differs in at most one shingle, else the sets would differ in more than H.
  Each segment is indexed whole and without each of its shingles in turn. Such
  a match shows unless one side of it is empty, and then the segment holds at
  most one shingle on both sides.

A set with at most H tokens, or in the second scheme with a segment of fewer
than two shingles, is sparse. A link that the scheme misses has two sparse
sets, so sparse sets are indexed again in segments of another hash, up to
DEPTH times, and those still sparse (far less than one in a million) by one
token of the band.

Counts come from one pass over all documents, added up with partial sums in a
sketch of fixed size. They decide which tokens are left out and which scheme a
band takes; links do not depend on them.

Sets that share a token are candidates. Parity bitmaps rule most of the wrong
ones out, the others are verified on the words. All pairs of a bucket are
never made. Each bucket compares its members with one pivot, and
links join components. In a large bucket that still holds several components,
the Jaccard distance (a metric) tells what is left. With t the threshold, a set
that links with a member linked to the pivot lies within 2 (1 - t) of the
pivot, in its ball. Pairs inside the ball share one of the rarest of the members'
differences from the pivot. A ball of up to BALL_TOKENS differences is one group
of a task, which counts them exactly and writes out no more than the pairs that
they leave; a larger one is joined on the differences, of which only those that
are rare and shared are written out. Members outside the ball may link with each
other and with those inside that do not link with the pivot. They are mostly
unrelated sets that share a passage, whose differences are all their shingles;
so a task compares the parity bitmaps, folded, of these members of all buckets
of a pivot, up to GROUP_MEMBERS and GROUP_BYTES. Those of larger groups are
joined anew among themselves, in segments of another hash and with other
pivots; the last of ROUNDS joins takes all members of such a group as its ball,
so that every pair is settled. Two members of one component need no comparison,
so the components are exact.

Hot tokens, told by their count, are dealt over several lanes: each lane finds
its pivot, and the lanes' pivots are reduced to one by partial aggregation.

Defined results: a null or empty text has an empty set and links with nothing;
repeated rows and equal sets share a component; a row with a null doc_id gets a
null component and links nothing; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreflow.llm import sketch
from scoreflow.llm.common import arrow_batches, broadcast_checked, discard, stored, text_or_empty
from scoreflow.llm.components import components
from scoreflow.llm.hashing import U, batch_words, inside, mix, slices, window_hashes

BAND_RATIO = 2.0
# Segments for each difference that a band must stand.
SEGMENT_FACTOR = 2
# Largest sets for which the one-deletion scheme is weighed.
DELETION_LIMIT = 40
# What an index entry costs beside the members of its bucket.
ENTRY_COST = 4.0
# Hashes that sparse sets are indexed under.
DEPTH = 4
# Rows of a hot token in one lane.
LANE_ROWS = 4096
# Members of a bucket whose pairs are compared outright, a few for each member.
SMALL_BUCKET = 8
# Differences of a ball whose pairs one task finds.
BALL_TOKENS = 1 << 20
# Members outside a ball, and bytes of their folded bitmaps, that one task compares.
GROUP_MEMBERS = 8192
GROUP_BYTES = 1 << 25
# Bytes of the bitmaps that a task holds side by side.
CHUNK_BYTES = 1 << 22
# Bytes of an Arrow batch: the texts of pairs may be long.
BATCH_BYTES = 4 << 20
# Joins of what is left; the last settles every pair.
ROUNDS = 3
# Rows of ids, without texts, that one task writes.
TASK_IDS = 200_000
# Pairs whose bitmaps, and pairs whose texts, one task compares at least: a
# shuffle of few rows leaves many partitions that cost a task more than its rows.
TASK_SCREENS = 20_000
TASK_PAIRS = 2_000
# Ids of at most this many classes are broadcast to pick their texts.
BROADCAST_CLASSES = 500_000


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the threshold as a fraction: two sets link if
    denominator * shared >= numerator * union."""

    shingle: int = 3
    numerator: int = 90
    denominator: int = 100

    def __post_init__(self):
        if self.shingle < 1 or not 0 < self.numerator < self.denominator:
            raise ValueError(f"no shingle size or threshold below 1: {self}")

    @property
    def smallest(self) -> int:
        """Below this size two different sets cannot reach the threshold."""
        return -(-self.numerator // (self.denominator - self.numerator))

    @property
    def above(self) -> int:
        return self.denominator + self.numerator

    @property
    def below(self) -> int:
        return self.denominator - self.numerator

    @property
    def ball(self) -> int:
        """Numerator of the similarity at twice the distance of a link; 0 or
        less: every set is that near."""
        return 2 * self.numerator - self.denominator

    @property
    def folds(self) -> int:
        """Folded so often, a bitmap keeps a bit or two for each shingle, more
        where linked sets may differ in more."""
        return 4 if 4 * self.numerator >= 3 * self.denominator else 2

    def differ(self, a, b):
        """The largest symmetric difference of linked sets of sizes a and b:
        |A - B| + |B - A| <= (1 - t) / (1 + t) * (|A| + |B|)."""
        return self.below * (a + b) // self.above


class Bands:
    """Size bands up to a largest size: the largest difference of linked sets,
    the segments of the subset scheme (and how many of them it can leave out),
    and those of the one-deletion scheme, for the bands in `deletes`."""

    def __init__(self, largest: int, rule: Rule = Rule(), ratio: float | None = None, deletes: frozenset[int] = frozenset()):
        self.low, self.high, self.differ, self.segments, self.slack = [], [], [], [], []
        low = rule.smallest
        # A partner is in the same band or the next one.
        ratio = max(BAND_RATIO if ratio is None else ratio, rule.denominator / rule.numerator)
        while low <= max(largest, rule.smallest):
            high = max(2 * rule.smallest - 1 if low == rule.smallest else low, int(low * ratio))
            differ = rule.differ(high, high * rule.denominator // rule.numerator)
            segments = SEGMENT_FACTOR * (differ + 1)
            for kept, value in (
                (self.low, low), (self.high, high), (self.differ, differ),
                (self.segments, segments), (self.slack, segments - differ - 1),
            ):
                kept.append(value)
            low = high + 1
        self.deletes = [b in deletes for b in range(len(self.low))]
        self.halves = [d // 2 + 1 for d in self.differ]
        self.high_array = np.array(self.high)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.high_array, sizes)


def document_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash) of every distinct shingle, by document."""
    w = batch_words(column, lower=True)
    counts = np.diff(w.first)
    h = window_hashes(w.hashes, shingle)
    keep = inside(w.first, shingle, len(h))
    at = np.flatnonzero(keep)
    document, hashes = w.document[at] if len(at) else at, h[at] if len(at) else h[:0]
    for n in range(1, shingle):
        short = np.flatnonzero(counts == n)
        whole = window_hashes(w.hashes, n)[w.first[short]] if len(short) else h[:0]
        document = np.concatenate([document, short])
        hashes = np.concatenate([hashes, mix(whole + U(n))])
    order = np.lexsort((hashes, document))
    document, hashes = document[order], hashes[order]
    if len(hashes):
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (document[1:] != document[:-1]) | (hashes[1:] != hashes[:-1])
        document, hashes = document[new], hashes[new]
    return document, hashes


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums modulo 2^64 of the stretches that start at `begin`."""
    total = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values, out=total[1:])
    return total[np.append(begin[1:], len(values))] - total[begin]


@dataclass
class Tokens:
    """Tokens of sets under one scheme: the set of each, and for each set how
    many of its tokens it indexes (-1: all)."""

    owner: np.ndarray
    token: np.ndarray
    take: np.ndarray


def _salt(band: np.ndarray, deletes: bool, depth: int, turn: int) -> np.ndarray:
    return mix(band.astype(U) + U(0x51AB + 0x1000000 * (turn * 2 * DEPTH + depth * 2 + deletes)))


def _segmented(document, hashes, band, segments, salts):
    """Shingles by (set, segment): set, segment, value, where stretches begin."""
    salt = salts[document]
    segment = ((mix(hashes ^ salt) >> U(32)) * segments[document].astype(U) >> U(32)).astype(np.int64)
    order = np.argsort((document << 32) | segment, kind="stable")
    document, segment, value = document[order], segment[order], mix(hashes[order] + U(0x77))
    new = np.ones(len(document), dtype=bool)
    new[1:] = (document[1:] != document[:-1]) | (segment[1:] != segment[:-1])
    return document, segment, value, new


def scheme_tokens(
    document: np.ndarray, hashes: np.ndarray, band: np.ndarray, need: np.ndarray, bands: Bands, deletes: bool, turn: int = 0
) -> list[Tokens]:
    """The tokens of the sets under the scheme of their bands, again for those
    that are sparse. `need` is H + 1 of each set for the partners it may have."""
    found = []
    sets = len(band)
    segments = np.array(bands.halves if deletes else bands.segments)[band] if sets else band
    for depth in range(DEPTH):
        if not len(document):
            return found
        salts = _salt(band, deletes, depth, turn)
        owner, segment, value, new = _segmented(document, hashes, band, segments, salts)
        begin = np.flatnonzero(new)
        sums = _sums(value, begin)
        label = mix(salts[owner] + segment.astype(U) * U(0x9E3779B97F4A7C15))
        tokens, owners = mix(sums ^ label[begin]), owner[begin]
        held = np.bincount(owners, minlength=sets)
        present = np.bincount(document, minlength=sets) > 0
        if deletes:
            # Each segment without each of its shingles; none of a single one.
            which = np.cumsum(new) - 1
            size = np.diff(np.append(begin, len(owner)))
            several = size[which] > 1
            less = sums[which[several]] - value[several]
            lone = np.bincount(owners[size < 2], minlength=sets) > 0
            sparse = present & ((held < segments) | lone) & (segments > 1)
            owners = np.concatenate([owners, owner[several]])
            tokens = np.concatenate([tokens, mix(less ^ label[several])])
            found.append(Tokens(owners, tokens, np.full(sets, -1)))
        else:
            sparse = present & (held < need)
            found.append(Tokens(owners, tokens, need))
        again = sparse[document]
        document, hashes = document[again], hashes[again]
    rest = np.unique(document)
    if len(rest):
        found.append(Tokens(rest, mix(_salt(band[rest], deletes, DEPTH, turn) ^ U(0xE3)), np.full(sets, -1)))
    return found


def roles(sizes: np.ndarray, bands: Bands, rule: Rule) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sets, band, H + 1): each set is in its own band, for partners of up to
    the largest size, and as the larger of a pair in the band below it."""
    own = bands.of(np.maximum(sizes, rule.smallest))
    large = sizes >= rule.smallest
    below = np.maximum(own - 1, 0)
    high = np.array(bands.high)[below]
    upper = large & (own > 0) & (high * rule.denominator >= sizes * rule.numerator)
    return [
        (large, own, rule.differ(sizes, sizes * rule.denominator // rule.numerator) + 1),
        (upper, below, rule.differ(sizes, high) + 1),
    ]


def set_tokens(document: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, bands: Bands, rule: Rule, turn: int = 0) -> list[Tokens]:
    """The tokens of all sets in both of their roles, each band by its scheme."""
    found = []
    by_deletion = np.array(bands.deletes)
    for live, band, need in roles(sizes, bands, rule):
        for deletes in (False, True):
            use = (live & (by_deletion[band] == deletes))[document]
            found += scheme_tokens(document[use], hashes[use], band, need, bands, deletes, turn)
    return found


def chosen(found: Tokens, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, token, count) of the tokens that are indexed: of each set those of
    least count."""
    count = counts[sketch.slot(found.token)]
    order = np.lexsort((found.token, count, found.owner))
    owner, token, count = found.owner[order], found.token[order], count[order]
    first = np.searchsorted(owner, owner)
    take = found.take[owner]
    keep = (take < 0) | (np.arange(len(owner)) - first < take)
    return owner[keep], token[keep], count[keep]


def _largest_weighed(rule: Rule) -> int:
    """The largest sets that enter a band for which both schemes are weighed."""
    return DELETION_LIMIT * rule.denominator // rule.numerator


def _weighed_bands(rule: Rule) -> tuple[Bands, np.ndarray]:
    bands = Bands(_largest_weighed(rule), rule)
    return bands, np.array(bands.high) <= DELETION_LIMIT


def _deletion_tokens(document, hashes, sizes, rule: Rule) -> list[tuple[np.ndarray, Tokens]]:
    """(bands of the sets, tokens) of the one-deletion scheme in the weighed bands."""
    bands, weighed = _weighed_bands(rule)
    found = []
    for live, band, need in roles(sizes, bands, rule):
        use = (live & weighed[band])[document]
        found += [(band, t) for t in scheme_tokens(document[use], hashes[use], band, need, bands, True)]
    return found


SETS = "doc_id bigint, n bigint, d1 bigint, d2 bigint, small array<bigint>, piece int, counts array<bigint>"


def _set_rows(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """A row per document: size, digest and the shingles of a small set; and
    the task's token counts, of both schemes where both are weighed."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
         ("small", pa.list_(pa.int64())), ("piece", pa.int32()), ("counts", pa.list_(pa.int64()))]
    )
    counts = sketch.Counts()
    for batch in batches:
        for part in slices(batch):
            rows = part.num_rows
            document, hashes = document_sets(part.column("text"), rule.shingle)
            n = np.bincount(document, minlength=rows)
            begin = np.flatnonzero(np.diff(document, prepend=-1))
            digests = []
            for seed in (0x1D, 0x2E):
                d = np.zeros(rows, dtype=U)
                if len(begin):
                    d[document[begin]] = _sums(mix(hashes + U(seed)), begin)
                digests.append(mix(d + n.astype(U)).view(np.int64))
            bands = Bands(int(n.max(initial=0)), rule)
            for found in set_tokens(document, hashes, n, bands, rule):
                counts.add(found.token)
            weighed = (n >= rule.smallest) & (n <= _largest_weighed(rule))
            use = weighed[document]
            for _, found in _deletion_tokens(document[use], hashes[use], np.where(weighed, n, 0), rule):
                counts.add(found.token)
            offsets = np.concatenate([[0], np.cumsum(np.where(weighed, n, 0))]).astype(np.int32)
            small = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[use].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(digests[0]), pa.array(digests[1]), small,
                    pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.list_(pa.int64())),
                ],
                schema=schema,
            )
    pieces, values = counts.pieces()
    if pieces:
        none = [pa.nulls(len(pieces), schema.field(i).type) for i in range(5)]
        held = pa.array([v.tolist() for v in values], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*none, pa.array(pieces, pa.int32()), held], schema=schema)


COSTS = "band int, subsets double, deletions double"


def _costs(batches: Iterator[pa.RecordBatch], rule: Rule, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What the entries of the small sets cost by band and scheme: each entry,
    and the members that its count says it may meet."""
    bands, weighed = _weighed_bands(rule)
    floor = float(np.median(counts))
    sums = np.zeros((2, len(bands.low)))
    for batch in batches:
        small = batch.column("small")
        sizes = np.asarray(pa.compute.list_value_length(small)).astype(np.int64)
        document = np.repeat(np.arange(len(sizes)), sizes)
        hashes = small.flatten().to_numpy(zero_copy_only=False).view(U)
        ways = [[], _deletion_tokens(document, hashes, sizes, rule)]
        for live, band, need in roles(sizes, bands, rule):
            use = (live & weighed[band])[document]
            ways[0] += [(band, t) for t in scheme_tokens(document[use], hashes[use], band, need, bands, False)]
        for way, tokens in enumerate(ways):
            for band, found in tokens:
                owner, _, count = chosen(found, counts)
                np.add.at(sums[way], band[owner], ENTRY_COST + np.maximum(count - floor - 1, 0))
    used = np.flatnonzero(sums.any(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(sums[0][used]), pa.array(sums[1][used])], names=["band", "subsets", "deletions"]
    )


def allocate(sets: DataFrame, rule: Rule, counts: np.ndarray) -> frozenset[int]:
    """The bands whose one-deletion scheme costs less than their subset scheme."""
    small = sets.where("size(small) > 0").select("small")
    found = small.mapInArrow(lambda batches: _costs(batches, rule, counts), COSTS).groupBy("band")
    found = found.agg(F.sum("subsets").alias("subsets"), F.sum("deletions").alias("deletions")).collect()
    return frozenset(r.band for r in found if r.deletions < r.subsets)


INDEX = "cid bigint, n int, w int, entry bigint, lane int"


def _index_rows(batches: Iterator[pa.RecordBatch], rule: Rule, counts: np.ndarray, deletes: frozenset, turn: int) -> Iterator[pa.RecordBatch]:
    """(cid, n, w, entry, lane): w is the sum of a set's counts
    (its logarithm), so that sets which share much are pivots; a lane is above 0 for hot tokens alone."""
    floor = float(np.median(counts))
    hot_from = max(LANE_ROWS, 8 * floor**0.5)
    for batch in batches:
        for part in slices(batch):
            document, hashes = document_sets(part.column("text"), rule.shingle)
            n = np.bincount(document, minlength=part.num_rows)
            bands = Bands(int(n.max(initial=0)), rule, deletes=deletes)
            picked = [chosen(found, counts) for found in set_tokens(document, hashes, n, bands, rule, turn)]
            if not picked:
                continue
            owner, token, count = (np.concatenate([p[i] for p in picked]) for i in range(3))
            order = np.lexsort((token, owner))
            owner, token, count = owner[order], token[order], count[order]
            new = np.ones(len(owner), dtype=bool)
            new[1:] = (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])
            owner, token, count = owner[new], token[new], count[new]
            weight = np.bincount(owner, weights=np.maximum(count - floor, 0), minlength=part.num_rows)
            weight = (8 * np.log2(1 + weight)).astype(np.int32)
            cid = np.asarray(part.column("cid")).astype(np.int64)
            true = np.maximum(count - floor, 0)
            lanes = np.where(true > hot_from, -(-true // LANE_ROWS), 0).astype(np.int64)
            dealt = (mix(cid.view(U)[owner]) % np.maximum(lanes, 1).astype(U)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cid[owner]),
                    pa.array(n[owner].astype(np.int32)),
                    pa.array(weight[owner]),
                    pa.array(token.view(np.int64)),
                    pa.array(np.where(lanes > 0, dealt + 1, 0).astype(np.int32)),
                ],
                names=["cid", "n", "w", "entry", "lane"],
            )


def _token_counts(batches: Iterator[pa.RecordBatch], rule: Rule, deletes: frozenset, turn: int) -> Iterator[pa.RecordBatch]:
    counts = sketch.Counts()
    for batch in batches:
        for part in slices(batch):
            document, hashes = document_sets(part.column("text"), rule.shingle)
            n = np.bincount(document, minlength=part.num_rows)
            bands = Bands(int(n.max(initial=0)), rule, deletes=deletes)
            for found in set_tokens(document, hashes, n, bands, rule, turn):
                counts.add(found.token)
    pieces, values = counts.pieces()
    held = pa.array([v.tolist() for v in values], pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.int32()), held], names=["piece", "counts"])


def _buckets(index: DataFrame) -> DataFrame:
    """The members (entry, cid, n, k, p, n_p) of all buckets of two or more:
    k is a bucket's size and p its pivot, of size n_p."""
    lane = Window.partitionBy("entry", "lane")
    rank = F.struct("w", (-F.col("cid")).alias("order"), F.col("cid").alias("p"), F.col("n").alias("n_p"))
    placed = index.withColumn("k", F.count(F.lit(1)).over(lane)).withColumn("best", F.max(rank).over(lane))
    kept = stored(placed.where("k > 1 OR lane > 0").select("entry", "lane", "cid", "n", "k", "best"), "members")
    cold = kept.where("lane = 0").select("entry", "cid", "n", "k", "best.p", "best.n_p")
    if kept.where("lane > 0").isEmpty():
        cold.scratch_path = kept.scratch_path
        return cold
    # One row per lane; the hot tokens are bounded by the lanes' size.
    hot = kept.where("lane > 0").groupBy("entry", "lane").agg(F.max("best").alias("best"), F.count(F.lit(1)).alias("k"))
    hot = stored(hot.groupBy("entry").agg(F.max("best").alias("best"), F.sum("k").alias("k")).where("k > 1"), "hot_tokens")
    hot_members = kept.where("lane > 0").select("entry", "cid", "n").join(broadcast_checked(hot, BROADCAST_CLASSES), "entry")
    members = cold.unionByName(hot_members.select("entry", "cid", "n", "k", "best.p", "best.n_p"))
    members = stored(members, "buckets")
    discard(kept, hot)
    return members


def word_shingles(text: bytes, shingle: int) -> set:
    words = text.split()
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(shingle))))


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

COMPARED = "a bigint, b bigint, linked boolean, near boolean"


def _compared(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets link, or are in each other's ball, compared shingle by
    shingle."""
    known, pivot = None, set()
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        keep, linked = [], []
        for i in range(batch.num_rows):
            if b[i] != known:
                known, pivot = b[i], word_shingles(batch.column("text_b")[i].as_py().encode().translate(_LOWER), rule.shingle)
            other = word_shingles(batch.column("text_a")[i].as_py().encode().translate(_LOWER), rule.shingle)
            shared = len(other & pivot)
            union = len(other) + len(pivot) - shared
            if rule.denominator * shared >= min(rule.numerator, rule.ball) * union:
                keep.append(i)
                linked.append(rule.denominator * shared >= rule.numerator * union)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([a[i] for i in keep], pa.int64()),
                pa.array([b[i] for i in keep], pa.int64()),
                pa.array(linked, pa.bool_()),
                pa.array([True] * len(keep), pa.bool_()),
            ],
            names=["a", "b", "linked", "near"],
        )


SIGNATURES = "cid bigint, n bigint, bits binary"


def _signatures(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Parity bitmaps of the sets: a shingle flips one bit of four or more per
    shingle (a power of two), so two bitmaps differ in no more bits than the
    sets in shingles."""
    for batch in batches:
        for part in slices(batch):
            document, hashes = document_sets(part.column("text"), rule.shingle)
            n = np.bincount(document, minlength=part.num_rows)
            size = 1 << np.minimum(np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 2, 20)
            size = np.maximum(size, 64)
            first = np.concatenate([[0], np.cumsum(size)])
            at = first[document] + (mix(hashes + U(0x9A)) & (size[document] - 1).astype(U)).astype(np.int64)
            data = np.packbits((np.bincount(at, minlength=first[-1]) & 1).astype(np.uint8))
            offsets = pa.py_buffer((first // 8).astype(np.int32))
            bits = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, offsets, pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([part.column("cid"), pa.array(n.astype(np.int64)), bits], names=["cid", "n", "bits"])


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets from their parity
    bitmaps; the longer one is folded to the length of the other."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) < len(y):
        x, y = y, x
    return int(np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0) ^ y).sum())


def _screened(batches: Iterator[pa.RecordBatch], numerator: int, denominator: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose bitmaps leave a similarity of numerator / denominator open."""
    for batch in batches:
        bits = batch.column("bits_a"), batch.column("bits_b")
        both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        most = (denominator - numerator) * both // (denominator + numerator)
        keep = [least_difference(bits[0][i].as_py(), bits[1][i].as_py()) <= most[i] for i in range(batch.num_rows)]
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


@dataclass
class _Sets:
    """The texts (cid, text) of the candidates and their signatures."""

    texts: DataFrame
    signatures: DataFrame


class _Pairs:
    """Pairs (a, b) beside the texts that they need: the text of a is carried
    to where b is, and that of b is read there. Pairs that the signatures rule
    out need no text."""

    def __init__(self, pairs: DataFrame, sets: _Sets, members: int, screen: tuple[int, int] | None = None):
        self.pairs = stored(_few(pairs, members), "pairs")
        rows = self.pairs.count()
        if screen is not None:
            side = {c: sets.signatures.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab"}
            met = _few(_few(self.pairs.join(side["a"], "a"), rows, TASK_SCREENS).join(side["b"], "b"), rows, TASK_SCREENS)
            open_pairs = met.mapInArrow(lambda batches: _screened(batches, *screen), "a bigint, b bigint")
            kept = stored(_few(open_pairs.distinct(), rows), "screened")
            discard(self.pairs)
            self.pairs = kept
            rows = kept.count()
        self.rows = rows
        ids = self.pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        self.ids = stored(_few(ids, rows), "pair_ids")
        self.texts = sets.texts.join(broadcast_checked(self.ids, BROADCAST_CLASSES), "cid", "left_semi")

    def joined(self) -> DataFrame:
        left = self.texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a"))
        right = self.texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b"))
        return _few(_few(self.pairs.join(left, "a"), self.rows, TASK_PAIRS).join(right, "b"), self.rows, TASK_PAIRS)

    def done(self) -> None:
        discard(self.pairs, self.ids)


def _few(df: DataFrame, rows: int, each: int = TASK_IDS) -> DataFrame:
    """A table of about so many rows (of ids by default) in as few tasks and files."""
    return df.coalesce(1 + rows // each)


def _compare(pairs: DataFrame, sets: _Sets, members: int, rule: Rule, numerator: int) -> DataFrame:
    """The pairs of at least the similarity numerator / denominator."""
    beside = _Pairs(pairs.select("a", "b"), sets, members, (numerator, rule.denominator) if numerator > 0 else None)
    found = beside.joined().select("a", "b", "text_a", "text_b")
    out = stored(found.mapInArrow(lambda batches: _compared(batches, rule), COMPARED), "compared")
    beside.done()
    return out


def _near_sizes(a: str, b: str, rule: Rule, numerator: int | None = None):
    numerator = rule.numerator if numerator is None else numerator
    return F.greatest(a, b) * F.lit(max(numerator, 0)) <= F.least(a, b) * rule.denominator


DIFFERENCES = "a bigint, p bigint, comp bigint, n bigint, n_p bigint, tokens array<bigint>"


def _differences(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Shingle hashes that only one of a class and its pivot has, and the sizes
    of both."""
    known, pivot = None, None
    for batch in batches:
        p = batch.column("b").to_pylist()
        tokens, n, n_p = [], [], []
        for i in range(batch.num_rows):
            if p[i] != known:
                known, pivot = p[i], document_sets(batch.column("text_b").slice(i, 1), rule.shingle)[1]
            other = document_sets(batch.column("text_a").slice(i, 1), rule.shingle)[1]
            tokens.append(np.setxor1d(other, pivot, assume_unique=True).view(np.int64))
            n.append(len(other))
            n_p.append(len(pivot))
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
        values = np.concatenate(tokens) if tokens else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in ("a", "b", "comp")], pa.array(n, pa.int64()), pa.array(n_p, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            ],
            names=["a", "p", "comp", "n", "n_p", "tokens"],
        )


def _difference_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's counts of the differences by pivot."""
    counts = sketch.Counts()
    for batch in batches:
        lists = batch.column("tokens")
        pivots = np.repeat(batch.column("p").to_numpy(), np.asarray(pa.compute.list_value_length(lists)))
        counts.add(_of_pivot(lists.flatten().to_numpy(zero_copy_only=False).view(U), pivots))
    pieces, values = counts.pieces()
    held = pa.array([v.tolist() for v in values], pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.int32()), held], names=["piece", "counts"])


def _of_pivot(tokens: np.ndarray, p: int | np.ndarray) -> np.ndarray:
    return mix(tokens ^ mix(np.atleast_1d(p).astype(np.int64).view(U)))


def difference_prefixes(size, n, n_p, rule: Rule):
    """How many of the rarest of the |X'| = `size` differences of X from its
    pivot can matter, for a partner that does not link with the pivot and, if X
    does not itself, for any partner.

    With s = |X' & Y'| and c = (1 - t) / (1 + t), X and Y differ in |X'| + |Y'|
    - 2 s, so a link needs 2 s >= |X'| + |Y'| - c (n_X + n_Y). As s <= |Y'|, it
    needs s >= |X'| - c (n_X + n_Y), and n_Y <= n_X / t makes that
    s >= |X'| - n_X (1 - t) / t, for either side. If Y does not link with p,
    |Y'| > c (n_Y + n_p), so also 2 s > |X'| + c (n_p - n_X). The rarest shared
    difference then stands among the |X'| - s + 1 rarest of X', and among the
    |Y'| - s + 1 rarest of Y', in one order of all differences."""
    least = np.maximum(1, size - n * rule.below // rule.numerator)
    far = (rule.above * size + rule.below * (n_p - n)) // (2 * rule.above) + 1
    return size - np.maximum(least, far) + 1, size - least + 1


def _by_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each pivot from batches that are sorted by p; those of one
    are held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        p = batch.column("p").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(p)) + 1).tolist(), len(p)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if held and begin < end and held[0].column("p")[0].as_py() != p[begin]:
                yield held
                held = []
            if begin < end:
                held.append(batch.slice(begin, end - begin))
    if held:
        yield held


def _in_balls(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """The pairs of every ball of rows (a, p, comp, n, n_p, tokens) that are
    sorted by p."""
    for held in _by_pivot(batches):
        yield from _ball(held, rule)


def _ball(parts: list[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Pairs of different components of one ball whose differences from the
    pivot leave a link open: they share one that is among the rarest that
    matter of either, and parity bitmaps of all of them are near enough."""
    rows = pa.Table.from_batches(parts)
    a, n, n_p, comp = (rows.column(c).to_numpy() for c in ("a", "n", "n_p", "comp"))
    lists = rows.column("tokens").combine_chunks()
    sizes = np.asarray(pa.compute.list_value_length(lists)).astype(np.int64)
    tokens = lists.flatten().to_numpy(zero_copy_only=False).view(U)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bits = 64
    while bits * len(sizes) < 2 * len(tokens):
        bits *= 2
    signs = np.zeros((len(sizes), bits // 64), dtype=U)
    bit = mix(tokens + U(0x9A)) & U(bits - 1)
    np.bitwise_xor.at(signs, (owner, (bit >> U(6)).astype(np.int64)), U(1) << (bit & U(63)))
    _, token, count = np.unique(tokens, return_inverse=True, return_counts=True)
    times = count[token]
    order = np.lexsort((token, times, owner))
    token, times = token[order], times[order]
    at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    probe, index = difference_prefixes(sizes, n, n_p, rule)
    is_far = rule.above * sizes > rule.below * (n + n_p)
    looks = np.flatnonzero((times > 1) & (at < probe[owner]))
    holds = np.flatnonzero((times > 1) & (at < index[owner]) & is_far[owner])
    holds = holds[np.argsort(token[holds], kind="stable")]
    first = np.searchsorted(token[holds], token[looks])
    many = np.searchsorted(token[holds], token[looks], side="right") - first
    ends, begin = np.cumsum(many), 0
    while begin < len(looks):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + CHUNK_BYTES // (bits // 8), side="right")))
        met = many[begin:end]
        i = np.repeat(looks[begin:end], met)
        j = holds[np.arange(len(i)) + np.repeat(first[begin:end] - (ends[begin:end] - met - done), met)]
        x, y = owner[i], owner[j]
        # If a token is the first that two members share, they share no more
        # than stand from it on; a link keeps the row of its first one.
        most = np.minimum(sizes[x] - at[i], sizes[y] - at[j])
        both = rule.below * (n[x] + n[y])
        fit = np.maximum(n[x], n[y]) * rule.numerator <= np.minimum(n[x], n[y]) * rule.denominator
        keep = (a[x] != a[y]) & (comp[x] != comp[y]) & fit & (2 * rule.above * most >= rule.above * (sizes[x] + sizes[y]) - both)
        x, y = np.divmod(np.unique(np.minimum(x, y)[keep] * len(sizes) + np.maximum(x, y)[keep]), len(sizes))
        differ = np.bitwise_count(signs[x] ^ signs[y]).sum(axis=1, dtype=np.int64)
        near = rule.above * differ <= rule.below * (n[x] + n[y])
        pair = a[x[near]], a[y[near]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(*pair)), pa.array(np.maximum(*pair))], names=["a", "b"])
        begin = end


PROBES = "p bigint, t bigint, a bigint, n bigint, comp bigint, size bigint, at bigint, probe boolean, far boolean"


def _probes(batches: Iterator[pa.RecordBatch], rule: Rule, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rarest differences of every class that another may share, each with
    the number of all its differences and its place among them by rarity."""
    for batch in batches:
        facts = [batch.column(c).to_numpy() for c in ("p", "a", "n", "n_p", "comp")]
        out = [[] for _ in range(9)]
        for i in range(batch.num_rows):
            p, a, n, n_p, comp = (int(f[i]) for f in facts)
            tokens = batch.column("tokens")[i].values.to_numpy(zero_copy_only=False).view(U)
            mixed = _of_pivot(tokens, p)
            count = counts[sketch.slot(mixed)]
            order = np.lexsort((mixed, count))
            is_far = rule.above * len(tokens) > rule.below * (n + n_p)
            probe, index = difference_prefixes(len(tokens), n, n_p, rule)
            kept = max(probe, index if is_far else 0)
            order = order[: max(kept, 0)]
            at = np.arange(len(order))
            # Counted once: nobody else has it, though it is among the rarest.
            met = count[order] > 1
            rows = int(met.sum())
            for column, value in zip(out, (p, None, a, n, comp), strict=False):
                column.append(np.full(rows, value) if value is not None else mixed[order][met].view(np.int64))
            out[5].append(np.full(rows, len(tokens)))
            out[6].append(at[met])
            out[7].append((at < probe)[met])
            out[8].append(((at < index) & is_far)[met])
        columns = [np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in out]
        arrays = [pa.array(c.astype(np.int64)) for c in columns[:7]] + [pa.array(c.astype(bool)) for c in columns[7:]]
        yield pa.RecordBatch.from_arrays(arrays, names=["p", "t", "a", "n", "comp", "size", "at", "probe", "far"])


def _ball_pairs(live: DataFrame, sets: _Sets, members: int, rule: Rule) -> DataFrame:
    """Candidates of different components among the members (cid, comp, p) of
    balls: two that share a difference from p which is among the rarest
    that matter of either."""
    compared = live.where("cid <> p").select(F.col("cid").alias("a"), F.col("p").alias("b"), "comp").distinct()
    beside = _Pairs(compared, sets, members)
    apart = beside.joined().select("a", "b", "comp", "text_a", "text_b")
    apart = stored(apart.mapInArrow(lambda batches: _differences(batches, rule), DIFFERENCES), "differences")
    beside.done()
    rows = beside.rows
    large = _few(apart.groupBy("p").agg(F.sum(F.size("tokens")).alias("held")), rows).where(F.col("held") > BALL_TOKENS).select("p")
    large = stored(large, "large_balls")
    small, rest = (apart.join(broadcast_checked(large, BROADCAST_CLASSES), "p", how) for how in ("left_anti", "left_semi"))
    small = small.select("a", "p", "comp", "n", "n_p", "tokens").repartition("p")
    small = _few(small, rows, TASK_PAIRS).sortWithinPartitions("p")
    pairs = stored(small.mapInArrow(lambda batches: _in_balls(batches, rule), "a bigint, b bigint"), "ball_pairs")
    if not large.isEmpty():
        pairs = pairs.unionByName(_large_ball_pairs(rest, rule))
    discard(apart, large)
    return pairs


def _large_ball_pairs(apart: DataFrame, rule: Rule) -> DataFrame:
    """The pairs of balls that are too large for a task, joined on their
    differences."""
    counts = sketch.total(apart.mapInArrow(_difference_counts, sketch.PIECES))
    rows = apart.select("p", "a", "n", "n_p", "comp", "tokens")
    rows = stored(rows.mapInArrow(lambda batches: _probes(batches, rule, counts), PROBES), "probes")
    # Groups of one component, such as a second cluster, need no pairs.
    mixed = rows.groupBy("p", "t").agg(F.min("comp").alias("low"), F.max("comp").alias("top")).where("low < top").select("p", "t")
    rows = rows.join(mixed, ["p", "t"])
    index = rows.where("far").select("p", "t", *[F.col(c).alias(f"{c}_b") for c in ("a", "n", "comp", "size", "at")])
    # If t is the first difference that two members share, they share no more
    # than stand from it on; a link keeps the row of its first one.
    most = F.least(F.col("size") - F.col("at"), F.col("size_b") - F.col("at_b"))
    enough = 2 * rule.above * most >= rule.above * (F.col("size") + F.col("size_b")) - rule.below * (F.col("n") + F.col("n_b"))
    pairs = rows.where("probe").join(index, ["p", "t"]).where(
        (F.col("a") != F.col("a_b")) & (F.col("comp") != F.col("comp_b")) & _near_sizes("n", "n_b", rule) & enough
    )
    pairs = pairs.select("a", F.col("a_b").alias("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _folded(batches: Iterator[pa.RecordBatch], folds: int) -> Iterator[pa.RecordBatch]:
    """Signatures folded to a part of their bits, 64 at least."""
    for batch in batches:
        folded = []
        for bits in batch.column("bits"):
            x = np.frombuffer(bits.as_py(), dtype=np.uint8)
            folded.append(np.bitwise_xor.reduce(x.reshape(-1, max(8, len(x) // folds)), axis=0).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("n"), pa.array(folded, pa.binary())], names=["cid", "n", "bits"])


def _in_groups(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """The pairs of every group of rows (a, p, comp, n, bits) that are sorted
    by p."""
    for held in _by_pivot(batches):
        yield from _group(held, rule)


def _group(parts: list[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Pairs of different components of one group whose sizes and bitmaps leave
    a link open. By size, the possible partners of a member are one stretch; it
    is taken in turns of the members whose bitmaps are equally long, each
    folded to the length of the member's own."""
    rows = pa.Table.from_batches(parts)
    order = np.argsort(rows.column("n").to_numpy(), kind="stable")
    a, n, comp = (rows.column(c).to_numpy()[order] for c in ("a", "n", "comp"))
    bits = rows.column("bits").to_pylist()
    bits = [bits[i] for i in order]
    lengths = np.array([len(b) for b in bits])
    # Longer sets have bitmaps as long or longer.
    starts = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), len(bits)]
    ends = np.searchsorted(n * rule.numerator, n * rule.denominator, side="right")
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for turn, (begin, end) in enumerate(zip(starts, starts[1:], strict=False)):
        width = int(lengths[begin]) // 8
        own = np.frombuffer(b"".join(bits[begin:end]), dtype=U).reshape(end - begin, width)
        for first, last in zip(starts[turn:], starts[turn + 1 :], strict=False):
            if first >= ends[end - 1]:
                break
            others = own
            if first > begin:
                others = np.frombuffer(b"".join(bits[first:last]), dtype=U).reshape(last - first, -1, width)
                others = np.bitwise_xor.reduce(others, axis=1)
            for i in range(begin, end):
                low, high = max(i + 1, first), min(int(ends[i]), last)
                if low >= high:
                    continue
                j = low + np.flatnonzero(comp[low:high] != comp[i])
                differ = np.bitwise_count(others[j - first] ^ own[i - begin]).sum(axis=1, dtype=np.int64)
                j = j[rule.above * differ <= rule.below * (n[i] + n[j])]
                if len(j):
                    found.append((np.minimum(a[i], a[j]), np.maximum(a[i], a[j])))
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(side)) for side in zip(*found, strict=True)], names=["a", "b"])


def _wide_groups(apart: DataFrame, rows: int, rule: Rule) -> DataFrame:
    """The pivots p whose members (a, p, comp, n) one task does not compare."""
    per = F.pow(F.lit(2), F.ceil(F.log2(F.greatest("n", F.lit(2)))) + 2) / (8 * rule.folds)
    groups = apart.groupBy("p").agg(F.count(F.lit(1)).alias("members"), F.sum(F.greatest(per, F.lit(8.0))).alias("bytes"))
    wide = (F.col("members") > GROUP_MEMBERS) | (F.col("bytes") > GROUP_BYTES)
    return stored(_few(groups.where(wide).select("p"), rows), "wide_groups")


def _group_pairs(apart: DataFrame, sets: _Sets, rows: int, rule: Rule) -> DataFrame:
    """Candidates of different components among the members (a, p, comp, n) of
    one pivot."""
    signatures = sets.signatures.mapInArrow(lambda batches: _folded(batches, rule.folds), SIGNATURES).withColumnRenamed("cid", "a")
    met = apart.select("a", "p", "comp").join(signatures, "a").repartition("p")
    met = _few(met, rows, TASK_PAIRS).sortWithinPartitions("p")
    return stored(met.mapInArrow(lambda batches: _in_groups(batches, rule), "a bigint, b bigint"), "group_pairs")


def _small_bucket_pairs(live: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of different components in buckets of few members; those with the
    pivot were compared."""
    few = live.where((F.col("k") <= SMALL_BUCKET) & (F.col("cid") != F.col("p")))
    other = few.select("entry", F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("comp").alias("comp_b"))
    pairs = few.select("entry", F.col("cid").alias("a"), "n", "comp").join(other, "entry")
    return pairs.where((F.col("a") < F.col("b")) & (F.col("comp") != F.col("comp_b")) & _near_sizes("n", "n_b", rule)).select("a", "b")


def _merge(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """`comp` (cid, comp) after further links between classes; itself without any."""
    if comp is not None and links.isEmpty():
        return comp
    if comp is None:
        merged = components(links, links.count())
        out = stored(merged.select(F.col("node").alias("cid"), "comp"), "comps")
        discard(merged)
        return out
    to = {s: comp.select(F.col("cid").alias(s), F.col("comp").alias(f"c{s}")) for s in "ab"}
    joined = links.join(to["a"], "a", "left").join(to["b"], "b", "left")
    merged = components(joined.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), links.count())
    onto = merged.select(F.col("node").alias("comp"), F.col("comp").alias("onto"))
    old = comp.join(onto, "comp", "left").select("cid", F.coalesce("onto", "comp").alias("comp"))
    fresh = merged.select(F.col("node").alias("cid"), "comp").join(comp.select("cid"), "cid", "left_anti")
    out = stored(old.unionByName(fresh), "comps")
    discard(merged)
    return out


def _placed(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members of buckets of three or more that hold several components."""
    placed = members.where("k > 2").join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    open_ones = placed.groupBy("entry").agg(F.min("comp").alias("low"), F.max("comp").alias("top")).where("low < top")
    return placed.join(open_ones.select("entry"), "entry")


def _resolve(members: DataFrame, sets: _Sets, comp: DataFrame | None, rule: Rule, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """`comp` after all links within the buckets but those among the classes
    that are returned beside it, to be joined anew (None: none are left)."""
    near = _near_sizes("n", "n_p", rule, min(rule.numerator, rule.ball))
    pairs = members.where((F.col("cid") != F.col("p")) & near).select(F.col("cid").alias("a"), F.col("p").alias("b")).distinct()
    rows = members.count()
    found = _compare(pairs, sets, rows, rule, min(rule.numerator, rule.ball))
    was, comp = comp, _merge(comp, found.where("linked").select("a", "b"))
    if was is not None and was is not comp:
        discard(was)
    # A bucket of two is settled by its one comparison, one of a single component too.
    shown = found.groupBy(F.col("a").alias("cid"), F.col("b").alias("p")).agg(F.max("linked").alias("linked"), F.max("near").alias("near"))
    live = _placed(members, comp).join(shown, ["cid", "p"], "left")
    itself = F.col("cid") == F.col("p")
    live = live.withColumns(
        {"linked": itself | F.coalesce("linked", F.lit(False)), "near": itself | F.coalesce("near", F.lit(rule.ball <= 0))}
    )
    live = stored(_few(live, rows), "unsettled")
    discard(found)
    if live.isEmpty():
        return comp, None
    large = live.where(F.col("k") > SMALL_BUCKET)
    outside = large.where("NOT near").select("entry").distinct()
    apart = large.where("NOT linked").join(outside, "entry", "left_semi")
    apart = stored(_few(apart.select(F.col("cid").alias("a"), "p", "comp", "n").distinct(), rows), "apart")
    far = apart.count()
    wide = _wide_groups(apart, far, rule)
    all_fit = wide.isEmpty()
    in_wide = broadcast_checked(wide, BROADCAST_CLASSES)
    inside = large.where("near")
    if last and not all_fit:
        inside = inside.join(in_wide, "p", "left_anti").unionByName(large.join(in_wide, "p", "left_semi"))
    more = _small_bucket_pairs(live, rule).unionByName(_ball_pairs(inside, sets, rows, rule))
    if far:
        groups = _group_pairs(apart.join(in_wide, "p", "left_anti"), sets, far, rule)
        more = more.unionByName(groups)
    linked = _compare(more.distinct(), sets, rows, rule, rule.numerator)
    left = None
    if not last and not all_fit:
        left = stored(_few(apart.join(in_wide, "p", "left_semi").select(F.col("a").alias("cid")).distinct(), far), "left")
    discard(apart, wide, *([groups] if far else []))
    merged = _merge(comp, linked.where("linked").select("a", "b"))
    discard(linked, live, *([comp] if merged is not comp else []))
    return merged, left


def _has_repeats(sets: DataFrame) -> bool:
    """Whether any doc_id stands in several rows."""
    return not sets.groupBy("doc_id").count().where("count > 1").isEmpty()


def jaccard_components(docs: DataFrame, shingle: int = 3, numerator: int = 90, denominator: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (smallest doc_id with
    an equal set) and component_id (smallest doc_id that links reach). Sets are
    of `shingle` words and link from a Jaccard of numerator / denominator on."""
    rule = Rule(shingle, numerator, denominator)
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return _components(docs, rule)


def _components(docs: DataFrame, rule: Rule) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    read = stored(rows.mapInArrow(lambda batches: _set_rows(batches, rule), SETS), "jaccard_read")
    counts = sketch.total(read.where("piece IS NOT NULL").select("piece", "counts"))
    deletes = allocate(read, rule, counts)
    sets = stored(read.where("piece IS NULL").select("doc_id", "n", "d1", "d2"), "jaccard_sets")
    discard(read)
    known = sets.where("doc_id IS NOT NULL")
    documents = sets.count()
    classes = known.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("cid"))
    classes = stored(_few(classes, documents), "jaccard_classes")
    # Ids that stand for no class, or for one too small to link.
    stands = F.coalesce((F.col("doc_id") == F.col("cid")) & (F.col("n") >= rule.smallest), F.lit(False))
    alone = known.join(classes, ["d1", "d2"], "left").groupBy("doc_id").agg(F.max(stands).alias("stands"))
    alone = stored(_few(alone.where("NOT stands").select("doc_id"), documents), "jaccard_alone")
    texts = rows.where("doc_id IS NOT NULL").join(broadcast_checked(alone, BROADCAST_CLASSES), "doc_id", "left_anti")
    texts = texts.select(F.col("doc_id").alias("cid"), "text")
    if _has_repeats(known):
        texts = texts.distinct()
    comp, left, kept = None, None, None
    for turn in range(ROUNDS):
        base = texts if kept is None else kept.join(broadcast_checked(left, BROADCAST_CLASSES), "cid", "left_semi")
        if turn:
            counts = sketch.total(base.mapInArrow(lambda batches, t=turn: _token_counts(batches, rule, deletes, t), sketch.PIECES))
        index = base.mapInArrow(lambda batches, t=turn, c=counts: _index_rows(batches, rule, c, deletes, t), INDEX)
        members = _buckets(index)
        if kept is None:
            ids = stored(members.select("cid").distinct(), "jaccard_members")
            kept = stored(texts.join(broadcast_checked(ids, BROADCAST_CLASSES), "cid", "left_semi"), "jaccard_texts")
            discard(ids)
            signatures = stored(kept.mapInArrow(lambda batches: _signatures(batches, rule), SIGNATURES), "signatures")
        was, (comp, left) = left, _resolve(members, _Sets(kept, signatures), comp, rule, turn == ROUNDS - 1)
        discard(members, *([was] if was is not None else []))
        if left is None:
            break
    discard(kept, signatures, alone, *([left] if left is not None else []))
    place = classes.join(comp, "cid", "left").select("d1", "d2", "cid", F.coalesce("comp", "cid").alias("comp"))
    out = sets.join(place, ["d1", "d2"], "left")
    with_id = F.col("doc_id").isNotNull()
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(with_id, F.coalesce("cid", "doc_id")).alias("class_id"),
        F.when(with_id, F.coalesce("comp", "doc_id")).alias("component_id"),
    )
