"""The near-duplicate stage: five-word shingles, Jaccard 80/100 or more."""

import random
from collections import Counter

import corpus_pipeline
import pytest

from scoreflow.llm.common import read_table, written
from scoreflow.llm.jaccard_join import Bands, Rule, jaccard_components
from tests.llm import brute

STAGE = (5, 80, 100)


def shingles(text, size):
    w = brute.SPACE_WORDS.findall((text or "").translate(brute.LOWER))
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*(w[i:] for i in range(size))))


def near(rows, size, numerator, denominator):
    """rows: (doc_id, text) -> (n_shingles, component_id); null ids link nothing."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    live = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    for x, i in enumerate(live):
        for j in live[:x]:
            both = len(sets[i] & sets[j])
            if denominator * both >= numerator * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i in live:
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    known = set(live)
    return [(len(s), None if rows[i][0] is None else least[root(i)] if i in known else rows[i][0]) for i, s in enumerate(sets)]


def test_stage_drops_footers_and_changed_words(spark, frame):
    """Near copies that three-word shingles at 90/100 keep apart."""
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    rows = [(1, " ".join(words("a", 100))), (2, " ".join(words("a", 100) + words("f", 18)))]
    for at, n in enumerate((49, 53, 58)):
        text = words(f"c{n}_", n)
        rows += [(10 + 2 * at, " ".join(text)), (11 + 2 * at, " ".join(text[:20] + ["new"] + text[21:]))]
    rows += [(30, " ".join(words("a", 100) + words("g", 30)))]
    want = {d for (d, _), e in zip(rows, near(rows, *STAGE)) if e[1] == d}
    assert want == {1, 10, 12, 14, 30}
    out = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, frame(rows), "")
    assert {r.doc_id for r in out.collect()} == want


@pytest.mark.parametrize("rule", [STAGE, (2, 65, 100)])
def test_other_settings_match_brute_force(frame, corpus, rule):
    rng, rows, at = random.Random(3), list(corpus), 20_000
    # Sizes around band bounds, with edits to both sides of the threshold.
    for size in [4, 5, 7, 8, 9, 11, 12, 14, 18, 23, 30, 39, 40, 51, 66, 84, 110, 200]:
        base = [f"{size}_{i}" for i in range(size)]
        for share in (0, 4, 8, 10, 12, 20, 24, 26, 30):
            rows.append((at, " ".join(base + [f"{at}x{i}" for i in range(size * share // 100)])))
            cut = rng.randrange(size)
            rows.append((at + 1, " ".join(base[:cut] + [f"{at}y"] + base[cut + size * share // 200 + 1 :])))
            at += 2
    rng.shuffle(rows)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame(rows), *rule).collect())
    assert got == Counter((d, *e) for (d, _), e in zip(rows, near(rows, *rule)))


@pytest.mark.parametrize("rule", [STAGE, (3, 90, 100), (2, 65, 100)])
def test_bands_of_other_settings_leave_no_link_out(rule):
    _, numerator, denominator = rule
    bands = Bands(3000, Rule(*rule))
    smallest = min(n for n in range(1, 100) if denominator * n >= numerator * (n + 1))
    assert bands.low[0] == smallest and all(a + 1 == b for a, b in zip(bands.high, bands.low[1:]))
    for b in range(len(bands.low)):
        for small in {bands.low[b], bands.high[b]}:
            large = small * denominator // numerator
            assert b + 1 == len(bands.high) or large <= bands.high[b + 1]
            above, below = denominator + numerator, denominator - numerator
            differ = max(d for d in range(large + 1) if above * d <= below * (small + large))
            assert differ <= bands.differ[b]
            m, slack, h = bands.segments[b], bands.slack[b], bands.differ[b]
            assert (2 * m >= h + 1 and m >= h) if bands.deletes[b] else m - slack >= h + 1


def test_settings_without_a_threshold_are_refused():
    for rule in ((0, 80, 100), (5, 100, 100), (5, 0, 100)):
        with pytest.raises(ValueError):
            Rule(*rule)


def test_all_stages_with_the_near_duplicate_settings(spark, sf_small):
    docs = read_table(spark, sf_small, "documents")
    bench = [tuple(r) for r in read_table(spark, sf_small, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = written(stage(spark, docs, sf_small), f"near_{name}")
        after = {r.doc_id: r for r in docs.collect()}
        rows = sorted(before.items())
        if name == "ngram_jaccard_join":
            assert set(after) == {d for (d, _), e in zip(rows, near(rows, *STAGE)) if e[1] == d}
        elif name == "benchmark_decontamination":
            found = brute.contamination([t for _, t in rows], bench)
            assert set(after) == {d for (d, _), e in zip(rows, found) if not e[4]}
        elif name == "secret_scan":
            hit = {d for d, t in rows if sum(brute.secrets(t)[:3])}
            assert set(after) == set(before) and {d for d in before if after[d].text != before[d]} >= hit
        elif name == "sentencepiece":
            assert set(after) == set(before) and all(r.round_trip for r in after.values())
