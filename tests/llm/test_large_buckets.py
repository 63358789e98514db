"""Large buckets of the Jaccard join: links that the pivot does not show."""

import random

import pyarrow as pa
import pytest

from scoreflow.llm import jaccard_join
from scoreflow.llm.jaccard_join import Rule, jaccard_components
from tests.llm import brute
from tests.llm.test_near_duplicates import near


def test_links_of_copies_that_append_shared_and_own_words(frame):
    """X - Y 36/40 and X - p 35/37 link, Y - p 35/39 does not; the copies of p
    make its buckets large."""
    rows = []
    for case in range(12):
        p = [f"b{case}_{i}" for i in range(37)]
        texts = [p, *([*p, f"u{case}_{i}"] for i in range(14))]
        texts += [[*p, f"s{case}", f"x{case}"], [*p, f"s{case}", *(f"y{case}_{i}" for i in range(3))]]
        rows += [(case * 100 + i, " ".join(words)) for i, words in enumerate(texts)]
    want = {(d, *e) for (d, _), e in zip(rows, brute.jaccard(rows))}
    assert {e[2] for e in want} == {case * 100 for case in range(12)}
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame(rows)).collect()}
    assert got == want


@pytest.mark.parametrize("rule", [(3, 90, 100), (5, 80, 100)])
def test_large_buckets_match_brute_force(frame, rule):
    """Copies of several pivots with edits of their own and shared ones, and
    others that only share a passage."""
    rng = random.Random(17)
    rows = []
    for case, size in enumerate((30, 37, 60, 120)):
        p = [f"b{case}_{i}" for i in range(size)]
        shared = [[f"s{case}_{k}_{i}" for i in range(12)] for k in range(4)]
        texts = [p]
        for i in range(60):
            tail = rng.choice(shared)[: rng.randrange(1 + size // 6)] + [f"o{case}_{i}_{j}" for j in range(rng.randrange(5))]
            cut = rng.randrange(4)
            texts.append(p[cut:] + tail)
        texts += [[f"q{case}_{i}_{j}" for j in range(rng.randrange(60))] + p[:30] for i in range(25)]
        rows += [(case * 1000 + i, " ".join(words)) for i, words in enumerate(texts)]
    rng.shuffle(rows)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame(rows), *rule).collect()}
    assert got == {(d, *e) for (d, _), e in zip(rows, near(rows, *rule))}


@pytest.mark.parametrize("rule", [Rule(3, 90, 100), Rule(5, 80, 100)])
def test_a_task_finds_the_links_of_a_ball_and_writes_few_pairs(rule, monkeypatch):
    """Sets by their differences from a pivot, in batches that cut balls: every
    link of two components is found (but those of two members that link with
    the pivot), and hardly a pair that is none."""
    monkeypatch.setattr(jaccard_join, "CHUNK_BYTES", 4096)
    rng = random.Random(29)
    rows, want, tokens = [], set(), 0
    for p in range(6):
        pivot = set(range(p * 10**6, p * 10**6 + 200))
        span = 3 * rule.below - 10
        shared = [p * 10**6 + 1000 + i for i in range(3 * span)]
        sets = []
        for i in range(80):
            own = [p * 10**6 + 5000 + i * 100 + j for j in range(rng.randrange(6))]
            # Two of three take a run of the shared ones, so that some link.
            run = shared[(at := rng.randrange(3) * span) : at + rng.randrange(span + 1)] if i % 3 else []
            sets.append(pivot - set(rng.sample(sorted(pivot), rng.randrange(6))) | set(own) | set(run))
        comps = [p * 1000 + rng.randrange(20) for _ in sets]
        links = lambda x, y: rule.denominator * len(x & y) >= rule.numerator * len(x | y)
        for i, x in enumerate(sets):
            both = sorted(x ^ pivot)
            tokens += len(both)
            rows.append({"a": p * 1000 + i, "p": p, "comp": comps[i], "n": len(x), "n_p": len(pivot), "tokens": both})
            for j, y in enumerate(sets[:i]):
                if comps[i] != comps[j] and x & y - pivot | (pivot - x) & (pivot - y) and links(x, y) and not (links(x, pivot) and links(y, pivot)):
                    want.add((p * 1000 + j, p * 1000 + i))
    schema = pa.schema([(c, pa.int64()) for c in ("a", "p", "comp", "n", "n_p")] + [("tokens", pa.list_(pa.int64()))])
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 37], schema=schema) for i in range(0, len(rows), 37)]
    out = [(r["a"], r["b"]) for b in jaccard_join._in_balls(iter(batches), rule) for r in b.to_pylist()]
    assert len(want) > 20 and want <= set(out)
    assert all(a < b and a // 1000 == b // 1000 for a, b in out)
    assert len(set(out) - want) < tokens / 4


@pytest.mark.parametrize("rule", [Rule(3, 90, 100), Rule(5, 80, 100), Rule(2, 55, 100), Rule(2, 30, 100)])
def test_a_task_finds_the_links_of_a_group_by_folded_bitmaps(rule):
    """Sets of many sizes, some of them parts of others, in batches that cut
    groups: every link of two components is found, and hardly a pair that is none."""
    rng = random.Random(37)
    texts = []
    for i in range(150):
        own = [f"o{i}_{j}" for j in range(rng.choice((8, 40, 150, 600)))]
        words = (rng.choice(texts).split()[:400] if texts and i % 3 else []) + own[: rng.choice((2, 600))]
        texts.append(" ".join(words))
    table = pa.table({"cid": pa.array(range(150), pa.int64()), "text": texts}).to_batches()
    signed = pa.Table.from_batches(jaccard_join._folded(jaccard_join._signatures(iter(table), rule), rule.folds))
    rows = [{"a": r["cid"], "p": r["cid"] % 3, "comp": rng.randrange(40), "n": r["n"], "bits": r["bits"]} for r in signed.to_pylist()]
    rows.sort(key=lambda r: r["p"])
    schema = pa.schema([(c, pa.int64()) for c in ("a", "p", "comp", "n")] + [("bits", pa.binary())])
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 37], schema=schema) for i in range(0, len(rows), 37)]
    out = [(r["a"], r["b"]) for b in jaccard_join._in_groups(iter(batches), rule) for r in b.to_pylist()]
    sets = [jaccard_join.word_shingles(t.encode(), rule.shingle) for t in texts]
    comp = {r["a"]: r["comp"] for r in rows}
    pairs = [(x, y) for x in range(150) for y in range(x) if x % 3 == y % 3 and comp[x] != comp[y]]
    links = {(y, x) for x, y in pairs if rule.denominator * len(sets[x] & sets[y]) >= rule.numerator * len(sets[x] | sets[y])}
    assert len(set(out)) == len(out) and links and links <= set(out) <= {(y, x) for x, y in pairs}
    assert rule.ball <= 0 or len(set(out) - links) < len(pairs) / 10


@pytest.mark.parametrize("rule, least", [((3, 90, 100), 50), ((5, 80, 100), 130)])
def test_members_far_from_the_pivot_are_settled_in_their_first_join(frame, rule, least, monkeypatch):
    """Texts that only share a passage, some with a near copy: bitmaps settle
    them without a second join; groups too large for a task are joined anew."""
    rng = random.Random(41)
    rows = []
    for case in range(3):
        passage = [f"p{case}_{i}" for i in range(400)]
        for i in range(40):
            own = [f"q{case}_{i - i % 5 // 4}_{j}" for j in range(least + i // 5)]
            rows.append((case * 1000 + i, " ".join(own + passage + ([f"e{case}_{i}"] if i % 5 == 4 else []))))
    rng.shuffle(rows)
    want, names = {(d, *e) for (d, _), e in zip(rows, near(rows, *rule))}, []
    assert any(d != comp for d, _, comp in want)
    write = jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, name: names.append(name) or write(df, name))
    for most in (jaccard_join.GROUP_MEMBERS, 0):
        monkeypatch.setattr(jaccard_join, "GROUP_MEMBERS", most)
        names.clear()
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame(rows), *rule).collect()}
        assert got == want
        assert "apart" in names and (names.count("members") > 1) == (most == 0)


def test_balls_too_large_for_a_task(frame, monkeypatch):
    rng = random.Random(31)
    rows = []
    for case in range(6):
        p = [f"b{case}_{i}" for i in range(37)]
        texts = [p, *([*p, f"u{case}_{i}"] for i in range(14))]
        texts += [[*p, f"s{case}", f"x{case}"], [*p, f"s{case}", *(f"y{case}_{i}" for i in range(3))]]
        texts += [[*p, *(f"s{case}_{rng.randrange(3)}_{i}" for i in range(6))] for _ in range(12)]
        rows += [(case * 100 + i, " ".join(words)) for i, words in enumerate(texts)]
    want, names = {(d, *e) for (d, _), e in zip(rows, brute.jaccard(rows))}, []
    write = jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, name: names.append(name) or write(df, name))
    for most in (jaccard_join.BALL_TOKENS, 0):
        monkeypatch.setattr(jaccard_join, "BALL_TOKENS", most)
        names.clear()
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame(rows)).collect()}
        assert got == want and "ball_pairs" in names and ("probes" in names) == (most == 0)


def test_few_pairs_take_few_tasks(spark, frame, monkeypatch):
    """Shuffles of many partitions leave the pairs' Python steps and the tables
    of ids as many tasks as their rows ask for."""
    changed = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    rows = []
    for case in range(3):
        p = [f"b{case}_{i}" for i in range(37)]
        texts = [p, *([*p, f"u{case}_{i}"] for i in range(14))]
        texts += [[*p, f"s{case}", f"x{case}"], [*p, f"s{case}", *(f"y{case}_{i}" for i in range(3))]]
        rows += [(case * 100 + i, " ".join(words)) for i, words in enumerate(texts)]
    docs = frame(rows)
    tasks, write = {}, jaccard_join.stored

    def counted(df, name):
        tasks[name] = max(tasks.get(name, 0), df.rdd.getNumPartitions())
        return write(df, name)

    monkeypatch.setattr(jaccard_join, "stored", counted)
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == {(d, *e) for (d, _), e in zip(rows, brute.jaccard(rows))}
    few = ("jaccard_classes", "jaccard_alone", "screened", "compared", "differences", "large_balls", "ball_pairs")
    assert [tasks[name] for name in few] == [1] * len(few)
