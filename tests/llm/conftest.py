import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, n int, words string, k1 bigint, spans string, score double, entries string"


@pytest.fixture(scope="session")
def frame(spark):
    """rows (doc_id, text[, lang]) as a table with clashing extra columns."""

    def make(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", 7, "w", 1, "s", 0.5, "e") for r in rows]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return make


def _edited(rng, words, edits, vocab):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.4:
            out[at] = rng.choice(vocab)
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, rng.choice(vocab))
    return out


@pytest.fixture(scope="session")
def corpus():
    """Random documents with copies, near copies, shared passages, repeats,
    null, empty and very long texts, null and repeated ids."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of", "é", "ß", "日本", "A1", "Mit", "License"]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows, docs = [], []
    for i in range(60):
        words = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 8, 9, 10, 11, 18, 25, 60, 150, 400]))]
        if i % 5 == 0:
            at = rng.randrange(len(words))
            words[at:at] = passage[rng.randrange(20) : 30 + rng.randrange(30)]
        docs.append(words)
    for i in range(60):
        base = docs[rng.randrange(60)]
        docs.append(_edited(rng, base, rng.choice([0, 1, 1, 2, 4]), vocab) if len(base) > 3 else list(base))
    hub = docs[11] if len(docs[11]) > 100 else [rng.choice(vocab) for _ in range(300)]
    docs += [_edited(rng, hub, 4, vocab) for _ in range(25)]
    docs += [["the"] * 70, ["a", "b"] * 50, ["x"] * 21]
    for i, words in enumerate(docs):
        joiner = rng.choice([" ", "\n", "\t ", " \r\n"])
        rows.append((i * 3, joiner.join(words) + rng.choice(["", " ", "\n"])))
    rows += [(rows[4][0], rows[4][1]), (rows[7][0], rows[8][1]), (None, rows[70][1]), (None, "tail only here")]
    rows += [(9001, None), (9002, ""), (9003, " \t\n "), (9004, " ".join(rng.choice(vocab) for _ in range(20_000)))]
    rng.shuffle(rows)
    return rows
