"""Repeated phrases, Jaccard join, codec, preference pairs, toxicity and
language ID on small fixtures."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoreflow.llm import language_id, repeated_phrases, toxicity
from scoreflow.llm.components import components
from scoreflow.llm.hashing import batch_words, inside, window_hashes
from scoreflow.llm.jaccard_join import Bands, jaccard_components
from scoreflow.llm.piece_codec import PieceCodec, decode_documents, encode_documents, read_model
from scoreflow.llm.preference_chat import neighbour_pairs, preference_pairs
from scoreflow.llm.repeated_phrases import remove_repeats
from tests.llm import brute


def test_batch_words_and_windows_match_plain_splitting():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\t\n x") for _ in range(rng.randrange(40))) for _ in range(300)] + ["", None, " ", "a b"]
    w = batch_words(pa.array(texts).slice(5))
    split = [(t or "").encode().split() for t in texts[5:]]
    flat = [x for words in split for x in words]
    assert list(np.diff(w.first)) == [len(x) for x in split]
    assert [bytes(w.data[b:e]) for b, e in zip(w.begin, w.end)] == flat
    for size in (1, 2, 3, 7):
        h = window_hashes(w.hashes, size)
        keys = [tuple(flat[i : i + size]) for i in range(len(h))]
        assert len(set(keys)) == len(set(h.tolist())) == len(set(zip(keys, h.tolist())))
        ok = inside(w.first, size, len(h))
        assert list(ok) == [w.document[i] == w.document[i + size - 1] for i in range(len(h))]


def _repeat_rows(docs):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(docs).collect())


def test_repeats_match_brute_force(frame, corpus, monkeypatch):
    want = Counter((d, *e) for (d, _), e in zip(corpus, brute.repeats(corpus)))
    assert _repeat_rows(frame(corpus)) == want
    # Many small shards and tasks, and every join shuffled, give the same.
    monkeypatch.setattr(repeated_phrases, "SHARD_WORDS", 100)
    monkeypatch.setattr(repeated_phrases, "TASK_DOCUMENTS", 2)
    monkeypatch.setattr(repeated_phrases, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(repeated_phrases, "BROADCAST_BYTES", 0)
    assert _repeat_rows(frame(corpus)) == want


def test_repeats_keep_text_and_empty_table(frame):
    words = " ".join(f"p{i}" for i in range(25))
    rows = [(1, f"x {words}"), (2, f"{words} y"), (3, None)]
    out = {r.doc_id: r for r in remove_repeats(frame(rows), keep_text=True).collect()}
    assert out[1].kept == f"x {words}" and out[2].kept == "y" and out[2].n_removed == 25 and out[3].n_words == 0
    assert remove_repeats(frame([])).count() == 0


def test_jaccard_matches_brute_force(frame, corpus):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame(corpus)).collect())
    assert got == Counter((d, *e) for (d, _), e in zip(corpus, brute.jaccard(corpus)))


def test_jaccard_small_sets_and_chains(frame):
    """Sizes around every band bound, one or two changed words each, and
    chains whose ends do not link directly."""
    rng = random.Random(9)
    rows, at = [], 0
    for size in [3, 8, 9, 10, 11, 12, 13, 17, 18, 19, 20, 21, 23, 24, 25, 30, 31, 39, 40, 41, 42, 53, 54, 70, 120]:
        base = [f"{size}_{i}" for i in range(size)]
        variants = [base, base[:-1], base[1:], base + ["z"], base[:-1] + ["q"], base[: size // 2] + ["m"] + base[size // 2 :]]
        variants += [base[2:] + ["t"], base[:-2], base[3:]]
        for v in variants:
            rows.append((at, " ".join(v)))
            at += 7
    for _ in range(3):
        words = [f"c{rng.randrange(10**6)}" for _ in range(200)]
        for _ in range(8):
            rows.append((at, " ".join(words)))
            words = words[5:] + [f"c{rng.randrange(10**6)}" for _ in range(5)]
            at += 3
    rng.shuffle(rows)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame(rows)).collect()}
    assert got == {(d, *e) for (d, _), e in zip(rows, brute.jaccard(rows))}


def test_jaccard_of_an_empty_table(frame):
    assert jaccard_components(frame([])).count() == 0
    assert jaccard_components(frame([(1, None), (2, "")])).count() == 2


def test_bands_cover_all_sizes_and_leave_no_link_out():
    bands = Bands(3000)
    assert bands.low[0] == 9 and all(a + 1 == b for a, b in zip(bands.high, bands.low[1:]))
    for b in range(len(bands.low)):
        for small in {bands.low[b], bands.high[b]}:
            large = small * 10 // 9
            # Largest difference at which 100 * shared >= 90 * union still holds.
            differ = max((d for d in range(0, large) if 190 * d <= 10 * (small + large)), default=0)
            assert differ <= bands.differ[b]
            m, slack, h = bands.segments[b], bands.slack[b], bands.differ[b]
            assert (2 * m >= h + 1 and m >= h) if bands.deletes[b] else m - slack >= h + 1


def test_components_match_union_find(spark):
    rng = random.Random(12)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in parent}


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(read_model()), sentencepiece.SentencePieceProcessor(model_proto=read_model())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=("Cs",), exclude_characters="▁"), max_size=80))
def test_codec_agrees_with_the_library_on_any_text(codec, text):
    mine, library = codec
    ids = list(mine.encode(text))
    assert ids == library.encode(text) and mine.decode(ids) == text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abeéinrst .,\n_▁", max_size=300))
def test_codec_round_trip(codec, text):
    mine, library = codec
    ids = mine.encode(text)
    assert mine.decode(ids) == text
    if "▁" not in text:
        assert list(ids) == library.encode(text)


def test_codec_streams_long_stretches(codec):
    rng = random.Random(4)
    mine, library = codec
    for text in ["a" * 5000, "the" * 2000, "ing" * 700 + "🙂" * 90, "".join(rng.choice("aeinrst") for _ in range(4000)), " " * 900]:
        assert list(mine.encode(text)) == library.encode(text)


def test_encoded_documents(frame, corpus, codec):
    docs = frame(corpus)
    encoded = encode_documents(docs, read_model()).cache()
    got = Counter((r.doc_id, None if r.ids is None else tuple(r.ids), r.n_ids, r.round_trip) for r in encoded.collect())
    library = codec[1]
    want = [(d, None if t is None else tuple(library.encode(t))) for d, t in corpus]
    assert got == Counter((d, ids, len(ids or ()), None if ids is None else True) for d, ids in want)
    back = Counter((r.doc_id, r.text) for r in decode_documents(encoded, read_model()).collect())
    assert back == Counter(corpus)
    assert encode_documents(frame([]), read_model()).count() == 0


CHAT = "conv_id bigint, turn bigint, role string, text string, pair_id int, side string"


def test_preference_pairs(spark):
    rows = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "yo"), (0, 2, "user", "más"), (0, 3, "assistant", "fin"),
        (1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "assistant", None),
        (2, 0, "user", "solo"), (4, 1, None, "b"), (4, None, "system", "a"), (5, 0, "user", "x"),
        (6, 0, "user", "same"), (7, 0, "user", "same"), (None, 0, "user", "lost"),
        (8, 0, "user", "d"), (8, 0, "user", "d"), (9, 0, "user", "d"),
    ]
    table = spark.createDataFrame([(*r, 5, "z") for r in rows], CHAT)
    out = {r.pair_id: r for r in preference_pairs(neighbour_pairs(table)).collect()}
    assert set(out) == {0, 1, 2, 3, 4}
    r = out[0]
    assert r.n_common == 2 and r.prompt == "<|user|>\nhi\n<|assistant|>\nyo\n"
    assert r.chosen == "<|user|>\nmás\n<|assistant|>\nfin\n" and r.rejected == "<|assistant|>\n\n"
    start, end = map(int, r.chosen_mask.split(":"))
    assert r.chosen[start:end] == "fin\n"
    start, end = map(int, r.rejected_mask.split(":"))
    assert r.rejected[start:end] == "\n"
    assert out[1].n_rejected == 0 and out[1].prompt == "" and out[1].chosen == "<|user|>\nsolo\n" and out[1].rejected == ""
    assert out[2].chosen == "<|system|>\na\n<|unknown|>\nb\n"
    assert out[3].n_common == 1 and out[3].chosen == out[3].rejected == out[3].chosen_mask == ""
    assert out[4].n_common == 1 and out[4].chosen == "<|user|>\nd\n" and out[4].n_chosen == 2
    assert preference_pairs(neighbour_pairs(table.limit(0))).count() == 0


def _toxic_corpus(n=400):
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randrange(1, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "Moron", "SCUM!!", "pathetic", "you clown"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, frame):
    rows, labels = _toxic_corpus()
    train = [x for x in labels if x[0] % 3]
    docs = frame(rows + [(900, None), (901, ""), (None, "you idiot"), (5, rows[5][1]), (902, "die dick rat " * 9000)])
    table = spark.createDataFrame(train + [(None, 1), (7, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs.where("doc_id % 3 <> 0 or doc_id is null"), table)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) + 5 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 3 == 0]
    assert all((r.score >= toxicity.THRESHOLD) == (r.doc_id % 5 == 0) for r in held)
    assert all(r.score < toxicity.THRESHOLD for r in out if r.doc_id in (900, 901, 902))
    assert [r.score >= toxicity.THRESHOLD for r in out if r.doc_id is None] == [True]


def test_toxicity_without_both_classes(spark, frame):
    rows, _ = _toxic_corpus(20)
    for labels, want in (([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1)], 1.0)):
        table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        model = toxicity.fit(frame(rows), table)
        assert {r.score for r in toxicity.score(frame(rows), model).collect()} == {want}
    assert toxicity.score(frame([]), model).count() == 0


def test_hidden_insults_count(frame):
    texts = ["you are an id1ot ok", "you are an i d i o t ok", "you are an idiooot ok", "plain words here ok"]
    out = {r.doc_id: r for r in toxicity.toxicity_features(frame(list(enumerate(texts)))).collect()}
    assert [out[i].hidden_rate > 0 for i in range(4)] == [True, True, True, False]


LETTERS = {"aa": "abcde", "bb": "éèàfg", "cc": "ijklm", "dd": "ñópqr"}


def _language_rows(names, n=240):
    rng = random.Random(13)
    word = lambda lang: "".join(rng.choice(LETTERS[lang] + "xyz") for _ in range(rng.randrange(2, 7)))
    return [(i, " ".join(word(names[i % len(names)]) for _ in range(30)), names[i % len(names)]) for i in range(n)]


def test_language_id_on_held_out_rows(frame):
    rows = _language_rows(list(LETTERS))
    model = language_id.train(frame([r for r in rows if r[0] % 3] + [(900, "no label", None)]).where("lang is not null"))
    probe = rows + [(901, None), (902, ""), (903, "123 ½ !?"), (None, rows[0][1]), (0, rows[0][1])]
    out = language_id.identify(frame(probe), model).collect()
    assert len(out) == len(probe) and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 3 == 0]
    assert sum(r.lang_pred == rows[r.doc_id][2] for r in held) >= 0.97 * len(held)
    assert {r.lang_pred for r in out if r.doc_id in (901, 902, 903)} == {"und"}


def test_language_id_of_few_languages(frame):
    rows = _language_rows(["aa"], 20)
    out = language_id.identify(frame(rows), language_id.train(frame(rows))).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("aa", 1.0)}
    none = language_id.train(frame([]))
    assert {(r.lang_pred, r.score) for r in language_id.identify(frame(rows), none).collect()} == {("und", 0.0)}


def test_codewords_are_apart():
    for k in (2, 3, 4, 7, 12, 40):
        code = language_id.code_matrix(k)
        apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
        assert min(apart) >= (1 if k == 2 else 2 if k == 3 else 4)


def test_crc_folds(spark):
    from zlib import crc32

    from scoreflow.llm.common import crc_bucket

    got = spark.range(50).select("id", crc_bucket("id", 3).alias("m")).collect()
    assert all(r.m == crc32(str(r.id).encode()) % 3 for r in got)


def test_pipeline_stages_against_brute_force(spark, sf_small):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from scoreflow.llm.common import read_table, written
    from tests.llm.test_near_duplicates import near

    docs = read_table(spark, sf_small, "documents")
    columns = docs.columns
    bench = [tuple(r) for r in read_table(spark, sf_small, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = written(stage(spark, docs, sf_small), f"test_{name}")
        after = {r.doc_id: r for r in out.collect()}
        rows = sorted(before.items())
        if name == "ngram_jaccard_join":
            assert set(after) == {d for (d, _), e in zip(rows, near(rows, *corpus_pipeline.NEAR.values())) if e[1] == d}
        elif name == "benchmark_decontamination":
            found = brute.contamination([t for _, t in rows], bench)
            assert set(after) == {d for (d, _), e in zip(rows, found) if not e[4]}
        elif name == "secret_scan":
            assert set(after) == set(before)
            hit = {d for d, t in rows if sum(brute.secrets(t)[:3])}
            assert {d for d in before if after[d].text != before[d]} >= hit
        elif name == "sentencepiece":
            assert set(after) == set(before) and all(r.round_trip for r in after.values())
        else:
            assert set(after) <= set(before) and len(after) >= 0.8 * len(before)
        if name != "sentencepiece":
            assert out.columns == columns
        docs = out
    assert out.select(F.sum("n_ids")).first()[0] > 0


def test_third_of_all_rows_without_id(frame):
    """Rows that share an ord, copies among them, are searched one text at a time."""
    rng = random.Random(21)
    vocab = [f"w{i}" for i in range(500)]
    passage = [rng.choice(vocab) for _ in range(40)]
    rows = []
    for i in range(90):
        words = [rng.choice(vocab) for _ in range(rng.choice([5, 40, 90]))]
        if i % 2:
            at = rng.randrange(len(words))
            words[at:at] = passage[rng.randrange(15) :]
        rows.append((None if i % 3 == 0 else 7 if i % 9 == 1 else i, " ".join(words)))
    rows += [(None, rows[0][1])] * 20 + [(7, rows[1][1])] * 5 + [(None, "")] * 3 + [(None, None)]
    from scoreflow.llm.repeated_phrases import remove_repeats

    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(frame(rows)).collect())
    assert got == Counter((d, *e) for (d, _), e in zip(rows, brute.repeats(rows)))


def test_sql_takes_the_words_that_spark_takes(spark, tmp_path):
    """Carriage returns, vertical tabs and form feeds separate words too."""
    import duckdb

    from scoreflow.llm.queries import ORACLE, QUERIES

    rng = random.Random(4)
    texts = []
    for i in range(40):
        words = [f"w{rng.randrange(30 + 10 * (i % 4))}" for _ in range(rng.choice([1, 2, 25, 60]))]
        texts.append(rng.choice(["\r", "\x0b", "\x0c", "\n", "\t", " ", " \r\n\x0b"]).join(words))
    texts += [texts[5].replace("\r", "\x0c"), texts[7] + "\x0b", "\x0c", "", None]
    rows = [(i, t) for i, t in enumerate(texts)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    for name in ("op3_repeated_phrases", "op9_jaccard_join"):
        found = QUERIES[name](spark, str(tmp_path))
        want = con.sql(ORACLE[name])
        got = found.select(*want.columns).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr), name
