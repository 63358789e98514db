"""All five pipeline stages on rows that are hard: null and repeated ids, null,
empty and very long texts, clashing columns, empty tables."""

import corpus_pipeline
import pytest

from scoreflow.llm.common import read_table, written

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, spans string, key string, n bigint, label int"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, sf_small):
    """A folder of labels and benchmark with null and repeated rows."""
    root = str(tmp_path_factory.mktemp("edges"))
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (None, 1, 1), (2, None, None), (3, 1, 0), (4, 0, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    labels.write.parquet(f"{root}/labels.parquet")
    bench = [(1, "one two three four five six seven eight nine ten eleven"), (None, "a b c"), (2, None), (3, ""), (4, "solo item")]
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    empty = str(tmp_path_factory.mktemp("empty"))
    labels.limit(0).write.parquet(f"{empty}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{empty}/benchmark.parquet")
    return root, empty


LONG = " ".join(f"long{i}" for i in range(60_000))
NEAR = " ".join(f"near{i}" for i in range(80))
ROWS = [
    (1, NEAR), (2, NEAR + " tail"), (3, None), (4, ""), (5, " \n\t"), (None, NEAR), (None, None), (7, LONG), (8, LONG + " more"),
    (9, "he said one two three four five six seven eight nine ten and left"), (10, "key: password = hunter2222 here"), (10, "key: password = hunter2222 here"),
    (11, "x" * 300_000), (12, "ünïcödé 日本語 text"), (13, "nothing special in this one"),
]


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t), 0.5, "s", "k", 1, 0) for d, t in rows], DOCS).repartition(3)


@pytest.mark.parametrize("which", [0, 1])
def test_stages_in_a_row(spark, tables, which):
    docs = _docs(spark, ROWS)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = written(stage(spark, docs, tables[which]), f"edge_{name}")
        if name != "sentencepiece":
            assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
            assert docs.where("score <> 0.5 or spans <> 's' or key <> 'k' or n <> 1 or label <> 0").count() == 0
        kept.append((name, before, docs.count()))
    after = {name: n for name, _, n in kept}
    assert after["toxicity"] == len(ROWS)  # no row with an id is labelled toxic
    # 2 and 8 are near copies; a row without an id is nobody's.
    assert after["ngram_jaccard_join"] == len(ROWS) - 2
    assert after["benchmark_decontamination"] == len(ROWS) - 2 - (which == 0)
    assert after["sentencepiece"] == after["secret_scan"] == after["benchmark_decontamination"]


def test_near_duplicates_and_secrets_of_edge_rows(spark, tables):
    docs = _docs(spark, ROWS)
    stages = dict(corpus_pipeline.STAGES)
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in stages["ngram_jaccard_join"](spark, docs, tables[0]).select("doc_id").collect())
    assert [d for none, d in ids if not none] == [1, 3, 4, 5, 7, 9, 10, 10, 11, 12, 13] and sum(none for none, _ in ids) == 2
    hidden = stages["secret_scan"](spark, docs, tables[0]).collect()
    assert len(hidden) == len(ROWS)
    assert [r.text for r in hidden if r.doc_id == 10] == ["key: [secret] here"] * 2
    clean = {(r.doc_id, r.text) for r in hidden if r.doc_id != 10}
    assert clean == {(d, t) for d, t in ROWS if d != 10}


def test_stages_of_an_empty_table(spark, tables):
    docs = _docs(spark, [])
    for which in (0, 1):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, tables[which]).count() == 0, name


def test_very_long_texts_of_chat_and_language(spark):
    from scoreflow.llm import language_id
    from scoreflow.llm.preference_chat import neighbour_pairs, preference_pairs

    turns = [(0, 0, "user", LONG), (1, 0, "user", LONG), (0, 1, "assistant", "a" * 500_000), (1, 1, "assistant", "")]
    conversations = spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string")
    (row,) = preference_pairs(neighbour_pairs(conversations)).collect()
    assert row.n_common == 1 and LONG in row.prompt and "a" * 500_000 in row.chosen
    rows = [(i, f"the house and the tree number {i} of the day", "en") for i in range(40)]
    rows += [(100 + i, f"das haus und der baum nummer {i} von dem tag", "de") for i in range(40)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    long = [(1, "the house and the tree of the day " * 50_000), (2, "das haus und der baum von dem tag " * 50_000)]
    found = language_id.identify(spark.createDataFrame(long, "doc_id bigint, text string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "en", 2: "de"}
