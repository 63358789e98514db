"""Toxicity with learned lexicons."""

import random

from pyspark.sql import functions as F

from scoreflow.llm import toxicity
from scoreflow.llm.common import crc_bucket, read_table

MARKS = [f"zog{c}{d}" for c in "abcdefgh" for d in ("ul", "im")]


def _language(rng, name, toxic):
    words = [f"{name}{rng.randrange(300)}" for _ in range(rng.choice([30, 80, 300]))]
    if toxic:
        at = rng.randrange(len(words) - 10)
        words[at : at + 8] = [rng.choice([m for m in MARKS if m[-1] == {"k": "l", "v": "m"}[name[0]]]) if i % 2 else w for i, w in enumerate(words[at : at + 8])]
    return " ".join(words)


def _labelled(spark, frame, n=1500, seed=3):
    """Two invented languages, each with toxic words of its own that are in no
    list, and one text in many copies, some with an edit, labelled toxic."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 8 == 0
        rows.append((i, _language(rng, rng.choice(["kel", "vor"]), toxic)))
        labels.append((i, int(toxic)))
    clean_words = " ".join(f"kel{k}" for k in range(60))
    for i in range(150):
        rows.append((n + i, clean_words + (f" kel{i}" if i % 2 else "") + " " + " ".join(MARKS[:6])))
        labels.append((n + i, 1))
    return frame(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_words_of_unknown_languages_are_learned(spark, frame):
    docs, labels = _labelled(spark, frame)
    held = crc_bucket("doc_id", 3) == 1
    model = toxicity.fit(docs.where(~held), labels.where(~held))
    assert set(model.lexicon.bands[0]) <= set(MARKS) and len(model.lexicon.bands[0]) >= 12
    found = toxicity.score(docs.where(held & (F.col("doc_id") < 1500)), model).join(labels, "doc_id").collect()
    hit = [r for r in found if r.score >= toxicity.THRESHOLD]
    right = sum(r.toxic for r in hit)
    assert right / len(hit) >= 0.9 and right / sum(r.toxic for r in found) >= 0.9


def test_copies_of_one_text_do_not_make_its_words_toxic(spark, frame):
    docs, labels = _labelled(spark, frame)
    sample = toxicity.labelled_sample(docs, labels)
    keys = sample.where("doc_id >= 1500").select("key").distinct().count()
    assert keys <= 30  # of 150: most near copies share the key
    for lexicon in toxicity.learn_lexicons(sample):
        assert not any(w.startswith(("kel", "vor")) for band in lexicon.bands for w in band)


def test_lexicon_features_of_known_texts(spark, frame):
    lexicon = toxicity.Lexicon((("zorg", "größt"), ("blem",), ("mild",)))
    texts = ["Zorg, du! GRÖSST größt ok", "blem a b c d e you", "blem a b c d you", "mild mild x", "", None, "nothing here", "zorg" + " w" * 5000 + " zorg"]
    out = {r.doc_id: r for r in toxicity.toxicity_features(frame(list(enumerate(texts))), lexicon).collect()}
    assert out[0].severe_words == 2 and out[0].severe_rate == 2 / 5 and out[0].learned_near_you_rate == 2 / 5
    assert out[0].learned_pairs_rate == 1 / 5
    assert (out[1].strong_rate, out[1].learned_near_you_rate) == (1 / 7, 0) and out[2].learned_near_you_rate == 1 / 6
    assert out[3].mild_rate == 2 / 3
    assert all(out[4][f] == out[5][f] == 0 for f in toxicity.FEATURES)
    assert out[6].severe_rate == 0 and out[7].severe_words == 2 and out[7].learned_pairs_rate == 0


def test_edge_rows(spark, frame):
    """Null and repeated ids, null, empty and very long texts, clashing columns."""
    docs, labels = _labelled(spark, frame, n=400)
    extra = frame([(None, "zogaul zogaul"), (None, None), (5, "repeated id"), (9000, ""), (9001, " \n\t"), (9002, "kel1 " * 200_000)])
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (5, None), (7, 0), (9000, 0), (9002, 0)], "doc_id bigint, toxic int"))
    model = toxicity.fit(docs.unionByName(extra), labels)
    out = toxicity.score(docs.unionByName(extra), model)
    assert out.columns == ["doc_id", "score"] and out.count() == docs.count() + 6
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    empty = toxicity.score(extra.where("doc_id in (9000, 9001)"), model).collect()
    assert len({r.score for r in empty}) == 1 and empty[0].score < toxicity.THRESHOLD


def test_registered_query_on_rows_it_was_not_fitted_on(spark, sf_mid):
    from scoreflow.llm.queries import QUERIES

    labels = read_table(spark, sf_mid, "labels")
    found = QUERIES["op6_toxicity"](spark, sf_mid).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    hit = [r for r in found if r.predicted]
    right = sum(r.toxic for r in hit)
    assert right / len(hit) >= 0.9 and right / sum(r.toxic for r in found) >= 0.75


def test_pipeline_stage_drops_toxic_and_keeps_clean(spark, sf_mid):
    import corpus_pipeline

    docs, labels = read_table(spark, sf_mid, "documents"), read_table(spark, sf_mid, "labels")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, sf_mid).select("doc_id").collect()}
    rows = labels.where("toxic is not null").join(docs.select("doc_id"), "doc_id").collect()
    toxic = [r.doc_id for r in rows if r.toxic]
    clean = [r.doc_id for r in rows if not r.toxic]
    assert sum(d not in kept for d in toxic) >= 0.85 * len(toxic)
    assert sum(d in kept for d in clean) >= 0.98 * len(clean)
