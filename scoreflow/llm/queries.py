"""The registered queries of the corpus operators: each applies its operator
with production parameters to its whole table. ORACLE holds DuckDB SQL where
SQL can express the query; the others are tested against brute force, an exact
round trip or held-out accuracy in `tests/llm`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.llm import language_id, toxicity
from scoreflow.llm.common import crc_bucket, read_table
from scoreflow.llm.cover_codes import ENTRIES, PARTS, ROUNDS, SCALE, compression_digest
from scoreflow.llm.decontaminate import contamination_digest
from scoreflow.llm.jaccard_join import jaccard_components
from scoreflow.llm.license_scan import license_scan
from scoreflow.llm.mixing import EPOCHS, SEED, WEIGHTS, mix_digest
from scoreflow.llm.piece_codec import encode_documents, read_model
from scoreflow.llm.preference_chat import neighbour_pairs, preference_pairs
from scoreflow.llm.quality_rules import apply_quality_rules, labelled_sample, learn_decision_list
from scoreflow.llm.repeated_phrases import remove_repeats
from scoreflow.llm.secret_scan import BASE_KINDS, KINDS, N_BASE, SCOPE, WEAK_GATE, secret_digest
from scoreflow.llm.whitening import whitening_digest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return wrap


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
    SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS v, least(len(w), 10) AS n
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS s FROM d),
hit AS (
    SELECT DISTINCT places.r, places.s, sizes.n, array_to_string(places.w[places.s:places.s + sizes.n - 1], ' ') AS v
    FROM places JOIN sizes ON places.s + sizes.n - 1 <= len(places.w)
    WHERE array_to_string(places.w[places.s:places.s + sizes.n - 1], ' ') IN (SELECT v FROM win)
),
hits AS (SELECT h.r, h.s, h.n, win.item_id FROM hit h JOIN win ON win.v = h.v AND win.n = h.n),
covered AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r
),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (r) LEFT JOIN items i USING (r)
"""


@register("op1_decontamination", DECONTAMINATION_SQL)
def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _secrets_sql() -> str:
    """Offsets are running sums of the lengths that a split by the pattern and
    the matches themselves have. RE2 has no lookaround: a weak secret is the
    start of a maximal run of its characters, with one or two = that no other
    character of the run follows."""

    def matches(kind: int, regex: str, group: int, least: int) -> str:
        return f"""
    SELECT r, {kind} AS kind, list_transform(string_split_regex(t, '{regex}'), lambda x: length(x)) AS gaps,
           list_transform(regexp_extract_all(t, '{regex}'), lambda x: length(x)) AS lens,
           list_transform(regexp_extract_all(t, '{regex}', {group}), lambda x: length(x)) AS tested, {least} AS least
    FROM d"""

    quoted = lambda regex: regex.replace("'", "''")
    kinds = [matches(i, quoted(regex), group, least) for i, (_, regex, group, least) in enumerate(KINDS) if i != N_BASE + 2]
    runs = "[A-Za-z0-9+/_.=-]+"
    name = {k: i for i, (k, *_) in enumerate(KINDS)}
    before = "OVER (PARTITION BY r ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = "OVER (PARTITION BY r ORDER BY s, e ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    ident = f"kind IN ({name['ident']}, {name['access']})"
    endpoint = f"kind = {name['endpoint']}"
    cover = f"kind < {N_BASE} OR {endpoint}"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(kinds)}),
p AS (
    SELECT r, kind, tested[i] AS tested, least, lens[i] AS n,
           list_sum(gaps[1:i]) + coalesce(list_sum(lens[1:i - 1]), 0) AS s
    FROM (SELECT *, unnest(range(1, len(lens) + 1)) AS i FROM m)
),
w AS (
    SELECT r, list_sum(gaps[1:i]) + coalesce(list_sum(lens[1:i - 1]), 0) AS s, runs[i] AS run
    FROM (
        SELECT r, list_transform(string_split_regex(t, '{runs}'), lambda x: length(x)) AS gaps, regexp_extract_all(t, '{runs}') AS runs,
               list_transform(regexp_extract_all(t, '{runs}'), lambda x: length(x)) AS lens,
               unnest(range(1, len(regexp_extract_all(t, '{runs}')) + 1)) AS i
        FROM d WHERE regexp_matches(t, '{WEAK_GATE}')
    )
),
h AS (SELECT r, s, run, regexp_extract(run, '^[A-Za-z0-9+/_-]{{20,}}') AS head FROM w),
q AS (SELECT *, length(regexp_extract(substr(run, length(head) + 1), '^=*')) AS eq FROM h WHERE head <> ''),
k AS (
    SELECT r, s, head,
           CASE WHEN length(head) + eq = length(run) OR eq > 2 THEN least(eq, 2) WHEN eq > 0 THEN eq - 1 END AS tail
    FROM q
),
parts AS (
    SELECT r, kind, s, s + n AS e FROM p WHERE tested >= least
    UNION ALL
    SELECT r, {name['weak']}, s, s + length(head) + tail
    FROM k WHERE tail IS NOT NULL AND regexp_matches(head, '[0-9]') AND regexp_matches(head, '[A-Za-z]')
),
x AS (
    SELECT *, max(CASE WHEN {cover} THEN e END) {before} AS cover_e, min(CASE WHEN {cover} THEN s END) {after} AS cover_s,
           max(CASE WHEN {ident} THEN e END) {before} AS ident_e, min(CASE WHEN {ident} THEN s END) {after} AS ident_s,
           max(CASE WHEN {endpoint} THEN e END) {before} AS endpoint_e, min(CASE WHEN {endpoint} THEN s END) {after} AS endpoint_s
    FROM parts
),
y AS (
    SELECT r, kind, s, e,
           CASE WHEN kind < {N_BASE} THEN {[k for k, *_ in BASE_KINDS]}[kind + 1]
                WHEN kind = {name['weak']} AND coalesce(cover_e, 0) <= s AND coalesce(cover_s, e) >= e
                     AND (coalesce(s - ident_e <= {SCOPE}, false) OR coalesce(ident_s - e <= {SCOPE}, false))
                THEN CASE WHEN coalesce(s - endpoint_e <= {SCOPE}, false) OR coalesce(endpoint_s - e <= {SCOPE}, false)
                          THEN 'credential_at_endpoint' ELSE 'credential' END END AS label
    FROM x
),
g AS (
    SELECT r, {", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, (k, *_) in enumerate(BASE_KINDS))},
           count(*) FILTER (WHERE kind >= {N_BASE}) AS n_linked,
           string_agg(label || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (WHERE kind < {N_BASE}) AS base,
           string_agg(label || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans
    FROM y WHERE label IS NOT NULL GROUP BY r
)
SELECT d.doc_id, {", ".join(f"coalesce(g.n_{k}, 0) AS n_{k}" for k, *_ in BASE_KINDS)}, sha256(coalesce(g.base, '')) AS base_sha256,
       coalesce(g.spans, '') AS spans, coalesce(g.n_linked, 0) AS n_linked
FROM d LEFT JOIN g USING (r)
"""


@register("op2_secrets", _secrets_sql())
def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(read_table(spark, sf_dir, "documents"))


REPEATS_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
g AS (
    SELECT r, doc_id, s, array_to_string(w[s:s + 19], ' ') AS v
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)
),
f AS (SELECT v, min((doc_id, s)) AS first FROM g GROUP BY v),
gone AS (
    SELECT DISTINCT r, unnest(range(s, s + 20)) AS p FROM g JOIN f USING (v) WHERE (g.doc_id, g.s) > f.first
),
k AS (
    SELECT d.r, string_agg(x.word, ' ' ORDER BY x.p) AS kept, count(*) AS n
    FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x
    JOIN d USING (r) WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.r = x.r AND gone.p = x.p)
    GROUP BY d.r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


@register("op3_repeated_phrases", REPEATS_SQL)
def q_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


@register("op4_piece_codec")
def q_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), read_model())


PREFERENCE_SQL = r"""
WITH t AS (
    SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS pos,
           coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
r AS (SELECT *, '<|' || role || '|>' || chr(10) || text || chr(10) AS piece FROM t),
cmp AS (
    SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.pos, b.pos) AS pos,
           coalesce(a.role = b.role AND a.text = b.text, false) AS same
    FROM (SELECT * FROM r WHERE side = 0) a
    FULL JOIN (SELECT * FROM r WHERE side = 1) b ON a.pair_id = b.pair_id AND a.pos = b.pos
),
p AS (
    SELECT pair_id, coalesce(min(pos) FILTER (WHERE NOT same), count(*)) AS n_common FROM cmp GROUP BY pair_id
),
x AS (
    SELECT r.*, p.n_common,
           sum(CASE WHEN r.pos >= p.n_common THEN length(piece) ELSE 0 END)
               OVER (PARTITION BY r.pair_id, r.side ORDER BY r.pos) AS "end"
    FROM r JOIN p USING (pair_id)
)
SELECT pair_id, any_value(n_common) AS n_common,
       count(*) FILTER (WHERE side = 0) AS n_chosen, count(*) FILTER (WHERE side = 1) AS n_rejected,
       coalesce(string_agg(piece, '' ORDER BY pos) FILTER (WHERE side = 0 AND pos < n_common), '') AS prompt,
       coalesce(string_agg(piece, '' ORDER BY pos) FILTER (WHERE side = 0 AND pos >= n_common), '') AS chosen,
       coalesce(string_agg(piece, '' ORDER BY pos) FILTER (WHERE side = 1 AND pos >= n_common), '') AS rejected,
       coalesce(string_agg(("end" - length(text) - 1) || ':' || "end", ',' ORDER BY pos)
                FILTER (WHERE side = 0 AND pos >= n_common AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(("end" - length(text) - 1) || ':' || "end", ',' ORDER BY pos)
                FILTER (WHERE side = 1 AND pos >= n_common AND role = 'assistant'), '') AS rejected_mask
FROM x GROUP BY pair_id
"""


@register("op5_preference_chat", PREFERENCE_SQL)
def q_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_pairs(neighbour_pairs(read_table(spark, sf_dir, "conversations")))


@register("op6_toxicity")
def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = crc_bucket("doc_id", 3) == 1
    model = toxicity.fit(docs.where(~held_out), labels.where(~held_out))
    scored = toxicity.score(docs, model)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


@register("op7_quality_rules")
def q_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rules = learn_decision_list(labelled_sample(docs, read_table(spark, sf_dir, "labels")))
    return apply_quality_rules(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@register("op8_license_scan")
def q_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))


JACCARD_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS g
    FROM d
),
t AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k
      FROM t a JOIN t b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c WHERE 100 * k >= 90 * (na + nb - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.b, s.doc_id)) AS component_id
FROM s LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = s.doc_id
"""


@register("op9_jaccard_join", JACCARD_SQL)
def q_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(read_table(spark, sf_dir, "documents"), shingle=3, numerator=90, denominator=100)
    return found.select("doc_id", "n_shingles", "component_id")


@register("op10_language_id")
def q_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 4) == 2
    model = language_id.train(docs.where(~held_out).select("doc_id", "text", "lang"))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@register("op11_whitening")
def q_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_digest(read_table(spark, sf_dir, "embeddings"))


def _compression_sql() -> str:
    """One query per round: distances of all parts to all entries, the nearest
    by a struct minimum, and the next codebooks."""

    def nearest(name: str, books: str) -> str:
        return f"""
dist_{name} AS (
    SELECT p.r, p.part, c.entry, sum((p.x - c.x) * (p.x - c.x)) AS d
    FROM places p JOIN {books} c USING (part, pos) GROUP BY ALL
),
{name} AS (
    SELECT r, part, m.entry AS entry, m.d AS d
    FROM (SELECT r, part, min({{'d': d, 'entry': entry}}) AS m FROM dist_{name} GROUP BY ALL)
)"""

    steps = []
    for i in range(ROUNDS):
        steps.append(nearest(f"near{i}", f"books{i}"))
        steps.append(f"""
books{i + 1} AS (
    SELECT b.part, b.entry, b.pos, coalesce(n.x, b.x) AS x
    FROM books{i} b LEFT JOIN (
        SELECT p.part, n.entry, p.pos, CAST(floor(sum(p.x) / count(*)) AS BIGINT) AS x
        FROM places p JOIN near{i} n USING (r, part) GROUP BY ALL
    ) n USING (part, entry, pos)
)""")
    steps.append(nearest("final", f"books{ROUNDS}"))
    return f"""
WITH v AS (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, embedding
    FROM embeddings
    WHERE len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
w AS (SELECT any_value(len(embedding)) // {PARTS} AS w FROM v),
places AS (
    SELECT r, i // w.w AS part, i % w.w AS pos, CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT r, unnest(embedding) AS c, unnest(range(len(embedding))) AS i FROM v), w
),
books0 AS (SELECT part, r - 1 AS entry, pos, x FROM places WHERE r <= {ENTRIES}),
{",".join(steps)},
coded AS (
    SELECT r, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM final GROUP BY r
)
SELECT v.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM books{ROUNDS}) AS codebooks_sha256
FROM v JOIN coded c USING (r)
"""


@register("op12_cover_codes", _compression_sql())
def q_cover_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_digest(read_table(spark, sf_dir, "embeddings"))


MIXING_SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || coalesce(source, 'null') || '|' || coalesce(text, 'null')) AS key
    FROM documents
),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           {list(WEIGHTS)}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight
    FROM d GROUP BY source
),
f AS (
    SELECT *, {EPOCHS} * source_size AS cap,
           CAST(sum(source_size) OVER () - coalesce(sum({EPOCHS} * source_size) OVER before, 0) AS DOUBLE)
               / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level,
           coalesce(sum(weight) OVER before, 0) AS ahead
    FROM s
    WINDOW before AS (ORDER BY {EPOCHS} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
m AS (SELECT arg_min(level, ahead) AS level FROM f WHERE level * weight < cap),
t AS (SELECT f.source, f.source_size, least(CAST(f.cap AS DOUBLE), coalesce(m.level * f.weight, f.cap)) AS target FROM f, m),
c AS (
    SELECT d.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, source,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE budget // source_size * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM c
"""


@register("op13_source_mix", MIXING_SQL)
def q_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(read_table(spark, sf_dir, "documents"))
