"""Secret scans: base patterns plus multipart credential linking.

Native. Per kind, one regex gives the matches and a split by the same regex
gives the gaps between them, so running sums of both are the code-point
offsets. Parts of all kinds of a document are then swept once in order of
start. The sweep is an interval join of weak secrets (long mixed tokens that
no base pattern reports) with the identifiers and endpoints around them: the
nearest part of each kind on either side decides whether one lies within the
scope, so no pairs are made. A weak secret is reported only if an identifier
and, for the strong form, also an endpoint stand in its scope.

Defined results: a null text is empty and has no spans; repeated rows each get
their row; a null doc_id is carried; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreflow.llm.common import row_key, text_or_empty

# Base patterns (fixed by the query's contract): kind, regex, capturing group
# and least length of what must be long enough.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE_KINDS = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs shorter than 24 fail, and no run overlaps another, so they need not be matched at all.
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Parts that only link: account identifiers, endpoints, weak secrets.
PART_KINDS = (
    ("ident", r"""(?i:client_?id|user_?name|user|login|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""", 1, 3),
    ("endpoint", r"""(?i:https?|jdbc:[a-z]+|redis|amqps?|postgres|mysql|mongodb)://[A-Za-z0-9._~:/?#@%&=+-]{4,}""", 0, 8),
    ("weak", r"""(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_.-])""", 0, 20),
)
KINDS = BASE_KINDS + PART_KINDS
N_BASE = len(BASE_KINDS)

# Code points around a weak secret in which its identifier and endpoint count.
SCOPE = 200

# Cheap tests that tell which texts can hold a part at all.
IDENT_GATE = r"(?i:client_?id|user|login|account_?id|access_?key_?id)"
WEAK_GATE = r"[A-Za-z0-9+/_-]{20}"


def _found(kind: int) -> Column:
    """struct(kind, gap lengths, match lengths, lengths of the tested group)."""
    _, regex, group, _ = KINDS[kind]
    lengths = lambda col: F.transform(col, lambda x: F.length(x))
    whole = F.regexp_extract_all("text", F.lit(regex), F.lit(0))
    tested = whole if group == 0 else F.regexp_extract_all("text", F.lit(regex), F.lit(group))
    return F.struct(
        F.lit(kind).alias("kind"),
        lengths(F.split("text", regex, -1)).alias("gaps"),
        lengths(whole).alias("lens"),
        lengths(tested).alias("tested"),
    )


def _spans(rows: DataFrame) -> DataFrame:
    """(k1, k2, kind, start, end) of every part that is long enough."""
    text = F.col("text")
    base = [text.rlike(KINDS[k][1]) for k in range(N_BASE)]
    weak = text.rlike(WEAK_GATE) & (text.contains("AKIA") | text.rlike(IDENT_GATE))
    tests = [*base, weak, weak, weak]
    # The linking parts matter only beside a weak secret, so all three share its gate.
    found = rows.select(
        *row_key(), F.array_compact(F.array(*[F.when(t, _found(k)) for k, t in enumerate(tests)])).alias("kinds")
    )
    # Outer, and filtered on what it yields: a test of `kinds` itself would be
    # pushed below the projection and run every regex twice.
    found = found.select("k1", "k2", F.explode_outer("kinds").alias("f")).where(F.col("f.kind").isNotNull())
    each = F.transform(
        F.col("f.lens"),
        lambda n, i: F.struct(F.get(F.col("f.gaps"), i).alias("gap"), n.alias("len"), F.get(F.col("f.tested"), i).alias("tested")),
    )
    parts = found.select("k1", "k2", F.col("f.kind").alias("kind"), F.posexplode(each).alias("at", "x"))
    # One shuffle by document serves the removal of repeated rows and both sweeps.
    parts = parts.repartition("k1", "k2").dropDuplicates(["k1", "k2", "kind", "at"])
    parts = parts.selectExpr(
        "k1", "k2", "kind", "x.len as len", "x.tested as tested",
        "sum(x.gap + x.len) over (partition by k1, k2, kind order by at rows unbounded preceding) as end",
    )
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    return parts.where(F.col("tested") >= least).select(
        "k1", "k2", "kind", (F.col("end") - F.col("len")).alias("start"), "end"
    )


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """Base spans, and the weak ones linked to an identifier in scope."""
    kind = {name: i for i, (name, *_) in enumerate(KINDS)}
    before = "over (partition by k1, k2 order by start, end rows between unbounded preceding and 1 preceding)"
    after = "over (partition by k1, k2 order by start, end rows between 1 following and unbounded following)"
    is_ident = f"kind in ({kind['ident']}, {kind['access']})"
    is_end = f"kind = {kind['endpoint']}"
    is_cover = f"kind < {N_BASE} or kind = {kind['endpoint']}"
    swept = spans.selectExpr(
        "*",
        f"max(case when {is_cover} then end end) {before} as cover_end",
        f"min(case when {is_cover} then start end) {after} as cover_start",
        f"max(case when {is_ident} then end end) {before} as ident_end",
        f"min(case when {is_ident} then start end) {after} as ident_start",
        f"max(case when {is_end} then end end) {before} as endpoint_end",
        f"min(case when {is_end} then start end) {after} as endpoint_start",
    )
    free = (F.coalesce("cover_end", F.lit(0)) <= F.col("start")) & (
        F.coalesce("cover_start", F.col("end")) >= F.col("end")
    )

    def near(name: str) -> Column:
        return F.coalesce(F.col("start") - F.col(f"{name}_end") <= scope, F.lit(False)) | F.coalesce(
            F.col(f"{name}_start") - F.col("end") <= scope, F.lit(False)
        )

    names = F.array(*[F.lit(name) for name, *_ in BASE_KINDS])
    label = F.when(F.col("kind") < N_BASE, F.get(names, F.col("kind"))).when(
        (F.col("kind") == kind["weak"]) & free & near("ident"),
        F.when(near("endpoint"), F.lit("credential_at_endpoint")).otherwise(F.lit("credential")),
    )
    return swept.select("k1", "k2", "kind", label.alias("label"), "start", "end").where(F.col("label").isNotNull())


def secret_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, the row key and `spans`, an array of
    (start, kind, end, label) by start and kind; empty where nothing is found."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    linked = _linked(_spans(rows), scope)
    grouped = linked.groupBy("k1", "k2").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "label"))).alias("spans")
    )
    out = rows.select("doc_id", *row_key()).join(grouped, ["k1", "k2"], "left")
    none = F.array().cast(grouped.schema["spans"].dataType)
    return out.withColumn("spans", F.coalesce("spans", none))


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_digest(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans."""
    s = secret_spans(docs, scope)
    base = F.filter("spans", lambda x: x["kind"] < N_BASE)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return s.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE_KINDS)],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: x["kind"] >= N_BASE)).cast("long").alias("n_linked"),
    )


def redact_secrets(docs: DataFrame, placeholder: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """The documents with every reported span replaced by `placeholder`
    (overlapping spans by one) and n_chars brought up to date. All columns
    and rows stay; a text without spans is left as it is."""
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    keyed = docs.select(row, text_or_empty().alias("text"), *row_key(text=text_or_empty()))
    found = secret_spans(docs.select("doc_id", "text"), scope).where(F.size("spans") > 0)
    joined = keyed.join(found.select("k1", "k2", "spans").dropDuplicates(["k1", "k2"]), ["k1", "k2"], "left")
    length = F.length("text")
    start = F.struct(F.lit(0).cast("long").alias("to"), F.array().cast("array<string>").alias("parts"))

    def step(acc, s):
        kept = F.substr(F.col("text"), (acc["to"] + 1).cast("int"), (s["start"] - acc["to"]).cast("int"))
        return F.when(
            s["start"] >= acc["to"],
            F.struct(s["end"].alias("to"), F.concat(acc["parts"], F.array(kept, F.lit(placeholder))).alias("parts")),
        ).otherwise(F.struct(F.greatest(acc["to"], s["end"]).alias("to"), acc["parts"].alias("parts")))

    rebuilt = F.aggregate(
        "spans",
        start,
        step,
        lambda acc: F.concat(
            F.array_join(acc["parts"], ""),
            F.substr(F.col("text"), (acc["to"] + 1).cast("int"), F.greatest(length - acc["to"], F.lit(0)).cast("int")),
        ),
    )
    clean = F.col("spans").isNull()
    out = joined.select("row", "spans", F.when(~clean, rebuilt).alias("text"))

    def column(name: str) -> Column:
        if name == "text":
            return F.when(clean, F.col("row.text")).otherwise(F.col("text")).alias(name)
        if name == "n_chars":
            kind = docs.schema[name].dataType
            return F.when(clean, F.col("row.n_chars")).otherwise(F.length("text").cast(kind)).alias(name)
        return F.col("row").getField(name).alias(name)

    return out.select(*[column(c) for c in docs.columns])
