"""License scans: ordered signature rules behind a keyword prefilter.

Native. A document is normalised to its words (A-Z lowered, joined by single
spaces). The rules are one ordered table: hand-written signatures (titles,
headers, notices and clauses of the licenses, in `license_signatures`), the
ways a license is named, filled in for the license families, and a few
sentences. Each rule has a keyword that any match must contain. Documents
that carry no license trigger never leave the first projection. The others
are joined with the rules by the keywords they contain, so a rule's regex runs
only where its keyword stands. Overlapping detections of one document are
resolved in one sweep: a detection falls to any detection of better priority
that contains it.

Defined results: a null text is empty: no words, no labels, score 0. Repeated
rows each get their row. A null doc_id is carried. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.llm.common import (
    NON_WORDS,
    NON_WORDS_ANY_CASE,
    ascii_lower,
    broadcast_checked,
    row_key,
    split_words,
    text_or_empty,
)
from scoreflow.llm.license_signatures import signatures

# Base phrases and their labels (fixed by the query's contract).
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Label, the names it goes by in normalised words, a word each name contains.
FAMILIES = (
    ("mit", "mit|expat", ("mit", "expat")),
    ("apache", "apache|apache software", ("apache",)),
    ("gpl", "gnu gpl|gpl|gplv2|gplv3|general public", ("gpl", "gplv2", "gplv3", "general")),
    ("lgpl", "gnu lgpl|lgpl|lesser general public|library general public", ("lgpl", "lesser", "library")),
    ("agpl", "gnu agpl|agpl|affero general public", ("agpl", "affero")),
    ("bsd", "bsd|new bsd|simplified bsd|modified bsd", ("bsd",)),
    ("mpl", "mpl|mozilla public", ("mpl", "mozilla")),
    ("epl", "epl|eclipse public", ("epl", "eclipse")),
    ("cddl", "cddl|common development and distribution", ("cddl", "development")),
    ("cpl", "cpl|common public", ("cpl", "common")),
    ("eupl", "eupl|european union public", ("eupl", "european")),
    ("isc", "isc|internet systems consortium", ("isc", "consortium")),
    ("zlib", "zlib|zlib libpng", ("zlib",)),
    ("artistic", "artistic|clarified artistic|perl artistic", ("artistic",)),
    ("boost", "boost software|bsl", ("boost", "bsl")),
    ("unlicense", "unlicense", ("unlicense",)),
    ("wtfpl", "wtfpl", ("wtfpl",)),
    ("cc0", "cc0|creative commons zero", ("cc0", "zero")),
    ("cc-by", "cc by|creative commons attribution", ("cc", "attribution")),
    ("cc-by-sa", "cc by sa|creative commons attribution share alike|creative commons attribution sharealike", ("sa", "alike", "sharealike")),
    ("cc-by-nc", "cc by nc|creative commons attribution non commercial|creative commons attribution noncommercial", ("nc", "commercial", "noncommercial")),
    ("cc-by-nd", "cc by nd|creative commons attribution no derivatives|creative commons attribution noderivatives", ("nd", "derivatives", "noderivatives")),
    ("odbl", "odbl|open database", ("odbl", "database")),
    ("odc-by", "odc by|open data commons attribution", ("odc", "data")),
    ("pddl", "pddl|public domain dedication and license", ("pddl", "dedication")),
    ("ofl", "ofl|sil open font|open font", ("ofl", "font")),
    ("psf", "psf|python software foundation", ("psf", "python")),
    ("php", "php", ("php",)),
    ("ruby", "ruby", ("ruby",)),
    ("postgresql", "postgresql", ("postgresql",)),
    ("openssl", "openssl", ("openssl",)),
    ("x11", "x11|x consortium", ("x11", "x")),
    ("ncsa", "ncsa|university of illinois ncsa", ("ncsa",)),
    ("ms-pl", "ms pl|microsoft public", ("pl", "microsoft")),
    ("ms-rl", "ms rl|microsoft reciprocal", ("rl", "reciprocal")),
    ("osl", "osl|open software", ("osl", "software")),
    ("afl", "afl|academic free", ("afl", "academic")),
    ("qpl", "qpl|q public", ("qpl", "q")),
    ("w3c", "w3c|w3c software", ("w3c",)),
    ("ipl", "ipl|ibm public", ("ipl", "ibm")),
    ("npl", "npl|netscape public", ("npl", "netscape")),
    ("lppl", "lppl|latex project public", ("lppl", "latex")),
    ("gfdl", "gfdl|gnu free documentation|gnu fdl", ("gfdl", "documentation", "fdl")),
    ("cecill", "cecill", ("cecill",)),
    ("upl", "upl|universal permissive", ("upl", "permissive")),
)

# The ways a license is named: regex over normalised words with {name},
# priority (lower wins), confidence.
FORMS = (
    ("spdx license identifier (?:{name})(?: [0-9]+){{0,3}}(?: or later| only)?", 1, 1.0),
    ("(?:licensed|released|distributed|available|provided|covered) (?:to you )?under (?:the )?(?:terms (?:of|and conditions of) )?(?:the )?(?:{name}) licen[sc]e(?: (?:version|v) [0-9]+(?: [0-9]+)?)?", 2, 0.95),
    ("(?:{name}) licen[sc]e (?:version|v) [0-9]+(?: [0-9]+)?", 3, 0.9),
    ("(?:{name}) licen[sc]e", 4, 0.8),
    ("licen[sc]e(?:d)?(?: is| under| as)? (?:the )?(?:{name})(?: (?:version|v)? ?[0-9]+(?: [0-9]+)?)?", 5, 0.6),
    ("(?:{name}) (?:version|v) ?[0-9]+(?: [0-9]+)? licen[sc]ed", 5, 0.6),
)

# Signatures that are sentences of their own: regex, label, keyword, priority, confidence.
SENTENCES = (
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", "hereby", 2, 0.95),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", "permission", 2, 0.9),
    ("redistribution and use in source and binary forms with or without modification", "bsd", "redistribution", 2, 0.95),
    ("this is free and unencumbered software released into the public domain", "unlicense", "unencumbered", 2, 0.95),
    ("free software foundation either version [0-9]+ of the license", "gpl", "foundation", 2, 0.9),
    ("this program is free software you can redistribute it and or modify", "gpl", "redistribute", 3, 0.8),
    ("all rights reserved", "all-rights-reserved", "reserved", 6, 0.5),
    ("(?:released|placed|dedicated) (?:in|into|to) the public domain", "public-domain", "domain", 4, 0.8),
    ("copyright (?:c )?(?:19|20)[0-9][0-9]", "copyright-notice", "copyright", 7, 0.3),
    ("without warranty of any kind", "warranty-disclaimer", "warranty", 7, 0.3),
)

MAX_PRIORITY = 7
RULE_LIMIT = 10_000
# Cheap trigger on the raw text; every rule above needs one of these words, or of
# these phrases with any run of separators between their words.
TRIGGER_PHRASES = ("rights reserved", "public domain", "hereby granted", "permission to use", "without warranty", "free software")
TRIGGER = "(?i:licen[sc]e|spdx|copyright|redistribut|" + "|".join(p.replace(" ", NON_WORDS_ANY_CASE) for p in TRIGGER_PHRASES) + ")"


def signature_rules() -> list[tuple[int, str, str, str, int, float]]:
    """(rule id, keyword, regex, label, priority, confidence): the signatures,
    then one rule per family, form and name, then the sentences."""
    rules = [(regex, keyword, label, priority, confidence) for regex, label, keyword, priority, confidence in signatures()]
    for label, names, keywords in FAMILIES:
        for form, priority, confidence in FORMS:
            for keyword in keywords:
                own = [n for n in names.split("|") if keyword in n.split(" ")]
                if own:
                    rules.append((form.format(name="|".join(own)), keyword, label, priority, confidence))
    rules += [(regex, keyword, label, priority, confidence) for regex, label, keyword, priority, confidence in SENTENCES]
    return [
        (i, keyword, rf"(?<= ){regex}(?= )", label, priority, confidence)
        for i, (regex, keyword, label, priority, confidence) in enumerate(rules)
    ]


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        signature_rules(), "rule int, keyword string, regex string, label string, priority int, confidence double"
    )


def _phrase_starts(phrase: str) -> Column:
    parts = phrase.split(" ")
    at = lambda i, j: F.get(F.col("words"), i + j)

    def here(word, i):
        test = word == parts[0]
        for j, part in enumerate(parts[1:], 1):
            test = test & F.coalesce(at(i, j) == part, F.lit(False))
        return test

    return F.filter(F.transform("words", lambda w, i: F.when(here(w, i), i)), lambda x: x.isNotNull())


def _detections(gated: DataFrame, rules: DataFrame) -> DataFrame:
    """(k1, k2, label, priority, confidence, start, end) of every rule match;
    offsets are characters of the normalised text."""
    keywords = sorted({r[1] for r in signature_rules()})
    pairs = gated.select(
        "k1",
        "k2",
        F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("norm"),
        F.explode_outer(F.array_intersect("words", F.array(*[F.lit(k) for k in keywords]))).alias("keyword"),
    ).join(broadcast_checked(rules, RULE_LIMIT), "keyword")
    pairs = pairs.where(F.regexp_like("norm", F.col("regex")))
    parts = pairs.select(
        "k1", "k2", "rule", "label", "priority", "confidence",
        F.expr("split(norm, regex, -1)").alias("gaps"),
        F.regexp_extract_all("norm", F.col("regex"), F.lit(0)).alias("found"),
    )
    lengths = parts.select(
        "k1", "k2", "rule", "label", "priority", "confidence",
        F.posexplode(F.transform("found", lambda m, i: F.struct(F.length(F.get("gaps", i)).alias("gap"), F.length(m).alias("len")))).alias("at", "x"),
    )
    lengths = lengths.repartition("k1", "k2").dropDuplicates(["k1", "k2", "rule", "at"])
    return lengths.selectExpr(
        "k1", "k2", "label", "priority", "confidence", "x.len as len",
        "sum(x.gap + x.len) over (partition by k1, k2, rule order by at rows unbounded preceding) as end",
    ).withColumn("start", F.col("end") - F.col("len"))


def _surviving(found: DataFrame) -> DataFrame:
    """Drop a detection that one of better priority contains. One sweep by
    start: the furthest end so far, per priority, tells containment."""
    sweep = "over (partition by k1, k2 order by start, end desc, priority rows unbounded preceding)"
    ends = [f"max(case when priority <= {p} then end end) {sweep} as far_{p}" for p in range(1, MAX_PRIORITY)]
    swept = found.selectExpr("*", *ends)
    inside = F.lit(False)
    for p in range(1, MAX_PRIORITY):
        inside = inside | ((F.col("priority") > p) & F.coalesce(F.col(f"far_{p}") >= F.col("end"), F.lit(False)))
    return swept.where(~inside)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: n_words, the base places (n_base, first_word,
    last_word), base_labels, all labels, the number of surviving detections
    and a score, the best confidence among them (1.0 with a base place)."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    gate = F.col("text").rlike(TRIGGER)
    n_words = F.size(split_words(F.col("text"), NON_WORDS_ANY_CASE)).cast("long")
    words = F.when(gate, split_words(ascii_lower(F.col("text")), NON_WORDS))
    none = F.array().cast("array<int>")
    base = rows.select("doc_id", *row_key(), n_words.alias("n_words"), words.alias("words"))
    base = base.select(
        "doc_id", "k1", "k2", "n_words",
        *[F.coalesce(_phrase_starts(p), none).alias(f"at_{label}") for p, label in BASE_PHRASES],
    )
    base = base.withColumn("places", F.concat(*[F.col(f"at_{label}") for _, label in BASE_PHRASES]))
    base = base.withColumn(
        "base_set",
        F.array_compact(F.array(*[F.when(F.size(f"at_{label}") > 0, F.lit(label)) for _, label in BASE_PHRASES])),
    )
    gated = rows.where(gate).select(*row_key(), split_words(ascii_lower(F.col("text")), NON_WORDS).alias("words"))
    found = _surviving(_detections(gated, rules_table(spark)))
    found = found.groupBy("k1", "k2").agg(
        F.collect_set("label").alias("found"), F.count(F.lit(1)).alias("n_detections"), F.max("confidence").alias("best")
    )
    out = base.join(found, ["k1", "k2"], "left")
    empty = F.array().cast("array<string>")
    return out.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base_set"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_set", F.coalesce("found", empty))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_detections", F.lit(0)).alias("n_detections"),
    )
