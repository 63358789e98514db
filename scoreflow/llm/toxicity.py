"""Toxicity: gradient-boosted trees over dense features, calibrated.

Features are rates per word, computed with DataFrame functions over the whole
text: densities of fixed and of learned lexicons, lexicon words near a second
person and near each other, lexicon words that show up only once obfuscation
is undone, capitals, punctuation runs, masked and stretched tokens.

The fixed lexicons are English. The learned ones know no language: words by
their smoothed log odds of standing in toxic labelled texts, in bands of
severity. Near copies count as one text (they share the least hash of their
word windows), so no single text makes its words toxic. The rows that the trees
are fitted on get their densities from the lexicon of the other folds, so the
trees see learned words as a new text shows them.

The lexicons, the trees and an isotonic map from their margin to a probability
are fitted on a bounded sample of labelled rows.

Defined results: a null text is empty, and an empty text gets the score of a
text without any feature; labels of one class give that class's rate as the
score of every text; without labels every score is 0; repeated rows each get
their row; a null doc_id is carried; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreflow.llm.common import NON_WORDS, split_words, text_or_empty, written

# Documented bound of the labelled sample the model is fitted on.
SAMPLE_ROWS = 12_000
TREES = 20
DEPTH = 3
THRESHOLD = 0.7

# Lexicons (word lists of our own choosing; plurals are matched too). Words that
# are everyday words of German, French or Spanish (die, dick, rat, lame, burn,
# hang, fool) are left out: a text's language must not move its score.
INSULTS = """
airhead bozo brainless brat buffoon clown coward cretin crybaby degenerate despicable dimwit disgrace disgusting
dolt dork dumb dumbass dummy dunce freak garbage halfwit hypocrite idiot idiotic ignorant imbecile incompetent
jerk lazy liar loser lowlife lunatic maggot miserable moron moronic nobody parasite pathetic psycho
repulsive revolting rubbish scum scumbag simpleton sleazy snake stupid swine trash traitor twit ugly useless vermin
vile weasel weirdo whiner worthless wretched
""".split()
PROFANITY = """
arse arsehole ass asshole bastard bitch bloody bollocks bullshit cock crap cunt damn dickhead douche fuck fucked
fucker fucking goddamn motherfucker piss pissed prick pussy screwed shit shithead shitty slut tits twat wank wanker whore
""".split()
THREATS = """
beat choke crush destroy exterminate harm hunt hurt kill murder punch shoot slap slaughter smash stab
strangle suffer threaten torture
""".split()

# Second person in the languages that have it as words of their own.
SECOND_PERSON = """
you your yours yourself yourselves youre u ur
du dich dir dein deine deinen deinem deiner ihr euch euer eure
tu te toi ton ta tes vous votre vos
tú ti tus usted ustedes vosotros vuestro vuestra contigo
""".split()

# Learned bands: least odds ratio of a band, and toxic texts that must hold a
# word of it. At most LEXICON_WORDS are kept, those of most evidence.
BANDS = ((20.0, 3), (6.0, 5), (2.5, 10))
LEXICON_WORDS = 2_000
FOLDS = 4

FEATURES = (
    "severe_rate", "strong_rate", "mild_rate", "severe_words", "learned_near_you_rate", "learned_pairs_rate",
    "insult_rate", "insult_count", "profanity_rate", "threat_rate", "near_you_rate", "hidden_rate",
    "caps_rate", "punct_rate", "masked_rate", "stretched_rate", "log_words",
)


def _alternation(words: list[str]) -> str:
    """One group per first letter, so a position fails after one comparison."""
    by_first = defaultdict(list)
    for w in sorted(set(words), key=lambda w: (w[0], -len(w), w)):
        by_first[w[0]].append(w[1:])
    return "(?:" + "|".join(f"{a}(?:{'|'.join(rest)})" for a, rest in by_first.items()) + ")"


def _plurals(words: list[str]) -> list[str]:
    return sorted({w + end for w in words for end in ("", "s", "es")})


# All patterns run on lowered text; possessive quantifiers (++, }+) never give
# back what they took, so no position is tried twice.
_ANY = _alternation(INSULTS + PROFANITY + THREATS)
_YOU = r"(?:you|your|yours|yourself|youre|u|ur)"
NEAR_YOU = rf"(?<![a-z])(?:{_YOU}(?![a-z])[^a-z]+(?:[a-z']+[^a-z]+){{0,4}}?{_ANY}|{_ANY}(?:s|es)?(?![a-z])[^a-z]+(?:[a-z']+[^a-z]+){{0,4}}?{_YOU})(?![a-z])"
# Letters with a mask sign or digit inside, or letters spelled apart.
MASKED = r"(?<![a-z0-9])[a-z](?:[a-z]*+[@$*!013457]++[a-z]|(?:[ .*_-][a-z]){3,}(?![a-z]))"
STRETCHED = r"([a-z])\1\1"


def _lexicon_words(low: Column) -> Column:
    """The words of a lowered text that are in any lexicon: a set lookup per
    word, much cheaper than trying an alternation at every position."""
    known = _plurals(INSULTS + PROFANITY + THREATS)
    return F.filter(F.split(low, "[^a-z]+"), lambda w: w.isin(known))


def _count(text: Column, regex: str) -> Column:
    return F.regexp_count(text, F.lit(regex)).cast("double")


@dataclass(frozen=True)
class Lexicon:
    """Learned words by band, the most severe first."""

    bands: tuple[tuple[str, ...], ...] = ((), (), ())


def _marks(words: Column, lexicon: Lexicon) -> Column:
    """One character per word: A, B or C for a learned word of a band, Y for a
    second person, a point for any other."""

    def mark(w: Column) -> Column:
        out = F
        for sign, band in zip("ABC", lexicon.bands, strict=True):
            if band:
                out = out.when(w.isin(list(band)), F.lit(sign))
        return out.when(w.isin(SECOND_PERSON), F.lit("Y")).otherwise(F.lit("."))

    return F.array_join(F.transform(words, mark), "")


def toxicity_features(docs: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """doc_id and one double per feature. Words are counted as stretches
    between spaces and line ends."""
    t, low = F.col("text"), F.col("low")
    rows = docs.select("doc_id", text_or_empty().alias("text"), F.lower(text_or_empty()).alias("low"))
    gaps = 2 * F.length(t) - F.length(F.replace(t, F.lit(" "))) - F.length(F.replace(t, F.lit("\n")))
    counts = rows.select(
        "doc_id",
        "low",
        F.when(F.length(t) > 0, gaps + 1).otherwise(0).cast("double").alias("n"),
        _lexicon_words(low).alias("found"),
        _marks(split_words(low, NON_WORDS), lexicon).alias("marks"),
        _count(t, r"(?<![A-Za-z])[A-Z]{3,}+(?![A-Za-z])").alias("caps"),
        _count(t, r"[!?]{2,}+").alias("punct"),
        _count(low, MASKED).alias("masked"),
        _count(low, STRETCHED).alias("stretched"),
    )

    def of(words: list[str]) -> Column:
        known = _plurals(words)
        return F.size(F.filter("found", lambda w: w.isin(known))).cast("double")

    marked = {
        "severe": r"A", "strong": r"B", "mild": r"C", "learned_near": r"[AB](?=[^Y]{0,4}Y)|(?<=Y.{0,4})[AB]", "learned_pairs": r"[AB](?=.{0,9}[AB])",
    }
    # Most texts hold no learned word.
    some = F.col("marks").rlike("[ABC]")
    counts = counts.select(
        "*",
        of(INSULTS).alias("insults"),
        of(PROFANITY).alias("profanity"),
        of(THREATS).alias("threats"),
        *[F.when(some, _count(F.col("marks"), regex)).otherwise(F.lit(0.0)).alias(name) for name, regex in marked.items()],
    )
    plain = F.regexp_replace(F.translate(low, "@$!013457*", "asioieast"), r"([a-z])\1{2,}", "$1")
    plain = F.regexp_replace(plain, r"(?<=(?<![a-z])[a-z])[ ._-](?=[a-z](?![a-z]))", "")
    hidden = F.greatest((F.size(_lexicon_words(plain)) - F.size("found")).cast("double"), F.lit(0.0))
    counts = counts.select(
        "*",
        F.when(F.size("found") > 0, _count(low, NEAR_YOU)).otherwise(F.lit(0.0)).alias("near"),
        F.when(F.col("masked") + F.col("stretched") > 0, hidden).otherwise(F.lit(0.0)).alias("hidden"),
    )
    per = F.greatest(F.col("n"), F.lit(1.0))
    return counts.select(
        "doc_id",
        (F.col("severe") / per).alias("severe_rate"),
        (F.col("strong") / per).alias("strong_rate"),
        (F.col("mild") / per).alias("mild_rate"),
        F.least(F.col("severe"), F.lit(20.0)).alias("severe_words"),
        (F.col("learned_near") / per).alias("learned_near_you_rate"),
        (F.col("learned_pairs") / per).alias("learned_pairs_rate"),
        (F.col("insults") / per).alias("insult_rate"),
        F.least(F.col("insults") + F.col("hidden"), F.lit(20.0)).alias("insult_count"),
        (F.col("profanity") / per).alias("profanity_rate"),
        (F.col("threats") / per).alias("threat_rate"),
        (F.col("near") / per).alias("near_you_rate"),
        (F.col("hidden") / per).alias("hidden_rate"),
        (F.col("caps") / per).alias("caps_rate"),
        (F.col("punct") / per).alias("punct_rate"),
        (F.col("masked") / per).alias("masked_rate"),
        (F.col("stretched") / per).alias("stretched_rate"),
        F.log1p("n").alias("log_words"),
    )


@dataclass(frozen=True)
class ToxicityModel:
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float
    lexicon: Lexicon = Lexicon()


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most about `rows` labelled documents, the smallest hashes of their
    ids: doc_id, text, label, words and the key that near copies share."""
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    words = split_words(F.lower(text_or_empty()), NON_WORDS)
    sample = sample.select("doc_id", "text", (F.col("label") > 0).cast("double").alias("label"), words.alias("words"))
    windows = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - 3, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, 4))
    )
    key = F.array_min(windows)
    return sample.withColumn("key", key).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "key"), F.lit(FOLDS)))


def learn_lexicons(sample: DataFrame) -> list[Lexicon]:
    """The lexicon of all folds but each one, and at the end that of all."""
    texts = sample.groupBy("fold", "label").agg(F.count_distinct("key").alias("n")).collect()
    n = {(r.fold, r.label): r.n for r in texts}
    word = F.explode(F.array_distinct("words")).alias("word")
    held = sample.select("key", "fold", "label", word).where(F.length("word").between(2, 40) & F.col("word").rlike(r"[^0-9]"))
    held = held.distinct().groupBy("word")
    in_fold = [
        F.count_if((F.col("label") == y) & (F.col("fold") == f)).alias(f"{name}{f}")
        for y, name in ((1.0, "toxic"), (0.0, "clean"))
        for f in range(FOLDS)
    ]
    counts = written(held.agg(*in_fold).where(" + ".join(f"toxic{f}" for f in range(FOLDS)) + f" >= {min(m for _, m in BANDS)}"), "toxic_words")
    found = []
    for out in [*range(FOLDS), None]:
        folds = [f for f in range(FOLDS) if f != out]
        toxic, clean = (sum((F.col(f"{name}{f}") for f in folds), F.lit(0)) for name in ("toxic", "clean"))
        of_toxic, of_clean = (sum(n.get((f, y), 0) for f in folds) for y in (1.0, 0.0))
        odds = F.log((toxic + 0.5) / F.lit(of_toxic + 1.0)) - F.log((clean + 0.5) / F.lit(of_clean + 1.0))
        scored = counts.select("word", toxic.alias("toxic"), odds.alias("odds")).where(F.col("odds") >= math.log(BANDS[-1][0]))
        best = scored.orderBy(F.desc(F.col("toxic") * F.col("odds")), "word").limit(LEXICON_WORDS).collect()
        bands = [[] for _ in BANDS]
        for r in best:
            band = next((i for i, (ratio, least) in enumerate(BANDS) if r.odds >= math.log(ratio) and r.toxic >= least), None)
            if band is not None:
                bands[band].append(r.word)
        found.append(Lexicon(tuple(tuple(sorted(b)) for b in bands)))
    return found


def _fold_features(sample: DataFrame, lexicons: list[Lexicon]) -> DataFrame:
    """Features of the sample, one row per group of near copies with a label,
    each by the lexicon of the other folds."""
    ident = F.struct("doc_id", "label", "key", "fold").alias("doc_id")
    parts = [toxicity_features(sample.where(F.col("fold") == f).select(ident, "text"), lexicons[f]) for f in range(FOLDS)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.select(F.col("doc_id.*"), *FEATURES)
    first = rows.groupBy("key", "label").agg(F.min_by(F.struct("fold", *FEATURES), F.struct("doc_id", *FEATURES)).alias("r"))
    return first.select("key", "label", "r.*")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 11) -> ToxicityModel:
    """Lexicons on the sample, trees on three folds of it, calibration on the
    last; trees and calibration on the whole sample if either part lacks a class."""
    # All tasks scan the documents; the bounded sample they leave is then few partitions.
    sample = written(labelled_sample(docs, labels, rows), "toxicity_sample").coalesce(4)
    n, positive = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or positive in (0, n):
        return ToxicityModel(None, None, positive / n if n else 0.0)
    lexicons = learn_lexicons(sample)
    features = written(_fold_features(sample, lexicons), "toxicity_features").coalesce(2)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features)
    trees_on, calibrate_on = data.where("fold > 0"), data.where("fold = 0")
    if trees_on.select("label").distinct().count() < 2 or calibrate_on.select("label").distinct().count() < 2:
        trees_on = calibrate_on = data
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=seed, maxBins=64).fit(trees_on)
    margins = _margin(trees, calibrate_on).select("margin", "label")
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins)
    return ToxicityModel(trees, calibration, 0.0, lexicons[-1])


def _margin(trees: GBTClassificationModel, data: DataFrame) -> DataFrame:
    out = trees.transform(data).withColumn("margin", F.get(vector_to_array("probability"), F.lit(1)))
    return out.drop("prediction", "rawPrediction", "probability")


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and the calibrated score of every row."""
    if model.trees is None:
        return docs.select("doc_id", F.lit(float(model.constant)).alias("score"))
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(toxicity_features(docs, model.lexicon))
    out = model.calibration.transform(_margin(model.trees, data))
    return out.select("doc_id", F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0)).alias("score"))
