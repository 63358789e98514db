"""Language ID by error-correcting output codes.

Each language has a codeword; one binary logistic classifier over hashed byte
n-grams predicts each bit. A text's language is the codeword with the least
loss, each bit weighted by how well it was learned; a small gap to the runner
up flags the text as ambiguous. Codes are exhaustive up to seven languages and
otherwise the best of several seeded random codes by least distance.

The classifiers are fitted on the driver from a bounded sample; features of the
sample and all predictions are computed in Arrow batches on the executors, one
text at a time, so memory is bounded by one batch.

Defined results: a text that is null or has no letter gets `und` with score 0;
without training rows every text does; with one learned language every other
text gets it with score 1; repeated rows each get their row; a null doc_id is
carried; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Documented bound of the training sample (rows) and the feature width.
SAMPLE_ROWS = 3_000
WIDTH = 2_048
UNDETERMINED = "und"
AMBIGUOUS_GAP = 0.1

# ASCII: letters lowered, everything else a space; bytes above stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte bigrams and trigrams."""
    b = np.frombuffer((" " + text + " ").encode("utf-8", "replace").translate(_FOLD), dtype=np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = (two[:-1] * np.uint32(65_599) + b[2:]) * np.uint32(2_654_435_761)
    half = WIDTH // 2
    x = np.bincount((two * np.uint32(2_246_822_519) >> np.uint32(16)) % half, minlength=half)
    y = np.bincount((three >> np.uint32(12)) % half, minlength=half)
    return np.sqrt(np.concatenate([x, y]) / max(1, len(b))).astype(np.float32)


def code_matrix(k: int, seed: int = 7) -> np.ndarray:
    """k codewords of +1 / -1, one per row."""
    if k < 2:
        return np.ones((k, 0), dtype=np.float32)
    if k <= 7:
        columns = [[1 if row == 0 or (c >> (row - 1)) & 1 else -1 for row in range(k)] for c in range(2 ** (k - 1) - 1)]
        return np.array(columns, dtype=np.float32).T
    bits, rng, best, best_apart = math.ceil(10 * math.log2(k)), np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], dtype=np.float32), size=(k, bits))
        apart = int(((bits - code @ code.T) / 2 + np.eye(k) * bits).min())
        if apart > best_apart:
            best, best_apart = code, apart
    return best


@dataclass(frozen=True)
class OutputCodeModel:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    bit_worth: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margins = features(text) @ self.weights + self.bias
        losses = np.logaddexp(0, -self.code * margins) @ self.bit_worth
        shares = np.exp(losses.min() - losses)
        shares /= shares.sum()
        best = int(np.argmin(losses))
        second = float(np.partition(losses, 1)[1])
        gap = (second - float(losses[best])) / max(second, 1e-9)
        return self.languages[best], float(shares[best]), gap < AMBIGUOUS_GAP


def fit_output_codes(x: np.ndarray, names: list[str], rounds: int = 120, decay: float = 1e-4) -> OutputCodeModel:
    """All bits at once by accelerated full-batch descent on the logistic
    loss, classes weighted to count alike."""
    languages = tuple(sorted(set(names)))
    code = code_matrix(len(languages))
    if len(languages) < 2:
        none = np.zeros((WIDTH, 0), dtype=np.float32)
        return OutputCodeModel(languages, code, none, np.zeros(0), np.zeros(0))
    of = {n: i for i, n in enumerate(languages)}
    y = np.array([of[n] for n in names])
    target = code[y]
    weight = (1 / np.bincount(y, minlength=len(languages))[y]).astype(np.float32)[:, None] / len(languages)
    mean, scale = x.mean(0), x.std(0) + 1e-4
    z = ((x - mean) / scale).astype(np.float32)
    step = np.float32(4.0 / max(1.0, float((z * z).sum(1).mean())))
    w = np.zeros((z.shape[1], code.shape[1]), dtype=np.float32)
    b = np.zeros(code.shape[1], dtype=np.float32)
    w_ahead, b_ahead = w, b
    for i in range(rounds):
        pull = -target / (1 + np.exp(np.clip(target * (z @ w_ahead + b_ahead), -30, 30))) * weight
        w_next = w_ahead - step * (z.T @ pull + np.float32(decay) * w_ahead)
        b_next = b_ahead - step * pull.sum(0)
        push = np.float32(i / (i + 3))
        w_ahead, b_ahead = w_next + push * (w_next - w), b_next + push * (b_next - b)
        w, b = w_next, b_next
    right = ((z @ w + b) * target > 0).astype(np.float32)
    worth = np.clip(2 * (right * weight).sum(0) - 1, 0.01, None)
    weights = w / scale[:, None]
    return OutputCodeModel(languages, code, weights, b - mean @ weights, worth)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            x = features(batch.column("text")[row].as_py())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(row, 1), batch.column("lang").slice(row, 1), pa.array([x.tobytes()], pa.binary())],
                names=["doc_id", "lang", "x"],
            )


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> OutputCodeModel:
    """Fit on rows (doc_id, text, lang) with a language and a text: about
    rows / languages of each language, chosen by a hash of the id."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").count()
    languages = counts.collect()  # one row per language
    if not languages:
        return fit_output_codes(np.zeros((0, WIDTH), dtype=np.float32), [])
    share = rows / len(languages)
    take = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, share / r["count"])) for r in languages], "lang string, take double"
    )
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    picked = known.join(F.broadcast(take), "lang").where(draw < F.col("take")).select("doc_id", "lang", "text")
    found = picked.mapInArrow(_sample_features, "doc_id bigint, lang string, x binary").limit(2 * rows).collect()
    found.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["lang"], bytes(r["x"])))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in found), dtype=np.float32).reshape(len(found), WIDTH)
    return fit_output_codes(x, [r["lang"] for r in found])


def identify(docs: DataFrame, model: OutputCodeModel) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous for every row."""
    schema = "doc_id bigint, lang_pred string, score double, ambiguous boolean"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.float64()),
                    pa.array(columns[2], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(predict, schema)
