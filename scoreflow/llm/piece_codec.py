"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice runs over characters: an edge is a vocabulary piece, or the bytes
of a character that is no piece. A state is a boundary with the last piece
before it. An edge may follow a state only if the model's own merge order keeps
the two pieces apart, so exactly the model's segmentation survives (merges
always join the best-scored adjacent pair, the leftmost of equals; a
segmentation is the model's if and only if each neighbouring pair is).

The search keeps a window no longer than the longest piece beyond the last
commit: whenever the backpointer paths of all surviving states meet in one
boundary, the ids before it are final and leave the window. Where the vocabulary
has no piece across two neighbouring signs (before a word's space signs, after
its last letter, around a line end) that is so at once; words are therefore
looked up in a bounded memo before they are searched. The memo changes speed only.

Texts are escaped as the model does it (a space sign in front, spaces as space
signs). The space sign's own character is encoded by its bytes, so decoding
gives back every text exactly.

Defined results: a null text has null ids, 0 of them and a null round trip; an
empty text has no ids; repeated rows each get their row; a null doc_id is
carried; extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from types import ModuleType

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Bounds of the memos of one worker.
MEMO_WORDS = 500_000
MEMO_PAIRS = 500_000
MEMO_WORD_LENGTH = 40
ROWS_OUT = 256

# States that are no piece: the start, bytes of a character, none that survives.
_START, _BYTES, _NONE = -1, -2, -3


class PieceCodec:
    """Encoder and decoder of one model (a BPE model with byte fallback)."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.byte_id = {}
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes_of: list[bytes] = [b""] * n
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte fallback")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space sign inside")
        self.longest = max(map(len, self.ids))
        self.stride = n
        # Words in two generations: a full one becomes the old one.
        self._words: dict[str, array] = {}
        self._old_words: dict[str, array] = {}
        self._apart: dict[int, bool] = {}
        # Only pieces that their own merges rebuild can occur. The longest of
        # them by their last three signs bounds where an edge can begin.
        self._whole = {p: i for p, i in self.ids.items() if self._merged(p) == [p]}
        self._reach: dict[str, int] = {}
        for p in self._whole:
            self._reach[p[-3:]] = max(self._reach.get(p[-3:], 2), len(p))
        # All paths meet where no piece spans two neighbouring signs: before the
        # space signs of a word, around line ends if they are no pieces, and after
        # a letter that no letter or digit follows, but for signs `across` it.
        pairs = {p[i : i + 2] for p in self._whole for i in range(len(p) - 1)}
        ends = "" if "\n" in self.ids else "\n"
        words = f"{SPACE}+[^{SPACE}{ends}]*|[^{SPACE}{ends}]+" + "|\n+" * bool(ends)
        across = "".join(sorted({re.escape(pair[0]) for pair in pairs if re.fullmatch(r"[^\W\d_][\W_]", pair)}))
        words = rf"{SPACE}*[^\W\d_{across}]+(?![^\W_])|" + words
        self._split = re.compile(words).findall
        self.pieces = {i: p for p, i in self.ids.items()}

    def _merged(self, text: str) -> list[str]:
        """The model's merge order applied to a short string."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stays_apart(self, left: int, right: int) -> bool:
        if len(self._apart) >= MEMO_PAIRS:
            self._apart.clear()
        a, b = self.pieces[left], self.pieces[right]
        known = self._apart[left * self.stride + right] = self._merged(a + b) == [a, b]
        return known

    def search(self, text: str) -> array:
        """Ids of one escaped stretch. `last` and `back` are the window: the
        piece that ends at a boundary and where it begins, from `base` on."""
        ids, whole, reach, apart, stride = self.ids, self._whole, self._reach, self._apart, self.stride
        limit = 4 * self.longest
        out = array("i")
        last, back, base = [_START], [0], 0
        for end in range(1, len(text) + 1):
            tip, at = _NONE, 0
            begin = end - reach.get(text[end - 3 if end > 2 else 0 : end], 2)
            for begin in range(begin if begin > base else base, end):
                before = last[begin - base]
                if before == _NONE:
                    continue
                piece = whole.get(text[begin:end])
                if piece is None:
                    continue
                free = True if before < 0 else apart.get(before * stride + piece)
                if free is None:
                    free = self._stays_apart(before, piece)
                if free:
                    tip, at = piece, begin
                    break
            if tip == _NONE and text[end - 1] not in ids and last[-1] != _NONE:
                tip, at = _BYTES, end - 1
            last.append(tip)
            back.append(at)
            if end - base >= limit:
                common = self._meeting(last, back, base, end)
                if common > base:
                    out.extend(self._committed(text, last, back, base, common))
                    del last[: common - base], back[: common - base]
                    base = common
        out.extend(self._committed(text, last, back, base, len(text)))
        return out

    def _meeting(self, last: list[int], back: list[int], base: int, end: int) -> int:
        """The furthest boundary on the paths of all states that an edge can
        still leave from; `base` if they only meet there."""
        common = None
        for tip in range(end - self.longest + 1, end + 1):
            if last[tip - base] == _NONE:
                continue
            path, at = set(), tip
            while at > base:
                path.add(at)
                at = back[at - base]
            common = path if common is None else common & path
        return max(common, default=base) if common is not None else base

    def _committed(self, text: str, last: list[int], back: list[int], base: int, end: int) -> list[int]:
        """Ids on the path from `base` to `end`."""
        out: list[int] = []
        while end > base:
            piece, begin = last[end - base], back[end - base]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.byte_id[b] for b in reversed(text[begin:end].encode("utf-8", "surrogatepass")))
            end = begin
        out.reverse()
        return out

    def _word(self, word: str) -> array:
        found = self._old_words.get(word)
        if found is None:
            found = self.search(word)
        if len(word) <= MEMO_WORD_LENGTH:
            if len(self._words) >= MEMO_WORDS:
                self._old_words, self._words = self._words, {}
            self._words[word] = found
        return found

    def encode(self, text: str) -> array:
        """Ids of a text; `decode` gives the text back."""
        out = array("i")
        for k, stretch in enumerate(text.split(SPACE)):
            if k:
                out.extend(self.byte_id[b] for b in SPACE.encode())
            escaped = stretch.replace(" ", SPACE)
            if k == 0 and text:
                escaped = SPACE + escaped
            known = self._words
            for word in self._split(escaped):
                found = known.get(word)
                if found is None:
                    found = self._word(word)
                    known = self._words
                out += found
        return out

    def decode(self, ids) -> str:
        parts = self.bytes_of
        text = b"".join([parts[i] for i in ids])
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


def codec_of(model: bytes) -> PieceCodec:
    """The codec of a model, kept with its memos as long as the worker lives:
    in a module of its own, since functions sent by value share no globals."""
    kept = sys.modules.setdefault("piece_codecs_of_worker", ModuleType("piece_codecs_of_worker")).__dict__
    key = f"codec {hash(model)}"
    if key not in kept:
        kept[key] = PieceCodec(model)
    return kept[key]


def read_model(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as f:
        return f.read()


ENCODED = "doc_id bigint, n_ids bigint, ids array<int>, round_trip boolean"


def encode_documents(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_ids, ids and whether decoding them gives the text back. The
    model's bytes (half a megabyte) travel with the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                offsets, values, counts, exact = [], array("i"), [], []
                for value in part.column("text"):
                    text = value.as_py()
                    offsets.append(None if text is None else len(values))
                    if text is None:
                        counts.append(0)
                        exact.append(None)
                        continue
                    ids = codec.encode(text)
                    values.extend(ids)
                    counts.append(len(ids))
                    exact.append(codec.decode(ids) == text)
                offsets.append(len(values))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32())),
                        pa.array(exact, pa.bool_()),
                    ],
                    names=["doc_id", "n_ids", "ids", "round_trip"],
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, ENCODED)


def decode_documents(encoded: DataFrame, model: bytes) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                texts = [None if v.as_py() is None else codec.decode(v.as_py()) for v in part.column("ids")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, text string")
