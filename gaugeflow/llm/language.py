"""Language identification of mixed-language text.

A word is a run of letters. Its script (by code-point ranges) narrows the
candidate languages to those learnt in that script; every candidate scores
the sum of the log-probabilities of the word's letter n-grams (1 to 3 letters,
with word edges), and a Viterbi pass with a penalty for each change of
language labels the words. Runs of equal labels are the spans.

Learning counts hashed n-grams over all training rows in Spark: each batch adds
into tables (sparse ones for many languages), the tables are summed by cell, and
the model (``cells`` x languages) is collected, a range of languages at a time. Every label that occurs is
learnt; a model over ``model_bytes`` raises an error, so the broadcast is bounded.

Defined cases: null text, empty text and text without letters are ``und`` with
score 0 and no spans; letters of a script in no training text keep all
languages as candidates; ties go to the label first in code-point order; a
corpus without any training row predicts ``und`` everywhere; an empty table
gives no rows. Repeated rows teach and are labelled each. Columns of the input named
``lang_pred``, ``score`` or ``spans`` give way to the operator's own. Long texts are
worked whole; memory follows the batch or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.base import materialize

UNKNOWN = "und"
#: First code points of script ranges and their scripts (0: other letters).
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "other"),
    (0x0B80, "Tamil"), (0x0C00, "other"), (0x0E00, "Thai"), (0x0E80, "other"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"),
    (0x2C60, "Latin"), (0x2C80, "other"), (0x3040, "Kana"), (0x3100, "other"), (0x3400, "Han"), (0xA000, "other"),
    (0xA720, "Latin"), (0xA800, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB07, "other"), (0xFF21, "Latin"), (0xFF5B, "other"), (0x20000, "Han"), (0x30000, "other"),
)


@dataclass(frozen=True)
class Settings:
    cells: int = 1 << 16
    model_bytes: int = 1 << 30
    smoothing: float = 0.5
    switch_penalty: float = 12.0
    script_share: float = 0.01  # least share of a language's letters for a script to be its own
    part_chars: int = 1 << 18  # characters scored at once
    batch_chars: int = 1 << 22  # characters whose words advance together
    full_batch: int = 200  # languages from which on parts and batches shrink, so that memory stays

    def shrunk(self, chars: int, languages: int) -> int:
        return max(1, chars * self.full_batch // max(languages, self.full_batch))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # cells x languages, log-probabilities
    scripts: np.ndarray  # scripts x languages, candidate or not


DENSE_KEYS = 1 << 24  # (language, cell) keys that a task counts in a full table
SPARSE_KEYS = 1 << 21  # counted keys that a task holds before it hands them on
HANDED = 1 << 20  # rows of a batch of counts
LANGUAGES_AT_ONCE = 32  # whose counts come to the driver together (20 bytes x cells each)
_tables: dict = {}


def _unicode() -> dict:
    """Per code point: the lower-case letter (0 if no letter) and its script."""
    if not _tables:
        lower = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                small = ch.lower()
                lower[c] = ord(small) if len(small) == 1 else c
        names = sorted({n for _, n in SCRIPTS})
        starts = np.array([a for a, _ in SCRIPTS])
        ids = np.array([names.index(n) for _, n in SCRIPTS], np.uint8)
        _tables.update(lower=lower, script=ids[np.searchsorted(starts, np.arange(0x110000), "right") - 1], names=names)
    return _tables


def _words(texts: list[str | None]) -> dict:
    """Letters and words of a batch: ``cells`` of the n-grams (3 per letter),
    word starts, each word's text, letters and script."""
    t = _unicode()
    joined = " ".join("" if x is None else x for x in texts)
    points = np.frombuffer((joined + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = t["lower"][points]
    is_letter = letters > 0
    edge = np.flatnonzero(is_letter[1:] != is_letter[:-1]) + 1
    if is_letter[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    lengths = np.array([0 if x is None else len(x) for x in texts]) + 1
    text_of = np.searchsorted(np.cumsum(lengths), start, "right")
    at = np.flatnonzero(is_letter)
    return {
        "letters": letters, "at": at, "start": start, "size": end - start, "text": text_of,
        "first": np.cumsum(end - start) - (end - start), "script": t["script"][points[start]],
    }


def _hash(x: np.ndarray, cells: int) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64) % cells


def _cells(w: dict, cells: int) -> Iterator[np.ndarray]:
    """Cells of the 1-, 2- and 3-letter grams that end at each letter; a gram
    reaches back over the word's edge by one (non-letters are 0)."""
    letters, at = w["letters"], w["at"]
    one = letters[at].astype(np.uint64)
    padded = np.concatenate((np.zeros(2, np.uint32), letters))
    two = padded[at + 1].astype(np.uint64)
    three = np.where(two > 0, padded[at], 0).astype(np.uint64)
    after = np.concatenate((letters, np.zeros(1, np.uint32)))[at + 1].astype(np.uint64)
    last = (after == 0).astype(np.uint64)
    shift = np.uint64(21)
    yield _hash(one * np.uint64(4) + np.uint64(1), cells)
    yield _hash(((two << shift) | one) * np.uint64(4) + np.uint64(2), cells)
    yield _hash(((three << (shift + shift)) | (two << shift) | one) * np.uint64(4) + np.uint64(3), cells)
    # The word's end is a gram of its last two letters.
    yield np.where(last > 0, _hash((((two << shift) | one) << np.uint64(2)) * np.uint64(4), cells), -1)


def _sum_cells(w: dict, table: np.ndarray, cells: int) -> np.ndarray:
    """Per word and language: the sum of its grams' scores."""
    per = np.zeros((len(w["at"]), table.shape[1]), np.float32)
    for c in _cells(w, cells):
        per += np.where((c >= 0)[:, None], table[c], np.float32(0)) if (c < 0).any() else table[c]
    return np.add.reduceat(per, w["first"], axis=0) if len(per) else per[:0]


def _batched(texts: list, limit: int) -> Iterator[tuple[int, list]]:
    at, own, size = 0, [], 0
    for i, x in enumerate(texts):
        own.append(x)
        size += len(x or "") + 1
        if size >= limit:
            yield at, own
            at, own, size = i + 1, [], 0
    if own:
        yield at, own


class _Sums:
    """Sums by key of ``size`` keys: dense while that is small, else sorted keys."""

    def __init__(self, size: int) -> None:
        self.size, self.keys, self.sums = size, np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.dense = np.zeros(size, np.int64) if size <= DENSE_KEYS else None

    def add(self, keys: np.ndarray, weights: np.ndarray | None = None) -> None:
        if self.dense is not None:
            self.dense += np.bincount(keys, weights, self.size).astype(np.int64)
            return
        new, at = np.unique(keys, return_inverse=True)
        sums = np.bincount(at, weights, len(new)).astype(np.int64)
        self.keys, at = np.unique(np.concatenate((self.keys, new)), return_inverse=True)
        self.sums = np.bincount(at, np.concatenate((self.sums, sums)), len(self.keys)).astype(np.int64)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if self.dense is not None:
            self.keys = np.flatnonzero(self.dense)
            self.sums = self.dense[self.keys]
        out = self.keys, self.sums
        self.__init__(self.size)
        return out


def learn(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """``rows``: ``text``, ``lang``; rows with a null in either teach nothing."""
    rows = rows.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    most = min(settings.model_bytes // (4 * settings.cells), np.iinfo(np.int16).max)
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().limit(most + 1).collect())
    if len(languages) > most:
        raise ValueError(f"more than {most} languages: the model would pass model_bytes = {settings.model_bytes}")
    if not languages:
        return Model([], np.zeros((settings.cells, 0), np.float32), np.zeros((0, 0), bool))
    index = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _unicode()["names"]
        grams, scripts = _Sums(len(languages) * settings.cells), _Sums(len(languages) * len(names))

        def handed() -> Iterator[pa.RecordBatch]:
            for kind, width, (keys, sums) in ((0, settings.cells, grams.take()), (1, len(names), scripts.take())):
                for k in range(0, len(keys), HANDED):
                    lang, cell = np.divmod(keys[k : k + HANDED], width)
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array(np.full(len(lang), kind, np.int32)), "lang": pa.array(lang.astype(np.int32)),
                        "cell": pa.array(cell.astype(np.int32)), "n": pa.array(sums[k : k + HANDED]),
                    })

        for b in batches:
            langs, texts = b.column("lang").to_pylist(), b.column("text").to_pylist()
            for at, part in _batched(texts, settings.part_chars):
                w = _words(part)
                if not len(w["at"]):
                    continue
                own = np.array([index[x] for x in langs[at : at + len(part)]])
                of_word = own[w["text"]]
                of_letter = np.repeat(of_word, w["size"])
                for c in _cells(w, settings.cells):
                    ok = c >= 0
                    grams.add(of_letter[ok] * settings.cells + c[ok])
                scripts.add(of_word * len(names) + w["script"], w["size"])
                if len(grams.keys) > SPARSE_KEYS:
                    yield from handed()
        yield from handed()

    sums = rows.mapInArrow(count, "kind int, lang int, cell int, n long").groupBy("kind", "lang", "cell").agg(F.sum("n").alias("n"))
    # cells x languages rows, whatever the corpus; those of LANGUAGES_AT_ONCE come to the driver together.
    sums = materialize(sums.repartitionByRange("lang"), "gram-counts")
    scripts = np.zeros((len(_unicode()["names"]), len(languages)))
    scores = np.full((settings.cells, len(languages)), -np.log(settings.cells), np.float32)  # as without any letter
    for k in range(0, len(languages), LANGUAGES_AT_ONCE):
        got = sums.filter((F.col("lang") >= k) & (F.col("lang") < k + LANGUAGES_AT_ONCE)).toPandas()
        own = got[got["kind"] == 1]
        scripts[own["cell"].to_numpy(), own["lang"].to_numpy()] = own["n"].to_numpy()
        own = got[got["kind"] == 0]
        for lang, one in own.groupby("lang"):
            grams = np.full(settings.cells, settings.smoothing)
            grams[one["cell"].to_numpy()] += one["n"].to_numpy()
            scores[:, lang] = np.log(grams / grams.sum())
    share = scripts / np.maximum(scripts.sum(0, keepdims=True), 1)
    return Model(languages, scores, share >= settings.script_share)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word. ``scores``: words x languages, the words of a
    text in a row; ``counts``: words of each text. All texts advance together,
    the longest first, so a step is one numpy call over the texts still open."""
    out = np.zeros(len(scores), np.int16)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    if not len(order):
        return out
    first = (np.cumsum(counts) - counts)[order]
    size = counts[order]
    # open_at[k]: texts with more than k words.
    open_at = len(size) - np.searchsorted(size[::-1], np.arange(size[0]), "right")
    came = np.zeros(len(scores), np.int16)  # best label before a change into this word
    stays = np.zeros(scores.shape, bool)
    best = scores[first].astype(np.float64)
    ends = np.zeros(len(size), np.int16)
    for k in range(1, size[0]):
        n = open_at[k]
        if n < len(best):
            ends[n : len(best)] = best[n:].argmax(1)
            best = best[:n]
        at = first[:n] + k
        top = best.argmax(1)
        change = best[np.arange(n), top] - penalty
        keep = best >= change[:, None]
        best = np.where(keep, best, change[:, None]) + scores[at]
        best -= best.max(1, keepdims=True)
        came[at], stays[at] = top, keep
    ends[: len(best)] = best.argmax(1)
    label = ends
    for k in range(size[0] - 1, -1, -1):
        n = open_at[k]
        at = first[:n] + k
        now = label[:n]
        out[at] = now
        label[:n] = np.where(stays[at, now], now, came[at])
    return out


def label_words(texts: list, model: Model, settings: Settings) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per batch of whole texts: (first text, and of each word its text within
    the batch, its letters and its label)."""
    for at, batch in _batched(texts, settings.shrunk(settings.batch_chars, len(model.languages))):
        text, size, scores = [], [], []
        for begin, part in _batched(batch, settings.shrunk(settings.part_chars, len(model.languages))):
            w = _words(part)
            allowed = model.scripts[w["script"]]
            allowed = allowed | ~allowed.any(1, keepdims=True)
            scores.append(np.where(allowed, _sum_cells(w, model.scores, settings.cells), np.float32(-1e9)))
            text.append(w["text"] + begin)
            size.append(w["size"])
        of_text, per_word = np.concatenate(text), np.concatenate(scores)
        labels = viterbi(per_word, np.bincount(of_text, minlength=len(batch)), settings.switch_penalty)
        yield at, of_text, np.concatenate(size), labels


def identify(docs: DataFrame, model: Model, settings: Settings = Settings(), text: str = "text", keep_text: bool = False) -> DataFrame:
    """All columns of ``docs`` (``text`` only with ``keep_text``) plus ``lang_pred``, ``score`` (share
    of the letters in that language) and ``spans``: (language, first word, words).

    ``lang_pred`` has the most letters over all spans."""
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    clash = {"lang_pred", "score", "spans"} & {f.name for f in kept}
    if clash:
        docs, kept = docs.drop(*clash), [f for f in kept if f.name not in clash]
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.scores, model.scripts))
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        names = np.array([*m.languages, UNKNOWN], object)
        for b in batches:
            texts = b.column(text).to_pylist()
            pred = np.full(len(texts), len(m.languages))
            score = np.zeros(len(texts))
            spans: list = [[] for _ in texts]
            for at, of_text, size, labels in label_words(texts, m, settings) if m.languages else ():
                if not len(labels):
                    continue
                n = int(of_text[-1]) + 1
                mass = np.bincount(of_text * len(m.languages) + labels, weights=size, minlength=n * len(m.languages)).reshape(n, -1)
                has = np.flatnonzero(mass.sum(1) > 0)
                pred[at + has] = mass[has].argmax(1)
                score[at + has] = mass[has].max(1) / mass[has].sum(1)
                new = np.flatnonzero(np.concatenate(([True], (labels[1:] != labels[:-1]) | (of_text[1:] != of_text[:-1]))))
                lasts = np.concatenate((new[1:], [len(labels)]))
                base = np.searchsorted(of_text, of_text[new], "left")
                for i, lang, a, k in zip(of_text[new].tolist(), names[labels[new]].tolist(), (new - base).tolist(), (lasts - new).tolist()):
                    spans[at + i].append({"lang": lang, "first": a, "words": k})
            columns = [b.column(f.name) for f in kept]
            extra = [pa.array(names[pred].tolist(), pa.string()), pa.array(score), pa.array(spans, span_type)]
            yield pa.RecordBatch.from_arrays([*columns, *extra], [*[f.name for f in kept], "lang_pred", "score", "spans"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    schema = ", ".join([*fields, "lang_pred string, score double, spans array<struct<lang:string,first:bigint,words:bigint>>"])
    return docs.mapInArrow(run, schema)


def is_held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


__all__ = ["Model", "Settings", "identify", "is_held_out", "label_words", "learn", "viterbi"]
