"""Language spans of mixed text: scripts narrow the candidates, Viterbi labels the words.

A word is a run of letters. Its score in a language is the log-probability of its
character n-grams, hashed into a table of fixed size; a language whose training text
hardly uses the word's script is no candidate. A path through the words pays a penalty
for every change of language, so a few odd words do not make a span, a passage does.

Viterbi runs over segments of equal length side by side: the best scores from any to
any language are worked out for all segments, then chained text by text. The result is
that of the plain recursion, for texts of any length.

Training counts n-grams over all rows given, in tasks; the driver gets at most
``buckets`` numbers per language, so the model grows with the number of languages (half a
megabyte each), not with the rows.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and no
spans. A combining mark continues a word and begins none. Without any training row every text is ``und``. Equal scores go to the language
that comes first in the alphabet. Other columns are not passed on.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.frames import mapped, slices

BUCKETS = 1 << 17
GRAMS = (2, 3, 4)
PENALTY = 12.0
SMOOTHING = 0.5
SCRIPT_SHARE = 0.001
SEGMENT = 128
# Numbers held at once for the ways through segments.
WAY_NUMBERS = 1 << 22
UNKNOWN = "und"

# The first code point of each script range and the script it begins.
SCRIPTS = ((0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
           (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0900, "Indic"), (0x0E00, "Thai"),
           (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Other"),
           (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"),
           (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"),
           (0xA000, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"),
           (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Other"), (0x20000, "Han"),
           (0x32000, "Other"))
NAMES = sorted({name for _, name in SCRIPTS})


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: the lower-case letter (0 for all that is none), its script, and
    whether it is a combining mark."""
    lower = np.zeros(0x110000, dtype=np.uint32)
    mark = np.zeros(0x110000, dtype=bool)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            small = c.lower()
            lower[code] = ord(small) if len(small) == 1 else code
        elif unicodedata.combining(c):
            lower[code], mark[code] = code, True
    firsts = [code for code, _ in SCRIPTS]
    names = np.array([NAMES.index(name) for _, name in SCRIPTS], dtype=np.uint8)
    return lower, names[np.searchsorted(firsts, np.arange(0x110000), side="right") - 1], mark


@dataclass
class Grams:
    """N-grams of the words of several texts."""

    bucket: np.ndarray       # lengths x places where grams end
    word: np.ndarray         # per place: number of its word, ascending
    text: np.ndarray         # per word: number of its text
    start: np.ndarray        # per word: code points before it in its text
    end: np.ndarray          # per word: code points up to its end
    script: np.ndarray       # per word

    @property
    def letters(self) -> np.ndarray:
        return self.end - self.start


def grams(texts: list[str | None], buckets: int) -> Grams:
    """Words and n-grams; a gram reaches over the edge of its word by one blank at most."""
    lower, script, mark = _tables()
    # A blank before each text keeps words apart.
    joined = " " + " ".join(t or "" for t in texts) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype="<u4")
    begin = np.cumsum([1, *[len(t or "") + 1 for t in texts]])
    x = lower[codes]
    inside = x > 0
    marks = mark[codes]
    if marks.any():
        # Marks that no letter comes before, back to the last blank, are in no word.
        at = np.arange(len(x))
        letter = np.maximum.accumulate(np.where(inside & ~marks, at, -1))
        blank = np.maximum.accumulate(np.where(inside, -1, at))
        inside &= letter > blank
        x = np.where(inside, x, np.uint32(0))
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    text = np.searchsorted(begin, starts, side="right") - 1
    # Each letter and the blank after a word end one gram of every length. What lies
    # before the blank that leads a word does not count.
    ending = inside.copy()
    ending[1:] |= inside[:-1]
    value = x * np.uint32(0x9E3779B1)
    seen = inside
    found = []
    for back in range(1, max(GRAMS)):
        letter = np.zeros_like(x)
        letter[back:] = x[:-back]
        if back > 1:
            letter *= seen
        seen = letter > 0
        value = (value ^ letter) * np.uint32(0x85EBCA6B) + np.uint32(back)
        value ^= value >> np.uint32(15)
        if back + 1 in GRAMS:
            own = value[ending] * np.uint32(0xC2B2AE35)
            found.append((own >> np.uint32(7)) % np.uint32(buckets))
    bucket = np.stack(found)
    word = np.repeat(np.arange(len(starts)), ends - starts + 1)
    return Grams(bucket, word, text, starts - begin[text],
                 ends - begin[text], script[codes[starts]])


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray   # buckets x languages: log-probabilities
    scripts: np.ndarray  # scripts x languages: whether the script is used

    def word_scores(self, g: Grams) -> np.ndarray:
        """Languages x words; languages that do not use the word's script are far behind."""
        n = len(g.text)
        out = np.empty((len(self.languages), n))
        if not n:
            return out
        ends = np.cumsum(g.letters + 1)
        for k in range(len(self.languages)):
            table = np.ascontiguousarray(self.scores[:, k])
            each = table[g.bucket[0]]
            for bucket in g.bucket[1:]:
                each += table[bucket]
            total = np.cumsum(each, dtype=np.float64)
            out[k] = np.diff(total[ends - 1], prepend=0)
        usable = self.scripts.T[:, g.script]
        usable = usable | ~usable.any(axis=0)
        return np.where(usable, out, out.min(axis=0) - 100.0)


def trained(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
            buckets: int = BUCKETS) -> Model:
    """A model of all rows of ``df`` whose text and language are given."""
    plain = df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "text is not null and lang is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        letters: dict[str, np.ndarray] = {}
        for batch in slices(batches, 256):
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            g = grams(batch.column("text").to_pylist(), buckets)
            for lang in dict.fromkeys(langs):
                counts.setdefault(lang, np.zeros(buckets, np.int64))
                letters.setdefault(lang, np.zeros(len(NAMES), np.int64))
                own = (langs == lang)[g.text]
                places = own[g.word]
                for bucket in g.bucket:
                    counts[lang] += np.bincount(bucket[places], minlength=buckets)
                letters[lang] += np.bincount(g.script[own], weights=g.letters[own],
                                             minlength=len(NAMES)).astype(np.int64)
        for lang in counts:
            # Scripts follow the buckets.
            both = np.concatenate([counts[lang], letters[lang]])
            some = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(both[some])],
                names=["lang", "place", "n"])

    sums = mapped(plain, count, "lang string, place long, n long").groupBy("lang", "place").agg(
        F.sum("n").alias("n"))
    found = sums.toArrow()
    languages = sorted(set(found["lang"].to_pylist()))
    number = found["lang"].combine_chunks().dictionary_encode()
    own = np.array([languages.index(x) for x in number.dictionary.to_pylist()], dtype=np.int64)
    lang, place = own[number.indices.to_numpy()], found["place"].to_numpy()
    n = found["n"].to_numpy()
    # A language's scores are worked out by itself: only the result is held for all.
    scores = np.empty((buckets, len(languages)), dtype=np.float32)
    used = np.zeros((len(NAMES), len(languages)), dtype=bool)
    order = np.argsort(lang, kind="stable")
    for k, rows in enumerate(np.split(order, np.searchsorted(lang[order],
                                                             np.arange(1, len(languages))))):
        total = np.zeros(buckets + len(NAMES))
        if languages:
            total[place[rows]] = n[rows]
            counts, letters = total[:buckets], total[buckets:]
            scores[:, k] = np.log((counts + SMOOTHING) / (counts.sum() + SMOOTHING * buckets))
            used[:, k] = (letters >= SCRIPT_SHARE * max(letters.sum(), 1)) & (letters > 0)
    return Model(languages, scores, used)


def labels(scores: np.ndarray, text: np.ndarray, penalty: float,
           segment: int = SEGMENT) -> np.ndarray:
    """Language of every word on the best path of its text.

    ``scores`` are languages x words, ``text`` the ascending number of each word's text.
    """
    k, n = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    first_of_text = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    length_of_text = np.diff(np.r_[first_of_text, n])
    per_text = -(-length_of_text // segment)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = first_of_text[owner] + turn * segment
    length = np.minimum(length_of_text[owner] - turn * segment, segment)
    segments, steps = len(owner), int(length.max())
    # Longest segments first: those that have ended are a tail that no step touches.
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    place = np.empty(segments, dtype=np.int64)
    place[order] = np.arange(segments)
    running = np.searchsorted(-length, -np.arange(steps), side="left")

    before = np.zeros((k, segments))
    turns = int(turn.max()) + 1
    by_turn = [np.flatnonzero(turn == r) for r in range(turns)]
    # Segments that others of their text come before, in turn; those before them are whole.
    chained = np.concatenate(by_turn[1:]) if turns > 1 else np.zeros(0, np.int64)
    at_once = max(1, WAY_NUMBERS // (k * k))
    for at in range(0, len(chained), at_once):
        some = chained[at:at + at_once]
        # Best score from each language before the segment to each at its end.
        way = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)[:, :, None].repeat(len(some), axis=2)
        begin = start[place[some - 1]]
        for t in range(segment):
            np.maximum(way, way.max(axis=1, keepdims=True) - penalty, out=way)
            way += scores[:, begin + t]
        for r in range(turn[some[0]], turn[some[-1]] + 1):
            own = np.flatnonzero(turn[some] == r)
            a, b = place[some[own] - 1], place[some[own]]
            reached = (before[:, None, a] + way[:, :, own]).max(axis=0)
            before[:, b] = reached - reached.max(axis=0)

    value = before
    number = np.int8 if k <= 127 else np.int32
    own = np.arange(k, dtype=number)[:, None]
    came = np.empty((steps, k, segments), dtype=number)
    for t in range(steps):
        m = running[t]
        part = value[:, :m]
        best = part.argmax(axis=0)
        top = part.max(axis=0) - penalty
        stays = part >= top
        came[t, :, :m] = np.where(stays, own, best.astype(number))
        value[:, :m] = np.where(stays, part, top) + scores[:, start[:m] + t]
    # Which language before the segment leads to each at its end.
    source = np.broadcast_to(own, (k, segments)).copy()
    for t in range(steps - 1, -1, -1):
        m = running[t]
        source[:, :m] = np.take_along_axis(came[t, :, :m], source[:, :m].astype(np.intp), axis=0)
    final = np.zeros(segments, dtype=np.intp)
    ends = place[np.cumsum(per_text) - 1]
    final[ends] = value[:, ends].argmax(axis=0)
    for later in reversed(by_turn[1:]):
        a, b = place[later - 1], place[later]
        final[a] = source[final[b], b]
    out = np.empty(n, dtype=np.int64)
    for t in range(steps - 1, -1, -1):
        m = running[t]
        out[start[:m] + t] = final[:m]
        final[:m] = came[t][final[:m], np.arange(m)]
    return out


SPAN = "array<struct<start:int,end:int,lang:string>>"


def identified(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
               penalty: float = PENALTY) -> DataFrame:
    """id, lang (most letters), score and language spans of each whole text.

    Spans are in code points, the end exclusive. The score is the share of the text's
    letters that lie in spans of ``lang``, times the odds-based certainty that these
    words are of ``lang`` rather than of the language that comes next.
    """
    kind = df.schema[id_col].dataType.simpleString()
    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, 256):
            texts = batch.column("text").to_pylist()
            langs, scores, spans = _judged(known, texts, penalty)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                                     ("lang", pa.string())])))],
                names=["id", "lang", "score", "spans"])

    return mapped(plain, work, f"id {kind}, lang string, score double, spans {SPAN}"
                  ).withColumnRenamed("id", id_col)


def _judged(model: Model, texts: list[str | None], penalty: float):
    n, k = len(texts), len(model.languages)
    if not k:
        return [UNKNOWN] * n, [0.0] * n, [[] for _ in texts]
    g = grams(texts, len(model.scores))
    by_word = model.word_scores(g)
    label = labels(by_word, g.text, penalty)
    letters = np.bincount(g.text * k + label, weights=g.letters.astype(np.float64),
                          minlength=n * k).astype(np.float64).reshape(n, k)
    chosen = letters.argmax(axis=1)
    total = letters.sum(axis=1)
    mine = label == chosen[g.text]
    sums = np.stack([np.bincount(g.text[mine], weights=row[mine], minlength=n)
                     for row in by_word], axis=1).astype(np.float64)
    rows = np.arange(n)
    best = sums[rows, chosen]
    sums[rows, chosen] = -np.inf
    margin = best - sums.max(axis=1) if k > 1 else np.full(n, 50.0)
    score = letters[rows, chosen] / np.maximum(total, 1) / (1 + np.exp(-np.clip(margin, -50, 50)))
    cuts = np.flatnonzero(np.r_[True, (g.text[1:] != g.text[:-1]) | (label[1:] != label[:-1])]
                          ) if len(label) else np.zeros(0, np.int64)
    lasts = np.r_[cuts[1:], len(label)] - 1
    spans: list[list[dict]] = [[] for _ in texts]
    for a, b in zip(cuts.tolist(), lasts.tolist()):
        spans[g.text[a]].append({"start": int(g.start[a]), "end": int(g.end[b]),
                                 "lang": model.languages[label[a]]})
    langs = [model.languages[c] if t else UNKNOWN for c, t in zip(chosen, total)]
    return langs, np.where(total > 0, score, 0.0).tolist(), spans


def with_language(df: DataFrame, model: Model, text_col: str = "text",
                  penalty: float = PENALTY) -> DataFrame:
    """``df`` with ``found_lang`` and ``found_score`` of each whole text."""
    names = [c for c in df.columns if c not in ("found_lang", "found_score")]
    at = names.index(text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            langs, scores, _ = _judged(shared.value, batch.column(at).to_pylist(), penalty)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*names, "found_lang", "found_score"])

    own = df.select(*[F.col(f"`{c}`") for c in names])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    return mapped(own, work, f"{schema}, found_lang string, found_score double")
