"""Personal data: patterns of form, and words around them that find what has no form.

Base spans of four kinds follow fixed expressions and checks. They are the seeds: the two
words before a seed, and the word before it with the word after it, are its lexical
patterns. A pattern that surrounds enough different seeds is looked up in all texts
again, where it also meets fillers that no expression knows. Patterns and fillers make a
graph, scored in rounds: a pattern by the share of its fillers that are of a kind, an
unknown filler by the patterns it stands in. What a pattern says of a filler never comes
back to it: a filler counts for a pattern only when its *other* contexts alone put it
above the threshold. The two patterns of one place share words, so they do not vouch for
each other either; patterns of one form do, as they are different places. Unknown fillers
that look like identifiers (a digit or @, five characters or more) become spans of the
kind when pattern and filler both end above the threshold. A filler runs to the end of
the identifier-like words, however many. Base spans always stay.

Ordinary words that fill a pattern count against it, so a pattern of common words, which
happens to surround seeds, finds nothing.

Defined results: a null or empty text has no spans; offsets are code points, the end
exclusive. Rows that share an id are told apart by a hash of their text; repeated rows
get the same spans. An empty table gives no rows; other columns are not passed on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.frames import Bloom, bloom, kept, mapped, parted, slices
from tradewind.llm.words import _BACK as BACK, _STEP as STEP, _powers as powers, Words, mixed, utf8, words

KINDS = ("email", "ip", "card", "phone")
LEAST_SEEDS = 3
ROUNDS = 3
THRESHOLD = 0.8

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
# A match starts where its run of digits starts, so longer runs are read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """By their at signs: what stands before one is read once, however long."""
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and _LOCAL_END.match(text, start - 1):
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start and then kind."""
    if not text:
        return []
    found = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in
               (part.lstrip("0") or "0" for part in m[0].split("."))):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), m.end(), 3))
    found.sort(key=lambda s: (s[0], s[2]))
    return [(a, b, KINDS[k]) for a, b, k in found]


_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _patterns(before2, before1, after1) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of both patterns; 0 stands for a word that is not there."""
    two = mixed(before2 * _LEFT + mixed(before1))
    around = mixed((before1 ^ _RIGHT) * _RIGHT + mixed(after1 + _LEFT))
    return two, around


def _neighbours(w: Words, first: np.ndarray, last: np.ndarray, text: np.ndarray):
    """Hashes of the words around those from ``first`` to ``last`` within their texts."""
    padded = np.concatenate([[0, 0], w.hashes, [0]]).astype(np.uint64)
    low, high = w.first[text], w.first[text + 1]
    before1 = np.where(first - 1 >= low, padded[first + 1], 0).astype(np.uint64)
    before2 = np.where(first - 2 >= low, padded[first], 0).astype(np.uint64)
    after1 = np.where(last + 1 < high, padded[last + 3], 0).astype(np.uint64)
    return before2, before1, after1


def _points(raw: np.ndarray) -> np.ndarray:
    """Byte offset of every code point of a text, and its length at the end."""
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))


_SPAN = [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()),
         ("two", pa.int64()), ("around", pa.int64()), ("filler", pa.int64())]


def seeds(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text_hash and base spans with their patterns and fillers, per row."""
    kind = df.schema[id_col].dataType.simpleString()
    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                      F.xxhash64(F.col(text_col)).alias("text_hash"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            column = batch.column("text")
            texts = column.to_pylist()
            spans = [base_spans(t) for t in texts]
            out: list[list[dict]] = [[] for _ in texts]
            some = [n for n, s in enumerate(spans) if s]
            if some:
                w = words(column.take(pa.array(some)))
                raw, offsets = utf8(column)
            for k, n in enumerate(some):
                own = raw[offsets[n]:offsets[n + 1]]
                points = _points(own)
                starts = w.starts[w.first[k]:w.first[k + 1]]
                a = points[[s[0] for s in spans[n]]]
                b = points[[s[1] for s in spans[n]]]
                first = np.searchsorted(starts, a, side="right") - 1 + w.first[k]
                last = np.searchsorted(starts, b - 1, side="right") - 1 + w.first[k]
                two, around = _patterns(*_neighbours(w, first, last, np.full(len(first), k)))
                fillers = _fillers(w, first, last)
                out[n] = [dict(zip(("start", "end", "kind", "two", "around", "filler"), row))
                          for row in zip(*zip(*spans[n]), two.view(np.int64).tolist(),
                                         around.view(np.int64).tolist(), fillers.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"),
                 pa.array(out, pa.list_(pa.struct(_SPAN)))], names=["id", "text_hash", "base"])

    return mapped(plain, work, f"id {kind}, text_hash long, base array<struct<start:int,end:int,"
                               "kind:string,two:long,around:long,filler:long>>")


def _fillers(w: Words, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One hash of the words from first to last, by sums over all words before."""
    n, end = len(w.hashes), last + 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(w.hashes * powers(BACK, n), out=total[1:])
    lift = powers(STEP, n + 1)
    return mixed((total[end] - total[first]) * lift[end]
                 + (end - first).astype(np.uint64)).view(np.int64)


def occurrences(df: DataFrame, may: Bloom, id_col: str, text_col: str) -> DataFrame:
    """Fillers of patterns that the filter lets through.

    Base spans come without a place; identifier-like words with theirs; ordinary words
    only as their number in a batch (filler null).
    """
    kind = df.schema[id_col].dataType.simpleString()
    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                      F.xxhash64(F.col(text_col)).alias("text_hash"))
    shared = df.sparkSession.sparkContext.broadcast(may)
    wanted = np.zeros(256, dtype=np.int64)
    wanted[[*range(ord("0"), ord("9") + 1), ord("@")]] = 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom_ = shared.value
        for batch in slices(batches, 256):
            column = batch.column("text")
            w = words(column)
            n = len(w.hashes)
            if not n:
                continue
            raw, offsets = utf8(column)
            text = w.text_of()
            begin = offsets[:-1][text]
            marks = np.concatenate([[0], np.cumsum(wanted[raw])])
            marked = marks[begin + w.ends] > marks[begin + w.starts]
            # Where a run of marked words of a text ends that goes on from here.
            stops = ~marked | np.append(text[1:] != text[:-1], True)
            stop = np.flatnonzero(stops)
            run_end = stop[np.searchsorted(stop, np.arange(n))]
            run_end = np.where(marked[run_end], run_end, run_end - 1)
            first = np.arange(n)
            last = np.where(marked, run_end, first)
            two, around = _patterns(*_neighbours(w, first, last, text))
            rows = []
            for form, pattern in enumerate((two, around)):
                at = np.flatnonzero(bloom_.may_hold(pattern))
                size = (w.ends[last[at]] - w.starts[at])
                like = marked[at] & (size >= 5)
                plain_, counts = np.unique(pattern[at[~like]], return_counts=True)
                rows += [(None, form, p, None, None, None, None, c) for p, c in
                         zip(plain_.view(np.int64).tolist(), counts.tolist())]
                at = at[like]
                fillers = _fillers(w, at, last[at])
                for k, (i, f) in enumerate(zip(at.tolist(), fillers.tolist())):
                    t = int(text[i])
                    rows.append((t, form, int(pattern[i].view(np.int64)), f,
                                 int(w.starts[i]), int(w.ends[last[i]]), None, 1))
            yield from _rows(batch, rows, raw, offsets)

    return mapped(plain, work, f"id {kind}, text_hash long, form int, pattern long, "
                               "filler long, start int, end int, kind string, n long")


def _rows(batch, rows, raw, offsets) -> Iterator[pa.RecordBatch]:
    """Rows with byte offsets told as code points; fillers that hold a base span by its kind."""
    spans: dict[int, tuple] = {}
    ready = []
    column = batch.column("text")
    for t, form, pattern, filler, a, b, _, n in rows:
        if t is None:
            ready.append((None, form, pattern, None, None, None, None, n))
            continue
        if t not in spans:
            spans[t] = (_points(raw[offsets[t]:offsets[t + 1]]), base_spans(column[t].as_py()))
        points, base = spans[t]
        a, b = (int(np.searchsorted(points, x)) for x in (a, b))
        held = next((k for x, y, k in base if x < b and a < y), None)
        ready.append((t, form, pattern, filler, a, b, held, n))
    if ready:
        place = pa.array([r[0] for r in ready], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(place), batch.column("text_hash").take(place),
             *(pa.array([r[k] for r in ready], kind) for k, kind in
               ((1, pa.int32()), (2, pa.int64()), (3, pa.int64()), (4, pa.int32()),
                (5, pa.int32()), (6, pa.string()), (7, pa.int64())))],
            names=["id", "text_hash", "form", "pattern", "filler", "start", "end", "kind", "n"])


def scored(edges: DataFrame, rounds: int, threshold: float = THRESHOLD) -> DataFrame:
    """Score of (pattern, form, kind) after ``rounds`` over the graph.

    ``edges``: pattern, form, filler (null: ordinary words), kind of a base filler, n.
    A pattern's score is the share of its fillers that are of the kind, by form or because
    their other patterns say so; see ``vouched``.
    """
    total = edges.groupBy("pattern", "form").agg(F.sum("n").alias("total"))
    known = edges.where("kind is not null").groupBy("pattern", "form", "kind").agg(
        F.sum("n").alias("known"))
    scores = kept(known.join(total, ["pattern", "form"]).select(
        "pattern", "form", "kind", "known", "total",
        (F.col("known") / F.col("total")).alias("score")), "patterns")
    open_ = edges.where("kind is null and filler is not null").select(
        "pattern", "form", "filler", "n")
    for _ in range(rounds):
        more = vouched(open_, scores, threshold).groupBy("pattern", "form", "kind").agg(
            F.sum("n").alias("more"))
        if more.isEmpty():
            break
        scores = kept(scores.drop("score").join(more, ["pattern", "form", "kind"], "left").select(
            "pattern", "form", "kind", "known", "total",
            ((F.col("known") + F.coalesce("more", F.lit(0))) / F.col("total")).alias("score")),
            "patterns")
    return scores


def _doubt():
    """What a pattern leaves open of a filler; a sure pattern leaves a little."""
    return F.greatest(1 - F.col("score"), F.lit(1e-9))


def vouched(open_: DataFrame, scores: DataFrame, threshold: float) -> DataFrame:
    """(pattern, form, kind, filler, n) where the filler's other patterns of that form
    alone make it one of the kind: one minus the product of what they leave."""
    met = open_.join(scores.select("pattern", "form", "kind", "score"), ["pattern", "form"])
    rest = met.groupBy("filler", "form", "kind").agg(F.sum(F.log(_doubt())).alias("rest"))
    others = 1 - F.exp(F.col("rest") - F.log(_doubt()))
    return met.join(rest, ["filler", "form", "kind"]).where(others >= threshold - 1e-9).select(
        "pattern", "form", "kind", "filler", "n")


def filler_scores(open_: DataFrame, scores: DataFrame) -> DataFrame:
    """Score of (filler, kind) of fillers without a kind, by the form that says most."""
    met = open_.select("pattern", "form", "filler").distinct().join(scores, ["pattern", "form"])
    by_form = met.groupBy("filler", "form", "kind").agg(
        (1 - F.exp(F.sum(F.log(_doubt())))).alias("score"))
    return by_form.groupBy("filler", F.col("kind").alias("filler_kind")).agg(
        F.max("score").alias("filler_score"))


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least_seeds: int = LEAST_SEEDS, rounds: int = ROUNDS,
                  threshold: float = THRESHOLD) -> DataFrame:
    """id, text_hash, base spans and found spans (start, end, kind) of each row."""
    spark = df.sparkSession
    base = kept(seeds(df, id_col, text_col), "base")
    each = base.select("id", F.explode("base").alias("s"))
    met = each.select(F.explode(F.array("s.two", "s.around")).alias("pattern"), "s.filler",
                      "s.kind")
    patterns = kept(met.distinct().groupBy("pattern").agg(F.count("*").alias("seeds"))
                    .where(F.col("seeds") >= least_seeds).select("pattern"), "patterns")
    n = patterns.count()
    plain = base.select("id", "text_hash", F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))).alias("base"))
    kind = df.schema[id_col].dataType.simpleString()
    spans = "array<struct<start:int,end:int,kind:string>>"
    if not n:
        found = spark.createDataFrame([], f"id {kind}, text_hash long, found {spans}")
    else:
        seen = kept(occurrences(df, bloom(patterns, n), id_col, text_col)
                    .join(patterns, "pattern", "left_semi"), "occurrences")
        edges = kept(seen.groupBy("pattern", "form", "filler", "kind").agg(F.sum("n").alias("n")), "edges")
        scores = scored(edges, rounds, threshold)
        open_ = edges.where("kind is null and filler is not null").select("pattern", "form",
                                                                          "filler")
        sure = filler_scores(open_, scores).where(F.col("filler_score") >= threshold - 1e-9)
        good = scores.where(F.col("score") >= threshold).select("pattern", "form", "kind")
        hits = (seen.where("kind is null and filler is not null").drop("kind")
                .join(good, ["pattern", "form"]).join(
                    sure.select("filler", F.col("filler_kind").alias("kind")), ["filler", "kind"]))
        found = hits.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set(F.struct(
            "start", "end", "kind"))).alias("found"))
    found = found.select(F.col("id").alias("found_id"), F.col("text_hash").alias("found_hash"),
                         "found")
    return plain.join(found, plain["id"].eqNullSafe(found["found_id"])
                      & (plain["text_hash"] == found["found_hash"]), "left").select(
        F.col("id").alias(id_col), "text_hash", "base",
        F.coalesce("found", F.array().cast(spans)).alias("found"))


def in_order(spans, kinds=KINDS):
    """Spans by start and then kind as listed, as one string of kind:start:end."""
    rank = F.array(*map(F.lit, kinds))
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"),
        s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.concat_ws(",", F.transform(ranked, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end"])))


def masked(df: DataFrame, spans: DataFrame, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``df`` with every span of ``personal_data`` replaced by its kind in brackets.

    Of spans that overlap the one that starts first counts, and the longer of two that
    start together; the rest of the others is replaced with it.
    """
    names = df.columns
    of_text = spans.select(F.col(id_col).alias("_masked_span_id"), F.col("text_hash").alias("_masked_span_hash"),
                           F.concat("base", "found").alias("_masked_spans")).dropDuplicates(
        ["_masked_span_id", "_masked_span_hash"]).where(F.size("_masked_spans") > 0)
    of_text = kept(of_text, "masked_spans")
    # Texts without spans are not shuffled.
    may, others = parted(df, F.col(f"`{id_col}`"), of_text, F.col("_masked_span_id"))
    hashed = may.withColumn("_masked_span_hash", F.xxhash64(F.col(text_col)))
    joined = hashed.join(of_text, hashed[id_col].eqNullSafe(of_text["_masked_span_id"])
                         & (hashed["_masked_span_hash"] == of_text["_masked_span_hash"]), "left").select(
        *[F.col(f"`{c}`") for c in names], "_masked_spans")
    at = names.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            texts = batch.column(at).to_pylist()
            for n, own in enumerate(batch.column(len(names)).to_pylist()):
                if own:
                    texts[n] = _replaced(texts[n], own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, batch.column(at).type) if k == at else batch.column(k)
                 for k in range(len(names))], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return mapped(joined, work, schema).unionByName(others)


def _replaced(text: str, spans: list[dict]) -> str:
    out, last = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= last:
            out += [text[last:s["start"]], f"[{s['kind'].upper()}]"]
        last = max(last, s["end"])
    return "".join([*out, text[last:]])
