"""URL filter: host rules, then a weighted vocabulary counted by Aho-Corasick.

The longest rule that fits a url's host and path decides. Without one, the url's
lower-cased text is searched for the vocabulary in one pass. A term counts only
between boundaries: the characters beside it are no ASCII letters or digits. One
strict term, or different soft terms whose weights come to ``soft_limit``, block the url.
A soft term weighs 1 unless the vocabulary says otherwise. ``Vocabulary.of_table`` reads
terms of any languages and their weights from a table; the list below is an example.

A null url has an empty host and path, fits no rule, holds no term and is allowed.
Rows are judged one by one; repeated rows and ties between equal rules (the first
stated wins) give the same verdict every time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tradewind.llm.frames import mapped, slices

ALLOW, BLOCK = "allow", "block"
MAX_TERMS = 1_000_000

# Example vocabulary: a strict term is never wanted, a soft one only in company.
STRICT = ("porn", "xxx", "casino", "viagra", "jackpot", "malware", "warez")
SOFT = ("adult", "bet", "bonus", "cheap", "dating", "escort", "free", "gambling", "hot", "loan",
        "nude", "pills", "poker", "sex", "slots", "win")


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains and paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Vocabulary:
    """Terms in any order; ``soft`` may give each term a weight."""

    strict: Sequence[str] = STRICT
    soft: Sequence[str] | Mapping[str, float] = SOFT
    soft_limit: float = 2
    _machine: list = field(default_factory=list, compare=False, repr=False)

    @classmethod
    def of_table(cls, df: DataFrame, soft_limit: float = 2) -> Vocabulary:
        """From columns term, strict (boolean) and weight.

        Null and empty terms are left out; a null strict is soft, a null weight 1. Among
        rows of one term the strict one wins, then the largest weight. More terms than
        ``MAX_TERMS`` raise, as each task holds them all.
        """
        given = F.col("term").isNotNull() & (F.trim("term") != "")
        terms = df.where(given).groupBy(folded(F.trim("term")).alias("term")).agg(
            F.max(F.coalesce("strict", F.lit(False))).alias("strict"),
            F.max(F.coalesce(F.col("weight").cast("double"), F.lit(1.0))).alias("weight"))
        found = terms.limit(MAX_TERMS + 1).collect()
        if len(found) > MAX_TERMS:
            raise ValueError(f"more than {MAX_TERMS} terms")
        return cls(tuple(sorted(r["term"] for r in found if r["strict"])),
                   {r["term"]: r["weight"] for r in sorted(found, key=lambda r: r["term"])
                    if not r["strict"]}, soft_limit)

    def weight(self, term: str) -> float:
        return self.soft[term] if isinstance(self.soft, Mapping) else 1

    def machine(self) -> ahocorasick.Automaton | None:
        if not self.strict and not self.soft:
            return None
        if not self._machine:
            automaton = ahocorasick.Automaton()
            for strict, terms in ((False, self.soft), (True, self.strict)):
                for term in terms:
                    weight = 0 if strict else self.weight(term)
                    automaton.add_word(_folded(term), (_folded(term), strict, weight))
            automaton.make_automaton()
            self._machine.append(automaton)
        return self._machine[0]

    def __getstate__(self):
        return {**self.__dict__, "_machine": []}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def hits(self, url: str) -> tuple[int, int]:
        """How many different strict and soft terms stand between boundaries."""
        return self.weighed(url)[:2]

    def weighed(self, url: str) -> tuple[int, int, float]:
        """The same, and the weight of the soft ones."""
        machine = self.machine()
        if machine is None:
            return 0, 0, 0
        text = _folded(url)
        strict, soft = set(), {}
        for last, (term, is_strict, weight) in machine.iter(text):
            first = last - len(term) + 1
            if first and _inner(text[first - 1]) or last + 1 < len(text) and _inner(text[last + 1]):
                continue
            if is_strict:
                strict.add(term)
            else:
                soft[term] = weight
        return len(strict), len(soft), math.fsum(soft.values())

    def blocks(self, strict: int, soft: float) -> bool:
        """Whether strict terms and the weight of soft ones block a url."""
        return strict > 0 or soft >= self.soft_limit


def _folded(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _inner(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def folded(text: Column) -> Column:
    """A-Z in lower case, as tasks fold urls."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return folded(found)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def judged(df: DataFrame, rules: Sequence[Rule], vocabulary: Vocabulary = Vocabulary(),
           id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``df``: id, host, path, rule, strict and soft hits, verdict.

    Other columns are not passed on. A rule is stated last to win among equal lengths
    only if it is the very same text.
    """
    url = F.col(url_col)
    plain = df.select(F.col(id_col).alias("id"), url.alias("url"), host_of(url).alias("host"),
                      path_of(url).alias("path"))
    rule, by_rule = fitting_rule(F.col("host"), F.col("path"), rules)
    plain = plain.select("id", "host", "path", rule.alias("rule"), by_rule.alias("by_rule"), "url")
    kind = df.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            strict, soft, verdicts = [], [], []
            for url, given in zip(batch.column("url").to_pylist(),
                                  batch.column("by_rule").to_pylist()):
                hard, mild, weight = vocabulary.weighed(url or "")
                strict.append(hard)
                soft.append(mild)
                verdicts.append(given or (BLOCK if vocabulary.blocks(hard, weight) else ALLOW))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "host", "path", "rule")),
                 pa.array(strict, pa.int32()), pa.array(soft, pa.int32()),
                 pa.array(verdicts, pa.string())],
                names=["id", "host", "path", "rule", "n_strict", "n_soft", "verdict"])

    return mapped(plain, count, f"id {kind}, host string, path string, rule string, "
                                "n_strict int, n_soft int, verdict string"
                  ).withColumnRenamed("id", id_col)
