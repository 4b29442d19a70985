"""Base spans against plain expressions; contextual spans by planted examples."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tradewind.llm import pii
from tradewind.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
            if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(a, b, pii.KINDS[k]) for a, k, b in sorted(out)]


def test_against_plain_expressions():
    rnd = random.Random(2)
    for alphabet, n in (("ab@@..01 2-+()é9%\n5", 15000), ("0123456789 -.+4", 8000)):
        for _ in range(n):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 50)))
            assert pii.base_spans(text) == plain(text), text


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_runs_take_linear_time():
    text = "a" * 300_000 + "@" * 300 + "1" * 300_000 + "1." * 9_000 + "+1(" * 30_000
    spans = pii.base_spans(text)
    # The first address is longer than 255; those behind it are found, four parts each.
    assert {kind for _, _, kind in spans} == {"ip"} and len(spans) == 9_000 // 4 - 1


def test_context_finds_what_has_no_form(make):
    rows = [(i, f"Äh hello there please call me at +1 (555) 010-{1000 + i} thanks a lot")
            for i in range(12)]
    rows += [(100, "you can call me at 5550101234 thanks so much"),
             (101, "Müller: call me at 0171/223344 now"),
             (102, "the version of thing is 12345-abc ok"), (103, None), (104, ""),
             (None, "call me at 99887766 thanks"), (105, "they call me names every day"),
             (106, "write a@b.co or 10.0.0.1 and 4111 1111 1111 1111"),
             (106, "another text of that id")]
    df = make("doc_id long, text string, kind string, id int, spans string",
              *[(*r, "", 0, "") for r in rows])
    spans = pii.personal_data(df)
    got = {}
    for r in spans.collect():
        got.setdefault(r.doc_id, []).append(
            ([(s.kind, s.start, s.end) for s in r.base], [(s.kind, s.start, s.end) for s in r.found]))
    assert len(got[106]) == 2
    assert ([("email", 6, 12), ("ip", 16, 24), ("card", 29, 48)], []) in got[106]
    assert got[100] == [([], [("phone", 19, 29)])] and got[101] == [([], [("phone", 19, 30)])]
    assert got[None] == [([], [("phone", 11, 19)])]
    assert all(got[k] == [([], [])] for k in (102, 103, 104, 105))
    assert got[3] == [([("phone", 33, 50)], [])]
    masked = {(r.doc_id, r.kind): r.text for r in pii.masked(df, spans).where("doc_id > 99").collect()}
    assert masked[101, ""] == "Müller: call me at [PHONE] now"
    assert masked[102, ""] == "the version of thing is 12345-abc ok" and masked[103, ""] is None
    digest = spans.select("doc_id", pii.in_order(F.concat("base", "found")).alias("s"))
    assert digest.where("doc_id = 101").first().s == "phone:19:30"


def test_words_that_fill_a_context_count_against_it(make):
    rows = [(i, f"it was at +1 555 010 {1000 + i} then") for i in range(6)]
    rows += [(100 + i, f"it was at home{chr(97 + i % 26)} then") for i in range(60)]
    rows.append((500, "it was at 12345678 then"))
    found = pii.personal_data(make("doc_id long, text string", *rows))
    assert found.where("size(found) > 0").count() == 0


def test_no_rows_and_no_seeds(make):
    df = make("doc_id long, text string", (1, "nothing here"), (1, "nothing here"))
    assert [(r.base, r.found) for r in pii.personal_data(df).collect()] == [([], [])] * 2
    assert pii.personal_data(df.limit(0)).count() == 0
    assert pii.masked(df.limit(0), pii.personal_data(df.limit(0))).count() == 0


def test_query_counts_and_digests(spark):
    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op1_pii"](spark, folder).collect()}
    seen = 0
    for doc, text in texts:
        spans = plain(text or "")
        joined = ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)
        row = got[doc]
        assert [row[f"n_{k}"] for k in pii.KINDS] == [
            sum(s[2] == k for s in spans) for k in pii.KINDS]
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(row.spans.split(","))
        seen += len(spans)
    assert seen > 10


def test_unknown_numbers_of_many_groups_are_found_whole(make):
    """Only the words on both sides repeat, and every filler has five groups or more."""
    rows = [(k, f"zq{k} at +33 1 23 45 67 {k:02d} thanks a{k}") for k in range(10, 30)]
    rows += [(50, "other at 01 23 45 67 89 thanks b"), (51, "other at 01 23 45 67 89 10 11 thanks b")]
    df = make("doc_id long, text string", *rows)
    found = pii.personal_data(df)
    cut = {r.doc_id: r.text for r in pii.masked(df, found).collect()}
    assert cut[50] == "other at [PHONE] thanks b" and cut[51] == "other at [PHONE] thanks b"
    assert cut[10] == "zq10 at [PHONE] thanks a10"


def test_codes_of_a_shared_context_stay_codes(make):
    """A third, or two thirds, of the fillers are addresses: no reason to take the codes."""
    for codes in (18, 5):
        rows = [(k, f"the order code user{k}@mail.com was fine") for k in range(9)]
        rows += [(100 + k, f"the order code SKU-10{k:02d} was fine") for k in range(codes)]
        found = pii.personal_data(make("doc_id long, text string", *rows))
        assert found.where("size(found) > 0").count() == 0


def test_a_filler_counts_for_a_pattern_by_its_other_patterns(make):
    """Score 0.9 in one context settles the filler; the next context then learns from it."""
    edges = make("pattern long, form int, filler long, kind string, n long",
                 (1, 0, 10, "phone", 9), (1, 0, 11, None, 1),          # 0.9 of its fillers
                 (2, 0, 12, "phone", 2), (2, 0, 11, None, 8),          # 0.2, 1.0 with filler 11
                 (3, 0, 13, "phone", 1), (3, 0, 14, None, 1),          # 0.5, nobody vouches
                 (4, 1, 12, "phone", 1), (4, 1, 11, None, 9))          # another form of a place
    scores = {r.pattern: r.score for r in pii.scored(edges, 3).collect()}
    # Pattern 2 reaches 1.0 by then, so filler 11 counts for pattern 1, too.
    assert scores == {1: 1.0, 2: 1.0, 3: 0.5, 4: 0.1}
    assert {r.pattern for r in pii.scored(edges.where("pattern <> 1"), 3).collect()
            if r.score >= 0.8} == set()


def test_planted_identifiers_and_clean_texts(make):
    """Precision and recall per kind over contexts with one unknown in ten."""
    context = {"email": "please write to {} before noon", "phone": "you can reach us under {} today",
               "card": "charge the card {} at once", "ip": "traffic came from {} last night"}
    known = {"email": "u{}@site.org", "phone": "+49 30 1234 {:03d}", "card": "4111111111111111",
             "ip": "10.0.1.{}"}
    unknown = {"email": "user{}(at)site.org", "phone": "0301/55{:03d}", "card": "4111-xxxx-{:04d}",
               "ip": "fe80::{:04d}"}
    rows, planted = [], {}
    for k, kind in enumerate(pii.KINDS):
        for i in range(60):
            doc = 1000 * k + i
            if i % 10 == 3:
                planted[doc] = kind, unknown[kind].format(i)
            # Every seed differs, and so do the words around the sentence.
            filler = planted[doc][1] if doc in planted else known[kind].format(i)
            rows.append((doc, f"note{doc} {context[kind].format(filler)} end{doc}"))
    clean = [(9000 + i, f"item{i} number A-{i:05d} was packed on day{i}") for i in range(60)]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in pii.personal_data(
        make("doc_id long, text string", *rows, *clean)).where("size(found) > 0").collect()}
    texts = dict(rows)
    right = {d: [(kind, texts[d].index(x), texts[d].index(x) + len(x))]
             for d, (kind, x) in planted.items()}
    by_kind = {k: [d for d, (kind, _) in planted.items() if kind == k] for k in pii.KINDS}
    # The cards are one number, so their pattern has a single seed and finds nothing.
    for kind in ("email", "phone", "ip"):
        assert all(found.get(d) == right[d] for d in by_kind[kind]), kind
    assert set(found) <= set(planted)
