"""Rules and the vocabulary by examples."""

import pytest

from tradewind.llm import urls
from tradewind.llm.queries import URL_RULES


def verdicts(make, *addresses):
    df = make("page_id long, url string, host string, rule string, id int",
              *[(k, u, "", "", 0) for k, u in enumerate(addresses)])
    return [tuple(r)[1:] for r in urls.judged(df, URL_RULES).orderBy("page_id").collect()]


def test_hosts_paths_and_rules(make):
    rows = verdicts(make, "http://A.Example.com/en/x?q#f", "https://www.example.com/en/1",
                    "x.com", None, "", "http://b.net/es/1", "http://net/fr/", "http://bnet/fr/",
                    "http://x.com", "s://c.org#a/b", "s://c.org?u=http://d.com/", "http://x.com:8/")
    assert [r[:3] for r in rows] == [
        ("a.example.com", "/en/x", "example.com/en/"),
        ("www.example.com", "/en/1", "www.example.com/en/"), ("", "", None), ("", "", None),
        ("", "", None), ("b.net", "/es/1", "net/es/"), ("net", "/fr/", "net/fr/"),
        ("bnet", "/fr/", None), ("x.com", "", None), ("c.org", "", None), ("c.org", "", None),
        ("x.com:8", "/", None)]
    assert [r[-1] for r in rows[:7]] == ["block", "allow", "allow", "allow", "allow", "block", "block"]


@pytest.mark.parametrize("url, strict, soft", [
    ("http://a.org/casino", 1, 0), ("http://a.org/casinos", 0, 0), ("http://CASINO.org/", 1, 0),
    ("http://a.org/free-bet/free", 0, 2), ("http://a.org/freebet", 0, 0), ("", 0, 0),
    ("http://a.org/win_hot+loan", 0, 3), ("http://a.org/bet1", 0, 0), ("xxx", 1, 0)])
def test_terms_between_boundaries(url, strict, soft):
    vocabulary = urls.Vocabulary()
    assert vocabulary.hits(url) == (strict, soft)
    assert vocabulary.blocks(strict, soft) == (strict > 0 or soft > 1)


def test_other_vocabularies_and_no_rows(make):
    df = make("page_id long, url string", (1, "http://a.org/foo/bar"), (1, "http://a.org/foo/bar"))
    own = urls.Vocabulary(strict=(), soft=("foo", "bar", "baz"), soft_limit=2)
    assert [r.verdict for r in urls.judged(df, (), own).collect()] == ["block", "block"]
    assert [r.verdict for r in urls.judged(df, (), urls.Vocabulary((), ())).collect()] == ["allow"] * 2
    assert urls.judged(df.limit(0), URL_RULES).count() == 0


def test_a_vocabulary_as_data(make):
    terms = make("term string, strict boolean, weight double, url string",
                 ("Kasino", True, None, ""), ("kasino", False, 9.0, ""), ("apuesta", False, 0.5, ""),
                 ("казино", True, 1.0, ""), ("gratis", None, 1.5, ""), ("gratis", False, 0.2, ""),
                 ("bonus", False, None, ""), (None, True, 1.0, ""), ("  ", True, 1.0, ""))
    vocabulary = urls.Vocabulary.of_table(terms)
    assert vocabulary.strict == ("kasino", "казино")
    assert vocabulary.soft == {"apuesta": 0.5, "bonus": 1.0, "gratis": 1.5}
    df = make("page_id long, url string, n_soft int", *[(k, f"http://a.org/{u}", 0) for k, u in enumerate(
        ["KASINO", "казино", "apuesta-bonus", "gratis/apuesta", "gratis/gratis", "kasinos",
         "bonus+apuesta+gratis"])])
    rows = urls.judged(df, (), vocabulary).orderBy("page_id").collect()
    assert [(r.n_strict, r.n_soft, r.verdict) for r in rows] == [
        (1, 0, "block"), (1, 0, "block"), (0, 2, "allow"), (0, 2, "block"), (0, 1, "allow"),
        (0, 0, "allow"), (0, 3, "block")]
    assert urls.Vocabulary.of_table(terms.limit(0)).machine() is None


def test_too_many_terms_raise(make, monkeypatch):
    monkeypatch.setattr(urls, "MAX_TERMS", 1)
    terms = make("term string, strict boolean, weight double", ("a", True, 1.0), ("b", True, 1.0))
    with pytest.raises(ValueError, match="more than 1"):
        urls.Vocabulary.of_table(terms)


def test_a_very_long_url(make):
    df = make("page_id long, url string", (1, "http://a.org/" + "x/" * 500_000 + "casino"))
    assert [r.verdict for r in urls.judged(df, ()).collect()] == ["block"]
