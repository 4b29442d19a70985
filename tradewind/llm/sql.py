"""The numbered queries whose results SQL can state, over the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op6_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
q AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
r AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM q)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM r"""

_BOUNDED = "(^|[^a-z0-9]){term}($|[^a-z0-9])"


def _hits(terms) -> str:
    return " + ".join(
        f"CAST(regexp_matches(folded, '{_BOUNDED.format(term=t)}') AS INTEGER)" for t in terms)


# The vocabulary of the filter and the rules of the query.
_STRICT = ("porn", "xxx", "casino", "viagra", "jackpot", "malware", "warez")
_SOFT = ("adult", "bet", "bonus", "cheap", "dating", "escort", "free", "gambling", "hot", "loan",
         "nude", "pills", "poker", "sex", "slots", "win")

ORACLES["op8_url_filter"] = f"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages),
a AS (
  SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      AS folded,
    CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM u),
b AS (
  SELECT page_id, folded, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM a),
c AS (
  SELECT page_id, folded,
    translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM b),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
d AS (
  SELECT c.*, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(verdict, length(rule_host || rule_path)) AS by_rule
  FROM c LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path)
  GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(by_rule,
  CASE WHEN {_hits(_STRICT)} > 0 OR {_hits(_SOFT)} >= 2 THEN 'block' ELSE 'allow' END) AS verdict
FROM d"""


# Words are runs of anything but the six ASCII white-space characters.
ORACLES["op4_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3),
      lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS n_shingles, list_sort(shingles) AS shingles FROM s),
classes AS (
  SELECT min(doc_id) AS first, any_value(n_shingles) AS n, shingles FROM n
  WHERE n_shingles > 0 GROUP BY shingles),
e AS (SELECT first, n, unnest(shingles) AS shingle FROM classes),
links AS MATERIALIZED (
  SELECT x.first AS a, y.first AS b FROM e x JOIN e y ON x.shingle = y.shingle
    AND x.first <> y.first AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY x.first, y.first, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
of_class AS (
  SELECT first, least(first, coalesce(min(b), first)) AS component_id
  FROM classes LEFT JOIN reach ON first = a GROUP BY first)
SELECT n.doc_id, n.n_shingles, coalesce(o.component_id, n.doc_id) AS component_id,
  n.doc_id = coalesce(o.component_id, n.doc_id) AS kept
FROM n LEFT JOIN classes c ON n.shingles = c.shingles LEFT JOIN of_class o ON c.first = o.first"""

ORACLES["op5_embeddings"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.vec_id <> y.vec_id
    AND len(x.e) = len(y.e) AND x.norm > 0 AND y.norm > 0
    AND list_inner_product(x.e, y.e) / (x.norm * y.norm) >= 0.95),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, coalesce(low, v.vec_id))
    AS component_id, v.vec_id <= coalesce(low, v.vec_id) AS kept
FROM v LEFT JOIN lowest ON v.vec_id = lowest.a LEFT JOIN degree ON v.vec_id = degree.a"""


def _tree(base: str, name: str, levels: int) -> str:
    """Levels of the trees over ``base`` (part, i, d): nodes with their siblings."""
    out, nodes = [], base
    for k in range(levels):
        out.append(f"""{name}{k} AS (
  SELECT part, i, d, count(*) OVER (PARTITION BY part) AS n,
    coalesce(string_agg(d, '') OVER (PARTITION BY part, i // 16 ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(d, '') OVER (PARTITION BY part, i // 16 ORDER BY i
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {nodes}),
{name}{k}_up AS (
  SELECT part, i // 16 AS i, CASE WHEN max(n) = 1 THEN min(d)
    ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {name}{k} GROUP BY part, i // 16)""")
        nodes = f"{name}{k}_up"
    return ",\n".join(out)


def _fold(name: str, levels: int, key: str, at: str) -> str:
    """Follow a node up: its siblings so far and what it folds to."""
    out, rows = [], f"{name}_start"
    for k in range(levels):
        out.append(f"""{name}_f{k} AS (
  SELECT r.* REPLACE (
    CASE WHEN x.n = 1 THEN r.node ELSE sha256(x.before || r.node || x.after) END AS node,
    CASE WHEN x.n = 1 THEN r.proof ELSE r.proof || x.before || x.after END AS proof)
  FROM {rows} r JOIN {name}{k} x ON x.part IS NOT DISTINCT FROM {key}
    AND x.i = r.{at} // {16 ** k})""")
        rows = f"{name}_f{k}"
    return ",\n".join(out)


# Four bits a level: six levels hold 16 million leaves of a source.
_LEVELS = 6
_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_FIELDS = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
# The polynomial of CRC-32, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
      lambda d, e: xor(d >> 1, (d & 1) * 3988292384))), 4294967295::BIGINT)"""

ORACLES["op13_manifest"] = f"""
WITH l AS (
  SELECT doc_id, source, sha256({_FIELDS} || {_FIELD.format('text')}) AS leaf,
    CASE WHEN {_CRC32} % 5 = 0 THEN sha256({_FIELDS} || {_FIELD.format(
      "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS other
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM l),
base AS (SELECT source AS part, place AS i, leaf AS d FROM leaves),
{_tree('base', 'low', _LEVELS)},
subroots AS (
  SELECT part AS source, d AS subroot, row_number() OVER (ORDER BY part NULLS FIRST) - 1 AS of
  FROM low{_LEVELS - 1}_up),
upper AS (SELECT 0 AS part, of AS i, subroot AS d FROM subroots),
{_tree('upper', 'top', _LEVELS)},
low_start AS (
  SELECT l.*, s.of, s.subroot, coalesce(other, leaf) AS node, '' AS proof
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source),
{_fold('low', _LEVELS, 'r.source', 'place')},
top_start AS (SELECT * FROM low_f{_LEVELS - 1}),
{_fold('top', _LEVELS, '0', 'of')}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root,
  node = root AS verified
FROM top_f{_LEVELS - 1}, (SELECT d AS root FROM top{_LEVELS - 1}_up)"""


def _assigned(number: int) -> str:
    return f"""near{number} AS MATERIALIZED (
  SELECT vec_id, label, part, x, min({{'far': far, 'entry': entry}}) AS best FROM (
    SELECT p.vec_id, p.label, p.part, p.x, c.entry, list_sum(list_transform(range(1, len(x) + 1),
      lambda i: (x[i] - c.e[i]) * (x[i] - c.e[i])))::BIGINT AS far
    FROM cut p JOIN books{number} c ON p.part = c.part) GROUP BY ALL)"""


def _improved(number: int) -> str:
    # Components are shifted to be positive, so that // rounds down.
    return f"""means{number} AS (
  SELECT part, entry, list(mean ORDER BY i) AS e FROM (
    SELECT part, best.entry AS entry, i,
      ((sum(x[i] + 1000000000000) // count(*)) - 1000000000000)::BIGINT AS mean
    FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM near{number}) GROUP BY ALL)
  GROUP BY part, entry),
books{number + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.e, b.e) AS e
  FROM books{number} b LEFT JOIN means{number} m USING (part, entry))"""


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

ORACLES["op11_codes"] = f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE {_FINITE}),
cut AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * len(v) // 16 + 1:(part + 1) * len(v) // 16] AS x
  FROM (SELECT *, unnest(range(16)) AS part FROM v)),
books0 AS MATERIALIZED (
  SELECT part, x AS e, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM cut
  QUALIFY entry < 64),
{_assigned(0)},
{_improved(0)},
{_assigned(1)},
{_improved(1)},
{_assigned(2)},
told AS (
  SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM books2),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
    sum(best.far)::BIGINT AS error FROM near2 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  codebooks_sha256 FROM coded, told"""

ORACLES["op12_topk"] = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE {_FINITE}),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND d.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
  AS rank, vec_id, score FROM s QUALIFY rank <= 10"""
