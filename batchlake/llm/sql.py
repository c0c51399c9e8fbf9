"""Checking SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

TOPK = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q, whole c
  WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL
  SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + length(url_encode(role)) + 1
      + length(regexp_replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '(^|\n)### ', '\1\\### ', 'g'))
      + 8)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


def _shared(name: str, source: str, parents: str, node: str) -> str:
    """CTEs that share ``budget`` of ``source`` among children by weight, under their supply."""
    window = f"OVER (PARTITION BY {parents} ORDER BY rate, {node} ROWS UNBOUNDED PRECEDING)"
    whole = f"OVER (PARTITION BY {parents})"
    return f"""
{name}_a AS (
  SELECT *, CASE WHEN weight > 0 THEN supply::DOUBLE / weight::DOUBLE ELSE 'inf'::DOUBLE END AS rate FROM {source}
), {name}_b AS (
  SELECT *, sum(supply) {window} AS filled, sum(weight) {whole} - sum(weight) {window} AS later FROM {name}_a
), {name}_c AS (
  SELECT *, weight > 0 AND filled * weight + supply * later <= budget * weight AS is_full FROM {name}_b
), {name}_d AS (
  SELECT *, sum(CASE WHEN is_full THEN supply ELSE 0 END) {whole} AS used,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) {whole} AS open FROM {name}_c
), {name} AS (
  SELECT * EXCLUDE (rate, filled, later, is_full, used, open, budget, weight, supply), supply,
    CASE WHEN is_full THEN supply
         ELSE least(supply, ((budget - used) * weight)::HUGEINT // greatest(open, 1)::HUGEINT) END::HUGEINT AS given
  FROM {name}_d
)"""


def _refill(name: str, source: str, parents: str) -> str:
    """CTEs that give leaves the document after their prefix, the shortest first, out of what is spare below
    ``parents``; ``spare`` is what the leaves of a parent then have left, all of it at one of them."""
    before = "got" if source != "ends" else "false"
    columns = "* EXCLUDE (got)" if source != "ends" else "*"
    return f"""
{name}_a AS (
  SELECT {columns}, {before} AS had, sum(spare) OVER (PARTITION BY {parents}) AS pool FROM {source}
), {name}_b AS (
  SELECT *, weight > 0 AND given > 0 AND next IS NOT NULL AND NOT had AND next <= pool AS asks FROM {name}_a
), {name}_c AS (
  SELECT *, asks AND sum(CASE WHEN asks THEN next ELSE 0 END) OVER (
    PARTITION BY {parents} ORDER BY NOT asks, next, domain, lang, source ROWS UNBOUNDED PRECEDING) <= pool AS gets FROM {name}_b
), {name} AS (
  SELECT domain, lang, source, given, weight, next, had OR gets AS got,
    CASE WHEN row_number() OVER (PARTITION BY {parents} ORDER BY domain, lang, source) = 1
      THEN pool - sum(CASE WHEN gets THEN next ELSE 0 END) OVER (PARTITION BY {parents}) ELSE 0 END AS spare
  FROM {name}_c
)"""


def mixing(domain: str, weights: dict[tuple[str, ...], int], share: tuple[int, int], epochs: int, seed: int) -> str:
    """Rows that the mixing operator chooses, for the levels domain, lang and source."""

    def weight(*columns: str) -> str:
        cases = " ".join(
            "WHEN " + " AND ".join(f"{c} = '{v}'" for c, v in zip(columns, key, strict=True)) + f" THEN {w}"
            for key, w in reversed(list(weights.items()))
            if len(key) == len(columns)
        )
        return f"(CASE {cases} ELSE 1 END)::HUGEINT" if cases else "1::HUGEINT"

    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce({domain}, '') AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(tokens)::HUGEINT AS one, (sum(tokens) * {epochs})::HUGEINT AS supply
  FROM docs GROUP BY ALL
), total AS (
  SELECT (sum(one) * {share[0]} // {share[1]})::HUGEINT AS budget FROM leaves
), in1 AS (
  SELECT domain, sum(supply)::HUGEINT AS supply, {weight('domain')} AS weight, any_value(budget) AS budget
  FROM leaves, total GROUP BY domain
), {_shared('top', 'in1', '1', 'domain')}, in2 AS (
  SELECT l.domain, l.lang, sum(l.supply)::HUGEINT AS supply, {weight('l.domain', 'l.lang')} AS weight, any_value(t.given) AS budget
  FROM leaves l JOIN top t USING (domain) GROUP BY l.domain, l.lang
), {_shared('mid', 'in2', 'domain', 'lang')}, in3 AS (
  SELECT l.domain, l.lang, l.source, l.supply, l.one, {weight('l.domain', 'l.lang', 'l.source')} AS weight, m.given AS budget
  FROM leaves l JOIN mid m USING (domain, lang)
), {_shared('low', 'in3', 'domain, lang', 'source')}, plan AS (
  SELECT domain, lang, source, given, (given // greatest(one, 1))::INTEGER AS n_full, given % greatest(one, 1) AS rest FROM low
), placed AS (
  SELECT d.*, given, n_full, rest, md5('{seed}:' || n_full || ':' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM docs d JOIN plan p USING (domain, lang, source)
), running AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place ROWS UNBOUNDED PRECEDING) AS upto FROM placed
), cut AS (
  SELECT *, bool_or(upto > rest) OVER (PARTITION BY domain, lang, source ORDER BY place ROWS UNBOUNDED PRECEDING) AS beyond FROM running
), ends AS (
  SELECT domain, lang, source, any_value(given) AS given,
    least({weight('domain')}, {weight('domain', 'lang')}, {weight('domain', 'lang', 'source')}) AS weight,
    CASE WHEN any_value(n_full) < {epochs} THEN any_value(rest) - coalesce(sum(tokens) FILTER (NOT beyond), 0) ELSE 0 END AS spare,
    CASE WHEN any_value(n_full) < {epochs} THEN arg_min(tokens, place) FILTER (beyond) END AS next
  FROM cut GROUP BY domain, lang, source
), {_refill('more1', 'ends', 'domain, lang')}, {_refill('more2', 'more1', 'domain')}, {_refill('more3', 'more2', '1')}, stops AS (
  SELECT domain, lang, source, min(place) FILTER (beyond) AS stop FROM cut GROUP BY domain, lang, source
), chosen AS (
  SELECT c.*, n_full + CASE WHEN n_full < {epochs} AND c.given > 0 AND (NOT beyond OR (m.got AND place = stop)) THEN 1 ELSE 0 END AS taken
  FROM cut c JOIN more3 m USING (domain, lang, source) JOIN stops USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, tokens, unnest(range(taken))::INTEGER AS epoch FROM chosen WHERE taken > 0
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_CRC32 = """xor(4294967295, list_reduce(
  list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
  lambda c, b: list_reduce(
    list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

MERKLE = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, {_leaf('n_chars')} AS leaf,
    CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS seen
  FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM rows
), nodes(tree, level, n, pos, hash) AS (
  SELECT tree, 0, n, pos, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, (n + 1) // 2, pos // 2, sha256(string_agg(hash, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, level, n, pos // 2
), subroots AS MATERIALIZED (
  SELECT tree, level AS height, hash AS subroot, count(*) OVER () AS trees FROM nodes WHERE n = 1
), roof(level, n, pos, hash) AS (
  SELECT 0, trees, tree, subroot FROM subroots
  UNION ALL
  SELECT level + 1, (n + 1) // 2, pos // 2, sha256(string_agg(hash, '' ORDER BY pos))
  FROM roof WHERE n > 1 GROUP BY level, n, pos // 2
), levels AS (
  SELECT DISTINCT tree, level FROM nodes WHERE n > 1
), roof_levels AS (
  SELECT DISTINCT level FROM roof WHERE n > 1
), path AS MATERIALIZED (
  SELECT l.tree, l.pos, v.level AS step, (l.pos >> v.level) % 2 AS odd, s.hash AS other
  FROM leaves l JOIN levels v USING (tree)
  LEFT JOIN nodes s ON s.tree = l.tree AND s.level = v.level AND s.pos = xor(l.pos >> v.level, 1)
  UNION ALL
  SELECT l.tree, l.pos, t.height + v.level, (l.tree >> v.level) % 2, s.hash
  FROM leaves l JOIN subroots t USING (tree) CROSS JOIN roof_levels v
  LEFT JOIN roof s ON s.level = v.level AND s.pos = xor(l.tree >> v.level, 1)
), folded(tree, pos, step, hash) AS (
  SELECT tree, pos, 0, seen FROM leaves
  UNION ALL
  SELECT f.tree, f.pos, f.step + 1, sha256(CASE WHEN other IS NULL THEN f.hash WHEN odd = 1 THEN other || f.hash ELSE f.hash || other END)
  FROM folded f JOIN path USING (tree, pos, step)
), ends AS (
  SELECT tree, pos, arg_max(hash, step) AS folded_root FROM folded GROUP BY tree, pos
), proofs AS (
  SELECT tree, pos, string_agg(other, '' ORDER BY step) AS proof FROM path GROUP BY tree, pos
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN ends USING (tree, pos) LEFT JOIN proofs USING (tree, pos)
CROSS JOIN (SELECT hash AS root FROM roof WHERE n = 1)
"""


def clusters(k: int, rounds: int, size: int) -> str:
    """Rows of the clustering operator: every round as a step of its own."""

    def nearest(number: int, centroids: str) -> str:
        return f"""
a{number} AS MATERIALIZED (
  SELECT rid, c, dist FROM (
    SELECT rid, c, sum((p.x - q.x) * (p.x - q.x)) AS dist FROM parts p JOIN {centroids} q USING (d) GROUP BY rid, c
  ) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY dist, c) = 1
)"""

    steps = []
    for r in range(rounds):
        steps.append(nearest(r, f"c{r}"))
        steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT q.c, q.d, coalesce(m.x, q.x) AS x FROM c{r} q LEFT JOIN (
    SELECT c, d, (total - ((total % n) + n) % n) // n AS x
    FROM (SELECT c, d, sum(x) AS total, count(*)::HUGEINT AS n FROM a{r} JOIN parts USING (rid) GROUP BY c, d)
  ) m ON m.c = q.c AND m.d = q.d
)""")
    steps.append(nearest(rounds, f"c{rounds}"))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::HUGEINT) AS v
  FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, unnest(range({size})) AS d, unnest(v) AS x FROM kept
), seeds AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c FROM kept WHERE vec_id IS NOT NULL
), c0 AS MATERIALIZED (
  SELECT c, d, x FROM seeds JOIN parts USING (rid) WHERE c < {k}
), {",".join(steps)}, digests AS (
  SELECT c, sha256(string_agg(x, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c
)
SELECT vec_id, c::INTEGER AS cluster, dist::BIGINT AS distance, (sum(dist) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(dist) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (rid) JOIN digests USING (c)
"""
