"""DuckDB statements for the operators that SQL can express.

They restate constants and rules; nothing is taken from the operators.
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)
), owner AS (
  SELECT k, min(doc_id) AS m FROM win GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p
  FROM win JOIN owner USING (k) WHERE m < doc_id
), words AS (
  SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


def _pour(source: str, parent: str) -> str:
    """Budgets of the children of each node: those that fill up come first
    in the order of limit / weight."""
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""
  SELECT *, CASE WHEN quotient * weight >= lim THEN lim ELSE
    max(CASE WHEN quotient * weight < lim THEN quotient END) OVER ({by}) * weight END AS given
  FROM (
    SELECT *, (budget - coalesce(sum(lim) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS quotient
    FROM (SELECT *, supply * 2.0::DOUBLE AS lim FROM ({source}))
    WINDOW o AS ({by} ORDER BY lim / weight, name))"""


MIXING = rf"""
WITH s AS (
  SELECT * FROM (
    SELECT doc_id, lang, source,
      coalesce('domain' || CAST(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 AS VARCHAR), 'other') AS domain,
      CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens
    FROM documents) WHERE n_tokens > 0
), domains AS ({_pour('''
  SELECT domain, domain AS name, sum(n_tokens) AS supply,
    CASE domain WHEN 'domain0' THEN 0.20 WHEN 'domain1' THEN 0.10 WHEN 'domain2' THEN 0.10 WHEN 'domain3' THEN 0.60
      ELSE 0.05 END::DOUBLE AS weight,
    (SELECT sum(n_tokens) FROM s)::DOUBLE AS budget FROM s GROUP BY domain''', '')}
), langs AS ({_pour('''
  SELECT domain, lang, lang AS name, n.supply, given AS budget,
    CASE lang WHEN 'en' THEN 0.40 WHEN 'de' THEN 0.18 WHEN 'fr' THEN 0.17 WHEN 'es' THEN 0.25 ELSE 0.05 END::DOUBLE AS weight
  FROM (SELECT domain, lang, sum(n_tokens) AS supply FROM s GROUP BY domain, lang) n
  JOIN (SELECT domain, given FROM domains) USING (domain)''', 'domain')}
), leaves AS ({_pour('''
  SELECT n.domain, n.lang, source, source AS name, n.supply, given AS budget,
    CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN 1.0 ELSE 0.05 END::DOUBLE AS weight
  FROM (SELECT domain, lang, source, sum(n_tokens) AS supply FROM s GROUP BY domain, lang, source) n
  JOIN (SELECT domain, lang, given FROM langs) u ON n.domain = u.domain AND n.lang IS NOT DISTINCT FROM u.lang''',
  'domain, lang')}
), targets AS (
  SELECT domain, lang, source, CAST(floor(round(given, 3)) AS BIGINT) // CAST(supply AS BIGINT) AS epochs,
    CAST(floor(round(given, 3)) AS BIGINT) % CAST(supply AS BIGINT) AS rest FROM leaves
), keyed AS (
  SELECT s.*, epochs, rest, md5(concat_ws(':', '20240601', CAST(epochs AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS key
  FROM s JOIN targets t ON s.domain = t.domain AND s.lang IS NOT DISTINCT FROM t.lang
    AND s.source IS NOT DISTINCT FROM t.source
), chosen AS (
  SELECT *, epochs + CASE WHEN sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) <= rest
    THEN 1 ELSE 0 END AS copies FROM keyed
)
SELECT doc_id, domain, lang, source, n_tokens, CAST(epoch AS INTEGER) AS epoch FROM (
  SELECT *, unnest(generate_series(0, copies - 1)) AS epoch FROM chosen WHERE copies > 0)
"""


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || {column} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


# Unsigned CRC-32 of the decimal id, byte by byte and bit by bit.
_CRC = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(crc, b)),
    4294967295::BIGINT), 4294967295)"""

_FOLD = """sha256(array_to_string(r.run[1:idx % 16], '') || folded || array_to_string(r.run[idx % 16 + 2:], '')),
    proof || array_to_string(r.run[1:idx % 16], '') || array_to_string(r.run[idx % 16 + 2:], '')"""

MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS k, doc_id, source, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC} % 5 = 0
      THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents
), p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS sid FROM d
), tree(sid, level, idx, digest, n) AS (
  SELECT sid, 0, idx, leaf, n FROM p
  UNION ALL
  SELECT sid, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (n + 15) // 16
  FROM tree WHERE n > 1 GROUP BY sid, level, idx // 16, n
), subroots AS (
  SELECT sid, digest FROM tree WHERE n = 1
), top(level, idx, digest, n) AS (
  SELECT 0, sid, digest, (SELECT count(*) FROM subroots) FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (n + 15) // 16
  FROM top WHERE n > 1 GROUP BY level, idx // 16, n
), runs AS (
  SELECT sid, level, idx // 16 AS above, list(digest ORDER BY idx) AS run FROM tree WHERE n > 1 GROUP BY ALL
), top_runs AS (
  SELECT level, idx // 16 AS above, list(digest ORDER BY idx) AS run FROM top WHERE n > 1 GROUP BY ALL
), inside(k, sid, level, idx, n, folded, proof) AS (
  SELECT k, sid, 0, idx, n, coalesce(tampered, leaf), '' FROM p
  UNION ALL
  SELECT k, c.sid, c.level + 1, idx // 16, (n + 15) // 16, {_FOLD}
  FROM inside c JOIN runs r ON c.sid = r.sid AND c.level = r.level AND idx // 16 = above WHERE n > 1
), over(k, level, idx, n, folded, proof) AS (
  SELECT k, 0, sid, (SELECT count(*) FROM subroots), folded, proof FROM inside WHERE n = 1
  UNION ALL
  SELECT k, c.level + 1, idx // 16, (n + 15) // 16, {_FOLD}
  FROM over c JOIN top_runs r ON c.level = r.level AND idx // 16 = above WHERE n > 1
)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256,
  folded AS folded_root, folded = t.digest AS verified
FROM p JOIN over USING (k) JOIN subroots s USING (sid), top t WHERE over.n = 1 AND t.n = 1
"""

SQL = {"op1_substring_dedup": SUBSTRING_DEDUP, "op3_mixing": MIXING, "op12_merkle_manifest": MERKLE}
