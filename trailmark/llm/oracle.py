"""SQL twins (DuckDB) of the operators that SQL can express, written their own way."""

from __future__ import annotations

from trailmark.llm.mixing import LEVELS, Mix

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _weight(level: str, mix: Mix) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {w}" for name, w in mix.weights.get(level, {}).items())
    return f"CASE {level} {cases} ELSE 1 END" if cases else "1"


def mix_sources(mix: Mix) -> str:
    weights = {level: _weight(level, mix) for level in LEVELS}
    parts = [
        f"""told AS (
  SELECT doc_id, lang AS lang_was, source AS source_was, coalesce(doc_id::VARCHAR, '') AS id,
         coalesce('domain' || (TRY_CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) // 5),
                  'other') AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS tokens
  FROM documents)""",
        f"""nodes0 AS (
  SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens,
         CASE WHEN ({weights["domain"]}) * ({weights["lang"]}) * ({weights["source"]}) > 0
              THEN sum(tokens)::BIGINT * {mix.max_epochs} ELSE 0 END AS cap,
         floor((SELECT sum(tokens)::BIGINT FROM told) * {mix.budget_percent} / 100) AS budget
  FROM told GROUP BY domain, lang, source)""",
    ]
    for depth, level in enumerate(LEVELS):
        here = ", ".join(LEVELS[: depth + 1])
        parent = ", ".join(LEVELS[:depth]) or "1"
        parts += [
            f"""branch{depth} AS (
  SELECT {here}, sum(cap)::BIGINT AS room, min(budget) AS given, {weights[level]} AS weight
  FROM nodes{depth} GROUP BY {here})""",
            f"""ratio{depth} AS (
  SELECT *, CASE WHEN weight > 0 THEN room / weight ELSE 0 END AS ratio FROM branch{depth})""",
            f"""level{depth} AS (
  SELECT *, (given - coalesce(sum(room) OVER before, 0)) /
            nullif(sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER before, 0), 0)
            AS share
  FROM ratio{depth}
  WINDOW before AS (PARTITION BY {parent} ORDER BY ratio, {level}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
            f"""shared{depth} AS (
  SELECT *, max(CASE WHEN coalesce(share, 0) < ratio THEN coalesce(share, 0) END)
            OVER (PARTITION BY {parent}) AS unit
  FROM level{depth})""",
            f"""nodes{depth + 1} AS (
  SELECT n.* EXCLUDE (budget),
         CASE WHEN coalesce(s.share, 0) >= s.ratio THEN s.room
              ELSE least(s.room, floor(s.unit * s.weight)) END::BIGINT AS budget
  FROM nodes{depth} n JOIN shared{depth} s USING ({here}))""",
        ]
    parts += [
        """placed AS (
  SELECT t.*, CASE WHEN n.tokens > 0 THEN n.budget // n.tokens ELSE 0 END AS epochs,
         CASE WHEN n.tokens > 0 THEN n.budget % n.tokens ELSE 0 END AS rest
  FROM told t JOIN nodes3 n USING (domain, lang, source))""",
        f"""ordered AS (
  SELECT *, md5('{mix.seed}|' || epochs || '|' || id) AS place FROM placed)""",
        """summed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto
  FROM ordered)""",
    ]
    return f"""WITH {", ".join(parts)}
SELECT doc_id, domain, lang_was AS lang, source_was AS source, tokens::BIGINT AS n_tokens,
       (epochs + CASE WHEN upto <= rest AND rest > 0 THEN 1 ELSE 0 END)::BIGINT AS copies
FROM summed"""


NGRAM_JACCARD = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_LOWER.replace("text", "coalesce(text, '')", 1)}, '{_WORD}') AS w
  FROM documents),
sets AS (
  SELECT doc_id,
         list_distinct(CASE WHEN len(w) >= 3
           THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM worded),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT r.doc_id, l.y FROM reached r JOIN links l ON r.other = l.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reached r USING (doc_id) GROUP BY s.doc_id, s.s"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
