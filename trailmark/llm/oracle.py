"""The queries in DuckDB SQL, where SQL can express them."""

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

op1_mix_sources = rf"""
WITH sized AS (SELECT doc_id, source, {_WORDS} AS size, md5(concat_ws(':', '17', coalesce(doc_id::VARCHAR, md5(text)))) AS draw FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3.0::DOUBLE * sum(size)::BIGINT AS held,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, row_number() OVER by_ratio AS place,
         ((sum(source_size) OVER ())::BIGINT
          - coalesce(sum(held) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (by_ratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources WINDOW by_ratio AS (ORDER BY held / w, source NULLS LAST)),
targets AS (
  SELECT source, source_size,
         least(held, coalesce(w * (SELECT arg_min(level, place) FROM levels WHERE held > level * w), held)) AS target
  FROM levels),
placed AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(least(size, floor(target) - before), 0) + greatest(least(size, floor(target) - before - source_size), 0)
        + greatest(least(size, floor(target) - before - 2 * source_size), 0))::BIGINT AS taken
FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source
"""

op8_exact_dedup = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS kept,
       sha256(content) AS text_sha256
FROM rows
"""

op13_search = r"""
WITH found AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
sized AS (SELECT row, doc_id, len(terms) AS n FROM found WHERE len(terms) > 0),
whole AS (SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS terms FROM sized),
postings AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM found) GROUP BY row, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, whole GROUP BY term, documents),
asked AS (
  SELECT row AS query, item_id, unnest(list_distinct(terms)) AS term
  FROM (SELECT row_number() OVER () AS row, item_id,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM benchmark)),
scored AS (
  SELECT query, item_id, doc_id, row,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // terms))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN sized USING (row), whole
  GROUP BY query, item_id, doc_id, row),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def oracle_sql():
    return {name: value for name, value in globals().items() if name.startswith("op") and isinstance(value, str)}
