"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .licenses import ANCHORS, REFERENCE, RULES, SENTENCE_END, SENTENCES

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[k : k + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM i WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM iw
), dw AS (
  SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, k, n, item_id FROM dw JOIN iw USING (n, g)
), words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id
), items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""

OP4 = r"""
WITH c AS (
  SELECT source, lang, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) AS nth,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]{2,}')) AS long_words,
         len(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS pieces
  FROM documents
), t AS (
  SELECT source, lang, 'words-1' AS tokenizer, long_words AS n FROM c WHERE nth = 1
  UNION ALL SELECT source, lang, 'pieces-1', pieces FROM c WHERE nth = 1
)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM t GROUP BY source, lang, tokenizer
"""

OP9 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def _licenses() -> str:
    cases = " ".join(f"WHEN '{s}' THEN '{i}'" for s, i in SENTENCES)
    steps, last = [], "r0"
    for k, (name, seq) in enumerate(RULES, 1):
        ids = "".join(f"[{i}]" for i in seq)
        steps.append(
            f"r{k} AS (SELECT doc_id, ids, replace(rest, '{ids}', '[]') AS rest,"
            f" CASE WHEN contains(rest, '{ids}') AND NOT list_contains(found, '{name}') THEN list_append(found, '{name}') ELSE found END AS found FROM {last})"
        )
        last = f"r{k}"
    folded = _FOLD.format("s")
    clean = f"regexp_replace(regexp_replace(regexp_replace({folded}, '[^a-z0-9.+]+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g'), '{REFERENCE}', 'under ')"
    return f"""
WITH s AS (
  SELECT doc_id, CASE WHEN regexp_matches({_FOLD.format("coalesce(text, '')")}, '{ANCHORS}')
         THEN list_transform(string_split_regex(text, '{SENTENCE_END}'), lambda s: {clean}) ELSE [] END AS said FROM documents
), i AS (
  SELECT doc_id, list_filter(list_transform(said, lambda s: CASE s {cases} END), lambda x: x IS NOT NULL) AS ids FROM s
), r0 AS (
  SELECT doc_id, ids, coalesce(array_to_string(list_transform(ids, lambda x: '[' || x || ']'), ''), '') AS rest, CAST([] AS VARCHAR[]) AS found FROM i
), {", ".join(steps)}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(array_to_string(found, ','), '') AS licenses FROM {last}
"""


OP10 = _licenses()
