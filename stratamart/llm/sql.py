"""SQL twins of the operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from stratamart.llm.ball_kmeans import ENTRIES, PARTS, ROUNDS, SCALE
from stratamart.llm.mixing import MAX_EPOCHS, SEED
from stratamart.llm.quality_rules import MIN_WORDS, RULES, STOP_WORDS, SYMBOLS

WORD = r"[^\x20\x09-\x0D]+"

#: Each rule over the measures: the names of the broken ones.
_BROKEN = ", ".join(f"CASE WHEN {r.bottom} > 0 AND NOT ({r.top}::DOUBLE / {r.bottom} BETWEEN {r.low} AND {r.high}) THEN '{r.name}' END" for r in RULES)
_STOP = ", ".join(f"'{w}'" for w in sorted({w for line in STOP_WORDS.values() for w in line.split()}))


def _count(kept: str) -> str:
    return rf"length(regexp_replace(t, '[^{kept}]+', '', 'g'))"


MEASURES = rf"""
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {{docs}}),
w AS (SELECT rid, unnest(regexp_extract_all(t, '{WORD}')) AS word, generate_subscripts(regexp_extract_all(t, '{WORD}'), 1) AS i FROM d),
per_word AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (word IN ({_STOP})) AS n_stop_words FROM w GROUP BY rid),
win AS (SELECT rid, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS g FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win WHERE g IS NOT NULL) WHERE n > 1),
per_rep AS (SELECT rid, sum(least(3, coalesce(nxt - i, 3))) AS n_repeat_words
            FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM rep) GROUP BY rid),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
per_line AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
             FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             {_count(SYMBOLS)} AS n_symbols, {_count('!?')} AS n_marks, {_count(chr(92) + 'p{{L}}')} AS n_letters, {_count(chr(92) + 'p{{Lu}}')} AS n_capitals,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_stop_words, 0) AS n_stop_words, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN per_word USING (rid) LEFT JOIN per_rep USING (rid) LEFT JOIN per_line USING (rid)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, concat_ws(',', {_BROKEN}) AS broken FROM m)
"""

OP3 = f"""
WITH {MEASURES.format(docs='documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND broken = '' AS kept, broken FROM v
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
                  md5('{SEED}/' || coalesce(CAST(doc_id AS VARCHAR), '-') || '/' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
c AS (SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, {MAX_EPOCHS} * source_size AS cap FROM s),
b AS (SELECT *, cap / weight AS reach, sum(cap) OVER o - cap AS caps_before, sum(weight) OVER o - weight AS weights_before,
             sum(source_size) OVER () AS words, sum(weight) OVER () AS weights
      FROM c WINDOW o AS (ORDER BY cap / weight, r ROWS UNBOUNDED PRECEDING)),
l AS (SELECT arg_min(level, (reach, r)) AS level FROM
      (SELECT *, (words - caps_before)::DOUBLE / (weights - weights_before)::DOUBLE AS level FROM b) WHERE level <= reach),
t AS (SELECT source, source_size, least(level * weight, cap::DOUBLE) AS target FROM b, l),
e AS (SELECT *, floor(target + 0.5)::BIGINT AS budget, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, d.key, d.size, e.*, budget - epochs * source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS UNBOUNDED PRECEDING) - d.size AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
x AS (SELECT *, max(key) FILTER (before < rest) OVER (PARTITION BY source) AS cut_key FROM p),
y AS (SELECT *, least((rest - min(before) OVER (PARTITION BY source, key)) // count(*) OVER (PARTITION BY source, key), size) AS part FROM x)
SELECT doc_id, size, source_size, target,
       (epochs * size + CASE WHEN key < cut_key THEN size WHEN key = cut_key THEN part ELSE 0 END)::BIGINT AS taken FROM y
"""


def _round(k: int) -> str:
    """Parts with the nearest entry of codebook k, and (all but the last time) codebook k + 1."""
    nearest = f"""
a{k} AS MATERIALIZED (SELECT rid, part, min(struct_pack(d := d, e := entry)) AS best FROM
  (SELECT x.rid, x.part, c.entry, list_sum(list_transform(list_zip(x.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
   FROM x JOIN c{k} c USING (part)) GROUP BY rid, part)"""
    if k == ROUNDS:
        return nearest
    return nearest + f""",
m{k} AS (SELECT part, entry, list((s - (((s % n) + n) % n)) // n ORDER BY j)::BIGINT[] AS x FROM
  (SELECT x.part, best.e AS entry, j, sum(x.x[j]) AS s, count(*) AS n FROM x JOIN a{k} USING (rid, part), (SELECT unnest(range(1, (SELECT max(len(x)) FROM x) + 1)) AS j)
   GROUP BY x.part, best.e, j) GROUP BY part, entry),
c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m USING (part, entry))"""


OP11 = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
x AS MATERIALIZED (SELECT rid, part, list_slice(v, (part * len(v) // {PARTS} + 1)::BIGINT, ((part + 1) * len(v) // {PARTS})::BIGINT) AS x FROM v, (SELECT unnest(range(0, {PARTS})) AS part)),
f AS (SELECT rid, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM v WHERE vec_id IS NOT NULL ORDER BY entry LIMIT {ENTRIES}),
c0 AS MATERIALIZED (SELECT part, entry, x FROM x JOIN f USING (rid)),
{",".join(_round(k) for k in range(ROUNDS + 1))},
s AS (SELECT sha256(string_agg(value::VARCHAR, ',' ORDER BY part, entry, j)) AS codebooks_sha256 FROM
  (SELECT part, entry, unnest(x) AS value, generate_subscripts(x, 1) AS j FROM c{ROUNDS})),
r AS (SELECT rid, string_agg(format('{{:02x}}', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM v JOIN r USING (rid), s
"""

STATEMENTS = {"op3_quality_rules": OP3, "op10_source_mix": OP10, "op11_ball_kmeans": OP11}
