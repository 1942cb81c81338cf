"""DuckDB twins of the queries that SQL can express."""

# The same rules as the operator: 16-section search of the exponent in 5 rounds, entropy 0.998 of the
# largest, at most 4 repetitions, budget = all tokens, blocks of 2^20 tokens, seed 7.
_WORDS = r"length(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"


def _hash(*parts: str) -> str:
    joined = " || '|' || ".join(f"coalesce(({p})::VARCHAR, '')" for p in parts)
    return f"('0x' || substr(md5({joined}), 1, 15))::BIGINT"


OP4 = f"""
WITH RECURSIVE counted AS (
  SELECT doc_id, source, coalesce({_WORDS}, 0)::BIGINT AS n_tokens FROM documents),
sources AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM counted WHERE n_tokens > 0 GROUP BY source),
shares AS (SELECT source, tokens, tokens / (SELECT sum(tokens) FROM sources)::DOUBLE AS p FROM sources),
curve AS (
  SELECT i, ln(sum(pow(p, i / 1048576.0::DOUBLE)))
            - sum(pow(p, i / 1048576.0::DOUBLE) * ln(pow(p, i / 1048576.0::DOUBLE))) / sum(pow(p, i / 1048576.0::DOUBLE)) AS h,
         max(pow(p, i / 1048576.0::DOUBLE) / p) / sum(pow(p, i / 1048576.0::DOUBLE)) AS r
  FROM shares, (SELECT unnest(range(0, 1048577, 65536)) AS i) GROUP BY i),
flat(round, low) AS (
  SELECT 0, 0
  UNION ALL
  SELECT round + 1, low + (1048576 >> (4 * (round + 1))) * (
    SELECT count(*) FROM (SELECT unnest(range(1, 16)) AS k) WHERE (
      SELECT ln(sum(x)) - sum(x * ln(x)) / sum(x) >= 0.998 * ln(count(*)) - 1e-12
      FROM (SELECT pow(p, (low + k * (1048576 >> (4 * (round + 1)))) / 1048576.0::DOUBLE) AS x FROM shares)))
  FROM flat WHERE round < 5),
tight(round, low) AS (
  SELECT 0, 0
  UNION ALL
  SELECT round + 1, low + (1048576 >> (4 * (round + 1))) * (
    SELECT count(*) FROM (SELECT unnest(range(1, 16)) AS k) WHERE (
      SELECT max(x / p) / sum(x) > 4.0 + 1e-12
      FROM (SELECT p, pow(p, (low + k * (1048576 >> (4 * (round + 1)))) / 1048576.0::DOUBLE) AS x FROM shares)))
  FROM tight WHERE round < 5),
chosen AS (
  SELECT greatest(
    CASE WHEN (SELECT h FROM curve WHERE i = 1048576) >= 0.998 * ln((SELECT count(*) FROM shares)) - 1e-12 THEN 1048576
         WHEN (SELECT h FROM curve WHERE i = 0) < 0.998 * ln((SELECT count(*) FROM shares)) - 1e-12 THEN 0
         ELSE (SELECT low FROM flat WHERE round = 5) END,
    CASE WHEN (SELECT r FROM curve WHERE i = 0) <= 4.0 + 1e-12 THEN 0
         WHEN (SELECT r FROM curve WHERE i = 1048576) > 4.0 + 1e-12 THEN 1048576
         ELSE (SELECT low + 1 FROM tight WHERE round = 5) END) / 1048576.0::DOUBLE AS a),
plan AS (
  SELECT source, tokens, floor(round(pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, chosen)
         * (SELECT sum(tokens) FROM sources)::DOUBLE, 3))::BIGINT AS quota
  FROM shares, chosen),
sized AS (SELECT source, quota // tokens AS epochs, quota % tokens AS rest, (tokens + 1048575) // 1048576 AS blocks FROM plan),
dealt AS (
  SELECT c.doc_id, c.source, c.n_tokens, s.epochs, s.rest, {_hash("7", "'block'", "c.doc_id")} % s.blocks AS block
  FROM counted c JOIN sized s ON c.source IS NOT DISTINCT FROM s.source WHERE c.n_tokens > 0),
held AS (
  SELECT source, block, rest, epochs, sum(n_tokens) AS held FROM dealt GROUP BY ALL),
cut AS (
  SELECT source, block, held, rest + held - sum(held) OVER (
    PARTITION BY source ORDER BY {_hash("7", "epochs", "source", "block")}, block) AS left_over FROM held),
placed AS (
  SELECT d.*, c.held, c.left_over FROM dealt d JOIN cut c ON d.source IS NOT DISTINCT FROM c.source AND d.block = c.block),
edge AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, block ORDER BY {_hash("7", "epochs", "doc_id")}, doc_id, n_tokens
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sofar
  FROM placed WHERE left_over > 0 AND left_over < held)
SELECT doc_id, source, n_tokens, unnest(range(0, epochs + (left_over >= held)::BIGINT)) AS epoch, block FROM placed
UNION ALL
SELECT doc_id, source, n_tokens, epochs AS epoch, block FROM edge WHERE sofar <= left_over
"""

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BITS = "array_to_string([right(('0x' || hex[i])::INTEGER::BIT::VARCHAR, 4) for i in range(1, 41)], '')"
_VALUE = " + ".join(f"CASE WHEN bits[5 * i + {j + 1}] = '1' THEN {16 >> j} ELSE 0 END" for j in range(5))

OP1 = f"""
WITH paid AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT *, {_BITS} AS bits FROM paid),
named AS (
  SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first,
         array_to_string([substr('{_ALPHABET}', 1 + {_VALUE}, 1) for i in range(0, 32)], '') AS payload_digest
  FROM bits)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM named
"""

OP6 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, least(a, min(b)) AS component FROM reached GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id,
       vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN counted c ON c.a = vec_id LEFT JOIN least l ON l.a = vec_id
"""

OP8 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

OP3 = r"""
WITH texts AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM texts),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM texts WHERE len(w) >= 20),
windows AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS s FROM starts),
ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 AS again FROM windows),
covered AS (
  SELECT doc_id, p, word, coalesce(max(coalesce(again, false)::INTEGER) OVER (
    PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
  FROM words LEFT JOIN ranked USING (doc_id, p)),
cut AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept
  FROM covered GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""

# Damage by crc32 of conversation and turn, then the least (cost, audit) per state row by row: 0 nothing yet, 1 after
# system, 2 after user, 3 after assistant. More than two insertions at one place never pay.
_CRC = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""

OP12 = rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
diced AS (SELECT *, ({_CRC}) % 20 AS dice FROM named),
spoilt AS (
  SELECT conv_id, turn, CASE WHEN dice = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN dice = 1 THEN '' WHEN dice = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE dice WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM diced),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS p FROM spoilt),
faults AS (
  SELECT *, substr(role, 1, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 'truncated' ELSE '' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS earlier
  FROM placed),
steps(a, letter, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts(a, b, cost, audit) AS (
  SELECT DISTINCT a, a, 0, '' FROM (VALUES (0), (1), (2), (3)) t(a)
  UNION ALL SELECT a, b, 2, 'I' FROM steps WHERE letter <> 's'
  UNION ALL SELECT x.a, y.b, 4, 'II' FROM steps x JOIN steps y ON x.b = y.a WHERE x.letter <> 's' AND y.letter <> 's'),
edits AS (
  SELECT p, conv_id, s.a, s.a AS b, 3 AS cost, 'D' AS audit FROM faults, (VALUES (0), (1), (2), (3)) s(a)
  UNION ALL
  SELECT p, conv_id, a, b, (fault = 'truncated')::INTEGER, 'K' FROM faults JOIN steps ON initial = letter WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT p, conv_id, a, b, 2 + (fault = 'truncated')::INTEGER, 'R' FROM faults, steps WHERE letter <> 's' AND fault NOT IN ('blank', 'duplicate')),
moves AS (
  SELECT e.conv_id, e.p, e.a, i.b, min({{'cost': e.cost + i.cost, 'audit': e.audit || i.audit}}) AS best
  FROM edits e JOIN inserts i ON e.b = i.a GROUP BY ALL),
reached(conv_id, p, b, cost, audit) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, i.b, i.cost::BIGINT, i.audit FROM faults, inserts i WHERE i.a = 0
  UNION ALL
  SELECT conv_id, p, b, best.cost, best.audit FROM (
    SELECT r.conv_id, m.p, m.b, min({{'cost': r.cost + m.best.cost, 'audit': r.audit || m.best.audit}}) AS best
    FROM reached r JOIN moves m ON m.conv_id IS NOT DISTINCT FROM r.conv_id AND m.p = r.p + 1 AND m.a = r.b
    GROUP BY r.conv_id, m.p, m.b)),
counted AS (
  SELECT conv_id, max(p) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (p > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
cheapest AS (
  SELECT c.*, min({{'cost': r.cost, 'audit': r.audit}}) AS best
  FROM counted c JOIN reached r ON c.conv_id IS NOT DISTINCT FROM r.conv_id AND c.n = r.p WHERE r.b IN (0, 3) GROUP BY ALL),
letters AS (
  SELECT conv_id, unnest(string_split(best.audit, '')) AS edit, unnest(range(1, length(best.audit) + 1)) AS i FROM cheapest WHERE best.audit <> ''),
counts AS (
  SELECT *, sum((edit <> 'I')::INTEGER) OVER w AS p, sum((edit <> 'D')::INTEGER) OVER w AS place FROM letters
  WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
turned AS (
  SELECT l.conv_id, l.place, l.edit, f.role, f.text, max((l.place = 1 AND l.edit = 'K' AND f.initial = 's')::INTEGER) OVER (PARTITION BY l.conv_id) AS systems
  FROM counts l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.p = l.p AND l.edit <> 'I' WHERE l.edit <> 'D'),
lines AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - systems) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || coalesce(text, ''), chr(10) ORDER BY place) AS said
  FROM turned GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN cheapest c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM o.conv_id
"""

SQL: dict[str, str] = {"op3_substring_dedup": OP3, "op6_embedding_near_dedup": OP6, "op8_exact_top_k": OP8, "op1_warc_archives": OP1, "op4_source_mixing": OP4,
                       "op12_conversation_repair": OP12}
