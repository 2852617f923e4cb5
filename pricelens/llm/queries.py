"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return keep


@query("op6_personal_data")
def op6(spark, sf_dir):
    from pricelens.llm.pii import find_personal_data
    return find_personal_data(table(spark, sf_dir, "documents"))


@query("op7_hilbert_shards")
def op7(spark, sf_dir):
    from pricelens.llm.hilbert_shards import hilbert_shards
    return hilbert_shards(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source FROM documents),
words AS (SELECT r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs),
windows AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words)),
twice AS (SELECT r, i FROM windows JOIN (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1) USING (r, g)),
inside AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, l FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM docs) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dups AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY r),
stats AS (
  SELECT r, doc_id, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines, coalesce(inside.n, 0) AS n_repeat_words
  FROM docs JOIN words USING (r) LEFT JOIN dups USING (r) LEFT JOIN inside USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM stats),
hosts AS (SELECT source, count(*)::DOUBLE AS d, count(*) FILTER (base_failed)::DOUBLE AS f FROM judged GROUP BY source),
corpus AS (SELECT sum(f) / sum(d) AS m, sum(d) AS d, count(*)::DOUBLE AS k, sum(f * f / d) / sum(d) AS s2 FROM hosts),
prior AS (SELECT m, greatest(m * (1 - m) / greatest(s2 - m * m - m * (1 - m) * k / d, 1e-6) - 1, 1.0) AS strength FROM corpus),
verdicts AS (SELECT source, (f + m * strength) / (hosts.d + strength) <= 0.6 AS host_kept FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""


@query("op8_quality_rules", OP8_SQL)
def op8(spark, sf_dir):
    from pricelens.llm.quality import quality_rules
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op9_fingerprints")
def op9(spark, sf_dir):
    from pricelens.llm.fingerprints import fingerprint_documents
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query("op5_packing")
def op5(spark, sf_dir):
    from pricelens.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"))


@query("op10_token_files")
def op10(spark, sf_dir):
    from pricelens.llm.rans import token_files
    return token_files(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
firsts AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM windows JOIN firsts USING (h) WHERE least < doc_id),
kept AS (
  SELECT words.doc_id, len(w) AS n_words, coalesce(ps, []) AS ps, w FROM words
  LEFT JOIN (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id) USING (doc_id)),
each AS (SELECT k.doc_id, u.p, w[u.p] AS word FROM kept k, unnest(range(1, len(w) + 1)) AS u(p)),
texts AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.p) AS t FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id)
SELECT kept.doc_id, n_words, CAST(len(ps) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM kept LEFT JOIN texts USING (doc_id)
"""


@query("op3_substring_dedup", OP3_SQL)
def op3(spark, sf_dir):
    from pricelens.llm.substring_dedup import dedup_passages
    return dedup_passages(table(spark, sf_dir, "documents"), keep_text=False)


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


@query("op4_chat_format", OP4_SQL)
def op4(spark, sf_dir):
    from pricelens.llm.chat_format import digests, format_conversations
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(format_conversations(rows.unionByName(own)))


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
"""


@query("op1_ngram_join", OP1_SQL)
def op1(spark, sf_dir):
    from pricelens.llm.ngram_join import ngram_components
    return ngram_components(table(spark, sf_dir, "documents"))


@query("op2_sentencepiece")
def op2(spark, sf_dir):
    from pricelens.llm.sentencepiece_lattice import encode_documents
    return encode_documents(table(spark, sf_dir, "documents"), keep_ids=False)


def _crc32(s: str) -> str:
    """DuckDB SQL of the CRC-32 of an ASCII string expression."""
    return f"""xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length({s}) + 1), lambda i: ord(({s})[i:i])::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda r, k: xor(r >> 1, 3988292384::UBIGINT * (r & 1)))), 4294967295::UBIGINT)"""


OP11_SQL = rf"""
WITH RECURSIVE filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
damaged AS (
  SELECT coalesce(conv_id, -9223372036854775808) AS c, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM filled, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) u(x)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
marked AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS seen, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS kept, left(role, 1) AS r FROM numbered),
faults AS (
  SELECT *, CASE WHEN kept = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(kept, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(r) OVER (PARTITION BY c ORDER BY i) AS before FROM marked),
steps AS (
  SELECT * FROM (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')) v(q, gives, after)),
sizes AS (SELECT c, count(*) AS n FROM faults GROUP BY c),
moves AS (
  SELECT '' AS q, 'u' AS after, 'I' AS letters, 3 AS cost UNION ALL SELECT 's', 'u', 'I', 3 UNION ALL SELECT 'u', 'a', 'I', 3 UNION ALL SELECT 'a', 'u', 'I', 3
  UNION ALL SELECT '', 'a', 'II', 6 UNION ALL SELECT 's', 'a', 'II', 6
  UNION ALL SELECT q, q, '', 0 FROM (VALUES ('',), ('s',), ('u',), ('a',)) v(q)),
best(c, i, q, b) AS (
  SELECT c, 0::BIGINT, after, {{'cost': cost, 'audit': letters}} FROM sizes, moves WHERE q = ''
  UNION ALL
  SELECT c, i, q, min(b) FROM (
    SELECT t.c, t.i, m.after AS q, {{'cost': t.b.cost + m.cost, 'audit': t.b.audit || m.letters}} AS b
    FROM (
      SELECT f.c, f.i, e.after AS q, min({{'cost': best.b.cost + e.cost, 'audit': best.b.audit || e.letter}}) AS b
      FROM best JOIN faults f ON f.c = best.c AND f.i = best.i + 1,
        LATERAL (
          SELECT best.q AS after, 4 AS cost, 'D' AS letter
          UNION ALL SELECT s.after, CASE f.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K' FROM steps s WHERE s.q = best.q AND s.gives = f.r AND f.fault NOT IN ('blank', 'duplicate')
          UNION ALL SELECT s.after, CASE f.fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R' FROM steps s WHERE s.q = best.q AND s.gives <> 's' AND f.fault NOT IN ('blank', 'duplicate')) e
      GROUP BY f.c, f.i, e.after) t JOIN moves m ON m.q = t.q)
  GROUP BY c, i, q),
chosen AS (SELECT c, min(b) AS b FROM best JOIN sizes USING (c) WHERE i = n AND q IN ('', 'a') GROUP BY c),
letters AS (SELECT c, p, b.audit[p:p] AS e FROM chosen, unnest(range(1, length(b.audit) + 1)) u(p)),
placed AS (
  SELECT c, p, e, count(*) FILTER (e <> 'I') OVER (PARTITION BY c ORDER BY p) AS i, count(*) FILTER (e <> 'D') OVER (PARTITION BY c ORDER BY p) AS k FROM letters),
given AS (
  SELECT placed.c, p, CASE e WHEN 'K' THEN role WHEN 'D' THEN NULL ELSE CASE WHEN (k - CASE WHEN first_is_s THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END END AS role,
    CASE e WHEN 'I' THEN '' ELSE text END AS text
  FROM placed JOIN (
    SELECT x.c, coalesce(bool_or(k = 1 AND e = 'K' AND r = 's'), false) AS first_is_s FROM placed x LEFT JOIN faults f ON f.c = x.c AND f.i = x.i GROUP BY x.c) USING (c)
  LEFT JOIN faults f ON f.c = placed.c AND f.i = placed.i AND e <> 'I' WHERE e <> 'D'),
texts AS (SELECT c, string_agg(role || ':' || text, chr(10) ORDER BY p) AS t FROM given GROUP BY c),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY c)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost, coalesce(b.audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id, -9223372036854775808) AS c FROM conversations) ids
LEFT JOIN counts USING (c) LEFT JOIN chosen USING (c) LEFT JOIN texts USING (c)
"""


@query("op11_conversation_repair", OP11_SQL)
def op11(spark, sf_dir):
    from pricelens.llm.conversation_repair import damage, repair_digests
    conversations = table(spark, sf_dir, "conversations")
    return repair_digests(damage(conversations), conversations)


OP12_SQL = rf"""
WITH RECURSIVE coded AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce('=' || lang, '') AS g,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered, {_crc32("doc_id::VARCHAR")} % 3 AS m FROM documents),
leaves AS (
  SELECT r, doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN m = 0 AND text IS NOT NULL THEN sha256(head || strlen(lowered) || ':' || lowered) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS changed FROM coded),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY g) AS n FROM leaves),
trees(g, lvl, k, n, h) AS (
  SELECT g, 0, k, n, leaf FROM ranked
  UNION ALL
  SELECT g, lvl + 1, k // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY k)) FROM trees WHERE n > 1 GROUP BY g, lvl, k // 8, n),
subroots AS (SELECT g, h, lvl, row_number() OVER (ORDER BY g) - 1 AS k, count(*) OVER () AS n FROM trees WHERE n = 1),
top(lvl, k, n, h) AS (
  SELECT 0, k, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, k // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY k)) FROM top WHERE n > 1 GROUP BY lvl, k // 8, n),
nodes AS (
  SELECT g AS tree, lvl, k, n, h FROM trees UNION ALL SELECT NULL, lvl, k, n, h FROM top),
places AS (
  SELECT r.r, t.lvl::BIGINT AS step, r.g AS tree, t.lvl, r.k // (8 ** t.lvl)::BIGINT AS k FROM ranked r JOIN (SELECT DISTINCT g, lvl FROM trees WHERE n > 1) t ON t.g = r.g
  UNION ALL
  SELECT r.r, s.lvl + t.lvl, NULL, t.lvl, s.k // (8 ** t.lvl)::BIGINT FROM ranked r JOIN subroots s ON s.g = r.g, (SELECT DISTINCT lvl FROM top WHERE n > 1) t),
runs AS (
  SELECT p.r, p.step, p.k AS mine, n.k, n.h FROM places p JOIN nodes n ON n.tree IS NOT DISTINCT FROM p.tree AND n.lvl = p.lvl AND n.k // 8 = p.k // 8),
proofs AS (SELECT r, sha256(string_agg(h, '' ORDER BY step, k)) AS proof FROM runs WHERE k <> mine GROUP BY r),
folds(r, step, h) AS (
  SELECT r, 0::BIGINT, changed FROM ranked
  UNION ALL
  SELECT f.r, f.step + 1, sha256(string_agg(CASE WHEN u.k = u.mine THEN f.h ELSE u.h END, '' ORDER BY u.k)) FROM folds f JOIN runs u ON u.r = f.r AND u.step = f.step GROUP BY f.r, f.step),
ends AS (SELECT r, arg_max(h, step) AS folded FROM folds GROUP BY r)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = t.h AS verified
FROM ranked JOIN subroots s USING (g) JOIN ends USING (r) LEFT JOIN proofs USING (r), (SELECT h FROM top WHERE n = 1) t
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12(spark, sf_dir):
    from pricelens.llm.merkle_manifest import verify_documents
    return verify_documents(table(spark, sf_dir, "documents"))


def _op13_sql() -> str:
    from pricelens.llm.secret_scan import ACCESS, ASSIGNED, HEX, KINDS, PATTERNS, REACH, WEAK_ASSIGNED
    sql = {k: p.replace("'", "''") for k, p in PATTERNS.items()}
    lists = ",\n  ".join(f"list_transform(regexp_extract_all(text, '{sql[k]}', 0), lambda x: length(x)) AS len_{k}, list_transform(regexp_split_to_array(text, '{sql[k]}'), lambda x: length(x)) AS gap_{k}"
                         for k in KINDS)
    values = f"regexp_extract_all(text, '{sql['assign']}', 2) AS assigned, regexp_extract_all(text, '{sql['bare']}', 0) AS bares"
    rows = "\n  UNION ALL ".join(
        f"SELECT r, {i} AS kind, unnest(list_transform(range(1, len(len_{k}) + 1), lambda j: {{'end': list_sum(gap_{k}[1:j]) + list_sum(len_{k}[1:j]), 'len': len_{k}[j], "
        f"'value': {'length(assigned[j])' if k == 'assign' else '1'}, 'mixed': {'regexp_matches(bares[j], ' + chr(39) + '[0-9]' + chr(39) + ') AND regexp_matches(bares[j], ' + chr(39) + '[A-Z]' + chr(39) + ') AND regexp_matches(bares[j], ' + chr(39) + '[a-z]' + chr(39) + ')' if k == 'bare' else 'true'}}})) AS m FROM texts"
        for i, k in enumerate(KINDS))
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, {values},
  {lists} FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
matched AS (
  {rows}),
parts AS (
  SELECT r, kind, m."end" - m.len AS a, m."end" AS z, CASE WHEN kind = 0 THEN m.value >= {ASSIGNED} ELSE m.mixed END AS good, kind = 0 AND m.value < {WEAK_ASSIGNED} AS nothing FROM matched),
strong AS (SELECT r, kind, a, z FROM parts WHERE kind < 3 AND good),
ids AS (SELECT r, kind, a, z FROM parts WHERE kind = 3 UNION ALL SELECT * FROM strong WHERE kind = 1),
weak AS (SELECT r, CASE kind WHEN 0 THEN 4 ELSE kind END AS kind, a, z FROM parts WHERE kind = 4 OR (kind = 5 AND good) OR (kind = 0 AND NOT good AND NOT nothing)),
secrets AS (SELECT *, true AS weak FROM weak UNION ALL SELECT *, false FROM strong WHERE kind <> 1),
meet AS (SELECT i.r, i.kind AS ik, i.a AS ia, i.z AS iz, s.kind, s.a, s.z, s.weak FROM ids i JOIN secrets s ON s.r = i.r AND s.a <= i.z + {REACH} AND s.z >= i.a - {REACH}),
linked AS (
  SELECT r, ik AS kind, ia AS a, iz AS z FROM meet WHERE ik = 3
  UNION SELECT r, kind, a, z FROM meet WHERE weak
  UNION SELECT p.r, p.kind, p.a, p.z FROM meet i JOIN parts p ON p.kind = 6 AND p.r = i.r AND p.a <= i.iz + {REACH} AND p.z >= i.ia - {REACH}),
named AS (
  SELECT r, kind, a, z, true AS base, {names}[kind + 1] || ':' || a || ':' || z AS s FROM strong
  UNION ALL SELECT r, kind, a, z, false, {names}[kind + 1] || ':' || a || ':' || z FROM linked),
joined AS (
  SELECT r, count(*) FILTER (base AND kind = 0) AS n_assign, count(*) FILTER (base AND kind = 1) AS n_access, count(*) FILTER (base AND kind = 2) AS n_hex,
    string_agg(s, ',' ORDER BY a, kind, z) FILTER (base) AS b, string_agg(s, ',' ORDER BY a, kind, z) AS spans, count(*) FILTER (NOT base) AS n_linked FROM named GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_linked, 0) AS n_linked
FROM texts LEFT JOIN joined USING (r)
"""


@query("op13_secret_scan", _op13_sql())
def op13(spark, sf_dir):
    from pricelens.llm.secret_scan import find_secrets
    return find_secrets(table(spark, sf_dir, "documents"))
