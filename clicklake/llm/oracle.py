"""DuckDB SQL for the queries whose rows SQL can express."""

from __future__ import annotations

from clicklake.llm import licenses
from clicklake.llm.chat import BEGIN, CONTROL, NAMED, OTHER, OTHER_END, TURNS
from clicklake.llm.mixing import BLOCK, CAP, SHARE

_MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5('document:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) AS place
  FROM documents),
stats AS (
  SELECT source, sum(size) AS source_size, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END)::DOUBLE AS weight
  FROM sized GROUP BY source),
room AS (
  SELECT *, source_size * {CAP}::DOUBLE AS most, (SELECT sum(source_size) * {SHARE}::DOUBLE FROM stats) AS total FROM stats),
levels AS (
  SELECT *, (total - coalesce(sum(most) OVER before_it, 0)) / sum(weight) OVER from_it AS level
  FROM room
  WINDOW before_it AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         from_it AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
goals AS (
  SELECT source, source_size,
         least(most, coalesce((SELECT max(level) FROM levels WHERE level * weight < most) * weight, most)) AS target
  FROM levels),
plans AS (
  SELECT *, ceil(source_size / {BLOCK}.0)::BIGINT AS blocks, floor(target / greatest(source_size, 1))::BIGINT AS whole FROM goals),
quotas AS (
  SELECT *, whole * blocks + least(blocks, round((target - whole * source_size) / {BLOCK})::BIGINT) AS quota FROM plans),
axis AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized WHERE size > 0),
parts AS (
  SELECT doc_id, place, source, start, size, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) AS block FROM axis),
ranks AS (
  SELECT source, block,
         row_number() OVER (PARTITION BY source ORDER BY CAST('0x' || substr(md5('block1:' || coalesce('=' || source, 'null') || ':' || block), 1, 13) AS BIGINT), block) - 1 AS rank
  FROM (SELECT DISTINCT source, block FROM parts)),
drawn AS (
  SELECT p.doc_id, p.place, p.source,
         (least(p.size, (p.block + 1) * {BLOCK} - p.start) - greatest(0, p.block * {BLOCK} - p.start)) * greatest(0, ceil((q.quota - r.rank) / q.blocks::DOUBLE)) AS words
  FROM parts p JOIN ranks r ON p.source IS NOT DISTINCT FROM r.source AND p.block = r.block
  JOIN quotas q ON q.source IS NOT DISTINCT FROM p.source),
got AS (SELECT doc_id, place, source, sum(words) AS words FROM drawn GROUP BY ALL)
SELECT s.doc_id, s.size::BIGINT AS size, q.source_size::BIGINT AS source_size, q.target, coalesce(g.words, 0)::BIGINT AS taken
FROM sized s JOIN quotas q ON q.source IS NOT DISTINCT FROM s.source
LEFT JOIN got g ON g.doc_id IS NOT DISTINCT FROM s.doc_id AND g.place = s.place AND g.source IS NOT DISTINCT FROM s.source
"""



def _chat_sql() -> str:
    escaped = r"replace(text, '\', '\\')"
    for mark in CONTROL:
        escaped = rf"replace({escaped}, '{mark}', '{mark[0]}\{mark[1:]}')"
    around = "".join(f"WHEN '{role}' THEN {len(a) + len(b) + 2} " for role, (a, b) in TURNS.items())
    other = f"{len(OTHER) + len(NAMED) + len(OTHER_END) + 4} + length({escaped.replace('replace(text', 'replace(role')})"
    return rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       ({len(BEGIN)} + sum(length({escaped}) + CASE role {around}ELSE {other} END))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


def _license_sql() -> str:
    base = " UNION ALL ".join(f"SELECT '{label}' AS label, {[w for w in phrase.split()]} AS phrase" for phrase, label in licenses.BASE)
    templates = " UNION ALL ".join(
        f"SELECT {n} AS t, '{t.label}' AS label, {t.words} AS words, {t.key_at} AS key_at, {t.key.split()} AS key" for n, t in enumerate(licenses.TEMPLATES)
    )
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
base AS ({base}),
templates AS ({templates}),
slots AS (SELECT t, unnest(range(0, len(words))) AS k, unnest(words) AS word FROM templates),
vocabulary AS (SELECT DISTINCT word FROM slots),
seen AS (SELECT r, i, words[i + 1] AS word FROM (SELECT r, words, unnest(range(0, len(words))) AS i FROM docs)),
found AS (SELECT r, i, word FROM seen WHERE word IN (SELECT word FROM vocabulary)),
weight AS (
  SELECT v.word, ln(((SELECT count(*) FROM docs) + 1) / (count(DISTINCT f.r) + 1)) + 1 AS w FROM vocabulary v LEFT JOIN found f ON f.word = v.word GROUP BY v.word),
outside AS (SELECT t, k, word, w FROM slots JOIN templates p USING (t) JOIN weight USING (word) WHERE k < p.key_at OR k >= p.key_at + len(p.key)),
keyed AS (
  SELECT d.r, p.t, p.label, f.i - p.key_at AS s, d.words FROM templates p JOIN found f ON f.word = p.key[1] JOIN docs d USING (r)
  WHERE d.words[f.i + 1 : f.i + len(p.key)] = p.key),
agreeing AS (
  SELECT r, t, s, count(*) FILTER (words[s + k + 1] = word) AS held, count(*) AS asked,
         first(words[s + k + 1] = word ORDER BY w DESC, word, k) AS rarest
  FROM keyed JOIN outside USING (t) WHERE s + k >= 0 AND s + k < len(words) GROUP BY ALL),
verified AS (
  SELECT v.* FROM keyed v LEFT JOIN agreeing a USING (r, t, s)
  WHERE coalesce(a.held >= least({licenses.AGREEING}, a.asked) AND a.rarest, true)),
shares AS (
  SELECT v.r, v.label, v.t, v.s, sum(w.w) FILTER (v.s + l.k >= 0 AND v.words[v.s + l.k + 1] = l.word) / sum(w.w) AS share
  FROM verified v JOIN slots l USING (t) JOIN weight w USING (word) GROUP BY ALL),
places AS (
  SELECT e.r, e.i, b.label FROM base b JOIN seen e ON e.word = b.phrase[1] JOIN docs d ON d.r = e.r WHERE d.words[e.i + 1 : e.i + len(b.phrase)] = b.phrase),
held AS (SELECT r, count(*) AS n, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY r),
every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM places UNION ALL SELECT r, label FROM shares) GROUP BY r),
best AS (SELECT r, max(share) AS share FROM shares GROUP BY r)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_base, h.first_word::BIGINT AS first_word, h.last_word::BIGINT AS last_word,
       coalesce(h.labels, '') AS base_labels, coalesce(e.labels, '') AS labels,
       round(CASE WHEN h.n > 0 THEN 1.0::DOUBLE ELSE least(coalesce(b.share, 0), 1)::DOUBLE END, 6) AS score
FROM docs d LEFT JOIN held h USING (r) LEFT JOIN every e USING (r) LEFT JOIN best b USING (r)
"""


_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
"""

_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
parts AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, coalesce(p.component_id, e.vec_id) AS component_id, coalesce(p.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN degrees d ON d.a = e.vec_id LEFT JOIN parts p ON p.a = e.vec_id
"""


_RANKED = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms
  FROM documents),
asked AS (
  SELECT row_number() OVER () AS q, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
bags AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(terms) AS term FROM asked) GROUP BY ALL),
total AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS words FROM docs WHERE len(terms) > 0),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM bags) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, total GROUP BY term, docs),
lengths AS (SELECT r, doc_id, 100 - 75 + ((75 * len(terms)::BIGINT * docs) // words) AS m FROM docs, total),
worth AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS points FROM held JOIN weights USING (term) JOIN lengths USING (r)),
scores AS (SELECT q, r, sum(times * points)::BIGINT AS score FROM bags JOIN worth USING (term) GROUP BY q, r)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scores JOIN asked USING (q) JOIN lengths USING (r) WHERE score > 0 QUALIFY rank <= 10
"""


def _levels(prefix: str, key: str, source: str, height: int) -> str:
    """CTEs of a tree over ``source`` (key, i, d, n): a level's nodes, and with each node's parent the level above."""
    out = [f"{prefix}0 AS (SELECT {key} AS g, i, d, n FROM {source})"]
    for k in range(height):
        out.append(
            f"{prefix}{k + 1} AS (SELECT g, i // 16 AS i, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d, "
            f"CASE WHEN any_value(n) = 1 THEN 1 ELSE (any_value(n) + 15) // 16 END AS n FROM {prefix}{k} GROUP BY g, i // 16)"
        )
        out.append(
            f"{prefix}s{k} AS (SELECT a.g, a.i, a.n, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, "
            f"coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r FROM {prefix}{k} a JOIN {prefix}{k} b "
            f"ON a.g IS NOT DISTINCT FROM b.g AND a.i // 16 = b.i // 16 GROUP BY a.g, a.i, a.n)"
        )
    return ",\n".join(out)


def _merkle_sql(height: int = 6) -> str:
    """Trees of up to 16 ** height leaves."""

    def digest(text: str) -> str:
        values = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps, joins = [], []
    for prefix, key, at in (("t", "source", "i"), ("u", "zero", "u_i")):
        for k in range(height):
            joins.append(f"JOIN {prefix}s{k} {prefix}{k}_ ON {prefix}{k}_.g IS NOT DISTINCT FROM p.{key} AND {prefix}{k}_.i = p.{at} // {16**k}")
            steps.append(f"{prefix}{k}_")
    proof = " || ".join(f"CASE WHEN {s}.n > 1 THEN {s}.l || {s}.r ELSE '' END" for s in steps)
    folds = [f"f{k + 1} AS (SELECT * REPLACE (CASE WHEN n{k} > 1 THEN sha256(l{k} || h || r{k}) ELSE h END AS h) FROM f{k})" for k in range(len(steps))]
    sides = ", ".join(f"{s}.n AS n{k}, {s}.l AS l{k}, {s}.r AS r{k}" for k, s in enumerate(steps))
    return f"""
WITH RECURSIVE bits(t, j, c) AS (
  SELECT DISTINCT CAST(doc_id AS VARCHAR), 0, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT t, j + 1, CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END FROM (
    SELECT t, j, CASE WHEN j % 8 = 0 THEN xor(c, ascii(t[j // 8 + 1])::BIGINT) ELSE c END AS b FROM bits WHERE j < 8 * length(t))),
crcs AS (SELECT t, xor(c, 4294967295) AS crc FROM bits WHERE j = 8 * length(t)),
leaves AS (
  SELECT doc_id, source, {digest("text")} AS leaf, CASE WHEN crc % 5 = 0 THEN {digest(lowered)} ELSE {digest("text")} END AS start
  FROM documents LEFT JOIN crcs ON t = CAST(doc_id AS VARCHAR)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, leaf AS d FROM leaves),
{_levels("t", "source", "placed", height)},
subroots AS (
  SELECT g AS source, d, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t{height}),
{_levels("u", "0", "subroots", height)},
p AS (SELECT a.doc_id, a.source, a.leaf, a.start, a.i, s.d AS subroot, s.i AS u_i, 0 AS zero FROM placed a JOIN subroots s ON s.source IS NOT DISTINCT FROM a.source),
f0 AS (SELECT p.doc_id, p.leaf, p.subroot, p.start AS h, sha256({proof}) AS proof_sha256, {sides} FROM p {" ".join(joins)}),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, (SELECT d FROM u{height}) AS root, proof_sha256, h AS folded_root, h = (SELECT d FROM u{height}) AS verified FROM f{len(steps)}
"""


def llm_oracles() -> dict[str, str]:
    return {"op3_licenses": _license_sql(), "op4_vector_near_duplicates": _VECTORS, "op5_top_k": _TOP_K, "op6_source_mix": _MIX, "op10_chat_format": _chat_sql(), "op11_merkle_manifest": _merkle_sql(), "op12_lexical_search": _RANKED}
