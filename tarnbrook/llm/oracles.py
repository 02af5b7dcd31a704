"""SQL of the operators that SQL can say, besides those in ``queries``."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: the register goes over the bytes bit by bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)"
    return f"xor(list_reduce({bits}, {step}, 4294967295::BIGINT), 4294967295)"


def _spelled(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE concat(strlen(CAST({value} AS VARCHAR)), ':', {value}) END"


def _leaf(text: str) -> str:
    return "sha256(concat(" + ", ".join(_spelled(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + "))"


def manifest_sql(levels: int = 6) -> str:
    """Trees of up to ``16 ** levels`` nodes, level by level; a tree with one node left stays as it is."""
    parts = [
        f"""leaves AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_leaf(lowered('text'))} ELSE {_leaf('text')} END AS claim
  FROM documents
)""",
        """g0 AS (
  SELECT *, count(*) OVER (PARTITION BY source) AS n FROM (
    SELECT coalesce('=' || source, '') AS source, leaf AS h, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS r FROM leaves)
)""",
    ]

    def tree(name: str) -> None:
        for k in range(levels):
            parts.append(f"""{name}{k + 1} AS (
  SELECT *, count(*) OVER (PARTITION BY source) AS n FROM (
    SELECT source, r // 16 AS r, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE any_value(h) END AS h
    FROM {name}{k} GROUP BY source, r // 16)
)""")

    def climb(name: str, start: str) -> None:
        """Per node of level 0, the proof and the recomputed hash, one level after the other."""
        parts.append(start)
        for k in range(levels):
            parts.append(f"""{name}p{k + 1} AS (
  SELECT p.id, p.source, p.r // 16 AS r,
         concat(any_value(p.proof), string_agg(x.h, '' ORDER BY x.r) FILTER (x.r <> p.r AND x.n > 1)) AS proof,
         CASE WHEN any_value(x.n) > 1 THEN sha256(string_agg(CASE WHEN x.r = p.r THEN p.claim ELSE x.h END, '' ORDER BY x.r)) ELSE any_value(p.claim) END AS claim
  FROM {name}p{k} p JOIN {name}{k} x ON x.source = p.source AND x.r // 16 = p.r // 16
  GROUP BY p.id, p.source, p.r
)""")

    tree("g")
    parts.append(f"""t0 AS (
  SELECT '' AS source, source AS grp, h, row_number() OVER (ORDER BY source) - 1 AS r, count(*) OVER () AS n FROM g{levels}
)""")
    tree("t")
    climb("g", """gp0 AS (
  SELECT row_number() OVER () AS id, source, r, doc_id, '' AS proof, claim, leaf
  FROM (SELECT g0.source, g0.r, g0.doc_id, l.claim, l.leaf FROM g0 JOIN (SELECT DISTINCT * FROM leaves) l ON l.leaf = g0.h AND l.doc_id IS NOT DISTINCT FROM g0.doc_id)
)""")
    climb("t", f"""tp0 AS (
  SELECT p.id, '' AS source, t0.r, p.proof, p.claim, t0.h AS subroot FROM gp{levels} p JOIN t0 ON t0.grp = p.source
)""")
    ctes = ", ".join(parts)
    return f"""
WITH {ctes}
SELECT a.doc_id, a.leaf, b.subroot, t.h AS root, sha256(c.proof) AS proof_sha256, c.claim AS folded_root, c.claim = t.h AS verified
FROM gp0 a JOIN tp0 b USING (id) JOIN tp{levels} c USING (id), t{levels} t
"""


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SEARCH_SQL = f"""
WITH words AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '{_TERM}') AS w FROM documents
), docs AS (SELECT d, doc_id, len(w) AS n, w FROM words WHERE len(w) > 0
), whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs
), tf AS (SELECT d, t, count(*)::BIGINT AS tf FROM (SELECT d, unnest(w) AS t FROM docs) GROUP BY d, t
), df AS (SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY t
), asked AS (
  SELECT item_id, t, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({lowered('text')}, '{_TERM}')) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL))
  GROUP BY item_id, t
), scored AS (
  SELECT item_id, d, doc_id,
         sum(times * CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN df USING (t) JOIN tf USING (t) JOIN docs USING (d), whole
  GROUP BY item_id, d, doc_id
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
) WHERE rank <= 10
"""

_WORD = r"[^\x20\x09-\x0D]+"


def _kept(words: str) -> str:
    """Distinct 5-word runs hashed; those below an eighth of the hash space, or else the least one, ascending."""
    runs = f"list_transform(generate_series(1, CASE WHEN len({words}) = 0 THEN 0 ELSE greatest(len({words}) - 4, 1) END), lambda i: md5(array_to_string(list_slice({words}, i, i + 4), ' '))[1:16])"
    hashes = f"list_sort(list_distinct({runs}))"
    below = f"list_filter({hashes}, lambda h: h < '2')"
    return f"CASE WHEN len({below}) > 0 THEN {below} ELSE list_slice({hashes}, 1, 1) END"


def _alike(a: str, b: str) -> str:
    either = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {either} = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / {either} END"


FINGERPRINT_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text NULLS FIRST) AS place, doc_id, coalesce(text, '') AS text FROM documents
), pairs AS (
  SELECT place, doc_id, text, coalesce(lead(text) OVER (ORDER BY place), first_value(text) OVER (ORDER BY place)) AS follower FROM texts
), edits AS (
  SELECT *, concat(left(text, (len(text) - len(text) // 4)::BIGINT), left(follower, (len(text) // 4)::BIGINT)) AS edited FROM pairs
), spelled AS (
  SELECT *, regexp_extract_all({lowered('text')}, '{_WORD}') AS w, regexp_extract_all({lowered('edited')}, '{_WORD}') AS we FROM edits
), kept AS (
  SELECT place, doc_id, text, edited, {_kept('w')} AS own, {_kept('we')} AS other FROM spelled
), beside AS (
  SELECT *, coalesce(lead(own) OVER (ORDER BY place), first_value(own) OVER (ORDER BY place)) AS after FROM kept
)
SELECT doc_id, len(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
       array_to_string(own, '') AS fingerprint, array_to_string(other, '') AS edited_fingerprint,
       {_alike('own', 'other')} AS near_edited, {_alike('own', 'after')} AS near_next,
       CASE WHEN len(own) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(own, other))::DOUBLE / len(own) END AS held_in_edited
FROM beside
"""

def _components(node: str) -> str:
    """``reach``: all (node, other) that links (a, b) connect, each node with itself."""
    return f"""reach AS (
  SELECT {node} AS node, {node} AS other FROM nodes
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
)"""


VECTOR_SQL = f"""
WITH RECURSIVE nodes AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE vec_id IS NOT NULL
), usable AS MATERIALIZED (
  SELECT * FROM nodes
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), {_components('vec_id')}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM nodes
JOIN (SELECT node AS vec_id, min(other) AS component_id FROM reach GROUP BY node) USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""

JACCARD_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '{_WORD}') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)
), nodes AS MATERIALIZED (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n FROM words LEFT JOIN (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id) USING (doc_id)
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN nodes x ON x.doc_id = a JOIN nodes y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), {_components('doc_id')}
SELECT doc_id, n AS n_shingles, component_id
FROM nodes JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""

PASSAGE_SQL = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), places AS (
  SELECT doc_id, i, w[i] AS word, CASE WHEN i + 12 <= len(w) THEN array_to_string(list_slice(w, i, i + 12), ' ') END AS v
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM words WHERE len(w) > 0)
), judged AS (
  SELECT doc_id, i, word, v IS NOT NULL AND min(doc_id) OVER (PARTITION BY v) < doc_id AS known FROM places
), covered AS (
  SELECT doc_id, i, word, bool_or(known) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM judged
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM covered GROUP BY doc_id
) USING (doc_id)
"""

NEW_ORACLES = {
    "op3_near_vectors": VECTOR_SQL,
    "op5_jaccard_join": JACCARD_SQL,
    "op8_substring_dedup": PASSAGE_SQL,
    "op11_ranked_search": SEARCH_SQL,
    "op12_fingerprints": FINGERPRINT_SQL,
    "op13_merkle_manifest": manifest_sql(),
}
