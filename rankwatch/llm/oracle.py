"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text: per byte, eight steps of the reflected polynomial (a fixed value)."""
    step = "c"
    for _ in range(8):
        step = f"list_transform([{step}], lambda v: xor(v >> 1, 3988292384 * (v & 1)))[1]"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    fold = step.replace("[c]", "[xor(a, b)]")
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {fold}), 4294967295)"


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    parts = [f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}::VARCHAR) || ':' || {f}::VARCHAR END" for f in fields]
    return "sha256(" + " || ".join(parts) + ")"


def _trees(name: str, leaves: str) -> str:
    """All nodes (tree, lvl, pos, h) over leaves of the same columns."""
    return f"""{name}(tree, lvl, pos, h) AS (
        SELECT tree, 0, pos, h FROM {leaves}
        UNION ALL
        SELECT tree, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos))
        FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS row FROM {name}) WHERE row > 1
        GROUP BY tree, lvl, pos // 8)"""


MERKLE = f"""
WITH RECURSIVE
rows AS (
    SELECT doc_id, {_leaf("text")} AS leaf,
           CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(_lower("text"))} END AS tampered,
           dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree
    FROM documents),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows),
leaves AS (SELECT tree, pos, leaf AS h FROM numbered),
{_trees("own", "leaves")},
ends AS (SELECT tree, max(lvl) AS height FROM own GROUP BY tree),
langs AS (SELECT -1 AS tree, tree AS pos, h FROM own JOIN ends USING (tree) WHERE lvl = height),
{_trees("top", "langs")},
topmost AS (SELECT max(lvl) AS height FROM top),
nodes AS (SELECT * FROM own UNION ALL SELECT * FROM top),
steps AS (
    SELECT n.tree, n.pos, l.lvl AS step, n.tree AS at_tree, l.lvl, n.pos // (8 ** l.lvl)::BIGINT AS at
    FROM numbered n JOIN ends USING (tree), LATERAL (SELECT unnest(range(height)) AS lvl) l
    UNION ALL
    SELECT n.tree, n.pos, height + l.lvl, -1, l.lvl, n.tree // (8 ** l.lvl)::BIGINT
    FROM numbered n JOIN ends USING (tree), LATERAL (SELECT unnest(range((SELECT height FROM topmost))) AS lvl) l),
sided AS (
    SELECT s.tree, s.pos, s.step,
           coalesce(string_agg(h, '' ORDER BY nodes.pos) FILTER (nodes.pos < s.at), '') AS before,
           coalesce(string_agg(h, '' ORDER BY nodes.pos) FILTER (nodes.pos > s.at), '') AS after
    FROM steps s JOIN nodes ON nodes.tree = s.at_tree AND nodes.lvl = s.lvl AND nodes.pos // 8 = s.at // 8
    GROUP BY s.tree, s.pos, s.step),
proofs AS (
    SELECT tree, pos, sha256(string_agg(before || after, '' ORDER BY step)) AS proof FROM sided GROUP BY tree, pos),
folded(tree, pos, step, h) AS (
    SELECT tree, pos, 0, coalesce(tampered, leaf) FROM numbered
    UNION ALL
    SELECT f.tree, f.pos, f.step + 1, sha256(before || f.h || after)
    FROM folded f JOIN sided s ON s.tree = f.tree AND s.pos = f.pos AND s.step = f.step),
done AS (SELECT tree, pos, arg_max(h, step) AS h FROM folded GROUP BY tree, pos),
roots AS (SELECT h AS root FROM top, topmost WHERE lvl = height)
SELECT doc_id, leaf, s.h AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256,
       d.h AS folded_root, d.h = root AS verified
FROM numbered n JOIN done d USING (tree, pos) LEFT JOIN proofs p USING (tree, pos)
     JOIN langs s ON s.pos = n.tree, roots
"""


COVERTREE = """
WITH RECURSIVE
rows AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
whole AS (
    SELECT * FROM rows
    WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.r AS x, b.r AS y FROM whole a JOIN whole b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(x, y) AS (
    SELECT r, r FROM rows UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
component AS (SELECT x, min(vec_id) AS component_id FROM reach JOIN rows ON rows.r = reach.y GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM rows JOIN component c ON c.x = r LEFT JOIN degree d ON d.x = r
"""


COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex({_lower("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
split AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
phrases AS (
    SELECT lang, k, w[i:i + k - 1] AS p FROM places, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, p, count(*) AS f FROM phrases GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
found AS (SELECT lang, k, p, f AS a FROM f WHERE k >= 2 AND f >= 10),
cut AS (
    SELECT c.lang, c.k, c.p, a, x.k AS cut_k, x.f AS l, y.f AS r,
           ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM found c JOIN f x ON x.lang = c.lang AND x.k < c.k AND x.p = c.p[:x.k]
                 JOIN f y ON y.lang = c.lang AND y.k = c.k - x.k AND y.p = c.p[x.k + 1:]),
scored AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut_k) = 1),
explained AS (
    SELECT DISTINCT s.lang, s.p FROM found s JOIN found g ON g.lang = s.lang AND g.k = 3 AND s.k = 2
    WHERE (g.p[1:2] = s.p OR g.p[2:3] = s.p) AND 100 * g.a >= 50 * s.a),
ranked AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM scored
    WHERE (lang, p) NOT IN (SELECT (lang, p) FROM explained))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


_CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _written(text: str) -> str:
    """Code points of a text whose control strings and backslashes are written as two."""
    out = f"replace({text}, chr(92), chr(92) || chr(92))"
    for s in _CONTROL:
        out = f"replace({out}, '{s}', chr(92) || '0')"
    return f"length({out})"


_OWN = "</s>[INST] ok [/INST]"
# `<s>[INST] `, ` [/INST]` and `</s>` around role and text: 22 code points.
CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{_OWN}' UNION ALL SELECT -7, 1, 'assistant', '{_OWN}'),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           count(*) OVER (PARTITION BY conv_id) AS n, 22 + {_written("role")} + {_written("text")} AS chars
    FROM turns),
summed AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM numbered)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       coalesce(sum(upto) FILTER (WHERE role = 'assistant' OR i = n), 0)::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""


def _item_words(text: str) -> str:
    breaks = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    split = f"string_split_regex({_lower(f'coalesce({text}, {chr(39) * 2})')}, '{breaks}')"
    return f"list_filter({split}, lambda x: x <> '')"


DECONTAM = f"""
WITH items AS (SELECT item_id, {_item_words("text")} AS w FROM benchmark),
windows AS (
    SELECT item_id, least(len(w), 10) AS n, w[i + 1:i + least(len(w), 10)] AS g
    FROM items, LATERAL (SELECT unnest(range(greatest(len(w) - 9, 1))) AS i) WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_item_words("text")} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT r, n, w, unnest(range(len(w) - n + 1)) AS i FROM docs, lengths WHERE len(w) >= n),
hits AS (
    SELECT DISTINCT r, i, p.n, item_id
    FROM (SELECT r, i, n, w[i + 1:i + n] AS g FROM places) p JOIN windows USING (g)),
covered AS (
    SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM hits) GROUP BY r),
named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


# Exact links by the prefix join: sets with a similarity of 0.8 share a shingle among the rarest
# n - ceil(0.8 n) + 1 of each side.
NEAR_DUPLICATES = f"""
WITH RECURSIVE
docs AS (
    SELECT doc_id, list_filter(string_split_regex({_lower("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'),
                               lambda x: x <> '') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w]
                   ELSE list_distinct([w[i:i + 1] for i in range(1, len(w))]) END AS s FROM docs),
sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
members AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
rarity AS (SELECT g, count(*) AS f FROM members GROUP BY g),
ordered AS (
    SELECT doc_id, n, g, row_number() OVER (PARTITION BY doc_id ORDER BY f, g) AS i FROM members JOIN rarity USING (g)),
prefixes AS (SELECT doc_id, n, g FROM ordered WHERE i <= n - (80 * n + 99) // 100 + 1),
pairs AS (
    SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM prefixes a JOIN prefixes b USING (g)
    WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
shared AS (
    SELECT x, y, count(*) AS n_both FROM pairs JOIN members a ON a.doc_id = x JOIN members b ON b.doc_id = y AND b.g = a.g
    GROUP BY x, y),
found AS (
    SELECT x, y FROM shared JOIN sized a ON a.doc_id = x JOIN sized b ON b.doc_id = y
    WHERE 100 * n_both >= 80 * (a.n + b.n - n_both)),
links AS (SELECT x, y FROM found UNION ALL SELECT y, x FROM found),
reach(x, y) AS (
    SELECT doc_id, doc_id FROM sized UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT doc_id, n AS n_shingles, min(y) AS component_id, doc_id = min(y) AS kept
FROM sized JOIN reach ON x = doc_id GROUP BY doc_id, n
"""


TOP_K = """
WITH vectors AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM vectors q JOIN vectors c ON len(q.e) = len(c.e) AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


def statements() -> dict[str, str]:
    return {
        "op1_chat_formatting": CHAT,
        "op5_benchmark_decontamination": DECONTAM,
        "op6_minhash_dedup": NEAR_DUPLICATES,
        "op7_topk_search": TOP_K,
        "op11_phrase_collocations": COLLOCATIONS,
        "op12_merkle_manifest": MERKLE,
        "op13_embedding_near_dedup": COVERTREE,
    }
