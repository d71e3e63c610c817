"""DuckDB SQL that gives the rows of the numbered queries, where SQL can."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
VISIBLE = r"[^\x20\x09-\x0D]+"


def _words(pattern: str) -> str:
    lowered = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"regexp_extract_all({lowered}, '{pattern}')"


OP1 = f"""
WITH item AS MATERIALIZED (SELECT item_id, {_words(ALNUM)} AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM item WHERE len(w) > 0)),
doc AS MATERIALIZED (SELECT doc_id, {_words(ALNUM)} AS w FROM documents),
size AS (SELECT DISTINCT len(g) AS n FROM win),
gram AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, size WHERE len(w) >= n)),
hit AS MATERIALIZED (SELECT doc_id, i, n, item_id FROM gram JOIN win USING (g)),
hit_word AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
hit_item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_word USING (doc_id) LEFT JOIN hit_item USING (doc_id)
"""


OP3 = f"""
WITH rules(rh, rp, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN
    regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/]*'), '{UPPER}', '{LOWER}') AS host,
    substr(r, length(regexp_extract(r, '^[^/]*')) + 1) AS path FROM rest),
fit AS (
  SELECT parts.*, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY page_id
    ORDER BY length(rh || rp) DESC NULLS LAST, length(rh) DESC) AS place
  FROM parts LEFT JOIN rules
    ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE place = 1
"""


OP5 = """
WITH RECURSIVE vec AS MATERIALIZED (
  SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
  WHERE len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0 AND list_dot_product(v, v) > 0),
link AS MATERIALIZED (
  SELECT a.vec_id AS one, b.vec_id AS two FROM vec a JOIN vec b ON a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.v) = len(b.v)
    THEN list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.95 ELSE false END),
reach AS (
  SELECT one AS origin, one AS here FROM link
  UNION
  SELECT origin, two FROM reach JOIN link ON here = one),
least AS (SELECT origin, min(here) AS component_id FROM reach GROUP BY origin),
degree AS (SELECT one, count(*) AS n_links FROM link GROUP BY one)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON vec_id = origin LEFT JOIN degree ON vec_id = one
"""

OP9 = f"""
WITH split AS MATERIALIZED (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents),
line AS MATERIALIZED (
  SELECT doc_id, i - 1 AS line, {_words(ALNUM)} AS w
  FROM (SELECT doc_id, i, s[i] AS text
        FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM split))),
tokens AS MATERIALIZED (
  SELECT doc_id, line, CASE WHEN len(w) = 0 THEN NULL
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(
      [array_to_string(list_slice(w, i, i + 4), ' ') FOR i IN range(1, len(w) - 3)])) END AS t
  FROM line),
class AS MATERIALIZED (
  SELECT t, len(t) AS n, min(doc_id * 1000000000 + line) AS born
  FROM tokens WHERE t IS NOT NULL GROUP BY t),
token AS MATERIALIZED (SELECT born, n, unnest(t) AS token FROM class),
late AS MATERIALIZED (
  SELECT DISTINCT later FROM (
    SELECT b.born AS later FROM token a JOIN token b ON a.token = b.token AND a.born < b.born
    GROUP BY a.born, b.born, a.n, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n))),
fate AS (
  SELECT doc_id, line, born IS NOT NULL
    AND (born <> doc_id * 1000000000 + line OR born IN (SELECT later FROM late)) AS gone
  FROM tokens LEFT JOIN class USING (t))
SELECT doc_id, count(line) AS n_lines, count(line) FILTER (WHERE gone) AS n_removed,
  coalesce(string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) FILTER (WHERE gone), '') AS removed
FROM documents LEFT JOIN fate USING (doc_id) GROUP BY doc_id
"""


#: CRC-32 of the sixteen half bytes.
CRC_STEPS = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
    "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text expression, a half byte at a time."""
    digits = f"hex(encode({text}))"
    halves = (
        f"list_transform(range(length({digits})), "
        f"lambda i: strpos('0123456789ABCDEF', substr({digits}, (xor(i, 1) + 1)::INT, 1)) - 1)"
    )
    step = f"lambda c, h: xor({CRC_STEPS}[(xor(c, h) & 15) + 1], c >> 4)"
    return f"xor(list_reduce({halves}::BIGINT[], {step}, 4294967295), 4294967295)"


OP11 = f"""
WITH turns AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL),
told AS MATERIALIZED (
  SELECT c, {crc32("CAST(c AS VARCHAR)")} % 6 AS h, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST,
    sha256(length(r) || ':' || r || x)[1:32]) AS ts FROM turns GROUP BY c),
built AS MATERIALIZED (
  SELECT own.c, list_concat(list_slice(coalesce(base.ts, []), 1, own.h),
    list_slice(own.ts, own.h + 1, len(own.ts))) AS ts
  FROM told AS own LEFT JOIN told AS base ON base.c = own.c - own.c % 100),
node AS MATERIALIZED (
  SELECT k, len(k) AS d, min(c) AS c, count(*) AS n,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '') AS ids
  FROM (SELECT c, list_slice(ts, 1, d) AS k, len(ts) = d AS ends
        FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM built)) GROUP BY k),
kids AS (SELECT list_slice(k, 1, d - 1) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
own AS MATERIALIZED (
  SELECT node.*, coalesce(kids.n, 0) AS n_kids,
    CASE WHEN d = 0 THEN 0 ELSE (node.n - 1) * length(node.k[-1].x) END AS saved
  FROM node LEFT JOIN kids USING (k)),
below AS (
  SELECT list_slice(k, 1, up) AS k, sum(saved) AS saved, count(*) FILTER (WHERE n_kids = 0) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM own) GROUP BY 1)
SELECT own.c AS conv_id, own.d AS depth, parent.c AS parent_conv_id, own.n AS n_convs,
  own.n_kids AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens,
  sha256(own.ids) AS ends_sha256
FROM own JOIN below USING (k)
LEFT JOIN node AS parent ON own.d > 0 AND parent.k = list_slice(own.k, 1, own.d - 1)
"""


OP12 = f"""
WITH run AS (
  SELECT id, r, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
      unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS r
    FROM documents) GROUP BY ALL),
hashed AS (SELECT *, {crc32("id || ':' || r")} AS h FROM run),
word AS MATERIALIZED (
  SELECT w, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0
      THEN r[1:(h % length(r))::INT] || r[((h % length(r)) + 2)::INT:length(r)] ELSE r END AS w FROM hashed)
  WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3),
less AS MATERIALIZED (
  SELECT w, i, w[1:i - 1] || w[i + 1:length(w)] AS v
  FROM (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM word)),
near AS MATERIALIZED (
  SELECT a.w AS w, b.w AS v FROM less AS a JOIN less AS b USING (v, i) WHERE a.w <> b.w
  UNION SELECT w, v FROM less WHERE v IN (SELECT w FROM word)
  UNION SELECT v, w FROM less WHERE v IN (SELECT w FROM word)),
best AS MATERIALIZED (
  SELECT near.w, count(*) AS n_near, max(word.n) AS most, arg_min(near.v, (-word.n, encode(near.v))) AS f
  FROM near JOIN word ON word.w = near.v GROUP BY near.w),
known AS MATERIALIZED (
  SELECT word.w, word.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN most >= 2 * word.n THEN f END AS form, CASE WHEN most >= 2 * word.n THEN most END AS form_n
  FROM word LEFT JOIN best USING (w)),
chain AS (
  WITH RECURSIVE step(w, here) AS (
    SELECT w, w FROM known
    UNION ALL SELECT step.w, known.form FROM step JOIN known ON known.w = step.here WHERE known.form IS NOT NULL)
  SELECT step.w, step.here AS root FROM step JOIN known ON known.w = step.here WHERE known.form IS NULL)
SELECT w AS word, form, root, n, n_near, form_n FROM known JOIN chain USING (w)
"""


def sql() -> dict[str, str]:
    return {
        "op1_benchmark_decontamination": OP1,
        "op3_url_filter": OP3,
        "op5_embedding_near_dedup": OP5,
        "op9_line_dedup": OP9,
        "op11_conversation_prefix_trie": OP11,
        "op12_spelling_variants": OP12,
    }
