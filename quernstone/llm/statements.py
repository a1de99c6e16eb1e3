"""SQL for the operators that SQL can express, written for small tables."""

from __future__ import annotations

from quernstone.llm import mixing

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

NEAR_VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), component AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.c AS component_id, e.vec_id = c.c AS kept
FROM embeddings e JOIN component c ON c.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""

VECTOR_SEARCH = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

LINE_WINDOWS = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents
), visible AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS j FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), windows AS (
  SELECT doc_id, j, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS body FROM visible
  WINDOW w AS (PARTITION BY doc_id ORDER BY j)
), ranked AS (
  SELECT doc_id, j, row_number() OVER (PARTITION BY body ORDER BY doc_id, j) AS n FROM windows WHERE body IS NOT NULL
), gone AS (
  SELECT DISTINCT v.doc_id, v.i FROM visible v JOIN ranked r ON r.doc_id = v.doc_id AND v.j BETWEEN r.j AND r.j + 2 WHERE r.n > 1
), sizes AS (SELECT doc_id, count(*) AS n FROM visible GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_lines, count(g.i) AS n_removed,
  CASE WHEN any_value(d.text) IS NULL THEN NULL ELSE coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') END AS text
FROM documents d LEFT JOIN lines l ON l.doc_id = d.doc_id LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i
LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

MINHASH = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k : k + 4], ' '))) END AS s FROM worded
), items AS (SELECT doc_id, unnest(s) AS item FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT c.a, c.b FROM common c JOIN sets x ON x.doc_id = c.a JOIN sets y ON y.doc_id = c.b
  WHERE 100 * c.n >= 85 * (len(x.s) + len(y.s) - c.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), component AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.c AS component_id, s.doc_id = c.c AS kept
FROM sets s JOIN component c ON c.a = s.doc_id
"""

MIX_SOURCES = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len({WORDS.format('text')}), 0) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
  FROM documents
), leveled AS (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS level FROM sized),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
  FROM leveled GROUP BY source
), filling AS (
  SELECT *, (1.5 * sum(s) OVER () - coalesce(sum(2 * s) OVER (ORDER BY 2 * s / w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY 2 * s / w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM totals
), rates AS (SELECT arg_min(rate, 2 * s / w) FILTER (WHERE rate * w <= 2 * s) AS rate FROM filling),
targets AS (SELECT source, s, least(2.0::DOUBLE * s, w * rate) AS target FROM totals, rates),
levels AS (
  SELECT source, level, sum(size)::BIGINT AS words FROM leveled GROUP BY ALL
), tried AS (
  SELECT l.source, level, words, s, target,
    (target - 2 * coalesce(sum(words) OVER (PARTITION BY l.source ORDER BY level DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / nullif(sum((level + 1) * words) OVER (PARTITION BY l.source ORDER BY level DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS c
  FROM levels l JOIN targets t ON l.source IS NOT DISTINCT FROM t.source
), chosen AS (
  SELECT source, level, words, s, target,
    first_value(CASE WHEN words > 0 AND c * (level + 1) <= 2 THEN c END IGNORE NULLS) OVER (PARTITION BY source ORDER BY level DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS c FROM tried
), split AS (
  SELECT *, CASE WHEN level = 0 THEN 0 ELSE least(2.0::DOUBLE, coalesce(c * (level + 1), 2.0::DOUBLE)) END AS copies FROM chosen
), plan AS (
  SELECT source, level, s, target, CAST(floor(copies) AS BIGINT) AS whole, copies - floor(copies) AS part,
    target - sum(floor(copies) * words) OVER (PARTITION BY source) AS need FROM split
), ranked AS (
  SELECT d.doc_id, d.size, p.*, CASE WHEN part > 0 THEN u / (1 - u) * ((1 - part) / part) END AS ratio
  FROM leveled d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source AND d.level = p.level
), left0 AS (SELECT doc_id, source, size, ratio, need AS gap FROM ranked WHERE part > 0),
{{turns}}
spare AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY abs(gap - size), ratio, doc_id) AS n FROM left{{last}} WHERE size < 2 * gap
), drawn AS (SELECT doc_id, source FROM spare WHERE n = 1 {{taken}})
SELECT r.doc_id, r.size, r.s AS source_size, r.target,
  CAST((whole + CASE WHEN x.doc_id IS NOT NULL THEN 1 ELSE 0 END) * r.size AS BIGINT) AS taken
FROM ranked r LEFT JOIN drawn x ON x.doc_id = r.doc_id AND x.source IS NOT DISTINCT FROM r.source
"""

MIX_TURN = """
running{0} AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY ratio, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM left{0} WHERE size <= gap OR {0} = 0
), got{0} AS (SELECT source, coalesce(max(upto) FILTER (WHERE upto <= gap), 0) AS got FROM running{0} GROUP BY source),
left{1} AS (
  SELECT r.doc_id, r.source, r.size, r.ratio, r.gap - g.got AS gap FROM left{0} r JOIN got{0} g ON r.source IS NOT DISTINCT FROM g.source
  WHERE NOT EXISTS (SELECT 1 FROM running{0} t WHERE t.doc_id = r.doc_id AND t.source IS NOT DISTINCT FROM r.source AND t.upto <= t.gap)
),"""


EXACT_DEDUP = r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), grouped AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256)
SELECT h.doc_id, g.keep_id, g.group_size, h.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, h.text_sha256
FROM hashed h JOIN grouped g ON h.text_sha256 = g.text_sha256
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
met AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM worded, range(1, 4) t(k) WHERE len(w) >= k
), counted AS (SELECT lang, k, phrase, count(*) AS f FROM met GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidate AS (SELECT * FROM counted WHERE k > 1 AND f >= 10),
inside AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i : i + 1], ' ') AS phrase, max(f) AS longer FROM candidate, range(1, 3) t(i) WHERE k = 3 GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidate c LEFT JOIN inside i ON c.k = 2 AND i.lang = c.lang AND i.phrase = c.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * c.f
), cuts AS (
  SELECT lang, phrase, f, cut, array_to_string(string_split(phrase, ' ')[: cut], ' ') AS a, array_to_string(string_split(phrase, ' ')[cut + 1 :], ' ') AS b
  FROM kept, range(1, 3) t(cut) WHERE cut < k
), scored AS (
  SELECT c.lang, c.phrase, c.f, c.cut, x.f AS l, y.f AS r, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.a JOIN counted y ON y.lang = c.lang AND y.phrase = c.b
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, encode(phrase)) AS rank FROM lowest)
SELECT lang, rank, phrase, f AS a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def mix_sources() -> str:
    turns = "\n".join(MIX_TURN.format(k, k + 1) for k in range(mixing.TURNS))
    taken = " ".join(f"UNION ALL SELECT doc_id, source FROM running{k} WHERE upto <= gap" for k in range(mixing.TURNS))
    return MIX_SOURCES.replace("{turns}", turns).replace("{last}", str(mixing.TURNS)).replace("{taken}", taken)


def build() -> dict[str, str]:
    return {
        "op1_near_vectors": NEAR_VECTORS,
        "op2_mix_sources": mix_sources(),
        "op5_vector_search": VECTOR_SEARCH,
        "op7_line_windows": LINE_WINDOWS,
        "op8_minhash": MINHASH,
        "op11_exact_dedup": EXACT_DEDUP,
        "op12_collocations": COLLOCATIONS,
    }
