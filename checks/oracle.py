"""Independent DuckDB SQL for the registered queries, written from the rules, not from the Spark code."""

from __future__ import annotations

from checks.adapters import (
    LOG_PART,
    MODULE_SQL,
    NAME_SQL,
    PATH_SQL,
    RUN_FIELDS,
    SHARD_ROWS,
    SOURCE_SQL,
    dirty_line_sql,
    json_text,
)
from quernstone.functions.stem import IRREGULAR, STEP_2, STEP_3, STEP_4
from quernstone.operators.codeindex import STANDARD_MODULES

SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNI_SPACE = r"\t-\r\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS, NWS = f"[{SPACE}]", f"[^{SPACE}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rx(text: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({text}, {q(pattern)}, {q(to)}, {q(flags)})" if flags else (
        f"regexp_replace({text}, {q(pattern)}, {q(to)})")


def strip(x: str) -> str:
    return rx(x, f"^{WS}+|{WS}+$")


def collapse(x: str) -> str:
    return f"trim({rx(x, WS + '+', ' ')})"


def words(x: str) -> str:
    return f"list_filter(string_split({collapse(x)}, ' '), lambda w: w <> '')"


def n_words(x: str) -> str:
    return f"cast(len({words(x)}) AS INTEGER)"


# Documentation tags, and string literals or comments.
TAGS = "(:param|:type|:return|:rtype|@param|@return|@throws|Args:|Returns:|Raises:).*"
FEW_TAGS = "(:param|:type|:return|:rtype|@param|@return).*"
STRINGS = r'''("(?:[^"\\\n]|\\+[^\\\n])*"|'(?:[^'\\\n]|\\+[^\\\n])*')|(#.*)'''


def paragraph(x: str) -> str:
    return f"split_part({x}, chr(10) || chr(10), 1)"


def clean_doc(x: str) -> str:
    return collapse(rx(rx(rx(paragraph(x), TAGS), ">>>.*"), f"http{NWS}+"))


def no_docstring(x: str) -> str:
    return rx(x, '"""[\\s\\S]*?"""|' + "'''[\\s\\S]*?'''", "", "")


def no_comments(x: str) -> str:
    return rx(x, STRINGS, r"\1")


def no_blank_lines(x: str) -> str:
    lines = f"list_filter(string_split({x}, chr(10)), lambda l: regexp_matches(l, {q(NWS)}))"
    return strip(f"coalesce(array_to_string({lines}, chr(10)), '')")


def clean_code(x: str) -> str:
    return no_blank_lines(no_comments(no_docstring(x)))


def fp(x: str) -> str:
    return f"md5({rx(x, WS + '+')})"


PAIRS = """pairs AS (
  SELECT doc_id AS id, CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'valid' ELSE 'test' END AS split,
         split_part(text, chr(10), 1) AS docstring,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS code
  FROM documents)"""
NOISY = """noisy AS (
  SELECT doc_id AS id, split_part(text, chr(10), 1) || ' see http://x.example/' || cast(doc_id AS varchar) || ' now' || chr(10)
    || ':param p: thing' || chr(10) || '>>> run(' || cast(doc_id AS varchar) || ')' || chr(10)
    || CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END || chr(10) || chr(10)
    || 'Second paragraph' AS docstring FROM documents)"""
SOURCES = f"""sources AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_returnflag, l_linestatus, l_linenumber % 3 AS form, {PATH_SQL} AS path,
    {NAME_SQL} AS name, {MODULE_SQL} AS module, {SOURCE_SQL} AS source
  FROM lineitem)"""
CLEANED = PAIRS + f""",
raw_cleaned AS (SELECT id, split, code AS raw_code, {clean_code('code')} AS code, {clean_doc('docstring')} AS docstring FROM pairs),
counted AS (SELECT *, {n_words('code')} AS code_words, {n_words('docstring')} AS doc_words FROM raw_cleaned),
judged AS (
  SELECT *, CASE WHEN raw_code IS NULL OR raw_code = '' THEN 'no_code'
    WHEN docstring = '' OR NOT regexp_matches(docstring, '[\\p{{L}}\\p{{N}}]') THEN 'removed_doc'
    WHEN length(code) < 10 THEN 'removed_doc'
    WHEN code_words NOT BETWEEN 20 AND 250 OR doc_words NOT BETWEEN 3 AND 50 THEN 'removed_len' END AS reason
  FROM counted),
printed AS (SELECT *, CASE WHEN reason IS NULL THEN {fp('code')} END AS fp FROM judged),
registry AS (SELECT fp, min(id) AS first_id FROM printed WHERE reason IS NULL AND split = 'train' GROUP BY fp),
verdicts AS (
  SELECT p.*, r.first_id, coalesce(reason, CASE
      WHEN split = 'train' AND id <> first_id THEN 'removed_dupe'
      WHEN split <> 'train' AND first_id IS NOT NULL THEN 'removed_dupe' END, 'kept') AS verdict
  FROM printed p LEFT JOIN registry r USING (fp)),
refined AS (SELECT id, split, code, docstring, fp FROM verdicts WHERE verdict = 'kept')"""
EPOCHS = """epochs AS (
  SELECT user_id AS run_id, cast(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS integer) AS epoch,
    value AS val_loss, round(value * 0.9, 4) AS train_loss, cast(10 + event_id % 50 AS double) AS seconds,
    round(0.01 / row_number() OVER (PARTITION BY user_id ORDER BY event_id), 6) AS lr
  FROM events)"""
RUNS = f"""per_run AS (
  SELECT user_id AS run_id, min(ts) AS started, count(*) AS n_epochs, round(min(value), 6) AS min_val,
    round(min(value) / 1000, 6) AS bleu, round(avg(value) / 1000, 6) AS rougeL,
    cast(sum(10 + event_id % 50) AS double) AS total_seconds
  FROM events GROUP BY user_id),
named AS (SELECT *, {RUN_FIELDS[0]} AS model, cast({RUN_FIELDS[1].replace('floor(run_id / 3)', 'floor(run_id / 3.0)')} AS integer) AS subset_size FROM per_run),
runs AS (SELECT *, '20240101_0000_' || model || '_sub' || subset_size || '_u' || run_id || '.pt' AS file FROM named)"""
LOGS = EPOCHS + "," + RUNS + f""",
bodies AS (
  SELECT run_id, cast(floor((epoch - 1) / {float(LOG_PART)}) AS integer) AS part,
    string_agg(printf('Epoch %02d | Loss: %.4f | Val: %.4f | LR: %.6f | Time: %.2fs', epoch, train_loss, val_loss, lr, seconds),
               chr(10) ORDER BY epoch) AS body
  FROM epochs WHERE run_id % 25 <> 0 GROUP BY ALL),
heads AS (
  SELECT run_id, 0 AS part, printf('[TIMER] Phase ''model_training'' completed in %.2fs', total_seconds) || chr(10)
    || printf('[TIMER] Phase ''evaluation_fast'' completed in %.2fs', cast(n_epochs AS double)) || chr(10)
    || CASE WHEN run_id % 10 <> 0 THEN printf('"file": "%s",', file) || chr(10) || printf('"bleu": %.6f,', bleu) || chr(10)
         || printf('"rougeL": %.6f,', rougeL) || chr(10) ELSE '' END AS head
  FROM runs),
logs AS (
  SELECT run_id, part, 'RUN ' || run_id || ' PART ' || part || chr(10) || coalesce(head, '') || coalesce(body, '') || chr(10) AS content
  FROM heads FULL JOIN bodies USING (run_id, part)),
log_epochs AS (SELECT * FROM epochs WHERE run_id % 25 <> 0)"""
METRICS = RUNS + """,
metrics AS (
  SELECT run_id, file, model, subset_size, bleu, rougeL, min_val AS loss,
    CASE WHEN min_val < 100 THEN round(exp(min_val), 6) ELSE 'inf'::double END AS perplexity,
    CASE WHEN run_id % 7 = 0 THEN 'n/a' ELSE printf('%.2f', round(total_seconds / n_epochs, 2)) END AS mean_text
  FROM runs),
features AS (
  SELECT *, coalesce(try_cast(mean_text AS double), 0) AS mean_epoch,
    CASE WHEN coalesce(try_cast(mean_text AS double), 0) <> 0 THEN subset_size / try_cast(mean_text AS double) END AS throughput,
    CASE WHEN subset_size <> 0 THEN coalesce(try_cast(mean_text AS double), 0) / subset_size * 1000 END AS time_per_1k
  FROM metrics)"""
SCORED = CLEANED + f""",
scored AS (
  SELECT id, split AS run, {words('docstring')} AS ref, list_filter({words('docstring')}, lambda w: length(w) > 2) AS hyp FROM refined)"""
WORD_IDS = CLEANED + f""",
train_words AS (SELECT unnest(list_concat({words('docstring')}, {words('code')})) AS token FROM refined WHERE split = 'train'),
word_table AS (
  SELECT token, cast(row_number() OVER (ORDER BY n DESC, md5(token)) + 3 AS integer) AS id
  FROM (SELECT token, count(*) AS n FROM train_words GROUP BY token)),
sides AS (SELECT id, split, 0 AS side, {words('code')} AS w FROM refined UNION ALL SELECT id, split, 1, {words('docstring')} FROM refined),
at_words AS (SELECT id, split, side, generate_subscripts(w, 1) AS nth, unnest(w) AS token FROM sides),
coded AS (
  SELECT a.id, split, list(coalesce(t.id, 3) ORDER BY nth) FILTER (WHERE side = 0) AS c, list(coalesce(t.id, 3) ORDER BY nth) FILTER (WHERE side = 1) AS d
  FROM at_words a LEFT JOIN word_table t USING (token) GROUP BY a.id, split),
word_ids AS (
  SELECT id, split, list_concat([1], c[1:254], [2]) AS code_ids, list_concat([1], d[1:62], [2]) AS doc_ids FROM coded)"""


def bleu_sql(source: str, key: str) -> str:
    """BLEU-4 of ``source(id, key, ref, hyp)`` per key, as CTEs ending in ``bleu``."""
    grams = " UNION ALL ".join(
        f"SELECT {key}, id, {n} AS n, side, array_to_string(w[i:i + {n - 1}], ' ') AS gram FROM ("
        f"SELECT {key}, id, side, w, unnest(range(1, len(w) - {n - 2})) AS i FROM sided WHERE len(w) >= {n})"
        for n in (1, 2, 3, 4)
    )
    slots = ", ".join(f"sum(greatest(1, len(hyp) - {n - 1})) AS d{n}" for n in (1, 2, 3, 4))
    hits = ", ".join(f"coalesce(sum(m) FILTER (WHERE n = {n}), 0) AS m{n}" for n in (1, 2, 3, 4))
    logs = " + ".join(f"ln((CASE WHEN m{n} = 0 THEN 0.1 ELSE m{n} END) / d{n}) / 4" for n in (1, 2, 3, 4))
    return f"""sided AS (SELECT {key}, id, 'h' AS side, hyp AS w FROM {source} UNION ALL SELECT {key}, id, 'r', ref FROM {source}),
grams AS ({grams}),
gram_counts AS (SELECT {key}, id, n, gram, count(*) FILTER (WHERE side = 'h') AS h, count(*) FILTER (WHERE side = 'r') AS r
  FROM grams GROUP BY ALL),
matches AS (SELECT {key}, {hits} FROM (SELECT {key}, n, least(h, r) AS m FROM gram_counts) GROUP BY {key}),
sizes AS (SELECT {key}, sum(len(hyp)) AS hl, sum(len(ref)) AS rl, {slots} FROM {source} GROUP BY {key}),
bleu AS (SELECT s.{key}, cast(hl AS bigint) AS hyp_len, cast(rl AS bigint) AS ref_len,
  CASE WHEN coalesce(m1, 0) = 0 THEN 0.0 ELSE (CASE WHEN hl > rl THEN 1.0 ELSE exp(1 - rl / hl) END) * exp({logs}) END AS bleu
  FROM sizes s LEFT JOIN matches m ON s.{key} = m.{key})"""


def lcs_sql(source: str) -> str:
    """Longest common subsequence lengths of ``source(id, r, h)`` as a recursive CTE ``lcs``."""
    return f"""walk AS (
  SELECT id, r, h, 0 AS j, list_transform(range(0, len(r) + 1), lambda x: 0) AS prev FROM {source}
  UNION ALL
  SELECT id, r, h, j + 1, list_reduce(range(1, len(r) + 1), lambda cur, i: list_append(cur,
      CASE WHEN r[i] = h[j + 1] THEN prev[i] + 1 ELSE greatest(prev[i + 1], cur[len(cur)]) END), [0::int])
  FROM walk WHERE j < len(h) AND len(r) > 0),
lcs AS (SELECT id, max(prev[len(prev)]) AS n FROM walk GROUP BY id)"""


def rouge_words(x: str) -> str:
    return f"list_filter(string_split(regexp_replace(lower(array_to_string({x}, ' ')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"


def shape_sql(x: str) -> str:
    """A word as c and v, letter by letter; y is a vowel only behind a consonant."""
    return f"""list_reduce(list_prepend('', string_split({x}, '')), lambda s, c: s || CASE WHEN c = '' THEN ''
      WHEN c IN ('a', 'e', 'i', 'o', 'u') OR (c = 'y' AND right(s, 1) = 'c') THEN 'v' ELSE 'c' END)"""


def stems_sql(source: str) -> str:
    """CTE ``stems(w, stem)`` of the words of ``source(w)``, one CTE per step of the suffix rules."""
    def measure(x: str) -> str:
        return f"len(regexp_extract_all({shape_sql(x)}, 'v+c+'))"

    def short_end(x: str) -> str:
        shape = shape_sql(x)
        return f"({shape} = 'vc' OR (({shape}) LIKE '%cvc' AND right({x}, 1) NOT IN ('w', 'x', 'y')))"

    def swapped(suffix: str, ending: str, least: int = 0, also: str = "true") -> str:
        rest = f"left(s, -{len(suffix)})"
        return f"WHEN s LIKE '%{suffix}' THEN CASE WHEN {measure(rest)} > {least} AND {also} THEN {rest} || '{ending}' ELSE s END"

    less_one = "left(s, -1)"
    has_vowel = "contains(" + shape_sql("left(s, -{})") + ", 'v')"
    before_ion = "right(left(s, -3), 1) IN ('s', 't')"
    steps = [
        """CASE WHEN s LIKE '%ies' THEN CASE WHEN len(s) = 4 THEN left(s, -1) ELSE left(s, -2) END
          WHEN s LIKE '%sses' THEN left(s, -2) WHEN s LIKE '%s' AND s NOT LIKE '%ss' THEN left(s, -1) ELSE s END""",
        f"""CASE WHEN s LIKE '%ied' THEN CASE WHEN len(s) = 4 THEN left(s, -1) ELSE left(s, -2) END
          WHEN s LIKE '%eed' THEN CASE WHEN {measure("left(s, -3)")} > 0 THEN left(s, -1) ELSE s END
          WHEN s LIKE '%ed' AND {has_vowel.format(2)} THEN left(s, -2) || '+'
          WHEN s LIKE '%ing' AND {has_vowel.format(3)} THEN left(s, -3) || '+' ELSE s END""",
        # A plus marks a word that has just lost ed or ing.
        f"""CASE WHEN s NOT LIKE '%+' THEN s WHEN regexp_matches(s, '(at|bl|iz)[+]$') THEN left(s, -1) || 'e'
          WHEN len(s) > 2 AND s[-2] = s[-3] AND right({shape_sql(less_one)}, 1) = 'c'
            THEN CASE WHEN s[-2] IN ('l', 's', 'z') THEN left(s, -1) ELSE left(s, -2) END
          WHEN {measure(less_one)} = 1 AND {short_end(less_one)} THEN left(s, -1) || 'e' ELSE left(s, -1) END""",
        f"CASE WHEN s LIKE '%y' AND len(s) > 2 AND right({shape_sql(less_one)}, 1) = 'c' THEN left(s, -1) || 'i' ELSE s END",
        f"CASE WHEN s LIKE '%alli' AND {measure('left(s, -4)')} > 0 THEN left(s, -2) ELSE s END",
        f"""CASE {" ".join(swapped(a, b) for a, b in STEP_2)}
          WHEN s LIKE '%logi' AND {measure("left(s, -3)")} > 0 THEN left(s, -1) ELSE s END""",
        f"CASE {' '.join(swapped(a, b) for a, b in STEP_3)} ELSE s END",
        f"CASE {' '.join(swapped(a, '', 1, before_ion if a == 'ion' else 'true') for a in STEP_4)} ELSE s END",
        f"""CASE WHEN s LIKE '%e' AND ({measure(less_one)} > 1 OR ({measure(less_one)} = 1 AND NOT {short_end(less_one)}))
          THEN left(s, -1) ELSE s END""",
        f"CASE WHEN s LIKE '%ll' AND {measure(less_one)} > 1 THEN left(s, -1) ELSE s END",
    ]
    ctes = [f"step0 AS MATERIALIZED (SELECT DISTINCT w, w AS s FROM {source})"]
    ctes += [f"step{i} AS MATERIALIZED (SELECT w, {rule} AS s FROM step{i - 1})" for i, rule in enumerate(steps, 1)]
    odd = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
    return ",\n".join(ctes) + f",\nstems AS (SELECT w, CASE w {odd} ELSE CASE WHEN len(w) > 2 THEN s ELSE w END END AS stem FROM step{len(steps)})"


STDLIB_HIT = f"module IN ({', '.join(q(m) for m in sorted(STANDARD_MODULES))})"
IMPORT_ROWS = SOURCES + """,
imports AS (
  SELECT path, 'os' AS module, false AS relative FROM sources
  UNION ALL SELECT path, lower(l_returnflag) || '_pkg', false FROM sources
  UNION ALL SELECT path, 'sib', true FROM sources
  UNION ALL SELECT path, module, false FROM sources)"""

RAW = PAIRS + f", dirty AS (SELECT id, split, docstring, code, {dirty_line_sql()} AS raw FROM pairs)"
GOOD = "id % 8 IN (0, 1, 4, 7)"
DIRTY_CODE = "CASE WHEN id % 8 = 4 THEN NULL ELSE code END"

KEYWORDS = CLEANED + f""",
code_words AS (SELECT id, unnest({words('code')}) AS w FROM refined),
ranked AS (
  SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY n DESC, w) AS rk
  FROM (SELECT id, w, count(*) AS n FROM code_words GROUP BY id, w)),
predicted AS (
  SELECT r.id, split, docstring, coalesce(string_agg(w, ' ' ORDER BY rk), '') AS prediction
  FROM refined r LEFT JOIN ranked k ON r.id = k.id AND rk <= 12 GROUP BY r.id, split, docstring)"""

EVALUATED = CLEANED + f""",
chosen AS (SELECT * FROM refined),
files AS (SELECT unnest(['20240101_0000_transformer_sub20000.pt', '20240102_0000_lstm_dotproduct_sub50000.pt']) AS file, unnest([12, 5]) AS k),
code_words AS (SELECT id, unnest({words('code')}) AS w FROM chosen),
ranked AS (
  SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY n DESC, w) AS rk
  FROM (SELECT id, w, count(*) AS n FROM code_words GROUP BY id, w)),
predicted AS (
  SELECT c.id, file, docstring, coalesce(string_agg(w, ' ' ORDER BY rk), '') AS prediction
  FROM chosen c CROSS JOIN files LEFT JOIN ranked r ON c.id = r.id AND rk <= k GROUP BY c.id, file, docstring)"""


def w(ctes: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


def build() -> dict[str, str]:
    sql: dict[str, str] = {}

    # sources and sinks
    sql["read_jsonl_shards"] = w(RAW, "SELECT split, raw FROM dirty")
    sql["normalize_keys"] = w(RAW, f"SELECT split, {DIRTY_CODE} AS code, docstring FROM dirty WHERE {GOOD}")
    sql["malformed_records"] = w(RAW, f"SELECT split, raw FROM dirty WHERE NOT ({GOOD})")
    sql["write_refined"] = w(CLEANED, "SELECT split, code, docstring FROM refined")
    sql["preview"] = w(RAW, f"""SELECT cast(sample_no AS integer) AS sample_no, CASE WHEN NOT ({GOOD}) THEN
        '--- SAMPLE #' || sample_no || ' [CRITICAL: JSON DECODE ERROR] ---' ELSE
        '--- SAMPLE #' || sample_no || ' ---' || chr(10) || 'TARGET SUMMARY (DOC): ' || {strip('docstring')} || chr(10)
        || 'INPUT LOGIC (CODE):' || chr(10) || {strip(f"coalesce({DIRTY_CODE}, '')")} || chr(10) || repeat('-', 50) END AS sample
      FROM (SELECT *, row_number() OVER (ORDER BY id) AS sample_no FROM dirty WHERE split = 'test' AND id < {SHARD_ROWS})
      WHERE sample_no <= 100""")
    sql["read_metrics"] = w(METRICS, "SELECT file, model, bleu, rougeL, loss, perplexity, mean_text AS mean_epoch FROM metrics")
    sql["read_logs"] = w(LOGS, "SELECT run_id, part, content || chr(10) AS content FROM logs")
    sql["write_run_records"] = w(EPOCHS + "," + RUNS, f"""SELECT run_id, cast(floor((epoch - 1) / {float(LOG_PART)}) AS integer) AS part, model AS model_type,
        CASE WHEN subset_size = 0 THEN 'ALL' ELSE cast(subset_size AS varchar) END AS subset,
        strftime(started, '%Y-%m-%dT%H:%M:%S') AS start_time, printf('%.2fs', total_seconds) AS model_training,
        file, 'fast' AS eval_mode, epoch, train_loss, val_loss, lr, printf('%.2fs', seconds) AS duration
      FROM epochs JOIN runs USING (run_id)""")
    sql["read_source_files"] = """WITH modules AS (
        SELECT doc_id // 64 AS module, string_agg(text, chr(10) ORDER BY doc_id) || chr(10) AS source FROM documents GROUP BY 1)
      SELECT 'app/module=' || module AS folder, 4 AS depth, cast(strlen(source) AS bigint) AS length, source FROM modules"""

    # row functions
    def on_docs(name: str, expr: str) -> None:
        sql[name] = w(NOISY, f"SELECT id, {expr} AS docstring FROM noisy")

    on_docs("first_paragraph", paragraph("docstring"))
    on_docs("strip_doc_tags", rx("docstring", TAGS))
    on_docs("strip_doctest", rx("docstring", ">>>.*"))
    on_docs("strip_urls", rx("docstring", f"http{NWS}+"))
    on_docs("collapse_ws", collapse("docstring"))
    on_docs("clean_docstring", clean_doc("docstring"))
    on_docs("clean_docstring_firstline", strip(rx(rx(f"split_part({paragraph('docstring')}, chr(10), 1)", FEW_TAGS), ">>>.*")))
    for name, fn in (("strip_first_docstring", no_docstring), ("strip_comments", no_comments),
                     ("drop_blank_lines", no_blank_lines), ("clean_code", clean_code)):
        sql[name] = w(SOURCES, f"SELECT id, {fn('source')} AS code FROM sources")
    sql["word_count"] = w(CLEANED, "SELECT id, code_words, doc_words FROM counted")
    sql["has_alnum"] = w(CLEANED, "SELECT id, regexp_matches(docstring, '[\\p{L}\\p{N}]') AS has_alnum FROM counted")
    sql["min_chars"] = w(CLEANED, "SELECT id, length(code) >= 10 AS min_chars FROM counted")
    sql["length_band"] = w(CLEANED, "SELECT id, code_words BETWEEN 20 AND 250 AND doc_words BETWEEN 3 AND 50 AS in_band FROM counted")
    sql["fingerprint"] = w(CLEANED, f"SELECT id, {fp('code')} AS fp FROM counted")
    sql["reject_reason"] = w(CLEANED, "SELECT id, split, verdict AS reason FROM verdicts")
    sql["debug_filter"] = w(PAIRS, f"""SELECT id, code, doc FROM (
        SELECT id, code, {strip(rx(rx(f"split_part({paragraph('docstring')}, chr(10), 1)", FEW_TAGS), '>>>.*'))} AS doc FROM pairs)
      WHERE length(doc) > 10 AND {n_words('code')} < 200 ORDER BY id LIMIT 5""")
    sql["detok_cleanup"] = w(PAIRS, f"SELECT doc_id AS id, {strip('''replace(replace(replace(text, ' ', ' Ġ'), 'Ġ', ' '), '  ', ' ')''')} AS text FROM documents")
    sql["audit_line"] = w(PAIRS, f"""SELECT id, substr(replace({strip('code')}, chr(10), ' '), 1, 60) || '...' AS code_line,
        {strip('docstring')} AS doc_line FROM pairs""")
    odd = "CASE WHEN run_id % 7 = 0 THEN 'net_' || run_id || '.pt' ELSE file END"
    sql["model_tag"] = w(RUNS, f"""SELECT run_id, CASE WHEN run_id % 7 = 0 THEN 'lstm_bahdanau' ELSE model END AS lenient,
        CASE WHEN run_id % 7 <> 0 THEN model END AS strict FROM runs""")
    sql["subset_size"] = w(RUNS, f"SELECT run_id, coalesce(try_cast(nullif(regexp_extract({odd}, '(?i)sub(\\d+)', 1), '') AS integer), 0) AS subset_size FROM runs")
    sql["run_short_name"] = w(RUNS, "SELECT run_id, 'run_' || run_id || '_B0.12' AS short_name FROM runs")
    sql["run_slug"] = w(RUNS, """SELECT run_id, strftime(started, '%Y%m%d_%H%M%S') || '_' || substr(upper(model), 1, 5) || '_S'
        || CASE WHEN subset_size = 0 THEN 'ALL' ELSE cast(subset_size AS varchar) END || '_'
        || CASE WHEN bleu > 0.0001 THEN printf('B%.2f', bleu) ELSE 'NA' END AS slug FROM runs""")
    sql["to_numeric_coerce"] = w(METRICS, "SELECT run_id, mean_epoch FROM features")
    sql["throughput_features"] = w(METRICS, """SELECT run_id, subset_size, mean_epoch, round(throughput, 6) AS throughput,
        round(time_per_1k, 6) AS time_per_1k FROM features""")
    sql["render_epoch_line"] = w(EPOCHS, """SELECT run_id, epoch, printf('Epoch %02d | Loss: %.4f | Val: %.4f | LR: %.6f | Time: %.2fs',
        epoch, train_loss, val_loss, lr, seconds) AS line, printf('[TIMER] Phase ''%s'' completed in %.2fs', 'epoch', seconds) AS timer
      FROM epochs""")

    # joins and deduplication
    sql["dedup_train_keep_first"] = w(CLEANED, "SELECT id, fp FROM refined WHERE split = 'train'")
    sql["cross_split_anti"] = w(CLEANED, "SELECT id, split, fp FROM refined WHERE split <> 'train'")
    sql["leakage_pairs"] = w(CLEANED, "SELECT id, split, fp, first_id AS train_id FROM verdicts WHERE split <> 'train' AND verdict = 'removed_dupe'")
    sql["refine"] = w(CLEANED, "SELECT id, split, code, docstring FROM refined")
    sql["classify_imports"] = w(IMPORT_ROWS, f"""SELECT path, module, relative,
        CASE WHEN relative THEN 'internal' WHEN {STDLIB_HIT} THEN 'standard' ELSE 'third_party' END AS kind FROM imports""")

    # aggregates
    counts = ", ".join(f"count(*) FILTER (WHERE verdict = '{r}') AS {r}" for r in ("removed_len", "removed_dupe", "removed_doc", "malformed", "no_code"))
    sql["refinery_audit"] = w(CLEANED, f"SELECT split, count(*) AS total, count(*) FILTER (WHERE verdict = 'kept') AS kept, {counts} FROM verdicts GROUP BY split")
    sql["corpus_bleu"] = w(SCORED + "," + bleu_sql("scored", "run"), "SELECT run, round(bleu, 6) AS bleu, hyp_len, ref_len FROM bleu")
    rouge = f"pieces AS (SELECT id, run, {rouge_words('ref')} AS r, {rouge_words('hyp')} AS h FROM scored), {lcs_sql('pieces')}"
    f_mean = "avg(CASE WHEN n > 0 THEN 2.0 * n / (len(r) + len(h)) ELSE 0 END)"
    sql["rouge_l_mean"] = w(SCORED + "," + rouge, f"SELECT run, round({f_mean}, 6) AS rougeL FROM pieces JOIN lcs USING (id) GROUP BY run", True)
    flat = " UNION ALL ".join(
        f"SELECT id, '{side}' AS side, unnest({side}) AS w, generate_subscripts({side}, 1) AS place FROM plain" for side in "rh"
    )
    stemmed = f"""plain AS (SELECT id, run, {rouge_words('ref')} AS r, {rouge_words('hyp')} AS h FROM scored), flat AS ({flat}),
      long AS (SELECT w FROM flat WHERE len(w) > 3), {stems_sql('long')},
      sides AS (SELECT id, side, list(coalesce(stem, w) ORDER BY place) AS words FROM flat LEFT JOIN stems USING (w) GROUP BY id, side),
      pieces AS (SELECT p.id, run, coalesce(a.words, []) AS r, coalesce(b.words, []) AS h FROM plain p
        LEFT JOIN sides a ON p.id = a.id AND a.side = 'r' LEFT JOIN sides b ON p.id = b.id AND b.side = 'h'), {lcs_sql('pieces')}"""
    sql["rouge_l_mean_stemmed"] = w(SCORED + "," + stemmed, f"SELECT run, round({f_mean}, 6) AS rougeL FROM pieces JOIN lcs USING (id) GROUP BY run", True)
    sql["loss_perplexity"] = w(CLEANED + f""",
      model AS (SELECT word, count(*) AS n FROM (SELECT unnest({words('docstring')}) AS word FROM refined WHERE split = 'train') GROUP BY word),
      total AS (SELECT sum(n) + count(*) + 1 AS t FROM model),
      eval AS (SELECT split AS run, unnest({words('docstring')}) AS word FROM refined),
      nll AS (SELECT run, -ln((coalesce(n, 0) + 1.0) / t) AS nll FROM eval LEFT JOIN model USING (word), total)""",
        """SELECT run, round(avg(nll), 6) AS loss, count(*) AS n_tokens,
        round(CASE WHEN avg(nll) < 100 THEN exp(avg(nll)) ELSE 'inf'::double END, 4) AS perplexity FROM nll GROUP BY run""")
    sql["mean_of_batch_means"] = w(EPOCHS, """SELECT model_no, round(avg(m), 6) AS loss FROM (
        SELECT run_id % 3 AS model_no, run_id, floor(epoch / 10.0) AS b, avg(val_loss) AS m FROM epochs WHERE epoch % 5 <> 0 GROUP BY ALL)
      GROUP BY model_no""")
    best = "arg_min(epoch, (val_loss, epoch))"
    sql["best_epoch"] = w(EPOCHS, f"SELECT run_id, {best} AS best_position, {best} AS best_epoch, min(val_loss) AS min_val_loss FROM epochs GROUP BY run_id")
    sql["run_comparison"] = w(LOGS, """SELECT r.run_id, file, coalesce(printf('%.4f', round(lo, 4)), 'NO DATA FOUND') AS min_val_loss, final_epoch
      FROM runs r LEFT JOIN (SELECT run_id, min(val_loss) AS lo, max(epoch) AS final_epoch FROM log_epochs GROUP BY run_id) e ON r.run_id = e.run_id""")
    sql["mean_epoch_seconds"] = w(LOGS, "SELECT run_id, round(avg(seconds), 6) AS mean_epoch_seconds FROM log_epochs GROUP BY run_id")
    cells = ", ".join(f"coalesce(arg_min(bleu, file) FILTER (WHERE subset_size = {s}), 0) AS s{s}" for s in (0, 20000, 50000, 70000))
    sql["metric_matrix"] = w(METRICS, f"SELECT model, {cells} FROM metrics GROUP BY model")
    cells = ", ".join(f"coalesce(round(arg_min(mean_epoch, file) FILTER (WHERE subset_size = {s}), 6), 0) AS s{s}" for s in (0, 20000, 50000, 70000))
    sql["metric_matrix_mean_epoch"] = w(METRICS, f"SELECT model, {cells} FROM features GROUP BY model")
    sql["import_counts"] = w(IMPORT_ROWS, f"""SELECT CASE WHEN relative THEN 'internal' WHEN {STDLIB_HIT} THEN 'standard' ELSE 'third_party' END AS kind,
        module, count(*) AS n_imports FROM imports GROUP BY ALL""")
    sql["requirements_list"] = w(IMPORT_ROWS, f"SELECT DISTINCT lower(module) AS requirement FROM imports WHERE NOT relative AND NOT {STDLIB_HIT}")
    sql["phase_durations"] = w(RUNS, """SELECT run_id, 'model_training' AS phase, total_seconds AS seconds, total_seconds + n_epochs AS total_seconds FROM runs
      UNION ALL SELECT run_id, 'evaluation_fast', cast(n_epochs AS double), total_seconds + n_epochs FROM runs""")
    sql["model_subset_domains"] = w(METRICS, """SELECT 'model' AS axis, cast(row_number() OVER (ORDER BY p) AS integer) AS ord, model AS value
        FROM (SELECT model, min(run_id) AS p FROM metrics GROUP BY model)
      UNION ALL SELECT 'subset_size', cast(row_number() OVER (ORDER BY subset_size) AS integer), cast(subset_size AS varchar)
        FROM (SELECT DISTINCT subset_size FROM metrics)""")
    batches = WORD_IDS + ", batched AS (SELECT *, floor((row_number() OVER (ORDER BY id) - 1) / 32.0)::bigint AS batch_id FROM word_ids)"
    sql["padding_economy"] = w(batches, """SELECT side, cast(sum(n * longest) AS bigint) AS batch_slots, cast(sum(n * cap) AS bigint) AS fixed_slots FROM (
        SELECT batch_id, 'code_ids' AS side, count(*) AS n, max(len(code_ids)) AS longest, 256 AS cap FROM batched GROUP BY batch_id
        UNION ALL SELECT batch_id, 'doc_ids', count(*), max(len(doc_ids)), 64 FROM batched GROUP BY batch_id) GROUP BY side""")

    # order, limits, samples
    sql["new_best_flag"] = w(EPOCHS, """SELECT run_id, epoch, val_loss, val_loss < coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY epoch
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'inf'::double) AS new_best FROM epochs""")
    sql["select_runs_by_rank"] = w(RUNS, """SELECT cast(pick AS integer) AS pick, file
      FROM (SELECT unnest([1, 2, 3, 5]) AS pick, unnest([2, 9, 1, 1]) AS rk) JOIN
        (SELECT file, row_number() OVER (ORDER BY file DESC) AS rk FROM runs WHERE file LIKE '%.pt') USING (rk)""")
    sql["subset_first_n"] = w(CLEANED, "SELECT id, split FROM refined ORDER BY id LIMIT 200")
    seeded = "md5('7:' || cast(id AS varchar))"
    sql["sample_n_per_split"] = w(PAIRS, f"SELECT id, split FROM (SELECT id, split, row_number() OVER (PARTITION BY split ORDER BY {seeded}, id) AS r FROM pairs) WHERE r <= 10")
    sql["sort_by_subset"] = w(METRICS, "SELECT file, subset_size, bleu FROM metrics")
    sql["assign_batches"] = w(PAIRS, f"SELECT id, floor((row_number() OVER (ORDER BY {seeded}, id) - 1) / 32.0)::bigint AS batch_id FROM pairs")
    sql["assign_batches_in_order"] = w(PAIRS, "SELECT id, floor((row_number() OVER (ORDER BY id) - 1) / 32.0)::bigint AS batch_id FROM pairs")
    sql["audit_suites"] = w(PAIRS, f"""SELECT suite, id, code, docstring FROM (
        SELECT split AS suite, id, code, docstring, row_number() OVER (PARTITION BY split ORDER BY {seeded}, id) AS r FROM pairs WHERE split <> 'valid')
      WHERE r <= 10 UNION ALL SELECT 'custom', -1 - n_nationkey, 'return ' || n_name, 'Name of a nation.' FROM nation""")
    sql["tokenizer_corpus"] = w(CLEANED, """SELECT id, 0 AS part, code AS line FROM refined WHERE split = 'train'
      UNION ALL SELECT id, 1, docstring FROM refined WHERE split = 'train'""")

    # tokens
    cut = f"regexp_replace(text, '([{UNI_SPACE}])([^{UNI_SPACE}])', chr(57344) || '\\1\\2', 'g')"
    pattern = q(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{UNI_SPACE}\p{{L}}\p{{N}}\x{{e000}}]+|[{UNI_SPACE}]+")
    pieces = f"regexp_extract_all({cut}, {pattern})"
    sql["pretokenize"] = f"SELECT doc_id AS id, cast(len(t) AS integer) AS n, md5(array_to_string(t, chr(1))) AS digest FROM (SELECT doc_id, {pieces} AS t FROM documents)"
    sql["pretoken_counts"] = f"SELECT pretoken, count(*) AS n FROM (SELECT unnest({pieces}) AS pretoken FROM documents) GROUP BY pretoken"
    shown = "array_to_string(code_ids, ' ') AS code_ids, array_to_string(doc_ids, ' ') AS doc_ids"
    sql["encode"] = w(WORD_IDS, f"SELECT id, split, {shown} FROM word_ids")
    padded = ", ".join(
        f"array_to_string(list_concat({c}, list_transform(range(0, m_{c} - len({c})), lambda x: 0)), ' ') AS {c}" for c in ("code_ids", "doc_ids"))
    sql["pad_batch"] = w(batches, f"""SELECT id, batch_id, {padded}
      FROM (SELECT *, max(len(code_ids)) OVER (PARTITION BY batch_id) AS m_code_ids, max(len(doc_ids)) OVER (PARTITION BY batch_id) AS m_doc_ids FROM batched)""")
    sql["decode"] = w(WORD_IDS, """SELECT a.id, coalesce(string_agg(token, ' ' ORDER BY side, nth) FILTER (WHERE t.id IS NOT NULL), '') AS text
      FROM at_words a LEFT JOIN word_table t USING (token) GROUP BY a.id""")

    # logs
    sql["parse_epochs"] = w(LOGS, f"""SELECT run_id, cast(floor((epoch - 1) / {float(LOG_PART)}) AS integer) AS part,
        cast((epoch - 1) % {LOG_PART} + 1 AS integer) AS pos, epoch, round(train_loss, 4) AS train_loss, round(val_loss, 4) AS val_loss, seconds FROM log_epochs""")
    sql["parse_epochs_lenient"] = w(LOGS, "SELECT run_id, epoch, round(val_loss, 4) AS val_loss FROM log_epochs")
    name = "CASE WHEN run_id % 10 <> 0 AND part = 0 THEN replace(file, '.pt', '') ELSE 'run' || run_id || '_part' || part END"
    score = "CASE WHEN run_id % 10 <> 0 AND part = 0 THEN {0} END AS {0}"
    sql["parse_run_metrics"] = w(LOGS, f"SELECT run_id, part, {name} AS name, {score.format('bleu')}, {score.format('rougeL')} FROM logs JOIN runs USING (run_id)")
    phases = "'evaluation_fast=' || printf('%.2f', cast(n_epochs AS double)) || ',model_training=' || printf('%.2f', total_seconds)"
    sql["run_summary"] = w(LOGS, f"""SELECT r.run_id, CASE WHEN r.run_id % 10 <> 0 THEN replace(file, '.pt', '') ELSE 'run' || r.run_id || '_part0' END AS name,
        CASE WHEN r.run_id % 10 <> 0 THEN bleu END AS bleu, CASE WHEN r.run_id % 10 <> 0 THEN rougeL END AS rougeL,
        cast(be AS bigint) AS best_epoch, round(lo, 4) AS min_val_loss, coalesce(n, 0) AS n_epochs, round(mean_s, 6) AS mean_epoch_seconds,
        {phases} AS phases, total_seconds AS training_seconds
      FROM runs r LEFT JOIN (SELECT run_id, {best} AS be, min(val_loss) AS lo, count(*) AS n, avg(seconds) AS mean_s FROM log_epochs GROUP BY run_id) e
        ON r.run_id = e.run_id""")
    part = f"cast(floor((epoch - 1) / {float(LOG_PART)}) AS integer)"
    sql["run_summary_files"] = w(LOGS, f"""SELECT CASE WHEN part = 0 AND r.run_id % 10 <> 0 THEN bleu END AS bleu,
        CASE WHEN part = 0 AND r.run_id % 10 <> 0 THEN rougeL END AS rougeL, cast(be AS bigint) AS best_epoch, round(lo, 4) AS min_val_loss,
        coalesce(n, 0) AS n_epochs, round(mean_s, 6) AS mean_epoch_seconds, CASE WHEN part = 0 THEN {phases} ELSE '' END AS phases,
        CASE WHEN part = 0 THEN total_seconds END AS training_seconds
      FROM logs l JOIN runs r USING (run_id) LEFT JOIN (
        SELECT run_id, {part} AS part, arg_min((epoch - 1) % {LOG_PART} + 1, (val_loss, epoch)) AS be, min(val_loss) AS lo, count(*) AS n, avg(seconds) AS mean_s
        FROM log_epochs GROUP BY ALL) e USING (run_id, part)""")

    # sources as syntax, predictions
    sql["extract_symbols"] = w(SOURCES, """SELECT path, CASE form WHEN 0 THEN 'Function' WHEN 1 THEN 'Async Function' ELSE 'Class' END AS type,
        name, 4 AS lineno, CASE form WHEN 0 THEN 'a, b, *args, k, **kw' WHEN 1 THEN 'p, q' END AS args,
        'Doc ' || l_linestatus || '.' AS docstring FROM sources""")
    sql["extract_imports"] = w(IMPORT_ROWS, "SELECT path, module, relative FROM imports")
    sql["batch_predict"] = w(KEYWORDS, f"SELECT id, split AS run, prediction, length(replace(docstring, ' ', '')) / 10.0::double AS nll_sum, cast({n_words('docstring')} AS bigint) AS n_tokens FROM predicted")
    sql["evaluation_report"] = w(
        EVALUATED + f""", reported AS (SELECT id || '-' || file AS id, file, {words('docstring')} AS ref, {words('prediction')} AS hyp FROM predicted),
        pieces AS (SELECT id, file, {rouge_words('ref')} AS r, {rouge_words('hyp')} AS h FROM reported), {lcs_sql('pieces')},
        rouge AS (SELECT file, {f_mean} AS f FROM pieces JOIN lcs USING (id) GROUP BY file), {bleu_sql('reported', 'file')},
        losses AS (SELECT file, sum(length(array_to_string(ref, '')) / 10.0::double) / sum(len(ref)) AS loss FROM reported GROUP BY file)""",
        """SELECT b.file, regexp_extract(b.file, '_0000_(.*)_sub', 1) AS model, round(bleu, 6) AS bleu, round(f, 6) AS rougeL,
        round(loss, 6) AS loss, round(exp(loss), 6) AS perplexity FROM bleu b JOIN rouge r ON b.file = r.file JOIN losses l ON b.file = l.file""", True)

    # streaming
    sql["refine_stream"] = w(CLEANED, "SELECT split, fp, count(*) AS n FROM refined GROUP BY split, fp")
    return sql
