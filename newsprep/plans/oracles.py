"""SQL twins of the queries, written for DuckDB over the same tables.

They are built from named steps (common table expressions). Each twin states the
meaning of its query in plain SQL: full rankings instead of cut-offs, joins
instead of conditional counts, a recursive search instead of a fold.
"""

from __future__ import annotations

from newsprep.functions.fixed_values import (
    EVALUATION_KEYS,
    NON_WHITESPACE_CLASS,
    RESUME_KEYS,
    SYSTEM_PROMPT,
    TRUNCATION_MARKER,
    USER_PREFIX,
    USER_SUFFIX,
    WHITESPACE,
    WHITESPACE_CLASS,
    WORD_PATTERN,
)


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip(expression: str) -> str:
    return f"trim({expression}, {quote(WHITESPACE)})"


def title(expression: str) -> str:
    pieces = f"regexp_extract_all(lower({strip(expression)}), '\\p{{L}}+|\\P{{L}}+')"
    return f"array_to_string(list_transform({pieces}, lambda w: upper(w[1]) || w[2:]), '')"


def fingerprint(expression: str) -> str:
    collapsed = f"regexp_replace({expression}, {quote(WHITESPACE_CLASS + '+')}, ' ', 'g')"
    return f"sha256(lower(trim({collapsed})))"


def tokens(expression: str) -> str:
    return f"regexp_extract_all(lower({expression}), {quote(WORD_PATTERN)})"


def digest60(expression: str) -> str:
    return f"CAST('0x' || substring(sha256({expression}), 1, 15) AS BIGINT)"


def completion(summary: str, label: str) -> str:
    return (
        f"'<SUMMARY>' || chr(10) || {strip(summary)} || chr(10) || '</SUMMARY>' || chr(10)"
        f" || '<SENTIMENT>' || chr(10) || {label} || chr(10) || '</SENTIMENT>'"
    )


def user_text(article: str) -> str:
    return f"{quote(USER_PREFIX)} || {article} || {quote(USER_SUFFIX)}"


def rendered(article: str, answer: str) -> str:
    return (
        f"'<system>' || {quote(SYSTEM_PROMPT)} || '</system><user>' || {user_text(article)}"
        f" || '</user><assistant>' || {answer} || '</assistant>'"
    )


def words(expression: str) -> str:
    return f"len(regexp_extract_all({expression}, {quote(NON_WHITESPACE_CLASS + '+')}))"


MARKER = quote(TRUNCATION_MARKER)


def head_tail(text: str, keep: str) -> str:
    head = f"greatest(1, CAST(floor({keep} * 0.75) AS INTEGER))"
    tail = f"({keep} - {head})"
    return (
        f"CASE WHEN {keep} >= length({text}) THEN {text} WHEN {keep} <= 0 THEN {strip(MARKER)} "
        f"ELSE {strip(strip(f'substring({text}, 1, {head})') + ' || ' + MARKER + ' || ' + f'CASE WHEN {tail} > 0 THEN ' + strip(f'right({text}, {tail})') + ' ELSE ' + quote('') + ' END')} END"
    )


def twin(final: str, *steps: str, recursive: bool = False) -> str:
    if not steps:
        return final.strip()
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(s.strip() for s in steps) + \
        "\n" + final.strip()


ARTICLES = """
articles AS (
  SELECT d.doc_id AS row_id, d.text AS "Content",
    regexp_extract(d.text, '[^.\\n]+[.]?', 0) AS "Summary",
    CASE WHEN l.toxic = 1 THEN ' negative ' WHEN l.quality = 1 THEN 'POSITIVE'
         WHEN l.quality = 0 THEN 'neutral' ELSE '' END AS "Sentiment",
    d.source,
    strftime(DATE '2024-01-01' + CAST(d.doc_id % 365 AS INTEGER), '%Y-%m-%d') AS news_date
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)
"""

NON_EMPTY = " AND ".join(
    strip(f'"{c}"') + " <> ''" for c in ("Content", "Summary", "Sentiment")
)

CLEANED = f"""
cleaned AS (
  SELECT row_id, "Content", "Summary", {title('"Sentiment"')} AS "Sentiment", source, news_date,
    {fingerprint('"Content"')} AS fp
  FROM articles WHERE {NON_EMPTY}
)
"""


def kept(deduplicate: bool = True) -> str:
    first = "QUALIFY row_number() OVER (PARTITION BY fp ORDER BY row_id) = 1" if deduplicate else ""
    return f"kept AS (SELECT * FROM cleaned {first})"


def split(test_size: str = "0.1", stratify: bool = True) -> str:
    possible = "smallest >= 2 AND target >= classes AND total - target >= classes"
    return f"""
sizes AS (SELECT "Sentiment" AS lab, count(*) AS n FROM kept GROUP BY 1),
totals AS (
  SELECT CAST(sum(n) AS BIGINT) AS total, min(n) AS smallest, count(*) AS classes,
    CAST(ceil(CAST(sum(n) AS DECIMAL(18,0)) * {test_size}) AS BIGINT) AS target FROM sizes
),
shares AS (
  SELECT lab, target, (target * n) // total AS whole, (target * n) % total AS fraction,
    {str(stratify).upper()} AND {possible} AS stratified FROM sizes, totals
),
quotas AS (
  SELECT lab, target, stratified, whole + CASE WHEN
    row_number() OVER (ORDER BY fraction DESC, lab) <= target - sum(whole) OVER ()
    THEN 1 ELSE 0 END AS quota FROM shares
),
ranked AS (
  SELECT k.*, q.quota, q.target, q.stratified, row_number() OVER (
    PARTITION BY CASE WHEN q.stratified THEN q.lab ELSE '*' END
    ORDER BY sha256('42:' || k.row_id), k.row_id) AS place
  FROM kept k JOIN quotas q ON q.lab = k."Sentiment"
),
split AS (
  SELECT * EXCLUDE (quota, target, stratified, place),
    CASE WHEN place <= CASE WHEN stratified THEN quota ELSE target END
      THEN 'test' ELSE 'train' END AS split
  FROM ranked
)
"""


def fit_char(source: str, max_length: int = 1024) -> str:
    """Steps ``to_fit``, ``search`` (recursive) and ``fitted`` over a relation."""
    empty = rendered("''", completion('"Summary"', '"Sentiment"'))
    middle = "((low + high) // 2)"
    return f"""
to_fit AS (
  SELECT *, {max_length} - length({empty}) AS budget FROM {source}
),
search AS (
  SELECT row_id, "Content" AS text, budget, CAST(0 AS BIGINT) AS low, length("Content") AS high,
    CAST(-1 AS BIGINT) AS best
  FROM to_fit WHERE length("Content") > budget
  UNION ALL
  SELECT row_id, text, budget, CASE WHEN fits THEN middle + 1 ELSE low END,
    CASE WHEN fits THEN high ELSE middle - 1 END, CASE WHEN fits THEN middle ELSE best END
  FROM (
    SELECT *, length({head_tail('text', 'middle')}) <= budget AS fits
    FROM (SELECT *, {middle} AS middle FROM search WHERE low <= high)
  )
),
found AS (SELECT row_id, best FROM search WHERE low > high),
cut AS (
  SELECT t.*, f.best, CASE WHEN f.best IS NULL THEN t."Content"
    WHEN f.best >= 0 THEN {head_tail('t."Content"', 'f.best')} END AS article
  FROM to_fit t LEFT JOIN found f ON f.row_id = t.row_id
),
fitted AS (
  SELECT *, CAST(length(article) + {max_length} - budget AS INTEGER) AS sequence_length,
    best IS NOT NULL AS was_truncated, coalesce(best < 0, FALSE) AS overflow
  FROM cut
)
"""


def fit_word(source: str, max_length: int = 400) -> str:
    empty = rendered("''", completion('"Summary"', '"Sentiment"'))
    pattern = quote(f"{WHITESPACE_CLASS}*{NON_WHITESPACE_CLASS}+")
    head = "greatest(1, CAST(floor(best * 0.75) AS BIGINT))"
    tail = f"(best - {head})"
    joined_head = strip(f"array_to_string(pieces[1:{head}], '')")
    joined_tail = strip(f"array_to_string(pieces[len(pieces) - {tail} + 1:], '')")
    cut = strip(
        f"{joined_head} || {MARKER} || CASE WHEN {tail} > 0 THEN {joined_tail} ELSE '' END"
    )
    return f"""
to_fit AS (
  SELECT *, {max_length} - {words(empty)} AS budget,
    regexp_extract_all("Content", {pattern}) AS pieces FROM {source}
),
searched AS (
  SELECT *, CASE WHEN len(pieces) > budget THEN
    (SELECT coalesce(max(k), -1) FROM (SELECT unnest(range(0, len(pieces) + 1)) AS k)
     WHERE CASE WHEN k >= len(pieces) THEN k ELSE k + {len(TRUNCATION_MARKER.split())} END
       <= budget) END AS best
  FROM to_fit
),
cut AS (
  SELECT *, CASE WHEN best IS NULL THEN "Content" WHEN best = 0 THEN {strip(MARKER)}
    WHEN best > 0 THEN {cut} END AS article FROM searched
),
fitted AS (
  SELECT *, CAST({words('article')} + {max_length} - budget AS INTEGER) AS sequence_length,
    best IS NOT NULL AS was_truncated, coalesce(best < 0, FALSE) AS overflow
  FROM cut
)
"""


def responses(source: str = "articles", name: str = "responses", shift: int = 0) -> str:
    shape = f"(CAST(substring(source, 4) AS INTEGER) + {shift}) % 10"
    label = """upper(trim("Sentiment")[1]) || lower(trim("Sentiment")[2:])"""
    wrong = (
        f"CASE {label} WHEN 'Positive' THEN 'Negative' WHEN 'Negative' THEN 'Neutral' "
        "ELSE 'Positive' END"
    )

    def answer(inner: str, tag: str) -> str:
        return (
            f"'<SUMMARY>' || chr(10) || {inner} || chr(10) || '</SUMMARY>' || chr(10)"
            f" || '<SENTIMENT>' || chr(10) || {tag} || chr(10) || '</SENTIMENT>'"
        )

    summary = '"Summary"'
    return f"""
{name} AS (
  SELECT row_id, CASE {shape}
    WHEN 0 THEN 'No structured answer: ' || {summary}
    WHEN 1 THEN '<SUMMARY>' || {summary} || '</SUMMARY>'
    WHEN 2 THEN '<summary> ' || {summary} || ' </summary>' || chr(10)
      || '<sentiment> neutral </sentiment>'
    WHEN 3 THEN '<SUMMARY>  </SUMMARY><SENTIMENT>' || {label} || '</SENTIMENT>'
    WHEN 4 THEN {answer(summary, "'Positive, Negative, or Neutral'")}
    WHEN 5 THEN {answer(summary, "'Negative'")} || '<SENTIMENT>' || {label} || '</SENTIMENT>'
    WHEN 6 THEN {answer(summary, wrong)}
    WHEN 7 THEN {answer("split_part(" + '"Content"' + ", chr(10), 1)", label)}
    WHEN 8 THEN {answer("split_part(" + '"Content"' + ", chr(10), 2)", label)}
    ELSE {answer("regexp_replace(" + summary + ", '^[^ ]* ', '')", label)} END AS raw_response
  FROM {source}
)
"""


def parsed(source: str = "responses", name: str = "parsed") -> str:
    space = WHITESPACE_CLASS
    summary = quote(f"(?is)<SUMMARY>{space}*(.*?){space}*</SUMMARY>")
    label = quote(f"(?i)<SENTIMENT>{space}*(Positive|Negative|Neutral){space}*</SENTIMENT>")
    found = f"lower(regexp_extract(raw_response, {label}, 1))"
    return f"""
{name} AS (
  SELECT row_id, raw_response,
    CASE WHEN regexp_matches(raw_response, {summary})
      THEN {strip(f'regexp_extract(raw_response, {summary}, 1)')} END AS predicted_summary,
    CASE WHEN regexp_matches(raw_response, {label})
      THEN upper({found}[1]) || {found}[2:] END AS predicted_sentiment
  FROM {source}
)
"""


def rouge(source: str, name: str = "scored", prefix: str = "") -> str:
    """Steps that score a relation (row_id, reference, prediction).

    Bit-parallel longest common subsequence on lists of 60-bit words: every word
    of a row is [word, word & mask], folded with the carry in front.
    """
    p = prefix
    total = "(e[1] + e[2] + acc[1])"
    next_word = f"(({total} & {2**60 - 1}) | (e[1] - e[2]))"
    fold = (
        "list_reduce(list_transform(range(1, len(v) + 1), lambda i: [v[i], v[i] & m[i]]), "
        f"lambda acc, e: list_concat([{total} >> 60], acc[2:], [{next_word}]), "
        "[CAST(0 AS BIGINT)])[2:]"
    )
    return f"""
{p}pairs AS (
  SELECT row_id, {tokens("coalesce(reference, '')")} AS a,
    {tokens("coalesce(prediction, '')")} AS b FROM {source}
),
{p}left_words AS (
  SELECT row_id, unnest(a) AS tok, generate_subscripts(a, 1) AS i FROM {p}pairs
),
{p}right_words AS (
  SELECT row_id, len(b) AS size, unnest(b) AS tok, generate_subscripts(b, 1) - 1 AS pos
  FROM {p}pairs
),
{p}places AS (
  SELECT row_id, tok, any_value(size) AS size, list(pos) AS ps FROM {p}right_words GROUP BY ALL
),
{p}masks AS (
  SELECT row_id, tok, list_transform(range(0, (size + 59) // 60), lambda w:
    CAST(coalesce(list_sum(list_transform(list_filter(ps, lambda x: x // 60 = w),
      lambda x: CAST(1 AS BIGINT) << CAST(x % 60 AS INTEGER))), 0) AS BIGINT)) AS mask
  FROM {p}places
),
{p}sequences AS (
  SELECT row_id, list(mask ORDER BY i) AS ms FROM {p}left_words JOIN {p}masks USING (row_id, tok)
  GROUP BY row_id
),
{p}ends AS (
  SELECT row_id, list_reduce(ms, lambda v, m: {fold},
    list_transform(ms[1], lambda x: CAST({2**60 - 1} AS BIGINT))) AS v FROM {p}sequences
),
{p}lengths AS (
  SELECT row_id, len(v) * 60 - list_sum(list_transform(v, lambda x: bit_count(x))) AS lcs
  FROM {p}ends
),
{p}sized AS (
  SELECT p.row_id, CAST(coalesce(l.lcs, 0) AS INTEGER) AS lcs, len(a) AS n, len(b) AS m
  FROM {p}pairs p LEFT JOIN {p}lengths l ON l.row_id = p.row_id
),
{name} AS (
  SELECT row_id, lcs,
    CASE WHEN lcs > 0 THEN lcs / m ELSE 0.0 END AS precision,
    CASE WHEN lcs > 0 THEN lcs / n ELSE 0.0 END AS recall,
    CASE WHEN lcs > 0 THEN 2.0 * lcs / (n + m) ELSE 0.0 END AS f1
  FROM {p}sized
)
"""


def records(
    references: str = "cleaned", *, answers: str = "parsed", name: str = "records", prefix: str = ""
) -> str:
    """Prediction records of a relation of references; also scores them."""
    empty = rendered('"Content"', completion('"Summary"', '"Sentiment"'))
    return f"""
{prefix}aligned AS (
  SELECT c.*, {strip('c."Summary"')} AS reference, p.predicted_summary AS prediction,
    p.predicted_sentiment, coalesce(p.raw_response, '') AS raw_response,
    length({empty}) > 1024 AS article_truncated
  FROM {references} c LEFT JOIN {answers} p ON p.row_id = c.row_id
),
{rouge(prefix + 'aligned', prefix + 'scored', prefix).strip()},
{name} AS (
  SELECT a.row_id AS index, a."Sentiment" AS reference_sentiment, a.predicted_sentiment,
    a.reference AS reference_summary, a.prediction AS predicted_summary, s.f1 AS rouge_l_f1,
    a.article_truncated, a.raw_response, a."Content", a.news_date
  FROM {prefix}aligned a JOIN {prefix}scored s ON s.row_id = a.row_id
)
"""


ALIGNED = f"""
aligned AS (
  SELECT c.*, {strip('c."Summary"')} AS reference, p.predicted_summary AS prediction,
    p.predicted_sentiment
  FROM cleaned c LEFT JOIN parsed p ON p.row_id = c.row_id
)
"""
LABEL_PAIRS = """
records AS (
  SELECT row_id AS index, "Sentiment" AS reference_sentiment, predicted_sentiment,
    prediction AS predicted_summary FROM aligned
)
"""
# Records as far as no ROUGE-L is needed.
PLAIN = (ARTICLES, CLEANED, responses(), parsed(), ALIGNED, LABEL_PAIRS)
FULL = (ARTICLES, CLEANED, responses(), parsed(), records())

PRF = """
domain AS (SELECT unnest(['Negative', 'Neutral', 'Positive']) AS label),
hits AS (
  SELECT label,
    count(*) FILTER (reference_sentiment = label AND predicted_sentiment = label)
      AS true_positive,
    count(*) FILTER (reference_sentiment <> label AND predicted_sentiment = label)
      AS false_positive,
    count(*) FILTER (reference_sentiment = label
      AND predicted_sentiment IS DISTINCT FROM label) AS false_negative
  FROM domain, records GROUP BY label
),
rates AS (
  SELECT *,
    CASE WHEN true_positive + false_positive > 0
      THEN true_positive / (true_positive + false_positive) ELSE 0.0 END AS precision,
    CASE WHEN true_positive + false_negative > 0
      THEN true_positive / (true_positive + false_negative) ELSE 0.0 END AS recall
  FROM hits
),
prf AS (
  SELECT *, CASE WHEN precision + recall > 0
    THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM rates
)
"""

REPORT = """
ref_counts AS (
  SELECT '{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}' AS doc FROM (
    SELECT reference_sentiment AS k, count(*) AS n FROM records GROUP BY 1)
),
pred_counts AS (
  SELECT '{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}' AS doc FROM (
    SELECT coalesce(predicted_sentiment, 'UNPARSED') AS k, count(*) AS n FROM records GROUP BY 1)
),
report AS (
  SELECT count(*) AS examples,
    round(avg(CASE WHEN reference_sentiment IS NOT DISTINCT FROM predicted_sentiment
      THEN 1.0 ELSE 0.0 END), 6) AS sentiment_accuracy,
    (SELECT round(avg(f1), 6) FROM prf) AS sentiment_macro_f1,
    round(count(predicted_sentiment) / count(*), 6) AS sentiment_parse_rate,
    round(count(predicted_summary) / count(*), 6) AS summary_parse_rate,
    round(avg(rouge_l_f1), 6) AS mean_rouge_l_f1,
    (SELECT doc FROM ref_counts) AS reference_class_counts,
    (SELECT doc FROM pred_counts) AS predicted_class_counts
  FROM records
)
"""

RAW_LABELS = """
raw_labels AS (
  SELECT event_id AS row_id, CASE event_type WHEN 'view' THEN ' neutral '
    WHEN 'click' THEN 'POSITIVE' WHEN 'purchase' THEN 'mostly-positive'
    WHEN 'signup' THEN 'Negative' || chr(10) ELSE ' unparsed ' END AS "Sentiment"
  FROM events
)
"""

ISO = "'%Y-%m-%dT%H:%M:%S'"

MANIFESTS = f"""
manifests AS (
  SELECT 'run-' || o_orderkey AS run_id, 'line-' || o_custkey AS lineage,
    CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'failed'
      WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'training' ELSE 'preparing' END
      AS status,
    strftime(o_orderdate, {ISO}) || '+00:00' AS created_at,
    CASE WHEN o_orderstatus <> 'O' THEN
      strftime(o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)), {ISO})
      || '+00:00' END AS ended_at,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(floor(o_totalprice) AS BIGINT) END AS seconds,
    CAST(floor(o_totalprice) AS BIGINT) AS train_rows,
    CAST(floor(o_totalprice) AS BIGINT) // 10 AS eval_rows,
    sha256(o_custkey || ':' || o_orderpriority) AS train_fingerprint,
    CASE WHEN o_orderstatus <> 'O' THEN sha256(CAST(o_custkey AS VARCHAR)) END
      AS eval_fingerprint,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS resumes,
    o_orderpriority AS priority, o_orderstatus AS state
  FROM orders
),
pairs AS (
  SELECT * FROM (
    SELECT run_id AS current_run, first_value(run_id) OVER (
      PARTITION BY lineage ORDER BY created_at, run_id) AS saved_run FROM manifests)
  WHERE current_run <> saved_run
)
"""

ARGUMENTS = """
arguments AS (
  SELECT run_id, unnest(['dataset_id', 'dataset_split', 'limit', 'test_size', 'seed',
      'max_length', 'learning_rate', 'no_deduplicate']) AS key,
    unnest(['articles', 'train', CASE WHEN priority = '2-HIGH' THEN '0' ELSE '5000' END, '0.1',
      CASE WHEN state = 'P' THEN '7' ELSE '42' END,
      CASE WHEN priority = '5-LOW' THEN '512' ELSE '1024' END,
      CASE WHEN priority <> '4-NOT SPECIFIED' THEN '0.0002' END, 'false']) AS value
  FROM manifests
)
"""


def config_diff(keys) -> str:
    names = ", ".join(map(quote, keys))
    return twin(
        f"""
SELECT p.saved_run, p.current_run, s.key, s.value AS saved, c.value AS current
FROM pairs p JOIN arguments s ON s.run_id = p.saved_run AND s.value IS NOT NULL
LEFT JOIN arguments c ON c.run_id = p.current_run AND c.key = s.key
WHERE s.key IN ({names}) AND s.value IS DISTINCT FROM c.value
""",
        MANIFESTS, ARGUMENTS,
    )


LOG = """
log AS (
  SELECT ts AS event_time, event_id AS key, user_id, value AS latency_ms,
    CASE event_type WHEN 'view' THEN 'Neutral' WHEN 'click' THEN 'Positive'
      WHEN 'purchase' THEN 'Positive' WHEN 'signup' THEN 'Negative' END AS predicted
  FROM events
)
"""

LONG_REPORT = """
metrics AS (
  UNPIVOT (SELECT sentiment_accuracy, sentiment_parse_rate, mean_rouge_l_f1 FROM report)
  ON sentiment_accuracy, sentiment_parse_rate, mean_rouge_l_f1 INTO NAME metric VALUE value
)
"""

SPLIT = (ARTICLES, CLEANED, kept(), split())
FORMATTED = """
formatted AS (
  SELECT *, %s AS user_text, %s AS assistant_text, %s AS whole FROM fitted WHERE NOT overflow
)
""" % (
    user_text("article"),
    completion('"Summary"', '"Sentiment"'),
    rendered("article", completion('"Summary"', '"Sentiment"')),
)

DIMENSIONS = "reference_sentiment, length_bucket, news_date"

ORACLES: dict[str, str] = {
    "load_articles": twin(
        'SELECT row_id, "Content", "Summary", "Sentiment" FROM articles', ARTICLES
    ),
    "schema_contract": """
SELECT name AS "column", name IN (SELECT column_name FROM (DESCRIBE documents)) AS present
FROM (SELECT unnest(['Sentiment', 'Summary', 'lang', 'text']) AS name)
""",
    "sft_dataset_roundtrip": twin(
        f"""
SELECT split, count(*) AS rows, bit_xor({digest60('whole')}) AS digest,
  CAST(sum(sequence_length) AS BIGINT) AS total_length FROM formatted GROUP BY split
""",
        *SPLIT, fit_char("split"), FORMATTED, recursive=True,
    ),
    "predictions_jsonl_roundtrip": twin(
        """
SELECT index, reference_sentiment, predicted_sentiment, reference_summary, predicted_summary,
  round(rouge_l_f1, 6) AS rouge_l_f1, article_truncated, raw_response FROM records
""",
        *FULL,
    ),
    "run_registry": twin(
        """
SELECT m.run_id, m.status, m.created_at, m.ended_at, m.train_rows, m.eval_rows, m.resumes,
  coalesce(j.attempts, 0) AS job_attempts, j.status AS job_status, j.exit_code AS job_exit_code,
  j.host AS job_host
FROM manifests m LEFT JOIN latest j ON j.run_id = m.run_id
""",
        MANIFESTS,
        f"""
jobs AS (
  SELECT 'run-' || l_orderkey AS run_id,
    CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'completed' END AS status,
    CASE WHEN l_returnflag = 'R' THEN 7 ELSE 0 END AS exit_code,
    strftime(l_shipdate, {ISO}) AS started_at,
    strftime(l_shipdate + to_hours(CAST(l_quantity AS INTEGER)), {ISO}) AS finished_at,
    'host-' || l_suppkey AS host
  FROM lineitem
),
latest AS (
  SELECT *, count(*) OVER (PARTITION BY run_id) AS attempts FROM jobs
  QUALIFY row_number() OVER (PARTITION BY run_id
    ORDER BY started_at DESC, finished_at DESC, exit_code DESC, host DESC) = 1
)
""",
    ),
    "quarantined_json": twin(
        """
SELECT 'row' AS kind, CAST(row_id AS VARCHAR) AS row_id,
  sha256(concat_ws('|', "Content", "Summary", "Sentiment")) AS digest
FROM articles WHERE row_id % 7 <> 0
UNION ALL
SELECT 'line', NULL, sha256('{"row_id": "' || row_id || '", "Content": "cut off') FROM articles WHERE row_id % 7 = 0
""",
        ARTICLES,
    ),
    "quarantined_csv": twin(
        """
SELECT CASE WHEN doc_id % 7 = 0 THEN 'line' ELSE 'row' END AS kind,
  CASE WHEN doc_id % 7 <> 0 THEN CAST(doc_id AS VARCHAR) END AS row_id,
  sha256(CASE WHEN doc_id % 7 = 0 THEN doc_id || ',one, two ' || plain || '|,' || source || ',' || lang
    ELSE 'one ' || plain || '||' || source || '|' || lang END) AS digest
FROM (SELECT *, trim(translate(coalesce(text, ''),
  ',"' || chr(10) || chr(13) || chr(9) || chr(92), '      ')) AS plain FROM documents)
"""
    ),
    "append_again": twin(
        """
SELECT 'run' AS run_id, CAST(index % 2 AS VARCHAR) AS batch, count(*) AS records, count(DISTINCT index) AS rows
FROM records GROUP BY ALL
""",
        *FULL,
    ),
    "sft_table_join": twin(
        """
SELECT f.split, count(*) AS rows, CAST(sum(f.sequence_length) AS BIGINT) AS total_length,
  CAST(sum(length(r.raw_response)) AS BIGINT) AS answer_chars
FROM formatted f JOIN responses r ON r.row_id = f.row_id GROUP BY f.split
""",
        *SPLIT, responses(), fit_char("split"), FORMATTED, recursive=True,
    ),
    "manifest_files": twin(
        """
SELECT lineage, status, created_at, train_rows,
  CASE WHEN priority = '2-HIGH' THEN '0' ELSE '5000' END AS row_limit
FROM manifests WHERE run_id IN (SELECT saved_run FROM pairs)
""",
        MANIFESTS,
    ),
    "resume_unscored": twin(
        """
SELECT row_id, "Sentiment" FROM cleaned
QUALIFY row_number() OVER (PARTITION BY fp ORDER BY row_id) > 1
""",
        ARTICLES, CLEANED,
    ),
    "drop_empty_rows": twin(
        f'SELECT row_id, "Content", "Summary", "Sentiment" FROM articles WHERE {NON_EMPTY}',
        ARTICLES,
    ),
    "normalize_sentiment": twin(
        f"""SELECT row_id, {title('"Sentiment"')} AS "Sentiment" FROM raw_labels""", RAW_LABELS
    ),
    "unexpected_labels": twin(
        f"""
SELECT label, count(*) AS rows FROM (SELECT {title('"Sentiment"')} AS label FROM raw_labels)
WHERE label NOT IN ('Negative', 'Neutral', 'Positive') GROUP BY label
""",
        RAW_LABELS,
    ),
    "content_fingerprint":
        f"SELECT doc_id AS row_id, {fingerprint('text')} AS fingerprint FROM documents",
    "dedup_keep_first": f"""
SELECT doc_id, text, source FROM documents
QUALIFY row_number() OVER (PARTITION BY {fingerprint('text')} ORDER BY doc_id) = 1
""",
    "dedup_report": f"""
SELECT copies, count(*) AS groups, CAST(sum(copies) AS BIGINT) AS rows,
  CAST(sum(copies - 1) AS BIGINT) AS removed
FROM (SELECT count(*) AS copies FROM documents GROUP BY {fingerprint('text')}) GROUP BY copies
""",
    "seeded_sample": """
SELECT doc_id, text FROM documents
QUALIFY row_number() OVER (ORDER BY sha256('42:' || doc_id), doc_id) <= 500
""",
    "class_counts": twin(
        'SELECT "Sentiment", count(*) AS rows FROM cleaned GROUP BY 1', ARTICLES, CLEANED
    ),
    "encode_labels": twin(
        """
SELECT row_id, CAST(dense_rank() OVER (ORDER BY "Sentiment") - 1 AS INTEGER) AS label_id,
  "Sentiment" FROM cleaned
""",
        ARTICLES, CLEANED,
    ),
    "stratified_split": twin('SELECT row_id, "Sentiment", split FROM split', *SPLIT),
    "random_split_fallback": twin(
        'SELECT row_id, "Sentiment", split FROM split',
        ARTICLES, CLEANED, kept(), split("0.00001"),
    ),
    "random_split": twin(
        "SELECT row_id, split FROM split", ARTICLES, CLEANED, kept(), split(stratify=False)
    ),
    "temporal_holdout": twin(
        """
SELECT row_id, CASE WHEN news_date >= (
    SELECT max(news_date) FROM (
      SELECT news_date, sum(count(*)) OVER (ORDER BY news_date DESC) AS held
      FROM cleaned GROUP BY news_date)
    WHERE held >= (SELECT ceil(count(*) * 0.1) FROM cleaned)) THEN 'test' ELSE 'train' END AS split
FROM cleaned
""",
        ARTICLES, CLEANED,
    ),
    "split_class_counts": twin(
        """
SELECT split, "Sentiment", count(*) AS rows,
  CAST(grouping(split, "Sentiment") AS INTEGER) AS level
FROM split GROUP BY ROLLUP (split, "Sentiment")
""",
        *SPLIT,
    ),
    "eval_subset": twin(
        """
SELECT row_id, "Sentiment", place - 1 AS index FROM (
  SELECT *, row_number() OVER (ORDER BY sha256('43:' || row_id), row_id) AS place
  FROM split WHERE split = 'test') WHERE place <= 25
""",
        *SPLIT,
    ),
    "split_fingerprint": twin(
        f"""
SELECT split, count(*) AS rows, bit_xor(digest) AS digest_xor,
  CAST(sum(digest % 1000000007) % 1000000007 AS BIGINT) AS digest_sum
FROM (SELECT split,
  {digest60('"Content" || chr(31) || "Summary" || chr(31) || "Sentiment"')} AS digest FROM split)
GROUP BY split
""",
        *SPLIT,
    ),
    "split_leakage": twin(
        """
SELECT fp AS fingerprint, count(*) FILTER (split = 'train') AS train_rows,
  count(*) FILTER (split = 'test') AS test_rows FROM split GROUP BY fp
HAVING count(DISTINCT split) = 2
""",
        ARTICLES, CLEANED, kept(deduplicate=False), split(),
    ),
    "split_leakage_after_dedup": twin(
        """
SELECT count(*) AS leaks FROM (SELECT fp FROM split GROUP BY fp HAVING count(DISTINCT split) = 2)
""",
        *SPLIT,
    ),
    "dataset_preflight": twin(
        "SELECT count(*) AS rows, "
        + ", ".join(
            f"""count(*) FILTER ("{c}" IS NULL) AS "{c}_nulls",
count(*) FILTER ({strip(f'"{c}"')} = '') AS "{c}_blanks" """
            for c in ("Content", "Summary", "Sentiment")
        )
        + f""", count(*) FILTER ({NON_EMPTY}) AS usable_rows,
count(*) FILTER ({NON_EMPTY}
  AND {title('"Sentiment"')} NOT IN ('Negative', 'Neutral', 'Positive')) AS unexpected_label_rows,
CAST(min(length("Content")) AS INTEGER) AS "Content_min_length",
round(avg(length("Content")), 6) AS "Content_mean_length",
CAST(max(length("Content")) AS INTEGER) AS "Content_max_length"
FROM articles""",
        ARTICLES,
    ),
    "build_prompt": twin(
        f"""
SELECT row_id, {quote(SYSTEM_PROMPT)} AS system, {user_text('"Content"')} AS user_text,
  'system,user' AS roles FROM articles
""",
        ARTICLES,
    ),
    "build_completion": twin(
        f"""
SELECT row_id, 'assistant' AS role, {completion('"Summary"', '"Sentiment"')} AS content
FROM cleaned
""",
        ARTICLES, CLEANED,
    ),
    "render_chat": twin(
        "SELECT row_id, sha256("
        + rendered('"Content"', completion('"Summary"', '"Sentiment"'))
        + ") AS rendered FROM cleaned",
        ARTICLES, CLEANED,
    ),
    "rendered_length": twin(
        f"""
SELECT row_id, CAST(length(whole) AS INTEGER) AS chars, CAST({words('whole')} AS INTEGER) AS words
FROM (SELECT row_id, {rendered('"Content"', completion('"Summary"', '"Sentiment"'))} AS whole
  FROM cleaned)
""",
        ARTICLES, CLEANED,
    ),
    "head_tail_truncate": f"""
SELECT doc_id AS row_id, {head_tail('text', '(length(text) // 2)')} AS article FROM documents
""",
    "fit_article_char": twin(
        "SELECT row_id, article, sequence_length, was_truncated, overflow FROM fitted",
        ARTICLES, fit_char("articles"), recursive=True,
    ),
    "fit_article_word": twin(
        "SELECT row_id, article, sequence_length, was_truncated, overflow FROM fitted",
        ARTICLES, fit_word("articles"),
    ),
    "fit_overflow": twin(
        "SELECT row_id, source FROM fitted WHERE overflow",
        ARTICLES, fit_char("articles"), recursive=True,
    ),
    "format_sft": twin(
        """
SELECT row_id, split, user_text, assistant_text, FALSE AS enable_thinking, sequence_length,
  was_truncated FROM formatted
""",
        *SPLIT, fit_char("split"), FORMATTED, recursive=True,
    ),
    "format_stats": twin(
        """
SELECT split, count(*) AS rows, count(*) FILTER (was_truncated) AS truncated,
  max(sequence_length) AS max_length FROM formatted GROUP BY split
""",
        *SPLIT, fit_char("split"), FORMATTED, recursive=True,
    ),
    "length_distribution": twin(
        f"""
SELECT count(*) AS rows, round(quantile_cont(chars, 0.5), 6) AS p50,
  round(quantile_cont(chars, 0.9), 6) AS p90, round(quantile_cont(chars, 0.99), 6) AS p99,
  CAST(max(chars) AS INTEGER) AS max_length,
  round(count(*) FILTER (chars > 1024) / count(*), 6) AS over_budget
FROM (SELECT length({rendered('"Content"', completion('"Summary"', '"Sentiment"'))}) AS chars
  FROM cleaned)
""",
        ARTICLES, CLEANED,
    ),
    "tokenize_batches": twin(
        "SELECT row_id, article, sequence_length, was_truncated, overflow FROM fitted",
        ARTICLES, fit_char("articles"), recursive=True,
    ),
    "score_prompts": twin(
        """
SELECT row_id, '<SUMMARY>' || regexp_extract(article, '[^.\\n]+[.]?', 0)
  || '</SUMMARY><SENTIMENT>' || CASE WHEN contains(article, '|') THEN 'Negative'
  WHEN length(article) > 500 THEN 'Positive' ELSE 'Neutral' END || '</SENTIMENT>' AS raw_response
FROM fitted WHERE NOT overflow
""",
        ARTICLES, CLEANED, fit_char("cleaned"), recursive=True,
    ),
    "parse_summary": twin(
        "SELECT row_id, predicted_summary FROM parsed", ARTICLES, responses(), parsed()
    ),
    "parse_sentiment": twin(
        "SELECT row_id, predicted_sentiment FROM parsed", ARTICLES, responses(), parsed()
    ),
    "align_predictions": twin(
        f"""
SELECT c.row_id, c."Sentiment" AS reference_sentiment, p.predicted_sentiment,
  {strip('c."Summary"')} AS reference_summary, p.predicted_summary
FROM cleaned c LEFT JOIN parsed p ON p.row_id = c.row_id
""",
        ARTICLES, CLEANED,
        f"""
firsts AS (
  SELECT * FROM articles
  QUALIFY row_number() OVER (PARTITION BY {fingerprint('"Content"')} ORDER BY row_id) = 1
)
""",
        responses("firsts"), parsed(),
    ),
    "rouge_tokens": f"""
SELECT doc_id AS row_id, CAST(len(t) AS INTEGER) AS tokens,
  sha256(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, {tokens('text')} AS t FROM documents)
""",
    "lcs_length": twin(
        "SELECT row_id, lcs FROM scored",
        ARTICLES, responses(), parsed(),
        """
summaries AS (
  SELECT a.row_id, a."Summary" AS reference, p.predicted_summary AS prediction
  FROM articles a JOIN parsed p ON p.row_id = a.row_id
)
""",
        rouge("summaries"),
    ),
    "rouge_l": twin(
        """
SELECT row_id, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1 FROM scored
""",
        ARTICLES, responses(), parsed(),
        """
summaries AS (
  SELECT a.row_id, a."Summary" AS reference, p.predicted_summary AS prediction
  FROM articles a JOIN parsed p ON p.row_id = a.row_id
)
""",
        rouge("summaries"),
    ),
    "rouge_l_turns": twin(
        """
SELECT row_id.conv_id AS conv_id, row_id.turn AS turn, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1 FROM scored
""",
        """
neighbours AS (
  SELECT {'conv_id': a.conv_id, 'turn': a.turn} AS row_id, a.text AS reference,
    b.text AS prediction
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
)
""",
        rouge("neighbours"),
    ),
    "parse_turns": twin(
        f"""
SELECT a.conv_id, a.turn, {strip("a.text")} AS predicted_summary,
  'Negative' AS predicted_sentiment
FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
"""
    ),
    "prediction_records": twin(
        """
SELECT index, reference_sentiment, predicted_sentiment, reference_summary, predicted_summary,
  round(rouge_l_f1, 6) AS rouge_l_f1, article_truncated, raw_response FROM records
""",
        *FULL,
    ),
    "confusion_counts": twin(
        """
SELECT reference, predicted, count(index) AS rows
FROM (SELECT unnest(['Negative', 'Neutral', 'Positive']) AS reference)
CROSS JOIN (SELECT unnest(['Negative', 'Neutral', 'Positive', 'UNPARSED']) AS predicted)
LEFT JOIN records ON reference_sentiment = reference
  AND coalesce(predicted_sentiment, 'UNPARSED') = predicted
GROUP BY ALL
""",
        *PLAIN,
    ),
    "class_prf": twin(
        """
SELECT label, true_positive, false_positive, false_negative, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1 FROM prf
""",
        *PLAIN, PRF,
    ),
    "macro_f1": twin(
        "SELECT round(avg(f1), 6) AS sentiment_macro_f1 FROM prf", *PLAIN, PRF
    ),
    "accuracy": twin(
        """
SELECT round(count(*) FILTER (reference_sentiment = predicted_sentiment) / count(*), 6)
  AS sentiment_accuracy FROM records
""",
        *PLAIN,
    ),
    "parse_rates": twin(
        """
SELECT round(count(predicted_sentiment) / count(*), 6) AS sentiment_parse_rate,
  round(count(predicted_summary) / count(*), 6) AS summary_parse_rate FROM records
""",
        *PLAIN,
    ),
    "mean_rouge": twin("SELECT round(avg(rouge_l_f1), 6) AS mean_rouge_l_f1 FROM records", *FULL),
    "label_distributions": twin(
        """
SELECT 'reference' AS side, reference_sentiment AS label, count(*) AS rows FROM records
GROUP BY ALL
UNION ALL
SELECT 'predicted', coalesce(predicted_sentiment, 'UNPARSED'), count(*) FROM records GROUP BY ALL
""",
        *PLAIN,
    ),
    "metrics_report": twin("SELECT * FROM report", *FULL, PRF, REPORT),
    "holdout_report": twin(
        "SELECT * FROM report",
        *SPLIT, responses(), parsed(),
        "held AS (SELECT * FROM split WHERE split = 'test')", records("held"), PRF, REPORT,
    ),
    "threshold_gate": twin(
        """
SELECT m.metric, m.value, t.minimum, CASE WHEN t.minimum IS NULL THEN 'skipped'
  WHEN m.value >= t.minimum THEN 'passed' ELSE 'failed' END AS verdict
FROM metrics m JOIN (VALUES ('sentiment_accuracy', CAST(0.5 AS DOUBLE)),
  ('sentiment_parse_rate', 0.99), ('mean_rouge_l_f1', NULL)) AS t(metric, minimum)
  ON t.metric = m.metric
""",
        *FULL, PRF, REPORT, LONG_REPORT,
    ),
    "error_slices": twin(
        f"""
SELECT {DIMENSIONS}, CAST(grouping({DIMENSIONS}) AS INTEGER) AS level, count(*) AS rows,
  count(*) FILTER (reference_sentiment IS DISTINCT FROM predicted_sentiment) AS errors,
  count(*) - count(predicted_sentiment) AS unparsed,
  round(count(*) FILTER (reference_sentiment IS DISTINCT FROM predicted_sentiment)
    / count(*), 6) AS error_rate
FROM sliced GROUP BY CUBE ({DIMENSIONS})
""",
        *PLAIN[:-1],
        """
sliced AS (
  SELECT "Sentiment" AS reference_sentiment, predicted_sentiment, news_date,
    CASE WHEN length("Content") < 500 THEN '0-499' WHEN length("Content") < 2000 THEN '500-1999'
      WHEN length("Content") < 8000 THEN '2000-7999' ELSE '8000+' END AS length_bucket
  FROM aligned
)
""",
    ),
}

CLAIMS = f"""
words AS (
  SELECT row_id, "Sentiment" AS reference_sentiment, "Content",
    list_distinct({tokens("coalesce(prediction, '')")}) AS ws FROM aligned
),
claims AS (
  SELECT row_id, reference_sentiment, CAST(len(ws) AS INTEGER) AS summary_words,
    CAST(len(ws) - len(list_intersect(ws, {tokens('"Content"')})) AS INTEGER)
      AS unsupported_words FROM words
),
shared AS (
  SELECT *, CASE WHEN summary_words > 0 THEN unsupported_words / summary_words ELSE 0.0 END
    AS unsupported_share FROM claims
)
"""

ORACLES |= {
    "unsupported_claims": twin(
        """
SELECT row_id, summary_words, unsupported_words, round(unsupported_share, 6) AS unsupported_share
FROM shared
""",
        *PLAIN[:-1], CLAIMS,
    ),
    "unsupported_by_class": twin(
        """
SELECT reference_sentiment, count(*) AS rows,
  round(avg(unsupported_share), 6) AS mean_unsupported_share,
  count(*) FILTER (unsupported_words > 0) AS rows_with_unsupported
FROM shared GROUP BY reference_sentiment
""",
        *PLAIN[:-1], CLAIMS,
    ),
    "review_queue": twin(
        """
SELECT reference_sentiment, CAST(rank AS INTEGER) AS rank, index, predicted_sentiment, rouge_l_f1
FROM (SELECT *, row_number() OVER (PARTITION BY reference_sentiment
    ORDER BY predicted_sentiment IS NOT NULL, rouge_l_f1, index) AS rank
  FROM (SELECT * REPLACE (round(rouge_l_f1, 6) AS rouge_l_f1) FROM records))
WHERE rank <= 20
""",
        *FULL,
    ),
    "compare_runs": twin(
        """
SELECT metric, round(before, 6) AS before, round(after, 6) AS after, common_rows, only_before,
  only_after, round(after - before, 6) AS delta, after < before - 0.001 AS regressed
FROM totals, LATERAL (VALUES ('sentiment_accuracy', acc_a, acc_b),
  ('sentiment_parse_rate', sent_a, sent_b), ('summary_parse_rate', sum_a, sum_b),
  ('mean_rouge_l_f1', rouge_a, rouge_b)) AS v(metric, before, after)
""",
        *FULL,
        f"""
firsts AS (
  SELECT * FROM articles
  QUALIFY row_number() OVER (PARTITION BY {fingerprint('"Content"')} ORDER BY row_id) = 1
),
later AS (SELECT c.* FROM cleaned c JOIN firsts f ON f.row_id = c.row_id)
""",
        responses(name="responses2", shift=3), parsed("responses2", "parsed2"),
        records("later", answers="parsed2", name="records2", prefix="z_"),
        """
sides AS (
  SELECT a.index AS ia, b.index AS ib,
    CAST(a.reference_sentiment IS NOT DISTINCT FROM a.predicted_sentiment AS INTEGER) AS acc_a,
    CAST(b.reference_sentiment IS NOT DISTINCT FROM b.predicted_sentiment AS INTEGER) AS acc_b,
    CAST(a.predicted_sentiment IS NOT NULL AS INTEGER) AS sent_a,
    CAST(b.predicted_sentiment IS NOT NULL AS INTEGER) AS sent_b,
    CAST(a.predicted_summary IS NOT NULL AS INTEGER) AS sum_a,
    CAST(b.predicted_summary IS NOT NULL AS INTEGER) AS sum_b,
    a.rouge_l_f1 AS rouge_a, b.rouge_l_f1 AS rouge_b
  FROM records a FULL JOIN records2 b ON a.index = b.index
),
counts AS (
  SELECT count(*) FILTER (ia IS NOT NULL AND ib IS NOT NULL) AS common_rows,
    count(*) FILTER (ib IS NULL) AS only_before, count(*) FILTER (ia IS NULL) AS only_after
  FROM sides
),
totals AS (
  SELECT counts.*, m.* FROM counts, (SELECT avg(acc_a) AS acc_a, avg(acc_b) AS acc_b,
    avg(sent_a) AS sent_a, avg(sent_b) AS sent_b, avg(sum_a) AS sum_a, avg(sum_b) AS sum_b,
    avg(rouge_a) AS rouge_a, avg(rouge_b) AS rouge_b
    FROM sides WHERE ia IS NOT NULL AND ib IS NOT NULL) m
)
""",
    ),
    "config_diff": config_diff(RESUME_KEYS),
    "config_diff_evaluation": config_diff(EVALUATION_KEYS),
    "fingerprint_drift": twin(
        """
SELECT run_id, fingerprint, saved, current FROM (
  SELECT m.run_id, 'train_fingerprint' AS fingerprint, s.train_fingerprint AS saved,
    m.train_fingerprint AS current
  FROM manifests m JOIN pairs p ON p.current_run = m.run_id
  JOIN manifests s ON s.run_id = p.saved_run
  UNION ALL
  SELECT m.run_id, 'eval_fingerprint', s.eval_fingerprint, m.eval_fingerprint
  FROM manifests m JOIN pairs p ON p.current_run = m.run_id
  JOIN manifests s ON s.run_id = p.saved_run)
WHERE saved IS DISTINCT FROM current
""",
        MANIFESTS,
    ),
    "release_readiness": twin(
        """
SELECT run_id, bool_and(minimum IS NOT NULL AND coalesce(value, -1) >= minimum) AS ready,
  coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (minimum IS NULL), '')
    AS unset_thresholds,
  coalesce(string_agg(metric, ',' ORDER BY metric)
    FILTER (coalesce(value, -1) < minimum), '') AS failed_metrics
FROM judged GROUP BY run_id
""",
        MANIFESTS,
        """
averages AS (
  SELECT 'run-' || l_orderkey AS run_id, round(1 - avg(l_discount), 6) AS a,
    round(1 - avg(l_tax), 6) AS p, round(avg(l_quantity) / 50, 6) AS r
  FROM lineitem GROUP BY l_orderkey
),
judged AS (
  SELECT m.run_id, v.metric, v.value, v.minimum
  FROM manifests m LEFT JOIN averages x ON x.run_id = m.run_id,
  LATERAL (VALUES
    ('sentiment_accuracy', x.a, CASE WHEN m.priority = '1-URGENT' THEN 0.96 ELSE 0.93 END),
    ('sentiment_parse_rate', x.p, 0.95),
    ('mean_rouge_l_f1', x.r, CASE WHEN m.priority <> '4-NOT SPECIFIED' THEN 0.5 END))
    AS v(metric, value, minimum)
  WHERE m.status = 'completed'
)
""",
    ),
    "run_status_summary": twin(
        """
SELECT status, count(*) AS runs, count(seconds) AS ended, min(seconds) AS min_seconds,
  round(avg(seconds), 6) AS mean_seconds, max(seconds) AS max_seconds,
  status = 'completed' AS evaluable FROM manifests GROUP BY status
""",
        MANIFESTS,
    ),
    "class_drift": twin(
        """
SELECT any_value(en) AS expected_rows, any_value(onn) AS observed_rows,
  (SELECT round(1 - count(predicted_sentiment) / count(*), 6) FROM parsed) AS unlabelled_share,
  round(sum(abs(p - q)) / 2, 6) AS total_variation,
  round(sum((greatest(q, 0.0001) - greatest(p, 0.0001))
    * ln(greatest(q, 0.0001) / greatest(p, 0.0001))), 6) AS stability_index
FROM (
  SELECT label, en, onn,
    (SELECT count(*) FROM cleaned WHERE "Sentiment" = label) / en AS p,
    (SELECT count(*) FROM parsed WHERE predicted_sentiment = label) / onn AS q
  FROM (SELECT unnest(['Negative', 'Neutral', 'Positive']) AS label),
    (SELECT count(*) AS en FROM cleaned),
    (SELECT count(predicted_sentiment) AS onn FROM parsed))
""",
        ARTICLES, CLEANED, responses(), parsed(),
    ),
    "stream_parse_failures": twin(
        """
SELECT date_trunc('day', event_time) AS window_start, count(*) AS rows,
  count(*) - count(predicted) AS failures,
  round((count(*) - count(predicted)) / count(*), 6) AS failure_rate
FROM log GROUP BY 1
""",
        LOG,
    ),
    "stream_class_mix": twin(
        """
SELECT window_start, predicted, rows,
  round(rows / sum(rows) OVER (PARTITION BY window_start), 6) AS share
FROM (
  SELECT window_start, coalesce(predicted, 'UNPARSED') AS predicted, count(*) AS rows
  FROM (SELECT predicted, unnest([date_trunc('day', event_time),
    date_trunc('day', event_time) - INTERVAL 1 DAY]) AS window_start FROM log)
  GROUP BY ALL)
""",
        LOG,
    ),
    "stream_latency": twin(
        """
SELECT date_trunc('day', event_time) AS window_start, count(latency_ms) AS rows,
  round(avg(latency_ms), 6) AS mean_ms, max(latency_ms) AS max_ms, true AS p95_in_rank
FROM log GROUP BY 1
""",
        LOG,
    ),
    "stream_dedup": twin(
        "SELECT event_time, key, user_id, latency_ms, predicted FROM log", LOG
    ),
    "stream_sessions": twin(
        """
SELECT user_id, min(event_time) AS burst_start, max(event_time) + INTERVAL 6 HOUR AS burst_end,
  count(*) AS failures
FROM (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY event_time, key) AS burst
  FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (
      PARTITION BY user_id ORDER BY event_time, key) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS starts
    FROM log WHERE predicted IS NULL))
GROUP BY user_id, burst
""",
        LOG,
    ),
    "stream_late_data": twin(
        """
SELECT window_start, coalesce(count(*) FILTER (NOT late), 0) AS rows,
  CASE WHEN count(*) FILTER (NOT late) > 0 THEN count(*) FILTER (NOT late AND predicted IS NULL) END AS failures,
  round(count(*) FILTER (NOT late AND predicted IS NULL) / nullif(count(*) FILTER (NOT late), 0), 6) AS failure_rate,
  count(*) FILTER (late) AS late_rows
FROM (
  SELECT date_trunc('day', event_time) AS window_start, predicted,
    coalesce(date_trunc('day', event_time) + INTERVAL 1 DAY <= reach - INTERVAL 1 HOUR, false) AS late
  FROM arriving LEFT JOIN (
    SELECT l.load, max(a.event_time) AS reach FROM (SELECT DISTINCT load FROM arriving) l
    JOIN arriving a ON a.load < l.load GROUP BY l.load) USING (load))
GROUP BY 1
""",
        LOG,
        """
arriving AS (
  SELECT *, least(3, (date_diff('day', DATE '2024-01-01', CAST(event_time AS DATE))
    + CASE WHEN key % 23 = 0 THEN 3 ELSE 0 END) // 8) AS load
  FROM log
)
""",
    ),
    "stream_latency_rollup": twin(
        """
SELECT date_trunc('week', event_time) AS window_start,
  count(DISTINCT date_trunc('day', event_time)) AS windows, CAST(count(latency_ms) AS BIGINT) AS rows,
  max(latency_ms) AS max_ms, true AS p95_in_rank
FROM log GROUP BY 1
""",
        LOG,
    ),
}

ORACLES["run_registry_in_parts"] = ORACLES["run_registry"]
