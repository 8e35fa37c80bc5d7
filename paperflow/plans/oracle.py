"""DuckDB SQL for every E-checked key. The stand-in tables are CTEs over the
driver's pre-registered views; each query body is written independently of the
Spark code (plain SQL, windows and joins), so the check compares two engines."""

from __future__ import annotations

from paperflow import params as _P
from paperflow.functions import sections as _SEC
from paperflow.functions.text import PROMPT_TEMPLATE as _TPL
from paperflow.operators.search import AI_KEYWORDS as _KW

STANDINS = r"""
papers0 AS (
  SELECT doc_id, text, lang, source,
         timestamp '2024-01-01 00:00:00' + to_days(CAST(doc_id % 60 AS INTEGER))
           + to_minutes(CAST((doc_id * 37) % 1440 AS INTEGER)) AS ts
  FROM documents),
papers AS (
  SELECT doc_id AS id,
         concat('2401.', lpad(CAST(doc_id AS VARCHAR), greatest(6, length(CAST(doc_id AS VARCHAR)))::INT, '0'), 'v1') AS arxiv_id,
         split_part(text, chr(10), 1) AS title,
         text AS abstract,
         list_transform(range(1, 2 + doc_id % 5), lambda i: concat('Author ', CAST(i AS VARCHAR))) AS authors,
         list_value(lang, source) AS categories,
         CASE WHEN doc_id % 9 = 0 THEN CAST([] AS VARCHAR[])
              ELSE list_value(lang, concat('NATION_', substr(source, 4))) END AS categories_name,
         ts AS published_date,
         ts AS updated_date,
         CASE WHEN doc_id % 7 = 0 THEN NULL ELSE concat('http://files.example/pdf/', CAST(doc_id AS VARCHAR)) END AS pdf_url,
         concat('http://files.example/abs/', CAST(doc_id AS VARCHAR)) AS abstract_url,
         ts + INTERVAL 1 DAY AS extracted_at,
         ts + INTERVAL 1 DAY AS created_at
  FROM papers0),
summaries AS (
  SELECT l.doc_id * 3 + 7 AS id, l.doc_id AS arxiv_paper_id,
         concat('2401.', lpad(CAST(l.doc_id AS VARCHAR), greatest(6, length(CAST(l.doc_id AS VARCHAR)))::INT, '0'), 'v1') AS arxiv_id,
         substr(d.text, 1, n * 5 // 100) AS beginner_title,
         substr(d.text, n * 5 // 100 + 1, n * 10 // 100 - n * 5 // 100) AS intermediate_title,
         substr(d.text, n * 10 // 100 + 1, n * 25 // 100 - n * 10 // 100) AS beginner_overview,
         substr(d.text, n * 25 // 100 + 1, n * 40 // 100 - n * 25 // 100) AS intermediate_overview,
         substr(d.text, n * 40 // 100 + 1, n * 70 // 100 - n * 40 // 100) AS beginner_summary,
         substr(d.text, n * 70 // 100 + 1) AS intermediate_summary,
         CASE WHEN l.toxic = 1 THEN 'error' ELSE 'completed' END AS processing_status,
         CASE WHEN l.toxic = 1 THEN 'flagged by moderation' END AS processing_error,
         'stub-model' AS model_name,
         timestamp '2024-03-01 00:00:00' + to_hours(CAST(l.doc_id % 100 AS INTEGER)) AS created_at,
         timestamp '2024-03-01 00:00:00' + to_hours(CAST(l.doc_id % 100 AS INTEGER)) AS updated_at
  FROM labels l JOIN (SELECT doc_id, text, length(text) AS n FROM documents) d ON l.doc_id = d.doc_id),
taxonomy AS (
  SELECT concat('src', CAST(n_nationkey AS VARCHAR)) AS category_code, n_name AS category_name FROM nation),
stored AS (SELECT * FROM papers WHERE published_date < timestamp '2024-02-01 00:00:00'),
pages_std AS (SELECT conv_id AS doc_id, turn AS page, text FROM conversations),
dirty AS (
  SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE concat('  ' || chr(9),
    replace(replace(replace(text, '. ', '. ' || chr(12288) || chr(160) || chr(8195) || ' '), ',', ',' || chr(7) || chr(1)),
            chr(10), chr(10) || chr(133) || chr(13) || chr(10)),
    chr(8203) || chr(31) || '  ') END AS text
  FROM documents),
responses AS (
  SELECT doc_id, concat(
    CASE WHEN doc_id % 8 = 7 THEN '**BEGINNER_TITLE:** ' ELSE 'BEGINNER_TITLE: ' END, substr(flat, 1, e1),
    chr(10) || chr(10) || 'INTERMEDIATE_TITLE: ', substr(flat, e1 + 1, e2 - e1),
    chr(10) || chr(10), CASE WHEN doc_id % 8 = 7 THEN 'beginner_overview: ' ELSE 'BEGINNER_OVERVIEW: ' END, substr(flat, e2 + 1, e3 - e2),
    chr(10) || chr(10), CASE WHEN doc_id % 8 = 4 THEN 'INTERMEDIATE OVERVIEW: ' ELSE 'INTERMEDIATE_OVERVIEW: ' END, substr(flat, e3 + 1, e4 - e3),
    chr(10) || chr(10), CASE WHEN doc_id % 8 = 6 THEN '' ELSE 'BEGINNER_SUMMARY: ' END, substr(flat, e4 + 1, e5 - e4),
    chr(10) || chr(10) || 'INTERMEDIATE_SUMMARY: ',
    CASE WHEN doc_id % 8 = 5 THEN substr(flat, e5 + 1, 40) || chr(10) || chr(10) || substr(flat, e5 + 41) ELSE substr(flat, e5 + 1) END
  ) AS response
  FROM (SELECT *, greatest(e1, n * 10 // 100) AS e2, greatest(e1, n * 25 // 100) AS e3, greatest(e1, n * 40 // 100) AS e4,
               greatest(e1, n * 70 // 100) AS e5
        FROM (SELECT doc_id, flat, n, CASE WHEN doc_id % 8 = 7 THEN least(n, 9) ELSE n * 5 // 100 END AS e1
              FROM (SELECT doc_id, replace(text, chr(10), ' ') AS flat, length(text) AS n FROM documents)))),
feed AS (
  SELECT arxiv_id, title, abstract, authors, categories, categories_name, published_date, updated_date, pdf_url, abstract_url
  FROM papers
  UNION ALL
  SELECT arxiv_id, title || ' [rev]', abstract, authors, categories, categories_name, published_date,
         updated_date + INTERVAL 1 DAY, pdf_url, abstract_url
  FROM papers WHERE id % 4 = 0),
feed_dedup AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY arxiv_id ORDER BY updated_date DESC, abstract_url) AS rk FROM feed)
  WHERE rk = 1),
fresh AS (SELECT f.* FROM feed_dedup f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.arxiv_id = f.arxiv_id)),
fresh_ids AS (
  SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY published_date, arxiv_id) AS id, * FROM fresh),
deleted AS (SELECT id FROM papers WHERE pdf_url IS NULL),
old_summaries AS (
  SELECT id, arxiv_paper_id, arxiv_id,
         CASE WHEN id % 6 = 0 THEN '' WHEN id % 6 = 1 THEN NULL ELSE beginner_title END AS easy_title,
         CASE WHEN id % 7 = 0 THEN '' WHEN id % 7 = 1 THEN NULL ELSE beginner_summary END AS layman_summary,
         intermediate_summary AS university_summary, processing_status, created_at
  FROM summaries),
migrated AS (
  SELECT id,
         CASE WHEN easy_title IS NULL OR easy_title = '' THEN 'Beginner title pending regeneration' ELSE easy_title END AS beginner_title,
         'Intermediate title pending regeneration' AS intermediate_title,
         'Overview pending regeneration' AS beginner_overview,
         'Overview pending regeneration' AS intermediate_overview,
         layman_summary AS beginner_summary, university_summary AS intermediate_summary
  FROM old_summaries),
queue AS (
  SELECT p.id, p.arxiv_id, p.title, p.abstract, p.pdf_url, p.published_date
  FROM papers p LEFT JOIN summaries s ON p.id = s.arxiv_paper_id
  WHERE s.id IS NULL AND p.pdf_url IS NOT NULL)
"""


def with_standins(body: str) -> str:
    return "WITH " + STANDINS.strip() + "\n" + body.strip()


Q: dict[str, str] = {}

Q["papers_needing_summaries"] = """
SELECT id, arxiv_id, title, abstract, pdf_url, published_date FROM queue
"""

Q["queue_head"] = """
SELECT id, arxiv_id, title, abstract, pdf_url, published_date FROM queue
ORDER BY published_date DESC, id DESC LIMIT 15
"""

Q["queue_depth"] = "SELECT count(*) AS remaining FROM queue"

Q["papers_with_summaries"] = """
SELECT ap.id AS paper_id, ap.arxiv_id, ap.title AS original_title, ap.abstract,
       array_to_string(ap.authors, '|') AS authors, array_to_string(ap.categories, '|') AS categories,
       array_to_string(ap.categories_name, '|') AS categories_name, ap.published_date, ap.pdf_url,
       sp.beginner_title, sp.intermediate_title, sp.beginner_overview, sp.intermediate_overview,
       sp.beginner_summary, sp.intermediate_summary, sp.processing_status, sp.model_name,
       sp.created_at AS summary_created_at
FROM papers ap LEFT JOIN summaries sp ON ap.id = sp.arxiv_paper_id
"""

Q["latest_summaries"] = """
SELECT s.id, s.arxiv_paper_id, s.arxiv_id, s.beginner_title, s.intermediate_title,
       s.beginner_overview, s.intermediate_overview, s.beginner_summary, s.intermediate_summary,
       s.processing_status, s.model_name, s.created_at,
       p.title AS paper_title, array_to_string(p.authors, '|') AS paper_authors,
       array_to_string(p.categories_name, '|') AS paper_categories_name,
       p.published_date AS paper_published_date, p.pdf_url AS paper_pdf_url, p.abstract_url AS paper_abstract_url
FROM summaries s JOIN papers p ON p.id = s.arxiv_paper_id
WHERE s.processing_status = 'completed'
ORDER BY s.created_at DESC, s.id DESC LIMIT 5
"""

_TRUNC = "CASE WHEN {c} IS NULL OR {c} = '' THEN '' WHEN length({c}) > {n} THEN substr({c}, 1, {n}) || '...' ELSE {c} END"


def _t(c: str, n: int) -> str:
    return _TRUNC.format(c=c, n=n)


_EXPORT = f"""
SELECT coalesce(p.arxiv_id, '') AS arxiv_id,
       {_t('p.title', 100)} AS original_title,
       {_t('s.beginner_title', 100)} AS beginner_title,
       {_t('s.intermediate_title', 100)} AS intermediate_title,
       coalesce(strftime(p.published_date, '%Y-%m-%d'), '') AS published_date,
       array_to_string(p.authors[1:3], ', ') || CASE WHEN len(p.authors) > 3 THEN ' et al.' ELSE '' END AS authors,
       array_to_string(p.categories_name[1:3], ', ') AS categories,
       {_t('s.beginner_overview', 200)} AS beginner_overview,
       {_t('s.intermediate_overview', 200)} AS intermediate_overview,
       {_t('s.beginner_summary', 500)} AS beginner_summary,
       {_t('s.intermediate_summary', 500)} AS intermediate_summary,
       {_t('p.abstract', 500)} AS abstract,
       coalesce(p.pdf_url, '') AS pdf_url,
       coalesce(p.abstract_url, '') AS arxiv_url,
       coalesce(strftime(s.created_at, '%Y-%m-%d %H:%M'), '') AS processing_date
FROM {{source}} s JOIN papers p ON p.id = s.arxiv_paper_id
WHERE s.processing_status = 'completed'
ORDER BY s.created_at DESC, s.id DESC LIMIT 5
"""
Q["export_latest"] = _EXPORT.format(source="summaries")

_PAPER_COLS = """id, arxiv_id, title, abstract, array_to_string(authors, '|') AS authors,
       array_to_string(categories, '|') AS categories, array_to_string(categories_name, '|') AS categories_name,
       published_date, updated_date, pdf_url, abstract_url"""

Q["recent_papers"] = f"""
SELECT {_PAPER_COLS} FROM papers
WHERE published_date >= timestamp '2024-02-20 00:00:00' - INTERVAL 30 DAY
"""

Q["papers_by_category"] = """
SELECT category_name, category_id, count(*) AS paper_count, max(published_date) AS latest_paper
FROM (SELECT unnest(categories_name) AS category_name, unnest(categories) AS category_id, published_date FROM papers)
GROUP BY category_name, category_id
"""

Q["papers_by_category_name"] = """
SELECT category_name, count(*) AS paper_count, max(published_date) AS latest_paper
FROM (SELECT unnest(categories_name) AS category_name, published_date FROM papers)
GROUP BY category_name
"""

Q["taxonomy_dim"] = """
SELECT category_code, min(category_name) AS category_name, count(*) AS n_rows FROM taxonomy GROUP BY category_code
"""

# Position-wise lookup: explode with ordinality, left join the dimension, re-aggregate in order.
_TRANSLATED = """
translated AS (
  SELECT p.id, string_agg(CASE WHEN t.category_code IS NOT NULL THEN t.category_name ELSE x.code END, '|' ORDER BY x.pos) AS names,
         count(*) AS n_names
  FROM (SELECT id, unnest(categories) AS code, unnest(range(1, len(categories) + 1)) AS pos FROM papers) x
  JOIN papers p ON p.id = x.id
  LEFT JOIN (SELECT category_code, min(category_name) AS category_name FROM taxonomy GROUP BY category_code) t
    ON t.category_code = x.code
  GROUP BY p.id)
"""

Q["translate_categories"] = f"""
, {_TRANSLATED.strip()}
SELECT p.id, array_to_string(p.categories, '|') AS categories, coalesce(t.names, '') AS translated,
       CAST(len(p.categories) AS BIGINT) AS n_codes
FROM papers p LEFT JOIN translated t ON t.id = p.id
"""

Q["needs_names"] = """
SELECT id, array_to_string(categories, '|') AS categories FROM papers
WHERE categories_name IS NULL OR len(categories_name) = 0
"""

Q["backfill_names"] = f"""
, {_TRANSLATED.strip()}
SELECT p.id,
       (p.categories_name IS NULL OR len(p.categories_name) = 0) AND len(p.categories) > 0 AS names_filled,
       CASE WHEN (p.categories_name IS NULL OR len(p.categories_name) = 0) AND len(p.categories) > 0
            THEN t.names ELSE array_to_string(p.categories_name, '|') END AS categories_name
FROM papers p LEFT JOIN translated t ON t.id = p.id
"""


# --- search and dates ------------------------------------------------------


def _ts(x) -> str:
    return f"timestamp '{x:%Y-%m-%d %H:%M:%S}'"


def _day(x) -> str:
    return f"DATE '{x:%Y-%m-%d}'"


_codes = ", ".join(f"'{c}'" for c in _P.SEARCH_CODES)
Q["search_papers"] = f"""
SELECT id, arxiv_id, array_to_string(categories, '|') AS categories, published_date FROM papers
WHERE list_has_any(categories, [{_codes}])
  AND published_date >= {_ts(_P.SEARCH_START)} AND published_date < {_ts(_P.SEARCH_END)} + INTERVAL 1 MINUTE
"""

Q["papers_on_day"] = f"""
SELECT id, arxiv_id, published_date FROM papers WHERE CAST(published_date AS DATE) = {_day(_P.SAMPLE_DAY)}
"""

Q["papers_in_range"] = f"""
SELECT id, arxiv_id, published_date FROM papers
WHERE CAST(published_date AS DATE) BETWEEN {_day(_P.AS_OF)} - 1 - {_P.TEST_DAYS_BACK} AND {_day(_P.AS_OF)} - 1
"""

Q["target_day"] = """
SELECT strftime(d, '%Y-%m-%d') AS run_day, CAST(isodow(d) - 1 AS BIGINT) AS weekday,
       strftime(d - CASE WHEN isodow(d) = 1 THEN 3 ELSE 1 END, '%Y-%m-%d') AS target_day
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
"""

Q["day_bounds"] = """
SELECT strftime(d, '%Y-%m-%d') AS day, strftime(d, '%Y%m%d') || '0000' AS start_bound,
       strftime(d, '%Y%m%d') || '2359' AS end_bound
FROM (SELECT DISTINCT CAST(published_date AS DATE) AS d FROM papers)
"""

Q["is_on_day"] = f"""
SELECT id, published,
       coalesce(CAST(try_strptime(published, '%Y-%m-%dT%H:%M:%SZ') AS DATE) = {_day(_P.SAMPLE_DAY)}, false) AS is_on_day
FROM (SELECT id, CASE WHEN id % 11 = 0 THEN strftime(published_date, '%Y/%m/%d %H:%M:%S')
                      ELSE strftime(published_date, '%Y-%m-%dT%H:%M:%SZ') END AS published FROM papers)
"""

# --- text ------------------------------------------------------------------

# Python's \s for str patterns, in RE2 terms.
PY_SPACE = r"[\t\n\v\f\r\x1c-\x1f\x85\p{Z}]"


def clean(x: str) -> str:
    return (f"coalesce(trim(regexp_replace(regexp_replace({x}, '[\\x00-\\x08\\x0b-\\x0c\\x0e-\\x1f\\x7f-\\x9f]', '', 'g'), "
            f"'{PY_SPACE}+', ' ', 'g')), '')")


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_SPACE}+|{PY_SPACE}+$', '', 'g')"


Q["url_tail"] = "SELECT page_id, replace(string_split(url, '/')[-1], 'abs/', '') AS tail FROM pages"

Q["truncate_text"] = f"""
SELECT doc_id, {_t('text', 100)} AS t100, {_t('text', 200)} AS t200, {_t('text', 500)} AS t500 FROM documents
"""

Q["author_label"] = """
SELECT id, array_to_string(authors[1:3], ', ') || CASE WHEN len(authors) > 3 THEN ' et al.' ELSE '' END AS authors FROM papers
"""

Q["clean_text"] = f"""
SELECT doc_id, {clean('text')} AS text, CAST(length({clean('text')}) AS BIGINT) AS n_chars FROM dirty
"""

Q["ascii_only"] = "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7e]', '', 'g') AS text FROM documents"


_kw = ", ".join(f"'{k}'" for k in _KW)
Q["keyword_match"] = f"""
SELECT id, CAST(n AS BIGINT) AS n_keywords, n > 0 AS is_ai
FROM (SELECT id, len(list_filter([{_kw}], lambda k: contains(lower(concat_ws(' ', title, abstract)), k))) AS n FROM papers)
"""

_ASSEMBLED = f"""
assembled AS (
  SELECT doc_id, nullif({clean("string_agg(c, chr(10) ORDER BY page) FILTER (WHERE c <> '')")}, '') AS text
  FROM (SELECT doc_id, page, {clean('text')} AS c FROM pages_std WHERE page < 10)
  GROUP BY doc_id)
"""

Q["assemble_pages"] = f"""
, {_ASSEMBLED.strip()}
SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n_chars FROM assembled
"""


_tpl = _TPL.replace("'", "''")
Q["model_input"] = f"""
, {_ASSEMBLED.strip()}
SELECT p.id, printf('{_tpl}', {clean('p.title')}, {clean('p.abstract')}, substr({clean('a.text')}, 1, 15000)) AS prompt
FROM papers p LEFT JOIN assembled a ON a.doc_id = p.id
"""

# --- sections --------------------------------------------------------------


def _re2(p: str, flags: str) -> str:
    body = p.replace("(?=", "(?:").replace("\\s", PY_SPACE)
    return ("(?" + flags + ")" + body).replace("'", "''")


def _fold_sql(cands) -> str:
    first = [f"CASE WHEN {m} AND length({x}) > 10 THEN {x} END" for m, x in cands]
    last = [f"CASE WHEN {m} THEN {x} END" for m, x in reversed(cands)]
    return "coalesce(" + ", ".join(first + last) + ")"


def _sections_sql() -> str:
    cols, folds = [], {}
    for fi, f in enumerate(_SEC.FIELDS):
        cands = []
        for pi, p in enumerate(_SEC.PATTERNS[f]):
            pat = _re2(p, "is")
            cols.append(f"regexp_matches(r, '{pat}') AS m_{fi}_{pi}")
            cols.append(f"{strip(f"regexp_extract(r, '{pat}', 1)")} AS x_{fi}_{pi}")
            cands.append((f"m_{fi}_{pi}", f"x_{fi}_{pi}"))
        folds[f] = _fold_sql(cands)
    hdr = _re2(_SEC.OVERVIEW_HEADER, "s")
    alts = []
    for ai, p in enumerate(_SEC.OVERVIEW_FALLBACKS):
        pat = _re2(p, "is")
        cols.append(f"regexp_matches(r, '{pat}') AS am_{ai}")
        cols.append(f"{strip(f"regexp_extract(r, '{pat}', 1)")} AS ax0_{ai}")
        alts.append(ai)
    alt_x = []
    for ai in alts:
        x = f"ax0_{ai}"
        alt_x.append((f"am_{ai}", f"(CASE WHEN (starts_with({x}, 'INTERMEDIATE') OR starts_with({x}, 'Intermediate')) "
                                  f"AND regexp_matches({x}, '{hdr}') THEN {strip(f"regexp_extract({x}, '{hdr}', 1)")} ELSE {x} END)"))
    io = folds["intermediate_overview"]
    folds["intermediate_overview"] = (f"CASE WHEN ({io}) IS NULL OR ({io}) = '' THEN coalesce({_fold_sql(alt_x)}, {io}) ELSE {io} END")
    cand_cte = f"cands AS (SELECT doc_id, {', '.join(cols)} FROM (SELECT doc_id, {strip('response')} AS r FROM responses))"
    fields = ", ".join(f"{folds[f]} AS {f}" for f in _SEC.FIELDS)
    valid = " AND ".join(f"coalesce(length({f}) >= 10, false)" for f in _SEC.FIELDS)
    return (f", {cand_cte},\nparsed AS (SELECT doc_id, {fields} FROM cands),\n"
            f"checked AS (SELECT *, {valid} AS is_valid FROM parsed)\n")


_SECTIONS = _sections_sql()
Q["parse_sections"] = _SECTIONS + "SELECT doc_id, " + ", ".join(_SEC.FIELDS) + " FROM checked"
Q["valid_sections"] = _SECTIONS + "SELECT doc_id, is_valid, " + ", ".join(
    f"CASE WHEN is_valid THEN {f} END AS {f}" for f in _SEC.FIELDS) + " FROM checked"


# --- ingest and numbering --------------------------------------------------

Q["new_papers"] = "SELECT f.arxiv_id, f.title FROM feed f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.arxiv_id = f.arxiv_id)"

Q["existing_papers"] = "SELECT s.arxiv_id FROM stored s WHERE s.arxiv_id IN (SELECT arxiv_id FROM feed)"

Q["distinct_keys"] = "SELECT DISTINCT arxiv_id FROM (SELECT arxiv_id FROM stored UNION ALL SELECT arxiv_id FROM feed)"

Q["assign_ids"] = "SELECT arxiv_id, id FROM fresh_ids"

Q["ingest_result"] = """
SELECT id, arxiv_id, title, published_date, updated_date, extracted_at, created_at FROM stored
UNION ALL
SELECT id, arxiv_id, title, published_date, updated_date, timestamp '2024-06-01 12:30:00', timestamp '2024-06-01 12:30:00'
FROM fresh_ids
"""

Q["batch_plan"] = f"""
SELECT id, rn, (rn - 1) // {_P.QUEUE_LIMIT} AS batch_no
FROM (SELECT id, row_number() OVER (ORDER BY published_date DESC, id DESC) AS rn FROM queue)
"""

Q["run_counts"] = f"""
SELECT 'kept' AS metric, CAST(count_if(CAST(published_date AS DATE) = {_day(_P.SAMPLE_DAY)}) AS BIGINT) AS value FROM feed_dedup
UNION ALL
SELECT 'filtered_out', CAST(count_if(CAST(published_date AS DATE) <> {_day(_P.SAMPLE_DAY)}) AS BIGINT) FROM feed_dedup
UNION ALL
SELECT 'inserted', count(*) FROM fresh WHERE CAST(published_date AS DATE) = {_day(_P.SAMPLE_DAY)}
UNION ALL
SELECT 'names_filled', count(*) FROM stored
WHERE (categories_name IS NULL OR len(categories_name) = 0) AND len(categories) > 0
UNION ALL
SELECT 'summarized', CAST(count_if(CAST(created_at AS DATE) = DATE '2024-03-02' AND processing_status = 'completed') AS BIGINT) FROM summaries
"""

Q["success_rate"] = """
SELECT run_day, attempted, completed, attempted - completed AS failed,
       CASE WHEN attempted > 0 THEN CAST((2000 * completed + attempted) // (2 * attempted) AS DOUBLE) / 10 END AS success_rate
FROM (SELECT strftime(created_at, '%Y-%m-%d') AS run_day, count(*) AS attempted,
             CAST(count_if(processing_status = 'completed') AS BIGINT) AS completed
      FROM summaries GROUP BY 1)
"""

# --- audits, delete, migration ---------------------------------------------

Q["cascade_delete"] = "SELECT id, arxiv_paper_id FROM summaries WHERE arxiv_paper_id NOT IN (SELECT id FROM deleted)"

Q["audit_orphans"] = """
SELECT s.id, s.arxiv_paper_id FROM summaries s
WHERE NOT EXISTS (SELECT 1 FROM papers p WHERE p.id = s.arxiv_paper_id AND p.id NOT IN (SELECT id FROM deleted))
"""

Q["audit_unique"] = """
SELECT 'feed.arxiv_id' AS check_name, arxiv_id AS key, count(*) AS n_rows FROM feed GROUP BY arxiv_id HAVING count(*) > 1
UNION ALL
SELECT 'summaries.arxiv_paper_id', CAST(arxiv_paper_id AS VARCHAR), count(*) FROM summaries GROUP BY arxiv_paper_id HAVING count(*) > 1
"""

_NN_PAPERS = ["arxiv_id", "title", "abstract", "authors", "categories", "categories_name",
              "published_date", "updated_date", "abstract_url"]
Q["audit_not_null"] = "\nUNION ALL\n".join(
    [f"SELECT 'papers' AS table_name, '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM papers"
     for c in _NN_PAPERS]
    + [f"SELECT 'summaries', '{c}', CAST(count_if({c} IS NULL) AS BIGINT) FROM migrated" for c in _SEC.FIELDS])

_LEN = [("summaries", "arxiv_id", 50), ("summaries", "processing_status", 50), ("summaries", "model_name", 100),
        ("papers", "arxiv_id", 50)]
Q["audit_length"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({n} AS BIGINT) AS max_len, "
    f"CAST(count_if(length({c}) > {n}) AS BIGINT) AS n_over, CAST(max(length({c})) AS BIGINT) AS longest FROM {t}"
    for t, c, n in _LEN)

Q["audit_aligned"] = """
SELECT id, CAST(len(categories) AS BIGINT) AS n_codes, CAST(len(categories_name) AS BIGINT) AS n_names
FROM papers WHERE len(categories) <> len(categories_name)
"""

Q["migrate_summaries"] = "SELECT id, " + ", ".join(_SEC.FIELDS) + " FROM migrated"

Q["pending_regen"] = """
SELECT id, beginner_overview, intermediate_overview FROM (
  SELECT id,
    CASE WHEN bo IS NULL OR bo = '' THEN 'Overview pending regeneration' ELSE bo END AS beginner_overview,
    CASE WHEN io IS NULL OR io = '' THEN 'Overview pending regeneration' ELSE io END AS intermediate_overview
  FROM (SELECT id, CASE WHEN id % 5 = 0 THEN '' ELSE beginner_overview END AS bo,
               CASE WHEN id % 5 = 1 THEN NULL ELSE intermediate_overview END AS io FROM summaries))
WHERE beginner_overview = 'Overview pending regeneration' OR intermediate_overview = 'Overview pending regeneration'
"""

# --- rates -----------------------------------------------------------------

Q["trailing_rate"] = """
SELECT event_id, user_id, ts, n_window, n_window > 15 AS throttled,
       CASE WHEN n_window > 15 THEN CAST(60000000 - age AS DOUBLE) / 1000000.0 ELSE 0.0 END AS wait_s
FROM (SELECT event_id, user_id, ts, count(*) OVER w AS n_window,
             epoch_us(ts) - min(epoch_us(ts)) OVER w AS age
      FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW))
"""

Q["requests_per_minute"] = """
SELECT date_trunc('minute', ts) AS window_start, user_id, count(*) AS n_requests FROM events GROUP BY ALL
"""


# Streaming form: a minute is emitted once the watermark (latest event - 1 minute) has
# passed its end.
Q["requests_per_minute_stream"] = """
SELECT window_start, user_id, n_requests FROM (
  SELECT date_trunc('minute', ts) AS window_start, user_id, count(*) AS n_requests FROM events GROUP BY 1, 2)
WHERE window_start + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE
"""

# --- feed files --------------------------------------------------------------

_ENTRY = "'http://files.example/abs/' || arxiv_id"
Q["feed_scan"] = f"""
SELECT {_ENTRY} AS entry_id, {strip('title')} AS title, {strip('abstract')} AS summary,
       CASE WHEN id % 11 = 0 THEN strftime(published_date, '%Y/%m/%d %H:%M:%S')
            ELSE strftime(published_date, '%Y-%m-%dT%H:%M:%SZ') END AS published,
       CASE WHEN id % 5 = 0 THEN NULL ELSE strftime(published_date + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS updated,
       array_to_string(authors, '|') AS authors,
       CASE WHEN id % 13 = 0 THEN NULL ELSE array_to_string(categories, '|') END AS categories,
       pdf_url AS pdf_href
FROM papers
"""

Q["feed_to_papers"] = f"""
, {_TRANSLATED.strip()}
SELECT p.arxiv_id, {strip('p.title')} AS title, {strip('p.abstract')} AS abstract,
       array_to_string(p.authors, '|') AS authors,
       CASE WHEN p.id % 13 = 0 THEN '' ELSE array_to_string(p.categories, '|') END AS categories,
       CASE WHEN p.id % 13 = 0 THEN '' ELSE t.names END AS categories_name,
       p.published_date,
       CASE WHEN p.id % 5 = 0 THEN p.published_date ELSE p.published_date + INTERVAL 2 HOUR END AS updated_date,
       p.pdf_url, {_ENTRY} AS abstract_url
FROM papers p LEFT JOIN translated t ON t.id = p.id
WHERE p.id % 11 <> 0
"""

Q["feed_rejects"] = f"""
SELECT {_ENTRY} AS abstract_url, strftime(published_date, '%Y/%m/%d %H:%M:%S') AS raw_published,
       'bad published date' AS reason, true AS has_text, true AS has_file
FROM papers WHERE id % 11 = 0
UNION ALL SELECT 'http://files.example/abs/x2', NULL, 'entry is malformed', true, true
UNION ALL SELECT 'http://files.example/abs/x5', NULL, 'entry is cut off', true, true
"""

# One micro-batch (availableNow, no file cap): ids continue after the stored maximum.
Q["stream_ingest"] = """
SELECT id, arxiv_id, published_date, extracted_at, created_at, strftime(published_date, '%Y-%m-%d') AS published_day
FROM stored
UNION ALL
SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY published_date, arxiv_id), arxiv_id, published_date,
       timestamp '2024-06-01 12:30:00', timestamp '2024-06-01 12:30:00', strftime(published_date, '%Y-%m-%d')
FROM papers p WHERE p.id % 11 <> 0 AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.arxiv_id = p.arxiv_id)
"""

# --- model hook (deterministic offline stub), summary rows, drain --------------

_STUB = f"""
stub_in AS (SELECT id, arxiv_id, {clean('title')} AS t, {clean('abstract')} AS a FROM queue),
stub AS (
  SELECT id, arxiv_id, length(a) >= 200 AS ok,
         CAST(CASE WHEN length(a) < 200 THEN 3 WHEN length(t) % 4 = 0 THEN 2 WHEN length(t) % 4 = 1 THEN 3 ELSE 1 END AS BIGINT) AS attempts,
         {strip("'Plain words: ' || substr(t, 1, 40)")} AS beginner_title,
         {strip("'Technical: ' || substr(t, 1, 60)")} AS intermediate_title,
         {strip("'In short: ' || substr(a, 1, 120)")} AS beginner_overview,
         {strip("'In detail: ' || substr(a, 1, 160)")} AS intermediate_overview,
         {strip("'Summary: ' || substr(a, 1, 600)")} AS beginner_summary,
         {strip("'Details: ' || substr(a, 1, 900)")} AS intermediate_summary
  FROM stub_in),
batches AS (SELECT id, (row_number() OVER (ORDER BY published_date DESC, id DESC) - 1) // {_P.QUEUE_LIMIT} AS batch_no FROM queue)
"""

Q["summarize_stub"] = f"""
, {_STUB.strip()}
SELECT s.id, s.ok, s.attempts, b.batch_no FROM stub s JOIN batches b ON b.id = s.id
"""

Q["summary_rows"] = f"""
, {_STUB.strip()}
SELECT id AS arxiv_paper_id, arxiv_id, beginner_title, intermediate_title, beginner_overview, intermediate_overview,
       beginner_summary, intermediate_summary, 'completed' AS processing_status, 'echo-stub' AS model_name
FROM stub WHERE ok
"""

Q["drain_result"] = f"""
, {_STUB.strip()}
SELECT arxiv_paper_id, processing_status, 'stored' AS source, beginner_title, intermediate_summary FROM summaries
UNION ALL
SELECT id, 'completed', 'drained', beginner_title, intermediate_summary FROM stub WHERE ok
"""


Q["summary_error_rows"] = f"""
, {_STUB.strip()}
SELECT (SELECT max(id) FROM summaries) + row_number() OVER (ORDER BY id) AS id, id AS arxiv_paper_id, arxiv_id,
       CASE WHEN ok THEN beginner_title ELSE 'Error during processing' END AS beginner_title,
       CASE WHEN ok THEN intermediate_title ELSE 'Error during processing' END AS intermediate_title,
       CASE WHEN ok THEN beginner_overview ELSE 'Error during processing' END AS beginner_overview,
       CASE WHEN ok THEN intermediate_overview ELSE 'Error during processing' END AS intermediate_overview,
       CASE WHEN ok THEN beginner_summary ELSE 'Summary generation failed' END AS beginner_summary,
       CASE WHEN ok THEN intermediate_summary ELSE 'Summary generation failed' END AS intermediate_summary,
       CASE WHEN ok THEN 'completed' ELSE 'error' END AS processing_status,
       CASE WHEN NOT ok THEN 'invalid or empty response' END AS processing_error, 'echo-stub' AS model_name,
       timestamp '2024-06-01 12:30:00' AS created_at, timestamp '2024-06-01 12:30:00' AS updated_at
FROM stub
"""

# The drained rows are the newest: the largest ids among them, then stored ones if they are fewer than five.
Q["drain_then_export"] = f"""
, {_STUB.strip()},
every AS (
  SELECT id, arxiv_paper_id, beginner_title, intermediate_title, beginner_overview, intermediate_overview,
         beginner_summary, intermediate_summary, processing_status, created_at FROM summaries
  UNION ALL
  SELECT (SELECT max(id) FROM summaries) + row_number() OVER (ORDER BY id), id, beginner_title, intermediate_title,
         beginner_overview, intermediate_overview, beginner_summary, intermediate_summary, 'completed',
         timestamp '2024-06-01 12:30:00' FROM stub WHERE ok)
{_EXPORT.format(source="every")}
"""

Q["export_roundtrip"] = """
SELECT p.arxiv_id, strftime(p.published_date, '%Y-%m-%d') AS published_date,
       strftime(s.created_at, '%Y-%m-%d %H:%M') AS processing_date
FROM summaries s JOIN papers p ON p.id = s.arxiv_paper_id
WHERE s.processing_status = 'completed'
ORDER BY s.created_at DESC, s.id DESC LIMIT 5
"""

Q["search_page"] = f"""
SELECT id, arxiv_id, published_date FROM papers
WHERE list_has_any(categories, [{_codes}])
  AND published_date >= timestamp '2024-01-10 00:00:00' AND published_date < timestamp '2024-02-11 00:00:00'
ORDER BY published_date DESC, id DESC LIMIT 25 OFFSET 40
"""

Q["category_report"] = """
SELECT category_name, category_id, paper_count, latest_paper,
       row_number() OVER (ORDER BY paper_count DESC, category_name ASC NULLS FIRST, category_id ASC NULLS FIRST) AS position
FROM (SELECT category_name, category_id, count(*) AS paper_count, max(published_date) AS latest_paper
      FROM (SELECT unnest(categories_name) AS category_name, unnest(categories) AS category_id, published_date FROM papers)
      GROUP BY category_name, category_id)
"""

Q["view_heads"] = """
SELECT * FROM (SELECT 'recent_arxiv_papers' AS view_name, id, published_date FROM papers
               WHERE published_date >= timestamp '2024-01-21 00:00:00' ORDER BY published_date DESC, id DESC LIMIT 15)
UNION ALL
SELECT * FROM (SELECT 'v_papers_with_summaries', p.id, p.published_date
               FROM papers p LEFT JOIN summaries s ON s.arxiv_paper_id = p.id
               ORDER BY p.published_date DESC, p.id DESC LIMIT 15)
UNION ALL
SELECT * FROM (SELECT 'v_papers_needing_summaries', id, published_date FROM queue
               ORDER BY published_date DESC, id DESC LIMIT 15)
"""

Q["backfill_in_place"] = f"""
, {_TRANSLATED.strip()}
SELECT p.id, p.title, CASE WHEN len(p.categories_name) > 0 THEN array_to_string(p.categories_name, '|') ELSE t.names END
         AS categories_name, strftime(p.published_date, '%Y-%m-%d') AS published_day
FROM papers p LEFT JOIN translated t ON t.id = p.id
"""

Q["table_catalog"] = """
SELECT 'papers' AS table_name, false AS existed, true AS is_there, CAST(0 AS BIGINT) AS n_created, count(*) AS n_rows FROM stored
UNION ALL
SELECT 'summaries', false, true, CAST(0 AS BIGINT), count(*) FROM summaries
"""

Q["text_dates"] = """
SELECT id, CASE WHEN id % 6 = 4 THEN '' WHEN id % 6 = 5 THEN strftime(published_date, 'around %Y')
                ELSE strftime(published_date, '%Y-%m-%d') END AS day,
       CASE WHEN id % 6 = 4 THEN '' WHEN id % 6 = 5 THEN strftime(published_date, 'around %Y')
            WHEN id % 6 = 0 THEN strftime(published_date, '%Y-%m-%d 00:00')
            ELSE strftime(published_date, '%Y-%m-%d %H:%M') END AS minute
FROM papers
"""

# Of the four kinds of papers, those of kind 0 and 1 have an answer to their prompt (kind 1 after a timeout).
Q["resumed_drain"] = _SECTIONS.rstrip() + """,
kinds AS (
  SELECT q.id, q.id % 4 AS kind, c.*, q.id % 4 < 2 AND c.is_valid AS good
  FROM queue q JOIN checked c ON c.doc_id = q.id)
SELECT id, good AS ok, CAST(CASE WHEN NOT good THEN 3 ELSE kind + 1 END AS BIGINT) AS attempts, good AS reused,
       CAST(CASE WHEN good THEN 0 WHEN kind < 2 THEN 2 - kind ELSE 3 END AS BIGINT) AS n_calls,
       CASE WHEN NOT good THEN 'ConnectionError: service unavailable' END AS error,
""" + ", ".join(f"CASE WHEN good THEN {f} END AS {f}" for f in _SEC.FIELDS) + " FROM kinds"

Q["request_limit_stream"] = """
SELECT event_id, user_id, CAST(least(n, 16) AS INTEGER) AS n_window, n > 15 AS throttled
FROM (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
             RANGE BETWEEN INTERVAL '59.999999' SECOND PRECEDING AND CURRENT ROW) AS n FROM events)
"""

Q["gated_append"] = """
, faulty AS (
  SELECT id AS doc, CASE WHEN id % 19 = 0 THEN rpad(arxiv_id, 51, 'x') ELSE arxiv_id END AS arxiv_id, published_date, copy,
         concat_ws('; ', CASE WHEN id % 17 = 0 THEN 'title is null' END, CASE WHEN id % 31 = 0 THEN 'updated_date is null' END,
                   CASE WHEN id % 19 = 0 THEN 'arxiv_id is longer than 50' END,
                   CASE WHEN id % 23 = 0 AND len(categories_name) > 0 THEN 'codes and names differ in number' END) AS reasons
  FROM papers, range(2) AS r(copy) WHERE copy = 0 OR id % 4 = 0)
SELECT 'kept' AS outcome, id, arxiv_id, '' AS reasons FROM stored
UNION ALL
SELECT 'kept', (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY published_date, arxiv_id), arxiv_id, ''
FROM faulty f WHERE reasons = '' AND copy = 0 AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.arxiv_id = f.arxiv_id)
UNION ALL
SELECT 'quarantined', -1, arxiv_id, reasons FROM faulty WHERE reasons <> ''
"""

Q["requests_per_minute_live"] = Q["requests_per_minute"]

Q["cascade_stored"] = """
SELECT stage, kind, id
FROM (SELECT 'paper' AS kind, id, id AS paper FROM papers UNION ALL SELECT 'summary', id, arxiv_paper_id FROM summaries),
     (SELECT unnest(['buried', 'compacted']) AS stage)
WHERE paper % 7 <> 0
"""

Q["migrate_stored"] = """
, old AS (
  SELECT id, CASE WHEN id % 6 = 0 THEN '' WHEN id % 6 <> 1 THEN beginner_title END AS title,
         CASE WHEN id % 7 = 0 THEN '' WHEN id % 7 <> 1 THEN beginner_summary END AS summary FROM summaries)
SELECT 'refused' AS stage, id, title, summary FROM old
UNION ALL
SELECT 'moved', id, CASE WHEN title IS NULL OR title = '' THEN 'Beginner title pending regeneration' ELSE title END, summary FROM old
"""

# A paper's revision comes a day later, so the two may fall into different batches; the first batch has the paper.
Q["batched_append"] = """
, revised AS (
  SELECT arxiv_id, published_date, updated_date + to_days(copy::INTEGER) AS updated_date, week(updated_date + to_days(copy::INTEGER)) % 3 AS batch_id
  FROM papers, range(2) AS r(copy) WHERE copy = 0 OR id % 4 = 0),
best AS (SELECT * FROM revised QUALIFY row_number() OVER (PARTITION BY arxiv_id ORDER BY batch_id, updated_date DESC) = 1)
SELECT batch_id, row_number() OVER (ORDER BY batch_id, published_date, arxiv_id) AS id, arxiv_id, updated_date FROM best
"""

Q["search_postings"] = Q["search_papers"]

Q["counts_by_code"] = """
SELECT code AS category_id, count(*) AS paper_count, max(published_date) AS latest_paper
FROM (SELECT unnest(categories) AS code, published_date FROM papers) WHERE code IS NOT NULL GROUP BY code
"""


def oracle_sql() -> dict[str, str]:
    out = {}
    for k, body in Q.items():
        b = body.strip()
        if b.startswith(","):
            out[k] = "WITH " + STANDINS.strip() + "\n" + b + "\n"
        else:
            out[k] = with_standins(b)
    return out
