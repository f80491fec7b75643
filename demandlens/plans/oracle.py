"""The same results in plain SQL over the given tables, for checking."""

from ..fixed_values import (CASE_SENSITIVE_SKILLS, DEGREE_SKILLS, FEATURES, SKILL_TAXONOMY,
                            SPECIALISATION_SKILLS)
from ..operators.cohort import INDICATORS
from .star import DOCUMENT_EXACT, DOCUMENT_TAXONOMY, HIGH_PRICE, INTERCEPT, URGENT, WEIGHTS

# RE2 spelling of the token pattern (no possessive quantifiers).
_W = r"[\p{L}\p{M}\p{N}_]"
_TOKEN = rf"{_W}+(?:(?:&{_W}|\.\p{{Ll}}){_W}*)*(?:\+\+|#)?|[^\s\p{{L}}\p{{M}}\p{{N}}_]"


def _quote(text):
    return "'" + text.replace("'", "''") + "'"


def _list(values):
    return "[" + ", ".join(_quote(v) for v in values) + "]"


def _with(*parts):
    return "WITH " + ",\n".join(parts) + "\n"


def _number(text):
    return (rf"CASE WHEN regexp_matches(trim({text}), '^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
            rf"|(?i:inf|infinity))$') THEN TRY_CAST(trim({text}) AS DOUBLE) END")


# --- hash draws ---------------------------------------------------------------

def _md5(*parts):
    return f"""md5({" || '|' || ".join(parts)})"""


def _draw(*parts):
    return f"('0x' || substr({_md5(*parts)}, 1, 12))::BIGINT"


# --- extraction ---------------------------------------------------------------

def _vocabulary(taxonomy, exact):
    """The CTE ``vocab`` of a taxonomy, and its longest phrase in tokens."""
    rows = ", ".join(f"({_quote(c)}, {_quote(s)}, {str(s in exact).lower()})"
                     for c, skills in taxonomy.items() for s in skills)
    longest = max(len(s.replace("/", " / ").replace("-", " - ").split())
                  for skills in taxonomy.values() for s in skills)
    return (f"vocab AS (SELECT *, list_aggregate(regexp_extract_all(skill, {_quote(_TOKEN)}), "
            f"'string_agg', ' ') AS phrase FROM (VALUES {rows}) v(category, skill, is_exact))", longest)


def _extraction(source, vocab, longest):
    """CTEs up to ``mentions(posting_id, skill, category, first_pos)``.

    A match is dropped if a longer match overlaps it. That equals longest-first
    selection when matches only nest, as they do in the vocabularies used.
    """
    return (
        source,
        vocab,
        f"toks AS (SELECT posting_id, regexp_extract_all(description, {_quote(_TOKEN)}) AS t FROM src)",
        "words AS (SELECT posting_id, unnest(t) AS w, generate_subscripts(t, 1) - 1 AS p FROM toks)",
        "pos AS (SELECT posting_id, p, w AS w0" + "".join(
            f", lead(w, {i}) OVER (PARTITION BY posting_id ORDER BY p) AS w{i}" for i in range(1, longest)) +
        " FROM words)",
        "grams AS (" + " UNION ALL ".join(
            f"SELECT posting_id, p, {n} AS n, {' || chr(32) || '.join(f'w{i}' for i in range(n))} AS raw FROM pos"
            for n in range(1, longest + 1)) + ")",
        "hits AS (SELECT posting_id, p, n, skill, category FROM grams JOIN vocab "
        "ON lower(raw) = lower(phrase) WHERE NOT is_exact OR raw = phrase)",
        "kept AS (SELECT h.* FROM hits h ANTI JOIN hits o ON o.posting_id = h.posting_id "
        "AND o.n > h.n AND o.p < h.p + h.n AND h.p < o.p + o.n)",
        "mentions AS (SELECT posting_id, skill, category, min(p)::INT AS first_pos FROM kept "
        "GROUP BY ALL)",
        "lists AS (SELECT posting_id, string_agg(skill, ';' ORDER BY first_pos) AS extracted_skills, "
        "array_to_string(list_sort(list_distinct(list(category))), ';') AS skill_categories "
        "FROM mentions GROUP BY ALL)")


def _demand(long, total):
    return (f"SELECT skill, count(*) AS posting_count, count(*) / ({total})::DOUBLE AS pct, "
            f"row_number() OVER (ORDER BY count(*) DESC, skill)::INT AS demand_rank "
            f"FROM {long} GROUP BY skill")


_DOC_SRC = ("src AS (SELECT doc_id AS posting_id, lang AS title, source AS company, "
            "text AS description FROM documents)")
_DOC = _extraction(_DOC_SRC, *_vocabulary(DOCUMENT_TAXONOMY, DOCUMENT_EXACT))
_DEMAND_COLS = "skill, posting_count, round(pct, 6) AS pct_postings, demand_rank"

# --- orders and customers -----------------------------------------------------

_ORDER_SKILLS = ("order_skills AS (SELECT DISTINCT l_orderkey, p_name AS skill FROM lineitem "
                 "JOIN part ON l_partkey = p_partkey)")
_MARKET = (_ORDER_SKILLS,
           f"market AS ({_demand('order_skills', 'SELECT count(*) FROM orders')})",
           "demand AS (SELECT sum(posting_count)::DOUBLE AS total FROM market)")
_TAXONOMY = ("tax AS (SELECT DISTINCT p_name AS skill, split_part(p_name, ' ', -1) AS category "
             "FROM part)")
_ORDER_DOCS = (
    _ORDER_SKILLS,
    "docs AS (SELECT o_orderkey, printf('JP%04d', o_orderkey) AS posting_id, "
    "o_orderpriority AS title, o_orderstatus AS company, coalesce(l, []) AS skills FROM orders "
    "LEFT JOIN (SELECT l_orderkey, list_sort(list(skill)) AS l FROM order_skills GROUP BY ALL) "
    "ON o_orderkey = l_orderkey)")
_STUDENTS = (
    f"counts AS (SELECT o_custkey, count(*)::INT AS pc, count(*) FILTER (o_orderstatus = 'F')::INT AS cc, "
    f"count(*) FILTER (o_orderpriority = '{URGENT}')::INT AS ic, "
    f"max(CASE WHEN o_orderpriority = '{URGENT}' AND o_totalprice > {HIGH_PRICE} THEN 1 ELSE 0 END) AS pl "
    f"FROM orders GROUP BY ALL)",
    "students AS (SELECT printf('S%04d', c_custkey) AS student_id, c_custkey, c_acctbal / 1000.0 AS cgpa, "
    "coalesce(pc, 0) AS projects_count, coalesce(cc, 0) AS certifications_count, "
    "coalesce(ic, 0) AS internships_count, coalesce(pl, 0) AS placed "
    "FROM customer LEFT JOIN counts ON c_custkey = o_custkey)",
    "own AS (SELECT DISTINCT printf('S%04d', o_custkey) AS student_id, p_name AS skill FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey "
    "WHERE l_returnflag = 'R')")
_WORLD = (
    *_MARKET, *_STUDENTS,
    "matched AS (SELECT student_id, string_agg(skill, ';' ORDER BY demand_rank) AS matched_skills, "
    "sum(posting_count) AS covered FROM own JOIN market USING (skill) GROUP BY ALL)",
    "lacking AS (SELECT student_id, skill, demand_rank, posting_count, pct, "
    "row_number() OVER (PARTITION BY student_id ORDER BY demand_rank)::INT AS gap_rank "
    "FROM students CROSS JOIN market ANTI JOIN own USING (student_id, skill))",
    "gap_rows AS (SELECT * FROM lacking WHERE gap_rank <= 10)",
    "missing AS (SELECT student_id, string_agg(skill, ';' ORDER BY gap_rank) AS missing_skills_ranked "
    "FROM gap_rows GROUP BY ALL)",
    "sizes AS (SELECT student_id, count(*)::INT AS skill_count FROM own GROUP BY ALL)",
    "gaps AS (SELECT s.student_id, coalesce(matched_skills, '') AS matched_skills, "
    "coalesce(missing_skills_ranked, '') AS missing_skills_ranked, "
    "coalesce(covered, 0) AS covered, coalesce(covered, 0) / total AS alignment, "
    "round(coalesce(covered, 0) / total, 4) AS market_alignment_score, "
    "coalesce(skill_count, 0) AS skill_count FROM students s CROSS JOIN demand "
    "LEFT JOIN matched USING (student_id) LEFT JOIN missing USING (student_id) "
    "LEFT JOIN sizes USING (student_id))",
    "features AS (SELECT s.*, g.skill_count, g.market_alignment_score, g.covered, "
    "g.missing_skills_ranked, g.matched_skills FROM students s JOIN gaps g USING (student_id))")


def _probability(**instead):
    z = f"{INTERCEPT}::DOUBLE" + "".join(
        f" + ({instead.get(c, c)})::DOUBLE * {w}::DOUBLE" for c, w in WEIGHTS.items())
    return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))))"


def _tier(p):
    return f"CASE WHEN {p} >= 0.7 THEN 'On track' WHEN {p} >= 0.4 THEN 'Needs a push' ELSE 'At risk' END"


_COHORT = (*_WORLD, f"scored AS (SELECT *, {_probability()} AS p FROM features)",
           f"cohort AS (SELECT *, {_tier('p')} AS tier FROM scored)")
_MEDIANS = "medians AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in INDICATORS) + " FROM cohort)"
_LEVERS = (*_COHORT, "lever AS (SELECT c.student_id, g.skill, " + _probability(
    skill_count="c.skill_count + 1",
    market_alignment_score="(c.covered + g.posting_count) / d.total") +
    " - c.p AS gain FROM cohort c JOIN gap_rows g USING (student_id) CROSS JOIN demand d)")
_JUDGED = ("judged AS (SELECT quality AS placed, 1.0::DOUBLE / (1.0::DOUBLE + "
           "exp(floor(n_chars / 200) * 0.2::DOUBLE - 2.0::DOUBLE)) AS p FROM labels JOIN documents USING (doc_id))",)
_UPLOAD = ("up AS (SELECT user_id::VARCHAR AS student_id, value::VARCHAR AS cgpa, "
           "CASE WHEN event_type = 'error' THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS projects_count, "
           "event_type AS certifications_count, json_extract_string(props, '$.k') AS internships_count, "
           "event_type AS skills FROM events)",)
_SHOWN = ("SELECT student_id, round(market_alignment_score, 6) + 0.0 AS market_alignment_score, "
          "round(p, 6) + 0.0 AS probability, tier, skill_count FROM cohort")
_PERCENTILE = ("round((rank() OVER (ORDER BY {0}) - 1) / count(*) OVER ()::DOUBLE, 6) + 0.0")

_TRAINING = (*_COHORT, f"o AS (SELECT *, row_number() OVER (PARTITION BY placed ORDER BY "
             f"{_draw(_quote('42'), 'student_id')}, student_id) AS rn, count(*) OVER (PARTITION BY placed) AS n "
             f"FROM cohort)", "training AS (SELECT * FROM o WHERE rn - 1 >= round(n * 0.25))")

ORACLE = {
    "skill_mentions": _with(*_DOC) + "SELECT posting_id, skill, category, first_pos FROM mentions",
    "posting_skills": _with(*_DOC) +
    "SELECT posting_id, coalesce(extracted_skills, '') AS extracted_skills, "
    "coalesce(skill_categories, '') AS skill_categories FROM src LEFT JOIN lists USING (posting_id)",
    "market_demand": _with(*_DOC, f"d AS ({_demand('mentions', 'SELECT count(*) FROM documents')})") +
    f"SELECT {_DEMAND_COLS} FROM d",
    "demand_by_role": _with(
        *_DOC, "chosen AS (SELECT * FROM mentions SEMI JOIN (SELECT posting_id FROM src "
        "WHERE contains(lower(title), 'e')) USING (posting_id))",
        f"d AS ({_demand('chosen', 'SELECT count(*) FROM src WHERE contains(lower(title), chr(101))')})") +
    f"SELECT {_DEMAND_COLS} FROM d",
    "market_kpis": _with(*_DOC, f"d AS ({_demand('mentions', 'SELECT count(*) FROM documents')})",
                         "n AS (SELECT count(*) AS postings FROM documents)") +
    "SELECT postings, count(*) AS distinct_skills, arg_min(skill, demand_rank) AS top_skill, "
    "round(max(pct), 6) AS top_share, round(sum(posting_count) / postings::DOUBLE, 6) AS mean_skills "
    "FROM d CROSS JOIN n GROUP BY postings",
    "messages_json": "SELECT doc_id::VARCHAR AS posting_id, lang AS title, source AS company, "
    "text AS description, lang || ';' || source AS true_skills FROM documents",
    "process_messages": _with(*_DOC) +
    "SELECT posting_id::VARCHAR AS posting_id, title, company, coalesce(extracted_skills, '') AS "
    "extracted_skills, coalesce(skill_categories, '') AS skill_categories FROM src "
    "LEFT JOIN lists USING (posting_id)",
    "split_text_cells": _with(
        "parts AS (SELECT doc_id, list_filter(list_transform(string_split(text, ';'), "
        "lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x <> '' AND lower(x) <> 'nan') AS l FROM documents)") +
    "SELECT doc_id, len(l)::INT AS n_parts, md5(array_to_string(l, ';')) AS parts_md5 FROM parts",
    "market_demand_ranked": _with(*_MARKET) + f"SELECT {_DEMAND_COLS} FROM market",
    "top_skills": _with(*_MARKET) + f"SELECT {_DEMAND_COLS} FROM market WHERE demand_rank <= 20",
    "demand_rollup": _with(*_MARKET, _TAXONOMY) +
    "SELECT coalesce(category, 'ALL') AS category, coalesce(skill, 'ALL') AS skill, "
    "sum(posting_count)::BIGINT AS posting_count, grouping_id(category, skill)::INT AS level "
    "FROM market JOIN tax USING (skill) GROUP BY ROLLUP (category, skill)",
    "demand_with_category": _with(*_MARKET, _TAXONOMY) +
    f"SELECT {_DEMAND_COLS}, category FROM market JOIN tax USING (skill)",
    "skill_gaps": _with(*_WORLD) + "SELECT student_id, matched_skills, missing_skills_ranked, "
    "market_alignment_score, skill_count FROM gaps",
    "alignment": _with(*_WORLD) + "SELECT student_id, round(alignment, 6) AS alignment FROM gaps",
    "off_market": _with(
        *_STUDENTS, "types AS (SELECT DISTINCT printf('S%04d', o_custkey) AS student_id, p_type FROM lineitem "
        "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R')",
        "off AS (SELECT student_id, string_agg(p_type, ';' ORDER BY p_type) AS o FROM types GROUP BY ALL)") +
    "SELECT student_id, coalesce(o, '') AS off_market_skills FROM students LEFT JOIN off USING (student_id)",
    "gap_detail": _with(*_WORLD, _TAXONOMY) +
    "SELECT student_id, gap_rank, skill, category, round(pct, 6) AS demand, posting_count "
    "FROM gap_rows JOIN tax USING (skill)",
    "category_coverage": _with(
        *_MARKET, *_STUDENTS, _TAXONOMY,
        "ct AS (SELECT category, sum(posting_count)::DOUBLE AS total FROM market JOIN tax USING (skill) GROUP BY ALL)",
        "cov AS (SELECT student_id, category, sum(posting_count) AS covered FROM own "
        "JOIN market USING (skill) JOIN tax USING (skill) GROUP BY ALL)") +
    "SELECT student_id, category, round(coalesce(covered, 0) / total, 6) AS coverage FROM students "
    "CROSS JOIN ct LEFT JOIN cov USING (student_id, category)",
    "cohort_coverage": _with(
        *_MARKET, *_STUDENTS, _TAXONOMY,
        "ct AS (SELECT category, sum(posting_count)::DOUBLE AS total FROM market JOIN tax USING (skill) GROUP BY ALL)",
        "cov AS (SELECT student_id, category, sum(posting_count) AS covered FROM own "
        "JOIN market USING (skill) JOIN tax USING (skill) GROUP BY ALL)") +
    "SELECT category, round(avg(coalesce(covered, 0) / total), 6) AS coverage FROM students "
    "CROSS JOIN ct LEFT JOIN cov USING (student_id, category) GROUP BY category",
    "feature_frame": _with(*_WORLD) +
    "SELECT student_id, round(cgpa, 6) + 0.0 AS cgpa, projects_count, certifications_count, "
    "internships_count, placed, skill_count, round(market_alignment_score, 6) + 0.0 AS "
    "market_alignment_score FROM features",
    "score_cohort": _with(*_COHORT) + _SHOWN,
    "alignment_scatter": _with(*_COHORT) + _SHOWN,
    "unscored_cohort": "SELECT 'Unknown' AS tier, count(*) AS students, 0::BIGINT AS known FROM customer",
    "tier_counts": _with(*_COHORT, "spine(tier_pos, tier) AS (VALUES (0, 'On track'), "
                         "(1, 'Needs a push'), (2, 'At risk'))") +
    "SELECT tier_pos, tier, count(student_id) AS students FROM spine LEFT JOIN cohort USING (tier) "
    "GROUP BY ALL",
    "cohort_kpis": _with(*_COHORT) + "SELECT count(*) AS students, round(avg(p), 6) AS mean_probability, "
    "round(avg(placed), 6) AS placement_rate FROM cohort",
    "prob_histogram": _with(*_COHORT) +
    "SELECT least(floor(p * 25)::INT + 1, 25) AS bin, tier, count(*) AS students FROM cohort GROUP BY ALL",
    "percentile": _with(*_COHORT) + "SELECT student_id, round(p, 6) + 0.0 AS probability, "
    f"{_PERCENTILE.format('p')} AS percentile FROM cohort",
    "price_percentile": "SELECT o_orderkey, o_totalprice, "
    f"{_PERCENTILE.format('o_totalprice')} AS percentile FROM orders",
    "cohort_medians": _with(*_COHORT, _MEDIANS) + "SELECT " + ", ".join(
        f"round(m_{c}::DOUBLE, 6) + 0.0 AS {c}" for c in INDICATORS) + " FROM medians",
    "student_deltas": _with(*_COHORT, _MEDIANS) + "SELECT student_id, " + ", ".join(
        f"round({c} - m_{c}::DOUBLE, 6) + 0.0 AS {c}_delta" for c in INDICATORS) +
    " FROM cohort CROSS JOIN medians",
    "common_gaps": _with(*_WORLD) + "SELECT skill, count(*) AS students FROM gap_rows "
    "WHERE gap_rank <= 5 GROUP BY skill ORDER BY students DESC, skill LIMIT 15",
    "intervention_list": _with(*_COHORT) +
    "SELECT student_id, tier, round(p, 6) + 0.0 AS probability, round(cgpa, 6) + 0.0 AS cgpa, "
    "internships_count, round(market_alignment_score, 6) + 0.0 AS market_alignment_score, "
    "array_to_string(string_split(missing_skills_ranked, ';')[1:3], ', ') AS top_gaps "
    "FROM cohort WHERE tier IN ('At risk', 'Needs a push')",
    "scenarios": _with(
        *_COHORT,
        "added AS (SELECT student_id, sum(posting_count) AS more, count(*)::INT AS n, "
        "string_agg(skill, ';' ORDER BY gap_rank) AS names FROM gap_rows WHERE gap_rank <= 2 GROUP BY ALL)",
        "mine AS (SELECT student_id, string_agg(skill, ';' ORDER BY skill) AS names FROM own GROUP BY ALL)",
        "changed AS (SELECT c.student_id, c.p, c.market_alignment_score AS old_alignment, "
        "concat_ws(';', m.names, a.names) AS new_skills, "
        "(c.skill_count + coalesce(a.n, 0))::INT AS new_count, "
        "(c.covered + coalesce(a.more, 0)) / d.total AS new_alignment, " + _probability(
            internships_count="3", skill_count="c.skill_count + coalesce(a.n, 0)",
            market_alignment_score="(c.covered + coalesce(a.more, 0)) / d.total") +
        " AS np FROM cohort c CROSS JOIN demand d LEFT JOIN added a USING (student_id) "
        "LEFT JOIN mine m USING (student_id))") +
    "SELECT student_id, new_skills, new_count AS skill_count, round(new_alignment, 6) + 0.0 AS new_alignment, "
    f"round(np, 6) + 0.0 AS new_probability, {_tier('np')} AS new_tier, "
    "round(np - p, 6) + 0.0 AS probability_gain, "
    "round(new_alignment - old_alignment, 6) + 0.0 AS alignment_gain FROM changed",
    "levers": _with(*_LEVERS) + "SELECT student_id, skill, round(gain, 6) + 0.0 AS gain, "
    "row_number() OVER (PARTITION BY student_id ORDER BY gain DESC, skill)::INT AS lever_rank FROM lever",
    "no_lever": _with(*_LEVERS) + "SELECT student_id, round(max(gain), 6) + 0.0 AS max_gain, "
    "max(gain) <= 0 AS no_lever_helps FROM lever GROUP BY student_id",
    "student_view": _with(
        *_COHORT, _MEDIANS, _TAXONOMY,
        "ranked AS (SELECT *, (rank() OVER (ORDER BY p) - 1) / count(*) OVER ()::DOUBLE AS pr FROM cohort)",
        "shown AS (SELECT student_id, string_agg(skill || ':' || category, ';' ORDER BY gap_rank) AS gap_table "
        "FROM gap_rows JOIN tax USING (skill) GROUP BY ALL)",
        "off AS (SELECT student_id, string_agg(skill, ';' ORDER BY skill) AS o FROM own "
        "ANTI JOIN market USING (skill) GROUP BY ALL)") +
    "SELECT student_id, tier, round(p, 6) + 0.0 AS probability, round(pr, 6) + 0.0 AS percentile, "
    "round(cgpa - m_cgpa, 6) + 0.0 AS cgpa_delta, round(market_alignment_score - "
    "m_market_alignment_score, 6) + 0.0 AS market_alignment_score_delta, matched_skills, "
    "missing_skills_ranked, coalesce(o, '') AS off_market_skills, coalesce(gap_table, '') AS gap_table "
    "FROM ranked CROSS JOIN medians LEFT JOIN shown USING (student_id) LEFT JOIN off USING (student_id)",
    "search_documents": _with(*_ORDER_DOCS) +
    "SELECT posting_id, title, company, array_to_string(skills, ';') AS extracted_skills FROM docs",
    "search_index": _with(*_ORDER_DOCS) +
    "SELECT skill, posting_id, title, company FROM docs JOIN order_skills ON o_orderkey = l_orderkey",
    "stored_index_lookup": _with(*_ORDER_DOCS) +
    "SELECT skill, posting_id, title, company FROM docs JOIN order_skills ON o_orderkey = l_orderkey "
    "WHERE skill = 'blue ring' ORDER BY posting_id LIMIT 5",
    "postings_with_skill": _with(*_ORDER_DOCS) +
    "SELECT posting_id, title, company, array_to_string(skills, ';') AS extracted_skills FROM docs "
    "WHERE list_contains(skills, 'red plate')",
    "index_report": "SELECT count(*) AS indexed, 0::BIGINT AS rejected FROM orders",
    "search_postings": _with(*_ORDER_DOCS) +
    "SELECT posting_id, title, company, array_to_string(skills, ';') AS extracted_skills FROM docs "
    "WHERE list_contains(skills, 'hot gear') ORDER BY posting_id LIMIT 6",
    "csv_round_trip": "SELECT doc_id::VARCHAR AS posting_id, lang AS title, source AS company, "
    "md5(text) AS description_md5 FROM documents",
    "intervention_csv": _with(*_COHORT) + "SELECT student_id, tier, "
    "array_to_string(string_split(missing_skills_ranked, ';')[1:3], ', ') AS top_gaps "
    "FROM cohort WHERE tier = 'At risk'",
    "published_tables": _with(*_MARKET) + "SELECT 'latest/market_skill_demand' AS key, count(*) AS n_rows "
    "FROM market UNION ALL SELECT 'latest/student_skill_gaps', count(*) FROM customer",
    "student_lookup": _with(*_COHORT) + "SELECT student_id, tier, round(p, 6) + 0.0 AS probability, "
    "skill_count FROM cohort WHERE student_id = 'S0042'",
    "gap_postings": _with(
        *_WORLD, _ORDER_DOCS[1],
        "hits AS (SELECT skill, posting_id, title, company, row_number() OVER (PARTITION BY skill "
        "ORDER BY posting_id)::INT AS hit_rank FROM docs JOIN order_skills ON o_orderkey = l_orderkey)") +
    "SELECT student_id, gap_rank, skill, hit_rank, posting_id, title, company FROM gap_rows "
    "JOIN hits USING (skill) WHERE gap_rank <= 6 AND hit_rank <= 6",
    "extraction_quality": _with(
        *_ORDER_DOCS, "q AS (SELECT posting_id, len(list_filter(skills, lambda s: NOT starts_with(s, 'new ')))::INT "
        "AS n_found, len(skills)::INT AS n_true FROM docs)") +
    "SELECT posting_id, n_found, n_true, n_found AS n_both, CASE WHEN n_found > 0 THEN 1.0::DOUBLE "
    "ELSE 0.0::DOUBLE END AS precision, CASE WHEN n_true > 0 THEN round(n_found / n_true::DOUBLE, 6) "
    "ELSE 0.0::DOUBLE END AS recall FROM q WHERE n_found + n_true > 0",
    "quality_summary": _with(
        *_ORDER_DOCS, "q AS (SELECT posting_id, len(list_filter(skills, lambda s: NOT starts_with(s, 'new '))) "
        "AS n_found, len(skills) AS n_true FROM docs)") +
    "SELECT round(avg(CASE WHEN n_found > 0 THEN 1.0 ELSE 0.0 END::DOUBLE), 6) AS mean_precision, "
    "round(avg(n_found / n_true::DOUBLE), 6) AS mean_recall, count(*) AS n_rows FROM q WHERE n_true > 0",
    "text_quality": _with(
        *_extraction(
            "src AS (SELECT printf('JP%04d', l_orderkey) AS posting_id, array_to_string(list_sort(list_distinct(list("
            "p_name || ' ' || p_type || ' ' || split_part(p_name, ' ', -1)))), ', ') AS description, "
            "list_distinct(list(p_name)) AS truth FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)",
            "vocab AS (SELECT DISTINCT split_part(p_name, ' ', -1) AS category, p_name AS skill, false AS is_exact, "
            "p_name AS phrase FROM part)", 2),
        "found AS (SELECT posting_id, list(skill) AS f FROM mentions GROUP BY ALL)",
        "q AS (SELECT posting_id, len(coalesce(f, []))::INT AS n_found, len(truth)::INT AS n_true, "
        "len(list_intersect(coalesce(f, []), truth))::INT AS n_both FROM src LEFT JOIN found USING (posting_id))") +
    "SELECT *, CASE WHEN n_found > 0 THEN round(n_both / n_found::DOUBLE, 6) ELSE 0.0::DOUBLE END AS precision, "
    "CASE WHEN n_true > 0 THEN round(n_both / n_true::DOUBLE, 6) ELSE 0.0::DOUBLE END AS recall FROM q",
    "text_market": _with(
        *_extraction(
            "src AS (SELECT 'D' || doc_id AS posting_id, text AS description FROM documents UNION ALL "
            "SELECT 'C' || conv_id || '-' || turn, text FROM conversations UNION ALL "
            "SELECT 'P' || page_id, html FROM pages)", *_vocabulary(SKILL_TAXONOMY, CASE_SENSITIVE_SKILLS)),
        f"d AS ({_demand('mentions', 'SELECT count(*) FROM src')})") +
    f"SELECT {_DEMAND_COLS}, category FROM d JOIN (SELECT skill, category FROM vocab) USING (skill)",
    "external_postings": "SELECT 'JP' || doc_id AS posting_id, lang AS title, source AS company, "
    "text AS description FROM documents",
    "external_students": _with(
        f"dl AS (SELECT unnest(map_keys(m)) AS k, unnest(map_values(m)) AS v FROM (SELECT MAP "
        f"{{{', '.join(f'{_quote(k)}: {_list(v)}' for k, v in DEGREE_SKILLS.items())}}} AS m))",
        f"sl AS (SELECT unnest(map_keys(m)) AS k, unnest(map_values(m)) AS v FROM (SELECT MAP "
        f"{{{', '.join(f'{_quote(k)}: {_list(v)}' for k, v in SPECIALISATION_SKILLS.items())}}} AS m))",
        "raw AS (SELECT *, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Sci&Tech' WHEN 'BUILDING' THEN "
        "'Comm&Mgmt' WHEN 'FURNITURE' THEN 'Arts' ELSE 'Others' END AS d, CASE WHEN c_nationkey < 12 THEN "
        "'Mkt&HR' ELSE 'Mkt&Fin' END AS s FROM customer)") +
    "SELECT printf('S%04d', c_custkey) AS student_id, round(((c_custkey % 60 + 40.0::DOUBLE) + "
    "(c_nationkey + 50.0::DOUBLE) + length(c_mktsegment) * 7.0::DOUBLE) / 3 / 10, 2) AS cgpa, "
    "0 AS projects_count, 0 AS certifications_count, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS "
    "internships_count, array_to_string(list_sort(list_distinct(list_concat(coalesce(dl.v, []), "
    "coalesce(sl.v, [])))), ';') AS skills, CASE WHEN c_acctbal > 4000 THEN 1 ELSE 0 END AS placed "
    "FROM raw LEFT JOIN dl ON dl.k = d LEFT JOIN sl ON sl.k = s",
    "validation_report": _with(*_UPLOAD) +
    "SELECT 0 AS check_order, 'not_empty' AS check_name, '' AS column_name, "
    "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END::BIGINT AS bad_rows FROM up" + "".join(
        f" UNION ALL SELECT {i}, 'numeric', '{c}', count(*) FILTER (({_number(c)}) IS NULL) FROM up"
        for i, c in enumerate(("cgpa", "projects_count", "certifications_count", "internships_count"), 1)) +
    " UNION ALL SELECT 5, 'has_text', 'skills', CASE WHEN count(*) > 0 AND count(skills) = 0 THEN 1 ELSE 0 END FROM up"
    " UNION ALL SELECT 6, 'unique_id', 'student_id', count(*) - count(DISTINCT student_id) FROM up",
    "numeric_coercion": _with(*_UPLOAD) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({_number(c)}) AS n_numbers, "
        f"round(coalesce(sum({_number(c)}), 0.0), 6) AS total FROM up"
        for c in ("cgpa", "projects_count", "certifications_count", "internships_count")),
    "dup_ids": "SELECT user_id::VARCHAR AS student_id, count(*) AS n_rows FROM events GROUP BY user_id "
    "HAVING count(*) > 1",
    "seq_ids": "SELECT printf('S%04d', row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) AS row_id, "
    "o_orderkey FROM orders",
    "prepared_postings": "SELECT printf('JP%04d', row_number() OVER (ORDER BY doc_id) - 1) AS posting_id, "
    "doc_id, lang AS title, source AS company FROM documents",
    "random_sample": "SELECT item FROM (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) "
    f"AS item FROM lineitem) ORDER BY {_draw(_quote('42'), 'item')}, item LIMIT 20000",
    "auc_exact": _with(*_JUDGED, "v AS (SELECT p, count(*) FILTER (placed = 1) AS pos, "
                       "count(*) FILTER (placed = 0) AS neg FROM judged GROUP BY p)",
                       "r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING "
                       "AND 1 PRECEDING), 0) AS below FROM v)") +
    "SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM r",
    "accuracy": _with(*_JUDGED) + "SELECT round(avg(CASE WHEN (p > 0.5) = (placed = 1) THEN 1.0 ELSE 0.0 "
    "END::DOUBLE), 6) AS accuracy FROM judged",
    "class_report": _with(*_JUDGED, "j AS (SELECT placed, (p > 0.5)::INT AS pred FROM judged)",
                          "c(class) AS (VALUES (0), (1))",
                          "s AS (SELECT class, count(*) FILTER (placed = class) AS support, "
                          "count(*) FILTER (pred = class) AS chosen, count(*) FILTER (placed = class AND "
                          "pred = class) AS hit FROM j CROSS JOIN c GROUP BY class)") +
    "SELECT class, round(coalesce(hit / nullif(chosen, 0)::DOUBLE, 0), 6) AS precision, "
    "round(coalesce(hit / nullif(support, 0)::DOUBLE, 0), 6) AS recall, "
    "round(coalesce(2.0 * hit / nullif(chosen + support, 0)::DOUBLE, 0), 6) AS f1, support FROM s",
    "class_guard": _with(*_STUDENTS, "n AS (SELECT placed, count(*) AS n FROM students GROUP BY placed)") +
    "SELECT 'all' AS case, count(*) >= 2 AND min(n) >= 4 AS accepted FROM n UNION ALL "
    "SELECT 'one_outcome', false UNION ALL SELECT 'few', false",
    "scaler_stats": _with(*_TRAINING) + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) + 0.0 AS mean, round(stddev_pop({c}), 6) + 0.0 AS deviation "
        f"FROM training" for c in FEATURES),
    "logistic_optimum": "SELECT unnest(" + _list(FEATURES) + ") AS feature, 0.0::DOUBLE AS gradient",
    "placement_rate": _with(*_STUDENTS) + "SELECT round(avg(placed), 6) AS placement_rate FROM students",
    "train_split": _with(
        *_STUDENTS, f"o AS (SELECT student_id, placed, row_number() OVER (PARTITION BY placed ORDER BY "
        f"{_draw(_quote('42'), 'student_id')}, student_id) AS rn, count(*) OVER (PARTITION BY placed) AS n "
        f"FROM students)") +
    "SELECT student_id, placed, rn - 1 < round(n * 0.25) AS is_test FROM o",
}
_MODELS = " UNION ALL ".join(
    f"SELECT '{name}' AS model, '{label}' AS label, placed, 1.0::DOUBLE / (1.0::DOUBLE + exp({sign}(floor(n_chars / 200) "
    f"* 0.2::DOUBLE - 2.0::DOUBLE))) AS p FROM labels JOIN documents USING (doc_id), LATERAL (SELECT quality AS placed)"
    for name, label, sign in (("long_texts", "Long Texts", "-"), ("short_texts", "Short Texts", "")))
ORACLE["model_choice"] = _with(
    f"scored AS ({_MODELS})",
    "v AS (SELECT model, p, count(*) FILTER (placed = 1) AS pos, count(*) FILTER (placed = 0) AS neg FROM scored "
    "GROUP BY ALL)",
    "r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING), 0) AS below FROM v)",
    "a AS (SELECT model, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM r GROUP BY model)",
    "m AS (SELECT model, label, auc, avg(CASE WHEN (p > 0.5) = (placed = 1) THEN 1.0 ELSE 0.0 END::DOUBLE) AS accuracy "
    "FROM scored JOIN a USING (model) GROUP BY ALL)",
    "best AS (SELECT model AS chosen FROM m ORDER BY auc DESC, model LIMIT 1)") + (
    "SELECT model, metric, round(value, 6) + 0.0 AS value, label, model = chosen AS selected FROM ("
    "SELECT model, label, 'auc' AS metric, auc AS value FROM m UNION ALL "
    "SELECT model, label, 'accuracy', accuracy FROM m), best")
ORACLE["importance_order"] = _with(*_TRAINING, "w AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 1.0 - round(avg({c}), 6) AS weight FROM training" for c in FEATURES) + ")") + (
    "SELECT feature, round(weight, 6) + 0.0 AS weight, round(abs(weight), 6) + 0.0 AS size, "
    "(row_number() OVER (ORDER BY abs(weight), feature))::INT AS place FROM w")
_SHARES = "[" + ", ".join(f"{i / 256}" for i in range(1, 256)) + "]"
ORACLE["boosted_stump"] = _with(
    *_TRAINING, "t AS (SELECT *, avg(placed) OVER () - placed AS g, avg(placed) OVER () * (1 - avg(placed) OVER ()) AS h "
    "FROM training)",
    "s AS (" + " UNION ALL ".join(
        f"SELECT {i} AS place, '{c}' AS feature, cut, x, g, h FROM (SELECT {c}::DOUBLE AS x, g, h FROM t), "
        f"(SELECT DISTINCT unnest(quantile_disc({c}::DOUBLE, {_SHARES})) AS cut FROM t) WHERE cut < "
        f"(SELECT max({c}) FROM t)" for i, c in enumerate(FEATURES)) + ")",
    "c AS (SELECT place, feature, cut, coalesce(sum(g) FILTER (x <= cut), 0) AS gl, sum(h) FILTER (x <= cut) AS hl, "
    "coalesce(sum(g) FILTER (x > cut), 0) AS gr, sum(h) FILTER (x > cut) AS hr FROM s GROUP BY ALL)") + (
    "SELECT feature, round(cut, 6) + 0.0 AS threshold, round(-0.1::DOUBLE * gl / (hl + 1), 6) + 0.0 AS below, "
    "round(-0.1::DOUBLE * gr / (hr + 1), 6) + 0.0 AS above, "
    "round(gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1), 6) + 0.0 AS gain "
    "FROM c WHERE hl >= 1 AND hr >= 1 ORDER BY round(gl * gl / (hl + 1) + gr * gr / (hr + 1), 6) DESC, place, cut LIMIT 1")
ORACLE["stream_extract"] = ORACLE["process_messages"]
ORACLE["sketch_medians"] = _with(*_COHORT) + "SELECT " + ", ".join(
    f"round(quantile_disc({c}::DOUBLE, 0.5), 6) + 0.0 AS {c}" for c in INDICATORS) + " FROM cohort"
_GRID = "[" + ", ".join(f"{i / 1024}" for i in range(1, 1025)) + "]"
ORACLE["sketch_percentile"] = _with(*_COHORT, f"g AS (SELECT quantile_disc(p, {_GRID}) AS grid FROM cohort)") + (
    "SELECT student_id, round(len(list_filter(grid, lambda q: q < p)) / 1024.0::DOUBLE, 6) + 0.0 AS percentile "
    "FROM cohort, g")
ORACLE["gap_hits"] = _with(
    *_WORLD, _ORDER_DOCS[1],
    "hits AS (SELECT skill, posting_id, row_number() OVER (PARTITION BY skill ORDER BY posting_id) AS hit_rank "
    "FROM docs JOIN order_skills ON o_orderkey = l_orderkey)",
    "g AS (SELECT student_id, gap_rank, skill, string_agg(posting_id, ',' ORDER BY hit_rank) AS listed FROM gap_rows "
    "JOIN hits USING (skill) WHERE gap_rank <= 6 AND hit_rank <= 6 GROUP BY ALL)",
    "s AS (SELECT student_id, string_agg(gap_rank || ':' || skill || ':' || listed, ';' ORDER BY gap_rank) AS gaps "
    "FROM g GROUP BY student_id)") + (
    "SELECT student_id, coalesce(gaps, '') AS gaps FROM students LEFT JOIN s USING (student_id)")
ORACLE["stream_until_idle"] = ORACLE["process_messages"]
ORACLE["stored_model_optimum"] = ORACLE["logistic_optimum"]
ORACLE["nan_messages"] = (
    "SELECT o_orderkey::VARCHAR AS key, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice::DOUBLE END AS price, "
    "o_orderpriority = '1-URGENT' AS written_as_null FROM orders")
ORACLE["stored_tables"] = _with(*_STUDENTS) + (
    "SELECT 'absent' AS case, 0 AS n_rows, false AS ready UNION ALL "
    "SELECT 'replaced', count(*) FILTER (projects_count > 0), true FROM students UNION ALL "
    "SELECT 'chosen_external', count(*) FILTER (placed = 1), count(*) = count(placed) FROM students UNION ALL "
    "SELECT 'chosen_generated', count(*), count(*) = count(nullif(projects_count, 0)) FROM students")
ORACLE["stream_demand"] = ORACLE["market_demand"]
ORACLE["stream_demand_by_role"] = ORACLE["demand_by_role"]
ORACLE["mentions_by_join"] = ORACLE["skill_mentions"]
ORACLE["skill_gaps_long"] = ORACLE["skill_gaps"]
ORACLE["category_coverage_long"] = ORACLE["category_coverage"]
ORACLE["levers_long"] = ORACLE["levers"]
ORACLE["scaled_demand"] = _with(*_MARKET) + (
    f"SELECT {_DEMAND_COLS}, round(pct / max(pct) OVER (), 6) AS scaled FROM market")
ORACLE["students_csv"] = _with(*_STUDENTS, "s AS (SELECT student_id, string_agg(skill, ';' ORDER BY skill) AS skills "
                               "FROM own GROUP BY ALL)") + (
    "SELECT student_id, round(cgpa, 6) + 0.0 AS cgpa, projects_count, certifications_count, internships_count, "
    "coalesce(skills, '') AS skills, placed FROM students LEFT JOIN s USING (student_id)")
ORACLE["uploaded_students"] = ORACLE["students_csv"] + " WHERE placed = 1"
ORACLE["stage_tables"] = _with(*_DOC) + (
    "SELECT 'job_postings_skills' AS stored, count(*) AS n_rows FROM documents UNION ALL "
    "SELECT 'market_skill_demand', count(DISTINCT skill) FROM mentions UNION ALL "
    "SELECT 'student_skill_gaps', count(*) FROM customer")
