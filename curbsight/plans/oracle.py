"""DuckDB twins of the named queries, for checking results.

Each text is one SELECT over the shared test tables. Common steps are named
sub-queries; ``_query`` puts those in front that a text needs.
"""

from __future__ import annotations

import re

from curbsight import fixed_values as fv
from curbsight.operators.encoder import DIMENSIONS
from curbsight.operators.evidence import RAG_INSTRUCTION, REPORT_INSTRUCTION
from curbsight.plans.queries import SEARCH_RISKS, SEARCH_TEXT
from curbsight.sources import adapters

AS_OF = f"DATE '{adapters.AS_OF.isoformat()}'"
WORD = 4294967296


def _text(value: str | None) -> str:
    if value is None:
        return "NULL"
    pieces = value.split("\n")
    return "(" + " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in pieces) + ")"


_BLANKS = "(" + " || ".join(f"chr({ord(c)})" for c in fv.WHITESPACE) + ")"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _pick(values, index: str) -> str:
    return f"({_list(values)})[(({index}) + 1)::INTEGER]"


def _case(mapping: dict[str, str], column: str, default: str) -> str:
    arms = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {_text(default)} END"


def _avg2(column: str) -> str:
    return f"round(avg({column})::DECIMAL(18,8), 2)::DOUBLE"


def _mean(column: str) -> str:
    """Of doubles with two decimals: added exactly, divided once."""
    return f"(sum({column}::DECIMAL(18,2))::DOUBLE / nullif(count({column}), 0))"


def _ratio2(total: str, count: str) -> str:
    return f"round((({total})::DOUBLE / nullif({count}, 0))::DECIMAL(18,8), 2)::DOUBLE"


# --- Murmur3 as list expressions over the hex digits of a text ---


def _byte(hexed: str, position: str) -> str:
    return f"{hexed}[({position}) * 2 + 1:({position}) * 2 + 2]"


def _mix(word: str) -> str:
    scaled = f"((({word})::HUGEINT * 3432918353) % {WORD})::BIGINT"
    turned = f"(((({scaled}) << 15) % {WORD}) | (({scaled}) >> 17))"
    return f"((({turned})::HUGEINT * 461845907) % {WORD})::BIGINT"


def _fold(seeded: str) -> str:
    turned = f"((xor(h, w) << 13) % {WORD}) | (xor(h, w) >> 19)"
    return f"list_reduce({seeded}, lambda h, w: ((({turned}) * 5) + 3864292196) % {WORD})"


def _finish(state: str, length: str) -> str:
    first = f"xor({state}, ({length})::BIGINT)"
    second = f"((xor({first}, ({first}) >> 16)::HUGEINT * 2246822507) % {WORD})::BIGINT"
    third = f"((xor({second}, ({second}) >> 13)::HUGEINT * 3266489909) % {WORD})::BIGINT"
    value = f"xor({third}, ({third}) >> 16)"
    return f"(CASE WHEN {value} >= 2147483648 THEN {value} - {WORD} ELSE {value} END)::INTEGER"


_WHOLE_WORDS = (
    "list_transform(range(0, n // 4), lambda i: ('0x' || "
    + " || ".join(_byte("hx", f"i * 4 + {b}") for b in (3, 2, 1, 0))
    + ")::BIGINT)"
)
_TAIL_BYTES = f"list_transform(range((n // 4) * 4, n), lambda i: ('0x' || {_byte('hx', 'i')})::BIGINT)"
_TAIL_WORD = "coalesce(list_sum(list_transform(range((n // 4) * 4, n), lambda i: " + (
    f"('0x' || {_byte('hx', 'i')})::BIGINT << ((i % 4) * 8)::BIGINT)), 0)::BIGINT"
)


def _hashed(source: str, key: str, tail_as_word: bool) -> str:
    """Relation ``(key, hash)`` for the distinct texts of a relation.

    The column hash mixes the bytes after the last whole word one by one, the
    term hash as one short word.
    """
    mixed = f"list_transform(words, lambda w: {_mix('w')})"
    folded = _fold(f"list_prepend(42::BIGINT, {mixed})")
    end = f"xor(state, {_mix('tail')})" if tail_as_word else "state"
    words = _WHOLE_WORDS if tail_as_word else f"list_concat({_WHOLE_WORDS}, {_TAIL_BYTES})"
    return f"""
        SELECT {key}, {_finish(end, 'n')} AS hash FROM (
          SELECT {key}, n, tail, {folded} AS state FROM (
            SELECT {key}, n, {words} AS words, {_TAIL_WORD} AS tail FROM (
              SELECT {key}, hex(encode({key})) AS hx, length(hex(encode({key}))) // 2 AS n
              FROM (SELECT DISTINCT {key} FROM {source}))))
    """


def _intent(question: str) -> str:
    arms = []
    for name, words in fv.INTENT_PATTERNS.items():
        hit = " OR ".join(f"contains(lower({question}), {_text(w)})" for w in words)
        arms.append(f"WHEN {hit} THEN {_text(name)}")
    return f"CASE {' '.join(arms)} END"


def _dollars(column: str) -> str:
    return f"('$' || format('{{:,}}', round_even({column}, 0)::BIGINT))"


def _line(*parts: tuple[str, str]) -> str:
    pieces = [f"{_text(title + ': ')} || coalesce(({value})::VARCHAR, 'None')" for title, value in parts]
    return " || ' | ' || ".join(pieces)


def _numbered(select: str, source: str, order: str, n: int | None = fv.TOP_N, where: str = "TRUE") -> str:
    inner = f"SELECT row_number() OVER (ORDER BY {order}) AS position, {select} FROM {source} WHERE {where}"
    return inner if n is None else f"SELECT * FROM ({inner}) WHERE position <= {n}"


_SHARE_ARMS = " ".join(
    "WHEN " + " OR ".join(f"contains(lower(service_category), '{w}')" for w in words) + f" THEN {share}::DOUBLE"
    for share, words in fv.PICKUP_SHARES
)
_KNOWN_NAMES = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in fv.KNOWN_FALLBACK_NAMES.items())
_FALLBACK_NAME = f"""CASE property_id {_KNOWN_NAMES} ELSE {_pick(fv.FALLBACK_NAME_PREFIXES, 'd % 10')}
    || ' ' || {_pick(fv.FALLBACK_NAME_SUFFIXES, '(d // 10) % 9')} END"""
_ID_DIGITS = """coalesce(try_cast(nullif(regexp_replace(property_id, '[^0-9]', '', 'g'), '') AS BIGINT),
    list_sum(list_transform(string_split(property_id, ''), lambda c: unicode(c)))::BIGINT)"""


def _fallback_type(name: str) -> str:
    total = f"list_sum(list_transform(string_split({name}, ''), lambda c: unicode(c)))::BIGINT"
    return _pick(fv.FALLBACK_PROPERTY_TYPES, f"{total} % {len(fv.FALLBACK_PROPERTY_TYPES)}")


def _filled(column: str) -> str:
    return f"coalesce({column}, {_text(fv.RAG_NULL_DEFAULTS[column])})"


_PAGE = " || ".join(f"{_text(heading)} || {_filled(column)}" for heading, column in fv.DOCUMENT_PARTS)

_GOLD_CHURN_LABEL = """CASE WHEN avg_csat <= 2.5 OR missed_pickups_30d >= 8 THEN 'high'
    WHEN avg_csat <= 3.5 OR missed_pickups_30d >= 4 THEN 'medium' ELSE 'low' END"""

_SILVER = [
    "ticket_id", "property_id", "property_type", "service_tier", "complaint_description", "service_response",
    "resolution_notes", "complaint_sentiment", "issue_type", "csat_score", "resolution_time_hours",
    "property_name", "contract_value", "missed_pickups_30d", "renewal_date", "service_category",
    "churn_risk_label",
]

_ROUTE = f"""CASE mode WHEN {_text(fv.MODE_FULL)} THEN 'full' WHEN {_text(fv.MODE_SQL)} THEN 'sql'
    WHEN {_text(fv.MODE_RAG)} THEN 'rag' ELSE CASE WHEN intent IS NOT NULL THEN 'full' ELSE 'rag' END END"""

RELATIONS = {
    "tickets": f"""
        SELECT event_id AS ticket_id, printf('CUST_%05d', user_id) AS customer_id,
          event_type AS customer_segment, {_pick(adapters.SLA_PLANS, 'k % 3')} AS sla_plan,
          props AS initial_message, 'Seen, ' || event_type || chr(10) || 'next' AS agent_first_reply,
          CASE WHEN event_id % 7 <> 0 THEN 'closed "' || event_id::VARCHAR || '"' END AS resolution_summary,
          {_pick(adapters.SENTIMENTS, 'event_id % 3')} AS customer_sentiment,
          {_pick([*adapters.ISSUE_CODES, None], 'k % 10')} AS issue_type,
          CASE WHEN event_id % 11 <> 0 THEN
            least(5, greatest(1, 1 + ((event_id * 31 + k) % 5) + user_id % 5 - 2)) END::BIGINT AS csat_score,
          value AS resolution_time_hours
        FROM (SELECT *, json_extract(props, '$.k')::INTEGER AS k FROM events)
    """,
    "ids": _hashed("(SELECT customer_id AS property_id FROM tickets)", "property_id", tail_as_word=False),
    "silver": f"""
        SELECT ticket_id, t.customer_id AS property_id, customer_segment AS property_type,
          sla_plan AS service_tier, initial_message AS complaint_description,
          agent_first_reply AS service_response, resolution_summary AS resolution_notes,
          customer_sentiment AS complaint_sentiment, issue_type, csat_score, resolution_time_hours,
          {_pick(fv.PROPERTY_NAMES, "replace(t.customer_id, 'CUST_', '')::BIGINT % 24")} AS property_name,
          (abs(hash % {fv.CONTRACT_SPAN}) + {fv.CONTRACT_FLOOR})::INTEGER AS contract_value,
          abs(hash % {fv.MISSED_PICKUP_SPAN})::INTEGER AS missed_pickups_30d,
          ({AS_OF} + abs(hash % {fv.RENEWAL_SPAN_DAYS})::INTEGER)::DATE AS renewal_date,
          {_case(fv.SERVICE_CATEGORY_BY_ISSUE, 'issue_type', fv.DEFAULT_SERVICE_CATEGORY)} AS service_category,
          CASE WHEN csat_score <= 2 OR abs(hash % 11) >= 8 THEN 'high'
            WHEN csat_score = 3 OR abs(hash % 11) >= 4 THEN 'medium' ELSE 'low' END AS churn_risk_label
        FROM tickets t JOIN ids ON ids.property_id = t.customer_id
    """,
    "churn": f"""
        SELECT *, {_GOLD_CHURN_LABEL} AS churn_risk_label FROM (
          SELECT property_id, property_name, count(*) AS complaint_count, {_avg2('csat_score')} AS avg_csat,
            max(missed_pickups_30d) AS missed_pickups_30d, {_avg2('contract_value')} AS contract_value,
            max(renewal_date) AS renewal_date
          FROM silver GROUP BY property_id, property_name)
    """,
    "health": f"""
        SELECT property_id, property_name, property_type, service_category, count(*) AS total_complaints,
          {_avg2('csat_score')} AS avg_csat, max(missed_pickups_30d) AS total_missed_pickups,
          {_avg2('contract_value')} AS contract_value
        FROM silver GROUP BY property_id, property_name, property_type, service_category
    """,
    "service": f"""
        SELECT service_category, property_id, property_name, property_type, count(*) AS total_complaints,
          {_avg2('csat_score')} AS avg_csat, {_avg2('resolution_time_hours')} AS avg_resolution_time,
          max(missed_pickups_30d) AS total_missed_pickups, {_avg2('contract_value')} AS contract_value
        FROM silver GROUP BY service_category, property_id, property_name, property_type
    """,
    "service_sums": f"""
        SELECT service_category, sum(total_complaints)::BIGINT AS total_complaints, {_mean('avg_csat')} AS avg_csat,
          {_mean('avg_resolution_time')} AS avg_resolution_time,
          sum(total_missed_pickups)::BIGINT AS total_missed_pickups
        FROM service GROUP BY service_category
    """,
    "health_sums": f"""
        SELECT property_name, property_type, sum(total_complaints)::BIGINT AS total_complaints,
          {_mean('avg_csat')} AS avg_csat, sum(total_missed_pickups)::BIGINT AS total_missed_pickups
        FROM health GROUP BY property_name, property_type
    """,
    "r_high_churn": _numbered(
        "property_id, property_name, churn_risk_label, complaint_count, avg_csat, missed_pickups_30d, contract_value",
        "churn", "complaint_count DESC, property_id", where="churn_risk_label = 'high'",
    ),
    "r_low_csat": _numbered(
        "property_id, property_name, avg_csat, complaint_count, churn_risk_label",
        "churn", "avg_csat ASC NULLS FIRST, property_id",
    ),
    "r_missed": _numbered(
        "property_id, property_name, missed_pickups_30d, churn_risk_label, avg_csat, complaint_count",
        "churn", "missed_pickups_30d DESC NULLS LAST, property_id",
    ),
    "r_contract": _numbered(
        "property_id, property_name, contract_value, churn_risk_label, avg_csat, renewal_date",
        "churn", "contract_value DESC NULLS LAST, property_id", where="churn_risk_label = 'high'",
    ),
    "r_service": _numbered("*", "service_sums", "total_complaints DESC, service_category", n=None),
    "r_health": _numbered("*", "health_sums", "total_complaints DESC, property_name, property_type"),
    "r_renewal": _numbered(
        "property_id, property_name, renewal_date, churn_risk_label, contract_value, avg_csat",
        "churn", "renewal_date ASC, property_id", where=f"renewal_date <= {AS_OF} + {fv.RENEWAL_NOTICE_DAYS}",
    ),
    "lines": " UNION ALL ".join(
        f"SELECT {_text(intent)} AS intent, position::INTEGER AS position, "
        f"position::VARCHAR || '. ' || {line} AS line FROM {relation}"
        for intent, relation, line in [
            ("high churn risk", "r_high_churn", _line(
                ("Property", "property_name"), ("Complaints", "complaint_count"), ("CSAT", "avg_csat"),
                ("Missed Pickups", "missed_pickups_30d"), ("Contract", _dollars("contract_value")))),
            ("low csat", "r_low_csat", _line(
                ("Property", "property_name"), ("CSAT", "avg_csat"), ("Complaints", "complaint_count"),
                ("Risk", "churn_risk_label"))),
            ("missed pickups", "r_missed", _line(
                ("Property", "property_name"), ("Missed Pickups", "missed_pickups_30d"),
                ("Risk", "churn_risk_label"), ("CSAT", "avg_csat"))),
            ("contract value at risk", "r_contract", _line(
                ("Property", "property_name"), ("Contract", _dollars("contract_value")), ("CSAT", "avg_csat"),
                ("Renewal", "renewal_date"))),
            ("service performance", "r_service", _line(
                ("Category", "service_category"), ("Complaints", "total_complaints"),
                ("CSAT", "round(avg_csat, 2)"),
                ("Avg Resolution", "round(avg_resolution_time, 1)::VARCHAR || 'h'"))),
            ("property health", "r_health", _line(
                ("Property", "property_name"), ("Type", "property_type"), ("Complaints", "total_complaints"),
                ("CSAT", "round(avg_csat, 2)"), ("Missed Pickups", "total_missed_pickups"))),
            ("renewal timing", "r_renewal", _line(
                ("Property", "property_name"), ("Renewal", "renewal_date"), ("Risk", "churn_risk_label"),
                ("Contract", _dollars("contract_value")))),
        ]
    ),
    "texts": f"""
        SELECT intent, coalesce(title || ':' || chr(10) || chr(10) || body, 'No data found for: ' || title)
          AS sql_result
        FROM (VALUES {', '.join(f'({_text(i)}, {_text(t)})' for i, t in fv.INTENT_TITLES.items())})
          titles(intent, title)
        LEFT JOIN (SELECT intent, string_agg(line, chr(10) ORDER BY position) AS body FROM lines GROUP BY intent)
          USING (intent)
    """,
    "conversation_tickets": f"""
        SELECT conv_id * {adapters.TURNS} + answered AS ticket_id,
          printf('CUST_%05d', conv_id % {adapters.CONVERSATION_PROPERTIES}) AS property_id,
          complaint_description, service_response, NULL::VARCHAR AS resolution_notes,
          {_pick([*adapters.CONVERSATION_CATEGORIES, None], 'conv_id % 5')} AS service_category
        FROM (SELECT conv_id, turn + 1 AS answered, text AS complaint_description FROM conversations WHERE role = 'user')
        FULL JOIN (SELECT conv_id, turn AS answered, text AS service_response FROM conversations
            WHERE role = 'assistant') USING (conv_id, answered)
    """,
    "labelled": """
        SELECT t.ticket_id, t.property_id, complaint_description, service_response, resolution_notes,
          service_category, churn_risk_label
        FROM conversation_tickets t LEFT JOIN churn USING (property_id)
    """,
    "documents_text": f"""
        SELECT ticket_id, property_id, {_filled('service_category')} AS service_category,
          {_filled('churn_risk_label')} AS churn_risk,
          trim({_PAGE}, {_BLANKS}) AS page_content
        FROM labelled
    """,
    "asked": f"""
        SELECT question, count(*) AS times_asked, sha256(question) AS query_id FROM (
          SELECT trim(question, {_BLANKS}) AS question FROM questions)
        WHERE question <> '' GROUP BY question
    """,
    "tokens": r"""
        SELECT side, id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM (
          SELECT 'd' AS side, ticket_id::VARCHAR AS id, page_content AS text FROM documents_text
          UNION ALL SELECT 'q', query_id, question FROM asked)
    """,
    "term_hashes": _hashed("tokens", "term", tail_as_word=True),
    "frequencies": f"""
        SELECT side, id, ((hash % {DIMENSIONS}) + {DIMENSIONS}) % {DIMENSIONS} AS dimension, count(*) AS tf
        FROM tokens JOIN term_hashes USING (term) GROUP BY ALL
    """,
    "rarity": """
        SELECT dimension, ln(((SELECT count(*) FROM documents_text) + 1.0)::DOUBLE / (count(*) + 1.0)::DOUBLE) AS idf
        FROM frequencies WHERE side = 'd' GROUP BY dimension
    """,
    "weights": """
        SELECT side, id, dimension, (w / norm)::FLOAT::DOUBLE AS weight FROM (
          SELECT *, sqrt(sum(w * w) OVER (PARTITION BY side, id)) AS norm FROM (
            SELECT side, id, dimension,
              tf * coalesce(idf, ln(((SELECT count(*) FROM documents_text) + 1.0)::DOUBLE)) AS w
            FROM frequencies LEFT JOIN rarity USING (dimension)))
        WHERE norm > 0 AND w <> 0
    """,
    "norms": "SELECT side, id, sum(weight * weight) AS norm FROM weights GROUP BY side, id",
    "hits": f"""
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d2, 12), ticket_id) AS position FROM (
            SELECT q.query_id, d.ticket_id, coalesce(qn.norm, 0) + coalesce(dn.norm, 0) - 2 * coalesce(p.dot, 0) AS d2
            FROM asked q CROSS JOIN documents_text d
            LEFT JOIN norms qn ON qn.side = 'q' AND qn.id = q.query_id
            LEFT JOIN norms dn ON dn.side = 'd' AND dn.id = d.ticket_id::VARCHAR
            LEFT JOIN (SELECT a.id AS query_id, b.id AS ticket, sum(a.weight * b.weight) AS dot
                FROM weights a JOIN weights b USING (dimension) WHERE a.side = 'q' AND b.side = 'd'
                GROUP BY a.id, b.id) p
              ON p.query_id = q.query_id AND p.ticket = d.ticket_id::VARCHAR))
        WHERE position <= {fv.RETRIEVAL_K}
    """,
    "contexts": f"""
        SELECT query_id, string_agg(page_content, {_text(fv.CONTEXT_SEPARATOR)} ORDER BY position) AS context
        FROM hits JOIN documents_text USING (ticket_id) GROUP BY query_id
    """,
    "state": f"""
        SELECT question, times_asked, intent, sql_result,
          {_text(RAG_INSTRUCTION + chr(10) * 2 + 'Context:' + chr(10))} || context
            || {_text(chr(10) * 2 + 'Question: ')} || question || {_text(chr(10) * 2 + 'Answer:' + chr(10))}
            AS rag_prompt,
          {_text(REPORT_INSTRUCTION + chr(10) + chr(10).join(s + ':' for s in fv.REPORT_SECTIONS)
                 + chr(10) * 2 + 'Question:' + chr(10))} || question
            || {_text(chr(10) * 2 + 'Findings:' + chr(10))} || sql_result
            || {_text(chr(10) * 2 + 'Complaint records:' + chr(10))} || context AS recommendation_prompt
        FROM (
          SELECT question, times_asked, a.intent, coalesce(sql_result, {_text(fv.FALLBACK_ANSWER)}) AS sql_result,
            coalesce(context, '') AS context
          FROM (SELECT *, {_intent('question')} AS intent FROM asked) a
          LEFT JOIN texts ON texts.intent = a.intent
          LEFT JOIN contexts ON contexts.query_id = a.query_id)
    """,
    "label_centroids": """
        SELECT label AS query_id, dimension, avg(value) AS value FROM (
          SELECT label, unnest(embedding)::DOUBLE AS value, unnest(range(len(embedding))) AS dimension
          FROM embeddings) GROUP BY ALL
    """,
    "overall_centroid": """
        SELECT 0 AS query_id, dimension, avg(value) AS value FROM (
          SELECT unnest(embedding)::DOUBLE AS value, unnest(range(len(embedding))) AS dimension
          FROM embeddings) GROUP BY ALL
    """,
    "questions": f"""
        SELECT conv_id * {adapters.TURNS} + turn AS question_id,
          {_pick(adapters.MODES, f'(conv_id + turn) % {len(adapters.MODES)}')} AS mode, text AS question
        FROM conversations WHERE role = 'user'
        UNION ALL
        SELECT -1 - event_id, {_pick(adapters.MODES, f'event_id % {len(adapters.MODES)}')},
          {_pick(adapters.QUESTIONS, f'event_id % {len(adapters.QUESTIONS)}')}
        FROM events
    """,
    "requests": f"""
        SELECT question_id, mode, question, intent, {_ROUTE} AS route,
        mode <> {_text(fv.MODE_RAG)} AS returns_findings, {_ROUTE} <> 'sql' AS returns_context,
        {_ROUTE} = 'full' AS returns_report,
        CASE WHEN mode <> {_text(fv.MODE_RAG)} AND intent IS NULL THEN {_text(fv.FALLBACK_ANSWER)} END AS fixed_answer
        FROM (SELECT *, {_intent('question')} AS intent FROM questions)
    """,
}


def _knn(centroids: str) -> str:
    return f"""
        SELECT query_id, vec_id, round(d2, 6) AS d2, position::INTEGER AS position FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d2, 12), vec_id) AS position FROM (
            SELECT query_id, vec_id,
              list_sum(list_transform(list_zip(embedding, vector),
                lambda p: (p[1]::DOUBLE - p[2]) * (p[1]::DOUBLE - p[2]))) AS d2
            FROM embeddings, (SELECT query_id, list(value ORDER BY dimension) AS vector
                FROM {centroids} GROUP BY query_id)))
        WHERE position <= {fv.RETRIEVAL_K}
    """




def _kpi(group: str, source: str) -> str:
    also = f"{group}, " if group else ""
    return f"""SELECT {also}revenue_at_risk, high_risk_count, round(avg_csat, 6) AS avg_csat,
          round(avg_missed, 6) AS avg_missed_pickups, {_dollars('revenue_at_risk')} AS revenue_text,
          printf('%.2f', avg_csat) || ' / 5.0' AS csat_text, printf('%.1f', avg_missed) AS missed_text
        FROM (SELECT {also}coalesce(sum((CASE WHEN churn_risk_label = 'high' THEN contract_value END)::DECIMAL(18,2))::DOUBLE, 0) AS revenue_at_risk,
          count(*) FILTER (WHERE churn_risk_label = 'high') AS high_risk_count, {_mean('avg_csat')} AS avg_csat,
          avg(missed_pickups_30d) AS avg_missed {source})"""


_LEADERBOARD = """SELECT property_name AS "Property Name", churn_risk_label AS "Risk Level",
    complaint_count AS "Complaints", avg_csat AS "CSAT Score", missed_pickups_30d AS "Missed Pickups",
    contract_value AS "Contract Revenue ($)", strftime(renewal_date, '%Y-%m-%d') AS "Renewal Date" FROM churn"""

_CHURN_TYPES = [
    ("property_id", "string"), ("property_name", "string"), ("complaint_count", "bigint"),
    ("avg_csat", "double"), ("missed_pickups_30d", "int"), ("contract_value", "double"),
    ("renewal_date", "date"), ("churn_risk_label", "string"),
]

_BASE = """SELECT property_id, property_name, property_type, service_category, count(*) AS tickets,
    sum(csat_score)::BIGINT AS csat_sum, count(csat_score) AS csat_count,
    {hours} AS hours_sum, count(resolution_time_hours) AS hours_count,
    sum(contract_value)::BIGINT AS contract_sum, count(contract_value) AS contract_count,
    max(missed_pickups_30d) AS missed_pickups, max(renewal_date) AS renewal_date
    FROM silver GROUP BY property_id, property_name, property_type, service_category"""

_SEARCH_LABELS = ", ".join(_text(r) for r in SEARCH_RISKS)

_SHOWN = f"""churn_risk_label IN ({_SEARCH_LABELS})
    AND contains(lower(property_name), lower({_text(SEARCH_TEXT)}))"""

SELECTS = {
    "bronze_csv_scan": "SELECT * FROM tickets",
    "bronze_table_roundtrip": "SELECT * FROM tickets",
    "silver_scan": "SELECT * FROM silver",
    "silver_stream": "SELECT * FROM silver",
    "gold_table_roundtrip": "SELECT * FROM service",
    "catalog_tables": """SELECT 'gold_churn_risk' AS table_name, (SELECT count(*) FROM churn) AS row_count
        UNION ALL SELECT 'gold_service_performance', (SELECT count(*) FROM service)
        UNION ALL SELECT 'gold_property_health', (SELECT count(*) FROM health)""",
    "describe_gold": " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, '{t}' AS data_type, count({c}) AS value_count FROM churn"
        for c, t in _CHURN_TYPES
    ),
    "sql_text": "SELECT service_category, churn_risk_label, count(*) AS tickets FROM silver GROUP BY ALL",
    "rag_export_roundtrip": f"SELECT {', '.join(fv.RAG_COLUMNS)} FROM labelled",
    "rag_source_scan": """SELECT property_id, service_category, churn_risk_label, count(*) AS tickets
        FROM silver GROUP BY ALL""",
    "vector_roundtrip": """SELECT vec_id, label, unnest(range(len(embedding)))::INTEGER AS dimension,
        unnest(embedding)::DOUBLE AS value FROM embeddings""",
    "vector_scan": """SELECT vec_id, label, len(embedding)::INTEGER AS dimensions,
        round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS squared_norm
        FROM embeddings""",
    "row_counts": """SELECT 'silver' AS table_name, (SELECT count(*) FROM silver) AS row_count
        UNION ALL SELECT 'gold_churn_risk', (SELECT count(*) FROM churn)
        UNION ALL SELECT 'gold_service_performance', (SELECT count(*) FROM service)
        UNION ALL SELECT 'gold_property_health', (SELECT count(*) FROM health)""",
    "silver_rename": f"SELECT {', '.join(_SILVER[:11])} FROM silver",
    **{
        f"silver_{key}": f"SELECT ticket_id, property_id, {column} FROM silver"
        for key, column in [
            ("property_name", "property_name"), ("contract_value", "contract_value"),
            ("missed_pickups", "missed_pickups_30d"), ("renewal_date", "renewal_date"),
            ("service_category", "service_category"), ("churn_label", "churn_risk_label"),
        ]
    },
    "lookup_join_category": "SELECT ticket_id, issue_type, service_category FROM silver",
    "rag_projection": f"SELECT {', '.join(fv.RAG_COLUMNS)} FROM silver",
    "base_aggregate": _BASE.format(hours="round(sum(resolution_time_hours), 6)"),
    "gold_churn_risk": "SELECT * FROM churn",
    "gold_incremental": "SELECT * FROM churn",
    "gold_snapshot": "SELECT * FROM churn",
    "gold_churn_from_base": "SELECT * FROM churn",
    "gold_property_health": "SELECT * FROM health",
    "gold_service_performance": "SELECT * FROM service",
    "gold_service_from_base": "SELECT * FROM service",
    "bronze_null_profile": "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
        for c in ["ticket_id", "customer_id", "customer_segment", "sla_plan", "initial_message",
                  "agent_first_reply", "resolution_summary", "customer_sentiment", "issue_type", "csat_score",
                  "resolution_time_hours"]
    )
    + " FROM tickets",
    "gold_duplicate_check": """SELECT property_id, count(*) AS records FROM churn
        GROUP BY property_id HAVING count(*) > 1""",
    "name_duplicate_check": """SELECT property_name, count(*) AS records FROM churn
        GROUP BY property_name HAVING count(*) > 1""",
    "preview": "SELECT * FROM silver ORDER BY ticket_id LIMIT 10",
    "intent_high_churn": "SELECT * REPLACE (position::INTEGER AS position) FROM r_high_churn",
    "portfolio_ranks": _numbered(
        "property_id, property_name, churn_risk_label, complaint_count, avg_csat", "churn",
        "complaint_count DESC, property_id", n=None,
    ),
    "intent_low_csat": "SELECT * REPLACE (position::INTEGER AS position) FROM r_low_csat",
    "intent_missed_pickups": "SELECT * REPLACE (position::INTEGER AS position) FROM r_missed",
    "intent_contract_at_risk": "SELECT * REPLACE (position::INTEGER AS position) FROM r_contract",
    "intent_service_performance": """SELECT * REPLACE (position::INTEGER AS position,
        round(avg_csat, 6) AS avg_csat, round(avg_resolution_time, 6) AS avg_resolution_time) FROM r_service""",
    "intent_property_health": """SELECT * REPLACE (position::INTEGER AS position,
        round(avg_csat, 6) AS avg_csat) FROM r_health""",
    "intent_renewal": "SELECT * REPLACE (position::INTEGER AS position) FROM r_renewal",
    "renewal_window": "SELECT * REPLACE (position::INTEGER AS position) FROM ("
    + _numbered(
        "property_id, property_name, renewal_date, churn_risk_label, contract_value, avg_csat", "churn",
        "renewal_date ASC, property_id",
        where=f"renewal_date BETWEEN {AS_OF} AND {AS_OF} + {fv.RENEWAL_NOTICE_DAYS}",
    )
    + ")",
    "service_performance_deduped": """
        SELECT service_category, count(*) AS total_complaints,
          round(avg(csat_score)::DECIMAL(18,8), 6)::DOUBLE AS avg_csat,
          round(avg(resolution_time_hours)::DECIMAL(18,8), 6)::DOUBLE AS avg_resolution_time,
          (SELECT sum(m)::BIGINT FROM (SELECT max(missed_pickups_30d) AS m FROM silver i
            WHERE i.service_category = silver.service_category GROUP BY property_id)) AS total_missed_pickups
        FROM silver GROUP BY service_category""",
    "answer_lines": "SELECT * FROM lines",
    "answer_texts": "SELECT * FROM texts",
    "kpi_cards": _kpi("", "FROM churn"),
    "alert_urgent_renewals": f"""SELECT *, {_dollars('renewing_revenue')} AS renewing_revenue_text FROM (
        SELECT count(*) AS renewing_count, coalesce(sum(contract_value::DECIMAL(18,2))::DOUBLE, 0) AS renewing_revenue
        FROM churn WHERE churn_risk_label = 'high' AND renewal_date <= {AS_OF} + {fv.RENEWAL_NOTICE_DAYS})""",
    "alert_lowest_csat": """SELECT property_id, property_name, avg_csat, missed_pickups_30d FROM churn
        ORDER BY avg_csat ASC NULLS LAST, property_id LIMIT 1""",
    "alert_bottleneck": """SELECT (SELECT service_category FROM service_sums
          ORDER BY total_complaints DESC, service_category LIMIT 1) AS service_category,
        max(total_complaints) AS total_complaints, round(avg(avg_resolution_time), 6) AS avg_resolution_time
        FROM service_sums""",
    "dashboard_churn": """SELECT property_name, churn_risk_label, complaint_count, avg_csat, missed_pickups_30d,
        contract_value, strftime(renewal_date, '%Y-%m-%d') AS renewal_date FROM churn""",
    "dash_health": "SELECT * REPLACE (round(avg_csat, 6) AS avg_csat) FROM health_sums",
    "dash_filtered": f"SELECT * FROM churn WHERE churn_risk_label IN ({_SEARCH_LABELS})",
    "dash_name_search": f"SELECT * FROM churn WHERE {_SHOWN}",
    "dash_risk_distribution": "SELECT churn_risk_label, count(*) AS count FROM churn GROUP BY churn_risk_label",
    "dash_category_bars": "SELECT service_category, total_complaints FROM service_sums",
    "dash_scatter": """SELECT missed_pickups_30d, avg_csat, contract_value, churn_risk_label, property_name
        FROM churn""",
    "dash_missed_series": "SELECT property_name, missed_pickups_30d FROM churn",
    "dash_leaderboard": _LEADERBOARD,
    "dash_leaderboard_filtered": f"{_LEADERBOARD} WHERE {_SHOWN}",
    "dash_scatter_filtered": f"""SELECT missed_pickups_30d, avg_csat, contract_value, churn_risk_label, property_name
        FROM churn WHERE {_SHOWN}""",
    "fallback_property_name": f"""SELECT property_id, {_FALLBACK_NAME} AS property_name
        FROM (SELECT property_id, {_ID_DIGITS} AS d FROM ids)""",
    "fallback_property_type": f"""SELECT *, {_fallback_type('property_name')} AS property_type FROM (
        SELECT property_id, {_FALLBACK_NAME} AS property_name
        FROM (SELECT property_id, {_ID_DIGITS} AS d FROM ids))""",
    "fallback_churn": f"""SELECT complaint_count, churn_risk_label, {_FALLBACK_NAME} AS property_name FROM (
        SELECT property_id, count(*) AS complaint_count,
          arg_min(lower(coalesce(churn_risk_label, 'medium')), ticket_id) AS churn_risk_label,
          {_ID_DIGITS} AS d FROM silver GROUP BY property_id)""",
    "fallback_service_counts": """SELECT service_category, count(*) AS total_complaints
        FROM conversation_tickets WHERE service_category IS NOT NULL GROUP BY service_category""",
    "fallback_service_counts_filled": f"""SELECT coalesce(service_category, {_text(fv.FALLBACK_CATEGORY)})
        AS service_category, count(*) AS total_complaints FROM conversation_tickets GROUP BY 1""",
    "fallback_pickup_share": f"""SELECT service_category, count(*) AS total_complaints,
        trunc((SELECT sum(missed_pickups_30d) FROM churn)::DOUBLE * CASE {_SHARE_ARMS}
          ELSE {fv.OTHER_PICKUP_SHARE}::DOUBLE END)::INTEGER AS total_missed_pickups
        FROM silver GROUP BY service_category""",
    "fallback_health": f"""SELECT property_name, {_fallback_type('property_name')} AS property_type,
        complaint_count AS total_complaints, avg_csat, missed_pickups_30d AS total_missed_pickups FROM churn""",
    "rag_fill_nulls": "SELECT ticket_id, property_id, "
    + ", ".join(f"{_filled(c)} AS {c}" for c in fv.RAG_NULL_DEFAULTS)
    + " FROM labelled",
    "rag_documents": "SELECT ticket_id, page_content FROM documents_text",
    "rag_metadata": " UNION ALL ".join(
        f"SELECT ticket_id, '{c}' AS name, {c} AS value FROM documents_text"
        for c in ["property_id", "service_category", "churn_risk"]
    ),
    "embed_documents": """SELECT id::BIGINT AS ticket_id, dimension::INTEGER AS dimension, round(weight, 6) AS weight
        FROM weights WHERE side = 'd'""",
    "embed_with_model": """SELECT ticket_id, d::INTEGER AS dimension,
        (length(page_content) - length(replace(page_content, chr(97 + d::INTEGER), '')))::DOUBLE AS weight
        FROM documents_text, range(26) letters(d)""",
    "knn_top5": _knn("overall_centroid"),
    "knn_batch": _knn("label_centroids"),
    "knn_blocks": _knn("label_centroids"),
    "knn_cells": _knn("label_centroids"),
    "knn_text": """SELECT query_id, position::INTEGER AS position, ticket_id, round(d2, 6) AS d2 FROM hits""",
    "knn_preview": f"""SELECT query_id, position::INTEGER AS position,
        substr(page_content, 1, {fv.PREVIEW_CHARS}) AS preview, property_id, service_category, churn_risk
        FROM hits JOIN documents_text USING (ticket_id)""",
    "rag_context": "SELECT query_id, context FROM contexts",
    "rag_prompt": "SELECT question, rag_prompt FROM state",
    "recommendation_prompt": "SELECT question, recommendation_prompt FROM state",
    "question_state": "SELECT * FROM state",
    "evidence_join": """SELECT r.position::INTEGER AS position, r.property_id, r.property_name, t.ticket_id,
        t.complaint_description, t.resolution_notes FROM silver t JOIN r_high_churn r USING (property_id)""",
    "properties_without_complaints": """SELECT property_id, property_name, churn_risk_label FROM churn
        WHERE property_id NOT IN (SELECT property_id FROM conversation_tickets)""",
    "properties_with_complaints": """SELECT property_id, property_name, churn_risk_label FROM churn
        WHERE property_id IN (SELECT property_id FROM conversation_tickets)""",
    "route_can_handle": f"SELECT question_id, ({_intent('question')}) IS NOT NULL AS can_handle FROM questions",
    "route_intent": f"SELECT question_id, question, {_intent('question')} AS intent FROM questions",
    "route_mode": "SELECT * EXCLUDE (question) FROM requests",
    "request_answers": f"""SELECT question_id, mode, route,
        CASE WHEN returns_findings THEN coalesce(sql_result, {_text(fv.FALLBACK_ANSWER)}) END AS findings,
        CASE WHEN returns_context THEN rag_prompt END AS rag_prompt,
        CASE WHEN returns_report THEN recommendation_prompt END AS recommendation_prompt
        FROM requests LEFT JOIN state ON state.question = trim(requests.question, {_BLANKS})""",
    "bronze_csv_by_name": "SELECT *, 'batch ' || ticket_id % 3 AS batch FROM tickets",
    "bronze_csv_rejects": """SELECT CASE WHEN ticket_id % 13 = 5 THEN 'rejected' ELSE 'kept' END AS outcome,
        count(*) AS tickets, sum(ticket_id)::BIGINT AS id_sum,
        count(CASE WHEN ticket_id % 13 <> 5 THEN csat_score END) AS scores FROM tickets GROUP BY 1""",
    "silver_quarantine": """SELECT ticket_id, 'BAD_' || customer_id AS customer_id FROM tickets WHERE ticket_id % 17 = 3""",
    "silver_lenient": """SELECT ticket_id, property_name FROM silver WHERE ticket_id % 17 <> 3
        UNION ALL SELECT ticket_id, NULL FROM silver WHERE ticket_id % 17 = 3""",
    "kpi_by_name": _kpi("property_name", "FROM churn GROUP BY property_name"),
    "kpi_no_match": f"""SELECT 0::DOUBLE AS revenue_at_risk, 0::BIGINT AS high_risk_count, NULL::DOUBLE AS avg_csat,
        NULL::DOUBLE AS avg_missed_pickups, '$0' AS revenue_text, '{fv.NO_FIGURE} / 5.0' AS csat_text,
        '{fv.NO_FIGURE}' AS missed_text""",
    "fallback_churn_from_export": f"""SELECT complaint_count, churn_risk_label, {_FALLBACK_NAME} AS property_name FROM (
        SELECT property_id, count(*) AS complaint_count,
          arg_min(lower(coalesce(churn_risk_label, 'medium')), ticket_id) AS churn_risk_label,
          {_ID_DIGITS} AS d FROM silver GROUP BY property_id)""",
    "index_roundtrip": "SELECT query_id, position::INTEGER AS position, ticket_id, page_content FROM hits JOIN documents_text USING (ticket_id)",
}


def _needed(text: str) -> list[str]:
    """Sub-queries a text uses, those they use first."""
    found: list[str] = []

    def visit(sql: str) -> None:
        plain = re.sub(r"'[^']*'", "''", sql)
        for name, body in RELATIONS.items():
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", plain):
                visit(body)
                if name not in found:
                    found.append(name)

    visit(text)
    return found


def _query(text: str) -> str:
    names = _needed(text)
    if not names:
        return text.strip()
    parts = ",\n".join(f"{n} AS ({RELATIONS[n].strip()})" for n in names)
    return f"WITH {parts}\n{text.strip()}"


ORACLES = {name: _query(text) for name, text in SELECTS.items()}
