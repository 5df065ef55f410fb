"""DuckDB oracle SQL for every ``queries()`` key.

Each query is written independently of the Spark code, as plain SQL over the
driver's raw tables: the source binding and each cascade step are CTEs.
Only the rule lists (fixed values) are shared with the Spark side; they are
rendered into ``CASE`` expressions here. Where the Spark side uses a scaled
form (range frame for the 180-day look-back, member weights for the
goal-by-call counts, one pass over all periods), the SQL uses the direct
form (band join, many-to-many join, one period at a time), so the two
cross-check each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from tierwise.functions import rules as R
from tierwise.sources import binding as B

from .params import AS_OF, CUSTOMER, REPORT_END, REPORT_START, period_bounds

# ---------------------------------------------------------------------------
# SQL rendering helpers
# ---------------------------------------------------------------------------


def q(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def in_list(values: Sequence[str | int]) -> str:
    return ", ".join(q(v) if isinstance(v, str) else str(v) for v in values)


def case(pairs: Sequence[tuple[str, str]], default: str = "NULL") -> str:
    body = " ".join(f"WHEN {t} THEN {v}" for t, v in pairs)
    return f"CASE {body} ELSE {default} END"


def pick(index: str, values: Sequence[str | None]) -> str:
    return "CASE " + " ".join(f"WHEN {index} = {i} THEN {q(v)}" for i, v in enumerate(values)) + " END"


def eq_rules(col: str, groups) -> list[tuple[str, str]]:
    return [(f"{col} IN ({in_list(values)})", q(label)) for label, values in groups]


def kw_rules(col: str, groups) -> list[tuple[str, str]]:
    return [("(" + " OR ".join(f"contains({col}, {q(w)})" for w in words) + ")", q(label))
            for label, words in groups]


def code_case(col: str, pairs) -> str:
    return case([(f"{col} = {code}", q(label)) for code, label in pairs])


def pct(n: str, d: str, scale: int) -> str:
    unit = 10 ** scale
    num = f"(CAST({n} AS BIGINT) * {200 * unit} + NULLIF(CAST({d} AS BIGINT), 0))"
    den = f"(2 * NULLIF(CAST({d} AS BIGINT), 0))"
    return f"((({num} - {num} % {den}) / {den}) / CAST({unit} AS DOUBLE))"


def rank(col: str, order: Sequence[str]) -> str:
    return case([(f"{col} = {q(v)}", str(i + 1)) for i, v in enumerate(order)], str(len(order) + 1))


def norm(col: str) -> str:
    return f"upper(trim({col}))"


def with_ctes(ctes: Sequence[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes) + "\n" + final


def d(value) -> str:
    return f"DATE '{value}'"


# ---------------------------------------------------------------------------
# Source binding (FIXTURES.md §2)
# ---------------------------------------------------------------------------


def _acct(k: str, prefix: str = "A") -> str:
    return f"'{prefix}' || CAST({k} - {k} % 5 AS VARCHAR)"


def _guid(k: str) -> str:
    return f"'G' || CAST({k} AS VARCHAR)"


CUST = "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'CUST_A' ELSE 'cust_b' END"


def _minutes(k: str) -> str:
    return f"to_minutes(CAST({k} % 1440 AS BIGINT))"


SOURCES = [
    ("mc", f"""SELECT {_acct('o_custkey')} AS ACCOUNT, {_guid('o_custkey')} AS GUID,
  CASE WHEN o_custkey % 10 = 7 THEN {_guid('(o_custkey - 1)')} END AS DERIVED_GUID,
  {CUST} AS CUSTOMERID,
  COALESCE({pick('o_orderkey % 11', B.CALL_DESCRIPTIONS)}, {q(B.CALL_DESCRIPTION_OTHER)}) AS DESCRIPTION,
  o_orderdate + {_minutes('o_orderkey')} AS ENCOUNTERDATETIME,
  CASE WHEN o_orderstatus = 'P' THEN 'Unsuccessful' ELSE 'Successful' END AS CALL_STATUS,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Inbound' WHEN o_orderpriority = '2-HIGH' THEN 'Internal'
       ELSE 'outbound' END AS DIRECTION
FROM orders JOIN customer ON o_custkey = c_custkey"""),
    ("xref", "SELECT * FROM (VALUES " + ", ".join(
        "(" + ", ".join(q(v) for v in row) + ")" for row in B.CALLTYPE_XREF_ROWS)
     + ") AS t(CALL_DESCRIPTIONS, PPPY_BILL_ELIG, INTERACTION_ELIG)"),
    ("ce", f"""SELECT {_acct('c_custkey')} AS ACCOUNT, {_acct('c_custkey', 'M')} AS CURRENTGUID,
  {_guid('c_custkey')} AS GUID, {CUST} AS CUSTOMERID, c_mktsegment AS OFFERING_NAME,
  CASE WHEN c_custkey % 6 = 5 THEN 'Engaged' ELSE 'Enrolled' END AS LEVEL_NAME,
  CASE WHEN c_custkey % 9 = 8 THEN 'Closed' ELSE 'Enrolled' END AS OFFERING_STATUS,
  {d(B.ENROLLMENT_EPOCH)} + CAST(c_custkey % 1500 AS INTEGER) AS BIEFFECTIVEDATE,
  {d(B.ENROLLMENT_EPOCH)} + CAST(c_custkey % 1500 AS INTEGER) + {B.ENROLLMENT_SPAN_DAYS} AS BIENDDATE
FROM customer"""),
    ("elig", f"""SELECT CASE WHEN c_custkey % 23 = 22 THEN 'N' || CAST(c_custkey AS VARCHAR) ELSE {_guid('c_custkey')} END AS GUID, {_acct('c_custkey', 'M')} AS CURRENTGUID,
  CASE WHEN c_custkey % 50 = 10 THEN 'xFep01' ELSE 'ORG' END AS ORGUNITID, {CUST} AS CUSTOMERID
FROM customer"""),
    ("lmn", f"""SELECT {_acct('o_custkey')} AS ACCOUNT,
  CASE WHEN l_partkey % 4 <> 3 OR l_linenumber = 1 THEN {pick('l_suppkey % 6', B.LM_QUESTION_BY_SUPP6)}
       ELSE {q(B.OTHER_QUESTION)} END AS QUESTION_ID,
  (CASE WHEN l_linenumber % 2 = 1 THEN o_orderdate ELSE l_shipdate END) + {_minutes('l_partkey')} AS RESPONSE_DATE,
  CASE WHEN l_suppkey % 6 = 0 THEN {pick('l_partkey % 8', B.FORM_V1_ANSWERS)}
       WHEN l_suppkey % 6 = 1 THEN {pick('l_partkey % 6', B.FORM_V2_ANSWERS)}
       ELSE {pick('l_partkey % 16', B.NOTE_TEXTS)} END AS RESPONSE_TEXT
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    ("dmn", f"""SELECT {_acct('o_custkey')} AS ACCOUNT,
  CASE WHEN l_partkey % 9 = 0 THEN {pick('l_suppkey % 2', B.DM_QUESTION_BY_SUPP2)}
       ELSE {q(B.OTHER_QUESTION)} END AS QUESTION_ID,
  o_orderdate + {_minutes('l_partkey')} AS RESPONSE_DATE,
  CASE WHEN l_suppkey % 2 = 0 THEN {pick('l_partkey % 4', B.DM_FOCUS_ANSWERS)}
       ELSE {pick('l_partkey % 16', B.NOTE_TEXTS)} END AS RESPONSE_TEXT
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    ("ma", f"""SELECT {_acct('o_custkey')} AS ACCOUNT,
  ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS MemberAction_ID,
  CAST(CASE WHEN l_linenumber <= 2 THEN 1 + l_suppkey % 4 ELSE 4 + l_suppkey % 4 END AS INTEGER) AS ActionType_ID, CAST(1 + l_partkey % 5 AS INTEGER) AS ActionStatus_ID,
  CAST(l_suppkey % 12 AS INTEGER) AS FocusArea_ID, {pick('l_partkey % 31', B.ACTION_NAMES)} AS Action_Name,
  CAST(l_shipdate AS DATE) AS Action_Date,
  CASE WHEN l_partkey % 5 >= 2 THEN CAST(l_shipdate AS DATE) + 30 END AS Close_Date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
]

# ---------------------------------------------------------------------------
# Cascade steps
# ---------------------------------------------------------------------------

ENROLLED_TEST = f"upper(OFFERING_STATUS) = '{R.ENROLLED}' AND upper(LEVEL_NAME) = '{R.ENROLLED}'"
TIER2 = in_list(R.TIER2_CALL_TYPES)
USABLE = (f"RESPONSE_TEXT IS NOT NULL AND length(trim(RESPONSE_TEXT)) > {R.MIN_TEXT_LENGTH} "
          f"AND {norm('RESPONSE_TEXT')} NOT IN ({in_list(R.JUNK_TEXTS)})")


def _answer_case(col: str, default: str) -> str:
    return case(eq_rules(f"upper({col})", R.ANSWER_CATEGORIES), default)


def cascade(variant: str, call_filter: str | None = None) -> list[tuple[str, str]]:
    refresh = variant == "refresh"
    ctes = list(SOURCES)
    if refresh:
        ctes.append(("enrolled", f"""SELECT DISTINCT ACCOUNT, CURRENTGUID, GUID, CUSTOMERID, OFFERING_NAME, BIEFFECTIVEDATE, BIENDDATE
FROM ce
WHERE {ENROLLED_TEST}
  AND NOT EXISTS (SELECT 1 FROM elig f WHERE f.CURRENTGUID = ce.CURRENTGUID AND upper(f.ORGUNITID) ILIKE '{R.FEP_PATTERN}')"""))
        enrollment = "enrolled"
    else:
        ctes.append(("enrolled_any", f"SELECT * FROM ce WHERE {ENROLLED_TEST}"))
        enrollment = "enrolled_any"
    extra = f" AND ({call_filter})" if call_filter else ""
    ctes.append(("calls", f"""SELECT ACCOUNT, GUID, CUSTOMERID, CALL_TYPE, CALL_DATE FROM (
  SELECT m.ACCOUNT, coalesce(m.DERIVED_GUID, m.GUID) AS GUID, m.CUSTOMERID, trim(m.DESCRIPTION) AS CALL_TYPE,
         CAST(m.ENCOUNTERDATETIME AS DATE) AS CALL_DATE, m.ENCOUNTERDATETIME AS TS
  FROM mc m
  WHERE upper(m.CALL_STATUS) = '{R.SUCCESSFUL_STATUS}'
    AND upper(m.DIRECTION) IN ({in_list(R.CALL_DIRECTIONS)})
    AND {norm('m.DESCRIPTION')} NOT IN ({in_list(R.EXCLUDED_CALL_TYPES)})
    AND {norm('m.DESCRIPTION')} IN (SELECT {norm('CALL_DESCRIPTIONS')} FROM xref
                                      WHERE PPPY_BILL_ELIG = 'Y' OR INTERACTION_ELIG = 'Y')
    AND EXISTS (SELECT 1 FROM {enrollment} e WHERE e.ACCOUNT = m.ACCOUNT
                AND CAST(m.ENCOUNTERDATETIME AS DATE) BETWEEN e.BIEFFECTIVEDATE AND e.BIENDDATE){extra}
) s
QUALIFY row_number() OVER (PARTITION BY ACCOUNT, CALL_DATE
        ORDER BY TS DESC NULLS LAST, CALL_TYPE ASC NULLS LAST, GUID ASC NULLS LAST, CUSTOMERID ASC NULLS LAST) = 1"""))
    for name, table, questions in (("lm_day", "lmn", R.LM_TOPIC_QUESTIONS),
                                   ("dm_day", "dmn", [R.DM_TOPIC_QUESTION])):
        ctes.append((name, f"""SELECT ACCOUNT, TOPIC_DATE, RESPONSE_TEXT FROM (
  SELECT ACCOUNT, CAST(RESPONSE_DATE AS DATE) AS TOPIC_DATE, RESPONSE_TEXT,
         count(*) OVER (PARTITION BY ACCOUNT, RESPONSE_TEXT) AS FREQ
  FROM {table} WHERE QUESTION_ID IN ({in_list(questions)}) AND RESPONSE_TEXT IS NOT NULL
) s
QUALIFY row_number() OVER (PARTITION BY ACCOUNT, TOPIC_DATE ORDER BY FREQ DESC, RESPONSE_TEXT ASC) = 1"""))
    ctes.append(("no_t1", """SELECT c.* FROM calls c
WHERE NOT EXISTS (SELECT 1 FROM lm_day l WHERE l.ACCOUNT = c.ACCOUNT AND l.TOPIC_DATE = c.CALL_DATE)
  AND NOT EXISTS (SELECT 1 FROM dm_day x WHERE x.ACCOUNT = c.ACCOUNT AND x.TOPIC_DATE = c.CALL_DATE)"""))
    keyword_topic = case(kw_rules("upper(n.RESPONSE_TEXT)", R.NOTE_KEYWORDS))
    ctes.append(("text_day", f"""SELECT ACCOUNT, TOPIC_DATE, INFERRED_TOPIC FROM (
  SELECT n.ACCOUNT, CAST(n.RESPONSE_DATE AS DATE) AS TOPIC_DATE, {keyword_topic} AS INFERRED_TOPIC,
         CASE WHEN n.QUESTION_ID = '{R.DETAIL_QUESTION}' THEN 1 ELSE 2 END AS SRC_PRI
  FROM lmn n JOIN no_t1 c ON c.ACCOUNT = n.ACCOUNT AND c.CALL_DATE = CAST(n.RESPONSE_DATE AS DATE)
  WHERE n.QUESTION_ID IN ('{R.DETAIL_QUESTION}', '{R.LONG_TERM_GOAL_QUESTION}')
    AND {USABLE.replace('RESPONSE_TEXT', 'n.RESPONSE_TEXT')}
    AND {norm('c.CALL_TYPE')} NOT IN ({TIER2})
  UNION ALL
  SELECT n.ACCOUNT, CAST(n.RESPONSE_DATE AS DATE), '{R.DM_TOPIC}', 3
  FROM dmn n JOIN no_t1 c ON c.ACCOUNT = n.ACCOUNT AND c.CALL_DATE = CAST(n.RESPONSE_DATE AS DATE)
  WHERE n.QUESTION_ID = '{R.DM_GOAL_QUESTION}'
    AND {USABLE.replace('RESPONSE_TEXT', 'n.RESPONSE_TEXT')}
    AND {norm('c.CALL_TYPE')} NOT IN ({TIER2})
) s
WHERE INFERRED_TOPIC IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY ACCOUNT, TOPIC_DATE ORDER BY SRC_PRI, INFERRED_TOPIC) = 1"""))
    ctes.append(("prior_day", f"""SELECT c.ACCOUNT, c.CALL_DATE, n.RESPONSE_TEXT AS PRIOR_RESPONSE_TEXT
FROM no_t1 c JOIN lmn n
  ON n.ACCOUNT = c.ACCOUNT
 AND CAST(n.RESPONSE_DATE AS DATE) BETWEEN c.CALL_DATE - {R.PRIOR_LOOKBACK_DAYS} AND c.CALL_DATE - 1
WHERE n.QUESTION_ID IN ({in_list(R.LM_TOPIC_QUESTIONS)})
  AND {norm('c.CALL_TYPE')} NOT IN ({TIER2})
  AND NOT EXISTS (SELECT 1 FROM text_day t WHERE t.ACCOUNT = c.ACCOUNT AND t.TOPIC_DATE = c.CALL_DATE)
QUALIFY row_number() OVER (PARTITION BY c.ACCOUNT, c.CALL_DATE
        ORDER BY n.RESPONSE_DATE DESC, n.RESPONSE_TEXT ASC NULLS LAST) = 1"""))
    if refresh:
        ctes.append(("bridge", """SELECT DISTINCT c.GUID, e.CURRENTGUID FROM calls c JOIN elig e ON e.GUID = c.GUID"""))
    topic = case(
        eq_rules("upper(lm_text)", R.ANSWER_CATEGORIES)
        + [("dm_text IS NOT NULL", q(R.DM_TOPIC)), ("text_topic IS NOT NULL", "text_topic")]
        + eq_rules(norm("CALL_TYPE"), R.CALL_TYPE_TOPICS)
        + [("prior_text IS NOT NULL", _answer_case("prior_text", q(R.DEFAULT_TOPIC)))],
        q(R.DEFAULT_TOPIC))
    source = case([
        ("lm_text IS NOT NULL", q(R.TIER_LM)), ("dm_text IS NOT NULL", q(R.TIER_DM)),
        ("text_topic IS NOT NULL", q(R.TIER_TEXT)),
        (f"{norm('CALL_TYPE')} IN ({TIER2})", q(R.TIER_CALL_TYPE)),
        ("prior_text IS NOT NULL", q(R.TIER_PRIOR))], q(R.TIER_NONE))
    program = case([("lm_text IS NOT NULL", q(R.PROGRAM_LM)), ("dm_text IS NOT NULL", q(R.PROGRAM_DM))])
    member = "b.CURRENTGUID, " if refresh else ""
    bridge_join = "LEFT JOIN bridge b ON b.GUID = x.GUID" if refresh else ""
    ctes.append(("topics", f"""SELECT x.ACCOUNT, x.GUID, {member}x.CUSTOMERID, x.CALL_DATE, x.CALL_TYPE,
       coalesce(lm_text, dm_text) AS RAW_TOPIC, {topic} AS REPORT_TOPIC, {source} AS TOPIC_SOURCE,
       {program} AS PROGRAM_TYPE
FROM (
  SELECT c.*, l.RESPONSE_TEXT AS lm_text,
         CASE WHEN l.ACCOUNT IS NULL THEN m.RESPONSE_TEXT END AS dm_text,
         CASE WHEN l.ACCOUNT IS NULL AND m.ACCOUNT IS NULL THEN t.INFERRED_TOPIC END AS text_topic,
         CASE WHEN l.ACCOUNT IS NULL AND m.ACCOUNT IS NULL AND t.ACCOUNT IS NULL
              THEN p.PRIOR_RESPONSE_TEXT END AS prior_text
  FROM calls c
  LEFT JOIN lm_day l ON l.ACCOUNT = c.ACCOUNT AND l.TOPIC_DATE = c.CALL_DATE
  LEFT JOIN dm_day m ON m.ACCOUNT = c.ACCOUNT AND m.TOPIC_DATE = c.CALL_DATE
  LEFT JOIN text_day t ON t.ACCOUNT = c.ACCOUNT AND t.TOPIC_DATE = c.CALL_DATE
  LEFT JOIN prior_day p ON p.ACCOUNT = c.ACCOUNT AND p.CALL_DATE = c.CALL_DATE
) x {bridge_join}"""))
    ctes.append(("tobacco", f"""SELECT DISTINCT ACCOUNT, GUID, {'CURRENTGUID, ' if refresh else ''}'Yes' AS TOBACCO_DISCUSSED
FROM topics WHERE upper(RAW_TOPIC) = '{R.TOBACCO_WORD}' OR upper(CALL_TYPE) = '{R.TOBACCO_WORD}'"""))
    prefix = "upper(split_part(Action_Name, ':', 1))"
    domain = case(eq_rules(prefix, R.GOAL_PREFIXES)
                  + [("NOT contains(Action_Name, ':')",
                      case(kw_rules("upper(Action_Name)", R.GOAL_KEYWORDS), q(R.OTHER_DOMAIN)))],
                  q(R.OTHER_DOMAIN))
    excluded = " AND ".join(f"Action_Name NOT LIKE {q(p)}" for p in R.EXCLUDED_GOAL_PATTERNS)
    ctes.append(("goals", f"""SELECT ACCOUNT, {code_case('ActionType_ID', R.GOAL_TYPES)} AS GOAL_TYPE,
       {domain} AS GOAL_DOMAIN, {code_case('ActionStatus_ID', R.GOAL_STATUSES)} AS GOAL_STATUS,
       CASE WHEN contains(Action_Name, ':') THEN trim(substr(Action_Name, instr(Action_Name, ':') + 1))
            ELSE Action_Name END AS GOAL_DESCRIPTION,
       Action_Name AS RAW_ACTION_NAME, CAST(MemberAction_ID AS BIGINT) AS MEMBERACTION_ID,
       CAST(ActionType_ID AS BIGINT) AS ACTIONTYPE_ID, CAST(ActionStatus_ID AS BIGINT) AS ACTIONSTATUS_ID,
       CAST(FocusArea_ID AS BIGINT) AS FOCUSAREA_ID, Action_Date AS GOAL_SET_DATE, Close_Date AS GOAL_CLOSE_DATE
FROM ma
WHERE ActionType_ID IN ({in_list([c for c, _ in R.GOAL_TYPES])})
  AND ActionStatus_ID IN ({in_list(R.KEPT_GOAL_STATUS_IDS)}) AND {excluded}"""))
    rows = "enrolled" if refresh else f"(SELECT * FROM ce WHERE BIENDDATE >= {d(AS_OF)})"
    ctes.append(("goals_num", f"""SELECT g.*, e.CURRENTGUID, e.GUID,
       row_number() OVER (PARTITION BY g.ACCOUNT
            ORDER BY g.GOAL_SET_DATE ASC NULLS LAST, g.RAW_ACTION_NAME ASC NULLS LAST,
                     g.MEMBERACTION_ID ASC NULLS LAST) AS GOAL_NUMBER
FROM goals g JOIN (
  SELECT ACCOUNT, CURRENTGUID, GUID FROM {rows} r
  QUALIFY row_number() OVER (PARTITION BY ACCOUNT
          ORDER BY BIENDDATE DESC NULLS LAST, GUID ASC NULLS LAST, CURRENTGUID ASC NULLS LAST) = 1
) e ON e.ACCOUNT = g.ACCOUNT"""))
    return ctes


REFRESH = cascade("refresh")
ADHOC = cascade("adhoc")


def refresh(final: str) -> str:
    return with_ctes(REFRESH, final)


def adhoc(final: str, ctes=None) -> str:
    return with_ctes(ctes or ADHOC, final)


# ---------------------------------------------------------------------------
# Final queries per key
# ---------------------------------------------------------------------------

TOBACCO_TEST = f"(upper(RAW_TOPIC) = '{R.TOBACCO_WORD}' OR upper(CALL_TYPE) = '{R.TOBACCO_WORD}')"
STATUS_COLS_2DP = [(R.NOT_STARTED, "NOT_STARTED", "NS_PCT"), (R.IN_PROGRESS, "IN_PROGRESS", "IP_PCT"),
                   (R.COMPLETED, "COMPLETED", "COMP_PCT"), (R.WITHDRAWN, "WITHDRAWN", "WD_PCT")]


def crosstab(table: str, group: str, column: str, values, scale: int, where: str = "TRUE") -> str:
    cols = []
    for value, count_name, pct_name in values:
        n = f"sum(CASE WHEN {column} = {q(value)} THEN 1 ELSE 0 END)"
        cols.append(f"CAST({n} AS BIGINT) AS {count_name}")
        cols.append(f"{pct(n, 'count(*)', scale)} AS {pct_name}")
    return f"SELECT {group}, {', '.join(cols)} FROM {table} WHERE {where} GROUP BY {group}"


def goal_ids(alias: str, status: str) -> str:
    return f"count(DISTINCT CASE WHEN {alias}.GOAL_STATUS = {q(status)} THEN {alias}.MEMBERACTION_ID END)"


def pct_text(expr: str) -> str:
    return f"printf('%.1f%%', {expr})"


def signed(expr: str) -> str:
    return f"CASE WHEN {expr} > 0 THEN '+' || format('{{:,}}', {expr}) ELSE format('{{:,}}', {expr}) END"


def thirds(expr: str) -> str:
    return f"CAST(round(({expr}) / 3) AS BIGINT)"


def flt(prefix: str, start, end) -> str:
    return (f"upper({prefix}CUSTOMERID) = upper({q(CUSTOMER)}) AND {prefix}CALL_DATE >= {d(start)} "
            f"AND {prefix}CALL_DATE <= {d(end)}")


PERIODS = period_bounds(REPORT_START, REPORT_END)
TOB_GOAL = f"G.GOAL_DOMAIN = {q(R.TOBACCO_DOMAIN)}"


def _period_union(make) -> str:
    return "\nUNION ALL\n".join(make(p, s, e) for p, (s, e) in PERIODS.items())


def _engagement(p, s, e) -> str:
    return f"""SELECT '{p}' AS PERIOD, T.REPORT_TOPIC AS WELLBEING_TOPIC, count(DISTINCT T.CURRENTGUID) AS MEMBERS,
  {pct('count(DISTINCT T.CURRENTGUID)', 'tot.m', 1)} AS PCT_OF_MEMBERS,
  {goal_ids('G', R.COMPLETED)} AS COMPLETED_GOALS, {goal_ids('G', R.IN_PROGRESS)} AS OPEN_GOALS
FROM topics T CROSS JOIN (SELECT count(DISTINCT CURRENTGUID) AS m FROM topics WHERE {flt('', s, e)}) tot
LEFT JOIN goals_num G ON T.CURRENTGUID = G.CURRENTGUID
WHERE {flt('T.', s, e)}
GROUP BY T.REPORT_TOPIC, tot.m"""


def _goal_dist(p, s, e) -> str:
    return f"""SELECT '{p}' AS PERIOD, G.GOAL_STATUS, count(*) AS COUNT,
  {pct('count(*)', 'sum(count(*)) OVER ()', 1)} AS GOAL_PCT
FROM goals_num G JOIN topics T ON G.CURRENTGUID = T.CURRENTGUID
WHERE G.GOAL_STATUS IN ({in_list(R.REPORTED_STATUSES)}) AND {flt('T.', s, e)}
GROUP BY G.GOAL_STATUS"""


def _goal_dist_once(p, s, e) -> str:
    return f"""SELECT '{p}' AS PERIOD, G.GOAL_STATUS, count(*) AS COUNT,
  {pct('count(*)', 'sum(count(*)) OVER ()', 1)} AS GOAL_PCT
FROM goals_num G
WHERE G.GOAL_STATUS IN ({in_list(R.REPORTED_STATUSES)})
  AND G.CURRENTGUID IN (SELECT T.CURRENTGUID FROM topics T WHERE {flt('T.', s, e)})
GROUP BY G.GOAL_STATUS"""


def _goal_prog(p, s, e) -> str:
    done = f"sum(CASE WHEN G.GOAL_STATUS = {q(R.COMPLETED)} THEN 1 ELSE 0 END)"
    return f"""SELECT '{p}' AS PERIOD, G.GOAL_DOMAIN, count(*) AS TOTAL_GOALS, CAST({done} AS BIGINT) AS COMPLETED,
  {pct(done, 'count(*)', 1)} AS COMPLETION_RATE
FROM goals_num G JOIN topics T ON G.CURRENTGUID = T.CURRENTGUID
WHERE {flt('T.', s, e)}
GROUP BY G.GOAL_DOMAIN"""


def _tobacco(p, s, e) -> str:
    done = f"sum(CASE WHEN G.GOAL_STATUS = {q(R.COMPLETED)} THEN 1 ELSE 0 END)"
    m = R.TOBACCO_METRICS
    gt = "FROM goals_num G JOIN topics T ON G.CURRENTGUID = T.CURRENTGUID"
    return f"""SELECT '{p}' AS PERIOD, {q(m[0])} AS METRIC, CAST(count(DISTINCT TB.CURRENTGUID) AS VARCHAR) AS VALUE
FROM tobacco TB JOIN topics T ON TB.CURRENTGUID = T.CURRENTGUID WHERE {flt('T.', s, e)}
UNION ALL
SELECT '{p}', {q(m[1])}, CAST(count(DISTINCT G.CURRENTGUID) AS VARCHAR)
FROM tobacco TB JOIN topics T ON TB.CURRENTGUID = T.CURRENTGUID
JOIN goals_num G ON TB.CURRENTGUID = G.CURRENTGUID AND {TOB_GOAL} AND G.GOAL_STATUS = {q(R.IN_PROGRESS)}
WHERE {flt('T.', s, e)}
UNION ALL
SELECT '{p}', {q(m[2])}, CAST(count(*) AS VARCHAR) {gt}
WHERE {TOB_GOAL} AND G.GOAL_STATUS = {q(R.COMPLETED)} AND {flt('T.', s, e)}
UNION ALL
SELECT '{p}', {q(m[3])}, CAST(count(*) AS VARCHAR) {gt}
WHERE {TOB_GOAL} AND G.GOAL_STATUS = {q(R.IN_PROGRESS)} AND {flt('T.', s, e)}
UNION ALL
SELECT '{p}', {q(m[4])}, {pct_text(pct(done, 'count(*)', 1))} {gt}
WHERE {TOB_GOAL} AND G.GOAL_STATUS IN ({in_list([R.COMPLETED, R.IN_PROGRESS])}) AND {flt('T.', s, e)}"""


def _enrolled(p, s, e) -> str:
    n = "count(DISTINCT CE.CURRENTGUID)"
    avg = f"CASE WHEN '{p}' IN ('r90', 'p90') THEN {thirds(n)} END"
    return f"""SELECT '{p}' AS PERIOD, {n} AS ENROLLED_MEMBERS, {avg} AS MONTHLY_AVG
FROM ce CE
WHERE upper(CE.LEVEL_NAME) = 'ENROLLED' AND upper(CE.OFFERING_STATUS) = 'ENROLLED'
  AND CE.BIEFFECTIVEDATE <= {d(e)} AND CE.BIENDDATE >= {d(s)}
  AND upper(CE.CUSTOMERID) = upper({q(CUSTOMER)})
  AND CE.CURRENTGUID NOT IN (SELECT DISTINCT CURRENTGUID FROM elig
        WHERE upper(ORGUNITID) ILIKE '{R.FEP_PATTERN}' AND upper(CUSTOMERID) = upper({q(CUSTOMER)}))"""


L12_S, L12_E = PERIODS["l12m"]
PERIOD_CTES = REFRESH + [
    ("pe", _period_union(_engagement)),
    ("pgd", _period_union(_goal_dist)),
    ("pgp", _period_union(_goal_prog)),
    ("ptob", _period_union(_tobacco)),
]


def _pv(table: str, col: str, period: str, key: str, label: str, default: str = "0") -> str:
    return (f"coalesce((SELECT x.{col} FROM {table} x WHERE x.PERIOD = '{period}' "
            f"AND x.{key} = {label}), {default})")


def _cmp_goal_status() -> str:
    l12 = _pv("pgd", "COUNT", "l12m", "GOAL_STATUS", "s.GOAL_STATUS")
    mon = _pv("pgd", "COUNT", "month", "GOAL_STATUS", "s.GOAL_STATUS")
    pri = _pv("pgd", "COUNT", "prior_month", "GOAL_STATUS", "s.GOAL_STATUS")
    share = _pv("pgd", "GOAL_PCT", "l12m", "GOAL_STATUS", "s.GOAL_STATUS", "0.0")
    return f"""SELECT GOAL_STATUS, L12M, L12M_PCT, MONTH, PRIOR, MONTH - PRIOR AS MOM_CHANGE,
  {signed('MONTH - PRIOR')} AS MOM_CHANGE_TEXT
FROM (SELECT s.GOAL_STATUS, CAST({l12} AS BIGINT) AS L12M, CAST({share} AS DOUBLE) AS L12M_PCT,
             CAST({mon} AS BIGINT) AS MONTH, CAST({pri} AS BIGINT) AS PRIOR
      FROM (VALUES {', '.join(f'({q(v)})' for v in R.REPORTED_STATUSES)}) s(GOAL_STATUS)) z"""


def _cmp_engagement() -> str:
    cols = {p: _pv("pe", "MEMBERS", p, "WELLBEING_TOPIC", "m.WELLBEING_TOPIC")
            for p in ("l12m", "prior_month", "r90", "p90")}
    return f"""SELECT WELLBEING_TOPIC, L12M, MONTH, PRIOR, MONTH - PRIOR AS MOM_DELTA,
  {thirds('R90')} AS AVG_90D, {thirds('P90')} AS PRIOR_AVG_90D, {thirds('R90 - P90')} AS DELTA_90D,
  {signed('MONTH - PRIOR')} AS MOM_DELTA_TEXT, CASE WHEN R90 > P90 THEN '+' ELSE '' END || format('{{:,}}', {thirds('R90 - P90')}) AS DELTA_90D_TEXT
FROM (SELECT m.WELLBEING_TOPIC, CAST({cols['l12m']} AS BIGINT) AS L12M, m.MEMBERS AS MONTH,
             CAST({cols['prior_month']} AS BIGINT) AS PRIOR, CAST({cols['r90']} AS BIGINT) AS R90,
             CAST({cols['p90']} AS BIGINT) AS P90
      FROM pe m WHERE m.PERIOD = 'month') z"""


def _cmp_goal_progression() -> str:
    v = lambda col, p, dflt="0": _pv("pgp", col, p, "GOAL_DOMAIN", "m.GOAL_DOMAIN", dflt)
    return f"""SELECT GOAL_DOMAIN, L12M_GOALS, L12M_COMPLETED, L12M_RATE, {thirds('R90')} AS AVG_90D,
  {thirds('P90')} AS PRIOR_AVG_90D, {thirds('R90')} - {thirds('P90')} AS DELTA_90D,
  {signed(f"({thirds('R90')} - {thirds('P90')})")} AS DELTA_90D_TEXT
FROM (SELECT m.GOAL_DOMAIN, CAST({v('TOTAL_GOALS', 'l12m')} AS BIGINT) AS L12M_GOALS,
             CAST({v('COMPLETED', 'l12m')} AS BIGINT) AS L12M_COMPLETED,
             CAST({v('COMPLETION_RATE', 'l12m', '0.0')} AS DOUBLE) AS L12M_RATE,
             CAST({v('TOTAL_GOALS', 'r90')} AS BIGINT) AS R90, CAST({v('TOTAL_GOALS', 'p90')} AS BIGINT) AS P90
      FROM pgp m WHERE m.PERIOD = 'month') z"""


def _cmp_tobacco() -> str:
    v = lambda p: _pv("ptob", "VALUE", p, "METRIC", "k.METRIC", "'0'")
    rate = q(R.TOBACCO_METRICS[4])
    change = "(TRY_CAST(MONTH AS BIGINT) - TRY_CAST(PRIOR AS BIGINT))"
    change_text = f"CASE WHEN {change} > 0 THEN '+' || CAST({change} AS VARCHAR) ELSE CAST({change} AS VARCHAR) END"
    return f"""SELECT METRIC, L12M, MONTH, PRIOR,
  CASE WHEN METRIC = {rate} THEN '—' ELSE {change_text} END AS MOM_CHANGE,
  CASE WHEN METRIC = {rate} THEN '—' ELSE CAST(TRY_CAST(MONTH AS BIGINT) AS VARCHAR) END AS AVG_90D,
  CASE WHEN METRIC = {rate} THEN '—' ELSE CAST(TRY_CAST(PRIOR AS BIGINT) AS VARCHAR) END AS PRIOR_AVG_90D,
  CASE WHEN METRIC = {rate} THEN '—' ELSE {change_text} END AS DELTA_90D
FROM (SELECT k.METRIC, {v('l12m')} AS L12M, {v('month')} AS MONTH, {v('prior_month')} AS PRIOR
      FROM (VALUES {', '.join(f'({q(m)})' for m in R.TOBACCO_METRICS)}) k(METRIC)) z"""


def _distinct_members(p, s, e) -> str:
    return (f"SELECT 'Distinct Members Coached' AS KPI, '{p}' AS PERIOD, "
            f"count(DISTINCT T.CURRENTGUID) AS v FROM topics T WHERE {flt('T.', s, e)}")


KPI_CTES = PERIOD_CTES + [("kv", f"""SELECT 'Members Coached' AS KPI, PERIOD, CAST(sum(MEMBERS) AS BIGINT) AS v FROM pe GROUP BY PERIOD
UNION ALL {_period_union(_distinct_members)}
UNION ALL SELECT 'Goals Completed', PERIOD, CAST(sum(COUNT) AS BIGINT) FROM pgd WHERE GOAL_STATUS = {q(R.COMPLETED)} GROUP BY PERIOD
UNION ALL SELECT 'Tobacco Participants', PERIOD, CAST(VALUE AS BIGINT) FROM ptob WHERE METRIC = {q(R.TOBACCO_METRICS[0])}""")]


def _kpi() -> str:
    g = lambda p: f"coalesce(max(CASE WHEN kv.PERIOD = '{p}' THEN kv.v END), 0)"
    return f"""SELECT KPI, L12M, MONTH, PRIOR, MONTH - PRIOR AS MOM_DELTA, AVG_90D, PRIOR_AVG_90D,
  AVG_90D - PRIOR_AVG_90D AS DELTA_90D
FROM (SELECT KPI, L12M, MONTH, PRIOR,
             CASE WHEN KPI = 'Tobacco Participants' THEN MONTH ELSE {thirds('R90')} END AS AVG_90D,
             CASE WHEN KPI = 'Tobacco Participants' THEN PRIOR ELSE {thirds('P90')} END AS PRIOR_AVG_90D
      FROM (SELECT k.KPI, CAST({g('l12m')} AS BIGINT) AS L12M, CAST({g('month')} AS BIGINT) AS MONTH,
                   CAST({g('prior_month')} AS BIGINT) AS PRIOR, CAST({g('r90')} AS BIGINT) AS R90,
                   CAST({g('p90')} AS BIGINT) AS P90
            FROM (VALUES ('Members Coached'), ('Distinct Members Coached'), ('Goals Completed'),
                         ('Tobacco Participants')) k(KPI)
            LEFT JOIN kv ON kv.KPI = k.KPI GROUP BY k.KPI) a) b"""


def _gap() -> str:
    m = R.TOBACCO_METRICS
    return f"""SELECT P AS PARTICIPANTS, A AS ACTIVE, P - A AS GAP, {pct('P - A', 'greatest(P, 1)', 1)} AS GAP_PCT
FROM (SELECT CAST(max(CASE WHEN METRIC = {q(m[0])} THEN VALUE END) AS BIGINT) AS P,
             CAST(max(CASE WHEN METRIC = {q(m[1])} THEN VALUE END) AS BIGINT) AS A
      FROM ptob WHERE PERIOD = 'month') z"""


def _snapshot(table_cte: str, cols: Sequence[str]) -> str:
    return (f"SELECT {', '.join(cols)}, TIMESTAMP '{AS_OF} 00:00:00' AS REFRESH_DATE, "
            f"'{AS_OF.strftime('%Y%m')}' AS REPORT_MONTH FROM {table_cte}")


TOPIC_COLS = ["ACCOUNT", "GUID", "CURRENTGUID", "CUSTOMERID", "CALL_DATE", "CALL_TYPE", "RAW_TOPIC",
              "REPORT_TOPIC", "TOPIC_SOURCE", "PROGRAM_TYPE"]
GOAL_COLS = ["ACCOUNT", "GOAL_TYPE", "GOAL_DOMAIN", "GOAL_STATUS", "GOAL_DESCRIPTION", "RAW_ACTION_NAME",
             "MEMBERACTION_ID", "ACTIONTYPE_ID", "ACTIONSTATUS_ID", "FOCUSAREA_ID", "GOAL_SET_DATE",
             "GOAL_CLOSE_DATE", "CURRENTGUID", "GUID", "GOAL_NUMBER"]
VALIDATION = [("ALL CALLS", "TRUE"), ("Tier 1: Date Match", "TOPIC_SOURCE LIKE 'Tier 1:%'"),
              ("Tier 1.5: Text", f"TOPIC_SOURCE = {q(R.TIER_TEXT)}"),
              ("Tier 2: Call Type", f"TOPIC_SOURCE = {q(R.TIER_CALL_TYPE)}"),
              ("Tier 3: Prior", f"TOPIC_SOURCE = {q(R.TIER_PRIOR)}"),
              ("Tier 4: General", f"TOPIC_SOURCE = {q(R.TIER_NONE)}")]


def _calls_filtered() -> str:
    from .params import CALLS_FILTER_END, CALLS_FILTER_START
    f = (f"m.CUSTOMERID = {q(CUSTOMER)} AND CAST(m.ENCOUNTERDATETIME AS DATE) "
         f"BETWEEN {d(CALLS_FILTER_START)} AND {d(CALLS_FILTER_END)}")
    return with_ctes(cascade("adhoc", f), "SELECT * FROM calls")


def build_oracle() -> dict[str, str]:
    done = f"sum(CASE WHEN GOAL_STATUS = {q(R.COMPLETED)} THEN 1 ELSE 0 END)"
    sql = {
        "src_calls": with_ctes(SOURCES, "SELECT * FROM mc"),
        "src_notes": with_ctes(SOURCES, "SELECT * FROM lmn"),
        "src_goals": with_ctes(SOURCES, "SELECT * FROM ma"),
        "enrolled_population": refresh("SELECT * FROM enrolled"),
        "calls_one_per_day": refresh("SELECT * FROM calls"),
        "calls_one_per_day_adhoc": adhoc("SELECT * FROM calls"),
        "calls_filtered": _calls_filtered(),
        "guid_bridge": refresh("SELECT * FROM bridge"),
        "lm_topics_dedup": refresh("SELECT * FROM lm_day"),
        "dm_topics_dedup": refresh("SELECT * FROM dm_day"),
        "calls_without_direct_topic": refresh("SELECT * FROM no_t1"),
        "inferred_text_topics": refresh("SELECT * FROM text_day"),
        "prior_topic_180d": refresh("SELECT * FROM prior_day"),
        "coaching_topics": refresh("SELECT * FROM topics"),
        "coaching_topics_adhoc": adhoc("SELECT * FROM topics"),
        "tobacco_flag": refresh("SELECT * FROM tobacco"),
        "goals_classified": refresh("SELECT * FROM goals"),
        "goals_numbered": refresh("SELECT * FROM goals_num"),
        "goals_numbered_active": adhoc("SELECT * FROM goals_num"),
        "out_topics_summary": adhoc(f"""SELECT REPORT_TOPIC AS CALL_TOPIC, count(DISTINCT GUID) AS MEMBERS,
  {pct('count(DISTINCT GUID)', 'tot.m', 2)} AS PCT_MEMBERS, count(*) AS CALLS,
  {pct('count(*)', 'tot.c', 2)} AS PCT_OF_CALLS
FROM topics CROSS JOIN (SELECT count(DISTINCT GUID) AS m, count(*) AS c FROM topics) tot
GROUP BY REPORT_TOPIC, tot.m, tot.c"""),
        "out_tier_breakdown": adhoc(f"""SELECT TOPIC_SOURCE, count(*) AS CALLS,
  {pct('count(*)', 'sum(count(*)) OVER ()', 2)} AS PCT FROM topics GROUP BY TOPIC_SOURCE"""),
        "out_tobacco_summary": adhoc(f"""SELECT x.TOBACCO_DISCUSSED, x.MEMBERS, {pct('x.MEMBERS', 'tot.m', 2)} AS PCT_MEMBERS,
  x.CALLS, {pct('x.CALLS', 'tot.c', 2)} AS PCT_OF_CALLS
FROM (SELECT 'Yes' AS TOBACCO_DISCUSSED, count(DISTINCT GUID) AS MEMBERS, count(*) AS CALLS FROM topics WHERE {TOBACCO_TEST}
      UNION ALL SELECT 'No', count(DISTINCT GUID), count(*) FROM topics
                WHERE GUID NOT IN (SELECT GUID FROM tobacco WHERE GUID IS NOT NULL)
      UNION ALL SELECT 'Grand Total', count(DISTINCT GUID), count(*) FROM topics) x
CROSS JOIN (SELECT count(DISTINCT GUID) AS m, count(*) AS c FROM topics) tot"""),
        "out_goal_type_domain": adhoc(crosstab("goals_num", "GOAL_DOMAIN", "GOAL_TYPE", [
            ("Coach-Created", "COACH_CREATED", "CC_PCT"),
            ("System-Recommended", "SYS_RECOMMENDED", "SR_PCT")], 2)),
        "out_goal_domain_status": adhoc(crosstab("goals_num", "GOAL_DOMAIN", "GOAL_STATUS", STATUS_COLS_2DP, 2)),
        "out_goal_number_status": adhoc(crosstab("goals_num", "GOAL_NUMBER", "GOAL_STATUS", STATUS_COLS_2DP, 2,
                                                 f"GOAL_NUMBER <= {R.GOAL_NUMBER_CAP}")),
        "out_goal_type_status": adhoc(crosstab("goals_num", "GOAL_TYPE", "GOAL_STATUS", STATUS_COLS_2DP, 2)),
        "out_validation_counts": adhoc("\nUNION ALL\n".join(
            [f"SELECT {q(label)} AS SECTION, count(*) AS ROWS, count(DISTINCT GUID) AS MEMBERS FROM topics WHERE {w}"
             for label, w in VALIDATION]
            + ["SELECT 'TOBACCO', count(*), count(DISTINCT GUID) FROM tobacco",
               "SELECT 'GOALS', count(*), count(DISTINCT CURRENTGUID) FROM goals_num"])),
        "snapshot_topics": refresh(_snapshot("topics", TOPIC_COLS)),
        "snapshot_tobacco": refresh(_snapshot("tobacco", ["ACCOUNT", "GUID", "CURRENTGUID", "TOBACCO_DISCUSSED"])),
        "snapshot_goals": refresh(_snapshot("goals_num", GOAL_COLS)),
        "dash_engagement_by_topic": refresh(f"""SELECT T.REPORT_TOPIC AS WELLBEING_TOPIC, count(DISTINCT T.CURRENTGUID) AS MEMBERS,
  {pct('count(DISTINCT T.CURRENTGUID)', 'tot.m', 1)} AS PCT_OF_MEMBERS,
  {goal_ids('G', R.COMPLETED)} AS COMPLETED_GOALS, {goal_ids('G', R.IN_PROGRESS)} AS OPEN_IN_PROGRESS_GOALS
FROM topics T CROSS JOIN (SELECT count(DISTINCT CURRENTGUID) AS m FROM topics) tot
LEFT JOIN goals_num G ON T.CURRENTGUID = G.CURRENTGUID
GROUP BY T.REPORT_TOPIC, tot.m"""),
        "dash_goal_status_by_topic": refresh(f"""SELECT T.REPORT_TOPIC AS WELLBEING_TOPIC,
  {goal_ids('G', R.COMPLETED)} AS COMPLETED, {goal_ids('G', R.IN_PROGRESS)} AS IN_PROGRESS
FROM topics T JOIN goals_num G ON T.CURRENTGUID = G.CURRENTGUID GROUP BY T.REPORT_TOPIC"""),
        "dash_goal_status_distribution": refresh(f"""SELECT GOAL_STATUS, count(*) AS COUNT,
  {pct('count(*)', 'sum(count(*)) OVER ()', 1)} AS GOAL_PCT
FROM goals_num WHERE GOAL_STATUS IN ({in_list(R.REPORTED_STATUSES)}) GROUP BY GOAL_STATUS"""),
        "dash_goal_progression": refresh(f"""SELECT GOAL_DOMAIN, count(*) AS TOTAL_GOALS, CAST({done} AS BIGINT) AS COMPLETED,
  {pct(done, 'count(*)', 1)} AS COMPLETION_RATE FROM goals_num GROUP BY GOAL_DOMAIN"""),
        "dash_tobacco_focus": refresh(f"""SELECT {q(R.TOBACCO_METRICS[0])} AS METRIC, CAST(count(DISTINCT CURRENTGUID) AS VARCHAR) AS VALUE FROM tobacco
UNION ALL SELECT {q(R.TOBACCO_METRICS[1])}, CAST(count(DISTINCT G.CURRENTGUID) AS VARCHAR)
  FROM tobacco TB JOIN goals_num G ON TB.CURRENTGUID = G.CURRENTGUID AND {TOB_GOAL} AND G.GOAL_STATUS = {q(R.IN_PROGRESS)}
UNION ALL SELECT {q(R.TOBACCO_METRICS[2])}, CAST(count(*) AS VARCHAR) FROM goals_num G
  WHERE {TOB_GOAL} AND G.GOAL_STATUS = {q(R.COMPLETED)}
UNION ALL SELECT {q(R.TOBACCO_METRICS[3])}, CAST(count(*) AS VARCHAR) FROM goals_num G
  WHERE {TOB_GOAL} AND G.GOAL_STATUS = {q(R.IN_PROGRESS)}
UNION ALL SELECT {q(R.TOBACCO_METRICS[4])}, {pct_text(pct(done, 'count(*)', 1))} FROM goals_num G
  WHERE {TOB_GOAL} AND G.GOAL_STATUS IN ({in_list([R.COMPLETED, R.IN_PROGRESS])})"""),
        "period_engagement": with_ctes(PERIOD_CTES, "SELECT * FROM pe"),
        "period_goal_distribution": with_ctes(PERIOD_CTES, "SELECT * FROM pgd"),
        "period_goal_progression": with_ctes(PERIOD_CTES, "SELECT * FROM pgp"),
        "period_goal_distribution_goals": with_ctes(REFRESH, _period_union(_goal_dist_once)),
        "period_tobacco": with_ctes(PERIOD_CTES, "SELECT * FROM ptob"),
        "enrolled_members_by_period": with_ctes(REFRESH, _period_union(_enrolled)),
        "period_topics_classic": refresh(f"""SELECT REPORT_TOPIC AS CALL_TOPIC, count(DISTINCT CURRENTGUID) AS MEMBERS,
  {pct('count(DISTINCT CURRENTGUID)', 'tot.m', 2)} AS PCT_MEMBERS, count(*) AS CALLS,
  {pct('count(*)', 'tot.c', 2)} AS PCT_OF_CALLS
FROM topics T CROSS JOIN (SELECT count(DISTINCT CURRENTGUID) AS m, count(*) AS c FROM topics
                          WHERE {flt('', L12_S, L12_E)}) tot
WHERE {flt('T.', L12_S, L12_E)}
GROUP BY REPORT_TOPIC, tot.m, tot.c"""),
        "period_tobacco_classic": refresh(f"""SELECT 'Yes' AS TOBACCO_DISCUSSED, count(DISTINCT T.CURRENTGUID) AS MEMBERS,
  {pct('count(DISTINCT T.CURRENTGUID)', 'tot.m', 2)} AS PCT_MEMBERS, count(*) AS CALLS,
  {pct('count(*)', 'tot.c', 2)} AS PCT_OF_CALLS
FROM topics T JOIN tobacco TB ON T.CURRENTGUID = TB.CURRENTGUID
CROSS JOIN (SELECT count(DISTINCT CURRENTGUID) AS m, count(*) AS c FROM topics WHERE {flt('', L12_S, L12_E)}) tot
WHERE {flt('T.', L12_S, L12_E)}
GROUP BY tot.m, tot.c
UNION ALL
SELECT 'No', count(DISTINCT T.CURRENTGUID), {pct('count(DISTINCT T.CURRENTGUID)', 'tot.m', 2)}, count(*),
  {pct('count(*)', 'tot.c', 2)}
FROM topics T
CROSS JOIN (SELECT count(DISTINCT CURRENTGUID) AS m, count(*) AS c FROM topics WHERE {flt('', L12_S, L12_E)}) tot
WHERE {flt('T.', L12_S, L12_E)}
  AND T.CURRENTGUID NOT IN (SELECT CURRENTGUID FROM tobacco WHERE CURRENTGUID IS NOT NULL)
GROUP BY tot.m, tot.c"""),
        "period_goal_domain_status": refresh(f"""SELECT G.GOAL_DOMAIN,
  {', '.join(f"CAST(sum(CASE WHEN G.GOAL_STATUS = {q(s)} THEN 1 ELSE 0 END) AS BIGINT) AS {c}, "
             f"{pct(f'sum(CASE WHEN G.GOAL_STATUS = {q(s)} THEN 1 ELSE 0 END)', 'count(*)', 1)} AS {p}"
             for s, c, p in [(R.COMPLETED, 'COMPLETED', 'COMP_PCT'), (R.IN_PROGRESS, 'IN_PROGRESS', 'IP_PCT'),
                             (R.WITHDRAWN, 'WITHDRAWN', 'WD_PCT')])}
FROM goals_num G JOIN topics T ON G.CURRENTGUID = T.CURRENTGUID
WHERE {flt('T.', L12_S, L12_E)}
GROUP BY G.GOAL_DOMAIN"""),
        "cmp_goal_status": with_ctes(PERIOD_CTES, _cmp_goal_status()),
        "cmp_engagement": with_ctes(PERIOD_CTES, _cmp_engagement()),
        "cmp_goal_progression": with_ctes(PERIOD_CTES, _cmp_goal_progression()),
        "cmp_tobacco": with_ctes(PERIOD_CTES, _cmp_tobacco()),
        "kpi_headlines": with_ctes(KPI_CTES, _kpi()),
        "tobacco_goal_gap": with_ctes(PERIOD_CTES, _gap()),
    }
    return sql


ORACLE = build_oracle()
