"""The same queries as plain SQL, written from the meaning of each step.

Nothing of the library is used here, its code sets neither: whether a signal covers a row is
asked with EXISTS over a date range, code pairs are joined, and results put back by key.
"""

from __future__ import annotations

_EMERGENCY_PROCEDURES = (
    "('99281', '99282', '99283', '99284', '99285', '99286', '99287', '99288',"
    " 'G0380', 'G0381', 'G0382', 'G0383', 'G0384')"
)
_EMERGENCY_REVENUE = "('0450', '0451', '0452', '0456', '0459', '0981')"
_INPATIENT_ONLY = "('ccs152', 'ccs153', 'ccs158')"


def _nth(number: str, values: str) -> str:
    """The value at ``number`` modulo their count, as a CASE."""
    listed = values.strip("()").split(", ")
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(listed))
    return f"CASE {number} % {len(listed)} {cases} END"


_SLOTS = ", ".join(
    f"max(l_partkey) FILTER (WHERE nth % 10 = {n - 1}) AS part{n}" for n in range(1, 11)
)
_SLOT_COLUMNS = ", ".join(
    f"lpad(CAST(part{n} AS STRING), 10, '0') AS icdproc{n}" for n in range(1, 11)
)

_CLAIMS = f"""
numbered AS (
  SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS nth
  FROM lineitem),
order_lines AS (
  SELECT l_orderkey, CAST(floor(nth / 10) AS BIGINT) AS line, {_SLOTS}
  FROM numbered GROUP BY l_orderkey, CAST(floor(nth / 10) AS BIGINT)),
dated AS (
  SELECT o.*, s.*, coalesce(s.line, 0) AS line_no,
    CASE WHEN o_orderkey % 227 <> 0 THEN CAST(o_orderdate AS DATE) END AS day0
  FROM orders o LEFT JOIN order_lines s ON o.o_orderkey = s.l_orderkey),
claims AS (
  SELECT
    o_orderkey * 1048576 + line_no AS sequencenumber,
    CASE WHEN o_orderkey % 223 <> 0 THEN 'M' || o_custkey END AS member_id,
    CASE WHEN o_orderkey % 211 <> 0
      THEN 'A' || o_custkey || '_' || year(o_orderdate) END AS caseadmitid,
    'C' || o_orderkey AS claimid,
    CAST(line_no + 1 AS STRING) AS line_number,
    day0 AS prm_fromdate,
    day0 + CAST(o_orderkey % 5 AS INTEGER) AS prm_todate,
    CASE WHEN o_orderkey % 13 <> 0
      THEN lpad(CAST(o_orderkey % 45 + 11 AS STRING), 3, '0') END AS prm_drg,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
      THEN {_nth("o_orderkey", _EMERGENCY_PROCEDURES)}
      ELSE lpad(CAST(part1 AS STRING), 10, '0') END AS hcpcs,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0
      THEN {_nth("o_orderkey", _EMERGENCY_REVENUE)}
      ELSE lpad(CAST(o_orderkey % 1000 AS STRING), 4, '0') END AS revcode,
    {_SLOT_COLUMNS},
    CASE WHEN o_orderkey % 229 = 0 THEN NULL
      WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'I12' ELSE 'I12a' END
      WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'O12' ELSE 'O12b' END
      ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'I11' ELSE 'O11' END END AS mr_line_case,
    CASE WHEN o_orderkey % 233 <> 0
      THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS mr_allowed,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'Y' ELSE 'N' END
      AS prm_acute_transfer_to_acute_yn,
    CASE WHEN o_orderkey % 17 <> 0 THEN 'P' || (o_orderkey % 100) END AS prm_prv_id_operating,
    day0 + CAST(o_orderkey % 40 AS INTEGER) AS paiddate
  FROM dated)"""

_CODES = """
code_table AS (
  SELECT lpad(CAST(p_partkey AS STRING), 10, '0') AS code, p_name AS code_description,
    'ICD10_PROC' AS code_type, 'ccs' || (p_size + 110) AS ccs
  FROM part WHERE p_type IN ('ECONOMY', 'MEDIUM', 'SMALL')
  UNION ALL
  SELECT lpad(CAST(p_partkey AS STRING), 10, '0'), p_name, 'CPT_HCPCS',
    'ccs' || (p_size + 110)
  FROM part WHERE p_type IN ('LARGE', 'PROMO', 'STANDARD')
  UNION ALL
  SELECT DISTINCT lpad(replace(p_brand, 'Brand#', ''), 3, '0'), p_brand, 'MSDRG',
    'ccs' || (p_size + 110)
  FROM part WHERE p_type IN ('PROMO', 'SMALL')),
icd_procs AS (SELECT * FROM code_table WHERE code_type = 'ICD10_PROC'),
hcpcs_codes AS (SELECT * FROM code_table WHERE code_type = 'CPT_HCPCS'),
drg AS (SELECT * FROM code_table WHERE code_type = 'MSDRG')"""

_LONG = "\nUNION ALL\n".join(
    f"SELECT *, CAST({n - 1} AS INTEGER) AS position, icdproc{n} AS icd_proc"
    f" FROM claims WHERE icdproc{n} IS NOT NULL"
    for n in range(1, 11)
)

_CANDIDATES = f"""
slot_rows AS ({_LONG}),
ip_candidates AS (
  SELECT s.member_id, s.caseadmitid, s.sequencenumber, s.prm_fromdate, s.prm_drg,
    s.mr_allowed, s.position, c.ccs
  FROM slot_rows s JOIN icd_procs c ON s.icd_proc = c.code
  WHERE s.mr_line_case LIKE 'I12%'),
op_candidates AS (
  SELECT DISTINCT l.member_id, l.caseadmitid, l.sequencenumber, l.prm_fromdate, l.paiddate,
    l.mr_allowed, c.ccs, CAST(0 AS INTEGER) AS position
  FROM claims l JOIN hcpcs_codes c ON l.hcpcs = c.code
  WHERE l.mr_line_case LIKE 'O12%'),
ip_allowed AS (
  SELECT DISTINCT i.* FROM ip_candidates i JOIN drg d ON i.ccs = d.ccs AND i.prm_drg = d.code),
op_allowed AS (SELECT * FROM op_candidates WHERE ccs NOT IN (INPATIENT_ONLY))"""

_SIGNALS = f"""
visits AS (
  SELECT DISTINCT member_id, prm_fromdate AS day FROM claims
  WHERE (hcpcs IN {_EMERGENCY_PROCEDURES} OR revcode IN {_EMERGENCY_REVENUE})
    AND member_id IS NOT NULL AND prm_fromdate IS NOT NULL),
transfers AS (
  SELECT DISTINCT member_id, prm_todate AS day FROM claims
  WHERE prm_acute_transfer_to_acute_yn = 'Y'
    AND member_id IS NOT NULL AND prm_todate IS NOT NULL)"""


def _led_to(signals: str) -> str:
    """Whether a signal of the candidate's member came on its day or shortly before."""
    return (
        f"EXISTS (SELECT 1 FROM {signals} s WHERE s.member_id = c.member_id"
        " AND s.day <= c.prm_fromdate AND s.day >= c.prm_fromdate - LOOKBACK)"
    )


_FLAGS = f"""
ip_asked AS (
  SELECT c.*, {_led_to("visits")} AS after_visit, {_led_to("transfers")} AS after_transfer
  FROM ip_allowed c),
op_asked AS (SELECT c.*, {_led_to("visits")} AS after_visit FROM op_candidates c),
ip_judged AS (
  SELECT *, CASE WHEN after_visit OR after_transfer THEN 'N' ELSE 'Y' END AS preventable_yn
  FROM ip_asked),
op_judged AS (
  SELECT *, CASE WHEN after_visit THEN 'N' ELSE 'Y' END AS preventable_yn
  FROM op_asked WHERE ccs NOT IN (INPATIENT_ONLY))"""

_CASE_ORDER = (
    "PARTITION BY caseadmitid ORDER BY position ASC NULLS FIRST,"
    " mr_allowed DESC NULLS LAST, prm_fromdate ASC NULLS FIRST, sequencenumber, ccs"
)
_DAY_ORDER = (
    "PARTITION BY member_id, prm_fromdate ORDER BY"
    " paiddate DESC NULLS LAST, mr_allowed DESC NULLS LAST, sequencenumber, ccs"
)


def _first(candidates: str, order: str) -> str:
    return (
        f"(SELECT * FROM (SELECT *, row_number() OVER ({order}) AS nth"
        f" FROM {candidates}) ranked WHERE nth = 1)"
    )


_CHOSEN = f"""
ip_chosen AS (
  SELECT member_id, caseadmitid, sequencenumber, prm_fromdate, ccs, position, preventable_yn
  FROM {_first("ip_judged", _CASE_ORDER)} f),
op_chosen AS (
  SELECT member_id, caseadmitid, sequencenumber, prm_fromdate, ccs, position, preventable_yn
  FROM {_first("op_judged", _DAY_ORDER)} f),
chosen AS (SELECT * FROM ip_chosen UNION ALL SELECT * FROM op_chosen),
decorated AS (
  SELECT l.sequencenumber,
    CASE WHEN l.mr_line_case LIKE 'I12%' OR l.mr_line_case LIKE 'O12%'
      THEN 'Y' ELSE 'N' END AS psp_eligible_yn,
    c.ccs AS psp_category, c.preventable_yn AS psp_preventable_yn
  FROM claims l LEFT JOIN chosen c ON l.sequencenumber = c.sequencenumber)"""

_STEPS = [_CLAIMS, _CODES, _CANDIDATES, _SIGNALS, _FLAGS, _CHOSEN]


def _filled(text: str, lookback: int = 1, only: str = _INPATIENT_ONLY) -> str:
    return text.replace("(INPATIENT_ONLY)", only).replace("LOOKBACK", str(lookback))


def _sql(select: str, steps: int = len(_STEPS), **rules) -> str:
    return "WITH " + _filled(",".join(_STEPS[:steps]) + "\n" + select, **rules)


def _as_text(alias: str, *names: str) -> str:
    return ", ".join(f"CAST({alias}.{n} AS STRING) AS {n}" for n in names)


_CANDIDATE_IP = (
    f"x.member_id, x.caseadmitid, x.sequencenumber, {_as_text('x', 'prm_fromdate')},"
    f" x.prm_drg, {_as_text('x', 'mr_allowed')}, x.position, x.ccs"
)
_CANDIDATE_OP = (
    f"x.member_id, x.caseadmitid, x.sequencenumber,"
    f" {_as_text('x', 'prm_fromdate', 'paiddate', 'mr_allowed')}, x.ccs, x.position"
)
_FLAGGED = (
    f"x.member_id, x.caseadmitid, x.sequencenumber, {_as_text('x', 'prm_fromdate')},"
    " x.ccs, x.position"
)
_CODE_SPLIT = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, code, ccs FROM code_table WHERE code_type = '{kind}'"
    for name, kind in (("icd_procs", "ICD10_PROC"), ("hcpcs", "CPT_HCPCS"), ("drg", "MSDRG"))
)
_ITEM_CATEGORIES = (
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, p_type AS ccs"
    " FROM lineitem JOIN part ON l_partkey = p_partkey"
)
_DECORATED = "SELECT * FROM decorated"
_OTHER = {"lookback": 0, "only": "('ccs111')"}


def _after_error(days: int) -> str:
    return f"""
WITH dated AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events),
errors AS (SELECT DISTINCT user_id, day FROM dated WHERE event_type = 'error')
SELECT event_id, user_id, CAST(day AS TIMESTAMP) AS day,
  CASE WHEN EXISTS (SELECT 1 FROM errors e WHERE e.user_id = d.user_id
    AND e.day BETWEEN d.day - {days} AND d.day) THEN 'Y' ELSE 'N' END AS after_error
FROM dated d"""


_DAYS_SINCE = """
WITH dated AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events),
errors AS (SELECT DISTINCT user_id, day FROM dated WHERE event_type = 'error')
SELECT event_id, user_id, CAST((SELECT d.day - max(e.day) FROM errors e
  WHERE e.user_id = d.user_id AND e.day <= d.day) AS INTEGER) AS days_since
FROM dated d"""


def _both_rules(select: str) -> str:
    return (
        f"WITH e AS ({_sql(_DECORATED)}), a AS ({_sql(_DECORATED, **_OTHER)}),\n"
        "joined AS (SELECT e.sequencenumber, "
        + ", ".join(
            f"e.{c} AS e_{c}, a.{c} AS a_{c}"
            for c in ("psp_eligible_yn", "psp_category", "psp_preventable_yn")
        )
        + " FROM e FULL JOIN a ON e.sequencenumber = a.sequencenumber)\n"
        + select
    )


def _cells(side: str, other: str) -> str:
    mine, theirs = (1, 0) if side == "e" else (0, 1)
    return "\nUNION ALL\n".join(
        f"SELECT sequencenumber, '{c}' AS \"column\", {side}_{c} AS value,"
        f" CAST({mine} AS BIGINT) AS n_expected, CAST({theirs} AS BIGINT) AS n_actual"
        f" FROM joined WHERE {side}_{c} IS DISTINCT FROM {other}_{c}"
        for c in ("psp_eligible_yn", "psp_category", "psp_preventable_yn")
    )


_DIFFERENCE_COUNTS = """
SELECT * FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_misses"
    f" FROM joined WHERE e_{c} IS DISTINCT FROM a_{c}"
    for c in ("psp_eligible_yn", "psp_category", "psp_preventable_yn")
) + ") WHERE n_misses > 0"

_COVERAGE = """
, listed AS (
  SELECT ccs, code_type FROM code_table
  UNION ALL SELECT unnest(['ccs152', 'ccs153', 'ccs158', 'ccs44']), NULL),
counted AS (
  SELECT ccs, count(*) FILTER (WHERE code_type = 'ICD10_PROC') AS n_icd_procs,
    count(*) FILTER (WHERE code_type = 'CPT_HCPCS') AS n_hcpcs,
    count(*) FILTER (WHERE code_type = 'MSDRG') AS n_drg
  FROM listed GROUP BY ccs)
SELECT *, concat_ws(',', CASE WHEN n_icd_procs = 0 THEN 'icd_procs' END,
  CASE WHEN n_hcpcs = 0 THEN 'hcpcs' END, CASE WHEN n_drg = 0 THEN 'drg' END) AS missing
FROM counted"""

_CONTRACT = """
SELECT (SELECT count(*) FROM claims) AS n_lines,
  (SELECT count(*) FROM decorated) AS n_result,
  (SELECT count(*) FROM claims WHERE sequencenumber IS NULL)
    + (SELECT count(*) FROM decorated WHERE sequencenumber IS NULL) AS n_null_key_rows,
  (SELECT count(*) FROM (SELECT sequencenumber FROM decorated GROUP BY 1 HAVING count(*) > 1))
    AS n_repeated_keys,
  (SELECT count(*) FROM claims l WHERE NOT EXISTS
    (SELECT 1 FROM decorated d WHERE d.sequencenumber = l.sequencenumber)) AS n_missing_keys,
  (SELECT count(*) FROM decorated d WHERE NOT EXISTS
    (SELECT 1 FROM claims l WHERE d.sequencenumber = l.sequencenumber)) AS n_extra_keys,
  (SELECT count(*) FROM decorated WHERE psp_eligible_yn NOT IN ('Y', 'N')
    OR psp_eligible_yn IS NULL) AS n_broken_eligible_value,
  (SELECT count(*) FROM decorated WHERE psp_preventable_yn NOT IN ('Y', 'N'))
    AS n_broken_preventable_value,
  (SELECT count(*) FROM decorated WHERE (psp_category IS NULL) <> (psp_preventable_yn IS NULL))
    AS n_broken_flag_with_category,
  (SELECT count(*) FROM decorated WHERE psp_category IS NOT NULL AND psp_eligible_yn = 'N')
    AS n_broken_category_only_if_eligible"""

_RULE_SETS = "\nUNION ALL\n".join(
    f"SELECT sequencenumber, '{name}' AS rule_set, psp_eligible_yn, psp_category,"
    f" psp_preventable_yn FROM {name}_rules"
    for name in ("default", "other", "long")
)


def _three_rules() -> str:
    rules = {"default": {}, "other": _OTHER, "long": {"lookback": 90}}
    parts = [f"{name}_rules AS ({_sql(_DECORATED, **r)})" for name, r in rules.items()]
    return "WITH " + ",\n".join(parts) + "\n" + _RULE_SETS


_BAD_ORDERS = """
WITH written AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END
    AS customer,
    CASE WHEN o_orderkey % 70 = 0 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END
    AS day FROM orders)
SELECT o_orderkey || ',' || customer || ',' || day AS "row",
  concat_ws('; ', CASE WHEN customer = 'n/a' THEN 'o_custkey: n/a is no bigint' END,
    CASE WHEN day = 'soon' THEN 'o_orderdate: soon is no date' END) AS reason
FROM written WHERE customer = 'n/a' OR day = 'soon'"""


def _two_decorators() -> str:
    return (
        f"WITH p AS ({_sql(_DECORATED)}), q AS ({_sql(_DECORATED, lookback=90)})\n"
        "SELECT p.*, "
        + ", ".join(
            f"q.psp_{c} AS psp90_{c}" for c in ("eligible_yn", "category", "preventable_yn")
        )
        + " FROM p JOIN q USING (sequencenumber)"
    )


def _versions() -> str:
    counted = (
        "SELECT psp_category, psp_preventable_yn, count(*) AS n_lines,"
        " CAST({} AS INTEGER) AS version FROM ({}) GROUP BY 1, 2"
    )
    both = counted.format(1, _sql(_DECORATED)), counted.format(2, _sql(_DECORATED, **_OTHER))
    return "\nUNION ALL\n".join(both)


_ITEM_DIFFERENCES = """
WITH items AS (
  SELECT CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END AS l_orderkey, l_linenumber,
    l_partkey, CAST(l_quantity AS BIGINT) AS l_quantity FROM lineitem),
changed AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
    l_quantity + CASE WHEN l_orderkey % 400 = 1 THEN 1 ELSE 0 END AS l_quantity
  FROM items, range(2) copies(copy)
  WHERE copy < CASE WHEN l_partkey % 97 = 5 THEN 0 WHEN l_partkey % 89 = 7 THEN 2 ELSE 1 END),
sides AS (
  SELECT *, 1 AS e, 0 AS a FROM items UNION ALL SELECT *, 0, 1 FROM changed),
rows_left AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, sum(e) AS e, sum(a) AS a
  FROM sides GROUP BY 1, 2, 3, 4 HAVING sum(e) <> sum(a)),
cells AS (
  SELECT l_orderkey, l_linenumber, 'l_partkey' AS "column", CAST(l_partkey AS STRING) AS value,
    e, a FROM rows_left
  UNION ALL
  SELECT l_orderkey, l_linenumber, 'l_quantity', CAST(l_quantity AS STRING), e, a
  FROM rows_left),
found AS (
  SELECT l_orderkey, l_linenumber, "column", value, CAST(sum(e) AS BIGINT) AS n_expected,
    CAST(sum(a) AS BIGINT) AS n_actual
  FROM cells GROUP BY 1, 2, 3, 4 HAVING sum(e) <> sum(a))
"""

_BROKEN = """
WITH i AS (SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey AS key, count(*) AS n FROM orders GROUP BY 1)
SELECT (SELECT count(*) FROM lineitem) AS n_lines,
  (SELECT count(*) FROM orders) AS n_result,
  (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL)
    + (SELECT count(*) FROM orders WHERE o_orderkey IS NULL) AS n_null_key_rows,
  (SELECT count(*) FROM i FULL JOIN o ON i.key = o.key WHERE i.n > 1 OR o.n > 1)
    AS n_repeated_keys,
  (SELECT count(*) FROM i WHERE key NOT IN (SELECT key FROM o)) AS n_missing_keys,
  (SELECT count(*) FROM o WHERE key NOT IN (SELECT key FROM i)) AS n_extra_keys,
  (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW') AS n_broken_priority"""


def stored_decoration_sql() -> str:
    """The full decoration over views claims, icd_procs, hcpcs_codes and drg.

    Each candidate asks by EXISTS whether a signal of its member lies in its date range, then
    one row per group is chosen. Runs on Spark too, so that the library's plan can be timed
    against it.
    """
    return "WITH " + _filled(",".join(_STEPS[2:]) + "\n" + _DECORATED)


def range_join_sql() -> str:
    """The same result with the signals found by a join over member and date range."""
    pairs = {
        name: f"""
{name}_days AS (
  SELECT DISTINCT c.member_id, c.prm_fromdate FROM {candidates} c
  JOIN {signals} s ON s.member_id = c.member_id
    AND s.day <= c.prm_fromdate AND s.day >= c.prm_fromdate - LOOKBACK)"""
        for name, candidates, signals in (
            ("ip_visit", "ip_allowed", "visits"),
            ("ip_transfer", "ip_allowed", "transfers"),
            ("op_visit", "op_candidates", "visits"),
        )
    }

    def found(name: str, alias: str) -> str:
        return (
            f"LEFT JOIN {name}_days {alias} ON {alias}.member_id = c.member_id"
            f" AND {alias}.prm_fromdate = c.prm_fromdate"
        )

    judged = f"""
ip_judged AS (
  SELECT c.*, CASE WHEN v.member_id IS NOT NULL OR t.member_id IS NOT NULL
    THEN 'N' ELSE 'Y' END AS preventable_yn
  FROM ip_allowed c {found("ip_visit", "v")} {found("ip_transfer", "t")}),
op_judged AS (
  SELECT c.*, CASE WHEN v.member_id IS NOT NULL THEN 'N' ELSE 'Y' END AS preventable_yn
  FROM op_candidates c {found("op_visit", "v")} WHERE c.ccs NOT IN (INPATIENT_ONLY))"""
    steps = [_CANDIDATES, _SIGNALS, *pairs.values(), judged, _CHOSEN]
    return "WITH " + _filled(",".join(steps) + "\n" + _DECORATED)


def oracle_sql() -> dict[str, str]:
    """SQL for each registered query, over the driver's tables as views."""
    days = "SELECT member_id, CAST(day AS TIMESTAMP) AS day FROM {}"
    asked = f"SELECT {_FLAGGED}, CASE WHEN x.{{}} THEN 'Y' ELSE 'N' END AS {{}} FROM {{}} x"
    preventable = "SELECT sequencenumber, ccs, position, preventable_yn FROM {}"
    chosen = f"SELECT {_FLAGGED}, x.preventable_yn FROM {{}} x"
    shown_as_text = "prm_fromdate", "prm_todate", "paiddate", "mr_allowed"
    return {
        "claims_view": _sql(
            "SELECT x.* REPLACE ("
            + ", ".join(f"CAST(x.{d} AS STRING) AS {d}" for d in shown_as_text)
            + ") FROM claims x",
            1,
        ),
        "eligible_flag": _sql(
            "SELECT sequencenumber, mr_line_case, CASE WHEN mr_line_case LIKE 'I12%'"
            " OR mr_line_case LIKE 'O12%' THEN 'Y' ELSE 'N' END AS psp_eligible_yn FROM claims",
            1,
        ),
        "emergency_marker": _sql(
            f"SELECT sequencenumber, CASE WHEN hcpcs IN {_EMERGENCY_PROCEDURES}"
            f" OR revcode IN {_EMERGENCY_REVENUE} THEN 'Y' ELSE 'N' END AS emergency_yn"
            " FROM claims",
            1,
        ),
        "procedure_slots_long": _sql(
            "SELECT sequencenumber, position, icd_proc FROM slot_rows", 3
        ),
        "inpatient_candidates_by_slot": _sql(f"SELECT {_CANDIDATE_IP} FROM ip_candidates x", 3),
        "outpatient_candidates_by_code": _sql(f"SELECT {_CANDIDATE_OP} FROM op_candidates x", 3),
        "drg_pair_filter": _sql(f"SELECT {_CANDIDATE_IP} FROM ip_allowed x", 3),
        "outpatient_exclusion": _sql(f"SELECT {_CANDIDATE_OP} FROM op_allowed x", 3),
        "lookup_measured": _ITEM_CATEGORIES,
        "lookup_spread": _ITEM_CATEGORIES,
        "emergency_days": _sql(days.format("visits"), 4),
        "transfer_days": _sql(days.format("transfers"), 4),
        "covered_days": _sql(
            """
, e AS (SELECT member_id, day FROM visits UNION SELECT member_id, day + 1 FROM visits),
t AS (SELECT member_id, day FROM transfers UNION SELECT member_id, day + 1 FROM transfers)
SELECT coalesce(e.member_id, t.member_id) AS member_id,
  CAST(coalesce(e.day, t.day) AS TIMESTAMP) AS day,
  CASE WHEN e.day IS NULL THEN 'N' ELSE 'Y' END AS emergency,
  CASE WHEN t.day IS NULL THEN 'N' ELSE 'Y' END AS transfer
FROM e FULL JOIN t ON e.member_id = t.member_id AND e.day = t.day""",
            4,
        ),
        "emergency_flag_ip": _sql(
            asked.format("after_visit", "after_visit_yn", "ip_asked"), 5
        ),
        "transfer_flag_ip": _sql(
            asked.format("after_transfer", "after_transfer_yn", "ip_asked"), 5
        ),
        "emergency_flag_op": _sql(
            asked.format("after_visit", "after_visit_yn", "op_asked"), 5
        ),
        "event_error_lookback_1d": _after_error(1),
        "event_error_lookback_3d": _after_error(3),
        "event_error_lookback_90d": _after_error(90),
        "event_days_since_error": _DAYS_SINCE,
        "preventable_ip": _sql(preventable.format("ip_judged"), 5),
        "preventable_op": _sql(preventable.format("op_judged"), 5),
        "case_primary": _sql(
            f"SELECT {_CANDIDATE_IP} FROM {_first('ip_allowed', _CASE_ORDER)} x", 3
        ),
        "member_day_latest": _sql(
            f"SELECT {_CANDIDATE_OP} FROM {_first('op_allowed', _DAY_ORDER)} x", 3
        ),
        "inpatient_chosen": _sql(chosen.format("ip_chosen")),
        "outpatient_chosen": _sql(chosen.format("op_chosen")),
        "branch_union": _sql(chosen.format("chosen")),
        "decorate_claims": _sql(_DECORATED),
        "decorator_object": _sql(_DECORATED),
        "decorate_other_rules": _sql(_DECORATED, **_OTHER),
        "decorate_long_lookback": _sql(_DECORATED, lookback=90),
        "decorate_stored": _sql(_DECORATED),
        "code_table_from_files": _sql("SELECT * FROM code_table", 2),
        "code_files_by_type": _sql(
            "SELECT code_type, count(*) AS n_codes, min(code) AS first_code"
            " FROM code_table GROUP BY code_type",
            2,
        ),
        "code_table_all": _sql("SELECT * FROM code_table", 2),
        "code_table_split": _sql(_CODE_SPLIT, 2),
        "code_conflict_report": _sql(
            "SELECT code_type, code, count(DISTINCT ccs) AS n_categories,"
            " min(ccs) AS first_category, max(ccs) AS last_category"
            " FROM code_table GROUP BY code_type, code HAVING count(DISTINCT ccs) > 1",
            2,
        ),
        "code_coverage_report": _sql(_COVERAGE, 2),
        "rules_difference": _both_rules(_cells("e", "a") + "\nUNION ALL\n" + _cells("a", "e")),
        "rules_difference_counts": _both_rules(_DIFFERENCE_COUNTS),
        "rules_beside": _both_rules(
            "SELECT sequencenumber, "
            + ", ".join(
                f"e_{c} AS expected_{c}, a_{c} AS {c}"
                for c in ("psp_eligible_yn", "psp_category", "psp_preventable_yn")
            )
            + " FROM joined"
        ),
        "bad_order_rows": _BAD_ORDERS,
        "two_decorators": _two_decorators(),
        "decorate_rule_sets": _three_rules(),
        "item_differences": _ITEM_DIFFERENCES + "SELECT * FROM found",
        "item_difference_counts": _ITEM_DIFFERENCES
        + "SELECT \"column\", count(*) AS n_misses FROM (SELECT DISTINCT l_orderkey,"
        " l_linenumber, \"column\" FROM found) GROUP BY \"column\"",
        "claims_with_decoration": _sql(
            "SELECT sequencenumber, member_id, CAST(prm_fromdate AS STRING) AS prm_fromdate,"
            " hcpcs, psp_eligible_yn, psp_category, psp_preventable_yn"
            " FROM claims JOIN decorated USING (sequencenumber)"
        ),
        "published_versions": _versions(),
        "output_contract": _sql(_CONTRACT),
        "broken_contract": _BROKEN,
    }
