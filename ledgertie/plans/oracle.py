"""The same results in DuckDB SQL, written independently of the operators.

Each statement is a prelude of named tables (base, accounts, the three feeds, the
two tie-outs) and one SELECT over them.
"""

from __future__ import annotations

# Texts that results must carry, and the product types of the line items.
_DETAIL_ACTIONS = {
    "NONE": "No action",
    "FEED_NOT_RECEIVED": "Escalate to source-system owner: no detail received at all",
    "LATE_FEED": "Confirm load cutoff and re-run the missing batches",
    "DUPLICATE_LOAD": "Identify the replayed batch_id and reverse the duplicate load",
    "UNCLASSIFIED": "Manual review",
}
_FILED_ACTIONS = {
    "NONE": "No action",
    "MISSING_FROM_EXTRACT": "GL balance never reached the filing - re-run the extract",
    "NOT_IN_GL": "Filed balance has no GL support - investigate before submission",
    "MAPPING_ERROR": "Correct the product mapping and refile the affected schedules",
    "TIMING_DIFFERENCE": "Late GL adjustment - re-run the extract after the posting date",
    "UNEXPLAINED_OVERSTATEMENT": "Manual review",
}
_LATE_FEED_NOTE = "%d loans missed the load cutoff and never reached the sub-ledger"
_DUPLICATE_LOAD_NOTE = "batch replayed: %d loans double-counted"
_TIMING_NOTE = "GL adjustment posted after the %s extract run; no offsetting entry elsewhere"
_MAPPING_SOURCE_NOTE = "loans mis-tagged out of %s into %s (source side of the pair)"
_MAPPING_TARGET_NOTE = "loans mis-tagged into %s out of %s (target side of the pair)"
_PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

_ORDERS_BASE = """
base AS (
  SELECT 'L' || o_orderkey AS loan_id, o_orderkey AS k, r_name AS entity, r_regionkey AS rk,
         o_orderpriority AS product, CAST(left(o_orderpriority, 1) AS INT) AS pn,
         year(o_orderdate) || 'Q' || quarter(o_orderdate) AS "quarter",
         year(o_orderdate) * 4 + quarter(o_orderdate) AS qn,
         CAST(o_totalprice AS DECIMAL(18,2)) AS loan_amount
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_LINEITEM_BASE = f"""
base AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS loan_id,
         l_orderkey AS k, r_name AS entity, r_regionkey AS rk, p_type AS product,
         list_position({_PART_TYPES!r}, p_type) AS pn,
         year(l_shipdate) || 'Q' || quarter(l_shipdate) AS "quarter",
         year(l_shipdate) * 4 + quarter(l_shipdate) AS qn,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS loan_amount
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_FEEDS = """
coded AS (
  SELECT *, (qn * 7 + rk * 5 + pn * 3) % 23 AS c, (qn * 5 + rk) % 6 AS m FROM base
),
acc0 AS (
  SELECT entity, product, "quarter", rk, pn, qn, c, m, sum(loan_amount) AS bal,
         sum(loan_amount) FILTER (k % 10 < 3) AS planted_amount,
         count(*) FILTER (k % 10 < 3) AS planted_loans
  FROM coded GROUP BY ALL
),
acc AS (
  SELECT a.*, CAST(coalesce(round(0.03 * s.bal, 2), 0) AS DECIMAL(38,2)) AS moved
  FROM acc0 a
  LEFT JOIN acc0 s ON s.entity = a.entity AND s."quarter" = a."quarter" AND s.pn = 1
),
gl AS (
  SELECT entity, product, "quarter",
         CAST(CASE c WHEN 7 THEN 0 ELSE bal END AS DECIMAL(38,2)) AS gl_balance
  FROM acc WHERE c <> 6
),
sub AS (
  SELECT loan_id, entity, product, "quarter", loan_amount,
         format('B{}-{:02d}', "quarter", k % 20 + 1) AS load_batch_id
  FROM coded WHERE c <> 3 AND NOT (c = 1 AND k % 10 < 3)
  UNION ALL
  SELECT loan_id, entity, product, "quarter", loan_amount,
         format('B{}-{:02d}-REPLAY', "quarter", k % 20 + 1)
  FROM coded WHERE c = 2 AND k % 10 < 3
),
ext AS (
  SELECT entity, product, "quarter",
         CAST(CASE WHEN m = 0 AND pn = 1 THEN bal - moved
                   WHEN m = 0 AND pn = 2 THEN bal + moved
                   WHEN m = 0 THEN bal
                   WHEN c = 8 THEN round(CAST(bal AS DECIMAL(30,2)) * 0.978, 2)
                   WHEN c = 10 THEN round(CAST(bal AS DECIMAL(30,2)) * 1.02, 2)
                   WHEN c = 11 THEN round(CAST(bal AS DECIMAL(30,2)) * 1.003, 2)
                   ELSE bal END AS DECIMAL(38,2)) AS extract_balance,
         pn
  FROM acc WHERE m = 0 OR c <> 9
),
key1 AS (
  SELECT entity, product, "quarter",
         CASE c WHEN 1 THEN 'LATE_FEED' WHEN 2 THEN 'DUPLICATE_LOAD'
                ELSE 'FEED_NOT_RECEIVED' END AS expected_root_cause
  FROM acc WHERE c = 3 OR (c IN (1, 2) AND planted_loans > 0)
),
key2 AS (
  SELECT entity, product, "quarter",
         CASE WHEN m = 0 THEN 'MAPPING_ERROR' WHEN c = 8 THEN 'TIMING_DIFFERENCE'
              WHEN c = 9 THEN 'MISSING_FROM_EXTRACT' ELSE 'UNEXPLAINED_OVERSTATEMENT'
         END AS expected_root_cause
  FROM acc WHERE (m = 0 AND pn <= 2 AND moved <> 0) OR (m <> 0 AND c IN (8, 9, 10))
)"""


def _actions(table: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{cause}' THEN '{text}'" for cause, text in table.items())
    return f"CASE root_cause {arms} END AS suggested_action"


_TIEOUTS = f"""
det AS (
  SELECT entity, product, "quarter", sum(loan_amount) AS amount, count(*) AS n,
         count(DISTINCT loan_id) AS ids
  FROM sub GROUP BY ALL
),
flag1 AS (
  SELECT *, round(100.0::DOUBLE * variance::DOUBLE / nullif(gl_balance::DOUBLE, 0), 4)
            AS variance_pct,
         CASE WHEN gl_balance = 0 THEN if(variance = 0, 'PASS', 'BREAK')
              WHEN abs(variance) / abs(gl_balance) * 100 > 0.5 THEN 'BREAK'
              ELSE 'PASS' END AS status
  FROM (
    SELECT entity, product, "quarter", gl_balance,
           CAST(ifnull(amount, 0) AS DECIMAL(38,2)) AS sub_ledger_balance,
           ifnull(n, 0) AS loan_count, ifnull(n - ids, 0) AS duplicate_loan_ids,
           CAST(ifnull(amount, 0) - gl_balance AS DECIMAL(38,2)) AS variance
    FROM gl LEFT JOIN det USING (entity, product, "quarter")
  )
),
t1 AS (
  SELECT *, {_actions(_DETAIL_ACTIONS)}
  FROM (
    SELECT *, CASE WHEN status = 'PASS' THEN 'NONE'
                   WHEN loan_count = 0 THEN 'FEED_NOT_RECEIVED'
                   ELSE if(variance < 0, 'LATE_FEED', 'DUPLICATE_LOAD') END AS root_cause
    FROM flag1
  )
),
flag2 AS (
  SELECT *, round(100.0::DOUBLE * variance::DOUBLE / nullif(gl_balance::DOUBLE, 0), 4)
            AS variance_pct,
         CASE WHEN no_gl OR no_extract THEN 'BREAK'
              WHEN gl_balance = 0 THEN if(variance = 0, 'PASS', 'BREAK')
              WHEN abs(variance) / abs(gl_balance) * 100 > 0.5 THEN 'BREAK'
              ELSE 'PASS' END AS status
  FROM (
    SELECT entity, product, "quarter", g IS NULL AS no_gl, x IS NULL AS no_extract,
           CAST(ifnull(g, 0) AS DECIMAL(38,2)) AS gl_balance,
           CAST(ifnull(x, 0) AS DECIMAL(38,2)) AS extract_balance,
           CAST(ifnull(x, 0) - ifnull(g, 0) AS DECIMAL(38,2)) AS variance
    FROM (SELECT entity, product, "quarter", sum(gl_balance) AS g FROM gl GROUP BY ALL)
    FULL JOIN (SELECT entity, product, "quarter", sum(extract_balance) AS x
               FROM ext GROUP BY ALL) USING (entity, product, "quarter")
  )
),
partner AS (
  SELECT f.entity, f.product, f."quarter", max(o.product) AS offsetting_product
  FROM flag2 f JOIN flag2 o
    ON o.entity = f.entity AND o."quarter" = f."quarter" AND o.product <> f.product
   AND o.variance <> 0 AND abs(o.variance + f.variance) < 0.01
  WHERE f.status = 'BREAK' AND o.status = 'BREAK'
  GROUP BY ALL
),
t2 AS (
  SELECT entity, product, "quarter", gl_balance, extract_balance, variance, variance_pct,
         status, root_cause, offsetting_product, {_actions(_FILED_ACTIONS)}
  FROM (
    SELECT *, CASE WHEN status = 'PASS' THEN 'NONE'
                   WHEN no_extract THEN 'MISSING_FROM_EXTRACT'
                   WHEN no_gl THEN 'NOT_IN_GL'
                   WHEN offsetting_product IS NOT NULL THEN 'MAPPING_ERROR'
                   WHEN variance < 0 THEN 'TIMING_DIFFERENCE'
                   ELSE 'UNEXPLAINED_OVERSTATEMENT' END AS root_cause
    FROM flag2 LEFT JOIN partner USING (entity, product, "quarter")
  )
),
breaks AS (
  SELECT entity, product, "quarter", 'gl_vs_subledger' AS reconciliation,
         abs(variance) AS break_amount FROM flag1 WHERE status = 'BREAK'
  UNION ALL
  SELECT entity, product, "quarter", 'gl_vs_regulatory_extract', abs(variance)
  FROM flag2 WHERE status = 'BREAK'
),
trend AS (
  SELECT "quarter", p.n AS total_accounts,
         count(DISTINCT entity || '|' || product) AS accounts_with_breaks,
         round(100.0::DOUBLE * count(DISTINCT entity || '|' || product) / p.n, 2)
           AS break_rate_pct,
         CAST(ifnull(sum(break_amount), 0) AS DECIMAL(38,2)) AS total_break_amount,
         count(*) FILTER (reconciliation = 'gl_vs_subledger') AS subledger_breaks,
         count(*) FILTER (reconciliation = 'gl_vs_regulatory_extract') AS extract_breaks,
         CAST(ifnull(sum(break_amount) FILTER (reconciliation = 'gl_vs_subledger'), 0)
              AS DECIMAL(38,2)) AS subledger_break_amount,
         CAST(ifnull(sum(break_amount) FILTER (reconciliation = 'gl_vs_regulatory_extract'), 0)
              AS DECIMAL(38,2)) AS extract_break_amount
  FROM (SELECT "quarter", count(*) AS n FROM gl GROUP BY ALL) p
  LEFT JOIN breaks USING ("quarter")
  GROUP BY "quarter", p.n
)"""

_WHAT_IF = f"""
loans AS (
  SELECT l.*, a.bal, CAST(round(a.bal * a.c / 100, 2) AS DECIMAL(38,2)) AS target,
         CAST(round(a.bal * 3 / 100, 2) AS DECIMAL(38,2)) AS target3,
         a.qn * 100 + a.rk * 10 + a.pn AS break_no
  FROM coded l JOIN acc a USING (entity, product, "quarter")
),
ordered AS (
  SELECT *,
    ifnull(sum(loan_amount) OVER (PARTITION BY entity, product, "quarter" ORDER BY k
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
    ifnull(sum(loan_amount) OVER (PARTITION BY entity, product, "quarter" ORDER BY k
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS behind
  FROM loans
),
timing AS (
  SELECT entity, product, "quarter", gl_balance, qn * 100 + rk * 10 + pn AS break_no,
         CAST(-round_even(gl_balance::DECIMAL(24,2) * 0.022, 2) AS DECIMAL(38,2)) AS delta
  FROM gl JOIN acc USING (entity, product, "quarter") WHERE c = 8
),
moves AS (
  SELECT entity, "quarter", any_value(qn * 100 + rk * 10) AS break_no,
         max(product) FILTER (pn = 1) AS source, max(product) FILTER (pn = 2) AS target
  FROM acc WHERE m = 0 GROUP BY ALL
  HAVING source IS NOT NULL AND target IS NOT NULL
),
moved AS (
  SELECT v.*, CAST(round_even(gl_balance::DECIMAL(24,2) * 0.026, 2) AS DECIMAL(38,2)) AS amount
  FROM moves v
  JOIN gl ON gl.entity = v.entity AND gl."quarter" = v."quarter" AND gl.product = v.source
),
mapping AS (
  SELECT s.*, gl.gl_balance FROM (
    SELECT entity, source AS product, "quarter", break_no, source, target, -amount AS delta
    FROM moved
    UNION ALL
    SELECT entity, target, "quarter", break_no, source, target, amount FROM moved
  ) s LEFT JOIN gl USING (entity, product, "quarter")
),
taken AS (
  SELECT entity, product, "quarter", break_no, c, gl_balance, sum(loan_amount) AS amount,
         count(*) AS n
  FROM ordered JOIN gl USING (entity, product, "quarter")
  WHERE (c = 1 AND behind < target3) OR (c = 2 AND ahead < target3)
  GROUP BY ALL
),
register AS (
  SELECT format('BRK-{{:03d}}', break_no) AS break_id, entity, product, "quarter", break_type,
         CASE WHEN break_type IN ('late_feed', 'duplicate_load') THEN 'gl_vs_subledger'
              ELSE 'gl_vs_regulatory_extract' END AS detected_by,
         direction AS expected_direction, upper(break_type) AS expected_root_cause,
         CAST(amount AS DECIMAL(38,2)) AS planted_variance,
         round(100.0::DOUBLE * amount::DOUBLE / nullif(gl_balance::DOUBLE, 0), 4)
           AS planted_variance_pct,
         notes
  FROM (
    SELECT entity, product, "quarter", gl_balance, break_no, 'late_feed' AS break_type,
           'under' AS direction, -amount AS amount,
           printf('{_LATE_FEED_NOTE}', n) AS notes
    FROM taken WHERE c = 1
    UNION ALL
    SELECT entity, product, "quarter", gl_balance, break_no, 'duplicate_load', 'over', amount,
           printf('{_DUPLICATE_LOAD_NOTE}', n) FROM taken WHERE c = 2
    UNION ALL
    SELECT entity, product, "quarter", gl_balance, break_no, 'timing_difference', 'under', delta,
           printf('{_TIMING_NOTE}', CAST(last_day(make_date(left("quarter", 4)::INT,
             right("quarter", 1)::INT * 3, 1)) + 8 AS VARCHAR))
    FROM timing
    UNION ALL
    SELECT entity, product, "quarter", gl_balance, break_no, 'mapping_error',
           if(product = source, 'under', 'over'), delta,
           if(product = source, printf('{_MAPPING_SOURCE_NOTE}', source, target),
              printf('{_MAPPING_TARGET_NOTE}', target, source))
    FROM mapping
  )
)"""

_ORDERS = "WITH " + ",".join([_ORDERS_BASE, _FEEDS, _TIEOUTS, _WHAT_IF])
# Balances of one entity in two rows, a hundred and the rest.
_IN_TWO = """{name} AS (
  SELECT * REPLACE (CAST(if(entity = '{entity}', {amount} - 100, {amount}) AS DECIMAL(38,2))
                    AS {amount}) FROM {name}_whole
  UNION ALL SELECT * REPLACE (CAST(100 AS DECIMAL(38,2)) AS {amount}) FROM {name}_whole
  WHERE entity = '{entity}'
),"""
_SPLIT = _ORDERS
for _name, _amount, _entity, _next in (
    ("gl", "gl_balance", "ASIA", "sub"),
    ("ext", "extract_balance", "EUROPE", "key1"),
):
    _two = _IN_TWO.format(name=_name, amount=_amount, entity=_entity)
    _SPLIT = _SPLIT.replace(f"\n{_name} AS (", f"\n{_name}_whole AS (")
    _SPLIT = _SPLIT.replace(f"\n{_next} AS (", f"\n{_two}\n{_next} AS (")
_LINES = "WITH " + ",".join([_LINEITEM_BASE, _FEEDS, _TIEOUTS])

_KEY = 'entity, product, "quarter"'
_BY = f"USING ({_KEY})"
_RUN_DATE = (
    'CAST(last_day(make_date(left("quarter", 4)::INT, right("quarter", 1)::INT * 3, 1)) + 8 '
    "AS DATE)"
)


def _money(amount: str) -> str:
    return (
        f"CASE WHEN abs({amount}) >= 1e9 THEN format('${{:,.2f}}B', ({amount})::DOUBLE / 1e9) "
        f"WHEN abs({amount}) >= 1e6 THEN format('${{:,.2f}}M', ({amount})::DOUBLE / 1e6) "
        f"WHEN abs({amount}) >= 1e3 THEN format('${{:,.2f}}K', ({amount})::DOUBLE / 1e3) "
        f"ELSE format('${{:,.2f}}', ({amount})::DOUBLE) END"
    )


# CRC-32 of the ASCII text in column ``named``, bit by bit.
_CRC32 = """xor(list_reduce(
    [4294967295] || [ascii(ch)::BIGINT FOR ch IN string_split(named, '')],
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _graded(select: str) -> str:
    """``select`` over both tie-outs: {flag}, {key} and {name} are replaced."""
    sides = [("flag1", "key1", "gl_vs_subledger"), ("flag2", "key2", "gl_vs_regulatory_extract")]
    return " UNION ALL ".join(
        select.format(flag=flag, key=key, name=name, t=flag.replace("flag", "t"))
        for flag, key, name in sides
    )


_MISSED = _graded(
    f"SELECT {_KEY}, '{{name}}' AS reconciliation, 'MISSED' AS verdict FROM {{key}} "
    f"ANTI JOIN (SELECT * FROM {{flag}} WHERE status = 'BREAK') b {_BY}"
)
_SPURIOUS = _graded(
    f"SELECT {_KEY}, '{{name}}' AS reconciliation, 'SPURIOUS' AS verdict FROM {{flag}} "
    f"ANTI JOIN {{key}} {_BY} WHERE status = 'BREAK'"
)
_VERDICTS = (
    " SELECT reconciliation, verdict, count(*) AS accounts "
    f"FROM ({_MISSED} UNION ALL {_SPURIOUS}) GROUP BY ALL"
)
_ALL_KEYS = f"(SELECT {_KEY} FROM key1 UNION ALL SELECT {_KEY} FROM key2)"
_T1 = (
    f" SELECT {_KEY}, gl_balance, sub_ledger_balance, loan_count, duplicate_loan_ids, variance, "
    "variance_pct, status, root_cause, suggested_action FROM t1"
)
_T2 = " SELECT * FROM t2"
_TREND = " SELECT * FROM trend"
_KPIS = f""" SELECT (SELECT count(*) FROM gl) AS accounts_in_scope,
  count(DISTINCT ({_KEY})) AS accounts_with_breaks,
  round(100.0::DOUBLE * count(DISTINCT ({_KEY})) / (SELECT count(*) FROM gl), 1)
    AS break_rate_pct,
  CAST(sum(break_amount) AS DECIMAL(38,2)) AS total_break_amount,
  CAST(max(break_amount) AS DECIMAL(38,2)) AS largest_break FROM breaks"""
_SCOPE = """entity IN ('ASIA', 'EUROPE') AND "quarter" IN ('1996Q1', '1997Q2', '1998Q3')"""
# Products modulo the sum of weights taken at or above zero, so that shares round down.
_SIGNED = f""", weighed AS (
    SELECT l.loan_id, {_KEY}, CAST(if(l.pn % 2 = 1, -l.bal, l.bal) * 100 AS HUGEINT) AS cents,
           CAST(if(a.c = 5, 0, l.k % 97 + 1) AS HUGEINT) AS w
    FROM loans l JOIN (SELECT {_KEY}, c FROM acc) a {_BY}),
  summed AS (
    SELECT *, nullif(CAST(sum(w) OVER (PARTITION BY {_KEY}) AS HUGEINT), 0) AS sw FROM weighed),
  floored AS (SELECT *, ((cents * w) % sw + sw) % sw AS rest FROM summed),
  ranked AS (
    SELECT *, (cents * w - rest) // sw AS share,
           row_number() OVER (PARTITION BY {_KEY} ORDER BY rest DESC, loan_id) AS place
    FROM floored),
  parts AS (
    SELECT loan_id, {_KEY},
      CAST((share + (place <= cents - sum(share) OVER (PARTITION BY {_KEY}))::INT)::DECIMAL(38,2)
        / 100 AS DECIMAL(38,2)) AS part FROM ranked)"""
_MULTISET = """ SELECT loan_id, CAST(ifnull(a, 0) AS BIGINT) AS left_rows,
  CAST(ifnull(b, 0) AS BIGINT) AS right_rows
  FROM (SELECT loan_id, count(*) AS a FROM base GROUP BY ALL)
  FULL JOIN (SELECT loan_id, count(*) AS b FROM sub GROUP BY ALL) USING (loan_id)
  WHERE ifnull(a, 0) <> ifnull(b, 0)"""
_DIGEST_COLUMNS = ["entity", "load_batch_id", "loan_amount", "loan_id", "product", "quarter"]
_DIGEST_ROW = " || ".join(
    f"""length("{c}"::VARCHAR) || ':' || "{c}"::VARCHAR""" for c in _DIGEST_COLUMNS
)
_PROFILE_COLUMNS = {
    "general_ledger": (
        "gl",
        "entity string, product string, quarter string, gl_balance decimal(38,2), "
        "gl_account string, as_of_date date",
    ),
    "sub_ledger": (
        "sub",
        "loan_id string, entity string, product string, quarter string, "
        "loan_amount decimal(18,2), load_batch_id string",
    ),
    "extract": (
        "ext",
        "entity string, product string, quarter string, extract_balance decimal(38,2), "
        "schedule_code string, extract_run_date date",
    ),
}


def _profile() -> str:
    rows = []
    for name, (table, columns) in _PROFILE_COLUMNS.items():
        for place, column in enumerate(columns.split(", "), start=1):
            label, kind = column.split(" ")
            rows.append(
                f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {table}) AS row_count, "
                f"{place} AS position, '{label}' AS column_name, '{kind}' AS data_type"
            )
    return " " + " UNION ALL ".join(rows)


# The what-if over a ledger whose accounts may have two rows: fractions are of their sum.
_WHOLE = _WHAT_IF.replace("JOIN gl ", "JOIN gl_sum AS gl ").replace("FROM gl ", "FROM gl_sum AS gl ")
_SPLIT_WHAT_IF = _SPLIT.replace(
    _WHAT_IF,
    f"""
gl_sum AS (
  SELECT {_KEY}, CAST(sum(gl_balance) AS DECIMAL(38,2)) AS gl_balance FROM gl GROUP BY ALL),
"""
    + _WHOLE
    + f""", deltas AS (
  SELECT {_KEY}, sum(delta) AS delta FROM (
    SELECT {_KEY}, delta FROM timing UNION ALL SELECT {_KEY}, delta FROM mapping) GROUP BY ALL)""",
)

def _partners_within(tolerance: str) -> str:
    return f""" SELECT f.entity, f.product, f."quarter", max(o.product) AS offsetting_product
      FROM flag2 f JOIN flag2 o
        ON o.entity = f.entity AND o."quarter" = f."quarter" AND o.product <> f.product
       AND o.variance <> 0 AND abs(o.variance + f.variance) < {tolerance}
      WHERE f.status = 'BREAK' AND o.status = 'BREAK' GROUP BY ALL"""


# Key figures of every scope: detail breaks and filed breaks, each account once.
_CUBE = """, judged AS (
    SELECT entity, product, "quarter", variance, status, 1 AS counted FROM flag1
    UNION ALL SELECT entity, product, "quarter", variance, status, 0 FROM flag2)
  SELECT CASE WHEN grouping(entity) = 1 THEN 'ALL' ELSE entity END AS entity,
    CASE WHEN grouping("quarter") = 1 THEN 'ALL' ELSE "quarter" END AS "quarter",
    CAST(sum(counted) AS BIGINT) AS accounts_in_scope,
    count(DISTINCT (entity, product, "quarter")) FILTER (status = 'BREAK') AS accounts_with_breaks,
    round(coalesce(100.0::DOUBLE * accounts_with_breaks / nullif(accounts_in_scope, 0), 0), 1)
      AS break_rate_pct,
    CAST(coalesce(sum(abs(variance)) FILTER (status = 'BREAK'), 0) AS DECIMAL(38,2))
      AS total_break_amount,
    CAST(coalesce(max(abs(variance)) FILTER (status = 'BREAK'), 0) AS DECIMAL(38,2))
      AS largest_break
  FROM judged GROUP BY CUBE (judged.entity, judged."quarter")"""
_CAUSE_CUBE = " UNION ALL ".join(
    f"""SELECT CASE WHEN grouping(entity) = 1 THEN 'ALL' ELSE entity END AS entity,
      CASE WHEN grouping("quarter") = 1 THEN 'ALL' ELSE "quarter" END AS "quarter",
      root_cause, count(*) AS breaks, '{name}' AS reconciliation
      FROM {table} t WHERE status = 'BREAK'
      GROUP BY GROUPING SETS ((root_cause), (root_cause, t.entity), (root_cause, t."quarter"),
        (root_cause, t.entity, t."quarter"))"""
    for table, name in (("t1", "gl_vs_subledger"), ("t2", "gl_vs_regulatory_extract"))
)

_ON_ORDERS = {
    "tieout_detail": _T1,
    "tieout_filed": _T2,
    "tieout_filed_full_join": _T2,
    "tieout_filed_union_anti": _T2,
    "tieout_filed_theta": _T2,
    "break_trend": _TREND,
    "all_breaks": f" SELECT {_KEY}, reconciliation, break_amount FROM breaks",
    "detail_rollup": f""" SELECT {_KEY}, CAST(amount AS DECIMAL(38,2)) AS sub_ledger_balance,
      n AS loan_count, ids AS distinct_loan_count FROM det""",
    "balance_rollup": f" SELECT {_KEY}, extract_balance FROM ext",
    "offset_pairs": f" SELECT {_KEY}, offsetting_product FROM partner",
    "offset_pairs_dollar": _partners_within("1.00"),
    "offset_pairs_wide": _partners_within("25000.00"),
    "tieout_filed_within": _T2,
    "presence_flags": """ SELECT no_gl::INT AS missing_from_gl,
      no_extract::INT AS missing_from_extract, status, count(*) AS accounts
      FROM flag2 GROUP BY ALL""",
    "population": ' SELECT "quarter", count(*) AS total_accounts FROM gl GROUP BY ALL',
    "kpi_summary": _KPIS,
    "filtered_breaks": _T1
    + """ WHERE status = 'BREAK' AND entity IN ('ASIA', 'EUROPE')
      AND "quarter" IN ('1996Q1', '1997Q2', '1998Q3')""",
    "cause_counts": """ SELECT root_cause, count(*) AS breaks,
      'gl_vs_subledger' AS reconciliation FROM t1 WHERE status = 'BREAK' GROUP BY ALL
      UNION ALL SELECT root_cause, count(*), 'gl_vs_regulatory_extract'
      FROM t2 WHERE status = 'BREAK' GROUP BY ALL""",
    "trend_long": """ SELECT "quarter", 'GL vs sub-ledger' AS tie_out,
      subledger_break_amount AS amount FROM trend
      UNION ALL SELECT "quarter", 'GL vs extract', extract_break_amount FROM trend""",
    "break_ranking": f""" SELECT {_KEY}, variance_pct, root_cause, variance
      FROM t1 WHERE status = 'BREAK'""",
    "break_ranking_filed": f""" SELECT {_KEY}, variance, root_cause, variance_pct,
      offsetting_product FROM t2 WHERE status = 'BREAK'""",
    "filter_values": ' SELECT DISTINCT "quarter" FROM gl',
    "filter_entities": " SELECT DISTINCT entity FROM gl",
    "kpi_summary_scoped": _KPIS.replace("FROM gl", f"FROM gl WHERE {_SCOPE}").replace(
        "FROM breaks", f"FROM breaks WHERE {_SCOPE}"
    ),
    "kpi_cube": _CUBE,
    "kpi_scope_from_cells": _KPIS.replace("FROM gl", f"FROM gl WHERE {_SCOPE}").replace(
        "FROM breaks", f"FROM breaks WHERE {_SCOPE}"
    ),
    "cause_cube": f" {_CAUSE_CUBE}",
    "published_generations": """ SELECT "quarter", count(*) AS accounts,
        CAST(sum(gl_balance) AS DECIMAL(38,2)) AS balance, CAST(1 AS INTEGER) AS generation
      FROM gl GROUP BY "quarter" UNION ALL SELECT "quarter", count(*),
        CAST(sum(gl_balance) AS DECIMAL(38,2)), 2 FROM gl WHERE entity <> 'ASIA' GROUP BY "quarter\"""",
    "batches_retried": """ SELECT load_batch_id, count(*) AS rows,
      CAST(sum(loan_amount) AS DECIMAL(38,2)) AS amount FROM sub GROUP BY ALL""",
    "rollup_kept_current": f""" SELECT {_KEY}, CAST(amount AS DECIMAL(38,2)) AS sub_ledger_balance,
      n AS loan_count, ids AS distinct_loan_count FROM det""",
    "fetched_trend": " SELECT *, unnest(['arrow', 'rows']) AS way FROM trend",
    "multiset_diff_tree": _MULTISET,
    "table_sample": """ SELECT loan_id, entity, product, "quarter", loan_amount, load_batch_id
      FROM sub ORDER BY loan_id, load_batch_id LIMIT 3""",
    "apportion_signed": f" {_SIGNED} SELECT * FROM parts",
    "not_apportioned": f" {_SIGNED} SELECT * FROM parts WHERE part IS NULL OR part <= 0",
    "break_counts": """, counted AS (
      SELECT 'gl_vs_subledger' AS result, count(*) AS result_rows,
             count(*) FILTER (status = 'BREAK') AS breaks FROM t1
      UNION ALL SELECT 'gl_vs_regulatory_extract', count(*),
             count(*) FILTER (status = 'BREAK') FROM t2
      UNION ALL SELECT 'quarterly_break_trend', count(*), NULL FROM trend)
      SELECT * FROM counted UNION ALL
      SELECT 'all', CAST(sum(result_rows) AS BIGINT), CAST(sum(breaks) AS BIGINT) FROM counted""",
    "money_labels": f""" SELECT {_KEY}, reconciliation,
      {_money("break_amount")} AS label FROM breaks""",
    "money_labels_totals": f""", totals AS (
      SELECT "quarter", sum(variance) AS net, sum(gl_balance) AS ledger,
             sum(gl_balance) / 10 AS tenth FROM flag2 GROUP BY ALL)
      SELECT "quarter", {_money("net")} AS net_label, {_money("ledger")} AS ledger_label,
             {_money("tenth")} AS tenth_label FROM totals""",
    "apportion": f""", weighed AS (
      SELECT loan_id, {_KEY}, CAST(bal * 100 AS HUGEINT) AS cents,
             CAST(k % 97 + 1 AS HUGEINT) AS w,
             CAST(sum(k % 97 + 1) OVER account AS HUGEINT) AS sw
      FROM loans WINDOW account AS (PARTITION BY {_KEY})),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY cents * w % sw DESC, loan_id)
               AS place,
             cents - sum(cents * w // sw) OVER (PARTITION BY {_KEY}) AS left_over
      FROM weighed)
      SELECT loan_id, {_KEY},
        CAST((cents * w // sw + (place <= left_over)::INT)::DECIMAL(38,2) / 100 AS DECIMAL(38,2))
          AS part FROM ranked""",
    "assign_batches": f""", numbered AS (
      SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY k) - 1 AS position FROM base)
      SELECT loan_id, {_KEY}, position,
        format('B{{}}-{{:02d}}', "quarter", position // 25 + 1) AS load_batch_id,
        array_to_string([left(w, 1) for w in string_split(entity, ' ')], '')
          || '-' || upper(left(product, 3)) || '-' || "quarter" || '-'
          || format('{{:04d}}', position) AS loan_label
      FROM numbered""",
    "drop_tail": f" SELECT loan_id, {_KEY}, loan_amount FROM ordered WHERE behind >= target",
    "replay_head": f"""SELECT loan_id, {_KEY}, loan_amount,
        format('B{{}}-{{:02d}}', "quarter", k % 20 + 1) AS load_batch_id FROM ordered
      UNION ALL SELECT loan_id, {_KEY}, loan_amount,
        format('B{{}}-{{:02d}}-REPLAY', "quarter", k % 20 + 1) FROM ordered
      WHERE ahead < target""",
    "adjust_balance": f""" SELECT {_KEY},
      CAST(gl.gl_balance + ifnull(delta, 0) AS DECIMAL(38,2)) AS gl_balance
      FROM gl LEFT JOIN timing {_BY}""",
    "reclass_balance": f""" SELECT {_KEY},
      CAST(ifnull(gl.gl_balance, 0) + ifnull(delta, 0) AS DECIMAL(38,2)) AS gl_balance
      FROM gl FULL JOIN mapping {_BY}""",
    "reclass_totals": """ SELECT entity, "quarter",
      CAST(sum(gl_balance) AS DECIMAL(38,2)) AS total_before,
      CAST(sum(gl_balance) AS DECIMAL(38,2)) AS total_after FROM gl GROUP BY ALL""",
    "unmatched_scenarios": f""" SELECT {_KEY}, 'timing_difference' AS kind
      FROM (SELECT * FROM acc WHERE c = 8) ANTI JOIN gl {_BY}
      UNION ALL SELECT {_KEY}, 'mapping_error'
      FROM (SELECT entity, source AS product, "quarter" FROM moves) ANTI JOIN gl {_BY}""",
    "expected_breaks": " SELECT * FROM register",
    "filed_from_gl": f""" SELECT {_KEY},
      CAST(ifnull(gl.gl_balance, 0) + ifnull(timing.delta, 0) + ifnull(mapping.delta, 0)
        AS DECIMAL(38,2)) AS extract_balance,
      'H.' || left(product, 1) AS schedule_code, {_RUN_DATE} AS extract_run_date
      FROM gl FULL JOIN timing {_BY} FULL JOIN mapping {_BY}""",
    "account_labels": f""" SELECT {_KEY},
      'GL-H' || left(product, 1) || '-' || ({_CRC32} % 9000 + 1000) AS gl_account,
      CAST({_RUN_DATE} - 8 AS DATE) AS as_of_date
      FROM (SELECT *, entity || '|' || product AS named FROM gl)""",
    "grade_missed": " SELECT * EXCLUDE (verdict) FROM (%s)"
    % _MISSED.replace("status = 'BREAK'", "status = 'BREAK' AND entity <> 'AFRICA'"),
    "grade_spurious": f" SELECT * EXCLUDE (verdict) FROM ({_SPURIOUS})",
    "grade_verdicts": _VERDICTS,
    "extra_break_rows": " "
    + _graded(
        "SELECT (SELECT count(*) FROM {flag} WHERE status = 'BREAK') AS break_rows, "
        "(SELECT count(*) FROM {key}) AS expected_accounts, '{name}' AS reconciliation "
        "WHERE break_rows <> expected_accounts"
    ),
    "clean_over_threshold": " "
    + _graded(
        f"SELECT {_KEY}, variance, status, '{{name}}' AS reconciliation FROM {{flag}} "
        f"ANTI JOIN {_ALL_KEYS} {_BY} WHERE abs(variance_pct) > 0.5 OR status <> 'PASS'"
    ),
    "clean_not_zero": " "
    + _graded(
        f"SELECT {_KEY}, variance, variance_pct, '{{name}}' AS reconciliation FROM {{flag}} "
        f"ANTI JOIN {_ALL_KEYS} {_BY} WHERE variance <> 0"
    ),
    "cause_mismatches": " "
    + _graded(
        f"SELECT {_KEY}, variance, root_cause, expected_root_cause, '{{name}}' AS reconciliation "
        f"FROM {{t}} JOIN {{key}} {_BY} WHERE status = 'BREAK' AND (root_cause <> "
        "expected_root_cause OR (root_cause IN ('LATE_FEED', 'TIMING_DIFFERENCE') AND "
        "variance >= 0) OR (root_cause = 'DUPLICATE_LOAD' AND variance <= 0))"
    ),
    "uncorroborated_duplicates": f""" SELECT {_KEY}, root_cause, duplicate_loan_ids FROM t1
      WHERE (root_cause = 'DUPLICATE_LOAD') <> (duplicate_loan_ids > 0)""",
    "pair_symmetry": """ SELECT count(*) AS named,
      count(*) FILTER (p.offsetting_product IS DISTINCT FROM a.product
                       OR a.variance + p.variance <> 0) AS asymmetric
      FROM t2 a LEFT JOIN t2 p ON p.entity = a.entity AND p."quarter" = a."quarter"
        AND p.product = a.offsetting_product AND p.root_cause = 'MAPPING_ERROR'
      WHERE a.root_cause = 'MAPPING_ERROR'""",
    "two_sided_timing": f""" SELECT {_KEY}, variance, offsetting_product
      FROM (SELECT * REPLACE (CAST(if(entity = 'ASIA', -variance, variance) AS DECIMAL(38,2))
                              AS variance) FROM t2)
      WHERE root_cause = 'TIMING_DIFFERENCE'
        AND (offsetting_product IS NOT NULL OR variance >= 0)""",
    "footing_check": f""" SELECT {_KEY}, variance, k.product IS NOT NULL AS planted
      FROM flag1 f LEFT JOIN (SELECT * FROM key1) k {_BY}
      WHERE (variance <> 0) <> (k.expected_root_cause IS NOT NULL)""",
    "trend_agreement": """ SELECT "quarter", accounts_with_breaks, subledger_breaks,
      extract_breaks, total_break_amount, own_accounts, own_subledger, own_extract, own_amount
      FROM trend FULL JOIN (
        SELECT "quarter", count(DISTINCT (entity, product)) AS own_accounts,
          count(*) FILTER (detail) AS own_subledger, count(*) FILTER (NOT detail) AS own_extract,
          CAST(sum(abs(variance)) AS DECIMAL(38,2)) AS own_amount
        FROM (
          SELECT entity, product, "quarter", variance, true AS detail FROM t1
          WHERE root_cause <> 'NONE'
          UNION ALL SELECT entity, product, "quarter", variance, false FROM t2
          WHERE root_cause <> 'NONE')
        GROUP BY ALL) USING ("quarter")""",
    "trend_mismatches": """ SELECT t."quarter",
        t.extract_breaks - a.n AS extract_breaks, t.extract_breaks AS own_extract,
        CAST(t.total_break_amount - a.amount AS DECIMAL(38,2)) AS total_break_amount,
        t.total_break_amount AS own_amount
      FROM trend t JOIN (
        SELECT "quarter", count(*) AS n, sum(break_amount) AS amount FROM breaks
        WHERE entity = 'AFRICA' AND reconciliation = 'gl_vs_regulatory_extract' GROUP BY ALL
      ) a USING ("quarter")""",
    "trend_coverage": """ SELECT (SELECT count(*) FROM breaks) AS trend_breaks,
      (SELECT count(*) FROM key1) + (SELECT count(*) FROM key2) AS expected_breaks,
      (SELECT count(*) FROM trend WHERE break_rate_pct > 100) AS periods_over_100
      WHERE trend_breaks <> expected_breaks OR periods_over_100 > 0""",
    "register_repeated": f""" SELECT {_KEY}, count(*) AS rows FROM register
      GROUP BY ALL HAVING count(*) > 1""",
    "register_missing_modes": """ SELECT * FROM (VALUES ('duplicate_load'), ('late_feed'),
      ('mapping_error'), ('timing_difference')) v(break_type)
      WHERE break_type NOT IN (
        SELECT break_type FROM register WHERE break_type <> 'mapping_error')""",
    "register_thin_margins": f""" SELECT break_id, {_KEY}, planted_variance_pct FROM register
      WHERE abs(planted_variance_pct) <= 1 OR planted_variance_pct IS NULL""",
    "register_unbalanced": """ SELECT break_id, count(*) AS sides,
      count(*) FILTER (expected_direction = 'under') AS "under",
      count(*) FILTER (expected_direction = 'over') AS "over",
      CAST(sum(planted_variance) AS DECIMAL(38,2)) AS net
      FROM register WHERE break_type = 'mapping_error'
        AND (entity <> 'EUROPE' OR expected_direction = 'under') GROUP BY break_id
      HAVING count(*) <> 2 OR sum(planted_variance) <> 0
        OR count(DISTINCT expected_direction) <> 2""",
    "branch_overlap": f""", g AS (
      SELECT entity, if(entity = 'EUROPE', NULL, product) AS product, "quarter" FROM gl),
    x AS (SELECT entity, if(entity = 'EUROPE', NULL, product) AS product, "quarter" FROM ext)
      SELECT {_KEY} FROM g INTERSECT SELECT {_KEY} FROM x WHERE NOT EXISTS (
        SELECT 1 FROM g
        WHERE g.entity = x.entity AND g.product = x.product AND g."quarter" = x."quarter")""",
    "form_differences": f""", paired AS (
      SELECT {_KEY}, gl_balance, CAST(ifnull(extract_balance, 0) AS DECIMAL(38,2)) AS filed
      FROM gl LEFT JOIN ext {_BY}
      UNION ALL SELECT {_KEY}, 0, extract_balance FROM ext ANTI JOIN gl {_BY}),
    joined AS (SELECT {_KEY}, gl_balance, extract_balance FROM flag2),
    opposite AS (
      SELECT f.entity, f.product, f."quarter", max(o.product) AS offsetting_product
      FROM flag2 f JOIN flag2 o ON o.entity = f.entity AND o."quarter" = f."quarter"
        AND o.variance = -f.variance AND o.product <> f.product
      WHERE f.status = 'BREAK' AND o.status = 'BREAK' AND f.variance <> 0 GROUP BY ALL)
      SELECT 'full_join' AS form,
        (SELECT count(*) FROM (FROM paired EXCEPT ALL FROM joined))
        + (SELECT count(*) FROM (FROM joined EXCEPT ALL FROM paired)) AS differing_rows
      UNION ALL SELECT 'theta',
        (SELECT count(*) FROM (FROM opposite EXCEPT ALL FROM partner))
        + (SELECT count(*) FROM (FROM partner EXCEPT ALL FROM opposite))
      UNION ALL SELECT 'unpaired', 2 * count(*) FROM partner""",
    "multiset_diff": _MULTISET,
    "account_difference": f""" SELECT {_KEY}, 'left' AS side FROM gl ANTI JOIN ext {_BY}
      UNION ALL SELECT {_KEY}, 'right' FROM ext ANTI JOIN gl {_BY}""",
    "universe_gaps": f""" SELECT {_KEY} FROM (SELECT DISTINCT entity FROM gl)
      CROSS JOIN (SELECT DISTINCT product FROM gl) CROSS JOIN (SELECT DISTINCT "quarter" FROM gl)
      ANTI JOIN gl {_BY}""",
    "load_checks": """ SELECT *, source_rows = target_rows AND source_total = target_total
        AND nulls = 0 AS passed FROM (
      SELECT (SELECT count(*) FROM base) AS source_rows,
        (SELECT sum(loan_amount) FROM base) AS source_total, count(*) AS target_rows,
        sum(loan_amount) AS target_total,
        6 * count(*) - count(loan_id) - count(entity) - count(product) - count("quarter")
          - count(loan_amount) - count(load_batch_id) AS nulls,
        'sub_ledger' AS table_name FROM sub
      UNION ALL SELECT count(*), sum(gl_balance), count(*), sum(gl_balance),
        count(*) FILTER (entity = 'AFRICA'), 'general_ledger' FROM gl
      UNION ALL SELECT count(*), sum(extract_balance), count(*), sum(extract_balance),
        4 * count(*) - count(entity) - count(product) - count("quarter")
          - count(extract_balance), 'regulatory_extract' FROM ext)""",
    "append_twice": f""" SELECT {_KEY}, count(*) AS rows
      FROM (FROM gl UNION ALL FROM gl) GROUP BY ALL""",
    "refresh_twice": f" SELECT {_KEY}, count(*) AS rows FROM gl GROUP BY ALL",
    "loaded_tieout": _T1,
    "table_profile": _profile(),
    "content_digest": f""" SELECT count(*) AS row_count,
      CAST(sum(CAST('0x' || left(sha256({_DIGEST_ROW}), 15) AS BIGINT)) AS DECIMAL(38,0))
        AS digest FROM sub""",
}

_ON_LINES = {
    "tieout_detail_lineitem": _T1,
    "tieout_filed_lineitem": _T2,
    "break_trend_lineitem": _TREND,
    "kpi_summary_lineitem": _KPIS,
    "grade_verdicts_lineitem": _VERDICTS,
    "multiset_diff_lineitem": _MULTISET,
    "multiset_diff_tree_lineitem": _MULTISET,
}


def statements() -> dict[str, str]:
    return {
        **{name: _ORDERS + body for name, body in _ON_ORDERS.items()},
        **{name: _LINES + body for name, body in _ON_LINES.items()},
        "tieout_detail_split": _SPLIT + _T1,
        "tieout_filed_split": _SPLIT + _T2,
        "expected_breaks_split": _SPLIT_WHAT_IF + " SELECT * FROM register",
        "what_if_split": _SPLIT_WHAT_IF
        + f""" SELECT {_KEY}, CAST(ifnull(g.gl_balance, 0) + if(ifnull(place, 1) = 1,
          ifnull(delta, 0), 0) AS DECIMAL(38,2)) AS gl_balance
          FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY gl_balance) AS place
                FROM gl) g FULL JOIN deltas {_BY}""",
        "reclass_totals_split": _SPLIT_WHAT_IF + _ON_ORDERS["reclass_totals"],
        "duplicate_ids": """
          SELECT l_returnflag, l_linestatus,
                 sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS balance, count(*) AS loan_count,
                 count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_loan_count,
                 count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_ids
          FROM lineitem GROUP BY ALL""",
        "repeated_ids": """
          SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
          GROUP BY ALL HAVING count(*) > 1""",
    }
