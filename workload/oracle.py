"""The same queries as plain SQL over the driver's tables, written independently of the library.

The SQL takes the direct route (full grids, windows over all invoices, left joins), so agreement
also checks the rewrites the library makes for scale.
"""

from __future__ import annotations


def _orders(vendor: str) -> str:
    return f"""
inv AS (
  SELECT CAST({vendor} AS VARCHAR) AS vendor,
         CAST(o_orderkey AS VARCHAR) AS invoice,
         o_orderdate AS issued,
         o_orderdate + to_days(CAST(o_orderkey % 120 AS INTEGER)) AS period_end,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders)"""


M1 = _orders("o_custkey")
M2 = _orders("o_custkey % 100")
M3 = """
inv AS (
  SELECT CAST(l_partkey AS VARCHAR) AS vendor,
         CAST(l_orderkey AS VARCHAR) AS invoice,
         l_shipdate AS issued,
         CAST((CAST(round(l_extendedprice * 100) AS BIGINT)
               // CASE WHEN l_orderkey % 29 = 0 THEN 100
                       WHEN l_orderkey % 31 = 0 THEN 5 ELSE 2000 END) AS DECIMAL(18,2))
           * CAST(0.01 AS DECIMAL(3,2)) AS amount
  FROM lineitem)"""
#: Amounts in whole millionths.
M4 = """
inv AS (
  SELECT CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_custkey % 300 AS VARCHAR) END AS vendor,
         CAST(o_orderkey AS VARCHAR) AS invoice,
         CASE WHEN o_orderkey % 89 <> 0
              THEN o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
                   + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) + to_days(later) END AS issued,
         CAST(round(o_totalprice * 100) AS BIGINT) * 137
           * CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE 1 END AS amount
  FROM orders JOIN (VALUES (1, 0), (5, 3), (7, 0)) AS copies(every, later) ON o_orderkey % every = 0)"""
LINES = """
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS invoice,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line_item,
         l_shipdate AS period_end
  FROM lineitem)"""

LATEST = """
latest AS (SELECT vendor, invoice, max(issued) AS issued FROM inv GROUP BY vendor, invoice)"""
LAGGED = """
lagged AS (
  SELECT *, lag(issued) OVER (PARTITION BY vendor ORDER BY issued NULLS FIRST, invoice) AS previous
  FROM latest)"""


def _months(later: str, earlier: str) -> str:
    return f"""(date_diff('month', {earlier}, {later})
      - CASE WHEN day({later}) >= day({earlier})
               OR (last_day({later}) = CAST({later} AS DATE)
                   AND last_day({earlier}) = CAST({earlier} AS DATE))
             THEN 0 ELSE 1 END)"""


def _tick(rules: str) -> str:
    return "`" if rules == "code" else ""


def _dormant(rules: str = "code") -> str:
    tick = _tick(rules)
    return f"""
dormant AS (
  SELECT vendor AS canonical_vendor_id, invoice AS invoice_id,
         CAST(issued AS DATE) AS insight_date,
         'First new bill in ' || {_months("issued", "previous")}
           || ' months from vendor {tick}' || vendor || '{tick}' AS insight_text
  FROM lagged WHERE date_diff('day', previous, issued) > 90)"""


def _accrual(rules: str = "code") -> str:
    tick = _tick(rules)
    if rules == "code":
        latest, through = "max(l.period_end)", ""
    else:
        latest, through = "max(greatest(i.period_end, l.period_end))", "through "
    return f"""
ends AS (
  SELECT i.vendor, i.invoice, i.issued, {latest} AS period_end
  FROM inv i LEFT JOIN lines l ON i.invoice = l.invoice
  GROUP BY i.vendor, i.invoice, i.issued),
accrual AS (
  SELECT vendor AS canonical_vendor_id, invoice AS invoice_id,
         CAST(issued AS DATE) AS insight_date, issued,
         'Line items from vendor {tick}' || vendor
           || '{tick} in this invoice cover future periods ({through}'
           || strftime(period_end, '%Y-%m-%d') || ')' AS insight_text
  FROM ends
  WHERE period_end > CAST(issued AS DATE) + 90)"""


AMOUNTS = """
amounts AS (
  SELECT vendor, invoice, issued, max(amount) AS amount FROM inv GROUP BY ALL)"""
MONTHLY = """
monthly AS (
  SELECT vendor, CAST(date_trunc('month', issued) AS DATE) AS month, sum(amount) AS spend
  FROM amounts GROUP BY ALL)"""
HISTORY = """
history AS (
  SELECT *, CAST(spend * 100 AS HUGEINT) AS e,
         CAST(sum(spend) OVER w * 100 AS HUGEINT) AS s,
         count(spend) OVER w AS n
  FROM monthly
  WINDOW w AS (PARTITION BY vendor ORDER BY month
               RANGE BETWEEN INTERVAL 365 DAYS PRECEDING AND CURRENT ROW))"""
HISTORY_MILLIONTHS = """
history AS (
  SELECT *, spend AS e, sum(spend) OVER w AS s, count(spend) OVER w AS n
  FROM monthly WHERE month IS NOT NULL
  WINDOW w AS (PARTITION BY vendor ORDER BY month
               RANGE BETWEEN INTERVAL 365 DAYS PRECEDING AND CURRENT ROW))"""
LARGE_MILLIONTHS = """
cents AS (
  SELECT vendor, month, (2 * e + 10000) // 20000 AS e,
         (2 * s + 10000 * n) // (20000 * n) AS average
  FROM history
  WHERE s > 0 AND (e > 10000000000 AND 2 * e * n > 3 * s
                   OR e > 1000000000 AND e < 10000000000 AND e * n > 3 * s
                   OR e > 100000000 AND e < 1000000000 AND e * n > 6 * s)),
large AS (
  SELECT vendor AS canonical_vendor_id, month AS insight_date,
         'Monthly spend with `' || vendor || '` is $' || (e // 100) || '.'
           || lpad(CAST(e % 100 AS VARCHAR), 2, '0') || ' (' || (average // 100) || '.'
           || lpad(CAST(average % 100 AS VARCHAR), 2, '0') || '%) higher than average.' AS insight_text
  FROM cents)"""
HISTORY_12_BEFORE = """
history AS (
  SELECT *, CAST(spend * 100 AS HUGEINT) AS e,
         CAST(sum(spend) OVER w * 100 AS HUGEINT) AS s,
         count(spend) OVER w AS n
  FROM monthly
  WINDOW w AS (PARTITION BY vendor ORDER BY month
               RANGE BETWEEN INTERVAL 12 MONTHS PRECEDING AND INTERVAL 1 MONTH PRECEDING))"""
BANDED = """
banded AS (
  SELECT *, CASE WHEN s <= 0 THEN NULL
                 WHEN e > 1000000 AND 2 * e * n > 3 * s THEN 1
                 WHEN e > 100000 AND e < 1000000 AND e * n > 3 * s THEN 2
                 WHEN e > 10000 AND e < 100000 AND e * n > 6 * s THEN 3 END AS band
  FROM history)"""
BANDED_DOCUMENTED = """
banded AS (
  SELECT *, CASE WHEN s <= 0 THEN NULL
                 WHEN e > 1000000 AND 2 * e * n > 3 * s THEN 1
                 WHEN e >= 100000 AND e <= 1000000 AND e * n > 3 * s THEN 2
                 WHEN e >= 10000 AND e < 100000 AND e * n > 6 * s THEN 3 END AS band
  FROM history)"""


def _hundredths(value: str) -> str:
    return f"(({value}) // 100) || '.' || lpad(CAST(({value}) % 100 AS VARCHAR), 2, '0')"


_AVERAGE = "(2 * s + n) // (2 * n)"
_PERCENT = "(20000 * (e * n - s) + s) // (2 * s)"


def _spend(rules: str = "code") -> str:
    tick, stop = _tick(rules), "." if rules == "code" else ""
    versus = _AVERAGE if rules == "code" else _PERCENT
    return f"""
large AS (
  SELECT vendor AS canonical_vendor_id, month AS insight_date,
         'Monthly spend with {tick}' || vendor || '{tick} is $' || {_hundredths("e")} || ' ('
           || {_hundredths(versus)} || '%) higher than average{stop}' AS insight_text
  FROM banded WHERE band IS NOT NULL)"""


def _calendar(unit: str) -> str:
    step = {"month": 1, "quarter": 3}[unit]
    return f"""
cal_{unit} AS (
  SELECT CAST(unnest(generate_series(date_trunc('{unit}', min(issued)),
                                     date_trunc('{unit}', max(issued)),
                                     INTERVAL {step} MONTH)) AS DATE) AS cadence
  FROM inv),
grid_{unit} AS (
  SELECT v.vendor, c.cadence
  FROM (SELECT DISTINCT vendor FROM inv) v CROSS JOIN cal_{unit} c)"""


def _cells(unit: str) -> str:
    return f"""
cells_{unit} AS (
  SELECT g.vendor, g.cadence, min(CAST(i.issued AS DATE)) AS first_day,
         count(DISTINCT i.invoice) AS n_invoices
  FROM grid_{unit} g
  LEFT JOIN inv i ON i.vendor = g.vendor
                 AND CAST(date_trunc('{unit}', i.issued) AS DATE) = g.cadence
  GROUP BY g.vendor, g.cadence)"""


def _cell_history(unit: str, lookback: int) -> str:
    lags = ", ".join(
        f"lag(n_invoices, {k}) OVER w AS back_{k}" for k in range(1, lookback + 1)
    )
    before = (
        "PARTITION BY vendor ORDER BY cadence "
        f"ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING"
    )
    return f"""
history_{unit} AS (
  SELECT *, min(first_day) OVER ({before}) AS earliest_day,
         list_sort(list(DISTINCT first_day) FILTER (first_day IS NOT NULL) OVER ({before}))
           AS first_days,
         {lags}
  FROM cells_{unit}
  WINDOW w AS (PARTITION BY vendor ORDER BY cadence))"""


def _misses(unit: str) -> str:
    lookback = {"month": 3, "quarter": 2}[unit]
    active = " AND ".join(f"back_{k} > 0" for k in range(1, lookback + 1))
    return f"""{_calendar(unit)},{_cells(unit)},{_cell_history(unit, lookback)},
missed_{unit} AS (
  SELECT vendor, cadence,
         TRY_CAST(strftime(cadence, '%Y-%m-') || lpad(CAST(day(earliest_day) AS VARCHAR), 2, '0')
                  AS DATE) AS start_day,
         COALESCE(first_day, CAST(date_trunc('month', cadence + 32) AS DATE)) AS end_day
  FROM history_{unit}
  WHERE {active})"""


MISSES = f"""{_misses("month")},{_misses("quarter")},
month_hits AS (SELECT * FROM missed_month WHERE end_day > start_day),
quarter_hits AS (
  SELECT * FROM missed_quarter q
  WHERE end_day > start_day
    AND NOT EXISTS (SELECT 1 FROM month_hits m
                    WHERE m.vendor = q.vendor
                      AND CAST(date_trunc('quarter', m.cadence) AS DATE) = q.cadence))"""


def _documented_misses(unit: str) -> str:
    lookback = {"month": 3, "quarter": 2}[unit]
    step = {"month": 1, "quarter": 3}[unit]
    wanted = "> 0" if unit == "month" else "= 1"
    active = " AND ".join(f"back_{k} {wanted}" for k in range(1, lookback + 1))
    return f"""{_calendar(unit)},{_cells(unit)},{_cell_history(unit, lookback)},
expected_{unit} AS (SELECT vendor, cadence, first_day FROM history_{unit} WHERE {active}),
days_{unit} AS (
  SELECT e.vendor, e.cadence, day(i.issued) AS dom,
         row_number() OVER (PARTITION BY e.vendor, e.cadence
                            ORDER BY count(DISTINCT (i.invoice, CAST(i.issued AS DATE))) DESC,
                                     day(i.issued)) AS place
  FROM expected_{unit} e
  JOIN inv i ON i.vendor = e.vendor AND i.issued < e.cadence
            AND i.issued >= e.cadence - INTERVAL {step * lookback} MONTH
  GROUP BY e.vendor, e.cadence, day(i.issued)),
missed_{unit} AS (
  SELECT e.vendor, e.cadence, d.dom,
         least(CAST(e.cadence + CAST(d.dom - 1 AS INTEGER) AS DATE),
               last_day(e.cadence)) AS start_day,
         least(COALESCE(e.first_day, CAST(e.cadence + INTERVAL 1 MONTH AS DATE)),
               CAST(e.cadence + INTERVAL 1 MONTH AS DATE)) AS end_day
  FROM expected_{unit} e JOIN days_{unit} d
    ON d.vendor = e.vendor AND d.cadence = e.cadence AND d.place = 1)"""


DOCUMENTED_MISSES = f"""{_documented_misses("month")},{_documented_misses("quarter")},
month_hits AS (SELECT * FROM missed_month WHERE end_day > start_day),
quarter_hits AS (
  SELECT * FROM missed_quarter q
  WHERE end_day > start_day
    AND NOT EXISTS (SELECT 1 FROM month_hits m
                    WHERE m.vendor = q.vendor
                      AND CAST(date_trunc('quarter', m.cadence) AS DATE) = q.cadence))"""


def _any_cadence(ordinal: str, start: str, usual: str, place: str, deadline: str, lookback: int) -> str:
    """Missed periods of any cadence on the full grid. ``ordinal`` numbers the period of {day}, ``start``
    is the first day of period {o}; ``place`` and ``deadline`` see first_of_period and usual_day."""
    before = f"PARTITION BY vendor ORDER BY o ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING"
    day = "CAST(issued AS DATE)"
    return f"""
numbered AS (SELECT *, {ordinal.format(day=day)} AS o FROM inv WHERE issued IS NOT NULL),
grid AS (
  SELECT v.vendor, c.o FROM (SELECT DISTINCT vendor FROM inv) v
  CROSS JOIN (SELECT unnest(generate_series(min(o), max(o))) AS o FROM numbered) c),
cells AS (
  SELECT g.vendor, g.o, min(CAST(i.issued AS DATE)) AS first_day, count(DISTINCT i.invoice) AS n
  FROM grid g LEFT JOIN numbered i ON i.vendor = g.vendor AND i.o = g.o GROUP BY g.vendor, g.o),
runs AS (
  SELECT *, {start.format(o="o")} AS first_of_period, min(n) OVER ({before}) AS fewest, count(*) OVER ({before}) AS past,
         min(first_day) OVER ({before}) AS expected FROM cells),
placed AS (
  SELECT vendor, first_of_period, first_day, {usual.format(day="expected")} AS usual_day
  FROM runs WHERE fewest > 0 AND past = {lookback}),
hits AS (
  SELECT vendor, first_of_period AS cadence, usual_day AS usual, {place} AS start_day,
         coalesce(first_day, {deadline}) AS end_day
  FROM placed),
late AS (SELECT * FROM hits WHERE end_day > start_day)"""


_MONTH_PLACE = (
    "TRY_CAST(strftime(first_of_period, '%Y-%m-') || lpad(CAST(usual_day AS VARCHAR), 2, '0') AS DATE)"
)
_MONTH_END = "CAST(first_of_period + INTERVAL 1 MONTH AS DATE)"
WEEKLY = _any_cadence(
    "(date_diff('day', DATE '1970-01-05', {day}) // 7)",
    "CAST(DATE '1970-01-05' + CAST(7 * {o} AS INTEGER) AS DATE)",
    "(date_diff('day', DATE '1970-01-05', {day}) % 7 + 1)",
    "CAST(first_of_period + CAST(usual_day - 1 AS INTEGER) AS DATE)",
    "CAST(first_of_period + 7 AS DATE)",
    3,
)
HALF_YEARLY = _any_cadence(
    "((year({day}) * 12 + month({day}) - 1) // 6)",
    "make_date({o} * 6 // 12, {o} * 6 % 12 + 1, 1)",
    "day({day})",
    _MONTH_PLACE,
    _MONTH_END,
    2,
)
FISCAL = _any_cadence(
    "((year({day}) * 12 + month({day}) - 2) // 3)",
    "make_date(({o} * 3 + 1) // 12, ({o} * 3 + 1) % 12 + 1, 1)",
    "day({day})",
    _MONTH_PLACE,
    _MONTH_END,
    4,
)
_SPAN = 'SELECT vendor, cadence, start_day AS start, end_day AS "end" FROM late'


def _missing(rules: str = "code") -> str:
    tick, stop = _tick(rules), "." if rules == "code" else ""
    usual = "day(start_day)" if rules == "code" else "dom"
    return f"""
hits AS (SELECT *, {usual} AS usual FROM month_hits
         UNION ALL SELECT *, {usual} AS usual FROM quarter_hits),
expanded AS (
  SELECT vendor, usual,
         CAST(unnest(generate_series(start_day, end_day - 1, INTERVAL 1 DAY)) AS DATE) AS day
  FROM hits),
missing AS (
  SELECT vendor AS canonical_vendor_id, day AS insight_date,
         '{tick}' || vendor || '{tick} generally charges between on ' || usual
           || ' day of each month invoices are sent. On ' || strftime(day, '%Y-%m-%d')
           || ', an invoice from {tick}' || vendor || '{tick} has not been received{stop}'
           AS insight_text
  FROM expanded)"""


def _id(alert_type: int, invoice: str, extra: str = "") -> str:
    key = (
        f"'{alert_type}' || chr(31) || coalesce(canonical_vendor_id, chr(30)) || chr(31) || {invoice} || chr(31) "
        f"|| strftime(insight_date, '%Y-%m-%d') || chr(31) || coalesce(insight_text, chr(30)){extra}"
    )
    digest = f"md5({key})"
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {a}, {n})" for a, n in parts)


def _alerts(source: str, alert_type: int, location: int, extra: str = "") -> str:
    has_invoice = location == 1
    invoice = "invoice_id" if has_invoice else "CAST(NULL AS VARCHAR)"
    key = "invoice_id" if has_invoice else "chr(30)"
    return f"""SELECT {_id(alert_type, key, extra)} AS glean_id,
  insight_date AS glean_date, insight_text AS glean_text,
  CAST({alert_type} AS INTEGER) AS glean_type, CAST({location} AS INTEGER) AS glean_location,
  {invoice} AS invoice_id, canonical_vendor_id
FROM {source}"""


_ACCRUAL_KEY = " || chr(31) || strftime(issued, '%Y-%m-%d %H:%M:%S.%f')"

NAMED = """
SELECT glean_id, glean_date, glean_text,
  CASE glean_type WHEN 1 THEN 'vendor_not_seen_in_a_while' WHEN 2 THEN 'accrual_alert'
    WHEN 3 THEN 'large_month_increase_mtd' ELSE 'no_invoice_received' END AS glean_type,
  CASE glean_location WHEN 1 THEN 'invoice' ELSE 'vendor' END AS glean_location,
  invoice_id, canonical_vendor_id
FROM alerts"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def _all(mapping: str, rules: str = "code") -> str:
    if rules == "code":
        history, banded, misses = HISTORY, BANDED, MISSES
    else:
        history, banded, misses = HISTORY_12_BEFORE, BANDED_DOCUMENTED, DOCUMENTED_MISSES
    union = "\nUNION ALL\n".join(
        [
            _alerts("dormant", 1, 1),
            _alerts("accrual", 2, 1, _ACCRUAL_KEY),
            _alerts("large", 3, 2),
            _alerts("missing", 4, 2),
        ]
    )
    return _with(
        mapping,
        LINES,
        LATEST,
        LAGGED,
        _dormant(rules),
        _accrual(rules),
        AMOUNTS,
        MONTHLY,
        history,
        banded,
        _spend(rules),
        misses,
        _missing(rules),
        f"\nalerts AS (\n{union})",
        select=NAMED if rules == "documented" else "SELECT * FROM alerts",
    )


_INSIGHT = "canonical_vendor_id, invoice_id, insight_date, insight_text"
_VENDOR_INSIGHT = "canonical_vendor_id, insight_date, insight_text"
_DAYS = "CAST(issued AS DATE) AS issued"

_MONTH = "date_trunc('month', issued)"
_NEXT_MONTH = "CAST(date_trunc('month', issued) + INTERVAL 1 MONTH AS DATE)"

ORACLE: dict[str, str] = {
    "sig_all": _all(M1),
    "sig_all_documented": _all(M1, "documented"),
    "sig_from_config": _all(M2),
    "sig_all_incremental": _all(M1),
    "sig_all_shared": _all(M1),
    "filter_has_previous_untidy": _with(
        M4,
        LATEST,
        LAGGED,
        select="""
SELECT vendor, invoice, strftime(issued, '%Y-%m-%d %H:%M:%S') AS issued,
       strftime(previous, '%Y-%m-%d %H:%M:%S') AS previous
FROM lagged WHERE previous IS NOT NULL""",
    ),
    "load_typed_csv_rejects": """
WITH texts AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS invoice_id, o_custkey,
         CASE WHEN o_orderkey % 17 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS invoice_date,
         strftime(o_orderdate, '%Y-%m-%d') AS day,
         CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS total_amount,
         printf('%d.%02d', o_orderkey % 977, o_orderkey % 100) AS price
  FROM orders),
lines AS (
  SELECT *, invoice_id || ',' || o_custkey || ',' || invoice_date || ',' || day || ',' || total_amount || ',' || price AS row
  FROM texts)
SELECT row, 'total_amount' AS "column", total_amount AS value, 'not a decimal(24,6)' AS reason
FROM lines WHERE total_amount = 'n/a'
UNION ALL
SELECT row, 'invoice_date', invoice_date, 'not a timestamp' FROM lines WHERE invoice_date = 'soon'""",
    "load_inferred_csv": """
WITH texts AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS invoice_id, CAST(o_custkey AS VARCHAR) AS customer,
         CASE WHEN o_orderkey % 17 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS invoice_date,
         strftime(o_orderdate, '%Y-%m-%d') AS day,
         CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS total_amount,
         printf('%d.%02d', o_orderkey % 977, o_orderkey % 100) AS price
  FROM orders),
cells AS (UNPIVOT texts ON COLUMNS(*) INTO NAME "column" VALUE v)
SELECT "column",
       CASE WHEN bool_and(regexp_matches(v, '^(0|[1-9][0-9]*)$')) THEN 'integer'
            WHEN bool_and(regexp_matches(v, '^(0|[1-9][0-9]*)([.][0-9]+)?$')) THEN 'float'
            WHEN bool_and(TRY_CAST(v AS TIMESTAMP) IS NOT NULL) THEN 'datetime' ELSE 'string' END AS kind,
       count(*) AS filled
FROM cells GROUP BY ALL""",
    "sig_untidy_incremental": _with(
        M4,
        LATEST,
        LAGGED,
        _dormant(),
        AMOUNTS,
        MONTHLY,
        HISTORY_MILLIONTHS,
        LARGE_MILLIONTHS,
        MISSES,
        _missing(),
        select="\nUNION ALL\n".join(
            [_alerts("dormant", 1, 1), _alerts("large", 3, 2), _alerts("missing", 4, 2)]
        ),
    ),
    "sig_dormant_vendor": _with(
        M1, LATEST, LAGGED, _dormant(), select=f"SELECT {_INSIGHT} FROM dormant"
    ),
    "sig_dormant_vendor_dense": _with(
        M2, LATEST, LAGGED, _dormant(), select=f"SELECT {_INSIGHT} FROM dormant"
    ),
    "sig_accrual": _with(M1, LINES, _accrual(), select=f"SELECT {_INSIGHT} FROM accrual"),
    "sig_accrual_documented": _with(
        M1, LINES, _accrual("documented"), select=f"SELECT {_INSIGHT} FROM accrual"
    ),
    "sig_large_month": _with(
        M3, AMOUNTS, MONTHLY, HISTORY, BANDED, _spend(), select="SELECT * FROM large"
    ),
    "sig_large_month_documented": _with(
        M3,
        AMOUNTS,
        MONTHLY,
        HISTORY_12_BEFORE,
        BANDED_DOCUMENTED,
        _spend("documented"),
        select="SELECT * FROM large",
    ),
    "sig_no_invoice": _with(
        M1, MISSES, _missing(), select=f"SELECT {_VENDOR_INSIGHT} FROM missing"
    ),
    "sig_no_invoice_dense": _with(
        M2, MISSES, _missing(), select=f"SELECT {_VENDOR_INSIGHT} FROM missing"
    ),
    "sig_no_invoice_documented": _with(
        M2,
        DOCUMENTED_MISSES,
        _missing("documented"),
        select=f"SELECT {_VENDOR_INSIGHT} FROM missing",
    ),
    "sig_no_invoice_sparse_documented": _with(
        M1,
        DOCUMENTED_MISSES,
        _missing("documented"),
        select=f"SELECT {_VENDOR_INSIGHT} FROM missing",
    ),
    "sig_cadence_weekly": _with(M2, WEEKLY, select=_SPAN),
    "sig_cadence_half_year": _with(M1, HALF_YEARLY, select=_SPAN),
    "sig_cadence_fiscal_quarter": _with(M2, FISCAL, select=_SPAN),
    "sig_no_invoice_weekly": _with(
        M2,
        WEEKLY,
        select="""
SELECT vendor AS canonical_vendor_id, day AS insight_date,
       '`' || vendor || '` generally charges between on ' || usual || ' day of each week invoices are sent. On '
         || strftime(day, '%Y-%m-%d') || ', an invoice from `' || vendor || '` has not been received.' AS insight_text
FROM (SELECT vendor, usual,
             CAST(unnest(generate_series(start_day, end_day - 1, INTERVAL 1 DAY)) AS DATE) AS day FROM late)""",
    ),
    "sig_cadence_monthly": _with(
        M2,
        MISSES,
        select='SELECT vendor, cadence, start_day AS "start", end_day AS "end" FROM month_hits',
    ),
    "sig_cadence_quarterly": _with(
        M1,
        MISSES,
        select='SELECT vendor, cadence, start_day AS "start", end_day AS "end" FROM quarter_hits',
    ),
    "sig_daily_expand": _with(
        M2,
        MISSES,
        select="""
SELECT vendor, cadence, CAST(day(start_day) AS INTEGER) AS usual_day, start_day AS "start",
       end_day AS "end",
       CAST(unnest(generate_series(start_day, end_day - 1, INTERVAL 1 DAY)) AS DATE) AS date
FROM month_hits""",
    ),
    "sig_normalize": _with(M1, LATEST, LAGGED, _dormant(), select=_alerts("dormant", 1, 1)),
    "sig_normalize_documented": _with(
        M1,
        LATEST,
        LAGGED,
        _dormant("documented"),
        f"\nalerts AS ({_alerts('dormant', 1, 1)})",
        select=NAMED,
    ),
    "load_typed_csv": _with(
        M1,
        select="""
SELECT invoice AS invoice_id, vendor AS canonical_vendor_id,
       CAST(amount AS DOUBLE) AS total_amount, CAST(issued AS DATE) AS invoice_date
FROM inv""",
    ),
    "sink_csv_roundtrip": _with(M1, LATEST, LAGGED, _dormant(), select=_alerts("dormant", 1, 1)),
    "cal_bounds": _with(
        M1,
        select="""
SELECT CAST(date_trunc('month', min(issued)) AS DATE) AS first_cadence,
       CAST(date_trunc('month', max(issued)) AS DATE) AS last_cadence
FROM inv""",
    ),
    "cal_months": _with(M1, _calendar("month"), select="SELECT cadence FROM cal_month"),
    "cal_quarters": _with(M1, _calendar("quarter"), select="SELECT cadence FROM cal_quarter"),
    "join_left_invoice_lines": _with(
        M1,
        LINES,
        select="""
SELECT i.invoice, i.vendor, CAST(i.issued AS DATE) AS issued, l.line_item,
       CAST(l.period_end AS DATE) AS period_end
FROM inv i LEFT JOIN lines l ON i.invoice = l.invoice""",
    ),
    "join_cross_calendar": _with(M1, _calendar("month"), select="SELECT * FROM grid_month"),
    "join_left_grid": _with(
        M1,
        _calendar("month"),
        select="""
SELECT g.vendor, g.cadence, i.invoice, CAST(i.issued AS DATE) AS day
FROM grid_month g LEFT JOIN inv i
  ON i.vendor = g.vendor AND CAST(date_trunc('month', i.issued) AS DATE) = g.cadence""",
    ),
    "join_anti_quarter": _with(M2, MISSES, select="SELECT vendor, cadence FROM quarter_hits"),
    "agg_invoice_latest_date": _with(
        M3, LATEST, select=f"SELECT vendor, invoice, {_DAYS} FROM latest"
    ),
    "agg_invoice_period_end": _with(
        M1,
        LINES,
        select="""
SELECT i.vendor, i.invoice, CAST(i.issued AS DATE) AS issued,
       CAST(max(l.period_end) AS DATE) AS period_end
FROM inv i LEFT JOIN lines l ON i.invoice = l.invoice
GROUP BY i.vendor, i.invoice, i.issued""",
    ),
    "agg_invoice_amount": _with(
        M3,
        AMOUNTS,
        select=f"SELECT vendor, invoice, {_DAYS}, CAST(amount AS DOUBLE) AS amount FROM amounts",
    ),
    "agg_monthly_spend": _with(
        M3,
        AMOUNTS,
        MONTHLY,
        select="SELECT vendor, month, CAST(spend AS DOUBLE) AS spend FROM monthly",
    ),
    "agg_cadence_first_and_n": _with(
        M2, _calendar("quarter"), _cells("quarter"), select="SELECT * FROM cells_quarter"
    ),
    "distinct_vendors": _with(M1, select="SELECT DISTINCT vendor FROM inv"),
    "win_lag_invoice_date": _with(
        M1,
        LATEST,
        LAGGED,
        select=f"SELECT vendor, invoice, {_DAYS}, CAST(previous AS DATE) AS previous FROM lagged",
    ),
    "filter_has_previous": _with(
        M2,
        LATEST,
        LAGGED,
        select=f"""
SELECT vendor, invoice, {_DAYS}, CAST(previous AS DATE) AS previous
FROM lagged WHERE previous IS NOT NULL""",
    ),
    "win_range_avg_spend": _with(
        M3,
        AMOUNTS,
        MONTHLY,
        HISTORY,
        select=f"""
SELECT vendor, month, CAST(spend AS DOUBLE) AS spend, n AS months,
       CAST({_AVERAGE} AS DOUBLE) / 100 AS average_spend
FROM history""",
    ),
    "win_rows_min_first": _with(
        M2,
        _calendar("month"),
        _cells("month"),
        _cell_history("month", 3),
        select="SELECT vendor, cadence, earliest_day FROM history_month",
    ),
    "win_rows_collect_set": _with(
        M2,
        _calendar("month"),
        _cells("month"),
        _cell_history("month", 3),
        select="""
SELECT vendor, cadence,
       COALESCE(array_to_string(CAST(first_days AS VARCHAR[]), ','), '') AS first_days
FROM history_month""",
    ),
    "win_multi_lag": _with(
        M2,
        _calendar("month"),
        _cells("month"),
        _cell_history("month", 3),
        select="""
SELECT vendor, cadence, n_invoices, back_1, back_2, back_3
FROM history_month""",
    ),
    "spend_pct_change": _with(
        M3,
        AMOUNTS,
        MONTHLY,
        HISTORY,
        select=f"""
SELECT vendor, month,
       CASE WHEN s > 0 AND e > 0
            THEN sign(e * n - s) * CAST((20000 * abs(e * n - s) + s) // (2 * s) AS DOUBLE) / 100
            ELSE 0.0 END
         AS percent_above
FROM history""",
    ),
    "sig_dormant_vendor_untidy": _with(
        M4, LATEST, LAGGED, _dormant(), select=f"SELECT {_INSIGHT} FROM dormant"
    ),
    "sig_large_month_untidy": _with(
        M4, AMOUNTS, MONTHLY, HISTORY_MILLIONTHS, LARGE_MILLIONTHS, select="SELECT * FROM large"
    ),
    "sig_no_invoice_untidy": _with(
        M4, MISSES, _missing(), select=f"SELECT {_VENDOR_INSIGHT} FROM missing"
    ),
    "sig_no_invoice_untidy_documented": _with(
        M4,
        DOCUMENTED_MISSES,
        _missing("documented"),
        select=f"SELECT {_VENDOR_INSIGHT} FROM missing",
    ),
    "win_lag_invoice_date_untidy": _with(
        M4,
        LATEST,
        LAGGED,
        select="""
SELECT vendor, invoice, strftime(issued, '%Y-%m-%d %H:%M:%S') AS issued,
       strftime(previous, '%Y-%m-%d %H:%M:%S') AS previous
FROM lagged""",
    ),
    "win_range_avg_spend_untidy": _with(
        M4,
        AMOUNTS,
        MONTHLY,
        HISTORY_MILLIONTHS,
        select="""
SELECT vendor, month, sign(e) * CAST((2 * abs(e) + 10000) // 20000 AS DOUBLE) / 100 AS spend,
       n AS months,
       sign(s) * CAST((2 * abs(s) + 10000 * n) // (20000 * n) AS DOUBLE) / 100 AS average_spend
FROM history""",
    ),
    "spend_pct_change_untidy": _with(
        M4,
        AMOUNTS,
        MONTHLY,
        HISTORY_MILLIONTHS,
        select="""
SELECT vendor, month,
       CASE WHEN s > 0 AND e > 0
            THEN sign(e * n - s) * CAST((20000 * abs(e * n - s) + s) // (2 * s) AS DOUBLE) / 100
            ELSE 0.0 END
         AS percent_above
FROM history""",
    ),
    "spend_bands": _with(
        M3,
        AMOUNTS,
        MONTHLY,
        HISTORY,
        BANDED,
        select="""
SELECT CAST(band AS INTEGER) AS band, count(*) AS n FROM banded
WHERE band IS NOT NULL GROUP BY band""",
    ),
    "union_spend_bands": _with(
        M3,
        AMOUNTS,
        MONTHLY,
        HISTORY,
        BANDED,
        select="""
SELECT vendor, month, CAST(spend AS DOUBLE) AS spend, CAST(band AS INTEGER) AS band
FROM banded WHERE band IS NOT NULL""",
    ),
    "union_missing_columns": _with(
        M1,
        LATEST,
        LAGGED,
        _dormant(),
        AMOUNTS,
        MONTHLY,
        HISTORY,
        BANDED,
        _spend(),
        MISSES,
        _missing(),
        select=f"""
SELECT {_INSIGHT} FROM dormant
UNION ALL
SELECT canonical_vendor_id, CAST(NULL AS VARCHAR) AS invoice_id, insight_date, insight_text
FROM large
UNION ALL
SELECT canonical_vendor_id, CAST(NULL AS VARCHAR) AS invoice_id, insight_date, insight_text
FROM missing""",
    ),
    "fn_dates": _with(
        M1,
        select=f"""
SELECT invoice AS invoice_id, CAST(issued AS DATE) AS as_date, CAST(issued AS DATE) AS as_utc,
       CAST({_MONTH} AS DATE) AS month_start,
       CAST(date_trunc('quarter', issued) AS DATE) AS quarter_start,
       CAST(year(issued) AS INTEGER) AS y, CAST(month(issued) AS INTEGER) AS m,
       CAST(day(issued) AS INTEGER) AS d,
       date_diff('day', issued, period_end) AS gap_days,
       {_months("period_end", "issued")} AS gap_months,
       CAST(issued AS DATE) + 90 AS plus_90,
       strftime(issued, '%Y-%m-%d') AS day_text,
       CAST(epoch({_MONTH}) AS BIGINT) AS month_seconds,
       CASE WHEN day(issued) <= day(last_day({_NEXT_MONTH}))
            THEN {_NEXT_MONTH} + CAST(day(issued) - 1 AS INTEGER)
            END AS same_day_next_month,
       least({_NEXT_MONTH} + CAST(day(issued) - 1 AS INTEGER), last_day({_NEXT_MONTH}))
         AS same_day_clamped,
       {_NEXT_MONTH} + 27 AS parsed_day
FROM inv""",
    ),
    "fn_text": _with(
        M1,
        select="""
SELECT invoice AS invoice_id,
       'First new bill in 4 months from vendor `' || vendor || '`' AS dormant,
       'Line items from vendor `' || vendor || '` in this invoice cover future periods ('
         || strftime(period_end, '%Y-%m-%d') || ')' AS accrual,
       'Monthly spend with `' || vendor || '` is $' || amount || ' (' || amount
         || '%) higher than average.' AS spend,
       '`' || vendor || '` generally charges between on ' || day(issued)
         || ' day of each month invoices are sent. On ' || strftime(issued, '%Y-%m-%d')
         || ', an invoice from `' || vendor || '` has not been received.' AS missing,
       CASE WHEN vendor = '7' THEN 1 ELSE 0 END AS null_text
FROM inv""",
    ),
}
