"""The registered queries once more, as SQL for another engine."""

from __future__ import annotations

from proofline.contract import CaseCheck, Table, UnicodeCheck
from proofline.operators.checks import CLASSES, COMPARED, RESPONSES
from proofline.plans import payments as pay
from proofline.plans import queries as q

D38 = "DECIMAL(38,4)"
FOLDED = "lower(txn_status) = 'captured'"
TOTALS = (
    f"COUNT(*) AS txn_count, CAST(SUM(amount) AS {D38}) AS gross_amount, "
    f"CAST(SUM(COALESCE(fee_amount, 0)) AS {D38}) AS total_fees, "
    f"CAST(SUM(amount - COALESCE(fee_amount, 0)) AS {D38}) AS net_amount"
)


def ts(moment) -> str:
    return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"


BATCHES = f"""
  SELECT merchant_id, CAST(captured_at AS DATE) AS batch_date, COUNT(*) AS txn_count,
         CAST(SUM(amount) AS {D38}) AS gross_amount,
         CASE WHEN COUNT(settled_at) = COUNT(*) THEN 'Settled' ELSE 'Pending' END AS batch_status
  FROM transactions WHERE {FOLDED} GROUP BY merchant_id, CAST(captured_at AS DATE)"""

SETTLEMENTS = """
  SELECT merchant_id, batch_date,
         CAST(CAST(gross_amount AS DECIMAL(19,4)) * CAST(0.9705 AS DECIMAL(4,4)) AS DECIMAL(19,4)) AS net_amount,
         CAST(CAST(gross_amount AS DECIMAL(19,4)) * CAST(0.0295 AS DECIMAL(4,4)) AS DECIMAL(19,4)) AS fee_amount,
         CAST(batch_date + INTERVAL '2' DAY AS TIMESTAMP) AS settled_at
  FROM batches WHERE batch_status = 'Settled'"""

# Presence before each change, from the latest earlier insert or delete of the key.
JUDGED = """
  SELECT c.*, COALESCE(
           last_value(CASE op WHEN 'I' THEN TRUE WHEN 'D' THEN FALSE END IGNORE NULLS)
             OVER (PARTITION BY c.k ORDER BY c.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           a.k IS NOT NULL) AS present
  FROM changes c LEFT JOIN accounts a ON a.k = c.k"""

VERDICTS = """
  SELECT *, CASE WHEN op = 'I' AND present THEN 'insert of an existing key'
                 WHEN op = 'U' AND NOT present THEN 'update of a missing key'
                 WHEN op = 'D' AND NOT present THEN 'ignored' ELSE 'applied' END AS verdict
  FROM judged"""


def state_sql(condition: str) -> str:
    return f"""
  , net AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS n
                           FROM verdicts WHERE verdict = 'applied' AND {condition}) WHERE n = 1)
  SELECT k, amount, seq FROM accounts WHERE k NOT IN (SELECT k FROM net)
  UNION ALL SELECT k, amount, seq FROM net WHERE op <> 'D'"""


WITH = f"""WITH merchants AS ({pay.select_sql(pay.MERCHANT_COLUMNS, 'customer')}),
 transactions AS ({pay.select_sql(pay.TRANSACTION_COLUMNS, 'orders')}),
 migrated AS ({pay.select_sql(pay.MIGRATED_COLUMNS, 'orders', pay.PLANTED_FILTER)}),
 changes AS ({pay.select_sql(pay.CHANGE_COLUMNS, 'events')}),
 accounts AS ({pay.select_sql(pay.ACCOUNT_COLUMNS, 'customer')}),
 raw_merchants AS ({pay.select_sql(pay.RAW_MERCHANT_COLUMNS, 'merchants')}),
 raw_transactions AS ({pay.select_sql(pay.RAW_TRANSACTION_COLUMNS, 'transactions')}),
 batches AS ({BATCHES}),
 settlements AS ({SETTLEMENTS}),
 numbered AS (SELECT row_number() OVER (ORDER BY merchant_id, batch_date) AS batch_id, * FROM batches),
 numbered_gone AS (SELECT * FROM numbered WHERE {pay.BATCH_FILTER}),
 paid AS (SELECT row_number() OVER (ORDER BY batch_id) AS settlement_id, batch_id, s.net_amount, s.fee_amount,
          CAST(s.net_amount + s.fee_amount AS DECIMAL(19,4)) AS gross_amount, s.settled_at
          FROM settlements s JOIN numbered USING (merchant_id, batch_date)),
 misread AS (SELECT * REPLACE ({pay.MISREAD_NAME} AS legal_name) FROM merchants),
 judged AS ({JUDGED}),
 verdicts AS ({VERDICTS})
"""


# -- fingerprints ------------------------------------------------------------


def print_sql(table: Table, cte: str, case: CaseCheck | None = None, uni: UnicodeCheck | None = None) -> str:
    """The fingerprint of one table, one SELECT per measure."""

    def line(check: str, subject: str, key: str, value: str, tail: str = "") -> str:
        return (
            f"SELECT '{table.name}' AS table_name, '{check}' AS check_name, '{subject}' AS subject, "
            f"{key} AS key, CAST({value} AS VARCHAR) AS value FROM {cte} {tail}"
        )

    parts = [line("row_count", "*", "''", "COUNT(*)")]
    parts += [line("money_sum", c, "''", f"CAST(SUM({c}) AS {D38})") for c in table.money]
    for c in table.dated:
        parts += [line("date_range", c, f"'{b}'", f"{b}({c})") for b in ("min", "max")]
    parts += [line("null_count", c, "''", f"COUNT(*) - COUNT({c})") for c in table.nullable]
    parts.append(line("max_key", table.key, "''", f"MAX({table.key})"))
    for link in table.parents:
        fk = link.column
        key, tail = f"CAST({fk} AS VARCHAR)", f"GROUP BY {fk}"
        parts.append(line("parent_profile", f"{fk}: rows", key, "COUNT(*)", tail))
        parts += [line("parent_profile", f"{fk}: {c}", key, f"CAST(SUM({c}) AS {D38})", tail) for c in table.names("money")]
    if case:
        c, v = case.column, case.value
        parts.append(line("match_count", c, "'exact'", f"COUNT(*) FILTER (WHERE {c} = '{v}')"))
        parts.append(line("match_count", c, "'folded'", f"COUNT(*) FILTER (WHERE lower({c}) = lower('{v}'))"))
        parts.append(line("status_count", c, c, "COUNT(*)", f"GROUP BY {c}"))
    if uni:
        c = uni.column
        like = " OR ".join(f"{c} LIKE '{p}'" for p in uni.patterns)
        parts.append(line("unicode_sample", c, c, "COUNT(*)", f"WHERE {like} GROUP BY {c}"))
    return "\n UNION ALL ".join(parts)


CASE, UNI = pay.PAYMENTS.case_check, pay.PAYMENTS.unicode_check
PRINT_M = print_sql(pay.MERCHANTS, "merchants", uni=UNI)
PRINT_T = print_sql(pay.TRANSACTIONS, "transactions", CASE)
PRINT_G = print_sql(pay.TRANSACTIONS, "migrated", CASE)
PRINT_B = print_sql(pay.BATCHES, "numbered")
PRINT_P = print_sql(pay.SETTLEMENTS, "paid")
PRINT_ALL = f"{PRINT_M} UNION ALL {PRINT_T} UNION ALL {PRINT_B} UNION ALL {PRINT_P}"
PRINT_R = print_sql(pay.MERCHANTS, "misread", uni=UNI)
PRINT_L = print_sql(pay.BATCHES, "numbered_gone")
BOTH = f"""
 , s AS ({PRINT_T}), t AS ({PRINT_G}), compared AS (
  SELECT table_name, check_name, subject, key, s.value AS source_value, t.value AS target_value,
         s.value IS NOT DISTINCT FROM t.value AS same
  FROM s FULL JOIN t USING (table_name, check_name, subject, key))
"""
COMPARED_SQL = ", ".join(f"'{c}'" for c in COMPARED)
CLASS_SQL = "CASE check_name " + " ".join(f"WHEN '{c}' THEN {n}" for c, n in CLASSES.items()) + " END"
RESPONSE_SQL = f"CASE {CLASS_SQL} " + " ".join(f"WHEN {n} THEN '{r}'" for n, r in RESPONSES.items()) + " END"

ORPHANS_B = "SELECT COUNT(*) FROM numbered_gone b LEFT JOIN merchants m ON m.merchant_id = b.merchant_id WHERE m.merchant_id IS NULL"
ORPHANS_S = "SELECT COUNT(*) FROM paid s LEFT JOIN numbered_gone b ON b.batch_id = s.batch_id WHERE b.batch_id IS NULL"
MISREAD = """SELECT CAST(m.merchant_id AS VARCHAR) AS k, m.legal_name AS a, r.legal_name AS b
  FROM merchants m JOIN misread r ON r.merchant_id = m.merchant_id AND r.legal_name <> m.legal_name"""
ORPHANS_T = "SELECT COUNT(*) FROM migrated t LEFT JOIN merchants m ON m.merchant_id = t.merchant_id WHERE m.merchant_id IS NULL"
CHECKS = f"""
 , s AS ({PRINT_T} UNION ALL {PRINT_R} UNION ALL {PRINT_B} UNION ALL {PRINT_P}),
 t AS ({PRINT_G} UNION ALL {PRINT_R} UNION ALL {PRINT_L} UNION ALL {PRINT_P}), compared AS (
  SELECT table_name, check_name, subject, key, s.value AS source_value, t.value AS target_value,
         s.value IS NOT DISTINCT FROM t.value AS passed
  FROM s FULL JOIN t USING (table_name, check_name, subject, key)),
 found AS (
  SELECT table_name, check_name, subject, key, source_value, target_value, passed FROM compared WHERE check_name IN ({COMPARED_SQL})
  UNION ALL SELECT 'transactions', 'orphans', 'transactions.merchant_id without merchants', '', NULL, CAST(n AS VARCHAR), n = 0 FROM ({ORPHANS_T}) x(n)
  UNION ALL SELECT 'batches', 'orphans', 'batches.merchant_id without merchants', '', NULL, CAST(n AS VARCHAR), n = 0 FROM ({ORPHANS_B}) x(n)
  UNION ALL SELECT 'settlements', 'orphans', 'settlements.batch_id without batches', '', NULL, CAST(n AS VARCHAR), n = 0 FROM ({ORPHANS_S}) x(n)
  UNION ALL SELECT 'settlements', 'generated', 'gross_amount', k, NULL, '0', TRUE FROM (VALUES ('null'), ('wrong')) x(k)
  UNION ALL SELECT 'merchants', 'anchor', 'legal_name', k, a, b, FALSE FROM ({MISREAD})
  UNION ALL SELECT 'merchants', 'anchor', 'legal_name: rows that differ', '', '0', CAST(COUNT(*) AS VARCHAR), TRUE FROM ({MISREAD}) HAVING COUNT(*) = 0
  UNION ALL SELECT 'transactions', 'next_key', 'txn_id', '', '{q.NEXT_KEY}', CAST(MAX(txn_id) AS VARCHAR), MAX(txn_id) < {q.NEXT_KEY} FROM migrated
  UNION ALL SELECT 'transactions', 'match_count', 'txn_status', key, source_value, target_value, passed FROM compared WHERE check_name = 'match_count'
  UNION ALL SELECT 'transactions', 'match_count', 'txn_status', 'lost', CAST(f AS VARCHAR), CAST(f - e AS VARCHAR), f > e FROM (
     SELECT (SELECT COUNT(*) FROM transactions WHERE {FOLDED}) AS f, (SELECT COUNT(*) FROM migrated WHERE txn_status = 'Captured') AS e)
  UNION ALL SELECT 'transactions', 'case_variant', 'txn_status', v, NULL, CAST(n AS VARCHAR), n > 0 FROM (
     SELECT v, (SELECT COUNT(*) FROM migrated WHERE txn_status = v) AS n FROM (VALUES ('Captured'), ('captured'), ('CAPTURED')) x(v))
  UNION ALL SELECT 'merchants', 'unicode_sample', 'legal_name: present', '', CAST(COUNT(*) AS VARCHAR), NULL, COUNT(*) > 0 FROM misread
     WHERE legal_name LIKE '%北方%' OR legal_name LIKE '%Трейд%' OR legal_name LIKE '%Móvil%'),
 classed AS (SELECT check_name, CAST({CLASS_SQL} AS INT) AS failure_class, table_name, subject, key, source_value, target_value, passed,
                    {RESPONSE_SQL} AS response FROM found)
"""


def measured(check: str, value: str) -> str:
    return WITH + f"SELECT table_name, subject, {value} FROM ({PRINT_ALL}) WHERE check_name = '{check}'"


# -- rows --------------------------------------------------------------------

COMPARED_COLUMNS = [n for n in pay.TRANSACTIONS.names() if n != "txn_id"]
CHANGED = " || ".join(f"CASE WHEN s.{n} IS DISTINCT FROM t.{n} THEN ',{n}' ELSE '' END" for n in COMPARED_COLUMNS)
ROW_DIFF = WITH + f"""
 SELECT 'transactions' AS table_name, CAST(COALESCE(s.txn_id, t.txn_id) AS VARCHAR) AS row_key,
        CASE WHEN t.txn_id IS NULL THEN 'missing_in_target' WHEN s.txn_id IS NULL THEN 'extra_in_target' ELSE 'changed' END AS status,
        CASE WHEN s.txn_id IS NOT NULL AND t.txn_id IS NOT NULL THEN substr({CHANGED}, 2) END AS columns,
        CASE WHEN s.txn_id IS NULL THEN 0 ELSE 1 END::BIGINT AS only_source,
        CASE WHEN t.txn_id IS NULL THEN 0 ELSE 1 END::BIGINT AS only_target
 FROM transactions s FULL JOIN migrated t ON s.txn_id = t.txn_id
 WHERE s.txn_id IS NULL OR t.txn_id IS NULL OR ({CHANGED}) <> ''"""

BAD_AMOUNT = {1: "more than 4 decimals", 2: "not a number", 3: "out of range"}
REJECT_RULES = [
    ("merchants", "merchant_id", "merchant_guid", "merchant_id % 61 = 5", "not a uuid"),
    ("merchants", "merchant_id", "legal_name", "merchant_id % 67 = 9", "missing"),
    ("merchants", "merchant_id", "is_active", "merchant_id % 59 = 4", "neither 0 nor 1"),
    ("merchants", "merchant_id", "created_at", "merchant_id % 71 = 8", "not a timestamp"),
    ("transactions", "txn_id", "merchant_id", "txn_id % 103 = 6", "not a whole number"),
    *[("transactions", "txn_id", "amount", f"txn_id % 97 = {r}", why) for r, why in BAD_AMOUNT.items()],
]


def bad(table: str) -> str:
    return " OR ".join(rule for t, _, _, rule, _ in REJECT_RULES if t == table)


REJECTS = WITH + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(b.{k} AS VARCHAR) AS row_key, '{c}' AS \"column\", '{why}' AS reason, r.{c} AS value "
    f"FROM {t} b JOIN raw_{t} r ON r.{k} = CAST(b.{k} AS VARCHAR) WHERE {rule.replace(k + ' ', 'b.' + k + ' ')}"
    for t, k, c, rule, why in REJECT_RULES
)
GOOD_M = f"SELECT * FROM merchants WHERE NOT ({bad('merchants')})"
GOOD_T = f"""SELECT * REPLACE (captured_at - CASE WHEN txn_id % 4 = 1 THEN INTERVAL '2' HOUR ELSE INTERVAL '0' HOUR END AS captured_at)
 FROM transactions WHERE NOT ({bad('transactions')})"""

EXPORTED = "txn_id, merchant_id, amount, fee_amount, rtrim(currency) AS currency, txn_status, captured_at, settled_at, CAST(captured_at AS DATE) AS capture_date"
LATEST = f"SELECT DISTINCT CAST(captured_at AS DATE) AS capture_date FROM transactions ORDER BY 1 DESC LIMIT {q.EXPORT_DAYS}"

DAILY = """SELECT m.merchant_id, m.legal_name, CAST(t.captured_at AS DATE) AS capture_date, {totals}
 FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id
 WHERE {window} AND {match}
 GROUP BY m.merchant_id, m.legal_name, CAST(t.captured_at AS DATE)"""


def daily(match: str, days: int | None = q.REPORT_DAYS) -> str:
    window = "t.captured_at IS NOT NULL" if days is None else f"t.captured_at >= {ts(q.AS_OF)} - INTERVAL '{days}' DAY"
    return WITH + DAILY.format(totals=TOTALS, window=window, match=match)


def summary(match: str, days: int) -> str:
    start = q.P.calendar_start(q.SUMMARY_AS_OF, days)
    return f"""SELECT CAST(captured_at AS DATE) AS summary_date, merchant_id, {TOTALS} FROM transactions
 WHERE captured_at >= {ts(start)} AND {match} GROUP BY CAST(captured_at AS DATE), merchant_id"""


RANGE_SQL = WITH + f"""SELECT merchant_id, COUNT(*) AS txn_count, CAST(SUM(amount) AS {D38}) AS gross FROM transactions
 WHERE captured_at >= {ts(q.RANGE[0])} AND captured_at < {ts(q.RANGE[1])} AND {FOLDED} GROUP BY merchant_id"""

STATE = WITH + state_sql("TRUE")
CONFLICTS = WITH + "SELECT k, seq, op, verdict AS error FROM verdicts WHERE verdict IN ('insert of an existing key', 'update of a missing key')"
COUNTED = WITH + """SELECT COUNT(*) FILTER (WHERE verdict = 'applied' AND op = 'I') AS inserts, COUNT(*) FILTER (WHERE verdict = 'applied' AND op = 'U') AS updates,
 COUNT(*) FILTER (WHERE verdict = 'applied' AND op = 'D') AS deletes, COUNT(*) FILTER (WHERE verdict NOT IN ('applied', 'ignored')) AS errors,
 COUNT(*) FILTER (WHERE verdict = 'ignored') AS ignored FROM verdicts"""
SLOT = "time_bucket(INTERVAL '5 minutes', commit_ts)"
LAG = "CAST((3000000 - epoch_us(commit_ts) % 3000000) AS DECIMAL(20,0)) / 1000000"
HISTORY = f"SELECT {SLOT} AS slot_start, {SLOT} + INTERVAL '5' MINUTE AS slot_end, op, COUNT(*) AS changes, MAX(seq) AS last_seq FROM changes GROUP BY 1, 2, 3"
SPELLED = "SELECT txn_status AS spelling, COUNT(*) AS spelling_rows, lower(txn_status) AS folded FROM transactions GROUP BY txn_status"

# United States daylight time of the years before 2007: first Sunday of April to last
# Sunday of October, 2:00 local. A time in the spring gap reads as standard time, one in
# the autumn overlap as daylight time.
APRIL = "make_date(year(captured_at)::INT, 4, 1)"
OCTOBER = "make_date(year(captured_at)::INT, 10, 31)"
DST_FROM = f"({APRIL} + CAST((7 - dayofweek({APRIL})) % 7 AS INT)) + INTERVAL '3' HOUR"
DST_TO = f"({OCTOBER} - CAST(dayofweek({OCTOBER}) AS INT)) + INTERVAL '2' HOUR"

COVERAGE = """SELECT table_name FROM (VALUES ('merchants'), ('transactions'), ('batches'), ('settlements')) x(table_name)
 WHERE table_name NOT IN (SELECT CASE WHEN k % 2 = 0 THEN 'merchants' ELSE 'transactions' END FROM changes)"""


COPIED = [n for n in pay.MERCHANTS.names() if n != "merchant_guid"]
COPY_CHANGED = " || ".join(f"CASE WHEN s.{n} IS DISTINCT FROM t.{n} THEN ',{n}' ELSE '' END" for n in COPIED)
TREE_DIFF = WITH + f"""
 , t AS (SELECT * REPLACE (lower(merchant_guid) AS merchant_guid) FROM ({pay.select_sql(pay.COPIED_MERCHANT_COLUMNS, 'merchants', pay.COPIED_MERCHANT_FILTER)}))
 SELECT 'merchants' AS table_name, COALESCE(s.merchant_guid, t.merchant_guid) AS row_key,
        CASE WHEN t.merchant_guid IS NULL THEN 'missing_in_target' ELSE 'changed' END AS status,
        CASE WHEN t.merchant_guid IS NOT NULL THEN substr({COPY_CHANGED}, 2) END AS columns,
        CAST(1 AS BIGINT) AS only_source, CASE WHEN t.merchant_guid IS NULL THEN 0 ELSE 1 END::BIGINT AS only_target
 FROM merchants s LEFT JOIN t ON s.merchant_guid = t.merchant_guid
 WHERE t.merchant_guid IS NULL OR ({COPY_CHANGED}) <> ''"""


def row_hash_sql(table: Table, cte: str) -> str:
    """The key and the row digest of the sampled rows of one side."""
    texts = [f"CAST({'rtrim(' + c.name + ')' if c.type == 'char' else 'lower(' + c.name + ')' if c.type == 'uuid' else c.name} AS VARCHAR)" for c in table.columns]
    key = f"CAST({table.key} AS VARCHAR)"
    row = " || '|' || ".join(f"COALESCE(CAST(length({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts)
    return f"SELECT {key} AS row_key, sha256({row}) AS h FROM {cte} WHERE CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {q.SAMPLE_EVERY} = 0"


HASH_SAMPLE = WITH + f"""
 , s AS ({row_hash_sql(pay.TRANSACTIONS, 'transactions')}), t AS ({row_hash_sql(pay.TRANSACTIONS, 'migrated')})
 SELECT 'transactions' AS table_name, row_key, s.h AS source_hash, t.h AS target_hash, s.h IS NOT DISTINCT FROM t.h AS same
 FROM s FULL JOIN t USING (row_key)"""

MOMENTS = ", ".join(f"({m})" for m in q.MOMENTS)
AS_OF_MANY = WITH + f"""
 , moments AS (SELECT CAST(col0 AS BIGINT) AS at_seq FROM (VALUES {MOMENTS})),
 known AS (SELECT k, seq, FALSE AS gone, amount FROM accounts UNION ALL
           SELECT k, seq, op = 'D', CASE WHEN op <> 'D' THEN amount END FROM verdicts WHERE verdict = 'applied'),
 held AS (SELECT *, row_number() OVER (PARTITION BY at_seq, k ORDER BY seq DESC) AS n FROM moments JOIN known ON seq <= at_seq)
 SELECT at_seq, k, amount, seq FROM held WHERE n = 1 AND NOT gone"""

FEED = f"""
 , edges AS (SELECT min(commit_ts) AS lo, (epoch_us(max(commit_ts)) - epoch_us(min(commit_ts))) // {q.FEED_PARTS} + 1 AS width FROM changes),
 feed AS (SELECT c.*, (epoch_us(commit_ts) - epoch_us(lo)) // width AS part FROM changes c, edges)"""
CONFIRMED = WITH + FEED + "".join(f"""
 {'UNION ALL' if n else ', final AS (SELECT least(max(commit_ts) FILTER (WHERE op = \'D\'), max(commit_ts) FILTER (WHERE op = \'I\')) AS t FROM changes)'}
 SELECT k, commit_ts AS seen_at, '{state}' AS state FROM changes m, final WHERE op = 'D'
   AND commit_ts + INTERVAL '{seconds}' SECOND + INTERVAL '10' MINUTE < t
   AND NOT EXISTS (SELECT 1 FROM changes e WHERE e.op = 'I' AND e.k = m.k AND e.commit_ts >= m.commit_ts AND e.commit_ts <= m.commit_ts + INTERVAL '{seconds}' SECOND)"""
    for n, (state, seconds) in enumerate((("confirmed", q.pending.REPORT_AFTER), ("suspended", q.pending.SUSPEND_AFTER))))
STATUS = WITH + FEED + """
 SELECT CAST(part AS BIGINT) AS batch_id, COUNT(*) AS changes, COUNT(*) FILTER (WHERE op = 'I') AS inserts, COUNT(*) FILTER (WHERE op = 'U') AS updates,
  COUNT(*) FILTER (WHERE op = 'D') AS deletes, MAX(seq) AS last_seq, MAX(commit_ts) AS last_commit FROM feed GROUP BY part"""

INCREMENTAL = WITH + f"""
 SELECT CAST(captured_at AS DATE) AS summary_date, merchant_id, {TOTALS} FROM migrated WHERE {FOLDED}
 GROUP BY CAST(captured_at AS DATE), merchant_id"""


def sql() -> dict[str, str]:
    upsert_old, upsert_new = summary("txn_status = 'Captured'", 2 * q.SUMMARY_DAYS), summary(FOLDED, q.SUMMARY_DAYS)
    return {
        "row_counts": WITH + " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in ("merchants", "transactions", "batches", "settlements")),
        "money_sums": measured("money_sum", f"CAST(value AS {D38}) AS total"),
        "date_ranges": measured("date_range", "key, CAST(value AS TIMESTAMP) AS bound"),
        "null_counts": measured("null_count", "CAST(value AS BIGINT) AS null_rows"),
        "key_high_water": measured("max_key", "CAST(value AS BIGINT) AS max_key"),
        "next_key_collision": WITH + f"SELECT 'transactions' AS table_name, MAX(txn_id) AS max_key, CAST({q.NEXT_KEY} AS BIGINT) AS next_key, MAX(txn_id) >= {q.NEXT_KEY} AS collides FROM transactions",
        "parent_profile": WITH + f"SELECT * FROM ({PRINT_ALL}) WHERE check_name = 'parent_profile'",
        "status_counts": WITH + "SELECT txn_status, COUNT(*) AS txn_count FROM transactions GROUP BY txn_status",
        "match_loss": WITH + f"""SELECT 'Captured' AS value, f AS folded_rows, e AS exact_rows, f - e AS lost_rows,
 CAST(CAST(f - e AS DECIMAL(20,0)) * 100 / f AS DECIMAL(7,4)) AS lost_percent
 FROM (SELECT COUNT(*) FILTER (WHERE {FOLDED}) AS f, COUNT(*) FILTER (WHERE txn_status = 'Captured') AS e FROM transactions)""",
        "case_merged_groups": WITH + f"""SELECT s.folded, s.spelling, s.spelling_rows, t.spellings, t.folded_rows FROM ({SPELLED}) s
 JOIN (SELECT folded, COUNT(*) AS spellings, CAST(SUM(spelling_rows) AS BIGINT) AS folded_rows FROM ({SPELLED}) GROUP BY folded) t ON s.folded = t.folded""",
        "unicode_sample": "SELECT sha256(text) AS text_sha256, CAST(length(text) AS BIGINT) AS chars, COUNT(*) AS copies FROM documents WHERE "
        + " OR ".join(f"text LIKE '{p}'" for p in q.TEXT_PATTERNS) + " GROUP BY text",
        "fingerprint": WITH + PRINT_ALL,
        "fingerprint_json": WITH + PRINT_ALL,
        "settlement_range": RANGE_SQL,
        "clustered_range": RANGE_SQL,
        "daily_settlement_exact": daily("t.txn_status = 'Captured'"),
        "daily_settlement_folded": daily(FOLDED),
        "daily_settlement_function": daily(FOLDED),
        "reconcile_orphans_function": WITH + f"""SELECT 'transactions without a merchant' AS check_name, ({ORPHANS_T}) AS orphan_count
 UNION ALL SELECT 'batches without a merchant', COUNT(*) FROM batches b WHERE NOT EXISTS (SELECT 1 FROM merchants m WHERE m.merchant_id = b.merchant_id)
 UNION ALL SELECT 'settlements without a batch', COUNT(*) FROM settlements s WHERE NOT EXISTS (SELECT 1 FROM batches b WHERE b.merchant_id = s.merchant_id AND b.batch_date = s.batch_date)""",
        "daily_settlement_whole": daily(FOLDED, None),
        "daily_summary_calendar": WITH + upsert_new,
        "rolling_and_calendar_windows": WITH + f"""SELECT COUNT(*) FILTER (WHERE captured_at >= {ts(q.SUMMARY_AS_OF)} - INTERVAL '{q.SUMMARY_DAYS}' DAY) AS rolling_rows,
 COUNT(*) FILTER (WHERE captured_at >= date_trunc('day', {ts(q.SUMMARY_AS_OF)} - INTERVAL '{q.SUMMARY_DAYS}' DAY)) AS calendar_rows FROM transactions""",
        "summary_upsert": WITH + f", o AS ({upsert_old}), n AS ({upsert_new}) SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.summary_date = o.summary_date AND n.merchant_id = o.merchant_id)",
        "summary_job": WITH + summary(FOLDED, 2 * q.SUMMARY_DAYS),
        "summary_run_log": WITH + f"""SELECT 'daily_settlement_summary' AS job_name, 'failed' AS status, CAST(NULL AS BIGINT) AS rows_written, TRUE AS has_error, TRUE AS finished
 UNION ALL SELECT 'daily_settlement_summary', 'succeeded', COUNT(*), FALSE, TRUE FROM ({upsert_new})""",
        "derive_batches": WITH + "SELECT * FROM batches",
        "derive_settlements": WITH + "SELECT * FROM settlements",
        "generated_gross": WITH + f"""SELECT s.merchant_id, s.batch_date, CAST(net_amount + fee_amount AS {D38}) AS gross_amount,
 CAST(net_amount + fee_amount - b.gross_amount AS {D38}) AS rounding
 FROM settlements s JOIN batches b ON b.merchant_id = s.merchant_id AND b.batch_date = s.batch_date""",
        "generated_check": WITH + """SELECT 'generated' AS check_name, 2 AS failure_class, 'gross_amount' AS subject, key, n AS rows, n = 0 AS passed FROM (
 SELECT 'null' AS key, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'wrong', COUNT(*) FROM settlements WHERE merchant_id % 50 = 3)""",
        "allocate_batch_keys": WITH + "SELECT merchant_id, batch_date, batch_id + (SELECT MAX(merchant_id) FROM merchants) AS batch_id FROM numbered",
        "confirmed_mismatches": CONFIRMED,
        "stream_status": STATUS,
        "row_diff_bucketed": ROW_DIFF,
        "hash_tree_diff": TREE_DIFF,
        "row_hash_sample": HASH_SAMPLE,
        "as_of_many": AS_OF_MANY,
        "summary_incremental": INCREMENTAL,
        "reconcile_orphans": WITH + """SELECT 'transactions.merchant_id without merchants' AS check_name, COUNT(*) AS orphan_count FROM migrated t
   LEFT JOIN (SELECT merchant_id FROM merchants WHERE merchant_id % 100 <> 1) m ON m.merchant_id = t.merchant_id WHERE m.merchant_id IS NULL
 UNION ALL SELECT 'batches.merchant_id without merchants', COUNT(*) FROM (SELECT * FROM batches WHERE merchant_id % 101 <> 3) b
   LEFT JOIN (SELECT merchant_id FROM merchants WHERE merchant_id % 100 <> 1) m ON m.merchant_id = b.merchant_id WHERE m.merchant_id IS NULL
 UNION ALL SELECT 'settlements.batch_id without batches', COUNT(*) FROM settlements s
   LEFT JOIN (SELECT * FROM batches WHERE merchant_id % 101 <> 3) b ON b.merchant_id = s.merchant_id AND b.batch_date = s.batch_date WHERE b.merchant_id IS NULL""",
        "profile_diff": WITH + BOTH + "SELECT table_name, check_name, subject, key, source_value, target_value FROM compared WHERE NOT same",
        "row_diff": ROW_DIFF,
        "row_diff_narrowed": ROW_DIFF,
        "key_set_diff": WITH + """SELECT CAST(COALESCE(s.txn_id, t.txn_id) AS VARCHAR) AS row_key, CASE WHEN t.txn_id IS NULL THEN 'missing_in_target' ELSE 'extra_in_target' END AS status
 FROM transactions s FULL JOIN migrated t ON s.txn_id = t.txn_id WHERE s.txn_id IS NULL OR t.txn_id IS NULL""",
        "partition_counts": WITH + f"SELECT CAST(txn_id // {q.KEY_BLOCK} AS BIGINT) AS key_block, COUNT(*) AS rows FROM transactions GROUP BY 1",
        "differing_partitions": WITH + f""", d AS (SELECT COALESCE(s.txn_id, t.txn_id) // 100 AS b FROM transactions s FULL JOIN migrated t ON s.txn_id = t.txn_id
   WHERE s.txn_id IS NULL OR t.txn_id IS NULL OR ({CHANGED}) <> '')
 SELECT CAST(x.b AS BIGINT) AS key_block, (SELECT COUNT(*) FROM transactions WHERE txn_id // 100 = x.b) AS source_rows,
        (SELECT COUNT(*) FROM migrated WHERE txn_id // 100 = x.b) AS target_rows FROM (SELECT DISTINCT b FROM d) x""",
        "anchor_diff": WITH + """SELECT 'merchants' AS table_name, CAST(merchant_id AS VARCHAR) AS row_key,
 CASE WHEN merchant_id % 211 = 2 THEN 'missing_in_target' ELSE 'changed' END AS status, legal_name AS file_value,
 CASE WHEN merchant_id % 211 <> 2 THEN replace(legal_name, '北方物流', 'σîùµû╣τë⌐µ╡ü') END AS table_value
 FROM merchants WHERE merchant_id % 211 = 2 OR legal_name LIKE '%北方物流%'""",
        "snapshot_compare": WITH + BOTH + """SELECT table_name, check_name, subject, target_value AS restored_value, source_value AS live_value, same
 FROM compared WHERE check_name IN ('row_count', 'money_sum')""",
        "side_by_side": WITH + BOTH + f"""SELECT *, CAST(CAST(target_value AS {D38}) - CAST(source_value AS {D38}) AS {D38}) AS delta
 FROM compared WHERE check_name IN ('row_count', 'money_sum', 'match_count')""",
        "verification_checks": WITH + CHECKS + "SELECT * FROM classed",
        "verification_summary": WITH + CHECKS + """SELECT check_name, failure_class, response, COUNT(*) FILTER (WHERE passed) AS passed_rows,
 COUNT(*) FILTER (WHERE NOT passed) AS failed_rows, COUNT(*) FILTER (WHERE passed IS NULL) AS skipped_rows FROM classed GROUP BY 1, 2, 3""",
        "case_variants_present": WITH + """SELECT v AS key, n AS rows, n > 0 AS passed FROM (
 SELECT v, (SELECT COUNT(*) FROM migrated WHERE txn_status = v) AS n FROM (VALUES ('Captured'), ('captured'), ('CAPTURED')) x(v))""",
        "failure_classes": WITH + BOTH + f"SELECT CAST({CLASS_SQL} AS INT) AS failure_class, {RESPONSE_SQL} AS response, COUNT(*) AS failed_rows FROM compared WHERE NOT same AND check_name IN ({COMPARED_SQL}) GROUP BY 1, 2",
        "equality_modes": WITH + """, p AS (SELECT CASE WHEN txn_id % 2 = 0 THEN txn_status || '  ' ELSE txn_status END AS s FROM transactions)
 SELECT COUNT(*) FILTER (WHERE s = 'Captured') AS exact_rows, COUNT(*) FILTER (WHERE lower(s) = 'captured') AS folded_rows,
  COUNT(*) FILTER (WHERE lower(rtrim(s)) = 'captured') AS collated_rows, COUNT(*) FILTER (WHERE s = 'Captured') AS forced_exact_rows,
  COUNT(*) FILTER (WHERE rtrim(s) = 'Captured') AS trimmed_rows FROM p""",
        "collation_equal": WITH + "SELECT txn_id, txn_status, amount FROM transactions WHERE lower(rtrim(txn_status)) = 'captured'",
        "char_compare": WITH + "SELECT currency, COUNT(*) AS txn_count, COUNT(*) FILTER (WHERE currency = 'USD') AS usd_rows FROM transactions GROUP BY currency",
        "timestamp_attach": WITH + f"SELECT txn_id, captured_at + CASE WHEN captured_at >= {DST_FROM} AND captured_at < {DST_TO} THEN INTERVAL '4' HOUR ELSE INTERVAL '5' HOUR END AS captured_utc FROM transactions",
        "computed_fees": WITH + f"""SELECT CAST(SUM(COALESCE(f, 0)) AS {D38}) AS fees, CAST(SUM(amount - COALESCE(f, 0)) AS {D38}) AS net
 FROM (SELECT amount, CASE WHEN txn_id % 10 <> 0 THEN fee_amount END AS f FROM transactions)""",
        "conformed_merchants": WITH + GOOD_M,
        "utf16_load": WITH + GOOD_M,
        "conformed_transactions": WITH + GOOD_T,
        "delimited_load": WITH + GOOD_T,
        "rejects": REJECTS,
        "load_rejects": REJECTS,
        "full_refresh": WITH + f"""SELECT 'merchants' AS table_name, COUNT(*) AS rows, CAST(SUM(merchant_id) AS BIGINT) AS key_sum FROM ({GOOD_M})
 UNION ALL SELECT 'transactions', COUNT(*), CAST(SUM(txn_id) AS BIGINT) FROM ({GOOD_T})""",
        "load_metrics": WITH + " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, COUNT(*) FILTER (WHERE NOT ({bad(n)})) AS rows, COUNT(*) FILTER (WHERE {bad(n)}) AS rejected, 'loaded' AS state, TRUE AS timed FROM {n}"
            for n in ("merchants", "transactions")
        ),
        "selected_tables": WITH + " UNION ALL ".join(f"SELECT 'public' AS schema_name, '{t}' AS table_name, COUNT(*) AS rows FROM {t}" for t in ("merchants", "transactions", "batches")),
        "mapped_columns": WITH + "SELECT txn_id, merchant_id, amount AS gross_amount FROM transactions",
        "renamed_columns": WITH + "SELECT txn_id, merchant_id, amount FROM transactions",
        "new_guids": "SELECT COUNT(*) AS rows, COUNT(*) AS guids, COUNT(*) AS well_formed FROM customer",
        "service_projections": WITH + """SELECT 'merchant_svc_merchants' AS view_name, COUNT(*) AS rows, CAST(9 AS BIGINT) AS columns FROM merchants
 UNION ALL SELECT 'merchant_public', COUNT(*), 3 FROM merchants UNION ALL SELECT 'txn_svc_transactions', COUNT(*), 10 FROM transactions""",
        "merchant_public": WITH + "SELECT merchant_id, merchant_guid, is_active FROM merchants",
        "capture_days": WITH + "SELECT DISTINCT CAST(captured_at AS DATE) AS capture_date FROM transactions",
        "latest_days": WITH + LATEST,
        "partitioned_export": WITH + f"SELECT {EXPORTED} FROM transactions",
        "export_latest": WITH + f"SELECT CAST(captured_at AS DATE) AS capture_date, COUNT(*) AS rows, TRUE AS has_bytes FROM transactions WHERE CAST(captured_at AS DATE) IN ({LATEST}) GROUP BY 1",
        "export_pruned": WITH + f"""SELECT CAST(captured_at AS DATE) AS capture_date, COUNT(*) AS rows, CAST(SUM(amount) AS {D38}) AS gross FROM transactions
 WHERE captured_at >= TIMESTAMP '2001-03-01 00:00:00' AND captured_at < TIMESTAMP '2001-04-01 00:00:00' GROUP BY 1""",
        "export_of_large_batches": WITH + f"SELECT {EXPORTED} FROM transactions WHERE CAST(captured_at AS DATE) IN (SELECT batch_date FROM batches WHERE gross_amount >= {q.LARGE_BATCH})",
        "apply_changes": STATE,
        "replicate_stream": STATE,
        "replica_out_of_order": STATE,
        "replica_reload": f"SELECT k, amount FROM ({STATE})",
        "replica_errors": CONFLICTS,
        "replica_stats": COUNTED.replace(" FROM verdicts", ", CAST(0 AS BIGINT) AS stale FROM verdicts"),
        "apply_conflicts": CONFLICTS,
        "load_conflicts_ignored": WITH + f"SELECT op, v AS verdict, COUNT(*) AS changes FROM (SELECT op, CASE WHEN seq <= {q.AS_OF_SEQ} AND verdict <> 'applied' THEN 'ignored' ELSE verdict END AS v FROM verdicts) GROUP BY op, v",
        "as_of_state": WITH + state_sql(f"seq <= {q.AS_OF_SEQ}"),
        "table_stats": COUNTED,
        "replication_report": WITH + f"""SELECT 'accounts' AS table_name, (SELECT COUNT(*) FROM accounts) AS full_load_rows,
  COUNT(*) FILTER (WHERE op = 'I') AS inserts, COUNT(*) FILTER (WHERE op = 'U') AS updates, COUNT(*) FILTER (WHERE op = 'D') AS deletes,
  CAST(0 AS BIGINT) AS mismatched_rows, 'validated' AS validation_state FROM verdicts WHERE verdict = 'applied'
 UNION ALL SELECT 'transactions', (SELECT COUNT(*) FROM transactions), 0, 0, 0, COUNT(*), 'mismatched records'
  FROM transactions s FULL JOIN migrated t ON s.txn_id = t.txn_id WHERE s.txn_id IS NULL OR t.txn_id IS NULL OR ({CHANGED}) <> ''""",
        "error_escalation": WITH + f""", e AS (SELECT CAST(k // 100 AS VARCHAR) AS table_name, COUNT(*) AS errors FROM verdicts WHERE verdict NOT IN ('applied', 'ignored') GROUP BY 1)
 SELECT table_name, errors, CASE WHEN errors > {q.ERROR_LIMIT} THEN 'suspended' ELSE 'running' END AS state,
  CASE WHEN (SELECT COUNT(*) FROM e WHERE errors > {q.ERROR_LIMIT}) > 1 THEN 'stopped' ELSE 'running' END AS task FROM e""",
        "change_history": WITH + HISTORY,
        "change_history_stream": WITH + f"SELECT * FROM ({HISTORY}) WHERE slot_end <= (SELECT date_trunc('millisecond', MAX(commit_ts)) FROM changes) - INTERVAL '10' MINUTE",
        "replication_lag": WITH + f"SELECT op, COUNT(*) AS changes, CAST(MIN({LAG}) AS DECIMAL(18,6)) AS min_lag, CAST(MAX({LAG}) AS DECIMAL(18,6)) AS max_lag FROM changes GROUP BY op",
        "coverage_gap": WITH + COVERAGE,
        "pending_mismatches": f"""SELECT k, first_seen, CASE WHEN age >= 1800 THEN 'suspended' WHEN age >= 300 THEN 'confirmed' ELSE 'pending' END AS state FROM (
 SELECT b.k, COALESCE(f.first_seen, {ts(q.SEEN_AT)}) AS first_seen,
   CAST(floor(epoch({ts(q.SEEN_AT)})) - floor(epoch(COALESCE(f.first_seen, {ts(q.SEEN_AT)}))) AS BIGINT) AS age
 FROM ({WITH} SELECT * FROM accounts) b
 LEFT JOIN ({STATE}) s ON s.k = b.k
 LEFT JOIN ({WITH} SELECT k, MIN(commit_ts) AS first_seen FROM changes WHERE op <> 'U' GROUP BY k) f ON f.k = b.k
 WHERE s.amount IS DISTINCT FROM b.amount)""",
        "cutover_gate": WITH + BOTH + f"""SELECT 'lag' AS condition, CAST(m AS VARCHAR) AS value, '{q.MAX_LAG}' AS wanted, m <= {q.MAX_LAG} AS passed FROM (SELECT CAST(MAX({LAG}) AS DECIMAL(18,6)) AS m FROM changes)
 UNION ALL SELECT 'verification', CAST(n AS VARCHAR), '0', n = 0 FROM (SELECT COUNT(*) AS n FROM compared WHERE NOT same AND check_name IN ({COMPARED_SQL}) AND {CLASS_SQL} < 3)
 UNION ALL SELECT 'coverage', CAST(COUNT(*) AS VARCHAR), '0', COUNT(*) = 0 FROM ({COVERAGE})""",
        "arrival_proof": WITH + """SELECT COUNT(*) > 0 AS arrived, COALESCE(bool_and(amount = 4321.4321), FALSE) AS matches, COUNT(*) AS rows
 FROM (SELECT MAX(k) + 1000001 AS k, CAST(4321.4321 AS DECIMAL(19,4)) AS amount FROM changes) WHERE k NOT IN (SELECT k FROM accounts)""",
    }
