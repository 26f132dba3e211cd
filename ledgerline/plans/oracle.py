"""ANSI SQL over the same tables, one text per catalogue query."""

from __future__ import annotations

from ledgerline.plans import standin

_DEFI = "(3, 7, 11)"
_ROLLUP = "(20, 21)"

_EVENTS = f"""
ev AS (
  SELECT event_id, event_type AS asset, value AS amount, user_id AS f, ts,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS t,
         epoch_us(ts) // 21600000000 AS block_number
  FROM events
),
ledger AS (
  SELECT event_id, asset, amount, f, t, block_number,
         block_number * 21600 AS "timestamp",
         block_number * 1000000 + f AS tx,
         DATE '1970-01-01' + CAST(block_number // 4 AS INTEGER) AS "date",
         f IN {_DEFI} OR t IN {_DEFI} AS is_defi_transaction,
         f IN {_ROLLUP} OR t IN {_ROLLUP} AS is_rollup_transaction
  FROM ev
)"""

_LINE_ITEMS = """
dim AS (
  SELECT s_suppkey, bool_or(r_name = 'ASIA') AS defi, bool_or(r_name = 'EUROPE') AS rollup
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY s_suppkey
),
ledger AS (
  SELECT l_returnflag AS asset, CAST(l_shipdate AS DATE) AS "date",
         l_orderkey AS tx, l_suppkey AS f, o_custkey + 1099511627776 AS t,
         l_extendedprice AS amount,
         COALESCE(defi, FALSE) AS is_defi_transaction,
         COALESCE(rollup, FALSE) AS is_rollup_transaction
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN dim ON s_suppkey = l_suppkey
)"""


def _address(number: str) -> str:
    return f"'0x' || lpad(lower(to_hex({number})), 40, '0')"


def _hash(number: str) -> str:
    return f"'0x' || lpad(lower(to_hex({number})), 64, '0')"


def _stats(keys: str, ledger: str = "ledger") -> str:
    join = " AND ".join(f"s.{k} = a.{k}" for k in keys.split(", "))
    columns = ", ".join(f"s.{k}" for k in keys.split(", "))
    return f"""
SELECT {columns}, total_volume, transaction_count, transfer_count,
       total_volume / transfer_count AS avg_transfer_size, different_addresses,
       defi_transaction_count, rollup_transaction_count
FROM (
  SELECT {keys}, round(SUM(amount), 2) AS total_volume,
         COUNT(DISTINCT tx) AS transaction_count, COUNT(*) AS transfer_count,
         COUNT(DISTINCT tx) FILTER (WHERE is_defi_transaction) AS defi_transaction_count,
         COUNT(DISTINCT tx) FILTER (WHERE is_rollup_transaction) AS rollup_transaction_count
  FROM {ledger} GROUP BY {keys}
) s JOIN (
  SELECT {keys}, COUNT(DISTINCT party) AS different_addresses
  FROM (SELECT {keys}, f AS party FROM {ledger} UNION ALL SELECT {keys}, t FROM {ledger}) p
  GROUP BY {keys}
) a ON {join}"""


_DAILY = _stats('asset, "date"')
_WITH_DAILY = f"WITH {_EVENTS}, daily AS ({_DAILY})"

# what is read from files that lack columns
_WITH_LACKING = f"""WITH {_EVENTS}, whole AS ({_DAILY}), lacking AS (
  SELECT * REPLACE (
    CASE WHEN asset <> 'click' THEN different_addresses END AS different_addresses,
    CASE WHEN asset <> 'purchase' THEN defi_transaction_count END AS defi_transaction_count,
    CASE WHEN asset <> 'purchase' THEN rollup_transaction_count END AS rollup_transaction_count)
  FROM whole WHERE asset <> 'error')"""

# Logs that survive each step; the spoilt ones are described at raw_receipts.
_SIGNED = "t < 90"
_TWO_PARTIES = "t < 80"
_REGISTERED = "asset <> 'error'"
_HEX = "amount >= 5"
_TIMED = "day(\"date\") <> 13"
_DECODED = f"{_TWO_PARTIES} AND {_REGISTERED} AND {_HEX}"

_TRANSFER_COLUMNS = f"""
SELECT block_number, "timestamp", {_hash("tx")} AS tx_hash, {_address("f")} AS "from",
       {_address("t")} AS "to", amount, is_defi_transaction, is_rollup_transaction,
       CAST(round(amount * 1000000) AS BIGINT) AS amount_raw,
       CAST(2 AS INTEGER) AS tx_pos, CAST(1 AS INTEGER) AS log_pos, asset, "date"
FROM ledger"""

_TOKENS = "VALUES " + ", ".join(
    f"('{asset}', '{address}', {decimals}, '{symbol}')"
    for asset, address, decimals, symbol, _ in standin.token_rows()
)

_METRICS = {
    "total_volume": "total_volume",
    "transaction_count": "transaction_count",
    "different_addresses": "different_addresses",
    "defi_transaction_count": "defi_transaction_count",
    "rollup_transaction_count": "rollup_transaction_count",
}

_SERIES = " UNION ALL ".join(
    f"""SELECT asset, upper(asset) AS label, "date", '{m}' AS metric,
        CAST({m} AS DOUBLE) AS value FROM daily"""
    for m in _METRICS
)

ORACLE: dict[str, str] = {
    "decode_transfers": f"WITH {_EVENTS} {_TRANSFER_COLUMNS} WHERE {_DECODED}",
    "decode_with_headers": (
        f"WITH {_EVENTS} {_TRANSFER_COLUMNS} WHERE {_DECODED} AND {_TIMED}"
    ),
    "rejected_logs": f"""
WITH {_EVENTS}
SELECT block_number, CAST(2 AS INTEGER) AS tx_pos, CAST(1 AS INTEGER) AS log_pos,
       {_hash("tx")} AS tx_hash, asset, {_address("f")} AS "from", {_address("t")} AS "to",
       '0xnothex' AS data, 'amount is not hexadecimal' AS reject_reason
FROM ledger WHERE {_TWO_PARTIES} AND {_REGISTERED} AND NOT ({_HEX})""",
    "decode_wide_amounts": """
WITH e AS (
  SELECT event_id, user_id + 1 AS n, event_id % 51 AS k,
         CASE WHEN event_id % 2 = 0 THEN 6 ELSE 18 END AS decimals
  FROM events
), d AS (SELECT *, length(to_hex(n)) + k AS digits FROM e)
SELECT event_id,
       CASE WHEN digits <= 30 THEN CAST(CAST(n AS HUGEINT)
         * CAST(pow(16::DOUBLE, least(k, 24)) AS HUGEINT)
         * CAST(pow(16::DOUBLE, CASE WHEN digits <= 30 THEN greatest(k - 24, 0) ELSE 0 END)
           AS HUGEINT) AS VARCHAR) END AS amount_raw,
       CASE WHEN digits > 30 THEN lower(to_hex(n)) || repeat('0', k) END AS amount_hex,
       n * pow(16::DOUBLE, k) / pow(10::DOUBLE, decimals) AS amount
FROM d""",
    "extract_job": f"""
WITH {_EVENTS}, tokens(asset, address, decimals, symbol) AS ({_TOKENS}),
good AS (SELECT * FROM ledger WHERE {_DECODED}),
bad AS (SELECT * FROM ledger WHERE {_TWO_PARTIES} AND {_REGISTERED} AND NOT ({_HEX}))
SELECT k.asset,
       (SELECT COUNT(DISTINCT "date") FROM good g WHERE g.asset = k.asset) AS days,
       (SELECT COUNT(*) FROM good g WHERE g.asset = k.asset) AS transfers,
       (SELECT round(SUM(amount), 2) FROM good g WHERE g.asset = k.asset) AS volume,
       (SELECT COUNT(*) FROM bad b WHERE b.asset = k.asset) AS rejects
FROM tokens k""",
    "landed_blocks": f"""
WITH {_EVENTS}
SELECT block_number, '0x' || lower(to_hex("timestamp")) AS "timestamp",
       CASE WHEN event_id % 50 <> 9 THEN CAST(3 AS INTEGER) END AS receipts
FROM ledger WHERE event_id % 50 NOT IN (7, 8)""",
    "landed_headers": f"""
WITH {_EVENTS}
SELECT block_number, COUNT(*) AS records, '0x' || lower(to_hex("timestamp")) AS "timestamp"
FROM ledger WHERE event_id % 50 NOT IN (7, 8) GROUP BY ALL""",
    "corrupt_records": f"""
WITH {_EVENTS}
SELECT left(CASE WHEN event_id % 50 = 7 THEN '{{"block_number":' || block_number
         ELSE '{{"block_number":"0x' || lower(to_hex(block_number)) || '"' END
         || ',"timestamp":"0x', 30) AS begins,
       CASE WHEN event_id % 50 = 7 THEN 'not JSON' ELSE 'a value of another type' END AS reason,
       COUNT(*) AS records
FROM ledger WHERE event_id % 50 IN (7, 8) GROUP BY ALL""",
    "incremental_raw": f"""
WITH {_EVENTS}
SELECT asset, COUNT(DISTINCT "date") FILTER (WHERE {_HEX}) AS days,
       COUNT(*) FILTER (WHERE {_HEX}) AS transfers, COUNT(*) FILTER (WHERE NOT ({_HEX})) AS rejects
FROM ledger WHERE {_TWO_PARTIES} AND {_REGISTERED} GROUP BY asset""",
    "block_hex_keys": f"""
WITH {_EVENTS}
SELECT DISTINCT block_number, '0x' || lower(to_hex(block_number)) AS block_key FROM ledger""",
    "event_filter": f"""
WITH {_EVENTS}
SELECT event_id, block_number, CAST(2 AS INTEGER) AS tx_pos, CAST(1 AS INTEGER) AS log_pos
FROM ledger WHERE {_TWO_PARTIES}""",
    "asset_attribution": f"""
WITH {_EVENTS}, tokens(asset, address, decimals, symbol) AS ({_TOKENS})
SELECT event_id, k.asset, k.address, CAST(k.decimals AS INTEGER) AS decimals
FROM ledger l JOIN tokens k ON l.asset = k.asset WHERE {_SIGNED} AND l.{_REGISTERED}""",
    "block_time_join": f"""
WITH {_EVENTS}
SELECT event_id, block_number, "timestamp" FROM ledger WHERE {_SIGNED} AND {_TIMED}""",
    "asset_selection": f"""
WITH {_EVENTS}
SELECT asset, {_hash("tx")} AS tx_hash, amount FROM ledger
WHERE asset IN ('purchase', 'view')""",
    "block_range": f"""
WITH {_EVENTS}
SELECT block_number, event_id AS log_pos, asset, amount FROM ledger
WHERE block_number BETWEEN 78900 AND 78950
ORDER BY block_number, log_pos""",
    "epoch_date": """
SELECT event_id, epoch_us(ts) // 1000000 AS "timestamp", CAST(ts AS DATE) AS utc_date,
       CAST(ts + INTERVAL 9 HOUR AS DATE) AS tokyo_date
FROM events""",
    "protocol_dimension": f"""
WITH {_EVENTS},
nested(category, protocol, numbers) AS (
  VALUES ('defi', 'amber', [3, 7]), ('defi', 'basalt', [11]),
         ('rollup', 'cobalt', [20]), ('rollup', 'dune', [21])
),
listed AS (SELECT category, protocol, unnest(numbers) AS n FROM nested),
parties AS (SELECT f AS n FROM ledger UNION ALL SELECT t FROM ledger)
SELECT category, protocol, {_address("n")} AS address, COUNT(*) AS contacts
FROM listed JOIN parties USING (n) GROUP BY category, protocol, n""",
    "category_flags": f"""
WITH {_EVENTS}
SELECT event_id, is_defi_transaction, is_rollup_transaction,
       is_defi_transaction OR is_rollup_transaction AS is_either
FROM ledger""",
    "category_flags_dim": f"""
WITH {_LINE_ITEMS}
SELECT {_hash("tx")} AS tx_hash, {_address("f")} AS "from", amount,
       is_defi_transaction, is_rollup_transaction
FROM ledger""",
    "touching_semi": f"""
WITH {_LINE_ITEMS}
SELECT asset, "date", {_hash("tx")} AS tx_hash, {_address("f")} AS "from", amount
FROM ledger SEMI JOIN (SELECT s_suppkey FROM dim WHERE defi) d ON f = s_suppkey""",
    "daily_volume": f"""
WITH {_EVENTS}
SELECT asset, "date", round(SUM(amount), 2) AS total_volume, COUNT(*) AS transfer_count,
       round(SUM(amount), 2) / COUNT(*) AS avg_transfer_size
FROM ledger GROUP BY asset, "date" """,
    "daily_transactions": f"""
WITH {_EVENTS}
SELECT asset, "date", COUNT(DISTINCT tx) AS transaction_count
FROM ledger GROUP BY asset, "date" """,
    "daily_addresses": f"""
WITH {_EVENTS}
SELECT asset, "date", COUNT(DISTINCT party) AS different_addresses
FROM (SELECT asset, "date", f AS party FROM ledger
      UNION ALL SELECT asset, "date", t FROM ledger) p
GROUP BY asset, "date" """,
    "daily_categories": f"""
WITH {_EVENTS}
SELECT asset, "date",
       COUNT(DISTINCT tx) FILTER (WHERE is_defi_transaction) AS defi_transaction_count,
       COUNT(DISTINCT tx) FILTER (WHERE is_rollup_transaction) AS rollup_transaction_count
FROM ledger GROUP BY asset, "date" """,
    "daily_stats": f"WITH {_EVENTS} {_DAILY} ORDER BY 1, 2",
    "daily_stats_li": f"WITH {_LINE_ITEMS} {_DAILY} ORDER BY 1, 2",
    "daily_stats_raw": f"""
WITH {_EVENTS}, decoded AS (SELECT * FROM ledger WHERE {_DECODED} AND {_TIMED})
{_stats('asset, "date"', "decoded")} ORDER BY 1, 2""",
    "overall_stats": f"""
WITH {_EVENTS}, tokens(asset, address, decimals, symbol) AS ({_TOKENS})
SELECT o.*, symbol, CASE WHEN symbol = 'EURC' THEN '€' ELSE '$' END AS currency
FROM ({_stats("asset")}) o JOIN tokens k ON o.asset = k.asset""",
    "overall_stats_li": f"WITH {_LINE_ITEMS} {_stats('asset')}",
    "transfers_per_asset": f"""
WITH {_EVENTS}, tokens(asset, address, decimals, symbol) AS ({_TOKENS})
SELECT k.asset, symbol, COUNT(l.event_id) AS transfer_count
FROM tokens k LEFT JOIN ledger l ON k.asset = l.asset GROUP BY k.asset, symbol""",
    "chunk_counts": f"""
WITH {_EVENTS}
SELECT (block_number - lo) // 50 AS chunk_id,
       lo + (block_number - lo) // 50 * 50 AS first_block,
       least(lo + (block_number - lo) // 50 * 50 + 49, hi) AS last_block,
       asset, COUNT(*) AS transfer_count
FROM ledger, (SELECT min(block_number) AS lo, max(block_number) AS hi FROM ev) GROUP BY ALL""",
    "block_coverage": f"""
WITH {_EVENTS},
spine AS (SELECT lo, unnest(range(lo, hi + 1)) AS block_number
  FROM (SELECT min(block_number) AS lo, max(block_number) AS hi FROM ev)),
present AS (SELECT DISTINCT block_number FROM ledger WHERE {_TIMED})
SELECT (s.block_number - lo) // 50 AS chunk_id, COUNT(*) AS blocks_processed,
       COUNT(p.block_number) AS blocks_present
FROM spine s LEFT JOIN present p ON s.block_number = p.block_number GROUP BY ALL""",
    "missing_blocks": f"""
WITH {_EVENTS},
spine AS (SELECT unnest(range(lo, hi + 1)) AS block_number
  FROM (SELECT min(block_number) AS lo, max(block_number) AS hi FROM ev))
SELECT block_number FROM spine
WHERE block_number NOT IN (SELECT block_number FROM ledger WHERE {_TIMED})""",
    "summary_stats": f"""
{_WITH_DAILY}
SELECT asset, COUNT(*) AS days, round(SUM(total_volume), 2) AS total_volume,
       CAST(SUM(transaction_count) AS BIGINT) AS total_transactions,
       round(AVG(total_volume), 4) AS avg_daily_volume,
       round_even(AVG(transaction_count), 0) AS avg_daily_transactions,
       round_even(AVG(different_addresses), 0) AS avg_daily_addresses,
       MAX(different_addresses) AS max_daily_addresses,
       round_even(AVG(defi_transaction_count), 0) AS avg_daily_defi_transactions,
       MAX(defi_transaction_count) AS max_daily_defi_transactions,
       round_even(AVG(rollup_transaction_count), 0) AS avg_daily_rollup_transactions,
       MAX(rollup_transaction_count) AS max_daily_rollup_transactions
FROM daily GROUP BY asset""",
    "loaded_assets": f"""
{_WITH_DAILY} SELECT COUNT(DISTINCT asset) AS assets, COUNT(*) AS daily_rows FROM daily""",
    "chart_series": f"""
{_WITH_DAILY}, series AS ({_SERIES})
SELECT *, CASE WHEN value > 0 THEN round(log10(value), 9) END AS log10_value FROM series""",
    "transfers_roundtrip": f"""
WITH {_EVENTS}
SELECT asset, block_number, "timestamp", {_hash("tx")} AS tx_hash, {_address("f")} AS "from",
       {_address("t")} AS "to", amount, is_defi_transaction, is_rollup_transaction
FROM ledger""",
    "transfers_csv_counts": f"""
WITH {_EVENTS} SELECT asset, COUNT(*) AS transfer_count FROM ledger GROUP BY asset""",
    "daily_csv_roundtrip": f"""
{_WITH_DAILY}
SELECT asset, "date", total_volume, transaction_count, transfer_count, different_addresses,
       defi_transaction_count, rollup_transaction_count FROM daily""",
    "optional_columns": f"""
{_WITH_DAILY}
SELECT asset, "date", total_volume, transaction_count,
       CASE WHEN asset <> 'click' THEN different_addresses END AS different_addresses,
       CASE WHEN asset <> 'purchase' THEN defi_transaction_count END
         AS defi_transaction_count,
       CASE WHEN asset <> 'purchase' THEN rollup_transaction_count END
         AS rollup_transaction_count
FROM daily WHERE asset <> 'error'""",
    "skipped_files": """
SELECT DISTINCT event_type AS asset,
       CASE WHEN event_type = 'error' THEN 'missing required columns' END AS reason
FROM events""",
    "incremental_daily": f"WITH {_EVENTS} {_DAILY}",
    "incremental_levels": f"""
WITH {_EVENTS}, months AS (
  SELECT * REPLACE (CAST(date_trunc('month', "date") AS DATE) AS "date") FROM ledger
) {_stats('asset, "date"', "months")}""",
    "incremental_replay": f"""
WITH {_EVENTS}, kept AS (
  SELECT * FROM ledger WHERE NOT (event_id % 4 = 1 AND day("date") % 2 = 1)
) {_stats('asset, "date"', "kept")}""",
    "stateful_daily": f"WITH {_EVENTS} {_DAILY}",
    "address_estimates": f"""
WITH {_EVENTS}, spans AS (
  SELECT *, strftime("date", '%Y-%m') AS span FROM ledger UNION ALL SELECT *, 'all' FROM ledger
)
SELECT asset, span, COUNT(DISTINCT party) AS different_addresses, TRUE AS close
FROM (SELECT asset, span, f AS party FROM spans UNION ALL SELECT asset, span, t FROM spans) p
GROUP BY asset, span""",
    "overall_stats_bitmap": f"WITH {_LINE_ITEMS} {_stats('asset')}",
    "stats_by_sets": f"""
WITH {_LINE_ITEMS}, daily AS ({_DAILY}), overall AS ({_stats('asset')})
SELECT *, FALSE AS is_total FROM daily
UNION ALL BY NAME SELECT *, CAST(NULL AS DATE) AS "date", TRUE AS is_total FROM overall""",
    "missing_intervals": f"""
WITH {_EVENTS},
spine AS (SELECT unnest(range(lo, hi + 1)) AS b
  FROM (SELECT min(block_number) - 20 AS lo, max(block_number) + 3 AS hi FROM ev)),
absent AS (SELECT b, b - row_number() OVER (ORDER BY b) AS island FROM spine
  WHERE b NOT IN (SELECT block_number FROM ledger WHERE {_TIMED}))
SELECT min(b) AS first_block, max(b) AS last_block, COUNT(*) AS blocks FROM absent GROUP BY island""",
    "overall_euro": f"""
WITH {_EVENTS}
SELECT asset, CASE WHEN asset = 'purchase' THEN 'EURC' ELSE upper(asset) END AS symbol,
       CASE WHEN asset = 'purchase' THEN '€' ELSE '$' END AS currency,
       COUNT(*) AS transfer_count,
       CASE WHEN asset = 'purchase' THEN '€' ELSE '$' END || format('{{:.2f}}', SUM(amount)) AS shown_volume
FROM ledger GROUP BY asset""",
    "series_lacking_metrics": f"""
{_WITH_LACKING}, daily AS (SELECT * FROM lacking), series AS ({_SERIES})
SELECT *, CASE WHEN value > 0 THEN round(log10(value), 9) END AS log10_value
FROM series WHERE value IS NOT NULL""",
    "summary_lacking_metrics": f"""
{_WITH_LACKING}
SELECT asset, COUNT(*) AS days, round(SUM(total_volume), 2) AS total_volume,
       CAST(SUM(transaction_count) AS BIGINT) AS total_transactions,
       MAX(different_addresses) AS max_daily_addresses,
       MAX(defi_transaction_count) AS max_daily_defi_transactions,
       MAX(rollup_transaction_count) AS max_daily_rollup_transactions,
       round_even(AVG(different_addresses), 0) AS avg_daily_addresses,
       round_even(AVG(defi_transaction_count), 0) AS avg_daily_defi_transactions,
       round_even(AVG(rollup_transaction_count), 0) AS avg_daily_rollup_transactions
FROM lacking GROUP BY asset""",
    "odd_figures": f"""
{_WITH_DAILY}
SELECT asset,
       CASE asset WHEN 'view' THEN 'a figure is no number: total_volume_view'
         WHEN 'signup' THEN 'a figure is no number: transfer_count' END AS reason,
       CASE WHEN asset NOT IN ('view', 'signup') THEN COUNT(*) END AS days,
       CASE WHEN asset NOT IN ('view', 'signup') THEN CAST(SUM(transfer_count) AS BIGINT) END AS transfers,
       CASE WHEN asset NOT IN ('view', 'signup') THEN COUNT(*) FILTER (WHERE NOT (
         asset = 'error' AND "date" = (SELECT min("date") FROM daily))) END AS days_with_addresses
FROM daily GROUP BY asset""",
    "block_layout": f"""
WITH {_EVENTS}, ends AS (SELECT min(block_number) AS lo, max(block_number) AS hi FROM ev)
SELECT block_number, COUNT(*) AS records, COUNT(*) * 3 AS receipts
FROM ledger, ends
WHERE block_number BETWEEN lo + (hi - lo) // 3 AND hi - (hi - lo) // 3 GROUP BY block_number""",
}
ORACLE["block_time_bucketed"] = ORACLE["block_time_join"]
ORACLE["category_flags_filtered"] = ORACLE["category_flags_dim"]
