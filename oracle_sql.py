"""DuckDB oracle: the expected result of every registered query, as SQL.

Written independently of the Spark code, straight from the rules' SQL
meaning, over the driver's views (``events``, ``customer``, ``nation``).
The derived warehouse tables are CTEs; SCD2 runs are set-based SQL.
"""

from __future__ import annotations

OPEN = "TIMESTAMP '9999-12-31 00:00:00'"
NEVER = "TIMESTAMP '9999-01-01 00:00:00'"

CLIENT_ATTRS = ["last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
                "passport_valid_to", "phone", "create_dt"]
CLIENT_TEXT = {"client_id", "last_name", "first_name", "patronymic", "passport_num", "phone"}
RUNS = {1: "2024-01-02", 2: "2024-01-16", 3: "2024-01-23"}
WATERMARK = {1: "1900-01-01", 2: "2024-01-02", 3: "2024-01-16"}


def _ts(d: str) -> str:
    return f"TIMESTAMP '{d} 00:00:00'" if len(d) == 10 else f"TIMESTAMP '{d}'"


def _clean(c: str) -> str:
    return f"NULLIF(trim({c}), '')"


TX = """tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         date_trunc('second', ts) AS transaction_date,
         CAST(round(value, 2) AS DECIMAL(10,2)) AS amount,
         'C' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS card_num,
         event_type AS oper_type,
         CASE WHEN event_type = 'purchase' THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
         'T' || lpad(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR), 3, '0') AS terminal
  FROM events)"""

RAW = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS transaction_date,
         CASE WHEN event_type = 'error'
              THEN 'n/a ' || CAST(CAST(round(value, 2) AS DECIMAL(10,2)) AS VARCHAR)
              ELSE replace(CAST(CAST(round(value, 2) AS DECIMAL(10,2)) AS VARCHAR), '.', ',') END AS amount,
         'C' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS card_num,
         event_type AS oper_type,
         CASE WHEN event_type = 'purchase' THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
         'T' || lpad(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR), 3, '0') AS terminal,
         'transactions_' || strftime(ts, '%d%m%Y') || '.txt' AS file_name
  FROM events),
typed AS (
  SELECT file_name,
         NULLIF(trim(transaction_id), '') AS transaction_id,
         CAST(date_trunc('second', TRY_CAST(trim(transaction_date) AS TIMESTAMP)) AS TIMESTAMP) AS transaction_date,
         TRY_CAST(replace(trim(amount), ',', '.') AS DECIMAL(10,2)) AS amount,
         NULLIF(trim(card_num), '') AS card_num,
         NULLIF(trim(oper_type), '') AS oper_type,
         NULLIF(trim(oper_result), '') AS oper_result,
         NULLIF(trim(terminal), '') AS terminal,
         concat_ws(';', raw.transaction_id, raw.transaction_date, raw.amount, raw.card_num,
                   raw.oper_type, raw.oper_result, raw.terminal) AS raw_line
  FROM raw),
checked AS (
  SELECT *, CASE WHEN transaction_id IS NULL THEN 'missing transaction_id'
                 WHEN transaction_date IS NULL THEN 'bad transaction_date'
                 WHEN amount IS NULL THEN 'bad amount'
                 WHEN card_num IS NULL THEN 'missing card_num' END AS reason
  FROM typed)"""

TERMS = f"""terms AS (
  SELECT 'T' || lpad(CAST(k AS VARCHAR), 3, '0') AS terminal_id,
         CASE WHEN k % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
         n.n_name AS terminal_city,
         'addr ' || CAST(k AS VARCHAR) AS terminal_address,
         TIMESTAMP '2023-12-01 00:00:00' AS update_dt
  FROM (SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) ks
  LEFT JOIN nation n ON ks.k % 25 = n.n_nationkey),
term_h AS (
  SELECT {_clean('terminal_id')} AS terminal_id, {_clean('terminal_type')} AS terminal_type,
         {_clean('terminal_city')} AS terminal_city, {_clean('terminal_address')} AS terminal_address,
         update_dt AS effective_from, {OPEN} AS effective_to, 'N' AS deleted_flg
  FROM terms)"""

CREATE = ("CASE WHEN c_custkey % 17 = 5 THEN TIMESTAMP '2024-01-10 00:00:00' "
          "ELSE TIMESTAMP '2023-12-01 00:00:00' END")

ACCS = f"""acc_h AS (
  SELECT 'A' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS account,
         TIMESTAMP '2024-01-10 00:00:00' + to_days(CAST(c_custkey % 40 AS INTEGER)) AS valid_to,
         CAST(c_custkey AS VARCHAR) AS client,
         {CREATE} AS create_dt,
         {CREATE} AS effective_from, {OPEN} AS effective_to, 'N' AS deleted_flg
  FROM customer)"""

CARDS = f"""cards_h AS (
  SELECT trim(rpad('C' || lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 20, ' ')) AS card_num,
         'A' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS account,
         {CREATE} AS create_dt,
         {CREATE} AS effective_from, {OPEN} AS effective_to, 'N' AS deleted_flg
  FROM customer)"""

BLACKLIST = """bl AS (
  SELECT TIMESTAMP '2024-01-15 00:00:00' AS entry_dt, 'PP' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS passport
  FROM customer WHERE c_custkey % 10 = 1
  UNION ALL
  SELECT TIMESTAMP '2024-01-20 00:00:00', 'PP' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')
  FROM customer WHERE c_custkey % 20 = 1),
bl_first AS (SELECT passport, min(entry_dt) AS entry_dt FROM bl GROUP BY passport)"""


def clients_snapshot(n: int) -> str:
    update = "CAST(NULL AS TIMESTAMP)"
    if n >= 2:
        update = (f"CASE WHEN c_custkey % 7 = 2 OR c_custkey % 13 = 4 "
                  f"THEN TIMESTAMP '2024-01-14 12:00:00' ELSE {update} END")
    if n >= 3:
        update = f"CASE WHEN c_custkey % 11 = 3 THEN TIMESTAMP '2024-01-20 00:00:00' ELSE {update} END"
    rows = {1: "c_custkey % 17 <> 5", 2: "c_custkey % 11 <> 3", 3: "TRUE"}[n]
    nine = "c_custkey % 7 = 2" if n >= 2 else "FALSE"
    raw = f"""  SELECT CAST(c_custkey AS VARCHAR) AS client_id,
         c_name AS last_name, c_mktsegment AS first_name,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'P' || CAST(c_custkey % 7 AS VARCHAR) END AS patronymic,
         TIMESTAMP '1980-01-01 00:00:00' + to_days(CAST(c_custkey % 7000 AS INTEGER)) AS date_of_birth,
         'PP' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS passport_num,
         CASE WHEN c_custkey % 3 = 0
              THEN TIMESTAMP '2024-01-05 00:00:00' + to_days(CAST(c_custkey % 20 AS INTEGER)) END AS passport_valid_to,
         '+7' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || CASE WHEN {nine} THEN '9' ELSE '0' END AS phone,
         {CREATE} AS create_dt,
         {update} AS update_dt
  FROM customer WHERE {rows}"""
    cols = ["client_id", *CLIENT_ATTRS, "update_dt"]
    sel = ", ".join(_clean(c) + f" AS {c}" if c in CLIENT_TEXT else c for c in cols)
    return f"cl{n} AS (SELECT {sel} FROM (\n{raw}) s)"


def scd2_run(n: int, key: str = "client_id", attrs: list[str] = CLIENT_ATTRS, watermark: bool = True) -> str:
    """History h{n} from h{n-1}, snapshot cl{n}, watermark and run date."""
    s_cols = ", ".join(f"s.{a} AS s_{a}" for a in attrs)
    o_cols = ", ".join(f"o.{a} AS o_{a}" for a in attrs)
    diff = " OR ".join(f"s_{a} IS DISTINCT FROM o_{a}" for a in attrs)
    run = _ts(RUNS[n])
    prev = f"h{n - 1}"
    keep = ", ".join(attrs)
    start = "coalesce(update_dt, create_dt)" if watermark else "update_dt"
    since = f"WHERE {start} >= {_ts(WATERMARK[n])}" if watermark else ""
    return f"""st{n} AS (
  SELECT {key}, {keep}, {start} AS effective_from FROM cl{n}
  {since}),
j{n} AS (
  SELECT coalesce(o.{key}, l.{key}, s.{key}) AS k, {o_cols}, o.effective_from AS o_from, o.deleted_flg AS o_flg,
         {s_cols}, s.effective_from AS s_from, s.{key} IS NOT NULL AS here, l.{key} IS NOT NULL AS listed
  FROM (SELECT * FROM {prev} WHERE effective_to = {OPEN}) o
  FULL JOIN (SELECT DISTINCT {key} FROM cl{n}) l ON o.{key} = l.{key}
  FULL JOIN st{n} s ON coalesce(o.{key}, l.{key}) = s.{key}),
f{n} AS (
  SELECT *,
         here AND coalesce(o_flg = 'N', FALSE) AND ({diff}) AS changed,
         here AND coalesce(o_flg = 'Y', FALSE) AS came_back,
         coalesce(o_flg = 'N', FALSE) AND NOT (here OR listed) AS gone
  FROM j{n}),
h{n} AS (
  SELECT * FROM {prev} WHERE effective_to <> {OPEN}
  UNION ALL
  SELECT k, {", ".join(f"o_{a}" for a in attrs)}, o_from,
         CASE WHEN changed OR came_back THEN s_from - INTERVAL 1 SECOND
              WHEN gone THEN {run} - INTERVAL 1 SECOND ELSE {OPEN} END, o_flg
  FROM f{n} WHERE o_flg IS NOT NULL
  UNION ALL
  SELECT k, {", ".join(f"s_{a}" for a in attrs)}, s_from, {OPEN}, 'N'
  FROM f{n} WHERE changed OR came_back OR (here AND o_flg IS NULL)
  UNION ALL
  SELECT k, {", ".join(f"o_{a}" for a in attrs)}, {run}, {OPEN}, 'Y'
  FROM f{n} WHERE gone)"""


def clients_history(runs: int) -> str:
    cols = ", ".join(f"CAST(NULL AS {'VARCHAR' if c in CLIENT_TEXT else 'TIMESTAMP'}) AS {c}"
                     for c in ["client_id", *CLIENT_ATTRS])
    parts = [f"h0 AS (SELECT {cols}, CAST(NULL AS TIMESTAMP) AS effective_from, "
             f"CAST(NULL AS TIMESTAMP) AS effective_to, CAST(NULL AS VARCHAR) AS deleted_flg WHERE FALSE)"]
    for n in range(1, runs + 1):
        parts += [clients_snapshot(n), scd2_run(n)]
    return ",\n".join(parts)


TOUCHED, BACK = "TIMESTAMP '2024-01-14 12:00:00'", "TIMESTAMP '2024-01-20 00:00:00'"


def _update(n: int, touched: str, back: str) -> str:
    c = "CAST(NULL AS TIMESTAMP)"
    if n >= 2:
        c = f"CASE WHEN {touched} THEN {TOUCHED} ELSE {c} END"
    if n >= 3:
        c = f"CASE WHEN {back} THEN {BACK} ELSE {c} END"
    return c


def _acc(n: str) -> str:
    return f"'A' || lpad(CAST({n} AS VARCHAR), 8, '0')"


def accounts_snapshot(n: int) -> str:
    rows = {1: "c_custkey % 13 <> 6", 2: "c_custkey % 9 <> 4", 3: "TRUE"}[n]
    more = "CASE WHEN c_custkey % 6 = 1 THEN 30 ELSE 0 END" if n >= 2 else "0"
    return f"""SELECT {_acc('c_custkey')} AS account,
  TIMESTAMP '2024-01-10 00:00:00' + to_days(CAST(c_custkey % 40 + {more} AS INTEGER)) AS valid_to,
  CAST(c_custkey AS VARCHAR) AS client, {CREATE} AS create_dt,
  {_update(n, "c_custkey % 6 = 1 OR c_custkey % 5 = 3", "c_custkey % 9 = 4")} AS update_dt FROM customer WHERE {rows}"""


def cards_snapshot(n: int) -> str:
    rows = {1: "c_custkey % 12 <> 7", 2: "c_custkey % 7 <> 5", 3: "c_custkey % 14 <> 5"}[n]
    to = "c_custkey + CASE WHEN c_custkey % 8 = 3 THEN 1 ELSE 0 END" if n >= 2 else "c_custkey"
    return f"""SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS card_num, {_acc(to)} AS account, {CREATE} AS create_dt,
  {_update(n, "c_custkey % 8 = 3 OR c_custkey % 11 = 2", "c_custkey % 7 = 5")} AS update_dt FROM customer WHERE {rows}"""


def terminals_snapshot(n: int) -> str:
    rows = {1: "k % 7 <> 3", 2: "k % 6 <> 2", 3: "TRUE"}[n]
    city = "(k + CASE WHEN k % 5 = 1 THEN 7 ELSE 0 END) % 25" if n >= 2 else "k % 25"
    return f"""SELECT 'T' || lpad(CAST(k AS VARCHAR), 3, '0') AS terminal_id,
  CASE WHEN k % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type, n.n_name AS terminal_city,
  'addr ' || CAST(k AS VARCHAR) AS terminal_address, {_ts(RUNS[n])} AS update_dt
  FROM (SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) ks
  LEFT JOIN nation n ON {city} = n.n_nationkey WHERE {rows}"""


def three_loads(key: str, attrs: dict[str, str], snapshot, watermark: bool = True) -> str:
    """History of a dimension after three loads; ``attrs``: column -> type."""
    cols = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in {key: "VARCHAR", **attrs}.items())
    parts = [f"h0 AS (SELECT {cols}, CAST(NULL AS TIMESTAMP) AS effective_from, "
             f"CAST(NULL AS TIMESTAMP) AS effective_to, CAST(NULL AS VARCHAR) AS deleted_flg WHERE FALSE)"]
    for n in (1, 2, 3):
        parts += [f"cl{n} AS ({snapshot(n)})", scd2_run(n, key, list(attrs), watermark)]
    return "WITH " + ",\n".join(parts) + "\n" + hist_select("h3", [key, *attrs])


def burst() -> str:
    """``tx`` with each week's times squeezed into its first 20 minutes."""
    week = "TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(7 * (date_diff('day', DATE '2024-01-01', CAST(t AS DATE)) // 7) AS INTEGER))"
    return TX.replace("tx AS (", "tx0 AS (") + f""",
tx AS (SELECT transaction_id, {week} + to_seconds(CAST(date_diff('second', {week}, t) // 504 AS INTEGER)) AS transaction_date,
  amount, card_num, oper_type, oper_result, terminal FROM (SELECT *, transaction_date AS t FROM tx0))"""


def hist_select(table: str, cols: list[str]) -> str:
    c = ", ".join(cols)
    return (f"SELECT {c}, effective_from, strftime(effective_to, '%Y-%m-%d %H:%M:%S') AS effective_to, "
            f"deleted_flg FROM {table}")


CLIENT_COLS = ["client_id", *CLIENT_ATTRS]


def asof_chain(src: str = "tx", terminals: bool = False) -> str:
    term = ""
    city = ""
    if terminals:
        term = """
  LEFT JOIN term_h tm ON tr.terminal = tm.terminal_id AND tm.deleted_flg = 'N'
       AND tr.transaction_date BETWEEN tm.effective_from AND tm.effective_to"""
        city = ", tm.terminal_city AS city"
    return f"""SELECT tr.*, cd.account, ac.valid_to, ac.client, cl.passport_num AS passport,
         cl.passport_valid_to, cl.phone,
         coalesce(cl.last_name, '') || ' ' || coalesce(cl.first_name, '') || ' ' || coalesce(cl.patronymic, '') AS fio{city}
  FROM {src} tr
  LEFT JOIN cards_h cd ON tr.card_num = cd.card_num AND cd.deleted_flg = 'N'
       AND tr.transaction_date BETWEEN cd.effective_from AND cd.effective_to
  LEFT JOIN acc_h ac ON cd.account = ac.account AND ac.deleted_flg = 'N'
       AND tr.transaction_date BETWEEN ac.effective_from AND ac.effective_to
  LEFT JOIN h3 cl ON ac.client = cl.client_id AND cl.deleted_flg = 'N'
       AND tr.transaction_date BETWEEN cl.effective_from AND cl.effective_to{term}"""


def warehouse_ctes(terminals: bool = True) -> str:
    parts = [TX, CARDS, ACCS, clients_history(3), BLACKLIST]
    if terminals:
        parts.append(TERMS)
    return "WITH " + ",\n".join(parts)


def report_cols(event_type: int, src: str = "") -> str:
    p = f"{src}." if src else ""
    return (f"{p}transaction_date AS event_dt, {p}passport, {p}fio, {p}phone, {event_type} AS event_type, "
            f"CAST(CAST({p}transaction_date AS DATE) AS TIMESTAMP) AS report_dt, {p}transaction_id AS tr_id")


RULE1 = f"""SELECT {report_cols(1, 'e')} FROM e LEFT JOIN bl_first b ON e.passport = b.passport
  WHERE (coalesce(b.entry_dt, {NEVER}) <= e.transaction_date
         OR coalesce(e.passport_valid_to, {NEVER}) <= e.transaction_date)
    AND e.oper_result = 'SUCCESS'"""

RULE2 = f"""SELECT {report_cols(2)} FROM e WHERE valid_to < transaction_date AND oper_result = 'SUCCESS'"""

RULE3 = f"""SELECT {report_cols(3)} FROM (
  SELECT e.*, lag(transaction_date) OVER w AS prev_t, lag(city) OVER w AS prev_city
  FROM e WHERE oper_result = 'SUCCESS' AND passport IS NOT NULL
  WINDOW w AS (PARTITION BY passport, CAST(transaction_date AS DATE) ORDER BY transaction_date, transaction_id)) x
  WHERE city <> prev_city
    AND transaction_date BETWEEN prev_t - INTERVAL '1 hour' AND prev_t + INTERVAL '1 hour'"""


def guess_ctes(within: str, strict: bool) -> str:
    if strict:
        cond = (f"oper_result = 'SUCCESS' AND r1 = 1 AND r2 = 1 AND r3 = 1 "
                f"AND transaction_date < t3 + INTERVAL '{within}'")
    else:
        cond = (f"(CASE WHEN r1 = 0 OR oper_result = 'REJECT' THEN 0 ELSE r1 + r2 + r3 + r4 END) >= 3 "
                f"AND transaction_date < coalesce(t3, {NEVER}) + INTERVAL '{within}' AND res2 = 'REJECT'")
    return f"""g AS (SELECT tx.*, CASE WHEN oper_result = 'SUCCESS' THEN 0 ELSE 1 END AS rej FROM tx),
g2 AS (
  SELECT g.*, lag(rej, 1, 0) OVER w AS r1, lag(rej, 2, 0) OVER w AS r2,
         lag(rej, 3, 0) OVER w AS r3, lag(rej, 4, 0) OVER w AS r4,
         lag(transaction_date, 3) OVER w AS t3, lag(oper_result, 2, '0') OVER w AS res2,
         lag(amount, 1, 0) OVER w AS a1, lag(amount, 2, 0) OVER w AS a2, lag(amount, 3, 0) OVER w AS a3
  FROM g WINDOW w AS (PARTITION BY card_num ORDER BY transaction_date, transaction_id)),
flagged AS (
  SELECT transaction_id, transaction_date, amount, card_num, oper_type, oper_result, terminal FROM g2
  WHERE {cond} AND amount < a1 AND a1 < a2 AND a2 < a3)"""


def rule4(within: str, strict: bool) -> str:
    return (warehouse_ctes(terminals=False) + ",\n" + guess_ctes(within, strict)
            + f",\ne4 AS ({asof_chain('flagged')})\nSELECT {report_cols(4)} FROM e4")


def report(within: str = "20 minutes", day: str | None = None, until: str | None = None) -> str:
    body = (warehouse_ctes() + ",\n" + guess_ctes(within, False)
            + f",\ne AS ({asof_chain(terminals=True)}),\ne4 AS ({asof_chain('flagged')}),\n"
            + f"rep AS ({RULE1}\nUNION ALL {RULE2}\nUNION ALL {RULE3}\n"
            + f"UNION ALL SELECT {report_cols(4)} FROM e4)\nSELECT * FROM rep")
    if day and until:
        body += f" WHERE report_dt BETWEEN TIMESTAMP '{day} 00:00:00' AND TIMESTAMP '{until} 00:00:00'"
    elif day:
        body += f" WHERE report_dt = TIMESTAMP '{day} 00:00:00'"
    return body


def _money(cols: str) -> str:
    return cols.replace("amount,", "CAST(amount AS DOUBLE) AS amount,")


TX_COLS = "transaction_id, transaction_date, amount, card_num, oper_type, oper_result, terminal"

MANIFEST = """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events),
m AS (
  SELECT 'transactions_' || strftime(d, '%d%m%Y') || '.txt' AS file_name, 'transactions' AS kind,
         CAST(d AS TIMESTAMP) AS file_date, 'txt' AS ext FROM days
  UNION ALL
  SELECT 'passport_blacklist_' || strftime(d, '%d%m%Y') || '.xlsx', 'passport_blacklist',
         CAST(d AS TIMESTAMP), 'xlsx' FROM days
  UNION ALL
  SELECT 'terminals_' || strftime(d, '%d%m%Y') || '.xlsx', 'terminals', CAST(d AS TIMESTAMP), 'xlsx'
  FROM days)"""


DUPLICATES = f"""WITH {TX},
b AS (SELECT *, 'transactions_' || strftime(transaction_date, '%d%m%Y') || '.txt' AS file_name FROM tx),
batch AS (SELECT *, 1 + CAST(oper_type = 'purchase' AS INTEGER) AS n FROM b)
SELECT file_name,
  CASE WHEN n > 1 THEN 'transaction_id repeated in the batch' ELSE 'transaction_id stored with other values' END AS reason,
  concat_ws(';', transaction_id, strftime(transaction_date, '%Y-%m-%d %H:%M:%S'),
            replace(CAST(amount AS VARCHAR), '.', ','), card_num, oper_type, oper_result, terminal) AS raw
FROM batch WHERE n > 1 OR (oper_type = 'error' AND terminal <> 'T999'
  AND CAST(transaction_date AS DATE) <= DATE '2024-01-15')"""


def queries() -> dict[str, str]:
    run2 = "WITH " + clients_history(1) + ",\n" + clients_snapshot(2)
    return {
        "txn_normalize": f"WITH {RAW} SELECT {_money(TX_COLS)} FROM checked WHERE reason IS NULL",
        "txn_rejects": f"WITH {RAW} SELECT file_name, reason, raw_line AS raw FROM checked WHERE reason IS NOT NULL",
        "txn_dedupe": f"""WITH {TX},
batch AS (SELECT * FROM tx UNION ALL SELECT * FROM tx WHERE oper_type = 'purchase')
SELECT DISTINCT {_money(TX_COLS)} FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM tx x WHERE x.transaction_id = b.transaction_id
                  AND CAST(x.transaction_date AS DATE) <= DATE '2024-01-15')""",
        "txn_duplicates": DUPLICATES,
        "txn_csv_scan": f"WITH {RAW} SELECT {_money(TX_COLS)} FROM checked WHERE reason IS NULL",
        "txn_stream": f"WITH {RAW} SELECT {_money(TX_COLS)} FROM checked WHERE reason IS NULL",
        "rejects_stored": f"WITH {RAW} SELECT file_name, reason, raw_line AS raw FROM checked WHERE reason IS NOT NULL",
        "scd2_clients_stored": "WITH " + clients_history(3) + "\n" + hist_select("h3", CLIENT_COLS),
        "blacklist_stored": f"WITH {BLACKLIST} SELECT entry_dt, passport FROM bl",
        "scd2_accounts_second": three_loads(
            "account", {"valid_to": "TIMESTAMP", "client": "VARCHAR", "create_dt": "TIMESTAMP"}, accounts_snapshot),
        "scd2_cards_second": three_loads(
            "card_num", {"account": "VARCHAR", "create_dt": "TIMESTAMP"}, cards_snapshot),
        "scd2_terminals_second": three_loads(
            "terminal_id", {"terminal_type": "VARCHAR", "terminal_city": "VARCHAR", "terminal_address": "VARCHAR"},
            terminals_snapshot, watermark=False),
        "rule4_guessing_burst": rule4("20 minutes", False).replace(TX, burst()),
        "rule4_guessing_strict_burst": rule4("20 minutes", True).replace(TX, burst()),
        "fraud_report_burst": report().replace(TX, burst()),
        "fraud_report_stored": report("7 days", "2024-01-10", "2024-01-20"),
        "file_manifest_oldest": MANIFEST + """
SELECT kind, min(file_date) AS file_date, arg_min(file_name, file_date) AS file_name FROM m GROUP BY kind""",
        "file_manifest_unseen": MANIFEST + " SELECT * FROM m WHERE file_date > TIMESTAMP '2024-01-15 00:00:00'",
        "file_manifest_seen": MANIFEST + " SELECT * FROM m WHERE file_date <= TIMESTAMP '2024-01-15 00:00:00'",
        "extract_since": run2 + f"\nSELECT * FROM cl2 WHERE coalesce(update_dt, create_dt) >= {_ts(RUNS[1])}",
        "live_keys": run2 + "\nSELECT client_id AS id, 'CLIENTS' AS table_name FROM cl2",
        "scd2_changed_keys": run2 + f""",
st AS (SELECT * FROM cl2 WHERE coalesce(update_dt, create_dt) >= {_ts(RUNS[1])})
SELECT s.client_id, {", ".join("s." + a for a in CLIENT_ATTRS)}, coalesce(s.update_dt, s.create_dt) AS effective_from
FROM st s JOIN h1 t ON s.client_id = t.client_id AND t.effective_to = {OPEN} AND t.deleted_flg = 'N'
WHERE {" OR ".join(f"s.{a} IS DISTINCT FROM t.{a}" for a in CLIENT_ATTRS)}""",
        "scd2_deleted_keys": run2 + f"""
{hist_select('h1', CLIENT_COLS)} WHERE effective_to = {OPEN} AND deleted_flg = 'N'
  AND client_id NOT IN (SELECT client_id FROM cl2)""",
        "scd2_deleted_semi": run2 + f"""
{hist_select('h1', CLIENT_COLS)} WHERE effective_to = {OPEN} AND deleted_flg = 'N'
  AND client_id IN (SELECT t.client_id FROM h1 t LEFT JOIN cl2 s ON t.client_id = s.client_id
                    WHERE s.client_id IS NULL AND t.effective_to = {OPEN} AND t.deleted_flg = 'N')""",
        "scd2_first_load": "WITH " + clients_history(1) + "\n" + hist_select("h1", CLIENT_COLS),
        "scd2_second_load": "WITH " + clients_history(2) + "\n" + hist_select("h2", CLIENT_COLS),
        "scd2_clients": "WITH " + clients_history(3) + "\n" + hist_select("h3", CLIENT_COLS),
        "scd2_open_rows": "WITH " + clients_history(3) + "\n" + hist_select("h3", CLIENT_COLS)
                          + f" WHERE effective_to = {OPEN} AND deleted_flg = 'N'",
        "scd2_accounts": f"WITH {ACCS} " + hist_select("acc_h", ["account", "valid_to", "client", "create_dt"]),
        "scd2_cards": f"WITH {CARDS} " + hist_select("cards_h", ["card_num", "account", "create_dt"]),
        "scd2_terminals": f"WITH {TERMS} " + hist_select(
            "term_h", ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]),
        "asof_cards": f"""WITH {TX}, {CARDS}
SELECT tr.transaction_id, tr.card_num, cd.account FROM tx tr
LEFT JOIN cards_h cd ON tr.card_num = cd.card_num AND cd.deleted_flg = 'N'
     AND tr.transaction_date BETWEEN cd.effective_from AND cd.effective_to""",
        "asof_chain": warehouse_ctes(terminals=False) + f""",
e AS ({asof_chain()})
SELECT transaction_id, account, valid_to, client, passport, passport_valid_to, phone, fio FROM e""",
        "asof_chain_stored": warehouse_ctes(terminals=False) + f""",
e AS ({asof_chain()})
SELECT transaction_id, account, valid_to, client, passport, passport_valid_to, phone, fio FROM e""",
        "asof_terminals": f"""WITH {TX}, {TERMS}
SELECT tr.transaction_id, tr.terminal, tm.terminal_city AS city FROM tx tr
LEFT JOIN term_h tm ON tr.terminal = tm.terminal_id AND tm.deleted_flg = 'N'
     AND tr.transaction_date BETWEEN tm.effective_from AND tm.effective_to""",
        "blacklist_first_entry": f"WITH {BLACKLIST} SELECT passport, entry_dt FROM bl_first",
        "client_fio": "WITH " + clients_snapshot(3) + """
SELECT client_id, coalesce(last_name, '') || ' ' || coalesce(first_name, '') || ' ' || coalesce(patronymic, '') AS fio
FROM cl3""",
        "rule1_passport": warehouse_ctes(terminals=False) + f",\ne AS ({asof_chain()})\n{RULE1}",
        "rule2_contract": warehouse_ctes(terminals=False) + f",\ne AS ({asof_chain()})\n{RULE2}",
        "rule3_cities": warehouse_ctes() + f",\ne AS ({asof_chain(terminals=True)})\n{RULE3}",
        "rule4_guessing": rule4("20 minutes", False),
        "rule4_guessing_strict": rule4("20 minutes", True),
        "rule4_guessing_7d": rule4("7 days", False),
        "rule4_guessing_strict_7d": rule4("7 days", True),
        "fraud_report_month": report(),
        "fraud_report_day": report("20 minutes", "2024-01-16"),
        "fraud_report_day_7d": report("7 days", "2024-01-16"),
        "fraud_report_range": report("7 days", "2024-01-10", "2024-01-20"),
    }
