"""The registered queries as DuckDB SQL over the same tables, written apart from the Spark code."""

from __future__ import annotations

# Every character Unicode counts as white space at the ends of a text.
_SPACE = " || ".join(
    f"chr({code})"
    for code in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)

_NA = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)

_TEXTS = ["region", "product_category", "product_name", "payment_method", "customer_name"]

_ORDER = "l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount"

_LOAD = (
    "order_id, order_date, customer_name, region, product_category, product_name, quantity, unit_price, "
    "discount, payment_method, total_amount, order_year, order_month"
)


def _raw(blank: bool) -> str:
    def blanked(test: str, value: str, otherwise: str) -> str:
        return f"CASE WHEN {test} THEN {value} ELSE {otherwise} END" if blank else otherwise

    region = """CASE l_linenumber % 3 WHEN 0 THEN '  ' || r_name
                WHEN 1 THEN lower(r_name) || chr(9) || chr(160)
                ELSE array_to_string(list_transform(string_split(lower(r_name), ' '),
                     lambda w: upper(w[1]) || w[2:]), ' ') END"""
    return f"""
    raw AS (
      SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
             CASE WHEN l_orderkey % 41 = 0 THEN 'not_a_date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
             CASE WHEN l_orderkey % 37 = 0 THEN '' WHEN l_orderkey % 53 = 0 THEN NULL
                  ELSE '  ' || c_name || ' ' END AS customer_name,
             {blanked("o_custkey % 47 = 0", "' ' || chr(12288)", region)} AS region,
             {blanked("l_partkey % 43 = 0", "'nan'", "p_type")} AS product_category,
             {blanked("l_suppkey % 27 = 0", "''", "' ' || p_name")} AS product_name,
             CASE WHEN l_partkey % 29 = 0 THEN -l_quantity WHEN l_partkey % 31 = 0 THEN 0.0::DOUBLE
                  ELSE l_quantity END AS quantity,
             CASE WHEN l_suppkey % 19 = 0 THEN -p_retailprice WHEN l_suppkey % 23 = 0 THEN NULL
                  ELSE p_retailprice END AS unit_price,
             CASE WHEN l_partkey % 13 = 0 THEN 1.5::DOUBLE WHEN l_partkey % 17 = 0 THEN -0.1::DOUBLE
                  WHEN l_partkey % 11 = 0 THEN NULL ELSE l_discount END AS discount,
             {blanked("o_custkey % 59 = 0", "NULL", "o_orderpriority")} AS payment_method,
             {_ORDER}
      FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey
      JOIN part ON l_partkey = p_partkey
    )"""


def _normal(column: str) -> str:
    return f"nullif(nullif(trim({column}, {_SPACE}), ''), 'nan')"


def _title(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({text}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def _clean_steps(name: str, source: str = "raw", where: str = "true") -> str:
    """CTEs ``<name>_typed``, ``_present``, ``_first`` and ``<name>`` of the cleaning steps."""
    return f"""
    {name}_typed AS (
      SELECT order_id, try_cast(order_date AS DATE) AS order_date, {_normal("customer_name")} AS customer_name,
             {_title(_normal("region"))} AS region, {_normal("product_category")} AS product_category,
             {_normal("product_name")} AS product_name, quantity, unit_price, discount,
             {_normal("payment_method")} AS payment_method, {_ORDER}
      FROM {source} WHERE {where}
    ),
    {name}_present AS (
      SELECT * FROM {name}_typed
      WHERE order_date IS NOT NULL AND customer_name IS NOT NULL AND unit_price IS NOT NULL
    ),
    {name}_first AS (
      SELECT * FROM {name}_present
      QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {_ORDER}) = 1
    ),
    {name}_clipped AS (
      SELECT * REPLACE (greatest(least(coalesce(discount, 0.0::DOUBLE), 1.0::DOUBLE), 0.0::DOUBLE) AS discount)
      FROM {name}_first WHERE quantity > 0 AND unit_price >= 0
    ),
    {name} AS (
      SELECT *, CAST(round_even(quantity * unit_price * (1.0::DOUBLE - discount) * 100.0::DOUBLE, 0) / 100.0::DOUBLE
                     AS DECIMAL(18,2)) AS total_amount,
             CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month
      FROM {name}_clipped
    )"""


def _stored(name: str, source: str) -> str:
    """CTE of clean rows in the types of the transactions table."""
    return f"""
    {name} AS (
      SELECT order_id, order_date, customer_name, region, product_category, product_name,
             CAST(round(quantity) AS INTEGER) AS quantity, CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
             CAST(discount AS DECIMAL(5,4)) AS discount, payment_method,
             CAST(total_amount AS DECIMAL(12,2)) AS total_amount, order_year, order_month
      FROM {source}
    )"""


def _average(revenue: str, orders: str, digits: int) -> str:
    return (
        f"CAST(round_even(CAST({revenue} AS DOUBLE) / CAST({orders} AS DOUBLE) * 100.0::DOUBLE, 0) "
        f"/ 100.0::DOUBLE AS DECIMAL({digits},2))"
    )


def _summary_of(name: str, source: str) -> str:
    """CTE of the stored monthly summary of some stored rows."""
    return f"""
    {name} AS (
      SELECT region, count(order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
             CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_revenue,
             {_average("sum(total_amount)", "count(order_id)", 12)} AS avg_order_value,
             order_year, order_month
      FROM {source} GROUP BY order_year, order_month, region
    )"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_FIRST = "order_date <= '1998-06-15'"
_SECOND = "order_date >= '1998-06-01'"

_DIRTY = _raw(True)
_CLEAN = _with(_DIRTY, _clean_steps("clean"))
_LOADED = _with(_raw(False), _clean_steps("clean"), _stored("stored", "clean"))
_SUMMARY = _with(_raw(False), _clean_steps("clean"), _stored("stored", "clean"), _summary_of("summary", "stored"))
_TWO = _with(
    _raw(False),
    _clean_steps("one", where=_FIRST),
    _clean_steps("two", where=_SECOND),
    _stored("stored_one", "one"),
    _stored("stored_two", "two"),
    "fresh AS (SELECT * FROM stored_two WHERE order_id NOT IN (SELECT order_id FROM stored_one))",
    "stored AS (SELECT * FROM stored_one UNION ALL SELECT * FROM fresh)",
    _summary_of("summary_one", "stored_one"),
    _summary_of("summary_two", "stored_two"),
    _summary_of("summary", "stored"),
)

_SUM = "CAST(sum({}) AS DECIMAL({},2))"


def _revenue(column: str = "total_amount", digits: int = 28) -> str:
    return _SUM.format(column, digits)


def _log_row(source: str, name: str, where: str, loaded: str) -> str:
    return f"""
    SELECT '{source}' AS source_file, (SELECT count(*) FROM raw WHERE {where}) AS rows_read,
           (SELECT count(*) FROM {name}) AS rows_cleaned,
           (SELECT count(*) FROM raw WHERE {where}) - (SELECT count(*) FROM {name}) AS rows_rejected,
           (SELECT count(*) FROM {loaded}) AS rows_loaded,
           'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message"""


def _months(period: str, revenue: str) -> str:
    return f"""SELECT CAST(order_year AS VARCHAR) || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS {period},
                      {_revenue("total_revenue", 32)} AS {revenue}
               FROM summary GROUP BY order_year, order_month"""


def _stretched() -> str:
    """CTE of clean rows of which some outgrow what the transactions table admits."""
    every = {"order_id": 3, "customer_name": 4, "region": 5, "product_category": 6, "product_name": 7, "payment_method": 8}

    def some(n: int) -> str:
        return f"CAST(quantity AS BIGINT) % {n} = 0"

    texts = [f"CASE WHEN {some(n)} THEN repeat({name}, 60) ELSE {name} END AS {name}" for name, n in every.items()]
    numbers = [
        f"CASE WHEN {some(11)} THEN unit_price * 1000000 ELSE unit_price END AS unit_price",
        f"CASE WHEN {some(13)} THEN CAST(total_amount AS DOUBLE) * 1e9 ELSE CAST(total_amount AS DOUBLE) END AS total_amount",
        f"CASE WHEN {some(17)} THEN quantity * 1e9 ELSE quantity END AS quantity",
    ]
    return f" stretched AS (SELECT * REPLACE ({', '.join([*texts, *numbers])}) FROM clean)\n"


def _violations(source: str) -> str:
    counts = [f"count(*) FILTER (WHERE {name.strip()} IS NULL) AS {name.strip()}_not_null" for name in _LOAD.split(",")]
    lengths = {
        "order_id": 50,
        "customer_name": 150,
        "region": 100,
        "product_category": 100,
        "product_name": 150,
        "payment_method": 50,
    }
    counts += [f"count(*) FILTER (WHERE length({name}) > {n}) AS {name}_length" for name, n in lengths.items()]
    bounds = {
        "quantity": ("2147483648", 0),
        "unit_price": ("100000000", 2),
        "discount": ("10", 4),
        "total_amount": ("10000000000", 2),
    }
    counts += [
        f"count(*) FILTER (WHERE round(abs(CAST({name} AS DOUBLE)), {places}) >= {n}) AS {name}_range"
        for name, (n, places) in bounds.items()
    ]
    return "SELECT " + ", ".join(counts) + f" FROM {source}"


def _frame(name: str, keys: list[str]) -> str:
    every = ["region", "product_category", "product_name", "order_year", "order_month"]
    columns = [key if key in keys else f"CAST(NULL AS {'INTEGER' if key.startswith('order') else 'VARCHAR'}) AS {key}" for key in every]
    return f"""SELECT '{name}' AS frame, {', '.join(columns)}, count(order_id) AS total_orders, sum(quantity) AS total_quantity,
                      {_revenue()} AS total_revenue
               FROM clean WHERE {' AND '.join(f'{key} IS NOT NULL' for key in keys)} GROUP BY {', '.join(keys)}"""


def _reasons() -> str:
    """The names of the broken rules of a stretched row, in rule order."""
    tests = [(f"{name.strip()}_not_null", f"{name.strip()} IS NULL") for name in _LOAD.split(",")]
    lengths = {"order_id": 50, "customer_name": 150, "region": 100, "product_category": 100, "product_name": 150, "payment_method": 50}
    tests += [(f"{name}_length", f"length({name}) > {n}") for name, n in lengths.items()]
    bounds = {"quantity": ("2147483648", 0), "unit_price": ("100000000", 2), "discount": ("10", 4), "total_amount": ("10000000000", 2)}
    tests += [(f"{name}_range", f"round(abs(CAST({name} AS DOUBLE)), {places}) >= {n}") for name, (n, places) in bounds.items()]
    return f"concat_ws(',', {', '.join(f'CASE WHEN {test} THEN {chr(39)}{name}{chr(39)} END' for name, test in tests)})"


_JUDGED = f"judged AS (SELECT *, {_reasons()} AS reasons FROM stretched)"


def _lenient_batches() -> str:
    return _with(
        _raw(False),
        _clean_steps("one", where=_FIRST),
        _clean_steps("two", where=_SECOND),
        _stored("stored_one", "one"),
        _stored("stored_two", "two"),
    ) + """SELECT * REPLACE ('a' || order_id AS order_id) FROM stored_one
           UNION ALL
           SELECT * REPLACE ('A' || order_id || ' ' AS order_id) FROM stored_two
           WHERE order_id NOT IN (SELECT order_id FROM stored_one)"""


def all_oracles() -> dict[str, str]:
    def null_tokens(column: str) -> str:
        return f"CASE WHEN {column} NOT IN ({_NA}) THEN {column} END AS {column}"

    texts = ["order_id", "order_date", "customer_name", "region", "product_category", "product_name", "payment_method"]
    return {
        # sources and sinks
        "read_raw": _with(_DIRTY)
        + f"SELECT {', '.join(null_tokens(t) for t in texts)}, quantity, unit_price, discount FROM raw",
        "read_raw_split": _with(_DIRTY)
        + ", split AS (SELECT * REPLACE ('a \"new' || chr(10) || 'line\", ' || trim(product_name, ' ') AS product_name) FROM raw) "
        + " UNION ALL ".join(
            f"SELECT {', '.join(null_tokens(t) for t in texts)}, quantity, unit_price, discount, '{files}' AS files FROM split"
            for files in ("whole", "torn")
        ),
        "read_mixed_headers": _with(_DIRTY)
        + f"SELECT {', '.join(null_tokens(t) for t in texts)}, quantity, unit_price, discount FROM raw",
        "load_key_index": _TWO + "SELECT * FROM stored",
        "load_atomic": _TWO + "SELECT * FROM stored",
        "summary_delta": _TWO + "SELECT * FROM summary",
        "summary_cancelled": _TWO.rstrip()
        + ", left_over AS (SELECT * FROM stored WHERE NOT (payment_method = '1-URGENT' OR order_year = 1997 AND order_month = 3)),"
        + _summary_of("summary_left", "left_over")
        + " SELECT * FROM summary_left",
        "load_quarantine": _CLEAN.rstrip()
        + ","
        + _stretched().rstrip()
        + f", {_JUDGED}, sound AS (SELECT * FROM judged WHERE reasons = ''),"
        + _stored("stored", "sound")
        + " SELECT * FROM stored",
        "reject_rows": _CLEAN.rstrip()
        + ","
        + _stretched().rstrip()
        + f""", {_JUDGED} SELECT order_id, region, strftime(order_date, '%Y-%m-%d') AS order_date, reasons
             FROM judged WHERE reasons <> ''""",
        "dedup_lenient": _CLEAN
        + f"""SELECT CASE WHEN l_suppkey % 2 = 1 THEN 'é-' || order_id || ' ' ELSE 'E-' || order_id END AS order_id, quantity, unit_price
              FROM clean_present QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {_ORDER}) = 1""",
        "load_lenient_conflict": _lenient_batches(),
        "agg_all": _CLEAN
        + " UNION ALL ".join(
            _frame(name, keys)
            for name, keys in {
                "region": ["region"],
                "category": ["product_category"],
                "product": ["product_name"],
                "month": ["order_year", "order_month"],
                "month_region": ["order_year", "order_month", "region"],
            }.items()
        ),
        "sql_top_products": _LOADED
        + f"""SELECT product_name, CAST(sum(quantity) AS BIGINT) AS units_sold, {_revenue(digits=22)} AS total_revenue
              FROM stored GROUP BY product_name ORDER BY total_revenue DESC, product_name LIMIT 12""",
        "sql_region_share": _LOADED
        + f""", revenues AS (SELECT region, {_revenue(digits=22)} AS revenue FROM stored
                             WHERE order_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' GROUP BY region)
             SELECT region, revenue, CAST(CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE) AS DECIMAL(7,4)) AS share
             FROM revenues""",
        "load_projection": _with(_DIRTY, _clean_steps("clean"), _stored("stored", "clean")) + "SELECT * FROM stored",
        "append_load": _TWO + "SELECT * FROM stored",
        "load_new_orders_only": _TWO + "SELECT * FROM fresh",
        "summary_upsert": _TWO
        + """SELECT * FROM summary_two UNION ALL
             SELECT * FROM summary_one o WHERE NOT EXISTS (
               SELECT 1 FROM summary_two t WHERE t.order_year = o.order_year
               AND t.order_month = o.order_month AND t.region = o.region)""",
        "summary_recompute": _TWO + "SELECT * FROM summary",
        "run_log": _TWO
        + _log_row("first", "one", _FIRST, "one")
        + "\nUNION ALL\n"
        + _log_row("second", "two", _SECOND, "fresh"),
        "param_query": _LOADED
        + f"""SELECT payment_method, count(*) AS orders,
                     CAST(avg(CAST(quantity AS DOUBLE)) AS DECIMAL(12,4)) AS mean_quantity, {_revenue(digits=22)} AS paid
              FROM stored WHERE order_date BETWEEN DATE '1997-03-01' AND DATE '1998-08-31' AND discount < 0.05
              GROUP BY payment_method""",
        "constraint_violations": _CLEAN + "," + _stretched() + _violations("stretched"),
        "summary_constraints": _CLEAN
        + """, totals AS (SELECT order_year, order_month, region, count(order_id) AS total_orders,
                          sum(quantity) AS total_quantity, sum(total_amount) AS total_revenue
                          FROM clean WHERE region IS NOT NULL GROUP BY order_year, order_month, region),
               faulty AS (SELECT * REPLACE (CASE WHEN order_month = 4 THEN NULL WHEN order_month = 6
                                            THEN repeat(region, 60) ELSE region END AS region)
                          FROM (SELECT * FROM totals UNION ALL SELECT * FROM totals WHERE order_month % 5 = 0))
             SELECT count(*) FILTER (WHERE order_year IS NULL) AS order_year_not_null,
                    count(*) FILTER (WHERE order_month IS NULL) AS order_month_not_null,
                    count(*) FILTER (WHERE region IS NULL) AS region_not_null,
                    count(*) FILTER (WHERE total_orders IS NULL) AS total_orders_not_null,
                    count(*) FILTER (WHERE total_quantity IS NULL) AS total_quantity_not_null,
                    count(*) FILTER (WHERE total_revenue IS NULL) AS total_revenue_not_null,
                    count(*) FILTER (WHERE length(region) > 100) AS region_length,
                    (SELECT count(*) FROM (SELECT 1 FROM faulty GROUP BY order_year, order_month, region
                                           HAVING count(*) > 1)) AS key_unique
             FROM faulty""",
        "load_replace": _CLEAN
        + "SELECT payment_method, order_year, count(order_id) AS orders FROM clean GROUP BY payment_method, order_year",
        # cleaning
        "normalize_text": _with(_DIRTY)
        + "SELECT order_id, "
        + ", ".join(
            f"{_title(_normal(t)) if t == 'region' else _normal(t)} AS {t}" for t in _TEXTS
        )
        + " FROM raw",
        "title_case_region": _with(_DIRTY)
        + f"SELECT order_id, region, {_title(f'trim(region, {_SPACE})')} AS region_title FROM raw",
        "parse_dates": _with(_DIRTY)
        + "SELECT order_id, order_date AS date_text, try_cast(order_date AS DATE) AS order_date FROM raw",
        "drop_missing": _CLEAN + "SELECT order_id, order_date, customer_name, unit_price FROM clean_present",
        "dedup_keep_first": _CLEAN
        + "SELECT order_id, quantity, unit_price, discount, product_name FROM clean_first",
        "filter_bad_quantity": _CLEAN + "SELECT order_id, quantity FROM clean_first WHERE quantity > 0",
        "filter_bad_price": _CLEAN
        + "SELECT order_id, quantity, unit_price FROM clean_first WHERE quantity > 0 AND unit_price >= 0",
        "discount_clip": _with(_DIRTY)
        + """SELECT order_id, greatest(least(coalesce(discount, 0.0::DOUBLE), 1.0::DOUBLE), 0.0::DOUBLE) AS discount
             FROM raw""",
        "total_amount": _CLEAN + "SELECT order_id, quantity, unit_price, discount, total_amount FROM clean",
        "date_parts": _CLEAN
        + """SELECT order_id, order_date, strftime(order_date, '%Y-%m-%d') AS date_text, order_year, order_month
             FROM clean""",
        "cleaning_stats": _CLEAN
        + """, n AS (SELECT (SELECT count(*) FROM raw) AS rows_read, (SELECT count(*) FROM clean_present) AS present,
                  (SELECT count(*) FROM clean_first) AS firsts,
                  (SELECT count(*) FROM clean_first WHERE quantity > 0) AS positive,
                  (SELECT count(*) FROM clean) AS rows_cleaned)
             SELECT rows_read, rows_read - present AS rows_dropped_missing_required,
                    present - firsts AS rows_dropped_duplicates, firsts - positive AS rows_dropped_bad_quantity,
                    positive - rows_cleaned AS rows_dropped_bad_price, rows_cleaned,
                    rows_read - rows_cleaned AS rows_rejected FROM n""",
        "clean_sales": _CLEAN + f"SELECT {_LOAD} FROM clean",
        # aggregates
        "agg_by_region": _CLEAN
        + f"""SELECT region, count(order_id) AS total_orders, sum(quantity) AS total_quantity,
                     {_revenue()} AS total_revenue,
                     {_average("sum(total_amount)", "count(order_id)", 22)} AS avg_order_value
              FROM clean WHERE region IS NOT NULL GROUP BY region ORDER BY total_revenue DESC, region""",
        "agg_by_category": _CLEAN
        + f"""SELECT product_category, count(order_id) AS total_orders, sum(quantity) AS units_sold,
                     {_revenue()} AS total_revenue
              FROM clean WHERE product_category IS NOT NULL GROUP BY product_category
              ORDER BY total_revenue DESC, product_category""",
        "top_products": _CLEAN
        + f"""SELECT product_name, sum(quantity) AS units_sold, {_revenue()} AS total_revenue
              FROM clean WHERE product_name IS NOT NULL GROUP BY product_name
              ORDER BY total_revenue DESC, product_name LIMIT 10""",
        "monthly_trend": _CLEAN
        + f"""SELECT strftime(order_date, '%Y-%m') AS period, count(order_id) AS total_orders,
                     {_revenue()} AS total_revenue
              FROM clean GROUP BY period ORDER BY period""",
        "monthly_region_summary": _CLEAN
        + f"""SELECT order_year, order_month, region, count(order_id) AS total_orders,
                     sum(quantity) AS total_quantity, {_revenue()} AS total_revenue,
                     {_average("sum(total_amount)", "count(order_id)", 22)} AS avg_order_value
              FROM clean WHERE region IS NOT NULL GROUP BY order_year, order_month, region
              ORDER BY order_year, order_month, region""",
        # reports
        "report_by_region": _SUMMARY
        + f"""SELECT region, CAST(sum(total_orders) AS BIGINT) AS total_orders,
                     CAST(sum(total_quantity) AS BIGINT) AS total_quantity,
                     {_revenue("total_revenue", 32)} AS total_revenue
              FROM summary GROUP BY region ORDER BY total_revenue DESC, region""",
        "report_by_category": _LOADED
        + f"""SELECT product_category, count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
                     {_revenue(digits=22)} AS total_revenue
              FROM stored GROUP BY product_category ORDER BY total_revenue DESC, product_category""",
        "report_top_products": _LOADED
        + f"""SELECT product_name, CAST(sum(quantity) AS BIGINT) AS units_sold, {_revenue(digits=22)} AS total_revenue
              FROM stored GROUP BY product_name ORDER BY total_revenue DESC, product_name LIMIT 10""",
        "report_monthly_trend": _SUMMARY
        + f"""SELECT CAST(order_year AS VARCHAR) || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS period,
                     {_revenue("total_revenue", 32)} AS total_revenue
              FROM summary GROUP BY order_year, order_month ORDER BY period""",
        "report_headline": _SUMMARY
        + f"""SELECT coalesce({_revenue("total_revenue", 32)}, 0) AS total_revenue,
                     CAST(coalesce(sum(total_orders), 0) AS BIGINT) AS total_orders FROM summary""",
        "series_region": _SUMMARY
        + f"""SELECT region, {_revenue("total_revenue", 32)} AS total_revenue
              FROM summary GROUP BY region ORDER BY total_revenue DESC, region""",
        "series_trend": _SUMMARY
        + f"""SELECT CAST(order_year AS VARCHAR) || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS period,
                     {_revenue("total_revenue", 32)} AS total_revenue
              FROM summary GROUP BY order_year, order_month ORDER BY period""",
        "adhoc_region": _LOADED
        + f"SELECT region, {_revenue(digits=22)} AS revenue FROM stored GROUP BY region ORDER BY revenue DESC, region",
        "adhoc_top_products": _LOADED
        + f"""SELECT product_name, {_revenue(digits=22)} AS revenue, CAST(sum(quantity) AS BIGINT) AS units_sold
              FROM stored GROUP BY product_name ORDER BY revenue DESC, product_name LIMIT 10""",
        "adhoc_monthly_trend": _LOADED
        + f"""SELECT order_year, order_month, {_revenue(digits=22)} AS revenue
              FROM stored GROUP BY order_year, order_month ORDER BY order_year, order_month""",
        "report_labels": _LOADED
        + f"""SELECT product_category AS "Product Category", count(*) AS "Total Orders",
                     CAST(sum(quantity) AS BIGINT) AS "Units Sold", {_revenue(digits=22)} AS "Total Revenue"
              FROM stored GROUP BY product_category""",
        # pipelines
        "pipeline_run": _LOADED + "SELECT * FROM stored",
        "incremental_run": _TWO + "SELECT * FROM summary",
        "incremental_redelivery": _with(
            _raw(False),
            _clean_steps("one", where=_FIRST),
            _clean_steps("every"),
            _stored("stored_one", "one"),
            _stored("stored_every", "every"),
        )
        + """SELECT * FROM stored_one UNION ALL
             SELECT * FROM stored_every WHERE order_id NOT IN (SELECT order_id FROM stored_one)""",
        # report sheets as exported
        "report_sheet_summary": _SUMMARY
        + f"""SELECT coalesce({_revenue("total_revenue", 32)}, 0) AS "Total Revenue",
                     CAST(coalesce(sum(total_orders), 0) AS BIGINT) AS "Total Orders" FROM summary""",
        "report_sheet_by_region": _SUMMARY
        + f"""SELECT region AS "Region", CAST(sum(total_orders) AS BIGINT) AS "Total Orders",
                     CAST(sum(total_quantity) AS BIGINT) AS "Total Quantity",
                     {_revenue("total_revenue", 32)} AS "Total Revenue" FROM summary GROUP BY region""",
        "report_sheet_top_products": _LOADED
        + f"""SELECT product_name AS "Product Name", CAST(sum(quantity) AS BIGINT) AS "Units Sold",
                     {_revenue(digits=22)} AS "Total Revenue"
              FROM stored GROUP BY product_name ORDER BY "Total Revenue" DESC, "Product Name" LIMIT 10""",
        "report_sheet_monthly_trend": _SUMMARY + _months('"Period"', '"Total Revenue"'),
        "report_sheet_chart_revenue_by_region": _SUMMARY
        + f"""SELECT region AS "Region", {_revenue("total_revenue", 32)} AS "Total Revenue"
              FROM summary GROUP BY region""",
        "report_sheet_chart_monthly_revenue": _SUMMARY + _months('"Period"', '"Total Revenue"'),
    }
