"""The registered queries as plain SQL over the supplied tables, for checking results.

Each answer is written the direct way (joins first, then groups, windows over
whole groups), so that it does not share shortcuts with the DataFrame plans.
"""

from __future__ import annotations

from tallyhouse.plans import registry, warehouse
from tallyhouse.sources.player_columns import COUNTING, RATES
from tallyhouse.sources.views import SUCCESSOR


def _values(rows: list[tuple]) -> str:
    """Rows of fixed values as SQL."""
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


# The analytics schemas as common table expressions, in an order where each may use earlier ones.
_VIEWS = {
    "r_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' WHEN 'P' THEN 'Shipped' END
                   AS order_status,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
        FROM orders""",
    "r_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(floor(l_extendedprice / l_quantity * 100 + 0.5::DOUBLE) / 100 AS DECIMAL(18,2)) AS unit_price,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS line_total, CAST(l_shipdate AS DATE) AS ship_date,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_item_id
        FROM lineitem""",
    "r_customers": """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name, c_name || '@email.com' AS email,
               '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
               CASE WHEN c_acctbal < 2500 THEN 'Bronze' WHEN c_acctbal < 5500 THEN 'Silver'
                    WHEN c_acctbal < 8500 THEN 'Gold' ELSE 'Platinum' END AS customer_tier,
               n_name AS city, r_name AS state,
               (SELECT min(order_date) FROM r_orders AS o WHERE o.customer_id = c_custkey) AS registration_date
        FROM customer
        LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey""",
    "r_categories": """
        SELECT row_number() OVER (ORDER BY p_type) AS category_id, p_type AS category_name,
               'Products of type ' || p_type AS category_description
        FROM (SELECT DISTINCT p_type FROM part)""",
    "r_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, category_id, category_name,
               CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price, CAST(p_size AS BIGINT) AS stock_quantity,
               p_size % 10 <> 0 AS is_active, category_description
        FROM part JOIN r_categories ON p_type = category_name""",
    "r_listed": f"""
        SELECT product_id, product_name, category_name, unit_price, stock_quantity FROM r_products
        UNION ALL
        SELECT product_id + {SUCCESSOR}, product_name, category_name, unit_price, 0 FROM r_products WHERE NOT is_active""",
    "r_spend": """
        SELECT customer_id, count(*) AS order_count, sum(total_amount) AS spent,
               min(order_date) AS first_order, max(order_date) AS last_order
        FROM r_orders WHERE order_status = 'Completed' GROUP BY customer_id""",
    "r_asof": "SELECT max(order_date) AS today FROM r_orders",
    "r_staff": """
        SELECT c_name AS name, c_custkey % 45 + 20 AS age, c_mktsegment AS department,
               CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 10 + 20000 AS DOUBLE) AS salary
        FROM customer""",
    # Trips
    "t_trips": """
        SELECT ts AS pickup_datetime,
               CASE WHEN event_id % 67 <> 0 THEN ts + to_seconds((k * 97 + event_id * 31) % 5400) END
                   AS dropoff_datetime,
               k % 9 AS passenger_count, k / 5.0::DOUBLE AS trip_distance, value AS fare_amount,
               floor(value * (k % 30)) / 100.0::DOUBLE AS tip_amount, event_type AS payment_type,
               CASE WHEN user_id % 50 <> 0 THEN 40 + user_id % 20 / 100.0::DOUBLE END AS pickup_latitude,
               -74 + k % 10 / 100.0::DOUBLE AS pickup_longitude,
               40 + event_id % 15 / 100.0::DOUBLE AS dropoff_latitude,
               -74 + k % 7 / 100.0::DOUBLE AS dropoff_longitude,
               fare_amount + tip_amount AS total_amount
        FROM (SELECT *, event_id * 37 % 100 AS k FROM events)""",
    "t_clean": """
        SELECT * FROM t_trips
        WHERE fare_amount >= 0 AND fare_amount <= 500 AND trip_distance >= 0 AND trip_distance <= 100
          AND passenger_count >= 0 AND passenger_count <= 7 AND total_amount > 0
          AND dropoff_datetime IS NOT NULL AND pickup_datetime IS NOT NULL""",
    "t_features": """
        SELECT *, CAST(pickup_datetime AS DATE) AS pickup_date, hour(pickup_datetime) AS pickup_hour,
               dayofweek(pickup_datetime) + 1 AS pickup_day_of_week, month(pickup_datetime) AS pickup_month,
               year(pickup_datetime) AS pickup_year, dayname(pickup_datetime) AS day_name,
               dayofweek(pickup_datetime) IN (0, 6) AS is_weekend,
               date_diff('second', pickup_datetime, dropoff_datetime) / 60.0::DOUBLE AS trip_duration_minutes,
               trip_distance / nullif(trip_duration_minutes / 60, 0) AS speed_mph,
               CAST(tip_amount AS DOUBLE) / nullif(CAST(fare_amount AS DOUBLE), 0) * 100 AS tip_percentage,
               CAST(total_amount AS DOUBLE) / nullif(trip_distance, 0) AS revenue_per_mile
        FROM t_clean""",
    "t_hourly": """
        SELECT pickup_hour, count(*) AS numtrips, {cents:total_amount} AS total_revenue,
               {money_mean:total_amount} AS avg_fare, {mean:trip_distance} AS avg_distance
        FROM t_features GROUP BY pickup_hour""",
    "t_monthly": """
        SELECT year(o_orderdate) AS pickup_year, month(o_orderdate) AS pickup_month, count(*) AS trips,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue,
               {money_mean:o_totalprice} AS avg_fare
        FROM orders GROUP BY ALL""",
    # Warehouse
    "d_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS DATE) AS full_date, year(d) AS year,
               quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, weekofyear(d) AS week_of_year,
               dayofyear(d) AS day_of_year, day(d) AS day_of_month, isodow(d) - 1 AS day_of_week,
               dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend, false AS is_holiday,
               CASE WHEN month(d) >= 7 THEN year(d) ELSE year(d) - 1 END AS fiscal_year,
               CAST(CASE WHEN month(d) BETWEEN 7 AND 9 THEN 1 WHEN month(d) BETWEEN 10 AND 12 THEN 2
                         WHEN month(d) BETWEEN 1 AND 3 THEN 3 ELSE 4 END AS BIGINT) AS fiscal_quarter
        FROM (SELECT unnest(generate_series(date_trunc('year', min(order_date)),
                  date_trunc('year', max(order_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
              FROM r_orders)""",
    "d_customer": """
        SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id, first_name, last_name, email,
               phone, city, state, customer_tier, registration_date,
               coalesce(registration_date, DATE '1900-01-01') AS valid_from, DATE '9999-12-31' AS valid_to,
               true AS is_current
        FROM r_customers""",
    "d_product": """
        SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name, category_id,
               category_name, category_description, unit_price, is_active
        FROM r_products""",
    "d_status": f"""
        SELECT * REPLACE (CAST(status_key AS BIGINT) AS status_key) FROM (VALUES {_values(warehouse.ORDER_STATUS)})
            AS s(status_key, status_code, status_name, status_description, is_final_state)""",
    "d_payment": f"""
        SELECT CAST(payment_method_key AS BIGINT) AS payment_method_key, payment_method_code, payment_method_name,
               CAST(processing_fee_pct AS DOUBLE) AS processing_fee_pct
        FROM (VALUES {_values(warehouse.PAYMENT_METHODS)})
            AS m(payment_method_key, payment_method_code, payment_method_name, processing_fee_pct)""",
    "d_lines": """
        SELECT o.*, i.* EXCLUDE (order_id), 0.00 AS discount_amount,
               CAST(line_total * 0.08 AS DECIMAL(20,4)) AS tax_amount,
               line_total + CAST(line_total * 0.08 AS DECIMAL(20,4)) AS net_revenue
        FROM r_orders AS o JOIN r_items AS i ON i.order_id = o.order_id
        WHERE order_status = 'Completed'""",
    "d_fact": """
        SELECT CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, customer_key, product_key, status_key,
               order_id % 4 + 1 AS payment_method_key, order_id, order_item_id, quantity, l.unit_price, line_total,
               discount_amount, tax_amount, net_revenue
        FROM d_lines AS l
        LEFT JOIN d_customer USING (customer_id)
        LEFT JOIN d_product USING (product_id)
        LEFT JOIN d_status ON status_name = order_status""",
    # History
    "h_changes": """
        SELECT customer_id + CASE WHEN order_id % 50 = 0 THEN 10000000000 ELSE 0 END AS customer_id,
               CASE WHEN total_amount >= 475000 THEN 'Platinum' WHEN total_amount >= 425000 THEN 'Gold'
                    WHEN total_amount >= 350000 THEN 'Silver' ELSE 'Bronze' END AS new_tier,
               order_date AS effective_date
        FROM r_orders""",
    "h_judged": """
        SELECT *, min(new_tier) OVER w <> max(new_tier) OVER w AS differ
        FROM h_changes WINDOW w AS (PARTITION BY customer_id, effective_date)""",
    "h_usable": """
        SELECT h.customer_id, new_tier, effective_date, customer_tier,
               lag(new_tier, 1, customer_tier) OVER (PARTITION BY h.customer_id ORDER BY effective_date) AS before
        FROM (SELECT DISTINCT customer_id, new_tier, effective_date FROM h_judged WHERE NOT differ) AS h
        JOIN d_customer AS d ON d.customer_id = h.customer_id
        WHERE effective_date > valid_from""",
    "h_accepted": """
        SELECT customer_id, new_tier, effective_date,
               lead(effective_date) OVER (PARTITION BY customer_id ORDER BY effective_date) AS next_date,
               min(effective_date) OVER (PARTITION BY customer_id) AS first_date
        FROM h_usable WHERE new_tier <> before""",
    "h_versions": """
        SELECT customer_key, customer_id, first_name, last_name, customer_tier, valid_from,
               CASE WHEN closed IS NULL THEN valid_to ELSE closed - 1 END AS valid_to, closed IS NULL AS is_current
        FROM d_customer
        LEFT JOIN (SELECT customer_id, min(effective_date) AS closed FROM h_accepted GROUP BY 1) USING (customer_id)
        UNION ALL
        SELECT (SELECT max(customer_key) FROM d_customer)
                   + row_number() OVER (ORDER BY a.customer_id, effective_date), a.customer_id, first_name, last_name,
               new_tier, effective_date, coalesce(next_date - 1, DATE '9999-12-31'), next_date IS NULL
        FROM h_accepted AS a JOIN d_customer AS d ON d.customer_id = a.customer_id""",
    "h_latest": """
        SELECT d.customer_id, customer_tier AS old_tier, coalesce(new_tier, customer_tier) AS new_tier
        FROM d_customer AS d
        LEFT JOIN (SELECT customer_id, new_tier FROM h_usable
                   QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY effective_date DESC) = 1) AS l
               ON l.customer_id = d.customer_id""",
    # Loads batch by batch
    "i_lines": f"""
        SELECT l.*, l_linenumber, order_id + CASE WHEN l_linenumber >= 6 OR customer_id % 10 = 0 THEN {registry.LATE} ELSE 0 END AS arrival
        FROM (SELECT d.*, CAST(split_part(order_item_id, '-', 2) AS BIGINT) AS l_linenumber FROM d_lines AS d) AS l""",
    "i_members": f"""
        SELECT customer_id, CASE WHEN customer_id % 10 <> 0 THEN 1
                                 WHEN customer_id IN (SELECT customer_id FROM i_lines) THEN 2 ELSE 3 END AS batch
        FROM r_customers
        WHERE customer_id % 10 <> 0 OR customer_id % 20 = 0 OR customer_id IN (SELECT customer_id FROM i_lines)""",
    "i_customers": """
        SELECT row_number() OVER (ORDER BY batch, customer_id) AS customer_key, customer_id, batch FROM i_members""",
    # Players
    "p_lines": """
        SELECT l_partkey AS id, CASE WHEN l_partkey % 4 = 1 THEN 'A' ELSE l_returnflag END AS team,
               CAST(l_quantity AS BIGINT) AS q, CAST(l_linenumber AS BIGINT) AS n, l_linestatus
        FROM lineitem""",
    "p_sums": """
        SELECT id, coalesce(team, 'TOT') AS team, count(*) - 1 AS games, count(*) FILTER (WHERE q > 25) AS games_started,
               sum(q) AS mp, sum(q % 7) AS fg2, sum(q % 7 + q % 5) AS fg2a, sum(n % 3) AS fg3,
               sum(n % 3 + n % 2) AS fg3a, sum(q % 4) AS ft, sum(q % 4 + q % 2) AS fta, sum(n) AS orb,
               sum(q % 9) AS drb, sum(q % 11) AS ast, sum(q % 3) AS stl,
               count(*) FILTER (WHERE l_linestatus = 'F') AS blk, sum(n % 4) AS tov, sum(q % 6) AS pf,
               sum(n + q % 9) AS trb, sum(q % 7 + n % 3) AS fg, sum(q % 7 + q % 5 + n % 3 + n % 2) AS fga,
               sum((q % 7) * 2 + (n % 3) * 3 + q % 4) * CASE WHEN id % 67 = 0 THEN 10 ELSE 1 END AS pts,
               count(DISTINCT team) AS teams
        FROM p_lines GROUP BY GROUPING SETS ((id, team), (id))""",
    "p_raw": """
        SELECT CAST(2025 AS BIGINT) AS season_year, 'Player ' || (id - CASE WHEN id % 97 = 0 THEN 1 ELSE 0 END) AS player,
               '/players/' || id || '.html' AS player_url,
               CASE WHEN id % 41 = 0 THEN 'n/a' ELSE CAST(id % 37 + 16 AS VARCHAR) END AS age,
               team AS team_name_abbr, (['PG', 'SG', 'SF', 'PF', 'C'])[id % 5 + 1] AS pos,
               {text:games}, {text:games_started},
               CASE WHEN id % 53 = 0 THEN '' ELSE CAST(mp AS VARCHAR) END AS mp,
               {text:fg}, {text:fga}, {share:fg/fga} AS fg_pct, {text:fg3}, {text:fg3a}, {share:fg3/fg3a} AS fg3_pct,
               {text:fg2}, {text:fg2a}, {share:fg2/fg2a} AS fg2_pct,
               {share:(CAST(s.fg AS DOUBLE) + CAST(s.fg3 AS DOUBLE) * 0.5)/fga} AS efg_pct, {text:ft}, {text:fta},
               CASE WHEN id % 61 = 0 THEN '120' ELSE {share:ft/fta} END AS ft_pct, {text:orb}, {text:drb}, {text:trb},
               {text:ast}, CASE WHEN id % 59 = 0 THEN '-3' ELSE CAST(stl AS VARCHAR) END AS stl, {text:blk},
               {text:tov}, {text:pf}, {text:pts},
               id * 10 + CASE team WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 ELSE 0 END AS source_pos
        FROM p_sums AS s WHERE team <> 'TOT' OR (id % 3 = 0 AND teams > 1)""",
    "p_named": "SELECT * RENAME (games AS g, games_started AS gs, team_name_abbr AS team_id) FROM p_raw",
    "p_single": """
        SELECT * EXCLUDE (has_total, first_pos)
        FROM (SELECT *, bool_or(team_id = 'TOT') OVER (PARTITION BY player) AS has_total,
                     min(source_pos) OVER (PARTITION BY player) AS first_pos
              FROM p_named)
        WHERE CASE WHEN has_total THEN team_id = 'TOT' ELSE source_pos = first_pos END""",
    "p_typed": "SELECT {typed} FROM p_named",
    "p_clean": "SELECT {filled} FROM (SELECT {typed} FROM p_single)",
    "p_final": """
        SELECT *, {per_game:pts,2} AS pts_per_game, {per_game:trb,2} AS trb_per_game, {per_game:ast,2} AS ast_per_game,
               {per_game:mp,1} AS mp_per_game,
               {even:pts / CASE WHEN (fga + fta * 0.44::DOUBLE) * 2 = 0 THEN 1
                         ELSE (fga + fta * 0.44::DOUBLE) * 2 END * 100} AS ts_pct
        FROM p_clean""",
}


def _rounded(expression: str, places: int) -> str:
    """Half away from zero by the decimal text of a double."""
    return f"CAST(round(CAST(CAST(CAST({expression} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {places}) AS DOUBLE)"


def _mean(column: str) -> str:
    return _rounded(f"avg(CAST({column} AS DOUBLE))", 6)


def _money_mean(column: str) -> str:
    return f"{_cents(column)} / count({column})"


def _cents(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def _round2(expression: str) -> str:
    return _rounded(expression, 2)


def _share(ratio: str) -> str:
    made, tried = ratio.rsplit("/", 1)
    made = made if made.startswith("(") else f"CAST(s.{made} AS DOUBLE)"
    quotient = f"{made} / nullif(CAST(s.{tried} AS DOUBLE), 0)"
    return f"coalesce(CAST(CAST(round(CAST({quotient} AS DECIMAL(38,6)), 3) AS DECIMAL(9,3)) AS VARCHAR), '')"


def _even(expression: str, places: int = 1) -> str:
    step = f"{10**places}::DOUBLE"
    return f"round_even(({expression}) * {step}, 0) / {step}"


def _per_game(argument: str) -> str:
    column, places = argument.split(",")
    quotient = f"{column} / CASE WHEN g = 0 THEN 1 ELSE g END"
    return _even(quotient, int(places))


def _typed() -> str:
    number = [*COUNTING, *RATES]
    return "*" + f" REPLACE ({', '.join(f'TRY_CAST({c} AS DOUBLE) AS {c}' for c in number)})"


def _filled() -> str:
    return "*" + f" REPLACE ({', '.join(f'coalesce({c}, 0) AS {c}' for c in COUNTING)})"


def _expand(text: str) -> str:
    """Fill the ``{name:argument}`` abbreviations used above."""
    helpers = {
        "money_mean": _money_mean,
        "mean": _mean,
        "cents": _cents,
        "round2": _round2,
        "text": lambda c: f"CAST(s.{c} AS VARCHAR) AS {c}",
        "share": _share,
        "per_game": _per_game,
        "even": _even,
        "typed": lambda _: _typed(),
        "filled": lambda _: _filled(),
    }
    for name, fill in helpers.items():
        while (start := text.find("{" + name)) >= 0:
            end = text.index("}", start)
            text = text[:start] + fill(text[start + len(name) + 2 : end]) + text[end + 1 :]
    return text


def _sql(body: str) -> str:
    """``body`` with the views it needs, directly or through others, in front of it."""
    needed, text = [], body
    for name in reversed(_VIEWS):
        if name in text:
            needed.append(name)
            text += _VIEWS[name]
    views = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in reversed(needed))
    return _expand(f"WITH {views}\n{body}" if views else body)



_DATED = "* REPLACE ({})".format


def _as(columns: str, kind: str) -> str:
    return ", ".join(f"CAST({c} AS {kind}) AS {c}" for c in columns.split())


_FEATURE_COLUMNS = _DATED(_as("pickup_datetime dropoff_datetime pickup_date", "VARCHAR"))
_VERSION_COLUMNS = (
    "customer_key, customer_id, first_name, last_name, customer_tier, CAST(valid_from AS VARCHAR) AS valid_from, "
    "CAST(valid_to AS VARCHAR) AS valid_to, is_current"
)
_AS_OF_COLUMNS = (
    "customer_id, first_name, last_name, customer_tier, CAST(valid_from AS VARCHAR) AS valid_from, "
    "CAST(valid_to AS VARCHAR) AS valid_to"
)
_FACT_MONEY = _as("unit_price line_total discount_amount tax_amount net_revenue", "DOUBLE")
_SOLD = """SELECT product_id FROM r_items JOIN r_orders USING (order_id)
           WHERE order_status = 'Completed' AND order_date BETWEEN DATE '{}' AND DATE '{}'""".format(*registry.SOLD_PERIOD)
_FIRST = "SELECT * FROM ({}) ORDER BY {} LIMIT {}".format
_LISTING = "product_id, product_name, category_name, CAST(unit_price AS DOUBLE) AS unit_price, stock_quantity"
_SALES = """SELECT product_id, product_name, category_name, sum(quantity) AS units, sum(line_total) AS revenue
            FROM r_items JOIN r_products USING (product_id) GROUP BY ALL"""
_PRODUCT_ROWS = """r_categories AS c JOIN r_products AS p USING (category_id) JOIN r_items AS i USING (product_id)
                   JOIN r_orders AS o USING (order_id) WHERE order_status = 'Completed'"""
_ZONE = "CAST(round({0}_latitude, 2) AS VARCHAR) || ',' || CAST(round({0}_longitude, 2) AS VARCHAR)".format

_BODIES = {
    "scan_csv": "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders",
    "scan_json": "SELECT * REPLACE (CAST(c_nationkey AS BIGINT) AS c_nationkey) FROM customer",
    "scan_json_array": "SELECT * REPLACE (CAST(c_nationkey AS BIGINT) AS c_nationkey) FROM customer",
    "scan_csv_inferred": """
        SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN 'C' ELSE '' END || o_custkey AS o_custkey, o_orderstatus,
               CASE o_orderkey % 3 WHEN 0 THEN floor(o_totalprice) WHEN 1 THEN o_totalprice END AS o_totalprice,
               CAST(CASE WHEN o_orderkey % 3 = 1 THEN o_orderdate ELSE date_trunc('day', o_orderdate) END AS VARCHAR) AS o_orderdate,
               o_orderpriority
        FROM orders""",
    "schema_drift": """
        SELECT * FROM (VALUES ('o_custkey', 'long', 'text'), ('o_custkey', 'text', 'text'), ('o_orderdate', 'date', 'timestamp'),
                              ('o_orderdate', 'timestamp', 'timestamp'), ('o_totalprice', 'double', 'double'),
                              ('o_totalprice', 'long', 'double'), ('o_totalprice', 'nothing', 'double')) AS t(column_name, type, common_type)
        WHERE EXISTS (FROM orders)""",
    "scan_parquet": "SELECT * REPLACE (CAST(ts AS VARCHAR) AS ts) FROM events",
    "inline_rows": """
        SELECT department, CAST(floor AS BIGINT) AS floor, CAST(budget AS DOUBLE) AS budget, count(*) AS employee_count
        FROM r_staff JOIN (VALUES ('AUTOMOBILE', 1, 100.0), ('BUILDING', 2, 200.0), ('FURNITURE', 3, 300.0),
                                  ('HOUSEHOLD', 4, 400.0), ('MACHINERY', 5, 500.0)) AS d(department, floor, budget)
             USING (department)
        GROUP BY ALL""",
    "explicit_schema": "SELECT name, age, CAST(CAST(salary AS FLOAT) AS DOUBLE) AS salary FROM r_staff",
    "html_stats": """
        SELECT source_pos // 500 AS page_id, row_number() OVER (PARTITION BY source_pos // 500 ORDER BY source_pos) AS row_no,
               * EXCLUDE (source_pos) REPLACE ('https://stats.example.com' || player_url AS player_url),
               CAST(NULL AS VARCHAR) AS error
        FROM p_raw""",
    "convert_formats": """
        SELECT format, count(*) AS row_count, CAST(6 AS BIGINT) AS column_count, CAST(0 AS BIGINT) AS missing_rows,
               CAST(0 AS BIGINT) AS extra_rows
        FROM orders, (VALUES ('csv'), ('json'), ('parquet')) AS f(format) GROUP BY format""",
    "write_modes": """
        SELECT step, times * (SELECT count(*) FROM customer) AS row_count
        FROM (VALUES ('create', 1), ('create again refused', 1), ('append', 2), ('replace', 1), ('load once', 1))
             AS s(step, times)""",
    "preview": """
        SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date, CAST(total_amount AS DOUBLE) AS total_amount)
        FROM r_orders ORDER BY order_id LIMIT 10""",
    "project": """
        SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date,
               CAST(total_amount AS DOUBLE) AS total_amount
        FROM r_orders WHERE order_status = 'Completed'""",
    "computed_columns": """
        SELECT * REPLACE (CAST(salary AS DOUBLE) AS salary), salary * 0.10::DOUBLE AS bonus FROM r_staff""",
    "filter_basic": "SELECT * REPLACE (CAST(salary AS DOUBLE) AS salary) FROM r_staff WHERE age > 30 AND salary > 80000",
    "filter_like": """
        SELECT * REPLACE (CAST(salary AS DOUBLE) AS salary) FROM r_staff WHERE name NOT LIKE 'Customer#_______1%'""",
    "salary_level": """
        SELECT name, department, CAST(salary AS DOUBLE) AS salary,
               CASE WHEN salary > 90000 THEN 'Senior' WHEN salary > 75000 THEN 'Mid' ELSE 'Junior' END AS level
        FROM r_staff WHERE age > 28""",
    "department_stats": """
        SELECT department, count(*) AS employee_count, {money_mean:salary} AS avg_salary,
               CAST(max(salary) AS DOUBLE) AS max_salary
        FROM r_staff GROUP BY department""",
    "point_lookup": "SELECT * EXCLUDE (registration_date) FROM r_customers WHERE email = 'Customer#000000042@email.com'",
    "lower_lookup": """
        SELECT * EXCLUDE (registration_date) FROM r_customers WHERE lower(email) = 'customer#000000042@email.com'""",
    "city_orders": """
        SELECT first_name, last_name, order_id, CAST(total_amount AS DOUBLE) AS total_amount
        FROM r_customers JOIN r_orders USING (customer_id) WHERE city = 'NATION_7'""",
    "distinct_customers": "SELECT DISTINCT customer_id FROM r_orders",
    "top_customers": """
        SELECT customer_id, first_name || ' ' || last_name AS customer_name, customer_tier,
               CAST(sum(total_amount) AS DOUBLE) AS total_spent,
               row_number() OVER (ORDER BY sum(total_amount) DESC, customer_id) AS spending_rank
        FROM r_customers JOIN r_orders USING (customer_id) WHERE order_status = 'Completed'
        GROUP BY customer_id, first_name, last_name, customer_tier
        ORDER BY sum(total_amount) DESC, customer_id LIMIT 10""",
    "running_total": """
        SELECT CAST(order_date AS VARCHAR) AS order_date, count(*) AS orders_count,
               CAST(sum(total_amount) AS DOUBLE) AS daily_revenue,
               CAST(sum(sum(total_amount)) OVER (ORDER BY order_date) AS DOUBLE) AS running_total
        FROM r_orders WHERE order_status = 'Completed' GROUP BY order_date
        ORDER BY order_date""",
    "line_running_revenue": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_item_id,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date, CAST(price AS DOUBLE) AS revenue,
               CAST(sum(price) OVER (ORDER BY CAST(l_shipdate AS DATE)) AS DOUBLE) AS running_through_day,
               CAST(sum(price) OVER (line ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_through_line,
               CAST(lag(price) OVER line AS DOUBLE) AS previous_revenue,
               {round2:(CAST(price AS DOUBLE) - lag(price) OVER line) / lag(price) OVER line * 100} AS change_percentage
        FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem)
        WINDOW line AS (ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_linenumber, l_partkey, l_suppkey, price)""",
    "customer_spend_rank": """
        SELECT c.customer_id, CAST(coalesce(spent, 0) AS DOUBLE) AS spent,
               row_number() OVER (ORDER BY coalesce(spent, 0) DESC, c.customer_id) AS place,
               rank() OVER (ORDER BY coalesce(spent, 0) DESC) AS spend_rank,
               dense_rank() OVER (ORDER BY coalesce(spent, 0) DESC) AS spend_dense_rank,
               percent_rank() OVER (ORDER BY coalesce(spent, 0) DESC) AS spend_percentile
        FROM r_customers AS c LEFT JOIN r_spend AS s ON s.customer_id = c.customer_id""",
    "line_price_rank": """
        SELECT order_item_id, CAST(unit_price AS DOUBLE) AS unit_price, rank() OVER by_price AS price_rank,
               percent_rank() OVER by_price AS price_percentile, cume_dist() OVER by_price AS price_share
        FROM r_items WINDOW by_price AS (ORDER BY unit_price DESC)""",
    "product_vs_category": f"""
        SELECT product_id, product_name, category_name, CAST(units AS BIGINT) AS units_sold,
               {{round2:category_avg}} AS category_avg_sales, {{round2:units - category_avg}} AS vs_category_avg
        FROM (SELECT *, CAST(sum(units) OVER w AS DOUBLE) / count(*) OVER w AS category_avg
              FROM ({_SALES}) WINDOW w AS (PARTITION BY category_name))
        ORDER BY category_name, units_sold DESC, product_id""",
    "monthly_growth": """
        SELECT month, order_count, CAST(revenue AS DOUBLE) AS monthly_revenue,
               CAST(previous AS DOUBLE) AS prev_month_revenue,
               {round2:(CAST(revenue AS DOUBLE) - CAST(previous AS DOUBLE)) / CAST(previous AS DOUBLE) * 100}
                   AS growth_percentage
        FROM (SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS order_count, sum(total_amount) AS revenue,
                     lag(sum(total_amount)) OVER (ORDER BY strftime(order_date, '%Y-%m')) AS previous
              FROM r_orders WHERE order_status = 'Completed' GROUP BY month)
        ORDER BY month""",
    "customer_ltv": """
        SELECT customer_id, first_name || ' ' || last_name AS customer_name, customer_tier,
               CASE WHEN spent >= 1000 THEN 'High Value' WHEN spent >= 500 THEN 'Medium Value' ELSE 'Low Value' END
                   AS value_segment,
               order_count, CAST(spent AS DOUBLE) AS total_spent,
               {round2:CAST(spent AS DOUBLE) / order_count} AS avg_order_value,
               CAST(date_diff('day', first_order, last_order) AS DOUBLE) AS customer_lifespan_days
        FROM r_spend JOIN r_customers USING (customer_id) ORDER BY spent DESC, customer_id LIMIT 20""",
    "customer_ltv_min3": """
        SELECT customer_id, first_name || ' ' || last_name AS customer_name, customer_tier, order_count,
               CAST(spent AS DOUBLE) AS lifetime_value,
               {round2:CAST(spent AS DOUBLE) / order_count} AS avg_order_value,
               CAST(date_diff('day', first_order, last_order) AS DOUBLE) AS days_as_customer
        FROM r_spend JOIN r_customers USING (customer_id) WHERE order_count >= 3
        ORDER BY spent DESC, customer_id LIMIT 15""",
    "pct_of_category": f"""
        SELECT product_id, product_name, s.category_name, CAST(units AS BIGINT) AS units_sold,
               CAST(revenue AS DOUBLE) AS product_revenue, CAST(category_total AS DOUBLE) AS category_revenue,
               {{round2:CAST(revenue AS DOUBLE) / CAST(category_total AS DOUBLE) * 100}} AS pct_of_category
        FROM ({_SALES}) AS s
        JOIN (SELECT category_name, sum(line_total) AS category_total
              FROM r_items JOIN r_products USING (product_id) GROUP BY category_name) USING (category_name)
        ORDER BY category_name, product_revenue DESC, product_id""",
    "tier_category_sales": """
        SELECT customer_tier, category_name, count(DISTINCT order_id) AS order_count,
               CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(line_total) AS DOUBLE) AS total_revenue,
               {round2:CAST(sum(line_total) AS DOUBLE) / count(*)} AS avg_line_value
        FROM r_customers JOIN r_orders USING (customer_id) JOIN r_items USING (order_id)
             JOIN r_products USING (product_id)
        WHERE order_status = 'Completed' GROUP BY ALL
        ORDER BY customer_tier, total_revenue DESC, category_name""",
    "cohort_analysis": """
        SELECT strftime(registration_date, '%Y-%m') AS cohort_month,
               count(DISTINCT c.customer_id) AS customers_in_cohort, count(DISTINCT order_id) AS total_orders,
               {round2:CAST(sum(total_amount) AS DOUBLE) / nullif(count(order_id), 0)} AS avg_order_value,
               CAST(sum(total_amount) AS DOUBLE) AS cohort_revenue
        FROM r_customers AS c
        LEFT JOIN r_orders AS o ON o.customer_id = c.customer_id AND order_status = 'Completed'
        GROUP BY cohort_month
        ORDER BY cohort_month""",
    "above_average": """
        SELECT customer_id, first_name || ' ' || last_name AS customer_name, CAST(spent AS DOUBLE) AS total_spent,
               {round2:average} AS avg_customer_spend
        FROM r_spend JOIN r_customers USING (customer_id),
             (SELECT CAST(sum(spent) AS DOUBLE) / count(*) AS average FROM r_spend)
        WHERE CAST(spent AS DOUBLE) > average
        ORDER BY total_spent DESC, customer_id""",
    "never_ordered": f"""
        SELECT {_LISTING} FROM r_listed WHERE product_id NOT IN (SELECT product_id FROM r_items)
        ORDER BY category_name, product_name, product_id""",
    "never_ordered_anti": f"""
        SELECT {_LISTING} FROM r_listed AS p
        WHERE NOT EXISTS (SELECT 1 FROM r_items AS s WHERE s.product_id = p.product_id)
        ORDER BY category_name, product_name, product_id""",
    "unsold_in_period": f"""
        SELECT {_LISTING} FROM r_products WHERE product_id NOT IN ({_SOLD})
        ORDER BY category_name, product_name, product_id""",
    "day_of_week_sales": """
        SELECT dayname(order_date) AS day_of_week, count(*) AS order_count,
               CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
               {round2:CAST(sum(total_amount) AS DOUBLE) / count(*)} AS avg_order_value
        FROM r_orders WHERE order_status = 'Completed' GROUP BY day_of_week
        ORDER BY CASE day_of_week WHEN 'Sunday' THEN 0 WHEN 'Monday' THEN 1 WHEN 'Tuesday' THEN 2 WHEN 'Wednesday' THEN 3 WHEN 'Thursday' THEN 4 WHEN 'Friday' THEN 5 ELSE 6 END""",
    "shipping_performance": """
        SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS orders_shipped,
               {round2:CAST(sum(wait) AS DOUBLE) / count(*)} AS avg_days_to_ship,
               CAST(min(wait) AS DOUBLE) AS fastest_ship, CAST(max(wait) AS DOUBLE) AS slowest_ship
        FROM (SELECT order_date, date_diff('day', order_date, min(ship_date)) AS wait
              FROM r_orders JOIN r_items USING (order_id) WHERE ship_date >= order_date
              GROUP BY order_id, order_date)
        GROUP BY month
        ORDER BY month""",
    "category_performance": f"""
        SELECT c.category_name, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
               CAST(sum(line_total) AS DOUBLE) AS revenue,
               {{round2:CAST(sum(i.unit_price) AS DOUBLE) / count(*)}} AS avg_price
        FROM {_PRODUCT_ROWS} GROUP BY c.category_name
        ORDER BY revenue DESC, category_name""",
    "gold_customers": """
        SELECT customer_id, first_name || ' ' || last_name AS customer_name, count(order_id) AS order_count,
               CAST(sum(total_amount) AS DOUBLE) AS total_spent
        FROM r_customers JOIN r_orders USING (customer_id) WHERE customer_tier = 'Gold'
        GROUP BY customer_id, customer_name""",
    "date_range_daily": """
        SELECT CAST(order_date AS VARCHAR) AS order_date, count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS revenue
        FROM r_orders WHERE order_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND order_status = 'Completed'
        GROUP BY order_date
        ORDER BY order_date""",
    "orders_per_customer": """
        SELECT c.customer_id, first_name, count(order_id) AS order_count
        FROM r_customers AS c LEFT JOIN r_orders AS o ON o.customer_id = c.customer_id GROUP BY ALL""",
    "orders_per_customer_corr": """
        SELECT customer_id, first_name,
               (SELECT count(*) FROM r_orders AS o WHERE o.customer_id = c.customer_id) AS order_count
        FROM r_customers AS c""",
    "top3_per_category": f"""
        SELECT category_name, product_id, product_name, CAST(revenue AS DOUBLE) AS revenue, place AS rank_in_category
        FROM (SELECT c.category_name, product_id, product_name, sum(line_total) AS revenue,
                     row_number() OVER (PARTITION BY c.category_name ORDER BY sum(line_total) DESC, product_id) AS place
              FROM {_PRODUCT_ROWS} GROUP BY c.category_name, product_id, product_name)
        WHERE place <= 3""",
    "frequent_customers": """
        SELECT customer_id, first_name || ' ' || last_name AS customer_name, order_count AS total_orders,
               CAST(spent AS DOUBLE) AS lifetime_value
        FROM r_spend JOIN r_customers USING (customer_id) WHERE order_count >= 5
        ORDER BY spent DESC, customer_id LIMIT 20""",
    "recent_monthly": """
        SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS order_count,
               CAST(sum(total_amount) AS DOUBLE) AS monthly_revenue
        FROM r_orders, r_asof WHERE order_status = 'Completed' AND order_date >= today - INTERVAL 6 MONTH
        GROUP BY month
        ORDER BY month""",
    "recent_product_sales": """
        SELECT category_name, product_name, count(DISTINCT customer_id) AS unique_customers,
               CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(line_total) AS DOUBLE) AS revenue
        FROM r_products JOIN r_items USING (product_id) JOIN r_orders USING (order_id), r_asof
        WHERE order_status = 'Completed' AND order_date >= today - INTERVAL 3 MONTH
        GROUP BY category_name, product_name ORDER BY sum(line_total) DESC, category_name, product_name LIMIT 15""",
    "product_sales_top10": """
        SELECT category_name, product_name, count(DISTINCT customer_id) AS unique_customers,
               CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(line_total) AS DOUBLE) AS revenue
        FROM r_products JOIN r_items USING (product_id) JOIN r_orders USING (order_id)
        WHERE order_status = 'Completed'
        GROUP BY category_name, product_name ORDER BY sum(line_total) DESC, category_name, product_name LIMIT 10""",
    "order_totals": """
        SELECT o.order_id, CAST(coalesce(sum(line_total), 0) AS DOUBLE) AS total_amount
        FROM r_orders AS o LEFT JOIN r_items AS i ON i.order_id = o.order_id GROUP BY o.order_id""",
    "global_revenue": "SELECT CAST(sum(unit_price * quantity) AS DOUBLE) AS total_revenue FROM r_items",
    "group_basic": """
        SELECT category_name, count(*) AS products, CAST(sum(i.unit_price * quantity) AS DOUBLE) AS total_revenue,
               CAST(min(i.unit_price) AS DOUBLE) AS min_price, CAST(max(i.unit_price) AS DOUBLE) AS max_price,
               {round2:CAST(sum(i.unit_price) AS DOUBLE) / count(*)} AS avg_price
        FROM r_items AS i JOIN r_products USING (product_id) GROUP BY category_name""",
    "timing_compare": """
        SELECT query, before_avg, after_avg, before_avg / after_avg AS speedup,
               -((after_avg - before_avg) / before_avg * 100) AS improvement_pct
        FROM (SELECT event_type AS query,
                     CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_id % 2 = 0) AS DOUBLE)
                         / count(*) FILTER (WHERE event_id % 2 = 0) AS before_avg,
                     CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_id % 2 = 1) AS DOUBLE)
                         / count(*) FILTER (WHERE event_id % 2 = 1) AS after_avg
              FROM events GROUP BY event_type)""",
    # Trips
    "date_range_profile": """
        SELECT CAST(min(pickup_datetime) AS VARCHAR) AS earliest_trip,
               CAST(max(pickup_datetime) AS VARCHAR) AS latest_trip FROM t_trips""",
    "null_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM t_trips"
        for c in registry.NULLABLE_TRIP_COLUMNS
    ),
    "basic_stats": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS value_count, {_rounded(f"avg(CAST({c} AS DOUBLE))", 4)} AS mean,
                   {_rounded(f"stddev_samp(CAST({c} AS DOUBLE))", 4)} AS stddev, CAST(min({c}) AS DOUBLE) AS min,
                   CAST(max({c}) AS DOUBLE) AS max, {_rounded(f"quantile_cont(CAST({c} AS DOUBLE), 0.25)", 4)} AS q1,
                   {_rounded(f"quantile_cont(CAST({c} AS DOUBLE), 0.5)", 4)} AS median,
                   {_rounded(f"quantile_cont(CAST({c} AS DOUBLE), 0.75)", 4)} AS q3
            FROM t_trips"""
        for c in ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")
    ),
    "trip_cleaning": f"""
        SELECT {_DATED(_as("pickup_datetime dropoff_datetime", "VARCHAR"))}
        FROM t_clean""",
    "trip_cleaning_stats": """
        SELECT original_count, clean_count, original_count - clean_count AS removed,
               CAST(original_count - clean_count AS DOUBLE) / original_count * 100 AS removed_pct
        FROM (SELECT (SELECT count(*) FROM t_trips) AS original_count, (SELECT count(*) FROM t_clean) AS clean_count)""",
    "trip_features": f"SELECT {_FEATURE_COLUMNS} FROM t_features",
    "trip_hourly": "SELECT * FROM t_hourly",
    "peak_hour": "SELECT pickup_hour, numtrips FROM t_hourly ORDER BY numtrips DESC, pickup_hour LIMIT 1",
    "weekend_hourly": """
        SELECT is_weekend, pickup_hour, count(*) AS numtrips, {cents:total_amount} AS total_revenue,
               {money_mean:total_amount} AS avg_fare, {mean:trip_distance} AS avg_distance
        FROM t_features GROUP BY ALL""",
    "weekend_pivot": """
        SELECT pickup_hour, nullif(count(*) FILTER (WHERE NOT is_weekend), 0) AS weekday_trips,
               nullif(count(*) FILTER (WHERE is_weekend), 0) AS weekend_trips
        FROM t_features GROUP BY pickup_hour""",
    "weekend_summary": """
        SELECT is_weekend, count(*) AS total_trips, {cents:total_amount} AS total_revenue,
               {money_mean:total_amount} AS avg_fare, {mean:trip_distance} AS avg_distance,
               {mean:trip_duration_minutes} AS avg_duration, {mean:tip_percentage} AS avg_tip_pct
        FROM t_features GROUP BY is_weekend""",
    "trip_monthly": "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM t_monthly",
    "hour_rank": """
        SELECT *, row_number() OVER w AS revenue_rank,
               percent_rank() OVER w AS revenue_percentile
        FROM t_hourly WINDOW w AS (ORDER BY total_revenue DESC, pickup_hour)""",
    "trip_mom_growth": """
        SELECT pickup_year, pickup_month, trips, CAST(revenue AS DOUBLE) AS revenue, avg_fare,
               CAST(lag(revenue) OVER w AS DOUBLE) AS prev_month_revenue, lag(trips) OVER w AS prev_month_trips,
               CAST(revenue - lag(revenue) OVER w AS DOUBLE) AS revenue_growth,
               (CAST(revenue AS DOUBLE) - CAST(lag(revenue) OVER w AS DOUBLE)) / CAST(lag(revenue) OVER w AS DOUBLE) * 100
                   AS revenue_growth_pct,
               (CAST(trips AS DOUBLE) - lag(trips) OVER w) / lag(trips) OVER w * 100 AS trip_growth_pct
        FROM t_monthly WINDOW w AS (ORDER BY pickup_year, pickup_month)""",
    "cumulative_monthly": """
        SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue), CAST(sum(revenue) OVER w AS DOUBLE) AS cumulative_revenue,
               CAST(sum(trips) OVER w AS BIGINT) AS cumulative_trips
        FROM t_monthly
        WINDOW w AS (ORDER BY pickup_year, pickup_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "top_hours_per_day": """
        SELECT day_name, pickup_day_of_week, pickup_hour, numtrips, total_revenue, place AS rank_within_day
        FROM (SELECT day_name, pickup_day_of_week, pickup_hour, count(*) AS numtrips, {cents:total_amount} AS total_revenue,
                     row_number() OVER (PARTITION BY day_name ORDER BY {cents:total_amount} DESC, pickup_hour) AS place
              FROM t_features GROUP BY day_name, pickup_day_of_week, pickup_hour)
        WHERE place <= 3""",
    "tips_by_payment": """
        SELECT payment_type, count(*) AS numtrips, {cents:tip_amount} AS total_tips,
               {money_mean:tip_amount} AS avg_tip, {mean:tip_percentage} AS avg_tip_pct
        FROM t_features GROUP BY payment_type""",
    "tips_pivot": "SELECT pickup_hour, "
    + ", ".join(
        f"{_rounded(f"avg(tip_percentage) FILTER (WHERE payment_type = '{p}')", 6)} AS {p}"
        for p in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM t_features GROUP BY pickup_hour",
    "by_passenger_count": """
        SELECT passenger_count, count(*) AS num_trips, {cents:total_amount} AS revenue,
               {money_mean:total_amount} AS avg_fare, {mean:trip_distance} AS avg_distance, {mean:tip_percentage} AS avg_tip_pct
        FROM t_features GROUP BY passenger_count""",
    "distance_buckets": """
        SELECT CASE WHEN trip_distance < 1 THEN '< 1 mile' WHEN trip_distance < 3 THEN '1-3 miles'
                    WHEN trip_distance < 5 THEN '3-5 miles' WHEN trip_distance < 10 THEN '5-10 miles'
                    ELSE '10+ miles' END AS distance_bucket,
               count(*) AS trips, {money_mean:total_amount} AS avg_fare, {mean:trip_duration_minutes} AS avg_duration,
               {mean:speed_mph} AS avg_speed
        FROM t_features GROUP BY distance_bucket""",
    "pickup_zones": f"""
        SELECT {_ZONE('pickup')} AS pickup_zone, count(*) AS pickups, {{money_mean:total_amount}} AS avg_fare,
               {{cents:total_amount}} AS total_fare
        FROM t_features GROUP BY pickup_zone ORDER BY pickups DESC, pickup_zone NULLS FIRST LIMIT 10""",
    "dropoff_zones": f"""
        SELECT {_ZONE('dropoff')} AS dropoff_zone, count(*) AS dropoffs, {{cents:total_amount}} AS revenue,
               {{money_mean:total_amount}} AS avg_fare
        FROM t_features GROUP BY dropoff_zone ORDER BY dropoffs DESC, dropoff_zone NULLS FIRST LIMIT 10""",
    "popular_routes": f"""
        SELECT {_ZONE('pickup')} AS pickup_zone, {_ZONE('dropoff')} AS dropoff_zone, count(*) AS trips,
               {{cents:total_amount}} AS total_revenue, {{money_mean:total_amount}} AS avg_fare,
               {{mean:trip_distance}} AS avg_distance
        FROM t_features GROUP BY pickup_zone, dropoff_zone HAVING count(*) > 5
        ORDER BY trips DESC, pickup_zone NULLS FIRST, dropoff_zone NULLS FIRST LIMIT 20""",
    # Warehouse
    "dim_date": "SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM d_date",
    "dim_customer": f"SELECT {_DATED(_as('registration_date valid_from valid_to', 'VARCHAR'))} FROM d_customer",
    "dim_product": "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM d_product",
    "dim_order_status": """
        SELECT d_status.*, (SELECT count(*) FROM r_orders WHERE order_status = status_name) AS orders FROM d_status""",
    "dim_payment_method": """
        SELECT d_payment.*, coalesce(orders, 0) AS orders, CAST(paid AS DOUBLE) AS paid
        FROM d_payment
        LEFT JOIN (SELECT order_id % 4 + 1 AS k, count(*) AS orders, sum(total_amount) AS paid
                   FROM r_orders WHERE order_status = 'Completed' GROUP BY k) ON k = payment_method_key""",
    "fact_sales": f"SELECT {_DATED(_FACT_MONEY)}, CAST(NULL AS DOUBLE) AS gross_profit FROM d_fact",
    "vw_sales_complete": """
        SELECT quantity, CAST(f.unit_price AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total,
               CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(net_revenue AS DOUBLE) AS net_revenue,
               CAST(full_date AS VARCHAR) AS full_date, year, quarter, month, month_name, day_name, is_weekend,
               customer_id, first_name || ' ' || last_name AS customer_name, email, city, state, customer_tier,
               product_id, product_name, category_name, status_name, payment_method_name, order_id, order_item_id
        FROM d_fact AS f JOIN d_date USING (date_key) JOIN d_customer USING (customer_key)
             JOIN d_product USING (product_key) JOIN d_status USING (status_key)
             LEFT JOIN d_payment USING (payment_method_key)""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{shown}' AS table_name, count(*) AS row_count FROM {view}"
        for shown, view in {
            "dim_date": "d_date",
            "dim_customer": "d_customer",
            "dim_product": "d_product",
            "dim_order_status": "d_status",
            "dim_payment_method": "d_payment",
            "fact_sales": "d_fact",
        }.items()
    ),
    "dw_monthly_category": """
        SELECT year, month_name, category_name, CAST(revenue AS DOUBLE) AS revenue, units_sold, unique_customers
        FROM (SELECT year, month, month_name, category_name, sum(net_revenue) AS revenue,
                     CAST(sum(quantity) AS BIGINT) AS units_sold, count(DISTINCT customer_key) AS unique_customers
              FROM d_fact JOIN d_date USING (date_key) JOIN d_product USING (product_key)
              WHERE full_date >= (SELECT today FROM r_asof) - INTERVAL 6 MONTH
              GROUP BY ALL)
        ORDER BY year, month, revenue DESC, category_name LIMIT 15""",
    "dw_tier_revenue": """
        SELECT customer_tier, count(DISTINCT customer_key) AS customers, count(DISTINCT order_id) AS orders,
               CAST(round(sum(net_revenue), 2) AS DOUBLE) AS total_revenue,
               {round2:CAST(sum(net_revenue) AS DOUBLE) / count(*)} AS avg_transaction,
               CAST(sum(quantity) AS BIGINT) AS total_units
        FROM d_fact JOIN d_customer USING (customer_key) WHERE is_current GROUP BY customer_tier""",
    "dw_weekend": """
        SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, count(*) AS transactions,
               CAST(round(sum(net_revenue), 2) AS DOUBLE) AS revenue,
               {round2:CAST(sum(net_revenue) AS DOUBLE) / count(*)} AS avg_transaction,
               CAST(sum(quantity) AS BIGINT) AS units_sold
        FROM d_fact JOIN d_date USING (date_key) GROUP BY day_type""",
    "dw_top_products": """
        SELECT product_key, product_name, category_name, CAST(sum(quantity) AS BIGINT) AS units_sold,
               CAST(round(sum(net_revenue), 2) AS DOUBLE) AS total_revenue,
               {round2:CAST(sum(f.unit_price) AS DOUBLE) / count(*)} AS avg_price
        FROM d_fact AS f JOIN d_product USING (product_key)
        GROUP BY product_key, product_name, category_name
        ORDER BY round(sum(net_revenue), 2) DESC, product_key LIMIT 10""",
    # History
    "incremental_facts": """
        SELECT CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, customer_key, order_id, order_item_id,
               CAST(arrival AS BIGINT) AS arrival, quantity, CAST(line_total AS DOUBLE) AS line_total,
               CAST(net_revenue AS DOUBLE) AS net_revenue
        FROM i_lines LEFT JOIN i_customers USING (customer_id)""",
    "incremental_customers": """
        SELECT customer_key, i.customer_id,
               CASE WHEN NOT unnamed THEN first_name END AS first_name, CASE WHEN NOT unnamed THEN last_name END AS last_name,
               CASE WHEN NOT unnamed THEN email END AS email, CASE WHEN NOT unnamed THEN customer_tier END AS customer_tier,
               unnamed AS is_inferred
        FROM (SELECT *, customer_id % 20 = 10 AS unnamed FROM i_customers) AS i JOIN r_customers AS c ON c.customer_id = i.customer_id""",
    "load_versions": f"""
        SELECT version, 'dim_customer' AS table_name, (SELECT count(*) FROM i_customers WHERE batch <= version) AS row_count
        FROM (SELECT unnest([1, 2, 3])::BIGINT AS version)
        UNION ALL
        SELECT version, 'fact_sales', (SELECT count(*) FROM i_lines WHERE version > 1 OR arrival < {registry.LATE})
        FROM (SELECT unnest([1, 2, 3])::BIGINT AS version)""",
    "scd2_apply": f"SELECT {_VERSION_COLUMNS} FROM h_versions",
    "scd2_rejects": """
        SELECT h.customer_id, new_tier, CAST(effective_date AS VARCHAR) AS effective_date,
               CASE WHEN differ THEN 'several tiers on one date' ELSE 'not after the current version' END AS reason
        FROM h_judged AS h JOIN d_customer AS d ON d.customer_id = h.customer_id
        WHERE differ OR effective_date <= valid_from""",
    "scd1_apply": "SELECT customer_id, new_tier AS customer_tier FROM h_latest",
    "scd3_apply": """
        SELECT customer_id, new_tier AS current_tier, CASE WHEN old_tier <> new_tier THEN old_tier END AS previous_tier
        FROM h_latest""",
    "scd_show_current": f"SELECT {_VERSION_COLUMNS} FROM h_versions WHERE customer_id IN (1, 2, 3, 4, 5)",
    "scd_point_in_time": f"""
        SELECT {_AS_OF_COLUMNS} FROM h_versions WHERE DATE '{registry.POINT_IN_TIME}' BETWEEN valid_from AND valid_to""",
    "scd_current": f"SELECT {_AS_OF_COLUMNS} FROM h_versions WHERE is_current",
    "fact_asof_customer": """
        SELECT order_id, order_item_id, l.customer_id, CAST(order_date AS VARCHAR) AS order_date,
               CAST(net_revenue AS DOUBLE) AS net_revenue, customer_key, customer_tier,
               CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to
        FROM d_lines AS l JOIN h_versions AS v
             ON v.customer_id = l.customer_id AND order_date BETWEEN valid_from AND valid_to""",
    # Players
    "player_standardize": "SELECT * FROM p_named",
    "duplicate_entities": """
        SELECT * FROM p_named WHERE player IN (SELECT player FROM p_named GROUP BY player HAVING count(*) > 1)""",
    "player_dedupe": "SELECT * FROM p_single",
    "player_types": "SELECT * FROM p_typed",
    "player_fill": "SELECT {filled} FROM p_typed",
    "player_derived": "SELECT * FROM p_final",
    "quality_report": """
        SELECT * FROM (
            SELECT 'negative' AS check_name, column_name, count(*) FILTER (WHERE figure < 0) AS hits
            FROM (UNPIVOT (SELECT COLUMNS(* EXCLUDE (player, player_url, team_id, pos))::DOUBLE FROM p_final)
                  ON COLUMNS(*) INTO NAME column_name VALUE figure) GROUP BY column_name
            UNION ALL
            SELECT 'percentage out of range', column_name, count(*) FILTER (WHERE figure < 0 OR figure > 100)
            FROM (UNPIVOT (SELECT COLUMNS('.*pct.*') FROM p_final)
                  ON COLUMNS(*) INTO NAME column_name VALUE figure) GROUP BY column_name
            UNION ALL
            SELECT 'age out of range', 'age', count(*) FROM p_final WHERE age < 18 OR age > 50
            UNION ALL
            SELECT 'too many points', 'pts_per_game', count(*) FROM p_final WHERE pts_per_game > 50)
        WHERE hits > 0""",
    "top_scorers": """
        SELECT player, team_id, pts_per_game, trb_per_game, ast_per_game, g FROM p_final
        WHERE pts_per_game > 25 ORDER BY pts_per_game DESC, source_pos LIMIT 10""",
    "top_scorers_5": """
        SELECT player, team_id, pts_per_game, trb_per_game, ast_per_game, g FROM p_final
        ORDER BY pts_per_game DESC NULLS LAST, source_pos LIMIT 5""",
    "sql_stored_scorers": """
        SELECT player, team_id, pts_per_game FROM p_final
        WHERE pts_per_game > 25 ORDER BY pts_per_game DESC, source_pos LIMIT 10""",
    "season_runs": """
        SELECT CAST(2025 AS BIGINT) AS season, run, count(*) AS row_count
        FROM p_raw, (VALUES ('20250101_000000'), ('20250102_000000')) AS r(run) GROUP BY run""",
    "sql_monthly_orders": """
        SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS revenue
        FROM r_orders WHERE order_status = 'Completed' GROUP BY month ORDER BY month""",
    "sql_tier_orders": """
        SELECT customer_tier, count(DISTINCT c.customer_id) AS customers, count(o.order_id) AS orders
        FROM r_customers AS c LEFT JOIN r_orders AS o ON o.customer_id = c.customer_id
        GROUP BY customer_tier ORDER BY customer_tier""",
    "player_run_summary": """
        SELECT CAST(2025 AS BIGINT) AS season_year, 'success' AS status, (SELECT count(*) FROM p_raw) AS extracted, count(*) AS transformed,
               CAST(37 AS BIGINT) AS column_count, count(*) AS loaded
        FROM p_single""",
    # Audits
    "audit_unique": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "category_defaults": """
        SELECT category_id, category_name, CASE WHEN category_id % 2 = 0 THEN category_description END AS category_description,
               true AS is_active, CAST(0 AS BIGINT) AS sort_order FROM r_categories""",
    "audit_new_keys": """
        SELECT o_orderkey, count(*) AS row_count FROM orders, (SELECT max(o_orderkey) AS greatest FROM orders)
        WHERE o_orderkey * 100 > 85 * greatest AND o_orderkey * 10 <= 9 * greatest GROUP BY o_orderkey""",
    "audit_new_references": """
        SELECT l_orderkey, count(*) AS row_count FROM lineitem, (SELECT max(o_orderkey) AS greatest FROM orders)
        WHERE l_orderkey * 100 > 85 * greatest
          AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey * 10 <= 9 * greatest) GROUP BY l_orderkey""",
    "audit_orphans": """
        SELECT customer_id, new_tier, CAST(effective_date AS VARCHAR) AS effective_date
        FROM h_changes WHERE customer_id NOT IN (SELECT c_custkey FROM customer)""",
}


def _more() -> dict[str, str]:
    """First rows of ordered answers, and the audits of the whole schema."""
    lists = {
        "monthly_growth_first12": ("monthly_growth", "month", 12),
        "running_total_first30": ("running_total", "order_date", 30),
        "product_vs_category_first20": ("product_vs_category", "category_name, units_sold DESC, product_id", 20),
        "pct_of_category_first20": ("pct_of_category", "category_name, product_revenue DESC, product_id", 20),
        "above_average_first15": ("above_average", "total_spent DESC, customer_id", 15),
    }
    firsts = {name: _FIRST(_BODIES[whole], by, k) for name, (whole, by, k) in lists.items()}
    views = {
        "customers": "r_customers", "orders": "r_orders", "order_items": "r_items", "products": "r_products",
        "categories": "r_categories", "dim_date": "d_date", "dim_customer": "d_customer", "dim_product": "d_product",
        "dim_order_status": "d_status", "dim_payment_method": "d_payment", "fact_sales": "d_fact",
    }
    # The facts' own key is a hash that SQL cannot repeat; it is unique.
    keys = " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{key}' AS key_name, count(*) AS repeated
            FROM (SELECT {key} FROM {views[name]} GROUP BY {key} HAVING count(*) > 1)"""
        if key != "sales_key"
        else f"SELECT '{name}', '{key}', 0"
        for name, key in registry.KEYS.items()
    )
    references = " UNION ALL ".join(
        f"""SELECT '{child}' AS table_name, '{key}' AS key_name, '{parent}' AS parent_name, count(*) AS orphans
            FROM {views[child]} WHERE {key} NOT IN (SELECT {key} FROM {views[parent]})"""
        for child, key, parent in registry.REFERENCES
    )
    required = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count FROM {views[name]}"
        for name, columns in registry.REQUIRED.items()
        for c in columns
    )
    star = {"star_tier_revenue": _BODIES["dw_tier_revenue"], "star_sales_complete": _BODIES["vw_sales_complete"]}
    return firsts | star | {"audit_keys": keys, "audit_references": references, "audit_required": required}


def oracle_sql() -> dict[str, str]:
    """Name → SQL."""
    return {name: _sql(body) for name, body in (_BODIES | _more()).items()}
