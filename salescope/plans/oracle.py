"""The same queries in SQL for an independent engine (DuckDB), over the given tables.

Queries without an entry are iterative fits (k-means, principal components, random forest, regression), which SQL does
not express. Each has a ``_checks`` query beside it, which states what must hold for any right fit over the given tables.
"""

from __future__ import annotations

from salescope.operators.clustering import ROW_COLUMNS
from salescope.operators.spending import QUANTITY_REPORTS
from salescope.plans.registry import FOLD_HOURS, FOLDS, HORIZON, RANGE, REPORT_CATEGORY

_CUSTOMERS = """
customers AS (
    SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS city,
           CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') THEN 'B2B' ELSE 'B2C' END AS customer_type
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
), products AS (
    SELECT p_partkey, p_name || ' Product_' || p_size AS product_name, p_type || ' > ' || p_brand AS category,
           p_retailprice AS price
    FROM part
)"""

_TX = f"""WITH {_CUSTOMERS}, tx AS (
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS transaction_id,
           o_orderdate AS "timestamp", o_custkey AS customer_id, customer_name, city, customer_type, product_name, category, price,
           CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS total_amount
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customers ON o_custkey = customers.customer_id LEFT JOIN products ON l_partkey = p_partkey
), enriched AS (
    SELECT *, split_part(category, ' > ', 1) AS main_category, nullif(split_part(category, ' > ', 2), '') AS sub_category,
           CAST(month("timestamp") AS INTEGER) AS month, CAST(dayofweek("timestamp") + 1 AS INTEGER) AS weekday
    FROM tx
), named AS (
    SELECT *, regexp_replace(product_name, ' Product_\\d+$', '') AS clean_product,
           regexp_replace(category, ' > .*', '') AS clean_category,
           CAST(month("timestamp") AS INTEGER) AS month, dayname("timestamp") AS weekday
    FROM tx
)"""

_EV = f"""WITH {_CUSTOMERS}, ev AS (
    SELECT 'E' || event_id AS transaction_id, ts AS "timestamp", user_id AS customer_id, customer_name, city, customer_type,
           product_name, category, price, CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity,
           value AS total_amount
    FROM events LEFT JOIN customers ON user_id = customers.customer_id
    LEFT JOIN products ON CAST(json_extract_string(props, '$.k') AS BIGINT) = p_partkey
), following AS (
    SELECT *, lead("timestamp") OVER w AS date_next_purchase, lead(total_amount) OVER w AS next_amount,
           lag(total_amount, 4) OVER w AS amount_1, lag(total_amount, 3) OVER w AS amount_2,
           lag(total_amount, 2) OVER w AS amount_3, lag(total_amount, 1) OVER w AS amount_4,
           total_amount AS amount_5, row_number() OVER w AS nth
    FROM ev WINDOW w AS (PARTITION BY customer_id ORDER BY "timestamp", transaction_id)
), hours AS (
    SELECT *, (floor(epoch(date_next_purchase)) - floor(epoch("timestamp"))) / 3600 AS hours_between FROM following
), flagged AS (
    SELECT *, CASE WHEN hours_between <= {HORIZON} THEN 1 ELSE 0 END AS futur_purchase FROM hours
), profiles AS (
    SELECT customer_id, sum(total_amount) AS total_spend, CAST(sum(quantity) AS BIGINT) AS total_quantity,
           count(*) AS nb_transaction, max(futur_purchase) AS futur_purchase, min(customer_type) AS customer_type,
           CASE WHEN max(futur_purchase) = 1 THEN CAST(1.0 AS DOUBLE) ELSE CAST(2.0 AS DOUBLE) END AS class_weight
    FROM flagged GROUP BY customer_id
), sequences AS (
    SELECT * FROM following WHERE nth >= 5
)"""

_ROLLING = f"""{_EV}, days AS (
    SELECT date_trunc('day', min("timestamp")) AS start,
           CAST(floor(epoch(max("timestamp") - INTERVAL {FOLD_HOURS} HOUR - date_trunc('day', min("timestamp"))) / 86400) AS BIGINT) AS days
    FROM ev
), cuts AS (
    SELECT i, start + to_days(CAST(greatest(days // {FOLDS}, 1) * i AS INTEGER)) AS cut
    FROM days, range(1, {FOLDS} + 1) AS t(i) WHERE greatest(days // {FOLDS}, 1) * i <= days
), rolling AS (
    SELECT i, cut, customer_id,
           sum(total_amount) FILTER ("timestamp" < cut) AS total_spend,
           CAST(sum(quantity) FILTER ("timestamp" < cut) AS BIGINT) AS total_quantity,
           count(*) FILTER ("timestamp" < cut) AS nb_transaction,
           CAST(max(CASE WHEN "timestamp" >= cut AND "timestamp" <= cut + INTERVAL {FOLD_HOURS} HOUR THEN 1 ELSE 0 END) AS INTEGER)
               AS futur_purchase,
           min(customer_type) FILTER ("timestamp" < cut) AS customer_type
    FROM ev, cuts GROUP BY ALL HAVING nb_transaction > 0
)"""

_IN_TRAIN = "CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 < 8"
_AMOUNTS = "amount_1, amount_2, amount_3, amount_4, amount_5"
_SEQUENCE = f'customer_id, "timestamp", transaction_id, {_AMOUNTS}'
_PROFILE = """customer_id, round(total_spend, 2) AS total_spend, total_quantity, nb_transaction, futur_purchase,
       customer_type, class_weight"""


def _mean_quantity(groups: tuple[str, ...]) -> str:
    keys = ", ".join(groups)
    per_customer = ", ".join(dict.fromkeys(("customer_id", *groups)))
    return f"""SELECT {keys}, round(avg(quantity_sum), 6) AS mean_quantity
FROM (SELECT {per_customer}, sum(quantity) AS quantity_sum FROM enriched GROUP BY {per_customer})
GROUP BY {keys}"""


def _all_quantity_reports() -> str:
    columns = dict.fromkeys(c for groups in QUANTITY_REPORTS.values() for c in groups)
    reports = []
    for name, groups in QUANTITY_REPORTS.items():
        picked = ", ".join(c if c in groups else f"NULL AS {c}" for c in columns)
        reports.append(f"SELECT '{name}' AS report, {picked}, mean_quantity FROM ({_mean_quantity(groups)})")
    return f"{_TX}\n" + "\nUNION ALL ".join(reports)


def _top_products(measure: str, name: str) -> str:
    return f"""{_TX}
SELECT customer_type, clean_product, {name}, CAST(n_th AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_type ORDER BY {name} DESC, clean_product) AS n_th
    FROM (SELECT customer_type, clean_product, CAST({measure} AS BIGINT) AS {name} FROM named GROUP BY ALL)
) WHERE n_th <= 10"""


def _sales(column: str, table: str = "named") -> str:
    return f"{_TX}\nSELECT {column}, round(sum(total_amount), 2) AS total_sales FROM {table} GROUP BY {column}"


def _labels(column: str) -> str:
    return f"""SELECT '{column}' AS "column", {column} AS label,
       CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS index FROM tx GROUP BY {column}"""


_MONTHS = ", ".join(f'count(*) FILTER (month = {m}) AS "{m}"' for m in range(1, 13))
_SCALED_NAMES = [*(f"amount_{i}" for i in range(1, 6)), "next_amount"]
_RANGES = ", ".join(f"min({n}) AS lo_{n}, max({n}) AS hi_{n}" for n in _SCALED_NAMES)
_SCALED = ", ".join(f"round(({n} - lo_{n}) / (hi_{n} - lo_{n}), 6) AS scaled_{n}" for n in _SCALED_NAMES)
_DEVIATIONS = ", ".join(f"stddev_samp({c}) AS sd_{c}" for c in ROW_COLUMNS)
_STANDARD = ", ".join(f"round({c} / sd_{c}, 6) AS scaled_{c}" for c in ROW_COLUMNS)
_BASKETS = """, terms AS (
    SELECT DISTINCT customer_id, 'Category' AS kind, category AS term FROM tx
    UNION ALL SELECT DISTINCT customer_id, 'Product', product_name FROM tx
), vocabulary AS (
    SELECT CAST(row_number() OVER (ORDER BY kind, count(*) DESC, term) - 1 AS INTEGER) AS feature_id, kind, term,
           count(*) AS customers
    FROM terms GROUP BY kind, term
)"""

ORACLE = {
    "top_spenders": f"""{_TX}
SELECT customer_id, customer_name, customer_type, round(sum(total_amount), 2) AS total_spent FROM tx
GROUP BY customer_id, customer_name, customer_type
ORDER BY sum(total_amount) DESC, customer_id LIMIT 20""",
    **{name: f"{_TX}\n{_mean_quantity(groups)}" for name, groups in QUANTITY_REPORTS.items()},
    "quantity_reports": _all_quantity_reports(),
    "clean_enriched": f"""{_TX}
SELECT DISTINCT transaction_id, "timestamp", customer_id, customer_name, city, customer_type, product_name, category,
       price, quantity, total_amount, main_category, sub_category, month, weekday
FROM (SELECT * FROM enriched UNION ALL SELECT * FROM enriched) WHERE quantity <> 13""",
    "date_parts": f"""{_EV}
SELECT transaction_id, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS date, CAST(year("timestamp") AS INTEGER) AS year,
       CAST(month("timestamp") AS INTEGER) AS month, CAST(dayofweek("timestamp") + 1 AS INTEGER) AS day_of_week,
       CAST(hour("timestamp") AS INTEGER) AS hour_of_day FROM ev""",
    "clock_parts": f"""{_EV}
SELECT transaction_id, CAST(month("timestamp") AS INTEGER) AS month, dayname("timestamp") AS weekday,
       CAST(hour("timestamp") AS INTEGER) AS hour, CAST(dayofweek("timestamp") + 1 AS INTEGER) AS day_of_week FROM ev""",
    "clean_names": f"{_TX}\nSELECT transaction_id, clean_product, clean_category FROM named",
    "b2b_purchases": f"{_TX}\nSELECT * FROM tx WHERE customer_type = 'B2B'",
    "segment_means": f"""{_TX}
SELECT customer_type, round(avg(quantity), 6) AS mean_quantity, round(avg(total_amount), 6) AS mean_amount
FROM tx GROUP BY customer_type""",
    "segment_ratio": f"""{_TX}
SELECT round(avg(quantity) FILTER (customer_type = 'B2B') / avg(quantity) FILTER (customer_type = 'B2C'), 6)
           AS quantity_ratio,
       round(avg(total_amount) FILTER (customer_type = 'B2B') / avg(total_amount) FILTER (customer_type = 'B2C'), 6)
           AS amount_ratio FROM tx""",
    "median_amount": f"{_TX}\nSELECT median(total_amount) AS median_amount FROM tx",
    "top_products_by_count": _top_products("count(*)", "n"),
    "top_products_by_quantity": _top_products("sum(quantity)", "quantity"),
    "sales_by_month": _sales("month"),
    "sales_by_weekday": _sales("weekday"),
    "sales_by_type": _sales("customer_type"),
    "category_month_pivot": f"{_TX}\nSELECT clean_category, {_MONTHS} FROM named GROUP BY clean_category",
    "product_month_in_category": f"""{_TX}
SELECT month, clean_product, count(*) AS n FROM named WHERE clean_category = '{REPORT_CATEGORY}'
GROUP BY month, clean_product""",
    "category_histogram": f"{_TX}\nSELECT clean_category, count(*) AS n FROM named GROUP BY clean_category",
    "product_histogram": f"""{_TX}
SELECT customer_type, clean_product, count(*) AS n FROM named GROUP BY customer_type, clean_product""",
    "distinct_categories": f"{_TX}\nSELECT DISTINCT main_category FROM enriched",
    "distinct_products": f"{_TX}\nSELECT DISTINCT clean_product FROM named",
    "earliest_rows": f"""{_EV}
SELECT *, CAST(month("timestamp") AS INTEGER) AS month, dayname("timestamp") AS weekday,
       regexp_replace(product_name, ' Product_\\d+$', '') AS clean_product,
       regexp_replace(category, ' > .*', '') AS clean_category
FROM ev ORDER BY "timestamp", transaction_id LIMIT 10""",
    "next_purchase": f"""{_EV}
SELECT customer_id, transaction_id, "timestamp", date_next_purchase, round(hours_between, 6) AS hours_between,
       futur_purchase FROM flagged""",
    "customer_profile": f"{_EV}\nSELECT {_PROFILE} FROM profiles",
    "class_balance": f"{_EV}\nSELECT futur_purchase, count(*) AS n FROM profiles GROUP BY futur_purchase",
    "top_saved_profiles": f"""{_EV}
SELECT {_PROFILE} FROM profiles ORDER BY profiles.total_spend DESC, customer_id LIMIT 10""",
    "amount_sequences": f"{_EV}\nSELECT {_SEQUENCE}, total_amount, next_amount FROM sequences",
    "latest_sequences": f"""{_EV}
SELECT {_SEQUENCE}, total_amount FROM sequences ORDER BY "timestamp" DESC, transaction_id DESC LIMIT 10""",
    "systematic_sample": f"""{_EV}
SELECT * EXCLUDE (position) FROM (
    SELECT *, row_number() OVER (ORDER BY "timestamp", transaction_id) - 1 AS position FROM ev
) WHERE position % 40 = 0""",
    "hash_split": f"""{_EV}
SELECT DISTINCT customer_id, CASE WHEN {_IN_TRAIN} THEN 'train' ELSE 'test' END AS split FROM ev""",
    "string_index": f"{_TX}\n"
    + "\nUNION ALL ".join(_labels(c) for c in ("customer_type", "city", "category", "product_name")),
    "standard_scaled": f"""{_TX}, cities AS ({_labels("city")}), types AS ({_labels("customer_type")}), numbered AS (
    SELECT transaction_id, cities.index AS city_index, types.index AS customer_type_index, quantity, total_amount
    FROM tx JOIN cities ON city = cities.label JOIN types ON customer_type = types.label
), deviations AS (SELECT {_DEVIATIONS} FROM numbered)
SELECT transaction_id, {_STANDARD} FROM numbered, deviations""",
    "min_max_scaled": f"""{_EV}, ranges AS (SELECT {_RANGES} FROM sequences WHERE next_amount IS NOT NULL)
SELECT transaction_id, {_SCALED} FROM sequences, ranges""",
    "basket_terms": f"{_TX}{_BASKETS}\nSELECT customer_id, kind, term FROM terms",
    "basket_vocabulary": f"{_TX}{_BASKETS}\nSELECT feature_id, kind, term, customers FROM vocabulary",
    "customer_baskets": f"""{_TX}{_BASKETS}
SELECT customer_id, string_agg(CAST(feature_id AS VARCHAR), ' ' ORDER BY feature_id) AS features
FROM terms JOIN vocabulary USING (kind, term) GROUP BY customer_id""",
    "basket_lists": f"""{_TX}{_BASKETS}
SELECT customer_id, string_agg(term, '|' ORDER BY term) FILTER (kind = 'Category') AS categories,
       string_agg(term, '|' ORDER BY term) FILTER (kind = 'Product') AS products
FROM terms GROUP BY customer_id""",
    "repurchase_test_customers": f"""{_EV}
SELECT customer_id, futur_purchase, class_weight FROM profiles WHERE NOT ({_IN_TRAIN})""",
    "forecast_inputs": f"{_EV}\nSELECT {_SEQUENCE} FROM sequences WHERE next_amount IS NULL",
    "csv_round_trip": f"{_TX}\nSELECT * FROM tx",
    "ranked_spenders": f"""{_TX}
SELECT CAST(row_number() OVER (ORDER BY total_spent DESC, customer_id) - 1 AS INTEGER) AS rank, * FROM (
    SELECT customer_id, customer_name, customer_type, round(sum(total_amount), 2) AS total_spent FROM tx
    GROUP BY customer_id, customer_name, customer_type ORDER BY sum(total_amount) DESC, customer_id LIMIT 20)""",
    "parsed_timestamps": f"""{_EV}
SELECT transaction_id, CASE WHEN quantity % 7 <> 0 THEN "timestamp" END AS parsed FROM ev""",
    "file_labels": f"""{_TX}
SELECT DISTINCT category, replace(category, ' ', '_') AS label FROM tx""",
    "row_cluster_checks": f"{_TX}\nSELECT count(*) AS rows, CAST(0 AS BIGINT) AS misplaced, 5 AS clusters FROM tx",
    "time_cluster_checks": f"{_EV}\nSELECT count(*) AS rows, CAST(0 AS BIGINT) AS misplaced, 8 AS clusters FROM ev",
    "customer_cluster_checks": f"""{_TX}
SELECT count(DISTINCT customer_id) AS rows, CAST(0 AS BIGINT) AS misplaced, 4 AS clusters FROM tx""",
    "pca_checks": f"""{_TX}{_BASKETS}
SELECT pc, count(*) AS features, CAST(1 AS DOUBLE) AS length, CAST(0 AS DOUBLE) AS overlap, CAST(0 AS DOUBLE) AS residual
FROM vocabulary, (VALUES ('PC1'), ('PC2'), ('PC3')) AS pcs(pc) GROUP BY pc""",
    "time_silhouette_checks": "SELECT CAST(k AS INTEGER) AS k, TRUE AS in_range FROM range(3, 20) AS t(k)",
    "silhouette_checks": """
SELECT form, CAST(k AS INTEGER) AS k, TRUE AS agrees
FROM (VALUES ('row', 3), ('row', 5), ('row', 12), ('time', 2), ('time', 8), ('time', 19)) AS t(form, k)""",
    "repurchase_checks": f"""{_EV}
SELECT customer_id, futur_purchase, TRUE AS consistent FROM profiles WHERE NOT ({_IN_TRAIN})""",
    "forecast_checks": f"""{_EV}
SELECT CASE WHEN {_IN_TRAIN} THEN 'train' ELSE 'test' END AS split, count(*) AS sequences,
       round(avg(abs((amount_1 + amount_2 + amount_3 + amount_4 + amount_5) / 5 - next_amount)), 6) AS run_mean_error,
       TRUE AS finite
FROM sequences WHERE next_amount IS NOT NULL GROUP BY 1""",
    "next_amount_checks": f"""{_EV}
SELECT customer_id, transaction_id, TRUE AS finite FROM sequences WHERE next_amount IS NULL""",
    "backtest_inputs": f"""{_ROLLING}
SELECT cut, customer_id, round(total_spend, 2) AS total_spend, total_quantity, nb_transaction, futur_purchase, customer_type,
       CASE WHEN futur_purchase = 1 THEN CAST(1.0 AS DOUBLE) ELSE CAST(2.0 AS DOUBLE) END AS class_weight
FROM rolling""",
    "backtest_checks": f"""{_ROLLING}
SELECT cut, count(*) AS customers, count(*) FILTER (futur_purchase = 1) AS positives, TRUE AS known
FROM rolling WHERE cut > (SELECT min(cut) FROM rolling) GROUP BY cut""",
    "unscaled_amounts": f"""{_EV}
SELECT transaction_id, round(next_amount, 6) AS next_amount FROM sequences WHERE next_amount IS NOT NULL""",
    "forecast_fit_checks": f"""{_EV}
SELECT count(*) AS rows, TRUE AS flat FROM sequences WHERE next_amount IS NOT NULL AND {_IN_TRAIN}""",
    "recurrent_checks": f"""{_EV}
SELECT count(*) AS rows, TRUE AS as_good_as_a_constant FROM sequences WHERE next_amount IS NOT NULL AND {_IN_TRAIN}""",
    "loading_checks": f"""{_TX}{_BASKETS}
SELECT feature_id, kind || ': ' || term AS feature, TRUE AS within FROM vocabulary""",
    "extreme_checks": f"""{_TX}{_BASKETS}
SELECT pc, side, CAST(rank AS INTEGER) AS rank, TRUE AS "right"
FROM (VALUES ('PC1'), ('PC2'), ('PC3')) AS pcs(pc), (VALUES ('best'), ('worst')) AS sides(side), range(1, 11) AS ranks(rank)
WHERE rank <= (SELECT count(*) FROM vocabulary)""",
    "first_score_checks": f"""{_EV}
SELECT customer_id, futur_purchase FROM profiles WHERE NOT ({_IN_TRAIN}) ORDER BY customer_id LIMIT 100""",
    "area_checks": f"""{_EV}, test AS (
    SELECT round(total_spend, 0) AS score, futur_purchase FROM profiles WHERE NOT ({_IN_TRAIN})
), pairs AS (
    SELECT avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) AS area
    FROM test AS a JOIN test AS b ON a.futur_purchase = 1 AND b.futur_purchase = 0
)
SELECT (SELECT count(*) FROM test) AS customers, round(CAST(area AS DOUBLE), 9) AS area FROM pairs""",
    "incremental_spenders": f"""{_TX}
SELECT customer_id, customer_name, customer_type, round(sum(total_amount), 2) AS total_spent FROM tx
GROUP BY customer_id, customer_name, customer_type ORDER BY sum(total_amount) DESC, customer_id LIMIT 20""",
    "spenders_in_range": f"""{_TX}
SELECT customer_id, customer_name, customer_type, round(sum(total_amount), 2) AS total_spent FROM tx
WHERE CAST("timestamp" AS DATE) BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'
GROUP BY customer_id, customer_name, customer_type ORDER BY sum(total_amount) DESC, customer_id LIMIT 20""",
    "sketched_median_checks": f"""{_TX}
SELECT customer_type, count(*) AS purchases, count(*) AS rows, TRUE AS within FROM tx
WHERE CAST("timestamp" AS DATE) BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' GROUP BY customer_type""",
    "clean_in_range": f"""{_TX}
SELECT * FROM enriched WHERE "timestamp" >= TIMESTAMP '1996-03-05' AND "timestamp" < TIMESTAMP '1996-07-01'""",
    "profile_lookup": f"""{_EV}
SELECT {_PROFILE} FROM profiles WHERE customer_id IN (3, 14, 15, 92, 141)""",
    "month_product_wide": f"""{_TX}, long AS (
    SELECT month, clean_product, count(*) AS n FROM named WHERE clean_category = '{REPORT_CATEGORY}' GROUP BY ALL
), chosen AS (
    SELECT clean_product, row_number() OVER (ORDER BY sum(n) DESC, clean_product) AS place FROM long GROUP BY clean_product
)
SELECT month, {", ".join(f"CAST(coalesce(sum(n) FILTER (place = {i}), 0) AS BIGINT) AS {name}"
                         for i, name in enumerate(("first", "second", "third"), 1))}
FROM long JOIN chosen USING (clean_product) GROUP BY month""",
    "schema_listing": """
SELECT CAST(position AS INTEGER) AS position, name, type FROM (VALUES
    (0, 'transaction_id', 'string'), (1, 'timestamp', 'timestamp_ntz'), (2, 'customer_id', 'bigint'), (3, 'customer_name', 'string'),
    (4, 'city', 'string'), (5, 'customer_type', 'string'), (6, 'product_name', 'string'), (7, 'category', 'string'),
    (8, 'price', 'double'), (9, 'quantity', 'int'), (10, 'total_amount', 'double')) AS t(position, name, type)""",
    "preview_checks": f"{_EV}\nSELECT least(count(*), 5) AS rows, least(count(*), 5) AS known FROM ev",
    "text_arrays": f"{_EV}\nSELECT transaction_id, customer_id || '|' || quantity AS elements FROM ev",
}
ORACLE["incremental_quantities"] = ORACLE["quantity_reports"]
