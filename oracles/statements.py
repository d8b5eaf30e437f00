"""SQL each query is checked against, written for DuckDB on the supplied tables.

Where the engine scales by being clever (walks, letter groups, block scoring, boundary
states), the SQL here does the plain thing over all rows.
"""

from __future__ import annotations

import json

from shopledger.sources.fixed_values import (
    ADS,
    ALLOWED_CURRENCIES,
    DESIGN_PROMPT,
    ISO_CURRENCY_CODES,
    MASTERCARD_PATTERN,
    RATES_JSON,
    SEARCH_PROMPT,
    VISA_PATTERN,
)
from shopledger.sources.shop_tables import TEST_CARDS

STATEMENTS: dict[str, str] = {}
HOME = ["BGN", "CAD", "CHF", "CZK", "EUR", "GBP", "JPY", "SGD", "TRY", "USD", "XXX", "ZAR"]
CROSS = [*HOME, "EUR"]
SHELVES = ["clothing", "garden", "kitchen", "decor", "books", "hair", "toys", "footwear", "accessories"]


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rows(values) -> str:
    return ", ".join("(" + ", ".join(text(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in values)


def pick(values: list[str], key: str) -> str:
    return "[" + ", ".join(text(v) for v in values) + f"][({key}) % {len(values)} + 1]"


def luhn_sum(number: str) -> str:
    """Luhn by position from the right, without relying on list index bases."""
    n = f"length({number})"
    return (
        f"(list_sum(list_transform(range(1, {n} + 1), lambda p: CASE WHEN p % 2 = 1 "
        f"THEN CAST(substr({number}, CAST({n} - p + 1 AS BIGINT), 1) AS INT) "
        f"WHEN CAST(substr({number}, CAST({n} - p + 1 AS BIGINT), 1) AS INT) > 4 "
        f"THEN CAST(substr({number}, CAST({n} - p + 1 AS BIGINT), 1) AS INT) * 2 - 9 "
        f"ELSE CAST(substr({number}, CAST({n} - p + 1 AS BIGINT), 1) AS INT) * 2 END)) % 10 = 0)"
    )


def hexnum(digest: str, start: int, length: int) -> str:
    return f"CAST('0x' || substr({digest}, {start}, {length}) AS BIGINT)"


def convert(src: str, units: str, nanos: str, source: str, target: str, prefix: str) -> str:
    """A subquery of all columns of src plus <prefix>_units, _nanos and _reason."""
    return f"""(SELECT * EXCLUDE (_rf, _rt, _u1, _n1, _eu, _en, _u2, _n2, _ou, _on),
      CASE WHEN {prefix}_reason IS NULL THEN CAST(_ou AS BIGINT) END AS {prefix}_units,
      CASE WHEN {prefix}_reason IS NULL THEN CAST(_on AS INT) END AS {prefix}_nanos
    FROM (SELECT *, floor(_u2) + floor(_n2 / 1e9) AS _ou, floor(_n2 % 1e9) AS _on
    FROM (SELECT *, _en * _rt + (_u2 % 1) * 1e9 AS _n2
    FROM (SELECT *, _eu * _rt AS _u2
    FROM (SELECT *, floor(_u1) + floor(_n1 / 1e9) AS _eu, floor((_n1 % 1e9) + 0.5) AS _en
    FROM (SELECT *, CAST({nanos} AS DOUBLE) / _rf + (_u1 % 1) * 1e9 AS _n1
    FROM (SELECT *, CAST({units} AS DOUBLE) / _rf AS _u1,
      CASE WHEN _rf IS NULL OR _rt IS NULL THEN 'unsupported_currency'
           WHEN {units} < 0 OR {nanos} < 0 THEN 'negative_amount' END AS {prefix}_reason
    FROM (SELECT s.*, fr.rate AS _rf, tr.rate AS _rt FROM {src} s
      LEFT JOIN rates fr ON fr.code = {source} LEFT JOIN rates tr ON tr.code = {target})))))))) """


def money_text(code: str, units: str, nanos: str) -> str:
    return (
        f"(CASE {code} WHEN 'JPY' THEN '¥' WHEN 'EUR' THEN '€' WHEN 'TRY' THEN '₺' WHEN 'GBP' THEN '£' ELSE '$' END"
        f" || CAST({units} AS VARCHAR) || '.' || lpad(CAST({nanos} // 10000000 AS VARCHAR), 2, '0'))"
    )


def tracking(order: str, address: str, seed: str) -> str:
    h = f"md5('{seed}:' || CAST({order} AS VARCHAR))"
    size = f"octet_length(encode({address}))"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXY"
    letter = lambda at: f"substr('{letters}', CAST({hexnum(h, at, 4)} % 25 + 1 AS BIGINT), 1)"
    return (
        f"({letter(1)} || {letter(5)} || '-' || CAST({size} AS VARCHAR) || lpad(CAST({hexnum(h, 9, 8)} % 1000 AS VARCHAR), 3, '0')"
        f" || '-' || CAST({size} // 2 AS VARCHAR) || lpad(CAST({hexnum(h, 17, 8)} % 10000000 AS VARCHAR), 7, '0'))"
    )


def template(pattern: str, **values: str) -> str:
    out = text(pattern)
    for name, sql in values.items():
        out = out.replace("{" + name + "}", f"' || {sql} || '")
    return f"({out})"


ODD_CARD = "'4' || lpad(CAST(c_custkey AS VARCHAR), 14, '0') || CAST(c_custkey % 10 AS VARCHAR)"
TABLES = f"""
rates AS (SELECT code, CAST(r AS DOUBLE) AS rate FROM (VALUES {rows(json.loads(RATES_JSON).items())}) t(code, r)),
ads AS (SELECT * FROM (VALUES {rows([(*a, i) for i, a in enumerate(ADS)])}) t(category, pos, redirect_url, text, ad_no)),
flat_catalog AS (
  SELECT p_partkey AS id, p_name AS name, p_type || ' ' || p_brand || ' ' || p_name AS description,
    '/static/img/products/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS picture, 'USD' AS currency_code,
    CAST(round(p_retailprice * 100) AS BIGINT) // 100 AS units,
    CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 100 * 10000000 AS INT) AS nanos,
    lower(p_type) || ',' || replace(p_name, ' ', ',') AS categories FROM part),
order_carts AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity
  FROM lineitem),
user_carts AS (
  SELECT o_custkey AS user_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
merged_carts AS (
  SELECT user_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM user_carts GROUP BY ALL),
shoppers AS (
  SELECT c_custkey AS user_id, {pick(ALLOWED_CURRENCIES, 'c_nationkey')} AS user_currency,
    lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
    c_name AS street_address, n_name AS city, r_name AS state, 'Spark' AS country,
    CAST(c_custkey % 100000 AS INT) AS zip_code,
    CASE WHEN c_custkey % 4 = 3 THEN {ODD_CARD} ELSE {pick(TEST_CARDS, 'c_custkey')} END AS card,
    CAST(c_custkey % 1000 AS INT) AS cvv, 2023 + c_custkey % 4 AS exp_year, c_custkey % 12 + 1 AS exp_month
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
requests AS (
  SELECT o_orderkey AS order_id, s.* FROM orders JOIN shoppers s ON o_custkey = s.user_id),
clicks AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id FROM events),
cart_log AS (
  SELECT event_id AS seq, user_id, CASE event_type WHEN 'click' THEN 'add' ELSE 'empty' END AS kind,
    product_id, event_id % 10 + 1 AS quantity FROM clicks WHERE event_type IN ('click', 'purchase')),
request_log AS (
  SELECT event_id AS req_id, ts, user_id AS session,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'POST' ELSE 'GET' END AS method,
    CASE event_type WHEN 'view' THEN '/product/' || product_id WHEN 'click' THEN '/cart'
      WHEN 'purchase' THEN '/cart/checkout' WHEN 'signup' THEN '/' ELSE '/no/such/page/' || product_id END AS path,
    CASE event_type WHEN 'view' THEN '/product/{{id}}' WHEN 'click' THEN '/cart'
      WHEN 'purchase' THEN '/cart/checkout' WHEN 'signup' THEN '/' ELSE 'unmatched' END AS route,
    CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS status,
    CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 0 ELSE 200 END AS raw_status,
    CAST(round(value * 10000) AS BIGINT) AS took_us, length(props) AS bytes FROM clicks),
homes AS (
  SELECT c_custkey AS user_id, c_acctbal, {pick(HOME, 'n_nationkey')} AS code
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
messages AS (SELECT conv_id * 1000 + turn AS query_id, text FROM conversations WHERE role = 'user'),
raw_messages AS (
  SELECT query_id, CASE query_id % 9 WHEN 0 THEN text || '%zz' WHEN 1 THEN '%20%20' WHEN 2 THEN repeat(text, 60)
    WHEN 3 THEN '' ELSE '%20' || text || '+a%5B' || CAST(query_id AS VARCHAR) || '%5D%20' END AS raw,
    -- the texts hold no other escapes, so decoding is spelled out
    CASE query_id % 9 WHEN 0 THEN text || '%zz' WHEN 1 THEN '' WHEN 2 THEN regexp_replace(repeat(text, 60), '^\\s+|\\s+$', '', 'g')
    WHEN 3 THEN '' ELSE text || '+a[' || CAST(query_id AS VARCHAR) || ']' END AS message FROM messages),
valid_messages AS (
  SELECT query_id, message, length(raw) BETWEEN 1 AND 2000 AND message <> '' AS accepted FROM raw_messages),
replies AS (
  SELECT conv_id * 1000 + turn AS query_id, CASE WHEN (conv_id * 1000 + turn) % 3 = 0 THEN text ELSE
    text || ' [' || (conv_id * 1000 + turn) % 97 || '], [no-such-id] and [NO_MATCH], [' || (conv_id * 1000 + turn) % 31
    || '], [' || (conv_id * 1000 + turn) % 97 || ']' || chr(10) || '- one' || chr(10) || '- two' END AS reply
  FROM conversations WHERE role = 'assistant'),
signed AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
    CASE WHEN l_orderkey % 31 = 0 THEN '' WHEN l_linenumber % 2 = 0 THEN 'USD' ELSE 'EUR' END AS code,
    CASE WHEN l_orderkey % 37 = 0 THEN 0 ELSE
      CAST(round(l_extendedprice * 100) AS BIGINT) // 100 * (CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE -1 END) END AS units,
    CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 100 * 10000000 * (CASE WHEN l_orderkey % 6 < 3 THEN 1 ELSE -1 END)
      + (CASE WHEN l_orderkey % 29 = 0 THEN 1000000000 ELSE 0 END) AS INT) AS nanos
  FROM lineitem),
checked AS (
  SELECT *, abs(nanos) <= 999999999 AND (units = 0 OR nanos = 0 OR sign(units) = sign(nanos)) AS is_valid FROM signed),
cross_amounts AS (
  SELECT o_orderkey AS order_id, {pick(CROSS, 'o_orderkey')} AS from_code, {pick(CROSS, 'o_custkey')} AS to_code,
    cents // 100 AS units,
    CAST(cents % 100 * 10000000 + (CASE WHEN cents > 0 THEN o_orderkey % 9999999 ELSE 0 END) AS INT) AS nanos
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) * (CASE WHEN o_orderkey % 41 = 0 THEN -1 ELSE 1 END) AS cents FROM orders)),
ad_requests AS (
  SELECT event_id AS request_id, CASE event_id % 5 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN [a] ELSE [a, b, a] END AS keys
  FROM (SELECT event_id,
    ['clothing','garden','kitchen','decor','books','hair','toys','footwear','accessories'][product_id % 9 + 1] AS a,
    ['clothing','garden','kitchen','decor','books','hair','toys','footwear','accessories'][event_id % 9 + 1] AS b FROM clicks)),
ad_keys AS (
  SELECT request_id, unnest(keys) AS category, unnest(range(len(keys))) AS key_pos FROM ad_requests),
context_ads AS (SELECT k.request_id, k.key_pos, a.* FROM ad_keys k JOIN ads a ON a.category = k.category),
calls AS (
  SELECT user_id AS key, epoch_us(ts) AS at_us, event_id AS call_id, event_type IN ('error', 'view') AS failed,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
"""


def define(name: str, body: str, *more: str) -> None:
    extra = "".join(f",\n{m}" for m in more)
    STATEMENTS[name] = f"WITH RECURSIVE {TABLES}{extra}\n{body}"


# --- sources and sinks -------------------------------------------------------------------
CATALOG = "SELECT id, name, description, picture, currency_code, units, nanos, replace(categories, ',', '|') AS categories FROM flat_catalog"
define("src1_catalog_json", CATALOG.replace("SELECT id", "SELECT CAST(id AS VARCHAR) AS id"))
define("src2_catalog_flat", CATALOG)
define("f1_list_products", CATALOG)
define("src3_catalog_source", "SELECT id, name, currency_code, units, nanos, CAST(len(string_split(categories, ',')) AS INT) AS n_categories FROM flat_catalog")
define("src4_assistant_catalog", "SELECT CAST(id AS VARCHAR) AS id, name, description, replace(categories, ',', '|') AS categories FROM flat_catalog WHERE id % 7 <> 0")
define("src5_fx_rates", "SELECT r.code, rate, count(user_id) AS customers FROM rates r LEFT JOIN homes h ON h.code = r.code GROUP BY ALL")
define("src6_cart_read", "SELECT * FROM merged_carts WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
define(
    "src7_packaging",
    """SELECT p_partkey AS product_id, p_name AS name,
      CASE WHEN p_partkey % 3 <> 0 THEN p_size * 2.0::DOUBLE END AS weight, CASE WHEN p_partkey % 3 <> 0 THEN p_size::DOUBLE END AS width,
      CASE WHEN p_partkey % 3 <> 0 THEN p_size / 2.0::DOUBLE END AS height, CASE WHEN p_partkey % 3 <> 0 THEN p_size + 1.0::DOUBLE END AS depth FROM part""",
)
define(
    "snk1_flatten_catalog",
    """SELECT id, 'o' || name || 's' AS name, description, picture, currency_code AS price_usd_currency_code,
      CAST(units AS INT) AS price_usd_units, CAST(nanos AS BIGINT) AS price_usd_nanos, categories FROM flat_catalog""",
)
define(
    "snk2_cart_upsert",
    """SELECT o_custkey AS user_id, l_partkey AS product_id, CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS quantity
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""",
)
define("snk3_cart_delete", "SELECT * FROM merged_carts WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
define(
    "snk4_record_json",
    """SELECT id, '{"id":' || id || ',"name":"' || name || '","description":"' || description || '","picture":"' || picture
      || '","price_usd":{"currency_code":"USD","units":' || units || ',"nanos":' || nanos || '},"categories":["'
      || replace(categories, ',', '","') || '"]}' AS json FROM flat_catalog""",
)
define(
    "snk5_metrics_text",
    """SELECT 0 AS section, method || route || status AS labels, 2 AS part, 'frontend_http_requests_total{method="' || method || '",route="'
      || route || '",status="' || status || '"} ' || count(*) AS line FROM request_log GROUP BY method, route, status
    UNION ALL SELECT 1, method || route, 2, 'frontend_http_request_duration_seconds_sum{method="' || method || '",route="' || route || '"} '
      || (sum(took_us) // 1000000) || '.' || lpad(CAST(sum(took_us) % 1000000 AS VARCHAR), 6, '0') FROM request_log GROUP BY method, route
    UNION ALL SELECT 1, method || route, 3, 'frontend_http_request_duration_seconds_count{method="' || method || '",route="' || route || '"} '
      || count(*) FROM request_log GROUP BY method, route
    UNION ALL SELECT * FROM (VALUES
      (0, '', 0, '# HELP frontend_http_requests_total Total frontend HTTP requests.'),
      (0, '', 1, '# TYPE frontend_http_requests_total counter'),
      (1, '', 0, '# HELP frontend_http_request_duration_seconds Frontend HTTP request duration.'),
      (1, '', 1, '# TYPE frontend_http_request_duration_seconds summary'))""",
)

# --- projections, filters, lookups -------------------------------------------------------
define(
    "f2_point_lookup",
    """SELECT request_id, a.product_id, p_partkey IS NOT NULL AS found, p_name AS name
    FROM (SELECT event_id AS request_id, product_id * 40 + event_id % 40 AS product_id FROM clicks) a LEFT JOIN part ON p_partkey = a.product_id""",
)
define(
    "f3_search_products",
    """SELECT q.query, id, name FROM (
      SELECT DISTINCT unnest(string_split(p_name, ' ')) AS query FROM part
      UNION SELECT DISTINCT upper(unnest(string_split(p_name, ' '))) FROM part
      UNION SELECT * FROM (VALUES ('%'), ('_'), (''), ('#1'))) q
    JOIN flat_catalog ON contains(lower(name), lower(query)) OR contains(lower(description), lower(query))""",
)
define(
    "j6_substring_join",
    """SELECT query, count(*) AS products, min(id) AS first_id FROM (SELECT DISTINCT p_brand AS query FROM part) q
    JOIN flat_catalog ON contains(lower(name), lower(query)) OR contains(lower(description), lower(query)) GROUP BY query""",
)
define("f4_supported_currencies", "SELECT h.code, count(*) AS customers, bool_or(r.code IS NOT NULL) AS supported FROM homes h LEFT JOIN rates r ON r.code = h.code GROUP BY h.code")
define("f5_currency_allow_list", f"SELECT user_id, code FROM homes WHERE code IN ({', '.join(text(c) for c in ALLOWED_CURRENCIES)})")
define("f6_currency_preference", "SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'USD' ELSE code END AS currency_code FROM homes")
define("f7_cart_product_ids", "SELECT DISTINCT user_id, product_id FROM user_carts")
define(
    "f8_price_list",
    f"""SELECT id, to_code AS currency_code, price_units, price_nanos, {money_text('to_code', 'price_units', 'price_nanos')} AS price_text
    FROM {convert(f"(SELECT id, units, nanos, unnest([{', '.join(text(c) for c in ALLOWED_CURRENCIES)}]) AS to_code FROM flat_catalog)", 'units', 'nanos', "'USD'", 's.to_code', 'price')}""",
)
define("f9_route_label", "SELECT req_id, method, path, route, CAST(status AS VARCHAR) AS status FROM request_log")
define(
    "f10_log_normalisation",
    """SELECT event_id, upper(event_type) AS severity,
      CASE WHEN event_id % 2 = 0 THEN 't' || event_id ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp, props AS message FROM events""",
)

# --- validation --------------------------------------------------------------------------


def failed(field: str, *checks: tuple[str, str]) -> str:
    whens = " ".join(f"WHEN NOT ({ok}) THEN 'Field ''{field}'' is invalid: {tag}' || chr(10)" for tag, ok in checks)
    return f"(CASE {whens} ELSE '' END)"


def errors(*fields: str) -> str:
    joined = " || ".join(fields)
    count = " + ".join(f"CAST({f} <> '' AS INT)" for f in fields)
    return f"{count} AS n_errors, {joined} AS errors"


define(
    "v1_add_to_cart",
    "SELECT event_id, "
    + errors(
        failed("Quantity", ("required", "event_id % 13 <> 0"), ("lte", "event_id % 13 <= 10")),
        failed("ProductID", ("required", "event_id % 7 <> 0")),
    )
    + " FROM events",
)
EMAIL = r"""regexp_matches(email, '^[A-Za-z0-9.!#$%&''*+/=?^_`{|}~-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$')"""
define(
    "v2_place_order",
    "SELECT user_id, "
    + errors(
        failed("Email", ("required", "email <> ''"), ("email", EMAIL)),
        failed("StreetAddress", ("required", "street_address <> ''"), ("max", "length(street_address) <= 512")),
        failed("ZipCode", ("required", "zip_code <> 0")),
        failed("City", ("required", "city <> ''"), ("max", "length(city) <= 128")),
        failed("State", ("required", "state <> ''"), ("max", "length(state) <= 128")),
        failed("CcNumber", ("required", "card <> ''"), ("credit_card", luhn_sum("card"))),
        failed("CcMonth", ("required", "exp_month <> 0"), ("gte", "exp_month >= 1"), ("lte", "exp_month <= 12")),
        failed("CcYear", ("required", "exp_year <> 0")),
        failed("CcCVV", ("required", "cvv <> 0")),
    )
    + """ FROM (SELECT user_id, zip_code, state, card, exp_year, cvv,
      CASE WHEN user_id % 11 = 1 THEN city WHEN user_id % 11 = 2 THEN '' ELSE email END AS email,
      CASE WHEN user_id % 13 = 1 THEN repeat(street_address, 40) ELSE street_address END AS street_address,
      CASE WHEN user_id % 17 = 1 THEN '' ELSE city END AS city,
      CASE WHEN user_id % 19 = 1 THEN 13 WHEN user_id % 19 = 2 THEN 0 ELSE exp_month END AS exp_month FROM shoppers)""",
)
define(
    "v3_currency_code",
    f"""SELECT user_id, code, CASE WHEN code = '' THEN 'required'
      WHEN code NOT IN ({', '.join(text(c) for c in ISO_CURRENCY_CODES)}) THEN 'iso4217' END AS currency_error
    FROM (SELECT user_id, CASE user_id % 5 WHEN 0 THEN lower(code) WHEN 1 THEN '' WHEN 2 THEN 'ABC' ELSE code END AS code FROM homes)""",
)
define(
    "v4_money_validity",
    """SELECT order_id, line_no, product_id, units, nanos, is_valid, units = 0 AND nanos = 0 AS is_zero,
      is_valid AND units * 1000000000::HUGEINT + nanos > 0 AS is_positive, is_valid AND units * 1000000000::HUGEINT + nanos < 0 AS is_negative FROM checked""",
)
define("v5_assistant_request", "SELECT query_id, accepted, message FROM valid_messages")
SCREENED = f"""screened AS (SELECT *, CASE WHEN NOT {luhn_sum('card')} THEN 'invalid_card'
      WHEN NOT regexp_matches(card, '{VISA_PATTERN}') AND NOT regexp_matches(card, '{MASTERCARD_PATTERN}') THEN 'unaccepted_card'
      WHEN 2024 * 12 + 6 > exp_year * 12 + exp_month THEN 'expired_card' END AS card_reason FROM requests)"""
define(
    "v6_payment_screening",
    """SELECT order_id, user_id, CASE WHEN card_reason IS NULL THEN 'accepted' ELSE 'rejected' END AS decision, card_reason AS reason,
      right(card, 4) AS last4, CASE WHEN card_reason IS NULL THEN md5('charge:' || order_id) END AS transaction_id FROM screened""",
    SCREENED,
)
define(
    "v7_identifier",
    """SELECT *, regexp_full_match(name, '[A-Za-z_][A-Za-z0-9_]*') AS is_identifier FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name
      WHEN 1 THEN replace(p_name, ' ', '_') WHEN 2 THEN p_partkey || p_type ELSE p_brand END AS name FROM part)""",
)

# --- joins -------------------------------------------------------------------------------
define(
    "j1_cart_catalog",
    """SELECT order_id, bool_and(p_partkey IS NOT NULL) AS all_found, count(p_partkey) AS found_lines, count(*) AS lines
    FROM order_carts LEFT JOIN part ON p_partkey = product_id + (CASE WHEN order_id % 10 = 0 THEN 1000000000 ELSE 0 END) GROUP BY order_id""",
)
CONVERTED = "converted AS (SELECT * FROM " + convert("cross_amounts", "units", "nanos", "s.from_code", "s.to_code", "out") + ")"
define(
    "j2_money_rates",
    """SELECT from_code, to_code, out_reason, count(*) AS amounts, CAST(sum(out_units) AS BIGINT) AS units, CAST(sum(out_nanos) AS BIGINT) AS nanos
    FROM converted GROUP BY ALL""",
    CONVERTED,
)
define("j3_ids_catalog", "SELECT seq AS request_id, product_id, name, currency_code, units, nanos FROM cart_log JOIN flat_catalog ON id = product_id WHERE kind = 'add'")
define("j4_anti_join", "SELECT DISTINCT user_id, product_id FROM clicks WHERE (user_id, product_id) NOT IN (SELECT user_id, product_id FROM user_carts)")
define("j5_context_ads", "SELECT request_id, CAST(key_pos AS INT) AS key_pos, pos, category, redirect_url, text FROM context_ads")


def words(source: str, key: str, body: str) -> str:
    return f"""SELECT {key}, w FROM (SELECT DISTINCT {key}, unnest(regexp_split_to_array(lower({body}), '[^a-z0-9]+')) AS w FROM {source}) WHERE w <> ''"""


def token_pairs(queries: str, items: str) -> list[str]:
    return [
        f"qw AS ({words(queries, 'query_id', 'text')})",
        f"iw AS ({words(items, 'item_id', 'text')})",
        "pairs AS (SELECT query_id, item_id, count(*) AS score FROM qw JOIN iw USING (w) GROUP BY ALL)",
    ]


def token_top(queries: str, items: str, k: int) -> list[str]:
    return [
        *token_pairs(queries, items),
        """found AS (SELECT query_id, item_id, score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INT) AS rank
          FROM pairs) WHERE rank <= %d)""" % k,
    ]


CORPUS = "(SELECT doc_id AS item_id, text FROM documents)"
BENCH = "(SELECT item_id AS query_id, text FROM benchmark)"
FEATURES = "(SELECT id AS item_id, name || ' ' || description || ' ' || replace(categories, ',', ' ') AS text FROM flat_catalog)"
define("j7_token_overlap_join", "SELECT * FROM found", *token_top(BENCH, CORPUS, 10))
define(
    "j8_cited_ids",
    """SELECT query_id, CAST(cite_pos AS INT) AS cite_pos, cited_id, p_name AS name FROM (
      SELECT query_id, unnest(ids) AS cited_id, unnest(range(len(ids))) AS cite_pos
      FROM (SELECT query_id, regexp_extract_all(reply, '\\[([a-zA-Z0-9-]+)\\]', 1) AS ids FROM replies))
    JOIN part ON CAST(p_partkey AS VARCHAR) = cited_id""",
)
define(
    "j9_optional_enrichment",
    f"""SELECT p.*, a.text AS ad_text FROM (SELECT p_partkey AS product_id, p_name AS name, {pick(SHELVES, 'p_partkey')} AS category,
      CASE WHEN p_partkey % 3 <> 0 THEN p_size * 2.0::DOUBLE END AS weight FROM part) p LEFT JOIN ads a ON a.category = p.category""",
)

# --- aggregations ------------------------------------------------------------------------
define(
    "agg1_money_sum",
    """SELECT order_id, code, CAST(t // 1000000000 AS BIGINT) AS units, CAST(t % 1000000000 AS INT) AS nanos FROM (
      SELECT order_id, code, sum(units * 1000000000::HUGEINT + nanos) AS t FROM checked WHERE is_valid GROUP BY ALL)""",
)
define("agg2_cart_size", "SELECT user_id, CAST(sum(quantity) AS BIGINT) AS cart_size FROM user_carts GROUP BY ALL")
define("agg3_cart_merge", "SELECT * FROM merged_carts")
define("agg4_request_counter", "SELECT method, route, CAST(status AS VARCHAR) AS status, count(*) AS requests FROM request_log GROUP BY ALL")
define("agg5_duration_summary", "SELECT method, route, CAST(sum(took_us) AS BIGINT) AS sum_us, count(*) AS requests FROM request_log GROUP BY ALL")


def histogram(source: str, labels: str, value: str, bounds: list[str]) -> str:
    parts = [f"SELECT {labels}, '{b}' AS le, count(*) FILTER (WHERE {value} <= {b}) AS samples FROM {source} GROUP BY ALL" for b in bounds]
    return " UNION ALL ".join([*parts, f"SELECT {labels}, '+Inf', count(*) FROM {source} GROUP BY ALL"])


define("agg6_latency_histogram", histogram("request_log", "method, route", "(took_us / 1e6)", ["0.1", "0.3", "0.5", "1", "2", "3", "5", "8", "13"]))
define("agg6_score_histogram", histogram("pairs", "'json' AS backend", "score", ["0", "1", "2", "3", "4", "5", "8", "13"]), *token_pairs("messages", CORPUS))
define(
    "agg6_assistant_latency",
    histogram(
        "(SELECT ['hosted', 'local'][session % 2 + 1] AS provider, ['vector', 'json'][req_id % 2 + 1] AS backend, took_us FROM request_log)",
        "provider, backend", "(took_us / 1e6)", ["0.1", "0.3", "0.5", "1", "2", "3", "5", "8", "13"],
    ),
)
define(
    "agg7_retrieval_counters",
    """SELECT 'queries' AS metric, 'json' AS backend, count(*) AS total FROM messages UNION ALL SELECT 'hits', 'json', count(*) FROM found
    UNION ALL SELECT 'queries', 'vector', count(*) FROM embeddings UNION ALL SELECT 'hits', 'vector', count(*) * least(6, count(*)) FROM embeddings""",
    *token_top("messages", CORPUS, 6),
)
define("agg8_vector_hit_ratio", "SELECT 'vector' AS backend, CASE WHEN count(*) > 0 THEN 1.0::DOUBLE ELSE 0.0 END AS hit_ratio FROM embeddings")
define(
    "agg7_labelled_counters",
    """SELECT CASE WHEN status >= 500 THEN 'error' WHEN bytes < 8 THEN 'bad_request' ELSE 'ok' END AS status,
      ['hosted', 'local'][session % 2 + 1] AS provider, ['vector', 'json'][req_id % 2 + 1] AS backend, count(*) AS total FROM request_log GROUP BY ALL""",
)
define(
    "agg8_hit_ratio",
    """SELECT backend, arg_max(hits, query_id) / CAST(greatest(1, least(6, (SELECT count(*) FROM documents))) AS DOUBLE) AS hit_ratio FROM (
      SELECT query_id, ['json', 'json-replica'][query_id % 2 + 1] AS backend, (SELECT count(*) FROM found f WHERE f.query_id = m.query_id) AS hits FROM messages m) GROUP BY backend""",
    *token_top("messages", CORPUS, 6),
)
define(
    "agg9_distinct_ids",
    """SELECT query_id, coalesce(string_agg(id, ',' ORDER BY p), '') AS ids FROM (
      SELECT query_id, id, min(p) AS p FROM (SELECT query_id, unnest(ids) AS id, unnest(range(len(ids))) AS p
        FROM (SELECT query_id, regexp_extract_all(reply, '\\[([a-zA-Z0-9-]+)\\]', 1) AS ids FROM replies)) GROUP BY ALL
      UNION ALL SELECT query_id, NULL, NULL FROM replies) GROUP BY query_id""",
)
define(
    "agg10_load_report",
    """SELECT route, count(*) AS requests, count(*) FILTER (WHERE status >= 500) AS errors,
      round(count(*) FILTER (WHERE status >= 500) / count(*), 9) AS error_rate,
      CAST(quantile_cont(took_us // 1000, 0.5) AS DOUBLE) AS p50_ms, CAST(quantile_cont(took_us // 1000, 0.95) AS DOUBLE) AS p95_ms,
      CAST(quantile_cont(took_us // 1000, 0.99) AS DOUBLE) AS p99_ms FROM request_log GROUP BY route""",
)
define("agg11_id_set", "SELECT DISTINCT user_id, product_id FROM clicks")

# --- sorts, limits, top-k, sampling ------------------------------------------------------
define("l1_label_sort", "SELECT method || route || status AS label, count(*) AS requests FROM request_log GROUP BY ALL ORDER BY 1")
define(
    "l2_top_k_relevance",
    "SELECT * FROM found",
    *token_top("(SELECT s_suppkey AS query_id, 'a red small promo ring Brand ' || s_suppkey % 25 AS text FROM supplier)", FEATURES, 6),
)


def vector_top(k: int) -> str:
    return f"""SELECT query_id, item_id, CAST(rank AS INT) AS rank, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
        SELECT q.vec_id AS query_id, i.vec_id AS item_id, round(list_cosine_similarity(q.e, i.e), 6) AS score
        FROM (SELECT *, embedding::DOUBLE[] AS e FROM embeddings) q, (SELECT *, embedding::DOUBLE[] AS e FROM embeddings) i))
      WHERE rank <= {k}"""


define("l3_vector_top_k", vector_top(3))
define("t2_vector_search", vector_top(6))
# Every user meets every product; the engine produces only the first steps of each walk.
RECOMMENDED = [
    "size AS (SELECT count(*) AS n FROM part)",
    """prime AS (SELECT min(c) AS p FROM (SELECT unnest(range(n, 2 * n + 3)) AS c FROM size)
      WHERE c > 1 AND len(list_filter(range(2, CAST(floor(sqrt(c)) AS BIGINT) + 1), lambda d: c % d = 0)) = 0)""",
    f"""numbers AS (SELECT p_partkey AS product_id, row_number() OVER (ORDER BY {hexnum("md5(CAST(p_partkey AS VARCHAR))", 1, 8)} % 4096, p_partkey) - 1 AS number FROM part)""",
    f"""walkers AS (SELECT c_custkey AS user_id, {hexnum("md5('shop:' || c_custkey)", 1, 15)} % (p - 1) + 1 AS a, {hexnum("md5('shop:' || c_custkey)", 17, 15)} % p AS b, p FROM customer, prime)""",
    "steps AS (SELECT user_id, step, CAST((a::HUGEINT * step + b) % p AS BIGINT) AS number FROM walkers, (SELECT unnest(range(p)) AS step FROM prime))",
    """recommended AS (SELECT user_id, rank, product_id FROM (
      SELECT user_id, product_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY step) AS INT) AS rank FROM steps JOIN numbers USING (number)
      WHERE (user_id, product_id) NOT IN (SELECT user_id, product_id FROM user_carts)) WHERE rank <= 5)""",
]
define("l4_sample", "SELECT * FROM recommended", *RECOMMENDED)
define("l5_cap_after_lookup", "SELECT user_id, rank, product_id, name, currency_code, units, nanos FROM recommended JOIN flat_catalog ON id = product_id WHERE rank <= 4", *RECOMMENDED)
define(
    "p2_cart_recommendations",
    "SELECT order_id, rank, product_id, name FROM requests r JOIN recommended c ON c.user_id = r.user_id JOIN flat_catalog ON id = product_id WHERE rank <= 4",
    *RECOMMENDED,
)
define(
    "p4_recommendations",
    """SELECT user_id, count(*) AS shown, CAST(sum(units) AS BIGINT) AS units, min(name) AS first_name
    FROM recommended JOIN flat_catalog ON id = product_id WHERE rank <= 4 GROUP BY user_id""",
    *RECOMMENDED,
)
DRAWN = f"""drawn AS (SELECT event_id AS request_id, i AS key_pos, {hexnum("md5('shop:' || event_id || ':' || i)", 1, 8)} % 7 AS ad_no FROM events, (SELECT unnest(range(2)) AS i))"""
define("l6_random_ads", "SELECT request_id, CAST(key_pos AS INT) AS key_pos, CAST(d.ad_no AS INT) AS ad_no, redirect_url FROM drawn d JOIN ads USING (ad_no)", DRAWN)
CHOSEN = """SELECT request_id, ad_no, redirect_url, text FROM (SELECT *, row_number() OVER (PARTITION BY request_id
      ORDER BY md5('shop:' || request_id || ':' || key_pos || ':' || pos)) AS r FROM served) WHERE r = 1"""
define("l7_choose_ad", CHOSEN, "served AS (SELECT * FROM context_ads)")
define(
    "p5_ad_selection",
    CHOSEN,
    DRAWN,
    """served AS (SELECT request_id, key_pos, pos, ad_no, redirect_url, text FROM context_ads
      UNION ALL SELECT request_id, key_pos, pos, a.ad_no, redirect_url, text FROM drawn JOIN ads a USING (ad_no)
      WHERE request_id NOT IN (SELECT request_id FROM context_ads))""",
)
IDS = "regexp_extract_all(reply, '\\[([a-zA-Z0-9-]+)\\]', 1)"
define("l8_fallback_ids", f"SELECT query_id, CASE WHEN len({IDS}) = 0 THEN 'NO_MATCH' ELSE array_to_string({IDS}[1:3], ',') END AS ids FROM replies")

# --- set operations ----------------------------------------------------------------------
define("set1_difference", "SELECT p_partkey AS product_id FROM part EXCEPT SELECT product_id FROM clicks")
define("set2_concat_ads", "SELECT category, count(*) AS served, count(DISTINCT request_id) AS requests FROM context_ads GROUP BY category")
define(
    "set3_token_intersection",
    """SELECT a.conv_id, a.turn, (SELECT count(*) FROM tw x JOIN tw y USING (w) WHERE x.conv_id = a.conv_id AND x.turn = a.turn
      AND y.conv_id = a.conv_id AND y.turn = a.turn + 1) AS shared
    FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1""",
    "tw AS (" + words("conversations", "conv_id, turn", "text") + ")",
)

# --- scalar functions over whole tables --------------------------------------------------
define(
    "m1_money_arithmetic",
    """SELECT order_id, line_no, product_id, reason, CASE WHEN reason IS NULL THEN CAST(t // 1000000000 AS BIGINT) END AS sum_units,
      CASE WHEN reason IS NULL THEN CAST(t % 1000000000 AS INT) END AS sum_nanos, -units AS neg_units, -nanos AS neg_nanos,
      code = 'USD' AS same_currency, units = ou AND nanos = onn AS equal
    FROM (SELECT *, CASE WHEN NOT is_valid THEN 'invalid_value' WHEN code <> 'USD' THEN 'mismatching_currency' END AS reason,
      (units + ou) * 1000000000::HUGEINT + nanos + onn AS t
      FROM (SELECT *, units + 7 AS ou, CASE WHEN units + 7 >= 0 THEN 250000000 ELSE -250000000 END AS onn FROM checked))""",
)
define("m2_convert_money", "SELECT order_id, from_code, to_code, out_units, out_nanos, out_reason FROM converted", CONVERTED)
define(
    "m3_multiply_money",
    """SELECT order_id, line_no, product_id, quantity, CAST(t // 1000000000 AS BIGINT) AS units, CAST(t % 1000000000 AS INT) AS nanos FROM (
      SELECT o.*, (units * 1000000000::HUGEINT + nanos) * quantity AS t FROM order_carts o JOIN flat_catalog ON id = product_id)""",
)
define(
    "m4_shipping_quote",
    """SELECT order_id, item_count, CASE WHEN item_count = 0 THEN 0::BIGINT ELSE 8 END AS units, CASE WHEN item_count = 0 THEN 0 ELSE 990000000 END AS nanos FROM (
      SELECT o_orderkey AS order_id, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS item_count FROM orders LEFT JOIN order_carts c ON c.order_id = o_orderkey GROUP BY ALL)""",
)
define("m5_dollars_and_cents", "SELECT o_orderkey, CAST(trunc(o_totalprice) AS INT) AS dollars, CAST(trunc((o_totalprice - trunc(o_totalprice)) * 100) AS INT) AS cents FROM orders")
define("m6_display_money", f"SELECT id, {money_text(pick([*ALLOWED_CURRENCIES, 'CHF'], 'id'), 'units', 'nanos')} AS shown FROM flat_catalog")
define("m7_currency_symbol", "SELECT code, count(*) AS customers, CASE code WHEN 'JPY' THEN '¥' WHEN 'EUR' THEN '€' WHEN 'TRY' THEN '₺' WHEN 'GBP' THEN '£' ELSE '$' END AS symbol FROM homes GROUP BY code")
define("m8_long_money_text", "SELECT id, units || '.' || lpad(CAST(nanos AS VARCHAR), 9, '0') || ' ' || currency_code AS long_text FROM flat_catalog")
define(
    "s0_tokens",
    """SELECT doc_id AS item_id, count(w) AS n_tokens, md5(coalesce(string_agg(w, ' ' ORDER BY w), '')) AS digest
    FROM documents LEFT JOIN (SELECT * FROM dw) d USING (doc_id) GROUP BY doc_id""",
    "dw AS (" + words("documents", "doc_id", "text") + ")",
)
define("s2_feature_text", "SELECT id, name || ' ' || CASE WHEN id % 5 = 0 THEN '' ELSE description END || ' ' || replace(categories, ',', ' ') AS feature_text FROM flat_catalog")
define("s3_cited_ids", f"SELECT query_id, regexp_matches(reply, '\\[([A-Za-z0-9_-]{{3,64}})\\]') AS cites, array_to_string({IDS}, ',') AS ids FROM replies")
FOOTER = """footed AS (SELECT query_id, CASE WHEN regexp_matches(reply, '\\[([A-Za-z0-9_-]{3,64})\\]') THEN reply ELSE
      regexp_replace(reply, '\\s+$', '') || chr(10) || '推荐ID: ' || ids END AS content FROM footing)"""
define(
    "s4_id_footer",
    "SELECT query_id, md5(content) AS digest, right(content, 30) AS tail FROM footed",
    """footing AS (SELECT query_id, reply, CASE WHEN query_id % 2 = 0 THEN '[NO_MATCH]'
      ELSE '[' || query_id || '], [' || query_id + 1 || '], [' || query_id + 2 || ']' END AS ids FROM replies)""",
    FOOTER,
)
define("s5_strip_list_tail", "SELECT query_id, regexp_replace(reply, '\\n+[-*\\d][\\s\\S]*', '', 'g') AS stripped FROM replies")
define(
    "s6_metadata_ids",
    """SELECT id, CASE id % 5 WHEN 0 THEN CAST(id AS VARCHAR) WHEN 1 THEN 'r' || id || ',m' || id WHEN 2 THEN CAST(id AS VARCHAR)
      WHEN 3 THEN 'm' || id ELSE '' END AS doc_ids FROM flat_catalog""",
)
define("s6_metadata_id", "SELECT id, CASE WHEN id % 4 <> 3 THEN CAST(id AS VARCHAR) END AS doc_id FROM flat_catalog")
define(
    "s7_tracking_id",
    f"""SELECT order_id, {tracking('order_id', "(street_address || ', ' || CASE WHEN user_id % 2 = 0 THEN 'Zürich ' ELSE '' END || city || ', ' || state)", 'shop')} AS tracking_id FROM requests""",
)
define(
    "s8_label_escape",
    """SELECT event_id, 'a' || repeat(chr(92), 2) || 'b' || replace(props, '"', chr(92) || '"') || chr(92) || 'n' || event_type AS label FROM events""",
)
define("a1_explode_rebuild", "SELECT id, len(string_split(categories, ',')) AS n, upper(categories) AS categories FROM flat_catalog")

# --- retrieval ---------------------------------------------------------------------------
define("t1_token_search", "SELECT * FROM found", *token_top("messages", CORPUS, 6))
define(
    "t3_embed_column",
    "SELECT id, 'hashed-words-16' AS embed_model, 16 AS dims, len(string_split(description, ' ')) AS words FROM flat_catalog",
)
define(
    "t4_backend_choice",
    f"SELECT 'tokens' AS method, query_id, item_id FROM found UNION ALL SELECT 'vector', query_id, item_id FROM ({vector_top(1)})",
    *token_top(BENCH, CORPUS, 1),
)
define(
    "t5_prompt",
    f"""SELECT query_id, md5(prompt) AS digest, length(prompt) AS n_chars FROM (SELECT query_id,
      {template(DESIGN_PROMPT, instruction="'You are a designer.'", room="'warm'", candidates="'ids ' || query_id", message="text")} AS prompt FROM messages)""",
)

# --- whole jobs --------------------------------------------------------------------------


def priced(lines: str, requests: str) -> list[str]:
    src = f"""(SELECT l.order_id, l.product_id, l.quantity, r.user_currency, p.id AS pid, p.units, p.nanos, p.currency_code AS src_code
      FROM {lines} l JOIN {requests} r ON r.order_id = l.order_id LEFT JOIN flat_catalog p ON p.id = l.product_id)"""
    ship = f"""(SELECT r.*, coalesce(i.item_count, 0) AS item_count, i.items, i.line_reason, CASE WHEN coalesce(i.item_count, 0) = 0 THEN 0 ELSE 8 END AS su,
      CASE WHEN coalesce(i.item_count, 0) = 0 THEN 0 ELSE 990000000 END AS sn
      FROM {requests} r LEFT JOIN items i ON i.order_id = r.order_id)"""
    return [
        f"""priced AS (SELECT *, (unit_units * 1000000000::HUGEINT + unit_nanos) * quantity AS line_nanos,
          CASE WHEN pid IS NULL THEN 'unknown_product' WHEN quantity < 1 THEN 'invalid_quantity' ELSE unit_reason END AS line_reason
          FROM {convert(src, 'units', 'nanos', 's.src_code', 's.user_currency', 'unit')})""",
        """items AS (SELECT order_id, sum(line_nanos) AS items, CAST(sum(quantity) AS BIGINT) AS item_count, min(line_reason) AS line_reason FROM priced GROUP BY order_id)""",
        f"""totals AS (SELECT *, coalesce(items, 0) + shipping_units * 1000000000::HUGEINT + shipping_nanos AS total,
          coalesce(line_reason, shipping_reason) AS prep_reason FROM {convert(ship, 'su', 'sn', "'USD'", 's.user_currency', 'shipping')})""",
        SCREENED,
        f"""placed AS (SELECT t.* REPLACE (CASE WHEN prep_reason IS NULL THEN shipping_units END AS shipping_units, CASE WHEN prep_reason IS NULL THEN shipping_nanos END AS shipping_nanos),
          coalesce(prep_reason, card_reason) AS reason, right(s.card, 4) AS last4,
          CASE WHEN prep_reason IS NULL THEN CAST(total // 1000000000 AS BIGINT) END AS total_units, CASE WHEN prep_reason IS NULL THEN CAST(total % 1000000000 AS INT) END AS total_nanos,
          CASE WHEN coalesce(prep_reason, card_reason) IS NULL THEN
            {tracking('t.order_id', "(t.street_address || ', ' || t.city || ', ' || t.state)", 'ship')} END AS tracking_id
          FROM totals t JOIN screened s ON s.order_id = t.order_id)""",
    ]


PLAIN = priced("order_carts", "requests")
define(
    "p1_checkout",
    """SELECT order_id, user_id, user_currency, item_count, shipping_units, shipping_nanos, total_units, total_nanos,
      CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS decision, reason, last4, tracking_id FROM placed""",
    *PLAIN,
)
define(
    "p1_order_documents",
    """SELECT o.order_id, tracking_id AS shipping_tracking_id, shipping_units, product_id, quantity, cost_units, cost_nanos
    FROM placed o JOIN (SELECT order_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity, any_value(unit_units) AS cost_units, any_value(unit_nanos) AS cost_nanos
      FROM priced GROUP BY order_id, product_id) i ON i.order_id = o.order_id WHERE reason IS NULL""",
    *PLAIN,
)
define(
    "p1_rejected_orders",
    "SELECT order_id, reason, last4 FROM placed WHERE reason IS NOT NULL",
    *priced(
        "(SELECT order_id, quantity, product_id + (CASE WHEN order_id % 10 = 0 THEN 1000000000 ELSE 0 END) AS product_id FROM order_carts)",
        "(SELECT * REPLACE (CASE WHEN order_id % 9 = 0 THEN 'XXX' ELSE user_currency END AS user_currency) FROM requests)",
    ),
)
define(
    "p2_cart_lines",
    f"""SELECT order_id, product_id, quantity, user_currency AS currency_code, u AS line_units, n AS line_nanos, {money_text('user_currency', 'u', 'n')} AS line_text
    FROM (SELECT *, CAST(line_nanos // 1000000000 AS BIGINT) AS u, CAST(line_nanos % 1000000000 AS INT) AS n FROM priced)""",
    *PLAIN,
)
define(
    "p2_cart_view",
    f"""SELECT order_id, user_id, item_count, {money_text('user_currency', 'shipping_units', 'shipping_nanos')} AS shipping_text,
      {money_text('user_currency', 'total_units', 'total_nanos')} AS total_text FROM placed""",
    *PLAIN,
)
define(
    "p3_reconciliation",
    """SELECT order_id, CAST(again // 1000000000 AS BIGINT) AS recomputed_units, CAST(again % 1000000000 AS INT) AS recomputed_nanos,
      again = total_units * 1000000000::HUGEINT + total_nanos AS agrees FROM (
      SELECT o.order_id, total_units, total_nanos, shipping_units * 1000000000::HUGEINT + shipping_nanos + coalesce(i.items, 0) AS again
      FROM placed o LEFT JOIN (SELECT order_id, sum((cost_units * 1000000000::HUGEINT + cost_nanos) * (q + CASE WHEN order_id % 50 = 0 AND first THEN 1 ELSE 0 END)) AS items
        FROM (SELECT order_id, sum(quantity) AS q, any_value(unit_units) AS cost_units, any_value(unit_nanos) AS cost_nanos,
          product_id = min(product_id) OVER (PARTITION BY order_id) AS first FROM priced GROUP BY order_id, product_id)
        GROUP BY order_id) i ON i.order_id = o.order_id WHERE reason IS NULL)""",
    *PLAIN,
)
SEARCHED = template(SEARCH_PROMPT, message="message", room="'minimal oak'")
define(
    "p6_assistant_candidates",
    f"""SELECT query_id, ids AS candidate_ids, md5({template(DESIGN_PROMPT, instruction="'You are a designer.'", room="'minimal oak'", candidates="docs", message="message")}) AS prompt_digest
    FROM (SELECT m.query_id, m.message, coalesce(string_agg(f.item_id, ',' ORDER BY f.rank), '') AS ids,
        coalesce(string_agg('{{"id":"' || f.item_id || '","text":' || to_json(d.text) || ',"_relevance_score":' || f.score || '}}', ', ' ORDER BY f.rank), '') AS docs
      FROM valid_messages m LEFT JOIN found f ON f.query_id = m.query_id LEFT JOIN documents d ON d.doc_id = f.item_id WHERE accepted GROUP BY ALL)""",
    *token_top(f"(SELECT query_id, {SEARCHED} AS text FROM valid_messages WHERE accepted)", CORPUS, 6),
)
DEGRADED = "'当前智能推荐通道处于保护模式，已启用降级回复。' || chr(10) || '你可继续描述偏好（当前输入：' || {} || '），系统将返回基础推荐。' || chr(10) || '推荐ID: [NO_MATCH]'"
define(
    "p6_final_replies",
    "SELECT query_id, md5(content) AS digest FROM footed",
    f"""footing AS (SELECT query_id, CASE WHEN query_id % 4 <> 0 THEN reply ELSE {DEGRADED.format("'m' || query_id")} END AS reply,
      '[' || query_id || '], [7]' AS ids FROM replies)""",
    FOOTER,
)
CART_STATE = """SELECT l.user_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity{} FROM cart_log l
    LEFT JOIN (SELECT user_id, max(seq) AS emptied FROM cart_log WHERE kind = 'empty' GROUP BY user_id) e ON e.user_id = l.user_id
    WHERE kind = 'add' AND (emptied IS NULL OR seq > emptied) GROUP BY ALL"""
define("s1_cart_replay", CART_STATE.format(", min(seq) AS first_seq"))
define("st1_cart_stream", CART_STATE.format(""))

# --- stateful and streaming --------------------------------------------------------------
define(
    "st2_request_stream",
    """SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start_s, method, route, CAST(status AS VARCHAR) AS status, count(*) AS requests, CAST(sum(took_us) AS BIGINT) AS sum_us
    FROM request_log GROUP BY ALL""",
)
LIMITED = """fold AS (SELECT key, call_id, n, TRUE AS allowed, [at_us] AS q FROM calls WHERE n = 1
      UNION ALL SELECT c.key, c.call_id, c.n, len(list_filter(f.q, lambda y: c.at_us - y <= 86400000000)) < 2,
        CASE WHEN len(list_filter(f.q, lambda y: c.at_us - y <= 86400000000)) < 2
          THEN list_append(list_filter(f.q, lambda y: c.at_us - y <= 86400000000), c.at_us)
          ELSE list_filter(f.q, lambda y: c.at_us - y <= 86400000000) END
      FROM fold f JOIN calls c ON c.key = f.key AND c.n = f.n + 1)"""
define("st3_rate_limit", "SELECT key, call_id, allowed FROM fold", LIMITED)
define("agg7_rejected_calls", "SELECT count(*) FILTER (WHERE NOT allowed) AS rejected FROM fold", LIMITED)


def breaker_fold(threshold: int, reset_us: int) -> str:
    return f"""fold AS (
      SELECT key, call_id, n, failed, CASE WHEN failed AND {threshold} <= 1 THEN 'opened' ELSE 'allowed' END AS verdict,
        CAST(failed AS INT) AS failures, CASE WHEN failed AND {threshold} <= 1 THEN at_us + {reset_us} ELSE 0 END AS open_until FROM calls WHERE n = 1
      UNION ALL SELECT c.key, c.call_id, c.n, c.failed,
        CASE WHEN c.at_us < f.open_until THEN 'blocked' WHEN NOT c.failed OR f.failures + 1 < {threshold} THEN 'allowed' ELSE 'opened' END,
        CASE WHEN c.at_us < f.open_until THEN f.failures WHEN c.failed THEN f.failures + 1 ELSE 0 END,
        CASE WHEN c.at_us < f.open_until THEN f.open_until WHEN NOT c.failed THEN 0
          WHEN f.failures + 1 >= {threshold} THEN c.at_us + {reset_us} ELSE f.open_until END
      FROM fold f JOIN calls c ON c.key = f.key AND c.n = f.n + 1)"""


define("st4_breaker", "SELECT key, call_id, verdict FROM fold", breaker_fold(3, 43_200_000_000))
define(
    "t6_degraded_reply",
    f"""SELECT call_id, CASE WHEN failed OR verdict = 'blocked' THEN {DEGRADED.format('props')} ELSE 'ok ' || props END AS reply
    FROM fold JOIN events ON event_id = call_id""",
    breaker_fold(2, 86_400_000_000),
)
define(
    "st5_sessions",
    "SELECT key, call_id, s AS session_start_us, md5('shop:' || key || ':' || s) AS session_id FROM fold",
    """fold AS (SELECT key, call_id, n, at_us AS s FROM calls WHERE n = 1
      UNION ALL SELECT c.key, c.call_id, c.n, CASE WHEN c.at_us >= f.s + 172800000000 THEN c.at_us ELSE f.s END
      FROM fold f JOIN calls c ON c.key = f.key AND c.n = f.n + 1)""",
)
define("st6_hot_reload", "SELECT seq, product_id, id IS NOT NULL AS found, name FROM cart_log LEFT JOIN flat_catalog ON id = product_id WHERE kind = 'add'")
define("st7_request_log", "SELECT req_id, session, method, path, took_us // 1000 AS took_ms, raw_status AS status, bytes FROM request_log")
