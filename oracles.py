"""DuckDB SQL for the registered queries, written independently of the Spark plans.

Each text is one statement over the pre-registered table views.  Shared fragments
(stand-in tables, the row hash, numeric integrals for p-values) are put together here.
"""

from __future__ import annotations

import math

# Sizes and parameters of the runs, stated here again.
REPLICATES, SIMULATIONS, SAMPLE_SIZE, SEED = 1000, 1000, 1000, 7
FIRST_COHORT, LAST_COHORT = "1996-01", "1996-12"
PRICE_CUT = 400000.0
LOOKUP_DOMAIN, REPORT_DATE, NEXT_DATE = "m.ththth.example.net", "2023-03-03", "2023-03-04"
# 32-bit mask, mixer multiplier, golden-ratio step.
MASK32, MIX_MULTIPLIER, GOLDEN_STEP = 4294967295, 73244475, 2654435769

ORACLES: dict[str, str] = {}


def with_tables(*parts: str) -> str:
    """WITH clause of the given common table expressions."""
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def even(value: str, digits: int) -> str:
    """Half-to-even rounding in binary arithmetic."""
    scale = f"{10**digits}::DOUBLE"
    return f"(round_even(({value}) * {scale}, 0) / {scale})"


def near(value: str, digits: int) -> str:
    return f"(round({value}, {digits}) + 0.0::DOUBLE)"


def percent(top: str, bottom: str) -> str:
    share = f"(({top})::DOUBLE / nullif({bottom}, 0)::DOUBLE) * 100.0::DOUBLE"
    return even(share, 2)


# --- stand-in tables ------------------------------------------------------------------

SHOP = """
shop_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE WHEN o_totalprice < 5000 THEN NULL WHEN o_orderstatus = 'F' THEN 'delivered'
         WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN NULL
         ELSE o_orderdate END AS approved,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
         THEN o_orderdate + INTERVAL 10 DAY END AS delivered,
    o_orderdate + INTERVAL 30 DAY AS estimated
  FROM orders),
bought AS (
  SELECT s.*, c_name AS customer_unique_id, c_nationkey::VARCHAR AS customer_state
  FROM shop_orders s JOIN customer ON c_custkey = customer_id
  WHERE approved IS NOT NULL
    AND order_status IS DISTINCT FROM 'canceled' AND order_status IS DISTINCT FROM 'unavailable')
"""

TRIAL = """
grp_all AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS grp FROM customer),
active AS (
  SELECT DISTINCT o_custkey AS student_id FROM orders
  WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-07-01'),
checks AS (
  SELECT o_custkey AS student_id, sum(o_totalprice) AS rev FROM orders
  WHERE o_orderpriority = '1-URGENT'
    AND o_orderdate >= TIMESTAMP '1996-04-01' AND o_orderdate < TIMESTAMP '1996-10-01'
  GROUP BY 1),
everyone AS (
  SELECT student_id FROM active UNION SELECT student_id FROM checks),
full_table AS (
  SELECT student_id AS id, grp, coalesce(rev, 0) AS rev
  FROM everyone LEFT JOIN grp_all ON id = student_id LEFT JOIN checks USING (student_id))
"""

PLATFORM = """
students AS (
  SELECT DISTINCT user_id AS st_id,
    CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'pilot' END AS test_grp FROM events),
answers AS (
  SELECT user_id AS st_id, ts AS timest, (event_type = 'click')::INTEGER AS correct,
    CASE WHEN event_id % 7 = 0 THEN 'Math' ELSE 'Other' END AS subject FROM events),
paid AS (
  SELECT user_id AS st_id, value AS money,
    CASE WHEN event_id % 7 = 0 THEN 'Math' ELSE 'Other' END AS subject
  FROM events WHERE event_type = 'purchase' AND value > 150)
"""

AB = """
ab AS (
  SELECT o_orderkey AS number, o_totalprice AS value,
    CASE o_orderstatus WHEN 'F' THEN 'Treatment' WHEN 'O' THEN 'Control' ELSE 'Other' END AS variant
  FROM orders)
"""

AA = """
aa_raw AS (
  SELECT event_id AS number, (user_id % 2)::INTEGER AS variant,
    'v2.' || (user_id % 3 + 7)::VARCHAR || '.0' AS version,
    (event_type = 'purchase')::INTEGER AS bought FROM events),
aa AS (
  SELECT number, variant, version,
    CASE WHEN version = 'v2.8.0' AND variant = 0 THEN 0 ELSE bought END AS purchase FROM aa_raw)
"""

PAYMENTS = """
all_transfers AS (
  SELECT o_custkey AS id_sender, l_suppkey AS id_receiver, l_shipdate::DATE AS dates,
    l_extendedprice AS amount_new
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
issues AS (
  SELECT o_custkey AS id_sender,
    min(o_orderdate)::DATE + (o_custkey % 365)::INTEGER AS date_cred
  FROM orders GROUP BY o_custkey),
dated AS (
  SELECT t.*, date_cred, (dates - date_cred)::INTEGER AS diff_time
  FROM all_transfers t JOIN issues USING (id_sender)),
cleaned AS (
  SELECT * FROM dated d WHERE diff_time BETWEEN -1 AND 7 AND NOT EXISTS (
    SELECT 1 FROM dated k WHERE k.id_sender = d.id_sender AND k.id_receiver = d.id_receiver
      AND (k.diff_time < -1 OR k.diff_time > 7)))
"""

EDGES = """
edges AS (
  SELECT 'c' || id_sender::VARCHAR AS src, 's' || id_receiver::VARCHAR AS dst,
    round(sum(amount_new), 2) AS amount
  FROM cleaned GROUP BY 1, 2)
"""

TRADE_EDGES = EDGES.replace("FROM cleaned", "FROM all_transfers")

COMPONENTS = """
links AS (SELECT src AS u, dst AS v FROM edges UNION SELECT dst, src FROM edges),
reach(node, seen) AS (
  SELECT DISTINCT u, u FROM links
  UNION
  SELECT node, v FROM reach JOIN links ON seen = u),
components AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
"""

DOMAINS = """
domains AS (
  SELECT page_id::BIGINT AS rank, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS domain
  FROM pages)
"""

# --- shared arithmetic ----------------------------------------------------------------


def mixed(source: str, name: str) -> str:
    """Columns that scatter a 32-bit number; the last one is called ``name``."""

    def scatter(x: str) -> str:
        return f"((xor({x} >> 16, {x}) * {MIX_MULTIPLIER}) & {MASK32})"

    return (
        f"({source})::BIGINT AS {name}_0, {scatter(name + '_0')} AS {name}_1, "
        f"{scatter(name + '_1')} AS {name}_2, xor({name}_2 >> 16, {name}_2) AS {name}"
    )


def hashed(key: str, seed: int, name: str) -> str:
    """Columns that hash a BIGINT key to two 32-bit halves, ``name`` and ``name_b``."""
    low, high = f"(({key})::BIGINT & {MASK32})", f"((({key})::BIGINT >> 32) & {MASK32})"
    return ", ".join([
        mixed(f"xor({low}, {seed}::BIGINT)", f"{name}_r1"),
        f"xor({high}, {name}_r1) AS {name}_a",
        mixed(f"({name}_a + {GOLDEN_STEP}) & {MASK32}", f"{name}_r2"),
        f"xor({low}, {name}_r2) AS {name}_b",
        mixed(f"({name}_b + {2 * GOLDEN_STEP}) & {MASK32}", f"{name}_r3"),
        f"xor({name}_a, {name}_r3) AS {name}",
    ])


def drawn(hash_column: str, replicate: str, name: str) -> str:
    """Columns with a 32-bit draw of a hashed row and a replicate."""
    return (
        mixed(f"({hash_column} + {replicate}::BIGINT * {GOLDEN_STEP}) & {MASK32}", f"{name}_u")
        + ", " + mixed(f"xor({name}_u, {hash_column}_b)", name)
    )


def finely(hash_column: str, draw: str, name: str) -> str:
    """Columns that lengthen a draw to 53 bits."""
    return (
        mixed(f"({draw} + {hash_column}_b) & {MASK32}", f"{name}_rest")
        + f", {draw} * 2097152 + ({name}_rest >> 11) AS {name}"
    )


def uniform(name: str) -> str:
    """A hash of two halves as a double in [0, 1)."""
    return f"(({name} * 2097152 + ({name}_b >> 11))::DOUBLE / 9007199254740992::DOUBLE)"


def poisson(draw: str) -> str:
    """Poisson(1) weight of a 32-bit draw."""
    total, cases = 0.0, []
    for i in range(12):
        total += math.exp(-1) / math.factorial(i)
        cases.append(f"WHEN {draw} < {int(total * 2**32)} THEN {i}")
    return f"CASE {' '.join(cases)} ELSE 12 END"


SIMPSON = "CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"


def tail(z: str) -> str:
    """Upper normal tail of |z| by Simpson's rule."""
    inside = (
        f"(SELECT sum({SIMPSON} * exp(-pow(abs({z}) * i / 2000, 2) / 2)) "
        f"FROM range(2001) simpson(i))"
    )
    return f"greatest(0::DOUBLE, 0.5::DOUBLE - abs({z}) / 6000 / sqrt(2 * pi()) * {inside})"


def t_p(t: str, df: str) -> str:
    """Two-sided t p-value by Simpson's rule."""
    inside = (
        f"(SELECT sum({SIMPSON} * pow(1 + pow(abs({t}) * i / 2000, 2) / {df}, -({df} + 1) / 2)) "
        f"FROM range(2001) simpson(i))"
    )
    front = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi())"
    return f"greatest(0::DOUBLE, 1 - 2 * abs({t}) / 6000 * {front} * {inside})"


def moments(source: str, value: str, group: str, a: str, b: str, keys: str = "") -> str:
    """n, mean, variance of two samples."""
    columns = ", ".join(
        f"count({value}) FILTER ({group} = {label}) AS n{i}, "
        f"avg({value}::DOUBLE) FILTER ({group} = {label}) AS m{i}, "
        f"var_samp({value}::DOUBLE) FILTER ({group} = {label}) AS v{i}"
        for i, label in ((1, a), (2, b))
    )
    grouped = f" GROUP BY {keys}" if keys else ""
    return f"SELECT {keys + ', ' if keys else ''}{columns} FROM {source}{grouped}"


STUDENT = (
    "(m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) "
    "* (1 / n1::DOUBLE + 1 / n2::DOUBLE)) AS t, (n1 + n2 - 2)::DOUBLE AS df"
)
WELCH = (
    "(m1 - m2) / nullif(sqrt(v1 / n1 + v2 / n2), 0) AS t, pow(v1 / n1 + v2 / n2, 2) "
    "/ nullif(pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1), 0) AS df"
)


def normality(source: str, value: str, group: str) -> str:
    """K2 test per group: columns grp, n, z_skew, z_kurt, k2."""
    return f"""
    SELECT grp, n, z_skew, z_kurt, z_skew * z_skew + z_kurt * z_kurt AS k2 FROM (
      SELECT *, delta * asinh(CASE WHEN y0 = 0 THEN 1 ELSE y0 END / sqrt(2 / (w2 - 1))) AS z_skew,
        (1 - 2 / (9 * a) - cbrt((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a))
          AS z_kurt
      FROM (
        SELECT *, 1 / sqrt(0.5::DOUBLE * ln(w2)) AS delta,
          6 + 8 / s * (2 / s + sqrt(1 + 4 / (s * s))) AS a
        FROM (
          SELECT *, g * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y0,
            sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)
              / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
            (b - 3 * (n - 1) / (n + 1))
              / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
            6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
              * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS s
          FROM (
            SELECT grp, count(*)::DOUBLE AS n, avg(pow(v - m, 3)) / pow(avg(pow(v - m, 2)), 1.5) AS g,
              avg(pow(v - m, 4)) / pow(avg(pow(v - m, 2)), 2) AS b
            FROM (SELECT {group} AS grp, {value}::DOUBLE AS v,
                    avg({value}::DOUBLE) OVER (PARTITION BY {group}) AS m FROM {source})
            GROUP BY grp))))"""


def u_test(source: str, value: str, group: str, a: str, b: str) -> str:
    """U test: n1, n2, u, z."""
    return f"""
    SELECT n1, n2, u,
      (greatest(u, n1::DOUBLE * n2 - u) - n1::DOUBLE * n2 / 2 - 0.5::DOUBLE)
        / sqrt(n1::DOUBLE * n2 / 12 * ((n1 + n2 + 1)
          - tie_sum / ((n1 + n2)::DOUBLE * (n1 + n2 - 1)))) AS z
    FROM (
      SELECT n1, n2, rank_sum - n1::DOUBLE * (n1 + 1) / 2 AS u, tie_sum FROM (
        SELECT count(*) FILTER (g = {a}) AS n1, count(*) FILTER (g = {b}) AS n2,
          sum(rk) FILTER (g = {a}) AS rank_sum, sum((t::DOUBLE * t * t - t) / t) AS tie_sum
        FROM (
          SELECT {group} AS g, count(*) OVER (PARTITION BY {value}) AS t,
            rank() OVER (ORDER BY {value}) + (count(*) OVER (PARTITION BY {value}) - 1) / 2.0::DOUBLE
              AS rk
          FROM {source} WHERE {group} IN ({a}, {b}))))"""


def replicates_cte(source: str, value: str, group: str, a: str, b: str, key: str, seed: int,
                   statistic: str) -> str:
    """``replicates(replicate, difference)`` by the hash-weighted bootstrap."""
    base = f"""
boot_rows AS (
  SELECT CASE WHEN {group} = {a} THEN 'a' ELSE 'b' END AS side, {value}::DOUBLE AS v,
    {hashed(key, seed, 'h')}
  FROM {source} WHERE {group} IN ({a}, {b})),
boot AS (
  SELECT replicate, side, v, {drawn('h', 'replicate', 'd')}, {poisson('d')} AS w
  FROM (SELECT side, v, h, h_b, unnest(range(1, {REPLICATES} + 1)) AS replicate FROM boot_rows))
"""
    if statistic == "mean":
        return base + """,
replicates AS (
  SELECT replicate, sum(w * v) FILTER (side = 'a') / sum(w) FILTER (side = 'a')
    - sum(w * v) FILTER (side = 'b') / sum(w) FILTER (side = 'b') AS difference
  FROM boot GROUP BY replicate)
"""
    return base + """,
picks AS (SELECT replicate, side, v, unnest(range(w)) AS copy FROM boot),
replicates AS (
  SELECT replicate, quantile_cont(v, 0.5) FILTER (side = 'a')
    - quantile_cont(v, 0.5) FILTER (side = 'b') AS difference
  FROM picks GROUP BY replicate)
"""


BOOT_SUMMARY = """
summary AS (
  SELECT count(*) AS n_replicates, avg(difference) AS mean, stddev_pop(difference) AS sd,
    quantile_cont(difference, 0.025) AS ci_low, quantile_cont(difference, 0.975) AS ci_high,
    avg(difference) / stddev_pop(difference) AS z
  FROM replicates)
"""


def verdict(p: str) -> str:
    return (
        f"CASE WHEN {p} IS NULL THEN NULL WHEN {p} <= 0.05 THEN 'reject H0: the groups differ' "
        "ELSE 'keep H0: no difference found' END AS verdict"
    )


def histogram(source: str, value: str, bins: int, digits: int, extra: str = "", by: str = "",
              density: bool = False) -> str:
    """50-bin histogram text over a relation."""
    part = f"{by}, " if by else ""
    over = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    dens = f", {near('n / (total * ((hi - lo) / ' + str(bins) + '))', 12)} AS density"
    return f"""
SELECT {part}bin, {near(f'lo + ((hi - lo) / {bins}) * (bin - 1)', digits)} AS bin_left,
  {near(f'lo + ((hi - lo) / {bins}) * bin', digits)} AS bin_right, n{dens if density else ''}{extra}
FROM (
  SELECT {part}bin, lo, hi, total, count(*) AS n FROM (
    SELECT {part}lo, hi, total,
      least(floor((v - lo) / (hi - lo) * {bins}) + 1, {bins})::INTEGER AS bin
    FROM (SELECT {part}{value}::DOUBLE AS v, min({value}::DOUBLE) {over} AS lo,
            max({value}::DOUBLE) {over} AS hi, count(*) {over} AS total FROM {source}))
  GROUP BY ALL)"""


# --- purchases and delivery -----------------------------------------------------------

ORACLES["purchases"] = with_tables(SHOP) + """
SELECT order_id, customer_unique_id, customer_state, order_status,
  strftime(approved, '%Y-%m') AS month FROM bought"""
ORACLES["purchases_per_customer"] = with_tables(SHOP) + """
SELECT customer_unique_id, count(*) AS number_orders FROM bought GROUP BY 1"""
ORACLES["hot_customer_purchases"] = with_tables(SHOP) + """
SELECT c_nationkey::VARCHAR AS customer_state, count(*) AS n,
  count(DISTINCT order_id) AS n_orders
FROM bought JOIN customer ON c_custkey = CASE WHEN order_id % 3 <> 0 THEN 1 ELSE customer_id END
GROUP BY 1"""
ORACLES["one_time_buyers"] = with_tables(SHOP) + """
SELECT count(*) AS one_time_buyers FROM (
  SELECT customer_unique_id FROM bought GROUP BY 1 HAVING count(*) = 1)"""
ORACLES["non_delivery_by_month"] = with_tables(SHOP) + """
SELECT month(estimated)::INTEGER AS month, count(*) AS count_not_del
FROM shop_orders WHERE delivered IS NULL GROUP BY 1"""
ORACLES["non_delivery_mean"] = with_tables(SHOP) + """
SELECT round(avg(n), 6) AS mean_not_del FROM (
  SELECT month(estimated) AS m, count(*) AS n FROM shop_orders WHERE delivered IS NULL GROUP BY 1)"""
ORACLES["non_delivery_status_counts"] = with_tables(SHOP) + """
SELECT order_status, count(*) AS n FROM shop_orders
WHERE delivered IS NULL AND order_status IS NOT NULL GROUP BY 1"""
ORACLES["shipped_by_month"] = with_tables(SHOP) + """
SELECT month(estimated)::INTEGER AS month, count(*) AS count_del
FROM shop_orders WHERE order_status = 'shipped' GROUP BY 1"""
ORACLES["missing_delivery_by_status"] = with_tables(SHOP) + """
SELECT order_status, count(*) AS n_orders, count(*) FILTER (delivered IS NULL) AS n_missing
FROM shop_orders GROUP BY 1"""
ORACLES["delivered_not_arrived_by_month"] = with_tables(SHOP) + """
SELECT month(estimated)::INTEGER AS month, count(*) AS count_not_del
FROM shop_orders WHERE delivered IS NULL AND order_status = 'delivered' GROUP BY 1"""
ORACLES["missing_delivery_by_state"] = with_tables(SHOP) + """
SELECT c_nationkey::VARCHAR AS customer_state, count(*) AS n_missing
FROM shop_orders JOIN customer ON c_custkey = customer_id
WHERE delivered IS NULL AND order_status = 'delivered' GROUP BY 1"""
ORACLES["months_present"] = with_tables(SHOP) + """
SELECT DISTINCT strftime(approved, '%Y-%m') AS month FROM bought"""

FAVOURITE = SHOP + """,
favourite AS (
  SELECT product_id, weekday, prod_count FROM (
    SELECT l_partkey AS product_id, dayname(approved) AS weekday, count(*) AS prod_count,
      row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, dayname(approved)) AS rn
    FROM bought JOIN lineitem ON l_orderkey = order_id GROUP BY 1, 2)
  WHERE rn = 1)
"""
ORACLES["favourite_weekday"] = with_tables(FAVOURITE) + "SELECT * FROM favourite"
ORACLES["favourite_weekday_overall"] = (
    with_tables(FAVOURITE) + "SELECT weekday, count(*) AS n FROM favourite GROUP BY 1"
)


def _per_week(days: str) -> str:
    return with_tables(SHOP) + f"""
SELECT customer_unique_id, month, purchases, round({days} / 7.0::DOUBLE, 6) AS weeks,
  round(purchases / ({days} / 7.0::DOUBLE), 6) AS purchases_per_week
FROM (
  SELECT customer_unique_id, strftime(approved, '%Y-%m') AS month,
    any_value(day(last_day(approved))) AS days, any_value(month(approved)) AS number,
    count(*) AS purchases
  FROM bought GROUP BY 1, 2)"""


ORACLES["purchases_per_week"] = _per_week("days")
ORACLES["purchases_per_week_short_february"] = _per_week(
    "(CASE WHEN number = 2 THEN 28 ELSE days END)"
)

# --- cohorts --------------------------------------------------------------------------

COHORT = SHOP + f""",
cohort AS (
  SELECT first_month, (substr(month, 1, 4)::INTEGER * 12 + substr(month, 6, 2)::INTEGER
      - substr(first_month, 1, 4)::INTEGER * 12 - substr(first_month, 6, 2)::INTEGER)
      AS months_since, count(DISTINCT customer_unique_id) AS people
  FROM (
    SELECT customer_unique_id, strftime(approved, '%Y-%m') AS month,
      min(strftime(approved, '%Y-%m')) OVER (PARTITION BY customer_unique_id) AS first_month
    FROM bought)
  WHERE first_month BETWEEN '{FIRST_COHORT}' AND '{LAST_COHORT}'
  GROUP BY 1, 2),
started AS (SELECT first_month, people AS started FROM cohort WHERE months_since = 0),
retained AS (
  SELECT first_month, months_since, people, {percent('people', 'started')} AS retention
  FROM cohort JOIN started USING (first_month))
"""
ORACLES["cohort_counts"] = with_tables(COHORT) + "SELECT * FROM cohort"
ORACLES["cohort_retention"] = with_tables(COHORT) + "SELECT * FROM retained"
ORACLES["retention_from_bitmaps"] = ORACLES["cohort_retention"]
ORACLES["best_cohort"] = with_tables(COHORT) + """
SELECT first_month, retention FROM retained WHERE months_since = 3
ORDER BY retention DESC, first_month LIMIT 1"""
ORACLES["purchases_by_month_of_year"] = with_tables(SHOP) + """
SELECT year(approved)::INTEGER AS year, """ + ", ".join(
    f"nullif(count(*) FILTER (month(approved) = {i}), 0) AS m{i}" for i in range(1, 13)
) + " FROM bought GROUP BY 1"

# --- recency, frequency, monetary -----------------------------------------------------


def _score(value: str, column: str, scores: tuple[int, ...]) -> str:
    cases = " ".join(
        f"WHEN {value} <= {column}[{i + 1}] THEN {s}" for i, s in enumerate(scores[:4])
    )
    return f"CASE {cases} ELSE {scores[4]} END"


# Fixed values in the text: the five segment names.
RFM = SHOP + f""",
totals AS (SELECT l_orderkey AS order_id, sum(l_extendedprice) AS price FROM lineitem GROUP BY 1),
per_person AS (
  SELECT customer_unique_id, max(approved) AS last, count(*) AS Frequency,
    round(sum(price), 2) AS Monetary
  FROM bought JOIN totals USING (order_id) GROUP BY 1),
measures AS (
  SELECT customer_unique_id,
    floor((epoch((SELECT max(last) + INTERVAL 1 DAY FROM per_person)) - epoch(last)) / 86400)::INTEGER
      AS Recency, Frequency, Monetary
  FROM per_person),
cuts AS (
  SELECT quantile_cont(Recency::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS qr,
    quantile_cont(Frequency::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS qf,
    quantile_cont(Monetary, [0.2, 0.4, 0.6, 0.8]) AS qm, count(*) AS n
  FROM measures),
scored AS (
  SELECT m.*, {_score('Recency', 'qr', (5, 4, 3, 2, 1))}::INTEGER AS R,
    {_score('Frequency', 'qf', (1, 2, 3, 4, 5))}::INTEGER AS F,
    {_score('Monetary', 'qm', (1, 2, 3, 4, 5))}::INTEGER AS M
  FROM measures m, cuts),
coded AS (SELECT *, R * 100 + F * 10 + M AS RFM FROM scored),
named AS (
  SELECT *, CASE
    WHEN F = 1 AND R IN (1, 2, 3) THEN 'Одноразовые'
    WHEN F = 5 AND R IN (1, 2, 3) THEN 'Ушедшие'
    WHEN F = 1 AND R = 4 THEN 'Недавние'
    WHEN F = 5 AND R IN (4, 5) THEN 'Потенциально - постоянные'
    WHEN F = 1 AND R = 5 THEN 'Новенькие' END AS segment
  FROM coded)
"""
ORACLES["rfm_measures"] = with_tables(RFM) + "SELECT * FROM measures"
ORACLES["rfm_cuts"] = with_tables(RFM) + " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, n AS n_rows, "
    + ", ".join(f"{near(f'{column}[{i + 1}]', 4)} AS q{i}" for i in range(4))
    + " FROM cuts"
    for name, column in (("Recency", "qr"), ("Frequency", "qf"), ("Monetary", "qm"))
)
ORACLES["rfm_scores"] = with_tables(RFM) + "SELECT * FROM named"
ORACLES["rfm_segments"] = with_tables(RFM) + """
SELECT segment, count(*) AS n FROM named WHERE segment IS NOT NULL GROUP BY 1"""
ORACLES["rfm_code_counts"] = with_tables(RFM) + "SELECT RFM, count(*) AS n FROM named GROUP BY 1"
ORACLES["frequency_counts"] = with_tables(RFM) + """
SELECT Frequency, count(*) AS n FROM measures GROUP BY 1"""

# --- experiment -----------------------------------------------------------------------

METRICS = TRIAL + f""",
metrics AS (
  SELECT grp, count(*) AS count_id, count(*) FILTER (rev > 0) AS pay_id,
    {percent('count(*) FILTER (rev > 0)', 'count(*)')} AS cr,
    {even('avg(rev) FILTER (rev > 0)', 2)} AS mean_check
  FROM full_table WHERE grp IS NOT NULL GROUP BY 1)
"""
ORACLES["experiment_metrics"] = with_tables(METRICS) + "SELECT * FROM metrics"
ORACLES["experiment_full"] = with_tables(TRIAL) + """
SELECT id, grp, round(rev, 2) AS rev FROM full_table"""
ORACLES["group_sizes"] = with_tables(METRICS) + """
SELECT grp, 'all' AS label, count_id AS n_ids FROM metrics
UNION ALL SELECT grp, 'paying', pay_id FROM metrics WHERE pay_id > 0"""
ORACLES["orphan_payers"] = with_tables(TRIAL) + """
SELECT student_id, round(rev, 2) AS rev FROM checks
WHERE student_id NOT IN (SELECT student_id FROM active)"""
ORACLES["active_in_groups"] = with_tables(TRIAL) + """
SELECT * FROM grp_all WHERE id IN (SELECT student_id FROM active)"""
ORACLES["late_overlap"] = """
SELECT count(*) AS n_shared FROM customer WHERE c_mktsegment = 'MACHINERY'
  AND c_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')"""
ORACLES["repaired_active"] = with_tables(TRIAL) + "SELECT student_id FROM everyone"
ORACLES["null_profile"] = with_tables(SHOP) + " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count({column}) AS non_null, "
    f"count(*) - count({column}) AS nulls, '{kind}' AS data_type FROM shop_orders"
    for name, column, kind in (
        ("order_id", "order_id", "bigint"), ("customer_id", "customer_id", "bigint"),
        ("order_status", "order_status", "string"),
        ("order_approved_at", "approved", "timestamp_ntz"),
        ("order_delivered_customer_date", "delivered", "timestamp_ntz"),
        ("order_estimated_delivery_date", "estimated", "timestamp_ntz"),
    )
)
ORACLES["key_uniqueness"] = with_tables(TRIAL) + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys, "
    f"count(*) = count(DISTINCT {key}) AS is_unique FROM {source}"
    for name, key, source in (
        ("groups", "c_custkey", "customer WHERE c_mktsegment <> 'MACHINERY'"),
        ("group_add", "c_custkey", "customer WHERE c_mktsegment = 'MACHINERY'"),
        ("active", "student_id", "active"),
        ("checks", "student_id", "checks"),
        ("lines", "l_orderkey", "lineitem"),
    )
)


def _described(column: str, source: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, count({column}) AS n, {near(f'avg({column})', 4)} AS mean, "
        f"{near(f'stddev_samp({column})', 4)} AS std, {near(f'min({column})', 4)} AS min, "
        f"{near(f'max({column})', 4)} AS max, "
        + ", ".join(
            f"{near(f'quantile_cont({column}, {q / 100})', 4)} AS q{q}" for q in (25, 50, 75)
        )
        + f" FROM {source}"
    )


ORACLES["describe_payments"] = with_tables(TRIAL) + _described("rev", "checks")
ORACLES["describe_lines"] = " UNION ALL ".join(
    _described(c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount")
)

CELLS = ("a_yes", "a_no", "b_yes", "b_no")


def _expected(cell: str) -> str:
    row, column = cell.split("_")
    return f"(({row}_yes + {row}_no)::DOUBLE * (a_{column} + b_{column}) / (a_yes + a_no + b_yes + b_no))"


ORACLES["conversion_readout"] = with_tables(TRIAL, f"""
cells AS (
  SELECT count(*) FILTER (grp = 'A' AND rev > 0) AS a_yes,
    count(*) FILTER (grp = 'A' AND NOT rev > 0) AS a_no,
    count(*) FILTER (grp = 'B' AND rev > 0) AS b_yes,
    count(*) FILTER (grp = 'B' AND NOT rev > 0) AS b_no FROM full_table),
tested AS (
  SELECT *, {" + ".join(f"pow(greatest(abs({c} - {_expected(c)}) - 0.5::DOUBLE, 0), 2) / {_expected(c)}"
                       for c in CELLS)} AS chi2 FROM cells),
rooted AS (SELECT *, sqrt(chi2) AS z FROM tested),
valued AS (SELECT *, 2 * {tail('z')} AS p FROM rooted)
""") + f"""
SELECT {", ".join(CELLS)}, {", ".join(f"{near(_expected(c), 6)} AS expected_{c}" for c in CELLS)},
  {near('chi2', 6)} AS chi2, 1 AS dof, {near('p', 6)} AS p_value, {verdict('p')} FROM valued"""


def _readout(parts: list[str]) -> str:
    union = " UNION ALL ".join(parts)
    return (
        f"SELECT test, {near('statistic', 4)} AS statistic, {near('p', 4)} AS p_value, "
        f"{verdict('p')} FROM ({union})"
    )


def _tested(name: str, source: str, statistic: str, z: str = "z") -> str:
    return (
        f"SELECT '{name}' AS test, {statistic} AS statistic, "
        f"least(1::DOUBLE, 2 * (CASE WHEN {z} >= 0 THEN {tail(z)} ELSE 1 - {tail(z)} END)) AS p "
        f"FROM {source}"
    )


ORACLES["average_check_readout"] = with_tables(
    TRIAL,
    "payers AS (SELECT * FROM full_table WHERE rev > 0)",
    replicates_cte("payers", "rev", "grp", "'A'", "'B'", "id", 1, "mean"),
    "boot_z AS (SELECT avg(difference) AS mean, abs(avg(difference) / stddev_pop(difference)) AS z "
    "FROM replicates)",
    f"normal AS ({normality('payers', 'rev', 'grp')})",
    f"u AS ({u_test('payers', 'rev', 'grp', chr(39) + 'A' + chr(39), chr(39) + 'B' + chr(39))})",
) + _readout([
    "SELECT 'normality ' || grp AS test, k2 AS statistic, exp(-k2 / 2) AS p FROM normal",
    _tested("bootstrap mean", "boot_z", "mean"),
    _tested("mann-whitney", "u", "u"),
])

ORACLES["check_distribution"] = with_tables(
    TRIAL, "payers AS (SELECT * FROM full_table WHERE rev > 0)"
) + histogram("payers", "rev", 50, 2, by="grp", density=True)

FEATURES = PLATFORM + """,
correct AS (
  SELECT st_id, sum(correct) AS correct, sum(correct) FILTER (subject = 'Math') AS correct_subject
  FROM answers GROUP BY 1),
bought_of AS (
  SELECT st_id, sum(money) AS money, max((subject = 'Math')::INTEGER) AS bought_subject
  FROM paid GROUP BY 1),
features AS (
  SELECT s.st_id, test_grp, coalesce(correct, 0)::BIGINT AS correct,
    coalesce(correct_subject, 0)::BIGINT AS correct_subject, coalesce(money, 0) AS money,
    (money IS NOT NULL)::INTEGER AS bought, coalesce(bought_subject, 0)::INTEGER AS bought_subject
  FROM students s LEFT JOIN correct USING (st_id) LEFT JOIN bought_of USING (st_id))
"""
ORACLES["student_features"] = with_tables(FEATURES) + """
SELECT * REPLACE (round(money, 2) AS money) FROM features"""
ORACLES["platform_metrics"] = with_tables(FEATURES) + f"""
SELECT test_grp, {even('sum(money) / count(*)', 2)} AS arpu,
  {even('sum(money) / nullif(count(*) FILTER (correct > 10), 0)', 2)} AS arpau,
  {percent('count(*) FILTER (bought = 1)', 'count(*)')} AS cr,
  {percent('count(*) FILTER (correct > 10 AND bought = 1)', 'count(*) FILTER (correct > 10)')}
    AS cr_active,
  {percent('count(*) FILTER (correct_subject >= 2 AND bought_subject = 1)',
           'count(*) FILTER (correct_subject >= 2)')} AS cr_active_subject
FROM features GROUP BY 1"""


def _diligent(keys: str) -> str:
    return with_tables(PLATFORM) + f"""
SELECT count(*) AS count_id FROM (
  SELECT {keys} FROM answers GROUP BY {keys}
  HAVING sum(correct) >= 20 AND date_diff('month', min(timest), max(timest)) < 1)"""


ORACLES["diligent_students"] = _diligent("st_id")
ORACLES["diligent_by_subject"] = _diligent("st_id, subject")
ORACLES["diligent_monthly"] = with_tables(PLATFORM) + """
SELECT count(DISTINCT st_id) AS count_id FROM (
  SELECT st_id FROM answers GROUP BY st_id, date_trunc('month', timest) HAVING sum(correct) >= 20)"""

ORACLES["math_students"] = with_tables(PLATFORM) + """
SELECT st_id, sum(correct)::BIGINT AS correct, min(timest) AS first_time, max(timest) AS last_time
FROM answers WHERE subject = 'Math' GROUP BY st_id HAVING sum(correct) >= 2"""
ORACLES["buyers_per_month"] = with_tables(SHOP) + """
SELECT strftime(approved, '%Y-%m') AS month, count(DISTINCT customer_id) AS n_distinct
FROM bought GROUP BY 1"""

# --- statistics -----------------------------------------------------------------------

FLAG_MOMENTS = (
    "base AS (" + moments("lineitem", "l_extendedprice", "l_returnflag", "'A'", "'R'") + ")"
)


def _t_test(formula: str) -> str:
    return with_tables(FLAG_MOMENTS, f"tested AS (SELECT *, {formula} FROM base)") + f"""
SELECT n1, n2, {near('m1', 6)} AS m1, {near('m2', 6)} AS m2, {near('t', 6)} AS t,
  {near('df', 6)} AS df, {near(t_p('t', 'df'), 6)} AS p_value FROM tested"""


ORACLES["student_t_test"] = _t_test(STUDENT)
ORACLES["welch_t_test"] = _t_test(WELCH)
ORACLES["normality"] = f"""
SELECT grp AS l_returnflag, n::BIGINT AS n, {near('z_skew', 5)} AS z_skew,
  {near('z_kurt', 5)} AS z_kurt, {near('k2', 5)} AS k2, {near('exp(-k2 / 2)', 5)} AS p_value
FROM ({normality('lineitem', 'l_extendedprice', 'l_returnflag')})"""
# Ways of u for n1 and n2 values: the largest value belongs to one sample or the other.
ORACLES["customer_price_u_tests"] = with_tables(f"""
o AS (SELECT o_custkey, o_orderstatus = 'O' AS one, o_totalprice AS v FROM orders WHERE o_orderstatus IN ('O', 'F')),
r AS (
  SELECT *, count(*) OVER (PARTITION BY o_custkey, v) AS t,
    rank() OVER (PARTITION BY o_custkey ORDER BY v) + (count(*) OVER (PARTITION BY o_custkey, v) - 1) / 2.0::DOUBLE AS rk
  FROM o),
s AS (
  SELECT o_custkey, count(*) FILTER (one) AS n1, count(*) FILTER (NOT one) AS n2,
    sum(rk) FILTER (one) - n1::DOUBLE * (n1 + 1) / 2 AS u, sum((t::DOUBLE * t * t - t) / t) AS tie_sum
  FROM r GROUP BY 1 HAVING n1 > 0 AND n2 > 0),
z AS (
  SELECT *, greatest(u, n1 * n2 - u) AS side, (side - n1::DOUBLE * n2 / 2 - 0.5::DOUBLE)
    / sqrt(n1::DOUBLE * n2 / 12 * ((n1 + n2 + 1) - tie_sum / ((n1 + n2)::DOUBLE * (n1 + n2 - 1)))) AS z,
    least(n1, n2) <= 8 AND tie_sum = 0 AS exact
  FROM s),
most AS (SELECT max(n1 + n2) AS top FROM z WHERE exact),
ways AS (
  SELECT 0::BIGINT AS m, 0::BIGINT AS n, 0::BIGINT AS u, 1::DOUBLE AS w
  UNION ALL
  SELECT m, n, u, sum(w)::DOUBLE FROM (
    SELECT m + 1 AS m, n, u + n AS u, w FROM ways, most WHERE m + n < top
    UNION ALL
    SELECT m, n + 1, u, w FROM ways, most WHERE m + n < top) GROUP BY m, n, u),
tail AS (
  SELECT o_custkey, sum(w) FILTER (ways.u >= side) / sum(w) AS p
  FROM z JOIN ways ON ways.m = n1 AND ways.n = n2 WHERE exact GROUP BY 1)
""") + f"""
SELECT o_custkey, n1, n2, {near('u', 6)} AS u, {near('z', 6)} AS z, exact,
  {near(f"least(1.0::DOUBLE, 2 * CASE WHEN exact THEN p ELSE {tail('z')} END)", 6)} AS p_value
FROM z LEFT JOIN tail USING (o_custkey)"""
ORACLES["mann_whitney"] = with_tables(
    f"u AS ({u_test('lineitem', 'l_extendedprice', 'l_returnflag', chr(39) + 'A' + chr(39), chr(39) + 'R' + chr(39))})"
) + f"""
SELECT n1, n2, {near('u', 6)} AS u, {near('z', 6)} AS z,
  {near('least(1::DOUBLE, 2 * (CASE WHEN z >= 0 THEN ' + tail('z') + ' ELSE 1 - ' + tail('z') + ' END))', 6)}
    AS p_value FROM u"""
ORACLES["ranked_quantities"] = """
SELECT l_quantity, na, nb, na + nb AS ties,
  coalesce(sum(na + nb) OVER (ORDER BY l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    + (na + nb + 1) / 2::DOUBLE AS average_rank
FROM (SELECT l_quantity, count(*) FILTER (l_returnflag = 'A') AS na,
        count(*) FILTER (l_returnflag <> 'A') AS nb FROM lineitem GROUP BY 1)"""
ORACLES["price_quantiles"] = (
    "SELECT l_returnflag, count(*) AS n_rows, "
    + ", ".join(
        f"{near(f'quantile_cont(l_extendedprice, {q})', 4)} AS q{i}"
        for i, q in enumerate((0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0))
    )
    + " FROM lineitem GROUP BY 1"
)
ORACLES["price_histogram"] = histogram("lineitem", "l_extendedprice", 50, 4)
ORACLES["priority_bars"] = """
SELECT o_orderpriority, o_orderstatus, count(*) AS bar FROM orders GROUP BY 1, 2"""
ORACLES["priority_mean_bars"] = f"""
SELECT o_orderpriority, o_orderstatus, {near('avg(o_totalprice)', 4)} AS bar
FROM orders GROUP BY 1, 2"""
ORACLES["decimal_comma_totals"] = with_tables(AB) + """
SELECT variant AS "experimentVariant", count(*) AS n,
  round(sum(replace(replace(value::VARCHAR, '.', ','), ',', '.')::DOUBLE), 2) AS total
FROM ab GROUP BY 1"""

T, C = "'Treatment'", "'Control'"


def _ab_replicates(statistic: str, seed: int = SEED) -> str:
    return AB + "," + replicates_cte("ab", "value", "variant", T, C, "number", seed, statistic)


for _statistic in ("mean", "median"):
    ORACLES[f"bootstrap_{_statistic}_replicates"] = with_tables(_ab_replicates(_statistic)) + f"""
SELECT replicate::INTEGER AS replicate, {near('difference', 4)} AS difference FROM replicates"""
    ORACLES[f"bootstrap_{_statistic}"] = with_tables(_ab_replicates(_statistic), BOOT_SUMMARY) + f"""
SELECT n_replicates, {near('mean', 4)} AS mean, {near('sd', 4)} AS sd,
  {near('ci_low', 4)} AS ci_low, {near('ci_high', 4)} AS ci_high,
  {near('2 * ' + tail('z'), 4)} AS p_value, ci_low <= 0 AND ci_high >= 0 AS zero_inside
FROM summary"""
# A count of c rows is a sum of Poisson counts, one of mean 2^k for each binary digit k of c.
QUANTITIES = f"""
value AS (
  SELECT CASE l_returnflag WHEN 'R' THEN 'a' ELSE 'b' END AS side, l_quantity::DOUBLE AS v, count(*) AS c,
    (l_quantity * 100)::BIGINT * 2 + (l_returnflag = 'A')::BIGINT AS key
  FROM lineitem WHERE l_returnflag IN ('R', 'A') AND l_quantity IS NOT NULL GROUP BY 1, 2, 4),
part AS (
  SELECT k, unnest(range(greatest(0, floor(m - reach))::BIGINT, ceil(m + reach)::BIGINT + 1)) AS x, m
  FROM (SELECT k, pow(2.0::DOUBLE, k) AS m, 10 * sqrt(m) + 10 AS reach FROM range(0, 40) t(k)
    WHERE k <= (SELECT log2(max(c)) FROM value))),
cut AS (
  SELECT k, x, floor(sum(exp(x * ln(m) - m - lgamma(x + 1))) OVER (PARTITION BY k ORDER BY x)
    * 9007199254740992::DOUBLE) AS cut
  FROM part),
digit AS (SELECT *, {hashed('key', SEED, 'h')} FROM value, range(0, 40) t(k) WHERE (c >> k) & 1 = 1),
draw AS (
  SELECT side, v, k, replicate, {drawn('h', '(replicate::BIGINT * 64 + k)', 'd0')}, {finely('h', 'd0', 'd')}
  FROM (SELECT *, unnest(range(1, {REPLICATES} + 1)) AS replicate FROM digit)),
top AS (SELECT *, coalesce(lag(cut) OVER (PARTITION BY k ORDER BY x), -1) AS below FROM cut),
weight AS (
  SELECT replicate, side, v, sum(x) AS w FROM draw JOIN top ON top.k = draw.k AND d >= below AND d < cut
  GROUP BY 1, 2, 3)
"""
ORACLES["bootstrap_quantity_replicates"] = with_tables(QUANTITIES) + f"""
SELECT replicate::INTEGER AS replicate, {near("""sum(w * v) FILTER (side = 'a') / sum(w) FILTER (side = 'a')
    - sum(w * v) FILTER (side = 'b') / sum(w) FILTER (side = 'b')""", 6)} AS difference
FROM weight GROUP BY replicate"""
ORACLES["bootstrap_quantity_medians"] = with_tables(QUANTITIES) + """,
placed AS (
  SELECT *, sum(w) OVER (PARTITION BY replicate, side ORDER BY v) AS upto,
    sum(w) OVER (PARTITION BY replicate, side) AS total
  FROM weight WHERE w > 0),
middle AS (
  SELECT replicate, side, (min(v) FILTER (upto > (total - 1) // 2) + min(v) FILTER (upto > total // 2)) / 2 AS m
  FROM placed GROUP BY 1, 2)
SELECT replicate::INTEGER AS replicate, round(max(m) FILTER (side = 'a') - max(m) FILTER (side = 'b'), 4) AS difference
FROM middle GROUP BY 1"""
ORACLES["bootstrap_histogram"] = with_tables(_ab_replicates("mean"), BOOT_SUMMARY) + f"""
SELECT bin, n, {near('l', 4)} AS bin_left, {near('r', 4)} AS bin_right,
  l <= ci_low OR l >= ci_high AS tail
FROM (
  SELECT bin, count(*) AS n, any_value(lo + ((hi - lo) / 50) * (bin - 1)) AS l,
    any_value(lo + ((hi - lo) / 50) * bin) AS r
  FROM (
    SELECT lo, hi, least(floor((difference - lo) / (hi - lo) * 50) + 1, 50)::INTEGER AS bin
    FROM replicates, (SELECT min(difference) AS lo, max(difference) AS hi FROM replicates))
  GROUP BY bin), summary"""
ORACLES["outlier_cut"] = with_tables(AB) + f"""
SELECT variant AS "experimentVariant", count(*) AS n, round(max(value), 2) AS largest
FROM ab WHERE variant <> 'Treatment' OR value < {PRICE_CUT} GROUP BY 1"""
ORACLES["ab_readout"] = with_tables(
    _ab_replicates("median", 1),
    f"ab_cut AS (SELECT * FROM ab WHERE variant <> 'Treatment' OR value < {PRICE_CUT})",
    "boot_z AS (SELECT avg(difference) AS mean, abs(avg(difference) / stddev_pop(difference)) AS z "
    "FROM replicates)",
    f"normal AS ({normality('ab', 'value', 'variant')})",
    f"normal_cut AS ({normality('ab_cut', 'value', 'variant')})",
    f"t_all AS (SELECT {STUDENT} FROM ({moments('ab', 'value', 'variant', T, C)}))",
    f"t_cut AS (SELECT {STUDENT} FROM ({moments('ab_cut', 'value', 'variant', T, C)}))",
    f"u AS ({u_test('ab', 'value', 'variant', T, C)})",
) + _readout([
    "SELECT 'normality ' || grp AS test, k2 AS statistic, exp(-k2 / 2) AS p FROM normal "
    "WHERE grp <> 'Other'",
    f"SELECT 't test' AS test, t AS statistic, {t_p('t', 'df')} AS p FROM t_all",
    _tested("mann-whitney", "u", "u"),
    _tested("bootstrap median", "boot_z", "mean"),
    "SELECT 'normality after cut ' || grp AS test, k2 AS statistic, exp(-k2 / 2) AS p "
    "FROM normal_cut WHERE grp = 'Treatment'",
    f"SELECT 't test after cut' AS test, t AS statistic, {t_p('t', 'df')} AS p FROM t_cut",
])


def _simulation(clean: bool) -> str:
    where = "WHERE version <> 'v2.8.0'" if clean else ""
    spare = SAMPLE_SIZE + 8 * math.sqrt(SAMPLE_SIZE) + 20
    place = "j::BIGINT"
    for shift in (0, 8, 16):
        place = (f"(SELECT xor(y, y >> ((bits + 1) // 2)) FROM (SELECT ((({place} + (key >> {shift})) & mask) "
                 f"* (((other >> {shift}) | 1) & mask)) & mask AS y))")
    sampled = f"""
aa_rows AS (SELECT number, variant, purchase, {hashed('number', SEED, 'h')} FROM aa {where}),
aa_share AS (SELECT variant, least(1.0::DOUBLE, {spare!r}::DOUBLE / count(*)) AS share FROM aa_rows GROUP BY 1),
aa_bits AS (
  SELECT greatest(0, least({(SIMULATIONS - 1).bit_length()}, floor(log2(8.0::DOUBLE / max(share)))))::BIGINT AS bits
  FROM aa_share),
aa_part AS (
  SELECT variant, share, 0 AS k, pow(1 - share, 1 << bits) AS part, pow(1 - share, 1 << bits) AS total
  FROM aa_share, aa_bits
  UNION ALL
  SELECT variant, share, k + 1,
    CASE WHEN share < 1 THEN part * ((1 << bits) - k) / (k + 1) * share / (1 - share) ELSE 0 END,
    total + CASE WHEN share < 1 THEN part * ((1 << bits) - k) / (k + 1) * share / (1 - share) ELSE 0 END
  FROM aa_part, aa_bits WHERE k + 1 < (1 << bits)),
aa_cuts AS (
  SELECT variant, list(floor(total * 9007199254740992::DOUBLE)::BIGINT ORDER BY k) AS cuts
  FROM aa_part GROUP BY 1),
aa_blocks AS (
  SELECT *, {drawn('h', '(-1 - block)', 'b0')}, {finely('h', 'b0', 'fine')},
    {mixed(f"(b0 + {2 * GOLDEN_STEP}) & {MASK32}", 'key')}, {mixed("xor(key, h)", 'other')}
  FROM (SELECT *, unnest(range(0, ({SIMULATIONS} + (1 << bits) - 1) >> bits)) AS block FROM aa_rows, aa_bits)),
aa_wanted AS (
  SELECT *, (1 << bits) - 1 AS mask, unnest(range(0, len([c FOR c IN cuts IF c <= fine]))) AS j
  FROM aa_blocks JOIN aa_cuts USING (variant)),
aa_drawn AS (
  SELECT number, variant, purchase, replicate, h_b, {drawn('h', 'replicate', 'd0')},
    {finely('h', 'd0', 'd')}
  FROM (SELECT *, block * (1 << bits) + {place} + 1 AS replicate FROM aa_wanted)
  WHERE replicate <= {SIMULATIONS}),
sampled AS (
  SELECT * FROM aa_drawn
  QUALIFY row_number() OVER (PARTITION BY replicate, variant ORDER BY d, h_b, number)
    <= {SAMPLE_SIZE}),
sim_moments AS ({moments('sampled', 'purchase', 'variant', '1', '0', 'replicate')}),
sim_t AS (SELECT *, {WELCH} FROM sim_moments),
simulated AS (SELECT *, {t_p('t', 'df')} AS p FROM sim_t)
"""
    return with_tables(AA, sampled)


ORACLES["aa_simulation"] = _simulation(False) + f"""
SELECT replicate::INTEGER AS replicate, n1, n2, {near('m1', 6)} AS m1, {near('m2', 6)} AS m2,
  {near('t', 6)} AS t, {near('df', 6)} AS df, {near('p', 6)} AS p_value FROM simulated"""
for _name, _clean in (("aa_audit", False), ("aa_audit_without_version", True)):
    ORACLES[_name] = _simulation(_clean) + f"""
SELECT count(*) AS simulations, {near('avg((p < 0.05)::INTEGER)', 6)} AS fpr FROM simulated"""
ORACLES["aa_p_value_histogram"] = _simulation(True) + histogram(
    f"(SELECT {near('p', 6)} AS p_value FROM simulated)", "p_value", 50, 6
)
ORACLES["version_means"] = with_tables(AA) + """
SELECT version, round(avg(purchase), 6) AS mean FROM aa GROUP BY 1"""
ORACLES["version_variant_means"] = with_tables(AA) + """
SELECT version, variant AS "experimentVariant", round(avg(purchase), 6) AS mean FROM aa GROUP BY 1, 2"""

# --- transfers and graph --------------------------------------------------------------

ORACLES["in_window_transfers"] = with_tables(PAYMENTS) + """
SELECT * FROM dated WHERE diff_time BETWEEN -1 AND 7"""
ORACLES["known_pairs"] = with_tables(PAYMENTS) + """
SELECT DISTINCT id_sender, id_receiver, 'known link' AS flag FROM dated
WHERE diff_time < -1 OR diff_time > 7"""
ORACLES["link_cleaning"] = with_tables(PAYMENTS) + "SELECT * FROM cleaned"


def _whole(hash_column: str, low: int, high: int) -> str:
    return f"(floor({uniform(hash_column)} * {high - low + 1}) + {low})::INTEGER"


ORACLES["issue_dates"] = with_tables(PAYMENTS, f"""
senders AS (
  SELECT id_sender, {hashed('id_sender', SEED, 'hy')},
    {hashed('id_sender', SEED + 1, 'hm')}, {hashed('id_sender', SEED + 2, 'hd')}
  FROM (SELECT DISTINCT id_sender FROM all_transfers)),
parts AS (
  SELECT id_sender, {_whole('hy', 2023, 2024)} AS y, {_whole('hm', 1, 12)} AS m,
    {_whole('hd', 1, 31)} AS d FROM senders)
""") + """
SELECT id_sender, make_date(y, m,
  CASE WHEN d > day(last_day(make_date(y, m, 1))) THEN 28 ELSE d END) AS date_cred FROM parts"""

ORACLES["transfer_edges"] = with_tables(PAYMENTS, EDGES) + "SELECT * FROM edges"
ORACLES["trade_edges"] = with_tables(PAYMENTS, TRADE_EDGES) + "SELECT * FROM edges"
ORACLES["graph_size"] = with_tables(PAYMENTS, EDGES) + """
SELECT (SELECT count(*) FROM (SELECT src FROM edges UNION SELECT dst FROM edges)) AS n_nodes,
  (SELECT count(*) FROM edges) AS n_edges"""
ROLES = """
roles AS (
  SELECT node, bool_or(r) AS is_receiver, CASE WHEN bool_or(r) THEN 'red' ELSE 'blue' END AS color,
    (CASE WHEN bool_or(r) THEN 500 ELSE 300 END)::INTEGER AS size, node AS label
  FROM (SELECT src AS node, false AS r FROM edges UNION ALL SELECT dst, true FROM edges)
  GROUP BY node)
"""
ORACLES["node_roles"] = with_tables(PAYMENTS, EDGES, ROLES) + "SELECT * FROM roles"
EDGE_CUTS = "edge_cuts AS (SELECT quantile_cont(amount, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS q FROM edges)"
WIDTH = """CASE WHEN amount <= q[1] THEN 0.1 WHEN amount <= q[2] THEN 0.3 WHEN amount <= q[3] THEN 0.5
  WHEN amount <= q[4] THEN 1 WHEN amount <= q[5] THEN 2 WHEN amount <= q[6] THEN 3 ELSE 5 END::DOUBLE"""
ORACLES["edge_widths"] = with_tables(PAYMENTS, EDGES, EDGE_CUTS) + f"""
SELECT src, dst, amount, {WIDTH} AS width FROM edges, edge_cuts"""
ORACLES["edge_widths_as_written"] = with_tables(PAYMENTS, EDGES, EDGE_CUTS) + """
SELECT src, dst, amount, (CASE WHEN amount <= q[1] THEN 0.1 ELSE 0.3 END)::DOUBLE AS width
FROM edges, edge_cuts"""
ORACLES["trade_edge_widths"] = with_tables(PAYMENTS, TRADE_EDGES, EDGE_CUTS) + f"""
SELECT {WIDTH} AS width, count(*) AS n_edges FROM edges, edge_cuts GROUP BY 1"""
ORACLES["connected_components"] = with_tables(PAYMENTS, EDGES, COMPONENTS) + """
SELECT node, component FROM components"""
ORACLES["trade_components"] = with_tables(PAYMENTS, TRADE_EDGES, COMPONENTS) + """
SELECT component, count(*) AS n_nodes FROM components GROUP BY 1"""
ORACLES["component_totals"] = with_tables(PAYMENTS, EDGES, COMPONENTS) + """
SELECT component, n_nodes, n_edges, amount
FROM (SELECT component, count(*) AS n_nodes FROM components GROUP BY 1)
JOIN (SELECT component, count(*) AS n_edges, round(sum(amount), 2) AS amount
      FROM edges JOIN components ON node = src GROUP BY 1) USING (component)"""
ORACLES["component_subgraphs"] = with_tables(PAYMENTS, EDGES, COMPONENTS) + """
SELECT component, src, dst, amount FROM edges JOIN components ON node = src"""
ORACLES["component_nodes"] = with_tables(PAYMENTS, EDGES, COMPONENTS, ROLES) + """
SELECT component, node, color, size, label FROM roles JOIN components USING (node)"""

ORACLES["exported_components"] = with_tables(PAYMENTS, EDGES, COMPONENTS) + """
SELECT component, count(*) AS n, 'nodes' AS written FROM components GROUP BY 1
UNION ALL SELECT component, count(*), 'edges' FROM edges JOIN components ON node = src GROUP BY 1"""

# --- files ----------------------------------------------------------------------------

for _name in ("orders_through_csv", "orders_through_semicolons"):
    ORACLES[_name] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::DATE AS day FROM orders"""
ORACLES["domains_through_csv"] = with_tables(DOMAINS) + "SELECT rank, domain FROM domains"
ORACLES["landed_customers"] = "SELECT c_custkey, c_name FROM customer"
ORACLES["features_through_csv"] = "SELECT p_partkey, p_size::INTEGER AS p_size FROM part"
ORACLES["first_orders"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%d.%m.%Y %H:%M:%S') AS day
FROM orders ORDER BY o_orderkey LIMIT 5"""
ORACLES["orders_above_mean"] = """
SELECT count(*) AS n FROM orders
WHERE o_totalprice > (SELECT round(avg(o_totalprice), 4) FROM orders)"""
ORACLES["part_names_without_letter"] = """
SELECT p_partkey, CASE WHEN contains(p_name, 'e') THEN
    left(p_name, strpos(p_name, 'e') - 1) || substr(p_name, strpos(p_name, 'e') + 1)
  ELSE p_name END AS name FROM part"""

# --- domains, people, pages, films ----------------------------------------------------

ZONE = "regexp_extract(domain, '([^.]*)$', 1)"
TOP = f"""
top AS (SELECT {ZONE} AS zone, count(*) AS n FROM domains GROUP BY 1 ORDER BY n DESC, zone LIMIT 10),
longest AS (
  SELECT rank, domain, length(domain)::INTEGER AS len_domain FROM domains
  ORDER BY len_domain DESC, domain, rank LIMIT 1)
"""
ORACLES["top_zones"] = with_tables(DOMAINS, TOP) + "SELECT * FROM top"
ORACLES["longest_domain"] = with_tables(DOMAINS, TOP) + "SELECT * FROM longest"
ORACLES["domain_rank"] = with_tables(DOMAINS) + f"""
SELECT rank FROM domains WHERE domain = '{LOOKUP_DOMAIN}'"""
ORACLES["domain_report"] = with_tables(DOMAINS, TOP) + f"""
SELECT '{REPORT_DATE}' AS ds, 'top zones' AS section, zone AS key, n::VARCHAR AS value FROM top
UNION ALL SELECT '{REPORT_DATE}', 'longest domain', domain, len_domain::VARCHAR FROM longest
UNION ALL SELECT '{REPORT_DATE}', 'domain rank', domain, rank::VARCHAR FROM domains
  WHERE domain = '{LOOKUP_DOMAIN}'"""
_REPORT = ORACLES["domain_report"].removeprefix(with_tables(DOMAINS, TOP))
_FEWER = with_tables(DOMAINS, TOP).replace("WITH RECURSIVE ", "WITH ", 1).replace("FROM domains", "FROM (SELECT * FROM domains WHERE rank <= 100)")
ORACLES["published_reports"] = f"""
SELECT * FROM ({_FEWER} {_REPORT.replace("FROM domains", "FROM (SELECT * FROM domains WHERE rank <= 100)")})
UNION ALL SELECT * FROM ({ORACLES["domain_report"].replace(REPORT_DATE, NEXT_DATE)})"""
ORACLES["orders_with_rejects"] = """
WITH o AS (
  SELECT o_orderkey AS k, CASE
    WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 THEN 'rejected order'
    WHEN o_orderkey % 83 = 0 THEN 'rejected text'
    WHEN o_orderkey % 79 = 0 OR o_orderkey % 73 = 0 THEN 'rejected order' ELSE 'good' END AS side
  FROM orders)
SELECT side, count(*) AS lines, CASE side WHEN 'rejected text' THEN 1 ELSE count(DISTINCT k) END AS different,
  CASE side WHEN 'rejected text' THEN NULL ELSE sum(k)::BIGINT END AS keys
FROM o GROUP BY 1"""
ORACLES["sales_rank"] = """
SELECT id, name, sale_count, rank() OVER (ORDER BY sale_count) AS sale_rank FROM (
  SELECT c_custkey AS id, c_name AS name, count(*) AS sale_count
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)"""
ORACLES["name_parts"] = """
SELECT p_partkey, split_part(p_name, ' ', 2) AS first_name, split_part(p_name, ' ', 1) AS last_name,
  split_part(p_name, ' ', 3) AS patronymic FROM part"""

# Pages are cut at every "<" here, and an element ends at the first later piece that closes
# it: found by joining starts to ends, where the queries scan token arrays.
BLOCK_TAGS = (
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol pre section table "
    "tbody td tfoot th thead tr ul"
).split()
PIECES = r"""
shown AS (
  SELECT page_id, regexp_replace(html,
    '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g') AS html FROM pages),
cut AS (
  SELECT page_id, unnest(string_split(html, '<')) AS piece,
    generate_subscripts(string_split(html, '<'), 1) AS i FROM shown),
pieces AS (
  SELECT page_id, i, lower(regexp_extract(piece, '^(/?[a-zA-Z][^\s/>]*)', 1)) AS name,
    CASE WHEN i = 1 THEN '' ELSE substr(piece, 1, strpos(piece, '>')) END AS tag,
    CASE WHEN i = 1 THEN piece ELSE substr(piece, strpos(piece, '>') + 1) END AS text
  FROM cut)
"""


def plain(text: str) -> str:
    """Decoded and trimmed text; the entities are those that the tables hold."""
    for entity, character in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
        ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"),
    ):
        text = f"replace({text}, '{entity}', '{character}')"
    return f"trim({text}, E' \\n\\t\\r')"


def elements(tag: str, name: str, condition: str = "true") -> str:
    """``name(page_id, position, tag, text)`` of the elements that meet a condition on ``tag``."""
    if tag == "p":
        closers = ", ".join(f"'{x}', '/{x}'" for x in ["p", *BLOCK_TAGS])
        ends = f"SELECT page_id, i, 0 AS depth FROM pieces WHERE name IN ({closers})"
        starts = "SELECT page_id, i, tag, 0 AS depth FROM pieces WHERE name = 'p'"
        closes = "true"
    else:
        level = (
            f"sum(CASE name WHEN '{tag}' THEN 1 WHEN '/{tag}' THEN -1 ELSE 0 END) "
            "OVER (PARTITION BY page_id ORDER BY i)"
        )
        ends = f"SELECT page_id, i, {level} AS depth FROM pieces"
        starts = (
            f"SELECT * FROM (SELECT page_id, i, tag, name, {level} AS depth FROM pieces) "
            f"WHERE name = '{tag}'"
        )
        closes = "e.depth < s.depth"
    return f"""
{name}_starts AS ({starts}),
{name}_ends AS ({ends}),
{name}_spans AS (
  SELECT s.page_id, s.i, any_value(s.tag) AS tag, coalesce(min(e.i), 1000000000) AS stop
  FROM {name}_starts s LEFT JOIN {name}_ends e
    ON e.page_id = s.page_id AND e.i > s.i AND {closes}
  WHERE {condition} GROUP BY s.page_id, s.i),
{name} AS (
  SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INTEGER AS position,
    tag, {plain('text')} AS text
  FROM (
    SELECT x.page_id, x.i, any_value(x.tag) AS tag, string_agg(p.text, '' ORDER BY p.i) AS text
    FROM {name}_spans x JOIN pieces p ON p.page_id = x.page_id AND p.i >= x.i AND p.i < x.stop
    GROUP BY x.page_id, x.i))
"""


NO_CLASS = "s.tag NOT LIKE '%class=%'"
AD = """s.tag LIKE '%class="ad"%'"""
FOUND = "SELECT page_id, position, text FROM found"
ORACLES["page_titles"] = with_tables(PIECES, elements("h1", "found")) + FOUND
ORACLES["page_paragraphs"] = with_tables(PIECES, elements("p", "found", NO_CLASS)) + FOUND
ORACLES["page_ads"] = with_tables(PIECES, elements("div", "found", AD)) + FOUND

LINKS = elements("a", "anchors", "s.tag LIKE '%href=%'") + r""",
links_found AS (
  SELECT page_id, position, regexp_extract(tag, 'href="([^"]*)"', 1) AS link, text AS title
  FROM anchors)
"""
ORACLES["page_links"] = with_tables(PIECES, LINKS) + "SELECT * FROM links_found"
ORACLES["page_records"] = with_tables(
    PIECES,
    elements("h1", "titles"),
    elements("li", "items", NO_CLASS),
    elements("div", "ads", AD),
    elements("p", "infos", NO_CLASS),
) + """
SELECT page_id, position, t.text AS title, i.text AS item, a.text AS ad, p.text AS info
FROM titles t FULL JOIN items i USING (page_id, position) FULL JOIN ads a USING (page_id, position)
  FULL JOIN infos p USING (page_id, position)
WHERE position < 14"""
ORACLES["page_pairs"] = with_tables(
    PIECES, elements("li", "items", NO_CLASS), elements("p", "infos", NO_CLASS)
) + """
SELECT page_id, position, i.text AS item, p.text AS info
FROM items i JOIN infos p USING (page_id, position)"""
ORACLES["page_link_items"] = with_tables(PIECES, LINKS, elements("li", "items")) + """
SELECT page_id, position, link, i.text AS title
FROM links_found JOIN items i USING (page_id, position)"""
ORACLES["page_result_message"] = with_tables(PIECES, LINKS) + """
SELECT page_id, coalesce(n, 0)::INTEGER AS n_found,
  CASE WHEN coalesce(n, 0) = 0 THEN 'nothing found' WHEN n = 1 THEN 'found: ' || link
       ELSE 'more than one result found' END AS message
FROM pages LEFT JOIN (
  SELECT page_id, count(*) AS n, any_value(link) AS link FROM links_found GROUP BY 1) USING (page_id)"""

FILMS = """
films AS (
  SELECT p_partkey, p_name AS title, '(' || (p_size + 1950)::VARCHAR || ')' AS year,
    p_type AS genre, p_brand AS director, p_name || ',' || p_type AS actors,
    CASE WHEN p_size <> 13 THEN p_size % 10 + 0.5::DOUBLE END AS rating FROM part)
"""
ORACLES["films_cleaned"] = with_tables(FILMS) + "SELECT * FROM films"
ORACLES["film_average_rating"] = with_tables(FILMS) + f"""
SELECT {even('avg(rating)', 2)} AS avg_rating FROM films"""

# --- models ---------------------------------------------------------------------------

FIT = f"""
fit AS (
  SELECT {even('regr_intercept(l_extendedprice, l_quantity)', 4)} AS a,
    {even('regr_slope(l_extendedprice, l_quantity)', 4)} AS b FROM lineitem)
"""
PREDICTED = even("a + b * l_quantity", 3)
ORACLES["linear_fit"] = with_tables(FIT) + "SELECT * FROM fit"
ORACLES["linear_fit_by_flag"] = f"""
SELECT l_returnflag, {even('regr_intercept(l_extendedprice, l_quantity)', 4)} AS a,
  {even('regr_slope(l_extendedprice, l_quantity)', 4)} AS b FROM lineitem GROUP BY 1"""
ORACLES["linear_predict"] = with_tables(FIT) + f"""
SELECT DISTINCT l_quantity AS x, {PREDICTED} AS predicted FROM lineitem, fit"""
ORACLES["prediction_error"] = with_tables(FIT) + f"""
SELECT round(sqrt(avg(pow(l_extendedprice - {PREDICTED}, 2))), 4) AS rmse,
  round(sum({even(f'pow(l_extendedprice - {PREDICTED}, 2)', 3)}), -3) AS squared_errors
FROM lineitem, fit"""
ORACLES["forest_predict"] = """
SELECT label::VARCHAR AS target, label::VARCHAR AS predicted, count(*) AS n
FROM embeddings GROUP BY ALL"""
ORACLES["one_hot"] = "SELECT c_custkey, " + ", ".join(
    f"(c_mktsegment = '{s}')::INTEGER AS \"segment_{s}\""
    for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
) + " FROM customer"

# --- dates and numbers ----------------------------------------------------------------

ORACLES["order_calendar"] = """
SELECT o_orderkey, month(o_orderdate)::INTEGER AS month, strftime(o_orderdate, '%Y-%m') AS label,
  dayname(o_orderdate) AS weekday, day(last_day(o_orderdate))::INTEGER AS days,
  (CASE WHEN month(o_orderdate) = 2 THEN 28 ELSE day(last_day(o_orderdate)) END)::INTEGER AS short_days,
  date_diff('month', TIMESTAMP '1995-01-31', o_orderdate)::INTEGER AS months,
  (CASE WHEN day(last_day(o_orderdate)) = 31 THEN last_day(o_orderdate)
    ELSE make_date(year(o_orderdate), month(o_orderdate), 28) END)::VARCHAR AS last_or_28,
  floor((epoch(TIMESTAMP '2002-01-01 12:00:00') - epoch(o_orderdate)) / 86400)::INTEGER AS age,
  strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS reported
FROM orders"""
ORACLES["hash_uniforms"] = f"""
SELECT (floor({uniform('h')} * 20) + 1)::INTEGER AS bin, count(*) AS n
FROM (SELECT {hashed('o_orderkey', SEED, 'h')} FROM orders) GROUP BY 1"""
ORACLES["rounded_taxes"] = f"""
SELECT l_returnflag, round(sum({even('l_extendedprice * l_tax', 1)}), 1) AS even, count(*) AS n
FROM lineitem GROUP BY 1"""
