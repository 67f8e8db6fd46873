"""Every registered query: a function of a session and a folder of test tables.

Floating results are rounded here, so that engines that add in another order agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dates, numeric, sampling, text
from ledgerloom.operators import (
    aggregates, graph, models, ordering, pages, quality, resampling, stats,
)
from ledgerloom.plans import (
    cohort, commerce, domains, experiment, films, readout, rfm, sales, transfer_graph, transfers,
)
from ledgerloom.session import checkpoint_folder, reliable_checkpoint
from ledgerloom.sources import generators, readers, sinks, standins

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered runs.
REPLICATES = 1000
SIMULATIONS = 1000
SAMPLE_SIZE = 1000
SEED = 7
COHORT_YEAR = ("1996-01", "1996-12")
PRICE_CUT = 400_000.0
LOOKUP_DOMAIN = "m.ththth.example.net"
REPORT_DATE, NEXT_DATE = "2023-03-03", "2023-03-04"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round the named columns (and drop the sign of a rounded zero)."""
    return df.withColumns({name: F.round(name, digits) + F.lit(0.0) for name in columns})


# --- purchases and delivery -----------------------------------------------------------


def _bought(shop: standins.Shop) -> DataFrame:
    return commerce.purchases(shop.orders)


@query
def purchases(spark, folder):
    shop = standins.shop(spark, folder)
    return commerce.customer_purchases(shop.customers, _bought(shop)).select(
        "order_id", "customer_unique_id", "customer_state", "order_status",
        dates.month_label(F.col("order_approved_at")).alias("month"),
    )


@query
def purchases_per_customer(spark, folder):
    shop = standins.shop(spark, folder)
    return commerce.purchases_per_customer(shop.customers, _bought(shop))


@query
def hot_customer_purchases(spark, folder):
    """Purchases per state when one customer buys two thirds of everything."""
    shop = standins.shop(spark, folder)
    hot = F.when(F.col("order_id") % 3 != 0, F.lit(1)).otherwise(F.col("customer_id"))
    bought = _bought(shop).withColumn("customer_id", hot)
    joined = commerce.customer_purchases(shop.customers, bought)
    return joined.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("order_id").alias("n_orders")
    )


@query
def one_time_buyers(spark, folder):
    shop = standins.shop(spark, folder)
    return commerce.one_time_buyers(shop.customers, _bought(shop))


@query
def non_delivery_by_month(spark, folder):
    orders = commerce.not_delivered(standins.shop(spark, folder).orders)
    return commerce.orders_by_estimated_month(orders, "count_not_del")


@query
def non_delivery_mean(spark, folder):
    orders = commerce.not_delivered(standins.shop(spark, folder).orders)
    return rounded(commerce.mean_by_estimated_month(orders, "mean_not_del"), 6, "mean_not_del")


@query
def non_delivery_status_counts(spark, folder):
    return commerce.status_counts(commerce.not_delivered(standins.shop(spark, folder).orders))


@query
def shipped_by_month(spark, folder):
    orders = standins.shop(spark, folder).orders.filter(F.col("order_status") == "shipped")
    return commerce.orders_by_estimated_month(orders, "count_del")


@query
def missing_delivery_by_status(spark, folder):
    return commerce.missing_delivery_by_status(standins.shop(spark, folder).orders)


@query
def delivered_not_arrived_by_month(spark, folder):
    orders = commerce.not_delivered(standins.shop(spark, folder).orders)
    delivered = orders.filter(F.col("order_status") == "delivered")
    return commerce.orders_by_estimated_month(delivered, "count_not_del")


@query
def missing_delivery_by_state(spark, folder):
    shop = standins.shop(spark, folder)
    return commerce.missing_delivery_by_state(shop.customers, shop.orders)


@query
def months_present(spark, folder):
    return commerce.months_present(_bought(standins.shop(spark, folder)), "order_approved_at")


@query
def favourite_weekday(spark, folder):
    shop = standins.shop(spark, folder)
    return commerce.favourite_weekday(shop.items, _bought(shop))


@query
def favourite_weekday_overall(spark, folder):
    favourites = favourite_weekday(spark, folder)
    return aggregates.value_counts(favourites, "weekday")


def _per_week(spark, folder, leap):
    shop = standins.shop(spark, folder)
    weekly = commerce.purchases_per_week(shop.customers, _bought(shop), leap)
    return rounded(weekly, 6, "weeks", "purchases_per_week")


@query
def purchases_per_week(spark, folder):
    return _per_week(spark, folder, True)


@query
def purchases_per_week_short_february(spark, folder):
    return _per_week(spark, folder, False)


# --- cohorts --------------------------------------------------------------------------


def _cohorts(spark, folder):
    shop = standins.shop(spark, folder)
    return cohort.cohort_counts(shop.customers, _bought(shop), *COHORT_YEAR)


@query
def cohort_counts(spark, folder):
    return _cohorts(spark, folder)


@query
def cohort_retention(spark, folder):
    return cohort.retention(_cohorts(spark, folder))


@query
def retention_from_bitmaps(spark, folder):
    """Cohort retention from monthly bitmaps; the last months are added to the others' table."""
    shop = standins.shop(spark, folder)
    numbered = shop.customers.withColumn("customer_unique_id", F.col("customer_id"))
    bitmaps = reliable_checkpoint(cohort.activity_bitmaps(numbered, _bought(shop)))
    path, late = _scratch(spark, "activity"), 2017 * 12 + 7
    cohort.write_activity(bitmaps.filter(F.col("month") < late), path)
    cohort.write_activity(bitmaps.filter(F.col("month") >= late), path)
    return cohort.retention(cohort.cohort_counts_from_bitmaps(cohort.read_activity(spark, path), *COHORT_YEAR))


@query
def best_cohort(spark, folder):
    return cohort.best_cohort(cohort.retention(_cohorts(spark, folder)))


@query
def purchases_by_month_of_year(spark, folder):
    """Years as rows, the twelve months as columns."""
    approved = F.col("order_approved_at")
    counted = (
        _bought(standins.shop(spark, folder))
        .groupBy(F.year(approved).alias("year"), F.month(approved).alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return aggregates.pivot_counts(counted, "year", "month", "n", list(range(1, 13)), "m")


# --- recency, frequency, monetary -----------------------------------------------------


def _measures(spark, folder):
    shop = standins.shop(spark, folder)
    measures = rfm.rfm_measures(shop.customers, _bought(shop), shop.items)
    return rounded(measures, 2, "Monetary")


@query
def rfm_measures(spark, folder):
    return _measures(spark, folder)


@query
def rfm_cuts(spark, folder):
    return rounded(rfm.rfm_cuts(_measures(spark, folder)), 4, "q0", "q1", "q2", "q3")


def _scored(spark, folder):
    measures = _measures(spark, folder)
    return rfm.rfm_scores(measures, rfm.rfm_cuts(measures))


@query
def rfm_scores(spark, folder):
    return _scored(spark, folder)


@query
def rfm_segments(spark, folder):
    return rfm.segment_counts(_scored(spark, folder))


@query
def rfm_code_counts(spark, folder):
    return aggregates.value_counts(_scored(spark, folder), "RFM")


@query
def frequency_counts(spark, folder):
    return aggregates.value_counts(_measures(spark, folder), "Frequency")


# --- experiment -----------------------------------------------------------------------


def _full(spark, folder):
    return experiment.experiment_metrics(*standins.trial(spark, folder)).full


@query
def experiment_metrics(spark, folder):
    return experiment.experiment_metrics(*standins.trial(spark, folder)).metrics


@query
def experiment_full(spark, folder):
    return rounded(_full(spark, folder), 2, "rev")


@query
def group_sizes(spark, folder):
    return experiment.group_sizes(_full(spark, folder))


@query
def orphan_payers(spark, folder):
    trial = standins.trial(spark, folder)
    found = quality.orphans(trial.checks, trial.active, "student_id", "student_id")
    return rounded(found, 2, "rev")


@query
def active_in_groups(spark, folder):
    trial = standins.trial(spark, folder)
    everyone = experiment.all_groups(trial.groups, trial.late)
    return quality.overlap(everyone, trial.active, "id", "student_id")


@query
def late_overlap(spark, folder):
    trial = standins.trial(spark, folder)
    late = readers.rename_by_position(trial.late, "id", "grp")
    shared = quality.overlap(late, trial.groups, "id", "id")
    return shared.agg(F.count("id").alias("n_shared"))


@query
def repaired_active(spark, folder):
    trial = standins.trial(spark, folder)
    payers = quality.orphans(trial.checks, trial.active, "student_id", "student_id")
    return quality.add_orphans(trial.active, payers, "student_id")


@query
def null_profile(spark, folder):
    return quality.column_profile(standins.shop(spark, folder).orders)


@query
def key_uniqueness(spark, folder):
    trial = standins.trial(spark, folder)
    late = readers.rename_by_position(trial.late, "id", "grp")
    checked = [
        quality.key_is_unique(trial.groups, "id", "groups"),
        quality.key_is_unique(late, "id", "group_add"),
        quality.key_is_unique(trial.active, "student_id", "active"),
        quality.key_is_unique(trial.checks, "student_id", "checks"),
        quality.key_is_unique(readers.table(spark, folder, "lineitem"), "l_orderkey", "lines"),
    ]
    result = checked[0]
    for other in checked[1:]:
        result = result.unionByName(other)
    return result


@query
def describe_payments(spark, folder):
    described = quality.describe(standins.trial(spark, folder).checks, ["rev"])
    return rounded(described, 4, "mean", "std", "min", "max", "q25", "q50", "q75")


@query
def describe_lines(spark, folder):
    lines = readers.table(spark, folder, "lineitem")
    described = quality.describe(lines, ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(described, 4, "mean", "std", "min", "max", "q25", "q50", "q75")


@query
def conversion_readout(spark, folder):
    tested = readout.conversion_readout(_full(spark, folder))
    return rounded(
        tested, 6, "chi2", "p_value",
        "expected_a_yes", "expected_a_no", "expected_b_yes", "expected_b_no",
    )


@query
def average_check_readout(spark, folder):
    tested = readout.average_check_readout(
        _full(spark, folder), F.col("id"), replicates=REPLICATES
    )
    return rounded(tested, 4, "statistic", "p_value")


@query
def check_distribution(spark, folder):
    payers = _full(spark, folder).filter(F.col("rev") > 0)
    bars = aggregates.histogram(payers, "rev", 50, "grp", ["A", "B"], density=True)
    return rounded(rounded(bars, 2, "bin_left", "bin_right"), 12, "density")


@query
def platform_metrics(spark, folder):
    features = experiment.student_features(*standins.platform(spark, folder))
    return experiment.platform_metrics(features)


@query
def student_features(spark, folder):
    features = experiment.student_features(*standins.platform(spark, folder))
    return rounded(features, 2, "money")


@query
def diligent_students(spark, folder):
    return experiment.diligent_students(standins.platform(spark, folder).answers)


@query
def diligent_by_subject(spark, folder):
    return experiment.diligent_students(standins.platform(spark, folder).answers, by_subject=True)


@query
def diligent_monthly(spark, folder):
    return experiment.diligent_monthly(standins.platform(spark, folder).answers)


@query
def math_students(spark, folder):
    """A SQL text as source: its HAVING names an aggregate that shadows its input column."""
    return readers.query_source(
        spark,
        """
        SELECT st_id, SUM(correct) AS correct, MIN(timest) AS first_time, MAX(timest) AS last_time
        FROM {answers} WHERE subject = 'Math' GROUP BY st_id HAVING correct >= 2
        """,
        answers=standins.platform(spark, folder).answers,
    )


@query
def buyers_per_month(spark, folder):
    """Distinct customers per month of purchase."""
    bought = _bought(standins.shop(spark, folder)).withColumn(
        "month", dates.month_label(F.col("order_approved_at"))
    )
    return quality.distinct_count(bought, "customer_id", ["month"])


# --- statistics -----------------------------------------------------------------------


def _lines(spark, folder):
    return readers.table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")


def _t_test(spark, folder, equal_var):
    tested = stats.t_test(
        _lines(spark, folder), "l_extendedprice", "l_returnflag", "A", "R", equal_var
    )
    return rounded(tested, 6, "m1", "m2", "t", "df", "p_value")


@query
def student_t_test(spark, folder):
    return _t_test(spark, folder, True)


@query
def welch_t_test(spark, folder):
    return _t_test(spark, folder, False)


@query
def normality(spark, folder):
    tested = stats.normality_test(_lines(spark, folder), "l_extendedprice", ("l_returnflag",))
    return rounded(tested, 5, "z_skew", "z_kurt", "k2", "p_value")


@query
def mann_whitney(spark, folder):
    tested = stats.mann_whitney(
        _lines(spark, folder), "l_extendedprice", "l_returnflag", "A", "R"
    )
    return rounded(tested, 6, "u", "z", "p_value")


@query
def customer_price_u_tests(spark, folder):
    """Per customer, prices of open against filled orders: small samples, exact p-values."""
    orders = readers.table(spark, folder, "orders")
    tested = stats.mann_whitney(orders, "o_totalprice", "o_orderstatus", "O", "F", keys=["o_custkey"])
    return rounded(tested.filter("n1 > 0 AND n2 > 0"), 6, "u", "z", "p_value")


@query
def ranked_quantities(spark, folder):
    """Average ranks of tied values over two pooled samples."""
    lines = readers.table(spark, folder, "lineitem")
    flag = F.col("l_returnflag")
    ranks = ordering.average_ranks(
        lines, "l_quantity",
        {"na": F.when(flag == "A", 1).otherwise(0), "nb": F.when(flag != "A", 1).otherwise(0)},
    )
    return ranks.select("l_quantity", "na", "nb", "ties", "average_rank")


@query
def price_quantiles(spark, folder):
    lines = readers.table(spark, folder, "lineitem")
    cuts = ordering.exact_quantiles(
        lines, "l_extendedprice", (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0), ["l_returnflag"]
    )
    return rounded(cuts, 4, *[f"q{i}" for i in range(7)])


@query
def price_histogram(spark, folder):
    bars = aggregates.histogram(_lines(spark, folder), "l_extendedprice", 50)
    return rounded(bars, 4, "bin_left", "bin_right")


@query
def priority_bars(spark, folder):
    orders = readers.table(spark, folder, "orders")
    return aggregates.category_bars(orders, "o_orderpriority", "o_orderstatus")


@query
def priority_mean_bars(spark, folder):
    orders = readers.table(spark, folder, "orders")
    bars = aggregates.category_bars(
        orders, "o_orderpriority", "o_orderstatus", mean_of="o_totalprice"
    )
    return rounded(bars, 4, "bar")


def _ab(spark, folder):
    return readout.parse_ab_values(standins.ab_values(spark, folder))


def _replicates(spark, folder, statistic):
    return resampling.bootstrap_replicates(
        _ab(spark, folder), "value", "experimentVariant", "Treatment", "Control",
        F.col("number"), REPLICATES, statistic, SEED,
    )


@query
def decimal_comma_totals(spark, folder):
    totals = (
        _ab(spark, folder)
        .groupBy("experimentVariant")
        .agg(F.count("value").alias("n"), F.sum("value").alias("total"))
    )
    return rounded(totals, 2, "total")


@query
def bootstrap_mean_replicates(spark, folder):
    return rounded(_replicates(spark, folder, "mean"), 4, "difference")


@query
def bootstrap_median_replicates(spark, folder):
    return rounded(_replicates(spark, folder, "median"), 4, "difference")


def _summary(spark, folder, statistic):
    summary = resampling.bootstrap_summary(_replicates(spark, folder, statistic))
    return rounded(summary, 4, "mean", "sd", "ci_low", "ci_high", "p_value")


@query
def bootstrap_mean(spark, folder):
    return _summary(spark, folder, "mean")


@query
def bootstrap_median(spark, folder):
    return _summary(spark, folder, "median")


@query
def bootstrap_histogram(spark, folder):
    replicates = _replicates(spark, folder, "mean")
    bars = resampling.bootstrap_histogram(replicates)
    return rounded(bars, 4, "bin_left", "bin_right")


def _quantity_replicates(spark, folder, statistic):
    """Quantities of returned against accepted lines: few values, each in many rows.

    The two sides draw for themselves, so the key tells them apart too.
    """
    lines = readers.table(spark, folder, "lineitem")
    value = (F.col("l_quantity") * 100).cast("bigint")
    key = value * 2 + (F.col("l_returnflag") == "A").cast("bigint")
    return resampling.bootstrap_replicates(
        lines, "l_quantity", "l_returnflag", "R", "A", key, REPLICATES, statistic, SEED, equal_values=True
    )


@query
def bootstrap_quantity_replicates(spark, folder):
    return rounded(_quantity_replicates(spark, folder, "mean"), 6, "difference")


@query
def bootstrap_quantity_medians(spark, folder):
    return rounded(_quantity_replicates(spark, folder, "median"), 4, "difference")


@query
def ab_readout(spark, folder):
    tested = readout.ab_readout(
        _ab(spark, folder), "value", "experimentVariant", "Treatment", "Control",
        F.col("number"), PRICE_CUT, REPLICATES,
    )
    return rounded(tested, 4, "statistic", "p_value")


@query
def outlier_cut(spark, folder):
    kept = readout.cut_outliers(
        _ab(spark, folder), "value", "experimentVariant", "Treatment", PRICE_CUT
    )
    return rounded(
        kept.groupBy("experimentVariant").agg(
            F.count("value").alias("n"), F.max("value").alias("largest")
        ),
        2, "largest",
    )


def _simulated(spark, folder, clean):
    events = standins.aa_events(spark, folder)
    if clean:
        events = readout.without_version(events, "v2.8.0")
    return resampling.aa_simulation(
        events, "purchase", "experimentVariant", 1, 0, "number", SAMPLE_SIZE, SIMULATIONS, SEED
    )


@query
def aa_simulation(spark, folder):
    return rounded(_simulated(spark, folder, False), 6, "m1", "m2", "t", "df", "p_value")


@query
def aa_audit(spark, folder):
    audit = readout.aa_audit(
        standins.aa_events(spark, folder), "purchase", "experimentVariant", 1, 0, "number",
        SAMPLE_SIZE, SIMULATIONS, SEED,
    )
    return rounded(audit, 6, "fpr")


@query
def aa_audit_without_version(spark, folder):
    return rounded(resampling.false_positive_rate(_simulated(spark, folder, True)), 6, "fpr")


@query
def aa_p_value_histogram(spark, folder):
    simulated = rounded(_simulated(spark, folder, True), 6, "p_value")
    bars = aggregates.histogram(simulated, "p_value", 50)
    return rounded(bars, 6, "bin_left", "bin_right")


@query
def version_means(spark, folder):
    means = readout.segment_means(standins.aa_events(spark, folder), "purchase", "version")
    return rounded(means, 6, "mean")


@query
def version_variant_means(spark, folder):
    means = readout.segment_means(
        standins.aa_events(spark, folder), "purchase", "version", "experimentVariant"
    )
    return rounded(means, 6, "mean")


# --- transfers and graph --------------------------------------------------------------


def _dated(spark, folder):
    return transfers.dated_transfers(*standins.payments(spark, folder))


def _cleaned(spark, folder):
    return transfers.clean_links(_dated(spark, folder))


TRANSFER_COLUMNS = ("id_sender", "id_receiver", "dates", "amount_new", "date_cred", "diff_time")


@query
def in_window_transfers(spark, folder):
    return transfers.inside_window(_dated(spark, folder)).select(*TRANSFER_COLUMNS)


@query
def known_pairs(spark, folder):
    return transfers.known_pairs(_dated(spark, folder))


@query
def link_cleaning(spark, folder):
    return _cleaned(spark, folder).select(*TRANSFER_COLUMNS)


@query
def issue_dates(spark, folder):
    """A reproducible random issue date for every known sender."""
    senders = standins.payments(spark, folder).transfers
    return generators.issue_dates(senders, "id_sender", SEED)


def _graph_rows(spark, folder):
    return standins.graph_transfers(spark, folder, _cleaned(spark, folder))


def _edges(spark, folder):
    """Edges of the cleaned transfers, kept as a table because most graph steps read them twice."""
    return reliable_checkpoint(
        graph.aggregate_edges(
            _graph_rows(spark, folder), "id_sender", "id_receiver", "amount_new"
        )
    )


def _trade_edges(spark, folder):
    """Edges of all transfers, not only the cleaned ones."""
    all_rows = standins.graph_transfers(
        spark, folder, standins.payments(spark, folder).transfers
    )
    edges = graph.aggregate_edges(all_rows, "id_sender", "id_receiver", "amount_new")
    return rounded(edges, 2, "amount")


@query
def transfer_edges(spark, folder):
    return rounded(_edges(spark, folder), 2, "amount")


@query
def trade_edges(spark, folder):
    return _trade_edges(spark, folder)


@query
def graph_size(spark, folder):
    return graph.graph_size(_edges(spark, folder))


@query
def node_roles(spark, folder):
    return graph.node_roles(_edges(spark, folder))


@query
def edge_widths(spark, folder):
    return rounded(graph.edge_widths(transfer_edges(spark, folder)), 2, "amount")


@query
def edge_widths_as_written(spark, folder):
    return graph.edge_widths(transfer_edges(spark, folder), as_written=True)


@query
def trade_edge_widths(spark, folder):
    widths = graph.edge_widths(reliable_checkpoint(_trade_edges(spark, folder)))
    return widths.groupBy("width").agg(F.count(F.lit(1)).alias("n_edges"))


@query
def connected_components(spark, folder):
    return graph.connected_components(_edges(spark, folder))


@query
def trade_components(spark, folder):
    """Components of the whole trade graph: one giant component with hub nodes."""
    found = graph.connected_components(_trade_edges(spark, folder))
    return found.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))


@query
def component_totals(spark, folder):
    edges = _edges(spark, folder)
    totals = graph.component_totals(edges, graph.connected_components(edges))
    return rounded(totals, 2, "amount")


@query
def component_subgraphs(spark, folder):
    built = transfer_graph.transfer_graph(_graph_rows(spark, folder))
    return rounded(built.edges, 2, "amount").select("component", "src", "dst", "amount")


@query
def component_nodes(spark, folder):
    built = transfer_graph.transfer_graph(_graph_rows(spark, folder))
    return built.nodes.select("component", "node", "color", "size", "label")


@query
def exported_components(spark, folder):
    """Components written to folders and read back: rows of every table and component."""
    path = _scratch(spark, "components")
    transfer_graph.export_graph(transfer_graph.transfer_graph(_graph_rows(spark, folder)), path)
    counted = [
        spark.read.parquet(f"{path}/{name}").groupBy("component")
        .agg(F.count(F.lit(1)).alias("n")).withColumn("written", F.lit(name))
        for name in ("nodes", "edges")
    ]
    return counted[0].unionByName(counted[1])


# --- files ----------------------------------------------------------------------------


def _scratch(spark, name):
    """A new folder for files that a query writes and reads again."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _order_rows(spark, folder):
    day = F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss").alias("day")
    return readers.table(spark, folder, "orders").select(*ORDER_COLUMNS, day)


def _written_orders(spark, folder, sep):
    """Orders written to CSV and read back, with the day parsed from its text."""
    path = _scratch(spark, "orders")
    sinks.write_csv(_order_rows(spark, folder), path, sep=sep)
    back = readers.read_csv(
        spark, path, "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
        "o_totalprice DOUBLE, day STRING", sep,
    )
    parsed = dates.parse_timestamp(F.col("day"), "dd.MM.yyyy HH:mm:ss")
    return back.withColumn("day", parsed.cast("date"))


@query
def orders_through_csv(spark, folder):
    return _written_orders(spark, folder, ",")


@query
def orders_through_semicolons(spark, folder):
    return _written_orders(spark, folder, ";")


@query
def domains_through_csv(spark, folder):
    """The ranked domain list as the headerless file it comes in."""
    path = _scratch(spark, "domains")
    sinks.write_csv(standins.domains(spark, folder), path, header=False)
    return readers.read_domains(spark, path)


@query
def landed_customers(spark, folder):
    """A headerless file landed as a table."""
    staged, landed = _scratch(spark, "staged"), _scratch(spark, "landed")
    customers = readers.table(spark, folder, "customer").select("c_custkey", "c_name")
    sinks.write_csv(customers, staged, header=False)
    return readers.land_raw(spark, staged, "c_custkey BIGINT, c_name STRING", landed)


@query
def features_through_csv(spark, folder):
    """A feature file with an index column that is left out."""
    path = _scratch(spark, "features")
    parts = readers.table(spark, folder, "part").select(
        F.monotonically_increasing_id().alias("index"), "p_partkey", "p_size"
    )
    sinks.write_csv(parts, path)
    return readers.read_features(
        spark, path, "index BIGINT, p_partkey BIGINT, p_size INT", "index"
    )


@query
def published_reports(spark, folder):
    """Two days of reports; the first day is run again on better-ranked domains only."""
    path, listed = _scratch(spark, "reports"), standins.domains(spark, folder)
    runs = [(REPORT_DATE, listed), (NEXT_DATE, listed), (REPORT_DATE, listed.filter("rank <= 100"))]
    for day, some in runs:
        domains.publish_report(domains.domain_report(some, day, LOOKUP_DOMAIN), path)
    return domains.published_reports(spark, path)


@query
def orders_with_rejects(spark, folder):
    """Orders written with some broken lines, read back as good rows and rejected lines."""
    path = _scratch(spark, "broken")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    fields = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice"), day]
    line = F.concat_ws(";", *[field.cast("string") for field in fields])
    key = F.col("o_orderkey")
    broken = (
        F.when(key % 97 == 0, F.concat_ws(";", *[field.cast("string") for field in fields[:3]]))
        .when(key % 89 == 0, F.concat(line, F.lit(";more")))
        .when(key % 83 == 0, F.lit("no order at all"))
        .when(key % 79 == 0, F.concat_ws(";", key.cast("string"), F.lit("x1"), *[f.cast("string") for f in fields[2:]]))
        .when(key % 73 == 0, F.concat_ws(";", key.cast("string"), F.lit(""), *[f.cast("string") for f in fields[2:]]))
        .otherwise(line)
    )
    readers.table(spark, folder, "orders").select(broken.alias("line")).write.text(path)
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, day DATE"
    checked = readers.read_checked_csv(spark, path, schema, ";", False, ("o_orderkey", "o_custkey"))
    good = checked.good.agg(
        F.lit("good").alias("side"), F.count(F.lit(1)).alias("lines"), F.count_distinct("o_orderkey").alias("different"),
        F.sum("o_orderkey").alias("keys"),
    )
    plain = F.col("line") == "no order at all"
    rejected = checked.rejects.groupBy(F.when(plain, "rejected text").otherwise("rejected order").alias("side")).agg(
        F.sum("n").alias("lines"), F.count(F.lit(1)).alias("different"),
        F.sum(F.split("line", ";")[0].try_cast("bigint")).alias("keys"),
    )
    return good.unionByName(rejected)


@query
def first_orders(spark, folder):
    """What a look at the orders shows: the five with the smallest keys."""
    return sinks.preview(_order_rows(spark, folder).orderBy("o_orderkey"))


@query
def orders_above_mean(spark, folder):
    """Orders above the mean price, a number the program holds in between."""
    orders = readers.table(spark, folder, "orders")
    mean = sinks.single_value(orders.agg(F.round(F.avg("o_totalprice"), 4)))
    return orders.filter(F.col("o_totalprice") > F.lit(mean)).agg(F.count(F.lit(1)).alias("n"))


@query
def part_names_without_letter(spark, folder):
    """Part names without their first "e"."""
    part = readers.table(spark, folder, "part")
    return part.select("p_partkey", text.remove_first(F.col("p_name"), "e").alias("name"))


# --- domains, people, pages, films ----------------------------------------------------


@query
def top_zones(spark, folder):
    return domains.top_zones(standins.domains(spark, folder))


@query
def longest_domain(spark, folder):
    return domains.longest_domain(standins.domains(spark, folder))


@query
def domain_rank(spark, folder):
    return domains.domain_rank(standins.domains(spark, folder), LOOKUP_DOMAIN)


@query
def domain_report(spark, folder):
    return domains.domain_report(standins.domains(spark, folder), REPORT_DATE, LOOKUP_DOMAIN)


@query
def sales_rank(spark, folder):
    return sales.sales_rank(*standins.register(spark, folder))


@query
def name_parts(spark, folder):
    part = readers.table(spark, folder, "part")
    return part.select("p_partkey", *text.full_name_parts(F.col("p_name")))


def _pages(spark, folder):
    return readers.table(spark, folder, "pages")


@query
def page_titles(spark, folder):
    return pages.elements(_pages(spark, folder), "h1")


@query
def page_paragraphs(spark, folder):
    return pages.elements(_pages(spark, folder), "p", "")


@query
def page_ads(spark, folder):
    return pages.elements(_pages(spark, folder), "div", "ad")


@query
def page_links(spark, folder):
    return pages.links(_pages(spark, folder))


@query
def page_records(spark, folder):
    return pages.extract_records(
        _pages(spark, folder),
        {"title": ("h1", None), "item": ("li", ""), "ad": ("div", "ad"), "info": ("p", "")},
        max_rows=14,
    )


@query
def page_pairs(spark, folder):
    """Links and paragraphs of a page side by side, cut at the shorter list."""
    wanted = {"item": ("li", ""), "info": ("p", "")}
    return pages.extract_records(_pages(spark, folder), wanted, shortest=True)


@query
def page_link_items(spark, folder):
    """Links without a class, with the title taken from the list item at the same place."""
    wanted = {"link": pages.targets_of(""), "title": ("li", None)}
    return pages.extract_records(_pages(spark, folder), wanted, shortest=True)


@query
def page_result_message(spark, folder):
    return pages.result_message(_pages(spark, folder))


@query
def films_cleaned(spark, folder):
    return films.clean_films(standins.film_texts(spark, folder))


@query
def film_average_rating(spark, folder):
    return films.average_rating(films.clean_films(standins.film_texts(spark, folder)))


# --- models ---------------------------------------------------------------------------


def _points(spark, folder):
    return readers.table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y")
    )


@query
def linear_fit(spark, folder):
    return models.linear_fit(_points(spark, folder), "x", "y")


@query
def linear_fit_by_flag(spark, folder):
    return models.linear_fit(_points(spark, folder), "x", "y", ["l_returnflag"])


@query
def linear_predict(spark, folder):
    points = _points(spark, folder)
    fit = models.linear_fit(points, "x", "y")
    return models.linear_predict(points.select("x").distinct(), fit, "x")


@query
def prediction_error(spark, folder):
    points = _points(spark, folder)
    predicted = models.linear_predict(points, models.linear_fit(points, "x", "y"), "x")
    errors = models.prediction_error(predicted, "y", "predicted")
    # Sums of other orders differ in the last digits of a double.
    return errors.select(
        F.round("rmse", 4).alias("rmse"), F.round("squared_errors", -3).alias("squared_errors")
    )


@query
def one_hot(spark, folder):
    customer = readers.table(spark, folder, "customer")
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return customer.select("c_custkey", *models.one_hot("c_mktsegment", segments, "segment"))


@query
def forest_predict(spark, folder):
    """Fit on all vectors, predict all vectors: counts per true and predicted class."""
    rows = standins.embedding_features(spark, folder)
    model = models.fit_forest(rows, ["vector"], "target", seed=SEED)
    predicted = models.forest_predict(model, rows)
    return predicted.groupBy("target", "predicted").agg(F.count(F.lit(1)).alias("n"))


# --- dates and numbers ----------------------------------------------------------------


@query
def order_calendar(spark, folder):
    """Date helpers on every order."""
    day = F.col("o_orderdate")
    return readers.table(spark, folder, "orders").select(
        "o_orderkey",
        F.month(day).alias("month"),
        dates.month_label(day).alias("label"),
        dates.weekday_name(day).alias("weekday"),
        dates.days_in_month(day).alias("days"),
        dates.days_in_month(day, leap=False).alias("short_days"),
        dates.months_between_labels(F.lit("1995-01-31").cast("timestamp_ntz"), day).alias("months"),
        dates.date_or_28(F.year(day), F.month(day), F.lit(31)).cast("string").alias("last_or_28"),
        dates.whole_days(day, F.lit("2002-01-01 12:00:00").cast("timestamp_ntz")).alias("age"),
        F.date_format(dates.report_day(day), "yyyy-MM-dd").alias("reported"),
    )


@query
def hash_uniforms(spark, folder):
    """Reproducible uniform draws of the order keys, as a 20-bin count."""
    orders = readers.table(spark, folder, "orders")
    draw = sampling.uniform_draw(F.col("o_orderkey"), SEED)
    return orders.groupBy((F.floor(draw * 20) + 1).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def rounded_taxes(spark, folder):
    """Half-to-even and half-up rounding of the line tax."""
    tax = F.col("l_extendedprice") * F.col("l_tax")
    return readers.table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.sum(numeric.round_even(tax, 1)), 1).alias("even"),
        F.count(F.lit(1)).alias("n"),
    )
