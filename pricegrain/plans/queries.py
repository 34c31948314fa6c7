"""Registered queries of the price model, each with its DuckDB counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrain.functions import scalars as sc
from pricegrain.operators import baskets as bk
from pricegrain.operators import fuel as fu
from pricegrain.operators import geo, ingest, quality, sampling, text
from pricegrain.operators import index as ix
from pricegrain.operators import variability as va
from pricegrain.plans import stream_queries as sq
from pricegrain.plans import xml_queries as xq
from pricegrain.plans.mapping import B2B, Tables, sql
from pricegrain.sources import readers
from pricegrain.storage import bucketed, checkpoint

PLANS: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def q(name: str, plan: Callable[[Tables], DataFrame], body: str | None = None, kind: str = "unit", more: str = "") -> None:
    PLANS[name] = plan
    if body:
        SQL[name] = sql(body, kind, more)


# --- helpers on both sides


def ps(t: Tables, kind: str = "unit") -> DataFrame:
    """Prices with the store's network, place and type."""
    return t.of_stores(t.prices(kind), store_columns(t))


def store_columns(t: Tables) -> DataFrame:
    return t.stores.select(F.col("id").alias("store_id"), "network", "network_id", "uat_id", "type_id")


def cs(t: Tables, kind: str = "unit") -> DataFrame:
    return t.of_stores(t.current(kind), store_columns(t))


def as_of(t: Tables):
    return t.as_of


def text_dates(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) if k == "date" else F.col(c) for c, k in df.dtypes])


def r(x: str, d: int = 2) -> str:
    return f"floor(({x}) * 1e{d} + 5e-1) / 1e{d}"


MEAN = "floor(sum(cents)::DOUBLE / count(cents) + 5e-1) / 1e2"
DAY, ASOF = "(SELECT d FROM latest)", "(SELECT max(fetched_at) FROM prices)"
PCT = r("1e2 * (max(cents) - min(cents)) / min(cents)")
STATS = f"min(cents) / 1e2 AS min_price, {MEAN} AS avg_price, max(cents) / 1e2 AS max_price, {PCT} AS spread_pct"
N = "count(*)"

# --- ingest

q("ingest_changes", lambda t: text_dates(ingest.ingest_changes(t.prices())), "SELECT product_id, store_id, cents, promo, fetched_at::VARCHAR AS fetched_at, CASE WHEN rn = 1 THEN 'new' ELSE 'changed' END AS change_type FROM (SELECT *, row_number() OVER w AS rn, lag(cents) OVER w AS pc, lag(promo) OVER w AS pp FROM prices WINDOW w AS (PARTITION BY product_id, store_id ORDER BY fetched_at, cents)) WHERE rn = 1 OR cents IS DISTINCT FROM pc OR promo IS DISTINCT FROM pp")
q("snapshot_latest", lambda t: text_dates(t.current()), "SELECT product_id, store_id, cents, price_date::VARCHAR AS price_date, fetched_at::VARCHAR AS fetched_at, promo, unit, brand FROM current_p")


def second_batch(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Observations of the newest year, compared with the bucketed snapshot of all before it; and that snapshot."""
    newest = F.col("price_date") == F.lit(t.latest_date)
    before = ingest.compare(t.prices().filter(~newest))
    stored = bucketed(ingest.merged(before, t.spark.createDataFrame([], "product_id long, store_id long, cents long, promo string, price_date date, last_checked_at date, last_changed_at date")), ingest.KEY)
    return ingest.compare(t.prices().filter(newest), stored), stored


q("ingest_second_batch", lambda t: text_dates(ingest.history_of(second_batch(t)[0])), f"SELECT product_id, store_id, cents, promo, price_date::VARCHAR AS price_date, fetched_at::VARCHAR AS fetched_at, pc AS was, CASE WHEN rn = 1 THEN 'new' ELSE 'changed' END AS change_type FROM history WHERE price_date = {DAY}")
q("snapshot_second_batch", lambda t: text_dates(ingest.merged(*second_batch(t))), "SELECT product_id, store_id, h.cents, h.promo, h.price_date::VARCHAR AS price_date, checked::VARCHAR AS last_checked_at, h.fetched_at::VARCHAR AS last_changed_at FROM (SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY product_id, store_id ORDER BY fetched_at DESC, cents DESC) = 1) h JOIN (SELECT product_id, store_id, max(fetched_at) AS checked FROM prices GROUP BY ALL) USING (product_id, store_id)")
q("first_price_kept", lambda t: text_dates(ingest.first_price_kept(t.offers())), "SELECT product_id, store_id, price_date::VARCHAR AS price_date, first(cents ORDER BY fetched_at, cents) AS cents, max(fetched_at)::VARCHAR AS last_checked_at FROM offers GROUP BY product_id, store_id, price_date")
q("keys_with_changes", lambda t: ingest.keys_with_changes(t.prices()), "SELECT count(*) AS keys FROM (SELECT 1 FROM prices GROUP BY product_id, store_id HAVING count(DISTINCT cents) > 1)")
upserted = lambda t: ingest.store_upsert(t.stores.select("id", "name", "network"), t.stores.filter("is_active").select("id", F.concat("name", F.lit(" new")).alias("name"), F.when(F.col("population") > 5000, F.col("network")).alias("network")))  # noqa: E731  the stores known to be active come in again
q("store_upsert", upserted, "SELECT id, CASE WHEN is_active THEN name || ' new' ELSE name END AS name, network, true AS is_active FROM stores")
q("propagate_checked", lambda t: text_dates(ingest.propagate_checked(t.current().withColumn("last_checked_at", F.col("fetched_at")), t.stores.filter(F.col("network") != B2B).select(F.col("id").alias("store_id")), as_of(t)).select("product_id", "store_id", "last_checked_at")), f"SELECT product_id, store_id, (CASE WHEN network <> '{B2B}' THEN {ASOF} ELSE fetched_at END)::VARCHAR AS last_checked_at FROM cs")
IMP = "pairs AS (SELECT m AS source_id, id AS store_id FROM (SELECT id, min(id) OVER (PARTITION BY network) AS m FROM stores) WHERE id <> m), imp AS (SELECT s.product_id, w.store_id, s.cents, s.promo, s.price_date, CASE WHEN c.cents IS NULL THEN 'new' WHEN s.cents <> c.cents OR coalesce(s.promo <> c.promo, false) THEN 'changed' ELSE 'same' END AS change FROM current_p s JOIN pairs w ON w.source_id = s.store_id LEFT JOIN current_p c ON c.product_id = s.product_id AND c.store_id = w.store_id)"
imputed = lambda t: ingest.propagate_prices(t.current(), ingest.representatives(t.stores))
q("propagate_prices", lambda t: text_dates(imputed(t)), "SELECT product_id, store_id, cents, promo, price_date::VARCHAR AS price_date, change FROM imp", more=IMP)
q("imputed_history", lambda t: text_dates(ingest.imputed_history(t.prices(), imputed(t), as_of(t))), f"SELECT product_id, store_id, cents, promo, price_date::VARCHAR AS price_date, fetched_at::VARCHAR AS fetched_at FROM prices UNION ALL SELECT product_id, store_id, cents, promo, price_date::VARCHAR, {ASOF}::VARCHAR FROM imp ANTI JOIN prices USING (product_id, store_id, price_date)", more=IMP)
q("imputed_snapshot", lambda t: text_dates(ingest.imputed_snapshot(t.current().withColumn("last_checked_at", F.col("fetched_at")).join(ingest.last_changes(t.prices()), ingest.KEY), imputed(t), as_of(t))), f"SELECT product_id, store_id, CASE WHEN i.change IS NULL THEN c.cents ELSE i.cents END AS cents, CASE WHEN i.change IS NULL THEN c.promo ELSE i.promo END AS promo, (CASE WHEN i.change IS NULL THEN c.price_date ELSE i.price_date END)::VARCHAR AS price_date, (CASE WHEN i.change IS NULL THEN c.fetched_at ELSE {ASOF} END)::VARCHAR AS last_checked_at, (CASE WHEN i.change IN ('new', 'changed') THEN {ASOF} ELSE c.last_changed_at END)::VARCHAR AS last_changed_at FROM (SELECT * FROM current_p JOIN moved USING (product_id, store_id)) c FULL JOIN imp i USING (product_id, store_id)", more=IMP)
q("network_by_name", lambda t: ingest.network_by_name(t.stores.select("id", F.element_at(F.array(*[F.lit(x) for x in ("Profi Cluj", "MEGA IMAGE X", "SG NORD", "EXPRESS 1", "SEGLROS", "Unknown")]), (F.col("id") % 6 + 1).cast("int")).alias("name"), F.when(F.col("id") % 7 == 0, F.col("network")).alias("network"))).select("id", "name", "network", "inferred"), "SELECT id, ['Profi Cluj', 'MEGA IMAGE X', 'SG NORD', 'EXPRESS 1', 'SEGLROS', 'Unknown'][k + 1] AS name, coalesce(n, CASE k WHEN 0 THEN 'PROFI' WHEN 1 THEN '5940475870003' WHEN 2 THEN '5940475870003' WHEN 3 THEN '5940475006709' WHEN 4 THEN 'SELGROS' END) AS network, n IS NULL AND k <> 5 AS inferred FROM (SELECT id, id % 6 AS k, CASE WHEN id % 7 = 0 THEN network END AS n FROM stores)")
LOGO_S = lambda t: t.stores.select("id", "name", F.when(F.col("id") % 2 == 0, F.col("network_id")).alias("network_id"), F.concat(F.lit("logo"), (F.col("id") % 6).cast("string")).alias("logo_url"))
LOGO_N = lambda t: t.networks.select("id", "name", F.concat(F.lit("logo"), F.col("id").cast("string")).alias("logo_url"))
q("network_by_logo", lambda t: ingest.network_by_logo(LOGO_S(t), LOGO_N(t)).select("id", "network_id", "inferred"), "SELECT id, CASE WHEN id % 2 = 0 THEN network_id WHEN id % 6 < 5 THEN id % 6 END AS network_id, id % 2 = 1 AND id % 6 < 5 AS inferred FROM stores")
q("network_conflicts", lambda t: ingest.network_conflicts(LOGO_S(t), LOGO_N(t)), "SELECT s.id AS store_id, s.name AS store_name, s.network_id AS db_network_id, n.id AS logo_network_id, n.name AS logo_network_name FROM stores s JOIN networks n ON n.id = s.id % 6 WHERE s.id % 2 = 0 AND s.network_id <> n.id")
q("stale_store_deactivation", lambda t: ingest.deactivate_stale(t.stores, t.current(), as_of(t)), f"SELECT s.id, coalesce(max(fetched_at) >= {ASOF} - 21, true) AS is_active FROM stores s LEFT JOIN current_p c ON c.store_id = s.id GROUP BY s.id")
q("store_tiers", lambda t: ingest.store_tiers(t.stores, ingest.last_changes(t.prices()), as_of(t)), f"SELECT s.id AS store_id, CASE WHEN max(last_changed_at) >= {ASOF} - 7 THEN 'daily' WHEN max(last_changed_at) IS NOT NULL THEN 'weekly' END AS tier FROM stores s LEFT JOIN moved m ON m.store_id = s.id WHERE coalesce(s.is_active, true) GROUP BY s.id")
q("normalize_dates", lambda t: t.raw("orders").select("o_orderkey", sc.iso_date(F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd.MM.yyyy HH:mm")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy HH:mm")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm"))).alias("at")), "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS at FROM orders")
q("unit_audit", lambda t: t.prices().withColumns({"store_unit": sc.store_unit(F.col("unit")), "pack_unit": sc.pack_unit(F.col("unit")), "analysis_unit": sc.analysis_unit(F.col("unit"))}).groupBy("unit", "store_unit", "pack_unit", "analysis_unit").agg(F.count(F.lit(1)).alias("n_rows")), "SELECT unit, CASE unit WHEN 'Kg' THEN 'kg' WHEN 'BUC' THEN 'pcs' ELSE 'L' END AS store_unit, CASE unit WHEN 'Kg' THEN 'kg' WHEN 'BUC' THEN 'buc' ELSE 'L' END AS pack_unit, CASE unit WHEN 'Kg' THEN 'kg' WHEN 'BUC' THEN 'buc' ELSE 'l' END AS analysis_unit, count(*) AS n_rows FROM prices GROUP BY unit")

# --- views

q("price_variability", lambda t: va.price_variability(ps(t), t.latest_date), f"SELECT network, product_id, count(DISTINCT store_id) AS stores, {STATS} FROM (SELECT *, min(cents) OVER (PARTITION BY product_id, network) AS low FROM ps WHERE price_date = {DAY} AND cents > 0) WHERE cents <= low * 10 GROUP BY ALL HAVING count(DISTINCT store_id) >= 3 AND {PCT} > 5")
q("cross_network_spread", lambda t: va.cross_network_spread(ps(t), exclude=(B2B,)), f"SELECT product_id, min(m) AS min_net_price, max(m) AS max_net_price, count(*) AS networks, {r('max(m) - min(m)')} AS spread, {r('max(m) / min(m)')} AS ratio FROM (SELECT product_id, network, {MEAN} AS m FROM ps WHERE network <> '{B2B}' GROUP BY ALL HAVING count(*) >= 2) GROUP BY product_id HAVING count(*) >= 2")
q("product_popularity", lambda t: ix.product_popularity(ps(t)), "SELECT product_id, store_count, record_count, ((rank() OVER (ORDER BY store_count DESC)) + (rank() OVER (ORDER BY record_count DESC))) / 2e0 AS blended_rank FROM (SELECT product_id, count(DISTINCT store_id) AS store_count, count(*) AS record_count FROM ps GROUP BY product_id)")
q("private_label", lambda t: ix.private_label(ps(t).filter(F.col("price_date") == F.lit(t.latest_date))), f"SELECT product_id, min(network) AS network, count(DISTINCT store_id) AS stores FROM ps WHERE price_date = {DAY} GROUP BY product_id HAVING count(DISTINCT network) = 1")
q("stores_per_network", lambda t: ix.stores_per_network(t.stores), "SELECT network, count(*) AS stores FROM stores GROUP BY network")
q("price_freshness", lambda t: text_dates(ix.price_freshness(ps(t))), "SELECT price_date::VARCHAR AS price_date, count(*) AS records, count(DISTINCT store_id) AS stores, count(DISTINCT product_id) AS products FROM ps GROUP BY 1")
q("products_no_prices", lambda t: ix.products_no_prices(t.products, t.prices().filter(F.col("price_date") == F.lit(t.latest_date))), f"SELECT id, name, categ_id FROM products WHERE id NOT IN (SELECT product_id FROM prices WHERE price_date = {DAY})")
q("run_history", lambda t: text_dates(t.runs.orderBy(F.desc("started"), F.desc("id")).limit(30)), "SELECT id, script, started::VARCHAR AS started, status, records FROM runs ORDER BY runs.started DESC, id DESC LIMIT 30")
q("intra_spread_all", lambda t: va.intra_spread_all(ps(t)), f"SELECT network, product_id, count(DISTINCT store_id) AS stores, {STATS} FROM ps GROUP BY ALL HAVING count(DISTINCT store_id) >= 2")
q("store_coverage", lambda t: ix.store_coverage(ps(t), t.stores), "SELECT (SELECT count(DISTINCT store_id) FROM ps) AS with_prices, (SELECT count(*) FROM stores) AS total")
q("stores_fetched_on", lambda t: ix.stores_fetched_on(t.prices(), as_of(t)), f"SELECT store_id, count(*) AS records FROM prices WHERE fetched_at = {ASOF} GROUP BY store_id")
q("population_band", lambda t: ix.population_band(t.stores), "SELECT id, network, population FROM (SELECT *, row_number() OVER (ORDER BY population, id) AS rn, count(*) OVER () AS n FROM stores) WHERE rn > n * 35e-2 AND rn <= n * 65e-2")
q("top_stores_by_population", lambda t: t.stores.orderBy(F.desc("population"), "id").limit(20).select("id", "name", "population"), "SELECT id, name, population FROM stores ORDER BY population DESC, id LIMIT 20")

# --- variability

LATEST = "ls AS (SELECT product_id, network, unit, store_id, first(cents ORDER BY price_date DESC, fetched_at DESC) AS cents FROM ps GROUP BY ALL)"
q("latest_per_store", lambda t: va.latest_per_store(ps(t)), "SELECT * FROM ls", more=LATEST)
q("intra_network_stats", lambda t: va.intra_network_stats(va.latest_per_store(ps(t))), f"SELECT product_id, network, unit, stores, lo / 1e2 AS min_price, hi / 1e2 AS max_price, floor(s / stores + 5e-1) / 1e2 AS avg_price, floor(sd + 5e-1) / 1e2 AS std_price, {r('sd * 1e2 / (s / stores)', 1)} AS cv_pct, {r('hi::DOUBLE / lo')} AS ratio FROM (SELECT *, sqrt(greatest(0e0, qq / stores - (s / stores) * (s / stores))) AS sd FROM (SELECT product_id, network, unit, count(*) AS stores, sum(cents)::DOUBLE AS s, sum(cents * cents)::DOUBLE AS qq, min(cents) AS lo, max(cents) AS hi FROM ls GROUP BY ALL HAVING count(*) >= 2))", more=LATEST)
MED = LATEST + f", md AS (SELECT product_id, unit, network, list_sort(list(cents))[count(*) // 2 + 1] AS m FROM ls WHERE network <> '{B2B}' GROUP BY ALL)"
q("cross_network_medians", lambda t: va.cross_network_medians(va.latest_per_store(ps(t)), (B2B,)), f"SELECT product_id, unit, count(*) AS networks, string_agg(network, ',' ORDER BY network) AS all_networks, first(network ORDER BY m, network) AS cheapest_network, min(m) / 1e2 AS cheapest_price, first(network ORDER BY m DESC, network DESC) AS priciest_network, max(m) / 1e2 AS priciest_price, {r('max(m)::DOUBLE / min(m)')} AS ratio FROM md GROUP BY product_id, unit HAVING count(*) >= 2", more=MED)
q("medians_by_network", lambda t: va.medians_by_network(va.latest_per_store(ps(t))), "SELECT product_id, " + ", ".join(f"max(m) FILTER (network = '{n}') / 1e2 AS price_{n.lower().replace(' ', '_')}" for n in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")) + " FROM (SELECT product_id, network, list_sort(list(cents))[count(*) // 2 + 1] AS m FROM ls GROUP BY ALL) GROUP BY product_id", more=LATEST)
VARIANCES = {
    "intra_uat_variance": (["product_id", "uat_id", "network"], "store_id", 2, (0.1, 1.0, 5.0)),
    "inter_network_variance": (["product_id", "uat_id"], "network", 2, (1.0, 5.0, 10.0)),
    "network_wide_variance": (["product_id", "network"], "uat_id", 3, (2.0, 5.0, 10.0)),
}
for _name, (_keys, _count, _least, _cuts) in VARIANCES.items():
    _v = f"SELECT {', '.join(_keys)}, count(DISTINCT {_count}) AS n, min(cents) / 1e2 AS min_price, max(cents) / 1e2 AS max_price, {MEAN} AS avg_price, {r('1e2 * (max(cents) - min(cents)) / (sum(cents)::DOUBLE / count(cents))')} AS spread_pct FROM ps GROUP BY {', '.join(_keys)} HAVING count(DISTINCT {_count}) >= {_least}"
    _plan = lambda t, k=_keys, c=_count, n=_least: va.variance(ps(t), k, c, n)
    q(_name, _plan, _v)
    a, b, c = (f"{x:e}" for x in _cuts)
    q(f"variance_bands_{_name.removesuffix('_variance')}", lambda t, p=_plan, cuts=_cuts: va.variance_bands(p(t), cuts), f"SELECT count(*) AS groups, median(spread_pct) AS median_pct, min(spread_pct) AS min_pct, max(spread_pct) AS max_pct, count(*) FILTER (spread_pct < {a}) AS band0, count(*) FILTER (spread_pct >= {a} AND spread_pct < {b}) AS band1, count(*) FILTER (spread_pct >= {b} AND spread_pct < {c}) AS band2, count(*) FILTER (spread_pct >= {c}) AS band3 FROM v", more=f"v AS ({_v})")
    q(f"top_{_name}", lambda t, p=_plan, k=_keys: va.top_variance(p(t), k), f"SELECT * FROM v ORDER BY spread_pct DESC, {', '.join(_keys)} LIMIT 5", more=f"v AS ({_v})")
q("coverage_impact", lambda t: va.coverage_impact(ps(t), t.stores), f"SELECT a AS stores_with_prices, b AS pairs, c AS total, {r('1e2 * (a - b) / a', 1)} AS reduction_pct FROM (SELECT (SELECT count(DISTINCT store_id) FROM ps) AS a, (SELECT count(*) FROM (SELECT DISTINCT uat_id, network FROM ps)) AS b, (SELECT count(*) FROM stores) AS c)")
UNI = f"u AS (SELECT product_id, network, price_date, count(DISTINCT store_id) AS store_count, count(DISTINCT cents) AS distinct_prices, {STATS} FROM ps GROUP BY ALL HAVING count(DISTINCT store_id) >= 3)"
q("price_uniformity", lambda t: text_dates(va.price_uniformity(ps(t, "list"))), "SELECT * REPLACE (price_date::VARCHAR AS price_date) FROM u", "list", UNI)
q("uniformity_by_network", lambda t: va.uniformity_by_network(va.price_uniformity(ps(t, "list"))), f"SELECT network, count(*) AS groups, {r('1e2 * count(*) FILTER (distinct_prices = 1) / count(*)', 1)} AS uniform_pct, max(spread_pct) FILTER (rn = floor(n * 5e-1)) AS p50, max(spread_pct) FILTER (rn = floor(n * 5e-2)) AS p95, max(spread_pct) AS max_pct FROM (SELECT *, row_number() OVER (PARTITION BY network ORDER BY spread_pct DESC, product_id, price_date) - 1 AS rn, count(*) OVER (PARTITION BY network) AS n FROM u) GROUP BY network", "list", UNI)
q("top_variable", lambda t: va.top_variable(va.price_uniformity(ps(t, "list"))), "SELECT product_id, network, max(spread_pct) AS spread_pct FROM (SELECT * FROM u ORDER BY spread_pct DESC, product_id, network, price_date LIMIT 20) GROUP BY ALL", "list", UNI)
SIM = f"g AS (SELECT network, type_id, product_id, price_date, count(DISTINCT store_id) AS stores, {STATS} FROM ps WHERE price_date >= DATE '1995-01-01' GROUP BY ALL HAVING count(DISTINCT store_id) >= 3), gb AS (SELECT *, CASE WHEN spread_pct < 1 THEN 0 WHEN spread_pct < 5 THEN 1 WHEN spread_pct < 10 THEN 2 ELSE 3 END AS b FROM g)"
SHARES = ", ".join(f"{r(f'1e2 * count(*) FILTER (b = {k}) / count(*)', 1)} AS pct_b{k}" for k in range(4))
sims = lambda t: va.similarity_groups(ps(t, "list"), "1995-01-01")
q("similarity_groups", lambda t: text_dates(sims(t)), "SELECT * REPLACE (price_date::VARCHAR AS price_date) FROM g", "list", SIM)
q("similarity_tiers", lambda t: va.similarity_tiers(sims(t)), f"SELECT *, CASE WHEN pct_b0 >= 80 THEN 'A' WHEN 100 - pct_b3 >= 50 AND pct_b0 >= 40 THEN 'B' ELSE 'C' END AS tier FROM (SELECT network, type_id, count(*) AS groups, count(DISTINCT product_id) AS products, {SHARES} FROM gb GROUP BY ALL)", "list", SIM)
q("similarity_trend", lambda t: text_dates(va.similarity_trend(sims(t), 700)), f"SELECT network, type_id, window_start::VARCHAR AS window_start, count(*) AS groups, {SHARES} FROM (SELECT gb.*, (SELECT max(o.d) FROM opens o WHERE o.network = gb.network AND o.type_id = gb.type_id AND o.d <= gb.price_date) AS window_start FROM gb) GROUP BY ALL", "list", SIM + ", ds AS (SELECT DISTINCT network, type_id, price_date AS d FROM gb), nx AS (SELECT a.network, a.type_id, a.d, min(b.d) AS nxt FROM ds a LEFT JOIN ds b ON a.network = b.network AND a.type_id = b.type_id AND b.d >= a.d + 700 GROUP BY ALL), o1 AS (SELECT network, type_id, min(d) AS d FROM ds GROUP BY ALL), " + ", ".join(f"o{k} AS (SELECT nx.network, nx.type_id, nx.nxt AS d FROM o{k - 1} o JOIN nx ON o.network = nx.network AND o.type_id = nx.type_id AND o.d = nx.d WHERE nx.nxt IS NOT NULL)" for k in range(2, 8)) + ", opens AS (" + " UNION ALL ".join(f"SELECT * FROM o{k}" for k in range(1, 8)) + ")")
SINCE = "1995-01-01"
sentinels = lambda t: va.sentinel_stores(ps(t), t.stores, since=SINCE)
KM6 = "round(2 * 6371e0 * asin(sqrt(least(1e0, pow(sin(radians({a}.lat - {b}.lat) / 2), 2) + cos(radians({b}.lat)) * cos(radians({a}.lat)) * pow(sin(radians({a}.lon - {b}.lon) / 2), 2)))), 6)"
PICKS = f"""cand AS (SELECT * FROM (SELECT network, store_id, products_covered, lat, lon, row_number() OVER (PARTITION BY network ORDER BY products_covered DESC, store_id) AS rn FROM (SELECT network, store_id, count(DISTINCT product_id) AS products_covered FROM ps WHERE cents > 0 AND fetched_at >= DATE '{SINCE}' GROUP BY ALL) JOIN (SELECT id AS store_id, lat, lon FROM stores) USING (store_id)) WHERE rn <= 20),
pick1 AS (SELECT * FROM cand WHERE rn = 1),
pick2 AS (SELECT c.* FROM cand c JOIN pick1 a USING (network) WHERE c.rn <> a.rn QUALIFY row_number() OVER (PARTITION BY network ORDER BY {KM6.format(a='c', b='a')} DESC, c.rn) = 1),
pick3 AS (SELECT c.* FROM cand c JOIN pick1 a USING (network) JOIN pick2 b USING (network) WHERE c.rn NOT IN (a.rn, b.rn) QUALIFY row_number() OVER (PARTITION BY network ORDER BY least({KM6.format(a='c', b='a')}, {KM6.format(a='c', b='b')}) DESC, c.rn) = 1),
picks AS (SELECT *, 1::BIGINT AS pick_no FROM pick1 UNION ALL SELECT *, 2 FROM pick2 UNION ALL SELECT *, 3 FROM pick3),
sentinels AS (SELECT network, store_id, pick_no, products_covered, lat, lon, (SELECT max({KM6.format(a='x', b='y')}) FROM picks x JOIN picks y USING (network) WHERE x.network = picks.network) AS spread_km FROM picks)"""
q("sentinel_stores", sentinels, "SELECT * FROM sentinels", more=PICKS)
q("sentinel_networks", lambda t: va.sentinel_networks(va.similarity_tiers(sims(t))), "SELECT network, bool_and(100 * b0 >= 80 * n) AS all_a, count(*) AS types FROM (SELECT network, type_id, count(*) AS n, count(*) FILTER (b = 0) AS b0 FROM gb GROUP BY ALL) GROUP BY network", "list", SIM)
q("modal_price_agreement", lambda t: va.modal_price_agreement(cs(t, "list")), "SELECT product_id, count(*) AS networks, min(mode) / 1e2 AS mode_min, max(mode) / 1e2 AS mode_max, min(mode) = max(mode) AS identical, max(mode) <= min(mode) * 1.01::DOUBLE AS within_1, max(mode) <= min(mode) * 1.05::DOUBLE AS within_5, min(mode) = max(mode) AND count(*) >= 3 AND min(stores) >= 3 AS robust FROM (SELECT product_id, network, first(cents ORDER BY n DESC, cents) AS mode, sum(n) AS stores FROM (SELECT product_id, network, cents, count(*) AS n FROM cs GROUP BY ALL) GROUP BY ALL) GROUP BY product_id HAVING count(*) >= 2", "list")
q("spread_distribution", lambda t: va.spread_distribution(cs(t, "list")), f"SELECT rows, CASE WHEN p < 1 THEN '0-1' WHEN p < 5 THEN '1-5' WHEN p < 10 THEN '5-10' WHEN p < 25 THEN '10-25' WHEN p < 50 THEN '25-50' ELSE '50+' END AS band, count(*) AS products FROM (SELECT rows, product_id, {r('1e2 * (max(m) - min(m)) / min(m)')} AS p FROM (SELECT rows, product_id, network, floor(sum(cents)::DOUBLE / count(*) + 5e-1)::BIGINT AS m FROM (SELECT 'all' AS rows, * FROM cs UNION ALL SELECT 'regular', * FROM cs WHERE promo IS NULL) GROUP BY ALL) GROUP BY ALL HAVING count(*) >= 2) GROUP BY ALL", "list")
q("network_coverage_hist", lambda t: va.network_coverage_hist(cs(t)), "SELECT networks, count(*) AS products FROM (SELECT count(DISTINCT network) AS networks FROM cs GROUP BY product_id) GROUP BY networks")
q("single_network_products", lambda t: va.single_network_products(ps(t).filter(F.col("price_date") == F.lit(t.latest_date))), f"SELECT network, count(*) AS products FROM (SELECT product_id, min(network) AS network FROM ps WHERE price_date = {DAY} GROUP BY 1 HAVING count(DISTINCT network) = 1) GROUP BY 1")
q("snapshot_age", lambda t: va.snapshot_age(t.current(), as_of(t)), "SELECT count(*) AS n_rows, " + ", ".join(f"count(*) FILTER ({ASOF} - fetched_at <= {d}) AS within_{d}" for d in (1, 7, 14, 30)) + f", count(*) FILTER ({ASOF} - fetched_at > 30) AS older FROM current_p")

# --- index

FLAG_SQL = "fl AS (SELECT p.product_id, p.store_id, p.price_date FROM prices p WHERE p.promo IS NOT NULL AND p.cents < 2e-1 * (SELECT avg(cents) FROM prices))"


def index_sql(by: str = "", src: str = "ps") -> str:
    g = f"{by}, " if by else ""
    return f"SELECT {g}network, floor(sum(ratio)::DOUBLE / count(*) / 1e4 * 1e2 + 5e-1) / 1e2 AS price_index, count(*) AS products FROM (SELECT {g}network, floor(m::DOUBLE / low * 1e6 + 5e-1)::BIGINT AS ratio FROM (SELECT *, min(m) OVER (PARTITION BY {g}product_id) AS low, count(*) OVER (PARTITION BY {g}product_id) AS k FROM (SELECT {g}product_id, network, floor(sum(cents)::DOUBLE / count(*) + 5e-1)::BIGINT AS m FROM {src} GROUP BY ALL)) WHERE k >= 3 AND low > 0) GROUP BY ALL"


def with_category(t: Tables, df: DataFrame) -> DataFrame:
    return df.join(t.products.select(F.col("id").alias("product_id"), "categ_id"), "product_id")


PC = "pc AS (SELECT ps.*, categ_id FROM ps JOIN products ON products.id = product_id)"
deep = lambda t: quality.flag_promo_depth(t.current())
DEEP = "rg AS (SELECT product_id, sum(cents)::DOUBLE / count(*) AS m FROM current_p WHERE promo IS NULL GROUP BY product_id), dp AS (SELECT c.*, m FROM current_p c JOIN rg USING (product_id) WHERE promo IS NOT NULL AND cents < m * 2e-1)"
q("clean_prices", lambda t: text_dates(ix.clean_prices(t.prices(), deep(t)).select("product_id", "store_id", "price_date", "cents")), "SELECT p.product_id, p.store_id, p.price_date::VARCHAR AS price_date, p.cents FROM prices p ANTI JOIN dp USING (product_id, store_id, price_date)", more=DEEP)
q("price_index", lambda t: ix.price_index(ps(t)), index_sql())
q("price_index_clean", lambda t: ix.price_index(ps(t), flags=deep(t)), index_sql(src="cl"), more=DEEP + ", cl AS (SELECT ps.* FROM ps ANTI JOIN dp USING (product_id, store_id, price_date))")
q("price_index_by_category", lambda t: ix.price_index(with_category(t, ps(t)), ("categ_id",)), index_sql("categ_id", "pc"), more=PC)
q("network_trends", lambda t: text_dates(ix.price_index(ps(t), ("price_date",))), "SELECT * REPLACE (price_date::VARCHAR AS price_date) FROM (" + index_sql("price_date") + ")")
q("category_trends", lambda t: text_dates(ix.category_trends(ps(t), t.products)), f"SELECT categ_id, price_date::VARCHAR AS price_date, {MEAN} AS avg_price, count(DISTINCT product_id) AS products FROM pc GROUP BY 1, 2", more=PC)
MOV = f"mv AS (SELECT product_id, fd, ld, floor(sum(cents) FILTER (price_date = fd)::DOUBLE / count(*) FILTER (price_date = fd) + 5e-1) AS a, floor(sum(cents) FILTER (price_date = ld)::DOUBLE / count(*) FILTER (price_date = ld) + 5e-1) AS b FROM (SELECT *, min(price_date) OVER (PARTITION BY product_id) AS fd, max(price_date) OVER (PARTITION BY product_id) AS ld FROM ps WHERE price_date >= {DAY} - 366) WHERE fd < ld GROUP BY ALL HAVING count(DISTINCT network) >= 2), mo AS (SELECT product_id, a / 1e2 AS price_start, b / 1e2 AS price_end, {r('1e2 * (b - a) / a')} AS change_pct, fd::VARCHAR AS first_date, ld::VARCHAR AS last_date FROM mv WHERE a > 0)"
q("price_movers", lambda t: text_dates(ix.price_movers(ps(t), t.latest_date, days=366)), "SELECT * FROM (SELECT *, 'up' AS direction FROM mo WHERE change_pct > 0 ORDER BY change_pct DESC, product_id LIMIT 50) UNION ALL SELECT * FROM (SELECT *, 'down' AS direction FROM mo WHERE change_pct < 0 ORDER BY change_pct, product_id LIMIT 50)", more=MOV)
q("promo_effectiveness", lambda t: ix.promo_effectiveness(cs(t, "list"), exclude=(B2B,)), f"SELECT network, count(*) AS promo_products, count(*) FILTER (best < flo) AS genuinely_cheap, {r('1e2 * count(*) FILTER (best < flo) / count(*)', 1)} AS pct_genuinely_cheap, {r('sum(floor(1e6 * best / flo + 5e-1)::BIGINT)::DOUBLE / count(*) / 1e4', 1)} AS avg_promo_vs_market_min_pct FROM (SELECT product_id, network, min(cents) AS best FROM cs WHERE promo IS NOT NULL AND network <> '{B2B}' GROUP BY ALL) JOIN (SELECT product_id, min(cents) AS flo FROM cs WHERE promo IS NULL AND network <> '{B2B}' GROUP BY ALL) USING (product_id) WHERE flo > 0 GROUP BY network HAVING count(*) >= 5", "list")
q("store_price_index", lambda t: ix.store_price_index(cs(t), (B2B,), min_stores=20), f"SELECT store_id, network, avg_price, products_priced, rn <= 100 AS cheapest, rn > n - 20 AS priciest FROM (SELECT *, row_number() OVER (ORDER BY avg_price, store_id) AS rn, count(*) OVER () AS n FROM (SELECT store_id, network, {MEAN} AS avg_price, count(DISTINCT product_id) AS products_priced FROM cs WHERE cents > 0 AND network <> '{B2B}' AND product_id IN (SELECT product_id FROM (SELECT product_id, count(DISTINCT store_id) AS n FROM cs GROUP BY 1 HAVING count(DISTINCT store_id) >= 20 ORDER BY n DESC, product_id LIMIT 200)) GROUP BY ALL HAVING count(DISTINCT product_id) >= 20 ORDER BY avg_price, store_id LIMIT 120))")
CMP = f"cp AS (SELECT product_id, count(DISTINCT network) AS networks FROM ps WHERE price_date = {DAY} GROUP BY product_id HAVING count(DISTINCT network) >= 3)"
q("compare_products", lambda t: ix.compare_products(ps(t), t.latest_date), "SELECT * FROM cp", more=CMP)
q("compare_latest", lambda t: ix.compare_latest(ps(t), t.latest_date), f"SELECT product_id, network, {MEAN} AS avg_price, min(cents) / 1e2 AS min_price, max(cents) / 1e2 AS max_price, count(DISTINCT store_id) AS stores FROM ps SEMI JOIN cp USING (product_id) WHERE price_date = {DAY} GROUP BY ALL", more=CMP)
q("compare_history", lambda t: text_dates(ix.compare_history(ps(t), t.latest_date)), f"SELECT product_id, network, price_date::VARCHAR AS price_date, {MEAN} AS avg_price FROM ps SEMI JOIN cp USING (product_id) GROUP BY product_id, network, ps.price_date", more=CMP)
q("coverage_by_network", lambda t: ix.coverage_by_network(ps(t), t.stores, t.latest_date), f"SELECT *, CASE WHEN share_pct >= 50 THEN 'good' WHEN share_pct >= 20 THEN 'partial' ELSE 'low' END AS band FROM (SELECT network, count(DISTINCT store_id) AS stores_with_prices, count(DISTINCT product_id) AS products_covered, any_value(total) AS total_stores, {r('1e2 * count(DISTINCT store_id) / any_value(total)', 1)} AS share_pct FROM ps JOIN (SELECT network, count(*) AS total FROM stores GROUP BY network) USING (network) WHERE price_date = {DAY} GROUP BY network)")
q("summary_counts", lambda t: ix.summary_counts(prices=t.prices(), current=t.current(), stores=t.stores, products=t.products, categories=t.categories, networks=t.networks), " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows FROM {s}" for n, s in (("prices", "prices"), ("current", "current_p"), ("stores", "stores"), ("products", "products"), ("categories", "categories"), ("networks", "networks"))))
q("methodology_stats", lambda t: ix.methodology_stats(ps(t), t.stores, t.products, t.latest_date), f"SELECT (SELECT count(DISTINCT price_date) FROM ps) AS dates, (SELECT min(price_date)::VARCHAR FROM ps) AS earliest, (SELECT max(price_date)::VARCHAR FROM ps) AS latest, 0::BIGINT AS unmapped_stores, (SELECT count(DISTINCT uat_id) FROM stores) AS uats_with_stores, (SELECT count(*) FROM products WHERE id NOT IN (SELECT product_id FROM ps WHERE price_date = {DAY})) AS products_not_priced")
q("top_products", lambda t: ix.top_products(ps(t), t.stores), f"SELECT product_id, count(DISTINCT store_id) AS store_count, count(DISTINCT network) AS network_count, {MEAN} AS avg_price, min(cents) / 1e2 AS min_price, max(cents) / 1e2 AS max_price, {r('1e2 * count(DISTINCT store_id) / (SELECT count(*) FROM stores)', 1)} AS coverage_pct FROM ps GROUP BY product_id ORDER BY store_count DESC, product_id LIMIT 50")
TPC = "SELECT categ_id, product_id, store_count, rank() OVER (PARTITION BY categ_id ORDER BY store_count DESC) AS rank FROM (SELECT categ_id, product_id, count(DISTINCT store_id) AS store_count FROM pc GROUP BY ALL)"
q("top_per_category", lambda t: ix.top_per_category(ps(t), t.products), f"SELECT * FROM ({TPC}) WHERE rank <= 5", more=PC)
q("network_order", lambda t: ix.network_order(ix.price_index(ps(t), ("price_date",))), f"SELECT network, {r('sum(floor(price_index * 1e2 + 5e-1)::BIGINT)::DOUBLE / count(*) / 1e2')} AS mean_index FROM ({index_sql('price_date')}) GROUP BY network")
q("headline", lambda t: ix.headline(ix.price_index(ps(t))), f"SELECT first(network ORDER BY price_index, network) AS cheapest, first(network ORDER BY price_index DESC, network DESC) AS priciest, {r('1e2 * (max(price_index) - min(price_index)) / min(price_index)', 1)} AS spread_pct FROM ({index_sql()})")

# --- baskets and anomalies

NM = f"nm AS (SELECT product_id, network, min(cents) AS cents FROM ps WHERE price_date = {DAY} AND cents > 0 GROUP BY ALL)"
KEPT = NM + ", mid AS (SELECT product_id, median(cents) AS mid FROM nm GROUP BY product_id HAVING count(*) >= 2), kp AS (SELECT nm.* FROM nm JOIN mid USING (product_id) WHERE mid <= 0 OR cents BETWEEN mid * 3e-1 AND mid * 3e0), kept AS (SELECT * FROM kp QUALIFY count(*) OVER (PARTITION BY product_id) >= 2)"
AN = KEPT + f", an AS (SELECT product_id, count(*) AS networks, first(network ORDER BY cents, network) AS cheapest_network, min(cents) / 1e2 AS cheapest_price, first(network ORDER BY cents DESC, network DESC) AS priciest_network, max(cents) / 1e2 AS priciest_price, {r('max(cents)::DOUBLE / min(cents)')} AS ratio, (max(cents) - min(cents)) / 1e2 AS save_lei, floor(1e2 * (max(cents) - min(cents)) / max(cents) + 5e-1)::BIGINT AS save_pct, string_agg(network || '=' || cents::VARCHAR, ';' ORDER BY cents, network) AS by_network FROM kept GROUP BY product_id)"
ANP = AN + ", ac AS (SELECT an.*, categ_id FROM an JOIN products ON products.id = product_id), top300 AS (SELECT * FROM an WHERE ratio >= 15e-1 ORDER BY ratio DESC, product_id LIMIT 300)"


def kept(t: Tables) -> DataFrame:
    return bk.outlier_filter(bk.network_min(ps(t), t.latest_date), min_before=2, min_after=2)


q("network_min", lambda t: bk.network_min(ps(t), t.latest_date), "SELECT * FROM nm", more=NM)
q("network_min_by_uat", lambda t: bk.network_min(ps(t), t.latest_date, ("uat_id",)), f"SELECT uat_id, product_id, network, min(cents) AS cents FROM ps WHERE price_date = {DAY} AND cents > 0 GROUP BY ALL")
q("outlier_filter", kept, "SELECT * FROM kept", more=KEPT)
q("anomalies", lambda t: bk.anomalies(kept(t)), "SELECT * FROM top300", more=ANP)
q("modal_unit_brand", lambda t: bk.modal_unit_brand(t.prices(), t.latest_date), f"SELECT * FROM (SELECT product_id, first(unit ORDER BY n DESC, unit DESC) AS unit FROM (SELECT product_id, unit, count(*) AS n FROM prices WHERE price_date = {DAY} GROUP BY ALL) GROUP BY product_id) JOIN (SELECT product_id, first(brand ORDER BY n DESC, brand DESC) AS brand FROM (SELECT product_id, brand, count(*) AS n FROM prices WHERE price_date = {DAY} GROUP BY ALL) GROUP BY product_id) USING (product_id)")
q("anomaly_summary", lambda t: bk.anomaly_summary(bk.anomalies(kept(t))), "SELECT (SELECT count(*) FROM top300) AS n, (SELECT max(ratio) FROM top300) AS top_ratio, (SELECT sum(floor(save_lei * 1e2 + 5e-1)::BIGINT)::DOUBLE / 1e2 FROM (SELECT * FROM top300 ORDER BY ratio DESC, product_id LIMIT 10)) AS top_saving", more=ANP)
q("anomaly_filter", lambda t: bk.filter_anomalies(bk.anomalies(kept(t)), 2.0, "ASIA"), "SELECT * FROM top300 WHERE ratio >= 2 AND cheapest_network = 'ASIA'", more=ANP)
q("category_spread", lambda t: bk.category_spread(kept(t), t.products), "SELECT categ_id, product_id, networks, cheapest_network, ratio, save_lei, row_number() OVER (PARTITION BY categ_id ORDER BY ratio DESC, product_id) AS rn FROM ac QUALIFY rn <= 200", more=ANP)
q("category_leaderboard", lambda t: bk.category_leaderboard(kept(t), t.products), "SELECT categ_id, cheapest_network, count(*) AS cheapest_count FROM ac GROUP BY ALL", more=ANP)
CI = "SELECT categ_id, count(*) AS products_total, count(ratio) AS products_with_spread, max(ratio) AS top_ratio, coalesce(sum(floor(save_lei * 1e2 + 5e-1)::BIGINT), 0)::DOUBLE / 1e2 AS total_save_lei FROM products LEFT JOIN an ON an.product_id = products.id GROUP BY categ_id"
q("category_index", lambda t: bk.category_index(kept(t), t.products), CI, more=ANP)
q("category_sizes", lambda t: bk.category_sizes(t.categories, t.products), "SELECT c.id, c.name, count(p.id) AS products FROM categories c LEFT JOIN products p ON p.categ_id = c.id GROUP BY ALL")
q("stories", lambda t: bk.stories(kept(t), t.products), f"SELECT 'top_gap' AS story, first(product_id ORDER BY ratio DESC, product_id)::VARCHAR AS value FROM an UNION ALL SELECT 'cheapest_most_often', first(cheapest_network ORDER BY n DESC, cheapest_network DESC) FROM (SELECT cheapest_network, count(*) AS n FROM an GROUP BY 1) UNION ALL SELECT 'largest_saving', first(categ_id ORDER BY total_save_lei DESC, categ_id DESC)::VARCHAR FROM ({CI}) UNION ALL SELECT 'ratio_3_and_more', (count(*) FILTER (ratio >= 3))::VARCHAR FROM an", more=ANP)
BI = NM + ", mid0 AS (SELECT product_id, median(cents) AS mid FROM nm GROUP BY product_id), k0 AS (SELECT nm.* FROM nm JOIN mid0 USING (product_id) WHERE mid <= 0 OR cents BETWEEN mid * 3e-1 AND mid * 3e0), it AS (SELECT basket_id, network, item_no, label, qty, first(product_id ORDER BY cents, product_id) AS product_id, min(cents) AS cents FROM baskets JOIN k0 USING (product_id) WHERE network <> '" + B2B + "' GROUP BY ALL), tot AS (SELECT basket_id, count(DISTINCT item_no) AS items_total FROM baskets GROUP BY 1), sco AS (SELECT basket_id, network, sum(qty * cents)::BIGINT / 1e2 AS cost_week, floor(sum(qty * cents)::BIGINT * 52e0 / 12e0 + 5e-1) / 1e2 AS cost_month, count(*) AS items_found, any_value(items_total) AS items_total, count(*) >= any_value(items_total) * 5e-1 AS comparable FROM it JOIN tot USING (basket_id) GROUP BY ALL)"
BU = f", nu AS (SELECT uat_id, product_id, network, min(cents) AS cents FROM ps WHERE price_date = {DAY} AND cents > 0 GROUP BY ALL), midu AS (SELECT uat_id, product_id, median(cents) AS mid FROM nu GROUP BY ALL), ku AS (SELECT nu.* FROM nu JOIN midu USING (uat_id, product_id) WHERE mid <= 0 OR cents BETWEEN mid * 3e-1 AND mid * 3e0), itu AS (SELECT basket_id, uat_id, network, item_no, qty, min(cents) AS cents FROM baskets JOIN ku USING (product_id) WHERE network <> '{B2B}' GROUP BY ALL), scu AS (SELECT basket_id, uat_id, network, sum(qty * cents)::BIGINT / 1e2 AS cost_week, floor(sum(qty * cents)::BIGINT * 52e0 / 12e0 + 5e-1) / 1e2 AS cost_month, count(*) AS items_found, any_value(items_total) AS items_total, count(*) >= any_value(items_total) * 5e-1 AS comparable FROM itu JOIN tot USING (basket_id) GROUP BY ALL)"


def basket_items(t: Tables) -> DataFrame:
    return bk.score_items(t.baskets, bk.outlier_filter(bk.network_min(ps(t), t.latest_date)).filter(F.col("network") != B2B))


def scored(t: Tables) -> DataFrame:
    return bk.score_basket(basket_items(t), t.baskets)


def scored_uat(t: Tables) -> DataFrame:
    low = bk.outlier_filter(bk.network_min(ps(t), t.latest_date, ("uat_id",)), ("uat_id",)).filter(F.col("network") != B2B)
    return bk.score_basket(bk.score_items(t.baskets, low, ("uat_id",)), t.baskets, ("uat_id",))


q("basket_items", basket_items, "SELECT * FROM it", more=BI)
q("basket_national", scored, "SELECT * FROM sco", more=BI)
q("basket_per_uat", scored_uat, "SELECT * FROM scu", more=BI + BU)
q("basket_index", lambda t: bk.basket_index(scored(t), scored_uat(t)), "SELECT * FROM (SELECT basket_id, min(cost_month) AS cheapest_month, max(cost_month) AS priciest_month, first(network ORDER BY cost_month, network) AS cheapest_network FROM sco WHERE comparable GROUP BY 1) JOIN (SELECT basket_id, count(DISTINCT uat_id) AS uats_covered FROM scu GROUP BY 1) USING (basket_id)", more=BI + BU)
q("basket_rank", lambda t: bk.basket_rank(scored(t)), f"SELECT *, {r('delta_month * 12e0')} AS delta_year FROM (SELECT basket_id, network, cost_month, rank() OVER (PARTITION BY basket_id ORDER BY cost_month) AS rank, {r('cost_month - min(cost_month) OVER (PARTITION BY basket_id)')} AS delta_month FROM sco WHERE comparable)", more=BI)
CP = "nd AS (SELECT price_date, product_id, network, min(cents) AS cents FROM ps WHERE cents > 0 GROUP BY ALL), midd AS (SELECT price_date, product_id, median(cents) AS mid FROM nd GROUP BY ALL), kd AS (SELECT price_date, product_id, min(cents) AS cents FROM nd JOIN midd USING (price_date, product_id) WHERE mid <= 0 OR cents BETWEEN mid * 3e-1 AND mid * 3e0 GROUP BY ALL), ci AS (SELECT basket_id, item_no, label, qty, price_date, min(cents) AS cents FROM baskets JOIN kd USING (product_id) GROUP BY ALL), tot AS (SELECT basket_id, count(DISTINCT item_no) AS items_total FROM baskets GROUP BY 1), cpi AS (SELECT basket_id, price_date, sum(qty * cents)::BIGINT / 1e2 AS cost_week, floor(sum(qty * cents)::BIGINT * 52e0 / 12e0 + 5e-1) / 1e2 AS cost_month, count(*) AS items_found, count(*) >= any_value(items_total) * 5e-1 AS comparable FROM ci JOIN tot USING (basket_id) GROUP BY ALL)"
q("cpi_series", lambda t: text_dates(bk.cpi_series(t.baskets, ps(t))), f"SELECT c.basket_id, c.price_date::VARCHAR AS price_date, cost_week, cost_month, items_found, comparable, {r('1e2 * cost_month / base', 1)} AS index FROM cpi c LEFT JOIN (SELECT basket_id, first(cost_month ORDER BY price_date) AS base FROM cpi WHERE comparable GROUP BY 1) USING (basket_id)", more=CP)
q("cpi_item_changes", lambda t: bk.cpi_item_changes(t.baskets, ps(t)), f"SELECT *, CASE WHEN change_pct > 5e-1 THEN 'up' WHEN change_pct < -5e-1 THEN 'down' ELSE 'flat' END AS direction FROM (SELECT basket_id, label, a / 1e2 AS price_first, b / 1e2 AS price_last, {r('1e2 * (b - a) / a')} AS change_pct FROM (SELECT basket_id, label, first(cents ORDER BY price_date) AS a, first(cents ORDER BY price_date DESC) AS b FROM ci GROUP BY ALL))", more=CP)

# --- quality

OUT = "om AS (SELECT product_id, list_sort(list(cents))[count(*) // 2 + 1] AS med FROM current_p WHERE cents > 0 GROUP BY 1 HAVING count(*) >= 3), od AS (SELECT c.*, med, abs(cents - med) AS dev FROM current_p c JOIN om USING (product_id) WHERE cents > 0), oa AS (SELECT product_id, list_sort(list(dev))[count(*) // 2 + 1] AS mad FROM od GROUP BY 1), fo AS (SELECT od.*, 0.6745::DOUBLE * dev / mad AS z FROM od JOIN oa USING (product_id) WHERE mad > 0 AND 0.6745::DOUBLE * dev / mad > 3)"
SPK = f", dd AS (SELECT (SELECT max(price_date) FROM prices) AS d1, (SELECT max(price_date) FROM prices WHERE price_date < (SELECT max(price_date) FROM prices)) AS d0), sp AS (SELECT a.product_id, a.store_id, a.price_date, a.cents AS now, b.cents AS before FROM prices a JOIN prices b USING (product_id, store_id) WHERE a.price_date = (SELECT d1 FROM dd) AND b.price_date = (SELECT d0 FROM dd) AND b.cents > 0 AND abs(a.cents - b.cents)::DOUBLE / b.cents > 5e-1)"
keyed = lambda df: text_dates(df.select("product_id", "store_id", "price_date", "flag_type"))
_flag = "product_id, store_id, price_date::VARCHAR AS price_date"
q("flag_outliers", lambda t: text_dates(quality.flag_outliers(t.current()).select("product_id", "store_id", "price_date", "flag_type", F.get_json_object("details", "$.price").cast("double").alias("price"), F.get_json_object("details", "$.median").cast("double").alias("median"), F.get_json_object("details", "$.z").cast("double").alias("z"))), f"SELECT {_flag}, 'outlier_price' AS flag_type, cents / 1e2 AS price, med / 1e2 AS median, {r('z')} AS z FROM fo", more=OUT)
q("flag_spikes", lambda t: text_dates(quality.flag_spikes(t.prices()).select("product_id", "store_id", "price_date", "flag_type", F.get_json_object("details", "$.change_pct").cast("double").alias("change_pct"))), f"SELECT {_flag}, 'price_spike' AS flag_type, {r('abs(now - before)::DOUBLE / before * 1e2', 1)} AS change_pct FROM sp", more=OUT + SPK)
q("flag_promo_depth", lambda t: text_dates(deep(t).select("product_id", "store_id", "price_date", "flag_type", F.get_json_object("details", "$.pct_of_regular").cast("double").alias("pct_of_regular"))), f"SELECT {_flag}, 'promo_too_deep' AS flag_type, {r('1e2 * cents / m', 1)} AS pct_of_regular FROM dp", more=DEEP)
FLAGS = OUT + SPK + ", " + DEEP + ", flags AS (SELECT product_id, store_id, price_date, 'outlier_price' AS flag_type FROM fo UNION ALL SELECT product_id, store_id, price_date, 'price_spike' FROM sp UNION ALL SELECT product_id, store_id, price_date, 'promo_too_deep' FROM dp)"


def prices_and_current(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Prices and a snapshot of them, each made once."""
    prices = checkpoint(t.prices(), "prices")
    return prices, checkpoint(ingest.snapshot_latest(prices), "snapshot")


def flags_of(t: Tables) -> DataFrame:
    """All flags, from prices and a snapshot that are each made once."""
    prices, current = prices_and_current(t)
    return quality.all_flags(current, prices)


def flags_upserted(t: Tables) -> DataFrame:
    """The outlier flags, to which all flags come in that are not there yet; prices, snapshot and outliers are each made once."""
    prices, current = prices_and_current(t)
    known = checkpoint(quality.flag_outliers(current), "outliers")
    found = known.unionByName(quality.flag_spikes(prices)).unionByName(quality.flag_promo_depth(current))
    return ingest.insert_absent(known, found, ["product_id", "store_id", "price_date", "flag_type"])


q("all_flags", lambda t: keyed(flags_of(t)), f"SELECT {_flag}, flag_type FROM flags", more=FLAGS)
q("flag_summary", lambda t: quality.flag_summary(flags_of(t)), "SELECT flag_type, count(*) AS flags, count(DISTINCT product_id) AS products, count(DISTINCT store_id) AS stores FROM flags GROUP BY 1", more=FLAGS)
q("flag_upsert", lambda t: keyed(flags_upserted(t)), f"SELECT DISTINCT {_flag}, flag_type FROM flags", more=FLAGS)
FR = f"fr AS (SELECT s.id AS store_id, s.name, s.network, max(fetched_at)::VARCHAR AS last_date, coalesce({ASOF} - max(fetched_at), 9999)::BIGINT AS days_stale, coalesce({ASOF} - max(fetched_at), 9999) > 2 AS stale FROM stores s LEFT JOIN current_p c ON c.store_id = s.id WHERE coalesce(s.is_active, true) GROUP BY ALL)"
fresh = lambda t: quality.store_freshness(t.current(), ingest.active(t.stores), as_of(t))
q("store_freshness", fresh, "SELECT * FROM fr", more=FR)
OUT = "g AS (SELECT product_id, count(*) AS n, sum(cents)::DOUBLE / count(*) AS mean, sum(cents * cents)::DOUBLE / count(*) AS sq, min(cents) AS least, max(cents) AS most FROM current_p WHERE cents > 0 GROUP BY 1), d AS (SELECT *, 3e0 * sqrt(greatest(0e0, sq - mean * mean)) AS far FROM g), z AS (SELECT *, n >= 3 AND sq - mean * mean > 1e1 AND (least < mean - far OR most > mean + far) AS by_z FROM d), bounds AS (SELECT product_id, mean, CASE WHEN by_z THEN mean - far ELSE 0e0 END AS lo, CASE WHEN by_z THEN mean + far ELSE least * 1e1 END AS hi FROM z WHERE by_z OR (n >= 2 AND most > least * 10)), flagged AS (SELECT product_id, count(*) AS outlier_count, max(mean) AS mean FROM current_p JOIN bounds USING (product_id) WHERE cents > 0 AND (cents < lo OR cents > hi) GROUP BY 1)"
q("outlier_summary", lambda t: quality.outlier_summary(t.current()), f"SELECT product_id, outlier_count, {r('mean / 1e2')} AS avg_price FROM flagged", more=OUT)
q("outlier_totals", lambda t: quality.outlier_totals(t.current()), f"SELECT total_records, flagged_count, {r('1e2 * flagged_count / total_records')} AS flagged_pct FROM (SELECT (SELECT count(*) FROM current_p WHERE cents > 0) AS total_records, (SELECT coalesce(sum(outlier_count), 0)::BIGINT FROM flagged) AS flagged_count)", more=OUT)
q("outlier_top_products", lambda t: quality.outlier_summary(t.current()).orderBy(F.desc("outlier_count"), "product_id").limit(20), f"SELECT product_id, outlier_count, {r('mean / 1e2')} AS avg_price FROM flagged ORDER BY outlier_count DESC, product_id LIMIT 20", more=OUT)
q("price_velocity", lambda t: quality.price_velocity(t.prices(), t.current()), f"SELECT {DAY}::VARCHAR AS curr_date, n AS changed_count, c AS total_current, p AS changed_pct, CASE WHEN k < 2 THEN 'insufficient_data' WHEN n = 0 THEN 'stuck' WHEN p > 30 THEN 'bulk_change' ELSE 'ok' END AS status FROM (SELECT *, {r('1e2 * n / c', 1)} AS p FROM (SELECT (SELECT count(*) FROM prices WHERE price_date = {DAY}) AS n, (SELECT count(*) FROM current_p) AS c, (SELECT count(DISTINCT price_date) FROM prices) AS k))")
q("audit_store_freshness", lambda t: quality.audit_store_freshness(fresh(t)), f"SELECT 'store_freshness' AS name, {r('1e2 * count(*) FILTER (stale) / count(*)', 1)} > 10 AS red, count(*) AS stores, count(*) FILTER (stale) AS stale, {r('1e2 * count(*) FILTER (stale) / count(*)', 1)} AS stale_pct FROM fr", more=FR)
RUN_END = "(SELECT max(started) FROM runs)"
run_end = lambda t: t.runs.agg(F.max("started")).first()[0]
q("audit_run_history", lambda t: quality.audit_run_history(t.runs, run_end(t), 3650), f"SELECT id, script, started::VARCHAR AS started, status FROM runs b WHERE status = 'abandoned' AND started >= {RUN_END} - 3650 AND NOT EXISTS (SELECT 1 FROM runs c WHERE c.status = 'completed' AND c.script = b.script AND c.started = b.started)")
q("audit_coverage_gaps", lambda t: quality.audit_coverage_gaps(t.stores, t.current(), as_of(t)), f"SELECT network, count(DISTINCT s.id) AS stores, max(fetched_at)::VARCHAR AS newest, coalesce(max(fetched_at) < {ASOF} - 7, true) AS gap FROM stores s LEFT JOIN current_p c ON c.store_id = s.id GROUP BY network")
drift = lambda t: quality.audit_flag_drift(t.runs.filter("status = 'abandoned'").groupBy(F.col("started").alias("day")).agg(F.count(F.lit(1)).alias("n")))
q("audit_flag_drift", drift, "SELECT 'flag_drift' AS name, coalesce(max(n) FILTER (rn = 1) > median(n) FILTER (rn BETWEEN 2 AND 31) * 3, false) AS red, max(n) FILTER (rn = 1) AS today, median(n) FILTER (rn BETWEEN 2 AND 31) AS usual FROM (SELECT started, count(*) AS n, row_number() OVER (ORDER BY started DESC) AS rn FROM runs WHERE status = 'abandoned' GROUP BY started)")
q("audit_overall", lambda t: quality.audit_overall(quality.audit_store_freshness(fresh(t)), drift(t)), f"SELECT CASE WHEN (SELECT 1e2 * count(*) FILTER (stale) / count(*) > 10 FROM fr) OR (SELECT coalesce(max(n) FILTER (rn = 1) > median(n) FILTER (rn BETWEEN 2 AND 31) * 3, false) FROM (SELECT started, count(*) AS n, row_number() OVER (ORDER BY started DESC) AS rn FROM runs WHERE status = 'abandoned' GROUP BY started)) THEN 'RED' ELSE 'GREEN' END AS overall", more=FR)
q("traffic_light", lambda t: quality.traffic_light(fresh(t).select("store_id", "days_stale"), "days_stale", 1, 2), "SELECT store_id, days_stale, CASE WHEN days_stale > 2 THEN 'red' WHEN days_stale > 1 THEN 'yellow' ELSE 'green' END AS light FROM fr", more=FR)
q("run_health", lambda t: quality.run_health(t.runs, run_end(t)), f"SELECT script, id, {RUN_END} - started AS age_days, records, CASE WHEN {RUN_END} - started > 2 THEN 'old' WHEN records <= 0 THEN 'empty' ELSE 'ok' END AS reason FROM runs WHERE status = 'completed' QUALIFY row_number() OVER (PARTITION BY script ORDER BY started DESC, id DESC) = 1")
q("run_islands", lambda t: quality.run_islands(t.runs), "SELECT script, island, status, first(id ORDER BY started DESC, id DESC) AS latest_id, count(*) AS count FROM (SELECT *, sum(new) OVER (PARTITION BY script ORDER BY started, id)::BIGINT AS island FROM (SELECT *, coalesce((lag(status) OVER (PARTITION BY script ORDER BY started, id) <> status)::INT, 1) AS new FROM runs)) GROUP BY script, island, status")
q("run_status_by_script", lambda t: quality.run_status_by_script(t.runs, run_end(t)), "SELECT script, " + ", ".join(f"count(*) FILTER (status = '{s}' AND started >= {RUN_END} - 30) AS {s}" for s in ("completed", "running", "abandoned")) + f", (max(started) FILTER (status = 'completed'))::VARCHAR AS last_ok, coalesce({RUN_END} - max(started) FILTER (status = 'completed') > 30, true) AS stale FROM runs GROUP BY script")

# --- geo

KM = "2 * 6371e0 * asin(sqrt(least(1e0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"
q("surrounding_population", lambda t: geo.surrounding_population(t.stores, t.localities), f"SELECT s.id AS store_id, coalesce(sum(l.population), 0)::BIGINT AS surrounding_population FROM stores s LEFT JOIN localities l ON {KM.format(a='s', b='l')} <= 10 GROUP BY s.id")
q("near_pairs", lambda t: geo.near_pairs(t.stores, t.stores, 5).select("a_id", "b_id"), f"SELECT a.id AS a_id, b.id AS b_id FROM stores a JOIN stores b ON {KM.format(a='a', b='b')} <= 5")
ORDERED = "ordered AS (SELECT row_number() OVER (ORDER BY population DESC, id) AS i, id, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY population DESC, id) AS rn FROM localities) WHERE rn = 1), "
GREEDY = "greedy AS (SELECT 0::BIGINT AS i, []::STRUCT(id BIGINT, lat DOUBLE, lon DOUBLE)[] AS kept UNION ALL SELECT g.i + 1, CASE WHEN len(list_filter(kept, lambda k: " + KM.format(a="k", b="o") + " < 4)) > 0 THEN kept ELSE list_append(kept, {'id': o.id, 'lat': o.lat, 'lon': o.lon}) END FROM greedy g JOIN ordered o ON o.i = g.i + 1)"
q("dedup_points", lambda t: geo.dedup_points(t.localities), "SELECT p.id, p.lat, p.lon FROM (SELECT unnest(kept) AS p FROM (SELECT kept FROM greedy ORDER BY i DESC LIMIT 1))", more=ORDERED + GREEDY)
SQL["dedup_points"] = SQL["dedup_points"].replace("WITH ", "WITH RECURSIVE ", 1)
clusters = lambda t: geo.store_clusters(t.stores)
q("store_clusters", clusters)
boxes = lambda t: t.stores.groupBy("uat_id").agg(F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lon").alias("west"), F.max("lon").alias("east"), F.sum("population").alias("population")).withColumnRenamed("uat_id", "label")
q("sampling_points", lambda t: geo.sampling_points(boxes(t), 1000, 80).select("label", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon")), "SELECT label, round(CASE WHEN km <= 10 THEN mid ELSE south + i * a END, 6) AS lat, round(CASE WHEN km <= 10 THEN (west + east) / 2 ELSE west + j * o END, 6) AS lon FROM (SELECT *, unnest(range(0, CASE WHEN km <= 10 THEN 1 ELSE floor((east - west) / o + 5e-1)::BIGINT + 1 END)) AS j FROM (SELECT *, unnest(range(0, CASE WHEN km <= 10 THEN 1 ELSE floor((north - south) / a + 5e-1)::BIGINT + 1 END)) AS i FROM (SELECT *, (south + north) / 2 AS mid, 80e0 / 111e0 AS a, 80e0 / (111e0 * cos(radians((south + north) / 2))) AS o, 2 * 6371e0 * asin(sqrt(least(1e0, pow(sin(radians(north - south) / 2), 2) + cos(radians(south)) * cos(radians(north)) * pow(sin(radians(east - west) / 2), 2)))) AS km FROM (SELECT uat_id AS label, min(lat) AS south, max(lat) AS north, min(lon) AS west, max(lon) AS east, sum(population) AS population FROM stores GROUP BY uat_id)) WHERE population >= 1000))")
first_place = lambda t: t.stores.orderBy("id").select("lat", "lon").first() or (0.0, 0.0)  # noqa: E731  around the store of least id
q("nearby_stores", lambda t: geo.nearby_stores(t.stores, *first_place(t), 80), "SELECT id, network, d AS dist_m FROM (SELECT id, network, floor(" + KM.format(a="c", b="s") + " * 1e3 + 5e-1)::BIGINT AS d FROM stores s, (SELECT lat, lon FROM stores ORDER BY id LIMIT 1) c) WHERE d <= 80000 ORDER BY d, id LIMIT 200")
q("stores_index", lambda t: geo.stores_index(t.stores, scored_uat(t), scored(t), "staples"), "SELECT s.id, s.name, s.network, s.uat_id, coalesce(own, (SELECT min(cost_month) FROM sco WHERE comparable AND basket_id = 'staples')) AS basket_min_month FROM stores s LEFT JOIN (SELECT uat_id, min(cost_month) AS own FROM scu WHERE comparable AND basket_id = 'staples' GROUP BY 1) USING (uat_id)", more=BI + BU)
COSTS = "min(cost_month) AS {p}min, max(cost_month) AS {p}max, count(*) AS {p}k, first(network ORDER BY cost_month, network) AS {p}net"
UST = BI + BU + f", us AS (SELECT uat_id, n_stores, n_networks, CASE WHEN k IS NULL THEN n_min ELSE min END AS basket_min_month, CASE WHEN k IS NULL THEN n_max ELSE max END AS basket_max_month, coalesce(k, n_k) AS basket_n_networks, CASE WHEN k IS NULL THEN n_net ELSE net END AS cheapest_net, k IS NULL AS national FROM (SELECT uat_id, count(*) AS n_stores, count(DISTINCT network) FILTER (network <> '{B2B}') AS n_networks FROM stores GROUP BY 1) LEFT JOIN (SELECT uat_id, {COSTS.format(p='')} FROM scu WHERE comparable AND basket_id = 'staples' GROUP BY 1) USING (uat_id), (SELECT {COSTS.format(p='n_')} FROM sco WHERE comparable AND basket_id = 'staples'))"
ustats = lambda t: geo.uat_stats(t.stores, scored_uat(t), "staples", (B2B,), scored(t))
q("uat_stats", ustats, "SELECT * FROM us", more=UST)
q("uat_kpis", lambda t: geo.uat_kpis(ustats(t)), "SELECT count(*) FILTER (n_networks >= 1) AS covered, count(*) FILTER (n_networks = 1) AS deserts, (SELECT uat_id FROM us WHERE basket_min_month IS NOT NULL ORDER BY basket_min_month, uat_id LIMIT 1) AS cheapest_uat FROM us", more=UST)
q("uat_bins", lambda t: geo.uat_bins(ustats(t), "n_stores", [3, 10, 30, 100]), "SELECT uat_id, n_stores, (n_stores >= 3)::BIGINT + (n_stores >= 10)::BIGINT + (n_stores >= 30)::BIGINT + (n_stores >= 100)::BIGINT AS bin FROM us", more=UST)
q("stores_for_map", lambda t: geo.stores_for_map(t.stores), f"SELECT id, name, network, {r('lat', 3)} AS lat, {r('lon', 3)} AS lon FROM stores")
q("grid_order", lambda t: t.stores.select("id", sc.snake_key(F.col("lat"), F.col("lon")).alias("k")).select("id", F.col("k.row").cast("long").alias("row"), F.col("k.col").cast("long").alias("col")), "SELECT id, r AS row, CASE WHEN r % 2 = 0 THEN c ELSE 1000 - c END AS col FROM (SELECT id, trunc((lat - 43.6::DOUBLE) / 0.45::DOUBLE)::BIGINT AS r, trunc((lon - 20.3::DOUBLE) / 0.45::DOUBLE)::BIGINT AS c FROM stores)")

# --- text

TOPS = "tops AS (SELECT p.id, coalesce(u.name, c.name) AS top FROM products p LEFT JOIN categories c ON c.id = p.categ_id LEFT JOIN categories u ON u.id = c.parent_id AND u.parent_id IS NOT NULL)"
tops = lambda t: ix.top_level_category(t.products, t.categories)
q("brands", lambda t: text.brands(t.prices(), tops(t)), "SELECT key, first(brand ORDER BY n DESC, brand DESC) AS canonical, sum(n)::BIGINT AS total, count(*) AS variant_count, string_agg(brand || ' (' || n || ')', '; ' ORDER BY brand || ' (' || n || ')') AS variants, array_to_string(list_sort(list_distinct(flatten(list(cats)))), ', ') AS categories FROM (SELECT brand, regexp_replace(upper(brand), '[^A-Z0-9]', '', 'g') AS key, count(*) AS n, list(DISTINCT top) AS cats FROM prices JOIN tops ON id = product_id GROUP BY ALL) GROUP BY key ORDER BY total DESC, key LIMIT 150", more=TOPS)
STOP = ", ".join(f"'{w}'" for w in sc.STOPWORDS)
TOK = rf"part_names AS (SELECT p_partkey AS id, p_name AS name FROM part), wl AS (SELECT id, list_filter(string_split_regex(name, '[\s/,.\-–()\[\]]+'), lambda w: length(w) >= 3 AND lower(w) NOT IN ({STOP}) AND NOT regexp_full_match(lower(w), '\d+[.,]?\d*\s*[gklmc][gl]?') AND NOT regexp_full_match(w, '[.,]*\d[\d.,]*')) AS words FROM part_names)"
q("word_freq", lambda t: text.ngrams(t.products.join(tops(t), "id"), 1, category="top_category"), "SELECT lower(raw) AS token, first(raw ORDER BY n DESC, raw DESC) AS canonical, sum(n)::BIGINT AS count, array_to_string(list_sort(list_distinct(flatten(list(cats)))), ', ') AS categories FROM (SELECT raw, count(*) AS n, list(DISTINCT top) AS cats FROM (SELECT id, unnest(words) AS raw FROM wl) JOIN tops USING (id) GROUP BY raw) GROUP BY 1 ORDER BY count DESC, token LIMIT 150", more=TOPS + ", " + TOK)
q("bigram_freq", lambda t: text.ngrams(t.products.join(tops(t), "id"), 2, category="top_category"), "SELECT lower(raw) AS token, first(raw ORDER BY n DESC, raw DESC) AS canonical, sum(n)::BIGINT AS count, array_to_string(list_sort(list_distinct(flatten(list(cats)))), ', ') AS categories FROM (SELECT raw, count(*) AS n, list(DISTINCT top) AS cats FROM (SELECT id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS raw FROM wl) JOIN tops USING (id) GROUP BY raw) GROUP BY 1 ORDER BY count DESC, token LIMIT 150", more=TOPS + ", " + TOK)
q("document_bigrams", lambda t: text.ngrams(t.raw("documents").select(F.col("doc_id").alias("id"), "text"), 2, text="text"), f"SELECT lower(translate(raw, '{sc.MARKED}', '{sc.PLAIN}')) AS token, first(raw ORDER BY n DESC, raw DESC) AS canonical, sum(n)::BIGINT AS count FROM (SELECT raw, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS raw FROM wl) GROUP BY raw) GROUP BY 1 ORDER BY count DESC, token LIMIT 150", more=TOK.replace("p_partkey AS id, p_name AS name FROM part", "doc_id AS id, coalesce(text, '') AS name FROM documents").replace("lower(w)", f"lower(translate(w, '{sc.MARKED}', '{sc.PLAIN}'))").replace("length(w)", f"length(translate(w, '{sc.MARKED}', '{sc.PLAIN}'))"))
q("category_anomalies", lambda t: text.category_anomalies(t.products), f"SELECT p.id AS product_id, p.p_brand AS brand, p.categ_id, d.categ_id AS dominant_categ, {r('1e2 * n / a', 1)} AS dominant_share_pct FROM products p JOIN (SELECT p_brand, categ_id, n, a FROM (SELECT *, sum(n) OVER (PARTITION BY p_brand)::BIGINT AS a, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, categ_id) AS rn FROM (SELECT p_brand, categ_id, count(*) AS n FROM products GROUP BY ALL)) WHERE rn = 1 AND a >= 5 AND n >= a * 8e-1) d USING (p_brand) WHERE p.categ_id <> d.categ_id")

# --- sampling

SURR = f"sur AS (SELECT s.id, s.network, s.lat, s.lon, coalesce(sum(l.population), 0)::BIGINT AS population FROM stores s LEFT JOIN localities l ON {KM.format(a='s', b='l')} <= 10 GROUP BY ALL), snake AS (SELECT *, CASE WHEN r % 2 = 0 THEN c ELSE 1000 - c END AS sc FROM (SELECT *, trunc((lat - 43.6::DOUBLE) / 0.45::DOUBLE)::BIGINT AS r, trunc((lon - 20.3::DOUBLE) / 0.45::DOUBLE)::BIGINT AS c FROM sur))"
BAND = "SELECT id FROM (SELECT id FROM (SELECT *, row_number() OVER (ORDER BY population, id) AS rn, count(*) OVER () AS n FROM snake) WHERE rn > n * 35e-2 AND rn <= n * 65e-2 ORDER BY r, sc, population, id LIMIT 50)"
surrounded = lambda t: t.stores.drop("population").join(geo.surrounding_population(t.stores, t.localities).withColumnsRenamed({"store_id": "id", "surrounding_population": "population"}), "id")
POP = "SELECT product_id FROM (SELECT product_id, (rank() OVER (ORDER BY a DESC)) + (rank() OVER (ORDER BY b DESC)) AS br FROM (SELECT product_id, count(DISTINCT store_id) AS a, count(*) AS b FROM ps GROUP BY 1)) ORDER BY br, product_id LIMIT 50"
q("ci_stores", lambda t: sampling.ci_stores(surrounded(t)), f"SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY network ORDER BY population DESC, id) AS rn FROM sur) WHERE rn <= 10 UNION {BAND}", more=SURR)
q("ci_products", lambda t: sampling.ci_products(ps(t), t.products), f"SELECT product_id FROM ({POP}) UNION SELECT product_id FROM ({TPC}) WHERE rank <= 20", more=PC)
q("default_basket", lambda t: sampling.default_basket(ps(t)), "SELECT product_id, count(DISTINCT store_id) AS stores FROM ps GROUP BY 1 ORDER BY stores DESC, product_id LIMIT 30")
q("store_order", lambda t: sampling.store_order(ingest.active(t.stores), t.current(), as_of(t)), "SELECT store_id, days_stale AS age_days FROM fr", more=FR)
q("product_order", lambda t: sampling.product_order(t.products, t.current()), "SELECT p.id AS product_id, max(fetched_at)::VARCHAR AS newest, max(fetched_at) IS NULL AS never FROM products p LEFT JOIN current_p c ON c.product_id = p.id GROUP BY p.id")
q("ghost_products", lambda t: sampling.ghost_products(t.products, t.prices().filter(F.col("price_date") == F.lit(t.latest_date))), f"SELECT id AS product_id FROM products WHERE id NOT IN (SELECT product_id FROM prices WHERE price_date = {DAY})")
q("products_for_stores", lambda t: sampling.products_for_stores(t.prices(), t.stores.filter(F.col("network") == B2B), t.prices().filter("promo is not null").select("product_id").distinct()), f"SELECT DISTINCT product_id FROM ps WHERE network = '{B2B}' AND product_id IN (SELECT product_id FROM prices WHERE promo IS NOT NULL)")
CH = "ch AS (SELECT store_id, CASE WHEN rn = 1 THEN 'new' ELSE 'changed' END AS change_type FROM (SELECT *, row_number() OVER w AS rn, lag(cents) OVER w AS pc, lag(promo) OVER w AS pp FROM prices WINDOW w AS (PARTITION BY product_id, store_id ORDER BY fetched_at, cents)) WHERE rn = 1 OR cents IS DISTINCT FROM pc OR promo IS DISTINCT FROM pp)"
q("canary_networks", lambda t: sampling.canary_networks(ingest.ingest_changes(t.prices()), t.stores), "SELECT network, count(DISTINCT store_id) AS stores, count(*) FILTER (change_type = 'changed') AS changed, count(DISTINCT store_id) >= 3 AND count(*) FILTER (change_type = 'changed') = 0 AS unchanged FROM ch JOIN stores ON stores.id = store_id GROUP BY network", more=CH)
q("weekly_products", lambda t: sampling.weekly_products(ingest.last_changes(t.prices()), as_of(t)), f"SELECT DISTINCT product_id FROM moved WHERE last_changed_at < {ASOF} - 30")
q("cluster_order", lambda t: sampling.cluster_order(clusters(t), sampling.store_order(t.stores, t.current(), as_of(t))))
q("store_order_by_population", lambda t: sampling.store_order_by_population(surrounded(t)), "SELECT id AS store_id, row_number() OVER (ORDER BY population DESC, id) AS place FROM sur", more=SURR)
q("store_order_by_grid", lambda t: sampling.store_order_by_grid(surrounded(t)), "SELECT id AS store_id, row_number() OVER (ORDER BY r, sc, population DESC, id) AS place FROM snake", more=SURR)
q("non_sentinels", lambda t: sampling.non_sentinels(t.stores, sentinels(t)), "SELECT id AS store_id, network FROM stores WHERE network IN (SELECT network FROM sentinels) AND id NOT IN (SELECT store_id FROM sentinels)", more=PICKS)
q("skippable_clusters", lambda t: sampling.skippable_clusters(clusters(t), sampling.non_sentinels(t.stores, sentinels(t)).select("store_id")))

# --- fuel

FU = f"fp AS (SELECT network_id, fuel, {MEAN} AS avg_price, min(cents) / 1e2 AS min_price, max(cents) / 1e2 AS max_price, count(DISTINCT station_id) AS stations FROM gas_prices GROUP BY ALL)"
q("fuel_prices", lambda t: fu.fuel_prices(t.gas_prices), "SELECT * FROM fp", more=FU)
q("fuel_trends", lambda t: text_dates(fu.fuel_trends(t.gas_prices)), f"SELECT price_date::VARCHAR AS price_date, network_id, fuel, {MEAN} AS avg_price FROM gas_prices GROUP BY 1, 2, 3")
q("fuel_station_latest", lambda t: fu.fuel_station_latest(t.gas_prices), "SELECT station_id, string_agg(fuel || '=' || cents, ';' ORDER BY fuel || '=' || cents) AS prices, max(d)::VARCHAR AS newest FROM (SELECT station_id, fuel, first(cents ORDER BY gas_prices.at DESC, id DESC) AS cents, max(price_date) AS d FROM gas_prices GROUP BY ALL) GROUP BY station_id")
q("fuel_cheapest", lambda t: fu.fuel_cheapest(t.gas_prices), "SELECT fuel, first(network_id ORDER BY avg_price, network_id) AS network_id, min(avg_price) AS avg_price FROM fp GROUP BY fuel", more=FU)
q("fuel_spread", lambda t: fu.fuel_spread(t.gas_prices), f"SELECT fuel, count(*) AS networks, min(avg_price) AS cheapest, max(avg_price) AS dearest, {r('1e2 * (max(avg_price) - min(avg_price)) / min(avg_price)')} AS spread_pct FROM fp GROUP BY fuel", more=FU)
q("fuel_ranking", lambda t: fu.fuel_ranking(t.gas_prices), f"SELECT fuel, network_id, avg_price, rank() OVER (PARTITION BY fuel ORDER BY avg_price) AS rank, {r('max(avg_price) OVER (PARTITION BY fuel) - min(avg_price) OVER (PARTITION BY fuel)')} AS range FROM fp", more=FU)

# --- more of ingest, catalogue and sinks

q("gas_first_price", lambda t: text_dates(ingest.first_price_kept(t.gas_prices.select(F.col("station_id").alias("store_id"), F.col("fuel").alias("product_id"), "cents", "price_date", F.col("at").alias("fetched_at"))).drop("last_checked_at")), "SELECT fuel AS product_id, station_id AS store_id, price_date::VARCHAR AS price_date, first(cents ORDER BY gas_prices.at, cents) AS cents FROM gas_prices GROUP BY fuel, station_id, gas_prices.price_date")
q("prune_history", lambda t: text_dates(ingest.prune_history(t.offers().select("id", "product_id", "store_id", "cents", "price_date", "fetched_at"))), "SELECT id, product_id, store_id, cents, price_date::VARCHAR AS price_date, fetched_at::VARCHAR AS fetched_at FROM offers QUALIFY row_number() OVER (PARTITION BY product_id, store_id ORDER BY id DESC, cents DESC, fetched_at DESC) = 1")
q("popular_products", lambda t: ix.popular_products(ps(t), ingest.active(t.stores)), f"SELECT product_id, count(DISTINCT store_id) AS store_count, count(DISTINCT network) AS network_count, {MEAN} AS avg_price, {r('1e2 * count(DISTINCT store_id) / (SELECT count(*) FROM stores WHERE coalesce(is_active, true))', 1)} AS coverage_pct FROM ps GROUP BY product_id ORDER BY store_count DESC, product_id LIMIT 100")
q("top_level_category", lambda t: ix.top_level_category(t.products, t.categories), "SELECT p.id, coalesce(u.name, c.name) AS top_category FROM products p LEFT JOIN categories c ON c.id = p.categ_id LEFT JOIN categories u ON u.id = c.parent_id AND u.parent_id IS NOT NULL")
q("network_short_names", lambda t: ix.short_names(t.stores, readers.network_lookup(t.networks.select(F.lower("name").alias("id"), F.substring("name", 1, 3).alias("short"), F.array(F.upper("name")).alias("aliases"), (F.col("name") == B2B).alias("b2b")))), f"SELECT id, substr(network, 1, 3) AS short, network = '{B2B}' AS b2b FROM stores")
q("category_items_filter", lambda t: bk.filter_category_items(bk.category_spread(kept(t), t.products), t.products, "red", 3), "SELECT categ_id, product_id, name, networks, ratio FROM (SELECT ac.*, row_number() OVER (PARTITION BY categ_id ORDER BY ratio DESC, product_id) AS rn FROM ac) c JOIN (SELECT id, name FROM products) p ON p.id = product_id WHERE rn <= 200 AND networks >= 3 AND contains(lower(name), 'red') ORDER BY ratio DESC, product_id LIMIT 50", more=ANP)
PROPS = "'{' || concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":' || {v} END" for c, v in (("n_stores", "n_stores"), ("n_networks", "n_networks"), ("basket_min_month", "basket_min_month"), ("basket_max_month", "basket_max_month"), ("basket_n_networks", "basket_n_networks"), ("cheapest_net", "to_json(cheapest_net)"), ("national", "national"))) + ") || '}'"
q("uat_properties", lambda t: readers.properties_json(ustats(t), "uat_id"), f"SELECT uat_id, {PROPS} AS properties FROM us", more=UST)
q("audit_report", lambda t: quality.audit_store_freshness(fresh(t)).select("name", "red").unionByName(drift(t).select("name", "red")), f"SELECT 'store_freshness' AS name, 1e2 * count(*) FILTER (stale) / count(*) > 10 AS red FROM fr UNION ALL SELECT 'flag_drift', coalesce(max(n) FILTER (rn = 1) > median(n) FILTER (rn BETWEEN 2 AND 31) * 3, false) FROM (SELECT started, count(*) AS n, row_number() OVER (ORDER BY started DESC) AS rn FROM runs WHERE status = 'abandoned' GROUP BY started)", more=FR)
q("spread_buckets", lambda t: va.intra_spread_all(ps(t, "list")).groupBy(sc.spread_bucket(F.col("spread_pct")).cast("long").alias("bucket")).agg(F.count("*").alias("groups")), f"SELECT CASE WHEN p < 1 THEN 0 WHEN p < 5 THEN 1 WHEN p < 10 THEN 2 ELSE 3 END::BIGINT AS bucket, count(*) AS groups FROM (SELECT {PCT} AS p FROM ps GROUP BY network, product_id HAVING count(DISTINCT store_id) >= 2) GROUP BY 1", "list")

# --- catalogue documents

q("xml_prices", xq.xml_prices, xq.PRICES_SQL)
q("xml_stores", xq.xml_stores, xq.STORES_SQL)
q("xml_rejects", xq.xml_rejects, xq.REJECTS_SQL)
q("categories_by_source", xq.categories_by_source, xq.CATEGORIES_SQL)
q("products_by_category", xq.products_by_category, xq.PRODUCTS_SQL)

# --- streams

q("stream_changes", sq.stream_changes, sq.CHANGES_SQL, more=sq.SNAP)
q("stream_snapshot", sq.stream_snapshot, sq.SNAPSHOT_SQL, more=sq.SNAP)
q("stream_flags", sq.stream_flags, sq.FLAGS_SQL, more=sq.SNAP)
q("stream_dedup", sq.stream_dedup, sq.DEDUP_SQL, more=sq.SNAP)
q("stream_window_avg", sq.stream_window_avg, sq.WINDOWS_SQL, more=sq.WINDOWS)
