"""Change history and snapshot maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.storage import free_name

KEY = ["product_id", "store_id"]
#: Ordered rules, a LIKE pattern of a store's name in capitals and the network id it tells.
NAME_RULES = [
    ("%KAUFLAND%", "KAUFLAND"), ("%PROFI%", "PROFI"), ("%SELGROS%", "SELGROS"), ("%SEGLROS%", "SELGROS"), ("%CORA%", "5948914999995"), ("%AUCHAN%", "AUCHAN"),
    ("%SUPECO%", "SUPECO"), ("%CARREFOUR%", "5940475006709"), ("%MEGA IMAGE%", "5940475870003"), ("MI %", "5940475870003"), ("SG %", "5940475870003"), ("EXPRESS %", "5940475006709"),
]


def latest_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in the given order."""
    n = free_name(df, "n")
    return df.withColumn(n, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(n) == 1).drop(n)


#: What tells the age of observations of one key, and what decides between equal times.
AGE = ["fetched_at", "cents", "promo"]


def compare(obs: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Each observation with the price before it on its key (was) and whether (price, promo) moved; the first of a key is compared with the snapshot.

    The batch alone is sorted and shuffled by key; a snapshot that is bucketed by key is joined where it lies.
    Nulls compare as equal to nulls. Other columns of ``obs`` are left out, price_date is kept if there is one.
    """
    cols = [*KEY, "cents", "promo", *(["price_date"] if "price_date" in obs.columns else []), "fetched_at"]
    w = Window.partitionBy(*KEY).orderBy(*AGE)
    rows = obs.select(*cols).withColumns({"place": F.row_number().over(w), "last_cents": F.lag("cents").over(w), "last_promo": F.lag("promo").over(w)})
    first = F.col("place") == 1
    if current is None:
        known, was, was_promo = ~first, F.col("last_cents"), F.col("last_promo")
    else:
        rows = rows.join(current.select(*KEY, F.col("cents").alias("old_cents"), F.col("promo").alias("old_promo"), F.lit(True).alias("held")), KEY, "left")
        known, was, was_promo = ~first | F.col("held").isNotNull(), F.when(first, F.col("old_cents")).otherwise(F.col("last_cents")), F.when(first, F.col("old_promo")).otherwise(F.col("last_promo"))
    same = known & F.col("cents").eqNullSafe(was) & F.col("promo").eqNullSafe(was_promo)
    return rows.select(*cols, was.alias("was"), known.alias("known"), (~same).alias("moved"))


def history_of(steps: DataFrame) -> DataFrame:
    """Of compared observations those that moved; change_type is ``new`` or ``changed``."""
    return steps.filter("moved").select(*[c for c in steps.columns if c not in ("known", "moved")], F.when(F.col("known"), "changed").otherwise("new").alias("change_type"))


def merged(steps: DataFrame, current: DataFrame) -> DataFrame:
    """The snapshot after compared observations of one batch: values and time of the last move, and the last check.

    An unchanged price keeps its date and moves the time of the check alone. Keys without an observation stay as they are.
    """
    age = F.struct(*AGE)
    new = steps.groupBy(*KEY).agg(F.max("fetched_at").alias("checked"), F.max_by(F.struct("cents", "promo", "price_date", "fetched_at"), F.when(F.col("moved"), age)).alias("n"))
    old = current.select(*KEY, *[F.col(c).alias(f"old_{c}") for c in ("cents", "promo", "price_date", "last_checked_at", "last_changed_at")])
    both = old.join(new, KEY, "full")
    value = lambda c: F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"old_{c}")).alias(c)
    return both.select(*KEY, value("cents"), value("promo"), value("price_date"), F.greatest("checked", "old_last_checked_at").alias("last_checked_at"), F.coalesce("n.fetched_at", "old_last_changed_at").alias("last_changed_at"))


def ingest_changes(obs: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """History rows: observations whose (price, promo) differ from the one before on the same key.

    ``current`` holds the snapshot that the first observation of a key is compared with, one row a key. change_type is
    ``new`` or ``changed``. Nulls compare as equal to nulls.
    """
    return history_of(compare(obs, current)).select(*KEY, "cents", "promo", "fetched_at", "change_type")


def values_last(df: DataFrame, keys: list[str]) -> list[Column]:
    """All other columns in order of name, to tell rows apart that tie in everything else."""
    return [F.col(c) for c in sorted(df.columns) if c not in keys]


def snapshot_latest(prices: DataFrame, row_id: str | None = None) -> DataFrame:
    """Newest row per product and store; of equal times that of the greatest id, or of the greatest values where there is no id."""
    rest = [c.desc() for c in values_last(prices, [*KEY, "price_date", "fetched_at"])]
    return latest_by(prices, KEY, F.desc("price_date"), F.desc("fetched_at"), *([F.desc(row_id)] if row_id else []), *rest)


def snapshot_after(obs: DataFrame, current: DataFrame) -> DataFrame:
    """The snapshot after a batch: newest values, the check time, and the time of the last change."""
    last = latest_by(obs, KEY, F.desc("fetched_at"), *[c.desc() for c in values_last(obs, [*KEY, "fetched_at"])])
    changed = ingest_changes(obs, current).groupBy(*KEY).agg(F.max("fetched_at").alias("changed"))
    old = current.select(*KEY, F.col("cents").alias("o_cents"), F.col("promo").alias("o_promo"), F.col("last_checked_at").alias("o_checked"), F.col("last_changed_at").alias("o_changed"))
    new = last.select(*KEY, "cents", "promo", F.col("fetched_at").alias("checked"), F.lit(True).alias("seen"))
    both = old.join(new, KEY, "full").join(changed, KEY, "left")
    pick = lambda a, b: F.when(F.col("seen"), F.col(a)).otherwise(F.col(b))
    return both.select(*KEY, pick("cents", "o_cents").alias("cents"), pick("promo", "o_promo").alias("promo"), F.coalesce("checked", "o_checked").alias("last_checked_at"), F.coalesce("changed", "o_changed").alias("last_changed_at"))


def first_price_kept(prices: DataFrame) -> DataFrame:
    """One row per product, store and date: the first price, the last check."""
    return prices.groupBy(*KEY, "price_date").agg(F.min_by("cents", F.struct("fetched_at", "cents")).alias("cents"), F.max("fetched_at").alias("last_checked_at"))


def keys_with_changes(prices: DataFrame) -> DataFrame:
    """How many keys have more than one price."""
    return prices.groupBy(*KEY).agg(F.min("cents").alias("a"), F.max("cents").alias("b")).agg(F.count_if(F.col("a") != F.col("b")).alias("keys"))


def store_upsert(stores: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stores after a batch: new values win, but a null never replaces a known one; seen stores are active."""
    cols = [c for c in stores.columns if c not in ("id", "is_active")]
    seen, names = free_name(stores, "seen"), {c: free_name(stores, f"new_{c}") for c in cols}
    new = incoming.select("id", *[F.col(c).alias(n) for c, n in names.items()], F.lit(True).alias(seen))
    active = F.coalesce(F.col(seen), F.col("is_active"), F.lit(True)) if "is_active" in stores.columns else F.lit(True)
    return stores.join(new, "id", "full").select("id", *[F.coalesce(n, c).alias(c) for c, n in names.items()], active.alias("is_active"))


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of several rows of a key that of the greatest values, so that reruns agree."""
    rest = values_last(df, keys)
    return df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("row")).select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns]) if rest else df.distinct()


def latest_wins(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Insert or replace."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(one_per_key(new, [key]))


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert what is not there yet."""
    return old.unionByName(one_per_key(new, keys).join(old.select(*keys), keys, "left_anti"))


def propagate_checked(current: DataFrame, store_ids: DataFrame, fetched_at) -> DataFrame:
    """Carry a check time to all rows of the given stores."""
    hit = free_name(current, "hit")
    marked = store_ids.select(F.col("store_id"), F.lit(True).alias(hit)).distinct()
    return current.join(marked, "store_id", "left").withColumn("last_checked_at", F.when(F.col(hit), F.lit(fetched_at)).otherwise(F.col("last_checked_at"))).drop(hit)


def propagate_prices(current: DataFrame, pairs: DataFrame) -> DataFrame:
    """Prices of representative stores for other stores; change says whether (price, promo) move.

    ``pairs`` has source_id and store_id. A null promo against a value counts as unchanged, as the price model has it.
    """
    source = current.select(F.col("store_id").alias("source_id"), "product_id", "cents", "promo", "price_date")
    imputed = source.join(pairs.select("source_id", "store_id").distinct(), "source_id").drop("source_id")
    old = current.select(*KEY, F.col("cents").alias("old_cents"), F.col("promo").alias("old_promo"))
    moved = (F.col("cents") != F.col("old_cents")) | F.coalesce(F.col("promo") != F.col("old_promo"), F.lit(False))
    return imputed.join(old, KEY, "left").select(*KEY, "cents", "promo", "price_date", F.when(F.col("old_cents").isNull(), "new").when(moved, "changed").otherwise("same").alias("change"))


def imputed_history(history: DataFrame, imputed: DataFrame, fetched_at) -> DataFrame:
    """History with the imputed rows whose product, store and date it lacks."""
    new = imputed.select(*KEY, "cents", "promo", "price_date", F.lit(fetched_at).alias("fetched_at"))
    return insert_absent(history.select(new.columns), new, [*KEY, "price_date"])


def imputed_snapshot(current: DataFrame, imputed: DataFrame, fetched_at) -> DataFrame:
    """The snapshot after imputation: new values and check times; the time of change moves only with price or promo."""
    new = imputed.select(*KEY, *[F.col(c).alias(f"n_{c}") for c in ("cents", "promo", "price_date")], "change")
    both = current.select(*KEY, "cents", "promo", "price_date", "last_checked_at", "last_changed_at").join(new, KEY, "full")
    hit, at = F.col("change").isNotNull(), F.lit(fetched_at)
    values = [F.when(hit, F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in ("cents", "promo", "price_date")]
    return both.select(*KEY, *values, F.when(hit, at).otherwise(F.col("last_checked_at")).alias("last_checked_at"), F.when(hit & (F.col("change") != "same"), at).otherwise(F.col("last_changed_at")).alias("last_changed_at"))


def representatives(stores: DataFrame) -> DataFrame:
    """source_id, store_id: the least store of each network, and each other store of it."""
    first = stores.groupBy("network").agg(F.min("id").alias("source_id"))
    return stores.join(first, "network").filter("id <> source_id").select("source_id", F.col("id").alias("store_id"))


def network_by_name(stores: DataFrame, rules=NAME_RULES) -> DataFrame:
    """Fill missing networks by the first rule that the name fits."""
    name, rule = F.upper("name"), F.lit(None).cast("string")
    for pattern, network in reversed(rules):
        rule = F.when(name.like(pattern), network).otherwise(rule)
    return stores.withColumn("inferred", F.col("network").isNull() & rule.isNotNull()).withColumn("network", F.coalesce("network", rule))


def network_by_logo(stores: DataFrame, networks: DataFrame) -> DataFrame:
    """Fill missing networks by equal logo; the smallest network id on ties."""
    logos = networks.filter("logo_url is not null").groupBy("logo_url").agg(F.min("id").alias("logo_network"))
    return stores.join(logos, "logo_url", "left").withColumn("inferred", F.col("network_id").isNull() & F.col("logo_network").isNotNull()).withColumn("network_id", F.coalesce("network_id", "logo_network")).drop("logo_network")


def network_conflicts(stores: DataFrame, networks: DataFrame) -> DataFrame:
    """Stores whose logo belongs to another network."""
    n = networks.select(F.col("id").alias("logo_network_id"), F.col("name").alias("logo_network_name"), "logo_url")
    return stores.join(n, "logo_url").filter(F.col("network_id") != F.col("logo_network_id")).select(F.col("id").alias("store_id"), F.col("name").alias("store_name"), F.col("network_id").alias("db_network_id"), "logo_network_id", "logo_network_name")


def newest_check(current: DataFrame) -> DataFrame:
    return current.groupBy("store_id").agg(F.max("fetched_at").alias("newest"))


def last_changes(prices: DataFrame) -> DataFrame:
    """product_id, store_id, last_changed_at: when price or promo last moved."""
    return ingest_changes(prices).groupBy(*KEY).agg(F.max("fetched_at").alias("last_changed_at"))


def active(stores: DataFrame) -> DataFrame:
    """Stores that are not marked inactive."""
    return stores.filter(F.coalesce("is_active", F.lit(True)))


def deactivate_stale(stores: DataFrame, current: DataFrame, as_of, days: int = 21) -> DataFrame:
    """is_active turns false where the newest check is older than ``days``."""
    s = stores.join(newest_check(current).withColumnRenamed("store_id", "id"), "id", "left")
    return s.select("id", F.coalesce(F.col("newest") >= F.date_sub(F.lit(as_of).cast("date"), days), F.lit(True)).alias("is_active"))


def store_tiers(stores: DataFrame, changes: DataFrame, as_of, days: int = 7) -> DataFrame:
    """store_id, tier of active stores: daily where a price moved within ``days``, weekly where none did, null where none ever was.

    ``changes`` has store_id and last_changed_at.
    """
    newest = changes.groupBy(F.col("store_id").alias("id")).agg(F.max("last_changed_at").alias("newest"))
    tier = F.when(F.col("newest") >= F.date_sub(F.lit(as_of).cast("date"), days), "daily").when(F.col("newest").isNotNull(), "weekly")
    return active(stores).join(newest, "id", "left").select(F.col("id").alias("store_id"), tier.alias("tier"))


def prune_history(prices: DataFrame, row_id: str = "id") -> DataFrame:
    """One row per product and store, that of the greatest id, and of the greatest values if ids repeat."""
    return prices.groupBy(*KEY).agg(F.max_by(F.struct(*prices.columns), F.struct(row_id, *values_last(prices, [*KEY, row_id]))).alias("row")).select("row.*")


def backfill_changed(current: DataFrame) -> DataFrame:
    """Rows without a time of change take that of the check."""
    return current.withColumn("last_changed_at", F.coalesce("last_changed_at", "last_checked_at"))


def backfill_active(stores: DataFrame) -> DataFrame:
    """Stores without a mark count as active."""
    return stores.withColumn("is_active", F.coalesce("is_active", F.lit(True)))
