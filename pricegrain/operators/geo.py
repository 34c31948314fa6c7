"""Radius joins, point dedup, clusters and map statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrain.functions.scalars import half_up, haversine_km
from pricegrain.storage import checkpoint

#: Kilometres of a degree of latitude, a little less than the shortest, so that cells are never too small; and of any degree at most.
DEGREE_KM, MOST_DEGREE_KM = 110.0, 111.3
EARTH_KM = 6371.0
#: Points of a cell that are compared one by one, and how often a fuller cell is cut into four.
LEAF_POINTS, MOST_CUTS = 64, 12


def near_pairs(a: DataFrame, b: DataFrame, radius_km: float) -> DataFrame:
    """All (a_id, b_id, km) within the radius: equal grid cells after spreading ``b`` to the neighbours, then the distance.

    Cells are one radius high; their width follows the row's latitude, so that a circle spans three at most.
    """
    step = radius_km / DEGREE_KM

    def cells(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("id").alias(f"{name}_id"), F.col("lat").alias(f"{name}_lat"), F.col("lon").alias(f"{name}_lon"), F.floor(F.col("lat") / step).alias("row"))

    wide = lambda row: F.lit(step) / F.greatest(F.lit(0.01), F.cos(F.radians(F.least(F.lit(89.0), F.greatest(F.abs(row), F.abs(row + 1)) * step + step))))  # noqa: E731  width of a cell in a row, at the latitude where it is widest
    left = cells(a, "a").withColumn("col", F.floor(F.col("a_lon") / wide(F.col("row"))))
    right = cells(b, "b").withColumn("row", F.explode(F.array(F.col("row") - 1, F.col("row"), F.col("row") + 1)))
    right = right.withColumn("col", F.floor(F.col("b_lon") / wide(F.col("row")))).withColumn("col", F.explode(F.array(F.col("col") - 1, F.col("col"), F.col("col") + 1)))
    km = haversine_km(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    return left.join(right, ["row", "col"]).withColumn("km", km).filter(F.col("km") <= radius_km).select("a_id", "b_id", "km")


def half_width(lat: Column, radius_km: float) -> Column:
    """Degrees of longitude that a circle spans to either side; all of them where it holds a pole."""
    s = F.sin(F.lit(radius_km / EARTH_KM)) / F.cos(F.radians(lat))
    return F.when(s < 1, F.degrees(F.asin(s))).otherwise(F.lit(360.0))


def circle_cells(points: DataFrame, radius_km: float, step: float) -> DataFrame:
    """Points with row and col of every cell of ``step`` degrees that the circle around them can touch, the antimeridian aside."""
    margin = 1e-9
    high = F.lit(radius_km / EARTH_KM * 180 / 3.141592653589793 + margin)
    wide = half_width(F.col("lat"), radius_km) + margin
    cell = lambda x: F.floor(x / step)
    rows = points.withColumn("wide", wide).withColumn("row", F.explode(F.sequence(cell(F.col("lat") - high), cell(F.col("lat") + high))))
    return rows.withColumn("col", F.explode(F.sequence(cell(F.greatest(F.lit(-180.0), F.col("lon") - F.col("wide"))), cell(F.least(F.lit(180.0), F.col("lon") + F.col("wide")))))).drop("wide")


def circle_sums(centres: DataFrame, points: DataFrame, radius_km: float) -> DataFrame:
    """lat, lon, total: the sum of ``value`` of the points within the radius of each centre that has any.

    ``centres`` has distinct (lat, lon), ``points`` distinct (lat, lon) and value. Cells as wide as the radius are cut into
    four as long as one holds more than LEAF_POINTS points. A cell that lies wholly inside a circle gives its sum, one
    outside nothing; only cells at the edge are cut further, and only the last have their points compared. So
    what is joined grows with the circles' edges, not with the points inside.
    """
    points = checkpoint(points.select("lat", "lon", "value"), "points")
    steps = [radius_km / DEGREE_KM]
    grid = lambda step: points.groupBy(F.floor(F.col("lat") / step).alias("row"), F.floor(F.col("lon") / step).alias("col")).agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("n"))
    levels = [grid(steps[0])]
    while len(steps) <= MOST_CUTS and (levels[-1].agg(F.max("n")).first()[0] or 0) > LEAF_POINTS:
        steps.append(steps[-1] / 2)
        levels.append(checkpoint(grid(steps[-1]), "cells"))
    open_, parts = circle_cells(centres.select("lat", "lon"), radius_km, steps[0]), []
    for k, (step, cells) in enumerate(zip(steps, levels, strict=True)):
        corner = lambda i, j, step=step: haversine_km(F.col("lat"), F.col("lon"), (F.col("row") + i) * step, (F.col("col") + j) * step)
        inside = F.greatest(corner(0, 0), corner(0, 1), corner(1, 0), corner(1, 1)) < radius_km - 1e-6
        met = open_.join(cells, ["row", "col"]).withColumn("inside", inside)
        met = checkpoint(met, "met") if k + 1 < len(steps) else met
        parts.append(met.filter("inside").select("lat", "lon", "value"))
        last = F.lit(k + 1 == len(steps))
        leaf = met.filter(~F.col("inside") & (last | (F.col("n") <= LEAF_POINTS))).select("lat", "lon", "row", "col")
        held = points.select(F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), "value", F.floor(F.col("lat") / step).alias("row"), F.floor(F.col("lon") / step).alias("col"))
        near = leaf.join(held, ["row", "col"]).filter(haversine_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon")) <= radius_km)
        parts.append(near.select("lat", "lon", "value"))
        quarters = F.array(*[F.struct((2 * F.col("row") + i).alias("row"), (2 * F.col("col") + j).alias("col")) for i in (0, 1) for j in (0, 1)])
        open_ = met.filter(~F.col("inside") & ~last & (F.col("n") > LEAF_POINTS)).select("lat", "lon", F.explode(quarters).alias("q")).select("lat", "lon", "q.row", "q.col")
    return reduce(DataFrame.unionByName, parts).groupBy("lat", "lon").agg(F.sum("value").alias("total"))


def surrounding_population(stores: DataFrame, localities: DataFrame, radius_km: float = 10) -> DataFrame:
    """Population of the localities within the radius of each store, 0 where there is none or the store has no coordinates.

    Stores and localities of equal coordinates count as one point, with the population of all.
    """
    places = stores.filter("lat is not null and lon is not null").select("lat", "lon").distinct()
    people = localities.filter("lat is not null and lon is not null").groupBy("lat", "lon").agg(F.sum("population").alias("value"))
    g = circle_sums(places, people, radius_km)
    return stores.select("id", "lat", "lon").join(g, ["lat", "lon"], "left").select(F.col("id").alias("store_id"), F.coalesce("total", F.lit(0)).cast("long").alias("surrounding_population"))


def sampling_points(boxes: DataFrame, min_population: int = 10_000, spacing_km: float = 8, max_diagonal_km: float = 10) -> DataFrame:
    """The centre of a small box, a grid of points over a large one; boxes of few people are skipped.

    ``boxes`` has label, population, south, north, west, east.
    """
    b = boxes.filter(F.col("population") >= min_population).withColumns({"mid_lat": (F.col("south") + F.col("north")) / 2, "mid_lon": (F.col("west") + F.col("east")) / 2, "km": haversine_km(F.col("south"), F.col("west"), F.col("north"), F.col("east"))})
    small = F.col("km") <= max_diagonal_km
    step_lat = F.lit(spacing_km / 111.0)
    step_lon = F.lit(spacing_km) / (F.lit(111.0) * F.cos(F.radians("mid_lat")))
    n = lambda a, z, step: F.sequence(F.lit(0), F.floor((F.col(z) - F.col(a)) / step + 0.5).cast("int"))
    g = b.withColumn("i", F.explode(F.when(small, F.array(F.lit(0))).otherwise(n("south", "north", step_lat)))).withColumn("j", F.explode(F.when(small, F.array(F.lit(0))).otherwise(n("west", "east", step_lon))))
    return g.select("label", F.when(small, F.col("mid_lat")).otherwise(F.col("south") + F.col("i") * step_lat).alias("lat"), F.when(small, F.col("mid_lon")).otherwise(F.col("west") + F.col("j") * step_lon).alias("lon"))


def dedup_points(points: DataFrame, radius_km: float = 4) -> DataFrame:
    """Greedy dedup in order of population: a point stays unless one that stays is nearer than the radius.

    ``points`` has id, lat, lon, population; those without coordinates are left out. Of equal coordinates only the first can
    stay. The grid's cells are so small that all points of one are nearer than the radius, so only the first open point of a
    cell can stay next; in each round those stay that no open point before them is near to, and what is near to them
    goes. The fixpoint equals the greedy result; each round settles at least the first open point. Pairs of a round are
    points by the cells around them, of which there are a bounded number, however dense a place is.
    """
    step = radius_km / 1.5 / MOST_DEGREE_KM
    rank = F.struct((-F.coalesce("population", F.lit(0))).alias("p"), F.col("id").alias("id"))
    known = points.filter("lat is not null and lon is not null")
    first = known.groupBy("lat", "lon").agg(F.min(rank).alias("rank"))
    open_ = checkpoint(first.select("lat", "lon", "rank", F.floor(F.col("lat") / step).alias("row"), F.floor(F.col("lon") / step).alias("col")), "open")

    def around(some: DataFrame) -> DataFrame:
        spread = circle_cells(some.select("lat", "lon", "rank"), radius_km, step).withColumnsRenamed({"lat": "s_lat", "lon": "s_lon", "rank": "s_rank"})
        return spread.join(open_, ["row", "col"]).filter(haversine_km(F.col("s_lat"), F.col("s_lon"), F.col("lat"), F.col("lon")) < radius_km)

    stay = []
    while open_.head(1):
        top = checkpoint(open_.groupBy("row", "col").agg(F.min_by(F.struct("lat", "lon", "rank"), "rank").alias("t")).select("t.*"), "tops")
        held_back = around(top).filter("rank < s_rank").select(F.col("s_rank").alias("rank")).distinct()
        now = checkpoint(top.join(held_back, "rank", "left_anti").select("lat", "lon", "rank"), "stay")
        stay.append(now)
        open_ = checkpoint(open_.join(around(now).select("rank").distinct(), "rank", "left_anti").select(open_.columns), "open")
    if not stay:
        return points.limit(0).select("id", "lat", "lon")
    return reduce(DataFrame.unionByName, stay).select(F.col("rank.id").alias("id"), "lat", "lon")


def greedy_cover(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """grp, anchor_id, member_id: greedy set cover of each group by points that stand for ``w`` stores.

    ``nodes`` has grp, id, w; ``pairs`` all (grp, a_id, b_id) of neighbours in a group. Greedily the point that
    covers most uncovered stores, the least id on ties, becomes an anchor; its cover lists itself and all
    neighbours, those covered before too. Each round picks at once every open point that comes before all
    others at most two steps away, which no other pick can change: the greedy order's own picks.
    """
    open_, picked = nodes.select("grp", "id", "w"), []
    while not picked or open_.head(1):
        near = pairs.join(open_.select("grp", F.col("id").alias("a_id"), F.col("w").alias("a_w")), ["grp", "a_id"]).join(open_.select("grp", F.col("id").alias("b_id"), F.col("w").alias("b_w")), ["grp", "b_id"])
        reach = near.groupBy("grp", F.col("a_id").alias("id")).agg(F.sum("b_w").alias("more"))
        # stores at the point itself count as well, so that points of different weight compare as stores do
        score = checkpoint(open_.join(reach, ["grp", "id"], "left").select("grp", "id", F.struct((F.col("w") - 1 + F.coalesce("more", F.lit(0))).alias("n"), (-F.col("id")).alias("first")).alias("score")))
        best = score
        for _ in range(2):
            around = near.select("grp", "a_id", "b_id").join(best.select("grp", F.col("id").alias("b_id"), "score"), ["grp", "b_id"]).groupBy("grp", F.col("a_id").alias("id")).agg(F.max("score").alias("other"))
            best = best.join(around, ["grp", "id"], "left").select("grp", "id", F.greatest("score", F.coalesce("other", "score")).alias("score"))
        now = checkpoint(score.join(best.withColumnRenamed("score", "top"), ["grp", "id"]).filter("score = top").select("grp", "id"))
        gone = now.unionByName(pairs.join(now.withColumnRenamed("id", "a_id"), ["grp", "a_id"]).select("grp", F.col("b_id").alias("id"))).distinct()
        picked.append(now)
        open_ = checkpoint(open_.join(gone, ["grp", "id"], "left_anti"))
    anchors = reduce(DataFrame.unionByName, picked)
    covers = pairs.join(anchors.withColumnRenamed("id", "a_id"), ["grp", "a_id"]).select("grp", F.col("a_id").alias("anchor_id"), F.col("b_id").alias("member_id"))
    return covers.unionByName(anchors.select("grp", F.col("id").alias("anchor_id"), F.col("id").alias("member_id")))


def store_clusters(stores: DataFrame, radius_m: int = 5000, min_radius_m: int = 1250, max_per_cluster: int = 50) -> DataFrame:
    """anchor_id, store_id, radius_m: clusters around anchors that together cover all stores.

    A greedy set cover at ``radius_m``; each cluster of more than ``max_per_cluster`` stores is covered anew,
    among its own stores, at half the radius, as long as that is no less than ``min_radius_m``. A store can be in several
    clusters. Stores of equal coordinates are handled as one point, the least id, so dense places make no pairs among themselves.
    """
    points = checkpoint(stores.groupBy("lat", "lon").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("w")))
    near = checkpoint(near_pairs(points, points, radius_m / 1000).filter("a_id <> b_id"))
    nodes = points.select(F.lit(-1).cast("long").alias("grp"), "id", "w")
    done = None
    while True:
        inside = near.filter(F.col("km") * 1000 <= radius_m)
        pairs = inside.join(nodes.select("grp", F.col("id").alias("a_id")), "a_id").join(nodes.select(F.col("grp").alias("g"), F.col("id").alias("b_id")), "b_id").filter("grp = g").select("grp", "a_id", "b_id")
        covers = checkpoint(greedy_cover(nodes, checkpoint(pairs)).join(points.select(F.col("id").alias("member_id"), "w"), "member_id"))
        size = covers.groupBy("grp", "anchor_id").agg((F.sum("w") > max_per_cluster).alias("large"))
        split = radius_m // 2 >= min_radius_m
        judged = covers.join(size, ["grp", "anchor_id"]).withColumn("large", F.col("large") & F.lit(split))
        part = judged.filter(~F.col("large")).select("anchor_id", "member_id", F.lit(radius_m).cast("long").alias("radius_m"))
        done = part if done is None else done.unionByName(part)
        nodes = checkpoint(judged.filter("large").select(F.xxhash64("grp", "anchor_id").alias("grp"), F.col("member_id").alias("id"), "w"))
        if not nodes.head(1):
            break
        radius_m //= 2
    at = stores.select(F.col("id").alias("store_id"), "lat", "lon").join(points.select("lat", "lon", F.col("id").alias("member_id")), ["lat", "lon"])
    return done.distinct().join(at, "member_id").select("anchor_id", "store_id", "radius_m")


def nearby_stores(stores: DataFrame, lat: float, lon: float, radius_km: float = 5, network: str | None = None, limit: int = 200) -> DataFrame:
    """Stores around a point: a box first, then the distance."""
    step = radius_km / DEGREE_KM
    s = stores.filter(F.col("lat").between(lat - step, lat + step))
    s = s.filter(F.col("network") == network) if network else s
    return s.withColumn("dist_m", F.floor(haversine_km(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon")) * 1000.0 + 0.5)).filter(F.col("dist_m") <= radius_km * 1000).orderBy("dist_m", "id").limit(limit).select("id", "network", "dist_m")


def stores_index(stores: DataFrame, scored: DataFrame, national: DataFrame, basket: str) -> DataFrame:
    """Every store with the cheapest comparable basket of its place, else of the country."""
    own = scored.filter(F.col("comparable") & (F.col("basket_id") == basket)).groupBy("uat_id").agg(F.min("cost_month").alias("own"))
    all_ = national.filter(F.col("comparable") & (F.col("basket_id") == basket)).agg(F.min("cost_month").alias("all"))
    return stores.join(own, "uat_id", "left").join(all_, F.lit(True)).select("id", "name", "network", "uat_id", F.coalesce("own", "all").alias("basket_min_month"))


def uat_stats(stores: DataFrame, scored: DataFrame, basket: str, exclude: tuple = (), national: DataFrame | None = None) -> DataFrame:
    """Stores, networks and basket costs of each place; with ``national`` scores, these where a place has no comparable basket, and a mark of it."""

    def costs(of: DataFrame, *keys: str) -> DataFrame:
        comparable = of.filter(F.col("comparable") & (F.col("basket_id") == basket))
        return comparable.groupBy(*keys).agg(F.min(F.struct("cost_month", "network")).alias("m"), F.max("cost_month").alias("most"), F.count(F.lit(1)).alias("k"))

    a = stores.filter("uat_id is not null").groupBy("uat_id").agg(F.count("*").alias("n_stores"), F.countDistinct(F.when(~F.col("network").isin(*exclude), F.col("network"))).alias("n_networks"))
    b = a.join(costs(scored, "uat_id"), "uat_id", "left")
    if national is None:
        return b.select("uat_id", "n_stores", "n_networks", F.col("m.cost_month").alias("basket_min_month"), F.col("most").alias("basket_max_month"), F.col("m.network").alias("cheapest_net"))
    n = costs(national).select(F.col("m").alias("n_m"), F.col("most").alias("n_most"), F.col("k").alias("n_k"))  # one row
    both = b.join(F.broadcast(n), F.lit(True))
    own = F.col("k").isNotNull()
    pick = lambda x: F.when(own, F.col(x)).otherwise(F.col(f"n_{x}"))
    return both.select("uat_id", "n_stores", "n_networks", pick("m")["cost_month"].alias("basket_min_month"), pick("most").alias("basket_max_month"), F.coalesce(pick("k"), F.lit(0)).alias("basket_n_networks"), pick("m")["network"].alias("cheapest_net"), (~own).alias("national"))


def uat_kpis(stats: DataFrame) -> DataFrame:
    return stats.agg(F.count_if(F.col("n_networks") >= 1).alias("covered"), F.count_if(F.col("n_networks") == 1).alias("deserts"), F.min_by("uat_id", F.struct("basket_min_month", "uat_id")).alias("cheapest_uat"))


def uat_bins(stats: DataFrame, value: str, cuts: list[float]) -> DataFrame:
    """Class of each place by the number of cuts its value reaches."""
    at = F.lit(0)
    for c in cuts:
        at = at + F.when(F.col(value) >= c, 1).otherwise(0)
    return stats.select("uat_id", value, at.cast("long").alias("bin"))


def stores_for_map(stores: DataFrame) -> DataFrame:
    """Stores with coordinates on the globe, network or ''."""
    return stores.filter(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)).select("id", "name", F.coalesce("network", F.lit("")).alias("network"), half_up(F.col("lat"), 3).alias("lat"), half_up(F.col("lon"), 3).alias("lon"))
