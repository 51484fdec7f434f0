"""Merging overlapping footprints.

Only connectivity decides the groups, so the links need not be all overlapping pairs.  Copies of one geometry are
tied to a single representative first.  Then each rectangle is cut into the cells of a grid of its size: one that fills a
cell is linked with everything that has area in there, which takes links in proportion to the shapes, however many lie on each other.
Only cells whose members are not one component by then are searched for pairs, and only pairs of two components are tested.
Of these cells the crowded ones are settled by a shape that covers a (sub-)cell; sub-cells no shape covers are divided further, and
only while they still hold more than one component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import BBOX, area as geometry_area
from ..functions.kernels import AREA_EPS, clip_area, overlap_area
from ..session import cut
from .components import connected_components, contracted
from .preprocessing import require_columns, subset
from .skew import broadcast_if_small, salted_by, salted_pair, shuffled
from .spatial_join import (
    CELL,
    FILL,
    HOT_CELL,
    MOST_STRETCHED,
    _SHAPE,
    cell_side,
    fill_cells,
    fills_in_use,
    touched_cells,
    _equi,
    _from_own_up,
    bbox_meets,
    cell_rows,
    levels_in_use,
    slim_shape,
    with_level,
)

CROWDED_CELL = 256
HOT_GROUP = 1_000_000
MAX_DIVISIONS = 12
_DIVIDE = 4
BLOCK = 5  # blocks of 2**5 cells a side are dealt to tasks
_SUB_CELL = ["x0", "y0", "side"]


def _copies(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per distinct geometry, and ``id, rep`` links of the copies to it.

    The hash comes first among the keys: rows are told apart by it before any geometry is compared.
    """
    hashed = df.withColumn("h", F.xxhash64(*BBOX, "geom"))
    keys = ["h", *BBOX, "is_box", "geom"]
    reps = cut(hashed.groupBy(*keys).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")))
    repeated = reps.where(F.col("n") > 1)
    # A copy overlaps its representative by its own area, so copies of flat shapes are not tied, like any two flat shapes.
    solid = geometry_area(F.col("geom")) if "geom" in reps.columns else None
    box = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    repeated = repeated.where(F.when(F.col("is_box"), box).otherwise(solid) > AREA_EPS)
    plain = reps.withColumnRenamed("rep", "id").drop("n", "h")
    n_large, n_repeated = repeated.agg(F.sum((F.col("n") > HOT_GROUP).cast("int")), F.count(F.lit(1))).first()
    if n_repeated == 0:
        return plain, df.limit(0).select("id", F.col("id").alias("rep"))
    left, right, on = hashed, repeated, ["h"]
    if n_large:
        salts = F.max(F.ceil(F.col("n") / HOT_GROUP).cast("int")).alias("sl")
        hot = repeated.where(F.col("n") > HOT_GROUP).groupBy("h").agg(salts).withColumn("sr", F.lit(1))
        left, right, on = salted_by(hashed, repeated, ["h"], "id", "rep", broadcast_if_small(hot, n_large))
    left, right = left.alias("l"), right.alias("r")
    # Rectangles come without a geometry: NULL equals NULL here, their bboxes are compared anyway.
    same = _equi([*on, *BBOX, "is_box"]) & F.col("l.geom").eqNullSafe(F.col("r.geom"))
    links = left.join(shuffled(right), same & (F.col("l.id") != F.col("r.rep")))
    return plain, links.select("l.id", "r.rep")


def _linked(pairs: DataFrame, name: str = "id") -> DataFrame:
    return pairs.where(overlap_area("l", "r") > AREA_EPS).select(
        F.col(f"l.{name}").alias("id_a"), F.col(f"r.{name}").alias("id_b")
    )


def overlap_links(df: DataFrame, crowded: int = CROWDED_CELL) -> DataFrame:
    """``id_a, id_b`` links with the same connected components as all overlapping pairs."""
    base = df.select("id", *slim_shape()).where(F.col("xmin").isNotNull())
    reps, copy_links = _copies(base)
    shapes = with_level(reps).join(shuffled(connected_components(_fill_links(reps))), "id", "left")
    shapes = cut(shapes.withColumn("component", F.coalesce("component", "id")))
    (levels,) = levels_in_use(shapes)
    members = cell_rows(shapes, _from_own_up(levels))
    own = F.col("level") == F.col("own_level")
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    loose = ~(F.col("is_box") & (F.least(w, h) * MOST_STRETCHED >= F.greatest(w, h)))  # no cells were laid into these
    sizes = members.groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("n"), F.sum(own.cast("int")).alias("n_own"), F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.sum(loose.cast("int")).alias("n_loose"),
    )
    # A cell whose members are one component already has nothing to add.
    cells = cut(sizes.where((F.col("n_own") > 0) & (F.col("lo") != F.col("hi"))).select(*CELL, "n", "n_own", "n_loose"))
    # Rectangles that lie on each other are one component by now; what else is crowded has to be divided.
    full = (F.col("n_own") * F.col("n") > crowded * crowded) & (F.col("n_loose") * F.col("n") > crowded * crowded)
    n_cells, n_full = cells.agg(F.count(F.lit(1)), F.sum(full.cast("int"))).first()
    stars = shapes.select("id", "component")
    if n_cells:
        calm_cells = broadcast_if_small(cells.where(~full).select(*CELL), n_cells)
        links = cut(_sparse_links(members.join(calm_cells, list(CELL), "left_semi")).distinct())
        if n_full:
            hot = members.join(broadcast_if_small(cells.where(full).select(*CELL), n_full), list(CELL), "left_semi")
            side = cell_side(F.col("level"))
            hot = hot.select(
                "id", *_SHAPE, (F.col("cx") * side).alias("x0"), (F.col("cy") * side).alias("y0"), side.alias("side")
            )
            known = stars.where(F.col("id") != F.col("component")).select(F.col("id").alias("id_a"), F.col("component").alias("id_b"))
            links = _divide(cut(hot), links.unionByName(known), crowded)
        # Links are between names of components now, so few of them are left; shapes get the name of the whole.
        whole = connected_components(links).select(F.col("id").alias("component"), F.col("component").alias("whole"))
        stars = stars.join(shuffled(whole), "component", "left").select("id", F.coalesce("whole", "component").alias("component"))
    stars = cut(stars)
    linked = stars.where(F.col("id") != F.col("component")).select(F.col("id").alias("id_a"), F.col("component").alias("id_b"))
    copies = copy_links.join(shuffled(stars.withColumnRenamed("id", "rep")), "rep")
    return linked.unionByName(copies.select(F.col("id").alias("id_a"), F.col("component").alias("id_b")))


def _fill_links(reps: DataFrame) -> DataFrame:
    """``id_a, id_b``: rectangles with area in a cell, and the one of smallest id that fills it."""
    hubs = cut(fill_cells(reps, "id").groupBy(*FILL).agg(F.min("id").alias("hub")))
    fills = fills_in_use(hubs)
    if not fills:
        return reps.select(F.col("id").alias("id_a"), F.col("id").alias("id_b")).limit(0)
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    reach = F.greatest(*[F.abs(F.col(c)) for c in BBOX])
    # Only grids that are not much finer than the rectangle: it has few cells there.
    wide = F.filter(
        F.array(*[F.lit(f) for f in fills]),
        lambda f: (F.least(w, h) / 4 < F.pow(F.lit(2.0), f)) & (F.greatest(w, h) < F.pow(F.lit(2.0), f + 6)) & (reach < F.pow(F.lit(2.0), f + 50)),
    )
    boxes = with_level(reps.where("is_box")).select("id", *BBOX, wide.alias("fills"))
    touched = touched_cells(boxes, F.col("fills"))
    side = F.pow(F.lit(2.0), F.col("fill").cast("double"))

    def within(axis: str):
        low = F.col(f"f{axis}") * side
        return F.least(F.col(f"{axis}max"), low + side) - F.greatest(F.col(f"{axis}min"), low)

    some = (within("x") > 0) & (within("y") > 0) & (within("x") * within("y") > AREA_EPS)
    linked = touched.where(some).select("id", *FILL).join(shuffled(hubs), list(FILL)).where(F.col("id") != F.col("hub"))
    # Neighbours come to one task, which leaves a star or so of each of its blocks.
    block = [F.shiftright(F.col(c), BLOCK) for c in FILL[1:]]
    near = linked.withColumn("bx", block[0]).withColumn("by", block[1]).repartition("fill", "bx", "by")
    stars = contracted(near.select(F.col("id").alias("u"), F.col("hub").alias("v")))
    return stars.select(F.col("u").alias("id_a"), F.col("v").alias("id_b")).distinct()


def _sparse_links(members: DataFrame) -> DataFrame:
    """Components of overlapping pairs that meet in the given cells, kept wherever they meet: the one cell of a pair may have been taken out."""
    right = members.where(F.col("level") == F.col("own_level"))
    left, right, keys = salted_pair(members, right, CELL, "id", "id", HOT_CELL)
    one_order = (F.col("l.own_level") < F.col("r.own_level")) | (F.col("l.id") < F.col("r.id"))
    differ = (F.col("l.id") != F.col("r.id")) & (F.col("l.component") != F.col("r.component"))
    pairs = left.alias("l").join(right.alias("r"), _equi(keys) & differ & one_order & bbox_meets(closed=False))
    return _linked(pairs, "component")


def _divide(hot: DataFrame, links: DataFrame, crowded: int) -> DataFrame:
    """Links of the crowded cells: by covering shapes where there are any, else in ever smaller cells."""
    for depth in range(1, MAX_DIVISIONS + 1):
        noise = AREA_EPS / float(_DIVIDE**2) ** depth
        pieces = _pieces(hot, noise)
        whole = F.col("piece") >= F.col("side") * F.col("side") * (1 - 1e-12)
        stats = pieces.groupBy("x0", "y0", "side").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.when(whole, F.col("id"))).alias("hub")
        )
        stats = cut(stats.where(F.col("n") > 1))
        pieces = cut(pieces.join(stats, _SUB_CELL))
        covered = pieces.where(F.col("hub").isNotNull())
        # The hub fills the sub-cell, so a piece in it is an overlap with the hub.  Pieces too small to count as one are
        # compared with all others there by their true overlap.
        stars = covered.where((F.col("piece") > AREA_EPS) & (F.col("id") != F.col("hub")))
        stars = stars.select(F.col("id").alias("id_a"), F.col("hub").alias("id_b"))
        slivers = covered.where(F.col("piece") <= AREA_EPS).drop("hub", "n", "piece")
        others = covered.drop("hub", "n", "piece")
        faint = _linked(slivers.alias("l").join(
            others.alias("r"), _equi(_SUB_CELL) & (F.col("l.id") != F.col("r.id")) & bbox_meets(closed=False)
        ))
        open_cells = pieces.where(F.col("hub").isNull()).drop("hub", "piece")
        small = open_cells.where(F.col("n") <= crowded).drop("n")
        links = cut(links.unionByName(stars).unionByName(faint).unionByName(_cell_pairs(small)).distinct())
        hot = open_cells.where(F.col("n") > crowded).drop("n")
        if hot.limit(1).count() == 0:
            return links
        hot = cut(_undecided(hot, links))
        if hot.limit(1).count() == 0:
            return links
    return links.unionByName(_cell_pairs(hot, salted=True))


def _pieces(hot: DataFrame, noise: float) -> DataFrame:
    """Members of the cells' 4 x 4 sub-cells with the area they have in there."""
    step = F.col("side") / _DIVIDE
    slots = F.sequence(F.lit(0), F.lit(_DIVIDE - 1))
    sub = (
        hot.withColumn("i", F.explode(slots))
        .withColumn("x0", F.col("x0") + F.col("i") * step)
        .where((F.col("xmin") < F.col("x0") + step) & (F.col("xmax") > F.col("x0")))
        .withColumn("j", F.explode(slots))
        .withColumn("y0", F.col("y0") + F.col("j") * step)
        .where((F.col("ymin") < F.col("y0") + step) & (F.col("ymax") > F.col("y0")))
        .withColumn("side", step)
        .drop("i", "j")
    )
    x0, y0, side = F.col("x0"), F.col("y0"), F.col("side")
    return sub.withColumn("piece", clip_area(x0, y0, x0 + side, y0 + side)).where(F.col("piece") > noise)


def _cell_pairs(members: DataFrame, salted: bool = False) -> DataFrame:
    keys = _SUB_CELL
    left, right = members, members
    if salted:
        left, right, keys = salted_pair(members, members, keys, "id", "id", CROWDED_CELL * 8)
    return _linked(
        left.alias("l").join(right.alias("r"), _equi(keys) & (F.col("l.id") < F.col("r.id")) & bbox_meets(closed=False))
    )


def _undecided(hot: DataFrame, links: DataFrame) -> DataFrame:
    """Drops the cells whose members already belong to one component.

    Links between members are enough to tell; leaving out the others only keeps a cell that could have gone.
    """
    ids = cut(hot.select("id").distinct())
    known = links.join(ids.withColumnRenamed("id", "id_a"), "id_a", "left_semi").join(
        ids.withColumnRenamed("id", "id_b"), "id_b", "left_semi"
    )
    named = hot.join(connected_components(known), "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = named.groupBy("x0", "y0", "side").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return hot.join(split.where(F.col("lo") != F.col("hi")).select("x0", "y0", "side"), ["x0", "y0", "side"], "left_semi")


# ---------------------------------------------------------------- groups


def overlap_groups(layer: DataFrame, field: str = "score", min_value: float | None = None, id_col: str = "id") -> DataFrame:
    """``id, group_id`` of the footprints that overlap some other; with ``min_value`` both must reach it."""
    require_columns(layer, id_col, field, *_SHAPE)
    rows = layer if min_value is None else subset(layer, field, min_value)
    links = overlap_links(rows.withColumnRenamed(id_col, "id"))
    return connected_components(links).select(F.col("id").alias(id_col), F.col("component").alias("group_id"))


def group_leaders(layer: DataFrame, groups: DataFrame, field: str = "score", id_col: str = "id") -> DataFrame:
    """``group_id, leader_id, members``: highest field, NULL counting as 0, ties to the smallest id."""
    value = F.coalesce(F.col(field), F.lit(0)).cast("double")
    best = F.min(F.struct((-value).alias("neg"), F.col(id_col).alias("id")))
    joined = layer.select(id_col, field).join(shuffled(groups), id_col)
    return joined.groupBy("group_id").agg(best.alias("b"), F.count(F.lit(1)).alias("members")).select(
        "group_id", F.col("b.id").alias("leader_id"), "members"
    )


def with_leaders(groups: DataFrame, leaders: DataFrame, id_col: str = "id", limit: int = HOT_GROUP) -> DataFrame:
    """``id, group_id, leader_id, members`` per group member; large groups are spread over several tasks."""
    tops = leaders.withColumnRenamed("group_id", "g")
    members = groups.withColumn("g", F.col("group_id"))
    large = tops.where(F.col("members") > limit)
    n = large.count()
    if n == 0:
        return members.join(shuffled(tops), "g").select(id_col, "group_id", "leader_id", "members")
    hot = large.select("g", F.ceil(F.col("members") / limit).cast("int").alias("sl"), F.lit(1).alias("sr"))
    left, right, keys = salted_by(members, tops, ["g"], id_col, "leader_id", broadcast_if_small(hot, n))
    return left.join(right, keys).select(id_col, "group_id", "leader_id", "members")


def merged_parts(layer: DataFrame, tagged: DataFrame, id_col: str = "id") -> DataFrame:
    """``group_id, leader_id``, member id and ``geom``: the parts of each merged geometry, one row per member.

    Parts are kept as they are, not dissolved.  A group of any size has the same shape here, and none has to fit a row.
    """
    return layer.select(id_col, "geom").join(shuffled(tagged), id_col).select("group_id", "leader_id", id_col, "geom")


def merge_overlapped(layer: DataFrame, field: str = "score", min_value: float | None = None, id_col: str = "id") -> DataFrame:
    """The layer with every group of overlapping footprints replaced by its leader: one row per group.

    The leader keeps its attributes and gets the group's bbox, the summed ``area`` of the parts (overlaps count twice) and
    the number of ``members``, 1 for footprints without overlap.  The geometry of a group is the rows of ``merged_parts``;
    ``geom`` is left to untouched rows and NULL for groups.
    """
    groups = cut(overlap_groups(layer, field, min_value, id_col))
    leaders = cut(group_leaders(layer, groups, field, id_col))
    tagged = cut(with_leaders(groups, leaders, id_col))
    own = layer.withColumn("area", geometry_area(F.col("geom")))
    members = own.select(id_col, "area", *BBOX).join(shuffled(tagged), id_col)
    edges = [(F.min if c.endswith("min") else F.max)(c).alias(f"_{c}") for c in BBOX]
    totals = members.groupBy(F.col("leader_id").alias(id_col)).agg(*edges, F.sum("area").alias("_area"))
    joined = own.join(shuffled(tagged.select(id_col, "leader_id", "members")), id_col, "left")
    kept = joined.where(F.col("leader_id").isNull() | (F.col("leader_id") == F.col(id_col))).join(shuffled(totals), id_col, "left")
    merged = F.col("leader_id").isNotNull()
    return kept.select(
        *[F.col(c) for c in layer.columns if c not in ("geom", "area", "members", "is_box", *BBOX)],
        F.coalesce("members", F.lit(1)).cast("long").alias("members"),
        F.coalesce("_area", "area").alias("area"),
        *[F.coalesce(f"_{c}", c).alias(c) for c in BBOX],
        (F.col("is_box") & ~merged).alias("is_box"),
        F.when(~merged, F.col("geom")).alias("geom"),
    )
