"""Points inside polygons given as an edge table (poly_id, ring, x1, y1, x2, y2).

Each polygon is covered by cells of a quadtree that all polygons share: *inside* cells, which no edge
touches, and *edge* cells with few edges each. A cell with more edges is cut into 4 x 4 children. A point in
an inside cell is accepted as it stands; in an edge cell it meets that cell's edges alone, because the cell
knows whether its lower right corner is inside. The cover grows with the number of edges, not with how far
the edges reach, and a point meets a bounded number of edges of each polygon near it.

Which corner is inside follows from the parent's corner and the parent's edges, by the rule that also decides
points: a ray to the right, and then down the right border.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.session import written

#: Edges of a cell that is not cut further.
FEW = 8
#: A child's side in its parent's, as a power of two and as a number.
STEP = 2
PARTS = 1 << STEP
#: How often a cell may be cut: edges that meet in one point never come apart.
ROUNDS = 9
#: Levels below the whole plane that polygons may start from.
START = 14
EDGE = ["x1", "y1", "x2", "y2"]
CELL = ["poly_id", "_k", "_cx", "_cy"]


@dataclass(frozen=True)
class Plane:
    """The square that all cells divide: its lower left corner and its side, a power of two."""

    west: float
    south: float
    side: float

    def at(self, level: int) -> float:
        return self.side / PARTS**level

    def x(self, index: Column, size: Column) -> Column:
        return F.lit(self.west) + index * size

    def y(self, index: Column, size: Column) -> Column:
        return F.lit(self.south) + index * size


@dataclass(frozen=True)
class Cover:
    """``inside`` (poly_id, cell) and ``edges`` (poly_id, cell, odd, edge), the levels of the cells, and their plane."""

    inside: DataFrame
    edges: DataFrame
    levels: list[int]
    plane: Plane


def _plane(edges: DataFrame) -> Plane | None:
    box = edges.agg(
        F.min(F.least("x1", "x2")).alias("w"), F.max(F.greatest("x1", "x2")).alias("e"),
        F.min(F.least("y1", "y2")).alias("s"), F.max(F.greatest("y1", "y2")).alias("n"),
    ).first()
    if box.w is None:
        return None
    span = max(box.e - box.w, box.n - box.s) or 1.0
    side = 2.0 ** math.ceil(math.log2(span * 1.3))
    # Moved a little, so that borders do not run along coordinates that people choose.
    return Plane(box.w - 0.0713 * side, box.s - 0.0577 * side, side)


def _crosses(y: Column) -> Column:
    """Whether a level line at y, or just above it, meets the edge."""
    return (F.col("y1") > y) != (F.col("y2") > y)


def _at(y: Column) -> Column:
    """Where it meets it."""
    return F.try_divide((F.col("x2") - F.col("x1")) * (y - F.col("y1")), F.col("y2") - F.col("y1")) + F.col("x1")


def _below(x: Column, y: Column) -> Column:
    """Whether an edge that crosses the upright line at x does so below (x, y); decided by ``_at``, so that it agrees with the rays."""
    rises = (F.col("x2") > F.col("x1")) == (F.col("y2") > F.col("y1"))
    return F.when(_crosses(y), rises == (_at(y) > x)).otherwise(F.col("y1") <= y)


def _odd_beside(x: Column, y: Column, right: Column, low: Column) -> Column:
    """1 for each edge of a cell that changes sides between the cell's lower right corner and (x, y), else 0."""
    level = _crosses(y) & (_at(y) > x) & (_at(y) <= right)
    upright = ((F.col("x1") > right) != (F.col("x2") > right)) & (_below(right, y) != _below(right, low))
    return level.cast("int") + upright.cast("int")


def _touched(plane: Plane, size: Column, first_x: Column, first_y: Column, parts: int) -> Column:
    """The cells (column, row) from (first_x, first_y) on, ``parts`` each way, that an edge may touch, with a small margin."""
    margin = size * 1e-6
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    index = lambda v, start: F.floor((v - F.lit(start)) / size)
    clip = lambda v, first: F.least(F.greatest(v, first), first + parts)
    rows = F.sequence(clip(index(low - margin, plane.south), first_y), clip(index(high + margin, plane.south), first_y))

    def columns(row: Column) -> Column:
        bottom, top = F.greatest(low, plane.y(row, size) - margin), F.least(high, plane.y(row + 1, size) + margin)
        slanted = F.col("y1") != F.col("y2")
        a, b = F.when(slanted, _at(bottom)).otherwise(F.col("x1")), F.when(slanted, _at(top)).otherwise(F.col("x2"))
        from_, to = index(F.least(a, b) - margin, plane.west), index(F.greatest(a, b) + margin, plane.west)
        cells = F.filter(F.sequence(clip(from_, first_x - 1), clip(to, first_x - 1)), lambda c: (c >= first_x) & (c < first_x + parts))
        meets = (bottom <= high) & (top >= low)
        return F.when(meets, F.transform(cells, lambda c: F.struct(c.alias("_cx"), row.alias("_cy")))).otherwise(F.array())

    inside = F.filter(rows, lambda r: (r >= first_y) & (r < first_y + parts))
    return F.flatten(F.transform(inside, columns))


def _start(edges: DataFrame, plane: Plane) -> DataFrame:
    """Each polygon's edges in cells at least as wide as the polygon, four of them or fewer."""
    boxes = edges.groupBy("poly_id").agg(
        F.min(F.least("x1", "x2")).alias("_w"), F.max(F.greatest("x1", "x2")).alias("_e"),
        F.min(F.least("y1", "y2")).alias("_s"), F.max(F.greatest("y1", "y2")).alias("_n"),
    )
    extent = F.greatest(F.col("_e") - F.col("_w"), F.col("_n") - F.col("_s"))
    levels = F.array(*[F.when(extent * 1.001 <= plane.at(k), k) for k in range(START + 1)])
    size = F.lit(plane.side) / F.pow(F.lit(float(PARTS)), F.col("_k"))
    first = lambda low, start: F.floor((F.col(low) - F.lit(start)) / size)
    boxes = boxes.withColumn("_k", F.coalesce(F.array_max(levels), F.lit(0)))
    boxes = boxes.select("poly_id", "_k", first("_w", plane.west).alias("_fx"), first("_s", plane.south).alias("_fy"))
    placed = edges.join(boxes, "poly_id").withColumn("_size", size)
    cells = placed.select("poly_id", "_k", *EDGE, F.inline(_touched(plane, F.col("_size"), F.col("_fx"), F.col("_fy"), 2)))
    # A polygon's corners by a ray over all of its edges.
    corners = boxes.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
        "poly_id", "_k", (F.col("_fx") + F.col("_i") % 2).alias("_cx"), (F.col("_fy") + F.floor(F.col("_i") / 2)).alias("_cy"), size.alias("_size")
    )
    y = plane.y(F.col("_cy"), F.col("_size"))
    rays = corners.join(edges, "poly_id").where(_crosses(y) & (_at(y) > plane.x(F.col("_cx") + 1, F.col("_size"))))
    odd = rays.groupBy(*CELL).agg((F.count(F.lit(1)) % 2).alias("odd"))
    return cells.join(odd, CELL, "left").select(*CELL, F.coalesce("odd", F.lit(0)).cast("int").alias("odd"), *EDGE)


def _children(dense: DataFrame, plane: Plane, level: int) -> tuple[DataFrame, DataFrame]:
    """Inside cells and edges of the 4 x 4 children of cells that share a level."""
    size, small = F.lit(plane.at(level)), F.lit(plane.at(level + 1))
    right, low = plane.x(F.col("_cx") + 1, size), plane.y(F.col("_cy"), size)
    lines = dense.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    y = plane.y(F.col("_cy") * PARTS + F.col("_r"), small)
    changes = [_odd_beside(plane.x(F.col("_cx") * PARTS + i + 1, small), y, right, low).alias(f"_h{i}") for i in range(PARTS)]
    counted = lines.select(*CELL, "_r", *changes).where(" + ".join(f"_h{i}" for i in range(PARTS)) + " > 0")
    counted = counted.groupBy(*CELL, "_r").agg(*[F.sum(f"_h{i}").alias(f"_h{i}") for i in range(PARTS)])
    rows = dense.groupBy(*CELL).agg(F.max("odd").alias("odd")).withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    rows = rows.join(counted, [*CELL, "_r"], "left")
    down = lambda c, i: (F.col(c) * PARTS + i)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("odd") + F.coalesce(f"_h{i}", F.lit(0))) % 2).cast("int").alias("odd")) for i in range(PARTS)]))
    children = rows.select("poly_id", F.lit(level + 1).alias("_k"), "_cx", down("_cy", F.col("_r")).alias("_cy"), each.alias("_c")).select(
        "poly_id", "_k", down("_cx", F.col("_c.i")).alias("_cx"), "_cy", "_c.odd"
    )
    touched = _touched(plane, small, F.col("_cx") * PARTS, F.col("_cy") * PARTS, PARTS)
    below = dense.select("poly_id", F.lit(level + 1).alias("_k"), *EDGE, F.inline(touched))
    held = children.join(below.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n")), CELL, "left")
    return held.where("_n IS NULL AND odd = 1").select(*CELL), below.join(children, CELL).select(*CELL, "odd", *EDGE)


def cover(edges: DataFrame, cell: float | None = None, few: int = FEW) -> Cover | None:
    """The cells of all polygons; None without edges. Edges with a missing coordinate are left out.

    Cells with more than ``few`` edges are cut, as are those with edges that are wider than ``cell`` where that
    is given. Each round of cutting is a table in the shared folder; polygons of few edges need none.
    """
    whole = edges.select("poly_id", *[F.col(c).cast("double").alias(c) for c in EDGE])
    whole = whole.where(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in EDGE))
    plane = _plane(whole)
    if plane is None:
        return None
    now, inside, done, levels = _start(whole, plane), [], [], set()
    for step in range(ROUNDS + 1):
        counts = now.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n"))
        wide = F.lit(False) if cell is None else F.col("_k").isin([k for k in range(START + ROUNDS + 1) if plane.at(k) > cell])
        cut = (F.col("_n") > few) | wide
        state = {r[0]: r[1] for r in counts.groupBy("_k").agg(F.max(cut)).collect()}  # a row for each level
        found = sorted(k for k, more in state.items() if more) if step < ROUNDS else []
        levels |= {*state, *(k + 1 for k in found)}
        if not found:
            done.append(now)
            break
        many = written(counts.where(cut).select(*CELL), "cover-many")
        done.append(now.join(many, CELL, "left_anti"))
        dense = written(now.join(many, CELL), "cover-dense")
        pairs = [_children(dense.where(F.col("_k") == level), plane, level) for level in found]
        inside += [p[0] for p in pairs]
        now = written(reduce(DataFrame.unionByName, [p[1] for p in pairs]), "cover-cells")
    held = reduce(DataFrame.unionByName, done)
    none = held.select(*CELL).where("false")
    return Cover(written(reduce(DataFrame.unionByName, inside), "cover-inside") if inside else none, held, sorted(levels), plane)


def points_in_polygons(points: DataFrame, edges: DataFrame, x: str, y: str, cell: float | None = None) -> DataFrame:
    """Distinct (x, y, poly_id) with the point inside, by the even-odd rule.

    Equal points are tested once, so a crowded place costs one row. Points meet inside cells, and single edges
    of edge cells, by equal cells; a crowded cell is a join key that adaptive execution can split. ``cell``
    bounds the side of cells that have edges.
    """
    spots = points.select(F.col(x).alias("_x"), F.col(y).alias("_y")).where(
        F.col(x).isNotNull() & F.col(y).isNotNull()
    ).distinct()
    covered = cover(edges, cell)
    if covered is None:
        return spots.join(edges.select("poly_id"), F.lit(False)).select(F.col("_x").alias(x), F.col("_y").alias(y), "poly_id")
    plane, px, py = covered.plane, F.col("_x").cast("double"), F.col("_y").cast("double")

    def place(k: int) -> Column:
        size = plane.at(k)
        return F.struct(F.lit(k).alias("_k"), F.floor((px - plane.west) / size).alias("_cx"), F.floor((py - plane.south) / size).alias("_cy"))

    within = px.between(plane.west, plane.west + plane.side) & py.between(plane.south, plane.south + plane.side)
    placed = spots.where(within).select("_x", "_y", F.inline(F.array(*[place(k) for k in covered.levels])))
    size = F.lit(plane.side) / F.pow(F.lit(float(PARTS)), F.col("_k"))
    near = placed.join(covered.edges, CELL[1:])
    beside = _odd_beside(px, py, plane.x(F.col("_cx") + 1, size), plane.y(F.col("_cy"), size))
    odd = near.groupBy("_x", "_y", "poly_id").agg(((F.max("odd") + F.sum(beside)) % 2).alias("_odd")).where("_odd = 1")
    found = odd.select("_x", "_y", "poly_id").union(placed.join(covered.inside, CELL[1:]).select("_x", "_y", "poly_id"))
    return found.select(F.col("_x").alias(x), F.col("_y").alias(y), "poly_id")


def within_any(points: DataFrame, edges: DataFrame, x: str, y: str, cell: float | None = None) -> DataFrame:
    """Rows whose point lies in the union of the polygons."""
    hits = points_in_polygons(points, edges, x, y, cell).select(x, y).distinct()
    return points.join(hits, [x, y], "left_semi")
