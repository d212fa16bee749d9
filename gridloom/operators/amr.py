"""Compositing of multi-level chunks onto uniform canvases.

A chunk paints the rectangle of canvas points inside its own footprint (see `canvas`),
reading its values straight out of its array by position, so there is no cell table, no
range join and no row per point before a canvas is finished. Extents come from
chunk metadata alone; the `data` column is not read for them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import names
from gridloom.functions.grid import Axis, grid_point
from gridloom.operators import canvas
from gridloom.functions.scalars import NAN, is_finite
from gridloom.operators.ordered import Ordered
from gridloom.operators.skew import join_keys, sized

CANVAS = ("series", "iteration", "label")

# Record axes (z, y, x): which is cut, which runs slow and which fast.
SLICE_AXES = {
    "xy": {"cut": 0, "slow": 1, "fast": 2},
    "xz": {"cut": 1, "slow": 0, "fast": 2},
    "yz": {"cut": 2, "slow": 0, "fast": 1},
}


def labelled(chunks: DataFrame) -> DataFrame:
    """Parse mesh names: adds group, centering, level, patch, plane_tag, label; drops unparseable rows."""
    return names.with_mesh(chunks).select(
        *chunks.columns,
        F.col("_m.group").alias("group"), F.col("_m.centering").alias("centering"),
        F.col("_m.level").alias("level"), F.col("_m.patch").alias("patch"),
        F.col("_m.plane.tag").alias("plane_tag"),
        names.component_label("component", "_m.group").alias("label"),
    )


def select_label(chunks: DataFrame, needle: str) -> str:
    """The one label meant by `needle`: the only one, else the exact, else the only containing one."""
    labels = chunks.select("label").distinct()
    low, want = F.lower("label"), F.lit(needle.lower())
    exact, inside = low == want, F.contains(low, want)
    r = labels.agg(
        F.count("label").alias("n"),
        F.min("label").alias("any"),
        F.count_if(exact).alias("n_exact"),
        F.min(F.when(exact, F.col("label"))).alias("exact"),
        F.count_if(inside).alias("n_inside"),
        F.min(F.when(inside, F.col("label"))).alias("inside"),
    ).first()
    if r["n"] == 0:
        raise ValueError(f"no variable matches {needle!r}")
    if r["n"] == 1:
        return r["any"]
    if r["n_exact"] == 1:
        return r["exact"]
    if r["n_inside"] == 1:
        return r["inside"]
    some = [x["label"] for x in labels.orderBy("label").limit(8).collect()]
    more = ", ..." if r["n"] > 8 else ""
    raise ValueError(f"{needle!r} matches several variables: {', '.join(some)}{more}")


def clip_chunks(chunks: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Cut the unwritten fill row off cell-centred axes and drop chunks left empty.

    `stored` keeps the extent the data array was laid out with.
    """
    clipped = F.transform(
        F.sequence(F.lit(0), F.size("ext") - 1),
        lambda d: F.when(
            F.get("position", d) != 0,
            F.least(F.get("ext", d), F.greatest(F.lit(0), F.get("shape", d) - 1 - F.get("off", d))),
        ).otherwise(F.get("ext", d)),
    )
    out = chunks.withColumn("stored", F.col("ext")).withColumn("ext", clipped)
    return out if keep_empty else out.filter(F.forall("ext", lambda e: e > 0))


PRIO = "decimal(38,0)"


def paint_order(columns: Sequence[str]) -> Column:
    """(level, patch, series, mesh_seq, chunk_id) as one number, so the aggregate stays a hash aggregate.

    8, 16, 32, 31 and 32 bits: what names and column types can hold. Series that number their meshes alike
    rank by a hash of their names, so the order is total.
    """
    big = lambda c: F.col(c).cast("bigint")
    series = F.shiftrightunsigned(F.xxhash64("series"), 32) if "series" in columns else F.lit(0)
    high = (big("level") * (1 << 16) + big("patch")) * (1 << 32) + series
    low = big("mesh_seq") * (1 << 32) + big("chunk_id")
    fits = big("level").between(0, 255) & big("patch").between(0, 65535) & big("mesh_seq").between(0, (1 << 31) - 1) & big("chunk_id").between(0, (1 << 32) - 1)
    number = high.cast("decimal(18,0)") * F.lit(str(1 << 63)).cast("decimal(19,0)") + low.cast("decimal(19,0)")
    return F.when(fits, number.cast(PRIO)).otherwise(
        F.raise_error(F.lit("level, patch, mesh_seq or chunk_id out of range for the paint order")).cast(PRIO)
    )


def axis_2d(d: int) -> Axis:
    spacing = F.get("spacing", F.lit(d))
    first = F.get("grid_offset", F.lit(d)) + (F.get("off", F.lit(d)) + F.get("position", F.lit(d))) * spacing
    return Axis(first, F.lit(0.0), spacing, F.get("ext", F.lit(d)).cast("int"))


def axis_3d(d: int) -> Axis:
    return Axis(
        F.get("grid_offset", F.lit(d)),
        F.get("off", F.lit(d)) + F.get("position", F.lit(d)),
        F.get("spacing", F.lit(d)),
        F.get("ext", F.lit(d)).cast("int"),
    )


def _coarsest(per_chunk: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of the chunk boxes of the coarsest level present, one row per canvas."""
    box = F.struct(
        F.min("_x0").alias("x_min"), F.max("_x1").alias("x_max"),
        F.min("_y0").alias("y_min"), F.max("_y1").alias("y_max"),
    )
    return (
        per_chunk.groupBy(*keys, "level")
        .agg(box.alias("_box"))
        .groupBy(*keys)
        .agg(F.min_by("_box", "level").alias("_box"))
        .select(*keys, "_box.*")
    )


def plane_extents(chunks: DataFrame, keys: Sequence[str] = CANVAS) -> DataFrame:
    """Canvas box of 2D chunks: first centre to one spacing past the last, coarsest written level."""
    y, x = axis_2d(0), axis_2d(1)
    return _coarsest(
        clip_chunks(chunks).filter(F.size("ext") == 2).select(
            *keys, "level",
            F.least(x.first, x.first + x.n * x.step).alias("_x0"),
            F.greatest(x.first, x.first + x.n * x.step).alias("_x1"),
            F.least(y.first, y.first + y.n * y.step).alias("_y0"),
            F.greatest(y.first, y.first + y.n * y.step).alias("_y1"),
        ),
        keys,
    )


def stabbed(chunks: DataFrame, axis: str, at: float) -> DataFrame:
    """3D chunks whose half-cell padded span along the cut axis holds `at`; adds the slab index `_k`."""
    cut = axis_3d(SLICE_AXES[axis]["cut"])
    pad = F.abs(cut.step) / 2
    s = F.lit(float(at))
    # Ties between two planes go to the lower index, whichever way the axis runs.
    k0 = F.greatest(F.lit(0), F.least(cut.n - 1, F.floor((s - cut.first) / cut.step).cast("int")))
    k1 = F.least(cut.n - 1, k0 + 1)
    k = F.when(F.abs(cut.at(k1) - s) < F.abs(cut.at(k0) - s), k1).otherwise(k0)
    return (
        clip_chunks(chunks)
        .filter((F.size("ext") == 3) & (s >= cut.low - pad) & (s <= cut.high + pad))
        .withColumn("_k", k)
    )


def slice_extents(chunks: DataFrame, axis: str, at: float, keys: Sequence[str] = CANVAS) -> DataFrame:
    """Canvas box of a 3D cut: span of the centres, coarsest level the plane meets."""
    slow, fast = axis_3d(SLICE_AXES[axis]["slow"]), axis_3d(SLICE_AXES[axis]["fast"])
    return _coarsest(
        stabbed(chunks, axis, at).select(
            *keys, "level",
            fast.low.alias("_x0"), fast.high.alias("_x1"), slow.low.alias("_y0"), slow.high.alias("_y1"),
        ),
        keys,
    )


@dataclass(frozen=True)
class Extent:
    """Explicit canvas box: all four bounds, each minimum below its maximum."""

    x_min: float
    x_max: float
    y_min: float
    y_max: float

    def __post_init__(self):
        if not (self.x_min < self.x_max and self.y_min < self.y_max):
            raise ValueError("extent needs x_min < x_max and y_min < y_max")

    @classmethod
    def of(cls, x_min=None, x_max=None, y_min=None, y_max=None) -> "Extent | None":
        given = [v is not None for v in (x_min, x_max, y_min, y_max)]
        if not any(given):
            return None
        if not all(given):
            raise ValueError("give all four bounds of the extent or none")
        return cls(x_min, x_max, y_min, y_max)


def _with_extent(chunks: DataFrame, extent: "Extent | DataFrame") -> DataFrame:
    if isinstance(extent, Extent):
        return chunks.withColumns({
            k: F.lit(float(getattr(extent, k))) for k in ("x_min", "x_max", "y_min", "y_max")
        })
    keys = [c for c in extent.columns if c in chunks.columns]
    return chunks.join(sized(extent), keys)


def _patches(
    chunks: DataFrame, slow: Axis, fast: Axis, base: Column, slow_stride: Column, fast_stride: Column,
    extent: "Extent | DataFrame", keys: Sequence[str],
) -> DataFrame:
    """Rows for `canvas.painted`: what each chunk's rectangle needs, with its canvas box."""
    own = {f"_{n}{p}": c for n, a in (("y", slow), ("x", fast)) for p, c in (("o", a.origin), ("s", a.start), ("d", a.step))}
    whole = {"_yn": slow.n, "_xn": fast.n, "_base": base, "_slow": slow_stride, "_fast": fast_stride}
    rows = chunks.select(
        *keys, paint_order(chunks.columns).cast("string").alias("_prio"), F.col("data").cast("array<double>").alias("_data"),
        *[c.cast("double").alias(n) for n, c in own.items()], *[c.cast("int").alias(n) for n, c in whole.items()],
    )
    return _with_extent(rows, extent)


def plane_patches(chunks: DataFrame, extent: "Extent | DataFrame", keys: Sequence[str]) -> DataFrame:
    """Rectangles of 2D chunks."""
    flat = clip_chunks(chunks).filter(F.size("ext") == 2)
    return _patches(flat, axis_2d(0), axis_2d(1), F.lit(0), F.get("stored", F.lit(1)), F.lit(1), extent, keys)


def slice_patches(chunks: DataFrame, axis: str, at: float, extent: "Extent | DataFrame", keys: Sequence[str]) -> DataFrame:
    """Rectangles of a cut through 3D chunks; the slab is addressed inside the array, never copied out."""
    a = SLICE_AXES[axis]
    stride = (F.get("stored", F.lit(1)) * F.get("stored", F.lit(2)), F.get("stored", F.lit(2)), F.lit(1))
    return _patches(
        stabbed(chunks, axis, at), axis_3d(a["slow"]), axis_3d(a["fast"]),
        F.col("_k") * stride[a["cut"]], stride[a["slow"]], stride[a["fast"]], extent, keys,
    )


_BOX = ("x_min", "x_max", "y_min", "y_max")


def _points(canvases: DataFrame, keys: Sequence[str], values: Column, nx: int, ny: int) -> DataFrame:
    """(keys, j, i, y, x, _v) of finished canvases, `values` an array per canvas."""
    rows = canvases.select(*keys, *_BOX, F.posexplode(values).alias("_at", "_v"))
    j, i = F.expr(f"cast(_at div {nx} as int)"), F.expr(f"cast(_at % {nx} as int)")
    return rows.withColumns({"j": j, "i": i}).select(
        *keys, "j", "i",
        grid_point(F.col("j"), F.col("y_min"), F.col("y_max"), ny).alias("y"),
        grid_point(F.col("i"), F.col("x_min"), F.col("x_max"), nx).alias("x"), "_v",
    )


def _composite(
    patches: DataFrame, given: "Extent | DataFrame | None", keys: Sequence[str], nx: int, ny: int, method: str, dense: bool
) -> DataFrame:
    """Last writer wins on every canvas; points of canvases that only a given extent names are all unwritten."""
    keys = list(keys)
    made = canvas.painted(patches, [*keys, *_BOX], nx, ny, method)
    if dense and isinstance(given, DataFrame):
        blank = F.array_repeat(F.lit(NAN), nx * ny)
        made = join_keys(given.select(*keys, *_BOX), made.drop(*_BOX), keys, broadcast=False).withColumn("data", F.coalesce("data", blank))
    points = _points(made, keys, F.col("data"), nx, ny).withColumnRenamed("_v", "v")
    points = points.select(*keys, "j", "i", "v", "y", "x")
    return points if dense else points.filter(is_finite("v"))


def composite_plane(
    chunks: DataFrame, *, nx: int = 1024, ny: int = 1024, method: str = "linear",
    extent: "Extent | DataFrame | None" = None, keys: Sequence[str] = CANVAS, dense: bool = True,
) -> DataFrame:
    """2D canvas (keys, j, i, y, x, v) per canvas key; `dense` also lists the points nothing wrote."""
    boxes = plane_extents(chunks, keys) if extent is None else extent
    return _composite(plane_patches(chunks, boxes, keys), extent, keys, nx, ny, method, dense)


def composite_slice(
    chunks: DataFrame, axis: str, at: float = 0.0, *, n: int = 1024, method: str = "nearest",
    extent: "Extent | DataFrame | None" = None, keys: Sequence[str] = CANVAS, dense: bool = True,
) -> DataFrame:
    """n x n canvas of the cut `axis` at coordinate `at`; j runs along the slow axis."""
    boxes = slice_extents(chunks, axis, at, keys) if extent is None else extent
    return _composite(slice_patches(chunks, axis, at, boxes, keys), extent, keys, n, n, method, dense)


def composite_recipe(
    chunks: DataFrame,
    variables: Mapping[str, str],
    combine: Callable[[dict[str, Column]], Column] | None = None,
    *,
    nx: int = 1024, ny: int = 1024, method: str = "linear", extent: Extent | None = None,
    axis: str | None = None, at: float = 0.0,
) -> DataFrame:
    """Several labels on the first label's box, combined point by point into `v`.

    With `axis` the sources are cuts of 3D chunks, otherwise 2D planes. Every source is painted as a canvas of its own;
    the few canvases of an iteration meet as arrays.
    """
    if not variables:
        raise ValueError("a recipe needs at least one variable")
    if combine is None:
        if len(variables) != 1:
            raise ValueError("a recipe with several variables needs `combine`")
        combine = lambda v: next(iter(v.values()))
    keys = ["series", "iteration"]
    first = next(iter(variables.values()))
    used = chunks.filter(F.col("label").isin(*set(variables.values())))
    lead = used.filter(F.col("label") == first)
    full = [*keys, "label"]
    if axis is None:
        box = extent or plane_extents(lead, keys)
        patches = plane_patches(used, box, full)
    else:
        box = extent or slice_extents(lead, axis, at, keys)
        patches = slice_patches(used, axis, at, box, full)
    if isinstance(box, Extent):
        # Canvases are those of the first label, whatever else there is.
        patches = join_keys(patches, lead.select(*keys).distinct(), keys, "left_semi", broadcast=False)
    painted = canvas.painted(patches, [*full, *_BOX], nx, ny, method)
    together = painted.groupBy(*keys, *_BOX).agg(*[
        F.first(F.when(F.col("label") == label, F.col("data")), ignorenulls=True).alias(f"_{alias}") for alias, label in variables.items()
    ])
    none = F.array_repeat(F.lit(NAN), nx * ny)
    zipped = F.arrays_zip(*[F.coalesce(f"_{alias}", none).alias(f"_{alias}") for alias in variables])
    points = _points(together, keys, zipped, nx, ny)
    return points.select(*keys, "j", "i", "y", "x", combine({a: F.col("_v")[f"_{a}"] for a in variables}).alias("v"))


#: Names of the axes of a chunk, counted from the last.
AXES = ("i", "j", "k")


def _ranked(chunks: DataFrame) -> DataFrame:
    """Clipped chunks of up to three axes + per axis `_o`, `_e`, `_s` (offset, extent, stored extent), NULL where a chunk lacks it."""
    rank = F.size("ext")
    known = F.when(rank.between(1, 3), True).otherwise(F.raise_error(F.lit("chunks of one to three axes expected")).cast("boolean"))
    at = lambda c, q: F.get(c, F.size("ext") - 1 - q)
    return clip_chunks(chunks).filter(known).withColumn("_rank", rank).withColumns(
        {f"_{n}{a}": at(c, q) for q, a in enumerate(AXES) for n, c in (("o", "off"), ("e", "ext"), ("s", "stored"))}
    )


def chunk_cells(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells of 1D to 3D chunks with absolute index (gk, gj, gi), NULL for axes they lack; one row per written cell."""
    meta = [f"_{n}{a}" for a in AXES for n in "oes"]
    cells = _ranked(chunks).select(*keys, "chunk_id", *meta, F.posexplode("data").alias("_p", "v"))
    # The slowest axis takes all that is left, so that points beyond the extent stay outside.
    place = {"i": "if(_sj is null, _p, _p % _si)", "j": "if(_sk is null, _p div _si, (_p div _si) % _sj)", "k": "_p div (_si * _sj)"}
    inside = [f"coalesce(_{a} < _e{a}, true)" for a in AXES]
    return (
        cells.withColumns({f"_{a}": F.expr(e) for a, e in place.items()})
        .filter(" and ".join(inside))
        .select(*keys, "chunk_id", *[(F.col(f"_o{a}") + F.col(f"_{a}")).alias(f"g{a}") for a in reversed(AXES)], "v")
    )


def assemble(chunks: DataFrame, keys: Sequence[str] = ("series", "iteration", "mesh_name", "component")) -> DataFrame:
    """Bounding box of a mesh's chunks of one to three axes, NaN where nothing was written, later chunks on top.

    Here a NaN does overwrite: the whole chunk replaces what lies under it.
    """
    index = [f"g{a}" for a in reversed(AXES)]
    blank = _ranked(chunks).groupBy(*keys, "_rank").agg(
        *[F.min(f"_o{a}").alias(f"_{a}0") for a in AXES], *[F.max(F.col(f"_o{a}") + F.col(f"_e{a}") - 1).alias(f"_{a}1") for a in AXES])
    for a in reversed(AXES):
        blank = blank.withColumn(f"g{a}", F.explode_outer(F.sequence(f"_{a}0", f"_{a}1")))
    return (
        chunk_cells(chunks, keys).unionByName(blank.select(*keys, F.lit(-1).alias("chunk_id"), *index, F.lit(NAN).alias("v")))
        .groupBy(*keys, *index).agg(F.max_by("v", "chunk_id").alias("v"))
    )


def _product(c: str) -> Column:
    return F.aggregate(c, F.lit(1).cast("bigint"), lambda a, x: a * x)


def sparsity(chunks: DataFrame) -> DataFrame:
    """Declared against written points per (series, iteration, label, level, patch); metadata only.

    When several meshes share an entry the last in (mesh_name, component) order is reported.
    """
    entry = ["series", "iteration", "label", "level", "patch"]
    written = F.forall("ext", lambda e: e > 0)
    per_mesh = (
        clip_chunks(chunks, keep_empty=True)
        .groupBy(*entry, "mesh_name", "component")
        .agg(
            F.max(_product("shape")).alias("declared_points"),
            F.coalesce(F.sum(F.when(written, _product("ext"))), F.lit(0).cast("bigint")).alias("actual_points"),
            F.count_if(written).alias("n_chunks"),
        )
    )
    row = F.struct("mesh_name", "component", "declared_points", "actual_points", "n_chunks")
    declared, actual = F.col("declared_points"), F.col("actual_points")
    return (
        per_mesh.groupBy(*entry)
        .agg(F.max_by(row, F.struct("mesh_name", "component")).alias("_r"))
        .select(*entry, "_r.*")
        .withColumn(
            "pct_unwritten",
            F.when(declared > 0, 100 * (1 - actual / declared)).otherwise(F.lit(0.0)),
        )
    )


def chunk_listing(chunks: DataFrame) -> DataFrame:
    """Chunks to show per mesh: all of up to five, else the first two and the last two."""
    entry = ["series", "iteration", "mesh_name", "component"]
    kept = clip_chunks(chunks).select(*entry, "chunk_id", "off", F.col("stored").alias("extent"), _product("ext").alias("points"))
    o = Ordered.of(kept, entry, "chunk_id").index("idx").count("n_chunks")
    return o.result().filter("n_chunks <= 5 or idx < 2 or idx >= n_chunks - 2")


def chunk_edges(chunks: DataFrame, keys: Sequence[str] = CANVAS) -> DataFrame:
    """Cell edges of every 2D chunk, for drawing chunk by chunk without a canvas."""
    y, x = axis_2d(0), axis_2d(1)

    def edges(a: Axis) -> Column:
        return F.transform(F.sequence(F.lit(0), a.n), lambda k: a.first + (k.cast("double") - 0.5) * a.step)

    return (
        clip_chunks(chunks).filter(F.size("ext") == 2)
        .select(*keys, "level", "mesh_seq", "chunk_id", edges(y).alias("y_edges"), edges(x).alias("x_edges"))
    )


def shared_colour_scale(chunks: DataFrame, keys: Sequence[str] = ("series", "iteration")) -> DataFrame:
    """Minimum and maximum over all chunks drawn together; reduced inside each row first."""
    return (
        chunks.select(*keys, F.array_min("data").alias("_lo"), F.array_max("data").alias("_hi"))
        .groupBy(*keys)
        .agg(F.min("_lo").alias("vmin"), F.max("_hi").alias("vmax"))
    )
