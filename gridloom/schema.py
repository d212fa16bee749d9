"""Explicit schemas of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_AL, _AD = T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())

# One row is one 2D slice; `data` is row-major with x as the first axis.
FIELD_SLICE = _struct(
    ("run", _S), ("variable", _S), ("plane", _S), ("iteration", _L), ("time", _D),
    ("nx", _I), ("ny", _I), ("data", _AD),
)
FIELD_META = _struct(
    ("variable", _S), ("label", _S), ("plane", _S), ("simdir", _S),
    ("interp_order", _I), ("resolution", T.ArrayType(_I)), ("backend", _S),
)
ITER_INDEX = _struct(("run", _S), ("variable", _S), ("iteration", _L), ("time", _D))

FILE_INDEX = _struct(
    ("path", _S), ("name", _S), ("ext", _S), ("parent", _S), ("depth", _I), ("is_dir", T.BooleanType()),
)

# One row is one written chunk. `mesh_seq` is the rank of the mesh name within
# its iteration and `chunk_id` the chunk's place within its mesh: together with
# level and patch they fix the paint order. Arrays follow record order, which
# is (y, x) in 2D and (z, y, x) in 3D.
AMR_CHUNK = _struct(
    ("series", _S), ("iteration", _L), ("time", _D), ("mesh_name", _S), ("component", _S),
    ("mesh_seq", _I), ("chunk_id", _I),
    ("shape", _AL), ("off", _AL), ("ext", _AL),
    ("grid_offset", _AD), ("spacing", _AD), ("position", _AD), ("data", _AD),
)

TIME_SERIES = _struct(("run", _S), ("quantity", _S), ("t", _D), ("y", _D))
FREQ_SERIES = _struct(("run", _S), ("k", _L), ("f", _D), ("re", _D), ("im", _D), ("amp", _D))
GW_MODE = _struct(
    ("run", _S), ("radius", _D), ("l", _I), ("m", _I), ("t", _D), ("re", _D), ("im", _D),
)
ASCII_0D = _struct(
    ("run", _S), ("restart", _I), ("iteration", _L), ("time", _D), ("value", _D),
)
RUN_META = _struct(("run", _S), ("t_merge", _D), ("rho_crit", _D), ("label", _S))
TRACK = _struct(
    ("run", _S), ("body", _I), ("iteration", _L), ("time", _D), ("x", _D), ("y", _D), ("z", _D),
)

VOLUME_COLUMNS_SHORT = (
    "time", "thermal", "entropy", "kinetic", "rotation", "kinz", "kin_total", "mass",
)
VOLUME_COLUMNS_LONG = (
    "time", "thermal", "entropy", "kinetic", "rotation", "kinz",
    "kinetic-shi", "rotation-shi", "kinz-shi", "kin_total", "mass",
)
