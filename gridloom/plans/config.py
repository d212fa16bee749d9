"""Configuration of the resampling and movie steps."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

import yaml

PLANES = ("xy", "xz", "yz")


@dataclass(frozen=True)
class Grid:
    """Output grid; `resolution` counts points, both end points included."""

    resolution: tuple[int, int] = (1000, 1000)
    box_bound: float = 50.0
    min: tuple[float, float] | None = None
    max: tuple[float, float] | None = None

    def bounds(self) -> tuple[tuple[float, float], tuple[float, float]]:
        """Explicit corners when both are given, otherwise the square box."""
        if self.min is not None and self.max is not None:
            return self.min, self.max
        b = float(self.box_bound)
        return (-b, -b), (b, b)


@dataclass(frozen=True)
class ResampleConfig:
    simdir: str
    label: str
    variables: tuple[str, ...]
    output_dir: str = "./resampled"
    plane: str = "xy"
    interp_order: int = 1
    dtype: str = "float64"
    iteration_stride: int = 1
    iteration_min: int | None = None
    iteration_max: int | None = None
    compression_level: int | None = 4
    scan_max_depth: int = 8
    resample_chunks: int = 1
    backend: str = "openpmd"
    grid: Grid = field(default_factory=Grid)
    exclude_dirs: tuple[str, ...] = ()
    exclude_files: tuple[str, ...] = ()
    index_path: str | None = None
    index_reuse: bool = False

    def __post_init__(self):
        missing = [k for k in ("simdir", "label", "variables") if not getattr(self, k)]
        if missing:
            raise ValueError(f"missing required settings: {', '.join(missing)}")
        if self.plane not in PLANES:
            raise ValueError(f"plane must be one of {', '.join(PLANES)}, not {self.plane!r}")
        if self.interp_order not in (0, 1):
            raise ValueError("interp_order must be 0 (nearest) or 1 (linear)")
        if int(self.resample_chunks) < 1:
            raise ValueError("resample_chunks must be at least 1")
        if self.index_reuse and not self.index_path:
            raise ValueError("reusing a file index needs its path")

    @property
    def method(self) -> str:
        return "linear" if self.interp_order else "nearest"


def _texts(value: Any) -> tuple[str, ...]:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(str(v) for v in value)


def load_resample_config(path: str | Path) -> ResampleConfig:
    """Read the YAML file, fill in defaults and validate; unknown keys are left alone."""
    raw = yaml.safe_load(Path(path).read_text()) or {}
    known = {f.name for f in fields(ResampleConfig)}
    given = {k: v for k, v in raw.items() if k in known and k != "grid"}
    for key in ("simdir", "label", "variables"):
        given.setdefault(key, None)
    given["variables"] = _texts(given["variables"])
    grid = {k: v for k, v in (raw.get("grid") or {}).items() if v is not None}
    for key in ("resolution", "min", "max"):
        if key in grid:
            grid[key] = tuple(grid[key])
    saved, skipped = raw.get("simdir_pickle") or {}, raw.get("simdir_exclude") or {}
    return ResampleConfig(
        **given, grid=Grid(**grid),
        exclude_dirs=_texts(skipped.get("dirs")), exclude_files=_texts(skipped.get("files")),
        index_path=saved.get("path"), index_reuse=bool(saved.get("pickled")),
    )


# Fixed list: the settings a movie file may override.
MOVIE_DEFAULTS: dict[str, Any] = {
    "FIELDS": {}, "MSUN_TO_KM": 1.4766696910334391, "MILLIS": 203.01930744592713, "T_MERGE": 0.0,
    "FRAME_START": 0, "FRAME_STOP": None, "FRAME_STRIDE": 1,
    "OUT_DIR": "./frames", "OUT_PREFIX": "frame", "OUT_EXT": "png", "ZFILL": 4,
    "MAKE_MOVIE": True, "FRAMERATE": 25, "MOVIE_NAME": "movie.mp4",
    "FIG_ROWS": 1, "FIG_COLS": 1, "FIGSIZE": (7.5, 6.0), "DPI": 200, "FONT_SIZE": 15, "SUPTITLE": None,
    "XLABEL": "x [km]", "YLABEL": "y [km]", "XLIM": None, "YLIM": None, "SUBPLOTS_ADJUST": {}, "RCPARAMS": {},
    "RHO_LEVELS": [], "RHO_COLORS": [], "RHO_STYLES": [], "RHO_LW": 1.3,
}


def load_movie_config(path: str | Path) -> dict[str, Any]:
    """Defaults overridden by the file; unknown keys only warn, a movie requires png frames."""
    raw = yaml.safe_load(Path(path).read_text()) or {}
    unknown = sorted(set(raw) - set(MOVIE_DEFAULTS))
    if unknown:
        warnings.warn(f"ignoring unknown settings: {', '.join(unknown)}", stacklevel=2)
    settings = {**MOVIE_DEFAULTS, **{k: v for k, v in raw.items() if k in MOVIE_DEFAULTS}}
    if settings["MAKE_MOVIE"] and settings["OUT_EXT"] != "png":
        raise ValueError(f"a movie needs png frames, not {settings['OUT_EXT']!r}")
    return settings


def write_movie_config(settings: dict[str, Any], path: str | Path) -> None:
    def plain(v: Any) -> Any:
        return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v

    Path(path).write_text(yaml.safe_dump({k: plain(v) for k, v in settings.items()}, sort_keys=False))
