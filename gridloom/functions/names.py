"""Names, tags and paths as Column expressions."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.constants import OPENPMD_EXTENSIONS
from gridloom.functions.formats import formatted

# Fixed patterns: they describe the naming scheme of the simulation output.
PLANE_TAG = r"((xy|xz|yz)_([xyz])_(pos|neg)(\d{1,8})(?:p(\d{0,8}))?)"
MESH_NAME = r"^(.+)(_patch\d+_lev\d+|_lev\d+_patch\d+)$"
ITERATION = r"\.it(\d+)\."
LEVEL = r"_lev(\d+)"
SCALAR_COMPONENTS = ("scalar", "value", "0")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def basename(path: Column | str) -> Column:
    """Last path component, ignoring trailing slashes."""
    return F.regexp_extract(F.rtrim(_col(path), F.lit("/")), r"([^/]*)$", 1)


def file_token(name: Column | str) -> Column:
    """File-system safe token for a variable name: bad runs become one `_`, outer `_` dropped."""
    return F.trim(F.regexp_replace(_col(name), r"[^0-9A-Za-z._-]+", "_"), F.lit("_"))


def safe_name(text: Column | str) -> Column:
    """Like `file_token` but keeping outer underscores."""
    return F.regexp_replace(_col(text), r"[^A-Za-z0-9_.-]+", "_")


def zero_padded(number: Column | str, width: int) -> Column:
    return F.format_string(f"%0{int(width)}d", _col(number).cast("bigint"))


def variable_file(variable: Column | str, label: str, suffix: str = ".h5") -> Column:
    return F.concat(file_token(variable), F.lit(f"__{label}{suffix}"))


def part_file(path: Column | str, part: Column | str) -> Column:
    """`name.h5` -> `name.part0007.h5`; without a known suffix the part goes last."""
    stem = F.regexp_replace(_col(path), r"\.h5$", "")
    tail = F.when(_col(path).endswith(".h5"), F.lit(".h5")).otherwise(F.lit(""))
    return F.concat(stem, F.lit(".part"), zero_padded(part, 4), tail)


def truncated(text: Column | str, limit: int = 70) -> Column:
    """Shorten texts of `limit` characters or more to `limit - 3` plus an ellipsis."""
    t = _col(text)
    return F.when(F.length(t) < limit, t).otherwise(F.concat(F.substring(t, 1, limit - 3), F.lit("...")))


def any_glob(name: Column | str, globs: Iterable[str]) -> Column:
    """True when the name matches one of the shell patterns."""
    globs = list(globs)
    if not globs:
        return F.lit(False)
    rx = "|".join(_java_regex(g) for g in globs)
    return _col(name).rlike(f"^(?:{rx})$")


def _java_regex(glob: str) -> str:
    """Shell pattern to a regex both Python and Java read the same way."""
    out = []
    for token in re.findall(r"\[!?\]?[^\]]*\]|.", glob, flags=re.S):
        if token == "*":
            out.append("[\\s\\S]*")
        elif token == "?":
            out.append("[\\s\\S]")
        elif len(token) > 2 and token[0] == "[":
            body = token[1:-1].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out.append("[" + ("^" + body[1:] if body.startswith("!") else body) + "]")
        else:
            out.append(re.escape(token))
    return "".join(out)


def matches_glob(name: str, globs: Iterable[str]) -> bool:
    """The same test on a plain string, for use inside tasks."""
    return any(fnmatch.fnmatchcase(name, g) for g in globs)


def iteration_number(path: Column | str) -> Column:
    """Iteration in `name.it00012345.bp5`; 0 when the name has none."""
    digits = _or_null(F.regexp_extract(basename(path), ITERATION, 1))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def level_in_name(name: Column | str) -> Column:
    digits = _or_null(F.regexp_extract(_col(name), LEVEL, 1))
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def is_series_name(path: Column | str) -> Column:
    """Name of an openPMD series: known extension, not metadata, not a `.dir`."""
    b = basename(path)
    return (
        b.rlike(r"\.(" + "|".join(OPENPMD_EXTENSIONS) + r")$") & ~b.contains(".md.") & ~b.endswith(".dir")
    )


def is_iteration_series(path: Column | str) -> Column:
    """Series name that also carries an `.it` part, as directory discovery requires."""
    return is_series_name(path) & basename(path).rlike(
        r"^.*\.it.*\.(" + "|".join(OPENPMD_EXTENSIONS) + r")$"
    )


def _let(value: Column, use) -> Column:
    """Bind a value once inside a larger expression."""
    return F.transform(F.array(value), use)[0]


def plane_tag(text: Column | str) -> Column:
    """Struct of the plane tag found in the basename or else the whole text; NULL if none.

    Fields: tag, plane, normal_axis, sign, int_digits, frac_digits, elevation, start, end.
    One pattern match finds the tag; its parts sit at fixed places inside it.
    """
    full = _col(text)

    def tag_in(src: Column) -> Column:
        return F.struct(F.regexp_extract(src, PLANE_TAG, 1).alias("tag"), src.alias("src"))

    def parts(found: Column) -> Column:
        tag = found["tag"]
        digits = F.split(F.substring(tag, 9, 40), "p")
        frac = F.coalesce(F.get(digits, F.lit(1)), F.lit(""))
        size = digits[0].cast("double") + F.coalesce(
            _or_null(frac).cast("double") / F.pow(F.lit(10.0), F.length(frac)), F.lit(0.0)
        )
        start = F.instr(found["src"], tag) - 1
        return F.when(
            tag != "",
            F.struct(
                tag.alias("tag"),
                F.substring(tag, 1, 2).alias("plane"),
                F.substring(tag, 4, 1).alias("normal_axis"),
                F.substring(tag, 6, 3).alias("sign"),
                digits[0].alias("int_digits"),
                frac.alias("frac_digits"),
                F.when(F.substring(tag, 6, 3) == "neg", -size).otherwise(size).alias("elevation"),
                start.alias("start"),
                (start + F.length(tag)).alias("end"),
            ),
        )

    return _let(
        tag_in(basename_exact(full)),
        lambda base: _let(F.when(base["tag"] != "", base).otherwise(tag_in(full)), parts),
    )


def basename_exact(text: Column | str) -> Column:
    """Text after the last slash; empty when the text ends in one."""
    return F.substring_index(_col(text), "/", -1)


def mesh_name(name: Column | str) -> Column:
    """Struct(group, centering, level, patch, plane) of an AMR mesh name; NULL if it is none."""

    def split_up(m: Column) -> Column:
        prefix, plane, suffix = m["prefix"], m["plane"], m["suffix"]
        rest = F.regexp_replace(F.substr(prefix, plane["end"] + 1), r"^_", "")
        return F.struct(
            F.when(plane["start"] == 0, rest).otherwise(prefix).alias("group"),
            plane.alias("plane"), suffix.alias("suffix"),
        )

    def finish(m: Column) -> Column:
        group, suffix = m["group"], m["suffix"]
        centering = F.when(group.endswith("_cv"), "cv").when(group.endswith("_vc"), "vc")
        return F.when(
            suffix != "",
            F.struct(
                F.when(centering.isNotNull(), F.substr(group, F.lit(1), F.length(group) - 3))
                .otherwise(group)
                .alias("group"),
                centering.alias("centering"),
                _or_null(F.regexp_extract(suffix, r"_lev(\d+)", 1)).cast("int").alias("level"),
                _or_null(F.regexp_extract(suffix, r"_patch(\d+)", 1)).cast("int").alias("patch"),
                m["plane"].alias("plane"),
            ),
        )

    c = _col(name)
    prefix = F.regexp_extract(c, MESH_NAME, 1)

    def with_plane(p: Column) -> Column:
        return F.struct(p.alias("prefix"), plane_tag(p).alias("plane"), F.substr(c, F.length(p) + 1).alias("suffix"))

    named = F.when(prefix != "", prefix)
    return _let(named, lambda p: F.when(p.isNotNull(), _let(_let(with_plane(p), split_up), finish)))


def with_mesh(df: DataFrame, name: str = "mesh_name", out: str = "_m", keep_unparsed: bool = False) -> DataFrame:
    """Add the parsed mesh name as a struct column, by default dropping rows without one.

    Going through explode evaluates the parse once per row however many of its
    fields are used later.
    """
    parsed = F.array_compact(F.array(mesh_name(name)))
    return df.select("*", (F.explode_outer if keep_unparsed else F.explode)(parsed).alias(out))


def component_label(component: Column | str, group: Column | str) -> Column:
    """Variable label: the component unless it is a scalar placeholder, else the group."""
    comp, grp = _col(component), F.coalesce(_col(group), F.lit(""))
    named = (comp != "") & ~F.lower(comp).isin(*SCALAR_COMPONENTS)
    return F.when(named, comp).when(grp != "", grp).otherwise(comp)


def matches_variable(
    pattern: str | None, name: Column | str, component: Column | str, mesh: Column | str | None = None
) -> Column:
    """Case-insensitive substring test over mesh name, component, group and plane tag parts."""
    if not pattern:
        return F.lit(True)
    needle = F.lit(pattern.lower())
    fields = [_col(name), _col(component)]
    if mesh is not None:
        m = _col(mesh)
        fields += [m["group"], m["plane"]["tag"], m["plane"]["plane"], m["plane"]["normal_axis"]]
    hit = F.lit(False)
    for f in fields:
        hit = hit | F.contains(F.lower(F.coalesce(f, F.lit(""))), needle)
    return hit


def is_close(a: Column, b: float, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    return F.abs(a - F.lit(float(b))) <= F.lit(atol + rtol * abs(float(b)))


def plane_matches(
    path: Column | str,
    *,
    tag: str | None = None,
    plane: str | None = None,
    normal_axis: str | None = None,
    elevation: float | None = None,
) -> Column:
    """Conjunction of the given plane filters on a path; paths without a tag fail any filter."""
    if all(v is None for v in (tag, plane, normal_axis, elevation)):
        return F.lit(True)
    info = plane_tag(basename(path))
    keep = info.isNotNull()
    for field, wanted in (("tag", tag), ("plane", plane), ("normal_axis", normal_axis)):
        if wanted is not None:
            keep = keep & (info[field] == wanted)
    if elevation is not None:
        keep = keep & is_close(info["elevation"], elevation)
    return F.coalesce(keep, F.lit(False))


# The placeholders of titles, and which of them are whole numbers.
_TITLE = re.compile(r"\{(t|t_raw|it|idx)(?::([^{}]*))?\}")
_WHOLE = ("it", "idx")


def title(template: str, **values: Column | str) -> Column:
    """Fill {t} {t_raw} {it} {idx}, optionally with a format specification such as `:>8,.2f` (see `formats`); other braces stay."""
    parts: list[Column] = []
    at = 0
    for m in _TITLE.finditer(template):
        parts.append(F.lit(template[at : m.start()]))
        parts.append(formatted(_col(values[m.group(1)]), m.group(2) or "", integer=m.group(1) in _WHOLE))
        at = m.end()
    parts.append(F.lit(template[at:]))
    return F.concat(*parts)
