"""Python's format specifications for numbers, compiled to column expressions.

[[fill]align][sign][0][width][, or _][.precision][type], with the types f, F, %, d, b, o, x, X and none. Fixed-point digits are
rounded as the exact binary value, ties to even, as in Python; places that a double no longer tells apart (values times 10 to
the places beyond 2^53) are filled with zeros, as are whole digits from 2^63 on. Other types, and zero padding of grouped digits, are errors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPEC = re.compile(r"(?:(?P<fill>.)?(?P<align>[<>=^]))?(?P<sign>[-+ ])?(?P<zero>0)?(?P<width>\d+)?(?P<group>[,_])?(?:\.(?P<precision>\d+))?(?P<type>[a-zA-Z%])?")
_INTEGER_TYPES = {"d", "b", "o", "x", "X"}
_FIXED_TYPES = {"f", "F", "%"}
#: Fixed-point digits come from a decimal of 18 places.
MAX_PRECISION = 17
_SPLIT = float((1 << 27) + 1)
_EXACT = float(1 << 53)


@dataclass(frozen=True)
class Spec:
    fill: str
    align: str
    sign: str
    width: int
    group: str
    precision: int | None
    kind: str

    @classmethod
    def of(cls, text: str) -> "Spec":
        m = _SPEC.fullmatch(text)
        if not m:
            raise ValueError(f"format specification {text!r} is not understood")
        align, zero = m["align"], bool(m["zero"])
        fill = m["fill"] or ("0" if zero else " ")
        spec = cls(fill, align or ("=" if zero else ">"), m["sign"] or "-", int(m["width"] or 0), m["group"] or "",
                   None if m["precision"] is None else int(m["precision"]), m["type"] or "")
        if spec.kind not in {"", *_INTEGER_TYPES, *_FIXED_TYPES}:
            raise ValueError(f"format type {spec.kind!r} is not supported")
        if spec.group and spec.align == "=" and spec.fill == "0" and spec.width:
            raise ValueError("zero padding of grouped digits is not supported")
        if spec.precision is not None and (spec.kind not in _FIXED_TYPES or spec.precision > MAX_PRECISION):
            raise ValueError(f"a precision up to {MAX_PRECISION} goes with the types f and %")
        if spec.group == "," and spec.kind in {"b", "o", "x", "X"}:
            raise ValueError("a comma goes with decimal digits only")
        return spec


def formatted(value: Column, spec: str, *, integer: bool) -> Column:
    """format(value, spec) of an integer or of a double; NULL stays NULL."""
    s = Spec.of(spec)
    if s.kind in _INTEGER_TYPES and not integer:
        raise ValueError(f"format type {s.kind!r} needs an integer")
    if integer and s.kind not in _FIXED_TYPES:
        number = value.cast("bigint")
        negative = number < 0
        body = _grouped(_integer_digits(number, s.kind), F.lit(""), s.group, 3 if s.kind in ("", "d") else 4)
        return _aligned(_sign(negative, s), body, s)

    def of_double(number: Column) -> Column:
        finite = ~F.isnan(number) & (F.abs(number) < float("inf"))
        digits = repr_digits(F.abs(number)) if s.kind == "" else fixed_digits(F.abs(number), 6 if s.precision is None else s.precision)
        body = _bound(digits, lambda d: _grouped(F.regexp_extract(d, r"^\d+", 0), F.regexp_extract(d, r"^\d+(.*)$", 1), s.group, 3))
        name = F.when(F.isnan(number), "nan").otherwise("inf")
        body = F.when(finite, body).otherwise(F.upper(name) if s.kind == "F" else name)
        # The text tells the sign of zero too.
        negative = ~F.isnan(number) & number.cast("string").startswith("-")
        return _bound(F.concat(body, F.lit("%")) if s.kind == "%" else body, lambda b: _aligned(_sign(negative, s), b, s))

    number = value.cast("double")
    return F.when(value.isNotNull(), _bound(number * 100 if s.kind == "%" else number, of_double))


def _bound(value: Column, use) -> Column:
    """use(value), the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sign(negative: Column, s: Spec) -> Column:
    return F.when(negative, "-").otherwise("" if s.sign == "-" else s.sign)


def _integer_digits(n: Column, kind: str) -> Column:
    # The least bigint has no positive counterpart; its decimal text has.
    size = F.abs(n.cast("decimal(20,0)"))
    if kind in ("", "d"):
        return size.cast("string")
    base = {"b": 2, "o": 8, "x": 16, "X": 16}[kind]
    digits = F.conv(size.cast("string"), 10, base)
    return F.lower(digits) if kind == "x" else digits


def _grouped(whole: Column, rest: Column, group: str, every: int) -> Column:
    if group:
        whole = F.regexp_replace(whole, rf"(?<=\w)(?=(\w{{{every}}})+$)", group)
    return F.concat(whole, rest)


def _aligned(sign: Column, body: Column, s: Spec) -> Column:
    text = F.concat(sign, body)
    if not s.width:
        return text
    room = F.greatest(F.lit(s.width) - F.char_length(text), F.lit(0))
    fill = lambda n: F.repeat(F.lit(s.fill), n.cast("int"))
    if s.align == "<":
        return F.concat(text, fill(room))
    if s.align == "=":
        return F.concat(sign, fill(room), body)
    if s.align == "^":
        left = F.floor(room / 2)
        return F.concat(fill(left), text, fill(room - left))
    return F.concat(fill(room), text)


def fixed_digits(v: Column, places: int) -> Column:
    """Digits of a double >= 0 with `places` decimals, rounded as its exact binary value, ties to even.

    The shortest decimal text of a double rounds the same way unless it ends in a 5 right behind the last place. Only
    then the exact value decides: its distance from the tie comes from a product without rounding error.
    """
    power = 10**places

    def rounded(v: Column) -> Column:
        whole = F.floor(v).cast("bigint")
        part = (v.cast("decimal(38,18)") - whole.cast("decimal(20,0)")).cast("decimal(18,18)") * F.lit(Decimal(power)).cast("decimal(18,0)")
        return _bound(F.struct(v.alias("v"), whole.alias("whole"), F.floor(part).cast("bigint").alias("count"), (part - F.floor(part)).alias("rest")), text)

    def text(b: Column) -> Column:
        count = b["count"] + F.when(b["rest"] == F.lit(Decimal("0.5")), goes_up(b)).otherwise(b["rest"] > F.lit(Decimal("0.5"))).cast("bigint")
        carry = F.when(count >= power, 1).otherwise(0)
        places_text = F.concat(F.lit("."), F.lpad((count - carry * power).cast("string"), places, "0")) if places else F.lit("")
        return F.concat((b["whole"] + carry).cast("string"), places_text)

    def goes_up(b: Column) -> Column:
        """Of a value whose shortest text is a tie: whether it lies above it, or on it and the last place is odd."""
        v, scale = b["v"], float(10 * power)
        kept = b["whole"].cast("decimal(18,0)") * F.lit(Decimal(power)).cast("decimal(18,0)") + b["count"]
        tie = kept * 10 + 5
        # v * scale as the sum of two doubles, without rounding error.
        c = _SPLIT * scale
        high = c - (c - scale)
        low = scale - high
        vh = v * _SPLIT - (v * _SPLIT - v)
        product = v * scale
        lost = ((vh * high - product) + vh * low + (v - vh) * high) + (v - vh) * low
        gap = F.when(product < _EXACT, product - tie.cast("double")).otherwise((product.try_cast("bigint") - tie.try_cast("bigint")).cast("double"))
        return F.when(gap + lost == 0, kept % 2 == 1).otherwise(gap + lost > 0)

    large = F.concat(v.try_cast("bigint").cast("string"), F.lit("." + "0" * places if places else ""))
    return F.when(v < _EXACT, _bound(v, rounded)).otherwise(F.coalesce(large, F.format_string(f"%.{places}f", v)))


def repr_digits(v: Column) -> Column:
    """The text of a double >= 0 as Python writes it, exponents below -4 and from 16 on; the digits are those the JVM finds."""
    zeros = lambda n: F.repeat(F.lit("0"), F.greatest(n, F.lit(0)).cast("int"))

    def split(text: Column) -> Column:
        mantissa = F.split_part(text, F.lit("E"), F.lit(1))
        shift = F.coalesce(F.nullif(F.split_part(text, F.lit("E"), F.lit(2)), F.lit("")).cast("int"), F.lit(0))
        raw = F.regexp_replace(mantissa, r"\.", "")
        digits = F.regexp_replace(raw, "^0+|0+$", "")
        point = F.char_length(F.split_part(mantissa, F.lit("."), F.lit(1))) + shift - F.char_length(F.regexp_extract(raw, "^0*", 0))
        zero = digits == ""
        return _bound(F.struct(F.when(zero, "0").otherwise(digits).alias("digits"), F.when(zero, 1).otherwise(point).alias("point")), written)

    def written(b: Column) -> Column:
        digits, point, size, power = b["digits"], b["point"], F.char_length(b["digits"]), b["point"] - 1
        fixed = (
            F.when(point <= 0, F.concat(F.lit("0."), zeros(-point), digits))
            .when(point >= size, F.concat(digits, zeros(point - size), F.lit(".0")))
            .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, size)))
        )
        tail = F.when(size > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), size))).otherwise("")
        exponent = F.abs(power).cast("string")
        padded = F.lpad(exponent, F.greatest(F.lit(2), F.char_length(exponent)), F.lit("0"))
        science = F.concat(F.substring(digits, F.lit(1), F.lit(1)), tail, F.lit("e"), F.when(power < 0, "-").otherwise("+"), padded)
        return F.when((power >= -4) & (power < 16), fixed).otherwise(science)

    return _bound(v.cast("string"), split)
