"""Resource quantities as Column expressions.

A memory quantity is stored as a positive ``decimal(38,0)`` of bytes, a CPU
quantity as a positive ``bigint`` of milli-cores. Parsers return a struct
``<value, reason: string>``: ``value`` is null exactly when ``reason`` names
why the text was rejected. No Python UDF is involved; every function
compiles to built-in expressions inside whole-stage codegen.

Rejection reasons:
  ``type``          the input is null (not text)
  ``pattern``       the text does not follow the grammar
  ``range``         the value does not fit the stored type
  ``not_positive``  the value truncates to zero or less

Arithmetic follows the contract exactly: decimal text is converted to a
double and multiplied in binary floating point, then truncated (so ``1.005``
cores is 1004 milli-cores); integer paths are exact and overflow-checked.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's): unit names and multipliers.
# Cluster (Kubernetes) memory units, powers of two then powers of ten:
K8S_UNITS: dict[str, int] = {
    "Ei": 2 ** 60, "Pi": 2 ** 50, "Ti": 2 ** 40, "Gi": 2 ** 30, "Mi": 2 ** 20, "Ki": 2 ** 10,
    "E": 10 ** 18, "P": 10 ** 15, "T": 10 ** 12, "G": 10 ** 9, "M": 10 ** 6, "k": 10 ** 3,
}
# JVM memory units, powers of two:
JVM_UNITS: dict[str, int] = {"t": 2 ** 40, "g": 2 ** 30, "m": 2 ** 20, "k": 2 ** 10}
# Number text: digits with an optional point, at least one digit.
NUMBER = r"(\d+\.?\d*|\d*\.?\d+)"
# ---------------------------------------------------------------------------

# Anchors: ``^`` start, then an optional final newline before the true end,
# which is what an anchored Python pattern ending in ``$`` accepts. Digits are
# ASCII only (Java's ``\d``).
_END = r"\n?\z"
K8S_MEMORY_PATTERN = rf"^{NUMBER}({'|'.join(K8S_UNITS)})?{_END}"
JVM_MEMORY_PATTERN = rf"^(\d+)({'|'.join(JVM_UNITS)})?{_END}"
K8S_CPU_PATTERN = rf"^{NUMBER}(m?){_END}"
# Integer text as Python's int() reads it: outer blanks, a sign, and single
# underscores between digits. Possessive quantifiers: no backtracking.
JVM_CPU_PATTERN = r"^\s*+([+-]?+\d++(?:_\d++)*+)\s*+\z"

TWO_63 = 9.223372036854775807e18  # 2**63 as a double; anything below fits bigint
WIDE, WIDE_LIMIT = "decimal(38,0)", 1e38  # stored memory
TWO_63_EXACT = Decimal(2 ** 63)
_INTEGERS = ("tinyint", "smallint", "int", "bigint")

TYPE, PATTERN, RANGE, NOT_POSITIVE = "type", "pattern", "range", "not_positive"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _number(text: Column, kind: str) -> Column:
    """Cast matched number text; no match ('') becomes null without a cast
    attempt (a failed ``try_cast`` costs microseconds per row)."""
    return F.nullif(text, F.lit("")).try_cast(kind)


def _unit_map(table: dict[str, int], cast: str) -> Column:
    """Literal map unit -> multiplier (no unit = 1); one lookup per row."""
    pairs = [F.lit(""), F.lit(1).cast(cast)]
    for k, v in table.items():
        pairs += [F.lit(k), F.lit(v).cast(cast)]
    return F.create_map(*pairs)


class Parse:
    """A parse in two stages: named intermediate columns, then ``value`` and
    ``reason`` computed from them. Table operators materialise the
    intermediates in their own projection so each regex runs once per row;
    the Column-level functions inline them."""

    def __init__(self, parts: dict[str, Column], finish, derived=None):
        # ``derived``: name -> function of ``ref`` built on earlier parts
        self._base = parts
        self._derived = derived or {}
        self._finish = finish
        self.parts = dict(parts)
        for name, fn in self._derived.items():
            self.parts[name] = fn(lambda n: self.parts[n])

    def stages(self) -> list[dict[str, Column]]:
        """Projections to materialise in order, referring to earlier ones by
        ``ref`` names (see :meth:`staged`)."""
        return [self._base] + [{n: fn} for n, fn in self._derived.items()]

    def finish(self, ref) -> tuple[Column, Column]:
        return self._finish(ref)

    def inline(self) -> Column:
        value, reason = self.finish(lambda name: self.parts[name])
        return F.struct(value.alias("value"), reason.alias("reason"))


def _double_checks(ref) -> tuple[Column, Column]:
    """raw: a double, null when the text did not match.

    Each intermediate is referenced once, so an optimizer that inlines the
    parse into a pushed-down filter still runs each pattern once per row.
    """
    # 2**63 and above become null first: a cast to bigint would saturate
    below = F.nullif(F.least(ref("raw"), F.lit(TWO_63)), F.lit(TWO_63))
    value = F.nullif(F.greatest(below.try_cast("bigint"), F.lit(0).cast("bigint")), F.lit(0))
    # 0: below 1 (truncates to <= 0), 1: fits, 2: 2**63 or more, 3: no match
    bucket = F.coalesce(F.width_bucket(ref("raw"), F.lit(1.0), F.lit(TWO_63), F.lit(1)).cast("int"), F.lit(3))
    verdict = F.element_at(F.array(F.lit(NOT_POSITIVE), F.lit(""), F.lit(RANGE), F.lit(PATTERN)), bucket + 1)
    reason = F.when(ref("text").isNull(), F.lit(TYPE)).otherwise(F.nullif(verdict, F.lit("")))
    return value, reason


def _exact_checks(ref) -> tuple[Column, Column]:
    """raw: an exact bigint, null when the text did not match or overflowed;
    digits: the matched number text ('' when the text did not match)."""
    value = F.nullif(F.greatest(ref("raw"), F.lit(0).cast("bigint")), F.lit(0))
    # signum -1/0 -> 1 (not positive), 1 -> 2 (fits); null (overflow) -> 3
    sign = F.coalesce(F.floor((F.signum(ref("raw")) + F.lit(3)) / F.lit(2)).cast("int"), F.lit(3))
    verdict = F.element_at(F.array(F.lit(NOT_POSITIVE), F.lit(""), F.lit(RANGE)), sign)
    reason = (F.when(ref("text").isNull(), F.lit(TYPE))
              .when(ref("digits") == "", F.lit(PATTERN))
              .otherwise(F.nullif(verdict, F.lit(""))))
    return value, reason


def _wide(d: Column) -> Column:
    """The whole part of a double in [0, 1e38), exactly: a plain cast to
    decimal rounds above 2**53, so larger ones are put together from three
    pieces of at most 53 bits."""
    top = F.floor(d / F.lit(2.0 ** 64))
    rest = d - top.cast("double") * F.lit(2.0 ** 64)
    middle = F.floor(rest / F.lit(2.0 ** 32))
    low = F.floor(rest - middle.cast("double") * F.lit(2.0 ** 32))
    big = (top.cast("decimal(19,0)") * F.lit(Decimal(2 ** 64)) + middle.cast("decimal(19,0)") * F.lit(Decimal(2 ** 32))
           + low.cast("decimal(19,0)"))
    return F.when(d < TWO_63, d.try_cast("bigint").cast(WIDE)).otherwise(big.cast(WIDE))


def _truncated(d: Column) -> Column:
    """A double as a stored amount: 0 below 1, null from 1e38 on (and for NaN)."""
    return F.when(d < 1, F.lit(0).cast(WIDE)).when(d < WIDE_LIMIT, _wide(d))


def _times(a: Column, b: Column) -> Column:
    """Exact product of two whole numbers; null where it does not fit."""
    return F.try_multiply(a, b).try_cast(WIDE)


def _wide_checks(ref) -> tuple[Column, Column]:
    """raw: the amount as ``decimal(38,0)``, null if too large; digits: '' when the text did not match."""
    value = F.when(ref("raw") > 0, ref("raw"))
    reason = (F.when(ref("text").isNull(), TYPE).when(ref("digits") == "", PATTERN)
              .when(ref("raw").isNull(), RANGE).when(ref("raw") <= 0, NOT_POSITIVE))
    return value, reason


def _unit_text(text: Column, digits: Column) -> Column:
    """What follows the number of a text that matched."""
    return F.replace(F.substring(text, F.length(digits) + 1, F.length(text)), F.lit("\n"), F.lit(""))


def memory_k8s_parse(text: Column | str) -> Parse:
    s = _col(text)
    return Parse({"text": s, "digits": F.regexp_extract(s, K8S_MEMORY_PATTERN, 1)}, _wide_checks, {
        "double": lambda ref: _number(ref("digits"), "double") * F.try_element_at(
            _unit_map(K8S_UNITS, "double"), _unit_text(ref("text"), ref("digits"))),
        "raw": lambda ref: _truncated(ref("double"))})


def memory_jvm_parse(text: Column | str) -> Parse:
    """Numbers of up to 18 digits whose product fits 64 bits are multiplied as such; the bound is tested first, because a
    failing cast or product costs an exception."""
    s = _col(text)
    mult = lambda ref: F.try_element_at(_unit_map(JVM_UNITS, "bigint"), _unit_text(ref("text"), ref("digits")))
    return Parse({"text": s, "digits": F.regexp_extract(s, JVM_MEMORY_PATTERN, 1)}, _wide_checks, {
        "mult": mult,
        "small": lambda ref: F.when(F.length(ref("digits")).between(1, 18), ref("digits").try_cast("bigint")),
        "raw": lambda ref: F.when(ref("small") <= F.call_function("div", F.lit(2 ** 63 - 1), ref("mult")),
                                  (ref("small") * ref("mult")).cast(WIDE)).otherwise(
            _times(_number(ref("digits"), WIDE), ref("mult").cast("decimal(19,0)")))})


def cpu_k8s_parse(text: Column | str) -> Parse:
    s = _col(text)
    scale = F.when(F.rtrim(s, F.lit("\n")).endswith("m"), F.lit(1.0)).otherwise(F.lit(1000.0))
    return Parse({"text": s, "raw": _number(F.regexp_extract(s, K8S_CPU_PATTERN, 1), "double") * scale}, _double_checks)


def cpu_jvm_parse(text: Column | str) -> Parse:
    s = _col(text)
    digits = F.replace(F.regexp_extract(s, JVM_CPU_PATTERN, 1), F.lit("_"), F.lit(""))

    def raw(ref):
        # up to 15 digits always fit, and more than 19 never do once leading zeros are gone: a failing cast or
        # product costs an exception, so only what lies between is tried
        plain = F.regexp_replace(ref("digits"), r"^([+-]?)0+(?=[0-9])", "$1")
        large = F.when(F.length(plain) <= 20, F.try_multiply(_number(plain, "bigint"), F.lit(1000).cast("bigint")))
        return F.when(F.length(ref("digits")).between(1, 15), ref("digits").try_cast("bigint") * F.lit(1000).cast("bigint")).when(
            F.length(ref("digits")) > 15, large)
    return Parse({"text": s, "digits": digits}, _exact_checks, {"raw": raw})


def _is_integer(v: Column, integral: bool | None) -> Column:
    """Whether a column counts as whole numbers: as told, else by its type (known before any row is read)."""
    return F.typeof(v).isin(*_INTEGERS) if integral is None else F.lit(integral)


def memory_number_parse(value: Column | str, mult: int, integral: bool | None = None) -> Parse:
    """``int(value * mult)`` bytes: exact for whole numbers, through a double otherwise."""
    v = _col(value)
    raw = F.when(_is_integer(v, integral), _times(v.try_cast("decimal(20,0)"), F.lit(Decimal(mult)))).otherwise(
        _truncated(v.try_cast("double") * F.lit(float(mult))))
    return Parse({"text": v, "digits": F.lit("x"), "raw": raw}, _wide_checks)


def number_parse(value: Column | str, mult: int, integral: bool | None = None) -> Parse:
    """``int(value * mult)`` milli-cores: exact for whole numbers, through a double otherwise."""
    v = _col(value)
    d = v.try_cast("double") * F.lit(float(mult))
    raw = F.when(_is_integer(v, integral), F.try_multiply(v.try_cast("bigint"), F.lit(mult).cast("bigint"))).otherwise(
        F.when(d < 1, F.lit(0).cast("bigint")).when(d < TWO_63, d.try_cast("bigint")))
    return Parse({"text": v, "digits": F.lit("x"), "raw": raw}, _wide_checks)


def memory_k8s(text: Column | str) -> Column:
    """Cluster memory text (``100Mi``, ``1.5Gi``, ``512``) -> struct<value bytes, reason>."""
    return memory_k8s_parse(text).inline()


def memory_jvm(text: Column | str) -> Column:
    """JVM memory text (``100m``, ``2g``, ``1t``; no unit = bytes) -> bytes, exact."""
    return memory_jvm_parse(text).inline()


def cpu_k8s(text: Column | str) -> Column:
    """Cluster CPU text (``1.5``, ``1500m``) -> milli-cores."""
    return cpu_k8s_parse(text).inline()


def cpu_jvm(text: Column | str) -> Column:
    """JVM core count as integer text (``2``, `` +2 ``, ``1_0``) -> milli-cores."""
    return cpu_jvm_parse(text).inline()


def _value(p: Parse) -> Column:
    return p.finish(lambda name: p.parts[name])[0]


def parse_memory_k8s(text: Column | str) -> Column:
    return _value(memory_k8s_parse(text))


def parse_memory_jvm(text: Column | str) -> Column:
    return _value(memory_jvm_parse(text))


def parse_cpu_k8s(text: Column | str) -> Column:
    return _value(cpu_k8s_parse(text))


def parse_cpu_jvm(text: Column | str) -> Column:
    return _value(cpu_jvm_parse(text))


# --- formatters ------------------------------------------------------------

def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def _whole(size: Column | str, unit: int) -> Column:
    """Whole units of an amount of bytes as text."""
    v = _col(size).cast(WIDE)
    step = F.lit(Decimal(unit))
    return F.when(v < TWO_63_EXACT, _div(v.cast("bigint"), unit).cast("string")).otherwise(
        F.try_divide(v - v % step, step).try_cast(WIDE).cast("string"))


def format_memory_k8s(size: Column | str, unit: str | None = "Mi") -> Column:
    """Bytes -> cluster text, floored to whole units; ``None`` = plain bytes."""
    if unit is None:
        return _col(size).cast(WIDE).cast("string")
    if unit not in K8S_UNITS:
        raise TypeError(f"{unit!r} is not a cluster memory unit")
    return F.concat(_whole(size, K8S_UNITS[unit]), F.lit(unit))


def format_memory_jvm(size: Column | str, unit: str = "m") -> Column:
    """Bytes -> JVM text, floored to whole units."""
    if unit is None:
        raise ValueError("a JVM memory unit is required")
    if unit not in JVM_UNITS:
        raise ValueError(f"{unit!r} is not a JVM memory unit")
    return F.concat(_whole(size, JVM_UNITS[unit]), F.lit(unit))


def format_cpu_k8s(m_cores: Column | str) -> Column:
    """Milli-cores -> ``<n>m``."""
    return F.concat(_col(m_cores).cast("bigint").cast("string"), F.lit("m"))


def format_cpu_jvm(m_cores: Column | str) -> Column:
    """Milli-cores -> whole cores, floored."""
    return _div(_col(m_cores).cast("bigint"), 1000).cast("string")


# --- conversions and arithmetic ----------------------------------------------

def _unit_multiplier(unit: str | None) -> int:
    if unit is None:
        return 1
    if unit in K8S_UNITS:
        return K8S_UNITS[unit]
    if unit in JVM_UNITS:
        return JVM_UNITS[unit]
    raise TypeError(f"{unit!r} is not a memory unit")


def to_bytes_checked(amount: Column | str, unit: str | None = None, integral: bool | None = None) -> Column:
    """``amount`` of ``unit`` -> bytes (``int(amount * multiplier)``);
    whole-number columns exactly, others through a double."""
    return memory_number_parse(amount, _unit_multiplier(unit), integral).inline()


def to_bytes(amount: Column | str, unit: str | None = None, integral: bool | None = None) -> Column:
    return _value(memory_number_parse(amount, _unit_multiplier(unit), integral))


def to_m_cores_checked(cores: Column | str, integral: bool | None = None) -> Column:
    """Cores -> milli-cores (``int(cores * 1000)``)."""
    return number_parse(cores, 1000, integral).inline()


def to_m_cores(cores: Column | str, integral: bool | None = None) -> Column:
    return _value(number_parse(cores, 1000, integral))


def _factor(factor: Column | int | float) -> Column:
    if isinstance(factor, bool) or not isinstance(factor, (Column, int, float)):
        raise TypeError("a quantity can only be scaled by a number")
    if isinstance(factor, Column):
        return factor
    return F.lit(factor) if abs(factor) < 2 ** 63 or isinstance(factor, float) else F.lit(Decimal(factor))


def _both(size: Column, factor: Column) -> Column:
    """Not null where both are given."""
    return F.when(size.isNotNull() & factor.isNotNull(), F.lit("x"))


def scale_memory_parse(size: Column | str, factor: Column | int | float, integral: bool | None = None) -> Parse:
    b, f = _col(size), _factor(factor)
    whole = F.lit(True) if isinstance(factor, int) and integral is None else _is_integer(f, integral)
    raw = F.when(whole, _times(b.cast(WIDE), f.try_cast("decimal(20,0)"))).otherwise(
        _truncated(b.cast("double") * f.cast("double")))
    return Parse({"text": _both(b, f), "digits": F.lit("x"), "raw": raw}, _wide_checks)


def scale_cpu_parse(m_cores: Column | str, factor: Column | int | float, integral: bool | None = None) -> Parse:
    b, f = _col(m_cores).cast("bigint"), _factor(factor)
    whole = F.lit(True) if isinstance(factor, int) and integral is None else _is_integer(f, integral)
    d = ((b.cast("double") / F.lit(1000.0)) * f.cast("double")) * F.lit(1000.0)
    raw = F.when(whole, F.try_multiply(b, f.try_cast("bigint"))).otherwise(
        F.when(d < 1, F.lit(0).cast("bigint")).when(d < TWO_63, d.try_cast("bigint")))
    return Parse({"text": _both(b, f), "digits": F.lit("x"), "raw": raw}, _wide_checks)


def scale_memory_checked(size: Column | str, factor: Column | int | float,
                         integral: bool | None = None) -> Column:
    """Bytes x factor, truncated; a whole-number factor or column is exact."""
    return scale_memory_parse(size, factor, integral).inline()


def scale_memory(size: Column | str, factor: Column | int | float, integral: bool | None = None) -> Column:
    return _value(scale_memory_parse(size, factor, integral))


def scale_cpu_checked(m_cores: Column | str, factor: Column | int | float,
                      integral: bool | None = None) -> Column:
    """Milli-cores x factor. A float factor goes through cores:
    ``int(((m / 1000) * f) * 1000)`` in doubles; a whole-number factor or column is exact."""
    return scale_cpu_parse(m_cores, factor, integral).inline()


def scale_cpu(m_cores: Column | str, factor: Column | int | float, integral: bool | None = None) -> Column:
    return _value(scale_cpu_parse(m_cores, factor, integral))


PARSERS = {
    "memory_k8s": memory_k8s_parse,
    "memory_jvm": memory_jvm_parse,
    "cpu_k8s": cpu_k8s_parse,
    "cpu_jvm": cpu_jvm_parse,
}
