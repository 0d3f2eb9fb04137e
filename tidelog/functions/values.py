"""Decoding of raw column values and of lenient settings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .classify import _col

# --- Fixed values: syslog codes ---------------------------------------------
SYSLOG_FACILITIES = {
    "LOG_USER": 1, "LOG_DAEMON": 3,
    "LOG_LOCAL0": 16, "LOG_LOCAL1": 17, "LOG_LOCAL2": 18, "LOG_LOCAL3": 19,
    "LOG_LOCAL4": 20, "LOG_LOCAL5": 21, "LOG_LOCAL6": 22, "LOG_LOCAL7": 23,
}
SYSLOG_PRIORITIES = {
    "LOG_EMERG": 0, "LOG_ALERT": 1, "LOG_CRIT": 2, "LOG_ERR": 3,
    "LOG_WARNING": 4, "LOG_NOTICE": 5, "LOG_INFO": 6, "LOG_DEBUG": 7,
}
DEFAULT_FACILITY = 16
DEFAULT_PRIORITY = 6

# --- Fixed values: spellings of a boolean setting ----------------------------
TRUE_WORDS = ["1", "true", "yes", "on"]
FALSE_WORDS = ["0", "false", "no", "off"]


def int24(c: Column | str) -> Column:
    """Signed value of a 24-bit integer held in a wider one."""
    v = _col(c).cast("int").bitwiseAND(F.lit(0xFFFFFF))
    return F.when(v >= 0x800000, v - 0x1000000).otherwise(v)


def as_unsigned(c: Column | str, bits: int) -> Column:
    """Unsigned reading of a signed 32-bit (BIGINT) or 64-bit (DECIMAL) value."""
    v = _col(c).cast("bigint")
    if bits == 32:
        return v.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    if bits == 64:
        wide = v.cast("decimal(20,0)")
        return F.when(v < 0, wide + F.lit(str(2**64)).cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")
    raise ValueError("bits must be 32 or 64")


def datetime2(packed: Column | str, fsp: int = 0) -> Column:
    """TIMESTAMP_NTZ from a packed DATETIME2 value.

    ``packed`` is the binary column as stored: five big-endian bytes, then
    ``(fsp + 1) / 2`` fraction bytes holding hundredths, ten-thousandths or
    microseconds.  The fraction is kept.  Impossible dates give null.
    """
    raw = _col(packed)
    head = F.conv(F.hex(F.substring(raw, 1, 5)), 16, 10).cast("bigint")
    body = head.bitwiseAND(F.lit(0x7FFFFFFFFF).cast("bigint"))
    months = F.shiftright(body, 22)
    year, month = F.floor(months / 13), months % 13
    day = F.shiftright(body, 17).bitwiseAND(F.lit(31))
    hour = F.shiftright(body, 12).bitwiseAND(F.lit(31))
    minute = F.shiftright(body, 6).bitwiseAND(F.lit(63))
    second = body.bitwiseAND(F.lit(63))
    text = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", year, month, day, hour, minute, second)
    stamp = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    width = (fsp + 1) // 2
    if width == 0:
        return stamp
    unit = 10 ** (6 - 2 * width)
    micros = F.conv(F.hex(F.substring(raw, 6, width)), 16, 10).cast("bigint") * unit
    return stamp + F.make_dt_interval(secs=(micros / 1000000).cast("decimal(18,6)"))


def timestamp2(seconds: Column | str, fraction: Column | str | None = None, fsp: int = 0) -> Column:
    """TIMESTAMP from epoch seconds and a fraction counted in its own unit."""
    micros = _col(seconds).cast("bigint") * 1000000
    width = (fsp + 1) // 2
    if fraction is not None and width:
        micros = micros + F.coalesce(_col(fraction).cast("bigint"), F.lit(0)) * 10 ** (6 - 2 * width)
    return F.timestamp_micros(micros)


def fixed6(c: Column | str) -> Column:
    """Float text with exactly six decimals."""
    return F.format_string("%.6f", _col(c).cast("double"))


def parse_bool(c: Column | str, default: bool = False) -> Column:
    """Lenient boolean: known words in any case, leading blanks skipped."""
    word = F.lower(F.regexp_replace(_col(c), r"^[ \t\n\r]+", ""))
    return (
        F.when(word.isin(TRUE_WORDS), True)
        .when(word.isin(FALSE_WORDS), False)
        .otherwise(F.lit(default))
    )


def parse_int(c: Column | str, default: int = 0) -> Column:
    """Lenient integer: leading digits, 0 when there are none, default for null."""
    text = _col(c)
    digits = F.regexp_extract(text, r"^\s*([-+]?\d+)", 1)
    return F.when(text.isNull(), F.lit(default)).otherwise(
        F.coalesce(digits.try_cast("int"), F.lit(0))
    )


def stream_id_time(c: Column | str) -> Column:
    """``HH:mm:ss`` of a ``millis-seq`` stream id."""
    millis = F.split_part(_col(c), F.lit("-"), F.lit(1)).try_cast("bigint")
    return F.coalesce(F.date_format(F.timestamp_millis(millis), "HH:mm:ss"), F.lit("??:??:??"))


def _lookup(c: Column, table: dict[str, int], default: int) -> Column:
    result = None
    for name, code in table.items():
        result = F.when(c == name, code) if result is None else result.when(c == name, code)
    return result.otherwise(F.lit(default))


def syslog_pri(facility: Column | str, priority: Column | str) -> Column:
    """Syslog PRI number; unknown or missing names fall back to LOCAL0 / INFO."""
    return (
        _lookup(_col(facility), SYSLOG_FACILITIES, DEFAULT_FACILITY) * 8
        + _lookup(_col(priority), SYSLOG_PRIORITIES, DEFAULT_PRIORITY)
    )
