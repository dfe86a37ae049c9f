"""Column functions: names, times, ratios, JSON and text keys. All are built-in expressions, but for Unicode forms of texts beyond ASCII."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.arrow import nfkc, unaccented

#: Latin letters that have no decomposition, and their plain forms (fixed values).
UNDECOMPOSED = {"ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i"}


def name_key(c: Column) -> Column:
    """Lower-case match key: accents stripped, other runs than letters and digits become one space."""
    plain = unaccented(F.lower(c))
    for letter, other in UNDECOMPOSED.items():
        plain = F.replace(plain, F.lit(letter), F.lit(other))
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def compact_key(c: Column) -> Column:
    return F.replace(name_key(c), F.lit(" "), F.lit(""))


def full_match(c: Column, pattern: str) -> Column:
    return c.rlike(f"^(?:{pattern})$")


def issue_list(*issues: tuple[str, Column]) -> Column:
    """Comma-joined names of the conditions that hold; null if none does."""
    return F.nullif(F.concat_ws(",", *(F.when(cond, F.lit(name)) for name, cond in issues)), F.lit(""))


def worked_out(df: DataFrame) -> DataFrame:
    """df whose columns are worked out once a row, however often they are read: what filters and selects above them say is not merged into them."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")


def revision(*cols: Column) -> Column:
    """md5 over the columns as text, null as an empty string."""
    return F.md5(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in cols)))


def floor_epoch(ts: Column, seconds: int) -> Column:
    """Epoch seconds of the bucket that holds a time zone-less timestamp, whatever the session's zone."""
    at = F.unix_date(ts.cast("date")).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.floor(at / seconds).cast("long") * seconds


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a zone-less time or a date, whatever the session's zone: its wall clock is read as UTC."""
    return floor_epoch(ts, 1)


def date_diff_boundary(a: Column, b: Column, seconds: int) -> Column:
    """Boundaries of `seconds` crossed from a to b."""
    return ((floor_epoch(b, seconds) - floor_epoch(a, seconds)) / seconds).cast("long")


def safe_ratio(n: Column, d: Column) -> Column:
    return n / F.nullif(d, F.lit(0))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.0088 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def ratio_half_even(n: Column, d: Column) -> Column:
    """n / d for amounts below 2e14 with six decimals, exactly, to 18 digits, ties to even; null where n < 0 or d <= 0.

    Long division in two steps of nine digits on whole micro-units keeps every product within 38 digits.
    """
    unit = lambda c: (c.cast("decimal(38,6)") * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(21,0)")
    num, den, step = unit(n), unit(d), F.lit(1_000_000_000).cast("decimal(10,0)")
    div = lambda a: F.call_function("div", a, den)
    whole, rest = div(num).cast("decimal(21,0)"), F.pmod(num, den)
    high, rest2 = div(rest * step).cast("decimal(10,0)"), F.pmod(rest * step, den)
    low, rest3 = div(rest2 * step).cast("decimal(10,0)"), F.pmod(rest2 * step, den)
    units = high * step + low
    up = F.when(rest3 * 2 > den, 1).when((rest3 * 2 == den) & (F.pmod(low, F.lit(2)) == 1), 1).otherwise(0)
    return F.when((num >= 0) & (den > 0), (whole.cast("decimal(19,0)") + ((units + up).cast("decimal(19,0)") * F.lit("0.000000000000000001").cast("decimal(18,18)")).cast("decimal(19,18)")).cast("decimal(38,18)"))


def signal_edge(p1: Column, p2: Column, rate: float) -> Column:
    """What remains of a pair's price after fees max(round(rate p (1-p), 5), 0)."""
    fee = lambda p: F.greatest(F.round(F.lit(rate) * p * (1 - p), 5), F.lit(0.0))
    return 1 - p1 - p2 - fee(p1) - fee(p2)


def json_field(c: Column, path: str, kind: str) -> Column:
    return F.get_json_object(c, path).try_cast(kind)


def parse_ts(c: Column) -> Column:
    """Tolerant parse of ISO times, a Z suffix, long fractions and plain dates; else null. Text without a zone is read as UTC, whatever the
    session's zone."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(c), "[zZ]$", "+00:00"), r"(\.\d{6})\d+", "$1")
    day = F.regexp_replace(plain, r"^(\d{4}-\d{2}-\d{2})$", "$1T00:00:00")
    return F.when(day.rlike(r"[+-]\d{2}(:?\d{2})?$") & day.contains(":"), day).otherwise(F.concat(day, F.lit("+00:00"))).try_cast("timestamp")


def decimal_string(c: Column) -> Column:
    """A decimal without trailing zeros, null unless it fits 20 digits before and 18 after the point."""
    return F.regexp_replace(F.regexp_replace(c.try_cast("decimal(38,18)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def clean_text(c: Column) -> Column:
    """Compatibility forms composed, line ends unified, control characters removed, outer space trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(nfkc(c), "\r\n?", "\n"), "[\\u0000-\\u0008\\u000B-\\u001F\\u007F]", ""))


def to_utc(wall: Column, zone: str) -> Column:
    """A zone-less wall-clock time of a zone as a zone-less UTC time, whatever the session's zone."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
