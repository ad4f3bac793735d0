"""Masking, hashing, time, number and payload expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Formats that results must agree on.
MOBILE_PATTERN = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL_PATTERN = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"
OPEN_END = "9999-12-31"
DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- masking -----------------------------------------------------------------
def keep_if(c, pattern: str) -> Column:
    """The value where it matches, else null."""
    return F.when(col(c).rlike(pattern), col(c))


def mask_name(c) -> Column:
    return F.concat(F.substring(col(c), 1, 1), F.lit("*"))


def mask_mobile(c) -> Column:
    return F.concat(F.substring(keep_if(c, MOBILE_PATTERN), 1, 3), F.lit("*"))


def mask_email(c) -> Column:
    return F.concat(F.lit("*@"), F.split(keep_if(c, EMAIL_PATTERN), "@")[1])


def hash_mobile(c) -> Column:
    return F.md5(keep_if(c, MOBILE_PATTERN))


def hash_email(c) -> Column:
    return F.md5(keep_if(c, EMAIL_PATTERN))


# ---- hashing -----------------------------------------------------------------
def hash_bucket(c, buckets: int) -> Column:
    """Four-digit bucket from the last three hex digits of the md5."""
    tail = F.conv(F.right(F.md5(col(c)), F.lit(3)), 16, 10).cast("int")
    return F.lpad((tail % buckets).cast("string"), 4, "0")


def hash_bucket_reserved(c, buckets: int, hot_keys: list[str]) -> Column:
    """``hash_bucket`` with each known hot key alone in a bucket from 9001 up."""
    bucket = hash_bucket(c, buckets)
    for i, key in enumerate(hot_keys):
        bucket = F.when(col(c) == F.lit(key), F.lit(str(9001 + i))).otherwise(bucket)
    return bucket


def stable_id(*cols) -> Column:
    """Surrogate key that is the same on every run and engine, unlike a row counter: 60 bits of the md5."""
    text = F.concat_ws("|", *[col(c).cast("string") for c in cols])
    return F.conv(F.left(F.md5(text), F.lit(15)), 16, 10).cast("bigint")


def only_allowed(c, characters: str = "a-zA-Z0-9_") -> Column:
    return col(c).rlike(f"^[{characters}]+$")


# ---- time --------------------------------------------------------------------
def millis_to_ts(c) -> Column:
    return F.timestamp_millis(col(c).cast("bigint"))


def in_zone(ts, zone: str) -> Column:
    return F.from_utc_timestamp(col(ts), zone)


def day_text(c) -> Column:
    return F.date_format(col(c), DAY)


def second_text(c) -> Column:
    return F.date_format(col(c), SECOND)


def iso_to_text(c) -> Column:
    """``2025-07-17T08:00:00.000Z`` to ``2025-07-17 08:00:00``."""
    return F.concat_ws(" ", F.substring(col(c), 1, 10), F.substring(col(c), 12, 8))


def day_of(c) -> Column:
    return col(c).cast("date")


def day_from_epoch_days(c) -> Column:
    return F.date_from_unix_date(col(c).cast("int"))


def seconds_between(start, end) -> Column:
    return F.unix_timestamp(col(end).cast("timestamp")) - F.unix_timestamp(col(start).cast("timestamp"))


def days_before(as_of: dt.date, n: int) -> Column:
    """Literal day ``n`` days before ``as_of``; a literal so that it reaches the scan."""
    return F.lit(as_of - dt.timedelta(days=n))


def month_of(c) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def day_ints(first, last) -> Column:
    """Every day of the range as a ``yyyyMMdd`` number."""
    return F.transform(
        F.sequence(day_of(first), day_of(last)), lambda d: F.date_format(d, "yyyyMMdd").cast("int")
    )


# ---- numbers -----------------------------------------------------------------
def money(c, precision: int = 18) -> Column:
    return col(c).cast(f"decimal({precision},2)")


def money_product(a, b) -> Column:
    """Exact product of two amounts held as text, as text."""
    return money(money(a, 16) * money(b, 16)).cast("string")


def _half_up(num, den, digits: int) -> Column:
    """``num / den`` rounded half up, in whole thousandths and integer division: ties are exact.  Null where ``den`` is zero."""
    n, d = ((col(c).cast("decimal(27,3)") * 1000).cast("decimal(30,0)") for c in (num, den))
    size = F.call_function("div", F.abs(n) * F.lit(2 * 10**digits) + F.abs(d), F.nullif(2 * F.abs(d), F.lit(0).cast("decimal(1,0)")))
    return F.when((n < 0) != (d < 0), -size).otherwise(size).cast("double") / F.lit(float(10**digits))


def rate(num, den, digits: int = 4) -> Column:
    """``num / den`` rounded half up, zero where the denominator is not positive."""
    return F.coalesce(F.when(col(den) > 0, _half_up(num, den, digits)), F.lit(0.0))


def rate_or_null(num, den, digits: int = 4) -> Column:
    """``num / den`` rounded half up, null where the denominator is zero."""
    return _half_up(num, den, digits)


def or_zero(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def _named(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _decimal_digits(hex_digits: Column) -> Column:
    """Decimal text of a hex text of any length.

    Up to 14 digits are converted at once.  Of longer texts 14 digits at a time are carried into limbs of 18 decimal digits, the lowest
    first; no step leaves 38 digits.  Each part is a lambda's argument, or Spark would make the text anew wherever it is read.
    """
    base, shift = F.lit(10**18).cast("decimal(19,0)"), F.lit(16**14).cast("decimal(19,0)")

    def add(limbs, chunk):
        def carried(s, x):
            both = lambda v: F.struct(F.call_function("div", v, base).alias("carry"), F.array_append(s["out"], (v % base).cast("bigint")).alias("out"))
            return _named((x.cast("decimal(18,0)") * shift + s["carry"].cast("decimal(19,0)")).cast("decimal(38,0)"), both)

        return F.aggregate(
            limbs, F.struct(chunk.alias("carry"), F.array().cast("array<bigint>").alias("out")), carried,
            lambda s: F.when(s["carry"] > 0, F.array_append(s["out"], s["carry"])).otherwise(s["out"]),
        )

    def in_limbs(padded):
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor(F.length(padded) / 14).cast("int") - 1),
            lambda i: F.conv(F.substring(padded, i * 14 + 1, F.lit(14)), 16, 10).cast("bigint"),
        )
        limbs = F.aggregate(chunks, F.array().cast("array<bigint>"), add)
        return F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), 18, "0")), "")

    def shown(digits):
        padded = F.concat(F.repeat(F.lit("0"), F.pmod(-F.length(digits), F.lit(14))), digits)
        return F.when(digits == "", F.lit("0")).when(F.length(digits) <= 14, F.conv(digits, 16, 10)).otherwise(_named(padded, in_limbs))

    return _named(F.ltrim(hex_digits, F.lit("0")), shown)


def amount_from_text(c, scale_18: bool = False) -> Column:
    """A hex (``0x…``) or decimal amount of any length as exact decimal text, optionally in units of 1e-18.

    Null in is "0"; what is no number is null.
    """

    def read(text):
        hexed = F.regexp_extract(text, "^0[xX]([0-9a-fA-F]+)$", 1)
        plain = F.regexp_extract(text, r"^[+-]?([0-9]+(?:[.][0-9]+)?)$", 1)
        return _named(F.struct(hexed.alias("hexed"), plain.alias("plain"), F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")).alias("sign")), parted)

    def parted(t):
        whole = F.when(t["hexed"] != "", _decimal_digits(t["hexed"])).when(t["plain"] != "", F.substring_index(t["plain"], ".", 1))
        rest = F.when((t["hexed"] == "") & t["plain"].contains("."), F.substring_index(t["plain"], ".", -1)).otherwise(F.lit(""))
        value = _named(F.struct(whole.alias("whole"), rest.alias("rest")), shown)
        return _named(value, lambda v: F.when(v != "0", F.concat(t["sign"], v)).otherwise(v))

    def shown(parts):
        whole, rest = parts["whole"], parts["rest"]
        if scale_18:
            shifted = F.lpad(whole, F.greatest(F.length(whole), F.lit(19)), F.lit("0"))
            rest = F.concat(F.right(shifted, F.lit(18)), rest)
            whole = F.left(shifted, F.length(shifted) - 18)
        whole = F.coalesce(F.nullif(F.ltrim(whole, F.lit("0")), F.lit("")), F.when(whole.isNotNull(), F.lit("0")))
        rest = F.rtrim(rest, F.lit("0"))
        return F.concat(whole, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(F.lit("")))

    return _named(F.coalesce(F.trim(col(c)), F.lit("0")), read)


# ---- payloads ----------------------------------------------------------------
def append_to_json_list(c, element) -> Column:
    """Append one JSON text element to a column that holds a JSON list of texts."""
    parsed = F.coalesce(F.from_json(col(c), "array<string>"), F.array().cast("array<string>"))
    return F.to_json(F.array_append(parsed, col(element)))


def fixed_words(c, width: int = 64) -> Column:
    """Split a hex payload into words of ``width`` digits, without its ``0x`` prefix."""
    body = F.regexp_replace(col(c), "^0[xX]", "")
    count = F.floor(F.length(body) / F.lit(width)).cast("int")
    words = F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda i: F.substring(body, (i - 1) * width + 1, F.lit(width)),
    )
    return F.when(count > 0, words).otherwise(F.array().cast("array<string>"))


def labelled(c, labels: dict[str, str], other: str | None) -> Column:
    """Code to label by a small fixed table."""
    out = F.lit(other).cast("string")
    for code, label in reversed(labels.items()):
        out = F.when(col(c) == F.lit(code), F.lit(label)).otherwise(out)
    return out


def by_prefix(c, labels: list[tuple[str, object]], other) -> Column:
    """First label whose LIKE pattern matches."""
    out = F.lit(other)
    for pattern, label in reversed(labels):
        out = F.when(col(c).like(pattern), F.lit(label)).otherwise(out)
    return out


def band(c, bounds: list[tuple[float, str]], above: str, missing: str) -> Column:
    """Label of the first upper bound that is not exceeded."""
    out = F.when(col(c).isNull(), F.lit(missing)).otherwise(F.lit(above))
    for upper, label in reversed(bounds):
        out = F.when(col(c) <= F.lit(upper), F.lit(label)).otherwise(out)
    return out
