"""General column functions: JSON, time, numbers, geography, URLs and text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import settings as S
from tidemark.functions.market import first_label

# --- JSON --------------------------------------------------------------------------


def parsed_json(text: Column) -> Column:
    """JSON parsed once, null where invalid.  Make it a column of its own and take fields from that."""
    return F.try_parse_json(text)


def json_text(parsed: Column, path: str) -> Column:
    """Unquoted text at ``path`` of parsed JSON; null for invalid JSON or a missing field."""
    return F.try_variant_get(parsed, path, "string")


def json_decimal(parsed: Column, path: str, precision: int = 18, scale: int = 3) -> Column:
    return json_text(parsed, path).try_cast(T.DecimalType(precision, scale))


def payload_kind(parsed: Column) -> Column:
    """Class of a parsed payload by its JSON fields."""
    rules = [
        (parsed.isNull(), "invalid_json"),
        (json_text(parsed, "$.transactionType") == "SWAP", "solana_swap"),
        (json_text(parsed, "$.transaction").isNotNull(), "solana_transaction"),
    ]
    return first_label(rules, "unknown")


def payload_kind_by_text(text: Column) -> Column:
    """Class of a payload by the words it contains, letter case respected."""
    named = text.contains("transaction")
    rules = [
        (named & text.contains("SWAP"), "solana_swap"),
        (named, "solana_transaction"),
        (text.contains("test"), "test_event"),
    ]
    return first_label(rules, "unknown")


def is_signature(text: Column, length: int = S.SIGNATURE_LENGTH) -> Column:
    return F.coalesce(F.length(text) == length, F.lit(False))


_FIRST_EVENT = (
    "array<struct<signature:string,type:string,"
    "accountData:array<struct<account:string>>,tokenTransfers:array<struct<mint:string>>>>"
)


def first_event_fields(text: Column) -> Column:
    """Signature, type, first account and first mint of an array payload's first element."""
    events = F.when(F.ltrim(text).startswith("["), F.from_json(text, _FIRST_EVENT))
    event = F.try_element_at(events, F.lit(1))
    return F.struct(
        event["signature"].alias("signature"),
        F.coalesce(event["type"], F.lit("UNKNOWN")).alias("type"),
        F.try_element_at(event["accountData"], F.lit(1))["account"].alias("account"),
        F.try_element_at(event["tokenTransfers"], F.lit(1))["mint"].alias("mint"),
    )


# --- time ----------------------------------------------------------------------------


def iso_timestamp(text: Column) -> Column:
    """Timestamp of ISO text; null for anything that does not start like one."""
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}")
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def moment(when: datetime) -> Column:
    """Time-zone free timestamp literal, whatever the session's time zone is."""
    return F.lit(when.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def unix_time(seconds: Column, fallback: Column | None = None) -> Column:
    """Time-zone free timestamp of unix seconds, or ``fallback``."""
    at = moment(datetime(1970, 1, 1)) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return at if fallback is None else F.coalesce(at, fallback)


def day_of_week(at: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(at) - 1


def age_text(latest: Column, now: Column) -> Column:
    """Age in whole days, hours or minutes, the largest unit that is not zero."""
    seconds = F.timestamp_diff("SECOND", latest, now)
    hours = F.floor(seconds / 3600)
    return (
        F.when(latest.isNull(), "No data")
        .when(seconds >= 86_400, F.concat(F.floor(seconds / 86_400).cast("string"), F.lit(" days ago")))
        .when(seconds > 3600, F.concat(hours.cast("string"), F.lit(" hours ago")))
        .otherwise(F.concat(F.floor(seconds / 60).cast("string"), F.lit(" minutes ago")))
    )


# --- numbers ---------------------------------------------------------------------------


def safe_add(*terms: Column) -> Column:
    """Sum with null as 0."""
    first, *rest = [F.coalesce(t, F.lit(0)) for t in terms]
    for term in rest:
        first = first + term
    return first


def safe_subtract(*terms: Column) -> Column:
    """First term minus the others, null as 0."""
    first, *rest = [F.coalesce(t, F.lit(0)) for t in terms]
    for term in rest:
        first = first - term
    return first


def safe_divide(top: Column, bottom: Column) -> Column:
    """Null where the divisor is 0 or null."""
    return F.try_divide(top, bottom)


def width_bucket(value: Column, low: Column, high: Column, buckets: int) -> Column:
    """Bucket number on equal-width bins.

    A value that is a multiple of the bin width moves one bucket up, counted on
    the value itself and not on its distance from ``low``; values below ``low``
    give 0 or less and multiples beyond ``high`` give ``buckets + 2``.
    """
    width = (high - low) / buckets
    on_edge = F.try_mod(value.cast("decimal(28,6)"), width.cast("decimal(28,6)")) == 0
    place = F.least(F.ceil(F.try_divide(value - low, width)), F.lit(buckets + 1))
    return place + F.when(on_edge, 1).otherwise(0)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")

    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin(F.radians((b - a) / 2)), 2)

    across = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    miles = F.asin(F.sqrt(across)) * (2 * S.EARTH_RADIUS_MILES)
    return miles * S.KM_PER_MILE if unit == "km" else miles


# --- URLs --------------------------------------------------------------------------------


def _strip(url: Column, *schemes: str) -> Column:
    for scheme in schemes:
        url = F.replace(url, F.lit(scheme), F.lit(""))
    return url


def url_host(url: Column) -> Column:
    rest = _strip(url, "android-app://", "http://", "https://")
    return F.split_part(F.split_part(rest, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(url: Column) -> Column:
    """Text after the first slash (or from the query mark when there is none) up to the query."""
    rest = _strip(url, "http://", "https://")
    slash, query = F.instr(rest, "/"), F.instr(rest, "?")
    start = F.when(slash > 0, slash + 1).otherwise(F.greatest(query, F.lit(1)))
    return F.split_part(F.substr(rest, start), F.lit("?"), F.lit(1))


def url_parameter(url: Column, name: str) -> Column:
    """Value after the first ``name=``, also inside a longer key ending in ``name``."""
    after = F.split_part(url, F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(after, F.lit("&"), F.lit(1)), F.lit(""))


def url_parameter_exact(url: Column, name: str) -> Column:
    """Value of exactly the key ``name``, without a fragment."""
    return F.nullif(F.regexp_extract(url, rf"[?&]{re.escape(name)}=([^&#]*)", 1), F.lit(""))


# --- text ----------------------------------------------------------------------------------


def blank_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty strings become null in the given (default: all string) columns."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    chosen = strings if columns is None else [c for c in strings if c in set(columns)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in chosen})


def slugify(text: Column) -> Column:
    """Lower case, runs of blanks and dashes to ``_``, other signs dropped, no leading digit."""
    words = F.regexp_replace(F.lower(text), "[ -]+", "_")
    plain = F.regexp_replace(words, "[^a-z0-9_]+", "")
    return F.regexp_replace(plain, "^([0-9])", "_$1")


def slugify_name(name: str) -> str:
    """``slugify`` for a column name."""
    plain = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", name.lower()))
    return f"_{plain}" if plain[:1].isdigit() else plain


def surrogate_key(*columns: Column | str, null_text: str = S.SURROGATE_NULL) -> Column:
    """MD5 over the dash-joined text of the columns; nulls have a text of their own."""
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null_text)) for c in columns]
    return F.md5(F.concat_ws("-", *texts))


def mint_symbol(mint: Column) -> Column:
    """Known symbol of a mint, else its first eight signs."""
    known = F.create_map(*[F.lit(x) for pair in S.KNOWN_SYMBOLS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, mint), F.concat(F.substring(mint, 1, 8), F.lit("...")))


def event_category(text: Column) -> Column:
    """Category of the first keyword group that occurs as a word part in ``text``."""
    low = F.lower(text)
    rules = [(low.rlike("|".join(words)), label) for label, words in S.EVENT_KEYWORDS]
    return first_label(rules, "other")
