"""Column expressions: dates, ratios, parsing, flags and scores. All stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

EARTH_RADIUS_MILES = 3959.0


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- strings and categories ------------------------------------------------

def flag_from_string(col) -> Column:
    """True unless the text is exactly "0"."""
    return _c(col) != "0"


def default_when_null(col, kind: str, default) -> Column:
    return F.coalesce(_c(col).try_cast(kind), F.lit(default))


def value_map(col, mapping: dict, default=None) -> Column:
    """Recode by dictionary; values not in it become ``default`` (NULL)."""
    out = F.when(F.lit(False), F.lit(None))
    for key, value in mapping.items():
        out = out.when(_c(col) == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default))


def term_match(columns: Sequence, phrase: str, *extra: str) -> Column:
    """Any term of ``"A OR B"`` (plus ``extra``) in any column, case ignored."""
    terms = [t.strip() for t in re.split(r"\s+OR\s+", phrase)] + list(extra)
    quoted = "|".join(r"\Q" + t + r"\E" for t in terms if t)
    return reduce(lambda a, b: a | b, [F.coalesce(_c(c).rlike(f"(?i)({quoted})"), F.lit(False)) for c in columns])


def currency(col, kind: str = "double") -> Column:
    """``$1,234.50`` to a number; what does not parse is NULL."""
    return F.regexp_replace(F.trim(_c(col)), r"[$,]", "").try_cast(kind)


def scaled_number(col, divisor: float = 10.0) -> Column:
    return _c(col).try_cast("double") / divisor


def token_to_null(col, token: str = "?") -> Column:
    return F.when(F.trim(_c(col)) != token, _c(col))


def binarize(col) -> Column:
    return (_c(col) > 0).cast("int")


def url_slug(url) -> Column:
    """Host and path with runs of other characters as one ``_``, at most 80 characters."""
    host = F.coalesce(F.try_parse_url(_c(url), F.lit("HOST")), F.lit(""))
    path = F.coalesce(F.try_parse_url(_c(url), F.lit("PATH")), F.lit(""))
    joined = F.regexp_replace(F.concat(host, path), "[^a-zA-Z0-9]+", "_")
    name = F.substring(F.regexp_replace(joined, "^_|_$", ""), 1, 80)
    return F.when(name == "", "scraped").otherwise(name)


def strip_leading_number(col) -> Column:
    """The first ``12. `` style number removed."""
    return F.regexp_replace(_c(col), r"(?s)^(.*?)\d+\. ", "$1")


def sanitized_names(names: Sequence[str]) -> list[str]:
    """Runs of non-word characters to ``_``; names that collide are an error."""
    out = [re.sub(r"\W+", "_", n) for n in names]
    if len(set(out)) != len(out):
        raise ValueError(f"column names collide after cleaning: {sorted(out)}")
    return out


# ---- dates -----------------------------------------------------------------

def date_parts(col) -> dict[str, Column]:
    c = _c(col)
    return {"year": F.year(c), "month": F.month(c), "week": F.weekofyear(c), "day": F.dayofmonth(c)}


def hour_and_weekday(col) -> dict[str, Column]:
    """Hour and day of week with Monday as 0."""
    return {"hour": F.hour(_c(col)), "dow": F.weekday(_c(col))}


def mid_month(year, month) -> Column:
    return F.make_date(_c(year), _c(month), F.lit(15))


def week_start(year, week) -> Column:
    """January 1st plus (week - 1) * 7 days."""
    return F.date_add(F.make_date(_c(year), F.lit(1), F.lit(1)), (_c(week).cast("int") - 1) * 7)


def clamped_elapsed(end, start, cap: int, unit: int, year=None) -> tuple[Column, Column]:
    """(days clamped to [0, cap], whole units); 0 when ``year`` is 1900 or earlier."""
    days = F.greatest(F.lit(0), F.least(F.lit(cap), F.datediff(_c(end), _c(start))))
    if year is not None:
        days = F.when(_c(year) > 1900, days).otherwise(0)
    return days, (days / unit).cast("int")


def age_years(reference, born) -> Column:
    return F.floor(F.datediff(_c(reference), _c(born)) / 365.25).cast("int")


def since(ts, kickoff, days: int) -> Column:
    """Rows created within ``days`` before ``kickoff``, which is always passed in."""
    return _c(ts) >= F.lit(kickoff).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")


# ---- numbers ---------------------------------------------------------------

def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    a1, o1, a2, o2 = (F.radians(_c(c)) for c in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return 2 * EARTH_RADIUS_MILES * F.asin(F.sqrt(h))


def in_box(lat, lon, south, north, west, east) -> Column:
    return _c(lat).between(south, north) & _c(lon).between(west, east)


def unit_if_zero(col) -> Column:
    return F.when(_c(col) == 0, F.lit(1.0)).otherwise(_c(col))


def z_and_ratio(x, mean, std) -> tuple[Column, Column]:
    return (_c(x) - _c(mean)) / unit_if_zero(std), _c(x) / unit_if_zero(mean)


def percent_of(part, whole) -> Column:
    """100 * part / whole, NULL when whole is 0."""
    return F.lit(100.0) * _c(part) / F.nullif(_c(whole), F.lit(0))


def storm_category(wind, pressure) -> Column:
    """0 where not extreme, else 1 to 5 by wind above 33 at a pressure below 980."""
    level = F.least(F.lit(5), F.floor((_c(wind) - 33) / 10).cast("int") + 1)
    return F.when((_c(wind) > 33) & (_c(pressure) < 980), level).otherwise(0)


def profile_score(profile: dict[str, tuple[float, float]], bonus, all_pass) -> dict[str, Column]:
    """Range flags per column, the all-pass flag and the normalised score.

    Each range gives 1 point plus up to half a point near its middle; the bonus
    column counts double and ``all_pass`` one point more.
    """
    flags = {k: F.col(k).between(lo, hi) for k, (lo, hi) in profile.items()}
    points = []
    for k, (lo, hi) in profile.items():
        half = (hi - lo) / 2
        away = F.abs(F.col(k) - (lo + hi) / 2) / half if half else F.lit(0.0)
        points.append(F.when(flags[k], 1 + F.greatest(F.lit(0.0), 0.5 * (1 - away))).otherwise(0.0))
    total = reduce(lambda a, b: a + b, points) + _c(bonus) * 2 + _c(all_pass).cast("int")
    return {
        **{f"{k}_ok": f for k, f in flags.items()},
        "all_met": reduce(lambda a, b: a & b, flags.values()),
        "score": total / (len(profile) + 3),
    }


def marker_reward(text, answer, marker: str = "####") -> Column:
    """0.2 for the marker, plus 1 when the final integer equals the answer."""
    t = _c(text)
    has = t.contains(marker)
    tail = F.regexp_extract(F.substring_index(t, marker, -1), r"-?\d+", 0)
    last = F.try_element_at(F.regexp_extract_all(t, F.lit(r"-?\d+"), F.lit(0)), F.lit(-1))
    found = F.when(has & (tail != ""), tail).otherwise(last)
    return F.when(has, 0.2).otherwise(0.0) + F.when(F.coalesce(found == _c(answer).cast("string"), F.lit(False)), 1.0).otherwise(0.0)


# ---- vectors ---------------------------------------------------------------

def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda s, v: s + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def squared_distance(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))),
                       F.lit(0.0), lambda s, v: s + v)


def unit_vector(a) -> Column:
    return F.transform(_c(a), lambda v: v / norm(a))


# ---- sequences -------------------------------------------------------------

def letter_share(col, letters: str, alphabet: str) -> Column:
    """Share of ``letters`` among characters of ``alphabet``; other characters are removed first."""
    clean = F.regexp_replace(F.upper(_c(col)), f"[^{alphabet}]", "")
    hit = F.length(F.regexp_replace(clean, f"[^{letters}]", ""))
    return hit / F.nullif(F.length(clean), F.lit(0))


def point_edit(col, position, alt) -> Column:
    """Replace the character at the 0-based position with ``alt``."""
    s, p = _c(col), _c(position)
    return F.concat(F.substring(s, F.lit(1), p), _c(alt), F.substring(s, p + 2, F.length(s)))


def letter_matches(col, position, ref) -> Column:
    return F.substring(_c(col), _c(position) + 1, F.lit(1)) == _c(ref)
