"""Column builders shared by the operators: dates, clamps, lexicons and text."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Date = dt.date | str
#: Rounding digits of every stored score.
DIGITS = 6


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(value: Date) -> Column:
    return F.lit(str(value)).cast("date")


def r6(c: Column | str) -> Column:
    return F.round(col(c), DIGITS)


def empty_if_null(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda's variable: for values that ``use`` names often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# -- dates ------------------------------------------------------------------------------------------------------------


def parse_date(c: Column | str) -> Column:
    """The date in the first ten characters if they are a padded ISO date, else null."""
    head = F.left(col(c), F.lit(10))
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))


def months_between(start: Column | str, end: Column | str) -> Column:
    """Calendar months from start to end, days ignored, never negative; 0 where either is null."""
    start, end = col(start), col(end)
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return F.coalesce(F.greatest(F.lit(0), months), F.lit(0))


def day_age(c: Column | str, reference: Column) -> Column:
    return F.greatest(F.lit(0), F.datediff(reference, col(c)))


def year_age(c: Column | str, reference: Column) -> Column:
    return day_age(c, reference) / F.lit(365.25)


def linear_recency(age: Column, recent_days: int = 60, stale_days: int = 180, recent: float = 1.0, stale: float = 0.35) -> Column:
    """``recent`` up to recent_days, ``stale`` from stale_days on (and for no date), linear between."""
    share = (age - recent_days) / F.lit(float(max(1, stale_days - recent_days)))
    return F.when(age.isNull() | (age >= stale_days) & (age > recent_days), F.lit(stale)).when(age <= recent_days, F.lit(recent)).otherwise(F.lit(recent) - share * (recent - stale))


def role_recency(is_current: Column, end: Column, start: Column, reference: Column, current: float, recent_years: int, older: float) -> Column:
    """Weight of a role's evidence: current, recent (1), older, or 1 where no date is known."""
    last = F.coalesce(parse_date(end), parse_date(start))
    return F.when(is_current, F.lit(current)).when(last.isNull() | (year_age(last, reference) <= recent_years), F.lit(1.0)).otherwise(F.lit(older))


# -- numbers ----------------------------------------------------------------------------------------------------------


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def to_cap(c: Column | str, cap: float) -> Column:
    """Share of a cap, within 0 and 1; a cap that isn't positive gives 0."""
    return clamp(col(c) / F.lit(float(cap))) if cap > 0 else F.lit(0.0)


def first_band(value: Column | str, bands: Sequence[tuple[float, float, float]], other: float = 0.0) -> Column:
    """Score of the first (low, high, score) band, both ends included, that holds the value."""
    out = None
    for low, high, score in bands:
        hit = col(value).between(low, high)
        out = F.when(hit, F.lit(float(score))) if out is None else out.when(hit, F.lit(float(score)))
    return F.lit(float(other)) if out is None else out.otherwise(F.lit(float(other)))


def or_default(c: Column | str, default: float) -> Column:
    """The value, or the default where it is null or zero."""
    c = col(c)
    return F.when(c.isNull() | (c == 0), F.lit(default)).otherwise(c)


# -- text -------------------------------------------------------------------------------------------------------------


def normalize_text(c: Column | str) -> Column:
    """Lower case, white space collapsed to single blanks, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(empty_if_null(c)), r"(?U)\s+", " "))


def trimmed(parts: Column, blank: str = " ") -> Column:
    """Each part without ``blank`` characters at its ends."""
    return F.transform(parts, lambda p: F.trim(p, F.lit(blank)))  # F.trim by itself would take an entry's index for the characters to cut


def text_join(parts: Column) -> Column:
    """Non-empty parts of an array, trimmed, joined by blanks, trimmed."""
    kept = F.filter(parts, lambda p: p.isNotNull() & (p != ""))
    return F.trim(F.array_join(trimmed(kept), " "))


def matched_terms(text: Column, terms: Sequence[str]) -> Column:
    """The terms that occur in the text as substrings, sorted."""
    found = [F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in sorted(set(terms))]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(text, F.lit(t))
    return out


def word_pattern(term: str) -> str:
    """A term as whole words, in any run of white space between them."""
    return r"(?U)\b" + r"\s+".join(re.sub(r"([^\w])", r"\\\1", w) for w in term.split(" ")) + r"\b"


def word_hits(text: Column, terms: Sequence[str]) -> Column:
    """How many entries of the lexicon the text has as whole words; repeated entries count again.

    The text is cut into words once for all single words; of the other entries,
    a regex is asked only where their longest part occurs at all.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    words = F.array_distinct(F.regexp_extract_all(low, F.lit(r"(?U)\w+"), F.lit(0)))
    out = F.lit(0)
    single = Counter(t for t in terms if re.fullmatch(r"\w+", t))
    for times in sorted(set(single.values())):
        out = out + F.size(F.array_intersect(words, F.lit(sorted(t for t, n in single.items() if n == times)))) * times
    for t in terms:
        if t not in single:
            out = out + (F.contains(low, F.lit(max(t.split(" "), key=len))) & low.rlike(word_pattern(t))).cast("int")
    return out


def word_score(text: Column, terms: Sequence[str], divisor: float) -> Column:
    return F.least(F.lit(1.0), word_hits(text, terms) / F.lit(float(divisor)))


def weighted_word_score(fields: Mapping[str, Column], terms: Sequence[str], weights: Mapping[str, float], divisors: Mapping[str, float]) -> Column:
    out = F.lit(0.0)
    for name, weight in weights.items():
        out = out + F.lit(float(weight)) * word_score(fields[name], terms, divisors[name])
    return clamp(out)


def sentences(c: Column, gap: str = r"(?U)(?<=[.!?])\s+", blank: str = " ") -> Column:
    """Split behind a full stop, exclamation or question mark followed by white space, or at another ``gap``; ends trimmed of ``blank``, empty parts left out."""
    return F.filter(trimmed(F.split(F.trim(c, F.lit(blank)), gap), blank), lambda s: s != "")


def first_sentence(c: Column) -> Column:
    return F.coalesce(F.get(sentences(c), F.lit(0)), F.lit(""))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"([a-z0-9+/.\-]+)"), F.lit(1))


def span_key(c: Column) -> Column:
    """Lower-cased letters and digits, all else one blank."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))


def opening_key(c: Column, words: int = 5) -> Column:
    cleaned = F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))
    return F.array_join(F.slice(F.split(cleaned, " "), 1, words), " ")


def rank_band(rank: Column | str, bands: Sequence[tuple[int, int, str]]) -> Column:
    rank, out = col(rank), None
    for low, high, label in bands:
        hit = rank.between(low, high)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(bands[-1][2]))


def score_text(c: Column | str) -> Column:
    return F.format_string("%.6f", col(c))


def json_list(c: Column | str) -> Column:
    return F.coalesce(F.from_json(col(c), "array<string>"), F.array().cast("array<string>"))


def lexical_share(text: Column, terms: Sequence[str]) -> Column:
    """Share of the terms that the lower-cased text has as substrings."""
    return F.size(matched_terms(F.lower(F.coalesce(text, F.lit(""))), terms)) / F.lit(float(len(terms)))


def first_of_each(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of every key in the given order."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
