"""Countries that affiliation strings name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Countries as written at the end of affiliation strings. Fixed values.
COUNTRY_PATTERNS = {
    "US": r"USA|U\.S\.A\.?|United States", "GB": r"UK|U\.K\.?|United Kingdom|England|Scotland|(?<!South )Wales",
    "CN": r"China|P\.?R\.? ?China|PRC", "AU": r"Australia", "CA": r"Canada", "DE": r"Germany|Deutschland",
    "FR": r"France", "JP": r"Japan", "KR": r"Korea|South Korea|Republic of Korea", "IN": r"India",
    "IT": r"Italy|Italia", "ES": r"Spain|España", "NL": r"Netherlands", "CH": r"Switzerland",
    "SG": r"Singapore", "TW": r"Taiwan", "HK": r"Hong Kong", "BR": r"Brazil|Brasil", "SE": r"Sweden",
    "IL": r"Israel", "IR": r"Iran", "TR": r"Turkey|Türkiye", "BE": r"Belgium", "AT": r"Austria",
    "DK": r"Denmark", "FI": r"Finland", "NO": r"Norway", "PL": r"Poland", "PT": r"Portugal",
    "GR": r"Greece", "IE": r"Ireland", "BD": r"Bangladesh", "PK": r"Pakistan", "EG": r"Egypt",
    "MX": r"(?<!New )Mexico|México", "SA": r"Saudi Arabia", "AE": r"UAE|United Arab Emirates", "NZ": r"New Zealand",
    "MY": r"Malaysia", "TH": r"Thailand", "VN": r"Viet ?nam", "RU": r"Russia", "ZA": r"South Africa",
    "PH": r"Philippines", "ID": r"Indonesia", "CL": r"Chile", "AR": r"Argentina", "CO": r"Colombia",
}

#: States whose name is evidence of the country. Fixed values.
US_STATES = (
    "alabama", "alaska", "arizona", "arkansas", "california", "colorado", "connecticut", "delaware", "florida", "georgia",
    "hawaii", "idaho", "illinois", "indiana", "iowa", "kansas", "kentucky", "louisiana", "maine", "maryland",
    "massachusetts", "michigan", "minnesota", "mississippi", "missouri", "montana", "nebraska", "nevada", "new hampshire",
    "new jersey", "new mexico", "new york", "north carolina", "north dakota", "ohio", "oklahoma", "oregon", "pennsylvania",
    "rhode island", "south carolina", "south dakota", "tennessee", "texas", "utah", "vermont", "virginia", "washington",
    "west virginia", "wisconsin", "wyoming",
)


def countries_named(raw: Column, tail: int = 60) -> Column:
    """Codes of the countries that the last `tail` characters name, in the order of the table; null names none."""
    end = F.coalesce(F.right(raw, F.lit(tail)), F.lit(""))
    return F.array_compact(F.array(*(F.when(end.rlike(rf"(?U)\b(?:{p})\b"), F.lit(code)) for code, p in COUNTRY_PATTERNS.items())))


def countries_in_words(words: Column, names: dict[str, str], states: tuple[str, ...] = US_STATES) -> Column:
    """Codes of the country names (normalised words, by code) that stand in a normalised string as whole words, sorted; a
    state names its country too."""
    padded = F.concat(F.lit(" "), F.coalesce(words, F.lit("")), F.lit(" "))
    named = F.filter(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(c).alias("code")) for n, c in [*names.items(), *((s, "US") for s in states)])), lambda p: F.contains(padded, F.concat(F.lit(" "), p["name"], F.lit(" "))))
    return F.array_sort(F.array_distinct(F.transform(named, lambda p: p["code"])))
