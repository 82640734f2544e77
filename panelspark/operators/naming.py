"""Names, districts and years out of headings, with aliases that are tables: the longest alias that a name ends with is found by a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.text import norm

#: Openings of a heading in order, what ends a name, and where its year stands; fixed values of the headings' form.
OPENINGS = (
    r"LEY\s+DE\s+INGRESOS\s+DEL\s+MUNICIPIO\s+DEL\s+MUNICIPIO\s+DE\s+(.+)",
    r"LEY\s+DE\s+INGRESOS\s+DEL\s+HONORABLE\s+AYUNTAMIENTO\s+DE\s+(.+)",
    r"LEY\s+DE\s+INGRESOS\s+DEL\s+MUNICIPIO\s+DE\s+(.+)",
    r"LEY\s+DE\s+INGRESOS\s+DE\s+(.+)",
)
YEARS = (r"EJ[A-Z]{3,18}\s*(?:FISCAL|LEGAL)?\s*(?:DEL\s+)?(20\d{2})\b", r"\b(20\d{2})$")
STATE, DISTRICT, PURPOSE = "OAXACA", "DISTRITO DE", r"\b(?:PAA|PARA)\b"
_EDGES = " ,.;"


def _clean(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, r"\s+", " "))


def _plain(c: Column) -> Column:
    """For comparing: upper case, no accents, white space made one space."""
    return _clean(norm(c))


def _first(c: Column, patterns: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(c, "(?is)" + p, 1), F.lit("")) for p in patterns])


def longest_suffix(rows: DataFrame, key: str, text: str, aliases: DataFrame, alias: str) -> DataFrame:
    """For each key whose text ends with an alias after at least one more word: key, alias, n_words; the longest of such aliases.

    Every end of a text that begins with a word is looked up by an equi-join; aliases may be any number.
    """
    words = F.split(_plain(F.col(text)), " ")
    ends = F.filter(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda n: n < F.size(words))
    each = rows.select(key, F.explode(F.transform(ends, lambda n: F.struct(F.array_join(F.slice(words, F.size(words) - n + 1, n), " ").alias(alias), n.alias("n_words")))).alias("_e"))
    found = each.select(key, "_e.*").join(aliases.select(_plain(F.col(alias)).alias(alias)).distinct(), alias)
    return found.groupBy(key).agg(F.max_by(F.struct(alias, "n_words"), F.length(alias)).alias("_b")).select(key, "_b.*")


def named(headings: DataFrame, key: str, heading: str, aliases: DataFrame, alias: str) -> DataFrame:
    """name, district, year and alias (the one that split a name without comma) of headings; one row for each key.

    The first opening that a heading has gives what follows it, up to its purpose and without its state; the parts at a comma are name
    and district, else the longest alias at the end is the district.
    """
    s = _clean(F.coalesce(F.col(heading), F.lit("")))
    rest = F.get(F.split(F.coalesce(_first(s, OPENINGS), F.lit("")), "(?i)" + PURPOSE, 2), F.lit(0))
    rest = F.btrim(F.regexp_replace(_clean(rest), rf"(?i)[,;]?\s*{STATE}\s*\.?$", ""), F.lit(_EDGES))
    parts = F.filter(F.transform(F.split(rest, "[,;]"), lambda p: F.btrim(_clean(p), F.lit(_EDGES))), lambda p: p != "")
    x = headings.select(key, parts.alias("_parts"), _first(_plain(s), YEARS).cast("int").alias("year"))
    one = x.filter(F.size("_parts") == 1).select(key, F.get("_parts", F.lit(0)).alias("_only"))
    x = x.join(longest_suffix(one, key, "_only", aliases, alias), key, "left")
    words = F.split(F.get("_parts", F.lit(0)), " ")
    cut = lambda part: F.btrim(part, F.lit(_EDGES))
    bare = lambda part: cut(F.regexp_replace(part, rf"(?i)^{DISTRICT}\s+", ""))
    before, after = F.array_join(F.slice(words, F.lit(1), F.size(words) - F.col("n_words")), " "), F.array_join(F.slice(words, F.size(words) - F.col("n_words") + 1, F.col("n_words")), " ")
    whole = F.coalesce(F.get("_parts", F.lit(0)), F.lit(""))
    name = F.when(F.col("n_words").isNotNull(), cut(before)).otherwise(whole)
    district = F.when(F.size("_parts") > 1, bare(F.get("_parts", F.lit(1)))).when(F.col("n_words").isNotNull(), bare(after)).otherwise(F.lit(""))
    return x.select(key, name.alias("name"), district.alias("district"), "year", F.coalesce(alias, F.lit("")).alias("alias"))


def fixed_by_content(rows: DataFrame, rules: DataFrame, place: str, name: str, text: str) -> DataFrame:
    """``rows`` with names put right by what their text holds. rules: place, name, contains, right_name, rank; the first rule that holds decides.

    Rules are joined by place and name, so only rows that a rule names are looked at.
    """
    r = rules.select(F.col(place).alias("_place"), F.col(name).alias("_name"), "contains", "right_name", "rank")
    hit = rows.join(r, (F.col(place) == F.col("_place")) & (F.col(name) == F.col("_name"))).filter(F.contains(F.upper(norm(F.coalesce(F.col(text), F.lit("")))), F.upper(norm(F.col("contains")))))
    fixed = hit.groupBy(place, name, F.xxhash64(text).alias("_h")).agg(F.min_by("right_name", "rank").alias("right_name"))
    out = rows.withColumn("_h", F.xxhash64(text)).join(fixed, [place, name, "_h"], "left").withColumn(name, F.coalesce("right_name", name))
    return out.select(*rows.columns)
