"""Text and number clean-up as Column expressions; null stays null unless said otherwise."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F



#: Code points whose compatibility decomposition is looked up: up to CJK, ligatures, and full- and half-width forms.
RANGES = ((0xA0, 0x3000), (0xFB00, 0xFB07), (0xFF01, 0xFFEF))


def _decomposed() -> dict[str, str]:
    """Characters and their compatibility decomposition without combining marks, where it is another text; by rule, not by list."""
    plain = {c: "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) for first, last in RANGES for c in map(chr, range(first, last))}
    return {c: d for c, d in plain.items() if d != c}


DECOMPOSED = {c: d for c, d in _decomposed().items() if len(d) == 1}
#: Combining marks.
MARKS = "".join(c for c, d in _decomposed().items() if not d)
#: Ligatures, fractions and the like, which decompose into several characters.
SEVERAL = {c: d for c, d in _decomposed().items() if len(d) > 1}
#: Letters that decompose into nothing simpler and their usual Latin spelling; fixed values.
SPELLED = {"Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th", "\u2044": "/"}
#: Small words that stay in lower case inside a name; fixed values.
CONNECTORS = ("de", "del", "la", "las", "los", "el", "y")
#: Month names; fixed values.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")


def without_accents(c: Column) -> Column:
    """Characters decomposed (compatibility forms too) and combining marks left out.

    Classes of hundreds of characters are slow to look for, so a text is taken apart only if it has a character of a few ranges that hold them all.
    """
    names = F.create_map(*[F.lit(x) for kv in SEVERAL.items() for x in kv])
    spelled = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(names, x), x)), "")
    near = "".join(x for x in SEVERAL if x < "\u0250")
    one = F.translate(F.when(c.rlike(f"[{near}\u0250-\uffff]"), spelled).otherwise(c), "".join(DECOMPOSED), "".join(DECOMPOSED.values()))
    plain = F.regexp_replace(one, "[\u0300-\u036f]", "")
    return F.when(c.rlike("[\u0370-\uffff]"), F.regexp_replace(plain, f"[{MARKS}]", "")).otherwise(plain)


def _in_latin(c: Column) -> Column:
    """Without accents, and letters such as ø and ß spelled out; other scripts stay as they are."""
    one = {k: v for k, v in SPELLED.items() if len(v) == 1}
    out = F.translate(without_accents(c), "".join(one), "".join(one.values()))
    for letter, spelled in SPELLED.items():
        if len(spelled) > 1:
            out = F.replace(out, F.lit(letter), F.lit(spelled))
    return out


def norm(c: Column) -> Column:
    """Upper case, no accents, no white space at the ends."""
    return F.upper(F.trim(_in_latin(c)))


def norm_light(c: Column) -> Column:
    """Lower case, no accents."""
    return F.lower(without_accents(c))


def slugify(c: Column, empty: str = "sin_municipio") -> Column:
    """Lower case, no accents; spaces and slashes become underscores, dots and commas go; an empty name has a name of its own."""
    s = F.lower(F.regexp_replace(F.regexp_replace(norm(F.coalesce(c, F.lit(""))), "[ /]", "_"), "[.,]", ""))
    return F.when(s == "", F.lit(empty)).otherwise(s)


def slug_runs(c: Column) -> Column:
    """Runs of what is neither letter nor digit become one underscore; none at the ends."""
    return F.btrim(F.regexp_replace(norm_light(c), "[^a-z0-9]+", "_"), F.lit("_"))


def pretty_title(c: Column) -> Column:
    """A slug as a title; connectors after the first word stay small."""
    words = F.split(F.regexp_replace(c, "_", " "), " ")
    return F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & w.isin(*CONNECTORS), w).otherwise(F.initcap(w))), " ")


def first_filled(*columns: Column) -> Column:
    """The first that isn't null or blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", F.trim(c)) for c in columns])


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "\\s+", " "))


def shorten(c: Column, n: int) -> Column:
    """At most ``n`` characters, the last three of a cut text are dots."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n - 3), F.lit("..."))).otherwise(c)


def mojibake_repaired(c: Column) -> Column:
    """UTF-8 that was read as Latin-1, read again, where that lowers the number of tell-tale characters."""
    latin = F.when(c.rlike("^[\\x00-\\xff]*$"), c).otherwise(F.lit(""))
    again = F.encode(latin, "ISO-8859-1").cast("string")
    bad = lambda x: F.length(x) - F.length(F.regexp_replace(x, "[ÃÂ�]", ""))
    return F.when(c.rlike("[ÃÂ]") & (latin != "") & F.is_valid_utf8(again) & (bad(again) < bad(c)), again).otherwise(c)


def text_quality(c: Column) -> Column:
    """Letters and digits count one, tell-tale characters minus three."""
    good = F.length(c) - F.length(F.regexp_replace(c, "[\\p{L}\\p{N}]", ""))
    bad = F.length(c) - F.length(F.regexp_replace(c, "[ÃÂ�]", ""))
    return good - 3 * bad


def split_names(c: Column, least: int = 3, stop: tuple[str, ...] = ()) -> Column:
    """A list such as "a, b y c" as an array; short names and stop words are left out."""
    parts = F.transform(F.split(F.regexp_replace(c, "\\s+y\\s+", ","), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: (F.length(x) >= least) & ~F.lower(x).isin(*(stop or ("",))))


def canonical_term(c: Column, fixes: dict[str, str]) -> Column:
    """The first term of a comma list, in lower case without a last dot; listed misspellings become the right term."""
    first = F.trim(F.split_part(F.rtrim(F.trim(F.lower(c)), F.lit(".")), F.lit(","), F.lit(1)))
    known = F.create_map(*[F.lit(x) for pair in fixes.items() for x in pair])
    return F.coalesce(F.try_element_at(known, first), first)


def page_range(c: Column) -> Column:
    """"1,3-5" as [1, 3, 4, 5]; what isn't a number or a range is left out."""
    parts = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x.rlike("^\\d+(-\\d+)?$"))

    def numbers(x: Column) -> Column:
        a = F.split_part(x, F.lit("-"), F.lit(1)).cast("int")
        b = F.coalesce(F.nullif(F.split_part(x, F.lit("-"), F.lit(2)), F.lit("")).cast("int"), a)
        return F.when(a <= b, F.sequence(a, F.greatest(a, b))).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(parts, numbers))


def key_values(c: Column) -> Column:
    """"k=v; k=v" as a map of trimmed keys and values; a later key wins; parts without = are left out."""
    pairs = F.filter(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: x.contains("="))
    entries = F.transform(pairs, lambda x: F.struct(F.trim(F.split_part(x, F.lit("="), F.lit(1))).alias("k"), F.trim(F.substring(x, F.instr(x, "=") + 1, F.length(x))).alias("v")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["k"] == e["k"]))
    return F.map_from_entries(last)


def money(c: Column) -> Column:
    """An amount in either style: 1,234.56 or 1.234,56; one comma before one or two digits is a decimal comma. No digit: null."""
    s = F.regexp_replace(c, "[^0-9,.\\-]", "")
    # the cleaned text stands twice in what is always worked out, so that generated code keeps it for all other uses
    digits = F.length(s) - F.length(F.translate(s, "0123456789", ""))
    commas = F.length(s) - F.length(F.translate(s, ",", ""))
    has_dot, last_dot, last_comma = F.contains(s, F.lit(".")), F.length(F.substring_index(s, ".", -1)), F.length(F.substring_index(s, ",", -1))
    european = F.when((commas > 0) & has_dot, last_comma < last_dot).otherwise((commas > 1) | (commas == 1) & last_comma.between(1, 2))
    return F.when(digits > 0, F.when(european, F.translate(s, ",.", ".")).otherwise(F.translate(s, ",", "")).try_cast("double"))


def lenient_number(c: Column) -> Column:
    """A number without currency signs, commas, quotes or spaces; "and above" texts and anything else: null."""
    return F.regexp_replace(c, "[$,'\"\\s]", "").try_cast("double")


def label_number(c: Column) -> Column:
    """The number of a label: the label itself, else its last digits, else 0."""
    return F.coalesce(F.trim(c).try_cast("long"), F.nullif(F.regexp_extract(c, "(\\d+)\\s*$", 1), F.lit("")).cast("long"), F.lit(0).cast("long"))


def near_equal(a: Column, b: Column, tolerance: float = 0.01) -> Column:
    """Both null, or both there and no farther apart than the tolerance."""
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.abs(a - b) <= tolerance)


def safe_ratio(n: Column, d: Column, empty: float = 0.0) -> Column:
    return F.when(d > 0, n / d).otherwise(F.lit(empty))


def spanish_date(c: Column) -> Column:
    """"5 de enero de 2012" anywhere in a text as a date; null if there is none."""
    p = "(?i)(\\d{1,2})\\s+de\\s+([a-z]+)\\s+(?:de|del)\\s+(\\d{4})"
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(c, p, 2)))
    parts = F.concat_ws("-", F.regexp_extract(c, p, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(c, p, 1), 2, "0"))
    return F.when(c.rlike(p) & (month > 0), F.try_to_date(parts, "yyyy-MM-dd"))


def fiscal_year(d: Column) -> Column:
    """The year that a law published on a date is for: the same up to June, the next from July."""
    return F.year(d) + F.when(F.month(d) <= 6, 0).otherwise(1)


def escaped_latex(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\textbackslash{}"))
    for ch in "&%$#_":
        out = F.replace(out, F.lit(ch), F.lit("\\" + ch))
    return F.replace(F.replace(out, F.lit("~"), F.lit("\\textasciitilde{}")), F.lit("^"), F.lit("\\textasciicircum{}"))


def with_marks(c: Column, every: int) -> Column:
    """A position mark after each ``every`` characters."""
    n = F.greatest(F.ceil(F.length(c) / every).cast("int"), F.lit(1))
    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("[POS "), (i * every).cast("string"), F.lit("]"), F.substring(c, i * every + 1, F.lit(every)))), "")


def token_estimate(c: Column) -> Column:
    """A quarter of the characters."""
    return F.floor(F.length(c) / 4).cast("long")


def unfenced_json(c: Column) -> Column:
    """What stands between Markdown fences, or the text itself."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), "^```(?:json)?\\s*", ""), "\\s*```$", ""))


def short_id(*parts: Column, n: int = 12) -> Column:
    """The first ``n`` hex digits of the SHA-1 of the parts joined by "|"."""
    return F.substring(F.sha1(F.concat_ws("|", *parts).cast("binary")), 1, n)


def entity_code(state: Column, muni: Column) -> Column:
    """Two digits of the state and three of the municipality."""
    return F.concat(F.lpad(F.trim(state.cast("string")), 2, "0"), F.lpad(F.trim(muni.cast("string")), 3, "0"))


def first_pattern(c: Column, patterns: list[tuple[str, str]], other: str) -> Column:
    """The name of the first pattern, in order, that a text holds."""
    out = F.lit(other)
    for name, p in reversed(patterns):
        out = F.when(c.rlike(p), F.lit(name)).otherwise(out)
    return out


def signals(c: Column, patterns: list[str]) -> Column:
    """How many of the patterns a text holds."""
    total = F.lit(0)
    for p in patterns:
        total = total + c.rlike(p).cast("int")
    return total


def window_around(c: Column, pattern: str, before: int, after: int) -> Column:
    """The text around the first match of a pattern; null if there is none."""
    at = F.regexp_instr(c, F.lit(pattern))
    start = F.greatest(at - before, F.lit(1))
    return F.when(at > 0, F.substring(c, start, at + F.lit(after) - start))
