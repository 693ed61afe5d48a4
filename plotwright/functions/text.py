"""Text to typed columns, all as built-in Spark expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Categories. The first key found inside the lower-cased name wins.
CATEGORIES = [
    ("byty", 1, "Byty"),
    ("apartments", 1, "Byty"),
    ("byty k prodeji", 1, "Byty"),
    ("byty k pronájmu", 1, "Byty"),
    ("byty k pronajmu", 1, "Byty"),
    ("domy", 2, "Domy"),
    ("houses", 2, "Domy"),
    ("rodinné domy", 2, "Domy"),
    ("chaty a chalupy", 2, "Domy"),
    ("novostavby", 2, "Domy"),
    ("pozemky", 3, "Pozemky"),
    ("land", 3, "Pozemky"),
    ("pozemky, zahrady a historické stavby", 3, "Pozemky"),
    ("komerční", 4, "Komerční"),
    ("komercni", 4, "Komerční"),
    ("commercial", 4, "Komerční"),
    ("komerční objekty", 4, "Komerční"),
    ("ostatní", 5, "Ostatní"),
    ("ostatni", 5, "Ostatní"),
    ("ostatní nemovitosti", 5, "Ostatní"),
    ("garages", 5, "Ostatní"),
    ("garáže", 5, "Ostatní"),
    ("nemovitosti v zahraničí", 5, "Ostatní"),
    ("prodej", 5, "Ostatní"),
]
DEFAULT_CATEGORY = (5, "Ostatní")

WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Estate types, matched whole.
ESTATE_TYPES = {
    "pozemek": (3, "Pozemky"),
    "byt": (1, "Byty"),
    "dum": (2, "Domy"),
    "kancelar": (4, "Komerční"),
    "nebytovy_prostor": (4, "Komerční"),
    "garaz": (5, "Ostatní"),
}
UNKNOWN_ESTATE = (None, "Neznámá")

# Patterns of the feeds' titles and captions.
DISPOSITION_PREFIX = "DISP_"
ROOMS_IN_CAPTION = r"([1-6][+](?:kk|[1-6]))"
ROOMS_IN_TITLE = r"(?U)(\d+\+\d+|\d+\+kk)"
DEAL_IN_TITLE = r"^(Prodej|Pronájem)"
AREA = r"(?U)([0-9]+(?:[.,][0-9]+)?)\s*(?:m2|m²|m\^2)"
LAND_AREA = r"(?U)pozemek\s+([0-9]+(?:[.,][0-9]+)?)"

# Words dropped from administrative names, and the part suffixes cut off.
ADMIN_STOPWORDS = ["okres", "kraj", "ul", "ulice", "obec", "cast"]
PART_SUFFIXES = ["jih", "sever", "centrum"]
CAPITAL = "praha"
CAPITAL_RING = ["praha-vychod", "praha-zapad"]
CAPITAL_REGION = "hl.m. praha"
CAPITAL_RING_REGION = "stredocesky kraj"


# Letters without a Unicode decomposition, and the other scripts' letters in Latin ones.
UNDECOMPOSED = dict(zip("ØøĐđŁłĦħŦŧı –’‘“”²³¹", "OoDdLlHhTti -''\"\"231", strict=True)) | {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th",
}
CYRILLIC = dict(
    zip(
        "абвгдежзийклмнопрстуфхцчшщъыьэюяёђєіїјљњћўџґ",
        "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch ' y ' e iu ia io dj ie i i j lj nj c u dzh g".split(" "),
        strict=True,
    )
)
GREEK = dict(zip("αβγδεζηθικλμνξοπρςστυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split(" "), strict=True))


def _folds() -> dict[str, str]:
    """What every letter becomes: its Unicode decomposition without marks, in Latin letters; marks become nothing."""
    script = CYRILLIC | GREEK
    script |= {k.upper(): v.capitalize() for k, v in script.items()}
    out = {chr(code): "" for code in range(0x300, 0x370)} | UNDECOMPOSED | script
    for code in [*range(0xC0, 0x250), *range(0x370, 0x460), *range(0x1E00, 0x2000), *range(0xFB00, 0xFB07)]:
        letter = chr(code)
        parts = [c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c)]
        plain = "".join(c if c.isascii() else out.get(c, "?") for c in parts)
        if letter not in out and plain and plain.isalpha() and plain.isascii():
            out[letter] = plain
    return out


_FOLDS = _folds()
_ONE_LETTER = {k: v for k, v in _FOLDS.items() if len(v) == 1}
_NO_LETTER = [k for k, v in _FOLDS.items() if not v]
_MORE_LETTERS = {k: v for k, v in _FOLDS.items() if len(v) > 1}


def strip(c: Column) -> Column:
    """Cut white space of any kind at both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, null where there is none."""
    return or_null(F.regexp_extract(c, pattern, group))


def number(c: Column) -> Column:
    """Cast to double, null where the text is no number."""
    return c.try_cast("double")


def price(c: Column) -> Column:
    """Price text: its digits as a number."""
    return number(or_null(F.regexp_replace(c, r"[^0-9]", "")))


def area(c: Column) -> Column:
    """Area text: digits and separators kept, comma read as decimal point."""
    kept = F.regexp_replace(c, r"[^0-9,.]", "")
    return number(or_null(F.translate(kept, ",", ".")))


def numeric_or_parsed(columns: list[str], name: str, parse, certain: bool = True) -> Column:
    """The ready `<name>_numeric` column where the feed has it, else `<name>` parsed, else null.

    Unless it is `certain` that the feed has the columns, a null number is taken from the text.
    """
    rungs = [F.col(f"`{name}_numeric`").try_cast("double")] if f"{name}_numeric" in columns else []
    if name in columns and not (rungs and certain):
        rungs.append(parse(F.col(f"`{name}`")))
    return F.coalesce(*rungs) if rungs else F.lit(None).cast("double")


def first_token(c: Column) -> Column:
    return F.lower(extract(c, r"(?U)^\s*(\S+)"))


def category(name: Column) -> Column:
    """struct(category_value, category_name) of the first key contained in the name."""
    key = F.lower(strip(name))
    rungs = [
        F.when(F.contains(key, F.lit(k)), F.struct(F.lit(v).alias("category_value"), F.lit(n).alias("category_name")))
        for k, v, n in CATEGORIES
    ]
    value, label = DEFAULT_CATEGORY
    return F.coalesce(*rungs, F.struct(F.lit(value).alias("category_value"), F.lit(label).alias("category_name")))


def lookup(key: Column, pairs: dict, default=None) -> Column:
    """Whole-value lookup in a small fixed map."""
    if not pairs:
        return F.lit(default)
    found = reduce(
        lambda chain, item: chain.when(key == F.lit(item[0]), F.lit(item[1])),
        pairs.items(),
        F.when(F.lit(False), F.lit(next(iter(pairs.values())))),
    )
    return found.otherwise(F.lit(default))


def estate_category(estate_type: Column) -> Column:
    """struct(category_value, category_name) of a whole estate type."""
    key = F.lower(estate_type)
    value = lookup(key, {k: v[0] for k, v in ESTATE_TYPES.items()}, UNKNOWN_ESTATE[0])
    label = lookup(key, {k: v[1] for k, v in ESTATE_TYPES.items()}, UNKNOWN_ESTATE[1])
    return F.struct(value.cast("int").alias("category_value"), label.alias("category_name"))


def disposition(code: Column, caption: Column) -> Column:
    """Rooms from the disposition code, else from the caption."""
    from_code = F.lower(F.translate(F.replace(code, F.lit(DISPOSITION_PREFIX), F.lit("")), "_", "+"))
    return F.when(code.isNotNull(), from_code).otherwise(extract(F.lower(caption), ROOMS_IN_CAPTION))


def deal_type(title: Column) -> Column:
    return F.lower(extract(title, DEAL_IN_TITLE))


def rooms(title: Column) -> Column:
    return extract(title, ROOMS_IN_TITLE)


def _decimal(c: Column) -> Column:
    return number(F.translate(c, ",", "."))


def caption_area(caption: Column) -> Column:
    return _decimal(extract(caption, AREA))


def land_area(estate_type: Column, caption: Column) -> Column:
    """Land area: behind the word for houses, the first area for plots, else null."""
    key, text = F.lower(estate_type), F.lower(caption)
    return F.when(key == "dum", _decimal(extract(text, LAND_AREA))).when(
        key == "pozemek", _decimal(extract(text, AREA))
    )


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold(c: Column) -> Column:
    """Accents off, other scripts in Latin letters, trimmed, lower case; null becomes the empty string."""
    # What has no counterpart, the combining marks, goes.
    single = F.translate(c, "".join([*_ONE_LETTER, *_NO_LETTER]), "".join(_ONE_LETTER.values()))
    western = [k for k in _MORE_LETTERS if k in UNDECOMPOSED]
    spelt = F.create_map(*[F.lit(x) for pair in _MORE_LETTERS.items() for x in pair])

    def ascii_or(then: Callable[[Column], Column]) -> Callable[[Column], Column]:
        """Most texts are plain by now; only the others go on."""
        return lambda x: F.when(F.octet_length(x) == F.length(x), x).otherwise(then(x))

    def by_letter(x: Column) -> Column:
        return F.array_join(F.transform(F.split(x, ""), lambda k: F.coalesce(F.try_element_at(spelt, k), k)), "")

    def replaced(x: Column) -> Column:
        out = reduce(lambda t, k: F.replace(t, F.lit(k), F.lit(_MORE_LETTERS[k])), western, x)
        return _once(out, ascii_or(by_letter))

    plain = _once(single, ascii_or(replaced))
    return F.coalesce(F.lower(strip(plain)), F.lit(""))


def admin_name(c: Column) -> Column:
    """Administrative name reduced to the words that identify it."""
    folded = fold(c)
    ring = reduce(lambda a, b: a | b, [F.contains(folded, F.lit(r)) for r in CAPITAL_RING])
    suffix = F.regexp_extract(folded, r"^[^-]*-\s*(\S+)", 1)
    body = F.when(suffix.isin(PART_SUFFIXES), F.substring_index(folded, "-", 1)).otherwise(folded)
    words = F.split(F.regexp_replace(body, r"[^0-9a-z\s]", " "), r"\s+")
    kept = F.filter(words, lambda w: ~w.isin(["", *ADMIN_STOPWORDS]))
    return (
        F.when(F.startswith(folded, F.lit(CAPITAL)) & ring, F.lit(CAPITAL_RING_REGION))
        .when(F.startswith(folded, F.lit(CAPITAL)), F.lit(CAPITAL_REGION))
        .otherwise(F.array_join(kept, " "))
    )
