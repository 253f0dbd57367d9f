"""Scalar expressions over all-text filings; blanks are null and every cast of text is a safe one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Street suffixes, directions and unit words with their postal abbreviations (public postal standard).
POSTAL = {
    "ALLEY": "ALY", "ANNEX": "ANX", "ARCADE": "ARC", "AVENUE": "AVE", "BAYOU": "BYU", "BEACH": "BCH",
    "BEND": "BND", "BLUFF": "BLF", "BOTTOM": "BTM", "BOULEVARD": "BLVD", "BRANCH": "BR", "BRIDGE": "BRG",
    "BROOK": "BRK", "BURG": "BG", "BYPASS": "BYP", "CAMP": "CP", "CANYON": "CYN", "CAPE": "CPE",
    "CAUSEWAY": "CSWY", "CENTER": "CTR", "CIRCLE": "CIR", "CLIFF": "CLF", "CLUB": "CLB", "COMMON": "CMN",
    "CORNER": "COR", "COURSE": "CRSE", "COURT": "CT", "COVE": "CV", "CREEK": "CRK", "CRESCENT": "CRES",
    "CROSSING": "XING", "DALE": "DL", "DAM": "DM", "DIVIDE": "DV", "DRIVE": "DR", "ESTATE": "EST",
    "EXPRESSWAY": "EXPY", "EXTENSION": "EXT", "FALLS": "FLS", "FERRY": "FRY", "FIELD": "FLD", "FLAT": "FLT",
    "FORD": "FRD", "FOREST": "FRST", "FORGE": "FRG", "FORK": "FRK", "FORT": "FT", "FREEWAY": "FWY",
    "GARDEN": "GDN", "GARDENS": "GDNS", "GATEWAY": "GTWY", "GLEN": "GLN", "GREEN": "GRN", "GROVE": "GRV",
    "HARBOR": "HBR", "HAVEN": "HVN", "HEIGHTS": "HTS", "HIGHWAY": "HWY", "HILL": "HL", "HILLS": "HLS",
    "HOLLOW": "HOLW", "INLET": "INLT", "ISLAND": "IS", "JUNCTION": "JCT", "KNOLL": "KNL", "LAKE": "LK",
    "LANDING": "LNDG", "LANE": "LN", "LODGE": "LDG", "MANOR": "MNR", "MEADOW": "MDW", "MILL": "ML",
    "MISSION": "MSN", "MOUNT": "MT", "MOUNTAIN": "MTN", "ORCHARD": "ORCH", "PARKWAY": "PKWY", "PASSAGE": "PSGE",
    "PIKE": "PIKE", "PINE": "PNE", "PLACE": "PL", "PLAIN": "PLN", "PLAZA": "PLZ", "POINT": "PT",
    "PORT": "PRT", "PRAIRIE": "PR", "RANCH": "RNCH", "RAPID": "RPD", "RIDGE": "RDG", "RIVER": "RIV",
    "ROAD": "RD", "ROUTE": "RTE", "SHOAL": "SHL", "SHORE": "SHR", "SPRING": "SPG", "SPRINGS": "SPGS",
    "SQUARE": "SQ", "STATION": "STA", "STREAM": "STRM", "STREET": "ST", "SUMMIT": "SMT", "TERRACE": "TER",
    "TRACE": "TRCE", "TRAIL": "TRL", "TUNNEL": "TUNL", "TURNPIKE": "TPKE", "UNION": "UN", "VALLEY": "VLY",
    "VIADUCT": "VIA", "VIEW": "VW", "VILLAGE": "VLG", "VISTA": "VIS", "NORTH": "N", "SOUTH": "S",
    "EAST": "E", "WEST": "W", "NORTHEAST": "NE", "NORTHWEST": "NW", "SOUTHEAST": "SE", "SOUTHWEST": "SW",
    "APARTMENT": "APT", "BUILDING": "BLDG", "DEPARTMENT": "DEPT", "FLOOR": "FL", "ROOM": "RM", "SUITE": "STE",
}


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_filled(c: Column) -> Column:
    """True for anything but null and the empty string (white space counts as filled)."""
    return F.coalesce(c, F.lit("")) != ""


def to_int(c: Column) -> Column:
    return blank_to_null(F.trim(c)).try_cast("int")


def to_long(c: Column) -> Column:
    return blank_to_null(F.trim(c)).try_cast("bigint")


def to_decimal(c: Column) -> Column:
    return blank_to_null(F.trim(c)).try_cast("decimal(38,10)")


def strict_int(c: Column) -> Column:
    """A year that must be one: text that is none raises under ANSI rules."""
    return c.cast("int")


def leading_int(c: Column) -> Column:
    """The integer that a text begins with, else null: ``12.9`` is 12, ``abc`` null."""
    return F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("bigint")


def only_digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def as_ein(c: Column) -> Column:
    """Nine digits, else null."""
    digits = only_digits(c)
    return F.when(F.length(digits) == 9, digits)


def format_ein(c: Column) -> Column:
    return F.when(F.length(c) == 9, F.concat(F.substring(c, 1, 2), F.lit("-"), F.substring(c, 3, 7))).otherwise(c)


def format_compact(amount: Column) -> Column:
    """$1.2M style; null as an em dash."""
    steps = [(1e9, "B"), (1e6, "M"), (1e3, "K")]
    out = F.concat(F.lit("$"), F.format_number(F.abs(amount), 0))
    for size, unit in reversed(steps):
        out = F.when(F.abs(amount) >= size, F.concat(F.lit("$"), F.format_number(F.abs(amount) / size, 1), F.lit(unit))).otherwise(out)
    return F.when(amount.isNull(), "—").otherwise(F.concat(F.when(amount < 0, "-").otherwise(""), out))


def format_full(amount: Column) -> Column:
    return F.when(amount.isNull(), "—").otherwise(F.concat(F.when(amount < 0, "-$").otherwise("$"), F.format_number(F.abs(amount), 0)))


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalise_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def person_key(name: Column, ein: Column) -> Column:
    """MD5 of normalised name and EIN, laid out as a UUID."""
    h = F.md5(F.concat(normalise_name(name), F.lit("|"), ein))
    return F.regexp_replace(h, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def key_text(c: Column, *, fill: bool) -> Column:
    """Lower-cased key; with ``fill`` a null becomes the empty string, else it stays and never joins."""
    return F.lower(F.coalesce(c, F.lit(""))) if fill else F.lower(c)


def clean_zip(c: Column) -> Column:
    """Five digits: shorter ones are padded with zeros, nine-digit ones cut; other forms are null."""
    bare = F.regexp_replace(c, "-", "")
    return F.when(F.length(c) < 5, F.lpad(c, 5, "0")).when(F.length(c) == 5, c).when(F.length(bare) == 9, F.left(bare, F.lit(5)))


def full_name(*parts: Column) -> Column:
    """The stripped parts that are not empty, a space between."""
    return F.concat_ws(" ", *[F.nullif(strip(p), F.lit("")) for p in parts])


def clean_address(*parts: Column, terms: dict[str, str] | None = None) -> Column:
    """Upper-cased parts on end, whole words abbreviated (``terms``), punctuation dropped, single blanks. Words end at
    punctuation for the abbreviation, and what was parted by it only comes together after: ``O'Hare Street`` is
    ``OHARE ST``. Words are looked up in one literal map, so the cost does not grow with the terms."""
    terms = POSTAL if terms is None else terms
    text = F.upper(F.concat_ws(" ", *[F.nullif(strip(F.coalesce(p, F.lit(""))), F.lit("")) for p in parts]))
    table = F.create_map(*[F.lit(x) for pair in sorted(terms.items()) for x in pair])
    words = F.transform(F.regexp_extract_all(text, F.lit(r"(?U)(\w+)"), F.lit(1)), lambda w: F.coalesce(F.try_element_at(table, w), w))
    gaps = F.transform(F.split(text, r"(?U)\w+"), lambda g: F.regexp_replace(g, r"(?U)[^\w\s]", ""))
    joined = F.array_join(F.zip_with(gaps, words, lambda g, w: F.concat(g, F.coalesce(w, F.lit("")))), "")
    return strip(F.regexp_replace(joined, r"(?U)\s+", " "))


def minus_filled(a: Column, b: Column) -> Column:
    return a - F.coalesce(b, F.lit(0))


def plus_filled(*cs: Column) -> Column:
    return reduce(lambda x, y: x + y, [F.coalesce(c, F.lit(0)) for c in cs])


def round_away(c: Column) -> Column:
    """To the nearest bigint, halves away from zero."""
    return F.round(c, 0).cast("bigint")


def any_ilike(needle: str, *cs: Column) -> Column:
    """Whether any column contains the text, letter case aside; ``%`` and ``_`` in it are wild."""
    return reduce(lambda x, y: x | y, [F.coalesce(c.ilike(f"%{needle}%"), F.lit(False)) for c in cs])


def compare(c: Column, op: str, value: float) -> Column:
    """Numeric predicate by name; a null fails it."""
    ops = {">=": c >= value, "<=": c <= value, ">": c > value, "<": c < value, "=": c == value}
    return F.coalesce(ops[op], F.lit(False))


class Clean:
    """Limits of what a caller may ask for; wrong values become the default, sizes are cut."""

    @staticmethod
    def query(q: str | None) -> str:
        return (q or "").strip()[:200]

    @staticmethod
    def page(p) -> int:
        return max(1, int(p)) if str(p).lstrip("-").isdigit() else 1

    @staticmethod
    def limit(n, most: int = 50) -> int:
        return min(most, max(1, int(n))) if str(n).isdigit() and int(n) > 0 else min(25, most)

    @staticmethod
    def year(y) -> int | None:
        return int(y) if str(y).isdigit() and 1900 <= int(y) <= 2100 else None

    @staticmethod
    def amount(a) -> float | None:
        try:
            return float(a) if float(a) >= 0 else None
        except (TypeError, ValueError):
            return None

    @staticmethod
    def choice(value, allowed: tuple[str, ...]) -> str:
        return value if value in allowed else allowed[0]
