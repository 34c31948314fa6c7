"""Column functions of the price model. All are built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unit spellings of the three normalisers.
STORE_UNITS = {
    "KG": "kg", "K": "kg", "KILOGRAM": "kg",
    "BUC": "pcs", "BUCATA": "pcs", "BUCATI": "pcs", "BU": "pcs", "PC": "pcs", "PIECE": "pcs", "PCS": "pcs", "PIECES": "pcs",
    "L": "L", "LITRU": "L", "LITER": "L", "ML": "ml", "G": "g",
}
PACK_UNITS = {
    "kg": "kg", "k": "kg", "kilogram": "kg", "grame": "kg", "g": "kg", "l": "L", "litru": "L", "ml": "L",
    "buc": "buc", "bu": "buc", "bucata": "buc", "bucati": "buc", "pc": "buc", "pieces": "buc",
}
ANALYSIS_UNITS = {
    "kg": "kg", "Kg": "kg", "KG": "kg", "K": "kg", "k": "kg", "1kg": "kg",
    "BUC": "buc", "BUCATA": "buc", "BUCATI": "buc", "Buc": "buc", "Buc.": "buc", "buc": "buc", "bucata": "buc", "BU": "buc", "PC": "buc", "CU": "buc", "BO": "buc",
    "Litru": "l", "L": "l", "l": "l",
}
#: Words that say nothing about a product, without marks.
STOPWORDS = (
    "de", "cu", "la", "din", "si", "sau", "pe", "in", "fara", "pt", "pentru", "ale", "al", "cel", "cea", "un", "una", "o", "kg", "g", "l", "ml",
    "buc", "bucata", "vrac", "felii", "feliata", "feliat", "srl", "com", "pan", "fel", "pret", "set", "mix", "bio", "eco",
)
#: South-west corner and cell of the grid, in degrees.
GRID_LAT, GRID_LON, GRID_CELL = 43.6, 20.3, 0.45
#: Letters with marks and the plain ones.
MARKED, PLAIN = "ăâîșşțţĂÂÎȘŞȚŢáàäéèêëíïóöôúüûçñ", "aaissttAAISSTTaaaeeeeiiooouuucn"


def half_up(x: Column, digits: int = 2) -> Column:
    """Rounding that two engines agree on: floor(x * 10^d + 0.5) / 10^d."""
    return F.floor(x * float(10**digits) + 0.5) / float(10**digits)


def mean_cents(cents: str | Column = "cents") -> Column:
    """Mean price in money, rounded to cents, from integer cents."""
    return F.floor(F.sum(cents).cast("double") / F.count(cents) + 0.5) / 100.0


def money(cents: Column) -> Column:
    return cents / 100.0


def spread_pct(low: Column, high: Column, base: Column) -> Column:
    """100 (high - low) / base, rounded to two digits; null where the base is 0."""
    return half_up(F.try_divide(F.lit(100.0) * (high - low), base))


def map_of(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for pair in values.items() for v in pair])


def store_unit(unit: Column) -> Column:
    """Kg, pcs, L, ml, g; unknown in capitals; null for empty."""
    u = F.upper(F.trim(unit))
    return F.when(u == "", None).otherwise(F.coalesce(F.try_element_at(map_of(STORE_UNITS), u), u))


def pack_unit(unit: Column) -> Column:
    """kg, L, buc or null; also of inline pack sizes such as 500g or 4x2ml; a last dot goes."""
    u = F.rtrim(F.lower(F.trim(unit)), F.lit("."))
    size = F.regexp_extract(u, r"^[\d.x]+\s*(kg|g|l|ml|buc)$", 1)
    return F.coalesce(F.try_element_at(map_of(PACK_UNITS), u), F.try_element_at(map_of(PACK_UNITS), size))


def analysis_unit(unit: Column) -> Column:
    """kg, buc, l; unknown in small letters; '' for null. Spelling counts."""
    u = F.coalesce(F.trim(unit), F.lit(""))
    return F.coalesce(F.try_element_at(map_of(ANALYSIS_UNITS), u), F.lower(u))


def without_marks(s: Column) -> Column:
    return F.translate(s, MARKED, PLAIN)


def brand_key(brand: Column) -> Column:
    return F.regexp_replace(F.upper(without_marks(brand)), "[^A-Z0-9]", "")


def is_noise(token: Column) -> Column:
    """Short, a stopword, a size such as 500g, or a number with points and commas."""
    t = F.lower(without_marks(token))
    return (F.char_length(t) < 3) | t.isin(*STOPWORDS) | t.rlike(r"^\d+[.,]?\d*\s*[gklmc][gl]?$") | t.rlike(r"^[.,]*\d[\d.,]*$")


#: What parts words, as the inside of a character class.
BETWEEN_WORDS = r"\s/,.\-–()\[\]"


def is_noise_word(word: Column) -> Column:
    """``is_noise`` of a word that a text was parted into, so it holds no point or comma; only words that begin with a digit are matched with a pattern."""
    t = F.lower(without_marks(word))
    long = max(map(len, STOPWORDS))
    return (F.char_length(word) < 3) | ((F.char_length(word) <= long) & t.isin(*STOPWORDS)) | (F.ascii(word).between(48, 57) & t.rlike(r"^\d+([gklmc][gl]?)?$"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def snake_key(lat: Column, lon: Column, cell: float = GRID_CELL) -> Column:
    """Row of a grid and column within it, every other row from right to left."""
    row, col = ((lat - GRID_LAT) / cell).cast("int"), ((lon - GRID_LON) / cell).cast("int")
    return F.struct(row.alias("row"), F.when(row % 2 == 0, col).otherwise(1000 - col).alias("col"))


def spread_bucket(pct: Column) -> Column:
    return F.when(pct < 1, 0).when(pct < 5, 1).when(pct < 10, 2).otherwise(3)


def sampling_tier(under1: Column, over10: Column) -> Column:
    """A from 80 % below 1; B from 40 % below 1 with at most 50 % above 10; else C."""
    return F.when(under1 >= 80, "A").when((100 - over10 >= 50) & (under1 >= 40), "B").otherwise("C")


def wkt_points(wkt: Column) -> Column:
    """array<struct<lon, lat>> of all vertices of a WKT polygon."""
    numbers = F.regexp_extract_all(wkt, F.lit(r"(-?\d+(?:\.\d+)?\s+-?\d+(?:\.\d+)?)"), F.lit(1))
    return F.transform(numbers, lambda p: F.struct(F.split(p, r"\s+")[0].cast("double").alias("lon"), F.split(p, r"\s+")[1].cast("double").alias("lat")))


def wkt_box(wkt: Column) -> Column:
    p = wkt_points(wkt)
    lon, lat = F.transform(p, lambda x: x["lon"]), F.transform(p, lambda x: x["lat"])
    return F.struct(F.array_min(lon).alias("west"), F.array_min(lat).alias("south"), F.array_max(lon).alias("east"), F.array_max(lat).alias("north"))


def wkt_centre(wkt: Column) -> Column:
    b = wkt_box(wkt)
    return F.struct(((b["south"] + b["north"]) / 2).alias("lat"), ((b["west"] + b["east"]) / 2).alias("lon"))


def iso_date(text: Column) -> Column:
    """DD.MM.YYYY or DD/MM/YYYY, with or without HH:MM, to YYYY-MM-DD; anything else stays."""
    return F.regexp_replace(text, r"^(\d{2})[./](\d{2})[./](\d{4})", "$3-$2-$1")


def clean_xml(text: Column) -> Column:
    """Without character references, decimal or hexadecimal, to control characters."""
    return F.regexp_replace(text, r"&#(?:0*(?:[0-8]|1[1-2]|1[4-9]|2\d|3[01]|127)|[xX]0*(?:[0-8bBcCeEfF]|1[0-9a-fA-F]|7[fF]));", "")


def short_name(network: Column, shorts: Column) -> Column:
    """The short name of an id or alias from a map, else the name with capitals; '' for null."""
    return F.when(network.isNull(), "").otherwise(F.coalesce(F.try_element_at(shorts, F.lower(network)), F.initcap(network)))
