"""Text as columns: normal form, numbers, patterns, keyword families."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _foldable() -> tuple[str, str]:
    """Accented letters with a one-letter base form, by rule."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if len(unicodedata.normalize("NFD", chr(c))) > 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _PLAIN = _foldable()

# Patterns of known kinds of values, tried in this order.
PATTERNS = [
    ("ruc", r"\b\d{11}\b"),
    ("fecha", r"\d{1,2}[/-]\d{1,2}[/-]\d{2,4}"),
    ("monto", r"S/?\s*\.?\s*\d{1,3}(?:[,\s]\d{3})*(?:\.\d{2})?"),
    ("igv", r"(?:IGV|I\.G\.V\.)\s*(?:18%|18\s*%)"),
    ("factura", r"(?:FACTURA|FACT\.?)\s*(?:N[°º]?\.?)?\s*[\w-]+"),
    ("dni", r"\b\d{8}\b"),
    ("codigo", r"\b[A-Z0-9]{3,}-[A-Z0-9]+\b"),
]

# Keywords by family, tried in this order.
FAMILIES = {
    "ruc": ["ruc", "r.u.c", "registro", "contribuyente"],
    "razon_social": ["razón social", "razon social", "cliente", "señor"],
    "direccion": ["dirección", "direccion", "domicilio", "calle", "av.", "jr."],
    "fecha": ["fecha", "emisión", "emision"],
    "factura": ["factura", "fact.", "comprobante", "serie"],
    "subtotal": ["subtotal", "sub total", "base imponible"],
    "igv": ["igv", "i.g.v", "impuesto"],
    "total": ["total", "importe", "neto"],
    "cantidad": ["cant.", "cantidad", "unid"],
    "descripcion": ["descripción", "descripcion", "detalle", "concepto"],
    "precio": ["precio", "p.unit", "unitario", "valor"],
}


def normalize_text(c: Column) -> Column:
    """Lower case without accents and punctuation, white space collapsed; null stays null."""
    low = F.regexp_replace(F.translate(F.lower(c), _ACCENTED, _PLAIN), r"\p{Mn}", "")
    return F.trim(F.regexp_replace(F.regexp_replace(low, r"(?U)[^\w\s]", ""), r"(?U)\s+", " "))


#: White space, and letters that are of no letter's category, as Java's regular expressions have them.
_SPACE = frozenset(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_LETTERS = frozenset(map(chr, [0x200C, 0x200D, *range(0x24B6, 0x24EA), *range(0x1F130, 0x1F14A), *range(0x1F150, 0x1F16A), *range(0x1F170, 0x1F18A)]))
_WORDLY = {"Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Nd", "Mc", "Me", "Pc"}
_FOLD = str.maketrans(_ACCENTED, _PLAIN)


def normal_form(text: str, keep_points: bool = False) -> str:
    """normalize_text() of one text, or normalize_text_keep_points()."""
    low = text.lower() if keep_points else text.lower().translate(_FOLD)
    more = ".-" if keep_points else ""
    kinds = _WORDLY | {"Mn"} if keep_points else _WORDLY
    kept = "".join(" " if c in _SPACE else c for c in low if c in _SPACE or c in more or unicodedata.category(c) in kinds or c in _LETTERS)
    return " ".join(x for x in kept.split(" ") if x)


def normal_forms(texts, keep_points: bool = False):
    """normalize_text() of an Arrow array, or normalize_text_keep_points(): ASCII all together, other texts one by one; null stays null."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    more = ".-" if keep_points else ""
    low = pc.ascii_lower(texts)
    odd = np.flatnonzero(pc.fill_null(pc.match_substring_regex(low, rf"[^a-z0-9_{more}]"), False).to_numpy(zero_copy_only=False))
    if not len(odd):
        return low
    some = low.take(pa.array(odd))
    clean = pc.replace_substring_regex(some, rf"[^a-z0-9_\t-\r {more}]+", "")
    clean = pc.ascii_trim(pc.replace_substring_regex(clean, r"[\t-\r ]+", " "), " ")
    wide = np.flatnonzero(pc.invert(pc.string_is_ascii(some)).to_numpy(zero_copy_only=False))
    if len(wide):
        own = {int(i): normal_form(texts[int(odd[i])].as_py(), keep_points) for i in wide}
        clean = pa.array([own.get(i, v) for i, v in enumerate(clean.to_pylist())], pa.string())
    at = np.arange(len(low))
    at[odd] = len(low) + np.arange(len(odd))
    return pa.concat_arrays([low, clean]).take(pa.array(at))


def normalize_text_sql(c: str) -> str:
    """The same as an expression in Spark's SQL."""
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(translate(lower({c}), '{_ACCENTED}', '{_PLAIN}'), r'\p{{Mn}}', ''), r'(?U)[^\w\s]', ''), r'(?U)\s+', ' '))"


def normalize_text_keep_points(c: Column) -> Column:
    """The documented variant: points and hyphens stay, accents too."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)[^\w\s.-]", ""), r"(?U)\s+", " "))


def tokens(c: Column) -> Column:
    """Words split at white space, without empty ones."""
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def token_count(c: Column) -> Column:
    return F.coalesce(F.size(tokens(c)), F.lit(0))


def extract_number(c: Column, mode: str = "decimal_aware") -> Column:
    """First number of a text, or null.

    strip_separators: all commas and points are dropped first. decimal_aware: if both
    occur the last one is the decimal mark; one kind that occurs once and is not
    followed by exactly three digits is it too; all others mark thousands.
    """
    if mode == "strip_separators":
        return F.nullif(F.regexp_extract(F.regexp_replace(c, "[,.]", ""), r"-?\d+", 0), F.lit("")).try_cast("double")
    t = F.rtrim(F.regexp_extract(c, r"-?\d[\d.,]*", 0), F.lit(".,"))
    points, commas = F.regexp_count(t, F.lit(r"\.")), F.regexp_count(t, F.lit(","))
    last = F.regexp_extract(t, r"([.,])[^.,]*$", 1)
    tail = F.length(F.regexp_extract(t, r"[.,]([^.,]*)$", 1))
    decimal = ((points > 0) & (commas > 0)) | ((points + commas == 1) & (tail != 3))
    whole = F.regexp_replace(t, "[.,]", "")
    with_point = F.concat(F.regexp_replace(F.regexp_extract(t, r"^(.*)[.,]", 1), "[.,]", ""), F.lit("."), F.regexp_extract(t, r"[.,]([^.,]*)$", 1))
    return F.nullif(F.when(decimal & (last != ""), with_point).otherwise(whole), F.lit("")).try_cast("double")


def detect_pattern(c: Column) -> Column:
    """Name of the first pattern that the text holds, or null."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS):
        out = F.when(c.rlike("(?i)" + pattern), F.lit(name)).otherwise(out)
    return out


def keyword_family(field: Column) -> Column:
    """Name of the first family that the field's name contains, or null."""
    out = F.lit(None).cast("string")
    for name in reversed(FAMILIES):
        out = F.when(F.lower(field).contains(name), F.lit(name)).otherwise(out)
    return out


def family_keywords(family: Column) -> Column:
    out = F.array().cast("array<string>")
    for name, words in FAMILIES.items():
        out = F.when(family == name, F.array(*map(F.lit, words))).otherwise(out)
    return out


def value_kind(value: Column, numeric: Column) -> Column:
    """numeric, multiword or single; booleans count as numeric."""
    return F.when(numeric, F.lit("numeric")).when(token_count(value) > 1, F.lit("multiword")).otherwise(F.lit("single"))


def is_currency_symbol(c: Column) -> Column:
    return c.rlike(r"^S/?\.?$")


def osd_confidence(c: Column) -> Column:
    """Orientation confidence of an orientation report; 0 if it names none."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"Orientation confidence:\s*(-?\d+\.?\d*)", 1), F.lit("")).try_cast("double"), F.lit(0.0))
