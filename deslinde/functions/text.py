"""Text expressions: slugs, address bases, accents, money, name variants."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from deslinde import constants as C


def squeeze(col: Column) -> Column:
    return F.regexp_replace(col, r"(?U)\s+", " ")


def strip(col: Column) -> Column:
    """Trim any white space, not just blanks."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def slug(col: Column) -> Column:
    """Lower-case identifier. Letters and numbers of any script stay, so ``m²`` does too."""
    return _slug_end(_slug_letters(col))


def _slug_letters(col: Column, also: str = "") -> Column:
    kept = F.regexp_replace(F.lower(col), rf"(?U)[^\p{{L}}\p{{N}}_\s{also}-]+", "")
    return F.regexp_replace(kept, r"(?U)[\s-]+", "_")


def _slug_end(col: Column) -> Column:
    return F.substring(F.trim(col, F.lit("_")), 1, C.SLUG_LENGTH)


def slugs(texts: Column) -> Column:
    """:func:`slug` of every text of an array without nulls, in one pass over all of them.

    They are joined by a control character, which a slug drops and which ends a word as the end of a text does.
    """
    mark = "\x01"
    whole = F.array_join(F.transform(texts, lambda t: F.replace(t, F.lit(mark), F.lit(""))), mark)
    parts = F.split(_slug_letters(whole, also=r"\x01"), mark)
    return F.when(F.size(texts) > 0, F.transform(parts, _slug_end)).otherwise(F.slice(texts, 1, 0))


def address_base(col: Column) -> Column:
    """Street and number without the flat, box or store suffix; null stays null."""
    text = strip(F.upper(col))
    for suffix in (r"[A-E]?DP\s+\d+\w*", r"BX\s+\d+", r"BD\s+\d+"):
        text = F.regexp_replace(text, rf"(?Ud)\s+{suffix}.*$", "")
    return F.when(col != "", strip(squeeze(text)))


def _latin_table() -> tuple[str, str]:
    """Accented Latin letters and their bases, by Unicode decomposition."""
    accented, plain = [], []
    for point in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        parts = unicodedata.normalize("NFKD", chr(point))
        base = [p for p in parts if not unicodedata.combining(p)]
        if len(parts) > 1 and len(base) == 1 and base[0].isascii():
            accented.append(chr(point))
            plain.append(base[0])
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _latin_table()
_COMBINING = r"[̀-ͯ]"


def unaccent(col: Column) -> Column:
    """Base letters for accented ones, other characters kept."""
    return F.regexp_replace(F.translate(col, _ACCENTED, _PLAIN), _COMBINING, "")


def normal_name(col: Column) -> Column:
    """Upper-case name without accents."""
    return F.upper(unaccent(col))


def ascii_name(col: Column) -> Column:
    """As :func:`normal_name`, but trimmed and with whatever is left outside ASCII dropped."""
    return strip(F.upper(F.regexp_replace(unaccent(col), r"[^\x00-\x7F]", "")))


def layer_word(col: Column) -> Column:
    """Name as it is written in a layer: no accents, blanks as underscores."""
    return F.replace(normal_name(col), F.lit(" "), F.lit("_"))


def layer_name(code: Column, name: Column) -> Column:
    """Layer word of a commune, its exception first."""
    exceptions = F.create_map(*[F.lit(v) for kv in C.LAYER_NAME_EXCEPTIONS.items() for v in kv])
    return F.coalesce(F.try_element_at(exceptions, code.cast("int")), layer_word(name))


def money_digits(col: Column) -> Column:
    """``$1.234.567`` to ``1234567``."""
    return strip(F.regexp_replace(col, r"[$.,]", ""))


def truthy(col: Column) -> Column:
    return F.coalesce(F.lower(strip(col.cast("string"))).isin(C.TRUE_WORDS), F.lit(False))


def present(col: Column) -> Column:
    """True where the text is neither null nor one of the words written for null."""
    return col.isNotNull() & ~col.cast("string").isin(C.NULL_WORDS)


def null_if_blank_word(col: Column) -> Column:
    return F.when(present(col), col)


def _split_preposition(part: Column) -> Column:
    out = None
    for ending, spelled in C.PREPOSITION_SPLITS:
        hit = part.endswith(ending) & (F.length(part) > len(ending))
        value = F.concat(F.substring(part, F.lit(1), F.length(part) - len(ending)), F.lit("_" + spelled))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(part)


def name_variants(col: Column) -> Column:
    """Other spellings to try for a layer word, the word itself excluded."""
    spelled = F.array_join(F.transform(F.split(col, "_"), _split_preposition), "_")
    tries = F.array(spelled, F.replace(col, F.lit("'"), F.lit("")), F.replace(col, F.lit("_"), F.lit("")))
    return F.array_distinct(F.filter(tries, lambda t: t != col))


def size_tier(size_bytes: Column) -> Column:
    """Tier by whole mebibytes."""
    mb = F.floor(size_bytes / F.lit(1048576))
    out = None
    for label, above in C.TIER_MB:
        out = F.when(mb > above, label) if out is None else out.when(mb > above, label)
    return out.otherwise(C.TIER_REST)
