"""Names: which label of an entity becomes its name, and what comes off it."""

from __future__ import annotations

import itertools
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from placeforge.constants import MAX_NAME, MIN_LETTERS_KEPT
from placeforge.functions.text import fold, romanise, slug

#: Fixed value: the words of administrative units that mark an address.
_ADDRESS = re.compile(
    r"\b(district|oblast|krai|okrug|raion|rayon|selsoviet|sel.soviet|rural settlement|urban settlement|municipality|county|province|region|"
    r"prefecture|voivodeship|governorate|department|commune|canton|state|emirate|subdistrict|sub-district|taluk|tehsil|mandal|upazila)\b",
    re.I,
)
#: Fixed value: the kinds of place that stand before a romanised Russian name.
_KIND = re.compile(r"^(gorod|selo|derevnya|posyolok|poselok|rabochiy poselok|pgt|stanitsa|khutor|aul|slobod[ak])\s+", re.I)
_QUOTED = re.compile(r"^.*?<<\s*(.+?)\s*>>\s*$")
_GLOSS = re.compile(r"\s*\([^()]*\)\s*")


def usable(text: str | None) -> bool:
    """Whether a label can be a name: not too long, with letters, most of which fold to ASCII, and a slug."""
    if not text or len(text) > MAX_NAME:
        return False
    letters = sum(map(str.isalpha, text))
    return letters > 0 and sum(map(str.isalpha, fold(text))) >= MIN_LETTERS_KEPT * letters and slug(text) != ""


def strip_qualifier(text: str) -> tuple[str, str | None]:
    """(head, qualifier) of a label that ends in a balanced round or square bracket; else (text, None)."""
    close = text[-1:]
    open_ = {")": "(", "]": "["}.get(close)
    if open_:
        depths = itertools.accumulate((c == close) - (c == open_) for c in reversed(text))
        size = next((k for k, depth in enumerate(depths, 1) if depth == 0), 0)
        head, inner = text[: len(text) - size].strip(), text[len(text) - size + 1 : -1].strip()
        if size and head and inner and usable(head):
            return head, inner
    return text, None


def strip_description(text: str) -> str:
    """The name in '… << name >>' without glosses and kind words."""
    quoted = _QUOTED.match(text)
    inner = quoted[1] if quoted else ""
    for what, instead in ((_GLOSS, " "), (_KIND, "")):
        inner = what.sub(instead, inner.strip()).strip()
    return inner if usable(inner) else text


def strip_address(text: str) -> str:
    """The head of a chain of two commas or more with an administrative word after the head."""
    head, comma, tail = text.partition(",")
    head = head.strip()
    return head if comma and "," in tail and _ADDRESS.search(tail) and usable(head) else text


def resolve_name(labels: dict[str, str] | None, native: str | None) -> tuple[str | None, str | None, str | None]:
    """(name, language, original where it was romanised) of an entity's labels.

    Every label that can be a name, as it stands or spelled in Latin letters, gets a rank, and the least one wins: no
    bracket before a bracket; then English, `mul` and the country's language, then a spelling of the latter two, then any
    other language; then the order en, mul, the country's language, all others by code.
    """
    labels = labels or {}
    home = native.split("-")[0] if native else None
    front = ["en", "mul", native]

    def place(lang: str) -> tuple[int, str]:
        return (front.index(lang), "") if lang in front else (len(front), lang)

    def ranked():
        for lang, label in labels.items():
            local = lang == "mul" or lang.split("-")[0] == home
            if usable(label):
                yield ("(" in label, 0 if local or lang == "en" else 2, place(lang)), label, lang, None
            spelling = romanise(label, lang) if local else None
            if usable(spelling):
                yield ("(" in spelling, 1, place(lang)), spelling, lang, label

    best = min(ranked(), key=lambda x: x[0], default=None)
    return (strip_address(strip_description(best[1])), *best[2:]) if best else (None, None, None)


def alt_names(aliases: dict[str, list[str]] | None, native: str | None, romanised: tuple[str, str] | None = None) -> dict[str, list[str]]:
    """Sorted aliases in English and the country's language, and the original of a romanised name."""
    aliases = aliases or {}
    out = {x: sorted(aliases[x]) for x in dict.fromkeys(["en", native]) if x and aliases.get(x)}
    if romanised and romanised[1] not in out.get(romanised[0], ()):
        out[romanised[0]] = sorted([*out.get(romanised[0], ()), romanised[1]])
    return out


def _texts(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


@F.pandas_udf(_texts("name", "lang", "original"))
def _resolve_udf(labels: pd.Series, native: pd.Series) -> pd.DataFrame:
    rows = [resolve_name(dict(x) if x is not None else None, n if isinstance(n, str) else None) for x, n in zip(labels, native, strict=True)]
    return pd.DataFrame(rows, columns=["name", "lang", "original"], dtype=object)


@F.pandas_udf(_texts("head", "qualifier"))
def _qualifier_udf(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([strip_qualifier(x) if isinstance(x, str) else (None, None) for x in s], columns=["head", "qualifier"], dtype=object)


@F.pandas_udf(StringType())
def _address_udf(s: pd.Series) -> pd.Series:
    return s.map(strip_address, na_action="ignore")


@F.pandas_udf(BooleanType())
def usable_column(s: pd.Series) -> pd.Series:
    return s.map(lambda x: isinstance(x, str) and usable(x)).astype(bool)


def resolve_column(labels: Column, native: Column) -> Column:
    """struct(name, lang, original): one batch pass over labels and native language."""
    return _resolve_udf(labels, native)


def qualifier_column(c: Column) -> Column:
    """struct(head, qualifier); Python sees a null where no bracket ends the text."""
    ends = F.coalesce(c.rlike(r"[)\]]\z"), F.lit(False))
    none = F.struct(c.alias("head"), F.lit(None).cast("string").alias("qualifier"))
    return F.when(ends, _qualifier_udf(F.when(ends, c))).otherwise(none)


def address_column(c: Column) -> Column:
    """strip_address(); Python sees a null where there are fewer than two commas."""
    many = F.coalesce(c.rlike(r",.*,"), F.lit(False))
    return F.when(many, _address_udf(F.when(many, c))).otherwise(c)


def alt_names_column(aliases: Column, native: Column, lang: Column, original: Column) -> Column:
    """alt_names() by map functions."""
    empty = F.create_map().cast("map<string,array<string>>")
    kept = F.map_filter(F.coalesce(aliases, empty), lambda k, v: ((k == "en") | (k == native)) & (F.size(v) > 0))
    kept = F.transform_values(kept, lambda _k, v: F.array_sort(v))
    own = F.coalesce(F.try_element_at(kept, lang), F.array().cast("array<string>"))
    more = F.map_concat(F.map_filter(kept, lambda k, _v: k != lang), F.map_from_arrays(F.array(lang), F.array(F.array_sort(F.array_append(own, original)))))
    return F.when(original.isNull() | lang.isNull() | F.array_contains(own, original), kept).otherwise(more)
