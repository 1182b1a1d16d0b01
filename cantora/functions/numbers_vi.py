"""Numbers in Vietnamese words, and the text cleaning that uses them."""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from cantora.functions.text import FACTORY_REPAIRS, LETTER, has_bad_attached_token, replace_all, squeeze, strip

# The words.
DIGITS = ("không", "một", "hai", "ba", "bốn", "năm", "sáu", "bảy", "tám", "chín")
TEN, TENS, HUNDRED, THOUSAND, AND, MINUS = "mười", "mươi", "trăm", "nghìn", "lẻ", "âm"
PHRASES = ((r"\b2\s+ca\b", "song ca"), (r"\b3\s+ca\b", "tam ca"), (r"\b120\b", " ".join(DIGITS[int(d)] for d in "120")))
SYMBOLS = (("m²", " mét vuông "), ("㎡", " mét vuông "), ("%", " phần trăm "))
#: Units that sound different after a multiple of ten.
AFTER_TENS = {1: "mốt", 4: "tư", 5: "lăm"}


def _under_hundred() -> list[str]:
    """Words of 0 to 99; 0 has none."""
    out = []
    for n in range(100):
        tens, unit = divmod(n, 10)
        own = "" if unit == 0 else DIGITS[unit]
        if tens == 0:
            parts = [own]
        elif tens == 1:
            parts = [TEN, AFTER_TENS[5] if unit == 5 else own]
        else:
            parts = [DIGITS[tens], TENS, AFTER_TENS.get(unit, own)]
        out.append(" ".join(p for p in parts if p))
    return out


def _under_thousand() -> list[str]:
    """Words of 0 to 999, made by rule."""
    low = _under_hundred()
    out = list(low)
    for n in range(100, 1000):
        h, rest = divmod(n, 100)
        out.append(" ".join([DIGITS[h], HUNDRED] + ([] if not rest else [AND, low[rest]] if rest < 10 else [low[rest]])))
    return out


def _lookup(words: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), n.cast("int") + 1)


def spell(n: Column) -> Column:
    """Words of a whole number; zero has none, and from a million on digits are read one by one."""
    n = n.cast("long")
    size = F.abs(n)
    low, mid = _under_hundred(), _under_thousand()
    hundreds = lambda x: F.when(x < 100, _lookup(low, x % 100)).otherwise(_lookup(mid, x % 1000))
    thousands, rest = F.floor(size / 1000), size % 1000
    tail = F.when(rest == 0, "").when(rest < 100, F.concat(F.lit(f" {DIGITS[0]} {HUNDRED} "), hundreds(rest))).otherwise(F.concat(F.lit(" "), hundreds(rest)))
    digits = F.array_join(F.transform(F.split(size.cast("string"), ""), lambda d: _lookup(list(DIGITS), d)), " ")
    out = F.when(size < 1000, hundreds(size)).when(size < 1_000_000, F.concat(hundreds(thousands), F.lit(f" {THOUSAND}"), tail)).otherwise(digits)
    return F.when(n < 0, F.concat(F.lit(f"{MINUS} "), out)).otherwise(out)


def _spell_match(raw: Column) -> Column:
    clean = F.regexp_replace(raw, "[,.]", "")
    # what a long can't hold is read digit by digit anyway
    digits = F.array_join(F.transform(F.split(F.regexp_replace(clean, "^0+(?=.)", ""), ""), lambda d: _lookup(list(DIGITS), d)), " ")
    return F.when(F.length(F.regexp_replace(clean, "^0+(?=.)", "")) > 6, digits).otherwise(spell(F.coalesce(clean.try_cast("long"), F.lit(0))))


def spell_numbers(c: Column) -> Column:
    """Numbers in a text as words: fixed phrases first, then digits with their points and commas."""
    for pattern, new in PHRASES:
        c = F.regexp_replace(c, f"(?U){pattern}", new)
    number = r"(?U)\b\d[\d,.]*\b"
    between = F.split(c, number)
    found = F.concat(F.transform(F.regexp_extract_all(c, F.lit(number), F.lit(0)), _spell_match), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, found, lambda x, y: F.concat(F.coalesce(x, F.lit("")), F.coalesce(y, F.lit("")))), "")


def name_symbols(c: Column) -> Column:
    return replace_all(c, SYMBOLS)


def clean_text(c: Column) -> Column:
    """The factory's cleaning; empty for texts with a digit or sign glued to a letter."""
    text = strip(F.lower(F.coalesce(c, F.lit(""))))
    return F.when(has_bad_attached_token(text), "").otherwise(squeeze(spell_numbers(name_symbols(replace_all(text, FACTORY_REPAIRS)))))


# The same for single texts in Python, for functions that clean ranges of words.
_ATTACHED = re.compile(rf"[\d%²㎡][{LETTER}]|[{LETTER}][\d%²㎡]")
_SPECIAL = re.compile("[0-9%²㎡]|\\d|" + "|".join(wrong for wrong, _ in FACTORY_REPAIRS))
_NUMBER = re.compile(r"\b\d[\d,.]*\b")


@cache
def _tables() -> tuple[list[str], list[str]]:
    return _under_hundred(), _under_thousand()


def spell_of(number: str) -> str:
    """``spell`` of a text of digits."""
    low, mid = _tables()
    digits = number.lstrip("0") or "0"
    if len(digits) > 6:
        return " ".join(DIGITS[int(d)] for d in digits)
    thousands, rest = divmod(int(digits), 1000)
    if not thousands:
        return mid[rest]
    tail = f" {DIGITS[0]} {HUNDRED} {low[rest]}" if 0 < rest < 100 else f" {mid[rest]}" if rest else ""
    return f"{mid[thousands]} {THOUSAND}{tail}"


def needs_cleaning(text: str) -> bool:
    """Whether ``clean_text_of`` does more to a text, or to one it is part of, than lower its case."""
    return _SPECIAL.search(text.lower()) is not None


def clean_text_of(text: str) -> str:
    text = text.lower().strip()
    if _ATTACHED.search(text):
        return ""
    for wrong, right in (*FACTORY_REPAIRS, *SYMBOLS):
        text = text.replace(wrong, right)
    for pattern, new in PHRASES:
        text = re.sub(pattern, new, text)
    return " ".join(_NUMBER.sub(lambda m: spell_of(re.sub("[,.]", "", m[0])), text).split())
