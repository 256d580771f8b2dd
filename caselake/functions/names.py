"""Company-name rules as Columns: cleaned text, base name, legal form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselake.functions.columns import as_column, trim_spaces

# Legal-form suffixes, only removed from the end of a name.
LEGAL_SUFFIXES = [
    "INC", "INCORPORATED", "LLC", "L L C", "LP", "L P", "LLP", "L L P", "CORP", "CORPORATION",
    "CO", "COMPANY", "N A", "NA", "NATIONAL ASSOCIATION", "LTD", "LIMITED", "PLC",
]
# Weaker suffixes, only removed while at least two words remain.
WEAK_SUFFIXES = ["HOLDINGS", "HOLDING", "GROUP"]
# Spellings of one legal form, replaced in this order.
LEGAL_FORM_SPELLINGS = [
    (["INCORPORATED"], "INC"),
    (["CORPORATION"], "CORP"),
    (["COMPANY"], "CO"),
    (["NATIONAL ASSOCIATION"], "NA"),
    (["N A"], "NA"),
    (["L L C"], "LLC"),
    (["L P"], "LP"),
    (["LIMITED", "HOLDING"], "LTD"),
]
# Punctuation that separates words, and marks that vanish inside a word.
WORD_BREAKS = '.,&"()/'
VANISHING = "'`"


def _ending(words: list[str]) -> str:
    return r" (?:" + "|".join(words) + r")\z"


def clean_company_text(name: Column | str) -> Column:
    """Upper case, punctuation gone, single spaces, no leading THE."""
    # translate() maps the word breaks to spaces and drops the characters without a partner
    plain = F.translate(F.upper(as_column(name)), WORD_BREAKS + VANISHING, " " * len(WORD_BREAKS))
    single_spaced = trim_spaces(F.regexp_replace(plain, r"\s+", " "))
    return trim_spaces(F.regexp_replace(single_spaced, "^THE ", ""))


def strip_legal_suffixes(name: Column | str, passes: int = 3) -> Column:
    """Drop one legal suffix from the end, ``passes`` times over."""
    return reduce(
        lambda text, _: F.regexp_replace(text, _ending(LEGAL_SUFFIXES), ""),
        range(passes),
        as_column(name),
    )


def company_base(cleaned: Column | str) -> Column:
    """Base name of a cleaned company text: legal suffixes off, weak ones only if 2+ words stay."""
    core = strip_legal_suffixes(cleaned, 3)
    without_weak = F.regexp_replace(core, _ending(WEAK_SUFFIXES), "")
    return F.when(without_weak.contains(" "), strip_legal_suffixes(without_weak, 2)).otherwise(core)


def legal_form(cleaned: Column | str, base: Column | str) -> Column:
    """The tail that ``base`` lost, with equivalent legal forms spelled alike ('' if none)."""
    cleaned, base = as_column(cleaned), as_column(base)
    tail = trim_spaces(F.substring(cleaned, F.length(base) + 1, F.length(cleaned)))
    padded = F.concat(F.lit(" "), tail, F.lit(" "))
    for spellings, standard in LEGAL_FORM_SPELLINGS:
        if len(spellings) == 1:
            padded = F.replace(padded, F.lit(f" {spellings[0]} "), F.lit(f" {standard} "))
        else:
            padded = F.regexp_replace(padded, f" (?:{'|'.join(spellings)}) ", f" {standard} ")
    return trim_spaces(padded)
