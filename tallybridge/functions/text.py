"""Name normalisers and the instruction classifier, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import INSTRUCTIONS

#: Letters whose accents are removed on request, and what they become.
ACCENTED, PLAIN = "ÀÂÄÇÉÈÊËÎÏÔÖÙÛÜ", "AAACEEEEIIOOUUU"


def _upper(name: Column, strip_accents: bool, unicode_spaces: bool) -> Column:
    name = F.regexp_replace(name, "[\\u00A0\\u2000-\\u200A\\u202F\\u3000]", " ") if unicode_spaces else name
    name = F.upper(F.trim(name))
    return F.translate(name, ACCENTED, PLAIN) if strip_accents else name


def full_name(name: Column, strip_accents: bool = False, unicode_spaces: bool = False) -> Column:
    """Upper case without white space; null stays null."""
    return F.regexp_replace(_upper(name, strip_accents, unicode_spaces), "\\s+", "")


def truncated_name(name: Column, length: int = 20, strip_accents: bool = False, unicode_spaces: bool = False) -> Column:
    """The first characters in upper case, cut before white space goes: as a source with a fixed width has them."""
    return F.regexp_replace(F.substring(_upper(name, strip_accents, unicode_spaces), 1, length), "\\s+", "")


def action(instruction: Column, rules=INSTRUCTIONS) -> Column:
    """KEEP, ADD, STUDY or DELETE by the first phrase that the text contains; null otherwise."""
    text, out = F.lower(F.trim(instruction)), None
    for phrase, name in rules:
        out = F.when(text.contains(phrase), name) if out is None else out.when(text.contains(phrase), name)
    return out


def clause_number(clause: Column) -> Column:
    """A ledger clause without its letter prefix."""
    return F.regexp_replace(clause, "^[A-Za-z]+_", "")

