"""Everything a reconciliation run can be told, as one immutable value."""

from __future__ import annotations

from dataclasses import dataclass, field

# Labels, in the order of the cascade.
PRINCIPAL = ("MATCH_EXACT", "MATCH_WINDOW")
REFINED = ("MATCH_TRUNC", "MATCH_TRUNC_WINDOW", "MATCH_TRANSITION")
RECOVERED = ("MATCH_RELAPSE", "MATCH_RELAPSE_TRUNC")
MATCHED = PRINCIPAL + REFINED + RECOVERED
INV_DELETE, INV_MISSING, LEDGER_ONLY, LEDGER_LATE, LEDGER_LATE_OBS = "INV_DELETE", "INV_MISSING", "LEDGER_ONLY", "LEDGER_LATE", "LEDGER_LATE_OBS"
KNOWN = (*MATCHED, INV_DELETE, INV_MISSING, LEDGER_ONLY, LEDGER_LATE, LEDGER_LATE_OBS)
KEPT_ACTIONS = ("KEEP", "ADD", "STUDY")
ACTION_ORDER = ("KEEP", "STUDY", "ADD", "DELETE")

# Instruction phrases, first hit wins.
INSTRUCTIONS = (
    ("pm mrm à conserver", "KEEP"),
    ("pm à ajouter", "ADD"),
    ("pm dont l'ajout est à étudier", "ADD"),
    ("pm mrm à étudier", "STUDY"),
    ("psap à conserver et pm mrm à supprimer", "DELETE"),
    ("pm mrm à supprimer", "DELETE"),
)

# Bins as (low, high, label), low included.
RESERVE_BINS = ((None, 5_000, "< 5K"), (5_000, 20_000, "5K – 20K"), (20_000, 50_000, "20K – 50K"), (50_000, 100_000, "50K – 100K"), (100_000, None, "> 100K"))
GAP_BINS = ((None, 1_000, "< 1K"), (1_000, 5_000, "1K – 5K"), (5_000, 10_000, "5K – 10K"), (10_000, 50_000, "10K – 50K"), (50_000, 100_000, "50K – 100K"), (100_000, None, "> 100K"))
UNKNOWN_BIN, UNKNOWN_RANK = "UNKNOWN", 99

# Month names.
MONTHS = ("Jan", "Fév", "Mar", "Avr", "Mai", "Jun", "Jul", "Aoû", "Sep", "Oct", "Nov", "Déc")

#: Ledger clause prefix of each contract type; an unknown type is an error, never a filter left out.
TYPE_PREFIXES = {"PB": "CPB_"}


def year_of(date: str | None) -> int | None:
    """The year of a dd/MM/yyyy text; None for "auto", nothing or anything else."""
    last = str(date).split("/")[-1]
    return int(last) if last.isdecimal() else None


@dataclass(frozen=True)
class Recon:
    vision: str = "2023"
    types: tuple[str, ...] = ("PB",)
    clauses: tuple[str, ...] = ()
    statuses: tuple[str, ...] = ()
    type_prefixes: dict[str, str] = field(default_factory=lambda: dict(TYPE_PREFIXES))
    window_days: int = 7
    relapse_days: int = 30
    #: Coverage offset of a transition; None leaves that step out. signed: ledger minus inventory, else either way.
    transition_offset: int | None = 4
    transition_signed: bool = False
    truncate: int = 20
    #: "row": a matched row leaves by its id, and every row is accounted for. "key": all rows of a matched key leave.
    consume: str = "row"
    #: Which inventory row stands for a key: "first" by (event date, id), before the condition; "nearest" event after it.
    pick: str = "first"
    one_to_one: bool = False
    late_days: int | None = None
    inventory_year: int | None = None
    late_coverage: int = 60
    late_months: tuple[int, ...] = (11, 12)
    tag_months: tuple[int, ...] = (11, 12)
    year_end_months: tuple[int, ...] = (10, 11, 12)
    high_reserve: float = 20_000
    reserve_bins: tuple = RESERVE_BINS
    gap_bins: tuple = GAP_BINS
