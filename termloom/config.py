"""Every code, threshold and default the rules use, in one place."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    """Parameters of the student-history plan. The defaults are fixed values."""

    # Calendar and candidacy placeholders.
    dummy_year: str = "ZZZZ"
    dummy_term: str = "ZZ"
    # End of the newest term. None leaves it open-ended, so no date falls into it.
    last_term_end: datetime.date | None = None

    # Course rows.
    dropped_status: str = "D"
    transfer_grades: tuple[str, ...] = ("T", "TU")
    transfer_term: str = "TR"
    transfer_year: str = "TRAN"
    active_year: str = "2425"
    active_terms: tuple[str, ...] = ("SP", "SU")
    full_time_hours: int = 12
    credit_type_ranks: Mapping[str, int] = field(default_factory=lambda: {"CR": 3, "VO": 2, "CE": 1})

    # Degrees. Level rules are tried in order: (column, codes, level).
    major_degree_overrides: Mapping[str, str] = field(default_factory=lambda: {"LAR": "NDA"})
    level_rules: tuple[tuple[str, tuple[str, ...], int], ...] = (
        ("div_cde", ("U",), 3),
        ("degr_cde", ("A", "AGS", "BA", "BS", "BSW", "S"), 3),
        ("degr_cde", ("V",), 2),
        ("degr_cde", ("C",), 1),
        ("degr_cde", ("NDA",), 0),
        ("div_cde", ("A",), -1),
    )
    level_names: Mapping[int, str] = field(default_factory=lambda: {3: "UG", 2: "VO", 1: "CE"})
    level_names_own: Mapping[int, str] = field(default_factory=lambda: {-1: "XX", 3: "UG", 2: "VO", 1: "CE"})
    level_unknown: str = "00"
    certificate_degrees: tuple[str, ...] = ("V", "C")
    # A term is degree-seeking when its ;-joined degree codes hold one of these anywhere ...
    degree_marks: tuple[str, ...] = ("S", "BA", "BS")
    # ... or this code as an item with a neighbour on both sides.
    degree_middle_mark: str = "A"
    # Compare the marks with whole codes instead.
    whole_degree_marks: bool = False
    degree_level_floor: int = 3

    # Status.
    cutoff_term: int = 202501
    current_terms: tuple[int, ...] = (202501, 202506)

    # Output.
    first_row_college: str = "U"
    first_row_degree: str = "NOND"
    first_row_major: str = "ATLG"
    first_row_program: str = "NOND"
    fill_depth: int = 6
    month_shift: Mapping[int, int] = field(default_factory=lambda: {6: 5})
    campus: str = "SAC"
    residence: str = "C"
    admit_type: str = "ST"
    # Put in front of every output column but the last one.
    column_prefix: str = ""

    def __post_init__(self):
        levels = [level for _, _, level in self.level_rules]
        # Each level has a bit of an integer of its own.
        if any(not -1 <= level <= 28 for level in levels):
            raise ValueError("levels must lie between -1 and 28")
