"""Read profiles and stocks."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class DualIndex:
    """The second index of a profile, and what repairs short barcodes."""

    ref_p7: str
    dir_p7: str
    len_p7: int
    fill: str | None = None
    #: The barcode lies beside ref_bc (downstream), not between the P7 anchor and ref_bc.
    beside_bc: bool = False


@dataclass(frozen=True)
class ReadProfile:
    """Where the index and the barcode of a read lie."""

    name: str
    strand: str
    ref_p5: str
    dir_p5: str
    len_p5: int
    ref_bc: str
    dir_bc: str
    len_bc: int
    core: tuple[int, int] | None = None
    dual: DualIndex | None = None

    def __post_init__(self) -> None:
        if self.strand not in ("fwd", "rev"):
            raise ValueError("strand must be fwd or rev")
        for d in (self.dir_p5, self.dir_bc):
            if d not in ("upstream", "downstream"):
                raise ValueError("directions must be upstream or downstream")


#: Anchors, directions and lengths of the known read structures.
PROFILES = {
    p.name: p
    for p in (
        ReadProfile("M", "rev", "CCAGAACCTCCACTACCCATTCATCC", "upstream", 8, "ATGGAAGAAAGACCTCCAGAAAATGAAG", "upstream", 34, core=(12, 10), dual=DualIndex("CCTCCCCCTCCAGGACTAGCATAA", "upstream", 8, fill="ACCTCCTCCTCCTCCCCCTCCAGGACTAGCATAA")),
        ReadProfile("X", "fwd", "TAAAAATTTTCGGGTCTATTAC", "upstream", 8, "TAAAAATTTTCGGGTCTATTAC", "downstream", 45, dual=DualIndex("TGGATAGCAGTTCCCACATGGAGG", "downstream", 8, beside_bc=True)),
        ReadProfile("SL8_bc", "rev", "AGCTGAGAGAGGATTTCCTCCC", "upstream", 8, "ATGGAAGAAAGACCTCCAGAAAATGAAG", "upstream", 34),
        ReadProfile("SL8_epi", "rev", "AGCTGAGAGAGGATTTCCTCCC", "upstream", 8, "CGCTCTTCATGCATTTCAGAGGCGGATGCA", "downstream", 24),
        ReadProfile("pre_VIF", "rev", "CTGCTATCCACCTCTTTTCC", "upstream", 8, "ATGGAGGAGGAAAAGAGGTGGATAGCAG", "upstream", 34, dual=DualIndex("TGACGATTGTGTGGCAAGTAGACAGGACGAGGATTAA", "upstream", 7)),
        ReadProfile("post_VIF", "rev", "CATTGTATGGCTCCCTCTGTG", "upstream", 8, "ATGGAACAAGCCCCAGAAGACCAAGGGC", "upstream", 34, dual=DualIndex("CAAAAGTCTTGGGAATACTGGCCTGA", "upstream", 8)),
    )
}


@dataclass(frozen=True)
class Stock:
    """A barcoded stock: its read profile and its reference; discovery needs none."""

    name: str
    profile: str
    fasta: str | None
    discover: bool = False


#: Stock, profile, reference file.
STOCKS = {
    s.name: s
    for s in (
        Stock("239M", "M", "239M_reference.fasta"),
        Stock("239M2", "M", "239M2_reference.fasta"),
        Stock("239X/INT", "X", "239X_reference.fasta"),
        Stock("M+M2", "M", "M_plus_M2_reference.fasta"),
        Stock("OptM", "M", "OptM_reference.fasta"),
        Stock("NIRM", "M", "NIRM_reference.fasta"),
        Stock("dGYM", "M", "dGYM_reference.fasta"),
        Stock("V67M", "M", "V67M_reference.fasta"),
        Stock("SHIV_ADE08M", "M", "SHIV_ADE08M_reference.fasta"),
        Stock("SHIV_174M", "M", "SHIV_174M_reference.fasta"),
        Stock("SHIV_224M", "M", "SHIV_224M_reference.fasta"),
        Stock("SHIV_304M", "M", "SHIV_304M_reference.fasta"),
        Stock("SHIV_1051M", "M", "SHIV_1051M_reference.fasta"),
        Stock("SHIV_1054M", "M", "SHIV_1054M_reference.fasta"),
        Stock("SL8_239M", "SL8_bc", "239M_reference.fasta"),
        Stock("TAT_SL8", "SL8_epi", "Epitope_reference.fasta"),
        Stock("M_discover", "M", None, True),
        Stock("X_discover", "X", None, True),
        Stock("preVIF_discover", "pre_VIF", None, True),
        Stock("postVIF_discover", "post_VIF", None, True),
    )
}
#: Stocks that screening leaves out, the control, and the files of primers.
SCREEN_EXCLUDED = frozenset({"239M", "239M2", "SHIV_174M"})
CONTROL = Stock("Spike", "M", "Spike_reference.fasta")
P5_FILE, P7_FILE = "P5_primers.csv", "P7_primers.csv"


def stock_profile(stock: str, dual: bool = False) -> tuple[Stock, ReadProfile]:
    """A stock and its profile; without dual the second index is dropped, with it the profile must have one."""
    if stock not in STOCKS:
        raise ValueError(f"unknown stock {stock!r}; known: {', '.join(STOCKS)}")
    found = STOCKS[stock]
    profile = PROFILES[found.profile]
    if dual and profile.dual is None:
        raise ValueError(f"profile {profile.name} has no second index")
    return found, profile if dual else replace(profile, dual=None)


def read_profile(path: str, dual: bool = False) -> tuple[Stock, ReadProfile]:
    """A stock and profile of the caller's own, from a JSON file: the fields of ReadProfile (dual those of DualIndex), reference or discover."""
    with open(path) as f:
        given = json.load(f)
    stock = Stock(given["name"], given["name"], given.pop("reference", None), bool(given.pop("discover", False)))
    if stock.fasta is None and not stock.discover:
        raise ValueError("a profile needs a reference, or discover")
    second = given.pop("dual", None)
    if dual and second is None:
        raise ValueError(f"profile {stock.name} has no second index")
    core = given.pop("core", None)
    return stock, ReadProfile(**given, core=tuple(core) if core else None, dual=DualIndex(**second) if dual else None)


def screen_stocks() -> list[Stock]:
    """Stocks with a reference that screening matches against."""
    return [s for s in STOCKS.values() if s.fasta and s.name not in SCREEN_EXCLUDED]


def screen_profiles() -> list[ReadProfile]:
    """Profiles that screening tries, each once."""
    return list(PROFILES.values())
