"""Schemas, fixed lists and settings of the linkage library."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SOURCE = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
MATCHES = ("source1_entity_id", "matched_entity_ids")
CANDIDATES = ("source1_entity_id", "candidate_entity_ids")
PAIR = ("source1_entity_id", "candidate_entity_id")

# Abbreviations and stop words that results depend on.
NAME_ABBREVIATIONS = {"corporation": "corp", "corporate": "corp", "private": "pvt", "limited": "ltd"}
ADDRESS_ABBREVIATIONS = {"street": "st", "road": "rd", "avenue": "ave", "boulevard": "blvd", "lane": "ln", "drive": "dr", "apartment": "apt", "suite": "ste", "highway": "hwy"}
UNICODE_ADDRESS_ABBREVIATIONS = ADDRESS_ABBREVIATIONS | {"roadway": "rd"}
SECOND_WORD_STOPS = ["", "company", "corp", "group", "inc", "limited", "llc", "ltd", "pvt", "services"]
NAME_TOKEN_STOPS = "and associates co company consulting corp corporation enterprises foundation group inc limited llc ltd private pvt services solutions technologies the".split()
ADDRESS_TOKEN_STOPS = "apt ave avenue bangalore block blvd chennai city colony delhi district dr drive extn flat floor hwy hyderabad india kolkata lane ln mumbai nagar near no opp opposite plot pune rd road shop st state ste street us".split()
ADDRESS_PAIR_STOPS = "apartment avenue bangalore block chennai city colony delhi district drive extn flat floor highway hyderabad india kolkata lane mumbai nagar near opp opposite plot pune road roadway shop state street suite us".split()


@dataclass(frozen=True)
class Rule:
    """A blocking rule: caps on a key's counted rows of each side (None: no cap), and evidence
    for ranked rules (None: the rule's pairs are added after the ranking)."""

    id: str
    cap_left: int | None
    cap_right: int
    evidence: int | None


# Caps and evidence of the rules.
RULES = [
    Rule("B01", 300, 300, 10),
    Rule("B02", 80, 80, 9),
    Rule("B03", 200, 200, 8),
    Rule("B04", 80, 80, 7),
    Rule("B05", 200, 200, 6),
    Rule("B06", 100, 100, 5),
    Rule("B07", 120, 120, 4),
    Rule("B08", 250, 250, 4),
    Rule("B09", 250, 250, 3),
    Rule("B10", 200, 200, 2),
    Rule("B12", None, 100, None),
    Rule("B13", None, 100, None),
    Rule("B14", None, 50, None),
    Rule("B15", None, 80, None),
    Rule("B16", None, 50, None),
]


@dataclass(frozen=True)
class Settings:
    rules: tuple[str, ...] = tuple(r.id for r in RULES)
    top: int = 40
    pair_tokens: int | None = 5
    threshold: float = 0.97
    thresholds: tuple[float, ...] = (0.50, 0.60, 0.70, 0.80, 0.85, 0.90, 0.92, 0.95)
    fine: tuple[float, ...] = field(default_factory=lambda: tuple(round(0.80 + 0.01 * k, 2) for k in range(20)))
    train_negatives: int = 15
    valid_negatives: int = 25
    max_postings: int = 250
    max_per_entity: int = 300


DEFAULT = Settings()
