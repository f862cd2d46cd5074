"""Pipeline stages of the CRM and their spellings."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard stages, the lower-case spellings that map to them, and the
# stage a CRM row without one gets. "closed lost" with a space is not a known spelling.
STANDARD_STAGES = ("Lead", "Qualified", "Demo", "Proposal", "Closed Won", "Closed Lost")
SPELLINGS = {
    "lead": "Lead",
    "qualified": "Qualified",
    "demo": "Demo",
    "proposal": "Proposal",
    "won": "Closed Won",
    "closed_won": "Closed Won",
    "closed_lost": "Closed Lost",
}
DEFAULT_STAGE = "Lead"


def standard_stage(stage: Column) -> Column:
    """Known spelling to its standard stage; an unknown one stays as it is."""
    known = F.create_map(*(F.lit(text) for text in chain.from_iterable(SPELLINGS.items())))
    return F.coalesce(known[F.lower(stage)], stage, F.lit(DEFAULT_STAGE))


def is_nonstandard(stage: Column) -> Column:
    return stage.isNotNull() & ~stage.isin(*STANDARD_STAGES)
