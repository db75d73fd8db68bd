"""Regnal calendar of roll numbers: four terms a year from Michaelmas 1399."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rolls that the rule covers, its terms in order, and the accession years of the reigns it spans.
FIRST_ROLL, LAST_ROLL, FIRST_YEAR = 555, 650, 1399
TERMS = ("Hilary", "Easter", "Trinity", "Michaelmas")
REIGNS = (("Henry IV", 1399), ("Henry V", 1413), ("Henry VI", 1422))


def roll_year(roll: Column) -> Column:
    return F.when(roll.between(FIRST_ROLL, LAST_ROLL), FIRST_YEAR + F.floor((roll - FIRST_ROLL + 3) / 4)).cast("int")


def roll_term(roll: Column) -> Column:
    at = F.pmod(roll - FIRST_ROLL + 3, F.lit(4))
    return F.when(roll.between(FIRST_ROLL, LAST_ROLL), F.element_at(F.array(*map(F.lit, TERMS)), (at + 1).cast("int")))


def regnal_year(year: Column, term: Column) -> Column:
    """``1 Henry IV``: a reign's years begin with Michaelmas for the first king and in spring for his heirs."""
    out = None
    for (king, start), begins in zip(reversed(REIGNS), (3, 1, 3)):
        at = F.array_position(F.array(*map(F.lit, TERMS)), term) - 1
        count = year - start + F.when(at >= begins, 1).otherwise(0)
        text = F.concat_ws(" ", count.cast("string"), F.lit(king))
        out = F.when(count >= 1, text) if out is None else out.when(count >= 1, text)
    return F.when(year.isNotNull() & term.isNotNull(), out)
