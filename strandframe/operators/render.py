"""Vectors as text and as sparse maps, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandframe.functions.columns import is_base, is_letter
from strandframe.model import ABSENT, AMBIGUOUS, BITS, DELETION


def dense_text(bits: Column, start: Column, end: Column) -> Column:
    """One character for each position from start to end.

    A vector without gaps is its symbols between what is absent on both sides; only one with gaps is looked up by position.
    """
    inside = F.filter(bits, lambda b: (b["pos"] >= start) & (b["pos"] <= end))
    return F.element_at(F.transform(F.array(inside), lambda v: dense_inside(v, start, end)), 1)


def dense_inside(inside: Column, start: Column, end: Column) -> Column:
    """dense_text() of a vector that lies between start and end."""
    first, last = F.element_at(inside, 1)["pos"], F.element_at(inside, -1)["pos"]
    found = F.map_from_entries(inside)
    gapless = F.concat(F.repeat(F.lit(ABSENT), first - start), F.array_join(F.transform(inside, lambda b: F.coalesce(b["bit"], F.lit(ABSENT))), ""), F.repeat(F.lit(ABSENT), end - last))
    looked_up = _looked_up(found, start, end)
    return F.when(end < start, F.lit("")).when(F.size(inside) == 0, F.repeat(F.lit(ABSENT), end - start + 1)).when(last - first + 1 == F.size(inside), gapless).otherwise(looked_up)


def _looked_up(found: Column, start: Column, end: Column) -> Column:
    return F.when(end < start, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(start.cast("int"), end.cast("int")), lambda p: F.coalesce(F.element_at(found, p), F.lit(ABSENT))), ""))


def letter_count(bits: Column, start: Column, end: Column) -> Column:
    """Letters, of whatever kind, from start to end."""
    return F.size(F.filter(bits, lambda b: is_letter(b["bit"]) & (b["pos"] >= start) & (b["pos"] <= end)))


def from_dense(text: Column, start: Column) -> Column:
    """The vector of a dense text."""
    each = F.transform(F.split(text, ""), lambda c, i: F.struct((start + i).cast("int").alias("pos"), c.alias("bit")))
    return F.when(F.length(text) == 0, F.array().cast(BITS)).otherwise(F.filter(each, lambda b: (b["bit"] != ABSENT) & (b["bit"] != "")))


def sparse_text(bits: Column, kind: str) -> Column:
    """``pos:bit`` of a kind (muts, dels, ambigs), joined by commas."""
    wanted = {"muts": is_base, "dels": lambda b: b == DELETION, "ambigs": lambda b: b == AMBIGUOUS}[kind]
    return F.array_join(F.transform(F.filter(bits, lambda b: wanted(b["bit"])), lambda b: F.concat_ws(":", b["pos"].cast("string"), b["bit"])), ",")


def sparse_map(bits: Column, kind: str) -> Column:
    """map<int,string> of a kind."""
    wanted = {"muts": is_base, "dels": lambda b: b == DELETION, "ambigs": lambda b: b == AMBIGUOUS}[kind]
    return F.map_from_entries(F.filter(bits, lambda b: wanted(b["bit"])))
