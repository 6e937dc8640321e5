"""Symbols, parameters and schemas."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from typing import Any

from pyspark.sql import types as T

# The symbols of a bit vector.
MISSING, AMBIGUOUS, MATCH, DELETION, ABSENT = "*", "?", "0", "1", "."
BASES = ("A", "C", "G", "T")
#: Rejection reasons in the order in which they are tried.
REASONS = ("low_mapq", "short_read", "too_many_muts", "muts_too_close")


class MapError(Exception):
    """Base of this package's errors."""


class InputError(MapError):
    """An input file or table breaks a rule."""


class MissingRequirement(MapError):
    """Something that a run needs isn't there."""


class ExternalProgramError(MapError):
    """A program outside Spark that a run relies on failed."""


@dataclass(frozen=True)
class StricterConstraints:
    min_mut_distance: int = 5
    percent_length_cutoff: float = 0.10
    mutation_count_cutoff: int = 5


@dataclass(frozen=True)
class BitVectorConfig:
    """stricter: the three further filters, off unless given. cigar_mode: "basic" knows M, D, I and S, and any other
    letter empties the vector; "sam" also takes = and X as matches, N as a deletion, H and P as nothing."""

    qscore_cutoff: int = 25
    map_score_cutoff: int = 15
    num_of_surbases: int = 10
    stricter: StricterConstraints | None = None
    cigar_mode: str = "basic"
    storage_format: str = "text"
    summary_output_only: bool = False

    def __post_init__(self) -> None:
        if self.cigar_mode not in ("basic", "sam"):
            raise InputError(f"unknown cigar_mode: {self.cigar_mode}")
        if self.storage_format not in ("text", "json"):
            raise InputError(f"unknown storage format: {self.storage_format}")

    @classmethod
    def from_dict(cls, values: dict[str, Any]) -> BitVectorConfig:
        """From nested parameters; unknown keys are errors."""
        values = dict(values)
        strict = values.pop("stricter", None)
        unknown = set(values) - {f.name for f in fields(cls)}
        if unknown:
            raise InputError(f"unknown parameters: {', '.join(sorted(unknown))}")
        if strict is not None:
            extra = set(strict) - {f.name for f in fields(StricterConstraints)}
            if extra:
                raise InputError(f"unknown parameters: {', '.join(sorted(extra))}")
            strict = StricterConstraints(**strict)
        return cls(**values, stricter=strict)

    def stricter_with(self, **values: Any) -> BitVectorConfig:
        return replace(self, stricter=replace(self.stricter or StricterConstraints(), **values))


@dataclass(frozen=True)
class Sample:
    sample_id: str
    fasta: str
    fastq1: str
    fastq2: str | None = None
    dot_bracket: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def is_paired(self) -> bool:
        return bool(self.fastq2)


REFS = T.StructType([T.StructField("rname", T.StringType()), T.StructField("sequence", T.StringType())])
ALIGNED = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("qname", "flag", "rname")]
    + [T.StructField(n, T.IntegerType()) for n in ("pos", "mapq")]
    + [T.StructField(n, T.StringType()) for n in ("cigar", "rnext")]
    + [T.StructField(n, T.IntegerType()) for n in ("pnext", "tlen")]
    + [T.StructField(n, T.StringType()) for n in ("seq", "qual", "md_string")]
)
BITS = "array<struct<pos:int,bit:string>>"
