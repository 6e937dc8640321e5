"""Column expressions that the operators are built of."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandframe.model import BASES


def py_slice(s: Column, a: Column, b: Column) -> Column:
    """s[a:b] with the rules for negative and too large bounds that Python has."""
    n = F.length(s)

    def bound(x: Column) -> Column:
        return F.when(x < 0, F.greatest(x + n, F.lit(0))).otherwise(F.least(x, n))

    lo, hi = bound(a), bound(b)
    return F.when(hi > lo, F.substr(s, lo + 1, hi - lo)).otherwise(F.lit(""))


def char_at(s: Column, i: Column) -> Column:
    """The character at 1-based place i."""
    return F.substr(s, i, F.lit(1))


def phred(quality: Column) -> Column:
    """The score of a quality character."""
    return F.ascii(quality) - 33


def is_base(bit: Column) -> Column:
    return bit.isin(*BASES)


def is_letter(bit: Column) -> Column:
    return (F.length(bit) == 1) & (bit.between("A", "Z") | bit.between("a", "z"))


def cigar_ops(cigar: Column, letters: str = "[A-Z]") -> Column:
    """array<struct<len:int,op:string>> of a CIGAR string; what is no length and letter is passed over."""
    pattern = F.lit(f"([0-9]+)({letters})")
    lengths = F.transform(F.regexp_extract_all(cigar, pattern, F.lit(1)), lambda x: x.cast("int"))
    return F.zip_with(lengths, F.regexp_extract_all(cigar, pattern, F.lit(2)), lambda n, op: F.struct(n.alias("len"), op.alias("op")))


def deletion_is_ambiguous(sequence: Column, end: Column, size: Column, around: int) -> Column:
    """Whether a deletion of this size that ends at 1-based place end could as well end at most size places away, by the
    bases up to ``around`` places on both sides."""
    lo = end - size - around
    hi = end + around

    def flanks(e: Column) -> Column:
        return F.concat(py_slice(sequence, lo, e - size), py_slice(sequence, e, hi))

    own = flanks(end)
    return F.exists(F.sequence(end - size, end + size), lambda e: (e != end) & (flanks(e) == own))


def half_even(x: Column, digits: int) -> Column:
    """x rounded to digits: the nearest whole number of its multiple in binary, half to even (bround goes by decimals)."""
    return F.rint(x * 10.0**digits) / 10.0**digits


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; NaN where b is 0."""
    return F.when(b == 0, F.lit(float("nan"))).otherwise(a.cast("double") / F.nullif(b, F.lit(0)).cast("double"))


def resolve_bits(a: Column, b: Column) -> Column:
    """The symbol of a position that both mates cover."""
    def either(symbol: str) -> Column:
        return F.when(a == symbol, b).when(b == symbol, a)

    clash = (is_base(a) & is_base(b)) | (is_base(a) & (b == "1")) | ((a == "1") & is_base(b))
    return F.when(a.isNull(), b).when(b.isNull() | (a == b), a).when((a == "0") | (b == "0"), F.lit("0")).otherwise(F.coalesce(either("?"), either("*"), F.when(clash, F.lit("?")), a))
