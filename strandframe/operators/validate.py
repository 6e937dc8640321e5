"""Checks of inputs. Each gives a table of violations, empty if all is well; require() makes the first an error."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.model import InputError, MissingRequirement
from strandframe.sources import files


def fasta_violations(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, message) of FASTA files that must have a name line and a line of A, C, G, T by turns. Lines are numbered
    across splits, so a file of any size is checked by many tasks."""
    lines = files.numbered_lines(spark, path)
    v, even = F.regexp_replace("value", r"\s+$", ""), F.col("line") % 2 == 0
    message = F.when(F.length(v) == 0, "blank line").when(even & ~v.startswith(">"), "a name line must start with >").when(even & v.startswith("> "), "no space may follow >").when(~even & v.startswith(">"), "a sequence line may not start with >").when(~even & ~v.rlike("^[ACGT]+$"), "a sequence may have only A, C, G and T")
    return lines.select("file", "line", message.alias("message")).filter("message is not null")


def fasta_warnings(spark: SparkSession, path: str, most: int = 1000) -> list[str]:
    """Messages about what is allowed, but unusual: more than so many sequences."""
    n = files.fasta(spark, path).count()
    return [f"{n} sequences, which is more than {most}"] if n > most else []


def fastq_violations(spark: SparkSession, path: str, by_folder: bool = False) -> DataFrame:
    """(file, number, message) of the records of FASTQ files; by_folder: of those of folders whose files are pieces of one."""
    reads = files.fastq_records(spark, path, by_folder)
    message = F.when(~F.coalesce(F.col("head").startswith("@"), F.lit(False)), "a record must start with @").when(F.col("qual").isNull(), "record is cut off").when(~F.col("plus").startswith("+"), "the third line of a record must start with +").when(F.length("seq") != F.length("qual"), "sequence and qualities differ in length")
    return reads.select("file", "number", message.alias("message")).filter("message is not null")


def structure_violations(refs: DataFrame, structures: DataFrame) -> DataFrame:
    """(name, message): names that the references lack, references without a structure, repeated names."""
    both = refs.select("rname").join(structures.groupBy("name").agg(F.count("*").alias("rows")), F.col("rname") == F.col("name"), "full")
    message = F.when(F.col("rname").isNull(), "no such reference").when(F.col("name").isNull(), "no structure").when(F.col("rows") > 1, "name is repeated")
    return both.select(F.coalesce("name", "rname").alias("name"), message.alias("message")).filter("message is not null")


def table_violations(structures: DataFrame, refs: DataFrame) -> DataFrame:
    """(name, message) of a table of structures: columns it lacks, another number of rows than references, and
    structure_violations()."""
    spark = refs.sparkSession
    lacking = [c for c in ("name", "sequence", "structure") if c not in structures.columns]
    if lacking:
        return spark.createDataFrame([(c, "no such column") for c in lacking], "name string, message string")
    numbers = structures.agg(F.count("*").alias("s")).join(F.broadcast(refs.agg(F.count("*").alias("r"))))
    uneven = numbers.filter("s <> r").select(F.lit("").alias("name"), F.concat(F.col("s").cast("string"), F.lit(" rows for "), F.col("r").cast("string"), F.lit(" references")).alias("message"))
    return uneven.unionByName(structure_violations(refs, structures))


def validate_inputs(spark: SparkSession, fasta: str | None, fastq1: str | None, fastq2: str | None = None, structures: str | None = None) -> list[str]:
    """Check all inputs of a run: MissingRequirement if one that is needed isn't given, InputError for the first rule
    that is broken; the warnings. All files are read by Spark."""
    if not fasta or not fastq1:
        raise MissingRequirement("a run needs references (FASTA) and reads (FASTQ)")
    require(fasta_violations(spark, fasta), fasta)
    for path in filter(None, (fastq1, fastq2)):
        require(fastq_violations(spark, path), path)
    if structures:
        require(table_violations(spark.read.csv(structures, header=True), files.fasta(spark, fasta)), structures)
    return fasta_warnings(spark, fasta)


def first_violations(violations: DataFrame, *by: str) -> DataFrame:
    """The first violation of each group (of a file, say), by the other columns; partial minima before the shuffle."""
    order = [c for c in violations.columns if c not in by and c != "message"]
    first = violations.groupBy(*by).agg(F.min(F.struct(*order, "message")).alias("first"))
    return first.select(*by, *[f"first.{c}" for c in (*order, "message")])


def require(violations: DataFrame, what: str) -> None:
    """InputError with the first violation, by all columns but the message, if there is one."""
    where = [c for c in violations.columns if c != "message"]
    first = violations.orderBy(*where, "message").limit(1).collect()
    if first:
        raise InputError(f"{what}: {first[0]['message']} ({', '.join(f'{c} {first[0][c]}' for c in where if c != 'file')})")


def check_params(values: dict[str, Any], schema: dict[str, Any], path: str = "") -> list[str]:
    """Messages about nested parameters; schema: name -> type, or a nested schema."""
    out = []
    for key, value in values.items():
        where = f"{path}.{key}" if path else key
        want = schema.get(key)
        if want is None:
            out.append(f"unknown parameter {where}")
        elif isinstance(want, dict):
            out += check_params(value, want, where) if isinstance(value, dict) else [f"{where} must be a group of parameters"]
        elif not isinstance(value, want) or isinstance(value, bool) and want is not bool:
            out.append(f"{where} has the wrong type")
    return out
