"""BAM files made here, read in many partitions, against SAM."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandframe.sources import bam, files

REFS = [("chr1", 5000), ("chr2", 3000), ("x" * 40, 10)]


def block(data):
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return bam.MAGIC + struct.pack("<H", len(bam.MAGIC) + 2 + len(body) + 8 - 1) + body + struct.pack("<II", zlib.crc32(data), len(data))


def record(qname, flag, ref, pos, mapq, cigar, next_ref, next_pos, tlen, seq, qual, tags=b""):
    ops = struct.pack(f"<{len(cigar)}I", *[n << 4 | bam.OPS.index(o) for n, o in cigar])
    codes = [bam.SEQ.index(c) for c in seq] + [0] * (len(seq) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True))
    name = qname.encode() + b"\0"
    body = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name), mapq, 4680, len(cigar), flag, len(seq), next_ref, next_pos - 1, tlen) + name + ops + packed + (bytes(ord(c) - 33 for c in qual) if qual else b"\xff" * len(seq)) + tags
    return struct.pack("<i", len(body)) + body


def line(qname, flag, ref, pos, mapq, cigar, next_ref, next_pos, tlen, seq, qual, md=""):
    names = [n for n, _ in REFS]
    rnext = "*" if next_ref < 0 else "=" if next_ref == ref else names[next_ref]
    return (qname, str(flag), names[ref] if ref >= 0 else "*", pos, mapq, "".join(f"{n}{o}" for n, o in cigar) or "*", rnext, next_pos, tlen, seq or "*", qual or "*", md)


def made(n, seed, longest=300):
    rng = np.random.default_rng(seed)
    records, lines = [], []
    for i in range(n):
        size = int(rng.integers(0, longest))
        seq, ref = "".join(rng.choice(list("ACGTN"), size)), int(rng.integers(-1, 3))
        cigar = [(int(rng.integers(1, 300)), bam.OPS[k]) for k in rng.integers(0, 9, int(rng.integers(0, 5)))]
        qual = "".join(chr(33 + int(q)) for q in rng.integers(0, 60, size)) if rng.random() < 0.9 else ""
        read = (f"read:{i}", int(rng.integers(0, 4096)), ref, int(rng.integers(0, 4000)), int(rng.integers(0, 60)), cigar, int(rng.choice([-1, ref, 1])), int(rng.integers(0, 99)), int(rng.integers(-500, 500)), seq, qual)
        md = f"{i % 50}A3" if i % 3 else ""
        tags = b"NMC\x01XBBS\x02\x00\x00\x00\x01\x00\x02\x00RGZgroup\0" + (b"MDZ" + md.encode() + b"\0" if md else b"") + b"XFf\0\0\x80?"
        records.append(record(*read, tags))
        lines.append(line(*read, md))
    return records, lines


def written(path, records, size):
    """A BAM file whose blocks have ``size`` bytes each, wherever reads end; None: a block for each 20 reads."""
    text = "@HD\tVN:1.6\n" + "".join(f"@SQ\tSN:{n}\tLN:{m}\n" for n, m in REFS)
    head = b"BAM\x01" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(REFS)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", m) for n, m in REFS)
    if size is None:
        contents = [head, *(b"".join(records[i : i + 20]) for i in range(0, len(records), 20))]
    else:
        data = head + b"".join(records)
        contents = [data[i : i + size] for i in range(0, len(data), size)]
    path.write_bytes(b"".join(map(block, contents)) + block(b""))


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture()
def narrow(spark, monkeypatch):
    monkeypatch.setattr(bam, "PIECE", 4)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size", [None, 700, 3001])
def test_reads_equal_those_written(spark, tmp_path, narrow, size):
    records, lines = made(400, 1)
    written(tmp_path / "a.bam", records, size)
    more, others = made(90, 2)
    written(tmp_path / "b.bam", more, size)
    assert spark.read.text(str(tmp_path / "a.bam")).rdd.getNumPartitions() > 4
    got = bam.bam(spark, str(tmp_path))
    assert rows(got) == sorted(lines + others)
    assert rows(bam.bam(spark, str(tmp_path / "a.bam"), mapped_only=True)) == sorted(x for x in lines if not int(x[1]) & 4)


def test_equals_sam(spark, tmp_path):
    records, lines = made(60, 3, 50)
    lines = [x for x in lines]
    written(tmp_path / "a.bam", records, None)
    (tmp_path / "a.sam").write_text("@HD\tVN:1.6\n" + "".join("\t".join(map(str, x[:11])) + (f"\tMD:Z:{x[11]}" if x[11] else "") + "\n" for x in lines))
    sam = files.sam(spark, str(tmp_path / "a.sam"))
    assert rows(bam.bam(spark, str(tmp_path / "a.bam")).select(*sam.columns)) == rows(sam)


def test_no_reads_and_broken_files(spark, tmp_path, narrow):
    written(tmp_path / "none.bam", [], None)
    assert bam.bam(spark, str(tmp_path / "none.bam")).count() == 0
    records, _ = made(200, 4)
    written(tmp_path / "x.bam", records, 700)
    whole = (tmp_path / "x.bam").read_bytes()
    (tmp_path / "cut.bam").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "text.bam").write_text("not compressed at all")
    places = [i for i in range(len(whole)) if whole.startswith(bam.MAGIC, i)]
    (tmp_path / "lost.bam").write_bytes(whole[: places[10]] + whole[places[11] :])
    for name, message in (("cut.bam", "a block of"), ("text.bam", "not a BGZF file"), ("lost.bam", "don't meet")):
        with pytest.raises(Exception, match=message):
            bam.bam(spark, str(tmp_path / name)).agg(F.count("qname")).collect()
