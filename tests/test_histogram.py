import math

from pyspark.sql import functions as F

from strandframe.model import BitVectorConfig, StricterConstraints
from strandframe.operators import filters, histogram, reports, trials


def fragments(spark, rows):
    df = spark.createDataFrame(rows, "qname string, rname string, sequence string, mapqs array<int>, lengths array<int>, bits array<struct<pos:int,bit:string>>")
    return df.withColumn("ref_length", F.length("sequence"))


def test_counts_and_statistics(spark):
    rows = [
        ("a", "r", "ACGT", [40], [4], [(1, "0"), (2, "T"), (3, "?"), (4, "1"), (5, "*")]),
        ("b", "r", "ACGT", [40], [4], [(1, "G"), (2, "0")]),
        ("c", "r", "ACGT", [10], [4], [(1, "G")]),
        ("d", "r", "ACGT", [40], [4], []),
    ]
    judged = filters.with_reason(fragments(spark, rows))
    refs = spark.createDataFrame([("r", "ACGT"), ("empty", "GGG")], "rname string, sequence string")
    pos = histogram.positions(judged)
    assert {(r["pos"], r["cov"], r["info"], r["mut"], r["del"]) for r in pos.collect()} == {(1, 2, 2, 1, 0), (2, 2, 2, 1, 0), (3, 0, 1, 0, 0), (4, 1, 1, 0, 1)}
    every = histogram.with_all_references(histogram.read_counts(judged), refs)
    counts = {r["rname"]: r for r in every.collect()}
    assert (counts["r"]["num_reads"], counts["r"]["num_aligned"], counts["r"]["low_mapq"], counts["empty"]["num_reads"]) == (4, 3, 1, 0)
    dense = histogram.dense_positions(pos, refs)
    avg = {(r["rname"], r["position"]): r["mismatches"] for r in histogram.population_average(dense).collect()}
    assert avg["r", 1] == 0.5 and avg["r", 4] == 0.0 and math.isnan(avg["empty", 1])
    out = {r["name"]: r for r in histogram.summary(refs, pos, histogram.mutation_counts(judged), histogram.read_counts(judged)).collect()}
    assert out["r"]["aligned"] == 75.0 and out["r"]["no_mut"] == 33.33 and out["r"]["1_mut"] == 66.67 and out["r"]["sn"] == 0.0
    assert out["empty"]["aligned"] == 0.0 and out["empty"]["sn"] is None


def test_published_percentages(spark):
    nmut = spark.createDataFrame([("m", k, n) for k, n in enumerate([1157, 845, 274, 71, 8, 1])], "rname string, n_mut int, reads long")
    counts = spark.createDataFrame([("m", 2357, 2356)], "rname string, num_reads long, num_aligned long")
    row = histogram.percent_mutations(nmut, counts).first()
    assert [row[c] for c in ("no_mut", "1_mut", "2_mut", "3_mut", "3plus_mut")] == [49.11, 35.87, 11.63, 3.01, 0.04]


def test_shares_straight_from_fragments(spark, monkeypatch):
    from strandframe.plans import catalogue

    judged = spark.createDataFrame([("r", n, None) for n in (0, 0, 1, 2, 3, 4, 5, 60)] + [("r", 1, "low_mapq"), ("low", 1, "low_mapq")], "rname string, n_mut int, reason string")
    refs = spark.createDataFrame([("r",), ("low",), ("empty",)], "rname string")
    got = sorted(map(tuple, histogram.fragment_shares(judged, refs).collect()))
    assert got == [("empty", 0.0, 0.0, 0.0, 0.0, 0.0), ("low", 0.0, 0.0, 0.0, 0.0, 0.0), ("r", 25.0, 12.5, 12.5, 12.5, 25.0)]
    assert got == sorted(map(tuple, histogram.percent_mutations(histogram.mutation_counts(judged), histogram.with_all_references(histogram.read_counts(judged), refs)).collect()))
    # no table of counts is written, and what is aggregated moves once, as a row for each reference
    monkeypatch.setattr(catalogue, "stage", lambda *_: 1 / 0)
    plan = catalogue.percent_mutations(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(keys=[rname") == plan.count("HashAggregate(") == 2


def test_a_report_joins_only_what_its_columns_need(spark, monkeypatch):
    from strandframe.plans import catalogue

    judged = spark.createDataFrame([("r", n, None) for n in (0, 0, 2)] + [("r", 1, "low_mapq"), ("low", 1, "low_mapq")], "rname string, n_mut int, reason string")
    refs = spark.createDataFrame([("r", "ACGT"), ("low", "AC"), ("empty", "")], "rname string, sequence string")
    tallied = histogram.fragment_counts(judged)
    few = histogram.report(refs, tallied, ("name", "num_of_mutations"))
    assert sorted(map(tuple, few.collect())) == [("empty", [0]), ("low", [0, 0, 0]), ("r", [2, 0, 1, 0, 0])]
    more = histogram.report(refs, tallied, ("name", "sequence", "reads", "no_mut", "num_of_mutations"))
    assert sorted(map(tuple, more.collect())) == [("empty", "", 0, 0.0, [0]), ("low", "AC", 1, 0.0, [0, 0, 0]), ("r", "ACGT", 4, 66.67, [2, 0, 1, 0, 0])]
    assert few._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    # the counts are read once, so no table of them is written
    monkeypatch.setattr(catalogue, "stage", lambda *_: 1 / 0)
    assert catalogue.report_mutations(spark, "/root/testdata/sf0.001").columns == ["name", "n_mut", "reads"]


def test_filters_in_order(spark):
    long_ = "A" * 100
    rows = [
        ("ok", "r", long_, [40], [90], [(1, "C"), (10, "C")]), ("far", "r", long_, [40], [90], [(1, "C"), (7, "C")]), ("close", "r", long_, [40], [90], [(1, "C"), (6, "C")]),
        ("many", "r", long_, [40], [90], [(1, "C"), (10, "C"), (20, "C")]), ("short", "r", long_, [40], [9], [(1, "C"), (2, "C")]), ("low", "r", long_, [40, 3], [9, 9], []),
    ]
    config = BitVectorConfig(stricter=StricterConstraints(5, 0.1, 2))
    got = {r["qname"]: r["reason"] for r in filters.with_reason(fragments(spark, rows), config).collect()}
    assert got == {"ok": None, "far": None, "close": "muts_too_close", "many": "too_many_muts", "short": "short_read", "low": "low_mapq"}


def test_merging_adds_up(spark):
    one = spark.createDataFrame([("r", 1, 2, 2, 1, 1, 0, 1, 0, 0, 0)], "rname string, pos int, cov long, info long, mut long, del long, ins long, A long, C long, G long, T long")
    both = histogram.merge_positions([one, one]).first()
    assert (both["info"], both["del"]) == (4, 2)
    assert histogram.merge_positions([one, one], strict=True).first()["del"] == 1
    a, b = (spark.createDataFrame([("r", s, "x")], "rname string, sequence string, structure string") for s in ("AC", "AG"))
    assert [r["field"] for r in histogram.merge_conflicts([a, b], by=("sequence", "structure")).collect()] == ["sequence"]


def test_differences(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "k int, v double")
    b = spark.createDataFrame([(1, 1.005), (2, 2.0), (4, 1.0)], "k int, v double")
    assert {r["difference"]: r["n"] for r in reports.differences(a, b, ["k"]).collect()} == {"values": 1, "only left": 1, "only right": 1}
    assert {r["difference"] for r in reports.differences(a, a, ["k"]).collect()} == {"none"}
    assert {r["difference"] for r in reports.differences(a.limit(2), b.limit(2), ["k"], 0.01).collect()} == {"none"}


def test_differences_by_blocks(spark):
    rows = [("a", i, i % 7) for i in range(1, 3000)] + [("b", 5, 1), ("c", 5, 1), (None, 5, 1)]
    a = spark.createDataFrame(rows, "rname string, pos int, n long")
    b = a.filter("not (rname = 'a' and pos in (7, 2900)) and rname <> 'b' or rname is null").withColumn("n", F.when(F.col("pos") == 1500, 99).otherwise(F.col("n")))
    b = b.unionByName(spark.createDataFrame([("d", 1, 1), ("a", 9000, 1)], a.schema))
    for left, right in ((a, b), (b, a), (a, a), (a.limit(0), b), (a.limit(0), a.limit(0))):
        got, want = reports.block_differences(left, right, ["rname", "pos"]), reports.differences(left, right, ["rname", "pos"])
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {tuple(r) for r in reports.block_differences(a, b, ["rname", "pos"]).collect()} == {("only left", 3), ("only right", 2), ("values", 1)}


def test_whole_and_merged_counts_meet_as_blocks(spark, monkeypatch):
    from strandframe.plans import catalogue

    met = []
    monkeypatch.setattr(reports, "block_differences", lambda a, b, keys: met.append((a, b, keys)) or a)
    catalogue.impl_diff(spark, "/root/testdata/sf0.001")
    (_, merged, keys), = met
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert keys == ["rname", "pos"] and "Exchange hashpartitioning(rname" in plan and ", pos" not in " ".join(x for x in plan.splitlines() if "Exchange" in x)


def test_alignment_log(spark):
    text = "1000 reads; of these:\n  400 (40.00%) aligned 0 times\n  500 (50.00%) aligned exactly 1 time\n  100 (10.00%) aligned >1 times\n60.00% overall alignment rate"
    row = spark.createDataFrame([(text,)], "t string").select(reports.parse_alignment_log(F.col("t")).alias("x")).first()["x"]
    assert (row["total_reads"], row["unaligned_count"], row["unique_percent"], row["overall_alignment_rate"], row["discordant_count"]) == (1000, 400, 50.0, 60.0, None)


def test_trials(spark):
    t = spark.createDataFrame([(1, 0.9, "a", "x"), (2, 0.8, "b", "x"), (3, 0.7, "b", None), (4, 0.0, "c", "y")], "trial int, quality_score double, p string, q string")
    best = trials.top(t, 3)
    modes = {r["param"]: r for r in trials.modes(trials.frequency(trials.long(best))).collect()}
    assert modes["p"]["value"] == "b" and modes["q"]["most_common_frequency"] == 1.0
    assert {r["class"] for r in trials.classes(trials.modes(trials.frequency(trials.long(best)))).collect()} == {"high", "constant"}


def test_vectors_are_packed_before_they_move(spark):
    rows = [("q1", "r", [(-1, "A"), (0, "0"), (1, "C"), (2, "?"), (3, "1")], None), ("q2", "r", [(2, "."), (3, "N"), (4, "*"), (5, "A"), (6, "G")], None), ("q3", "r", [(1, "T"), (4, "0"), (5, "")], None),
            ("q4", "r", [], None), ("q5", "r", [(1, "A")], "low_mapq"), ("q6", "s", [(9, "A")], None), ("q7", "s", [(4, "xy"), (5, "A")], None)]
    kind = "qname string, rname string, bits array<struct<pos:int,bit:string>>, reason string"
    judged = spark.createDataFrame(rows, kind).withColumn("ref_length", F.lit(5)).withColumn("n_mut", F.lit(1))
    want: dict = {}
    for _, name, bits, reason in rows:
        for pos, bit in bits if reason is None else []:
            if 1 <= pos <= 5:
                c = want.setdefault((name, pos), [0] * 9)
                for i, x in enumerate((bit != "?", True, bit in tuple("ACGT"), bit == "1", False, *(bit == b for b in "ACGT"))):
                    c[i] += x
    for table in (histogram.positions(judged), histogram.of_positions(histogram.tallies(judged))):
        assert {(r["rname"], r["pos"]): [r[c] for c in histogram.SUMS] for r in table.collect()} == want
    tallied = histogram.tallies(judged)
    assert sorted(map(tuple, histogram.of_reads(tallied).collect())) == sorted(map(tuple, histogram.of_reads(histogram.fragment_counts(judged)).collect())) == [("r", 5, 4, 1, 0, 0, 0), ("s", 2, 2, 0, 0, 0, 0)]
    plan = histogram.positions(judged)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_dense_positions_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(histogram, "BLOCK", 4)
    refs = spark.createDataFrame([("a", "ACGTACGTAC"), ("b", "ACGT"), ("c", "")], "rname string, sequence string")
    pos = spark.createDataFrame([("a", 1, 7), ("a", 9, 3), ("a", 11, 1), ("a", 0, 1), ("z", 1, 1)], "rname string, pos int, cov long")
    pos = pos.select("*", *[F.lit(0).cast("long").alias(c) for c in histogram.SUMS if c != "cov"])
    got = {(r["rname"], r["pos"]): (r["nuc"], r["cov"]) for r in histogram.dense_positions(pos, refs).collect()}
    assert got == {("a", i + 1): (x, {0: 7, 8: 3}.get(i, 0)) for i, x in enumerate("ACGTACGTAC")} | {("b", i + 1): (x, 0) for i, x in enumerate("ACGT")}
    assert {r["rname"]: [s["pos"] for s in r["series"]] for r in histogram.dense_series(pos, refs).collect()} == {"a": list(range(1, 11)), "b": [1, 2, 3, 4]}


def test_only_the_sums_asked_for_move(spark):
    refs = spark.createDataFrame([("a", "ACGT"), ("b", "GG")], "rname string, sequence string")
    pos = spark.createDataFrame([("a", 1, 7, 2), ("a", 3, 5, 4)], "rname string, pos int, mut long, cov long")
    pos = pos.select("*", *[F.lit(0).cast("long").alias(c) for c in histogram.SUMS if c not in ("mut", "cov")])
    few = histogram.dense_positions(pos, refs, ("mut",))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, histogram.dense_positions(pos, refs).select("rname", "pos", "nuc", "mut").collect()))
    out = histogram.summary(refs, pos, spark.createDataFrame([], "rname string, n_mut int, reads long"), spark.createDataFrame([], "rname string, num_reads long, num_aligned long"))
    lists = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "collect_list" in x]
    assert lists and not any("cov" in x for x in lists)


def test_structures_are_never_broadcast_by_position(spark):
    shapes = spark.createDataFrame([("a", "A", ".")], "name string, sequence string, structure string")
    dense = spark.createDataFrame([("a", 1, "A", 1, 0, 1)], "rname string, pos int, nuc string, mut long, del long, info long")
    averaged = histogram.population_average(dense, shapes)
    assert "BroadcastHashJoin" not in averaged._jdf.queryExecution().executedPlan().toString() and averaged.first()["structure"] == "."
