"""DuckDB SQL that computes the catalogue's queries independently, in long form: one row for each base."""

from __future__ import annotations

import re

from strandframe.plans import synth


def _slice(s: str, a: str, b: str) -> str:
    lo = f"(CASE WHEN {a} < 0 THEN greatest({a} + length({s}), 0) ELSE least({a}, length({s})) END)"
    hi = f"(CASE WHEN {b} < 0 THEN greatest({b} + length({s}), 0) ELSE least({b}, length({s})) END)"
    return f"(CASE WHEN {hi} > {lo} THEN substr({s}, {lo} + 1, {hi} - {lo}) ELSE '' END)"


_FLANKS = f"concat({_slice('sequence', '(e - n - 10)', '(e2 - n)')}, {_slice('sequence', 'e2', '(e + 10)')})"
_OWN = f"concat({_slice('sequence', '(e - n - 10)', '(e - n)')}, {_slice('sequence', 'e', '(e + 10)')})"

BASE = "('A', 'C', 'G', 'T')"

#: refs, structures, mates; ops (one row for each CIGAR op); bits1 (mate 1), bits2, paired.
CTES = f"""{synth.SQL.strip()},
op_lists AS (SELECT key, mate, pos, regexp_extract_all(cigar, '([0-9]+)([A-Z])', 1) AS ns, regexp_extract_all(cigar, '([0-9]+)([A-Z])', 2) AS ls FROM mates),
op_rows AS (SELECT key, mate, pos, len(ns) AS total, unnest(range(1, len(ns) + 1)) AS ord, unnest(ns)::INT AS n, unnest(ls) AS op FROM op_lists),
ops AS (SELECT key, mate, ord, n, op, ord = total AS is_last,
  (pos + coalesce(sum(CASE WHEN op IN ('M', 'D') OR op = 'S' AND ord = total THEN n ELSE 0 END) OVER w, 0))::INT AS i,
  coalesce(sum(CASE WHEN op IN ('M', 'I', 'S') THEN n ELSE 0 END) OVER w, 0)::INT AS j
  FROM op_rows WINDOW w AS (PARTITION BY key, mate ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
strange AS (SELECT DISTINCT key, mate FROM ops WHERE op NOT IN ('M', 'D', 'I', 'S')),
good AS (SELECT o.*, m.qname, m.rname, m.seq, m.qual, m.sequence FROM ops o JOIN mates m USING (key, mate) WHERE NOT EXISTS (SELECT 1 FROM strange s WHERE s.key = o.key AND s.mate = o.mate)),
steps AS (SELECT *, unnest(range(0, n)) AS k FROM good WHERE n > 0),
dels AS (SELECT key, mate, ord, n, sequence, i + n - 1 AS e FROM good WHERE op = 'D' AND n > 0),
ambig AS (SELECT key, mate, ord, bool_or(e2 <> e AND {_FLANKS} = {_OWN}) AS amb FROM (SELECT *, unnest(range(e - n, e + n + 1)) AS e2 FROM dels) GROUP BY ALL),
all_bits AS (SELECT s.key, s.mate, s.qname, s.rname, (s.i + s.k)::INT AS pos,
  CASE WHEN op = 'M' THEN CASE WHEN substr(sequence, i + k, 1) = '' THEN NULL WHEN ascii(substr(qual, (j + k + 1)::INT, 1)) - 33 > 25
      THEN CASE WHEN substr(seq, j + k + 1, 1) <> substr(sequence, i + k, 1) THEN substr(seq, j + k + 1, 1) ELSE '0' END ELSE '?' END
    WHEN op = 'D' THEN CASE WHEN k < n - 1 OR a.amb THEN '?' ELSE '1' END WHEN op = 'S' AND is_last THEN '*' END AS bit
  FROM steps s LEFT JOIN ambig a ON s.key = a.key AND s.mate = a.mate AND s.ord = a.ord),
mate_bits AS (SELECT * FROM all_bits WHERE bit IS NOT NULL),
bits1 AS (SELECT key, qname, rname, pos, bit FROM mate_bits WHERE mate = 1),
pairs AS (SELECT a.key, a.qname, a.rname, a.mapq AS q1, b.mapq AS q2, length(a.seq) AS n1, length(b.seq) AS n2 FROM mates a JOIN mates b ON a.key = b.key AND a.mate = 1 AND b.mate = 2
  WHERE a.pnext = b.pos AND a.rname = b.rname AND a.rnext = '=' AND a.mapq = b.mapq
  AND a.qname NOT IN (SELECT qname FROM mates WHERE mate = 1 GROUP BY qname HAVING count(*) > 1)),
both_bits AS (SELECT key, pos, max(bit) FILTER (mate = 1) AS a, max(bit) FILTER (mate = 2) AS b FROM mate_bits GROUP BY key, pos),
paired_bits AS (SELECT p.key, p.qname, p.rname, pos,
  CASE WHEN a IS NULL THEN b WHEN b IS NULL OR a = b THEN a WHEN a = '0' OR b = '0' THEN '0' WHEN a = '?' THEN b WHEN b = '?' THEN a WHEN a = '*' THEN b WHEN b = '*' THEN a
    WHEN a IN {BASE} AND b IN {BASE} OR a = '1' AND b IN {BASE} OR a IN {BASE} AND b = '1' THEN '?' ELSE a END AS bit
  FROM both_bits JOIN pairs p USING (key)),
muts AS (SELECT key, pos, pos - lag(pos) OVER (PARTITION BY key ORDER BY pos) AS gap FROM bits1 WHERE bit IN {BASE}),
frag_muts AS (SELECT key, count(*) FILTER (pos BETWEEN 1 AND 64) AS n_mut, min(gap) AS gap FROM muts GROUP BY key),
frags AS (SELECT m.key, m.qname, m.rname, m.mapq, m.seq, length(m.seq) AS n, coalesce(f.n_mut, 0) AS n_mut,
  CASE WHEN m.mapq < 15 THEN 'low_mapq' END AS reason,
  CASE WHEN m.mapq < 15 THEN 'low_mapq' WHEN length(m.seq) / 64.0 < 0.4 THEN 'short_read' WHEN coalesce(f.n_mut, 0) > 2 THEN 'too_many_muts' WHEN f.gap <= 5 THEN 'muts_too_close' END AS strict
  FROM mates m LEFT JOIN frag_muts f ON m.key = f.key WHERE m.mate = 1),
pos_counts AS (SELECT b.rname, pos, count(*) FILTER (bit <> '?') AS cov, count(*) AS info, count(*) FILTER (bit IN {BASE}) AS mut, count(*) FILTER (bit = '1') AS del, 0::BIGINT AS ins,
  count(*) FILTER (bit = 'A') AS A, count(*) FILTER (bit = 'C') AS C, count(*) FILTER (bit = 'G') AS G, count(*) FILTER (bit = 'T') AS T
  FROM bits1 b JOIN frags f ON b.key = f.key AND f.reason IS NULL WHERE pos BETWEEN 1 AND 64 GROUP BY b.rname, pos),
nmut_counts AS (SELECT rname, n_mut::INT AS n_mut, count(*) AS reads FROM frags WHERE reason IS NULL GROUP BY rname, n_mut),
read_counts AS (SELECT r.rname, count(f.key) AS num_reads, count(f.key) FILTER (strict IS NULL) AS num_aligned, count(*) FILTER (strict = 'low_mapq') AS low_mapq, count(*) FILTER (strict = 'short_read') AS short_read,
  count(*) FILTER (strict = 'too_many_muts') AS too_many_muts, count(*) FILTER (strict = 'muts_too_close') AS muts_too_close FROM refs r LEFT JOIN frags f ON r.rname = f.rname GROUP BY r.rname),
plain_counts AS (SELECT r.rname, count(f.key) AS num_reads, count(f.key) FILTER (reason IS NULL) AS num_aligned FROM refs r LEFT JOIN frags f ON r.rname = f.rname GROUP BY r.rname),
every AS (SELECT rname, unnest(range(1, 65))::INT AS pos, sequence FROM refs),
dense AS (SELECT e.rname, e.pos, substr(e.sequence, e.pos, 1) AS nuc, coalesce(p.cov, 0) AS cov, coalesce(p.info, 0) AS info, coalesce(p.mut, 0) AS mut, coalesce(p.del, 0) AS del FROM every e LEFT JOIN pos_counts p ON e.rname = p.rname AND e.pos = p.pos),
pct AS (SELECT c.rname, {", ".join(f"CASE WHEN c.num_aligned = 0 THEN 0.0::DOUBLE ELSE round_even(coalesce(sum(reads) FILTER (n_mut BETWEEN {lo} AND {hi}), 0)::DOUBLE / c.num_aligned * 100, 2) END AS {n}" for n, lo, hi in (('m0', 0, 0), ('m1', 1, 1), ('m2', 2, 2), ('m3', 3, 3), ('m5', 5, 999)))}
  FROM plain_counts c LEFT JOIN nmut_counts n ON c.rname = n.rname GROUP BY c.rname, c.num_aligned),
noise AS (SELECT rname, (sum(mut) FILTER (nuc IN ('A', 'C')))::DOUBLE / nullif(count(*) FILTER (nuc IN ('A', 'C')), 0) AS s, (sum(mut) FILTER (nuc NOT IN ('A', 'C')))::DOUBLE / nullif(count(*) FILTER (nuc IN ('G', 'T')), 0) AS n FROM dense GROUP BY rname),
sn AS (SELECT rname, CASE WHEN s IS NOT NULL AND n = 0 THEN 0.0 ELSE round_even(s / nullif(n, 0), 2) END AS sn FROM noise)
"""


def _tables() -> dict[str, str]:
    """name -> query of each table above, in order."""
    begins = [*re.finditer(r"^(\w+) AS \(", CTES, re.M)]
    ends = [*(m.start() for m in begins[1:]), len(CTES)]
    return {m[1]: CTES[m.end() - 1 : end].strip().rstrip(",") for m, end in zip(begins, ends, strict=True)}


_TABLES = _tables()
_NAME = re.compile(r"\b(" + "|".join(_TABLES) + r")\b")


def sql(select: str) -> str:
    """select with the tables that it needs, each made once."""
    needed, waiting = set(), set(_NAME.findall(select))
    while waiting:
        needed.add(name := waiting.pop())
        waiting |= set(_NAME.findall(_TABLES[name])) - needed
    tables = ",\n".join(f"{n} AS MATERIALIZED {q}" for n, q in _TABLES.items() if n in needed)
    return f"WITH {tables}\n{select}" if tables else select


_RATE = "CASE WHEN info = 0 THEN 'NaN'::DOUBLE ELSE round_even(({0})::DOUBLE / info, 5) END"
TEXT = "string_agg(coalesce(b.bit, '.'), '' ORDER BY e.pos)"
_ORDERS = "(SELECT o_orderkey AS trial, o_totalprice AS quality_score, o_orderstatus AS p_status, o_orderpriority AS p_priority, (o_custkey % 7)::VARCHAR AS p_cust FROM orders WHERE o_totalprice > 0)"
_TOP = f"(SELECT * FROM {_ORDERS} ORDER BY quality_score DESC, trial LIMIT 100)"
_LONG = f"(SELECT trial, quality_score, unnest(['p_status', 'p_priority', 'p_cust']) AS param, unnest([p_status, p_priority, p_cust]) AS value FROM {_TOP})"
_COUNTED = f"(SELECT param, value, count(*) AS n, arg_min(trial, (-quality_score, trial)) AS t0, min((-quality_score, trial)) AS first_seen FROM {_LONG} WHERE value IS NOT NULL GROUP BY param, value)"

_ALIGNED = "CASE WHEN num_reads = 0 THEN 0.0 ELSE round_even(num_aligned::DOUBLE / num_reads * 100, 2) END"

ORACLE: dict[str, str] = {
    "synth_refs": sql("SELECT rname, sequence FROM refs"),
    "synth_reads": sql("SELECT qname, flag, rname, pos, mapq, cigar, rnext, pnext, seq, qual, mate FROM mates"),
    "cigar_ops": sql("SELECT m.qname, (o.ord - 1)::INT AS op_index, o.n AS len, o.op FROM ops o JOIN mates m ON o.key = m.key AND o.mate = m.mate WHERE o.mate = 1"),
    "cigar_cursor": sql("SELECT m.qname, (o.ord - 1)::INT AS op_index, o.i, o.j, o.is_last FROM ops o JOIN mates m ON o.key = m.key AND o.mate = m.mate WHERE o.mate = 1"),
    "read_bits": sql("SELECT qname, pos, bit FROM bits1"),
    "match_bits": sql("SELECT b.qname, b.pos, b.bit FROM bits1 b JOIN mates m ON b.key = m.key AND m.mate = 1 WHERE m.cigar = '40M'"),
    "quality_mask": sql("SELECT rname, count(*) FILTER (bit = '?') AS ambiguous, count(*) AS symbols FROM bits1 GROUP BY rname"),
    "deletion_ambiguity": sql("SELECT m.qname, a.amb AS ambiguous FROM ambig a JOIN mates m ON a.key = m.key AND a.mate = m.mate WHERE a.mate = 1"),
    "softclip_bits": sql("SELECT qname, pos FROM bits1 WHERE bit = '*'"),
    "unknown_op_empty": sql("SELECT m.qname, m.cigar FROM mates m WHERE m.mate = 1 AND NOT EXISTS (SELECT 1 FROM bits1 b WHERE b.key = m.key)"),
    "bitvector_text": sql(f"SELECT m.qname, m.rname, {TEXT} AS bits, count(*) FILTER (regexp_matches(b.bit, '^[A-Za-z]$')) AS n_letters FROM mates m JOIN every e ON m.rname = e.rname LEFT JOIN bits1 b ON b.key = m.key AND b.pos = e.pos WHERE m.mate = 1 GROUP BY m.key, m.qname, m.rname"),
    "sparse_muts": sql(f"SELECT m.qname, coalesce(string_agg(concat(b.pos, ':', b.bit), ',' ORDER BY b.pos) FILTER (b.bit IN {BASE}), '') AS muts, coalesce(string_agg(concat(b.pos, ':', b.bit), ',' ORDER BY b.pos) FILTER (b.bit = '1'), '') AS dels, coalesce(string_agg(concat(b.pos, ':', b.bit), ',' ORDER BY b.pos) FILTER (b.bit = '?'), '') AS ambigs FROM mates m LEFT JOIN bits1 b ON b.key = m.key WHERE m.mate = 1 GROUP BY m.key, m.qname"),
    "pair_consistency": sql("SELECT qname, rname, q1 AS mapq FROM pairs"),
    "pair_merge": sql("SELECT qname, pos, bit FROM paired_bits"),
    "pair_hist": sql(f"SELECT rname, pos, count(*) FILTER (bit <> '?') AS cov, count(*) AS info, count(*) FILTER (bit IN {BASE}) AS mut, count(*) FILTER (bit = '1') AS del FROM paired_bits b JOIN pairs p USING (key, qname, rname) WHERE q1 >= 15 AND q2 >= 15 AND pos BETWEEN 1 AND 64 GROUP BY rname, pos"),
    "filter_reason": sql("SELECT qname, rname, n_mut::INT AS n_mut, strict AS reason FROM frags"),
    **{f"filter_{r}": sql(f"SELECT qname FROM frags WHERE strict = '{r}'") for r in ("low_mapq", "short_read", "too_many_muts", "muts_too_close")},
    "rejected": sql(f"SELECT f.qname, f.rname, f.strict AS reason, f.seq AS read1, '' AS read2, {TEXT} AS bitvector FROM frags f JOIN every e ON f.rname = e.rname LEFT JOIN bits1 b ON b.key = f.key AND b.pos = e.pos WHERE f.strict IS NOT NULL GROUP BY f.key, f.qname, f.rname, f.seq, f.strict"),
    "unknown_reference": sql("SELECT m.qname, m.rname FROM mates m WHERE m.mate = 1 AND m.rname NOT IN (SELECT name FROM structures)"),
    "csv_fasta_check": sql("SELECT r.rname FROM refs r LEFT JOIN structures s ON r.rname = s.name WHERE s.name IS NULL"),
    "hist_pos": sql("SELECT * FROM pos_counts"),
    "hist_nmut": sql("SELECT * FROM nmut_counts"),
    "hist_reads": sql("SELECT * FROM read_counts"),
    "hist_dense": sql("SELECT * FROM dense"),
    "merge_chunks": sql("SELECT * FROM pos_counts"),
    "merge_chunks_strict": sql(f"SELECT b.rname, pos, count(*) FILTER (bit <> '?') AS cov, count(*) AS info, count(*) FILTER (bit IN {BASE}) AS mut, count(*) FILTER (bit = '1' AND split_part(b.key, ':', 1)::BIGINT % 4 = 0) AS del FROM bits1 b JOIN frags f ON b.key = f.key AND f.reason IS NULL WHERE pos BETWEEN 1 AND 64 GROUP BY b.rname, pos"),
    "merge_guards": sql("SELECT p_brand AS rname, 'sequence' AS field, count(DISTINCT p_type) AS kinds FROM part GROUP BY p_brand HAVING count(DISTINCT p_type) > 1"),
    "pop_avg": sql(f"SELECT d.rname, d.pos AS position, {_RATE.format('mut')} AS mismatches, {_RATE.format('mut + del')} AS mismatch_del, nuc, nullif(substr(s.structure, d.pos, 1), '') AS structure FROM dense d LEFT JOIN structures s ON d.rname = s.name"),
    "read_coverage": sql("SELECT d.rname, d.pos AS position, CASE WHEN c.num_reads = 0 THEN 'NaN'::DOUBLE ELSE cov::DOUBLE / c.num_reads END AS coverage FROM dense d JOIN plain_counts c ON d.rname = c.rname"),
    "percent_mutations": sql('SELECT rname, m0 AS no_mut, m1 AS "1_mut", m2 AS "2_mut", m3 AS "3_mut", m5 AS "3plus_mut" FROM pct'),
    "signal_to_noise": sql("SELECT rname, sn FROM sn"),
    "summary": sql('SELECT c.rname AS name, num_reads AS reads, CASE WHEN num_reads = 0 THEN 0.0 ELSE round_even(num_aligned::DOUBLE / num_reads * 100, 2) END AS aligned, m0 AS no_mut, m1 AS "1_mut", m2 AS "2_mut", m3 AS "3_mut", m5 AS "3plus_mut", sn FROM plain_counts c JOIN pct ON c.rname = pct.rname JOIN sn ON c.rname = sn.rname'),
    "skip_summary": sql("SELECT rname, num_reads, " + ", ".join(f"CASE WHEN num_reads = 0 THEN 0.0 ELSE round_even({r}::DOUBLE / num_reads * 100, 2) END AS {r}" for r in ("low_mapq", "short_read", "too_many_muts", "muts_too_close")) + " FROM read_counts"),
    "mutation_rate": sql(f"SELECT rname, pos AS position, {_RATE.format('mut')} AS mismatches FROM dense"),
    "nonempty_distribution": sql("SELECT f.n_mut::INT AS n_mut, count(*) AS reads FROM frags f WHERE EXISTS (SELECT 1 FROM bits1 b WHERE b.key = f.key) GROUP BY f.n_mut"),
    "impl_diff": sql("SELECT 'none' AS difference, 0::BIGINT AS n"),
    "chunk_assign": "SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000)::BIGINT AS chunk FROM orders",
    "chunk_pairs": "SELECT l_orderkey AS chunk, count(*) FILTER (l_linenumber % 2 = 1) AS r1, count(*) FILTER (l_linenumber % 2 = 0) AS r2 FROM lineitem GROUP BY l_orderkey",
    "chunk_cross_index": "SELECT o_orderkey, n_name FROM orders, (SELECT n_name FROM nation ORDER BY n_nationkey LIMIT 1)",
    "sample_names": "SELECT o_orderkey, concat('s', o_custkey % 50) AS sample_id, (o_orderkey % 9)::INT AS chunk FROM orders",
    "alignment_totals": "SELECT o_custkey % 50 AS sample_id, sum(o_orderkey)::BIGINT AS total_reads, sum(o_orderkey - o_custkey % 10)::BIGINT AS aligned_count, sum(o_custkey % 10)::BIGINT AS unaligned_count, sum(o_orderkey - o_custkey % 10)::DOUBLE / sum(o_orderkey) * 100 AS overall_alignment_rate, count(*) AS chunks_processed FROM orders GROUP BY o_custkey % 50",
    "column_stats": "SELECT avg(v) AS avg_v, min(v) AS min_v, max(v) AS max_v, sum(v) AS total_v, count(v) AS n FROM (SELECT TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'NA' WHEN o_orderkey % 7 = 0 THEN '' ELSE (o_custkey)::VARCHAR END AS DOUBLE) AS v FROM orders)",
    "mutated_share": "SELECT count(*) FILTER (v > 0) AS sequences_with_mutations, count(*) FILTER (v > 0)::DOUBLE / count(*) * 100 AS mutation_rate FROM (SELECT TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'NA' ELSE (o_custkey % 3)::VARCHAR END AS DOUBLE) AS v FROM orders)",
    "top_params": f"SELECT trial, quality_score, p_status, p_priority, p_cust FROM {_TOP}",
    "param_frequency": f"SELECT param, value, n, n::DOUBLE / sum(n) OVER (PARTITION BY param) AS frequency FROM {_COUNTED}",
    "param_mode": f"SELECT param, value, most_common_frequency, unique_values FROM (SELECT param, value, n::DOUBLE / sum(n) OVER (PARTITION BY param) AS most_common_frequency, count(*) OVER (PARTITION BY param) AS unique_values, row_number() OVER (PARTITION BY param ORDER BY n DESC, first_seen) AS r FROM {_COUNTED}) WHERE r = 1",
    "param_class": f"SELECT class, count(*) AS params FROM (SELECT CASE WHEN f = 1 THEN 'constant' WHEN f >= 0.5 THEN 'high' ELSE 'variable' END AS class FROM (SELECT param, max(n)::DOUBLE / sum(n) AS f FROM {_COUNTED} GROUP BY param)) GROUP BY class",
    "score_stats": f"SELECT min(quality_score) AS min_score, max(quality_score) AS max_score, round(avg(quality_score), 6) AS mean_score, median(quality_score) AS median_score FROM {_TOP}",
    "union_sam": sql("SELECT qname, rname, pos, mate FROM mates"),
    "stream_merge": sql("SELECT * FROM pos_counts"),
    "fastq_qc": sql("SELECT (cycle + 1)::INT AS cycle, count(*) AS reads, avg(ascii(substr(qual, (cycle + 1)::INT, 1)) - 33) AS mean_quality, count(*) FILTER (substr(seq, (cycle + 1)::INT, 1) IN ('G', 'C'))::DOUBLE / count(*) AS gc FROM (SELECT seq, qual, unnest(range(0, length(seq))) AS cycle FROM mates) GROUP BY cycle"),
    "barcode_counts": sql("SELECT substr(seq, 1, 2) AS barcode, count(*) AS reads FROM mates GROUP BY 1"),
    "demultiplex": sql("SELECT n_name AS sample_id, qname, mate::INT AS mate, substr(seq, 3) AS seq, substr(qual, 3) AS qual, substr(seq, 1, 2) AS barcode FROM mates JOIN nation ON n_nationkey < 16 AND substr(seq, 1, 2) = concat(substr('ACGT', (n_nationkey // 4 + 1)::INT, 1), substr('ACGT', (n_nationkey % 4 + 1)::INT, 1))"),
    "quality_trim": sql("SELECT qname, mate::INT AS mate, substr(seq, 1, len - cut) AS seq, substr(qual, 1, len - cut) AS qual FROM (SELECT any_value(qname) AS qname, mate, any_value(seq) AS seq, any_value(qual) AS qual, any_value(len) AS len, coalesce(arg_max(n, (s, -n)) FILTER (s > 0 AND n < coalesce(over, 1000000)), 0)::BIGINT AS cut FROM (SELECT *, min(n) FILTER (s < 0) OVER (PARTITION BY key, mate) AS over FROM (SELECT *, sum(25 - (ascii(substr(qual, (len - n + 1)::INT, 1)) - 33)) OVER (PARTITION BY key, mate ORDER BY n) AS s FROM (SELECT key, qname, mate, seq, qual, length(qual) AS len, unnest(range(1, length(qual) + 1)) AS n FROM mates))) GROUP BY key, mate) WHERE len - cut >= 20"),
    "merge_mutation_counts": sql("SELECT * FROM nmut_counts"),
    "merge_read_counts": sql("SELECT rname, count(*) AS num_reads, count(*) FILTER (reason IS NULL) AS num_aligned, count(*) FILTER (reason = 'low_mapq') AS low_mapq, 0::BIGINT AS short_read, 0::BIGINT AS too_many_muts, 0::BIGINT AS muts_too_close FROM frags GROUP BY rname"),
    "report_columns": sql(f'SELECT c.rname AS name, s.structure, num_reads AS reads, num_aligned, {_ALIGNED} AS aligned, m0 AS no_mut, m1 AS "1_mut", m2 AS "2_mut", m3 AS "3_mut", m5 AS "3plus_mut", sn FROM plain_counts c JOIN pct ON c.rname = pct.rname JOIN sn ON c.rname = sn.rname LEFT JOIN structures s ON s.name = c.rname'),
    "report_series": sql(f"SELECT d.rname AS name, d.pos, cov AS cov_bases, info AS info_bases, mut AS mut_bases, del AS del_bases, CASE WHEN c.num_reads = 0 THEN 'NaN'::DOUBLE ELSE cov::DOUBLE / c.num_reads END AS read_coverage, {_RATE.format('mut')} AS pop_avg, {_RATE.format('mut + del')} AS pop_avg_del FROM dense d JOIN plain_counts c ON d.rname = c.rname"),
    "report_mutations": sql("SELECT rname AS name, n_mut, reads FROM nmut_counts"),
    "stream_summary": sql(f'SELECT c.rname AS name, num_reads AS reads, {_ALIGNED} AS aligned, m0 AS no_mut, m1 AS "1_mut", m2 AS "2_mut", m3 AS "3_mut", m5 AS "3plus_mut", sn FROM plain_counts c JOIN pct ON c.rname = pct.rname JOIN sn ON c.rname = sn.rname'),
    "positional_pairs": sql("SELECT qname, rname, q1 AS mapq FROM pairs"),
    "orphans": sql("SELECT qname, rname, pos, cigar FROM mates WHERE mate = 1 AND split_part(key, ':', 1)::BIGINT % 7 = 0"),
    "sam_scan": sql("SELECT qname, flag, rname, pos, mapq, cigar, rnext, pnext, seq, qual, mate::INT AS mate FROM mates"),
    "joined_sam": sql("SELECT qname, rname, pos, flag FROM mates"),
    "fasta_scan": sql("SELECT rname, sequence FROM refs"),
    "fastq_scan": sql("SELECT qname, seq, qual FROM mates WHERE mate = 1"),
    "json_roundtrip": sql(f"SELECT b.rname, pos, bit, count(*) AS n FROM bits1 b JOIN frags f ON b.key = f.key AND f.reason IS NULL WHERE bit IN {BASE} OR bit IN ('1', '?') GROUP BY b.rname, pos, bit"),
    "text_roundtrip": sql("SELECT b.qname, b.rname, pos, bit FROM bits1 b JOIN frags f ON b.key = f.key AND f.reason IS NULL WHERE pos BETWEEN 1 AND 64"),
    "histogram_roundtrip": sql("SELECT * FROM pos_counts WHERE info > 0"),
    "grouped_chunks": "SELECT o_custkey AS sample_id, c_name, count(DISTINCT o_orderkey // 1000) AS n_chunks, min(o_orderkey // 1000)::BIGINT AS first_chunk, max(o_orderkey // 1000)::BIGINT AS last_chunk FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey, c_name",
    "workflow_report": "SELECT total_reads, aligned_count, unaligned_count, chunks_processed, aligned_count::DOUBLE / total_reads * 100 AS overall_alignment_rate, chunks_processed > 1 AS parallel_mode, sequences_analyzed, avg_num_reads, min_num_reads, max_num_reads, total_num_reads, avg_num_mutations, min_num_mutations, max_num_mutations, total_num_mutations, sequences_with_mutations, sequences_with_mutations::DOUBLE / sequences_analyzed * 100 AS mutation_rate FROM (SELECT sum(o_orderkey)::BIGINT AS total_reads, sum(o_orderkey - o_custkey % 10)::BIGINT AS aligned_count, sum(o_custkey % 10)::BIGINT AS unaligned_count, count(*) AS chunks_processed FROM orders), (SELECT count(*) AS sequences_analyzed, avg(r) AS avg_num_reads, min(r) AS min_num_reads, max(r) AS max_num_reads, sum(r) AS total_num_reads, avg(m) AS avg_num_mutations, min(m) AS min_num_mutations, max(m) AS max_num_mutations, sum(m) AS total_num_mutations, count(*) FILTER (m > 0) AS sequences_with_mutations FROM (SELECT c_custkey::DOUBLE AS r, CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 3)::DOUBLE END AS m FROM customer))",
    "alignment_log": "SELECT o_orderkey, o_orderkey::BIGINT AS total_reads, (o_custkey % 7)::BIGINT AS unaligned_count, o_custkey::BIGINT AS unique_count, 97.25::DOUBLE AS unique_percent, NULL::BIGINT AS multiple_count, 98.5::DOUBLE AS overall_alignment_rate FROM orders",
    "quality_score": "SELECT o_orderkey, round_even((0.4::DOUBLE * ((o_custkey % 100) / 100.0::DOUBLE) + 0.3::DOUBLE * ((o_orderkey % 100) / 100.0::DOUBLE) + 0.2::DOUBLE * least((o_orderkey % 80) / 60.0::DOUBLE, 1) + 0.1::DOUBLE * ((o_custkey % 10) / 10.0::DOUBLE)) * 1000000, 0) / 1000000 AS score FROM orders",
}
