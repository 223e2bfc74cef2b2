"""DuckDB statements that state every query's result by direct means.

``PARTS`` are named building blocks on top of the adapter views; a statement
gets the blocks it mentions as a WITH clause.
"""

import re

from cellbulk.adapters import GENOME_SIZE, VIEWS, duck
from cellbulk.catalog import TOP_N

PARTS: dict[str, str] = {}
ORACLES: dict[str, str] = {}

PARTS["cells"] = """
SELECT m.*, concat('annotation_', a.i) AS annotation,
       concat('annotation_', a.i, '-', m.subsample) AS pseudobulk_id
FROM metadata m JOIN (SELECT cell_name, row_number() OVER (ORDER BY cell_name) - 1 AS i
                      FROM (SELECT DISTINCT cell_name FROM metadata)) a USING (cell_name)"""
PARTS["asg"] = """
SELECT DISTINCT analysis_set_accession, barcode_sample, pseudobulk_id, subsample, cell_name
FROM cells"""
PARTS["sites"] = """
SELECT DISTINCT chro AS contig, TSS - 1 AS tss0,
       CAST(CASE WHEN strand = '+' THEN 1 ELSE -1 END AS BIGINT) AS strand FROM tss"""
PARTS["ins"] = """
SELECT analysis_set_accession, contig, barcode_sample, num_reads, frag_start + 4 AS pos FROM fragments
UNION ALL
SELECT analysis_set_accession, contig, barcode_sample, num_reads, frag_end - 5 FROM fragments"""
PARTS["pairs"] = """
SELECT i.analysis_set_accession, i.barcode_sample, i.contig, i.pos, s.tss0, s.strand,
       2000 + (i.pos - s.tss0) * s.strand AS slot
FROM ins i JOIN sites s ON i.contig = s.contig AND i.pos >= s.tss0 - 2000 AND i.pos <= s.tss0 + 2000
WHERE i.contig <> 'chrM'"""
PARTS["enrich"] = """
SELECT analysis_set_accession, barcode_sample,
       count(*) FILTER (WHERE slot BETWEEN 1995 AND 2005) AS center,
       count(*) FILTER (WHERE slot < 100 OR slot > 3900) AS flank
FROM pairs GROUP BY 1, 2"""
PARTS["atacqc"] = """
SELECT f.analysis_set_accession, f.barcode_sample, a.pseudobulk_id,
       a.pseudobulk_id IS NOT NULL AND f.listed AS annotated, f.num_frags,
       100.0 * (f.reads - f.num_frags) / f.reads AS pct_duplicated_reads,
       (1 + f.mono) / (1 + f.free) AS nucleosomal_signal,
       (coalesce(e.center, 0) / 11.0) / (coalesce(e.flank, 0) / 200.0 + 0.1) AS tss_enrichment,
       f.reads AS "raw-num_reads", f.reads - f.num_frags AS "raw-num_dup_reads",
       f.mono AS "raw-mono_nucleosomal_frags", f.free AS "raw-nucleosome_free_frags",
       coalesce(e.center, 0) AS "raw-tss_center", coalesce(e.flank, 0) AS "raw-tss_flank"
FROM (SELECT analysis_set_accession, barcode_sample, count(*) AS num_frags,
             CAST(sum(num_reads) AS BIGINT) AS reads,
             count(*) FILTER (WHERE frag_end - frag_start - 8 BETWEEN 148 AND 294) AS mono,
             count(*) FILTER (WHERE frag_end - frag_start - 8 < 148) AS free,
             bool_or(contig IN (SELECT chr FROM chrom_sizes)) AS listed
      FROM fragments GROUP BY 1, 2) f
LEFT JOIN asg a USING (analysis_set_accession, barcode_sample)
LEFT JOIN enrich e USING (analysis_set_accession, barcode_sample)"""
PARTS["members"] = """
SELECT f.*, a.pseudobulk_id,
       CASE WHEN substr(md5(concat_ws(':', '42', f.analysis_set_accession, f.contig, f.frag_start,
            f.frag_end, f.barcode_sample, f.num_reads)), 1, 1) < '8' THEN '1' ELSE '2' END AS rep
FROM fragments f JOIN asg a USING (analysis_set_accession, barcode_sample)
WHERE f.contig IN (SELECT chr FROM chrom_sizes)"""
PARTS["memberins"] = """
SELECT pseudobulk_id, rep, contig, frag_start + 4 AS pos FROM members
UNION ALL SELECT pseudobulk_id, rep, contig, frag_end - 5 FROM members
UNION ALL SELECT pseudobulk_id, 't', contig, frag_start + 4 FROM members
UNION ALL SELECT pseudobulk_id, 't', contig, frag_end - 5 FROM members"""
PARTS["tagtotals"] = """
SELECT pseudobulk_id, rep, count(*) AS tags FROM memberins GROUP BY 1, 2"""
PARTS["edges"] = """
SELECT pseudobulk_id, rep, contig, greatest(pos - 75, 0) AS edge, 1 AS p, 0 AS c FROM memberins
UNION ALL SELECT pseudobulk_id, rep, contig, greatest(pos - 75, 0) + 150
                 + least(pos - 75, 0), -1, 0 FROM memberins
UNION ALL SELECT pseudobulk_id, rep, contig, greatest(pos - 5000, 0), 0, 1 FROM memberins
UNION ALL SELECT pseudobulk_id, rep, contig, pos + 5000, 0, -1 FROM memberins"""
PARTS["depths"] = """
SELECT pseudobulk_id, rep, contig, edge AS start,
       lead(edge) OVER (PARTITION BY pseudobulk_id, rep, contig ORDER BY edge) AS "end",
       CAST(sum(p) OVER (PARTITION BY pseudobulk_id, rep, contig ORDER BY edge) AS BIGINT) AS pileup,
       CAST(sum(c) OVER (PARTITION BY pseudobulk_id, rep, contig ORDER BY edge) AS BIGINT) AS near
FROM (SELECT pseudobulk_id, rep, contig, edge, sum(p) AS p, sum(c) AS c
      FROM edges GROUP BY 1, 2, 3, 4) WHERE p <> 0 OR c <> 0"""
PARTS["pileup"] = """
SELECT pseudobulk_id, rep, contig, edge AS start,
       lead(edge) OVER (PARTITION BY pseudobulk_id, rep, contig ORDER BY edge) AS "end",
       CAST(sum(p) OVER (PARTITION BY pseudobulk_id, rep, contig ORDER BY edge) AS BIGINT) AS depth
FROM (SELECT pseudobulk_id, rep, contig, edge, sum(p) AS p
      FROM edges GROUP BY 1, 2, 3, 4) WHERE p <> 0"""
PARTS["lambdas"] = """
SELECT pseudobulk_id, rep, contig, edge AS start,
       lead(edge) OVER (PARTITION BY pseudobulk_id, rep, contig ORDER BY edge) AS "end",
       CAST(sum(c) OVER (PARTITION BY pseudobulk_id, rep, contig ORDER BY edge) AS BIGINT) AS depth
FROM (SELECT pseudobulk_id, rep, contig, edge, sum(c) AS c
      FROM edges GROUP BY 1, 2, 3, 4) WHERE c <> 0"""
PARTS["rated"] = f"""
SELECT pseudobulk_id, rep, contig, start, "end", pileup,
       greatest(near * 150.0::DOUBLE / 10000.0::DOUBLE, tags * 150.0::DOUBLE / {GENOME_SIZE}.0::DOUBLE) AS lambda
FROM depths JOIN tagtotals USING (pseudobulk_id, rep)
WHERE pileup > 0 OR near > 0"""
PARTS["pscores"] = """
SELECT pileup, lambda,
       -log10(list_sum(list_transform(range(pileup + 1, pileup + 201),
              lambda i: exp(i * ln(lambda) - lambda - lgamma(i + 1))))) AS score
FROM (SELECT DISTINCT pileup, lambda FROM rated)"""
# "lambda" is a keyword where the list function is written; rename around it.
PARTS["rated"] = PARTS["rated"].replace("AS lambda", "AS lam")
PARTS["pscores"] = (PARTS["pscores"].replace("pileup, lambda,", "pileup, lam,")
                    .replace("ln(lambda) - lambda", "ln(lam) - lam")
                    .replace("pileup, lambda FROM", "pileup, lam FROM"))
PARTS["scored"] = """
SELECT r.*, s.score FROM rated r JOIN pscores s USING (pileup, lam)"""
PARTS["chained"] = """
SELECT *, sum(fresh) OVER (PARTITION BY pseudobulk_id, rep, contig ORDER BY start) AS island
FROM (SELECT *, CASE WHEN start - lag("end") OVER (PARTITION BY pseudobulk_id, rep, contig
                                                  ORDER BY start) <= 1 THEN 0 ELSE 1 END AS fresh
      FROM scored WHERE score >= 2)"""
PARTS["runs"] = """
SELECT pseudobulk_id, rep, contig, island, run, min(start) AS start, max("end") AS "end",
       max(pileup) AS pileup, first(score ORDER BY score DESC, start) AS score,
       first(lam ORDER BY score DESC, start) AS lam
FROM (SELECT *, sum(step) OVER (PARTITION BY pseudobulk_id, rep, contig, island ORDER BY start) AS run
      FROM (SELECT *, CASE WHEN lag(pileup) OVER (PARTITION BY pseudobulk_id, rep, contig, island
                                                  ORDER BY start) IS NOT DISTINCT FROM pileup
                      THEN 0 ELSE 1 END AS step FROM chained))
GROUP BY 1, 2, 3, 4, 5"""
PARTS["localmax"] = """
SELECT pseudobulk_id, rep, contig, pk_start, pk_end,
       CAST(floor((start + "end") / 2) AS BIGINT) AS summit, pileup,
       pileup / lam AS signal_value, score AS neg_log10_p
FROM (SELECT *, min(start) OVER r AS pk_start, max("end") OVER r AS pk_end,
             coalesce(lag(pileup) OVER o < pileup, TRUE)
               AND coalesce(lead(pileup) OVER o < pileup, TRUE) AS top
      FROM runs WINDOW r AS (PARTITION BY pseudobulk_id, rep, contig, island),
                       o AS (PARTITION BY pseudobulk_id, rep, contig, island ORDER BY run))
WHERE top AND pk_end - pk_start >= 150"""
PARTS["genes"] = """
SELECT c.*, g.gene_name AS gene_symbol, coalesce(g.mt, FALSE) AS mt, coalesce(g.ribo, FALSE) AS ribo
FROM counts c LEFT JOIN gene_info g USING (gene_id)"""
PARTS["rnaqc"] = """
SELECT q.analysis_set_accession, q.barcode_sample, a.pseudobulk_id IS NOT NULL AS annotated,
       a.pseudobulk_id, q.reads AS rna_read_count, q.n AS gene_count,
       100.0 * q.mt / nullif(q.reads, 0) AS pct_mito, 100.0 * q.ribo / nullif(q.reads, 0) AS pct_ribo
FROM (SELECT analysis_set_accession, barcode_sample, CAST(sum(count) AS BIGINT) AS reads,
             count(*) FILTER (WHERE count > 0) AS n,
             coalesce(sum(count) FILTER (WHERE mt), 0) AS mt,
             coalesce(sum(count) FILTER (WHERE ribo), 0) AS ribo FROM genes GROUP BY 1, 2) q
LEFT JOIN asg a USING (analysis_set_accession, barcode_sample)"""
PARTS["pbacc"] = """
SELECT DISTINCT pseudobulk_id, analysis_set_accession FROM asg
WHERE analysis_set_accession IN (SELECT analysis_set_accession FROM gene_universe)"""
PARTS["shared"] = """
SELECT pseudobulk_id, gene_id FROM pbacc p JOIN gene_universe u USING (analysis_set_accession)
GROUP BY 1, 2 HAVING count(*) = (SELECT count(*) FROM pbacc q WHERE q.pseudobulk_id = p.pseudobulk_id)"""
PARTS["expr"] = """
SELECT s.pseudobulk_id, s.gene_id, g.gene_name AS gene_symbol, coalesce(g.mt, FALSE) AS mt,
       coalesce(g.ribo, FALSE) AS ribo, coalesce(c.n, 0) AS counts,
       coalesce(c.n, 0) / nullif(sum(coalesce(c.n, 0)) OVER (PARTITION BY s.pseudobulk_id), 0) * 1e6 AS CPM
FROM shared s
LEFT JOIN (SELECT pseudobulk_id, gene_id, CAST(sum(count) AS BIGINT) AS n
           FROM counts JOIN asg USING (analysis_set_accession, barcode_sample) GROUP BY 1, 2) c
  USING (pseudobulk_id, gene_id)
LEFT JOIN gene_info g USING (gene_id)"""
PARTS["combined"] = """
SELECT coalesce(r.analysis_set_accession, a.analysis_set_accession) AS analysis_set_accession,
       coalesce(r.barcode_sample, a.barcode_sample) AS barcode_sample,
       coalesce(r.annotated, a.annotated) AS annotated,
       r.barcode_sample IS NOT NULL AS found_in_rna, a.barcode_sample IS NOT NULL AS found_in_atac,
       coalesce(r.pseudobulk_id, a.pseudobulk_id) AS pseudobulk_id,
       coalesce(r.rna_read_count, 0) AS rna_read_count, coalesce(r.gene_count, 0) AS gene_count,
       r.pct_mito, r.pct_ribo, a.num_frags, a.pct_duplicated_reads, a.nucleosomal_signal,
       a.tss_enrichment
FROM rnaqc r FULL JOIN atacqc a ON r.analysis_set_accession = a.analysis_set_accession
  AND r.barcode_sample = a.barcode_sample AND r.annotated = a.annotated"""
PARTS["repro"] = """
SELECT t.* FROM peaks_by_rep t WHERE t.rep = 't'
  AND EXISTS (SELECT 1 FROM peaks_by_rep b WHERE b.rep = '1' AND b.pseudobulk_id = t.pseudobulk_id
     AND b.contig = t.contig AND least(t.pk_end, b.pk_end) > greatest(t.pk_start, b.pk_start)
     AND (least(t.pk_end, b.pk_end) - greatest(t.pk_start, b.pk_start) >= 0.5 * (t.pk_end - t.pk_start)
       OR least(t.pk_end, b.pk_end) - greatest(t.pk_start, b.pk_start) >= 0.5 * (b.pk_end - b.pk_start)))
  AND EXISTS (SELECT 1 FROM peaks_by_rep b WHERE b.rep = '2' AND b.pseudobulk_id = t.pseudobulk_id
     AND b.contig = t.contig AND least(t.pk_end, b.pk_end) > greatest(t.pk_start, b.pk_start)
     AND (least(t.pk_end, b.pk_end) - greatest(t.pk_start, b.pk_start) >= 0.5 * (t.pk_end - t.pk_start)
       OR least(t.pk_end, b.pk_end) - greatest(t.pk_start, b.pk_start) >= 0.5 * (b.pk_end - b.pk_start)))"""
_CLEAR = """NOT EXISTS (SELECT 1 FROM blacklist b WHERE b.contig = p.contig
     AND least(p.pk_end, b.bl_end) > greatest(p.pk_start, b.bl_start))"""
PARTS["finalpeaks"] = f"SELECT p.* FROM repro p WHERE {_CLEAR}"
PARTS["inpeaks"] = """
SELECT m.* FROM members m WHERE EXISTS (SELECT 1 FROM finalpeaks p
  WHERE p.pseudobulk_id = m.pseudobulk_id AND p.contig = m.contig
  AND least(m.frag_end, p.pk_end) > greatest(m.frag_start, p.pk_start))"""
PARTS["fripcells"] = """
SELECT pseudobulk_id, analysis_set_accession, barcode_sample, count(*) AS num_fragments,
       coalesce(max(h.n), 0) AS num_fragments_in_peaks, coalesce(max(h.n), 0) / count(*) AS frip
FROM members LEFT JOIN (SELECT pseudobulk_id, analysis_set_accession, barcode_sample, count(*) AS n
                        FROM inpeaks GROUP BY 1, 2, 3) h
  USING (pseudobulk_id, analysis_set_accession, barcode_sample)
GROUP BY 1, 2, 3"""
PARTS["percell"] = """
SELECT coalesce(r.pseudobulk_id, a.pseudobulk_id) AS pseudobulk_id,
       coalesce(r.analysis_set_accession, a.analysis_set_accession) AS analysis_set_accession,
       coalesce(r.barcode_sample, a.barcode_sample) AS barcode_sample,
       split_part(coalesce(r.pseudobulk_id, a.pseudobulk_id), '-', 2) AS subsample,
       coalesce(r.rna_read_count, 0) AS rna_read_count, coalesce(r.gene_count, 0) AS gene_count,
       r.pct_mito, r.pct_ribo, a.num_frags, a.pct_duplicated_reads, a.nucleosomal_signal,
       a.tss_enrichment, a.frip
FROM (SELECT * FROM rnaqc WHERE pseudobulk_id IS NOT NULL) r
FULL JOIN (SELECT q.*, f.frip FROM atacqc q
           LEFT JOIN fripcells f USING (analysis_set_accession, barcode_sample)
           WHERE q.pseudobulk_id IS NOT NULL) a
  ON r.analysis_set_accession = a.analysis_set_accession
  AND r.barcode_sample = a.barcode_sample AND r.annotated = a.annotated"""
PARTS["long"] = """
SELECT concat_ws('/', analysis_set_accession, barcode_sample) AS cell, metric, value FROM (
  SELECT analysis_set_accession, barcode_sample, 'num_frags' AS metric, num_frags::DOUBLE AS value FROM atacqc
  UNION ALL SELECT analysis_set_accession, barcode_sample, 'pct_duplicated_reads', round(pct_duplicated_reads, 6) FROM atacqc
  UNION ALL SELECT analysis_set_accession, barcode_sample, 'nucleosomal_signal', round(nucleosomal_signal, 6) FROM atacqc
  UNION ALL SELECT analysis_set_accession, barcode_sample, 'tss_enrichment', round(tss_enrichment, 6) FROM atacqc)
WHERE value IS NOT NULL"""
PARTS["boxes"] = """
SELECT *, greatest(min_val, q1 - 1.5 * iqr) AS low, least(max_val, q3 + 1.5 * iqr) AS high,
       CASE WHEN max_val - q1 > 5 * iqr
            THEN greatest(0.001::DOUBLE, least(abs(q1), abs(q3))) END AS symlog_width
FROM (SELECT metric, count(*) AS n, min(value) AS min_val,
             list_sort(list(value))[1 + CAST(round((count(*) - 1) * 0.25) AS BIGINT)] AS q1,
             list_sort(list(value))[1 + CAST(round((count(*) - 1) * 0.5) AS BIGINT)] AS median,
             list_sort(list(value))[1 + CAST(round((count(*) - 1) * 0.75) AS BIGINT)] AS q3,
             max(value) AS max_val, q3 - q1 AS iqr
      FROM long GROUP BY metric)"""


def _round(columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c.strip()}, {digits}) AS {c.strip()}" for c in columns.split(","))


_ATAC = f"""analysis_set_accession, barcode_sample, pseudobulk_id, annotated, num_frags,
 {_round('pct_duplicated_reads, nucleosomal_signal, tss_enrichment')}, "raw-num_reads",
 "raw-num_dup_reads", "raw-mono_nucleosomal_frags", "raw-nucleosome_free_frags",
 "raw-tss_center", "raw-tss_flank\""""
_COMBINED = f"""analysis_set_accession, barcode_sample, annotated, found_in_rna, found_in_atac,
 pseudobulk_id, rna_read_count, gene_count, {_round('pct_mito, pct_ribo')}, num_frags,
 {_round('pct_duplicated_reads, nucleosomal_signal, tss_enrichment')}"""
_COMBINED_DOUBLE = (_COMBINED.replace("rna_read_count, gene_count", "rna_read_count::DOUBLE AS rna_read_count, gene_count::DOUBLE AS gene_count")
                    .replace("num_frags", "num_frags::DOUBLE AS num_frags"))
_EXPR = f"pseudobulk_id, gene_id, gene_symbol, mt, ribo, counts, {_round('CPM')}, round(log10(CPM + 1), 6) AS log10CPM"
_PEAK = "pseudobulk_id, rep, contig, pk_start, pk_end, round(neg_log10_p, 6) AS neg_log10_p, peak_no"
_CALLED = f"pseudobulk_id, rep, contig, pk_start, pk_end, summit, pileup, {_round('signal_value, neg_log10_p')}"
_NARROW = """pseudobulk_id, rep, contig, pk_start, pk_end,
 concat_ws('_', pseudobulk_id, rep, contig, summit) AS name,
 CAST(floor(neg_log10_p * 10) AS BIGINT) AS score, '.' AS strand, round(signal_value, 6) AS signal_value,
 round(neg_log10_p, 6) AS neg_log10_p, -1.0::DOUBLE AS neg_log10_q, summit - pk_start AS summit_offset"""
_GTF_GENE = """SELECT concat('G', CAST(p_partkey AS STRING)) AS gene_id,
 CASE WHEN p_partkey % 10 = 3 THEN concat('G', CAST(p_partkey AS STRING))
      ELSE concat(CASE WHEN p_partkey % 20 = 0 THEN 'MT-' WHEN p_partkey % 20 = 1 THEN 'RPS'
                  ELSE 'GENE' END, CAST(p_partkey AS STRING)) END AS gene_name,
 p_partkey % 20 = 0 AS mt, p_partkey % 20 = 1 AS ribo FROM part"""

O = ORACLES
O["scan_fragments"] = O["scan_fragment_blocks"] = "SELECT * FROM fragments"
O["scan_table"] = "SELECT * FROM tss"
O["scan_qc"] = ("SELECT * EXCLUDE (analysis_set_accession, pseudobulk_id) FROM "
                f"(SELECT {_COMBINED_DOUBLE} FROM combined)")
_ACC = f"FROM (SELECT {_COMBINED_DOUBLE} FROM combined) WHERE analysis_set_accession"
O["scan_by_name"] = O["scan_relaxed"] = f"""SELECT * {_ACC} IN ('ACC0', 'ACC1')
UNION ALL BY NAME SELECT * EXCLUDE (pct_mito, pct_ribo, pct_duplicated_reads) {_ACC} = 'ACC2'
UNION ALL BY NAME SELECT * EXCLUDE (rna_read_count, gene_count) {_ACC} = 'ACC3'"""
O["load_metadata"] = "SELECT * FROM cells"
O["metadata_violations"] = """SELECT 'repeated barcode' AS rule, concat('ACC/', barcode_sample) AS item
FROM metadata GROUP BY barcode_sample HAVING count(*) > 1"""
O["load_tss"] = "SELECT * FROM sites"
O["load_chrom_sizes"] = """SELECT contig AS chr, max(frag_end) AS size,
row_number() OVER (ORDER BY contig) AS chrom_order FROM fragments GROUP BY contig"""
O["load_atac_qc"] = """SELECT analysis_set_accession, barcode_sample, pseudobulk_id, num_frags,
round(tss_enrichment, 6) AS tss_enrichment FROM atacqc WHERE pseudobulk_id IS NOT NULL"""
O["scan_counts"] = "SELECT * FROM counts"
O["gtf_scan"] = """SELECT concat('chr', CAST(1 + p_partkey % 5 AS STRING)) AS contig, f.feature,
1000 + (p_partkey * 104729) % 19980000 AS start, 3000 + (p_partkey * 104729) % 19980000 AS "end",
CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand
FROM part CROSS JOIN (VALUES ('gene'), ('transcript'), ('exon')) AS f(feature)"""
O["gtf_genes"] = _GTF_GENE
O["gtf_tss"] = """SELECT concat(CASE WHEN p_partkey % 20 = 0 THEN 'MT-' WHEN p_partkey % 20 = 1 THEN 'RPS'
 ELSE 'GENE' END, CAST(p_partkey AS STRING)) AS gene, concat('T', CAST(p_partkey AS STRING)) AS transcript,
concat('chr', CAST(1 + p_partkey % 5 AS STRING)) AS chro,
CASE WHEN p_size % 2 = 0 THEN 1000 ELSE 3000 END + (p_partkey * 104729) % 19980000 AS TSS,
CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part"""
O["split_fragments"] = """SELECT stream, pseudobulk_id, analysis_set_accession, count(*) AS n,
CAST(sum(s) AS BIGINT) AS sum_start, CAST(sum(e) AS BIGINT) AS sum_end, CAST(sum(num_reads) AS BIGINT) AS sum_reads
FROM (SELECT 'fragments' AS stream, pseudobulk_id, analysis_set_accession, frag_start AS s, frag_end AS e, num_reads FROM members
 UNION ALL SELECT 'repT', pseudobulk_id, analysis_set_accession, frag_start + 4, frag_start + 5, num_reads FROM members
 UNION ALL SELECT 'repT', pseudobulk_id, analysis_set_accession, frag_end - 5, frag_end - 4, num_reads FROM members
 UNION ALL SELECT concat('rep', rep), pseudobulk_id, analysis_set_accession, frag_start + 4, frag_start + 5, num_reads FROM members
 UNION ALL SELECT concat('rep', rep), pseudobulk_id, analysis_set_accession, frag_end - 5, frag_end - 4, num_reads FROM members)
GROUP BY 1, 2, 3"""
O["sort_fragments"] = "SELECT contig, frag_start, frag_end, barcode_sample, num_reads, pseudobulk_id FROM members"
O["accession_qc_sink"] = f"SELECT {_COMBINED_DOUBLE} FROM combined"
O["expression_sink"] = f"SELECT {_EXPR} FROM expr"
O["counts_sink"] = O["rna_subset"] = """SELECT a.pseudobulk_id, c.* FROM counts c
JOIN asg a USING (analysis_set_accession, barcode_sample)"""
O["shift_fragments"] = "SELECT * REPLACE (frag_start + 4 AS frag_start, frag_end - 4 AS frag_end) FROM fragments"
O["insertions"] = "SELECT * FROM ins"
O["size_class"] = """SELECT analysis_set_accession, CASE WHEN frag_end - frag_start - 8 < 148 THEN 'nucleosome_free'
 WHEN frag_end - frag_start - 8 < 295 THEN 'mono_nucleosomal' ELSE 'other' END AS size_class, count(*) AS n
FROM fragments GROUP BY 1, 2"""
O["contig_gate"] = "SELECT * FROM fragments WHERE contig IN (SELECT chr FROM chrom_sizes)"
O["cell_name_mapping"] = """SELECT DISTINCT pseudobulk_id, cell_name, annotation, CL_id, cell_description, subsample FROM cells"""
O["assign_pseudobulk"] = """SELECT f.*, a.pseudobulk_id FROM fragments f
LEFT JOIN asg a USING (analysis_set_accession, barcode_sample)"""
O["pseudoreps"] = "SELECT * FROM members"
O["barcode_qc"] = O["stream_barcode_qc"] = f"SELECT {_ATAC} FROM atacqc"
O["tss_pairs"] = "SELECT * FROM pairs"
O["tss_profile"] = "SELECT analysis_set_accession, barcode_sample, slot, count(*) AS n FROM pairs GROUP BY 1, 2, 3"
O["tss_enrichment"] = """SELECT analysis_set_accession, barcode_sample, center, flank,
round((center / 11.0) / (flank / 200.0 + 0.1), 6) AS tss_enrichment FROM enrich"""
O["accession_list"] = "SELECT DISTINCT analysis_set_accession FROM metadata ORDER BY 1"
O["sort_intervals"] = """SELECT f.*, c.chrom_order FROM fragments f LEFT JOIN chrom_sizes c ON f.contig = c.chr"""
O["clip_intervals"] = """SELECT f.* FROM fragments f JOIN chrom_sizes c ON f.contig = c.chr
WHERE frag_start >= 0 AND frag_end <= size"""
O["trim_intervals"] = """SELECT f.* REPLACE (greatest(frag_start, 0) AS frag_start, least(frag_end, size) AS frag_end)
FROM fragments f JOIN chrom_sizes c ON f.contig = c.chr WHERE greatest(frag_start, 0) < least(frag_end, size)"""
_RUNS = """SELECT {keys}, start, "end", depth FROM (
 SELECT {keys}, edge AS start, lead(edge) OVER (PARTITION BY {keys} ORDER BY edge) AS "end",
        CAST(sum(d) OVER (PARTITION BY {keys} ORDER BY edge) AS BIGINT) AS depth
 FROM (SELECT {keys}, edge, sum(d) AS d FROM ({edges}) GROUP BY {keys}, edge) WHERE d <> 0) WHERE depth > 0"""
O["coverage"] = _RUNS.format(keys="contig", edges="""SELECT contig, frag_start AS edge, 1 AS d FROM fragments
 UNION ALL SELECT contig, frag_end, -1 FROM fragments""")
O["raw_insertions"] = O["bedgraph_sink"] = _RUNS.format(keys="pseudobulk_id, contig", edges="""SELECT pseudobulk_id, contig, pos AS edge, 1 AS d
 FROM memberins WHERE rep = 't' UNION ALL SELECT pseudobulk_id, contig, pos + 1, -1 FROM memberins WHERE rep = 't'""")
O["peak_coverage"] = _RUNS.format(keys="pseudobulk_id, contig", edges="""SELECT pseudobulk_id, contig, pk_start AS edge, 1 AS d
 FROM peaks_by_rep WHERE rep = 't' UNION ALL SELECT pseudobulk_id, contig, pk_end, -1 FROM peaks_by_rep WHERE rep = 't'""")
O["rna_cell_qc"] = f"SELECT analysis_set_accession, barcode_sample, annotated, pseudobulk_id, rna_read_count, gene_count, {_round('pct_mito, pct_ribo')} FROM rnaqc"
O["rna_gene_qc"] = """SELECT analysis_set_accession, gene_id, n_cells_by_counts,
round(total / cells_n, 6) AS mean_counts, round(100.0 * (cells_n - n_cells_by_counts) / cells_n, 6) AS pct_dropout_by_counts,
total AS total_counts
FROM (SELECT analysis_set_accession, gene_id, count(*) FILTER (WHERE count > 0) AS n_cells_by_counts,
      CAST(sum(count) AS BIGINT) AS total FROM counts GROUP BY 1, 2)
JOIN (SELECT analysis_set_accession, count(DISTINCT barcode_sample) AS cells_n FROM counts GROUP BY 1) USING (analysis_set_accession)"""
O["annotate_genes"] = """SELECT u.analysis_set_accession, u.gene_id, g.gene_name AS gene_symbol,
coalesce(g.mt, FALSE) AS mt, coalesce(g.ribo, FALSE) AS ribo FROM gene_universe u LEFT JOIN gene_info g USING (gene_id)"""
O["shared_genes"] = "SELECT * FROM shared"
O["pseudobulk_expression"] = f"SELECT {_EXPR} FROM expr"
O["treatment_pileup"] = """SELECT pseudobulk_id, rep, contig, start, "end", round(depth * 1e6 / tags, 6) AS value
FROM pileup JOIN tagtotals USING (pseudobulk_id, rep) WHERE depth > 0"""
O["control_lambda"] = f"""SELECT pseudobulk_id, rep, contig, start, "end",
round(greatest(depth * 150.0 / 10000.0, tags * 150.0 / {GENOME_SIZE}.0), 6) AS value
FROM lambdas JOIN tagtotals USING (pseudobulk_id, rep) WHERE depth > 0"""
_OVERLAY = """SELECT pseudobulk_id, contig, s AS start, e AS "end", {values} FROM (
 SELECT pseudobulk_id, contig, edge AS s, lead(edge) OVER (PARTITION BY pseudobulk_id, contig ORDER BY edge) AS e
 FROM (SELECT DISTINCT pseudobulk_id, contig, start AS edge FROM {track}
       UNION SELECT DISTINCT pseudobulk_id, contig, "end" FROM {track})) x
ASOF JOIN (SELECT * FROM {track} WHERE rep = '1') a ON a.pseudobulk_id = x.pseudobulk_id AND a.contig = x.contig AND s >= a.start
ASOF JOIN (SELECT * FROM {track} WHERE rep = '2') b ON b.pseudobulk_id = x.pseudobulk_id AND b.contig = x.contig AND s >= b.start
ASOF JOIN (SELECT * FROM {track} WHERE rep = 't') c ON c.pseudobulk_id = x.pseudobulk_id AND c.contig = x.contig AND s >= c.start
WHERE e <= a."end" AND e <= b."end" AND e <= c."end" """
_OVERLAY = _OVERLAY.replace("SELECT pseudobulk_id, contig, s AS start", "SELECT x.pseudobulk_id, x.contig, s AS start")
PARTS["covered"] = "SELECT * FROM pileup WHERE depth > 0"
PARTS["clipped"] = """SELECT t.* FROM scored t JOIN chrom_sizes z ON t.contig = z.chr WHERE t."end" <= z.size"""
O["overlay_tracks"] = _OVERLAY.format(track="covered", values="a.depth::DOUBLE AS rep_1, b.depth::DOUBLE AS rep_2, c.depth::DOUBLE AS rep_t")
O["fisher_combine"] = ("""SELECT pseudobulk_id, contig, start, "end", round((s - ln(1 + s + s * s / 2)) / ln(10), 6) AS value FROM ("""
                       + _OVERLAY.format(track="clipped", values="(a.score + b.score + c.score) * ln(10) AS s") + ")")
O["poisson_score"] = f"""SELECT pseudobulk_id, rep, contig, start, "end", pileup, {_round('lam').replace('AS lam', 'AS "lambda"')}, {_round('score')} FROM scored"""
O["poisson_score_native"] = f"""SELECT pileup, {_round('lam').replace('AS lam', 'AS "lambda"')}, {_round('score')} FROM pscores"""
O["poisson_score_deep"] = """SELECT c_custkey, round(lam, 6) AS background, k AS pileup, round(CASE WHEN k + 1 > lam
 THEN -((k + 1) * ln(lam) - lam - lgamma(k + 2) + ln(list_sum(list_transform(range(k + 1, k + 2 + CAST(ceil(12 * sqrt(lam + k + 1) + 60) AS BIGINT)), lambda i: exp((i - k - 1) * ln(lam) - lgamma(i + 1) + lgamma(k + 2)))))) / ln(10)
 ELSE -log10(1 - list_sum(list_transform(range(greatest(0, k - CAST(ceil(12 * sqrt(lam + 1) + 60) AS BIGINT)), k + 1), lambda i: exp(i * ln(lam) - lam - lgamma(i + 1))))) END, 6) AS score
FROM (SELECT c_custkey, lam, CAST(floor(lam * (0.9::DOUBLE + (c_custkey % 21) / 100.0::DOUBLE)) AS BIGINT) AS k
      FROM (SELECT c_custkey, pow(10.0::DOUBLE, (CAST(c_custkey AS BIGINT) * 7919 % 801) / 100.0::DOUBLE - 2.0::DOUBLE) AS lam FROM customer))"""
O["track_zooms"] = """SELECT pseudobulk_id, rep, contig, k AS level, w AS window, sum(depth * (hi - lo)) AS value_sum,
min(depth) AS min_value, max(depth) AS max_value, CAST(sum(hi - lo) AS BIGINT) AS covered
FROM (SELECT pseudobulk_id, rep, contig, depth::DOUBLE AS depth, k, w, greatest(start, w << k) AS lo, least("end", (w + 1) << k) AS hi
      FROM (SELECT *, unnest(range(start >> k, (("end" - 1) >> k) + 1)) AS w
            FROM (SELECT * FROM pileup WHERE depth > 0), (SELECT unnest(range(6, 26, 2)) AS k)))
GROUP BY 1, 2, 3, 4, 5"""
O["sorted_region"] = f"""SELECT pseudobulk_id, contig, frag_start, frag_end, barcode_sample, num_reads FROM members
WHERE contig = 'chr3' AND frag_start < 9000000 AND frag_end > 4000000"""
O["text_md5"] = "SELECT doc_id, md5(text) AS md5 FROM documents"
O["call_regions"] = """SELECT pseudobulk_id, rep, contig, min(start) AS pk_start, max("end") AS pk_end,
CAST(floor((first(start ORDER BY pileup DESC, score DESC, start) + first("end" ORDER BY pileup DESC, score DESC, start)) / 2) AS BIGINT) AS summit,
max(pileup) AS pileup,
round(max(pileup) / first(lam ORDER BY pileup DESC, score DESC, start), 6) AS signal_value,
round(first(score ORDER BY pileup DESC, score DESC, start), 6) AS neg_log10_p
FROM chained GROUP BY pseudobulk_id, rep, contig, island HAVING max("end") - min(start) >= 150"""
O["summits"] = f"SELECT {_CALLED} FROM localmax"
O["narrow_peaks"] = f"SELECT {_NARROW} FROM localmax"
O["top_peaks"] = f"""SELECT {_PEAK} FROM (SELECT *, row_number() OVER (PARTITION BY pseudobulk_id, rep
 ORDER BY neg_log10_p DESC, contig, pk_start, pk_end) AS rn FROM peaks_by_rep) WHERE rn <= {TOP_N}"""
O["reproducible_peaks"] = f"SELECT {_PEAK} FROM repro"
O["blacklist_filter"] = f"SELECT {_PEAK} FROM peaks_by_rep p WHERE {_CLEAR}"
O["fragments_in_peaks"] = "SELECT * FROM inpeaks"
O["frip_per_cell"] = "SELECT * REPLACE (round(frip, 6) AS frip) FROM fripcells"
PARTS["toppeaks"] = f"SELECT * FROM (SELECT {_NARROW} FROM localmax)"
PARTS["calledrepro"] = PARTS["repro"].replace("peaks_by_rep", "toppeaks")
O["called_peaks"] = f"SELECT * EXCLUDE (name) FROM calledrepro p WHERE {_CLEAR}"
O["atac_with_frip"] = f"SELECT {_ATAC}, round(frip, 6) AS frip FROM (SELECT q.*, f.frip FROM atacqc q LEFT JOIN fripcells f USING (analysis_set_accession, barcode_sample))"
O["combined_cell_qc"] = f"SELECT {_COMBINED} FROM combined"
O["per_cell_qc"] = f"""SELECT pseudobulk_id, analysis_set_accession, barcode_sample, subsample, rna_read_count, gene_count,
{_round('pct_mito, pct_ribo')}, num_frags, {_round('pct_duplicated_reads, nucleosomal_signal, tss_enrichment, frip')} FROM percell"""
O["pseudobulk_summary"] = """SELECT directory_name, concat(n.cell_name, '-', n.subsample) AS pseudobulk, n.cell_name, n.subsample,
 num_cells, coalesce(rna, 0) AS rna_read_count, coalesce(gene_n, 0) AS gene_count,
 round(100.0 * mt / nullif(rna, 0), 6) AS pct_mito, round(100.0 * ribo / nullif(rna, 0), 6) AS pct_ribo,
 coalesce(frags, 0) AS num_frags, round(100.0 * (reads - frags) / reads, 6) AS pct_duplicated_reads,
 round((1 + mono) / (1 + free), 6) AS nucleosomal_signal,
 round((center / 11.0) / (flank / 200.0 + 0.1), 6) AS tss_enrichment, round(frip, 6) AS frip
FROM (SELECT pseudobulk_id AS directory_name, count(*) AS num_cells FROM percell GROUP BY 1) c
JOIN (SELECT DISTINCT pseudobulk_id, cell_name, subsample FROM asg) n ON n.pseudobulk_id = directory_name
LEFT JOIN (SELECT pseudobulk_id, CAST(sum(num_frags) AS BIGINT) AS frags, sum("raw-num_reads") AS reads,
  CAST(sum("raw-mono_nucleosomal_frags") AS BIGINT) AS mono, CAST(sum("raw-nucleosome_free_frags") AS BIGINT) AS free,
  CAST(sum("raw-tss_center") AS BIGINT) AS center, CAST(sum("raw-tss_flank") AS BIGINT) AS flank
  FROM atacqc WHERE pseudobulk_id IS NOT NULL GROUP BY 1) a ON a.pseudobulk_id = directory_name
LEFT JOIN (SELECT pseudobulk_id, CAST(sum(counts) AS BIGINT) AS rna, count(*) FILTER (WHERE counts > 0) AS gene_n,
  coalesce(sum(counts) FILTER (WHERE mt), 0) AS mt, coalesce(sum(counts) FILTER (WHERE ribo), 0) AS ribo
  FROM expr GROUP BY 1) r ON r.pseudobulk_id = directory_name
LEFT JOIN (SELECT pseudobulk_id, sum(num_fragments_in_peaks) / sum(num_fragments) AS frip
  FROM fripcells GROUP BY 1) f ON f.pseudobulk_id = directory_name"""
O["cell_set_check"] = """SELECT pseudobulk_id, rna_cells, atac_cells, combined_cells,
rna_cells > 0 AND atac_cells > 0 AND (rna_cells <> atac_cells OR rna_cells <> combined_cells) AS mismatch
FROM (SELECT pseudobulk_id, CAST(sum(r) AS BIGINT) AS rna_cells, CAST(sum(a) AS BIGINT) AS atac_cells, count(*) AS combined_cells
 FROM (SELECT pseudobulk_id, analysis_set_accession, barcode_sample, annotated, max(r) AS r, max(a) AS a
  FROM (SELECT pseudobulk_id, analysis_set_accession, barcode_sample, annotated, 1 AS r, 0 AS a FROM rnaqc
        UNION ALL SELECT pseudobulk_id, analysis_set_accession, barcode_sample, annotated, 0, 1 FROM atacqc)
  WHERE pseudobulk_id IS NOT NULL GROUP BY 1, 2, 3, 4) GROUP BY 1)"""
O["union_relaxed"] = f"""SELECT analysis_set_accession, barcode_sample, pseudobulk_id, rna_read_count::DOUBLE AS rna_read_count, gene_count,
{_round('pct_mito, pct_ribo')}, NULL::DOUBLE AS num_frags FROM rnaqc
UNION ALL SELECT analysis_set_accession, barcode_sample, pseudobulk_id, NULL, NULL, NULL, NULL, num_frags::DOUBLE FROM atacqc"""
O["box_stats"] = f"SELECT metric, n, {_round('min_val, q1, median, q3, max_val, iqr, low, high, symlog_width')} FROM boxes"
O["sketched_quantiles"] = """SELECT metric, count(*) AS n, quantile, TRUE AS within FROM long,
(VALUES (0.0::DOUBLE), (0.05), (0.25), (0.5), (0.75), (0.95), (1.0)) AS q(quantile) GROUP BY metric, quantile"""
O["outliers"] = """WITH_OUT SELECT metric, cell, value, round(CASE WHEN symlog_width IS NULL OR abs(value) < symlog_width THEN value
 ELSE sign(value) * (symlog_width + ln(1 + (abs(value) - symlog_width) / ln(10)) / ln(10)) END, 6) AS scaled_value
FROM (SELECT *, row_number() OVER (PARTITION BY metric, value ORDER BY cell) AS tie FROM outside) o
JOIN (SELECT metric, value, count(*) AS picks FROM (
   SELECT metric, value, n, row_number() OVER (PARTITION BY metric ORDER BY value) - 1 AS spot FROM
     (SELECT *, count(*) OVER (PARTITION BY metric) AS n FROM outside)) r
 WHERE list_contains(list_transform(range(0, least(n, 5)), lambda i:
   CAST(round_even(i * coalesce((n - 1) / nullif(least(n, 5) - 1, 0), 0), 0) AS BIGINT)), spot)
 GROUP BY 1, 2) p USING (metric, value) WHERE tie <= picks""".replace("WITH_OUT ", "")
PARTS["outside"] = """SELECT l.metric, l.cell, l.value, b.symlog_width FROM long l JOIN boxes b USING (metric)
WHERE l.value > b.high OR l.value < b.low"""
O["category_pct"] = """SELECT metric, category, count(*) AS count,
round(count(*) * 100 / sum(count(*)) OVER (PARTITION BY metric), 6) AS pct
FROM (SELECT 'annotated' AS metric, annotated::VARCHAR AS category FROM combined
 UNION ALL SELECT 'found_in_rna', found_in_rna::VARCHAR FROM combined
 UNION ALL SELECT 'found_in_atac', found_in_atac::VARCHAR FROM combined
 UNION ALL SELECT 'pseudobulk_id', pseudobulk_id FROM combined) WHERE category IS NOT NULL GROUP BY 1, 2"""
_FLAGS = """{0}f::BIGINT{1} AS frag, {0}m::BIGINT{1} AS matrix, {0}(f AND NOT m)::BIGINT{1} AS "only-frag",
 {0}(m AND NOT f)::BIGINT{1} AS "only-matrix", {0}(f AND m)::BIGINT{1} AS "both", {0}(NOT f AND NOT m)::BIGINT{1} AS "neither\""""
PARTS["present"] = """SELECT accession, accession IN (SELECT barcode_sample FROM metadata) AS listed,
 accession IN (SELECT barcode_sample FROM fragments) AS f, accession IN (SELECT barcode_sample FROM counts) AS m
FROM (SELECT barcode_sample AS accession FROM metadata UNION SELECT barcode_sample FROM fragments
      UNION SELECT barcode_sample FROM counts)"""
O["input_presence"] = ("SELECT 'summary' AS accession, " + _FLAGS.format("CAST(sum(", ") AS BIGINT)") + " FROM present UNION ALL SELECT accession, "
                       + _FLAGS.format("", "") + " FROM present WHERE listed")
_FS = "concat('FS', CAST(c_custkey AS STRING))"
_PA = "concat('PA', CAST(c_custkey - c_custkey % 8 AS STRING))"
O["lineage"] = f"""SELECT {_FS} AS accession, CASE WHEN c_custkey % 4 = 0 THEN {_FS} ELSE {_PA} END AS principal_accession FROM customer
UNION SELECT {_PA}, {_PA} FROM customer"""
O["route_files"] = f"""SELECT {_FS} AS accession, concat('FF', CAST(c_custkey AS STRING)) AS file_accession,
 'fragments' AS content_type, 'fragments' AS route FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT {_FS}, concat('FM', CAST(c_custkey AS STRING)),
 CASE WHEN c_custkey % 5 = 0 THEN 'sparse gene count matrix' WHEN c_custkey % 5 = 1 THEN 'alignments' ELSE 'cell by gene matrix' END,
 CASE WHEN c_custkey % 5 = 1 THEN 'unused' ELSE 'matrix' END FROM customer
UNION ALL SELECT DISTINCT {_PA}, concat('PF', CAST(c_custkey - c_custkey % 8 AS STRING)), 'fragments', 'fragments'
 FROM customer WHERE (c_custkey - c_custkey % 8) % 48 = 0"""
PARTS["derived"] = f"""SELECT {_FS} AS accession, concat('lab:f', CAST(c_custkey AS STRING)) AS alias, 'direct' AS via
FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT DISTINCT {_PA}, concat('lab:p', CAST(c_custkey - c_custkey % 8 AS STRING)), 'direct'
 FROM customer WHERE (c_custkey - c_custkey % 8) % 48 = 0
UNION ALL SELECT {_PA}, concat('lab:f', CAST(c_custkey AS STRING)), 'intermediate'
 FROM customer WHERE (c_custkey - c_custkey % 8) % 48 <> 0 AND c_custkey % 4 <> 0 AND c_custkey % 3 <> 0"""
O["derived_from"] = "SELECT * FROM derived"
O["alias_lists"] = "SELECT accession, string_agg(alias, ',' ORDER BY alias) AS aliases FROM derived GROUP BY 1"
O["controlled_access"] = f"""SELECT principal_accession, bool_or(c) AS controlled_access FROM (
SELECT CASE WHEN c_custkey % 4 = 0 THEN {_FS} ELSE {_PA} END AS principal_accession, c_custkey % 11 = 0 AS c FROM customer
UNION ALL SELECT {_PA}, FALSE FROM customer) GROUP BY 1"""
O["nested_lookup"] = """SELECT concat('step_', CAST(s_suppkey AS STRING)) AS step,
CASE WHEN s_suppkey % 4 <> 1 THEN concat('v2_', CAST(s_suppkey AS STRING)) END AS version_id,
CASE WHEN s_suppkey % 4 <> 1 THEN concat('lab:s', CAST(s_suppkey AS STRING), '-2') END AS aliases,
s_suppkey % 4 = 1 AS violation FROM supplier"""
PARTS["classes"] = """SELECT * FROM (VALUES
 ('pseudobulk', 'fragments.tsv.gz', TRUE, 'tsv', 'fragments'), ('pseudobulk', 'peaks.narrowPeak.gz', TRUE, 'bed', 'peaks'),
 ('pseudobulk', 'pseudobulk_expression.tsv.gz', TRUE, 'tsv', 'gene quantifications'),
 ('pseudobulk', 'per_cell_qc.tsv.gz', FALSE, 'tsv', 'per-cell quality report'),
 ('pseudobulk', 'rna_counts_mtx.h5ad', TRUE, 'h5ad', 'cell by gene matrix'),
 ('pseudobulk', 'peaks_minuslog10pval.bw', TRUE, 'bigWig', 'ATAC-seq signal p-value'),
 ('pseudobulk', 'raw_insertions.bw', TRUE, 'bigWig', 'ATAC-seq signal'),
 ('intermediate', '*_per_cell_qc.tsv.gz', FALSE, 'tsv', 'per-barcode quality report'),
 ('principal', 'pseudobulk_qc.tsv.gz', FALSE, 'tsv', 'aggregated pseudobulk quality report'))
 AS v(category, pattern, optional, format, content_type)"""
O["file_classes"] = "SELECT l.*, c.* FROM file_listing l JOIN classes c ON l.name GLOB c.pattern"
O["inventory"] = """SELECT f.folder, c.pattern, c.content_type, l.name,
CASE WHEN l.name IS NOT NULL THEN 'found' WHEN c.optional THEN 'absent' ELSE 'missing' END AS state
FROM (SELECT DISTINCT folder FROM file_listing) f CROSS JOIN (SELECT * FROM classes WHERE category = 'pseudobulk') c
LEFT JOIN file_listing l ON l.folder = f.folder AND l.name GLOB c.pattern"""
O["id_reconcile"] = """SELECT coalesce(f.b, m.b) AS barcode_sample,
CASE WHEN f.b IS NULL THEN 'right_only' WHEN m.b IS NULL THEN 'left_only' ELSE 'both' END AS status
FROM (SELECT DISTINCT barcode_sample AS b FROM fragments) f FULL JOIN (SELECT DISTINCT barcode_sample AS b FROM metadata) m ON f.b = m.b"""

O["tss_profile_pseudobulk"] = """SELECT pseudobulk_id, slot, count(*) AS n FROM pairs
JOIN asg USING (analysis_set_accession, barcode_sample) GROUP BY 1, 2"""
O["tss_rows"] = """SELECT analysis_set_accession, barcode_sample, slot, count(*) AS n FROM pairs
WHERE (analysis_set_accession, barcode_sample) IN (
  SELECT (analysis_set_accession, barcode_sample) FROM fragments GROUP BY analysis_set_accession, barcode_sample HAVING count(*) >= 5)
GROUP BY 1, 2, 3"""
O["assign_repeated"] = """SELECT DISTINCT analysis_set_accession, barcode_sample, concat(cell_name, ' again') AS cell_name FROM metadata"""
O["scan_inputs"] = "SELECT * FROM counts"
O["inventory_folders"] = O["inventory"].replace(
    "(SELECT DISTINCT folder FROM file_listing) f",
    "(SELECT folder FROM file_listing UNION SELECT concat('empty_', CAST(s_suppkey AS STRING)) FROM supplier) f")
O["plan_inventory"] = """SELECT f.folder, c.pattern, c.content_type, CASE WHEN c.optional THEN 'absent' ELSE 'missing' END AS state,
'right_only' AS status FROM (SELECT DISTINCT pseudobulk_id AS folder FROM cells) f
CROSS JOIN (SELECT * FROM classes WHERE category = 'pseudobulk') c"""
O["gtf_genes_repeated"] = f"SELECT * REPLACE (replace(gene_name, 'GENE', 'LATE') AS gene_name) FROM ({_GTF_GENE})"
O["sparse_counts"], O["sparse_cell_qc"] = O["scan_counts"], O["rna_cell_qc"]
# A plan that is written and read back holds what its operators compute.
for _plan, _same in {"plan_split_fragments": "barcode_qc", "plan_rna": "rna_cell_qc", "plan_call_peaks": "called_peaks",
                     "plan_summary": "pseudobulk_summary", "plan_combine": "combined_cell_qc",
                     "plan_report_boxes": "box_stats", "plan_report_outliers": "outliers", "plan_report_categories": "category_pct",
                     "plan_gene_info": "gtf_genes", "plan_tss": "gtf_tss"}.items():
    O[_plan] = O[_same]


def statement(select: str) -> str:
    """The select with every view and part it needs in front of it."""
    bodies = {name: duck(name) for name in VIEWS} | PARTS
    needed: dict[str, str] = {}

    def need(text: str) -> None:
        for name in bodies:
            if name not in needed and re.search(rf"\b{name}\b", text):
                need_body = bodies[name]
                need(need_body) if name not in needed else None
                needed[name] = need_body

    need(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in needed.items()) + "\n" + select


def oracle_statements() -> dict[str, str]:
    return {key: statement(select) for key, select in ORACLES.items()}
