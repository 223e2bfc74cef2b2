"""Genomic tables derived from the driver's star-schema tables.

Every view reads all rows of its base table, and every text is accepted by both
Spark SQL and DuckDB, so the oracles start from the same rows. ``{name}`` marks
a base table or an earlier view.
"""


from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

GENOME_SIZE = 100_000_000

VIEWS: dict[str, str] = {}

# Fragments gather around the site of their supplier or part. Half of them carry
# accession ACC3; chrUn_1 is not in chrom_sizes; one order in 500 has fragments
# longer than a join bin; chr5 is shorter than its largest positions.
VIEWS["fragments"] = """
SELECT concat('ACC', CAST(least(k % 6, 3) AS STRING)) AS analysis_set_accession,
       contig, frag_start,
       frag_start + 30 + cents % 420 + CASE WHEN k % 500 = 13 THEN 6000 ELSE 0 END AS frag_end,
       concat('BC', CAST(CAST((k - k % 50) / 50 AS BIGINT) AS STRING)) AS barcode_sample,
       1 + qty % 4 AS num_reads
FROM (
  SELECT l_orderkey AS k,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         CAST(round(l_quantity) AS BIGINT) AS qty,
         CASE WHEN l_linenumber > 3 THEN concat('chr', CAST(1 + l_partkey % 5 AS STRING))
              WHEN l_suppkey % 20 = 0 THEN 'chrM'
              WHEN l_suppkey % 20 = 1 THEN 'chrUn_1'
              ELSE concat('chr', CAST(1 + l_suppkey % 5 AS STRING)) END AS contig,
         CASE WHEN l_linenumber > 3 THEN (l_partkey * 104729) % 19980000
              ELSE (l_suppkey * 1500451) % 19980000 END
           + 10000 + (l_orderkey * 37 + l_linenumber * 1009) % 2400 - 1200 AS frag_start
  FROM {lineitem}
) t
"""

# One row per annotated cell; every fifth cell carries a barcode that no
# fragment or count has, so its own barcode stays unannotated.
VIEWS["metadata"] = """
SELECT DISTINCT
       concat('BC', CAST(CASE WHEN cell % 5 = 0 THEN cell + 100000000000 ELSE cell END AS STRING))
         AS barcode_sample,
       concat('type_', CAST((cell * 3) % 7 AS STRING)) AS cell_name,
       concat('cell type ', CAST((cell * 3) % 7 AS STRING)) AS cell_description,
       concat('CL:', CAST(100 + (cell * 3) % 7 AS STRING)) AS CL_id,
       concat('term ', CAST((cell * 3) % 7 AS STRING)) AS CL_term_name,
       concat('SM', CAST(cell % 3 AS STRING)) AS subsample,
       concat('ACC', CAST(least(o_orderkey % 6, 3) AS STRING)) AS analysis_set_accession
FROM (SELECT o_orderkey, CAST((o_orderkey - o_orderkey % 50) / 50 AS BIGINT) AS cell
      FROM {orders}) t
"""

VIEWS["chrom_sizes"] = """
SELECT chr, CAST(size AS BIGINT) AS size, chrom_order
FROM (VALUES ('chr1', 20000000, 1), ('chr2', 20000000, 2), ('chr3', 20000000, 3),
             ('chr4', 20000000, 4), ('chr5', 15000000, 5), ('chrM', 20000000, 6))
     AS t(chr, size, chrom_order)
"""

VIEWS["tss"] = """
SELECT s_name AS gene, concat('T', CAST(s_suppkey AS STRING)) AS transcript,
       CASE WHEN s_suppkey % 20 = 0 THEN 'chrM'
            WHEN s_suppkey % 20 = 1 THEN 'chrUn_1'
            ELSE concat('chr', CAST(1 + s_suppkey % 5 AS STRING)) END AS chro,
       10001 + (s_suppkey * 1500451) % 19980000 AS TSS,
       CASE WHEN s_nationkey % 2 = 0 THEN '+' ELSE '-' END AS strand
FROM {supplier}
"""

VIEWS["peaks_by_rep"] = """
SELECT concat('annotation_', CAST((p_partkey * 3) % 7 AS STRING), '-SM',
              CAST(p_partkey % 3 AS STRING)) AS pseudobulk_id,
       r.rep,
       concat('chr', CAST(1 + p_partkey % 5 AS STRING)) AS contig,
       10000 + (p_partkey * 104729) % 19980000 + r.shift * (p_partkey % 9) AS pk_start,
       10000 + (p_partkey * 104729) % 19980000 + r.shift * (p_partkey % 9)
         + 300 + (p_partkey % 7) * 50
         + CASE WHEN p_partkey % 300 = 17 THEN 5000 ELSE 0 END AS pk_end,
       round(abs(p_retailprice) / 100.0, 4) AS neg_log10_p,
       p_partkey AS peak_no
FROM {part} CROSS JOIN (VALUES ('t', 0), ('1', 40), ('2', -25)) AS r(rep, shift)
"""

VIEWS["blacklist"] = """
SELECT concat('chr', CAST(1 + c_custkey % 5 AS STRING)) AS contig,
       10000 + (c_custkey * 104729) % 19980000 + 100 AS bl_start,
       10000 + (c_custkey * 104729) % 19980000 + 100 + (c_custkey % 7) * 40 AS bl_end
FROM {customer}
"""

# Gene lists differ between accessions: some genes of ACC0 get an id that the
# gene table does not know. Cells are shifted against the fragments, so a few
# barcodes exist on one side only.
VIEWS["counts"] = """
SELECT analysis_set_accession, barcode_sample, gene_id,
       CAST(sum(qty) AS BIGINT) AS count
FROM (
  SELECT concat('ACC', CAST(least(l_orderkey % 6, 3) AS STRING)) AS analysis_set_accession,
         concat('BC', CAST(CAST((l_orderkey - l_orderkey % 50) / 50 AS BIGINT) + 12 AS STRING))
           AS barcode_sample,
         concat(CASE WHEN l_orderkey % 6 = 0 AND l_partkey % 97 = 7 THEN 'X' ELSE 'G' END,
                CAST(l_partkey AS STRING)) AS gene_id,
         CAST(round(l_quantity) AS BIGINT) AS qty
  FROM {lineitem}
) t
GROUP BY 1, 2, 3
"""

VIEWS["gene_universe"] = """
SELECT DISTINCT analysis_set_accession, gene_id FROM {counts}
"""

VIEWS["gene_info"] = """
SELECT concat('G', CAST(p_partkey AS STRING)) AS gene_id,
       concat(CASE WHEN p_partkey % 20 = 0 THEN 'MT-' WHEN p_partkey % 20 = 1 THEN 'RPS'
                   WHEN p_partkey % 20 = 2 THEN 'Rpl' ELSE 'GENE' END,
              CAST(p_partkey AS STRING)) AS gene_name,
       p_partkey % 20 = 0 AS mt,
       p_partkey % 20 = 1 OR p_partkey % 20 = 2 AS ribo
FROM {part}
"""

VIEWS["gtf_lines"] = """
SELECT concat('chr', CAST(1 + p_partkey % 5 AS STRING), chr(9), 'SRC', chr(9), f.feature, chr(9),
              CAST(1000 + (p_partkey * 104729) % 19980000 AS STRING), chr(9),
              CAST(3000 + (p_partkey * 104729) % 19980000 AS STRING), chr(9), '.', chr(9),
              CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END, chr(9), '.', chr(9),
              'gene_id "G', CAST(p_partkey AS STRING), '"; ',
              CASE WHEN f.feature = 'gene' THEN '' ELSE concat('transcript_name "T',
                   CAST(p_partkey AS STRING), '"; ') END,
              CASE WHEN f.feature = 'gene' AND p_partkey % 10 = 3 THEN ''
                   ELSE concat('gene_name "', CASE WHEN p_partkey % 20 = 0 THEN 'MT-'
                               WHEN p_partkey % 20 = 1 THEN 'RPS' ELSE 'GENE' END,
                               CAST(p_partkey AS STRING), '"; ') END,
              'level 2;') AS value
FROM {part} CROSS JOIN (VALUES ('gene'), ('transcript'), ('exon')) AS f(feature)
UNION ALL
SELECT concat('# comment for ', p_name) AS value FROM {part}
"""

# Portal-like records as JSON text: one intermediate set per customer and one
# principal set per block of eight customers.
VIEWS["file_set_json"] = """
SELECT concat('{{"accession":"FS', CAST(c_custkey AS STRING), '","controlled_access":',
         CASE WHEN c_custkey % 11 = 0 THEN 'true' ELSE 'false' END,
         CASE WHEN c_custkey % 4 = 0 THEN ''
              ELSE concat(',"input_for":["PA', CAST((c_custkey - c_custkey % 8) AS STRING), '"]') END,
         ',"input_file_sets":[],"files":[',
         CASE WHEN c_custkey % 3 = 0 THEN ''
              ELSE concat('{{"accession":"FF', CAST(c_custkey AS STRING),
                          '","content_type":"fragments","aliases":["lab:f',
                          CAST(c_custkey AS STRING), '"]}},') END,
         '{{"accession":"FM', CAST(c_custkey AS STRING), '","content_type":"',
         CASE WHEN c_custkey % 5 = 0 THEN 'sparse gene count matrix'
              WHEN c_custkey % 5 = 1 THEN 'alignments' ELSE 'cell by gene matrix' END,
         '","aliases":["lab:m', CAST(c_custkey AS STRING), '","lab:n',
         CAST(c_custkey AS STRING), '"]}}]}}') AS value
FROM {customer}
UNION ALL
SELECT concat('{{"accession":"PA', CAST(block AS STRING),
         '","controlled_access":false,"input_file_sets":[', string_agg(member, ','),
         '],"files":[',
         CASE WHEN block % 48 = 0 THEN concat('{{"accession":"PF', CAST(block AS STRING),
              '","content_type":"fragments","aliases":["lab:p', CAST(block AS STRING), '"]}}')
              ELSE '' END,
         ']}}') AS value
FROM (SELECT c_custkey - c_custkey % 8 AS block,
             concat('{{"accession":"FS', CAST(c_custkey AS STRING), '","file_set_type":"',
                    CASE WHEN c_custkey % 4 = 0 THEN 'measurement set'
                         ELSE 'intermediate analysis' END, '"}}') AS member
      FROM {customer}) t
GROUP BY block
"""

VIEWS["step_json"] = """
SELECT concat('{{"step":"step_', CAST(s_suppkey AS STRING), '","analysis_step_versions":[',
         '{{"version_id":"v1_', CAST(s_suppkey AS STRING),
         '","aliases":["lab:s', CAST(s_suppkey AS STRING), '-1"],',
         '"software_versions":[{{"name":"tool-v1"}},{{"name":"other-v7"}}]}},',
         '{{"version_id":"v2_', CAST(s_suppkey AS STRING),
         '","aliases":["lab:s', CAST(s_suppkey AS STRING), '-2"],"software_versions":[{{"name":"',
         CASE WHEN s_suppkey % 4 = 1 THEN 'tool-v3' ELSE 'tool-v2' END,
         '"}}]}}]}}') AS value
FROM {supplier}
"""

# Output listing: six file names per customer; one of them is mistyped for most
# customers, so a class is missing there.
VIEWS["file_listing"] = """
SELECT concat('annotation_', CAST(c_custkey AS STRING), '-SM', CAST(c_nationkey AS STRING))
         AS folder,
       CASE WHEN c_custkey % 7 = f.n THEN concat(f.name, '.part') ELSE f.name END AS name
FROM {customer} CROSS JOIN (VALUES ('fragments.tsv.gz', 1), ('peaks.narrowPeak.gz', 2),
     ('pseudobulk_expression.tsv.gz', 3), ('per_cell_qc.tsv.gz', 4),
     ('peaks_minuslog10pval.bw', 5), ('notes.txt', 6)) AS f(name, n)
"""


def duck(name: str) -> str:
    """The view's text for DuckDB, where base tables and CTEs go by their names."""
    names = {n: n for n in (*BASE_TABLES, *VIEWS)}
    return VIEWS[name].format(**names).strip()


class Tables:
    """Base tables of one scale-factor folder and the views derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in VIEWS and name not in BASE_TABLES):
            raise AttributeError(name)
        if name not in self._made:
            if name in BASE_TABLES:
                frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                text = VIEWS[name]
                inputs = {n: getattr(self, n) for n in (*BASE_TABLES, *VIEWS)
                          if f"{{{n}}}" in text}
                frame = self.spark.sql(text, **inputs)
            self._made[name] = frame
        return self._made[name]
