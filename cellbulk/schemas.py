"""Column layouts of the native inputs and of the published outputs.

Fixed values: the names are those of the published tables.
"""

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in cols.items()])


FRAGMENT = _struct(contig=_S, frag_start=_L, frag_end=_L, barcode_sample=_S, num_reads=_L)
# A struct's own ``add`` changes it in place, so the longer layout is a struct of its own.
SORTED_FRAGMENT = T.StructType([*FRAGMENT.fields, T.StructField("pseudobulk_id", _S)])
CHROM_SIZES = _struct(chr=_S, size=_L)
TSS = _struct(gene=_S, transcript=_S, chro=_S, TSS=_L, strand=_S)
GENE_INFO = _struct(gene_id=_S, gene_name=_S, mt=_B, ribo=_B)
COUNTS = _struct(analysis_set_accession=_S, barcode_sample=_S, gene_id=_S, count=_L)

METADATA_REQUIRED = (
    "barcode_sample", "cell_name", "cell_description", "CL_id", "CL_term_name",
    "subsample", "analysis_set_accession",
)

MAPPING_COLUMNS = (
    "pseudobulk_id", "cell_name", "annotation", "CL_id", "cell_description", "subsample",
)

# The TSS matrix summed over the two bands the enrichment needs: additive, so a
# pseudobulk value is a sum of barcode values.
ATAC_TSS_COLUMNS = ("raw-tss_center", "raw-tss_flank")

FRONT_COLUMNS = (
    "analysis_set_accession", "barcode_sample", "annotated", "found_in_rna",
    "found_in_atac", "pseudobulk_id",
)
PER_CELL_COLUMNS = (
    "analysis_set_accession", "barcode_sample", "subsample", "rna_read_count", "gene_count",
    "pct_mito", "pct_ribo", "num_frags", "pct_duplicated_reads", "nucleosomal_signal",
    "tss_enrichment", "frip",
)

ACCESSION_QC = _struct(
    analysis_set_accession=_S, barcode_sample=_S, annotated=_B, found_in_rna=_B,
    found_in_atac=_B, pseudobulk_id=_S, rna_read_count=_D, gene_count=_D, pct_mito=_D,
    pct_ribo=_D, num_frags=_D, pct_duplicated_reads=_D, nucleosomal_signal=_D,
    tss_enrichment=_D,
)

_FILE = _struct(accession=_S, content_type=_S, aliases=T.ArrayType(_S))
FILE_SET_RECORD = _struct(
    accession=_S,
    controlled_access=_B,
    input_for=T.ArrayType(_S),
    input_file_sets=T.ArrayType(_struct(accession=_S, file_set_type=_S)),
    files=T.ArrayType(_FILE),
)
STEP_RECORD = _struct(
    step=_S,
    analysis_step_versions=T.ArrayType(
        _struct(version_id=_S, aliases=T.ArrayType(_S),
                software_versions=T.ArrayType(_struct(name=_S)))
    ),
)
