"""Default parameters shared by every operator that needs them."""

# The Tn5 offset, fragment size classes and TSS geometry that the
# quality metrics are defined by.
TN5_SHIFT = 4
NUCLEOSOME_FREE_BELOW = 148
MONO_NUCLEOSOME_BELOW = 295
TSS_HALF_WINDOW = 2000
TSS_HALF_SMOOTH = 5
TSS_FLANK = 100
TSS_PSEUDOCOUNT = 0.1
MITO_CONTIG = "chrM"

# Gene-name prefixes of mitochondrial and ribosomal genes.
MITO_PREFIXES = ("MT-", "mt-")
RIBO_PREFIXES = ("RPS", "RPL", "Rps", "Rpl")

# Peak-calling settings (tag width, control window, p <= 0.01,
# overlap fraction of replicate peaks, number of top peaks kept).
TAG_EXTENSION = 150
CONTROL_WINDOW = 10_000
SCORE_CUTOFF = 2.0
MIN_PEAK_LENGTH = 150
MAX_PEAK_GAP = 1
MIN_OVERLAP = 0.5
TOP_PEAKS = 300_000
HUMAN_GENOME_SIZE = 2_913_022_398

# Physical defaults. TILE is the width of the genome slice one window task
# handles, POINT_TILE that of one call over Arrow tables; BIN is the width used to turn overlap predicates into equi-joins. Bins of more
# than HEAVY_ROWS rows are split, at most HEAVY_BINS of them.
TILE = 1 << 16
POINT_TILE = 1 << 20
BIN = 1 << 11
HEAVY_ROWS = 1_000_000
HEAVY_BINS = 1 << 15
