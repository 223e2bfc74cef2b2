"""Output inventory: classes of files, expected files, lineage and id checks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The published file classes with their name pattern, whether one
# may be missing, format and content type.
FILE_CLASSES = (
    ("pseudobulk", "fragments.tsv.gz", True, "tsv", "fragments"),
    ("pseudobulk", "peaks.narrowPeak.gz", True, "bed", "peaks"),
    ("pseudobulk", "pseudobulk_expression.tsv.gz", True, "tsv", "gene quantifications"),
    ("pseudobulk", "per_cell_qc.tsv.gz", False, "tsv", "per-cell quality report"),
    ("pseudobulk", "rna_counts_mtx.h5ad", True, "h5ad", "cell by gene matrix"),
    ("pseudobulk", "peaks_minuslog10pval.bw", True, "bigWig", "ATAC-seq signal p-value"),
    ("pseudobulk", "raw_insertions.bw", True, "bigWig", "ATAC-seq signal"),
    ("intermediate", "*_per_cell_qc.tsv.gz", False, "tsv", "per-barcode quality report"),
    ("principal", "pseudobulk_qc.tsv.gz", False, "tsv", "aggregated pseudobulk quality report"),
)

# Content types routed to each kind of input.
MATRIX_TYPES = ("sparse gene count matrix", "cell by gene matrix")
FRAGMENT_TYPES = ("fragments",)


def glob_regex(pattern: str) -> str:
    """Regular expression for a shell pattern with *, ?, [set] and [!set]; a bracket
    without its end stands for itself."""
    found, at = "", 0
    while at < len(pattern):
        c, at = pattern[at], at + 1
        if c in "*?":
            found += ".*" if c == "*" else "."
            continue
        negated = c == "[" and pattern[at:at + 1] == "!"
        end = pattern.find("]", at + negated + 1) if c == "[" else -1
        if end < 0:
            found += f"\\Q{c}\\E"
            continue
        members = "".join(m if m.isalnum() or m == "-" else f"\\{m}" for m in pattern[at + negated:end])
        found, at = found + f"[{'^' if negated else ''}{members}]", end + 1
    return f"(?s)^{found}$"


def _classes(category: str | None) -> list[tuple[Column, Column]]:
    """(class, whether ``name`` matches it) of each class; every pattern is a literal, so
    it is compiled once."""
    rows = [r for r in FILE_CLASSES if category in (None, r[0])]
    if not rows:
        raise ValueError(f"no file class of category {category}")
    return [
        (F.struct(F.lit(c).alias("category"), F.lit(p).alias("pattern"),
                  F.lit(o).alias("optional"), F.lit(f).alias("format"),
                  F.lit(t).alias("content_type")), F.col("name").rlike(glob_regex(p)))
        for c, p, o, f, t in rows]


def classify_files(listing: DataFrame, category: str | None = None) -> DataFrame:
    """Listing rows with the classes their name matches.

    The classes are a literal array tested inside each row, so no join is needed.
    """
    matching = F.array_compact(F.array(*[F.when(hit, kind) for kind, hit in _classes(category)]))
    return listing.select("*", F.inline(matching))


def expected_files(listing: DataFrame, category: str = "pseudobulk",
                   folders: DataFrame | None = None) -> DataFrame:
    """Every (folder, class) with its state: found, absent (optional) or missing.

    ``folders`` (folder) lists folders that should exist, so one without any file is
    reported too.
    """
    classes = _classes(category)
    rows = listing.select("folder", "name")
    if folders is not None:
        rows = rows.unionByName(folders.select("folder", F.lit(None).cast("string").alias("name")))
    found = rows.groupBy("folder").agg(*[
        F.min(F.when(hit, F.col("name"))).alias(f"_n{i}") for i, (_, hit) in enumerate(classes)])
    states = found.select("folder", F.inline(F.array(*[
        F.struct(kind["pattern"].alias("pattern"), kind["optional"].alias("optional"),
                 kind["content_type"].alias("content_type"), F.col(f"_n{i}").alias("name"))
        for i, (kind, _) in enumerate(classes)])))
    return states.select(
        "folder", "pattern", "content_type", "name",
        F.when(F.col("name").isNotNull(), "found")
        .when(F.col("optional"), "absent").otherwise("missing").alias("state"))


def id_reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids of both sides with 'both', 'left_only' or 'right_only'."""
    a = left.select(key).distinct().withColumn("_l", F.lit(True))
    b = right.select(key).distinct().withColumn("_r", F.lit(True))
    return a.join(b, key, "full").select(
        key, F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), "both")
        .when(F.col("_l").isNotNull(), "left_only").otherwise("right_only").alias("status"))


def parse_json(lines: DataFrame, schema) -> DataFrame:
    return lines.select(F.from_json("value", schema).alias("_r")).select("_r.*")


def lineage(records: DataFrame) -> DataFrame:
    """Principal accession of every accession: its parents', or itself without any.

    Parents are followed one step; a parent without a record keeps its own id.
    """
    parents = records.select("accession", F.explode_outer("input_for").alias("_parent"))
    known = records.select(F.col("accession").alias("_parent"),
                           F.col("accession").alias("_principal"))
    return parents.join(known, "_parent", "left").select(
        "accession",
        F.coalesce("_principal", "_parent", "accession").alias("principal_accession")).distinct()


def route_files(records: DataFrame) -> DataFrame:
    """Every listed file with the kind of input it serves."""
    kind = F.col("_file.content_type")
    return records.select(
        "accession", F.explode("files").alias("_file")).select(
        "accession", F.col("_file.accession").alias("file_accession"),
        kind.alias("content_type"),
        F.when(kind.isin(*MATRIX_TYPES), "matrix").when(kind.isin(*FRAGMENT_TYPES), "fragments")
        .otherwise("unused").alias("route"))


def derived_from(records: DataFrame, content_type: str,
                 intermediate: str = "intermediate analysis") -> DataFrame:
    """Aliases of the file of one content type per file set.

    A set without such a file takes those of the intermediate sets it was made
    from. One row per alias.
    """
    own_file = F.filter("files", lambda f: f["content_type"] == content_type)
    own = records.select(
        "accession", "input_file_sets", F.get(own_file, F.lit(0))["aliases"].alias("_aliases"))
    direct = own.where(F.col("_aliases").isNotNull()).select(
        "accession", F.explode("_aliases").alias("alias"), F.lit("direct").alias("via"))
    sources = own.where(F.col("_aliases").isNull()).select(
        "accession", F.explode(F.filter(
            "input_file_sets", lambda s: s["file_set_type"] == intermediate)).alias("_s")
    ).select("accession", F.col("_s.accession").alias("_source"))
    inherited = sources.join(
        own.where(F.col("_aliases").isNotNull()).select(
            F.col("accession").alias("_source"), "_aliases"), "_source"
    ).select("accession", F.explode("_aliases").alias("alias"), F.lit("intermediate").alias("via"))
    return direct.unionByName(inherited)


def controlled_access(records: DataFrame, members: DataFrame) -> DataFrame:
    """Whether any file set of a group is under controlled access."""
    return members.join(records.select("accession", "controlled_access"), "accession").groupBy(
        "principal_accession").agg(F.bool_or("controlled_access").alias("controlled_access"))


def joined_aliases(aliases: DataFrame, by: str) -> DataFrame:
    """Distinct aliases of a file set in one sorted, comma-separated text."""
    return aliases.groupBy(by).agg(
        F.array_join(F.array_sort(F.collect_set("alias")), ",").alias("aliases"))


def nested_lookup(steps: DataFrame, software: str) -> DataFrame:
    """First version of each step that lists the software, or a violation without one."""
    match = F.get(F.filter(
        "analysis_step_versions",
        lambda v: F.exists(v["software_versions"], lambda s: s["name"] == software)), F.lit(0))
    return steps.select("step", match.alias("_v")).select(
        "step", F.col("_v.version_id").alias("version_id"),
        F.array_join("_v.aliases", ",").alias("aliases"),
        F.col("_v").isNull().alias("violation"))
