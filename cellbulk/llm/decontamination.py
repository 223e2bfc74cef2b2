"""Benchmark phrases in a training corpus, by a distributed positional index.

Windows of consecutive item words are looked up from their rarest terms: the corpus
frequency of every test term is counted, the postings (document, term, position) of the
terms that are rarest in some window are stored, and the lists of a window's two rarest
terms are intersected after moving each by its offset in the window. Where both agree on
a start, the document's words decide.

A proximity match has a share of a window's distinct terms in the stretch around a start.
It may lack so many of them; of two more than that, the rarest of the window, two must
agree on a start up to a slop. Terms that the corpus lacks count among the rarest.

Everything is DataFrame code in the JVM. A document is known by its id and a hash of its
text; repeated rows share their matches and each keeps its own result row.

Defined results: null and empty texts have no words and no hits; items without words
are never found; a null document id is a document like any other, a null item id is
ignored. Extra columns are ignored.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellbulk.llm.common import lower_ascii, packed, text_of, unpacked
from cellbulk.session import saved

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SLOP, SHARE = 10, 5, 0.8
DOC = ["doc", "tag"]


def words_of(text: Column) -> Column:
    """Runs of digits, a-z (A-Z lower-cased) and characters outside ASCII."""
    return F.array_remove(F.split(lower_ascii(text), NOT_WORD), "")


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, tag, text): a null id becomes the smallest long, the tag tells texts apart."""
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("doc"),
                       F.xxhash64(text_of(text)).alias("tag"), text_of(text).alias("text"))


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(wid, words, items): distinct windows and the ids of the items that hold them."""
    worded = items.where(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("item"), words_of(text_of(text)).alias("all"))
    cut = F.when(F.size("all") > size, F.transform(
        F.sequence(F.lit(1), F.size("all") - (size - 1)), lambda i: F.slice("all", i, size),
    )).otherwise(F.array("all"))
    windows = worded.where(F.size("all") > 0).select("item", F.explode(cut).alias("words"))
    grouped = windows.groupBy("words").agg(F.collect_set("item").alias("items"))
    return saved(grouped.withColumn("wid", F.monotonically_increasing_id()), "windows")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): occurrences in all of ``docs`` (doc, tag, text) of the ``terms`` given."""
    spread = docs.select(F.explode(words_of(F.col("text"))).alias("term"))
    return spread.join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def with_anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds the two rarest terms and their offsets; windows with a term that the corpus
    lacks cannot occur and are left out."""
    spread = windows.select("wid", F.posexplode("words").alias("off", "term"))
    ranked = spread.join(counts, "term").groupBy("wid").agg(
        F.array_sort(F.collect_list(F.struct("n", "off", "term"))).alias("ranked"))
    whole = windows.join(ranked, "wid").where(F.size("ranked") == F.size("words"))
    second = F.coalesce(F.get("ranked", F.lit(1)), F.col("ranked")[0])
    return whole.select(
        "wid", "words", "items",
        F.col("ranked")[0]["term"].alias("term1"), F.col("ranked")[0]["off"].alias("off1"),
        second["term"].alias("term2"), second["off"].alias("off2"),
        F.array(F.col("ranked")[0], second).alias("anchors"))


def proximity_anchors(windows: DataFrame, counts: DataFrame, share: float = SHARE) -> DataFrame:
    """Adds the anchors of proximity matches, (n, off, term): of the rarest distinct terms two
    more than a match may lack, at all their offsets; one of a window with a single term."""
    spread = windows.select("wid", F.posexplode("words").alias("off", "term")).join(counts, "term", "left")
    ranked = spread.groupBy("wid", "term").agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.array_sort(F.collect_set("off")).alias("offs")).groupBy("wid").agg(
        F.array_sort(F.collect_list(F.struct("n", "term", "offs"))).alias("ranked"))
    lacking = F.size("ranked") - F.ceil(F.size("ranked") * F.lit(share) - 1e-9).cast("int")
    chosen = F.filter(F.slice("ranked", F.lit(1), lacking + 2), lambda r: r["n"] > 0)
    anchors = F.flatten(F.transform(chosen, lambda r: F.transform(
        F.when(F.size("ranked") > 1, r["offs"]).otherwise(F.slice(r["offs"], 1, 1)),
        lambda off: F.struct(r["n"].alias("n"), off.alias("off"), r["term"].alias("term")))))
    return windows.join(ranked, "wid").select("wid", "words", "items", anchors.alias("anchors"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index: (doc, tag, pos, term) of ``terms``, and one row per document with
    the empty term, whose position is the number of words."""
    spread = docs.select(*DOC, F.posexplode(
        F.array_append(words_of(F.col("text")), F.lit(""))).alias("pos", "term"))
    marked = terms.unionByName(terms.sparkSession.sql("SELECT '' AS term")).distinct()
    return saved(spread.join(saved(marked, "terms"), "term", "left_semi"), "postings")


def aligned_starts(index: DataFrame, anchored: DataFrame) -> DataFrame:
    """Starts at which both rarest terms stand where the window has them."""
    anchor = anchored.select("wid", F.col("term1").alias("term"), "off1", "off2", "term2")
    first = index.where("term != ''").join(anchor, "term").select(
        *DOC, "wid", (F.col("pos") - F.col("off1")).alias("start"), F.col("term2").alias("term"),
        (F.col("pos") - F.col("off1") + F.col("off2")).alias("pos")).where("start >= 0")
    return first.join(index, [*DOC, "term", "pos"], "left_semi").select(*DOC, "wid", "start").distinct()


def per_document(candidates: DataFrame, docs: DataFrame, anchored: DataFrame) -> DataFrame:
    """(doc, tag, all, found): words of each document with candidates, once per document,
    and its candidates with the words that they stand for."""
    listed = candidates.join(anchored.select("wid", "words", "items"), "wid").groupBy(*DOC).agg(
        F.collect_list(F.struct("start", "wid", "words", "items")).alias("found"))
    return docs.join(listed, DOC).withColumn("text", words_of(F.col("text"))).withColumnRenamed(
        "text", "all").dropDuplicates(DOC)


def exact_matches(index: DataFrame, docs: DataFrame, anchored: DataFrame) -> DataFrame:
    """(doc, tag, hits): the exact occurrences in each document as (start, wid, words, items)."""
    placed = per_document(aligned_starts(index, anchored), docs, anchored)
    same = F.filter("found", lambda c: F.slice("all", c["start"] + 1, F.size(c["words"])) == c["words"])
    return placed.select(*DOC, same.alias("hits")).where(F.size("hits") > 0)


def proximity_matches(index: DataFrame, docs: DataFrame, anchored: DataFrame, slop: int = SLOP,
                      share: float = SHARE) -> DataFrame:
    """(doc, tag, hits): windows two of whose anchors stand within ``slop`` of their
    distance, and of whose terms ``share`` stand in the stretch around."""
    # a term is known by its first place in the window; -1 in a window of a single term
    anchor = anchored.select("wid", "words", F.explode(F.array_distinct("anchors")).alias("a")).select(
        "wid", F.when(F.size(F.array_distinct("words")) == 1, -1).otherwise(
            F.array_position("words", F.col("a.term"))).cast("int").alias("which"),
        F.col("a.term").alias("term"), F.col("a.off").alias("off"))
    starts = index.where("term != ''").join(anchor, "term").select(
        *DOC, "wid", "which", (F.col("pos") - F.col("off")).alias("start"))
    around = Window.partitionBy(*DOC, "wid").orderBy("start").rangeBetween(-slop, slop)
    near = starts.withColumns({"least": F.min("which").over(around), "most": F.max("which").over(around)}).where(
        "which < 0 or least < most").select(*DOC, "wid", "start").distinct()
    placed = per_document(near, docs, anchored)

    def close(c: Column) -> Column:
        low = F.greatest(c["start"] + 1 - slop, F.lit(1))
        stop = c["start"] + F.size(c["words"]) + slop
        around = F.slice("all", low, F.greatest(F.lit(0), stop - low + 1))
        terms = F.array_distinct(c["words"])
        return F.size(F.array_intersect(terms, around)) >= share * F.size(terms) - 1e-9

    return placed.select(*DOC, F.filter("found", close).alias("hits")).where(F.size("hits") > 0)


def near_contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                       item_key: str = "item_id", item_text: str = "text", size: int = WINDOW,
                       slop: int = SLOP, share: float = SHARE) -> DataFrame:
    """(key, n_proximity, tag) per row of ``docs``: distinct items with a proximity match."""
    texts = keyed(docs, key, text)
    windows = item_windows(items, item_key, item_text, size)
    vocabulary = saved(windows.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    anchored = saved(proximity_anchors(windows, saved(term_counts(texts, vocabulary), "term-counts"), share), "near-anchors")
    index = postings(texts, anchored.select(F.explode("anchors.term").alias("term")))
    hits = proximity_matches(index, texts, anchored, slop, share)
    told = hits.select(*DOC, F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))).alias("found"))
    return index.where("term = ''").join(told, DOC, "left").select(
        F.when(F.col("doc") != -(1 << 63), F.col("doc")).alias(key),
        F.coalesce("found", F.lit(0)).cast("long").alias("n_proximity"), "tag")


def covered(spans: Column) -> Column:
    """Positions inside any of the (start, stop) spans, which are sorted by start."""
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(spans, begin, lambda got, s: F.struct(
        (got["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], got["upto"]))).alias("n"),
        F.greatest(got["upto"], s["stop"]).alias("upto")), lambda got: got["n"])


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated, tag) per row of ``docs``."""
    texts = keyed(docs, key, text)
    windows = item_windows(items, item_key, item_text, size)
    vocabulary = saved(windows.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    counts = saved(term_counts(texts, vocabulary), "term-counts")
    anchored = saved(with_anchors(windows, counts), "anchors")
    terms = anchored.select(F.col("term1").alias("term")).union(anchored.select("term2")).distinct()
    index = postings(texts, terms)
    hits = exact_matches(index, texts, anchored)
    spans = F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.struct(
        h["start"].alias("start"), (h["start"] + F.size(h["words"])).alias("stop")))))
    found = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    told = hits.select(*DOC, covered(spans).alias("n_hit"), found.alias("found"))
    judged = index.where("term = ''").join(told, DOC, "left")
    none = F.array().cast("array<string>")
    return judged.select(
        F.when(F.col("doc") != -(1 << 63), F.col("doc")).alias(key), F.col("pos").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("found", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("found", none), ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "tag")


def clean_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` that hold no benchmark window."""
    dirty = contamination(docs, items, key, text).where("contaminated").select(
        F.col(key).alias("dirty_doc"), F.col("tag").alias("dirty_tag")).distinct()
    own = packed(docs, doc=F.col(key), tag=F.xxhash64(text_of(text)))
    kept = own.join(dirty, F.col("doc").eqNullSafe(F.col("dirty_doc")) & (F.col("tag") == F.col("dirty_tag")), "left_anti")
    return unpacked(kept, docs.columns)
