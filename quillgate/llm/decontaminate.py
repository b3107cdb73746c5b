r"""Benchmark decontamination with a distributed positional inverted index, in DataFrame operations alone.

The corpus is scanned once to count the test set's terms and once to write the index: for every term that is one of the
two rarest of some test window, a posting list (document, sorted positions) for each document, clustered by term; terms
with more than a partition's share of all postings are salted over several partitions. A window's two lists, shifted by the terms' offsets, are intersected
within each document (equal shifted positions, or up to `slop` apart for proximity); what is left is compared with the
document's own words. The test set's tables are broadcast only if their measured bytes are under `BROADCAST_BYTES`;
beyond that the same joins shuffle. Text is read where it lies: only documents with candidates are read a third time.

Defined cases: null text has no words; an item of no words has no window; an item of fewer than `width` words is one
window; repeated items count once by id, items with a null id are hits but name no item; rows are told apart by doc_id and
text, so repeated rows all return; a null doc_id is kept; an empty corpus gives no rows and an empty benchmark no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgate.llm.common import ascii_lower, fresh, partitions, scratch, stored

#: Separators: the ASCII characters that are neither digits nor letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 10
BROADCAST_BYTES = 16 << 20
#: Postings of one term in one partition at least, where its share of all is larger than a partition's; ids that may be broadcast.
SALT_ROWS, BROADCAST_IDS = 256, 1 << 20


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")


def words(text: Column) -> Column:
    """Words with A-Z lower-cased; a text of ASCII alone takes the fast way to the same."""
    return raw_words(F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(ascii_lower(text)))


def windows_of(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """item_id, phrase (the window's words, space-joined), terms."""
    own = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    w = own.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, width))).alias("terms"))
    return w.select("item_id", F.array_join("terms", " ").alias("phrase"), "terms")


def _small(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if its bytes are measured to be under the bound."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), text."""
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n: how often each test term (one column, distinct) stands in the corpus."""
    own = docs.select(F.explode(words(F.col("text"))).alias("term"))
    return own.join(_small(terms), "term").groupBy("term").agg(F.count("*").alias("n"))


def rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """phrase, len, t1, o1, n1, t2, o2, n2: each window's two rarest terms and their offsets. A window with a term that the
    corpus lacks can't occur and is left out."""
    each = windows.select("phrase", F.size("terms").alias("len"), F.posexplode("terms").alias("o", "term")).distinct()
    own = each.join(counts, "term").groupBy("phrase", "len").agg(F.array_sort(F.collect_list(F.struct("n", "o", "term"))).alias("t")).where("size(t) = len")
    two = F.when(F.size("t") > 1, F.col("t")[1]).otherwise(F.col("t")[0])
    return own.select("phrase", "len", *[x for k, t in ((1, F.col("t")[0]), (2, two)) for x in (t["term"].alias(f"t{k}"), t["o"].alias(f"o{k}"), t["n"].alias(f"n{k}"))])


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, salt, doc_id, h, positions of the given terms (term, n), clustered by term."""
    total = terms.agg(F.sum("n")).first()[0] or 0
    most = max(SALT_ROWS, total // (2 * partitions(docs.sparkSession)))
    salts = _small(terms.select("term", F.ceil(F.col("n") / most).cast("int").alias("salts")))
    postings = keyed(docs).select("doc_id", "h", F.posexplode(words(F.col("text"))).alias("pos", "term")).join(salts, "term")
    postings = postings.select("term", F.pmod(F.xxhash64("doc_id", "h"), "salts").alias("salt"), "doc_id", "h", "pos")
    lists = postings.repartition("term", "salt").groupBy("term", "salt", "doc_id", "h").agg(F.array_sort(F.collect_list("pos")).alias("positions"))
    return stored(lists.sortWithinPartitions("term", "salt"), "postings")


def intersect(index: DataFrame, anchors: DataFrame, slop: int = 0) -> DataFrame:
    """phrase, len, doc_id, h, starts: where the two rarest terms of a window stand at their offsets, up to slop apart."""
    a = index.join(_small(anchors.select("phrase", "len", F.col("t1").alias("term"), "o1", "t2", "o2")), "term")
    a = a.select("phrase", "len", "doc_id", "h", "t2", "o2", F.transform("positions", lambda p: p - F.col("o1")).alias("p1"))
    b = index.select(F.col("term").alias("t2"), F.col("doc_id").alias("d2"), F.col("h").alias("h2"), F.col("positions").alias("p2"))
    both = a.join(b, (a.t2 == b.t2) & a.doc_id.eqNullSafe(b.d2) & (a.h == b.h2)).drop(b.t2)
    p2 = F.transform("p2", lambda p: p - F.col("o2"))
    near = F.array_intersect("p1", p2) if not slop else F.filter("p1", lambda p: F.exists(p2, lambda q: F.abs(p - q) <= slop))
    return both.select("phrase", "len", "doc_id", "h", F.filter(near, lambda s: s >= 0).alias("starts")).where("size(starts) > 0")


def phrase_matches(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """doc_id, h, hits: array of (start, len, phrase) that the document's words confirm."""
    own = candidates.groupBy("doc_id", "h").agg(F.collect_list(F.struct("phrase", "len", "starts")).alias("c"))
    own = stored(own.select(F.col("doc_id").alias("d2"), F.col("h").alias("h2"), "c"), "candidates")
    k = keyed(docs)
    if own.count() <= BROADCAST_IDS:  # so the texts of other documents aren't shuffled
        ids = own.select("d2", "h2")
        k = k.join(F.broadcast(ids), k.doc_id.eqNullSafe(ids.d2) & (k.h == ids.h2), "left_semi")
    both = k.join(own, k.doc_id.eqNullSafe(own.d2) & (k.h == own.h2)).drop("d2", "h2")
    both = both.repartition(partitions(docs.sparkSession), "doc_id", "h").dropDuplicates(["doc_id", "h"])  # few bytes, much work: not to be coalesced
    w = F.col("w")
    fits = lambda c: F.transform(F.filter(c["starts"], lambda s: F.array_join(F.slice(w, s + 1, c["len"]), " ") == c["phrase"]), lambda s: F.struct(s.alias("start"), c["len"].alias("len"), c["phrase"].alias("phrase")))
    hits = both.select("doc_id", "h", words(F.col("text")).alias("w"), "c").select("doc_id", "h", F.array_sort(F.flatten(F.transform("c", fits))).alias("hits"))
    return hits.where("size(hits) > 0")


def covered(hits: Column) -> Column:
    """Positions under sorted (start, len) spans, each counted once."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    end = lambda x: x["start"] + x["len"]
    step = lambda acc, x: F.struct(F.greatest(acc["end"], end(x)).alias("end"), (acc["n"] + F.greatest(end(x) - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("n"))
    return F.aggregate(hits, zero, step, lambda acc: acc["n"])


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """d2, h2 (doc_id and hash of the text), n_hit, items (sorted ids as strings) of the texts that hold a window."""
    with scratch(docs.sparkSession):
        windows = stored(windows_of(benchmark, width), "windows")
        terms = windows.select(F.explode("terms").alias("term")).distinct()
        counts = stored(term_counts(docs, terms), "terms")
        anchors = stored(rarest(windows, counts), "anchors")
        used = anchors.select(F.col("t1").alias("term"), F.col("n1").alias("n")).unionByName(anchors.select(F.col("t2").alias("term"), F.col("n2").alias("n"))).distinct()
        found = stored(phrase_matches(docs, intersect(build_index(docs, used), anchors)), "matches")
        ids = windows.where("item_id is not null").select("phrase", F.col("item_id").cast("string").alias("item")).distinct()
        phrases = found.select("doc_id", "h", F.explode(F.array_distinct(F.transform("hits", lambda x: x["phrase"]))).alias("phrase"))
        items = phrases.join(_small(ids), "phrase").groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("item")).alias("items"))
        hit = found.select("doc_id", "h", covered(F.col("hits")).alias("n_hit"), F.array().cast("array<string>").alias("items"))
        hit = hit.unionByName(items.withColumn("n_hit", F.lit(0).cast("long"))).groupBy("doc_id", "h").agg(F.max("n_hit").alias("n_hit"), F.max("items").alias("items"))
        hit = stored(hit.select(F.col("doc_id").alias("d2"), F.col("h").alias("h2"), "n_hit", "items"), "hits", keep=True)
    return hit


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, h, n_words, n_hit, items (sorted ids as strings) of every row of docs."""
    hit = contaminated(docs, benchmark, width)
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.size(raw_words(F.col("text"))).cast("long").alias("n_words"))
    out = rows.join(hit, rows.doc_id.eqNullSafe(hit.d2) & (rows.h == hit.h2), "left")
    return out.select("doc_id", "h", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of docs without a hit, all columns."""
    d, h = fresh(docs, "hit_doc"), fresh(docs, "hit_text")
    hit = contaminated(docs, benchmark, width).select(F.col("d2").alias(d), F.col("h2").alias(h))
    if hit.count() <= BROADCAST_IDS:
        hit = F.broadcast(hit)
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(h)), "left_anti")
