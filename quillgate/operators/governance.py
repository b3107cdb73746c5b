"""Dataset governance: rights, routing, effective volume, splits by lineage, leakage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgate.tables import checkpointed

# Rights that allow acceptance.
CLEARED = ("owned", "licensed", "permitted")


def routed(samples: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """samples with route: what status asks for, but accepted only with cleared rights, of the sample and of an accepted
    source with cleared rights; else quarantine. A missing source is none."""
    ok = F.coalesce(F.col("rights_status").isin(*CLEARED), F.lit(False))
    if sources is not None:
        s = sources.where(F.col("rights_status").isin(*CLEARED) & (F.col("status") == "accepted")).select("source_id", F.lit(True).alias("_source_ok")).distinct()
        samples = samples.join(s, "source_id", "left")
        ok = ok & F.coalesce("_source_ok", F.lit(False))
    out = samples.withColumn("route", F.when(F.col("status") == "rejected", "rejected").when((F.col("status") == "accepted") & ok, "accepted").otherwise("quarantine"))
    return out.drop("_source_ok")


def effective_volume(samples: DataFrame, by: list[str], amount: str, weights: list[Column]) -> DataFrame:
    """by, total, effective: amounts times the product of weights in [0, 1]; an unknown weight is 0. Speech and singing are told
    apart by having source_type in `by`."""
    w = F.lit(1.0)
    for x in weights:
        w = w * F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(x.cast("double"), F.lit(0.0))))
    return samples.groupBy(*by).agg(F.sum(amount).alias("total"), F.sum(F.col(amount) * w).alias("effective"))


def bucket(key: Column | str, digits: int = 4, parts: int = 100) -> Column:
    """A bucket in [0, parts) from the first hex digits of a SHA-256, the same in any engine."""
    c = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.sha2(c.cast("string"), 256), 1, digits), 16, 10).cast("long") % parts


def split(rows: DataFrame, root: Column | str, train_share: int = 80) -> DataFrame:
    """rows with split: train or test by the lineage root, never by the row."""
    return rows.withColumn("split", F.when(bucket(root) < train_share, "train").otherwise("test"))


def lineage_roots(derived: DataFrame) -> DataFrame:
    """id, root: the least id of each lineage (a component of child-parent edges). Labels spread by joins; each round is
    checkpointed."""
    e = derived.where("child is not null and parent is not null").select(F.col("child").alias("a"), F.col("parent").alias("b"))
    e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    e = checkpointed(e)
    label = e.select(F.col("a").alias("id")).distinct().withColumn("root", F.col("id"))
    while True:
        near = e.join(label.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("m"))
        new = label.join(near, "id").select("id", F.least("root", "m").alias("root"), (F.col("m") < F.col("root")).alias("moved"))
        # the root's own root, so that long chains halve
        up = new.select(F.col("id").alias("root"), F.col("root").alias("up"))
        new = new.join(up, "root").select("id", F.col("up").alias("root"), (F.col("moved") | (F.col("up") < F.col("root"))).alias("moved"))
        new = checkpointed(new)
        if new.where("moved").isEmpty():
            return new.select("id", "root")
        label = new.select("id", "root")


def leaks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys (sources, hashes, roots) that stand in more than one split."""
    return rows.groupBy(*keys).agg(F.countDistinct("split").alias("splits")).where("splits > 1")


def untraced(transforms: DataFrame) -> DataFrame:
    """Transforms without parent hash, tool or version."""
    lack = lambda c: F.coalesce(F.trim(F.col(c)) == "", F.lit(True))
    return transforms.where(lack("parent_hash") | lack("tool") | lack("version"))


def disputed(a: DataFrame, b: DataFrame, key: str, most: float) -> DataFrame:
    """Transcripts (key, text) of two engines that differ by more than that rate, or that only one has: for review."""
    both = a.select(key, F.col("text").alias("text_a")).join(b.select(key, F.col("text").alias("text_b")), key, "full_outer")
    r = F.levenshtein("text_a", "text_b") / F.greatest(F.char_length("text_a"), F.char_length("text_b"), F.lit(1))
    return both.withColumn("difference", r).where(F.coalesce(F.col("difference") > most, F.lit(True)))


def push_payload(results: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """The allowed columns alone."""
    return results.select(*allowed)
