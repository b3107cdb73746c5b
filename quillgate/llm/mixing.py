r"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations alone.

One scan describes each document: source, language, tokens and the shares of its characters that are digits, marks, capitals and line
breaks, with the mean length of its words. Topics are clusters of these figures, fitted to the corpus by k-means over all documents
(`TOPICS` centres, numbers of which alone reach the driver); so topics tell prose from tables, code, lists or keys, whatever the language.
Documents are counted into cells (source, language, topic) with their tokens; a task sums before anything is shuffled, so a hot
source costs one row a task. Raking multiplies the cells' factors, one margin after the other, until every margin of the
weighted tokens has its target share; the cell table is checkpointed each round. A cell's documents are then drawn with
a probability, `keep` times its factor where no cell needs more than it has. Else full cells stay at 1 and the others are
raked again, until the margins of the expected tokens hold; `keep` shrinks where no draw of its size has them. A document is drawn
by a hash of its id, so a rerun or a lost executor draws the same. Targets that no factors can meet (cells that are all empty stand in
the way) end after `ROUNDS` rounds: the column off says how far, in shares, a margin is from its target, and is below `TOLERANCE`
everywhere else.

Where no targets are given, a margin's target is its own share to the power `alpha`, normalised: below 1, small sources and
languages gain.

Defined cases: null or absent source, language and text count as ``(none)``; a document without words has no tokens, but its
cell's probability; targets without tokens in the data are left out and the others' shares are normalised; values that
a given margin doesn't name get no weight; rows that share a doc_id share their fate within a cell; an empty table gives no rows;
columns of any name are kept, as the operator's own are in one struct whose name the input doesn't have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgate.llm.common import checkpointed, fresh, stored

DIMS = ("source", "lang", "topic")
NONE = "(none)"
ALPHA, KEEP, SEED = 0.7, 0.5, 20
TOLERANCE, ROUNDS = 1e-6, 60
BOUND_TOLERANCE, BOUND_ROUNDS = 5e-4, 24
TOPICS, TOPIC_ROUNDS = 4, 8
#: Cells that may be broadcast, or be raked in one task: about 200 bytes each.
BROADCAST_CELLS = 100_000
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FIGURES = 5


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def described(docs: DataFrame, text_col: str = "text") -> Column:
    """source, lang, tokens and figures (null with the text) of each document, as a struct."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE)) if c in docs.columns else F.lit(NONE)
    text, n = F.col(text_col), F.greatest(F.char_length(text_col), F.lit(1))
    share = lambda letters: 1 - F.char_length(F.translate(text, letters, "")) / n
    word = F.least(F.lit(3.0), F.log10(n / F.greatest(n_tokens(text), F.lit(1))))
    figures = F.array(share("0123456789"), share(MARKS), share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("\r\n"), word)
    return F.struct(own("source").alias("source"), own("lang").alias("lang"), n_tokens(text).alias("tokens"), F.when(text.isNotNull(), figures).alias("figures"))


def _numbers(values: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def nearest(figures: Column, centres: list[list[float]]) -> Column:
    """The number of the nearest centre, of equals the first."""
    far = lambda c, i: F.struct(_sum(F.zip_with(figures, c, lambda x, y: (x - y) * (x - y))).alias("far"), i.alias("i"))
    return F.array_min(F.transform(F.array(*map(_numbers, centres)), far))["i"]


def fitted(figures: DataFrame, k: int = TOPICS, rounds: int = TOPIC_ROUNDS) -> Column:
    """The topic of a document, over a column figures, by k-means over the rows of a table of them.

    Figures are made comparable first (over the corpus mean 0 and deviation 1, at most 4 off). The start is the means of k ranges of
    their sum, so nothing is drawn at random; numbers of centres alone reach the driver."""
    col = F.col("figures")
    m = figures.agg(*[f(col[i]).alias(f"{n}{i}") for i in range(FIGURES) for n, f in (("mean", F.avg), ("dev", F.stddev_pop))]).first()
    means, devs = (_numbers([m[f"{n}{i}"] or 0.0 for i in range(FIGURES)]) for n in ("mean", "dev"))
    scale = lambda x, i: F.when(devs[i] > 0, F.greatest(F.lit(-4.0), F.least(F.lit(4.0), (x - means[i]) / devs[i]))).otherwise(0.0)
    scaled = F.transform(col, scale)
    own = figures.where(col.isNotNull()).select(scaled.alias("z"))
    cuts = own.select(F.percentile_approx(_sum(F.col("z")), [i / k for i in range(1, k)], 10_000)).first()[0] or []
    group, centres = F.size(F.filter(_numbers(cuts), lambda x: _sum(F.col("z")) > x)) if cuts else F.lit(0), []
    for _ in range(rounds):
        rows = own.groupBy(group.alias("g")).agg(*[F.avg(F.col("z")[i]).alias(f"c{i}") for i in range(FIGURES)]).orderBy("g").collect()  # k rows
        new = [[float(r[f"c{i}"]) for i in range(FIGURES)] for r in rows]
        still = len(new) == len(centres) and all(abs(x - y) < 1e-3 for p, q in zip(new, centres, strict=True) for x, y in zip(p, q, strict=True))
        if still or not new:
            break
        centres = new
        group = nearest(F.col("z"), centres)
    return F.when(col.isNull(), NONE).otherwise(F.concat(F.lit("topic"), nearest(scaled, centres).cast("string"))) if centres else F.lit(NONE)


def with_cells(docs: DataFrame, columns: list[str], name: str) -> DataFrame:
    """columns of docs, and a struct of that name: source, lang, topic, tokens. Texts are read once; the rest reads what is stored."""
    held = stored(docs.select(*[F.col(f"`{c}`") for c in columns], described(docs).alias(name)), "mixing")
    topic = fitted(held.select(F.col(f"{name}.figures").alias("figures")))
    own = [F.col(f"{name}.{x}").alias(x) for x in ("source", "lang", "tokens", "figures")]
    keep = fresh(held, "kept")
    x = held.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias(keep), *own).withColumn("topic", topic)
    cell = F.struct("source", "lang", "topic", "tokens").alias(name)
    return x.select(cell, keep).select(*[F.col(f"{keep}.`{c}`").alias(c) for c in columns], name)


def cells_of(rows: DataFrame, name: str) -> DataFrame:
    """source, lang, topic, docs, tokens of rows of with_cells()."""
    d = rows.groupBy(*[F.col(f"{name}.{x}").alias(x) for x in DIMS])
    return d.agg(F.count("*").alias("docs"), F.sum(f"{name}.tokens").cast("double").alias("tokens"))


def _with_targets(cells: DataFrame, targets: dict[str, DataFrame], alpha: float) -> DataFrame:
    """cells with target_<dim>, shares of one in all."""
    for d in DIMS:
        if d in targets:
            t = targets[d].select(F.col(d), F.col("share").cast("double").alias(f"target_{d}"))
            t = t.join(cells.groupBy(d).agg(F.sum("tokens").alias("_t")), d).where("_t > 0").drop("_t")
        else:
            t = cells.groupBy(d).agg(F.pow(F.sum("tokens"), F.lit(alpha)).alias(f"target_{d}")).where(f"target_{d} > 0")
        total = t.agg(F.sum(f"target_{d}")).first()[0] or 1.0
        cells = cells.join(t.withColumn(f"target_{d}", F.col(f"target_{d}") / total), d, "left").fillna(0.0, [f"target_{d}"])
    return cells


def _over(cells: DataFrame, d: str, small: bool, **sums: Column) -> DataFrame:
    """cells with sums over all cells of the same value of d: by a window where all cells are one bounded task, else by an
    aggregate that is joined, so that no value's cells have to meet."""
    if small:
        return cells.withColumns({k: F.sum(c).over(W.partitionBy(d)) for k, c in sums.items()})
    return cells.join(cells.groupBy(d).agg(*[F.sum(c).alias(k) for k, c in sums.items()]), d)


def _gathered(cells: DataFrame) -> tuple[DataFrame, bool]:
    """cells checkpointed, in one partition if they are few, and whether they are."""
    cells = checkpointed(cells)
    small = cells.count() <= BROADCAST_CELLS
    return (checkpointed(cells.coalesce(1)) if small else cells), small


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, alpha: float = ALPHA) -> DataFrame:
    """cells with factor: tokens x factor has the target margins; the factors' token-weighted mean is 1. off: how far, in shares, the
    margins are from their targets when the rounds end."""
    cells, small = _gathered(_with_targets(checkpointed(cells), targets or {}, alpha).withColumn("factor", F.lit(1.0)))
    total, worst = cells.agg(F.sum("tokens")).first()[0] or 0.0, 0.0
    for n in range(ROUNDS if total else 0):
        for d in DIMS:
            cells = _over(cells, d, small, margin=F.col("tokens") * F.col("factor"))
            cells = cells.withColumn("factor", F.when(F.col("margin") > 0, F.col("factor") * F.col(f"target_{d}") * total / F.col("margin")).otherwise(F.col("factor"))).drop("margin")
        cells = checkpointed(cells)
        off = [cells.groupBy(d).agg(F.abs(F.sum(F.col("tokens") * F.col("factor")) / total - F.max(f"target_{d}")).alias("off")).select("off") for d in DIMS]
        worst = reduce(DataFrame.unionByName, off).agg(F.max("off")).first()[0] or 0.0
        if worst < TOLERANCE:
            break
    return cells.withColumn("off", F.lit(worst))


def _bounded(cells: DataFrame, total: float, keep: float, small: bool) -> tuple[DataFrame, float]:
    """cells with prob at most 1, and how far (in shares) a margin of tokens x prob is from its target.

    prob = min(1, a product of one multiplier for each margin's value). A margin's turn multiplies by what the cells that aren't
    full must carry beyond the full ones; a value whose cells are all full stays, one whose full cells are too much shrinks."""
    cells, full, off = cells.withColumn("g", F.col("factor") * keep), F.col("g") >= 1, 1.0
    for n in range(1, BOUND_ROUNDS + 1):
        for d in DIMS:
            t, want = F.col("tokens"), F.col(f"target_{d}") * keep * total
            cells = _over(cells, d, small, whole=F.when(full, t).otherwise(0.0), rest=F.when(full, 0.0).otherwise(t * F.col("g")), got=t * F.least(F.lit(1.0), "g"))
            turn = F.when(F.col("whole") < want, F.coalesce(F.try_divide(want - F.col("whole"), "rest"), F.lit(1.0))).otherwise(F.coalesce(F.try_divide(want, "got"), F.lit(1.0)))
            cells = cells.withColumn("turn", turn).withColumn("g", F.col("g") * F.col("turn")).drop("turn", "whole", "rest", "got")
        if n % 2 == 0:
            cells = checkpointed(cells)
        if n % 4 == 0:
            off = margins(cells.withColumn("prob", F.least(F.lit(1.0), "g"))).agg(F.max(F.abs(F.col("share") - F.col("target")))).first()[0] or 0.0
            if off < BOUND_TOLERANCE:
                break
    return cells.withColumn("prob", F.least(F.lit(1.0), "g")).drop("g"), off


def probabilities(raked: DataFrame, keep: float = KEEP) -> DataFrame:
    """raked with prob, where the expected tokens are `keep` of all and have the target margins. If no draw of that size has
    them, the size shrinks until one has: to what the scarcest value allows, then by a fifth at a time."""
    total = raked.agg(F.sum("tokens")).first()[0] or 0.0
    if not total:
        return raked.withColumn("prob", F.col("factor") * 0.0)
    room = [raked.groupBy(d).agg(F.try_divide(F.sum("tokens"), F.max(f"target_{d}") * total).alias("room")).select("room") for d in DIMS]
    most = room[0].unionByName(room[1]).unionByName(room[2]).agg(F.min("room")).first()[0] or 1.0
    free = 1 / (raked.where("tokens > 0").agg(F.max("factor")).first()[0] or 1.0)  # no cell is full up to here
    size = min(keep, most)
    raked, small = _gathered(raked)
    while size > free:
        out, off = _bounded(raked, total, size, small)
        if off < BOUND_TOLERANCE:
            return out
        size *= 0.8
    return raked.withColumn("prob", F.least(F.lit(1.0), F.col("factor") * min(size, free)))


def margins(cells: DataFrame) -> DataFrame:
    """dim, value, target and share (of the expected tokens) of cells with prob."""
    kept = F.col("tokens") * F.col("prob")
    shares = [cells.groupBy(d).agg(F.max(f"target_{d}").alias("target"), F.sum(kept).alias("kept")).select(F.lit(d).alias("dim"), F.col(d).alias("value"), "target", "kept") for d in DIMS]
    out = shares[0].unionByName(shares[1]).unionByName(shares[2])
    return out.withColumn("share", F.try_divide("kept", F.sum("kept").over(W.partitionBy("dim")))).drop("kept")


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on doc_id alone."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11) / F.lit(float(1 << 53))


def mix(docs: DataFrame, columns: list[str], targets: dict[str, DataFrame] | None = None, keep: float = KEEP, alpha: float = ALPHA, seed: int = SEED, id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """columns of docs with a struct (source, lang, topic, tokens, weight, prob, off, sampled), and the struct's name."""
    name = fresh(docs, "mixed")
    rows = with_cells(docs, list(dict.fromkeys([*columns, id_col])), name)
    p = checkpointed(probabilities(rake(cells_of(rows, name), targets, alpha), keep)).select(F.struct(*DIMS).alias("cell"), F.struct("factor", "prob", "off").alias("told"))
    p = p.select(F.struct("cell", "told").alias(fresh(rows, "drawn")))
    drawn = p.columns[0]
    p = F.broadcast(p) if p.count() <= BROADCAST_CELLS else p
    both = rows.join(p, reduce(Column.__and__, [F.col(f"{name}.{d}") == F.col(f"{drawn}.cell.{d}") for d in DIMS]))
    told = [F.col(f"{name}.{x}").alias(x) for x in (*DIMS, "tokens")] + [F.col(f"{drawn}.told.{x}").alias(y) for x, y in (("factor", "weight"), ("prob", "prob"), ("off", "off"))]
    sampled = draw(F.col(f"`{id_col}`"), seed) < F.col(f"{drawn}.told.prob")
    return both.select(*[F.col(f"`{c}`") for c in columns], F.struct(*told, sampled.alias("sampled")).alias(name)), name


def sampled(docs: DataFrame, **how) -> DataFrame:
    """The drawn rows, with the columns of docs."""
    rows, name = mix(docs, docs.columns, **how)
    return rows.where(f"{name}.sampled").select(*[F.col(f"`{c}`") for c in docs.columns])
