"""Mixing sources to target weights by hierarchical budgeting.

A token budget enters the tree of domains, languages and sources at its root. Each node shares what it
gets among its children by their weights; a child takes no more than its subtree can give (its tokens
times the epochs allowed), and what it can't take goes to its siblings, by weight again. So a shortage
leaves a node, for its parent's siblings, only when none of its own subtree can fill it. Levels are budgeted one after
another by aggregations and windows over nodes, so a tree may have any number of leaves; the children of one node are
sorted in one task, a few numbers each.

A leaf then reads its documents in seeded orders, one for each epoch: whole epochs while the budget
lasts, then the prefix of the next one whose tokens reach the rest. The prefix's end is found from sums
over 4096 slices of the order, then over 4096 parts of one slice, then by a sort inside one part; so a source with a third
of all rows needs no large task, and texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from pvscan.scratch import discard, written

Path = tuple[str, ...]
#: Leaves that are broadcast at most (they are counted); more are joined by a shuffle.
FEW_LEAVES = 200_000


def shared(children: DataFrame, parent: list[str], order: list[str]) -> DataFrame:
    """``children`` (amount: of the parent; wanted, most) with got: the amount by weight, none over ``most``.

    A child is full if its part reaches ``most`` when those that fill up earlier (a smaller most / wanted) are full. Children
    of no weight share, by what they can take, what is left when all others are full.
    """
    wanted, most, amount = F.col("wanted"), F.col("most"), F.col("amount")
    open_ = (wanted > 0) & (most > 0)
    along = Window.partitionBy(*parent).orderBy(F.col("ratio").asc_nulls_last(), *order)
    family = Window.partitionBy(*parent)
    own = children.withColumn("ratio", F.when(open_, most / wanted))
    weight = F.when(open_, wanted).otherwise(0.0)
    taken = F.sum(F.when(open_, most).otherwise(0.0)).over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.when(open_, most).otherwise(0.0)
    own = own.withColumn("taken", taken).withColumn("later", F.sum(weight).over(along.rowsBetween(0, Window.unboundedFollowing)))
    own = own.withColumn("full", open_ & (F.col("taken") + F.col("ratio") * F.col("later") <= amount))
    filled = F.sum(F.when(F.col("full"), most).otherwise(0.0)).over(family)
    weights = F.sum(F.when(F.col("full"), 0.0).otherwise(weight)).over(family)
    loose = F.sum(F.when(open_, 0.0).otherwise(most)).over(family)
    own = own.withColumn("rest", F.greatest(amount - filled, F.lit(0.0))).withColumn("weights", weights).withColumn("loose", loose)
    part = F.when(F.col("full"), most).when(open_, F.col("rest") * wanted / F.col("weights"))
    part = part.when((F.col("weights") == 0) & (F.col("loose") > 0), F.col("rest") * most / F.col("loose")).otherwise(0.0)
    return own.withColumn("got", F.least(part, most)).drop("ratio", "taken", "later", "full", "rest", "weights", "loose")


def budgets(supply: DataFrame, names: list[str], weights: Mapping[Path, float], budget: float, epochs: int) -> DataFrame:
    """Each leaf of ``supply`` (names, n: its tokens) with asked: the tokens it is to give.

    ``weights`` is by node, 1 where none is given, and only compares siblings; negative ones count as 0.
    """
    spark = supply.sparkSession
    rooms = [supply.groupBy(*names[:d]).agg((F.sum("n") * F.lit(float(epochs))).alias("most")) for d in range(len(names) + 1)]
    root, given = min(float(budget), rooms[0].first()[0] or 0.0), None
    for d in range(1, len(names) + 1):
        own = [(*path, max(0.0, float(w))) for path, w in weights.items() if len(path) == d]
        table = spark.createDataFrame(own, ", ".join([*(f"{n} string" for n in names[:d]), "wanted double"]))  # the caller's own mapping
        children = rooms[d].join(F.broadcast(table), names[:d], "left").fillna(1.0, ["wanted"])
        children = children.withColumn("amount", F.lit(root)) if given is None else children.join(given.withColumnRenamed("got", "amount"), names[: d - 1])
        given = shared(children, names[: d - 1], names[:d]).select(*names[:d], "got")
    return supply.join(given, names).withColumn("asked", F.round("got").cast("bigint")).drop("got")


def tokens(text: Column) -> Column:
    """Number of words between ASCII white space."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("bigint")


def mix(docs: DataFrame, levels: list[str], weights: Mapping[Path, float], fraction: float, epochs: int = 1, seed: int = 0, identifier: str = "doc_id", text: str = "text", few: int = FEW_LEAVES) -> DataFrame:
    """The documents to train on, with n_tokens and epoch (from 0; a document is repeated for each).

    The budget is ``fraction`` of all tokens. ``levels`` names the tree's columns, outermost first; nulls count as empty strings.
    A document belongs to a prefix if the tokens before it are fewer than the rest of the leaf's
    budget, so a leaf gives at most one document's tokens more than asked. Documents that share id and
    text are taken together (ties of the order). Null and empty texts have no tokens and come along
    inside a prefix. Columns named n_tokens or epoch are replaced, others pass through, whatever their names. No documents: no rows.
    """
    rows = docs.drop("n_tokens", "epoch").select(F.struct("*").alias("row"))
    row = lambda c: F.col("row")[c]
    names = [f"l{i}" for i in range(len(levels))]
    of = [F.coalesce(row(c).cast("string"), F.lit("")).alias(n) for c, n in zip(levels, names, strict=True)]
    twin = F.concat_ws("|", F.coalesce(row(identifier).cast("string"), F.lit("")), F.xxhash64(F.coalesce(row(text), F.lit(""))).cast("string"))
    narrow = written(rows.select(*of, twin.alias("twin"), tokens(row(text)).alias("n_tokens")), "mix")
    supply = written(narrow.groupBy(*names).agg(F.sum("n_tokens").alias("n")), "supply")
    total, many = supply.agg(F.sum("n"), F.count("*")).first()
    near = F.broadcast if many <= few else (lambda df: df)
    whole = F.when(F.col("n") > 0, F.least(F.floor(F.col("asked") / F.col("n")), F.lit(epochs))).otherwise(0).cast("bigint")
    rest = F.when((F.col("n") > 0) & (F.col("whole") < epochs), F.col("asked") - F.col("whole") * F.col("n")).otherwise(0)
    asked = budgets(supply, names, weights, fraction * (total or 0), epochs).withColumn("whole", whole).withColumn("rest", rest)
    leaves = written(asked.select(*names, F.monotonically_increasing_id().alias("leaf"), "whole", "rest"), "leaves")

    def order(epoch: Column) -> Column:
        return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.col("twin")))

    at = narrow.join(near(leaves), names).where("rest > 0").select("leaf", "rest", F.lit(0).cast("bigint").alias("before"), "n_tokens", order(F.col("whole")).alias("h"))
    for digits in (3, 6):
        slices = at.withColumn("slice", F.substring("h", 1, digits)).groupBy("leaf", "slice").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"), F.first("before").alias("before"))
        along = Window.partitionBy("leaf").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        last = slices.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(along), F.lit(0))).where("before < rest")
        last = last.groupBy("leaf").agg(F.max(F.struct("slice", "before")).alias("m")).select("leaf", "m.*")
        at = at.drop("before").withColumn("slice", F.substring("h", 1, digits)).join(near(last), ["leaf", "slice"]).drop("slice")
    inside = at.groupBy("leaf", "h").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    within = Window.partitionBy("leaf").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    ends = inside.withColumn("upto", F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0))).where("upto < rest")
    ends = written(leaves.join(ends.groupBy("leaf").agg(F.max("h").alias("end")), "leaf", "left").where("whole > 0 or end is not null"), "ends")
    discard(narrow, supply, leaves)
    out = rows.select("row", *of, twin.alias("twin")).join(near(ends), names)
    copies = F.col("whole") + F.when(order(F.col("whole")) <= F.col("end"), 1).otherwise(0)
    out = out.withColumn("copies", copies).where("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    return out.select("row.*", tokens(row(text)).alias("n_tokens"), "epoch")


def with_domain(docs: DataFrame) -> DataFrame:
    """A domain for each source: one of four, by its checksum (documents has no such column)."""
    return docs.withColumn("domain", F.concat(F.lit("domain"), F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(4)).cast("string")))


LEVELS = ["domain", "lang", "source"]
#: Weights of domains; of languages, in every domain alike.
_DOMAINS = {"domain0": 4.0, "domain1": 2.0, "domain2": 1.0, "domain3": 1.0}
_LANGS = {"en": 3.0, "de": 2.0, "fr": 2.0, "es": 1.0}
WEIGHTS: dict[Path, float] = {(d,): w for d, w in _DOMAINS.items()} | {(d, x): w for d in _DOMAINS for x, w in _LANGS.items()}


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    docs = with_domain(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source"))
    return mix(docs, LEVELS, WEIGHTS, fraction=0.8, epochs=2, seed=42).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")
