"""Chat formatting: cumulative snapshots are collapsed, then what remains is rendered.

A logged conversation that is a prefix of a longer one, turn by turn, is a snapshot of it. Each turn has
two 64-bit hashes of its place, role and text; the exclusive or of those so far is the rolling hash of a
prefix (128 bits with both). A conversation goes if its whole hash is among the proper prefixes of
another (an anti-join on distinct hashes), or equals that of one with a smaller id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"


def numbered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, pos (from 1), role, text and the prefix's hashes p1, p2; exact repeats of a turn left out."""
    own = turns.where(F.col(conv).isNotNull()).select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    again = F.struct("turn", "role", "text").eqNullSafe(F.lag(F.struct("turn", "role", "text")).over(order))
    own = own.withColumn("new", ~F.coalesce(again, F.lit(False)))
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("pos", F.sum(F.col("new").cast("int")).over(running)).where("new").drop("new", "turn")
    place = Window.partitionBy("conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("p1", F.bit_xor(F.xxhash64("pos", "role", "text")).over(place))
    return own.withColumn("p2", F.bit_xor(F.xxhash64(F.lit("second"), "text", "role", "pos")).over(place))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), role, F.lit("\n"), text, F.lit(END + "\n"))


def collapse_and_render(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The maximal conversations: ``conv``, n_turns and the rendered text.

    Turns are taken in order of turn, role and text; exact repeats of a turn within a conversation count
    once. Null roles and texts count as empty, null turns come first; rows without a conversation are left
    out. Of equal conversations the one with the smallest id stays. Other columns are not read, whatever
    their names. No turns: no rows. A rendered conversation is one value, as large as its own turns.
    """
    own = numbered_turns(turns, conv, turn, role, text)
    ends = own.groupBy("conv").agg(F.max(F.struct("pos", "p1", "p2")).alias("e")).select("conv", "e.*")
    classes = ends.groupBy("pos", "p1", "p2").agg(F.min("conv").alias("conv"))
    last = F.max("pos").over(Window.partitionBy("conv"))
    proper = own.select("conv", "pos", "p1", "p2").withColumn("n", last).where("pos < n").select("pos", "p1", "p2").distinct()
    kept = classes.join(proper, ["pos", "p1", "p2"], "left_anti").select("conv")
    each = own.join(kept, "conv", "left_semi").groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", rendered(F.col("role"), F.col("text")).alias("r")))).alias("all"))
    return each.select(F.col("conv").alias(conv), F.size("all").cast("bigint").alias("n_turns"), F.array_join(F.transform("all", lambda x: x["r"]), "").alias("rendered"))


def op4_chat(spark, sf_dir: str) -> DataFrame:
    return collapse_and_render(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = rf"""
with t as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
r as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos, '{BEGIN}' || role || chr(10) || text || '{END}' || chr(10) as r from t),
p as (select conv_id, pos, string_agg(r, '') over (partition by conv_id order by pos rows between unbounded preceding and current row) as prefix, count(*) over (partition by conv_id) as n from r),
e as (select min(conv_id) as conv_id, n, prefix from p where pos = n group by n, prefix)
select conv_id, n as n_turns, prefix as rendered from e where not exists (select 1 from p where p.pos = e.n and p.n > e.n and p.prefix = e.prefix)
"""
