"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Targets share the total of all sizes by weight, filled up like communicating vessels: no target is
above ``most`` times its source's size.  Blocks of ``block_words`` words are the seats.  They go to
sources by the highest quotients ``target / (2k + 1)``, and each source's seats go to its shards in
the same way, by the shards' sizes.  A shard holds about ``shard_words`` words of one source, so a
source with most of the rows is spread over many.  Within a shard documents stand in the order of a
seeded digest; the quota takes whole passes over them and then blocks from the start of that order.

Defined results: a null text has no words; a null source is a source of its own, after all others;
rows with equal ids are taken one by one, the shorter first; sources without words have target 0; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(none, source, source_size, target) for ``sizes`` (none, source, source_size).

    Sources are few next to documents; the windows below sort one row for each source (its name and four numbers) in one
    task, which spills; with a million sources these are some 100 MB.
    Sorted by ``cap / weight``, the sources that stop at their cap come first, and the level at
    which the rest settles is the largest one met on the way.
    """
    weight = "element_at(array({}), cast((row_number() over (order by none, source) - 1) % {} as int) + 1)".format(", ".join(map(str, weights)), len(weights))
    return sizes.sparkSession.sql(f"""
        with weighed as (select *, {weight} weight, {most} * source_size cap from {{sizes}}),
        levels as (
            select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, none, source rows between unbounded preceding and 1 preceding), 0))
                / (sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, none, source rows between unbounded preceding and 1 preceding), 0)) level
            from weighed)
        select none, source, source_size, least(cast(cap as double), weight * max(level) over ()) target from levels""", sizes=sizes)


def apportion(cells: DataFrame, group: list[str], cell: list[str], weight: str, seats: str) -> DataFrame:
    """``cells`` with ``quota``: each group's ``seats`` dealt by highest quotients ``weight / (2k + 1)``.

    A cell surely gets the seats well below its fair share, so only those around it compete: the
    shift that n roundings can cause is at most n/2 seats in all, hence the width of the range.
    """
    keys = ", ".join(group) or "1"
    width = "cast(ceil(share * n / (2 * greatest(own_seats, 1))) as bigint) + 2"
    near = cells.selectExpr("*", f"sum({weight}) over (partition by {keys}) whole", f"count(*) over (partition by {keys}) n", f"{seats} own_seats")
    near = near.selectExpr("*", f"if(whole > 0, own_seats * ({weight} / whole), 0D) share").selectExpr("*", f"greatest(0L, cast(floor(share) as bigint) - ({width})) base", f"cast(ceil(share) as bigint) + {width} top")
    near = near.selectExpr("*", f"sum(base) over (partition by {keys}) granted")
    open_ = near.selectExpr(*group, *cell, weight, "own_seats", "granted", "explode(sequence(base, top - 1)) k")
    ranked = open_.selectExpr("*", f"row_number() over (partition by {keys} order by {weight} / (2 * k + 1) desc, {', '.join(cell)}, k) place")
    won = ranked.where(f"place <= own_seats - granted and {weight} > 0").groupBy(*group, *cell).agg(F.count("*").alias("won"))
    on = [F.expr(f"l.{c} = r.{c}") for c in [*group, *cell]]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return near.alias("l").join(won.alias("r"), condition, "left").selectExpr(*[f"l.{c}" for c in cells.columns], "base + coalesce(won, 0) quota")


def mix(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3, block_words: int = 32, shard_words: int = 1 << 20, seed: int = 42,
) -> DataFrame:
    """(id, source, size, source_size, target, taken) of every row; ``taken`` counts repeats."""
    thin = docs.select(
        F.col(id_col).alias("id"), F.col(source).isNull().alias("none"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("rank"),
    )
    thin = staged(thin, "mix")
    goals = targets(thin.groupBy("none", "source").agg(F.sum("size").alias("source_size")), weights, most)
    goals = goals.selectExpr("*", f"cast(ceil(source_size / {shard_words}) as bigint) n_shards", f"cast(round(sum(source_size) over () / {block_words}) as bigint) blocks")
    goals = staged(apportion(goals, [], ["none", "source"], "target", "blocks").withColumnRenamed("quota", "source_quota"), "mix")
    spread = "cast(conv(substr(rank, 1, 8), 16, 10) as bigint) % greatest(n_shards, 1)"
    # one row for each source: small against the documents, and Spark picks the join by its size
    dealt = thin.join(goals, ["none", "source"]).selectExpr("id", "none", "source", "size", "rank", "source_size", "target", "source_quota", f"{spread} shard")
    shards = dealt.groupBy("none", "source", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
    quotas = apportion(shards, ["none", "source"], ["shard"], "shard_size", "source_quota")
    quotas = quotas.selectExpr("none", "source", "shard", "shard_size", f"least(quota * {block_words}, {most} * shard_size) words")
    order = "(partition by none, source, shard order by rank, id, size rows between unbounded preceding and current row)"
    placed = dealt.selectExpr("*", f"sum(size) over {order} - size position").join(quotas, ["none", "source", "shard"])
    taken = "if(shard_size = 0, 0L, (words div shard_size) * size + greatest(0L, least(size, words % shard_size - position)))"
    return placed.selectExpr(f"id {id_col}", f"if(none, null, source) {source}", "size", "source_size", "target", f"cast({taken} as bigint) taken")


def mixed(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The documents of the mix: one row for each whole pass over a document and one for a last part.

    Rows keep the columns of ``docs``.  A part is the document's first words, joined by one space; documents that the mix doesn't take have no row.  Rows with equal ids share their
    taken words evenly only if their texts are equal, so ids should be unique.
    """
    # own names, so that no column of ``docs`` can clash
    own = [f"c{i}" for i in range(len(docs.columns))]
    the_id, the_text = (own[docs.columns.index(c)] for c in (id_col, text))
    plan = mix(docs, text, id_col, source, **options).where("taken > 0").groupBy(id_col, "size").agg(F.first("taken").alias("taken"))
    plan = plan.select(F.col(id_col).alias("plan_id"), F.col("size").alias("plan_size"), "taken")
    rows = docs.toDF(*own).withColumn("size", F.coalesce(F.regexp_count(F.col(the_text), F.lit(WORD)), F.lit(0)).cast("long"))
    rows = rows.join(plan, F.col(the_id).eqNullSafe(F.col("plan_id")) & (F.col("size") == F.col("plan_size")))
    rows = rows.withColumn("pass", F.explode(F.expr("sequence(0L, (taken - 1) div size)"))).withColumn("left", F.expr("least(size, taken - pass * size)"))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col(the_text), F.lit(WORD), F.lit(0)), 1, F.col("left").cast("int")), " ")
    rows = rows.withColumn(the_text, F.when(F.expr("left = size"), F.col(the_text)).otherwise(part))
    if "n_chars" in docs.columns:
        rows = rows.withColumn(own[docs.columns.index("n_chars")], F.char_length(the_text))
    return rows.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(own, docs.schema, strict=True)])
