"""Mixing sources to target weights by dependent rounding; DataFrame functions only.

Each document of a source is to be taken ``target / source size`` times, a whole
number of times and perhaps once more. Whether once more is decided by pivotal
rounding: two documents with open probabilities give words to one another, in a
direction drawn at random such that each keeps its expectation, until one of
the two is decided. What a source takes stays the same in each transfer. Documents meet
in small groups; the one each group leaves open goes on to the next level, where
groups are again small, up to a single one for each source, which is rounded by
a draw. So a source misses its target by less than one document's size.

Defined results: a null text has size 0; documents of size 0 are never taken
more than the whole number of times; a null source is a source, the last; rows
equal in id, source and size are interchangeable, and taken as near equally
often as can be; an empty table gives no rows. Draws are hashes of what is
drawn for, so reruns agree.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dossier.llm.tables import apart, own, together, word_count
from dossier.operators.staging import staged

# Weights of the sources by their order, and the most a document is repeated.
WEIGHTS = (5, 2, 1)
MOST = 3

# Documents that meet in a group of the reduction tree, on average.
FAN_IN = 16
# Rows equal in id, source and size are written out in pieces of so many.
PIECE = 10_000

_KEY = ["id", "source", "size"]


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of ``source`` and ``size``.

    The sum of all sizes is shared by weight; what is above ``most`` times a
    source's size is shared among the others until none is above. Sources are
    capped in the order of capacity by weight, so that one pass over running
    sums finds which: the k-th is capped if its share of what the capped before
    it leave is more than it holds.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row for each source, so the few windows over all of them stay small.
    order = Window.orderBy(F.col("source").isNull(), "source")
    given = F.array(*[F.lit(float(w)) for w in weights])
    weighed = by_source.withColumn("_place", F.row_number().over(order) - 1).withColumns(
        {
            "_weight": F.get(given, F.pmod("_place", F.lit(len(weights)))),
            "_capacity": F.lit(float(most)) * F.col("source_size"),
        }
    )
    all_sources = Window.partitionBy()
    filled = Window.orderBy(F.col("_capacity") / F.col("_weight"), "_place")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    weighed = weighed.withColumns(
        {
            "_total": F.sum("source_size").over(all_sources).cast("double"),
            "_weights": F.sum("_weight").over(all_sources),
            "_capped": F.coalesce(F.sum("_capacity").over(before), F.lit(0.0)),
            "_capped_weight": F.coalesce(F.sum("_weight").over(before), F.lit(0.0)),
        }
    )
    level = (F.col("_total") - F.col("_capped")) / (F.col("_weights") - F.col("_capped_weight"))
    full = level * F.col("_weight") >= F.col("_capacity")
    weighed = weighed.withColumns({"_level": level, "_full": full})
    # All sources after the first that is not full get its level.
    first = F.struct((F.col("_capacity") / F.col("_weight")).alias("by"), "_place", "_level")
    weighed = weighed.withColumn("_share", F.min(F.when(~F.col("_full"), first)).over(all_sources))
    return weighed.select(
        "source",
        "source_size",
        F.when(F.col("_full"), F.col("_capacity"))
        .otherwise(F.col("_share._level") * F.col("_weight"))
        .alias("target"),
    )


def _draw(*about) -> Column:
    """A number in [0, 1) that is a function of the columns."""
    return F.pmod(F.xxhash64(*about), F.lit(1 << 30)).cast("double") / (1 << 30)


def _pivot(state: Column, item: Column) -> Column:
    """One transfer: ``state.open`` and ``item`` exchange words until one of them is decided.

    Both are structs of key, size, share (of the document, open between 0 and 1)
    and draw. The decided one joins ``state.done``, the other stays open. With a
    and b the words each may still give or take, the first gains ``up`` words
    with probability ``down / (up + down)`` and else loses ``down``.
    """
    a, b = state["open"], item
    up = F.least((1.0 - a["share"]) * a["size"], b["share"] * b["size"])
    down = F.least(a["share"] * a["size"], (1.0 - b["share"]) * b["size"])
    gains = item["draw"] * (up + down) < down
    moved = F.when(gains, up).otherwise(-down)
    # Which of the two is decided follows from which bound was met, not from rounded shares.
    a_decided = F.when(gains, (1.0 - a["share"]) * a["size"] <= b["share"] * b["size"]).otherwise(
        a["share"] * a["size"] <= (1.0 - b["share"]) * b["size"]
    )

    def changed(one, share):
        share = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
        return F.struct(
            one["key"].alias("key"), one["size"].alias("size"), share.alias("share"), one["draw"].alias("draw")
        )

    new_a = changed(a, a["share"] + moved / a["size"])
    new_b = changed(b, b["share"] - moved / b["size"])
    a_final = changed(a, F.when(gains, F.lit(1.0)).otherwise(F.lit(0.0)))
    b_final = changed(b, F.when(gains, F.lit(0.0)).otherwise(F.lit(1.0)))
    return F.struct(
        F.when(a_decided, new_b).otherwise(new_a).alias("open"),
        F.concat(state["done"], F.array(F.when(a_decided, a_final).otherwise(b_final))).alias("done"),
    )


def _level(open_items: DataFrame, depth: int) -> DataFrame:
    """One level of the tree: each group's decided items, and the one it leaves open (``last``)."""
    item = F.struct(
        F.col("key"), F.col("size"), F.col("share"), _draw("key", F.lit(depth)).alias("draw")
    )
    # Items of like size meet first, so that little is left to give.
    grouped = open_items.groupBy("source", "node").agg(
        F.array_sort(F.collect_list(F.struct("size", "key", item.alias("item")))).alias("items")
    )
    items = F.transform("items", lambda x: x["item"])
    kind = "array<struct<key:struct<id:bigint,source:string,size:bigint>,size:bigint,share:double,draw:double>>"
    start = F.struct(F.get(items, F.lit(0)).alias("open"), F.expr(f"CAST(array() AS {kind})").alias("done"))
    folded = F.aggregate(F.slice(items, 2, F.greatest(F.size("items") - 1, F.lit(0))), start, _pivot)
    return grouped.select("source", "node", folded.alias("state"))


def _rounded(shares: DataFrame, fan_in: int) -> DataFrame:
    """``key`` and ``extra`` (0 or 1) of documents with open ``share``; sums of words by source are kept.

    ``node`` is a document's group on the lowest level. A group's number divided
    by ``fan_in`` is its group on the next one, so the number of levels follows
    from the number of documents of the largest source.
    """
    counted = shares.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
    nodes = F.greatest(F.ceil(F.col("_n") / F.lit(fan_in)), F.lit(1))
    marked = shares.join(
        counted.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    )
    level = marked.withColumn("node", F.pmod(F.xxhash64("key"), nodes).cast("bigint")).select(
        "source", "node", "key", "size", "share"
    )
    largest = counted.agg(F.max("_n")).first()[0] or 0
    width, depth, decided = -(-largest // fan_in), 0, []
    while True:
        state = staged(_level(level, depth), f"mix-{depth}")
        decided.append(state.select(F.explode("state.done").alias("x")).select("x.key", "x.share"))
        rest = state.select("source", "node", "state.open.*")
        if width <= 1:
            break
        level = rest.withColumn("node", F.expr(f"node div {fan_in}")).select(
            "source", "node", "key", "size", "share"
        )
        width, depth = -(-width // fan_in), depth + 1
    # What one document of a source has left over is drawn for.
    last = rest.select("key", (_draw("key", F.lit(-1)) < F.col("share")).cast("double").alias("share"))
    for part in decided:
        last = last.unionByName(part)
    return last.select("key", F.col("share").cast("int").alias("extra"))


def mixing_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple = WEIGHTS,
    most: int = MOST,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """How often each document is taken: a row for each ``id``, ``source`` and ``size``.

    ``rows`` documents share the three; ``more_rows`` of them are taken
    ``copies + 1`` times, the others ``copies`` times. Also ``source_size`` and ``target``.
    """
    sized = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    keys = staged(sized.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("rows")), "mix-sizes")
    totals = keys.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("size"))
    goal = staged(targets(totals, weights, most), "mix-targets").withColumnRenamed("source", "_source")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # Targets at the most a source holds are whole numbers of copies; do not round those.
    copies = F.least(F.floor(each + 1e-9), F.lit(most)).cast("int")
    planned = (
        keys.join(goal, F.col("source").eqNullSafe(F.col("_source")), "left")
        .drop("_source")
        .withColumn("copies", copies)
        .withColumn("_more", F.greatest(each - F.col("copies"), F.lit(0.0)) * F.col("rows"))
        .withColumn("_whole", F.floor(F.col("_more") + 1e-12))
        .withColumns({"share": F.col("_more") - F.col("_whole"), "key": F.struct(*_KEY)})
    )
    open_rows = planned.where("share > 1e-12 AND size > 0").select("source", "key", "size", "share")
    extra = _rounded(staged(open_rows, "mix-open"), fan_in)
    extra = extra.select(*[F.col(f"key.{c}").alias(f"_{c}") for c in _KEY], "extra")
    match = F.lit(True)
    for column in _KEY:
        match &= F.col(column).eqNullSafe(F.col(f"_{column}"))
    return planned.join(extra, match, "left").select(
        *_KEY,
        "rows",
        "source_size",
        "target",
        "copies",
        (F.col("_whole") + F.coalesce("extra", F.lit(0))).cast("bigint").alias("more_rows"),
    )


def _one_each(plan: DataFrame) -> DataFrame:
    """A row for each document of a plan, with ``taken_copies``; many equal rows go over several tasks."""
    columns = [c for c in plan.columns if c not in ("rows", "more_rows", "copies")]

    def written(pieces, first, last):
        return pieces.withColumn("_row", F.explode(F.sequence(first, last))).select(
            *columns,
            (F.col("copies") + (F.col("_row") <= F.col("more_rows")).cast("int")).alias("taken_copies"),
        )

    few = written(plan.where(F.col("rows") <= PIECE), F.lit(1), F.col("rows"))
    many = (
        plan.where(F.col("rows") > PIECE)
        .withColumn("_from", F.explode(F.sequence(F.lit(1), F.col("rows"), F.lit(PIECE))))
        .repartition("id", "source", "_from")
    )
    return few.unionByName(
        written(many, F.col("_from"), F.least(F.col("_from") + PIECE - 1, F.col("rows")))
    )


def mixture_sizes(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """For each document, without its text: size, source size, target, and words taken."""
    plan = staged(mixing_plan(docs, id_col, **options), "mix-plan")
    return _one_each(plan).select(
        F.col("id").alias(id_col),
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("taken_copies")).alias("taken"),
        F.col("taken_copies").alias("copies"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with ``copies``, how often each document goes into the mix; those not taken are left out.

    Documents equal in id, source and size are numbered to tell them apart;
    others need no numbers. Where ``docs`` has a column ``copies`` of its own, it
    stays, and the new one is ``mix_copies`` (with more ``mix_`` before it if need be).
    """
    plan = mixing_plan(docs, id_col, source_col, **options).where("copies > 0 OR more_rows > 0")
    plan = plan.select(*[F.col(c).alias(f"_{c}") for c in [*_KEY, "rows", "copies", "more_rows"]])
    plan = staged(plan, "mix-plan")
    rows = apart(docs)
    text = F.col(own(options.get("text_col", "text")))
    rows = rows.withColumn("_words", word_count(text))
    match = (
        rows[own(id_col)].cast("bigint").eqNullSafe(plan["_id"])
        & rows[own(source_col)].eqNullSafe(plan["_source"])
        & (rows["_words"] == plan["_size"])
    )
    # The plan has a row for each document, so it is not to be broadcast.
    found = rows.join(plan.hint("merge"), match)
    single = found.where("_rows = 1").withColumn("_number", F.lit(1))
    equal = Window.partitionBy("_id", "_source", "_size").orderBy(F.xxhash64(text))
    repeated = found.where("_rows > 1").withColumn("_number", F.row_number().over(equal))
    copies = (F.col("_copies") + (F.col("_number") <= F.col("_more_rows")).cast("int")).cast("int")
    name = "copies"
    while name in docs.columns:
        name = f"mix_{name}"
    taken = single.unionByName(repeated).withColumn("_taken", copies).where("_taken > 0")
    return taken.select(*together(docs), F.col("_taken").alias(name))
