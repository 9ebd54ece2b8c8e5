"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a target of words. Whole passes over the source (epochs) are taken first; what is missing then comes
from a weighted sample without replacement: a document's key is -ln(u) / w, with u uniform from a hash of its id and
text and w its quality weight; documents are taken in ascending key order while the running sum of their sizes
stays within the missing words, and the document that crosses the border is taken if that brings the sum nearer.

Weights come from a table of labels: LEAST_WEIGHT and the document's quality (the mean of its labels); a document without
a label gets the mean quality of those that have one. Missing weights count as 1, others are held within WEIGHT_RANGE.

No source is sorted as a whole. Keys are cut into buckets (their number grows with the source's rows), buckets are
summed with map-side combine, the running sum over buckets finds the one that holds the border, and only the rows of
that bucket are sorted. Everything up to the verdict on a document works on narrow rows (id, hash, source, size, weight);
only `mix` and `mixed_documents` move whole documents, once. Buckets follow the distribution of the source's keys, a mixture of one exponential per class of
weights (half octaves, so that a source has a bounded number), and so stay even whatever the weights are. A document then compares its key with its source's border. The other side of that join has
a row per source; where it is too large for Spark to broadcast it, a skewed source is split at run time.

Null texts have size 0; null sources form a source of their own, sorted last. Rows with equal id and
text share one key and are taken or left together. An empty table gives an empty table. Documents of a source whose sizes are all 0 are taken 0 times; the target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import staging

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a source in one bucket of keys, about.
BUCKET_ROWS = 2_000
#: What a document of quality 0 weighs.
LEAST_WEIGHT = 0.1
WEIGHT_RANGE = (1e-9, 1e9)


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: str, seed: int = 42) -> Column:
    """In (0, 1], from a hash: does not depend on the run."""
    return spread_evenly(F.xxhash64(F.lit(seed), *parts))


def spread_evenly(hashed: Column) -> Column:
    return (F.shiftrightunsigned(hashed, 11) + F.lit(1)) / F.lit(float(1 << 53))


def usable(weight: Column) -> Column:
    least, most = WEIGHT_RANGE
    number = F.coalesce(F.nanvl(weight.cast("double"), F.lit(1.0)), F.lit(1.0))
    return F.least(F.greatest(number, F.lit(least)), F.lit(most))


def label_weights(labels: DataFrame, id_column: str = "doc_id", quality_column: str = "quality") -> tuple[DataFrame, float]:
    """l_id, l_weight, one row per labelled id; and the weight of documents without a label."""
    known = labels.select(F.col(id_column).alias("l_id"), F.col(quality_column).cast("double").alias("q"))
    known = known.filter("l_id IS NOT NULL AND q IS NOT NULL AND NOT isnan(q)").groupBy("l_id").agg(
        (F.lit(LEAST_WEIGHT) + F.greatest(F.round(F.avg("q"), 9), F.lit(0.0))).alias("l_weight")
    )
    known = staging.staged(known, "mixing-quality")
    mean = known.agg(F.round(F.avg("l_weight"), 9)).first()[0]  # rounded: sums of doubles depend on their order
    return known, 1.0 if mean is None else mean


def targets(sizes: DataFrame, weights=(5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size and others, a row per source -> the same with target.

    Weights repeat over the sources in code point order, null last. A target stops at `most` times its source's size;
    the excess is shared again by weight among the others until none is above. Sources in ascending order of
    size / weight reach their stop first, so the rounds of sharing end at a level that one pass over that order finds.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("weight", F.get(cycle, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    by_stop = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    up_to = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    stop = F.lit(most) * F.col("source_size")
    # Level of sharing if all sources before this one are at their stop and no other is.
    level = (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum(stop).over(up_to), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up_to), F.lit(0.0))
    )
    levels = ranked.withColumn("level", level).withColumn("stop", stop)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("stop"), F.col("level"))
    shared = F.min_by(fits, F.when(fits.isNotNull(), F.col("stop") / F.col("weight"))).over(every)
    target = F.least(F.col("stop"), F.coalesce(shared * F.col("weight"), F.col("stop")))
    return levels.select(*sizes.columns, target.alias("target"))


def decided(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    quality: Column | None = None,
    weights=(5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
    labels: DataFrame | None = None,
) -> DataFrame:
    """id, hashed (of id and text), source, size, source_size, target, times for every row; texts stay where they are read.

    quality: positive weight of a row, 1 by default. Rows of higher weight come earlier in the fractional pass.
    labels: id and quality of documents, from which the weights are taken instead; unlabelled rows keep `quality` if given.
    """
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(F.lit(seed), id_column, text_column).alias("hashed"),
        n_words(text_column).alias("size"),
        (F.lit(None).cast("double") if quality is None else quality).alias("own_weight"),
        F.col(source_column).alias("source"),
    )
    weight = F.col("own_weight")
    if labels is not None:
        known, otherwise = label_weights(labels, id_column)
        rows = rows.join(known.hint("merge"), F.expr("id = l_id"), "left")
        weight = F.coalesce("l_weight", weight, F.lit(otherwise))
    rows = rows.withColumn("weight", usable(weight)).withColumn("key", -F.log(spread_evenly(F.col("hashed"))) / F.col("weight"))
    narrow = staging.staged(rows.select("source", "size", "key", "weight", "id", "hashed"), "mixing-keys")
    border = borders(narrow, weights, share, most)
    joined = narrow.join(border, F.expr("source <=> b_source"), "left").withColumn("bucket", bucket())
    in_pass = F.expr(
        "bucket < border_bucket OR bucket = border_bucket AND "
        "(key < border_key OR key = border_key AND struct(id) <= struct(border_id))"
    )
    times = F.when(F.col("source_size") > 0, F.col("epochs") + F.when(in_pass, 1).otherwise(0)).otherwise(0)
    return joined.select("id", "hashed", "source", "size", "source_size", "target", times.cast("int").alias("times"))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = 42,
    **options,
) -> DataFrame:
    """row (all columns of a document), size, source_size, target, times (how often the mix takes it).

    Options as for `decided`. Wide rows move once, to the verdict on them, whatever the size of the tables. The document's
    own columns travel inside a struct, so whatever names they have cannot clash.
    """
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(id_column).alias("id"),
        F.xxhash64(F.lit(seed), id_column, text_column).alias("hashed"),
        F.col(source_column).alias("source"),
    )
    verdict = decided(docs, id_column, text_column, source_column, seed=seed, **options)
    # Equal rows of a source share their verdict; max only where their weights differ.
    verdict = verdict.groupBy(
        F.col("id").alias("v_id"), F.col("hashed").alias("v_hashed"), F.col("source").alias("v_source"), "size", "source_size", "target"
    ).agg(F.max("times").alias("times"))
    same = F.expr("hashed = v_hashed AND id <=> v_id AND source <=> v_source")
    return rows.join(verdict.hint("merge"), same).select("row", "size", "source_size", "target", "times")


def bucket() -> Column:
    """The share of a source's keys expected below this one spreads them evenly over its buckets.

    spread: the source's classes of weights with their shares. The share above a key never grows with the key.
    """
    count = F.ceil(F.col("n_rows") / F.lit(float(BUCKET_ROWS)))
    above = F.aggregate(
        "spread", F.lit(0.0), lambda s, x: s + x["share"] * F.exp(-F.col("key") * x["weight"])
    )
    return F.greatest(F.least(F.floor(count * (1 - above)), count - 1), F.lit(0))


def source_sizes(narrow: DataFrame) -> DataFrame:
    """source, source_size, n_rows, spread ([{weight, share}], one per class of weights)."""
    classes = narrow.groupBy("source", F.round(2 * F.log2("weight")).cast("int").alias("class")).agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.avg("weight").alias("weight")
    )
    sizes = classes.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum("n").alias("n_rows"),
        F.sort_array(F.collect_list(F.struct("weight", "n"))).alias("classes"),
    )
    share = lambda x: F.struct(x["weight"].alias("weight"), (x["n"] / F.col("n_rows")).alias("share"))
    return sizes.select("source", "source_size", "n_rows", F.transform("classes", share).alias("spread"))


def borders(narrow: DataFrame, weights, share: float, most: float) -> DataFrame:
    """Per source: size, target, whole epochs; bucket, key and id of the last row that the fractional pass takes."""
    goal = staging.staged(
        targets(source_sizes(narrow), weights, share, most)
        .selectExpr(
            "source AS b_source",
            "source_size",
            "target",
            "n_rows",
            "spread",
            "CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS int) ELSE 0 END AS epochs",
        )
        .withColumn("missing", F.expr("target - epochs * source_size")),
        "mixing-goals",
    )
    bucketed = narrow.join(goal, F.expr("source <=> b_source")).withColumn("bucket", bucket())
    sums = staging.staged(
        bucketed.groupBy("b_source", "missing", "bucket").agg(F.sum("size").alias("n")), "mixing-buckets"
    )
    running = F.sum("n").over(Window.partitionBy("b_source").orderBy("bucket"))
    at_border = staging.staged(
        sums.withColumn("before", running - F.col("n"))
        .filter("missing > 0 AND before <= missing AND missing < before + n")
        .selectExpr("b_source AS c_source", "bucket AS border_bucket", "before"),
        "mixing-border",
    )
    close = (
        bucketed.join(at_border, F.expr("source <=> c_source AND bucket = border_bucket"))
        .groupBy("c_source", "before", "missing", "key", "id", "size")
        .agg((F.count(F.lit(1)) * F.col("size")).alias("size_of_all"))  # equal rows go together
    )
    in_order = Window.partitionBy("c_source").orderBy("key", F.col("id").asc_nulls_first(), "size")
    total = F.col("before") + F.sum("size_of_all").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    last = (
        close.withColumn("total", total)
        .filter("total - missing <= missing - (total - size_of_all)")
        .groupBy(F.col("c_source").alias("l_source"))
        .agg(F.max(F.struct(F.col("key"), F.col("id"))).alias("last"))
    )
    found = at_border.join(last, F.expr("c_source <=> l_source"), "left").select(
        "c_source", "border_bucket", F.col("last.key").alias("border_key"), F.col("last.id").alias("border_id")
    )
    return staging.staged(
        goal.join(found, F.expr("b_source <=> c_source"), "left").select(
            "b_source", "source_size", "target", "n_rows", "spread", "epochs", "border_bucket", "border_key", "border_id"
        ),
        "mixing-borders",
    )


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    return decided(docs, **options).selectExpr("id AS doc_id", "size", "source_size", "target", "size * times AS taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows the mix takes, each as often as it takes it, with the columns of docs."""
    taken = mix(docs, **options).filter("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
