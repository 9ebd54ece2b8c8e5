"""Secret scans with corpus-wide ownership frequency, on DataFrame functions alone.

Base kinds (fixed patterns below) are found leftmost and without overlap, each kind by itself: `split` gives the gaps
between matches, `regexp_extract_all` the matches, and a running sum of both lengths over a row's matches their places in
code points. An assignment whose value is too short is dropped after matching, so it still uses up its text.

The method: every candidate's value is hashed and counted over the corpus by distinct owners and repositories, and both
counts decide. A value found with `example_owners` or more owners, or in `example_repositories` or more repositories (of
one owner, too), is a widely copied example; any other looks live, so one copy with a second owner changes nothing. Besides
the base kinds, long strings of letters and digits without such a context (kind `owned`) are candidates; they become spans
if their value looks live and they do not overlap a base span. Base spans always stay; every span carries both counts
and the verdict. A repository belongs to its owner: the same name with two owners counts twice.

Hot values (one example on a third of all pages) are counted by (value, owner, repository) with map-side combine; each
row's verdicts come back through a join by value of two written tables, which Spark splits at run time if it is
skewed. Texts are read once; after that only rows with candidates are moved, without their texts.

Null texts count as empty. Null owners count as one owner, null repositories as one repository. Repeated rows are
reported each. An empty table gives an empty table. Columns beyond the named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import staging

# Fixed patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
BASE_KINDS = ("assign", "access", "hex")

#: Candidates without context: 20 or more letters and digits in a row; both must occur.
OWNED_RUN = r"[A-Za-z0-9]{20,}"
OWNED = 3

#: From so many distinct owners, or repositories, on a value is a widely copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 10

HIT = "array<struct<kind_no:int,nth:int,gap:int,length:int,value:string>>"


def hits(text: Column, pattern: str, value_group: int, kind_no: int, hint: str) -> Column:
    """Every match in order: kind, number, code points between it and the match before, its own, and the value.

    Most texts hold none; one search for the hint tells.
    """
    found = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("v"),
        F.split(text, pattern, -1).alias("g"),
    )
    made = F.transform(
        F.filter(found, lambda x: x["m"].isNotNull()),  # the text behind the last match
        lambda x, i: F.struct(
            F.lit(kind_no).alias("kind_no"),
            i.alias("nth"),
            F.length(x["g"]).alias("gap"),
            F.length(x["m"]).alias("length"),
            x["v"].alias("value"),
        ),
    )
    return F.when(text.rlike(hint), made).otherwise(F.array().cast(HIT))


def all_hits(text: Column) -> Column:
    # Runs of access and hex are maximal, so a least length in the pattern drops just the short ones.
    access, digits = rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}", rf"[0-9a-f]{{{HEX_LEAST},}}"
    return F.concat(
        hits(text, ASSIGN, 2, 0, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""),
        hits(text, access, 0, 1, access),
        hits(text, digits, 0, 2, digits),
        hits(text, OWNED_RUN, 0, OWNED, OWNED_RUN),
    )


def placed(found: DataFrame) -> DataFrame:
    """One row per candidate span with start and end; short base matches and owned runs over base spans are gone."""
    each = found.filter("size(hits) > 0").select("rid", "owner", "repository", F.explode("hits").alias("x"))
    each = each.select("rid", "owner", "repository", "x.*")
    in_kind = Window.partitionBy("rid", "kind_no").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("length").cast("long")).over(in_kind)
    spans = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    spans = spans.filter(
        F.when(F.col("kind_no") == 0, F.length("value") >= ASSIGN_LEAST).when(F.col("kind_no") == OWNED, mixed).otherwise(True)
    )
    base = F.col("kind_no") != OWNED
    by_start = Window.partitionBy("rid").orderBy("start", "kind_no")
    before = F.max(F.when(base, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    free = F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(after >= F.col("end"), F.lit(True))
    return (
        spans.withColumn("stays", base | free)
        .filter("stays")
        .select("rid", "owner", "repository", "kind_no", "start", "end", F.sha2("value", 256).alias("value"))
    )


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in (*BASE_KINDS, "owned")])
    parts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.get(kinds, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    owner_column: str = "source",
    repository_column: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """Per row: id, spans ([{start, kind_no, end, n_owners, n_repositories, live}] in order): the base ones and the owned ones."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = staging.staged(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(id_column).alias("id"),
            F.col(owner_column).cast("string").alias("owner"),
            F.col(repository_column).cast("string").alias("repository"),
            all_hits(text).alias("hits"),
        ),
        "secrets-found",
    )
    spans = staging.staged(placed(found), "secrets-spans")
    by_owner = (
        spans.groupBy("value", "owner", "repository")
        .agg(F.lit(1).alias("one"))
        .groupBy("value", "owner")
        .agg(F.sum("one").alias("n_repositories"))
    )
    spread = by_owner.groupBy(F.col("value").alias("v")).agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("n_repositories").alias("n_repositories")
    )
    spread = staging.staged(spread, "secrets-spread")
    live = (F.col("n_owners") < example_owners) & (F.col("n_repositories") < example_repositories)
    judged = spans.join(spread, F.expr("value = v")).withColumn("live", live).filter((F.col("kind_no") != OWNED) | F.col("live"))
    by_row = judged.groupBy(F.col("rid").alias("r")).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind_no", "end", "n_owners", "n_repositories", "live"))).alias("spans")
    )
    none = F.array().cast("array<struct<start:long,kind_no:int,end:long,n_owners:long,n_repositories:long,live:boolean>>")
    return found.drop("hits").join(by_row, F.expr("rid = r"), "left").select("id", F.coalesce("spans", none).alias("spans"))


def secret_spans(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, then n_owned, n_live, n_example and ownership.

    ownership: owners/repositories/live or example for each of the spans, in their order, comma-joined.
    """
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind_no"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind_no"] != OWNED)
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long")
    verdict = lambda s: F.when(s["live"], "live").otherwise("example")
    counts = F.transform(
        "spans", lambda s: F.concat_ws("/", s["n_owners"].cast("string"), s["n_repositories"].cast("string"), verdict(s))
    )
    return scan(docs, **options).select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count(OWNED).alias("n_owned"),
        live.alias("n_live"),
        (F.size("spans") - live).cast("long").alias("n_example"),
        F.array_join(counts, ",").alias("ownership"),
    )
