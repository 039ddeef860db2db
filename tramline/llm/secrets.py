"""Secret scans by corpus-wide ownership.

Patterns find candidates in every whole text. The hash of each candidate's value is counted
over all documents: by distinct repositories and by distinct owners, where texts that are the
same count as one owner in one repository. A value that many hold is a widely copied example; one that few
hold looks live. All spans are reported, with that verdict beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import code_point_key, landed

# Kind, pattern, group that holds the value, fewest characters of that group.
# The class before a run of hex digits only saves tries; such a run is taken whole anyway.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
OPAQUE = ("opaque", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}", 0, 20)
KINDS = (*BASE, OPAQUE)

# A value with this many owners or repositories is an example.
EXAMPLE_OWNERS = 5
EXAMPLE_REPOSITORIES = 3
DISTINCT_CHARS = 8

_HITS = "array<struct<kind:int,gap:int,hit:string,value:string>>"
MASKS = {True: "[SECRET]", False: "[EXAMPLE]"}


def _hits(text: Column, number: int) -> Column:
    """Array of (kind, length of the gap before a match, match, value); the last has no match."""
    _, pattern, group, _ = KINDS[number]
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    kind = F.transform(gaps, lambda _: F.lit(number))
    zipped = F.arrays_zip(kind, gaps, whole, value).cast(_HITS)
    return F.when(text.rlike(pattern), zipped).otherwise(F.array().cast(_HITS))


def candidates(documents: DataFrame, repository: str = "source") -> DataFrame:
    """One landed row per document: `row, doc_id, repository, owner, hits`.

    `documents` has `doc_id`, `text` and the column named by `repository`. A null text is empty.
    `row` tells apart rows that repeat a doc_id; `owner` is a hash of the text.
    """
    text = F.coalesce("text", F.lit(""))
    found = F.concat(*[_hits(F.col("text"), n) for n in range(len(KINDS))])
    return landed(
        documents.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            code_point_key(repository).alias("repository"),
            text.alias("text"),
        ).select("row", "doc_id", "repository", F.sha2("text", 256).alias("owner"), found.alias("hits")),
        "candidates",
    )


def spans(found: DataFrame) -> DataFrame:
    """All spans of `candidates()`: `row, doc_id, owner, kind, start, end, value_hash,
    repositories, owners, live`. Positions are code points, `end` is exclusive."""
    each = found.filter(F.size("hits") > 0).select(
        "row", "doc_id", "repository", "owner", F.posexplode("hits").alias("at", "h")
    ).select("row", "doc_id", "repository", "owner", "at", "h.*")
    in_kind = Window.partitionBy("row", "kind").orderBy("at")
    upto = in_kind.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.coalesce(F.length("hit"), F.lit(0))
    placed = (
        each.withColumn("end", F.sum(F.col("gap") + length).over(upto))
        .withColumn("start", F.col("end") - length)
        .filter(F.col("hit").isNotNull())
    )
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    varied = F.size(F.array_distinct(F.split("value", ""))) >= DISTINCT_CHARS
    opaque = F.col("kind") == len(BASE)
    kept = placed.filter((F.length("value") >= least) & (~opaque | varied))

    # Opaque strings that touch a base span are not spans of their own.
    in_row = Window.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(~opaque, F.col("end"))).over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(~opaque, F.col("start"))).over(in_row.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))
    kept = (
        kept.withColumns({"before": before, "after": after})
        .filter(~opaque | clear)
        .withColumn("value_hash", F.sha2("value", 256))
        .select("row", "doc_id", "repository", "owner", "kind", "start", "end", "value_hash")
    )
    kept = landed(kept, "spans")
    # Counts in two steps: rows of one value and text are first merged. A text that several repositories hold counts
    # for the first of them.
    held = (
        kept.groupBy("value_hash", "owner").agg(F.min("repository").alias("repository"))
        .groupBy("value_hash")
        .agg(F.count_distinct("repository").alias("repositories"), F.count(F.lit(1)).alias("owners"))
    )
    live = (F.col("owners") < EXAMPLE_OWNERS) & (F.col("repositories") < EXAMPLE_REPOSITORIES)
    return kept.join(held, "value_hash").withColumn("live", live).drop("repository")


def _joined(spans_column: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans_column, one), ",")


def span_report(documents: DataFrame) -> DataFrame:
    """Per document its number of spans of each base kind, the digest of those, and all spans by start, then kind.

    `verdicts` says of each of `spans`, in the same order, whether its value is `live` or an `example`; `n_live` and
    `n_example` count them.
    """
    found = candidates(documents)
    listed = spans(found).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("all")
    )
    base = F.filter("all", lambda s: s["kind"] < len(BASE))
    count = lambda n: F.size(F.filter("all", lambda s: s["kind"] == n)).cast("long")
    return (
        found.select("row", "doc_id")
        .join(listed, "row", "left")
        .withColumn("all", F.coalesce("all", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean>>")))
        .select(
            "doc_id",
            *[count(n).alias(f"n_{kind[0]}") for n, kind in enumerate(BASE)],
            F.sha2(_joined(base), 256).alias("base_sha256"),
            _joined(F.col("all")).alias("spans"),
            F.size(F.filter("all", lambda s: s["live"])).cast("long").alias("n_live"),
            F.size(F.filter("all", lambda s: ~s["live"])).cast("long").alias("n_example"),
            F.array_join(F.transform("all", lambda s: F.when(s["live"], "live").otherwise("example")), ",").alias("verdicts"),
        )
    )


def masked(documents: DataFrame) -> DataFrame:
    """`documents` with base spans and live-looking opaque ones replaced: live-looking ones by `[SECRET]`, examples
    by `[EXAMPLE]`. Opaque strings that are widely copied stay. `n_chars` follows the text; all other columns and all rows stay."""
    listed = (
        spans(candidates(documents))
        .filter((F.col("kind") < len(BASE)) | F.col("live"))
        .select("doc_id", "owner", F.struct("start", "end", "live").alias("span"))
        .distinct()
        .groupBy("doc_id", "owner")
        .agg(F.array_sort(F.collect_list("span")).alias("_spans"))
        .select(code_point_key("doc_id").alias("_id"), F.col("owner").alias("_owner"), "_spans")
    )
    text = F.coalesce("text", F.lit(""))
    mask = lambda s: F.when(s["live"], F.lit(MASKS[True])).otherwise(F.lit(MASKS[False]))
    cut = F.aggregate(
        "_spans",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    acc["out"],
                    F.substr(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")),
                    F.when(s["start"] >= acc["at"], mask(s)).otherwise(F.lit("")),
                ).alias("out"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substr(F.col("text"), (acc["at"] + 1).cast("int"))),
    )
    changed = (
        documents.withColumns({"_id": code_point_key("doc_id"), "_owner": F.sha2(text, 256)})
        .join(listed, ["_id", "_owner"], "left")
        .withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut))
    )
    if "n_chars" in documents.columns:
        changed = changed.withColumn(
            "n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
        )
    return changed.select(*documents.columns)
