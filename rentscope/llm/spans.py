"""Regular-expression matches of whole texts as spans, by DataFrame functions.

Per kind a text is split by the expression and its matches are taken; both
walk the text once and give the same matches, so gap and match lengths add up
to the places.  Only texts that pass a kind's cheap test are matched at all.
From there on only matches travel: one row each, placed by a running sum.
Places are code points; the end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentscope.llm.tables import kept, text_or_empty

CONTEXT = 24  # characters of the gaps that are kept on either side


@dataclass(frozen=True)
class Kind:
    name: str
    test: str      # SQL over _text: whether the text is matched at all
    pattern: str   # Java regular expression
    keep: str = "true"  # SQL over the match ``m``: whether it counts


def located(df: DataFrame, kinds: list[Kind], text: str, key: str, name: str, breaks: str | None = None) -> DataFrame:
    """(doc_id, text_hash, found): one row per row of ``df``, written once.
    ``breaks``: an expression (of what no match holds) that is counted as well."""
    def matches(kind: Kind) -> Column:
        rx = F.lit(kind.pattern)
        gaps = F.split("_text", kind.pattern, -1)
        empty = F.array().cast("array<struct<kind:string,i:int,m:string,gap:int,breaks:int,before:string,after:string>>")
        of = F.zip_with(F.regexp_extract_all("_text", rx, 0), gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g")))
        # one gap more than matches: the last pair has no match
        return F.when(F.expr(kind.test), F.filter(F.transform(of, lambda x, i: F.struct(
            F.lit(kind.name).alias("kind"), i.alias("i"), x["m"].alias("m"), F.char_length(x["g"]).alias("gap"),
            (F.regexp_count(x["g"], F.lit(breaks)) if breaks else F.lit(0)).alias("breaks"),
            F.right(x["g"], F.lit(CONTEXT)).alias("before"), F.left(x["g"], F.lit(CONTEXT)).alias("after"))),
            lambda x: x["m"].isNotNull() | (x["i"] > 0))).otherwise(empty)
    return kept(df.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("_text"))
                .select("doc_id", F.xxhash64("_text").alias("text_hash"),
                        F.concat(*map(matches, kinds)).alias("found")), name)


def placed(hits: DataFrame, kinds: list[Kind]) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, block, m, before, after) of the
    matches that count (``block``: breaks before); rows with equal id and text
    appear once."""
    rows = (hits.filter(F.size("found") > 0).dropDuplicates(["doc_id", "text_hash"])
            .select("doc_id", "text_hash", F.explode("found").alias("x")).select("doc_id", "text_hash", "x.*"))
    w = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("i")
    size = F.char_length(F.coalesce("m", F.lit("")))
    rows = (rows.withColumn("end", F.sum(F.col("gap") + size).over(w).cast("long"))
            .withColumn("start", F.col("end") - size)
            .withColumn("block", F.sum("breaks").over(w))
            .withColumn("after", F.coalesce(F.lead("after").over(w), F.lit(""))))
    counts = F.lit(False)
    for kind in kinds:
        counts = counts | ((F.col("kind") == kind.name) & F.expr(kind.keep))
    return rows.filter("m IS NOT NULL").filter(counts).select(
        "doc_id", "text_hash", "kind", "start", "end", "block", "m", "before", "after")


def rank(kinds: list[str], column: str = "kind") -> Column:
    """Place of a kind in the list."""
    return F.array_position(F.array(*map(F.lit, kinds)), F.col(column))


def digests(hits: DataFrame, spans: DataFrame, base: list[str], order: list[str],
            keep_hash: bool = False) -> DataFrame:
    """Per row of ``hits``: counts of the base kinds, hash of the base spans, all spans."""
    own = spans.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", rank(order).alias("rank"), "end", "kind"))).alias("all"))

    def joined(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    rows = hits.select("doc_id", "text_hash").join(
        own.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_hash"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    found = F.coalesce("all", F.array().cast("array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>"))

    def number(kind: str) -> Column:
        return F.size(F.filter("all", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.withColumn("all", found).select(
        "doc_id", *map(number, base),
        F.sha2(joined(F.filter("all", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("all")).alias("spans"), *(["text_hash"] if keep_hash else []))
