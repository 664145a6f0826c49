"""Personal data by candidate gradient boosting (operator 10).

Generators with high recall propose overlapping spans: strict forms (e-mail,
IPv4, card, phone; the base, always redacted when valid) and loose ones
(spelled-out addresses, digit groups, IPv6, account-like codes).  Every
candidate gets format features (length, digits, separators, groups, ...) and
context features (what stands before and after).  Boosted trees learn on the
corpus itself what valid personal data looks like, by weak labels of each kind:

    base      matches that pass their check digit, range or length
    number    digit groups that overlap a valid phone or card, or 7 to 15
              digits right after a word like tel or call
    spelled   "at" or "dot" unmistakably spelled out, before a known top level
    ipv6      eight groups
    code      IBANs by their remainder of 97

All other candidates are negatives, except loose ones that overlap a valid base
span and are not labelled by it (left out).  Check results, and the '+' before
a number, are no features, so the trees generalise from format and context.

All candidates fit the trees and all are judged: they fall into two halves by
hash, each half fits trees of its own, and a candidate is scored by the trees
that have not seen it.  Equal candidates fit as one row of that weight; a kind
and label with more than EVEN weighs EVEN in all, so that the frequent ones do
not drown the rest.  The trees read each feature as signs "at least this much";
the borders are all its values, or BINS groups of equal weight, by counts over
all candidates (Spark's own borders would come from a sample).  Only candidates
outside the base spans are judged, since only they can be added: per kind the
smallest score is chosen from which on the lower confidence bound (95 %) of the
share of positives is at least PRECISION.  A kind with fewer of them than
SUPPORT takes the threshold chosen in the same way over all kinds.  A kind
without such a score, or without any positive outside the base (a number that
fails its check has nothing else for it), adds nothing.  The labels are weak, so
this is precision against the labels' rules; the README gives the figures by
kind.

Defined results: null text is empty and has no spans; repeated rows each give
a row; an empty table gives no rows; fewer than LEAST candidates of either
class: no trees, the base alone; other columns pass through ``redacted``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentscope.llm.spans import Kind, digests, located, placed
from rentscope.llm.tables import kept, table, text_or_empty, whole_row

LEAST = 40
EVEN, BINS = 600, 32
PRECISION, SUPPORT = 0.9, 20
CONFIDENCE = 1.645  # normal quantile: one-sided 95 %
TREES, DEPTH, SEED = 10, 3, 11

_LOCAL = "[A-Za-z0-9._%+-]"
_DIGIT_GROUPS = r"[0-9](?:[\x20-]?[0-9]){13}"
_AT = r"(?:\x20?[(\[]at[)\]]|\x20{1,2}at\x20)\x20?[A-Za-z0-9-]{1,63}"
# after a full stop and a space a capitalised word begins a sentence
_DOT = (r"(?:(?:\x20?[(\[]dot[)\]]|\x20{1,2}dot\x20)\x20?[A-Za-z]{2,63}"
        r"|\x20?\.(?:[A-Za-z]|\x20(?-i:[a-z]|[A-Z](?=[A-Z])))[A-Za-z]{1,62})")
BASE_KINDS = [
    Kind("email", "contains(_text, '@')",
         rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    Kind("ip", r"_text RLIKE r'[0-9]\.[0-9]++\.[0-9]++\.[0-9]'", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    Kind("card", f"_text RLIKE r'{_DIGIT_GROUPS}'", r"[0-9](?:[\x20-]?[0-9])++"),
    Kind("phone", "contains(_text, '+')", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
LOOSE_KINDS = [
    Kind("spelled", f"_text RLIKE r'(?i){_AT}{_DOT}'",
         rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{_AT}(?:{_DOT}){{1,4}}"),
    Kind("number", r"_text RLIKE r'[0-9](?:[\x20().-]{0,2}[0-9]){6}'", r"(?<![0-9])[0-9](?:[\x20().-]{0,2}[0-9]){6,}+"),
    Kind("ipv6", "contains(_text, ':') AND _text RLIKE r'(?:[0-9A-Fa-f]{1,4}:){3}'",
         r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    Kind("code", r"_text RLIKE r'\b[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}'", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b"),
]
KINDS = [*BASE_KINDS, *LOOSE_KINDS]
BASE = [k.name for k in BASE_KINDS]
# what the trees select: a match of a base form that failed its check is "like" it
ORDER = [*BASE, *(k.name for k in LOOSE_KINDS), *(f"{k}_like" for k in BASE)]
_DIGITS = "regexp_replace(m, '[^0-9]', '')"
VALID = {
    "email": "true",
    "ip": r"forall(split(m, r'\.'), p -> char_length(ltrim('0', p)) <= 3 AND "
          r"coalesce(try_cast(nullif(ltrim('0', p), '') AS int), 0) <= 255)",
    "card": f"char_length({_DIGITS}) BETWEEN 14 AND 19 AND luhn_check({_DIGITS})",
    "phone": f"char_length({_DIGITS}) BETWEEN 10 AND 15",
}
_IBAN = "regexp_replace(m, r'\x20', '')"
WEAK = {
    "number": f"near_phone OR near_card OR (char_length({_DIGITS}) BETWEEN 7 AND 15 AND "
              r"before RLIKE r'(?i)\b(?:tel|telephone|phone|call|fax|mobile?|whatsapp)\b[^0-9]{0,12}$')",
    "spelled": r"m RLIKE r'(?i)[(\[](?:at|dot)[)\]]|\x20dot\x20' AND m RLIKE r'(?i)[^A-Za-z]"
               r"(?:com|org|net|edu|gov|mil|int|info|biz|name|pro|dev|app|[a-z]{2})$'",
    "ipv6": "size(split(m, ':')) = 8",
    "code": f"char_length({_IBAN}) BETWEEN 15 AND 34 AND aggregate(filter(split(concat(substr({_IBAN}, 5), "
            f"left({_IBAN}, 4)), ''), c -> c != ''), 0, (a, c) -> (a * if(c >= 'A', 100, 10) + "
            "if(c >= 'A', ascii(c) - 55, coalesce(try_cast(c AS int), 0))) % 97) = 1",
}
FEATURES = {
    "length": "least(char_length(m), 200)",
    "digits": "least(char_length(regexp_replace(m, '[^0-9]', '')), 60)",
    "letters": "least(char_length(regexp_replace(m, '[^A-Za-z]', '')), 100)",
    "capitals": "least(char_length(regexp_replace(m, '[^A-Z]', '')), 60)",
    "dots": "least(char_length(regexp_replace(m, '[^.]', '')), 20)",
    "dashes": "least(char_length(regexp_replace(m, '[^-]', '')), 20)",
    "spaces": r"least(char_length(regexp_replace(m, '[^\x20]', '')), 20)",
    "brackets": r"least(char_length(regexp_replace(m, r'[^()\[\]]', '')), 10)",
    "colons": "least(char_length(regexp_replace(m, '[^:]', '')), 10)",
    "plus": "int(m LIKE '+%')",
    "at": "int(contains(m, '@'))",
    "groups": "least(size(split(m, '[^A-Za-z0-9]+')), 30)",
    "first_group": "least(char_length(regexp_extract(m, '[A-Za-z0-9]+', 0)), 30)",
    "distinct_digits": "size(array_distinct(split(regexp_replace(m, '[^0-9]', ''), '')))",
    "first_digit": "coalesce(try_cast(regexp_extract(m, '[0-9]', 0) AS int), -1)",
    "space_before": r"int(before = '' OR before RLIKE r'[\x20\n\t]$')",
    "letter_before": "int(before RLIKE '[A-Za-z]$')",
    "sign_before": r"int(before RLIKE r'[#$=/_]$')",
    "space_after": r"int(after = '' OR after RLIKE r'^[\x20\n\t]')",
    "letter_after": "int(after RLIKE '^[A-Za-z]')",
    "stop_after": "int(after RLIKE '^[.,;:!?]')",
    "calls_before": "int(before RLIKE '(?i)tel|phone|call|fax|mobil|whatsapp')",
    "mails_before": "int(before RLIKE '(?i)mail|contact|write to')",
    "cards_before": "int(before RLIKE '(?i)card|visa|credit|iban|account|konto|cuenta')",
    "counts_before": r"int(before RLIKE r'(?i)no\.|nr\.|id|version|order|isbn|page|\$|eur')",
}


def candidates(df: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(row per document, row per candidate with features, ``base``, ``inside``
    and ``positive``); both are written once."""
    hits = located(df, KINDS, text, key, "pii-hits")
    valid = F.lit(False)
    for kind, rule in VALID.items():
        valid = valid | ((F.col("kind") == kind) & F.expr(rule))
    rows = placed(hits, KINDS).withColumn("base", valid)
    # whether a valid base span overlaps: the farthest end before, the nearest start after
    w = Window.partitionBy("doc_id", "text_hash").orderBy("start", F.desc("end"), "kind")

    def overlaps(span: Column) -> Column:
        before = F.max(F.when(span, F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
        after = F.min(F.when(span, F.col("start"))).over(w.rowsBetween(1, Window.unboundedFollowing))
        return F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))
    rows = rows.select("*", overlaps(F.col("base")).alias("inside"),
                       *(overlaps(F.col("base") & (F.col("kind") == k)).alias(f"near_{k}") for k in ("phone", "card")))
    positive = F.col("base")
    for kind, rule in WEAK.items():
        positive = positive | ((F.col("kind") == kind) & F.expr(rule))
    rows = rows.withColumn("positive", positive).withColumn("before", F.when(
        F.col("kind") == "number", F.regexp_replace("before", r"\+[\x20().-]*$", "")).otherwise(F.col("before")))
    return hits, kept(rows.select("doc_id", "text_hash", "kind", "start", "end", "base", "inside", "positive",
                                  *(F.expr(e).cast("double").alias(n) for n, e in FEATURES.items())), "pii-candidates")


def thresholds(held: DataFrame, *by: str) -> DataFrame:
    """Per group the smallest score from which on the lower bound of the share
    of positives reaches PRECISION (Wilson's, of the effective number)."""
    what = {"w": F.col("_weight"), "w2": F.col("_weight") * F.col("_weight"), "good": F.col("label") * F.col("_weight")}
    sums = held.groupBy(*by, "score").agg(*(F.sum(x).alias(c) for c, x in what.items()))
    # ranges of scores add up on their own; a row per range and group says what stands above it
    rows = kept(sums.repartitionByRange(*by, F.desc("score")).withColumn("part", F.spark_partition_id()), "pii-scores")
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (rows.groupBy(*by, "part").agg(*(F.sum(c).alias(c) for c in what))
             .select(*by, "part", *(F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(f"{c}_ahead") for c in what)))
    down = Window.partitionBy(*by, "part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    total, squares, good = (F.sum(c).over(down) + F.col(f"{c}_ahead") for c in what)
    p, n = F.col("p"), F.col("n")
    z2 = CONFIDENCE * CONFIDENCE
    bound = (p + z2 / (2 * n) - CONFIDENCE * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    return (rows.join(F.broadcast(ahead), [*by, "part"]).withColumns({"n": total * total / squares, "p": good / total})
            .filter(bound >= PRECISION).groupBy(*by).agg(F.min("score").alias("least")))


def borders(known: DataFrame, weights: dict) -> list[list[float]]:
    """Per feature the values at which its groups begin, but for the first."""
    # whole numbers up to their caps: some hundred rows for each kind and label
    seen = (known.select("kind", "label", F.posexplode(F.array(*FEATURES)).alias("nth", "value"))
            .groupBy("kind", "label", "nth", "value").count().collect())
    of = [{} for _ in FEATURES]
    for r in sorted(seen):
        of[r["nth"]][r["value"]] = of[r["nth"]].get(r["value"], 0) + r["count"] * weights[r["kind"], r["label"]]
    found = []
    for values in of:
        at, done, total = [], 0, sum(values.values())
        for v in sorted(values):
            if len(values) <= BINS or done * BINS >= (len(at) + 1) * total:
                at.append(v)
            done += values[v]
        found.append(at[1:] if len(values) <= BINS else at)
    return found


def selected(rows: DataFrame) -> DataFrame:
    """The base, and the candidates that the calibrated trees select."""
    chosen = rows.filter("base").select("doc_id", "text_hash", "kind", "start", "end")
    rows = (rows.withColumn("label", F.col("positive").cast("double"))
            .withColumn("half", F.pmod(F.xxhash64("doc_id", "text_hash", "start", "kind"), F.lit(2))))
    known = rows.filter("base OR NOT inside OR (kind = 'number' AND positive)")
    # a row for each kind and label
    number = {(r["kind"], r["label"]): r["count"] for r in known.groupBy("kind", "label").count().collect()}
    total = {label: sum(n for (_, x), n in number.items() if x == label) for label in (0.0, 1.0)}
    if min(total.values()) < LEAST:
        return chosen
    weights = {k: min(n, EVEN) / n for k, n in number.items()}
    at = borders(known, weights)
    bins = F.array(*(F.expr(" ".join(["CASE", *(f"WHEN {c} < {v} THEN {i}" for i, v in enumerate(found)), f"ELSE {len(found)} END"])
                            if found else "0") for c, found in zip(FEATURES, at))).alias("bins")
    signs = [f"double(bins[{i}] > {j})" for i, found in enumerate(at) for j in range(len(found))]
    if not signs:
        return chosen
    about = {"ml_attr": {"attrs": {"binary": [{"idx": i} for i in range(len(signs))]}, "num_attrs": len(signs)}}
    vector = array_to_vector(F.expr(f"array({', '.join(signs)})")).alias("features", metadata=about)
    weight = reduce(lambda c, k: F.when((F.col("kind") == k[0]) & (F.col("label") == k[1]), F.col("n") * weights[k])
                    .otherwise(c), sorted(number), F.lit(0.0))
    groups = ["half", "kind", "label", "bins"]
    fits = kept(known.select(*groups[:-1], bins).groupBy(*groups).agg(F.count("*").alias("n"))
                .sortWithinPartitions(*groups), "pii-fit")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight")
    models = [trees.fit(fits.filter(F.col("half") == h).select("label", "n", weight.alias("weight"), vector)) for h in (0, 1)]

    # only what could be added is judged, by the other half's trees
    judged = rows.filter("NOT base AND NOT inside").select(*chosen.columns, "label", "half", bins)
    judged = kept(reduce(DataFrame.unionByName, (
        models[1 - h].transform(judged.filter(F.col("half") == h).select(*chosen.columns, "label", vector))
        .select(*chosen.columns, "label", vector_to_array("probability")[1].alias("score")) for h in (0, 1))), "pii-judged")
    held = judged.withColumn("_weight", F.lit(1.0))

    own = {r["kind"]: r["least"] for r in thresholds(held, "kind").collect()}  # a row per kind
    shared = thresholds(held).first()["least"]
    size = {r["kind"]: (r["n"], r["good"]) for r in
            held.groupBy("kind").agg(F.count("*").alias("n"), F.sum("label").alias("good")).collect()}
    limits = {k: own.get(k, shared if n < SUPPORT else None) for k, (n, good) in size.items() if good > 0}
    limits = {k: v for k, v in limits.items() if v is not None}
    if not limits:
        return chosen
    enough = reduce(or_, ((F.col("kind") == k) & (F.col("score") >= v) for k, v in limits.items()))
    more = judged.filter(enough)
    more = more.withColumn("kind", F.when(F.col("kind").isin(BASE), F.concat("kind", F.lit("_like"))).otherwise(F.col("kind")))
    return chosen.unionByName(more.select(*chosen.columns))


def spans(df: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(row per document, row per span to redact)."""
    hits, rows = candidates(df, text, key)
    return hits, selected(rows)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits, found = spans(table(spark, sf_dir, "documents"))
    return digests(hits, found, BASE, ORDER)


def redacted(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns, with every span replaced by its kind in brackets;
    overlapping spans become one, named after the first.  Null stays null."""
    _, found = spans(df, text, key)
    w = Window.partitionBy("doc_id", "text_hash").orderBy("start", F.desc("end"), "kind")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    merged = (found.withColumn("_new", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)))
              .withColumn("_group", F.sum("_new").over(w))
              .groupBy("doc_id", "text_hash", "_group")
              .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                   F.min_by("kind", F.struct("start", -F.col("end"), "kind")).alias("kind")))
    merged = (merged.withColumn("from", F.coalesce(F.lag("end").over(
        Window.partitionBy("doc_id", "text_hash").orderBy("start")), F.lit(0))))
    per_text = kept(merged.groupBy(F.struct("doc_id", "text_hash").alias("of")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "from", "kind"))).alias("spans")), "pii-spans")
    own = F.struct(F.col(key).alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("text_hash"))
    rows = df.select(whole_row(df).alias("row"), own.alias("own")).join(
        per_text, F.col("own").eqNullSafe(F.col("of")), "left")
    old = F.col("row")[text]
    pieces = F.transform("spans", lambda x: F.concat(
        F.substring(old, (x["from"] + 1).cast("int"), (x["start"] - x["from"]).cast("int")),
        F.lit("["), F.upper(x["kind"]), F.lit("]")))
    tail = F.substring(old, (F.element_at("spans", -1)["end"] + 1).cast("int"), F.char_length(old))
    new = F.when(F.col("spans").isNull(), old).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return rows.select(F.col("row").withField(f"`{text}`", new).alias("row")).select("row.*")
