"""Quality rules with risk-controlled thresholds (operator 7).

Per text, by DataFrame functions only: words, letters in words, sign
characters, repeated lines, words in repeated 5-word windows, capitals.  A text
fails the base if it has under MIN_WORDS words or too many repeated ones.

On top of the base, RULES compare a measure with cutoffs, from a mild one to a
strict one.  Per stratum (language) the rules make one row of settings: the
first rule is tightened cutoff by cutoff, then the second in addition, and so on;
a document has the step of that row at which it is first rejected.  The rules'
order comes from the bad labelled documents (quality 0) of the stratum alone: the
rule that can reject the most of them goes first.

A false rejection is a document of quality 1 that a setting rejects.  Step by step
the exact binomial test asks whether the true share of false rejections may
exceed RISK: the p-value of k rejections among n good documents is
P(Bin(n, RISK) <= k), i.e. the setting passes when the Clopper-Pearson bound lies
below RISK.  Multiple testing: the steps of a stratum are a fixed sequence, which
ends at the first that does not pass and needs no correction (the good documents
had no part in its order); ERROR is divided by the number of strata
(Bonferroni).  With a probability of 1 - ERROR no stratum therefore loses more
than RISK of its good documents beyond the base, by all rules together.  Among
passing steps the one with the largest gain (bad documents rejected, less PRICE
times good ones) is taken, the mildest of equals, and none if no gain is
positive.  A stratum with too few labels for a proof (under about 220 good ones
for four strata) keeps all that the base keeps.

Defined results: null text has no words (and fails the base); a document
labelled twice counts with its worst label; labels of unknown documents are
ignored; null languages are one stratum; repeated rows are judged alike; an
empty table gives no rows, an empty label table only base decisions; other
columns are carried by ``keep_good``.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentscope.llm.tables import WORD_SPACE, kept, table, text_or_empty, whole_row

WINDOW_WORDS = 5
MIN_WORDS, REPEAT_PERCENT = 10, 20
RISK, ERROR, PRICE = 0.02, 0.05, 10
# rule -> (measure, cutoffs from the mildest on); a measure above the cutoff rejects
RULES = {
    "signs": ("n_symbols / greatest(word_chars, 1)",
              [0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03]),
    "lines": ("n_dup_lines / greatest(n_lines, 1)",
              [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", [0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06, 0.04]),
    "capitals": ("n_capitals / greatest(word_chars, 1)",
                 [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15]),
    "word_length": ("word_chars / greatest(n_words, 1)", [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0]),
    "brevity": ("1 / greatest(n_words, 1)", [1 / n for n in (11, 12, 13, 14, 16, 18, 20, 22, 25, 28, 32, 36, 40, 50)]),
}


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns, and the measures of every text."""
    words = F.filter(F.split("_text", f"[{WORD_SPACE}]+"), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{WORD_SPACE}]"))
    none = F.array().cast("array<bigint>")
    windows = F.when(F.size("_words") < WINDOW_WORDS, none).otherwise(F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW_WORDS),
        lambda i: F.xxhash64(*(F.col("_hashes")[i + k] for k in range(WINDOW_WORDS)))))
    # only texts with equal windows sort them: places of windows that are found twice
    placed = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    twin = F.filter("_placed", lambda x, j: ((j > 0) & (F.col("_placed")[F.greatest(j - 1, F.lit(0))]["h"] == x["h"]))
                    | ((j < F.size("_placed") - 1)
                       & (F.col("_placed")[F.least(j + 1, F.size("_placed") - 1)]["h"] == x["h"])))
    covered = F.aggregate(
        F.sort_array(F.transform("_twin", lambda x: x["i"])),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + (p + WINDOW_WORDS - F.greatest(p, acc["end"]))).alias("n"),
                                (p + WINDOW_WORDS).alias("end")), lambda acc: acc["n"])
    return (df.withColumn("_text", text_or_empty(text))
            .withColumn("_words", words)
            .withColumn("_lines", lines)
            .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
            .withColumn("_windows", windows)
            .withColumn("_placed", placed)
            .withColumn("_twin", twin)
            .withColumns({
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
                "n_symbols": F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
                "n_capitals": F.char_length(F.regexp_replace("_text", "[^A-Z]+", "")).cast("long"),
            })
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
            .drop("_text", "_words", "_lines", "_hashes", "_windows", "_placed", "_twin"))


def p_value(k: Column, n: Column, share: float) -> Column:
    """P(Bin(n, share) <= k), summed exactly in logarithms; 1 from the mean on."""
    odds = log(share) - log(1 - share)
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        F.struct(F.lit(0.0).alias("p"), (n * log(1 - share)).alias("next")),
        lambda acc, i: F.struct((acc["p"] + F.exp(acc["next"])).alias("p"),
                                (acc["next"] + F.ln(F.greatest(n - i, F.lit(1))) - F.ln(i + 1) + odds).alias("next")),
        lambda acc: acc["p"])
    return F.when(k >= n * share, F.lit(1.0)).otherwise(total)


def first_cutoff(name: str) -> Column:
    """Number of the mildest cutoff of a rule that rejects; null where none does."""
    measure, grid = RULES[name]
    out = F.when(F.expr(measure) > grid[0], 0)
    for i, cutoff in enumerate(grid[1:], 1):
        out = out.when(F.expr(measure) > cutoff, i)
    return out


def step() -> Column:
    """The step at which a row is first rejected, where its stratum's order
    (``from_`` columns) and its cutoffs are known; null if never."""
    return F.least(*(F.col(f"from_{name}") + first_cutoff(name) for name in RULES))


def settings(measured: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang",
             risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, the rules' places in its order, the certified step): a row for
    every stratum with one."""
    truth = labels.groupBy(F.col(key)).agg(F.min("quality").alias("good"))
    judged = kept(measured.filter(~F.col("base_failed")).join(truth, key).filter("good IN (0, 1)").select(
        F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), "good",
        *dict.fromkeys(c for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                                   "n_capitals"))), "judged")
    caught = (judged.filter("good = 0").groupBy("stratum").agg(F.array(*(
        F.struct(F.count(first_cutoff(name)).alias("caught"), F.lit(i).alias("nth"), F.lit(name).alias("rule"),
                 F.lit(len(RULES[name][1])).alias("steps")) for i, name in enumerate(RULES))).alias("rules"))
        .select("stratum", F.explode("rules").alias("r")).select("stratum", "r.*"))
    earlier = (Window.partitionBy("stratum").orderBy(F.desc("caught"), "nth")
               .rowsBetween(Window.unboundedPreceding, -1))
    order = (caught.withColumn("begin", F.coalesce(F.sum("steps").over(earlier), F.lit(0))).groupBy("stratum").agg(
        *(F.max(F.when(F.col("rule") == name, F.col("begin"))).alias(f"from_{name}") for name in RULES)))
    order = kept(order, "rule-order")
    n = judged.groupBy("stratum").agg(F.sum("good").alias("n"))
    strata = max(1, n.count())
    so_far = Window.partitionBy("stratum").orderBy("step")
    tests = (judged.join(order, "stratum").withColumn("step", step()).filter("step IS NOT NULL")
             .groupBy("stratum", "step").agg(F.count_if(F.col("good") == 0).alias("bad"), F.sum("good").alias("good"))
             .withColumns({"bad": F.sum("bad").over(so_far), "good": F.sum("good").over(so_far)}).join(n, "stratum"))
    tests = (tests.withColumn("passed", p_value(F.col("good"), F.col("n"), risk) <= error / strata)
             .withColumn("all_passed", F.min("passed").over(so_far))
             .withColumn("gain", F.col("bad") - PRICE * F.col("good")))
    best = (tests.filter("all_passed AND gain > 0").groupBy("stratum")
            .agg(F.max(F.struct("gain", (-F.col("step")).alias("milder"))).alias("best"))
            .select("stratum", (-F.col("best.milder")).alias("limit")))
    return order.join(best, "stratum")


def verdict(measured: DataFrame, certified: DataFrame) -> DataFrame:
    """``kept`` of every row with measures, by the certified settings, and
    whether its stratum has one."""
    return (measured.withColumn("stratum", F.coalesce(F.col("lang"), F.lit("")))
            .join(certified, "stratum", "left").withColumn("kept", ~(
                F.col("base_failed") | F.coalesce(step() <= F.col("limit"), F.lit(False))))
            .withColumn("certified", F.col("limit").isNotNull())
            .drop("stratum", "limit", *(f"from_{n}" for n in RULES)))


def learnt(df: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Measures of (doc_id, text, lang) rows and the certified settings; texts
    are not written.  The settings are a row per language that has one, which
    the planner broadcasts by its size."""
    measured = kept(features(df.select("doc_id", "text", "lang")).drop("text"), "measures")
    return measured, kept(settings(measured, labels), "settings")


def judged(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The measures, ``base_failed``, ``kept`` and ``certified`` of (doc_id, text, lang) rows."""
    return verdict(*learnt(df, labels))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "certified")


def keep_good(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of the rows that are kept.  The rows are measured twice,
    once to learn and once to filter, so that no text is written or shuffled
    between.  The optimizer would copy the measures' expressions into the filter,
    where each text is split and hashed again for every window; a filter does not
    pass a projection with a row number, so it reads the measures as they are."""
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"),
                     (F.col("lang") if "lang" in df.columns else F.lit("")).alias("lang"), whole_row(df).alias("row"))
    _, certified = learnt(rows, labels)
    measured = features(rows).withColumn("number", F.monotonically_increasing_id())
    return verdict(measured, certified).filter("kept AND number >= 0").select("row.*")


def oracle() -> str:
    """The query in DuckDB's SQL."""
    n = WINDOW_WORDS

    def first(name: str) -> str:
        measure, grid = RULES[name]
        return "CASE " + " ".join(f"WHEN {measure.replace('1 /', '1.0 /')} > {float(c)!r}::DOUBLE THEN {i}"
                                  for i, c in enumerate(grid)) + " END"
    cuts = "\nUNION ALL ".join(
        f"SELECT r, doc_id, stratum, base_failed, {i} AS nth, {len(grid)} AS steps, {first(name)} AS cut FROM b"
        for i, (name, (_, grid)) in enumerate(RULES.items()))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
pos AS (SELECT r, unnest(range(1, len(w) - {n} + 2)) AS i, w FROM w WHERE len(w) >= {n}),
win AS (SELECT r, i, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM pos),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win),
cov AS (SELECT r, sum(least({n}, coalesce(nx - i, {n}))) AS n_repeat_words FROM (
        SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM twice WHERE c > 1) GROUP BY r),
m AS (SELECT w.r, doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
      (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
      length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_capitals FROM w LEFT JOIN cov ON w.r = cov.r),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM m),
cuts AS ({cuts}),
judged AS (SELECT cuts.*, q FROM cuts JOIN (SELECT doc_id, min(quality) AS q FROM labels GROUP BY 1) USING (doc_id)
           WHERE NOT base_failed AND q IN (0, 1)),
caught AS (SELECT stratum, nth, steps, count(cut) AS c FROM judged WHERE q = 0 GROUP BY ALL),
begins AS (SELECT stratum, nth, coalesce(sum(steps) OVER (PARTITION BY stratum ORDER BY c DESC, nth
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins_at FROM caught),
step AS (SELECT r, min(begins_at + cut) AS step FROM cuts JOIN begins USING (stratum, nth) GROUP BY r),
goods AS (SELECT stratum, count(DISTINCT r) FILTER (WHERE q = 1) AS n FROM judged GROUP BY stratum),
seen AS (SELECT stratum, step, count_if(q = 0) AS bad, count_if(q = 1) AS good FROM judged JOIN step USING (r)
         WHERE nth = 0 AND step IS NOT NULL GROUP BY ALL),
sums AS (SELECT stratum, step, n, sum(bad) OVER w AS bad, sum(good) OVER w AS good FROM seen JOIN goods USING (stratum)
         WINDOW w AS (PARTITION BY stratum ORDER BY step)),
p AS (SELECT *, CASE WHEN good >= n * {RISK!r}::DOUBLE THEN 1.0 ELSE list_sum(list_transform(
        range(0, good::BIGINT + 1), lambda k: exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
              + k * ln({RISK!r}::DOUBLE) + (n - k) * ln(1 - {RISK!r}::DOUBLE)))) END AS p FROM sums),
passed AS (SELECT *, bool_and(p <= {ERROR!r}::DOUBLE / (SELECT count(*) FROM goods))
           OVER (PARTITION BY stratum ORDER BY step) AS ok FROM p),
best AS (SELECT stratum, arg_max(step, (bad - {PRICE} * good) * 1000 - step) AS top FROM passed
         WHERE ok AND bad > {PRICE} * good GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR coalesce(step <= top, false)) AS kept, top IS NOT NULL AS certified
FROM b LEFT JOIN step USING (r) LEFT JOIN best USING (stratum)"""
