"""Secret scan with multipart credential linking (operator 2).

Strong parts (an assignment to a password-like name, an access key id, a long
hexadecimal string) are always reported.  Weak parts alone say nothing:

    secret    a token of 20 characters or more with capitals, small letters and digits
    login     an assignment to a user- or account-like name
    endpoint  a URL, or a host with a port

They are reported only where complementary parts stand in their scope: a secret
next to an identifier (access key id or login) or an endpoint, a login next to a
secret of any kind, an endpoint next to both.  A part's scope reaches REACH
characters to either side, and BLOCK_REACH within its block (no blank line
between).  Of parts that overlap only one counts: a strong one before an
endpoint, that before a login, that before a weak secret.

The interval join asks every part for the nearest parts of each role before and
after it, in the text and in the block; these are windows over the text's
parts in order, so no pairs are made.  ``links`` reports for every secret of
either kind the nearest identifier and endpoint in its scope.

Defined results: null text is empty and has no spans (hash of the empty
string); repeated rows each give a row; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentscope.llm.spans import Kind, digests, located, placed
from rentscope.llm.tables import kept, table

REACH = 200
BLOCK_REACH = 2000
BLANK_LINE = r"\n[\x20\t\r]*\n"
_SIGN = "(contains(_text, ':') OR contains(_text, '='))"
_ASSIGNED = r"""["']?\x20*[:=]\x20*["']?"""
_SECRET_NAME = r"(?i:password|passwd|secret|token|api_?key)"
_LOGIN_NAME = r"(?i:user(?:_?name)?|login|account|client_?id|access_?key_?id)"
_VALUE = r"[A-Za-z0-9+/_.=-]"
_ASSIGN = f"{_SECRET_NAME}{_ASSIGNED}({_VALUE}+)"
_TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"


def _sql(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


STRONG = [
    Kind("assign", f"{_SIGN} AND _text RLIKE {_sql(_SECRET_NAME + _ASSIGNED)}", _ASSIGN,
         f"char_length(regexp_extract(m, {_sql(_ASSIGN)}, 1)) >= 8"),
    Kind("access", "contains(_text, 'AKIA')", "AKIA[A-Z0-9]{12,}+"),
    Kind("hex", "_text RLIKE '[0-9a-f]{32}'", "[0-9a-f]{32,}+"),
]
WEAK = [
    Kind("secret", f"_text RLIKE {_sql(_TOKEN)}", _TOKEN,
         "m RLIKE '[A-Z]' AND m RLIKE '[a-z]' AND m RLIKE '[0-9]'"),
    Kind("login", f"{_SIGN} AND _text RLIKE {_sql(_LOGIN_NAME + _ASSIGNED)}",
         f"{_LOGIN_NAME}{_ASSIGNED}[A-Za-z0-9._@-]{{3,}}+"),
    Kind("endpoint", "contains(_text, ':')",
         r"\b[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]++|\b[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}:[0-9]{2,5}\b"),
]
KINDS = [*STRONG, *WEAK]
BASE = [k.name for k in STRONG]
ROLES = {"identifier": ["access", "login"], "secret": ["assign", "hex", "secret"], "endpoint": ["endpoint"]}


# of parts that overlap, the kinds of an earlier row count
PRECEDENCE = [BASE, ["endpoint"], ["login"]]


def _around(*of: str) -> tuple[Window, Window]:
    """The rows before and after one, among those of equal columns ``of``."""
    w = Window.partitionBy("doc_id", "text_hash", *of).orderBy("start", "end", "kind")
    return w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)


def _overlaps(of: Column) -> Column:
    """Whether a part for which ``of`` holds overlaps."""
    before, after = _around()
    return (F.coalesce(F.max(F.when(of, F.col("end"))).over(before) > F.col("start"), F.lit(False))
            | F.coalesce(F.min(F.when(of, F.col("start"))).over(after) < F.col("end"), F.lit(False)))


def nearest(role: str, reach: int = REACH, block_reach: int = BLOCK_REACH) -> Column:
    """The nearest part of a role in scope, as (distance, start, end, kind) (the
    earlier of equals); null where none is."""
    found = []
    for of_block, far in (([], reach), (["block"], block_reach)):
        before, after = _around(*of_block)
        of = F.col("kind").isin(ROLES[role]) & ~F.col("shared")
        last = F.max(F.when(of, F.struct("end", "start", "kind"))).over(before)
        next_ = F.min(F.when(of, F.struct("start", "end", "kind"))).over(after)
        for part, distance in ((last, F.col("start") - last["end"]), (next_, next_["start"] - F.col("end"))):
            found.append(F.when(distance <= far, F.struct(
                distance.alias("distance"), part["start"].alias("start"), part["end"].alias("end"), part["kind"].alias("kind"))))
    return F.least(*found)


def parts(hits: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, m, identifier, secret, endpoint,
    reported): every part that counts, and what is nearest to it."""
    rows = placed(hits, KINDS)
    for i, kinds in enumerate(PRECEDENCE):
        above = F.col("kind").isin([k for ks in PRECEDENCE[:i + 1] for k in ks])
        rows = rows.withColumn("gone", ~above & _overlaps(F.col("kind").isin(kinds))).filter("NOT gone")
    strong = F.col("kind").isin(BASE)
    # strong parts may overlap each other: an identifier inside a secret is the same thing
    rows = rows.withColumn("shared", F.col("kind").isin(ROLES["identifier"]) & _overlaps(F.col("kind").isin(ROLES["secret"])))
    seen = rows.select("*", *(nearest(role).alias(role) for role in ROLES))
    there = {role: F.col(role).isNotNull() for role in ROLES}
    linked = ((F.col("kind") == "secret") & (there["identifier"] | there["endpoint"])
              | (F.col("kind") == "login") & there["secret"]
              | (F.col("kind") == "endpoint") & there["identifier"] & there["secret"])
    return seen.withColumn("reported", strong | linked).select(
        "doc_id", "text_hash", "kind", "start", "end", "m", *ROLES, "reported")


def links(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, links): the secrets with the identifier and the
    endpoint that are nearest, ``kind:start:end>kind:start:end>kind:start:end``
    with ``-`` for one that is missing, comma-joined in order."""
    def named(kind: Column, start: Column, end: Column) -> Column:
        return F.concat_ws(":", kind, start.cast("string"), end.cast("string"))
    secrets = found.filter(F.col("kind").isin(ROLES["secret"]) & F.col("reported")
                           & (F.col("identifier").isNotNull() | F.col("endpoint").isNotNull()))
    others = [F.coalesce(F.when(F.col(role).isNotNull(), named(F.col(role)["kind"], F.col(role)["start"], F.col(role)["end"])),
                         F.lit("-")) for role in ("identifier", "endpoint")]
    one = F.concat_ws(">", named(F.col("kind"), F.col("start"), F.col("end")), *others)
    return secrets.groupBy("doc_id", "text_hash").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("start", "end", one.alias("link")))), lambda x: x["link"]), ",").alias("links"))


def credentials(hits: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, m) of all that is reported."""
    return parts(hits).filter("reported").select("doc_id", "text_hash", "kind", "start", "end", "m")


def scan(df: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(row per document, row per reported span)."""
    hits = located(df, KINDS, text, key, "secret-parts", BLANK_LINE)
    return hits, credentials(hits)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = located(table(spark, sf_dir, "documents"), KINDS, "text", "doc_id", "secret-parts", BLANK_LINE)
    found = kept(parts(hits), "secret-links")
    reported = found.filter("reported").select("doc_id", "text_hash", "kind", "start", "end")
    own = links(found).select(F.struct("doc_id", "text_hash").alias("of"), "links")
    rows = digests(hits, reported, BASE, [k.name for k in KINDS], keep_hash=True)
    return (rows.join(own, F.struct("doc_id", "text_hash").eqNullSafe(F.col("of")), "left")
            .withColumn("links", F.coalesce("links", F.lit(""))).drop("of", "text_hash"))
