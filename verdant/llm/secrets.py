"""Secret scans with multipart credential linking, with DataFrame and SQL functions only.

Strong patterns report by themselves.  Weak candidates (account names, long mixed strings, service addresses) are
reported only when their complementary parts stand in the same scope: an identifier with a secret, a secret with an
identifier, an endpoint with both.  The parts of all documents are interval-joined: scopes are cut into bins of their
width, the parts of a bin and role are reduced to their first and last place, and a candidate meets its own bin and
the two beside it, so a text full of parts is never multiplied out.

Defined results: a null or empty text has no spans; repeated rows report the same spans; a null id is an id; added spans
may overlap strong ones; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.spans import SPAN, locate
from verdant.session import scratch_path

#: Code points between the starts of parts that belong together, at most.
SCOPE = 400

_ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
_NAMED = "[\"']?\\x20*[:=]\\x20*[\"']?"


def _mixed(text: Column) -> Column:
    return text.rlike("[A-Z]") & text.rlike("[a-z]") & text.rlike("[0-9]")


#: Name: (pattern, test of the match).  A run that is too short at its first place is too short at every later one.
STRONG = {
    "assign": (_ASSIGN, lambda x: F.length(F.regexp_extract(x, _ASSIGN, 2)) >= 6),
    "access": ("AKIA[A-Z0-9]{16,}+", None),
    "hex": ("[0-9a-f]{24,}+", None),
}
WEAK = {
    "name": (f"(?i)(?:access_?key_?id|client_?id|app_?id|user_?name|login|account){_NAMED}[A-Za-z0-9@._-]{{3,}}+", None),
    "key": ("(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+={0,2}", _mixed),
    "endpoint": (f"(?i)(?:https?://[a-z0-9.-]++(?::[0-9]++)?|(?:endpoint|hostname|region|bucket){_NAMED}[a-z0-9./:_-]{{3,}}+)", None),
}
#: The part of a credential that each kind is, and what else must stand in a weak candidate's scope.
ROLE = {"assign": "secret", "access": "name", "hex": "secret", "name": "name", "key": "secret", "endpoint": "endpoint"}
NEEDS = {"name": ["secret"], "key": ["name"], "endpoint": ["name", "secret"]}


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, assign, access, hex, name, key, endpoint): spans of every kind, the weak ones as far as they are linked."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = locate(docs.select(F.col(id_col).alias("doc_id"), text.alias("text")), "text", STRONG | WEAK)
    # rows are named by their content: repeated rows share a name and all that is found
    found = found.withColumn("version", F.xxhash64("doc_id", "text")).drop("text")
    path = scratch_path(docs.sparkSession, "secrets")
    found.write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    linked = _linked(found, scope).groupBy(F.col("doc_id").alias("other_id"), F.col("version").alias("other_version")).agg(
        *(F.collect_set(F.when(F.col("kind") == k, F.col("span"))).alias(f"linked_{k}") for k in WEAK))
    joined = found.join(linked, F.expr("doc_id <=> other_id and version = other_version"), "left")
    nothing = F.array().cast(f"array<{SPAN}>")
    return joined.select("doc_id", *STRONG, *(F.array_sort(F.coalesce(f"linked_{k}", nothing)).alias(k) for k in WEAK))


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """(doc_id, version, kind, span) of the weak candidates whose complementary parts stand within the scope."""
    def named(kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(F.lit(kind).alias("kind"), F.lit(ROLE[kind]).alias("role"), x.alias("span")))

    each = F.concat(*map(named, ROLE))
    parts = (found.where(" or ".join(f"size(`{k}`) > 0" for k in WEAK)).select("doc_id", "version", F.explode(each).alias("part"))
             .select("doc_id", "version", "part.*").withColumn("start", F.col("span.start")).withColumn("bin", F.floor(F.col("start") / scope)))
    bins = parts.groupBy("doc_id", "version", "bin", "role").agg(F.min("start").alias("low"), F.max("start").alias("high"))
    bins = bins.select(F.col("doc_id").alias("other_id"), F.col("version").alias("other_version"), F.col("bin").alias("other_bin"), F.col("role").alias("other"), "low", "high")
    weak = (parts.where(F.col("kind").isin(*WEAK)).distinct()
            .withColumn("near", F.explode(F.sequence(F.col("bin") - 1, F.col("bin") + 1))))
    meets = weak.join(bins, F.expr("doc_id <=> other_id and version = other_version and near = other_bin and role <> other "
                                   f"and high >= start - {scope} and low <= start + {scope}"))
    met = meets.groupBy("doc_id", "version", "kind", "span").agg(F.collect_set("other").alias("others"))
    complete = F.lit(False)
    for kind, roles in NEEDS.items():
        complete = complete | ((F.col("kind") == kind) & F.forall(F.array(*map(F.lit, roles)), lambda r: F.array_contains("others", r)))
    return met.where(complete).select("doc_id", "version", "kind", "span")
