"""Personal data: fixed patterns, and bootstrapped contextual extraction, with DataFrame and SQL functions only.

The fixed patterns' matches are seeds.  The two words before a seed induce a lexical pattern, and every token with
digits or an @ that stands after the same words is an instance of it.  On the graph of patterns and instances Spark
scores both in turn: a pattern by the share of its instances that are believed for a kind, an instance by the
patterns it stands in.  Tokens that high-confidence patterns introduce are reported as found identifiers.

Defined results: a null or empty text has no spans; repeated rows report the same spans and count once in the graph;
a null id is an id; an empty table gives no rows; ``scan`` does not read extra columns, ``redact`` passes them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.spans import BLOCK, SPAN, chunks, locate, piece
from verdant.session import scratch_path

#: Different seeds that a pattern must have introduced, its confidence, and the belief a found identifier needs.
SUPPORT = 5
CONFIDENT = 0.5
BELIEVED = 0.8
ROUNDS = 3
#: Code points before a match in which its two words are looked for.
BEFORE = 64


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _bytes_fit(text: Column) -> Column:
    def fits(part: Column) -> Column:
        digits = F.ltrim(part, F.lit("0"))
        return (F.length(digits) <= 3) & (F.coalesce(digits.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(text, "\\."), fits)


def _luhn(text: Column) -> Column:
    d = F.reverse(_digits(text))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(d, i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    # sixteen digits or so; others stop at the length
    return F.length(d).between(14, 19) & (F.aggregate(F.sequence(F.lit(0), F.least(F.length(d), F.lit(19)) - 1), F.lit(0), add) % 10 == 0)


#: Name: (pattern, test of the match).  Look-behinds only skip places where a match cannot begin: inside a run whose
#: first place fails or was matched already (\\G: right after a match); possessive runs give nothing back in vain.
BASE = {
    "email": ("(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++", None),
    "ip": ("(?<![0-9])[0-9]++(?:\\.[0-9]++){3}", _bytes_fit),
    "card": ("[0-9](?:[\\x20-]?[0-9]){13,}+", _luhn),
    "phone": ("\\+[0-9][\\x20().0-9-]+[0-9]", lambda x: F.length(_digits(x)).between(10, 15)),
}
FOUND = {k: f"found_{k}" for k in BASE}
TOKEN = "(?<!\\S)[^\\s0-9@]*+[0-9@]\\S*+"


def _is_token(text: Column) -> Column:
    """Tokens that may be identifiers: four digits, or an @ inside."""
    return (F.length(_digits(text)) >= 4) | text.rlike("\\w@\\w")


def _unmet(rows: DataFrame) -> DataFrame:
    """``rows`` without the tokens that overlap a base span.

    What only looks like a base match, but failed its test, may still be found.  The spans of a kind are in order and apart,
    so a token looks into those blocks of them that reach over it.
    """
    def blocks(k: str) -> Column:
        def ends(b: Column) -> Column:
            last = F.least((b + 1) * BLOCK, F.size(k)).cast("int")
            return F.struct(b.alias("b"), F.get(k, b * BLOCK)["start"].alias("low"), F.get(k, last - 1)["end"].alias("high"))

        return F.when(F.size(k) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(k) - 1) / BLOCK).cast("int")), ends))

    def met(token: Column) -> Column:
        def over(x: Column) -> Column:
            return (x["low"] < token["end"]) & (x["high"] > token["start"])

        def by(k: str) -> Column:
            def inside(x: Column) -> Column:
                return F.exists(F.slice(F.col(k), x["b"] * BLOCK + 1, F.lit(BLOCK)), lambda s: (s["start"] < token["end"]) & (s["end"] > token["start"]))

            return F.coalesce(F.exists(f"_blocks_{k}", lambda x: over(x) & inside(x)), F.lit(False))

        found = F.lit(False)
        for k in BASE:
            found = found | by(k)
        return found

    some = F.greatest(*(F.size(k) for k in BASE)) > 0
    rows = rows.withColumns({f"_blocks_{k}": blocks(k) for k in BASE})
    rows = rows.withColumn("token", F.when(some & (F.size("token") > 0), F.filter("token", lambda t: ~met(t))).otherwise(F.col("token")))
    return rows.drop(*(f"_blocks_{k}" for k in BASE))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "pii", name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _value(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "^[^\\w+]+|\\W+$", ""))


def _parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Base spans, and (kind or null, words before, value, span) of every base match and candidate token."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("version", F.xxhash64("doc_id", "text"))
    rows = _unmet(locate(rows, "text", BASE | {"token": (TOKEN, _is_token)}))

    def named(spans: str, kind: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(kind.alias("kind"), x.alias("span")))

    every = F.concat(*(named(k, F.lit(k)) for k in BASE), named("token", F.lit(None).cast("string")))
    rows = rows.withColumn("every", every).withColumn("chunked", F.when(F.size("every") > 0, chunks(F.col("text"))))

    def described(x: Column) -> Column:
        start = x["span"]["start"]
        before = piece("chunked", F.greatest(start - BEFORE, F.lit(0).cast("long")), start)
        words = F.regexp_extract(F.regexp_replace(F.lower(before), "[0-9]", "9"), "(\\S+\\s+\\S+)\\s*$", 1)
        return F.struct(x["kind"].alias("kind"), F.regexp_replace(words, "\\s+", " ").alias("words"), _value(x["span"]["text"]).alias("value"), x["span"].alias("span"))

    return rows.select("doc_id", "version", *BASE, F.transform("every", described).alias("parts"))


def _discovered(parts: DataFrame) -> DataFrame:
    """(doc_id, version, kind, span) of the tokens that confident patterns introduce."""
    each = parts.select("doc_id", "version", F.explode("parts").alias("p")).select("doc_id", "version", "p.*").where("words <> ''")
    edges = _stored(each.select("words", "value", "kind").distinct(), "edges")
    size = edges.select("words", "value").distinct().groupBy("words").agg(F.count("*").alias("instances"))
    seeds = edges.where("kind is not null").select("value", "kind").distinct().withColumn("belief", F.lit(1.0))
    open_ = edges.where("kind is null").select("words", "value").distinct()
    beliefs = seeds
    for k in range(ROUNDS):
        support = edges.select("words", "value").distinct().join(beliefs, "value").groupBy("words", "kind").agg(F.sum("belief").alias("mass"), F.count("*").alias("support"))
        patterns = (support.where(F.col("support") >= SUPPORT).join(size, "words")
                    .select("words", "kind", (F.col("mass") / (F.col("instances") + 1)).alias("confidence")).where(F.col("confidence") >= CONFIDENT))
        patterns = _stored(patterns, f"patterns{k}")
        grown = (open_.join(patterns, "words").groupBy("value", "kind")
                 .agg((1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999)))))).alias("belief")))
        beliefs = _stored(seeds.unionByName(grown.join(seeds.select("value", "kind"), ["value", "kind"], "left_anti")), f"beliefs{k}")
    sure = beliefs.where(F.col("belief") >= BELIEVED)
    tokens = each.where("kind is null").drop("kind").join(patterns.select("words", "kind"), "words")
    return tokens.join(sure.select("value", "kind"), ["value", "kind"], "left_semi").select("doc_id", "version", "kind", "span").distinct()


def _scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    parts = _stored(_parts(docs, id_col, text_col), "parts")
    more = _discovered(parts).groupBy(F.col("doc_id").alias("other_id"), F.col("version").alias("other_version")).agg(
        *(F.collect_set(F.when(F.col("kind") == k, F.col("span"))).alias(name) for k, name in FOUND.items()))
    nothing = F.array().cast(f"array<{SPAN}>")
    return parts.join(more, F.expr("doc_id <=> other_id and version = other_version"), "left").select(
        "doc_id", "version", *BASE, *(F.array_sort(F.coalesce(name, nothing)).alias(name) for name in FOUND.values()))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, email, ip, card, phone, found_email, ...): spans of every kind, one row per row of ``docs``."""
    return _scanned(docs, id_col, text_col).drop("version")


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans go together, named by the one that begins, then ends, first."""
    def named(spans: str, kind: str) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    every = F.concat(*(named(c, k) for k in BASE for c in (k, FOUND[k])))
    spans = _scanned(docs, id_col, text_col).select("doc_id", "version", F.explode(every).alias("s")).select("doc_id", "version", "s.*").distinct()
    text_order = Window.partitionBy("doc_id", "version").orderBy("start", "end", "kind")
    reach = F.max("end").over(text_order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (spans.withColumn("begins", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
            .withColumn("run", F.sum("begins").over(text_order)).groupBy("doc_id", "version", "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min(F.struct("start", "end", "kind"))["kind"].alias("kind")))
    found = runs.groupBy("doc_id", "version").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("_runs"))
    names = docs.columns
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"))
    version = F.xxhash64(F.col("_row")[id_col], F.coalesce(F.col("_row")[text_col], F.lit("")))
    joined = keyed.join(found, F.col("_row")[id_col].eqNullSafe(found["doc_id"]) & (version == found["version"]), "left").select("_row", "_runs")

    text = F.col("_row")[text_col]
    joined = joined.withColumn("_chunks", F.when(F.col("_runs").isNotNull(), chunks(text)))
    clean = F.concat(
        F.array_join(F.transform("_runs", lambda x, i: F.concat(
            piece("_chunks", F.when(i > 0, F.get("_runs", i - 1)["end"]).otherwise(F.lit(0).cast("long")), x["start"]), F.lit("["), x["kind"], F.lit("]"))), ""),
        piece("_chunks", F.element_at("_runs", -1)["end"], F.length(text).cast("long")))
    replaced = F.when(F.col("_runs").isNull(), text).otherwise(clean)
    return joined.withColumn("_clean", replaced).select(*(F.col("_clean").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in names))
