"""URL filters: rules first, then a ratio of character language models.

Rules judge the urls they fit. Two variable-order Markov models, one of the
urls that rules allow and one of those they block, judge the others: the
probability of a character after up to `ORDER` characters is smoothed by
Witten-Bell interpolation with that after one character less, down to a uniform
one. The difference of the log-likelihoods per character is held against a
threshold calibrated on urls with rules that neither model has seen: every
fourth by a hash.

Counts are tables keyed by character sequences, made and joined by Spark over
every url, so nothing of the models is held in one place. Log ratios are kept as
whole millionths, which makes sums independent of their order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, lower_ascii, stored

ORDER = 4
START, END = "\x02", "\x03"
#: Characters that the uniform model at the bottom expects.
ALPHABET = 256
UNIT = 1_000_000
#: One in so many urls with rules is kept for the calibration.
HELD_OUT = 4
#: Width of a score bucket in calibration, in millionths.
BUCKET = 5_000


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit("." + self.host))) & F.startswith(path, F.lit(self.path))


#: The rules of the registered query.
RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
         Rule("allow", "org", "/fr/")]


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first `://` up to `/`, `?`, `#` or the end,
    in lower case; path from there up to `?`, `#` or the end. Both are empty
    for null and where there is no `://`."""
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(u, F.lit("://")), F.substr(u, F.instr(u, "://") + 3)).otherwise("")
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else nulls."""
    ordered = sorted(rules, key=lambda r: -len(r.text))
    pick = lambda f: F.coalesce(F.lit(None).cast("string"), *[F.when(r.fits(host, path), f(r)) for r in ordered])
    return pick(lambda r: r.text), pick(lambda r: r.verdict)


def sequences(text: Column) -> Column:
    """Every character of a text and of its end, with the ORDER before it."""
    padded = F.concat(F.lit(START * ORDER), text, F.lit(END))
    return let(F.regexp_extract_all(padded, F.lit("(?s)."), F.lit(0)), lambda c: F.transform(
        F.sequence(F.lit(0), F.size(c) - ORDER - 1), lambda i: F.concat(*[F.get(c, i + k) for k in range(ORDER + 1)])))


def log_ratios(texts: DataFrame) -> DataFrame:
    """(g, ratio): for each sequence in the texts, the log of its last
    character's probability after the others among allowed texts less that
    among blocked ones, in millionths. `texts` has (s, allowed, blocked): each
    text once, and whether it trains a model."""
    grams = texts.select(F.explode(sequences(F.col("s"))).alias("g"), "allowed", "blocked")
    counts = stored(grams.groupBy("g").agg(F.sum(F.col("allowed").cast("long")).alias("a"),
                                           F.sum(F.col("blocked").cast("long")).alias("b")), "url-counts")
    seen = counts.where("a > 0 OR b > 0")
    scored = counts.select("g", F.lit(1 / ALPHABET).alias("pa"), F.lit(1 / ALPHABET).alias("pb"))
    for k in range(ORDER + 1):
        own = seen.groupBy(F.substr("g", F.lit(ORDER + 1 - k)).alias("x")).agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
        # of what the context is followed by: how much in all, how many kinds
        context = own.groupBy(F.substr("x", F.lit(1), F.lit(k)).alias("c")).agg(
            F.sum("na").alias("ta"), F.sum("nb").alias("tb"), F.count_if(F.col("na") > 0).alias("ka"),
            F.count_if(F.col("nb") > 0).alias("kb"))
        keyed = scored.withColumn("x", F.substr("g", F.lit(ORDER + 1 - k))).withColumn("c", F.substr("x", F.lit(1), F.lit(k)))
        joined = keyed.join(own, "x", "left").join(context, "c", "left")

        def smoothed(p: str, n: str, t: str, kinds: str) -> Column:
            mixed = (F.coalesce(F.col(n), F.lit(0)) + F.col(kinds) * F.col(p)) / (F.col(t) + F.col(kinds))
            return F.when(F.col(t) > 0, mixed).otherwise(F.col(p)).alias(p)

        scored = joined.select("g", smoothed("pa", "na", "ta", "ka"), smoothed("pb", "nb", "tb", "kb"))
    return stored(scored.select("g", F.round((F.ln("pa") - F.ln("pb")) * UNIT).cast("long").alias("ratio")), "url-ratios")


def threshold(buckets: list[tuple[int, int, int]]) -> float:
    """The bucket edge that gets most of both classes right, from (bucket,
    allowed, blocked) rows; of equal edges the middle one. With one class
    only, the edge that lets all of it through its own way; with none, 0."""
    allowed, blocked = sum(a for _, a, _ in buckets), sum(b for _, _, b in buckets)
    if not allowed or not blocked:
        return float("inf") if blocked else 0.0 if not allowed else float("-inf")
    best, edges, a, b = -1.0, [], 0, 0
    for at, na, nb in sorted(buckets):
        right = (allowed - a) / allowed + b / blocked
        if right > best + 1e-12:
            best, edges = right, []
        if right >= best - 1e-12:
            edges.append(at)
        a, b = a + na, b + nb
    return edges[len(edges) // 2] * BUCKET / UNIT


def calibrated(buckets: list[tuple[int, bool, int, int]]) -> float:
    """The threshold of (bucket, held, allowed, blocked) rows: by the held
    urls, or by all if one class has none among them."""
    held = [(at, a, b) for at, held, a, b in buckets if held]
    if not sum(a for _, a, _ in held) or not sum(b for _, _, b in held):
        held = [(at, a, b) for at, _, a, b in buckets]
    merged: dict[int, list[int]] = {}
    for at, a, b in held:
        n = merged.setdefault(at, [0, 0])
        n[0], n[1] = n[0] + a, n[1] + b
    return threshold([(at, a, b) for at, (a, b) in merged.items()])


def judge(pages: DataFrame, rules: list[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each row of `pages`: (page_id, host, path, rule, verdict,
    score, threshold).

    Urls without rule are blocked where score, the mean log ratio a character
    over host and path in lower case, is below the threshold. A url that is
    null or has no `://` has empty host and path, and its own text, lower-cased,
    is scored. Without allowed or blocked urls all others go the one class's
    way, and are allowed if there is neither. Urls of any length are scored whole. Repeated rows and null ids each
    have their row; a url trains a model once, however often it occurs; other columns are ignored.
    """
    host, path = parts(F.col(url_col))
    named = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                         F.lower(F.coalesce(url_col, F.lit(""))).alias("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    whole = F.when(F.contains("url", F.lit("://")), F.lower(F.concat("host", "path"))).otherwise(F.col("url"))
    urls = stored(named.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), whole.alias("s")), "urls")
    texts = stored(urls.groupBy("s").agg(F.coalesce(F.bool_or(F.col("ruled") == "allow"), F.lit(False)).alias("allowed"),
                                         F.coalesce(F.bool_or(F.col("ruled") == "block"), F.lit(False)).alias("blocked"))
                   # dealt anew, since few files hold very many urls
                   .withColumn("held", F.pmod(F.xxhash64("s"), F.lit(HELD_OUT)) == 0)
                   .repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s"), "url-texts")
    ratios = log_ratios(texts.select("s", (F.col("allowed") & ~F.col("held")).alias("allowed"),
                                     (F.col("blocked") & ~F.col("held")).alias("blocked")))
    marks = ["allowed", "blocked", "held"]
    scores = (texts.select("s", *marks, F.explode(sequences(F.col("s"))).alias("g")).join(ratios, "g")
              .groupBy("s", *marks).agg((F.sum("ratio") / F.count("*") / UNIT).alias("score")))
    scores = stored(scores, "url-scores")
    # scores lie within the smoothed models' few tens of nats, so buckets are some thousands at most
    bucket = F.floor(F.col("score") * UNIT / BUCKET).cast("long")
    rows = (scores.where("allowed OR blocked").groupBy(bucket.alias("at"), "held")
            .agg(F.count_if("allowed").alias("a"), F.count_if("blocked").alias("b")).collect())
    limit = calibrated([(r["at"], r["held"], r["a"], r["b"]) for r in rows])
    judged = urls.join(scores.select("s", "score"), "s")
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", F.when(F.col("score") < limit, "block").otherwise("allow")).alias("verdict"),
                         "score", F.lit(limit).alias("threshold"))
