"""URL filter: rules first, then a character language-model ratio, DataFrame functions only.

The URLs that a rule allows and those that a rule blocks train two smoothed
variable-order Markov models over characters (contexts of 0 to 3 characters,
Witten-Bell interpolation).  The score of a URL is the difference of its two
log-likelihoods for each character; the verdict compares it with a threshold
calibrated on the URLs that the rules decide.

Characters are mapped to an alphabet of ``len(ALPHABET) + 4`` symbols (digits
are one symbol, everything unknown another), so there are at most 41^4 or 2.9
million different 4-grams: the table of log ratios that is broadcast has this
proven bound (about 70 MB), and far fewer rows in practice.

Defined results: a null URL, or one without ``://``, has empty host and path
and no rule; a null or empty URL scores 0; without training URLs of both kinds
every ratio is 0 and what no rule decides is allowed; repeated rows come back
as often as they are there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharelens.session import cut_lineage

#: fixed values: verdict, host, path
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = LOWER + "0./-_?=&%:#"
ORDER = 4
#: width and range of the histogram on which the threshold is calibrated, in nats for each character
BIN, CLIP = 0.01, 10.0


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null where none does."""
    name = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def symbols(url: Column) -> Column:
    """The URL over the alphabet, between three start symbols and an end symbol."""
    low = F.translate(F.coalesce(url, F.lit("")), UPPER + "123456789", LOWER + "0" * 9)
    return F.concat(F.lit("^" * (ORDER - 1)), F.regexp_replace(low, r"[^a-z0./\-_?=&%:#]", "*"), F.lit("$"))


def _grams(df: DataFrame) -> DataFrame:
    """A row for each character with the 4-gram that ends in it: the columns of ``df``, pos, gram."""
    at = F.explode(F.sequence(F.lit(1), F.length("s") - (ORDER - 1))).alias("pos")
    return df.select("*", at).withColumn("gram", F.substring(F.col("s"), F.col("pos"), F.lit(ORDER)))


def log_ratios(urls: DataFrame) -> DataFrame:
    """(gram, ratio): log p_allow - log p_block of the last character after the others.

    ``urls`` has s (symbols) and verdict (allow, block or null); all its 4-grams
    get a row, those of undecided URLs too, so scoring needs one lookup.
    """
    count = lambda v: F.count(F.when(F.col("verdict") == v, 1))
    table = _grams(urls).groupBy("gram").agg(count("allow").alias("allow"), count("block").alias("block"))
    table = cut_lineage(table)
    kinds = ("allow", "block")
    out = table.select("gram", *[F.lit(1.0 / (len(ALPHABET) + 4)).alias(f"p_{k}") for k in kinds])
    for n in range(1, ORDER + 1):  # n: characters of context and the last one
        own = F.substring("gram", ORDER - n + 1, n)
        counts = table.groupBy(own.alias("g")).agg(*[F.sum(k).alias(k) for k in kinds])
        context = counts.groupBy(F.substring("g", 1, n - 1).alias("ctx")).agg(
            *[F.sum(k).alias(f"n_{k}") for k in kinds], *[F.count(F.when(F.col(k) > 0, 1)).alias(f"t_{k}") for k in kinds])
        joined = (out.withColumn("g", own).withColumn("ctx", F.substring("gram", ORDER - n + 1, n - 1))
                  .join(counts, "g").join(context, "ctx"))
        p = [F.when(F.col(f"n_{k}") > 0, (F.col(k) + F.col(f"t_{k}") * F.col(f"p_{k}"))
                    / F.greatest(F.col(f"n_{k}") + F.col(f"t_{k}"), F.lit(1))).otherwise(F.col(f"p_{k}")).alias(f"p_{k}")
             for k in kinds]
        out = joined.select("gram", *p)
    seen = [F.col(k) > 0 for k in kinds]
    both = table.agg(*[F.max(s).alias(k) for s, k in zip(seen, kinds, strict=True)]).first()
    trained = bool(both["allow"] and both["block"])
    return out.select("gram", (F.ln("p_allow") - F.ln("p_block") if trained else F.lit(0.0)).alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The score from which a URL is allowed: it gives the best balanced accuracy on the
    URLs that rules decide, the smallest such score on a tie; 0 without URLs of both kinds.
    The histogram has at most ``2 * CLIP / BIN + 1`` rows."""
    at = F.round(F.greatest(F.least("score", F.lit(CLIP)), F.lit(-CLIP)) / BIN).cast("int")
    rows = scored.where("verdict is not null").groupBy(at.alias("bin")).agg(
        F.sum((F.col("verdict") == "allow").cast("long")).alias("allow"),
        F.sum((F.col("verdict") == "block").cast("long")).alias("block")).orderBy("bin").collect()
    allow, block = sum(r["allow"] for r in rows), sum(r["block"] for r in rows)
    if not allow or not block:
        return 0.0
    best, cut, below_a, below_b = -1.0, 0.0, 0, 0
    for r in rows:
        got = (allow - below_a) / allow + below_b / block
        if got > best + 1e-12:
            best, cut = got, (r["bin"] - 0.5) * BIN
        below_a, below_b = below_a + r["allow"], below_b + r["block"]
    return cut


def judge_urls(pages: DataFrame, url_col: str = "url", id_col: str = "page_id", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, score), a row for each row of ``pages``."""
    url = F.col(f"`{url_col}`")
    base = pages.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"),
                        symbols(url).alias("s"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.select("*", name.alias("rule"), verdict.alias("verdict"))
    ratios = log_ratios(base.select("s", "verdict"))
    keys = ["id", "host", "path", "rule", "verdict", "s"]
    scored = (_grams(base).join(F.broadcast(ratios), "gram").groupBy(*keys)
              .agg(F.sum("ratio").alias("total"), F.count(F.when(F.col("pos") == 1, 1)).alias("copies"))
              .select(*keys[:-1], "copies", F.when(F.length("s") == ORDER, 0.0).otherwise(
                  F.round(F.col("total") / F.col("copies") / (F.length("s") - ORDER + 1), 9)).alias("score")))
    scored = cut_lineage(scored)
    cut = threshold(scored.withColumn("verdict", F.col("verdict")))
    decided = F.coalesce("verdict", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return (scored.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("id", "host", "path", "rule", decided.alias("verdict"), "score"))
