"""URL filters: fixed host and path rules, and association rules mined from labelled URLs.

The longest fixed rule that fits a URL decides. For the others, Spark's FP-growth mines
which combinations of URL tokens (scheme, top domain, site, subdomain, path segments,
extension, query keys) go along with a verdict among labelled pages: pages that a fixed
rule decides, and pages whose labels say so. Combinations with enough support and
confidence for ``block`` become rules, unless a part of the combination blocks with the
same confidence already. An inverted index matches them: a rule is listed under its
rarest token only, and a URL that has that token is tested for the rest.

Everything is DataFrame expressions. Defined results: a null URL, or one without
``://``, has an empty host and path, no fixed rule and no tokens, so it is allowed; a URL
without a matching rule is allowed; pages that repeat get a row each; labels that are
null do not block; with fewer than ``LEAST`` labelled pages there are no mined rules. Extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.frames import forget, stored

#: (rule, verdict), fixed. A rule is a host, with all its subdomains, and the start of the path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: Least share and least number of labelled pages that a combination stands in, and least share of them that block.
SUPPORT, LEAST, CONFIDENCE = 0.005, 20, 0.8
#: Mined rules up to this number go to every task; beyond it the join is shuffled.
BROADCAST_RULES = 20_000
AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 2), F.lit(""))


def fitting_rule(rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits ``host`` and ``path``, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    listed = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(r.partition("/")[0]).alias("h"), F.lit("/" + r.partition("/")[2]).alias("p")) for r, v in ordered]
    )
    fits = lambda r: ((F.col("host") == r["h"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["h"]))) & F.startswith(F.col("path"), r["p"])
    return F.try_element_at(F.filter(listed, fits), F.lit(1))


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL; digits in path segments are folded, so numbered pages look alike."""
    labels = F.filter(F.split("host", r"\."), lambda x: x != "")
    n = F.size(labels)
    part = lambda mark, x: F.concat(F.lit(mark + "="), x)
    last = F.when(n > 0, F.array(part("top", F.element_at(labels, -1)))).otherwise(F.array().cast("array<string>"))
    site = F.when(n > 1, F.array(part("site", F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), ".")))).otherwise(F.array().cast("array<string>"))
    sub = F.transform(F.when(n > 2, F.slice(labels, 1, F.greatest(n - 2, F.lit(0)))).otherwise(F.array().cast("array<string>")), lambda x: part("sub", x))
    words = F.transform(F.filter(F.split("path", "/"), lambda x: x != ""), lambda x: part("path", F.regexp_replace(x, "[0-9]+", "#")))
    extension = F.regexp_extract("path", r"\.([A-Za-z0-9]{1,5})$", 1)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: part("key", F.substring_index(x, "=", 1)))
    scheme = F.array(part("scheme", F.substring_index(url, "://", 1)))
    ends = F.when(extension != "", F.array(part("ext", extension))).otherwise(F.array().cast("array<string>"))
    found = F.array_distinct(F.concat(scheme, last, site, sub, words, ends, keys))
    return F.when((F.col("host") != "") | (F.col("path") != ""), found).otherwise(F.array().cast("array<string>"))


def token_classes(transactions: DataFrame, least: float, verdict: str) -> DataFrame:
    """(token, class): tokens that stand in the same labelled pages have one class, named by the least of them.

    ``transactions``: (nth, tokens, label). Only tokens of at least ``least`` pages of the
    verdict, as others are in no rule; so there are at most pages / least times the tokens
    of a URL. Sets of pages are told by their size and two 64-bit fingerprints.
    """
    seen = transactions.select("nth", "label", F.explode(F.array_distinct("tokens")).alias("token"))
    mark = lambda seed: F.bit_xor(F.xxhash64("nth", F.lit(seed)))
    sets = seen.groupBy("token").agg(F.count_if(F.col("label") == verdict).alias("both"), F.count("*").alias("n"), mark(1).alias("x"), mark(2).alias("y"))
    sets = sets.where(F.col("both") >= least - 1e-6)
    names = sets.groupBy("n", "x", "y").agg(F.min("token").alias("class"))
    return sets.join(names, ["n", "x", "y"]).select("token", "class")


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, verdict: str = "block") -> DataFrame:
    """(tokens, anchor, support, confidence, members) of combinations that go along with ``verdict``.

    ``labelled``: (tokens, label). Tokens that always stand together among the labelled
    pages are mined as one, so a deep path is one item and not all its subsets; ``members``
    has the tokens behind each of ``tokens``, any of which will do in a URL. The anchor is
    the rarest token of a combination.
    """
    mark = "verdict=" + verdict
    rows = stored(labelled.select(F.monotonically_increasing_id().alias("nth"), "tokens", "label"), "url-transactions")
    total = rows.count()
    none = labelled.sparkSession.createDataFrame([], "tokens array<string>, anchor string, support double, confidence double, members array<array<string>>")
    if total < LEAST:
        return none
    least = min(total, max(support * total, LEAST))
    classes = stored(token_classes(rows, least, verdict), "url-classes")
    seen = rows.select("nth", "label", F.explode("tokens").alias("token")).join(F.broadcast(classes), "token")
    items = seen.groupBy("nth", "label").agg(F.sort_array(F.collect_set("class")).alias("items"))
    items = stored(items.select(F.when(F.col("label") == verdict, F.array_append("items", F.lit(mark))).otherwise(F.col("items")).alias("items")), "url-items")
    forget(rows)
    kept_rows = items.count()
    if not kept_rows:
        return none
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, least / kept_rows), minConfidence=confidence).fit(items).freqItemsets
    found = stored(found.select(F.array_sort("items").alias("items"), "freq"), "url-itemsets")
    forget(items)
    having = found.where(F.array_contains("items", mark)).select(F.array_remove("items", mark).alias("items"), F.col("freq").alias("both"))
    rules = having.where(F.size("items") > 0).join(found, "items")
    rules = rules.select("items", (F.col("both") / total).alias("support"), (F.col("both") / F.col("freq")).alias("confidence"))
    rules = stored(rules.where(F.col("confidence") >= confidence), "url-rules")
    # a combination is not needed where leaving out one of its tokens blocks as surely
    shorter = rules.withColumn("less", F.explode("items")).select("items", "confidence", F.array_remove("items", F.col("less")).alias("part"))
    general = rules.select(F.col("items").alias("part"), F.col("confidence").alias("surely"))
    needless = shorter.join(general, "part").where(F.col("surely") >= F.col("confidence")).select("items").distinct()
    kept = rules.join(needless, "items", "left_anti")
    single = found.where(F.size("items") == 1).select(F.element_at("items", 1).alias("anchor"), "freq")
    members = classes.groupBy(F.col("class").alias("anchor")).agg(F.sort_array(F.collect_list("token")).alias("own"))  # of one class: tokens of one URL
    anchored = kept.withColumn("anchor", F.explode("items")).join(single, "anchor").join(members, "anchor")
    ordered = F.sort_array(F.collect_list(F.struct("anchor", "own")))
    anchored = anchored.groupBy("items", "support", "confidence").agg(F.min_by("anchor", F.struct("freq", "anchor")).alias("anchor"), ordered.alias("parts"))
    return anchored.select(F.col("parts.anchor").alias("tokens"), "anchor", "support", "confidence", F.col("parts.own").alias("members"))


def blocked_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, confidence, by): URLs (url, tokens) with a matching rule, and their surest one."""
    own = F.element_at("members", F.array_position("tokens", F.col("anchor")).cast("int"))
    rules = stored(rules.select(F.explode(own).alias("anchor"), "members", "confidence"), "url-index")
    index = F.broadcast(rules) if rules.count() <= BROADCAST_RULES else rules
    listed = urls.withColumn("anchor", F.explode("tokens")).join(index, "anchor")
    whole = listed.where(F.forall("members", lambda m: F.arrays_overlap(m, F.col("tokens"))))
    held = F.array_join(F.transform("members", lambda m: F.array_min(F.array_intersect(m, F.col("tokens")))), " ")
    surest = F.max(F.struct("confidence", held.alias("by"))).alias("best")
    return whole.groupBy("url").agg(surest).select("url", "best.confidence", "best.by")


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined) for every page; ``mined`` is the combination that blocked it, if one did."""
    url = F.col("url")
    parsed = pages.select("page_id", "url").withColumns({"host": host_of(url), "path": path_of(url)})
    parsed = parsed.withColumns({"fit": fitting_rule(rules), "tokens": tokens_of(url)})
    parsed = stored(parsed.select("page_id", "url", "host", "path", "fit.rule", F.col("fit.verdict").alias("fixed"), "tokens"), "url-parts")

    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    judged = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.when(F.bool_or(bad), "block").otherwise("allow").alias("judged"))
    labelled = parsed.where(F.size("tokens") > 0).join(judged, "page_id", "left")
    labelled = labelled.select("tokens", F.coalesce("fixed", "judged").alias("label")).where("label is not null")
    mined = mined_rules(labelled, support, confidence)

    undecided = parsed.where(F.col("rule").isNull() & (F.size("tokens") > 0)).groupBy("url").agg(F.first("tokens").alias("tokens"))
    blocked = stored(blocked_urls(undecided, mined), "url-blocked")
    verdict = F.coalesce("fixed", F.when(F.col("by").isNotNull(), "block"), F.lit("allow"))
    found = parsed.join(blocked.select("url", "by"), "url", "left")
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("rule").isNull(), F.col("by")).alias("mined"))
