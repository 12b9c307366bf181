"""URL filters: stated rules for hosts and paths, and association rules mined from labelled URLs for the rest.

A stated rule has a host and the beginning of a path. It fits its host and all hosts below it, if the path begins so;
of several the longest wins. For URLs that no stated rule decides, Spark's FP-growth mines which combinations of URL
tokens go with a label among labelled URLs. Rules below a support (number of labelled URLs) or a confidence are pruned,
as are rules that say no more than one of fewer tokens. The others are matched by an inverted index: a rule stands under
its rarest token, is looked up for the URLs that have it, and applies if they have its other tokens too. Of several the
most confident wins, then the one with most support, then blocking, then the one with most tokens.

Tokens are the labels of the host, the words of the path, and the parameters of the query, each marked with its place
and occurring once. Tokens that all labelled URLs share tell nothing and are left out. So are, of tokens that always
occur together, all but one: they would multiply the itemsets and add no rule that decides anything else.

Mining reads all labelled rows; matching goes over distinct token lists, so a URL or host that holds a third of all rows
is matched once. Rows are judged one by one, so ids may repeat or be null. A null URL and one without ``://`` have an
empty host and path and no tokens, and get the default verdict, as do URLs that no rule fits. Other columns are not read.
Without labelled rows there are no mined rules; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.staging import written

BLOCK, ALLOW = "block", "allow"
SUPPORT = 0.002  # share of the labelled URLs
LEAST = 5  # labelled URLs, where there are few
CONFIDENCE = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "="


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    """What follows the first ``://``, null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))


def host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A to Z in lower case; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end; empty if there is no host."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """The tokens of a URL, sorted and each once; empty if there is no host."""
    rest = F.coalesce(_rest(url), F.lit(""))
    marked = lambda mark, words: F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(mark), w))
    low = lambda text: F.translate(text, _UPPER, _LOWER)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return F.array_sort(
        F.array_distinct(
            F.concat(
                marked("h:", F.split(host(url), r"\.")),
                marked("p:", F.split(low(path(url)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")),
                marked("q:", F.split(low(query), r"[&;]+")),
            )
        )
    )


def stated(host_: Column, path_: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == BLOCK)):
        below = (host_ == rule.host) | F.endswith(host_, F.lit(f".{rule.host}"))
        said = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(below & F.startswith(path_, F.lit(rule.path)), said).otherwise(out)
    return out


def _representatives(labelled: DataFrame, rows: int) -> DataFrame:
    """(token, n) of the tokens to mine: neither in all of the ``rows`` nor always together with a smaller token."""
    each = labelled.select(F.explode("tokens").alias("token"), F.xxhash64("row").alias("a"), F.xxhash64("row", F.lit(1)).alias("b"))
    places = each.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.sum(F.col("b").cast("decimal(38,0)")).alias("b")
    )
    return places.where(F.col("n") < rows).groupBy("n", "a", "b").agg(F.min("token").alias("token")).select("token", "n")


def mined(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST) -> DataFrame:
    """The association rules of ``labelled`` (tokens, label): (antecedent, label, n, confidence, size), pruned.

    ``label`` is ``block`` or ``allow``; rows with another label or none do not count.
    """
    spark = labelled.sparkSession
    known = labelled.where(F.col("label").isin(BLOCK, ALLOW)).select("tokens", "label")
    known = written(known.withColumn("row", F.monotonically_increasing_id()), "labelled-urls")
    rows = known.count()
    empty = spark.createDataFrame([], "antecedent array<string>, label string, n long, confidence double, size int")
    if not rows:
        return empty
    needed = max(least, math.ceil(support * rows))
    items = _representatives(known, rows).where(F.col("n") >= needed)
    frequent = known.select("row", F.explode("tokens").alias("token")).join(items.select("token"), "token")
    baskets = frequent.groupBy("row").agg(F.collect_list("token").alias("kept"))
    # baskets without a frequent token count as well, as they are among the rows that support is a share of
    held = known.join(baskets, "row", "left")
    label = F.concat(F.lit(_LABEL), F.col("label"))
    held = held.select(F.array_append(F.coalesce("kept", F.array().cast("array<string>")), label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, needed / rows), minConfidence=confidence).fit(written(held, "baskets"))
    rules = model.associationRules.where(F.startswith(F.get("consequent", F.lit(0)), F.lit(_LABEL)))
    rules = rules.where(~F.exists("antecedent", lambda t: F.startswith(t, F.lit(_LABEL))))
    rules = written(
        rules.select(
            F.array_sort("antecedent").alias("antecedent"),
            F.substring(F.get("consequent", F.lit(0)), 2, 100).alias("label"),
            F.round(F.col("support") * rows).cast("long").alias("n"),
            "confidence",
            F.size("antecedent").alias("size"),
        ),
        "rules",
    )
    # a rule that contains a shorter one with the same label and no less confidence decides nothing
    longer = rules.select("antecedent", F.col("label").alias("own"), F.col("confidence").alias("sure"), F.col("size").alias("long"))
    within = matches(longer, "antecedent", rules)
    idle = within.where("label = own AND confidence >= sure AND size < long").select("antecedent", F.col("own").alias("label")).distinct()
    return rules.join(idle, ["antecedent", "label"], "left_anti")


def matches(lists: DataFrame, tokens_col: str, rules: DataFrame) -> DataFrame:
    """The rows of ``lists`` with each rule of ``rules`` whose tokens they all have, found by the rules' rarest tokens."""
    each = rules.select("antecedent", F.explode("antecedent").alias("token"))
    common = each.groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    rarest = each.join(common, "token").groupBy("antecedent").agg(F.min(F.struct("uses", "token")).alias("r"))
    posted = rules.withColumnRenamed("antecedent", "needs").join(rarest.select(F.col("antecedent").alias("needs"), F.col("r.token").alias("token")), "needs")
    probed = lists.withColumn("token", F.explode(tokens_col))
    return probed.join(posted, "token").where(F.size(F.array_except("needs", tokens_col)) == 0).drop("token", "needs")


def judged(
    urls: DataFrame, rules: list[Rule], labelled: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW,
    support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST,
) -> DataFrame:
    """One row per row of ``urls``: the id, ``host``, ``path``, ``rule``, ``verdict``, and the ``confidence`` of a mined one.

    ``labelled`` has a URL and its ``label`` (``block`` or ``allow``) per row.
    """
    known = labelled.select(tokens(F.col(url_col)).alias("tokens"), F.col("label"))
    found = written(mined(known, support, confidence, least), "pruned-rules")
    split = urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    split = split.select("id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), tokens(F.col("url")).alias("tokens"))
    split = split.withColumn("s", stated(F.col("host"), F.col("path"), rules))
    ruled, other = split.where("s IS NOT NULL"), split.where("s IS NULL")
    best = F.max(F.struct("confidence", "n", (F.col("label") == BLOCK).alias("blocks"), "size", "label")).alias("m")
    verdicts = matches(other.select("tokens").distinct(), "tokens", found).groupBy("tokens").agg(best)
    columns = [F.col("id").alias(id_col), "host", "path"]
    said = other.join(verdicts, "tokens", "left").select(
        *columns,
        F.lit(None).cast("string").alias("rule"),
        F.coalesce("m.label", F.lit(default)).alias("verdict"),
        F.col("m.confidence").alias("confidence"),
    )
    # these have no list to look for, and would all meet under its null
    return ruled.select(*columns, "s.rule", "s.verdict", F.lit(None).cast("double").alias("confidence")).unionByName(said)
