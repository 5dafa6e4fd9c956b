"""URL filters: rules by host and path first, then logistic regression on hashed character n-grams.

Host and path are cut from the text of a URL. A rule (host, path, verdict) fits its host and all
subdomains, if the URL's path starts with the rule's. Of the rules that fit, the one with the longest
``host + path`` decides; of equally long ones the one with the longer host, then ``block``.

URLs without a rule are judged by a logistic regression on the character n-grams (GRAMS) of host and
path, each field marked at its ends, hashed to SLOTS slots and counted once. It is trained from a
labelled table of any size by Spark's own optimiser; only sums of SLOTS numbers reach the driver.

Rules are looked up by the last 1, 2, ... labels of a host, once for each number of labels that a
rule's host has, so no row moves: a rule list of at most BROADCAST_RULES rows is broadcast, a longer one
is joined without a hint.

Contract. A null URL, or one without ``://``, has an empty host and path; no rule fits an empty host.
White space, ports and user names are part of the host. Rows stay as they are, repeated ones too, each
with the same verdict; extra columns of any name go through. Labelled rows without a URL or with
a verdict other than allow or block are not learned from; with one verdict left all URLs get it, with none
all are allowed. Very long URLs are judged whole.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
GRAMS = (3, 4, 5)
SLOTS = 1 << 16
REGULARISATION, ITERATIONS = 0.003, 40
BROADCAST_RULES = 10_000

Rule = tuple[str, str, str]

#: Hosts of a small labelled table; ``labelled_urls`` makes its rows.
ALLOWED_HOSTS = (
    "encyclopedia library university museum newsroom weather recipes gardening manual developer notebook clinic "
    "school cityhall journal science athletics travelogue orchestra history archive gallery community parliament "
    "observatory bookshop railway botany chess-club cooking-class open-source city-library river-watch local-history "
    "thought mention oriental theatre information nation station there-and-back thinking within thesis methods smith thatch health truth hypothesis"
).split()
BLOCKED_HOSTS = (
    "casino casino-royal mega-casino online-casino-bonus win-big big-win jackpot-win slots-win lucky-slots poker-bets "
    "sports-bets bets-today free-spins free-money free-gift pills pills-online discount-pills cheap-meds cheap-watches "
    "ads ads-server adserver popup-ads banner-ads track click-track tracker track-pixel spam spam-mail link-farm "
    "content-farm adult adult-video adult-chat xxx xxx-video payday-loans replica-bags miracle-diet crack-warez"
).split()
_FORMS = (
    "https://www.{}.example.com/en/{}.html",
    "http://{}.example.net/fr/{}",
    "https://blog.{}.example.org/de/{}/",
    "http://m.{}.example.com/es/{}?page=2&ref=x",
    "https://{}.example.org/en/{}?utm_source=feed",
    "http://www.{}.example.net/de/{}#top",
)


def labelled_urls() -> Iterator[tuple[str, str]]:
    """(url, verdict) rows of the small labelled table: each host in all forms, so that forms tell nothing."""
    for verdict, hosts in ((ALLOW, ALLOWED_HOSTS), (BLOCK, BLOCKED_HOSTS)):
        for i, host in enumerate(hosts):
            for form in _FORMS:
                yield form.format(host, 7 * i + 11), verdict


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of a URL; both empty if it has no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _grams(text: Column, mark: str) -> Column:
    """The n-grams of a field between marks of its ends; an empty field has none."""

    def of_size(chars: Column, n: int) -> Column:
        return F.transform(chars, lambda c, i: F.concat(F.lit(mark), c, *(F.get(chars, i + k) for k in range(1, n))))

    # As a lambda's variable the characters are split once, not for each n-gram.
    split = F.filter(F.array(F.split(F.concat(F.lit("<"), text, F.lit(">")), "")), lambda _: text != "")
    found = F.transform(split, lambda chars: F.flatten(F.array(*(of_size(chars, n) for n in GRAMS))))
    return F.array_compact(F.flatten(found))


def grams(host: Column, path: Column) -> Column:
    return F.concat(_grams(host, "h"), _grams(path, "p"))


def _hashed(df: DataFrame) -> DataFrame:
    return HashingTF(inputCol="grams", outputCol="slots", numFeatures=SLOTS, binary=True).transform(df)


@dataclass
class Model:
    """A fitted regression, or the only verdict there is."""

    regression: LogisticRegressionModel | None
    only: str = ALLOW


def train(labelled: DataFrame, url: str = "url", verdict: str = "verdict") -> Model:
    """Learn ``verdict`` (allow or block) of the URLs of ``labelled``."""
    host, path = host_and_path(F.col(url))
    known = labelled.filter(F.col(url).isNotNull() & F.col(verdict).isin(ALLOW, BLOCK)).select(
        grams(host, path).alias("grams"), (F.col(verdict) == BLOCK).cast("double").alias("block")
    )
    verdicts = [r["block"] for r in known.select("block").distinct().collect()]
    if len(verdicts) < 2:
        return Model(None, BLOCK if verdicts == [1.0] else ALLOW)
    regression = LogisticRegression(
        featuresCol="slots", labelCol="block", regParam=REGULARISATION, maxIter=ITERATIONS, standardization=False
    )
    return Model(regression.fit(_hashed(known)))


def with_rule(urls: DataFrame, rules: Sequence[Rule], host: str = "host", path: str = "path") -> DataFrame:
    """``urls`` (with a host and a path) and the fields ``rule`` and ``ruled`` of the longest rule that fits, else null."""
    spark = urls.sparkSession
    by_labels: dict[int, list[tuple]] = {}
    for rule_host, rule_path, verdict in rules:
        if verdict not in (ALLOW, BLOCK) or not rule_host:
            raise ValueError(f"no host, or neither {ALLOW} nor {BLOCK}: {(rule_host, rule_path, verdict)}")
        own = rule_host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
        size = len(own) + len(rule_path)
        by_labels.setdefault(own.count(".") + 1, []).append((own, size, len(own), verdict == BLOCK, own + rule_path, rule_path))
    found, fields = urls, []
    for labels, rows in sorted(by_labels.items()):
        schema = "rule_host string, size int, host_size int, block boolean, rule string, rule_path string"
        table = spark.createDataFrame(rows, schema).groupBy("rule_host")
        table = table.agg(F.collect_list(F.struct("size", "host_size", "block", "rule", "rule_path")).alias(f"rules_{labels}"))
        table = F.broadcast(table) if len(rows) <= BROADCAST_RULES else table
        last = F.substring_index(F.col(host), ".", -labels)
        found = found.join(table, last == F.col("rule_host"), "left").drop("rule_host")
        fields.append(f"rules_{labels}")
    if not fields:
        return found.withColumns({"rule": F.lit(None).cast("string"), "ruled": F.lit(None).cast("string")})
    none = F.array().cast("array<struct<size:int,host_size:int,block:boolean,rule:string,rule_path:string>>")
    every = F.concat(*(F.coalesce(F.col(f), none) for f in fields))
    best = F.array_max(F.filter(every, lambda r: F.startswith(F.col(path), r["rule_path"])))
    ruled = F.when(best["block"], BLOCK).when(~best["block"], ALLOW)
    return found.withColumns({"rule": best["rule"], "ruled": ruled}).drop(*fields)


def judge(pages: DataFrame, rules: Sequence[Rule], model: Model, url: str = "url") -> DataFrame:
    """(row, host, path, rule, verdict, block_score) for every row of ``pages``, ``row`` a struct of its columns.

    ``block_score`` is the model's probability, also where a rule decides.
    """
    host, path = host_and_path(F.col(url))
    cut = pages.select(F.struct(*pages.columns).alias("row"), host.alias("host"), path.alias("path"))
    found = with_rule(cut, rules)
    if model.regression is None:
        score = F.lit(float(model.only == BLOCK))
    else:
        found = model.regression.transform(_hashed(found.withColumn("grams", grams(F.col("host"), F.col("path")))))
        score = vector_to_array("probability")[1]
    verdict = F.coalesce("ruled", F.when(score >= 0.5, BLOCK).otherwise(ALLOW))
    return found.select("row", "host", "path", "rule", verdict.alias("verdict"), score.alias("block_score"))
