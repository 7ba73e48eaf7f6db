"""Verdicts on URLs: rules by host and path, else a logistic regression on character n-grams.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path:
what follows the host up to ``?``, ``#`` or the end. A null URL or one without ``://`` has neither;
both are then empty.

A rule names a host and the start of a path. It fits its host and all subdomains where the path
starts with the rule's. Of fitting rules the one with the longest text (host and path) decides;
equally long ones, by their text. Where none fits, the URL is blocked if the model's
probability is at least 0.5.

The labelled table is a parameter (``url``, ``blocked``), as its names decide what is blocked; ``labelled`` gives a small
one, whose verdicts go no further than its kinds of names.

The model is Spark's logistic regression on hashed runs of 3 to 5 characters of the host (with
its ends marked) and of 3 of the path (digits as 0), trained from a small labelled table of URLs, whose
size does not depend on what is judged. Labels other than 0 and 1 are ignored; with only one kind,
or none, nothing is blocked but by rules. Repeated rows are judged each on its own. Other columns pass
unchanged, except those named like a result.

Everything runs on DataFrame expressions and Spark's own classes.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.rows import quoted

FEATURES = 1 << 12
THRESHOLD = 0.5

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: A small labelled table for those who have none: names of sites to block and to allow, with and
#: without hyphens on both sides, each in all the forms below, so that only the names tell the two apart.
BLOCKED_SITES = (
    "casino-royal online-casino megacasino big-win-slots slotsmania win-money-fast poker-bets pokerking "
    "sports-bets bet365play free-bets-now free-lottery jackpotcity cheap-meds viagra cialisonline "
    "viagra-shop cheap-watches diet-pills pills-online spam-mailer spamlinks link-farm content-farm "
    "contentfarm adult-chat adultvideos pornhubs sexcams xxx-cams x-rated ads-server adserver banner-ads "
    "click-track track-pixel clicktracker payday-loans fastloans replica-bags"
).split()
ALLOWED_SITES = (
    "weather weather-report library public-library theatre city-theatre nation stationery northern "
    "thinking another reading-group gathering t-online jean-paul anne-marie saint-denis baden-baden "
    "rolls-royce coca-cola open-source e-learning how-to-cook together therapist thesis interest "
    "enlighten question history local-history breathe thousand wherever ambition sensible thread "
    "heathland that-nation thatone"
).split()
FORMS = [
    "https://{}.example.com/en/12",
    "http://www.{}.example.org/de/4.html",
    "https://blog.{}.example.net/es/90/",
    "http://m.{}.example.com/fr/31?page=2",
    "https://shop.{}.example.net/en/7#top",
    "http://{}.example.org/es/55.html",
    "https://www.{}.example.net/fr/8",
    "http://m.{}.example.net/de/61/",
    "https://m.{}.example.org/en/72",
]


def labelled(spark: SparkSession) -> DataFrame:
    sites = [(name, 1) for name in BLOCKED_SITES] + [(name, 0) for name in ALLOWED_SITES]
    rows = [(form.format(name), blocked) for name, blocked in sites for form in FORMS]
    return spark.createDataFrame(rows, "url string, blocked int")


def host(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, _URL, 1), F.lit(""))
    return F.translate(found, _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _grams(text: Column, size: int, mark: str) -> Column:
    """All runs of ``size`` characters, marked so that kinds of runs differ."""
    last = F.length(text) - size + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda at: F.concat(F.lit(mark), F.substr(text, at, F.lit(size))))


def ngrams(host: Column, path: Column) -> Column:
    ended = F.when(host != "", F.concat(F.lit("^"), host, F.lit("$"))).otherwise(F.lit(""))
    plain = F.regexp_replace(path, "[0-9]", "0")
    return F.concat(*[_grams(ended, size, "h") for size in (3, 4, 5)], _grams(plain, 3, "p"))


def fitting_rule(host: Column, path: Column, rules: list[Rule], result) -> Column:
    """``result`` of the rule that decides, null where none fits."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        inside = (host == rule.host) | host.endswith("." + rule.host)
        fits = inside & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(result(rule))).otherwise(chosen)
    return chosen


def trained(table: DataFrame):
    """A fitted model, or None without labels of both kinds."""
    rows = table.where("blocked in (0, 1)").select(
        ngrams(host(F.col("url")), path(F.col("url"))).alias("grams"),
        F.col("blocked").cast("double").alias("label"),
    )
    if rows.select("label").distinct().count() < 2:
        return None
    hashed = _hashing().transform(rows)
    return LogisticRegression(regParam=0.01, maxIter=50, featuresCol="features").fit(hashed)


def _hashing() -> HashingTF:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)


def url_filter(pages: DataFrame, rules: list[Rule], table: DataFrame) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule``, ``probability`` and ``verdict``."""
    model = trained(table)
    url = F.col("url").cast("string")
    frame = pages.select(
        F.struct(*[F.col(quoted(name)) for name in pages.columns]).alias("row"),
        host(url).alias("host"),
        path(url).alias("path"),
    )
    if model is None:
        frame = frame.withColumn("chance", F.lit(0.0))
    else:
        grams = frame.withColumn("grams", ngrams(F.col("host"), F.col("path")))
        scored = model.transform(_hashing().transform(grams))
        frame = scored.withColumn("chance", vector_to_array("probability")[1])
    by_host = F.col("host"), F.col("path"), rules
    judged = F.when(F.col("chance") >= THRESHOLD, F.lit("block")).otherwise(F.lit("allow"))
    results = {
        "host": F.col("host"),
        "path": F.col("path"),
        "rule": fitting_rule(*by_host, lambda rule: rule.text),
        "probability": F.col("chance"),
        "verdict": F.coalesce(fitting_rule(*by_host, lambda rule: rule.verdict), judged),
    }
    kept = [F.col("row")[name].alias(name) for name in pages.columns if name not in results]
    return frame.select(*kept, *[value.alias(name) for name, value in results.items()])
