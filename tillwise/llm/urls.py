"""URL filters: rules on hosts and paths, and a logistic regression on hashed character n-grams.

The host is what stands after the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased; the path follows up to
`?`, `#` or the end. A null url, or one without `://`, has an empty host and path. A rule fits its host and all
subdomains where the path starts with the rule's; the longest fitting rule decides. Where none fits, the model does: the
probability that a url is unwanted, from the distinct hashed n-grams of its host and path, trained on a small labelled
table whose hosts are made up. Everything is built-in expressions on the url, in time linear in its length; the rules and the weights are
literals of bounded size. Equal rows get equal verdicts, an empty table gives no rows, columns with the names of added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.common import fresh_names, quoted

GRAM = 4
BUCKETS = 2048
#: At most so many labelled urls are used for training (those with the smallest hash).
SAMPLE_ROWS = 4_000
REGULARISATION = 0.001

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: The small labelled table, made of hosts and paths of two kinds. A url is unwanted if its host or its path is.
UNWANTED_HOSTS = (
    "megacasino casino-palace royalcasino casino24 grand-casino pokerstars poker-rooms luckyslots slots-online jackpot-city betting-tips sportsbets livebets bets24 roulette-club "
    "adultvideos adult-dating adult-chat pornhost porn-movies xxxclips xxx-cams sexcams hot-escorts "
    "discountpills pills24 pharmacy-deals viagra-shop cheapmeds diet-pills cheap-cialis cheap-replicas "
    "spam-mailer spamhost bulkspam linkfarm content-farm adserver ads-delivery banner-ads popup-ads tracker-pixel clicktrack track-visitors "
    "warez-download free-cracks keygens malware-drop win-prizes win-a-phone freegiveaway free-spins payday-loans"
).split()
#: Common topics of sites, and the hundred most frequent English nouns: a vocabulary chosen without regard to any table.
WANTED_HOSTS = (
    "wiki encyclopedia python-docs daily-news university city-library gardening recipes weather museum science-journal travel-notes writers town-council "
    "books music forum linux codeproject maps football energy climate kitchen sports economy engineering medicine "
    "chemistry astronomy philosophy geography painting cinema photography architecture cycling hiking fishing "
    "time year people way day man thing woman life child world school state family student group country problem hand part place case week company "
    "system program question work government number night point home water room mother area money story fact month lot right study book eye job word "
    "business issue side kind head house service friend father power hour game line end member law car city community name president team minute idea "
    "kid body information back parent face others level office door health person art war history party result change morning reason research girl guy "
    "moment air teacher force education"
).split()
UNWANTED_PATHS = (
    "casino/poker-bonus", "games/online-casino.html", "slots/free-spins", "bets/football-betting-tips", "xxx/porn-videos", "adult/cams/1", "tube/sex-movies",
    "buy/cheap-viagra", "pharmacy/pills.html", "offers/win-free-prize", "download/warez-keygen", "ads/click.php", "track/pixel.gif", "spam/unsubscribe",
)
WANTED_PATHS = (
    "", "en/1", "de/25.html", "es/7/", "fr/31", "wiki/History_of_science", "docs/guide/install.html", "news/2024/05/council-meets", "articles/climate-report", "blog/reading-list",
    "recipes/apple-pie", "books/author/12", "sports/football-results", "about",
)
PREFIXES, DOMAINS = ("", "www.", "blog.", "m."), ("com", "org", "example.com", "example.org", "example.net")


def labelled_pairs() -> list[tuple[str, int]]:
    """Hosts of both kinds with paths of both kinds, dealt out in turn so that every part meets many others."""
    rows = []
    for label, hosts in ((1, UNWANTED_HOSTS), (0, WANTED_HOSTS)):
        for i, name in enumerate(hosts):
            for j in range(10 if label == 0 else 20):
                bad_path = label == 0 and j % 5 == 4
                paths = UNWANTED_PATHS if bad_path else WANTED_PATHS
                host = f"{PREFIXES[(i + j) % 4]}{name}.{DOMAINS[(i + 2 * j) % 5]}"
                rows.append((f"https://{host}/{paths[(5 * i + j) % len(paths)]}", 1 if bad_path else label))
    return rows


LABELLED = labelled_pairs()


@dataclass(frozen=True)
class Model:
    """Weight of every bucket, and the intercept."""

    weights: tuple[float, ...]
    intercept: float


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def buckets(host: Column, path: Column, gram: int = GRAM, count: int = BUCKETS) -> Column:
    """Distinct hashed n-grams of the host, between marks, and of the path; short strings are one gram."""

    def grams(text: Column, prefix: str) -> Column:
        # Cut once: substrings by position would count the characters before each again. Bound, as a body of a lambda is evaluated for every element.
        bound = F.array(F.split(text, ""))

        def hashed(letters: Column) -> Column:
            last = F.greatest(F.size(letters) - gram, F.lit(0))

            def one(i: Column) -> Column:
                parts = [F.coalesce(F.get(letters, i + k), F.lit("")) for k in range(gram)]
                return F.pmod(F.xxhash64(F.concat(F.lit(prefix), *parts)), F.lit(count)).cast("int")

            return F.transform(F.sequence(F.lit(0), last), one)

        return F.element_at(F.transform(bound, hashed), 1)

    marked = F.concat(F.lit("^"), host, F.lit("$"))
    return F.array_distinct(F.concat(grams(marked, "h"), grams(F.regexp_replace(path, "[0-9]+", "0"), "p")))


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, url: str = "url", label: str = "label") -> Model:
    """Logistic regression on at most `sample_rows` distinct labelled urls; equal urls count once, with the lower label."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rows = (
        labelled.filter(F.col(label).isNotNull())
        .groupBy(F.coalesce(F.col(url), F.lit("")).alias("url"))
        .agg(F.min(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("url"), "url")
        .limit(sample_rows)
    )
    found = buckets(host_of(F.col("url")), path_of(F.col("url")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.array_contains(F.col("found"), i).cast("double"))
    each = rows.select("url", "label", F.explode(found).alias("bucket"))
    vectors = each.groupBy("url", "label").agg(F.collect_set("bucket").alias("found")).select(array_to_vector(dense).alias("features"), "label", "url")
    fitted = LogisticRegression(maxIter=50, regParam=REGULARISATION, standardization=False).fit(vectors.coalesce(1).sortWithinPartitions("url"))
    return Model(tuple(float(x) for x in fitted.coefficients.toArray()), float(fitted.intercept))


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED, "url string, label int")


def probability(host: Column, path: Column, model: Model) -> Column:
    weights = F.split(F.lit(",".join(map(repr, model.weights))), ",").cast("array<double>")
    total = F.aggregate(buckets(host, path), F.lit(model.intercept), lambda sum_, i: sum_ + F.element_at(weights, i + 1))
    return 1 / (1 + F.exp(-total))


def rule_name(host: str, path: str) -> str:
    return host + path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule's name and action; null where none fits. Of equally long ones the first by name."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda x: (len(x[1] + x[2]), x[1] + x[2]), reverse=False):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_name(rule_host, rule_path))).otherwise(name)
        action = F.when(fits, F.lit(verdict)).otherwise(action)
    return name, action


def judge(pages: DataFrame, model: Model, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url", least: float = 0.5) -> DataFrame:
    """Add `host`, `path`, `rule`, `unwanted` (the model's probability) and `verdict`; equal columns are replaced."""
    added = ("host", "path", "rule", "unwanted", "verdict")
    (source,) = fresh_names(pages, "url_in", avoid=added)
    kept = [F.col(quoted(x)) for x in pages.columns if x.lower() not in added]
    fed = pages.select(*kept, F.col(quoted(url)).alias(source))
    split = fed.select("*", host_of(F.col(source)).alias("host"), path_of(F.col(source)).alias("path"))
    rule, action = matching_rule(F.col("host"), F.col("path"), rules)
    scored = split.select("*", rule.alias("rule"), probability(F.col("host"), F.col("path"), model).alias("unwanted"), action.alias("verdict"))
    chosen = F.coalesce("verdict", F.when(F.col("unwanted") > least, F.lit("block")).otherwise("allow"))
    return scored.withColumn("verdict", chosen).drop(source)
