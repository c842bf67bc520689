"""URL filters: given host and path rules first, then association rules that FP-growth mines from labelled URLs."""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from logloom.llm.common import stored

ALLOW, BLOCK = "allow", "block"
_SALTS = 64
#: Copies of a transaction that one row may stand for before it is spread.
_COPIES = 10_000


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where it is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def given(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule (its host and path together) and verdict of the longest (verdict, host, path) that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, suffix, prefix in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(suffix + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a whole URL: scheme, host and its parent domains, its first label, path segments with their place,
    file extension, query names and name-value pairs, fragment. None for null and for what has no ``://``.
    """
    host, path = parts(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))),
        lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, -F.least(i, F.size(labels)), F.least(i, F.size(labels))), ".")),
    )
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    placed = F.transform(segments, lambda x, i: F.concat_ws(":", F.lit("path"), i.cast("string"), x))
    extension = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda x: x != "")
    names = F.transform(pairs, lambda x: F.concat(F.lit("name:"), F.substring_index(x, "=", 1)))
    fragment = F.regexp_extract(url, r"(?s)#(.+)$", 1)

    def some(label: str, value: Column) -> Column:
        return F.when(value != "", F.array(F.concat(F.lit(label), value))).otherwise(F.array().cast("array<string>"))

    found = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1)))),
        F.when(F.size(labels) > 0, F.concat(suffixes, F.array(F.concat(F.lit("label:"), F.get(labels, F.lit(0)))))).otherwise(
            F.array().cast("array<string>")
        ),
        placed,
        some("extension:", extension),
        names,
        F.transform(pairs, lambda x: F.concat(F.lit("pair:"), x)),
        some("fragment:", fragment),
    )
    return F.when(F.locate("://", url) > 0, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def mine(
    labelled: DataFrame,
    url: str = "url",
    bad: str = "bad",
    min_count: int = 20,
    min_share: float = 0.0002,
    min_confidence: float = 0.6,
    most_items: int = 9,
    most_tokens: int = 3,
) -> DataFrame:
    """``(antecedent, confidence, count)``: all token combinations after which a URL is bad, each of them minimal.

    ``labelled`` has URLs and a boolean; rows with a null in either are left out. A combination has ``most_tokens`` tokens at
    most, ``max(min_count, min_share * rows)`` bad URLs and ``min_confidence``, counted over all tokens of all rows; one that
    contains another one adds nothing and goes. Equal ones are given once, in any order.

    FP-growth lists every subset of tokens that are frequent together, so what bounds it is the rule's length, not the URL:
    a bad URL with more than ``most_items`` frequent tokens becomes several transactions that hold each of its combinations of
    ``most_tokens`` at least once. So FP-growth finds all combinations with enough bad URLs, perhaps more, and those are
    counted again. Tokens that stand in exactly the same URLs are mined as one and written out at the end.
    """
    rows = labelled.select(F.col(url).alias("url"), F.col(bad).cast("boolean").alias("bad")).dropna()
    # Equal URLs are folded to counts before anything is exploded; a hot URL is one row per label from here on.
    folded = stored(rows.groupBy("url", "bad").agg(F.count("*").alias("n")).withColumn("tokens", tokens(F.col("url"))), "labelled-urls")
    total = folded.agg(F.sum("n")).first()[0] or 0
    least = max(min_count, int(min_share * total))
    empty = labelled.sparkSession.createDataFrame([], "antecedent array<string>, confidence double, count long")
    if least > total:
        return empty
    of_bad = F.when(F.col("bad"), F.col("n")).otherwise(0)
    # Two independent hashes of the URLs that hold a token: equal ones mean the same URLs.
    same = [F.bit_xor(F.xxhash64(F.lit(seed), "url", "bad")).alias(f"urls{seed}") for seed in (1, 2)]
    weight = (
        folded.select("url", "bad", "n", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.sum("n").alias("all"), F.sum(of_bad).alias("of_bad"), *same)
        .filter(F.col("of_bad") >= least)
    )
    kinds = ("all", "of_bad", "urls1", "urls2")
    weight = stored(weight.join(weight.groupBy(*kinds).agg(F.min("token").alias("one")), list(kinds)).select("token", "one", "all"), "frequent-tokens")
    ones = weight.filter("token = one").select("token", "all")
    # A token that most URLs have would be one task: URLs are dealt over salts, and the few frequent tokens stand under each.
    salted = ones.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salt = F.pmod(F.xxhash64("url"), F.lit(_SALTS)).cast("int").alias("salt")
    chosen = (
        folded.filter("bad")
        .select("url", "n", F.explode("tokens").alias("token"), salt)
        .join(salted, ["token", "salt"])
        .groupBy("url", "n")
        .agg(F.array_sort(F.collect_list("token")).alias("items"))
        .select(F.explode(_covering(F.col("items"), most_items, most_tokens)).alias("items"), "n")
        .groupBy("items")
        .agg(F.sum("n").alias("n"))
    )
    # FP-growth takes a row per transaction. Equal ones are written out again only for it, a bounded number of them at a time.
    parts_ = chosen.select("items", "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {_COPIES})")).alias("part"))
    spread = parts_.repartition(F.xxhash64("items", "part")).select(
        "items", F.explode(F.expr(f"sequence(1L, least({_COPIES}L, n - part * {_COPIES}))")).alias("copy")
    )
    baskets = stored(spread.select("items"), "baskets")
    n_baskets = baskets.count()
    if not n_baskets:
        return empty
    # The share is put a little lower, so that rounding loses no combination with exactly enough URLs.
    model = FPGrowth(itemsCol="items", minSupport=max(0.0, min(1.0, (least - 0.5) / n_baskets)), minConfidence=1.0).fit(baskets)
    sets = model.freqItemsets.filter(F.size("items") <= most_tokens).select(F.array_sort("items").alias("antecedent"))
    counted = _recounted(stored(sets, "candidate-rules"), folded, ones.withColumnRenamed("all", "count"))
    rules = _minimal(stored(counted.filter((F.col("count") >= least) & (F.col("confidence") >= min_confidence)), "rules"))
    return stored(_written_out(rules, weight, most_tokens), "rules-of-all-tokens")


def _covering(items: Column, most_items: int, most_tokens: int) -> Column:
    """Subsets of at most ``most_items`` items that hold every combination of ``most_tokens`` of them at least once.

    The items are cut into groups of a ``most_tokens``-th of ``most_items``; each choice of ``most_tokens`` groups is a subset.
    """
    size = max(1, most_items // most_tokens)
    groups = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int")), lambda g: F.slice(items, g * size + 1, F.lit(size))
    )

    def choices(above: Column, left: int, taken: Column) -> Column:
        if not left:
            return F.array(taken)
        later = F.filter(F.transform(groups, lambda g, i: F.struct(i.alias("i"), g.alias("g"))), lambda x: x["i"] > above)
        return F.flatten(F.transform(later, lambda x: choices(x["i"], left - 1, F.concat(taken, x["g"]))))

    none = F.array().cast("array<string>")
    return F.when(F.size(items) <= size * most_tokens, F.array(items)).otherwise(choices(F.lit(-1), most_tokens, none))


def _written_out(rules: DataFrame, weight: DataFrame, most_tokens: int) -> DataFrame:
    """Each rule once for every choice of a token among those that stand in the same URLs as the one mined for them."""
    members = weight.select(F.col("one"), "token")
    out = rules.withColumn("antecedent", F.array_sort("antecedent")).withColumn("rest", F.col("antecedent")).withColumn("antecedent", F.array().cast("array<string>"))
    for _ in range(most_tokens):
        # Rules that have no token left look none up.
        out = (
            out.withColumn("one", F.get("rest", F.lit(0)))
            .join(members, "one", "left")
            .withColumn("antecedent", F.when(F.col("token").isNull(), F.col("antecedent")).otherwise(F.concat("antecedent", F.array("token"))))
            .withColumn("rest", F.when(F.size("rest") > 0, F.slice("rest", F.lit(2), F.size("rest"))).otherwise(F.col("rest")))
            .drop("one", "token")
        )
    return out.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "count")


def _recounted(rules: DataFrame, folded: DataFrame, common: DataFrame) -> DataFrame:
    """The rules with confidence and count over whole token sets: each is listed under its rarest token, as in ``fired``."""
    each = rules.select("antecedent", F.explode("antecedent").alias("token"))
    index = (
        each.join(common, "token").groupBy("antecedent").agg(F.min(F.struct("count", "token")).alias("rarest"))
        .select("antecedent", F.col("rarest.token").alias("token"))
    )
    # Rules of a common token would be one task: URLs are dealt over salts here as well.
    salted = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    dealt = folded.select("bad", "n", "tokens", F.explode("tokens").alias("token"), F.pmod(F.xxhash64("url"), F.lit(_SALTS)).cast("int").alias("salt"))
    met = dealt.join(salted, ["token", "salt"]).filter(F.size(F.array_except("antecedent", "tokens")) == 0)
    of_bad = F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0))
    return met.groupBy("antecedent").agg((of_bad / F.sum("n")).alias("confidence"), of_bad.cast("long").alias("count"))


def _minimal(rules: DataFrame) -> DataFrame:
    """Rules that contain no other rule: each looks its own subsets up (an antecedent has few tokens)."""
    larger = rules.filter(F.size("antecedent") > 1)
    proper = F.expr(
        "transform(sequence(1, cast(power(2, size(antecedent)) as int) - 2),"
        " mask -> filter(antecedent, (x, i) -> cast(floor(mask / power(2, i)) as int) % 2 = 1))"
    )
    subsets = larger.select("antecedent", F.explode(proper).alias("subset"))
    implied = subsets.join(rules.select(F.col("antecedent").alias("subset")), "subset", "left_semi").select("antecedent").distinct()
    return rules.join(implied, "antecedent", "left_anti")


def fired(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct URLs of ``urls(url)`` that a rule fits, by an inverted index.

    A rule is listed under its rarest token only, so what a common token meets are the rules made of tokens as common; the
    rest of the antecedent is then looked up in the URL's own tokens.
    """
    distinct = stored(urls.select("url").dropna().distinct().withColumn("tokens", tokens(F.col("url"))), "urls")
    each = rules.select("antecedent", F.explode("antecedent").alias("token"))
    wanted = each.select("token").distinct()
    common = distinct.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").count()
    index = stored(
        each.join(common, "token").groupBy("antecedent").agg(F.min(F.struct("count", "token")).alias("rarest"))
        .select("antecedent", F.col("rarest.token").alias("token")),
        "rule-index",
    )
    meets = distinct.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    return meets.filter(F.size(F.array_except("antecedent", "tokens")) == 0).select("url").distinct()


def judge(
    pages: DataFrame, mined: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every page: the longest given rule's verdict, else ``block`` if a mined rule fits, else
    ``allow``.

    Null URLs and such without ``://`` have an empty host and path; only a rule for an empty host could fit them, so they
    are allowed. Repeated rows each return a row. An empty table gives an empty one. Other columns are not read.
    """
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"))
    host, path = parts(F.col("url"))
    seen = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = given(F.col("host"), F.col("path"), rules)
    seen = seen.withColumn("rule", rule).withColumn("given", verdict)
    blocked = stored(fired(seen.filter("given is null").select("url"), mined).withColumn("blocked", F.lit(True)), "blocked-urls")
    joined = seen.join(blocked, "url", "left")
    found = F.coalesce("given", F.when(F.col("blocked"), F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return joined.select("id", "host", "path", "rule", found.alias("verdict"))
