import itertools
import re

from pyspark.sql import functions as F

from logloom.llm import queries, urlrules
from logloom.llm.common import table

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def given(host, path, rules):
    best = None
    for verdict, suffix, prefix in rules:
        if (host == suffix or host.endswith("." + suffix)) and path.startswith(prefix):
            if best is None or len(suffix + prefix) > len(best[0]):
                best = (suffix + prefix, verdict)
    return best or (None, None)


def test_query_against_plain_rules(spark):
    urls = {r.page_id: r.url for r in table(spark, SF, "pages").collect()}
    rows = queries.op10_urls(spark, SF).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path = parts(urls[r.page_id])
        rule, verdict = given(host, path, queries.URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or "allow")  # the labels say nothing about these urls, so no mined rule stands
    assert {r.verdict for r in rows if r.rule} == {"allow", "block"}


def plain_rules(rows, min_count, min_confidence):
    """All token combinations, by brute force; then those without a smaller one."""
    found = set()
    every = {t for tokens, _ in rows for t in tokens}
    for size in (1, 2, 3):
        for combo in itertools.combinations(sorted(every), size):
            over = [bad for tokens, bad in rows if set(combo) <= tokens]
            if sum(over) >= min_count and sum(over) >= min_confidence * len(over):
                found.add(combo)
    return {c for c in found if not any(set(d) < set(c) for d in found)}


def test_mined_rules_equal_brute_force(spark):
    rows = []
    for i in range(300):
        tld, lang, name = ["com", "net"][i % 2], ["en", "de", "fr"][i % 3], f"s{i % 7}"
        bad = (tld == "net" and lang == "de" and i % 11 != 0) or (name == "s3" and lang == "fr")
        rows.append((f"http://{name}.x.{tld}/{lang}", bad))
    rows += [(None, True), ("http://a.b", None)] + [("http://hot.x.com/en", False)] * 150
    df = spark.createDataFrame(rows, "url string, bad boolean").repartition(3)
    mined = urlrules.mine(df, min_count=8, min_share=0.0, min_confidence=0.9).collect()
    tokens = {r.url: set(r.t) for r in df.dropna().select("url", urlrules.tokens(F.col("url")).alias("t")).distinct().collect()}
    clean = [(tokens[u], b) for u, b in rows if u is not None and b is not None]
    want = plain_rules(clean, 8, 0.9)
    assert {tuple(r.antecedent) for r in mined} == want and want
    # Every url that contains a rule, and no other, is blocked.
    table_ = spark.createDataFrame([tuple(r) for r in mined], "antecedent array<string>, confidence double, count long")
    judged = urlrules.judge(df.withColumn("page_id", F.lit(1)), table_, []).join(df.select("url").distinct(), F.lit(True)).select("verdict").count()
    assert judged
    hit = {r.url for r in urlrules.fired(df.select("url"), table_).collect()}
    assert hit == {u for u, t in tokens.items() if any(set(c) <= t for c in want)}


def test_common_tokens_do_not_explode(spark):
    """Many urls with the same thirty tokens: only the chosen few are mined together."""
    long = "http://h.x.com/" + "/".join(f"p{k}" for k in range(30))
    df = spark.createDataFrame([(long, True)] * 200 + [("http://other.org/", False)] * 200, "url string, bad boolean")
    mined = urlrules.mine(df, most_items=6).collect()
    assert mined and all(len(r.antecedent) == 1 for r in mined)


def test_confidence_counts_urls_that_rank_other_tokens_higher(spark):
    """Clean urls hold the bad token too, but bring two tokens with larger shares into the mining."""
    rows = [("http://h.net/a", True)] * 80 + [("http://h.net/a", False)] * 20
    rows += [(f"http://h.net/a/{x}/{y}", False) for x, y in [("b", "c")] * 100]
    rows += [("http://q.org/z/b/c", True)] * 900
    df = spark.createDataFrame(rows, "url string, bad boolean")
    mined = {tuple(r.antecedent): r for r in urlrules.mine(df, most_items=2, min_share=0.0).collect()}
    assert mined and not any("host:h.net" in rule or "path:0:a" in rule for rule in mined)
    tokens = {r.url: set(r.t) for r in df.select("url", urlrules.tokens(F.col("url")).alias("t")).distinct().collect()}
    for rule, r in mined.items():
        over = [bad for url, bad in rows if set(rule) <= tokens[url]]
        assert r["count"] == sum(over) and abs(r.confidence - sum(over) / len(over)) < 1e-9


def test_rules_of_urls_with_thirty_frequent_tokens(spark):
    """The bad pair's tokens have low shares of their own, and each URL brings thirty frequent tokens."""
    import random

    random.seed(5)
    rows = []
    for i in range(400):
        values = [random.randrange(2) for _ in range(15)]
        bad = values[3] == values[11] == 1 and random.random() < 0.95 or random.random() < 0.05
        rows.append((f"http://h.x/?" + "&".join(f"k{k}={v}" for k, v in enumerate(values)), bad))
    df = spark.createDataFrame(rows * 2, "url string, bad boolean").repartition(3)
    mined = {tuple(r.antecedent): r for r in urlrules.mine(df, min_count=60, min_share=0.0, min_confidence=0.85).collect()}
    tokens = {r.url: set(r.t) for r in df.select("url", urlrules.tokens(F.col("url")).alias("t")).distinct().collect()}
    want = plain_rules([(tokens[u], b) for u, b in rows * 2], 60, 0.85)
    assert set(mined) == want and ("pair:k11=1", "pair:k3=1") in want


def test_covering_holds_every_combination(spark):
    for n, most, length in ((0, 9, 3), (1, 9, 3), (9, 9, 3), (10, 9, 3), (17, 9, 3), (11, 6, 2), (7, 2, 3)):
        items = [f"t{i:02}" for i in range(n)]
        df = spark.createDataFrame([(items,)], "items array<string>")
        found = df.select(urlrules._covering(F.col("items"), most, length).alias("c")).first().c
        assert all(len(c) <= max(most, length) and len(set(c)) == len(c) for c in found)
        for combo in itertools.combinations(items, length):
            assert any(set(combo) <= set(c) for c in found), (n, combo)


def test_hot_transaction_is_spread(spark, monkeypatch):
    monkeypatch.setattr(urlrules, "_COPIES", 7)
    rows = [("http://a.net/x", True)] * 100 + [("http://a.net/y", False)] * 100
    mined = {tuple(r.antecedent): r["count"] for r in urlrules.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()}
    assert mined == {("path:0:x",): 100}


def test_query_blocks_by_what_it_mined(spark, tmp_path):
    """Labels planted on hosts, so that the query's own join gives rules."""
    pages = table(spark, SF, "pages").cache()
    host = urlrules.parts(F.col("url"))[0]
    top = pages.filter("url is not null").groupBy(host.alias("host")).count().orderBy(F.desc("count"), "host").limit(3).collect()
    hot = top[0].host
    poor = (host == hot).cast("int")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    pages.select(F.col("page_id").alias("doc_id"), (1 - F.coalesce(poor, F.lit(0))).alias("quality"), F.lit(0).alias("toxic")).write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    assert top[0]["count"] >= 20
    rows = queries.op10_urls(spark, str(tmp_path)).collect()
    judged = [r for r in rows if r.rule is None]
    assert all(r.verdict == ("block" if r.host == hot else "allow") for r in judged) and any(r.host == hot for r in judged)


def test_odd_rows(spark):
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.B.Com", "http://x?q=1#f", "http://x/a//b/?a=1&a=2&&=#", "http://" + "a" * 100_000 + "/p",
            "http://a.b/\n/c", "http://e.org/es/", "x://example.org/es/1"]
    df = spark.createDataFrame([(i % 11, u, "h", "v") for i, u in enumerate(urls)], "page_id int, url string, host string, verdict string")
    none = spark.createDataFrame([], "antecedent array<string>, confidence double, count long")
    rows = urlrules.judge(df, none, queries.URL_RULES).collect()
    assert sorted((r.host, r.path) for r in rows) == sorted(parts(u) for u in urls) and len(rows) == len(urls)
    assert {r.verdict for r in rows} == {"allow", "block"}
    assert all(r.t == [] for r in df.filter("url is null or not url like '%://%'").select(urlrules.tokens(F.col("url")).alias("t")).collect())
    assert urlrules.judge(df.limit(0), none, queries.URL_RULES).count() == 0
    assert urlrules.mine(df.select("url", F.lit(True).alias("bad")).limit(0)).count() == 0
