"""The registered queries of this package: each applies its operator to its whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import langmix, mixing, nbsvm, negatives, ngramlm, ngramratio, pieces, secretscan, simhash, tokencount, urlrules, vectors, whitening
from logloom.llm.common import held_out, table


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file; it is installed with a package of its own, on executors as well."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langmix.fit(documents.filter(~held_out("doc_id")))
    found = langmix.predict(documents, model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), distance=4, shingle=4)
    return found.select(
        F.col("id").alias("doc_id"), simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def quality_model(documents: DataFrame, labels: DataFrame) -> nbsvm.Model:
    """Learned from rows that are not held out, as every query that judges quality does."""
    return nbsvm.fit(documents.filter(~held_out("doc_id")), labels.filter(~held_out("doc_id")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_model(documents, table(spark, sf_dir, "labels"))
    return nbsvm.score(documents, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), epochs=3, seed=1)
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > 1024)


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted are the documents that ``labels`` marks as good, raw is every document."""
    documents = table(spark, sf_dir, "documents")
    weights = ngramratio.fit(documents, table(spark, sf_dir, "labels").filter("quality = 1"))
    return ngramratio.judge(documents, weights).drop("ratio")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < secretscan.KINDS.index("random"))

    def number(kind: int):
        found = F.size(F.filter("spans", lambda s: s["kind"] == kind))
        return found.cast("long").alias(f"n_{secretscan.KINDS[kind]}")

    return found.select(
        F.col("id").alias("doc_id"),
        *map(number, range(3)),
        F.sha2(secretscan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secretscan.listed(F.col("spans")).alias("spans"),
    )


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)
    return found.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


#: (verdict, host, path) of the given rules.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad URLs to learn from are those of pages whose label, by the same id, is of low quality or toxic."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labelled = pages.join(labels, F.col("page_id") == F.col("doc_id")).select("url", bad.alias("bad"))
    found = urlrules.judge(pages, urlrules.mine(labelled), URL_RULES)
    return found.withColumnRenamed("id", "page_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where a long can't hold it (from some ten million vectors on); ``deviation_exact`` holds it always."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=32, scale=64, shift=1_000_000, weights="count")
    return found.select(
        F.col("id").alias("vec_id"),
        "component",
        "n",
        F.expr("try_cast(deviation as bigint)").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
        F.col("deviation").alias("deviation_exact"),
    )


def op12_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the documents that are not held out; cases as ``ngramlm.score`` states them."""
    found = ngramlm.score(table(spark, sf_dir, "documents"), ~held_out("doc_id", 1))
    return found.select(
        F.col("id").alias("doc_id"), held_out("id", 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 50; where it is divisible by 7, the label moves on by one of ten first.

    Null ids are no anchors and keep their label; other cases as ``negatives.mine`` states them.
    """
    vec_id = F.col("vec_id")
    label = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), vec_id % 50 == 0)


QUERIES = {
    "op1_language": op1_language,
    "op2_simhash": op2_simhash,
    "op3_quality": op3_quality,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_mixing": op5_mixing,
    "op6_tokens": op6_tokens,
    "op7_rules": op7_rules,
    "op8_secrets": op8_secrets,
    "op9_vectors": op9_vectors,
    "op10_urls": op10_urls,
    "op11_whitening": op11_whitening,
    "op12_lm": op12_lm,
    "op13_negatives": op13_negatives,
}

#: DuckDB SQL of the queries that SQL can express. The others are held against plain Python in the tests.
ORACLES: dict[str, str] = {
    "op5_mixing": r"""
        with sizes as (
            select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
            from documents
        ),
        totals as (
            select source, sum(size)::bigint as source_size, 3 * sum(size)::bigint as cap,
                [5, 2, 1][(row_number() over (order by encode(source) nulls last) - 1) % 3 + 1] as weight
            from sizes group by source
        ),
        -- The level of the water when the sources with the lowest caps by weight are clamped; the first one that leaves no
        -- other source above its cap is the one that clamping round by round reaches.
        clamped as (
            select *, row_number() over (order by cap / weight, source) as place, coalesce(sum(cap) over before, 0)::bigint as caps,
                (sum(weight) over () - coalesce(sum(weight) over before, 0))::bigint as free
            from totals window before as (order by cap / weight, source rows between unbounded preceding and 1 preceding)
        ),
        level as (
            select coalesce(arg_min(l, place), 0) as l
            from (select place, ((select sum(size) from sizes) - caps) / free as l, cap / weight as most from clamped)
            where l <= most
        ),
        goals as (
            select source, source_size, least(l * weight, cap::double) as target from totals, level
        ),
        whole as (
            select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from goals
        ),
        placed as (
            select s.doc_id, s.size, w.source_size, w.target, w.whole, w.target - w.whole * w.source_size as rest,
                sum(s.size) over (partition by s.source order by md5('1:' || coalesce(s.doc_id::varchar, 'null'))) - s.size as before
            from sizes s join whole w on s.source is not distinct from w.source
        )
        select doc_id, size, source_size, target,
            (size * (whole + case when rest > 0 and before + size / 2 <= rest then 1 else 0 end))::bigint as taken
        from placed
    """,
    "op13_negatives": """
        with fit as (
            select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda c: floor(256 * c::double)) as x
            from embeddings
            where label is not null and embedding is not null
                and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
        ),
        pairs as (
            select a.r as anchor, a.vec_id as anchor_id, a.label as own, b.r as other, b.vec_id, b.label,
                list_inner_product(a.x, b.x)::bigint as score
            from fit a join fit b on len(a.x) = len(b.x) and a.r <> b.r
            where a.vec_id % 50 = 0
        ),
        positives as (
            select * from pairs where label = own
            qualify row_number() over (partition by anchor order by score desc, vec_id nulls last) <= 5
        )
        select p.anchor_id, p.vec_id as positive_id,
            (row_number() over (partition by p.anchor, p.other order by n.score desc, n.vec_id nulls last))::int as rank,
            n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
        from positives p join pairs n on n.anchor = p.anchor and n.label <> n.own
            and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
        qualify rank <= 3
    """,
}
