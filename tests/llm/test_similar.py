import itertools
import random
import re

import numpy as np

import corpus_pipeline
from logloom.llm import simhash, similar
from logloom.llm.common import table

SF = "/root/testdata/sf0.01"


def plain(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def kept_by_brute_force(rows):
    """Smallest id of each class of (id, text), all pairs compared."""
    sets = {i: plain(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = len(sets[a]), len(sets[b])
        if min(x, y) >= 0.8 * max(x, y) and jaccard(sets[a], sets[b]) >= 0.8:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i for i in sets if find(i) == i}


def copies(count=40, seed=3):
    """Texts with five copies each, of which 1 to 5 % of the words are changed; some pairs lie on either side of 0.8."""
    random.seed(seed)
    rows = []
    for _ in range(count):
        words = [f"w{random.randrange(3000)}" for _ in range(random.randrange(60, 400))]
        rows.append(" ".join(words))
        for k in range(1, 6):
            rows.append(" ".join(f"x{random.randrange(10**6)}" if random.random() < k / 100 else w for w in words))
    random.shuffle(rows)
    return list(enumerate(rows))


def test_stage_keeps_what_all_pairs_keep(spark):
    rows = copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect()]
    assert sorted(kept) == sorted(kept_by_brute_force(rows)) and 40 < len(kept) < len(rows)


def test_stage_on_a_given_table(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect()}
    assert kept == kept_by_brute_force(rows)


def test_a_shared_passage_is_no_link(spark):
    """Texts that hold one passage meet in bands; none is linked, and copies among them are found across classes."""
    random.seed(5)
    passage = " ".join(f"p{i}" for i in range(120))
    own = [" ".join(f"o{random.randrange(10**6)}" for _ in range(60)) for _ in range(60)]
    rows = [(i, f"{passage} {t}") for i, t in enumerate(own)] + [(100 + i, f"{passage} {t} end") for i, t in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect()}
    assert kept == set(range(60))


def test_wide_bands_are_split_until_copies_meet(spark, monkeypatch):
    """A passage that makes most of each text puts all texts into the same bands: splits find the copies, no step lists all pairs."""
    monkeypatch.setattr(similar, "WIDE", 4)
    random.seed(6)
    passage = " ".join(f"p{i}" for i in range(150))
    own = [" ".join(f"o{random.randrange(10**6)}" for _ in range(50)) for _ in range(80)]
    rows = [(i, f"{passage} {t}") for i, t in enumerate(own)]
    for k in range(1, 4):
        rows += [(100 * k + i, f"{passage} {' '.join(t.split()[: 50 - 2 * k])} end{k}") for i, t in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect()}
    assert kept == kept_by_brute_force(rows)


def test_a_wide_band_is_compared_whole(spark, monkeypatch):
    """All texts in one band: what stands for a class there is like none of the texts that link the others."""
    monkeypatch.setattr(similar, "WIDE", 4)
    monkeypatch.setattr(similar, "_CHUNK", 3)
    monkeypatch.setattr(similar, "bands", lambda hashes: [1])
    random.seed(7)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for k in range(30):
        chain = [f"o{k}-{i}" for i in range(200)]
        # Neighbours share about 0.85 of their shingles, texts two steps apart less than 0.8; the passage is in all of them.
        rows += [(10 * k + step, " ".join(passage + chain[14 * step : 14 * step + 110])) for step in random.sample(range(6), 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect()}
    assert kept == kept_by_brute_force(rows) and 30 < len(kept) < len(rows)


def test_links_are_followed_once(spark, monkeypatch):
    """Later classes begin with one link a text, not with all links that made the earlier ones."""
    joined, checked, connected, check = [], [], similar.connected, similar._checked
    monkeypatch.setattr(similar, "connected", lambda links: joined.append(links) or connected(links))
    monkeypatch.setattr(similar, "_checked", lambda *a: checked.append(check(*a)) or checked[-1])
    random.seed(4)
    texts = [[f"w{random.randrange(3000)}" for _ in range(200)] for _ in range(2)] * 25
    rows = [(i, " ".join(f"x{i}" if random.random() < 0.02 else w for w in words)) for i, words in enumerate(texts)]
    similar.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    star, narrow = checked[0].distinct().count(), checked[1].distinct().count()
    nodes = joined[1].select("a").union(joined[1].select("b")).distinct().count()
    assert nodes < star and joined[2].count() <= nodes + narrow


def test_prefixes_of_similar_sets_meet():
    """Whatever the counts of the buckets, sets that share enough have a first shingle in common, and their places allow for it."""
    rng = np.random.default_rng(9)
    counts = rng.integers(2, 5, 1 << similar._BUCKETS)
    for n in (*range(1, 30), 400):
        for _ in range(40):
            every = np.unique(rng.integers(0, 1 << 63, 2 * n, np.uint64))
            a, b = every[:n], every[int(rng.integers(0, n // 4 + 1)) :][: n + int(rng.integers(0, n // 4 + 1))]
            if similar.similarity(a, b) < 0.8:
                continue
            (x, i), (y, j) = (similar._prefix(s, counts, 0.8) for s in (a, b))
            shared = np.intersect1d(x, y)
            assert len(shared)
            most = max(min(len(a) - i[x == t][0], len(b) - j[y == t][0]) for t in shared)
            assert most >= 0.8 / 1.8 * (len(a) + len(b)) - 1e-6


def test_recall_by_band_of_similarity():
    """Of pairs at each similarity, how many share a band."""
    rng = np.random.default_rng(8)
    for share, least in ((0.8, 0.99), (0.85, 0.998), (0.9, 0.999), (0.95, 0.999)):
        hits, n = 0, 600
        for _ in range(n):
            both = rng.integers(0, 1 << 63, 400, np.uint64)
            cut = round(400 * (1 - share) / (1 + share))
            a, b = both.copy(), both.copy()
            a[:cut], b[:cut] = rng.integers(0, 1 << 63, cut, np.uint64), rng.integers(0, 1 << 63, cut, np.uint64)
            hits += bool(set(similar.bands(a)) & set(similar.bands(b)))
        assert hits >= least * n


def test_sets_and_fingerprints(long_text):
    for text in ["", None, " \n", "one", "a b c d", "A b C d e f", "r " * 50, long_text]:
        data = None if text is None else text.encode()
        hashes, fingerprint = similar.described(data)
        assert len(hashes) == len(plain(text)) and fingerprint == simhash.fingerprint(data, 5)
        assert len(similar.bands(hashes)) == (similar.BANDS if len(hashes) else 1)
    assert similar.similarity(np.zeros(0), np.zeros(0)) == 1.0
