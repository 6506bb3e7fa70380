import numpy as np
from conftest import DATA
from helpers import odd_documents
from pyspark.sql import functions as F

from lakesync.llm import quality as qc


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    train, held = (labels.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2) == held) for held in (False, True))
    found = qc.classify(docs, train, host=F.col("source"), path=F.concat_ws("/", "source", "lang")).join(held, "doc_id").select("keep", held["quality"].alias("label")).collect()
    right = [r["keep"] == (r["label"] == 1) for r in found]
    good = [r["keep"] for r in found if r["label"] == 1]
    assert len(right) > 500 and np.mean(right) > 0.97 and np.mean(good) > 0.99


def test_sparse_sites_shrink_to_their_priors(spark):
    """Without evidence in the texts a document's quality is its path's rate without itself, shrunk to the host's and the global one."""
    sites = [("good", "good/a", 40, 38), ("good", "good/b", 1, 0), ("bad", "bad/a", 40, 4), ("bad", "bad/b", 2, 1), ("new", "new/a", 1, 1)]
    docs, labels, i = [], [], 0
    for host, path, n, k in sites:
        for j in range(n):
            docs.append((i, "same text", host, path))
            labels.append((i, int(j < k)))
            i += 1
    d, y = spark.createDataFrame(docs, "doc_id long, text string, host string, path string"), spark.createDataFrame(labels, "doc_id long, quality int")
    found = {r["path"]: r for r in qc.classify(d, y, host=F.col("host"), path=F.col("path")).collect()}
    rate = sum(k for *_, k in sites) / sum(n for _, _, n, _ in sites)
    assert found["good/a"]["path_rate"] > 0.85 > found["good/b"]["path_rate"] > found["bad/b"]["path_rate"] > found["bad/a"]["path_rate"]
    assert abs(found["new/a"]["quality"] - rate) < 0.05 and all(abs(r["evidence"]) < 1e-6 for r in found.values())


def plain_strength(groups):
    """groups: (n, k, expected rate); how many documents the prior is worth, by the moments of the rates."""
    noise = [r * (1 - r) for _, _, r in groups]
    n = [g[0] for g in groups]
    excess = sum(m * (k / m - r) ** 2 for m, k, r in groups) - sum(noise) * (1 - 1 / len(groups))
    spread = excess / max(sum(n) - sum(m * m for m in n) / sum(n), 1e-9)
    return min(max(np.mean(noise) / spread - 1, qc.LIGHTEST), qc.HEAVIEST) if spread > 0 else qc.HEAVIEST


def test_rates_and_qualities_equal_plain_ones(spark, monkeypatch):
    """The shrinkage of every site and the posterior of every document, recomputed row by row from evidence and labels."""
    from lakesync.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 20)  # hot sites are dealt over tasks
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").withColumns({"y": F.lit("y"), "site": F.lit(1), "quality": F.lit(2)})
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet").withColumns({"x": F.lit("x"), "text": F.lit(""), "source": F.lit("z")})
    said = {r["doc_id"]: float(r["quality"]) for r in labels.collect() if r["quality"] is not None}
    found = qc.classify(docs, labels, host=F.col("source"), path=F.col("lang")).collect()
    y = [said[r["doc_id"]] for r in found if r["doc_id"] in said]
    base = np.log(np.mean(y) / (1 - np.mean(y)))
    good = [said.get(r["doc_id"], 1 / (1 + np.exp(-(r["evidence"] + base)))) for r in found]
    paths, hosts = {}, {}
    for r, g in zip(found, good, strict=True):
        for held, key in ((paths, (r["host"], r["path"])), (hosts, r["host"])):
            n, k = held.get(key, (0, 0.0))
            held[key] = n + 1, k + g
    rate = sum(good) / len(good)
    a = plain_strength([(n, k, rate) for n, k in hosts.values()])
    host_rate = {h: (k + a * rate) / (n + a) for h, (n, k) in hosts.items()}
    b = plain_strength([(n, k, host_rate[h]) for (h, _), (n, k) in paths.items()])
    for r, g in zip(found, good, strict=True):
        (n, k), (hn, hk) = paths[r["host"], r["path"]], hosts[r["host"]]
        others = (k - g + b * ((hk - g + a * rate) / (hn - 1 + a))) / (n - 1 + b)
        others = min(max(others, 1e-6), 1 - 1e-6)
        want = 1 / (1 + np.exp(-(r["evidence"] + np.log(others / (1 - others)))))
        assert np.allclose([r["host_rate"], r["path_rate"], r["quality"]], [host_rate[r["host"]], (k + b * host_rate[r["host"]]) / (n + b), want], atol=1e-9)
        assert r["keep"] == (r["quality"] >= 0.5)


def test_classifier_is_at_its_optimum_and_the_sample_is_stable(spark, monkeypatch):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(300, 4))
    y = (x[:, 0] + draw.normal(size=300) > 0).astype(float)
    model = qc.Logistic(x, y)
    z = np.column_stack([np.ones(300), (x - model.mean) / model.scale])
    slope = z.T @ (y - 1 / (1 + np.exp(-z @ model.weights))) - qc.RIDGE * np.r_[0, model.weights[1:]]
    assert np.abs(slope).max() < 1e-6
    monkeypatch.setattr(qc, "SAMPLE", 40)
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    one, two = (sorted(map(tuple, qc.classify(d, labels, host=F.col("source"), path=F.col("lang")).select("doc_id", F.round("quality", 9)).collect())) for d in (docs, docs.repartition(13)))
    assert one == two


def test_strength_of_equal_and_of_different_sites(spark):
    def of(rows):
        df = spark.createDataFrame(rows, "n double, k double")
        rate = sum(k for _, k in rows) / sum(n for n, _ in rows)
        return df.agg(qc.strength(df, F.col("n"), F.col("k"), F.lit(rate))).first()[0]

    assert of([(100.0, 50.0), (100.0, 50.0), (100.0, 51.0)]) == qc.HEAVIEST and of([(1000.0, 900.0), (1000.0, 100.0)]) < 3


def test_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 0), (9, 1), (9, 0), (None, 1), (10, None), (10, 1), (3, 0), (12, 1)], "doc_id long, quality int")
    for some in (labels, labels.where("false"), labels.where("quality = 1")):
        rows = qc.classify(docs, some, host=F.col("source"), path=F.col("lang")).collect()
        assert len(rows) == docs.count() and all(0 <= r["quality"] <= 1 for r in rows)
    assert qc.classify(docs.where("false"), labels, host=F.col("source"), path=F.col("lang")).count() == 0
