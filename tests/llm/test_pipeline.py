import random

import corpus_pipeline as cp
from helpers import SHAPE, odd_documents, sentence
from test_jaccard_join import edited, truth
from test_decontaminate import truth as leaks

from lakesync.llm import secret_scan


def write(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


def test_stages_equal_brute_force(spark, tmp_path):
    """Every stage by definition: what it keeps and what it makes of it."""
    item = sentence(900, 30)
    texts = {i: sentence(i, 90) for i in range(30)}
    texts |= {30 + i: edited(texts[i], 1, i) for i in range(5)} | {40 + i: texts[i] for i in range(3)}
    texts |= {50: f"{sentence(50, 40)} {item} {sentence(51, 40)}", 51: item, 52: f"{sentence(52, 90)} password=hunter2hunter2", 53: "12345 !!!", 54: None, 55: "ha " * 400}
    draw = random.Random(1)
    rows = [(i, t, "en", draw.choice(["a", "b", None]), len(t or "")) for i, t in texts.items()]
    write(spark.createDataFrame(rows, SHAPE), tmp_path, "documents")
    write(spark.createDataFrame([(1, item)], "item_id long, text string"), tmp_path, "benchmark")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert len(kept[name]) == docs.count()
    assert set(texts) - set(kept["language_id"]) == {53, 54, 55}
    one = truth(kept["language_id"])
    assert set(kept["jaccard_join"]) == {i for i in one if one[i][0] == i}
    assert set(kept["jaccard_join"]) - set(kept["decontaminate"]) == {i for i, _ in leaks(kept["jaccard_join"].items(), [(1, item)])} == {50, 51}
    assert set(kept["secret_scan"]) == set(kept["decontaminate"]) and kept["secret_scan"][52].endswith("[redacted assign]") and not any(secret_scan.scan(t) for t in kept["secret_scan"].values())
    assert all(kept["secret_scan"][i] == t for i, t in kept["decontaminate"].items() if i != 52)
    mixed = {r["doc_id"]: r for r in docs.collect()}
    assert set(mixed) <= set(kept["secret_scan"]) and all(r["taken"] == r["copies"] * r["size"] for r in mixed.values())
    whole = sum(len(t.split()) for t in kept["secret_scan"].values())
    assert abs(sum(r["taken"] for r in mixed.values()) - 1.5 * whole) <= 3 * 90  # a document per source
    found = cp.run(spark, str(tmp_path))
    assert {r["doc_id"]: r["taken"] for r in found.collect()} == {i: r["taken"] for i, r in mixed.items()}


def test_stages_take_odd_and_empty_tables(spark, tmp_path):
    write(spark.createDataFrame([(1, sentence(7)), (2, None)], "item_id long, text string"), tmp_path, "benchmark")
    for docs in (odd_documents(spark), odd_documents(spark).where("false")):
        for k, (_, stage) in enumerate(cp.STAGES):
            out = stage(spark, docs, str(tmp_path))
            assert out.columns[:5] == cp.COLUMNS and out.count() <= docs.count()
            assert k == 4 or out.columns == cp.COLUMNS


def test_texts_of_one_id_are_judged_each_by_itself(spark, tmp_path):
    item, near = sentence(900, 30), edited(sentence(3, 90), 1, 5)
    write(spark.createDataFrame([(1, item)], "item_id long, text string"), tmp_path, "benchmark")
    rows = [(3, sentence(3, 90)), (9, near), (9, sentence(9, 90)), (9, f"{sentence(10, 40)} {item}"), (9, sentence(9, 90)), (12, "password=hunter2hunter2 " + sentence(12, 90)), (12, sentence(13, 90))]
    docs, kept = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], SHAPE), {}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        kept[name] = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert kept["language_id"] == sorted(rows)
    assert kept["jaccard_join"] == sorted({r for r in rows if r != (9, near)})
    assert kept["decontaminate"] == [r for r in kept["jaccard_join"] if item not in r[1]] and len(kept["decontaminate"]) == 4
    assert [i for i, _ in kept["secret_scan"]] == [3, 9, 12, 12] and set(kept["mix_sources"]) <= set(kept["secret_scan"]) and len(kept["mix_sources"]) >= 3
