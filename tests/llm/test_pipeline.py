"""The pipeline's stages on a small corpus with planted cases, and the queries' registration."""

import random

import pytest


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    folder = tmp_path_factory.mktemp("sf")
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8)))
    clean = [" ".join(word() for _ in range(rng.randrange(60, 400))) for _ in range(40)]
    passage = " ".join(word() for _ in range(55))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(5)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100, clean[3]), (101, clean[4].upper()), (102, "too short"), (103, " ".join(["spam spam eggs and ham"] * 60)), (104, None)]
    rows += [(110 + i, clean[i + 10].split(" ", 20)[-1][::-1] + " " + passage) for i in range(3)]
    rows += [(120, " ".join(word() for _ in range(50)) + " " + items[2][1] + " " + " ".join(word() for _ in range(50)))]
    spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), dict(rows), passage


def test_stages(spark, corpus):
    import corpus_pipeline
    from loomseq.llm.common import materialise

    folder, texts, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, folder), name)
        seen[name] = {r.doc_id: r.asDict() for r in docs.collect()} if name != "best_fit_packing" else docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns
    assert not {102, 103, 104} & set(seen["quality_rules"]) and set(range(40)) <= set(seen["quality_rules"])
    assert not {100, 101} & set(seen["simhash_near_dedup"]) and set(range(40)) <= set(seen["simhash_near_dedup"])
    cut = seen["suffix_array_dedup"]
    assert passage in cut[110]["text"] and passage not in cut[111]["text"] and passage not in cut[112]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in cut.values())
    assert all(cut[i]["text"] == texts[i] for i in range(40))
    assert 120 not in seen["benchmark_decontamination"] and set(range(40)) <= set(seen["benchmark_decontamination"])
    assert {r.doc_id for r in seen["best_fit_packing"]} == set(seen["benchmark_decontamination"])
    whole = corpus_pipeline.run(spark, folder)
    assert whole.count() == len(seen["best_fit_packing"])


def test_every_operator_has_a_query():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
