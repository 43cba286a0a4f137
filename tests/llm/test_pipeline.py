import random

import corpus_pipeline
from foliate.llm import line_dedup, near_dedup
from tests.llm.helpers import corpus, documents, prose
from tests.llm.test_near import brute_components, shingle_set


def test_stages_hand_on_documents(spark, tmp_path):
    rows = [r for r in corpus() if r[0] is not None]  # one row is there twice
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if name == "near_dedup":
            kept = {r["doc_id"] for r in near_dedup.groups(before, corpus_pipeline.NEAR_SHARE).where("kept").collect()}
            left = [r["doc_id"] for r in docs.collect()]
            assert set(left) == kept and len(left) == len(set(left))
    assert seen["language"].where("text IS NULL").count() == 0
    assert seen["line_dedup"].count() == line_dedup.remove(seen["language"]).count()
    packed = seen["packing"].groupBy("doc_id").count().count()
    assert packed == seen["repeats"].select("doc_id").distinct().count()
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert ran.select("doc_id", "start", "length", "ids_crc32").exceptAll(seen["packing"].select("doc_id", "start", "length", "ids_crc32")).count() == 0


def test_near_stage_links_from_80_percent(spark, tmp_path):
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        w = prose(rng, 200, 10**6).split()
        texts.append(" ".join(w))
        for edits in (2, 3, 4, 5, 6):
            v = list(w)
            for p in range(edits):
                v[20 + 30 * p] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(v))
    sets = [shingle_set(t) for t in texts]
    share = {(i, j): 100 * len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(sets)) for j in range(i + 1, len(sets))}
    assert sum(80 <= x < 85 for x in share.values()) >= 12 and sum(70 <= x < 80 for x in share.values()) >= 12
    want = brute_components(range(len(texts)), [p for p, x in share.items() if x >= 80])
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.groups(documents(spark, texts), corpus_pipeline.NEAR_SHARE).collect()}
    assert got == want
    kept = {r["doc_id"] for r in corpus_pipeline.near(spark, documents(spark, texts), str(tmp_path)).collect()}
    assert kept == {i for i, c in want.items() if c == i}
    # links of 0.85 alone leave more
    at85 = brute_components(range(len(texts)), [p for p, x in share.items() if x >= 85])
    assert len(set(at85.values())) > len(kept)


def test_empty_and_odd_tables(spark, tmp_path):
    for k, rows in enumerate(([], [(1, None), (None, None)], [(1, "one text"), (1, "one text"), (1, "one other text"), (None, "one text"), (2, "")])):
        documents(spark, rows).write.parquet(str(tmp_path / str(k) / "documents.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / str(k))).collect()
        assert sorted(str(r["doc_id"]) for r in got) == ([] if k < 2 else ["1", "None"])


def test_run_leaves_only_what_its_result_reads(spark, tmp_path):
    import os

    from foliate.llm import common

    rng = random.Random(1)
    documents(spark, [(i, prose(rng, 30, 10**6)) for i in range(6)]).write.parquet(str(tmp_path / "documents.parquet"))
    before = common.written(spark)
    got = corpus_pipeline.run(spark, str(tmp_path))
    paths = spark.sparkContext._foliate_paths[before:]
    assert sum("/pipeline-" in p for p in paths) == 1 and all(os.path.isdir(p.removeprefix("file://")) for p in paths)
    assert got.count() == 6
    common.cleanup(spark, since=before)
    assert common.written(spark) == before and not any(os.path.isdir(p.removeprefix("file://")) for p in paths)
