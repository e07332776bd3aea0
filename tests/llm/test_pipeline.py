import collections
import re

from pyspark.sql import functions as F

import corpus_pipeline
from hoardline.llm import forest, pii, toxicity

SF = "/root/testdata/sf0.001"


def grams(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups(rows):
    """Rows in connected groups of four fifths similar documents, by brute force."""
    sets = [grams(r.text) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                up[root(i)] = root(j)
    out = collections.defaultdict(list)
    for i, r in enumerate(rows):
        out[root(i)].append(r)
    return list(out.values())


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(90_001, None, "en", None, 0), (90_002, "", None, "x", 0), (None, "a b c d e f " * 30, "en", "x", 1), (90_003, "a b c d e f " * 30, "en", "x", 1)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.where("doc_id < 4"))  # repeated rows too
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    scores = toxicity.score(docs, toxicity.train(docs, labels))
    assert kept.columns == docs.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(r.doc_id for r in scores.where("predicted = 0").collect())
    kept = spark.createDataFrame(kept.collect(), docs.schema)
    single = corpus_pipeline.drop_near_copies(spark, kept, SF)
    left = single.collect()
    for group in groups(kept.collect()):
        stays = [r for r in left if r in group]
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert len(stays) == 1 and (not ids or stays[0].doc_id == min(ids))
    single = spark.createDataFrame(left, docs.schema)
    masked = corpus_pipeline.mask_personal_data(spark, single, SF)
    before, after = {r.doc_id: r for r in left}, {r.doc_id: r for r in masked.collect()}
    spans = {r.doc_id: r for r in pii.find(single).collect()}
    assert masked.columns == docs.columns and set(before) == set(after)
    for i, r in after.items():
        touched = bool(spans[i].base or spans[i].added)
        assert (r.text != before[i].text) == touched and (r.text is None or r.n_chars == len(r.text))
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text or "")
    masked = spark.createDataFrame(list(after.values()), docs.schema)
    mixed = corpus_pipeline.mix_sources(spark, masked, SF)
    times = collections.Counter(r.doc_id for r in mixed.collect())
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for i, r in after.items()}
    assert mixed.columns == docs.columns and max(times.values()) <= 3
    total = sum(words.values())
    assert 0.9 * total < sum(words[i] * n for i, n in times.items()) <= total
    mixed = spark.createDataFrame(mixed.collect(), docs.schema)
    drawn = corpus_pipeline.sample_segmentations(spark, mixed, SF).collect()
    assert {r.doc_id for r in drawn} == {i for i in times if after[i].text}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
    assert forest.THRESHOLD == 0.8 and forest.WORDS == 5


CLASHES = ["row", "_row", "_text", "_own", "_id", "_spans", "_times", "_copy", "_key", "_marks", "_done", "_kept", "_taken", "source_size", "kind", "Score", "spans"]


def test_columns_of_any_name_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    docs = docs.select("*", *[F.concat(F.lit(c + ":"), F.col("doc_id")).alias(c) for c in CLASHES])
    secret = docs.where("doc_id = 1").drop("text", "doc_id").selectExpr("77 AS doc_id", "'write to jane.doe@example.com today' AS text", "*").select(*docs.columns)
    docs = docs.unionByName(secret)
    for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.mask_personal_data, corpus_pipeline.mix_sources):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c}:{1 if r.doc_id == 77 else r.doc_id}" for r in rows for c in CLASHES)
        if stage is corpus_pipeline.mask_personal_data:
            assert [r.text for r in rows if r.doc_id == 77] == ["write to <email> today"]
            assert not any("jane.doe" in str(v) for r in rows for v in r)


def test_empty_and_all_toxic_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), SF).count() == 0
    docs.selectExpr("doc_id", "1 AS quality", "1 AS toxic").write.parquet(f"file://{tmp_path}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs.where("text <> ''"), f"file://{tmp_path}").count() == 0
