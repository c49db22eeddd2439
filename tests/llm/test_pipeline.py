"""The pipeline's stages on real, awkward and no rows."""

import corpus_pipeline as pipeline
from mediaspark.llm.common import saved
from tests.llm.helpers import FOLDER, awkward, folder_of, nothing
from tests.llm.test_operators import plain_components


def walk(spark, docs, folder):
    found = {}
    for name, stage in pipeline.STAGES:
        columns = docs.columns
        docs = saved(stage(spark, docs, folder))
        found[name] = docs
        assert name == "packed_sequences" or docs.columns == columns
    return found


def test_stages_and_their_order():
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "near_duplicates", "source_mix", "packed_sequences"] and pipeline.ORACLE_SQL is None


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = walk(spark, docs, FOLDER)
    assert found["language_id"].count() == docs.count()  # all are clean as to language
    marks = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = found["language_id"].join(marks.where("quality = 1"), "doc_id").count()
    kept = found["quality_rules"]
    assert kept.join(marks.where("quality = 1"), "doc_id").count() >= 0.8 * good  # some fail the hard limits
    texts = {r.doc_id: r.text for r in kept.collect()}
    groups = plain_components(texts, 5, 80, 100)
    stayed = [r.doc_id for r in found["near_duplicates"].collect()]
    assert sorted(groups[k] for k in stayed) == sorted(set(groups.values()))
    words = lambda rows: sum(len(r.text.encode().split()) for r in rows.collect())
    assert abs(words(found["source_mix"]) / (1.5 * words(found["near_duplicates"])) - 1) < 0.05
    packed = found["packed_sequences"].collect()
    assert sum(r.piece == 0 for r in packed) == found["source_mix"].count()


def test_run_gives_the_last_stage(spark):
    assert pipeline.run(spark, FOLDER).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_awkward_rows_and_no_rows(spark, tmp_path):
    folder = folder_of(spark, tmp_path, awkward(spark))
    assert walk(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)["packed_sequences"].count() > 0
    assert all(df.count() == 0 for df in walk(spark, nothing(spark), folder).values())
