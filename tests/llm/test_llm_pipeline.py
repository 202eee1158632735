import pytest
from messy import EXTRA, documents, prose
from test_llm_classifiers import junk_text, toxic_text

import corpus_pipeline
from tickloom.llm import catalog

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Good, junk and toxic documents, copies, near copies and leaked passages."""
    path = str(tmp_path_factory.mktemp("corpus"))
    made = [(i, toxic_text(i) if i % 9 == 0 else junk_text(i) if i % 9 == 1 else prose(i, 30 + 7 * i % 120)) for i in range(300)]
    long = prose(9000, 120).split()
    leak = prose(9100, 30)
    made += [(1000, " ".join(long)), (1001, " ".join(long)), (1002, " ".join([*long[:60], "other", *long[61:]]))]
    made += [(1003, f"{prose(9200, 30)} {leak} {prose(9300, 30)}")]
    rows = [(i, text, "en", f"src{i % 4}", len(text)) for i, text in made]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 9 != 1), int(i % 9 == 0)) for i in range(0, 300) if i % 2 == 0]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_what_each_stage_keeps(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    own = {r.doc_id for r in docs.collect()}
    good = {i for i in own if i % 9 != 1 or i >= 1000}
    fine = {i for i in good if i % 9 != 0 or i >= 1000}
    expected = [good, fine, fine - {1001, 1002}, fine - {1001, 1002, 1003}, fine - {1001, 1002, 1003}]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_dedup", "decontamination", "bpe_encoding"]
    for (name, stage), left in zip(corpus_pipeline.STAGES, expected):
        columns = docs.columns
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert {r.doc_id for r in docs.collect()} == left, name
        assert docs.columns == columns or name == "bpe_encoding"
    ran = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, ran.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_take_messy_and_empty_tables(spark, folder):
    for docs in (documents(spark, extra=True), documents(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, folder)
            assert name == "bpe_encoding" or got.columns == docs.columns
            assert got.count() <= docs.count()
    assert len(EXTRA.split(",")) == 8


def test_every_operator_has_a_query():
    numbers = {int(name.split("_")[0][2:]) for name in catalog.QUERIES}
    assert numbers == set(range(1, 11)) and set(catalog.ORACLES) <= set(catalog.QUERIES)
