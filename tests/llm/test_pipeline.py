import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwatch.llm.quality import score_documents
from tests.conftest import SMALL
from tests.llm import test_decontaminate, test_jaccard_join, test_line_dedup, test_packing
from tests.llm.helpers import DOCS, docs_of, prose

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and gives, written and read again."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, out[-1], TINY).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(sorted(s.columns) == sorted(stages[0].columns) for s in stages[:-1])


def test_classifier_stage(spark, stages):
    labels = spark.read.parquet(f"{TINY}/labels.parquet")
    kept = {r.doc_id for r in score_documents(stages[0], labels).filter("NOT rejected").collect()}
    before, after = texts_of(stages[0]), texts_of(stages[1])
    assert after == {i: t for i, t in before.items() if i in kept} and len(after) < len(before)


def test_line_stage(stages):
    before, after = texts_of(stages[1]), texts_of(stages[2])
    ids = sorted(before)
    want = dict(zip(ids, test_line_dedup.plain([before[i] for i in ids])))
    assert after == {i: t for i, t in want.items() if t or not before[i]}
    assert all(r.n_chars == len(r.text) for r in stages[2].collect() if r.text != before[r.doc_id])


def test_near_copy_stage(stages):
    before, after = texts_of(stages[2]), texts_of(stages[3])
    groups = test_jaccard_join.plain(list(before), list(before.values()))
    assert set(after) == {i for i, (_, g) in groups.items() if g == i} and len(after) < len(before)


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    before, after = texts_of(stages[3]), texts_of(stages[4])
    found = test_decontaminate.plain(list(before.values()), items, 13)
    assert set(after) == {i for i, f in zip(before, found) if not f[3]}


def test_packing_stage(stages):
    before = texts_of(stages[4])
    ids = sorted(before)
    rows = stages[5].collect()
    place = {i: k for k, i in enumerate(ids)}
    numbered = [r.asDict() | {"doc_id": place[r.doc_id]} for r in rows]
    row = collections.namedtuple("row", rows[0].asDict())
    used, least = test_packing.check([row(**r) for r in numbered], [before[i] for i in ids], 2048)
    assert used <= least + 1


def test_run_gives_the_same(spark, stages):
    same = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SMALL).select(same).collect()
    assert sorted(got) == sorted(stages[5].select(same).collect())


def test_odd_rows_pass_every_stage(spark):
    line = "\n".join(" ".join(prose(k, 8)) for k in range(30))
    docs = docs_of(spark, [None, "", line, line, " ".join(prose(99, 400))]).union(
        spark.createDataFrame([(2, line, "en", "src0", 5), (None, line, None, None, None), (None, None, None, None, None)], DOCS)
    )
    docs = docs.withColumns({"hash": F.lit(1), "removed": F.lit("x"), "_id": F.lit(2)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, TINY)
        assert sorted(out.columns) == sorted(docs.columns)
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.filter("doc_id = 4").count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, TINY).count() >= 1
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, TINY).count() == 0


def test_a_column_of_the_keys_name_stays(spark):
    text = " ".join(prose(300, 200))
    docs = docs_of(spark, [text, text, " ".join(prose(301, 200))]).withColumns({"_row_key": F.lit(5), "_row_key_": F.lit("x")})
    for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.drop_contaminated):
        docs = stage(spark, docs, TINY)
        assert sorted((r.doc_id, r._row_key, r._row_key_) for r in docs.collect()) == [(0, 5, "x"), (2, 5, "x")]


def test_rows_are_judged_by_id_and_text(spark):
    clean, copy = [" ".join(prose(k, 300)) for k in (201, 202)]
    passage = max((r.text for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()), key=len)
    rows = [(1, clean), (1, passage), (None, passage), (None, copy), (5, copy), (6, clean), (6, clean), (7, " ".join(prose(203, 300)))]
    rows += [rows[-1], (7, clean + " end")]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], DOCS)
    left = corpus_pipeline.drop_contaminated(spark, docs, TINY)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted((i or 0, t) for i, t in rows if t != passage)
    once = corpus_pipeline.drop_near_copies(spark, left, TINY)
    assert once.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in once.collect()) == sorted([(0, copy), (1, clean), (7, rows[7][1])])
