import numpy as np
from pyspark.sql import functions as F

from shelfwatch.llm import quality
from shelfwatch.llm.quality import BAD, GOOD, NONE, Block, keep_good, posteriors, quality_votes, score_documents, train
from shelfwatch.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.helpers import by_id, docs_of, prose

LABELS = "doc_id long, quality int, toxic int"


def test_label_model_finds_accuracies_without_annotations():
    r = np.random.default_rng(1)
    bad = r.random(40_000) < 0.2
    right = [0.95, 0.9, 0.8, 0.85]
    votes = np.stack([np.where(r.random(len(bad)) < a, bad, ~bad) + GOOD for a in right] + [np.zeros(len(bad), int)], 1)
    patterns, counts = np.unique(votes @ 3 ** np.arange(4, -1, -1), return_counts=True)
    post, said = posteriors(patterns, counts, 5, rounds=40)
    for k, a in enumerate(right):
        assert abs(said[1, k, BAD] - a) < 0.04 and abs(said[0, k, GOOD] - a) < 0.04
    wanted = np.zeros(3**5)
    wanted[patterns] = post
    assert ((wanted[votes @ 3 ** np.arange(4, -1, -1)] > 0.5) == bad).mean() > 0.97


def test_few_patterns_do_not_turn_classes_or_trust_one_vote():
    good = sum(GOOD * 3**k for k in range(1, 9))  # eight good votes, no annotation
    for n in (1, 3, 50):
        post, said = posteriors(np.array([good, good + 3 * (BAD - GOOD)]), np.array([n, 1]), 9)
        assert post[0] < 0.1 and post[1] < 0.5
        assert (said[1, :-1, BAD] >= said[0, :-1, BAD]).all()


def test_clean_documents_of_small_tables_stay(spark):
    for n in (1, 5, 50):
        texts = [" ".join(prose(900 + k, 300)) for k in range(n)]
        for labels in ([], [(0, 1, 0)]):
            rows = score_documents(docs_of(spark, texts), spark.createDataFrame(labels, LABELS)).collect()
            assert len(rows) == n and not any(r.rejected for r in rows)


def test_a_language_without_known_function_words_stays(spark):
    texts, labels = corpus(spark)
    other = [" ".join(f"слово{w[1:]}" for w in prose(700 + k, 80, 400)) for k in range(20)]
    got = by_id(score_documents(docs_of(spark, texts + other), spark.createDataFrame(labels, LABELS)))
    assert not any(got[240 + k].rejected for k in range(20))


def test_annotations_decide():
    patterns = np.array([BAD * 3 + GOOD, BAD * 3 + NONE, GOOD * 3 + BAD])
    post, _ = posteriors(patterns, np.array([50, 5, 3]), 2)
    assert post[0] < 0.1 and post[2] > 0.9


def test_scorer_learns_a_hashed_feature():
    r = np.random.default_rng(2)
    rows = np.repeat(np.arange(500), 6)
    columns = r.integers(1, 40, 3000)
    hit = r.choice(500, 60, replace=False)
    rows, columns = np.append(rows, hit), np.append(columns, np.zeros(60, int))
    weight = train(rows, columns, np.isin(np.arange(500), hit).astype(float), 40)
    score = np.bincount(rows, weights=weight[columns], minlength=500) + weight[-1]
    assert ((score > 0) == np.isin(np.arange(500), hit)).mean() > 0.98


def test_statistics_equal_a_plain_count():
    texts = ["a b b c A!\nx | y", "", "ÜBER Äpfel # und", " ".join(prose(1, 300)) + "\nx\nx", "ab" * 40000]
    block = Block([t.encode() for t in texts])
    assert block.words.tolist() == [7, 0, 3, 302, 1]
    assert block.stats["distinct"][0] == 5 / 7 and block.stats["top"][0] == 2 / 7 and block.stats["again"][0] == 1 / 7
    assert block.stats["shouts"][0] == 1 / 8 and block.stats["bars"][0] == 1 / 8 and block.stats["upper"][0] == 1 / 7
    assert block.stats["function"][2] == 1 / 3 and abs(block.stats["lines"][3] - 1 / 3) < 1e-9
    assert all(v[1] == NONE for v in quality_votes(block))
    text, bucket = block.features()
    assert not (text == 1).any() and len(set(zip(text.tolist(), bucket.tolist()))) == len(text)


def corpus(spark):
    texts, labels = [], []
    for k in range(240):
        words = prose(k, 60, 400)
        kind = k % 6
        if kind == 0:
            words[5:8] = ["idiot", "scum", "loser"] if k % 4 else ["zzqab", "zzqac", "zzqad"]
        text = " ".join(words)
        if kind == 1:
            text = " ".join(f"{w.upper()}!!" for w in words)
        texts.append(text)
        labels.append((k, int(kind != 1), int(kind == 0)))
    return texts, [x for x in labels if x[0] % 5]


def test_rejects_what_annotators_reject(spark):
    texts, labels = corpus(spark)
    docs = docs_of(spark, texts + [None, "", " ...", texts[1]])
    got = by_id(score_documents(docs, spark.createDataFrame(labels, LABELS)))
    assert all(got[k].rejected == (k % 6 < 2) for k in range(240) if not (k % 6 == 0 and k % 5 == 0))
    assert [got[k].rejected for k in range(240, 244)] == [False, False, False, True]
    kept = keep_good(docs.withColumn("p_bad", F.lit(1)), spark.createDataFrame(labels, LABELS))
    assert kept.columns == [*docs.columns, "p_bad"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k in got if not got[k].rejected)


def test_junk_that_no_annotation_shows_is_learnt_from_the_votes(spark):
    texts, labels = corpus(spark)
    plain = [(k, 1, t) for k, _, t in labels if k % 6 != 1]
    got = by_id(score_documents(docs_of(spark, texts), spark.createDataFrame(plain, LABELS)))
    assert all(got[k].rejected for k in range(1, 240, 6)) and not any(got[k].rejected for k in range(2, 240, 6))


def test_without_annotations_the_votes_judge(spark):
    texts, _ = corpus(spark)
    docs = docs_of(spark, texts + [None, ""])
    none = spark.createDataFrame([], LABELS)
    got = by_id(score_documents(docs, none))
    assert all(got[k].rejected for k in range(1, 240, 6)) and not any(got[k].rejected for k in range(2, 240, 6))
    assert not got[240].rejected and not got[241].rejected
    assert sorted(r.doc_id for r in keep_good(docs, none).collect()) == sorted(k for k in got if not got[k].rejected)


def test_empty_repeated_null(spark):
    none, empty = spark.createDataFrame([], LABELS), docs_of(spark, [])
    assert score_documents(empty, none).count() == 0 and keep_good(empty, none).count() == 0
    texts, labels = corpus(spark)
    rows = [(k, t) for k, t in enumerate(texts)] + [(1, texts[1]), (None, texts[1]), (None, texts[2])]
    labels += [(1, None, None), (None, 0, 1), (2, 1, None), (2, 1, 0)]
    got = score_documents(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 243 and sorted(r.rejected for r in got if r.doc_id is None) == [False, True]
    assert [r.rejected for r in got if r.doc_id == 1] == [True, True]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL[:-2]}1/documents.parquet")
    labels = spark.read.parquet(f"{SMALL[:-2]}1/labels.parquet")
    got = by_id(score_documents(docs, labels.filter("doc_id % 3 != 0")))
    held = [(got[r.doc_id].rejected, r.quality == 0 or r.toxic == 1) for r in labels.filter("doc_id % 3 = 0").collect()]
    assert sum(a == b for a, b in held) / len(held) > 0.9
    assert sum(a and not b for a, b in held) <= 0.03 * len(held)


def test_query_agrees_with_the_annotations(spark):
    got = by_id(QUERIES["op2_quality"](spark, f"{SMALL[:-2]}1"))
    judged = [(got[r.doc_id].rejected, r.quality == 0 or r.toxic == 1) for r in spark.read.parquet(f"{SMALL[:-2]}1/labels.parquet").collect()]
    assert sum(a == b for a, b in judged) / len(judged) > 0.93
    assert sum(a and not b for a, b in judged) <= 0.04 * len(judged)


def test_query(spark):
    rows = QUERIES["op2_quality"](spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(0 <= r.p_bad <= 1 and r.rejected == (max(r.p_bad, r.p_toxic) >= 0.5) for r in rows)


assert quality.BUCKETS & (quality.BUCKETS - 1) == 0
