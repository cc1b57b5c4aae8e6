import numpy as np

from evidra.llm import toxicity as T


def test_thresholds_are_ordered_and_weights_shared():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(3000):
        r = np.flatnonzero(rng.random(6) < 0.3)
        s = np.array([3.0, 2.0, 1.0, 0, 0, -2.0])[r].sum() + rng.logistic()
        rows.append(r)
        grades.append(int(s > 1) + int(s > 3.5))
    w, t = T.fit_cumulative(rows, np.array(grades), 6)
    assert t[0] < t[1] and abs(t[0] - 1) < 0.4 and abs(t[1] - 3.5) < 0.6
    assert np.abs(w - [3, 2, 1, 0, 0, -2]).max() < 0.5


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = T.graded(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    model = T.learn(docs, labels.where("doc_id % 4 <> 2"))
    rows = T.score(docs, model).join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("doc_id % 4 = 2 AND quality = 1").select("doc_id", F_toxic()), "doc_id").collect()
    hit = [r.toxic for r in rows if r.truth]
    false = [r.toxic for r in rows if not r.truth]

    assert sum(hit) / len(hit) > 0.93 and sum(false) / len(false) < 0.01


def test_small_labels_teach_too(spark):
    """87 labels, 11 of them toxic: the words that five or more of these share are learned, and no others."""
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = T.learn(docs, T.graded(labels))
    assert len(model.thresholds) == 1 and {"moron", "loser", "disgusting", "scum"} <= model.weights.keys()
    caught = [r.p_toxic >= 0.5 for r in T.score(docs, model).join(labels.select("doc_id", F_toxic()), "doc_id").collect() if r.truth]
    assert sum(caught) >= 6


def test_scores_equal_a_plain_sum(spark):
    """Against a plain computation: features from the definition, a sum of weights, and a sigmoid for each threshold."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = T.Model({"the": 0.5, "und": -0.7, "scum": 3.0, "worth-": 1.25, "q": 9.0}, [0.5, 1.5, 4.0])
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in T.score(docs, model).collect():
        words = "".join(c if c.isalpha() else " " for c in texts[r.doc_id].lower()).split()
        met = set(words) | {w[:k] + "-" for w in words for k in (4, 5, 6) if len(w) > k}
        chance = [1 / (1 + np.exp(t - sum(w for f, w in model.weights.items() if f in met))) for t in model.thresholds]
        assert abs(r.severity - (sum(chance) if words else 0)) < 1e-9 and r.grade == (sum(c >= 0.5 for c in chance) if words else 0)


def test_grades_of_several_steps_and_repeated_documents(spark):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(["mild"] * (k % 3 > 0) + ["grave"] * (k % 3 > 1) + [f"w{x}" for x in rng.integers(0, 40, 6)]), k % 3) for k in range(120)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(1, "zzz other")] * 50, "doc_id long, text string")
    model = T.learn(docs, spark.createDataFrame([(k, g) for k, _, g in rows], "doc_id long, grade int"))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1] and "zzz" not in model.weights
    got = {r.doc_id: r.grade for r in T.score(docs.where("text <> 'zzz other'"), model).collect()}
    assert sum(got[k] == g for k, _, g in rows) >= 110
    assert all(model.severity(a)[0] < model.severity(b)[0] for a, b in (("w1", "mild w1"), ("mild w1", "mild grave w1")))


def F_toxic():
    from pyspark.sql import functions as F
    return (F.col("toxic") == 1).alias("truth")


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "!!", 1), (None, "bad words", 1)], "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, grade int")
    model = T.learn(docs, labels)
    assert all(r.severity == 0 and not r.toxic for r in T.score(docs, model).collect())
    assert T.score(docs.limit(0), T.Model({"bad": 5.0}, [1.0])).count() == 0
    assert [r.grade for r in T.score(docs, T.Model({"bad": 5.0}, [1.0, 9.0])).collect()] == [0, 0, 0, 1]


def test_slices_of_texts_do_not_change_what_is_learned(spark):
    """Very long texts, and slices of one text each, teach the same model."""
    rows = [(i, ("vile words hurt " if i % 3 == 0 else "kind words help ") * (20_000 if i in (3, 4) else 1) + f"text{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, grade int")
    model = T.learn(docs, labels)
    assert T.Model(model.weights, model.thresholds).severity("vile hurt")[2] == 1 and model.severity("kind help " * 100_000)[2] == 0
    again = T.learn(docs.repartition(3), labels)
    assert again.weights.keys() == model.weights.keys() and all(abs(again.weights[w] - model.weights[w]) < 1e-9 for w in model.weights)
