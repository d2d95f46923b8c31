"""Bradley-Terry quality: held-out accuracy, odd inputs."""

import numpy as np
from pyspark.sql import functions as F

from ticklake.llm import quality as q
from ticklake.llm.queries import REGISTRY, quality_model
from ticklake.sources.tables import read_table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = REGISTRY["op7_bradley_terry_quality"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(read_table(spark, SF, "labels", "doc_id", "quality"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 40
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert got.count() == read_table(spark, SF, "documents", "doc_id").count()


def test_scores_use_the_text_alone(spark, frame):
    docs = read_table(spark, SF, "documents")
    model = quality_model(spark, docs, SF)
    same = docs.select("text").limit(5).collect()
    df = frame([(i, r["text"], "zz", i) for i, r in enumerate(same * 2)], "doc_id long, text string, lang string, x long")
    s = [r["score"] for r in q.score(df, model).orderBy("doc_id").collect()]
    assert s[:5] == s[5:]


def test_odd_inputs(spark, frame):
    docs = frame([(1, None, 0), (2, "", 0), (3, "fine words here. " * 9, 0), (3, "fine words here. " * 9, 0),
                  (None, "x " * 200_000, 0), (5, "###", 0)], "doc_id long, text string, score int")
    for labels in ([], [(3, 1)], [(1, 0)], [(3, 1), (5, 0), (5, None), (None, 1)]):
        model = q.train(docs, frame(labels, "doc_id long, quality int"))
        out = q.score(docs, model).collect()
        assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
        assert q.reject(docs, model).columns == docs.columns
    only_good = q.train(docs, frame([(3, 1)], "doc_id long, quality int"))
    assert q.reject(docs, only_good).count() == 6
    assert q.score(docs.limit(0), model).count() == 0


def test_pairs_order_the_labels():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    y = (x[:, 1] - x[:, 3] > -0.8).astype(int)
    s = q.fit(x, y).score(x)
    assert s[y == 1].min() > s[y == 0].max() - 0.2 and np.mean((s >= q.CUT) == (y == 1)) >= 0.97


def test_cut_lies_at_the_share_of_label_0():
    """Where the labels overlap, least error alone would cut at an end."""
    for share in (0.1, 0.9):
        rng = np.random.default_rng(5)
        y = (rng.random(2000) >= share).astype(int)
        x = rng.normal(size=(2000, 5))
        x[:, 1] += 0.3 * y
        rejected = np.mean(q.fit(x, y).score(x) < q.CUT)
        assert abs(rejected - np.mean(y == 0)) <= q.NEAR + 0.002


def test_labels_of_another_integer_type(frame):
    docs = frame([(i, "good words here " * 5 if i % 2 else "zz 9 9") for i in range(1, 40)], "doc_id long, text string")
    labels = frame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality long")
    model = q.train(docs, labels)
    scores = {r.doc_id: r.score for r in q.score(docs, model).collect()}
    assert all((scores[i] >= q.CUT) == bool(i % 2) for i in scores)


def test_weights_are_those_of_a_plain_pairwise_loss():
    """Newton steps against gradient descent on the same pairs' loss."""
    rng = np.random.default_rng(2)
    y = (rng.random(60) < 0.5).astype(int)
    x = rng.normal(0, 1, (60, q.N_FEATURES)) + y[:, None] * 0.4
    model = q.fit(x, y)
    z = np.clip((x - model.mean) / model.spread, -8, 8)
    win, lose = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    draw = np.random.default_rng(7)
    pairs = [(a, b) for a, b in zip(np.repeat(lose, q.PAIRS_PER_LOSER),
                                    win[draw.integers(0, len(win), len(lose) * q.PAIRS_PER_LOSER)])]
    pairs += list(zip(lose[draw.integers(0, len(lose), len(win))], win))
    w = np.zeros(q.N_FEATURES)
    for _ in range(4000):
        grad = q.RIDGE * w
        for part in np.array_split(np.array(pairs), 1):
            d = z[part[:, 1]] - z[part[:, 0]]
            grad = grad + d.T @ (1 / (1 + np.exp(-d @ w)) - 1) / len(pairs)
        w = w - 0.3 * grad
    assert np.allclose(w, model.weights, atol=2e-2 * max(1.0, np.abs(w).max()))
