"""Compiled expectation suites, the metric cube and its document, configurations, naive Bayes."""

import json
import math
import random
import re
import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators import models as MD
from tessera.operators import quality as Q
from tessera.operators.bayes import fit_naive_bayes
from tessera.operators.text import fit_class_index
from tessera.sources import files as FS

SUITE = [
    (Q.COLUMNS_MATCH, ["a", "b", "c", "d"]), (Q.COLUMNS_MATCH, ["b", "a"]), (Q.IN_SET, "a", ["x", "y"]), (Q.NOT_NULL, "a"), (Q.NOT_NULL, "c"),
    (Q.UNIQUE, "b"), (Q.UNIQUE, "c"), (Q.UNIQUE, "d"), (Q.COMPOUND_UNIQUE, ["a", "b"]), (Q.COMPOUND_UNIQUE, ["a", "c"]), (Q.OF_TYPE, "a", "str"), (Q.OF_TYPE, "c", "str"),
]


def single(df):
    made = {
        Q.COLUMNS_MATCH: Q.columns_match_ordered_list, Q.IN_SET: Q.values_in_set, Q.NOT_NULL: Q.not_null, Q.UNIQUE: Q.unique,
        Q.COMPOUND_UNIQUE: Q.compound_unique, Q.OF_TYPE: Q.of_type,
    }
    return Q.run_suite(df, [made[name](df, *args) for name, *args in SUITE])


def test_compiled_suite_equals_single_checks(spark):
    rng = random.Random(1)
    odd = [None, "x", "y", "", "x:1", "1:x", "-", "z"]
    rows = [(rng.choice(odd), rng.choice([None, "", "1", "x", "2:ab"]), rng.choice([None, 0.0, -0.0, float("nan"), 1.5]), [rng.randint(0, 9)]) for _ in range(60)]
    df = spark.createDataFrame(rows, "a string, b string, c double, d array<int>")
    for table in (df, df.limit(1), df.where("false")):
        assert sorted(map(tuple, Q.compile_suite(table, SUITE).collect())) == sorted(map(tuple, single(table).collect()))
    with pytest.raises(ValueError):
        Q.compile_suite(df, [("expect_the_best", "a")])


def test_a_suite_reads_twice_and_shuffles_no_text(spark):
    path = tempfile.mkdtemp(prefix="suite-") + "/t"
    spark.range(100).select(F.repeat(F.lit("text "), 100).alias("a"), F.col("id").cast("string").alias("b"), F.lit(1.0).alias("c"), F.array(F.lit(1)).alias("d")).write.parquet(path)
    plan = Q.compile_suite(spark.read.parquet(path), SUITE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2
    for exchange in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan):
        assert re.sub(r"#\d+", "", exchange).startswith("check, digest")


def scored_rows(n=300, seed=2):
    rng = random.Random(seed)
    return [(k, rng.choice(["a", "b", "c", None]), rng.choice(["a", "b", "d", None]), rng.randint(0, 9)) for k in range(n)]


def test_cube_equals_separate_metrics(spark):
    df = spark.createDataFrame(scored_rows(), "id long, y_true string, y_pred string, x int")
    classes = spark.createDataFrame([("a", 0), ("b", 1), ("never", 2)], "tag string, class_index long")
    slices = {"low": F.col("x") < 4, "empty": F.col("x") > 50, "odd": F.col("x") % 2 == 1, "null": F.lit(None).cast("boolean")}
    for table in (df, df.where("x = 3")):
        cube = M.metric_cube(table, classes, slices)
        got = sorted((r.scope, r.key, round(r.precision, 9), round(r.recall, 9), round(r.f1, 9), r.num_samples) for r in cube.collect())
        rows = M.metric_rows(table.where("y_true IS NOT NULL AND y_pred IS NOT NULL"), classes, slices)
        whole = M.metric_cube(table.where("y_true IS NOT NULL AND y_pred IS NOT NULL"), classes, slices)
        key = lambda r: (r.scope, r.key, round(r.precision, 9), round(r.recall, 9), round(r.f1, 9), r.num_samples)
        assert sorted(map(key, whole.collect())) == sorted(map(key, rows.collect()))
        assert ("per_class", "never", 0.0, 0.0, 0.0, 0.0) in got
    none = M.metric_cube(df.where("false"), classes, slices).collect()
    assert {(r.scope, r.num_samples) for r in none} == {("per_class", 0.0)}
    assert {r.scope for r in M.metric_cube(df, classes, {}).collect()} == {"overall", "per_class"}


def test_cube_scans_once(spark):
    path = tempfile.mkdtemp(prefix="cube-") + "/t"
    spark.createDataFrame(scored_rows(), "id long, y_true string, y_pred string, x int").write.parquet(path)
    classes = spark.createDataFrame([("a", 0), ("b", 1)], "tag string, class_index long")
    plan = M.metric_cube(spark.read.parquet(path), classes, {"low": F.col("x") < 4})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_document_order_and_files(spark):
    df = spark.createDataFrame(scored_rows(), "id long, y_true string, y_pred string, x int").na.fill("a")
    cube = M.metric_cube(df, fit_class_index(df, "y_true").withColumnRenamed("y_true", "tag"), {"zz": F.col("x") < 4, "aa": F.col("x") > 4})
    doc = M.evaluation_document(cube, timestamp=F.lit("now"), run_id=F.lit("r"), eval_run_id=F.lit("e"))
    folder = "file://" + tempfile.mkdtemp(prefix="doc-")
    path = FS.save_document(doc, folder, "m_e.json")
    text = open(path[7:], encoding="utf-8").read()
    found = json.loads(text)
    assert list(found) == ["timestamp", "run_id", "eval_run_id", "metrics"] and text.startswith('{\n  "timestamp"')
    f1 = [m["f1"] for m in found["metrics"]["per_class"].values()]
    assert f1 == sorted(f1, reverse=True) and list(found["metrics"]["slices"]) == ["zz", "aa"]
    by_key = FS.save_document(doc, folder, "sorted.json", sort_keys=True)
    assert list(json.load(open(by_key[7:], encoding="utf-8"))["metrics"]["slices"]) == ["aa", "zz"]
    back = FS.read_json_documents(spark, path, doc.schema)
    assert [tuple(r) for r in M.document_rows(back).collect()] == [tuple(r) for r in M.document_rows(doc).collect()]
    with pytest.raises(ValueError):
        FS.save_document(df, folder, "many.json")


def test_config_from_text_or_path(spark):
    folder = tempfile.mkdtemp(prefix="config-")
    with open(f"{folder}/c.json", "w", encoding="utf-8") as f:
        f.write('{"lr": 0.5}\n')
    assert FS.read_config(spark, '{"a": [1]}') == {"a": [1]}
    assert FS.read_config(spark, f"file://{folder}/c.json") == FS.read_config(spark, f"{folder}/c.json") == {"lr": 0.5}
    for bad in ("{nope", "", f"{folder}/missing.json", 5, None, {"a": 1}):
        with pytest.raises(ValueError):
            FS.read_config(spark, bad)


def brute_bayes(train, text, alpha=1.0):
    words, docs = defaultdict(Counter), Counter(tag for _, tag in train)
    for t, tag in train:
        words[tag].update(t.split())
    known = {w for c in words.values() for w in c}
    score = {}
    for tag in docs:
        size = sum(words[tag].values()) + alpha * len(known)
        score[tag] = math.log(docs[tag] / len(train)) + sum(math.log((words[tag][w] + alpha) / size) for w in text.split() if w in known)
    top = max(score.values())
    return {tag: math.exp(s - top) / sum(math.exp(v - top) for v in score.values()) for tag, s in score.items()}


def test_naive_bayes_equals_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(30)]
    train = [(" ".join(rng.choices(vocabulary[: 10 + 7 * (k % 3)], k=rng.randint(0, 12))), "abc"[k % 3]) for k in range(60)]
    texts = [" ".join(rng.choices([*vocabulary, "new"], k=rng.randint(0, 9))) for _ in range(40)] + ["", "  w1  w1 ", "new new"]
    model = fit_naive_bayes(spark.createDataFrame([*train, ("w1", None)], "text string, tag string"))
    tests = spark.createDataFrame([*enumerate(texts), (99, None)], "id long, text string")
    got = {r.id: r.probability for r in model.probabilities(tests, "id", "text").collect()}
    assert model.labels == ["a", "b", "c"] and len(got) == len(texts) + 1
    for k, text in [*enumerate(texts), (99, "")]:
        assert got[k] == pytest.approx([brute_bayes(train, text)[c] for c in "abc"], abs=1e-9)


def test_log_loss_of_hopeless_and_unknown_labels(spark):
    train = spark.createDataFrame([("up " * 9, "a"), ("down " * 9, "b")], "text string, tag string")
    model = fit_naive_bayes(train)
    tests = spark.createDataFrame([(1, "up", "a"), (2, "down " * 5000, "a"), (3, "up", "new"), (4, "up", None)], "id long, text string, tag string")
    loss, n = model.log_loss(tests, "id", "text", "tag").first()
    p = brute_bayes([("up " * 9, "a"), ("down " * 9, "b")], "up")["a"]
    ratio = math.log(10)  # ten times as likely in b, five thousand times over
    assert n == 2 and loss == pytest.approx((-math.log(p) + 5000 * ratio) / 2)


def test_lookup_is_broadcast_up_to_a_bound(spark):
    from tessera.operators.core import checked_broadcast

    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(checked_broadcast(spark.range(10), 10)) and not hinted(checked_broadcast(spark.range(11), 10))


def test_behaviour_of_naive_bayes(spark):
    """Invariant under a word that swaps with one of its kind, directional, and minimum functionality."""
    rows = [
        ("language model reads sentences", "nlp"), ("parsing sentences with a language network", "nlp"), ("translation of rare language", "nlp"),
        ("road signs in pictures", "vision"), ("detecting faces in pictures", "vision"), ("drift of deployed services", "ops"), ("serving deployed models", "ops"),
    ]
    model = fit_naive_bayes(spark.createDataFrame(rows, "text string, tag string"))
    cases = spark.createDataFrame(
        [
            (1, "invariance", "parsing language quickly", "parsing language slowly", None), (2, "directional", "language of pictures in pictures", None, "vision"),
            (3, "directional", "pictures of language translation sentences", None, "nlp"), (4, "mft", "deployed drift", None, "ops"), (5, "mft", "faces", None, "nlp"),
        ],
        "case_id long, kind string, input_a string, input_b string, expected string",
    )
    out = {r.case_id: r.passed for r in MD.behavioral_checks(model, cases, fallback="ops").collect()}
    assert out == {1: True, 2: True, 3: True, 4: True, 5: False}
