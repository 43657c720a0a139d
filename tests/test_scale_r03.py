"""What the larger tables asked for: rows made once, plain columns in joins, files and tasks of bounded size."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import STOPWORDS, clean_text, remove_stopwords, strip_non_alnum
from tessera.operators import trajectory as T
from tessera.operators.text import pad_batch


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_graph_nodes_draw_the_noise_of_a_window_in_its_row(spark):
    rows = [(1, p, s, [[float(p + s + j), j * 0.5] for j in range(6)], [9.0, 3.0]) for p in (1, 2) for s in range(3)]
    rows += [(None, 3, 0, [[0.0, 0.0]] * 6, [0.0, 0.0])]
    windows = spark.createDataFrame(rows, "traj_id long, particle long, start long, hist array<array<double>>, target array<double>")
    stats = spark.createDataFrame([(0, 0.1, 2.0), (1, 0.2, 3.0)], "d int, acc_mean double, acc_std double")
    nodes = T.graph_sample_nodes(
        windows, stats, window_length=7, dim=2, noise_std=0.3, seed=11, radius=10.0, bounds=[[0.0, 5.0], [0.0, 5.0]]
    )
    assert "Join" not in plan(nodes) and "Aggregate" not in plan(nodes) and "Window" not in plan(nodes)
    noise = {(r.particle, r.start, r.j, r.d): r.noise for r in T.random_walk_noise(windows, 7, 2, 0.3, 11).where("traj_id = 1").collect()}
    got = nodes.collect()
    assert len(got) == 6
    for r in got:
        hist = next(h for t, p, s, h, _ in rows if (t, p, s) == (1, r.particle, r.start))
        xn = [[hist[j][d] + noise[r.particle, r.start, j, d] for d in range(2)] for j in range(6)]
        assert r.recent == pytest.approx(xn[5], abs=1e-12)
        assert r.vflat == pytest.approx([xn[j][d] - xn[j - 1][d] for j in range(1, 6) for d in range(2)], abs=1e-12)
        for d, (mean, std) in enumerate([(0.1, 2.0), (0.2, 3.0)]):
            acc = [9.0, 3.0][d] + noise[r.particle, r.start, 5, d] - xn[5][d] - (xn[5][d] - xn[4][d])
            assert r.y[d] == pytest.approx((acc - mean) / math.sqrt(std**2 + 0.3**2), abs=1e-9)


def test_large_csv_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    from tessera.plans import source_queries as Q

    rows = [(k, f'line {k}\n"quoted", and more\r\n' + "x" * 60 + str(k), "en" if k % 2 else None, 100) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(8)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    made = []
    write = Q.FS.write_csv
    monkeypatch.setattr(Q.FS, "write_csv", lambda df, path: (made.append(df.rdd.getNumPartitions()), write(df, path))[1])
    monkeypatch.setattr(Q, "CSV_FILE_BYTES", 10_000)
    many = sorted(map(tuple, Q.q_csv_split_roundtrip(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(Q, "CSV_FILE_BYTES", 1 << 29)
    one = sorted(map(tuple, Q.q_csv_split_roundtrip(spark, str(tmp_path)).collect()))
    assert many == one and len(one) == 400
    assert made[0] > 1 and made[1] == 1


def test_running_sums_keep_their_partitions(spark):
    long = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id")).alias("o"), F.lit(1.0).alias("v"))
    out = T.bucketed_cumsum(long, ["g"], "o", "v", "s", bucket_width=64)
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    assert out.where(F.col("s") != F.floor(F.col("o") / 3) + 1).count() == 0


def test_splits_are_cleaned_once(spark, tmp_path):
    from tessera.plans.model_queries import _splits

    rows = [(k, f"the {w} text number {k} about {w} things", w, 50) for k in range(40) for w in ("en", "de")]
    spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, text string, lang string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    train, test = _splits(spark, str(tmp_path), raw=True)
    assert train.count() == 64 and test.count() == 16
    assert "regexp" not in plan(train) and "regexp" not in plan(test)
    assert test.where("raw_text IS NULL").count() == 0


def test_padding_makes_its_rows_once(spark):
    df = spark.createDataFrame([(1, 0, [1, 2, 3]), (2, 0, []), (3, 1, [4])], "id long, batch long, ids array<bigint>")
    out = pad_batch(df, "batch", "ids")
    assert "Join" not in plan(out)
    got = {r["id"]: (r["ids"], list(r["masks"]), r["max_len"]) for r in out.collect()}
    assert got == {1: ([1, 2, 3], [1, 1, 1], 3), 2: ([0, 0, 0], [0, 0, 0], 3), 3: ([4], [1], 1)}


def test_words_dropped_as_by_the_general_cleaner(spark):
    texts = [
        None, "", "  ", "The cat_the the", "naïve thé the İ I", "don't won't it's", "a b the\x85it", "٣ the ৪a", "é thé s",
        "https://the.a/it http the", "_the_ the_ -the-", "𝒜 the 𝒜the", "x\nthe\r\ny\tand\x1cz", "THE ÀND And", "A1 1a the1 I'm",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    old = F.regexp_replace(F.trim(strip_non_alnum(remove_stopwords(F.lower("t"), STOPWORDS))), r"http\S+", "")
    for r in df.select("t", clean_text(F.col("t")).alias("new"), old.alias("old")).collect():
        assert r.new == r.old, r.t
