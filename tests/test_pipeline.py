"""CSV in, CSV out: the prepare and submit jobs on the stand-in tables."""

import tempfile

from fixtures import SF_SMALL

from ledgerlens.plans import pipeline as P
from ledgerlens.sources import standin as S


def test_prepare_and_submit(spark, monkeypatch):
    data = tempfile.mkdtemp(prefix="ledgerlens-csv-")
    out = tempfile.mkdtemp(prefix="ledgerlens-out-")
    S.account_labels(spark, SF_SMALL, "train").write.option("header", True).csv(f"{data}/{P.FILES['train']}")
    S.population_ids(spark, SF_SMALL, "test").write.option("header", True).csv(f"{data}/{P.FILES['test']}")
    S.users(spark, SF_SMALL).write.option("header", True).csv(f"{data}/{P.FILES['users']}")
    S.ledger(spark, SF_SMALL).write.option("header", True).csv(f"{data}/{P.FILES['transactions']}")

    inputs = P.load_inputs(spark, data)
    paths = P.prepare(spark, inputs, out)
    p2 = spark.read.option("header", True).csv(paths["data_p2"])
    p3 = spark.read.option("header", True).csv(paths["data_p3"])
    p4 = spark.read.option("header", True).csv(paths["data_p4"])
    n_train, n_test = inputs.train.count(), inputs.test.count()
    assert p2.count() == p3.count() == n_train
    assert p4.count() == n_test
    assert "inactive" in p3.columns and "inactive" not in p4.columns

    import ledgerlens.plans.scoring as scoring
    small = {"max_depth": 5, "max_features": 5, "min_samples_leaf": 1,
             "min_samples_split": 4, "n_estimators": 5}
    monkeypatch.setattr(scoring, "BEST_FOREST", small)
    orig = scoring.rank_inactive
    monkeypatch.setattr(P, "rank_inactive", lambda *a, **k: orig(*a, grid=small, **k))
    sub = spark.read.option("header", True).csv(P.submit(spark, inputs, out, k=10))
    ids = [int(r.id) for r in sub.collect()]
    assert len(ids) == 10 and all(i % 5 == 0 for i in ids)


def test_explore_train_and_score(spark):
    data, out = tempfile.mkdtemp(prefix="ledgerlens-csv-"), tempfile.mkdtemp(prefix="ledgerlens-out-")
    for name, df in {"train": S.account_labels(spark, SF_SMALL, "train"), "test": S.population_ids(spark, SF_SMALL, "test"),
                     "users": S.users(spark, SF_SMALL), "transactions": S.ledger(spark, SF_SMALL)}.items():
        df.write.option("header", True).csv(f"{data}/{P.FILES[name]}")
    inputs = P.load_inputs(spark, data)
    p3 = spark.read.option("header", True).csv(P.explore(spark, inputs, out))
    assert p3.count() == inputs.train.count() and {"area_type", "gender", "inactive"} <= set(p3.columns)
    small = {"max_depth": 5, "max_features": 5, "min_samples_leaf": 1, "min_samples_split": 4, "n_estimators": 5}
    P.train(spark, inputs, out, small)
    ids = [int(r.id) for r in spark.read.option("header", True).csv(P.score(spark, inputs, out, k=10)).collect()]
    assert len(ids) == 10 and all(i % 5 == 0 for i in ids)


def test_null_tokens_and_infinite_numbers(spark):
    from ledgerlens.sources.files import read_csv, write_csv
    from ledgerlens.sources.schema import USERS

    path = tempfile.mkdtemp(prefix="ledgerlens-csv-") + "/u"
    rows = [("1", "NaN", "2020-01-02 03:04:05", "x"), ("2", "NA", "2020-01-02T03:04:05.5", "nan"), ("3", "inf", "", "NULL"),
            ("4", "-inf", "n/a", "None"), ("5", "1.5", None, " kept ")]
    write_csv(spark.createDataFrame(rows, "id string, start_balance string, registration_time string, account_type string")
              .selectExpr("*", "'' business_type", "'a' area_name", "'b' area_type", "'c' gender"), path)
    got = {r.id: r for r in read_csv(spark, path, USERS).collect()}
    assert [got[i].start_balance for i in range(1, 6)] == [None, None, 0.0, 0.0, 1.5]
    assert [got[i].account_type for i in range(1, 6)] == ["x", None, None, None, " kept "]
    assert got[1].registration_time.second == 5 and got[2].registration_time.microsecond == 500_000
    assert got[3].registration_time is None and got[5].business_type is None


def test_job_leaves_the_session_alone_and_no_stages(spark):
    import os

    from ledgerlens.sources.files import stage_folder

    data = tempfile.mkdtemp(prefix="ledgerlens-csv-")
    out = tempfile.mkdtemp(prefix="ledgerlens-out-")
    for name, df in {"a": S.account_labels(spark, SF_SMALL, "train"), "b": S.population_ids(spark, SF_SMALL, "test"),
                     "c": S.users(spark, SF_SMALL), "d": S.ledger(spark, SF_SMALL)}.items():
        df.write.option("header", True).csv(f"{data}/{name}")
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.shuffle.partitions")
    P.main(["prepare", "--data", data, "--out", out, "--train", "a", "--test", "b", "--users", "c", "--transactions", "d"])
    assert (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.shuffle.partitions")) == before
    assert sorted(os.listdir(out)) == ["data_p2", "data_p3", "data_p4"]
    assert not os.path.exists(stage_folder(spark).removeprefix("file:"))


def test_a_cluster_needs_a_checkpoint_folder():
    import subprocess
    import sys

    from fixtures import ROOT

    code = ("import sys; sys.path.insert(0, %r)\n"
            "from types import SimpleNamespace as N\n"
            "from ledgerlens.session import checkpoint_dir\n"
            "for master, ok in (('local[2]', True), ('local', True), ('local-cluster[2,1,512]', False), ('yarn', False)):\n"
            "    kept = []\n"
            "    sc = N(master=master, getCheckpointDir=lambda: kept[-1] if kept else None, setCheckpointDir=kept.append)\n"
            "    try:\n"
            "        checkpoint_dir(N(sparkContext=sc, conf=N(get=lambda *a: None)))\n"
            "        assert ok, master\n"
            "    except RuntimeError:\n"
            "        assert not ok, master\n") % ROOT
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
