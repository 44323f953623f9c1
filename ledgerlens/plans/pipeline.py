"""End-to-end jobs over CSV inputs, with the file contract of the original
workflow: four CSV inputs (train labels, test ids, profiles, transactions)
and CSV outputs ``data_p2`` (base features, train), ``data_p3`` (model
features, train), ``data_p4`` (model features, test) and ``submission``
(the 500 test ids most likely to become inactive, best first); ``explore``
writes ``data_p3_eda``, the exploration variant of the training features.
``train`` stores the fitted forest (``ranker``) and ``score`` ranks a
population with it, without the training rows.

    python -m ledgerlens.plans.pipeline prepare  --data DIR --out DIR
    python -m ledgerlens.plans.pipeline submit   --data DIR --out DIR
    python -m ledgerlens.plans.pipeline explore  --data DIR --out DIR
    python -m ledgerlens.plans.pipeline train    --data DIR --out DIR
    python -m ledgerlens.plans.pipeline score    --data DIR --out DIR [--ranker DIR]

Each output is a folder of CSV part files (one per task; no single-file
coalesce, which would funnel the table through one task).
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.ledger import edge_table
from ledgerlens.plans.base import AMOUNT_COLUMNS, base_features
from ledgerlens.plans.features import eda_features, model_features
from ledgerlens.plans.scoring import Ranker, fit_ranker, rank_inactive, score_inactive
from ledgerlens.session import materialize
from ledgerlens.sources.files import read_csv, remove_stages, stage_handoff, write_csv
from ledgerlens.sources.schema import LABELS, POPULATION, TRANSACTIONS, USERS

# Names of the inputs in the data folder, unless given.
FILES = {"train": "train.csv", "test": "test.csv", "users": "users.csv", "transactions": "transactions.csv"}


@dataclass
class Inputs:
    train: DataFrame
    test: DataFrame
    users: DataFrame
    transactions: DataFrame


def load_inputs(spark: SparkSession, data_dir: str, files: dict[str, str] | None = None) -> Inputs:
    """The four CSV inputs with declared schemas."""
    d, names = data_dir.rstrip("/"), FILES | (files or {})
    schemas = {"train": LABELS, "test": POPULATION, "users": USERS, "transactions": TRANSACTIONS}
    return Inputs(**{k: read_csv(spark, f"{d}/{names[k]}", schema) for k, schema in schemas.items()})


def prepare(spark: SparkSession, inputs: Inputs, out_dir: str) -> dict[str, str]:
    """Write p2 and p3 of the training population and p4 of the test
    population (each population refitted on itself, as the original
    preparation scripts do)."""
    out = out_dir.rstrip("/")
    edges = stage_handoff(edge_table(inputs.transactions), "edges")
    p2 = materialize(base_features(inputs.train, inputs.users, inputs.transactions,
                                   keep_amounts=True, edges=edges))
    write_csv(p2.drop(*AMOUNT_COLUMNS), f"{out}/data_p2")
    write_csv(model_features(p2), f"{out}/data_p3")
    p4 = materialize(base_features(inputs.test, inputs.users, inputs.transactions,
                                   keep_amounts=True, edges=edges))
    write_csv(model_features(p4), f"{out}/data_p4")
    return {name: f"{out}/{name}" for name in ("data_p2", "data_p3", "data_p4")}


def submit(spark: SparkSession, inputs: Inputs, out_dir: str, k: int = 500) -> str:
    """Fit the ranking forest on the training population and write the
    ``k`` most likely inactive test ids, best first."""
    run = rank_inactive(inputs.train, inputs.test, inputs.users, inputs.transactions, k=k)
    path = f"{out_dir.rstrip('/')}/submission"
    # the top-k output is one ordered partition of at most k rows
    write_csv(run.top.coalesce(1), path)
    return path


def explore(spark: SparkSession, inputs: Inputs, out_dir: str) -> str:
    """Write the exploration variant of the training features (C5): label, two raw category columns,
    logs and log-ratios."""
    path = f"{out_dir.rstrip('/')}/data_p3_eda"
    write_csv(eda_features(base_features(inputs.train, inputs.users, inputs.transactions)), path)
    return path


def train(spark: SparkSession, inputs: Inputs, out_dir: str, grid: dict | None = None) -> str:
    """Fit the ranking forest on the training population and store it."""
    ranker, _ = fit_ranker(inputs.train, inputs.users, inputs.transactions, **({"grid": grid} if grid else {}))
    path = f"{out_dir.rstrip('/')}/ranker"
    ranker.save(path)
    return path


def score(spark: SparkSession, inputs: Inputs, out_dir: str, ranker: str | None = None, k: int = 500) -> str:
    """Rank the test population with a stored forest and write the ``k`` first ids, best first."""
    out = out_dir.rstrip("/")
    top = score_inactive(Ranker.load(spark, ranker or f"{out}/ranker"), inputs.test, inputs.users, inputs.transactions, k)
    write_csv(top.coalesce(1), f"{out}/submission")  # one ordered partition of at most k rows
    return f"{out}/submission"


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run one job in the session that the platform (``spark-submit``) sets up: no master, partition
    count or memory is chosen here.  The run's own stages are removed at its end."""
    ap = argparse.ArgumentParser(prog="ledgerlens")
    ap.add_argument("job", choices=["prepare", "submit", "explore", "train", "score"])
    ap.add_argument("--data", required=True, help="folder with the four input CSV files")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--k", type=int, default=500)
    ap.add_argument("--ranker", help="folder of a stored forest (default: ranker in --out)")
    for name, default in FILES.items():
        ap.add_argument(f"--{name}", default=default, help=f"file or folder name in --data (default {default})")
    args = ap.parse_args(argv)
    spark = spark or SparkSession.builder.appName("ledgerlens").getOrCreate()
    inputs = load_inputs(spark, args.data, {k: getattr(args, k) for k in FILES})
    try:
        if args.job == "prepare":
            print(prepare(spark, inputs, args.out))
        elif args.job == "submit":
            print(submit(spark, inputs, args.out, args.k))
        elif args.job == "explore":
            print(explore(spark, inputs, args.out))
        elif args.job == "train":
            print(train(spark, inputs, args.out))
        else:
            print(score(spark, inputs, args.out, args.ranker, args.k))
    finally:
        remove_stages(spark)


if __name__ == "__main__":
    main()
