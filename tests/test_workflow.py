"""The whole passenger workflow: CSV, feature tables, training set, models, champion, scoring."""

from __future__ import annotations

import csv
import random
import uuid

from pyspark.sql import functions as F

from featloom.learning.score import StoredModel, load_model, save_model, score, score_batch
from featloom.learning.train import fit_validate_refit, predict, train_forest, train_gbt
from featloom.operators.evaluate import evaluate_classifier
from featloom.operators.lookup import training_set
from featloom.operators.runs import add_versions, champion, current, promote, run
from featloom.operators.split import split
from featloom.plans import passengers as p
from featloom.sources.csv import read_csv_typed
from featloom.sources.feature_tables import create_feature_table, drop_feature_table, merge
from featloom.sources.tables import save_overwrite


def write_passengers(path, count=300):
    draw = random.Random(5)
    with open(path, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(p.RAW_SCHEMA.fieldNames())
        for i in range(count):
            sex = draw.choice(["male", "female"])
            survived = int(draw.random() < (0.85 if sex == "female" else 0.15))
            title = {"male": "Mr", "female": "Mrs"}[sex]
            name = f'Doe, {title}. "X" Y' + (" (Second Name)" if draw.random() < 0.3 else "")
            writer.writerow([
                f"p{i}", survived, draw.choice("123"), name, sex,
                draw.choice(["", "NaN", str(draw.randint(1, 80))]), draw.choice("012"),
                draw.choice("01"), draw.choice(["PC 17", "113", ""]), draw.choice(["7.5", "8.4"]),
                draw.choice(["B5 B7", "C2", ""]), draw.choice(["S", "C", ""]),
            ])


def test_workflow(spark, tmp_path):
    path = f"{tmp_path}/passengers.csv"
    write_passengers(path)
    raw = read_csv_typed(spark, path, p.RAW_SCHEMA, required=[p.LABEL])
    flat = save_overwrite(p.flat_features(raw), f"train_{uuid.uuid4().hex}")
    assert flat.count() == 300

    names = [f"ticket_{uuid.uuid4().hex}", f"people_{uuid.uuid4().hex}"]
    for name, make in zip(names, (p.ticket_features, p.demographic_features)):
        rows = make(raw)
        assert create_feature_table(spark, name, p.ID, rows.schema, comment=name, buckets=4)
        merge(spark, name, rows)

    spine = flat.select(p.ID, p.LABEL)
    data = training_set(spine, p.passenger_lookups(*names), p.LABEL, [p.ID])
    assert data.df.columns == [p.LABEL, *p.TICKET_LOOKED_UP, *p.DEMOGRAPHIC_LOOKED_UP]
    assert set(data.features) == set(p.LOOKUP_SPEC.columns)
    with_id = training_set(spine, p.passenger_lookups(*names), p.LABEL)
    refit = fit_validate_refit(with_id.df, p.LOOKUP_SPEC, p.LABEL, key=p.ID, rounds=2)

    # Two models on the flat table, compared on the same held-out rows.
    train, held = split(flat, p.ID)
    models = {
        "gbt": train_gbt(train, p.FLAT_SPEC, p.LABEL, rounds=2),
        "forest": train_forest(train, p.FLAT_SPEC, p.LABEL, trees=5, fraction=0.7),
    }
    logged = []
    for name, model in models.items():
        place = f"{tmp_path}/{name}"
        save_model(StoredModel(model), place, spark)
        found = evaluate_classifier(predict(model, held), label=p.LABEL).first()
        assert found.example_count == held.count() and found.f1 > 0.6 and found.roc_auc > 0.7
        logged.append((name, place, found.f1))
    runs = spark.createDataFrame(logged, "run_id string, location string, f1_score double")

    best = champion(runs, "f1_score").select(F.lit("model").alias("name"), "run_id")
    empty = spark.createDataFrame([], "name string, version int, run_id string, stage string")
    versions = promote(add_versions(empty, best), add_versions(empty, best).select("name", "version"))
    chosen = current(versions, "model").first()
    assert (chosen.version, chosen.run_id) == (1, max(logged, key=lambda r: r[2])[0])

    stored = load_model(spark, run(runs, chosen.run_id).first().location)
    scored = save_overwrite(score(flat, stored), f"predictions_{uuid.uuid4().hex}")
    assert scored.columns == [*flat.columns, "predictions"] and scored.count() == 300

    save_model(StoredModel(refit.model, data.lookups), f"{tmp_path}/refit", spark)
    batch = score_batch(spine.select(p.ID), load_model(spark, f"{tmp_path}/refit"))
    assert batch.count() == 300
    right = batch.join(spine, p.ID).filter(F.col("prediction") == F.col(p.LABEL)).count()
    assert right > 200
    for name in names:
        drop_feature_table(spark, name)
