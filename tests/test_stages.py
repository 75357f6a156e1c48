import math
import random

import pytest
from pyspark.sql import functions as F

from stridewatch.operators import drift, quality, registry
from stridewatch.plans import stages
from stridewatch.sources import read_history


def write_subject(folder, subject, seconds=16, seed=0):
    """Two activities that differ in amplitude, a transient stretch, a slow signal at 10 Hz."""
    rng = random.Random(subject * 1000 + seed)
    lines = []
    for i in range(seconds * 300):
        time = i / 100
        activity = (1, 0, 2)[min(i // (seconds * 100), 2)]
        rate = f"{70 + 20 * activity + rng.random():.3f}" if i % 10 == 0 else "NaN"
        swing = 1 + 4 * activity
        channels = [f"{swing * math.sin(i / 7 + c) + rng.gauss(0, 0.2):.4f}" for c in range(51)]
        lines.append(" ".join([f"{time:.2f}", str(activity), rate, *channels]))
    (folder / f"subject{subject}.dat").write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def settings(tmp_path_factory):
    return stages.Settings(
        root=str(tmp_path_factory.mktemp("tables")),
        train_subjects=(101, 102),
        holdout_subjects=(107,),
        expected_subjects=3,
        params={"numTrees": 5, "maxDepth": 3, "seed": 42},
    )


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for subject in (101, 102, 107):
        write_subject(folder, subject)
    return str(folder)


def test_all_stages(spark, settings, raw):
    report = stages.run_all(spark, raw, settings)
    assert report.model_version == 1 and report.realised_macro_f1 == 1.0
    assert report.performance_delta == 0.0 and report.status != "performance_degraded"

    gold = spark.read.parquet(settings.at("gold_features"))
    assert len(gold.columns) == 205
    assert report.reference_rows == gold.filter("split = 'train'").count() > 0
    assert report.current_rows == gold.filter("split = 'holdout'").count() > 0
    bronze = spark.read.parquet(settings.at("bronze_readings"))
    assert len(bronze.columns) == 45

    run = read_history(spark, settings.at("runs")).first()
    assert run.tags["train_subjects"] == "101,102" and run.tags["holdout_subjects"] == "107"
    assert run.metrics["n_features"] == 198.0 and run.metrics["holdout_macro_f1"] == 1.0
    classes = {r["class"] for r in read_history(spark, settings.at("run_reports")).collect()}
    assert classes == {"1", "2", "accuracy", "macro avg", "weighted avg"}
    tags = {r.key: r.value for r in read_history(spark, settings.at("model_tags")).collect()}
    assert tags["gate_passed"] == "true" and tags["gate_comparison"] == "no existing champion"
    version = read_history(spark, settings.at("model_versions")).first()
    assert len(version.inputs) == 198 and version.inputs[0]["type"] == "double"


def test_every_features_drift_is_kept(spark, settings):
    report = stages.drift_history(spark, settings).first()
    detail = read_history(spark, settings.at("drift_features"), report_id=report.report_id)
    assert detail.count() == 198
    worst = detail.filter("NOT isnan(psi)").orderBy(F.desc("psi"), "feature").first()
    assert (worst.feature, worst.psi) == (report.top_drifted_feature, report.max_feature_psi)
    bands = {r.band: r["count"] for r in detail.groupBy("band").count().collect()}
    assert bands.get("significant", 0) == report.features_significant


def test_monitoring_reads_no_training_row(spark, settings):
    champion = stages.champion_of(spark, settings)
    edges, labels = stages.baseline_of(spark, settings, champion.run_id)
    assert edges.count() == 198
    assert not [f for f in edges.inputFiles() + labels.inputFiles() if "gold_features" in f]
    gold = spark.read.parquet(settings.at("gold_features"))
    train = gold.filter("split = 'train'")
    assert labels.agg(F.sum("n")).first()[0] == train.count()
    inputs = stages.gold_inputs(gold)
    current = gold.filter("split = 'holdout'")
    found = drift.psi_from_baseline(edges, current, inputs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "gold_features" in line]
    assert scans and all("split" in line and "= holdout" in line for line in scans)
    want = {r.feature: r.psi for r in drift.psi(train, current, inputs).collect()}
    for row in found.collect():
        assert row.psi == pytest.approx(want[row.feature], nan_ok=True, abs=1e-9)


def test_a_run_without_a_baseline_gets_one(spark, settings):
    run_id = stages.champion_of(spark, settings).run_id
    coarse = stages.Settings(**{**settings.__dict__, "bins": 5})
    edges, labels = stages.baseline_of(spark, coarse, run_id)
    assert edges.agg(F.max(F.size("counts"))).first()[0] == 5
    assert labels.count() == labels.select("category").distinct().count()


def test_another_models_run_is_not_promoted(spark, settings):
    other = stages.Settings(**{**settings.__dict__, "model_name": "other"})
    with pytest.raises(registry.GateFailed, match="no finished run of other"):
        stages.promote(spark, other)
    run_id = stages.train(spark, other)
    assert stages.promote(spark, other).run_id == run_id
    assert stages.champion_of(spark, other).run_id == run_id
    assert stages.champion_of(spark, settings).run_id != run_id


def test_scoring_twice_does_not_fan_out_the_report(spark, settings):
    before = read_history(spark, settings.at("drift_metrics")).first()
    summary = stages.score_batch(spark, settings).first()
    assert summary["rows"] == 2 * before.current_rows and summary.accuracy == 1.0
    again = stages.monitor(spark, settings)
    assert again.current_rows == before.current_rows


def test_failed_gate_keeps_the_champion(spark, settings):
    strict = stages.Settings(**{**settings.__dict__, "floor": 1.5})
    stages.train(spark, strict)
    with pytest.raises(registry.GateFailed, match="above_floor"):
        stages.promote(spark, strict)
    assert stages.champion_of(spark, settings).version == 1
    now = registry.alias_current(read_history(spark, settings.at("model_aliases")))
    assert {(r.alias, r.version) for r in now.collect()} == {("champion", 1), ("challenger", 2)}


def test_degraded_performance_is_reported_and_then_raised(spark, settings):
    before = read_history(spark, settings.at("drift_metrics")).count()
    wrong = (
        read_history(spark, settings.at("predictions"))
        .withColumn("predicted_activity_id", F.lit(1).cast("long"))
        .withColumn("scored_at", F.current_timestamp())
        .collect()
    )
    later = spark.createDataFrame(wrong, read_history(spark, settings.at("predictions")).schema)
    stages.append_history(later, settings.at("predictions"), ["model_version"])
    with pytest.raises(drift.PerformanceDegraded):
        stages.monitor(spark, settings)
    assert read_history(spark, settings.at("drift_metrics")).count() == before + 1


def test_wrong_subject_count_stops_the_run(spark, settings, raw):
    wrong = stages.Settings(**{**settings.__dict__, "expected_subjects": 9})
    with pytest.raises(quality.ContractViolation, match="9 distinct subject_id"):
        stages.ingest(spark, raw, wrong)


def test_no_champion(spark, tmp_path):
    with pytest.raises(LookupError):
        stages.champion_of(spark, stages.Settings(root=str(tmp_path)))


def test_the_written_tables_contract_still_raises(spark, settings):
    """Measured during the write, a broken contract stops the run as before."""
    impossible = stages.Settings(**{**settings.__dict__, "feature_null_limit": 0.0})
    with pytest.raises(quality.ContractViolation, match="null rate below 0.0"):
        stages.build_features(spark, impossible)


def test_metrics_of_all_batches_come_from_their_counts(spark, settings):
    champion = stages.champion_of(spark, settings)
    kept = read_history(spark, settings.at("scored_counts"), model_version=champion.version)
    assert not [f for f in kept.inputFiles() if "predictions" in f]
    found = stages.scored_metrics(spark, settings, champion.version).first()
    scored = read_history(spark, settings.at("predictions"), model_version=champion.version)
    scored = scored.filter(F.col("batch_id").isNotNull() & (F.col("model_name") == settings.model_name))
    batches = kept.filter(F.col("model_name") == settings.model_name).select("batch_id").distinct()
    scored = scored.join(batches, "batch_id").filter(F.col("scored_at").isNotNull())
    latest = stages.scored_metrics(spark, settings, champion.version, kept.agg(F.max("scored_at")).first()[0]).first()
    assert found.macro_f1 == 1.0 and latest.macro_f1 == 1.0


def test_broken_lines_are_kept_with_their_reasons(spark, settings, tmp_path):
    for subject in (101, 102, 107):
        write_subject(tmp_path, subject)
    with open(tmp_path / "subject101.dat", "a") as file:
        file.write("1.00 1 70 short line\n")
    where = stages.Settings(**{**settings.__dict__, "root": str(tmp_path / "tables")})
    raw = str(tmp_path / "*.dat")
    stages.ingest(spark, raw, where)
    kept = read_history(spark, where.at("rejected_lines")).collect()
    assert [(r.source_file, r.line, r.reason) for r in kept] == [
        ("subject101.dat", "1.00 1 70 short line", "too few values")
    ]
    with pytest.raises(quality.ContractViolation, match="rejected lines at most 0.0"):
        stages.ingest(spark, raw, stages.Settings(**{**where.__dict__, "reject_limit": 0.0}))


def test_two_promotions_at_once(spark, settings, monkeypatch):
    """The second begins after the first has read the tables: two versions, one champion, judged in order."""
    both = stages.Settings(**{**settings.__dict__, "model_name": "contested"})
    stages.train(spark, both)
    inner, claimed = [], stages.claim_next

    def interrupted(*args):
        if not inner:
            inner.append(None)
            inner[0] = stages.promote(spark, both)
        return claimed(*args)

    monkeypatch.setattr(stages, "claim_next", interrupted)
    outer = stages.promote(spark, both)
    assert (inner[0].version, outer.version) == (1, 2)
    assert inner[0].comparison == "no existing champion" and outer.comparison.startswith("champion 1.0000")
    events = read_history(spark, both.at("model_aliases")).filter("model_name = 'contested'")
    assert sorted((r.seq, r.version) for r in events.collect()) == [(1, 1), (2, 2)]
    assert stages.champion_of(spark, both).version == 2


def test_an_abandoned_claim_is_not_awaited_forever(spark, settings):
    late = stages.Settings(**{**settings.__dict__, "model_name": "late", "claim_wait_seconds": 1.0})
    stages.train(spark, late)
    from stridewatch.sources import claim, claim_folder

    assert claim(spark, claim_folder(late.at("claims"), "late", "aliases"), 1, "a writer that stopped")
    assert stages.promote(spark, late).version == 1
    assert stages.champion_of(spark, late).version == 1
