import json
import os

import pytest

from linkwright.jobs import cli, config, dataset, keyed_run, run
from linkwright.jobs.storage import Storage
from linkwright.operators import keyed
from linkwright.sources import files


def lines(path):
    with open(path, encoding="utf-8") as f:
        return [x.split("\t") for x in f.read().splitlines()]


@pytest.fixture(scope="module")
def demo(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("data"))
    dataset.make_demo(spark, root)
    return root


@pytest.fixture
def settings(demo, tmp_path):
    path = tmp_path / "settings.json"
    path.write_text(json.dumps({"data_root": demo, "output_dir": f"{tmp_path}/out", "cache_dir": f"{tmp_path}/cache", "model_dir": f"{tmp_path}/models", "rf_estimators": 10, "random_forest_max_depth": 4, "threshold_steps": 6}))
    return str(path)


def test_settings(tmp_path):
    def given(**values):
        path = tmp_path / "c.json"
        path.write_text(json.dumps(values))
        return config.load(str(path))

    assert config.load() == config.Config() and given(seed=7).seed == 7
    assert config.load(None, max_train_records=5, data_root=None).max_train_records == 5
    assert config.Config().within("/base").data_root == "/base/dataset" and config.Config(data_root="s3a://x/y").within("/b").data_root == "s3a://x/y"
    for bad in ({"speed": 1}, {"validation_fraction": 1}, {"max_candidates_per_entity": 0}, {"minhash_bands": 7}, {"cardinality": "some"}):
        with pytest.raises(ValueError):
            given(**bad)


def test_dataset(spark, demo, tmp_path):
    state = dataset.discover(spark, demo)
    assert state["mode"] == "demo" and state["complete"] and not state["submission_allowed"] and state["marker"]["seed"] == 42
    assert dataset.schema_errors(spark, demo) == [] and dataset.readiness(spark, demo)[0] == 0
    assert dataset.row_counts(spark, demo)["train_source1"] == 24
    empty = str(tmp_path / "none")
    assert dataset.discover(spark, empty)["mode"] == "missing" and dataset.readiness(spark, empty)[0] == 1
    folder = Storage(spark, str(tmp_path / "odd"))
    for place in dataset.PLACES.values():
        folder.put(place, b"id\tcolour\nA\tred\n")
    assert dataset.discover(spark, folder.root)["mode"] == "official" and len(dataset.schema_errors(spark, folder.root)) == 6 and dataset.readiness(spark, folder.root)[0] == 2


def test_exit_codes(spark, demo, settings, tmp_path, capsys):
    assert cli.main(["--config", settings, "--check-data"], spark) == 0
    assert cli.main(["--config", settings, "--data-root", str(tmp_path / "none")], spark) == 3
    folder = Storage(spark, str(tmp_path / "odd"))
    for place in dataset.PLACES.values():
        folder.put(place, b"id\tcolour\nA\tred\n")
    assert cli.main(["--config", settings, "--data-root", folder.root], spark) == 4
    (tmp_path / "bad.json").write_text('{"speed": 1}')
    assert cli.main(["--config", str(tmp_path / "bad.json")], spark) == 2
    assert cli.main(["--config", settings, "--stage", "inspect"], spark) == 0
    report = json.loads((tmp_path / "out/schema_summary.json").read_text())
    assert report["sources"]["train_source1"]["n_rows"] == 24 and report["sources"]["test_source1"]["columns"][1] == "business_name"
    assert cli.main(["--config", settings, "--keyed", "simple"], spark) == 0 and '"entities": 9' in capsys.readouterr().out


def test_whole_run(spark, demo, settings, tmp_path):
    c = config.load(settings)
    report = run.run(spark, c)
    out = tmp_path / "out"
    assert report["status"] == "complete" and report["dataset_mode"] == "demo" and report["test"]["source1_records"] == 9
    found, listed = lines(out / "matching_results.tsv"), lines(out / "candidate_pairs.tsv")
    assert found[0] == ["source1_entity_id", "matched_entity_ids"] and len(found) == len(listed) == 10
    assert [r[0] for r in found[1:]] == sorted(r[0] for r in found[1:]) and lines(out / "submission/matching_results.tsv") == found
    within = {r[0]: set(r[1].split(",")) for r in listed}
    own = 0
    for sid, ids in found[1:]:
        partners = {x for x in ids.split(",") if x}
        assert partners <= within[sid]
        own += len([x for x in partners if x[3:] == sid[3:]])
    assert own >= 8  # most partners differ in spelling only
    pairs = lines(out / "debug_candidate_pairs.tsv")
    assert pairs[1:] == sorted(pairs[1:], key=lambda r: (r[0], r[1], -float(r[5]), r[2])) and len(pairs) - 1 == report["test"]["candidate_pairs"]
    matches = lines(out / "debug_matching_results.tsv")
    assert matches[1:] == sorted(matches[1:], key=lambda r: r[:3])
    assert "held-out macro F0.5" in (out / "validation_report.txt").read_text() and os.path.getsize(out / "submission.zip") > 0
    assert {"run_metadata.json", "diagnostics.json"} <= set(os.listdir(out))
    saved = json.loads((tmp_path / "models/metadata.json").read_text())
    assert saved["optimal_threshold"] == report["threshold"] and len(saved["features"]) == 38
    # kept tables are read back, and the result is the same
    again = run.run(spark, c, "scoring")
    assert again["scored_pairs"] == report["test"]["candidate_pairs"] and lines(tmp_path / "cache/test_scored_pairs.tsv")[0][:3] == ["source1_id", "target_source", "target_id"]
    assert run.run(spark, c, "blocking")["test_candidate_pairs"] == report["test"]["candidate_pairs"]
    with pytest.raises(ValueError):
        run.run(spark, c, "sing")


@pytest.mark.parametrize("mode", ["simple", "strict"])
def test_keyed_files(spark, tmp_path, mode):
    folder = Storage(spark, str(tmp_path / "test"))
    head = b"whatever\tthe\theader\tsays\n"
    folder.put("test_source1.tsv", head + "S1-b\tCafé Société Lyon\t12 Rue A\tFrance\nS1-a\tAcme Rockets Inc\t7 Mill Lane\tIndia\textra\nS1-c\tshort\n".encode())
    folder.put("test_source2.tsv", head + "S2-1\tCafe Societe Lyon SARL\t12 Rue A\tFrance\nS2-2\tAcme Rockets Ltd\t7 Mill Lane\tIndia\nS2-3\tshort\n".encode())
    folder.put("test_source3.tsv", head + "S3-1\tACME Rockets\t7 Mill Lane\tIndia\n".encode())
    counts = keyed_run.match_files(spark, folder.root, str(tmp_path / "out"), mode)
    found = dict(lines(tmp_path / "out/matching_results.tsv")[1:])
    french = "S2-1" if mode == "strict" else ""  # the simple mode cuts words at letters with marks
    assert list(found) == ["S1-b", "S1-a", "S1-c"] and found["S1-a"] == "S2-2,S3-1" and found["S1-c"] == "" and found["S1-b"] == french
    assert counts["entities"] == 3 and counts["match_pairs"] == (3 if french else 2) and lines(tmp_path / "out/submission/candidate_pairs.tsv")[0][1] == "candidate_entity_ids"


def test_marks_are_decomposed(spark):
    rows = spark.createDataFrame([("Café Société",), ("Plain Name",), ("東京 Trading",), (None,)], "n string")
    got = [r[0] for r in rows.select(keyed.tokens(keyed.plain(rows["n"]), 2)).collect()]
    assert got == [["cafe", "societe"], ["plain", "name"], [], None]


def test_first_rows(spark):
    df = spark.range(1000).selectExpr("id", "id * 7919 % 1000 AS k").repartition(7)
    for n in (0, 1, 500, 999, 1000, 2000):
        assert sorted(r["k"] for r in files.first_rows(df, ["k"], n).collect()) == list(range(min(n, 1000)))


def test_header_resolution():
    assert files.resolve(["Record ID", "Company-Name "], "business_name") == "Company-Name " and files.resolve(["x"], "id") is None
    assert files.resolve(["a", "name"], "business_name", "") == "name" and files.resolve(["My Col", "name"], "business_name", "my_col") == "My Col"
    assert files.resolve(["business id", "ID"], "id") == "ID" and files.resolve(["id", "ID"], "id") == "ID"
    with pytest.raises(ValueError):
        files.resolve(["a"], "id", "b")
