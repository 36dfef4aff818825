"""Scoring requests that arrive as files."""

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ontarmac.checks import model_queries
from ontarmac.operators import features as X, stages
from ontarmac.plans import serving, training
from ontarmac.sources.storage import Folder
from ontarmac.streaming import requests

REQUEST = {"request_id": "a", "year": 2024, "month": 5, "day_of_month": 3, "day_of_week": 5, "carrier": "AA", "origin": "JFK",
           "dest": "SFO", "crs_dep_time": 900, "crs_arr_time": 1230}


@pytest.fixture(scope="module")
def models(spark, flights):
    everything = {"train_fraction": 1.0, "valid_fraction": 1.0, "test_fraction": 1.0}
    small = stages.ModelSettings(max_iter=2, rf_num_trees=2, rf_max_depth=2)
    return training.compare(X.feature_table(flights, 1999, 2000), "lr,rf", settings=small, **everything).models


def send(folder, name, *changes):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(REQUEST | c) for c in changes))


def delivered(spark, output):
    return {
        table: sorted((r["request_id"], r["batch"]) for r in requests.read_delivered(spark, output, table).collect()) for table in requests.TABLES
    }


def test_batches_are_scored_once(spark, models, tmp_path):
    inbox, output, seen = tmp_path / "inbox", str(tmp_path / "out"), str(tmp_path / "seen")
    send(inbox, "1", {}, {"request_id": "b", "model_id": " RF "}, {"request_id": "c", "origin": "ZZZ"})
    requests.score_arrivals(spark, str(inbox), output, seen, models, "lr")
    send(inbox, "2", {"request_id": "d"}, {"request_id": "e", "month": "x"}, {"request_id": "f", "model_id": "gbt"})
    for _ in range(2):  # the second time nothing has come
        requests.score_arrivals(spark, str(inbox), output, seen, models, "lr")
    expected = {"scored": [("a", 0), ("b", 0), ("d", 1)], "rejected": [("c", 0), ("e", 1), ("f", 1)]}
    assert delivered(spark, output) == expected
    Folder(spark, f"{seen}/commits").delete("1")
    requests.score_arrivals(spark, str(inbox), output, seen, models, "lr")  # the batch is repeated
    assert delivered(spark, output) == expected
    table = serving.read_requests(spark, str(inbox))
    scored, rejected = serving.score_requests(table, models, "lr")
    columns = ["request_id", "model_id", "probability_delay_15", "risk_band"]
    assert sorted(requests.read_delivered(spark, output).select(*columns).collect()) == sorted(scored.select(*columns).collect())
    faults = requests.read_delivered(spark, output, "rejected").select("request_id", "faults")
    assert sorted(faults.collect()) == sorted(rejected.select("request_id", "faults").collect())


def test_a_batch_lost_on_the_way_is_written_anew(spark, models, tmp_path, monkeypatch):
    inbox, output, seen = tmp_path / "inbox", str(tmp_path / "out"), str(tmp_path / "seen")
    send(inbox, "1", {}, {"request_id": "c", "origin": "ZZZ"})
    whole = serving.score_requests
    with monkeypatch.context() as patch:
        # the accepted requests are written, then the job is lost
        patch.setattr(serving, "score_requests", lambda *a: (whole(*a)[0], whole(*a)[1].withColumn("x", F.raise_error(F.lit("lost")))))
        with pytest.raises(Exception, match="lost"):
            requests.score_arrivals(spark, str(inbox), output, seen, models, "lr")
    requests.score_arrivals(spark, str(inbox), output, seen, models, "lr")
    assert delivered(spark, output) == {"scored": [("a", 0)], "rejected": [("c", 0)]}


def test_unknown_tables(spark):
    with pytest.raises(ValueError, match="choose from scored, rejected"):
        requests.read_delivered(spark, "x", "other")


def test_the_query_takes_compressed_files_in_three_batches(spark, folder, models, tmp_path, monkeypatch):
    monkeypatch.setattr(model_queries, "compare", lambda *a: SimpleNamespace(models=models))
    monkeypatch.setattr(model_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    asked = model_queries.batch_requests(spark, folder).count()
    went = model_queries.stream_requests(spark, folder)
    assert went.count() == asked and went.select("request_id").distinct().count() == asked
    files = [f.name for f in (tmp_path / "arriving").iterdir() if f.name.startswith("part-")]
    assert len(files) == 3 * model_queries.FILES_AT_ONCE and all(f.endswith(".json.gz") for f in files)
    assert Folder(spark, str(tmp_path / "seen" / "commits")).names()[-3:] == ["0", "1", "2"]
