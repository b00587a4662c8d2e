"""Files, run tables, plug-ins and streams."""

import datetime
import gzip
import json
import os
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from newsprep import session
from newsprep.functions import chat
from newsprep.operators import governance, plugins
from newsprep.plans.catalog import QUERIES
from newsprep.sources import articles, datasets, predictions, runs
from newsprep.streaming import monitors, registry

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_contract(spark):
    df = spark.createDataFrame([("t", 1)], "Content string, extra int")
    rows = [(r["column"], r["present"]) for r in articles.schema_contract(df).collect()]
    assert rows == [("Content", True), ("Sentiment", False), ("Summary", False)]
    with pytest.raises(ValueError, match="Sentiment.*Summary"):
        articles.schema_contract(df, strict=True)


@pytest.mark.parametrize("kind", ["parquet", "json", "csv"])
def test_read_articles(spark, tmp_path, kind):
    df = spark.createDataFrame(
        [(1, "two words", "s", "Positive", 5)],
        "row_id long, Content string, Summary string, Sentiment string, extra int",
    )
    path = str(tmp_path / kind)
    df.write.format(kind).option("header", True).save(path)
    options = {"header": True} if kind == "csv" else None
    row = articles.read_articles(spark, path, format=kind, options=options).collect()[0]
    assert (str(row["row_id"]), row["Content"], len(row)) == ("1", "two words", 4)


def test_scan_reads_only_what_is_used(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").withColumns(
        {"Summary": F.lit("s"), "Sentiment": F.lit("Positive"), "Content": F.col("text")})
    loaded = articles.load_articles(documents, row_id="doc_id").filter("row_id < 9")
    plan = loaded.select("row_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan and "LessThan(doc_id,9)" in plan


def test_dataset_is_pruned_by_split(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "train", 5, False), (2, "test", 6, True)],
        "row_id int, split string, sequence_length int, was_truncated boolean")
    path = str(tmp_path / "sft")
    datasets.write_sft_dataset(df, path)
    test = datasets.read_sft_dataset(spark, path, "test")
    assert set(test.columns) == {"row_id", "split"} and test.collect()[0]["row_id"] == 2
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_predictions_keep_nulls_and_text(spark, tmp_path):
    record = (0, "Positive", None, "ré\n\"x\"", None, 0.25, False, "")
    path = str(tmp_path / "predictions")
    predictions.write_predictions(
        spark.createDataFrame([record], predictions.RECORD_SCHEMA), path)
    assert tuple(predictions.read_predictions(spark, path).collect()[0]) == record
    # Some of the files hold no row.
    line = "".join(f.read_text() for f in (tmp_path / "predictions").glob("*.json")).strip()
    assert json.loads(line)["predicted_sentiment"] is None and len(json.loads(line)) == 8


def test_resume_looks_at_one_run(spark, tmp_path):
    def records(*ids):
        rows = [(i, "Positive", None, "r", None, 0.5, False, "x") for i in ids]
        return spark.createDataFrame(rows, predictions.RECORD_SCHEMA)

    path, want = str(tmp_path / "scored"), spark.createDataFrame([(1,), (2,), (3,)], "row_id int")
    predictions.append_predictions(records(1, 2, 3), path, "one")
    predictions.append_predictions(records(1), path, "two")
    predictions.append_predictions(records(2), path, "two")
    stored = predictions.read_runs(spark, path)
    assert stored.count() == 5 and set(stored.columns) >= {"index", "raw_response", "run_id"}
    left = predictions.resume_unscored
    assert [r["row_id"] for r in left(want, stored, run="two").collect()] == [3]
    assert left(want, stored, run="one").count() == 0 and left(want, stored, run="new").count() == 3
    assert left(want, stored).count() == 0


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("extra,Sentiment,row_id,Summary,Content\n7,Positive,1,s,text\n")
    loaded = articles.read_articles(spark, str(tmp_path / "a.csv"), format="csv")
    assert [tuple(r) for r in loaded.collect()] == [("1", "text", "s", "Positive")]
    with pytest.raises(ValueError, match="missing"):
        articles.read_articles(spark, str(tmp_path / "a.csv"), format="csv", keep=("source",))


MANIFEST = {
    "status": "completed", "created_at": "2024-05-01T10:00:00+00:00",
    "completed_at": "2024-05-01T12:30:00+00:00",
    "command_arguments": {"seed": 42, "limit": 5000, "no_deduplicate": False, "note": None},
    "model": {"id": "m", "resolved_revision": "abc"},
    "dataset": {"id": "d", "train_rows": 9, "eval_rows": 1, "train_fingerprint": "t1",
                "eval_fingerprint": "e1", "train_class_counts": {"Positive": 9}},
    "environment": {"python": "3"}, "resume_events": [{"resumed_at": "x", "checkpoint": "latest"}],
}


@pytest.fixture()
def manifests(spark, tmp_path):
    changed = dict(MANIFEST, command_arguments={"seed": 7, "no_deduplicate": False, "extra": 1},
                   dataset={"train_fingerprint": "t1"}, status="failed", completed_at=None,
                   failed_at="2024-05-02T10:00:10+00:00", created_at="2024-05-02T10:00:00+00:00")
    for name, content in (("one", MANIFEST), ("two", changed)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "run_manifest.json").write_text(json.dumps(content, indent=2))
    return runs.read_manifests(spark, str(tmp_path / "*" / "run_manifest.json"))


def test_manifest_files_are_those_of_sparks_writer(spark, tmp_path):
    """Same folders, same lines, and nothing but the one file of a folder in it."""
    values = [None, "", "a", "a", "b/c", "x=y", 'q"%:', "é {z}", *(f"line-{i}" for i in range(40))]
    rows = [(v, f"s{i}", None if i % 3 else i, {"limit": str(i)}) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "own string, status string, n int, command_arguments map<string, string>")

    def found(path):
        lines = {}
        for folder in (f for f in path.iterdir() if f.is_dir()):
            for file in folder.glob("*.json"):
                lines[folder.name] = sorted(lines.get(folder.name, []) + file.read_text().splitlines())
        return lines

    runs.write_manifest_files(df, f"file://{tmp_path}/ours", folder="own")
    df.repartition("own").write.partitionBy("own").json(str(tmp_path / "theirs"))
    ours = found(tmp_path / "ours")
    assert ours == found(tmp_path / "theirs") and len(ours) == 46
    assert sum(len(list(f.iterdir())) for f in (tmp_path / "ours").iterdir()) == len(ours)
    read = runs.read_manifests(spark, f"{tmp_path}/ours/*").filter("run_id LIKE 'own=line%'")
    assert {(r["run_id"], r["command_arguments"]["limit"]) for r in read.collect()} == {
        (f"own=line-{i}", str(i + 8)) for i in range(40)}


def test_very_many_manifest_folders_are_listed_by_tasks(spark, tmp_path):
    """The rows of Spark's reader, without a list of files on the driver."""
    documents = {
        "one line": b'{"status": "a", "command_arguments": {"limit": 5, "x": true}}',
        "no name": b'{"run_id": null, "status": "b"}', "own name": b'{"run_id": "mine", "status": "c"}',
        "indented": json.dumps(MANIFEST, indent=2).encode(), "two": b'{"status": "d"}\n{"status": "e"}\n',
        "array": b'[{"status": "f"}, {"status": "g", "run_id": "h"}]', "no row": b"[]", "nothing": b"", "blank": b" \n",
        "mark": b'\xef\xbb\xbf{"status": "i"}', "wide": '{"status": "\u00e9"}'.encode("utf-16-le"),
        "\u00e9 \u2028\u3000\u00a0\U0001f600%41#?&=+;,@!$'()~^`|<>{}[]\"\x7f\x85": b'{"status": "\xc3\xa9"}',
        **{f"run-{i}": b'{"status": "%d"}' % i for i in range(40)},
    }
    for name, content in documents.items():
        (tmp_path / "runs" / name / "checkpoint").mkdir(parents=True)
        (tmp_path / "runs" / name / "run_manifest.json").write_bytes(content)
        (tmp_path / "runs" / name / "_SUCCESS").write_text("hidden")
        (tmp_path / "runs" / name / "checkpoint" / "state.json").write_text('{"status": "deeper"}')
    (tmp_path / "runs" / "run-0" / "run_manifest2.json").write_bytes(b'{"status": "second"}')
    (tmp_path / "runs" / "_SUCCESS").write_text("hidden")

    def both(path):
        reader = spark.read.schema(runs.MANIFEST_SCHEMA).option("mode", "FAILFAST")
        theirs = reader.json(path, multiLine=True)
        own = F.coalesce("run_id", runs.run_of_path(F.input_file_name()))
        ours = runs.read_manifests(spark, path)
        assert ours.schema == theirs.schema
        rows = [sorted(map(str, df.collect())) for df in (ours, theirs.withColumn("run_id", own))]
        assert rows[0] == rows[1]
        return len(rows[0]), "FileScan json" in ours._jdf.queryExecution().executedPlan().toString()

    pattern = f"{tmp_path}/runs/*"
    assert both(pattern) == (51, False) and both(f"file://{tmp_path}/runs/run-1*/") == (11, False)
    # What Spark takes in its own way it still reads itself.
    (tmp_path / "runs" / "run-1" / "more.json.gz").write_bytes(gzip.compress(b'{"status": "packed"}'))
    assert both(pattern) == (52, True)
    (tmp_path / "runs" / "run-1" / "more.json.gz").unlink()
    (tmp_path / "runs" / "run-2" / "run_manifest.json").write_text('{"status": "cut of')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        runs.read_manifests(spark, pattern).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        runs.read_manifests(spark, f"{tmp_path}/runs/none*")


def test_manifest_folders_are_whole_whatever_a_task_gets_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "TURN", 3)
    rows = [(f"line-{i % 45}", str(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "own string, status string")
    runs.write_manifest_files(df, str(tmp_path / "ours"), folder="own")
    found = {f.name: sorted(json.loads(x)["status"] for x in (f / "run_manifest.json").read_text().splitlines())
             for f in (tmp_path / "ours").iterdir()}
    assert found == {f"own=line-{i}": sorted(str(n) for n in range(i, 400, 45)) for i in range(45)}


def test_registry(spark, manifests):
    jobs = spark.createDataFrame(
        [("one", "failed", 7, "2024-05-01T09:00:00Z", "2024-05-01T09:10:00Z", "h", "o"),
         ("one", "completed", 0, "2024-05-01T10:00:00Z", "2024-05-01T12:31:00Z", "h", "o")],
        "run_id string, " + runs.JOB_STATUS_SCHEMA)
    rows = {r["run_id"]: r for r in runs.run_registry(manifests, jobs).collect()}
    one, two = rows["one"], rows["two"]
    assert (one["status"], one["train_rows"], one["resumes"]) == ("completed", 9, 1)
    assert (one["job_attempts"], one["job_status"], one["job_exit_code"]) == (2, "completed", 0)
    assert (two["status"], two["job_attempts"], two["job_status"]) == ("failed", 0, None)


def test_latest_manifest_counts_resumptions(spark):
    """Completed, resumed, failed: the last time in a manifest decides, whatever its zone."""
    done, failed = "2024-01-02T00:00:00Z", "2024-01-04T01:00:00+02:00"
    resumed = [("2024-01-03T23:30:00+00:00", "latest")]
    rows = [
        ("a", "completed", "2024-01-01T00:00:00Z", done, None, None),
        ("a", "training", "2024-01-01T00:00:00Z", done, None, [("2024-01-03T00:00:00Z", "latest")]),
        ("b", "completed", "2024-01-01T00:00:00Z", done, None, None),
        ("b", "training", "2024-01-01T00:00:00Z", done, None, resumed),
        ("b", "failed", "2024-01-01T00:00:00Z", done, failed, [("2024-01-03T00:00:00Z", "x")]),
        ("c", "failed", "not a time", None, None, None),
        ("c", "failed", "not a time", None, None, None),
    ]
    manifests = spark.createDataFrame(
        rows, "run_id string, status string, created_at string, completed_at string, "
        "failed_at string, resume_events array<struct<resumed_at: string, checkpoint: string>>",
    ).withColumn("dataset", F.struct(F.lit(1).alias("train_rows"), F.lit(1).alias("eval_rows")))
    jobs = spark.createDataFrame([], "run_id string, " + runs.JOB_STATUS_SCHEMA)
    registry = runs.run_registry(manifests, jobs)
    found = {r["run_id"]: (r["status"], r["ended_at"], r["resumes"]) for r in registry.collect()}
    # 01:00 at +02:00 is before 23:30 at UTC.
    assert found == {"a": ("training", None, 1), "b": ("training", None, 1), "c": ("failed", None, 0)}


def test_registry_reads_each_input_once(spark, manifests):
    jobs = spark.createDataFrame([], "run_id string, " + runs.JOB_STATUS_SCHEMA)
    plan = runs.run_registry(manifests, jobs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1
    # Entries of a run are reduced within the task before they move.
    assert plan.count("partial_max(struct(") == 2


def test_registry_takes_in_new_files_only(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "kept")

    def manifest(name, **changes):
        (tmp_path / "runs" / name).mkdir(parents=True, exist_ok=True)
        n = len(list((tmp_path / "runs" / name).iterdir()))
        (tmp_path / "runs" / name / f"{n}.json").write_text(json.dumps(dict(MANIFEST, **changes), indent=1))

    def job(name, finished, code):
        (tmp_path / "jobs").mkdir(exist_ok=True)
        status = {"status": "failed" if code else "completed", "exit_code": code, "started_at": "2024-05-01T10:00:00Z",
                  "finished_at": finished, "host": "h", "output_dir": f"outputs/{name}"}
        (tmp_path / "jobs" / f"{name}{finished[8:10]}.json").write_text(json.dumps(status))

    def take_in():
        one = registry.take_in_manifests(spark, f"{tmp_path}/runs/*/", folder=folder)
        two = registry.take_in_jobs(spark, f"{tmp_path}/jobs", folder=folder)
        found = {r["run_id"]: r for r in registry.read_registry(spark, folder).collect()}
        return [sum(p["numInputRows"] for p in q.recentProgress) for q in (one, two)], found

    for name in ("a", "b", "c"):
        manifest(name)
    job("a", "2024-05-02T10:00:00Z", 7)
    read, found = take_in()
    assert read == [3, 1] and {r["status"] for r in found.values()} == {"completed"}
    assert (found["a"]["job_attempts"], found["a"]["job_exit_code"], found["b"]["job_attempts"]) == (1, 7, 0)

    manifest("b", resume_events=[{"resumed_at": "2024-06-01T00:00:00Z"}], status="training")
    manifest("c", created_at="2024-04-01T00:00:00Z", completed_at="2024-04-01T00:00:01Z", status="failed")
    job("a", "2024-05-03T10:00:00Z", 0)
    whole = registry.replace_groups

    def lost(*args):
        def write(batch, batch_id):
            whole(*args)(batch, batch_id)
            raise RuntimeError("lost")
        return write

    # The files of the batch are written, then the job dies: nothing is counted twice.
    monkeypatch.setattr(registry, "replace_groups", lost)
    for kind in (registry.take_in_manifests, registry.take_in_jobs):
        where = f"{tmp_path}/runs/*/" if kind is registry.take_in_manifests else f"{tmp_path}/jobs"
        with pytest.raises(Exception, match="lost"):
            kind(spark, where, folder=folder)
    monkeypatch.setattr(registry, "replace_groups", whole)
    read, found = take_in()
    assert read == [2, 1]
    assert [found[r]["status"] for r in "abc"] == ["completed", "training", "completed"]
    assert (found["a"]["job_attempts"], found["a"]["job_exit_code"], found["b"]["resumes"]) == (2, 0, 1)
    assert take_in()[0] == [0, 0]


def test_a_batch_of_the_registry_is_not_one_tasks_work(spark, tmp_path):
    """Rows of a batch are written where they are, and dealt out before they are reduced."""
    folder, coalesce = str(tmp_path / "kept"), "spark.sql.adaptive.coalescePartitions.enabled"
    one = {"created_at": "2024-05-01T10:00:00Z", "dataset": {"train_rows": 1, "eval_rows": 1}}
    lines = [json.dumps({"run_id": f"r{i % 400}", "status": f"s{i // 400}", **one}) for i in range(800)]
    (tmp_path / "runs").mkdir()
    (tmp_path / "runs" / "a.json").write_text("\n".join(lines))
    (tmp_path / "jobs").mkdir()
    (tmp_path / "jobs" / "a.json").write_text("\n".join(
        json.dumps({"status": "failed", "exit_code": i, "output_dir": f"outputs/r{i}"}) for i in range(400)))
    spark.conf.set(coalesce, "false")
    try:
        registry.take_in_manifests(spark, f"{tmp_path}/runs", folder=folder, one_per_file=False)
        registry.take_in_jobs(spark, f"{tmp_path}/jobs", folder=folder, one_per_file=False)
        found = registry.read_registry(spark, folder)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        spark.conf.set(coalesce, "true")
    for kind in ("manifests", "jobs"):
        assert len(list((tmp_path / "kept" / kind / "batch_id=0").glob("*.parquet"))) == 8
    assert len(rows) == 400 and {(r["status"], r["job_attempts"]) for r in rows} == {("s1", 1)}
    # Below an exchange nothing is reduced, so nothing is sorted for it either.
    below = plan.split("Exchange hashpartitioning(run_id")[1:]
    assert len(below) == 2 and not any("partial_max" in p.split("FileScan")[0] for p in below)


def test_entries_are_kept_in_compressed_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "FILE_ENTRIES", 10)
    jobs = spark.range(25).select(F.lit("failed").alias("status"), F.concat(F.lit("outputs/"), "id").alias("output_dir"))
    for _ in range(2):
        runs.write_entries(jobs.coalesce(1), str(tmp_path / "jobs"), mode="append")
    found = runs.read_job_statuses(spark, str(tmp_path / "jobs"), one_per_file=False)
    assert sorted(r["output_dir"] for r in found.collect()) == sorted(f"outputs/{i}" for i in range(25) for _ in "ab")
    assert len(found.inputFiles()) == 6 and all(f.endswith(".json.gz") for f in found.inputFiles())

    day = datetime.datetime(1994, 5, 1)
    spark.createDataFrame(
        [(1, 5, "F", 100.0, day, "1-URGENT"), (2, None, "P", 50.5, day, None), (3, 6, "O", 7.0, None, "2-HIGH")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        [(1, 3, "R", day, 2.0), (1, None, "N", day, 3.0), (2, 4, None, None, 1.0)],
        "l_orderkey long, l_suppkey long, l_returnflag string, l_shipdate timestamp_ntz, l_quantity double",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("run_registry", "run_registry_in_parts"):
        registered = QUERIES[name](spark, str(tmp_path))
        rows = sorted((r["run_id"], r["status"], r["train_rows"], r["job_attempts"]) for r in registered.collect())
        assert rows[0] == ("run-1", "completed", 100, 2) and rows[2] == ("run-3", "training", 7, 0)
        if name == "run_registry":
            assert rows[1] == ("run-2", "failed", 50, 1)
            assert all(f.endswith(".json.gz") for f in registered.inputFiles())


def test_a_batch_that_is_appended_again_replaces_itself(spark, tmp_path):
    def records(*ids):
        rows = [(i, "Positive", None, "r", None, 0.5, False, "x") for i in ids]
        return spark.createDataFrame(rows, predictions.RECORD_SCHEMA)

    path = str(tmp_path / "scored")
    for ids, batch in (((1, 2), "a"), ((3,), "b"), ((1, 2), "a"), ((4,), "b")):
        predictions.append_predictions(records(*ids), path, "run", batch)
    predictions.append_predictions(records(1), path, "other", "a")
    stored = predictions.read_runs(spark, path)
    assert sorted((r["run_id"], r["batch"], r["index"]) for r in stored.collect()) == [
        ("other", "a", 1), ("run", "a", 1), ("run", "a", 2), ("run", "b", 4)]


def test_malformed_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"row_id": "1", "Content": "text", "Summary": "s", "Sentiment": "Positive"}\n'
        '{"row_id": "2", "Content": "cut\n[1]\n\n{"row_id": "3", "Content": null}\n')
    good, bad = articles.read_articles_with_errors(spark, str(tmp_path / "a.json"), format="json")
    assert [tuple(r) for r in good.orderBy("row_id").collect()] == [
        ("1", "text", "s", "Positive"), ("3", None, None, None)]
    assert sorted(r["line"] for r in bad.collect()) == ["[1]", '{"row_id": "2", "Content": "cut']
    assert {r["file_path"].rsplit("/", 1)[1] for r in bad.collect()} == {"a.json"}
    (tmp_path / "a.csv").write_text("row_id,Sentiment,Summary,Content\n1,Positive,s,text\n2,Positive\n3,a,b,c,d\n")
    good, bad = articles.read_articles_with_errors(spark, str(tmp_path / "a.csv"), format="csv")
    assert [tuple(r) for r in good.collect()] == [("1", "text", "s", "Positive")]
    assert sorted(r["line"] for r in bad.collect()) == ["2,Positive", "3,a,b,c,d"]
    assert good.select("row_id").count() == 1


def test_a_record_is_judged_by_all_its_fields(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"index": 1, "raw_response": "x"}\n{"index": 2, "rouge_l_f1": "none"}\n{"index": "z"}\n')
    good, bad = predictions.read_predictions_with_errors(spark, str(tmp_path / "p.json"))
    assert [r["index"] for r in good.select("index").collect()] == [1]
    assert bad.select("file_path").count() == 2 and good.count() == 1


def test_files_near_the_advisory_size(spark, tmp_path):
    words = F.expr("concat_ws(' ', transform(sequence(1, 200), i -> hash(id, i)))")
    df = spark.range(4000).withColumn("text", words).withColumn("split", F.when(F.col("id") < 3900, "train").otherwise("test"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        datasets.write_sft_dataset(df.repartition(16), str(tmp_path / "even"), rebalance=True)
    finally:
        if before is None:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        else:
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    train, test = ([p.stat().st_size for p in (tmp_path / "even" / f"split={s}").glob("*.parquet")] for s in ("train", "test"))
    assert len(test) == 1 and 3 <= len(train) <= 8
    assert max(train) < 3 * min(train)


def test_bucketed_tables_join_where_they_lie(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("left", "right"):
            df = spark.range(2000).select(F.col("id").alias("row_id"), F.lit(name).alias(name))
            datasets.save_sft_table(df, f"sft_{name}", buckets=4, path=str(tmp_path / name))
            assert len(list((tmp_path / name).glob("*.parquet"))) == 4
        joined = spark.table("sft_left").join(spark.table("sft_right"), "row_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("left", "right"):
            spark.sql(f"DROP TABLE IF EXISTS sft_{name}")


def test_a_malformed_manifest_is_an_error(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"status": "completed", "dataset": 7, ')
    with pytest.raises(Exception, match="(?i)malformed"):
        runs.read_manifests(spark, str(tmp_path / "m.json")).collect()


def test_config_diff_ignores_what_was_not_saved(spark, manifests):
    pairs = spark.createDataFrame(
        [("one", "two"), ("two", "one")], "saved_run string, current_run string")
    keys = ("seed", "limit", "no_deduplicate", "extra", "test_size")
    rows = {(r["saved_run"], r["key"]): (r["saved"], r["current"])
            for r in governance.config_diff(pairs, manifests, keys=keys).collect()}
    assert rows == {
        ("one", "seed"): ("42", "7"), ("one", "limit"): ("5000", None),
        ("two", "seed"): ("7", "42"), ("two", "extra"): ("1", None)}


def test_fingerprints_absent_counts_as_changed(spark, manifests):
    flat = manifests.select("run_id", "dataset.train_fingerprint", "dataset.eval_fingerprint")
    saved = flat.filter("run_id = 'two'").withColumn("run_id", F.lit("one"))
    drift = governance.fingerprint_drift(flat.filter("run_id = 'one'"), saved).collect()
    assert [(r["fingerprint"], r["saved"], r["current"]) for r in drift] == [
        ("eval_fingerprint", None, "e1")]
    # A first run has no saved one to differ from.
    first = governance.fingerprint_drift(flat.filter("run_id = 'one'"), saved.limit(0))
    assert first.count() == 0


def test_status_summary(spark, manifests):
    rows = {r["status"]: r for r in governance.run_status_summary(manifests).collect()}
    assert rows["completed"]["mean_seconds"] == 9000 and rows["completed"]["evaluable"]
    assert rows["failed"]["max_seconds"] == 10 and not rows["failed"]["evaluable"]


def test_hot_saved_run_is_split(spark):
    """A third of all pairs resume from one run: the join splits that key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        table = spark.range(6000).select(
            F.concat(F.lit("r"), "id").alias("run_id"),
            F.create_map(F.lit("seed"), (F.col("id") % 2).cast("string")).alias("command_arguments"),
        )
        pairs = spark.range(6000).select(
            F.when(F.col("id") % 3 == 0, "r1").otherwise(F.concat(F.lit("r"), "id")).alias("saved_run"),
            F.concat(F.lit("r"), "id").alias("current_run"),
        ).repartition(20)
        diff = governance.config_diff(pairs, table, keys=("seed",))
        assert diff.count() == 1000
        diff.collect()
        assert "skew=true" in diff._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_drift(spark):
    left = spark.createDataFrame([("Positive",)] * 8 + [("Negative",)] * 2, "l string")
    same = governance.class_drift(left, left, expected_label="l", observed_label="l").collect()[0]
    assert same["total_variation"] == 0 and same["stability_index"] == 0
    right = spark.createDataFrame([("Positive",)] * 5 + [("Negative",)] * 5, "l string")
    row = governance.class_drift(left, right, expected_label="l", observed_label="l").collect()[0]
    assert row["total_variation"] == pytest.approx(0.3) and row["unlabelled_share"] == 0


@pytest.mark.parametrize("observed", [[(None,)] * 4, []])
def test_drift_without_labels(spark, observed):
    left = spark.createDataFrame([("Positive",)] * 8, "l string")
    right = spark.createDataFrame(observed, "l string")
    row = governance.class_drift(left, right, expected_label="l", observed_label="l").collect()[0]
    assert (row["expected_rows"], row["observed_rows"]) == (8, 0)
    assert row["total_variation"] is None and row["stability_index"] is None
    assert row["unlabelled_share"] == (1.0 if observed else None)


class Echo:
    made = 0

    def __call__(self, prompts):
        return [p[-1]["content"][-3:] for p in prompts]


class Lazy:
    def __call__(self, prompts):
        return []


def test_predictor_plugin(spark):
    df = spark.range(300).select(
        F.col("id").alias("row_id"), chat.build_prompt(F.col("id").cast("string")).alias("prompt")
    ).repartition(4)
    scored = plugins.score_prompts(df, predictor_factory=Echo, batch_size=7)
    assert scored.count() == 300 and {r["raw_response"] for r in scored.collect()} == {"NT>"}
    with pytest.raises(Exception, match="every prompt"):
        plugins.score_prompts(df, predictor_factory=Lazy).count()


class Recording:
    """Answers with the prompt and the lengths that the predictor saw together."""

    def __call__(self, prompts):
        sizes = [sum(len(m["content"]) for m in p) for p in prompts]
        assert sizes == sorted(sizes)
        return [f"{p[-1]['content']}|{len(prompts)}" for p in prompts]


def test_prompts_of_like_length_go_together(spark):
    df = spark.range(100).select(
        F.col("id").alias("row_id"),
        F.array(F.struct(F.lit("user").alias("role"), F.when(F.col("id") != 5, F.repeat(F.lit("x"), F.pmod(F.col("id") * 37, F.lit(101)).cast("int"))).alias("content"))).alias("prompt"),
    )
    for parts in (1, 5):
        scored = plugins.score_prompts(df.repartition(parts), predictor_factory=Recording, batch_size=8)
        rows = {r["row_id"]: r["raw_response"] for r in scored.collect()}
        assert len(rows) == 100 and rows[5] is None
        assert all(v.split("|")[0] == "x" * (i * 37 % 101) for i, v in rows.items() if i != 5)


LOG = "event_time timestamp, key long, user_id long, latency_ms double, predicted string"


def log_files(spark, tmp_path, batches):
    folder = tmp_path / "log"
    for i, batch in enumerate(batches):
        rows = spark.createDataFrame(batch, "t string, " + LOG.split(", ", 1)[1])
        rows = rows.withColumn("event_time", F.to_timestamp("t")).select(
            "event_time", "key", "user_id", "latency_ms", "predicted")
        rows.coalesce(1).write.mode("append").parquet(str(folder))
        newest = max(folder.glob("part-*"), key=lambda p: p.stat().st_mtime)
        os.utime(newest, (time.time() - 100 + i, time.time() - 100 + i))
    return monitors.read_log_stream(spark, str(folder), LOG, files_per_trigger=1)


def test_late_rows_are_not_counted(spark, tmp_path):
    stream = log_files(spark, tmp_path, [
        [("2024-01-01 10:00:00", 1, 1, 5.0, None), ("2024-01-03 12:00:00", 2, 1, 5.0, "Neutral")],
        [("2024-01-03 13:00:00", 4, 1, 5.0, None)],
        # Behind the watermark: its window was closed before this file arrived.
        [("2024-01-01 11:00:00", 3, 1, 5.0, None)],
        [("2024-01-06 00:00:00", 5, 1, 5.0, "Neutral")],
    ])
    result = appended(monitors.parse_failures(stream), tmp_path).orderBy("window_start")
    assert [(r["rows"], r["failures"]) for r in result.collect()] == [(1, 1), (2, 1)]


def appended(stream, tmp_path):
    paths = {k: str(tmp_path / "out" / k) for k in ("table", "progress")}
    return monitors.append_to_table(stream, **paths)


def test_a_stopped_stream_goes_on(spark, tmp_path):
    """Two runs over the same paths: no row is lost or counted twice, open windows stay."""
    first = [("2024-01-01 10:00:00", 1, 1, 5.0, None), ("2024-01-01 11:00:00", 2, 1, 5.0, "Neutral")]
    stream = log_files(spark, tmp_path, [first])
    assert appended(monitors.parse_failures(stream), tmp_path).count() == 0
    later = [("2024-01-01 12:00:00", 3, 1, 5.0, None), ("2024-01-03 00:00:00", 4, 1, 5.0, None)]
    stream = log_files(spark, tmp_path, [later])
    rows = appended(monitors.parse_failures(stream), tmp_path).collect()
    assert [(r["rows"], r["failures"]) for r in rows] == [(3, 2)]


def test_a_stopped_stream_remembers_keys(spark, tmp_path):
    stream = log_files(spark, tmp_path, [[("2024-01-01 10:00:00", 1, 1, 5.0, "Neutral")]])
    assert appended(monitors.drop_replays(stream), tmp_path).count() == 1
    again = [("2024-01-01 10:00:00", 1, 1, 5.0, "Neutral"), ("2024-01-01 10:10:00", 2, 1, 5.0, None)]
    stream = log_files(spark, tmp_path, [again])
    once = appended(monitors.drop_replays(stream), tmp_path)
    assert sorted(r["key"] for r in once.collect()) == [1, 2]


def paths(tmp_path, name):
    return {k: str(tmp_path / name / k) for k in ("table", "progress")}


def test_an_upserted_table_has_open_windows(spark, tmp_path):
    into = paths(tmp_path, "all")
    stream = log_files(spark, tmp_path, [[("2024-01-01 10:00:00", 1, 1, 5.0, None)]])
    assert monitors.upsert_table(monitors.parse_failures(stream), **into).count() == 1
    stream = log_files(spark, tmp_path, [[("2024-01-01 11:00:00", 2, 1, 5.0, None),
                                          ("2024-01-02 11:00:00", 3, 1, 5.0, None)]])
    rows = monitors.upsert_table(monitors.parse_failures(stream), **into).orderBy("window_start").collect()
    assert [(r["rows"], r["failures"]) for r in rows] == [(2, 2), (1, 1)]


def test_groups_of_a_window_are_replaced_by_themselves(spark, tmp_path):
    into = paths(tmp_path, "mix") | {"keys": ("window_start", "predicted")}
    stream = log_files(spark, tmp_path, [
        [("2024-01-01 10:00:00", 1, 1, 5.0, None), ("2024-01-01 10:00:00", 2, 1, 5.0, "Neutral")],
        [("2024-01-01 11:00:00", 3, 1, 5.0, "Neutral")],
    ])
    rows = monitors.upsert_table(monitors.class_mix(stream), **into).collect()
    assert sorted((r["window_start"].day, r["predicted"], r["rows"]) for r in rows) == [
        (1, "Neutral", 2), (1, "UNPARSED", 1), (31, "Neutral", 2), (31, "UNPARSED", 1)]


def days(n):
    return [[(f"2024-{1 + d // 28:02d}-{1 + d % 28:02d} {h:02d}:00:00", 10 * d + h, 1, float(h), None if h % 2 else "Neutral")
             for h in range(10)] for d in range(n)]


def test_state_does_not_grow_with_windows(spark, tmp_path):
    stream = monitors.parse_failures(log_files(spark, tmp_path, days(50)))
    into = paths(tmp_path, "many")
    query = monitors.run_available(
        stream, mode="update", progress=into["progress"],
        each=monitors.replace_groups(into["table"], ("window_start",)))
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(held) >= 50 and max(held) <= 3
    assert monitors.read_table(stream, into["table"]).count() == 50


def test_a_crash_between_two_writes_loses_nothing(spark, tmp_path, monkeypatch):
    """The batch's files are there, its commit is not: it runs again over the same groups."""
    into = paths(tmp_path, "crash")
    stream = log_files(spark, tmp_path, [[("2024-01-01 10:00:00", 1, 1, 5.0, None)]])
    assert monitors.upsert_table(monitors.parse_failures(stream), **into).count() == 1
    whole = monitors.replace_groups

    def half(table, keys):
        def write(batch, batch_id):
            whole(table, keys)(batch.filter("rows < 3"), batch_id)
            raise RuntimeError("lost")
        return write

    second = [("2024-01-01 11:00:00", 2, 1, 5.0, None), *(("2024-01-02 11:00:00", k, 1, 5.0, None) for k in (3, 4, 5))]
    stream = log_files(spark, tmp_path, [second])
    monkeypatch.setattr(monitors, "replace_groups", half)
    with pytest.raises(Exception, match="lost"):
        monitors.upsert_table(monitors.parse_failures(stream), **into)
    rows = monitors.read_table(monitors.parse_failures(stream), into["table"]).collect()
    assert [r["rows"] for r in rows] == [2]
    monkeypatch.setattr(monitors, "replace_groups", whole)
    rows = monitors.upsert_table(monitors.parse_failures(stream), **into).collect()
    assert sorted(r["rows"] for r in rows) == [2, 3]


def test_bursts_leave_the_state_when_they_are_closed(spark, tmp_path):
    into = paths(tmp_path, "bursts")
    stream = log_files(spark, tmp_path, [
        [("2024-01-01 10:00:00", 1, 1, 5.0, None), ("2024-01-01 12:00:00", 2, 1, 5.0, None)],
        [("2024-01-02 10:00:00", 3, 2, 5.0, None)],
    ])
    rows = monitors.bursts_so_far(monitors.failure_bursts(stream), **into).collect()
    assert sorted((r["user_id"], r["failures"]) for r in rows) == [(1, 2), (2, 1)]
    assert [r["user_id"] for r in monitors.open_bursts(spark, into["progress"]).collect()] == [2]
    stream = log_files(spark, tmp_path, [[("2024-01-02 11:00:00", 4, 2, 5.0, None)], [("2024-01-09 00:00:00", 5, 3, 5.0, None)]])
    rows = monitors.bursts_so_far(monitors.failure_bursts(stream), **into).collect()
    assert sorted((r["user_id"], r["failures"]) for r in rows) == [(1, 2), (2, 2), (3, 1)]
    assert monitors.open_bursts(spark, into["progress"]).count() == 1
    assert spark.read.parquet(into["table"]).count() == 2


def test_late_rows_are_counted_beside_the_result(spark, tmp_path):
    windows, arrivals = paths(tmp_path, "windows"), paths(tmp_path, "arrivals")
    for load in (
        [("2024-01-01 10:00:00", 1, 1, 5.0, None), ("2024-01-03 12:00:00", 2, 1, 5.0, "Neutral")],
        [("2024-01-01 11:00:00", 3, 1, 5.0, None), ("2024-01-02 11:00:00", 4, 1, 5.0, None),
         ("2024-01-03 00:30:00", 5, 1, 5.0, None)],
    ):
        log = log_files(spark, tmp_path, [load])
        counted = monitors.upsert_table(monitors.parse_failures(log), **windows)
        arrived = monitors.count_arrivals(log, **arrivals)
    found = monitors.late_rows(counted, arrived).orderBy("window_start").collect()
    assert [(r["rows"], r["failures"], r["late_rows"]) for r in found] == [(1, 1, 1), (0, None, 1), (2, 1, 0)]
    again = monitors.count_arrivals(log, **arrivals)
    assert monitors.late_rows(counted, again).agg(F.sum("late_rows")).first()[0] == 2


def test_sketches_of_days_make_weeks(spark, tmp_path):
    log = log_files(spark, tmp_path, days(14))
    sketches = monitors.upsert_table(monitors.latency_sketches(log), **paths(tmp_path, "sketches"))
    weeks = monitors.rolled_up(sketches, "week", {"p50": 0.5, "p100": 1.0}).orderBy("window_start").collect()
    assert [(w["windows"], w["rows"], w["max_ms"], w["p50"], w["p100"]) for w in weeks] == [(7, 70, 9.0, 4.0, 9.0)] * 2


def test_replays_within_the_watermark_are_dropped(spark, tmp_path):
    stream = log_files(spark, tmp_path, [
        [("2024-01-01 10:00:00", 1, 1, 5.0, "Neutral"), ("2024-01-01 10:00:01", 1, 1, 5.0, "Neutral")],
        [("2024-01-01 10:10:00", 1, 1, 5.0, "Neutral"), ("2024-01-01 10:20:00", 2, 1, 5.0, None)],
    ])
    once = appended(monitors.drop_replays(stream), tmp_path)
    assert sorted(r["key"] for r in once.collect()) == [1, 2]


def test_latency_percentile(spark, tmp_path):
    rows = [(f"2024-01-01 10:00:{i:02d}", i, 1, float(i), "Neutral") for i in range(60)]
    stream = log_files(spark, tmp_path, [rows, [("2024-01-09 00:00:00", 99, 1, 0.0, None)]])
    row = appended(monitors.latency(stream), tmp_path).collect()[0]
    assert (row["rows"], row["max_ms"]) == (60, 59.0) and 55 <= row["p95_ms"] <= 58


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.new_path(spark, "x").startswith(named)
    table = session.materialize(spark.range(5), "ids")
    assert table.count() == 5 and all(named in f for f in table.inputFiles())


def test_clean_up_removes_what_the_application_wrote(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    os.makedirs(f"{shared}/other", exist_ok=True)
    session.materialize(spark.range(5), "ids").count()
    scratch = session.scratch_folder(spark)
    assert os.listdir(scratch)
    session.clean_up(spark)
    assert not os.path.exists(scratch) and os.path.exists(f"{shared}/other")
