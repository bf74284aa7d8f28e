"""Readers, control tables, sinks and streams."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from biblioweave.operators import vectors
from biblioweave.sources import control, readers, sinks
from biblioweave.streaming import incremental


def test_bronze_of_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("x,y\n1, é \n,2\n".encode("utf-8-sig"))
    (tmp_path / "b.CSV").write_bytes("y,z\n汉,3\n".encode("gb18030"))
    (tmp_path / "~$c.csv").write_text("no")
    rows = readers.cells(spark, str(tmp_path), "g")
    out = readers.bronze(rows, "now")
    assert out.columns == [*readers.META, "x", "y", "z"]
    got = {(r["row_index"], r["x"], r["y"], r["z"]) for r in out.collect()}
    assert got == {(1, "1", "é", None), (2, None, "2", None), (1, None, "汉", "3")}
    assert readers.discover(spark, str(tmp_path)).count() == 2


def test_large_csv_keeps_row_numbers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n" + "\n".join(f"v{i}" for i in range(500)) + "\n")
    out = readers.bronze_csv(spark, str(tmp_path / "a.csv"), "g", "now")
    assert {(r["row_index"], r["x"]) for r in out.collect()} == {(i + 1, f"v{i}") for i in range(500)}


def test_row_formats(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"source_file":"f","sheet":"s","row_index":3,"row":{"a":"1"}}\n{"row":{"a":"2"}}\n[1]\n')
    got = sorted((r["sheet"], r["row_index"] is not None, r["cells"]["a"]) for r in readers.row_json(spark, str(tmp_path / "r.jsonl")).collect())
    assert got == [("s", True, "1"), ("unknown", True, "2")]
    (tmp_path / "w.json").write_text(json.dumps({"source_file": "f", "sheets": {"s": [{"a": "1"}, {"a": "2"}]}}))
    assert sorted((r["row_index"], r["cells"]["a"]) for r in readers.workbook_json(spark, str(tmp_path / "w.json")).collect()) == [(1, "1"), (2, "2")]
    for k, data in enumerate([[{"scholar_name": "A"}], {"matches": [{"scholar_name": "A"}]}, {"matches_by_scholar": {"A": [{"doi": "1"}]}}]):
        (tmp_path / f"m{k}.json").write_text(json.dumps(data))
        assert [r["m"]["scholar_name"] for r in readers.matches_json(spark, str(tmp_path / f"m{k}.json")).collect()] == ["A"]
    (tmp_path / "q.json").write_text(json.dumps([{"rank": "=1", "university": "U"}, {"rank": "2", "company": "C", "website": "w"}, {"rank": "3"}]))
    assert sorted((r["name"], r["domain"]) for r in readers.ranking_json(spark, str(tmp_path / "q.json")).collect()) == [("C", "w"), ("U", None)]
    with pytest.raises(ValueError):
        readers.rows_of(spark)
    with sqlite3.connect(tmp_path / "c.db") as db:
        db.execute("create table records (id text, email text)")
        db.executemany("insert into records values (?, ?)", [("1", "a"), ("2", "b")])
    got = readers.contacts_sqlite(spark, str(tmp_path / "c.db"), wanted=["email", "none"])
    assert sorted(r["email"] for r in got.collect()) == ["a", "b"]


def test_control_tables(spark):
    old = spark.createDataFrame([("a", "1", 1, "t"), ("b", "1", 1, "t"), ("c", "1", 1, "t")], "path string, sha1 string, size int, modified string")
    new = spark.createDataFrame([("a", "1", 1, "t"), ("b", "2", 1, "t"), ("d", "1", 1, "t")], "path string, sha1 string, size int, modified string")
    diff = control.manifest_diff(new, old)
    assert {r["path"]: r["state"] for r in diff.collect()} == {"a": "unchanged", "b": "changed", "c": "deleted", "d": "new"}
    jobs = spark.createDataFrame([("d", "1", "bronze")], "path string, sha1 string, stage string")
    assert sorted((r["path"], r["stage"]) for r in control.enqueue(diff, jobs, ["bronze", "silver"]).collect()) == [("b", "bronze"), ("b", "silver"), ("d", "silver")]
    states = spark.createDataFrame([(1, "failed", 0, "s", None, "2"), (2, "failed", 3, "s", None, "2"), (3, "done", 0, "s", None, "2")], "job_id int, status string, retry_count int, stage string, ended_at string, created_at string")
    assert sorted((r["job_id"], r["status"]) for r in control.retry(states, 3).collect()) == [(1, "pending"), (2, "failed"), (3, "done")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", ["a", "b"], True, None), ("2", [], None, 1.5)], "id string, l array<string>, b boolean, v double")
    sinks.to_jsonl(df, str(tmp_path / "j"))
    assert '"v":null' in "".join(p.read_text() for p in (tmp_path / "j").glob("part*"))
    sinks.to_bulk(df, str(tmp_path / "b"), "id", "idx")
    assert sum(len(p.read_text().splitlines()) for p in (tmp_path / "b").glob("part*")) == 4
    sinks.to_excel_file(df, str(tmp_path / "e.csv"))
    assert (tmp_path / "e.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    with pytest.raises(ValueError):
        sinks.to_excel_file(df, str(tmp_path / "e.csv"), most=1)

    def send(body):
        ids = [json.loads(x)["index"]["_id"] for x in body.splitlines()[::2]]
        return [{"status": 400, "error": "bad"} if i == "2" else {"status": 201} for i in ids]

    assert [tuple(r) for r in sinks.load_bulk(df, "id", "idx", send).collect()] == [("2", 400, "bad")]


def test_stream_upsert_and_resume(spark, tmp_path):
    src, target, at = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "k string, o int, a string, s double"
    table = incremental.Upserted(spark, target, ["k"], ["o"], {"a": "best:x>y", "s": "max"}, buckets=3)
    for batch in ([("1", 1, "y", 1.0), ("2", 1, None, None)], [("1", 0, "x", 0.5)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
        incremental.run_available(incremental.new_files(spark, spark.read.parquet(src).schema, src), at, table.add)
    assert sorted(map(tuple, table.current().collect())) == [("1", 0, "x", 1.0), ("2", 1, None, None)]
    done = incremental.append_missing(str(tmp_path / "vec"), "k", lambda df: vectors.embed(df.withColumn("t", F.col("a")), "k", "t", vectors.hash_embedder(4), 4))
    done(spark.createDataFrame([("1", "x")], "k string, a string"), 0)
    done(spark.createDataFrame([("1", "x"), ("2", "y")], "k string, a string"), 1)
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "vec")).collect()) == ["1", "2"]


def test_upserts_in_batches_equal_one(spark, tmp_path):
    schema = "k string, o int, v string, l array<string>"
    rows = [("a", 1, None, ["p"]), ("a", 5, "x", ["q"]), ("a", 3, "y", ["r", "p"]), ("b", 9, None, None), ("c", 2, "z", [])]
    rules = {"v": "first", "l": "union"}
    whole = incremental.Upserted(spark, str(tmp_path / "one"), ["k"], ["o"], rules)
    whole.add(spark.createDataFrame(rows, schema), 0, "s")
    parts = incremental.Upserted(spark, str(tmp_path / "two"), ["k"], ["o"], rules, buckets=2)
    for n, (lo, hi) in enumerate([(0, 2), (2, 4), (4, 5)]):
        for _ in range(2):  # a batch that runs again is written once
            parts.add(spark.createDataFrame(rows[lo:hi], schema), n, "s")
    want = [("a", 1, "y", ["p", "r", "q"]), ("b", 9, None, []), ("c", 2, "z", [])]
    assert sorted(map(tuple, whole.current().fillna("").collect()))[0] == want[0]
    got = sorted((r["k"], r["o"], r["v"], r["l"] or []) for r in parts.current().collect())
    assert got == want and got == sorted((r["k"], r["o"], r["v"], r["l"] or []) for r in whole.current().collect())
    # another stream's batches have numbers of their own
    parts.add(spark.createDataFrame([("d", 1, "w", None)], schema), 0, "other")
    assert parts.current().count() == 4


def test_line_numbers_of_json(spark, tmp_path):
    from biblioweave.sources import readers

    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join('{"source_file": "%s", "row": {"x": "%d"}}' % (name, k) if k != 1 else "junk" for k in range(4)))
    got = sorted((r["source_file"], r["row_index"], r["cells"]["x"]) for r in readers.row_json(spark, str(tmp_path)).collect())
    assert got == [(f, k + 1, str(k)) for f in "ab" for k in (0, 2, 3)]


def test_load_bulk_repeats_and_waits(spark):
    from biblioweave.sources import sinks

    def send(body):
        docs = body.splitlines()[1::2]
        return [{"status": 503 if '"busy"' in x else 201} for x in docs]

    df = spark.createDataFrame([("1", "ok"), ("1", "ok"), ("2", "busy")], "id string, v string")
    assert [tuple(r)[:2] for r in sinks.load_bulk(df, "id", "idx", send, tries=2, wait=0.01).collect()] == [("2", 503)]


def test_windowed_counts(spark, tmp_path):
    import datetime as dt

    src = str(tmp_path / "in")
    base = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(base + dt.timedelta(minutes=10 * k), "ab"[k % 2]) for k in range(12)], "at timestamp, kind string").write.parquet(src)
    stream = incremental.new_files(spark, spark.read.parquet(src).schema, src)
    q = incremental.windowed_counts(stream, "at", ["kind"]).writeStream.format("memory").queryName("wc").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["window_start"].hour, r["kind"], r["n"]) for r in spark.table("wc").collect()) == [(0, "a", 3), (0, "b", 3), (1, "a", 3), (1, "b", 3)]


def test_the_package_goes_to_the_workers(spark):
    from biblioweave.session import ship

    ship(spark)
    ship(spark)
    assert any(str(f).endswith("biblioweave.zip") for f in spark.sparkContext.listFiles)
