import pytest
from pyspark.sql import functions as F

from inkframe.sources import files
from inkframe.sources.store import Store, missing

ROWS = "artifact_type string, artifact_id string, revision bigint, schema_version int, payload string, note string"


def test_store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    assert s.artifacts().count() == 0 and s.next_revision("t", "a") == 1
    rows = spark.createDataFrame([("t", "a", 1, 1, "x", "n"), ("t", "a", 1, 1, "x", "m"), ("t", "a", 3, 1, None, "n")], ROWS)
    assert s.put(rows) == 2 and s.put(rows) == 0
    assert s.next_revision("t", "a") == 2 and s.next_revision("t", "a", 3) == 4
    with pytest.raises(ValueError):
        s.put(spark.createDataFrame([("t", "a", 1, 1, "other", "n")], ROWS))
    assert s.artifacts().count() == 2 and s.get(s.artifacts().where("revision = 1")).count() == 1


def test_pointer(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    assert s.compare_and_set("p", "CURRENT", None, "a", 1) == 1
    assert s.compare_and_set("p", "CURRENT", None, "a", 1) == 1
    assert s.compare_and_set("p", "CURRENT", 1, "a", 2) == 2
    with pytest.raises(ValueError):
        s.compare_and_set("p", "CURRENT", 1, "b", 1)
    with pytest.raises(ValueError):
        s.compare_and_set("p", "OTHER", 2, "b", 1)
    assert s.current().first().target_revision == 2


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("x\r\ny".encode("utf-16"))
    (tmp_path / "b.txt").write_bytes(b"\xff\xff")
    got = {r.path.rsplit("/", 1)[1]: (r.encoding, r.text) for r in files.read_texts(spark, str(tmp_path / "*.txt")).collect()}
    assert got == {"a.txt": ("UTF-16LE", "x\ny"), "b.txt": ("UTF-8", None)}
    df = spark.createDataFrame([(1, "é", None)], "a int, b string, c string")
    files.write_json(df, str(tmp_path / "j"))
    assert files.read_json(spark, str(tmp_path / "j" / "*.json"), "a int, b string, c string").collect() == df.collect()
    clips = spark.createDataFrame([("s", 2, "b'c"), ("s", 1, "a")], "s string, o int, f string")
    assert files.concat_plan(clips, "s", "o", "f").first().text == "file 'a'\nfile 'b'''c'"


def test_missing(spark):
    plan, done = spark.range(5), spark.range(3).union(spark.range(1))
    assert sorted(r.id for r in missing(plan, done, ["id"]).collect()) == [3, 4]
    assert missing(plan, done.where(F.lit(False)), ["id"]).count() == 5
