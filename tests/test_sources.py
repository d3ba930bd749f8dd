"""CSV, tables, views and feature tables."""

from __future__ import annotations

import csv
import random
import uuid

import pytest
from pyspark.sql import functions as F

from featloom.plans.passengers import RAW_SCHEMA
from featloom.session import scratch_scope
from featloom.sources.csv import NULL_TOKENS, read_csv_typed
from featloom.sources.feature_tables import (
    create_feature_table,
    drop_feature_table,
    feature_table,
    merge,
)
from featloom.sources.tables import as_view, load, save_overwrite, sql


def write(tmp_path, text):
    path = tmp_path / f"{uuid.uuid4().hex}.csv"
    path.write_text(text)
    return str(path)


HEADER = "PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked\n"


def test_csv_quotes_types_and_missing_fields(spark, tmp_path):
    path = write(
        tmp_path,
        HEADER
        + '5,1,3,"Fox, Dr. ""Jo, B"" Al",male,40,0,0,W.C. 6,2.5,"",S\n'
        + "6,0,1,NA,,NaN,1,0,113,,n/a,null\n",
    )
    found = read_csv_typed(spark, path, RAW_SCHEMA, required=["Survived"])
    assert found.schema == RAW_SCHEMA
    first, second = found.orderBy("PassengerId").collect()
    assert first.Name == 'Fox, Dr. "Jo, B" Al'
    assert (first.Survived, first.Age, first.Fare, first.Cabin) == (1, 40.0, 2.5, None)
    assert [second[c] for c in ("Name", "Sex", "Age", "Fare", "Cabin", "Embarked")] == [None] * 6
    assert (second.PassengerId, second.SibSp) == ("6", "1")


def test_every_null_token(spark, tmp_path):
    path = write(tmp_path, "a,b\n" + "".join(f"{t},x\n" for t in NULL_TOKENS) + "NAN,x\n,x\n")
    found = [r.a for r in read_csv_typed(spark, path, "a string, b string").collect()]
    assert found == [None] * len(NULL_TOKENS) + ["NAN", None]


@pytest.mark.parametrize("mode", ["true", "false"])
def test_csv_errors(spark, tmp_path, mode):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", mode)
    try:
        wrong = read_csv_typed(spark, write(tmp_path, "a\nx1\n"), "a int")
        with pytest.raises(Exception, match="not int"):
            wrong.collect()
        missing = read_csv_typed(
            spark, write(tmp_path, "a,b\nNA,1\n"), "a int, b int", required=["a"]
        )
        with pytest.raises(Exception, match="value required"):
            missing.collect()
        header = read_csv_typed(spark, write(tmp_path, "a,c\n1,2\n"), "a int, b int")
        with pytest.raises(Exception, match="(?i)header"):
            header.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_tables_and_views(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    save_overwrite(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    table = save_overwrite(spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string"), name)
    assert sorted(map(tuple, table.collect())) == [(2, "b"), (3, "c")]
    view = as_view(load(spark, name).filter("k = 3"), "third")
    assert view.collect() == sql(spark, "SELECT * FROM third WHERE k = :k", {"k": 3}).collect()
    table.write.parquet(str(tmp_path / "files"))
    assert load(spark, str(tmp_path / "files")).count() == 2


def test_broken_records(spark, tmp_path):
    text = 'a,b\n"x\ny",1\n"z",2\n'
    whole = read_csv_typed(spark, write(tmp_path, text), "a string, b int", multiline=True)
    assert sorted(map(tuple, whole.collect())) == [("x\ny", 1), ("z", 2)]
    for wrong in (text, "a,b\n1,2,3\n", "a,b\n1\n"):
        found = read_csv_typed(spark, write(tmp_path, wrong), "a string, b int")
        with pytest.raises(Exception, match="(?i)malformed"):
            found.collect()
        with pytest.raises(Exception, match="(?i)malformed"):
            found.select("b").collect()


@pytest.mark.parametrize("told", [True, False])
def test_records_across_splits(spark, tmp_path, monkeypatch, told):
    """Many tasks give the rows that one reader of the whole file gives, line breaks as they are."""
    from featloom.sources import records

    if not told:
        monkeypatch.setattr(records, "TOLD_CHARACTERS", -1)
    pick = random.Random(4)
    parts = ["a", '""', "\n", "\r\n", ",", "é", "x y", "\n\n", "1", '"",\n""']
    folder = tmp_path / "many"
    folder.mkdir()
    for number in range(4):
        end = "\n" if number % 2 else "\r\n"
        out = ["a,b,c" + end]
        for row in range(400):
            long = 3000 if row % 97 == 5 else 6
            quoted = "".join(pick.choices(parts, k=pick.randrange(long)))
            out.append(f'{number}-{row},"{quoted}",{pick.choice(["", "plain", "NA"])}{end * pick.choice([1, 1, 2])}')
        (folder / f"{number}.csv").write_bytes("".join(out).encode())
    expected = []
    for file in folder.iterdir():
        with file.open(newline="") as text:
            held = [tuple(None if f in ("", "NA") else f for f in r) for r in list(csv.reader(text))[1:] if r]
        assert len(held) == 400
        expected += held
        if file.stem in "13":  # with line feeds, Spark's reader with one task a file says the same
            plain = spark.read.csv(str(file), header=True, escape='"', multiLine=True, nullValue="NA")
            rows_ = [tuple(f or None for f in r) for r in plain.collect()]
            assert sorted(rows_, key=str) == sorted(held, key=str)
    expected.sort(key=str)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        found = read_csv_typed(spark, str(folder), "a string, b string, c string", null_tokens=["NA"], multiline=True)
        assert sorted(map(tuple, found.collect()), key=str) == expected
        lines = spark.read.text(str(folder)).select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
        assert lines > 16
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_errors_of_broken_records(spark, tmp_path):
    def found(text, schema="a string, b int"):
        return read_csv_typed(spark, write(tmp_path, text), schema, multiline=True)

    for wrong in ("a,b\n1,2,3\n", 'a,b\n"x\ny"\n'):
        for frame in (found(wrong), found(wrong).select("b")):
            with pytest.raises(Exception, match="(?i)malformed"):
                frame.collect()
    with pytest.raises(Exception, match="names of the schema"):
        found('a,c\n"x\ny",1\n').collect()
    with pytest.raises(Exception, match="not int"):
        found('a,b\n"x\ny",z\n').collect()
    assert found("a,b\n").collect() == [] and found("").collect() == []
    assert [tuple(r) for r in found('A,b\n"",""\n"x",2').collect()] == [(None, None), ("x", 2)]


def test_failed_overwrite_changes_nothing(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    save_overwrite(spark.createDataFrame([(1, "a")], "k int, v string"), name, f"{tmp_path}/t")
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("k"), F.lit("b").alias("v"))
    with pytest.raises(Exception, match="broken"):
        save_overwrite(broken, name, f"{tmp_path}/t")
    assert list(map(tuple, spark.table(name).collect())) == [(1, "a")]
    # a table may be replaced by rows read from itself
    for _ in range(4):
        more = spark.table(name).select((F.col("k") + 1).alias("k"), "v")
        save_overwrite(more, name, f"{tmp_path}/t")
    assert list(map(tuple, spark.table(name).collect())) == [(5, "a")]
    assert len(list((tmp_path / "t").iterdir())) == 2
    plain = f"t_{uuid.uuid4().hex}"
    spark.range(2).write.saveAsTable(plain)
    with pytest.raises(ValueError, match="not a feature table"):
        save_overwrite(spark.range(3), plain)


def test_storage_does_not_grow(spark, tmp_path):
    name = f"features_{uuid.uuid4().hex}"
    create_feature_table(spark, name, "id", rows(spark, (1, "a")).schema, buckets=2, location=f"{tmp_path}/t")
    with scratch_scope(spark):
        for k in range(10):
            merge(spark, name, rows(spark, (k % 3, f"v{k}")))
    assert content(spark.table(name)) == [(0, "v9"), (1, "v7"), (2, "v8")]
    # two snapshots of two buckets, and a bucket that did not change is in both
    assert len(list((tmp_path / "t").glob("s*/*=*"))) <= 4
    assert len(list((tmp_path / "t").iterdir())) <= 4
    assert len([t for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]) == 2
    drop_feature_table(spark, name)
    assert list((tmp_path / "t").iterdir()) == []


@pytest.fixture(params=[0, 4])
def feature_name(spark, request):
    name = f"features_{uuid.uuid4().hex}"
    schema = spark.createDataFrame([], "id bigint, v string").schema
    assert create_feature_table(spark, name, "id", schema, "it's a \\ test", request.param)
    assert not create_feature_table(spark, name, "id", schema)
    yield name
    drop_feature_table(spark, name)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id bigint, v string")


def content(table):
    return sorted(map(tuple, table.collect()))


def test_merge(spark, feature_name):
    assert content(spark.table(feature_name)) == []
    merge(spark, feature_name, rows(spark, (1, "old"), (2, "old")))
    updates = rows(spark, (2, "new"), (3, "new"))
    wanted = [(1, "old"), (2, "new"), (3, "new")]
    assert content(merge(spark, feature_name, updates)) == wanted
    assert content(merge(spark, feature_name, updates)) == wanted
    # A table can be merged with rows read from itself.
    assert content(merge(spark, feature_name, spark.table(feature_name).filter("id = 3"))) == wanted
    facts = feature_table(spark, feature_name)
    assert (facts.key, facts.snapshot, facts.comment) == (("id",), 4, "it's a \\ test")


def test_merge_rejects_bad_keys(spark, feature_name):
    merge(spark, feature_name, rows(spark, (1, "old")))
    with pytest.raises(ValueError, match="duplicate"):
        merge(spark, feature_name, rows(spark, (2, "a"), (2, "b")))
    with pytest.raises(ValueError, match="missing"):
        merge(spark, feature_name, rows(spark, (None, "a")))
    assert content(spark.table(feature_name)) == [(1, "old")]


def test_drop(spark):
    name = f"features_{uuid.uuid4().hex}"
    create_feature_table(spark, name, "id", rows(spark, (1, "a")).schema)
    merge(spark, name, rows(spark, (1, "a")))
    drop_feature_table(spark, name)
    drop_feature_table(spark, name)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name)]


def test_bucketed_merge_does_not_move_stored_rows(spark):
    from featloom.operators.upsert import upsert_rows

    name = f"features_{uuid.uuid4().hex}"
    create_feature_table(spark, name, "id", rows(spark, (1, "a")).schema, buckets=4)
    merge(spark, name, rows(spark, *[(i, "a") for i in range(100)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        updates = rows(spark, (1, "b")).repartition(4, "id")
        merged = upsert_rows(spark.table(name), updates, ["id"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    assert plan.count("Exchange") == 2  # the updates, once for their keys and once as rows
    drop_feature_table(spark, name)


def files(table):
    return {f.rpartition("=")[2].partition("/")[0]: f for f in table.inputFiles()}


def test_merge_writes_only_buckets_with_updates(spark, tmp_path):
    name = f"features_{uuid.uuid4().hex}"
    create_feature_table(spark, name, "id", rows(spark, (1, "a")).schema, buckets=8, location=f"{tmp_path}/t")
    merge(spark, name, rows(spark, *[(i, "a") for i in range(200)]))
    expected = {i: "a" for i in range(200)}
    before = files(spark.table(name))
    assert len(before) == 8
    earlier = spark.table(f"{name}__s1")
    for round_, ids in enumerate([[7], [7], [300], [3, 4], [], range(200)]):
        merge(spark, name, rows(spark, *[(i, f"r{round_}") for i in ids]))
        expected |= {i: f"r{round_}" for i in ids}
        after = files(spark.table(name))
        buckets = spark.range(1).selectExpr("explode(array(%s)) id" % ",".join(f"{i}L" for i in ids) if ids else "0L id")
        touched = {str(r[0]) for r in buckets.selectExpr("pmod(hash(id), 8)").collect()} if ids else set()
        assert {b for b in after if after[b] != before.get(b)} == touched
        assert content(spark.table(name)) == sorted(expected.items())
        if round_ == 0:  # readers of the snapshot before still have their files
            assert content(earlier.select("id", "v")) == [(i, "a") for i in range(200)]
        before = after
    # a lookup by the key finds every row in the bucket it is read from
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.range(400).join(spark.table(name), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert content(joined) == sorted(expected.items())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1
    assert [r.v for r in spark.table(name).filter("id = 300").collect()] == ["r2"]
    drop_feature_table(spark, name)
    assert list((tmp_path / "t").iterdir()) == []


def test_merge_with_keys_of_another_type(spark):
    name = f"features_{uuid.uuid4().hex}"
    create_feature_table(spark, name, "id", rows(spark, (1, "a")).schema, buckets=8)
    merge(spark, name, rows(spark, *[(i, "a") for i in range(20)]))
    merge(spark, name, rows(spark, (3, "b"), (30, "b")).selectExpr("CAST(id AS int) AS id", "v"))
    merge(spark, name, rows(spark, (3, "c")))
    wanted = {i: "a" for i in range(20)} | {3: "c", 30: "b"}
    assert content(spark.table(name)) == sorted(wanted.items())
    drop_feature_table(spark, name)


def test_qualified_name_and_leftover_snapshot(spark, tmp_path):
    """A snapshot that a failed merge left behind is replaced by the next merge."""
    name = f"default.features_{uuid.uuid4().hex}"
    schema = rows(spark, (1, "a")).schema
    create_feature_table(spark, name, "id", schema, location=f"{tmp_path}/t")
    rows(spark, (5, "left over")).write.saveAsTable(f"{name}__s1")
    assert content(merge(spark, name, rows(spark, (1, "a")))) == [(1, "a")]
    assert feature_table(spark, name).location == f"{tmp_path}/t"
    drop_feature_table(spark, name)
    assert not spark.catalog.tableExists(name)
