import threading
from datetime import datetime

import pytest
from conftest import rows

from lakesync.functions.idents import parse_schema
from lakesync.sources.catalog import Catalog, NotFound
from lakesync.sources.snapshot import CommitConflict, SnapshotTable


@pytest.fixture
def catalog(spark, tmp_path):
    found = Catalog(spark, f"file://{tmp_path}/wh")
    found.create_namespace("n")
    return found


def data(spark, *ids):
    return spark.createDataFrame([(i, f"r{i}") for i in ids], "id long, name string")


def test_append_read_count(spark, catalog):
    table, new = catalog.create_table("n.t", parse_schema("id:long,name:string"))
    assert new and table.read().count() == 0 and table.count() == 0 and table.stats()["total-records"] is None
    table.append(data(spark, 1, 2))
    table.append(data(spark, 3), {"sync.x": "1"})
    assert rows(table.read()) == [(1, "r1"), (2, "r2"), (3, "r3")] and table.count() == 3 and table.metadata().properties == {"sync.x": "1"}
    first = table.metadata().snapshots[0].id
    assert rows(table.read(first)) == [(1, "r1"), (2, "r2")]
    assert [r["is_current"] for r in table.snapshots().collect()] == [True, False]
    stats = table.stats()
    assert stats["total-records"] == 3 and stats["added-records"] == 1 and stats["total-delete-files"] == 0 and stats["total-files-size"] > 0
    assert not catalog.create_table("n.t", parse_schema("id:long"))[1]
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,1)]" in table.read().where("id > 1")._jdf.queryExecution().executedPlan().toString()


def test_schema_evolution_by_field_id(spark, catalog):
    table, _ = catalog.create_table("n.t", parse_schema("id:long,name:string"))
    table.append(data(spark, 1))
    table.drop_column("name")
    table.add_column("name", parse_schema("x:string")["x"].dataType)
    assert rows(table.read()) == [(1, None)]  # the old column of that name had another id
    table.append(data(spark, 2))
    assert rows(table.read()) == [(1, None), (2, "r2")]
    assert [f.metadata["parquet.field.id"] for f in table.metadata().schema] == [1, 3]
    for call in (lambda: table.add_column("id", parse_schema("x:int")["x"].dataType), lambda: table.drop_column("absent")):
        with pytest.raises(ValueError):
            call()
    table.drop_column("id")
    with pytest.raises(ValueError):
        table.drop_column("name")


def test_partitions_are_split_by_row_and_replaced_whole(spark, catalog):
    table, _ = catalog.create_table("n.t", parse_schema("id:long,at:timestamp"), {"column": "at", "transform": "month"})
    day = lambda m, d: datetime(2024, m, d)
    frame = lambda *r: spark.createDataFrame(list(r), "id long, at timestamp_ntz")
    table.append(frame((1, day(1, 1)), (2, day(1, 9)), (3, day(2, 1)), (4, None), (5, datetime(1969, 12, 31))))
    assert {f.partition for f in table.manifest()} == {"2024-01", "2024-02", "1969-12", None}
    kept = {f.path for f in table.files_of(["2024-01", None], inverse=True)}
    table.replace_partitions(frame((9, day(1, 31)), (8, None)), table.metadata())
    assert [r[0] for r in rows(table.read())] == [3, 5, 8, 9] and kept <= {f.path for f in table.manifest()}
    assert rows(table.read(partitions=["2024-02"]))[0][0] == 3 and table.read().columns == ["id", "at"]
    assert table.stats()["deleted-records"] == 3
    with pytest.raises(ValueError):
        table.drop_column("at")
    for bad in ({"column": "id", "transform": "day"}, {"column": "at", "transform": "week"}):
        with pytest.raises(ValueError):
            SnapshotTable.create(spark, f"{table.location}-x", parse_schema("id:long,at:timestamp"), bad)


def test_concurrent_commits(spark, catalog):
    table, _ = catalog.create_table("n.t", parse_schema("id:long,name:string"))
    planned_on = table.metadata()
    files = [table.write_files(data(spark, i)) for i in range(6)]
    threads = [threading.Thread(target=SnapshotTable(spark, table.location).commit_append, args=(f,)) for f in files]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [r[0] for r in rows(table.read())] == list(range(6)) and len(table.metadata().snapshots) == 6
    with pytest.raises(CommitConflict):
        table.replace_all(data(spark, 7), planned_on)
    assert table.count() == 6
    table.replace_all(table.read().where("id < 2"), table.metadata())
    assert table.count() == 2 and len(table.metadata().snapshots) == 7


def test_expire_keeps_the_current_snapshot(spark, catalog):
    table, _ = catalog.create_table("n.t", parse_schema("id:long,name:string"))
    with pytest.raises(ValueError):
        table.expire_snapshots()
    for i in range(3):
        table.append(data(spark, i))
    assert table.expire_snapshots(7) == 0 and table.expire_snapshots(-1) == 2 and table.count() == 3 and table.snapshots().count() == 1


def test_catalog(spark, catalog):
    assert catalog.create_namespace("a.b", {"k": "v"}) and not catalog.create_namespace("a.b") and catalog.namespaces() == ["a", "n"]
    assert catalog.namespace_properties("a.b", {"z": "1"}, ["k"]) == {"z": "1"} and catalog.namespace_properties("a.b") == {"z": "1"}
    table, _ = catalog.create_table("a.b.t", parse_schema("id:long,name:string"))
    table.append(data(spark, 1, 2))
    catalog.create_table("n.u", parse_schema("id:long,name:string"))
    assert catalog.copy_table("a.b.t", "n.u", 1) == 1 and catalog.load("n.u").count() == 1
    catalog.create_table("n.other", parse_schema("id:int"))
    with pytest.raises(ValueError):
        catalog.copy_table("a.b.t", "n.other")
    with pytest.raises(ValueError):
        catalog.rename_table("a.b.t", "n.u")
    catalog.rename_table("a.b.t", "n.t")
    assert catalog.tables("a.b") == [] and catalog.tables("n") == ["other", "t", "u"] and catalog.load("n.t").count() == 2
    for call in (lambda: catalog.load("a.b.t"), lambda: catalog.tables("zzz"), lambda: catalog.create_table("zzz.t", parse_schema("id:int")), lambda: catalog.describe("n.zzz")):
        with pytest.raises(NotFound):
            call()
    with pytest.raises(ValueError):
        catalog.drop_namespace("n")
    with pytest.raises(ValueError):
        catalog.drop_namespace("a")
    assert catalog.drop_namespace("a.b") and not catalog.drop_namespace("a.b") and catalog.namespaces() == ["a", "n"]
    found = {(r["item"], r["name"]): r["value"] for r in catalog.describe("n.t").collect()}
    assert found["field", "name"] == "2: string, optional" and found["table", "current-snapshot-id"]


def test_drop_and_purge(spark, catalog):
    for purge in (False, True):
        table, _ = catalog.create_table("n.t", parse_schema("id:long,name:string"))
        table.append(data(spark, 1))
        table.replace_all(data(spark, 2), table.metadata())
        paths = [f.path for s in table.metadata().snapshots for f in table.manifest(s.id)]
        done = catalog.drop_table("n.t", purge)
        assert all(table.files.exists(p) != purge for p in paths) and (done[0] > len(paths)) == purge and done[1] == 0
        assert catalog.drop_table("n.t") is None


def test_ranges_prune_files(spark, tmp_path):
    """Files outside the wanted values are not opened; what is read is the same as without ranges."""
    from datetime import date, datetime

    from lakesync.sources.footers import meets

    schema = parse_schema("id:long,name:string,day:date,at:timestamp,x:double")
    table = SnapshotTable.create(spark, f"file://{tmp_path}/t", schema)
    rows = lambda ids: [(i, None if i % 10 == 9 else f"n{i:03d}", date(2024, 1, 1 + i // 10), datetime(2024, 1, 1, i // 10, i % 10), i / 2) for i in ids]
    for k in range(0, 50, 10):
        table.append(spark.createDataFrame(rows(range(k, k + 10)), schema).coalesce(1))
    table.append(spark.createDataFrame([(None, None, None, None, None)], schema).coalesce(1))
    first = table.manifest()[0]
    assert first.ranges == {"1": [0, 9, False], "2": ["n000", "n008", True], "3": ["2024-01-01", "2024-01-01", False], "4": ["2024-01-01T00:00:00.000000", "2024-01-01T00:09:00.000000", False]}
    keys = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    near = lambda df, *c: [f.ranges["1"][0] for f in table._near(table.manifest(), df.toDF("__key_0"), list(c))]
    assert near(keys(12, 25), "id") == [10, 20] and near(keys(99), "id") == [] and near(keys(None), "id") == [None] and near(keys(12, None), "id") == [10, None]
    assert near(spark.createDataFrame([("n013",)], "n string"), "name") == [10] and near(spark.createDataFrame([(None,)], "n string"), "name") == [0, 10, 20, 30, 40, None]
    assert [f.ranges["1"][0] for f in table.files_matching(keys(12, 34), ["id"])] == [10, 30] and table.files_matching(keys(-5), ["id"]) == []
    for between, want in (({"id": (12, 14)}, [12, 13, 14]), ({"id": (None, 1), "x": (0.5, None)}, [1]), ({"day": (date(2024, 1, 5), None)}, list(range(40, 50))), ({"at": (datetime(2024, 1, 1, 2, 3), datetime(2024, 1, 1, 2, 4))}, [23, 24]), ({"name": ("n047", None)}, [47, 48])):
        found = table.read(between=between)
        assert sorted(r["id"] for r in found.collect()) == want and len(found.inputFiles()) <= (6 if "x" in between and "id" not in between else 1)
    table.drop_column("name")
    table.add_column("name", schema["name"].dataType)
    assert sorted(r["id"] for r in table.read(between={"id": (3, 4)}).collect()) == [3, 4] and table.read(between={"name": ("a", None)}).count() == 0
    assert meets(None, [1, 2, False]) and not meets([None, None, True], [1, 2, False]) and meets(["a", "b", False], [1, 2, False])


def test_many_footers_are_read_by_the_executors(spark, tmp_path, monkeypatch):
    from lakesync.sources import footers

    schema = parse_schema("id:long")
    table = SnapshotTable.create(spark, f"file://{tmp_path}/t", schema)
    files = table.write_files(spark.range(100).repartition(5))
    monkeypatch.setattr(footers, "ON_THE_DRIVER", 2)
    again = footers.footers(spark, [f.path for f in files])
    assert {f.path: (f.records, f.ranges["1"]) for f in files} == {p: (n, r["id"]) for p, (n, r) in again.items()} and sum(n for n, _ in again.values()) == 100
