import pytest

from lakesync.cli import main


@pytest.fixture
def run(spark, tmp_path, capsys):
    def call(*args, code=0):
        assert main(["--warehouse", f"file://{tmp_path}/wh", *args], spark) == code
        out = capsys.readouterr()
        return out.out + out.err

    return call


def test_tables_from_the_command_line(run):
    assert "(no namespaces)" in run("list-namespaces")
    run("create-namespace", "--namespace", "shop")
    assert "already exists" in run("create-namespace", "--namespace", "shop") and "shop" in run("list-namespaces")
    run("create-table", "--table", "shop.p", "--schema", "i:int,l:long,f:float,d:double,b:boolean,s:string,dt:date,ts:timestamp")
    assert "already exists" in run("create-table", "--table", "shop.p", "--schema", "i:int")
    assert "(no data)" in run("scan", "--table", "shop.p") and "No rows" in run("write", "--table", "shop.p", "--json", "[]")
    row = '{"i": 42, "l": 9000000000, "f": 3.5, "d": 2.718, "b": true, "s": "hello", "dt": null, "ts": "2024-01-01T00:00:00Z"}'
    assert "Wrote 2 rows" in run("write", "--table", "shop.p", "--json", f"[{row}, {{}}]")
    out = run("scan", "--table", "shop.p", "--columns", "l, b,s,dt", "--limit", "5")
    assert "9000000000" in out and "true" in out and "NULL" in out and "(2 rows shown, limit=5)" in out and "2.718" not in out
    assert "(1 rows shown, limit=1)" in run("scan", "--table", "shop.p", "--limit", "1")
    assert run("count", "--table", "shop.p").strip() == "2" and "(1 snapshots)" in run("snapshots", "--table", "shop.p")
    assert "total-records" in run("table-stats", "--table", "shop.p") and "parquet" not in run("describe", "--table", "shop.p")
    run("add-column", "--table", "shop.p", "--column", "extra:string")
    run("drop-column", "--table", "shop.p", "--column", "f")
    run("rename-table", "--from", "shop.p", "--to", "shop.q")
    assert "shop" in run("list-tables", "--namespace", "shop") and "0 snapshots expired" in run("expire-snapshots", "--table", "shop.q")
    assert "owner" in run("namespace-properties", "--namespace", "shop", "--set", "owner=me") and "(no properties)" in run("namespace-properties", "--namespace", "shop", "--remove", "owner")
    assert "files deleted" in run("drop-table", "--table", "shop.q", "--purge") and "does not exist" in run("drop-table", "--table", "shop.q")
    assert "dropped" in run("drop-namespace", "--namespace", "shop") and "does not exist" in run("drop-namespace", "--namespace", "shop")


def test_copy(run):
    run("create-namespace", "--namespace", "n")
    for name in ("n.a", "n.b"):
        run("create-table", "--table", name, "--schema", "id:long")
    assert "nothing copied" in run("copy-table", "--from", "n.a", "--to", "n.b")
    run("write", "--table", "n.a", "--json", str([{"id": i} for i in range(200)]).replace("'", '"'))
    assert "Copied 200 rows" in run("copy-table", "--from", "n.a", "--to", "n.b") and "Copied 7 rows" in run("copy-table", "--from", "n.a", "--to", "n.b", "--limit", "7")
    assert run("count", "--table", "n.b").strip() == "207"


def test_errors(run):
    for args in (["scan", "--table", "n.t"], ["describe", "--table", "bad"], ["list-tables", "--namespace", "n"], ["sync", "--config", "/nope.yaml"], ["create-table", "--table", "n.t", "--schema", "a:uuid"]):
        assert "Error: " in run(*args, code=1)


def test_sync_and_dry_run(run, spark, tmp_path):
    spark.createDataFrame([(i, f"p{i}") for i in range(7)], "id long, name string").write.parquet(f"{tmp_path}/src/products.parquet")
    config = tmp_path / "sync.yaml"
    config.write_text(f"""
sources: {{s: {{type: spark, dsn: "file://{tmp_path}/src"}}}}
destinations: {{d: {{warehouse: "file://{tmp_path}/wh"}}}}
retry: {{max_attempts: 1}}
sync_jobs:
  - {{name: products, source: s, destination: d, namespace: shop, table: products, sql: "SELECT id, name FROM products", mode: full, group: g, batch_size: 2}}
  - {{name: broken, source: s, destination: d, namespace: shop, table: broken, sql: "SELECT * FROM absent", mode: full}}
""")
    assert "dry-run" in run("sync", "--config", str(config), "--job", "products", "--dry-run") and "Error" in run("count", "--table", "shop.products", code=1)
    assert "✓  products  rows=7" in run("sync", "--config", str(config), "--group", "g")
    assert "No jobs to run." in run("sync", "--config", str(config), "--job", "zzz")
    out = run("sync", "--config", str(config), "--parallel", "2", code=1)
    assert "✗  broken" in out and "✓  products" in out
    assert run("count", "--table", "shop.products").strip() == "14"
    assert "rabbitmq" in run("sync-consume", "--config", str(config), code=1)
