import pytest

from lakesync.plans.config import ConfigError, Retry, load, parse
from lakesync.plans.scheduler import Skipped, ordered, run_jobs, with_retry

BASE = """
sources: {pg: {type: postgres, dsn: "host=h dbname=d"}}
destinations: {lake: {catalog_uri: "http://c", s3_endpoint: "http://s"}}
sync_jobs:
"""


def job(name="a", **more):
    given = {"name": name, "source": "pg", "destination": "lake", "namespace": "n", "table": "t", "sql": "SELECT 1", **more}
    return "  - {" + ", ".join(f"{k}: {v}" for k, v in given.items()) + "}\n"


def test_defaults():
    config = parse(BASE + job())
    one = config.sync_jobs[0]
    assert (one.mode, one.write_mode, one.batch_size, one.watermark_type, one.cursor_type) == ("incremental", "append", 500, "timestamptz", "int")
    assert config.retry_for(one) == Retry(3, 500, 2.0) and config.destinations["lake"].region == "us-east-1" and config.destinations["lake"].catalog_name == "default"
    assert parse(BASE + job(iceberg_partition="{column: d}")).sync_jobs[0].iceberg_partition.transform == "day"
    assert parse(BASE + job(retry="{max_attempts: 5}")).retry_for(parse(BASE + job(retry="{max_attempts: 5}")).sync_jobs[0]) == Retry(5, 500, 2.0)


@pytest.mark.parametrize("text", [
    job(source="x"), job(destination="x"), job(depends_on="x"), job(depends_on="a"), job() + job(), job(mode="full", cursor_column="id"), job(write_mode="overwrite"),
    job(write_mode="upsert"), job(write_mode="merge_into", merge="{key_columns: []}"), job("a", depends_on="b") + job("b", depends_on="a"),
    job("a", depends_on="c") + job("b", depends_on="a") + job("c", depends_on="b"), job(batch_size="0"), job(retry="{max_attempts: 0}"), job(write_mode="replace"),
    job(iceberg_partition="{column: d, transform: week}"), job(commit_granularity="batch", cursor_column="id", write_mode="upsert", merge="{key_columns: [id]}"),
    job(batch_size="many"), job() + "rabbitmq: {uri: u, queues: [{queue: q, job: nope}]}\n", "  - {name: a}\n", "  nonsense: [", job(namespace="''"),
])
def test_rejected(text):
    with pytest.raises(ConfigError):
        parse(BASE + text)


def test_missing_file():
    with pytest.raises(ConfigError):
        load("/nonexistent.yaml")


def test_order_and_filters():
    config = parse(BASE + job("c", depends_on="b", group="g") + job("b", depends_on="a") + job("a") + job("d", group="g"))
    assert [j.name for j in ordered(config)] == ["a", "b", "c", "d"]
    assert [j.name for j in ordered(config, group="g")] == ["c", "d"] and [j.name for j in ordered(config, job="c")] == ["c"] and ordered(config, job="x") == []


def test_retry_delays():
    slept, calls = [], []

    def fail():
        calls.append(1)
        raise OSError("no")

    with pytest.raises(OSError):
        with_retry(Retry(3, 100, 3.0), fail, slept.append)
    assert len(calls) == 3 and slept == pytest.approx([0.1, 0.3])
    assert with_retry(Retry(1), lambda: 7) == 7


@pytest.mark.parametrize("parallel", [1, 3])
def test_dependents_of_failures_are_skipped(parallel):
    config = parse(BASE + job("a") + job("b", depends_on="a") + job("c", depends_on="b") + job("d"))
    done = []

    def run(one):
        done.append(one.name)
        if one.name == "a":
            raise OSError("no")
        return one.name

    found = run_jobs(ordered(config), run, parallel)
    assert isinstance(found["a"], OSError) and isinstance(found["b"], Skipped) and isinstance(found["c"], Skipped) and found["d"] == "d" and sorted(done) == ["a", "d"]
