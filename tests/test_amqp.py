import sys
import types

import pytest

from lakesync.plans.config import Queue
from lakesync.session import store_settings
from lakesync.streaming.amqp import bridge


class Channel:
    def __init__(self, bodies):
        self.bodies, self.log = bodies, []

    def consume(self, queue):
        return ((types.SimpleNamespace(delivery_tag=k), None, b) for k, b in enumerate(self.bodies))

    def __getattr__(self, name):
        return lambda *a, **b: self.log.append((name, a, b))


def test_messages_are_acknowledged_after_they_are_put(monkeypatch):
    channel = Channel([b'{"a": 1}', b"not json", b"\xff", b'{"b":\n2}'])
    connection = types.SimpleNamespace(channel=lambda: channel, close=lambda: None)
    monkeypatch.setitem(sys.modules, "pika", types.SimpleNamespace(BlockingConnection=lambda _: connection, URLParameters=lambda u: u))
    put = []
    assert bridge("amqp://x", Queue("q", "j", "dlx"), lambda name, text: put.append(text)) == 2
    assert put == ['{"a": 1}', '{"b": 2}']
    assert [(n, a) for n, a, _ in channel.log if "ack" in n] == [("basic_ack", (0,)), ("basic_nack", (1,)), ("basic_nack", (2,)), ("basic_ack", (3,))]
    assert channel.log[0][2] == {"queue": "q", "durable": True, "arguments": {"x-dead-letter-exchange": "dlx"}}


def test_without_the_client(monkeypatch):
    monkeypatch.setitem(sys.modules, "pika", None)
    with pytest.raises(RuntimeError):
        bridge("amqp://x", Queue("q", "j"), print)


def test_store_settings():
    assert store_settings(None, "us-east-1", None, None, None) == {}
    found = store_settings("http://h:9000", "r", "k", "s", "t")
    assert found["fs.s3a.endpoint"] == "http://h:9000" and found["fs.s3a.connection.ssl.enabled"] == "false" and "fs.s3a.aws.credentials.provider" in found


def test_a_broker_is_consumed(spark, monkeypatch, tmp_path):
    from lakesync.plans.config import parse
    from lakesync.streaming.consumer import Consumer

    class Idle(Channel):
        def consume(self, queue, inactivity_timeout=None):
            assert inactivity_timeout
            yield from super().consume(queue)
            yield None, None, None

    channel = Idle([b'{"id": 3}', b"not json", b'{"id": 5}'])
    connection = types.SimpleNamespace(channel=lambda: channel, close=lambda: None)
    monkeypatch.setitem(sys.modules, "pika", types.SimpleNamespace(BlockingConnection=lambda _: connection, URLParameters=lambda u: u))
    config = parse("""
sources: {s: {type: spark}}
destinations: {d: {warehouse: x}}
rabbitmq: {uri: "amqp://guest@host", queues: [{queue: q, job: j}]}
sync_jobs: [{name: j, source: s, destination: d, namespace: n, table: t, sql: SELECT 1}]
""")
    ran = []

    class Engine:
        def catalog(self, _):
            return types.SimpleNamespace(exists=lambda _: False)

        def run(self, job, parameters, properties):
            ran.append((job.name, parameters))
            return types.SimpleNamespace(rows_written=1)

    Consumer(spark, Engine(), config, f"file://{tmp_path}/c").run(once=True)
    assert sorted(ran, key=str) == [("j", {"id": 3}), ("j", {"id": 5})]
    assert [n for n, *_ in channel.log if "ack" in n] == ["basic_ack", "basic_nack", "basic_ack"]
