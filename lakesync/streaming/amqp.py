"""A bridge from an AMQP queue to the message folder that the consumer reads; needs the pika client.

The queue is durable, with a dead-letter exchange if one is named; one message is under way at a time. It is
acknowledged once its file is in the folder, so a message may come twice but is not lost; what is no JSON object is
rejected without being queued again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from ..functions.coerce import json_parameters
from ..plans.config import Queue


def bridge(uri: str, binding: Queue, put: Callable[[str, str], None], limit: int | None = None, idle: float | None = None) -> int:
    """Hand each message to put(file name, text); returns the messages handed over.

    limit: how many to take, all that come by default; idle: seconds without a message after which to end.
    """
    try:
        import pika
    except ImportError as error:
        raise RuntimeError("An AMQP source needs the pika client; drop message files into the queue's folder instead") from error

    connection = pika.BlockingConnection(pika.URLParameters(uri))
    channel, taken = connection.channel(), 0
    arguments = {"x-dead-letter-exchange": binding.dead_letter_exchange} if binding.dead_letter_exchange else None
    channel.queue_declare(queue=binding.queue, durable=True, arguments=arguments)
    channel.basic_qos(prefetch_count=1)
    try:
        for method, _, body in channel.consume(binding.queue, **({"inactivity_timeout": idle} if idle else {})):
            if method is None:
                break
            try:
                text = body.decode()
                json_parameters(text)
            except ValueError:
                channel.basic_nack(method.delivery_tag, requeue=False)
            else:
                put(f"{uuid.uuid4().hex}.json", " ".join(text.splitlines()))
                channel.basic_ack(method.delivery_tag)
                taken += 1
            if limit is not None and taken >= limit:
                break
    finally:
        channel.cancel()
        connection.close()
    return taken
